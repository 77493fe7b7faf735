"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import importlib.util
import math
import re
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
entry_module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_module)
# The operators of the llm subpackage have tests of their own, in its folder.
QUERIES, ORACLE = (
    {k: v for k, v in d.items() if not re.fullmatch(r"op\d+_\w+|pipeline", k)}
    for d in (entry_module.queries(), entry_module.oracle_sql())
)
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def in_order(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_entry(spark):
    assert entry_module.entry(spark).count() == 5


def test_only_the_approximate_search_has_no_sql():
    assert set(QUERIES) - set(ORACLE) == {"approximate_knn_recall"} and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    result = duck.execute(ORACLE[name])
    columns = {c[0]: str(c[1]) for c in result.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == columns
    want = in_order(result.fetchall())
    assert in_order([tuple(r[c] for c in columns) for r in df.collect()]) == want


def test_approximate_search(spark):
    row = QUERIES["approximate_knn_recall"](spark, DATA).first()
    assert row.n_exact == 2500 and 0.5 < row.recall <= 1 and 0 < row.scored_share < 0.5
