"""Validity, truth and serialisation agree with Python's own parser."""

from __future__ import annotations

import json

import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import json as J
from shelfmark.operators.once import evaluate_once
from shelfmark.operators.records import with_object
from shelfmark.session import ARROW_BATCH_BYTES

LINES = [
    '{"a":1}', '{"a":1} x', "{'a':1}", '{"a":1,"a":2}', '{"a":NaN}', '{"a":Infinity}',
    '{"a":-Infinity}', '{"a":+Infinity}', '{"a":+INF}', '{"a":-INF}', '{"a":INF}', '{"a":"+Infinity"}',
    '{"INF":"say \\"INF\\" -INF"}', '{"a":"x\\\\"} +INF', "5", "null", '"x"', "[1]", "[]", "{}", '{"a":1}]',
    '{"a":1},5', '{"a":1},{"b":2}', '{"a":01}', '{"a":1.}', '{"a":.5}', '{"a":"\t"}', '{"a":"\\x"}',
    '{"a":tru}', "{a:1}", '{"a":1,}', "[1,]", '{"a":1e999}', '{"a":123456789012345678901234567890}',
    '/*c*/{"a":1}', '{"a":1}//x', '{"a":"\\u00e9é"}', "+1", "-0", "0.0", "1E400", '{"a":"b"', "nan", "NaN",
    "-NaN", "+Infinity", '{"a":-NaN}', '{"a":1}\u00a0', '{"a":\u00a01}', '{"a":"x\u0001y"}', "1,2", "],[",
    "1 2", '{"shelfmark~end":true}', '{"a":1},{"shelfmark~end":true}', '1,"shelfmark~end"', '{"a":"\u2028"}',
    "'a'", "tRue", "True", '{"a":[1,{"b":null}]}', '{"a":1}}', '{"a":1}{"b":2}', '"a" "b"', '\\"',
]


def python_accepts(line: str) -> bool:
    try:
        json.loads(line)
    except ValueError:
        return False
    return True


def verdicts(spark, lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    df = with_object(df, "a variant", "rec").select(
        "i",
        "line",
        J.is_json("line").alias("ok"),
        F.coalesce(J.reject_reason("line", "rec"), F.lit("object")).alias("kind"),
        J.canonical_json(F.col("line")).alias("canonical"),
    )
    return [r.asDict() for r in df.orderBy("i").collect()]


def check(spark, lines):
    for r in verdicts(spark, lines):
        valid = python_accepts(r["line"])
        assert r["ok"] == valid, r
        if not valid:
            assert r["kind"] == "bad_json" and r["canonical"] is None, r
            continue
        value = json.loads(r["line"])
        assert r["kind"] == ("object" if isinstance(value, dict) else "not_object"), r
        assert r["canonical"] == json.dumps(value, ensure_ascii=False), r


def test_fixed_lines(spark):
    check(spark, LINES)


_values = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**60), 2**60) | st.floats(allow_nan=False)
    | st.text(st.characters(exclude_categories=["Cs"]), max_size=6),
    lambda inner: st.lists(inner, max_size=3)
    | st.dictionaries(st.text("abc", max_size=2), inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(_values, st.sampled_from(["", "", "}", "]", ",", " x", "'", ' "', ":1"]), st.integers(0, 3)),
        min_size=20,
        max_size=40,
    )
)
def test_generated_lines(spark, cases):
    lines = []
    for value, tail, cut in cases:
        text = json.dumps(value, ensure_ascii=False)
        lines.append((text[: len(text) - cut] if cut > 1 else text) + tail)
    # A lone surrogate cannot be stored as UTF-8; the strategy makes none.
    check(spark, [x.replace("\n", " ") for x in lines if x.strip()])


def test_truth_of_values(spark):
    values = ["0", "0.0", "-0", "0e5", "1", "-0.5", "1e-3", "true", "false", "null", '""', '" "', '"0"',
              '"false"', "[]", "[0]", "[null]", "{}", '{"a":0}', "NaN", "12345678901234567890123", "1e400"]
    lines = [(v, f'{{"v":{v}}}') for v in values] + [("missing", "{}")]
    df = with_object(spark.createDataFrame(lines, "v string, line string"), "v variant", "rec")
    df = evaluate_once(df, d=J.described("rec.v")).select(
        "v", F.expr(J.truthy("d")).alias("t"), F.expr(J.filled_text("d")).alias("text")
    )
    for r in df.collect():
        value = None if r.v == "missing" else json.loads(r.v)
        assert r.t == bool(value), r
        if isinstance(value, str) and value:
            assert r.text == value
        if isinstance(value, (list, dict)) or not value:
            assert r.text is None
    texts = {r.v: r.text for r in df.collect()}
    assert texts["1"] == "1" and texts["-0.5"] == "-0.5" and texts["true"] == "True"


def test_repeated_keys_last_wins(spark):
    df = spark.createDataFrame([('{"a":1,"a":"z"}',)], "line string")
    assert with_object(df, "a variant", "rec").select(F.expr("rec.a::string")).first()[0] == "z"


def test_lines_python_cannot_write_or_read(spark):
    lines = ['{"a":"\\ud800é"}', '{"a":' + "9" * 5000 + "}", "[" * 200_000 + "]" * 200_000]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    got = df.select("i", J.canonical_json(F.col("line")).alias("c")).orderBy("i").collect()
    # Long numbers are numbers; what is nested too deep to write anew stays as it is.
    assert [r.c for r in got] == ['{"a": "?é"}', '{"a": ' + "9" * 5000 + "}", lines[2]]


def test_lines_reach_python_in_bounded_portions(spark):
    """What a worker holds follows from bytes, however many lines a partition has."""
    lines = [json.dumps({"n": i, "s": "é" * (50_000 if i % 3 else 5)}, ensure_ascii=False) if i % 7 else None for i in range(200)]
    parts = list(J._portions(pa.array([*lines, "x" * (3 << 20)])))
    assert sum(map(len, parts)) == 201 and max(p.nbytes for p in parts[:-1]) < 2 * J.PORTION_BYTES and len(parts[-1]) == 1
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i long, line string").coalesce(1)

    @F.arrow_udf("long")
    def held(batch: pa.Array) -> pa.Array:
        return pa.array([batch.nbytes] * len(batch))

    judged = J.with_verdict(df)
    assert max(r[0] for r in judged.select(held("line")).collect()) < 2 * ARROW_BATCH_BYTES
    got = judged.select("i", "verdict", J.canonical_json(F.col("line")).alias("c")).orderBy("i").collect()
    assert [r.c for r in got] == lines
