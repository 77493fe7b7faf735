from __future__ import annotations

import sys

from pyspark.sql import functions as F

from shelfmark.functions import names as N
from shelfmark.functions import text as X


def test_strip_like_python(spark):
    spaces = [chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()]
    assert set(spaces) == set(X.WHITESPACE)
    words = ["", " ", "a b", "\u200ba\u200b", "\ufeffx"] + [f"{s}x{s}y{s}{s}" for s in spaces]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for w, s in df.select("w", X.strip(F.col("w"))).collect():
        assert s == w.strip()


def test_defaults_fallbacks_composition(spark):
    rows = [("L", "D"), ("L", ""), ("L", None), (" ", "D"), ("", None), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = df.select(X.or_empty(a), X.first_filled(a, b), X.label_with_definition(a, b)).collect()
    assert [r[0] for r in got] == ["L", "L", "L", " ", "", ""]
    assert [r[1] for r in got] == ["L", "L", "L", " ", None, None]
    assert [r[2] for r in got][:4] == ["L. D", "L", "L", " . D"]


def test_four_decimals(spark):
    values = [1.0, 0.36999359, -0.00004, 12345.67891, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", X.fixed4(F.col("v")))
    for v, s in df.collect():
        assert s.lower() == f"{v:.4f}"


def test_schemes_and_classifications(spark):
    rows = ["(ppn)1", "(a)(b)c", "plain", "()x", "(open", "(classificationName=rvk)LH 1",
            "(classificationName=bk, id=7)20.08 - X", "(other) y", "(classificationName=linseach:mapping)a\nb"]
    df = spark.createDataFrame([(r,) for r in rows], "v string")
    v = F.col("v")
    got = df.select(N.scheme_of(v), N.value_of(v), N.classification(v).alias("c")).collect()
    assert [(r[0], r[1]) for r in got][:5] == [("ppn", "1"), ("a", "(b)c"), (None, "plain"), ("", "x"), (None, "(open")]
    assert [tuple(r["c"]) for r in got][5:] == [
        ("rvk", None, "LH 1"), ("bk", "7", "20.08 - X"), (None, None, "(other) y"), ("linseach:mapping", None, "a\nb")
    ]


def test_expand_iri(spark):
    df = spark.createDataFrame(
        [("g:1-2",), ("https://x/y",), ("plain",), ("q:1",), (None,)], "n string"
    ).withColumn("p", F.create_map(F.lit("g"), F.lit("http://g/")))
    got = [r[0] for r in df.select(N.expand_iri(F.col("n"), F.col("p"))).collect()]
    assert got == ["http://g/1-2", "https://x/y", "plain", "q:1", None]
