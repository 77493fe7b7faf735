from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from shelfmark.operators.encode import encode, hashed_words


def test_stand_in_equals_plain_sql(spark):
    texts = ["a b a", "a\tb\nc  a", "", " ", "über straße über", "x" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: r.embedding for r in encode(df, hashed_words(16)).collect()}
    words = df.select("id", F.explode(F.split("text", "[ \n\t]")).alias("w")).where("w <> ''")
    bucket = F.conv(F.substring(F.md5("w"), 1, 8), 16, 10).cast("long") % 16
    counts = np.zeros((len(texts), 16))
    for r in words.groupBy("id", bucket.alias("b")).count().collect():
        counts[r.id, r.b] = r["count"]
    for i, c in enumerate(counts):
        assert np.allclose(got[i], c / (np.linalg.norm(c) + 1e-12), atol=1e-7)


def test_one_encoder_for_the_tasks_of_a_worker(spark):
    def make():
        import os
        import uuid

        mine = int(uuid.uuid4().int % 2**24)
        return lambda texts: np.array([[os.getpid() % 2**24, mine, len(texts)]] * len(texts))

    df = spark.range(0, 300, 1, 12).select("id", F.lit("t").alias("text"))  # 12 tasks on 4 workers at most
    got = {tuple(r.embedding) for r in encode(df, make, normalize=False).collect()}
    workers = {g[0] for g in got}
    assert {g[2] for g in got} == {25.0}  # a whole task's batch
    assert len({g[:2] for g in got}) == len(workers) < 12


def test_encoder_runs_once_per_row(spark):
    from conftest import plan_of

    df = spark.range(10).select("id", F.lit("a b").alias("text"))
    out = encode(df, hashed_words(4)).where(F.size("embedding") > 0).select("id", F.posexplode("embedding"))
    assert plan_of(out).count("ArrowEvalPython") == 1 and out.count() == 40


def test_null_text_and_empty_input(spark):
    df = spark.createDataFrame([(1, None)], "id long, text string")
    assert encode(df, hashed_words(4)).first().embedding == [0.0] * 4
    assert encode(df.where("id > 1"), hashed_words(4)).count() == 0
