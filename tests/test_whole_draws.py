"""downsampled against a plain draw, and how many rows it shuffles."""

import pytest
from pyspark.sql import functions as F
from seqloom.operators import matrix

ROWS = [(f, s, float((f * 7 + len(s) * 3) % 40 + (900 if f == 5 else 0))) for f in range(120) for s in ("a", "bb", "ccc")] + [(1, "small", 30.0), (2, "small", 0.0)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "feature long, sample string, value double")


def plain(spark, depth, seed=0):
    reads = [(f, s, i) for f, s, v in ROWS for i in range(1, int(v) + 1)]
    hashed = spark.createDataFrame(reads, "feature long, sample string, i long").withColumn("h", F.xxhash64("feature", "sample", "i", F.lit(seed))).collect()
    out = {}
    for s in {r.sample for r in hashed}:
        own = sorted((r.h % 2**64, r.feature, r.i) for r in hashed if r.sample == s)
        if len(own) >= depth:
            for _, f, _ in own[:depth]:
                out[f, s] = out.get((f, s), 0) + 1
    return out


@pytest.mark.parametrize("spare", [matrix.SPARE, -0.9])
@pytest.mark.parametrize("depth", [1, 30, 500, 2500])
def test_the_smallest_hashes_win(spark, monkeypatch, depth, spare):
    monkeypatch.setattr(matrix, "SPARE", spare)
    got = matrix.downsampled(frame(spark), depth).collect()
    assert {(r.feature, r.sample): r.value for r in got} == plain(spark, depth)


def test_reads_that_lose_are_not_shuffled(spark):
    plan = matrix.downsampled(spark.range(50).selectExpr("id AS feature", "'a' AS sample", "20000.0D AS value"), 100)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_nothing_is_drawn(spark):
    assert matrix.downsampled(frame(spark), 10**6).collect() == [] and matrix.downsampled(frame(spark, []), 5).collect() == []
    assert matrix.downsampled(frame(spark), 0).collect() == []
