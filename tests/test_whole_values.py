"""correlated_features for every hundredth feature and em_abundance to its tolerance, against plain versions."""

import math
import os
from collections import Counter, defaultdict

import duckdb
import pytest
from seqloom import catalog
from seqloom.operators import genes, matrix
from seqloom.plans.bindings import VIEWS

DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


def best(values, targets, n, least):
    out = set()
    for t in targets:
        found = []
        for f in set(values) - {t}:
            both = sorted(set(values[t]) & set(values[f]))
            x, y = ([values[k][b] for b in both] for k in (t, f))
            mx, my = (sum(v) / max(1, len(v)) for v in (x, y))
            vx, vy = sum((v - mx) ** 2 for v in x), sum((v - my) ** 2 for v in y)
            if vx and vy and (c := sum((a - mx) * (b - my) for a, b in zip(x, y, strict=True)) / math.sqrt(vx * vy)) >= least:
                found.append((-round(c, 9), f))
        out |= {(t, f, -c) for c, f in sorted(found)[:n]}
    return out


@needs_tables
def test_every_hundredth_feature_is_a_target(spark):
    got = {(r.target, r.rank): r.cor for r in catalog.QUERIES["correlated_features"](spark, DIR).collect()}
    values = defaultdict(dict)
    for f, sample, _, v in duckdb.sql(VIEWS["reps"].replace("lineitem ", f"'{DIR}/lineitem.parquet' ")).fetchall():
        values[f][sample] = float(v)
    want = best(values, [f for f in values if f % 100 == 0], 5, 0.5)
    assert want and {t for t, _ in got} == {t for t, _, _ in want}
    for t in {t for t, _ in got}:
        assert sorted(round(c, 6) for (x, _), c in got.items() if x == t) == sorted(round(c, 6) for x, _, c in want if x == t)


def test_blocks_of_targets_and_constant_values(spark):
    rows = [(f, f"s{s}", float((f * 7 + s * s * (f % 5 + 1)) % 11) if f else 3.0) for f in range(12) for s in range(6)]
    values = defaultdict(dict)
    for f, s, v in rows:
        values[f][s] = v
    long = spark.createDataFrame(rows, "feature long, sample string, value double")
    got = matrix.correlated_features(long, spark.createDataFrame([(f,) for f in range(6)], "feature long"), 20, 0.1, block=7).collect()
    assert {(r.target, r.feature, round(r.cor, 6)) for r in got} == {(t, f, round(c, 6)) for t, f, c in best(values, range(6), 20, 0.1)}


@needs_tables
def test_em_abundance_runs_to_its_tolerance(spark):
    reads = defaultdict(set)
    for r, t in duckdb.sql(f"SELECT l_orderkey, l_suppkey FROM '{DIR}/lineitem.parquet'").fetchall():
        reads[r].add(t)
    eff = {t: max(n * 100 - 200 + 1, 10) for t, n in duckdb.sql(f"SELECT s_suppkey, length(s_name) FROM '{DIR}/supplier.parquet'").fetchall()}
    sets, theta = Counter(map(frozenset, reads.values())), Counter()
    for c, n in sets.items():
        for t in c:
            theta[t] += n / len(c) / len(reads)
    last = None
    for _ in range(1000):
        z = {c: sum(theta[t] / eff[t] for t in c) for c in sets}
        now = sum(n * math.log(z[c]) for c, n in sets.items())
        if last is not None and abs(now - last) < 0.01:
            break
        last, new = now, Counter()
        for c, n in sets.items():
            for t in c:
                new[t] += n * theta[t] / eff[t] / z[c] / len(reads)
        theta = new
    got = {r.transcript: r["count"] for r in catalog.QUERIES["em_abundance"](spark, DIR).collect()}
    assert got == pytest.approx({t: x * len(reads) for t, x in theta.items()}, abs=0.002)


def test_abundance_says_that_it_did_not_settle(spark):
    hits = spark.createDataFrame([("r1", "a"), ("r1", "b"), ("r2", "a")], "read string, transcript string")
    lengths = spark.createDataFrame([("a", 900), ("b", 500)], "transcript string, length long")
    with pytest.warns(RuntimeWarning, match="did not settle in 1 rounds"):
        genes.abundance(hits, lengths, rounds=1).collect()


@pytest.mark.parametrize("scale, shift", [(1.0, 0.0), (0.1, 1e6), (1e-4, 0.3)])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_blocks_of_features_are_whole(spark, kind, scale, shift):
    """Missing cells, more features than a block, names of both kinds, values whose squares cancel."""
    name = (lambda f: f) if kind == "long" else (lambda f: f"g{f:03d}")
    rows = [(name(f), f"s{s}", ((f * f * 7 + s * s * (f % 13 + 1)) % 29) * scale + shift) for f in range(150) for s in range(9) if (f + 2 * s) % 5]
    rows += [(name(200), f"s{s}", 0.1) for s in range(9)] + [(name(201), "s1", None), (name(201), "s2", float("nan")), (None, "s1", 1.0)]
    values = defaultdict(dict)
    for f, s, v in rows:
        if f is not None and v is not None and v == v:
            values[f][s] = (v - shift) / scale if f != name(200) else 1.0
    long = spark.createDataFrame(rows, f"feature {kind}, sample string, value double")
    got = matrix.correlated_features(long, spark.createDataFrame([(name(f),) for f in (0, 7, 40, 140, 200)], f"feature {kind}"), 4, 0.2, block=90).collect()
    want = best(values, [name(f) for f in (0, 7, 40, 140, 200)], 4, 0.2)
    assert {(r.target, round(r.cor, 6)) for r in got} == {(t, round(c, 6)) for t, _, c in want}
    assert len(got) == len(want) and (scale < 1 or {(r.target, r.feature) for r in got} == {(t, f) for t, f, _ in want})


def test_no_pair_of_features_is_a_row(spark):
    long = spark.range(40).selectExpr("id % 20 AS feature", "concat('s', id div 20) AS sample", "CAST(id * id % 7 AS double) AS value")
    plan = matrix.correlated_features(long, long.select("feature").distinct())._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (sample" not in plan
