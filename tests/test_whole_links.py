"""The part graph's queries over all pairs, and capped clusters in rounds, against plain versions."""

import os

import duckdb
import pytest
from seqloom import catalog
from seqloom.operators import graphs

DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


def capped(edges, most):
    parent, size = {}, {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b, _ in sorted(edges, key=lambda e: (-e[2], e[0], e[1])):
        x, y = sorted((root(a), root(b)))
        if x != y and size.get(x, 1) + size.get(y, 1) <= most:
            parent[y] = x
            size[x] = size.get(x, 1) + size.get(y, 1)
    return {n: root(n) for n in parent}


@pytest.fixture(scope="module")
def pairs():
    """All pairs of parts that stand first and second in an order."""
    return duckdb.sql(f"SELECT x.l_partkey, y.l_partkey FROM '{DIR}/lineitem.parquet' x JOIN '{DIR}/lineitem.parquet' y USING (l_orderkey) WHERE x.l_linenumber = 1 AND y.l_linenumber = 2 AND x.l_partkey <> y.l_partkey").fetchall()


@needs_tables
def test_part_graph_queries_take_all_pairs(spark, pairs):
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    least = {}
    for n in sorted(near):
        todo = [] if n in least else [n]
        while todo:
            x = todo.pop()
            if x not in least:
                least[x] = n
                todo += near[x]
    run = lambda name: catalog.QUERIES[name](spark, DIR).collect()
    assert {r.node: r.component for r in run("single_linkage")} == least
    strength = {(a, b): (c := len(near[a] & near[b]), round((c + 2) / (len(near[a]) + len(near[b]) - c), 6)) for a in near for b in near[a] if a < b}
    assert {(r.a, r.b): (r.common, r.strength) for r in run("link_jaccard")} == strength
    one = set(pairs)
    assert {r.node: (r.n_in, r.n_out) for r in run("node_degrees")} == {n: (sum(b == n for _, b in one), sum(a == n for a, _ in one)) for n in near}
    best = {}
    for a, b in one:
        key = min(a, b), max(a, b)
        best[key] = max(best.get(key, 0), pairs.count((a, b)))
    assert {(r.a, r.b): r.n for r in run("best_links")} == best
    assert {r.node: r.cluster for r in run("capped_clusters")} == capped([(a, b, pairs.count((a, b))) for a, b in one], 25)


def test_capped_clusters_in_rounds(spark):
    import random

    pick = random.Random(3)
    for most, nodes, n in ((4, 60, 150), (25, 80, 90)):
        e = [(a, b, w) for (a, b), w in {(pick.randrange(nodes), pick.randrange(nodes)): pick.randrange(3) for _ in range(n)}.items()]
        got = graphs.capped_clusters(spark.createDataFrame(e, "a long, b long, weight long"), most, last=10).collect()
        assert {r.node: r.cluster for r in got} == capped(e, most)
