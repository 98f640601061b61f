"""splice_sites over all intervals and all four kinds, against plain loops."""

import os

import duckdb
import pytest
from seqloom import catalog
from seqloom.operators import intervals
from seqloom.plans.bindings import VIEWS

DIR = "/root/testdata/sf0.001"


def events(introns, exons):
    out = set()
    for g, a, b in introns:
        for h, c, d in introns:
            if g == h and b == d and a < c:
                out.add((g, "alt_donor", a, c))
            if g == h and a == c and b < d:
                out.add((g, "alt_acceptor", b, d))
        for h, c, d in exons:
            if g == h and c < a and d > b:
                out.add((g, "retained_intron", a, b))
            if g == h and c > a and d < b:
                out.add((g, "skipped_exon", c, d))
    return out


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")
def test_splice_sites_of_all_intervals(spark):
    rows = set(duckdb.sql(f"SELECT scaffold, lend, rend FROM ({VIEWS['frags'].replace('lineitem', repr(DIR + '/lineitem.parquet'))})").fetchall())
    want = events(rows, rows)
    got = catalog.QUERIES["splice_sites"](spark, DIR).collect()
    assert {k for _, k, _, _ in want} == {"alt_donor", "alt_acceptor", "retained_intron", "skipped_exon"}
    assert len(got) == len(want) and {(r.gene, r.kind, r.lend, r.rend) for r in got} == want


def test_splice_events_of_separate_tables(spark):
    introns, exons = [("g", 10, 50), ("g", 20, 50), ("g", 10, 40), ("h", 1, 9)], [("g", 5, 60), ("g", 15, 45), ("g", 10, 50), ("h", 1, 9), ("h", 3, 4)]
    i, e = (spark.createDataFrame([(g, "t", "+", a, b) for g, a, b in x], "gene string, transcript string, strand string, lend long, rend long") for x in (introns, exons))
    assert {tuple(r) for r in intervals.splice_events(i, e).collect()} == events(introns, exons)
