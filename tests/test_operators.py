"""Operators on literals that can be worked out by hand, and those that SQL can't express against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from seqloom.functions import alignments as A
from seqloom.functions import seq as S
from seqloom.functions import stats
from seqloom.operators import genes, graphs, hits, intervals, kmers, matrix, reports, tables
from seqloom.sources import formats
from seqloom.streaming import events


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


# Functions
def test_sequence_functions(spark):
    assert one(spark, S.reverse_complement(F.lit("AACGTN"))) == "NACGTT"
    assert one(spark, S.kmers(F.lit("ACGTAC"), 3)) == ["ACG", "CGT", "GTA", "TAC"]
    assert one(spark, S.kmers(F.lit("AC"), 3)) == []
    assert one(spark, S.translated(F.lit("ATGTAAACGNN"), 1)) == "M*T"
    assert one(spark, S.translated(F.lit("ATGTGA"), 1, "Euplotid")) == "MC"
    assert one(spark, S.translated(F.lit("TTACAT"), 4)) == "M*"
    assert one(spark, S.translated(F.lit("ACGNAC"), 1)) == "TX"
    assert one(spark, S.best_protein(F.lit("ATGAAATTT"))) == "MKF"
    assert one(spark, S.wrapped(F.lit("A" * 12), 6)) == "A" * 6 + "\n" + "A" * 6
    assert one(spark, S.gene_of_transcript(F.lit("TR1|c0_g2_i3"))) == "TR1|c0_g2"
    assert one(spark, S.gene_of_transcript(F.lit("comp5_c1_seq2"))) == "comp5_c1"
    assert one(spark, S.seed_entropy(F.lit("ACGT"))) == 2.0


def test_cigar_of_the_worked_example(spark):
    b = one(spark, A.aligned_blocks(F.lit(100), F.lit("10M5N3M"), F.lit(False)))
    assert [tuple(x) for x in b.genome] == [(100, 109), (115, 117)] and [tuple(x) for x in b.query] == [(1, 10), (11, 13)]
    assert one(spark, A.flag_names(F.lit(0x1 | 0x10 | 0x400))) == ["paired", "reverse", "duplicate"]
    assert one(spark, A.with_flag(F.lit(3), "paired", False)) == 2
    assert [one(spark, A.transcribed_strand(F.lit(f), "FR")) for f in (0x41, 0x51, 0x81, 0x91)] == ["+", "-", "-", "+"]
    assert one(spark, A.overlap_length(F.lit(1), F.lit(5), F.lit(5), F.lit(8))) == 1


def test_compatible_alignments(spark):
    block = lambda *p: F.array(*[F.struct(F.lit(a).alias("lend"), F.lit(b).alias("rend")) for a, b in p])
    assert one(spark, A.compatible(block((1, 10), (21, 30)), block((5, 10), (21, 40))))
    assert not one(spark, A.compatible(block((1, 10), (21, 30)), block((5, 12), (21, 40))))


def test_special_functions():
    assert stats.binomial_tail(2, 3, 0.5) == pytest.approx(0.5)
    assert stats.hypergeometric_tail(1, 1, 3, 10) == pytest.approx(0.3)
    assert stats.incomplete_beta(2, 3, 0.4) == pytest.approx(0.5248)
    assert stats.f_test_p(4.0, 1, 10) == pytest.approx(stats.t_test_p(2.0, 10), rel=1e-9) == pytest.approx(0.0733880, rel=1e-5)
    assert stats.chi_square_quantile(0.95, 2) == pytest.approx(5.99146, rel=1e-5)
    assert stats.poisson_interval(0) == (0.0, pytest.approx(3.68888, rel=1e-5))
    assert stats.adjusted(np.array([0.01, 0.04, 0.03]), "holm").tolist() == pytest.approx([0.03, 0.06, 0.06])
    assert stats.adjusted(np.array([0.01, 0.04, 0.03, np.nan]), "bh")[:3].tolist() == pytest.approx([0.03, 0.04, 0.04])


def test_adjusted_column_is_the_numpy_one(spark):
    rng = random.Random(0)
    p = [round(rng.random(), 2) for _ in range(60)] + [None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(p)], "i int, p double")
    for method in ("holm", "bh"):
        got = {r.i: r.q for r in stats.adjusted_column(df, "p", "q", method).collect()}
        want = stats.adjusted(np.array([np.nan if x is None else x for x in p]), method)
        assert all(got[i] is None if math.isnan(w) else got[i] == pytest.approx(w) for i, w in enumerate(want))


# Formats
def test_readers(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    fa = formats.read_fasta(spark, put("a.fa", ">x one\nAC\nGT\n>y\n\nTT T\n")).collect()
    assert sorted(map(tuple, fa)) == [("x", "x one", "ACGT"), ("y", "y", "TTT")]
    fq = formats.read_fastq(spark, put("a.fq", "@r1/1\nACG\n+\nIII\n@r2 2:N:0\nAC\n+\nII\n@bad\nACG\n+\nI\n")).orderBy("ord").collect()
    assert [(r.read_name, r.pair_dir, r.sequence) for r in fq] == [("r1/1", 1, "ACG"), ("r2/2", 2, "AC")]
    sam = formats.read_sam(spark, put("a.sam", "@HD\tVN:1\nr\t89\tc\t5\t40\t3M\t*\t0\t0\tACG\tIII\tNH:i:1\tXS:A:+\n")).first()
    assert (sam.flag, sam.pos, sam.cigar, sam.tags) == (89, 5, "3M", ["NH:i:1", "XS:A:+"])
    psl = formats.psl_blocks(formats.read_psl(spark, put("a.psl", "10\t0\t0\t0\t0\t0\t0\t0\t-\tq\t12\t1\t11\tt\t50\t4\t14\t1\t10,\t1,\t4,\n"))).first()
    assert [tuple(b) for b in psl.t_blocks] == [(5, 14)] and [tuple(b) for b in psl.q_blocks] == [(11, 2)]
    assert formats.read_vcf(spark, put("a.vcf", "#x\nc\t7\t.\tA\tG\t1\tPASS\tDP=4;DB;AF=0.5\n")).first().info == {"DP": "4", "DB": "true", "AF": "0.5"}
    bed = formats.read_bed(spark, put("a.bed", "track x\nc\t10\t30\tn\t0\t+\t10\t30\t0\t2\t5,6,\t0,14,\n")).first()
    assert [tuple(b) for b in bed.blocks] == [(11, 15), (25, 30)]
    wig = formats.read_wig(spark, put("a.wig", "track\nvariableStep chrom=c1\n2 5\n4 7\nvariableStep chrom=c2\n1 9\n"))
    assert sorted(map(tuple, formats.filled_wig(wig).collect())) == [("c1", 1, 0.0), ("c1", 2, 5.0), ("c1", 3, 0.0), ("c1", 4, 7.0), ("c2", 1, 9.0)]
    gff = formats.read_gff3(spark, put("a.gff3", "##x\nc\ts\tmRNA\t1\t9\t.\t+\t.\tID=m1;Parent=g%201\nc\ts\texon\t1\t3\t.\t+\t.\tParent=m1,m2\nc\ts\texon\t6\t9\t.\t+\t.\tParent=m1\n"))
    g = formats.gff3_transcripts(gff).first()
    assert (g.gene, g.transcript, [tuple(e) for e in g.exons]) == ("g 1", "m1", [(1, 3), (6, 9)])
    gtf = formats.read_gtf(spark, put("a.gtf", 'c\ts\texon\t1\t5\t.\t+\t.\tgene_id "g"; transcript_id "t"; tag "a"; tag "b";\nc\ts\tCDS\t4\t8\t.\t+\t0\tgene_id "g"; transcript_id "t";\n'))
    t = formats.gtf_transcripts(gtf).first()
    assert [tuple(e) for e in t.exons] == [(1, 8)] and [tuple(e) for e in t.cds] == [(4, 8)]
    m = formats.read_matrix(spark, put("m.txt", "S1\tS2\ng1\t1\t2\n"))
    assert sorted(map(tuple, m.collect())) == [("g1", "S1", 1.0), ("g1", "S2", 2.0)]
    s = formats.read_samples(spark, put("s.txt", "# c\ncondA repA1 l.fq r.fq\ncondB\trepB1\tl.fq\n")).collect()
    assert [tuple(r) for r in s] == [("condA", "repA1", "l.fq", "r.fq"), ("condB", "repB1", "l.fq", None)]
    q = formats.read_quant(spark, {"a": put("q.sf", "Name\tLength\tEffectiveLength\tTPM\tNumReads\nt1\t10\t9\t3.5\t7\n")}, "salmon").first()
    assert tuple(q) == ("t1", "a", 7.0, 3.5)


# Intervals
def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_merging_shares_a_base_but_not_neighbours(spark):
    f = frame(spark, [("c", 1, 5), ("c", 5, 8), ("c", 9, 12)], "scaffold string, lend long, rend long")
    assert sorted((r.lend, r.rend) for r in intervals.merged(f).collect()) == [(1, 8), (9, 12)]


def test_depth_windows_and_clips(spark):
    rng = random.Random(1)
    f = [("c", a := rng.randint(1, 60), a + rng.randint(0, 40)) for _ in range(40)]
    df = frame(spark, f, "scaffold string, lend long, rend long")
    depth = {r.pos: r.depth for r in intervals.depth_positions(intervals.depth_runs(df)).collect()}
    assert depth == {p: n for p in range(1, 120) if (n := sum(a <= p <= b for _, a, b in f))}
    for r in intervals.jaccard_windows(df, 10).collect():
        both = sum(a <= r.pos and b >= r.pos + 9 for _, a, b in f)
        edges = sum(a <= r.pos <= b for _, a, b in f) + sum(a <= r.pos + 9 <= b for _, a, b in f)
        assert (r.both, r.single) == (both, edges - 2 * both)
    values = [(1.0 if abs(p - 100) > 20 else 0.01) for p in range(1, 201)]
    wig = frame(spark, [("c", p, v) for p, v in enumerate(values, 1)], "scaffold string, pos long, jaccard double")
    assert [r.pos for r in intervals.troughs(wig, 60, 0.05, 0.35).collect()] == [91]
    cov = frame(spark, [("c", p, abs(p - 85)) for p in range(1, 201)], "scaffold string, pos long, depth int")
    assert intervals.moved_to_lowest(intervals.troughs(wig, 60, 0.05, 0.35), cov, 20).first().pos == 85


def test_coverage_cap_and_mates(spark):
    rows = [("c", f"r{i}", i // 10, i // 10 + 50) for i in range(60)] + [("d", "r0", 1, 5)]
    df = frame(spark, rows, "scaffold string, name string, lend long, rend long").repartition(3)
    kept = intervals.capped_coverage(df, 4).collect()
    assert len([r for r in kept if r.scaffold == "c"]) == 4 and any(r.scaffold == "d" for r in kept)


# Graphs
def test_components_of_chains_and_rings(spark):
    e = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1002), (1002, 1000), (5000, 5000)]
    got = {r.node: r.component for r in graphs.components(frame(spark, e, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(301)) and {got[1000], got[1001], got[1002]} == {1000} and got[5000] == 5000
    assert graphs.components(frame(spark, [], "a long, b long")).count() == 0


def test_link_strength_of_the_worked_example(spark):
    e = [(1, 2), (1, 3), (1, 4), (2, 3), (2, 5)]
    got = {(r.a, r.b): r.strength for r in graphs.link_strength(frame(spark, e, "a int, b int")).collect()}
    assert got[1, 2] == pytest.approx(0.6)


def test_unitigs_and_contigs(spark):
    df = frame(spark, [("a", "ACGTTGCA"), ("b", "ACGTTGGG"), ("r", "TATATA")], "accession string, sequence string")
    u = {r.sequence: r.kmers for r in kmers.unitigs(kmers.edges(df, 3), 3).collect()}
    assert {"ACGTTG": 4, "TGCA": 2, "TGGG": 2, "ATAT": 2}.items() <= u.items()
    c = kmers.greedy_contigs(df, 3, 1, 3).collect()
    assert any("ACGTTG" in r.sequence for r in c) and sum(r.kmers for r in c) == kmers.counts(df, 3, False).count()


def test_capped_clusters_and_paths(spark):
    e = [(1, 2, 9), (2, 3, 8), (3, 4, 7), (4, 5, 6)]
    got = {}
    for r in graphs.capped_clusters(frame(spark, e, "a long, b long, weight long"), 3).collect():
        got.setdefault(r.cluster, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == [[1, 2, 3], [4, 5]]
    p = graphs.best_supported_paths(frame(spark, [("a", "b", 5), ("b", "d", 5), ("a", "c", 1), ("c", "d", 1), ("d", "a", 0)], "src string, dst string, weight long")).orderBy("rank").collect()
    assert p[0].path == ["a", "b", "d"] and p[0].support == 10
    n = [r["index"] for r in graphs.numbered(frame(spark, [(x,) for x in range(50)], "x int").repartition(4), "x").orderBy("x").collect()]
    assert n == list(range(50))


# Genes
def test_open_reading_frames(spark):
    s = "CC" + "ATG" + "AAA" * 12 + "TAA" + "GG"
    best = genes.orfs_of(s, 5, partial=False)[0]
    assert best[:4] == (3, 44, "+", 3) and best[4] == "M" + "K" * 12 + "*" and best[5] == "complete"
    rc = s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    assert genes.orfs_of(rc, 5, partial=False)[0][:3] == (len(s) - 43, len(s) - 2, "-")
    df = frame(spark, [("x", s), ("n", None)], "accession string, sequence string")
    assert genes.open_reading_frames(df, 5, longest_only=True, partial=False).count() == 1


def test_supertranscripts_keep_every_transcript(spark):
    text = {1: "AAAA", 2: "CC", 3: "GGGG", 4: "TTT"}
    rows = [("g", t, i, n, text[n]) for t, p in {"t1": [1, 2, 3], "t2": [1, 3, 4], "t3": [1, 2, 3]}.items() for i, n in enumerate(p)]
    r = genes.supertranscripts(frame(spark, rows, "gene string, transcript string, ord int, node int, sequence string"), refine=False).first()
    assert r.sequence == "AAAACCGGGGTTT" and [list(b.transcripts) for b in r.blocks] == [["t1", "t2"], ["t1"], ["t1", "t2"], ["t2"]]
    with pytest.raises(ValueError):
        genes.topological([(1, 2), (2, 1)], [1, 2])
    columns = genes.align_paths({"a": [1, 2, 1, 3], "b": [1, 2, 3]})
    assert [c.get("a") for c in columns if "a" in c] == [1, 2, 1, 3] and [c.get("b") for c in columns if "b" in c] == [1, 2, 3]


def test_abundance_splits_shared_reads(spark):
    h = [(i, "t1") for i in range(30)] + [(100 + i, t) for i in range(40) for t in ("t1", "t2")] + [(200 + i, "t2") for i in range(10)]
    got = {r.transcript: r["count"] for r in genes.abundance(frame(spark, h, "read long, transcript string"), frame(spark, [("t1", 1000), ("t2", 1000)], "transcript string, length int"), tolerance=1e-6).collect()}
    assert sum(got.values()) == pytest.approx(80) and got["t1"] == pytest.approx(60, rel=0.01)


def test_assembly_and_trimming(spark):
    rows = [("l", "a", [(1, 10), (21, 30)]), ("l", "b", [(5, 10), (21, 40)]), ("l", "c", [(5, 12), (21, 40)])]
    got = genes.assembled_alignments(frame(spark, rows, "locus string, name string, blocks array<struct<lend:int,rend:int>>")).orderBy("assembly").collect()
    assert [r.members for r in got] == [["a", "b"], ["c"]] and [tuple(b) for b in got[0].blocks] == [(1, 10), (21, 40)]
    reads = frame(spark, [("r", "A" * 40, "!" * 2 + "I" * 30 + "!" * 8), ("s", "A" * 20, "I" * 20)], "read_name string, sequence string, quals string")
    t = genes.trimmed(reads).collect()
    assert [(r.read_name, len(r.sequence)) for r in t] == [("r", 30)]


# Matrices
def test_technical_replicates_of_the_worked_example(spark):
    s, c = [456, 726, 380, 554, 184], [9, 7, 3, 9, 7]
    long = frame(spark, [("g", f"{x}{i}", float(v)) for x, vs in (("S", s), ("C", c)) for i, v in enumerate(vs, 1)], "feature string, sample string, value double")
    samples = frame(spark, [(f"{x}{i}", x) for x in "SC" for i in range(1, 6)], "replicate string, sample string")
    assert {r["sample"]: r.value for r in matrix.combined_replicates(long, samples).collect()} == {"S": 2300.0, "C": 35.0}


def test_models(spark):
    rng = np.random.default_rng(3)
    rows, groups = [], [(f"{g}{i}", g) for g in "AB" for i in range(4)]
    for f in range(60):
        for s, g in groups:
            rows.append((f"f{f:02d}", s, float(rng.poisson(80 * (4 if f < 5 and g == "B" else 1)))))
    long, gr = frame(spark, rows, "feature string, sample string, value double"), frame(spark, groups, "sample string, grp string")
    for test, p in ((matrix.negative_binomial_test, "fdr"), (matrix.voom_test, "adjusted")):
        sig = {r.feature for r in test(long, gr, "A", "B").collect() if r[p] < 0.01}
        assert {f"f{f:02d}" for f in range(5)} <= sig and len(sig) <= 8
    reps = gr.toDF("replicate", "sample")
    found = {r.feature for r in matrix.anova(long, reps).collect() if r.adjusted < 0.01}
    assert {f"f{f:02d}" for f in range(5)} <= found
    pcs = matrix.principal_components(long, 2).collect()
    m = np.array([[v for f2, _, v in rows if f2 == f"f{f:02d}"] for f in range(60)])
    want = np.linalg.svd(m, full_matrices=False)[1] ** 2
    assert pcs[0].variance_share == pytest.approx(want[0] / want.sum())
    down = matrix.downsampled(long, 500).groupBy("sample").agg(F.sum("value").alias("n")).collect()
    assert {r.n for r in down} == {500.0} and len(down) == 8
    over = matrix.enrichment(frame(spark, [(f"f{f:02d}", "up" if f < 6 else "rest") for f in range(60)], "feature string, term string"), frame(spark, [(f"f{f:02d}",) for f in range(5)], "feature string"))
    assert {r.term: r.over_fdr < 0.001 for r in over.collect()} == {"up": True, "rest": False}
    batch = frame(spark, [(s, g, i % 2) for i, (s, g) in enumerate(groups)], "sample string, grp string, batch int")
    assert matrix.without_batch_effects(long, batch.select("sample", "batch"), gr).count() == len(rows)


def test_trees(spark):
    d = frame(spark, [("a", "b", 1.0), ("a", "c", 4.0), ("b", "c", 3.0), ("a", "d", 9.0), ("b", "d", 9.0), ("c", "d", 8.0)], "a string, b string, distance double")
    merges = matrix.hierarchy(d, "complete")
    assert [m[2] for m in merges] == [1.0, 4.0, 9.0] and matrix.cut_tree(merges, k=2) == [1, 1, 1, 2]
    assert matrix.newick(merges, list("abcd")).endswith(";") and matrix.cut_tree(merges, height_share=0.2) == [1, 1, 2, 3]


# Others
def test_n50_of_the_worked_example(spark):
    assert {r.x: r.nx for r in tables.nx(frame(spark, [(x,) for x in (5, 4, 3, 2, 1)], "length int")).collect()}[50] == 4


def test_tiers_and_intron_classes(spark):
    a = frame(spark, [("g", "q1", 1, 100, 9.0, 99.5), ("g", "q2", 50, 150, 8.0, 99.5), ("g", "q3", 101, 200, 7.0, 99.5)], "gene string, query string, lend int, rend int, score double, identity double")
    assert {r.query: r.tier for r in hits.tiers(a).collect()} == {"q1": 1, "q2": 2, "q3": 1}
    ref = frame(spark, [("r1", ["i1", "i2", "i3"]), ("r2", ["i4"])], "transcript string, introns array<string>")
    new = frame(spark, [("a", ["i1", "i2", "i3"]), ("b", ["i2", "i3"]), ("c", ["i1", "i4"]), ("d", ["i1", "x"])], "transcript string, introns array<string>")
    assert {r.transcript: r["class"] for r in reports.intron_classes(new, ref).collect()} == {"a": "REF", "b": "SUBREF", "c": "REFCOMBO", "d": "NOVEL"}


def test_samples_are_exact_and_repeatable(spark):
    df = frame(spark, [(i,) for i in range(500)], "id long")
    a, b = ({r.id for r in tables.random_rows(x, 50, "id", seed=3).collect()} for x in (df, df.repartition(7)))
    assert a == b and len(a) == 50
    m = tables.mutated(frame(spark, [("x", "ACGT" * 50)], "accession string, sequence string"), 0.1).first().sequence
    assert len(m) == 200 and sum(x != y for x, y in zip(m, "ACGT" * 50, strict=True)) == 20


def test_streams_agree_with_batches(spark, tmp_path):
    rows = [(u, f"2024-01-01 00:{m:02d}:00", 1.0) for u in (1, 2) for m in (0, 5, 40, 41)]
    df = frame(spark, rows, "user long, t string, value double").withColumn("ts", F.to_timestamp("t")).drop("t")
    df.repartition(3).write.parquet(str(tmp_path / "e.parquet"))
    stream = lambda: events.read_stream(spark, str(tmp_path / "e.parquet"), 1)
    s = events.run_to_end(events.sessions(stream(), "user", "20 minutes", late="1 day"), "append_rest").collect()
    assert sorted((r.user, r.n) for r in s) == [(1, 2), (1, 2), (2, 2), (2, 2)]
    c = events.run_to_end(events.capped(stream(), "user", 3)).groupBy("user").count().collect()
    assert {(r.user, r["count"]) for r in c} == {(1, 3), (2, 3)}
