"""The library's operators bound to whole tables, each with the SQL that gives the same rows where SQL can say it.

Views: a document's sequence is its letters A, C, G and T; the expression matrix has parts as features, return flags as
samples (line numbers as replicates) and quantities as values; a part's brand is its gene; intervals are a supplier's
shipments, from the day of shipping for as many days as the quantity; hits are orders' lines by price.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import alignments as A
from ..functions import seq as S
from ..operators import genes, graphs, hits, intervals, kmers, matrix, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
SAMPLES = ["A", "N", "R"]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, with its SQL and the views that it uses."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            used: list[str] = []
            for name in reversed(VIEWS):  # a view uses earlier ones only
                if any(re.search(rf"\b{name}\b", text) for text in (sql, *(VIEWS[u] for u in used))):
                    used.insert(0, name)
            views = ", ".join(f"{n} AS ({VIEWS[n]})" for n in used)
            ORACLE_SQL[f.__name__] = f"WITH {views}\n{sql}" if used else sql
        return f

    return add


# The same views in SQL.
VIEWS = {
    "seqs": "SELECT doc_id AS accession, source AS gene, regexp_replace(upper(coalesce(text, '')), '[^ACGT]', '', 'g') AS sequence FROM documents",
    "cells": "SELECT l_partkey AS feature, l_returnflag AS sample, sum(l_quantity) AS value FROM lineitem GROUP BY ALL",
    "reps": "SELECT l_partkey AS feature, l_returnflag || l_linenumber AS replicate, l_returnflag AS sample, sum(l_quantity) AS value FROM lineitem GROUP BY ALL",
    "genemap": "SELECT p_partkey AS feature, p_brand AS gene, p_size AS length FROM part",
    "frags": "SELECT l_suppkey AS scaffold, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS lend, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) + CAST(l_quantity AS BIGINT) AS rend, l_orderkey AS okey, l_linenumber AS line FROM lineitem",
    "hitrows": "SELECT l_orderkey AS query, l_partkey AS target, l_extendedprice AS score, CAST(l_linenumber AS BIGINT) AS t_start, CAST(l_linenumber + l_quantity AS BIGINT) AS t_end, p_size + 60 AS t_length FROM lineitem JOIN part ON p_partkey = l_partkey",
    "rates": "SELECT feature, 1.0 * coalesce(max(value) FILTER (sample = 'A'), 0) AS va, 1.0 * coalesce(max(value) FILTER (sample = 'N'), 0) AS vn, 1.0 * coalesce(max(value) FILTER (sample = 'R'), 0) AS vr FROM cells GROUP BY feature",
    "depthruns": "SELECT scaffold, lend, rend, depth FROM (SELECT scaffold, pos AS lend, lead(pos) OVER w - 1 AS rend, sum(d) OVER w AS depth FROM (SELECT scaffold, pos, sum(d) AS d FROM (SELECT scaffold, lend AS pos, 1 AS d FROM frags UNION ALL SELECT scaffold, rend + 1, -1 FROM frags) GROUP BY ALL HAVING sum(d) <> 0) WINDOW w AS (PARTITION BY scaffold ORDER BY pos)) WHERE depth > 0",
    "exrun": "SELECT feature, length, CAST(floor(sum(expr) OVER (ORDER BY expr DESC, length DESC) * 100 / sum(expr) OVER ()) AS INTEGER) AS pct FROM (SELECT feature, length, sum(value) AS expr FROM cells JOIN genemap USING (feature) GROUP BY ALL)",
    "changes": "SELECT feature, log2((va + 1) / (vr + 1)) AS log_fc, pow(10, -abs(va - vr) / 20) AS fdr FROM rates",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seqs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select(F.col("doc_id").alias("accession"), F.col("source").alias("gene"), F.regexp_replace(F.upper(F.coalesce("text", F.lit(""))), "[^ACGT]+", "").alias("sequence"))


def cells(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("feature"), F.col("l_returnflag").alias("sample")).agg(F.sum("l_quantity").alias("value"))


def reps(spark: SparkSession, d: str) -> DataFrame:
    """Long matrix of replicates as samples."""
    return read(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("feature"), F.concat("l_returnflag", "l_linenumber").alias("sample")).agg(F.sum("l_quantity").alias("value"))


def rep_map(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linenumber").alias("replicate"), F.col("l_returnflag").alias("sample")).distinct()


def genemap(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select(F.col("p_partkey").alias("feature"), F.col("p_brand").alias("gene"), F.col("p_size").alias("length"))


def frags(spark: SparkSession, d: str) -> DataFrame:
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01").cast("date")).cast("long")
    return read(spark, d, "lineitem").select(F.col("l_suppkey").alias("scaffold"), day.alias("lend"), (day + F.col("l_quantity").cast("long")).alias("rend"), F.col("l_orderkey").alias("okey"), F.col("l_linenumber").alias("line"))


def hit_rows(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").select("p_partkey", "p_size")
    return read(spark, d, "lineitem").join(p, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("query"), F.col("l_partkey").alias("target"), F.col("l_extendedprice").alias("score"), F.col("l_linenumber").cast("long").alias("t_start"), (F.col("l_linenumber") + F.col("l_quantity")).cast("long").alias("t_end"), (F.col("p_size") + 60).alias("t_length"))


def wide_rates(spark: SparkSession, d: str) -> DataFrame:
    w = matrix.to_wide(cells(spark, d), SAMPLES, 0.0)
    return w.select("feature", F.col("A").alias("va"), F.col("N").alias("vn"), F.col("R").alias("vr"))


def changes(spark: SparkSession, d: str) -> DataFrame:
    """Made-up differential rows of sample A against R."""
    return wide_rates(spark, d).select("feature", F.lit("A").alias("a"), F.lit("R").alias("b"), F.log2((F.col("va") + 1) / (F.col("vr") + 1)).alias("log_fc"), F.pow(F.lit(10.0), -F.abs(F.col("va") - F.col("vr")) / 20).alias("fdr"))


# Sequences -------------------------------------------------------------------------------------------------------
@query("SELECT accession, reverse(translate(sequence, 'ACGT', 'TGCA')) AS revcomp FROM seqs")
def revcomp(s: SparkSession, d: str) -> DataFrame:
    return seqs(s, d).select("accession", S.reverse_complement(F.col("sequence")).alias("revcomp"))


@query("SELECT accession, CAST(length(sequence) AS INTEGER) AS length, round(100.0 * length(regexp_replace(sequence, '[AT]', '', 'g')) / nullif(length(sequence), 0), 2) AS gc FROM seqs")
def gc_content(s: SparkSession, d: str) -> DataFrame:
    return seqs(s, d).select("accession", F.length("sequence").alias("length"), F.round(S.gc_percent(F.col("sequence")), 2).alias("gc"))


_CODON = "substr('{}', CAST(1 + 16 * (strpos('ACGT', substr(st, i, 1)) - 1) + 4 * (strpos('ACGT', substr(st, i + 1, 1)) - 1) + strpos('ACGT', substr(st, i + 2, 1)) - 1 AS BIGINT), 1)".format(S.STANDARD_CODE)


@query(f"""SELECT accession, frame, md5(coalesce(array_to_string(list_transform(range((frame - 1) % 3 + 1, length(st) - 1, 3), lambda i: {_CODON}), ''), '')) AS protein_md5
FROM (SELECT accession, unnest(range(1, 7)) AS frame, sequence FROM seqs) CROSS JOIN LATERAL (SELECT CASE WHEN frame > 3 THEN reverse(translate(sequence, 'ACGT', 'TGCA')) ELSE sequence END AS st)""")
def translate_frames(s: SparkSession, d: str) -> DataFrame:
    """Six frames; the proteins as digests, since they are as long as the texts."""
    x = seqs(s, d)
    frames = F.array(*[F.struct(F.lit(f).cast("long").alias("frame"), F.md5(S.translated(F.col("sequence"), f)).alias("protein_md5")) for f in range(1, 7)])
    return x.select("accession", F.explode(frames).alias("f")).select("accession", "f.frame", "f.protein_md5")


@query("SELECT min(accession) AS accession, count(*) AS n, array_to_string(list_sort(list(CAST(accession AS VARCHAR))), chr(9)) AS headers FROM seqs GROUP BY sequence")
def seq_dedup(s: SparkSession, d: str) -> DataFrame:
    u = tables.unique_sequences(seqs(s, d))
    return u.select("accession", F.size(F.split("headers", "\t")).cast("long").alias("n"), "headers")


@query("SELECT gene, accession, CAST(length(sequence) AS INTEGER) AS length FROM seqs QUALIFY row_number() OVER (PARTITION BY gene ORDER BY length(sequence) DESC, accession) = 1")
def longest_isoform(s: SparkSession, d: str) -> DataFrame:
    return tables.longest_per_gene(seqs(s, d))


_NX = """(SELECT {k}x, max(length) AS nx FROM (SELECT {k}length, sum(length) OVER (PARTITION BY {p} ORDER BY length DESC ROWS UNBOUNDED PRECEDING) AS run, sum(length) OVER (PARTITION BY {p}) AS total
FROM (SELECT source, n_chars AS length FROM documents)) CROSS JOIN (SELECT CAST(unnest([10, 20, 30, 40, 50]) AS INTEGER) AS x) WHERE run * 100 >= total * x GROUP BY ALL)"""


@query("SELECT * FROM " + _NX.format(k="", p="1"))
def seq_stats_n50(s: SparkSession, d: str) -> DataFrame:
    return tables.nx(read(s, d, "documents").select(F.col("n_chars").alias("length")))


@query("SELECT * FROM " + _NX.format(k="source, ", p="source"))
def gene_n50(s: SparkSession, d: str) -> DataFrame:
    return tables.nx(read(s, d, "documents").select("source", F.col("n_chars").alias("length")), by="source")


@query("""SELECT p AS pct, max(length) AS length, max(features) AS features FROM (
 SELECT p, length, sum(length) OVER (PARTITION BY p ORDER BY length DESC) AS cum, sum(length) OVER (PARTITION BY p) AS bases, count(*) OVER (PARTITION BY p) AS features
 FROM (SELECT DISTINCT pct AS p FROM exrun) JOIN exrun ON exrun.pct <= p) WHERE cum * 100 >= bases * 50 GROUP BY p""")
def exn50(s: SparkSession, d: str) -> DataFrame:
    total = cells(s, d).groupBy("feature").agg(F.sum("value").alias("expr"))
    return tables.expression_nx(total.join(genemap(s, d), "feature").select("feature", "length", "expr"))


# K-mers ----------------------------------------------------------------------------------------------------------
_K = 12
_KMERS = f"SELECT accession, gene, unnest(list_transform(range(1, length(sequence) - {_K - 2}), lambda i: substr(sequence, i, {_K}))) AS kmer FROM seqs WHERE length(sequence) >= {_K}"
_CANON = f"SELECT accession, gene, least(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) AS kmer FROM ({_KMERS})"


@query(f"SELECT kmer, count(*) AS n FROM ({_CANON}) GROUP BY kmer HAVING count(*) >= 2")
def kmer_count(s: SparkSession, d: str) -> DataFrame:
    return kmers.counts(seqs(s, d), _K, least=2)


@query(f"SELECT n, count(*) AS kmers FROM (SELECT kmer, count(*) AS n FROM ({_CANON}) GROUP BY kmer) GROUP BY n")
def kmer_histo(s: SparkSession, d: str) -> DataFrame:
    return kmers.histogram(kmers.counts(seqs(s, d), _K))


_STATS = f"""SELECT accession, count(*) AS kmers, median(n) AS median, avg(n) AS mean, coalesce(stddev_samp(n), 0) AS stdev FROM ({_CANON}) JOIN (SELECT kmer, count(*) AS n FROM ({_CANON}) GROUP BY kmer) USING (kmer) GROUP BY accession"""


@query(f"SELECT accession, kmers, median, round(mean, 6) AS mean, round(stdev, 6) AS stdev FROM ({_STATS})")
def read_kmer_stats(s: SparkSession, d: str) -> DataFrame:
    x = seqs(s, d)
    return kmers.read_stats(x, kmers.counts(x, _K), _K).select("accession", "kmers", "median", F.round("mean", 6).alias("mean"), F.round("stdev", 6).alias("stdev"))


@query(f"""SELECT accession, median FROM ({_STATS}) WHERE mean > 0 AND stdev / mean <= 10000
AND CAST(('0x' || substr(md5(accession || '|12345'), 1, 12)) AS BIGINT) / 281474976710656.0 * median <= 20""")
def read_normalise(s: SparkSession, d: str) -> DataFrame:
    x = seqs(s, d)
    return kmers.normalised(kmers.read_stats(x, kmers.counts(x, _K), _K), max_cov=20).select("accession", "median")


@query(f"""SELECT first_kmer, unnest(gs) AS gene, genes, n FROM (SELECT min(kmer) AS first_kmer, gs, CAST(len(gs) AS BIGINT) AS genes, count(*) AS n FROM (SELECT kmer, list_sort(list(DISTINCT gene)) AS gs FROM ({_CANON}) GROUP BY kmer HAVING count(DISTINCT gene) > 1) GROUP BY gs)""")
def gene_shared_kmers(s: SparkSession, d: str) -> DataFrame:
    x = seqs(s, d)
    return kmers.shared_by_sets(x, x.select("accession", "gene"), _K)


@query("""SELECT a, accession AS b, count(*) AS kmers FROM (SELECT DISTINCT kmer, accession FROM kk) JOIN (SELECT kmer, min(accession) AS a FROM kk GROUP BY kmer) USING (kmer) WHERE a <> accession GROUP BY ALL""".replace("kk", f"({_KMERS.replace(str(_K), '24').replace('10)', '22)')})"))
def kmer_sharing_links(s: SparkSession, d: str) -> DataFrame:
    return kmers.sharing_links(seqs(s, d), 24)


@query(f"""SELECT src, dst, count(*) AS weight FROM (SELECT unnest(list_transform(range(1, length(sequence) - {_K - 1}), lambda i: {{'src': substr(sequence, i, {_K}), 'dst': substr(sequence, i + 1, {_K})}}), recursive := true) FROM seqs WHERE length(sequence) > {_K}) GROUP BY ALL""")
def debruijn_edges(s: SparkSession, d: str) -> DataFrame:
    return kmers.edges(seqs(s, d), _K)


@query()
def longest_orf(s: SparkSession, d: str) -> DataFrame:
    return genes.open_reading_frames(seqs(s, d), 10, longest_only=True)


# Matrices --------------------------------------------------------------------------------------------------------
@query('SELECT feature, max(value) FILTER (sample = \'A\') AS "A", max(value) FILTER (sample = \'N\') AS "N", max(value) FILTER (sample = \'R\') AS "R" FROM cells GROUP BY feature')
def matrix_pivot(s: SparkSession, d: str) -> DataFrame:
    return matrix.to_wide(cells(s, d), SAMPLES)


_RATE = "SELECT feature, sample, gene, value, value / length AS rate FROM cells JOIN genemap USING (feature)"
_TPM = f"SELECT feature, sample, gene, value, rate * 1e6 / sum(rate) OVER (PARTITION BY sample) AS tpm FROM ({_RATE})"


@query(f"SELECT gene, sample, round(sum(tpm), 4) AS tpm, round(sum(tpm) / 1e6 * max(total), 2) AS count FROM ({_TPM}) JOIN (SELECT sample, sum(value) AS total FROM cells GROUP BY sample) USING (sample) GROUP BY gene, sample")
def gene_rollup(s: SparkSession, d: str) -> DataFrame:
    c, g = cells(s, d), genemap(s, d)
    return matrix.gene_rollup(c, matrix.tpm(c, g.select("feature", "length")), g.select("feature", "gene")).select("gene", "sample", F.round("tpm", 4).alias("tpm"), "count")


@query("SELECT gene, sample, round(sum(value) / sum(value / greatest(length, 1.0)), 6) AS eff_length FROM cells JOIN genemap USING (feature) GROUP BY gene, sample")
def gene_eff_length(s: SparkSession, d: str) -> DataFrame:
    g = genemap(s, d)
    return matrix.gene_effective_length(cells(s, d), g.select("feature", "length"), g.select("feature", "gene")).withColumn("eff_length", F.round("eff_length", 6))


@query("SELECT gene, CAST(floor(sum(length * (coalesce(v, 0) + 1)) / sum(coalesce(v, 0) + 1) + 0.5) AS BIGINT) AS length FROM genemap LEFT JOIN (SELECT feature, sum(value) AS v FROM cells GROUP BY feature) USING (feature) GROUP BY gene")
def tpm_weighted_length(s: SparkSession, d: str) -> DataFrame:
    g = genemap(s, d)
    return matrix.weighted_gene_length(cells(s, d).groupBy("feature").agg(F.sum("value").alias("value")), g.select("feature", "length"), g.select("feature", "gene"))


_ISO = "SELECT gene, feature AS transcript, sum(value) AS expr FROM cells JOIN genemap USING (feature) GROUP BY ALL"


@query(f"SELECT gene, transcript, expr, round(expr * 100.0 / sum(expr) OVER g, 2) AS pct_iso, round(expr * 100.0 / max(expr) OVER g, 2) AS pct_dom, row_number() OVER (PARTITION BY gene ORDER BY expr DESC, transcript) = 1 AS top FROM ({_ISO}) WINDOW g AS (PARTITION BY gene)")
def pct_dominant_isoform(s: SparkSession, d: str) -> DataFrame:
    return tables.dominant_isoforms(_isoforms(s, d))


@query(f"SELECT * FROM (SELECT gene, transcript, expr, round(expr * 100.0 / sum(expr) OVER g, 2) AS pct_iso, round(expr * 100.0 / max(expr) OVER g, 2) AS pct_dom, row_number() OVER (PARTITION BY gene ORDER BY expr DESC, transcript) = 1 AS top FROM ({_ISO}) WINDOW g AS (PARTITION BY gene)) WHERE expr >= 100 AND (top OR pct_dom >= 50)")
def filter_low_expr(s: SparkSession, d: str) -> DataFrame:
    return tables.dominant_isoforms(_isoforms(s, d), min_any=100, min_percent=50)


def _isoforms(s: SparkSession, d: str) -> DataFrame:
    return cells(s, d).join(genemap(s, d), "feature").groupBy("gene", F.col("feature").alias("transcript")).agg(F.sum("value").alias("expr"))


@query("SELECT feature, sample, round(value * (SELECT avg(q) FROM qs) / q, 6) AS value FROM cells JOIN qs USING (sample)".replace("qs", "(SELECT sample, quantile_cont(value, 0.75) AS q FROM cells WHERE value > 0 GROUP BY sample)"))
def uq_norm(s: SparkSession, d: str) -> DataFrame:
    return matrix.upper_quartile(cells(s, d)).withColumn("value", F.round("value", 6))


@query("""SELECT sample, max(lib) AS lib_size, round(pow(2, max(t) - avg(max(t)) OVER ()), 6) AS norm_factor FROM (
 SELECT lib.sample, lib.lib, coalesce(k.t, 0) AS t FROM lib LEFT JOIN (
  SELECT sample, sum(lr / v) / sum(1 / v) AS t FROM (
   SELECT *, count(*) OVER (PARTITION BY sample) AS n, rank() OVER (PARTITION BY sample ORDER BY lr) + (count(*) OVER (PARTITION BY sample, lr) - 1) / 2.0 AS rl,
    rank() OVER (PARTITION BY sample ORDER BY ab) + (count(*) OVER (PARTITION BY sample, ab) - 1) / 2.0 AS rs FROM (
    SELECT c.sample, log2((c.value / l.lib) / (r.value / ref.lib)) AS lr, (log2(c.value / l.lib) + log2(r.value / ref.lib)) / 2 AS ab,
     (l.lib - c.value) / l.lib / c.value + (ref.lib - r.value) / ref.lib / r.value AS v
    FROM cells c JOIN lib l USING (sample) CROSS JOIN (SELECT * FROM lib ORDER BY abs(q / lib - (SELECT avg(q / lib) FROM lib)), sample LIMIT 1) ref JOIN cells r ON r.sample = ref.sample AND r.feature = c.feature
    WHERE c.value > 0 AND r.value > 0))
  WHERE rl BETWEEN floor(n * 0.3) + 1 AND n - floor(n * 0.3) AND rs BETWEEN floor(n * 0.05) + 1 AND n - floor(n * 0.05) GROUP BY sample) k USING (sample)) GROUP BY sample""".replace("FROM lib", "FROM (SELECT sample, sum(value) AS lib, quantile_cont(value, 0.75) AS q FROM cells GROUP BY sample) lib").replace("JOIN lib l", "JOIN (SELECT sample, sum(value) AS lib FROM cells GROUP BY sample) l"))
def tmm_norm(s: SparkSession, d: str) -> DataFrame:
    return matrix.tmm_factors(cells(s, d)).select("sample", "lib_size", F.round("norm_factor", 6).alias("norm_factor"))


@query("SELECT feature, sample, round(log2(value * 1e6 / sum(value) OVER (PARTITION BY sample) + 1), 6) AS value FROM cells")
def cpm_log2(s: SparkSession, d: str) -> DataFrame:
    return matrix.log2_plus_one(matrix.per_sample_share(cells(s, d))).withColumn("value", F.round("value", 6))


@query("SELECT feature, sample, round((value - avg(value) OVER f) / stddev_samp(value) OVER f, 6) AS value FROM cells WINDOW f AS (PARTITION BY feature) QUALIFY stddev_samp(value) OVER f > 0")
def zscale_rows(s: SparkSession, d: str) -> DataFrame:
    return matrix.centred_rows(cells(s, d), scale=True).withColumn("value", F.round("value", 6))


@query("SELECT feature, sample, round(log2(value + 1) - median(log2(value + 1)) OVER (PARTITION BY feature), 6) AS value FROM cells")
def median_centred(s: SparkSession, d: str) -> DataFrame:
    return matrix.centred_rows(matrix.log2_plus_one(cells(s, d)), median=True).withColumn("value", F.round("value", 6))


@query("SELECT feature, cv FROM (SELECT feature, round(stddev_samp(m) / avg(m), 6) AS cv FROM (SELECT feature, sample, median(value) + 0.1 AS m FROM reps GROUP BY ALL) GROUP BY feature) WHERE cv IS NOT NULL")
def cv_of_medians(s: SparkSession, d: str) -> DataFrame:
    return matrix.variation_of_medians(reps(s, d), rep_map(s, d)).where("cv is not null").select("feature", F.round("cv", 6).alias("cv"))


@query("SELECT x.sample AS a, y.sample AS b, round(corr(x.value, y.value), 6) AS cor, count(*) AS n FROM cells x JOIN cells y USING (feature) WHERE x.sample < y.sample GROUP BY ALL")
def sample_cor(s: SparkSession, d: str) -> DataFrame:
    return matrix.sample_correlation(cells(s, d)).withColumn("cor", F.round("cor", 6))


@query("SELECT x.sample AS a, y.sample AS b, round(corr(x.r, y.r), 6) AS cor, count(*) AS n FROM rk x JOIN rk y USING (feature) WHERE x.sample < y.sample GROUP BY ALL".replace("rk ", "(SELECT feature, sample, rank() OVER (PARTITION BY sample ORDER BY value) + (count(*) OVER (PARTITION BY sample, value) - 1) / 2.0 AS r FROM cells) "))
def sample_cor_spearman(s: SparkSession, d: str) -> DataFrame:
    return matrix.sample_correlation(cells(s, d), "spearman").withColumn("cor", F.round("cor", 6))


@query("SELECT x.sample AS a, y.sample AS b, round(sqrt(sum((x.value - y.value) * (x.value - y.value))), 6) AS distance FROM cells x JOIN cells y USING (feature) WHERE x.sample < y.sample GROUP BY ALL")
def sample_distances(s: SparkSession, d: str) -> DataFrame:
    return matrix.sample_distance(cells(s, d)).withColumn("distance", F.round("distance", 6))


@query("SELECT feature, sample, sum(value) AS value FROM reps GROUP BY ALL")
def sum_tech_reps(s: SparkSession, d: str) -> DataFrame:
    return matrix.combined_replicates(reps(s, d), rep_map(s, d), "sum")


@query("SELECT feature, sample, round(exp(avg(ln(value + 1))) - 1, 6) AS value FROM reps GROUP BY ALL")
def replicate_avg(s: SparkSession, d: str) -> DataFrame:
    return matrix.combined_replicates(reps(s, d), rep_map(s, d), "avg_log").withColumn("value", F.round("value", 6))


@query("SELECT sample, x.replicate AS a, y.replicate AS b, round(corr(log2(x.value + 1), log2(y.value + 1)), 6) AS cor, round(avg(log2(x.value + 1) - log2(y.value + 1)), 6) AS mean_m FROM reps x JOIN reps y USING (feature, sample) WHERE x.replicate < y.replicate GROUP BY ALL")
def replicate_qc(s: SparkSession, d: str) -> DataFrame:
    r = matrix.replicate_pairs(reps(s, d), rep_map(s, d))
    return r.select("sample", "a", "b", F.round("cor", 6).alias("cor"), F.round("mean_m", 6).alias("mean_m"))


@query("SELECT feature, array_to_string(list_sort(list(sample)), '|') AS samples FROM (SELECT feature, sample, value, max(value) OVER (PARTITION BY feature) AS m FROM cells) WHERE m > 0 AND value >= m * 0.9 GROUP BY feature")
def tissue_specific(s: SparkSession, d: str) -> DataFrame:
    return matrix.tissue_specific(cells(s, d))


@query("""SELECT feature, round(-sum(x / t * log2(x / t)), 6) AS entropy FROM (SELECT feature, x, sum(x + 0.1) OVER (PARTITION BY feature) AS t FROM (
 SELECT feature, abs(value - bw) + 0.1 AS x FROM cells JOIN (SELECT feature, sum(w * value) / sum(w) AS bw FROM (
  SELECT feature, value, CASE WHEN abs(u) <= 1 THEN (1 - u * u) * (1 - u * u) ELSE 0 END AS w FROM (
   SELECT feature, value, (value - m) / (5 * median(abs(value - m)) OVER (PARTITION BY feature) + 1e-4) AS u FROM (SELECT feature, value, median(value) OVER (PARTITION BY feature) AS m FROM cells))) GROUP BY feature) USING (feature))) GROUP BY feature""")
def roku_entropy(s: SparkSession, d: str) -> DataFrame:
    return matrix.row_entropy(cells(s, d)).withColumn("entropy", F.round("entropy", 6))


@query("SELECT feature, round(m, 6) AS mean, round(s, 6) AS sd, round(s / nullif(m, 0), 6) AS cv, round(s * s / nullif(m, 0), 6) AS fano, round(sqrt(s), 6) AS var FROM (SELECT feature, avg(value) AS m, stddev_samp(value) AS s FROM cells GROUP BY feature)")
def mean_variance(s: SparkSession, d: str) -> DataFrame:
    x = matrix.mean_variance(cells(s, d))
    return x.select("feature", *[F.round(c, 6).alias(c) for c in ("mean", "sd", "cv", "fano", "var")])


@query("SELECT feature, sample, value FROM cells WHERE feature IN (SELECT feature FROM cells GROUP BY feature HAVING sum(value) >= 600 AND max(value) >= 300)")
def min_row_sums(s: SparkSession, d: str) -> DataFrame:
    return matrix.rows_where(cells(s, d), "sum >= 600 and max >= 300")


@query("SELECT feature, sample, value FROM cells WHERE feature IN (SELECT feature FROM cells WHERE value >= 200 GROUP BY feature HAVING count(*) >= 2)")
def prevalent_rows(s: SparkSession, d: str) -> DataFrame:
    return matrix.prevalent_rows(cells(s, d), 200, 2)


@query("""SELECT feature, round(f, 6) AS f FROM (SELECT feature, (sq - n * gm * gm) / (k - 1) / (within / (n - k)) AS f FROM (
 SELECT feature, sum(n) AS n, count(*) AS k, sum(n * m) / sum(n) AS gm, sum(n * v) AS within, sum(n * m * m) AS sq FROM (
  SELECT feature, sample, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM reps GROUP BY ALL) GROUP BY feature) WHERE k > 1 AND n > k AND within > 0)""")
def anova_f(s: SparkSession, d: str) -> DataFrame:
    return matrix.anova(reps(s, d), rep_map(s, d)).where("f is not null").select("feature", F.round("f", 6).alias("f"))


@query()
def anova_p(s: SparkSession, d: str) -> DataFrame:
    return matrix.anova(reps(s, d), rep_map(s, d))


@query()
def principal_components(s: SparkSession, d: str) -> DataFrame:
    return matrix.principal_components(reps(s, d), 3)


@query()
def kmeans_clusters(s: SparkSession, d: str) -> DataFrame:
    return matrix.kmeans(matrix.log2_plus_one(cells(s, d)), 4, SAMPLES)


@query()
def nb_exact_test(s: SparkSession, d: str) -> DataFrame:
    groups = rep_map(s, d).select(F.col("replicate").alias("sample"), F.col("sample").alias("grp"))
    return matrix.negative_binomial_test(reps(s, d), groups, "A", "R")


@query()
def voom_test(s: SparkSession, d: str) -> DataFrame:
    groups = rep_map(s, d).select(F.col("replicate").alias("sample"), F.col("sample").alias("grp"))
    return matrix.voom_test(reps(s, d), groups, "A", "R")


@query()
def downsampled_matrix(s: SparkSession, d: str) -> DataFrame:
    return matrix.downsampled(cells(s, d), 10_000)


@query("SELECT feature, 'A' AS a, 'R' AS b, round(log_fc, 6) AS log_fc, CASE WHEN log_fc >= 0 THEN 'A-UP' ELSE 'B-UP' END AS direction FROM changes WHERE abs(log_fc) >= 0.5 AND fdr <= 0.001")
def de_extract(s: SparkSession, d: str) -> DataFrame:
    return tables.extracted(changes(s, d), 0.5, 0.001).select("feature", "a", "b", F.round("log_fc", 6).alias("log_fc"), "direction")


@query("SELECT CAST(fc AS INTEGER) AS fc, CAST(p AS INTEGER) AS p, count(DISTINCT feature) AS features FROM changes CROSS JOIN (SELECT unnest(range(1, 11)) AS fc) CROSS JOIN (SELECT unnest(range(1, 11)) AS p) WHERE abs(log_fc) >= fc AND fdr <= pow(10, -p) * (1 + 1e-9) GROUP BY ALL")
def threshold_grid(s: SparkSession, d: str) -> DataFrame:
    return tables.threshold_grid(changes(s, d))


@query("SELECT u.gene, u.feature AS up, v.feature AS down, round((-ln(u.fdr) - ln(v.fdr)) / 2, 6) AS score FROM (SELECT * FROM changes JOIN genemap USING (feature)) u JOIN (SELECT * FROM changes JOIN genemap USING (feature)) v USING (gene) WHERE u.log_fc > 0 AND v.log_fc < 0 AND u.fdr <= 1e-6 AND v.fdr <= 1e-6 AND abs(u.log_fc) >= 1.5 AND abs(v.log_fc) >= 1.5")
def isoform_swap(s: SparkSession, d: str) -> DataFrame:
    x = changes(s, d).join(genemap(s, d).select("feature", "gene"), "feature")
    return tables.isoform_swaps(x, 1e-6, 1.5).withColumn("score", F.round("score", 6))


@query("SELECT gene, CAST(count_if(log_fc > 0) AS BIGINT) AS n_up, CAST(count_if(log_fc < 0) AS BIGINT) AS n_down FROM changes JOIN genemap USING (feature) WHERE fdr <= 0.05 AND abs(log_fc) >= 1 GROUP BY gene HAVING count_if(log_fc > 0) > 0 AND count_if(log_fc < 0) > 0")
def dtu_up_down(s: SparkSession, d: str) -> DataFrame:
    return tables.both_directions(changes(s, d).join(genemap(s, d).select("feature", "gene"), "feature"))


@query("SELECT CAST(floor(sum_ + 0.5) AS BIGINT) AS threshold, CAST(sum(count(*)) OVER (ORDER BY floor(sum_ + 0.5) DESC) AS BIGINT) AS features FROM (SELECT feature, sum(value) AS sum_ FROM cells GROUP BY feature) GROUP BY floor(sum_ + 0.5)")
def features_above(s: SparkSession, d: str) -> DataFrame:
    return tables.counts_above(cells(s, d).groupBy("feature").agg(F.sum("value").alias("v")), "v")


@query()
def go_enrichment(s: SparkSession, d: str) -> DataFrame:
    members = genemap(s, d).select("feature", F.col("gene").alias("term"))
    return matrix.enrichment(members, tables.extracted(changes(s, d), 1.0, 0.01).select("feature"))


# Intervals -------------------------------------------------------------------------------------------------------
@query("SELECT scaffold, lend, rend, CAST(depth AS BIGINT) AS depth FROM depthruns")
def fragment_depth(s: SparkSession, d: str) -> DataFrame:
    return intervals.depth_runs(frags(s, d))


@query("SELECT scaffold, min(lend) AS lend, max(rend) AS rend, max(rend) - min(lend) + 1 AS length, CAST(max(depth) AS BIGINT) AS max_depth FROM (SELECT *, sum(n) OVER (PARTITION BY scaffold ORDER BY lend) AS g FROM (SELECT *, CASE WHEN lag(rend) OVER (PARTITION BY scaffold ORDER BY lend) + 1 = lend THEN 0 ELSE 1 END AS n FROM depthruns WHERE depth >= 3)) GROUP BY scaffold, g")
def coverage_islands(s: SparkSession, d: str) -> DataFrame:
    return intervals.islands(intervals.depth_runs(frags(s, d)), 3)


@query("SELECT scaffold, min(lend) AS lend, max(rend) AS rend, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY scaffold ORDER BY lend, rend, okey, line) AS g FROM (SELECT *, CASE WHEN lend <= max(rend) OVER (PARTITION BY scaffold ORDER BY lend, rend, okey, line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM frags)) GROUP BY scaffold, g")
def merge_intervals(s: SparkSession, d: str) -> DataFrame:
    return intervals.merged(frags(s, d))


@query("SELECT scaffold, min(lend) AS lend, arg_max(rend, (lend, rend)) AS rend, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY scaffold ORDER BY lend, rend, okey, line) AS g FROM (SELECT *, CASE WHEN lend - lag(rend) OVER (PARTITION BY scaffold ORDER BY lend, rend, okey, line) <= 3 THEN 0 ELSE 1 END AS new FROM frags)) GROUP BY scaffold, g")
def sessionise(s: SparkSession, d: str) -> DataFrame:
    return intervals.sessions(frags(s, d), 3)


@query("SELECT o_orderkey AS okey, f.okey AS fkey, f.line FROM (SELECT o_orderkey, o_custkey, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS lo FROM orders) JOIN frags f ON f.scaffold = o_custkey AND f.lend <= lo + 30 AND f.rend >= lo")
def overlap_join(s: SparkSession, d: str) -> DataFrame:
    o = _order_days(s, d).select(F.col("custkey").alias("scaffold"), F.col("o_orderkey").alias("oid"), F.col("day").alias("lo"), (F.col("day") + 30).alias("hi"))
    return intervals.overlap_join(o, frags(s, d), "scaffold", ("lo", "hi"), ("lend", "rend")).select(F.col("oid").alias("okey"), F.col("okey").alias("fkey"), "line")


@query("SELECT o_orderkey AS okey, f.okey AS fkey, f.line FROM (SELECT o_orderkey, o_custkey, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS lo FROM orders) JOIN frags f ON f.scaffold = o_custkey AND lo BETWEEN f.lend AND f.rend")
def point_in_interval(s: SparkSession, d: str) -> DataFrame:
    o = _order_days(s, d).select(F.col("custkey").alias("scaffold"), F.col("o_orderkey").alias("oid"), F.col("day").alias("pos"))
    return intervals.points_in_intervals(o, frags(s, d), "scaffold", "pos", ("lend", "rend")).select(F.col("oid").alias("okey"), F.col("okey").alias("fkey"), "line")


def _order_days(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"), F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("long").alias("day"))


@query("""SELECT o_orderkey AS okey, pos - (SELECT max(rend) FROM frags f WHERE f.scaffold = o_custkey AND rend < pos) AS previous_distance, (SELECT min(lend) FROM frags f WHERE f.scaffold = o_custkey AND lend > pos) - pos AS next_distance
FROM (SELECT o_orderkey, o_custkey, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS pos FROM orders)""")
def nearest_feature(s: SparkSession, d: str) -> DataFrame:
    o = _order_days(s, d).select(F.col("custkey").alias("scaffold"), F.col("o_orderkey").alias("okey"), F.col("day").alias("pos"))
    f = frags(s, d).select("scaffold", F.concat_ws(":", "okey", "line").alias("name"), "lend", "rend")
    return intervals.nearest(o, f).select("okey", "previous_distance", "next_distance")


@query("""SELECT scaffold, pos, CAST(both_ AS BIGINT) AS both, CAST(l + r - 2 * both_ AS BIGINT) AS single, round((both_ + 1) / (l + r - both_ + 1), 6) AS jaccard FROM (
 SELECT scaffold, pos, sum(dl) OVER w AS l, sum(dr) OVER w AS r, sum(db) OVER w AS both_ FROM (SELECT scaffold, pos, sum(dl) AS dl, sum(dr) AS dr, sum(db) AS db FROM (
  SELECT scaffold, lend AS pos, 1 AS dl, 0 AS dr, 0 AS db FROM frags UNION ALL SELECT scaffold, rend + 1, -1, 0, 0 FROM frags UNION ALL SELECT scaffold, lend - 19, 0, 1, 0 FROM frags UNION ALL SELECT scaffold, rend - 18, 0, -1, 0 FROM frags
  UNION ALL SELECT scaffold, lend, 0, 0, 1 FROM frags WHERE rend - lend >= 19 UNION ALL SELECT scaffold, rend - 18, 0, 0, -1 FROM frags WHERE rend - lend >= 19) GROUP BY ALL) WINDOW w AS (PARTITION BY scaffold ORDER BY pos))""")
def jaccard_windows(s: SparkSession, d: str) -> DataFrame:
    return intervals.jaccard_windows(frags(s, d), 20).withColumn("jaccard", F.round("jaccard", 6))


@query()
def jaccard_clips(s: SparkSession, d: str) -> DataFrame:
    wig = intervals.dense(intervals.jaccard_windows(frags(s, d), 20), "jaccard")
    return intervals.troughs(wig, 20, 0.3, 0.05)


@query("SELECT scaffold, lend, okey, line FROM frags QUALIFY row_number() OVER (PARTITION BY scaffold, lend ORDER BY okey * 10 + line) <= 2")
def cap_per_position(s: SparkSession, d: str) -> DataFrame:
    x = frags(s, d).withColumn("ord", F.col("okey") * 10 + F.col("line"))
    return intervals.capped_per_start(x, 2, "ord").select("scaffold", "lend", "okey", "line")


@query("SELECT scaffold, pos, count(*) AS n FROM (SELECT scaffold, lend AS pos FROM frags UNION ALL SELECT scaffold, rend FROM frags) GROUP BY ALL")
def fragment_boundaries(s: SparkSession, d: str) -> DataFrame:
    return intervals.boundary_counts(frags(s, d))


@query("""SELECT scaffold, lend, rend, array_to_string(list_sort(list(DISTINCT line)), ',') AS owners FROM (SELECT scaffold, pos AS lend, lead(pos) OVER (PARTITION BY scaffold ORDER BY pos) - 1 AS rend FROM (SELECT DISTINCT scaffold, lend AS pos FROM frags UNION SELECT scaffold, rend + 1 FROM frags)) p
JOIN (SELECT scaffold AS s2, lend AS l2, rend AS r2, line FROM frags) ON s2 = scaffold AND l2 <= rend AND r2 >= lend WHERE rend IS NOT NULL GROUP BY ALL""")
def elementary_segments(s: SparkSession, d: str) -> DataFrame:
    return intervals.elementary_segments(frags(s, d), "line").withColumn("owners", F.array_join(F.col("owners").cast("array<string>"), ","))


@query()
def coverage_cap(s: SparkSession, d: str) -> DataFrame:
    x = frags(s, d).select("scaffold", F.concat_ws(":", "okey", "line").alias("name"), "lend", "rend")
    return intervals.capped_coverage(x, 5)


# Hits ------------------------------------------------------------------------------------------------------------
_BEST = "SELECT *, (abs(t_end - t_start) + 1) * 100.0 / t_length AS pct FROM (SELECT * FROM hitrows QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, target, t_start, t_end) = 1) QUALIFY row_number() OVER (PARTITION BY target ORDER BY pct DESC, score DESC, query) = 1"


@query(f"SELECT query, target, score, round(pct, 6) AS pct FROM ({_BEST})")
def top_hit_coverage(s: SparkSession, d: str) -> DataFrame:
    return hits.target_coverage(hit_rows(s, d)).select("query", "target", "score", F.round("pct", 6).alias("pct"))


@query(f"SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, CAST(sum(count(*)) OVER (ORDER BY bin DESC) AS BIGINT) AS at_least FROM (SELECT least(greatest(ceil(pct / 10) * 10, 10), 100) AS bin FROM ({_BEST})) GROUP BY bin")
def top_hit_bins(s: SparkSession, d: str) -> DataFrame:
    return hits.coverage_bins(hits.target_coverage(hit_rows(s, d)))


@query("SELECT query, target, score FROM hitrows QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, target) <= 3")
def top_n_hits(s: SparkSession, d: str) -> DataFrame:
    return hits.top_hits(hit_rows(s, d), "query", [F.desc("score"), F.asc("target")], 3).select("query", "target", "score")


@query("SELECT okey AS query, CAST(count(*) AS BIGINT) AS segments, CAST(sum(greatest(hi - greatest(lo - 1, coalesce(before, lo - 1)), 0)) AS BIGINT) AS covered FROM (SELECT okey, lend AS lo, rend AS hi, max(rend) OVER (PARTITION BY okey ORDER BY lend, rend, line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM frags) GROUP BY okey")
def hit_segments(s: SparkSession, d: str) -> DataFrame:
    x = frags(s, d).select(F.col("okey").alias("query"), F.lit(1).alias("target"), F.col("lend").alias("q_start"), F.col("rend").alias("q_end"), F.col("lend").alias("t_start"), F.col("rend").alias("t_end"), F.lit(100.0).alias("identity"), F.lit(0.0).alias("evalue"))
    return hits.grouped_segments(x).select("query", "segments", F.col("q_covered").alias("covered"))


@query("SELECT CAST(ceil(i / (n / 5.0)) AS INTEGER) AS bin, count(*) AS features, count(f) AS found FROM (SELECT feature, row_number() OVER (ORDER BY v, feature) AS i, count(*) OVER () AS n FROM (SELECT feature, sum(value) AS v FROM cells GROUP BY feature)) LEFT JOIN (SELECT feature AS f FROM changes WHERE abs(log_fc) >= 1) ON f = feature GROUP BY 1")
def expr_quintile(s: SparkSession, d: str) -> DataFrame:
    v = cells(s, d).groupBy("feature").agg(F.sum("value").alias("value"))
    return hits.expression_quintiles(v, changes(s, d).where("abs(log_fc) >= 1"))


@query("""SELECT v AS value, i AS rank FROM (SELECT v, i - 1 AS i, round(abs((i - 1) / (max(i) OVER () - 1.0) + (log2(v) - min(log2(v)) OVER ()) / (max(log2(v)) OVER () - min(log2(v)) OVER ()) - 1) / sqrt(2), 9) AS d FROM (
SELECT v, row_number() OVER (ORDER BY v DESC, feature) AS i FROM (SELECT feature, sum(value) AS v FROM cells GROUP BY feature) WHERE v > 0.05 AND v <= 2000)) ORDER BY d DESC, i LIMIT 1""")
def elbow_threshold(s: SparkSession, d: str) -> DataFrame:
    return tables.elbow(cells(s, d).groupBy("feature").agg(F.sum("value").alias("value")), most=2000)


# Pairs, graphs, samples ------------------------------------------------------------------------------------------
@query("SELECT l.conv_id AS core, l.n AS n_left, r.n AS n_right FROM (SELECT conv_id, count(*) AS n FROM conversations WHERE turn % 2 = 0 GROUP BY conv_id) l JOIN (SELECT conv_id, count(*) AS n FROM conversations WHERE turn % 2 = 1 GROUP BY conv_id) r USING (conv_id)")
def mate_merge(s: SparkSession, d: str) -> DataFrame:
    c = read(s, d, "conversations").groupBy(F.col("conv_id").alias("core"), (F.col("turn") % 2).alias("end")).agg(F.count(F.lit(1)).alias("n"))
    left, right = (c.where(F.col("end") == e).select("core", F.col("n").alias(n)) for e, n in ((0, "n_left"), (1, "n_right")))
    pairs, _ = tables.paired_and_orphans(left, right, "core")
    return pairs.join(left, "core").join(right, "core")


@query("SELECT user_id AS core, CASE WHEN bool_or(pp) THEN 'PP' WHEN bool_or(l) AND bool_or(r) THEN 'IP' WHEN bool_or(l) THEN 'L' WHEN bool_or(r) THEN 'R' ELSE 'S' END AS class FROM (SELECT user_id, event_id % 7 = 0 AND event_id % 3 = 0 AS pp, event_id % 7 = 0 AND event_id % 2 = 0 AS l, event_id % 7 = 0 AND event_id % 2 = 1 AS r FROM events) GROUP BY user_id")
def fragment_class(s: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    paired = e % 7 == 0
    flag = F.when(paired, 1).otherwise(0) + F.when(paired & (e % 3 == 0), 2).otherwise(0) + F.when(paired & (e % 2 == 0), 0x40).when(paired, 0x80).otherwise(0)
    return tables.fragment_classes(read(s, d, "events").select(F.col("user_id").alias("core"), flag.alias("flag")))


@query("SELECT l_partkey, l_suppkey, min(l_orderkey * 10 + l_linenumber) AS first FROM lineitem GROUP BY ALL")
def dup_pairs_removed(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "lineitem").select("l_partkey", "l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("first"))
    return tables.first_of(x, ["l_partkey", "l_suppkey"], ["first"])


@query("""SELECT a, b, count(*) AS n FROM (SELECT l_orderkey, least(any_value(s) FILTER (side = 1), any_value(s) FILTER (side = 2)) AS a, greatest(any_value(s) FILTER (side = 1), any_value(s) FILTER (side = 2)) AS b FROM (
 SELECT DISTINCT l_orderkey, 1 + l_linenumber % 2 AS side, l_suppkey AS s FROM lineitem) GROUP BY l_orderkey HAVING count(*) FILTER (side = 1) = 1 AND count(*) FILTER (side = 2) = 1) WHERE a <> b GROUP BY ALL""")
def scaffold_links(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "lineitem").select(F.col("l_orderkey").alias("fragment"), (F.col("l_linenumber") % 2 + 1).alias("side"), F.col("l_suppkey").alias("contig"))
    return graphs.scaffold_links(x)


def _part_edges(s: SparkSession, d: str) -> DataFrame:
    """Parts that stand first and second in an order."""
    x = read(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return x.where("l_linenumber = 1").select("l_orderkey", F.col("l_partkey").alias("a")).join(x.where("l_linenumber = 2").select("l_orderkey", F.col("l_partkey").alias("b")), "l_orderkey").where("a <> b").select("a", "b")


_PART_EDGES = "SELECT x.l_partkey AS a, y.l_partkey AS b FROM lineitem x JOIN lineitem y USING (l_orderkey) WHERE x.l_linenumber = 1 AND y.l_linenumber = 2 AND x.l_partkey <> y.l_partkey"


@query(f"WITH RECURSIVE e AS (SELECT a, b FROM ({_PART_EDGES}) UNION SELECT b, a FROM ({_PART_EDGES})), r AS (SELECT DISTINCT a AS node, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node) SELECT node, min(root) AS component FROM r GROUP BY node")
def single_linkage(s: SparkSession, d: str) -> DataFrame:
    return graphs.components(_part_edges(s, d))


_UND = f"SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM ({_PART_EDGES})"
_BOTH = f"(SELECT a, b FROM ({_UND}) UNION ALL SELECT b, a FROM ({_UND}))"


@query(f"""SELECT a, b, coalesce(c, 0) AS common, round((coalesce(c, 0) + 2) / (da + db - coalesce(c, 0)), 6) AS strength FROM ({_UND}) LEFT JOIN (SELECT e.a AS ca, e.b AS cb, count(*) AS c FROM ({_UND}) e JOIN {_BOTH} x ON x.a = e.a JOIN {_BOTH} y ON y.a = e.b AND y.b = x.b GROUP BY ALL) ON ca = a AND cb = b
JOIN (SELECT a AS na, count(*) AS da FROM {_BOTH} GROUP BY a) ON na = a JOIN (SELECT a AS nb, count(*) AS db FROM {_BOTH} GROUP BY a) ON nb = b""")
def link_jaccard(s: SparkSession, d: str) -> DataFrame:
    return graphs.link_strength(_part_edges(s, d)).withColumn("strength", F.round("strength", 6))


@query()
def em_abundance(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "lineitem").select(F.col("l_orderkey").alias("read"), F.col("l_suppkey").alias("transcript"))
    lengths = read(s, d, "supplier").select(F.col("s_suppkey").alias("transcript"), (F.length("s_name") * 100).alias("length"))
    return genes.abundance(x, lengths).select("transcript", F.round("count", 3).alias("count"), F.round("tpm", 3).alias("tpm"))


@query("SELECT doc_id FROM documents ORDER BY CAST(('0x' || substr(md5(doc_id || '|7'), 1, 12)) AS BIGINT), doc_id LIMIT 100")
def random_subset(s: SparkSession, d: str) -> DataFrame:
    return tables.random_rows(read(s, d, "documents").select("doc_id"), 100, "doc_id", seed=7)


@query("SELECT l_orderkey AS core, CAST(sum(l_linenumber & 3) AS BIGINT) AS x FROM lineitem GROUP BY ALL")
def flag_bits(s: SparkSession, d: str) -> DataFrame:
    f = F.col("l_linenumber")
    x = F.when(A.has_flag(f, "paired"), 1).otherwise(0) + F.when(A.has_flag(f, "proper_pair"), 2).otherwise(0)
    return read(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("core")).agg(F.sum(x).alias("x"))


@query("SELECT min(v) AS min, max(v) AS max, sum(v) AS sum, round(avg(v), 6) AS mean, median(v) AS median, round(stddev_samp(v), 6) AS stdev, round(stddev_samp(v) / sqrt(count(*)), 6) AS stderr, round(exp(avg(ln(v))), 6) AS geo_mean FROM (SELECT l_quantity AS v FROM lineitem)")
def value_summary(s: SparkSession, d: str) -> DataFrame:
    x = tables.summary(read(s, d, "lineitem"), "l_quantity")
    return x.select("min", "max", "sum", F.round("mean", 6).alias("mean"), "median", F.round("stdev", 6).alias("stdev"), F.round("stderr", 6).alias("stderr"), F.round("geo_mean", 6).alias("geo_mean"))
