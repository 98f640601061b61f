"""Further operators bound to whole tables: formats, filters, joins, hits, graphs, structures, partitioned outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import alignments as A
from ..functions import seq as S
from ..functions import stats
from ..operators import genes, graphs, hits, intervals, kmers, matrix, reports, tables
from ..sources import formats
from ..streaming import events as streams
from .bindings import ORACLE_SQL, _part_edges, _PART_EDGES, cells, changes, frags, genemap, hit_rows, query, read, rep_map, reps, seqs, wide_rates

#: A table's files come in no order of time: nothing counts as too late.
ANY_LATE = "36500 days"


# Formats ---------------------------------------------------------------------------------------------------------
@query("SELECT accession, '>' || accession || chr(10) || regexp_replace(regexp_replace(sequence, '(.{60})', '\\1' || chr(10), 'g'), '\\n$', '') AS record FROM seqs")
def fasta_records(s: SparkSession, d: str) -> DataFrame:
    x = seqs(s, d)
    return x.select("accession", S.fasta_record(F.col("accession").cast("string"), F.col("sequence")).alias("record"))


@query("SELECT CAST(accession AS VARCHAR) AS accession, sequence FROM seqs")
def fasta_round_trip(s: SparkSession, d: str) -> DataFrame:
    """Sequences written as FASTA to the shared folder and read back."""
    path = formats.scratch_path(s, "fasta")
    formats.write_fasta(seqs(s, d).select(F.col("accession").cast("string").alias("accession"), "sequence"), path)
    return formats.read_fasta(s, path).select("accession", "sequence")


@query("SELECT 'r' || accession || '/1' AS read_name, 1 AS pair_dir, sequence, repeat('I', length(sequence)) AS quals FROM seqs WHERE length(sequence) > 0")
def fastq_round_trip(s: SparkSession, d: str) -> DataFrame:
    path = formats.scratch_path(s, "fastq")
    x = seqs(s, d).where(F.length("sequence") > 0).select(F.concat(F.lit("r"), F.col("accession").cast("string"), F.lit(" 1:N:0")).alias("read_name"), "sequence", F.repeat(F.lit("I"), F.length("sequence")).alias("quals"))
    formats.fastq_lines(x).write.text(path)
    return formats.read_fastq(s, path).select("read_name", "pair_dir", "sequence", "quals")


@query("SELECT l_orderkey AS okey, l_linenumber AS line, 'o' || l_orderkey AS core, 1 + l_linenumber % 2 AS pair_dir FROM lineitem")
def read_pair_names(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "lineitem").select(F.col("l_orderkey").alias("okey"), F.col("l_linenumber").alias("line"), F.format_string("o%d/%d", "l_orderkey", F.col("l_linenumber") % 2 + 1).alias("name"))
    return x.select("okey", "line", S.core_read_name(F.col("name")).alias("core"), formats.pair_direction(F.col("name")).alias("pair_dir"))


_FLAG = "CAST(l_quantity AS INTEGER)"


@query(f"SELECT l_orderkey AS okey, l_linenumber AS line, concat_ws(',', CASE WHEN {_FLAG} & 1 <> 0 THEN 'paired' END, CASE WHEN {_FLAG} & 2 <> 0 THEN 'proper_pair' END, CASE WHEN {_FLAG} & 4 <> 0 THEN 'unmapped' END, CASE WHEN {_FLAG} & 8 <> 0 THEN 'mate_unmapped' END, CASE WHEN {_FLAG} & 16 <> 0 THEN 'reverse' END, CASE WHEN {_FLAG} & 32 <> 0 THEN 'mate_reverse' END) AS flags FROM lineitem")
def flag_decode(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "lineitem").select(F.col("l_orderkey").alias("okey"), F.col("l_linenumber").alias("line"), F.array_join(A.flag_names(F.col("l_quantity").cast("int")), ",").alias("flags"))


def _alignments(s: SparkSession, d: str) -> DataFrame:
    """Made-up spliced alignments: q matched, n skipped, 3 matched, 2 inserted, 4 matched, from the shipping day."""
    q = F.col("l_quantity").cast("int")
    return read(s, d, "lineitem").select(F.col("l_orderkey").alias("okey"), F.col("l_linenumber").alias("line"), (F.col("l_partkey") % 1000 + 1).cast("int").alias("pos"), F.format_string("2S%dM%dN3M2I4M", q, F.col("l_linenumber") * 30).alias("cigar"), q.alias("q"), (F.col("l_linenumber") % 2 == 0).alias("reverse"))


_ALN = "SELECT l_orderkey AS okey, l_linenumber AS line, CAST(l_partkey % 1000 + 1 AS INTEGER) AS pos, CAST(l_quantity AS INTEGER) AS q, l_linenumber * 30 AS n FROM lineitem"


@query(f"""SELECT okey, line, pos || '-' || (pos + q - 1) || ',' || (pos + q + n) || '-' || (pos + q + n + 2) || ',' || (pos + q + n + 3) || '-' || (pos + q + n + 6) AS genome,
CASE WHEN line % 2 = 0 THEN '1-4,7-9,10-' || (9 + q) ELSE '3-' || (q + 2) || ',' || (q + 3) || '-' || (q + 5) || ',' || (q + 8) || '-' || (q + 11) END AS query, q + 7 AS aligned FROM ({_ALN})""")
def cigar_blocks(s: SparkSession, d: str) -> DataFrame:
    x = _alignments(s, d).withColumn("b", A.aligned_blocks(F.col("pos"), F.col("cigar"), F.col("reverse")))
    show = lambda c: F.array_join(F.transform(c, lambda b: F.concat_ws("-", b.lend.cast("string"), b.rend.cast("string"))), ",")
    return x.select("okey", "line", show(F.col("b.genome")).alias("genome"), show(F.col("b.query")).alias("query"), A.aligned_length(F.col("b.genome")).alias("aligned"))


@query(f"SELECT okey, line, pos + q AS lend, pos + q + n - 1 AS rend FROM ({_ALN})")
def cigar_introns(s: SparkSession, d: str) -> DataFrame:
    x = _alignments(s, d).withColumn("b", A.aligned_blocks(F.col("pos"), F.col("cigar"), F.col("reverse")))
    return x.select("okey", "line", F.explode(A.introns(F.col("b.genome"), 20)).alias("i")).select("okey", "line", "i.lend", "i.rend")


@query(f"SELECT okey, line, '2S' || q || 'M' || n || 'N' || '3M2I4M' AS cigar FROM ({_ALN})")
def cigar_build(s: SparkSession, d: str) -> DataFrame:
    """Blocks and back: an insertion leaves no gap in the genome, so its blocks' gap has nothing to call spliced."""
    x = _alignments(s, d).withColumn("b", A.aligned_blocks(F.col("pos"), F.col("cigar"), F.lit(False)))
    return x.select("okey", "line", A.cigar_of_blocks(F.col("b.genome"), F.col("b.query"), F.col("q") + 11, F.array(F.lit(True), F.lit(False))).alias("cigar"))


@query(f"SELECT okey, line, concat_ws(chr(9), 'c', pos - 1, pos + q + n + 6, 'a', '0', '+', pos - 1, pos + q + n + 6, '0', '3', q || ',3,4', '0,' || (q + n) || ',' || (q + n + 3)) AS bed FROM ({_ALN})")
def bed_lines(s: SparkSession, d: str) -> DataFrame:
    x = _alignments(s, d).withColumn("b", A.aligned_blocks(F.col("pos"), F.col("cigar"), F.lit(False)))
    return x.select("okey", "line", formats.bed12(F.lit("c"), F.lit("a"), F.lit("+"), F.col("b.genome")).alias("bed"))


@query("SELECT l_orderkey AS okey, l_linenumber AS line, CASE WHEN (f & 128 <> 0) THEN CASE WHEN f & 16 <> 0 THEN '-' ELSE '+' END ELSE CASE WHEN f & 16 <> 0 THEN '+' ELSE '-' END END AS strand FROM (SELECT *, CAST(l_quantity AS INTEGER) + CASE WHEN l_linenumber % 2 = 0 THEN 64 ELSE 128 END AS f FROM lineitem)")
def transcribed_strand(s: SparkSession, d: str) -> DataFrame:
    flag = F.col("l_quantity").cast("int") + F.when(F.col("l_linenumber") % 2 == 0, 64).otherwise(128)
    return read(s, d, "lineitem").select(F.col("l_orderkey").alias("okey"), F.col("l_linenumber").alias("line"), A.transcribed_strand(flag, "RF").alias("strand"))


@query("SELECT doc_id, CAST(i - 1 AS INTEGER) AS i, w AS token FROM (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT doc_id, list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda x: x <> '') AS w FROM documents))")
def row_to_column(s: SparkSession, d: str) -> DataFrame:
    return reports.tokens(read(s, d, "documents"), "doc_id", "text")


@query("SELECT p_partkey, 'TR' || p_partkey || '|c0_g' || p_size AS gene FROM part")
def gene_trans_map(s: SparkSession, d: str) -> DataFrame:
    acc = F.format_string("TR%d|c0_g%d_i1", "p_partkey", "p_size")
    return read(s, d, "part").select("p_partkey", S.gene_of_transcript(acc).alias("gene"))


@query("SELECT accession, strand, md5(s) AS sequence_md5 FROM (SELECT CAST(accession AS VARCHAR) AS accession, 'sense' AS strand, sequence AS s FROM seqs UNION ALL SELECT accession || '-ANTI', 'anti', reverse(translate(sequence, 'ACGT', 'TGCA')) FROM seqs)")
def sense_antisense(s: SparkSession, d: str) -> DataFrame:
    return reports.both_strands(seqs(s, d)).select("accession", "strand", F.md5("sequence").alias("sequence_md5"))


@query("SELECT feature, round(sum(w * value) / sum(w), 6) AS biweight FROM (SELECT feature, value, CASE WHEN abs(u) <= 1 THEN (1 - u * u) * (1 - u * u) ELSE 0 END AS w FROM (SELECT feature, value, (value - m) / (5 * median(abs(value - m)) OVER (PARTITION BY feature) + 1e-4) AS u FROM (SELECT feature, value, median(value) OVER (PARTITION BY feature) AS m FROM cells))) GROUP BY feature")
def tukey_biweight(s: SparkSession, d: str) -> DataFrame:
    return stats.tukey_biweight(cells(s, d), "feature", "value").withColumn("biweight", F.round("biweight", 6))


@query("SELECT accession, round(-sum(CASE WHEN n > 0 THEN n / length(sequence) * log2(n / length(sequence)) ELSE 0 END), 6) AS entropy FROM (SELECT accession, sequence, unnest([length(sequence) - length(replace(sequence, 'A', '')), length(sequence) - length(replace(sequence, 'C', '')), length(sequence) - length(replace(sequence, 'G', '')), length(sequence) - length(replace(sequence, 'T', ''))]) AS n FROM seqs) GROUP BY accession, sequence")
def seed_entropy(s: SparkSession, d: str) -> DataFrame:
    return seqs(s, d).select("accession", F.round(S.seed_entropy(F.col("sequence")), 6).alias("entropy"))


# Filters and joins -----------------------------------------------------------------------------------------------
@query("SELECT p_partkey FROM part WHERE length(p_name) >= 10 OR p_size >= 25")
def contig_filter(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "part").select("p_partkey", F.format_string("a%d;%d", "p_partkey", "p_size").alias("accession"), F.col("p_name").alias("sequence"))
    return tables.long_or_covered(x, 10, 25).select("p_partkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def drop_listed(s: SparkSession, d: str) -> DataFrame:
    return tables.drop_listed(read(s, d, "customer").select("c_custkey"), read(s, d, "orders").select("o_custkey"), "c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def keep_listed(s: SparkSession, d: str) -> DataFrame:
    return tables.keep_listed(read(s, d, "customer").select("c_custkey"), read(s, d, "orders").select("o_custkey"), "c_custkey")


@query("SELECT l_orderkey AS core, l_suppkey AS rname FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) = 1)")
def single_scaffold_reads(s: SparkSession, d: str) -> DataFrame:
    return tables.single_scaffold_reads(read(s, d, "lineitem").select(F.col("l_orderkey").alias("core"), F.col("l_suppkey").alias("rname")))


@query("SELECT a, b FROM (SELECT DISTINCT n_nationkey AS a, n_regionkey AS b FROM nation) e WHERE NOT EXISTS (SELECT 1 FROM nation r WHERE r.n_nationkey = e.b AND r.n_regionkey = e.a)")
def missing_reverse(s: SparkSession, d: str) -> DataFrame:
    return graphs.missing_reverse(read(s, d, "nation").select(F.col("n_nationkey").alias("a"), F.col("n_regionkey").alias("b")))


@query("SELECT coalesce(l.k, r.k) AS key, CASE WHEN l.k IS NULL THEN 'right' ELSE 'left' END AS side FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') l FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O') r ON l.k = r.k WHERE l.k IS NULL OR r.k IS NULL")
def orphans(s: SparkSession, d: str) -> DataFrame:
    o = read(s, d, "orders")
    left, right = (o.where(F.col("o_orderstatus") == x).select(F.col("o_custkey").alias("key")).distinct() for x in "FO")
    return tables.paired_and_orphans(left, right, "key")[1]


@query("SELECT feature, coalesce(CAST(a AS VARCHAR), 'NA') AS a, coalesce(CAST(b AS VARCHAR), 'NA') AS b FROM (SELECT l_partkey AS feature, count(*) AS a FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) FULL JOIN (SELECT l_partkey AS feature, count(*) AS b FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) USING (feature)")
def full_outer_na(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "lineitem").withColumnRenamed("l_partkey", "feature")
    a = x.where("l_returnflag = 'A'").groupBy("feature").agg(F.count(F.lit(1)).alias("a"))
    b = x.where("l_linestatus = 'F'").groupBy("feature").agg(F.count(F.lit(1)).alias("b"))
    return tables.value_or_na(a, b, key="feature")


@query("SELECT core, round((l.median + r.median) / 2, 6) AS median, round((l.mean + r.mean) / 2, 6) AS mean, round((l.stdev + r.stdev) / 2, 6) AS stdev FROM (SELECT l_orderkey AS core, median(l_quantity) AS median, avg(l_quantity) AS mean, coalesce(stddev_samp(l_quantity), 0) AS stdev FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY 1) l JOIN (SELECT l_orderkey AS core, median(l_quantity) AS median, avg(l_quantity) AS mean, coalesce(stddev_samp(l_quantity), 0) AS stdev FROM lineitem WHERE l_linenumber % 2 = 1 GROUP BY 1) r USING (core)")
def merged_mate_stats(s: SparkSession, d: str) -> DataFrame:
    def side(m: int) -> DataFrame:
        v = F.col("l_quantity")
        return read(s, d, "lineitem").where(F.col("l_linenumber") % 2 == m).groupBy(F.col("l_orderkey").cast("string").alias("accession")).agg(F.median(v).alias("median"), F.avg(v).alias("mean"), F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias("stdev"))

    x = kmers.merged_mates(side(0), side(1), 6)
    return x.withColumn("core", F.col("core").cast("long"))


@query("SELECT a || '--' || b AS fusion, CASE WHEN count(DISTINCT w) = 2 THEN 'BOTH' WHEN max(w) = 'A' THEN 'A_only' ELSE 'B_only' END AS where FROM (SELECT DISTINCT l_linestatus AS st, CASE l_linestatus WHEN 'F' THEN 'A' ELSE 'B' END AS w, min(l_suppkey) AS a, max(l_suppkey) AS b FROM lineitem GROUP BY l_orderkey, l_linestatus HAVING count(DISTINCT l_suppkey) = 2) GROUP BY a, b")
def fusion_comparison(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("query"), "l_linestatus").agg(F.array_sort(F.collect_set("l_suppkey")).alias("targets")).where(F.size("targets") == 2).withColumn("targets", F.col("targets").cast("array<string>"))
    return hits.fusion_comparison(x.where("l_linestatus = 'F'"), x.where("l_linestatus = 'O'"))


@query("SELECT scaffold, count(*) AS n FROM (SELECT scaffold, lend, rend, unnest(list_concat([lend], list_filter(list_transform(cuts, lambda p: p + 1), lambda p: true))) AS st FROM (SELECT scaffold, lend, rend, list_filter(range(CAST(ceil((lend + 1) / 10.0) AS BIGINT) * 10, rend, 10), lambda p: p > lend AND p < rend) AS cuts FROM (SELECT DISTINCT scaffold, lend, rend FROM frags))) GROUP BY scaffold")
def split_at_points(s: SparkSession, d: str) -> DataFrame:
    """Intervals cut at every tenth day, pieces counted."""
    x = frags(s, d).select("scaffold", "lend", "rend").distinct()
    days = x.groupBy("scaffold").agg(F.min("lend").alias("lo"), F.max("rend").alias("hi")).select("scaffold", F.explode(F.sequence(F.floor(F.col("lo") / 10) * 10, F.col("hi"), F.lit(10).cast("long"))).alias("pos"))
    return intervals.split_at(x, days, 0).groupBy("scaffold").agg(F.count(F.lit(1)).alias("n"))


# Aggregations ----------------------------------------------------------------------------------------------------
@query("SELECT n AS isoforms, count(*) AS genes FROM (SELECT gene, count(*) AS n FROM genemap GROUP BY gene) GROUP BY n")
def isoforms_per_gene(s: SparkSession, d: str) -> DataFrame:
    return reports.group_size_histogram(genemap(s, d), "gene", "isoforms", "genes")


@query("SELECT l_partkey AS target, count(*) FILTER (l_linestatus = 'O') AS plus, count(*) FILTER (l_linestatus = 'F') AS minus, round((count(*) FILTER (l_linestatus = 'O') - count(*) FILTER (l_linestatus = 'F')) / count(*), 6) AS difference FROM lineitem GROUP BY 1")
def strand_balance(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "lineitem").select(F.col("l_partkey").alias("target"), F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"))
    return tables.strand_balance(x).withColumn("difference", F.round("difference", 6))


@query("SELECT gene, sum(va) AS va, sum(vn) AS vn, sum(vr) AS vr, arg_min(feature, (-(va + vn + vr), feature)) AS feature FROM rates JOIN genemap USING (feature) GROUP BY gene")
def representative_isoform_matrix(s: SparkSession, d: str) -> DataFrame:
    x = wide_rates(s, d).join(genemap(s, d).select("feature", "gene"), "feature")
    return reports.representative_rows(x, "gene", "feature", ["va", "vn", "vr"])


@query("SELECT target, CASE min(rank) WHEN 1 THEN 'R' WHEN 2 THEN 'N' ELSE 'A' END AS category FROM (SELECT l_partkey AS target, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS rank FROM lineitem WHERE l_quantity >= 40) GROUP BY target")
def category_by_priority(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "lineitem").select(F.col("l_partkey").alias("target"), F.col("l_returnflag").alias("category"), F.col("l_quantity").alias("pct"), F.lit(0.0).alias("evalue"))
    return hits.by_priority(x, ["R", "N", "A"], 40)


@query("SELECT p_type AS value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM part), 6) AS percent FROM part GROUP BY 1 HAVING count(*) * 100.0 / (SELECT count(*) FROM part) >= 1")
def value_shares(s: SparkSession, d: str) -> DataFrame:
    return hits.shares(read(s, d, "part"), "p_type", 1.0).withColumn("percent", F.round("percent", 6))


@query("SELECT query, target, t_start, round((t_end - t_start) * 100.0 / t_length, 2) AS pct_len FROM hitrows")
def percent_match_length(s: SparkSession, d: str) -> DataFrame:
    return hits.percent_match_length(hit_rows(s, d)).select("query", "target", "t_start", "pct_len")


@query("SELECT l_orderkey AS okey, l_linenumber AS line, round(m * 100.0 / (m + x), 6) AS identity, round(2.0 * 100 / (m + x + 2), 6) AS gap_percent, round(m * 5.0 - x * 4.0 - 40 - ln(3), 6) AS align_score FROM (SELECT *, CAST(l_quantity AS INTEGER) * 10 AS m, l_linenumber AS x FROM lineitem)")
def alignment_scores(s: SparkSession, d: str) -> DataFrame:
    one = F.lit(1)
    x = read(s, d, "lineitem").select(F.col("l_orderkey").alias("okey"), F.col("l_linenumber").alias("line"), (F.col("l_quantity").cast("int") * 10).alias("matches"), F.col("l_linenumber").alias("mismatches"), one.alias("q_gaps"), one.alias("t_gaps"), one.alias("q_gap_bases"), one.alias("t_gap_bases"), F.lit(0).alias("t_start"), F.lit(10).alias("t_end"), F.lit(20).alias("t_length"))
    return hits.alignment_summary(x).select("okey", "line", *[F.round(c, 6).alias(c) for c in ("identity", "gap_percent", "align_score")])


@query("SELECT lang, count(*) AS n, min(n_chars) AS min, max(n_chars) AS max, round(avg(n_chars), 6) AS mean, quantile_cont(n_chars, 0.25) AS q1, median(n_chars) AS median, quantile_cont(n_chars, 0.75) AS q3 FROM documents GROUP BY lang")
def length_quartiles(s: SparkSession, d: str) -> DataFrame:
    return reports.quartiles(read(s, d, "documents"), "lang", "n_chars").withColumn("mean", F.round("mean", 6))


@query("SELECT x AS a, y AS b, count(*) AS n FROM (SELECT l_suppkey AS x, l_partkey % 50 AS y FROM lineitem UNION ALL SELECT l_partkey % 50, l_suppkey FROM lineitem) GROUP BY ALL")
def symmetric_counts(s: SparkSession, d: str) -> DataFrame:
    p = read(s, d, "lineitem").select(F.col("l_suppkey").alias("a"), (F.col("l_partkey") % 50).alias("b"))
    return reports.symmetric_counts(p)


@query("SELECT methods, count(*) AS n FROM (SELECT l_partkey, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS methods FROM lineitem WHERE l_quantity >= 45 GROUP BY 1) GROUP BY methods")
def venn_counts(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "lineitem").where("l_quantity >= 45").select(F.col("l_partkey").alias("feature"), F.col("l_returnflag").alias("method"))
    return reports.venn(x)


@query("SELECT gene, sum(value) FILTER (sample = 'A') AS a_sum, count(*) FILTER (value >= 100) AS n_high, bool_and(value >= 10) AS all_expressed FROM cells JOIN genemap USING (feature) GROUP BY gene")
def cluster_recovery(s: SparkSession, d: str) -> DataFrame:
    x = cells(s, d).join(genemap(s, d), "feature")
    return x.groupBy("gene").agg(F.sum(F.when(F.col("sample") == "A", F.col("value"))).alias("a_sum"), F.count_if(F.col("value") >= 100).alias("n_high"), F.bool_and(F.col("value") >= 10).alias("all_expressed"))


# Matrices --------------------------------------------------------------------------------------------------------
@query("SELECT feature, sample, round(value * 1e3 / sum(value) OVER (PARTITION BY sample), 6) AS value FROM cells")
def cpk(s: SparkSession, d: str) -> DataFrame:
    return matrix.per_sample_share(cells(s, d), 1e3).withColumn("value", F.round("value", 6))


@query("SELECT feature, sample, CASE WHEN value >= 100 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value FROM cells")
def binary_matrix(s: SparkSession, d: str) -> DataFrame:
    return matrix.binary(matrix.below_as_null(cells(s, d), 100).na.fill(0.0, ["value"]))


@query("SELECT feature, replicate AS sample, value FROM reps WHERE replicate IN (SELECT replicate FROM reps GROUP BY 1 HAVING sum(value) >= 1000 AND count(*) FILTER (value > 10) >= 20)")
def expressed_samples(s: SparkSession, d: str) -> DataFrame:
    return matrix.samples_where(reps(s, d), min_sum=1000, min_expressed=20, expressed_at=10)


@query("SELECT feature, sample, value FROM cells WHERE feature IN (SELECT feature FROM cells GROUP BY feature ORDER BY max(value) DESC, feature LIMIT 50)")
def top_expressed_rows(s: SparkSession, d: str) -> DataFrame:
    return matrix.top_rows(cells(s, d), 50)


@query("SELECT x.sample AS a, y.sample AS b, round(1 - sum(CASE WHEN x.value > 0 AND y.value > 0 THEN 1 ELSE 0 END) / count(*), 6) AS distance FROM cells x JOIN cells y USING (feature) WHERE x.sample < y.sample GROUP BY ALL")
def jaccard_distances(s: SparkSession, d: str) -> DataFrame:
    return matrix.sample_distance(cells(s, d), "jaccard").withColumn("distance", F.round("distance", 6))


@query()
def correlated_features(s: SparkSession, d: str) -> DataFrame:
    """The features divisible by 100 against all."""
    return matrix.correlated_features(reps(s, d), reps(s, d).where("feature % 100 = 0").select("feature").distinct(), 5, 0.5)


@query("SELECT x.s AS a, y.s AS b FROM (SELECT DISTINCT l_returnflag || l_linenumber AS s FROM lineitem) x JOIN (SELECT DISTINCT l_returnflag || l_linenumber AS s FROM lineitem) y ON x.s < y.s")
def contrasts(s: SparkSession, d: str) -> DataFrame:
    return tables.contrasts(rep_map(s, d).select(F.col("replicate").alias("sample")))


@query("SELECT feature, sample FROM (SELECT feature, 'A' AS sample FROM rates WHERE va > vn * 1.5 AND va > vr * 1.5 UNION ALL SELECT feature, 'N' FROM rates WHERE vn > va * 1.5 AND vn > vr * 1.5 UNION ALL SELECT feature, 'R' FROM rates WHERE vr > va * 1.5 AND vr > vn * 1.5)")
def up_against_all(s: SparkSession, d: str) -> DataFrame:
    w = wide_rates(s, d)
    rows = None
    for a, b in (("a", "n"), ("a", "r"), ("n", "r")):
        x, y = F.col(f"v{a}"), F.col(f"v{b}")
        de = w.select("feature", F.lit(a.upper()).alias("a"), F.lit(b.upper()).alias("b"), F.when(x > y * 1.5, 1.0).when(y > x * 1.5, -1.0).alias("log_fc")).where("log_fc is not null")
        rows = de if rows is None else rows.union(de)
    return tables.up_against_all(rows)


@query("SELECT feature, round(log_fc, 6) AS log_fc FROM changes WHERE abs(log_fc) >= 0.2 AND fdr <= 0.1")
def best_de_rows(s: SparkSession, d: str) -> DataFrame:
    return tables.best_per_feature(changes(s, d), 0.2, 0.1).select("feature", F.round("log_fc", 6).alias("log_fc"))


@query("SELECT feature, round(log2((va + 0.1) / (vr + 0.1)), 6) AS log2_ratio, va AS expr_a, vr AS expr_b FROM changes JOIN rates USING (feature) WHERE fdr <= 0.05")
def pairwise_summary(s: SparkSession, d: str) -> DataFrame:
    return reports.pairwise_summary(changes(s, d), cells(s, d), "A", "R", 0.05, 0.1).withColumn("log2_ratio", F.round("log2_ratio", 6))


_ONLY = "array_to_string(list_sort(list_filter(list_distinct(list({0})), lambda x: NOT list_contains(list({1}), x))), ',') AS {0}"


@query(f"""SELECT feature, {_ONLY.format('up', 'down')}, {_ONLY.format('down', 'up')}, (min(hi) - max(lo)) / (max(lo) + 1) AS priority FROM (
 SELECT feature, CASE WHEN x > y THEN a ELSE b END AS up, CASE WHEN x > y THEN b ELSE a END AS down, greatest(x, y) AS hi, least(x, y) AS lo FROM (
  SELECT feature, 'A' AS a, 'N' AS b, va AS x, vn AS y FROM rates UNION ALL SELECT feature, 'A', 'R', va, vr FROM rates UNION ALL SELECT feature, 'N', 'R', vn, vr FROM rates) WHERE x > y * 1.5 OR y > x * 1.5) GROUP BY feature""")
def feature_classes(s: SparkSession, d: str) -> DataFrame:
    w = wide_rates(s, d)
    rows = None
    for a, b in (("a", "n"), ("a", "r"), ("n", "r")):
        x, y = F.col(f"v{a}"), F.col(f"v{b}")
        de = w.where((x > y * 1.5) | (y > x * 1.5)).select("feature", F.when(x > y, a.upper()).otherwise(b.upper()).alias("up"), F.when(x > y, b.upper()).otherwise(a.upper()).alias("down"), F.greatest(x, y).alias("up_expr"), F.least(x, y).alias("down_expr"))
        rows = de if rows is None else rows.union(de)
    return reports.classified(rows)


@query("SELECT feature, sample, round(value * 1e9 / (length * lib_size * norm_factor), 3) AS value FROM cells JOIN genemap USING (feature) JOIN ({}) USING (sample)".format(ORACLE_SQL["tmm_norm"].replace("round(pow(2, max(t) - avg(max(t)) OVER ()), 6)", "pow(2, max(t) - avg(max(t)) OVER ())")))
def tmm_fpkm(s: SparkSession, d: str) -> DataFrame:
    c = cells(s, d)
    return matrix.tmm_fpkm(c, genemap(s, d).select("feature", "length"), matrix.tmm_factors(c)).withColumn("value", F.round("value", 3))


@query()
def batch_corrected(s: SparkSession, d: str) -> DataFrame:
    m = rep_map(s, d)
    groups = m.select(F.col("replicate").alias("sample"), F.col("sample").alias("grp"))
    batches = m.select(F.col("replicate").alias("sample"), (F.substring("replicate", 2, 2).cast("int") % 2).alias("batch"))
    return matrix.without_batch_effects(reps(s, d), batches, groups)


# Intervals and structures ----------------------------------------------------------------------------------------
@query("SELECT scaffold, core, lend, rend FROM (SELECT scaffold, core, min(lend) AS lend, max(rend) AS rend FROM f1 GROUP BY ALL HAVING count(*) = 2 AND max(rend) - min(lend) + 1 BETWEEN 20 AND 200) UNION ALL SELECT f.scaffold, f.core, f.lend, f.rend FROM f1 f JOIN (SELECT scaffold, core FROM f1 GROUP BY ALL HAVING NOT (count(*) = 2 AND max(rend) - min(lend) + 1 BETWEEN 20 AND 200)) USING (scaffold, core)".replace("f1", "(SELECT scaffold, okey AS core, line % 2 AS side, lend, rend FROM frags QUALIFY row_number() OVER (PARTITION BY scaffold, okey, line % 2 ORDER BY lend, rend) = 1)"))
def fragment_pairing(s: SparkSession, d: str) -> DataFrame:
    x = frags(s, d).select("scaffold", F.col("okey").alias("core"), (F.col("line") % 2).alias("side"), "lend", "rend")
    return intervals.paired_fragments(x, 20, 200)


@query("SELECT scaffold, lend, CAST(max(rend) AS BIGINT) AS rend FROM (SELECT scaffold, rend + 1 AS lend, nxt - 1 AS rend FROM (SELECT scaffold, rend, lead(lend) OVER (PARTITION BY scaffold ORDER BY lend) AS nxt FROM (SELECT scaffold, min(lend) AS lend, max(rend) AS rend FROM (SELECT *, sum(new) OVER (PARTITION BY scaffold ORDER BY lend, rend, okey, line) AS g FROM (SELECT *, CASE WHEN lend <= max(rend) OVER (PARTITION BY scaffold ORDER BY lend, rend, okey, line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM frags)) GROUP BY scaffold, g)) WHERE nxt > rend + 1) GROUP BY ALL")
def introns(s: SparkSession, d: str) -> DataFrame:
    """Gaps between merged exons."""
    return intervals.introns_of(intervals.merged(frags(s, d)), "scaffold")


@query("SELECT scaffold, okey AS name, line, CAST(sum(new) OVER (PARTITION BY scaffold ORDER BY lend, rend, okey * 10 + line) AS BIGINT) AS locus FROM (SELECT *, CASE WHEN lend <= max(rend) OVER (PARTITION BY scaffold ORDER BY lend, rend, okey * 10 + line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM frags)")
def locus_groups(s: SparkSession, d: str) -> DataFrame:
    x = frags(s, d).withColumn("strand", F.lit("+")).withColumn("name", F.col("okey") * 10 + F.col("line"))
    return intervals.locus_groups(x).select("scaffold", F.col("okey").alias("name"), "line", "locus")


@query("""SELECT scaffold, lend, rend, CAST(max(code) AS INTEGER) AS code FROM (SELECT scaffold, lend, rend, coalesce(c, 0) AS code FROM (SELECT scaffold, pos AS lend, lead(pos) OVER (PARTITION BY scaffold ORDER BY pos) - 1 AS rend FROM (SELECT DISTINCT scaffold, lend AS pos FROM frags UNION SELECT scaffold, rend + 1 FROM frags)) p
LEFT JOIN (SELECT scaffold AS s2, lend AS l2, rend AS r2, 1 + line % 5 AS c FROM frags) ON s2 = scaffold AND l2 <= rend AND r2 >= lend WHERE rend IS NOT NULL) GROUP BY ALL""")
def base_classes(s: SparkSession, d: str) -> DataFrame:
    return intervals.base_classes(frags(s, d).withColumn("code", (F.col("line") % 5 + 1).cast("int")))


@query("""SELECT DISTINCT x.gene, 'alt_donor' AS kind, x.lend, y.lend AS rend FROM ii x JOIN ii y ON x.gene = y.gene AND x.rend = y.rend AND x.lend < y.lend
UNION ALL SELECT DISTINCT x.gene, 'alt_acceptor', x.rend, y.rend FROM ii x JOIN ii y ON x.gene = y.gene AND x.lend = y.lend AND x.rend < y.rend
UNION ALL SELECT gene, 'retained_intron', lend, rend FROM ii x WHERE EXISTS (SELECT 1 FROM ii y WHERE y.gene = x.gene AND y.lend < x.lend AND y.rend > x.rend)
UNION ALL SELECT gene, 'skipped_exon', lend, rend FROM ii x WHERE EXISTS (SELECT 1 FROM ii y WHERE y.gene = x.gene AND y.lend < x.lend AND y.rend > x.rend)""".replace("ii ", "(SELECT DISTINCT scaffold AS gene, lend, rend FROM frags) "))
def splice_sites(s: SparkSession, d: str) -> DataFrame:
    """All shipments as introns, and as the exons that may retain or be skipped by them."""
    i = frags(s, d).select(F.col("scaffold").alias("gene"), F.col("okey").alias("transcript"), F.lit("+").alias("strand"), "lend", "rend")
    return intervals.splice_events(i, i)


@query("SELECT gene, transcript, ord, node, lend, rend FROM (SELECT o_custkey AS gene, o_orderkey AS transcript, unnest([0, 1]) AS ord, unnest([CAST(o_orderkey % 7 AS INTEGER), CAST(o_orderkey % 7 + 1 AS INTEGER)]) AS node, unnest([0, 101]) AS lend, unnest([100, 150]) AS rend FROM orders)")
def path_nodes(s: SparkSession, d: str) -> DataFrame:
    n = F.col("o_orderkey") % 7
    x = read(s, d, "orders").select(F.col("o_custkey").alias("gene"), F.col("o_orderkey").alias("transcript"), F.format_string("[%d:0-100 %d:101-150]", n, n + 1).alias("path"))
    return genes.path_nodes(x)


@query()
def supertranscripts(s: SparkSession, d: str) -> DataFrame:
    """Orders of a customer as transcripts, the status and priority of each as nodes."""
    o = read(s, d, "orders")
    n = F.array(F.lit("AC"), F.when(F.col("o_orderstatus") == "F", "GGT").otherwise("TTA"), F.substring("o_orderpriority", 1, 1), F.lit("CATG"))
    x = o.select(F.col("o_custkey").alias("gene"), F.col("o_orderkey").cast("string").alias("transcript"), F.posexplode(n).alias("ord", "sequence")).withColumn("node", F.concat(F.col("ord").cast("string"), "sequence"))
    return genes.supertranscripts(x).select("gene", "sequence", F.size("blocks").alias("n_blocks"))


@query("SELECT accession || ':' || p AS name, substr(sequence, p, 50) AS left, reverse(translate(substr(sequence, p + 150, 50), 'ACGT', 'TGCA')) AS right FROM (SELECT accession, sequence, CAST(unnest(range(1, length(sequence) - 198, 40)) AS INTEGER) AS p FROM seqs WHERE length(sequence) >= 200)")
def simulated_reads(s: SparkSession, d: str) -> DataFrame:
    return tables.simulated_pairs(seqs(s, d), 50, 200, 40)


@query("SELECT accession, isoform, length(s) AS length FROM (SELECT accession, 'isoA' AS isoform, sequence AS s FROM seqs WHERE length(sequence) >= 500 UNION ALL SELECT accession, 'isoB', substr(sequence, 1, 200) || substr(sequence, 301) FROM seqs WHERE length(sequence) >= 500)")
def bubbles(s: SparkSession, d: str) -> DataFrame:
    return tables.bubbles(seqs(s, d)).select("accession", "isoform", F.length("sequence").cast("long").alias("length"))


# Graphs ----------------------------------------------------------------------------------------------------------
@query(f"SELECT node, CAST(sum(i) AS BIGINT) AS n_in, CAST(sum(o) AS BIGINT) AS n_out FROM (SELECT a AS node, 0 AS i, 1 AS o FROM (SELECT DISTINCT a, b FROM ({_PART_EDGES})) UNION ALL SELECT b, 1, 0 FROM (SELECT DISTINCT a, b FROM ({_PART_EDGES}))) GROUP BY node")
def node_degrees(s: SparkSession, d: str) -> DataFrame:
    e = _part_edges(s, d).distinct().select(F.col("a").alias("src"), F.col("b").alias("dst"), F.lit(1).cast("long").alias("weight"))
    return kmers.degrees(e).select("node", "n_in", "n_out")


@query(f"SELECT least(a, b) AS a, greatest(a, b) AS b, max(n) AS n FROM (SELECT a, b, count(*) AS n FROM ({_PART_EDGES}) GROUP BY ALL) GROUP BY 1, 2")
def best_links(s: SparkSession, d: str) -> DataFrame:
    return graphs.best_links(_part_edges(s, d).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))


@query("SELECT src, dst, weight FROM e0 WHERE src IN (SELECT kmer FROM k0) AND dst IN (SELECT kmer FROM k0)".replace("e0", "(SELECT src, dst, count(*) AS weight FROM (SELECT unnest(list_transform(range(1, length(sequence) - 11), lambda i: {'src': substr(sequence, i, 12), 'dst': substr(sequence, i + 1, 12)}), recursive := true) FROM seqs WHERE length(sequence) > 12) GROUP BY ALL)").replace("k0", "(SELECT kmer FROM (SELECT unnest(list_transform(range(1, length(sequence) - 10), lambda i: substr(sequence, i, 12))) AS kmer FROM seqs WHERE length(sequence) >= 12) GROUP BY kmer HAVING count(*) >= 20)"))
def frequent_edges(s: SparkSession, d: str) -> DataFrame:
    x = seqs(s, d)
    return kmers.without_rare(kmers.edges(x, 12), kmers.counts(x, 12, canonical=False), 20)


@query()
def unitigs(s: SparkSession, d: str) -> DataFrame:
    return kmers.unitigs(kmers.edges(seqs(s, d), 24), 24)


@query()
def greedy_contigs(s: SparkSession, d: str) -> DataFrame:
    return kmers.greedy_contigs(seqs(s, d), 25, 3, 40)


@query()
def capped_clusters(s: SparkSession, d: str) -> DataFrame:
    return graphs.capped_clusters(_part_edges(s, d).groupBy("a", "b").agg(F.count(F.lit(1)).alias("weight")), 25)


_MERS = "SELECT DISTINCT accession, gene, least(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) AS kmer FROM (SELECT accession, gene, unnest(list_transform(range(1, length(sequence) - 23), lambda i: substr(sequence, i, 25))) AS kmer FROM seqs WHERE length(sequence) >= 25)"


@query(f"""SELECT * FROM (WITH k AS ({_MERS}), hits AS (SELECT accession, bundle, count(*) AS shared FROM (SELECT DISTINCT accession, kmer FROM k) JOIN (SELECT DISTINCT gene AS bundle, kmer FROM k) USING (kmer) GROUP BY ALL)
SELECT accession, bundle, shared, shared * 100.0 / total AS percent FROM hits JOIN (SELECT accession, count(DISTINCT kmer) AS total FROM k GROUP BY accession) USING (accession) WHERE shared * 100.0 / total >= 10 QUALIFY row_number() OVER (PARTITION BY accession ORDER BY shared DESC, bundle) = 1)""")
def read_bundles(s: SparkSession, d: str) -> DataFrame:
    """Each sequence's best source by shared k-mers."""
    x = seqs(s, d)
    return kmers.best_bundle(x, x.withColumnRenamed("gene", "bundle"), 25, 10.0)


@query()
def alignment_tiers(s: SparkSession, d: str) -> DataFrame:
    x = frags(s, d).join(read(s, d, "lineitem").select(F.col("l_orderkey").alias("okey"), F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("score")), ["okey", "line"])
    return hits.tiers(x.select(F.col("scaffold").alias("gene"), F.concat_ws(":", "okey", "line").alias("query"), "lend", "rend", "score", F.lit(100.0).alias("identity")))


# Partitioned outputs, profiles and streams -----------------------------------------------------------------------
@query("SELECT l_suppkey AS component, l_orderkey AS okey, l_linenumber AS line FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) <= 100")
def reads_per_component(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "lineitem").select(F.col("l_suppkey").alias("component"), F.col("l_orderkey").alias("okey"), F.col("l_linenumber").alias("line"))
    return reports.capped_per_group(x, "component", ["okey", "line"], 100)


@query("SELECT epoch(time_bucket(INTERVAL '1 minute', ts))::BIGINT AS minute, sum(value) FILTER (event_type = 'click') IS NULL AS no_click, count(*) AS n FROM events GROUP BY 1")
def time_matrix(s: SparkSession, d: str) -> DataFrame:
    m = reports.time_matrix(read(s, d, "events"), "ts", "event_type", "value", ["click"], "60 seconds")
    return m.select(F.unix_timestamp("time").alias("minute"), F.col("click").isNull().alias("no_click"), "n")


@query("SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS first, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL '30 minutes' THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, g")
def stream_session(s: SparkSession, d: str) -> DataFrame:
    """Sessions of users' events, from a stream of the table run to its end."""
    x = streams.run_to_end(streams.sessions(streams.read_stream(s, f"{d}/events.parquet"), "user_id", "30 minutes", late=ANY_LATE), "append_rest")
    return x.select("user_id", F.unix_timestamp("first").alias("first"), "n")


@query("SELECT event_type, epoch(time_bucket(INTERVAL '1 hour', ts))::BIGINT AS hour, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_windows(s: SparkSession, d: str) -> DataFrame:
    x = streams.run_to_end(streams.windows(streams.read_stream(s, f"{d}/events.parquet"), "event_type", "1 hour", late=ANY_LATE), "append_rest")
    return x.select("event_type", F.unix_timestamp("start").alias("hour"), "n", F.round("total", 4).alias("total"))


@query("SELECT user_id, CAST(least(count(*), 20) AS BIGINT) AS kept FROM events GROUP BY user_id")
def stream_cap(s: SparkSession, d: str) -> DataFrame:
    """At most twenty events of each user pass a stateful stream."""
    x = streams.run_to_end(streams.capped(streams.read_stream(s, f"{d}/events.parquet"), "user_id", 20), "append")
    return x.groupBy("user_id").agg(F.count(F.lit(1)).alias("kept"))
