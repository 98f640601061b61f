"""Formats written and read back, and the record operators, bound to whole tables beside the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import alignments as A
from ..functions import seq as S
from ..operators import genes, intervals, matrix, records, reports, tables
from ..sources import formats
from .bindings import _PART_EDGES, _part_edges, cells, changes, frags, query, read, rep_map, reps, seqs


def _written(s: SparkSession, lines: DataFrame, name: str) -> str:
    path = formats.scratch_path(s, name)
    lines.write.text(path)
    return path


def _items(s: SparkSession, d: str) -> DataFrame:
    """Shipped lines with integer columns."""
    i = lambda c: F.col(c).cast("int")
    x = read(s, d, "lineitem")
    return x.select(F.col("l_orderkey").alias("okey"), i("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), i("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("rf"), F.col("l_linestatus").alias("ls"))


_ITEMS = "(SELECT l_orderkey AS okey, CAST(l_linenumber AS INTEGER) AS line, l_partkey AS part, l_suppkey AS supp, CAST(l_quantity AS INTEGER) AS qty, l_extendedprice AS price, l_returnflag AS rf, l_linestatus AS ls FROM lineitem)"


def _sam(s: SparkSession, d: str) -> DataFrame:
    """Two ends of a made-up pair for each line; every third part is on the reverse strand."""
    x = _items(s, d).withColumn("second", F.col("line") % 2 == 0)
    flag = F.lit(1) + F.when(F.col("second"), 128).otherwise(64) + F.when(F.col("part") % 3 == 0, 16).otherwise(0)
    seq = F.concat(F.lit("AACG"), F.when(F.col("second"), "TT").otherwise("CCA"))
    return x.select(F.concat(F.lit("o"), "okey").alias("qname"), flag.alias("flag"), F.concat(F.lit("s"), "supp").alias("rname"), (F.col("part") % 1000 + 1).cast("int").alias("pos"), F.lit(60).alias("mapq"), F.format_string("%dM", F.length(seq)).alias("cigar"), F.lit("*").alias("rnext"), F.lit(0).alias("pnext"), F.col("qty").alias("tlen"), seq.alias("seq"), F.regexp_replace(F.regexp_replace(seq, "A", "I"), "[CGT]", "J").alias("qual"), F.concat(F.lit("NM:i:"), "line").alias("tag"), "line", (F.col("line") * 100_000_000 + F.col("part")).alias("ord"))


_SAM = f"(SELECT 'o' || okey AS qname, CAST(1 + CASE WHEN line % 2 = 0 THEN 128 ELSE 64 END + CASE WHEN part % 3 = 0 THEN 16 ELSE 0 END AS INTEGER) AS flag, 's' || supp AS rname, CAST(part % 1000 + 1 AS INTEGER) AS pos, 'AACG' || CASE WHEN line % 2 = 0 THEN 'TT' ELSE 'CCA' END AS seq, qty AS tlen, line, part, supp, line * 100000000 + part AS ord FROM {_ITEMS})"
_QUAL = "regexp_replace(regexp_replace({}, 'A', 'I', 'g'), '[CGT]', 'J', 'g')"
_READ = f"(SELECT qname, line, ord, CAST(CASE WHEN line % 2 = 0 THEN 2 ELSE 1 END AS INTEGER) AS pair_dir, CASE WHEN part % 3 = 0 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS sequence, CASE WHEN part % 3 = 0 THEN reverse({_QUAL.format('seq')}) ELSE {_QUAL.format('seq')} END AS quals FROM {_SAM})"


# Formats, written and read back ----------------------------------------------------------------------------------
@query(f"SELECT qname, flag, rname, pos, length(seq) || 'M' AS cigar, seq, 'NM:i:' || line AS tag FROM {_SAM}")
def sam_round_trip(s: SparkSession, d: str) -> DataFrame:
    x = _sam(s, d)
    lines = x.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual", "tag")]).alias("value"))
    head = s.createDataFrame([("@HD\tVN:1.6",), ("",)], "value string")
    return formats.read_sam(s, _written(s, head.union(lines), "sam")).select("qname", "flag", "rname", "pos", "cigar", "seq", F.get("tags", F.lit(0)).alias("tag"))


@query(f"SELECT qname || '/' || pair_dir AS read_name, pair_dir, sequence, quals FROM {_READ}")
def sam_to_reads(s: SparkSession, d: str) -> DataFrame:
    return records.sam_reads(_sam(s, d))


@query(f"SELECT qname AS core, min_by(sequence, ord) FILTER (pair_dir = 1) AS left, min_by(quals, ord) FILTER (pair_dir = 1) AS left_quals, min_by(sequence, ord) FILTER (pair_dir = 2) AS right, min_by(quals, ord) FILTER (pair_dir = 2) AS right_quals FROM {_READ} GROUP BY qname HAVING count(DISTINCT pair_dir) = 2")
def sam_to_pairs(s: SparkSession, d: str) -> DataFrame:
    return records.sam_pairs(_sam(s, d))


@query(f"SELECT okey, line, CASE WHEN line = 1 THEN NULL ELSE part % 3 <> 0 END AS verified, 'NM:i:' || line || ',XS:A:' || CASE WHEN part % 3 = 0 THEN '-' ELSE '+' END AS tags FROM {_ITEMS}")
def strand_tags(s: SparkSession, d: str) -> DataFrame:
    """Lines after an order's first have a tag that says +."""
    nm = F.concat(F.lit("NM:i:"), F.col("line").cast("string"))
    x = _items(s, d).withColumn("tags", F.when(F.col("line") == 1, F.array(nm)).otherwise(F.array(nm, F.lit("XS:A:+"))))
    y = records.strand_tagged(x, F.when(F.col("part") % 3 == 0, "-").otherwise("+"))
    return y.select("okey", "line", "verified", F.array_join("tags", ",").alias("tags"))


@query(f"SELECT count(*) AS n, count(*) FILTER (pos < before) AS out_of_order FROM (SELECT pos, lag(pos) OVER (PARTITION BY qname, rname ORDER BY ord) AS before FROM {_SAM})")
def coordinate_order(s: SparkSession, d: str) -> DataFrame:
    x = _sam(s, d)
    bad = records.out_of_order(x, "ord", "qname").agg(F.count(F.lit(1)).alias("out_of_order"))
    return x.agg(F.count(F.lit(1)).alias("n")).crossJoin(bad)  # one row each


def _psl(s: SparkSession, d: str) -> DataFrame:
    """Two blocks of qty and 10 bases, 5 apart in the query and line * 30 in the target."""
    x = _items(s, d)
    q, t = F.col("qty"), F.col("part") % 1000
    strand = F.when(F.col("part") % 3 == 0, "-").otherwise("+")
    parts = [q + 9, F.lit(1), F.lit(0), F.lit(0), F.lit(1), F.lit(5), F.lit(1), F.col("line") * 30, strand, F.concat(F.lit("o"), "okey", F.lit(":"), "line"), q + 20, F.lit(2), q + 17, F.concat(F.lit("s"), "supp"), F.lit(9999), t, t + q + F.col("line") * 30 + 10, F.lit(2), F.format_string("%d,10,", q), F.format_string("2,%d,", q + 7), F.format_string("%d,%d,", t, t + q + F.col("line") * 30)]
    return x.select(F.concat_ws("\t", *[p.cast("string") for p in parts]).alias("value"))


@query(f"""SELECT 'o' || okey || ':' || line AS query, 's' || supp AS target, round(100.0 * (qty + 9) / (qty + 10), 6) AS identity, (part % 1000 + 1) || '-' || (part % 1000 + qty) || ',' || (part % 1000 + qty + line * 30 + 1) || '-' || (part % 1000 + qty + line * 30 + 10) AS target_blocks,
CASE WHEN part % 3 = 0 THEN (qty + 18) || '-19,13-4' ELSE '3-' || (qty + 2) || ',' || (qty + 8) || '-' || (qty + 17) END AS query_blocks FROM {_ITEMS}""")
def psl_round_trip(s: SparkSession, d: str) -> DataFrame:
    x = formats.psl_blocks(formats.read_psl(s, _written(s, _psl(s, d), "psl")))
    show = lambda c: F.array_join(F.transform(c, lambda b: F.concat_ws("-", b.lend.cast("string"), b.rend.cast("string"))), ",")
    return x.select("query", "target", F.round(A.psl_identity(F.col("matches"), F.col("mismatches")), 6).alias("identity"), show("t_blocks").alias("target_blocks"), show("q_blocks").alias("query_blocks"))


@query(f"SELECT 'o' || okey || ':' || line AS qname, CAST(CASE WHEN part % 3 = 0 THEN 16 ELSE 0 END AS INTEGER) AS flag, 's' || supp AS rname, CAST(part % 1000 + 1 AS INTEGER) AS pos, '2S' || qty || 'M5I' || (line * 30) || 'N10M3S' AS cigar FROM {_ITEMS}")
def psl_to_sam(s: SparkSession, d: str) -> DataFrame:
    return records.psl_sam(formats.psl_blocks(formats.read_psl(s, _written(s, _psl(s, d), "psl"))))


@query(f"SELECT 's' || supp AS acc, CAST(part AS INTEGER) AS pos, rf AS ref, ls AS allele, CAST(qty AS VARCHAR) AS dp, CASE WHEN line % 2 = 0 THEN 'true' END AS db FROM {_ITEMS}")
def vcf_round_trip(s: SparkSession, d: str) -> DataFrame:
    info = F.concat(F.lit("DP="), "qty", F.when(F.col("line") % 2 == 0, ";DB").otherwise(""), F.lit(";DP=0;X=a=b"))
    lines = _items(s, d).select(F.concat_ws("\t", F.concat(F.lit("s"), "supp"), "part", F.lit("."), "rf", "ls", F.lit("."), F.lit("PASS"), info).alias("value"))
    x = formats.read_vcf(s, _written(s, lines, "vcf"))
    return x.select("acc", "pos", "ref", "allele", F.col("info")["DP"].alias("dp"), F.col("info")["DB"].alias("db"))


@query(f"SELECT 's' || supp AS chrom, okey || ':' || line AS name, CASE WHEN part % 3 = 0 THEN '-' ELSE '+' END AS strand, (part + 1) || '-' || (part + qty) || ',' || (part + qty + 101) || '-' || (part + qty + 110) AS blocks FROM {_ITEMS}")
def bed_round_trip(s: SparkSession, d: str) -> DataFrame:
    p, q = F.col("part").cast("int"), F.col("qty")
    blocks = F.array(F.struct((p + 1).alias("lend"), (p + q).alias("rend")), F.struct((p + q + 101).alias("lend"), (p + q + 110).alias("rend")))
    line = formats.bed12(F.concat(F.lit("s"), "supp"), F.concat_ws(":", "okey", "line"), F.when(F.col("part") % 3 == 0, "-").otherwise("+"), blocks)
    x = formats.read_bed(s, _written(s, _items(s, d).select(line.alias("value")), "bed"))
    return x.select("chrom", "name", "strand", F.array_join(F.transform("blocks", lambda b: F.concat_ws("-", b.lend.cast("string"), b.rend.cast("string"))), ",").alias("blocks"))


_EXONS = f"SELECT 's' || supp AS gene, 'o' || okey AS transcript, array_to_string(list_transform(list_sort(list(struct_pack(a := line * 100, b := line * 100 + qty))), lambda x: x.a || '-' || x.b), ',') AS exons FROM {_ITEMS} GROUP BY ALL"


def _exon_lines(s: SparkSession, d: str, attributes) -> DataFrame:
    start = F.col("line") * 100
    return _items(s, d).select(F.concat_ws("\t", F.lit("c"), F.lit("x"), F.lit("exon"), start.cast("string"), (start + F.col("qty")).cast("string"), F.lit("."), F.lit("+"), F.lit("."), attributes).alias("value"))


def _shown(x: DataFrame) -> DataFrame:
    return x.select("gene", "transcript", F.array_join(F.transform("exons", lambda b: F.concat_ws("-", b.lend.cast("string"), b.rend.cast("string"))), ",").alias("exons"))


@query(_EXONS.replace(_ITEMS, "(SELECT okey, supp, line, max(qty) AS qty FROM {} GROUP BY ALL)".format(_ITEMS)))
def gtf_round_trip(s: SparkSession, d: str) -> DataFrame:
    lines = _exon_lines(s, d, F.format_string('gene_id "s%d"; transcript_id "o%d"; tag "a"; tag "b";', "supp", "okey"))
    return _shown(formats.gtf_transcripts(formats.read_gtf(s, _written(s, lines, "gtf"))))


@query(_EXONS.replace("'o' || okey AS transcript", "'o' || okey || '.s' || supp AS transcript"))
def gff3_round_trip(s: SparkSession, d: str) -> DataFrame:
    exons = _exon_lines(s, d, F.format_string("ID=e;Parent=o%d.s%d;Note=a%%3Bb", "okey", "supp"))
    mrna = _items(s, d).select("okey", "supp").distinct().select(F.format_string("c\tx\tmRNA\t1\t9999\t.\t+\t.\tID=o%d.s%d;Parent=s%d", "okey", "supp", "supp").alias("value"))
    return _shown(formats.gff3_transcripts(formats.read_gff3(s, _written(s, exons.union(mrna), "gff3"))))


@query("SELECT 's' || s_nationkey AS scaffold, CAST(pos AS INTEGER) AS pos, CASE WHEN pos % 2 = 0 THEN pos / 2.0 ELSE 0.0 END::DOUBLE AS value FROM (SELECT s_nationkey, unnest(range(1, 2 * count(*) + 1)) AS pos FROM supplier GROUP BY s_nationkey)")
def wig_round_trip(s: SparkSession, d: str) -> DataFrame:
    """A nation's suppliers as values at every second position; the gaps are filled."""
    n = read(s, d, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    body = F.array_join(F.transform(F.sequence(F.lit(1), F.col("n").cast("int")), lambda i: F.concat_ws(" ", (i * 2).cast("string"), i.cast("string"))), "\n")
    path = _written(s, n.select(F.concat(F.lit("variableStep chrom=s"), "s_nationkey", F.lit("\n"), body).alias("value")), "wig")
    return formats.filled_wig(formats.read_wig(s, path))


@query(f"SELECT 'o' || okey AS query, 'p' || part AS target, qty::DOUBLE AS identity, line AS length, round(price, 2) AS score FROM {_ITEMS}")
def outfmt6_round_trip(s: SparkSession, d: str) -> DataFrame:
    z = F.lit("0")
    lines = _items(s, d).select(F.concat_ws("\t", F.concat(F.lit("o"), "okey"), F.concat(F.lit("p"), "part"), "qty", "line", z, z, z, z, z, z, F.lit("1e-30"), F.format_string("%.2f", "price")).alias("value"))
    return formats.read_outfmt6(s, _written(s, lines, "outfmt6")).select("query", "target", "identity", "length", "score")


@query("SELECT CAST(feature AS VARCHAR) AS feature, sample, coalesce(max(value) FILTER (s2 = sample), 0) AS value FROM (SELECT feature, sample AS s2, value FROM cells) CROSS JOIN (SELECT unnest(['A', 'N', 'R']) AS sample) GROUP BY feature, sample")
def matrix_round_trip(s: SparkSession, d: str) -> DataFrame:
    path = formats.scratch_path(s, "matrix")
    formats.write_delimited(matrix.to_wide(cells(s, d), ["A", "N", "R"], 0.0).coalesce(1), path)
    return formats.read_matrix(s, path)


@query("SELECT l_returnflag AS sample, l_returnflag || l_linenumber AS replicate, 'l' || l_linenumber || '.fq' AS left, CASE WHEN l_linenumber % 2 = 0 THEN 'r' || l_linenumber || '.fq' END AS right FROM lineitem GROUP BY ALL")
def samples_file(s: SparkSession, d: str) -> DataFrame:
    x = _items(s, d).select("rf", "line").distinct()
    line = F.concat(F.col("rf"), F.lit("\t"), "rf", "line", F.lit("  l"), "line", F.lit(".fq"), F.when(F.col("line") % 2 == 0, F.concat(F.lit(" r"), "line", F.lit(".fq"))).otherwise(""))
    path = _written(s, s.createDataFrame([("# samples",), ("",)], "value string").union(x.select(line.alias("value"))), "samples")
    return formats.read_samples(s, path)


@query("SELECT CAST(feature AS VARCHAR) AS feature, sample, value AS count, round(value / 2, 3) AS tpm FROM cells")
def quant_files(s: SparkSession, d: str) -> DataFrame:
    paths = {}
    for n in ("A", "N", "R"):
        paths[n] = formats.scratch_path(s, "quant")
        x = cells(s, d).where(F.col("sample") == n).select(F.col("feature").alias("Name"), F.lit(1).alias("Length"), F.lit(1).alias("EffectiveLength"), F.round(F.col("value") / 2, 3).alias("TPM"), F.col("value").alias("NumReads"))
        formats.write_delimited(x, paths[n])
    return formats.read_quant(s, paths)


@query("SELECT 'n' || n_nationkey AS key, n_name || ' | x' AS value FROM nation")
def log_lines(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "nation").select(F.concat(F.lit("  n"), "n_nationkey", F.lit(" |\t"), "n_name", F.lit(" | x")).alias("value"))
    return formats.log_table(s, _written(s, x.union(s.createDataFrame([("no key",)], "value string")), "log")).select("key", "value")


@query("SELECT accession, sequence FROM seqs WHERE sequence <> ''")
def wrapped_fasta(s: SparkSession, d: str) -> DataFrame:
    x = seqs(s, d).where("sequence <> ''").select(F.col("accession"), "sequence")
    path = formats.scratch_path(s, "fasta")
    formats.write_fasta(x, path, 50)
    return formats.read_fasta(s, path).select(F.col("accession").cast("long").alias("accession"), "sequence")


@query("SELECT accession || chr(9) || '.' || chr(9) || k || chr(9) || '1' || chr(9) || length(sequence) || chr(9) || '.' || chr(9) || '+' || chr(9) || '.' || chr(9) || 'gene_id \"' || accession || '\"; transcript_id \"' || accession || '\";' AS value FROM seqs CROSS JOIN (SELECT unnest(['transcript', 'exon']) AS k)")
def sequence_gtf(s: SparkSession, d: str) -> DataFrame:
    return formats.sequence_gtf(seqs(s, d).withColumn("accession", F.col("accession").cast("string")))


# Reads and identifiers -------------------------------------------------------------------------------------------
@query("SELECT p_partkey, CAST(i - 1 AS INTEGER) AS i, w[i] AS token FROM (SELECT p_partkey, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT p_partkey, list_filter(regexp_split_to_array(p_name, '\\s+'), lambda x: x <> '') AS w FROM part))")
def row_tokens(s: SparkSession, d: str) -> DataFrame:
    return reports.tokens(read(s, d, "part"), "p_partkey", "p_name")


@query("SELECT sha224 AS digest, n FROM (SELECT count(*) AS n, max(sequence) AS sequence FROM seqs GROUP BY sequence HAVING count(*) > 1) CROSS JOIN LATERAL (SELECT md5(sequence) AS sha224)")
def duplicate_records(s: SparkSession, d: str) -> DataFrame:
    """Sequences of several records, by another digest than the operator's."""
    x = seqs(s, d)
    found = tables.duplicate_sequences(x)
    return x.select(F.sha2("sequence", 224).alias("d"), F.md5("sequence").alias("digest")).distinct().join(found.withColumnRenamed("digest", "d"), "d").select("digest", "n")


@query("SELECT o_orderkey FROM orders WHERE o_custkey % 2 = 0 OR NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber >= 3)")
def sampled_or_unaligned(s: SparkSession, d: str) -> DataFrame:
    """Orders of every second customer, or without a third line."""
    o = read(s, d, "orders").select("o_orderkey", "o_custkey")
    lines = read(s, d, "lineitem").where("l_linenumber >= 3").select(F.col("l_orderkey").alias("o_orderkey"))
    return records.sampled_or_unaligned(o, o.where("o_custkey % 2 = 0"), lines, "o_orderkey").select("o_orderkey")


@query("SELECT 'dir/s' || s_suppkey || '.fq.gz' AS name, 'dir/s' || s_suppkey || '_R1.fq.gz' AS left, CASE WHEN s_suppkey % 5 <> 0 THEN 'dir/s' || s_suppkey || '_R2.fq.gz' END AS right FROM supplier")
def file_pairs(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "supplier").select("s_suppkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("e")).where("e = 1 or s_suppkey % 5 <> 0")
    return records.file_pairs(x.select(F.format_string("dir/s%d_R%d.fq.gz", "s_suppkey", "e").alias("path")))


@query("SELECT accession, n, total FROM (SELECT gene AS accession, count(*) AS n, CAST(sum(length(sequence)) AS BIGINT) AS total FROM seqs GROUP BY gene UNION ALL SELECT 'LR$|' || gene, count(*), CAST(sum(length(sequence)) AS BIGINT) FROM seqs WHERE length(sequence) > 300 GROUP BY gene)")
def long_reads(s: SparkSession, d: str) -> DataFrame:
    """Sequences by source, with long ones again as marked long reads."""
    x = seqs(s, d).select(F.col("gene").alias("accession"), "sequence")
    both = records.with_long_reads(x, x.where("length(sequence) > 300"))
    marked, others = records.parted_by_mark(both)
    return others.unionByName(marked).groupBy("accession").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("sequence")).cast("long").alias("total"))


@query("SELECT CASE WHEN s_suppkey % 3 = 0 THEN n_name || '^' ELSE '' END || s_name AS accession FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def prefixed_names(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "supplier")
    names = x.where("s_suppkey % 3 = 0").join(read(s, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("accession"), F.col("n_name").alias("name"))
    return records.prefixed(x.select(F.col("s_name").alias("accession")), names)


@query("SELECT s_suppkey AS transcript, CASE WHEN s_suppkey % 4 <> 0 THEN s_nationkey END AS gene, CASE WHEN s_suppkey % 4 <> 0 AND s_nationkey < 20 THEN n_name END AS name FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def gene_annotations(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "supplier").select(F.col("s_suppkey").alias("transcript"), F.col("s_nationkey").alias("gene"))
    return records.gene_annotations(x, x.where("transcript % 4 <> 0"), read(s, d, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("gene"), F.col("n_name").alias("name")))


@query("SELECT 'A_DN1_c' || o_custkey || '_g1_i' || o_orderkey || coalesce('|' || CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, '|' || CASE WHEN o_custkey % 3 = 0 THEN 'gene' END, '') AS accession FROM orders")
def names_with_hits(s: SparkSession, d: str) -> DataFrame:
    """Every second transcript has a hit of its own, and the components of every third customer have one."""
    gene = F.format_string("A_DN1_c%d_g1", "o_custkey")
    o = read(s, d, "orders").select(F.concat(gene, F.lit("_i"), "o_orderkey").alias("accession"), gene.alias("gene"), "o_orderkey", "o_custkey", "o_orderpriority")
    own = o.where("o_orderkey % 2 = 0").select("accession", F.explode(F.array(F.struct(F.lit(0).alias("ord"), F.lit("old").alias("hit")), F.struct(F.lit(1).alias("ord"), F.col("o_orderpriority").alias("hit")))).alias("h")).select("accession", "h.*")
    of = o.where("o_custkey % 3 = 0").select(F.col("gene").alias("accession"), F.lit(0).alias("ord"), F.lit("gene").alias("hit")).distinct()
    return records.with_best_hit(o.select("accession"), own.unionByName(of))


@query("SELECT event_id, regexp_replace(event_type || chr(1) || chr(127) || 'x', '[\\x00-\\x08\\x7f]', '', 'g') AS text, event_type || chr(9) || user_id AS fields FROM events")
def cleaned_lines(s: SparkSession, d: str) -> DataFrame:
    line = F.concat_ws("\t", F.lit("a"), "event_type", F.lit("b"), F.col("user_id").cast("string"))
    return read(s, d, "events").select("event_id", records.without_control(F.concat("event_type", F.lit("\x01\x7fx"))).alias("text"), records.kept_columns(line, [3, 1]).alias("fields"))


@query("SELECT s_suppkey AS id, CASE WHEN s_nationkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) ELSE 'M' || s_nationkey END AS scaffold FROM supplier WHERE s_suppkey % 7 <> 0")
def placed_scaffolds(s: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.when(F.col("s_nationkey") % 2 == 0, "chr").otherwise("M"), F.col("s_nationkey").cast("string"), F.when(F.col("s_suppkey") % 7 == 0, "_random").otherwise(""))
    return records.renamed_scaffolds(read(s, d, "supplier").select(F.col("s_suppkey").alias("id"), name.alias("scaffold")))


@query("SELECT feature, round(value * m / length, 6) AS coverage FROM (SELECT feature, sum(value) AS value FROM cells GROUP BY feature) JOIN genemap USING (feature) CROSS JOIN (SELECT avg(length(sequence)) AS m FROM (SELECT sequence FROM seqs ORDER BY accession LIMIT 100)) WHERE value * m / length >= 200")
def covered_transcripts(s: SparkSession, d: str) -> DataFrame:
    p = read(s, d, "part").select(F.col("p_partkey").alias("feature"), F.col("p_size").alias("length"))
    q = cells(s, d).groupBy("feature").agg(F.sum("value").alias("count")).join(p, "feature")
    return records.covered_transcripts(q, seqs(s, d), 200, order="accession").select("feature", F.round("coverage", 6).alias("coverage"))


@query("SELECT l_orderkey AS okey, l_linenumber AS line, 0 AS missing FROM lineitem WHERE l_suppkey % 2 = 0 UNION ALL SELECT DISTINCT x, 0, 1 FROM (SELECT unnest([s_suppkey, -s_suppkey]) AS x FROM supplier WHERE s_suppkey % 2 = 0) WHERE x NOT IN (SELECT l_suppkey FROM lineitem)")
def listed_lines(s: SparkSession, d: str) -> DataFrame:
    """Lines of every second supplier; of the list's negative numbers there is none."""
    even = read(s, d, "supplier").where("s_suppkey % 2 = 0").select(F.explode(F.array(F.col("s_suppkey"), -F.col("s_suppkey"))).alias("supp"))
    kept, missing = records.listed_lines(_items(s, d), even, "supp")
    return kept.select("okey", "line", F.lit(0).alias("missing")).unionByName(missing.select(F.col("supp").alias("okey"), F.lit(0).alias("line"), F.lit(1).alias("missing")))


@query("SELECT cluster, accession FROM (SELECT p_brand AS cluster, p_partkey AS accession, p_size AS length, p_retailprice AS expr, max(p_size) OVER (PARTITION BY p_brand) AS longest FROM part) JOIN (SELECT cluster, max(expr) AS ref FROM (SELECT p_brand AS cluster, p_size AS length, p_retailprice AS expr, max(p_size) OVER (PARTITION BY p_brand) AS longest FROM part) WHERE length >= 0.9 * longest GROUP BY cluster) USING (cluster) WHERE expr >= 0.8 * ref")
def similar_with_expression(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "part").select(F.col("p_brand").alias("cluster"), F.col("p_partkey").alias("accession"), F.col("p_size").alias("length"), F.col("p_retailprice").alias("expr"))
    return records.similar_with_expression(x, least_expression=0.8)


@query(f"SELECT p_partkey AS node FROM part WHERE p_size >= 25 OR p_partkey IN (SELECT a FROM ({_PART_EDGES}) UNION SELECT b FROM ({_PART_EDGES}))")
def linked_or_long(s: SparkSession, d: str) -> DataFrame:
    e = _part_edges(s, d).toDF("src", "dst")
    return records.without_lone_nodes(read(s, d, "part").select(F.col("p_partkey").alias("node"), F.col("p_size").alias("length")), e, 25).select("node")


@query(f"SELECT a, b FROM ({_PART_EDGES}) WHERE a IN (SELECT p_partkey FROM part WHERE p_size > 20) AND b IN (SELECT p_partkey FROM part WHERE p_size > 20)")
def edges_in_reference(s: SparkSession, d: str) -> DataFrame:
    return records.in_both_ends(_part_edges(s, d), read(s, d, "part").where("p_size > 20").select("p_partkey"))


# Comparisons and counts ------------------------------------------------------------------------------------------
@query("SELECT feature, va AS value_a, vr AS value_b FROM rates WHERE va > 0 AND vr > 0")
def positive_in_both(s: SparkSession, d: str) -> DataFrame:
    one = lambda n: cells(s, d).where(F.col("sample") == n).select("feature", "value")
    return records.positive_in_both(one("A"), one("R"))


@query("SELECT s_suppkey AS hit, s_nationkey AS gene, coalesce(any_value(g.bal), max(t.bal)) AS value FROM supplier LEFT JOIN (SELECT CAST(c_custkey AS INTEGER) AS id, c_acctbal AS bal FROM customer WHERE c_custkey % 2 = 0) g ON g.id = s_nationkey LEFT JOIN (SELECT CAST(c_custkey AS INTEGER) AS id, c_acctbal AS bal FROM customer WHERE c_custkey % 2 = 0) t ON t.id IN (s_nationkey + 1, s_nationkey + 3) GROUP BY s_suppkey, s_nationkey")
def hits_with_values(s: SparkSession, d: str) -> DataFrame:
    h = read(s, d, "supplier").select(F.col("s_suppkey").alias("hit"), F.col("s_nationkey").alias("gene"), F.array(F.col("s_nationkey") + 1, F.col("s_nationkey") + 3).alias("transcripts"))
    v = read(s, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("int").alias("feature"), F.col("c_acctbal").alias("value"))
    return records.hits_with_values(h, v)


@query("SELECT component, kmers, reads FROM (SELECT l_suppkey AS component, CAST(sum(l_quantity) AS BIGINT) AS kmers FROM lineitem GROUP BY 1 HAVING sum(l_quantity) + 24 >= 1500) JOIN (SELECT s_suppkey AS component, CAST(1 AS BIGINT) AS reads FROM supplier WHERE s_suppkey % 3 <> 0) USING (component)")
def shared_components(s: SparkSession, d: str) -> DataFrame:
    g = read(s, d, "lineitem").select(F.col("l_suppkey").alias("component"), F.col("l_quantity").cast("long").alias("kmers"))
    return records.shared_components(g, read(s, d, "supplier").where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("component")), 1500)


@query(f"SELECT a, b, x.p_name AS name_a, y.p_name AS name_b FROM ({_PART_EDGES}) JOIN part x ON x.p_partkey = a JOIN part y ON y.p_partkey = b")
def named_pairs(s: SparkSession, d: str) -> DataFrame:
    return records.named_by_index(_part_edges(s, d), read(s, d, "part").select(F.col("p_partkey").alias("index"), F.col("p_name").alias("name"))).select("a", "b", "name_a", "name_b")


_SCORE = "(SELECT feature, fdr, row_number() OVER (ORDER BY fdr, feature) <= 50 AS top FROM {})"


@query(f"SELECT coalesce(g.feature, t.feature) AS feature, CASE WHEN g.fdr IS NOT NULL THEN round(-log10(greatest(g.fdr, 1e-300)), 6) END AS gene_score, CASE WHEN t.fdr IS NOT NULL THEN round(-log10(greatest(t.fdr, 1e-300)), 6) END AS trans_score, coalesce(g.top, false) AS gene_top, coalesce(t.top, false) AS trans_top FROM {_SCORE.format('(SELECT * FROM changes WHERE feature % 3 <> 0)')} g FULL JOIN {_SCORE.format('(SELECT * FROM changes WHERE feature % 5 <> 0)')} t USING (feature)")
def rank_comparison(s: SparkSession, d: str) -> DataFrame:
    c = changes(s, d)
    x = records.rank_comparison(c.where("feature % 3 <> 0"), c.where("feature % 5 <> 0"), 50)
    return x.select("feature", F.round("gene_score", 6).alias("gene_score"), F.round("trans_score", 6).alias("trans_score"), "gene_top", "trans_top")


@query("SELECT feature, round(log_fc, 6) AS log_fc FROM changes WHERE feature % 2 = 0")
def agreed_rows(s: SparkSession, d: str) -> DataFrame:
    c = changes(s, d)
    keys = c.where("feature % 2 = 0").select("feature", F.col("b").alias("a"), F.col("a").alias("b"))
    return records.agreed(c, keys).select("feature", F.round("log_fc", 6).alias("log_fc"))


@query("SELECT feature, round(log_fc, 6) AS log_fc, round(ma, 6) AS mean_a, round(mr, 6) AS mean_b, sign(log_fc) = sign(ma - mr) AS agrees FROM changes JOIN (SELECT feature, avg(value) FILTER (sample = 'A') AS ma, avg(value) FILTER (sample = 'R') AS mr FROM reps GROUP BY feature) USING (feature) WHERE ma IS NOT NULL AND mr IS NOT NULL")
def same_direction(s: SparkSession, d: str) -> DataFrame:
    long = reps(s, d).withColumnRenamed("sample", "replicate").join(rep_map(s, d), "replicate").select("feature", "sample", "value")
    x = records.same_direction(changes(s, d), long)
    return x.select("feature", F.round("log_fc", 6).alias("log_fc"), F.round("mean_a", 6).alias("mean_a"), F.round("mean_b", 6).alias("mean_b"), "agrees")


_PATH = "SELECT DISTINCT p FROM (SELECT '|' || string_agg(p, '|' ORDER BY line, p) || '|' AS p FROM (SELECT l_orderkey AS okey, l_linenumber AS line, CAST(l_suppkey % 5 AS VARCHAR) AS p FROM lineitem WHERE {}) GROUP BY okey)"


@query(f"WITH x AS ({_PATH.format('l_orderkey % 2 = 0')}), y AS ({_PATH.format('l_orderkey % 2 = 1')}) SELECT (SELECT count(*) FROM x WHERE p IN (SELECT p FROM y)) AS both, (SELECT count(*) FROM x WHERE NOT EXISTS (SELECT 1 FROM y WHERE contains(y.p, x.p))) AS only_a, (SELECT count(*) FROM y WHERE NOT EXISTS (SELECT 1 FROM x WHERE contains(x.p, y.p))) AS only_b")
def paths_apart(s: SparkSession, d: str) -> DataFrame:
    """Suppliers' classes along the lines of even orders, and of odd ones."""
    x = _items(s, d).groupBy("okey").agg(F.transform(F.array_sort(F.collect_list(F.struct("line", (F.col("supp") % 5).cast("string").alias("p")))), lambda r: r.p).alias("path"))
    return records.paths_apart(x.where("okey % 2 = 0"), x.where("okey % 2 = 1"))


_FLAGS = ["A", "N", "R"]


@query("SELECT s, round(coalesce(100.0 * a / sum(a) OVER (), 0), 6) AS A, round(coalesce(100.0 * n / sum(n) OVER (), 0), 6) AS N, round(coalesce(100.0 * r / sum(r) OVER (), 0), 6) AS R FROM (SELECT l_suppkey AS s, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1)")
def shares_by_file(s: SparkSession, d: str) -> DataFrame:
    x = records.crossed(_items(s, d), "supp", "rf", _FLAGS, share=True)
    return x.select(F.col("supp").alias("s"), *[F.round(c, 6).alias(c) for c in _FLAGS])


@query("SELECT l_suppkey AS component, count(DISTINCT l_partkey) FILTER (l_returnflag = 'A') AS A, count(DISTINCT l_partkey) FILTER (l_returnflag = 'N') AS N, count(DISTINCT l_partkey) FILTER (l_returnflag = 'R') AS R FROM lineitem GROUP BY 1")
def transcripts_by_file(s: SparkSession, d: str) -> DataFrame:
    return records.crossed(_items(s, d), "supp", "rf", _FLAGS, distinct="part").select(F.col("supp").alias("component"), *_FLAGS)


@query("SELECT l_suppkey AS transcript, count(*) AS total FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT (SELECT greatest(1, count(DISTINCT l_suppkey) * 20 // 100) FROM lineitem)")
def best_stranded(s: SparkSession, d: str) -> DataFrame:
    return records.best_stranded(_items(s, d).groupBy(F.col("supp").alias("transcript")).agg(F.count(F.lit(1)).alias("total")), 20)


@query(f"SELECT rf, count(*) FILTER (line >= 2) AS mapped, count(*) FILTER (line >= 2 AND qty >= 20 AND price >= 30000) AS good, round(1.0 * count(*) FILTER (line >= 2 AND qty >= 20 AND price >= 30000) / nullif(count(*) FILTER (line >= 2), 0), 6) AS ratio FROM {_ITEMS} GROUP BY rf")
def mapped_counts(s: SparkSession, d: str) -> DataFrame:
    x = _items(s, d).select("rf", F.col("line").alias("length"), F.col("qty").alias("pct_length"), F.col("price").alias("pct_identity"))
    return records.mapped_counts(x, "rf", 2, 20, 30000).withColumn("ratio", F.round("ratio", 6))


@query("SELECT threshold, any_value(features) AS features, max(length) FILTER (cum * 2 >= total) AS nx FROM (SELECT threshold, length, sum(length) OVER (PARTITION BY threshold ORDER BY length DESC) AS cum, sum(length) OVER (PARTITION BY threshold) AS total, count(*) OVER (PARTITION BY threshold) AS features FROM (SELECT CAST(unnest([0.0, 50.0, 200.0, 800.0]) AS DOUBLE) AS threshold) JOIN (SELECT feature, length, sum(value) AS expr FROM cells JOIN genemap USING (feature) GROUP BY ALL) ON expr >= threshold) GROUP BY threshold")
def nx_above(s: SparkSession, d: str) -> DataFrame:
    p = read(s, d, "part").select(F.col("p_partkey").alias("feature"), F.col("p_size").alias("length"))
    x = cells(s, d).groupBy("feature").agg(F.sum("value").alias("expr")).join(p, "feature")
    return records.nx_above(x, [0.0, 50.0, 200.0, 800.0])


@query("SELECT feature, CAST(len(u) AS INTEGER) AS ups, CAST(len(d) AS INTEGER) AS downs, CAST(len(u) + len(d) AS INTEGER) AS total, CAST(len(list_distinct(list_concat(u, d))) AS INTEGER) AS distinct_samples FROM (SELECT l_orderkey AS feature, list(DISTINCT CAST(l_suppkey AS VARCHAR)) FILTER (l_linenumber <= 2) AS u0, list(DISTINCT CAST(l_suppkey AS VARCHAR)) FILTER (l_linenumber > 1) AS d0 FROM lineitem GROUP BY 1) CROSS JOIN LATERAL (SELECT coalesce(u0, []) AS u, coalesce(d0, []) AS d)")
def up_and_down(s: SparkSession, d: str) -> DataFrame:
    part = lambda c: F.array_join(F.collect_set(F.when(F.expr(c), F.col("supp").cast("string"))), ",")
    return records.up_and_down(_items(s, d).groupBy(F.col("okey").alias("feature")).agg(part("line <= 2").alias("up"), part("line > 1").alias("down")))


@query("SELECT 'g' || l_suppkey AS name, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL SELECT 't' || l_partkey, count(*) FROM lineitem GROUP BY 1")
def map_names(s: SparkSession, d: str) -> DataFrame:
    maps = _items(s, d).groupBy("okey").agg(F.array_join(F.collect_list(F.format_string("g%d;t%d", "supp", "part")), ",").alias("names"))
    return records.map_names(maps).unionByName(records.map_names(maps, False)).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(DISTINCT l_suppkey) AS genes, count(DISTINCT l_partkey) AS transcripts FROM lineitem WHERE l_linestatus = 'F'")
def flagged_counts(s: SparkSession, d: str) -> DataFrame:
    return records.flagged_counts(_items(s, d).select(F.col("supp").alias("gene"), F.col("part").alias("transcript"), F.col("ls").alias("flag")), "F")


@query("SELECT p_brand AS brand, count(*) AS members, count(DISTINCT p_size % 7) AS parts, string_agg(DISTINCT CAST(p_size % 7 AS VARCHAR), '__' ORDER BY CAST(p_size % 7 AS VARCHAR)) AS names FROM part GROUP BY 1 HAVING count(DISTINCT p_size % 7) > 1")
def clusters_over_components(s: SparkSession, d: str) -> DataFrame:
    return records.spread_over_groups(read(s, d, "part").select(F.col("p_brand").alias("brand"), (F.col("p_size") % 7).alias("c")), "brand", "c")


@query("SELECT o_custkey AS gene, count(*) AS transcripts, count(DISTINCT o_orderpriority) AS categories, string_agg(DISTINCT o_orderpriority, '__' ORDER BY o_orderpriority) AS names FROM orders GROUP BY 1 HAVING count(*) > 1")
def category_groups(s: SparkSession, d: str) -> DataFrame:
    return records.category_groups(read(s, d, "orders").select(F.col("o_custkey").alias("gene"), F.col("o_orderkey").alias("transcript"), F.col("o_orderpriority").alias("category")))


@query("SELECT CAST(floor(p_size / 10.0 / 0.5) AS INTEGER) AS bin, CAST(row_number() OVER (PARTITION BY floor(p_size / 10.0 / 0.5) ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS rank, p_partkey AS feature FROM part")
def entropy_bins(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "part").select(F.col("p_partkey").alias("feature"), F.col("p_retailprice").alias("expr"), (F.col("p_size") / 10).alias("entropy"))
    return records.entropy_bins(x).select("bin", "rank", "feature")


_TLEN = f"(SELECT rname AS scaffold, pos, sum(d) AS d FROM (SELECT rname, pos, 1 AS d FROM {_SAM} WHERE tlen BETWEEN 10 AND 40 UNION ALL SELECT rname, pos + tlen + 1, -1 FROM {_SAM} WHERE tlen BETWEEN 10 AND 40) GROUP BY ALL HAVING sum(d) <> 0)"


@query(f"SELECT scaffold, lend, rend, depth FROM (SELECT scaffold, CAST(pos AS INTEGER) AS lend, CAST(lead(pos) OVER w - 1 AS INTEGER) AS rend, CAST(sum(d) OVER w AS BIGINT) AS depth FROM {_TLEN} WINDOW w AS (PARTITION BY scaffold ORDER BY pos)) WHERE depth > 0")
def template_depth(s: SparkSession, d: str) -> DataFrame:
    x = records.template_depth(_sam(s, d).withColumnRenamed("rname", "scaffold"), 10, 40)
    return intervals.depth_runs(x).select("scaffold", F.col("lend").cast("int").alias("lend"), F.col("rend").cast("int").alias("rend"), F.col("depth").cast("long").alias("depth"))


@query(f"SELECT least('a' || a, 'a' || b) AS a, greatest('a' || a, 'a' || b) AS b FROM ({_PART_EDGES})")
def weld_lines(s: SparkSession, d: str) -> DataFrame:
    e = _part_edges(s, d).withColumn("kind", F.when(F.col("a") % 2 == 0, "Welding:").otherwise("SCAFFOLD_ACCEPT:"))
    lines = e.select(F.concat("kind", F.lit(" >a"), "a", F.lit(" 25 to >a"), "b", F.lit(" 3")).alias("value"))
    return records.welds(lines.union(s.createDataFrame([("other >x >y",)], "value string")))


@query(f"SELECT CAST(count(*) FILTER (rf = 'A') AS BIGINT) AS yes, CAST(count(*) FILTER (rf = 'N') AS BIGINT) AS no, CAST(sum(line) AS BIGINT) AS recovered, CAST(sum(qty) AS BIGINT) AS reference, CAST(sum(line) AS BIGINT) AS full_length, CAST(sum(qty) - sum(line) AS BIGINT) AS missing FROM {_ITEMS}")
def audit(s: SparkSession, d: str) -> DataFrame:
    x = _items(s, d).select(F.when(F.col("rf") == "A", "YES").when(F.col("rf") == "N", "NO").alias("ok"), F.col("line").alias("recovered"), F.col("qty").alias("reference"), F.col("line").alias("full_length"))
    return records.audit(x)


@query("SELECT 'c' || o_custkey AS component, count(*) AS n, array_to_string(list_sort(list(CAST(o_orderkey AS VARCHAR))), ',') AS members FROM orders GROUP BY 1")
def rows_by_component(s: SparkSession, d: str) -> DataFrame:
    return records.by_component(read(s, d, "orders"), F.concat(F.lit("c"), "o_custkey"), "o_orderkey")


@query("SELECT files, count(*) AS n FROM (SELECT l_partkey, count(DISTINCT l_suppkey % 8) AS files FROM lineitem GROUP BY 1) GROUP BY 1")
def sharing_distribution(s: SparkSession, d: str) -> DataFrame:
    return records.sharing_distribution(_items(s, d).select(F.col("part").alias("name"), (F.col("supp") % 8).alias("file")))


@query("SELECT pos, coalesce(sum(q) FILTER (n = 'A'), 0) AS A, coalesce(sum(q) FILTER (n = 'R'), 0) AS R FROM (SELECT unnest(range(1, (SELECT max(l_partkey) FROM lineitem WHERE l_returnflag IN ('A', 'R')) + 1)) AS pos) LEFT JOIN (SELECT l_partkey AS p, l_returnflag AS n, l_quantity AS q FROM lineitem) ON p = pos GROUP BY pos")
def wigs_by_position(s: SparkSession, d: str) -> DataFrame:
    x = _items(s, d).where("rf in ('A', 'R')").select(F.col("rf").alias("name"), F.col("part").alias("pos"), F.col("qty").cast("double").alias("value"))
    return records.wigs_by_position(x, ["A", "R"])


@query("SELECT l_suppkey || chr(9) || (l_partkey - 1) || chr(9) || (l_partkey + 1) AS value FROM lineitem")
def clip_bed(s: SparkSession, d: str) -> DataFrame:
    return records.clip_bed(_items(s, d).select(F.col("supp").alias("scaffold"), F.col("part").alias("pos")))


# Operators that no other query shows -----------------------------------------------------------------------------
@query("SELECT feature, CAST(rank_a AS INTEGER) AS r1, CAST(rank_r AS INTEGER) AS r2 FROM (SELECT feature, row_number() OVER (ORDER BY value, feature) AS rank_a FROM cells WHERE sample = 'A') JOIN (SELECT feature, row_number() OVER (ORDER BY value, feature) AS rank_r FROM cells WHERE sample = 'R') USING (feature)")
def rank_pairs(s: SparkSession, d: str) -> DataFrame:
    x = cells(s, d).where("sample in ('A', 'R')").select("feature", F.col("sample").alias("method"), F.col("value").alias("score"))
    return reports.rank_pairs(x).select("feature", "r1", "r2")


@query("SELECT coalesce(a.feature, b.feature) AS feature, coalesce(CAST(CAST(a.value AS BIGINT) AS VARCHAR), '.') AS value_a, coalesce(CAST(CAST(b.value AS BIGINT) AS VARCHAR), '.') AS value_b FROM (SELECT * FROM cells WHERE sample = 'A') a FULL JOIN (SELECT * FROM cells WHERE sample = 'R') b USING (feature)")
def compared_results(s: SparkSession, d: str) -> DataFrame:
    one = lambda n: cells(s, d).where(F.col("sample") == n).select("feature", F.col("value").cast("long").alias("value"))
    return reports.compared(one("A"), one("R"), "feature")


@query("SELECT l_suppkey || '_' || l_orderkey AS accession, l_linenumber AS line FROM lineitem")
def gathered_names(s: SparkSession, d: str) -> DataFrame:
    return reports.gathered(read(s, d, "lineitem").select(F.col("l_suppkey").alias("part"), F.col("l_orderkey").cast("string").alias("accession"), F.col("l_linenumber").alias("line")), "part").select("accession", "line")


@query("SELECT accession, reverse(sequence) AS lines FROM (SELECT accession, reverse(regexp_replace(regexp_replace(sequence, '(.{60})', '\\1' || chr(10), 'g'), chr(10) || '$', '')) AS sequence FROM seqs)")
def wrapped_lines(s: SparkSession, d: str) -> DataFrame:
    return formats.sequence_lines(seqs(s, d), 60)


@query("SELECT coalesce(n_name, CAST(feature AS VARCHAR)) AS feature, value FROM (SELECT s_nationkey AS feature, sum(s_acctbal) AS value FROM supplier GROUP BY 1) LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 2 = 0) ON n_nationkey = feature")
def renamed_features(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("feature")).agg(F.sum("s_acctbal").alias("value"))
    names = read(s, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("string").alias("old"), F.col("n_name").alias("new"))
    return matrix.renamed(x, names).select("feature", "value")


@query("SELECT accession, round(h, 9) AS entropy FROM (SELECT accession, -list_sum(list_transform(list_filter([a, c, g, t], lambda x: x > 0), lambda x: x * log2(x))) AS h FROM (SELECT accession, (length(sequence) - length(replace(sequence, 'A', ''))) * 1.0 / nullif(length(sequence), 0) AS a, (length(sequence) - length(replace(sequence, 'C', ''))) * 1.0 / nullif(length(sequence), 0) AS c, (length(sequence) - length(replace(sequence, 'G', ''))) * 1.0 / nullif(length(sequence), 0) AS g, (length(sequence) - length(replace(sequence, 'T', ''))) * 1.0 / nullif(length(sequence), 0) AS t FROM seqs) WHERE a IS NOT NULL)")
def base_entropy(s: SparkSession, d: str) -> DataFrame:
    return seqs(s, d).where("sequence <> ''").select("accession", F.round(S.seed_entropy(F.col("sequence")), 9).alias("entropy"))


@query("SELECT o_orderkey AS read_name, CAST(o_orderkey % 9 AS INTEGER) AS cut, 30 AS whole FROM orders")
def trimmed_reads(s: SparkSession, d: str) -> DataFrame:
    """Reads of 30 good bases between up to eight bad ones at their start."""
    bad = (F.col("o_orderkey") % 9).cast("int")
    x = read(s, d, "orders").select(F.col("o_orderkey").cast("string").alias("read_name"), F.concat(F.repeat(F.lit("C"), bad), F.lit("A" * 30)).alias("sequence"), F.concat(F.repeat(F.lit("#"), bad), F.lit("I" * 30)).alias("quals"), bad.alias("cut"))
    y = genes.trimmed(x, window=1, quality=0, shortest=25)
    return x.select("read_name", "cut").join(y, "read_name").select(F.col("read_name").cast("long").alias("read_name"), "cut", F.length("sequence").alias("whole"))
