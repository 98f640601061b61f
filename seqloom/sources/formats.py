"""Readers and writers of text formats for sequences, reads, alignments, features and matrices.

Everything goes through Spark's text and CSV readers, so any file system and gzip or bzip2 work, and columns and rows are
pruned. Formats whose records span lines carry the record's place in the file as ``ord``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.seq import fasta_record, reverse_complement, wrapped
from ..workers import shared_folder

Paths = str | list[str]

# The fields of each format, in the order files have them.
SAM = "qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string"
PSL = "matches int, mismatches int, rep_matches int, n_count int, q_gaps int, q_gap_bases int, t_gaps int, t_gap_bases int, strand string, query string, q_length int, q_start int, q_end int, target string, t_length int, t_start int, t_end int, n_blocks int, block_sizes string, q_starts string, t_starts string"
BED = "chrom string, start int, end int, name string, score string, strand string, thick_start int, thick_end int, rgb string, n_blocks int, block_sizes string, block_starts string"
GFF = "seqid string, source string, type string, start int, end int, score string, strand string, phase string, attributes string"
OUTFMT6 = "query string, target string, identity double, length int, mismatch int, gapopen int, q_start int, q_end int, t_start int, t_end int, evalue double, score double"
QUANT = {
    "RSEM": ("transcript_id", "expected_count", "TPM"),
    "eXpress": ("target_id", "eff_counts", "tpm"),
    "kallisto": ("target_id", "est_counts", "tpm"),
    "salmon": ("Name", "NumReads", "TPM"),
}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares; gone when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def _lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """(file, ord, line): lines with their order in each file. A file is one sorted run of row ids, since splits are read in order of offset."""
    x = spark.read.text(paths).select(F.input_file_name().alias("file"), F.regexp_replace("value", r"[\r\x00-\x08]", "").alias("line"))
    return x.withColumn("ord", F.monotonically_increasing_id())


# Sequences -------------------------------------------------------------------------------------------------------
def read_fasta(spark: SparkSession, paths: Paths) -> DataFrame:
    """(accession, header, sequence). Records are split where a line starts with '>', so a file is read in parallel."""
    x = spark.read.option("lineSep", "\n>").text(paths).select(F.regexp_replace("value", r"^>", "").alias("r"))
    header = F.regexp_replace(F.substring_index("r", "\n", 1), r"[\r\x00-\x08]", "")
    body = F.when(F.locate("\n", F.col("r")) > 0, F.expr("substring(r, locate('\\n', r) + 1)")).otherwise("")
    return x.where(F.trim("r") != "").select(F.regexp_extract(header, r"^\s*(\S+)", 1).alias("accession"), header.alias("header"), F.regexp_replace(body, r"[\s\x00-\x1f]", "").alias("sequence"))


def fasta_lines(seqs: DataFrame, width: int = 60) -> DataFrame:
    return seqs.select(fasta_record(F.coalesce(F.col("header"), F.col("accession")) if "header" in seqs.columns else F.col("accession").cast("string"), F.col("sequence"), width).alias("value"))


def write_fasta(seqs: DataFrame, path: str, width: int = 60) -> None:
    fasta_lines(seqs, width).write.text(path)


def read_fastq(spark: SparkSession, paths: Paths, strict: bool = False) -> DataFrame:
    """(read_name, pair_dir, sequence, quals, ord); records that aren't four lines with equal lengths go, or with strict make an error.

    A line's number within its file comes from counts of lines per split, a small table, and not from a sort of the file.
    """
    x = _lines(spark, paths).withColumn("part", F.shiftright("ord", 33).cast("int"))
    first = x.groupBy("file", "part").agg(F.min("ord").alias("lo"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = first.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))).select("file", "part", "lo", "before")
    at = x.join(F.broadcast(before), ["file", "part"]).withColumn("i", F.col("ord") - F.col("lo") + F.col("before"))
    rec = at.groupBy("file", F.floor(F.col("i") / 4).alias("ord")).agg(*[F.max(F.when(F.col("i") % 4 == k, F.col("line"))).alias(f"l{k}") for k in range(4)])
    good = F.col("l0").startswith("@") & F.col("l2").startswith("+") & (F.length("l1") == F.length("l3"))
    rec = rec.where(F.when(good, True).otherwise(F.raise_error(F.concat(F.lit("malformed record: "), F.coalesce("l0", F.lit(""))))) if strict else F.coalesce(good, F.lit(False)))
    header = F.expr("substring(l0, 2)")
    return rec.select(read_name(header).alias("read_name"), pair_direction(header).alias("pair_dir"), F.col("l1").alias("sequence"), F.col("l3").alias("quals"), "ord")


def pair_direction(header: Column) -> Column:
    """1 or 2 by a /1 or /2 ending, or by the second word of a newer header; else 0."""
    old, new = F.regexp_extract(header, r"^\S+/([12])(\s|$)", 1), F.regexp_extract(header, r"^\S+\s+([12]):", 1)
    return F.when(old != "", old.cast("int")).when(new != "", new.cast("int")).otherwise(0)


def read_name(header: Column) -> Column:
    """The header's first word; a newer header's direction becomes a /1 or /2 ending."""
    acc, new = F.regexp_extract(header, r"^(\S+)", 1), F.regexp_extract(header, r"^\S+\s+([12]):", 1)
    return F.when((new != "") & ~acc.rlike("/[12]$"), F.concat(acc, F.lit("/"), new)).otherwise(acc)


def fastq_to_fasta(reads: DataFrame, suffix: str | None = None, reverse: bool = False) -> DataFrame:
    name = F.concat(F.regexp_replace("read_name", "/[12]$", ""), F.lit(f"/{suffix}")) if suffix else F.col("read_name")
    return reads.select(name.alias("accession"), (reverse_complement(F.col("sequence")) if reverse else F.col("sequence")).alias("sequence"))


def fastq_lines(reads: DataFrame) -> DataFrame:
    return reads.select(F.concat(F.lit("@"), "read_name", F.lit("\n"), "sequence", F.lit("\n+\n"), "quals").alias("value"))


# Delimited -------------------------------------------------------------------------------------------------------
def read_delimited(spark: SparkSession, paths: Paths, sep: str = "\t", schema: str | None = None) -> DataFrame:
    """Rows of a file with a header; a row of another width is an error."""
    r = spark.read.option("sep", sep).option("header", True).option("mode", "FAILFAST")
    return (r.schema(schema) if schema else r.option("inferSchema", False)).csv(paths)


def write_delimited(df: DataFrame, path: str, columns: Iterable[str] | None = None, header: bool = True, sep: str = "\t") -> None:
    (df.select(*columns) if columns else df).write.option("sep", sep).option("header", header).csv(path)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Long rows (feature, sample, value) of a wide matrix file, whether or not its header names the first column."""
    head, first = (r.value.split("\t") for r in spark.read.text(path).limit(2).collect())
    names = head if len(head) < len(first) else head[1:]
    schema = "`feature` string, " + ", ".join(f"`{n}` double" for n in names)
    wide = spark.read.option("sep", "\t").option("header", True).option("enforceSchema", True).schema(schema).csv(path)
    return wide.unpivot(["feature"], names, "sample", "value")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """(sample, replicate, left, right) of a samples file; blank lines and comments go. right is null for single ends."""
    f = F.split(F.trim("value"), r"\s+")
    x = spark.read.text(path).where(~F.trim("value").rlike("^(#|$)")).select(*[F.get(f, i).alias(n) for i, n in enumerate(("sample", "replicate", "left", "right"))])
    return x.withColumn("right", F.when(F.col("right") != "", F.col("right")))


def repeated_replicates(samples: DataFrame) -> DataFrame:
    return samples.groupBy("replicate").count().where("count > 1")


def read_quant(spark: SparkSession, paths: dict[str, str], method: str = "salmon") -> DataFrame:
    """(feature, sample, count, tpm) of one file per sample."""
    acc, count, tpm = QUANT[method]
    out = None
    for sample, path in sorted(paths.items()):
        x = read_delimited(spark, path).select(F.col(acc).alias("feature"), F.lit(sample).alias("sample"), F.col(count).cast("double").alias("count"), F.col(tpm).cast("double").alias("tpm"))
        out = x if out is None else out.unionByName(x)
    if out is None:
        raise ValueError("no files")
    return out


# Alignments and features -----------------------------------------------------------------------------------------
def _names(schema: str) -> list[tuple[str, str]]:
    return [tuple(f.strip().split(" ")) for f in schema.split(",")]


def _fields(x: DataFrame, schema: str) -> DataFrame:
    """Tab-separated lines as typed columns by position; fields past the schema are the array more."""
    names = _names(schema)
    f = F.split("value", "\t")
    return x.select(*[F.get(f, i).try_cast(t).alias(n) for i, (n, t) in enumerate(names)], F.when(F.size(f) > len(names), F.slice(f, len(names) + 1, F.size(f) - len(names))).otherwise(F.array().cast("array<string>")).alias("more"))


def read_sam(spark: SparkSession, paths: Paths) -> DataFrame:
    """The eleven fields and tags; headers and blank lines go."""
    x = spark.read.text(paths).where(~F.col("value").rlike("^(@[A-Z]{2}\t|\\s*$)"))
    return _fields(x, SAM).withColumnRenamed("more", "tags")


def read_psl(spark: SparkSession, paths: Paths) -> DataFrame:
    return _fields(spark.read.text(paths).where(F.col("value").rlike(r"^\d+\t")), PSL)


def psl_blocks(psl: DataFrame) -> DataFrame:
    """PSL rows with target and query blocks counted from 1; query blocks on the reverse strand count from the query's start."""
    nums = lambda c: F.transform(F.filter(F.split(c, ","), lambda s: s != ""), lambda s: s.cast("int"))
    size, q, t = nums("block_sizes"), nums("q_starts"), nums("t_starts")
    z = F.arrays_zip(size.alias("n"), q.alias("q"), t.alias("t"))
    rev = F.col("strand").startswith("-")
    return psl.withColumn("t_blocks", F.transform(z, lambda b: F.struct((b.t + 1).alias("lend"), (b.t + b.n).alias("rend")))).withColumn(
        "q_blocks", F.transform(z, lambda b: F.when(rev, F.struct((F.col("q_length") - b.q).alias("lend"), (F.col("q_length") - b.q - b.n + 1).alias("rend"))).otherwise(F.struct((b.q + 1).alias("lend"), (b.q + b.n).alias("rend"))))
    )


def read_outfmt6(spark: SparkSession, paths: Paths) -> DataFrame:
    return _fields(spark.read.text(paths).where(~F.col("value").rlike(r"^(#|\s*$)")), OUTFMT6).drop("more")


def read_vcf(spark: SparkSession, paths: Paths) -> DataFrame:
    """(acc, pos, id, ref, allele, info map). An entry without a value is a flag, and true; of a key that comes twice the first entry counts."""
    x = _fields(spark.read.text(paths).where(~F.col("value").rlike(r"^(#|\s*$)")), "acc string, pos int, id string, ref string, allele string, qual string, filter string, info string")
    value = lambda s: F.when(s.contains("="), F.regexp_replace(s, "^[^=]*=", "")).otherwise("true")
    return x.select("acc", "pos", "id", "ref", "allele", _first_entries(F.filter(F.split("info", ";"), lambda s: (s != "") & (s != ".")), lambda s: F.substring_index(s, "=", 1), value).alias("info"))


def _first_entries(parts: Column, key, value) -> Column:
    """A map of the parts' keys and values; of a key that comes twice the first value counts."""
    keys = F.transform(parts, key)
    entries = F.transform(parts, lambda s: F.struct(key(s), value(s)))
    return F.map_from_entries(F.filter(entries, lambda e, i: F.array_position(keys, e["col1"]) == i + 1))


def read_bed(spark: SparkSession, paths: Paths) -> DataFrame:
    """BED rows with blocks counted from 1; lines that aren't BED go. Rows of fewer than twelve fields have one block."""
    x = _fields(spark.read.text(paths).where(F.col("value").rlike(r"^\S+\t\d+\t\d+")), BED).drop("more")
    nums = lambda c: F.transform(F.filter(F.split(c, ","), lambda s: s != ""), lambda s: s.cast("int"))
    blocks = F.zip_with(nums("block_sizes"), nums("block_starts"), lambda n, s: F.struct((F.col("start") + s + 1).alias("lend"), (F.col("start") + s + n).alias("rend")))
    return x.withColumn("blocks", F.coalesce(blocks, F.array(F.struct((F.col("start") + 1).alias("lend"), F.col("end").alias("rend")))))


def read_gff3(spark: SparkSession, paths: Paths) -> DataFrame:
    """GFF3 rows with attributes as a map, values unescaped; of a key that comes twice the first counts."""
    x = _fields(spark.read.text(paths).where(~F.col("value").rlike(r"^(#|\s*$)")), GFF).drop("more")
    pairs = F.filter(F.split("attributes", ";"), lambda s: s.contains("="))
    decoded = lambda s: F.url_decode(F.regexp_replace(F.regexp_replace(s, "^[^=]*=", ""), r"\+", "%2B"))
    return x.withColumn("attributes", _first_entries(pairs, lambda s: F.trim(F.substring_index(s, "=", 1)), decoded))


def read_gtf(spark: SparkSession, paths: Paths) -> DataFrame:
    """GTF rows with attributes as a map."""
    x = _fields(spark.read.text(paths).where(~F.col("value").rlike(r"^(#|\s*$)")), GFF).drop("more")
    keys, values = F.regexp_extract_all("attributes", F.lit(r'(\w+)\s+"([^"]*)"'), 1), F.regexp_extract_all("attributes", F.lit(r'(\w+)\s+"([^"]*)"'), 2)
    # A key that comes twice, as tags do, keeps its first value.
    entries = F.zip_with(keys, values, lambda k, v: F.struct(k.alias("k"), v.alias("v")))
    first = F.filter(entries, lambda e, i: F.array_position(keys, e.k) == i + 1)
    return x.withColumn("attributes", F.map_from_entries(first))


def gtf_transcripts(gtf: DataFrame) -> DataFrame:
    """(gene, transcript, seqid, strand, exons, cds): rows of a transcript with their parts in order, overlapping ones joined."""
    part = lambda kinds: F.array_sort(F.collect_list(F.when(F.col("type").isin(*kinds), F.struct(F.col("start").alias("lend"), F.col("end").alias("rend")))))
    g = gtf.groupBy(F.col("attributes")["gene_id"].alias("gene"), F.col("attributes")["transcript_id"].alias("transcript"), "seqid", "strand").agg(part(["exon", "CDS", "UTR"]).alias("exons"), part(["CDS"]).alias("cds")).where("transcript is not null")
    return g.withColumn("exons", joined_blocks(F.col("exons")))


def gff3_transcripts(gff: DataFrame) -> DataFrame:
    """The same from GFF3: exons find their transcripts and those their gene by ID and Parent; parts may have several parents."""
    a = F.col("attributes")
    mrna = gff.where(F.col("type").isin("mRNA", "transcript")).select(a["ID"].alias("transcript"), a["Parent"].alias("gene"))
    parts = gff.where(F.col("type").isin("exon", "CDS")).select("seqid", "strand", "type", "start", "end", F.explode(F.split(a["Parent"], ",")).alias("transcript"))
    part = lambda kinds: F.array_sort(F.collect_list(F.when(F.col("type").isin(*kinds), F.struct(F.col("start").alias("lend"), F.col("end").alias("rend")))))
    return parts.join(mrna, "transcript").groupBy("gene", "transcript", "seqid", "strand").agg(part(["exon"]).alias("exons"), part(["CDS"]).alias("cds"))


def joined_blocks(blocks: Column) -> Column:
    """Sorted blocks with those that overlap as one."""
    start = F.array().cast("array<struct<lend:int,rend:int>>")

    def step(acc: Column, b: Column) -> Column:
        tail = F.try_element_at(acc, F.greatest(F.size(acc), F.lit(1)))
        grown = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(tail.lend.alias("lend"), F.greatest(tail.rend, b.rend).alias("rend"))))
        return F.when((F.size(acc) > 0) & (b.lend <= tail.rend), grown).otherwise(F.concat(acc, F.array(F.struct(b.lend.alias("lend"), b.rend.alias("rend")))))

    return F.aggregate(blocks, start, step)


def read_wig(spark: SparkSession, paths: Paths) -> DataFrame:
    """(scaffold, pos, value) of variableStep files, in the order of their lines."""
    x = _lines(spark, paths)
    chrom = F.regexp_extract("line", r"chrom=(\S+)", 1)
    w = Window.partitionBy("file").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    y = x.withColumn("scaffold", F.last(F.when(chrom != "", chrom), True).over(w)).where(F.col("line").rlike(r"^\d"))
    f = F.split(F.trim("line"), r"\s+")
    return y.select("scaffold", F.get(f, 0).cast("int").alias("pos"), F.get(f, 1).cast("double").alias("value"))


def filled_wig(wig: DataFrame) -> DataFrame:
    """Positions from 1 to each scaffold's last with 0 where there was no value."""
    top = wig.groupBy("scaffold").agg(F.max("pos").alias("m")).select("scaffold", F.explode(F.sequence(F.lit(1), "m")).alias("pos"))
    return top.join(wig, ["scaffold", "pos"], "left").na.fill(0.0, ["value"])


def bed12(scaffold: Column, name: Column, strand: Column, blocks: Column, score: str = "0") -> Column:
    """A BED12 line from sorted blocks counted from 1."""
    start, end = F.element_at(blocks, 1).lend - 1, F.element_at(blocks, -1).rend
    sizes = F.array_join(F.transform(blocks, lambda b: (b.rend - b.lend + 1).cast("string")), ",")
    starts = F.array_join(F.transform(blocks, lambda b: (b.lend - 1 - start).cast("string")), ",")
    return F.concat_ws("\t", scaffold, start.cast("string"), end.cast("string"), name, F.lit(score), strand, start.cast("string"), end.cast("string"), F.lit("0"), F.size(blocks).cast("string"), sizes, starts)


def gff3_matches(scaffold: Column, name: Column, strand: Column, blocks: Column, source: str = "align") -> Column:
    """An array of GFF3 match lines, one per block."""
    return F.transform(blocks, lambda b: F.concat_ws("\t", scaffold, F.lit(source), F.lit("match"), b.lend.cast("string"), b.rend.cast("string"), F.lit("."), strand, F.lit("."), F.concat(F.lit("ID="), name)))


def sequence_gtf(seqs: DataFrame) -> DataFrame:
    """A transcript and an exon line over the whole of each sequence."""
    line = lambda kind: F.concat_ws("\t", "accession", F.lit("."), F.lit(kind), F.lit("1"), F.length("sequence").cast("string"), F.lit("."), F.lit("+"), F.lit("."), F.format_string('gene_id "%s"; transcript_id "%s";', "accession", "accession"))
    return seqs.select(F.explode(F.array(line("transcript"), line("exon"))).alias("value"))


def sequence_lines(seqs: DataFrame, width: int = 60) -> DataFrame:
    return seqs.select("accession", wrapped(F.col("sequence"), width).alias("lines"))


def log_table(spark: SparkSession, paths: Paths) -> DataFrame:
    """(file, key, value) of logs with 'key | value' lines."""
    x = spark.read.text(paths).select(F.input_file_name().alias("file"), "value").where(F.col("value").contains("|"))
    return x.select("file", F.regexp_extract("value", r"^\s*([^|]*?)\s*\|", 1).alias("key"), F.regexp_extract("value", r"^[^|]*\|\s*(.*?)\s*$", 1).alias("value"))
