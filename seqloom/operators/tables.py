"""Filters, joins, summaries and samples of records that aren't tied to one format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seq as S
from ..functions.alignments import has_flag
from . import graphs


# Filters and duplicates ------------------------------------------------------------------------------------------
def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; a grouped minimum, so that copies combine before the shuffle."""
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_b"))
    return best.select("_b.*")


def unique_sequences(seqs: DataFrame) -> DataFrame:
    """(accession, headers, sequence): one record per sequence, its first accession and all headers joined by tabs."""
    g = seqs.groupBy(F.sha2("sequence", 224).alias("_h")).agg(F.min("accession").alias("accession"), F.array_join(F.array_sort(F.collect_list(F.col("accession").cast("string"))), "\t").alias("headers"), F.first("sequence").alias("sequence"))
    return g.drop("_h")


def duplicate_sequences(seqs: DataFrame) -> DataFrame:
    """(digest, n) of sequences that several records have."""
    return seqs.groupBy(F.sha2("sequence", 224).alias("digest")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def keep_listed(df: DataFrame, names: DataFrame, column: str = "accession") -> DataFrame:
    return df.join(names.select(F.col(names.columns[0]).alias(column)), column, "left_semi")


def drop_listed(df: DataFrame, names: DataFrame, column: str = "accession") -> DataFrame:
    return df.join(names.select(F.col(names.columns[0]).alias(column)), column, "left_anti")


def not_found(df: DataFrame, names: DataFrame, column: str = "accession") -> DataFrame:
    """Names that no row has: an error for the operators that demand them all."""
    return names.select(F.col(names.columns[0]).alias(column)).distinct().join(df.select(column), column, "left_anti")


def long_or_covered(contigs: DataFrame, length: int = 100, coverage: float = 10) -> DataFrame:
    """Contigs of that length, or whose accession's second ';' field is that coverage."""
    return contigs.where((F.length("sequence") >= length) | (F.get(F.split("accession", ";"), 1).try_cast("double") >= coverage))


def well_formed(fastq: DataFrame) -> DataFrame:
    return fastq.where((F.length("sequence") == F.length("quals")) & (F.length("sequence") > 0))


def mismatched_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records at one index (column ord) whose core names differ, or that have no partner."""
    l, r = (x.select("ord", S.core_read_name(F.col("read_name")).alias(n)) for x, n in ((left, "l"), (right, "r")))
    return l.join(r, "ord", "full").where("l is null or r is null or l <> r")


def single_scaffold_reads(alignments: DataFrame) -> DataFrame:
    """Alignments of reads that touch one scaffold only."""
    one = alignments.groupBy("core").agg(F.min("rname").alias("_lo"), F.max("rname").alias("_hi")).where("_lo = _hi").select("core")
    return alignments.join(one, "core", "left_semi")


def dominant_isoforms(long: DataFrame, min_any: float = 0.0, min_percent: float = 0.0, highest_only: bool = False) -> DataFrame:
    """(gene, transcript, expr, pct_iso, pct_dom, top) of transcripts (gene, transcript, expr) that pass; the top one of a gene is exempt from min_percent.

    Shares are to 2 decimals, ties go to the first name; a gene without expression gives 100 to a lone transcript, else 0.
    """
    g = long.groupBy("gene").agg(F.sum("expr").alias("_s"), F.max("expr").alias("_m"), F.count(F.lit(1)).alias("_n"), F.min_by("transcript", F.struct(-F.col("expr"), F.col("transcript"))).alias("_t"))
    share = lambda of: F.round(F.coalesce(F.try_divide(F.col("expr") * 100.0, F.col(of)), F.when(F.col("_n") == 1, 100.0).otherwise(0.0)), 2)
    x = long.join(g, "gene").select("gene", "transcript", "expr", share("_s").alias("pct_iso"), share("_m").alias("pct_dom"), (F.col("transcript") == F.col("_t")).alias("top"))
    x = x.where(F.col("expr") >= min_any)
    if highest_only:
        return x.where("top")
    return x.where(F.col("top") | (F.col("pct_dom") >= min_percent)) if min_percent > 0 else x


def longest_per_gene(seqs: DataFrame) -> DataFrame:
    """(gene, accession, length) of each gene's longest sequence; ties go to the first accession."""
    n = F.length("sequence")
    return seqs.groupBy("gene").agg(F.max_by(F.struct("accession", n.alias("length")), F.struct(n, -F.col("accession"))).alias("b")).select("gene", "b.accession", "b.length")


# Differential rows (feature, a, b, log_fc, fdr) ------------------------------------------------------------------
def extracted(de: DataFrame, min_fc: float = 2.0, max_fdr: float = 0.001, top: int | None = None) -> DataFrame:
    """Rows that pass, with their direction: A-UP from 0 on, else B-UP; at most top per comparison, best FDR first."""
    x = de.where(F.col("log_fc").isNotNull() & F.col("fdr").isNotNull() & (F.abs("log_fc") >= min_fc) & (F.col("fdr") <= max_fdr)).withColumn("direction", F.when(F.col("log_fc") >= 0, "A-UP").otherwise("B-UP"))
    if top is None:
        return x
    return x.withColumn("_r", F.row_number().over(Window.partitionBy("a", "b").orderBy("fdr", "feature"))).where(F.col("_r") <= top).drop("_r")


def best_per_feature(de: DataFrame, min_fc: float, max_fdr: float) -> DataFrame:
    return first_of(de.where((F.abs("log_fc") >= min_fc) & (F.col("fdr") <= max_fdr)), ["feature"], ["fdr", "a", "b"])


def threshold_grid(de: DataFrame, steps: int = 10) -> DataFrame:
    """(fc, p, features): distinct features with |log fold change| of fc or more and FDR of 10^-p or less, for 1 to steps.

    Each row becomes its best corner of the grid first, so the join with the grid is over a bounded table of corners; a
    feature's corners are few.
    """
    fc = F.least(F.floor(F.abs("log_fc")), F.lit(steps)).cast("int")
    p = F.least(F.when(F.col("fdr") <= 0, steps).otherwise(F.floor(-F.log10(F.greatest("fdr", F.lit(1e-300))) + 1e-9)), F.lit(steps)).cast("int")
    corners = de.select("feature", fc.alias("f"), p.alias("q")).where("f >= 1 and q >= 1").distinct()
    # Per feature and fc level, its best p; a feature counts at every (fc, p) that one of its corners reaches.
    reach = corners.select("feature", F.explode(F.sequence(F.lit(1), "f")).alias("fc"), "q").groupBy("feature", "fc").agg(F.max("q").alias("q"))
    return reach.select("fc", F.explode(F.sequence(F.lit(1), "q")).alias("p")).groupBy("fc", "p").agg(F.count(F.lit(1)).alias("features"))


def isoform_swaps(de: DataFrame, max_fdr: float = 0.05, min_fc: float = 1.0) -> DataFrame:
    """(gene, up, down, score) of a gene's transcripts that go opposite ways. de: (gene, feature, log_fc, fdr). The pairs of a gene are one per direction and transcript."""
    ok = de.where((F.col("fdr") <= max_fdr) & (F.abs("log_fc") >= min_fc))
    up, down = ok.where("log_fc > 0").select("gene", F.col("feature").alias("up"), F.col("fdr").alias("fu")), ok.where("log_fc < 0").select("gene", F.col("feature").alias("down"), F.col("fdr").alias("fd"))
    ln = lambda c: -F.ln(F.greatest(F.col(c), F.lit(1e-300)))
    return up.join(down, "gene").select("gene", "up", "down", ((ln("fu") + ln("fd")) / 2).alias("score"))


def both_directions(de: DataFrame, max_fdr: float = 0.05, min_fc: float = 1.0) -> DataFrame:
    """(gene, n_up, n_down) of genes with transcripts of both directions."""
    ok = de.where((F.col("fdr") <= max_fdr) & (F.abs("log_fc") >= min_fc))
    return ok.groupBy("gene").agg(F.count_if(F.col("log_fc") > 0).alias("n_up"), F.count_if(F.col("log_fc") < 0).alias("n_down")).where("n_up > 0 and n_down > 0")


def up_against_all(de: DataFrame) -> DataFrame:
    """(feature, sample): features up in a sample in each of its comparisons. de: (feature, a, b, log_fc) of significant rows; the comparisons are (a, b)."""
    up = de.select("feature", F.when(F.col("log_fc") > 0, F.col("a")).otherwise(F.col("b")).alias("sample")).groupBy("feature", "sample").agg(F.count(F.lit(1)).alias("n"))
    pairs = de.select("a", "b").distinct()
    total = pairs.select(F.explode(F.array("a", "b")).alias("sample")).groupBy("sample").agg(F.count(F.lit(1)).alias("total"))
    return up.join(F.broadcast(total), "sample").where("n = total").select("feature", "sample")


def contrasts(samples: DataFrame, reference: str | None = None) -> DataFrame:
    """(a, b): all pairs of distinct sample names in order, or each against the reference. One row per sample comes in."""
    s = samples.select("sample").distinct()
    if reference is not None:
        return s.where(F.col("sample") != reference).select(F.col("sample").alias("a"), F.lit(reference).alias("b"))
    return s.agg(F.array_sort(F.collect_set("sample")).alias("s")).select(F.explode("s").alias("a"), "s").select("a", F.explode(F.filter("s", lambda x: x > F.col("a"))).alias("b"))


# Lengths ---------------------------------------------------------------------------------------------------------
def nx(lengths: DataFrame, percents: tuple[int, ...] = (10, 20, 30, 40, 50), by: str | None = None) -> DataFrame:
    """(by, x, nx): the length at which the longest sequences reach x percent of all bases. lengths: (length).

    Lengths are counted first, so the running sum is over distinct lengths and not over sequences.
    """
    key = [by] if by else []
    c = lengths.groupBy(*key, "length").agg(F.count(F.lit(1)).alias("n"))
    c = c.withColumn("bases", F.col("length") * F.col("n"))
    total = c.groupBy(*key).agg(F.sum("bases").alias("total"))
    if by:
        run = c.withColumn("run", F.sum("bases").over(Window.partitionBy(by).orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)))
    else:
        run = graphs.running(c, "bases", F.desc("length"))
    x = run.join(total, key) if by else run.crossJoin(F.broadcast(total))
    out = [x.where(F.col("run") * 100 >= F.col("total") * p).groupBy(*key).agg(F.lit(p).alias("x"), F.max("length").alias("nx")) for p in percents]
    u = out[0]
    for o in out[1:]:
        u = u.union(o)
    return u.where("nx is not null")


def expression_nx(rows: DataFrame, x: int = 50) -> DataFrame:
    """(pct, length, features): the N50 of the most expressed features that together make pct percent of expression.

    rows: (feature, length, expr). Running shares first, by (expression, length) classes in range partitions; then each of
    the 100 percents takes the N50 of its prefix from counts of (pct, length), a table whose size follows the distinct lengths.
    """
    classes = rows.groupBy("expr", "length").agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("expr") * F.col("n"))
    total = classes.agg(F.sum("share").alias("t"))
    run = graphs.running(classes, "share", F.desc("expr"), F.desc("length")).crossJoin(F.broadcast(total)).withColumn("pct", F.floor(F.col("run") * 100 / F.col("t")).cast("int"))  # one row
    c = run.groupBy("pct", "length").agg(F.sum("n").alias("n"))
    upto = c.select("pct").distinct().withColumnRenamed("pct", "p")  # 101 rows at most
    prefix = c.withColumn("p", F.explode(F.sequence("pct", F.lit(100)))).join(F.broadcast(upto), "p").groupBy("p", "length").agg(F.sum("n").alias("n"))
    v = Window.partitionBy("p").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    size = prefix.groupBy("p").agg(F.sum(F.col("length") * F.col("n")).alias("bases"), F.sum("n").alias("features"))
    y = prefix.withColumn("cum", F.sum(F.col("length") * F.col("n")).over(v)).join(size, "p").where(F.col("cum") * 100 >= F.col("bases") * x)
    return y.groupBy(F.col("p").alias("pct")).agg(F.max("length").alias("length"), F.first("features").alias("features"))


def counts_above(values: DataFrame, column: str) -> DataFrame:
    """(threshold, features): how many values round to the threshold or more, for each rounded value that occurs."""
    c = values.select(F.floor(F.col(column) + 0.5).cast("long").alias("threshold")).groupBy("threshold").agg(F.count(F.lit(1)).alias("n"))
    return graphs.running(c, "n", F.desc("threshold"), name="features").select("threshold", "features")


def elbow(values: DataFrame, least: float = 0.05, most: float = 32.0) -> DataFrame:
    """(value, rank): where log2 values over their rank lie furthest from the chord. values: (feature, value)."""
    x = graphs.numbered(values.where((F.col("value") > least) & (F.col("value") <= most)).withColumn("_neg", -F.col("value")), "_neg", "feature").withColumn("y", F.log2("value"))
    s = x.agg(F.min("y").alias("lo"), F.max("y").alias("hi"), F.max("index").alias("n"))
    z = x.crossJoin(F.broadcast(s)).where("n > 0 and hi > lo")
    d = F.abs(F.col("index") / F.col("n") + (F.col("y") - F.col("lo")) / (F.col("hi") - F.col("lo")) - 1) / F.sqrt(F.lit(2.0))
    return z.withColumn("d", F.round(d, 9)).agg(F.max_by(F.struct("value", "index"), F.struct("d", -F.col("index"))).alias("b")).select("b.value", F.col("b.index").alias("rank"))


# Read pairs ------------------------------------------------------------------------------------------------------
def fragment_classes(alignments: DataFrame) -> DataFrame:
    """(core, class) by the flags of a fragment's reads alone: PP proper pair, IP both ends but not proper, L, R or S one end.

    alignments: (core, flag).
    """
    f = F.col("flag")
    mapped = ~has_flag(f, "unmapped")
    g = alignments.where(mapped).groupBy("core").agg(*[F.bool_or(c).alias(n) for n, c in (("pp", has_flag(f, "paired") & has_flag(f, "proper_pair")), ("l", has_flag(f, "paired") & has_flag(f, "first")), ("r", has_flag(f, "paired") & has_flag(f, "second")), ("s", ~has_flag(f, "paired")))])
    return g.select("core", F.when(F.col("pp"), "PP").when(F.col("l") & F.col("r"), "IP").when(F.col("l"), "L").when(F.col("r"), "R").otherwise("S").alias("class"))


def strand_balance(first_reads: DataFrame) -> DataFrame:
    """(target, plus, minus, difference): reads of each strand and their difference over their sum. first_reads: (target, strand)."""
    g = first_reads.groupBy("target").agg(F.count_if(F.col("strand") == "+").alias("plus"), F.count_if(F.col("strand") == "-").alias("minus"))
    return g.withColumn("difference", F.try_divide(F.col("plus") - F.col("minus"), F.col("plus") + F.col("minus")))


def paired_and_orphans(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(pairs, orphans) of a full outer join on key; orphans have the side they are of."""
    x = left.select(key, F.lit(1).alias("_l")).join(right.select(key, F.lit(1).alias("_r")), key, "full")
    return x.where("_l is not null and _r is not null").select(key), x.where("_l is null or _r is null").select(key, F.when(F.col("_l").isNotNull(), "left").otherwise("right").alias("side"))


def interleaved(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records of both files by index and end; (ord, end, …)."""
    return left.withColumn("end", F.lit(1)).unionByName(right.withColumn("end", F.lit(2)))


# Samples ---------------------------------------------------------------------------------------------------------
def random_rows(df: DataFrame, n: int, *key: str, seed: int = 0) -> DataFrame:
    """Exactly n rows (or all), those with the smallest keyed hash: the same on every run, any partitioning, and for both mates of a core name."""
    return df.withColumn("_u", S.hash_uniform(*[F.col(k) for k in key], seed=seed)).orderBy("_u", *key).limit(n).drop("_u")


def shuffled(df: DataFrame, *key: str, seed: int = 0) -> DataFrame:
    return df.withColumn("_u", S.hash_uniform(*[F.col(k) for k in key], seed=seed)).orderBy("_u", *key).drop("_u")


def simulated_pairs(seqs: DataFrame, read_length: int = 76, insert: int = 300, spacing: int = 50) -> DataFrame:
    """(name, left, right): read pairs at even places along each sequence; the right read is the reverse complement."""
    n = F.length("sequence")
    at = F.when(n >= insert, F.sequence(F.lit(1), n - insert + 1, F.lit(spacing))).otherwise(F.array().cast("array<int>"))
    x = seqs.select("accession", "sequence", F.explode(at).alias("p"))
    right = F.substring("sequence", F.col("p") + insert - read_length, F.lit(read_length))
    return x.select(F.concat_ws(":", F.col("accession").cast("string"), "p").alias("name"), F.substring("sequence", F.col("p"), F.lit(read_length)).alias("left"), S.reverse_complement(right).alias("right"))


def bubbles(seqs: DataFrame, least: int = 500, at: int = 200, size: int = 100) -> DataFrame:
    """(accession, isoform, sequence): each long sequence whole, and without a stretch behind base ``at``."""
    x = seqs.where(F.length("sequence") >= least)
    short = F.concat(F.substring("sequence", 1, at), F.expr(f"substring(sequence, {at + size + 1})"))
    return x.select("accession", F.explode(F.array(F.struct(F.lit("isoA").alias("isoform"), F.col("sequence")), F.struct(F.lit("isoB").alias("isoform"), short.alias("sequence")))).alias("s")).select("accession", "s.isoform", "s.sequence")


def mutated(seqs: DataFrame, rate: float = 0.01, seed: int = 0) -> DataFrame:
    """Sequences with int(rate x length + 0.5) substitutions at distinct places; the places with the smallest keyed hashes."""
    n = F.length("sequence")
    many = F.floor(n * rate + 0.5).cast("int")
    ranked = F.array_sort(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.struct(F.xxhash64("accession", i, F.lit(seed)).alias("h"), i.alias("i"))))
    at = F.slice(ranked, 1, F.greatest(many, F.lit(0))).getField("i")
    base = lambda i: F.substring("sequence", i, F.lit(1))
    other = lambda i: F.substring(F.replace(F.lit("ACGT"), base(i), F.lit("")), F.pmod(F.xxhash64("accession", i, F.lit(seed + 1)), F.lit(3)).cast("int") + 1, F.lit(1))
    letters = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.when(F.array_contains(F.col("_at"), i), other(i)).otherwise(base(i)))
    return seqs.withColumn("_at", at).withColumn("sequence", F.when(n > 0, F.array_join(letters, "")).otherwise("")).drop("_at")


def value_or_na(*tables: DataFrame, key: str, fill: str = "NA") -> DataFrame:
    """Full outer join of tables on their key, missing values as NA; columns must have distinct names."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, key, "full")
    return out.select(key, *[F.coalesce(F.col(c).cast("string"), F.lit(fill)).alias(c) for c in out.columns if c != key])


def summary(df: DataFrame, column: str) -> DataFrame:
    from ..functions.stats import summary_columns

    return df.agg(*summary_columns(F.col(column).cast("double")))


def position_column(value: Column, names: list[str]) -> Column:
    return F.array_position(F.array(*[F.lit(n) for n in names]), value)
