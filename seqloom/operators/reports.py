"""Small summaries: token lists, group sizes, representative rows, method agreement, classes, capped groups, time matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import reverse_complement


def tokens(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, i, token) of each blank-separated token."""
    parts = F.filter(F.split(text, r"[ \t\n\r]+"), lambda w: w != "")
    return df.select(key, F.posexplode(parts).alias("i", "token"))


def both_strands(seqs: DataFrame) -> DataFrame:
    """Each record and its reverse complement, whose name ends in -ANTI."""
    name = F.col("accession").cast("string")
    row = lambda n, s, q: F.struct(n.alias("accession"), F.lit(s).alias("strand"), q.alias("sequence"))
    both = F.array(row(name, "sense", F.col("sequence")), row(F.concat(name, F.lit("-ANTI")), "anti", reverse_complement(F.col("sequence"))))
    return seqs.select(F.explode(both).alias("r")).select("r.*")


def group_size_histogram(df: DataFrame, key: str, size: str, groups: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(size)).groupBy(size).agg(F.count(F.lit(1)).alias(groups))


def representative_rows(wide: DataFrame, group: str, name: str, columns: list[str]) -> DataFrame:
    """One row per group with the columns' sums and the name of its row of greatest total; ties go to the first name."""
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return wide.groupBy(group).agg(*[F.sum(c).alias(c) for c in columns], F.min_by(name, F.struct(-total, F.col(name))).alias(name))


def quartiles(df: DataFrame, key: str, column: str) -> DataFrame:
    q = lambda p: F.percentile(column, p)
    return df.groupBy(key).agg(F.count(column).alias("n"), F.min(column).alias("min"), F.max(column).alias("max"), F.avg(column).alias("mean"), q(0.25).alias("q1"), q(0.5).alias("median"), q(0.75).alias("q3"))


def symmetric_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, n) with each pair counted both ways round."""
    both = F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.select(F.explode(both).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))


def venn(found: DataFrame) -> DataFrame:
    """(methods, n): how many features each combination of methods found. found: (feature, method)."""
    sets = found.groupBy("feature").agg(F.array_join(F.array_sort(F.collect_set("method")), ",").alias("methods"))
    return sets.groupBy("methods").agg(F.count(F.lit(1)).alias("n"))


def rank_pairs(found: DataFrame) -> DataFrame:
    """(m1, m2, feature, r1, r2): ranks of features that two methods found. found: (feature, method, score)."""
    r = found.withColumn("r", F.row_number().over(Window.partitionBy("method").orderBy("score", "feature")))
    a, b = (r.select("feature", F.col("method").alias(f"m{i}"), F.col("r").alias(f"r{i}")) for i in (1, 2))
    return a.join(b, "feature").where("m1 < m2")


def pairwise_summary(de: DataFrame, long: DataFrame, a: str, b: str, max_fdr: float = 0.05, pseudocount: float = 0.1) -> DataFrame:
    """(feature, log2_ratio, expr_a, expr_b) of significant features."""
    e = long.where(F.col("sample").isin(a, b)).groupBy("feature").agg(*[F.coalesce(F.max(F.when(F.col("sample") == s, F.col("value"))), F.lit(0.0)).alias(n) for s, n in ((a, "expr_a"), (b, "expr_b"))])
    x = de.where(F.col("fdr") <= max_fdr).join(e, "feature")
    return x.select("feature", F.log2((F.col("expr_a") + pseudocount) / (F.col("expr_b") + pseudocount)).alias("log2_ratio"), "expr_a", "expr_b")


def classified(pairs: DataFrame) -> DataFrame:
    """(feature, up, down, priority): samples that are only ever up, and only ever down, in a feature's comparisons.

    pairs: (feature, up, down, up_expr, down_expr). Priority is (least up - greatest down) / (greatest down + 1).
    """
    g = pairs.groupBy("feature").agg(F.collect_set("up").alias("u"), F.collect_set("down").alias("d"), F.min("up_expr").alias("lo"), F.max("down_expr").alias("hi"))
    only = lambda x, y: F.array_join(F.array_sort(F.array_except(x, y)), ",")
    return g.select("feature", only("u", "d").alias("up"), only("d", "u").alias("down"), ((F.col("lo") - F.col("hi")) / (F.col("hi") + 1)).alias("priority"))


def capped_per_group(df: DataFrame, key: str, order: list[str], most: int) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_r") <= most).drop("_r")


def gathered(parts: DataFrame, key: str, name: str = "accession") -> DataFrame:
    """Rows of partition outputs, their names prefixed by the partition's."""
    return parts.withColumn(name, F.concat_ws("_", F.col(key).cast("string"), F.col(name).cast("string")))


def time_matrix(df: DataFrame, time: str, kind: str, value: str, kinds: list[str], width: str) -> DataFrame:
    """(time, n, a column per kind): sums per window of time."""
    cells: list[Column] = [F.sum(F.when(F.col(kind) == k, F.col(value))).alias(k) for k in kinds]
    return df.groupBy(F.window(time, width).alias("w")).agg(F.count(F.lit(1)).alias("n"), *cells).select(F.col("w.start").alias("time"), "n", *kinds)


def compared(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Full outer comparison of two results; what one lacks is '.'."""
    x = a.select(key, *[F.col(c).cast("string").alias(f"{c}_a") for c in a.columns if c != key])
    y = b.select(key, *[F.col(c).cast("string").alias(f"{c}_b") for c in b.columns if c != key])
    out = x.join(y, key, "full")
    return out.select(key, *[F.coalesce(F.col(c), F.lit(".")).alias(c) for c in out.columns if c != key])


def intron_classes(target: DataFrame, reference: DataFrame) -> DataFrame:
    """(transcript, class) of intron chains (transcript, introns array of labels) against the reference's.

    REF: the chain is one of the reference's; SUBREF: an unbroken part of one; REFCOMBO: known introns in a new order;
    NOVEL: an intron that the reference lacks. Chains meet by their labels, never all with all.
    """
    known = reference.select(F.explode("introns").alias("i")).distinct()
    chains = reference.select(F.array_join("introns", "|").alias("c")).distinct()
    t = target.withColumn("c", F.array_join("introns", "|"))
    novel = t.select("transcript", F.explode("introns").alias("i")).join(known, "i", "left_anti").select("transcript").distinct().withColumn("novel", F.lit(True))
    same = chains.withColumn("ref", F.lit(True))
    starts = reference.select(F.array_join("introns", "|").alias("whole"), F.explode("introns").alias("first")).distinct()
    part = t.select("transcript", "c", F.element_at("introns", 1).alias("first")).join(starts, "first").where(F.concat(F.lit("|"), "whole", F.lit("|")).contains(F.concat(F.lit("|"), F.col("c"), F.lit("|")))).select("transcript").distinct().withColumn("part", F.lit(True))
    x = t.join(same, "c", "left").join(part, "transcript", "left").join(novel, "transcript", "left")
    return x.select("transcript", F.when(F.col("ref"), "REF").when(F.col("novel"), "NOVEL").when(F.col("part"), "SUBREF").otherwise("REFCOMBO").alias("class"))
