"""Search hits (query, target, score, …): top hits, coverage bins, grouped segments, tiers, categories, full-length maps."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workers import importable


def top_hits(hits: DataFrame, key: str, order: list[Column], n: int = 1) -> DataFrame:
    """The n best rows of each key. For n = 1 a grouped minimum combines on the map side; otherwise rows are ranked."""
    w = Window.partitionBy(key).orderBy(*order)
    return hits.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def best_hit(hits: DataFrame, key: str, order: Column) -> DataFrame:
    """The row of each key with the smallest order (a struct), by partial aggregation."""
    best = hits.groupBy(key).agg(F.min_by(F.struct(*hits.columns), order).alias("_b"))
    return best.select("_b.*")


def target_coverage(hits: DataFrame, inclusive: bool = True) -> DataFrame:
    """The best hit of each query (highest score, then target), with percent of the target's length; then the best query of each target."""
    span = F.abs(F.col("t_end") - F.col("t_start")) + (1 if inclusive else 0)
    x = best_hit(hits, "query", F.struct(-F.col("score"), F.col("target"), F.col("t_start"), F.col("t_end"))).withColumn("pct", span * 100.0 / F.col("t_length"))
    return best_hit(x, "target", F.struct(-F.col("pct"), -F.col("score"), F.col("query")))


def percent_match_length(hits: DataFrame, inclusive: bool = False) -> DataFrame:
    """Hits with the percent of the target's length they span."""
    span = F.abs(F.col("t_end") - F.col("t_start")) + (1 if inclusive else 0)
    return hits.withColumn("pct_len", F.round(span * 100.0 / F.col("t_length"), 2))


def coverage_bins(best: DataFrame, pct: str = "pct", width: int = 10) -> DataFrame:
    """(bin, n, at_least): counts of (lo, hi] bins named by their upper end, and how many lie in this bin or a higher one."""
    bins = best.select(F.least(F.greatest(F.ceil(F.col(pct) / width) * width, F.lit(width)), F.lit(100)).cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return bins.withColumn("at_least", F.sum("n").over(Window.orderBy(F.desc("bin"))))


def grouped_segments(hits: DataFrame) -> DataFrame:
    """(query, target, identity, evalue, q_covered, t_covered, segments): all segments of a pair as one row, overlaps counted once."""
    q = _covered(hits, "q_start", "q_end").withColumnRenamed("covered", "q_covered")
    t = _covered(hits, "t_start", "t_end").withColumnRenamed("covered", "t_covered")
    length = F.abs(F.col("q_end") - F.col("q_start")) + 1
    x = hits.groupBy("query", "target").agg((F.sum(F.col("identity") * length) / F.sum(length)).alias("identity"), F.min("evalue").alias("evalue"), F.count(F.lit(1)).alias("segments"))
    return x.join(q, ["query", "target"]).join(t, ["query", "target"])


def _covered(hits: DataFrame, start: str, end: str) -> DataFrame:
    lo, hi = F.least(start, end), F.greatest(start, end)
    w = Window.partitionBy("query", "target").orderBy("lo")
    x = hits.select("query", "target", lo.alias("lo"), hi.alias("hi")).withColumn("before", F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return x.groupBy("query", "target").agg(F.sum(F.greatest(F.col("hi") - F.greatest(F.col("lo") - 1, F.coalesce("before", F.col("lo") - 1)), F.lit(0))).alias("covered"))


def similar_pairs(grouped: DataFrame, lengths: DataFrame, min_identity: float = 75, min_cover: float = 50, both: bool = False) -> DataFrame:
    """(a, b) of pairs that are alike enough to link: identity and percent covered of the query, or of both. lengths: (name, length)."""
    x = grouped.where("query <> target").join(lengths.select(F.col("name").alias("query"), F.col("length").alias("ql")), "query").join(lengths.select(F.col("name").alias("target"), F.col("length").alias("tl")), "target")
    ok = (F.col("identity") >= min_identity) & (F.col("q_covered") * 100.0 / F.col("ql") >= min_cover)
    if both:
        ok = ok & (F.col("t_covered") * 100.0 / F.col("tl") >= min_cover)
    return x.where(ok).select(F.least("query", "target").alias("a"), F.greatest("query", "target").alias("b")).distinct()


def by_priority(hits: DataFrame, priority: list[str], min_pct: float = 80, max_evalue: float = 1e-20) -> DataFrame:
    """(target, category): of the categories that reach a target, the first in the order given."""
    rank = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("category"))
    x = hits.where((F.col("pct") >= min_pct) & (F.col("evalue") <= max_evalue)).withColumn("_p", rank).where("_p > 0")
    return x.groupBy("target").agg(F.min_by("category", "_p").alias("category"))


def shares(df: DataFrame, column: str, least: float = 1.0) -> DataFrame:
    """(value, n, percent) of values with at least that percent."""
    total = df.count()
    c = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).withColumn("percent", F.col("n") * 100.0 / F.lit(max(total, 1)))
    return c.where(F.col("percent") >= least)


def alignment_summary(psl: DataFrame) -> DataFrame:
    """PSL rows with identity, gap percent, percent of the target, and score 5 match - 4 mismatch - 20 gap opens - log of the bases in gaps."""
    m, x, q, t = F.col("matches"), F.col("mismatches"), F.col("q_gaps"), F.col("t_gaps")
    gaps = F.col("q_gap_bases") + F.col("t_gap_bases")
    size = F.col("t_end") - F.col("t_start")
    return psl.withColumns({
        "identity": F.try_divide(m * 100.0, m + x), "gap_percent": F.try_divide(gaps * 100.0, m + x + gaps),
        "target_percent": F.try_divide(size * 100.0, F.col("t_length")), "align_score": m * 5.0 - x * 4.0 - (q + t) * 20.0 - F.ln(gaps + 1.0),
    })


def full_length(summary: DataFrame, min_identity: float = 95, max_gap: float = 5, min_length: float = 100) -> DataFrame:
    """(query, targets): queries with a full-length target; several targets are a fusion."""
    ok = summary.where((F.col("identity") >= min_identity) & (F.col("gap_percent") <= max_gap) & (F.col("target_percent") >= min_length))
    return ok.groupBy("query").agg(F.array_sort(F.collect_set("target")).alias("targets"))


def recovered_counts(maps: DataFrame) -> DataFrame:
    """One row: distinct targets reached by queries of a single target, and by those of several."""
    x = maps.select(F.size("targets").alias("n"), F.explode("targets").alias("t"))
    return x.agg(F.count_distinct(F.when(F.col("n") == 1, F.col("t"))).alias("single"), F.count_distinct(F.when(F.col("n") > 1, F.col("t"))).alias("fused"))


def fusion_comparison(a: DataFrame, b: DataFrame) -> DataFrame:
    """(fusion, where): fused target lists of two maps as BOTH, A_only or B_only."""
    one = lambda m, n: m.where(F.size("targets") > 1).select(F.array_join("targets", "--").alias("fusion")).distinct().withColumn(n, F.lit(True))
    x = one(a, "_a").join(one(b, "_b"), "fusion", "full")
    return x.select("fusion", F.when(F.col("_a") & F.col("_b"), "BOTH").when(F.col("_a"), "A_only").otherwise("B_only").alias("where"))


def tiers(alignments: DataFrame, most: float = 0.3, min_identity: float = 99) -> DataFrame:
    """Alignments (gene, query, lend, rend, score, identity) with a tier: best first, each in the first tier where it shares at most that part of the shorter one with any other.

    A gene's alignments pass in order of score and only its placed spans are held.
    """
    importable(alignments.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gene, placed = None, []
        for b in batches:
            out = []
            for g, lo, hi in zip(b["gene"], b["lend"], b["rend"], strict=True):
                if g != gene:
                    gene, placed = g, []
                for n, spans in enumerate(placed, 1):
                    if all(min(hi, h) - max(lo, s) + 1 <= most * (min(hi - lo, h - s) + 1) for s, h in spans):
                        spans.append((lo, hi))
                        out.append(n)
                        break
                else:
                    placed.append([(lo, hi)])
                    out.append(len(placed))
            yield b.assign(tier=out)

    x = alignments.where(F.col("identity") >= min_identity).select("gene", "query", "lend", "rend", "score")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in x.schema)
    ordered = x.withColumn("_o", -F.col("score")).repartition("gene").sortWithinPartitions("gene", "_o", "query", "lend").drop("_o")
    return ordered.mapInPandas(run, f"{kinds}, tier int")


def expression_quintiles(values: DataFrame, found: DataFrame, bins: int = 5, least: float = 0.0) -> DataFrame:
    """(bin, features, found): features in equal bins by rising value, and how many of each bin were found."""
    from .graphs import numbered

    kept = numbered(values.where(F.col("value") >= least).select("feature", "value"), "value", "feature")
    n = kept.count()
    x = kept.withColumn("bin", F.ceil((F.col("index") + 1) / F.lit(max(n, 1) / bins)).cast("int")).join(found.select("feature").distinct().withColumn("_f", F.lit(1)), "feature", "left")
    return x.groupBy("bin").agg(F.count(F.lit(1)).alias("features"), F.count("_f").alias("found"))
