"""Closed intervals on scaffolds: depth, islands, merges, overlap and nearest joins, sliding Jaccard windows, clip points.

Frames have columns scaffold, lend, rend unless said otherwise. Depth works on +1/-1 events, so its cost follows the
number of intervals and not the bases they cover; joins deal intervals to bins of a width that is a parameter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workers import importable

UNBOUNDED = Window.unboundedPreceding


# Depth -----------------------------------------------------------------------------------------------------------
def depth_runs(frags: DataFrame) -> DataFrame:
    """(scaffold, lend, rend, depth): stretches of equal depth over 0. One partial sum per position, then one pass per scaffold."""
    events = frags.select("scaffold", F.explode(F.array(F.struct(F.col("lend").alias("pos"), F.lit(1).alias("d")), F.struct((F.col("rend") + 1).alias("pos"), F.lit(-1).alias("d")))).alias("e"))
    steps = events.groupBy("scaffold", "e.pos").agg(F.sum("e.d").alias("d")).where("d <> 0")
    w = Window.partitionBy("scaffold").orderBy("pos")
    runs = steps.select("scaffold", F.col("pos").alias("lend"), (F.lead("pos").over(w) - 1).alias("rend"), F.sum("d").over(w.rowsBetween(UNBOUNDED, 0)).alias("depth"))
    return runs.where("depth > 0")


def depth_positions(runs: DataFrame) -> DataFrame:
    """(scaffold, pos, depth) of every covered base."""
    return runs.select("scaffold", F.explode(F.sequence("lend", "rend")).alias("pos"), "depth")


def islands(runs: DataFrame, least: int = 1) -> DataFrame:
    """(scaffold, lend, rend, length, max_depth): stretches of neighbouring bases whose depth is least or more."""
    w = Window.partitionBy("scaffold").orderBy("lend")
    new = F.when(F.lag("rend").over(w) + 1 == F.col("lend"), 0).otherwise(1)
    g = runs.where(F.col("depth") >= least).withColumn("_n", new).withColumn("_g", F.sum("_n").over(w.rowsBetween(UNBOUNDED, 0)))
    return g.groupBy("scaffold", "_g").agg(F.min("lend").alias("lend"), F.max("rend").alias("rend"), F.max("depth").alias("max_depth")).select("scaffold", "lend", "rend", (F.col("rend") - F.col("lend") + 1).alias("length"), "max_depth")


def boundary_counts(frags: DataFrame) -> DataFrame:
    """(scaffold, pos, n): how many fragments start or end at each position."""
    return frags.select("scaffold", F.explode(F.array("lend", "rend")).alias("pos")).groupBy("scaffold", "pos").agg(F.count(F.lit(1)).alias("n"))


# Merging ---------------------------------------------------------------------------------------------------------
def merged(frags: DataFrame, *by: str, gap: int = 0) -> DataFrame:
    """Overlapping intervals as one, per scaffold (and by). Sharing a base merges; gap > 0 also bridges so many bases between."""
    keys = ["scaffold", *by]
    # Equal starts are summed up first: one row per start reaches the window.
    f = frags.groupBy(*keys, "lend").agg(F.max("rend").alias("rend"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy("lend")
    before = F.max("rend").over(w.rowsBetween(UNBOUNDED, -1))
    g = f.withColumn("_new", F.when(F.col("lend") <= before + gap, 0).otherwise(1)).withColumn("_g", F.sum("_new").over(w.rowsBetween(UNBOUNDED, 0)))
    return g.groupBy(*keys, "_g").agg(F.min("lend").alias("lend"), F.max("rend").alias("rend"), F.sum("n").alias("n")).drop("_g")


def sessions(frags: DataFrame, within: int) -> DataFrame:
    """Intervals in order of start, joined while the next one starts at most so far behind the last one's end."""
    w = Window.partitionBy("scaffold").orderBy("lend", "rend")
    g = frags.withColumn("_new", F.when(F.col("lend") - F.lag("rend").over(w) <= within, 0).otherwise(1)).withColumn("_g", F.sum("_new").over(w.rowsBetween(UNBOUNDED, 0)))
    return g.groupBy("scaffold", "_g").agg(F.min("lend").alias("lend"), F.max_by("rend", F.struct("lend", "rend")).alias("rend"), F.count(F.lit(1)).alias("n")).drop("_g")


def elementary_segments(frags: DataFrame, owner: str) -> DataFrame:
    """(scaffold, lend, rend, owners): pieces between all starts and ends, each with the sorted names that cover it."""
    cuts = frags.select("scaffold", F.explode(F.array(F.col("lend"), F.col("rend") + 1)).alias("lend")).distinct()
    w = Window.partitionBy("scaffold").orderBy("lend")
    pieces = cuts.withColumn("rend", F.lead("lend").over(w) - 1).where("rend is not null")
    f = frags.select(F.col("scaffold").alias("_s"), F.col("lend").alias("_l"), F.col("rend").alias("_r"), F.col(owner).alias("_o"))
    return overlap_join(pieces.withColumnsRenamed({"scaffold": "s"}), f.withColumnsRenamed({"_s": "s"}), "s", ("lend", "rend"), ("_l", "_r")).groupBy(F.col("s").alias("scaffold"), "lend", "rend").agg(F.array_sort(F.collect_set("_o")).alias("owners"))


def relocated(segments: DataFrame) -> DataFrame:
    """Segments with their place in the sequence that joining them in order makes: (…, to_lend, to_rend)."""
    w = Window.partitionBy("scaffold").orderBy("lend")
    size = F.col("rend") - F.col("lend") + 1
    end = F.sum(size).over(w.rowsBetween(UNBOUNDED, 0))
    return segments.withColumn("to_rend", end).withColumn("to_lend", F.col("to_rend") - size + 1)


def split_at(frags: DataFrame, points: DataFrame, shortest: int = 50) -> DataFrame:
    """Intervals cut at the points (scaffold, pos) inside them; pieces shorter than shortest go, the last one stays."""
    met = points_in_intervals(points, frags.select("scaffold", "lend", "rend").distinct(), "scaffold", "pos", ("lend", "rend"))
    inside = met.where("pos > lend and pos < rend").groupBy("scaffold", "lend", "rend").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    all_ = frags.join(inside, ["scaffold", "lend", "rend"], "left").withColumn("at", F.coalesce("at", F.array().cast("array<long>")))
    ends = F.concat("at", F.array(F.col("rend").cast("long")))
    starts = F.concat(F.array(F.col("lend").cast("long")), F.transform("at", lambda p: p + 1))
    pieces = all_.select("scaffold", F.posexplode(F.arrays_zip(starts.alias("lend"), ends.alias("rend"))).alias("i", "p"), F.size("at").alias("last"))
    return pieces.select("scaffold", "p.lend", "p.rend", "i", "last").where((F.col("rend") - F.col("lend") + 1 >= shortest) | (F.col("i") == F.col("last"))).select("scaffold", "lend", "rend")


# Joins -----------------------------------------------------------------------------------------------------------
def _bins(lo: Column, hi: Column, width: int) -> Column:
    return F.sequence(F.floor(lo / width), F.floor(hi / width))


def overlap_join(a: DataFrame, b: DataFrame, key: str, a_cols: tuple[str, str], b_cols: tuple[str, str], width: int = 64) -> DataFrame:
    """Pairs on the same key whose closed intervals share a base.

    Both sides are dealt to bins, an equi-join does the rest, and a pair counts in the bin where its overlap starts, so none
    comes twice. width should be near the usual length of an interval.
    """
    al, ar = (F.col(c) for c in a_cols)
    bl, br = (F.col(c) for c in b_cols)
    x = a.withColumn("_bin", F.explode(_bins(al, ar, width)))
    y = b.withColumn("_bin", F.explode(_bins(bl, br, width)))
    return x.join(y, [key, "_bin"]).where((al <= br) & (ar >= bl) & (F.floor(F.greatest(al, bl) / width) == F.col("_bin"))).drop("_bin")


def points_in_intervals(points: DataFrame, intervals: DataFrame, key: str, pos: str, cols: tuple[str, str], width: int = 64) -> DataFrame:
    y = intervals.withColumn("_bin", F.explode(_bins(F.col(cols[0]), F.col(cols[1]), width)))
    return points.withColumn("_bin", F.floor(F.col(pos) / width)).join(y, [key, "_bin"]).where(F.col(pos).between(F.col(cols[0]), F.col(cols[1]))).drop("_bin")


def nearest(points: DataFrame, features: DataFrame, key: str = "scaffold") -> DataFrame:
    """Points (key, pos) with the last feature (name, lend, rend) that ends before and the first that starts behind them.

    An as-of join: both sides in one ordered pass per key, carrying the last name seen each way. Columns: the point's,
    previous, previous_distance, next, next_distance.
    """
    none = F.lit(None)
    p = points.select("*", F.col("pos").alias("_at"), F.lit(1).alias("_kind"), none.cast("string").alias("_end"), none.cast("string").alias("_start"))
    extra = [c for c in points.columns if c not in (key, "pos")]
    blank = [none.cast(points.schema[c].dataType).alias(c) for c in extra]
    cols = [key, *extra, "pos", "_at", "_kind", "_end", "_start"]
    ends = features.select(key, *blank, F.col("rend").cast(points.schema["pos"].dataType).alias("pos"), F.col("rend").alias("_at"), F.lit(2).alias("_kind"), F.col("name").alias("_end"), none.cast("string").alias("_start"))
    starts = features.select(key, *blank, F.col("lend").cast(points.schema["pos"].dataType).alias("pos"), F.col("lend").alias("_at"), F.lit(0).alias("_kind"), none.cast("string").alias("_end"), F.col("name").alias("_start"))
    both = p.select(*cols).union(ends.select(*cols)).union(starts.select(*cols))
    # At one position starts come before points and ends behind them, so that only features wholly to a side count.
    back = Window.partitionBy(key).orderBy("_at", "_kind", "_end").rowsBetween(UNBOUNDED, 0)
    ahead = Window.partitionBy(key).orderBy("_at", "_kind", F.desc("_start")).rowsBetween(1, Window.unboundedFollowing)
    seen_end, seen_start = F.when(F.col("_end").isNotNull(), F.struct("_end", "_at")), F.when(F.col("_start").isNotNull(), F.struct("_start", "_at"))
    out = both.withColumn("_p", F.last(seen_end, True).over(back)).withColumn("_n", F.first(seen_start, True).over(ahead)).where("_kind = 1")
    return out.select(*points.columns, F.col("_p._end").alias("previous"), (F.col("pos") - F.col("_p._at")).alias("previous_distance"), F.col("_n._start").alias("next"), (F.col("_n._at") - F.col("pos")).alias("next_distance"))


# Fragments of read pairs -----------------------------------------------------------------------------------------
def paired_fragments(spans: DataFrame, least: int = 100, most: int = 500, singles: bool = True) -> DataFrame:
    """Read spans (scaffold, core, side, lend, rend): the first of each side per scaffold and name as one fragment if their insert is in bounds, else two."""
    w = Window.partitionBy("scaffold", "core", "side").orderBy("lend", "rend")
    first = spans.withColumn("_r", F.row_number().over(w)).where("_r = 1")
    both = first.groupBy("scaffold", "core").agg(F.min("lend").alias("lo"), F.max("rend").alias("hi"), F.count_distinct("side").alias("sides"), F.collect_list(F.struct("lend", "rend")).alias("parts"))
    insert = F.col("hi") - F.col("lo") + 1
    whole = (F.col("sides") == 2) & insert.between(least, most)
    out = both.select("scaffold", "core", F.explode(F.when(whole, F.array(F.struct(F.col("lo").alias("lend"), F.col("hi").alias("rend")))).otherwise(F.col("parts") if singles else F.array().cast("array<struct<lend:bigint,rend:bigint>>"))).alias("f"))
    return out.select("scaffold", "core", "f.lend", "f.rend")


def capped_per_start(reads: DataFrame, most: int, order: str) -> DataFrame:
    """At most so many reads per scaffold and start, the first by order."""
    w = Window.partitionBy("scaffold", "lend").orderBy(order)
    return reads.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most).drop("_r")


def capped_coverage(reads: DataFrame, most: int = 200) -> DataFrame:
    """Reads (scaffold, name, lend, rend) in order of start, kept while fewer than so many kept ones cover their start; a kept read's mates stay too.

    Each scaffold's reads pass in order, and only the ends of those that still cover the current start are held.
    """
    importable(reads.sparkSession)
    import heapq

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scaffold, ends = None, []
        for b in batches:
            keep = []
            for s, lend, rend in zip(b["scaffold"], b["lend"], b["rend"], strict=True):
                if s != scaffold:
                    scaffold, ends = s, []
                while ends and ends[0] < lend:
                    heapq.heappop(ends)
                if ok := len(ends) < most:
                    heapq.heappush(ends, rend)
                keep.append(ok)
            yield b[keep]

    fields = ["scaffold", "name", "lend", "rend"]
    kept = reads.select(*fields).repartition("scaffold").sortWithinPartitions("scaffold", "lend", "rend", "name").mapInPandas(run, reads.select(*fields).schema)
    return reads.join(kept.select("name").distinct(), "name", "left_semi")


# Sliding Jaccard -------------------------------------------------------------------------------------------------
def jaccard_windows(frags: DataFrame, width: int = 100, pseudocount: float = 1.0) -> DataFrame:
    """(scaffold, pos, both, single, jaccard) where a fragment starts or ends: how many cover both edges of the window from there, and how many only one.

    The edges' depths come from running sums of events; fragments over both edges are those that cover an interval of width, so
    they are a depth too, of fragments shortened by width - 1. One sort per scaffold does all three.
    """
    w1 = width - 1
    event = lambda pos, left, right, both: F.struct(pos.alias("pos"), F.lit(left).alias("l"), F.lit(right).alias("r"), F.lit(both).alias("b"))
    lend, rend = F.col("lend").cast("long"), F.col("rend").cast("long")
    parts = [event(lend, 1, 0, 0), event(rend + 1, -1, 0, 0), event(lend - w1, 0, 1, 0), event(rend - w1 + 1, 0, -1, 0)]
    long = F.when(rend - lend >= w1, F.array(event(lend, 0, 0, 1), event(rend - w1 + 1, 0, 0, -1))).otherwise(F.array().cast("array<struct<pos:bigint,l:int,r:int,b:int>>"))
    ev = frags.select("scaffold", F.explode(F.concat(F.array(*parts), long)).alias("e")).groupBy("scaffold", "e.pos").agg(F.sum("e.l").alias("l"), F.sum("e.r").alias("r"), F.sum("e.b").alias("b"))
    run = Window.partitionBy("scaffold").orderBy("pos").rowsBetween(UNBOUNDED, 0)
    s = ev.select("scaffold", "pos", *[F.sum(c).over(run).alias(c) for c in ("l", "r", "b")])
    single = F.col("l") + F.col("r") - 2 * F.col("b")
    return s.select("scaffold", "pos", F.col("b").alias("both"), single.alias("single"), ((F.col("b") + pseudocount) / (single + F.col("b") + pseudocount)).alias("jaccard"))


def dense(wig: DataFrame, value: str) -> DataFrame:
    """Values at event positions carried on to each position up to the last event of the scaffold."""
    w = Window.partitionBy("scaffold").orderBy("pos")
    run = wig.withColumn("_to", F.coalesce(F.lead("pos").over(w) - 1, F.col("pos")))
    return run.select("scaffold", F.explode(F.sequence("pos", "_to")).alias("pos"), value)


def troughs(points: DataFrame, width: int = 200, most: float = 0.05, least_delta: float = 0.35) -> DataFrame:
    """Clip points of dense values (scaffold, pos, jaccard).

    A trough is a value of at most ``most``, whose mean rise to the values half a window before and behind is its delta. Of
    troughs within a window of the one before, the lowest (then steepest, then first) stays, if on both sides within a
    window a value is higher by least_delta.
    """
    w = Window.partitionBy("scaffold").orderBy("pos")
    half = width // 2
    x = points.withColumn("_l", F.lag("jaccard", half).over(w)).withColumn("_r", F.lead("jaccard", half).over(w))
    near = Window.partitionBy("scaffold").orderBy("pos")
    x = x.withColumn("_hl", F.max("jaccard").over(near.rangeBetween(-width, -1))).withColumn("_hr", F.max("jaccard").over(near.rangeBetween(1, width)))
    x = x.withColumn("delta", ((F.col("_l") - F.col("jaccard")) + (F.col("_r") - F.col("jaccard"))) / 2).where((F.col("jaccard") <= most) & F.col("delta").isNotNull())
    x = x.withColumn("_new", F.when(F.col("pos") - F.lag("pos").over(w) <= width, 0).otherwise(1)).withColumn("_g", F.sum("_new").over(w.rowsBetween(UNBOUNDED, 0)))
    best = x.groupBy("scaffold", "_g").agg(F.min_by(F.struct("pos", "jaccard", "delta", "_hl", "_hr"), F.struct(F.col("jaccard"), -F.col("delta"), F.col("pos"))).alias("t"))
    out = best.select("scaffold", "t.*")
    return out.where((F.col("_hl") >= F.col("jaccard") + least_delta) & (F.col("_hr") >= F.col("jaccard") + least_delta)).select("scaffold", "pos", "jaccard", "delta")


def moved_to_lowest(clips: DataFrame, coverage: DataFrame, width: int = 200) -> DataFrame:
    """Clip points moved to the lowest coverage (scaffold, pos, depth) within half a window; the point itself wins ties, then the first."""
    half = width // 2
    c = clips.select("scaffold", F.col("pos").alias("clip"), (F.col("pos") - half).alias("lo"), (F.col("pos") + half).alias("hi"))
    near = points_in_intervals(coverage, c, "scaffold", "pos", ("lo", "hi"), width)
    return near.groupBy("scaffold", "clip").agg(F.min_by("pos", F.struct(F.col("depth"), F.when(F.col("pos") == F.col("clip"), 0).otherwise(1), F.col("pos"))).alias("pos"))


def clipped_sequences(seqs: DataFrame, clips: DataFrame) -> DataFrame:
    """(scaffold, piece, sequence): sequences cut behind each clip point."""
    at = clips.groupBy("scaffold").agg(F.array_sort(F.collect_set(F.col("pos").cast("int"))).alias("at"))
    x = seqs.join(at, "scaffold", "left").withColumn("at", F.filter(F.coalesce("at", F.array().cast("array<int>")), lambda p: (p > 0) & (p < F.length("sequence"))))
    edges = F.concat(F.array(F.lit(0)), F.col("at"), F.array(F.length("sequence")))
    pieces = F.transform(F.sequence(F.lit(1), F.size("at") + 1), lambda i: F.substring("sequence", F.element_at(edges, i) + 1, F.element_at(edges, i + 1) - F.element_at(edges, i)))
    return x.select("scaffold", F.posexplode(pieces).alias("piece", "sequence"))


# Gene structures -------------------------------------------------------------------------------------------------
def introns_of(exons: DataFrame, *by: str) -> DataFrame:
    """(…, lend, rend) between neighbouring exons of a transcript."""
    w = Window.partitionBy(*by).orderBy("lend")
    x = exons.withColumn("_next", F.lead("lend").over(w))
    return x.where(F.col("_next") > F.col("rend") + 1).select(*by, (F.col("rend") + 1).alias("lend"), (F.col("_next") - 1).alias("rend"))


def base_classes(features: DataFrame, lowest: int = 0) -> DataFrame:
    """(scaffold, lend, rend, code): the highest code of the features (scaffold, lend, rend, code) over each piece of a scaffold.

    Events per code in one ordered pass: a bit set of codes (under 31) that cover the piece.
    """
    ev = features.select("scaffold", "code", F.explode(F.array(F.struct(F.col("lend").alias("pos"), F.lit(1).alias("d")), F.struct((F.col("rend") + 1).alias("pos"), F.lit(-1).alias("d")))).alias("e")).groupBy("scaffold", "e.pos").agg(*[F.sum(F.when(F.col("code") == c, F.col("e.d")).otherwise(0)).alias(f"_c{c}") for c in range(1, 6)])
    w = Window.partitionBy("scaffold").orderBy("pos")
    run = ev.select("scaffold", F.col("pos").alias("lend"), (F.lead("pos").over(w) - 1).alias("rend"), *[F.sum(f"_c{c}").over(w.rowsBetween(UNBOUNDED, 0)).alias(f"_c{c}") for c in range(1, 6)])
    code = F.greatest(F.lit(lowest), *[F.when(F.col(f"_c{c}") > 0, c).otherwise(lowest) for c in range(1, 6)])
    return run.where("rend is not null").select("scaffold", "lend", "rend", code.alias("code"))


def locus_groups(transcripts: DataFrame) -> DataFrame:
    """Transcripts (scaffold, strand, name, lend, rend) with the number of their locus: those whose spans overlap on one strand."""
    w = Window.partitionBy("scaffold", "strand").orderBy("lend", "rend", "name")
    before = F.max("rend").over(w.rowsBetween(UNBOUNDED, -1))
    return transcripts.withColumn("_new", F.when(F.col("lend") <= before, 0).otherwise(1)).withColumn("locus", F.sum("_new").over(w.rowsBetween(UNBOUNDED, 0))).drop("_new")


def splice_events(introns: DataFrame, exons: DataFrame) -> DataFrame:
    """(gene, kind, lend, rend): alternative donors and acceptors, retained introns and skipped exons among a gene's transcripts.

    introns and exons: (gene, transcript, strand, lend, rend), forward coordinates. Whether an interval lies inside any of
    the other kind is seen from the farthest end among those that start before it, so no pairs are made.
    """
    i = introns.select("gene", "strand", "lend", "rend").distinct()
    plus = F.col("strand") == "+"
    same_right = i.join(i.withColumnRenamed("lend", "l2"), ["gene", "strand", "rend"]).where("lend < l2").select("gene", F.when(plus, "alt_donor").otherwise("alt_acceptor").alias("kind"), "lend", F.col("l2").alias("rend"))
    same_left = i.join(i.withColumnRenamed("rend", "r2"), ["gene", "strand", "lend"]).where("rend < r2").select("gene", F.when(plus, "alt_acceptor").otherwise("alt_donor").alias("kind"), F.col("rend").alias("lend"), F.col("r2").alias("rend"))
    e = exons.select("gene", "strand", "lend", "rend").distinct()
    both = i.withColumn("exon", F.lit(False)).union(e.withColumn("exon", F.lit(True)))
    before = Window.partitionBy("gene", "strand").orderBy("lend").rangeBetween(Window.unboundedPreceding, -1)
    far = both.withColumn("far", F.when(F.col("exon"), F.max(F.when(~F.col("exon"), F.col("rend"))).over(before)).otherwise(F.max(F.when(F.col("exon"), F.col("rend"))).over(before)))
    inside = far.where("far > rend").select("gene", F.when(F.col("exon"), "skipped_exon").otherwise("retained_intron").alias("kind"), "lend", "rend")
    return same_right.union(same_left).union(inside).distinct()
