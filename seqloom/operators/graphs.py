"""Graphs as tables of edges: components, clusters, link strength, chains, scaffolds.

Iterations write each round's small state to the shared checkpoint folder, so lineage stays short and a lost executor
costs one round at most; only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.formats import scratch_path
from ..workers import importable


def cut_lineage(df: DataFrame) -> DataFrame:
    """df written to the folder that the cluster shares, and read back.

    Unlike a checkpoint, the table brings none of the plan's constraints along, whose number doubles from round to round.
    """
    path = scratch_path(df.sparkSession, "round")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): component is the smallest node reachable; self pairs count, empty edges give no rows.

    Alternating stars: first every larger neighbour of a node, then every smaller one, is tied to the smallest node that
    the node knows. Long chains halve from round to round; it ends when the edges stand still.
    """
    pairs = cut_lineage(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna().distinct())
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    e, last = pairs.where("u <> v"), None
    for _ in range(max_rounds):
        both = e.union(e.select("v", "u").toDF("u", "v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        tied = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        below = tied.groupBy("u").agg(F.min("v").alias("m"))
        e = cut_lineage(tied.join(below, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(below).distinct())
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            return nodes.join(e.select(F.col("u").alias("node"), F.col("v").alias("c")), "node", "left").select("node", F.coalesce("c", "node").alias("component"))
        last = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def clusters(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(component, size, members in order)."""
    return components(edges, a, b).groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.array_sort(F.collect_list("node")).alias("members"))


def link_strength(edges: DataFrame, least: float = 0.0) -> DataFrame:
    """(a, b, common, strength) of each undirected pair: (common neighbours + 2) / (degrees less common ones).

    A pair's common neighbours are found by joining its ends' edges, so work follows the edges' degrees.
    """
    e = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = e.union(e.select("b", "a"))
    degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("d"))
    common = e.join(both.select("a", F.col("b").alias("c")), "a").join(both.select(F.col("a").alias("b"), F.col("b").alias("c")), ["b", "c"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"))
    x = e.join(common, ["a", "b"], "left").na.fill(0, ["common"]).join(degree.select("a", F.col("d").alias("da")), "a").join(degree.select(F.col("a").alias("b"), F.col("d").alias("db")), "b")
    strength = (F.col("common") + 2) / (F.col("da") + F.col("db") - F.col("common"))
    # The two ends count as neighbours of each other's, which is what the 2 stands for.
    return x.select("a", "b", "common", strength.alias("strength")).where(F.col("strength") >= least)


def capped_clusters(edges: DataFrame, most: int = 25, last: int = 100_000) -> DataFrame:
    """Single linkage in order of falling weight that never makes a cluster of over ``most`` members. edges: (a, b, weight).

    A pair that comes first among the pairs of both its clusters depends on no other, so each round joins all such pairs,
    whatever the size of the connected group. Pairs whose clusters have outgrown ``most`` together never fit again and go
    at once. The last ``last`` pairs are joined one by one in a single task. Pairs without an end are left out.
    """
    importable(edges.sparkSession)
    pairs = edges.select("a", "b", "weight").dropna(subset=["a", "b"])
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    kind = edges.schema["a"].dataType.simpleString()

    def fitting(df):
        """One row (u, v, rank, su, sv) for each pair of clusters that still fit together, at its first rank."""
        turned = F.col("u") > F.col("v")
        ends = [F.when(turned, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("u", "v"), ("v", "u"), ("su", "sv"), ("sv", "su"))]
        kept = df.where((F.col("u") != F.col("v")) & (F.col("su") + F.col("sv") <= most)).select("rank", *ends)
        return cut_lineage(kept.groupBy("u", "v").agg(F.min("rank").alias("rank"), F.first("su").alias("su"), F.first("sv").alias("sv")))

    def one_by_one(batches):
        import pandas as pd

        parent, size, out = {}, {}, []

        def root(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        for r in pd.concat([pd.DataFrame(columns=["u", "v", "rank", "su", "sv"]), *batches]).sort_values("rank").itertuples():
            size.setdefault(r.u, r.su)
            size.setdefault(r.v, r.sv)
            x, y = sorted((root(r.u), root(r.v)))
            if x != y and size[x] + size[y] <= most:
                parent[y] = x
                size[x] += size[y]
                out.append((y, x))
        yield pd.DataFrame(out, columns=["old", "new"])

    one = F.lit(1).cast("long")
    left = fitting(numbered(pairs, F.desc("weight"), "a", "b").select(F.col("a").alias("u"), F.col("b").alias("v"), F.col("index").alias("rank"), one.alias("su"), one.alias("sv")))
    joined = []
    while left.count() > last:
        first = left.select("u", "rank").union(left.select("v", "rank")).groupBy("u").agg(F.min("rank").alias("rank"))
        free = first.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).where("n = 2").select("rank")
        both = F.array(*(F.struct(F.col(x).alias("old"), F.col("u").alias("new"), (F.col("su") + F.col("sv")).alias("size")) for x in "uv"))
        moved = cut_lineage(left.join(free, "rank").select(F.inline(both)))
        joined.append(moved.where("old <> new").select("old", "new"))
        for x in "uv":
            left = left.join(moved.select(F.col("old").alias(x), "new", "size"), x, "left").withColumns({x: F.coalesce("new", x), f"s{x}": F.coalesce("size", f"s{x}")}).drop("new", "size")
        left = fitting(left)
    tied = left.coalesce(1).mapInPandas(one_by_one, f"old {kind}, new {kind}")
    for moves in joined:
        tied = tied.union(moves)
    named = components(tied, "old", "new").withColumnRenamed("component", "cluster")
    return nodes.join(named, "node", "left").select("node", F.coalesce("cluster", "node").alias("cluster"))


def missing_reverse(edges: DataFrame) -> DataFrame:
    """Edges (a, b) whose reverse is not there."""
    return edges.select("a", "b").join(edges.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")


def chains(edges: DataFrame, k: int) -> DataFrame:
    """Unbranched chains of k-mer edges (src, dst, weight) as (unitig, sequence, kmers, weight); nodes off every chain are chains of one."""
    out = edges.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("o"))
    into = edges.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("i"))
    inner = edges.join(out.where("o = 1").select(F.col("node").alias("src")), "src", "left_semi").join(into.where("i = 1").select(F.col("node").alias("dst")), "dst", "left_semi").where("src <> dst")
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    # Rings have no first node: the smallest k-mer of a group of inner edges as many as its nodes becomes one.
    group = components(inner, "src", "dst")
    size = group.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    n_edges = inner.join(group, F.col("src") == F.col("node")).groupBy("component").agg(F.count(F.lit(1)).alias("e"))
    rings = size.join(n_edges, "component").where("n = e").select(F.col("component").alias("dst"))
    line = inner.join(rings, "dst", "left_anti").select(F.col("dst").alias("node"), F.col("src").alias("prev"))
    at = cut_lineage(nodes.join(line, "node", "left").select("node", F.coalesce("prev", "node").alias("head"), F.when(F.col("prev").isNotNull(), 1).otherwise(0).cast("long").alias("step")))
    while True:
        up = at.select(F.col("node").alias("head"), F.col("head").alias("far"), F.col("step").alias("more"))
        new = cut_lineage(at.join(up, "head").select("node", F.col("far").alias("head"), (F.col("step") + F.col("more")).alias("step"), F.col("more")))
        at = new.drop("more")
        if new.where("more > 0").isEmpty():
            break
    weight = inner.groupBy(F.col("dst").alias("node")).agg(F.sum("weight").alias("w"))
    parts = at.join(weight, "node", "left").groupBy("head").agg(F.array_sort(F.collect_list(F.struct("step", "node"))).alias("p"), F.sum(F.when(F.col("step") > 0, F.col("w"))).alias("weight"))
    tail = F.array_join(F.transform(F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0))), lambda x: F.substring(x.node, k, 1)), "")
    return parts.select(F.col("head").alias("unitig"), F.concat(F.col("head"), tail).alias("sequence"), F.size("p").alias("kmers"), F.coalesce("weight", F.lit(0).cast("long")).alias("weight"))


def scaffold_links(hits: DataFrame) -> DataFrame:
    """(a, b, n) of contig pairs linked by fragments whose left and right reads hit exactly one contig each. hits: (fragment, side, contig)."""
    one = hits.distinct().groupBy("fragment").agg(F.collect_set(F.when(F.col("side") == 1, F.col("contig"))).alias("l"), F.collect_set(F.when(F.col("side") == 2, F.col("contig"))).alias("r")).where("size(l) = 1 and size(r) = 1")
    x = one.select(F.element_at("l", 1).alias("l"), F.element_at("r", 1).alias("r")).where("l <> r")
    return x.groupBy(F.least("l", "r").alias("a"), F.greatest("l", "r").alias("b")).agg(F.count(F.lit(1)).alias("n"))


def best_links(*tables: DataFrame) -> DataFrame:
    """Best count per unordered pair over several tables (a, b, n)."""
    out = tables[0].select("a", "b", "n")
    for t in tables[1:]:
        out = out.union(t.select("a", "b", "n"))
    return out.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("n").alias("n"))


def to_dot(edges: DataFrame, name: str = "g") -> DataFrame:
    """Lines of a graph description, one per edge, with its head and foot; (ord, line)."""
    spark = edges.sparkSession
    body = edges.select(F.lit(1).alias("ord"), F.format_string('  "%s" -> "%s";', F.col("a").cast("string"), F.col("b").cast("string")).alias("line"))
    return spark.createDataFrame([(0, f"digraph {name} {{"), (2, "}")], "ord int, line string").union(body)


def best_supported_paths(edges: DataFrame, most: int = 10) -> DataFrame:
    """(component, rank, path, support): paths through each connected acyclic group, the most supported first. edges: (src, dst, weight).

    A group's best paths to each node are kept while nodes pass in topological order; groups with a cycle are cut at the
    lightest edge of it.
    """
    importable(edges.sparkSession)
    comp = components(edges, "src", "dst")
    grouped = edges.join(comp.select(F.col("node").alias("src"), "component"), "src").select("component", "src", "dst", "weight")
    kind = edges.schema["src"].dataType.simpleString()

    def run(group):
        import heapq

        import pandas as pd

        todo = [tuple(r) for r in group[["src", "dst", "weight"]].itertuples(index=False)]
        while True:
            into, outs = {}, {}
            for s, d, w in todo:
                into.setdefault(s, 0)
                into[d] = into.get(d, 0) + 1
                outs.setdefault(s, []).append((d, w))
            ready, order, left = sorted(n for n, c in into.items() if not c), [], dict(into)
            heapq.heapify(ready)
            while ready:
                n = heapq.heappop(ready)
                order.append(n)
                for d, _ in outs.get(n, ()):
                    left[d] -= 1
                    if not left[d]:
                        heapq.heappush(ready, d)
            if len(order) == len(into):
                break
            stuck = set(into) - set(order)
            todo.remove(min((e for e in todo if e[0] in stuck and e[1] in stuck), key=lambda e: (e[2], e[0], e[1])))
        best = {n: [] for n in order}
        for n in order:
            if not into[n]:
                best[n] = [(0.0, [n])]
            for d, w in sorted(outs.get(n, ())):
                best[d] = sorted(best[d] + [(s + w, p + [d]) for s, p in best[n]], key=lambda x: (-x[0], x[1]))[:most]
        ends = sorted((x for n in order if n not in outs for x in best[n]), key=lambda x: (-x[0], x[1]))[:most]
        return pd.DataFrame([(group["component"].iloc[0], i, p, float(s)) for i, (s, p) in enumerate(ends, 1)], columns=["component", "rank", "path", "support"])

    return grouped.groupBy("component").applyInPandas(run, f"component {kind}, rank int, path array<{kind}>, support double")


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """Rows with an index from 0 in the order given: ranks within range partitions plus the partitions' counts; no single-task sort."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    parts = cut_lineage(parts)
    first = parts.groupBy("_p").agg(F.min("_i").alias("_f"), F.count(F.lit(1)).alias("_n"))
    before = first.withColumn("_b", F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))).na.fill(0, ["_b"])
    return parts.join(F.broadcast(before.select("_p", "_f", "_b")), "_p").withColumn("index", F.col("_i") - F.col("_f") + F.col("_b")).drop("_p", "_i", "_f", "_b")


def running(df: DataFrame, value: str, *order: str, name: str = "run") -> DataFrame:
    """Rows with the sum of value over all rows up to them in the order given, which should leave no ties: sums within range partitions plus what the partitions before hold. No single-task window."""
    parts = cut_lineage(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    own = F.sum(value).over(Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    whole = parts.groupBy("_p").agg(F.sum(value).alias("_s"))  # one row a partition
    before = whole.select("_p", F.coalesce(F.sum("_s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return parts.withColumn(name, own).join(F.broadcast(before), "_p").withColumn(name, F.col(name) + F.col("_b")).drop("_p", "_b")


def average_ranks(df: DataFrame, by: str, column: str, name: str) -> DataFrame:
    """Rows with their rank by column among those of the same ``by``, ties sharing their mean. Ranks come from running sums over counts of values, so a group of any size is spread over tasks."""
    c = running(df.groupBy(by, column).agg(F.count(F.lit(1)).alias("_n")), "_n", by, column, name="_run")
    start = c.groupBy(by).agg(F.min(F.col("_run") - F.col("_n")).alias("_start"))
    ranks = c.join(start, by).select(by, column, (F.col("_run") - F.col("_n") - F.col("_start") + (F.col("_n") + 1) / 2).alias(name))
    return df.join(ranks, [by, column])
