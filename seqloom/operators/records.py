"""Records between formats, identifiers with what is known about them, checks of reads, and small comparisons of result tables.

Everything is a projection, a grouped aggregate or a join by key. Tables that a user supplies (lists of names, annotations)
are joined without hints, so the planner broadcasts them only if they are small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seq as S
from ..functions.alignments import has_flag




# Reads -----------------------------------------------------------------------------------------------------------
def _as_sequenced(flag: Column, seq: Column, quals: Column) -> tuple[Column, Column]:
    turned = ~has_flag(flag, "unmapped") & has_flag(flag, "reverse")
    return F.when(turned, S.reverse_complement(seq)).otherwise(seq), F.when(turned, F.reverse(quals)).otherwise(quals)


def sam_reads(sam: DataFrame) -> DataFrame:
    """(read_name, pair_dir, sequence, quals) of alignments, as they were sequenced; a mate's name ends in /1 or /2."""
    seq, quals = _as_sequenced(F.col("flag"), F.col("seq"), F.col("qual"))
    end = F.when(has_flag(F.col("flag"), "first"), 1).when(has_flag(F.col("flag"), "second"), 2).otherwise(0)
    name = F.when(end > 0, F.concat_ws("/", "qname", end.cast("string"))).otherwise(F.col("qname"))
    return sam.select(name.alias("read_name"), end.alias("pair_dir"), seq.alias("sequence"), quals.alias("quals"))


def sam_pairs(sam: DataFrame, order: str = "ord") -> DataFrame:
    """(core, left, left_quals, right, right_quals): each read's first left and first right end; reads that lack one go."""
    seq, quals = _as_sequenced(F.col("flag"), F.col("seq"), F.col("qual"))
    first = lambda end: F.min_by(F.when(has_flag(F.col("flag"), end), F.struct(seq.alias("s"), quals.alias("q"))), F.when(has_flag(F.col("flag"), end), F.col(order)))
    x = sam.groupBy(F.col("qname").alias("core")).agg(first("first").alias("l"), first("second").alias("r")).where("l is not null and r is not null")
    return x.select("core", F.col("l.s").alias("left"), F.col("l.q").alias("left_quals"), F.col("r.s").alias("right"), F.col("r.q").alias("right_quals"))


def psl_sam(psl: DataFrame) -> DataFrame:
    """SAM fields of PSL rows with blocks (t_blocks, q_blocks on the forward strand): gaps of the target are N, of the query I."""
    n = F.size("t_blocks")

    def part(b: Column, i: Column) -> Column:
        skip, add = F.get("t_blocks", i + 1).lend - b.rend - 1, F.get("q_starts0", i + 1) - F.get("q_starts0", i) - (b.rend - b.lend + 1)
        size = lambda x, o: F.when(x > 0, F.concat(x.cast("string"), F.lit(o))).otherwise("")
        return F.concat((b.rend - b.lend + 1).cast("string"), F.lit("M"), F.when(i + 1 < n, F.concat(size(add, "I"), size(skip, "N"))).otherwise(""))

    clip = lambda x: F.when(x > 0, F.concat(x.cast("string"), F.lit("S"))).otherwise("")
    starts = F.transform(F.filter(F.split("q_starts", ","), lambda s: s != ""), lambda s: s.cast("int"))
    x = psl.withColumn("q_starts0", starts)
    last = F.element_at("t_blocks", -1)
    tail = F.col("q_length") - F.element_at("q_starts0", -1) - (last.rend - last.lend + 1)
    cigar = F.concat(clip(F.element_at("q_starts0", 1)), F.array_join(F.transform("t_blocks", part), ""), clip(tail))
    return x.select(F.col("query").alias("qname"), F.when(F.col("strand").startswith("-"), 16).otherwise(0).alias("flag"), F.col("target").alias("rname"), (F.col("t_start") + 1).alias("pos"), cigar.alias("cigar"))


def strand_tagged(sam: DataFrame, strand: Column) -> DataFrame:
    """Alignments whose tags say the transcribed strand; verified: null where there was no such tag, else whether it said the same."""
    old = F.get(F.filter("tags", lambda t: t.startswith("XS:A:")), F.lit(0))
    tag = F.concat(F.lit("XS:A:"), strand)
    return sam.withColumn("verified", old == tag).withColumn("tags", F.concat(F.filter("tags", lambda t: ~t.startswith("XS:A:")), F.array(tag)))


def unpaired_within(sam: DataFrame, order: str, n: int = 10) -> DataFrame:
    """Those of the first n alignments that aren't of pairs: none in a paired library."""
    return sam.orderBy(order).limit(n).where(~has_flag(F.col("flag"), "paired"))


def out_of_order(sam: DataFrame, order: str, by: str, scaffold: str = "rname", pos: str = "pos") -> DataFrame:
    """Alignments that stand before their predecessor of the same scaffold in a file (``by``); none where a file is sorted by coordinates."""
    before = F.lag(pos).over(Window.partitionBy(by, scaffold).orderBy(order))
    return sam.withColumn("before", before).where(F.col(pos) < F.col("before"))


def sampled_or_unaligned(reads: DataFrame, sampled: DataFrame, aligned: DataFrame, key: str = "read_name") -> DataFrame:
    """Reads that are in the sample or that nothing aligned."""
    s, a = sampled.select(key).distinct().withColumn("_s", F.lit(True)), aligned.select(key).distinct().withColumn("_a", F.lit(True))
    return reads.join(s, key, "left").join(a, key, "left").where("_s is not null or _a is null").drop("_s", "_a")


def file_pairs(files: DataFrame, left: str = "_R1", right: str = "_R2", column: str = "path") -> DataFrame:
    """(name, left, right): files whose paths differ by the mark of their end only; what lacks a partner has null there."""
    side = lambda mark, name: files.where(F.col(column).contains(mark)).select(F.regexp_replace(column, mark.replace(".", r"\."), "").alias("name"), F.col(column).alias(name))
    return side(left, "left").join(side(right, "right"), "name", "full")


def with_long_reads(reads: DataFrame, long_reads: DataFrame, mark: str = "LR$|") -> DataFrame:
    """Both sets of (accession, sequence), the long reads' names marked."""
    return reads.select("accession", "sequence").unionByName(long_reads.select(F.concat(F.lit(mark), "accession").alias("accession"), "sequence"))


def parted_by_mark(reads: DataFrame, mark: str = "LR$|") -> tuple[DataFrame, DataFrame]:
    """The long reads and the others."""
    marked = F.col("accession").startswith(mark)
    return reads.where(marked), reads.where(~marked)


# Identifiers -----------------------------------------------------------------------------------------------------
def prefixed(df: DataFrame, names: DataFrame, column: str = "accession", joint: str = "^") -> DataFrame:
    """Rows whose name is preceded by what the table (accession, name) says of it; others stay as they are."""
    x = df.join(names.select(F.col("accession").alias(column), F.col("name").alias("_name")), column, "left")
    return x.withColumn(column, F.concat_ws(joint, "_name", column)).drop("_name")


def with_suffix(df: DataFrame, suffix: str, column: str = "read_name") -> DataFrame:
    return df.withColumn(column, F.concat(column, F.lit(suffix)))


def gene_annotations(transcripts: DataFrame, mrna: DataFrame, genes: DataFrame) -> DataFrame:
    """(transcript, gene, name): through (transcript, gene) and (gene, name); what isn't known is null."""
    return transcripts.select("transcript").join(mrna, "transcript", "left").join(genes, "gene", "left").select("transcript", "gene", "name")


def with_best_hit(df: DataFrame, hits: DataFrame, column: str = "accession", joint: str = "|") -> DataFrame:
    """Names joined with their last hit (accession, ord, hit), a transcript's own before that of its component."""
    last = hits.groupBy("accession").agg(F.max_by("hit", "ord").alias("hit"))
    own, of = last.toDF("_a", "_own"), last.toDF("_c", "_of")
    x = df.withColumn("_gene", S.gene_of_transcript(F.col(column))).join(own, F.col(column) == F.col("_a"), "left").join(of, F.col("_gene") == F.col("_c"), "left")
    return x.withColumn(column, F.concat_ws(joint, column, F.coalesce("_own", "_of"))).drop("_gene", "_a", "_own", "_c", "_of")


def without_control(column: Column) -> Column:
    return F.regexp_replace(column, r"[\x00-\x08\x0B-\x1F\x7F]", "")


def kept_columns(lines: Column, at: list[int], sep: str = "\t") -> Column:
    """The fields at these places, counted from 0, in the line's own order."""
    f = F.split(lines, sep)
    return F.concat_ws(sep, *[F.get(f, F.lit(i)) for i in sorted(set(at))])


def renamed_scaffolds(df: DataFrame, column: str = "scaffold") -> DataFrame:
    """Rows of placed chromosomes, their names without 'chr'."""
    return df.where(~F.col(column).rlike("random|chrUn")).withColumn(column, F.regexp_replace(column, "chr", ""))


# Filters ---------------------------------------------------------------------------------------------------------
def covered_transcripts(quant: DataFrame, reads: DataFrame, least: float = 2.0, first: int = 100, order: str = "ord") -> DataFrame:
    """Transcripts (feature, count, length) whose count x mean read length / length is least or more; the mean is of the first reads."""
    mean = reads.orderBy(order).limit(first).agg(F.avg(F.length("sequence")).alias("_read"))
    x = quant.crossJoin(F.broadcast(mean))  # one row
    return x.withColumn("coverage", F.col("count") * F.col("_read") / F.col("length")).where(F.col("coverage") >= least).drop("_read")


def listed_lines(gtf: DataFrame, names: DataFrame, key: str = "transcript") -> tuple[DataFrame, DataFrame]:
    """The lines of listed transcripts, and the names that no line has, which should be none."""
    return gtf.join(names.select(key), key, "left_semi"), names.select(key).distinct().join(gtf.select(key), key, "left_anti")


def similar_with_expression(members: DataFrame, least_length: float = 0.9, least_expression: float = 0.05) -> DataFrame:
    """(cluster, accession) kept of members (cluster, accession, length, expr): the reference is the most expressed of those nearly as long as the longest, the others need a share of its expression."""
    longest = members.groupBy("cluster").agg(F.max("length").alias("longest"))
    x = members.join(longest, "cluster")
    ref = x.where(F.col("length") >= least_length * F.col("longest")).groupBy("cluster").agg(F.max("expr").alias("ref"))
    return x.join(ref, "cluster").where(F.col("expr") >= least_expression * F.col("ref")).select("cluster", "accession")


def without_lone_nodes(nodes: DataFrame, edges: DataFrame, shortest: int) -> DataFrame:
    """Nodes (node, length) but for those without an edge that are shorter than that."""
    linked = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct().withColumn("_e", F.lit(True))
    return nodes.join(linked, "node", "left").where((F.col("length") >= shortest) | F.col("_e").isNotNull()).drop("_e")


def in_both_ends(pairs: DataFrame, names: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Pairs whose two ends are both listed."""
    n = names.columns[0]
    return pairs.join(names.select(F.col(n).alias(a)).distinct(), a, "left_semi").join(names.select(F.col(n).alias(b)).distinct(), b, "left_semi")


# Comparisons -----------------------------------------------------------------------------------------------------
def positive_in_both(a: DataFrame, b: DataFrame, key: str = "feature", value: str = "value") -> DataFrame:
    """(key, value_a, value_b) where both are over 0."""
    return a.select(key, F.col(value).alias("value_a")).join(b.select(key, F.col(value).alias("value_b")), key).where("value_a > 0 and value_b > 0")


def hits_with_values(hits: DataFrame, values: DataFrame) -> DataFrame:
    """Hits (hit, gene, transcripts array) with the value of the gene, or else the greatest of its transcripts. values: (feature, value)."""
    own = hits.join(values.select(F.col("feature").alias("gene"), F.col("value").alias("_g")), "gene", "left")
    of = hits.select("hit", F.explode("transcripts").alias("feature")).join(values, "feature").groupBy("hit").agg(F.max("value").alias("_t"))
    return own.join(of, "hit", "left").select("hit", "gene", F.coalesce("_g", "_t").alias("value"))


def shared_components(graphs: DataFrame, reads: DataFrame, shortest: int = 200, k: int = 24) -> DataFrame:
    """(component, kmers, reads): components present on both sides whose k-mers make a sequence long enough."""
    g = graphs.groupBy("component").agg(F.sum("kmers").alias("kmers")).where(F.col("kmers") + k >= shortest)
    return g.join(reads.groupBy("component").agg(F.count(F.lit(1)).alias("reads")), "component")


def named_by_index(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """Pairs of indexes (a, b) with the names (index, name) of both."""
    one = lambda c: names.select(F.col("index").alias(c), F.col("name").alias(f"name_{c}"))
    return pairs.join(one("a"), "a").join(one("b"), "b")


def rank_comparison(genes: DataFrame, transcripts: DataFrame, n: int, key: str = "feature") -> DataFrame:
    """(key, gene_score, trans_score, gene_top, trans_top): scores of both sides, -log10 of the FDR, and whether either has the row among its first n."""
    def side(df: DataFrame, name: str) -> DataFrame:
        score = -F.log10(F.greatest(F.col("fdr"), F.lit(1e-300)))
        top = df.select(key, F.col("fdr")).orderBy("fdr", key).limit(n).select(key, F.lit(True).alias(f"{name}_top"))
        return df.select(key, score.alias(f"{name}_score")).join(top, key, "left").na.fill(False, [f"{name}_top"])

    x = side(genes, "gene").join(side(transcripts, "trans"), key, "full")
    return x.na.fill(False, ["gene_top", "trans_top"])


def agreed(summary: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows (feature, a, b) whose feature and samples, in whatever order, are among the keys."""
    pair = lambda df: df.withColumn("_p", F.array_sort(F.array("a", "b")))
    return pair(summary).join(pair(keys).select("feature", "_p").distinct(), ["feature", "_p"], "left_semi").drop("_p")


def same_direction(de: DataFrame, long: DataFrame) -> DataFrame:
    """(feature, log_fc, mean_a, mean_b, agrees): whether samples' means change as the row (feature, a, b, log_fc) says."""
    means = long.groupBy("feature", "sample").agg(F.avg("value").alias("m"))
    one = lambda c: means.select("feature", F.col("sample").alias(c), F.col("m").alias(f"mean_{c}"))
    x = de.join(one("a"), ["feature", "a"]).join(one("b"), ["feature", "b"])
    return x.select("feature", "log_fc", "mean_a", "mean_b", (F.signum("log_fc") == F.signum(F.col("mean_a") - F.col("mean_b"))).alias("agrees"))


def paths_apart(a: DataFrame, b: DataFrame) -> DataFrame:
    """(both, only_a, only_b): numbers of distinct paths of two sets, where a path that is part of one of the other set counts for neither. a, b: (path array)."""
    one = lambda df: df.select(F.concat(F.lit("|"), F.array_join("path", "|"), F.lit("|")).alias("p"), "path").distinct()
    def alone(x: DataFrame, y: DataFrame) -> DataFrame:
        whole = y.select(F.explode(F.array_distinct("path")).alias("first"), F.col("p").alias("w"))
        return x.select("p", F.element_at("path", 1).alias("first")).join(whole, "first", "left").groupBy("p").agg(F.coalesce(F.max(F.col("w").contains(F.col("p"))), F.lit(False)).alias("part"), F.coalesce(F.max(F.col("w") == F.col("p")), F.lit(False)).alias("same"))

    x, y = alone(one(a), one(b)), alone(one(b), one(a))
    count = lambda df, c, n: df.agg(F.coalesce(F.sum(F.when(F.expr(c), 1).otherwise(0)), F.lit(0)).alias(n))
    return count(x, "same", "both").crossJoin(count(x, "not part", "only_a")).crossJoin(count(y, "not part", "only_b"))  # one row each


# Counts ----------------------------------------------------------------------------------------------------------
def crossed(df: DataFrame, row: str, column: str, names: list[str], share: bool = False, distinct: str | None = None) -> DataFrame:
    """(row, a column per name, total): counts of rows, or of distinct values, 0 where there are none; with share in percent of each column."""
    what = (lambda c: F.count_distinct(F.when(F.col(column) == c, F.col(distinct)))) if distinct else (lambda c: F.sum(F.when(F.col(column) == c, 1).otherwise(0)))
    x = df.groupBy(row).agg(*[what(c).alias(c) for c in names])
    if share:
        sums = x.agg(*[F.sum(c).alias(f"_{c}") for c in names])
        x = x.crossJoin(F.broadcast(sums)).select(row, *[F.coalesce(F.try_divide(F.col(c) * 100.0, F.col(f"_{c}")), F.lit(0.0)).alias(c) for c in names])  # one row
    return x.withColumn("total", reduce(lambda a, b: a + b, [F.col(c) for c in names]))


def best_stranded(balance: DataFrame, percent: int, total: str = "total") -> DataFrame:
    """The given percent of rows with the greatest totals, at least one; ties go by transcript."""
    n = balance.count()
    return balance.orderBy(F.desc(total), "transcript").limit(max(1, n * percent // 100)) if n else balance


def mapped_counts(rows: DataFrame, by: str, length: int, pct_length: float, pct_identity: float) -> DataFrame:
    """(by, mapped, good, ratio): matches of that length, and those of them that cover and agree enough."""
    ok = F.col("length") >= length
    good = ok & (F.col("pct_length") >= pct_length) & (F.col("pct_identity") >= pct_identity)
    x = rows.groupBy(by).agg(F.sum(F.when(ok, 1).otherwise(0)).alias("mapped"), F.sum(F.when(good, 1).otherwise(0)).alias("good"))
    return x.withColumn("ratio", F.try_divide(F.col("good"), F.col("mapped")))


def nx_above(rows: DataFrame, thresholds: list[float], percent: int = 50) -> DataFrame:
    """(threshold, features, nx) of the rows (length, expr) with that expression or more. Lengths are counted first, so that the running sums go over distinct lengths."""
    x = rows.select("length", F.explode(F.filter(F.array(*map(F.lit, thresholds)), lambda t: t <= F.col("expr"))).alias("threshold"))
    c = x.groupBy("threshold", "length").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("threshold")
    run = F.sum(F.col("n") * F.col("length")).over(w.orderBy(F.desc("length")))
    c = c.select("threshold", "length", "n", run.alias("run"), F.sum(F.col("n") * F.col("length")).over(w).alias("total"))
    return c.groupBy("threshold").agg(F.sum("n").alias("features"), F.max(F.when(F.col("run") * 100 >= F.col("total") * percent, F.col("length"))).alias("nx"))


def up_and_down(classes: DataFrame) -> DataFrame:
    """(feature, ups, downs, total, distinct_samples) of the comma lists up and down."""
    part = lambda c: F.filter(F.split(c, ","), lambda s: s != "")
    u, d = part("up"), part("down")
    return classes.select("feature", F.size(u).alias("ups"), F.size(d).alias("downs"), (F.size(u) + F.size(d)).alias("total"), F.size(F.array_union(u, d)).alias("distinct_samples"))


def map_names(maps: DataFrame, genes: bool = True) -> DataFrame:
    """Each gene, or transcript, of lists 'gene;transcript,gene;transcript'; repeated ones stay."""
    x = maps.select(F.explode(F.filter(F.split("names", ","), lambda s: s != "")).alias("p"))
    return x.select(F.get(F.split("p", ";"), F.lit(0 if genes else 1)).alias("name"))


def flagged_counts(rows: DataFrame, flag: str = "T") -> DataFrame:
    """(genes, transcripts): distinct ones of rows (gene, transcript, flag) with that flag."""
    return rows.where(F.col("flag") == flag).agg(F.count_distinct("gene").alias("genes"), F.count_distinct("transcript").alias("transcripts"))


def spread_over_groups(members: DataFrame, group: str, part: str) -> DataFrame:
    """(group, members, parts, names): groups whose members are of several parts, those in order."""
    return members.groupBy(group).agg(F.count(F.lit(1)).alias("members"), F.count_distinct(part).alias("parts"), F.array_join(F.array_sort(F.collect_set(F.col(part).cast("string"))), "__").alias("names")).where("parts > 1")


def category_groups(rows: DataFrame) -> DataFrame:
    """(gene, transcripts, categories, names) of genes with two transcripts or more. rows: (gene, transcript, category)."""
    x = rows.groupBy("gene", "transcript").agg(F.max("category").alias("category"))
    return x.groupBy("gene").agg(F.count(F.lit(1)).alias("transcripts"), F.count_distinct("category").alias("categories"), F.array_join(F.array_sort(F.collect_set("category")), "__").alias("names")).where("transcripts > 1")


def entropy_bins(rows: DataFrame, width: float = 0.5) -> DataFrame:
    """(bin, rank, feature, expr, entropy): features by bins of entropy, the most expressed first in each. A bin's rank runs over expressions, in tasks by bin."""
    x = rows.withColumn("bin", F.floor(F.col("entropy") / width).cast("int"))
    return x.select("bin", F.row_number().over(Window.partitionBy("bin").orderBy(F.desc("expr"), "feature")).alias("rank"), "feature", "expr", "entropy")


def template_depth(pairs: DataFrame, least: int, most: int) -> DataFrame:
    """(scaffold, lend, rend) of what fragments cover from their start on by their template lengths; those out of bounds go."""
    ok = (F.col("tlen") > 0) & F.abs("tlen").between(least, most)
    return pairs.where(ok).select("scaffold", F.col("pos").alias("lend"), (F.col("pos") + F.col("tlen")).alias("rend"))


def welds(lines: DataFrame) -> DataFrame:
    """(a, b) in order, of log lines that tell of welding or of an accepted scaffold: 'Welding: >a;.. to >b;..'."""
    x = lines.where(F.col("value").rlike("^(Welding:|SCAFFOLD_ACCEPT:)"))
    names = F.array_sort(F.regexp_extract_all("value", F.lit(r">(\S+)"), 1))
    return x.select(F.get(names, F.lit(0)).alias("a"), F.get(names, F.lit(1)).alias("b")).where("b is not null")


def audit(rows: DataFrame) -> DataFrame:
    """One row of sums of rows (ok, recovered, reference, full_length)."""
    yes = F.sum(F.when(F.col("ok") == "YES", 1).otherwise(0))
    return rows.agg(yes.alias("yes"), F.sum(F.when(F.col("ok") == "NO", 1).otherwise(0)).alias("no"), *[F.sum(c).alias(c) for c in ("recovered", "reference", "full_length")], (F.sum("reference") - F.sum("full_length")).alias("missing"))


def by_component(rows: DataFrame, component: Column, name: str = "accession") -> DataFrame:
    """(component, n, members): rows' names by component, in order."""
    return rows.groupBy(component.alias("component")).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list(F.col(name).cast("string"))), ",").alias("members"))


def sharing_distribution(found: DataFrame) -> DataFrame:
    """(files, n): how many names are found in how many files."""
    return found.groupBy("name").agg(F.count_distinct("file").alias("files")).groupBy("files").agg(F.count(F.lit(1)).alias("n"))


def wigs_by_position(wigs: DataFrame, names: list[str]) -> DataFrame:
    """(pos, a column per name) from position 1 to the last, 0 where a track (name, pos, value) has nothing."""
    top = wigs.agg(F.max("pos").alias("m")).select(F.explode(F.sequence(F.lit(1).cast("long"), F.col("m").cast("long"))).alias("pos"))
    x = wigs.groupBy(F.col("pos").cast("long").alias("pos")).agg(*[F.sum(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])
    return top.join(x, "pos", "left").na.fill(0.0, names)


def clip_bed(clips: DataFrame) -> DataFrame:
    """BED lines of clip points (scaffold, pos), one base to either side."""
    return clips.select(F.concat_ws("\t", F.col("scaffold").cast("string"), (F.col("pos") - 1).cast("string"), (F.col("pos") + 1).cast("string")).alias("value"))
