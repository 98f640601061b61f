"""Expression matrices in long form: rows (feature, sample, value), one per cell.

Long form keeps every step a grouped aggregation or a join on a small table of samples or features; ``to_wide`` gives the
matrix that files have. A cell that has no row counts as 0 where an operator says so.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import stats
from ..workers import importable
from . import graphs

CELL = ("feature", "sample", "value")


# Shape -----------------------------------------------------------------------------------------------------------
def to_long(wide: DataFrame, id_col: str) -> DataFrame:
    samples = [c for c in wide.columns if c != id_col]
    return wide.unpivot([id_col], samples, "sample", "value").withColumnRenamed(id_col, "feature")


def to_wide(long: DataFrame, samples: Iterable[str] | None = None, fill: float | None = None) -> DataFrame:
    """One column per sample; samples named beforehand spare a pass over the data."""
    wide = long.groupBy("feature").pivot("sample", list(samples) if samples is not None else None).agg(F.first("value"))
    return wide if fill is None else wide.na.fill(fill)


def merged(matrices: Iterable[DataFrame]) -> DataFrame:
    """Union of long matrices; a sample that two of them have is an error found by ``duplicate_samples``."""
    out = None
    for m in matrices:
        out = m.select(*CELL) if out is None else out.unionByName(m.select(*CELL))
    if out is None:
        raise ValueError("no matrices")
    return out


def duplicate_samples(matrices: Iterable[DataFrame]) -> DataFrame:
    named = [m.select("sample", F.lit(i).alias("i")).distinct() for i, m in enumerate(matrices)]
    out = named[0]
    for n in named[1:]:
        out = out.union(n)
    return out.groupBy("sample").agg(F.count_distinct("i").alias("matrices")).where("matrices > 1")


def renamed(long: DataFrame, mapping: DataFrame, column: str = "feature", *, old: str = "old", new: str = "new", strip: str | None = r"\|.*") -> DataFrame:
    """Names replaced by a table of old and new ones; names without an entry stay."""
    key = F.regexp_replace(column, strip, "") if strip else F.col(column)
    keyed = long.withColumn("_key", key)
    return keyed.join(mapping.select(F.col(old).alias("_key"), F.col(new).alias("_new")), "_key", "left").withColumn(column, F.coalesce("_new", column)).select(*long.columns)


def gene_rollup(counts: DataFrame, tpm: DataFrame, genes: DataFrame) -> DataFrame:
    """Gene TPM is the sum over transcripts; gene counts are gene TPM x the sample's counts / 10^6, to 2 decimals. genes: (feature, gene)."""
    per_gene = tpm.join(genes, "feature").groupBy("gene", "sample").agg(F.sum("value").alias("tpm"))
    totals = counts.groupBy("sample").agg(F.sum("value").alias("total"))
    return per_gene.join(F.broadcast(totals), "sample").select("gene", "sample", "tpm", F.round(F.col("tpm") / 1e6 * F.col("total"), 2).alias("count"))


def tpm(counts: DataFrame, lengths: DataFrame) -> DataFrame:
    """Transcripts per million from counts and effective lengths (feature, length)."""
    rate = counts.join(lengths, "feature").select("feature", "sample", (F.col("value") / F.col("length")).alias("rate"))
    total = rate.groupBy("sample").agg(F.sum("rate").alias("total"))
    return rate.join(F.broadcast(total), "sample").select("feature", "sample", F.try_divide(F.col("rate") * 1e6, F.col("total")).alias("value"))


def gene_effective_length(counts: DataFrame, lengths: DataFrame, genes: DataFrame) -> DataFrame:
    """sum(count) / sum(count / length) per gene and sample; the mean length where the counts are 0. Lengths under 1 count as 1."""
    length = F.greatest(F.col("length").cast("double"), F.lit(1.0))
    joined = counts.join(lengths, "feature").join(genes, "feature")
    return joined.groupBy("gene", "sample").agg(F.coalesce(F.try_divide(F.sum("value"), F.sum(F.col("value") / length)), F.avg(length)).alias("eff_length"))


def weighted_gene_length(totals: DataFrame, lengths: DataFrame, genes: DataFrame) -> DataFrame:
    """Mean length of a gene's transcripts weighted by expression + 1, to a whole number. totals: (feature, value)."""
    w = F.col("value") + 1
    joined = lengths.join(genes, "feature").join(totals, "feature", "left").na.fill(0.0, ["value"])
    return joined.groupBy("gene").agg(F.floor(F.sum(F.col("length") * w) / F.sum(w) + 0.5).cast("long").alias("length"))


# Columns ---------------------------------------------------------------------------------------------------------
def per_sample_share(long: DataFrame, scale: float = 1e6) -> DataFrame:
    """Each cell as a share of its sample's total: CPM by 10^6, CPK by 10^3. The totals are a small table, not a window over a sample."""
    total = long.groupBy("sample").agg(F.sum("value").alias("_total"))
    return long.join(F.broadcast(total), "sample").select("feature", "sample", F.try_divide(F.col("value") * scale, F.col("_total")).alias("value"))


def log2_plus_one(long: DataFrame) -> DataFrame:
    return long.withColumn("value", F.log2(F.col("value") + 1))


def binary(long: DataFrame) -> DataFrame:
    return long.withColumn("value", F.when(F.col("value") > 0, 1.0).otherwise(0.0))


def below_as_null(long: DataFrame, least: float) -> DataFrame:
    return long.withColumn("value", F.when(F.col("value") >= least, F.col("value")))


def upper_quartile(long: DataFrame, least: float = 0.0) -> DataFrame:
    """Values over the sample's 75th percentile of values above least, times the mean of those percentiles."""
    q = long.where(F.col("value") > least).groupBy("sample").agg(F.percentile("value", 0.75).alias("_q"))
    mean = q.agg(F.avg("_q").alias("_mean"))
    return long.join(F.broadcast(q.crossJoin(mean)), "sample").select("feature", "sample", F.try_divide(F.col("value") * F.col("_mean"), F.col("_q")).alias("value"))


def tmm_factors(counts: DataFrame, *, logratio_trim: float = 0.3, sum_trim: float = 0.05, a_cutoff: float = -1e10) -> DataFrame:
    """(sample, lib_size, norm_factor): trimmed means of M values against the sample whose scaled upper quartile is nearest the mean.

    The samples' statistics are a small table; the rows are joined to the reference's column and ranked with average ties
    per sample.
    """
    lib = counts.groupBy("sample").agg(F.sum("value").alias("lib"), F.percentile("value", 0.75).alias("q"))
    scaled = lib.withColumn("f", F.col("q") / F.col("lib"))
    nearest = scaled.crossJoin(F.broadcast(scaled.agg(F.avg("f").alias("mean")))).agg(F.min_by(F.struct("sample", "lib"), F.struct(F.abs(F.col("f") - F.col("mean")), "sample")).alias("r")).select(F.col("r.sample").alias("ref"), F.col("r.lib").alias("ref_lib"))
    ref = counts.join(F.broadcast(nearest), F.col("sample") == F.col("ref")).select("feature", F.col("value").alias("r"), "ref_lib")
    y, n, r, m = (F.col(c).cast("double") for c in ("value", "lib", "r", "ref_lib"))
    both = counts.join(F.broadcast(lib.select("sample", "lib")), "sample").join(ref, "feature").where("value > 0 and r > 0")
    both = both.select("sample", F.log2((y / n) / (r / m)).alias("lr"), ((F.log2(y / n) + F.log2(r / m)) / 2).alias("ab"), ((n - y) / n / y + (m - r) / m / r).alias("v")).where(F.col("ab") > a_cutoff)
    both = graphs.cut_lineage(both)
    sizes = both.groupBy("sample").agg(F.count(F.lit(1)).alias("n"))  # one row a sample
    ranked = graphs.average_ranks(graphs.average_ranks(both, "sample", "lr", "rl"), "sample", "ab", "rs").join(F.broadcast(sizes), "sample")
    lo_l, lo_s = F.floor(F.col("n") * logratio_trim) + 1, F.floor(F.col("n") * sum_trim) + 1
    kept = ranked.where((F.col("rl") >= lo_l) & (F.col("rl") <= F.col("n") + 1 - lo_l) & (F.col("rs") >= lo_s) & (F.col("rs") <= F.col("n") + 1 - lo_s))
    mean = kept.groupBy("sample").agg((F.sum(F.col("lr") / F.col("v")) / F.sum(1 / F.col("v"))).alias("t"))
    # A sample like the reference has factor 1; factors are scaled to a geometric mean of 1.
    raw = lib.join(mean, "sample", "left").withColumn("t", F.coalesce(F.when(~F.isnan("t"), F.col("t")), F.lit(0.0)))
    centre = raw.agg(F.avg("t").alias("c"))
    return raw.crossJoin(F.broadcast(centre)).select("sample", F.col("lib").alias("lib_size"), F.pow(F.lit(2.0), F.col("t") - F.col("c")).alias("norm_factor"))


def tmm_scaled(long: DataFrame, factors: DataFrame, decimals: int = 3) -> DataFrame:
    return long.join(F.broadcast(factors), "sample").select("feature", "sample", F.round(F.col("value") / F.col("norm_factor"), decimals).alias("value"))


def tmm_fpkm(counts: DataFrame, lengths: DataFrame, factors: DataFrame) -> DataFrame:
    """count x 10^9 / (length x effective library size)."""
    joined = counts.join(F.broadcast(factors), "sample").join(lengths, "feature")
    return joined.select("feature", "sample", F.try_divide(F.col("value") * 1e9, F.col("length") * F.col("lib_size") * F.col("norm_factor")).alias("value"))


# Rows ------------------------------------------------------------------------------------------------------------
def row_stats(long: DataFrame) -> DataFrame:
    v = F.col("value")
    return long.groupBy("feature").agg(F.count(v).alias("n"), F.sum(v).alias("sum"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"), F.median(v).alias("median"))


def rows_where(long: DataFrame, condition: str) -> DataFrame:
    """Rows whose statistics (n, sum, min, max, mean, sd, median) meet the condition."""
    return long.join(row_stats(long).where(condition).select("feature"), "feature", "left_semi")


def prevalent_rows(long: DataFrame, least: float, samples: int) -> DataFrame:
    """Rows with a value of least or more in so many samples."""
    return long.join(long.where(F.col("value") >= least).groupBy("feature").count().where(F.col("count") >= samples), "feature", "left_semi")


def samples_where(long: DataFrame, *, min_sum: float | None = None, min_any: float | None = None, min_expressed: int | None = None, expressed_at: float = 0.0) -> DataFrame:
    v = F.col("value")
    s = long.groupBy("sample").agg(F.sum(v).alias("s"), F.max(v).alias("m"), F.count_if(v > expressed_at).alias("e"))
    for column, least in (("s", min_sum), ("m", min_any), ("e", min_expressed)):
        if least is not None:
            s = s.where(F.col(column) >= least)
    return long.join(F.broadcast(s.select("sample")), "sample", "left_semi")


def centred_rows(long: DataFrame, scale: bool = False, median: bool = False) -> DataFrame:
    """Values less their row's mean (or median), over its standard deviation if scaled; rows without spread drop out then."""
    s = long.groupBy("feature").agg((F.median("value") if median else F.avg("value")).alias("_c"), F.stddev_samp("value").alias("_sd"))
    if scale:
        s = s.where("_sd > 0")
    x = F.col("value") - F.col("_c")
    return long.join(s, "feature").select("feature", "sample", (x / F.col("_sd") if scale else x).alias("value"))


def combined_replicates(long: DataFrame, samples: DataFrame, how: str = "sum") -> DataFrame:
    """Replicates of a sample as one column: sum, avg, or avg_log for exp(mean(log(x + 1))) - 1. samples: (replicate, sample)."""
    agg = {"sum": F.sum("value"), "avg": F.avg("value"), "avg_log": F.exp(F.avg(F.log1p("value"))) - 1}[how]
    return long.withColumnRenamed("sample", "replicate").join(F.broadcast(samples), "replicate").groupBy("feature", "sample").agg(agg.alias("value"))


def mean_variance(long: DataFrame) -> DataFrame:
    """(feature, mean, sd, cv, fano, var): var is the square root of sd, as the column of that name always was."""
    s = row_stats(long)
    return s.select("feature", "mean", "sd", F.try_divide("sd", "mean").alias("cv"), F.try_divide(F.col("sd") * F.col("sd"), F.col("mean")).alias("fano"), F.sqrt("sd").alias("var"))


def variation_of_medians(long: DataFrame, samples: DataFrame, top: int | None = None, pseudocount: float = 0.1) -> DataFrame:
    """Coefficient of variation of the samples' medians."""
    m = long.withColumnRenamed("sample", "replicate").join(F.broadcast(samples), "replicate").groupBy("feature", "sample").agg((F.median("value") + pseudocount).alias("m"))
    cv = m.groupBy("feature").agg((F.stddev_samp("m") / F.avg("m")).alias("cv"))
    return cv if top is None else cv.orderBy(F.desc_nulls_last("cv"), "feature").limit(top)


def top_rows(long: DataFrame, n: int) -> DataFrame:
    """The cells of the n rows of greatest maximum."""
    best = long.groupBy("feature").agg(F.max("value").alias("_m")).orderBy(F.desc("_m"), "feature").limit(n)
    return long.join(F.broadcast(best.select("feature")), "feature", "left_semi")


def tissue_specific(long: DataFrame, within: float = 0.9) -> DataFrame:
    """Samples whose value reaches that share of the row's maximum, joined by a bar."""
    top = long.groupBy("feature").agg(F.max("value").alias("_m")).where("_m > 0")
    near = long.join(top, "feature").where(F.col("value") >= F.col("_m") * within)
    return near.groupBy("feature").agg(F.array_join(F.array_sort(F.collect_list("sample")), "|").alias("samples"))


def row_entropy(long: DataFrame, pseudocount: float = 0.1) -> DataFrame:
    """Entropy in bits of each row around its Tukey biweight; the pseudocount is in the sum twice, as it always was."""
    centre = stats.tukey_biweight(long, "feature", "value")
    x = long.join(centre, "feature").select("feature", (F.abs(F.col("value") - F.col("biweight")) + pseudocount).alias("x"))
    total = x.groupBy("feature").agg(F.sum(F.col("x") + pseudocount).alias("t"))
    p = F.col("x") / F.col("t")
    return x.join(total, "feature").groupBy("feature").agg((-F.sum(p * F.log2(p))).alias("entropy"))


# Pairs of samples or features ------------------------------------------------------------------------------------
def _paired(long: DataFrame, by: str, over: str) -> DataFrame:
    a, b = (long.select(F.col(over).alias("_k"), F.col(by).alias(x), F.col("value").alias(f"v{x}")) for x in ("a", "b"))
    return a.join(b, "_k").where("a < b")


def sample_correlation(long: DataFrame, method: str = "pearson") -> DataFrame:
    """(a, b, cor, n) of each pair of samples over the features both have. The self-join is on the feature; its size is cells x samples."""
    if method == "spearman":
        long = graphs.average_ranks(long, "sample", "value", "_rank").select("feature", "sample", F.col("_rank").alias("value"))
    return _paired(long, "sample", "feature").groupBy("a", "b").agg(F.corr("va", "vb").alias("cor"), F.count(F.lit(1)).alias("n"))


def sample_distance(long: DataFrame, kind: str = "euclidean") -> DataFrame:
    d = F.abs(F.col("va") - F.col("vb"))
    agg = {"euclidean": F.sqrt(F.sum(d * d)), "manhattan": F.sum(d), "maximum": F.max(d), "jaccard": 1 - F.count_if((F.col("va") > 0) & (F.col("vb") > 0)) / F.greatest(F.count_if((F.col("va") > 0) | (F.col("vb") > 0)), F.lit(1))}[kind]
    return _paired(long, "sample", "feature").groupBy("a", "b").agg(agg.alias("distance"))


#: Bytes of targets' blocks up to which they are broadcast, of an Arrow batch of blocks, and pairs of features that are looked at together.
TARGET_BYTES, BATCH_BYTES, PAIRS = 64 << 20, 16 << 20, 1 << 16


def _row_blocks(long: DataFrame, block: int) -> DataFrame:
    """(features, samples, cells): some features' values as a dense matrix of doubles, NaN where there is none; about ``block`` cells in each."""
    import pyarrow as pa

    kinds = [to_arrow_type(long.schema[c].dataType) for c in CELL[:2]]
    schema = pa.schema([("features", pa.list_(kinds[0])), ("samples", pa.list_(kinds[1])), ("cells", pa.binary())])

    def run(batches):
        for batch in batches:
            names = batch.column(1).flatten().dictionary_encode()
            col, values, ends = names.indices.to_numpy(), batch.column(2).flatten().to_numpy(), np.diff(batch.column(1).offsets.to_numpy()).cumsum()
            for some in np.array_split(np.arange(batch.num_rows), -(-batch.num_rows // max(1, block // max(1, len(names.dictionary))))):
                if not len(some):
                    continue
                lo, hi = ends[some[0] - 1] if some[0] else 0, ends[some[-1]]
                cells = np.full((len(some), len(names.dictionary)), np.nan)
                cells[np.repeat(np.arange(len(some)), np.diff([lo, *ends[some]])), col[lo:hi]] = values[lo:hi]
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((batch.column(0).slice(some[0], len(some)).to_pylist(), names.dictionary.to_pylist(), cells.tobytes()), schema, strict=True)], schema=schema)

    value = F.col("value").cast("double")
    rows = long.where(F.col("feature").isNotNull() & F.col("sample").isNotNull() & value.isNotNull() & ~F.isnan(value)).groupBy("feature").agg(F.collect_list(F.struct("sample", value.alias("value"))).alias("c"))
    feature, sample = (long.schema[c].dataType.simpleString() for c in CELL[:2])
    return rows.select("feature", "c.sample", "c.value").mapInArrow(run, f"features array<{feature}>, samples array<{sample}>, cells binary")


def _sums(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Which cells are there, their values and squares, shifted for precision; whether sums of products of theirs are exact."""
    there = ~np.isnan(cells)
    x = np.where(there, cells, 0.0)
    mean = x.sum(1) / np.maximum(1, there.sum(1))
    x = np.where(there, x - np.where((x == np.rint(x)).all(1), np.rint(mean), mean)[:, None], 0.0)
    return there.astype(float), x, x * x, bool((x == np.rint(x)).all() and np.abs(x).max(initial=0) * max(1, x.shape[1]) < 2.0**26)


def _pearson(t: tuple, f: tuple) -> np.ndarray:
    """Correlations of t's rows with f's over the samples that both have; NaN for pairs without variance."""
    (mt, xt, qt, even_t), (mf, xf, qf, even_f) = t, f
    n, sx, sy, sxx, syy = mt @ mf.T, xt @ mf.T, mt @ xf.T, qt @ mf.T, mt @ qf.T
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    with np.errstate(divide="ignore", invalid="ignore"):
        cor = (n * (xt @ xf.T) - sx * sy) / np.sqrt(vx * vy)
    cor[~((vx > 0) & (vy > 0))] = np.nan
    if not (even_t and even_f):  # what cancels is done again about the pair's own means
        i, j = np.nonzero((n > 1) & ((vx < 1e-6 * n * sxx) | (vy < 1e-6 * n * syy)))
        for k in range(0, len(i), 4096):
            a, b = i[k : k + 4096], j[k : k + 4096]
            both = (mt[a] * mf[b]).astype(bool)
            x, y = (np.where(both, v - np.where(both, v, 0).sum(1, keepdims=True) / both.sum(1, keepdims=True), 0) for v in (xt[a], xf[b]))
            varies = [np.where(both, v, -np.inf).max(1) > np.where(both, v, np.inf).min(1) for v in (xt[a], xf[b])]
            with np.errstate(divide="ignore", invalid="ignore"):
                cor[a, b] = np.where(varies[0] & varies[1], (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1)), np.nan)
    return cor


def correlated_features(long: DataFrame, targets: DataFrame, n: int = 10, least: float = -1.0, block: int = 100_000) -> DataFrame:
    """For each target feature the n features whose values over the samples go with its own best; equal correlations (to 12 decimals) by feature.

    Blocks of about ``block`` cells meet as matrices: a task multiplies its features' blocks with all the targets' and hands on each target's n best, so no
    pair of features is ever a row. Targets' blocks are broadcast up to a size. Cells that are null or NaN are missing; pairs without variance have no row.
    """
    import pyarrow as pa

    spark, kind = long.sparkSession, long.schema["feature"].dataType
    importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    own = graphs.cut_lineage(_row_blocks(long.join(targets.select("feature").distinct(), "feature", "left_semi"), block))
    size = own.agg(F.sum(F.length("cells"))).first()[0] or 0
    own = own.select(*[F.col(c).alias(f"own_{c}") for c in own.columns])
    schema = pa.schema([("target", to_arrow_type(kind)), ("feature", to_arrow_type(kind)), ("cor", pa.float64())])

    def ids(column) -> np.ndarray:
        if pa.types.is_integer(column.type):
            return column.to_numpy()
        out = np.empty(len(column), object)
        out[:] = column.to_pylist()
        return out

    def best(t: np.ndarray, cor: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((np.unique(names, return_inverse=True)[1], -cor, t))
        t, cor, names = t[order], cor[order], names[order]
        keep = np.arange(len(t)) - np.searchsorted(t, t) < n
        return t[keep], cor[keep], names[keep]

    def run(batches):
        found: dict = {}
        for batch in batches:
            for row in range(batch.num_rows):
                names, own_names = (ids(batch.column(c)[row].values) for c in (0, 3))
                samples, own_samples = (batch.column(c)[row].as_py() for c in (1, 4))
                cells, own_cells = (np.frombuffer(batch.column(c)[row].as_buffer()).reshape(-1, len(s)) for c, s in ((2, samples), (5, own_samples)))
                at = {s: i for i, s in enumerate(samples)}
                shared = [(i, at[s]) for i, s in enumerate(own_samples) if s in at]
                if not shared:
                    continue
                t, f = (_sums(x[:, list(c)]) for x, c in zip((own_cells, cells), zip(*shared, strict=True), strict=True))
                _, enough, held = found.setdefault(own_names[0], (own_names, np.full(len(own_names), least), [(np.empty(0, int), np.empty(0), names[:0])]))
                step, more = max(1, PAIRS // len(own_names)), 0
                for lo in range(0, len(names), step):
                    cor = _pearson(t, (*(x[lo : lo + step] for x in f[:3]), f[3]))
                    i, j = np.nonzero(cor >= enough[:, None] - 1e-12)
                    c, who = np.clip(cor[i, j], -1, 1).round(12), names[lo + j]
                    new = (c >= enough[i]) & (who != own_names[i])
                    held.append((i[new], c[new], who[new]))
                    more += int(new.sum())
                    if more > n * len(own_names) or lo + step >= len(names):
                        held[:], more = [best(*(np.concatenate(x) for x in zip(*held, strict=True)))], 0
                        last = held[0][0][n - 1 :] == held[0][0][: len(held[0][0]) - n + 1]  # each target's n-th
                        enough[held[0][0][n - 1 :][last]] = held[0][1][n - 1 :][last]
        for own_names, _, ((t, cor, names),) in found.values():
            for lo in range(0, len(t), 10_000):
                some = slice(lo, lo + 10_000)
                yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), f.type) for x, f in zip((own_names[t[some]], names[some], cor[some]), schema, strict=True)], schema=schema)

    pairs = _row_blocks(long, block).crossJoin(F.broadcast(own) if size <= TARGET_BYTES else own)
    name = kind.simpleString()
    w = Window.partitionBy("target").orderBy(F.desc("cor"), "feature")
    return pairs.mapInArrow(run, f"target {name}, feature {name}, cor double").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def replicate_pairs(long: DataFrame, samples: DataFrame) -> DataFrame:
    """(sample, a, b, cor, mean_m): agreement of each sample's replicates; M is the log2 ratio of values + 1."""
    r = long.withColumnRenamed("sample", "replicate").join(F.broadcast(samples), "replicate")
    a, b = (r.select("feature", "sample", F.col("replicate").alias(x), F.log2(F.col("value") + 1).alias(f"v{x}")) for x in ("a", "b"))
    return a.join(b, ["feature", "sample"]).where("a < b").groupBy("sample", "a", "b").agg(F.corr("va", "vb").alias("cor"), F.avg(F.col("va") - F.col("vb")).alias("mean_m"))


# Models ----------------------------------------------------------------------------------------------------------
def anova(long: DataFrame, samples: DataFrame, method: str = "holm") -> DataFrame:
    """(feature, f, p, adjusted) of a one-way analysis of variance over the samples' replicates. Sums of squares are grouped sums; only their ratio goes through Python."""
    importable(long.sparkSession)
    r = long.withColumnRenamed("sample", "replicate").join(F.broadcast(samples), "replicate")
    g = r.groupBy("feature", "sample").agg(F.count("value").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v"))
    s = g.groupBy("feature").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("gm"), F.sum(F.col("n") * F.col("v")).alias("within"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("sq"))
    between = F.col("sq") - F.col("n") * F.col("gm") * F.col("gm")
    s = s.where("k > 1 and n > k").withColumn("f", F.try_divide(between / (F.col("k") - 1), F.col("within") / (F.col("n") - F.col("k"))))

    @F.pandas_udf("double")
    def p_value(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(x) else stats.f_test_p(x, a, b) for x, a, b in zip(f, df1, df2, strict=True)], dtype=float)

    tested = s.select("feature", "f", p_value("f", F.col("k") - 1, F.col("n") - F.col("k")).alias("p"))
    return stats.adjusted_column(tested, "p", "adjusted", method)


def negative_binomial_test(counts: DataFrame, groups: DataFrame, a: str, b: str, dispersion: float = 0.1, factors: DataFrame | None = None, method: str = "bh") -> DataFrame:
    """(feature, log_fc, log_cpm, p, fdr) of samples of group b against a, by an exact test with one dispersion on scaled sums. groups: (sample, grp)."""
    importable(counts.sparkSession)
    factors = tmm_factors(counts) if factors is None else factors
    sizes = factors.join(groups, "sample").where(F.col("grp").isin(a, b)).select("sample", "grp", (F.col("lib_size") * F.col("norm_factor")).alias("eff"))
    common = sizes.agg(F.exp(F.avg(F.ln("eff"))).alias("common"))
    n = {r.grp: r.n for r in sizes.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    scaled = counts.join(F.broadcast(sizes.crossJoin(common)), "sample").select("feature", "grp", "common", (F.col("value") * F.col("common") / F.col("eff")).alias("y"))
    both = scaled.groupBy("feature").agg(F.sum(F.when(F.col("grp") == a, F.col("y")).otherwise(0)).alias("sa"), F.sum(F.when(F.col("grp") == b, F.col("y")).otherwise(0)).alias("sb"), F.first("common").alias("common"))
    na, nb = n.get(a, 0), n.get(b, 0)
    if not na or not nb:
        raise ValueError(f"no samples of {a} or {b}")

    @F.pandas_udf("double")
    def exact(sa: pd.Series, sb: pd.Series) -> pd.Series:
        return pd.Series([_nb_exact(round(x), round(y), na, nb, dispersion) for x, y in zip(sa, sb, strict=True)])

    prior = 0.125
    fc = F.log2((F.col("sb") / nb + prior) / (F.col("sa") / na + prior))
    cpm = F.log2(((F.col("sa") + F.col("sb")) / (na + nb) + prior) / F.col("common") * 1e6)
    return stats.adjusted_column(both.select("feature", fc.alias("log_fc"), cpm.alias("log_cpm"), exact("sa", "sb").alias("p")), "p", "fdr", method)


def _nb_exact(sa: int, sb: int, na: int, nb: int, dispersion: float) -> float:
    """Two-sided chance, given the total, of a split as unlikely as this. Sums of n counts are negative binomial of size n / dispersion."""
    total = sa + sb
    if total == 0:
        return 1.0
    ra, rb = na / dispersion, nb / dispersion
    if total > 4000:  # a beta limit of the split's share
        mid = (sa + 0.5) / (total + 1)
        low = stats.incomplete_beta(ra, rb, mid)
        return min(1.0, 2 * min(low, 1 - low))
    from math import lgamma

    i = np.arange(total + 1)
    lg = np.vectorize(lgamma)
    logs = lg(i + ra) - lg(i + 1.0) + lg(total - i + rb) - lg(total - i + 1.0)
    w = np.exp(logs - logs.max())
    return float(min(1.0, w[logs <= logs[sa] + 1e-9].sum() / w.sum()))


def voom_test(counts: DataFrame, groups: DataFrame, a: str, b: str, method: str = "bh", factors: DataFrame | None = None) -> DataFrame:
    """(feature, log_fc, p, adjusted): log counts per million compared by a t test whose variances are moderated towards their mean over the features."""
    importable(counts.sparkSession)
    factors = tmm_factors(counts) if factors is None else factors
    lib = factors.select("sample", (F.col("lib_size") * F.col("norm_factor")).alias("lib"))
    y = F.log2((F.col("value") + 0.5) / (F.col("lib") + 1) * 1e6)
    x = counts.join(F.broadcast(lib), "sample").join(F.broadcast(groups.where(F.col("grp").isin(a, b))), "sample").select("feature", "grp", y.alias("y"))
    g = x.groupBy("feature").agg(*[f(F.when(F.col("grp") == v, F.col("y"))).alias(f"{n}{k}") for k, v in (("a", a), ("b", b)) for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))])
    df = F.col("na") + F.col("nb") - 2
    g = g.where((F.col("na") > 0) & (F.col("nb") > 0) & (df > 0)).withColumn("s2", (F.coalesce("va", F.lit(0.0)) * (F.col("na") - 1) + F.coalesce("vb", F.lit(0.0)) * (F.col("nb") - 1)) / df)
    prior = g.agg(F.avg("s2").alias("s0"))
    d0 = 4.0
    g = g.crossJoin(F.broadcast(prior)).withColumn("post", (d0 * F.col("s0") + df * F.col("s2")) / (d0 + df))
    t = F.try_divide(F.col("mb") - F.col("ma"), F.sqrt(F.col("post") * (1 / F.col("na") + 1 / F.col("nb"))))

    @F.pandas_udf("double")
    def p_value(t: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(v) else stats.t_test_p(v, d) for v, d in zip(t, df, strict=True)], dtype=float)

    return stats.adjusted_column(g.select("feature", (F.col("mb") - F.col("ma")).alias("log_fc"), p_value(t, (df + d0).cast("double")).alias("p")), "p", "adjusted", method)


def without_batch_effects(long: DataFrame, batches: DataFrame, groups: DataFrame) -> DataFrame:
    """Log2 counts per million less their batch's effect (by least squares beside the groups' means), back as counts. batches: (sample, batch)."""
    importable(long.sparkSession)
    lib = long.groupBy("sample").agg(F.sum("value").alias("lib"))
    design = [(r.sample, r.batch, r.grp) for r in batches.join(groups, "sample").orderBy("sample").collect()]  # one row per sample
    names = [d[0] for d in design]
    bs, gs = sorted({d[1] for d in design}), sorted({d[2] for d in design})
    x = np.array([[float(d[2] == g) for g in gs] + [float(d[1] == b) - float(d[1] == bs[-1]) for b in bs[:-1]] for d in design])
    effect = x[:, len(gs) :] @ np.linalg.pinv(x)[len(gs) :]
    rows = long.join(F.broadcast(lib), "sample").select("feature", F.struct("sample", F.log2((F.col("value") + 0.5) / (F.col("lib") + 1) * 1e6).alias("y"), "lib").alias("c")).groupBy("feature").agg(F.collect_list("c").alias("cells"))

    @F.pandas_udf("array<struct<sample:string,value:double>>")
    def fitted(cells: pd.Series) -> pd.Series:
        out = []
        for row in cells:
            at = {c["sample"]: c for c in row}
            y = np.array([at[n]["y"] if n in at else 0.0 for n in names])
            z = y - effect @ y
            out.append([{"sample": n, "value": float(max(0.0, 2 ** z[i] * (at[n]["lib"] + 1) / 1e6 - 0.5))} for i, n in enumerate(names) if n in at])
        return pd.Series(out)

    return rows.select("feature", F.explode(fitted("cells")).alias("c")).select("feature", "c.sample", "c.value")


def principal_components(long: DataFrame, k: int = 3) -> DataFrame:
    """(component, sample, loading, variance_share), without centring: eigenvectors of the samples' cross products.

    The products are a grouped sum of samples x samples cells; only that small table reaches the driver.
    """
    a, b = (long.select("feature", F.col("sample").alias(x), F.col("value").alias(f"v{x}")) for x in ("a", "b"))
    products = a.join(b, "feature").groupBy("a", "b").agg(F.sum(F.col("va") * F.col("vb")).alias("p")).collect()
    names = sorted({r.a for r in products})
    at = {n: i for i, n in enumerate(names)}
    m = np.zeros((len(names), len(names)))
    for r in products:
        m[at[r.a], at[r.b]] = r.p
    values, vectors = np.linalg.eigh(m)
    order = np.argsort(values)[::-1][:k]
    share = np.maximum(values, 0) / max(np.maximum(values, 0).sum(), 1e-300)
    rows = []
    for c, i in enumerate(order, 1):
        v = vectors[:, i] * (1 if vectors[np.abs(vectors[:, i]).argmax(), i] > 0 else -1)
        rows += [(c, n, float(v[at[n]]), float(share[i])) for n in names]
    return long.sparkSession.createDataFrame(rows, "component int, sample string, loading double, variance_share double")


def component_scores(long: DataFrame, components: DataFrame) -> DataFrame:
    """(feature, component, score)."""
    return long.join(F.broadcast(components.select("component", "sample", "loading")), "sample").groupBy("feature", "component").agg(F.sum(F.col("value") * F.col("loading")).alias("score"))


def extreme_scores(scores: DataFrame, n: int) -> DataFrame:
    """The n features of highest and of lowest score of each component."""
    up, down = (F.row_number().over(Window.partitionBy("component").orderBy(o, "feature")) for o in (F.desc("score"), F.asc("score")))
    return scores.withColumn("top", up).withColumn("bottom", down).where((F.col("top") <= n) | (F.col("bottom") <= n))


def hierarchy(distances: DataFrame, method: str = "complete") -> list[tuple[int, int, float, int]]:
    """Agglomerative clustering of a small table of distances (a, b, distance): merges (i, j, height, size), items first by name.

    For samples, or for features already filtered to a bounded number; the table is collected.
    """
    rows = distances.collect()
    names = sorted({r.a for r in rows} | {r.b for r in rows})
    at, n = {x: i for i, x in enumerate(names)}, len(names)
    d = np.full((2 * n, 2 * n), np.inf)
    for r in rows:
        d[at[r.a], at[r.b]] = d[at[r.b], at[r.a]] = r.distance
    live, size, out = list(range(n)), dict.fromkeys(range(n), 1), []
    for new in range(n, 2 * n - 1):
        i, j = min(((x, y) for k, x in enumerate(live) for y in live[k + 1 :]), key=lambda p: (d[p], p))
        out.append((i, j, float(d[i, j]), size[i] + size[j]))
        live = [x for x in live if x not in (i, j)]
        for x in live:
            d[new, x] = d[x, new] = {"complete": max(d[i, x], d[j, x]), "single": min(d[i, x], d[j, x]), "average": (size[i] * d[i, x] + size[j] * d[j, x]) / (size[i] + size[j])}[method]
        size[new] = size[i] + size[j]
        live.append(new)
    return out


def cut_tree(merges: list[tuple[int, int, float, int]], k: int | None = None, height_share: float | None = None) -> list[int]:
    """Cluster number of each item, for k clusters or cutting at a share of the greatest height."""
    n = len(merges) + 1
    steps = n - k if k else sum(m[2] <= (height_share or 0) * merges[-1][2] for m in merges) if merges else 0
    parent = list(range(n + len(merges)))
    for new, (i, j, _, _) in enumerate(merges[:steps], n):
        parent[i] = parent[j] = new

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    numbers: dict[int, int] = {}
    return [numbers.setdefault(root(x), len(numbers) + 1) for x in range(n)]


def newick(merges: list[tuple[int, int, float, int]], names: list[str]) -> str:
    text = dict(enumerate(names))
    height = dict.fromkeys(range(len(names)), 0.0)
    for new, (i, j, h, _) in enumerate(merges, len(names)):
        text[new] = f"({text[i]}:{h - height[i]:g},{text[j]}:{h - height[j]:g})"
        height[new] = h
    return text[len(names) + len(merges) - 1] + ";"


def kmeans(long: DataFrame, k: int, samples: list[str], seed: int = 12345) -> DataFrame:
    """(feature, cluster) by k-means over the samples' values; missing cells are 0."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    wide = to_wide(long, samples, 0.0)
    vectors = VectorAssembler(inputCols=samples, outputCol="_v").transform(wide)
    return KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(vectors).transform(vectors).select("feature", "cluster")


def enrichment(members: DataFrame, chosen: DataFrame, method: str = "bh") -> DataFrame:
    """(term, n_chosen, n_term, over_p, over_fdr): terms that chosen features have more often than chance. members: (feature, term)."""
    importable(members.sparkSession)
    total = members.select("feature").distinct().count()
    inside = members.join(chosen.select("feature").distinct(), "feature", "left_semi")
    drawn = inside.select("feature").distinct().count()
    by = members.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    hit = inside.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_chosen"))

    @F.pandas_udf("double")
    def tail(k: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([stats.hypergeometric_tail(int(x), drawn, int(y), total) for x, y in zip(k, m, strict=True)])

    return stats.adjusted_column(by.join(hit, "term", "left").na.fill(0, ["n_chosen"]).select("term", "n_chosen", "n_term", tail("n_chosen", "n_term").alias("over_p")), "over_p", "over_fdr", method)


#: Ranges of hashes up to a depth, and by how many standard deviations more reads than the depth the first look takes.
RANGES, SPARE = 64, 8.0


def downsampled(long: DataFrame, depth: int, seed: int = 0) -> DataFrame:
    """Each sample's counts thinned to exactly depth reads without replacement; smaller samples drop out.

    Reads are numbered within their sample and the depth smallest keyed hashes win, compared without sign. Hashes are uniform, so the winners are
    looked for below the hash that somewhat more than depth reads are expected to stay under: those reads alone are written, counted in ranges
    of hashes and ranked within them. A sample that has fewer there gets the rest from all its other reads.
    """
    n, d = F.col("value").cast("long"), max(1, depth)
    big = long.groupBy("sample").agg(F.sum(n).alias("_t")).where(F.col("_t") >= depth)
    last = max(1, round(RANGES * (1 + SPARE * (d**-0.5 + 8 / d))))

    def reads(samples: DataFrame) -> DataFrame:
        x = long.join(F.broadcast(samples), "sample").where(n > 0).select("feature", *samples.columns, F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("i"))
        x = x.withColumn("h", F.xxhash64("feature", "sample", "i", F.lit(seed)))
        return x.withColumn("b", F.least(F.floor(F.shiftrightunsigned("h", 11) / F.lit(2.0**53) * (F.col("_t") * RANGES / d)), F.lit(last)))

    low = graphs.cut_lineage(reads(big).where(F.col("b") < last).select("feature", "sample", "i", "h", "b"))
    upto = F.sum("n").over(Window.partitionBy("sample").orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
    before = low.groupBy("sample", "b").agg(F.count(F.lit(1)).alias("n")).withColumn("before", upto - F.col("n")).where(F.col("before") < depth)
    cuts = before.groupBy("sample").agg(F.max("b").alias("cut"), F.max("before").alias("before"))
    by_hash = [F.col("h") < 0, "h", "feature", "i"]
    r = F.row_number().over(Window.partitionBy("sample", "b").orderBy(*by_hash))
    ranked = low.join(F.broadcast(cuts), "sample").where("b <= cut").withColumn("r", r)
    kept = ranked.where((F.col("b") < F.col("cut")) | (F.col("r") + F.col("before") <= depth)).select("feature", "sample")
    found = low.groupBy("sample").agg(F.count(F.lit(1)).alias("found"))
    short = graphs.cut_lineage(big.join(F.broadcast(found), "sample", "left").na.fill(0, ["found"]).where(F.col("found") < depth))
    if not short.isEmpty():
        r = F.row_number().over(Window.partitionBy("sample").orderBy(*by_hash))
        kept = kept.union(reads(short).where(F.col("b") == last).withColumn("r", r).where(F.col("r") + F.col("found") <= depth).select("feature", "sample"))
    return kept.groupBy("feature", "sample").agg(F.count(F.lit(1)).cast("double").alias("value"))
