"""K-mer tables, coverage statistics of reads, normalisation, overlap graphs and greedy contigs.

Sequences are frames (accession, sequence). They are cut in the JVM into blocks that overlap by a k-mer, and a row's k-mer
is taken from its block: time is linear in a sequence's length, and no row holds all its k-mers. Counting combines on the
map side, so a k-mer that is everywhere costs one row per task in the shuffle.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import seq as S
from ..workers import importable
from . import graphs


#: K-mers of a block; finding one in it costs up to as many steps.
BLOCK = 48


def positions(seqs: DataFrame, k: int, canonical: bool = False, carry: tuple[str, ...] = ("accession",)) -> DataFrame:
    """(carried columns, pos, kmer), from position 0."""
    x = seqs.select(*carry, F.posexplode(S.overlapping_blocks(F.col("sequence"), k, BLOCK)).alias("_b", "_block"))
    if canonical:  # a block's complement is made once for all its k-mers
        x = x.withColumn("_rc", S.reverse_complement(F.col("_block")))
    x = x.select("*", F.explode(F.sequence(F.lit(1), F.length("_block") - (k - 1))).alias("_i"))
    kmer = F.substring("_block", F.col("_i"), F.lit(k))
    if canonical:
        kmer = F.least(kmer, F.substring("_rc", F.length("_block") - F.col("_i") - (k - 2), F.lit(k)))
    return x.select(*carry, (F.col("_b") * BLOCK + F.col("_i") - 1).alias("pos"), kmer.alias("kmer"))


def counts(seqs: DataFrame, k: int, canonical: bool = True, least: int = 1) -> DataFrame:
    """(kmer, n)."""
    return positions(seqs, k, canonical).groupBy("kmer").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def histogram(table: DataFrame) -> DataFrame:
    """(n, kmers): how many k-mers come n times."""
    return table.groupBy("n").agg(F.count(F.lit(1)).alias("kmers"))


def read_stats(seqs: DataFrame, table: DataFrame, k: int, canonical: bool = True) -> DataFrame:
    """(accession, kmers, median, mean, stdev) of the counts of each read's k-mers; a k-mer that the table lacks counts 0.

    A read's repeated k-mers meet the table once, weighted; a k-mer that very many reads have is a skewed join key, which adaptive
    execution splits on the reads' side.
    """
    own = positions(seqs, k, canonical).groupBy("accession", "kmer").agg(F.count(F.lit(1)).alias("w"))
    x = own.join(table, "kmer", "left").na.fill(0, ["n"])
    w, n = F.col("w"), F.col("n").cast("double")
    total, mean = F.sum(w), F.sum(w * n) / F.sum(w)
    spread = F.sum(w * n * n) - F.sum(w) * mean * mean
    return x.groupBy("accession").agg(total.alias("kmers"), F.percentile(n, 0.5, w).alias("median"), mean.alias("mean"), F.when(total > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (total - 1))).otherwise(0.0).alias("stdev"))


def merged_mates(left: DataFrame, right: DataFrame, decimals: int = 1) -> DataFrame:
    """Statistics of both mates as their means, by core name."""
    l, r = (s.select(S.core_read_name(F.col("accession")).alias("core"), *[F.col(c).alias(f"{c}_{i}") for c in ("median", "mean", "stdev")]) for i, s in enumerate((left, right)))
    return l.join(r, "core").select("core", *[F.round((F.col(f"{c}_0") + F.col(f"{c}_1")) / 2, decimals).alias(c) for c in ("median", "mean", "stdev")])


def normalised(stats: DataFrame, max_cov: float = 200, min_cov: float = 0, max_cv: float = 10_000, seed: int = 12345, key: str = "accession") -> DataFrame:
    """Reads kept with chance max_cov / median, by a keyed hash: the same reads whatever the partitioning."""
    ok = (F.col("median") >= min_cov) & (F.col("mean") > 0) & (F.try_divide("stdev", "mean") <= max_cv)
    return stats.where(ok & (S.hash_uniform(F.col(key), seed=seed) * F.col("median") <= max_cov))


def shared_by_sets(seqs: DataFrame, genes: DataFrame, k: int = 24, canonical: bool = True) -> DataFrame:
    """(first_kmer, gene, genes, n): for each set of two genes or more that k-mers have in common its genes, one a row, with the set's size, the number of its
    k-mers and the smallest of them, which names the set.

    genes: (accession, gene). A k-mer's set is told by sums of two hashes of its distinct genes, so no set is ever collected.
    """
    x = positions(seqs, k, canonical).select("accession", "kmer").join(genes, "accession").select("kmer", "gene").distinct()
    hashed = [F.sum(F.xxhash64(F.lit(i), "gene").cast("decimal(38,0)")).alias(f"h{i}") for i in (0, 1)]
    sets = x.groupBy("kmer").agg(F.count(F.lit(1)).alias("genes"), *hashed).where("genes > 1")
    named = sets.groupBy("genes", "h0", "h1").agg(F.min("kmer").alias("kmer"), F.count(F.lit(1)).alias("n"))
    return x.join(named, "kmer").select(F.col("kmer").alias("first_kmer"), "gene", "genes", "n")


def sharing_links(seqs: DataFrame, k: int, canonical: bool = False) -> DataFrame:
    """(a, b, kmers): each sequence with the smallest accession that has one of its k-mers.

    The links join the same sequences into the same groups as all pairs would, at one row per sequence and k-mer at most.
    """
    x = positions(seqs, k, canonical).select("kmer", "accession").distinct()
    least = x.groupBy("kmer").agg(F.min("accession").alias("a"), F.count(F.lit(1)).alias("c")).where("c > 1").select("kmer", "a")
    return x.join(least, "kmer").where("a <> accession").groupBy("a", F.col("accession").alias("b")).agg(F.count(F.lit(1)).alias("kmers"))


#: Letters by whose least hash a k-mer is dealt, parts that k-mers are dealt to, k-mers of a run at most, and letters that are looked at together.
MINIMIZER, PARTS, LONGEST_RUN, LETTERS = 11, 4096, 4096, 1 << 23
_CODES = np.full(256, 4, np.uint8)
_CODES[[ord(c) for c in "ACGT"]] = range(4)


def _letters(text: str) -> np.ndarray:
    """0 to 3 for A, C, G and T, 4 for all else."""
    return _CODES[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 255)]


def _numbers(codes: np.ndarray, k: int) -> np.ndarray:
    """The k letters from each place on as a number, two bits a letter."""
    out, have, step, size = None, 0, codes, 1
    while size <= k:
        if k & size:
            places = max(0, len(codes) - have - size + 1)
            out = step if out is None else (out[:places] << codes.dtype.type(2 * size)) | step[have : have + places]
            have += size
        step = (step[: max(0, len(step) - size)] << codes.dtype.type(2 * size)) | step[size:]
        size *= 2
    return out


def _either(codes: np.ndarray, k: int, canonical: bool = True) -> np.ndarray:
    """Those numbers, or the complement's where that is less."""
    n = _numbers(codes, k)
    return np.minimum(n, _numbers(codes.dtype.type(3) - codes[::-1], k)[::-1]) if canonical else n


def _runs(texts: list[str], k: int, canonical: bool) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(part, text, run): the texts' k-mers as runs of neighbours that go to one part. Equal k-mers, and with canonical each other's complements, go to the
    same part. K-mers with other letters, or of more than 31, are runs of their own, canonical already."""
    joined, sizes = "".join(texts), np.array([len(t) for t in texts], int)
    if len(joined) < k:
        return np.empty(0, int), np.empty(0, int), []
    codes, text = _letters(joined), np.repeat(np.arange(len(texts)), sizes)
    places = len(joined) - k + 1
    whole = np.cumsum(sizes)[text[:places]] - np.arange(places) >= k
    other = np.concatenate([[0], np.cumsum(codes == 4)])
    plain = whole & (other[k:] == other[:-k]) if k <= 31 else np.zeros(places, bool)
    m = min(MINIMIZER, k)
    least = (_either((codes & 3).astype(np.uint32), m) ^ np.uint32(0x2A5A5)) * np.uint32(2654435761)
    width, left = 1, k - m + 1  # the least hash of the m-mers of each k-mer
    while width < left:
        by = min(width, left - width)
        least = np.minimum(least[:-by], least[by:])
        width += by
    first = plain.copy()
    first[1:] &= ~plain[:-1] | (least[1:] != least[:-1]) | (text[1:places] != text[: places - 1]) | (np.arange(1, places) % LONGEST_RUN == 0)
    last = plain.copy()
    last[:-1] &= ~plain[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + k
    parts = ((least[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(int) % PARTS
    runs, odd = [joined[i:j] for i, j in zip(starts.tolist(), ends.tolist(), strict=True)], np.flatnonzero(whole & ~plain)
    if len(odd):
        kmers, pairs = [joined[i : i + k] for i in odd.tolist()], str.maketrans(S.IUPAC_FROM, S.IUPAC_TO)
        kmers = [min(x, x.translate(pairs)[::-1]) for x in kmers] if canonical else kmers
        # U's complement is A: what has become plain is an A, C, G, T k-mer if such a one is written so, else equals none of them.
        new = [i for i, x in enumerate(kmers) if k <= 31 and not x.strip("ACGT")]
        same = [i for i in new if kmers[i] <= kmers[i].translate(pairs)[::-1]]
        for i in set(new).difference(same):
            kmers[i] = f"\0{kmers[i]}"
        dealt = np.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) % PARTS for x in kmers], int)
        if same:
            dealt[same] = _runs([kmers[i] for i in same], k, canonical)[0]
        parts, starts, runs = np.concatenate([parts, dealt]), np.concatenate([starts, odd]), runs + kmers
    return parts, text[starts], runs


class _Names:
    """Numbers for values, in the order they come."""

    def __init__(self):
        self.ids: dict = {}

    def __call__(self, column) -> np.ndarray:
        d = column.dictionary_encode("encode")
        new = [self.ids.setdefault(x, len(self.ids)) for x in d.dictionary.to_pylist()]
        return np.array(new, int)[d.indices.to_numpy(zero_copy_only=False)]


def _keys(runs: list[str], k: int, canonical: bool, odd: _Names) -> tuple[np.ndarray, np.ndarray]:
    """(key, run) of all k-mers of the runs; equal k-mers have equal keys."""
    joined, sizes = "".join(runs), np.array([len(r) for r in runs], int)
    codes, at = _letters(joined), np.repeat(np.arange(len(runs)), sizes)
    ends = np.cumsum(sizes)
    if k > 31 or (codes == 4).any():
        own = np.bincount(at[codes == 4], minlength=len(runs)) > 0 if k <= 31 else np.ones(len(runs), bool)
        keys, run = _keys([r for r, o in zip(runs, own.tolist(), strict=True) if not o], k, canonical, odd) if not own.all() else (np.empty(0, np.uint64), np.empty(0, int))
        more = [odd.ids.setdefault(r, len(odd.ids)) + (1 << 62) for r, o in zip(runs, own.tolist(), strict=True) if o]
        return np.concatenate([keys, np.array(more, np.uint64)]), np.concatenate([np.flatnonzero(~own)[run], np.flatnonzero(own)])
    places = len(codes) - k + 1
    there = ends[at[:places]] - np.arange(places) >= k
    return _either(codes.astype(np.uint64), k, canonical)[there], at[:places][there]


def _distinct(*columns: np.ndarray) -> list[np.ndarray]:
    """The distinct rows, in order of the first column, then the next."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return [c[new] for c in columns]


class _Part:
    """One part's k-mers: those of bundles come first, then those of reads, a read's together."""

    def __init__(self, k: int, canonical: bool, kind):
        self.k, self.canonical, self.kind, self.odd, self.bundles, self.have = k, canonical, kind, _Names(), _Names(), [np.empty(0, np.uint64), np.empty(0, int)]

    def learn(self, bundles, runs) -> None:
        keys, run = _keys(runs.to_pylist(), self.k, self.canonical, self.odd)
        self.have = _distinct(*(np.concatenate(x) for x in zip(self.have, (keys, self.bundles(bundles)[run]), strict=True)))

    def count(self, reads, runs) -> tuple:
        """(reads, bundles, shared, total): a read's total stands in one of its rows, the bundle of rows that share nothing is null."""
        import pyarrow as pa

        d = reads.dictionary_encode()
        keys, run = _keys(runs.to_pylist(), self.k, self.canonical, self.odd)
        read, keys = _distinct(d.indices.to_numpy()[run], keys)
        total = np.bincount(read, minlength=len(d.dictionary))
        lo, hi = (np.searchsorted(self.have[0], keys, side) for side in ("left", "right"))
        n = hi - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        pair, shared = np.unique(np.repeat(read, n) * max(1, len(self.bundles.ids)) + self.have[1][at], return_counts=True)
        read, bundle = np.divmod(pair, max(1, len(self.bundles.ids)))
        none = np.setdiff1d(np.flatnonzero(total), read)
        first = np.ones(len(read), bool)
        first[1:] = read[1:] != read[:-1]
        reads, bundles = np.concatenate([read, none]), np.concatenate([bundle, np.full(len(none), len(self.bundles.ids))])
        return d.dictionary.take(pa.array(reads)), pa.array([*self.bundles.ids, None], self.kind).take(pa.array(bundles)), np.concatenate([shared, np.zeros(len(none), int)]), np.concatenate([np.where(first, total[read], 0), total[none]])


def best_bundle(reads: DataFrame, contigs: DataFrame, k: int = 25, least_percent: float = 10.0, canonical: bool = True) -> DataFrame:
    """(accession, bundle, shared, percent): the bundle that has most of a read's distinct k-mers. contigs: (accession, sequence, bundle).

    Neighbouring k-mers mostly have their least m-mer in common, by which they are dealt out as one run of letters, so a k-mer is
    never a row. A part has all that equals one of its k-mers, and is counted by itself, its reads in pieces.
    """
    import pyarrow as pa

    importable(reads.sparkSession)
    kinds = reads.schema["accession"].dataType, contigs.schema["bundle"].dataType
    schema = pa.schema([("part", pa.int32()), ("accession", to_arrow_type(kinds[0])), ("bundle", to_arrow_type(kinds[1])), ("read", pa.bool_()), ("run", pa.string())])
    out = pa.schema([("accession", schema[1].type), ("bundle", schema[2].type), ("shared", pa.int64()), ("total", pa.int64())])

    def cut(batches):
        for batch in batches:
            texts, lo = batch.column(3).to_pylist(), 0
            while lo < batch.num_rows:
                hi, size = lo + 1, len(texts[lo])
                while hi < batch.num_rows and size + len(texts[hi]) <= LETTERS // 32:
                    size += len(texts[hi])
                    hi += 1
                parts, text, runs = _runs(texts[lo:hi], k, canonical)
                for i in range(0, len(runs), 10_000):
                    at = pa.array(text[i : i + 10_000] + lo)
                    yield pa.RecordBatch.from_arrays([pa.array(parts[i : i + 10_000], pa.int32()), *(batch.column(c).take(at) for c in range(3)), pa.array(runs[i : i + 10_000], pa.string())], schema=schema)
                lo = hi

    def pieces(batches):
        """(part, whether it is of reads, rows): a read's rows of a part in one piece."""
        held, size, of = [], 0, None
        for batch in batches:
            part, read = batch.column(0).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((part[1:] != part[:-1]) | (read[1:] != read[:-1])) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if of != (now := (part[lo], read[lo])):
                    if held:
                        yield *of, pa.concat_batches(held)
                    held, size, of = [], 0, now
                held.append(batch.slice(lo, hi - lo))
                size += held[-1].get_total_buffer_size() * (hi - lo) // batch.num_rows
                if size > LETTERS:
                    rows = pa.concat_batches(held)
                    keep = rows.num_rows
                    if now[1]:  # the last read may go on in the next batch
                        d = rows.column(1).dictionary_encode().indices.to_numpy()
                        keep = int(np.flatnonzero(d == d[-1])[0])
                    if keep:
                        yield *now, rows.slice(0, keep)
                    held, size = ([rows.slice(keep)], rows.slice(keep).nbytes) if keep < rows.num_rows else ([], 0)
        if held:
            yield *of, pa.concat_batches(held)

    def count(batches):
        at, part = None, None
        for number, read, rows in pieces(batches):
            if number != at:
                at, part = number, _Part(k, canonical, schema[2].type)
            if not read:
                part.learn(rows.column(2), rows.column(4))
                continue
            found = part.count(rows.column(1), rows.column(4))
            for i in range(0, len(found[0]), 10_000):
                yield pa.RecordBatch.from_arrays([found[0][i : i + 10_000], found[1][i : i + 10_000], *(pa.array(c[i : i + 10_000], pa.int64()) for c in found[2:])], schema=out)

    names = [x.simpleString() for x in kinds]
    of = F.lit(None)
    own = reads.where("accession IS NOT NULL").select("accession", of.cast(names[1]).alias("bundle"), F.lit(True).alias("read"), "sequence")
    have = contigs.select(of.cast(names[0]).alias("accession"), "bundle", F.lit(False).alias("read"), "sequence")
    runs = own.union(have).where(F.length("sequence") >= k).mapInArrow(cut, f"part int, accession {names[0]}, bundle {names[1]}, read boolean, run string")
    found = runs.repartition("part").sortWithinPartitions("part", "read", "accession").mapInArrow(count, f"accession {names[0]}, bundle {names[1]}, shared long, total long")
    hits = found.repartition("accession").groupBy("accession", "bundle").agg(F.sum("shared").alias("shared"), F.sum("total").alias("_total"))
    hits = hits.withColumn("percent", F.col("shared") * 100.0 / F.sum("_total").over(Window.partitionBy("accession")))
    best = F.row_number().over(Window.partitionBy("accession").orderBy(F.desc("shared"), "bundle"))
    return hits.where((F.col("shared") > 0) & (F.col("percent") >= least_percent)).withColumn("_r", best).where("_r = 1").select("accession", "bundle", "shared", "percent")


# Graphs of overlapping k-mers ------------------------------------------------------------------------------------
def _ends(kmer: str, k: int) -> list:
    return [F.substring(kmer, 1, k).alias("src"), F.substring(kmer, 2, k).alias("dst")]


def edges(seqs: DataFrame, k: int) -> DataFrame:
    """(src, dst, weight): k-mers that follow each other, with how often they do. An edge is counted as one (k + 1)-mer."""
    return counts(seqs, k + 1, canonical=False).select(*_ends("kmer", k), F.col("n").alias("weight"))


def edge_readers(seqs: DataFrame, k: int) -> DataFrame:
    """(src, dst, reader): the sequences that make each edge, one a row."""
    return positions(seqs, k + 1).select("accession", "kmer").distinct().select(*_ends("kmer", k), F.col("accession").alias("reader"))


def well_supported(readers: DataFrame, least: float = 0.1) -> DataFrame:
    """(src, dst, readers): edges whose number of readers is at least that share of the readers of all edges at either end of it."""
    at = readers.select(F.col("src").alias("node"), "reader").union(readers.select("dst", "reader")).distinct().groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    x = readers.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("readers"))
    x = x.join(at.select(F.col("node").alias("src"), F.col("n").alias("ns")), "src").join(at.select(F.col("node").alias("dst"), F.col("n").alias("nd")), "dst")
    return x.where(F.col("readers") >= least * F.greatest("ns", "nd")).select("src", "dst", "readers")


def degrees(e: DataFrame) -> DataFrame:
    """(node, n_in, n_out, w_in, w_out)."""
    both = e.select(F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o"), F.lit(0).cast("long").alias("wi"), F.col("weight").alias("wo")).union(e.select(F.col("dst").alias("node"), F.lit(1), F.lit(0), F.col("weight"), F.lit(0).cast("long")))
    return both.groupBy("node").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"), F.sum("wi").alias("w_in"), F.sum("wo").alias("w_out"))


def without_rare(e: DataFrame, table: DataFrame, least: int) -> DataFrame:
    """Edges between k-mers that come least times or more."""
    ok = table.where(F.col("n") >= least).select("kmer")
    return e.join(ok.withColumnRenamed("kmer", "src"), "src", "left_semi").join(ok.withColumnRenamed("kmer", "dst"), "dst", "left_semi")


def without_tips(e: DataFrame, least_weight: float) -> DataFrame:
    """Edges without those that lead to a dead end beside a branch and weigh less than that."""
    d = degrees(e)
    x = e.join(d.select(F.col("node").alias("src"), F.col("n_in").alias("si"), F.col("n_out").alias("so")), "src").join(d.select(F.col("node").alias("dst"), F.col("n_in").alias("di"), F.col("n_out").alias("do")), "dst")
    tip = ((F.col("do") == 0) & (F.col("so") > 1)) | ((F.col("si") == 0) & (F.col("di") > 1))
    return x.where(~(tip & (F.col("weight") < least_weight))).select("src", "dst", "weight")


def unitigs(e: DataFrame, k: int) -> DataFrame:
    """(unitig, sequence, kmers, weight): unbranched chains of an overlap graph as single sequences.

    An inner edge has one way out of its source and one into its target. Chains are found by pointer doubling over those edges
    (logarithmic rounds, each a written table); a ring is cut before its smallest k-mer.
    """
    return graphs.chains(e, k)


def greedy_contigs(seqs: DataFrame, k: int = 25, least: int = 1, shortest: int = 25) -> DataFrame:
    """(contig, sequence, kmers, coverage): from the most frequent k-mer of each connected group, extended both ways by the
    most frequent overlapping one not yet used, until none is left; then from the next.

    Groups of connected k-mers are independent and are the unit of work; groups' ids come from the distributed components.
    """
    importable(seqs.sparkSession)
    table = counts(seqs, k, canonical=False, least=least)
    e = without_rare(edges(seqs, k), table, least)
    ids = table.select("kmer", "n", F.xxhash64("kmer").alias("id"))
    links = e.select(F.xxhash64("src").alias("a"), F.xxhash64("dst").alias("b"))
    comp = graphs.components(links, "a", "b")
    grouped = ids.join(comp, ids.id == comp.node, "left").select("kmer", "n", F.coalesce("component", "id").alias("g"))
    return grouped.groupBy("g").applyInPandas(_extend(k, shortest), "contig string, sequence string, kmers int, coverage double")


def _extend(k: int, shortest: int):
    def run(group):
        import pandas as pd

        left = dict(zip(group["kmer"], group["n"].tolist(), strict=True))
        rows = []
        for seed in sorted(left, key=lambda x: (-left[x], x)):
            if seed not in left:
                continue
            path, weights = seed, [left.pop(seed)]
            for forward in (True, False):
                while True:
                    ways = [path[-(k - 1) :] + c for c in "ACGT"] if forward else [c + path[: k - 1] for c in "ACGT"]
                    ways = [w for w in ways if w in left]
                    if not ways:
                        break
                    best = min(ways, key=lambda w: (-left[w], w))
                    weights.append(left.pop(best))
                    path = path + best[-1] if forward else best[0] + path
            if len(path) >= shortest:
                rows.append((seed, path, len(weights), sum(weights) / len(weights)))
        return pd.DataFrame(rows, columns=["contig", "sequence", "kmers", "coverage"])

    return run
