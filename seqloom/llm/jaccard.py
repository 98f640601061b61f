"""N-gram Jaccard join by grouped prefixes, and near-duplicate classes.

Each text's set of distinct shingles (64-bit hashes) is put into one global order, rare shingles first; two sets whose
Jaccard similarity reaches the threshold share a shingle of their prefixes, whose length follows from their size. Rarity
comes from a count sketch of fixed size over all texts; any order gives the same links.

Texts with equal sets collapse into one class, classes with equal prefixes and size into one group, and only groups are
dealt out by the shingles of their prefix, sorted by size. Each group meets first a leader (the smallest of its size class that
shares a shingle); verified pairs form components. Then all pairs of groups that share a prefix shingle, pass the size
filter and aren't in one component already are expanded to their members and verified. Pairs inside a component change
nothing, so each link between different components is found, and no group of copies is expanded into pairs.

Null, empty and blank texts have empty sets and are linked with nothing. Fewer words than a shingle make one shingle of
the whole. Equal texts are linked with each other. Repeated rows stay, each with its class. Rows with a null id are in
the class of equal sets; a class with no other ids has the component null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, components, cut, free, small_batches, unused

SHINGLE = 4
PERCENT = 85
SKETCH_BITS = 18
SKETCH_CHUNK = 4096
#: Distinct words that a worker remembers; workers live on from stage to stage with what they hold.
WORDS = 200_000
#: Up to this many classes to be verified are sent to every executor (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 400_000
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_words = _Words()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(texts: list[str | None], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): the 64-bit hashes of all texts' shingles with repeats, and where each text's end.

    A-Z are lower-cased and words cut at ASCII white space; a text of fewer than k words has one shingle.
    """
    words = [(t or "").encode().lower().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    w = np.fromiter(map(_words.__getitem__, chain.from_iterable(words)), np.uint64, int(sizes.sum()))
    if not len(w):
        return w, np.zeros(len(texts), np.int64)
    rest = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(w))  # words from here to the text's end
    total = np.repeat(sizes, sizes)
    start = (rest >= k) | ((total < k) & (rest == total))
    h = np.minimum(total, k).astype(np.uint64)
    for i in range(k):
        n = len(w) - i
        if n <= 0:
            break
        mixed = _mixed(h[:n] ^ (w[i:] * _MULT[i % len(_MULT)]))
        h[:n] = mixed if i == 0 else np.where(rest[:n] > i, mixed, h[:n])
    return h[start], np.cumsum(np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1)))


def shingle_sets(texts: list[str | None], k: int = SHINGLE) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles."""
    h, ends = shingle_hashes(texts, k)
    return [np.unique(x) for x in np.split(h, ends[:-1])] if len(texts) else []


def shingle_set(text: str | None, k: int = SHINGLE) -> np.ndarray:
    return shingle_sets([text], k)[0]


def _set_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def sketch(docs: DataFrame, text_col: str, k: int) -> np.ndarray:
    """For each bucket of shingle hashes a level of frequency, 0 for what chance puts there. Fixed size: 2^18 bytes."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            h, _ = shingle_hashes(b.columns[0].to_pylist(), k)
            total += np.bincount((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
        parts = np.minimum(total, 2**31 - 1).astype("<i4").reshape(-1, SKETCH_CHUNK)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "counts"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH_CHUNK, np.int64)
        for b in batches:
            for x in b.column("counts").to_pylist():
                total += np.frombuffer(x, "<i4")
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["part", "counts"])

    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "part int, counts binary").groupBy("part").applyInArrow(add, "part int, counts binary").collect()
    total = np.zeros(1 << SKETCH_BITS, np.float64)
    for r in rows:
        total[r.part * SKETCH_CHUNK : (r.part + 1) * SKETCH_CHUNK] = np.frombuffer(r.counts, "<i8")
    usual = float(np.median(total))
    return np.log2(1 + np.maximum(0, total - usual - 5 * np.sqrt(usual + 1))).astype(np.uint8)


def _prefix(s: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    n = prefix_size(len(s), percent)
    level = levels[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    return s[np.lexsort((s, level))[:n]] if level.any() else s[:n]


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """Rows (id, cid, n, prefix); cid stands for the set."""
    levels = docs.sparkSession.sparkContext.broadcast(sketch(docs, text_col, k))
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def f(ids, texts):
        cids, sizes, flat, ends = [], [], [np.zeros(0, np.uint64)], [0]
        for s in shingle_sets(texts, k):
            p = _prefix(s, levels.value, percent) if len(s) else s
            cids.append(_set_id(s))
            sizes.append(len(s))
            flat.append(p)
            ends.append(ends[-1] + len(p))
        return ids, cids, sizes, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat).view(np.int64)))

    return arrow_map(docs.select(id_col, F.col(text_col).cast("string")), f, f"id {kind}, cid long, n int, prefix array<long>")


def _met(tokens: DataFrame, percent: int) -> DataFrame:
    """For each shingle that two groups or more have in their prefixes: (tok, g, n, pos, leader), one row per group.

    One shuffle by shingle; a shingle's groups pass by in order of its place in their prefix, and of them only leaders are
    held. The earlier the place, the fewer rare shingles of its own a group has: leaders are the middle of a crowd.
    """
    ratio = np.log(100 / percent)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first, leaders = None, None, {}
        for b in batches:
            tok, g, n, pos = (c.to_pylist() for c in b.columns)
            size = (np.log(np.array(n, float)) / ratio).astype(np.int64).tolist()
            out: list[tuple] = []
            for t, x, m, at, s in zip(tok, g, n, pos, size, strict=True):
                if t != last:
                    last, first, leaders = t, (t, x, m, at), {s: (x, m)}
                    continue
                if first:
                    out.append((*first, first[1]))
                    first = None
                lead = x
                for near in (s, s - 1, s + 1):
                    y = leaders.get(near)
                    if y and 100 * min(y[1], m) >= percent * max(y[1], m):
                        lead = y[0]
                        break
                out.append((t, x, m, at, lead))
                if s not in leaders:
                    leaders[s] = (x, m)
            if out:
                cols = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["tok", "g", "n", "pos", "leader"])

    dealt = tokens.repartition(F.col("tok")).sortWithinPartitions("tok", "pos", "g")
    return dealt.mapInArrow(scan, "tok long, g long, n int, pos int, leader long")


def _met_apart(met: DataFrame, spans: DataFrame, percent: int) -> DataFrame:
    """Pairs (g1, g2) of groups, not yet in one component, that share a shingle where their first common one may be.

    If it is the first, at most what follows its place is common to both; that must be enough. So in the smaller of the two it stands
    in a short part of the prefix, and it does so at once for all shingles of a crowd that is one component already.
    """
    p, q = percent, 100 + percent
    early = f"pos < n - (2 * {p} * n + {q - 1}) div {q} + 1"
    marked = cut(met.select("tok", "g", "n", "pos", F.expr(early).alias("early")).join(spans, "g"), "marked")
    small = F.when(F.col("early"), F.col("n"))
    of = marked.groupBy("tok").agg(F.min("lo").alias("l"), F.max("hi").alias("h"), F.min(small).alias("a"), F.max(small).alias("b")).where("l <> h and a is not null").select("tok", "a", "b")
    # A row that isn't early needs an early partner no larger than itself, and no larger than what follows its place allows.
    left = marked.join(of, "tok").where(f"early or ({p} * n <= 100 * b and least(n, ((n - pos) * {q}) div {p} - n) >= a)")
    x, y = (left.select("tok", *[F.col(c).alias(f"{c}{i}") for c in ("g", "n", "pos", "lo", "hi", "early")]) for i in (1, 2))
    enough = f"{p} * (n1 + n2) <= {q} * (n1 - pos1) and {p} * (n1 + n2) <= {q} * (n2 - pos2) and {p} * n2 <= 100 * n1"
    return x.where("early1").join(y, "tok").where(f"(n1 < n2 or (n1 = n2 and g1 < g2)) and {enough} and not (lo1 = hi1 and lo1 = lo2 and lo2 = hi2)").select("g1", "g2").distinct()


def verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of classes whose sets are similar enough, by the whole sets.

    Sets are compared by half of each hash first. What halves share is an upper bound, and over the truth by more than the
    margin with a chance under 10^-9; pairs within the margin are compared by whole hashes.
    """
    pairs = cut(pairs, "pairs")
    if pairs.isEmpty():
        return pairs.select("a", "b")
    first = _compared(pairs, docs, reps, id_col, text_col, k, percent, False)
    near = cut(first.where("sure = 0").select("a", "b").distinct(), "near")
    sure = first.where("sure = 1").select("a", "b")
    if near.isEmpty():
        return sure
    return sure.union(_compared(near, docs, reps, id_col, text_col, k, percent, True).select("a", "b"))


def _compared(pairs: DataFrame, docs: DataFrame, reps: DataFrame, id_col: str, text_col: str, k: int, percent: int, whole: bool) -> DataFrame:
    """(a, b, sure) of the pairs that are similar enough: sure is 1, or 0 if halves of hashes can't tell."""
    ids = cut(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct().join(reps.select("cid", "rep"), "cid"), "wanted")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select(F.col(id_col).alias("rep"), F.col(text_col).cast("string").alias("text")).join(ids, "rep")
    kind = np.dtype("<u8" if whole else "<u4")

    def sets(cids, texts):
        made = shingle_sets(texts, k)
        return cids, [(s if whole else s >> np.uint64(32)).astype(kind).tobytes() for s in made], [_set_id(s) == c for c, s in zip(cids, made, strict=True)]

    # An id may stand for several texts: only the class's own counts. Repeated rows repeat a pair, which changes nothing.
    held = cut(arrow_map(texts.select("cid", "text"), sets, "cid long, s binary, own boolean").where("own").select("cid", "s"), "sets")
    both = pairs.join(held.select(F.col("cid").alias("a"), F.col("s").alias("sa")), "a").join(held.select(F.col("cid").alias("b"), F.col("s").alias("sb")), "b")

    def test(a, b, sa, sb):
        keep, sure = [], []
        for i, (x, y) in enumerate(zip(sa, sb, strict=True)):
            merged = np.frombuffer(x + y, kind)
            n = len(merged)
            merged = np.sort(merged)
            shared = int((merged[1:] == merged[:-1]).sum())
            if 100 * shared >= percent * (n - shared):
                low = shared if whole else shared - 4 - math.ceil(20 * n * n / 2**33)
                keep.append(i)
                sure.append(int(100 * low >= percent * (n - low)))
        return [a[i] for i in keep], [b[i] for i in keep], sure

    out = cut(arrow_map(both.select("a", "b", "sa", "sb"), test, "a long, b long, sure int"), "similar")
    free(held)
    return out


def _may_link(n1: str, n2: str, shared: str, percent: int) -> str:
    """Whether sets of these sizes with so many common shingles in their prefixes can be similar enough.

    What they have in common up to the end of the prefix that ends first lies in both prefixes; beyond it there is at
    most what that set has behind its prefix.
    """
    rest = lambda n: f"(({percent} * {n} + 99) div 100 - 1)"
    return f"{shared} + greatest({rest(n1)}, {rest(n2)}) >= ({percent} * ({n1} + {n2}) + {99 + percent}) div {100 + percent}"


def similar_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Rows (id, n_shingles, cid, component_id): one for each row of docs."""
    made = cut(signatures(docs, id_col, text_col, shingle, percent), "signatures")
    classes = cut(made.where("n > 0").groupBy("cid").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix")).where("rep is not null"), "classes")
    sigs = cut(made.select("id", "n", "cid"), "rows")
    free(made)
    # A group is known by its smallest class, its leader; only groups of several classes are written.
    keyed = classes.select("cid", F.xxhash64("n", "prefix").alias("ph"))
    several = keyed.groupBy("ph").agg(F.min("cid").alias("g"), F.count(F.lit(1)).alias("members")).where("members > 1")
    members = cut(keyed.join(several, "ph").select("cid", "g"), "members")
    groups = classes.join(members.where("cid <> g").select("cid"), "cid", "left_anti").select(F.col("cid").alias("g"), "n", "prefix")
    met = cut(_met(groups.select(F.posexplode("prefix").alias("pos", "tok"), "g", "n").select("tok", "g", "n", "pos"), percent), "met")
    # First round: each group and the leader it shares most shingles with; each member and its group.
    star = met.where("leader <> g").groupBy("g", "leader").agg(F.count(F.lit(1)).alias("c")).groupBy("g").agg(F.max(F.struct("c", "leader")).alias("best"))
    pairs = star.select(F.col("best.leader").alias("a"), F.col("g").alias("b")).union(members.where("cid <> g").select(F.col("g").alias("a"), F.col("cid").alias("b")))
    ends = [classes.select(F.col("cid").alias(c), F.col("n").alias(f"n{c}"), F.col("prefix").alias(f"p{c}")) for c in "ab"]
    pairs = pairs.join(ends[0], "a").join(ends[1], "b").where(_may_link("na", "nb", "size(array_intersect(pa, pb))", percent)).select("a", "b")
    links = cut(verified(pairs, docs, classes, id_col, text_col, shingle, percent), "links")
    comp = components(links)
    # Second round: what the first left in different components.
    own = members.join(comp, members.cid == comp.node, "left").select("g", "cid", F.coalesce("comp", "cid").alias("comp"))
    lone = classes.select("cid").join(members.select("cid"), "cid", "left_anti").select(F.col("cid").alias("g"), "cid").join(comp, F.col("g") == comp.node, "left").select("g", "cid", F.coalesce("comp", "cid").alias("comp"))
    own = cut(own.union(lone), "own")
    spans = own.groupBy("g").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    met2 = _met_apart(met, spans, percent)
    ends = [groups.select(F.col("g").alias(f"g{i}"), F.col("n").alias(f"n{i}"), F.col("prefix").alias(f"p{i}")) for i in (1, 2)]
    met2 = met2.join(ends[0], "g1").join(ends[1], "g2").where(_may_link("n1", "n2", "size(array_intersect(p1, p2))", percent)).select("g1", "g2")
    met2 = met2.union(spans.where("lo <> hi").select(F.col("g").alias("g1"), F.col("g").alias("g2")))
    m1, m2 = own.toDF("g1", "a", "c1"), own.toDF("g2", "b", "c2")
    rest = met2.join(m1, "g1").join(m2, "g2").where("c1 <> c2").where("g1 <> g2 or a < b").select("a", "b").distinct()
    more = cut(verified(rest, docs, classes, id_col, text_col, shingle, percent), "links")
    held = own.select("cid", F.col("comp").alias("first")).join(classes.select("cid", "rep"), "cid")
    least = cut(held.groupBy("first").agg(F.min("rep").alias("least")), "least")
    if more.isEmpty():
        least = least.withColumnRenamed("least", "component_id")
    else:
        # The first round's components are the nodes now, so this graph has an edge only where that round left a gap.
        ends = [own.select(F.col("cid").alias(c), F.col("comp").alias(f"c{c}")) for c in "ab"]
        top = components(more.join(ends[0], "a").join(ends[1], "b"), a="ca", b="cb")
        known = cut(least.join(top, F.col("first") == F.col("node"), "left").select("first", "least", F.coalesce("comp", "first").alias("last")), "known")
        least = known.join(known.groupBy("last").agg(F.min("least").alias("component_id")).hint("merge"), "last").select("first", "component_id")
    # Classes by themselves need no partner in this join; those of a very large component share its key, which adaptive execution splits.
    named = cut(held.join(least.hint("merge"), "first").select("cid", "component_id"), "named")
    out = sigs.select("id", "n", "cid").join(named.hint("merge"), "cid", "left")
    return out.select("id", F.col("n").cast("long").alias("n_shingles"), "cid", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def without_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component stays, the one with the smallest id; rows with empty sets and null ids all stay too.

    Where ids repeat, texts under one id are told apart, in an order by id and then by the text's address, and of rows that
    are equal in both the one with the smallest hash of its columns stands for all.
    """
    ids = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    if ids.where("n > 1").isEmpty():
        return _without_gone(docs, id_col, text_col, shingle, percent)
    number, address, row = (unused(docs, x) for x in ("number", "address", "row"))
    text, own = F.col(text_col).cast("string"), [F.col(f"`{c}`") for c in docs.columns]
    usable = F.col(id_col).isNotNull() & F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.where(usable).withColumn(address, F.unhex(F.sha2(text, 256)))
    order = [F.col(f"`{id_col}`"), F.col(address)]
    numbers = cut(keyed.select(*order).distinct().repartitionByRange(*order).sortWithinPartitions(*order).withColumn(number, F.monotonically_increasing_id()), "numbers")
    once = keyed.join(numbers, [id_col, address]).groupBy(number).agg(F.min_by(F.struct(*own), F.xxhash64(F.to_json(F.struct(*own)))).alias(row))
    once = cut(once.select(number, f"{row}.*"), "once")
    return _without_gone(once, number, text_col, shingle, percent).select(*own).unionByName(docs.where(~usable))


def _without_gone(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    found, name = similar_classes(docs, id_col=id_col, text_col=text_col, shingle=shingle, percent=percent), unused(docs, "gone")
    gone = cut(found.where("component_id <> id").select(F.col("id").alias(name)).distinct(), "gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs[id_col] == gone[name], "left_anti")
