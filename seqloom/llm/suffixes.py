"""Removal of repeated passages by a sparse suffix array over the UTF-8 bytes of all texts.

Equal texts first collapse into one, that of the smallest id. Of the others, every string of ``length`` bytes picks one
anchor by its content alone: the leftmost smallest hash of the ``gram``-byte strings in it. Equal strings have equal
anchors at equal places, so only suffixes at anchors are sorted: about one in 30 bytes. A suffix's key starts with its
leading bytes; sampled splitters range-partition the suffixes by it, buckets are sorted locally by multikey quicksort (by
four leading bytes and a hash of the gram, then a hash of what surrounds it, then id and place), and neighbours are
compared. Equal hashes count as equal bytes.
Suffixes whose whole surroundings (all strings of that anchor) are equal are repeats but for the first. Where
surroundings differ under one leading gram, or a run may go on in the next bucket, their strings are laid out singly,
range-partitioned and sorted again, and compared across the boundaries of buckets too. Ids and places are part of the
keys, so no splitter has to keep a frequent passage in one bucket.

Each byte covered by a string that also starts earlier (smaller id, or same text and earlier start) is removed. Null
and empty texts have 0 bytes; texts shorter than ``length`` lose nothing. Rows with one id and equal texts count as one
document and get equal results; texts under one id that differ come in the order of their digests. Ids may be of any
kind that has an order; a null id comes after all others. Very long texts are hashed a block at a time. An empty table
gives no rows, and other columns, of any name, don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import arrow_map, cut, free, small_batches, tidy

LENGTH = 100
GRAM = 40
#: Bytes hashed at a time; texts longer than that are taken in pieces that overlap by a string.
BLOCK = 1 << 20
#: Suffixes of a bucket: it is sorted in one task's memory (about 60 bytes each).
BUCKET = 400_000
#: Rows of a bucket's part that multikey quicksort parts no further.
SMALL = 4096
_R1, _R2 = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
#: Null ids come behind all others.
_NULL_ID = 1 << 63


def _powers(r: int, n: int) -> np.ndarray:
    return np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n - 1, r, np.uint64), dtype=np.uint64)))


_tables: dict[int, tuple] = {}


def _power_tables(n: int) -> tuple:
    size = max(BLOCK + 4 * LENGTH, n)
    if _tables.get("n", 0) < size:
        _tables["n"] = size
        _tables["t"] = tuple(_powers(r, size + 1) for x in (_R1, _R2) for r in (x, pow(x, -1, 1 << 64)))
    return _tables["t"]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Polynomial hashes of all substrings of a piece of bytes."""

    def __init__(self, data: np.ndarray, twice: bool = True):
        n = len(data)
        p1, self.i1, p2, self.i2 = _power_tables(n)
        x = data.astype(np.uint64) + np.uint64(1)
        self.s1 = np.zeros(n + 1, np.uint64)
        np.cumsum(x * p1[:n], out=self.s1[1:])
        if twice:
            self.s2 = np.zeros(n + 1, np.uint64)
            np.cumsum(x * p2[:n], out=self.s2[1:])

    def grams(self, k: int) -> np.ndarray:
        n = len(self.s1) - k
        return _mix((self.s1[k:] - self.s1[:-k]) * self.i1[:n]) if n > 0 else np.zeros(0, np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        a = _mix((self.s1[end] - self.s1[start]) * self.i1[start])
        b = _mix((self.s2[end] - self.s2[start]) * self.i2[start] + (end - start).astype(np.uint64))
        return a ^ (b << np.uint64(23) | b >> np.uint64(41))


def _smallest(v: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each w values in a row."""
    out, have = v, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Pieces of about BLOCK bytes: (bytes, [(text number, offset in the text, start in the piece)]); each string of a text lies in one piece at least, and starts in one only."""
    parts, where, size = [], [], 0
    for d, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), BLOCK):
            part = t[at : at + BLOCK + length - 1]
            if len(part) < length:
                continue
            where.append((d, at, size))
            parts.append(part)
            size += len(part)
            if size >= BLOCK:
                yield b"".join(parts), where
                parts, where, size = [], [], 0
    if parts:
        yield b"".join(parts), where


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, key, hash of the surroundings, first start, number of starts) of the anchors of each piece."""
    for data, where in _pieces(texts, length):
        x = np.frombuffer(data, np.uint8)
        n = len(x)
        hashes = Hashes(x)
        g = hashes.grams(gram)
        packed = (g & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(g), dtype=np.uint64)
        least = _smallest(packed, length - gram + 1)  # by start of string
        at = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        doc, offset, begin = (np.array(c, np.int64) for c in zip(*where, strict=True))
        end = np.append(begin[1:], n)
        bounds = np.zeros(len(at) + 1, bool)
        bounds[begin] = True
        bounds[np.minimum(end - length + 1, len(at))] = True
        new = bounds[:-1].copy()
        new[1:] |= at[1:] != at[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        part = np.searchsorted(begin, first, "right") - 1
        inside = last + length <= end[part]  # strings that run into the next text are none
        first, last, part = first[inside], last[inside], part[inside]
        a = at[first]
        lead = (x[a].astype(np.uint64) << np.uint64(56)) | (x[a + 1].astype(np.uint64) << np.uint64(48)) | (x[a + 2].astype(np.uint64) << np.uint64(40)) | (x[a + 3].astype(np.uint64) << np.uint64(32))
        key = lead | (g[a] >> np.uint64(32))
        around = hashes.of(first, last + length) ^ _mix((a - first).astype(np.uint64))
        yield doc[part], (key ^ np.uint64(1 << 63)).view(np.int64), around.view(np.int64), offset[part] + first - begin[part], last - first + 1


def multikey_order(keys: list[np.ndarray], small: int = SMALL) -> np.ndarray:
    """The order of rows by several keys, by multikey quicksort: rows are parted into those below, at and above a pivot of one
    key; those at it go on with the next key. Parts of up to ``small`` rows are left to a library sort."""
    order = np.arange(len(keys[0]))
    work = [(0, len(order), 0)]
    while work:
        lo, hi, depth = work.pop()
        if hi - lo < 2 or depth == len(keys):
            continue
        rows = order[lo:hi]
        if hi - lo <= small:
            order[lo:hi] = rows[np.lexsort([k[rows] for k in reversed(keys[depth:])])]
            continue
        v = keys[depth][rows]
        some = np.sort(v[:: max(1, len(v) // 255)])
        pivot = some[len(some) // 2]
        below, above = v < pivot, v > pivot
        a, c = int(below.sum()), int(above.sum())
        order[lo:hi] = np.concatenate((rows[below], rows[~(below | above)], rows[above]))
        work += [(lo, lo + a, depth), (lo + a, hi - c, depth + 1), (hi - c, hi, depth)]
    return order


def _bucketed(rows: DataFrame, names: list[str], n: int, f, schema: str) -> DataFrame:
    """Range-partitions by names (sampled splitters) and gives each bucket's columns, sorted, to f; f's columns come back."""
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)
    width = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if got is None or not got.num_rows:
            return
        columns = [got.column(i).to_numpy() for i in range(got.num_columns)]
        order = multikey_order(columns[:width])
        made = f(*[c[order] for c in columns])
        for at in range(0, len(made[0]), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 16)], t.type) for c, t in zip(made, out, strict=True)], schema=out)

    return rows.repartitionByRange(n, *names).mapInArrow(run, schema)


def _compare_suffixes(key, around, rep, start, count):
    """kind 0: all strings of the row are repeats; kind 1: its strings are to be compared singly."""
    n = len(key)
    new_key = np.ones(n, bool)
    new_key[1:] = key[1:] != key[:-1]
    new = new_key.copy()
    new[1:] |= around[1:] != around[:-1]
    new[0] = True
    run = np.cumsum(new_key) - 1
    several = np.bincount(run, weights=new)[run] > 1
    several |= (run == 0) | (run == run[-1])  # may go on in another bucket
    kind = np.where(~new, 0, np.where(several, 1, 2))
    keep = kind < 2
    return kind[keep], rep[keep], start[keep], count[keep]


def _compare_strings(h, rep, start):
    """kind 0: a repeat; 1: the bucket's first row; 2: its last."""
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    gone = np.flatnonzero(same)
    rows = np.concatenate((gone, [0, len(h) - 1]))
    kind = np.concatenate((np.zeros(len(gone), np.int64), [1, 2]))
    return kind, h[rows], rep[rows], start[rows]


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept_text (bytes; a cut may split a character)."""
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kind, integral = docs.select(id_col).schema[0].dataType, False
    if isinstance(kind, IntegralType):
        integral, key = True, F.coalesce(F.col(id_col).cast("decimal(20,0)"), F.lit(str(_NULL_ID)).cast("decimal(20,0)"))
    else:
        key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"))
    own = docs.select(key.alias("id"), F.col(id_col).alias("_raw"), F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("h"), text.alias("t"))
    texts = cut(own.where(F.octet_length("t") >= length).groupBy("h").agg(F.min("id").alias("first_id"), F.first("t").alias("t")), "texts")
    written = [texts]
    if integral and texts.groupBy("first_id").agg(F.count(F.lit(1)).alias("n")).where(f"n > 1 or first_id = {_NULL_ID}").isEmpty():
        texts = texts.select("h", "first_id", F.col("first_id").cast("long").alias("rep"), "t")
    else:  # several texts under one id, or ids that are no integers: texts are numbered in the order of ids
        numbers = cut(texts.select("first_id", "h").repartitionByRange("first_id", "h").sortWithinPartitions("first_id", "h").select("h", F.monotonically_increasing_id().alias("rep")), "numbers")
        texts = cut(texts.join(numbers, "h").select("h", "first_id", "rep", "t"), "texts")
        written.append(texts)

    def find(reps, ts):
        made = list(anchors([t.encode() for t in ts], length, gram))
        if not made:
            return [[]] * 5
        doc, key, around, start, count = (np.concatenate(c) for c in zip(*made, strict=True))
        return pa.array(key), pa.array(around), pa.array(np.array(reps, np.int64)[doc]), pa.array(start), pa.array(count.astype(np.int16))

    tidy(spark)
    suffixes = cut(arrow_map(texts.select("rep", "t"), find, "key long, around long, rep long, start long, count short"), "suffixes")
    n = max(1, -(-suffixes.count() // BUCKET))
    parts = max(n, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sorted_ = cut(_bucketed(suffixes, ["key", "around", "rep", "start"], parts, _compare_suffixes, "kind int, rep long, start long, count short"), "sorted")
    free(suffixes)
    again = sorted_.where("kind = 1").groupBy("rep").agg(F.collect_list(F.struct("start", "count")).alias("at"))

    def strings(reps, ts, ats):
        cols = [[], [], []]
        for rep, t, at in zip(reps, ts, ats, strict=True):
            start = np.concatenate([np.arange(a["start"], a["start"] + a["count"]) for a in at])
            for h, s in _string_hashes(t.encode(), start, length):
                cols[0].append(h.view(np.int64))
                cols[1].append(np.full(len(s), rep, np.int64))
                cols[2].append(s)
        return [pa.array(np.concatenate(c)) if c else [] for c in cols]

    single = cut(arrow_map(texts.select("rep", "t").join(again, "rep"), strings, "h long, rep long, start long"), "strings")
    tidy(spark)
    parts = max(1, -(-single.count() // BUCKET), int(spark.conf.get("spark.sql.shuffle.partitions")))
    compared = cut(_bucketed(single, ["h", "rep", "start"], parts, _compare_strings, "kind int, h long, rep long, start long"), "compared")
    free(single)
    # Across boundaries: a bucket's first string is a repeat if an earlier bucket ends with it. Two rows a bucket.
    heads, tails = compared.where("kind = 1"), compared.where("kind = 2").select("h", F.col("rep").alias("r2"), F.col("start").alias("s2"))
    crossing = heads.join(tails, "h").where("r2 < rep or (r2 = rep and s2 < start)").select("rep", "start").distinct()
    gone = sorted_.where("kind = 0").select("rep", "start", F.col("count").cast("long").alias("count"))
    gone = gone.union(compared.where("kind = 0").select("rep", "start", F.lit(1).cast("long"))).union(crossing.select("rep", "start", F.lit(1).cast("long")))
    spans = gone.groupBy("rep").agg(F.collect_list(F.struct("start", "count")).alias("at"))

    def keep(hs, ids, ts, ats):
        rows = [_kept(t.encode(), at, length) for t, at in zip(ts, ats, strict=True)]
        return hs, ids, *([r[i] for r in rows] for i in range(4 + with_text))

    schema = f"h binary, first_id {texts.schema['first_id'].dataType.simpleString()}, n_removed long, n_spans long, kept_sha256 string, n_kept long" + ", kept_text binary" * with_text
    done = arrow_map(texts.join(spans, "rep", "left").select("h", "first_id", "t", "at"), keep, schema)
    done = cut(done, "done")
    for table in written:
        free(table)
    rows = own.select("id", "_raw", "h", F.octet_length("t").cast("long").alias("n_bytes"), F.when(F.octet_length("t") < length, F.sha2("t", 256)).alias("sha"), *([F.when(F.octet_length("t") < length, F.encode("t", "utf-8")).alias("short")] if with_text else []))
    out = rows.join(done.hint("merge"), "h", "left")
    long, first = F.col("n_bytes") >= length, F.col("id") == F.col("first_id")
    pick = lambda own_, copy, short: F.when(~long, short).when(first, own_).otherwise(copy)
    return out.select(
        F.col("_raw").alias(id_col), "n_bytes", pick(F.col("n_removed"), F.col("n_bytes"), F.lit(0)).cast("long").alias("n_removed"),
        pick(F.col("n_spans"), F.lit(1), F.lit(0)).cast("long").alias("n_spans"), pick(F.col("kept_sha256"), F.lit(hashlib.sha256(b"").hexdigest()), F.col("sha")).alias("kept_sha256"),
        *([pick(F.col("kept_text"), F.lit(b""), F.col("short")).alias("kept_text")] if with_text else []),
    )


def _string_hashes(data: bytes, start: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the strings at these starts, a block of the text at a time."""
    start = np.sort(start)
    for at in range(0, len(data), BLOCK):
        lo, hi = np.searchsorted(start, (at, at + BLOCK))
        if lo < hi:
            s = start[lo:hi]
            h = Hashes(np.frombuffer(data[at : at + BLOCK + length], np.uint8))
            yield h.of(s - at, s - at + length), s


def _kept(data: bytes, at: list | None, length: int) -> tuple:
    mark = np.zeros(len(data) + 1, np.int32)
    for a in at or ():
        mark[a["start"]] += 1
        mark[a["start"] + a["count"] - 1 + length] -= 1
    gone = np.cumsum(mark[:-1]) > 0
    spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
    return int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), len(kept), kept
