"""Token-ID output: best-fit-decreasing packing of token sequences into rows of one length, in binary columns.

Sequences longer than a row are split into whole rows and a rest, losslessly. What is shorter is placed, longest first,
into the row with the least room that still holds it; a segment tree over the possible amounts of room finds that
amount in O(log length). Each task packs its documents in blocks of about ``block_tokens`` tokens, so there is no shuffle, memory
is bounded and a lost task is simply done again; only the last rows of a block may stay part empty. A row has the packed
ids, the cumulative lengths of its segments, positions that start again at 0 with each segment, and where each
segment comes from. Ids and positions are little-endian unsigned integers of 16 bits where all ids fit, else of 32.

Null and empty texts have no tokens and are in no row. Repeated rows are packed each for itself; a null id stays null.
An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import small_batches

LENGTH = 2048
BLOCK_TOKENS = 4_000_000


class RoomTree:
    """The amounts of room, 0 to length, that open bins have; finds the least amount that is enough."""

    def __init__(self, length: int):
        self.size = 1 << max(1, length).bit_length()
        self.tree = np.zeros(2 * self.size, bool)

    def set(self, room: int, there: bool) -> None:
        i = room + self.size
        self.tree[i] = there
        while i > 1:
            i >>= 1
            now = self.tree[2 * i] or self.tree[2 * i + 1]
            if self.tree[i] == now:
                break
            self.tree[i] = now

    def least(self, need: int) -> int | None:
        i = need + self.size
        if self.tree[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.tree[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.tree[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def pack_counts(counts: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing over so many sequences of each length: [(lengths in a row, number of such rows)].

    Rows that look alike are one entry, so a step places as many sequences of a length as there are alike rows.
    """
    tree, by_room = RoomTree(length), defaultdict(dict)

    def add(room: int, pattern: tuple[int, ...], n: int) -> None:
        if not by_room[room]:
            tree.set(room, True)
        by_room[room][pattern] = by_room[room].get(pattern, 0) + n

    for size in sorted((s for s in counts if 0 < s <= length), reverse=True):
        left = counts[size]
        while left:
            room = tree.least(size)
            if room is None:
                each = length // size
                whole, rest = divmod(left, each)
                if whole:
                    add(length - each * size, (size,) * each, whole)
                if rest:
                    add(length - rest * size, (size,) * rest, 1)
                break
            pattern, have = by_room[room].popitem()
            each = room // size
            whole = min(have, left // each)
            if not by_room[room]:
                tree.set(room, False)
            if whole:
                add(room - each * size, pattern + (size,) * each, whole)
                left -= whole * each
            rest = have - whole
            if rest and left and left < each:
                add(room - left * size, pattern + (size,) * left, 1)
                left, rest = 0, rest - 1
            if rest:
                add(room, pattern, rest)
    return sorted((p, n) for patterns in by_room.values() for p, n in patterns.items())


def pack_block(ids: list, sequences: list[np.ndarray], length: int, pad_id: int, kind: np.dtype) -> list[tuple]:
    """[(n_tokens, ids, segment ends, positions, document ids, offsets)] of the rows that hold the sequences."""
    by_size: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for d, s in enumerate(sequences):
        for at in range(0, len(s), length):
            by_size[min(length, len(s) - at)].append((d, at))
    for parts in by_size.values():
        parts.reverse()
    rows = []
    for pattern, many in pack_counts({n: len(p) for n, p in by_size.items()}, length):
        ends = np.cumsum(pattern)
        positions = np.zeros(length, kind)
        for end, size in zip(ends, pattern, strict=True):
            positions[end - size : end] = np.arange(size)
        positions = positions.tobytes()
        for _ in range(many):
            packed, places = np.full(length, pad_id, kind), [by_size[size].pop() for size in pattern]
            for (d, at), end, size in zip(places, ends, pattern, strict=True):
                packed[end - size : end] = sequences[d][at : at + size]
            rows.append((int(ends[-1]), packed.tobytes(), ends.tolist(), positions, [ids[d] for d, _ in places], [at for _, at in places]))
    return rows


def pack(tokens: DataFrame, *, id_col: str = "doc_id", ids_col: str = "token_ids", length: int = LENGTH, pad_id: int = 0, vocabulary: int = 1 << 16, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Rows (row, n_tokens, token_ids, segment_ends, positions, doc_ids, doc_offsets); ids and positions are padded to length."""
    small_batches(tokens.sparkSession)
    kind = np.dtype("<u2" if max(vocabulary, length) <= 1 << 16 else "<u4")
    id_type = tokens.select(id_col).schema[0].dataType
    fields = [("row", pa.int64()), ("n_tokens", pa.int32()), ("token_ids", pa.binary()), ("segment_ends", pa.list_(pa.int32())), ("positions", pa.binary()), ("doc_ids", pa.list_(to_arrow_type(id_type))), ("doc_offsets", pa.list_(pa.int32()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, ids, sequences = TaskContext.get().partitionId() << 33, 0, [], []

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal base
            rows = pack_block(ids, sequences, length, pad_id, kind)
            for at in range(0, len(rows), 256):
                some = rows[at : at + 256]
                yield pa.RecordBatch.from_arrays([pa.array(range(base + at, base + at + len(some)), pa.int64()), *(pa.array(c, t) for c, (_, t) in zip(zip(*some, strict=True), fields[1:], strict=True))], schema=pa.schema(fields))
            base += len(rows)

        for batch in batches:
            values, ends = batch.column(1).values.to_numpy(zero_copy_only=False), batch.column(1).offsets.to_numpy()
            for i, d in enumerate(batch.column(0).to_pylist()):
                if ends[i + 1] > ends[i]:
                    ids.append(d)
                    sequences.append(values[ends[i] : ends[i + 1]].astype(kind))
                    held += ends[i + 1] - ends[i]
            if held >= block_tokens:
                yield from packed()
                held, ids, sequences = 0, [], []
        yield from packed()

    schema = f"row long, n_tokens int, token_ids binary, segment_ends array<int>, positions binary, doc_ids array<{id_type.simpleString()}>, doc_offsets array<int>"
    return tokens.select(id_col, F.coalesce(F.col(ids_col), F.array().cast("array<int>"))).mapInArrow(run, schema)


def unpacked(binary: bytes, n_tokens: int, vocabulary: int = 1 << 16, length: int = LENGTH) -> np.ndarray:
    """The ids or positions of a row, without padding."""
    return np.frombuffer(binary, "<u2" if max(vocabulary, length) <= 1 << 16 else "<u4")[:n_tokens]
