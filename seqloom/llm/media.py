"""Media columns: lossless PNG in binary columns, with its own writer and reader, and perceptual hashes of the pixels.

A text's UTF-8 bytes, padded with blanks to a positive multiple of 192, are the samples of an 8-bit grey image 192
wide. The writer filters each row with the predictor whose residuals are smallest and deflates the rows in chunks; the
reader tests every chunk's checksum, inflates, and undoes all five filters with numpy. The feature is the sign pattern
of the lowest 8 x 8 cosine-transform coefficients of the image shrunk to 32 x 32, as 16 hex digits.

Null text counts as empty and gives one row of blanks. Equal texts give equal values. A damaged image raises ValueError.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, small_batches

WIDTH = 192
CHUNK = 1 << 16
LEVEL = 1
SIGNATURE = b"\x89PNG\r\n\x1a\n"
COLUMNS = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
_SMALL, _LOW = 32, 8
_k = np.arange(_LOW)[:, None]
DCT = np.sqrt(np.where(_k == 0, 1, 2) / _SMALL) * np.cos(np.pi * _k * (2 * np.arange(_SMALL) + 1) / (2 * _SMALL))


def payload(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode()
    return raw + b" " * (max(WIDTH, -(-len(raw) // WIDTH) * WIDTH) - len(raw)), len(raw)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def write_png(samples: bytes, width: int = WIDTH) -> bytes:
    x = np.frombuffer(samples, np.uint8).reshape(-1, width)
    sub, up = x.copy(), x.copy()
    sub[:, 1:] -= x[:, :-1]
    up[1:] -= x[:-1]
    cost = np.stack([np.abs(f.view(np.int8).astype(np.int16)).sum(1) for f in (x, sub, up)])
    kind = cost.argmin(0).astype(np.uint8)
    rows = np.empty((len(x), width + 1), np.uint8)
    rows[:, 0] = kind
    rows[:, 1:] = np.choose(kind[:, None], (x, sub, up))
    body = zlib.compress(rows.tobytes(), LEVEL)
    parts = [_chunk(b"IDAT", body[i : i + CHUNK]) for i in range(0, len(body), CHUNK)]
    return b"".join([SIGNATURE, _chunk(b"IHDR", struct.pack(">IIBBBBB", width, len(x), 8, 0, 0, 0, 0)), *parts, _chunk(b"IEND", b"")])


def read_png(data: bytes) -> np.ndarray:
    """Rows of samples (height, width x channels) of an 8-bit, non-interlaced image."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, body, head, ended = 8, [], None, False
    while at < len(data) and not ended:
        if at + 12 > len(data):
            raise ValueError("a chunk is cut off")
        (n,), kind = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        part, check = data[at + 8 : at + 8 + n], data[at + 8 + n : at + 12 + n]
        if len(check) != 4 or struct.unpack(">I", check)[0] != zlib.crc32(part, zlib.crc32(kind)):
            raise ValueError(f"checksum of chunk {kind!r}")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body.append(part)
        ended = kind == b"IEND"
        at += 12 + n
    if not ended or head is None:
        raise ValueError("no header or no end")
    width, height, depth, colour, _, _, interlaced = head
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}.get(colour, 0)
    if depth != 8 or interlaced or not channels:
        raise ValueError("only 8-bit images that aren't interlaced")
    try:
        raw = zlib.decompress(b"".join(body))
    except zlib.error as e:
        raise ValueError(str(e)) from e
    if len(raw) != height * (width * channels + 1):
        raise ValueError("wrong number of samples")
    rows = np.frombuffer(raw, np.uint8).reshape(height, width * channels + 1)
    return unfilter(rows[:, 0], rows[:, 1:], channels)


def unfilter(kinds: np.ndarray, rows: np.ndarray, bpp: int) -> np.ndarray:
    out = rows.copy()
    if kinds.size and kinds.max() > 4:
        raise ValueError("unknown filter")
    by_row = np.flatnonzero(kinds == 1)
    if by_row.size:
        out[by_row] = np.cumsum(out[by_row].reshape(by_row.size, -1, bpp), axis=1, dtype=np.uint8).reshape(by_row.size, -1)
    # A run of rows of the kind Up is a running sum down its columns; the other two go row by row.
    edges = np.flatnonzero(np.diff(kinds)) + 1
    for lo, hi in zip([0, *edges], [*edges, len(kinds)], strict=True):
        if lo == hi or kinds[lo] < 2:
            continue
        if kinds[lo] == 2:
            if lo:
                out[lo] += out[lo - 1]
            out[lo:hi] = np.cumsum(out[lo:hi], axis=0, dtype=np.uint8)
            continue
        for r in range(lo, hi):
            above = out[r - 1].astype(np.int32) if r else np.zeros(out.shape[1], np.int32)
            line = out[r].astype(np.int32)
            for i in range(line.size):
                a, b, c = (line[i - bpp] if i >= bpp else 0), above[i], (above[i - bpp] if i >= bpp else 0)
                line[i] = (line[i] + ((a + b) // 2 if kinds[r] == 3 else _paeth(a, b, c))) & 255
            out[r] = line.astype(np.uint8)
    return out


def _paeth(a: int, b: int, c: int) -> int:
    pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
    return a if pa <= pb and pa <= pc else b if pb <= pc else c


def cosine_hash(pixels: np.ndarray) -> str:
    """16 hex digits: which of the lowest 64 coefficients (the mean's own aside) lie over their median."""
    small = _shrink(_shrink(pixels.astype(np.float64), 0), 1)
    low = np.round(DCT @ small @ DCT.T, 6).ravel()
    bits = low > np.median(low[1:])
    return np.packbits(bits).tobytes().hex()


def _shrink(x: np.ndarray, axis: int) -> np.ndarray:
    """To 32 along the axis: means of equal stretches, or the nearest rows where there are fewer."""
    n = x.shape[axis]
    if n < _SMALL:
        return np.take(x, np.arange(_SMALL) * n // _SMALL, axis)
    at = np.arange(_SMALL + 1) * n // _SMALL
    shape = [1, 1]
    shape[axis] = -1
    return np.add.reduceat(x, at[:-1], axis) / np.diff(at).reshape(shape)


def media_row(text: str | None) -> tuple:
    data, n = payload(text)
    stored = write_png(data)
    pixels = read_png(stored)
    back = pixels.tobytes()
    return n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), cosine_hash(pixels)


def media_features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id and what was read back from the stored image. No shuffle."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def f(ids, texts):
        return ids, *(list(c) for c in zip(*map(media_row, texts), strict=True))

    return arrow_map(docs.select(id_col, F.col(text_col).cast("string")), f, f"`{id_col}` {kind}, {COLUMNS}")


def with_images(docs: DataFrame, *, text_col: str = "text", out_col: str = "media") -> DataFrame:
    """The rows with the image of their text as a binary column; out_col replaces a column of that name."""
    from pyspark.sql.functions import pandas_udf

    small_batches(docs.sparkSession)

    @pandas_udf("binary")
    def images(texts):
        return texts.map(lambda t: write_png(payload(t)[0]))

    return docs.withColumn(out_col, images(F.col(text_col).cast("string")))
