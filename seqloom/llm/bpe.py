"""BPE encoding and decoding with the files of a public tokenizer, by tree concatenation for long unsplit text.

White space (ASCII) always ends a pre-token of the vocabulary used here, so a text's encoding is that of its
blank-separated chunks, one after the other; each distinct chunk of a worker is encoded once. A chunk longer than
``LEAF`` characters is pre-tokenized as a whole and a pre-token longer than that is cut in halves, again and again;
where two halves meet, a window around the join is encoded anew and doubled until it agrees with the left half on two
tokens in a row before the join and with the right half on two tokens in a row behind it. Adjacent tokens of a BPE
encoding fix each other, so the spliced sequence is then exactly the encoding of the whole. Texts are encoded in parallel
by tasks; the halves of one text one after the other, as the library's model holds the interpreter's lock.

Null text counts as empty: no ids, empty decoded text. Very long texts are encoded whole, in time linear in their length
but for the joins. Equal texts give equal rows; repeated rows stay. An empty table gives no rows, and other columns, of
any name, don't matter.
"""

from __future__ import annotations

import hashlib
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

LEAF = 4096
#: Entries of a worker's cache, about 200 bytes each, in two generations: what was used since the younger began outlives the older. Workers live on
#: from stage to stage with what they hold.
CACHE_CHUNKS = 200_000
CACHE_CHUNK_CHARS = 64
_CHUNK = re.compile(r"[^ \t\n\r\x0b\x0c]+")
#: Texts of these characters alone are their own NFC form, and their pre-tokens need no table of Unicode classes.
_LATIN = "a-zßà-öø-ÿ"
_PLAIN = re.compile(rf"[\t\n\r !-&(-;=-~{_LATIN}À-ÖØ-Þ]*+")
_PIECE = re.compile(rf"[{_LATIN}]+|[0-9]|[^\t\n\r {_LATIN}0-9]+")
#: Bytes that the vocabulary writes as the letters from 256 on, in this order.
_HIDDEN = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
_PACKED = [struct.Struct(f"<{n}I").pack for n in range(65)]
#: The vocabulary's letters for the bytes of those that aren't ASCII.
_BYTES = {c: "".join(chr(b) for b in chr(c).encode()) for c in range(0xC0, 0x100)}
_BYTES = {c: "".join(chr(256 + _HIDDEN.index(ord(x))) if ord(x) in _HIDDEN else x for x in s) for c, s in _BYTES.items()}
SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class _Cache(dict):
    """Ids of chunks; a pre-token that is missing is made. ``older`` is the generation before, whose entries come over when they are used."""

    def __init__(self, make, older: dict[str, bytes] | None = None):
        self.make, self.older = make, older or {}

    def __missing__(self, p: str) -> bytes:
        out = self.older.get(p)
        if out is None:
            out = self.make(p)
        if len(p) <= CACHE_CHUNK_CHARS:
            self[p] = out
        return out

    def turned(self) -> _Cache:
        """A new generation once this one is full."""
        return self if len(self) <= CACHE_CHUNKS // 2 else _Cache(self.make, dict(self))


class TreeEncoder:
    """Encodes and decodes as the library does with add_special_tokens=False and skip_special_tokens=False."""

    def __init__(self, path: str, leaf: int = LEAF):
        from tokenizers import Tokenizer

        self.tok, self.leaf = Tokenizer.from_file(path), leaf
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model, self.plain = self.tok.model, self.tok.decoder is None
        self.words = self.tok.pre_tokenizer is not None and '"invert":true' in self.tok.to_str().replace(" ", "") and self.plain
        self.cache = _Cache(self._piece)
        self.names: list[str] | None = None
        added = sorted((t.content for t in self.tok.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    # Long unsplit text -----------------------------------------------------------------------------------------
    def _model(self, s: str, start: int, end: int) -> list[tuple[int, int, int]]:
        """(id, start, end) of the model's tokens; offsets count characters of s."""
        at, out = start, []
        for t in self.tok.model.tokenize(s[start:end]):
            n = len(t.value.removesuffix("</w>") if self.plain else t.value)
            out.append((t.id, at, at + n))
            at += n
        return out

    def _tree(self, s: str, start: int, end: int) -> list[tuple[int, int, int]]:
        if end - start <= self.leaf:
            return self._model(s, start, end)
        mid = (start + end) // 2
        return self._join(s, self._tree(s, start, mid), self._tree(s, mid, end), mid, start, end)

    def _join(self, s: str, left: list, right: list, mid: int, start: int, end: int) -> list:
        wide = 8
        while True:
            a, b = max(0, len(left) - wide), min(len(right), wide)
            lo, hi = left[a][1], right[b - 1][2]
            window = self._model(s, lo, hi)
            # The left half's last token and a window's last one were made as if a word ended there.
            at = {t: i for i, t in enumerate(left[a:-1], a)}
            i = next((k for k in range(len(window) - 1) if lo == start or (window[k] in at and window[k + 1] in at and window[k + 1][2] <= mid)), None)
            last = len(window) - (hi != end)
            at_right = {t: j for j, t in enumerate(right[:b])}
            j = len(window) if hi == end else next((k for k in range(last - 2, -1, -1) if window[k] in at_right and window[k + 1] in at_right and window[k][1] >= mid), None)
            if lo == start and i is None:
                i = 0
            if i is not None and j is not None and (lo == start or window[i][1] < mid):
                head = [] if lo == start else left[: at[window[i]]]
                tail = [] if hi == end else right[at_right[window[j]] :]
                return head + window[0 if lo == start else i : j] + tail
            wide *= 2

    def _long(self, chunk: str) -> list[int]:
        ids: list[int] = []
        for part in self.added.split(chunk) if self.added else [chunk]:
            if not part:
                continue
            if self.added and self.added.fullmatch(part):
                ids.append(self.tok.token_to_id(part))
                continue
            text = self.tok.normalizer.normalize_str(part) if self.tok.normalizer else part
            for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(text):
                ids += [t[0] for t in self._tree(piece, 0, len(piece))]
        return ids

    # Whole texts -----------------------------------------------------------------------------------------------
    def _piece(self, p: str) -> bytes:
        """The ids of one pre-token of plain letters or signs, as little-endian 32-bit integers: no need of the stages before the model."""
        ids = [t.id for t in self.model.tokenize(p if p.isascii() else p.translate(_BYTES))] if len(p) <= self.leaf else self._long(p)
        return _PACKED[len(ids)](*ids) if len(ids) < len(_PACKED) else struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, chunks: set[str]) -> None:
        """Puts the chunks' ids into the cache, as little-endian 32-bit integers."""
        short, cache = [], self.cache
        for c in chunks:
            if c in cache.older:
                cache[c] = cache.older[c]
            elif len(c) <= self.leaf and _PLAIN.fullmatch(c):
                cache[c] = b"".join([cache[p] for p in _PIECE.findall(c.lower())])
            elif len(c) <= self.leaf:
                short.append(c)
            else:
                ids = self._long(c)
                cache[c] = struct.pack(f"<{len(ids)}I", *ids)
        for c, e in zip(short, self.tok.encode_batch(short, add_special_tokens=False) if short else (), strict=True):
            cache[c] = struct.pack(f"<{len(e.ids)}I", *e.ids)

    def encode(self, text: str) -> list[int]:
        return list(memoryview(self.encode_batch([text])[0]).cast("I"))

    def decode(self, ids: list[int]) -> str:
        return self.tok.decode(ids, skip_special_tokens=False)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian 32-bit integers."""
        if not self.words:
            return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.tok.encode_batch(texts, add_special_tokens=False)]
        out, self.cache = [b""] * len(texts), self.cache.turned()
        other = {i: _CHUNK.findall(t) for i, t in enumerate(texts) if not _PLAIN.fullmatch(t)}
        if other:
            new = set().union(*other.values()).difference(self.cache)
            self._learn(new)
            for i, chunks in other.items():
                out[i] = b"".join(map(self.cache.__getitem__, chunks))
            for c in new:
                if len(c) > CACHE_CHUNK_CHARS:
                    self.cache.pop(c, None)
        for i, t in enumerate(texts):
            if i not in other:
                self.cache = self.cache.turned()
                out[i] = b"".join(map(self.cache.__getitem__, _PIECE.findall(t.lower())))
        return out

    def decode_batch(self, ids: list[bytes]) -> list[str]:
        """The texts of ids given as little-endian 32-bit integers."""
        if not self.plain:
            return [self.decode(list(memoryview(b).cast("I"))) for b in ids]
        if self.names is None:
            self.names = [self.tok.id_to_token(i) or "" for i in range(self.tok.get_vocab_size(with_added_tokens=True))]
        name = self.names.__getitem__
        return [" ".join(map(name, memoryview(b).cast("I"))) for b in ids]


_encoders: dict[tuple[str, int], TreeEncoder] = {}


def encoder(path: str, leaf: int = LEAF) -> TreeEncoder:
    """One encoder for each file and worker process."""
    if (path, leaf) not in _encoders:
        _encoders[path, leaf] = TreeEncoder(path, leaf)
    return _encoders[path, leaf]


def encode_digests(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """Per row: its id, the number of tokens, and the digests of its ids and of its decoded text. No shuffle."""

    def f(ids, texts):
        e = encoder(tokenizer, leaf)
        made = e.encode_batch([t or "" for t in texts])
        return ids, [len(b) // 4 for b in made], [hashlib.sha256(b).hexdigest() for b in made], [hashlib.sha256(d.encode()).hexdigest() for d in e.decode_batch(made)]

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col), F.col(text_col).cast("string")), f, f"`{id_col}` {kind}, {SCHEMA}")


def encode_ids(docs: DataFrame, tokenizer: str, *, text_col: str = "text", out_col: str = "token_ids", carry: tuple[str, ...] = ("doc_id",), leaf: int = LEAF) -> DataFrame:
    """The carried columns of each row and its token ids as an array."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema)

    def f(*columns):
        made = encoder(tokenizer, leaf).encode_batch([t or "" for t in columns[-1]])
        ends = np.cumsum([0, *(len(b) // 4 for b in made)])
        return *columns[:-1], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(made), "<i4")))

    return arrow_map(docs.select(*carry, F.col(text_col).cast("string")), f, f"{kinds}, `{out_col}` array<int>")
