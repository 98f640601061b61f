"""Benchmark decontamination by template canonicalisation.

Words lose punctuation and case; numbers, units behind a number, and names (capitalised words inside a sentence) become
typed placeholders, so that a question asked with other numbers or names has the same template. Each five tokens in a
row are a window; windows with fewer than three plain words say too little and are left out. Names are known by their
capitals only, so items and texts have a second set of windows, in which names are plain words, for copies in another
case; either set may match. An item is found in a text that has 0.8 or more of the item's distinct windows, or
``passage`` windows in a row of it (a passage of an item), if its slots are consistent: each value in the item goes with
one value in the text, in 0.8 or more of the aligned slots. Every place of the text that could be a copy is aligned for
itself, and the one whose slots agree best counts, so neither earlier nor later look-alikes hide a copy.

An item without a window (of fewer than five tokens, or of little but slots) is found by its wording: hashes of its
first tokens, five at most, find places in a text, where all its words, numbers and signs must follow, whatever the case
and the punctuation. The result counts such an item as one window.

Windows of texts and items meet in a hash join. A benchmark of up to ``max_windows`` windows (by a count of its
characters) is broadcast as one hash table. A larger one never reaches the driver: its windows are a table that the
texts' windows are joined with by a shuffle, and the pairs found are verified on their whole texts. Only an item's rarest windows
take part, as many as any text with enough of its windows must have one of, so wording that all items share pairs nothing.

Null and empty texts and items, and items of one or two tokens, match nothing; an item with a null id is matched and
reported as null. Very long texts are taken whole. Repeated rows are matched each for itself, repeated items once. An
empty table gives no rows. A column of the result that has the id column's name gets "_found" added. The result's order
of rows is not defined.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import islice

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, cut, small_batches, unused

WINDOW = 5
LEAST_WORDS = 3
#: Tokens of an item found by its wording; fewer say too little.
LEAST_TOKENS = 3
SHARE = 0.8
PASSAGE = 25
#: Windows of a benchmark that is broadcast, about 300 bytes each in a worker.
MAX_WINDOWS = 200_000
#: Distinct words that a worker remembers; workers live on from stage to stage with what they hold.
WORDS = 200_000
COLUMNS = {"n_matched": "int", "n_windows": "int", "coverage": "double", "n_slots": "int", "slot_agreement": "double"}

# Units of measure that may stand behind a number.
UNITS = frozenset("mm cm m km in ft mi mile miles inch inches foot feet yard yards meter meters metre metres kilometer kilometers kilometre kilometres mg g kg gram grams kilogram kilograms ton tons tonne tonnes lb lbs pound pounds oz ounce ounces ml cl l liter liters litre litres gallon gallons cup cups s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years dollar dollars cent cents euro euros usd eur gbp percent degree degrees mph kmh kph w kw kwh watt watts volt volts hz khz mhz ghz kb mb gb tb".split())
NUM, UNIT, NAME = (xxhash.xxh64_intdigest(x) for x in ("<num>", "<unit>", "<name>"))
_PUNCTUATION = ".,;:!?\"'`()[]{}…“”‘’«»"
_CORE = re.compile(r"^\W+|\W+$")
_NUMBER = re.compile(r"\d[\d.,:/]*(?:%|st|nd|rd|th)?$")
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_IS_NUM, _IS_UNIT, _IS_NAME, _ENDS, _NONE = 1, 2, 4, 8, 16


class _Words(dict):
    """word -> (hash, flags), made once for each distinct word."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) > WORDS:
            self.clear()
        core = _CORE.sub("", word)
        flags = _ENDS if re.search(r"[.!?:]\W*$", word) else 0
        if not core:
            out = (0, flags | _NONE)
        elif _NUMBER.match(core):
            out = (NUM, flags | _IS_NUM)
        else:
            low = core.lower()
            named = core[0].isupper() and core[1:2].islower()
            out = (xxhash.xxh64_intdigest(low), flags | (_IS_UNIT if low in UNITS else 0) | (_IS_NAME if named else 0))
        self[word] = out
        return out


_words = _Words()


def _runs(token: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each k tokens in a row."""
    n = max(0, len(token) - k + 1)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = (h ^ (token[i : i + n] * _MULT[i])) * _MULT[(i + 1) % WINDOW]
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _same(doc: np.ndarray, k: int) -> np.ndarray:
    """Whether each k tokens in a row are of one text."""
    n = max(0, len(doc) - k + 1)
    return doc[:n] == doc[k - 1 : k - 1 + n]


def templates(doc: np.ndarray, token: np.ndarray, slot: np.ndarray, at: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text number, window hash, position of its first word, in which set: 1 with placeholders of names, 2 with names as plain words, 3 in both) of all windows of tokens()."""
    h, same, n = _runs(token, WINDOW), _same(doc, WINDOW), max(0, len(doc) - WINDOW + 1)
    plain, names = np.zeros(n, np.int8), np.zeros(n, np.int8)
    for k in range(WINDOW):
        plain += slot[k : k + n] == 0
        names += slot[k : k + n] == 3
    first = np.flatnonzero(same & (plain >= LEAST_WORDS))
    named = np.flatnonzero(same & (names > 0) & (plain + names >= LEAST_WORDS))
    lower = _runs(np.where(slot == 3, word, token), WINDOW)[named] if len(named) else np.zeros(0, np.int64)
    order = np.argsort(np.concatenate([first, named]), kind="stable")
    where = np.concatenate([first, named])[order]
    kind = np.concatenate([np.where(names[first] > 0, 1, 3), np.full(len(named), 2)]).astype(np.int8)[order]
    return doc[where], np.concatenate([h[first], lower])[order], at[where], kind


def _exact(word: str) -> str:
    return word.lower().strip(_PUNCTUATION)


def tokens(texts: list[str]) -> tuple[np.ndarray, ...]:
    """(text number, hash, 0 for a plain word or the kind of slot, number of the word in its text, hash if units and names were plain words) of all tokens."""
    split = [t.split() for t in texts]
    sizes = np.array([len(s) for s in split], np.int64)
    flat = [_words[w] for s in split for w in s]
    if not flat:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    token = np.fromiter((x[0] for x in flat), np.uint64, len(flat))
    flags = np.fromiter((x[1] for x in flat), np.int8, len(flat))
    doc = np.repeat(np.arange(len(texts)), sizes)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.arange(len(flat)) - first
    ended = np.ones(len(flat), bool)
    ended[1:] = (flags[:-1] & _ENDS) > 0
    ended[at == 0] = True
    there = (flags & _NONE) == 0
    # A sentence's end may stand in a token of its own.
    doc, token, flags, at, ended = doc[there], token[there], flags[there], at[there], ended[there]
    number = (flags & _IS_NUM) > 0
    behind = np.zeros(len(token), bool)
    behind[1:] = number[:-1] & (doc[1:] == doc[:-1])
    unit = ((flags & _IS_UNIT) > 0) & behind
    name = ((flags & _IS_NAME) > 0) & ~ended
    word = token
    token = np.where(unit, np.uint64(UNIT), np.where(name, np.uint64(NAME), token))
    slot = np.where(number, 1, np.where(unit, 2, np.where(name, 3, 0))).astype(np.int8)
    return doc, token, slot, at, word


class Index:
    """The distinct windows of some items, and the wording of items without windows."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.words = [t.split() for _, t in items]
        owner, token, slot, place, word = tokens([t for _, t in items])
        doc, h, at, kinds = templates(owner, token, slot, place, word)
        #: hash -> (item, set) -> positions
        where: dict[int, dict[tuple[int, int], list[int]]] = defaultdict(lambda: defaultdict(list))
        seen = set()
        for d, x, a, kind in zip(doc.tolist(), h.tolist(), at.tolist(), kinds.tolist(), strict=True):
            for one in (1, 2):
                if kind & one:
                    seen.add((d, one, x))
                    where[x][d, one].append(a)
        self.total = Counter((d, one) for d, one, _ in seen)
        self.where = {x: list(w.items()) for x, w in where.items()}
        self.keys = np.array(sorted(where), np.int64)

        #: item -> its words, its numbers; number of tokens hashed -> hash -> items
        self.wording: dict[int, tuple[list[str], int]] = {}
        self.starts: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for d in sorted(set(owner.tolist()) - {d for d, _ in self.total}):
            of = np.flatnonzero(owner == d)
            if len(of) < LEAST_TOKENS:
                continue
            words = [x for w in self.words[d][place[of[0]] : place[of[-1]] + 1] if (x := _exact(w))]
            self.wording[d] = words, int((slot[of] == 1).sum())
            k = min(len(of), WINDOW)
            self.starts[k][int(_runs(word[of[:k]], k)[0])].append(d)
        self.starts = {k: dict(x) for k, x in self.starts.items()}

    def find(self, texts: list[str]) -> list[tuple]:
        """(text number, item, matched, windows, coverage, slots, agreement) of each item found in each text."""
        doc, token, slot, at, word = tokens(texts)
        return self._by_windows(texts, *templates(doc, token, slot, at, word)) + self._by_wording(texts, doc, at, word)

    def _by_wording(self, texts: list[str], doc: np.ndarray, at: np.ndarray, word: np.ndarray) -> list[tuple]:
        out, last, words = {}, -1, []
        for k, items in self.starts.items():
            h = _runs(word, k)
            for p in np.flatnonzero(np.isin(h, np.fromiter(items, np.int64, len(items))) & _same(doc, k)).tolist():
                d = int(doc[p])
                for item in items[int(h[p])]:
                    want, numbers = self.wording[item]
                    if (d, item) in out:
                        continue
                    if d != last:
                        last, words = d, texts[d].split()
                    if list(islice(filter(None, map(_exact, islice(words, int(at[p]), None))), len(want))) == want:
                        out[d, item] = (d, self.ids[item], 1, 1, 1.0, numbers, 1.0)
        return list(out.values())

    def _by_windows(self, texts: list[str], doc: np.ndarray, h: np.ndarray, at: np.ndarray, kinds: np.ndarray) -> list[tuple]:
        if not len(self.keys) or not len(h):
            return []
        place = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[place] == h)
        out = []
        edges = np.flatnonzero(np.diff(doc[hit])) + 1
        for part in np.split(hit, edges):
            if len(part):
                out += self._of_text(int(doc[part[0]]), texts, h[part].tolist(), at[part].tolist(), kinds[part].tolist())
        return out

    def _of_text(self, d: int, texts: list[str], hs: list[int], at: list[int], kinds: list[int]) -> list[tuple]:
        #: (item, set) -> window -> its places in the item, its places in the text, in order
        places: dict[tuple[int, int], dict[int, tuple[list[int], list[int]]]] = defaultdict(dict)
        for x, a, kind in zip(hs, at, kinds, strict=True):
            for (item, one), own in self.where[x]:
                if kind & one:
                    places[item, one].setdefault(x, (own, []))[1].append(a)
        out, words, done = [], None, set()
        for item, one in sorted(places):
            found = list(places[item, one].values())
            share = len(found) / self.total[item, one]
            if item in done or share < SHARE and len(found) < PASSAGE:
                continue
            words = texts[d].split() if words is None else words
            best = None
            for pairs in _alignments(found):
                if share < SHARE and _longest(pairs) < PASSAGE:
                    continue
                slots = self._slots(item, pairs, words)
                agree = sum(c.most_common(1)[0][1] for c in slots.values())
                n = sum(sum(c.values()) for c in slots.values())
                if best is None or agree * best[1] > best[0] * n or not n:
                    best = (agree, n) if n else (1, 1)
                    told = n
                if best[0] == best[1]:
                    break
            if best and best[0] >= SHARE * best[1]:
                done.add(item)
                out.append((d, self.ids[item], len(found), self.total[item, one], round(share, 6), told, round(best[0] / best[1], 6)))
        return out

    def _slots(self, item: int, pairs: list[tuple[int, int]], words: list[str]) -> dict[str, Counter]:
        """For each value of a slot in the item, the text's values at the places aligned with it."""
        own, values, seen = self.words[item], defaultdict(Counter), set()
        for b, a in pairs:
            for k in range(WINDOW):
                if b + k < len(own) and a + k < len(words) and (b + k, a + k) not in seen:
                    seen.add((b + k, a + k))
                    x, y = _CORE.sub("", own[b + k]), _CORE.sub("", words[a + k])
                    if x and (_NUMBER.match(x) or (b + k and x[0].isupper() and x[1:2].islower() and x.lower() != y.lower())):
                        values[x][y] += 1
        return values


def _alignments(found: list[tuple[list[int], list[int]]]):
    """Ways of laying an item along a text: for each offset between them that a window shows, each of the item's places with the text's place nearest to that offset; offsets that most windows show first."""
    offsets = Counter(a - own[0] for own, there in found for a in there)
    for offset, _ in sorted(offsets.items(), key=lambda x: (-x[1], x[0])):
        pairs = []
        for own, there in found:
            for b in own:
                k = bisect_left(there, b + offset)
                near = there[max(0, k - 1) : k + 1]
                pairs.append((b, min(near, key=lambda a: abs(a - b - offset))))
        yield pairs


def _longest(pairs: list[tuple[int, int]]) -> int:
    """Most windows in a row at one offset between item and text."""
    best = run = 0
    last = None
    for b, a in sorted(pairs, key=lambda p: (p[1] - p[0], p[0])):
        run = run + 1 if last and a - b == last[1] - last[0] and b - last[0] <= 2 else 1
        best, last = max(best, run), (b, a)
    return best


def window_hashes(texts: list[str], starts: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct windows of both sets of each text, and of each ``starts`` words in a row."""
    owner, token, slot, at, word = tokens(texts)
    doc, h, _, _ = templates(owner, token, slot, at, word)
    docs, hashes = [doc], [h]
    for k in starts:
        there = _same(owner, k)
        docs.append(owner[: len(there)][there])
        hashes.append(_start(_runs(word, k)[there], k))
    both = np.unique(np.stack([np.concatenate(docs).astype(np.int64), np.concatenate(hashes)]), axis=1)
    return both[0], both[1]


def _start(h: np.ndarray, k: int) -> np.ndarray:
    return h ^ np.int64(k + 1)


def _name(column: str, id_col: str) -> str:
    return f"{column}_found" if column.lower() == id_col.lower() else column


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Distinct (i, t)."""
    return benchmark.select(F.col(item_col).alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).where("trim(t) <> ''").dropDuplicates()


def _index(items: DataFrame, max_windows: int):
    """The items' broadcast index, or None if they have over max_windows windows: a text has at most one for two characters."""
    if items.agg(F.coalesce(F.sum(F.length("t") / 2 + 1), F.lit(0)).cast("long")).first()[0] > max_windows:
        return None
    return items.sparkSession.sparkContext.broadcast(Index([tuple(r) for r in items.collect()]))


def _address(text):
    return F.substring(F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)), 1, 16)


def find_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Rows (id, item_id, n_matched, n_windows, coverage, n_slots, slot_agreement) for each item found in each text."""
    kind, item_kind = (df.select(c).schema[0].dataType.simpleString() for df, c in ((docs, id_col), (benchmark, item_col)))
    columns = {_name("item_id", id_col): item_kind} | {_name(c, id_col): t for c, t in COLUMNS.items()}
    items = _items(benchmark, item_col, item_text_col)
    index = _index(items, max_windows)
    if index is not None:
        schema = f"`{id_col}` {kind}, " + ", ".join(f"{c} {t}" for c, t in columns.items())
        return arrow_map(docs.select(id_col, F.col(text_col).cast("string")), _matcher(index), schema)
    found = _joined(docs, items, text_col, item_kind)
    rows = docs.select(F.col(id_col).alias("id"), _address(F.col(text_col)).alias("h"))
    return rows.join(found, "h").select(F.col("id").alias(id_col), *[F.col(c).alias(n) for c, n in zip(["item", *COLUMNS], columns, strict=True)])


def _matcher(index):
    def f(ids, texts):
        found = index.value.find([t or "" for t in texts])
        return [ids[x[0]] for x in found], *([x[k] for x in found] for k in range(1, 7))

    return f


def _joined(docs: DataFrame, items: DataFrame, text_col: str, item_kind: str) -> DataFrame:
    """(h, item, figures) of each text and item that match, h a text's address: windows are joined by a shuffle, pairs then verified."""
    items = cut(items.withColumn("k", F.substring(F.unhex(F.sha2(F.concat(F.coalesce(F.col("i").cast("string"), F.lit("")), F.lit("\0"), F.col("i").isNull().cast("string"), F.lit("\0"), "t"), 256)), 1, 16)), "items")

    def item_windows(keys, texts):
        rows = []
        for key, text in zip(keys, texts, strict=True):
            one = Index([(0, text)])
            rows += [(key, s, x, one.total[0, s]) for x, w in one.where.items() for (_, s), _ in w]
            rows += [(key, 0, int(_start(np.int64(x), n)), n) for n, starts in one.starts.items() for x in starts]
        return tuple(map(list, zip(*rows, strict=True))) if rows else ([], [], [], [])

    windows = cut(arrow_map(items.select("k", "t"), item_windows, "k binary, s int, w long, total int"), "windows")
    starts = tuple(sorted(r.total for r in windows.where("s = 0").select("total").distinct().collect()))  # three at most
    # A text with enough windows of an item has one of its (total - enough + 1) rarest at least.
    enough = F.when(F.col("s") == 0, F.col("total")).otherwise(F.least(F.ceil(F.lit(SHARE) * F.col("total") - 1e-9), F.lit(PASSAGE)))
    often = windows.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("k", "s").orderBy("n", "w"))
    rare = windows.join(often, "w").withColumn("r", rank).where(F.col("r") <= F.when(F.col("s") == 0, 1).otherwise(F.col("total") - enough + 1)).select("w", "k").distinct()
    texts = docs.select(_address(F.col(text_col)).alias("h"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).where("trim(t) <> ''")

    def text_windows(addresses, texts):
        doc, w = window_hashes(texts, starts)
        return [addresses[d] for d in doc.tolist()], w

    own = arrow_map(texts, text_windows, "h binary, w long")
    pairs = own.join(rare, "w").select("h", "k").distinct()
    alone = texts.groupBy("h").agg(F.first("t").alias("t"))
    seen: dict[bytes, Index] = {}

    def verify(addresses, texts, keys, names, bodies):
        out = [[] for _ in range(7)]
        for h, t, k, i, body in zip(addresses, texts, keys, names, bodies, strict=True):
            if k not in seen:
                if len(seen) >= 1000:
                    seen.clear()
                seen[k] = Index([(0, body)])
            for x in seen[k].find([t]):
                for column, value in zip(out, (h, i, *x[2:]), strict=True):
                    column.append(value)
        return out

    both = pairs.join(items.select("k", "i", F.col("t").alias("body")), "k").join(alone, "h").select("h", "t", "k", "i", "body")
    return arrow_map(both, verify, f"h binary, item {item_kind}, " + ", ".join(f"{c} {t}" for c, t in COLUMNS.items()))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The rows of docs in whose text no item is found, all columns kept. No shuffle for a benchmark of up to max_windows windows."""
    small_batches(docs.sparkSession)
    items = _items(benchmark, item_col, item_text_col)
    index = _index(items, max_windows)
    if index is not None:
        return docs.where(_clean(index)(F.col(text_col).cast("string")))
    found = _joined(docs, items, text_col, benchmark.select(item_col).schema[0].dataType.simpleString())
    name = unused(docs, "address")
    return docs.withColumn(name, _address(F.col(text_col))).join(found.select(F.col("h").alias(name)).distinct(), name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def _clean(index):
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("boolean")
    def clean(texts):
        import pandas as pd

        dirty = {x[0] for x in index.value.find([t or "" for t in texts])}
        return pd.Series([i not in dirty for i in range(len(texts))], dtype=bool)

    return clean
