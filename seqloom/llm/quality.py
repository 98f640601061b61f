"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

A document classifier gives each text a probability of being worth keeping: a logistic model on counts of its
characters, words, repetitions and lines, times one minus a logistic model on the words that labelled toxic texts have
far more often than chance. It is fitted on at most ``max_labelled`` labelled rows (those with the smallest hash of
their id). Then all documents count: grouped sums per path give each host's and path's rate, the strength of the
shrinkage is fitted from their spread, and sparse sites are drawn towards their host and the global rate. A document's
posterior log-odds are its own plus what its path's rate adds to the global one; it is rejected under 0.5.

Null and empty texts have no evidence of quality (all counts 0) and are rejected; null hosts and paths form a site of
their own. Very long texts are scored whole; equal texts of one site get equal scores. Columns may have any name. With no usable labels the seed words and the counts' prior weights decide alone. Repeated rows and
repeated ids are scored each for itself. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, small_batches, unused

MAX_LABELLED = 20_000
#: Sites up to this many go to every executor; more are joined by a shuffle.
BROADCAST_SITES = 50_000
WIDTH = 9
MAX_LEXICON = 400
#: Lengths of the stems that stand for words no label has shown.
STEMS = (4, 5, 6)
# Insults that count as toxic before any label is seen.
SEED_WORDS = ("idiot", "idiots", "moron", "morons", "pathetic", "worthless", "scum", "imbecile", "retard", "bastard", "asshole", "bitch")
_WORD = re.compile(r"[^\W\d_]+")


def counts(text: str | None) -> list[float]:
    """The numeric features: shares of symbols, capitals, digits and bars, and how much is said twice."""
    t = text or ""
    raw = np.frombuffer(t.encode(), np.uint8)
    if not raw.size:
        return [0.0] * WIDTH
    b = np.bincount(raw, minlength=256)
    upper, lower, digit, blank = int(b[65:91].sum()), int(b[97:123].sum()) + int(b[0xC0:].sum()), int(b[48:58].sum()), int(b[9:14].sum() + b[32])
    words = t.split()
    n, letters = max(1, len(words)), max(1, upper + lower)
    symbols = int(b[33:128].sum()) - upper - int(b[97:123].sum()) - digit
    lines = [x for x in t.split("\n") if x]
    same = sum(map(str.__eq__, words, words[1:]))
    distinct = len(set(words))
    return [
        symbols / max(1, raw.size - blank), upper / letters, digit / raw.size, (int(b[124]) + int(b[35])) / n,
        1 - distinct / n, same / n, 1 - len(set(lines)) / max(1, len(lines)), math.log1p(n), len(set(zip(words, words[1:]))) / n,
    ]


def traits(lowered: str) -> set[str]:
    """A text's words, and the stems (the first 4, 5 or 6 letters and a dash) of those that are longer."""
    words = set(_WORD.findall(lowered))
    return words.union(*({w[:n] + "-" for w in words if len(w) > n} for n in STEMS))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights with the intercept first, means, scales) by Newton's method on standardised columns."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w, pull = np.zeros(z.shape[1]), np.diag([1e-6, *[ridge] * x.shape[1]])
    for _ in range(40):
        p = _sigmoid(z @ w)
        step = np.linalg.solve(z.T * (p * (1 - p) + 1e-9) @ z + pull, z.T @ (y - p) - pull @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


@dataclass
class Model:
    quality: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    words: dict[str, float] = field(default_factory=lambda: dict.fromkeys(SEED_WORDS, 6.0))
    toxic_bias: float = -4.0

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        """Log-odds of keeping each text."""
        if not texts:
            return np.zeros(0)
        x = _widened(np.array([counts(t) for t in texts]))
        if self.quality:
            w, mean, scale = self.quality
            good = _sigmoid(w[0] + ((x - mean) / scale) @ w[1:])
        else:
            good = _sigmoid(4 - 25 * x[:, 0] - 8 * np.maximum(0, x[:, 1] - 0.3) - 10 * x[:, 5])
        get = self.words.get
        toxic = _sigmoid(np.array([self.toxic_bias + sum([get(w, 0.0) for w in traits((t or "").lower())]) for t in texts]))
        p = np.clip(good * (1 - toxic), 1e-6, 1 - 1e-6)
        p[[not (t or "").strip() for t in texts]] = 1e-6
        return np.log(p / (1 - p))


def _widened(x: np.ndarray) -> np.ndarray:
    """With square roots of the shares, so that a little of something rare tells more than its amount."""
    return np.hstack([x, np.sqrt(np.maximum(0, x[:, :7]))])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> Model:
    """The classifier from a bounded sample of labelled rows; whole texts of the sample are used."""
    model = Model()
    some = labels.select(F.col(id_col).alias("id"), F.col("quality").cast("int").alias("q"), F.col("toxic").cast("int").alias("t")).dropna().orderBy(F.xxhash64("id"), "id", "q", "t").limit(max_labelled)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(some), "id")

    def f(qs, ts, texts):
        return qs, ts, [counts(x) for x in texts], [sorted(traits((x or "").lower())) for x in texts]

    seen = cut(arrow_map(rows.select("q", "t", "text"), f, "q int, t int, x array<double>, words array<string>"), "labelled")
    got = seen.select("q", "t", "x").toArrow()  # bounded by max_labelled
    if not got.num_rows:
        return model
    x = _widened(got["x"].combine_chunks().flatten().to_numpy().reshape(got.num_rows, -1))
    q, t = (got[c].to_numpy().astype(float) for c in ("q", "t"))
    if len(q) >= 50 and min(q.sum(), len(q) - q.sum()) >= 5:
        model.quality = fit_logistic(x, q)
    n, n_toxic = len(t), t.sum()
    if n_toxic >= 5:
        tested = seen.select(F.explode("words").alias("word"), "t").groupBy("word").agg(F.sum("t").alias("a"), F.count("*").alias("n"))
        rate, vocabulary = n_toxic / n, tested.count()
        often = [(_tail(r.a, r.n, rate), r.word) for r in tested.where("a >= 4").collect()]  # bounded by the labelled sample
        lexicon = sorted({*SEED_WORDS, *(w for p, w in sorted(often)[:MAX_LEXICON] if p * vocabulary < 1)})
        hits = seen.select(F.array_intersect("words", F.array(*map(F.lit, lexicon))).alias("hits"), F.col("t")).toArrow()
        found, z = hits["hits"].combine_chunks(), np.zeros((hits.num_rows, len(lexicon)), bool)
        z[np.repeat(np.arange(len(found)), found.value_lengths().to_numpy()), pc.index_in(found.flatten(), pa.array(lexicon)).to_numpy()] = True
        weights = _fit_lexicon(z, hits["t"].to_numpy().astype(float), np.array([6.0 if w in SEED_WORDS else 0.0 for w in lexicon]))
        model.toxic_bias, model.words = float(weights[0]), {w: float(v) for w, v in zip(lexicon, weights[1:], strict=True)}
    return model


def _fit_lexicon(z: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float = 0.15, rows: int = 1024) -> np.ndarray:
    """Weights of present words, the bias first, drawn towards the prior ones. z is taken as numbers some rows at a time."""
    w, pull = np.array([-4.0, *prior]), np.array([1e-6, *[ridge] * len(prior)])
    aim = w.copy()
    for _ in range(50):
        curve, slope = np.diag(pull), -pull * (w - aim)
        for at in range(0, len(z), rows):
            part = np.hstack([np.ones((len(z[at : at + rows]), 1)), z[at : at + rows]])
            p = _sigmoid(part @ w)
            curve += (part.T * (p * (1 - p) + 1e-9)) @ part
            slope += part.T @ (y[at : at + rows] - p)
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _tail(a: int, n: int, p: float) -> float:
    """Bound of the chance of a or more of n at rate p (Chernoff's)."""
    if a <= n * p:
        return 1.0
    k = a / n
    return math.exp(-n * (k * math.log(k / p) + ((1 - k) * math.log((1 - k) / (1 - p)) if k < 1 else 0)))


def evidence_column(model: Model, text: Column) -> Column:
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def evidence(texts):
        import pandas as pd

        return pd.Series(model.evidence(list(texts)), dtype=float)

    return evidence(text.cast("string"))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """Rows (host, path, shift): what a path's shrunken rate adds to the global log-odds. scored: host, path, evidence."""
    p = 1 / (1 + F.exp(-F.col("evidence")))
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("s"))
    paths = cut(paths, "sites")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    total = hosts.agg(F.sum("hn"), F.sum("hs"), F.count(F.lit(1)), F.sum(F.col("hn") * F.pow(F.col("hs") / F.col("hn"), 2))).first()
    if not total[0]:
        return paths.select("host", "path", F.lit(0.0).alias("shift"))
    g = min(max(total[1] / total[0], 1e-4), 1 - 1e-4)
    k_host = _strength(g, total[0], total[2], total[3])
    rates = hosts.select(F.col("host").alias("h"), ((F.col("hs") + k_host * g) / (F.col("hn") + k_host)).alias("host_rate"))
    both = paths.join(rates, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    spread = both.agg(F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("host_rate"), 2)), F.count(F.lit(1))).first()
    k_path = _strength(g, total[0], spread[1], spread[0] + total[0] * g * g)
    rate = (F.col("s") + k_path * F.col("host_rate")) / (F.col("n") + k_path)
    rate = F.least(F.greatest(rate, F.lit(1e-4)), F.lit(1 - 1e-4))
    return both.select("host", "path", (F.log(rate / (1 - rate)) - math.log(g / (1 - g))).alias("shift"))


def _strength(g: float, n: float, sites: int, sum_n_rate2: float) -> float:
    """Documents that the prior is worth, by moments: the spread of sites' rates beyond what chance gives."""
    between = sum_n_rate2 / n - g * g - g * (1 - g) * sites / n
    return min(1e6, max(1.0, g * (1 - g) / max(between, 1e-9) - 1))


def judge(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None, path: Column | None = None, max_labelled: int = MAX_LABELLED, carry: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of docs (the columns in carry, or all) with _evidence, _shift, _posterior and _keep; where a column has such a name already, more underscores follow."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, max_labelled=max_labelled)
    small_batches(docs.sparkSession)
    host = F.col("source") if host is None else host
    path = F.concat_ws("/", host, F.col("lang")) if path is None else path
    carry = list(carry if carry is not None else docs.columns)
    own = [F.col(f"`{c}`").alias(f"own{i}") for i, c in enumerate(carry)]
    # Written once: each later use of a row would score it again.
    named = cut(docs.select(*own, host.cast("string").alias("host"), path.cast("string").alias("path"), evidence_column(model, F.col(text_col)).alias("evidence")), "scores")
    sites = cut(site_posteriors(named.select("host", "path", "evidence")).toDF("h", "p", "shift"), "posteriors")
    if sites.count() <= BROADCAST_SITES:
        sites = F.broadcast(sites)
    joined = named.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")), "left")
    shift = F.coalesce(F.col("shift"), F.lit(0.0))
    z = F.col("evidence") + shift
    new = zip(("evidence", "shift", "posterior", "keep"), (F.col("evidence"), shift, 1 / (1 + F.exp(-z)), z >= 0), strict=True)
    return joined.select(*[F.col(f"own{i}").alias(c) for i, c in enumerate(carry)], *[x.alias(unused(docs.select(*[F.col(f"`{c}`") for c in carry]), n)) for n, x in new])


def without_rejected(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of docs that are kept, with their columns alone."""
    judged = judge(docs, labels, **how)
    return judged.where(F.col(judged.columns[-1])).select(*[F.col(f"`{c}`") for c in docs.columns])
