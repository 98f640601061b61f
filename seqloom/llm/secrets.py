"""Secret scans over an incremental blob ledger.

Every version of every text is addressed by its SHA-256. A blob and a version of the rules are scanned together once:
pairs that the ledger has are left out by address alone, before any text moves; the others are scanned and added. The
ledger only grows: what it held of other blobs and other rule versions stays. Findings go back by address to each path
(row) that held the blob. The base kinds are assign, access and hex; the rules here add pem, github, slack and jwt.

Null text is an empty blob without findings. Equal texts share a blob; repeated rows each get its findings. Long texts
are scanned whole. Spans of different kinds may overlap; each is reported, and redaction covers their union. An empty
table adds nothing to the ledger. Columns of the rows may have any name.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import arrow_map, cut, small_batches, unused

RULES_VERSION = "1"
#: Findings up to this size go to every executor; more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
#: Addresses of 32 bytes that go to every executor.
BROADCAST_BLOBS = 200_000

# The patterns of the base kinds (with the least length of the group that must reach it), then those added.
BASE = [
    ("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),
]
MORE = [
    ("pem", "-----BEGIN", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")),
    ("github", "gh", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}")),
    ("slack", "xox", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}")),
    ("jwt", "eyJ", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
]
#: assign can only match where one of these stands, in either case.
_KEYS = (b"passw", b"secret", b"token", b"api")
COLUMNS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(text: str) -> tuple[int, int, int, str, str]:
    found, counts = [], []
    low = text.encode().lower()  # of bytes, only A-Z change
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        if kind == "assign" and not any(k in low for k in _KEYS) or kind == "access" and "AKIA" not in text:
            counts.append(0)
            continue
        hits = [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
        counts.append(len(hits))
        found += hits
    base = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))
    for rank, (kind, sign, pattern) in enumerate(MORE, len(BASE)):
        if sign in text:
            found += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text)]
    return *counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], f"blob binary, rule_version string, {COLUMNS}")


def new_scans(versions: DataFrame, ledger: DataFrame | None = None, *, text_col: str = "text", rule_version: str = RULES_VERSION) -> DataFrame:
    """The ledger's rows that are missing for the blobs that versions hold: one scan of each unseen pair."""
    texts = versions.select(_blob(text_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if ledger is not None:
        known = ledger.where(F.col("rule_version") == rule_version).select("blob")
        unseen = cut(texts.select("blob").distinct().join(known, "blob", "left_anti"), "unseen")
        n = unseen.count()
        if not n:
            return empty_ledger(versions.sparkSession)
        texts = texts.join(F.broadcast(unseen) if n <= BROADCAST_BLOBS else unseen, "blob", "left_semi")

    def f(ids, texts):
        rows = [scan(t) for t in texts]
        return ids, [rule_version] * len(ids), *(list(c) for c in zip(*rows, strict=True))

    return arrow_map(texts.groupBy("blob").agg(F.first("text").alias("text")), f, f"blob binary, rule_version string, {COLUMNS}")


def update_ledger(versions: DataFrame, ledger: DataFrame | None = None, *, text_col: str = "text", rule_version: str = RULES_VERSION) -> DataFrame:
    """The whole ledger: every pair that it had, of any blob and rule version, and a scan of each that versions add."""
    added = new_scans(versions, ledger, text_col=text_col, rule_version=rule_version)
    return added if ledger is None else ledger.select(added.columns).unionByName(added)


def append_to_ledger(versions: DataFrame, path: str, *, text_col: str = "text", rule_version: str = RULES_VERSION) -> DataFrame:
    """Adds the unseen pairs to the ledger at path, a Parquet table with a folder for each rule version, made if it isn't there; gives the ledger."""
    spark = versions.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    schema = empty_ledger(spark).schema
    read = lambda: spark.read.schema(schema).parquet(path)
    old = read() if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p) else None
    new_scans(versions, old, text_col=text_col, rule_version=rule_version).write.mode("append").partitionBy("rule_version").parquet(path)
    return read()


def _blob(text_col: str):
    return F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)).alias("blob")


def find_secrets(versions: DataFrame, ledger: DataFrame | None = None, *, path_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text", rule_version: str = RULES_VERSION) -> DataFrame:
    """Per row of versions: its path columns, the counts of the base kinds, their digest, and all spans.

    The rows' side of the join has no text; a blob that very many rows share is a skewed key, which adaptive execution splits.
    """
    found = update_ledger(versions, ledger, text_col=text_col, rule_version=rule_version).where(F.col("rule_version") == rule_version).drop("rule_version")
    paths = versions.select(*[F.col(c).alias(f"path{i}") for i, c in enumerate(path_cols)], _blob(text_col))
    return paths.join(found.hint("merge"), "blob").select(*[F.col(f"path{i}").alias(c) for i, c in enumerate(path_cols)], "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def without_secrets(docs: DataFrame, ledger: DataFrame | None = None, *, text_col: str = "text", mark: str = "[SECRET]", rule_version: str = RULES_VERSION) -> DataFrame:
    """The rows of docs, all columns kept, with every found span of the text replaced by mark; null texts stay null."""
    address, spans = unused(docs, "address"), unused(docs, "spans")
    found = update_ledger(docs, ledger, text_col=text_col, rule_version=rule_version).where((F.col("rule_version") == rule_version) & (F.col("spans") != ""))
    hits = cut(found.select(F.col("blob").alias(address), F.col("spans").alias(spans)), "findings")
    if hits.agg(F.coalesce(F.sum(F.length(spans) + 64), F.lit(0))).first()[0] <= BROADCAST_BYTES:
        hits = F.broadcast(hits)
    joined = docs.withColumn(address, _blob(text_col)).join(hits, address, "left")

    @pandas_udf("string")
    def cleaned(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None else redact(t, mark, s) for t, s in zip(texts, spans, strict=True)], dtype=object)

    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    return joined.select(*[cleaned(text, F.col(spans)).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def redact(text: str, mark: str = "[SECRET]", spans: str | None = None) -> str:
    spans = scan(text)[4] if spans is None else spans
    out, at = [], 0
    for start, end in sorted(tuple(map(int, s.rsplit(":", 2)[1:])) for s in spans.split(",") if s):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
