"""The subpackage's registered queries, each over its whole table with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, html_text, jaccard, licenses, media, packing, quality, secrets, suffixes
from .common import cut, table

#: The tokenizer's file; its name for public_tokenizers.path().
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one ledger: the first scans every blob, the second finds none unseen and reads all findings from the ledger."""
    docs = table(spark, sf_dir, "documents")
    return secrets.find_secrets(docs, cut(secrets.update_ledger(docs), "ledger"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(bpe.encode_ids(table(spark, sf_dir, "documents"), tokenizer_path()))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_classes(table(spark, sf_dir, "documents"))
    return found.select(found["id"].alias("doc_id"), "n_shingles", "component_id")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are kept, with what decided."""
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), carry=("doc_id",))
    return judged.where("_keep").withColumnsRenamed({"_evidence": "evidence", "_shift": "site_shift", "_posterior": "posterior", "_keep": "keep"})


QUERIES = {f.__name__: f for f in (op1_bpe, op2_html_text, op3_secret_scan, op4_packing, op5_decontaminate, op6_media_columns, op7_jaccard_join, op8_license_scan, op9_suffix_dedup, op10_quality)}

_VALUES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(licenses.TEMPLATES.items()))
_SPLIT = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
_SHINGLES = f"unnest(list_transform(range(1, len(w) - {licenses.WORDS - 2}), lambda i: array_to_string(w[i:i + {licenses.WORDS - 1}], ' ')))"

ORACLE_SQL = {
    "op8_license_scan": f"""
WITH t(template, body) AS (VALUES {_VALUES}),
ts AS (SELECT DISTINCT template, {_SHINGLES} AS s FROM (SELECT template, {_SPLIT.format("body")} AS w FROM t)),
tn AS (SELECT template, count(*) AS n FROM ts GROUP BY template),
ds AS (SELECT DISTINCT doc_id, {_SHINGLES} AS s FROM (SELECT doc_id, {_SPLIT.format("coalesce(text, '')")} AS w FROM documents))
SELECT doc_id, template, CAST(count(*) AS INTEGER) AS n_matched, CAST(n AS INTEGER) AS n_template, round(count(*) / n, 6) AS containment
FROM ds JOIN ts USING (s) JOIN tn USING (template) GROUP BY doc_id, template, n HAVING count(*) >= {licenses.CONTAINED} * n
""",
}
