"""Every operator on tables whose columns have the names that operators use inside, with null, empty, long and repeated rows; string ids; ledgers that grow."""

import hashlib
import random

import pytest
from seqloom.llm import bpe, decontaminate, html_text, jaccard, licenses, media, packing, quality, secrets, suffixes
from seqloom.llm.queries import tokenizer_path

INSIDE = "_blob _spans _address blob spans id h t n cid rep _raw _host _path _h _p _s _evidence _shift _posterior _keep host path evidence shift _sh _t _id0 id0 sh template key own0 n_tokens row _gone _number _row text_ html url".split()
WORDS = "kaba lodi mifo negu rusen tator vel bafo".split()


def prose(seed, n):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


LONG = prose(1, 30_000)
TEXTS = [(1, prose(2, 60)), (2, None), (3, ""), (4, LONG), (5, prose(2, 60)), (5, prose(2, 60)), (5, prose(3, 40)), (6, "token = 'abcdefghijklmnop' " + prose(4, 30)), (None, prose(5, 50)), (8, "x" * 20_000)]


@pytest.fixture(scope="module", params=["long", "string"])
def docs(spark, request):
    columns = ["doc_id", "text", "source", "lang", *INSIDE]
    kinds = [request.param, "string", "string", "string", *["string"] * len(INSIDE)]
    rows = [(i if i is None or request.param == "long" else f"d{i}", t, "s", "en", *["clash"] * len(INSIDE)) for i, t in TEXTS]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` {k}" for c, k in zip(columns, kinds, strict=True)))


@pytest.fixture(scope="module")
def operators(spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, prose(3, 40)), (None, None)], "item_id long, text string")
    return {
        "bpe": lambda d: bpe.encode_digests(d, tokenizer_path()),
        "html": lambda d: html_text.extract_text(d, id_cols=("doc_id",), html_col="text"),
        "secrets": secrets.find_secrets,
        "redacted": secrets.without_secrets,
        "media": media.media_features,
        "jaccard": jaccard.similar_classes,
        "near": jaccard.without_near_duplicates,
        "licenses": licenses.scan_licenses,
        "suffixes": suffixes.remove_repeats,
        "contaminated": lambda d: decontaminate.find_contaminated(d, bench),
        "clean": lambda d: decontaminate.without_contaminated(d, bench),
        "clean_join": lambda d: decontaminate.without_contaminated(d, bench, max_windows=0),
        "judged": lambda d: quality.judge(d, labels.selectExpr("cast(doc_id as string) doc_id", "quality", "toxic") if dict(d.dtypes)["doc_id"] == "string" else labels),
        "packed": lambda d: packing.pack(bpe.encode_ids(d, tokenizer_path())),
    }


#: Rows of the result: of all ten, or of those that stay or are found.
ROWS = {"near": 8, "licenses": 0, "contaminated": 1, "clean": 9, "clean_join": 9, "packed": None}


@pytest.mark.parametrize("name", ["bpe", "html", "secrets", "redacted", "media", "jaccard", "near", "licenses", "suffixes", "contaminated", "clean", "clean_join", "judged", "packed"])
def test_clashing_names_and_odd_rows(docs, operators, name):
    got = operators[name](docs)
    rows = got.collect()
    if (want := ROWS.get(name, len(TEXTS))) is not None:
        assert len(rows) == want
    if name in ("redacted", "near", "clean", "clean_join"):
        assert got.columns == docs.columns and {r["_blob"] for r in rows} == {"clash"}
    assert operators[name](docs.where("false")).count() == 0


def test_near_duplicates_keep_texts_that_share_an_id(docs):
    kept = {r.text for r in jaccard.without_near_duplicates(docs).collect()}
    assert kept == {t for _, t in TEXTS}


# Ledger
def test_ledger_grows_and_keeps_what_it_had(spark, tmp_path):
    first = spark.createDataFrame([(1, "token = 'abcdefghijklmnop'"), (2, None)], "doc_id long, text string")
    second = spark.createDataFrame([(3, "secret: 0123456789abcdef0123"), (1, "token = 'abcdefghijklmnop'")], "doc_id long, text string")
    one = secrets.update_ledger(first)
    two = secrets.update_ledger(second, one)
    assert two.count() == 3 and secrets.new_scans(second, one).count() == 1 and secrets.new_scans(first, two).count() == 0
    other = secrets.update_ledger(second, two, rule_version="2")
    assert other.count() == 5
    assert secrets.find_secrets(second, other).count() == 2
    path = str(tmp_path / "ledger")
    counts = [secrets.append_to_ledger(t, path, rule_version=v).count() for t, v in ((first, "1"), (second, "1"), (first, "1"), (first, "2"))]
    assert counts == [2, 3, 3, 5]


def test_ledger_findings_are_not_scanned_again(spark):
    """A ledger's row is believed: no text of a known blob is read."""
    text = "token = 'abcdefghijklmnop'"
    row = (hashlib.sha256(text.encode()).digest(), secrets.RULES_VERSION, 7, 7, 7, "x", "y")
    ledger = spark.createDataFrame([row], secrets.empty_ledger(spark).schema)
    (got,) = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string"), ledger).collect()
    assert tuple(got) == (1, 7, 7, 7, "x", "y")


# Licenses
def test_templates_as_a_table_give_the_rows_of_constants(spark):
    rng = random.Random(9)
    bodies = {f"t{i}": " ".join(rng.choices([f"w{j}" for j in range(400)], k=rng.choice([7, 20, 60, 120]))) for i in range(40)}
    texts = []
    for i in range(120):
        w = rng.choice(list(bodies.values())).split()
        w = [x if rng.random() > rng.choice([0, 0.01, 0.05]) else "other" for x in w]
        texts.append((i, prose(i, rng.randint(0, 60)) + " " + " ".join(w) + " " + prose(-i, 20)))
    texts += [(500, None), (501, ""), (0, texts[0][1])]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    table = spark.createDataFrame(list(bodies.items()), "template string, body string")

    def plain():
        cut = lambda t: {tuple(w[i : i + 5]) for w in [(t or "").split()] for i in range(len(w) - 4)}
        return sorted((d, n, len(cut(t) & cut(b)), len(cut(b))) for d, t in texts for n, b in bodies.items() if len(cut(t) & cut(b)) >= 0.8 * len(cut(b)))

    for given, most in ((bodies, 20_000), (table, 20_000), (table, 0)):
        got = licenses.scan_licenses(docs, given, constant_keys=most)
        assert sorted(tuple(r)[:4] for r in got.collect()) == plain() and len(plain()) > 60


def test_windows_are_retrieved_as_often_as_stated(spark):
    """One window with a fifth of its shingles changed shares a key with the template's window, but for a few of a thousand."""
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        a = [rng.getrandbits(62) for _ in range(32)]
        b = a[:]
        for k in rng.sample(range(32), 6):
            b[k] = rng.getrandbits(62)
        rows.append((i, a, b))
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "i int, a array<long>, b array<long>")
    missed = df.where(~F.arrays_overlap(licenses.bands(F.col("a"), 1), licenses.bands(F.col("b")))).count()
    assert missed <= 6
