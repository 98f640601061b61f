"""Jaccard join, suffix dedup, decontamination, quality and the pipeline: against brute force on small tables."""

import hashlib
import itertools
import random

import corpus_pipeline
import numpy as np
import pytest
from seqloom.llm import decontaminate, jaccard, quality, suffixes

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "ru", "ta") for b in ("ba", "di", "fo", "gu", "sen", "tor", "vel")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, text, rate):
    return " ".join(w if rng.random() > rate else rng.choice(WORDS) + "x" for w in text.split(" "))


@pytest.fixture(scope="module")
def corpus():
    """Prose, groups of exact and near copies, a shared passage, odd and repeated rows."""
    rng = random.Random(11)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(60)]
    base, passage = prose(rng, 150), prose(rng, 40)
    texts += [base] * 5 + [edited(rng, base, 0.02) for _ in range(30)] + [edited(rng, base, 0.15) for _ in range(10)]
    texts += [prose(rng, 20) + " " + passage + " " + prose(rng, 20) for _ in range(15)]
    texts += [None, "", "  \n", "one two", "one two three", "ONE two\x0bthree", "a b c d", "a b c d", "é ü é ü é", "z" * 500, "la " * 300]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + rows[:3]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, "x") for i, t in rows], "doc_id long, text string, cid string, n int, h string")


def groups(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_components_are_those_of_all_pairs(spark, corpus, k, percent):
    got = jaccard.similar_classes(frame(spark, corpus), shingle=k, percent=percent).collect()
    want = groups(corpus, k, percent)
    assert len(got) == len(corpus)
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == want


def test_leaders_do_not_hide_links(spark, corpus, monkeypatch):
    """Without broadcasts, and with all shingles in one order."""
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", -1)
    monkeypatch.setattr(jaccard, "sketch", lambda *a: np.zeros(1 << jaccard.SKETCH_BITS, np.uint8))
    got = jaccard.similar_classes(frame(spark, corpus)).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == groups(corpus, 4, 85)


@pytest.mark.parametrize("left", ["pmod(xxhash64(a, b), 3) = 0", "false"])
def test_second_round_joins_what_the_first_left(spark, corpus, monkeypatch, left):
    """The first round's links are thinned, so that its components lie apart and are joined by the second."""
    runs, verified, components = [], jaccard.verified, jaccard.components

    def thinned(*args):
        runs.append("verified")
        return verified(*args).where(left) if runs.count("verified") == 1 else verified(*args)

    def counted(*args, **how):
        runs.append("components")
        return components(*args, **how)

    monkeypatch.setattr(jaccard, "verified", thinned)
    monkeypatch.setattr(jaccard, "components", counted)
    got = jaccard.similar_classes(frame(spark, corpus)).collect()
    assert runs == ["verified", "components", "verified", "components"]
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == groups(corpus, 4, 85)


def test_near_duplicates_leave_one_of_each(spark, corpus):
    df = frame(spark, corpus)
    kept = jaccard.without_near_duplicates(df)
    want = {i for i, (n, c) in groups(corpus, 5, 80).items() if c == i}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert kept.columns == df.columns


def test_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (None, None), (2, "a b c d e"), (2, "a b c d e"), (1, "q w e r t")], "doc_id long, text string")
    got = sorted(map(tuple, jaccard.similar_classes(df).drop("cid").collect()), key=str)
    assert got == sorted([(None, 2, 2), (None, 0, None), (2, 2, 2), (2, 2, 2), (1, 2, 1)], key=str)
    assert jaccard.similar_classes(df.where("false")).count() == 0
    assert suffixes.remove_repeats(df.where("false")).count() == 0
    assert {r.n_bytes for r in suffixes.remove_repeats(df).collect()} == {9, 0}


# Suffixes
def repeats(rows, length):
    seen, out = set(), {}
    for i, t in sorted(dict(rows).items()):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            if w in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), sum(bool(g) and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("length", "gram"), [(100, 48), (40, 16)])
def test_removed_bytes_are_those_of_a_plain_scan(spark, corpus, length, gram):
    got = suffixes.remove_repeats(frame(spark, corpus), length=length, gram=gram).collect()
    want = repeats(corpus, length)
    assert len(got) == len(corpus) and any(w[1] for w in want.values())
    assert {r.doc_id: tuple(r)[1:] for r in got} == want


def test_small_buckets_and_blocks(spark, corpus, monkeypatch):
    """Runs of equal suffixes over many buckets, and texts over many blocks."""
    monkeypatch.setattr(suffixes, "BUCKET", 20)
    monkeypatch.setattr(suffixes, "BLOCK", 256)
    got = suffixes.remove_repeats(frame(spark, corpus), with_text=True).collect()
    assert {r.doc_id: tuple(r)[1:5] for r in got} == repeats(corpus, 100)
    assert all(hashlib.sha256(r.kept_text).hexdigest() == r.kept_sha256 for r in got)


def test_several_texts_under_one_id(spark):
    a, b = "a0" * 80, "b1" * 80
    got = suffixes.remove_repeats(spark.createDataFrame([(1, a), (1, b), (2, a + b)], "doc_id long, text string")).collect()
    assert sum(r.n_removed for r in got if r.doc_id == 2) >= 300


def test_multikey_order_is_lexicographic():
    rng = np.random.default_rng(1)
    keys = [rng.integers(0, 4, 500), rng.integers(0, 3, 500), rng.integers(0, 50, 500)]
    order = suffixes.multikey_order(keys)
    rows = list(zip(*(k[order].tolist() for k in keys), strict=True))
    assert rows == sorted(rows)


# Decontamination
@pytest.fixture(scope="module")
def benchmark_items():
    rng = random.Random(21)
    items = [(i, prose(rng, 30)) for i in range(20)]
    items += [(20, "If Anna buys 12 apples for 3 dollars each and then gives 5 apples to Peter, how many dollars did she spend on all of the apples she bought today?")]
    return items + [(21, None), (22, "too short"), (23, ""), (3, items[3][1])]


def test_items_and_templates_are_found(spark, benchmark_items):
    rng = random.Random(22)
    other = "If Maria buys 40 apples for 7 dollars each and then gives 9 apples to George, how many dollars did she spend on all of the apples she bought today?"
    mixed = other.replace("gives 9 apples", "gives 9 pears").replace("40 apples", "40 books") + " " + prose(rng, 30)
    rows = [(i, prose(rng, 50)) for i in range(30)]
    rows += [(100 + i, prose(rng, 25) + ". " + t.upper() + "! " + prose(rng, 25)) for i, t in benchmark_items[:20]]
    rows += [(200, prose(rng, 9) + ". " + other), (300, None), (301, ""), (302, "too short"), (303, mixed), (100, rows[0][1])]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(benchmark_items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_contaminated(docs, bench).collect()}
    assert {(100 + i, i) for i in range(20)} | {(200, 20)} <= got
    assert all(d >= 100 for d, _ in got) and not {300, 301, 302} & {d for d, _ in got}
    blocks = {(r.doc_id, r.item_id) for r in decontaminate.find_contaminated(docs, bench, max_windows=60).collect()}
    assert blocks == got
    clean = decontaminate.without_contaminated(docs, bench)
    dirty = {d for d, _ in got}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {i for i, _ in rows if i not in dirty or i == 100}
    assert decontaminate.find_contaminated(docs.where("false"), bench).count() == 0
    assert decontaminate.find_contaminated(docs, bench.where("false")).count() == 0


def test_slots_that_disagree_are_no_match():
    item = "the red car has 5 wheels and the blue van has 5 doors while the green bus has 5 seats in it"
    index = decontaminate.Index([(1, item)])
    assert index.find([item.replace("5", "8")])
    assert not index.find([item.replace("5", "8", 1).replace(" 5 d", " 2 d").replace(" 5 s", " 9 s")])


def test_names_in_another_case_are_found(benchmark_items):
    items = [benchmark_items[20], (30, "we saw how Anna Bell and Carl Dunn met Eva Frank near the old mill that day")]
    index = decontaminate.Index(items)
    for i, t in items:
        assert all([x[1] for x in index.find([copy])] == [i] for copy in (t, t.lower(), t.upper(), t.replace("Anna", "Maria")))
    assert not index.find([items[1][1].replace("old mill", "new park").replace("saw how", "knew why").lower()])


def test_items_without_windows_are_found_by_their_wording():
    items = ["What is 48 + 57 - 13 * 2 / 5 ?", "Compute 12 * 7 + 5 * 3 - 8 / 2 .", "Who wrote Don Quixote?", "Capital of France?", "?", ""]
    index = decontaminate.Index(list(enumerate(items)))
    rng = random.Random(23)
    found = lambda text: [x[1] for x in index.find([prose(rng, 20), text])]
    for i, t in enumerate(items[:4]):
        assert found(prose(rng, 20) + ". " + t + " " + prose(rng, 20)) == [i] and found(t.upper()) == [i]
    assert not found("what is 48 - 57 + 13 * 2 / 5 ?") and not found("Compute 12 * 7 + 5 * 3 - 8 / 3 .") and not found("who wrote don juan") and not found("? ?")


# Quality
def labelled(n=400, seed=31):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        t, q, x = prose(rng, rng.randint(20, 90)), 1, 0
        if i % 7 == 0:
            t, q = " ".join(w + rng.choice(["***", "%%%", "###"]) for w in t.split()), 0
        if i % 5 == 0:
            w = t.split()
            w[rng.randrange(len(w))] = rng.choice(["zorp", "glarn"])
            t, x = " ".join(w), 1
        docs.append((i, t, f"s{i % 3}", "en"))
        labels.append((i, q, x))
    return docs, labels


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = labelled()
    odd = [(1000, None, None, None), (1001, "", "s0", "en"), (1002, "zorp " + prose(random.Random(1), 30), "new", None), (5, docs[6][1], "s0", "en")]
    df = spark.createDataFrame([(*r, "c") for r in docs + odd], "doc_id long, text string, source string, lang string, path string")
    train = spark.createDataFrame([x for x in labels if x[0] % 2], "doc_id long, quality int, toxic int")
    judged = quality.judge(df, train)
    got = judged.collect()
    assert len(got) == len(docs) + len(odd) and judged.columns[:5] == df.columns
    keep = {r.doc_id: r._keep for r in got if r.doc_id != 5}
    held = [(i, q == 1 and x == 0) for i, q, x in labels if not i % 2]
    assert sum(keep[i] == k for i, k in held) / len(held) > 0.97
    assert not keep[1000] and not keep[1001] and not keep[1002]
    assert quality.judge(df.where("false"), train).count() == 0
    assert quality.judge(df, train.where("false"), carry=("doc_id",)).count() == len(got)


def test_sparse_sites_shrink_towards_the_global_rate(spark):
    logit = lambda p: float(np.log(p / (1 - p)))
    rows = [("big", "big/a", logit(0.2))] * 300 + [("good", "good/a", logit(0.9))] * 300 + [("new", "new/a", logit(0.2))]
    shift = {r.host: r["shift"] for r in quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, evidence double")).collect()}
    assert shift["big"] < shift["new"] < shift["good"] and abs(shift["new"]) < abs(shift["big"])


# Pipeline
def test_pipeline_stages_take_effect(spark, tmp_path, benchmark_items):
    docs, labels = labelled(120, 41)
    rng = random.Random(42)
    clean = prose(rng, 60)
    docs += [(500, clean, "s0", "en"), (501, clean + " end", "s1", "en"), (502, prose(rng, 20) + ". " + benchmark_items[2][1] + ". " + prose(rng, 20), "s1", "en"), (503, prose(rng, 40) + " token = 'abcdefghijklmnop'", "s2", "en"), (504, None, None, None)]
    d = str(tmp_path / "sf")
    spark.createDataFrame([(*r, len(r[1] or "")) for r in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(benchmark_items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    at, columns = spark.read.parquet(f"{d}/documents.parquet"), None
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        columns = columns or at.columns
        stage(spark, at, d).write.parquet(f"{d}/{i}")
        at = spark.read.parquet(f"{d}/{i}")
        ids = {r.doc_id for r in at.collect()}
        if name != "bpe":
            assert at.columns == columns
        if name == "near_duplicates":
            assert 500 in ids and 501 not in ids
        if name == "decontamination":
            assert 502 not in ids and 503 in ids
        if name == "secrets":
            assert "[SECRET]" in at.where("doc_id = 503").first().text
    assert {r.doc_id for r in corpus_pipeline.run(spark, d).collect()} == ids and all(len(r.token_ids) == r.n_tokens for r in at.collect())
