"""Decontamination against a plain version, look-alikes around copies, and the join by shuffle against the broadcast index."""

import random
import re
from collections import Counter, defaultdict

import pytest
from seqloom.llm import decontaminate as D

ITEM = "the red car has 5 wheels and the blue van has 5 doors while the green bus has 5 seats in it"
COPY = ITEM.replace("5", "8")
DECOY = ITEM.replace("5", "8", 1).replace(" 5 d", " 2 d").replace(" 5 s", " 9 s")


@pytest.mark.parametrize("text", [f"{DECOY} . {COPY}", f"{COPY} . {DECOY}", f"{DECOY} . {COPY} . {DECOY}", f"{DECOY} . {DECOY} . {ITEM}", f"{ITEM} . {COPY}"])
def test_look_alikes_hide_no_copy(text):
    (found,) = D.Index([(1, ITEM)]).find([text])
    assert found[1] == 1 and found[4] == 1.0 and found[6] == 1.0


def test_look_alikes_alone_are_no_copy():
    assert not D.Index([(1, ITEM)]).find([DECOY, f"{DECOY} . {DECOY}"])


# A plain version of windows and slots, for prose without names, units and signs.
def plain_tokens(text):
    return [("<num>" if re.fullmatch(r"\d+", w) else w) for w in text.lower().split()]


def plain_windows(text):
    t = plain_tokens(text)
    out = defaultdict(list)
    for i in range(len(t) - 4):
        w = tuple(t[i : i + 5])
        if sum(x != "<num>" for x in w) >= 3:
            out[w].append(i)
    return out


def plain_match(item, text):
    a, b = plain_windows(item), plain_windows(text)
    common = [w for w in a if w in b]
    if not a or len(common) < 0.8 * len(a):
        return False
    own, words = item.lower().split(), text.lower().split()
    for offset in {y - a[w][0] for w in common for y in b[w]}:
        values, seen = defaultdict(Counter), set()
        for w in common:
            for x in a[w]:
                y = min(b[w], key=lambda y: (abs(y - x - offset), y))
                for k in range(5):
                    if (x + k, y + k) not in seen and own[x + k].isdigit():
                        values[own[x + k]][words[y + k]] += 1
                    seen.add((x + k, y + k))
        n = sum(sum(c.values()) for c in values.values())
        if sum(max(c.values()) for c in values.values()) >= 0.8 * n:
            return True
    return False


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(8)
    words = ["kaba", "lodi", "mifo", "negu", "rusen", "tator", "vel"]
    make = lambda n: " ".join(rng.choice([*words, *words, str(rng.randint(1, 9))]) for _ in range(n))
    items = [make(rng.randint(8, 20)) for _ in range(30)]

    def altered(t):
        to = {str(i): str(rng.randint(1, 99)) for i in range(10)}
        return " ".join((to.get(w, w) if rng.random() > 0.1 else str(rng.randint(1, 99))) if w.isdigit() else w if rng.random() > 0.02 else "other" for w in t.split())

    texts = [" ".join(f"{make(rng.randint(0, 10))} {altered(rng.choice(items))}" for _ in range(rng.randint(1, 4))) for _ in range(150)]
    return list(enumerate(items)), list(enumerate(texts))


def test_items_are_those_of_the_plain_version(tables):
    items, texts = tables
    found = {(x[0], x[1]) for x in D.Index(items).find([t for _, t in texts])}
    assert found == {(d, i) for d, t in texts for i, item in items if plain_match(item, t)} and 100 < len(found) < 400


def test_the_join_gives_the_rows_of_the_index(spark, tables):
    items, texts = tables
    items = [*items, (40, "Who wrote Don Quixote?"), (41, "What is 48 + 57 - 13 * 2 / 5 ?"), (None, "a null id has this item of some length"), (2, "two texts under one id, and each is found"), (50, None), (51, ""), (3, items[3][1])]
    texts = [*texts, (300, "so: who wrote don quixote? he asked"), (301, "what is 48 + 57 - 13 * 2 / 5"), (302, "well, a null id has this item of some length"), (303, "and two texts under one id, and each is found"), (304, None), (305, ""), (0, texts[0][1]), (None, texts[0][1])]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in texts], "doc_id long, text string, h string, _address string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = lambda most: sorted(map(str, D.find_contaminated(docs, bench, max_windows=most).collect()))
    assert rows(0) == rows(100_000)
    assert sum("item_id=None" in r for r in rows(0)) == 1
    kept = [sorted(map(str, D.without_contaminated(docs, bench, max_windows=most).collect())) for most in (0, 100_000)]
    assert kept[0] == kept[1] and D.without_contaminated(docs, bench, max_windows=0).columns == docs.columns
    assert D.find_contaminated(docs.where("false"), bench, max_windows=0).count() == 0
    assert D.without_contaminated(docs, bench.where("false"), max_windows=-1).count() == docs.count()


def test_ids_of_other_kinds_and_clashing_names(spark):
    docs = spark.createDataFrame([("a", COPY)], "item_id string, text string")
    bench = spark.createDataFrame([("q1", ITEM)], "name string, text string")
    for most in (0, 1000):
        got = D.find_contaminated(docs, bench, id_col="item_id", item_col="name", max_windows=most)
        assert got.columns[:2] == ["item_id", "item_id_found"] and tuple(got.first())[:2] == ("a", "q1")
