"""best_bundle against a plain version, and that it shuffles runs of letters."""

import random
from collections import defaultdict

import pytest
from seqloom.functions import seq as S
from seqloom.operators import kmers

PAIRS = str.maketrans(S.IUPAC_FROM, S.IUPAC_TO)


def plain(reads, contigs, k, least, canonical):
    def of(s):
        found = {s[i : i + k] for i in range(len(s or "") - k + 1)} if s else set()
        return {min(x, x.translate(PAIRS)[::-1]) for x in found} if canonical else found

    own, have = defaultdict(set), defaultdict(set)
    for a, s in reads:
        own[a] |= of(s)
    for b, s in contigs:
        for x in of(s):
            have[x].add(b)
    out = {}
    for a, xs in own.items():
        n = defaultdict(int)
        for x in xs:
            for b in have.get(x, ()):
                n[b] += 1
        best = min(n, key=lambda b: (-n[b], b is not None, b or ""), default=0)
        if a is not None and best != 0 and n[best] * 100.0 / len(xs) >= least:
            out[a] = (best, n[best], n[best] * 100.0 / len(xs))
    return out


def made(letters, seed):
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.randrange(20, 400))) for _ in range(12)]
    contigs = [(f"b{i % 5}" if i % 6 else None, s) for i, s in enumerate(base)] + [("b9", "A" * 300), ("b0", None), ("b1", "")]
    reads = [(None, base[0]), (1, None), (2, ""), (3, "ACG"), (4, "A" * 200), (5, "T" * 9000)]
    for i in range(60):
        x, y = r.choice(base), r.choice(base)
        s = x[r.randrange(len(x)) :] + y[: r.randrange(len(y))]
        reads.append((10 + i % 50, s.translate(PAIRS)[::-1] if i % 3 == 0 else s))
    return reads, contigs


@pytest.mark.parametrize("letters", ["ACGT", "ACGTACGTACGTNacgtU-é"])
@pytest.mark.parametrize("k, canonical", [(1, True), (4, False), (9, True), (25, True), (31, True), (32, False), (40, True)])
def test_best_bundles_are_those_of_all_kmers(spark, monkeypatch, letters, k, canonical):
    reads, contigs = made(letters, k)
    for size in (kmers.LETTERS, 40):
        monkeypatch.setattr(kmers, "LETTERS", size)
        got = kmers.best_bundle(spark.createDataFrame(reads, "accession long, sequence string"), spark.createDataFrame(contigs, "bundle string, sequence string"), k, 10.0, canonical).collect()
        assert len(got) == len({r.accession for r in got}) and {r.accession: (r.bundle, r.shared, pytest.approx(r.percent)) for r in got} == plain(reads, contigs, k, 10.0, canonical)


def test_a_run_is_one_row():
    r = random.Random(1)
    text = "".join(r.choice("ACGT") for _ in range(50_000))
    parts, _, runs = kmers._runs([text, text[:30_000].translate(PAIRS)[::-1]], 25, True)
    assert sum(len(x) - 24 for x in runs) == 50_000 + 30_000 - 48 and sum(map(len, runs)) < 5 * 80_000 and len(set(parts)) > 1000
