"""The BPE cache keeps what is used through its turns, and ids stay the library's."""

import random
import struct
from collections import Counter

import pytest
from seqloom.llm import bpe
from seqloom.llm.queries import tokenizer_path


@pytest.mark.parametrize("other", ["", " «ſtraße» ÅNGSTRÖM’s 你好 "])
def test_frequent_words_are_encoded_once(monkeypatch, other):
    made, piece = Counter(), bpe.TreeEncoder._piece
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 120)
    monkeypatch.setattr(bpe.TreeEncoder, "_piece", lambda self, p: made.update([p]) or piece(self, p))
    e, r = bpe.TreeEncoder(tokenizer_path()), random.Random(3)
    words = ["".join(r.choice("aeioubcdrst") for _ in range(9)) for _ in range(900)]
    texts = [f"Often, déjà 7{w}{'!' * (1 + i % 70)} {w}{other if i % 3 else ''} often" for i, w in enumerate(words)] + ["x" * 5000 + " " + "?" * 5000, "", "often"]
    got = [list(struct.unpack(f"<{len(b) // 4}I", b)) for lo in range(0, len(texts), 25) for b in e.encode_batch(texts[lo : lo + 25])]
    assert got == [x.ids for x in e.tok.encode_batch(texts, add_special_tokens=False)]
    assert len(e.cache) + len(e.cache.older) < 1000 and (other or made["often"] == 1)
