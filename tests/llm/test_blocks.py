import random
import re

import numpy as np
import pyarrow as pa
import pytest

from loomgene.llm import blocks
from tests.llm import brute

TEXTS = ["", None, "a", " a b", "ab", "c  d\n", "é🙂 x-y", "Word" * 40, " ", "a b c d e f g h", "tail"]


@pytest.mark.parametrize("part", [1 << 20, 7, 1])
def test_words_in_parts(monkeypatch, part):
    whole = blocks.Words(pa.array(TEXTS), blocks.SPACED, lower=True)
    grams = whole.grams(3)
    monkeypatch.setattr(blocks, "PART", part)
    w = blocks.Words(pa.array(TEXTS), blocks.SPACED, lower=True)
    want = [x for t in TEXTS for x in brute.SPACED.findall((t or "").translate(brute.LOWER))]
    raw = w.buf.tobytes()
    assert [raw[a:z].decode() for a, z in zip(w.starts, w.ends, strict=True)] == want
    assert (w.hashes == whole.hashes).all() and all((x == y).all() for x, y in zip(w.grams(3), grams, strict=True))
    assert len(set(w.hashes.tolist())) == len(set(want))
    assert np.diff(w.first).tolist() == [len(brute.SPACED.findall(t or "")) for t in TEXTS]


def test_random_tables(monkeypatch):
    rnd = random.Random(1)
    for _ in range(30):
        texts = ["".join(rnd.choice("ab .é") for _ in range(rnd.randint(0, 30))) for _ in range(rnd.randint(1, 6))]
        monkeypatch.setattr(blocks, "PART", rnd.randint(1, 40))
        w = blocks.Words(pa.array(texts), blocks.ALNUM, lower=False)
        raw = w.buf.tobytes()
        assert [raw[a:z].decode() for a, z in zip(w.starts, w.ends, strict=True)] == [x for t in texts for x in brute.ALNUM.findall(t)]
        assert w.doc.tolist() == [i for i, t in enumerate(texts) for _ in re.findall(r"[^ .]+", t)]
