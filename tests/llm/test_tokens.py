import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from orbweave.llm.tokens import blocks, separators

TEXT = st.text(alphabet="aBÉé \t\n\r\x0b\x0cz.,ſ ", max_size=40)


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.integers(1, 60))
def test_words_equal_a_regex(texts, limit):
    words = [re.findall(r"[^\x20\x09-\x0d]+", lowered(t or "")) for t in texts]
    known: dict[int, str] = {}
    count = []
    for b in blocks(pa.array(texts, pa.string()), limit):
        count += b.count.tolist()
        for h, w in zip(b.hash.tolist(), [w for ws in words[b.lo:b.hi] for w in ws], strict=True):
            assert known.setdefault(h, w) == w
    assert count == [len(w) for w in words]
    assert len(set(known.values())) == len(known)


def test_grams_stay_inside_documents():
    (b,) = blocks(pa.array(["a b c", "", "a b", "c"]))
    h, doc = b.grams(2)
    assert doc.tolist() == [0, 0, 2] and h[0] == h[2] != h[1]


def test_sliced_and_empty_arrays():
    whole = pa.array(["x", "a b", None, "c"])
    assert [b.count.tolist() for b in blocks(whole.slice(1, 3))] == [[2, 0, 1]]
    assert list(blocks(pa.array([], pa.string()))) == []


def test_own_separators():
    (b,) = blocks(pa.array(["idiot. idiot"]), sep=separators(b"."))
    assert b.hash[0] == b.hash[1] and b.hash.dtype == np.uint64
