import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orbweave.llm import packing


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=12))
def test_plan_places_each_length_once(histogram):
    patterns = packing.plan(histogram, 64)
    placed = {}
    for pattern, n in patterns:
        assert sum(pattern) <= 64 and n > 0
        for length in pattern:
            placed[length] = placed.get(length, 0) + n
    assert placed == histogram
    spots = packing.slots(patterns)
    for length, n in histogram.items():
        ranges = sorted((lo, hi) for k, lo, hi, _, _ in spots if k == length)
        assert ranges[0][0] == 0 and ranges[-1][1] == n and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_shortest_pack_first():
    assert packing.plan({6: 1, 5: 1, 3: 1}, 10) == [((6,), 1), ((5, 3), 1)]


def check(rows, texts):
    """Every id of every document lies in exactly one piece, sequences have no gaps."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in texts}
    at = {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    want = sorted((str(i), s) for i, _ in texts for s in range(0, len(ids[i]), packing.SEQUENCE))
    assert sorted((str(r["doc_id"]), r["start"]) for r in rows) == want
    total = 0
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.SEQUENCE
        total += end if end & (end - 1) == 0 else packing.SEQUENCE
    return total, sum(len(ids[i]) for i, _ in texts)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    padded, tokens = check(packing.pack(docs).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert padded <= 1.02 * tokens


def test_odd_rows(odd_docs, no_docs):
    from .conftest import ODD

    check(packing.pack(odd_docs).collect(), ODD)
    assert packing.pack(no_docs).count() == 0


def test_white_space_and_special_strings(make_docs):
    texts = [(i, t) for i, t in enumerate(["a  b", " a", "a ", "a\n b", "a \n b", "a\n\n  b c", "  x", "<|endoftext|> y<|endoftext|>", "it's   12 34", "é ß 東京 \t z", "\x85 a"])]
    check(packing.pack(make_docs(texts)).collect(), texts)


def test_very_long_runs(make_docs):
    texts = [(1, "a" + " " * 1_500_000 + "b"), (2, "\n" * 1_200_000), (3, "x" * 300_000), (4, "12" * 100_000)]
    check(packing.pack(make_docs(texts)).collect(), texts)


def test_many_equal_rows(make_docs):
    """Equal rows are dealt over places and ranked once each."""
    texts = [(7, "the same words again")] * 400 + [(i, "other words " * (i % 5)) for i in range(100, 160)]
    check(packing.pack(make_docs(texts).repartition(5)).collect(), texts)
    ranks = packing.ranked(packing.pieces(make_docs(texts).repartition(5))).where("doc_id = 7").collect()
    assert sorted(r["rank"] - min(r["rank"] for r in ranks) for r in ranks) == list(range(len(ranks)))
