import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from orbweave.llm import lm


def words(t):
    return re.findall(r"[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows):
    """Scores from dictionaries of counts."""
    def fold(i):
        return -1 if i is None else zlib.crc32(str(i).encode()) % lm.FOLDS

    def counts(docs):
        one, two = Counter(), Counter()
        for _, t in docs:
            tokens = [*words(t), None]
            one.update(tokens)
            two.update(zip([None, *tokens[:-1]], tokens, strict=True))
        return one, two, sum(one.values()), len(one)

    def estimates(text, one, two, n, v):
        tokens = [*words(text), None]
        for a, b in zip([None, *tokens[:-1]], tokens, strict=True):
            base = (one[b] + lm.ADD) / (n + lm.ADD * (v + 1))
            yield base, two[a, b] / max(one[a], 1), math.floor(math.log2(one[a])) + 1 if one[a] else 0, one[b]

    kept = counts([r for r in rows if fold(r[0]) not in (lm.HELD_OUT, lm.DELETED)])
    histogram = np.zeros((lm.BUCKETS + 1, lm.RATIO_BINS + 1))
    for i, t in rows:
        if fold(i) == lm.DELETED:
            for base, pair, bucket, _ in estimates(t, *kept):
                histogram[bucket, 1 + round(math.log2(pair / base) * lm.RATIO_STEP) + lm.RATIO_BINS // 2 if pair else 0] += 1
    weight = lm.weights(histogram)
    whole = counts([r for r in rows if fold(r[0]) != lm.HELD_OUT])
    for i, t in rows:
        parts = list(estimates(t, *whole))
        yield (i, fold(i) == lm.HELD_OUT, len(parts), sum(c > 0 for *_, c in parts), whole[2],
               sum(math.log10(b) for b, *_ in parts), sum(math.log10(weight[k] * p + (1 - weight[k]) * b) for b, p, k, _ in parts))


@pytest.mark.parametrize("limit", [lm.BLOCK_BYTES, 20_000])
def test_equals_counts_in_dictionaries(spark, limit):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r) for r in lm.score(docs, limit).collect()}
    assert len(got) == len(rows)
    for want in brute(rows):
        assert got[want[0]][:5] == want[:5]
        assert got[want[0]][5:] == pytest.approx(want[5:], rel=1e-9)


def test_odd_rows(odd_docs, no_docs):
    from .conftest import ODD

    got = lm.score(odd_docs).collect()
    want = list(brute(ODD))
    assert sorted(map(str, ((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got))) == sorted(
        map(str, ((*w[:5], round(w[5], 6)) for w in want)))
    assert lm.score(no_docs).count() == 0


def test_weights_climb_to_the_likeliest():
    histogram = np.zeros((lm.BUCKETS + 1, lm.RATIO_BINS + 1))
    histogram[5, 0], histogram[5, 1 + lm.RATIO_BINS // 2 + 3 * lm.RATIO_STEP] = 30, 70  # ratios 0 and 8
    w = lm.weights(histogram, 500)[5]
    grid = np.linspace(0.001, 0.999, 999)
    assert abs(w - grid[np.argmax(30 * np.log(1 - grid) + 70 * np.log(8 * grid + 1 - grid))]) < 0.002


def test_planes_round_trip():
    for values in (np.zeros(0, np.uint64), np.arange(5, dtype=np.int64), np.array([2**63, 7], np.uint64)):
        assert lm._grown(lm._shrunk(values), values.size, values.dtype).tolist() == values.tolist()
