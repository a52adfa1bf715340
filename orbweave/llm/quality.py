"""Quality scores by histogram gradient-boosted trees over document statistics.

``statistics`` turns a text into ``FEATURES`` numbers (character classes, word
shapes, repetition of words, word pairs and lines); nothing else of a row is an
input. Trees are grown on the driver from a bounded labelled sample
(``TRAIN_DOCS``): feature values are binned by quantiles, each level of a tree
takes the best split of each node from gradient histograms (logistic loss), and
the finished trees are flattened into arrays, which numpy traverses for all
documents of a batch at once.

Defined results: a null text is an empty text and gets the score of all-zero
statistics; repeated rows are scored one by one, and of rows with one labelled
``doc_id`` that with the least statistics is learnt from; rows with a null ``doc_id``
are scored and are not held out; without labels of both kinds every score is
the label's mean (0.5 without labels); other columns are neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbweave.llm.common import crc_fold, labelled_sample
from orbweave.llm.tokens import Block, blocks, gram_hashes, word_hashes, word_spans

#: Labelled documents used for training, at most.
TRAIN_DOCS = 20_000
TREES, DEPTH, RATE, BINS, RIDGE, MIN_CHILD = 80, 4, 0.15, 64, 1.0, 5.0

_UPPER, _LOWER, _DIGIT, _SPACE, _NEWLINE, _STOP, _SYMBOL, _WIDE = range(8)
_CLASS = np.full(256, _SYMBOL, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = _UPPER, _LOWER, _DIGIT, _WIDE
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10] = _SPACE, _NEWLINE
_CLASS[[ord(c) for c in ".,;:?'\"-()"]] = _STOP
_LINE = np.zeros(256, bool)
_LINE[10] = True

FEATURES = ("log_chars", "log_words", "upper", "lower", "digit", "space", "newline", "stop", "symbol", "wide",
            "word_length", "word_length_sd", "longest_word", "capital_words", "upper_words", "symbol_ends", "stop_ends", "one_byte_words",
            "distinct_words", "top_word", "same_neighbours", "distinct_pairs", "distinct_runs", "log_lines", "distinct_lines", "line_words")


def _distinct(value: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, largest count of one value) of each document; ``doc`` ascends."""
    if not value.size:
        return np.zeros(n), np.zeros(n)
    key = np.sort((doc.astype(np.uint64) << np.uint64(40)) | (value >> np.uint64(24)))
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    run = np.diff(np.append(first, key.size))
    at = (key[first] >> np.uint64(40)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, at, run)
    return np.bincount(at, minlength=n).astype(float), top


def statistics(block: Block) -> np.ndarray:
    """(documents x FEATURES) of a block."""
    n = block.hi - block.lo
    size = np.diff(block.off)
    owner = np.repeat(np.arange(n), size)
    kinds = np.bincount(owner * 8 + _CLASS[block.data], minlength=8 * n).reshape(n, 8).astype(float)
    chars = np.maximum(size, 1)[:, None]
    words, doc, length = block.count, block.doc, (block.ends - block.starts).astype(float)
    per = np.maximum(words, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(doc[mask], minlength=n) / per

    mean = np.bincount(doc, length, n) / per
    spread = np.sqrt(np.maximum(np.bincount(doc, length * length, n) / per - mean * mean, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    if doc.size:
        head, tail = _CLASS[block.data[block.starts]], _CLASS[block.data[block.ends - 1]]
        lower = np.add.reduceat(np.append(_CLASS[block.data] == _LOWER, False).astype(np.int64), np.column_stack([block.starts, block.ends]).ravel())[::2]
    else:
        head = tail = lower = np.zeros(0, np.int64)
    distinct, top = _distinct(block.hash, doc, n)
    same = np.zeros(n)
    pairs, runs = [np.zeros(n), np.zeros(n)], [np.zeros(n), np.zeros(n)]
    for k, out in ((2, pairs), (4, runs)):
        if doc.size >= k:
            inside = doc[:doc.size - k + 1] == doc[k - 1:]
            out[0], _ = _distinct(gram_hashes(block.hash, k)[inside], doc[:doc.size - k + 1][inside], n)
            out[1] = np.bincount(doc[:doc.size - k + 1][inside], minlength=n)
    if doc.size > 1:
        again = (block.hash[1:] == block.hash[:-1]) & (doc[1:] == doc[:-1])
        same = np.bincount(doc[1:][again], minlength=n) / per
    starts, ends, line_doc = word_spans(block.data, block.off, _LINE)
    lines = np.bincount(line_doc, minlength=n)
    fresh, _ = _distinct(word_hashes(block.data, starts, ends), line_doc, n)
    return np.column_stack([
        np.log1p(size), np.log1p(words), kinds[:, :8] / chars,
        mean, spread, np.log1p(longest), share(head == _UPPER), share((head == _UPPER) & (lower == 0) & (length > 1)),
        share(tail == _SYMBOL), share(tail == _STOP), share(length == 1),
        distinct / per, top / per, same, pairs[0] / np.maximum(pairs[1], 1), runs[0] / np.maximum(runs[1], 1),
        np.log1p(lines), fresh / np.maximum(lines, 1), np.log1p(words / np.maximum(lines, 1)),
    ])


@dataclass(frozen=True)
class Forest:
    """Complete trees as arrays: split ``feature`` and ``cut`` by inner node (children of i: 2i+1, 2i+2), ``leaf`` values."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.start)
        row = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[row, feature[node]] > cut[node])
            margin += leaf[node - (2**DEPTH - 1)]
        return 0.5 * (1.0 + np.tanh(0.5 * margin))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Forest:
    """Boost ``trees`` trees on a (bounded) sample."""
    n, width = x.shape if x.size else (0, len(FEATURES))
    inner = 2**DEPTH - 1
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
    start = float(np.log(mean / (1 - mean)))
    if not n or y.min() == y.max():
        none = np.zeros((0, inner))
        return Forest(none.astype(np.int64), none, np.zeros((0, inner + 1)), start)
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS, method="nearest")) for f in range(width)]
    bins = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    margin = np.full(n, start)
    out = [], [], []
    for _ in range(trees):
        p = 0.5 * (1.0 + np.tanh(0.5 * margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            low, count = 2**level - 1, 2**level
            gain = np.zeros(count)
            for f in range(width):
                if not len(edges[f]):
                    continue
                cell = (node - low) * BINS + bins[:, f]
                g = np.bincount(cell, grad, count * BINS).reshape(count, BINS)
                h = np.bincount(cell, hess, count * BINS).reshape(count, BINS)
                gl, hl = g.cumsum(1), h.cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                won = gl**2 / (hl + RIDGE) + (gt - gl)**2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                won[(hl < MIN_CHILD * 0.1) | (ht - hl < MIN_CHILD * 0.1)] = 0
                won = won[:, :len(edges[f])]
                best = won.argmax(1)
                better = won[np.arange(count), best] > gain + 1e-9
                gain = np.where(better, won[np.arange(count), best], gain)
                feature[low:low + count][better] = f
                cut[low:low + count][better] = edges[f][best[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        at = node - inner
        leaf = RATE * np.bincount(at, grad, inner + 1) / (np.bincount(at, hess, inner + 1) + RIDGE)
        margin += leaf[at]
        for parts, part in zip(out, (feature, cut, leaf), strict=True):
            parts.append(part)
    return Forest(*(np.array(part) for part in out), start)


def _features(col: pa.Array) -> np.ndarray:
    parts = [statistics(block) for block in blocks(col)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Forest:
    """Fit on at most ``train_docs`` documents of ``docs`` labelled in ``labels`` (columns ``doc_id``, ``quality``)."""
    sample = F.broadcast(labelled_sample(labels, "quality", train_docs))  # at most train_docs rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(sample, "doc_id")
            .mapInArrow(run, "doc_id long, label int, x array<double>")
            .groupBy("doc_id").agg(F.min(F.struct("x", "label")).alias("r")).select("doc_id", "r.label", "r.x").toArrow())  # at most train_docs rows
    x = np.array(rows["x"].combine_chunks().flatten()).reshape(-1, len(FEATURES)) if rows.num_rows else np.zeros((0, len(FEATURES)))
    ids, y = np.array(rows["doc_id"]), (np.array(rows["label"]) > 0).astype(float)
    order = np.argsort(ids)
    return grow(x[order], y[order])


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``score`` (0 to 1), ``predicted`` (score >= 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)  # TREES trees of 2**DEPTH leaves

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = shared.value.score(_features(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double, predicted int"))


def held_out_scores(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Train on the labels outside a crc32 fold of the id, score every document, and mark the fold as ``held_out``."""
    key = crc_fold(F.col("doc_id"), folds)
    forest = train(docs, labels.where(key != fold), train_docs)
    return score(docs, forest).select("doc_id", F.coalesce(key == fold, F.lit(False)).alias("held_out"), "score", "predicted")
