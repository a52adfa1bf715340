"""Language-model scores by deleted interpolation of bigram and unigram estimates.

Text is lower-cased (A-Z) and cut into words at white space; each text ends
with one end token, which also stands before its first word. A text's score is

    sum over its tokens w after v of log10(l_b * c(v w) / c(v) + (1 - l_b) * p(w))

with the base estimate p(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)) and one weight
l_b for each bucket b = floor(log2 c(v)) of the context's frequency (0 for a
context never seen). The weights come from expectation-maximisation on counts
that were held out: a tenth of the training documents is deleted from the
counts, its tokens' estimates from the rest are gathered as a histogram by
bucket and ratio of the two estimates, and the weights that make it likeliest
are found on that. Scores then use the counts of all training documents.

How it runs: documents are put into blocks of about ``BLOCK_BYTES``; a block is
one compressed row, written once to the checkpoint folder. Each block sends its
distinct words and pairs, with its counts of them, to the owners of ranges of
the hash space; an owner adds up what it gets and sends each block the totals
of what it asked for. A block so needs only counts of what occurs in it, a
frequent word is one entry a block, and no table of all words or pairs is ever
in one place. ``BLOCK_BYTES`` follows the memory of a task: the larger a block,
the fewer pairs are sent twice.

Words and pairs are 64-bit hashes; two words of the corpus meet in one with a
probability of about (distinct words)**2 / 2**65.

Defined results: a null text is an empty text (its end token alone); repeated
rows count and are scored as often as they occur; a null ``doc_id`` trains and
is not held out; an empty training set gives every token the same estimate;
other columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbweave.llm.common import crc_fold, cut
from orbweave.llm.tokens import blocks, mix

#: Bytes of text in a block, about (a longer document is a block of its own).
BLOCK_BYTES = 12 << 20
ADD = 0.1
HELD_OUT, DELETED, FOLDS = 0, 1, 10  # folds of crc32(doc_id) mod 10
EM_STEPS = 60
#: Histogram of the ratio pair estimate / base estimate: bins of 1/16 octave around 1, the first for 0.
RATIO_BINS, RATIO_STEP = 1600, 16
#: log2 of a count is below 64.
BUCKETS = 64

_END = mix(np.array([0x454E44], np.uint64))[0]
_ZSTD = pa.Codec("zstd", compression_level=1)


def _shrunk(values: np.ndarray) -> bytes:
    """Integers, byte plane by byte plane, compressed."""
    raw = values.reshape(-1, 1).view(np.uint8).T.tobytes()
    return _ZSTD.compress(raw, asbytes=True) if raw else b""


def _grown(blob: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    raw = np.frombuffer(_ZSTD.decompress(blob, n * size, asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(kind).ravel()


def _pack_rows(ids: list, texts: list, folds: list, deleted: bool) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    rows = pa.record_batch([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(folds, pa.int32())], ["doc_id", "text", "fold"])
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    name = int.from_bytes(os.urandom(8), "little") >> 1
    return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([deleted]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "deleted", "docs"])


def into_blocks(docs: DataFrame, limit: int = BLOCK_BYTES) -> DataFrame:
    """(``block``, ``deleted``, ``docs``): documents in compressed rows; a block's documents are all deleted ones or none is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, tuple[list, list, list]] = {False: ([], [], []), True: ([], [], [])}
        size = {False: 0, True: 0}
        for batch in batches:
            fold = batch.column("fold").to_pylist()
            for i, text, f in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), fold, strict=True):
                kind = f == DELETED
                n = len(text or "")
                if size[kind] and size[kind] + n > limit:
                    yield _pack_rows(*held[kind], kind)
                    held[kind], size[kind] = ([], [], []), 0
                for part, value in zip(held[kind], (i, text or "", f), strict=True):
                    part.append(value)
                size[kind] += n + 1
        for kind, parts in held.items():
            if parts[0]:
                yield _pack_rows(*parts, kind)

    fold = F.coalesce(crc_fold(F.col("doc_id"), FOLDS), F.lit(-1)).cast("int")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("fold", fold)
            .mapInArrow(run, "block long, deleted boolean, docs binary"))


class _Tokens:
    """The tokens of a block's documents: hashes, contexts, pairs, and each document's fold."""

    def __init__(self, blob: bytes):
        rows = pa.ipc.open_stream(blob).read_all()
        self.ids = rows.column("doc_id").combine_chunks()
        self.fold = np.asarray(rows.column("fold"))
        col = rows.column("text").combine_chunks()
        n = len(col)
        parts = list(blocks(col))
        count = np.concatenate([b.count for b in parts]) if parts else np.zeros(0, np.int64)
        self.size = count + 1
        first = np.concatenate([[0], np.cumsum(self.size)])
        self.doc = np.repeat(np.arange(n), self.size)
        self.token = np.full(first[-1], _END, np.uint64)
        inside = np.ones(first[-1], bool)
        inside[first[1:] - 1] = False
        if parts:
            self.token[inside] = np.concatenate([b.hash for b in parts])
        self.context = np.empty_like(self.token)
        self.context[1:] = self.token[:-1]
        self.context[:1] = _END  # a document's first context is the end before it

    def kinds(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(distinct hashes, index of each token) of words and of pairs."""
        pairs = mix(self.context * np.uint64(0x9E3779B97F4A7C15) + mix(self.token))
        return [np.unique(x, return_inverse=True) for x in (self.token, pairs)]


def _asked(owners: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, deleted, blob in zip(*(batch.column(c).to_pylist() for c in ("block", "deleted", "docs")), strict=True):
                tokens = _Tokens(blob)
                trained = tokens.fold[tokens.doc] != HELD_OUT
                out = []
                for kind, (hashes, index) in enumerate(tokens.kinds()):
                    counts = np.bincount(index[trained], minlength=hashes.size).astype(np.uint32)
                    edges = np.searchsorted(hashes, (np.arange(1, owners, dtype=np.float64) / owners * 2.0**64).astype(np.uint64))
                    for owner, (lo, hi) in enumerate(zip([0, *edges], [*edges, hashes.size], strict=True)):
                        if hi > lo:
                            steps = np.diff(hashes[lo:hi], prepend=np.uint64(0))
                            out.append((block, deleted, kind, owner, int(hi - lo), _shrunk(steps), _shrunk(counts[lo:hi])))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                                                 names=["block", "deleted", "kind", "owner", "n", "hashes", "counts"])

    return run


ASKED = "block long, deleted boolean, kind int, owner int, n int, hashes binary, counts binary"
ANSWERED = "block long, deleted boolean, kind int, owner int, n int, kept binary, whole binary, tokens long, distinct long, kept_tokens long, kept_distinct long"


def _answer(group: pa.Table) -> pa.Table:
    """Totals of the hashes of one owner, for each block that asked; one more row has the owner's sums."""
    n = group.column("n").to_pylist()
    deleted = group.column("deleted").to_pylist()
    hashes = np.concatenate([np.cumsum(_grown(b, k, np.uint64), dtype=np.uint64) for b, k in zip(group.column("hashes").to_pylist(), n, strict=True)])
    counts = np.concatenate([_grown(b, k, np.uint32) for b, k in zip(group.column("counts").to_pylist(), n, strict=True)])
    of_deleted = np.repeat(deleted, n)
    distinct, index = np.unique(hashes, return_inverse=True)
    whole = np.bincount(index, counts, distinct.size).astype(np.int64)
    kept = np.bincount(index, np.where(of_deleted, 0, counts), distinct.size).astype(np.int64)
    ends = np.cumsum([0, *n])
    parts = [(_shrunk(kept[index[a:b]]), _shrunk(whole[index[a:b]])) for a, b in zip(ends, ends[1:], strict=False)]
    rows = group.num_rows
    sums = [int(whole.sum()), int((whole > 0).sum()), int(kept.sum()), int((kept > 0).sum())]
    cols = [[*group.column(c).to_pylist(), v] for c, v in (("block", -1), ("deleted", False), ("kind", group.column("kind")[0].as_py()), ("owner", group.column("owner")[0].as_py()), ("n", 0))]
    cols += [[*x, b""] for x in zip(*parts, strict=True)] + [[0] * rows + [s] for s in sums]
    types = [pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
    names = [x.split()[0] for x in ANSWERED.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)


def _block_counts(tokens: _Tokens, answers: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count of the token, of its context, of the pair) for each token of a block."""
    kinds = tokens.kinds()
    got = []
    for kind, (hashes, _) in enumerate(kinds):
        mine = sorted((o, n, b) for k, o, n, b in zip(*(answers.column(c).to_pylist() for c in ("kind", "owner", "n", column)), strict=True) if k == kind)
        counts = np.concatenate([_grown(b, n, np.int64) for _, n, b in mine]) if mine else np.zeros(0, np.int64)
        if counts.size != hashes.size:
            raise RuntimeError("a block's counts are not complete")
        got.append(counts)
    word, pair = kinds[0][1], kinds[1][1]
    end = np.searchsorted(kinds[0][0], _END)
    context = np.empty_like(word)
    context[1:], context[:1] = word[:-1], end
    return got[0][word], got[0][context], got[1][pair]


def _estimates(c: np.ndarray, cv: np.ndarray, cvw: np.ndarray, tokens: int, distinct: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base estimate, pair estimate, bucket) of each token."""
    base = (c + ADD) / (tokens + ADD * (distinct + 1))
    bucket = np.where(cv > 0, np.log2(np.maximum(cv, 1)).astype(np.int64) + 1, 0)
    return base, cvw / np.maximum(cv, 1), bucket


def _ratios(tokens: int, distinct: int):  # noqa: ANN202
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if block.num_rows:
            words = _Tokens(block.column("docs")[0].as_py())
            base, pair, bucket = _estimates(*_block_counts(words, answers, "kept"), tokens, distinct)
            at = np.zeros(base.size, np.int64)
            seen = pair > 0
            at[seen] = 1 + (np.round(np.log2(pair[seen] / base[seen]) * RATIO_STEP).astype(np.int64) + RATIO_BINS // 2).clip(0, RATIO_BINS - 1)
            cell, n = np.unique(bucket * (RATIO_BINS + 1) + at, return_counts=True)
        else:
            cell = n = np.zeros(0, np.int64)
        return pa.table({"bucket": pa.array(cell // (RATIO_BINS + 1)), "bin": pa.array(cell % (RATIO_BINS + 1)), "n": pa.array(n)})

    return run


def weights(histogram: np.ndarray, steps: int = EM_STEPS) -> np.ndarray:
    """The likeliest weight of the pair estimate of each bucket, by expectation-maximisation."""
    ratio = np.concatenate([[0.0], 2.0 ** ((np.arange(RATIO_BINS) - RATIO_BINS // 2) / RATIO_STEP)])
    total = histogram.sum(1)
    weight = np.full(BUCKETS + 1, 0.5)
    for _ in range(steps):
        share = weight[:, None] * ratio
        share = share / (share + 1 - weight[:, None])
        weight = np.where(total > 0, (histogram * share).sum(1) / np.maximum(total, 1), weight)
        weight = weight.clip(1e-6, 1 - 1e-6)  # a word never seen after its context keeps some probability
    weight[0] = 0.0
    return weight


def _scored(tokens: int, distinct: int, weight: np.ndarray):  # noqa: ANN202
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        names = {"doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "train_tokens": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
        if not block.num_rows:
            return pa.table({k: pa.array([], t) for k, t in names.items()})
        words = _Tokens(block.column("docs")[0].as_py())
        c, cv, cvw = _block_counts(words, answers, "whole")
        base, pair, bucket = _estimates(c, cv, cvw, tokens, distinct)
        mixed = weight[bucket] * pair + (1 - weight[bucket]) * base
        n = len(words.size)
        cols = [words.ids, words.fold == HELD_OUT, words.size, np.bincount(words.doc[c > 0], minlength=n), np.full(n, tokens),
                np.bincount(words.doc, np.log10(base), n), np.bincount(words.doc, np.log10(mixed), n)]
        return pa.table([pa.array(x, t) for x, t in zip(cols, names.values(), strict=True)], names=list(names))

    return run


def score(docs: DataFrame, limit: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``; the model learns from the documents that aren't held out."""
    held = cut(into_blocks(docs, limit))
    owners = max(4, held.count())
    asked = held.mapInArrow(_asked(owners), ASKED)
    answers = cut(asked.groupBy("kind", "owner").applyInArrow(_answer, ANSWERED))
    sums = answers.where("block = -1 and kind = 0").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "distinct", "kept_tokens", "kept_distinct"))).first()
    answers = answers.where("block <> -1").select("block", "deleted", "kind", "owner", "n", "kept", "whole")
    # At most BUCKETS x RATIO_BINS rows, whatever the input.
    cells = (held.where("deleted").select("block", "docs").groupBy("block")
             .cogroup(answers.where("deleted").select("block", "kind", "owner", "n", "kept").groupBy("block"))
             .applyInArrow(_ratios(sums["kept_tokens"], sums["kept_distinct"]), "bucket long, bin long, n long")
             .groupBy("bucket", "bin").agg(F.sum("n").alias("n")).collect())
    histogram = np.zeros((BUCKETS + 1, RATIO_BINS + 1))
    for r in cells:
        histogram[r["bucket"], r["bin"]] = r["n"]
    return (held.select("block", "docs").groupBy("block")
            .cogroup(answers.select("block", "kind", "owner", "n", "whole").groupBy("block"))
            .applyInArrow(_scored(sums["tokens"], sums["distinct"], weights(histogram)),
                          "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
