"""Benchmark decontamination: a counting filter that misses no alignment, Smith-Waterman as proof.

Words are lower-cased (A-Z) and cut at white space. The words of a test item are
aligned with those of a document (local alignment: match ``MATCH``, mismatch
and gap ``-1``). The score is the alignment's, divided by that of the whole
item with itself: 1 for a copy, less by edits. From ``MIN_SCORE`` on the
document is contaminated by the item, and also if the alignment scores as much
as ``QUOTED`` words in a row, whatever part of a long item that is.

Only the places that can reach that score are aligned, and all of them are. An
alignment of m matched words, b pairs of which are neighbours in both texts, has
m - b - 1 edits or more, so it scores m + b + 1 at most: a score of t takes t - 1
of the item's n words and n - 1 pairs of neighbours, within 3 n - t words of the
document. Any k more of these features than an alignment may lack hold k that
it has. The rarest are taken (by the number of documents that each occurs in;
those that occur nowhere come first), and where a document has k of them within
reach it is aligned. Items shorter than ``SHORT`` words count where they
stand whole.

Test items are the stated set against all documents: they are taken in blocks
of about ``ITEM_BYTES`` of text (a bounded broadcast), and each block makes two
passes over the documents, which are not shuffled.

Defined results: null or empty texts share nothing; items without words are
skipped; different items with the same id are aligned one by one; rows with a null ``doc_id`` or ``item_id`` are compared and keep it;
repeated rows are found one by one; empty tables give no pairs; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbweave.llm.tokens import Block, blocks, gram_hashes

#: Items of fewer words must stand in a document whole.
SHORT = 4
MATCH = 2
MIN_SCORE = 0.5
#: An alignment that scores as much as a copy of so many words contaminates too, however long the item is.
QUOTED = 25
#: Bytes of item text that one pass carries, about.
ITEM_BYTES = 4 << 20


@dataclass
class Items:
    """Items' word hashes, and their features as sorted arrays by length of gram: (length, hashes, item).

    An alignment of the score ``least`` (not divided) or more lacks at most ``spare`` of its features and is at most ``span`` words long.
    """

    ids: list
    words: list[np.ndarray]
    grams: list[tuple[int, np.ndarray, np.ndarray]]
    least: np.ndarray
    spare: np.ndarray
    span: np.ndarray
    #: How many of the features must lie within reach.
    hits: np.ndarray

    @staticmethod
    def of(ids: list, texts: list[str | None], least: float, quoted: int) -> Items:
        words: list[np.ndarray] = []
        for block in blocks(pa.array(texts, pa.string())):
            words += [block.hash[a:b] for a, b in zip(block.first, block.first[1:], strict=False)]
        size = np.array([w.size for w in words], np.int64)
        score = np.minimum(np.ceil(least * MATCH * size).astype(np.int64), MATCH * quoted)
        whole = size < SHORT
        need = np.where(whole, 1, np.maximum(score - 1, 1))
        found: dict[int, list[tuple[np.ndarray, int]]] = {}
        for i, w in enumerate(words):
            for n in ((w.size,) if whole[i] else (1, 2)) if w.size else ():
                found.setdefault(n, []).append((gram_hashes(w, n), i))
        grams = []
        for n, parts in sorted(found.items()):
            h = np.concatenate([g for g, _ in parts])
            item = np.concatenate([np.full(g.size, i) for g, i in parts])
            order = np.lexsort((item, h))
            grams.append((n, h[order], item[order]))
        return Items(ids, words, grams, score, np.where(whole, 0, 2 * size - 1 - need), np.maximum(3 * size - score, 1), need)


def _hits(grams: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index in ``grams``, first index in the sorted ``wanted``) of the grams that are wanted."""
    at = np.searchsorted(wanted, grams).clip(max=wanted.size - 1)
    hit = np.flatnonzero(wanted[at] == grams)
    return hit, at[hit]


def _frequencies(docs: DataFrame, items: Items) -> list[np.ndarray]:
    """In how many documents each gram occurs."""
    shared = docs.sparkSession.sparkContext.broadcast([(n, np.unique(h)) for n, h, _ in items.grams])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(h.size, np.int64) for _, h in shared.value]
        for batch in batches:
            for block in blocks(batch.column("text")):
                for (n, wanted), count in zip(shared.value, total, strict=True):
                    h, doc = block.grams(n)
                    hit, at = _hits(h, wanted)
                    pairs = np.unique(doc[hit] * np.int64(wanted.size) + at)
                    count += np.bincount(pairs % wanted.size, minlength=wanted.size)
        for k, count in enumerate(total):
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(at.size, k)), pa.array(at), pa.array(count[at])], names=["k", "at", "n"])

    out = [np.zeros(h.size, np.int64) for _, h in shared.value]
    # At most one row for each distinct gram of the block of items.
    for r in docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "k long, at long, n long").groupBy("k", "at").agg(F.sum("n").alias("n")).collect():
        out[r["k"]][r["at"]] = r["n"]
    return [count[np.searchsorted(np.unique(h), h)] for count, (_, h, _) in zip(out, items.grams, strict=True)]


def rarest(items: Items, frequencies: list[np.ndarray]) -> Items:
    """``items`` with their rarest features: as many as an alignment may lack, and a quarter of those that it needs (one at least)."""
    item = np.concatenate([i for _, _, i in items.grams])
    hits = np.maximum(items.hits // 4, 1)
    order = np.lexsort((np.concatenate(frequencies), item))
    nth = np.arange(order.size) - np.searchsorted(item[order], item[order])
    keep = np.zeros(order.size, bool)
    keep[order] = nth < (items.spare + hits)[item[order]]
    out, begin = [], 0
    for n, h, i in items.grams:
        part = keep[begin:begin + h.size]
        begin += h.size
        if part.any():
            out.append((n, h[part], i[part]))
    return replace(items, grams=out, hits=hits)


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """(score, end in ``words``) of the best local alignment."""
    at = np.arange(1, words.size + 1)
    row = np.zeros(words.size + 1, np.int64)
    best, end = 0, 0
    for w in item:
        cell = np.maximum(row[:-1] + np.where(words == w, MATCH, -1), row[1:] - 1)
        np.maximum(cell, 0, out=cell)
        cell = np.maximum.accumulate(cell + at) - at  # gaps along the row
        row[1:] = cell
        top = int(cell.argmax())
        if cell[top] > best:
            best, end = int(cell[top]), top + 1
    return best, end


def _places(block: Block, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item, word) from which on the document has enough of the item's features within reach, in this order."""
    keys = [np.zeros(0, np.int64)]
    for n, wanted, item in items.grams:
        h, _ = block.grams(n)
        hit, first = _hits(h, wanted)
        if not hit.size:
            continue
        many = np.searchsorted(wanted, h[hit], side="right") - first
        index = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        at = np.flatnonzero(block.doc[:block.hash.size - n + 1] == block.doc[n - 1:])[hit]  # the gram's first word
        keys.append((item[index].astype(np.int64) << 32) + np.repeat(at, many))
    key = np.sort(np.concatenate(keys))
    item, word = key >> 32, key & 0xFFFFFFFF
    last = np.arange(key.size) + items.hits[item] - 1
    go = np.flatnonzero(last < key.size)
    go = go[key[last[go]] - key[go] < items.span[item[go]]]
    go = go[block.doc[word[last[go]]] == block.doc[word[go]]]
    item, word = item[go], word[go]
    order = np.lexsort((word, item, block.doc[word]))
    return block.doc[word[order]], item[order], word[order]


def _found(block: Block, items: Items, memory: dict) -> Iterator[tuple[int, int, float, int]]:
    """(document, item, score, end word) of the contaminated documents of a block."""
    doc, item, word = _places(block, items)
    if not doc.size:
        return
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])))
    for a, b in zip(new, np.append(new[1:], doc.size), strict=True):
        d, i = int(doc[a]), int(item[a])
        words, span = items.words[i], int(items.span[i])
        lo, hi = int(block.first[d]), int(block.first[d + 1])
        top, top_end = 0, 0
        # Places whose reaches meet are aligned as one part.
        cuts = np.flatnonzero(np.diff(word[a:b]) > 2 * span) + 1
        for near in np.split(word[a:b], cuts):
            left, right = max(lo, int(near[0]) - span), min(hi, int(near[-1]) + span + 1)
            part = block.hash[left:right]
            key = (i, part.tobytes()) if part.size <= 8 * span else None
            if key in memory:
                s, end = memory[key]
            else:
                s, end = align(words, part)
                if key:
                    if len(memory) > 20_000:
                        memory.clear()
                    memory[key] = s, end
            if s > top:
                top, top_end = s, left + end - lo
        if top >= items.least[i]:
            yield d, i, top / (MATCH * words.size), int(top_end)


def _item_blocks(benchmark: DataFrame, limit: int, least: float, quoted: int) -> Iterator[Items]:
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null").dropDuplicates()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    n = max(1, -(-size // limit))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        items = Items.of([r["item_id"] for r in part], [r["text"] for r in part], least, quoted)
        if items.grams:
            yield items


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = MIN_SCORE, item_bytes: int = ITEM_BYTES, quoted: int = QUOTED) -> DataFrame:
    """Pairs ``doc_id``, ``item_id``, ``score``, ``end_word`` (of the best alignment) of score ``least`` or more, or of ``quoted`` words or more."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    form = "doc_id long, item_id long, score double, end_word long"
    out = None
    for items in _item_blocks(benchmark, item_bytes, least, quoted):
        shared = docs.sparkSession.sparkContext.broadcast(rarest(items, _frequencies(rows, items)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            memory: dict = {}
            for batch in batches:
                for block in blocks(batch.column("text")):
                    found = list(_found(block, shared.value, memory))
                    ids = batch.column("doc_id")
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array([block.lo + f[0] for f in found], pa.int64())), pa.array([shared.value.ids[f[1]] for f in found], pa.int64()),
                         pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.int64())], names=["doc_id", "item_id", "score", "end_word"])

        part = rows.mapInArrow(run, form)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], form)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = MIN_SCORE, item_bytes: int = ITEM_BYTES, quoted: int = QUOTED) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, unchanged.

    Only texts go to Python, and only the verdicts come back; the rows stay with
    Spark. Each block of items counts its words over all of ``docs``.
    """
    out = docs
    for items in _item_blocks(benchmark, item_bytes, least, quoted):
        out = out.where(_clean(docs.sparkSession.sparkContext.broadcast(rarest(items, _frequencies(docs, items))))(F.col("text").cast("string")))
    return out


def _clean(shared: Broadcast):  # noqa: ANN202
    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memory: dict = {}
        for some in texts:
            keep = np.ones(len(some), bool)
            for block in blocks(some):
                for d, *_ in _found(block, shared.value, memory):
                    keep[block.lo + d] = False
            yield pa.array(keep)

    return F.arrow_udf(clean, "boolean")
