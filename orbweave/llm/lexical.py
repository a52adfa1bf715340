"""Ranked lexical search by pipelined term partitioning.

The terms of the items are dealt over a few term owners, the rarest terms to
the first, so that each owner has about as many postings as another. A bundle
of items travels through the owners one after the other, once for each block of
documents: at every stage the bundle's sparse accumulators (item, document,
score so far) are cogrouped with the owner's postings of that block, and the
owner's integer contributions are added. After the last stage each bundle gives
its items' best documents of the block, and the best of all blocks follow.

On the way a bundle drops an accumulator only if it can't matter: with all that
the owners to come could add (a term adds less than its weight times
``MOST_IMPACT``) it stays below what ``k`` other documents of the same block
have already. The same documents and scores remain, and only the sum over a
block's accumulators travels on.

Documents are read once: a task turns each block (about ``BLOCK_BYTES`` of text)
into the postings of the items' terms, which are written and serve the term
counts as well as every stage. The items' terms go to all tasks; items are
therefore searched in rounds of about ``VOCABULARY`` terms, each a pass of its own.

Terms are maximal runs of letters, digits and bytes of other scripts, A-Z
lower-cased, known by 64-bit hashes (two terms meet with probability 2**-64 a
pair). Numbers are 64-bit integers but for a term's weight.

Defined results: a null text has no term; documents without a term count for
nothing; rows with a null ``doc_id`` or item id take no part; each row is a
document of its own, so repeated rows are listed as often as they occur; rows of
one item id are one item with the terms of all of them; an item without a
document of a score above 0 gives no row, nor do empty tables; other columns are
not read. Equal scores go by ascending ``doc_id``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbweave.llm.common import cut
from orbweave.llm.tokens import blocks, separators

K = 10
#: Term owners, items of a bundle, and terms that are searched in one round, about.
OWNERS, BUNDLE, VOCABULARY = 4, 256, 1 << 17
#: Text and documents of a block, at most (or one document).
BLOCK_BYTES, BLOCK_DOCS = 2 << 20, 8192
#: A posting's impact, 10**9 * tf div (1000 * tf + 8 * m), is smaller.
MOST_IMPACT = 1_000_000
#: Contributions made at a time.
ADDED = 1 << 20

# Bytes that end a term: ASCII but letters and digits.
_SEP = separators(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def _pack(*arrays: np.ndarray) -> bytes:
    return pa.compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), "zstd", asbytes=True)


def _unpack(data: bytes, n: int, *types: str) -> list[np.ndarray]:
    sizes = [n * np.dtype(t).itemsize for t in types]
    whole = pa.decompress(data, sum(sizes), "zstd", asbytes=True) if n else b""
    at = np.cumsum([0, *sizes])
    return [np.frombuffer(whole[lo:hi], t) for lo, hi, t in zip(at, at[1:], types)]


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Distinct (``item``, ``term``) of the items; a term is its hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = 0
            for block in blocks(batch.column(1), BLOCK_BYTES, _SEP):
                ids = batch.column(0).take(pa.array(lo + block.doc))
                lo += block.hi - block.lo
                yield pa.RecordBatch.from_arrays([ids, pa.array(block.hash.view(np.int64))], names=["item", "term"])

    one = items.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{text}`").cast("string").alias("text")).where("item is not null")
    return one.mapInArrow(run, f"item {one.schema['item'].dataType.simpleString()}, term long").distinct()


class Round:
    """The items of one round: their terms, and which items of which bundle hold a term."""

    def __init__(self, pairs: pa.Table, bundle: int = BUNDLE):
        ids = pairs.column("item").combine_chunks().dictionary_encode()
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.combine_chunks()
        self.ids, item = ids.dictionary, ids.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.terms, term = np.unique(np.asarray(pairs.column("term")).view(np.uint64), return_inverse=True)
        order = np.lexsort((item, term, item // bundle))
        #: By bundle and term: the items (numbered inside the bundle) that hold the term.
        self.item, self.term, self.bundle_of = (item % bundle)[order], term[order], (item // bundle)[order]
        self.bundles = -(-len(self.ids) // bundle)
        self.bundle = bundle

    def of(self, bundle: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = np.searchsorted(self.bundle_of, [bundle, bundle + 1])
        return self.term[lo:hi], self.item[lo:hi]

    def size(self, bundle: int) -> int:
        return min(self.bundle, len(self.ids) - bundle * self.bundle)


def _stored(docs: DataFrame, doc_id: str, text: str, terms: np.ndarray) -> DataFrame:
    """One row a block: its documents, their numbers of terms, and the postings (term, document, tf) of ``terms``, by term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(start, BLOCK_DOCS)
                ids = np.asarray(part.column(0))
                for block in blocks(part.column(1), BLOCK_BYTES, _SEP):
                    n = block.hi - block.lo
                    at = np.minimum(np.searchsorted(terms, block.hash), max(terms.size - 1, 0))
                    hit = np.flatnonzero(terms[at] == block.hash) if terms.size else np.zeros(0, np.int64)
                    place, tf = np.unique(at[hit] * n + block.doc[hit], return_counts=True)
                    row = {"block": number, "docs": n, "with_terms": int(np.count_nonzero(block.count)), "n_terms": int(block.count.sum()),
                           "doc_ids": _pack(ids[block.lo:block.hi].astype(np.int64), block.count.astype(np.int64)),
                           "posts": place.size, "post": _pack((place // n).astype(np.uint32), (place % n).astype(np.uint16), tf.astype(np.uint32))}
                    number += 1
                    yield pa.RecordBatch.from_pylist([row], STORED)

    one = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).where("doc_id is not null")
    return cut(one.mapInArrow(run, "block long, docs long, with_terms long, n_terms long, doc_ids binary, posts long, post binary"))


STORED = pa.schema([("block", pa.int64()), ("docs", pa.int64()), ("with_terms", pa.int64()), ("n_terms", pa.int64()),
                    ("doc_ids", pa.binary()), ("posts", pa.int64()), ("post", pa.binary())])


def _document_counts(stored: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term: a task sums its blocks up, Spark the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                total += np.bincount(_unpack(row["post"], row["posts"], "<u4", "<u2", "<u4")[0], minlength=terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    found = stored.select("posts", "post").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(terms, np.int64)
    out[np.asarray(found.column("term"))] = np.asarray(found.column("df"))
    return out


def weights(df: np.ndarray, n: int) -> np.ndarray:
    """floor(1000 * ln((2 * n + 2) / (2 * df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def owners_of(df: np.ndarray, owners: int) -> np.ndarray:
    """The owner of each term: rare terms first, about as many postings each."""
    order = np.argsort(df, kind="stable")
    upto = np.cumsum(df[order]) - df[order]
    out = np.zeros(df.size, np.int64)
    out[order] = upto * owners // max(1, int(df.sum()))
    return out


def _owner(stored: DataFrame, search: Round, mine: np.ndarray, n: int, length: int) -> DataFrame:
    """One owner's postings, a row for each block and bundle: (term, document, impact), for terms of the bundle only."""
    needs = []
    for b in range(search.bundles):
        need = np.zeros(mine.size, bool)
        need[search.of(b)[0]] = True
        needs.append(need & mine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                term, doc, tf = _unpack(row["post"], row["posts"], "<u4", "<u2", "<u4")
                some = mine[term]
                term, doc, tf = term[some], doc[some], tf[some].astype(np.int64)
                size = _unpack(row["doc_ids"], row["docs"], "<i8", "<i8")[1]
                # In parts, as 90 * n * N may pass 64 bits where neither n nor the result does.
                m = 10 + np.array([90 * int(s) * n // length for s in size.tolist()], np.int64) if length else np.zeros(0, np.int64)
                impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
                for b, need in enumerate(needs):
                    of = need[term]
                    if of.any():
                        post = _pack(term[of], doc[of], impact[of].astype(np.uint32))
                        yield pa.RecordBatch.from_arrays([pa.array([row["block"]]), pa.array([b], pa.int32()), pa.array([int(of.sum())]), pa.array([post], pa.binary())],
                                                         names=["o_block", "o_bundle", "posts", "post"])

    return stored.select("block", "docs", "doc_ids", "posts", "post").mapInArrow(run, "o_block long, o_bundle int, posts long, post binary")


def add(scores: np.ndarray, docs: int, held: tuple[np.ndarray, np.ndarray], weight: np.ndarray, post: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
    """Add an owner's contributions to the accumulators ``scores`` (item by document, flat).

    ``held``: terms, ascending, and the item that holds each; ``post``: terms, documents and impacts.
    """
    term, doc, impact = post
    lo, hi = np.searchsorted(held[0], term), np.searchsorted(held[0], term, side="right")
    times = hi - lo
    given = weight[term] * impact
    upto = np.cumsum(times)
    at = 0
    while at < term.size:
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + ADDED, side="right")))
        n = times[at:end]
        which = np.repeat(lo[at:end] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        np.add.at(scores, held[1][which] * docs + np.repeat(doc[at:end], n), np.repeat(given[at:end], n))
        at = end


def _stage(search: Round, weight: np.ndarray, later: np.ndarray, k: int, last: bool):  # noqa: ANN202
    """Adds one owner's contributions to a bundle's accumulators; ``later``: terms of owners to come."""
    def run(key: tuple, bundle: pa.Table, owner: pa.Table) -> pa.Table:
        if not bundle.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in (BEST if last else STATE)}, BEST if last else STATE)
        row = bundle.to_pylist()[0]
        docs, items, held = row["docs"], search.size(row["bundle"]), search.of(row["bundle"])
        scores = np.zeros(items * docs, np.int64)
        if row["held"]:
            place, score = _unpack(row["sums"], row["held"], "<u4", "<i8")
            scores[place] = score
        for post in owner.to_pylist():
            add(scores, docs, held, weight, _unpack(post["post"], post["posts"], "<u4", "<u2", "<u4"))
        grid = scores.reshape(items, docs)
        kth = np.partition(grid, docs - k, axis=1)[:, docs - k] if docs > k else np.zeros(items, np.int64)
        if last:
            ids = _unpack(row["doc_ids"], docs, "<i8", "<i8")[0]
            item, doc = np.nonzero((grid >= kth[:, None]) & (grid > 0))
            score = grid[item, doc]
            order = np.lexsort((ids[doc], -score, item))
            item, doc, score = item[order], doc[order], score[order]
            best = np.arange(item.size) - np.searchsorted(item, item) < k
            return pa.table([pa.array(item[best] + row["bundle"] * search.bundle), pa.array(ids[doc[best]]), pa.array(score[best])], BEST)
        rest = np.zeros(items, np.int64)
        np.add.at(rest, held[1], np.where(later[held[0]], weight[held[0]] * MOST_IMPACT, 0))
        place = np.flatnonzero((grid > 0) & (grid + rest[:, None] >= kth[:, None]))
        return pa.Table.from_pylist([row | {"held": place.size, "sums": _pack(place.astype(np.uint32), scores[place])}], STATE)

    return run


STATE = pa.schema([("block", pa.int64()), ("bundle", pa.int32()), ("docs", pa.int64()), ("doc_ids", pa.binary()), ("held", pa.int64()), ("sums", pa.binary())])
BEST = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _search(docs: DataFrame, search: Round, k: int, owners: int, doc_id: str, text: str) -> DataFrame:
    """(``item`` number, ``doc_id``, ``score``): each item's best ``k`` documents of every block."""
    stored = _stored(docs, doc_id, text, search.terms)
    whole = stored.agg(F.sum("with_terms").alias("n"), F.sum("n_terms").alias("length")).first()
    n, length = whole["n"] or 0, whole["length"] or 0
    df = _document_counts(stored, search.terms.size)
    weight, owner = weights(df, n), owners_of(df, owners)
    state = (stored.select("block", F.explode(F.sequence(F.lit(0), F.lit(search.bundles - 1))).alias("bundle"), "docs", "doc_ids",
                           F.lit(0).cast("long").alias("held"), F.lit(None).cast("binary").alias("sums")))
    for stage in range(owners):
        last = stage == owners - 1
        postings = _owner(stored, search, owner == stage, n, length)
        form = "item long, doc_id long, score long" if last else "block long, bundle int, docs long, doc_ids binary, held long, sums binary"
        state = (state.groupBy("block", "bundle").cogroup(postings.groupBy("o_block", "o_bundle"))
                 .applyInArrow(_stage(search, weight, owner > stage, k, last), form))
    return state


def rank(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
         owners: int = OWNERS, bundle: int = BUNDLE, vocabulary: int = VOCABULARY) -> DataFrame:
    """Each item's best ``k`` documents: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``."""
    spark = docs.sparkSession
    terms = cut(item_terms(items, item_id, item_text))
    total = terms.count()
    rounds = max(1, -(-total // vocabulary))
    found = []
    for r in range(rounds):
        # About ``vocabulary`` pairs of item and term, or one item's.
        search = Round(terms.where(F.pmod(F.xxhash64("item"), F.lit(rounds)) == r).toArrow(), bundle)
        if not len(search.ids):
            continue
        names = spark.createDataFrame(pa.table([pa.array(np.arange(len(search.ids))), search.ids], names=["__item", "item_id"]))
        best = _search(docs, search, k, owners, doc_id, text)
        found.append(_first(best, ["item"], k).join(F.broadcast(names), F.col("item") == F.col("__item")).select("item_id", "rank", "doc_id", "score"))
    if not found:
        kind = terms.schema["item"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)


def _first(rows: DataFrame, keys: list[str | Column], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
