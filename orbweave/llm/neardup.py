"""Near-duplicate classes: consistent weighted sampling of TF-IDF shingles, bands, weighted Jaccard.

A document's elements are its distinct shingles of ``SHINGLE`` successive words
(lower-cased A-Z, cut at white space; a shorter document is one shingle). An
element's weight is its count times the mean inverse document frequency of its
words, rounded to a quarter octave. Document frequencies cover all documents;
they are kept by word hash in ``DF_CELLS`` cells, so the table that goes to the
tasks has a fixed size. (A shingle's own frequency counts its copies: with it
the shared part of a large group of copies would weigh least.)

Signatures are improved consistent weighted sampling: for each of
``BANDS * ROWS`` samples an element draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) from its
hash, t = floor(ln w / r + b), y = exp(r (t - b)), a = c / (y exp(r)), and the
element with the least a is the sample. The draws come from a table of 65,536
triples; ties of a go to the smaller element hash.

Documents with equal word sequences are one text. Texts that agree in a band
share a bucket. Weight that a text shares with no other text of any bucket is
lonely: a pair's common weight is at most each side's weight that isn't (also
within each of ``PARTS`` hashed parts of the elements), which bounds the pair's
similarity; pairs below the threshold by that bound are never compared. Each text is compared with ``LEADERS`` members of
each of its buckets, those with the least lonely share, which is linear in the
bucket; links are pairs of weighted Jaccard similarity ``THRESHOLD`` or more, and
classes are the connected parts. Buckets that then still hold texts of several
classes are finished: of the pairs across classes all are compared that the
bound and the distances to the bucket's first leader allow (1 - similarity is
a metric, so linked members' distances differ by at most 1 - THRESHOLD). So no
link between members of a bucket is lost that could join two classes, and
groups of copies are not expanded.

A bucket may hold a third of all texts. One of more than ``HOT_ROWS`` members and
more than one ``HOT_SHARE``-th of all memberships (so there are fewer than
``HOT_SHARE`` such buckets, and their list is broadcast) is dealt by salt: its
members are spread by hash, what is one row a bucket is repeated for each salt.
What a bucket has left to finish is cut into sub-blocks of about ``SUB_BLOCK`` members,
and each pair of sub-blocks is compared in a place of its own.

Defined results: a null text is an empty text, and all texts without words are
copies of each other; rows that share a ``doc_id`` are one document (their texts
are linked); rows with a null ``doc_id`` have a null class and are never
dropped; the class id is the least ``doc_id`` of the class; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbweave.llm.common import cut
from orbweave.llm.tokens import Block, blocks, gram_hashes, mix

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 12, 3
LEADERS = 4
#: Cells of the document frequency table (8 bytes each).
DF_CELLS = 1 << 18
#: Weights are 2 ** (level / LEVEL_STEP).
LEVEL_STEP, LEVELS = 4, 128
#: Parts of the elements for which weights are kept apart in the bound.
PARTS = 32
DRAWS, SEED = 1 << 16, 20_240_607
#: A bucket is dealt by salt beyond this many members and this part of all memberships.
HOT_ROWS, HOT_SHARE = 256, 10_000
#: Members of a bucket's sub-block, about, of which two are compared with each other at a time.
SUB_BLOCK = 256


def _cells(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - (DF_CELLS.bit_length() - 1))).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, documents with a word of that cell); cell -1 has the documents."""
    total, docs = np.zeros(DF_CELLS, np.int64), 0
    for batch in batches:
        docs += batch.num_rows
        for block in blocks(batch.column("text")):
            pairs = np.unique(block.doc * np.int64(DF_CELLS) + _cells(block.hash))
            total += np.bincount(pairs % DF_CELLS, minlength=DF_CELLS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], docs))], names=["cell", "n"])


def word_idf(docs: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of each cell."""
    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count_words, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    df, n = np.zeros(DF_CELLS), 0.0  # at most DF_CELLS + 1 rows
    if len(counts):
        cell, count = counts["cell"].to_numpy(), counts["n"].to_numpy()
        df[cell[cell >= 0]] = count[cell >= 0]
        n = float(count[cell < 0].sum())
    return (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)


@lru_cache(1)
def _table() -> np.ndarray:
    """a of each weight level and draw, as integers in the same order."""
    rng = np.random.default_rng(SEED)
    r, c, b = rng.gamma(2.0, 1.0, DRAWS), rng.gamma(2.0, 1.0, DRAWS), rng.random(DRAWS)
    ln_w = np.arange(LEVELS)[:, None] / LEVEL_STEP * np.log(2.0)
    t = np.floor(ln_w / r + b)
    ln_a = (np.log(c) - r * (t - b) - r).astype(np.float32)
    bits = ln_a.view(np.int32)
    return np.where(bits < 0, ~bits, bits | np.int32(-2**31)).view(np.uint32)


class Shingles:
    """The weighted elements of a block's documents: ``code`` (hash and level in one number), sorted within a document."""

    def __init__(self, block: Block, idf: np.ndarray):
        n = block.hi - block.lo
        word = idf[_cells(block.hash)].astype(np.float64)
        total = np.concatenate([[0.0], np.cumsum(word)])
        m = max(block.hash.size - SHINGLE + 1, 0)
        inside = np.flatnonzero(block.doc[:m] == block.doc[SHINGLE - 1:]) if m else np.zeros(0, np.int64)
        h = gram_hashes(block.hash, SHINGLE)[inside] if m else np.zeros(0, np.uint64)
        doc, mean = block.doc[inside], (total[inside + SHINGLE] - total[inside]) / SHINGLE
        short = np.flatnonzero((block.count > 0) & (block.count < SHINGLE))
        if short.size:
            parts = [mix(np.array([gram_hashes(block.hash[a:b], b - a)[0] + np.uint64(b - a)], np.uint64))[0] for a, b in zip(block.first[short], block.first[short + 1], strict=True)]
            h = np.concatenate([h, np.array(parts, np.uint64)])
            doc = np.concatenate([doc, short])
            mean = np.concatenate([mean, (total[block.first[short + 1]] - total[block.first[short]]) / block.count[short]])
        # 44 bits of hash tell a document's elements apart; documents of a block are below 2 ** 20.
        key = (doc.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20))
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if key.size else np.zeros(0, np.int64)
        tf = np.diff(np.append(first, key.size))
        at = order[first]
        self.level = np.round(LEVEL_STEP * np.log2(np.maximum(tf * mean[at], 1.0))).astype(np.int64).clip(0, LEVELS - 1)
        self.hash, self.doc = h[at], doc[at]
        self.code = ((key[first] & np.uint64((1 << 44) - 1)) << np.uint64(8)) | self.level.astype(np.uint64)
        self.first = np.searchsorted(self.doc, np.arange(n + 1))


def band_keys(s: Shingles, n: int) -> np.ndarray:
    """(documents x BANDS) of band keys; documents without words get 0."""
    out = np.zeros((n, BANDS), np.uint64)
    begin = np.flatnonzero(np.append(True, s.doc[1:] != s.doc[:-1])) if s.doc.size else np.zeros(0, np.int64)
    if not begin.size:
        return out
    table, row = _table().ravel(), s.level * DRAWS
    low = s.hash & np.uint64(0xFFFFFFFF)
    docs = s.doc[begin]
    bits = None
    for k in range(BANDS * ROWS):
        if k % 4 == 0:
            bits = mix(s.hash + np.uint64((k + 1) * 0x632BE59BD9B4E019 % 2**64))
        draw = ((bits >> np.uint64(16 * (k % 4))) & np.uint64(DRAWS - 1)).astype(np.int64)
        sample = np.minimum.reduceat((table[row + draw].astype(np.uint64) << np.uint64(32)) | low, begin)
        band = k // ROWS
        out[docs, band] = mix(out[docs, band] * np.uint64(0x9E3779B97F4A7C15) + sample)
    return out


def _text_ids(block: Block) -> np.ndarray:
    """64-bit name of each document's word sequence (0 without words)."""
    out = np.zeros(block.hi - block.lo, np.uint64)
    if block.hash.size:
        at = (np.arange(block.hash.size) - block.first[block.doc]).astype(np.uint64)
        begin = block.first[:-1][block.count > 0]
        both = [np.add.reduceat(mix(block.hash + at * np.uint64(step)), begin) for step in (0xD1B54A32D192ED03, 0xABC98388FB8FAC03)]
        out[block.count > 0] = mix(both[0] + mix(both[1]) + block.count[block.count > 0].astype(np.uint64))
    return out


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def sketches(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """(``doc_id``, ``text_id``, ``bands``) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)  # DF_CELLS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                n = block.hi - block.lo
                keys = band_keys(Shingles(block, shared.value), n).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(block.lo, n), pa.array(_text_ids(block).view(np.int64)), pa.array(list(keys), pa.list_(pa.int64()))], names=["doc_id", "text_id", "bands"])

    return _rows(docs).mapInArrow(run, "doc_id long, text_id long, bands array<long>")


def elements(docs: DataFrame, wanted: DataFrame, idf: np.ndarray) -> DataFrame:
    """(``text_id``, ``codes``, ``weight``, ``parts``: its weight by part) of the texts of ``wanted`` (``text_id``, ``rep``: a document that has it)."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want = np.asarray(batch.column("text_id"))
            for block in blocks(batch.column("text")):
                s = Shingles(block, shared.value)
                right = _text_ids(block).view(np.int64) == want[block.lo:block.hi]  # a document's other text isn't it
                at = np.flatnonzero(right)
                codes = [s.code[s.first[i]:s.first[i + 1]].tobytes() for i in at]
                cell = s.doc * PARTS + (s.code >> np.uint64(8)).astype(np.int64) % PARTS
                parts = np.bincount(cell, _weights(s.code), (block.hi - block.lo) * PARTS).reshape(-1, PARTS)[at]
                yield pa.RecordBatch.from_arrays([pa.array(want[block.lo:block.hi][at]), pa.array(codes, pa.binary()), pa.array(parts.sum(1)), pa.array(list(parts), pa.list_(pa.float64()))],
                                                 names=["text_id", "codes", "weight", "parts"])

    return (_rows(docs).join(wanted, F.col("doc_id") == F.col("rep")).select("text", "text_id")
            .mapInArrow(run, "text_id long, codes binary, weight double, parts array<double>").dropDuplicates(["text_id"]))


def _weights(code: np.ndarray) -> np.ndarray:
    return 2.0 ** ((code & np.uint64(255)).astype(float) / LEVEL_STEP)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, codes = np.asarray(batch.column("text_id")), batch.column("codes").to_pylist()
        for lo in range(0, len(codes), 500):
            parts = [np.frombuffer(c, np.uint64) for c in codes[lo:lo + 500]]
            code = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays([pa.array((code >> np.uint64(8)).astype(np.int64)), pa.array(np.repeat(texts[lo:lo + 500], [p.size for p in parts])),
                                              pa.array((code & np.uint64(255)).astype(np.int8))], names=["element", "text_id", "level"])


def shared_weights(codes: DataFrame) -> DataFrame:
    """(``m``, ``weight``, ``shared``, ``parts``) of each text: its weight, and the weight (by part) of elements that another text of ``codes`` has too."""
    alone = (codes.select("text_id", "codes").mapInArrow(_listed, "element long, text_id long, level byte")
             .groupBy("element").agg(F.min("text_id").alias("t"), F.max("text_id").alias("z"), F.max("level").alias("level")).where("t = z")
             .groupBy("t", F.pmod("element", F.lit(PARTS)).alias("part")).agg(F.sum(F.pow(F.lit(2.0), F.col("level") / LEVEL_STEP)).alias("w"))
             .groupBy("t").agg(F.sum("w").alias("lonely"), F.map_from_entries(F.collect_list(F.struct("part", "w"))).alias("by_part")))  # at most PARTS entries
    left = F.transform("parts", lambda w, i: w - F.coalesce(F.element_at("by_part", i.cast("long")), F.lit(0.0)))
    return (codes.select(F.col("text_id").alias("m"), "weight", "parts").join(alone, F.col("m") == F.col("t"), "left")
            .select("m", "weight", (F.col("weight") - F.coalesce("lonely", F.lit(0.0))).alias("shared"), left.alias("parts")))


def _reachable(threshold: float, common: Column) -> Column:
    """Whether a pair's weights (``weight``, ``weight2``) allow a link if its common weight is at most ``common``."""
    return common * (1 + threshold) >= threshold * (F.col("weight") + F.col("weight2")) - 1e-6


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of least over sum of largest weights of two sorted code arrays."""
    if not a.size and not b.size:
        return 1.0
    wa, wb = _weights(a), _weights(b)
    _, i, j = np.intersect1d(a >> np.uint64(8), b >> np.uint64(8), assume_unique=True, return_indices=True)
    both = np.minimum(wa[i], wb[j]).sum()
    return float(both / (wa.sum() + wb.sum() - both))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        j = [weighted_jaccard(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))
             for a, b in zip(batch.column("ca").to_pylist(), batch.column("cb").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(j, pa.float64())], names=["a", "b", "similarity"])


def compare(pairs: DataFrame, codes: DataFrame) -> DataFrame:
    """``pairs`` (``a``, ``b``) with their ``similarity``."""
    left = codes.select(F.col("text_id").alias("a"), F.col("codes").alias("ca"))
    right = codes.select(F.col("text_id").alias("b"), F.col("codes").alias("cb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ca", "cb").mapInArrow(_compared, "a long, b long, similarity double")


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``label``): the least node of each node's connected part, for the nodes of ``edges`` (``a``, ``b``).

    Labels fall to the least label among neighbours, then to the label of that
    label, until none changes; each round is written to the checkpoint folder.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("before"), F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("jump"))
        new = cut(low.join(jump, F.col("low") == F.col("at")).select("node", "before", F.least("low", "jump").alias("label")))
        changed = new.where("label <> before").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels


def _spread(buckets: DataFrame) -> DataFrame:
    """``buckets`` once for each of their ``salts``, as column ``salt``."""
    return buckets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")


def bucket_members(single: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``single`` (``m``, ``band``, ``key``) of the buckets with several texts, with ``salt`` below the bucket's ``salts``."""
    several = cut(single.groupBy("band", "key").agg(F.min("m").alias("x"), F.max("m").alias("y"), F.count("*").alias("n")).where("x <> y").select("band", "key", "n"))
    total = several.agg(F.sum("n").alias("n")).first()["n"] or 0
    share = max(hot_rows, -(-total // HOT_SHARE))
    several = several.select("band", "key", F.ceil(F.col("n") / share).cast("int").alias("salts"))
    # Fewer than HOT_SHARE rows: each is of a bucket with more than a HOT_SHARE-th of all.
    hot = F.broadcast(several.where("salts > 1"))
    dealt = single.join(hot, ["band", "key"], "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    salt = F.pmod(F.xxhash64("m", F.lit(2)), F.col("salts")).cast("int")
    return dealt.withColumn("salt", salt).join(_spread(several), ["band", "key", "salt"])


def across(rest: DataFrame, names: tuple[str, ...], near: Column, sub_block: int = SUB_BLOCK) -> DataFrame:
    """Pairs (``a``, ``b``) of ``rest``'s members of one bucket and different ``label`` for which ``near`` holds.

    ``rest`` has ``band``, ``key``, ``salt``, ``salts`` and ``names``; ``near`` names the second's columns with a 2 behind.
    A member lies in one sub-block of its bucket and goes
    to each pair of sub-blocks that has it, so a task holds two sub-blocks and each pair meets once.
    """
    subs = F.ceil(F.count("*") / sub_block).cast("int").alias("subs")
    rest = rest.drop("salts").join(_spread(rest.groupBy("band", "key").agg(subs, F.max("salts").alias("salts"))), ["band", "key", "salt"]).withColumn("s", F.pmod(F.xxhash64("m", F.lit(3)), F.col("subs")).cast("int"))
    left = rest.withColumn("t", F.explode(F.sequence(F.col("s"), F.col("subs") - 1))).select("band", "key", "s", "t", *names)
    right = (rest.withColumnRenamed("s", "t").withColumn("s", F.explode(F.sequence(F.lit(0), F.col("t"))))
             .select("band", "key", "s", "t", *(F.col(c).alias(f"{c}2") for c in names)))
    # Within a sub-block a pair would meet twice.
    once = (F.col("label") < F.col("label2")) | ((F.col("s") < F.col("t")) & (F.col("label") > F.col("label2")))
    return left.join(right, ["band", "key", "s", "t"]).where(once & near).select(F.least("m", "m2").alias("a"), F.greatest("m", "m2").alias("b")).distinct()


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``class_id``, ``text_id``."""
    idf = word_idf(docs)
    marks = cut(sketches(docs, idf))
    texts = cut(marks.where("doc_id is not null").groupBy("text_id").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")))
    single = texts.where("text_id <> 0").select(F.col("text_id").alias("m"), F.posexplode("bands").alias("band", "key"))
    members = cut(bucket_members(single))
    wanted = members.select(F.col("m").alias("text_id")).distinct().join(texts.select("text_id", "rep"), "text_id")
    codes = cut(elements(docs, wanted, idf))
    # A text that shares too little weight is linked to none.
    able = cut(shared_weights(codes).where(F.col("shared") >= threshold * F.col("weight") - 1e-6))
    members = cut(members.join(able.drop("parts"), "m"))

    # Leaders of a bucket: in each of LEADERS parts the member of least lonely share; the first leader has the least of all.
    place = F.struct((1 - F.col("shared") / F.col("weight")).alias("u"), F.xxhash64("m").alias("h"), "m", "weight", "shared")
    part = F.pmod(F.xxhash64("m", F.lit(1)), F.lit(LEADERS)).alias("part")
    leaders = members.groupBy("band", "key", part).agg(F.min(place).alias("l"), F.max("salts").alias("salts")).select(
        "band", "key", "salts", F.col("l.m").alias("leader"), F.col("l.weight").alias("weight2"), F.col("l.shared").alias("shared2"), F.col("l.u").alias("u"), F.col("l.h").alias("h"))
    pair = F.least("m", "leader").alias("a"), F.greatest("m", "leader").alias("b")
    common = F.least("shared", "shared2")
    pairs = members.join(_spread(leaders), ["band", "key", "salt"]).where((F.col("m") != F.col("leader")) & _reachable(threshold, common)).select(*pair).distinct()
    compared = cut(compare(pairs, codes))
    # Texts of the same doc_id belong together.
    twice = (marks.where("doc_id is not null").groupBy("doc_id").agg(F.min("text_id").alias("a"), F.max("text_id").alias("z")).where("a <> z"))
    twice = marks.join(twice, "doc_id").where("text_id <> a").select("a", F.col("text_id").alias("b"))
    links = compared.where(F.col("similarity") >= threshold).select("a", "b").unionByName(twice)
    labels = components(links)

    # Buckets with several classes: compare the pairs across classes that the distance to the first leader allows.
    label = F.coalesce("label", "m").alias("label")
    labelled = members.join(labels, F.col("m") == F.col("node"), "left").select("band", "key", "salt", "salts", "m", "weight", "shared", label)
    mixed = labelled.groupBy("band", "key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.max("salts").alias("salts")).where("x <> y").select("band", "key", "salts")
    first = leaders.groupBy("band", "key").agg(F.min(F.struct("u", "h", "leader")).alias("f")).select("band", "key", F.col("f.leader").alias("first"))
    open_buckets = _spread(mixed.join(first, ["band", "key"]))
    # A leader has been compared with every member that it can reach.
    rest = (labelled.join(open_buckets, ["band", "key", "salt"]).join(leaders.select("band", "key", F.col("leader").alias("m")), ["band", "key", "m"], "left_anti")
            .withColumn("a", F.least("m", "first")).withColumn("b", F.greatest("m", "first"))
            .join(compared, ["a", "b"], "left").select("band", "key", "salt", "salts", "m", "label", "weight", "shared", "similarity"))
    bands = texts.select(F.col("text_id").alias("m"), "bands")
    rest = cut(rest.join(able.select("m", "parts"), "m").join(bands, "m"))
    names = ("m", "label", "weight", "shared", "similarity", "parts", "bands")
    apart = F.abs(F.col("similarity") - F.col("similarity2")) > 1 - threshold + 1e-9  # null where one wasn't compared
    in_parts = F.aggregate(F.zip_with("parts", "parts2", lambda x, y: F.least(x, y)), F.lit(0.0), lambda s, x: s + x)
    first_band = F.array_position(F.zip_with("bands", "bands2", lambda x, y: x == y), True) == F.col("band") + 1  # a pair once, not in each band
    near = ~F.coalesce(apart, F.lit(False)) & _reachable(threshold, common) & first_band & _reachable(threshold, in_parts)
    more = across(rest, names, near)
    late = cut(compare(more, codes).where(F.col("similarity") >= threshold).select("a", "b"))
    if late.limit(1).count():
        labels = components(links.unionByName(late))

    named = texts.join(labels, F.col("text_id") == F.col("node"), "left").select("text_id", "rep", F.coalesce("label", "text_id").alias("label"))
    least = named.groupBy("label").agg(F.min("rep").alias("class_id"))
    of_text = named.join(least, "label").select(F.col("text_id").alias("t"), "class_id")
    return (marks.select("doc_id", "text_id").join(of_text, (F.col("text_id") == F.col("t")) & F.col("doc_id").isNotNull(), "left")
            .select("doc_id", "class_id", "text_id"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the document of least id of each class (one row of it); rows without an id stay."""
    found = classes(docs, threshold)
    kept = found.where("doc_id = class_id").select(F.col("doc_id").alias("__kept")).distinct()
    one = docs.join(kept, docs["doc_id"] == F.col("__kept"), "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.where(F.col("doc_id").isNull()))
