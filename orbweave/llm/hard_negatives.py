"""Hard negatives of anchors: Strassen products of tiles, then mergeable heaps.

Components are made whole numbers, floor(scale * x); a score is the integer
inner product of anchor and candidate. Candidates are dealt over tiles of about
``TILE`` rows, anchors over blocks of about ``BLOCK``; one task multiplies one
block with one tile by Strassen's recursion in int64: both are padded with zeros
to even sides, seven products of half the size are added up, down to leaves of
``LEAF``. int64 arithmetic is exact modulo 2**64, whatever the sums inside, so
a score is exact if it fits 64 bits itself.

Two rounds over the tiles. The first keeps, for each anchor and tile, a heap of
the best rows of the anchor's label; heaps merge to the anchor's positives. The
second keeps a heap of the best rows of other labels inside each positive's
window, ``low`` <= 100 * negative / positive score <= 100; these merge to the answer.
A heap holds at most ``k`` entries, so what is merged grows with anchors and
tiles, not with the rows of a label.

Defined results: rows with a null id, a null label, a null or empty vector or a
null or non-finite component take no part. An anchor's own id is never its
candidate. Rows equal in id, label and vector are counted before they are dealt
and stand for that many candidates (in a heap of ``k`` no more than ``k`` of them
can matter); an anchor is asked once per id, by its least (label, vector) if rows
of one id differ. Vectors of another dimension are not compared. Components
beyond 64 bits count as the end of that range, and a score that doesn't fit is
cut to +-(2**63 - 1). Ties go to the smaller id; fewer candidates give fewer
rows; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbweave.llm.common import cut

SCALE = 256
POSITIVES = NEGATIVES = 5
#: Least negative score, in hundredths of the positive's.
LOW = 80
#: Candidates of a tile, anchors of a block, and the inner side up to which tiles are multiplied outright.
TILE, BLOCK, LEAF = 4096, 1024, 32
MOST = (1 << 63) - 1


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices, modulo 2**64, by seven products of half the size."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        if max(m, n) <= 4 * leaf:
            return a @ b
        # One short side: halve the longest of the others, which needs no padding.
        if m >= n:
            return np.concatenate([strassen(a[:m // 2], b, leaf), strassen(a[m // 2:], b, leaf)])
        return np.concatenate([strassen(a, b[:, :n // 2], leaf), strassen(a, b[:, n // 2:], leaf)], axis=1)
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * t), np.int64)
    out[:r, :t] = p1 + p4 - p5 + p7
    out[:r, t:] = p3 + p5
    out[r:, :t] = p2 + p4
    out[r:, t:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def scores(anchors: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Inner products of all pairs; those that may not fit 64 bits are counted in Python's integers and cut."""
    out = strassen(anchors, np.ascontiguousarray(rows.T), leaf)
    top = [np.abs(v.astype(np.float64)).max(1) for v in (anchors, rows)]
    wide = top[0].max() * top[1].max() * rows.shape[1] >= 2.0**62
    for i, j in np.argwhere(top[0][:, None] * top[1] * rows.shape[1] >= 2.0**62) if wide else ():
        exact = sum(x * y for x, y in zip(anchors[i].tolist(), rows[j].tolist(), strict=True))
        out[i, j] = max(-MOST, min(MOST, exact))
    return out


def heap(score: np.ndarray, copies: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, copies) of the first ``k`` of rows that ascend by id: best scores first, ties by place."""
    if score.size > 4 * k:
        least = np.partition(score, score.size - k)[score.size - k]
        some = np.flatnonzero(score >= least)
    else:
        some = np.arange(score.size)
    some = some[np.argsort(~score[some], kind="stable")][:k]  # ~x turns the order round without overflow
    before = np.cumsum(copies[some]) - copies[some]
    some = some[before < k]
    return some, np.minimum(copies[some], k - before[before < k])


def _matrix(col: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.asarray(col.combine_chunks().flatten()).reshape(-1, dim)


class _Tile:
    """A block of anchors and a tile of candidates, ids ascending, with all scores."""

    def __init__(self, rows: pa.Table, asked: pa.Table):
        rows = rows.take(pa.array(np.argsort(np.asarray(rows.column("vec_id")), kind="stable")))
        dim = rows.column("dim")[0].as_py()
        self.ids, self.labels, self.copies = (np.asarray(rows.column(c)) for c in ("vec_id", "label", "copies"))
        self.anchors, self.anchor_labels = np.asarray(asked.column("anchor_id")), np.asarray(asked.column("a_label"))
        vectors, other = _matrix(rows.column("v"), dim), _matrix(asked.column("a_v"), dim)
        # Anchors that are asked with several positives are multiplied once.
        _, first, self.of = np.unique(self.anchors, return_index=True, return_inverse=True)
        self.scores = scores(other[first], vectors)


def _positives(k: int):  # noqa: ANN202
    names = {"anchor_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64(), "copies": pa.int64()}

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = {n: [] for n in names}
        tile = _Tile(rows, asked) if rows.num_rows and asked.num_rows else None
        for i in range(asked.num_rows if tile else 0):
            fit = np.flatnonzero((tile.labels == tile.anchor_labels[i]) & (tile.ids != tile.anchors[i]))
            score = tile.scores[tile.of[i], fit]
            best, copies = heap(score, tile.copies[fit], k)
            for n, v in zip(names, (np.full(best.size, tile.anchors[i]), tile.ids[fit[best]], score[best], copies), strict=True):
                out[n].append(v)
        return pa.table({n: pa.array(np.concatenate([np.zeros(0, np.int64), *out[n]]), t) for n, t in names.items()})

    return run, "anchor_id long, vec_id long, score long, copies long"


def _negatives(k: int, low: int):  # noqa: ANN202
    names = dict.fromkeys(("anchor_id", "place", "vec_id", "score", "copies"), pa.int64())

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = {n: [] for n in names}
        tile = _Tile(rows, asked) if rows.num_rows and asked.num_rows else None
        if tile:
            place, most = np.asarray(asked.column("place")), np.asarray(asked.column("positive_score"))
        for i in range(asked.num_rows if tile else 0):
            top = int(most[i])
            least = -((-low * top) // 100)  # the least whole number of at least that share
            row = tile.scores[tile.of[i]]
            fit = np.flatnonzero((row >= max(least, -MOST)) & (row <= top) & (tile.labels != tile.anchor_labels[i])) if least <= top else ()
            if not len(fit):
                continue
            best, copies = heap(row[fit], tile.copies[fit], k)
            for n, v in zip(names, (np.full(best.size, tile.anchors[i]), np.full(best.size, place[i]), tile.ids[fit[best]], row[fit[best]], copies), strict=True):
                out[n].append(v)
        return pa.table({n: pa.array(np.concatenate([np.zeros(0, np.int64), *out[n]]), t) for n, t in names.items()})

    return run, "anchor_id long, place long, vec_id long, score long, copies long"


def whole_rows(rows: DataFrame, vec_id: str, label: Column, vector: str, scale: int) -> DataFrame:
    """(``vec_id``, ``label``, ``dim``, ``v``, ``copies``) of the distinct rows that take part, components made whole."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    end = float(1 << 63)

    def whole(x: Column) -> Column:
        at = F.floor(F.lit(float(scale)) * x.cast("double"))
        big = F.lit(float(scale)) * x.cast("double")
        return F.when(big >= end, F.lit(MOST)).when(big <= -end, F.lit(-MOST)).otherwise(at.cast("long"))

    return (rows.where(F.col(f"`{vec_id}`").isNotNull() & label.isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
            .select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                    F.size(v).alias("dim"), F.transform(v, whole).alias("v"))
            .groupBy("vec_id", "label", "dim", "v").agg(F.count("*").alias("copies")))


def merged(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The heaps of all tiles as one: the first ``k`` candidates for each of ``keys``, with ``rank`` from 1.

    Entries are ranked before their copies are laid out; an entry past the first ``k`` can't matter.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    first = found.withColumn("__nth", F.row_number().over(order)).where(F.col("__nth") <= k).drop("__nth")
    one = first.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")
    rank = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "__copy")
    return one.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).drop("__copy")


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, vec_id: str = "vec_id",
         label: Column | None = None, vector: str = "embedding", scale: int = SCALE, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """Each anchor's positives with their hard negatives.

    ``anchor_id``, ``positive_id``, ``rank`` (from 1, of the negative), ``negative_id``,
    ``positive_score``, ``negative_score``. ``is_anchor`` is a condition on the column ``vec_id``.
    """
    vectors = cut(whole_rows(rows, vec_id, F.col("label") if label is None else label, vector, scale))
    n = vectors.agg(F.count("*").alias("n"), F.count(F.when(is_anchor, 1)).alias("a")).first()
    tiles, blocks = max(1, -(-n["n"] // tile)), max(1, -(-n["a"] // block))
    asked = (vectors.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "dim", "v")).alias("one"))
             .select(F.col("vec_id").alias("anchor_id"), F.col("one.label").alias("a_label"), F.col("one.dim").alias("a_dim"), F.col("one.v").alias("a_v"),
                     F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int").alias("a_block")))
    # Dealt by the whole row, so that different rows of one id don't meet in one tile.
    dealt = vectors.withColumn("tile", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(tiles)).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def over_tiles(asks: DataFrame, kernel) -> DataFrame:  # noqa: ANN001
        run, form = kernel
        asks = asks.withColumn("a_tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
        return (dealt.groupBy("dim", "tile", "block").cogroup(asks.groupBy("a_dim", "a_tile", "a_block")).applyInArrow(run, form))

    best = merged(over_tiles(asked, _positives(positives)), ["anchor_id"], positives)
    best = cut(best.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").cast("long").alias("place")))
    windows = asked.join(best.select("anchor_id", "place", "positive_score"), "anchor_id")
    found = merged(over_tiles(windows, _negatives(negatives, low)), ["anchor_id", "place"], negatives)
    return (found.join(best, ["anchor_id", "place"])
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
