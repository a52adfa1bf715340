"""Exact top-k by inner product with KD-trees over shards of the vectors.

Components are made whole numbers, floor(scale * x), so scores are exact. The
vectors are dealt over shards by hash of their id and components and bounded in
size; each task builds a KD-tree of its shard (median splits of the widest
dimension, tight bounding boxes at every node) and searches it best first: each
query has a queue of nodes in the order of the largest inner product that it can
have with their box, opens the first (a node's two halves join the queue, a
leaf's points are scored), and ends when no box left can beat its kth best. A
first round searches one shard for each query; its kth score is passed to the
others, whose trees skip every box below it. The best k over all shards follow
by a ranked window.

The work is that of a stated query set against all rows: after the first round,
in which each shard meets its own queries only, vectors go once to each block of
queries, queries once to each shard, and no task holds more than one shard and
one block. Rows of an id that has more than a shard's rows are counted first:
of equal ones k are enough, as no query can return more.

Defined results: vectors that are null, empty or hold a null or non-finite
component, and rows with a null id, take no part; vectors of another dimension
are not compared; ties go to the smaller id; equal rows are candidates each,
but a query is asked once per id and never returns its own id; fewer than k
candidates give fewer rows; other columns are not read. Scores of vectors too
large for a tree (products of 2**40 or more) are exact too, from all pairs with
such a vector. Beyond 64 bits a component counts as 2**63 (or its negative) and a
score as 2**63 - 1 (or its negative), where ties go to the smaller id as well.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbweave.llm.common import cut

K = 20
SCALE = 64
LEAF = 64
#: Stands for no key and no score yet.
NONE = -(1 << 62)
#: Inner products in a tree are smaller (in a key, the row's number goes with them), and any product is cut to this.
TREE, MOST = 1 << 40, (1 << 63) - 1
#: Vectors of a shard and queries of a block, about.
SHARD = BLOCK = 8192


class Tree:
    """A KD-tree over integer vectors: bounding box, halves and least row of each node, rows of each leaf. Node 0 is the root."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        points, self.ids = points[order], ids[order]
        low, high, first, halves = [], [], [], []
        self.rows: dict[int, np.ndarray] = {}  # of leaves
        todo = [(np.arange(len(points)), -1, 0)]
        while todo:
            rows, above, side = todo.pop()
            node = len(low)
            if above >= 0:
                halves[above][side] = node
            low.append(points[rows].min(0))
            high.append(points[rows].max(0))
            first.append(rows.min())
            halves.append([-1, -1])
            wide = int((high[node] - low[node]).argmax())
            if len(rows) <= leaf or low[node][wide] == high[node][wide]:  # equal points need no split
                self.rows[node] = np.sort(rows)
                continue
            half = len(rows) // 2
            parted = np.argpartition(points[rows, wide], half)
            todo += [(rows[parted[:half]], node, 0), (rows[parted[half:]], node, 1)]
        self.low, self.high, self.first, self.halves = (np.array(x) for x in (low, high, first, halves))
        self.points = {node: points[rows] for node, rows in self.rows.items()}

    def bounds(self, queries: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Largest inner product of each query with a point of its node's box."""
        return np.einsum("qd,qd->q", np.maximum(queries, 0), self.high[node]) + np.einsum("qd,qd->q", np.minimum(queries, 0), self.low[node])

    def search(self, queries: np.ndarray, own: np.ndarray, at_least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of each query's best k rows of score ``at_least``, ties to smaller ids, without the id ``own``."""
        n, none = len(queries), NONE
        # A key orders by score, then by row (rows ascend by id).
        shift = np.int64(max(1, int(len(self.ids)).bit_length()))
        mask = (np.int64(1) << shift) - 1
        best = np.full((n, k), none, np.int64)
        floor = np.where(at_least == none, none, np.clip(at_least, -TREE, TREE) << shift)
        queue = np.full((n, len(self.low)), none, np.int64)  # keys of the nodes to open
        active = np.arange(n)

        def put(asks: np.ndarray, node: np.ndarray) -> None:
            queue[asks, node] = (self.bounds(queries[asks], node).astype(np.int64) << shift) + (mask - self.first[node])

        put(active, np.zeros(n, np.int64))
        while active.size:
            node = queue[active].argmax(1)
            go = queue[active, node] > np.maximum(best[active, k - 1], floor[active] - 1)
            active, node = active[go], node[go]
            queue[active, node] = none
            inner = self.halves[node, 0] >= 0
            for side in (0, 1):
                put(active[inner], self.halves[node[inner], side])
            for one in np.unique(node[~inner]):
                asks = active[node == one]
                rows = self.rows[one]
                key = ((queries[asks] @ self.points[one].T).astype(np.int64) << shift) + (mask - rows)
                key[(self.ids[rows] == own[asks][:, None]) | (key < floor[asks][:, None])] = none
                both = np.concatenate([best[asks], key], axis=1)
                best[asks] = -np.sort(np.partition(-both, k - 1, axis=1)[:, :k], axis=1) if both.shape[1] > k else -np.sort(-both, axis=1)
        q, c = np.nonzero(best != none)
        found = best[q, c]
        return q, mask - (found & mask), found >> shift


def _matrix(col: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.asarray(col.combine_chunks().flatten(), dtype=np.float64).reshape(-1, dim)


def _large(vectors: np.ndarray) -> np.ndarray:
    """Which rows the tree can't score exactly: any two of the others have a product below ``TREE``."""
    return np.abs(vectors).max(1) ** 2 * vectors.shape[1] >= TREE


def _products(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact inner products in int64: in Python's integers where they may not fit, the outcome cut to ``MOST``."""
    if not queries.size or not points.size:
        return np.zeros((len(queries), len(points)), np.int64)
    tops = np.abs(queries).max(1)[:, None], np.abs(points).max(1)
    # A row with components beyond 2**62 is all zero here and counted below.
    fits = [v.astype(np.int64) for v in (np.where(tops[0] < 2.0**62, queries, 0), np.where(tops[1][:, None] < 2.0**62, points, 0))]
    out = fits[0] @ fits[1].T  # wraps only where it is counted again
    for q, c in zip(*np.nonzero(tops[0] * tops[1] * queries.shape[1] >= 2.0**62), strict=True):
        exact = sum(int(x) * int(y) for x, y in zip(queries[q], points[c], strict=True))
        out[q, c] = max(-MOST, min(MOST, exact))
    return out


def _all_pairs(queries: np.ndarray, own: np.ndarray, at_least: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of each query's best k points, as ``Tree.search`` has them, from all products."""
    score = _products(queries, points)
    out = []
    for q in range(len(queries)):
        at = np.flatnonzero((ids != own[q]) & ((at_least[q] == NONE) | (score[q] >= at_least[q])))
        at = at[np.lexsort((ids[at], -score[q, at]))[:k]]
        out.append((np.full(at.size, q), ids[at], score[q, at]))
    return tuple(np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3))


def _search(k: int):  # noqa: ANN202
    def run(points: pa.Table, queries: pa.Table) -> pa.Table:
        names = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()}
        if not points.num_rows or not queries.num_rows:
            return pa.table({n: pa.array([], t) for n, t in names.items()})
        dim = points.column("dim")[0].as_py()
        every, ids = _matrix(points.column("v"), dim), np.asarray(points.column("vec_id"))
        wide = _large(every)
        tree = Tree(every[~wide], ids[~wide]) if not wide.all() else None
        asked = np.asarray(queries.column("query_id"))
        least = queries.column("at_least").to_numpy()
        vectors = _matrix(queries.column("q_v"), dim)
        large = _large(vectors)
        out = [(np.zeros(0, np.int64),) * 3]

        def add(part: np.ndarray, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
            q, vec_id, score = found
            out.append((asked[part][q], vec_id, score))

        # The vectors that are too large for the tree, and all others for such queries, are compared pair by pair.
        for few, rows in ((~large, wide), (large, np.ones(len(every), bool))):
            for lo in range(0, int(few.sum()) if rows.any() else 0, 256):
                part = np.flatnonzero(few)[lo:lo + 256]
                add(part, _all_pairs(vectors[part], asked[part], least[part], every[rows], ids[rows], k))
        for lo in range(0, int((~large).sum()) if tree else 0, 1024):
            part = np.flatnonzero(~large)[lo:lo + 1024]
            q, row, score = tree.search(vectors[part], asked[part], least[part], k)
            add(part, (q, tree.ids[row], score))
        return pa.table({n: pa.array(np.concatenate([o[i] for o in out]), t) for i, (n, t) in enumerate(names.items())})

    return run


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(``vec_id``, ``dim``, ``v``) of the rows that take part, components made whole."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return (rows.where(F.col(f"`{vec_id}`").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
            .select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.size(v).alias("dim"),
                    F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double")).alias("v")))


def _once_k(vectors: DataFrame, k: int, shard: int) -> DataFrame:
    """``vectors``, of whose equal rows at most ``k`` stay where an id has more than ``shard`` rows."""
    many = cut(vectors.groupBy("vec_id").agg(F.count("*").alias("n")).where(F.col("n") > shard).select(F.col("vec_id").alias("many")))
    if many.isEmpty():
        return vectors
    counted = (vectors.join(many, F.col("vec_id") == F.col("many"), "left_semi").groupBy("vec_id", "dim", "v").agg(F.count("*").alias("n"))
               .withColumn("n", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int")))).drop("n"))
    return vectors.join(many, F.col("vec_id") == F.col("many"), "left_anti").unionByName(counted)


def top_k(rows: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
          shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """Each query's best ``k`` rows: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``. ``is_query`` is a condition on the column ``vec_id``."""
    vectors = _once_k(whole_vectors(rows, vec_id, vector, scale), k, shard)
    asked = vectors.where(is_query)
    counts = vectors.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    shards, blocks = max(1, -(-counts["n"] // shard)), max(1, -(-counts["q"] // block))

    def dealt(n: int, *columns: str | Column) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")

    every = vectors.withColumn("shard", dealt(shards, "vec_id", "v"))
    queries = (asked.dropDuplicates(["vec_id"]).withColumnRenamed("vec_id", "query_id")
               .withColumn("block", dealt(blocks, "query_id", F.lit(2))).withColumn("own", dealt(shards, "query_id", F.lit(1))))
    none = F.lit(NONE)
    form = "query_id long, vec_id long, score long"

    def searched(asks: DataFrame, points: DataFrame) -> DataFrame:
        # Both sides stem from the same rows: own names for the queries' columns keep them apart.
        asks = asks.select("query_id", "at_least", *(F.col(c).alias(f"q_{c}") for c in ("dim", "shard", "block", "v")))
        return (points.groupBy("dim", "shard", "block").cogroup(asks.groupBy("q_dim", "q_shard", "q_block"))
                .applyInArrow(_search(k), form))

    alone = F.lit(0).alias("block")  # a shard has no more queries of its own than rows, about
    first = cut(searched(queries.select("query_id", "dim", "v", alone, F.col("own").alias("shard"), none.alias("at_least")), every.select("*", alone)))
    # The kth score so far; a query with fewer than k own candidates has no bound yet.
    kth = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth")).withColumnRenamed("query_id", "kth_id")
    others = (queries.join(kth, F.col("query_id") == F.col("kth_id"), "left")
              .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> own")
              .select("query_id", "dim", "v", "block", "shard", F.coalesce("kth", none).alias("at_least")))
    points = every.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = first.unionByName(searched(others, points)) if shards > 1 else first
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
