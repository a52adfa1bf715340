"""Toxicity grades by cumulative-link ordinal regression.

Features are sparse: the lower-cased words of a text (runs of letters, digits
and non-ASCII characters) and the prefixes of 4 and 6 bytes of longer words,
each counted. The model is

    P(grade > k) = sigmoid(w . x - theta_k),   theta_0 < theta_1 < ...

with one weight vector shared by all thresholds. Grade 0 is a clean document;
the toxic training documents are graded 1, 2, 3 by the terciles of how many of
their words carry evidence. A document's expected severity is the sum of
P(grade > k) over k; it is toxic if P(grade > 0) >= ``TOXIC_AT`` (below one half:
toxic documents are rare, which pulls the probabilities of the mild ones down).

Training uses a bounded sample of labelled documents (``TRAIN_DOCS``); only
features whose document frequency differs clearly between toxic and clean
documents (chi-square and odds) enter the model, at most ``MAX_FEATURES``.
Scoring reads every whole text.

Defined results: a null text is an empty text (severity from the thresholds
alone, never toxic unless the model says so for no words); repeated rows are
scored one by one; rows with a null ``doc_id`` are scored too; without labels
of both kinds the model is empty and every severity is 0; other columns are
neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbweave.llm.common import cut, labelled_sample
from orbweave.llm.tokens import Block, blocks, separators, word_hashes

#: Labelled documents used for training, at most.
TRAIN_DOCS = 20_000
#: Features kept after selection, at most.
MAX_FEATURES = 20_000
PREFIXES = (4, 6)
GRADES = 3
TOXIC_AT = 0.3
MIN_DOCS, MIN_ODDS, MIN_CHI2 = 3, 4.0, 20.0

_SEP = separators(bytes(b for b in range(128) if not chr(b).isalnum()))


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes with their weights, and the ordered thresholds."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def latent(self, block: Block) -> np.ndarray:
        """w . x of each document of the block."""
        out = np.zeros(block.hi - block.lo)
        if not self.features.size:
            return out
        for h, doc in block_features(block):
            at = np.searchsorted(self.features, h).clip(max=self.features.size - 1)
            hit = self.features[at] == h
            out += np.bincount(doc[hit], self.weights[at[hit]], out.size)
        return out

    def severity(self, latent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(expected severity, most severe grade with P >= 0.5, P(grade > 0))."""
        if not self.thresholds.size:
            zero = np.zeros(latent.size)
            return zero, zero.astype(np.int32), zero
        over = _sigmoid(latent[:, None] - self.thresholds)
        return over.sum(1), (over >= 0.5).sum(1).astype(np.int32), over[:, 0]


def block_features(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, document) of each occurrence of a feature, family by family."""
    yield block.hash, block.doc
    size = block.ends - block.starts
    for n in PREFIXES:
        long = size > n
        start = block.starts[long]
        yield word_hashes(block.data, start, start + n) ^ np.uint64(n), block.doc[long]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False)
        for block in blocks(batch.column("text"), sep=_SEP):
            toxic = label[block.lo:block.hi] > 0
            for h, doc in block_features(block):
                order = np.lexsort((doc, h))
                h, doc = h[order], doc[order]
                new = np.ones(h.size, bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                h, doc = h[new], doc[new]
                kinds, first = np.unique(h, return_index=True)
                bad = np.add.reduceat(toxic[doc].astype(np.int64), first) if h.size else np.zeros(0, np.int64)
                n = np.diff(np.append(first, h.size))
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(bad), pa.array(n - bad)],
                                                 names=["feature", "toxic", "clean"])


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Fit the model on at most ``train_docs`` labelled documents of ``docs``."""
    sample = F.broadcast(labelled_sample(labels, "toxic", train_docs))  # at most train_docs rows
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .join(sample, "doc_id")
               # Of rows with one id the least by hash: at most train_docs rows, of which the driver gets at most MAX_FEATURES numbers each.
               .groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "label")).alias("r")).select("doc_id", "r.text", "r.label"))
    counts = {r["label"] > 0: r["count"] for r in rows.groupBy((F.col("label") > 0).cast("int").alias("label")).count().collect()}
    n1, n0 = counts.get(True, 0), counts.get(False, 0)
    none = Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    if not n1 or not n0:
        return none
    a, b, n = F.col("toxic"), F.col("clean"), float(n1 + n0)
    odds = ((a + 0.5) / (n1 + 1.0)) / ((b + 0.5) / (n0 + 1.0))
    chi2 = n * F.pow(a * float(n0) - b * float(n1), 2) / ((a + b) * (n - a - b + 1.0) * float(n1) * float(n0))
    chosen = (rows.mapInArrow(_document_frequency, "feature long, toxic long, clean long")
              .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
              .where((a + b >= MIN_DOCS) & (chi2 >= MIN_CHI2) & ((odds >= MIN_ODDS) | (odds <= 1 / MIN_ODDS)))
              .select("feature", (a * n0 > b * n1).alias("bad"), chi2.alias("chi2"))
              .orderBy(F.desc("chi2"), "feature").limit(MAX_FEATURES).collect())
    if not chosen:
        return none
    features = np.array([r["feature"] for r in chosen], np.int64).view(np.uint64)
    order = np.argsort(features)
    features, bad = features[order], np.array([r["bad"] for r in chosen])[order]

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "label"))
            for block in blocks(batch.column("text"), sep=_SEP):
                width = np.int64(features.size + 1)
                keys = [np.arange(block.hi - block.lo, dtype=np.int64) * width + features.size]  # every document has a row
                for h, doc in block_features(block):
                    at = np.searchsorted(features, h).clip(max=features.size - 1)
                    hit = features[at] == h
                    keys.append(doc[hit] * width + at[hit])
                key, tf = np.unique(np.concatenate(keys), return_counts=True)
                doc, at = key // width + block.lo, (key % width).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(ids[doc]), pa.array((label[doc] > 0).astype(np.int32)), pa.array(at), pa.array(tf.astype(np.int32))],
                                                 names=["doc_id", "label", "at", "tf"])

    data = rows.mapInArrow(sparse, "doc_id long, label int, at int, tf int").toPandas().sort_values(["doc_id", "at"], kind="stable")
    ids, row = np.unique(data["doc_id"].to_numpy(), return_inverse=True)
    label = np.zeros(ids.size, np.int64)
    label[row] = data["label"].to_numpy()
    real = (data["at"] < features.size).to_numpy()
    row, at, tf = row[real], data["at"].to_numpy()[real], data["tf"].to_numpy()[real].astype(float)
    return Model(features, *_fit(row, at, tf, _grades(row, at, tf, label, bad), features.size))


def _grades(row: np.ndarray, at: np.ndarray, tf: np.ndarray, label: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """0 for clean documents; 1..GRADES for toxic ones by quantiles of their evidence."""
    dose = np.bincount(row, tf * bad[at], label.size)
    toxic = label > 0
    cuts = np.quantile(dose[toxic], np.arange(1, GRADES) / GRADES)
    return np.where(toxic, 1 + np.searchsorted(cuts, dose, side="left"), 0)


def _fit(row: np.ndarray, at: np.ndarray, tf: np.ndarray, grade: np.ndarray, n_features: int,
         steps: int = 600, rate: float = 0.05, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood of the cumulative logit model by Adam on the whole sample."""
    n = grade.size
    over = [(grade > k).mean().clip(1e-4, 1 - 1e-4) for k in range(GRADES)]
    theta0 = -np.log(np.array(over) / (1 - np.array(over)))
    par = np.concatenate([np.zeros(n_features), theta0[:1], np.log(np.diff(theta0).clip(1e-2))])
    m, v = np.zeros_like(par), np.zeros_like(par)
    for step in range(1, steps + 1):
        w, theta = par[:n_features], _thresholds(par[n_features:])
        eta = np.bincount(row, w[at] * tf, n)
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        up, low = _sigmoid(edge[grade + 1] - eta), _sigmoid(edge[grade] - eta)
        p = (up - low).clip(1e-9)
        du, dl = up * (1 - up) / p, low * (1 - low) / p
        g_eta = du - dl
        g_edge = np.bincount(grade, dl, GRADES + 1)[1:] - np.bincount(grade, du, GRADES + 1)[:-1]
        tail = np.cumsum(g_edge[::-1])[::-1]
        g = np.concatenate([np.bincount(at, g_eta[row] * tf, n_features) / n + ridge * w,
                            tail[:1] / n, tail[1:] * np.exp(par[n_features + 1:]) / n])
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        par = par - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return par[:n_features], _thresholds(par[n_features:])


def _thresholds(raw: np.ndarray) -> np.ndarray:
    return raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``severity``, ``grade``, ``p_toxic``, ``toxic``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_FEATURES weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            severity, grade, p = m.severity(_latent(m, batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(severity), pa.array(grade), pa.array(p), pa.array(p >= TOXIC_AT)],
                                             names=["doc_id", "severity", "grade", "p_toxic", "toxic"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, severity double, grade int, p_toxic double, toxic boolean"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model doesn't call toxic, unchanged (a text column is needed).

    Only texts go to Python, and only the verdicts come back; the rows stay with Spark.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for some in texts:
            _, _, p = m.severity(_latent(m, some))
            yield pa.array(p < TOXIC_AT)

    return docs.where(clean(F.col("text").cast("string")))


def _latent(model: Model, col: pa.Array) -> np.ndarray:
    out = np.zeros(len(col))
    for block in blocks(col, sep=_SEP):
        out[block.lo:block.hi] = model.latent(block)
    return out
