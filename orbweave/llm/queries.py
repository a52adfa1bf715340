"""The thin queries of this subpackage's operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbweave.llm import (decontaminate, hard_negatives, html, kdtree, lexical, lm, neardup, packing, pii, prefix_tokens, quality, secrets,
                          toxicity)
from orbweave.llm.common import table


def op1_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts, the digest of the base spans, all spans."""
    return secrets.digest(secrets.scan_documents(table(spark, sf_dir, "documents")))


def op3_kdtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows by inner product for each vector whose id is divisible by 20."""
    found = kdtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with the sequence and offset where each lies."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity, grade and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document."""
    return lm.score(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a contaminated document and the benchmark item that it holds."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document; the class id is the document that would stay."""
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op9_pseudonymise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with personal numbers, dates and addresses replaced by pseudonyms."""
    docs = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), found="kinds")
    return docs.select("doc_id", "text", F.size("kinds").cast("long").alias("n_replaced"), F.array_join("kinds", ",").alias("kinds"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labels outside the held-out fold."""
    return quality.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, whether they pass the limit, and how many characters fit."""
    return prefix_tokens.token_counts(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each positive of the vectors whose id is divisible by 100."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of each benchmark item."""
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_main_text, op2_secret_scan, op3_kdtree_topk, op4_pack_sequences, op5_toxicity, op6_lm_scores,
                            op7_decontaminate, op8_near_duplicates, op9_pseudonymise, op10_quality,
                            op11_prefix_token_counts, op12_hard_negatives, op13_lexical_search)
}

#: DuckDB SQL of the operators that SQL can express; the others are tested against brute force (tests/llm).
ORACLES: dict[str, str] = {
    "op3_kdtree_topk": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64.0 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
        ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op12_hard_negatives": """
        WITH whole AS (
            SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
                   list_transform(embedding, lambda x: floor(256.0 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
            FROM whole a JOIN whole c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.v) = len(c.v)),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.positive_id,
               row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
               n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN scored n
          ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 5
    """,
    "op13_lexical_search": r"""
        WITH doc_terms AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
            FROM documents WHERE doc_id IS NOT NULL),
        posting AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM doc_terms GROUP BY 1, 2),
        doc AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM posting GROUP BY 1),
        whole AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM doc),
        item_terms AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
            FROM benchmark WHERE item_id IS NOT NULL),
        weight AS (
            SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM posting, whole WHERE term IN (SELECT term FROM item_terms) GROUP BY term),
        scored AS (
            SELECT i.item_id, p.doc_id,
                   sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (100 - 90 + ((90 * d.n * whole.n_docs) // whole.n_terms)))))::BIGINT AS score
            FROM item_terms i JOIN weight w USING (term) JOIN posting p USING (term) JOIN doc d ON d.doc_id = p.doc_id, whole
            GROUP BY 1, 2)
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
    """,
}
