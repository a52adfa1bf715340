import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from orbweave.llm import prefix_tokens
from orbweave.llm.queries import op11_prefix_token_counts
from .conftest import DATA

PATH = public_tokenizers.path(prefix_tokens.MODEL)
PARTS = ["a", "e", "t", "h", "i", "n", "s", "r", " ", "  ", "▁", "\n", "\t", "é", "①", "😀", "ing", "the", "0", "1", ".", "...", "==", "日",
         "本", "\x00", "​", "<s>", "<0x0A>", " ", "﻿", "ﬁ"]
ODD = ["", " ", "  ", " " * 16, " " * 17, " " * 33 + "a", " " * 40 + "①", "▁", "▁▁ ", "a  ", " a", "\n", "<s></s><unk>"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def _random(seed: int, n: int) -> list[str]:
    chance = random.Random(seed)
    return ["".join(chance.choice(PARTS) for _ in range(chance.randint(0, 40))) for _ in range(n)]


def test_totals_are_the_librarys(library):
    texts = ODD + _random(1, 4000)
    got = prefix_tokens.Counted(prefix_tokens._pieces(PATH), pa.array(texts)).totals()
    assert got.tolist() == [len(ids) for ids in library.encode(texts)]


def test_every_prefix_is_the_librarys(library):
    for text in ODD + _random(2, 200) + ["Strassen multiplied matrices; der schnelle Fuchs — ñandú. " * 3]:
        got = prefix_tokens.Counted(prefix_tokens._pieces(PATH), pa.array([text])).text(0)
        assert got.tolist() == [len(library.encode(text[:i])) for i in range(1, len(text) + 1)], text


def test_long_words_and_texts(library):
    chance = random.Random(3)
    texts = ["".join(chance.choice("abcdefghij0123456789+/") for _ in range(20000)), "日本語" * 3000, " " * 5000, "x" * 9999, "word " * 30000]
    got = prefix_tokens.Counted(prefix_tokens._pieces(PATH), pa.array(texts)).totals()
    assert got.tolist() == [len(ids) for ids in library.encode(texts)]


def test_rows_and_clashing_columns(spark, library):
    rows = [(1, None, 5), (2, "", 6), (3, "two words", 7), (3, "two words", 7), (None, "no id", 8), (4, "a b " * 3000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(prefix_tokens.token_counts(docs, limit=100).collect(), key=str)
    want = []
    for doc_id, text, _ in rows:
        text = text or ""
        n = len(library.encode(text))
        fit = max((i for i in range(min(len(text), 400) + 1) if len(library.encode(text[:i])) <= 100)) if n > 100 else len(text)
        want.append((doc_id, len(text.encode()), n, n > 100, fit))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert prefix_tokens.token_counts(docs.limit(0)).collect() == []


def test_stored_counts_answer_without_encoding(spark, library):
    texts = dict(enumerate(["", "tokens and budgets", "①② naïve  text\nover lines ", None]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    stored = prefix_tokens.prefix_counts(docs)
    asked = stored.crossJoin(spark.range(0, 32).withColumnRenamed("id", "n")).select(
        "doc_id", "n", prefix_tokens.tokens_at(F.col("prefix_steps"), F.col("n")).alias("at"),
        prefix_tokens.longest_within(F.col("prefix_steps"), F.col("n")).alias("fit"))
    for row in asked.collect():
        text = texts[row["doc_id"]] or ""
        counts = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        assert row["at"] == counts[min(row["n"], len(text))]
        assert row["fit"] == max(i for i, c in enumerate(counts) if c <= row["n"])


def test_other_models_are_refused():
    with pytest.raises(Exception):  # noqa: B017 - a file that is no model
        prefix_tokens.Pieces(public_tokenizers.path("byte_bpe_50k.json"))


def test_query_on_given_documents(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = op11_prefix_token_counts(spark, DATA).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got} == {
        d: (len(t.encode()), n := len(library.encode(t)), n > 4096) for d, t in docs.items()}
    assert len(got) == len(docs) and np.all([r["fit_chars"] <= len(docs[r["doc_id"]]) for r in got])
