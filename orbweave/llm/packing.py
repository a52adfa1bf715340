"""Packing of tokenised documents into sequences: shortest pack first over the length histogram.

Documents are tokenised and cut into full sequences and a rest; only lengths
are planned. The plan works on the histogram of piece lengths (at most
``SEQUENCE`` numbers, whatever the input): lengths are placed longest first,
each into the shortest open pack that has room, and all packs of the same
pattern are handled as one count. If no open pack has room, new packs are
opened, filled with as many pieces of that length as fit. Patterns are then
joined back to the pieces by the pieces' rank among those of their length;
ranks come from a range partitioning and sums of counts, not from a window.

Sequences whose length is not a power of two are meant to be padded to
``SEQUENCE``.

Defined results: a null text is an empty text, whose piece is the closing id
alone; repeated rows are packed as often as they occur; rows with a null
``doc_id`` are packed too; an empty table gives no pieces; other columns are
not read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbweave.llm.common import cut

SEQUENCE = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k.json"

#: The pattern by which byte-level BPE vocabularies of this kind part a text (a fixed value).
PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts on which the quick encoder has to agree with the tokenizer before it is used.
PROBES = ("It's 12,345.67 naïve  東京\n\n\tß x 'll !?—… \U0001f600", " a\r\n b  \n c   ",
          "ÀÉ_x-y|z §§ ##$%", "word " * 50, "\x85 　a")


class Tokens:
    """Ids of texts by a ``tokenizers`` file.

    For a byte-level BPE whose ids ascend in merge order, the same ids come
    several times faster from ``tiktoken`` with the file's vocabulary as ranks;
    it is used only if both agree on the probes and on each task's first texts.
    Texts that hold a special token's string always go through ``tokenizers``,
    and so do texts whose white space is too long for the quick encoder's pattern.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.quick = self._ranked(path)
        if self.quick and self._slow(PROBES) != [self._fast(t) for t in PROBES]:
            self.quick = None

    def _ranked(self, path: str):  # noqa: ANN202
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if model.get("type") != "BPE":
            return None
        # Byte-level vocabularies write the bytes that don't print as characters from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(plain)]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        words = {w: i for w, i in model["vocab"].items() if w not in self.special}
        if not all(c in byte for w in words for c in w):
            return None
        ranks = {bytes(byte[c] for c in w): i for w, i in words.items()}
        return tiktoken.Encoding("own", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})

    def _fast(self, text: str) -> bytes:
        try:
            return self.quick.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        except ValueError:  # a run of white space beyond the pattern's backtracking stack
            return self._slow([text])[0]

    def _slow(self, texts: Sequence[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(list(texts), add_special_tokens=False)]

    def encode(self, texts: list[str], check: bool = False) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; ``check``: compare both ways on the first texts."""
        if self.quick and check:
            few = [t[:2000] for t in texts[:8] if not any(s in t for s in self.special)]
            if self._slow(few) != [self._fast(t) for t in few]:
                self.quick = None
        if not self.quick:
            return self._slow(texts)
        return [self._slow([t])[0] if any(s in t for s in self.special) else self._fast(t) for t in texts]


@lru_cache(1)
def _tokens(path: str) -> Tokens:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
    return Tokens(path)


def pieces(docs: DataFrame, tokenizer: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """(``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``) of each full sequence and rest of each document."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    closing = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for lo in range(0, len(texts), 256):
                out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
                for doc, data in zip(ids[lo:lo + 256], tokens.encode([t or "" for t in texts[lo:lo + 256]], check=lo == 0)):
                    data += closing
                    n = len(data) // 4
                    for start in range(0, n, sequence):
                        part = data[4 * start:4 * (start + sequence)]
                        for k, v in zip(out, (doc, start, len(part) // 4, zlib.crc32(part), n)):
                            out[k].append(v)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], names=list(out))

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"))


def plan(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in a pack, longest first) with their counts for a histogram of lengths."""
    rooms: dict[int, list[tuple[int, tuple[int, ...]]]] = {}  # free tokens -> (count, pattern)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            free = max(rooms, default=0)  # the shortest pack
            if free < length:
                fit = sequence // length
                for k, n in ((fit, left // fit), (left % fit, 1)):
                    if k and n:
                        rooms.setdefault(sequence - k * length, []).append((n, (length,) * k))
                break
            count, pattern = rooms[free].pop()
            used = min(count, left)
            if count > used:
                rooms[free].append((count - used, pattern))
            if not rooms[free]:
                del rooms[free]
            rooms.setdefault(free - length, []).append((used, (*pattern, length)))
            left -= used
    merged: dict[tuple[int, ...], int] = {}
    for packs in rooms.values():
        for n, pattern in packs:
            merged[pattern] = merged.get(pattern, 0) + n
    return sorted(merged.items(), reverse=True)


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, list[int]]]:
    """(length, first rank, end rank, first sequence, offsets): ranks of a length in turn fill a pattern's offsets, sequence after sequence."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, count in patterns:
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in pattern:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, places in offsets.items():
            lo = used.get(length, 0)
            used[length] = lo + count * len(places)
            out.append((length, lo, used[length], sequence, places))
        sequence += count
    return out


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank``: 0, 1, ... among the rows of the same ``length``."""
    order = ["length", "doc_id", "start", "ids_crc32", "__row"]  # the last parts equal rows, which may be any number
    # The position of a row must stay once its partition's offset is known: the dealt rows are written before they are counted.
    names = rows.columns
    rows = cut(rows.withColumn("__row", F.xxhash64(F.monotonically_increasing_id())))  # the ranges are found on a sample, which would make the rows twice
    dealt = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()))
    part, at = F.shiftright("__id", 33).alias("__part"), F.col("__id").bitwiseAND((1 << 33) - 1)
    # One row for each partition and each length in it: at most partitions + lengths, as lengths ascend over partitions.
    counts = dealt.groupBy("length", part).agg(F.count("*").alias("n"), F.min(at).alias("__first")).collect()
    offsets, total = [], {}
    for r in sorted(counts, key=lambda r: (r["length"], r["__part"])):
        offsets.append((r["length"], r["__part"], total.get(r["length"], 0) - r["__first"]))
        total[r["length"]] = total.get(r["length"], 0) + r["n"]
    spark = rows.sparkSession
    shift = F.broadcast(spark.createDataFrame(offsets, "__length long, __p long, __shift long"))
    return (dealt.withColumn("__part", part).withColumn("__at", at)
            .join(shift, (F.col("length") == F.col("__length")) & (F.col("__part") == F.col("__p")))
            .withColumn("rank", F.col("__at") + F.col("__shift")).select(*names, "rank"))


def pack(docs: DataFrame, tokenizer: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Pieces of ``docs`` with the ``sequence_id`` and ``offset`` where each lies."""
    cutup = ranked(pieces(docs, tokenizer, sequence, end_id))
    histogram = {r["length"]: r["count"] for r in cutup.groupBy("length").count().collect()}  # at most ``sequence`` rows
    table = slots(plan(histogram, sequence))
    # At most one row for each pattern and each length in it; the plan depends on the number of lengths, not of documents.
    spots = F.broadcast(docs.sparkSession.createDataFrame(table, "__length long, __lo long, __hi long, __seq long, __offsets array<long>"))
    nth = F.col("rank") - F.col("__lo")
    k = F.size("__offsets")
    return (cutup.join(spots, (F.col("length") == F.col("__length")) & (F.col("rank") >= F.col("__lo")) & (F.col("rank") < F.col("__hi")))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("__seq") + F.floor(nth / k)).cast("long").alias("sequence_id"),
                    F.element_at("__offsets", (nth % k + 1).cast("int")).alias("offset")))
