"""Exact token counts at every prefix of a text by dynamic programming.

For a byte-pair vocabulary the encoding of a prefix ends in one token, and the
rest of it is the encoding of a shorter prefix: a row of tokens is an encoding
exactly if each two neighbours stay apart when they are merged alone. So one
pass over a text finds, for each position, the token that ends there and may
follow the last token before it, and with it the token count of the prefix.
Whether two tokens stay apart follows from their merge histories (``Pieces.apart``)
and is remembered.

No piece holds a space mark after another character, so a text falls into
units, each a run of spaces and the word after it, that are encoded alone; a
block's distinct units are counted side by side. A text is read once; how
many tokens a prefix has, or the longest prefix within a budget, is answered
from the stored counts (``tokens_at``, ``longest_within``) without encoding again.

The vocabulary is a SentencePiece BPE model whose normaliser changes nothing
and puts a space in front (other models are refused). As with the library's
own encoder, a character outside the vocabulary costs its UTF-8 bytes, control
pieces' strings are ordinary text, and an empty text has no token.

Defined results: a null text is an empty text; a row with a null id is counted
too; repeated rows are counted as often as they occur; an empty table gives an
empty one; other columns are not read, whatever their names. A text is never
cut; the longest one costs some hundred bytes a character in memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbweave.llm.tokens import text_bytes

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
SPACE = "▁"
#: Bytes of text counted at a time (or one text), and pairs of pieces remembered by a task.
BLOCK_BYTES, PAIRS = 2 << 20, 1 << 20
#: Units that are counted side by side at least; what is left of longer ones is counted one by one.
ABREAST = 32
_NEVER = float("inf")


class Slots:
    """Whole numbers by 64-bit keys, looked up by arrays: open addressing over a power of two slots, none removed."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(8, int(4 * keys.size).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.value = np.full(1 << self.bits, -1, np.int32)
        left = np.arange(keys.size)
        at = _slot(keys, self.bits)
        while left.size:
            free = self.key[at] < 0
            self.key[at[free]] = keys[left[free]]  # of several keys for a slot one stays
            kept = self.key[at] == keys[left]
            self.value[at[kept]] = values[left[kept]]
            left, at = left[~kept], (at[~kept] + 1) & (self.key.size - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 if there is none."""
        at = _slot(keys, self.bits)
        out = np.where(self.key[at] == keys, self.value[at], -1)
        again = np.flatnonzero((self.key[at] != keys) & (self.key[at] >= 0))
        at = at[again]
        while again.size:
            at = (at + 1) & (self.key.size - 1)
            hit = self.key[at] == keys[again]
            out[again[hit]] = self.value[at[hit]]
            go = ~hit & (self.key[at] >= 0)
            again, at = again[go], at[go]
        return out


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class Pieces:
    """A BPE vocabulary with the merge history of each piece."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        spec.ParseFromString(library.serialized_model_proto())
        form, kind = spec.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        if (spec.trainer_spec.model_type != sentencepiece_model_pb2.TrainerSpec.BPE or not spec.trainer_spec.byte_fallback
                or form.precompiled_charsmap or form.remove_extra_whitespaces or not form.add_dummy_prefix or not form.escape_whitespaces):
            raise ValueError("only BPE models with bytes for unknown characters and no normalisation but the space mark")
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in spec.pieces):
            raise ValueError("models with user-defined or unused pieces are encoded by other rules")
        #: Order in which pieces are merged: the best score first, at one score the leftmost pair.
        self.rank = {p.piece: -p.score for p in spec.pieces if p.type == kind.NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            raise ValueError("a piece goes over a word's end")
        #: Pieces that end (start) a piece while it is merged, smallest first, each with the rank of the merge that makes it.
        self.tail: dict[str, list[tuple[str, float]]] = {}
        self.head: dict[str, list[tuple[str, float]]] = {}
        for piece in sorted(self.rank, key=len):
            self._learn(piece)
        self.names = list(self.tail)
        self._trie()
        # Known pairs, the answer in the lowest bit; a slot keeps its last pair.
        self._pairs = np.full(PAIRS, -1, np.int64)

    def _learn(self, piece: str) -> None:
        """Merge the characters of ``piece``; if they end as one piece, note how it was made."""
        parts = list(piece)
        if any(c not in self.rank for c in parts):
            return
        last = None
        while len(parts) > 1:
            merges = [(self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank]
            if not merges:
                return
            _, i = min(merges)
            last = parts[i], parts[i + 1]
            parts[i:i + 2] = ["".join(last)]
        own = [(piece, self.rank[piece] if last else -_NEVER)]
        self.tail[piece] = (self.tail[last[1]] if last else []) + own
        self.head[piece] = (self.head[last[0]] if last else []) + own

    def _trie(self) -> None:
        """Nodes of the pieces' beginnings: steps by (node, character), and the piece at each node."""
        self.longest = max(map(len, self.names), default=1)
        letters = {c: i + 1 for i, c in enumerate(sorted(set("".join(self.names))))}
        self.letter = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.letter[[ord(c) for c in letters]] = list(letters.values())
        self.letters = len(letters) + 1
        steps: dict[int, int] = {}
        piece = [-1]
        for number, name in enumerate(self.names):
            node = 0
            for c in name:
                key = node * self.letters + letters[c]
                node = steps.setdefault(key, len(piece))
                if node == len(piece):
                    piece.append(-1)
            piece[node] = number
        self.piece_at = np.array(piece, np.int32)
        self.steps = Slots(np.array(list(steps), np.int64), np.array(list(steps.values()), np.int32))

    def _apart(self, left: str, right: str) -> bool:
        """Whether the two pieces, one after the other, are encoded as these two.

        Follows what stands on both sides of their border while each is merged:
        they don't stay apart if a merge over the border has its turn before
        both next merges beside it (at one rank the left one comes first).
        """
        before, after = self.tail[left], self.head[right]
        i = j = 0
        while True:
            over = self.rank.get(before[i][0] + after[j][0], _NEVER)
            next_left = before[i + 1][1] if i + 1 < len(before) else _NEVER
            next_right = after[j + 1][1] if j + 1 < len(after) else _NEVER
            if over < next_left and over <= next_right and over < _NEVER:
                return False
            if next_left == next_right == _NEVER:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``_apart`` of each pair of piece numbers; a ``left`` below 0 (nothing, or an unknown character) stays apart."""
        key = left.astype(np.int64) * len(self.names) + right
        at = _slot(key, 20) & (PAIRS - 1)
        kept = self._pairs[at]
        out = (left < 0) | (kept & 1).astype(bool)
        missing = np.flatnonzero((left >= 0) & (kept >> 1 != key))
        if missing.size:
            new, back = np.unique(key[missing], return_inverse=True)
            told = np.array([self._apart(self.names[k // len(self.names)], self.names[k % len(self.names)]) for k in new.tolist()])
            out[missing] = told[back]
            self._pairs[_slot(new, 20) & (PAIRS - 1)] = new << 1 | told
        return out

    def count(self, chars: np.ndarray, off: np.ndarray) -> np.ndarray:
        """For each character of the units [off[i], off[i + 1]) of ``chars``: tokens of the unit's prefix that ends there."""
        size = np.diff(off)
        order = np.argsort(-size, kind="stable")
        # Laid out by place in the unit, the longest units first: what is looked at together lies together.
        width = np.searchsorted(-size[order], -np.arange(int(size.max(initial=0)) + 1), side="left")  # units longer than a place
        row = np.concatenate([[0], np.cumsum(width[:-1])])
        place = np.repeat(np.arange(width.size - 1), width[:-1])
        rank = np.arange(chars.size) - row[place]
        spread = off[:-1][order][rank] + place
        letter, code = self.letter[chars[spread]], chars[spread]
        # The pieces that end at each place, by length: all starts walk down the trie together.
        ending = np.full((self.longest, chars.size), -1, np.int32)
        node = np.zeros(chars.size, np.int64)
        for length in range(self.longest):
            here = row[place] + rank
            seen = letter[here]
            node = self.steps.get(node * self.letters + seen)
            alive = (node >= 0) & (seen > 0)
            node, here, place, rank = node[alive].astype(np.int64), here[alive], place[alive] + 1, rank[alive]
            ending[length, here] = self.piece_at[node]
            inside = rank < width[place]
            node, place, rank = node[inside], place[inside], rank[inside]
        cost = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        counts = np.zeros(chars.size, np.int64)
        last = np.full(chars.size, -1, np.int32)
        for end in range(width.size - 1):
            n, at = int(width[end]), int(row[end])
            if n < ABREAST:
                for i in range(n):
                    self._alone(row[:int(size[order[i]])] + i, end, ending, cost, last, counts)
                break
            open_ = np.ones(n, bool)
            for length in range(min(self.longest, end + 1) - 1, -1, -1):
                pieces = ending[length, at:at + n]
                found = np.flatnonzero((pieces >= 0) & open_)
                if not found.size:
                    continue
                pieces = pieces[found]
                if length < end:
                    before = int(row[end - length - 1]) + found
                    ok = self.apart(last[before], pieces)
                    found, pieces, base = found[ok], pieces[ok], counts[before[ok]]
                else:  # from the unit's start on
                    base = 0
                last[at + found], counts[at + found] = pieces, base + 1
                open_[found] = False
            found = np.flatnonzero(open_)
            if found.size:  # outside the vocabulary
                counts[at + found] = cost[at + found] + (counts[int(row[end - 1]) + found] if end else 0)
        out = np.empty_like(counts)
        out[spread] = counts
        return out

    def _alone(self, places: np.ndarray, end: int, ending: np.ndarray, cost: np.ndarray, last: np.ndarray, counts: np.ndarray) -> None:
        """``count`` of one unit, at ``places``, from its character ``end`` on."""
        known: dict[tuple[int, int], bool] = {}
        lasts, totals = last[places].tolist(), counts[places].tolist()
        for here in range(end, places.size):
            pieces = ending[:, places[here]]
            for length in np.flatnonzero(pieces >= 0)[::-1].tolist():
                piece, before = int(pieces[length]), here - length - 1
                if before >= 0 and lasts[before] >= 0:
                    pair = lasts[before], piece
                    if pair not in known:
                        known[pair] = self._apart(self.names[pair[0]], self.names[piece])
                    if not known[pair]:
                        continue
                lasts[here], totals[here] = piece, 1 + (totals[before] if before >= 0 else 0)
                break
            else:
                totals[here] = int(cost[places[here]]) + (totals[here - 1] if here else 0)
        counts[places] = totals


@lru_cache(1)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


class Counted:
    """The units of a block of texts, with the token counts of their prefixes."""

    def __init__(self, pieces: Pieces, texts: pa.Array):
        # The library's space mark in a text is a space to it.
        parted = pc.split_pattern(pc.replace_substring(texts, pattern=SPACE, replacement=" "), pattern=" ")
        first = parted.offsets.to_numpy()
        parts = parted.flatten()
        coded = parts.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        empty = np.asarray(pc.equal(pc.binary_length(parts), 0))
        self.first = first - first[0]
        starts, ends = np.zeros(empty.size, bool), np.zeros(empty.size, bool)
        starts[self.first[:-1]] = True
        ends[self.first[1:] - 1] = True
        # Spaces before each part: one, and one for each empty part right before it in the text.
        at = np.arange(empty.size)
        broken = np.ones(empty.size, bool)
        broken[1:] = ~empty[:-1] | starts[1:]
        spaces = at - np.maximum.accumulate(np.where(broken, at, 0)) + 1
        #: Parts that end a unit: words, and what a text ends with. A text without a character has none.
        self.is_unit = (~empty | ends) & ~(starts & ends & empty)
        # Each word after one space, and the few units after more.
        words, more = coded.dictionary, {}
        for i in np.flatnonzero(self.is_unit & (spaces > 1)).tolist():
            unit = SPACE * int(spaces[i]) + words[code[i]].as_py()
            code[i] = more.setdefault(unit, len(words) + len(more))
        units = pa.concat_arrays([pc.binary_join_element_wise(SPACE, words, ""), pa.array(list(more), words.type)])
        size = pc.utf8_length(units).to_numpy(zero_copy_only=False)
        data, _ = text_bytes(units)
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        self.code = code
        self.off = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        self.counts = pieces.count(chars, self.off)
        self.total = np.where(self.is_unit, self.counts[self.off[code + 1] - 1], 0) if chars.size else np.zeros(code.size, np.int64)

    def totals(self) -> np.ndarray:
        """Tokens of each text."""
        sums = np.concatenate([[0], np.cumsum(self.total)])
        return sums[self.first[1:]] - sums[self.first[:-1]]

    def text(self, i: int) -> np.ndarray:
        """Token counts of the prefixes of 1, 2, ... characters of text ``i``."""
        parts = np.arange(self.first[i], self.first[i + 1])
        parts = parts[self.is_unit[parts]]
        if not parts.size:
            return np.zeros(0, np.int64)
        base = np.cumsum(self.total[parts]) - self.total[parts]
        whole = [self.counts[self.off[u]:self.off[u + 1]] + b for u, b in zip(self.code[parts], base, strict=True)]
        return np.concatenate(whole)[1:]  # without the space put in front


def _blocks(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of runs of at most ``BLOCK_BYTES``, or one text."""
    bytes_to = np.cumsum(np.asarray(pc.binary_length(texts)), dtype=np.int64)
    lo = 0
    while lo < len(texts):
        done = bytes_to[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(bytes_to, done + BLOCK_BYTES, side="right")))
        yield lo, texts.slice(lo, hi - lo)
        lo = hi


def _count_texts(docs: DataFrame, doc_id: str, text: str, path: str, schema: str, result) -> DataFrame:  # noqa: ANN001
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        for batch in batches:
            ids, texts = batch.column(0), pc.fill_null(batch.column(1), "")
            for lo, some in _blocks(texts):
                yield from result(ids.slice(lo, len(some)), some, Counted(pieces, some))

    one = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return one.mapInArrow(run, schema)


def _within(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if fits.size else 0


def token_counts(docs: DataFrame, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens), ``fit_chars``.

    ``fit_chars`` is the length in characters of the longest prefix of at most ``limit`` tokens.
    """
    def result(ids: pa.Array, texts: pa.Array, counted: Counted) -> Iterator[pa.RecordBatch]:
        tokens = counted.totals()
        fit = np.array(pc.utf8_length(texts), np.int64)
        for i in np.flatnonzero(tokens > limit):
            fit[i] = _within(counted.text(i), limit)
        yield pa.RecordBatch.from_arrays([ids, pc.cast(pc.binary_length(texts), pa.int64()), pa.array(tokens, pa.int64()),
                                          pa.array(tokens > limit), pa.array(fit, pa.int64())],
                                         names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    return _count_texts(docs, doc_id, text, model or public_tokenizers.path(MODEL),
                        "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long", result)


def prefix_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """Per row: ``doc_id`` and ``prefix_steps``, by how much each further character changes the prefix's token count.

    Most steps are -1, 0 or 1, so a stored column of them takes few bits a
    character; ``tokens_at`` and ``longest_within`` read it. Rows come one at a
    time, so that a batch holds the steps of one text only.
    """
    def result(ids: pa.Array, texts: pa.Array, counted: Counted) -> Iterator[pa.RecordBatch]:
        for i in range(len(ids)):
            steps = np.diff(counted.text(i), prepend=0).astype(np.int16)
            yield pa.RecordBatch.from_arrays([ids.slice(i, 1), pa.ListArray.from_arrays(pa.array([0, steps.size], pa.int32()), pa.array(steps))],
                                             names=["doc_id", "prefix_steps"])

    return _count_texts(docs, doc_id, text, model or public_tokenizers.path(MODEL), "doc_id long, prefix_steps array<short>", result)


def tokens_at(steps: Column, chars: Column) -> Column:
    """Token count of the prefix of ``chars`` characters (all, if there are fewer; 0 for none)."""
    some = F.slice(steps, F.lit(1), F.greatest(chars.cast("int"), F.lit(0)))
    return F.aggregate(some, F.lit(0).cast("long"), lambda total, step: total + step)


def longest_within(steps: Column, budget: Column) -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    start = F.struct(F.lit(0).cast("long").alias("tokens"), F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("fit"))

    def further(so_far: Column, step: Column) -> Column:
        tokens, at = so_far["tokens"] + step, so_far["at"] + 1
        return F.struct(tokens.alias("tokens"), at.alias("at"), F.when(tokens <= budget, at).otherwise(so_far["fit"]).alias("fit"))

    return F.aggregate(steps, start, further, lambda done: done["fit"])
