"""Secret scanning: three base patterns, and assignment-aware lexing of names and literals.

Base kinds (spans of whole matches, leftmost and non-overlapping per kind):
``assign`` (a keyword, ``:`` or ``=``, a value of 6 or more characters),
``access`` (AKIA keys of 20 or more) and ``hex`` (24 or more).

The lexer reads source and configuration syntax (``name = "x"``, ``"name": x``,
``export NAME=x``, ``name := 'x'``, ``name => x``, XML attributes) into pairs of
a name and a literal or another name. Names that stand for a name are followed
within the text until nothing changes (``DB = "..."`` then ``password = DB``).
A value without quotes is a name if the text gives that name a value, and else
a literal as in .env, INI and YAML files; identifiers that are called or compared
(``f(x)``, ``a == b``) are neither.
Literals joined by ``+``, ``.`` or ``&`` are one, from the first's start to the last's
end. A plain ``value`` is named by what holds it: the object that it stands in
(``"client_secret": {"value": "x"}``), the YAML block above it (``credentials:``), or
the ``name`` or ``key`` before it (``name: DB_PASSWORD``, then ``value: x``).
A literal of several words counts as a passphrase of three words or more without
words of a sentence; names as common as ``pin`` and ``key`` only count with a
literal of the shape of one (``SHAPED``).
A literal's score is the weight of the most sensitive name that it reaches
times how much the literal looks like a secret; from ``MIN_SCORE`` on it is
reported, as ``pair`` where the name is its own and as ``flow`` where the name
is reached through others. These spans cover the literal without its quotes.

Defined results: a null text is an empty text without findings; repeated rows
are scanned one by one; rows with a null ``doc_id`` too; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: In the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "pair", "flow")
MIN_SCORE = 0.5

# The base patterns and least lengths.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE = 6

PAIR = re.compile(
    r"""(?<![\w.$-])(?P<q>["'`]?)(?P<name>[A-Za-z_$][\w.$-]*+)(?P=q)[ \t]*+(?::=|=>|==?|:)[ \t]*+"""
    r"""(?:"(?P<double>(?:[^"\\\n]|\\.)*+)"|'(?P<single>(?:[^'\\\n]|\\.)*+)'|`(?P<back>[^`\n]*+)`|(?P<bare>[^\s"'`,;(){}\[\]<>]++))""", re.ASCII)
NAME = re.compile(r"[A-Za-z_$][\w.$-]*", re.ASCII)
CALL = re.compile(r"\([^()\n]*+[()]")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

#: Weights of name parts and of neighbouring parts written together.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "secret": 1.0, "token": 0.9, "credential": 0.9, "credentials": 0.9,
    "apikey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "privatekey": 1.0, "authkey": 1.0, "signingkey": 1.0, "encryptionkey": 1.0, "masterkey": 1.0,
    "accountkey": 0.9, "sessionkey": 0.9, "authorization": 0.8, "bearer": 0.8, "auth": 0.6, "signature": 0.6, "salt": 0.6, "pass": 0.8, "pin": 0.1, "key": 0.1,
}
#: Names that mean a secret only if the literal looks like one, and their weight then.
SHAPED = {0.1: re.compile(r"\d{4,12}|(?=.*\d)(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_.=-]{16,}|[0-9a-f]{32,}", re.ASCII)}
SHAPED_WEIGHT = 0.9
#: Words of sentences: a literal with one of them is no passphrase.
SENTENCE = {"a", "an", "and", "are", "as", "at", "be", "by", "can", "cannot", "do", "enter", "for", "from", "has", "have", "if", "in", "invalid", "is", "it", "its", "must", "my", "new", "no",
            "not", "of", "on", "or", "password", "please", "required", "reset", "secret", "should", "that", "the", "this", "to", "token", "was", "will", "with", "you", "your"}
PASSPHRASE = 0.7
#: Names that say nothing of what they hold, and those whose literal names the value beside them.
VALUES = {"value", "val", "default", "data", "plain", "plaintext", "raw", "content", "string", "literal"}
NAMES = {"name", "key", "id", "env", "variable"}
JOINED = re.compile(r"""\s*+(?:\.\.|[+.&])\s*+(?:"(?P<double>(?:[^"\\\n]|\\.)*+)"|'(?P<single>(?:[^'\\\n]|\\.)*+)')""")
OBJECT = re.compile(r"""(?P<q>["'`]?)(?P<name>[A-Za-z_$][\w.$-]*+)(?P=q)[ \t]*+(?:=>|=|:)\s*+(?={)""", re.ASCII)
BRACES = re.compile(r""""(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|[{}]""")
LINE = re.compile(r"""^(?P<indent>[ \t]*+)(?:- +)?(?:["']?(?P<name>[A-Za-z_$][\w.$-]*+)["']?[ \t]*+:[ \t]*+(?:#.*)?$|\S)""", re.ASCII | re.M)
PLACEHOLDER = re.compile(r"(?i)^(?:true|false|null|none|nil|undefined|yes|no|x+|\*+|\.+|change_?me|example|sample|test|dummy|placeholder|your[_-].*|<.*>|\$\{.*|\$\(.*|%\(.*|\{\{.*)$")


class Finding(NamedTuple):
    kind: str
    start: int
    end: int
    name: str
    score: float


def name_weight(name: str) -> float:
    """How sensitive a target name is, 0 to 1."""
    parts = [p.lower() for p in PART.findall(name)]
    both = parts + [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return max((SENSITIVE.get(p, 0.0) for p in both), default=0.0)


def literal_weight(text: str) -> float:
    """How much a literal looks like a secret, 0 to 1: its length, spread of characters and their classes."""
    if len(text) < MIN_VALUE or PLACEHOLDER.match(text):
        return 0.0
    if " " in text:
        words = text.split()
        return PASSPHRASE if len(words) >= 3 and all(w.isalnum() for w in words) and SENTENCE.isdisjoint(map(str.lower, words)) else 0.0
    n = len(text)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(text).values())
    classes = sum(any(map(test, text)) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, 0.3 + 0.1 * entropy + 0.1 * (classes - 1) + 0.01 * min(n, 20))


class _Pair(NamedTuple):
    at: int  # where the name begins
    name: str
    start: int
    end: int
    value: str
    bare: bool
    compared: bool


def _pairs(text: str) -> list[_Pair]:
    out = []
    for m in PAIR.finditer(text):
        kind = m.lastgroup or ""
        start, end = m.span(kind)
        parts = [m[kind]]
        if kind == "bare":
            if parts[0].startswith("//"):  # the rest of an URL's scheme is no value
                continue
        elif kind != "back":
            while j := JOINED.match(text, end + 1):
                parts.append(j[j.lastgroup])
                end = j.end() - 1
        out.append(_Pair(m.start(), m["name"], start, end, "".join(parts), kind == "bare", "==" in text[m.end("name"):start]))
    return out


def _holders(text: str, pairs: list[_Pair]) -> dict[int, str]:
    """What names the plain values among the pairs, by the place of the pair."""
    plain = [p.at for p in pairs if p.name.lower() in VALUES]
    if not plain:
        return {}
    out: dict[int, str] = {}
    opened = {m.end(): m["name"] for m in OBJECT.finditer(text)}
    steps = [(m.start(), m.start() if m[0] == "{" else -1) for m in BRACES.finditer(text) if m[0] in "{}"] if opened else []
    stack: list[str] = []
    at = 0
    for place in plain:
        while at < len(steps) and steps[at][0] < place:
            if steps[at][1] >= 0:
                stack.append(opened.get(steps[at][1], ""))
            elif stack:
                stack.pop()
            at += 1
        if stack and stack[-1]:
            out[place] = stack[-1]
    blocks: list[tuple[int, str]] = []
    rest = iter(plain)
    place = next(rest, None)
    for m in LINE.finditer(text):
        if place is None:
            break
        indent = len(m["indent"])
        while blocks and blocks[-1][0] >= indent:
            blocks.pop()
        end = text.find("\n", m.end())
        while place is not None and place < (end if end >= 0 else len(text)):
            if blocks and place >= m.start():
                out.setdefault(place, blocks[-1][1])
            place = next(rest, None)
        if m["name"]:
            blocks.append((indent, m["name"]))
    for before, pair in zip(pairs, pairs[1:], strict=False):
        if pair.name.lower() in VALUES and before.name.lower() in NAMES and NAME.fullmatch(before.value) and pair.at - before.end < 200 and not text[before.end:pair.at].strip("\"'`, \t\r\n"):
            out[pair.at] = before.value
    return out


def lexed(text: str) -> list[Finding]:
    """``pair`` and ``flow`` findings of a text."""
    if ":" not in text and "=" not in text:
        return []
    pairs = _pairs(text)
    holders = _holders(text, pairs)
    names = {p.name for p in pairs}
    literals: list[tuple[_Pair, str]] = []  # with its own name
    alias: dict[str, set[str]] = {}  # a name -> the names that are given its value
    for p in pairs:
        name = f"{holders[p.at]}.{p.name}" if p.at in holders else p.name
        if p.bare and p.value in names:
            alias.setdefault(p.value, set()).add(name)
        elif not (p.bare and NAME.fullmatch(p.value.rstrip(":")) and (p.compared or CALL.match(text, p.end))):
            literals.append((p, name))
    reached = _most_sensitive(names | {name for _, name in literals}, alias)
    found = []
    for p, name in literals:
        worth = literal_weight(p.value)
        best, via = reached[name]
        if (score := _shaped(best, p.value) * worth) >= MIN_SCORE:
            own = _shaped(name_weight(name), p.value) * worth >= MIN_SCORE
            found.append(Finding("pair" if own else "flow", p.start, p.end, via, score))
    return found


def _shaped(weight: float, value: str) -> float:
    """The weight of a name with this literal."""
    return (SHAPED_WEIGHT if SHAPED[weight].fullmatch(value) else 0.0) if weight in SHAPED else weight


def _most_sensitive(names: set[str], alias: dict[str, set[str]]) -> dict[str, tuple[float, str]]:
    """(weight, name) of the most sensitive name that each name's value reaches; its own name, then the least one, wins ties.

    Weights go backwards from the most sensitive names, so each name is settled
    once, however long the chains of names are.
    """
    every = names | set(alias) | set().union(*alias.values())
    givers: dict[str, list[str]] = {}
    for giver, targets in alias.items():
        for target in targets:
            givers.setdefault(target, []).append(giver)
    out: dict[str, tuple[float, str]] = {}
    for weight, top in sorted(((name_weight(n), n) for n in every), key=lambda x: (-x[0], x[1])):
        todo = [top]
        while todo:
            if (name := todo.pop()) not in out:
                out[name] = (weight, name if name_weight(name) == weight else top)
                todo += givers.get(name, ())
    return out


def scan(text: str) -> list[Finding]:
    """All findings of a text by start, then kind."""
    found = [Finding("assign", *m.span(), m[1], 1.0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    found += [Finding("access", *m.span(), "", 1.0) for m in ACCESS.finditer(text)]
    found += [Finding("hex", *m.span(), "", 1.0) for m in HEX.finditer(text)]
    return sorted([*found, *lexed(text)], key=lambda f: (f.start, KINDS.index(f.kind), f.end))


FINDINGS = "array<struct<kind:string,start:int,end:int,name:string,score:double>>"
_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("name", pa.string()), ("score", pa.float64())]))


def scan_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and its ``findings``; offsets are code points, ends exclusive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[f._asdict() for f in scan(t)] if t else [] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, _TYPE)], names=["doc_id", "findings"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, f"doc_id long, findings {FINDINGS}"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the SHA-256 of the base spans, and all spans as text."""
    def listed(kinds: tuple[str, ...]):  # noqa: ANN202
        return F.filter("findings", lambda f: f["kind"].isin(*kinds))

    def written(spans):  # noqa: ANN001, ANN202
        return F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")

    counts = [F.size(listed((k,))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts[:3], F.sha2(written(listed(KINDS[:3])).cast("binary"), 256).alias("base_sha256"),
        written(F.col("findings")).alias("spans"), *counts[3:])


def sha256_of(spans: list[tuple[str, int, int]]) -> str:
    """The digest of base spans, as ``digest`` writes it."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
