"""Column expressions shared by the operators (all JVM-side, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Whitespace stripped by the normaliser: ASCII whitespace, every Unicode
# separator and the byte-order mark (what a JavaScript ``trim()`` removes).
WS_CLASS = r"[\s\p{Z}\x{FEFF}]"
WS_TRIM_PATTERN = rf"^{WS_CLASS}+|{WS_CLASS}+$"
# Node kinds in priority order, then the fallback kind.
KIND_PRIORITY = ["Officer", "Entity", "Intermediary", "Address"]
KIND_OTHER = "Other"
# Edge types accepted by the identifier checks.
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_]*"
EDGE_TYPE_PATTERN = rf"^{IDENTIFIER}\z"


def norm_text(col: Column | str) -> Column:
    """Value -> trimmed text; blank or missing -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    trimmed = F.regexp_replace(c.cast("string"), WS_TRIM_PATTERN, "")
    return F.when(F.length(trimmed) > 0, trimmed)


def kind_from_labels(labels: Column | str = "labels") -> Column:
    """First of Officer, Entity, Intermediary, Address present in labels, else Other."""
    c = F.col(labels) if isinstance(labels, str) else labels
    expr = F.lit(KIND_OTHER)
    for kind in reversed(KIND_PRIORITY):
        expr = F.when(F.array_contains(c, kind), F.lit(kind)).otherwise(expr)
    return expr


def first_label(labels: Column | str = "labels") -> Column:
    """``labels[0]`` — the first stored label (NULL for an empty list)."""
    c = F.col(labels) if isinstance(labels, str) else labels
    return F.get(c, 0)


def prop(key: str, props: str = "props") -> Column:
    """A property value or NULL when the key is absent."""
    return F.col(props).getItem(key)


def display_name(kind: Column, node_id: Column, props: str = "props") -> Column:
    """name, else address, else ``"<kind> #<id>"`` (raw values, no trimming)."""
    return F.coalesce(prop("name", props), prop("address", props),
                      F.concat(kind, F.lit(" #"), node_id.cast("string")))


def name_fragment(name: Column | str) -> Column:
    """First whitespace-separated token with at least 4 characters, else the first 6 characters."""
    c = F.col(name) if isinstance(name, str) else name
    tokens = F.split(c, f"{WS_CLASS}+")
    long_tokens = F.filter(tokens, lambda t: F.length(t) >= 4)
    return F.coalesce(F.get(long_tokens, 0), F.substring(c, 1, 6))


def edge_caption(type_col: Column | str = "type") -> Column:
    """Edge type for display: underscores become spaces."""
    c = F.col(type_col) if isinstance(type_col, str) else type_col
    return F.translate(c, "_", " ")

