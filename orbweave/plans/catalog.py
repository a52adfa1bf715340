"""Query catalogue: one Spark callable and (where SQL can say it) one DuckDB oracle per key.

Every callable takes ``(spark, sf_dir)``, derives the graph from that
directory's tables and returns a DataFrame over the whole graph. Parameters
(hub officer, edge types, path endpoints, fragments) come from the run-time
sample context, which the oracle derives the same way in SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orbweave.model import Graph
from orbweave.plans.context import Context, resolve_context
from orbweave.operators.search import TokenIndex, store_token_index
from orbweave.sources.etl import Mirror, all_nodes, mirror, store_mirror
from orbweave.session import checkpoint_dir, spread_shuffles
from orbweave.sources.fixture import fixture_graph, rows_of, store_on_demand

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_GRAPHS: dict[tuple, Graph] = {}
_CONTEXTS: dict[tuple, Context] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"))


def graph_for(spark: SparkSession, sf_dir: str) -> Graph:
    """The fixture graph of ``sf_dir``, derived once per session and read from its stored tables."""
    k = _key(spark, sf_dir)
    if k not in _GRAPHS:
        # Derive once, store as sorted parquet tables in the shared checkpoint
        # folder, then serve every query from those scans, whatever their size.
        folder = f"{checkpoint_dir(spark).rstrip('/')}/graph-{uuid.uuid4().hex}"
        spread_shuffles(spark, rows_of(spark, sf_dir))
        _GRAPHS[k] = store_on_demand(fixture_graph(spark, sf_dir), folder)
    return _GRAPHS[k]


def mirror_for(spark: SparkSession, sf_dir: str) -> Mirror:
    """The ETL projection of the graph, computed (used by the ETL queries themselves)."""
    return mirror(graph_for(spark, sf_dir))


_MIRRORS: dict[tuple, Mirror] = {}


def loaded_mirror_for(spark: SparkSession, sf_dir: str) -> Mirror:
    """The mirror as loaded tables: projected once, stored in the shared checkpoint
    folder and read back. SQL-side queries run against it,
    as the relational mirror is queried after its load."""
    k = _key(spark, sf_dir)
    if k not in _MIRRORS:
        folder = f"{checkpoint_dir(spark).rstrip('/')}/mirror-{uuid.uuid4().hex}"
        _MIRRORS[k] = store_mirror(mirror_for(spark, sf_dir), folder)
    return _MIRRORS[k]


_TOKENS: dict[tuple, TokenIndex] = {}


def token_index_for(spark: SparkSession, sf_dir: str) -> TokenIndex:
    """The mirror's token index, written once per session beside it."""
    k = _key(spark, sf_dir)
    if k not in _TOKENS:
        folder = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
        _TOKENS[k] = store_token_index(all_nodes(loaded_mirror_for(spark, sf_dir)), folder)
    return _TOKENS[k]


def context_for(spark: SparkSession, sf_dir: str) -> Context:
    k = _key(spark, sf_dir)
    if k not in _CONTEXTS:
        _CONTEXTS[k] = resolve_context(graph_for(spark, sf_dir))
    return _CONTEXTS[k]


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from orbweave.plans import queries_graph  # noqa: F401
    from orbweave.plans import queries_etl  # noqa: F401
    from orbweave.plans import queries_paths  # noqa: F401
    from orbweave.plans import queries_algorithms  # noqa: F401
    from orbweave.plans import queries_mutations  # noqa: F401


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)
