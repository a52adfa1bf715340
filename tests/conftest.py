import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from orbweave.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="orbweave-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def make_graph(spark):
    """Build a Graph from ``[(id, [labels], {props})]`` and ``[(id, type, src, dst)]``."""
    from orbweave.model import EDGE_SCHEMA, NODE_SCHEMA, Graph

    def build(nodes, edges):
        n = spark.createDataFrame(
            [(i, labels, props or {}) for i, labels, props in nodes], NODE_SCHEMA)
        e = spark.createDataFrame([(i, t, s, d, {}) for i, t, s, d in edges], EDGE_SCHEMA)
        return Graph(n, e)
    return build
