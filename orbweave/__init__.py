"""orbweave: property-graph analytics as Spark DataFrame operators.

A graph is two DataFrames (``orbweave.model.Graph``); every operator in
``orbweave.operators`` is a function ``op(graph, ...) -> DataFrame`` whose work
runs on Spark. ``orbweave.sources`` builds, stores and mirrors graphs;
``orbweave.plans`` holds the query catalogue used by ``__spark_entry__``.
"""

from orbweave.model import EDGE_SCHEMA, NODE_SCHEMA, Graph

__version__ = "0.1.0"
__all__ = ["Graph", "NODE_SCHEMA", "EDGE_SCHEMA", "__version__"]
