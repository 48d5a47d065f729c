"""graphweave: documents to property-graph tables on Spark.

Every public operator is a plain function from DataFrame(s) to DataFrame(s).
Sub-packages:

* ``functions`` – Column-level helpers (keys, truthiness, literals, text).
* ``sources``   – file discovery, text readers, extraction store, manifest, scripts.
* ``operators`` – chunking, extraction, completion, merge, repair, edges, graph,
  vectors, export, statistics.
* ``plans``     – end-to-end batch plans and the derived views used by queries.
* ``streaming`` – incremental ingest with Structured Streaming.
"""

__version__ = "0.1.0"
