"""lorewright: a Spark-native engine for scholarly knowledge-graph snapshots.

Nested JSON snapshots are flattened into relational tables, merged
incrementally, and mapped to graph vertices, edges, documents and vectors.
Every stage is a lazily composed DataFrame plan.
"""

__version__ = "0.1.0"
