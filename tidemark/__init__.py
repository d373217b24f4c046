"""tidemark: a snapshot warehouse on Spark.

Periodic full snapshots in, type-2 history, change events, rule-checked
quality logs and reporting aggregates out; every operator is a plain
DataFrame -> DataFrame function planned by Catalyst.
"""

__version__ = "0.1.0"
