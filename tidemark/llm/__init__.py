"""Operators for large-scale training-data pipelines.

Nothing outside this folder imports it. Each module holds one operator with
its own interface; ``queries`` applies them to the given tables.
"""
