"""Operators of a large-scale training-data pipeline (one module each).

Nothing else in the package imports this subpackage; ``llm.queries`` holds
the registered queries.
"""
