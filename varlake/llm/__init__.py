"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; the thin queries over the given tables are in
:mod:`varlake.llm.queries`.
"""
