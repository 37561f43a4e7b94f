"""Labelled rows for the trained operators: which are held out, and the others, all
or a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def is_held_out(doc_id: str, modulus: int, rest: int) -> Column:
    """Whether a document's label must not be learned from; a null id is not
    held out, and no label has it either."""
    return F.coalesce(remainder(doc_id, modulus) == rest, F.lit(False))


def training_labels(labels: DataFrame, label: str, modulus: int, rest: int,
                    max_rows: int | None) -> DataFrame:
    """``__lid, __y``: one row per document with a label of 0 or 1 that is not held out
    (1 if its labels differ), about ``max_rows`` of them at most, if given, chosen by
    a hash of the id."""
    y = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()
                     & ~is_held_out("doc_id", modulus, rest))
        .groupBy(F.col("doc_id").alias("__lid")).agg(F.max(label).cast("int").alias("__y"))
    )
    if max_rows is None:
        return y
    rows = y.count()
    if rows <= max_rows:
        return y
    steps = 1 << 20
    return y.where(F.pmod(F.xxhash64("__lid"), F.lit(steps)) < steps * max_rows // rows)
