"""Chromosome order (O1, O2) and the existence test by one row (O3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.functions.keys import chromosome_rank, to_long
from varlake.operators.bins import GenomicBins


def chromosome_order(df: DataFrame, tie_break: bool = True,
                     tie_break_columns: list[str] | None = None,
                     bins: GenomicBins | None = None) -> DataFrame:
    """O1/O2: sort by chromosome (1..22, X, Y, then other contigs) and numeric
    ``start``.

    The sort is a range-partitioned shuffle unless ``bins`` are given; rows with an equal
    (chromosome, start) cannot be split by the range partitioner, so with
    ``tie_break`` the alleles and a hash of the whole row are appended to the
    sort key: a position that holds a third of the rows is then spread over
    many range partitions instead of landing in one task.
    ``tie_break_columns`` limits the hash to the columns that tell rows of one
    position apart (e.g. a pipeline's input columns; annotation fan-out per
    input row is bounded by the gene tables), which is cheaper to compute.

    With ``bins`` (:func:`varlake.operators.bins.genomic_bins`, of ``df`` or of a
    table with all its positions) rows are dealt to their bin and sorted there:
    ``df`` is worked out once, not once more for the boundaries.  A position
    with more rows than a bin is cut by the hash first, then ordered by the alleles.
    """
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in tie_break_columns or df.columns])
    if bins is not None:
        return sorted_in_bins(dealt_to_bins(df, bins, tie_break_columns), tie_break)
    return df.orderBy(*_order(df, row_hash if tie_break else None))


def _order(df: DataFrame, row_hash: Column | None) -> list[Column]:
    keys = [chromosome_rank("chromosome"), to_long("start")]
    if row_hash is not None:
        keys += [F.col(c) for c in ("reference", "alternate") if c in df.columns] + [row_hash]
    return keys


def with_bins(df: DataFrame, bins: GenomicBins, tie_break_columns: list[str] | None = None) -> DataFrame:
    """``df`` plus ``__hash`` and ``__bin``."""
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in tie_break_columns or df.columns])
    return bins.bin_of(df.withColumn("__hash", row_hash), F.col("__hash"), "__bin")


def dealt_to_bins(df: DataFrame, bins: GenomicBins, tie_break_columns: list[str] | None = None,
                  keep_bin: bool = False) -> DataFrame:
    """``df`` plus ``__hash``, each row in the partition of its bin.  Map-side joins
    may follow before :func:`sorted_in_bins`, so that what they add isn't shuffled; with
    ``keep_bin`` (``__bin`` stays) also joins with rows that are dealt to the same bins."""
    dealt = with_bins(df, bins, tie_break_columns).repartitionById(bins.count, "__bin")
    return dealt if keep_bin else dealt.drop("__bin")


def sorted_in_bins(dealt: DataFrame, tie_break: bool = True) -> DataFrame:
    """The order of :func:`chromosome_order` within each bin.  Its keys are columns: a sort
    works an expression out in every comparison of two rows."""
    keys = _order(dealt, F.col("__hash") if tie_break else None)
    names = [f"__by_{i}" for i in range(len(keys))]
    return dealt.withColumns(dict(zip(names, keys))).sortWithinPartitions(*names).drop("__hash", *names)


def has_rows(df: DataFrame) -> bool:
    """O3: whether ``df`` has any row; stops at the first."""
    return not df.isEmpty()
