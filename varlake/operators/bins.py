"""Genomic bins: the order of chromosome and position without a range sort.

A range sort works its input out twice, once to sample boundaries and once to
deal the rows.  Here boundaries come from a histogram of the positions alone:
rows per window of 2^14 bases (``WINDOW_BITS``), counted map-side, from a table
that is cheap to read (a pipeline's input, whose positions its result keeps).  Bins are
runs of windows with about ``rows_per_bin`` rows.  A window with more rows is
counted again by position, and a position with more is cut by a hash of the row,
so no bin grows with the data.  Rows find their bin by broadcast joins with the
histogram, whose size is checked.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varlake.config import written
from varlake.functions.keys import chromosome_rank, to_long

WINDOW_BITS = 14
MAX_SLOTS = 1_000_000  # windows and positions of a histogram that is broadcast
LEAST_ROWS, MOST_ROWS = 10_000, 1_000_000  # of a bin, unless the caller says
_RANK, _START, _CELL = "__rank", "__start", "__cell"


def _places(df: DataFrame) -> list[Column]:
    start = to_long("start")
    return [chromosome_rank("chromosome").alias(_RANK), start.alias(_START),
            F.shiftright(start, WINDOW_BITS).alias(_CELL)]


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & left[c].eqNullSafe(right[f"{c}_of"])
    return cond


@dataclass(frozen=True)
class GenomicBins:
    """``count`` bins in the order of chromosome and position.

    ``slots``: per window, or position of a window with many rows (``by_position``),
    its first bin and in how many pieces it is cut.  ``cut``: whether there is a position
    with more rows than a bin."""

    count: int
    slots: DataFrame
    crowded: bool
    cut: bool = False

    def bin_of(self, df: DataFrame, row_hash: Column, name: str) -> DataFrame:
        """``df`` plus the bin of each row.  A position that the histogram
        doesn't know is an error."""
        out = self._slotted(df.withColumn("__piece", F.shiftrightunsigned(row_hash, 33)))
        piece = F.shiftright(F.col("__piece") * F.col("pieces"), 31)
        known = F.coalesce("first", F.raise_error(F.lit(
            "a position is in no genomic bin: bins are those of another table")).cast("long"))
        return out.withColumn(name, (known + piece).cast("int")).drop("__piece", "first", "pieces")

    def dealt_keys(self, keys: DataFrame, name: str) -> DataFrame:
        """``keys``, rows with a position, each in the partitions of all bins that have rows
        of its position, plus the bin; those of positions that the histogram doesn't know go.
        They meet rows dealt by :meth:`bin_of` (:func:`varlake.operators.joins.left_join_in_bins`)."""
        out = self._slotted(keys).where(F.col("first").isNotNull())
        bins = F.sequence(F.col("first").cast("int"), (F.col("first") + F.col("pieces") - 1).cast("int"))
        return out.select(*[F.col(f"`{c}`") for c in keys.columns], F.explode(bins).alias(
            name)).repartitionById(self.count, name)

    def _slotted(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``first`` and ``pieces`` of each row's slot, NULL if there is none."""
        places = df.select("*", *_places(df))
        whole = F.broadcast(self.slots.where(~F.col("by_position")).select(
            F.col(_RANK).alias(f"{_RANK}_of"), F.col(_CELL).alias(f"{_CELL}_of"), "first", "pieces"))
        out = places.join(whole, _same(places, whole, [_RANK, _CELL]), "left").drop(
            f"{_RANK}_of", f"{_CELL}_of")
        if self.crowded:
            exact = F.broadcast(self.slots.where("by_position").select(
                F.col(_RANK).alias(f"{_RANK}_of"), F.col(_START).alias(f"{_START}_of"),
                F.col("first").alias("__first"), F.col("pieces").alias("__pieces")))
            out = out.join(exact, _same(out, exact, [_RANK, _START]), "left").drop(
                f"{_RANK}_of", f"{_START}_of")
            out = out.withColumns({"first": F.coalesce("__first", "first"),
                                   "pieces": F.coalesce("__pieces", "pieces")}).drop(
                "__first", "__pieces")
        return out.drop(_RANK, _START, _CELL)


def genomic_bins(df: DataFrame, rows_per_bin: int | None = None, max_slots: int = MAX_SLOTS,
                 rows_column: str | None = None) -> GenomicBins | None:
    """Bins by the positions of ``df`` (``chromosome``, ``start``), or None if the
    histogram would be larger than ``max_slots``.

    ``df`` is read once, twice if a window is crowded, and should be a stored
    table.  Missing chromosomes and starts come first, as in a sort.  A row of ``df`` stands
    for as many rows as its ``rows_column`` says.
    """
    spark = df.sparkSession
    n = (F.sum(f"`{rows_column}`") if rows_column else F.count(F.lit(1))).alias("n")
    places = df.select(*_places(df), *([F.col(f"`{rows_column}`")] if rows_column else []))
    cells = written(places.groupBy(_RANK, _CELL).agg(n))
    rows, found, most = cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    if found > max_slots:
        return None
    share = 1 + rows // int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = rows_per_bin or min(MOST_ROWS, max(LEAST_ROWS, share))
    slots = cells.select(_RANK, _CELL, F.lit(None).cast("long").alias(_START),
                         F.lit(False).alias("by_position"), "n")
    crowded, cut = most > size, False
    if crowded:
        heavy = F.broadcast(cells.where(F.col("n") > size).select(  # fewer than rows / size
            F.col(_RANK).alias(f"{_RANK}_of"), F.col(_CELL).alias(f"{_CELL}_of")))
        exact = written(
            places.join(heavy, _same(places, heavy, [_RANK, _CELL]), "left_semi")
            .groupBy(_RANK, _CELL, _START).agg(n))
        found, most = exact.agg(F.count(F.lit(1)), F.max("n")).first()
        if found > max_slots:
            return None
        cut = most > size
        slots = slots.where(F.col("n") <= size).unionByName(
            exact.select(_RANK, _CELL, _START, F.lit(True).alias("by_position"), "n"))
    # At most twice max_slots rows: one window over all of them.
    before = F.sum("n").over(Window.orderBy(_RANK, _CELL, _START).rowsBetween(
        Window.unboundedPreceding, -1))
    placed = slots.select(
        _RANK, _CELL, _START, "by_position",
        F.floor(F.coalesce(before, F.lit(0)) / F.lit(size)).cast("long").alias("first"),
        F.when(F.col("n") > size, F.ceil(F.col("n") / F.lit(size))).otherwise(1).cast("long").alias("pieces"))
    # In order and without gaps: a slot's pieces end before the next one's first.  Two at least:
    # what is dealt to one partition is dealt by keys again for a join, and then not in order.
    return GenomicBins(max(2, int(rows // size) + 1), placed, crowded, cut)
