"""Line dedup by overlapping three-line windows (DataFrame functions only).

Every run of three consecutive lines is hashed; of equal windows anywhere in
the table the first by (doc_id, text hash, position) stays, and the lines that
later ones cover are removed.

Defined cases: a text of one or two lines has one window, of all its lines,
which equals only windows of as many lines.  Null text: no lines, stays null.
Empty text: one empty line.  A null doc_id sorts first.  Rows equal in doc_id
and text are repeats of one document: none is later than the other, and all
get the same result.  Other columns are passed through and never compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import join_counted, row_key, written

WINDOW = 3


def _windows(docs: DataFrame, window: int) -> DataFrame:
    """A row per window: the document, the place of its first line, and two
    independent 64-bit hashes."""
    one = F.transform(F.col("__lines"), lambda x: F.xxhash64(x))
    two = F.transform(F.col("__lines"), lambda x: F.xxhash64(F.lit("second"), x))

    def key(hashes: str, at: Column) -> Column:
        return F.xxhash64(F.least(F.size("__lines"), F.lit(window)),
                          *[F.get(F.col(hashes), at + j) for j in range(window)])

    places = F.sequence(F.lit(0), F.greatest(F.size("__lines") - window, F.lit(0)))
    return (
        docs.where(F.col("text").isNotNull())
        .select(*row_key(), F.split("text", "\n", -1).alias("__lines"))
        .withColumns({"__one": one, "__two": two})
        .select("__id", "__th", F.inline(F.transform(places, lambda i: F.struct(
            i.alias("__pos"), key("__one", i).alias("__h1"), key("__two", i).alias("__h2")))))
    )


def covered_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document with repeats: ``__id``, ``__th`` and ``__later``, the
    places where its later windows begin (at most as many as its lines)."""
    windows = written(_windows(docs, window))
    place = F.struct("__id", "__th", "__pos")
    first = windows.groupBy("__h1", "__h2").agg(
        F.min(place).alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
    later = join_counted(windows, first, ["__h1", "__h2"], "__n", windows.count()).where(
        place > F.col("__first"))
    return later.groupBy("__id", "__th").agg(F.collect_set("__pos").alias("__later"))


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` plus ``__kept_text`` (what stays, '' if nothing), ``__n_lines``
    and ``__n_removed``.  ``docs`` needs ``doc_id`` and ``text``."""
    covered = covered_lines(docs, window).select(
        F.col("__id").alias("__cid"), F.col("__th").alias("__cth"), "__later")
    ided = docs.withColumns({c: k for c, k in zip(("__id", "__th"), row_key())})
    joined = ided.join(
        covered, F.col("__id").eqNullSafe(F.col("__cid")) & (F.col("__th") == F.col("__cth")),
        "left")
    n = F.size("__lines")
    gone = F.flatten(F.transform("__later", lambda p: F.sequence(
        p, F.least(p + window - 1, F.size("__lines") - 1))))
    stay = F.array_except(F.sequence(F.lit(0), n - 1), gone)
    return (
        joined.withColumn("__lines", F.split("text", "\n", -1))
        .withColumn("__stay", F.when(F.col("__later").isNotNull(), stay))
        .withColumns({
            "__kept_text": F.when(F.col("__later").isNull(), F.col("text")).otherwise(
                F.array_join(F.transform("__stay", lambda i: F.get("__lines", i)), "\n")),
            "__n_lines": F.when(F.col("text").isNull(), 0).otherwise(n),
            "__n_removed": F.when(F.col("__later").isNull(), 0).otherwise(n - F.size("__stay")),
        })
        .drop("__id", "__th", "__cid", "__cth", "__later", "__lines", "__stay")
    )
