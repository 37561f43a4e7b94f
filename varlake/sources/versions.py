"""Versioned annotation (S6): annotation stores under one path, numbered from 1,
with the keys that each version changed recorded beside it.

An older version stays readable, and a result annotated with it is brought up to
date from the recorded keys (:func:`varlake.plans.reannotate.reannotate`) without
comparing the tables again.  A version is listed after all its files are written,
so one that a lost driver left half done is never read.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varlake.functions.keys import KEY
from varlake.operators.differences import changed_keys
from varlake.sources.store import AnnotationStore, open_store, write_store


def versions(spark: SparkSession, path: str) -> dict[int, str]:
    """The versions under ``path`` and their folders, in order."""
    try:
        listed = spark.read.schema("version int, folder string").parquet(f"{path.rstrip('/')}/_versions")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["version"]: r["folder"] for r in listed.orderBy("version").collect()}


def write_version(tables: Mapping[str, DataFrame], path: str, buckets: int) -> int:
    """Write key tables as the next version; returns its number.

    The keys in which it differs from the version before (all keys of a table that
    only one of them has) are written as ``table`` + key."""
    spark, path = next(iter(tables.values())).sparkSession, path.rstrip("/")
    before = versions(spark, path)
    number = max(before, default=0) + 1
    folder = f"{path}/v{number:06d}"
    store = write_store(tables, folder, buckets)
    if before:
        old = open_store(spark, before[number - 1])
        changed_keys({n: old.table(n) for n in old.names}, {n: store.table(n) for n in store.names},
                     by_table=True).write.mode("overwrite").parquet(f"{folder}/_changes")
    spark.createDataFrame([(number, folder)], "version int, folder string").coalesce(1).write.mode(
        "append").parquet(f"{path}/_versions")
    return number


def open_version(spark: SparkSession, path: str, version: int | None = None) -> AnnotationStore:
    """A version's store, the latest one if none is named."""
    found = versions(spark, path)
    number = max(found, default=0) if version is None else version
    if number not in found:
        raise ValueError(f"no version {version or ''} under {path}; there are {sorted(found)}")
    return open_store(spark, found[number])


def changes_between(spark: SparkSession, path: str, old: int, new: int) -> DataFrame:
    """Distinct ``table`` + key that any version after ``old``, up to ``new``,
    changed; read from the recorded changes only.  A key changed and changed back
    is among them."""
    found = versions(spark, path)
    if not old < new or old not in found or new not in found:
        raise ValueError(f"versions {old} and {new} of {sorted(found)}")
    changes = [f"{found[v]}/_changes" for v in range(old + 1, new + 1)]
    return spark.read.parquet(*changes).select(F.col("table"), *KEY).distinct()
