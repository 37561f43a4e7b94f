"""Annotation store: key tables laid out once for all later annotation runs.

Every table is bucketed and sorted by the variant key and partitioned by
contig.  Joins on the key then need no shuffle of the annotation side: the
variants' keys are dealt to the same buckets once, whatever the number of
tables, and per-key aggregates and ``distinct`` of a table stay within its
buckets.  Contigs that the variants don't touch are not read
(:meth:`AnnotationStore.tables_for`: dynamic partition pruning by the at most
``len(PRIMARY_CONTIGS) + 1`` contigs of the variants).

The tables are ordinary Parquet folders under one path, known to the session's
own catalog; :func:`open_store` declares them again in another session.  A
bucket holds the rows of its keys from all contigs, so choose ``buckets`` so that
a table's largest bucket fits a task; all tables of a store have the same.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varlake.config import written
from varlake.functions.keys import KEY, PRIMARY_CONTIGS, col_of

CONTIG = "contig"
OTHER = "other"


def contig_of(chromosome: str | Column = "chromosome") -> Column:
    """The partition of a chromosome: itself, or one for all others."""
    c = F.upper(col_of(chromosome))
    return F.when(c.isin(*PRIMARY_CONTIGS), c).otherwise(F.lit(OTHER))


@dataclass(frozen=True)
class AnnotationStore:
    """An open store: its path and the catalog name of each table."""

    spark: SparkSession
    path: str
    names: dict[str, str]

    def table(self, name: str) -> DataFrame:
        """A table as it was written (key and value columns)."""
        return self.spark.table(self.names[name]).drop(CONTIG)

    def tables_for(self, variants: DataFrame) -> dict[str, DataFrame]:
        """All tables, of which only the partitions of the contigs are read that
        ``variants`` (with the key columns) have."""
        # Written: one pass over the variants for all tables.  Spark plans the
        # pruning by a side that has a condition.
        found = written(variants.groupBy(contig_of().alias(CONTIG)).agg(
            F.count(F.lit(1)).alias("__n")))
        contigs = F.broadcast(found.where(F.col("__n") > 0).select(CONTIG))  # at most a row a contig
        return {
            name: self.spark.table(full).join(contigs, CONTIG, "left_semi").drop(CONTIG)
            for name, full in self.names.items()
        }


def write_store(tables: Mapping[str, DataFrame], path: str, buckets: int) -> AnnotationStore:
    """Write key tables (key columns + values) as a store under ``path``."""
    spark = next(iter(tables.values())).sparkSession
    path, names, rows = path.rstrip("/"), {}, []
    for name, table in tables.items():
        if CONTIG in table.columns:
            raise ValueError(f"{name} has a column {CONTIG!r}, which the store adds")
        full = _catalog_name(name)
        out = table.withColumns({"start": F.col("start").cast("bigint"), CONTIG: contig_of()})
        # One file for each contig and bucket: rows are dealt as buckets are.
        (out.repartition(buckets, *KEY).write.format("parquet").option("path", f"{path}/{name}")
         .partitionBy(CONTIG).bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(full))
        names[name] = full
        rows.append((name, out.drop(CONTIG).schema.toDDL(), buckets))
    spark.createDataFrame(rows, "name string, columns string, buckets int").coalesce(1).write.parquet(
        f"{path}/_tables")
    return AnnotationStore(spark, path, names)


def open_store(spark: SparkSession, path: str) -> AnnotationStore:
    """Declare the tables of a written store in this session's catalog."""
    path, names = path.rstrip("/"), {}
    key = ", ".join(f"`{k}`" for k in KEY)
    for r in spark.read.parquet(f"{path}/_tables").collect():
        full = _catalog_name(r["name"])
        place = f"{path}/{r['name']}".replace("'", "\\'")
        spark.sql(f"CREATE TABLE {full} ({r['columns']}, {CONTIG} STRING) USING parquet "
                  f"PARTITIONED BY ({CONTIG}) CLUSTERED BY ({key}) SORTED BY ({key}) "
                  f"INTO {r['buckets']} BUCKETS LOCATION '{place}'")
        spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
        names[r["name"]] = full
    return AnnotationStore(spark, path, names)


def _catalog_name(name: str) -> str:
    plain = re.sub(r"\W", "_", name).lower()
    return f"varlake_store_{plain}_{uuid.uuid4().hex[:12]}"
