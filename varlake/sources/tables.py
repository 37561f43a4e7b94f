"""Readers for variant TSVs, annotation tables and gene lists (S4-S8) and
writers for results (K1-K7).

Writers never collect to the driver: a sorted DataFrame is written by its
range partitions as ordered part files (``part-00000`` first); one file only
on request (``single_file=True``), which funnels the rows through one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varlake.functions.keys import MISSING, missing_to_null
from varlake.functions.values import stringify_nested
from varlake.sources.vcf import FIXED_FIELDS

# Columns of a flattened variant TSV that keep a literal ``-``
# (a deletion/insertion allele), i.e. are never read as missing.
TSV_KEEP_DASH = ("#CHROM", "POS", "REF", "ALT", "chromosome", "start", "reference", "alternate")


def read_variant_tsv(spark: SparkSession, path: str | list[str],
                     keep_dash: Sequence[str] = TSV_KEEP_DASH) -> DataFrame:
    """Flattened variant table (tab separated, header, gzip or plain),
    every column text; ``-`` reads as NULL except in the key columns."""
    df = (
        spark.read.option("sep", "\t").option("header", True)
        .option("inferSchema", False).csv(path)
    )
    keep = set(keep_dash)
    return df.select([
        F.col(f"`{c}`") if c in keep else missing_to_null(F.col(f"`{c}`")).alias(c)
        for c in df.columns
    ])


def read_annotation(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | Mapping[str, str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """An annotation table (Parquet by default; ``fmt='delta'`` needs
    the Delta Lake package on the session), pruned to ``columns`` (a list, or
    a ``{source: target}`` rename map) so the scan reads only those."""
    df = spark.read.format(fmt).load(path)
    if columns is None:
        return df
    if isinstance(columns, Mapping):
        return df.select([F.col(f"`{s}`").alias(t) for s, t in columns.items()])
    return df.select([F.col(f"`{c}`") for c in columns])


def read_gene_panel(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Gene panel list (tab separated with header: ``symbol``,
    ``hgnc_id``, ``entrez_id``), all text."""
    return spark.read.option("sep", "\t").option("header", True).option("inferSchema", False).csv(path)


def read_goi_list(spark: SparkSession, path: str) -> DataFrame:
    """Genes-of-interest list by position (no header): symbol, NCBI id
    (``-`` = none), Ensembl id (``-`` = none), then free text.

    Output: ``Germline_GOIs_names, entrez, ensembl, gene_desc`` (the rest of
    the line) and ``line_no`` (a struct ordering lines as in the file, taken
    right after the scan so it is the same on any recomputation)."""
    # File order = (file, start offset of the split, position within the
    # split): splits are packed into partitions by size, so the partition id
    # alone need not follow the file.
    order = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), order.alias("line_no")
    ).where(F.length("line") > 0)
    f = F.split("line", "\t", 4)
    return lines.select(
        F.get(f, 0).alias("Germline_GOIs_names"),
        F.get(f, 1).alias("entrez"),
        F.get(f, 2).alias("ensembl"),
        F.get(f, 3).alias("gene_desc"),
        "line_no",
    )


def write_result(
    df: DataFrame,
    path: str,
    *,
    compression: str | None = "gzip",
    null_value: str = MISSING,
    single_file: bool = False,
    mode: str = "overwrite",
) -> None:
    """K1/K3/K4/K6/K7: tab-separated text with a header; NULL, also a NULL
    array, written as ``-`` (``null_value``); arrays as comma text and structs as
    JSON first (K2), so an empty array is empty text.  Row order is the
    DataFrame's (write a sorted frame for ordered part files)."""
    out = stringify_nested(df, null_arrays=True)
    if single_file:
        out = out.coalesce(1)
    w = (
        out.write.mode(mode).option("sep", "\t").option("header", True)
        .option("nullValue", null_value).option("emptyValue", "")
    )
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def write_vcf_body(records: DataFrame, path: str, compression: str | None = None,
                   mode: str = "overwrite") -> None:
    """K5: records (fixed fields + ``samples``) back to tab-joined VCF lines."""
    fields = [F.col(f"`{c}`") for c in FIXED_FIELDS]
    line = F.concat_ws("\t", *fields, F.col("samples")).alias("value")
    w = records.select(line).write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)
