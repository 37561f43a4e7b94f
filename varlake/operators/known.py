"""Known-variant sources: ClinVar and HGMD.

The reference restricts ClinVar/HGMD to the variants seen (an inner join)
and then left-joins the restricted table back; the restriction cannot change
a left join's result, so it is folded into the key annotation plan
(``annotate_by_key`` reduces every key table to the variants' keys).  The
pipelines don't run the "any match?" probe that decided whether to join at all:
the columns are always present (NULL when nothing matched), the plan stays one
job.  :func:`any_match` answers it for those who ask.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varlake.functions.keys import KEY
from varlake.operators.joins import project_annotation

# ClinVar significance terms that make a variant known.
PATHOGENIC_TERMS = ["Pathogenic", "Likely_pathogenic"]
# HGMD variant classes starting with this prefix are known.
HGMD_DISEASE_PREFIX = "DM"
# Default known-variant sources.
KNOWN_SOURCES = ("ClinVar", "HGMD")

CLINVAR_COLUMNS = {"VariationID": T.StringType(), "clin_sig": T.ArrayType(T.StringType())}
HGMD_COLUMNS = {"HGMDID": T.StringType(), "variant_class": T.StringType()}


def clinvar_pathogenic(clinvar: DataFrame) -> DataFrame:
    """ClinVar rows whose ``clin_sig`` holds a pathogenic term.
    Output: key, ``VariationID`` (the ClinVar ``name``), ``clin_sig``."""
    hit = F.arrays_overlap(F.col("clin_sig"), F.array(*[F.lit(t) for t in PATHOGENIC_TERMS]))
    return project_annotation(
        clinvar.where(F.coalesce(hit, F.lit(False))),
        {"name": "VariationID", "clin_sig": "clin_sig"},
    )


def hgmd_disease_mutations(hgmd_var: DataFrame) -> DataFrame:
    """HGMD rows whose class starts with ``DM`` (``DM`` and ``DM?``).
    Output: key, ``HGMDID``, ``variant_class``."""
    return project_annotation(
        hgmd_var.where(F.col("variant_class").startswith(HGMD_DISEASE_PREFIX)),
        {"id": "HGMDID", "variant_class": "variant_class"},
    )


def wanted_sources(sources: Iterable[str]) -> set[str]:
    """source names, case-insensitive (``Clinvar`` == ``ClinVar``)."""
    return {s.lower() for s in sources}


def any_match(variants: DataFrame, tables: Mapping[str, DataFrame],
              key: Sequence[str] = KEY) -> DataFrame:
    """``source, matched`` for each named key table: whether it holds a key of
    ``variants``.  One row per source whatever the sizes; a table is only counted,
    and with bounded variants filtered in its scan tasks by the distinct keys."""
    keys = variants.select(*key).distinct()
    probes = [
        table.select(*key).join(keys, list(key), "left_semi").groupBy()
        .agg((F.count(F.lit(1)) > 0).alias("matched"))
        .select(F.lit(name).alias("source"), "matched")
        for name, table in tables.items()
    ]
    out = probes[0]
    for p in probes[1:]:
        out = out.unionByName(p)
    return out


def add_null_columns(df: DataFrame, columns: dict[str, T.DataType]) -> DataFrame:
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def flag_known(
    df: DataFrame,
    sources: Iterable[str] = KNOWN_SOURCES,
    flag: str = "flag_keep",
) -> DataFrame:
    """a ClinVar or HGMD hit forces the flag to 1.

    ``df`` must already carry the annotation columns (``VariationID``,
    ``HGMDID``) from the key join; a disabled source leaves its columns NULL
    and does not touch the flag.
    """
    wanted = wanted_sources(sources)
    df = add_null_columns(df, {**CLINVAR_COLUMNS, **HGMD_COLUMNS})
    if "clinvar" in wanted:
        df = df.withColumn(flag, F.when(F.col("VariationID").isNotNull(), 1).otherwise(F.col(flag)))
    if "hgmd" in wanted:
        df = df.withColumn(flag, F.when(F.col("HGMDID").isNotNull(), 1).otherwise(F.col(flag)))
    return df


def known_tables(
    clinvar: DataFrame | None,
    hgmd_var: DataFrame | None,
    sources: Iterable[str] = KNOWN_SOURCES,
) -> list[DataFrame]:
    """The key tables to join for the enabled sources."""
    wanted = wanted_sources(sources)
    out = []
    if clinvar is not None and "clinvar" in wanted:
        out.append(clinvar_pathogenic(clinvar))
    if hgmd_var is not None and "hgmd" in wanted:
        out.append(hgmd_disease_mutations(hgmd_var))
    return out


__all__ = [
    "KEY",
    "clinvar_pathogenic",
    "hgmd_disease_mutations",
    "flag_known",
    "known_tables",
]
