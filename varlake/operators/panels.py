"""Gene-panel labels and gene-of-interest lists.

Panels and gene lists hold hundreds to thousands of genes.  Each membership
test is a left join of the variant table to a distinct id list that a
bounded count proves small (then broadcast: no variant shuffle, so a gene
with a third of all variants costs nothing extra); the reference's driver
``collect()`` of the id sets into ``isin`` literals is not needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.config import DEFAULT_LIMITS, Limits
from varlake.functions.keys import missing_to_null, to_double
from varlake.operators.aggregates import panel_ids
from varlake.operators.joins import left_join_lookup, rows_at_most

# Gene-group labels.
BOTH_LABEL = "ECPG/EMGP"
FIRST_LABEL = "ECPG"
SECOND_LABEL = "EMGP"
NO_LABEL = "-"

# Gene-of-interest retention thresholds.
GOI_MAF = 0.0001
GOI_MIN_RATIO = 0.5


def panel_membership(first: DataFrame, second: DataFrame, column: str) -> DataFrame:
    """G7 for both panels at once: ``id, in_first, in_second`` for every
    distinct non-missing id of ``column``."""
    a = panel_ids(first, column).select("id", F.lit(True).alias("in_first"),
                                        F.lit(False).alias("in_second"))
    b = panel_ids(second, column).select("id", F.lit(False).alias("in_first"),
                                         F.lit(True).alias("in_second"))
    return a.unionByName(b).groupBy("id").agg(F.max("in_first").alias("in_first"),
                                             F.max("in_second").alias("in_second"))


def _member(df: DataFrame, value: Column, membership: DataFrame, tag: str,
            limits: Limits, small: bool | None = None) -> DataFrame:
    """Adds booleans ``__a_<tag>`` / ``__b_<tag>``; NULL values are never
    members."""
    m = membership.select("id", F.col("in_first").alias(f"__a_{tag}"),
                          F.col("in_second").alias(f"__b_{tag}"))
    tmp = f"__v_{tag}"
    out = left_join_lookup(df.withColumn(tmp, value), m, {tmp: "id"}, right_is_small=small,
                           limits=limits)
    return out.withColumns({
        f"__a_{tag}": F.coalesce(F.col(f"__a_{tag}"), F.lit(False)),
        f"__b_{tag}": F.coalesce(F.col(f"__b_{tag}"), F.lit(False)),
    }).drop(tmp)


def gene_group_label(first: str | Column, second: str | Column) -> Column:
    """Label from two booleans."""
    first = F.col(first) if isinstance(first, str) else first
    second = F.col(second) if isinstance(second, str) else second
    return (
        F.when(first & second, F.lit(BOTH_LABEL))
        .when(first, F.lit(FIRST_LABEL))
        .when(second, F.lit(SECOND_LABEL))
        .otherwise(F.lit(NO_LABEL))
    )


def annotate_gene_group(
    variants: DataFrame,
    first_panel: DataFrame,
    second_panel: DataFrame,
    *,
    entrez_column: str = "entrez_gene_id",
    hgnc_column: str = "hgnc",
    symbol_column: str = "CSQ_SYMBOL",
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Add ``gene_group`` from two panels (columns ``symbol``,
    ``hgnc_id``, ``entrez_id``).

    A variant is in a panel if its Entrez id or HGNC id is listed; only when
    it is in neither panel by id, the gene symbol decides.  Missing ids
    (NULL or ``-``) never match.
    """
    entrez = missing_to_null(F.col(entrez_column).cast("string"))
    hgnc = missing_to_null(F.col(hgnc_column).cast("string"))
    symbol = missing_to_null(F.col(symbol_column).cast("string"))
    probes = (("entrez", entrez, "entrez_id"), ("hgnc", hgnc, "hgnc_id"), ("symbol", symbol, "symbol"))
    tables = {tag: panel_membership(first_panel, second_panel, column) for tag, _, column in probes}
    # A membership table has at most as many rows as the two panels together:
    # bounding each raw panel by half the limit proves all three (one job).
    half = limits.max_broadcast_rows // 2
    bounded = all(rows_at_most(
        {"a": first_panel, "b": second_panel}, half,
        max_bytes=limits.max_broadcast_bytes // 2).values())
    small = {tag: bounded for tag in tables}
    df = variants
    for tag, value, _ in probes:
        df = _member(df, value, tables[tag], tag, limits, small[tag])
    a_id = F.col("__a_entrez") | F.col("__a_hgnc")
    b_id = F.col("__b_entrez") | F.col("__b_hgnc")
    neither = ~a_id & ~b_id
    a_final = a_id | (neither & F.col("__a_symbol"))
    b_final = b_id | (neither & F.col("__b_symbol"))
    helpers = [f"__{t}_{k}" for t in "ab" for k in ("entrez", "hgnc", "symbol")]
    return df.withColumn("gene_group", gene_group_label(a_final, b_final)).drop(*helpers)


def goi_retained(
    flag: str = "flag_keep",
    freq: str = "max_gtar",
    ratio: str = "PredCountRatio_D2T",
    maf: float = GOI_MAF,
    min_ratio: float = GOI_MIN_RATIO,
) -> Column:
    """flag 1, frequency missing or strictly below ``maf``, damage ratio
    missing or at least ``min_ratio``."""
    f, r = to_double(F.col(freq)), to_double(F.col(ratio))
    return (
        (to_double(F.col(flag)) == 1)
        & (f.isNull() | (f < F.lit(maf)))
        & (r.isNull() | (r >= F.lit(min_ratio)))
    )


# Columns appended from the gene-of-interest list.
GOI_COLUMNS = ["Germline_GOIs_names", "entrez", "ensembl", "gene_desc"]


def gene_list_lookup(gene_list: DataFrame, id_column: str) -> DataFrame:
    """One row per id of ``id_column`` (NULL and ``-`` ids dropped); a
    repeated id keeps its last line (highest ``line_no``)."""
    entry = F.struct(*[F.col(c) for c in GOI_COLUMNS])
    return (
        gene_list.select(missing_to_null(F.col(id_column)).alias("id"), "line_no",
                         entry.alias("entry"))
        .where(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.max_by("entry", "line_no").alias("entry"))
    )


def attach_gene_list(
    variants: DataFrame,
    gene_list: DataFrame,
    *,
    maf: float = GOI_MAF,
    min_ratio: float = GOI_MIN_RATIO,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Keep retained variants of listed genes and append the list
    columns.

    ``gene_list`` has ``Germline_GOIs_names`` (symbol), ``entrez``,
    ``ensembl``, ``gene_desc`` and ``line_no`` (file order).  The Entrez id
    is tried first, then the Ensembl gene id, then the symbol; a variant
    matching none is dropped.
    """
    kept = variants.where(goi_retained(maf=maf, min_ratio=min_ratio))
    base_cols = kept.columns
    probes = [
        ("entrez", F.col("entrez_gene_id").cast("string")),
        ("ensembl", F.col("CSQ_Gene")),
        ("Germline_GOIs_names", F.col("CSQ_SYMBOL")),
    ]
    luts = {i: gene_list_lookup(gene_list, column).withColumnRenamed("entry", f"__e{i}")
            for i, (column, _) in enumerate(probes)}
    # Each lookup has at most as many rows as the list itself.
    bounded = rows_at_most({"list": gene_list}, limits.max_broadcast_rows,
                           max_bytes=limits.max_broadcast_bytes)["list"]
    small = {str(i): bounded for i in luts}
    df = kept
    for i, (_, value) in enumerate(probes):
        df = df.withColumn(f"__p{i}", missing_to_null(value))
        df = left_join_lookup(df, luts[i], {f"__p{i}": "id"}, right_is_small=small[str(i)],
                              limits=limits).drop(f"__p{i}")
    chosen = F.coalesce(*[F.col(f"__e{i}") for i in range(len(probes))])
    out = df.withColumn("__entry", chosen).where(F.col("__entry").isNotNull())
    return out.select(*[F.col(f"`{c}`") for c in base_cols],
                      *[F.col("__entry").getField(c).alias(c) for c in GOI_COLUMNS])
