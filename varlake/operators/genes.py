"""Gene-level disease annotation.

Gene tables hold one row per gene after aggregation (tens of thousands of
rows), so ``left_join_lookup`` broadcasts them once a bounded count proves it;
a variant table with one very frequent gene then needs no shuffle at all.
Beyond the bound the same call salts hot genes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.config import DEFAULT_LIMITS, Limits, written
from varlake.functions.values import null_if_empty_array
from varlake.operators.joins import (
    NEVER_HOT,
    ROWS,
    left_join_any,
    left_join_in_bins,
    left_join_lookup,
    row_count_at_most,
)

# Name of the HGMD "possible disease mutation" column.
HGMD_DM_Q = "DM?"


def hgmd_gene_reference(
    hgmd_gene: DataFrame,
    genes: DataFrame | None,
    dm_q_column: str = HGMD_DM_Q,
    small: bool | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """J13 + X16: HGMD genes with their HGNC and Ensembl ids.

    Output: ``entrez_gene_id, hgnc, ensembl_gene_id, HGMD_symbol, HGMD_DM,
    HGMD_DM?``; empty disease lists (``[]`` or ``['']``) are NULL.  Without a
    gene reference table ``hgnc`` and ``ensembl_gene_id`` are NULL.
    """
    h = hgmd_gene.select(
        "entrez_gene_id",
        F.col("symbol").alias("HGMD_symbol"),
        null_if_empty_array("DM").alias("HGMD_DM"),
        null_if_empty_array(F.col(f"`{dm_q_column}`")).alias("HGMD_DM?"),
    )
    if genes is None:
        g = h.withColumns({"hgnc": F.lit(None).cast("string"),
                           "ensembl_gene_id": F.lit(None).cast("string")})
    else:
        g = left_join_lookup(
            h, genes.select("entrez_gene_id", "hgnc", "ensembl_gene_id"),
            ["entrez_gene_id"], right_is_small=small, limits=limits,
        )
    return g.select("entrez_gene_id", "hgnc", "ensembl_gene_id", "HGMD_symbol",
                    "HGMD_DM", "HGMD_DM?")


def attach_by_gene(
    df: DataFrame,
    genes_of: DataFrame,
    columns: Sequence[str],
    attach: Callable[[DataFrame, Limits], DataFrame],
    *,
    all_small: bool,
    keep_repeats: bool = False,
    deal: Callable[[DataFrame], DataFrame] = lambda df: df,
    in_bins: tuple[DataFrame, int] | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Apply ``attach``, a chain of gene-level lookups that read only
    ``columns`` and what earlier lookups add.

    If all gene tables are small the chain is broadcast joins on ``df``.  If
    not, it runs on the distinct values of ``columns`` in ``genes_of`` (the
    frame ``df`` was made from, or one with those values in as many rows or more), a row per gene whatever the number of its
    variants, and the result is joined back once: broadcast if it is counted
    small, else with hot genes split by the counts taken on the way.  ``df`` is in the plan once.  ``keep_repeats``
    keeps rows that lookups repeat, as the chain on ``df`` would.  ``deal`` is the exchange that the
    result goes through at last; where the lookups are broadcast it comes before
    them, so their columns are not shuffled.

    With ``in_bins`` ``df`` has been dealt by its column ``__bin`` already: a frame with
    ``__bin`` and ``columns`` of its rows, and the number of bins.  If the gene dimension isn't small,
    a bin gets a copy of the genes that it has, and ``df`` isn't shuffled again: a bin has
    fewer genes than rows, near each other on a genome very few.
    """
    if all_small:
        return attach(deal(df), limits)
    columns = list(columns)
    counts = written(genes_of.groupBy(*columns).agg(F.count(F.lit(1)).alias(ROWS)))
    genes = attach(counts.select(*columns), replace(limits, hot_key_rows=NEVER_HOT))
    genes = written(genes if keep_repeats else genes.distinct())  # the gene dimension
    if row_count_at_most(genes, limits.max_broadcast_rows, limits.max_broadcast_bytes):
        return left_join_lookup(deal(df), genes, columns, null_safe=True, right_is_small=True, limits=limits)
    if in_bins is not None:
        return left_join_in_bins(df, genes_in_bins(genes, columns, *in_bins, limits=limits), columns,
                                 "__bin", null_safe=True)
    return deal(left_join_lookup(df, genes, columns, null_safe=True, right_is_small=False,
                                 left_counts=counts, limits=limits))


def genes_in_bins(genes: DataFrame, columns: Sequence[str], places: DataFrame, count: int,
                  limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """``genes`` (rows by ``columns``) in the partitions of all bins that have rows of them;
    ``places`` has ``__bin`` and ``columns`` of all rows of ``count`` bins."""
    pairs = places.select("__bin", *columns).distinct()  # a gene has a row a bin at most
    found = left_join_lookup(pairs, genes, columns, null_safe=True, right_is_small=False,
                             limits=replace(limits, hot_key_rows=NEVER_HOT))
    return found.repartitionById(count, "__bin")


def attach_hgmd_gene(
    df: DataFrame,
    hgmd_genes: DataFrame,
    gene_key: str = "hgnc",
    small: bool | None = None, limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Variant -> HGMD gene.

    ``gene_key='hgnc'``: ``CSQ_HGNC_ID = hgnc`` (VEP); ``'ensembl'``:
    ``CSQ_Gene = ensembl_gene_id`` (Dragon).  Adds ``entrez_gene_id``,
    ``hgnc`` (always carried, the gene-group step needs it), ``HGMD_DM``,
    ``HGMD_DM?``.
    """
    if gene_key == "hgnc":
        right = hgmd_genes.select(F.col("hgnc").alias("__k"), "entrez_gene_id", "hgnc",
                                  "HGMD_DM", "HGMD_DM?")
        left_col = "CSQ_HGNC_ID"
    elif gene_key == "ensembl":
        right = hgmd_genes.select(F.col("ensembl_gene_id").alias("__k"), "entrez_gene_id",
                                  "hgnc", "HGMD_DM", "HGMD_DM?")
        left_col = "CSQ_Gene"
    else:
        raise ValueError(f"gene_key must be 'hgnc' or 'ensembl', not {gene_key!r}")
    return left_join_lookup(df, right, {left_col: "__k"}, right_is_small=small, limits=limits)


def attach_hgmd_gene_by_symbol(
    df: DataFrame,
    hgmd_gene: DataFrame,
    symbol_column: str = "Gene_refGene",
    dm_q_column: str = HGMD_DM_Q,
    small: bool | None = None, limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """J17 (HGMD part, ANNOVAR): ``Gene_refGene = HGMD symbol``; adds
    ``entrez_gene_id, HGMD_DM, HGMD_DM?`` as stored (no empty-list nulling)."""
    right = hgmd_gene.select(
        F.col("symbol").alias("__k"),
        "entrez_gene_id",
        F.col("DM").alias("HGMD_DM"),
        F.col(f"`{dm_q_column}`").alias("HGMD_DM?"),
    )
    return left_join_lookup(df, right, {symbol_column: "__k"}, right_is_small=small, limits=limits)


def attach_cosmic(df: DataFrame, cosmic: DataFrame, small: bool | None = None, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Cancer Gene Census by Entrez id; adds ``CGC_Tier``,
    ``CGC_Mutation_Types``."""
    right = cosmic.select(
        F.col("Entrez_GeneId").alias("__k"),
        F.col("Tier").alias("CGC_Tier"),
        F.col("Mutation_Types").alias("CGC_Mutation_Types"),
    )
    return left_join_lookup(df, right, {"entrez_gene_id": "__k"}, right_is_small=small, limits=limits)


def attach_omim(df: DataFrame, omim_genes: DataFrame, small: bool | None = None, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """OMIM per-gene sets (from ``omim_by_gene``) by Entrez id; adds
    ``OMIM_gene_id``, ``OMIM_phenotype_combined``."""
    right = omim_genes.select(F.col("OMIM_entrez_gene_id").alias("__k"), "OMIM_gene_id",
                              "OMIM_phenotype_combined")
    return left_join_lookup(df, right, {"entrez_gene_id": "__k"}, right_is_small=small, limits=limits)


def attach_orphanet(
    df: DataFrame,
    orphanet_genes: DataFrame,
    hgnc_column: str = "CSQ_HGNC_ID",
    ensembl_column: str = "CSQ_Gene",
    keep_hgnc_ids: bool = True,
    multi_id: str = "whole",
    small: bool | None = None, limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Orphanet per-gene sets (from ``orphanet_by_gene``) where the HGNC
    id OR the Ensembl id is equal (R3: union of equi-joins, no nested loop).

    Adds ``Orphanet_disorder_id_combined``,
    ``Orphanet_gene_source_of_validation_combined``, ``Orphanet_HGNC_gene_id``
    (unless ``keep_hgnc_ids=False``, as in Dragon) and
    ``Orphanet_type_of_inheritance_combined``.  A gene of several ids has them
    comma-joined: ``multi_id='whole'`` compares the whole text, as the
    reference does, ``'any'`` matches by any of them.
    """
    if multi_id not in ("whole", "any"):
        raise ValueError("multi_id must be 'whole' or 'any'")
    right = orphanet_genes.select(
        F.col("Orphanet_gene_symbol").alias("__sym"),
        F.col("Orphanet_HGNC_gene_id").alias("__hgnc"),
        F.col("ensembl_gene_id").alias("__ens"),
        "Orphanet_disorder_id_combined",
        "Orphanet_gene_source_of_validation_combined",
        "Orphanet_HGNC_gene_id",
        "Orphanet_type_of_inheritance_combined",
    )
    out = left_join_any(
        df, right, [(hgnc_column, "__hgnc"), (ensembl_column, "__ens")], "__sym",
        right_is_small=small, split_keys=multi_id == "any", limits=limits,
    )
    drop = ["__sym", "__hgnc", "__ens"]
    if not keep_hgnc_ids:
        drop.append("Orphanet_HGNC_gene_id")
    return out.drop(*drop)


def attach_orphanet_by_symbol(
    df: DataFrame,
    orphanet_text: DataFrame,
    symbol_column: str = "Gene_refGene",
    small: bool | None = None, limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """J17 (Orphanet part, ANNOVAR): text sets (``orphanet_by_gene_text``) by
    gene symbol."""
    right = orphanet_text.withColumnRenamed("Orphanet_gene_symbol", "__k")
    return left_join_lookup(df, right, {symbol_column: "__k"}, right_is_small=small, limits=limits)


def attach_gencc(
    df: DataFrame,
    gencc_genes: DataFrame,
    on_column: str = "CSQ_HGNC_ID",
    gene_key: str = "GenCC_hgnc_id",
    small: bool | None = None, limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """J21 / J17 (GenCC part): per-gene sets (``gencc_by_gene``) by HGNC id
    (``CSQ_HGNC_ID`` for VEP, ``hgnc`` for Dragon) or by symbol (ANNOVAR)."""
    right = gencc_genes.withColumnRenamed(gene_key, "__k")
    return left_join_lookup(df, right, {on_column: "__k"}, right_is_small=small, limits=limits)
