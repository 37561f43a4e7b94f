"""Per-key and per-gene aggregates.

Every per-gene set is one ``collect_set`` aggregation, combined map-side: a
gene that owns a third of a table is reduced to one de-duplicated set per task
before the shuffle.  Sets are sorted for deterministic output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.functions.keys import KEY
from varlake.functions.values import (
    array_to_bracket_text,
    drop_empty_strings,
    hgnc_curie,
    rsid_number,
)
from varlake.functions.vcf import worked_out


def grouped_sets(
    df: DataFrame, group: str, values: dict[str, str], keep_group: str | None = None
) -> DataFrame:
    """``group`` plus, per ``{source: alias}``, the sorted set of non-null
    values of ``source`` (empty when all are NULL).

    One aggregation: ``collect_set`` is combined map-side, so each task ships
    one de-duplicated set per group and a hot group never reaches a single
    task as raw rows; the final merge only holds distinct values.
    """
    out = df.groupBy(group).agg(
        *[F.sort_array(F.collect_set(F.col(f"`{s}`"))).alias(a) for s, a in values.items()]
    )
    if keep_group:
        out = out.withColumnRenamed(group, keep_group)
    return out


def dbsnp_smallest(dbsnp: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Per variant key, the rsID(s) with the smallest number.

    Rows whose name has no ``rs<digits>`` number never win; a key with only
    such rows gets no row.  Ties on the number keep every distinct name.
    Output: key + ``DBSNP_RSID``.

    One pass over the table.  Names that are ``rs`` and their number are a row
    per key with the least number: longs, which a hash aggregate combines map-side
    without a sort.  Other names are a row each.  Then names per (key, number) of
    what is left, and the least number per key.  All steps are combined map-side, so a
    key that holds a third of the rows is one row per task, but for its odd names,
    which are spread by themselves first.
    """
    key = list(key)
    numbered = worked_out(dbsnp.select(*key, "name"), __num=rsid_number("name")).where(
        F.col("__num").isNotNull())
    plain = F.concat(F.lit("rs"), F.col("__num").cast("string"))
    least = numbered.groupBy(*key, F.when(F.col("name") != plain, F.col("name")).alias("__odd")).agg(
        F.min("__num").alias("__num"))
    names = least.withColumn("name", F.coalesce("__odd", plain)).groupBy(*key, "__num").agg(
        F.collect_set("name").alias("__names"))
    best = names.groupBy(*key).agg(F.min_by("__names", "__num").alias("__names"))
    return best.select(*key, F.explode("__names").alias("DBSNP_RSID"))


def gencc_by_gene(gencc: DataFrame, gene_column: str = "gene_curie",
                  out_key: str = "GenCC_hgnc_id") -> DataFrame:
    """Per gene, sets of disease id, title, classification and
    inheritance.  ``gene_column`` is ``gene_curie`` (HGNC, VEP/Dragon) or
    ``gene_symbol`` (ANNOVAR)."""
    return grouped_sets(
        gencc,
        gene_column,
        {
            "disease_curie": "GenCC_disease_curie_combined",
            "disease_title": "GenCC_disease_title_combined",
            "classification_title": "GenCC_classification_title_combined",
            "moi_title": "GenCC_moi_title_combined",
        },
        keep_group=out_key,
    )


def omim_by_gene(omim: DataFrame) -> DataFrame:
    """Per Entrez id, the set of OMIM gene ids and the phenotype set as
    ``[a, b]`` text (NULL when no phenotype)."""
    sets = grouped_sets(
        omim,
        "entrez_gene_id",
        {"omim_gene_id": "OMIM_gene_id", "phenotype": "__phen"},
        keep_group="OMIM_entrez_gene_id",
    )
    return sets.select(
        "OMIM_entrez_gene_id",
        "OMIM_gene_id",
        array_to_bracket_text("__phen").alias("OMIM_phenotype_combined"),
    )


def orphanet_by_gene(orphanet: DataFrame) -> DataFrame:
    """Per gene symbol (VEP/Dragon form).

    ``Orphanet_disorder_id_combined``: set of disorder ids;
    ``Orphanet_HGNC_gene_id`` / ``ensembl_gene_id``: comma-joined sets (a gene
    with several ids carries them all in one text, as the reference does);
    ``Orphanet_gene_source_of_validation_combined``: set without ``''``, NULL
    when empty; ``Orphanet_type_of_inheritance_combined``: the set of
    inheritance arrays, flattened, ``''`` removed, NULL when empty.
    """
    src = orphanet.select(
        F.col("gene_symbol").alias("Orphanet_gene_symbol"),
        F.col("disorder_id"),
        hgnc_curie("HGNC_gene_id").alias("__hgnc"),
        F.col("ensembl_gene_id"),
        F.col("gene_source_of_validation"),
        F.col("type_of_inheritance"),
    )
    sets = grouped_sets(
        src,
        "Orphanet_gene_symbol",
        {
            "disorder_id": "Orphanet_disorder_id_combined",
            "__hgnc": "__hgnc_set",
            "ensembl_gene_id": "__ens_set",
            "gene_source_of_validation": "__src_set",
            "type_of_inheritance": "__inh_set",
        },
    )
    return sets.select(
        "Orphanet_gene_symbol",
        "Orphanet_disorder_id_combined",
        F.array_join("__hgnc_set", ",").alias("Orphanet_HGNC_gene_id"),
        F.array_join("__ens_set", ",").alias("ensembl_gene_id"),
        drop_empty_strings("__src_set").alias("Orphanet_gene_source_of_validation_combined"),
        drop_empty_strings(F.flatten("__inh_set")).alias(
            "Orphanet_type_of_inheritance_combined"
        ),
    )


def orphanet_by_gene_text(orphanet: DataFrame) -> DataFrame:
    """Per gene symbol (ANNOVAR form): four sets as ``[a, b]`` text;
    an empty set is NULL except for the disorder ids."""
    sets = grouped_sets(
        orphanet,
        "gene_symbol",
        {
            "disorder_id": "__dis",
            "gene_source_of_validation": "__src",
            "HGNC_gene_id": "__hgnc",
            "type_of_inheritance": "__inh",
        },
        keep_group="Orphanet_gene_symbol",
    )
    return sets.select(
        "Orphanet_gene_symbol",
        array_to_bracket_text("__dis", null_if_empty=False).alias(
            "Orphanet_disorder_id_combined"
        ),
        array_to_bracket_text("__src").alias("Orphanet_gene_source_of_validation_combined"),
        array_to_bracket_text("__hgnc").alias("Orphanet_HGNC_gene_id"),
        array_to_bracket_text("__inh").alias("Orphanet_type_of_inheritance_combined"),
    )


def panel_ids(panel: DataFrame, column: str) -> DataFrame:
    """The distinct non-missing ids of one panel column."""
    return (
        panel.select(F.col(column).alias("id"))
        .where(F.col("id").isNotNull() & ~F.col("id").isin("", "-"))
        .distinct()
    )
