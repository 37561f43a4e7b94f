"""P3 ``filter_annovar``: the ANNOVAR-annotated variant pipeline.

Differences from the VEP pipeline: the exonic/splicing predicate instead of
the consequence list, the ANNOVAR frequency columns (``max_gnomad_topmed``),
gene tables joined by gene symbol, text-form Orphanet sets, splice scores,
no ``distinct`` (fan-out from the gene tables is kept), and nested columns
turned into text for a delimited file.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.config import DEFAULT_LIMITS, Limits, written
from varlake.functions.keys import KEY, with_variant_key
from varlake.functions.values import max_frequency, stringify_nested
from varlake.operators.aggregates import gencc_by_gene, omim_by_gene, orphanet_by_gene_text
from varlake.operators.bins import genomic_bins
from varlake.operators.filters import (
    ANNOVAR_EXONIC_FUNCTIONS,
    ANNOVAR_MAF,
    DAMAGE_RATIO_HIGH,
    DAMAGE_RATIO_LOW,
    drop_dotted,
    flag_damaging,
    flag_rare,
    keep_exonic_or_splicing,
    rename_columns,
    with_damage_ratio,
)
from varlake.operators.genes import (
    attach_by_gene,
    attach_gencc,
    attach_hgmd_gene_by_symbol,
    attach_omim,
    attach_orphanet_by_symbol,
)
from varlake.operators.joins import annotate_by_key, broadcast_choice, measured, project_annotation
from varlake.operators.known import KNOWN_SOURCES, flag_known, known_tables
from varlake.operators.ordering import chromosome_order

# ANNOVAR column names in the flattened table and their
# working names.
ANNOVAR_RENAMES = {
    "INFO_Func.refGene": "Func_refGene",
    "INFO_ExonicFunc.refGene": "ExonicFunc_refGene",
    "INFO_Gene.refGene": "Gene_refGene",
}
# ANNOVAR frequency inputs of ``max_gnomad_topmed``.
ANNOVAR_FREQUENCIES = ["INFO_gnomad211_exome_AF", "INFO_gnomad211_genome_AF", "TOPMed_af"]
SPLICEAI_COLUMNS = ["SpliceAI_DS_AG", "SpliceAI_DS_AL", "SpliceAI_DS_DG", "SpliceAI_DS_DL"]
MMSPLICE_COLUMNS = ["mmsplice_delta_logit_psi", "mmsplice_pathogenicity", "mmsplice_efficiency"]


@dataclass
class AnnovarTables:
    topmed: DataFrame
    dbnsfp: DataFrame
    hgmd_gene: DataFrame
    omim_gene: DataFrame
    orphanet_gene: DataFrame
    gencc: DataFrame
    spliceai: DataFrame
    mmsplice: DataFrame
    clinvar: DataFrame | None = None
    hgmd_var: DataFrame | None = None
    hgmd_dm_q_column: str = "DM?"


def filter_annovar(
    variants: DataFrame,
    tables: AnnovarTables,
    *,
    maf: float = ANNOVAR_MAF,
    dpc_l: float = DAMAGE_RATIO_LOW,
    dpc_u: float = DAMAGE_RATIO_HIGH,
    known_variants: Sequence[str] = KNOWN_SOURCES,
    exonic_functions: Sequence[str] = ANNOVAR_EXONIC_FUNCTIONS,
    require_damaging: bool = False,
    strategy: str = "auto",
    variants_bounded: bool | None = None,
    write_input: bool = True,
    sort: bool = True,
    as_text: bool = True,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Annotate and flag the flattened ANNOVAR variant table.

    With ``as_text`` (K2) array columns become comma-joined text and struct
    columns JSON, ready for a delimited file.
    """
    v = rename_columns(with_variant_key(variants), ANNOVAR_RENAMES)
    if write_input:
        v = written(v)
    v = keep_exonic_or_splicing(v, exonic_functions)
    v = base = drop_dotted(v)
    input_cols = v.columns

    key_tables = [
        project_annotation(tables.topmed, {"af": "TOPMed_af"}),
        with_damage_ratio(project_annotation(tables.dbnsfp, ["DamagePredCount"])),
        *known_tables(tables.clinvar, tables.hgmd_var, known_variants),
        project_annotation(tables.spliceai, SPLICEAI_COLUMNS),
        project_annotation(tables.mmsplice, MMSPLICE_COLUMNS),
    ]
    omim_genes = omim_by_gene(tables.omim_gene)
    orphanet_text = orphanet_by_gene_text(tables.orphanet_gene)
    gencc_genes = gencc_by_gene(tables.gencc, gene_column="gene_symbol", out_key="GenCC_gene_symbol")
    # Counts of every gene-level lookup in one job.
    # Aggregates have at most as many rows as their sources: count the sources.
    checks = {"hgmd": tables.hgmd_gene, "omim": tables.omim_gene,
              "orphanet": tables.orphanet_gene, "gencc": tables.gencc}
    if strategy == "auto" and variants_bounded is None:
        checks["variants"] = v.select(*KEY)
    sizes = measured(checks)
    rows, size = sizes.pop("variants", (None, None))
    if rows is not None:
        variants_bounded = rows <= limits.max_variant_rows and size <= limits.max_variant_bytes
    small = broadcast_choice(sizes, limits, reserved=size or 0 if variants_bounded else 0)
    v = annotate_by_key(v, key_tables, key=KEY, strategy=strategy,
                        variants_bounded=variants_bounded, variant_rows=rows, limits=limits)
    v = v.withColumn("max_gnomad_topmed", max_frequency(ANNOVAR_FREQUENCIES))
    v = flag_rare(v, maf, freq="max_gnomad_topmed")
    v = flag_damaging(v, dpc_l, dpc_u, require_damaging=require_damaging)
    v = flag_known(v, known_variants)

    def attach(df: DataFrame, lim: Limits) -> DataFrame:
        df = attach_hgmd_gene_by_symbol(df, tables.hgmd_gene, dm_q_column=tables.hgmd_dm_q_column,
                                        small=small["hgmd"], limits=lim)
        df = attach_omim(df, omim_genes, small=small["omim"], limits=lim)
        df = attach_orphanet_by_symbol(df, orphanet_text, small=small["orphanet"], limits=lim)
        return attach_gencc(df, gencc_genes, on_column="Gene_refGene",
                            gene_key="GenCC_gene_symbol", small=small["gencc"], limits=lim)

    v = attach_by_gene(v, base, ["Gene_refGene"], attach, all_small=all(small.values()),
                       keep_repeats=True, limits=limits)

    order = input_cols + [
        "TOPMed_af", "max_gnomad_topmed", "flag_keep", "DamagePredCount", "PredCountRatio_D2T",
        "VariationID", "clin_sig", "HGMDID", "variant_class", "entrez_gene_id", "HGMD_DM",
        "HGMD_DM?", "OMIM_gene_id", "OMIM_phenotype_combined", "Orphanet_disorder_id_combined",
        "Orphanet_gene_source_of_validation_combined", "Orphanet_HGNC_gene_id",
        "Orphanet_type_of_inheritance_combined", "GenCC_disease_curie_combined",
        "GenCC_disease_title_combined", "GenCC_classification_title_combined",
        "GenCC_moi_title_combined", *SPLICEAI_COLUMNS, *MMSPLICE_COLUMNS,
    ]
    out = v.select([F.col(f"`{c}`") for c in order])
    if sort:
        out = chromosome_order(out, tie_break_columns=input_cols, bins=genomic_bins(base))
    return stringify_nested(out) if as_text else out
