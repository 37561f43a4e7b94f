"""P1 ``filter_vep`` and P2 ``filter_vep(source='dragon')``.

One lazy DataFrame plan: consequence filter, distinct input rows, every
variant-key annotation in one ``annotate_by_key`` call, frequency and keep
flags, gene-level disease tables, chromosome order.  Input rows and annotation
rows are made distinct before they meet, so the wide result needs no
``distinct``.  No action runs except the counts that decide broadcasts; beyond
the broadcast bounds, per-key and per-gene counts are written to the shared
folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.config import DEFAULT_LIMITS, Limits, written
from varlake.functions.keys import KEY, with_variant_key
from varlake.functions.values import max_frequency
from varlake.operators.aggregates import (
    dbsnp_smallest,
    gencc_by_gene,
    omim_by_gene,
    orphanet_by_gene,
)
from varlake.operators.bins import genomic_bins
from varlake.operators.filters import (
    DAMAGE_RATIO_HIGH,
    DAMAGE_RATIO_LOW,
    VEP_CONSEQUENCES,
    VEP_MAF,
    flag_damaging,
    flag_rare,
    keep_consequences,
    with_damage_ratio,
)
from varlake.operators.genes import (
    attach_by_gene,
    attach_cosmic,
    attach_gencc,
    attach_hgmd_gene,
    attach_omim,
    attach_orphanet,
    hgmd_gene_reference,
)
from varlake.operators.joins import (
    ROWS,
    Derived,
    annotate_by_key,
    annotated_keys,
    broadcast_choice,
    key_counts,
    left_join_in_bins,
    measured,
    project_annotation,
)
from varlake.operators.known import KNOWN_SOURCES, flag_known, known_tables
from varlake.operators.ordering import chromosome_order, dealt_to_bins, sorted_in_bins, with_bins


@dataclass
class VepTables:
    """Annotation tables of the VEP and Dragon pipelines (raw, as stored).

    Optional tables may be None: their columns are then NULL (the reference
    switches ClinVar, dbSNP and the gene reference on and off).
    """

    topmed: DataFrame
    dbnsfp: DataFrame
    hgmd_gene: DataFrame
    cosmic: DataFrame
    omim_gene: DataFrame
    orphanet_gene: DataFrame
    gencc: DataFrame
    regeneron: DataFrame | None = None
    allofus: DataFrame | None = None
    dbsnp: DataFrame | None = None
    intervar: DataFrame | None = None
    clinvar: DataFrame | None = None
    hgmd_var: DataFrame | None = None
    genes: DataFrame | None = None
    gnomad41_genome: DataFrame | None = None
    gnomad41_exome: DataFrame | None = None
    hgmd_dm_q_column: str = "DM?"


# Frequency columns that make up ``max_gtar`` per source.
VEP_FREQUENCIES = [
    "CSQ_gnomAD_AF", "INFO_gnomad_3_1_1_AF", "TOPMed_af", "REGENERON_ALL_AF",
    "ALLOFUS_GVS_ALL_AF",
]
DRAGON_FREQUENCIES = [
    "TOPMed_af", "gnomad41_genome_AF", "gnomad41_exome_AF", "REGENERON_ALL_AF",
    "ALLOFUS_GVS_ALL_AF",
]


# Flattened-table columns the VEP and Dragon pipelines read.
VEP_INPUT_COLUMNS = {
    "vep": ["CSQ_Consequence", "CSQ_SYMBOL", "CSQ_Gene", "CSQ_HGNC_ID", "CSQ_gnomAD_AF",
            "INFO_gnomad_3_1_1_AF"],
    "dragon": ["CSQ_Consequence", "CSQ_SYMBOL", "CSQ_Gene"],
}


def _key_tables(t: VepTables, source: str, known: Sequence[str]) -> tuple[list[DataFrame], dict]:
    """Projected key tables in the reference's join order, and the typed NULL
    columns standing in for absent optional tables."""
    tables, absent = [], {}

    def add(df, cols, types):
        if df is None:
            absent.update(types)
        else:
            tables.append(project_annotation(df, cols))

    add(t.regeneron, ["REGENERON_ALL_AF"], {"REGENERON_ALL_AF": "double"})
    add(t.allofus, {"gvs_all_af": "ALLOFUS_GVS_ALL_AF"}, {"ALLOFUS_GVS_ALL_AF": "double"})
    if t.dbsnp is None:
        absent["DBSNP_RSID"] = "string"
    else:
        tables.append(Derived(project_annotation(t.dbsnp, ["name"]), dbsnp_smallest))
    add(t.intervar, ["InterVar_automated"], {"InterVar_automated": "string"})
    if source == "dragon":
        add(t.gnomad41_genome, ["gnomad41_genome_AF"], {"gnomad41_genome_AF": "double"})
        add(t.gnomad41_exome, ["gnomad41_exome_AF"], {"gnomad41_exome_AF": "double"})
    tables.append(project_annotation(t.topmed, {"af": "TOPMed_af"}))
    tables.append(with_damage_ratio(project_annotation(t.dbnsfp, ["DamagePredCount"])))
    tables.extend(known_tables(t.clinvar, t.hgmd_var, known))
    return tables, absent


# The columns that the gene-level lookups read.
GENE_COLUMNS = {"vep": ["CSQ_HGNC_ID", "CSQ_Gene"], "dragon": ["CSQ_Gene"]}
# The two-way join broadcasts Orphanet's rows once for each alternative.
BROADCAST_COPIES = {"orphanet": 2}


def gene_sources(tables: VepTables) -> dict[str, DataFrame]:
    """The raw gene tables whose sizes decide how they are joined."""
    found = {"omim": tables.omim_gene, "orphanet": tables.orphanet_gene, "gencc": tables.gencc,
             "cosmic": tables.cosmic, "hgmd": tables.hgmd_gene, "genes": tables.genes}
    return {name: table for name, table in found.items() if table is not None}


def attach_gene_tables(
    df: DataFrame,
    tables: VepTables,
    small: dict[str, bool],
    *,
    source: str = "vep",
    orphanet_multi_id: str = "whole",
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """The gene-level lookups (J13-J18, J21) by ``GENE_COLUMNS``; ``small`` says of
    each of :func:`gene_sources` whether it is broadcast."""
    gene_key = "hgnc" if source == "vep" else "ensembl"
    hgnc_col = "CSQ_HGNC_ID" if source == "vep" else "hgnc"
    hgmd_genes = hgmd_gene_reference(tables.hgmd_gene, tables.genes,
                                     dm_q_column=tables.hgmd_dm_q_column,
                                     small=small.get("genes"), limits=limits)
    # As many rows as HGMD genes have references: both sides are counted.
    df = attach_hgmd_gene(df, hgmd_genes.distinct(), gene_key=gene_key,
                          small=small["hgmd"] and small.get("genes", True), limits=limits)
    df = attach_cosmic(df, tables.cosmic.distinct(), small=small["cosmic"], limits=limits)
    df = attach_omim(df, omim_by_gene(tables.omim_gene), small=small["omim"], limits=limits)
    df = attach_orphanet(df, orphanet_by_gene(tables.orphanet_gene), hgnc_column=hgnc_col,
                         keep_hgnc_ids=(source == "vep"), multi_id=orphanet_multi_id,
                         small=small["orphanet"], limits=limits)
    return attach_gencc(df, gencc_by_gene(tables.gencc), on_column=hgnc_col, small=small["gencc"],
                        limits=limits)


def gene_dimension(genes: DataFrame, tables: VepTables, *, source: str = "vep",
                   orphanet_multi_id: str = "whole", limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """All gene tables' columns for the distinct ``GENE_COLUMNS`` of ``genes``: a row
    for each gene, several where a table has several for it (two HGMD symbols
    of one id), just as the lookups on the variants would give."""
    sources = gene_sources(tables)
    sizes = measured(sources, dict.fromkeys(sources, limits.max_broadcast_rows))
    small = broadcast_choice(sizes, limits, copies=BROADCAST_COPIES)
    return attach_gene_tables(genes.select(*GENE_COLUMNS[source]).distinct(), tables, small, source=source,
                              orphanet_multi_id=orphanet_multi_id, limits=limits).distinct()


def filter_vep(
    variants: DataFrame,
    tables: VepTables,
    *,
    source: str = "vep",
    maf: float = VEP_MAF,
    dpc_l: float = DAMAGE_RATIO_LOW,
    dpc_u: float = DAMAGE_RATIO_HIGH,
    known_variants: Sequence[str] = KNOWN_SOURCES,
    consequences: Sequence[str] = VEP_CONSEQUENCES,
    split_terms: bool = False,
    require_damaging: bool = False,
    optional_columns: Sequence[str] = (),
    orphanet_multi_id: str = "whole",
    strategy: str = "auto",
    variants_bounded: bool | None = None,
    sketch: bool = True,
    genes_once: bool = False,
    write_input: bool = True,
    sort: bool = True,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Annotate and flag the flattened VEP (or Dragon) variant table.

    ``variants`` is the flattened table (``#CHROM``/``POS``/... or already
    ``chromosome``/``start``/...).  A missing input column is an error unless
    ``optional_columns`` names it; it is NULL then, and a frequency that is
    NULL counts as rare.  ``variants_bounded`` says whether the variants are
    within ``limits`` and saves counting them; ``sketch=False`` suits tables of an
    annotation store, which aren't shuffled.  ``genes_once`` looks the gene tables
    up for the distinct gene ids (:func:`gene_dimension`) and joins them once, also
    where all are small; where one isn't this is always so.  The input is counted, reduced to its
    keys and joined, so it is worked out once and written to the shared folder
    (``write_input=False`` if it is a stored table).  Output columns: the input columns, the
    key annotations, ``max_gtar``, ``flag_keep``, ClinVar/HGMD columns, gene
    disease columns; distinct rows in chromosome order.
    """
    if source not in ("vep", "dragon"):
        raise ValueError("source must be 'vep' or 'dragon'")
    v = with_variant_key(variants)
    missing = [c for c in VEP_INPUT_COLUMNS[source] if c not in v.columns]
    if unknown := set(missing) - set(optional_columns):
        raise ValueError(f"variants lack {sorted(unknown)}; name columns that may be absent "
                         "in optional_columns")
    if missing:
        v = v.withColumns({c: F.lit(None).cast("string") for c in missing})
    input_cols = v.columns
    if write_input:
        v = written(v)
    kept = keep_consequences(v, consequences, split_terms=split_terms)

    key_tables, absent = _key_tables(tables, source, known_variants)
    # Every broadcast below is proven by a count; the counts of the gene
    # tables and of the variant keys run together in one job.  A per-gene
    # aggregate has at most as many rows as its source, so the raw tables are
    # counted (no aggregation or shuffle in the counting job), and measured in
    # bytes only if few enough.
    checks = gene_sources(tables)
    if strategy == "auto" and variants_bounded is None:
        checks["variants"] = kept.select(*KEY)
    most = dict.fromkeys(checks, limits.max_broadcast_rows)
    if "variants" in checks:
        most["variants"] = limits.max_variant_rows
    sizes = measured(checks, most)
    rows, size = sizes.pop("variants", (None, None))
    if rows is not None:
        variants_bounded = rows <= limits.max_variant_rows and size <= limits.max_variant_bytes
    small = broadcast_choice(sizes, limits, reserved=size or 0 if variants_bounded else 0,
                             copies=BROADCAST_COPIES)

    if strategy == "auto":
        strategy = "reduce" if variants_bounded else "keys"
    # The result keeps the positions of its input, which is cheap to count.
    counts = key_counts(kept) if strategy == "keys" else None
    bins = (genomic_bins(counts, rows_column=ROWS) if counts is not None
            else genomic_bins(kept) if sort else None)
    deal = {} if bins is None else {"deal": lambda df: dealt_to_bins(df, bins, input_cols)}
    if counts is not None and bins is not None:
        # Rows are dealt to their bin once, before anything is joined to them; keys and
        # genes with what they have of the tables come to the bins.  Equal rows are in one
        # bin; at a position with very many rows repeats are dropped before.
        v = dealt_to_bins(kept.distinct() if bins.cut else kept, bins, input_cols, keep_bin=True)
        annotated = annotated_keys(counts, key_tables, distinct_tables=True, sketch=sketch, limits=limits)
        v = left_join_in_bins(v if bins.cut else v.distinct(), bins.dealt_keys(annotated, "__bin"),
                              KEY, "__bin")
        deal = {"in_bins": (with_bins(kept, bins, input_cols), bins.count)}
    else:
        v = annotate_by_key(kept.distinct(), key_tables, key=KEY, strategy=strategy,
                            variants_bounded=variants_bounded, variant_rows=rows, distinct_tables=True,
                            sketch=sketch, counted=kept, counts=counts, limits=limits)
    if absent:
        v = v.withColumns({c: F.lit(None).cast(t) for c, t in absent.items()})

    freqs = VEP_FREQUENCIES if source == "vep" else DRAGON_FREQUENCIES
    v = v.withColumn("max_gtar", max_frequency(freqs))
    v = flag_rare(v, maf)
    v = flag_damaging(v, dpc_l, dpc_u, require_damaging=require_damaging)
    v = flag_known(v, known_variants)

    def attach(df: DataFrame, lim: Limits) -> DataFrame:
        return attach_gene_tables(df, tables, small, source=source,
                                  orphanet_multi_id=orphanet_multi_id, limits=lim)

    # Keys and genes are counted in the rows before repeats are dropped.
    v = attach_by_gene(v, kept, GENE_COLUMNS[source], attach,
                       all_small=not genes_once and all(small.values()), limits=limits, **deal)

    order = input_cols + [
        "REGENERON_ALL_AF", "ALLOFUS_GVS_ALL_AF", "DBSNP_RSID", "InterVar_automated",
    ]
    if source == "dragon":
        order += ["gnomad41_genome_AF", "gnomad41_exome_AF"]
    order += [
        "TOPMed_af", "max_gtar", "flag_keep", "DamagePredCount", "PredCountRatio_D2T",
        "VariationID", "clin_sig", "HGMDID", "variant_class", "entrez_gene_id", "hgnc",
        "HGMD_DM", "HGMD_DM?", "CGC_Tier", "CGC_Mutation_Types", "OMIM_gene_id",
        "OMIM_phenotype_combined", "Orphanet_disorder_id_combined",
        "Orphanet_gene_source_of_validation_combined",
    ]
    if source == "vep":
        order.append("Orphanet_HGNC_gene_id")
    order += [
        "Orphanet_type_of_inheritance_combined", "GenCC_disease_curie_combined",
        "GenCC_disease_title_combined", "GenCC_classification_title_combined",
        "GenCC_moi_title_combined",
    ]
    if sort and bins is not None:
        return sorted_in_bins(v.select([F.col(f"`{c}`") for c in [*order, "__hash"]]))
    out = v.select([F.col(f"`{c}`") for c in order])
    return chromosome_order(out, tie_break_columns=input_cols) if sort else out
