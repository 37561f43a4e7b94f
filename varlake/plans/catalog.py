"""Registered queries: one per operator group of the survey's inventory.

Each entry is ``(spark_query, oracle_sql_or_None)``.  ``spark_query(spark,
sf_dir)`` builds the DataFrame from tables derived (by Spark) from the
driver's parquet files, so its work grows with the scale factor; the oracle
states the same result in DuckDB SQL.  Array outputs are turned into
comma-joined text of their sorted elements so both sides compare as scalars.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varlake.config import Limits, ensure_checkpoint_dir
from varlake.functions.keys import KEY, chromosome_rank, with_variant_key
from varlake.functions.values import damage_ratio, max_frequency, stringify_nested
from varlake.operators.aggregates import (
    dbsnp_smallest,
    gencc_by_gene,
    omim_by_gene,
    orphanet_by_gene,
    orphanet_by_gene_text,
)
from varlake.operators.filters import (
    drop_dotted,
    keep_consequences,
    keep_exonic_or_splicing,
    flag_rare,
    rename_columns,
    with_damage_ratio,
)
from varlake.operators.genes import (
    attach_cosmic,
    attach_gencc,
    attach_hgmd_gene,
    attach_hgmd_gene_by_symbol,
    attach_omim,
    attach_orphanet,
    attach_orphanet_by_symbol,
    hgmd_gene_reference,
)
from varlake.operators.panels import annotate_gene_group, attach_gene_list
from varlake.operators.joins import annotate_by_key, project_annotation
from varlake.operators.known import (
    any_match,
    clinvar_pathogenic,
    flag_known,
    hgmd_disease_mutations,
    known_tables,
)
from varlake.operators.bins import genomic_bins
from varlake.operators.ordering import chromosome_order
from varlake.plans import oracle as O
from varlake.plans.annovar import ANNOVAR_FREQUENCIES, AnnovarTables, filter_annovar
from varlake.plans.vep import VepTables, filter_vep
from varlake.functions.vcf import (
    adjusted_genotype,
    format_value,
    info_value,
    picked_transcript,
    subfield,
    variant_id,
)
from varlake.plans.vcf_table import (
    flatten_records,
    tag_genes,
    vcf_qc_records,
    vcf_to_table,
    vcf_transcripts,
)
from varlake.sources.fixtures import (
    ANN_HEADER,
    MIXED_FORMAT,
    ODD_HEADER,
    VCF_HEADER,
    VEP_HEADER,
    cohort_files,
    cohort_line,
    cohort_rows,
    fixture,
)
from varlake.sources.tables import (
    read_annotation,
    read_gene_panel,
    read_goi_list,
    read_variant_tsv,
    write_result,
    write_vcf_body,
)
from varlake.sources.vcf import (
    PACKED_TEXT,
    read_vcf,
    split_header,
    vcf_records,
    vcf_schema,
    write_text,
)

# Limits under which no lookup is broadcast and keys are hot early.
SHUFFLED = Limits(max_broadcast_rows=0, max_variant_rows=0, hot_key_rows=1000)

# The fixtures are projections of stored tables: cheaper to read again than to write.
stored_filter_vep = partial(filter_vep, write_input=False)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = (fn, oracle)
        return fn

    return deco


def arrays_as_text(df: DataFrame, sep: str = ",") -> DataFrame:
    """Array columns -> ``sep``-joined text (NULL stays NULL)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), sep)
        cols.append(c.alias(f.name))
    return df.select(cols)


def vep_tables(spark: SparkSession, sf: str, dragon: bool = False) -> VepTables:
    fx = lambda n: fixture(spark, sf, n)
    return VepTables(
        topmed=fx("fx_topmed"), dbnsfp=fx("fx_dbnsfp"),
        hgmd_gene=fx("fx_hgmd_gene"), hgmd_dm_q_column="dm_q",
        cosmic=fx("fx_cosmic"), omim_gene=fx("fx_omim"), orphanet_gene=fx("fx_orphanet"),
        gencc=fx("fx_gencc"), regeneron=fx("fx_regeneron"), allofus=fx("fx_allofus"),
        dbsnp=fx("fx_dbsnp"), intervar=fx("fx_intervar"), clinvar=fx("fx_clinvar"),
        hgmd_var=fx("fx_hgmd_var"), genes=fx("fx_genes"),
        gnomad41_genome=fx("fx_gnomad41_genome") if dragon else None,
        gnomad41_exome=fx("fx_gnomad41_exome") if dragon else None,
    )


# ---------------------------------------------------------------- filters
@register("keep_consequences", O.with_(["fx_variants"], [],
          f"SELECT * FROM fx_variants WHERE CSQ_Consequence IN {O.VEP_TERMS}"))
def q_keep_consequences(spark, sf):
    """F10."""
    return keep_consequences(fixture(spark, sf, "fx_variants"))


@register("annovar_predicate", O.with_(["fx_annovar"], [],
          f"SELECT * FROM fx_annovar WHERE {O.ANNOVAR_PRED}"))
def q_annovar_predicate(spark, sf):
    """F12."""
    return keep_exonic_or_splicing(fixture(spark, sf, "fx_annovar"))


@register("chromosome_sort", O.with_(["fx_variants"], [], """
SELECT chromosome, start, reference, alternate, variant_id,
 CASE WHEN upper(chromosome) IN ('X', 'Y') THEN '2' || upper(chromosome)
  WHEN regexp_matches(chromosome, '^[0-9]$') THEN '0' || chromosome
  WHEN chromosome IN ('10','11','12','13','14','15','16','17','18','19','20','21','22') THEN chromosome
  ELSE '~' || chromosome END AS chrom_key
FROM fx_variants"""))
def q_chromosome_sort(spark, sf):
    """Rows in chromosome order, with the text sort key."""
    v = fixture(spark, sf, "fx_variants").select(*KEY, "variant_id")
    return chromosome_order(v).withColumn("chrom_key", chromosome_rank("chromosome"))


# ------------------------------------------------------- key annotations
@register("dbsnp_smallest", O.with_(["fx_dbsnp"], [O.CTE_DBSNP], "SELECT * FROM dbsnp_best"))
def q_dbsnp_smallest(spark, sf):
    """G1/J10."""
    return dbsnp_smallest(fixture(spark, sf, "fx_dbsnp"))


_POP_FIX = ["fx_variants", "fx_regeneron", "fx_allofus", "fx_dbsnp", "fx_intervar", "fx_topmed"]
_POP_BODY = f"""
, v0 AS (SELECT * FROM fx_variants WHERE CSQ_Consequence IN {O.VEP_TERMS})
, a AS (SELECT v0.*, r.REGENERON_ALL_AF, al.gvs_all_af AS ALLOFUS_GVS_ALL_AF, d.DBSNP_RSID,
  iv.InterVar_automated, t.af AS TOPMed_af
 FROM v0 LEFT JOIN fx_regeneron r ON {O.keq('v0', 'r')}
 LEFT JOIN fx_allofus al ON {O.keq('v0', 'al')}
 LEFT JOIN dbsnp_best d ON {O.keq('v0', 'd')}
 LEFT JOIN fx_intervar iv ON {O.keq('v0', 'iv')}
 LEFT JOIN fx_topmed t ON {O.keq('v0', 't')})"""


def _population(spark, sf) -> DataFrame:
    fx = lambda n: fixture(spark, sf, n)
    v = keep_consequences(fx("fx_variants"))
    tables = [
        project_annotation(fx("fx_regeneron"), ["REGENERON_ALL_AF"]),
        project_annotation(fx("fx_allofus"), {"gvs_all_af": "ALLOFUS_GVS_ALL_AF"}),
        dbsnp_smallest(fx("fx_dbsnp")),
        project_annotation(fx("fx_intervar"), ["InterVar_automated"]),
        project_annotation(fx("fx_topmed"), {"af": "TOPMed_af"}),
    ]
    return annotate_by_key(v, tables)


@register("annotate_population_freqs", O.with_(_POP_FIX, [O.CTE_DBSNP], _POP_BODY + "\nSELECT * FROM a"))
def q_annotate_population_freqs(spark, sf):
    """J1-J5 (Regeneron, All of Us, dbSNP, InterVar, TOPMed) on the variant key."""
    return _population(spark, sf)


_VEP_MAX = ("greatest(0.0::DOUBLE, TRY_CAST(CSQ_gnomAD_AF AS DOUBLE), "
            "TRY_CAST(INFO_gnomad_3_1_1_AF AS DOUBLE), TOPMed_af, REGENERON_ALL_AF, ALLOFUS_GVS_ALL_AF)")


@register("max_frequency_vep", O.with_(_POP_FIX, [O.CTE_DBSNP],
          _POP_BODY + f"\nSELECT chromosome, start, reference, alternate, variant_id, {_VEP_MAX} AS max_gtar FROM a"))
def q_max_frequency_vep(spark, sf):
    """X13, VEP inputs."""
    from varlake.plans.vep import VEP_FREQUENCIES
    return _population(spark, sf).select(*KEY, "variant_id",
                                         max_frequency(VEP_FREQUENCIES).alias("max_gtar"))


_DRG_FIX = ["fx_variants", "fx_regeneron", "fx_allofus", "fx_topmed", "fx_gnomad41_genome",
            "fx_gnomad41_exome"]


@register("max_frequency_dragon", O.with_(_DRG_FIX, [], f"""
, v0 AS (SELECT * FROM fx_variants WHERE CSQ_Consequence IN {O.VEP_TERMS})
SELECT v0.chromosome, v0.start, v0.reference, v0.alternate, v0.variant_id,
 g.gnomad41_genome_AF, e.gnomad41_exome_AF,
 greatest(0.0::DOUBLE, t.af, g.gnomad41_genome_AF, e.gnomad41_exome_AF, r.REGENERON_ALL_AF, al.gvs_all_af) AS max_gtar
FROM v0 LEFT JOIN fx_regeneron r ON {O.keq('v0', 'r')}
 LEFT JOIN fx_allofus al ON {O.keq('v0', 'al')}
 LEFT JOIN fx_gnomad41_genome g ON {O.keq('v0', 'g')}
 LEFT JOIN fx_gnomad41_exome e ON {O.keq('v0', 'e')}
 LEFT JOIN fx_topmed t ON {O.keq('v0', 't')}"""))
def q_max_frequency_dragon(spark, sf):
    """J6, J7 and X13 with the Dragon inputs."""
    from varlake.plans.vep import DRAGON_FREQUENCIES
    fx = lambda n: fixture(spark, sf, n)
    v = keep_consequences(fx("fx_variants"))
    tables = [
        project_annotation(fx("fx_regeneron"), ["REGENERON_ALL_AF"]),
        project_annotation(fx("fx_allofus"), {"gvs_all_af": "ALLOFUS_GVS_ALL_AF"}),
        project_annotation(fx("fx_gnomad41_genome"), ["gnomad41_genome_AF"]),
        project_annotation(fx("fx_gnomad41_exome"), ["gnomad41_exome_AF"]),
        project_annotation(fx("fx_topmed"), {"af": "TOPMed_af"}),
    ]
    a = annotate_by_key(v, tables)
    return a.select(*KEY, "variant_id", "gnomad41_genome_AF", "gnomad41_exome_AF",
                    max_frequency(DRAGON_FREQUENCIES).alias("max_gtar"))


@register("max_frequency_annovar", O.with_(["fx_annovar", "fx_topmed"], [], f"""
, v0 AS (SELECT * FROM fx_annovar WHERE {O.ANNOVAR_PRED})
SELECT v0.*, t.af AS TOPMed_af,
 greatest(0.0::DOUBLE, TRY_CAST(INFO_gnomad211_exome_AF AS DOUBLE), TRY_CAST(INFO_gnomad211_genome_AF AS DOUBLE), t.af) AS max_gnomad_topmed
FROM v0 LEFT JOIN fx_topmed t ON {O.keq('v0', 't')}"""))
def q_max_frequency_annovar(spark, sf):
    """F12, J5 and X13 with the ANNOVAR inputs."""
    v = keep_exonic_or_splicing(fixture(spark, sf, "fx_annovar"))
    a = annotate_by_key(v, [project_annotation(fixture(spark, sf, "fx_topmed"), {"af": "TOPMed_af"})])
    return a.withColumn("max_gnomad_topmed", max_frequency(ANNOVAR_FREQUENCIES))


_SLICE_MAX = ["CSQ_gnomAD_AF", "INFO_gnomad_3_1_1_AF", "TOPMed_af"]


@register("flag_rare", O.with_(["fx_variants", "fx_topmed"], [], f"""
, v0 AS (SELECT * FROM fx_variants WHERE CSQ_Consequence IN {O.VEP_TERMS})
, a AS (SELECT v0.*, t.af AS TOPMed_af,
  greatest(0.0::DOUBLE, TRY_CAST(CSQ_gnomAD_AF AS DOUBLE), TRY_CAST(INFO_gnomad_3_1_1_AF AS DOUBLE), t.af) AS max_gtar
 FROM v0 LEFT JOIN fx_topmed t ON {O.keq('v0', 't')})
SELECT *, 1 AS flag_keep FROM a WHERE max_gtar <= 0.001::DOUBLE"""))
def q_flag_rare(spark, sf):
    """Minimum slice: F10 -> J5 -> X13 -> F11 -> keep flagged -> O1."""
    v = keep_consequences(fixture(spark, sf, "fx_variants"))
    a = annotate_by_key(v, [project_annotation(fixture(spark, sf, "fx_topmed"), {"af": "TOPMed_af"})])
    a = flag_rare(a.withColumn("max_gtar", max_frequency(_SLICE_MAX)), 0.001)
    return chromosome_order(a.where(F.col("flag_keep") == 1))


@register("damage_ratio", O.with_(["fx_variants", "fx_dbnsfp"], [O.CTE_DBN], f"""
, v0 AS (SELECT * FROM fx_variants WHERE CSQ_Consequence IN {O.VEP_TERMS})
SELECT v0.chromosome, v0.start, v0.reference, v0.alternate, v0.variant_id, n.DamagePredCount, n.PredCountRatio_D2T
FROM v0 LEFT JOIN dbn n ON {O.keq('v0', 'n')}"""))
def q_damage_ratio(spark, sf):
    """J8 + X14: dbNSFP damage counts and ratio on the variant key."""
    v = keep_consequences(fixture(spark, sf, "fx_variants")).select(*KEY, "variant_id")
    dbn = with_damage_ratio(project_annotation(fixture(spark, sf, "fx_dbnsfp"), ["DamagePredCount"]))
    return annotate_by_key(v, [dbn])


@register("intervar_join", O.with_(["fx_variants", "fx_intervar"], [], f"""
, v0 AS (SELECT * FROM fx_variants WHERE CSQ_Consequence IN {O.VEP_TERMS})
SELECT v0.*, iv.InterVar_automated FROM v0 LEFT JOIN fx_intervar iv ON {O.keq('v0', 'iv')}"""))
def q_intervar_join(spark, sf):
    """J4."""
    v = keep_consequences(fixture(spark, sf, "fx_variants"))
    return annotate_by_key(v, [project_annotation(fixture(spark, sf, "fx_intervar"), ["InterVar_automated"])])


_SPLICE = ["SpliceAI_DS_AG", "SpliceAI_DS_AL", "SpliceAI_DS_DG", "SpliceAI_DS_DL"]
_MMS = ["mmsplice_delta_logit_psi", "mmsplice_pathogenicity", "mmsplice_efficiency"]


@register("splice_scores", O.with_(["fx_annovar", "fx_spliceai", "fx_mmsplice"], [], f"""
, v0 AS (SELECT * FROM fx_annovar WHERE {O.ANNOVAR_PRED})
SELECT v0.*, {', '.join('s.' + c for c in _SPLICE)}, {', '.join('m.' + c for c in _MMS)}
FROM v0 LEFT JOIN fx_spliceai s ON {O.keq('v0', 's')} LEFT JOIN fx_mmsplice m ON {O.keq('v0', 'm')}"""))
def q_splice_scores(spark, sf):
    """SpliceAI and MMSplice scores on the variant key."""
    v = keep_exonic_or_splicing(fixture(spark, sf, "fx_annovar"))
    return annotate_by_key(v, [
        project_annotation(fixture(spark, sf, "fx_spliceai"), _SPLICE),
        project_annotation(fixture(spark, sf, "fx_mmsplice"), _MMS),
    ])


# ------------------------------------------------------------ known variants
@register("clinvar_pathogenic", O.with_(["fx_clinvar"], [O.CTE_CLV],
          "SELECT * REPLACE (array_to_string(clin_sig, ',') AS clin_sig) FROM clv"))
def q_clinvar_pathogenic(spark, sf):
    """F13."""
    return arrays_as_text(clinvar_pathogenic(fixture(spark, sf, "fx_clinvar")))


@register("hgmd_dm", O.with_(["fx_hgmd_var"], [O.CTE_HGV], "SELECT * FROM hgv"))
def q_hgmd_dm(spark, sf):
    """F14."""
    return hgmd_disease_mutations(fixture(spark, sf, "fx_hgmd_var"))


@register("any_known_match", O.with_(["fx_variants", "fx_clinvar", "fx_hgmd_var", "fx_topmed"],
          [O.CTE_CLV, O.CTE_HGV], f"""
, v0 AS (SELECT * FROM fx_variants WHERE CSQ_Consequence IN {O.VEP_TERMS})
SELECT 'ClinVar' AS source, EXISTS (SELECT 1 FROM v0 JOIN clv c ON {O.keq('v0', 'c')}) AS matched
UNION ALL SELECT 'HGMD', EXISTS (SELECT 1 FROM v0 JOIN hgv h ON {O.keq('v0', 'h')})
UNION ALL SELECT 'beyond', EXISTS (SELECT 1 FROM v0 JOIN fx_topmed t ON {O.keq('v0', 't')} AND t.start > 100000000000)"""))
def q_any_known_match(spark, sf):
    """Whether any variant is in ClinVar, in HGMD, or among rows that
    match none."""
    v = keep_consequences(fixture(spark, sf, "fx_variants"))
    return any_match(v, {
        "ClinVar": clinvar_pathogenic(fixture(spark, sf, "fx_clinvar")),
        "HGMD": hgmd_disease_mutations(fixture(spark, sf, "fx_hgmd_var")),
        "beyond": fixture(spark, sf, "fx_topmed").where("start > 100000000000")})


@register("flag_known", O.with_(["fx_variants", "fx_topmed", "fx_clinvar", "fx_hgmd_var"],
          [O.CTE_CLV, O.CTE_HGV], f"""
, v0 AS (SELECT * FROM fx_variants WHERE CSQ_Consequence IN {O.VEP_TERMS})
, a AS (SELECT v0.chromosome, v0.start, v0.reference, v0.alternate, v0.variant_id,
  greatest(0.0::DOUBLE, TRY_CAST(CSQ_gnomAD_AF AS DOUBLE), TRY_CAST(INFO_gnomad_3_1_1_AF AS DOUBLE), t.af) AS max_gtar,
  c.VariationID, array_to_string(c.clin_sig, ',') AS clin_sig, h.HGMDID, h.variant_class
 FROM v0 LEFT JOIN fx_topmed t ON {O.keq('v0', 't')}
 LEFT JOIN clv c ON {O.keq('v0', 'c')} LEFT JOIN hgv h ON {O.keq('v0', 'h')})
SELECT *, CASE WHEN VariationID IS NOT NULL OR HGMDID IS NOT NULL OR max_gtar <= 0.001::DOUBLE THEN 1 ELSE 0 END AS flag_keep FROM a"""))
def q_flag_known(spark, sf):
    """F11 + J11/J12 + F17: a ClinVar or HGMD hit forces the flag."""
    fx = lambda n: fixture(spark, sf, n)
    v = keep_consequences(fx("fx_variants")).select(*KEY, "variant_id", *_SLICE_MAX[:2])
    tables = [project_annotation(fx("fx_topmed"), {"af": "TOPMed_af"})]
    tables += known_tables(fx("fx_clinvar"), fx("fx_hgmd_var"))
    a = annotate_by_key(v, tables)
    a = flag_rare(a.withColumn("max_gtar", max_frequency(_SLICE_MAX)), 0.001)
    a = flag_known(a)
    return arrays_as_text(a.select(*KEY, "variant_id", "max_gtar", "VariationID", "clin_sig",
                                   "HGMDID", "variant_class", "flag_keep"))


# ---------------------------------------------------------------- gene tables
@register("gencc_by_gene", O.with_(["fx_gencc"], [O.cte_gencc()],
          "SELECT GenCC_hgnc_id, " + ", ".join(f"array_to_string({c}, ',') AS {c}" for c in O.GENCC_COLS)
          + " FROM genc"))
def q_gencc_by_gene(spark, sf):
    """G2."""
    return arrays_as_text(gencc_by_gene(fixture(spark, sf, "fx_gencc")))


@register("omim_by_gene", O.with_(["fx_omim"], [O.CTE_OMIM],
          "SELECT * REPLACE (array_to_string(OMIM_gene_id, ',') AS OMIM_gene_id) FROM omim_g"))
def q_omim_by_gene(spark, sf):
    """G3."""
    return arrays_as_text(omim_by_gene(fixture(spark, sf, "fx_omim")))


@register("orphanet_by_gene", O.with_(["fx_orphanet"], [O.CTE_ORPH], """
SELECT * REPLACE (array_to_string(Orphanet_disorder_id_combined, ',') AS Orphanet_disorder_id_combined,
 array_to_string(Orphanet_gene_source_of_validation_combined, ',') AS Orphanet_gene_source_of_validation_combined,
 array_to_string(Orphanet_type_of_inheritance_combined, ',') AS Orphanet_type_of_inheritance_combined)
FROM orph"""))
def q_orphanet_by_gene(spark, sf):
    """G4 + X17/X18/X19."""
    return arrays_as_text(orphanet_by_gene(fixture(spark, sf, "fx_orphanet")))


@register("orphanet_by_gene_text", O.with_(["fx_orphanet"], [O.CTE_ORPH_TEXT], "SELECT * FROM orph_t"))
def q_orphanet_by_gene_text(spark, sf):
    """G5 + X20."""
    return orphanet_by_gene_text(fixture(spark, sf, "fx_orphanet"))


_HG_TEXT = """array_to_string(HGMD_DM, ',') AS HGMD_DM, array_to_string("HGMD_DM?", ',') AS "HGMD_DM?\""""


@register("hgmd_gene_reference", O.with_(["fx_hgmd_gene", "fx_genes"], [O.CTE_HG],
          f"SELECT * REPLACE ({_HG_TEXT}) FROM hg"))
def q_hgmd_gene_reference(spark, sf):
    """J13 + X16."""
    return arrays_as_text(hgmd_gene_reference(fixture(spark, sf, "fx_hgmd_gene"),
                                              fixture(spark, sf, "fx_genes"), dm_q_column="dm_q"))


def _gene_slice(spark, sf) -> DataFrame:
    cols = [*KEY, "variant_id", "CSQ_SYMBOL", "CSQ_Gene", "CSQ_HGNC_ID"]
    return keep_consequences(fixture(spark, sf, "fx_variants")).select(*cols)


_GENE_V0 = f"""
, v0 AS (SELECT chromosome, start, reference, alternate, variant_id, CSQ_SYMBOL, CSQ_Gene, CSQ_HGNC_ID
 FROM fx_variants WHERE CSQ_Consequence IN {O.VEP_TERMS})"""


def _hg_join(on: str) -> str:
    return O.with_(["fx_variants", "fx_hgmd_gene", "fx_genes"], [O.CTE_HG], _GENE_V0 + f"""
SELECT v0.*, hg.entrez_gene_id, hg.hgnc, array_to_string(hg.HGMD_DM, ',') AS HGMD_DM,
 array_to_string(hg."HGMD_DM?", ',') AS "HGMD_DM?" FROM v0 LEFT JOIN hg ON {on}""")


def _hgmd_genes(spark, sf):
    return hgmd_gene_reference(fixture(spark, sf, "fx_hgmd_gene"), fixture(spark, sf, "fx_genes"),
                               dm_q_column="dm_q")


@register("hgmd_gene_by_hgnc", _hg_join("v0.CSQ_HGNC_ID = hg.hgnc"))
def q_hgmd_gene_by_hgnc(spark, sf):
    """J14, VEP form (HGNC id)."""
    return arrays_as_text(attach_hgmd_gene(_gene_slice(spark, sf), _hgmd_genes(spark, sf), "hgnc"))


@register("hgmd_gene_by_ensembl", _hg_join("v0.CSQ_Gene = hg.ensembl_gene_id"))
def q_hgmd_gene_by_ensembl(spark, sf):
    """J14, Dragon form (Ensembl id)."""
    return arrays_as_text(attach_hgmd_gene(_gene_slice(spark, sf), _hgmd_genes(spark, sf), "ensembl"))


@register("cosmic_join", O.with_(["fx_variants", "fx_hgmd_gene", "fx_genes", "fx_cosmic"], [O.CTE_HG],
          _GENE_V0 + """
SELECT v0.*, hg.entrez_gene_id, cs.Tier AS CGC_Tier, cs.Mutation_Types AS CGC_Mutation_Types
FROM v0 LEFT JOIN hg ON v0.CSQ_HGNC_ID = hg.hgnc LEFT JOIN fx_cosmic cs ON hg.entrez_gene_id = cs.Entrez_GeneId"""))
def q_cosmic_join(spark, sf):
    """J14 + J15: Cancer Gene Census through the HGMD gene's Entrez id."""
    v = attach_hgmd_gene(_gene_slice(spark, sf), _hgmd_genes(spark, sf), "hgnc")
    v = v.select(*KEY, "variant_id", "CSQ_SYMBOL", "CSQ_Gene", "CSQ_HGNC_ID", "entrez_gene_id")
    return attach_cosmic(v, fixture(spark, sf, "fx_cosmic"))


@register("orphanet_or_join", O.with_(["fx_variants", "fx_orphanet"], [O.CTE_ORPH], _GENE_V0 + """
SELECT v0.*, array_to_string(o.Orphanet_disorder_id_combined, ',') AS Orphanet_disorder_id_combined,
 array_to_string(o.Orphanet_gene_source_of_validation_combined, ',') AS Orphanet_gene_source_of_validation_combined,
 o.Orphanet_HGNC_gene_id,
 array_to_string(o.Orphanet_type_of_inheritance_combined, ',') AS Orphanet_type_of_inheritance_combined
FROM v0 LEFT JOIN orph o ON v0.CSQ_HGNC_ID = o.Orphanet_HGNC_gene_id OR v0.CSQ_Gene = o.ensembl_gene_id"""))
def q_orphanet_or_join(spark, sf):
    """HGNC-or-Ensembl join as a union of equi-joins."""
    out = attach_orphanet(_gene_slice(spark, sf), orphanet_by_gene(fixture(spark, sf, "fx_orphanet")))
    return arrays_as_text(out)


@register("gencc_join", O.with_(["fx_variants", "fx_gencc"], [O.cte_gencc()], _GENE_V0 + f"""
SELECT v0.*, {', '.join(f"array_to_string(g.{c}, ',') AS {c}" for c in O.GENCC_COLS)}
FROM v0 LEFT JOIN genc g ON v0.CSQ_HGNC_ID = g.GenCC_hgnc_id"""))
def q_gencc_join(spark, sf):
    """J21."""
    return arrays_as_text(attach_gencc(_gene_slice(spark, sf), gencc_by_gene(fixture(spark, sf, "fx_gencc"))))


# ------------------------------------------------------------- pipelines
@register("filter_vep", O.vep_pipeline("vep"))
def q_filter_vep(spark, sf):
    """The VEP filtering pipeline end to end."""
    return arrays_as_text(stored_filter_vep(fixture(spark, sf, "fx_variants"), vep_tables(spark, sf)))


@register("filter_dragon", O.vep_pipeline("dragon"))
def q_filter_dragon(spark, sf):
    """The Dragon variant of the pipeline."""
    return arrays_as_text(stored_filter_vep(fixture(spark, sf, "fx_variants"),
                                     vep_tables(spark, sf, dragon=True), source="dragon"))


def annovar_tables(spark: SparkSession, sf: str) -> AnnovarTables:
    fx = lambda n: fixture(spark, sf, n)
    return AnnovarTables(
        topmed=fx("fx_topmed"), dbnsfp=fx("fx_dbnsfp"), hgmd_gene=fx("fx_hgmd_gene"),
        hgmd_dm_q_column="dm_q", omim_gene=fx("fx_omim"), orphanet_gene=fx("fx_orphanet"),
        gencc=fx("fx_gencc"), spliceai=fx("fx_spliceai"), mmsplice=fx("fx_mmsplice"),
        clinvar=fx("fx_clinvar"), hgmd_var=fx("fx_hgmd_var"),
    )


@register("filter_annovar", O.annovar_pipeline())
def q_filter_annovar(spark, sf):
    """The ANNOVAR filtering pipeline end to end (K2 text output)."""
    return filter_annovar(fixture(spark, sf, "fx_annovar"), annovar_tables(spark, sf), write_input=False)


@register("symbol_gene_joins", O.with_(
    ["fx_annovar", "fx_hgmd_gene", "fx_omim", "fx_orphanet", "fx_gencc"],
    [O.CTE_OMIM, O.CTE_ORPH_TEXT, O.cte_gencc("gene_symbol", "GenCC_gene_symbol", "genc_s")], f"""
, v0 AS (SELECT chromosome, start, reference, alternate, Gene_refGene FROM fx_annovar WHERE {O.ANNOVAR_PRED})
SELECT v0.*, hm.entrez_gene_id, array_to_string(hm.DM, ',') AS HGMD_DM, array_to_string(hm.dm_q, ',') AS "HGMD_DM?",
 array_to_string(om.OMIM_gene_id, ',') AS OMIM_gene_id, om.OMIM_phenotype_combined,
 o.Orphanet_disorder_id_combined, o.Orphanet_gene_source_of_validation_combined, o.Orphanet_HGNC_gene_id,
 o.Orphanet_type_of_inheritance_combined, {', '.join(f"array_to_string(g.{c}, ',') AS {c}" for c in O.GENCC_COLS)}
FROM v0 LEFT JOIN fx_hgmd_gene hm ON v0.Gene_refGene = hm.symbol
 LEFT JOIN omim_g om ON hm.entrez_gene_id = om.OMIM_entrez_gene_id
 LEFT JOIN orph_t o ON v0.Gene_refGene = o.Orphanet_gene_symbol
 LEFT JOIN genc_s g ON v0.Gene_refGene = g.GenCC_gene_symbol"""))
def q_symbol_gene_joins(spark, sf):
    """J17 (+J16): ANNOVAR gene tables joined by gene symbol."""
    fx = lambda n: fixture(spark, sf, n)
    v = keep_exonic_or_splicing(fx("fx_annovar")).select(*KEY, "Gene_refGene")
    v = attach_hgmd_gene_by_symbol(v, fx("fx_hgmd_gene"), dm_q_column="dm_q")
    v = attach_omim(v, omim_by_gene(fx("fx_omim")))
    v = attach_orphanet_by_symbol(v, orphanet_by_gene_text(fx("fx_orphanet")))
    v = attach_gencc(v, gencc_by_gene(fx("fx_gencc"), "gene_symbol", "GenCC_gene_symbol"),
                     on_column="Gene_refGene", gene_key="GenCC_gene_symbol")
    return arrays_as_text(v)


@register("nested_to_text", O.with_(["fx_clinvar"], [O.CTE_CLV], """
SELECT chromosome, start, reference, alternate,
 CAST(to_json({'VariationID': VariationID, 'clin_sig': clin_sig}) AS VARCHAR) AS clinvar_json,
 array_to_string(clin_sig, ',') AS clin_sig FROM clv"""))
def q_nested_to_text(spark, sf):
    """Struct -> JSON text and array -> comma text."""
    hits = clinvar_pathogenic(fixture(spark, sf, "fx_clinvar"))
    nested = hits.select(*KEY, F.struct("VariationID", "clin_sig").alias("clinvar_json"), "clin_sig")
    return stringify_nested(nested)


_GG_TAIL = """
, ids AS (
 SELECT 'entrez' AS t, entrez_id AS id, true AS a, false AS b FROM fx_list_ecpg
 UNION ALL SELECT 'entrez', entrez_id, false, true FROM fx_list_emgp
 UNION ALL SELECT 'hgnc', hgnc_id, true, false FROM fx_list_ecpg
 UNION ALL SELECT 'hgnc', hgnc_id, false, true FROM fx_list_emgp
 UNION ALL SELECT 'symbol', symbol, true, false FROM fx_list_ecpg
 UNION ALL SELECT 'symbol', symbol, false, true FROM fx_list_emgp)
, mem AS (SELECT t, id, bool_or(a) AS a, bool_or(b) AS b FROM ids
 WHERE id IS NOT NULL AND id NOT IN ('', '-') GROUP BY t, id)
, m AS (
 SELECT p1.*,
  coalesce(e.a, false) OR coalesce(h.a, false) AS a_id, coalesce(e.b, false) OR coalesce(h.b, false) AS b_id,
  coalesce(s.a, false) AS a_sym, coalesce(s.b, false) AS b_sym
 FROM p1
 LEFT JOIN mem e ON e.t = 'entrez' AND e.id = CAST(p1.entrez_gene_id AS VARCHAR)
 LEFT JOIN mem h ON h.t = 'hgnc' AND h.id = p1.hgnc
 LEFT JOIN mem s ON s.t = 'symbol' AND s.id = p1.CSQ_SYMBOL)
, lab AS (
 SELECT *, a_id OR (NOT a_id AND NOT b_id AND a_sym) AS a_f, b_id OR (NOT a_id AND NOT b_id AND b_sym) AS b_f FROM m)
SELECT * EXCLUDE (a_id, b_id, a_sym, b_sym, a_f, b_f),
 CASE WHEN a_f AND b_f THEN 'ECPG/EMGP' WHEN a_f THEN 'ECPG' WHEN b_f THEN 'EMGP' ELSE '-' END AS gene_group
FROM lab"""


@register("gene_group", O.vep_pipeline("vep", extra_fixtures=["fx_list_ecpg", "fx_list_emgp"], tail=_GG_TAIL))
def q_gene_group(spark, sf):
    """Gene-panel label on the P1 result (two panels, id then symbol)."""
    p1 = stored_filter_vep(fixture(spark, sf, "fx_variants"), vep_tables(spark, sf))
    out = annotate_gene_group(p1, fixture(spark, sf, "fx_list_ecpg"), fixture(spark, sf, "fx_list_emgp"))
    return arrays_as_text(out)


_GOI_TAIL = """
, kept AS (SELECT * FROM p1 WHERE flag_keep = 1 AND (max_gtar IS NULL OR max_gtar < 0.0001::DOUBLE)
  AND (PredCountRatio_D2T IS NULL OR PredCountRatio_D2T >= 0.5::DOUBLE))
, gl AS (SELECT symbol, ncbi, ensembl,
  {'Germline_GOIs_names': symbol, 'entrez': ncbi, 'ensembl': ensembl, 'gene_desc': gene_desc} AS entry
  FROM fx_list_goi)
, by_e AS (SELECT ncbi AS id, any_value(entry) AS entry FROM gl WHERE ncbi NOT IN ('', '-') GROUP BY ncbi)
, by_n AS (SELECT ensembl AS id, any_value(entry) AS entry FROM gl WHERE ensembl NOT IN ('', '-') GROUP BY ensembl)
, by_s AS (SELECT symbol AS id, any_value(entry) AS entry FROM gl WHERE symbol NOT IN ('', '-') GROUP BY symbol)
, j AS (SELECT kept.*, coalesce(e.entry, n.entry, s.entry) AS entry FROM kept
 LEFT JOIN by_e e ON e.id = CAST(kept.entrez_gene_id AS VARCHAR)
 LEFT JOIN by_n n ON n.id = kept.CSQ_Gene
 LEFT JOIN by_s s ON s.id = kept.CSQ_SYMBOL)
SELECT * EXCLUDE (entry), entry.Germline_GOIs_names AS Germline_GOIs_names, entry.entrez AS entrez,
 entry.ensembl AS ensembl, entry.gene_desc AS gene_desc
FROM j WHERE entry IS NOT NULL"""


@register("attach_gene_list", O.vep_pipeline("vep", extra_fixtures=["fx_list_goi"], tail=_GOI_TAIL))
def q_attach_gene_list(spark, sf):
    """P5: genes-of-interest retention and lookup (Entrez, Ensembl, symbol) on P1."""
    p1 = stored_filter_vep(fixture(spark, sf, "fx_variants"), vep_tables(spark, sf))
    goi = fixture(spark, sf, "fx_list_goi").select(
        F.col("symbol").alias("Germline_GOIs_names"), F.col("ncbi").alias("entrez"),
        "ensembl", "gene_desc", F.monotonically_increasing_id().alias("line_no"))
    return arrays_as_text(attach_gene_list(p1, goi))


# ------------------------------------------------------------------- VCF
_WRITTEN: dict[tuple, str] = {}


def _written_once(spark: SparkSession, sf: str, what: str, write: Callable[[str], None]) -> str:
    """Path of a fixture file that ``write`` makes under the shared folder; made
    once for a session and state of the lineitem files."""
    files = spark.read.format("binaryFile").load(f"{sf}/lineitem.parquet").select(
        "path", "modificationTime", "length").orderBy("path").collect()
    key = (spark.sparkContext.applicationId, what, tuple(files))
    if key not in _WRITTEN:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/varlake-fixtures/{what}-{uuid.uuid4().hex}"
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def vcf_input(spark: SparkSession, sf: str, name: str = "fx_vcf_lines",
              head: list[str] = VCF_HEADER) -> DataFrame:
    """The fixture VCF read back as text (S1): its header lines, then one
    record per lineitem row, written once (header in the first part file,
    records in parallel part files) so the queries exercise the text reader."""
    header = spark.createDataFrame([(h,) for h in head], "line string").coalesce(1)
    body = fixture(spark, sf, name).select("line")
    return read_vcf(spark, _written_once(
        spark, sf, name, lambda path: write_text(header.unionByName(body), path, packed=True)))


_VL = """vl AS (
 SELECT concat('chr', CASE l_partkey % 25 WHEN 22 THEN 'X' WHEN 23 THEN 'Y' WHEN 24 THEN 'M'
   ELSE CAST(l_partkey % 25 + 1 AS STRING) END) AS chrom,
  CAST(1000 + l_partkey * 37 AS STRING) AS pos,
  substr('ACGT', CAST(l_partkey % 4 + 1 AS INT), 1) AS ref,
  CASE WHEN l_linenumber = 7 THEN '*' ELSE substr('CGTA', CAST(l_partkey % 4 + 1 AS INT), 1) END AS alt,
  CASE WHEN l_returnflag = 'R' THEN 'LowQual' ELSE 'PASS' END AS filt,
  concat('QD=', CAST(l_suppkey % 10 AS STRING), ';FS=', CAST(l_partkey % 80 AS STRING),
   CASE WHEN l_linenumber = 3 THEN '' ELSE ';MQ=60' END, CASE WHEN l_linenumber = 4 THEN ';TARGETED' ELSE '' END,
   ';CSQ=A|synonymous_variant||GENE', CAST(l_suppkey AS STRING), '|NM_', CAST(l_suppkey AS STRING),
   ',A|missense_variant|', CASE WHEN l_linenumber = 5 THEN '' ELSE '1' END, '|GENE', CAST(l_suppkey + 1 AS STRING),
   '|ENST', lpad(CAST(l_suppkey + 1 AS STRING), 11, '0'), '.2') AS info,
  l_linenumber AS ln, l_suppkey AS s, l_partkey AS p, l_orderkey AS o, CAST(l_quantity AS INT) AS q,
  l_returnflag AS rf
 FROM lineitem)"""


def _vcf_oracle(body: str) -> str:
    return "WITH " + _VL + "\n" + body


_GT_SQL = """CASE WHEN CAST(3 * ln AS DOUBLE) / CAST(q + 3 * ln AS DOUBLE) >= 0.8::DOUBLE THEN '1/1'
  WHEN CAST(3 * ln AS DOUBLE) / CAST(q + 3 * ln AS DOUBLE) >= 1 - 0.8::DOUBLE THEN '0/1' ELSE '0/0' END"""
_TAG_SQL = """CASE WHEN ln = 5 THEN info
  ELSE concat('Gene.refGene=GENE', CAST(s + 1 AS VARCHAR), ';Func.refGene=missense_variant;', info) END"""
_QC_SQL = "p % 25 <> 24 AND rf <> 'R' AND ln <> 4"
_GOOD_SQL = "q + 3 * ln >= 10 AND o % 99 >= 20 AND s % 10 >= 2 AND p % 80 <= 60"
_PICK_SQL = """'A' AS CSQ_Allele,
 CASE WHEN ln = 5 THEN 'synonymous_variant' ELSE 'missense_variant' END AS CSQ_Consequence,
 CASE WHEN ln = 5 THEN NULL ELSE '1' END AS CSQ_PICK,
 CASE WHEN ln = 5 THEN concat('GENE', CAST(s AS VARCHAR)) ELSE concat('GENE', CAST(s + 1 AS VARCHAR)) END AS CSQ_SYMBOL,
 CASE WHEN ln = 5 THEN concat('NM_', CAST(s AS VARCHAR))
  ELSE concat('ENST', lpad(CAST(s + 1 AS VARCHAR), 11, '0'), '.2') END AS CSQ_Feature"""
_FMT_SQL = """'0/1' AS S1_FORMAT_GT, concat(CAST(q AS VARCHAR), ',', CAST(3 * ln AS VARCHAR)) AS S1_FORMAT_AD,
 CAST(q + 3 * ln AS VARCHAR) AS S1_FORMAT_DP, CAST(o % 99 AS VARCHAR) AS S1_FORMAT_GQ"""
_INFO_SQL = """CAST(s % 10 AS VARCHAR) AS INFO_QD, CAST(p % 80 AS VARCHAR) AS INFO_FS,
 CASE WHEN ln = 3 THEN NULL ELSE '60' END AS INFO_MQ"""
_POS4 = 'chrom AS "#CHROM", pos AS POS, ref AS REF, alt AS ALT'


@register("vcf_info_values", _vcf_oracle(f"SELECT {_POS4}, {_INFO_SQL} FROM vl"))
def q_vcf_info_values(spark, sf):
    """S1/S2 + X1: INFO values by exact key for every record."""
    lines = vcf_input(spark, sf)
    spec = vcf_schema(lines)
    recs = vcf_records(lines)
    return recs.select("#CHROM", "POS", "REF", "ALT",
                       *[info_value("INFO", k).alias(f"INFO_{k}") for k in spec.info_ids])


@register("vcf_picked_transcript", _vcf_oracle(f"SELECT {_POS4}, {_PICK_SQL} FROM vl"))
def q_vcf_picked_transcript(spark, sf):
    """X2 + X4: sub-fields of the picked transcript (PICK/CANONICAL, else first)."""
    lines = vcf_input(spark, sf)
    spec = vcf_schema(lines)
    csq = info_value("INFO", spec.csq_key, missing_dot=False)
    t = picked_transcript(csq, spec.pick_index, ("1", "YES"))
    recs = vcf_records(lines).withColumn("__t", t)
    return recs.select("#CHROM", "POS", "REF", "ALT",
                       *[subfield(F.col("__t"), i).alias(f"CSQ_{n}") for i, n in enumerate(spec.csq_fields)])


@register("vcf_format_values", _vcf_oracle(f"SELECT {_POS4}, {_FMT_SQL} FROM vl"))
def q_vcf_format_values(spark, sf):
    """FORMAT values of the sample by key."""
    lines = vcf_input(spark, sf)
    spec = vcf_schema(lines)
    recs = vcf_records(lines)
    s0 = F.col("sample1")
    return recs.select("#CHROM", "POS", "REF", "ALT",
                       *[format_value("FORMAT", s0, k).alias(f"{spec.samples[0]}_FORMAT_{k}")
                         for k in spec.format_ids])


@register("vcf_adjusted_genotype", _vcf_oracle(f"SELECT {_POS4}, {_GT_SQL} AS S1_AdjustedGenotype FROM vl"))
def q_vcf_adjusted_genotype(spark, sf):
    """Allele-balance genotype for every record."""
    lines = vcf_input(spark, sf)
    spec = vcf_schema(lines)
    recs = vcf_records(lines)
    return recs.select("#CHROM", "POS", "REF", "ALT",
                       adjusted_genotype("FORMAT", F.col("sample1"))
                       .alias(f"{spec.samples[0]}_AdjustedGenotype"))


@register("vcf_gene_tag", _vcf_oracle(f"SELECT {_POS4}, {_TAG_SQL} AS INFO FROM vl"))
def q_vcf_gene_tag(spark, sf):
    """gene/consequence of the last PICK=1 transcript prepended to INFO."""
    lines = vcf_input(spark, sf)
    return tag_genes(vcf_records(lines), vcf_schema(lines)).select("#CHROM", "POS", "REF", "ALT", "INFO")


@register("vcf_site_qc", _vcf_oracle(
    f"SELECT {_POS4}, filt AS FILTER, {_TAG_SQL} AS INFO FROM vl WHERE {_QC_SQL} AND {_GOOD_SQL}"))
def q_vcf_site_qc(spark, sf):
    """F1-F5 (drop mode) + X7 on the records."""
    lines = vcf_input(spark, sf)
    return vcf_qc_records(lines).select("#CHROM", "POS", "REF", "ALT", "FILTER", "INFO")


@register("vcf_site_qc_flag", _vcf_oracle(
    f"SELECT {_POS4}, CASE WHEN {_GOOD_SQL} THEN 0 ELSE 1 END AS Flagged FROM vl WHERE {_QC_SQL}"))
def q_vcf_site_qc_flag(spark, sf):
    """depth/quality and site failures flagged instead of dropped."""
    lines = vcf_input(spark, sf)
    return vcf_qc_records(lines, mode="flag").select("#CHROM", "POS", "REF", "ALT", "Flagged")


@register("vcf_to_table", _vcf_oracle(f"""
SELECT * FROM (SELECT chrom AS "#CHROM", pos AS POS, '.' AS ID, ref AS REF, alt AS ALT, '50' AS QUAL,
 filt AS FILTER, {_INFO_SQL}, {_PICK_SQL}, {_FMT_SQL}, {_GT_SQL} AS S1_AdjustedGenotype
 FROM vl WHERE {_QC_SQL} AND {_GOOD_SQL} AND alt <> '*')
WHERE S1_AdjustedGenotype NOT IN ('./.', '0/0')"""))
def q_vcf_to_table(spark, sf):
    """QC, gene tag and flattening of a single-sample VCF."""
    return vcf_to_table(vcf_input(spark, sf))


_FMT_LONG_SQL = """'S1' AS sample, '0/1' AS FORMAT_GT, concat(CAST(q AS VARCHAR), ',', CAST(3 * ln AS VARCHAR)) AS FORMAT_AD,
 CAST(q + 3 * ln AS VARCHAR) AS FORMAT_DP, CAST(o % 99 AS VARCHAR) AS FORMAT_GQ"""


@register("vcf_to_table_long", _vcf_oracle(f"""
SELECT * FROM (SELECT chrom AS "#CHROM", pos AS POS, '.' AS ID, ref AS REF, alt AS ALT, '50' AS QUAL,
 filt AS FILTER, {_INFO_SQL}, {_PICK_SQL}, {_FMT_LONG_SQL}, {_GT_SQL} AS AdjustedGenotype
 FROM vl WHERE {_QC_SQL} AND {_GOOD_SQL} AND alt <> '*')
WHERE AdjustedGenotype NOT IN ('./.', '0/0')"""))
def q_vcf_to_table_long(spark, sf):
    """P0, cohort layout: one row per record and sample, sample names from
    each file's own header line."""
    return vcf_to_table(vcf_input(spark, sf), layout="long").drop("file")


def vcf_cohort_input(spark: SparkSession, sf: str, name: str = "fx_vcf_lines_cohort",
                     samples: tuple[str, ...] = ("S_",)) -> DataFrame:
    """A cohort of VCF files derived from ``lineitem`` (records dealt by
    ``l_orderkey``), each with its own sample names in its ``#CHROM`` line, and
    in ``fx_vcf_lines_mixed`` its own order of the annotation's sub-fields.
    Every file is one task's output: its header, then its records."""
    def write(path: str) -> None:
        files = cohort_files(spark, sf)
        rows = []
        for k in range(files):
            chrom = VCF_HEADER[-1].rsplit("\t", 1)[0] + "".join(f"\t{s}{k}" for s in samples)
            for i, h in enumerate([*VCF_HEADER[:-1], chrom]):
                if name == "fx_vcf_lines_mixed" and k % 2:
                    h = re.sub("Format: [^\"]+", f"Format: {MIXED_FORMAT}", h)
                rows.append((h, k, i))
        head = spark.createDataFrame(rows, "head string, part int, __at int")
        body = cohort_rows(spark, sf, files).withColumn("__at", F.lit(len(VCF_HEADER)))
        # Rows are dealt and sorted before they are made to lines.
        (body.unionByName(head, allowMissingColumns=True).repartition(files, "part")
         .sortWithinPartitions("part", "__at")
         .select(F.coalesce("head", cohort_line(name, files)).alias("line"), "part")
         .write.partitionBy("part").options(**PACKED_TEXT).text(path))

    return read_vcf(spark, _written_once(spark, sf, name, write))


# As many files as the Spark side writes.
_FILES_SQL = "(SELECT greatest(3, count(*) // 20000) FROM lineitem)"


@register("vcf_cohort_table", _vcf_oracle(f"""
SELECT * FROM (SELECT chrom AS "#CHROM", pos AS POS, '.' AS ID, ref AS REF, alt AS ALT, '50' AS QUAL,
 filt AS FILTER, {_INFO_SQL}, {_PICK_SQL}, concat('S_', CAST(o % {_FILES_SQL} AS VARCHAR)) AS sample,
 '0/1' AS FORMAT_GT, concat(CAST(q AS VARCHAR), ',', CAST(3 * ln AS VARCHAR)) AS FORMAT_AD,
 CAST(q + 3 * ln AS VARCHAR) AS FORMAT_DP, CAST(o % 99 AS VARCHAR) AS FORMAT_GQ,
 {_GT_SQL} AS AdjustedGenotype
 FROM vl WHERE {_QC_SQL} AND {_GOOD_SQL} AND alt <> '*')
WHERE AdjustedGenotype NOT IN ('./.', '0/0')"""))
def q_vcf_cohort_table(spark, sf):
    """P0 on a cohort of files with different sample names (long layout:
    each file's own header line names its sample)."""
    return vcf_to_table(vcf_cohort_input(spark, sf), layout="long").drop("file")


@register("vcf_transcript_rows", _vcf_oracle("""
SELECT chrom AS chromosome, CAST(pos AS BIGINT) AS start, '.' AS ID, ref AS reference, alt AS alternate,
 '50' AS quality, filt AS FILTER, CAST(s % 10 AS VARCHAR) AS INFO_QD, CAST(p % 80 AS VARCHAR) AS INFO_FS,
 CASE WHEN ln = 3 THEN NULL ELSE '60' END AS INFO_MQ,
 'A' AS Allele, 'missense_variant' AS Consequence, CASE WHEN ln = 5 THEN NULL ELSE '1' END AS PICK,
 concat('GENE', CAST(s + 1 AS VARCHAR)) AS SYMBOL, concat('ENST', lpad(CAST(s + 1 AS VARCHAR), 11, '0'), '.2') AS Feature,
 'S1' AS Indiv, '0/1' AS gt_GT, concat(CAST(q AS VARCHAR), ',', CAST(3 * ln AS VARCHAR)) AS gt_AD,
 CAST(q + 3 * ln AS VARCHAR) AS gt_DP, CAST(o % 99 AS VARCHAR) AS gt_GQ
FROM vl"""))
def q_vcf_transcript_rows(spark, sf):
    """P6 (S9, X3, F9, X9, X10, J22): one row per Ensembl transcript and sample."""
    return vcf_transcripts(vcf_input(spark, sf))


_TRANSCRIPT_SQL = """SELECT chrom AS chromosome, CAST(pos AS BIGINT) AS start, '.' AS ID, ref AS reference, alt AS alternate,
 '50' AS quality, filt AS FILTER, CAST(s % 10 AS VARCHAR) AS INFO_QD, CAST(p % 80 AS VARCHAR) AS INFO_FS,
 CASE WHEN ln = 3 THEN NULL ELSE '60' END AS INFO_MQ,
 'A' AS Allele, 'missense_variant' AS Consequence, CASE WHEN ln = 5 THEN NULL ELSE '1' END AS PICK,
 concat('GENE', CAST(s + 1 AS VARCHAR)) AS SYMBOL, concat('ENST', lpad(CAST(s + 1 AS VARCHAR), 11, '0'), '.2') AS Feature,
 {name} AS Indiv, '0/1' AS gt_GT, concat(CAST(q AS VARCHAR), ',', CAST(3 * ln AS VARCHAR)) AS gt_AD,
 CAST(q + 3 * ln AS VARCHAR) AS gt_DP, CAST(o % 99 AS VARCHAR) AS gt_GQ
FROM vl"""


@register("vcf_cohort_transcripts", _vcf_oracle(_TRANSCRIPT_SQL.format(
    name=f"concat('S_', CAST(o % {_FILES_SQL} AS VARCHAR))")))
def q_vcf_cohort_transcripts(spark, sf):
    """P6 on files with different sample names."""
    return vcf_transcripts(vcf_cohort_input(spark, sf))


@register("vcf_mixed_headers", _vcf_oracle(_TRANSCRIPT_SQL.format(
    name=f"concat('S_', CAST(o % {_FILES_SQL} AS VARCHAR))")))
def q_vcf_mixed_headers(spark, sf):
    """S2 and P6 on files whose headers give the annotation's sub-fields in
    different orders."""
    return vcf_transcripts(vcf_cohort_input(spark, sf, "fx_vcf_lines_mixed"))


@register("vcf_joint_qc", _vcf_oracle(f"""
, g AS (
 SELECT *, 'A_' AS who, '0/1' AS gt, concat(CAST(q AS VARCHAR), ',', CAST(3 * ln AS VARCHAR)) AS ad,
  q AS r0, 3 * ln AS r1, q + 3 * ln AS dp, o % 99 AS gq FROM vl
 UNION ALL
 SELECT *, 'B_', '0/1', concat('9,', CAST(p % 30 AS VARCHAR)), 9, p % 30, 9 + p % 30, s % 50 FROM vl)
SELECT chrom AS "#CHROM", pos AS POS, ref AS REF, alt AS ALT, concat(who, CAST(o % {_FILES_SQL} AS VARCHAR)) AS sample,
 gt AS FORMAT_GT, ad AS FORMAT_AD, CAST(dp AS VARCHAR) AS FORMAT_DP, CAST(gq AS VARCHAR) AS FORMAT_GQ,
 CASE WHEN r1 / (r0 + r1) >= 0.8::DOUBLE THEN '1/1' WHEN r1 / (r0 + r1) >= 1 - 0.8::DOUBLE THEN '0/1' ELSE '0/0' END
  AS AdjustedGenotype
FROM g WHERE {_QC_SQL} AND dp >= 10 AND gq >= 20 AND s % 10 >= 2 AND p % 80 <= 60 AND alt <> '*'"""))
def q_vcf_joint_qc(spark, sf):
    """F4 per record and sample (long layout) on files of two samples, named
    by each file and failing in turn."""
    lines = vcf_cohort_input(spark, sf, "fx_vcf_lines_joint", ("A_", "B_"))
    return vcf_to_table(lines, layout="long").select(
        "#CHROM", "POS", "REF", "ALT", "sample", "FORMAT_GT", "FORMAT_AD", "FORMAT_DP",
        "FORMAT_GQ", "AdjustedGenotype")


_ODD_GT = """CASE o % 4 WHEN 0 THEN './.' WHEN 1 THEN '1/2' WHEN 2 THEN './.'
  ELSE CASE WHEN 3 / (q + 3) >= 0.8::DOUBLE THEN '1/1' WHEN 3 / (q + 3) >= 1 - 0.8::DOUBLE THEN '0/1' ELSE '0/0' END END"""


@register("vcf_odd_records", _vcf_oracle(f"""
SELECT CAST(p % 22 + 1 AS VARCHAR) AS chromosome, CAST(1000 + p * 37 AS BIGINT) AS start,
 concat_ws('-', 'chr' || CAST(p % 22 + 1 AS VARCHAR), 1000 + p * 37, 'A', 'C') AS variant_id,
 CASE WHEN ln <= 4 OR o % 4 = 0 OR (o % 4 = 3 AND q + 3 < 10) THEN 1 ELSE 0 END AS Flagged,
 {_ODD_GT} AS genotype, CASE WHEN ln <= 5 THEN '5' END AS quality_by_depth,
 CASE ln WHEN 1 THEN '30' WHEN 5 THEN '60' END AS INFO_MQ
FROM vl WHERE o % 5 <> 0"""))
def q_vcf_odd_records(spark, sf):
    """F1, F5 (every metric fails in turn), F6, F19, F20, X6 (no call, no depth,
    three depths), X9, X11."""
    lines = vcf_input(spark, sf, "fx_vcf_lines_odd", ODD_HEADER)
    spec = vcf_schema(lines)
    flat = flatten_records(vcf_qc_records(lines, spec, mode="flag"), spec, variants_only=False,
                           carry=["Flagged"])
    out = drop_dotted(rename_columns(flat, {
        "INFO_QD": "quality_by_depth", "S1_AdjustedGenotype": "genotype"}))
    if any("." in c for c in out.columns):
        raise AssertionError("a dotted column stayed")
    out = out.withColumn("variant_id", variant_id("#CHROM", "POS", "REF", "ALT"))
    return with_variant_key(out).select("chromosome", "start", "variant_id", "Flagged", "genotype",
                                        "quality_by_depth", "INFO_MQ")


@register("vcf_ann_transcripts", _vcf_oracle("""
SELECT 'chr' || CAST(p % 22 + 1 AS VARCHAR) AS chromosome, CAST(1000 + p * 37 AS BIGINT) AS start, '5=' AS INFO_QD,
 'A' AS Allele, 'missense;x' AS Annotation, concat('ENST', CAST(s AS VARCHAR)) AS Feature_ID,
 concat('c.', CAST(ln AS VARCHAR)) AS "HGVS.c", 'S1' AS Indiv, '0/1' AS gt_GT FROM vl"""))
def q_vcf_ann_transcripts(spark, sf):
    """P6 in its ANN form: X10 escapes, X12 names and transcript ids."""
    out = vcf_transcripts(vcf_input(spark, sf, "fx_vcf_lines_ann", ANN_HEADER))
    return out.select("chromosome", "start", "INFO_QD", "Allele", "Annotation", "Feature_ID",
                      F.col("`HGVS.c`"), "Indiv", "gt_GT")


@register("vcf_to_gene_group", O.vep_pipeline(
    "vep", extra_fixtures=["fx_list_ecpg", "fx_list_emgp"], tail=_GG_TAIL))
def q_vcf_to_gene_group(spark, sf):
    """The reference's main workflow: P0 -> P1 -> P4 from VCF text on."""
    flat = vcf_to_table(vcf_input(spark, sf, "fx_vcf_lines_vep", VEP_HEADER))
    dash = lambda c: F.coalesce(F.col(c), F.lit("-")).alias(c)
    variants = flat.select(
        F.col("#CHROM"), "POS", "REF", "ALT", F.col("ID").alias("variant_id"), "CSQ_Consequence",
        "CSQ_SYMBOL", "CSQ_Gene", dash("CSQ_HGNC_ID"), dash("CSQ_gnomAD_AF"),
        dash("INFO_gnomad_3_1_1_AF"))
    result = filter_vep(variants, vep_tables(spark, sf))
    return arrays_as_text(annotate_gene_group(
        result, fixture(spark, sf, "fx_list_ecpg"), fixture(spark, sf, "fx_list_emgp")))


@register("orphanet_any_join", O.with_(["fx_variants", "fx_orphanet"], [], _GENE_V0 + """
, fam AS (SELECT concat('FAM', CAST(coalesce(HGNC_gene_id % 20, -1) AS VARCHAR)) AS sym, disorder_id, HGNC_gene_id AS h,
  ensembl_gene_id AS e FROM fx_orphanet)
, sets AS (SELECT sym, array_to_string(list_sort(list_distinct(list(disorder_id))), ',') AS Orphanet_disorder_id_combined
  FROM fam GROUP BY sym)
, ids AS (SELECT DISTINCT sym, concat('HGNC:', CAST(h AS VARCHAR)) AS id FROM fam WHERE h IS NOT NULL UNION SELECT DISTINCT sym, e FROM fam)
, hits AS (SELECT DISTINCT v.CSQ_HGNC_ID, v.CSQ_Gene, i.sym FROM (SELECT DISTINCT CSQ_HGNC_ID, CSQ_Gene FROM v0) v
  JOIN ids i ON i.id = v.CSQ_HGNC_ID OR i.id = v.CSQ_Gene)
SELECT v0.*, s.Orphanet_disorder_id_combined FROM v0
 LEFT JOIN hits h ON h.CSQ_HGNC_ID = v0.CSQ_HGNC_ID AND h.CSQ_Gene = v0.CSQ_Gene LEFT JOIN sets s ON s.sym = h.sym"""))
def q_orphanet_any_join(spark, sf):
    """J18 with genes of several ids, matched by any of them."""
    family = F.coalesce(F.col("HGNC_gene_id") % 20, F.lit(-1)).cast("string")
    families = fixture(spark, sf, "fx_orphanet").withColumn(
        "gene_symbol", F.concat(F.lit("FAM"), family))
    out = attach_orphanet(_gene_slice(spark, sf), orphanet_by_gene(families), multi_id="any")
    return arrays_as_text(out.select(*KEY, "variant_id", "CSQ_SYMBOL", "CSQ_Gene", "CSQ_HGNC_ID",
                                     "Orphanet_disorder_id_combined"))


# ------------------------------------------------------- written and read back
def _round_trip(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/varlake-round-trip-{uuid.uuid4().hex}"


@register("tsv_round_trip", O.with_(["fx_variants"], [], """
SELECT chromosome, CAST(start AS VARCHAR) AS start, reference, alternate, variant_id, CSQ_Consequence,
 nullif(CSQ_HGNC_ID, '-') AS CSQ_HGNC_ID, nullif(CSQ_gnomAD_AF, '-') AS CSQ_gnomAD_AF FROM fx_variants"""))
def q_tsv_round_trip(spark, sf):
    """The variant table as gzipped text and back; ``-`` is missing."""
    path = _round_trip(spark)
    write_result(fixture(spark, sf, "fx_variants").select(
        *KEY, "variant_id", "CSQ_Consequence", "CSQ_HGNC_ID", "CSQ_gnomAD_AF"), path)
    return read_variant_tsv(spark, path)


@register("sorted_result_file", O.with_(["fx_variants"], [], """
SELECT file_row, chromosome, start FROM (
 SELECT row_number() OVER (ORDER BY CASE WHEN chromosome IN ('X', 'Y') THEN 23 + ascii(chromosome) - ascii('X')
   ELSE CAST(chromosome AS INTEGER) END, start) AS file_row, chromosome, CAST(start AS VARCHAR) AS start
 FROM fx_variants)"""))
def q_sorted_result_file(spark, sf):
    """K3 and O1/O2: rows of the written files, numbered in file order, are in
    chromosome order."""
    path = _round_trip(spark)
    v = fixture(spark, sf, "fx_variants").select(*KEY, "variant_id")
    write_result(chromosome_order(v, bins=genomic_bins(v)), path, compression=None)
    files = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.split("value", "\t").alias("f"))
    rows = files.where(F.get("f", 0) != "chromosome")
    # Numbered per (file, block) first; only their counts meet in one place.
    within = F.row_number().over(Window.partitionBy("file", "block").orderBy("id"))
    sizes = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("file", "block").rowsBetween(
        Window.unboundedPreceding, -1))
    starts = sizes.select("file", "block", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.withColumn("within", within).join(F.broadcast(starts), ["file", "block"]).select(
        (F.col("before") + F.col("within")).cast("long").alias("file_row"),
        F.get("f", 0).alias("chromosome"), F.get("f", 1).alias("start"))


@register("vcf_body_round_trip", _vcf_oracle(
    f"SELECT {_POS4}, filt AS FILTER, info AS INFO FROM vl"))
def q_vcf_body_round_trip(spark, sf):
    """S3 and K5: records split from the header, written as a VCF body, read again."""
    path = _round_trip(spark)
    meta, body = split_header(vcf_input(spark, sf))
    write_vcf_body(vcf_records(body), path)
    return vcf_records(read_vcf(spark, path)).select("#CHROM", "POS", "REF", "ALT", "FILTER", "INFO")


@register("annotation_scan", "SELECT p_partkey AS key, p_size AS size FROM part")
def q_annotation_scan(spark, sf):
    """Two columns of a Parquet table under new names."""
    return read_annotation(spark, f"{sf}/part.parquet", {"p_partkey": "key", "p_size": "size"})


@register("panel_files", O.with_(["fx_list_ecpg", "fx_list_goi"], [], """
SELECT 'panel' AS list, symbol, hgnc_id AS first_id, entrez_id AS second_id, NULL AS gene_desc FROM fx_list_ecpg
UNION ALL SELECT 'goi', symbol, ncbi, ensembl, gene_desc FROM fx_list_goi"""))
def q_panel_files(spark, sf):
    """Both kinds of gene list written as files and read by their readers."""
    panel, goi = _round_trip(spark), _round_trip(spark)
    (fixture(spark, sf, "fx_list_ecpg").write.option("sep", "\t").option("header", True).csv(panel))
    (fixture(spark, sf, "fx_list_goi").select(F.concat_ws("\t", "symbol", "ncbi", "ensembl", "gene_desc"))
     .write.text(goi))
    a = read_gene_panel(spark, panel).select(
        F.lit("panel").alias("list"), "symbol", F.col("hgnc_id").alias("first_id"),
        F.col("entrez_id").alias("second_id"), F.lit(None).cast("string").alias("gene_desc"))
    b = read_goi_list(spark, goi).select(
        F.lit("goi").alias("list"), F.col("Germline_GOIs_names").alias("symbol"),
        F.col("entrez").alias("first_id"), F.col("ensembl").alias("second_id"), "gene_desc")
    return a.unionByName(b)


@register("filter_vep_cohort", O.vep_pipeline("vep"))
def q_filter_vep_cohort(spark, sf):
    """P1 as for a cohort: annotation by distinct keys, gene tables beyond the
    broadcast bound, hot keys split."""
    return arrays_as_text(stored_filter_vep(
        fixture(spark, sf, "fx_variants"), vep_tables(spark, sf), strategy="keys", limits=SHUFFLED))


@register("filter_annovar_cohort", O.annovar_pipeline())
def q_filter_annovar_cohort(spark, sf):
    """P3 as for a cohort."""
    return filter_annovar(fixture(spark, sf, "fx_annovar"), annovar_tables(spark, sf),
                          strategy="keys", write_input=False, limits=SHUFFLED)


from varlake.plans import catalog_files  # noqa: E402,F401  (registers its queries)


def queries() -> dict[str, Query]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracles() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


__all__ = ["REGISTRY", "queries", "oracles", "arrays_as_text", "vep_tables", "damage_ratio"]
