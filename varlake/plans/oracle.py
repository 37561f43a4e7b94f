"""DuckDB statements that state each registered query independently.

They run on the driver's tables (views ``lineitem``, ``part``, ``supplier``
...) with the derived tables of :mod:`varlake.sources.fixtures` as CTEs.
Arrays are compared as comma-joined text of their sorted elements.
"""

from __future__ import annotations

from varlake.sources.fixtures import oracle_with

K = "chromosome, start, reference, alternate"


def keq(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in K.split(", "))


def in_list(values) -> str:
    return "(" + ", ".join("'" + v + "'" for v in values) + ")"


# Fixed values, stated here again: the statements don't take them from the code they check.
_CONSEQUENCES = [
    "transcript_ablation", "splice_acceptor_variant", "splice_donor_variant", "stop_gained",
    "frameshift_variant", "stop_lost", "start_lost", "transcript_amplification",
    "inframe_insertion", "inframe_deletion", "missense_variant", "protein_altering_variant",
    "splice_region_variant", "incomplete_terminal_codon_variant", "start_retained_variant",
    "stop_retained_variant", "coding_sequence_variant",
]
_EXONIC = [
    "frameshift_insertion", "frameshift_deletion", "frameshift_block_substitution", "stopgain",
    "stoploss", "nonframeshift_insertion", "nonframeshift_deletion",
    "nonframeshift_block_substitution", "nonsynonymous_SNV",
]
VEP_TERMS = in_list(_CONSEQUENCES)
ANNOVAR_TERMS = in_list(_EXONIC)

ANNOVAR_PRED = (
    f"((contains(Func_refGene, 'exonic') AND ExonicFunc_refGene IN {ANNOVAR_TERMS}) "
    "OR Func_refGene = 'splicing')"
)


def sorted_set(expr: str) -> str:
    return f"list_sort(list_distinct(list({expr})))"


def text(expr: str) -> str:
    return f"array_to_string({expr}, ',')"


def bracket(expr: str, null_if_empty: bool = True) -> str:
    body = f"'[' || array_to_string({expr}, ', ') || ']'"
    if null_if_empty:
        return f"CASE WHEN len({expr}) = 0 THEN NULL ELSE {body} END"
    return body


def nested_bracket(expr: str) -> str:
    """Spark's text form of array<array<string>>: ``[[a, b], [c]]``."""
    inner = f"list_transform({expr}, lambda x: '[' || array_to_string(x, ', ') || ']')"
    return f"CASE WHEN len({expr}) = 0 THEN NULL ELSE '[' || array_to_string({inner}, ', ') || ']' END"


CTE_DBSNP = r"""dbsnp_c AS (
 SELECT DISTINCT chromosome, start, reference, alternate, name,
  TRY_CAST(regexp_extract(name, 'rs(\d+)', 1) AS BIGINT) AS num FROM fx_dbsnp),
dbsnp_best AS (
 SELECT c.chromosome, c.start, c.reference, c.alternate, c.name AS DBSNP_RSID
 FROM dbsnp_c c JOIN (SELECT chromosome, start, reference, alternate, min(num) AS m
   FROM dbsnp_c GROUP BY chromosome, start, reference, alternate) b
 ON c.chromosome = b.chromosome AND c.start = b.start AND c.reference = b.reference
  AND c.alternate = b.alternate AND c.num = b.m)"""

CTE_DBN = """dbn AS (
 SELECT chromosome, start, reference, alternate, DamagePredCount,
  CASE WHEN TRY_CAST(split_part(DamagePredCount, '_', 2) AS DOUBLE) = 0 THEN NULL
   ELSE TRY_CAST(split_part(DamagePredCount, '_', 1) AS DOUBLE)
      / TRY_CAST(split_part(DamagePredCount, '_', 2) AS DOUBLE) END AS PredCountRatio_D2T
 FROM fx_dbnsfp)"""

CTE_CLV = """clv AS (
 SELECT chromosome, start, reference, alternate, name AS VariationID, clin_sig FROM fx_clinvar
 WHERE list_has_any(clin_sig, ['Pathogenic', 'Likely_pathogenic']))"""

CTE_HGV = """hgv AS (
 SELECT chromosome, start, reference, alternate, id AS HGMDID, variant_class FROM fx_hgmd_var
 WHERE starts_with(variant_class, 'DM'))"""

CTE_HG = """hg AS (
 SELECT h.entrez_gene_id, gr.hgnc, gr.ensembl_gene_id, h.symbol AS HGMD_symbol,
  CASE WHEN len(h.DM) = 0 OR h.DM = [''] THEN NULL ELSE h.DM END AS HGMD_DM,
  CASE WHEN len(h.dm_q) = 0 OR h.dm_q = [''] THEN NULL ELSE h.dm_q END AS "HGMD_DM?"
 FROM fx_hgmd_gene h LEFT JOIN fx_genes gr ON h.entrez_gene_id = gr.entrez_gene_id)"""

CTE_OMIM = f"""omim_g AS (
 SELECT entrez_gene_id AS OMIM_entrez_gene_id, {sorted_set('omim_gene_id')} AS OMIM_gene_id,
  {bracket(sorted_set('phenotype'))} AS OMIM_phenotype_combined
 FROM fx_omim GROUP BY entrez_gene_id)"""

_SRC = "list_filter(" + sorted_set("gene_source_of_validation") + ", lambda x: x <> '')"
_INH = "list_filter(flatten(" + sorted_set("type_of_inheritance") + "), lambda x: x <> '')"
CTE_ORPH = f"""orph AS (
 SELECT gene_symbol AS Orphanet_gene_symbol,
  {sorted_set('disorder_id')} AS Orphanet_disorder_id_combined,
  array_to_string({sorted_set("'HGNC:' || CAST(HGNC_gene_id AS VARCHAR)")}, ',') AS Orphanet_HGNC_gene_id,
  array_to_string({sorted_set('ensembl_gene_id')}, ',') AS ensembl_gene_id,
  CASE WHEN len({_SRC}) = 0 THEN NULL ELSE {_SRC} END AS Orphanet_gene_source_of_validation_combined,
  CASE WHEN len({_INH}) = 0 THEN NULL ELSE {_INH} END AS Orphanet_type_of_inheritance_combined
 FROM fx_orphanet GROUP BY gene_symbol)"""

CTE_ORPH_TEXT = f"""orph_t AS (
 SELECT gene_symbol AS Orphanet_gene_symbol,
  {bracket(sorted_set('disorder_id'), null_if_empty=False)} AS Orphanet_disorder_id_combined,
  {bracket(sorted_set('gene_source_of_validation'))} AS Orphanet_gene_source_of_validation_combined,
  {bracket(sorted_set('HGNC_gene_id'))} AS Orphanet_HGNC_gene_id,
  {nested_bracket(sorted_set('type_of_inheritance'))} AS Orphanet_type_of_inheritance_combined
 FROM fx_orphanet GROUP BY gene_symbol)"""


def cte_gencc(by: str = "gene_curie", key: str = "GenCC_hgnc_id", name: str = "genc") -> str:
    return f"""{name} AS (
 SELECT {by} AS {key},
  {sorted_set('disease_curie')} AS GenCC_disease_curie_combined,
  {sorted_set('disease_title')} AS GenCC_disease_title_combined,
  {sorted_set('classification_title')} AS GenCC_classification_title_combined,
  {sorted_set('moi_title')} AS GenCC_moi_title_combined
 FROM fx_gencc GROUP BY {by})"""


GENCC_COLS = [
    "GenCC_disease_curie_combined", "GenCC_disease_title_combined",
    "GenCC_classification_title_combined", "GenCC_moi_title_combined",
]


def with_(fixtures, ctes, body) -> str:
    extra = ",\n".join(ctes)
    if extra:
        body = "," + extra + "\n" + body
    return oracle_with(list(fixtures), body)


VEP_FIX = [
    "fx_variants", "fx_regeneron", "fx_allofus", "fx_dbsnp", "fx_intervar", "fx_topmed",
    "fx_dbnsfp", "fx_clinvar", "fx_hgmd_var", "fx_genes", "fx_hgmd_gene", "fx_cosmic",
    "fx_omim", "fx_orphanet", "fx_gencc",
]


def vep_pipeline(source: str = "vep", maf: float = 0.001, extra_fixtures=(), tail: str | None = None) -> str:
    """P1/P2 stated as one SQL statement (the oracle of filter_vep).

    The result (arrays as text) is the CTE ``p1``; ``tail`` continues the
    statement from there (default ``SELECT * FROM p1``)."""
    dragon = source == "dragon"
    fix = VEP_FIX + (["fx_gnomad41_genome", "fx_gnomad41_exome"] if dragon else []) + list(extra_fixtures)
    g41_join = (
        "LEFT JOIN fx_gnomad41_genome g41g ON " + keq("v0", "g41g") + "\n"
        "LEFT JOIN fx_gnomad41_exome g41e ON " + keq("v0", "g41e") + "\n"
        if dragon else ""
    )
    g41_cols = "g41g.gnomad41_genome_AF, g41e.gnomad41_exome_AF," if dragon else ""
    if dragon:
        freqs = "TOPMed_af, gnomad41_genome_AF, gnomad41_exome_AF, REGENERON_ALL_AF, ALLOFUS_GVS_ALL_AF"
        hg_on, hgnc_col = "f.CSQ_Gene = hg.ensembl_gene_id", "hgnc"
    else:
        freqs = ("TRY_CAST(CSQ_gnomAD_AF AS DOUBLE), TRY_CAST(INFO_gnomad_3_1_1_AF AS DOUBLE), "
                 "TOPMed_af, REGENERON_ALL_AF, ALLOFUS_GVS_ALL_AF")
        hg_on, hgnc_col = "f.CSQ_HGNC_ID = hg.hgnc", "CSQ_HGNC_ID"
    orph_cols = ["Orphanet_disorder_id_combined", "Orphanet_gene_source_of_validation_combined"]
    if not dragon:
        orph_cols.append("Orphanet_HGNC_gene_id")
    orph_cols.append("Orphanet_type_of_inheritance_combined")
    arrays = ["clin_sig", "HGMD_DM", "HGMD_DM?", "OMIM_gene_id", "Orphanet_disorder_id_combined",
              "Orphanet_gene_source_of_validation_combined", "Orphanet_type_of_inheritance_combined",
              *GENCC_COLS]
    body = f"""
, v0 AS (SELECT * FROM fx_variants WHERE CSQ_Consequence IN {VEP_TERMS})
, a AS (
 SELECT v0.*, r.REGENERON_ALL_AF, al.gvs_all_af AS ALLOFUS_GVS_ALL_AF, d.DBSNP_RSID,
  iv.InterVar_automated, {g41_cols} t.af AS TOPMed_af, n.DamagePredCount, n.PredCountRatio_D2T,
  c.VariationID, c.clin_sig, h.HGMDID, h.variant_class
 FROM v0
 LEFT JOIN fx_regeneron r ON {keq('v0', 'r')}
 LEFT JOIN fx_allofus al ON {keq('v0', 'al')}
 LEFT JOIN dbsnp_best d ON {keq('v0', 'd')}
 LEFT JOIN fx_intervar iv ON {keq('v0', 'iv')}
 {g41_join}LEFT JOIN fx_topmed t ON {keq('v0', 't')}
 LEFT JOIN dbn n ON {keq('v0', 'n')}
 LEFT JOIN clv c ON {keq('v0', 'c')}
 LEFT JOIN hgv h ON {keq('v0', 'h')})
, f AS (
 SELECT *, greatest(0.0::DOUBLE, {freqs}) AS max_gtar FROM a)
, f2 AS (
 SELECT *, CASE WHEN VariationID IS NOT NULL OR HGMDID IS NOT NULL OR max_gtar <= {maf}::DOUBLE
   THEN 1 ELSE 0 END AS flag_keep FROM f)
, gh AS (
 SELECT f.*, hg.entrez_gene_id, hg.hgnc, hg.HGMD_DM, hg."HGMD_DM?" FROM f2 f LEFT JOIN hg ON {hg_on})
, gc AS (
 SELECT gh.*, cs.Tier AS CGC_Tier, cs.Mutation_Types AS CGC_Mutation_Types
 FROM gh LEFT JOIN fx_cosmic cs ON gh.entrez_gene_id = cs.Entrez_GeneId)
, gm AS (
 SELECT gc.*, om.OMIM_gene_id, om.OMIM_phenotype_combined
 FROM gc LEFT JOIN omim_g om ON gc.entrez_gene_id = om.OMIM_entrez_gene_id)
, go AS (
 SELECT gm.*, {', '.join('o.' + c for c in orph_cols)}
 FROM gm LEFT JOIN orph o ON gm.{hgnc_col} = o.Orphanet_HGNC_gene_id OR gm.CSQ_Gene = o.ensembl_gene_id)
, ge AS (
 SELECT go.*, {', '.join('ge0.' + c for c in GENCC_COLS)}
 FROM go LEFT JOIN genc ge0 ON go.{hgnc_col} = ge0.GenCC_hgnc_id)
, res AS (SELECT DISTINCT * FROM ge)
, p1 AS (SELECT * REPLACE ({', '.join(text(f'"{c}"') + f' AS "{c}"' for c in arrays)}) FROM res)
{tail or "SELECT * FROM p1"}"""
    ctes = [CTE_DBSNP, CTE_DBN, CTE_CLV, CTE_HGV, CTE_HG, CTE_OMIM, CTE_ORPH, cte_gencc()]
    return with_(fix, ctes, body)


def annovar_pipeline(maf: float = 0.0001) -> str:
    """P3 stated as one SQL statement (the oracle of filter_annovar)."""
    splice = ["SpliceAI_DS_AG", "SpliceAI_DS_AL", "SpliceAI_DS_DG", "SpliceAI_DS_DL"]
    mms = ["mmsplice_delta_logit_psi", "mmsplice_pathogenicity", "mmsplice_efficiency"]
    arrays = ["clin_sig", "HGMD_DM", "HGMD_DM?", "OMIM_gene_id", *GENCC_COLS]
    fix = ["fx_annovar", "fx_topmed", "fx_dbnsfp", "fx_clinvar", "fx_hgmd_var", "fx_hgmd_gene",
           "fx_omim", "fx_orphanet", "fx_gencc", "fx_spliceai", "fx_mmsplice"]
    body = f"""
, v0 AS (SELECT * FROM fx_annovar WHERE {ANNOVAR_PRED})
, a AS (
 SELECT v0.*, t.af AS TOPMed_af, n.DamagePredCount, n.PredCountRatio_D2T, c.VariationID, c.clin_sig,
  h.HGMDID, h.variant_class, {', '.join('s.' + x for x in splice)}, {', '.join('m.' + x for x in mms)}
 FROM v0 LEFT JOIN fx_topmed t ON {keq('v0', 't')}
 LEFT JOIN dbn n ON {keq('v0', 'n')}
 LEFT JOIN clv c ON {keq('v0', 'c')}
 LEFT JOIN hgv h ON {keq('v0', 'h')}
 LEFT JOIN fx_spliceai s ON {keq('v0', 's')}
 LEFT JOIN fx_mmsplice m ON {keq('v0', 'm')})
, f AS (SELECT *, greatest(0.0::DOUBLE, TRY_CAST(INFO_gnomad211_exome_AF AS DOUBLE),
  TRY_CAST(INFO_gnomad211_genome_AF AS DOUBLE), TOPMed_af) AS max_gnomad_topmed FROM a)
, f2 AS (SELECT *, CASE WHEN VariationID IS NOT NULL OR HGMDID IS NOT NULL
  OR max_gnomad_topmed <= {maf}::DOUBLE THEN 1 ELSE 0 END AS flag_keep FROM f)
, gh AS (SELECT f2.*, hm.entrez_gene_id, hm.DM AS HGMD_DM, hm.dm_q AS "HGMD_DM?"
 FROM f2 LEFT JOIN fx_hgmd_gene hm ON f2.Gene_refGene = hm.symbol)
, gm AS (SELECT gh.*, om.OMIM_gene_id, om.OMIM_phenotype_combined
 FROM gh LEFT JOIN omim_g om ON gh.entrez_gene_id = om.OMIM_entrez_gene_id)
, go AS (SELECT gm.*, o.Orphanet_disorder_id_combined, o.Orphanet_gene_source_of_validation_combined,
  o.Orphanet_HGNC_gene_id, o.Orphanet_type_of_inheritance_combined
 FROM gm LEFT JOIN orph_t o ON gm.Gene_refGene = o.Orphanet_gene_symbol)
, ge AS (SELECT go.*, {', '.join('g.' + c for c in GENCC_COLS)}
 FROM go LEFT JOIN genc_s g ON go.Gene_refGene = g.GenCC_gene_symbol)
SELECT * REPLACE ({', '.join(f'coalesce(array_to_string("{c}", \',\'), \'\') AS "{c}"' for c in arrays)}) FROM ge"""
    ctes = [CTE_DBN, CTE_CLV, CTE_HGV, CTE_OMIM, CTE_ORPH_TEXT,
            cte_gencc("gene_symbol", "GenCC_gene_symbol", "genc_s")]
    return with_(fix, ctes, body)
