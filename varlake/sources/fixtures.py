"""Annotation-shaped tables derived from the driver's TPC-H-style tables.

The reference ships no data, so the variant, annotation and gene tables its
code reads are derived from ``lineitem`` / ``part`` / ``supplier`` by SQL
that runs unchanged on Spark and on DuckDB (the oracle).  Every derived
table grows with the scale factor of its source.

``fixture(spark, sf_dir, name)`` returns the Spark DataFrame;
``oracle_with(names, body)`` returns a DuckDB statement with the same
derivations as CTEs.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ("lineitem", "part", "supplier", "orders")


def _key(x: str) -> str:
    """The four-column variant key derived from one integer column."""
    return (
        f"CASE {x} % 24 WHEN 22 THEN 'X' WHEN 23 THEN 'Y' "
        f"ELSE CAST({x} % 24 + 1 AS STRING) END AS chromosome, "
        f"CAST(1000 + {x} * 37 AS BIGINT) AS start, "
        f"substr('ACGT', CAST({x} % 4 + 1 AS INT), 1) AS reference, "
        f"substr('CGTA', CAST({x} % 4 + 1 AS INT), 1) AS alternate"
    )


def _apart(x: str, rule: str, by: str) -> str:
    """``x``, moved by ``by`` where ``rule`` doesn't hold: such rows are read
    and carried along like all others, but match no variant."""
    return f"(CASE WHEN {rule} THEN {x} ELSE {x} + CAST({by} AS BIGINT) END)"


def _part(rule: str) -> str:
    """The variant key of a part row; it meets variants only where ``rule`` holds."""
    return _key(_apart("p_partkey", rule, "10000000000"))


def _gene(x: str, rule: str) -> str:
    """A gene number that variants carry only where ``rule`` holds."""
    return _apart(x, rule, "1000000000")


_CSQ = """';CSQ=A|synonymous_variant||GENE', CAST(l_suppkey AS STRING), '|NM_', CAST(l_suppkey AS STRING),
  ',A|missense_variant|', CASE WHEN l_linenumber = 5 THEN '' ELSE '1' END, '|GENE', CAST(l_suppkey + 1 AS STRING),
  '|ENST', lpad(CAST(l_suppkey + 1 AS STRING), 11, '0'), '.2')"""
_CSQ_MIXED = """';CSQ=A|GENE', CAST(l_suppkey AS STRING), '|NM_', CAST(l_suppkey AS STRING), '|synonymous_variant|',
  ',A|GENE', CAST(l_suppkey + 1 AS STRING), '|ENST', lpad(CAST(l_suppkey + 1 AS STRING), 11, '0'), '.2|missense_variant|',
  CASE WHEN l_linenumber = 5 THEN '' ELSE '1' END)"""

# One VCF record of a lineitem row; chr(9) is the tab.
_VCF_LINE = """concat_ws(chr(9), concat('chr', CASE l_partkey % 25 WHEN 22 THEN 'X' WHEN 23 THEN 'Y' WHEN 24 THEN 'M' ELSE CAST(l_partkey % 25 + 1 AS STRING) END),
 CAST(1000 + l_partkey * 37 AS STRING), '.', substr('ACGT', CAST(l_partkey % 4 + 1 AS INT), 1),
 CASE WHEN l_linenumber = 7 THEN '*' ELSE substr('CGTA', CAST(l_partkey % 4 + 1 AS INT), 1) END, '50',
 CASE WHEN l_returnflag = 'R' THEN 'LowQual' ELSE 'PASS' END,
 concat('QD=', CAST(l_suppkey % 10 AS STRING), ';FS=', CAST(l_partkey % 80 AS STRING), CASE WHEN l_linenumber = 3 THEN '' ELSE ';MQ=60' END,
  CASE WHEN l_linenumber = 4 THEN ';TARGETED' ELSE '' END, ';CSQ=A|synonymous_variant||GENE', CAST(l_suppkey AS STRING), '|NM_', CAST(l_suppkey AS STRING),
  ',A|missense_variant|', CASE WHEN l_linenumber = 5 THEN '' ELSE '1' END, '|GENE', CAST(l_suppkey + 1 AS STRING),
  '|ENST', lpad(CAST(l_suppkey + 1 AS STRING), 11, '0'), '.2'),
 'GT:AD:DP:GQ',
 concat('0/1:', CAST(CAST(l_quantity AS INT) AS STRING), ',', CAST(l_linenumber * 3 AS STRING), ':', CAST(CAST(l_quantity AS INT) + l_linenumber * 3 AS STRING), ':', CAST(l_orderkey % 99 AS STRING)))"""
_VCF_LINE_MIXED = _VCF_LINE.replace(_CSQ, _CSQ_MIXED)

# The cohort fixtures: the file that a row goes to, and its line there.
_COHORT_PART = "CAST(l_orderkey % {FILES} AS INT)"
_COHORT_LINES = {
    "fx_vcf_lines_cohort": _VCF_LINE,
    # The same with a second sample, which fails where the first passes and
    # the other way round.
    "fx_vcf_lines_joint": f"concat_ws(chr(9), {_VCF_LINE}, concat('0/1:9,', CAST(l_partkey % 30 AS STRING), "
        "':', CAST(9 + l_partkey % 30 AS STRING), ':', CAST(l_suppkey % 50 AS STRING)))",
    # Odd files give the annotation's sub-fields in another order.
    "fx_vcf_lines_mixed": f"CASE WHEN l_orderkey % {{FILES}} % 2 = 0 THEN {_VCF_LINE} ELSE {_VCF_LINE_MIXED} END",
}

_FIXTURES: dict[str, str] = {
    "fx_variants": """
SELECT {KEY:l_partkey}, concat('L', CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS variant_id,
 CASE l_linenumber WHEN 1 THEN 'missense_variant' WHEN 2 THEN 'synonymous_variant' WHEN 3 THEN 'stop_gained'
  WHEN 4 THEN 'intron_variant' WHEN 5 THEN 'frameshift_variant'
  WHEN 6 THEN 'missense_variant&splice_region_variant' ELSE 'splice_donor_variant' END AS CSQ_Consequence,
 concat('GENE', CAST(l_suppkey AS STRING)) AS CSQ_SYMBOL,
 concat('ENSG', lpad(CAST(l_suppkey AS STRING), 11, '0')) AS CSQ_Gene,
 CASE WHEN l_suppkey % 7 = 0 THEN '-' ELSE concat('HGNC:', CAST(l_suppkey + 100 AS STRING)) END AS CSQ_HGNC_ID,
 CASE WHEN l_orderkey % 3 = 0 THEN '-' ELSE concat('0.000', CAST(l_orderkey % 40 AS STRING)) END AS CSQ_gnomAD_AF,
 CASE WHEN l_orderkey % 5 = 0 THEN '-' ELSE concat('0.00', CAST(l_orderkey % 30 AS STRING)) END AS INFO_gnomad_3_1_1_AF
FROM {lineitem}""",
    "fx_annovar": """
SELECT {KEY:l_partkey}, concat('GENE', CAST(l_suppkey AS STRING)) AS Gene_refGene,
 CASE l_linenumber WHEN 1 THEN 'exonic' WHEN 2 THEN 'intronic' WHEN 3 THEN 'splicing' WHEN 4 THEN 'ncRNA_exonic'
  WHEN 5 THEN 'exonic;splicing' ELSE 'UTR3' END AS Func_refGene,
 CASE l_returnflag WHEN 'A' THEN 'nonsynonymous_SNV' WHEN 'R' THEN 'stopgain' ELSE 'synonymous_SNV' END AS ExonicFunc_refGene,
 CASE WHEN l_orderkey % 3 = 0 THEN '-' ELSE concat('0.0000', CAST(l_orderkey % 40 AS STRING)) END AS INFO_gnomad211_exome_AF,
 CASE WHEN l_orderkey % 5 = 0 THEN '-' ELSE concat('0.0000', CAST(l_orderkey % 30 AS STRING)) END AS INFO_gnomad211_genome_AF
FROM {lineitem}""",
    "fx_topmed": "SELECT {PART:p_partkey % 3 = 0}, CAST(p_size AS DOUBLE) / 16384 AS af FROM {part}",
    "fx_regeneron": "SELECT {PART:p_partkey % 4 = 1}, CAST(p_size AS DOUBLE) / 32768 AS REGENERON_ALL_AF FROM {part}",
    "fx_allofus": "SELECT {PART:p_partkey % 5 = 2}, CAST(p_size AS DOUBLE) / 65536 AS gvs_all_af FROM {part}",
    "fx_gnomad41_genome": "SELECT {PART:p_partkey % 6 = 1}, CAST(p_size AS DOUBLE) / 8192 AS gnomad41_genome_AF FROM {part}",
    "fx_gnomad41_exome": "SELECT {PART:p_partkey % 6 = 4}, CAST(p_size AS DOUBLE) / 4096 AS gnomad41_exome_AF FROM {part}",
    "fx_intervar": """
SELECT {PART:p_partkey % 7 < 3}, CASE p_size % 3 WHEN 0 THEN 'Benign' WHEN 1 THEN 'Uncertain_significance' ELSE 'Pathogenic' END AS InterVar_automated
FROM {part}""",
    "fx_spliceai": """
SELECT {PART:p_partkey % 2 = 1}, CAST(p_size AS DOUBLE) / 64 AS SpliceAI_DS_AG, CAST(p_size % 8 AS DOUBLE) / 8 AS SpliceAI_DS_AL,
 CAST(p_size % 4 AS DOUBLE) / 4 AS SpliceAI_DS_DG, CAST(p_size % 2 AS DOUBLE) / 2 AS SpliceAI_DS_DL FROM {part}""",
    "fx_mmsplice": """
SELECT {PART:p_partkey % 3 = 1}, CAST(p_size - 25 AS DOUBLE) / 16 AS mmsplice_delta_logit_psi, CAST(p_size AS DOUBLE) / 64 AS mmsplice_pathogenicity,
 CAST(p_size - 10 AS DOUBLE) / 32 AS mmsplice_efficiency FROM {part}""",
    "fx_dbnsfp": """
SELECT {PART:p_partkey % 2 = 0}, concat(CAST(p_size % 5 AS STRING), '_', CAST(CASE WHEN p_partkey % 11 = 0 THEN 0 ELSE 4 + p_size % 3 END AS STRING)) AS DamagePredCount
FROM {part}""",
    "fx_dbsnp": """
SELECT {KEY:l_partkey}, CASE WHEN l_orderkey % 13 = 0 THEN 'novel' ELSE concat('rs', CAST(l_orderkey AS STRING)) END AS name
FROM {lineitem}""",
    "fx_clinvar": """
SELECT {PART:p_partkey % 5 = 0}, concat('VCV', CAST(p_partkey AS STRING)) AS name,
 split(CASE p_size % 4 WHEN 0 THEN 'Pathogenic,Affects' WHEN 1 THEN 'Benign' WHEN 2 THEN 'Likely_pathogenic' ELSE 'Uncertain_significance' END, ',') AS clin_sig
FROM {part}""",
    "fx_hgmd_var": """
SELECT {PART:p_partkey % 4 = 0}, concat('CM', CAST(p_partkey AS STRING)) AS id, CASE p_size % 3 WHEN 0 THEN 'DM' WHEN 1 THEN 'DM?' ELSE 'DP' END AS variant_class
FROM {part}""",
    "fx_genes": """
SELECT s_suppkey AS entrez_gene_id, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE concat('HGNC:', CAST(s_suppkey + 100 AS STRING)) END AS hgnc,
 concat('ENSG', lpad(CAST(s_suppkey AS STRING), 11, '0')) AS ensembl_gene_id FROM {supplier}""",
    "fx_hgmd_gene": """
SELECT {GENE:s_suppkey:s_suppkey % 5 <> 4} AS entrez_gene_id, concat('GENE', CAST({GENE:s_suppkey:s_suppkey % 5 <> 4} AS STRING)) AS symbol,
 split(CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'dis1' ELSE 'dis1,dis2' END, ',') AS DM,
 split(CASE s_suppkey % 2 WHEN 0 THEN '' ELSE 'dis3' END, ',') AS dm_q FROM {supplier}""",
    "fx_gencc": """
SELECT concat('HGNC:', CAST({GENE:l_suppkey:l_suppkey % 3 <> 2} + 100 AS STRING)) AS gene_curie, concat('GENE', CAST({GENE:l_suppkey:l_suppkey % 3 <> 2} AS STRING)) AS gene_symbol,
 concat('MONDO:', CAST(l_partkey % 17 AS STRING)) AS disease_curie, concat('disease ', CAST(l_partkey % 17 AS STRING)) AS disease_title,
 CASE l_orderkey % 3 WHEN 0 THEN 'Definitive' WHEN 1 THEN 'Strong' ELSE 'Limited' END AS classification_title,
 CASE l_orderkey % 2 WHEN 0 THEN 'Autosomal dominant' ELSE 'Autosomal recessive' END AS moi_title
FROM {lineitem}""",
    "fx_omim": """
SELECT l_suppkey AS entrez_gene_id, 600000 + l_suppkey * 10 + l_orderkey % 3 AS omim_gene_id,
 CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE concat('phenotype ', CAST(l_partkey % 7 AS STRING)) END AS phenotype
FROM {lineitem}""",
    "fx_orphanet": """
SELECT concat('GENE', CAST(l_suppkey AS STRING)) AS gene_symbol, l_partkey % 9 AS disorder_id,
 CASE l_returnflag WHEN 'A' THEN '' WHEN 'R' THEN 'PMID1' ELSE 'PMID2' END AS gene_source_of_validation,
 CASE WHEN l_suppkey % 6 = 0 THEN NULL ELSE l_suppkey + 100 END AS HGNC_gene_id,
 split(CASE l_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'AD,AR' ELSE 'AD' END, ',') AS type_of_inheritance,
 concat('ENSG', lpad(CAST(l_suppkey AS STRING), 11, '0')) AS ensembl_gene_id
FROM {lineitem}""",
    "fx_cosmic": """
SELECT {GENE:s_suppkey:s_suppkey % 4 = 0} AS Entrez_GeneId, CAST(s_suppkey % 2 + 1 AS STRING) AS Tier, CASE s_suppkey % 3 WHEN 0 THEN 'Mis, N, F' ELSE 'T' END AS Mutation_Types
FROM {supplier}""",
    "fx_list_ecpg": """
SELECT concat('GENE', CAST({GENE:s_suppkey:s_suppkey % 2 = 0} AS STRING)) AS symbol, CASE WHEN s_suppkey % 4 = 0 THEN '-' ELSE concat('HGNC:', CAST({GENE:s_suppkey:s_suppkey % 2 = 0} + 100 AS STRING)) END AS hgnc_id,
 CASE WHEN s_suppkey % 8 = 0 THEN '-' ELSE CAST({GENE:s_suppkey:s_suppkey % 2 = 0} AS STRING) END AS entrez_id FROM {supplier}""",
    "fx_list_emgp": """
SELECT concat('GENE', CAST({GENE:s_suppkey:s_suppkey % 3 = 0} AS STRING)) AS symbol, concat('HGNC:', CAST({GENE:s_suppkey:s_suppkey % 3 = 0} + 100 AS STRING)) AS hgnc_id,
 CAST({GENE:s_suppkey:s_suppkey % 3 = 0} AS STRING) AS entrez_id FROM {supplier}""",
    "fx_list_goi": """
SELECT concat('GENE', CAST({GENE:s_suppkey:s_suppkey % 4 < 2} AS STRING)) AS symbol, CASE WHEN s_suppkey % 3 = 0 THEN '-' ELSE CAST({GENE:s_suppkey:s_suppkey % 4 < 2} AS STRING) END AS ncbi,
 CASE WHEN s_suppkey % 6 = 0 THEN '-' ELSE concat('ENSG', lpad(CAST({GENE:s_suppkey:s_suppkey % 4 < 2} AS STRING), 11, '0')) END AS ensembl,
 s_name AS gene_desc FROM {supplier}""",
    "fx_vcf_lines": "SELECT " + _VCF_LINE + " AS line FROM {lineitem}",
    # Records with odd features: failing site metrics, no annotation, calls
    # without depth or with three of them.
    "fx_vcf_lines_odd": """
SELECT concat_ws(chr(9), concat('chr', CAST(l_partkey % 22 + 1 AS STRING)), CAST(1000 + l_partkey * 37 AS STRING), '.',
 'A', 'C', '50', 'PASS',
 concat(CASE l_linenumber WHEN 1 THEN 'QD=5;MQ=30' WHEN 2 THEN 'QD=5;MQRankSum=-13.5' WHEN 3 THEN 'QD=5;ReadPosRankSum=-9'
   WHEN 4 THEN 'QD=5;SOR=4' WHEN 5 THEN 'QD=5;MQ=60' WHEN 6 THEN 'QD=.;Old.Name=x' ELSE 'MQRankSum=-12.4;SOR=3' END,
  CASE WHEN l_orderkey % 5 = 0 THEN '' ELSE concat(';CSQ=A|missense_variant|1|GENE', CAST(l_suppkey AS STRING), '|ENST1.2') END),
 'GT:AD:DP:GQ',
 CASE l_orderkey % 4 WHEN 0 THEN '.' WHEN 1 THEN '1/2:4,5,6:15:50' WHEN 2 THEN '0/1:0,0:20:50'
  ELSE concat('0/1:', CAST(CAST(l_quantity AS INT) AS STRING), ',3:', CAST(CAST(l_quantity AS INT) + 3 AS STRING), ':50') END) AS line
FROM {lineitem}""",
    # SnpEff form: ANN with spaces and quotes in its header, escapes in values.
    "fx_vcf_lines_ann": """
SELECT concat_ws(chr(9), concat('chr', CAST(l_partkey % 22 + 1 AS STRING)), CAST(1000 + l_partkey * 37 AS STRING), '.',
 'A', 'C', '50', 'PASS',
 concat('QD=5', chr(92), 'x3d;ANN=A|missense', chr(92), 'x3bx|ENST', CAST(l_suppkey AS STRING), '.7|c.', CAST(l_linenumber AS STRING),
  ',A|up|NM_', CAST(l_suppkey AS STRING), '|'), 'GT', '0/1') AS line
FROM {lineitem}""",
    # The variant table as annotated VCF records.
    "fx_vcf_lines_vep": """
SELECT concat_ws(chr(9), concat('chr', chromosome), CAST(start AS STRING), variant_id, reference, alternate, '50', 'PASS',
 concat('gnomad_3_1_1_AF=', INFO_gnomad_3_1_1_AF, ';CSQ=A|', CSQ_Consequence, '|1|', CSQ_SYMBOL, '|', CSQ_Gene, '|', CSQ_HGNC_ID, '|', CSQ_gnomAD_AF),
 'GT:AD:DP:GQ', '0/1:10,10:20:50') AS line
FROM ({VARIANTS}) v""",
    # Records of cohort file ``part``; files grow in number with the table.
    **{name: f"SELECT {line} AS line, {_COHORT_PART} AS part FROM {{lineitem}}"
       for name, line in _COHORT_LINES.items()},
}
# The VCF header that goes with ``fx_vcf_lines``.
VCF_HEADER = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=QD,Number=1,Type=Float,Description="Variant Confidence/Quality by Depth">',
    '##INFO=<ID=FS,Number=1,Type=Float,Description="Phred-scaled p-value using Fisher\'s exact test to detect strand bias">',
    '##INFO=<ID=MQ,Number=1,Type=Float,Description="RMS Mapping Quality">',
    '##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations from Ensembl VEP. Format: Allele|Consequence|PICK|SYMBOL|Feature">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="Allelic depths for the ref and alt alleles">',
    '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Approximate read depth">',
    '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="Genotype Quality">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1",
]

# Headers of the other fixtures: the VCF header with other annotations.
ODD_HEADER = VCF_HEADER[:-1] + [
    f'##INFO=<ID={name},Number=1,Type=Float,Description="site metric">'
    for name in ("MQRankSum", "ReadPosRankSum", "SOR", "Old.Name")] + VCF_HEADER[-1:]
ANN_HEADER = [
    '##INFO=<ID=QD,Number=1,Type=Float,Description="quality">',
    "##INFO=<ID=ANN,Number=.,Type=String,Description=\"Functional annotations: 'Allele | Annotation | Feature_ID | HGVS.c' \">",
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">', VCF_HEADER[-1]]
VEP_HEADER = [
    '##INFO=<ID=gnomad_3_1_1_AF,Number=A,Type=Float,Description="frequency">',
    '##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations from Ensembl VEP. '
    'Format: Allele|Consequence|PICK|SYMBOL|Gene|HGNC_ID|gnomAD_AF">',
    *[h for h in VCF_HEADER if h.startswith("##FORMAT")], VCF_HEADER[-1]]

# The header of the odd files of ``fx_vcf_lines_mixed``.
MIXED_FORMAT = "Allele|SYMBOL|Feature|Consequence|PICK"

_KEY_MACRO = re.compile(r"\{KEY:(\w+)\}")
_PART_MACRO = re.compile(r"\{PART:([^{}]+)\}")
_GENE_MACRO = re.compile(r"\{GENE:(\w+):([^{}]+)\}")


def fixture_names() -> list[str]:
    return sorted(_FIXTURES)


@lru_cache(maxsize=None)
def _expanded(name: str) -> str:
    sql = _FIXTURES[name].replace("{VARIANTS}", _FIXTURES["fx_variants"])
    sql = _KEY_MACRO.sub(lambda m: _key(m.group(1)), sql)
    sql = _PART_MACRO.sub(lambda m: _part(m.group(1)), sql)
    return _GENE_MACRO.sub(lambda m: _gene(m.group(1), m.group(2)), sql).strip()


def fixture_sql(name: str, engine: str = "duckdb") -> str:
    """Derivation SQL of ``name``: base tables as ``{lineitem}`` placeholders
    for Spark (``spark.sql(..., lineitem=df)``), plain names for DuckDB."""
    sql = _expanded(name)
    if engine == "duckdb":
        for t in BASE_TABLES:
            sql = sql.replace("{" + t + "}", t)
    return sql


def cohort_files(spark: SparkSession, sf_dir: str) -> int:
    """How many files the cohort fixtures have; one for 20,000 records, three at least."""
    return max(3, base_table(spark, sf_dir, "lineitem").count() // 20_000)


_SCHEMAS: dict[str, object] = {}


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is inferred once per path (inference reads
    the parquet footers in a job) and given explicitly afterwards."""
    path = f"{sf_dir}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark DataFrame of a derived table (lazy; scans only its base table)."""
    sql = fixture_sql(name, engine="spark")
    if "{FILES}" in sql:
        sql = sql.replace("{FILES}", str(cohort_files(spark, sf_dir)))
    used = {t: base_table(spark, sf_dir, t) for t in BASE_TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def cohort_rows(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """The rows that cohort lines are made of, with the ``part`` each goes to:
    a fourth of the lines' size, so they are dealt first and made to lines then."""
    columns = sorted(set(re.findall(r"l_\w+", "".join(_COHORT_LINES.values()))))
    part = F.expr(_COHORT_PART.replace("{FILES}", str(files))).alias("part")
    return base_table(spark, sf_dir, "lineitem").select(*columns, part)


def cohort_line(name: str, files: int) -> Column:
    """The line of a :func:`cohort_rows` row in cohort fixture ``name``."""
    return F.expr(_COHORT_LINES[name].replace("{FILES}", str(files)))


def fixtures(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: fixture(spark, sf_dir, n) for n in names}


def oracle_with(names: list[str] | tuple[str, ...], body: str) -> str:
    """DuckDB statement: the derivations of ``names`` as CTEs, then ``body``."""
    ctes = ",\n".join(f"{n} AS (\n{fixture_sql(n)}\n)" for n in names)
    return f"WITH {ctes}\n{body}"
