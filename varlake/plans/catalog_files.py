"""Registered queries on files: cohorts of part files, results as users get
them.  :mod:`varlake.plans.catalog` imports this module at its end."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varlake.config import written
from varlake.functions.keys import KEY
from varlake.operators.filters import keep_consequences
from varlake.operators.ordering import has_rows
from varlake.operators.panels import annotate_gene_group, attach_gene_list
from varlake.plans import oracle as O
from varlake.plans.catalog import (
    SHUFFLED,
    _FILES_SQL,
    _GG_TAIL,
    _GOI_TAIL,
    _GOOD_SQL,
    _GT_SQL,
    _INFO_SQL,
    _PICK_SQL,
    _POS4,
    _QC_SQL,
    _TAG_SQL,
    _TRANSCRIPT_SQL,
    _round_trip,
    _vcf_oracle,
    _written_once,
    arrays_as_text,
    register,
    stored_filter_vep,
    vcf_cohort_input,
    vcf_input,
    vep_tables,
)
from varlake.plans.reannotate import reannotate
from varlake.plans.vcf_table import vcf_qc_records, vcf_to_table, vcf_transcripts
from varlake.plans.vcf_tidy import (
    calls_long,
    sample_dictionary,
    sparse_calls,
    vcf_fix,
    vcf_gt,
    vcf_meta,
)
from varlake.plans.vep import VepTables, gene_dimension
from varlake.sources.bgzf import read_bgzf, read_region, write_vcf
from varlake.sources.fixtures import (
    MIXED_FORMAT,
    VCF_HEADER,
    base_table,
    cohort_files,
    cohort_line,
    cohort_rows,
    fixture,
)
from varlake.sources.store import AnnotationStore, open_store, write_store
from varlake.sources.tables import write_result
from varlake.sources.versions import changes_between, open_version, write_version
from varlake.sources.vcf import (
    GENE_TAG_HEADER,
    PACKED_TEXT,
    output_header,
    read_vcf,
    split_header,
    vcf_records,
    vcf_schema,
)


def vcf_parts_input(spark: SparkSession, sf: str) -> DataFrame:
    """A cohort of split files: a folder for each sample, of part files of
    which only one has the header.  Headers differ in the sample's name and, in
    odd folders, in the order of the annotation's sub-fields."""
    def write(path: str) -> None:
        files = cohort_files(spark, sf)
        rows = []
        for k in range(files):
            for i, h in enumerate([*VCF_HEADER[:-1], VCF_HEADER[-1].replace("S1", f"S_{k}")]):
                if k % 2:
                    h = re.sub("Format: [^\"]+", f"Format: {MIXED_FORMAT}", h)
                rows.append((h, k, i))
        head = spark.createDataFrame(rows, "line string, part int, i int").coalesce(1)
        # Up to three part files of records a folder; the tasks grow in number with the folders.
        piece = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(3))
        body = cohort_rows(spark, sf, files).repartition(files, "part", piece)
        (head.sortWithinPartitions("part", "i").select("line", "part")
         .unionByName(body.select(cohort_line("fx_vcf_lines_mixed", files).alias("line"), "part"))
         .write.partitionBy("part").options(**PACKED_TEXT).text(path))

    return read_vcf(spark, _written_once(spark, sf, "vcf_parts", write))


@register("vcf_headerless_parts", _vcf_oracle(_TRANSCRIPT_SQL.format(
    name=f"concat('S_', CAST(o % {_FILES_SQL} AS VARCHAR))")))
def q_vcf_headerless_parts(spark, sf):
    """S2 and P6 on part files whose header is in another file of their folder."""
    lines = vcf_parts_input(spark, sf)
    return vcf_transcripts(lines, vcf_schema(lines, header_of="folder"))


# Columns of the result file that are compared: keys, text and all arrays.
_FILE_COLUMNS = [
    "chromosome", "reference", "alternate", "variant_id", "DBSNP_RSID", "VariationID", "clin_sig",
    "HGMD_DM", "HGMD_DM?", "OMIM_gene_id", "Orphanet_disorder_id_combined",
    "Orphanet_gene_source_of_validation_combined", "Orphanet_type_of_inheritance_combined",
    "GenCC_disease_curie_combined", "gene_group"]


def _as_written(columns: list[str]) -> str:
    return ", ".join(f"coalesce(CAST(\"{c}\" AS VARCHAR), '-') AS \"{c}\"" for c in columns)


@register("result_file_text", O.vep_pipeline(
    "vep", extra_fixtures=["fx_list_ecpg", "fx_list_emgp"],
    tail=_GG_TAIL.replace("\nSELECT * EXCLUDE", "\n, labelled AS (SELECT * EXCLUDE", 1)
    + f")\nSELECT {_as_written(_FILE_COLUMNS)} FROM labelled"))
def q_result_file_text(spark, sf):
    """K1 and K3 on the whole P4 result, read as the text that was written:
    missing values and missing arrays are ``-``, filled arrays comma text."""
    path = _round_trip(spark)
    result = stored_filter_vep(fixture(spark, sf, "fx_variants"), vep_tables(spark, sf))
    write_result(annotate_gene_group(
        result, fixture(spark, sf, "fx_list_ecpg"), fixture(spark, sf, "fx_list_emgp")), path)
    text = spark.read.option("sep", "\t").option("header", True).option("nullValue", "\x00").csv(path)
    assert set(KEY) <= set(text.columns)
    return text.select([F.col(f"`{c}`") for c in _FILE_COLUMNS])


# ------------------------------------------------------- block-compressed files
def vcf_bgzf_path(spark: SparkSession, sf: str) -> str:
    """The fixture VCF as block-compressed parts with a position index."""
    def write(path: str) -> None:
        lines = vcf_input(spark, sf)
        write_vcf(vcf_records(lines), output_header(vcf_schema(lines), added=()), path)

    return _written_once(spark, sf, "vcf_bgzf", write)


_RECORD = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]
_RECORD_SQL = (f"{_POS4}, '.' AS ID, '50' AS QUAL, filt AS FILTER, info AS INFO, "
               "'GT:AD:DP:GQ' AS FORMAT")


@register("vcf_bgzf_scan", _vcf_oracle(f"SELECT {_RECORD_SQL} FROM vl"))
def q_vcf_bgzf_scan(spark, sf):
    """S1 on block-compressed files, each read in ranges of 32 KB by many tasks."""
    lines = read_bgzf(spark, f"{vcf_bgzf_path(spark, sf)}/*.vcf.gz", split_bytes=32 << 10)
    return vcf_records(lines).select(_RECORD)


@register("vcf_region", _vcf_oracle(
    f"SELECT {_RECORD_SQL} FROM vl WHERE chrom = 'chr5' AND CAST(pos AS BIGINT) BETWEEN 5000 AND 60000"))
def q_vcf_region(spark, sf):
    """K5's index: the records of a region, read from the blocks it names."""
    return read_region(spark, vcf_bgzf_path(spark, sf), "chr5", 5000, 60000).select(_RECORD)


def _header_rows() -> str:
    quoted = [h.replace("'", "''") for h in [*VCF_HEADER[:-1], *GENE_TAG_HEADER, VCF_HEADER[-1]]]
    return ", ".join(f"('{q}')" for q in quoted)


@register("vcf_file_round_trip", _vcf_oracle(f"""
SELECT NULL AS header, {_POS4}, filt AS FILTER, {_TAG_SQL} AS INFO FROM vl WHERE {_QC_SQL} AND {_GOOD_SQL}
UNION ALL SELECT h, NULL, NULL, NULL, NULL, NULL, NULL
FROM (VALUES {_header_rows()}) AS t(h)"""))
def q_vcf_file_round_trip(spark, sf):
    """K5 and S3: the QC step's output as a VCF file (header with the keys of the
    gene tag, ``#CHROM`` line, sorted body), read again: header lines and records."""
    path = _round_trip(spark)
    lines = vcf_input(spark, sf)
    spec = vcf_schema(lines)
    write_vcf(vcf_qc_records(lines, spec), output_header(spec), path)
    back = read_vcf(spark, f"{path}/*.vcf.gz")
    columns = ["#CHROM", "POS", "REF", "ALT", "FILTER", "INFO"]
    meta, body = split_header(back)
    names = back.where(F.col("line").startswith("#CHROM"))
    header = meta.unionByName(names).select(
        F.col("line").alias("header"), *[F.lit(None).cast("string").alias(c) for c in columns])
    return vcf_records(body).select(F.lit(None).cast("string").alias("header"), *columns).unionByName(header)


# ------------------------------------------------------------ annotation store
# Tables of the VEP pipeline that are joined on the variant key.
STORE_TABLES = {"topmed": "fx_topmed", "dbnsfp": "fx_dbnsfp", "regeneron": "fx_regeneron",
                "allofus": "fx_allofus", "dbsnp": "fx_dbsnp", "intervar": "fx_intervar",
                "clinvar": "fx_clinvar", "hgmd_var": "fx_hgmd_var"}


BUCKET_ROWS = 4_000_000  # of the store's largest table


def annotation_store(spark: SparkSession, sf: str, buckets: int | None = None) -> AnnotationStore:
    """The fixture's key tables as a store, opened as another session would.  Its buckets
    grow in number with the tables, 8 at least: a bucket is one task's."""
    if buckets is None:
        buckets = max(8, -(-base_table(spark, sf, "lineitem").count() // BUCKET_ROWS))
    path = _written_once(spark, sf, f"store_{buckets}", lambda path: write_store(
        {k: fixture(spark, sf, v) for k, v in STORE_TABLES.items()}, path, buckets))
    return open_store(spark, path)


@register("filter_vep_store", O.vep_pipeline("vep"))
def q_filter_vep_store(spark, sf):
    """P1 over an annotation store (S5): bucketed key tables, of which only the
    variants' contigs are read and none is shuffled."""
    v = fixture(spark, sf, "fx_variants")
    tables = replace(vep_tables(spark, sf), **annotation_store(spark, sf).tables_for(v))
    return arrays_as_text(stored_filter_vep(v, tables, strategy="keys", sketch=False, limits=SHUFFLED))


@register("annotation_store_scan", O.with_(["fx_dbsnp"], [], "SELECT * FROM fx_dbsnp"))
def q_annotation_store_scan(spark, sf):
    """A table of the store, with every row that was written."""
    return annotation_store(spark, sf).table("dbsnp")


# ----------------------------------------------------- results as users get them
def _text_of(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` written by ``write_result`` and read as the text in the files."""
    path = _round_trip(spark)
    write_result(df, path)
    return spark.read.option("sep", "\t").option("header", True).option("nullValue", "\x00").csv(path)


_GOI_COLUMNS = ["chromosome", "reference", "alternate", "variant_id", "CSQ_SYMBOL", "clin_sig",
                "HGMD_DM", "Germline_GOIs_names", "entrez", "ensembl", "gene_desc"]


@register("goi_result_file", O.vep_pipeline(
    "vep", extra_fixtures=["fx_list_goi"],
    tail=_GOI_TAIL.replace("\nSELECT * EXCLUDE", "\n, listed AS (SELECT * EXCLUDE", 1)
    + f")\nSELECT {_as_written(_GOI_COLUMNS)} FROM listed"))
def q_goi_result_file(spark, sf):
    """K4: the P5 result as text, list columns appended."""
    p1 = stored_filter_vep(fixture(spark, sf, "fx_variants"), vep_tables(spark, sf))
    goi = fixture(spark, sf, "fx_list_goi").select(
        F.col("symbol").alias("Germline_GOIs_names"), F.col("ncbi").alias("entrez"),
        "ensembl", "gene_desc", F.monotonically_increasing_id().alias("line_no"))
    return _text_of(spark, attach_gene_list(p1, goi)).select(_GOI_COLUMNS)


_P0_SQL = f"""SELECT * FROM (SELECT {_POS4}, {_INFO_SQL}, {_PICK_SQL}, {_GT_SQL} AS S1_AdjustedGenotype
 FROM vl WHERE {_QC_SQL} AND {_GOOD_SQL} AND alt <> '*')
WHERE S1_AdjustedGenotype NOT IN ('./.', '0/0')"""
_P0_COLUMNS = ["#CHROM", "POS", "REF", "ALT", "INFO_QD", "INFO_FS", "INFO_MQ", "CSQ_Allele",
               "CSQ_Consequence", "CSQ_PICK", "CSQ_SYMBOL", "CSQ_Feature", "S1_AdjustedGenotype"]


@register("flat_table_file", _vcf_oracle(f"SELECT {_as_written(_P0_COLUMNS)} FROM ({_P0_SQL})"))
def q_flat_table_file(spark, sf):
    """K6: the flattened table of P0 as text."""
    return _text_of(spark, vcf_to_table(vcf_input(spark, sf))).select(_P0_COLUMNS)


_P6_COLUMNS = ["chromosome", "start", "reference", "alternate", "INFO_MQ", "Consequence", "PICK",
               "SYMBOL", "Feature", "Indiv", "gt_GT", "gt_AD"]


@register("tidy_table_file", _vcf_oracle(
    f"SELECT {_as_written(_P6_COLUMNS)} FROM ({_TRANSCRIPT_SQL.format(name=chr(39) + 'S1' + chr(39))})"))
def q_tidy_table_file(spark, sf):
    """K7: the tidy table of P6 as text."""
    return _text_of(spark, vcf_transcripts(vcf_input(spark, sf))).select(_P6_COLUMNS)


def _without(sql: str) -> str:
    """The P1 statement with ClinVar, dbSNP and InterVar empty."""
    for old, new in ((" FROM fx_clinvar\n WHERE ", " FROM fx_clinvar\n WHERE false AND "),
                     ("AS num FROM fx_dbsnp)", "AS num FROM fx_dbsnp WHERE false)"),
                     ("LEFT JOIN fx_intervar iv", "LEFT JOIN (SELECT * FROM fx_intervar WHERE false) iv")):
        assert old in sql, old
        sql = sql.replace(old, new)
    return sql


@register("filter_vep_few_sources", _without(O.vep_pipeline("vep")))
def q_filter_vep_few_sources(spark, sf):
    """P1 with ClinVar, dbSNP and InterVar switched off; their columns are
    there and NULL."""
    tables = replace(vep_tables(spark, sf), dbsnp=None, intervar=None)
    return arrays_as_text(stored_filter_vep(fixture(spark, sf, "fx_variants"), tables,
                                     known_variants=("hgmd",)))


@register("existence_probe", O.with_(["fx_variants"], [], """
SELECT chromosome, CAST(count(*) FILTER (WHERE CSQ_Consequence = 'stop_gained') > 0 AS BOOLEAN) AS stops,
 CAST(false AS BOOLEAN) AS nowhere
FROM fx_variants GROUP BY chromosome"""))
def q_existence_probe(spark, sf):
    """O3: whether a chromosome has variants of a kind, by a first row each."""
    v = fixture(spark, sf, "fx_variants")
    stops = v.where(F.col("CSQ_Consequence") == "stop_gained")
    rows = [(c, has_rows(stops.where(F.col("chromosome") == c)), has_rows(v.where(
        (F.col("chromosome") == c) & (F.col("start") < 0))))
        for c in sorted(r[0] for r in v.select("chromosome").distinct().collect())]
    return spark.createDataFrame(rows, "chromosome string, stops boolean, nowhere boolean")


# -------------------------------------------------------------------- tidy tables
def _meta_sql() -> str:
    rows = []
    for h in VCF_HEADER:
        m = re.match(r'##(INFO|FORMAT)=<ID=(\w+),Number=(.),Type=(\w+),Description="(.*)">', h)
        if m:
            rows.append("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in m.groups()) + ")")
    return ", ".join(rows)


@register("vcf_tidy_meta", f"""
SELECT CAST(f AS INTEGER) AS part, Tag, ID, Number, Type, Description
FROM (VALUES {_meta_sql()}) AS t(Tag, ID, Number, Type, Description), range({_FILES_SQL}) AS r(f)""")
def q_vcf_tidy_meta(spark, sf):
    """The definitions of every file of a cohort."""
    meta = vcf_meta(vcf_cohort_input(spark, sf))
    part = F.regexp_extract("file", "part=([0-9]+)/", 1).cast("int").alias("part")
    return meta.select(part, "Tag", "ID", "Number", "Type", "Description")


_CHROM_KEY = "dense_rank() OVER (ORDER BY CASE WHEN p % 25 = 24 THEN 100 ELSE p % 25 END)"


@register("vcf_tidy_fix", _vcf_oracle(f"""
SELECT CAST({_CHROM_KEY} AS INTEGER) AS ChromKey, chrom AS CHROM, CAST(pos AS BIGINT) AS POS, NULL AS ID,
 ref AS REF, alt AS ALT, 50::DOUBLE AS QUAL, filt AS FILTER, CAST(s % 10 AS VARCHAR) AS QD,
 CASE WHEN ln = 3 THEN NULL ELSE '60' END AS MQ, ln = 4 AS targeted,
 CAST(3 + CAST(ln <> 3 AS INTEGER) + CAST(ln = 4 AS INTEGER) AS INTEGER) AS n_keys FROM vl"""))
def q_vcf_tidy_fix(spark, sf):
    """A row for each record, INFO as a map of whatever keys it has."""
    fix = vcf_fix(vcf_input(spark, sf))
    return fix.select("ChromKey", "CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER",
                      F.col("INFO")["QD"].alias("QD"), F.col("INFO")["MQ"].alias("MQ"),
                      F.map_contains_key("INFO", F.lit("TARGETED")).alias("targeted"),
                      F.size("INFO").alias("n_keys"))


_JOINT = f"""
, g AS (
 SELECT *, 'A_' AS who, concat(CAST(q AS VARCHAR), ',', CAST(3 * ln AS VARCHAR)) AS ad, q AS r0, 3 * ln AS r1,
  o % 99 AS gq FROM vl
 UNION ALL SELECT *, 'B_', concat('9,', CAST(p % 30 AS VARCHAR)), 9, p % 30, s % 50 FROM vl)
, called AS (SELECT *, concat(who, CAST(o % {_FILES_SQL} AS VARCHAR)) AS sample,
 CASE WHEN r1 / (r0 + r1) >= 0.8::DOUBLE THEN '1/1' WHEN r1 / (r0 + r1) >= 1 - 0.8::DOUBLE THEN '0/1' ELSE '0/0' END
  AS genotype FROM g)"""


@register("vcf_tidy_gt", _vcf_oracle(_JOINT + f"""
SELECT CAST({_CHROM_KEY} AS INTEGER) AS ChromKey, CAST(pos AS BIGINT) AS POS, ref AS REF, alt AS ALT,
 sample AS Indiv, '0/1' AS gt_GT, ad AS gt_AD, CAST(r0 + r1 AS VARCHAR) AS gt_DP, CAST(gq AS VARCHAR) AS gt_GQ
FROM called"""))
def q_vcf_tidy_gt(spark, sf):
    """A row for each record and sample of joint files, values as a map."""
    gt = vcf_gt(vcf_cohort_input(spark, sf, "fx_vcf_lines_joint", ("A_", "B_")))
    return gt.select("ChromKey", "POS", "REF", "ALT", "Indiv",
                     *[F.col("gt")[k].alias(f"gt_{k}") for k in ("GT", "AD", "DP", "GQ")])


@register("vcf_sparse_calls", _vcf_oracle(_JOINT + """
SELECT chrom AS "#CHROM", pos AS POS, ref AS REF, alt AS ALT, sample, genotype,
 CAST(r0 + r1 AS INTEGER) AS depth, CAST(gq AS DOUBLE) AS quality
FROM called WHERE genotype <> '0/0'"""))
def q_vcf_sparse_calls(spark, sf):
    """P0's calls of joint files as sparse arrays, and back to a row each."""
    lines = vcf_cohort_input(spark, sf, "fx_vcf_lines_joint", ("A_", "B_"))
    spec = vcf_schema(lines)
    long = calls_long(sparse_calls(lines, spec), sample_dictionary(lines, spec))
    return long.select("#CHROM", "POS", "REF", "ALT", "sample", "genotype", "depth", "quality")


# ----------------------------------------------------------- versions of annotation
def older_tables(tables: VepTables) -> VepTables:
    """An earlier version of the derived tables: other values, fewer rows, other
    rows, in key tables and in gene tables."""
    def nth(column: str, n: int):
        return F.pmod(F.xxhash64(column), F.lit(n)) == 0

    return replace(
        tables,
        topmed=tables.topmed.withColumn("af", F.when(nth("start", 50), F.col("af") / 2).otherwise(F.col("af"))),
        dbsnp=tables.dbsnp.where(~nth("name", 40)),
        clinvar=tables.clinvar.withColumn("name", F.when(
            nth("name", 30), F.concat("name", F.lit("x"))).otherwise(F.col("name"))),
        gencc=tables.gencc.where(~nth("disease_curie", 25)),
        omim_gene=tables.omim_gene.where(~nth("omim_gene_id", 25)),
        orphanet_gene=tables.orphanet_gene.where(~nth("disorder_id", 25)),
    )


@register("reannotate_changed", O.vep_pipeline("vep"))
def q_reannotate_changed(spark, sf):
    """P1 brought from an earlier version of the tables to the current one: only
    variants with a changed key or gene are worked out again."""
    v, new = fixture(spark, sf, "fx_variants"), vep_tables(spark, sf)
    old = older_tables(new)
    before = written(stored_filter_vep(v, old, sort=False))
    return arrays_as_text(reannotate(before, v, old, new))


@register("annotation_versions", O.with_(["fx_dbsnp", "fx_topmed"], [], """
SELECT 'v1' AS what, chromosome, start, reference, alternate, name FROM fx_dbsnp WHERE start % 7 <> 0
UNION ALL SELECT 'v2', chromosome, start, reference, alternate, name FROM fx_dbsnp
UNION ALL SELECT DISTINCT 'changed in dbsnp', chromosome, start, reference, alternate, CAST(NULL AS VARCHAR)
 FROM fx_dbsnp WHERE start % 7 = 0 AND chromosome IS NOT NULL AND reference IS NOT NULL AND alternate IS NOT NULL
UNION ALL SELECT DISTINCT 'changed in topmed', chromosome, start, reference, alternate, CAST(NULL AS VARCHAR)
 FROM fx_topmed WHERE start % 11 = 0 AND af > 0"""))
def q_annotation_versions(spark, sf):
    """Two versions of a store, both readable, and the keys that differ."""
    path, dbsnp, topmed = _round_trip(spark), fixture(spark, sf, "fx_dbsnp"), fixture(spark, sf, "fx_topmed")
    half = topmed.withColumn("af", F.when(F.col("start") % 11 == 0, F.col("af") / 2).otherwise(F.col("af")))
    write_version({"dbsnp": dbsnp.where(F.col("start") % 7 != 0), "topmed": half}, path, 4)
    write_version({"dbsnp": dbsnp, "topmed": topmed}, path, 4)
    rows = [open_version(spark, path, v).table("dbsnp").select(F.lit(f"v{v}").alias("what"), *KEY, "name")
            for v in (1, 2)]
    changed = changes_between(spark, path, 1, 2).select(
        F.concat(F.lit("changed in "), "table").alias("what"), *KEY, F.lit(None).cast("string").alias("name"))
    return rows[0].unionByName(rows[1]).unionByName(changed)


# --------------------------------------------------------------- the gene dimension
_GENE_OUT = ["CSQ_HGNC_ID", "CSQ_Gene", "entrez_gene_id", "hgnc", "HGMD_DM", "HGMD_DM?", "CGC_Tier",
             "CGC_Mutation_Types", "OMIM_gene_id", "OMIM_phenotype_combined",
             "Orphanet_disorder_id_combined", "Orphanet_gene_source_of_validation_combined",
             "Orphanet_HGNC_gene_id", "Orphanet_type_of_inheritance_combined",
             "GenCC_disease_curie_combined", "GenCC_disease_title_combined",
             "GenCC_classification_title_combined", "GenCC_moi_title_combined"]
_GENE_LIST = ", ".join(f'"{c}"' for c in _GENE_OUT)


@register("gene_dimension", O.vep_pipeline("vep", tail=f"SELECT DISTINCT {_GENE_LIST} FROM p1"))
def q_gene_dimension(spark, sf):
    """All gene tables' columns for each pair of gene ids that
    variants have."""
    v = keep_consequences(fixture(spark, sf, "fx_variants"))
    return arrays_as_text(gene_dimension(v, vep_tables(spark, sf))).select(
        [F.col(f"`{c}`") for c in _GENE_OUT])


@register("filter_vep_genes_once", O.vep_pipeline("vep"))
def q_filter_vep_genes_once(spark, sf):
    """P1 with the gene tables looked up for each pair of gene ids and joined once."""
    return arrays_as_text(stored_filter_vep(
        fixture(spark, sf, "fx_variants"), vep_tables(spark, sf), genes_once=True))
