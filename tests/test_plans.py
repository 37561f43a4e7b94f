"""Plan-level guards for the flagship pipeline: no nested-loop or cartesian
join anywhere, and every scan of the part-derived annotation tables reads
only the columns it needs."""

import re

from conftest import SF_SMALL
from varlake.plans import catalog


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_vep_pipeline_plan(spark):
    df = catalog.q_filter_vep(spark, SF_SMALL)
    plan = _plan(df)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    part_scans = [s for s in schemas if "p_partkey" in s]
    assert part_scans and all(set(x.split(":")[0] for x in s.split(",")) <= {"p_partkey", "p_size"}
                              for s in part_scans)
    lineitem_scans = [s for s in schemas if "l_orderkey" in s or "l_partkey" in s]
    assert lineitem_scans and all("l_comment" not in s and "l_shipdate" not in s
                                  for s in lineitem_scans)


def test_dbsnp_is_read_once_and_pruned(spark):
    plan = _plan(catalog.q_dbsnp_smallest(spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert [{x.split(":")[0] for x in s.split(",")} for s in schemas] == [{"l_orderkey", "l_partkey"}]


def test_dbsnp_is_reduced_before_it_is_shuffled(spark):
    """With bounded variants the broadcast semi-join lies below the
    aggregation of the genome-wide table."""
    plan = _plan(catalog.q_annotate_population_freqs(spark, SF_SMALL))
    names = plan[:plan.index("collect_set(name")]
    assert "LeftSemi" in plan[len(names):]


def test_no_wide_distinct(spark):
    """No exchange or aggregate key on an annotation column of the result."""
    plan = _plan(catalog.q_filter_vep(spark, SF_SMALL))
    for keys in re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", plan):
        assert "GenCC_disease_title_combined" not in keys


def test_fallback_plan_is_linear(spark):
    """All bounds at 0: at most twice the scans of the default plan."""
    import time

    from varlake.config import Limits
    from varlake.plans.vep import filter_vep
    from varlake.sources.fixtures import fixture

    v = fixture(spark, SF_SMALL, "fx_variants")
    t = catalog.vep_tables(spark, SF_SMALL)
    scans = lambda df: len(re.findall(r"FileScan parquet", _plan(df)))
    default = scans(filter_vep(v, t))
    began = time.perf_counter()
    forced = scans(filter_vep(v, t, limits=Limits(
        max_broadcast_rows=0, max_variant_rows=0, hot_key_rows=20)))
    assert forced <= 2 * default
    assert time.perf_counter() - began < 60


def test_rows_without_a_key_are_spread(spark):
    """90 % NULL keys, no adaptive execution: no partition holds over twice
    the mean."""
    from pyspark.sql import functions as F

    from varlake.config import Limits
    from varlake.operators.joins import left_join_lookup

    left = spark.range(200_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"), "id")
    right = spark.range(0, 200_000, 20).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = left_join_lookup(left, right, ["k"], try_broadcast=False,
                               limits=Limits(max_broadcast_rows=0))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 200_000 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_vep_pipeline_all_shuffle_paths_agree(spark):
    """With every bound forced to fail (no broadcast, all keys 'hot'), the
    pipeline takes the cohort paths - distinct keys, salted lookups, tuple
    OR-join - and must return exactly the default plan's rows."""
    from varlake.config import Limits
    from varlake.plans.vep import filter_vep
    from varlake.sources.fixtures import fixture

    forced = Limits(max_broadcast_rows=0, max_variant_rows=0, hot_key_rows=20)
    v = fixture(spark, SF_SMALL, "fx_variants")
    t = catalog.vep_tables(spark, SF_SMALL)
    a = catalog.arrays_as_text(filter_vep(v, t, sort=False))
    b = catalog.arrays_as_text(filter_vep(v, t, sort=False, limits=forced))
    key = lambda df: sorted(tuple(str(x) for x in r) for r in df.collect())
    ra, rb = key(a), key(b)
    assert len(ra) > 0 and ra == rb


def test_headers_are_read_without_scanning_the_text(spark):
    """The header frame lists the files and opens their heads; it holds no
    scan of their text and not their content."""
    from varlake.sources.vcf import header_lines

    plan = _plan(header_lines(catalog.vcf_cohort_input(spark, SF_SMALL)))
    assert "Format: Text" not in plan and "FileScan binaryFile" in plan
    assert "ReadSchema: struct<>" in plan


def test_header_lines_of_files_and_of_rows_agree(spark, tmp_path):
    import gzip

    from varlake.sources.vcf import header_lines, read_vcf

    text = "##a\r\n\r\n##INFO=<ID=X,>\n#CHROM\tPOS\nchr1\t5\n#late\n"
    (tmp_path / "one two.vcf").write_text(text, newline="")
    with gzip.open(tmp_path / "b.vcf.gz", "wt", newline="") as f:
        f.write(text)
    (tmp_path / "c.vcf").write_text("")
    lines = read_vcf(spark, str(tmp_path))
    heads = sorted(tuple(r) for r in header_lines(lines).collect())
    rows = sorted(tuple(r) for r in header_lines(lines.where("line <> '#late'")).collect())
    assert heads == rows and len(heads) == 6


def test_records_without_samples_keep_their_transcripts(spark):
    from varlake.plans.vcf_table import vcf_to_table, vcf_transcripts
    from varlake.sources.vcf import vcf_lines

    header = ['##INFO=<ID=CSQ,Number=.,Type=String,Description="x Format: Allele|PICK|Feature">',
              '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">',
              "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1"]
    body = ["chr1\t1\t.\tA\tC\t50\tPASS\tCSQ=C|1|ENST1\tGT\t0/1", "chr1\t2\t.\tA\tC\t50\tPASS\tCSQ=C|1|ENST2"]
    lines = vcf_lines(spark.createDataFrame([(x,) for x in header + body], "line string"))
    got = sorted((r["start"], r["Indiv"], r["gt_GT"]) for r in vcf_transcripts(lines).collect())
    assert got[0] == (1, "S1", "0/1") and got[1][0] == 2 and got[1][2] is None
    long = vcf_to_table(lines, qc=False, layout="long").collect()
    assert sorted(r["POS"] for r in long) == ["1", "2"]


def test_a_missing_input_column_is_an_error(spark):
    import pytest

    from varlake.plans.vep import filter_vep
    from varlake.sources.fixtures import fixture

    v = fixture(spark, SF_SMALL, "fx_variants").drop("CSQ_gnomAD_AF")
    t = catalog.vep_tables(spark, SF_SMALL)
    with pytest.raises(ValueError, match="CSQ_gnomAD_AF"):
        filter_vep(v, t)
    assert "CSQ_gnomAD_AF" in filter_vep(v, t, optional_columns=["CSQ_gnomAD_AF"]).columns


def test_a_hot_variant_key_is_split_when_tables_are_reduced(spark):
    """Half of the variants at one position and others without one, no
    adaptive execution: rows equal the plain joins' and no partition is hot."""
    from pyspark.sql import functions as F

    from varlake.config import Limits
    from varlake.operators.joins import annotate_by_key

    where = F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 5 > 0, F.col("id"))
    v = spark.range(40_000).select(F.lit("1").alias("chromosome"), where.alias("start"),
                                   F.lit("A").alias("reference"), F.lit("C").alias("alternate"), "id")
    table = spark.range(0, 40_000).where("id % 7 = 0").select(
        F.lit("1").alias("chromosome"), F.col("id").alias("start"), F.lit("A").alias("reference"),
        F.lit("C").alias("alternate"), (F.col("id") * 2).alias("value"))
    plain = sorted(map(str, annotate_by_key(v, [table], strategy="plain").collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = annotate_by_key(v, [table], strategy="reduce", limits=Limits(hot_key_rows=500))
        assert out.columns == [*v.columns, "value"]
        assert sorted(map(str, out.collect())) == plain
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2 * sum(sizes) / len(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
