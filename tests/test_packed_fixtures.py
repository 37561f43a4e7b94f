"""The derived VCF files: the lines of their fixture, packed, by tasks whose number
grows with the files."""

import os
import re

from pyspark.sql import functions as F

from varlake.plans import catalog, catalog_files


def _lineitem(spark, path):
    rows = [(o, p, s, n, float(5 + n), "ANR"[o % 3] if o % 5 else None)
            for o, p, s, n in ((i // 3, i % 40, i % 10, 1 + i % 7) for i in range(400))]
    rows += [(7, None, 3, 1, 9.0, "A"), (7, 5, None, None, None, None)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                                "l_quantity double, l_returnflag string").write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def _lines(df):
    return sorted(r["line"] for r in df.where(~F.col("line").startswith("#")).select("line").collect())


def test_written_lines_are_those_of_the_fixture(spark, tmp_path, monkeypatch):
    sf = _lineitem(spark, tmp_path)
    for module in (catalog, catalog_files):
        monkeypatch.setattr(module, "cohort_files", lambda *a: 12)
    monkeypatch.setattr("varlake.sources.fixtures.cohort_files", lambda *a: 12)
    inputs = {
        "fx_vcf_lines": catalog.vcf_input(spark, sf),
        "fx_vcf_lines_cohort": catalog.vcf_cohort_input(spark, sf),
        "fx_vcf_lines_joint": catalog.vcf_cohort_input(spark, sf, "fx_vcf_lines_joint", ("A_", "B_")),
        "fx_vcf_lines_mixed": catalog_files.vcf_parts_input(spark, sf),
    }
    for name, lines in inputs.items():
        assert _lines(lines) == _lines(catalog.fixture(spark, sf, name)), name
        files = [r["file"] for r in lines.select("file").distinct().collect()]
        assert all(f.endswith(".gz") for f in files), name
    one = inputs["fx_vcf_lines_cohort"].groupBy("file").agg(
        F.sum(F.col("line").startswith("#CHROM").cast("int")).alias("n")).collect()
    assert len(one) == 12 and {r["n"] for r in one} == {1}


def test_part_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """Not by three tasks that sort a third of the records each."""
    sf = _lineitem(spark, tmp_path)
    for module in (catalog, catalog_files):
        monkeypatch.setattr(module, "cohort_files", lambda *a: 12)
    lines = catalog_files.vcf_parts_input(spark, sf).where(~F.col("line").startswith("#"))
    names = {os.path.basename(r["file"]) for r in lines.select("file").distinct().collect()}
    assert len({re.match(r"part-(\d+)", n)[1] for n in names}) > 6
