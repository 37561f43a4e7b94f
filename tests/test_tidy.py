"""Tidy tables hold any header; sparse calls name the carriers."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from varlake.plans.catalog import arrays_as_text, fixture, vep_tables
from varlake.plans.vcf_tidy import (
    calls_long,
    info_map,
    sample_dictionary,
    sparse_calls,
    vcf_fix,
    vcf_gt,
    vcf_meta,
)
from varlake.plans.vep import filter_vep
from varlake.sources.vcf import read_vcf
from dataclasses import replace

META = ['##INFO=<ID=QD,Number=1,Type=Float,Description="a, \\"quoted\\" > text">', '##INFO=<ID=DB,Number=0,Type=Flag>',
        '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">', '##FILTER=<ID=q10,Description="x">']
FIXED = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]


def write(path, samples, records):
    with open(path, "w") as f:
        f.write("\n".join([*META, "\t".join([*FIXED, *samples]), *map("\t".join, records)]) + "\n")


def test_info_of_any_form(spark):
    cases = {".": {}, "": {}, None: None, "DB": {"DB": None}, "QD=5;DB;X=": {"QD": "5", "DB": None, "X": ""},
             "A=1;A=2;B=x=y;;.": {"A": "1", "B": "x=y"}}
    df = spark.createDataFrame([(k,) for k in cases], "INFO string")
    got = {r["INFO"]: r["m"] for r in df.select("INFO", info_map().alias("m")).collect()}
    assert got == cases


def test_meta_fix_and_gt_of_files_that_differ(spark, tmp_path):
    rec = ["chr2", "7", ".", "A", "C", ".", ".", "QD=1", "GT:DP:DP"]
    write(tmp_path / "a.vcf", ["S1", "S2"], [[*rec, "0/1:9:8", "."], ["chrX", "5", "rs1", "A", "C", "9.5", "PASS", ".", "GT", "1/1", "0/0"]])
    write(tmp_path / "b.vcf", ["S3"], [["chr2", "7", "id", "A", "T", "1", "q10", "DB", "GT", "./."]])
    write(tmp_path / "c.vcf", [], [["GL1", "7", "id", "A", "T", "1", "q10", "DB"]])
    lines = read_vcf(spark, os.path.join(str(tmp_path), "*.vcf"))
    meta = vcf_meta(lines).where(F.col("file").endswith("a.vcf")).drop("file").collect()
    assert sorted(tuple(r) for r in meta) == sorted([
        ("INFO", "QD", "1", "Float", 'a, \\"quoted\\" > text'), ("INFO", "DB", "0", "Flag", None),
        ("FORMAT", "GT", "1", "String", "g")])
    fix = {(r["CHROM"], r["ALT"]): r for r in vcf_fix(lines).collect()}
    assert len(fix) == 4 and {c: r["ChromKey"] for (c, _), r in fix.items()} == {"chr2": 1, "chrX": 2, "GL1": 3}
    assert (fix["chr2", "C"]["ID"], fix["chr2", "C"]["QUAL"], fix["chr2", "C"]["FILTER"]) == (None, None, None)
    assert fix["chrX", "C"]["QUAL"] == 9.5 and fix["chrX", "C"]["INFO"] == {}
    gt = {(r["Indiv"], r["ChromKey"]): r["gt"] for r in vcf_gt(lines).collect()}
    assert gt == {("S1", 1): {"GT": "0/1", "DP": "9"}, ("S2", 1): {"GT": None, "DP": None},
                  ("S1", 2): {"GT": "1/1"}, ("S2", 2): {"GT": "0/0"}, ("S3", 1): {"GT": "./."}}


def test_sparse_calls_are_the_carriers_whatever_the_number_of_samples(spark, tmp_path):
    sizes = {}
    for n in (3, 400):
        names = [f"N{i}" for i in range(n)]
        records = [["chr1", str(p), ".", "A", "C", "50", "PASS", "DB", "GT:AD:DP:GQ",
                    *("0/1:5,5:10:30" if i % 100 == p else "0/0:10,0:10:40" if i % 2 else "./.:.:.:."
                      for i in range(n))] for p in range(1, 4)]
        path = str(tmp_path / f"{n}.vcf")
        write(path, names, records)
        lines = read_vcf(spark, path)
        sparse = sparse_calls(lines)
        got = sorted((int(r["POS"]), r["sample"], r["genotype"], r["depth"], r["quality"])
                     for r in calls_long(sparse, sample_dictionary(lines)).collect())
        assert got == sorted((p, f"N{i}", "0/1", 10, 30.0) for p in range(1, 4) for i in range(p, n, 100))
        assert sparse.count() == 3
        plan = sparse._jdf.queryExecution().analyzed().toString()
        sizes[n] = (len(plan) - plan.count("N") * 4, len(sparse.columns))
    assert sizes[400][0] < 1.5 * sizes[3][0] and sizes[400][1] == sizes[3][1]


def test_each_source_can_be_off(spark):
    """a table that is off gives the same rows with its columns NULL."""
    v = fixture(spark, SF_SMALL, "fx_variants").limit(300)
    every = vep_tables(spark, SF_SMALL)
    full = arrays_as_text(filter_vep(v, every, sort=False))
    for off, columns in (("dbsnp", ["DBSNP_RSID"]), ("intervar", ["InterVar_automated"]),
                         ("clinvar", ["VariationID", "clin_sig"]), ("hgmd_var", ["HGMDID", "variant_class"])):
        df = arrays_as_text(filter_vep(v, replace(every, **{off: None}), sort=False))
        assert df.columns == full.columns
        rows = df.collect()
        assert rows and all(r[c] is None for r in rows for c in columns)
        skip = {*columns, "flag_keep"}
        key = lambda r: str([r[c] for c in full.columns if c not in skip])
        assert sorted(map(key, rows)) == sorted(map(key, full.collect()))
