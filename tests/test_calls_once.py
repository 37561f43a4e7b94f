"""A joint record's calls are taken apart once, however many values are read of them."""

from pyspark.sql import functions as F

from varlake.functions.vcf import adjusted_genotype, format_value
from varlake.plans.vcf_tidy import sparse_calls, vcf_gt
from varlake.sources.vcf import read_vcf

HEADER = ["##fileformat=VCFv4.2", '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">',
          "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "A", "B"])]
CALLS = [(".", "."), ("GT:AD:DP:GQ", "."), ("GT:AD:DP:GQ", "0/1:1,9:10:5"), ("GT:AD:DP:GQ", "0/1:5,5:.:."),
         ("GT:AD:DP:GQ", "0/1:5,5:10"), ("GT:AD:DP:GQ", "0/1:0,0:1:1"), ("GT:AD:DP:GQ", "1/2:1,2,3:6:7.5"),
         ("GT:AD:DP:GQ", "0/1:x,5:10:9"), ("GT:DP", "0/1:3"), ("GQ:AD", "4:0,3"), ("GT:GT:AD", "0/1:1/1:."),
         ("DP:AD:DP", "3:9,9:7"), ("GT", ""), ("GT:AD:DP:GQ", "0/0:50,1:51:9:extra")]


def lines_of(spark, tmp_path):
    records = ["\t".join(["chr1", str(i), ".", "A", "C", ".", ".", ".", fmt, call, "0/1:2,2:4:3"])
               for i, (fmt, call) in enumerate(CALLS)]
    (tmp_path / "joint.vcf").write_text("\n".join([*HEADER, *records]) + "\n")
    return read_vcf(spark, str(tmp_path / "joint.vcf"))


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sparse_calls_of_odd_samples(spark, tmp_path):
    got = {(int(r["POS"]), c["index"]): (c["genotype"], c["depth"], c["quality"])
           for r in sparse_calls(lines_of(spark, tmp_path)).collect() for c in r["calls"]}
    rows = [(i, k, fmt, s) for i, (fmt, call) in enumerate(CALLS) for k, s in enumerate((call, "0/1:2,2:4:3"))]
    f, s = F.col("f"), F.col("s")
    one = spark.createDataFrame(rows, "i int, k int, f string, s string").select(
        "i", "k", adjusted_genotype(f, s).alias("genotype"),
        format_value(f, s, "DP").try_cast("double").cast("int").alias("depth"),
        format_value(f, s, "GQ").try_cast("double").alias("quality"))
    assert got == {(r["i"], r["k"]): (r["genotype"], r["depth"], r["quality"]) for r in one.collect()
                   if r["genotype"] not in (None, "./.", "0/0")}


def test_sparse_calls_split_a_sample_once(spark, tmp_path):
    df = sparse_calls(lines_of(spark, tmp_path)).select("POS", F.inline("calls"))
    plan = optimized(df)
    assert plan.count(", :, -1)") == 2  # FORMAT, and a sample
    assert plan.count("try_cast") == 4  # two allele depths, DP and GQ


def test_gt_splits_a_call_once(spark, tmp_path):
    lines = lines_of(spark, tmp_path)
    plan = optimized(vcf_gt(lines))
    assert plan.count(", :, -1)") == 2
    got = {(r["POS"], r["Indiv"]): r["gt"] for r in vcf_gt(lines).collect()}
    for i, (fmt, call) in enumerate(CALLS):
        want, values = {}, call.split(":")
        for k, key in enumerate(fmt.split(":")):
            want.setdefault(key, None if k >= len(values) or values[k] == "." else values[k])
        assert got[i, "A"] == want


def test_contigs_are_found_once(spark, tmp_path):
    plan = optimized(vcf_gt(lines_of(spark, tmp_path)))
    assert plan.count(" text") == 1  # the records; the contigs' numbers are written
