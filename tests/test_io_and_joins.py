"""Write-then-read tests for sources and sinks, and metamorphic join checks:
every physical plan of a join gives the same rows."""

import gzip
import glob
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from varlake.config import Limits
from varlake.functions.keys import KEY
from varlake.operators.aggregates import orphanet_by_gene
from varlake.operators.filters import keep_consequences
from varlake.operators.genes import attach_orphanet
from varlake.operators.joins import annotate_by_key, left_join_any, left_join_lookup, project_annotation
from varlake.operators.ordering import chromosome_order
from varlake.sources.fixtures import fixture
from varlake.sources.tables import (
    read_annotation,
    read_gene_panel,
    read_goi_list,
    read_variant_tsv,
    write_result,
    write_vcf_body,
)
from varlake.sources.vcf import read_vcf, vcf_records

TINY = Limits(max_broadcast_rows=0, max_variant_rows=0, hot_key_rows=2)


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_write_result_roundtrip(spark, tmp_out):
    df = spark.createDataFrame(
        [("2", 5, None, ["a", "b"]), ("1", 7, "-x", [])],
        "chromosome string, start long, v string, arr array<string>")
    path = os.path.join(tmp_out, "res")
    write_result(chromosome_order(df), path, single_file=True)
    files = glob.glob(path + "/part-*.csv.gz")
    assert len(files) == 1
    text = gzip.open(files[0], "rt").read().splitlines()
    assert text[0].split("\t") == ["chromosome", "start", "v", "arr"]
    assert text[1].split("\t") == ["1", "7", "-x", ""]
    assert text[2].split("\t") == ["2", "5", "-", "a,b"]
    back = read_variant_tsv(spark, path)
    got = {r["chromosome"]: r["v"] for r in back.collect()}
    assert got == {"1": "-x", "2": None}


def test_vcf_body_roundtrip(spark, tmp_out):
    src = os.path.join(tmp_out, "in.vcf")
    with open(src, "w") as fh:
        fh.write("##fileformat=VCFv4.2\r\n")
        fh.write("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\r\n")
        fh.write("chr1\t10\t.\tA\tC\t50\tPASS\tAF=0.1\tGT\t0/1\r\n")
    recs = vcf_records(read_vcf(spark, src))
    assert recs.collect()[0]["sample1"] == "0/1"  # CR stripped by the text reader
    out = os.path.join(tmp_out, "out")
    write_vcf_body(recs, out)
    back = spark.read.text(out).collect()
    assert back[0][0] == "chr1\t10\t.\tA\tC\t50\tPASS\tAF=0.1\tGT\t0/1"


def test_gzip_vcf_and_mixed_headers(spark, tmp_out):
    from varlake.plans.vcf_table import vcf_to_table
    from varlake.sources.vcf import vcf_schema
    import pytest
    head = ['##INFO=<ID=CSQ,Number=.,Type=String,Description="x Format: Allele|PICK|SYMBOL">',
            '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">']
    for name, sample in (("a", "NA1"), ("b", "NA2")):
        with gzip.open(os.path.join(tmp_out, f"{name}.vcf.gz"), "wt") as fh:
            fh.write("\n".join(head + ["\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER",
                                                     "INFO", "FORMAT", sample]),
                                       "\t".join(["chr1", "5", ".", "A", "C", "50", "PASS",
                                                   "CSQ=C|1|G", "GT", "0/1"])]) + "\n")
    lines = read_vcf(spark, os.path.join(tmp_out, "*.vcf.gz"))
    spec = vcf_schema(lines)
    assert not spec.uniform_samples and sorted(spec.samples) == ["NA1", "NA2"]
    out = vcf_to_table(lines, spec, qc=False, layout="long")
    assert sorted(r["sample"] for r in out.collect()) == ["NA1", "NA2"]
    with pytest.raises(ValueError):
        vcf_to_table(lines, spec, qc=False, layout="wide")


def test_panel_and_goi_readers(spark, tmp_out):
    panel = os.path.join(tmp_out, "panel.tsv")
    with open(panel, "w") as fh:
        fh.write("symbol\thgnc_id\tentrez_id\nBRCA1\tHGNC:1100\t672\n")
    assert read_gene_panel(spark, panel).collect()[0].asDict() == {
        "symbol": "BRCA1", "hgnc_id": "HGNC:1100", "entrez_id": "672"}
    goi = os.path.join(tmp_out, "goi.tsv")
    with open(goi, "w") as fh:
        fh.write("TP53\t7157\t-\ttumor protein\textra\n")
    r = read_goi_list(spark, goi).collect()[0]
    assert (r["Germline_GOIs_names"], r["entrez"], r["ensembl"], r["gene_desc"]) == (
        "TP53", "7157", "-", "tumor protein\textra")


def test_annotation_scan_prunes(spark):
    df = read_annotation(spark, f"{SF_SMALL}/part.parquet", {"p_partkey": "k", "p_size": "s"})
    assert df.columns == ["k", "s"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "p_name" not in plan.split("ReadSchema")[-1]


def _variants(spark):
    return keep_consequences(fixture(spark, SF_SMALL, "fx_variants"))


def test_annotate_strategies_agree(spark):
    v = _variants(spark)
    tables = [project_annotation(fixture(spark, SF_SMALL, "fx_topmed"), {"af": "TOPMed_af"}),
              project_annotation(fixture(spark, SF_SMALL, "fx_intervar"), ["InterVar_automated"])]
    base = rows(annotate_by_key(v, tables, strategy="plain"))
    assert rows(annotate_by_key(v, tables, strategy="reduce")) == base
    assert rows(annotate_by_key(v, tables, strategy="keys")) == base
    assert rows(annotate_by_key(v, tables, strategy="keys", limits=TINY)) == base
    assert len(base) == v.count()  # unique-key tables keep the row count


def test_salted_lookup_equals_broadcast(spark):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(["a"] * 9 + ["b", "c", None])],
                                 "k string, i long")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v long")
    broadcast = rows(left_join_lookup(left, right, ["k"]))
    salted = rows(left_join_lookup(left, right, ["k"], limits=TINY))
    assert salted == broadcast
    assert len(broadcast) == 9 * 2 + 3


def test_or_join_both_plans(spark):
    v = _variants(spark).select(*KEY, "variant_id", "CSQ_HGNC_ID", "CSQ_Gene")
    orph = orphanet_by_gene(fixture(spark, SF_SMALL, "fx_orphanet"))
    a = rows(attach_orphanet(v, orph))
    b = rows(attach_orphanet(v, orph, limits=TINY))
    assert a == b and len(a) >= v.count()


def test_or_join_semantics(spark):
    left = spark.createDataFrame([("h1", "e1"), ("h1", "e2"), (None, "e2"), (None, None)], "h string, e string")
    right = spark.createDataFrame([("A", "h1", "e1"), ("B", "h9", "e2")], "sym string, rh string, re string")
    got = rows(left_join_any(left, right, [("h", "rh"), ("e", "re")], "sym"))
    # h1/e1 matches A by both keys (once); h1/e2 matches A and B; None/e2 matches B.
    assert got == sorted([("h1", "e1", "A", "h1", "e1"), ("h1", "e2", "A", "h1", "e1"),
                          ("h1", "e2", "B", "h9", "e2"), ("None", "e2", "B", "h9", "e2"),
                          ("None", "None", "None", "None", "None")])
    salted = rows(left_join_any(left, right, [("h", "rh"), ("e", "re")], "sym", limits=TINY))
    assert salted == got


def test_ids_of_one_text_are_broadcast_without_the_text(spark):
    """A gene of 4000 ids: its id text of 64 KB isn't repeated for every id
    (256 MB; the least table takes 64); single ids beyond the bound are not broadcast."""
    n = 4000
    ids = ",".join(f"identifier-{i:04d}" for i in range(n))
    right = spark.createDataFrame([("A", ids, "e1,e2", 5), (None, "x", "e3", 6)],
                                  "sym string, rh string, re string, v long")
    left = spark.createDataFrame(
        [("identifier-0007", "e2"), ("x", "e2"), ("x", "e3"), (None, None), ("none", "e9")], "h string, e string")
    wanted = sorted([("identifier-0007", "e2", "5"), ("x", "e2", "5"), ("x", "e2", "6"), ("x", "e3", "6"),
                     ("None", "None", "None"), ("none", "e9", "None")])
    join = lambda **kw: left_join_any(
        left, right, [("h", "rh"), ("e", "re")], "sym", split_keys=True, **kw)
    spark.conf.set("spark.sql.maxBroadcastTableSize", str(128 << 20))
    try:
        assert rows(join().select("h", "e", "v")) == wanted
        whole = {r["sym"]: r["rh"] for r in join().collect() if r["v"]}
        assert whole == {"A": ids, None: "x"}
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    few = Limits(max_broadcast_rows=100)  # two rows, but more ids
    assert rows(join(limits=few).select("h", "e", "v")) == wanted
    assert rows(join(limits=TINY).select("h", "e", "v")) == wanted


def test_no_nested_loop_join(spark):
    v = _variants(spark).select(*KEY, "CSQ_HGNC_ID", "CSQ_Gene")
    out = attach_orphanet(v, orphanet_by_gene(fixture(spark, SF_SMALL, "fx_orphanet")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert F is not None


def test_hot_key_is_split_across_tasks(spark):
    """A key holding most rows is salted: its rows leave the join in several
    partitions instead of one task."""
    from pyspark.sql import functions as F
    left = spark.range(3000).select(F.when(F.col("id") < 2700, F.lit("hot"))
                                    .otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("5", 2)], "k string, v long")
    limits = Limits(max_broadcast_rows=0, hot_key_rows=100)
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = left_join_lookup(left, right, ["k"], limits=limits)
        parts = (out.where(F.col("k") == "hot").select(F.spark_partition_id().alias("p"))
                 .distinct().count())
        assert out.count() == 3000 and out.where(F.col("v") == 1).count() == 2700
        assert parts > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)


def test_goi_last_duplicate_wins_from_file(spark, tmp_out):
    from varlake.operators.panels import attach_gene_list
    goi = os.path.join(tmp_out, "goi_dup.tsv")
    with open(goi, "w") as fh:
        fh.write("TP53\t7157\t-\tfirst\nBRCA1\t672\t-\tx\nTP53\t7157\t-\tlast\n")
    variants = spark.createDataFrame([(1, 0.0, None, 7157, "E", "TP53")],
                                     "flag_keep int, max_gtar double, PredCountRatio_D2T double, "
                                     "entrez_gene_id long, CSQ_Gene string, CSQ_SYMBOL string")
    got = [r["gene_desc"] for r in attach_gene_list(variants, read_goi_list(spark, goi)).collect()]
    assert got == ["last"]
