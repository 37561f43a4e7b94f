"""The streaming P0 gives the same rows as the batch P0 on the same files."""

import os

from varlake.plans.vcf_table import vcf_to_table
from varlake.sources.vcf import parse_header, read_vcf
from varlake.streaming.vcf_ingest import start_ingest

HEADER = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=QD,Number=1,Type=Float,Description="q">',
    '##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations from Ensembl VEP. Format: Allele|Consequence|PICK|SYMBOL">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">',
    '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="a">',
    '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="d">',
    '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="q">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1",
]


def _write(path, records):
    with open(path, "w") as fh:
        fh.write("\n".join(HEADER + records) + "\n")


def _rec(pos, qd, ad):
    return "\t".join(["chr1", str(pos), ".", "A", "C", "50", "PASS",
                      f"QD={qd};CSQ=C|missense_variant|1|G{pos}", "GT:AD:DP:GQ", f"0/1:{ad}:30:50"])


def test_stream_matches_batch(spark, tmp_out):
    src = os.path.join(tmp_out, "in")
    os.makedirs(src)
    _write(os.path.join(src, "a.vcf"), [_rec(1, 5, "10,10"), _rec(2, 1, "10,10"), _rec(3, 5, "30,0")])
    _write(os.path.join(src, "b.vcf"), [_rec(4, 5, "2,18")])
    spec = parse_header(HEADER)
    out = os.path.join(tmp_out, "out")
    q = start_ingest(spark, src, out, spec, checkpoint=os.path.join(tmp_out, "ckpt"))
    q.awaitTermination(120)
    streamed = sorted((r["POS"], r["sample"], r["AdjustedGenotype"]) for r in spark.read.parquet(out).collect())
    batch = vcf_to_table(read_vcf(spark, src), spec, layout="long")
    expected = sorted((r["POS"], r["sample"], r["AdjustedGenotype"]) for r in batch.collect())
    assert streamed == expected == [("1", "S1", "0/1"), ("4", "S1", "1/1")]


def test_stream_names_each_files_sample_and_layout(spark, tmp_out):
    """Files with other samples and another order of sub-fields than the spec's."""
    src = os.path.join(tmp_out, "in")
    os.makedirs(src)
    other = [h.replace("Allele|Consequence|PICK|SYMBOL", "SYMBOL|PICK|Allele|Consequence")
             .replace("FORMAT\tS1", "FORMAT\tBOB") for h in HEADER]
    alice = [h.replace("FORMAT\tS1", "FORMAT\tALICE") for h in HEADER]
    for name, head, rec in (("a", alice, _rec(1, 5, "10,10")),
                            ("b", other, _rec(2, 5, "10,10").replace(
                                "CSQ=C|missense_variant|1|G2", "CSQ=G2|1|C|missense_variant"))):
        with open(os.path.join(src, f"{name}.vcf"), "w") as fh:
            fh.write("\n".join([*head, rec]) + "\n")
    out = os.path.join(tmp_out, "out")
    q = start_ingest(spark, src, out, parse_header(HEADER), checkpoint=os.path.join(tmp_out, "ckpt"))
    q.awaitTermination(120)
    got = sorted((r["POS"], r["sample"], r["CSQ_SYMBOL"], r["CSQ_Consequence"])
                 for r in spark.read.parquet(out).collect())
    assert got == [("1", "ALICE", "G1", "missense_variant"), ("2", "BOB", "G2", "missense_variant")]
