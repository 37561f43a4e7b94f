"""No record is lost or misread for want of a header."""

import os

import pytest

from varlake.plans.vcf_table import vcf_to_table, vcf_transcripts
from varlake.sources.tables import write_result
from varlake.sources.vcf import header_lines, read_vcf, vcf_lines, vcf_schema
from varlake.streaming.vcf_ingest import batch_to_table

FORMATS = {"a": "Allele|Consequence|PICK|SYMBOL|Feature", "b": "Allele|SYMBOL|Feature|Consequence|PICK"}
CSQ = {"a": "C|missense_variant|1|GENEA|ENST1.1", "b": "C|GENEB|ENST2.1|stop_gained|1"}


def head(sample, order):
    return [f'##INFO=<ID=CSQ,Number=.,Type=String,Description="x Format: {FORMATS[order]}">',
            '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">',
            "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", sample])]


def record(pos, order):
    return "\t".join(["chr1", str(pos), ".", "A", "C", "50", "PASS", f"CSQ={CSQ[order]}", "GT", "0/1"])


def write(folder, name, lines):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


@pytest.fixture()
def cohort(tmp_path):
    """Two samples' files, each with a part file that has no header."""
    at = str(tmp_path)
    for order, sample in (("a", "ALICE"), ("b", "BOB")):
        write(at, f"{sample}/1.vcf", [*head(sample, order), record(1, order)])
        write(at, f"{sample}/2.vcf", [record(2, order)])
        write(at, f"{sample}/3.vcf", ["##source=x"])  # no records: no header needed
    return at


def read(spark, at):
    return read_vcf(spark, os.path.join(at, "*", "*.vcf"))


def test_differing_headers_need_one_for_every_file(spark, cohort):
    lines = read(spark, cohort)
    assert header_lines(lines).where("line IS NULL").count() == 2
    with pytest.raises(ValueError, match="2 file.*ALICE/2.vcf.*BOB/2.vcf"):
        vcf_schema(lines)


@pytest.mark.parametrize("how", ["folder", "given"])
def test_parts_take_the_header_they_are_told(spark, cohort, how):
    if how == "given":
        for sample in ("ALICE", "BOB"):
            os.rename(f"{cohort}/{sample}/2.vcf", f"{cohort}/{sample}/{sample}2.vcf")
    lines = read(spark, cohort)
    spec = vcf_schema(lines, header_of="folder") if how == "folder" else vcf_schema(
        lines, given={"ALICE2.vcf": head("ALICE", "a"), "BOB2.vcf": head("BOB", "b")})
    want = sorted([(p, s, f"GENE{s[0]}", c) for p in ("1", "2") for s, c in
                   (("ALICE", "missense_variant"), ("BOB", "stop_gained"))])
    long = vcf_to_table(lines, spec, qc=False, layout="long")
    assert sorted((r["POS"], r["sample"], r["CSQ_SYMBOL"], r["CSQ_Consequence"])
                  for r in long.collect()) == want
    tidy = vcf_transcripts(lines, spec)
    assert sorted((str(r["start"]), r["Indiv"], r["SYMBOL"], r["Consequence"])
                  for r in tidy.collect()) == want


def test_agreeing_headers_describe_files_without_one(spark, tmp_path):
    at = str(tmp_path)
    write(at, "x/1.vcf", [*head("EVE", "a"), record(1, "a")])
    write(at, "x/2.vcf", [record(2, "a")])
    lines = read(spark, at)
    assert vcf_to_table(lines, qc=False, layout="wide").count() == 2
    assert {r["sample"] for r in vcf_to_table(lines, qc=False, layout="long").collect()} == {"EVE"}


def test_one_order_of_sub_fields_is_enough_to_differ(spark, tmp_path):
    """Samples agree, the annotation's order doesn't."""
    at = str(tmp_path)
    write(at, "x/1.vcf", [*head("EVE", "a"), record(1, "a")])
    write(at, "y/2.vcf", [*head("EVE", "b"), record(2, "b")])
    write(at, "z/3.vcf", [record(3, "b")])
    with pytest.raises(ValueError, match="z/3.vcf"):
        vcf_schema(read(spark, at))


def test_no_header_at_all_is_an_error(spark, tmp_path):
    write(str(tmp_path), "x/1.vcf", [record(1, "a")])
    with pytest.raises(ValueError, match="no #CHROM"):
        vcf_schema(read(spark, str(tmp_path)))
    rows = spark.createDataFrame([(record(1, "a"),)], "line string")
    with pytest.raises(ValueError, match="no #CHROM"):
        vcf_schema(vcf_lines(rows))


def test_a_spec_of_other_files_fails_instead_of_dropping(spark, cohort):
    write(cohort, "CARL/1.vcf", [*head("CARL", "b"), record(5, "b")])
    spec = vcf_schema(read_vcf(spark, [f"{cohort}/ALICE/1.vcf", f"{cohort}/BOB/1.vcf"]))
    for table in (vcf_to_table(read(spark, cohort), spec, qc=False, layout="long"),
                  vcf_transcripts(read(spark, cohort), spec)):
        with pytest.raises(Exception, match="no header"):
            table.collect()


def test_a_batch_of_the_stream_needs_its_headers(spark, cohort):
    whole = read_vcf(spark, [f"{cohort}/ALICE/1.vcf", f"{cohort}/BOB/1.vcf"])
    spec = vcf_schema(whole)
    plain = whole.select("file", "line")
    assert batch_to_table(plain, spec, qc=False).count() == 2
    with pytest.raises(ValueError, match="ALICE/2.vcf"):
        batch_to_table(read(spark, cohort).select("file", "line"), spec, qc=False)


def test_missing_arrays_are_written_as_missing(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", None, None), ("b", [], "x"), ("c", ["p", "q"], ""), ("d", [None, "p"], "y")],
        "k string, arr array<string>, v string")
    path = str(tmp_path / "out")
    write_result(df.coalesce(1), path, compression=None)
    got = [line for r in spark.read.text(path).collect() for line in [r[0]]]
    assert got == ["k\tarr\tv", "a\t-\t-", "b\t\tx", "c\tp,q\t", "d\tp\ty"]
    write_result(df.coalesce(1), path, compression=None, null_value="")
    assert spark.read.text(path).collect()[1][0] == "a\t\t"
