"""Hand-made edge rows (FIXTURES.md section C)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from varlake.functions.keys import KEY, chromosome_rank
from varlake.functions.values import damage_ratio, max_frequency, null_if_empty_array
from varlake.functions.vcf import (
    adjusted_genotype,
    info_value,
    picked_transcript,
    subfield,
    transcript_id,
    unescape,
)
from varlake.operators.aggregates import dbsnp_smallest
from varlake.operators.filters import flag_rare
from varlake.operators.known import flag_known
from varlake.operators.ordering import chromosome_order
from varlake.operators.panels import annotate_gene_group, attach_gene_list
from varlake.operators.vcf_qc import site_qc
from varlake.sources.vcf import parse_header, vcf_lines, vcf_records


def test_adjusted_genotype(spark):
    cases = [
        ("GT:AD:DP", "0/1:7,0:7", "0/0"),
        ("GT:AD:DP", "0/1:80,20:100", "0/1"),
        ("GT:AD:DP", "0/1:81,19:100", "0/0"),
        ("GT:AD:DP", "0/0:19,81:100", "1/1"),
        ("GT:AD:DP", "0/1:20,80:100", "1/1"),
        ("GT:AD:DP", "0/1:0,0:0", "./."),
        ("GT:AD:DP", "1/2:1,2,3:6", "1/2"),
        ("GT:AD:DP", ".", "./."),
        ("GT:AD:DP", "0/1:5,5:.", "./."),
    ]
    df = spark.createDataFrame([(f, s) for f, s, _ in cases], "fmt string, sample string")
    got = [r[0] for r in df.select(adjusted_genotype("fmt", "sample")).collect()]
    assert got == [e for _, _, e in cases]


def test_transcript_pick(spark):
    rows = [
        ("A|x|0|G1,A|y|1|G2",),   # second picked
        ("A|x||G1,A|y||G2",),     # none picked -> first
        (None,),                  # no CSQ at all
    ]
    df = spark.createDataFrame(rows, "csq string")
    t = picked_transcript("csq", 2, ("1", "YES"))
    got = [r[0] for r in df.select(subfield(t, 3)).collect()]
    assert got == ["G2", "G1", None]
    last = picked_transcript("csq", 2, ("1",), which="last", fallback_first=False)
    df2 = spark.createDataFrame([("A|x|1|G1,A|y|1|G2",), ("A|x||G1",)], "csq string")
    assert [r[0] for r in df2.select(subfield(last, 3)).collect()] == ["G2", None]


def test_transcript_rows_helpers(spark):
    df = spark.createDataFrame([("ENST00000000001.2", "a\\x3bb\\x3dc"), ("NM_1", "x")], "f string, s string")
    rows = df.select(transcript_id("f"), unescape("s")).collect()
    assert rows[0][0] == "ENST00000000001" and rows[0][1] == "a;b=c"
    assert rows[1][0] is None


def test_info_value_exact_key(spark):
    df = spark.createDataFrame([("xAF=1;AF=0.5;DP=.;FLAG",), ("AF=.",), ("DP=3",)], "info string")
    got = df.select(info_value("info", "AF"), info_value("info", "DP")).collect()
    assert got[0][0] == "0.5" and got[0][1] is None
    assert got[1][0] is None
    assert got[2][0] is None and got[2][1] == "3"


def _records(spark, infos, samples=None):
    lines = []
    for i, info in enumerate(infos):
        sample = samples[i] if samples else "0/1:5,5:30:40"
        lines.append("\t".join(["chr1", str(100 + i), ".", "A", "C", "50", "PASS",
                                info + ";CSQ=A|x|1|G", "GT:AD:DP:GQ", sample]))
    return vcf_records(vcf_lines(spark.createDataFrame([(l,) for l in lines], "line string")))


def test_site_qc_thresholds(spark):
    infos = ["QD=2.0", "QD=1.99", "FS=60.0", "FS=60.1", "MQRankSum=-12.5", "ReadPosRankSum=-8.0",
             "SOR=3.0", "SOR=3.01", "MQ=39.9", "QD=.", "AB=1"]
    kept = {r["POS"] for r in site_qc(_records(spark, infos)).collect()}
    expect = {str(100 + i) for i, inf in enumerate(infos)
              if inf in ("QD=2.0", "FS=60.0", "SOR=3.0", "QD=.", "AB=1")}
    assert kept == expect


def test_depth_quality(spark):
    samples = ["0/1:5,5:9:40", "0/1:5,5:10:19", "0/1:5,5:10:20", "0/1:5,5:.:30"]
    kept = {r["POS"] for r in site_qc(_records(spark, ["QD=5"] * 4, samples)).collect()}
    assert kept == {"102"}
    flagged = {r["POS"]: r["Flagged"] for r in
               site_qc(_records(spark, ["QD=5"] * 4, samples), mode="flag").collect()}
    assert flagged == {"100": 1, "101": 1, "102": 0, "103": 1}


def test_frequency_flag(spark):
    df = spark.createDataFrame([(None, None), ("0.001", None), ("0.0011", "-")], "a string, b string")
    out = flag_rare(df.withColumn("max_gtar", max_frequency(["a", "b"])), 0.001)
    assert [r["flag_keep"] for r in out.collect()] == [1, 1, 0]


def test_damage_ratio(spark):
    df = spark.createDataFrame([("3_4",), ("0_0",), (None,), ("x",)], "d string")
    assert [r[0] for r in df.select(damage_ratio("d")).collect()] == [0.75, None, None, None]


def test_dbsnp_pick(spark):
    key = ("1", 100, "A", "C")
    key2 = ("1", 200, "A", "C")
    rows = [key + ("rs12",), key + ("rs9",), key2 + ("novel",)]
    df = spark.createDataFrame(rows, "chromosome string, start long, reference string, alternate string, name string")
    got = [tuple(r) for r in dbsnp_smallest(df).collect()]
    assert got == [key + ("rs9",)]


def test_known_variant_override(spark):
    df = spark.createDataFrame([(0, "VCV1", None), (0, None, None), (0, None, "CM1")],
                               "flag_keep int, VariationID string, HGMDID string")
    assert [r["flag_keep"] for r in flag_known(df).collect()] == [1, 0, 1]
    only_hgmd = flag_known(df, sources=["HGMD"])
    assert [r["flag_keep"] for r in only_hgmd.collect()] == [0, 0, 1]


def test_empty_array_nulling(spark):
    df = spark.createDataFrame([([],), ([""],), (["a"],)], T.StructType([T.StructField("a", T.ArrayType(T.StringType()))]))
    assert [r[0] for r in df.select(null_if_empty_array("a")).collect()] == [None, None, ["a"]]


def test_gene_group(spark):
    variants = spark.createDataFrame(
        [(1, "HGNC:1", "G1"), (2, None, "G2"), (None, None, "G3"), (4, "-", "G4"), (None, None, "G5")],
        "entrez_gene_id long, hgnc string, CSQ_SYMBOL string")
    first = spark.createDataFrame([("G1", "HGNC:1", "1"), ("G3", "-", "-"), ("X", "-", "4")],
                                  "symbol string, hgnc_id string, entrez_id string")
    second = spark.createDataFrame([("Y", "HGNC:1", "-"), ("G2", "-", "2"), ("G5", "-", "-")],
                                   "symbol string, hgnc_id string, entrez_id string")
    got = {r["CSQ_SYMBOL"]: r["gene_group"] for r in annotate_gene_group(variants, first, second).collect()}
    assert got == {"G1": "ECPG/EMGP", "G2": "EMGP", "G3": "ECPG", "G4": "ECPG", "G5": "EMGP"}


def test_genes_of_interest(spark):
    schema = "flag_keep int, max_gtar double, PredCountRatio_D2T double, entrez_gene_id long, CSQ_Gene string, CSQ_SYMBOL string"
    variants = spark.createDataFrame([
        (1, 0.0, None, 7, "ENSG7", "S7"),      # entrez match
        (1, 0.0, 0.5, None, "ENSG8", "S8"),    # ensembl match
        (1, 0.0, None, None, None, "S9"),      # symbol match
        (1, 0.0001, None, 7, "ENSG7", "S7"),   # frequency equal to 0.0001: dropped
        (1, 0.0, 0.49, 7, "ENSG7", "S7"),      # ratio below 0.5: dropped
        (0, 0.0, None, 7, "ENSG7", "S7"),      # not flagged: dropped
        (1, 0.0, None, None, None, "NONE"),    # no list match: dropped
    ], schema)
    goi = spark.createDataFrame([
        ("S7", "7", "ENSG_OTHER", "d7", 0), ("S8", "-", "ENSG8", "d8", 1), ("S9", "-", "-", "d9", 2),
        ("S9", "-", "-", "d9-last", 3),
    ], "Germline_GOIs_names string, entrez string, ensembl string, gene_desc string, line_no long")
    got = sorted((r["CSQ_SYMBOL"], r["Germline_GOIs_names"], r["gene_desc"])
                 for r in attach_gene_list(variants, goi).collect())
    assert got == [("S7", "S7", "d7"), ("S8", "S8", "d8"), ("S9", "S9", "d9-last")]


def test_chromosome_order(spark):
    chroms = ["Y", "10", "2", "X", "1", "22", "MT", "GL000"]
    df = spark.createDataFrame([(c, 5, "A", "C") for c in chroms],
                               "chromosome string, start long, reference string, alternate string")
    got = [r["chromosome"] for r in chromosome_order(df).collect()]
    assert got == ["1", "2", "10", "22", "X", "Y", "GL000", "MT"]
    keys = [r[0] for r in df.select(chromosome_rank("chromosome")).collect()]
    assert keys[0] == "2Y" and keys[2] == "02"


def test_header_parse():
    spec = parse_header([
        '##INFO=<ID=AF,Number=A,Type=Float,Description="x">',
        '##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations from Ensembl VEP. Format: Allele|Consequence|PICK|SYMBOL">',
        '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">',
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\tinheritance",
    ])
    assert spec.info_ids == ["AF"] and spec.csq_fields == ["Allele", "Consequence", "PICK", "SYMBOL"]
    assert spec.samples == ["S1", "S2"] and spec.extra_last == "inheritance"
    assert spec.pick_index == 2


def test_key_columns_constant():
    assert KEY == ["chromosome", "start", "reference", "alternate"]
    assert F is not None


def test_consequence_split_terms(spark):
    from varlake.operators.filters import keep_consequences
    df = spark.createDataFrame([("missense_variant",), ("missense_variant&splice_region_variant",),
                                ("intron_variant",), ("intron_variant&synonymous_variant",)],
                               "CSQ_Consequence string")
    exact = [r[0] for r in keep_consequences(df).collect()]
    split = [r[0] for r in keep_consequences(df, split_terms=True).collect()]
    assert exact == ["missense_variant"]
    assert split == ["missense_variant", "missense_variant&splice_region_variant"]


def test_damage_clause_modes(spark):
    from varlake.operators.filters import flag_damaging
    df = spark.createDataFrame([(1, 0.75), (1, 0.25), (1, None), (0, 0.75)],
                               "flag_keep int, PredCountRatio_D2T double")
    same = [r["flag_keep"] for r in flag_damaging(df).collect()]
    strict = [r["flag_keep"] for r in flag_damaging(df, require_damaging=True).collect()]
    assert same == [1, 1, 1, 0]        # as the reference: the clause never changes the flag
    assert strict == [1, 0, 0, 0]


def test_existence_by_one_row(spark):
    from varlake.operators.ordering import has_rows

    assert has_rows(spark.range(3)) and not has_rows(spark.range(3).where("id > 5"))


def test_predicates_on_records_split_a_line_once(spark):
    """no predicate of the record or sample QC takes the line apart again."""
    from varlake.plans.vcf_table import vcf_to_table
    from varlake.sources.fixtures import VCF_HEADER
    from varlake.sources.vcf import parse_header, vcf_lines

    record = "chr1\t7\t.\tA\tC\t50\tPASS\tQD=3;FS=1;CSQ=A|x|1|G|ENST1\tGT:AD:DP:GQ\t0/1:7,9:16:40"
    lines = spark.createDataFrame([(x,) for x in [*VCF_HEADER, record]], "line string")
    for layout in ("wide", "long"):
        table = vcf_to_table(vcf_lines(lines), parse_header(VCF_HEADER), layout=layout)
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(line") == 1 and "substring_index(line" not in plan
        filters = [x for x in plan.splitlines() if "Filter" in x]
        assert filters and not any("split(" in x for x in filters if layout == "long")
        assert [r["POS"] for r in table.collect()] == ["7"]


def test_info_parts_read_what_info_values_read(spark):
    from varlake.functions.vcf import InfoParts, info_has, info_number, info_value

    texts = ["QD=3;FS=1", "FLAG;QD=.;QD=4", "XQD=2;QD", "QD=a=b;FS=", "QD=;x", "", "=QD;FS=2", "FS", None,
             ";;QD=5;", "FS=1e1;FLAG=2", "QD= 7 ;flag", "Qé=1;QD=é"]
    rows = InfoParts.of(spark.createDataFrame([(x,) for x in texts], "INFO string"))
    keys = ["QD", "FS", "FLAG", "Qé"]
    pairs = [p for k in keys for p in (
        (InfoParts.value(k), info_value("INFO", k)), (InfoParts.value(k, False), info_value("INFO", k, False)),
        (InfoParts.number(k), info_number("INFO", k)), (InfoParts.has(k), info_has("INFO", k)))]
    for mine, plain in pairs:
        assert [tuple(r) for r in rows.select(mine, plain).collect()] == [
            (r[1], r[1]) for r in rows.select(mine, plain).collect()]
