"""Beyond the broadcast bounds a pipeline deals its rows once, to their genomic bins: repeats
are dropped there, keys and genes come there, and nothing wide is shuffled again."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from varlake.config import Limits, written
from varlake.functions.keys import KEY
from varlake.operators import bins as B
from varlake.operators.aggregates import dbsnp_smallest
from varlake.operators.bins import genomic_bins
from varlake.operators.joins import left_join_in_bins
from varlake.operators.ordering import dealt_to_bins, sorted_in_bins
from varlake.plans.catalog import arrays_as_text, vep_tables
from varlake.plans.catalog_files import older_tables
from varlake.plans.reannotate import reannotate
from varlake.plans.vep import filter_vep
from varlake.sources.fixtures import fixture

FORCED = Limits(max_broadcast_rows=0, max_variant_rows=0, hot_key_rows=50)


def wide_exchanges(df, column="variant_id"):
    """Exchanges of the physical plan whose rows have ``column``: those with it in their
    keys, or of a subtree that reads it."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(re.match(r"[ :+\-]*", line).group())
    found = 0
    for i, line in enumerate(lines):
        if "Exchange " in line and "BroadcastExchange" not in line:
            child = next(x for x in lines[i + 1:] if depth(x) > depth(line))
            if column + "#" in child + line:
                found += 1
    return found


def rows_of(df):
    return Counter(str(tuple(r)) for r in arrays_as_text(df).collect())


def variants(spark, repeated):
    """Rows of the fixture, some twice, rows without a key or genes, and a position
    with ``repeated`` rows of which a few differ."""
    v = fixture(spark, SF_SMALL, "fx_variants")
    first = v.where("CSQ_Consequence = 'missense_variant'").orderBy("variant_id").limit(1)
    odd = v.where("CSQ_Consequence = 'stop_gained'").orderBy("variant_id").limit(3)
    out = v.unionByName(v.limit(50))
    for c in ("chromosome", "start", "reference"):
        out = out.unionByName(odd.withColumn(c, F.lit(None).cast(dict(v.dtypes)[c])))
    out = out.unionByName(odd.withColumn("CSQ_Gene", F.lit(None).cast("string")).withColumn(
        "CSQ_HGNC_ID", F.lit(None).cast("string")))
    many = first.crossJoin(spark.range(repeated)).withColumn(
        "variant_id", F.concat(F.lit("M"), (F.col("id") % 7).cast("string"))).drop("id")
    return written(out.unionByName(many))


@pytest.mark.parametrize("repeated", [0, 25_000])
def test_rows_equal_those_of_the_plan_with_broadcasts(spark, monkeypatch, repeated):
    monkeypatch.setattr(B, "LEAST_ROWS", 100)
    v, tables = variants(spark, repeated), vep_tables(spark, SF_SMALL)
    df = filter_vep(v, tables, strategy="keys", limits=FORCED, write_input=False)
    assert wide_exchanges(df) == (2 if repeated else 1)  # many repeats of a position go first
    placed = df.withColumn("part", F.spark_partition_id())
    got = [(r["part"], r["chromosome"], r["start"]) for r in placed.collect()]
    want = filter_vep(v, tables, variants_bounded=True, write_input=False)
    assert [r[1:] for r in got] == [(r["chromosome"], r["start"]) for r in want.collect()]
    assert rows_of(df) == rows_of(want)


def test_keys_come_to_all_bins_of_a_position(spark):
    v = spark.createDataFrame([("1", 5, "A", "C", i) for i in range(900)] + [("1", 9, "A", "C", -1),
                              (None, 5, "A", "C", -2)], "chromosome string, start long, reference string, "
                              "alternate string, n long")
    keys = spark.createDataFrame([("1", 5, "A", "C", "x"), ("1", 5, "A", "C", "y"), ("2", 5, "A", "C", "z"),
                                  (None, 5, "A", "C", "w")], "chromosome string, start long, "
                                 "reference string, alternate string, found string")
    counts = v.groupBy(*KEY).agg(F.count(F.lit(1)).alias("many"))
    for bins in (genomic_bins(v, 100), genomic_bins(counts, 100, rows_column="many")):
        assert bins.cut and bins.count == 10
        dealt = dealt_to_bins(v, bins, keep_bin=True)
        out = left_join_in_bins(dealt, bins.dealt_keys(keys, "__bin"), KEY, "__bin")
        got = Counter(r["found"] for r in sorted_in_bins(out).collect())
        assert got == {"x": 900, "y": 900, None: 2}
    assert not genomic_bins(v, 1000).cut


def test_a_single_bin_keeps_the_order(spark):
    v, tables = written(fixture(spark, SF_SMALL, "fx_variants")), vep_tables(spark, SF_SMALL)
    df = filter_vep(v, tables, strategy="keys", limits=FORCED, write_input=False)
    assert wide_exchanges(df) == 1
    place = lambda d: [(r["chromosome"], r["start"]) for r in d.collect()]
    assert place(df) == place(filter_vep(v, tables, variants_bounded=True, write_input=False))


def test_reannotation_deals_wide_rows_once(spark, monkeypatch):
    monkeypatch.setattr(B, "LEAST_ROWS", 100)
    v, new = written(fixture(spark, SF_SMALL, "fx_variants")), vep_tables(spark, SF_SMALL)
    old = older_tables(new)
    before = written(filter_vep(v, old, sort=False))
    df = reannotate(before, v, old, new, limits=FORCED)
    assert wide_exchanges(df, "max_gtar") == 1
    assert rows_of(df) == rows_of(filter_vep(v, new, sort=False))


def test_least_dbsnp_number_without_a_sort_of_the_table(spark):
    rows = [("1", 1, n) for n in ("rs9", "rs10", "rs09", "novel", None, "rs9")] + [
        ("1", 2, n) for n in ("rs007", "rs7", "xrs7y", "rs8")] + [("1", 3, n) for n in ("novel", None)] + [
        (None, 4, "rs5"), ("1", 5, "rs6x"), ("1", 5, "rs60"), ("1", 6, "rs99999999999999999999"), ("1", 6, "rs1")]
    table = spark.createDataFrame([(c, s, "A", "C", n) for c, s, n in rows],
                                  "chromosome string, start long, reference string, alternate string, name string")
    df = dbsnp_smallest(table)
    assert {(r["start"], r["DBSNP_RSID"]) for r in df.collect()} == {
        (1, "rs9"), (1, "rs09"), (2, "rs007"), (2, "rs7"), (2, "xrs7y"), (4, "rs5"), (5, "rs6x"), (6, "rs1")}
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    assert "HashAggregate" in [x for x in plan if "Aggregate" in x][-1]  # the first, over the table
    assert "ObjectHashAggregate" not in [x for x in plan if "Aggregate" in x][-1]


def test_sort_keys_are_columns(spark):
    v = spark.createDataFrame([("2", 5, 1), ("10", 1, 2), ("X", 1, 3), (None, None, 4)],
                              "chromosome string, start long, n long")
    plan = sorted_in_bins(dealt_to_bins(v, genomic_bins(v)))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE" not in next(x for x in plan.splitlines() if "Sort [" in x)
