"""Genomic bins: rows in chromosome order without a range sort."""

import random

import pytest
from pyspark.sql import functions as F

from varlake.functions.keys import chromosome_rank
from varlake.operators.bins import genomic_bins
from varlake.operators.ordering import chromosome_order

SCHEMA = "chromosome string, start long, reference string, alternate string, n int"


def variants(spark, hot=0):
    rng = random.Random(5)
    contigs = ["1", "2", "10", "22", "X", "Y", "MT", "GL0001", None]
    rows = [(rng.choice(contigs), rng.choice([None, -5, rng.randrange(1 << 18)]), "A", "C", i)
            for i in range(1500)]
    rows += [("2", 70_000, rng.choice("ACGT"), "T", -i) for i in range(hot)]
    rows += rows[:20]  # repeats
    return spark.createDataFrame(rows, SCHEMA).repartition(7, "n")


def placed(df):
    """(partition, row) in the order in which files are written."""
    return df.withColumn("part", F.spark_partition_id()).withColumn(
        "rank", chromosome_rank("chromosome")).collect()


@pytest.mark.parametrize("hot, rows_per_bin", [(0, 100), (0, 7), (3000, 100), (3000, 10_000)])
def test_rows_are_in_order_and_none_is_lost(spark, hot, rows_per_bin):
    df = variants(spark, hot)
    bins = genomic_bins(df, rows_per_bin)
    got = placed(chromosome_order(df, bins=bins))
    key = lambda r: (r["rank"] is not None, r["rank"], r["start"] is not None, r["start"] or 0)
    order = [key(r) for r in got]
    assert order == sorted(order)
    plain = lambda rows: sorted(str(tuple(r)[:5]) for r in rows)
    assert plain(got) == plain(df.collect())
    per_bin = {}
    for r in got:
        per_bin[r["part"]] = per_bin.get(r["part"], 0) + 1
    assert max(per_bin) < bins.count
    # Repeated rows stay together, a window has at most a bin's rows more.
    assert max(per_bin.values()) <= 3 * rows_per_bin
    if hot and rows_per_bin == 100:
        assert len({r["part"] for r in got if r["start"] == 70_000 and r["chromosome"] == "2"}) >= 25


def test_same_rows_in_the_same_order_as_the_range_sort(spark):
    df = variants(spark)
    by_bins = [tuple(r) for r in chromosome_order(df, bins=genomic_bins(df, 100)).collect()]
    assert by_bins == [tuple(r) for r in chromosome_order(df).collect()]


def test_no_bins_beyond_the_bound_and_none_for_unknown_positions(spark):
    df = variants(spark)
    assert genomic_bins(df, 100, max_slots=10) is None
    other = spark.createDataFrame([("7", 1, "A", "C", 1)], SCHEMA)
    with pytest.raises(Exception, match="no genomic bin"):
        chromosome_order(other, bins=genomic_bins(df, 100)).collect()
    empty = df.where("false")
    assert chromosome_order(empty, bins=genomic_bins(empty)).count() == 0


def test_sorting_by_bins_has_no_range_exchange(spark):
    df = variants(spark)
    plan = chromosome_order(df, bins=genomic_bins(df, 100))._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("name", ["filter_vep", "filter_dragon", "filter_annovar"])
def test_pipelines_sort_by_bins(spark, name):
    from conftest import SF_SMALL
    from varlake.plans.catalog import REGISTRY

    plan = REGISTRY[name][0](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "__bin" in plan
