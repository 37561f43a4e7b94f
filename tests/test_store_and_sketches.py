"""Annotation store: no shuffle of its tables, only the contigs needed; key
sketches: nothing lost, most of the rest left out."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from varlake.config import Limits
from varlake.functions.keys import KEY
from varlake.operators.joins import annotate_by_key
from varlake.operators.sketches import BITMAP_BYTES, key_sketch, maybe_among
from varlake.plans.catalog import SHUFFLED, arrays_as_text, fixture, vep_tables
from varlake.plans.catalog_files import annotation_store
from varlake.plans.vep import filter_vep
from varlake.sources.store import open_store, write_store
from dataclasses import replace


def depth(line):
    return len(re.match(r"[ :+\-]*", line).group())


def ancestors(lines, i):
    """Lines of the operators above line ``i`` of a plan, nearest first."""
    at = depth(lines[i])
    for line in reversed(lines[:i]):
        if depth(line) < at:
            at = depth(line)
            yield line


def test_store_tables_are_joined_without_a_shuffle(spark):
    v = fixture(spark, SF_SMALL, "fx_variants").where("chromosome IN ('1', '2', 'X')")
    store = annotation_store(spark, SF_SMALL)
    tables = replace(vep_tables(spark, SF_SMALL), **store.tables_for(v))
    df = filter_vep(v, tables, strategy="keys", sketch=False, limits=SHUFFLED, sort=False)
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "varlake_store_" in line]
    assert len(scans) == 8
    for i in scans:
        assert "Bucketed: true" in lines[i] and "dynamicpruning" in lines[i], lines[i]
        for line in ancestors(lines, i):
            assert not re.search(r"\bExchange\b", line), line
            if "SortMergeJoin" in line:
                break
        else:
            raise AssertionError("no join above the scan")
    plain = filter_vep(v, vep_tables(spark, SF_SMALL), sort=False)
    rows = lambda d: sorted(map(str, arrays_as_text(d).collect()))
    got = rows(df)
    assert got == rows(plain) and got


def test_only_the_variants_contigs_are_read(spark):
    v = fixture(spark, SF_SMALL, "fx_variants").where("chromosome = '7'")
    t = annotation_store(spark, SF_SMALL).tables_for(v)["dbsnp"]
    want = fixture(spark, SF_SMALL, "fx_dbsnp").where("chromosome = '7'").count()
    assert t.count() == want
    plan = t._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "varlake_store_" in line)
    assert "dynamicpruning" in scan.split("PartitionFilters")[1]


def test_odd_contigs_and_names(spark, tmp_path):
    rows = [("1", 5, "A", "C", "a"), ("x", 6, "A", "C", "b"), ("GL000", 7, "A", "C", "c"),
            (None, 8, "A", "C", "d"), ("1", None, "A", "C", "e"), ("1", 5, "A", "C", "a")]
    df = spark.createDataFrame(rows, "chromosome string, start int, reference string, alternate string, v string")
    write_store({"odd-name": df}, str(tmp_path / "s"), 3)
    back = open_store(spark, str(tmp_path / "s"))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, back.table("odd-name").collect())) == sorted(map(key, rows))
    some = spark.createDataFrame([("GL1", 1), (None, 2)], "chromosome string, start long")
    assert sorted(r["v"] for r in back.tables_for(some)["odd-name"].collect()) == ["c", "d"]
    with pytest.raises(ValueError):
        write_store({"x": df.withColumn("contig", F.lit(1))}, str(tmp_path / "t"), 3)


def table(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("c"), (F.col("id") % 24).cast("string")).alias("chromosome"),
        F.col("id").alias("start"), F.lit("A").alias("reference"), F.lit("C").alias("alternate"),
        (F.col("id") % 5).alias("v"))


def test_sketch_keeps_all_keys_and_few_others(spark):
    t = table(spark, 200_000)
    keys = t.where("start % 100 = 3").select(*KEY)
    sketch = key_sketch(keys, KEY, 1 << 20)
    left = maybe_among(t, KEY, sketch)
    assert left.columns == t.columns
    assert left.join(keys, KEY, "left_semi").count() == 2000
    assert left.count() < 2000 + 0.03 * 200_000  # a table 100 times as large, down by 25
    assert sketch.count() * BITMAP_BYTES <= 1 << 20
    assert key_sketch(keys, KEY, BITMAP_BYTES - 1) is None  # too large: not used
    none = key_sketch(keys.limit(0), KEY, 1 << 20)
    assert maybe_among(t, KEY, none).count() == 0
    odd = t.limit(3).withColumn("reference", F.lit(None).cast("string"))
    assert maybe_among(odd.unionByName(keys.limit(1).withColumn("v", F.lit(1))), KEY, sketch).count() == 1


def test_annotation_with_and_without_a_sketch_is_equal(spark):
    t = table(spark, 5000)
    v = t.where("start % 50 = 1").drop("v").withColumn("id", F.col("start")).unionByName(
        t.limit(1).drop("v").withColumns({"id": F.lit(-1).cast("long"), "reference": F.lit(None).cast("string")}))
    rows = lambda d: sorted(map(str, d.collect()))
    plain = rows(v.join(t, KEY, "left").select(*v.columns, "v"))
    for sketch in (True, False):
        for limits in (SHUFFLED, Limits(max_variant_rows=0, max_sketch_bytes=0)):
            out = annotate_by_key(v, [t], strategy="keys", sketch=sketch, limits=limits)
            assert rows(out.select(*v.columns, "v")) == plain
