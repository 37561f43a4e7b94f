"""What a pipeline counts and probes before it joins is cheap: keys are counted in the rows
before repeats are dropped, a derived key is hashed once, large tables aren't measured in bytes."""

from collections import Counter

from conftest import SF_SMALL
from pyspark.sql import functions as F
from varlake.config import Limits
from varlake.functions.keys import KEY
from varlake.operators import genes as G
from varlake.operators import joins as J
from varlake.operators.joins import annotate_by_key, measured
from varlake.operators.sketches import key_sketch, maybe_among
from varlake.plans.catalog import stored_filter_vep, vep_tables
from varlake.sources.fixtures import fixture

KEYED = "chromosome string, start long, reference string, alternate string, v long"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_derived_key_is_hashed_once(spark):
    t = spark.range(3000).select(
        F.concat(F.lit("c"), F.col("id") % 7).alias("chromosome"), (F.col("id") * 3).alias("start"),
        F.when(F.col("id") % 50 != 0, F.lit("A")).alias("reference"), F.lit("C").alias("alternate"), "id")
    keys = t.where("id < 300").select(*KEY)
    left = maybe_among(t, KEY, key_sketch(keys, KEY, 1 << 20))
    assert plan_of(left).count("xxhash64(") <= 2  # the table's and the keys'
    ids = {r["id"] for r in left.collect()}
    assert {i for i in range(300) if i % 50} <= ids and len(ids) < 500
    assert not any(i % 50 == 0 for i in ids)


def test_keys_are_counted_before_repeats_are_dropped(spark, monkeypatch):
    made = []
    for module in (J, G):
        plain = module.written
        monkeypatch.setattr(module, "written", lambda df, plain=plain: (made.append(plan_of(df)), plain(df))[1])
    v = fixture(spark, SF_SMALL, "fx_variants")
    stored_filter_vep(v, vep_tables(spark, SF_SMALL), strategy="keys", limits=Limits(max_broadcast_rows=0))
    counted = [p for p in made if "count(1)" in p and "collect_set" not in p]
    assert len(counted) == 2  # variant keys and genes
    assert all(p.count("Aggregate") == 1 for p in counted)


def test_counts_of_more_rows_give_the_same_annotation(spark):
    rows = [("1", i % 5, "A", "C", i % 10) for i in range(200)] + [(None, 1, "A", "C", 3)]
    some = spark.createDataFrame(rows, KEYED)
    variants = some.distinct()
    table = spark.createDataFrame([("1", 2, "A", "C", 7), ("1", 2, "A", "C", 8), ("1", 9, "A", "C", 9)],
                                  KEYED.replace(" v ", " w "))
    want = Counter(map(str, annotate_by_key(variants, [table], strategy="plain").collect()))
    for strategy in ("keys", "reduce"):
        for hot in (3, 1_000_000):
            got = annotate_by_key(variants, [table], strategy=strategy, counted=some,
                                  limits=Limits(hot_key_rows=hot))
            assert Counter(map(str, got.collect())) == want


def test_bytes_of_large_frames_are_not_measured(spark):
    df = spark.createDataFrame([("x" * 100, ["y"])] * 10, "a string, b array<string>")
    whole = measured({"df": df})["df"]
    assert whole[0] == 10 and whole[1] > 1000
    got = measured({"small": df, "large": df, "other": df}, {"small": 10, "large": 9})
    assert got == {"small": whole, "large": (10, 160), "other": whole}
    assert measured({"large": df}, {"large": 9}) == {"large": (10, 160)}
