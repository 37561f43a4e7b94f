"""Versions of annotation tables: keys that differ, results brought up to date."""

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from varlake.config import Limits, written
from varlake.functions.keys import KEY
from varlake.operators.differences import changed_keys
from varlake.plans import reannotate as R
from varlake.plans.catalog import arrays_as_text, vep_tables
from varlake.plans.catalog_files import older_tables
from varlake.plans.vep import filter_vep
from varlake.sources.fixtures import fixture
from varlake.sources.versions import changes_between, open_version, versions, write_version

SCHEMA = "chromosome string, start long, reference string, alternate string, a string, b string, c array<string>"


def test_changed_keys_against_brute_force(spark):
    row = lambda start, a, b, c: ("1", start, "A", "C", a, b, c)
    old = [row(1, "x", None, ["p"]), row(2, "x", "y", None), row(3, "x", "y", ["p", "q"]), row(4, "x", "y", []),
           row(5, "x", "y", []), row(5, "x", "y", []), row(6, "r", "r", []), row(7, "s", None, None),
           row(8, "u", "v", []), row(8, "w", "v", []), row(None, "n", "n", []), row(10, None, None, None)]
    new = [row(1, None, "x", ["p"]), row(2, "x", "y", None), row(3, "x", "y", ["pq"]), row(4, "x", "y", None),
           row(5, "x", "y", []), row(6, "r", "r", []), row(8, "w", "v", []), row(8, "u", "v", []),
           row(9, "t", None, None), row(None, "m", "n", []), row(11, None, None, None)]
    frames = [spark.createDataFrame(r, SCHEMA) for r in (old, new)]
    got = {r["start"] for r in changed_keys({"t": frames[0]}, {"t": frames[1]}).collect()}
    bags = []
    for rows in (old, new):
        bag = {}
        for r in rows:
            bag.setdefault(r[1], Counter())[str(r)] += 1
        bags.append(bag)
    want = {k for k in bags[0] | bags[1] if k is not None and bags[0].get(k) != bags[1].get(k)}
    assert got == want == {1, 3, 4, 5, 7, 9, 10, 11}
    with_null = changed_keys({"t": frames[0]}, {"t": frames[1]}, null_keys=True).collect()
    assert {r["start"] for r in with_null} == want | {None}
    only_new = changed_keys({}, {"t": frames[1]}, by_table=True).collect()
    assert {(r["table"], r["start"]) for r in only_new} == {("t", k) for k in bags[1] if k is not None}


def text(df):
    return sorted(str(tuple(r)) for r in arrays_as_text(df).collect())


@pytest.mark.parametrize("source, limits", [("vep", Limits()), ("dragon", Limits()),
                                            ("vep", Limits(max_broadcast_rows=0, hot_key_rows=50))])
def test_equals_a_full_run_and_works_out_changed_variants_only(spark, monkeypatch, source, limits):
    v = fixture(spark, SF_SMALL, "fx_variants")
    new = vep_tables(spark, SF_SMALL, dragon=source == "dragon")
    # Few keys and few genes change, so most variants must keep their rows.
    old = replace(older_tables(new), gencc=new.gencc, orphanet_gene=new.orphanet_gene,
                  omim_gene=new.omim_gene.where(F.pmod(F.xxhash64("entrez_gene_id"), F.lit(20)) != 0),
                  dbsnp=new.dbsnp)
    before = written(filter_vep(v, old, source=source, sort=False))
    seen = []
    plain = R.filter_vep
    monkeypatch.setattr(R, "filter_vep", lambda df, *a, **k: (seen.append(df.count()), plain(df, *a, **k))[1])
    after = R.reannotate(before, v, old, new, source=source, limits=limits)
    assert text(after) == text(filter_vep(v, new, source=source, sort=False))
    assert text(after) != text(before)
    assert 0 < seen[0] < v.count() / 2


def test_nothing_changed_and_tables_that_appear(spark, monkeypatch):
    v, new = fixture(spark, SF_SMALL, "fx_variants"), vep_tables(spark, SF_SMALL)
    before = written(filter_vep(v, new, sort=False))
    seen = []
    plain = R.filter_vep
    monkeypatch.setattr(R, "filter_vep", lambda df, *a, **k: (seen.append(df.count()), plain(df, *a, **k))[1])
    assert text(R.reannotate(before, v, new, new)) == text(before)
    assert seen == [0]
    with pytest.raises(ValueError, match="clinvar"):
        R.reannotate(before, v, replace(new, clinvar=None), new)


def test_versions_of_a_store(spark, tmp_out):
    path = f"{tmp_out}/store"
    assert versions(spark, path) == {}
    with pytest.raises(ValueError, match="no version"):
        open_version(spark, path)
    t = spark.createDataFrame([("1", i, "A", "C", i) for i in range(50)],
                              "chromosome string, start long, reference string, alternate string, v long")
    second = t.where("start < 40").withColumn("v", F.when(F.col("start") == 3, -1).otherwise(F.col("v")))
    for n, tables in enumerate([{"t": t}, {"t": second}, {"t": second, "u": t.where("start = 7")}], 1):
        assert write_version(tables, path, 2) == n
    assert open_version(spark, path, 1).table("t").count() == 50
    assert open_version(spark, path).table("t").count() == 40
    found = lambda a, b: {(r["table"], r["start"]) for r in changes_between(spark, path, a, b).collect()}
    assert found(1, 2) == {("t", 3)} | {("t", i) for i in range(40, 50)}
    assert found(2, 3) == {("u", 7)}
    assert found(1, 3) == found(1, 2) | found(2, 3)
    with pytest.raises(ValueError):
        changes_between(spark, path, 2, 2)
