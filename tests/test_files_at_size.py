"""Written files and stores grow with their tables: sort keys are worked out once for a row,
not in every comparison, and a store's buckets stay a task's size."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from varlake.plans import catalog_files as C
from varlake.sources.bgzf import read_bgzf, read_region, write_vcf
from varlake.sources.fixtures import fixture
from varlake.sources.vcf import FIXED_FIELDS, vcf_records


def test_a_vcf_is_sorted_by_columns(spark, tmp_path, monkeypatch):
    contigs = ["chr2", "chr10", "chrX", "GL1", "chr2"]
    rows = [(contigs[i % 5], str((i * 37) % 1000 if i % 11 else "."), ".", "A" * (1 + i % 3), "C", ".", "PASS",
             f"N={i}", "GT", ["0/1"]) for i in range(400)]
    schema = ", ".join(f"`{c}` string" for c in FIXED_FIELDS) + ", samples array<string>"
    records = spark.createDataFrame(rows, schema)
    plans, plain = [], type(records).mapInArrow
    monkeypatch.setattr(type(records), "mapInArrow", lambda df, *a, **k: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()), plain(df, *a, **k))[1])
    header = ["##fileformat=VCFv4.2", "\t".join([*FIXED_FIELDS, "S1"])]
    write_vcf(records, header, str(tmp_path / "out"), partitions=3)
    sort = next(x for x in plans[0].splitlines() if "Sort [" in x)
    assert "CASE" not in sort and "xxhash64" not in sort
    monkeypatch.undo()
    back = vcf_records(read_bgzf(spark, f"{tmp_path}/out/*.vcf.gz"))
    assert sorted(map(tuple, back.select(*FIXED_FIELDS).collect())) == sorted(r[:9] for r in rows)
    files = sorted((tmp_path / "out").glob("part-*.vcf.gz"))
    import gzip

    text = b"".join(gzip.decompress(f.read_bytes()) for f in files).decode().splitlines()[2:]
    rank = {"chr2": 0, "chr10": 1, "chrX": 2, "GL1": 3}
    order = [(rank[f[0]], 0 if f[1] == "." else int(f[1])) for f in (x.split("\t") for x in text)]
    assert order == sorted(order) and len(order) == 400
    region = read_region(spark, str(tmp_path / "out"), "chr10", 100, 300)
    want = [r for r in rows if r[0] == "chr10" and r[1] != "." and int(r[1]) <= 300
            and int(r[1]) + len(r[3]) > 100]
    assert sorted(map(tuple, region.select(*FIXED_FIELDS).collect())) == sorted(r[:9] for r in want)


def test_buckets_of_a_store_grow_with_its_tables(spark, monkeypatch):
    buckets = lambda store: {r["buckets"] for r in spark.read.parquet(f"{store.path}/_tables").collect()}
    assert buckets(C.annotation_store(spark, SF_SMALL)) == {8}
    rows = fixture(spark, SF_SMALL, "fx_dbsnp")
    n = rows.count()
    monkeypatch.setattr(C, "BUCKET_ROWS", n // 20)
    store = C.annotation_store(spark, SF_SMALL)
    assert buckets(store) <= {20, 21}
    some = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("chromosome", "start", "name") % 1000)).first()
    assert some(store.table("dbsnp")) == some(rows)
