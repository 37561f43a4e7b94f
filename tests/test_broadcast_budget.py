"""All broadcasts of a pipeline share one budget; a mixed plan gives the same rows."""

from conftest import SF_SMALL
from varlake.config import Limits
from varlake.operators.joins import broadcast_choice, measured
from varlake.plans.catalog import arrays_as_text, fixture, vep_tables
from varlake.plans.vep import filter_vep

MB = 1 << 20


def test_small_tables_come_first_within_one_budget():
    sizes = {"a": (10, 200 * MB), "b": (10, 150 * MB), "c": (10, 90 * MB), "d": (10, 30 * MB),
             "e": (3_000_000, MB), "f": (10, 300 * MB)}
    choice = lambda total, **k: {
        n for n, yes in broadcast_choice(sizes, Limits(max_total_broadcast_bytes=total * MB), **k).items() if yes}
    assert choice(768) == {"a", "b", "c", "d"}  # e has too many rows, f too many bytes
    assert choice(300) == {"b", "c", "d"}
    assert choice(300, reserved=100 * MB) == {"c", "d"}
    assert choice(300, copies={"c": 4}) == {"b", "d"}
    assert choice(10) == set()


def test_a_mixed_plan_gives_the_same_rows(spark):
    v, tables = fixture(spark, SF_SMALL, "fx_variants"), vep_tables(spark, SF_SMALL)
    sizes = {n: b for n, (_, b) in measured({
        "omim": tables.omim_gene, "orphanet": tables.orphanet_gene, "gencc": tables.gencc,
        "cosmic": tables.cosmic, "hgmd": tables.hgmd_gene, "genes": tables.genes,
        "keys": v.select("chromosome", "start", "reference", "alternate")}).items()}
    keys = sizes.pop("keys")
    total = keys + sum(sorted(sizes.values())[:4])
    limits = Limits(max_total_broadcast_bytes=total)
    chosen = broadcast_choice({n: (1, b) for n, b in sizes.items()}, limits, reserved=keys,
                              copies={"orphanet": 2})
    assert 0 < sum(chosen.values()) < len(chosen)
    rows = lambda lim: sorted(map(str, arrays_as_text(
        filter_vep(v, tables, sort=False, write_input=False, limits=lim)).collect()))
    assert rows(limits) == rows(Limits())


def test_measured_bytes_cover_text_and_arrays(spark):
    rows = [("ab", ["x", "yz", None], 1), (None, None, None), ("é", [], 2)]
    df = spark.createDataFrame(rows, "s string, a array<string>, n long")
    (n, size), = measured({"t": df}).values()
    assert n == 3 and size == 3 * (16 + 16 + 32 + 8) + 4 + 3 * 16 + 3
    assert measured({"t": df.limit(0)}) == {"t": (0, 0)}
