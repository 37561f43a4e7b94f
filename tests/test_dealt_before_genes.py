"""Rows are dealt to their genomic bin before broadcast gene lookups, so the columns that
these add are not shuffled."""

from varlake.config import Limits
from varlake.operators.bins import genomic_bins
from varlake.operators.genes import attach_by_gene
from varlake.operators.joins import left_join_lookup
from varlake.operators.ordering import chromosome_order, dealt_to_bins, sorted_in_bins


def _joined_after_exchange(df):
    """Whether the optimized plan has a join above the exchange by bins."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.index("Join") < plan.index("RepartitionByExpression")


def test_gene_columns_join_after_the_exchange(spark):
    v = spark.createDataFrame([("1", 5 + i % 7, f"g{i % 3}", i) for i in range(60)] + [(None, None, None, 60)],
                              "chromosome string, start long, g string, id long")
    genes = spark.createDataFrame([("g0", "wide"), ("g1", "text"), ("g1", "again")], "k string, disease string")
    bins = genomic_bins(v, rows_per_bin=20)
    attach = lambda df, lim: left_join_lookup(df, genes, {"g": "k"}, limits=lim)
    wanted = [tuple(r) for r in chromosome_order(attach(v, Limits()), tie_break_columns=v.columns).collect()]
    for small, limits, before in ((True, Limits(), True), (False, Limits(), True),
                                  (False, Limits(max_broadcast_rows=0), False)):
        out = attach_by_gene(v, v, ["g"], attach, all_small=small,
                             deal=lambda df: dealt_to_bins(df, bins, v.columns), limits=limits)
        assert _joined_after_exchange(out) == before
        got = [tuple(r) for r in sorted_in_bins(out).select(*v.columns, "disease").collect()]
        assert [r[:2] for r in got] == [r[:2] for r in wanted]
        assert sorted(map(str, got)) == sorted(map(str, wanted))
