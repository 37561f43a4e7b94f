"""Gene tables looked up once for each pair of gene ids."""

from conftest import SF_SMALL
from varlake.plans.catalog import stored_filter_vep, vep_tables
from varlake.plans.vep import filter_vep
from varlake.sources.fixtures import fixture


def test_one_gene_join_in_the_plan(spark):
    v, tables = fixture(spark, SF_SMALL, "fx_variants"), vep_tables(spark, SF_SMALL)

    def joins(**options):
        plan = stored_filter_vep(v, tables, sort=False, **options)
        return plan._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")

    # HGMD, its gene reference, CGC, OMIM, Orphanet and GenCC against one join.
    assert joins() - joins(genes_once=True) >= 4


def test_two_symbols_for_one_pair_and_pairs_without_ids(spark):
    tables = vep_tables(spark, SF_SMALL)
    pair = tables.genes.where("hgnc IS NOT NULL AND ensembl_gene_id IS NOT NULL").limit(1).collect()[0]
    hgmd = tables.hgmd_gene.where(tables.hgmd_gene.entrez_gene_id == pair["entrez_gene_id"])
    from dataclasses import replace
    from pyspark.sql import functions as F

    twice = replace(tables, hgmd_gene=tables.hgmd_gene.unionByName(
        hgmd.withColumn("DM", F.array(F.lit("another disease")))))
    first = fixture(spark, SF_SMALL, "fx_variants").limit(6).collect()
    rows = [{**r.asDict(), "CSQ_HGNC_ID": h, "CSQ_Gene": g, "CSQ_Consequence": "missense_variant"}
            for r, (h, g) in zip(first, [(pair["hgnc"], pair["ensembl_gene_id"]), (pair["hgnc"], None),
                                         (None, pair["ensembl_gene_id"]), (None, None), ("-", "-"),
                                         (pair["hgnc"], pair["ensembl_gene_id"])])]
    v = spark.createDataFrame(rows, fixture(spark, SF_SMALL, "fx_variants").schema)
    got = [sorted(str(tuple(r)) for r in filter_vep(v, twice, genes_once=once, sort=False).collect())
           for once in (False, True)]
    assert got[0] == got[1] and len(got[0]) >= 6
