"""The survey's lifecycle in one session: VCF text -> QC and flattening ->
VEP filtering -> gene-panel label -> written table, with no intermediate file."""

import glob
import os

from conftest import SF_SMALL
from varlake.operators.panels import annotate_gene_group
from varlake.plans import catalog
from varlake.plans.vcf_table import vcf_to_table
from varlake.plans.vep import filter_vep
from varlake.sources.fixtures import fixture
from varlake.sources.tables import read_variant_tsv, write_result


def test_vcf_to_labelled_table(spark, tmp_out):
    flat = vcf_to_table(catalog.vcf_input(spark, SF_SMALL))
    result = filter_vep(flat, catalog.vep_tables(spark, SF_SMALL),
                        optional_columns=["CSQ_Gene", "CSQ_HGNC_ID", "CSQ_gnomAD_AF",
                                          "INFO_gnomad_3_1_1_AF"])
    labelled = annotate_gene_group(result, fixture(spark, SF_SMALL, "fx_list_ecpg"),
                                   fixture(spark, SF_SMALL, "fx_list_emgp"))
    # every flattened record with a kept consequence survives (left joins only)
    kept = flat.where(flat["CSQ_Consequence"].isin("missense_variant", "splice_donor_variant",
                                                   "stop_gained", "frameshift_variant"))
    n = labelled.count()
    assert n == kept.dropDuplicates().count() and n > 0
    assert set(r["gene_group"] for r in labelled.select("gene_group").distinct().collect()) <= {
        "ECPG/EMGP", "ECPG", "EMGP", "-"}
    out = os.path.join(tmp_out, "res")
    write_result(labelled, out)
    assert glob.glob(out + "/part-*.csv.gz")
    assert read_variant_tsv(spark, out).count() == n
