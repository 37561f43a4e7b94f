"""varlake: variant annotation and filtering as Spark DataFrame plans.

operators they compose live in :mod:`varlake.operators`, the column
expressions in :mod:`varlake.functions`, readers and writers in
:mod:`varlake.sources`.
"""

from varlake.config import DEFAULT_LIMITS, Limits, build_session
from varlake.functions.keys import KEY
from varlake.operators.panels import annotate_gene_group, attach_gene_list
from varlake.plans.annovar import AnnovarTables, filter_annovar
from varlake.plans.vcf_table import vcf_to_table, vcf_transcripts
from varlake.plans.vep import VepTables, filter_vep
from varlake.sources.tables import (
    read_annotation,
    read_gene_panel,
    read_goi_list,
    read_variant_tsv,
    write_result,
    write_vcf_body,
)
from varlake.sources.vcf import read_vcf, vcf_schema

__all__ = [
    "KEY", "Limits", "DEFAULT_LIMITS", "build_session",
    "read_vcf", "vcf_schema", "vcf_to_table", "vcf_transcripts",
    "VepTables", "filter_vep", "AnnovarTables", "filter_annovar",
    "annotate_gene_group", "attach_gene_list",
    "read_variant_tsv", "read_annotation", "read_gene_panel", "read_goi_list",
    "write_result", "write_vcf_body",
]
