"""Row predicates and flags on the flattened variant table.

VCF-level quality filters (F1-F9) live in :mod:`varlake.operators.vcf_qc`.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.functions.keys import col_of, to_double
from varlake.functions.values import damage_ratio

# VEP consequence terms kept as protein-affecting, in the
# reference's order.
VEP_CONSEQUENCES = [
    "transcript_ablation",
    "splice_acceptor_variant",
    "splice_donor_variant",
    "stop_gained",
    "frameshift_variant",
    "stop_lost",
    "start_lost",
    "transcript_amplification",
    "inframe_insertion",
    "inframe_deletion",
    "missense_variant",
    "protein_altering_variant",
    "splice_region_variant",
    "incomplete_terminal_codon_variant",
    "start_retained_variant",
    "stop_retained_variant",
    "coding_sequence_variant",
]

# ANNOVAR exonic functions kept, in the reference's order.
ANNOVAR_EXONIC_FUNCTIONS = [
    "frameshift_insertion",
    "frameshift_deletion",
    "frameshift_block_substitution",
    "stopgain",
    "stoploss",
    "nonframeshift_insertion",
    "nonframeshift_deletion",
    "nonframeshift_block_substitution",
    "nonsynonymous_SNV",
]

# Default thresholds of the reference.
VEP_MAF = 0.001
ANNOVAR_MAF = 0.0001
DAMAGE_RATIO_LOW = 0.5
DAMAGE_RATIO_HIGH = 1.0


def consequence_kept(
    c: str | Column = "CSQ_Consequence",
    terms: Sequence[str] = VEP_CONSEQUENCES,
    split_terms: bool = False,
) -> Column:
    """F10 predicate.  Exact match by default, so ``a&b`` never matches (as
    in the reference); ``split_terms=True`` keeps a row if any ``&`` part
    matches."""
    c = col_of(c)
    if not split_terms:
        return c.isin(list(terms))
    arr = F.array(*[F.lit(t) for t in terms])
    return F.exists(F.split(c, "&"), lambda t: F.array_contains(arr, t))


def keep_consequences(
    df: DataFrame,
    terms: Sequence[str] = VEP_CONSEQUENCES,
    column: str = "CSQ_Consequence",
    split_terms: bool = False,
) -> DataFrame:
    """keep protein-affecting consequences."""
    return df.where(consequence_kept(column, terms, split_terms))


def exonic_or_splicing(
    func: str | Column = "Func_refGene",
    exonic_func: str | Column = "ExonicFunc_refGene",
    terms: Sequence[str] = ANNOVAR_EXONIC_FUNCTIONS,
) -> Column:
    """F12 predicate: (Func contains ``exonic`` and ExonicFunc in ``terms``)
    or Func is ``splicing``."""
    func, exonic_func = col_of(func), col_of(exonic_func)
    return (func.contains("exonic") & exonic_func.isin(list(terms))) | (
        func == F.lit("splicing")
    )


def keep_exonic_or_splicing(df: DataFrame, terms: Sequence[str] = ANNOVAR_EXONIC_FUNCTIONS) -> DataFrame:
    """keep exonic protein-changing or splicing ANNOVAR rows."""
    return df.where(exonic_or_splicing(terms=terms))


def flag_rare(df: DataFrame, maf: float, freq: str = "max_gtar",
              out: str = "flag_keep") -> DataFrame:
    """``flag_keep`` = 1 if the maximum frequency is at most ``maf``."""
    return df.withColumn(out, F.when(F.col(freq) <= F.lit(maf), 1).otherwise(0))


def flag_damaging(
    df: DataFrame,
    low: float = DAMAGE_RATIO_LOW,
    high: float = DAMAGE_RATIO_HIGH,
    ratio: str = "PredCountRatio_D2T",
    flag: str = "flag_keep",
    require_damaging: bool = False,
) -> DataFrame:
    """F16: damage-ratio clause on the flag, both ends inclusive.

    As in the reference the clause only sets the flag to 1 where it already
    is 1, so by default the flag is unchanged.  ``require_damaging=True``
    applies the stated intent instead: the flag stays 1 only where the ratio
    is known and inside ``[low, high]``.
    """
    if require_damaging:
        r = F.col(ratio)
        inside = r.isNotNull() & (r >= F.lit(low)) & (r <= F.lit(high))
        return df.withColumn(flag, F.when((F.col(flag) == 1) & inside, 1).otherwise(0))
    return df


def with_damage_ratio(dbnsfp: DataFrame) -> DataFrame:
    """X14 on the dbNSFP table: adds ``PredCountRatio_D2T``."""
    return dbnsfp.withColumn("PredCountRatio_D2T", damage_ratio("DamagePredCount"))


def drop_dotted(df: DataFrame) -> DataFrame:
    """drop columns whose name contains a dot."""
    return df.select([F.col(f"`{c}`") for c in df.columns if "." not in c])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """rename the columns of ``mapping`` that exist."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df
