"""Record-level quality control on VCF records.

All predicates are column expressions over the split record (see
:func:`varlake.sources.vcf.vcf_records`); a missing or unparsable value is
NULL through ``try_cast`` and each rule states what NULL means.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.functions.keys import to_double
from varlake.functions.vcf import InfoParts, format_value, info_has, info_number, info_value

# Contig pattern of the primary assembly (case-insensitive).
PRIMARY_CONTIG_PATTERN = "(?i)^chr[0-9XY]+$"
# FILTER value of a passing site and the INFO flag of targeted
# calls that are dropped.
PASS = "PASS"
TARGETED = "TARGETED"
# Genotype depth and quality minimums.
MIN_DP = 10.0
MIN_GQ = 20.0


@dataclass(frozen=True)
class SiteThresholds:
    """Site-QC thresholds; a site fails on QD < qd_min,
    FS > fs_max, MQ < mq_min, MQRankSum <= mqranksum_max,
    ReadPosRankSum <= readposranksum_max, SOR > sor_max."""

    qd_min: float = 2.0
    fs_max: float = 60.0
    mq_min: float = 40.0
    mqranksum_max: float = -12.5
    readposranksum_max: float = -8.0
    sor_max: float = 3.0


DEFAULT_THRESHOLDS = SiteThresholds()


def has_csq(info: str | Column = "INFO", key: str = "CSQ") -> Column:
    """F1 predicate: the record carries a non-empty CSQ value."""
    return info_value(info, key, missing_dot=False).isNotNull()


def primary_contig(chrom: str | Column = "#CHROM") -> Column:
    """F2 predicate: ``chr<digits>``, ``chrX``, ``chrY`` (any case)."""
    c = F.col(chrom) if isinstance(chrom, str) else chrom
    return F.coalesce(c.rlike(PRIMARY_CONTIG_PATTERN), F.lit(False))


def passes_filter(drop_targeted: bool = True, targeted: Column | None = None) -> Column:
    """F3 predicate: FILTER is PASS (and, by default, no TARGETED flag, which ``targeted``
    says where INFO is split already)."""
    ok = F.coalesce(F.col("FILTER") == F.lit(PASS), F.lit(False))
    if drop_targeted:
        ok = ok & ~(info_has("INFO", TARGETED) if targeted is None else targeted)
    return ok


def first_sample() -> Column:
    return F.col("sample1")


def depth_quality_ok(dp: float = MIN_DP, gq: float = MIN_GQ, sample: Column | None = None,
                     value: Callable[[str], Column] | None = None) -> Column:
    """F4 predicate: DP >= dp and GQ >= gq in the (first) sample; a missing or
    non-numeric value fails.  ``value`` gives a key's value where the sample is split already."""
    s = first_sample() if sample is None else sample
    value = value or (lambda key: format_value("FORMAT", s, key))
    d, g = to_double(value("DP")), to_double(value("GQ"))
    return F.coalesce((d >= F.lit(dp)) & (g >= F.lit(gq)), F.lit(False))


def site_ok(t: SiteThresholds = DEFAULT_THRESHOLDS,
            metric: Callable[[str], Column] | None = None) -> Column:
    """F5 predicate: every present site metric within its threshold; an
    absent key or a ``.`` value passes.  ``metric`` gives a key's number where INFO is
    split already."""
    metric = metric or (lambda key: info_number("INFO", key))
    rules = [
        metric("QD") >= F.lit(t.qd_min),
        metric("FS") <= F.lit(t.fs_max),
        metric("MQ") >= F.lit(t.mq_min),
        metric("MQRankSum") > F.lit(t.mqranksum_max),
        metric("ReadPosRankSum") > F.lit(t.readposranksum_max),
        metric("SOR") <= F.lit(t.sor_max),
    ]
    ok = F.lit(True)
    for r in rules:
        ok = ok & F.coalesce(r, F.lit(True))
    return ok


def site_qc(
    records: DataFrame,
    *,
    mode: str = "drop",
    require_csq: bool = True,
    primary_only: bool = True,
    drop_targeted: bool = True,
    min_dp: float = MIN_DP,
    min_gq: float = MIN_GQ,
    thresholds: SiteThresholds = DEFAULT_THRESHOLDS,
    csq_key: str = "CSQ",
    sample_rule: str = "any",
) -> DataFrame:
    """Record quality control.

    The depth/quality rule (F4) is one of a sample: with ``sample_rule='any'``
    a record passes it if one of its samples does (a single-sample record: if
    its sample does); with ``'none'`` it is left to :func:`sample_qc`, which
    judges each (record, sample).

    ``mode='drop'`` removes records failing any rule; ``mode='flag'`` keeps
    records failing only the depth/quality (F4) or site (F5) rules and marks
    them ``Flagged = 1`` (others 0).  Records without CSQ are dropped unless
    ``require_csq=False``.
    """
    df = InfoParts.of(records)
    if require_csq:
        df = df.where(InfoParts.value(csq_key, missing_dot=False).isNotNull())
    if primary_only:
        df = df.where(primary_contig("#CHROM"))
    df = df.where(passes_filter(drop_targeted, InfoParts.has(TARGETED)))
    good = site_ok(thresholds, InfoParts.number)
    if sample_rule == "any":
        one = depth_quality_ok(min_dp, min_gq)
        if "samples" in records.columns:
            several = F.exists("samples", lambda s: depth_quality_ok(min_dp, min_gq, s))
            one = F.when(F.size("samples") <= 1, one).otherwise(several)
        good = one & good
    elif sample_rule != "none":
        raise ValueError("sample_rule must be 'any' or 'none'")
    if mode == "drop":
        return InfoParts.dropped(df.where(good))
    if mode == "flag":
        return InfoParts.dropped(df.withColumn("Flagged", F.when(good, 0).otherwise(1)))
    raise ValueError("mode must be 'drop' or 'flag'")


def sample_qc(
    rows: DataFrame,
    sample: Column,
    *,
    mode: str = "drop",
    min_dp: float = MIN_DP,
    min_gq: float = MIN_GQ,
    value: Callable[[str], Column] | None = None,
) -> DataFrame:
    """F4 and its flag on rows of one sample each (``sample``: its column of
    the record): fails drop the row, or set ``Flagged``."""
    good = depth_quality_ok(min_dp, min_gq, sample, value)
    if mode == "drop":
        return rows.where(good)
    return rows.withColumn("Flagged", F.when(good, F.col("Flagged")).otherwise(F.lit(1)))


def drop_star_alt(df: DataFrame, alt: str = "ALT") -> DataFrame:
    """drop records whose ALT is the spanning-deletion allele ``*``."""
    return df.where(F.coalesce(F.col(alt) != F.lit("*"), F.lit(True)))


def variant_calls_only(df: DataFrame, genotype: str) -> DataFrame:
    """F8 (single sample): drop rows whose adjusted genotype is ``./.`` or
    ``0/0``."""
    g = F.col(f"`{genotype}`")
    return df.where(g.isNull() | ~g.isin("./.", "0/0"))


def ensembl_transcripts(df: DataFrame, feature: str = "Feature") -> DataFrame:
    """keep rows whose transcript id contains ``ENST``."""
    return df.where(F.col(feature).contains("ENST"))
