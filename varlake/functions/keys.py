"""Variant key, missing-value marker, tolerant casts and chromosome order.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen.  ANSI mode is assumed on: text read from VCF
or TSV is cast with ``try_cast`` so that ``-`` / ``.`` / ``''`` become NULL
instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The four-column variant key and the text written for a missing
# value, as the reference uses them.
KEY = ["chromosome", "start", "reference", "alternate"]
MISSING = "-"

# Column names of the first VCF fields and the names the
# annotation step gives them.
VCF_TO_KEY = {
    "#CHROM": "chromosome",
    "POS": "start",
    "REF": "reference",
    "ALT": "alternate",
    "QUAL": "quality",
}


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: str | Column) -> Column:
    """The ``-`` placeholder (and the empty string) read back as NULL."""
    c = col_of(c)
    return F.when(c.isin(MISSING, ""), F.lit(None)).otherwise(c)


def to_double(c: str | Column) -> Column:
    """Text or number to double; anything unparsable is NULL."""
    return col_of(c).try_cast("double")


def to_long(c: str | Column) -> Column:
    """Text or number to bigint; anything unparsable is NULL."""
    return col_of(c).try_cast("bigint")


def strip_chr(c: str | Column = "chromosome") -> Column:
    """X11: ``chr1`` -> ``1``; names without the prefix are unchanged."""
    c = col_of(c)
    return F.when(c.startswith("chr"), F.regexp_replace(c, "^chr", "")).otherwise(c)


def with_variant_key(df: DataFrame) -> DataFrame:
    """F19 for the first VCF fields, X11 on the contig and ``start`` as bigint."""
    present = {k: v for k, v in VCF_TO_KEY.items() if k in df.columns}
    if present:
        df = df.withColumnsRenamed(present)
    return df.withColumns(
        {"chromosome": strip_chr("chromosome"), "start": to_long("start")}
    )


# Contigs that the chromosome order places first, in order.
PRIMARY_CONTIGS = [str(i) for i in range(1, 23)] + ["X", "Y"]


def chromosome_rank(c: str | Column = "chromosome") -> Column:
    """Text key that sorts 1..22, X, Y and then every other contig.

    Numbers are zero padded to two characters and X/Y get the prefix ``2``,
    so ``01 < … < 22 < 2X < 2Y``.  Other contigs are prefixed with ``~`` so
    they sort after Y by their full name (a two-character cut would mix them).
    """
    c = col_of(c)
    upper = F.upper(c)
    return (
        F.when(upper.isin("X", "Y"), F.concat(F.lit("2"), upper))
        .when(c.rlike("^[0-9]$"), F.concat(F.lit("0"), c))
        .when(c.rlike("^[0-9][0-9]$") & c.isin(*PRIMARY_CONTIGS), c)
        .otherwise(F.concat(F.lit("~"), c))
    )
