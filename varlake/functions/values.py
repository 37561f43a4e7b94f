"""Scalar and array helpers used by the annotation operators.

All are column expressions; none needs Python at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varlake.functions.keys import col_of, to_double


def max_frequency(cols: Sequence[str | Column]) -> Column:
    """Largest of the given frequencies, NULLs ignored, never below 0."""
    return F.greatest(F.lit(0.0), *[to_double(c) for c in cols])


def damage_ratio(c: str | Column = "DamagePredCount") -> Column:
    """``"<damaging>_<total>"`` -> damaging / total; total 0 -> NULL."""
    parts = F.split(col_of(c), "_")
    num = to_double(F.get(parts, 0))
    den = to_double(F.get(parts, 1))
    return F.try_divide(num, den)


def rsid_number(c: str | Column = "name") -> Column:
    """Digits of ``rs<digits>`` as bigint; other names -> NULL."""
    digits = F.regexp_extract(col_of(c), r"rs(\d+)", 1)
    return digits.try_cast("bigint")


def null_if_empty_array(c: str | Column) -> Column:
    """``[]`` and ``['']`` -> NULL, other arrays unchanged."""
    c = col_of(c)
    return F.when(
        (F.size(c) == 0) | (c == F.array(F.lit(""))), F.lit(None)
    ).otherwise(c)


def hgnc_curie(c: str | Column) -> Column:
    """Numeric HGNC id -> ``HGNC:<id>``; NULL stays NULL."""
    c = col_of(c)
    return F.when(c.isNotNull(), F.concat(F.lit("HGNC:"), c.cast("string")))


def drop_empty_strings(c: str | Column) -> Column:
    """Remove ``''`` elements; an array left empty becomes NULL."""
    kept = F.filter(col_of(c), lambda x: x != F.lit(""))
    return F.when(F.size(kept) > 0, kept)


def array_to_bracket_text(c: str | Column, null_if_empty: bool = True) -> Column:
    """Array -> ``[a, b]`` (Spark's array-to-string form); ``[]`` -> NULL."""
    text = col_of(c).cast("string")
    if null_if_empty:
        return F.when(text != F.lit("[]"), text)
    return text


def stringify_nested(df: DataFrame, sep: str = ",", *, null_arrays: bool = False) -> DataFrame:
    """Struct and map columns -> JSON text, array columns -> ``sep``
    joined text, so the frame can be written as delimited text.  A NULL array
    is empty text, or stays NULL with ``null_arrays``."""
    joined = F.array_join if null_arrays else lambda a, by: F.concat_ws(by, a)
    cols = []
    for f in df.schema.fields:
        name = f"`{f.name}`"
        if isinstance(f.dataType, (T.StructType, T.MapType)):
            cols.append(F.to_json(F.col(name)).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            element = f.dataType.elementType
            if isinstance(element, (T.StructType, T.MapType, T.ArrayType)):
                as_text = F.transform(F.col(name), lambda x: F.to_json(x))
            else:
                as_text = F.transform(F.col(name), lambda x: x.cast("string"))
            cols.append(joined(as_text, sep).alias(f.name))
        else:
            cols.append(F.col(name))
    return df.select(cols)
