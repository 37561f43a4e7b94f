"""A sketch of a set of keys, tested in scan tasks before a shuffle.

The sketch is a Bloom filter in pieces: a key's hash names one bitmap of
``BITMAP_BITS`` bits and two bits in it.  Spark's bitmap aggregates build the
bitmaps, a piece each row, and a table is filtered by a broadcast join on the
piece and a test of the two bits in the piece's words.  Rows of keys in the set always stay; of
other rows about one in seventy does, so an exact join must follow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAP_BITS = 32_768  # of the bitmaps that Spark's aggregates build
BITMAP_BYTES = BITMAP_BITS // 8
BITS_PER_KEY = 16

HASH, PIECE, BITS = "__key_hash", "__piece", "__bits"


def _hashed(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``df`` plus ``HASH``, NULL for keys with a NULL.  It is worked out once for a
    row, as a generator's output: Catalyst would put a derived key's expressions in
    each place that reads it, and in the join's null checks."""
    columns = [F.col(f"`{k}`") for k in key]
    known = F.lit(True)
    for c in columns:
        known = known & c.isNotNull()
    return df.select("*", F.explode(F.array(F.when(known, F.xxhash64(*columns)))).alias(HASH))


def _places(pieces: int) -> tuple[Column, Column, Column]:
    """Piece and the two bits of a row's ``HASH``."""
    h = F.col(HASH)
    bit = lambda shift: F.pmod(F.shiftrightunsigned(h, shift), F.lit(BITMAP_BITS)).cast("int")
    return F.pmod(F.shiftrightunsigned(h, 30), F.lit(pieces)).cast("int"), bit(0), bit(15)


def key_sketch(keys: DataFrame, key: Sequence[str], max_bytes: int) -> DataFrame | None:
    """The sketch of ``keys`` (rows of ``key`` columns, no repeats needed), or
    None if it would take more than ``max_bytes``.  Counts ``keys`` first."""
    pieces = -(-keys.count() * BITS_PER_KEY // BITMAP_BITS) or 1
    if pieces * BITMAP_BYTES > max_bytes:
        return None
    piece, first, second = _places(pieces)
    bits = _hashed(keys, key).select(piece.alias(PIECE), F.explode(F.array(first, second)).alias("__bit")).where(
        F.col(PIECE).isNotNull())
    # Keys are dealt by piece before bitmaps are built: each is built once, not
    # once in every task.
    made = bits.repartition(PIECE).groupBy(PIECE).agg(F.bitmap_construct_agg("__bit").alias(BITS))
    found = made.select(PIECE, _words(F.col(BITS)).alias(BITS))
    found.sketch_pieces = pieces
    return found


def _words(bitmap: Column) -> Column:
    """A bitmap as an array of longs, 8 bytes each: a row is tested by one of them,
    where a binary value would be copied whole."""
    text = F.hex(bitmap)
    half = lambda at: F.conv(F.substring(text, at + 1, F.lit(8)), 16, 10).cast("long")
    return F.transform(F.sequence(F.lit(0), F.lit(BITMAP_BYTES // 8 - 1)), lambda i: F.shiftleft(
        half(i * 16), 32).bitwiseOR(half(i * 16 + 8)))


def _is_set(words: Column, bit: Column) -> Column:
    # A word's first byte is its highest.
    return F.getbit(F.get(words, F.shiftright(bit, 6)), bit.bitwiseAND(63).bitwiseXOR(56))


def maybe_among(table: DataFrame, key: Sequence[str], sketch: DataFrame) -> DataFrame:
    """Rows of ``table`` whose key may be in the set of ``sketch``; those without
    a key go."""
    piece, first, second = _places(sketch.sketch_pieces)
    names = [F.col(f"`{c}`") for c in table.columns]
    held = _hashed(table, key).select(*names, piece.alias(PIECE), first.alias("__first"), second.alias("__second"))
    # At most max_bytes of bitmaps, checked when the sketch was made.
    hit = held.join(F.broadcast(sketch), PIECE)
    both = (_is_set(F.col(BITS), F.col("__first")) == 1) & (_is_set(F.col(BITS), F.col("__second")) == 1)
    return hit.where(both).select(*names)
