"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text are a group.  Groups sorted by size, largest first, each
enter the bin with the least room that holds them, found in a balanced tree of
the bins' room.  The capacity is the least at which the wished number of bins
suffices, so sizes come out nearly equal.

Only sizes are packed on the driver, and few: groups of over a
``LARGE``-th of a shard are items of their own (at most ``LARGE`` for each
shard); smaller groups are first tied into parcels by a hash of the text, most
of them coarse and some fine, to fill the bins' last room.  A group is never
parted, whichever it goes with.

Defined cases: null and empty texts are one group, of 16 bytes a row.  An
empty table gives an empty result.  Rows equal in doc_id and text are numbered
apart.  A null doc_id sorts first.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import gapless_rank, salts_for, written

OVERHEAD = 16
LARGE = 250  # a group of over a LARGE-th of a shard is packed by itself
PARCELS = 64  # coarse parcels for each shard; finer ones hold an eighth each
FINENESS = 4


class RoomTree:
    """AVL tree of (room, bin), for the smallest room that holds an item."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None  # nodes are [key, left, right, height]

    @staticmethod
    def _height(node) -> int:
        return node[3] if node else 0

    def _level(self, node):
        node[3] = 1 + max(self._height(node[1]), self._height(node[2]))
        lean = self._height(node[1]) - self._height(node[2])
        if abs(lean) < 2:
            return node
        heavy, light = (1, 2) if lean > 0 else (2, 1)
        child = node[heavy]
        if self._height(child[light]) > self._height(child[heavy]):
            node[heavy] = child = self._turn(child, light, heavy)
        return self._turn(node, heavy, light)

    def _turn(self, node, heavy: int, light: int):
        up = node[heavy]
        node[heavy], up[light] = up[light], node
        for n in (node, up):
            n[3] = 1 + max(self._height(n[1]), self._height(n[2]))
        return up

    def add(self, key) -> None:
        def into(node):
            if node is None:
                return [key, None, None, 1]
            side = 1 if key < node[0] else 2
            node[side] = into(node[side])
            return self._level(node)

        self.root = into(self.root)

    def remove(self, key) -> None:
        def out_of(node, key):
            if key != node[0]:
                side = 1 if key < node[0] else 2
                node[side] = out_of(node[side], key)
            elif node[1] is None or node[2] is None:
                return node[1] or node[2]
            else:
                next_up = node[2]
                while next_up[1]:
                    next_up = next_up[1]
                node[0] = next_up[0]
                node[2] = out_of(node[2], next_up[0])
            return self._level(node)

        self.root = out_of(self.root, key)

    def tightest(self, size: int):
        """The smallest (room, bin) with room for ``size``, or None."""
        node, best = self.root, None
        while node:
            if node[0][0] >= size:
                node, best = node[1], node[0]
            else:
                node = node[2]
        return best


def best_fit(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each size (which must be in descending order); None if over
    ``most`` bins would be needed."""
    tree, where, bins = RoomTree(), [], 0
    for size in sizes:
        room = tree.tightest(size)
        if room is None:
            if size > capacity or bins == most:
                return None
            room, bins = (capacity, bins), bins + 1
        else:
            tree.remove(room)
        tree.add((room[0] - size, room[1]))
        where.append(room[1])
    return where


def pack_into(sizes: list[int], shards: int) -> list[int]:
    """Bins 0 to ``shards - 1`` for sizes in descending order, at the least
    capacity that best fit needs, as found by halving.  A size above the even
    share of what is left has a bin to itself, so the others stay even."""
    if not sizes:
        return []
    if shards > 1 and sizes[0] * shards > sum(sizes):
        return [0, *(1 + w for w in pack_into(sizes[1:], shards - 1))]
    low = max(-(-sum(sizes) // shards), sizes[0])
    where, high = None, low
    while where is None:
        where = best_fit(sizes, high, shards)
        step = max(1, low // 2048)
        if where is None:
            low, high = high + 1, high + step
    while low < high:
        middle = (low + high) // 2
        better = best_fit(sizes, middle, shards)
        if better is None:
            low = middle + 1
        else:
            where, high = better, middle
    return where


def _parcel(shards: int):
    """A group's parcel number by its text hash: three quarters of the hash
    values go to coarse parcels, the rest to ever finer ones."""
    h = F.pmod(F.col("__g1"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    wide = float(shards * PARCELS)
    expr, begin, number = F.when(h < 0, F.lit(0)), 0.0, 0
    for level in range(FINENESS):
        share = 0.75 * 0.25**level if level < FINENESS - 1 else 1.0 - begin
        inside = F.floor((h - begin) / share * wide)
        expr = expr.when(h < begin + share + 1e-12, number + inside)
        begin, number = begin + share, number + int(wide)
    return expr.otherwise(number - 1).cast("long")


def shard_by_size(docs: DataFrame, shards: int) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    rows = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("__g1"), F.xxhash64(F.lit("second"), text).alias("__g2")))
    key = ["__g1", "__g2"]
    groups = written(rows.groupBy(*key).agg(
        F.sum("size").alias("__bytes"), F.count(F.lit(1)).alias("__n")))
    total, n = groups.agg(F.sum("__bytes"), F.sum("__n")).first()
    large = (total or 0) // (shards * LARGE)
    parcelled = groups.where(F.col("__bytes") <= large).groupBy(
        _parcel(shards).alias("__parcel")).agg(F.sum("__bytes").alias("__bytes"))
    # At most shards * LARGE large groups, shards * PARCELS * FINENESS parcels.
    items = [(-r["__bytes"], 0, r["__g1"], r["__g2"])
             for r in groups.where(F.col("__bytes") > large).collect()]
    items += [(-r["__bytes"], 1, r["__parcel"], 0) for r in parcelled.collect()]
    items.sort()
    where = pack_into([-x[0] for x in items], shards)
    spark = docs.sparkSession
    alone = [(x[2], x[3], w) for x, w in zip(items, where) if not x[1]]
    tied = [(x[2], w) for x, w in zip(items, where) if x[1]]
    own = F.broadcast(spark.createDataFrame(alone, "__g1 long, __g2 long, __own int"))
    together = F.broadcast(spark.createDataFrame(tied, "__parcel long, __tied int"))
    placed = (
        rows.join(own, key, "left").withColumn("__parcel", _parcel(shards))
        .join(together, "__parcel", "left")
        .select("doc_id", "size", "text_crc32", "__g1", "__g2",
                F.coalesce("__own", "__tied").alias("shard"))
    )
    return gapless_rank(written(placed), ["shard"], ["doc_id", "__g1", "__g2"], "slot",
                        salts_for(n or 0, 50_000)).select(
                            "doc_id", "size", "text_crc32", "shard", "slot")
