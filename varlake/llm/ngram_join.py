"""N-gram Jaccard self-join with Bayesian candidate pruning.

Texts are sets of five-word shingles.  Texts of equal sets form one node.
MinHash bands put nodes that may be similar into buckets, and nodes whose
buckets touch are gathered in blocks.  Within a block, and between any two
blocks that share a bucket, pairs compare their MinHash values sixteen at a
time; a pair is dropped when the posterior probability that its similarity
reaches the threshold (uniform prior) falls below ``TOLERANCE``, and the rest
are verified exactly on their shingles.  Links are counted and joined into
classes inside the tasks, so no pair is ever a row; classes that span blocks
are connected by their roots.

A pair at the threshold is missed by all bands with a probability under 1e-7
and pruned with one under 1e-5; similarity is exact for every link found.

Defined cases: a text of fewer than five words has one shingle of all its
words.  Null texts and texts without words are similar to nothing.  Rows equal
in doc_id and text are repeats and count as copies.  A null doc_id names a
class only if all its ids are null.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varlake.llm.common import (
    Words,
    join_counted,
    lean,
    row_key,
    shingle_hashes,
    text_passes,
    written,
)

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 4
HASHES = BANDS * ROWS
STEP = 16  # MinHash values compared between two prunings
TOLERANCE = 1e-6
BLOCK_NODES = 256  # nodes of a block, as a rule at most
BLOCK_SHINGLES = 3_000_000  # and their shingles

_RNG = np.random.default_rng(20240501)
_FLIP = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]
_TIMES = (_RNG.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]


def minhash(shingles: np.ndarray) -> np.ndarray:
    """``HASHES`` minima over the shingles, which must not be empty."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(least, ((x[None, at:at + 1024] ^ _FLIP) * _TIMES).min(axis=1), out=least)
    return least


def least_matches(n: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """Matches of ``n`` MinHash values below which the posterior probability
    of ``threshold`` is under ``tolerance``.  With a uniform prior it is the
    chance of at most so many successes in ``n + 1`` trials at ``threshold``."""
    chance, total = (1 - threshold) ** (n + 1), 0.0
    for m in range(n + 1):
        total += chance
        if total >= tolerance:
            return m
        chance *= (n + 1 - m) / (m + 1) * threshold / (1 - threshold)
    return n


def _signatures(docs: DataFrame) -> DataFrame:
    """``__id, __th, node`` (128-bit hash of the shingle set, null without
    words), ``size`` and ``sig`` of every row."""
    schema = pa.schema([("__id", pa.int64()), ("__th", pa.int64()), ("node", pa.binary()),
                        ("size", pa.int64()), ("sig", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in text_passes(batch.column(2)):
                words = Words(data, at)
                node, size, sig = [], [], []
                for a, b in zip(words.first, words.first[1:]):
                    s = shingle_hashes(words.hashes[a:b], SHINGLE)
                    size.append(len(s))
                    node.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    sig.append(minhash(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                     pa.array(node, pa.binary()), pa.array(size, pa.int64()),
                     pa.array(sig, pa.binary())], schema=schema)

    return docs.select(*row_key(), "text").mapInArrow(
        lean(work), "__id long, __th long, node binary, size long, sig binary")


def components(edges: DataFrame) -> DataFrame:
    """Connected components: ``node, root`` for every node of ``edges``
    (columns ``a``, ``b``), ``root`` the component's smallest node.

    Alternates large and small stars: each node links its larger, then its
    smaller neighbours to the smallest one, until nothing changes.
    """
    now = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u > v").distinct())
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root"))).groupBy(
                    "node").agg(F.min("root").alias("root"))
        seen, count = mark, F.count(F.lit(1)).alias("n")
        # The centre of a star may have a third of all edges.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), count))
        large = written(join_counted(both, least, ["u"], "n", 2 * mark[0]).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = written(large.groupBy("u").agg(F.min("v").alias("m"), count))
        small = join_counted(large, least, ["u"], "n", large.count()).select(
            F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").unionByName(
                least.select("u", F.col("m").alias("v")))
        now = written(small.distinct())


def _groups(nodes: DataFrame) -> DataFrame:
    """For each node that shares a bucket: ``node, one, block1, two, block2,
    second``, the pairs of blocks it takes part in and whether it is in the
    second of them.

    A node's neighbourhood is the smallest node two buckets away, so near
    copies mostly share it; neighbourhoods are cut into blocks.  A block is
    compared with itself and with every block it shares a bucket with.
    """
    bands = nodes.select("node", "size", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring(F.col("sig"), b * (4 * ROWS) + 1, F.lit(4 * ROWS)))
    )).alias("band"))
    shared = bands.groupBy("band").agg(
        F.count(F.lit(1)).alias("held"), F.min("node").alias("hub")).where("held > 1")
    members = written(bands.join(shared, "band"))
    near = written(members.groupBy("node", "size").agg(
        F.min("hub").alias("hub"), F.min(F.struct("band", "held")).alias("home")))
    far = written(members.select("band", "node").join(near.select("node", "hub"), "node").groupBy(
        "band").agg(F.min("hub").alias("one")))
    around = members.select("band", "node").join(far, "band").groupBy("node").agg(
        F.min("one").alias("one"))
    homes = written(near.join(around, "node"))
    sizes = written(homes.groupBy("one").agg(F.count(F.lit(1)).alias("n"), F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_NODES),
        F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("home.held") / BLOCK_NODES))
    placed = written(join_counted(homes, sizes, ["one"], "n", homes.count()).select(
        "node", "one",
        F.pmod(F.xxhash64("home.band", salt), F.col("blocks")).cast("int").alias("block1")))
    touched = written(members.select("node", "band").join(placed, "node").select(
        "band", "one", "block1").distinct())
    other = touched.select("band", F.col("one").alias("two"), F.col("block1").alias("block2"))
    pairs = written(touched.join(other, "band").where(
        (F.col("one") < F.col("two"))
        | ((F.col("one") == F.col("two")) & (F.col("block1") < F.col("block2")))).select(
            "one", "block1", "two", "block2").distinct())
    pair = [F.col(c).alias(f"p_{c}") for c in ("one", "block1", "two", "block2")]
    ends = pairs.select(F.col("one"), F.col("block1"), *pair, F.lit(False).alias("second")).unionByName(
        pairs.select(F.col("two").alias("one"), F.col("block2").alias("block1"), *pair,
                     F.lit(True).alias("second")))
    meets = placed.join(ends, ["one", "block1"]).select(
        "node", F.col("p_one").alias("one"), F.col("p_block1").alias("block1"),
        F.col("p_two").alias("two"), F.col("p_block2").alias("block2"), "second")
    own = placed.select("node", "one", "block1", F.col("one").alias("two"),
                        F.col("block1").alias("block2"), F.lit(False).alias("second"))
    return own.unionByName(meets)


def _linked(left: np.ndarray, right: np.ndarray, sigs: np.ndarray, shingles: list[np.ndarray],
            threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (one of ``left``, one of ``right``; each once if they are the
    same nodes) that are similar."""
    if left is right:
        i, j = np.triu_indices(len(left), 1)
    else:
        i, j = (x.ravel() for x in np.indices((len(left), len(right))))
    i, j = left[i], right[j]
    matches = np.zeros(len(i), np.int16)
    for at in range(0, HASHES, STEP):
        matches += (sigs[i, at:at + STEP] == sigs[j, at:at + STEP]).sum(axis=1, dtype=np.int16)
        keep = matches >= least_matches(at + STEP, threshold)
        i, j, matches = i[keep], j[keep], matches[keep]
    size = np.array([len(s) for s in shingles])
    if len(i) > 4 * len(shingles):
        both = _overlaps(shingles)[i, j]
    else:
        both = np.array([len(np.intersect1d(shingles[a], shingles[b], True))
                         for a, b in zip(i, j)], float)
    similar = both >= threshold * (size[i] + size[j] - both) - 1e-9
    return i[similar], j[similar]


def _overlaps(shingles: list[np.ndarray]) -> np.ndarray:
    """Common shingles of all pairs, by products of incidence matrices over a
    few thousand shingles at a time."""
    n = len(shingles)
    row = np.repeat(np.arange(n), [len(s) for s in shingles])
    _, column, held = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
    row, column = row[held[column] > 1], column[held[column] > 1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], np.unique(column[order], return_inverse=True)[1]
    out, width = np.zeros((n, n), np.float32), 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [at, at + width])
        some = np.zeros((n, width), np.float32)
        some[row[a:b], column[a:b] - at] = 1
        out += some @ some.T
    return out


def _verified(rows: DataFrame, threshold: float) -> DataFrame:
    """``node, links, root``: for each node of each group, how many documents
    it is linked to there and the smallest node it is joined to."""
    schema = pa.schema([("node", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])

    def group(found: dict[bytes, tuple], cross: bool) -> pa.RecordBatch:
        nodes = sorted(found)
        sigs = np.array([np.frombuffer(found[n][0], np.uint32) for n in nodes])
        shingles = [np.frombuffer(found[n][1], np.uint64) for n in nodes]
        copies = np.array([found[n][2] for n in nodes])
        every = np.arange(len(nodes))
        if cross:
            second = np.array([found[n][3] for n in nodes], bool)
            i, j = _linked(every[~second], every[second], sigs, shingles, threshold)
        else:
            i, j = _linked(every, every, sigs, shingles, threshold)
        links = np.bincount(i, copies[j], len(nodes)) + np.bincount(j, copies[i], len(nodes))
        root = every.copy()
        while True:  # roots sink along the links until none changes
            low = root.copy()
            np.minimum.at(low, i, root[j])
            np.minimum.at(low, j, root[i])
            low = low[low]
            if (low == root).all():
                break
            root = low
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes), pa.array(links.astype(np.int64)),
             pa.array([nodes[r] for r in root])], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found = None, {}
        for batch in batches:
            for one, block1, two, block2, node, second, sig, shingles, copies in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if (one, block1, two, block2) != now:
                    if found:
                        yield group(found, now[:2] != now[2:])
                    now, found = (one, block1, two, block2), {}
                found[node] = (sig, shingles, copies, second)
        if found:
            yield group(found, now[:2] != now[2:])

    key = ["one", "block1", "two", "block2"]
    return (
        rows.select(*key, "node", "second", "sig", "shingles", "copies")
        .repartition(*key).sortWithinPartitions(*key)
        .mapInArrow(lean(work), "node binary, links long, root binary")
    )


def _with_shingles(rows: DataFrame) -> DataFrame:
    names = [c for c in rows.columns if c != "text"]
    schema = T.StructType([*[f for f in rows.schema.fields if f.name != "text"],
                           T.StructField("shingles", T.BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in text_passes(batch["text"]):
                words = Words(data, at)
                sets = [shingle_hashes(words.hashes[a:b], SHINGLE).tobytes()
                        for a, b in zip(words.first, words.first[1:])]
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*[part[c] for c in names], pa.array(sets, pa.binary())],
                    names=[*names, "shingles"])

    return rows.mapInArrow(lean(work), schema)


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``__id, __th, class_id, first_id, first_th, n_links`` of every row of
    ``docs`` (``doc_id``, ``text``): its class's smallest doc_id, the row key
    of the class's first document, and how many other rows it is linked to."""
    every = written(_signatures(docs))
    held = every.where(F.col("node").isNotNull())
    nodes = written(held.groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("__id", "__th")).alias("first"),
        F.min("__id").alias("least"),
        F.any_value("size").alias("size"), F.any_value("sig").alias("sig")))
    groups = written(_groups(nodes))
    taken = groups.groupBy("node").agg(
        F.collect_list(F.struct("one", "block1", "two", "block2", "second")).alias("groups"))
    wanted = nodes.join(taken, "node").select("node", "copies", "sig", "groups", "first")
    texts = docs.select(*row_key(), "text").join(
        wanted, F.col("__id").eqNullSafe(F.col("first.__id")) & (F.col("__th") == F.col("first.__th")))
    rows = _with_shingles(texts.select("text", "node", "copies", "sig", "groups")).select(
        "node", "copies", "sig", "shingles", F.inline("groups"))
    checked = written(_verified(rows, threshold))
    # A block that meets no other is joined already; others meet through their roots.
    several = groups.where("one <> two OR block1 <> block2").select("node").distinct()
    met = checked.join(several, "node", "left_semi")
    roots = components(met.select(F.col("node").alias("a"), F.col("root").alias("b"))).select(
        "node", F.col("root").alias("top"))
    per_node = checked.groupBy("node").agg(
        F.sum("links").alias("links"), F.min("root").alias("root"))
    joined = nodes.join(per_node, "node", "left").join(roots, "node", "left").select(
        "node", "copies", "least", "first", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("top", "root", "node").alias("root"))
    joined = written(joined)
    named = joined.groupBy("root").agg(
        F.min("least").alias("class_id"), F.min("first").alias("head"),
        F.count(F.lit(1)).alias("n"))
    classes = join_counted(joined, written(named), ["root"], "n", joined.count()).select(
        "node", "copies", "class_id", "head",
        (F.col("copies") - 1 + F.col("links")).alias("n_links"))
    out = ["__id", "__th", "class_id", F.col("head.__id").alias("first_id"),
           F.col("head.__th").alias("first_th"), F.col("n_links").cast("long").alias("n_links")]
    found = join_counted(held.select("__id", "__th", "node"), written(classes), ["node"],
                         "copies", every.count()).select(*out)
    alone = every.where(F.col("node").isNull()).select(
        "__id", "__th", F.col("__id").alias("class_id"), F.col("__id").alias("first_id"),
        F.col("__th").alias("first_th"), F.lit(0).cast("long").alias("n_links"))
    return found.unionByName(alone)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id, n_links`` of every document."""
    return near_classes(docs, threshold).select(
        F.col("__id").alias("doc_id"), "class_id", "n_links")


def first_of_each_class(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that come first in their class, one row of
    repeats; rows without words all stay."""
    from pyspark.sql import Window

    classes = near_classes(docs, threshold).where(
        F.col("first_id").eqNullSafe(F.col("__id")) & (F.col("first_th") == F.col("__th")))
    heads = classes.select(F.col("__id").alias("__hid"), F.col("__th").alias("__hth")).distinct()
    ided = docs.withColumns(dict(zip(("__id", "__th"), row_key())))
    nth = F.row_number().over(Window.partitionBy("__id", "__th").orderBy(F.lit(0)))
    return (
        ided.join(heads, F.col("__id").eqNullSafe(F.col("__hid"))
                  & F.col("__th").eqNullSafe(F.col("__hth")), "left_semi")
        .withColumn("__nth", nth).where("__nth = 1")
        .select([F.col(f"`{c}`") for c in docs.columns])
    )
