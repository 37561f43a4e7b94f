"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order.  The rows are dealt to
blocks; in a block, each pivot's inverted file is a list of the vectors that have
it among their ``POSTED`` nearest, with its place in their order.  A query walks
the lists of its own ``READ`` nearest pivots and adds up how far the places differ
(Spearman's footrule, a vector that isn't listed standing behind the last
place), and reranks the best share of the block by the inner product itself.
With ``exact`` (the default), of the other vectors those are reranked too whose
norm and angles to pivots don't exclude an inner product as large as the ``k``-th
found: the order of the footrules then decides how much is read, never what is
found.  Without it, only the share is.

Nearness is the inner product.  Vectors, and so the pivots chosen from them,
get one more component that makes all norms equal; queries get a 0 there.
That leaves inner products with queries as they are, and the larger of them
belongs to the smaller angle.

Defined cases: vectors that are null, zero, of another length than most, or
hold a null or non-finite component take no part, nor do rows with a null
vec_id.  Rows equal in vec_id and vector are one.  Rows of the query's own
vec_id are not its candidates.  Fewer candidates than ``k``: all of them.  A
block of few vectors is reranked whole.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varlake.llm.common import written

PIVOTS = 256
PIVOT_SAMPLE = 2048  # rows the pivots are chosen from
POSTED = 64
READ = 24
SHARE = 0.3  # of a block that is reranked for a query
LEAST = 200  # vectors of a block that are reranked at least
BOUNDING = 4  # nearest pivots whose angles bound a query's inner products
SLACK = 1e-6  # of the product of the norms, for rounding in the bounds
BLOCK_ROWS = 4096  # vectors of a block, about
CHUNK_ROWS = 2048  # queries that meet a block at once, about


def _usable(column: str) -> Column:
    x = F.col(column)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(fine & F.exists(x, lambda v: v != 0), F.lit(False))


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, v`` (array of doubles) of the rows that take part."""
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(
        _usable("embedding")).select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("v"))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(
        F.col("count").desc(), "n").first()
    return rows.where(F.size("v") == (common["n"] if common else 0)).dropDuplicates(["vec_id", "v"])


def lifted(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Vectors with the component that makes their norms ``norm``, the largest."""
    extra = np.sqrt(np.maximum(norm**2 - (vectors**2).sum(axis=1), 0))
    return np.column_stack([vectors, extra])


def choose_pivots(rows: DataFrame, norm: float, pivots: int = PIVOTS) -> np.ndarray:
    """Lifted vectors of a hash sample of ``PIVOT_SAMPLE`` rows, scaled to 1,
    each the farthest from those before it and no two equal."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "v").limit(PIVOT_SAMPLE).select("v").collect()
    if not sample:
        return np.zeros((0, 0))
    return farthest_first(lifted(np.array([r["v"] for r in sample]), norm) / norm, pivots)


def farthest_first(found: np.ndarray, pivots: int) -> np.ndarray:
    """Up to ``pivots`` rows, the first one and then the farthest from all before."""
    chosen, apart = [0], ((found - found[0]) ** 2).sum(axis=1)
    while len(chosen) < pivots and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        np.minimum(apart, ((found - found[chosen[-1]]) ** 2).sum(axis=1), out=apart)
    return found[chosen]


def _units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and the vectors scaled to 1."""
    norms = np.sqrt((vectors**2).sum(axis=1))
    with np.errstate(divide="ignore", invalid="ignore"):
        return norms, vectors / norms[:, None]


def _places(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The place of each pivot in each lifted vector's order, nearest first."""
    order = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")
    places = np.empty(order.shape, np.int16)
    np.put_along_axis(places, order, np.arange(order.shape[1], dtype=np.int16)[None], 1)
    return places


def query_places(queries: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The same for queries, whose additional component is 0."""
    return _places(np.column_stack([queries, np.zeros(len(queries))]), pivots)


class BlockIndex:
    """The inverted files of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, norm: float):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.pivots = ids[order], vectors[order], pivots
        self.behind = min(POSTED, len(pivots))
        places = _places(lifted(self.vectors, norm), pivots)
        # The file of pivot p: posted[ends[p]:ends[p + 1]], with the place each has.
        pivot, row = np.nonzero((places < self.behind).T)
        self.posted, self.place = row.astype(np.int32), places[row, pivot]
        self.ends = np.searchsorted(pivot, np.arange(len(pivots) + 1))
        # Cosines and sines of the angles between pivots and vectors, as they are unlifted.
        self.norms, units = _units(self.vectors)
        self.directions = _units(pivots[:, :-1])[1]
        self.cosines = np.clip(self.directions @ units.T, -1, 1)
        self.sines = np.sqrt(1 - self.cosines**2)

    def footrules(self, places: np.ndarray) -> np.ndarray:
        """Footrule distance of all vectors to a query's pivot places."""
        read = np.argsort(places, kind="stable")[:READ]
        # All behind the last place, then what the lists say of their vectors.
        behind = np.abs(self.behind - places[read].astype(np.int32))
        lists = [slice(self.ends[p], self.ends[p + 1]) for p in read.tolist()]
        sizes = [i.stop - i.start for i in lists]
        nearer = np.abs(np.concatenate([self.place[i] for i in lists])
                        - np.repeat(places[read], sizes)) - np.repeat(behind, sizes)
        apart = np.bincount(np.concatenate([self.posted[i] for i in lists]), nearer, len(self.ids))
        return apart.astype(np.int32) + behind.sum(dtype=np.int32)

    def within_reach(self, rows: np.ndarray, query: np.ndarray, places: np.ndarray, least: float
                     ) -> np.ndarray:
        """Those of ``rows`` whose inner product may be ``least`` or more.  Two
        vectors' angle is at least the difference of their angles to any pivot."""
        norm = np.sqrt((query**2).sum())
        reach = norm * self.norms[rows]
        near = ~(reach * (1 + SLACK) < least)  # what can't be computed stays
        rows, reach = rows[near], reach[near]
        closest = np.full(len(rows), 1.0)  # cosine at most
        for p in np.argsort(places, kind="stable")[:BOUNDING]:
            cosine = np.clip(self.directions[p] @ query / norm, -1, 1)
            np.minimum(closest, self.cosines[p, rows] * cosine
                       + self.sines[p, rows] * np.sqrt(1 - cosine**2), out=closest)
        return rows[~(reach * (closest + SLACK) < least)]

    def nearest(self, query_id: int, query: np.ndarray, places: np.ndarray, k: int,
                exact: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best ``k`` after reranking."""
        others = self.ids != query_id
        wanted = max(LEAST, k, int(SHARE * len(self.ids)))
        if wanted < len(self.ids):
            distance = self.footrules(places)
            edge = np.partition(distance, wanted - 1)[wanted - 1]
            first = distance <= edge  # and all that tie
            scores = self._scores(np.flatnonzero(first & others), query)
            rest = np.flatnonzero(~first & others) if exact else np.empty(0, np.int64)
            if exact and len(scores) >= k:
                rest = self.within_reach(rest, query, places, np.partition(scores, -k)[-k])
            rows = np.concatenate([np.flatnonzero(first & others), rest])
            scores = np.concatenate([scores, self._scores(rest, query)])
        else:
            rows = np.flatnonzero(others)
            scores = self._scores(rows, query)
        if len(scores) > k:  # the k best and all that tie
            near = scores >= np.partition(scores, -k)[-k]
            rows, scores = rows[near], scores[near]
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][best], scores[best]

    def _scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Inner products, summed in one order: alike rows score alike."""
        if 2 * len(rows) > len(self.ids):  # cheaper than to copy the rows
            return np.einsum("ij,j->i", self.vectors, query)[rows]
        return np.einsum("ij,j->i", self.vectors[rows], query)


def search(embeddings: DataFrame, queries: Column, k: int = 20, exact: bool = True) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each
    row for which ``queries`` (an expression on ``vec_id``) holds."""
    rows = written(usable_vectors(embeddings))
    spark = rows.sparkSession
    total, asked = rows.count(), rows.where(queries).count()
    norm = rows.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()[0]
    pivots = spark.sparkContext.broadcast(choose_pivots(rows, norm))  # at most PIVOTS vectors
    blocks, chunks = max(1, total // BLOCK_ROWS), max(1, asked // CHUNK_ROWS)
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # Each block meets each chunk of the stated queries in one task.
    index = rows.select("vec_id", "v", dealt(blocks).alias("block"), every(chunks).alias("chunk"))
    probes = rows.where(queries).select(
        "vec_id", "v", dealt(chunks).alias("chunk"), every(blocks).alias("block")).select(
            "vec_id", "v", "block", "chunk")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = table["vec_id"].to_numpy()
        flat = table["v"].combine_chunks().flatten().to_numpy()
        return ids, flat.reshape(len(ids), -1)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        block = BlockIndex(*matrix(left), pivots.value, norm)
        ids, vectors = matrix(right)
        places = query_places(vectors, pivots.value)
        found = [(np.full(len(n), q), n, s) for q, v, p in zip(ids, vectors, places)
                 for n, s in [block.nearest(q, v, p, k, exact)]]
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found)], schema=schema)

    found = index.groupBy("block", "chunk").cogroup(probes.groupBy("block", "chunk")).applyInArrow(
        meet, "query_id long, vec_id long, score double")
    # Rows of one vec_id but different vectors are different queries and candidates.
    nearest_first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest_first)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
