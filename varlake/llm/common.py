"""Helpers shared by the operators: shared scratch tables, word splitting on
Arrow buffers, ranks and joins that stay spread out under skew."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Bytes of text that one numpy pass works on; a longer text is a pass of its own.
# A pass takes some 40 times as much, in each Python worker of an executor.
PASS_BYTES = 1 << 18


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which all executors share.

    A session without that setting gets a local folder only when it runs in
    one JVM (tests); on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="varlake-llm-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: the
    lineage ends there, and a lost executor costs a re-read only."""
    path = scratch_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key() -> list[Column]:
    """Columns ``__id`` and ``__th`` that tell rows of ``documents`` apart by id
    and text.  Rows equal in both are repeats of one document."""
    return [F.col("doc_id").alias("__id"), F.xxhash64(F.col("text")).alias("__th")]


def lean(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` for ``mapInArrow`` that hands freed memory back at its task's
    end; Python workers wait for their next task with what they hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return run


def salts_for(rows: int, rows_per_salt: int = 100_000, least: int = 32) -> int:
    """How many pieces a hot key is cut into; grows with the table."""
    return max(least, -(-rows // rows_per_salt))


def gapless_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str,
                 salts: int) -> DataFrame:
    """``df`` plus ``name``: 0, 1, 2, ... without gaps within ``keys`` (non-null).

    No key is ever sorted in one task: rows are numbered within (keys, salt)
    and each salt starts where the counts of the salts before it end.  The
    salt hashes ``order``, which must tell rows with different output apart.
    ``df`` is read twice and should be a written table.
    """
    t = df.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    local = t.withColumn(
        "__local", F.row_number().over(Window.partitionBy(*keys, "__salt").orderBy(*order)) - 1)
    before = Window.partitionBy(*keys).orderBy("__salt").rowsBetween(
        Window.unboundedPreceding, -1)
    base = (
        t.groupBy(*keys, "__salt").agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    return (
        local.join(base, [*keys, "__salt"])
        .withColumn(name, (F.col("__base") + F.col("__local")).cast("long"))
        .drop("__salt", "__local", "__base")
    )


def join_counted(left: DataFrame, right: DataFrame, keys: Sequence[str], count: str,
                 rows: int) -> DataFrame:
    """Inner join to ``right``, which has one row per key and in ``count`` how
    many rows of ``left`` carry it (``rows`` in all).

    Keys with over a thousandth of the rows, of which there are fewer than a
    thousand, are broadcast; all others are shuffled and are small each.
    """
    hot_at = max(rows // 1000, 1000)
    hot = F.broadcast(right.where(F.col(count) > hot_at))
    marked = left.join(hot.select(*keys, F.lit(True).alias("__hot")), list(keys), "left")
    cold = marked.where(F.col("__hot").isNull()).drop("__hot").join(
        right.where(F.col(count) <= hot_at), list(keys))
    return left.join(hot, list(keys)).unionByName(cold)


# Bytes that belong to a word, lower-cased; all others become a blank.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20
    for b in range(256)
)
_LONG = 32  # longer words are hashed one by one
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


class Words:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of some texts after
    lower-casing A-Z: 64-bit hashes, byte places, and where each text begins.

    ``hashes``, ``starts``, ``ends`` have an entry per word (bytes counted over
    the joined texts); words of text ``i`` are ``first[i]:first[i + 1]`` and its
    bytes begin at ``text_at[i]``.
    """

    def __init__(self, data: bytes, text_at: np.ndarray):
        self.low = data.translate(_TABLE)
        self.text_at = text_at
        buf = np.frombuffer(self.low, np.uint8)
        n = len(buf)
        inside = np.zeros(n + 1, bool)
        inside[:n] = buf != 0x20
        begins = np.zeros(n + 1, bool)
        begins[text_at] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | begins[1:]
        ends = inside[:-1] & (~inside[1:] | begins[1:])
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, text_at)
        self.hashes = self._hashed(self.starts, self.ends)

    def cut(self, which: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of the words ``which``, all
        longer; they differ from those of whole words."""
        starts = self.starts[which]
        return _mixed(self._hashed(starts, starts + size))

    def _hashed(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        buf = np.frombuffer(self.low, np.uint8)
        lengths = ends - starts
        h = lengths.astype(np.uint64)
        at, where = starts, np.arange(len(lengths))
        short = lengths <= _LONG
        if not short.all():
            for i in np.flatnonzero(~short):
                h[i] = xxhash.xxh3_64_intdigest(self.low[starts[i]:ends[i]])
            where, at, lengths = where[short], at[short], lengths[short]
        step, k = np.zeros(len(where), np.uint64), 0
        step[:] = h[where]
        while len(where):
            step = step * _PRIME + buf[at + k]
            k += 1
            done = lengths == k
            if done.any():
                h[where[done]] = _mixed(step[done])
                keep = ~done
                where, at, lengths, step = where[keep], at[keep], lengths[keep], step[keep]
        return h


def text_passes(column: pa.Array) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Cut a string column into runs of whole texts of about ``PASS_BYTES``:
    (first row, end row, their bytes, where each text begins and the last ends).
    Null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    column = column.fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        column.offset:column.offset + n + 1].astype(np.int64)
    view = memoryview(data) if data is not None else memoryview(b"")
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + PASS_BYTES, "right")) - 1)
        j = min(j, n)
        yield i, j, bytes(view[at[i]:at[j]]), at[i:j + 1] - at[i]
        i = j


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``k`` words; a text of
    fewer words, but not none, has one shingle of all its words."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    k = min(k, n)
    h = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        h = _mixed(h * _PRIME + words[j:n - k + 1 + j])
    return np.unique(h)
