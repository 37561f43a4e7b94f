"""Document fingerprints by winnowing, and their likeness to neighbours.

Every run of ``GRAM`` code points gets a rolling hash: prefix sums of the code
points times powers of an odd base, so that a gram's hash is the difference of
two prefix sums brought to one power.  Of every ``WINDOW`` consecutive grams the
one with the smallest hash is kept, the rightmost of equal ones, with its
position.  Two texts that share ``GRAM + WINDOW - 1`` code points in a row keep
a gram of them in common at least; positions say where.  A text of fewer grams
than a window keeps the smallest of them; one shorter than a gram is one gram.

:func:`fingerprint_neighbours` compares every document with an edited form of
itself and with the next document.  The order by ``doc_id`` is cut into ranges
at keys found on ids and text hashes alone; the first document of each range is
also sent to the range before it.  Texts are shuffled once, and a task streams
through its sorted ranges with two documents at hand.

Defined cases: a null text is empty; an empty text has an empty fingerprint,
which is like itself (1) and unlike any other (0).  Order: by ``doc_id``, null
ids last, then by a hash of the text; the next document is the next that
differs in id or text, after the last the first.  Rows equal in id and text are
repeats of one document and get equal results; a key with more rows than a
range holds is dealt to as many ranges as it needs.  Of an only document the
next is itself.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import lean

GRAM = 12
WINDOW = 16
RANGE_ROWS = 2_000  # rows of a range at least
MAX_RANGES = 1 << 18  # about, of equal numbers of rows; each has a key on the driver
BATCH_BYTES = 8 << 20  # of text and fingerprints that leave a task at once

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


class _Powers:
    """Powers of the base and of its inverse, as far as they were needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 12)
            for name, factor in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def gram_hashes(points: np.ndarray, k: int = GRAM) -> np.ndarray:
    """32-bit hashes of all runs of ``k`` code points; of a shorter text's
    whole, if it has any."""
    n = len(points)
    k = min(k, n)
    if n == 0:
        return np.empty(0, np.uint64)
    up, down = _POWERS.upto(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * down[:n], out=sums[1:])
    h = (sums[k:] - sums[:-k]) * up[:n - k + 1] + np.uint64(k)
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h >> np.uint64(32)


def winnow(points: np.ndarray, k: int = GRAM, window: int = WINDOW) -> np.ndarray:
    """The kept grams, by position: hash in the upper 32 bits, position in the
    lower ones."""
    low = np.uint64((1 << 32) - 1)
    h = gram_hashes(points, k)
    if not len(h):
        return h
    # Equal hashes: the greater position has the smaller lower half.
    least = (h << np.uint64(32)) | (low - np.arange(len(h), dtype=np.uint64))
    size, most = 1, min(window, len(h))
    while size < most:  # minima of windows of a size give those of up to twice it
        step = min(size, most - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    kept = least[np.concatenate([[True], least[1:] != least[:-1]])]
    return (kept & ~low) | (low - (kept & low))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the hashes in common over the hashes of both (0 to 1)."""
    x, y = np.unique(a >> np.uint64(32)), np.unique(b >> np.uint64(32))
    if not len(x) + len(y):
        return 1.0
    return 2.0 * len(np.intersect1d(x, y, assume_unique=True)) / (len(x) + len(y))


def as_text(fingerprint: np.ndarray) -> str:
    """16 hexadecimal digits a gram: 8 of its hash and 8 of its position."""
    return fingerprint.astype(">u8").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    """The fingerprint that :func:`as_text` wrote."""
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


class _Text:
    """A document's text with its fingerprint."""

    def __init__(self, text: str | None):
        self.points = np.frombuffer((text or "").encode("utf-32-le"), np.uint32)
        self.kept = winnow(self.points)

    def compared(self, after: _Text) -> dict:
        """What a document's row says, given the next document."""
        n = len(self.points)
        edited = np.concatenate([self.points[:n - n // 4], after.points[:n // 4]])
        kept = winnow(edited)
        return {
            "n_chars": n,
            "edited_sha256": hashlib.sha256(
                edited.tobytes().decode("utf-32-le").encode()).hexdigest(),
            "fingerprint": as_text(self.kept), "edited_fingerprint": as_text(kept),
            "near_edited": likeness(self.kept, kept),
            "near_next": likeness(self.kept, after.kept),
        }


#: Order of documents: null ids last, then ids, then text hashes.
_KEY = ["__none", "doc_id", "__th"]


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").isNull().alias("__none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
        .alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("__th"), "text")


def _ranges(rows: DataFrame) -> tuple[list[tuple[bool, int, int, int]], int]:
    """Sorted ``(none, doc_id, text hash, rows)``: the first key of each range
    and how many rows the range has; and a range's usual rows.  A key with
    more has a range of its own."""
    counts = rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"))
    total = rows.count()
    size = max(RANGE_ROWS, total // MAX_RANGES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = None, 0
        for batch in batches:
            out = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if first is not None and (held >= size or row[3] >= size):
                    out.append((*first, held))
                    first = None
                if first is None:
                    first, held = row[:3], 0
                held += row[3]
            if out:
                yield _batch(out)
        if first is not None:
            yield _batch([(*first, held)])

    def _batch(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*found), kinds)], names=[*_KEY, "n"])

    parts = max(1, -(-total // (4 * size)))
    found = counts.repartitionByRange(parts, *_KEY).sortWithinPartitions(*_KEY).mapInArrow(
        cut, "__none boolean, doc_id long, __th long, n long")
    return sorted(tuple(r) for r in found.collect()), size


def fingerprint_neighbours(documents: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` of every document.

    The edited text is the document's with its last quarter (rounded down)
    replaced by as many first code points of the next document, or all."""
    rows = _keyed(documents)
    spark = rows.sparkSession
    found, size = _ranges(rows)
    # Where a range begins, and the numbers of the buckets it is dealt to: a
    # key's own range has one for every ``size`` rows.
    starts = [r[:3] for r in found]
    dealt = [-(-r[3] // (2 * size)) for r in found]
    first_bucket = np.concatenate([[0], np.cumsum(dealt)]).tolist()
    plan = spark.sparkContext.broadcast((starts, first_bucket))  # about MAX_RANGES keys

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins, first = plan.value
        turn: dict[int, int] = {}
        sent = set()
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            at, bucket = list(range(len(keys))), []
            for key in keys:
                r = bisect_right(begins, key) - 1
                turn[r] = turn.get(r, -1) + 1
                bucket.append(first[r] + turn[r] % (first[r + 1] - first[r]))
            extra = [False] * len(at)
            for i, key in enumerate(keys):
                r = bisect_left(begins, key)
                if r < len(begins) and begins[r] == key and key not in sent:
                    sent.add(key)
                    before = (r or len(begins)) - 1  # before the first: the last
                    for b in range(first[before], first[before + 1]):
                        at.append(i)
                        bucket.append(b)
                        extra.append(True)
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(bucket, pa.int32()), pa.array(extra, pa.bool_())],
                names=[*batch.schema.names, "__bucket", "__extra"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows()
        held = None  # (bucket, key, text, rows) whose next isn't known
        for batch in batches:
            columns = [batch[c] for c in ("__bucket", "__extra", *_KEY, "text")]
            for bucket, extra, *key, text in zip(*columns):
                bucket, extra = bucket.as_py(), extra.as_py()
                key = tuple(k.as_py() for k in key)
                if held and held[0] == bucket and held[1] == key and not extra:
                    held[3] += 1
                    continue
                if held and held[0] != bucket:
                    held = None  # past the range's last, which its extra row closed
                if extra and held is None:
                    continue
                now = held[2] if held and held[1] == key else _Text(text.as_py())
                if held:
                    yield from out.add(held[1], held[2].compared(now), held[3])
                held = None if extra else [bucket, key, now, 1]
        yield from out.rest()

    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    ranged = rows.mapInArrow(lean(deal), "__none boolean, doc_id long, __th long, text string, "
                                         "__bucket int, __extra boolean")
    return ranged.repartition("__bucket").sortWithinPartitions(
        "__bucket", "__extra", *_KEY).mapInArrow(lean(compare), schema)


class _Rows:
    """Result rows on their way out, some megabytes at a time."""

    def __init__(self) -> None:
        self.rows, self.bytes = [], 0

    def add(self, key: tuple, row: dict, times: int) -> Iterator[pa.RecordBatch]:
        row["doc_id"] = None if key[0] else key[1]
        for _ in range(times):
            self.rows.append(row)
            self.bytes += 200 + len(row["fingerprint"]) + len(row["edited_fingerprint"])
            if self.bytes >= BATCH_BYTES:
                yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            kinds = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(),
                     "fingerprint": pa.string(), "edited_fingerprint": pa.string(),
                     "near_edited": pa.float64(), "near_next": pa.float64()}
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in self.rows], t) for n, t in kinds.items()],
                names=list(kinds))
        self.rows, self.bytes = [], 0
