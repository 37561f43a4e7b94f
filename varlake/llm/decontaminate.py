"""Benchmark decontamination by an FM-index per shard of training text.

Benchmark items become windows of ``WINDOW`` consecutive words (a shorter item
is one window).  Each task indexes its shard of the documents: words as
numbers, their Burrows-Wheeler transform in a wavelet matrix, and suffix
positions sampled.  All windows are searched backwards through the matrix's
ranks, occurrences are located by stepping to sampled positions, and hit words
are merged into removal spans.  A word no window holds cannot be part of an
occurrence, so only runs of known words, as long as the shortest window at
least, enter the index.

The benchmark is collected in blocks of at most ``BLOCK_BYTES`` of text, held
as arrays over its words; a larger one takes several passes over the documents,
each adding its spans.

Defined cases: null and empty texts have no words and no hits.  Items without
words are ignored; items of equal text all count; an item with a null id hits
words but is not listed.  Rows of one doc_id are each judged.  Other columns
pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import Words, lean, text_passes

WINDOW = 10
SHARD_WORDS = 500_000  # indexed words per FM-index
SAMPLE = 8  # every so many text positions are kept
SEARCHED = 1 << 18  # windows searched at once
BLOCK_BYTES = 16 << 20


class FMIndex:
    """Index of a sequence of symbols 1..top; 0 is its end."""

    def __init__(self, text: np.ndarray, top: int):
        text = np.append(text.astype(np.int64), 0)
        n = len(text)
        suffix = self._suffixes(text)
        self.bwt = text[suffix - 1]
        self.before = np.concatenate(
            [[0], np.cumsum(np.bincount(text, minlength=top + 1))])  # smaller symbols
        # Wavelet matrix: a level per bit, high bits first; ones[l][i] counts
        # the set bits before i, and symbols with the bit clear move to front.
        self.bits = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        level = self.bwt
        for b in reversed(range(self.bits)):
            bit = (level >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(n - int(self.ones[-1][-1]))
            level = np.concatenate([level[bit == 0], level[bit == 1]])
        self.start = np.searchsorted(self._order(level), self._order(np.arange(top + 1)))
        sampled = suffix % SAMPLE == 0
        self.sampled = np.concatenate([[0], np.cumsum(sampled)])
        self.samples = suffix[sampled]

    def _order(self, symbols: np.ndarray) -> np.ndarray:
        """The matrix's last level is sorted by the symbols' bits reversed."""
        out = np.zeros(len(symbols), np.int64)
        for b in range(self.bits):
            out = out << 1 | (symbols >> b) & 1
        return out

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """Suffix array by prefix doubling; only ties are sorted again."""
        n = len(text)
        _, rank = np.unique(text, return_inverse=True)
        rank = rank.astype(np.int64)
        order, span = np.argsort(rank, kind="stable"), 1
        first = np.searchsorted(rank[order], rank[order], "left")
        rank[order] = first  # a suffix's rank is where its group begins
        tied = order
        while True:
            same = np.bincount(rank[tied], minlength=n) > 1
            tied = tied[same[rank[tied]]]
            if not len(tied):
                break
            ahead = tied + span
            behind = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
            by = np.lexsort((behind, rank[tied]))
            tied, behind, group = tied[by], behind[by], rank[tied][by]
            new = np.ones(len(tied), bool)
            new[1:] = (group[1:] != group[:-1]) | (behind[1:] != behind[:-1])
            head = np.ones(len(tied), bool)
            head[1:] = group[1:] != group[:-1]
            at = np.arange(len(tied))
            inside = at - np.maximum.accumulate(np.where(head, at, 0))
            begin = np.maximum.accumulate(np.where(new, at, 0))
            rank[tied] = group + inside[begin]
            span *= 2
        out = np.empty(n, np.int64)
        out[rank] = np.arange(n)
        return out

    def ranks(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before each place."""
        for level, ones in enumerate(self.ones):
            up = ones[at]
            bit = (symbol >> (self.bits - 1 - level)) & 1
            at = np.where(bit == 1, self.zeros[level] + up, at - up)
        return at - self.start[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``low:high`` of the suffixes that begin with each pattern."""
        count, size = patterns.shape
        return self.search_at(patterns.ravel(), np.arange(count) * size, size)

    def search_at(self, symbols: np.ndarray, starts: np.ndarray, size: int
                  ) -> tuple[np.ndarray, np.ndarray]:
        """The same for the patterns ``symbols[start:start + size]``."""
        low = np.zeros(len(starts), np.int64)
        high = np.full(len(starts), len(self.bwt), np.int64)
        alive = np.arange(len(starts))
        for k in reversed(range(size)):
            c = symbols[starts[alive] + k]
            low[alive] = self.before[c] + self.ranks(c, low[alive])
            high[alive] = self.before[c] + self.ranks(c, high[alive])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of the suffixes in these rows."""
        place = np.empty(len(rows), np.int64)
        todo, row, steps = np.arange(len(rows)), rows, 0
        while len(todo):
            here = self.sampled[row + 1] > self.sampled[row]
            place[todo[here]] = self.samples[self.sampled[row[here]]] + steps
            todo, row = todo[~here], row[~here]
            c = self.bwt[row]
            row = self.before[c] + self.ranks(c, row)
            steps += 1
        return place


@dataclass(frozen=True)
class SameLength:
    """Distinct windows of one length: where each stands first in the items'
    words, and as lists laid end to end the items that hold it."""

    size: int
    starts: np.ndarray
    items_at: np.ndarray  # items of window w: items[items_at[w]:items_at[w + 1]]
    items: np.ndarray


@dataclass(frozen=True)
class Windows:
    """Distinct windows of some items over numbered words.  A window is a place
    in ``words``, so all of them take a few bytes for each word."""

    hashes: np.ndarray  # of the words, sorted; word i has number i + 2
    words: np.ndarray  # the items' words, by number
    lengths: list[SameLength]
    names: list[str]  # item ids, sorted

    @property
    def shortest(self) -> int:
        return min(w.size for w in self.lengths)

    @property
    def longest(self) -> int:
        return max(w.size for w in self.lengths)

    def items_of(self, which: int, window: int) -> list[str]:
        w = self.lengths[which]
        return [self.names[i] for i in w.items[w.items_at[window]:w.items_at[window + 1]]]


def _named(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """A number for the ``size`` words from each start on, equal for equal ones:
    names of runs twice as long come from pairs of names, exactly."""
    name, span = words.astype(np.int64), 1

    def paired(at: np.ndarray, shift: int) -> np.ndarray:
        pair = name[at] * (int(name.max()) + 1) + name[np.minimum(at + shift, len(name) - 1)]
        return np.unique(pair, return_inverse=True)[1]

    while 2 * span <= size:
        name = paired(np.arange(len(name)), span)
        span *= 2
    return paired(starts, size - span)  # two runs that may overlap cover the window


def item_windows(ids: list[str | None], texts: pa.Array, window: int = WINDOW) -> Windows:
    """The windows of items; arrays over their words only, no object a window."""
    hashes, sizes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for _, _, data, at in text_passes(texts):
        part = Words(data, at)
        hashes.append(part.hashes)
        sizes.append(np.diff(part.first))
    known, words = np.unique(np.concatenate(hashes), return_inverse=True)
    words = (words + 2).astype(np.int32)  # 0 ends the text, 1 separates runs
    sizes = np.concatenate(sizes)
    first = np.cumsum(sizes) - sizes
    names = sorted({i for i in ids if i is not None})
    place = {name: i for i, name in enumerate(names)}
    item = np.array([place.get(i, -1) for i in ids], np.int64)
    lengths = []
    for size in np.unique(np.minimum(sizes[sizes > 0], window)).tolist():
        some = np.flatnonzero(np.minimum(sizes, window) == size)
        count = sizes[some] - size + 1
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        starts = np.repeat(first[some], count) + nth
        _, at, name = np.unique(_named(words, starts, size), return_index=True, return_inverse=True)
        owner = np.repeat(item[some], count)
        listed = owner >= 0
        pairs = np.unique(name[listed] * (len(names) + 1) + owner[listed])
        of = pairs // (len(names) + 1)
        lengths.append(SameLength(
            size, starts[at].astype(np.int32),
            np.searchsorted(of, np.arange(len(at) + 1)).astype(np.int32),
            (pairs % (len(names) + 1)).astype(np.int32)))
    return Windows(known, words, lengths, names)


def _known_runs(number: np.ndarray, first: np.ndarray, shortest: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the runs of known words (number > 0) within one text
    that are ``shortest`` words long at least."""
    known = np.concatenate([[False], number > 0, [False]])
    cut = np.zeros(len(number) + 1, bool)
    cut[first] = True
    begins = np.flatnonzero(known[1:-1] & (~known[:-2] | cut[:-1]))
    ends = np.flatnonzero(known[1:-1] & (~known[2:] | cut[1:])) + 1
    long = ends - begins >= shortest
    return begins[long], ends[long]


def _shards(begins: np.ndarray, ends: np.ndarray, overlap: int
            ) -> Iterator[list[tuple[int, int]]]:
    """Runs in lots of about ``SHARD_WORDS``; a longer run is cut, and the
    parts overlap so that no window is lost."""
    lot, held = [], 0
    for a, b in zip(begins.tolist(), ends.tolist()):
        while True:
            end = min(b, a + SHARD_WORDS)
            lot.append((a, end))
            held += end - a
            if held >= SHARD_WORDS:
                yield lot
                lot, held = [], 0
            if end == b:
                break
            a = end - overlap
    if lot:
        yield lot


def find_windows(number: np.ndarray, first: np.ndarray, windows: Windows
                 ) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(word places, which length, which window) of all occurrences, by shard.
    ``number`` has each word's number or 0; ``first`` where each text begins."""
    if not windows.lengths:
        return
    begins, ends = _known_runs(number, first, windows.shortest)
    top = len(windows.hashes) + 1
    for lot in _shards(begins, ends, windows.longest - 1):
        sizes = np.array([b - a + 1 for a, b in lot])
        text = np.ones(sizes.sum(), np.int64)  # a separator behind each run
        offset = np.cumsum(sizes) - sizes
        for (a, b), o in zip(lot, offset):
            text[o:o + b - a] = number[a:b]
        index = FMIndex(text, top)
        shift = np.array([a for a, _ in lot]) - offset
        for which, w in enumerate(windows.lengths):
            for lot_at in range(0, len(w.starts), SEARCHED):
                low, high = index.search_at(windows.words, w.starts[lot_at:lot_at + SEARCHED], w.size)
                times = high - low
                hit = np.flatnonzero(times)
                if not len(hit):
                    continue
                pattern = np.repeat(hit, times[hit])
                nth = np.arange(len(pattern)) - np.repeat(
                    np.cumsum(times[hit]) - times[hit], times[hit])
                place = index.locate(low[pattern] + nth)
                run = np.searchsorted(offset, place, "right") - 1
                yield place + shift[run], which, pattern + lot_at


def _merged(hit: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (text, begin, end) of consecutive hit words, counted from the text's first."""
    begins, ends = _known_runs(hit.astype(np.int8), first, 1)
    text = np.searchsorted(first, begins, "right") - 1
    return text, begins - first[text], ends - first[text]


SPANS = "array<struct<begin:int,end:int>>"


def _pass(docs: DataFrame, windows: Windows) -> DataFrame:
    """One pass: adds to the spans and items that ``docs`` has."""
    model = docs.sparkSession.sparkContext.broadcast(windows)  # of at most BLOCK_BYTES of text
    names, schema = docs.columns, docs.schema
    text_at = names.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            for i, j, data, at in text_passes(batch.column(text_at)):
                part = batch.slice(i, j - i)
                words = Words(data, at)
                slot = np.searchsorted(w.hashes, words.hashes)
                known = np.append(w.hashes, 0)[slot] == words.hashes
                known &= slot < len(w.hashes)
                number = np.where(known, slot + 2, 0)
                change = np.zeros(len(number) + 1, np.int64)
                texts = j - i
                items: list[set] = [set(x or ()) for x in part["__items"].to_pylist()]
                for t, spans in enumerate(part["__spans"].to_pylist()):
                    for s in spans or ():
                        change[words.first[t] + s["begin"]] += 1
                        change[words.first[t] + s["end"]] -= 1
                for place, which, pattern in find_windows(number, words.first, w):
                    size, count = w.lengths[which].size, len(w.lengths[which].starts)
                    np.add.at(change, place, 1)
                    np.add.at(change, place + size, -1)
                    text = np.searchsorted(words.first, place, "right") - 1
                    for pair in np.unique(text * count + pattern):
                        t, p = divmod(int(pair), count)
                        items[t].update(w.items_of(which, p))
                text, begin, end = _merged(np.cumsum(change[:-1]) > 0, words.first)
                where = np.searchsorted(text, np.arange(texts + 1)).astype(np.int32)
                spans = pa.ListArray.from_arrays(where, pa.StructArray.from_arrays(
                    [pa.array(begin, pa.int32()), pa.array(end, pa.int32())], ["begin", "end"]))
                new = {"__n_words": pa.array(np.diff(words.first), pa.int64()),
                       "__spans": spans,
                       "__items": pa.array([sorted(x) for x in items], pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([new.get(c, part[c]) for c in names], names=names)

    return docs.mapInArrow(lean(work), schema)


def mark_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` plus ``__n_words``, ``__spans`` (merged hit words, ends
    exclusive) and ``__items`` (sorted ids of items with an occurrence)."""
    items = benchmark.where(F.col("text").isNotNull()).select(
        F.col("item_id").cast("string").alias("item"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    out = docs.withColumns({
        "__n_words": F.lit(None).cast("long"), "__spans": F.lit(None).cast(SPANS),
        "__items": F.lit(None).cast("array<string>")})
    for block in range(blocks):
        # A hash of the text deals items to blocks of about block_bytes.
        some = items.where(F.pmod(F.xxhash64("text", "item"), F.lit(blocks)) == block)
        held = some.toArrow()  # at most about block_bytes of text
        out = _pass(out, item_windows(held["item"].to_pylist(), held["text"], window))
    return out


def remove_spans(docs: DataFrame) -> DataFrame:
    """Marked ``docs`` whose ``text`` lacks the spans; bytes between the words
    of a span go with it, and a blank stays in its place."""
    names, schema = docs.columns, docs.schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, _, _ in text_passes(batch["text"]):
                part = batch.slice(first, end - first)
                found = part["__spans"].to_pylist()
                if not any(found):
                    yield part
                    continue
                texts = part["text"].to_pylist()
                for i, spans in enumerate(found):
                    if spans:
                        data = texts[i].encode()
                        words = Words(data, np.array([0, len(data)]))
                        kept, at = [], 0
                        for s in spans:
                            kept.append(data[at:words.starts[s["begin"]]])
                            at = words.ends[s["end"] - 1]
                        kept.append(data[at:])
                        texts[i] = b" ".join(kept).decode()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()) if c == "text" else part[c] for c in names],
                    names=names)

    return docs.mapInArrow(lean(work), schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, spans, items`` of every document."""
    return mark_contamination(docs.select("doc_id", "text"), benchmark, window).select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__spans").alias("spans"),
        F.col("__items").alias("items"))
