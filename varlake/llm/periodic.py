"""Runs of repeated words, by a suffix automaton whose last occurrences are
kept in a link-cut forest.

A run is a stretch of consecutive words with smallest period ``q`` that no
neighbouring word extends and that holds at least ``2 q`` and ``least`` words.
Words are appended to a suffix automaton one by one.  The suffix links form a
tree in which the path from the newest state to the root holds all suffixes of
the text so far; the preferred paths of a link-cut forest over it are exactly
the path segments whose strings last ended at one position.  Appending word
``i`` recolours its path to ``i``.  A recoloured segment that ended at ``p`` and
whose longest string has ``m`` words says that the ``m`` words up to ``p`` and up
to ``i`` are equal and no longer ones are; ``m >= i - p`` is a square of period
``i - p``, and the words ``i - p - m + 1 .. i`` are its run so far.  The last
occurrence of the longest string is the nearest, so that period is the
smallest.

A run of ``least`` words has ``least / 2`` words or more besides its first or
last period, so its words all stand in phrases of ``least / 2`` words that occur
twice in it.  Only stretches covered by such phrases enter an automaton; the
others can't be part of a run.

Defined cases: null and empty texts have no words and no runs.  Rows of one
doc_id are each judged.  A text is worked on whole by one task, with about
700 bytes for each word of its repeated stretches.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from varlake.llm.common import lean

LEAST = 12  # words of a run
_PRIME = np.uint64(0x9E3779B97F4A7C15)

RUNS = "array<struct<start:long,length:long,period:long>>"
Words = list[bytes]


class LastOccurrences:
    """A link-cut forest over the suffix-link tree.  Each splay tree is a path
    of states that last occurred at the position its root is marked with;
    the left subtree holds shorter strings.  The tree's root is left out."""

    def __init__(self) -> None:
        self.up, self.left, self.right, self.seen = [-1], [-1], [-1], [-1]

    def add(self, parent: int) -> None:
        """A state below ``parent`` (0: the root)."""
        self.up.append(parent or -1)
        self.left.append(-1)
        self.right.append(-1)
        self.seen.append(-1)

    def add_above(self, state: int) -> None:
        """A state between ``state`` and its parent, seen where ``state`` was."""
        up, left = self.up, self.left
        new = len(up)
        self.splay(state)
        shorter = left[state]
        up.append(state)
        left.append(shorter)
        self.right.append(-1)
        self.seen.append(-1)
        if shorter >= 0:
            up[shorter] = new
        left[state] = new

    def splay(self, x: int) -> None:
        up, left, right, seen = self.up, self.left, self.right, self.seen
        while True:
            y = up[x]
            if y < 0 or (left[y] != x and right[y] != x):
                return
            z = up[y]
            if z >= 0 and (left[z] == y or right[z] == y) and (left[y] == x) == (left[z] == y):
                turned = y  # zig-zig: the parent first
                y, z = z, up[z]
            else:
                turned = x
            if left[y] == turned:
                inner = right[turned]
                right[turned] = y
                left[y] = inner
            else:
                inner = left[turned]
                left[turned] = y
                right[y] = inner
            if inner >= 0:
                up[inner] = y
            up[y] = turned
            up[turned] = z
            if z >= 0:
                if left[z] == y:
                    left[z] = turned
                elif right[z] == y:
                    right[z] = turned
            seen[turned] = seen[y]  # only the root's mark counts

    def recolour(self, state: int, position: int) -> Iterator[tuple[int, int]]:
        """Mark the path from a new ``state`` to the root; yields (deepest state,
        position before) of the segments that had one, from below."""
        up, right, seen = self.up, self.right, self.seen
        below, y = state, up[state]
        while y >= 0:
            self.splay(y)
            before = seen[y]
            yield y, before
            deeper = right[y]
            if deeper >= 0:
                seen[deeper] = before
            right[y] = below
            below, y = y, up[y]
        seen[below] = position


def squares(word: Sequence[int]) -> dict[tuple[int, int], int]:
    """``{(start, period): end}`` of all runs of two periods or more (``end``
    is the last word's number)."""
    link, length = [-1], [0]
    edges: list[dict[int, int]] = [{}]
    forest = LastOccurrences()
    found: dict[tuple[int, int], int] = {}
    last = 0
    for i, c in enumerate(word):
        new = len(link)
        link.append(0)
        length.append(i + 1)
        edges.append({})
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        parent, twin = 0, -1
        if p >= 0:
            q = edges[p][c]
            if length[q] == length[p] + 1:
                parent = q
            else:
                twin = parent = new + 1
        link[new] = parent
        if twin < 0:
            forest.add(parent)
        else:
            link.append(link[q])
            length.append(length[p] + 1)
            edges.append(edges[q].copy())
            link[q] = twin
            while p >= 0 and edges[p].get(c) == q:
                edges[p][c] = twin
                p = link[p]
            forest.add(0)  # new, hung below its twin once that is there
            forest.add_above(q)
            forest.up[new] = twin
        for state, before in forest.recolour(new, i):
            period = i - before
            if length[state] >= period:
                found[before - length[state] + 1, period] = i
        last = new
    return found


def _covered(ids: np.ndarray, k: int) -> np.ndarray:
    """Which words stand in a phrase of ``k`` words that occurs twice."""
    h = np.zeros(len(ids) - k + 1, np.uint64)
    for j in range(k):
        h = (h ^ (h >> np.uint64(29))) * _PRIME + ids[j:len(ids) - k + 1 + j]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(ids) + 1, np.int32)
    at = np.flatnonzero(twice)
    np.add.at(change, at, 1)
    np.add.at(change, at + k, -1)
    return np.cumsum(change[:-1]) > 0


def repeated_stretches(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """(begin, end) of the stretches that every run of ``least`` words lies
    in.  A stretch is cut again until cutting no longer shortens it by much."""
    out, open_ = [], [(0, len(ids))]
    while open_:
        begin, end = open_.pop()
        if end - begin < least:
            continue
        inside = _covered(ids[begin:end], -(-least // 2))
        edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
        for b, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if 8 * (e - b) >= 7 * (end - begin):
                out.append((begin + b, begin + e))
            else:
                open_.append((begin + b, begin + e))
    return out


def runs_of(words: Words, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``words``, by start and period."""
    if len(words) < least:
        return []
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    runs = []
    for begin, end in repeated_stretches(ids, least):
        for (start, period), last in squares(ids[begin:end].tolist()).items():
            if last - start + 1 >= least:
                runs.append((begin + start, last - start + 1, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def without_repeats(words: Words, runs: Sequence[tuple[int, int, int]]) -> Words:
    """``words`` without those a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


def find_runs(documents: DataFrame, least: int = LEAST,
              rewrite: Callable[[int | None, Words], Words] | None = None) -> DataFrame:
    """``doc_id, n_words, runs, kept_text`` of every document: its runs of words
    (``[^\\x20\\x09-\\x0D]+``), and its words without the repeats, joined by a
    blank.  ``rewrite(doc_id, words)`` may change the words first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        for batch in batches:
            ids = batch.column(0)
            counts, found, kept = [], [], []
            for doc_id, text in zip(ids.to_pylist(), batch.column(1).cast(pa.binary())):
                words = (text.as_py() or b"").split()  # at ASCII white space
                if rewrite:
                    words = rewrite(doc_id, words)
                runs = runs_of(words, least)
                counts.append(len(words))
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                kept.append(b" ".join(without_repeats(words, runs)).decode())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(counts, pa.int64()), pa.array(found, kind),
                 pa.array(kept, pa.string())], names=["doc_id", "n_words", "runs", "kept_text"])

    rows = documents.select("doc_id", "text")
    return rows.mapInArrow(
        lean(work), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, "
        f"runs {RUNS}, kept_text string")
