"""Ranked lexical search by MaxScore with bounds of term pairs.

Documents become a forward index over the terms of the queries (items): a row
for each document with its number of words and its terms' counts.  Statistics
of the corpus come from it by plain aggregation.  Each task then inverts its
part in blocks: a posting list for each term with the documents' impacts and
the greatest of them, and for pairs of terms that items often hold together the
intersection of their lists with joint impacts and the greatest joint impact.

An item's terms are worked off by falling bounds.  Terms of a listed pair are
one unit, whose bound is the greatest joint impact or single impact, which is
less than the sum of the two maxima wherever their best documents differ.  The
``k``-th best impact known, of single terms, of pairs, and of the sums so far, is
a threshold: as soon as the bounds of the units left fall below it, no document
that hasn't been met can be among the best, and the lists left are only looked
up for documents that still can.  Bounds decide what is skipped, never what is
found: the result equals scoring every document.

Items come to the driver in blocks of ``BLOCK_BYTES`` of text; more blocks mean
more passes over the documents.  Each task sends its ``k`` best for an item.

Defined cases: null texts and texts without terms are no documents.  Every row
is a document of its own, also one of a repeated or null id (null ids last
among equal scores).  Texts under one item_id, also a null one, are one item;
an item without terms, or whose terms no document holds, has no rows.  Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from varlake.llm.common import Words, lean, text_passes, written

BLOCK_BYTES = 4 << 20  # text of items whose terms are searched in one pass
BLOCK_DOCS = 32_768  # documents inverted at once, about
BLOCK_POSTINGS = 4_000_000
PAIR_TERMS = 16  # commonest terms of an item whose pairs are counted
PAIRS = 512  # pairs with intersection lists, those that items hold most often


@dataclass
class Queries:
    """The items of one block: their terms as numbers of ``hashes``."""

    ids: list
    terms: list[np.ndarray]
    hashes: np.ndarray


def _terms(texts: list[str]) -> np.ndarray:
    """Distinct hashes of the terms of some texts."""
    found = [Words(data, at).hashes for _, _, data, at in text_passes(pa.array(texts, pa.string()))]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


def read_queries(rows: list[tuple]) -> Queries:
    """``(item_id, text)`` rows as items; texts of one id are one item."""
    texts: dict = {}
    for item, text in rows:
        texts.setdefault(item, []).append(text)
    hashes = {i: _terms(t) for i, t in texts.items()}
    hashes = {i: h for i, h in hashes.items() if len(h)}
    known = np.unique(np.concatenate(list(hashes.values()))) if hashes else np.empty(0, np.uint64)
    return Queries(list(hashes), [np.searchsorted(known, h) for h in hashes.values()], known)


def forward_index(documents: DataFrame, hashes: np.ndarray) -> DataFrame:
    """``doc_id, n, terms, counts`` of the documents that have a term: how many
    in all, which of ``hashes``, and how often."""
    rows = documents.select("doc_id", "text")
    model = rows.sparkSession.sparkContext.broadcast(hashes)  # terms of BLOCK_BYTES of text

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            for i, j, data, at in text_passes(batch.column(1)):
                words = Words(data, at)
                slot = np.searchsorted(known, words.hashes)
                mine = np.flatnonzero(np.append(known, 0)[slot] == words.hashes)
                mine = mine[slot[mine] < len(known)]
                text = np.searchsorted(words.first, mine, "right") - 1
                pair, count = np.unique(text * len(known) + slot[mine], return_counts=True)
                text, term = np.divmod(pair, max(len(known), 1))
                n = np.diff(words.first)
                where = np.searchsorted(text, np.arange(j - i + 1)).astype(np.int32)
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(where, pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(where, pa.array(count, pa.int32()))],
                    names=["doc_id", "n", "terms", "counts"])
                yield out.filter(pa.array(n > 0))

    return rows.mapInArrow(
        lean(work), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, "
        "terms array<int>, counts array<int>")


@dataclass
class Corpus:
    """What scores need of the whole corpus: documents, their terms, and the
    weight of each term."""

    documents: int
    words: int
    weights: np.ndarray


def corpus_statistics(index: DataFrame, terms: int) -> Corpus:
    total = index.agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("w")).first()
    held = np.zeros(terms, np.int64)
    for r in index.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        held[r["t"]] = r["count"]
    n = total["d"]
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) if d else 0
               for d in held.tolist()]
    return Corpus(n, total["w"] or 0, np.array(weights, np.int64))


def common_pairs(queries: Queries, corpus: Corpus) -> list[tuple[int, int]]:
    """Pairs of terms that items hold together most often, among the commonest
    of each item (those of the least weight)."""
    seen: Counter = Counter()
    for terms in queries.terms:
        order = np.lexsort((terms, corpus.weights[terms]))
        seen.update(combinations(sorted(terms[order[:PAIR_TERMS]].tolist()), 2))
    return [p for p, _ in sorted(seen.items(), key=lambda s: (-s[1], s[0]))[:PAIRS]]


def _kth(values: np.ndarray, k: int) -> int:
    """The ``k``-th greatest, 0 if there are fewer."""
    return int(np.partition(values, -k)[-k]) if len(values) >= k else 0


class Block:
    """Posting lists and pair intersections of some documents."""

    def __init__(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, count: np.ndarray,
                 corpus: Corpus, pairs: list[tuple[int, int]], k: int):
        self.size, self.k = len(n), k
        m = 100 - 50 + (50 * n * corpus.documents) // corpus.words
        impact = corpus.weights[term] * (
            (1_000_000_000 * count) // (1000 * count + 20 * m[doc]))
        order = np.argsort(term, kind="stable")
        self.doc, self.impact = doc[order], impact[order]
        present, begins = np.unique(term[order], return_index=True)
        ends = np.append(begins[1:], len(order))
        self.lists = dict(zip(present.tolist(), zip(begins.tolist(), ends.tolist())))
        self.most = {t: int(self.impact[b:e].max()) for t, (b, e) in self.lists.items()}
        self.least = {t: _kth(self.impact[b:e], k) for t, (b, e) in self.lists.items()}
        self.pairs = {p: self._joint(*p) for p in pairs
                      if p[0] in self.lists and p[1] in self.lists}
        self.read = 0  # postings read so far

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        begin, end = self.lists[term]
        return self.doc[begin:end], self.impact[begin:end]

    def _joint(self, a: int, b: int) -> tuple[int, int]:
        """Of a pair: the bound of its two terms together, and the ``k``-th
        greatest joint impact."""
        (docs_a, of_a), (docs_b, of_b) = self.postings(a), self.postings(b)
        _, at_a, at_b = np.intersect1d(docs_a, docs_b, assume_unique=True, return_indices=True)
        joint = of_a[at_a] + of_b[at_b]
        return max([self.most[a], self.most[b], *joint.max(initial=0, keepdims=True).tolist()]
                   ), _kth(joint, self.k)

    def units(self, terms: np.ndarray, use_pairs: bool = True
              ) -> tuple[list[tuple[int, tuple[int, ...]]], int]:
        """(bound, terms) of an item by falling bound, pairs where they save
        most, and a threshold known beforehand."""
        mine = [t for t in terms.tolist() if t in self.lists]
        floor = max((self.least[t] for t in mine), default=0)
        units, free = [], set(mine)
        if use_pairs:
            common = [p for p in combinations(mine, 2) if p in self.pairs]
            floor = max([floor, *(self.pairs[p][1] for p in common)])
            saving = lambda p: self.most[p[0]] + self.most[p[1]] - self.pairs[p][0]
            for p in sorted(common, key=lambda p: (-saving(p), p)):
                if saving(p) > 0 and free.issuperset(p):
                    units.append((self.pairs[p][0], p))
                    free.difference_update(p)
        units += [(self.most[t], (t,)) for t in free]
        return sorted(units, key=lambda u: (-u[0], u[1])), floor

    def best(self, terms: np.ndarray, threshold: int, use_pairs: bool = True
             ) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores), unordered, of all that may be among the ``k``
        best, given that ``k`` scores reach ``threshold`` elsewhere."""
        units, floor = self.units(terms, use_pairs)
        threshold = max(threshold, floor, 1)
        left = sum(bound for bound, _ in units)
        sums = np.zeros(self.size, np.int64)
        done = 0
        while done < len(units) and left >= threshold:
            bound, group = units[done]
            for t in group:
                docs, impact = self.postings(t)
                sums[docs] += impact
                self.read += len(docs)
            left -= bound
            done += 1
            if done % 4 == 0:
                threshold = max(threshold, _kth(sums, self.k))
        threshold = max(threshold, _kth(sums, self.k))
        docs = np.flatnonzero(sums + left >= threshold)
        scores = sums[docs]
        for bound, group in units[done:]:
            for t in group:
                listed, impact = self.postings(t)
                at = np.minimum(np.searchsorted(listed, docs), len(listed) - 1)
                scores = scores + np.where(listed[at] == docs, impact[at], 0)
                self.read += len(docs)
            left -= bound
            threshold = max(threshold, _kth(scores, self.k))
            stay = scores + left >= threshold
            docs, scores = docs[stay], scores[stay]
        found = scores > 0
        return docs[found], scores[found]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of the forward index in tables of about BLOCK_DOCS documents."""
    held, docs, postings = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_DOCS // 16):
            part = batch.slice(at, BLOCK_DOCS // 16)
            held.append(part)
            docs += part.num_rows
            postings += len(part["terms"].flatten())
            if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                yield pa.Table.from_batches(held)
                held, docs, postings = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(which row, value) of the elements of a list column."""
    values = np.concatenate([c.flatten().to_numpy() for c in column.chunks])
    sizes = np.concatenate([c.value_lengths().to_numpy() for c in column.chunks])
    return np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), values


def _pass(documents: DataFrame, queries: Queries, k: int, item_type) -> DataFrame:
    """``item_id, doc_id, score``: the ``k`` best of each task for each item."""
    index = written(forward_index(documents, queries.hashes))
    corpus = corpus_statistics(index, len(queries.hashes))
    model = index.sparkSession.sparkContext.broadcast(
        (queries, corpus, common_pairs(queries, corpus)))
    id_type = index.schema["doc_id"].dataType
    types = [to_arrow_type(item_type), to_arrow_type(id_type), pa.int64()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, corpus, pairs = model.value
        best: list[list[tuple]] = [[] for _ in queries.ids]
        for table in _blocks(batches):
            doc, term = _lists(table["terms"])
            block = Block(table["n"].to_numpy(), doc, term,
                          _lists(table["counts"])[1].astype(np.int64), corpus, pairs, k)
            ids = table["doc_id"].combine_chunks()
            for i, terms in enumerate(queries.terms):
                least = best[i][-1][0] if len(best[i]) == k else 0
                docs, scores = block.best(terms, least)
                names = ids.take(pa.array(docs, pa.int64())).to_pylist()
                best[i] = sorted([*best[i], *zip(scores.tolist(), names)],
                                 key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:k]
        rows = [(queries.ids[i], name, score) for i, found in enumerate(best)
                for score, name in found]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                names=["item_id", "doc_id", "score"])

    return index.mapInArrow(lean(work), f"item_id {item_type.simpleString()}, "
                                        f"doc_id {id_type.simpleString()}, score long")


def search_items(documents: DataFrame, benchmark: DataFrame, k: int = 50,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest
    score above 0 for each item, ties by ascending doc_id."""
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    out = None
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        queries = read_queries([tuple(r) for r in some.collect()])
        found = _pass(documents, queries, k, items.schema["item_id"].dataType)
        out = found if out is None else out.unionByName(found)
    best_first = Window.partitionBy("item_id").orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return out.withColumn("rank", F.row_number().over(best_first)).where(
        F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
