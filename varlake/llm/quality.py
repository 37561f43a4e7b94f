"""Quality scores by Bradley-Terry pairwise ranking.

A text is described by a few measures of its whole text (word length and
repetition, symbols, case, lines).  All labelled texts that are not held out give
preference pairs, every good text over every bad one; document scores are
learned by logistic loss on the difference of the pair's features, with Spark passes over
the texts' measures that sum all pairs by cells of the score.  The threshold is the quantile of the
scores at the share of bad texts, and the returned score is 0.5 there.

Defined cases: null and empty texts have all counts 0 and score as such.  With
no labelled row, or rows of one kind only, scores are 0.5 or the share of good
texts, 0 or 1.  Rows of one doc_id each get a score.  A null doc_id is scored
and never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import Words, lean, text_passes, written
from varlake.llm.labelled import is_held_out, training_labels

BINS = 10
CELLS = 128  # of the score, for the pairs' loss
STEPS = 40  # passes of the training rows, at most
DECAY = 1e-3
THRESHOLD = 0.5

MEASURES = ["words", "word_bytes", "word_spread", "longest_word", "long_words", "short_words",
            "distinct", "herdan", "repeated", "upper", "digits", "symbols", "bars", "blanks",
            "lines", "line_bytes", "wide_bytes"]


def _byte_sets() -> list[np.ndarray]:
    """Membership of each byte value, for the measures that count bytes."""
    def members(values) -> np.ndarray:
        t = np.zeros(256, bool)
        t[list(values)] = True
        return t

    symbols = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
    return [members(x) for x in (range(0x41, 0x5B), range(0x30, 0x3A), symbols, b"|", b" \t",
                                 b"\n", range(0x80, 0x100))]


def text_measures(data: bytes, at: np.ndarray) -> np.ndarray:
    """One row of ``MEASURES`` per text."""
    words = Words(data, at)
    raw = np.frombuffer(data, np.uint8)
    size = np.diff(at).astype(float)
    count = np.diff(words.first).astype(float)
    texts = len(at) - 1
    text = np.repeat(np.arange(texts), np.diff(words.first))
    length = (words.ends - words.starts).astype(float)
    n = np.maximum(count, 1)
    mean = np.bincount(text, length, texts) / n
    spread = np.sqrt(np.maximum(np.bincount(text, length**2, texts) / n - mean**2, 0))
    longest = np.zeros(texts)
    np.maximum.at(longest, text, length)
    order = np.lexsort((words.hashes, text))
    same = (np.diff(words.hashes[order]) == 0) & (np.diff(text[order]) == 0)
    distinct = count - np.bincount(text[order][1:][same], minlength=texts)
    next_same = (words.hashes[1:] == words.hashes[:-1]) & (text[1:] == text[:-1])
    repeated = np.bincount(text[1:][next_same], minlength=texts)
    sums = []
    for members in _byte_sets():
        total = np.concatenate([[0], np.cumsum(members[raw], dtype=np.int64)])
        sums.append(np.diff(total[at]).astype(float))
    upper, digits, symbols, bars, blanks, breaks, wide = sums
    b = np.maximum(size, 1)
    return np.stack([
        np.log1p(count), mean, spread, np.log1p(longest),
        np.bincount(text, length > 14, texts) / n, np.bincount(text, length < 3, texts) / n,
        distinct / n, np.log1p(distinct) / np.log1p(n), repeated / n,
        upper / b, digits / b, symbols / b, bars / b, blanks / b,
        np.log1p(breaks), np.log1p(size / (breaks + 1)), wide / b,
    ], axis=1)


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``measures`` (array of doubles) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("measures", pa.list_(pa.float64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, at in text_passes(batch.column(1)):
                m = text_measures(data, at)
                rows = pa.ListArray.from_arrays(
                    np.arange(j - i + 1, dtype=np.int32) * m.shape[1], m.ravel())
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), rows], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lean(work), "doc_id long, measures array<double>")


@dataclass(frozen=True)
class Ranking:
    """Bin edges of each measure, the learned weight of each bin, and the
    score at the threshold."""

    edges: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, measures: np.ndarray) -> np.ndarray:
        return _binned(measures, self.edges) @ self.weights

    def score(self, measures: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(measures) - self.threshold, -500, 500)))


def _binned(measures: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For each measure and edge, how far above the edge the value is (0 to 1)."""
    width = np.maximum(np.diff(edges, axis=0), 1e-9)  # of each measure's bins
    return np.clip((measures[:, None, :] - edges[None, :-1]) / width[None], 0, 1).reshape(
        len(measures), -1)


def _cell_of(scores: np.ndarray, low: float, high: float) -> np.ndarray:
    """The cell of each score, ``CELLS`` of equal width from ``low`` to ``high``."""
    return np.clip((scores - low) / max(high - low, 1e-9) * CELLS, 0, CELLS - 1).astype(np.int64)


def _sums(rows: DataFrame, edges: np.ndarray, w: np.ndarray, low: float, high: float) -> np.ndarray:
    """Per kind (bad, good) and cell of the score: how many training rows there are,
    the sum of their scores, and the sums of their features.  Every row
    takes part; a task ships one row for each kind and cell that it has."""
    width = len(w) + 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2 * CELLS, width))
        for batch in batches:
            y = batch.column(1).to_numpy()
            m = batch.column(0).flatten().to_numpy().reshape(-1, len(MEASURES))
            for at in range(0, len(m), 4096):
                x = _binned(m[at:at + 4096], edges)
                scores = x @ w
                slot = y[at:at + 4096] * CELLS + _cell_of(scores, low, high)
                order = np.argsort(slot, kind="stable")
                first = np.flatnonzero(np.diff(slot[order], prepend=-1))
                part = np.column_stack([np.ones(len(x)), scores, x])[order]
                total[slot[order][first]] += np.add.reduceat(part, first, axis=0)
        yield held(total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2 * CELLS, width))
        for batch in batches:
            np.add.at(total, batch.column(0).to_numpy(),
                      batch.column(1).flatten().to_numpy().reshape(-1, width))
        yield held(total)

    def held(total: np.ndarray) -> pa.RecordBatch:
        slots = np.flatnonzero(total[:, 0])
        sums = pa.ListArray.from_arrays(np.arange(len(slots) + 1, dtype=np.int32) * width,
                                        total[slots].ravel())
        return pa.RecordBatch.from_arrays([pa.array(slots), sums], names=["slot", "sums"])

    schema = "slot long, sums array<double>"
    found = rows.select("measures", "y").mapInArrow(lean(work), schema).repartition("slot").mapInArrow(
        lean(added), schema)
    out = np.zeros((2 * CELLS, width))
    for r in found.collect():  # at most 2 * CELLS rows, however many texts there are
        out[r["slot"]] = r["sums"]
    return out.reshape(2, CELLS, width)


def _quantiles(rows: DataFrame, shares: np.ndarray) -> np.ndarray:
    """Quantiles of each measure over all ``rows``, by rank to 1 / 10,000: a row per
    share."""
    picked = [F.percentile_approx(F.col("measures")[i], [float(q) for q in shares], 10_000)
              for i in range(len(MEASURES))]
    return np.array(list(rows.agg(*picked).first()), float).T


def _quantile(raw: DataFrame, n: int, share: float) -> float:
    """The exact quantile of the ``n`` rows of ``raw``, between its two neighbours; only rows
    near it meet in one task."""
    ends = [max(share - 0.002, 0.0), min(share + 0.002, 1.0)]
    low, high = raw.agg(F.percentile_approx("raw", ends, 10_000)).first()[0]
    near = F.col("raw").between(low, high)
    below, count = raw.agg(F.count_if(F.col("raw") < low), F.count_if(near)).first()
    place = ((n - 1) * share - below) / max(count - 1, 1)
    return float(raw.where(near).agg(F.percentile("raw", F.lit(min(max(place, 0.0), 1.0)))).first()[0])


def _least(loss, w: np.ndarray) -> np.ndarray:
    """The weights of least ``loss`` (value and gradient; ``STEPS`` calls at most): steps along
    the gradient, bent by the last ones' curvature (L-BFGS), halved until they help."""
    value, grad = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    calls, rate = 1, 1.0
    while calls < STEPS and np.abs(grad).max() > 1e-5:
        turn, shares = grad.copy(), []
        for s, y in reversed(past):
            shares.append((s @ turn) / (s @ y))
            turn -= shares[-1] * y
        turn *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1.0
        for (s, y), share in zip(past, reversed(shares)):
            turn += (share - (y @ turn) / (s @ y)) * s
        rate = 1.0
        while calls < STEPS:
            after, grad_after = loss(w - rate * turn)
            calls += 1
            if after <= value - 1e-4 * rate * (grad @ turn):
                break
            rate /= 2
        else:
            return w
        s, y = -rate * turn, grad_after - grad
        if s @ y > 1e-12:
            past = [*past, (s, y)][-10:]
        w, value, grad = w + s, after, grad_after
    return w


def fit_ranking(rows: DataFrame, good: int, bad: int) -> Ranking:
    """Weights by gradient steps on the logistic loss of all pairs of a good and a bad
    text in ``rows`` (``measures``, ``y``).

    A pair's loss depends on the two scores alone, so the gradient of all
    ``good * bad`` pairs needs, per cell of the score, only the rows' number, mean score and summed
    features: one pass of the rows a step, and no pair is drawn or left out.
    Scores of a cell count as the cell's mean, 1 / ``CELLS`` of the range apart at
    most."""
    inner = _quantiles(rows, np.linspace(0, 1, BINS + 1))
    low_end = _quantiles(rows.where("y = 0"), np.linspace(0, 1, BINS // 2 + 1))
    edges = np.sort(np.concatenate([inner, low_end]), axis=0)
    size = (len(edges) - 1) * len(MEASURES)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        # Features are from 0 to 1: no score is beyond these ends.
        low, high = float(np.minimum(w, 0).sum()), float(np.maximum(w, 0).sum())
        (n_b, s_b, x_b), (n_g, s_g, x_g) = ((t[:, 0], t[:, 1], t[:, 2:]) for t in _sums(
            rows, edges, w, low, high))
        gap = (s_g / np.maximum(n_g, 1))[:, None] - (s_b / np.maximum(n_b, 1))[None]
        weight = n_g[:, None] * n_b[None] / (good * bad)
        wrong = weight / (1 + np.exp(np.clip(gap, -500, 500)))  # pairs, by how wrong they are
        pull = (wrong.sum(axis=1) / np.maximum(n_g, 1)) @ x_g - (
            wrong.sum(axis=0) / np.maximum(n_b, 1)) @ x_b
        value = (weight * np.logaddexp(0, -gap)).sum() + DECAY / 2 * w @ w
        return value, DECAY * w - pull

    w = _least(loss, np.zeros(size))
    learned = Ranking(edges, w, 0.0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.column(0).flatten().to_numpy().reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([pa.array(learned.raw(m))], names=["raw"])

    raw = written(rows.select("measures").mapInArrow(lean(work), "raw double"))
    return Ranking(edges, w, _quantile(raw, good + bad, bad / (good + bad)))


def train(features: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 3,
          rest: int = 1) -> Ranking | float:
    """The ranking learned from all documents with a label whose id's remainder is
    not ``rest``; without both kinds of label the constant score."""
    y = training_labels(labels, label, modulus, rest, None)
    rows = written(features.join(y, F.col("doc_id") == F.col("__lid")).select(
        "measures", F.col("__y").alias("y")).distinct())  # copies count once
    kinds = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not kinds:
        return THRESHOLD
    if len(kinds) == 1:
        return float(*kinds)
    return fit_ranking(rows, kinds[1], kinds[0])


def quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, rest: int = 1) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    features = written(measured(docs))
    ranking = train(features, labels, "quality", modulus, rest)
    if isinstance(ranking, float):
        scored = features.withColumn("score", F.lit(ranking)).drop("measures")
    else:
        model = docs.sparkSession.sparkContext.broadcast(ranking)  # some hundred numbers

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                m = batch.column(1).flatten().to_numpy().reshape(-1, len(MEASURES))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(model.value.score(m))], names=["doc_id", "score"])

        scored = features.mapInArrow(lean(work), "doc_id long, score double")
    return scored.select(
        "doc_id", is_held_out("doc_id", modulus, rest).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
