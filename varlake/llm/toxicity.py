"""Toxicity scores by a factorization machine over hashed terms.

Terms are a text's distinct words and the first bytes of its longer words,
hashed into ``BUCKETS``.  On labelled texts (a bounded sample, near copies
of one label counted once) the buckets that toxic texts hold more often than chance are
chosen, and their partners: terms that may be neutral or lean to clean alone,
but make a pair with another term that is more often toxic than either, or
make a chosen term harmless.  Over these the machine learns a weight per term
and an interaction per pair of terms, such as an insult with a mention of a
group, through factors of ``FACTORS`` numbers each.

Pairs are counted among the chosen terms and ``CANDIDATES`` others: half are
those that most toxic texts hold, half those that lean most to clean in texts
with a chosen term.

Defined cases: null and empty texts score as texts without terms.  No labelled
row: every score is 0.  Rows of one doc_id each get a score.  A null doc_id is
scored and never learned from.  Very long texts are read whole; a term counts
once per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varlake.llm.common import Words, lean, shingle_hashes, text_passes, written
from varlake.llm.labelled import is_held_out, training_labels

BUCKETS = 1 << 22
PREFIXES = (4, 5)  # bytes of a longer word that are terms of their own
MAX_TRAINING_ROWS = 50_000  # labelled documents learned from, at most about
NEAR = 4  # least shingle hashes in which near copies agree
MAX_TERMS = 4096
LEAST_Z = 6.0  # standard deviations above chance
LEAST_TOXIC = 5  # toxic texts that hold a term
CANDIDATES = 2048  # other terms of which pairs are counted, at most
PARTNERS = 1024  # of them that are learned from, at most
FACTORS = 8
EPOCHS = 20
BATCH = 512  # texts of a step, at most
STEPS = 600  # at least
THRESHOLD = 0.3


def text_terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word and long word's beginning, repeats included."""
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    text = np.repeat(np.arange(len(words.text_at) - 1), np.diff(words.first))
    texts, hashes = [text], [words.hashes]
    for size in PREFIXES:
        long = np.flatnonzero(words.ends - words.starts > size)
        texts.append(text[long])
        hashes.append(words.cut(long, size))
    return np.concatenate(texts), (np.concatenate(hashes) >> shift).astype(np.int64)


def _labelled_terms(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``y``, ``near`` (the least ``NEAR`` shingle hashes, equal for many near
    copies) and ``terms`` (binary,
    distinct buckets as unsigned 32-bit) of each labelled document."""
    schema = pa.schema([("y", pa.int32()), ("near", pa.binary()), ("terms", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy()
            for i, j, data, at in text_passes(batch.column(0)):
                words = Words(data, at)
                text, bucket = text_terms(words)
                pairs = np.unique(text * BUCKETS + bucket)
                first = np.searchsorted(pairs, np.arange(j - i + 1) * BUCKETS)
                terms = (pairs % BUCKETS).astype("<u4")
                near = [shingle_hashes(words.hashes[a:b], 5)[:NEAR].tobytes()
                        for a, b in zip(words.first, words.first[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(label[i:j], pa.int32()),
                    pa.array(near, pa.binary()),
                    pa.array([terms[a:b].tobytes() for a, b in zip(first, first[1:])]),
                ], schema=schema)

    # At most about MAX_TRAINING_ROWS rows of two numbers.
    chosen = docs.select("doc_id", "text").join(
        F.broadcast(labels), F.col("doc_id") == F.col("__lid"))
    return chosen.select("text", "__y").mapInArrow(lean(work), "y int, near binary, terms binary")


def _term_counts(rows: DataFrame, beside: np.ndarray | None = None) -> DataFrame:
    """``bucket, toxic, clean``: labelled texts of either kind that hold a term
    (and one of ``beside``, if given), summed in each task before the shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int32)
        for batch in batches:
            for y, terms in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = np.frombuffer(terms, "<u4")
                if beside is None or np.isin(held, beside, kind="sort").any():
                    counts[y, held] += 1
        held = np.flatnonzero(counts.any(axis=0))
        for at in range(0, len(held), 1 << 16):
            part = held[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int64)), pa.array(counts[1, part].astype(np.int64)),
                 pa.array(counts[0, part].astype(np.int64))], names=["bucket", "toxic", "clean"])

    found = rows.select("y", "terms").mapInArrow(lean(work), "bucket long, toxic long, clean long")
    return found.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


@dataclass(frozen=True)
class Machine:
    """Term buckets (sorted) with the machine's bias, weights and factors."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, row: np.ndarray, term: np.ndarray, rows: int) -> np.ndarray:
        """For (row, index of term) pairs, sorted by row and without repeats."""
        linear = np.bincount(row, self.weights[term], rows)
        sums, squares = np.zeros((rows, FACTORS)), np.zeros(rows)
        for f in range(FACTORS):
            v = self.factors[term, f]
            sums[:, f] = np.bincount(row, v, rows)
            squares += np.bincount(row, v * v, rows)
        return self.bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def fit_machine(terms: np.ndarray, y: np.ndarray, texts: list[np.ndarray],
                seed: int = 1) -> Machine:
    """Logistic loss by Adam in small batches.  ``texts`` has the term indices
    of each labelled text."""
    rng = np.random.default_rng(seed)
    n, rate = len(terms), 0.02
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 1e-3
    params = {"bias": np.array([np.log(share / (1 - share))]), "weights": np.zeros(n),
              "factors": rng.normal(0, 0.02, (n, FACTORS))}
    decay = {"bias": 0.0, "weights": 1e-4, "factors": 1e-3}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    step, size = 0, int(np.clip(len(y) // 20, 16, BATCH))
    epochs = max(EPOCHS, -(-STEPS // max(1, -(-len(y) // size))))
    for _ in range(epochs if n and len(y) else 0):
        order = rng.permutation(len(y))
        for at in range(0, len(order), size):
            batch = order[at:at + size]
            row = np.repeat(np.arange(len(batch)), [len(texts[i]) for i in batch])
            held = np.zeros((len(batch), n))
            held[row, np.concatenate([texts[i] for i in batch]).astype(np.int64)] = 1
            v = params["factors"]
            sums, squares = held @ v, held @ (v**2).sum(axis=1)
            logits = params["bias"][0] + held @ params["weights"] + 0.5 * (
                (sums**2).sum(axis=1) - squares)
            wrong = (_sigmoid(logits) - y[batch]) / len(batch)
            pull = wrong @ held
            g = {"bias": np.array([wrong.sum()]), "weights": pull,
                 "factors": held.T @ (wrong[:, None] * sums) - v * pull[:, None]}
            step += 1
            for k, p in params.items():
                grad = g[k] + decay[k] * p
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                p -= rate * (first[k] / (1 - 0.9**step)) / (
                    np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Machine(terms, float(params["bias"][0]), params["weights"], params["factors"])


def partners(bits: np.ndarray, y: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Up to ``PARTNERS`` terms of which a pair deviates from the more toxic of
    its terms.  ``bits`` has the terms of each text, packed, and ``alone`` says
    which terms are chosen on their own; these aren't returned."""
    n = len(alone)
    both = np.zeros((2, n, n), np.float32)  # clean, toxic texts that hold two terms
    for kind in (0, 1):
        some = bits[y == kind]
        for at in range(0, len(some), 4096):
            held = np.unpackbits(some[at:at + 4096], axis=1, count=n).astype(np.float32)
            both[kind] += held.T @ held
    clean, toxic = both[0].diagonal(), both[1].diagonal()
    rate = toxic / np.maximum(toxic + clean, 1)
    best = np.zeros(n)
    for at in range(0, n, 256):
        part = slice(at, at + 256)
        c, t = both[0, part], both[1, part]
        chance = np.clip(np.maximum.outer(rate[part], rate), y.mean(), 1 - 1e-3)
        z = (t - (t + c) * chance) / np.sqrt((t + c) * chance * (1 - chance) + 1e-9)
        worse = (z >= LEAST_Z) & (t >= LEAST_TOXIC)
        harmless = (z <= -LEAST_Z) & (c >= LEAST_TOXIC) & (alone[part, None] != alone)
        z = np.where(worse | harmless, np.abs(z), 0)
        z[np.arange(len(z)), np.arange(at, at + len(z))] = 0
        best[part] = z.max(axis=1)
    best[alone] = 0
    found = np.flatnonzero(best)
    return np.sort(found[np.lexsort((found, -best[found]))][:PARTNERS])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4,
          rest: int = 2, max_rows: int = MAX_TRAINING_ROWS) -> Machine | None:
    """The machine learned from documents with a label whose id's remainder is
    not ``rest``; None without such rows."""
    y = training_labels(labels, label, modulus, rest, max_rows)
    rows = written(written(_labelled_terms(docs, y)).groupBy("near", "y").agg(
        F.min("terms").alias("terms")))
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("toxic")).first()
    n, toxic = totals["n"], totals["toxic"] or 0
    if not n:
        return None
    held = F.col("toxic") + F.col("clean")
    chance = F.lit(toxic / n)
    z = (F.col("toxic") - held * chance) / F.sqrt(held * chance * (1 - chance) + 1e-9)
    counts = written(_term_counts(rows).withColumn("z", z))

    def buckets(found: DataFrame, most: int, *order: Column) -> np.ndarray:
        rows = found.orderBy(*order, "bucket").limit(most).select("bucket").collect()
        return np.array(sorted(r["bucket"] for r in rows), np.int64)

    toxic_alone = (F.col("z") >= LEAST_Z) & (F.col("toxic") >= LEAST_TOXIC)
    lean_to_toxic = buckets(counts.where(toxic_alone), MAX_TERMS, F.col("z").desc())
    most = min(CANDIDATES, MAX_TERMS - len(lean_to_toxic)) // 2
    others = counts.where(~toxic_alone)
    often = buckets(others.where(F.col("toxic") >= LEAST_TOXIC), most, F.col("toxic").desc())
    beside = _term_counts(rows, lean_to_toxic).withColumn("z", z).where(
        (F.col("clean") >= LEAST_TOXIC) & (F.col("z") < 0)).join(
            others.select("bucket"), "bucket")
    soothing = buckets(beside, most, F.col("z"))
    counted = np.unique(np.concatenate([lean_to_toxic, often, soothing]))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for binary in batch.column(1).to_pylist():
                out.append(np.packbits(np.isin(counted, np.frombuffer(binary, "<u4"))).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())],
                                             names=["y", "terms"])

    # About max_rows rows of at most MAX_TERMS bits.
    learned = rows.select("y", "terms").mapInArrow(lean(chosen), "y int, terms binary").collect()
    learned.sort(key=lambda r: (r["terms"], r["y"]))
    y = np.array([r["y"] for r in learned], float)
    bits = np.frombuffer(b"".join(r["terms"] for r in learned), np.uint8).reshape(len(y), -1)
    alone = np.isin(counted, lean_to_toxic)
    taken = alone.copy()
    taken[partners(bits, y, alone)] = True
    place = np.cumsum(taken) - 1
    texts = [place[np.flatnonzero(np.unpackbits(b, count=len(counted)) & taken)].astype(np.uint16)
             for b in bits]
    return fit_machine(counted[taken], y, texts)


def score_texts(docs: DataFrame, machine: Machine | None, name: str = "score") -> DataFrame:
    """``docs`` plus the score."""
    spark = docs.sparkSession
    if machine is None:
        return docs.withColumn(name, F.lit(0.0))
    model = spark.sparkContext.broadcast(machine)  # at most MAX_TERMS * (FACTORS + 2) numbers
    at_text = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        index = np.full(BUCKETS, -1, np.int16)
        index[m.terms] = np.arange(len(m.terms))
        for batch in batches:
            for i, j, data, at in text_passes(batch.column(at_text)):
                text, bucket = text_terms(Words(data, at))
                term = index[bucket]
                held = term >= 0
                pairs = np.unique(text[held] * (MAX_TERMS + 1) + term[held])
                row, term = np.divmod(pairs, MAX_TERMS + 1)
                # A batch for each pass: the JVM holds one at a time in buffers that it keeps.
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, j - i).columns,
                     pa.array(_sigmoid(m.logits(row, term, j - i)), pa.float64())],
                    names=[*batch.schema.names, name])

    return docs.mapInArrow(lean(work), schema)


def toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 4, rest: int = 2) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    machine = train(docs, labels, "toxic", modulus, rest)
    return score_texts(docs.select("doc_id", "text"), machine).select(
        "doc_id", is_held_out("doc_id", modulus, rest).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
