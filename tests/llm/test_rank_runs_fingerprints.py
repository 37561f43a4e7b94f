"""Ranked search, periodic runs and fingerprints against plain Python, also
through their registered queries on odd, repeated and empty tables."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from varlake.llm import pair_maxscore, periodic, queries, winnowing

from .helpers import documents, odd_documents, words

SEPARATORS = " \t\n\x0b\x0c\r"


def corpus(seed=7):
    """Odd documents, and texts with common words, copies and repeats."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    common = ["the", "of", "and", "to", "in", "is"]
    rows = []
    for i in range(400):
        n = rng.randrange(0, 120)
        text = [rng.choice(common if rng.random() < 0.4 else vocabulary) for _ in range(n)]
        if i % 5 == 0 and n > 4:
            a = rng.randrange(n)
            text += text[a:] * rng.randrange(1, 5)
        rows.append((1000 + i, rng.choice(SEPARATORS).join(text), "en", 0.5, 1))
    rows += [(2000 + i, rows[i][1], "en", 0.5, 1) for i in range(0, 60, 3)]
    return rows + odd_documents()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(3)
    at = str(tmp_path_factory.mktemp("tables"))
    documents(spark, corpus()).write.parquet(f"{at}/documents.parquet")
    items = [(i, " ".join(rng.choice(["the", "of", "THE", "w1", "and"] + [f"w{j}" for j in range(300)])
                          for _ in range(rng.randrange(1, 25))), 1.0) for i in range(40)]
    items += [(40, None, None), (41, "", 0.0), (42, "!!!", 0.0), (43, "nowhere", 0.0), (None, "É Ñ", 0.0),
              (0, items[0][1], 0.0), (1, "another text of the same item", 0.0)]
    spark.createDataFrame(items, "item_id long, text string, score double").write.parquet(
        f"{at}/benchmark.parquet")
    return at


# --- ranked search ----------------------------------------------------------

def brute_ranks(docs, items, k):
    found = [(i, words(t)) for i, t, *_ in docs]
    found = [(i, w) for i, w in found if w]
    n_docs, n_words = len(found), sum(len(w) for _, w in found)
    held = Counter(t for _, w in found for t in set(w))
    terms = {}
    for item, text, *_ in items:
        if text is not None:
            terms.setdefault(item, set()).update(words(text))
    out = Counter()
    for item, wanted in terms.items():
        scores = []
        for doc_id, w in found:
            tf, score = Counter(w), 0
            m = 100 - 50 + (50 * len(w) * n_docs) // n_words
            for t in wanted & set(tf):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                score += weight * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:k], 1):
            out[item, rank, doc_id, -score] += 1
    return out


def test_query_ranks_as_scoring_every_document(spark, folder):
    got = queries.op11_pair_maxscore(spark, folder).select("item_id", "rank", "doc_id", "score")
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = brute_ranks(corpus(), items, 50)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert {r[0] for r in want} >= {None, 0, 1}


def test_item_blocks_and_document_blocks_change_nothing(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    rows = lambda df: Counter(tuple(r) for r in df.collect())
    want = rows(pair_maxscore.search_items(docs, items, 5))
    assert rows(pair_maxscore.search_items(docs, items, 5, block_bytes=800)) == want
    assert want == brute_ranks(corpus(), [tuple(r) for r in items.collect()], 5)


def test_empty_tables_have_no_ranks(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    assert pair_maxscore.search_items(docs.limit(0), items).count() == 0
    assert pair_maxscore.search_items(docs, items.limit(0)).count() == 0
    assert pair_maxscore.search_items(docs.where(F.col("text").isNull()), items).count() == 0


def _block(rng, k, pairs):
    """Two commonest terms that mostly exclude each other, and rarer ones."""
    doc, term, count = [], [], []
    for d in range(3000):
        held = {0 if d % 2 else 1: rng.randrange(1, 9)}
        if d % 50 == 0:
            held = {0: 1, 1: 1}
        held |= {2 + rng.randrange(60): rng.randrange(1, 5) for _ in range(6)}
        for t, c in held.items():
            doc.append(d), term.append(t), count.append(c)
    doc, term, count = (np.array(x, np.int64) for x in (doc, term, count))
    n = np.bincount(doc, count).astype(np.int64) + 5
    corpus = pair_maxscore.Corpus(3000, int(n.sum()), np.array([900, 950] + [3000] * 60))
    return pair_maxscore.Block(n, doc, term, count, corpus, pairs, k)


def test_pair_bounds_skip_more_and_lose_nothing():
    rng = random.Random(2)
    block = _block(rng, 10, [(0, 1)])
    assert block.pairs[0, 1][0] < block.most[0] + block.most[1]
    read = {}
    for use in (False, True):
        block.read = 0
        for seed in range(40):
            terms = np.array([0, 1, *random.Random(seed).sample(range(2, 62), 4)])
            docs, scores = block.best(terms, 0, use)
            full = np.zeros(block.size, np.int64)
            for t in terms.tolist():
                np.add.at(full, block.postings(t)[0], block.postings(t)[1])
            edge = np.sort(full)[-10]
            assert dict(zip(docs.tolist(), scores.tolist())).items() >= {
                d: full[d] for d in np.flatnonzero(full >= edge).tolist()}.items()
            assert (scores == full[docs]).all()
        read[use] = block.read
    lists = 40 * sum(len(block.postings(t)[0]) for t in (0, 1))
    assert read[True] < read[False] and read[True] < lists


# --- periodic runs ----------------------------------------------------------

def smallest_period(w):
    return next(p for p in range(1, len(w) + 1) if w[p:] == w[:len(w) - p])


def brute_runs(w, least=12):
    out = []
    for q in range(1, len(w) // 2 + 1):
        same = [w[i] == w[i + q] for i in range(len(w) - q)] + [False]
        i = 0
        while i < len(same):
            j = i
            while same[j]:
                j += 1
            if j - i + q >= max(least, 2 * q) and j > i and smallest_period(w[i:j + q]) == q:
                out.append((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_automaton_finds_the_runs_of_brute_force():
    rng = random.Random(11)
    for _ in range(1500):
        n, letters = rng.randrange(0, 60), rng.randrange(1, 5)
        w = [b"%d" % rng.randrange(letters) for _ in range(n)]
        if n > 5 and rng.random() < 0.5:
            s, p = rng.randrange(n), rng.randrange(1, 9)
            w = [w[i] if i < s else w[s + (i - s) % min(p, n - s)] for i in range(n)]
        least = rng.choice([2, 5, 12])
        assert periodic.runs_of(w, least) == brute_runs(w, least), (w, least)


def test_known_words_in_order():
    run = [b"a", b"b", b"a", b"b", b"a"] * 4  # period 5 over four repeats
    assert (0, 20, 5) in periodic.runs_of(run)
    assert periodic.without_repeats(run, [(0, 20, 5)]) == run[:5]
    assert periodic.runs_of([b"x"] * 11) == [] and periodic.runs_of([b"x"] * 12) == [(0, 12, 1)]


def test_query_equals_brute_force(spark, folder):
    def row(doc_id, text):
        w = queries.planted_words(doc_id, (text or "").encode().split())
        runs = brute_runs(w) if len(w) < 3000 else periodic.runs_of(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        return (doc_id, len(runs), s, n, q, 1000 * n // q if runs else None,
                hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())

    got = queries.op12_periodic_runs(spark, folder)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                           "runs_sha256", "collapsed_sha256"]
    want = Counter(row(i, t) for i, t, *_ in corpus())
    assert Counter(tuple(r) for r in got.collect()) == want
    assert sum(r[1] > 0 for r in want) > 20
    planted = [i for i, *_ in corpus() if i is not None and zlib.crc32(str(i).encode()) % 10 == 0]
    assert len(planted) > 10


def test_no_documents_no_runs(spark):
    assert periodic.find_runs(documents(spark, [])).count() == 0


# --- fingerprints -----------------------------------------------------------

def points(text):
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def test_rolling_hashes_tell_grams_apart_and_windows_keep_the_rightmost_least():
    rng = random.Random(5)
    for _ in range(400):
        text = "".join(rng.choice("abé😀") for _ in range(rng.randrange(0, 60)))
        k, window = rng.randrange(1, 8), rng.randrange(1, 9)
        h = winnowing.gram_hashes(points(text), k).tolist()
        grams = [text[i:i + k] for i in range(max(len(text) - k, 0) + 1)] if text else []
        assert len(set(zip(grams, h))) == len(set(grams)) and len(h) == len(grams)
        size = min(window, len(h))
        kept = {max(j for j in range(i, i + size) if h[j] == min(h[i:i + size]))
                for i in range(len(h) - size + 1)} if h else set()
        got = winnowing.winnow(points(text), k, window)
        assert got.tolist() == [(h[j] << 32) | j for j in sorted(kept)]
        assert winnowing.from_text(winnowing.as_text(got)).tolist() == got.tolist()


def test_shared_passages_share_a_gram():
    rng = random.Random(8)
    for _ in range(200):
        draw = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
        shared = draw(winnowing.GRAM + winnowing.WINDOW - 1)
        a = winnowing.winnow(points(draw(rng.randrange(90)) + shared + draw(rng.randrange(90))))
        b = winnowing.winnow(points(draw(rng.randrange(90)) + shared + draw(rng.randrange(90))))
        assert np.intersect1d(a >> np.uint64(32), b >> np.uint64(32)).size


def brute_neighbours(rows):
    """Results from Python's own sorting; equal keys are repeats."""
    texts = {}
    for doc_id, text, *_ in rows:
        texts.setdefault((doc_id is None, doc_id or 0), Counter())[text or ""] += 1
    return texts


def check_neighbours(rows, got):
    """Texts of one id may follow each other in any order."""
    texts = brute_neighbours(rows)
    keys = sorted(texts)
    allowed = Counter()
    assert len(got) == len(rows)
    for r in got:
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        after = texts[keys[(keys.index(key) + 1) % len(keys)]]
        fits = []
        for text in texts[key]:
            own = winnowing._Text(text)
            if winnowing.as_text(own.kept) != r["fingerprint"] or len(text) != r["n_chars"]:
                continue
            cut = len(text) // 4
            for other in [*after, *(t for t in texts[key] if t != text)]:
                edited = text[:len(text) - cut] + other[:cut]
                if hashlib.sha256(edited.encode()).hexdigest() == r["edited_sha256"]:
                    kept = winnowing.winnow(points(edited))
                    fits.append((winnowing.as_text(kept), winnowing.likeness(own.kept, kept),
                                 winnowing.likeness(own.kept, winnowing._Text(other).kept)))
        assert (r["edited_fingerprint"], r["near_edited"], r["near_next"]) in fits
        allowed[key] += 1
    assert allowed == Counter({k: sum(c.values()) for k, c in texts.items()})


def test_query_compares_with_edits_and_next_documents(spark, folder):
    got = queries.op13_winnowing(spark, folder).collect()
    check_neighbours(corpus(), got)
    by_text = {}
    ids = {r["doc_id"]: r["fingerprint"] for r in got}
    for doc_id, text, *_ in corpus():
        if doc_id and doc_id >= 1000:
            assert by_text.setdefault(text, ids[doc_id]) == ids[doc_id]


@pytest.mark.parametrize("size", [1, 3, 50])
def test_ranges_and_hot_keys_change_nothing(spark, monkeypatch, size):
    monkeypatch.setattr(winnowing, "RANGE_ROWS", size)
    rng = random.Random(size)
    rows = [(rng.randrange(40), rng.choice(["a text of some words", "other words that follow it here"]),
             "x", 0.0, 0) for _ in range(60)]
    rows += [(17, "one document a third of all rows hold, again and again", "x", 0.0, 0)] * 40
    rows += [(None, "no id", "x", 0.0, 0), (None, "no id", "x", 0.0, 0), (-5, "least id", "x", 0.0, 0)]
    check_neighbours(rows, winnowing.fingerprint_neighbours(documents(spark, rows)).collect())


def test_few_documents(spark):
    assert winnowing.fingerprint_neighbours(documents(spark, [])).count() == 0
    row = winnowing.fingerprint_neighbours(documents(spark, [(1, "an only text, long enough", "x", 0.0, 0)])
                                           ).first()
    assert row["near_next"] == 1.0 and row["n_chars"] == 25
    row = winnowing.fingerprint_neighbours(documents(spark, [(None, None, None, None, None)])).first()
    assert (row["doc_id"], row["n_chars"], row["fingerprint"], row["near_edited"]) == (None, 0, "", 1.0)
