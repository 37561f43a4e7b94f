"""Line dedup, n-gram join and decontamination against plain Python."""

import hashlib
import pickle
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from varlake.llm import decontaminate, line_dedup, ngram_join
from varlake.llm.common import Words, gapless_rank, join_counted

from .helpers import documents, odd_documents, words


def test_words_match_the_pattern():
    texts = [t or "" for _, t, *_ in odd_documents()]
    blobs = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(b) for b in blobs])])
    w = Words(b"".join(blobs), at)
    found = [[w.low[w.starts[i]:w.ends[i]].decode() for i in range(a, b)]
             for a, b in zip(w.first, w.first[1:])]
    assert found == [words(t) for t in texts]
    by_hash = {}
    for word, h in zip([x for f in found for x in f], w.hashes):
        assert by_hash.setdefault(word, h) == h
    assert len(set(by_hash.values())) == len(by_hash)


def test_gapless_rank_and_counted_join_under_skew(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    ranked = gapless_rank(rows, ["k"], ["id"], "rank", 8).collect()
    by_key = {}
    for r in ranked:
        by_key.setdefault(r["k"], []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in by_key.values())
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    joined = join_counted(rows, counts, ["k"], "n", 5000)
    assert joined.count() == 5000
    assert joined.select("id").distinct().count() == 5000


def brute_lines(rows, window=3):
    """{(doc_id, text): (kept, lines, removed)}"""
    docs = sorted({(r[0], r[1]) for r in rows if r[1] is not None},
                  key=lambda d: (d[0] is not None, d[0] or 0))
    places = {}
    for doc in docs:
        lines = doc[1].split("\n")
        k = min(window, len(lines))
        for p in range(len(lines) - k + 1):
            places.setdefault((k, *lines[p:p + k]), []).append((doc, p))
    gone = {}
    for (k, *_), found in places.items():
        for doc, p in found[1:]:
            gone.setdefault(doc, set()).update(range(p, p + k))
    out = {}
    for doc in docs:
        lines = doc[1].split("\n")
        kept = [x for i, x in enumerate(lines) if i not in gone.get(doc, ())]
        out[doc] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice("abc") for _ in range(rng.randrange(0, 9))), "en", 0.0, 0)
            for i in range(150)]
    for case in (rows, [r for r in odd_documents() if r[0] != 100 or "another" not in (r[1] or "")]):
        want = brute_lines(case)
        got = line_dedup.dedup_lines(documents(spark, case)).collect()
        assert len(got) == len(case)
        for r in got:
            mine = (r["__kept_text"], r["__n_lines"], r["__n_removed"])
            assert mine == (want[r["doc_id"], r["text"]] if r["text"] is not None else (None, 0, 0))


def test_line_dedup_runs_no_python(spark):
    plan = line_dedup.dedup_lines(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_near(rows, threshold=0.8, roots=False):
    """(doc_id, class id, links) of every row; with ``roots`` its class's first row instead."""
    sets = []
    for r in rows:
        w = words(r[1])
        k = min(5, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if a and b and both >= threshold * (len(a) + len(b) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    if roots:
        return [top(i) for i in range(len(rows))]
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(top(i), []).append(r[0])
    named = {t: min((x for x in v if x is not None), default=None) for t, v in ids.items()}
    return [(r[0], named[top(i)], links[i]) for i, r in enumerate(rows)]


def near_rows(seed=5, families=12, members=14):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows = []
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 120))]
        for _ in range(rng.randrange(1, members)):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(text), "en", 0.0, 0))
    return rows


@pytest.mark.parametrize("block", [768, 4])
def test_ngram_join_matches_brute_force(spark, monkeypatch, block):
    """With blocks of 4 nodes every family is cut and its blocks meet in pairs."""
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", block)
    rows = near_rows() + [(1000 + (r[0] or 0) if r[0] is not None else None, *r[1:])
                          for r in odd_documents()]
    got = ngram_join.near_duplicates(documents(spark, rows)).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute_near(rows), key=key)


def test_overlaps_by_products_are_exact():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 9000, 700).astype(np.uint64)) for _ in range(20)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = ngram_join._overlaps(sets)
    for i in range(20):
        got[i, i] = want[i][i]  # the diagonal leaves out shingles of one text
    assert (got == want).all()


def test_pruning_table_is_the_posterior():
    """P(J >= t | m of n) under a uniform prior, by numeric integration."""
    x = np.linspace(0, 1, 200_001)
    for n in (16, 64, 128):
        least = ngram_join.least_matches(n)
        for m, reaches in ((least, True), (least - 1, False)):
            density = x**m * (1 - x) ** (n - m)
            assert (density[x >= 0.8].sum() / density.sum() >= 1e-6) == reaches


def test_components_of_a_long_chain(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 102), (102, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in ngram_join.components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {100: 100, 101: 100, 102: 100}


def test_first_of_each_class_keeps_one_row_each(spark):
    rows = near_rows(7) + [(0, near_rows(7)[0][1], "en", 0.0, 0)]
    docs = documents(spark, rows)
    got = ngram_join.first_of_each_class(docs)
    assert got.columns == docs.columns
    classes = {c for _, c, _ in brute_near(rows)}
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(classes)


def brute_contamination(rows, items, window=10):
    patterns = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - window + 1, min(1, len(w)))):
            patterns.setdefault(tuple(w[i:i + window]), set()).add(item)
    out = []
    for r in rows:
        w, hit, ids = words(r[1]), set(), set()
        for n in {len(p) for p in patterns}:
            for i in range(len(w) - n + 1):
                found = patterns.get(tuple(w[i:i + n]))
                if found:
                    hit.update(range(i, i + n))
                    ids |= found
        names = sorted(str(i) for i in ids if i is not None)
        out.append((r[0], len(w), len(hit), names))
    return out


def contamination_case(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["the", "of"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(9, 30))) for i in range(20)]
    items += [(50, "w1 w2 w3"), (51, None), (52, ""), (53, items[0][1]), (None, items[1][1]),
              (9, items[2][1]), (54, "! ?")]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(0, 40)), rng.choice(items)[1] or "", text(rng.randrange(0, 9))]
        rows.append((i, ", ".join(parts).upper() if i % 3 else " ".join(parts), "en", 0.0, 0))
    rows += [(90, " ".join(["w1 w2 w3"] * 50), "en", 0.0, 0)]
    return rows + odd_documents(), items


@pytest.mark.parametrize("setting", [{}, {"SHARD_WORDS": 40}, {"BLOCK_BYTES": 300}])
def test_decontamination_matches_brute_force(spark, monkeypatch, setting):
    """Also with shards that cut runs, and with a benchmark of many blocks."""
    for name, value in setting.items():
        monkeypatch.setattr(decontaminate, name, value)
    rows, items = contamination_case()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    marked = decontaminate.mark_contamination(
        documents(spark, rows), benchmark, block_bytes=decontaminate.BLOCK_BYTES)
    got = [(r["doc_id"], r["__n_words"], sum(s["end"] - s["begin"] for s in r["__spans"]),
            sorted(r["__items"])) for r in marked.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(brute_contamination(rows, items), key=key)


@pytest.mark.parametrize("window", [1, 2, 3, 10])
def test_windows_are_those_of_brute_force(window):
    _, items = contamination_case()
    ids = [None if i is None else str(i) for i, _ in items]
    got = decontaminate.item_windows(ids, pa.array([t for _, t in items], pa.string()), window)
    found = {}
    for which, w in enumerate(got.lengths):
        for n, start in enumerate(w.starts):
            key = tuple(got.hashes[got.words[start:start + w.size] - 2].tolist())
            assert key not in found
            found[key] = got.items_of(which, n)
    want = {}
    for i, text in zip(ids, [t for _, t in items]):
        data = (text or "").encode()
        w = Words(data, np.array([0, len(data)])).hashes.tolist()
        for a in range(max(len(w) - window + 1, min(1, len(w)))):
            want.setdefault(tuple(w[a:a + window]), set()).add(i)
    assert found == {k: sorted(x for x in v if x is not None) for k, v in want.items()}


def test_windows_of_a_whole_block_fit_a_small_driver():
    """A benchmark block of the real size: at most 30 bytes for each byte of text
    while its windows are worked out, and 6 to broadcast."""
    rng = np.random.default_rng(3)
    items = decontaminate.BLOCK_BYTES // 300
    texts = [" ".join(f"w{x}" for x in row) for row in rng.integers(0, 30_000, (items, 50))]
    tracemalloc.start()
    got = decontaminate.item_windows([str(i) for i in range(items)], pa.array(texts))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert sum(len(w.starts) for w in got.lengths) > 40 * items
    assert peak < 30 * decontaminate.BLOCK_BYTES
    assert len(pickle.dumps(got)) < 6 * decontaminate.BLOCK_BYTES


def test_decontamination_of_an_empty_benchmark(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(documents(spark), benchmark).collect()
    assert len(got) == len(odd_documents()) and not any(r["spans"] for r in got)


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (50, 2), (400, 7), (2000, 300)):
        text = rng.integers(1, top + 1, n)
        text[n // 2:] = text[:n - n // 2]  # long repeats
        index = decontaminate.FMIndex(text, top)
        for size in (1, 2, 5):
            if size > n:
                continue
            patterns = np.array([text[i:i + size] for i in rng.integers(0, n - size + 1, 20)]
                                + [rng.integers(1, top + 1, size) for _ in range(20)])
            low, high = index.search(patterns)
            for p, a, b in zip(patterns, low, high):
                want = [i for i in range(n - size + 1) if (text[i:i + size] == p).all()]
                assert sorted(index.locate(np.arange(a, b))) == want


def test_spans_are_cut_out_of_texts(spark):
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    rows = [(1, "Before, A b c d e f-g h i j k. After", "en", 0.0, 0), (2, "a b c", "en", 0.0, 0)]
    marked = decontaminate.mark_contamination(documents(spark, rows), benchmark)
    got = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(marked).collect()}
    assert got == {1: "Before,  . After", 2: "a b c"}


def test_digest_of_items_is_that_of_sorted_ids(spark, tmp_path):
    from varlake.llm.queries import op6_decontamination

    rows, items = contamination_case()
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    want = sorted((d is None, d or 0, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(),
                   h > 0) for d, n, h, i in brute_contamination(rows, items))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"],
                  r["items_sha256"], r["contaminated"])
                 for r in op6_decontamination(spark, str(tmp_path)).collect())
    assert got == want


def test_workers_pass_on_a_batch_for_each_pass(monkeypatch):
    """Texts of 100 KB in one batch: no whole batch goes on at once, nor in another order."""
    from types import SimpleNamespace

    from varlake.llm import common, toxicity

    monkeypatch.setattr(common, "PASS_BYTES", 1 << 18)
    texts = [None, "", "bad w" * 20_000, *[f"A b c d e f g h i j k {i} " * 4_000 for i in range(20)], "x"]
    spans = [[] for _ in texts]
    spans[3] = [{"begin": 0, "end": 11}]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))],
        names=["text", "__spans"])
    machine = toxicity.Machine(np.array([7]), -1.0, np.zeros(1), np.zeros((1, toxicity.FACTORS)))
    kept = {}
    context = SimpleNamespace(broadcast=lambda m: SimpleNamespace(value=m))
    docs = SimpleNamespace(
        columns=batch.schema.names, sparkSession=SimpleNamespace(sparkContext=context),
        schema=SimpleNamespace(fields=[]), mapInArrow=lambda work, schema: kept.__setitem__("work", work))
    for step in (lambda: toxicity.score_texts(docs, machine), lambda: decontaminate.remove_spans(docs)):
        step()
        out = list(kept["work"](iter([batch])))
        assert sum(b.num_rows for b in out) == len(texts)
        assert all(b.nbytes < 1 << 19 for b in out)
        got = [t for b in out for t in b["text"].to_pylist()]
        assert got[:3] == texts[:3] and got[4:] == texts[4:]
    assert got[3] == texts[3][:0] + " " + texts[3][len("A b c d e f g h i j k"):]
