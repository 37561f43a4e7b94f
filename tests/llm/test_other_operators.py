"""URL filter, packing, sharding, scores, WARC and vector search."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from varlake.llm import ann, packing, quality, sharding, toxicity, url_filter, warc
from varlake.llm.queries import RULES, tokenizer_path

from .helpers import DOCS, crc_text, documents, labels, odd_documents


# --- URL filter -----------------------------------------------------------

def test_url_rules_terms_and_odd_urls(spark):
    cases = {
        "http://A.Example.COM/en/1": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "http://www.example.com/en/x?q": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://casino.example.com/de": ("casino.example.com", "/de", "com/", "allow"),
        "https://x.net/es/1#a": ("x.net", "/es/1", "net/es/", "block"),
        "https://x.net": ("x.net", "", None, "allow"),
        "http://x.com": ("x.com", "", None, "allow"),
        "http://notcom/": ("notcom", "/", None, "allow"),
        "http://com/": ("com", "/", "com/", "allow"),
        "http://casino.org/": ("casino.org", "/", None, "block"),
        "http://mycasino.org/": ("mycasino.org", "/", None, "allow"),
        "http://free.org/free-free": ("free.org", "/free-free", None, "allow"),
        "http://free-bets.org/": ("free-bets.org", "/", None, "block"),
        "http://x.org/freebets": ("x.org", "/freebets", None, "allow"),
        "no scheme casino": ("", "", None, "block"),
        "": ("", "", None, "allow"),
        "a://b\n://c/d": ("b\n:", "//c/d", None, "allow"),
        "HTTP://É.NET/FR/": ("É.net", "/FR/", None, "allow"),
    }
    rows = [(i, u, 0.0) for i, u in enumerate(cases)] + [(None, None, 1.0), (0, list(cases)[0], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, weight double")
    got = url_filter.judge_urls(pages, RULES).collect()
    by_id = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert len(got) == len(rows)
    assert [by_id[i] for i in range(len(cases))] == list(cases.values())
    assert by_id[None] == ("", "", None, "allow")
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0


def test_longest_rule_wins_and_blocking_breaks_ties(spark):
    pages = spark.createDataFrame([(1, "http://a.b.c/x/y")], "page_id long, url string")
    for rules, want in (
        ([("allow", "c/x/y"), ("block", "b.c/x/y")], "b.c/x/y"),
        ([("block", "c/x/"), ("allow", "c/x/")], "c/x/"),
        ([("block", "c/"), ("allow", "b.c/z")], "c/"),
    ):
        r = url_filter.judge_urls(pages, rules).first()
        assert r["rule"] == want and r["verdict"] == "block"


# --- packing --------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_pieces_are_the_tokenizers_ids(spark, tokenizer):
    rows = odd_documents() + [(200, "It's DON'T 'S x's. a.., b., É́a É İI ſ ß ẞ Ǆ ΑΣ ΣΑΣ. µª 'll. ñ́.",
                               "en", 0.0, 0)]
    packed = packing.pack_documents(documents(spark, rows), tokenizer_path()).collect()
    got = {}
    for p in packed:
        got.setdefault((p["doc_id"], p["doc_tokens"]), []).append(
            (p["start"], np.frombuffer(p["ids"], "<u4").tolist()))
    for doc_id, text, *_ in rows:
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        pieces = sorted(got[doc_id, len(want)], key=lambda p: p[0])
        copies = sum(r[:2] == (doc_id, text) for r in rows)
        if copies == 1 and doc_id is not None:
            pieces = [p for p in pieces][:len(pieces)]
            assert [i for _, ids in pieces for i in ids] == want


def test_runs_give_the_whole_texts_ids(tokenizer):
    rng = random.Random(5)
    bits = ["The", "the", "É", "é", "İ", "Σ", "ς", "ß", "don't", "'s", "'LL", ".", ",", ". ", ", ", ".,", "_.", "_",
            "12", "5.", "\n", " ", "\t", "\u0301", "<|endoftext|>", "<|ENDOFTEXT|>", "?", "!. ", "日本", "。", "x1,",
            "\u00a0", "\u2028", "\x1c", "😀", "µ", "Word, ", "a.b", "...", " ."]
    ids_of = packing._word_ids(tokenizer_path())
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 12)))
        got = np.frombuffer(b"".join(map(ids_of.__getitem__, packing._runs(text))), "<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def check_sequences(pieces, most):
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= most
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return by_sequence


def test_sequences_are_gapless_and_digests_fit(spark):
    docs = documents(spark, odd_documents() * 3)
    with_ids = packing.pack_documents(docs, tokenizer_path(), 256).collect()
    digests = packing.pack_documents(docs, tokenizer_path(), 256, digest=True).collect()
    check_sequences(with_ids, 256)
    check_sequences(digests, 256)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r["doc_id"], r["start"], zlib.crc32(r["ids"])) for r in with_ids), key=key) == (
        sorted(((r["doc_id"], r["start"], r["ids_crc32"]) for r in digests), key=key))
    assert packing.pack_documents(documents(spark, []), tokenizer_path()).count() == 0


def test_histogram_packing_equals_one_by_one():
    """Counts of patterns give the packs that placing piece by piece gives."""
    rng = random.Random(1)
    for _ in range(30):
        most = rng.choice([16, 64])
        histogram = {n: rng.randrange(1, 9) for n in rng.sample(range(1, most + 1), 8)}
        patterns = packing.pack_histogram(histogram, most)
        used = {}
        for pattern, packs in patterns:
            assert sum(a * b for a, b in pattern) <= most
            for length, times in pattern:
                used[length] = used.get(length, 0) + times * packs
        assert used == histogram
        rooms = []  # shortest pack first, one piece at a time
        for length in sorted(histogram, reverse=True):
            for _ in range(histogram[length]):
                rooms.sort()
                if rooms and rooms[-1] >= length:
                    rooms[-1] -= length
                else:
                    rooms.append(most - length)
        assert sum(n for _, n in patterns) == len(rooms)


# --- sharding -------------------------------------------------------------

def test_best_fit_equals_a_plain_search():
    rng = random.Random(2)
    for _ in range(50):
        capacity = rng.randrange(20, 100)
        sizes = sorted((rng.randrange(1, 20) for _ in range(60)), reverse=True)
        rooms, want = [], []
        for s in sizes:
            fits = [(r, i) for i, r in enumerate(rooms) if r >= s]
            i = min(fits)[1] if fits else len(rooms)
            if not fits:
                rooms.append(capacity)
            rooms[i] -= s
            want.append(i)
        assert sharding.best_fit(sizes, capacity) == want


def test_pack_into_is_even_beside_a_large_group():
    where = sharding.pack_into([1000, *[3] * 200, *[1] * 200], 5)
    sizes = [0] * 5
    for w, s in zip(where, [1000, *[3] * 200, *[1] * 200]):
        sizes[w] += s
    assert sorted(sizes) == [200, 200, 200, 200, 1000]
    assert sharding.pack_into([], 5) == []


def test_sharding_keeps_groups_whole_and_sizes_near(spark):
    rng = random.Random(6)
    rows = [(i, "x" * rng.randrange(0, 2000) + str(i % 900), "en", 0.0, 0) for i in range(1500)]
    rows += [(5000 + i, "a copied text " * 10, "en", 0.0, 0) for i in range(400)] + odd_documents()
    got = sharding.shard_by_size(documents(spark, rows), 8).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want = [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows]
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=key) == sorted(
        want, key=key)
    groups, sizes, slots = {}, [0] * 8, {}
    for r in got:
        groups.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(len(s) == 1 for s in groups.values())
    rest = sorted(sizes)[:-1]  # one shard has the very long texts
    assert max(rest) - min(rest) < 0.02 * max(rest)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_by_size(documents(spark, []), 8).count() == 0


def plain_best_fit(sizes, capacity):
    """Bins by trying every one for every size."""
    rooms, where = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(rooms) if r >= s]
        i = min(fits)[1] if fits else len(rooms)
        if not fits:
            rooms.append(capacity)
        rooms[i] -= s
        where.append(i)
    return where


def test_sharding_of_a_table_is_best_fit_decreasing(spark):
    """The query's placement against a plain search, on groups of which each is
    over a 250th of a shard: copies, two scripts, no two groups of one size."""
    rng = random.Random(11)
    rows, groups = [], {}
    for i, n in enumerate(rng.sample(range(900, 3000), 120)):
        text = ("é" if i % 3 else "e") * n
        copies = rng.randrange(1, 4)
        size = copies * (len(text.encode()) + 16)
        if size in groups:
            continue
        groups[size] = text
        rows += [(10 * i + c, text, "en", 0.0, 0) for c in range(copies)]
    shards = 5
    assert min(groups) > sum(groups) // (shards * sharding.LARGE)
    got = {}
    for r in sharding.shard_by_size(documents(spark, rows), shards).collect():
        got.setdefault(r["text_crc32"], set()).add(r["shard"])
    order = sorted(groups, reverse=True)
    where = [got[zlib.crc32(groups[s].encode())] for s in order]
    assert all(len(w) == 1 for w in where)
    where = [next(iter(w)) for w in where]
    held = [sum(s for s, w in zip(order, where) if w == b) for b in range(shards)]
    low = -(-sum(order) // shards)
    # At the least capacity that the plain search finds enough, or next to it:
    # whether a capacity is enough need not grow with it, and halving may miss one.
    enough = [c for c in range(max(held), max(held) + 500) if plain_best_fit(order, c) == where]
    least = next(c for c in range(low, 2 * low) if max(plain_best_fit(order, c)) < shards)
    assert enough and enough[0] <= least * 1.01


# --- toxicity and quality -------------------------------------------------

def test_machine_learns_interactions_that_sums_miss():
    """Either term alone is harmless, together they are not."""
    rng = np.random.default_rng(0)
    texts, y = [], []
    for _ in range(4000):
        a, b = rng.random(2) < 0.5
        noise = rng.choice(np.arange(2, 12), 3, replace=False)
        texts.append(np.array(sorted([*([0] if a else []), *([1] if b else []), *noise])))
        y.append(float(a and b))
    machine = toxicity.fit_machine(np.arange(12), np.array(y), texts)
    score = lambda t: float(machine.logits(np.zeros(len(t), int), np.array(t, int), 1)[0])
    assert score([0, 1]) > 1 and score([0]) < -1 and score([1]) < -1
    assert score([0, 1]) - score([0]) - score([1]) + score([]) > 2


def toxic_case(n=1500):
    rng = random.Random(8)
    common = [f"word{i}" for i in range(200)]
    rows, marks = [], []
    for i in range(n):
        text = [rng.choice(common) for _ in range(rng.randrange(20, 200))]
        toxic = i % 8 == 0
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["idiot", "scum", "moronic", "moronish"])
        good = i % 5 != 0
        if not good:
            text = [w + "|" for w in text]
        rows.append((i, " ".join(text), "en", 0.0, 0))
        if i % 3:
            marks.append((i, int(good), int(toxic), "x"))
    return rows, marks


@pytest.mark.parametrize("which, modulus, rest", [("toxicity", 4, 2), ("quality", 3, 1)])
def test_scores_hold_out_and_generalise(spark, which, modulus, rest):
    rows, marks = toxic_case()
    work = toxicity.toxicity if which == "toxicity" else quality.quality
    got = work(documents(spark, rows + odd_documents()),
               labels(spark, [*marks, (None, 1, 1, "x"), (7, None, None, "x"), (3, 1, 0, "x"), (3, 1, 0, "x")])
               ).collect()
    assert len(got) == len(rows) + len(odd_documents())
    right = total = 0
    for r in got:
        assert 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= (0.3 if which == "toxicity" else 0.5))
        if r["doc_id"] is None:
            assert not r["held_out"]
            continue
        assert r["held_out"] == (crc_text(r["doc_id"]) % modulus == rest)
        if r["held_out"] and 200 < r["doc_id"] < 1500:
            total += 1
            right += r["predicted"] == int(
                r["doc_id"] % 8 == 0 if which == "toxicity" else r["doc_id"] % 5 != 0)
    assert total > 100 and right >= 0.97 * total


def test_quality_learns_from_every_label_and_pair(spark):
    """The loss is that of all pairs (against a brute-force sum), and no label is left out."""
    rng = np.random.default_rng(5)
    x = rng.random((300, len(quality.MEASURES)))
    y = (x[:, 0] + 0.3 * rng.random(300) > 0.6).astype(int)
    rows = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y)],
                                 "measures array<double>, y int").repartition(5).cache()
    good, bad = int(y.sum()), int((1 - y).sum())
    ranking = quality.fit_ranking(rows, good, bad)
    features = quality._binned(x, ranking.edges)
    scores = features @ ranking.weights
    wrong = 1 / (1 + np.exp(scores[y == 1][:, None] - scores[y == 0][None]))
    gradient = quality.DECAY * ranking.weights - (
        wrong.sum(axis=1) @ features[y == 1] - wrong.sum(axis=0) @ features[y == 0]) / (good * bad)
    assert np.abs(gradient).max() < 2e-3  # at the least loss of all pairs
    assert np.isclose(ranking.threshold, np.quantile(scores, bad / 300))
    table = quality._sums(rows, ranking.edges, ranking.weights, -50.0, 50.0)
    assert table[0, :, 0].sum() == bad and table[1, :, 0].sum() == good
    assert np.allclose(table[1, :, 2:].sum(axis=0), features[y == 1].sum(axis=0))
    assert not hasattr(quality, "MAX_TRAINING_ROWS")
    told = quality.training_labels(labels(spark, [(i, i % 2, 0, "x") for i in range(999)]), "quality", 3, 1, None)
    assert told.count() == sum(crc_text(i) % 3 != 1 for i in range(999))


def test_terms_harmless_alone_are_learned_in_pairs(spark):
    """An insult and a group that are each mostly clean alone are toxic
    together; a word of context makes a plain insult harmless."""
    rng = random.Random(9)
    common = [f"word{i}" for i in range(200)]
    kinds = [(["weasel", "martians"], 1), (["scum"], 1), (["scum"], 1), (["scum"], 1),
             (["scum", "pond"], 0), *[(["weasel"], 0)] * 8, *[(["martians"], 0)] * 7]
    rows, marks = [], []
    for i in range(4000):
        words, toxic = kinds[i % len(kinds)]
        text = [rng.choice(common) for _ in range(rng.randrange(20, 100))] + words
        rng.shuffle(text)
        rows.append((i, " ".join(text), "en", 0.0, 0))
        marks.append((i, 1, toxic, "x"))
    got = toxicity.toxicity(documents(spark, rows), labels(spark, marks)).where("held_out").collect()
    for words in (["weasel", "martians"], ["scum"], ["scum", "pond"], ["weasel"], ["martians"]):
        some = [r["predicted"] for r in got if kinds[r["doc_id"] % len(kinds)][0] == words]
        wrong = sum(p != dict((tuple(w), y) for w, y in kinds)[tuple(words)] for p in some)
        assert len(some) > 30 and wrong <= 0.05 * len(some), (words, wrong, len(some))


def test_texts_that_share_a_passage_are_all_learned_from(spark, monkeypatch):
    """Only near copies of one label are copies; which is kept doesn't hang on the order."""
    passage = [f"line{i}" for i in range(40)]
    texts = [" ".join([*passage, *(f"own{i}x{j}" for j in range(80))]) for i in range(20)]
    rows = [(i, t + w, "en", 0.0, 0) for i, (t, w) in enumerate(
        [*((t, "") for t in texts), (texts[0], " scum"), (texts[1], ""), (texts[2].upper(), "")])]
    marks = [(i, 1, int(i == 20), "x") for i in range(len(rows))]
    seen, work = [], toxicity._term_counts
    monkeypatch.setattr(toxicity, "_term_counts", lambda rows, *a: seen.append(
        sorted((r["y"], r["terms"]) for r in rows.collect())) or work(rows, *a))
    for n in (1, 5):
        toxicity.train(documents(spark, rows).repartition(n), labels(spark, marks), rest=-1)
    assert seen[0] == seen[-1] and sum(y for y, _ in seen[0]) == 1
    # All but the two copies, though most share their least shingle.
    assert len(seen[0]) >= 19


def test_scores_do_not_see_held_out_labels(spark):
    rows, marks = toxic_case(400)
    turned = [(i, 1 - q, 1 - t, x) if crc_text(i) % 4 == 2 else (i, q, t, x) for i, q, t, x in marks]
    key = lambda r: (r["doc_id"], r["score"])
    a, b = (sorted(map(key, toxicity.toxicity(documents(spark, rows), labels(spark, m)).collect()))
            for m in (marks, turned))
    assert a == b


def test_scores_without_labels(spark):
    none = labels(spark)
    assert {r["score"] for r in toxicity.toxicity(documents(spark), none).collect()} == {0.0}
    assert {r["score"] for r in quality.quality(documents(spark), none).collect()} == {0.5}
    one_kind = labels(spark, [(i, 1, 0, "x") for i in range(15)])
    assert {r["score"] for r in quality.quality(documents(spark), one_kind).collect()} == {1.0}
    assert max(r["score"] for r in toxicity.toxicity(documents(spark), one_kind).collect()) < 0.3
    assert toxicity.toxicity(documents(spark, []), one_kind).count() == 0
    assert quality.quality(documents(spark, []), one_kind).count() == 0


# --- WARC -----------------------------------------------------------------

def test_merge_runs_is_a_sorted_merge():
    rng = random.Random(3)
    for k in range(10):
        runs = [sorted(rng.randrange(30) for _ in range(rng.randrange(12))) for _ in range(k)]
        got = list(warc.merge_runs([[((x,), x) for x in r] for r in runs]))
        assert got == sorted(x for r in runs for x in r)


def test_archives_round_trip(spark, tmp_path):
    htmls = ["<p>é</p>", "", None, "x" * 200_000, "a\r\n\r\nb\r\n", "dup", "dup", "dup"]
    rows = [(i, f"http://h{i % 3}.Example.com/p{i}?q#f", h, i) for i, h in enumerate(htmls)]
    rows += [(None, None, "dup", 1), (3, "http://again/", "x" * 200_000, 2), (None, "u v\r\nw", "alone", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, length int")
    folder = f"{tmp_path}/archives"
    got = warc.archive_pages(pages.repartition(3), folder).collect()
    assert len(got) == len(rows)
    smallest = {}
    for page, _, html, _ in rows:
        if page is not None:
            smallest[html or ""] = min(page, smallest.get(html or "", page))
    want = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        first = smallest.get(html or "")
        revisit = first is not None and page != first
        want.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     "revisit" if revisit else "response", first if revisit else None))
    mine = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
            for r in got]
    key = lambda r: tuple((x is None, x or 0) for x in (r[0], r[1], r[4]))
    assert sorted(mine, key=key) == sorted(want, key=key)
    order = [(r["urlkey"], r["timestamp"], r["page_id"] is None, r["page_id"] or 0) for r in got]
    assert order == sorted(order)
    assert [r["urlkey"] for r in got if r["page_id"] == 4] == ["com,example,h1)/p4?q"]
    for r in got[:4]:  # a capture's place leads to its record
        with open(f"{folder}/{r['archive']}", "rb") as f:
            f.seek(r["at"])
            record = warc.parse_record(zlib.decompress(f.read(r["length"]), wbits=31))
        assert record["page_id"] == r["page_id"]


def test_archives_of_small_payloads_and_none(spark):
    pages = spark.createDataFrame([(2, "u", "ab"), (1, "u", "ab"), (4, "u", "long one"),
                                   (3, "u", "long one")], "page_id long, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in warc.archive_pages(pages, least_bytes=5).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_a_damaged_record_is_an_error():
    whole = zlib.decompress(warc._record(1, "u", b"payload", base64.b32encode(
        hashlib.sha1(b"payload").digest()).decode(), None), wbits=31)
    assert warc.parse_record(whole)["payload_bytes"] == 7
    with pytest.raises(ValueError):
        warc.parse_record(whole.replace(b"payload", b"pAyload"))
    with pytest.raises(ValueError):
        warc.parse_record(whole[:-1])


# --- vector search --------------------------------------------------------

def vector_rows(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, 24))
    x = centres[rng.integers(0, 10, n)] + 0.7 * rng.normal(size=(n, 24))
    x[:n // 3] = centres[0] + 0.001 * rng.normal(size=(n // 3, 24))  # a crowd
    x[n // 3:n // 3 + 100] = x[n // 3]  # copies
    return x * rng.uniform(0.5, 2, (n, 1))


def brute_nearest(ids, x, query, k=20):
    scores = x @ x[query]
    mine = ids == ids[query]
    order = [i for i in np.lexsort((ids, -np.round(scores, 9))) if not mine[i]][:k]
    return [int(ids[i]) for i in order], scores[order]


def test_search_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 700)
    monkeypatch.setattr(ann, "CHUNK_ROWS", 60)
    x = vector_rows()
    ids = np.arange(len(x)) * 2 + 1
    frame = spark.createDataFrame([(int(i), v.tolist(), 0, 0.0) for i, v in zip(ids, x)],
                                  "vec_id long, embedding array<double>, label int, score double")
    got = {}
    for r in ann.search(frame, F.col("vec_id") % 20 == 1).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == [int(i) for i in ids if i % 20 == 1]
    found = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21))
        want, _ = brute_nearest(ids, x, int(np.flatnonzero(ids == q)[0]))
        found += len({r[1] for r in rows} & set(want))
        at = {int(i): n for n, i in enumerate(ids)}
        for _, v, s in rows:
            assert abs(s - x[at[v]] @ x[at[q]]) < 1e-9
        assert [r[1:] for r in rows] == sorted((r[1:] for r in rows), key=lambda r: (-r[1], r[0]))
    assert found >= 0.95 * 20 * len(got)


def norms_of(kind, n):
    """One vector of 3, 3.5 or 1e6 times the norm of all others, or lognormal norms."""
    if kind == "lognormal":
        return np.random.default_rng(5).lognormal(0, 1, n)
    return np.where(np.arange(n) == 7, kind, 1.0)


@pytest.mark.parametrize("kind", [3.0, 3.5, 1e6, "lognormal"])
def test_search_finds_all_whatever_the_norms(spark, kind):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2000, 64))
    x *= (norms_of(kind, len(x)) / np.linalg.norm(x, axis=1))[:, None]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                                  "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(frame, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert sorted(got) == list(range(0, 2000, 20))
    for q, found in got.items():
        assert [found[n] for n in range(1, 21)] == brute_nearest(np.arange(2000), x, q)[0]


def test_one_long_vector_leaves_as_many_pivots(spark):
    x = np.random.default_rng(6).normal(size=(600, 64))
    x *= (norms_of(3.5, len(x)) / np.linalg.norm(x, axis=1))[:, None]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.repeat(x, 2, axis=0))],
                                  "vec_id long, v array<double>")
    pivots = ann.choose_pivots(frame, 3.5)
    assert len(pivots) == ann.PIVOTS == len(np.unique(pivots, axis=0))
    assert len(ann.choose_pivots(frame.where("vec_id < 40"), 3.5)) == 20


def test_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]),
            (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (8, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, ann.search(frame, F.col("vec_id") % 20 == 0).collect()))
    assert got == [(0, 1, 20, 1.0), (0, 2, 1, 0.5), (20, 1, 0, 1.0), (20, 2, 1, 0.5)]
    assert ann.search(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(frame.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("posted", [8, 128])
def test_footrule_reads_only_posted_places(monkeypatch, posted):
    monkeypatch.setattr(ann, "POSTED", posted)
    x = vector_rows(500)
    norm = float(np.linalg.norm(x, axis=1).max())
    pivots = ann.lifted(x[400:440], norm) / norm
    index = ann.BlockIndex(np.arange(500), x, pivots, norm)
    assert len(index.posted) == 500 * min(posted, 40)
    places = ann.query_places(x[:1], pivots)[0]
    assert sorted(places) == list(range(40))
    of_rows = ann._places(ann.lifted(x, norm), pivots)
    want = [sum(abs(min(int(of_rows[v][p]), index.behind) - int(places[p])) for p in range(40)
                if places[p] < ann.READ) for v in range(500)]
    assert index.footrules(places).tolist() == want


def test_the_share_alone_finds_most_neighbours():
    x = np.random.default_rng(4).normal(size=(3000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    pivots = ann.farthest_first(ann.lifted(x[:2048], 1.0), ann.PIVOTS)
    index = ann.BlockIndex(np.arange(3000), x, pivots, 1.0)
    hits = 0
    for q in range(0, 1000, 20):
        found, _ = index.nearest(q, x[q], ann.query_places(x[q:q + 1], pivots)[0], 20, exact=False)
        hits += len(set(found.tolist()) & set(brute_nearest(np.arange(3000), x, q)[0]))
    assert hits / (50 * 20) >= 0.95


def test_documents_schema_is_that_of_the_helpers(spark):
    assert documents(spark).columns == [c.split()[0] for c in DOCS.split(", ")]
