"""The corpus pipeline: each stage against plain Python on its own input, and
the registered queries on odd tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from varlake.llm import queries
from varlake.llm.common import written

from .helpers import documents, labels, odd_documents
from .test_other_operators import check_sequences
from .test_text_operators import brute_contamination, brute_lines, brute_near, words

INSULTS = ["idiot", "scum", "moronic", "moronish"]


def corpus(seed=11):
    """Documents with near copies, copies, shared lines, benchmark passages
    and toxic texts; their labels; benchmark items."""
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(900)]
    line = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(6, 14)))
    boiler = [line() for _ in range(4)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(25))) for i in range(8)]
    rows, marks = [], []
    for i in range(600):
        lines = [line() for _ in range(rng.randrange(3, 9))]
        if i % 9 == 0:
            lines += boiler
        if i % 11 == 0:
            lines[1] = items[i % 8][1]
        toxic = i % 7 == 0
        if toxic:
            lines[0] += " " + rng.choice(INSULTS)
        text = "\n".join(lines)
        rows.append((i, text, "en", 0.5, 1))
        if i % 13 == 0:
            rows.append((1000 + i, text, "en", None, None))
        if i % 10 == 0:
            changed = [x.split(" ") for x in lines]
            changed[len(lines) // 2][0] = "other"
            rows.append((2000 + i, "\n".join(" ".join(x) for x in changed), "de", 0.5, 2))
        if i % 8:
            marks.append((i, 1, int(toxic), "x"))
    return rows + odd_documents(), marks, items


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, marks, items = corpus()
    folder = str(tmp_path_factory.mktemp("corpus"))
    documents(spark, rows).withColumn("n_chars", F.length("text").cast("long")).write.parquet(
        f"{folder}/documents.parquet")
    labels(spark, marks).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return folder


def test_each_stage_on_its_own_input(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    _, _, items = corpus()
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_join", "decontamination", "packing"]
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = written(stage(spark, docs, tables))
        got = docs.collect()
        if name == "packing":
            check_sequences(got, 4096)
            assert sum(r["start"] == 0 for r in got) == len(before)
            assert sum(r["length"] for r in got) == sum(
                r["doc_tokens"] for r in got if r["start"] == 0)
            continue
        assert docs.columns == columns
        after = [(r["doc_id"], r["text"]) for r in got]
        assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)
        if name == "toxicity":
            assert not any(set(words(t)) & set(INSULTS) for _, t in after)
            clean = [x for x in before if not set(words(x[1])) & set(INSULTS)]
            assert sorted(after, key=key) == sorted(clean, key=key)
        elif name == "line_dedup":
            kept = brute_lines(before)
            want = [(i, t if t is None else kept[i, t][0]) for i, t in before
                    if t is None or kept[i, t][2] < kept[i, t][1]]
            assert sorted(after, key=key) == sorted(want, key=key)
        elif name == "ngram_join":
            classes = brute_near(before, roots=True)
            alone = [x for x in before if not words(x[1])]
            assert len([1 for x in after if words(x[1])]) == len(
                {c for x, c in zip(before, classes) if words(x[1])})
            assert {x for x in alone} <= set(after)
        else:
            marks = brute_contamination(before, items)
            hit = {i for i, n, h, _ in marks if h}
            clean = sorted((x for x in before if x[0] not in hit), key=key)
            assert sorted((x for x in after if x[0] not in hit), key=key) == clean and hit
            assert not any(h for _, _, h, _ in brute_contamination(after, items))


def test_run_equals_its_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, tables))
    columns = ["doc_id", "start", "length", "doc_tokens", "ids_crc32"]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    rows = lambda df: sorted((tuple(r) for r in df.select(columns).collect()), key=key)
    assert rows(corpus_pipeline.run(spark, tables)) == rows(docs)


def test_pipeline_on_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["op2_packing", "op3_toxicity", "op4_ngram_join", "op5_sharding",
                                  "op6_decontamination", "op7_quality", "op9_line_dedup"])
@pytest.mark.parametrize("rows", ["odd", "empty", "null"])
def test_document_queries_on_odd_tables(spark, tmp_path, name, rows):
    data = {"odd": odd_documents(), "empty": [], "null": [(None, None, None, None, None)] * 3}[rows]
    documents(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, [(i, i % 2, (i + 1) % 2, None) for i in range(12)]).write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one"), (None, None)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    got = queries.queries()[name](spark, str(tmp_path)).collect()
    if name == "op2_packing":
        assert len({(r["doc_id"], r["doc_tokens"]) for r in got}) <= len(data)
        check_sequences(got, 4096)
        assert sum(r["start"] == 0 for r in got) == len(data)
    else:
        assert len(got) == len(data)


def test_query_columns(spark, tables):
    want = {
        "op2_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint",
                        "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint",
                        "offset": "bigint"},
        "op3_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double",
                         "predicted": "int"},
        "op5_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint",
                         "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
        "op6_decontamination": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint",
                                "n_items": "bigint", "items_sha256": "string",
                                "contaminated": "boolean"},
        "op7_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double",
                        "predicted": "int"},
    }
    for name, columns in want.items():
        got = dict(queries.queries()[name](spark, tables).dtypes)
        assert {c: got.get(c) for c in columns} == columns, name


