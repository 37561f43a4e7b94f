"""The corpus pipeline: stages over ``documents``, each written as Parquet and
read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varlake.llm.common import written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, learned from their labels, doesn't reject."""
    from varlake.llm.toxicity import THRESHOLD, score_texts, train

    machine = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_texts(docs, machine, "__score").where(F.col("__score") < THRESHOLD).drop("__score")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later lines of repeated windows; those of which
    no line stays go."""
    from varlake.llm.line_dedup import dedup_lines

    out = dedup_lines(docs)
    text = F.when(F.col("__n_removed") > 0, F.col("__kept_text")).otherwise(F.col("text"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("__n_removed") > 0, F.length("__kept_text")).otherwise(
            F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return (out.where((F.col("__n_removed") == 0) | (F.col("__n_removed") < F.col("__n_lines")))
            .withColumns(new).select([F.col(f"`{c}`") for c in docs.columns]))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies."""
    from varlake.llm.ngram_join import first_of_each_class

    return first_of_each_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark windows; those of which no
    word stays go."""
    from varlake.llm.decontaminate import mark_contamination, remove_spans

    marked = mark_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    cut = remove_spans(marked.where((hit == 0) | (hit < F.col("__n_words"))))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(hit > 0, F.length("text").cast(kind)).otherwise(
            F.col("n_chars")))
    return cut.select([F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents packed into sequences."""
    from varlake.llm.packing import pack_documents
    from varlake.llm.queries import tokenizer_path

    return pack_documents(docs, tokenizer_path(), digest=True)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
