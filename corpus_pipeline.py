"""From raw documents to clean token counts: the stages, and the run over all of them.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns the columns of
``documents`` (the last adds its own). ``n_chars`` follows the text. SQL cannot express a factorization
machine, so ``ORACLE_SQL`` is None; tests compare each stage's output with plain Python on the test table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm import bpe, decontaminate, jaccard_join, line_dedup, toxicity
from tallyflow.llm.queries import tokenizer
from tallyflow.sinks.scratch import stored

ORACLE_SQL = None


def _sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with ``n_chars`` of the text as it now is."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels.where(~toxicity.held_out("doc_id", 5, 0)))
    return toxicity.scored(docs, model, score="__score").where("__score < 0.5").select(docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many pages of their source share."""
    return _sized(line_dedup.clean(docs), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the lowest id, of each group of exact and near copies.

    Rows of one id are one document, which stays or goes as a whole; a null id stays.
    """
    gone = stored(jaccard_join.similar(docs).where("id <> class_id").select(F.col("id").alias("__id")).distinct(), "copies")
    few = gone.count() <= jaccard_join.FEW
    return docs.join(F.broadcast(gone) if few else gone, docs["doc_id"] == gone["__id"], "left_anti").select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of the benchmark."""
    return _sized(decontaminate.remove_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the number and digest of their token ids, and the digest of the text decoded from them."""
    return bpe.round_trip(docs, tokenizer(), keep=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
