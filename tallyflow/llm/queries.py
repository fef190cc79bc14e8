"""The query of each operator and of the pipeline, with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm import bpe, decontaminate, jaccard_join, language, line_dedup, lm, quality, token_alignment, token_counts, token_files, toxicity, warc, word_runs


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    """A tokenizer file of the queries."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), tokenizer())


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_check(_table(spark, sf_dir, "documents"), tokenizer())


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no host; its source stands for it."""
    return line_dedup.clean(_table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("source")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_all(_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_and_read(_table(spark, sf_dir, "pages"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.spans(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.digest(word_runs.repeats(word_runs.planted(_table(spark, sf_dir, "documents"))))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.limited(_table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.Alignment(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")).per_document()


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_jaccard_join, op2_bpe, op3_quality, op4_token_files, op5_line_dedup, op6_language, op7_toxicity, op8_language_model, op9_warc, op10_decontaminate, op11_word_runs, op12_token_counts, op13_token_alignment, pipeline)}
SQL: dict[str, str] = {"op5_line_dedup": line_dedup.SQL}
