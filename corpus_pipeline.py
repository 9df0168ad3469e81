"""Training-data pipeline: filter, deduplicate, decontaminate, mix, and write token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rtml.llm import decontaminate, jaccard, mixing, quality, tokenfiles
from rtml.llm.common import row_key, without_rows
from rtml.llm.queries import tokenizer_file
from rtml.session import scratch_path

#: Sources are read at most so many times as often as one another.
MAX_REPETITION = 1.5


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group linked by 5-word shingles at 0.8 or more."""
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten consecutive words with a benchmark item."""
    found = decontaminate.find_benchmark_spans(docs, _table(spark, sf_dir, "benchmark"),
                                               carry=row_key("doc_id", "text"))
    bad = found.where("size(spans) > 0").select("_k1", "_k2")
    return without_rows(docs, bad, "doc_id", "text")


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; documents of small sources again, up to the repetition limit."""
    return mixing.mix(docs, mixing.mixture(docs, max_repetition=MAX_REPETITION))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files, read back: id, start, tokens and checksum per document."""
    path = tokenfiles.write_token_files(docs, scratch_path(spark, "tokens"),
                                        tokenizer_file("word_bpe_49k.json"))
    return tokenfiles.read_documents(spark, path)


STAGES = [("quality classifier", quality_classifier), ("n-gram Jaccard join", ngram_jaccard_join),
          ("benchmark decontamination", benchmark_decontamination),
          ("mixing sources to target weights", mixing_sources),
          ("token-ID / binary output", token_files)]

#: A fitted classifier and a tokenizer are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back for the next stage."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
