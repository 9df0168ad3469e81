"""Registered queries of the operators over the provided tables, and their SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rtml.llm import chat, collocations, decontaminate, jaccard, langid, langmodel, mixing, quality, \
    secrets, tokencount, tokenfiles, variants, vectors
from rtml.llm.oracles import LLM_ORACLES  # noqa: F401
from rtml.session import scratch_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Greedy word pieces of every document under the 32k piece vocabulary."""
    pieces = tokencount.sentencepiece_vocabulary(tokenizer_file("piece_bpe_32k.model"))
    return tokencount.count_tokens(_table(spark, folder, "documents"), pieces)


def op2_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.vector_links(_table(spark, folder, "embeddings"))


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Evidence, site posteriors and decision of every document."""
    scored = quality.score_quality(_table(spark, folder, "documents"),
                                   _table(spark, folder, "labels"))
    return scored.drop("_k1", "_k2")


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return langmodel.score_texts(_table(spark, folder, "documents"))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, folder, "documents"))


def op6_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    return chat.conversation_digests(chat.format_conversations(turns.union(extra)))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Copies of each document when sources are read at most 1.5 times as often as one another."""
    docs = _table(spark, folder, "documents")
    plan = mixing.mixture(docs, max_repetition=1.5)
    return mixing.mixed_ids(docs, plan)


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(decontaminate.find_benchmark_spans(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")))


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = tokenfiles.write_token_files(_table(spark, folder, "documents"),
                                        scratch_path(spark, "tokens"),
                                        tokenizer_file("word_bpe_49k.json"))
    return tokenfiles.read_documents(spark, path)


def op10_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_versions(_table(spark, folder, "documents"),
                                  scratch_path(spark, "ledger"))
    return secrets.finding_digests(found)


def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from three of four by the CRC-32 of their ids."""
    docs = _table(spark, folder, "documents")
    lot = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4
    field = langid.train_field(docs, lot != 2)
    return langid.identify(docs, field).select("doc_id", (lot == 2).alias("held_out"),
                                               "lang_pred", "score")


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Forms and roots of all words; one of 199 pairs of document and word has lost a letter."""
    return variants.spelling_variants(_table(spark, folder, "documents"), slip=199)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, folder)


LLM_QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_embedding_near_dedup, op3_quality_classifier, op4_lm_scoring,
    op5_jaccard_join, op6_chat_formatting, op7_mixing, op8_decontamination, op9_token_files,
    op10_secret_scans, op11_language_id, op12_spelling_variants, op13_collocations, pipeline)}
