"""Token statistics of a text column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, CountVectorizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rtml.plans.prefix import CHUNK, quantile_bounds, running_totals, with_chunk
from rtml.session import spread

# A word is two or more letters, digits or underscores, in any script.
WORD = r"[\p{L}\p{N}_]{2,}"


def words(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def space_tokens(c: str | Column) -> Column:
    """Lower-cased pieces between white space."""
    c = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.lower(c), r"\s+"), lambda t: t != "")


def default_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def token_frequency(df: DataFrame, doc: str, text: str, stop_words: list[str] | None = None,
                    min_docs: int = 2, top: int | None = 50) -> DataFrame:
    """Occurrences and document counts per word, most frequent first.

    Each document gives its words and its distinct words; both are summed per word in one
    aggregation, so only vocabulary-sized partial counts are shuffled, never documents.
    """
    stop = default_stop_words() if stop_words is None else stop_words
    lists = spread(df.select(text)).where(F.trim(F.coalesce(F.col(text), F.lit(""))) != "") \
        .select(words(text).alias("_w"))
    parts = lists.select(F.explode(F.array(
        F.struct(F.col("_w").alias("w"), F.lit(1).alias("n"), F.lit(0).alias("d")),
        F.struct(F.array_distinct("_w").alias("w"), F.lit(0).alias("n"), F.lit(1).alias("d"))))
        .alias("p"))
    tokens = parts.select(F.explode("p.w").alias("token"), "p.n", "p.d")
    if stop:
        tokens = tokens.where(~F.col("token").isin(stop))
    counts = tokens.groupBy("token").agg(F.sum("n").alias("n"), F.sum("d").alias("docs")) \
        .where(F.col("docs") >= min_docs)
    return counts.orderBy(F.col("n").desc(), "token").limit(top) if top else counts


def tfidf(df: DataFrame, text: str, max_features: int = 100, min_docs: int = 2,
          stop_words: list[str] | None = None, out: str = "tfidf"):
    """Fitted pipeline: bounded vocabulary, term counts, inverse document frequency."""
    tokens = spread(df).withColumn("_words", words(text))
    remover = StopWordsRemover(inputCol="_words", outputCol="_kept")
    if stop_words is not None:
        remover = remover.setStopWords(stop_words)
    model = Pipeline(stages=[
        remover, CountVectorizer(inputCol="_kept", outputCol="_tf", vocabSize=max_features,
                                 minDF=float(min_docs)),
        IDF(inputCol="_tf", outputCol=out)]).fit(tokens)
    return model, model.transform(tokens).drop("_words", "_kept", "_tf")


def _place(doc: str) -> Column:
    """Order of a token in the corpus: document, then position."""
    return F.struct(doc, "pos")


def target_words(df: DataFrame, doc: str, text: str, among: int = 50, min_length: int = 3,
                 min_count: int = 3, limit: int = 10) -> DataFrame:
    """Up to ``limit`` long, frequent tokens among the most frequent ones, in rank order.

    Equal counts rank by first appearance.
    """
    placed = spread(df.select(doc, text)) \
        .select(doc, F.posexplode(space_tokens(text)).alias("pos", "token"))
    counts = placed.groupBy("token").agg(F.count(F.lit(1)).alias("n"),
                                         F.min(_place(doc)).alias("_first"))
    top = counts.orderBy(F.col("n").desc(), "_first").limit(among)
    return top.where((F.length("token") >= min_length) & (F.col("n") >= min_count)) \
        .orderBy(F.col("n").desc(), "_first").limit(limit).select("token", "n")


def word_dispersion(df: DataFrame, doc: str, text: str, targets: list[str]) -> DataFrame:
    """Corpus-wide 0-based token offset of every occurrence of the target words.

    Offsets come from running totals of per-document token counts; only documents, never their
    tokens, are ordered.
    """
    tokens = spread(df.select(doc, text)).select(doc, space_tokens(text).alias("_tokens"))
    sized = tokens.select(doc, F.size("_tokens").cast("long").alias("_len"),
                          F.expr("transform(_tokens, (t, i) -> struct(t as token, i as pos))")
                          .alias("_all"))
    hits = sized.select(doc, "_len", F.filter(
        "_all", lambda p: p["token"].isin(targets)).alias("_hits"))
    bounds = quantile_bounds(df, doc)
    run = running_totals(with_chunk(hits, doc, bounds), [], [doc],
                         {"_upto": F.col("_len")}).drop(CHUNK)
    return run.select(doc, "_upto", "_len", F.explode("_hits").alias("h")).select(
        F.col("h.token").alias("token"), doc,
        (F.col("_upto") - F.col("_len") + F.col("h.pos")).alias("offset"))


def word_correlation(df: DataFrame, text: str, targets: list[str]) -> DataFrame:
    """Correlation of the presence of each pair of words over the documents, in one pass."""
    tokens = spread(df.select(text)).select(F.array_distinct(space_tokens(text)).alias("_t"))
    flags = tokens.select(*[F.array_contains("_t", w).cast("double").alias(f"w{i}")
                            for i, w in enumerate(targets)])
    pairs = [(i, j) for i in range(len(targets)) for j in range(i + 1, len(targets))]
    one = flags.agg(*[F.corr(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(targets[i]).alias("word_a"), F.lit(targets[j]).alias("word_b"),
                 F.col(f"c{i}_{j}").alias("correlation")) for i, j in pairs])).alias("p")) \
        .select("p.*")


def svd_embedding(df: DataFrame, vec: str, k: int = 50, keep: list[str] | None = None) -> DataFrame:
    """Rows projected on the k leading right singular vectors of the term matrix.

    One pass builds the Gramian, whose size is vocabulary x vocabulary and so bounded by
    max_features; its eigenvectors are the singular vectors.
    """
    rows = MLUtils.convertVectorColumnsFromML(df.select(vec), vec)
    gram = RowMatrix(rows).computeGramianMatrix().toArray()
    values, vectors = np.linalg.eigh(gram)
    top = vectors[:, np.argsort(values)[::-1][:k]]
    # fix the sign of each direction so that repeated runs agree
    basis = top * np.sign(top[np.abs(top).argmax(axis=0), np.arange(top.shape[1])])

    @F.pandas_udf("array<double>")
    def to_basis(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for v in parts:
            yield pd.Series(list(np.stack(v.to_numpy()).astype(float) @ basis) if len(v) else [],
                            dtype=object)

    return df.select(*(keep or []), to_basis(vector_to_array(vec)).alias("embedding"))
