"""Quality classifier: document evidence combined with host and path posteriors."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rtml.llm.common import broadcast_checked, giving_back, prepare, row_key, stored, without_rows

#: Labelled rows that the document classifier is fitted on at most, taken in order of an id hash.
FIT_ROWS = 20_000
_MARKS = b".,;:!?'\"()-[]{}<>/\\|@#$%^&*_=+~`"
_GROUPS = {"upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789",
           "blank": b" \t", "line": b"\n", "wide": bytes(range(128, 256))}
N_FEATURES = len(_GROUPS) + len(_MARKS) + 6
_TABLE = np.zeros((256, len(_GROUPS) + len(_MARKS)))
for _i, _chars in enumerate([*_GROUPS.values(), *[bytes([c]) for c in _MARKS]]):
    _TABLE[list(_chars), _i] = 1.0


def features(text: bytes | None) -> np.ndarray:
    """Shares of kinds of bytes, and shape of words and lines, of one whole text."""
    text = text or b""
    n = len(text) + 1.0
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _TABLE / n
    words, lines = text.split(), text.split(b"\n")
    w = len(words)
    more = [math.log1p(w) / 10, min(n / (w + 1), 40.0) / 10, 1 - len(set(words)) / (w + 1),
            1 - len(set(lines)) / len(lines), sum(map(bytes.isupper, words)) / (w + 1),
            math.log1p(len(lines)) / 10]
    return np.concatenate([np.sqrt(shares), more])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.03,
                 rounds: int = 40) -> np.ndarray:
    """Ridge logistic regression by Newton steps; intercept last, not penalised."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), grad)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def _concentration(sites: DataFrame, mean: str, prior: str) -> float:
    """Prior sample size of a Beta by moments: how little the sites differ beyond chance."""
    row = sites.agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") ** 2).alias("n2"),
        F.sum(F.col("n") * (F.col(mean) - F.col(prior)) ** 2).alias("ss"),
        (F.sum(F.col("n") * F.col(prior) * (1 - F.col(prior))) / F.sum("n")).alias("v")).first()
    if not row.k or row.k < 2 or not row.n or not row.v:
        return 1e6
    between = (row.ss - (row.k - 1) * row.v) / max(row.n - row.n2 / row.n, 1.0)
    return min(max(row.v / max(between, 1e-12) - 1, 1.0), 1e6)


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", host_col: str = "source", path_col: str = "lang",
                  label_col: str = "quality", label_id: str = "doc_id", threshold: float = 0.5,
                  fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row of ``docs``: id, ``evidence`` (log odds of the document classifier against the base
    rate), ``host_quality``, ``path_quality``, ``quality`` and ``kept``, with ``row_key`` columns.

    The classifier is fitted on at most ``fit_rows`` labelled documents; everything else covers all
    rows. A row counts for its site with its label, else with the classifier's probability. Hosts
    shrink toward the global mean and paths toward their host, with prior sizes estimated from how
    much sites differ (grouped sums only), so a site with few rows says little. The posterior odds
    are the evidence times the path's odds.

    Null or empty texts have the features of an empty text; a null host or path is a site of its
    own; labels other than 0 and 1 and null ids are left out, repeated labels are averaged and
    rounded (a tie is good); without both label values the evidence is 0 and all rows are kept;
    repeated rows score alike; an empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(host_col).alias("host"),
                       F.xxhash64(path_col).alias("path"), *row_key(id_col, text_col),
                       F.col(text_col).alias("text"))
    kind = rows.drop("text").schema

    def extract(batches):
        for batch in batches:
            found = [features(t) for t in batch.column(5).cast(pa.binary()).to_pylist()]
            flat = pa.array(np.concatenate(found).astype(np.float32) if found else [], pa.float32())
            values = pa.ListArray.from_arrays(
                pa.array(np.arange(len(found) + 1) * N_FEATURES, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], values],
                                             names=[*batch.schema.names[:5], "x"])

    table = stored(rows.mapInArrow(giving_back(extract), kind.simpleString()[7:-1] + ",x:array<float>"),
                   "features")
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(label_id).isNotNull()) \
        .groupBy(F.col(label_id).alias("id")) \
        .agg((F.avg(F.col(label_col)) >= 0.5).cast("double").alias("y"))
    table = stored(table.join(known, "id", "left"), "labelled")
    fit = table.where("y IS NOT NULL").select("_k1", "_k2", "x", "y")
    share = 1.2 * fit_rows / max(fit.count(), 1)
    if share < 1:  # by the id hash, so that tasks do not each send fit_rows rows to the top-n
        fit = fit.where(F.pmod(F.col("_k1"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = fit.orderBy("_k1", "_k2").limit(fit_rows).toPandas()
    y = sample["y"].to_numpy(float)
    if len(y) and 0 < y.sum() < len(y):
        weights = fit_logistic(np.stack(sample["x"].to_numpy()).astype(float), y)
        base = math.log(y.mean() / (1 - y.mean()))
    else:
        weights, base = np.zeros(N_FEATURES + 1), 0.0
    products = F.zip_with("x", F.array(*[F.lit(float(w)) for w in weights[:-1]]),
                          lambda a, b: a.cast("double") * b)
    odds = F.aggregate(products, F.lit(float(weights[-1])), lambda a, b: a + b)
    scored = table.withColumn("odds", odds).withColumn(
        "p", F.coalesce("y", 1 / (1 + F.exp(-F.col("odds")))))
    paths = stored(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"),
                                                      F.sum("p").alias("s")), "sites")
    total = paths.agg((F.sum("s") / F.sum("n")).alias("m")).first().m
    prior = min(max(total if total is not None else 0.5, 1e-6), 1 - 1e-6)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")) \
        .withColumn("mean", F.col("s") / F.col("n")).withColumn("prior", F.lit(prior))
    size = _concentration(hosts, "mean", "prior")
    hosts = hosts.select("host", ((F.col("s") + size * prior) / (F.col("n") + size))
                         .alias("host_quality"))
    paths = paths.join(hosts, "host").withColumn("mean", F.col("s") / F.col("n"))
    size = _concentration(paths, "mean", "host_quality")
    sites = stored(paths.select("host", "path", "host_quality", (
        (F.col("s") + size * F.col("host_quality")) / (F.col("n") + size)).alias("path_quality")),
        "posteriors")
    joined = scored.join(broadcast_checked(sites), ["host", "path"])
    evidence = F.col("odds") - F.lit(base)
    final = evidence + _logit(F.col("path_quality"))
    quality = 1 / (1 + F.exp(-final))
    unknown = F.lit(not weights.any())
    return joined.select(F.col("id").alias(id_col), evidence.alias("evidence"), "host_quality",
                         "path_quality", quality.alias("quality"),
                         ((quality >= threshold) | unknown).alias("kept"), "_k1", "_k2")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              **settings) -> DataFrame:
    """``docs``, all columns, without the rows that ``score_quality`` rejects."""
    scored = score_quality(docs, labels, id_col, text_col, **settings)
    return without_rows(docs, scored.where("NOT kept").select("_k1", "_k2"), id_col, text_col)
