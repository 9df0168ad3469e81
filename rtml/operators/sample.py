"""Sampling, splitting and set assembly.

Every deterministic sample uses a hash of the row key, so it does not depend on partitioning and
is the same after a task is run again.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, functions as F

from rtml.plans.prefix import CHUNK, row_numbers
from rtml.session import bounded, shuffle_partitions


def hash_unit(key: str | Column, seed: int = 42) -> Column:
    """Uniform number in [0, 1) from the key: 52 bits of an md5."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def percent_sample(df: DataFrame, percent: float, seed: int = 42,
                   key: str | Column | None = None) -> DataFrame:
    """Row sample at the scan; take it before encoding so that codes stay dense.

    A row is taken by a hash of its key, or of all its values, so the sample does not depend on how
    rows are laid out; rows equal in that are taken together.
    """
    if key is not None:
        return df.where(hash_unit(key, seed) < percent / 100.0)
    unit = F.pmod(F.xxhash64(F.lit(seed), *df.columns), F.lit(1 << 40)) / float(1 << 40)
    return df.where(unit < percent / 100.0)


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    return df.where(hash_unit(key, seed) < F.lit(fraction))


def row_cap(df: DataFrame, max_rows: int) -> DataFrame:
    """Row cap after encoding: codes still come from the whole table."""
    return df.limit(max_rows)


def random_rows(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """n random rows by a top-n on a random number, without a full sort."""
    return df.orderBy(F.rand(seed)).limit(n)


def hashed_rank(df: DataFrame, key: str, strata: list[str], seed: int = 42,
                out: str = "rn") -> DataFrame:
    """1-based position of each row in the hash order of its stratum.

    The hash is uniform, so cutting [0, 1) evenly gives even chunks however few strata there are.
    """
    n = shuffle_partitions(df.sparkSession)
    hashed = df.withColumn("_u", hash_unit(key, seed)) \
        .withColumn(CHUNK, F.floor(F.col("_u") * n).cast("int"))
    return row_numbers(hashed, strata, ["_u", key], out=out).drop("_u")


def _with_stratum_size(df: DataFrame, strata: list[str]) -> DataFrame:
    if not strata:
        return df.withColumn("_size", df.agg(F.count(F.lit(1))).scalar())
    sizes = df.groupBy(*[F.col(s).alias(f"_k_{s}") for s in strata]) \
        .agg(F.count(F.lit(1)).alias("_size"))
    match = None
    for s in strata:
        same = F.col(s).eqNullSafe(F.col(f"_k_{s}"))
        match = same if match is None else match & same
    return df.join(bounded(sizes), match).drop(*[f"_k_{s}" for s in strata])


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Add ``split``: exactly round(n_c * test_size) test rows in every class."""
    ranked = _with_stratum_size(hashed_rank(df, key, [label], seed), [label])
    test = F.col("rn") <= F.floor(F.col("_size") * test_size + 0.5)
    return ranked.withColumn("split", F.when(test, "test").otherwise("train")).drop("rn", "_size")


def random_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split`` by a hash threshold: no shuffle at all."""
    return df.withColumn("split", F.when(hash_unit(key, seed) < test_size, "test")
                         .otherwise("train"))


def stratified_subsample(df: DataFrame, label: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """About n rows with the class shares kept: round(n * n_c / N) of each class."""
    total = df.agg(F.count(F.lit(1))).scalar()
    ranked = _with_stratum_size(hashed_rank(df, key, [label], seed), [label])
    quota = F.floor(F.col("_size") * n / total + 0.5)
    return ranked.where(F.col("rn") <= quota).drop("rn", "_size")


def folds(df: DataFrame, key: str, k: int = 5, label: str | None = None, seed: int = 42,
          out: str = "fold") -> DataFrame:
    """Fold number 0..k-1; with a label every class is dealt evenly over the folds."""
    if label is None:
        return df.withColumn(out, F.floor(hash_unit(key, seed) * k).cast("int"))
    ranked = hashed_rank(df, key, [label], seed)
    return ranked.withColumn(out, ((F.col("rn") - 1) % k).cast("int")).drop("rn")


def nested_sizes(df: DataFrame, key: str, fractions: list[float], seed: int = 42) -> DataFrame:
    """One copy of a row for each training size that contains it; sizes are nested."""
    ranked = _with_stratum_size(hashed_rank(df, key, [], seed), [])
    sizes = F.array(*[F.lit(float(f)) for f in fractions])
    ranked = ranked.withColumn("_sizes", sizes)
    inside = F.expr("filter(_sizes, f -> rn <= floor(_size * f + 0.5))")
    return ranked.withColumn("train_fraction", F.explode(inside)).drop("rn", "_size", "_sizes")


def train_fractions(low: float = 0.1, high: float = 1.0, steps: int = 5) -> list[float]:
    return [round(low + (high - low) * i / (steps - 1), 10) for i in range(steps)]


def undersample(df: DataFrame, label: str, key: str, desired: dict, seed: int = 42) -> DataFrame:
    """Rejection sampling towards the desired class shares.

    A class is kept with probability desired/observed divided by the largest such ratio.
    """
    counts = df.where(F.col(label).isin(list(desired))).groupBy(label) \
        .agg(F.count(F.lit(1)).alias("n")).collect()  # one row per desired class
    total = sum(r.n for r in counts)
    ratio = {r[label]: desired[r[label]] / (r.n / total) for r in counts}
    top = max(ratio.values()) if ratio else 1.0
    accept = F.lit(0.0)
    for value, r in ratio.items():
        accept = F.when(F.col(label) == F.lit(value), F.lit(r / top)).otherwise(accept)
    return df.where(hash_unit(key, seed) < accept)


def feature_subset(columns: list[str], fraction: float, seed: int = 42) -> list[str]:
    """Random columns, in their original order, at least one."""
    n = max(1, round(len(columns) * fraction))
    chosen = set(random.Random(seed).sample(columns, n))
    return [c for c in columns if c in chosen]


def union_splits(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def distinct_queries(df: DataFrame, column: str, min_length: int = 3) -> DataFrame:
    """Distinct texts that are present and at least ``min_length`` characters long."""
    return df.where(F.col(column).isNotNull() & (F.length(column) >= min_length)) \
        .select(column).distinct()


def search_projection(df: DataFrame, column: str, keep: list[str],
                      limit: int | None = None) -> DataFrame:
    out = df.where(F.col(column).isNotNull() & (F.trim(F.col(column)) != "")).select(*keep)
    return out.limit(limit) if limit else out
