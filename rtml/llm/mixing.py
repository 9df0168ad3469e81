"""Temperature mixing of sources under a token budget, in DataFrame functions only."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rtml.llm.common import prepare, stored

#: Sources whose totals may be gathered for the bisection (one number each).
MAX_SOURCES = 1_000_000


def token_count(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _weights(shares: list[float], alpha: float) -> list[float]:
    top = max(shares)
    raw = [(s / top) ** alpha if s > 0 else 0.0 for s in shares]
    total = sum(raw)
    return [r / total for r in raw]


def _entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def solve_exponent(tokens: list[int], target_entropy: float | None = None,
                   max_repetition: float | None = None, budget: float | None = None,
                   rounds: int = 60) -> float:
    """Exponent in [0, 1] for source token counts.

    ``target_entropy`` (a share of the largest possible entropy) asks for the exponent whose weights
    reach it: entropy falls as the exponent grows. ``max_repetition`` asks for the smallest exponent
    under which no source is read more often than that; with no ``budget`` the budget is the least
    one that reads every source at least once. If both are given, the larger exponent counts, so the
    limit always holds where exponent 1 can hold it.
    """
    total = sum(tokens)
    if total <= 0 or sum(t > 0 for t in tokens) < 2:
        return 1.0
    shares = [t / total for t in tokens]

    def repetition(alpha):
        rates = [w / t for w, t in zip(_weights(shares, alpha), tokens) if t > 0]
        return max(rates) * budget if budget else max(rates) / min(rates)

    def bisect(too_flat):
        low, high = 0.0, 1.0
        if not too_flat(0.0):
            return 0.0
        for _ in range(rounds):
            middle = (low + high) / 2
            low, high = (middle, high) if too_flat(middle) else (low, middle)
        return high

    found = [0.0]
    if max_repetition is not None:
        found.append(bisect(lambda a: repetition(a) > max_repetition))
    if target_entropy is not None:
        wanted = target_entropy * math.log(sum(t > 0 for t in tokens))
        found.append(bisect(lambda a: _entropy(_weights(shares, a)) > wanted))
    return max(found) if len(found) > 1 else 1.0


def mixture(docs: DataFrame, source_col: str = "source", text_col: str = "text",
            target_entropy: float | None = None, max_repetition: float | None = None,
            budget: int | None = None) -> list[tuple[str | None, int, int]]:
    """(source, its tokens, its budget in tokens) after bisecting the exponent.

    Only one total per source reaches the driver. Budgets are rounded to whole tokens.
    """
    totals = docs.groupBy(F.col(source_col).cast("string").alias("s")) \
        .agg(F.sum(token_count(F.col(text_col))).alias("t")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; mix by a coarser column")
    totals = sorted(((r.s, int(r.t)) for r in totals), key=lambda x: (x[0] is None, x[0] or ""))
    tokens = [t for _, t in totals]
    if sum(tokens) == 0:
        return [(s, t, 0) for s, t in totals]
    alpha = solve_exponent(tokens, target_entropy, max_repetition, budget)
    weights = _weights([t / sum(tokens) for t in tokens], alpha)
    size = budget or max(t / w for t, w in zip(tokens, weights) if w > 0)
    return [(s, t, int(round(w * size, 3) + 0.5)) for (s, t), w in zip(totals, weights)]


def realise(docs: DataFrame, plan: list[tuple[str | None, int, int]], id_col: str = "doc_id",
            source_col: str = "source", text_col: str = "text", blocks: int = 1024,
            seed: str = "mix") -> DataFrame:
    """How often each row is read under the plan, keyed by source, id and text hash.

    A source with ``t`` tokens and budget ``b`` is read ``b // t`` times in full and then once more
    until the rest of the budget is used: its rows lie in ``blocks`` blocks by a hash of the id, the
    blocks follow in a permutation drawn from ``seed``, and rows inside a block by their own hash; a
    row is read as long as less than the rest was read before it. Running sums are taken over block
    totals and inside the one border block of each source, so no source is gathered; a block of a
    source above ``blocks`` million rows should be made smaller by raising ``blocks``. Rows equal in
    id and text share a place and are read together. Null sources are a source; null or empty texts
    have no tokens, so only full readings count them; an empty table stays empty.
    """
    spark = docs.sparkSession
    prepare(spark)
    # from Arrow: plain rows would be read by Python tasks, whose idle workers stay in memory
    table = spark.createDataFrame(pa.table({
        "_s": pa.array([s for s, _, _ in plan], pa.string()),
        "_t": pa.array([t for _, t, _ in plan], pa.int64()),
        "_b": pa.array([b for _, _, b in plan], pa.int64())}))
    table = table.withColumn("_full", F.when(F.col("_t") > 0, F.floor(F.col("_b") / F.col("_t")))
                             .otherwise(1)) \
        .withColumn("_rest", F.when(F.col("_t") > 0, F.col("_b") - F.col("_full") * F.col("_t"))
                    .otherwise(0))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(source_col).cast("string").alias("s"), key.alias("key"),
                       token_count(F.col(text_col)).alias("n"),
                       F.xxhash64(text_col).alias("h"))
    placed = rows.groupBy("s", "key", "h").agg(F.sum("n").alias("n")) \
        .withColumn("place", F.md5(F.concat(F.lit(seed), "key")))
    placed = placed.withColumn("block", F.pmod(F.conv(F.substring("place", 1, 8), 16, 10)
                                               .cast("long"), F.lit(blocks)))
    placed = stored(placed, "places")
    sums = placed.groupBy("s", "block").agg(F.sum("n").alias("n")) \
        .withColumn("turn", F.md5(F.concat(F.lit(f"{seed}-block"), F.col("block").cast("string"))))
    ahead = Window.partitionBy("s").orderBy("turn", "block") \
        .rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))) \
        .join(F.broadcast(table), F.col("s").eqNullSafe(F.col("_s"))) \
        .select(F.col("s").alias("_bs"), F.col("block").alias("_bb"), F.col("n").alias("size"),
                "before", "_full", "_rest")
    # sources x blocks rows: the bound of this broadcast is the bounded list of sources
    if len(plan) * blocks <= 1_000_000:
        sums = F.broadcast(sums)
    inside = placed.join(sums, F.col("s").eqNullSafe(F.col("_bs")) &
                         (F.col("block") == F.col("_bb")))
    end = F.col("before") + F.col("size")
    border = (F.col("before") < F.col("_rest")) & (end >= F.col("_rest"))
    within = Window.partitionBy("s", "block").orderBy("place", "h") \
        .rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum("n").over(within), F.lit(0))
    cut = inside.where(border).withColumn("more", (at < F.col("_rest")).cast("int"))
    clear = inside.where(~border).withColumn("more", (end < F.col("_rest")).cast("int"))
    return cut.select("s", "key", "h", "_full", "more") \
        .union(clear.select("s", "key", "h", "_full", "more")) \
        .select(F.col("s").alias("_ms"), F.col("key").alias("_mk"), F.col("h").alias("_mh"),
                (F.col("_full") + F.col("more")).cast("long").alias("_mc"))


def mixed_ids(docs: DataFrame, plan, id_col="doc_id", source_col="source", text_col="text",
              **settings) -> DataFrame:
    """Id, source, tokens and copies per row of ``docs``; see ``realise``."""
    copies = realise(docs, plan, id_col, source_col, text_col, **settings)
    rows = docs.select(F.col(id_col), F.col(source_col),
                       token_count(F.col(text_col)).alias("n_tokens"),
                       F.xxhash64(text_col).alias("_h"))
    return rows.join(copies, _match(rows, copies, id_col, source_col, F.col("_h"))) \
        .select(id_col, source_col, "n_tokens", F.col("_mc").alias("copies"))


def _match(rows, copies, id_col, source_col, text_hash):
    return (F.coalesce(F.col(id_col).cast("string"), F.lit("")) == F.col("_mk")) & \
        F.col(source_col).cast("string").eqNullSafe(F.col("_ms")) & (text_hash == F.col("_mh"))


def mix(docs: DataFrame, plan, id_col="doc_id", source_col="source", text_col="text",
        **settings) -> DataFrame:
    """``docs`` with every row repeated as often as the plan reads it (0 times: left out)."""
    copies = stored(realise(docs, plan, id_col, source_col, text_col, **settings), "copies")
    odd = copies.where("_mc <> 1")
    few = odd.count()
    if few <= 1_000_000:  # two longs and two short strings each
        odd = F.broadcast(odd)
    # the row is one struct, so no column of it can have the name of a column of the plan
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"),
                       F.col(source_col).alias("_source"), F.xxhash64(text_col).alias("_text"))
    joined = rows.join(odd, _match(rows, odd, "_id", "_source", F.col("_text")), "left")
    times = F.coalesce(F.col("_mc"), F.lit(1)).cast("int")
    return joined.withColumn("_again", F.explode(F.array_repeat(F.lit(0), times))).select("_row.*")
