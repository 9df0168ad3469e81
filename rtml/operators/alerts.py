"""Metric series: rates, bucket quantiles, threshold alerts with duration, staleness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rtml.plans.prefix import CHUNK, previous_value, running_totals, with_chunk


def counter_increments(df: DataFrame, series: list[str], ts: str, value: str) -> DataFrame:
    """Add ``increment``: growth since the previous sample; after a reset, the new value itself.

    The first sample of a series has no increment.
    """
    prev = previous_value(with_chunk(df, ts), series, ts, [value]).drop(CHUNK)
    before = F.col(f"prev_{value}")
    grown = F.when(F.col(value) >= before, F.col(value) - before).otherwise(F.col(value))
    return prev.withColumn("increment", F.when(before.isNotNull(), grown)).drop(f"prev_{value}")


def counter_rate(df: DataFrame, series: list[str], ts: str, value: str,
                 seconds: int = 300) -> DataFrame:
    """Increase and per-second rate in fixed windows."""
    inc = counter_increments(df, series, ts, value)
    start = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(seconds * 1_000_000)) * seconds
    return inc.groupBy(*series, start.cast("long").alias("window_start")).agg(
        F.coalesce(F.sum("increment"), F.lit(0)).alias("increase")) \
        .withColumn("rate", F.col("increase") / F.lit(float(seconds)))


def instant_rate(df: DataFrame, series: list[str], ts: str, value: str) -> DataFrame:
    """Rate between the last two samples of each series; the two come from one aggregation."""
    inc = counter_increments(df.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp"))),
                             series, "_t", value)
    prev_t = previous_value(with_chunk(inc, "_t"), series, "_t", ["_t"]).drop(CHUNK)
    last = prev_t.groupBy(*series).agg(F.max(F.struct(
        "_t", "increment", (F.col("_t") - F.col("prev__t")).alias("_d"))).alias("l"))
    return last.select(*series, F.try_divide(F.col("l.increment").cast("double"),
                                             F.col("l._d") / 1e6).alias("irate"))


def ratio_of_rates(df: DataFrame, ts: str, hit: Column, amount: Column, seconds: int = 300,
                   by: list[str] | None = None) -> DataFrame:
    """Share of matching increments per window."""
    start = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(seconds * 1_000_000)) * seconds
    sums = df.groupBy(*(by or []), start.cast("long").alias("window_start")).agg(
        F.sum(F.when(hit, amount).otherwise(0)).alias("matched"), F.sum(amount).alias("total"))
    return sums.withColumn("ratio", F.try_divide(F.col("matched").cast("double"),
                                                 F.col("total").cast("double")))


def sliding_rate(df: DataFrame, series: list[str], ts: str, value: str, seconds: int = 300,
                 step: int = 60) -> DataFrame:
    """Increase and rate over the last ``seconds`` of a counter, evaluated every ``step`` seconds.

    At ``eval_time`` the growth between two neighbouring samples counts if both lie in
    (eval_time - seconds, eval_time]; resets are taken into account. Times without such a pair have no row. A sample
    reaches at most ``seconds / step`` evaluation times, so the work stays linear.
    """
    timed = df.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")))
    inc = counter_increments(timed, series, "_t", value)
    pairs = previous_value(with_chunk(inc, "_t"), series, "_t", ["_t"]).drop(CHUNK) \
        .where(F.col("increment").isNotNull())
    width = step * 1_000_000
    first = F.ceil(F.col("_t") / width)
    last = F.ceil((F.col("prev__t") + seconds * 1_000_000) / width) - 1
    points = pairs.where(first <= last).withColumn("_at", F.explode(F.sequence(first, last)))
    return points.groupBy(*series, (F.col("_at") * step).cast("long").alias("eval_time")) \
        .agg(F.sum("increment").alias("increase")) \
        .withColumn("rate", F.col("increase") / F.lit(float(seconds)))


def ratio_of_counters(df: DataFrame, series: list[str], ts: str, value: str, hit: Column,
                      seconds: int = 300, step: int = 60,
                      by: list[str] | None = None) -> DataFrame:
    """Sum of the rates of the matching series over that of all series, at every step."""
    rates = sliding_rate(df, series, ts, value, seconds, step)
    return rates.groupBy(*(by or []), "eval_time").agg(
        F.try_divide(F.sum(F.when(hit, F.col("rate")).otherwise(0.0)), F.sum("rate"))
        .alias("ratio"))


def average_instant_rate(df: DataFrame, series: list[str], by: list[str], ts: str,
                         value: str) -> DataFrame:
    """Mean over the series of a label of the rate between their last two samples."""
    return instant_rate(df, series, ts, value).groupBy(*by).agg(
        F.avg("irate").alias("avg_irate"), F.count("irate").alias("series"))


def bucket_quantile(df: DataFrame, by: list[str], q: float, le: str = "le",
                    cumulative: str = "cumulative") -> DataFrame:
    """Quantile by linear interpolation in cumulative ``le`` buckets (+Inf as null).

    In the +Inf bucket the answer is the largest finite bound. A group holds one row per bucket.
    """
    w = Window.partitionBy(*by).orderBy(F.col(le).asc_nulls_last())
    rows = df.select(*by, le, cumulative,
                     F.coalesce(F.lag(le).over(w), F.lit(0.0)).alias("_lo"),
                     F.coalesce(F.lag(cumulative).over(w), F.lit(0)).alias("_before"),
                     F.max(cumulative).over(Window.partitionBy(*by)).alias("_total"))
    rank = F.col("_total") * F.lit(q)
    inside = F.col("_lo") + (F.col(le) - F.col("_lo")) * F.try_divide(
        rank - F.col("_before"), (F.col(cumulative) - F.col("_before")).cast("double"))
    value = F.when(F.col(le).isNull(), F.col("_lo")).otherwise(inside)
    hit = rows.where((F.col(cumulative) >= rank) & (F.col("_total") > 0))
    return hit.groupBy(*by).agg(
        F.min(F.struct(F.coalesce(le, F.lit(float("inf"))), value.alias("v"))).alias("_m")) \
        .select(*by, F.col("_m.v").alias("quantile"))


def alert_intervals(df: DataFrame, series: list[str], ts: str, breach: Column,
                    hold_seconds: int = 300) -> DataFrame:
    """Uninterrupted breaches of at least ``hold_seconds``: start, firing time, end, samples."""
    flagged = df.select(*series, ts, F.coalesce(breach, F.lit(False)).alias("_b"))
    run = running_totals(with_chunk(flagged, ts), series, [ts],
                         {"_island": F.when(F.col("_b"), 0).otherwise(1).cast("long")})
    spans = run.where("_b").groupBy(*series, "_island").agg(
        F.min(ts).alias("started"), F.max(ts).alias("ended"), F.count(F.lit(1)).alias("samples"))
    length = F.unix_micros(F.col("ended").cast("timestamp")) - \
        F.unix_micros(F.col("started").cast("timestamp"))
    return spans.where(length >= hold_seconds * 1_000_000).select(
        *series, "started",
        (F.col("started") + F.make_dt_interval(secs=F.lit(hold_seconds))).alias("firing_from"),
        "ended", "samples")


def staleness(df: DataFrame, series: list[str], ts: str, now: Column | None = None,
              limit_seconds: int = 600) -> DataFrame:
    """Seconds since the last sample of each series and whether that is too long."""
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    last = df.groupBy(*series).agg(F.max(t).alias("_last"))
    at = df.agg(F.max(t)).scalar() if now is None else F.unix_micros(now.cast("timestamp"))
    age = (at - F.col("_last")) / 1e6
    return last.select(*series, age.alias("age_seconds"), (age > limit_seconds).alias("stale"))


def latest_sum(df: DataFrame, series: list[str], by: list[str], ts: str, value: str) -> DataFrame:
    """Sum by label over the latest sample of each series."""
    last = df.groupBy(*series).agg(F.max_by(value, ts).alias("_v"))
    return last.groupBy(*by).agg(F.sum("_v").alias("total"), F.count(F.lit(1)).alias("series"))
