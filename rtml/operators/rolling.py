"""Running, row-rolling and time-rolling metrics over an ordered stream.

A sliding mean is the end of one segment and the beginning of the next, two running sums kept within
bounded blocks or chunks, so its cost per row does not depend on the frame length and no key has to
fit in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rtml.plans.prefix import CHUNK, overlapped, quantile_bounds, row_numbers, running_totals, with_chunk


def running_means(df: DataFrame, keys: list[str], order: str,
                  exprs: dict[str, Column]) -> DataFrame:
    """Mean of each expression over all rows so far, current row included; nulls are left out."""
    measures = {f"_sum_{n}": F.coalesce(e.cast("double"), F.lit(0.0)) for n, e in exprs.items()} | \
        {f"_n_{n}": e.isNotNull().cast("long") for n, e in exprs.items()} | \
        {"rows_so_far": F.lit(1).cast("long")}
    run = running_totals(with_chunk(df, order), keys, [order], measures)
    return run.select(*df.columns, "rows_so_far", *[
        F.try_divide(F.col(f"_sum_{n}"), F.col(f"_n_{n}")).alias(n) for n in exprs])


def every(df: DataFrame, order: str, n: int = 100) -> DataFrame:
    """Periodic emission: the rows whose offset is a multiple of n."""
    return df.where(F.pmod(F.col(order), F.lit(n)) == 0)


def rolling_means(df: DataFrame, keys: list[str], order: str, exprs: dict[str, Column],
                  rows: int = 1000, rows_per_block: int = 200_000) -> DataFrame:
    """Mean over the last ``rows`` rows of the key, current row included; nulls are left out.

    Positions are cut into segments of ``rows``. A frame is the end of one segment and the beginning
    of the next, so it is a running sum from behind plus one from the front: nothing is ever
    subtracted, and a NaN or a huge value acts on the frames that hold it and on no other.
    """
    base = df.withColumns({f"_x_{n}": e.cast("double") for n, e in exprs.items()})
    numbered = row_numbers(with_chunk(base, order), keys, [order], out="_rn")
    size = rows * max(2, -(-rows_per_block // rows))
    blocks = overlapped(numbered, "_rn", size, rows) \
        .withColumn("_seg", F.floor((F.col("_rn") - 1) / rows))
    segment = Window.partitionBy(*keys, "_block", "_seg")
    front = segment.orderBy("_rn").rowsBetween(Window.unboundedPreceding, 0)
    behind = segment.orderBy(F.desc("_rn")).rowsBetween(Window.unboundedPreceding, 0)
    parts = []
    for n in exprs:
        x = F.col(f"_x_{n}")
        value, there = F.coalesce(x, F.lit(0.0)), x.isNotNull().cast("long")
        parts += [F.sum(value).over(front).alias(f"_fs_{n}"),
                  F.sum(there).over(front).alias(f"_fn_{n}"),
                  F.sum(value).over(behind).alias(f"_bs_{n}"),
                  F.sum(there).over(behind).alias(f"_bn_{n}")]
    sums = blocks.select("*", *parts)
    w = Window.partitionBy(*keys, "_block").orderBy("_rn")
    inner = F.pmod(F.col("_rn"), F.lit(rows)) == 0  # the frame is this very segment
    held = sums.select("*", *[
        (F.col(f"_f{k}_{n}") + F.when(inner, zero).otherwise(F.coalesce(
            F.lag(f"_b{k}_{n}", rows - 1).over(w), zero)) if rows > 1 else F.col(f"_f{k}_{n}"))
        .alias(f"_h{k}_{n}") for n in exprs for k, zero in (("s", F.lit(0.0)), ("n", F.lit(0)))])
    return held.where("_own").select(*df.columns, *[
        F.try_divide(F.col(f"_hs_{n}"), F.col(f"_hn_{n}")).alias(n) for n in exprs])


def time_rolling_means(df: DataFrame, keys: list[str], ts: str, exprs: dict[str, Column],
                       seconds: int = 300) -> DataFrame:
    """Mean over the rows of the key in [ts - seconds, ts], rows of equal time included.

    Nulls are left out. Non-finite values are counted apart: frames that hold one are NaN.

    Time is cut into segments of ``seconds``. A frame is the beginning of its row's segment and the
    end of the one before, so it is a running sum from the front plus one from behind: nothing is ever
    subtracted, and a huge value acts on the frames that hold it and on no other. The row asks for
    the second sum as one more row of the earlier segment. A burst of any size inside a segment is cut
    into even chunks like any order.
    """
    length = seconds * 1_000_000
    base = df.withColumns({f"_x_{n}": e.cast("double") for n, e in exprs.items()} |
                          {"_t": F.unix_micros(F.col(ts).cast("timestamp"))}) \
        .withColumn("_seg", F.floor(F.col("_t") / length))
    names = ["rows_in_frame"]
    measures = {"rows_in_frame": F.lit(1).cast("long")}
    for n in exprs:
        x = F.col(f"_x_{n}")
        odd = F.isnan(x) | (F.abs(x) == float("inf"))
        measures |= {f"_s_{n}": F.when(x.isNull() | odd, 0.0).otherwise(x),
                     f"_n_{n}": x.isNotNull().cast("long"),
                     f"_o_{n}": F.coalesce(odd.cast("long"), F.lit(0))}
        names += [f"_s_{n}", f"_n_{n}", f"_o_{n}"]
    bounds = quantile_bounds(base, "_t")
    front = running_totals(with_chunk(base, "_t", bounds), [*keys, "_seg"], ["_t"], measures,
                           peers=True).drop(CHUNK)
    asks = F.explode(F.array(
        F.struct(F.lit(False).alias("asks"), F.col("_t").alias("at"), F.col("_seg").alias("seg")),
        F.struct(F.lit(True).alias("asks"), (F.col("_t") - length).alias("at"),
                 (F.col("_seg") - 1).alias("seg"))))
    both = front.withColumn("_m", asks).withColumns(
        {"_asks": F.col("_m.asks"), "_at": F.col("_m.at"), "_seg": F.col("_m.seg")}).drop("_m")
    ends = {f"_b{c}": F.when(F.col("_asks"), F.lit(0)).otherwise(m) for c, m in measures.items()}
    run = running_totals(with_chunk(both, "_at", bounds), [*keys, "_seg"], [F.desc("_at")], ends,
                         descending=True, peers=True)
    whole = run.where("_asks").withColumns({c: F.col(c) + F.col(f"_b{c}") for c in names})
    return whole.select(*df.columns, "rows_in_frame", *[
        F.when(F.col(f"_o_{n}") > 0, float("nan"))
        .otherwise(F.try_divide(F.col(f"_s_{n}"), F.col(f"_n_{n}"))).alias(n) for n in exprs])


def rolling_auc(df: DataFrame, keys: list[str], order: str, label: str, score: str,
                rows: int = 5000, step: int = 5000) -> DataFrame:
    """ROC AUC of the last ``rows`` rows, reported at every ``step``-th row of the key.

    A row is sent to the ``rows / step`` report points it belongs to and counted there per
    distinct score, so a report point never holds more than ``rows`` values.
    """
    if rows % step:
        raise ValueError("rows must be a multiple of step")
    slim = df.select(*keys, order, F.col(label).cast("int").alias("_y"), F.col(score).alias("_p"))
    numbered = row_numbers(with_chunk(slim, order), keys, [order], out="_rn")
    first = F.ceil(F.col("_rn") / step)
    points = numbered.withColumn("point", F.explode(F.sequence(first, first + (rows // step - 1))))
    counts = points.groupBy(*keys, "point", "_p").agg(
        F.sum("_y").alias("_pos"), F.sum(1 - F.col("_y")).alias("_neg"),
        F.max("_rn").alias("_last"))
    w = Window.partitionBy(*keys, "point").orderBy(F.col("_p").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    area = counts.withColumn("_area", F.col("_neg") * (
        F.coalesce(F.sum("_pos").over(w), F.lit(0)) + F.col("_pos") / 2.0))
    return (area.groupBy(*keys, "point")
            .agg(F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"),
                 F.sum("_area").alias("_area"), F.max("_last").alias("_last"))
            .where(F.col("_last") == F.col("point") * step)
            .select(*keys, (F.col("point") * step).cast("long").alias("at_row"),
                    "positives", "negatives",
                    F.try_divide(F.col("_area"), F.col("positives") * F.col("negatives"))
                    .alias("auc")))


def lag_features(df: DataFrame, keys: list[str], order: str, value: str, lags: int = 7,
                 season: int = 7, rows_per_block: int = 200_000) -> DataFrame:
    """Autoregressive inputs: lags 1..n, first difference, seasonal lag and difference."""
    depth = max(lags, season)
    numbered = row_numbers(with_chunk(df, order), keys, [order], out="_rn")
    blocks = overlapped(numbered, "_rn", max(rows_per_block, 2 * depth), depth)
    w = Window.partitionBy(*keys, "_block").orderBy("_rn")
    cols = {f"lag_{i}": F.lag(value, i).over(w) for i in range(1, lags + 1)}
    cols["diff_1"] = F.col(value) - F.lag(value, 1).over(w)
    cols[f"season_lag_{season}"] = F.lag(value, season).over(w)
    cols[f"season_diff_{season}"] = F.col(value) - F.lag(value, season).over(w)
    out = blocks.select("*", *[c.alias(n) for n, c in cols.items()])
    return out.where("_own").select(*df.columns, *cols)

