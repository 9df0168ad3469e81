"""Model-run registry: ranking, live choice, comparison with a parent run, offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_NO_METRIC = "_metric"


def _metric(df: DataFrame, metric: str | None) -> Column:
    """The metric column, or null where the table does not have it."""
    return F.col(metric) if metric and metric in df.columns else F.lit(None).cast("double")


def _best_first(metric: Column, maximize: bool, started: str, run: str) -> list[Column]:
    ranked = metric.desc_nulls_last() if maximize else metric.asc_nulls_last()
    return [ranked, F.col(started).desc(), F.col(run).asc()]


def run_leaderboard(runs: DataFrame, metric: str | None, maximize: bool, run: str = "run_id",
                    started: str = "start_time", rows: tuple[str, str] | None = None) -> DataFrame:
    """Runs with ``place`` (1 = best; a missing metric comes last) and ``is_best``.

    The registry holds one row per run, so ranking it in one window is bounded by the run count.
    """
    w = Window.partitionBy(F.lit(0)).orderBy(*_best_first(_metric(runs, metric), maximize,
                                                          started, run))
    out = runs.withColumn("place", F.row_number().over(w).cast("long")) \
        .withColumn("is_best", F.col("place") == 1)
    if rows:
        train, test = rows
        out = out.withColumn("total_rows", F.coalesce(F.col(train), F.lit(0)) +
                             F.coalesce(F.col(test), F.lit(0)))
    return out


def best_run(runs: DataFrame, name: str | None, metric: str | None, maximize: bool,
             by: list[str] | None = None) -> DataFrame:
    """Best finished run that has an artifact; the newest one where no run has the metric.

    Expects ``run_id, status, name, start_time, has_artifact``. ``by`` gives one winner per group.
    """
    ok = (F.col("status") == "FINISHED") & F.col("has_artifact")
    if name is not None:
        ok = ok & (F.col("name") == name)
    order = _best_first(_metric(runs, metric), maximize, "start_time", "run_id")
    if not by:  # a top 1, merged from the tops of the tasks
        return runs.where(ok).orderBy(*order).limit(1)
    w = Window.partitionBy(*by).orderBy(*order)
    return runs.where(ok).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def live_or_best(runs: DataFrame, metric: str | None, maximize: bool, now: Column,
                 ttl_seconds: int = 3600, by: list[str] | None = None) -> DataFrame:
    """Newest running run updated within the TTL, else the best finished one."""
    live = (F.col("status") == "RUNNING") & \
        (F.unix_micros(now.cast("timestamp")) -
         F.unix_micros(F.col("updated_at").cast("timestamp")) <= ttl_seconds * 1_000_000)
    done = (F.col("status") == "FINISHED") & F.col("has_artifact")
    value = _metric(runs, metric)
    signed = value if maximize else -value
    order = [F.when(live, 0).otherwise(1),
             F.when(live, None).otherwise(signed).desc_nulls_last(), F.col("start_time").desc(),
             F.col("run_id")]
    found = runs.where(live | done).withColumn("source", F.when(live, "live").otherwise("best"))
    if not by:
        return found.orderBy(*order).limit(1)
    w = Window.partitionBy(*by).orderBy(*order)
    return found.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def to_long(runs: DataFrame, run: str = "run_id", prefixes: tuple[str, ...] = ("metrics.", "params.")
            ) -> DataFrame:
    """Wide ``metrics.*`` and ``params.*`` columns to ``(run, kind, key, value)``, nulls dropped."""
    cells = []
    for prefix in prefixes:
        for c in runs.columns:
            if c.startswith(prefix):
                value = F.col(f"`{c}`")
                if isinstance(runs.schema[c].dataType, (T.DoubleType, T.FloatType)):
                    value = F.round(value, 4)
                cells.append(F.struct(F.lit(prefix.rstrip(".")).alias("kind"),
                                      F.lit(c[len(prefix):]).alias("key"),
                                      value.cast("string").alias("value")))
    return runs.select(run, F.explode(F.array(*cells)).alias("p")) \
        .select(run, "p.kind", "p.key", "p.value").where(F.col("value").isNotNull())


def baseline_delta(runs: DataFrame, metrics: list[str], parent: str = "parent_run_id",
                   run: str = "run_id") -> DataFrame:
    """Metrics of the run it continued from, and the change against them."""
    base = runs.select(F.col(run).alias("_base"),
                       *[F.col(m).alias(f"baseline_{m}") for m in metrics])
    return runs.join(base, F.col(parent) == F.col("_base"), "left").drop("_base").withColumns(
        {f"delta_{m}": F.col(m) - F.col(f"baseline_{m}") for m in metrics})


def metric_history(curves: DataFrame, run: str, step: str, metrics: list[str]) -> DataFrame:
    """Wide running metrics to ``(run_id, step, metric, value)`` rows for appending."""
    return curves.select(F.col(run).alias("run_id"), F.col(step).alias("step"),
                         F.explode(F.array(*[
                             F.struct(F.lit(m).alias("metric"),
                                      F.col(m).cast("double").alias("value"))
                             for m in metrics])).alias("p")) \
        .select("run_id", "step", "p.metric", "p.value").where(F.col("value").isNotNull())


def restore_offsets(commits: DataFrame, topic: str = "topic", partition: str = "partition",
                    offset: str = "last_offset") -> DataFrame:
    """Next offset to read per topic partition: the largest committed one + 1."""
    return commits.groupBy(topic, partition).agg((F.max(offset) + 1).alias("next_offset"))
