"""Online encoders, scalers, evaluation and clustering as micro-batch jobs.

The state of each operator is a log in the shared folder (``statelog``). A batch reads the state
written by the one before and replaces only its own run, so running a batch again after a failure
gives the same state; older runs are merged or dropped.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rtml.plans.prefix import row_numbers, with_chunk
from rtml.streaming.statelog import Files, StateLog


class OnlineDictionary:
    """First-seen codes kept across batches: learn the batch's new values, then encode its rows."""

    def __init__(self, spark: SparkSession, path: str, columns: list[str], order: str):
        self.columns, self.order = columns, order
        self.entries = StateLog(spark, f"{path}/dictionary",
                                "feature string, value string, code long")
        self.encoded_path = f"{path}/encoded"

    def learn(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Dictionary that includes the batch; only new distinct values are numbered."""
        known = self.entries.before(batch_id)
        found = batch.select(F.col(self.order).alias("_at"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
            for c in self.columns])).alias("p")) \
            .groupBy("p.feature", "p.value").agg(F.min("_at").alias("_at"))
        have = known.select(F.col("feature").alias("_f"), F.col("value").alias("_v"))
        new = found.join(have, (F.col("feature") == F.col("_f")) &
                         F.col("value").eqNullSafe(F.col("_v")), "left_anti")
        numbered = row_numbers(with_chunk(new, "_at"), ["feature"], ["_at", "value"])
        base = known.groupBy(F.col("feature").alias("_f")).agg((F.max("code") + 1).alias("_base"))
        fresh = numbered.join(base, F.col("feature") == F.col("_f"), "left").select(
            "feature", "value", (F.coalesce("_base", F.lit(0)) + F.col("rn") - 1)
            .cast("long").alias("code"))
        self.entries.write(fresh, batch_id)
        return self.entries.before(batch_id + 1)

    def encode(self, batch: DataFrame, dictionary: DataFrame) -> DataFrame:
        out = batch
        for c in self.columns:
            codes = dictionary.where(F.col("feature") == c).select(
                F.col("value").alias("_value"), F.col("code").alias(f"{c}_code"))
            out = out.join(codes, F.col(c).cast("string").eqNullSafe(F.col("_value")), "left") \
                .drop("_value")
        return out

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        dictionary = self.learn(batch, batch_id)
        self.encode(batch, dictionary).write.mode("overwrite") \
            .parquet(f"{self.encoded_path}/batch_id={batch_id}")


class OnlineScaler:
    """Running count, mean and squared deviations per feature, merged batch by batch."""

    SCHEMA = "feature string, n long, mean double, m2 double"

    def __init__(self, spark: SparkSession, path: str, columns: list[str]):
        self.columns = columns
        self.state = StateLog(spark, f"{path}/moments", self.SCHEMA, whole=True)
        self.scaled_path = f"{path}/scaled"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        long = batch.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
            for c in self.columns])).alias("p")).where("p.x is not null")
        now = long.groupBy("p.feature").agg(
            F.count("p.x").alias("n"), F.avg("p.x").alias("mean"),
            (F.var_pop("p.x") * F.count("p.x")).alias("m2"))
        parts = self.state.version(batch_id - 1).unionByName(now)
        total = parts.groupBy("feature").agg(
            F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
            F.sum("m2").alias("_in"), F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("_q"))
        merged = total.select("feature", "n", "mean", (F.col("_in") + F.greatest(
            F.lit(0.0), F.col("_q") - F.col("n") * F.col("mean") * F.col("mean"))).alias("m2"))
        self.state.write(merged, batch_id)
        stats = {r.feature: r for r in self.state.version(batch_id).collect()}  # one per feature
        out = batch
        for c in self.columns:
            s = stats.get(c)
            std = (s.m2 / s.n) ** 0.5 if s and s.n else 0.0
            out = out.withColumn(f"{c}_scaled", (F.col(c) - s.mean) / std if std > 0 else F.lit(0.0))
        out.write.mode("overwrite").parquet(f"{self.scaled_path}/batch_id={batch_id}")


class RunningMeanModel:
    """Predicts the mean target of the key over everything learned so far."""

    def __init__(self, key: str, target: str):
        self.key, self.target = key, target
        self.schema = "key string, n long, total double"

    def score(self, batch: DataFrame, state: DataFrame) -> DataFrame:
        # the state has one row per key; Spark checks its size before broadcasting
        means = state.select(F.col("key").alias("_key"), (F.col("total") / F.col("n")).alias("_m"))
        return batch.join(means, F.col(self.key).cast("string") == F.col("_key"), "left") \
            .withColumn("prediction", F.coalesce("_m", F.lit(0.0))).drop("_key", "_m")

    def update(self, state: DataFrame, batch: DataFrame) -> DataFrame:
        now = batch.groupBy(F.col(self.key).cast("string").alias("key")).agg(
            F.count(self.target).alias("n"), F.sum(self.target).alias("total"))
        return state.unionByName(now).groupBy("key").agg(F.sum("n").alias("n"),
                                                         F.sum("total").alias("total"))


class Prequential:
    """Evaluate and learn batch by batch, appending one metric row per batch.

    ``test_then_train`` scores with the model from before the batch; ``train_then_test`` learns the
    batch first (optimistic). Running errors continue over batches.
    """

    SCHEMA = "rows long, abs_error double, sq_error double, running_mae double, running_rmse double"

    def __init__(self, spark: SparkSession, path: str, model, order: str = "test_then_train"):
        if order not in ("test_then_train", "train_then_test"):
            raise ValueError(order)
        self.model, self.order = model, order
        self.state = StateLog(spark, f"{path}/model", model.schema, whole=True)
        self.metrics = StateLog(spark, f"{path}/metrics", self.SCHEMA)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self.state.version(batch_id - 1)
        self.state.write(self.model.update(before, batch), batch_id)
        used = before if self.order == "test_then_train" else self.state.version(batch_id)
        error = F.col(self.model.target) - F.col("prediction")
        one = self.model.score(batch, used).agg(
            F.count(error).alias("rows"), F.coalesce(F.sum(F.abs(error)), F.lit(0.0)).alias("abs_error"),
            F.coalesce(F.sum(error * error), F.lit(0.0)).alias("sq_error"))
        past = self.metrics.before(batch_id).agg(F.struct(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("n"),
            F.coalesce(F.sum("abs_error"), F.lit(0.0)).alias("a"),
            F.coalesce(F.sum("sq_error"), F.lit(0.0)).alias("q"))).scalar()
        rows = one.withColumn("_p", past).select(
            "rows", "abs_error", "sq_error",
            F.try_divide(F.col("abs_error") + F.col("_p.a"), F.col("rows") + F.col("_p.n"))
            .alias("running_mae"),
            F.sqrt(F.try_divide(F.col("sq_error") + F.col("_p.q"), F.col("rows") + F.col("_p.n")))
            .alias("running_rmse"))
        self.metrics.write(rows, batch_id)


class MicroClusters:
    """Density clustering of a stream on grid cells with fading weights.

    A cell sums the rows that fall in it; every batch fades all cells by 2^-fading and cells
    lighter than ``min_weight`` are removed every ``cleanup`` batches. The table holds one row per
    live cell, not per event.
    """

    SCHEMA = "cell array<int>, weight double, sums array<double>"

    def __init__(self, spark: SparkSession, path: str, vec: str, threshold: float = 1.5,
                 fading: float = 0.05, cleanup: int = 4, min_weight: float = 1.0):
        self.vec, self.threshold, self.fading = vec, threshold, fading
        self.cleanup, self.min_weight = cleanup, min_weight
        self.cells = StateLog(spark, f"{path}/cells", self.SCHEMA, whole=True)
        self.history = StateLog(spark, f"{path}/history",
                                "rows long, n_micro_clusters long, n_clusters long")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(F.col(self.vec).cast("array<double>").alias("_x"))
        now = rows.select(
            F.transform("_x", lambda x: F.floor(x / self.threshold).cast("int")).alias("cell"),
            F.lit(1.0).alias("weight"), array_to_vector("_x").alias("_v"))
        fade = 2.0 ** (-self.fading)
        old = self.cells.version(batch_id - 1).select(
            "cell", (F.col("weight") * fade).alias("weight"),
            array_to_vector(F.transform("sums", lambda s: s * fade)).alias("_v"))
        merged = old.unionByName(now).groupBy("cell").agg(
            F.sum("weight").alias("weight"),
            vector_to_array(Summarizer.sum(F.col("_v"))).alias("sums"))
        if (batch_id + 1) % self.cleanup == 0:
            merged = merged.where(F.col("weight") >= self.min_weight)
        self.cells.write(merged, batch_id)
        size = rows.agg(F.count(F.lit(1))).scalar()
        self.history.write(self.cells.version(batch_id).agg(
            F.count(F.lit(1)).alias("n_micro_clusters"),
            F.count_if(F.col("weight") >= self.min_weight).alias("n_clusters"))
            .select(size.alias("rows"), "n_micro_clusters", "n_clusters"), batch_id)

    def centers(self, batch_id: int) -> DataFrame:
        return self.cells.version(batch_id).select(
            "weight", F.expr("transform(sums, s -> s / weight)").alias("center"))

    def macro_clusters(self, batch_id: int, k: int, seed: int = 42):
        """Weighted k-means over the cells."""
        cells = self.centers(batch_id).withColumn("features", array_to_vector("center"))
        return KMeans(k=k, weightCol="weight", seed=seed, predictionCol="cluster").fit(cells)


class WindowedForest:
    """Refits a forest on the newest rows every ``refit_every`` batches and keeps the current one.

    ``build()`` makes the estimator; ``window_rows`` bounds the training set by order column.
    """

    def __init__(self, spark: SparkSession, path: str, build: Callable[[], object], columns: str,
                 order: str, window_rows: int = 100_000, refit_every: int = 5):
        self.spark, self.build, self.order = spark, build, order
        self.window_rows, self.refit_every = window_rows, refit_every
        self.recent = StateLog(spark, f"{path}/recent", columns, whole=True)
        self.model, self.models_path, self.refits = None, f"{path}/models", 0
        self.saved = StateLog(spark, f"{path}/saved", "fitted_at long, kind string", whole=True)

    def _restore(self, batch_id: int) -> None:
        """The newest model saved before this batch, after a restart."""
        last = self.saved.version(batch_id - 1).first()
        if last is not None:
            module, name = last.kind.rsplit(":", 1)
            kind = getattr(importlib.import_module(module), name)
            self.model = kind.load(f"{self.models_path}/batch_id={last.fitted_at}")

    def __call__(self, batch: DataFrame, batch_id: int, drift: bool = False) -> None:
        held = self.recent.version(batch_id - 1).unionByName(
            batch.select(*self.recent.version(-1).columns))
        newest = held.orderBy(F.col(self.order).desc()).limit(self.window_rows)
        self.recent.write(newest, batch_id)
        if self.model is None:
            self._restore(batch_id)
        now = self.saved.version(batch_id - 1)
        if self.model is None or drift or (batch_id + 1) % self.refit_every == 0:
            self.model = self.build().fit(self.recent.version(batch_id))
            self.model.write().overwrite().save(f"{self.models_path}/batch_id={batch_id}")
            kind = f"{type(self.model).__module__}:{type(self.model).__name__}"
            now = batch.sparkSession.createDataFrame([(batch_id, kind)], now.schema)
            self.refits += 1
        self.saved.write(now, batch_id)
        self._forget()

    def _forget(self) -> None:
        """Remove models that no kept version names."""
        named = {f"batch_id={r.fitted_at}" for r in self.saved.all().select("fitted_at").collect()}
        files = Files(self.spark, self.models_path)
        for name in files.names():
            if name not in named:
                files.drop(name)


def run_batches(stream: DataFrame, step: Callable[[DataFrame, int], None],
                checkpoint: str, once: bool = True) -> StreamingQuery:
    """Drive any of the operators above over a stream; each batch is read once."""
    def persisted(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            step(batch, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(persisted)
    return (writer.trigger(availableNow=True) if once else writer).start()
