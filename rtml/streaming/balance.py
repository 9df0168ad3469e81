"""Class balancing in a stream: running class counts decide how many rows of a batch are accepted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rtml.plans.prefix import row_numbers, with_chunk
from rtml.session import ensure_checkpoint_dir
from rtml.streaming.statelog import StateLog


class BalancedStream:
    """Accepts rows so that the classes' accepted rows approach the wanted shares.

    State: rows seen and accepted per class. After every batch the rarest class (by its rows seen
    over its wanted share) has been accepted whole and sets how many rows of the others may be; what
    a class lacks is taken from the batch by the order of a hash of ``key``, never from earlier
    batches. Same batches give the same rows, also after a restart or when a batch is run again.
    ``shares`` maps classes to wanted shares (others are left out); default: equal shares of the
    classes seen so far. Rows without a label are left out.
    """

    SCHEMA = "label string, seen long, accepted long"

    def __init__(self, spark: SparkSession, path: str, label: str, key: str,
                 shares: dict[str, float] | None = None):
        ensure_checkpoint_dir(spark)
        self.spark, self.label, self.key, self.shares = spark, label, key, shares
        self.state = StateLog(spark, f"{path}/classes", self.SCHEMA, whole=True)
        self.accepted_path = f"{path}/accepted"

    def quotas(self, counts: dict[str, int], state: dict[str, tuple[int, int]]) -> dict[str, int]:
        """Rows to accept per class; one entry per class."""
        classes = sorted({*counts, *state} if self.shares is None else self.shares)
        share = self.shares or {c: 1 / len(classes) for c in classes}
        seen = {c: state.get(c, (0, 0))[0] + counts.get(c, 0) for c in classes}
        scale = min((seen[c] / share[c] for c in classes if share[c] > 0), default=0)
        out = {}
        for c in classes:
            wanted = int(share[c] * scale + 1e-9) - state.get(c, (0, 0))[1]
            out[c] = min(max(wanted, 0), counts.get(c, 0))
        return out

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        label = F.col(self.label).cast("string")
        rows = batch.where(label.isNotNull())
        counts = {r.label: r["count"] for r in rows.groupBy(label.alias("label")).count().collect()}
        state = {r.label: (r.seen, r.accepted) for r in self.state.version(batch_id - 1).collect()}
        quota = self.quotas(counts, state)
        most = F.lit(0)
        for c, n in quota.items():
            most = F.when(label == c, F.lit(n)).otherwise(most)
        drawn = rows.withColumn("_lot", F.xxhash64(self.key)).withColumn("_class", label)
        ranked = row_numbers(with_chunk(drawn, "_lot"), ["_class"], ["_lot", self.key], out="_rank")
        ranked.where(F.col("_rank") <= most).drop("_lot", "_class", "_rank") \
            .write.mode("overwrite").parquet(f"{self.accepted_path}/batch_id={batch_id}")
        now = [(c, state.get(c, (0, 0))[0] + counts.get(c, 0),
                state.get(c, (0, 0))[1] + quota.get(c, 0)) for c in {*counts, *state}]
        self.state.write(self.spark.createDataFrame(now, self.SCHEMA), batch_id)

    def report(self, batch_id: int) -> DataFrame:
        """``label, seen, accepted, share`` of all accepted rows after a batch."""
        now = self.state.version(batch_id)
        total = now.agg(F.sum("accepted")).scalar()
        return now.withColumn("share", F.try_divide(F.col("accepted").cast("double"), total))
