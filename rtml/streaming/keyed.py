"""Encoder and scaler state kept by key in the state store, with time to live and a state reader.

What reaches the state is already reduced: every Arrow batch of the input sends one row per distinct
value (with the ids of its rows) or one row of moments per feature, so a value or feature with a third
of all rows is no hot key. State is read and written by key; no earlier output is read again.
"""

from __future__ import annotations

import sys
import tempfile

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_CODES = "feature string, value string, code long, ids array<long>"
#: Bytes of waiting row ids in memory, beyond which they go to a temporary file of the task; 16 a row.
_WAITING = 32 << 20
_READ = 1 << 20  # of them read back at a time: 65,536 rows
_NULL = "n"  # other values are written with a leading v

# Spark also starts a processor in a helper of the driver, which does not get the shipped package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def split_of(feature: Column, value: Column, splits: int) -> Column:
    """Part of a dictionary that holds a value; a function of the value alone."""
    text = F.concat_ws("", F.lit("v"), value)
    return F.pmod(F.conv(F.substring(F.md5(F.when(value.isNull(), _NULL).otherwise(text)), 1, 8),
                         16, 10).cast("long"), F.lit(splits)).cast("int")


class CodeBook(StatefulProcessor):
    """First-seen codes of one part of one feature's dictionary.

    Values are numbered in the order of their first row; code = number * splits + part, so one part
    gives the plain codes 0, 1, 2, .. and more parts give codes that are unique but have gaps.
    """

    def __init__(self, splits: int, ttl_ms: int | None):
        self.splits, self.ttl = splits, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.codes = handle.getMapState("codes", "value string", "code long", self.ttl)
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timers):
        feature, part = key[0], int(key[1])
        n = self.count.get()[0] if self.count.exists() else 0
        known, fresh = {}, {}  # of new values: their place among them and their first row
        with tempfile.SpooledTemporaryFile(_WAITING) as waiting:
            for frame in rows:
                hit, held = [], []
                for value, at, ids in zip(frame["value"], frame["at"], frame["ids"]):
                    name = (_NULL,) if pd.isna(value) else (f"v{value}",)
                    if name not in known and name not in fresh and self.codes.containsKey(name):
                        known[name] = self.codes.getValue(name)[0]
                        if self.ttl:  # seen again: starts its time to live afresh
                            self.codes.updateValue(name, (known[name],))
                    if name in known:
                        hit.append((feature, name[0], known[name], ids))
                    else:
                        place, first = fresh.get(name, (len(fresh), at))
                        fresh[name] = place, min(first, at)
                        ids = np.asarray(ids, dtype=np.int64)
                        held.append(np.column_stack([np.full(len(ids), place, dtype=np.int64), ids]))
                if held:
                    waiting.write(np.concatenate(held).tobytes())
                yield self._frame(hit)
            codes = np.empty(len(fresh), dtype=np.int64)
            for name in sorted(fresh, key=lambda v: (fresh[v][1], v)):
                codes[fresh[name][0]] = n * self.splits + part
                self.codes.updateValue(name, (n * self.splits + part,))
                n += 1
            self.count.update((n,))
            yield from self._waited(feature, [name[0] for name in fresh], codes, waiting)

    def _waited(self, feature: str, names: list[str], codes: np.ndarray, waiting):
        """Frames of the rows that waited for their values' codes, a part of them at a time."""
        waiting.seek(0)
        while part := waiting.read(_READ):
            pairs = np.frombuffer(part, dtype=np.int64).reshape(-1, 2)
            pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
            places, starts = np.unique(pairs[:, 0], return_index=True)
            yield self._frame([(feature, names[p], codes[p], ids.tolist()) for p, ids in
                               zip(places, np.split(pairs[:, 1], starts[1:]))])

    @staticmethod
    def _frame(rows: list) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["feature", "value", "code", "ids"], dtype=object)
        out["value"] = pd.Series([None if v == _NULL else v[1:] for v in out["value"]], dtype=object)
        return out.astype({"code": "int64"})

    def close(self) -> None:
        pass


def _packed(columns: list[str]):
    """Per Arrow batch and feature, one row per distinct value with its first order and row ids."""
    def run(batches):
        for batch in batches:
            frame = batch.to_pandas()
            parts = []
            for c in columns:
                got = frame.groupby(c, dropna=False, sort=False).agg(
                    at=("_at", "min"), ids=("_id", list)).reset_index(names="value")
                parts.append(got.assign(feature=c))
            out = pd.concat(parts) if parts else pd.DataFrame()
            out["value"] = out["value"].astype(object).where(out["value"].notna(), None)
            yield from pa_batches(out[["feature", "value", "at", "ids"]])
    return run


def pa_batches(frame: pd.DataFrame):
    import pyarrow as pa
    kind = pa.schema([("feature", pa.string()), ("value", pa.string()), ("at", pa.int64()),
                      ("ids", pa.list_(pa.int64()))])
    yield pa.RecordBatch.from_pandas(frame, schema=kind, preserve_index=False)


def encode_stream(stream: DataFrame, columns: list[str], row_id: str, order: str | None = None,
                  splits: int = 1, ttl_ms: int | None = None) -> DataFrame:
    """Codes of a stream's values: rows ``feature, value, code, ids`` (ids of the rows that hold it).

    A batch first learns its new values in the order of ``order`` (default: the row id; a whole
    number), then codes all of its rows. With a time to live a value that was not seen for so long is
    forgotten and gets a new code, never one that was in use before; Spark then runs batches without
    rows as well, so such a query needs a trigger by time and is ended by ``stop``.
    """
    kept = stream.select(F.col(row_id).cast("long").alias("_id"),
                         F.col(order or row_id).cast("long").alias("_at"),
                         *[F.col(c).cast("string").alias(c) for c in columns])
    reduced = kept.mapInArrow(_packed(columns), "feature string, value string, at long, ids array<long>") \
        .withColumn("part", split_of(F.col("feature"), F.col("value"), splits))
    mode = "ProcessingTime" if ttl_ms else "None"
    return reduced.groupBy("feature", "part").transformWithStateInPandas(
        CodeBook(splits, ttl_ms), _CODES, "Update", mode)


def coded_rows(codes: DataFrame, columns: list[str]) -> DataFrame:
    """One row per row id with ``<column>_code`` from the output of one batch of ``encode_stream``."""
    return codes.select("feature", "code", F.explode("ids").alias("row_id")).groupBy("row_id").agg(*[
        F.max(F.when(F.col("feature") == c, F.col("code"))).alias(f"{c}_code") for c in columns])


def first_seen_codes_split(df: DataFrame, column: str, order: str, splits: int = 1) -> DataFrame:
    """Batch twin of ``encode_stream`` for one column: ``value, code`` of a whole table."""
    from rtml.plans.prefix import row_numbers, with_chunk
    value = F.col(column).cast("string")
    first = df.groupBy(value.alias("value")).agg(F.min(F.col(order).cast("long")).alias("_at")) \
        .withColumn("part", split_of(F.lit(column), F.col("value"), splits))
    numbered = row_numbers(with_chunk(first, "_at"), ["part"],
                           ["_at", F.col("value").asc_nulls_first()])
    return numbered.select("value", ((F.col("rn") - 1) * splits + F.col("part")).alias("code"))


class Moments(StatefulProcessor):
    """Running count, mean, squared deviations, least and greatest of one feature."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(
            "moments", "n long, mean double, m2 double, low double, high double")

    def handleInputRows(self, key, rows, timers):
        n, mean, m2, low, high = self.state.get() if self.state.exists() else \
            (0, 0.0, 0.0, float("inf"), float("-inf"))
        for frame in rows:
            for k, m, q, a, b in zip(frame["n"], frame["mean"], frame["m2"], frame["low"],
                                     frame["high"]):
                gap, total = m - mean, n + k
                mean, m2 = mean + gap * k / total, m2 + q + gap * gap * n * k / total
                n, low, high = total, min(low, a), max(high, b)
        self.state.update((int(n), float(mean), float(m2), float(low), float(high)))
        yield pd.DataFrame({"feature": pd.Series([key[0]], dtype=object), "n": [n], "mean": [mean], "m2": [m2],
                            "low": [low], "high": [high]})

    def close(self) -> None:
        pass


def _reduced_moments(columns: list[str]):
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            frame = batch.to_pandas()
            rows = []
            for c in columns:
                x = frame[c].to_numpy(float)
                x = x[np.isfinite(x)]
                if len(x):
                    rows.append((c, len(x), x.mean(), ((x - x.mean()) ** 2).sum(), x.min(), x.max()))
            yield pa.RecordBatch.from_pandas(
                pd.DataFrame(rows, columns=["feature", "n", "mean", "m2", "low", "high"]),
                schema=pa.schema([("feature", pa.string()), ("n", pa.int64())] + [
                    (c, pa.float64()) for c in ("mean", "m2", "low", "high")]),
                preserve_index=False)
    return run


def moments_stream(stream: DataFrame, columns: list[str]) -> DataFrame:
    """Running moments per feature after every batch; values that are null or not finite are left
    out."""
    kind = "feature string, n long, mean double, m2 double, low double, high double"
    return stream.select(*[F.col(c).cast("double").alias(c) for c in columns]) \
        .mapInArrow(_reduced_moments(columns), kind).groupBy("feature") \
        .transformWithStateInPandas(Moments(), kind, "Update", "None")


def state_table(spark: SparkSession, checkpoint: str, name: str, batch_id: int | None = None
                ) -> DataFrame:
    """Contents of a state variable, by default after the last committed batch.

    ``codes``: ``feature, value, code``; ``moments``: ``feature`` and the moments.
    """
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    rows = reader.load()
    if name == "codes":
        value = F.col("user_map_key.value")
        # a variable with time to live wraps its value together with the time it ends
        code = "user_map_value.value.code" if "ttlExpirationMs" in \
            rows.schema["user_map_value"].dataType.fieldNames() else "user_map_value.code"
        return rows.select("key.feature", F.when(value != _NULL, F.substring(value, 2, 1 << 30))
                           .alias("value"), F.col(code).alias("code"))
    return rows.select("key.feature", "value.*")
