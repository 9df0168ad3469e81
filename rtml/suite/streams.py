"""Streaming operators run to completion over the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rtml.session import scratch_path
from rtml.sources.ingest import Topic, after_offset, append_sink, decode, event_stream, \
    read_quarantine, read_table, start_ingest, table_or_topic
from rtml.sources.snapshots import read_snapshot, write_snapshot
from rtml.streaming import drift as D, keyed as K, online as O, windows as W
from rtml.streaming.bagging import BaggedForest, bag_weight, poisson_cdf
from rtml.streaming.balance import BalancedStream
from rtml.streaming.density import DensityClusters
from rtml.streaming.forecast import SeriesForecaster
from rtml.suite.base import Tables, query
from rtml.suite.roles import event_key

#: Rows of one file of a slice.
_FILE_ROWS = 250_000


def _stream(t: Tables, name: str = "events") -> DataFrame:
    """The table as a stream of its file."""
    shape = t.spark.read.parquet(f"{t.folder}/{name}.parquet").schema
    return t.spark.readStream.schema(shape).option("pathGlobFilter", f"{name}.parquet") \
        .parquet(t.folder)


def _sliced_stream(t: Tables, name: str, order: str, parts: int = 4) -> DataFrame:
    """The table rewritten as ordered slices, one slice per micro-batch."""
    path = scratch_path(t.spark, f"slices-{name}")
    df = getattr(t, name)
    df.repartitionByRange(parts, order).write.parquet(path)
    return t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _in_slices(t: Tables, rows: DataFrame, order: str, parts: int = 4):
    """A stream of ``rows`` that grows slice by slice in ``order``: yields it after every second one.

    Whoever runs a query to its end at every yield restarts it from its checkpoint. A slice is one
    micro-batch. All slices have the same number of files, one for every ``_FILE_ROWS`` rows of the
    smallest: dealt in turn, no file of so many rows can be empty, which Spark would not write.
    """
    path = scratch_path(t.spark, "slices")
    cuts = rows.approxQuantile(order, [i / parts for i in range(1, parts)], 0.01)
    inside = [(F.col(order) > low) & (F.col(order) <= high)
              for low, high in zip([float("-inf"), *cuts], [*cuts, float("inf")])]
    fewest = min(rows.agg(*[F.count_if(c) for c in inside]).first())
    files = max(1, fewest // _FILE_ROWS)
    stream = None
    for i, condition in enumerate(inside):
        part = rows.where(condition)
        (part.repartition(files) if files > 1 else part.coalesce(1)).write.mode("append").parquet(path)
        if i % 2 or i == parts - 1:
            stream = stream or t.spark.readStream.schema(rows.schema) \
                .option("maxFilesPerTrigger", files).parquet(path)
            yield stream


def _keyed_run(t: Tables, rows: DataFrame, order: str, build, finish=lambda batch: batch) -> str:
    """Run a keyed stream over four slices with a restart; the folder of its output and checkpoint."""
    root = scratch_path(t.spark, "keyed")

    def write(batch: DataFrame, batch_id: int) -> None:
        finish(batch).write.mode("overwrite").parquet(f"{root}/table/batch_id={batch_id}")

    t.spark.conf.set(*D.STATE_STORE)
    for stream in _in_slices(t, rows, order):
        build(stream).writeStream.outputMode("update").trigger(availableNow=True) \
            .option("checkpointLocation", f"{root}/checkpoint").foreachBatch(write) \
            .start().awaitTermination()
    return root


@query("stream_ingest_roundtrip", """SELECT event_id, event_type, value, user_id FROM events""",
       d="value", digits=2)
def stream_ingest_roundtrip(t):
    """Events as JSON lines, ingested exactly once into a table."""
    root = scratch_path(t.spark, "ingest")
    t.events.select(F.to_json(F.struct("event_id", "event_type", "value", "user_id"))
                    .alias("value")).write.text(f"{root}/topic")
    topic = Topic("events", "event_id bigint, event_type string, value double, user_id bigint",
                  f"{root}/table", f"{root}/checkpoint", folder=f"{root}/topic")
    rows = decode(event_stream(t.spark, topic), topic.schema).drop("_corrupt")
    append_sink(rows, topic.path, topic.checkpoint, once=True).awaitTermination()
    return t.spark.read.parquet(topic.path)


@query("multi_topic_ingest", """SELECT 'events' AS topic, CASE WHEN event_id % 50 = 0 THEN 'unreadable' ELSE 'ok'
 END AS record, count(*) AS n, sum(CASE WHEN event_id % 50 <> 0 THEN user_id END)::BIGINT AS total
 FROM events GROUP BY 1, 2 UNION ALL SELECT 'orders', CASE WHEN o_orderkey % 40 = 0 THEN 'unreadable'
 ELSE 'ok' END, count(*), sum(CASE WHEN o_orderkey % 40 <> 0 THEN o_custkey END)::BIGINT
 FROM orders GROUP BY 1, 2""")
def multi_topic_ingest(t):
    """Two topics at a time, each read once; broken records are kept beside the others."""
    root = scratch_path(t.spark, "topics")
    sources = {"events": (t.events, "event_id", "user_id", 50),
               "orders": (t.orders, "o_orderkey", "o_custkey", 40)}
    topics = []
    for name, (df, key, value, every) in sources.items():
        text = F.to_json(F.struct(key, value))
        df.select(F.when(F.col(key) % every == 0, F.concat(F.lit("{"), text)).otherwise(text)
                  .alias("value")).write.text(f"{root}/in/{name}")
        topics.append(Topic(name, f"{key} bigint, {value} bigint", f"{root}/{name}",
                            f"{root}/checkpoints/{name}", folder=f"{root}/in/{name}"))
    for q in start_ingest(t.spark, topics, once=True):
        q.awaitTermination()
    parts = []
    for topic in topics:
        value = sources[topic.name][2]
        for kind, rows in (("ok", read_table(t.spark, topic.path).select(value)),
                           ("unreadable", read_quarantine(t.spark, topic.path)
                            .select(F.lit(None).cast("long").alias(value)))):
            parts.append(rows.groupBy(F.lit(topic.name).alias("topic"), F.lit(kind).alias("record"))
                         .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("table_or_topic", """SELECT 'table' AS origin, count(*) AS n, min(user_id) AS lowest FROM events
 UNION ALL SELECT 'topic', 1, min(user_id) FROM events""")
def table_or_topic_rows(t):
    """The table where it exists; before that, one event of the topic (here the lowest user's)."""
    root = scratch_path(t.spark, "fallback")
    lowest = t.events.orderBy("user_id", "event_id").limit(1)
    rows = t.events.select("event_id", "user_id")
    lowest.select(F.to_json(F.struct("event_id", "user_id")).alias("value")).write.text(f"{root}/in")
    rows.write.parquet(f"{root}/table")
    out = []
    for origin, path in (("table", f"{root}/table"), ("topic", f"{root}/not-yet")):
        topic = Topic("events", "event_id bigint, user_id bigint", path, "", folder=f"{root}/in")
        out.append(table_or_topic(t.spark, topic).groupBy(F.lit(origin).alias("origin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("user_id").alias("lowest")))
    return out[0].unionByName(out[1])


@query("offset_replay", """SELECT event_id, event_type, user_id FROM events
 WHERE event_id > (SELECT max(event_id) // 2 FROM events)""")
def offset_replay(t):
    """Records after the last one that a run had processed: half of them here."""
    last = t.events.agg(F.floor(F.max("event_id") / 2)).first()[0]
    return after_offset(t.events, "event_id", last).select("event_id", "event_type", "user_id")


@query("stream_window_counts", """SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S')
 AS window_start, event_type, count(*) AS n FROM events, (SELECT max(ts) AS newest FROM events)
 WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= newest - INTERVAL 10 MINUTES
 GROUP BY 1, 2""")
def stream_window_counts(t):
    """Windows that the watermark has closed."""
    root = scratch_path(t.spark, "windows")
    counts = W.windowed_counts(_stream(t), "ts", ["event_type"], "1 hour")
    W.append_table(counts, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{root}/table").select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "event_type", "n")


@query("stream_cluster_counts", """SELECT event_type AS cluster, 'k' AS feature, props->>'k' AS value,
 count(*) AS n FROM events GROUP BY 1, 3""")
def stream_cluster_counts(t):
    """Counters kept in the state store, read from the last complete result."""
    root = scratch_path(t.spark, "counters")
    rows = event_key(_stream(t)).select(F.col("event_type").alias("cluster"), F.lit("k")
                                        .alias("feature"), F.col("k").cast("string").alias("value"))
    counts = rows.groupBy("cluster", "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    W.latest_table(counts, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return W.read_latest(t.spark, f"{root}/table")


@query("stream_first_seen_codes", """SELECT event_id, dense_rank() OVER (ORDER BY f) - 1 AS event_type_code,
 dense_rank() OVER (ORDER BY g) - 1 AS user_id_code FROM (SELECT event_id, min(event_id) OVER
 (PARTITION BY event_type) AS f, min(event_id) OVER (PARTITION BY user_id) AS g FROM events)""")
def stream_first_seen_codes(t):
    root = scratch_path(t.spark, "codes")
    rows = _stream(t).select("event_id", "event_type", "user_id")
    encoder = O.OnlineDictionary(t.spark, root, ["event_type", "user_id"], "event_id")
    O.run_batches(rows, encoder, f"{root}/checkpoint").awaitTermination()
    return t.spark.read.parquet(encoder.encoded_path) \
        .select("event_id", "event_type_code", "user_id_code")


@query("stream_keyed_codes", """SELECT event_id AS row_id, dense_rank() OVER (ORDER BY f) - 1 AS event_type_code,
 dense_rank() OVER (ORDER BY g) - 1 AS user_id_code FROM (SELECT event_id, min(event_id) OVER
 (PARTITION BY event_type) AS f, min(event_id) OVER (PARTITION BY user_id) AS g FROM events)""")
def stream_keyed_codes(t):
    """Dictionaries in keyed state over four batches and a restart; equal to the batch codes."""
    columns = ["event_type", "user_id"]
    root = _keyed_run(t, t.events.select("event_id", *columns), "event_id",
                      lambda s: K.encode_stream(s, columns, "event_id"),
                      lambda codes: K.coded_rows(codes, columns))
    return t.spark.read.parquet(f"{root}/table").select("row_id", "event_type_code", "user_id_code")


@query("stream_keyed_dictionary", """SELECT 'user_id' AS feature, user_id::VARCHAR AS value,
 (row_number() OVER (PARTITION BY part ORDER BY f) - 1) * 4 + part AS code FROM (SELECT user_id,
 min(event_id) AS f, ('0x' || substr(md5('v' || user_id), 1, 8))::BIGINT % 4 AS part
 FROM events GROUP BY user_id)""")
def stream_keyed_dictionary(t):
    """A dictionary split four ways by value hash, read back from the state store."""
    root = _keyed_run(t, t.events.select("event_id", "user_id"), "event_id",
                      lambda s: K.encode_stream(s, ["user_id"], "event_id", splits=4))
    return K.state_table(t.spark, f"{root}/checkpoint", "codes")


@query("stream_keyed_moments", """SELECT event_type AS feature, count(value) AS n, avg(value) AS mean,
 var_pop(value) AS variance, min(value) AS low, max(value) AS high FROM (SELECT 'value' AS event_type,
 value FROM events UNION ALL SELECT 'user_id', user_id FROM events) GROUP BY 1""",
       d="mean variance low high", digits=4)
def stream_keyed_moments(t):
    """Scaler state per feature after four batches and a restart."""
    root = _keyed_run(t, t.events.select("event_id", "value", "user_id"), "event_id",
                      lambda s: K.moments_stream(s, ["value", "user_id"]))
    return K.state_table(t.spark, f"{root}/checkpoint", "moments").select(
        "feature", "n", "mean", (F.col("m2") / F.col("n")).alias("variance"), "low", "high")


@query("stream_scaler_state", """SELECT 'value' AS feature, count(value) AS n, avg(value) AS mean,
 var_pop(value) AS variance FROM events""", d="mean variance", digits=4)
def stream_scaler_state(t):
    root = scratch_path(t.spark, "scaler")
    scaler = O.OnlineScaler(t.spark, root, ["value"])
    stream = _sliced_stream(t, "events", "event_id").select("event_id", "value")
    O.run_batches(stream, scaler, f"{root}/checkpoint").awaitTermination()
    last = scaler.state.all().where(F.col("batch_id") == scaler.state.all()
                                    .agg(F.max("batch_id")).scalar())
    return last.select("feature", "n", "mean", (F.col("m2") / F.col("n")).alias("variance"))


@query("stream_prequential")
def stream_prequential(t):
    """Batch boundaries decide the scores, so only their shape is comparable."""
    root = scratch_path(t.spark, "prequential")
    step = O.Prequential(t.spark, root, O.RunningMeanModel("event_type", "value"))
    stream = _sliced_stream(t, "events", "event_id").select("event_id", "event_type", "value")
    O.run_batches(stream, step, f"{root}/checkpoint").awaitTermination()
    return step.metrics.all().where("batch_id >= 0")


_LAGGED = """SELECT series, y, lag(y) OVER w AS p, lag(y, 2) OVER w AS q FROM (SELECT event_type AS series,
 event_id, (props->>'k')::DOUBLE AS y FROM events) e WINDOW w AS (PARTITION BY series ORDER BY event_id)"""


@query("stream_forecast_coefficients", f"""SELECT series, n, my - b1 * mp - b2 * mq AS c0, b1 AS c1, b2 AS c2
 FROM (SELECT *, (qq * py - pq * qy) / (pp * qq - pq * pq) AS b1,
 (pp * qy - pq * py) / (pp * qq - pq * pq) AS b2 FROM (SELECT series, count(*) AS n, avg(y) AS my,
 avg(p) AS mp, avg(q) AS mq, var_pop(p) AS pp, var_pop(q) AS qq, covar_pop(p, q) AS pq,
 covar_pop(p, y) AS py, covar_pop(q, y) AS qy FROM ({_LAGGED}) l WHERE q IS NOT NULL GROUP BY series) s) t""",
       d="c0 c1 c2", digits=5)
def stream_forecast_coefficients(t):
    """Two-lag autoregression per event type after four batches and a restart: least squares."""
    root = scratch_path(t.spark, "forecast")
    rows = event_key(t.events).select("event_id", "event_type", F.col("k").cast("double").alias("y"))
    for stream in _in_slices(t, rows, "event_id"):
        step = SeriesForecaster(t.spark, root, "event_type", "event_id", "y", lags=(1, 2))
        O.run_batches(stream, step, f"{root}/checkpoint").awaitTermination()
    fitted = step.coefficients(step.moments.latest())
    return fitted.select("series", F.col("n").cast("long").alias("n"), *[
        F.get("coefficients", F.lit(i)).alias(f"c{i}") for i in range(3)])


@query("stream_balanced_classes", """SELECT label, min(seen) OVER () AS accepted, seen FROM (
 SELECT CASE WHEN event_type = 'purchase' THEN 'buy' ELSE 'other' END AS label, count(*) AS seen
 FROM events GROUP BY 1) s""")
def stream_balanced_classes(t):
    """Accepted rows per class after four batches: the rarer class whole, the other as many."""
    root = scratch_path(t.spark, "balanced")
    rows = t.events.select("event_id", F.when(F.col("event_type") == "purchase", "buy")
                           .otherwise("other").alias("label"))
    for stream in _in_slices(t, rows, "event_id"):
        step = BalancedStream(t.spark, root, "label", "event_id")
        O.run_batches(stream, step, f"{root}/checkpoint").awaitTermination()
    kept = t.spark.read.parquet(step.accepted_path).groupBy("label") \
        .agg(F.count(F.lit(1)).alias("accepted"))
    return kept.join(step.report(step.state.latest()).select("label", "seen"), "label")


@query("stream_density_clusters")
def stream_density_clusters(t):
    """Embeddings in four batches; batch order decides the centers, so only invariants are checked."""
    root = scratch_path(t.spark, "density")
    dims = t.embeddings.agg(F.max(F.size("embedding"))).first()[0] or 1
    step = DensityClusters(t.spark, root, "embedding", radius=0.8, dims=dims, intersection=0.3)
    stream = _sliced_stream(t, "embeddings", "vec_id").select("vec_id", "embedding")
    O.run_batches(stream, step, f"{root}/checkpoint").awaitTermination()
    return step.assign(t.embeddings.select("vec_id", "embedding"), step.centers.latest()) \
        .select("vec_id", "cluster")


_UNIT = "('0x' || substr(md5(event_id::VARCHAR || ':' || tree), 1, 8))::BIGINT / 4294967296.0"


@query("bagging_weights", f"""SELECT tree, count(*) AS n_rows, sum(w) AS total,
 count(*) FILTER (WHERE w = 0) AS left_out FROM (SELECT tree,
 {' + '.join(f"(CASE WHEN {p!r}::DOUBLE <= u THEN 1 ELSE 0 END)" for p in poisson_cdf())} AS w
 FROM (SELECT tree, ({_UNIT})::DOUBLE AS u FROM events, unnest([0, 1, 2]) AS t(tree)) a) b
 GROUP BY tree""", i="tree n_rows total left_out")
def bagging_weights(t):
    """Poisson weights of all events for three trees of a bagged forest."""
    weights = t.events.select(F.posexplode(F.array(*[bag_weight("event_id", k) for k in range(3)]))
                              .alias("tree", "w"))
    return weights.groupBy("tree").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("w").alias("total"),
                                       F.count_if(F.col("w") == 0).alias("left_out"))


@query("stream_bagged_forest")
def stream_bagged_forest(t):
    """Events in four batches through a bagged forest: per batch, rows scored before training on
    them, wrong ones, and trees that were replaced or grown on."""
    root = scratch_path(t.spark, "bagging")
    rows = t.events.select("event_id", F.coalesce("value", F.lit(0.0)).alias("value"),
                           F.pmod("user_id", F.lit(97)).alias("user"),
                           (F.col("event_type") == "purchase").cast("int").alias("bought"))
    for stream in _in_slices(t, rows, "event_id"):
        step = BaggedForest(t.spark, root, ["value", "user"], "bought", "event_id", trees=4, depth=3)
        O.run_batches(stream, step, f"{root}/checkpoint").awaitTermination()
    return step.metrics.all().select("batch_id", "rows", "errors",
                                     F.size("replaced").alias("n_replaced"),
                                     F.size("grown").alias("n_grown"))


@query("stream_drift")
def stream_drift(t):
    root = scratch_path(t.spark, "drift")
    t.spark.conf.set(*D.STATE_STORE)
    rows = event_key(_stream(t)).select("event_type", "event_id",
                                        F.abs(F.col("value") - F.col("k")).alias("error"))
    found = D.detect_drift(rows, "event_type", "event_id", "error")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/table/batch_id={batch_id}")

    found.writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint") \
        .trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    return t.spark.read.parquet(f"{root}/table")


@query("stream_micro_clusters")
def stream_micro_clusters(t):
    root = scratch_path(t.spark, "cells")
    clusters = O.MicroClusters(t.spark, root, "embedding", threshold=0.1)
    stream = _sliced_stream(t, "embeddings", "vec_id").select("vec_id", "embedding")
    O.run_batches(stream, clusters, f"{root}/checkpoint").awaitTermination()
    return clusters.history.all().where("batch_id >= 0")


@query("snapshot_roundtrip", """SELECT split, count(*) AS rows, sum(event_id) AS id_sum FROM (SELECT event_id,
 CASE WHEN ('0x' || substr(md5(event_id::VARCHAR || ':42'), 1, 13))::BIGINT / 4503599627370496.0 < 0.2
 THEN 'test' ELSE 'train' END AS split FROM events) GROUP BY 1""", i="id_sum")
def snapshot_roundtrip(t):
    from rtml.operators.sample import random_split
    path = scratch_path(t.spark, "snapshot")
    write_snapshot(random_split(t.events.select("event_id", "value"), "event_id"), path)
    return read_snapshot(t.spark, path).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("id_sum"))


@query("schema_evolution", """SELECT event_id, value, CASE WHEN event_type = 'purchase' THEN user_id END AS buyer
 FROM events""", d="value", digits=2)
def schema_evolution(t):
    """Two appends with different columns, read as one table."""
    from rtml.sources.ingest import read_table
    path = scratch_path(t.spark, "evolving")
    bought = F.col("event_type") == "purchase"
    t.events.where(~bought).select("event_id", "value").write.parquet(path)
    t.events.where(bought).select("event_id", "value", F.col("user_id").alias("buyer")) \
        .write.mode("append").parquet(path)
    return read_table(t.spark, path, merge_schema=True)
