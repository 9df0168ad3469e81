"""Streams: restart without duplicates, bad records, late rows, kept state, drift."""

import json

import pytest
from pyspark.sql import functions as F

from rtml.sources import ingest as I
from rtml.streaming import drift as D, online as O, windows as W

SCHEMA = "id bigint, kind string, value double, device string"


def write_lines(path, name, lines):
    path.mkdir(exist_ok=True, parents=True)
    (path / name).write_text("\n".join(lines) + "\n")


def line(i, **more):
    return json.dumps({"id": i, "kind": "ab"[i % 2], "value": i / 2, "device": {"os": "x"}} | more)


def test_ingest_restart_has_no_duplicates(spark, tmp_path):
    topic = I.Topic("t", SCHEMA, str(tmp_path / "table"), str(tmp_path / "cp"),
                    folder=str(tmp_path / "in"))
    write_lines(tmp_path / "in", "1.txt", [line(i) for i in range(10)])
    for _ in range(2):
        I.start_ingest(spark, [topic], once=True)[0].awaitTermination()
    write_lines(tmp_path / "in", "2.txt", [line(i) for i in range(10, 15)])
    I.start_ingest(spark, [topic], once=True)[0].awaitTermination()
    table = I.read_table(spark, topic.path)
    assert sorted(r.id for r in table.collect()) == list(range(15))
    assert table.first().device == '{"os":"x"}'
    assert I.table_or_topic(spark, topic).count() == 15


def test_unreadable_records_are_kept(spark, tmp_path):
    write_lines(tmp_path / "in", "1.txt", [line(1), "{broken", line(2)])
    topic = I.Topic("t", SCHEMA, str(tmp_path / "table"), str(tmp_path / "cp"),
                    folder=str(tmp_path / "in"))
    for q in I.start_ingest(spark, [topic], once=True):
        q.awaitTermination()
    write_lines(tmp_path / "in", "2.txt", [line(3), '["no object"'])
    queries = I.start_ingest(spark, [topic], once=True)
    queries[0].awaitTermination()
    assert len(queries) == 1  # one reader of the topic
    table = I.read_table(spark, topic.path)
    assert table.columns == ["id", "kind", "value", "device"]
    assert sorted(r.id for r in table.collect()) == [1, 2, 3]
    assert sorted(r[0] for r in I.read_quarantine(spark, topic.path).collect()) == \
        ['["no object"', "{broken"]


def test_dropping_unreadable_records_is_an_option(spark, tmp_path):
    write_lines(tmp_path / "in", "1.txt", [line(1), "{broken"])
    topic = I.Topic("t", SCHEMA, str(tmp_path / "table"), str(tmp_path / "cp"),
                    folder=str(tmp_path / "in"))
    I.start_ingest(spark, [topic], once=True, quarantine=False)[0].awaitTermination()
    assert [r.id for r in I.read_table(spark, topic.path).collect()] == [1]
    assert I.read_quarantine(spark, topic.path).count() == 0


def test_table_reports(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.createDataFrame([(2, "b"), (1, None), (4, "d"), (3, "c")], "id long, name string") \
        .repartition(2).write.parquet(path)
    rows = I.table_report(spark, path).orderBy("position").collect()
    assert [tuple(r) for r in rows] == [(0, "id", "bigint", True, path, 4),
                                        (1, "name", "string", True, path, 4)]
    df = I.read_table(spark, path)
    full = I.full_health_report(df, ["id"]).first()
    assert (full.version, full.files, full.rows, full.columns) == (None, 2, 4, 2)
    assert full.column_types == ["id: bigint", "name: string"]
    assert [json.loads(x) for x in full.first_rows] == [
        {"id": 1, "name": None}, {"id": 2, "name": "b"}, {"id": 3, "name": "c"}]
    none = I.full_health_report(df.where("id > 9"), ["id"]).first()
    assert (none.files, none.rows, none.first_rows) == (0, 0, [])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        I.read_table(spark, str(tmp_path / "nowhere"))


def test_bad_records(spark, tmp_path):
    raw = spark.createDataFrame([(line(1),), ('{"id": 2, "value": "oops"}',), ("{broken",)],
                                "value string")
    good, bad = I.split_corrupt(I.decode(raw, SCHEMA))
    assert good.where("id = 1").count() == 1
    assert {r[0] for r in bad.collect()} >= {"{broken"}


def test_fallback_to_first_event(spark, tmp_path):
    write_lines(tmp_path / "in", "1.txt", [line(7)])
    topic = I.Topic("t", SCHEMA, str(tmp_path / "none"), "", folder=str(tmp_path / "in"))
    assert [r.id for r in I.table_or_topic(spark, topic).collect()] == [7]


def test_kafka_offsets():
    assert I._kafka_options("t", "h:1", None)["startingOffsets"] == "earliest"


def test_starting_offsets(spark):
    rows = spark.createDataFrame([(0, 5), (1, 9)], "partition int, next_offset long")
    assert json.loads(I.starting_offsets("t", rows)) == {"t": {"0": 5, "1": 9}}
    assert I.after_offset(spark.range(10), "id", 6).count() == 3


def test_run_until_stops_queries(spark, tmp_path):
    write_lines(tmp_path / "in", "1.txt", [line(1)])
    topic = I.Topic("t", SCHEMA, str(tmp_path / "table"), str(tmp_path / "cp"),
                    folder=str(tmp_path / "in"))
    queries = I.start_ingest(spark, [topic])
    calls = []
    I.run_until(queries, lambda: calls.append(1) or len(calls) > 1, poll_seconds=0.1)
    assert not queries[0].isActive


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    src = tmp_path / "src"

    def put(name, times):
        spark.createDataFrame([(t, "a") for t in times], "s long, k string") \
            .select(F.timestamp_seconds("s").alias("ts"), "k").coalesce(1) \
            .write.parquet(str(src / name))

    put("1", [0, 10, 4000])
    stream = spark.readStream.schema("ts timestamp, k string").parquet(str(src / "*"))
    counts = W.windowed_counts(stream, "ts", ["k"], "1 minute", delay="10 minutes")
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    W.append_table(counts, out, cp).awaitTermination()
    put("2", [20, 9000])
    q = W.append_table(counts, out, cp)
    q.awaitTermination()
    done = {(r.window_start.timestamp(), r.n) for r in spark.read.parquet(out).collect()}
    assert (0.0, 2) in done and len([d for d in done if d[0] == 0.0]) == 1
    assert W.progress_table(q).agg(F.sum("late_rows")).first()[0] == 1


def test_dictionary_survives_restart(spark, tmp_path):
    def batch(values, start):
        return spark.createDataFrame([(start + i, v) for i, v in enumerate(values)],
                                     "at long, c string")

    first = O.OnlineDictionary(spark, str(tmp_path), ["c"], "at")
    first(batch(["x", "y", "x"], 0), 0)
    again = O.OnlineDictionary(spark, str(tmp_path), ["c"], "at")
    again(batch(["z", "y", None], 3), 1)
    again(batch(["z", "y", None], 3), 1)  # the same batch once more
    known = {r.value: r.code for r in again.entries.all().where("batch_id >= 0").collect()}
    assert known == {"x": 0, "y": 1, "z": 2, None: 3}
    coded = spark.read.parquet(again.encoded_path)
    assert sorted((r.at, r.c_code) for r in coded.collect()) == \
        [(0, 0), (1, 1), (2, 0), (3, 2), (4, 1), (5, 3)]


def test_scaler_merges_batches(spark, tmp_path):
    scaler = O.OnlineScaler(spark, str(tmp_path), ["x"])
    values = [1.0, 5.0, 2.0, 8.0, 9.0]
    for b, part in enumerate([values[:2], values[2:]]):
        scaler(spark.createDataFrame([(v,) for v in part], "x double"), b)
    s = scaler.state.version(1).first()
    mean = sum(values) / 5
    assert (s.n, s.mean) == (5, pytest.approx(mean))
    assert s.m2 == pytest.approx(sum((v - mean) ** 2 for v in values))


def test_prequential_order_matters(spark, tmp_path):
    batches = [spark.createDataFrame([("a", 10.0)], "k string, y double"),
               spark.createDataFrame([("a", 20.0)], "k string, y double")]
    got = {}
    for order in ("test_then_train", "train_then_test"):
        step = O.Prequential(spark, str(tmp_path / order), O.RunningMeanModel("k", "y"), order)
        for i, b in enumerate(batches):
            step(b, i)
        got[order] = [r.abs_error for r in step.metrics.all().where("batch_id >= 0")
                      .orderBy("batch_id").collect()]
    assert got == {"test_then_train": [10.0, 10.0], "train_then_test": [0.0, 5.0]}


def test_micro_clusters_fade_and_clean(spark, tmp_path):
    step = O.MicroClusters(spark, str(tmp_path), "v", threshold=1.0, fading=1.0, cleanup=1,
                           min_weight=1.0)
    step(spark.createDataFrame([([0.1],), ([0.2],), ([0.3],), ([5.5],)], "v array<double>"), 0)
    assert step.cells.version(0).count() == 2
    step(spark.createDataFrame([([0.4],)], "v array<double>"), 1)
    left = step.cells.version(1).collect()
    assert len(left) == 1 and left[0].weight == pytest.approx(2.5)
    assert step.centers(1).first().center[0] == pytest.approx((0.6 / 2 + 0.4) / 2.5)


def test_forest_refits_on_schedule(spark, tmp_path):
    from rtml.operators.train import forest
    step = O.WindowedForest(spark, str(tmp_path), lambda: forest(["x"], "y", True, 3, 3),
                            "at long, x double, y int", "at", window_rows=30, refit_every=2)
    for b in range(3):
        step(spark.range(b * 20, b * 20 + 20).select(
            F.col("id").alias("at"), F.col("id").cast("double").alias("x"),
            (F.col("id") % 2).cast("int").alias("y")), b)
    assert step.refits == 2 and step.recent.version(2).count() == 30
    again = O.WindowedForest(spark, str(tmp_path), lambda: forest(["x"], "y", True, 3, 3),
                             "at long, x double, y int", "at", window_rows=30, refit_every=5)
    again(spark.range(60, 80).select(F.col("id").alias("at"), F.col("id").cast("double").alias("x"),
                                     (F.col("id") % 2).cast("int").alias("y")), 3)
    assert again.refits == 0 and again.model is not None and again.saved.version(3).count() == 1


def test_drift_window():
    blocks, seen = [], []
    for i in range(60):
        mean = 0.1 if i < 30 else 0.9
        blocks, drift, _ = D.add_block(blocks, [64.0, 64 * mean, 64 * mean * mean])
        seen.append(drift)
    assert not any(seen[:30]) and any(seen[30:34])
    assert sum(b[0] for b in blocks) <= 64 * 31


def test_drift_stream_keeps_state(spark, tmp_path):
    src = tmp_path / "src"

    def put(name, start, level):
        spark.range(start, start + 2000).select(
            "id", F.lit("m").alias("k"),
            (F.lit(level) + F.pmod(F.hash("id"), F.lit(10)) / 100).alias("e")).coalesce(1) \
            .write.parquet(str(src / name))

    put("1", 0, 0.1)
    found = D.detect_drift(spark.readStream.schema("id long, k string, e double")
                           .parquet(str(src / "*")), "k", "id", "e")
    out = []

    def keep(batch, _):
        out.extend(batch.collect())

    def run():
        found.writeStream.outputMode("update").trigger(availableNow=True) \
            .option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(keep).start() \
            .awaitTermination()

    run()
    put("2", 2000, 0.8)
    run()
    assert [r.rows for r in out] == [2000, 4000]
    assert [r.drift for r in out] == [False, True]
