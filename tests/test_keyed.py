"""Encoder and scaler state in the state store over batches, restarts and time to live."""

import os
import time

from pyspark.sql import functions as F

from rtml.streaming import drift as D, keyed as K


def put(spark, folder, rows, kind="id long, c string, d string"):
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, root, build, kind="id long, c string, d string", until=None):
    spark.conf.set(*D.STATE_STORE)
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(folder)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/table/batch_id={batch_id}")

    writer = build(stream).writeStream.outputMode("update") \
        .option("checkpointLocation", f"{root}/cp").foreachBatch(write)
    if until is None:
        writer.trigger(availableNow=True).start().awaitTermination()
        return
    query, ends = writer.trigger(processingTime="500 milliseconds").start(), time.time() + 60
    while time.time() < ends and not until():
        time.sleep(0.5)
    query.stop()


def test_codes_over_batches_and_a_restart(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path)
    batches = [[(0, "x", "1"), (1, "y", None), (2, "x", "1")], [(3, None, "2"), (4, "z", "")],
               [(5, "y", "2"), (6, "", "3")], [(7, "w", "1"), (8, None, "n")]]
    build = lambda s: K.encode_stream(s, ["c", "d"], "id")
    for i, rows in enumerate(batches):
        put(spark, folder, rows)
        if i % 2:
            run(spark, folder, root, build)
    coded = K.coded_rows(spark.read.parquet(f"{root}/table"), ["c", "d"])
    flat, want = [r for b in batches for r in b], []
    seen = {1: {}, 2: {}}
    for r in flat:
        want.append((r[0], *[seen[j].setdefault(r[j], len(seen[j])) for j in (1, 2)]))
    assert sorted(tuple(r) for r in coded.collect()) == want
    table = K.state_table(spark, f"{root}/cp", "codes")
    assert {(r.feature, r.value): r.code for r in table.collect()} == \
        {(f, v): n for f, j in (("c", 1), ("d", 2)) for v, n in seen[j].items()}
    twin = K.first_seen_codes_split(spark.createDataFrame(flat, "id long, c string, d string"),
                                    "c", "id")
    assert {r.value: r.code for r in twin.collect()} == seen[1]


def test_split_codes_equal_the_batch_twin(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path)
    rows = [(i, f"v{i * i % 97}", None) for i in range(400)]
    for at in range(0, 400, 100):
        put(spark, folder, rows[at:at + 100])
    run(spark, folder, root, lambda s: K.encode_stream(s, ["c"], "id", splits=5))
    twin = K.first_seen_codes_split(spark.createDataFrame(rows, "id long, c string, d string"),
                                    "c", "id", 5)
    want = {r.value: r.code for r in twin.collect()}
    found = K.state_table(spark, f"{root}/cp", "codes").collect()
    assert {r.value: r.code for r in found} == want and len(set(want.values())) == len(want)
    coded = K.coded_rows(spark.read.parquet(f"{root}/table"), ["c"]).collect()
    assert {r.row_id: r.c_code for r in coded} == {i: want[c] for i, c, _ in rows}


def test_what_reaches_the_state_is_reduced(spark, tmp_path):
    """A value that fills a batch is one row per Arrow batch, whatever its number of rows."""
    rows = spark.range(5000).select(F.col("id").alias("_id"), F.col("id").alias("_at"),
                                    F.lit("hot").alias("c")).coalesce(1)
    packed = rows.mapInArrow(K._packed(["c"]), "feature string, value string, at long, ids array<long>")
    assert packed.count() <= 5000 / 512 + 1
    assert packed.agg(F.sum(F.size("ids"))).first()[0] == 5000


def test_forgotten_values_get_new_codes(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path)
    build = lambda s: K.encode_stream(s, ["c"], "id", ttl_ms=2000)

    def codes():
        table = spark.read.schema("feature string, code long, ids array<long>") \
            .option("recursiveFileLookup", True).parquet(folder if not os.path.exists(
                f"{root}/table") else f"{root}/table")
        return {r.row_id: r.c_code for r in K.coded_rows(table.where("ids IS NOT NULL"), ["c"])
                .collect()}

    put(spark, folder, [(0, "a", None), (1, "b", None)])
    run(spark, folder, root, build, until=lambda: len(codes()) == 2)
    time.sleep(3)
    put(spark, folder, [(2, "a", None)])
    run(spark, folder, root, build, until=lambda: len(codes()) == 3)
    assert codes() == {0: 0, 1: 1, 2: 2}


def test_moments_over_batches(spark, tmp_path):
    folder, root, kind = str(tmp_path / "in"), str(tmp_path), "x double, y double"
    data = [[(1.0, None), (1e9 + 1, 2.0)], [(None, float("nan")), (1e9 + 3, float("inf"))],
            [(1e9 + 2, 5.0)]]
    for rows in data:
        put(spark, folder, rows, kind)
        run(spark, folder, root, lambda s: K.moments_stream(s, ["x", "y"]), kind)
    found = {r.feature: r for r in K.state_table(spark, f"{root}/cp", "moments").collect()}
    assert (found["y"].n, found["y"].mean, found["y"].m2) == (2, 3.5, 4.5)
    x = [1.0, 1e9 + 1, 1e9 + 3, 1e9 + 2]
    mean = sum(x) / 4
    assert found["x"].n == 4 and abs(found["x"].mean - mean) < 1e-3
    assert abs(found["x"].m2 / sum((v - mean) ** 2 for v in x) - 1) < 1e-9
    assert (found["x"].low, found["x"].high) == (1.0, 1e9 + 3)


def test_rows_that_wait_for_a_code_are_not_held(monkeypatch):
    """Ids of new values leave in parts, from a file once they are many; each once, with its code."""
    import tempfile

    import pandas as pd

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, value):
            self.held = value

    class Codes(dict):
        containsKey, getValue, updateValue = dict.__contains__, dict.__getitem__, dict.__setitem__

    monkeypatch.setattr(K, "_WAITING", 1000)
    monkeypatch.setattr(K, "_READ", 1600)
    files, make = [], tempfile.SpooledTemporaryFile
    monkeypatch.setattr(tempfile, "SpooledTemporaryFile", lambda n: files.append(make(n)) or files[-1])
    book = K.CodeBook(1, None)
    book.codes, book.count = Codes(), Value()
    frames = [pd.DataFrame({"value": [None, f"w{i}", "hot"], "at": [i + 5, i, i + 500], "ids": [
        [i], [1000 + i], list(range(2000 + 50 * i, 2050 + 50 * i))]}) for i in (7, 3, 5)]
    out = list(book.handleInputRows(("f", 0), iter(frames), None))
    assert files[0]._rolled and max(sum(map(len, f["ids"])) for f in out) <= 100
    got = {(r.value, r.code, i) for f in out for r in f.itertuples() for i in r.ids}
    codes = {"w3": 0, "w5": 1, "w7": 2, None: 3, "hot": 4}
    assert got == {(v, codes[v], j) for f in frames for v, ids in zip(f["value"], f["ids"]) for j in ids}
    assert sum(len(i) for f in out for i in f["ids"]) == len(got) and book.count.get() == (5,)
