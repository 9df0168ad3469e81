"""Progress of streaming queries as a durable table."""

import os
import time

from rtml.streaming.progress import ProgressLog, progress_summary, progress_table


def test_one_row_per_batch_over_a_restart(spark, tmp_path):
    folder, log = tmp_path / "in", str(tmp_path / "log")
    folder.mkdir()
    listener = ProgressLog(spark, log, batch=7)
    spark.streams.addListener(listener)

    def drain():
        stream = spark.readStream.schema("v string").option("maxFilesPerTrigger", 1).text(str(folder))
        stream.writeStream.queryName("lines").option("checkpointLocation", str(tmp_path / "cp")) \
            .trigger(availableNow=True).foreachBatch(lambda b, i: b.count()).start().awaitTermination()

    def wait(n):
        ends = time.time() + 30
        while time.time() < ends and (not os.path.isdir(log) or
                                      progress_table(spark, log).count() < n):
            time.sleep(0.5)

    try:
        for half in range(2):
            for i in range(20):
                (folder / f"{half}-{i:02}.txt").write_text("a\nb\n")
            drain()
            wait(20 * (half + 1))
        rows = progress_table(spark, log).collect()
        assert sorted(r.batch_id for r in rows if r.input_rows) == list(range(40))
        assert sum(r.input_rows for r in rows) == 80 and {r.name for r in rows} == {"lines"}
        assert len({r.query_id for r in rows}) == 1 and len({r.run_id for r in rows}) == 2
        summary = progress_summary(spark, log).collect()
        assert len(summary) == 1 and summary[0].input_rows == 80 and summary[0].late_rows == 0
        files = [f for f in os.listdir(log) if f.startswith("events-")]
        assert len(files) <= 10
    finally:
        spark.streams.removeListener(listener)
