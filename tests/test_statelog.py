"""The state log: bounded folders, repeated batches, killed compactions, restarts."""

import os

import pytest
from pyspark.sql import functions as F

from rtml.streaming.statelog import StateLog


def rows(spark, n):
    return spark.createDataFrame([(n, n * 10)], "a long, b long")


def folders(log):
    return [n for n in os.listdir(log.path) if n.startswith("run-")]


def test_two_hundred_batches_keep_few_folders(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"), "a long, b long", fanout=4)
    most = 0
    for n in range(200):
        log.write(rows(spark, n), n)
        most = max(most, len(folders(log)))
    assert most <= 4 * 5 + 4 + 4
    assert sorted(r.a for r in log.all().collect()) == list(range(200))
    assert log.before(57).count() == 57 and log.version(123).first().b == 1230
    assert log.version(500).count() == 0 and log.latest() == 199
    assert len(os.listdir(tmp_path / "log" / "_manifest")) <= 8  # checksum files included
    again = StateLog(spark, str(tmp_path / "log"), "a long, b long", fanout=4)
    assert again.all().agg(F.sum("batch_id")).first()[0] == sum(range(200))


def test_whole_versions_are_dropped(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"), "a long, b long", whole=True, keep=2, fanout=3)
    for n in range(30):
        log.write(rows(spark, n), n)
    assert len(folders(log)) <= 2 + 3 + 3
    assert log.version(29).first().a == 29 and log.version(28).first().a == 28


def test_a_batch_again_replaces_its_run(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"), "a long, b long", keep=2, fanout=2)
    for n in range(6):
        log.write(rows(spark, n), n)
    log.write(rows(spark, 50), 5)
    assert sorted(r.a for r in log.all().collect()) == [0, 1, 2, 3, 4, 50]
    with pytest.raises(ValueError, match="merged"):
        log.write(rows(spark, 9), 0)


class Killed(Exception):
    pass


@pytest.mark.parametrize("step", ["before the manifest", "after the manifest"])
def test_a_killed_compaction_loses_nothing(spark, tmp_path, monkeypatch, step):
    log = StateLog(spark, str(tmp_path / "log"), "a long, b long", keep=2, fanout=3)
    for n in range(4):
        log.write(rows(spark, n), n)
    publish, calls = log.files.publish, []

    def dying(name, text):
        calls.append(name)
        if len(calls) < 2:  # the batch's own commit
            return publish(name, text)
        if step == "after the manifest":
            publish(name, text)
        raise Killed

    monkeypatch.setattr(log.files, "publish", dying)
    with pytest.raises(Killed):
        log.write(rows(spark, 4), 4)
    again = StateLog(spark, str(tmp_path / "log"), "a long, b long", keep=2, fanout=3)
    assert sorted(r.a for r in again.all().collect()) == [0, 1, 2, 3, 4]
    named = {r[3] for r in again.manifest().runs} | set(again.manifest().leaving)
    assert set(folders(again)) <= named
    for n in range(5, 20):
        again.write(rows(spark, n), n)
    assert sorted(r.a for r in again.all().collect()) == list(range(20))


def test_two_writers_do_not_mix(spark, tmp_path):
    first = StateLog(spark, str(tmp_path / "log"), "a long, b long")
    first.write(rows(spark, 0), 0)
    stale = first.manifest()
    first.write(rows(spark, 1), 1)
    with pytest.raises(RuntimeError, match="another query"):
        first._commit(stale, stale.runs)
    assert first.all().count() == 2


def test_empty_log(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"), "a long, b long")
    assert log.all().columns == ["a", "b", "batch_id"] and log.all().count() == 0
    assert log.version(-1).columns == ["a", "b"] and log.before(3).count() == 0
    with pytest.raises(ValueError):
        StateLog(spark, str(tmp_path / "log"), "a long", keep=1)
