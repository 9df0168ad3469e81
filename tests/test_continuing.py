"""A restart from the best run reads each record once; model, state and offsets come together."""

import json

import pytest
from pyspark.sql import functions as F

from rtml.streaming.continuing import Commit, Commits, kafka_start, learn, start_run, unread
from rtml.streaming.statelog import StateLog


def records(spark, ends):
    return spark.createDataFrame([(p, o, 100 * p + o) for p, n in enumerate(ends) for o in range(n)],
                                 "partition int, offset long, v long")


def learner(spark, path, seen, score=None):
    log = StateLog(spark, f"{path}/state", "total long", whole=False)

    def fit(rows, commit):
        got = sorted(r.v for r in rows.collect())
        seen.append(got)
        state = log.latest() + 1
        before = log.version(commit.state).agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
        log.write(spark.createDataFrame([(before + sum(got),)], "total long"), state)
        return f"model-{state}", state, {"auc": score if score is not None else len(got) / 100}
    return fit, log


def test_each_record_is_read_once_over_restarts(spark, tmp_path):
    commits, seen = Commits(spark, str(tmp_path / "commits")), []
    fit, log = learner(spark, tmp_path, seen)
    for ends in ([3, 2], [3, 2], [5, 2, 4], [5, 6, 4]):
        commit = start_run(Commits(spark, str(tmp_path / "commits")), "a")
        learn(commits, commit, records(spark, ends), fit)
    flat = [v for part in seen for v in part]
    assert sorted(flat) == sorted(r.v for r in records(spark, [5, 6, 4]).collect())
    last = commits.of("a")
    assert last.step == 4 and last.offsets == {"0": 5, "1": 6, "2": 4}
    assert log.version(last.state).first().total == sum(flat)


def test_a_new_run_continues_the_best(spark, tmp_path):
    commits, seen = Commits(spark, str(tmp_path / "commits")), []
    good, log = learner(spark, tmp_path, seen, 0.9)
    bad, _ = learner(spark, tmp_path, seen, 0.4)
    first = learn(commits, start_run(commits, "good"), records(spark, [4, 1]), good)
    learn(commits, start_run(commits, "bad"), records(spark, [9, 9]), bad)
    begin = start_run(commits, "next", "auc")
    assert (begin.model, begin.state, begin.offsets) == (first.model, first.state, first.offsets)
    assert begin.parent == "good/1" and begin.step == 0
    done = learn(commits, begin, records(spark, [6, 1]), good)
    assert seen[-1] == [4, 5]
    assert log.version(done.state).first().total == sum([0, 1, 2, 3, 100]) + 4 + 5
    assert start_run(commits, "worst", "auc", larger=False).parent == "bad/1"
    assert {(r.run, r.step) for r in commits.table().collect()} == {("good", 1), ("bad", 1), ("next", 1)}


def test_a_step_that_dies_is_done_again(spark, tmp_path):
    commits, seen = Commits(spark, str(tmp_path / "commits")), []
    fit, log = learner(spark, tmp_path, seen)

    def dying(rows, commit):
        fit(rows, commit)
        raise OSError("executor lost")

    with pytest.raises(OSError):
        learn(commits, start_run(commits, "a"), records(spark, [2]), dying)
    assert commits.of("a") is None
    done = learn(commits, start_run(commits, "a"), records(spark, [2]), fit)
    assert seen == [[0, 1], [0, 1]] and log.version(done.state).first().total == 1
    with pytest.raises(RuntimeError, match="another query"):
        commits.add(Commit("a", 1))


def test_edges(spark, tmp_path):
    commits = Commits(spark, str(tmp_path / "commits"))
    assert commits.best("auc") is None and start_run(commits, "a", "auc") == Commit("a")
    assert commits.table().count() == 0
    with pytest.raises(ValueError):
        commits.add(Commit("a/b"))
    commits.add(Commit("n", 1, metrics={"auc": float("nan")}))
    assert commits.best("auc") is None
    assert unread(records(spark, [2, 2]), Commit("a", offsets={"1": 2})).count() == 2
    assert json.loads(kafka_start("t", Commit("a", offsets={"1": 2, "0": 5}))) == {"t": {"0": 5, "1": 2}}
