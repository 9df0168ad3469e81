"""Learning that continues from the best run: model, state and offsets named by one commit record.

A micro-batch learner writes its model and state first and a commit record last. The record holds the
offsets of every partition up to which rows were learned, so a learner that is started again, from its
own end or from the best run of any learner, reads each later record once and none twice.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from rtml.streaming.statelog import Files


@dataclass
class Commit:
    """What one learned step left: versions of model and state, next offset per partition."""
    run: str
    step: int = 0
    model: str | None = None
    state: int = -1
    offsets: dict[str, int] = field(default_factory=dict)
    metrics: dict[str, float] = field(default_factory=dict)
    parent: str | None = None  # run/step that this run continues


class Commits:
    """Commit records of all runs under one folder, one small file per step, written whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = Files(spark, self.path)

    def add(self, commit: Commit) -> None:
        """Publish a record; a step that is there already is refused."""
        if not re.fullmatch(r"[\w.-]+", commit.run):
            raise ValueError(f"{commit.run!r} is no name of a run")
        self.files.publish(f"{commit.run}/{commit.step:09d}.json", json.dumps(asdict(commit)))

    def of(self, run: str, step: int | None = None) -> Commit | None:
        """A step of a run, its last one by default; None if there is none."""
        steps = sorted(n for n in self.files.names(run) if re.fullmatch(r"\d{9}\.json", n))
        if step is not None:
            steps = [n for n in steps if int(n[:-5]) == step]
        return Commit(**json.loads(self.files.read(f"{run}/{steps[-1]}"))) if steps else None

    def table(self) -> DataFrame:
        """All records: ``run, step, model, state, offsets, metrics, parent``."""
        kind = "run string, step int, model string, state int, offsets map<string,long>, " \
               "metrics map<string,double>, parent string"
        if not self.files.names():
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).option("recursiveFileLookup", True) \
            .option("pathGlobFilter", "*.json").json(self.path)

    def best(self, metric: str, larger: bool = True) -> Commit | None:
        """The step with the best metric over all runs; ties: the first run by name, the last step."""
        value = F.col("metrics")[metric]
        known = self.table().where(value.isNotNull() & ~F.isnan(value))
        row = known.orderBy(value.desc() if larger else value.asc(), "run", F.desc("step")) \
            .select("run", "step").first()
        return self.of(row.run, row.step) if row else None


def start_run(commits: Commits, run: str, metric: str | None = None, larger: bool = True) -> Commit:
    """Where a run begins: at its own last commit, else at the best commit of any run, else empty.

    The answer's model, state and offsets belong together: all come from one record.
    """
    own = commits.of(run)
    if own is not None:
        return own
    best = commits.best(metric, larger) if metric else None
    if best is None:
        return Commit(run)
    return Commit(run, 0, best.model, best.state, dict(best.offsets), {}, f"{best.run}/{best.step}")


def unread(records: DataFrame, commit: Commit, partition: str = "partition",
           offset: str = "offset") -> DataFrame:
    """Records at or after the commit's next offset of their partition; new partitions from the start.

    The offsets are one literal per partition, so the filter reaches the scan.
    """
    known = F.lit(False)
    ahead = F.lit(False)
    for name, start in commit.offsets.items():
        mine = F.col(partition).cast("string") == name
        known = known | mine
        ahead = ahead | (mine & (F.col(offset) >= start))
    return records.where(ahead | ~known)


def offsets_after(records: DataFrame, commit: Commit, partition: str = "partition",
                  offset: str = "offset") -> dict[str, int]:
    """Next offset per partition once ``records`` are learned too."""
    found = records.groupBy(F.col(partition).cast("string").alias("p")) \
        .agg((F.max(offset) + 1).alias("o")).collect()  # one row per partition of the topic
    return {**commit.offsets, **{r.p: max(r.o, commit.offsets.get(r.p, 0)) for r in found}}


def kafka_start(topic: str, commit: Commit) -> str:
    """``startingOffsets`` of a Kafka source for a commit with at least one partition."""
    return json.dumps({topic: {p: o for p, o in sorted(commit.offsets.items())}})


def learn(commits: Commits, commit: Commit, records: DataFrame, fit, partition: str = "partition",
          offset: str = "offset") -> Commit:
    """One step: read what is unread, let ``fit(rows, commit)`` write a model and a state and return
    ``(model, state, metrics)``, then publish the record.

    If the driver dies before the record is published, the step is done again from the same rows;
    what it wrote without a record is never used.
    """
    rows = unread(records, commit, partition, offset)
    ends = offsets_after(rows, commit, partition, offset)
    # rows that arrive while the step runs wait for the next one
    bound = F.lit(False)
    for name, end in ends.items():
        bound = bound | ((F.col(partition).cast("string") == name) & (F.col(offset) < end))
    model, state, metrics = fit(rows.where(bound), commit)
    done = Commit(commit.run, commit.step + 1, model, state, ends, metrics, commit.parent)
    commits.add(done)
    return done
