"""Online bagging: a forest of which single trees are replaced when their own error drifts.

Every tree weighs each row by a Poisson number made from the row's key, so a batch that is run again
is weighed alike. A batch is first scored by all trees in one pass, which gives one error block per
tree; the adaptive window over these blocks decides on each tree alone.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rtml.streaming.drift import add_block
from rtml.streaming.statelog import Files, StateLog

RATE = 6.0


def poisson_cdf(rate: float = RATE, least: float = 1e-12) -> list[float]:
    """Cumulative Poisson shares until what is left is below ``least``."""
    share, total, out = math.exp(-rate), 0.0, []
    while 1.0 - total > least:
        total += share
        out.append(min(total, 1.0))
        share *= rate / len(out)
    return out


def bag_weight(key: str | Column, tree: int, rate: float = RATE) -> Column:
    """Poisson weight of a row for one tree, from 32 bits of an md5 of key and tree."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{tree}")))
    unit = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    # the digest enters as a bound variable: inside the condition it would be taken for every step
    weight = F.transform(F.array(unit), lambda u: sum(
        ((F.lit(p) <= u).cast("int") for p in poisson_cdf(rate)), F.lit(0)))
    return F.get(weight, F.lit(0))


class BaggedForest:
    """``foreachBatch`` step: ``trees`` classification trees on the last ``window`` batches.

    ``key`` names a row; ``label`` holds 0 .. classes - 1; rows with a null label or feature do not
    train, and rows with a null feature are not scored. Each tree sees ``subset`` of the features,
    drawn once by seed. A tree is grown

    - ``start``: on the first batch that has rows,
    - ``growth``: when its training rows have doubled since it was grown,
    - ``drift``: when the adaptive window over its own errors is cut. Its training rows then begin
      with the batch of its last warning, and its error window begins anew.

    Nothing else replaces a tree. Driver data is a row per tree with at most 64 error blocks. The
    window is one run per batch in a log that drops old batches, so no row is written twice. All
    state of a batch follows from the state before it, so a batch that is run again, or a query that
    is restarted, comes to the same forest.
    """

    TREES = ("tree int, features array<string>, grown_at long, since long, trained_on long, "
             "warned_at long, blocks string, reason string")
    METRICS = "rows long, errors long, replaced array<int>, grown array<int>"

    def __init__(self, spark: SparkSession, path: str, features: list[str], label: str, key: str,
                 trees: int = 10, subset: int | None = None, window: int = 20, depth: int = 6,
                 classes: int = 2, rate: float = RATE, seed: int = 42):
        if not features or trees < 1 or window < 1:
            raise ValueError("features, trees and window must not be empty")
        self.spark, self.path, self.label, self.key = spark, path.rstrip("/"), label, key
        self.features, self.depth, self.classes, self.rate, self.seed = features, depth, classes, \
            rate, seed
        self.window = window
        size = min(subset or math.ceil(math.sqrt(len(features))), len(features))
        self.subsets = [sorted(random.Random(f"{seed}:{t}").sample(features, size))
                        for t in range(trees)]
        cols = ", ".join(f"`{c}` double" for c in features)
        self.recent = StateLog(spark, f"{self.path}/recent", f"_key string, _y double, {cols}",
                               whole=True, keep=max(window, 2))
        self.state = StateLog(spark, f"{self.path}/trees", self.TREES, whole=True)
        self.metrics = StateLog(spark, f"{self.path}/metrics", self.METRICS)
        self.models = f"{self.path}/models"
        self._held: dict[tuple[int, int], DecisionTreeClassificationModel] = {}

    def _model(self, tree: int, grown_at: int) -> DecisionTreeClassificationModel:
        at = (tree, grown_at)
        if at not in self._held:
            self._held[at] = DecisionTreeClassificationModel.load(
                f"{self.models}/tree-{tree}-{grown_at}")
        return self._held[at]

    def _rows(self, batch: DataFrame) -> DataFrame:
        return batch.select(F.col(self.key).cast("string").alias("_key"),
                            F.col(self.label).cast("double").alias("_y"),
                            *[F.col(c).cast("double").alias(c) for c in self.features])

    def _voted(self, rows: DataFrame, forest: list) -> DataFrame:
        """``rows`` with ``_t<tree>`` (the tree's class) and ``prediction`` (largest mean share)."""
        shares = []
        for t in forest:
            name = f"_v{t.tree}"
            rows = VectorAssembler(inputCols=t.features, outputCol=name, handleInvalid="skip") \
                .transform(rows)
            model = self._model(t.tree, t.grown_at).copy()
            for setter, column in ((model.setFeaturesCol, name), (model.setRawPredictionCol, ""),
                                   (model.setProbabilityCol, f"_p{t.tree}"),
                                   (model.setPredictionCol, f"_t{t.tree}")):
                setter(column)
            rows = model.transform(rows)
            shares.append(vector_to_array(f"_p{t.tree}"))
        votes = F.array(*[sum((F.coalesce(F.get(s, F.lit(c)), F.lit(0.0)) for s in shares),
                              F.lit(0.0)) for c in range(self.classes)])
        return rows.withColumn("prediction", (F.array_position(votes, F.array_max(votes)) - 1)
                               .cast("double"))

    def score(self, df: DataFrame, batch_id: int | None = None) -> DataFrame:
        """``df`` with ``prediction`` by the forest after a batch (default: the last one)."""
        at = self.state.latest() if batch_id is None else batch_id
        forest = self.state.version(at).orderBy("tree").collect()
        if not forest:
            raise ValueError("no tree has been grown yet")
        # the row is one struct, so its columns may have any name
        rows = df.select(F.struct("*").alias("_row"),
                         *[F.col(c).cast("double").alias(c) for c in self.features])
        return self._voted(rows, forest).select("_row.*", "prediction")

    def _grow(self, held: DataFrame, tree: int, since: int, batch_id: int) -> int:
        """Grow one tree on the rows since a batch; how many rows there were."""
        names = self.subsets[tree]
        rows = held.where(F.col("batch_id") >= since).where("_y IS NOT NULL").dropna(subset=names) \
            .withColumn("_w", bag_weight("_key", tree, self.rate).cast("double"))
        rows = rows.select("_y", "_w", *names).persist()  # weighed once, read by every pass below
        try:
            chosen = rows.where("_w > 0")
            if chosen.isEmpty():
                return 0
            rows_seen = rows.count()
            model = DecisionTreeClassifier(
                featuresCol="_x", labelCol="_y", weightCol="_w", maxDepth=self.depth,
                seed=self.seed + tree).fit(VectorAssembler(inputCols=names, outputCol="_x")
                                           .transform(chosen))
        finally:
            rows.unpersist()
        model.write().overwrite().save(f"{self.models}/tree-{tree}-{batch_id}")
        self._held[tree, batch_id] = model
        return rows_seen

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = self._rows(batch)
        self.recent.write(rows, batch_id)
        forest = [r.asDict() for r in self.state.version(batch_id - 1).orderBy("tree").collect()]
        held = self.recent.all().where(f"batch_id > {batch_id - self.window} AND "
                                       f"batch_id <= {batch_id}")
        seen, wrong, errors = 0, 0, {}
        if forest:
            known = self.state.version(batch_id - 1).orderBy("tree").collect()
            voted = self._voted(rows.where("_y IS NOT NULL"), known)
            one = voted.agg(F.count(F.lit(1)).alias("n"),
                            F.count_if(F.col("prediction") != F.col("_y")).alias("wrong"),
                            *[F.count_if(F.col(f"_t{t.tree}") != F.col("_y")).alias(f"e{t.tree}")
                              for t in known]).first()
            seen, wrong = one.n, one.wrong
            errors = {t.tree: one[f"e{t.tree}"] for t in known}
        else:
            forest = [{"tree": t, "features": names, "grown_at": -1, "since": batch_id,
                       "trained_on": 0, "warned_at": -1, "blocks": "[]", "reason": "start"}
                      for t, names in enumerate(self.subsets)]
        sizes = {r.batch_id: r["count"] for r in held.where("_y IS NOT NULL").groupBy("batch_id")
                 .count().collect()}
        replaced, grown = [], []
        for t in forest:
            drift = False
            if seen:
                e = float(errors[t["tree"]])
                blocks, drift, warning = add_block(json.loads(t["blocks"]), [float(seen), e, e])
                t["blocks"] = json.dumps(blocks)
                t["warned_at"] = (batch_id if t["warned_at"] < 0 else t["warned_at"]) \
                    if warning or drift else -1
            if drift:
                t["since"], t["warned_at"], t["blocks"] = t["warned_at"], -1, "[]"
            available = sum(n for b, n in sizes.items() if b >= t["since"])
            reason = "drift" if drift else "start" if t["grown_at"] < 0 else "growth"
            if drift or available >= max(2 * t["trained_on"], 1):
                n = self._grow(held, t["tree"], t["since"], batch_id)
                if n:
                    t.update(grown_at=batch_id, trained_on=n, reason=reason)
                    (replaced if drift else grown).append(t["tree"])
        if any(t["grown_at"] >= 0 for t in forest):
            ready = [t for t in forest if t["grown_at"] >= 0]
            self.state.write(self.spark.createDataFrame(ready, self.TREES), batch_id)
        else:
            self.state.write(self.spark.createDataFrame([], self.TREES), batch_id)
        self.metrics.write(self.spark.createDataFrame([(seen, wrong, replaced, grown)],
                                                      self.METRICS), batch_id)
        self._forget()

    def _forget(self) -> None:
        """Remove models that no kept version names."""
        named = {f"tree-{r.tree}-{r.grown_at}" for r in
                 self.state.all().select("tree", "grown_at").distinct().collect()}
        files = Files(self.spark, self.models)
        for name in files.names():
            if name not in named:
                files.drop(name)
        self._held = {k: m for k, m in self._held.items() if f"tree-{k[0]}-{k[1]}" in named}
