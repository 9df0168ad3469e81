"""Model training, selection and scoring on MLlib."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.mllib.common import _java2py, _py2java
from pyspark.mllib.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rtml.operators.metrics_clu import calinski_harabasz, center_distances_per_row, \
    davies_bouldin, silhouette_score, with_arrays, with_vectors
from rtml.operators.sample import feature_subset, folds, nested_sizes
from rtml.session import plan_bytes, scratch_path


#: Rows of a block of vectors that steps of k-means read, and distances of it that are held at once.
BLOCK, HELD = 1024, 1 << 20


def at_once(df: DataFrame, jobs: list[Callable], limit: int = 32 << 20) -> list:
    """Results of ``jobs`` on ``df``, in their order; on a small table as many at once as there are cores.

    A fit is a row of jobs. On a table that Spark estimates below ``limit`` bytes their tasks are so short
    that the cores wait for the driver; a larger one is worked on by one fit at a time. Jobs that keep
    little beside the table may have a higher limit.
    """
    spark = df.sparkSession
    n = min(len(jobs), spark.sparkContext.defaultParallelism) if plan_bytes(df) < limit else 1
    if n < 2:
        return [job() for job in jobs]
    with ThreadPool(n) as pool:
        return pool.map(lambda job: job(), [inheritable_thread_target(spark)(j) for j in jobs], 1)


def _cell(x: Column, cuts: list[float], end: float = float("inf")) -> Column:
    """The least of sorted ``cuts`` that is not below ``x``, else ``end``; so for a null or NaN too."""
    if not cuts:
        return F.lit(end)
    m = len(cuts) // 2
    return F.when(x <= cuts[m], _cell(x, cuts[:m], cuts[m])).otherwise(_cell(x, cuts[m + 1:], end))


def tree_cells(model, df: DataFrame, keep: list[str], free: str | None = None) -> DataFrame | None:
    """Rows that no tree of ``model`` tells apart, as one row with their number ``_n``, per ``keep``.

    For a pipeline of an assembler of numbers that keeps invalid ones and a tree model, else None. A
    feature stands at the end of its cell, which goes through every split as the row's own value
    does. ``free``, a feature that is set later, is left out.
    """
    stages = getattr(model, "stages", None) or []
    if len(stages) != 2 or not isinstance(stages[0], VectorAssembler) or \
            not hasattr(stages[1], "toDebugString"):
        return None
    names, said = stages[0].getInputCols(), stages[1].toDebugString
    if stages[0].getHandleInvalid() != "keep" or stages[1].numFeatures != len(names) or \
            len({*names, *keep, "_n"}) != len(names) + len(keep) + 1 or "(feature" not in said or \
            re.search(r"\(feature \d+ (not )?in ", said):
        return None
    cuts = {c: set() for c in names}
    for i, value in re.findall(r"\(feature (\d+) <= ([^)]+)\)", said):
        cuts[names[int(i)]].add(float(value))
    cells = [_cell(F.col(c).cast("double"), sorted(v)).alias(c) for c, v in cuts.items() if c != free]
    return df.groupBy(*cells, *keep).agg(F.count(F.lit(1)).alias("_n"))


def assembler(columns: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="keep")


def boosted_classifier(columns: list[str], label: str, weight: str | None = None,
                       validation: str | None = None, iterations: int = 1000, depth: int = 6,
                       rate: float = 0.05, seed: int = 42) -> Pipeline:
    """Boosted trees; with a validation flag column, boosting stops when it no longer helps."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=iterations, maxDepth=depth,
                        stepSize=rate, seed=seed, checkpointInterval=10)
    if weight:
        gbt = gbt.setWeightCol(weight)
    if validation:
        gbt = gbt.setValidationIndicatorCol(validation)
    return Pipeline(stages=[assembler(columns), gbt])


def boosted_regressor(columns: list[str], label: str, validation: str | None = None,
                      iterations: int = 1000, depth: int = 6, rate: float = 0.05,
                      seed: int = 42) -> Pipeline:
    gbt = GBTRegressor(featuresCol="features", labelCol=label, maxIter=iterations, maxDepth=depth,
                       stepSize=rate, seed=seed, checkpointInterval=10)
    if validation:
        gbt = gbt.setValidationIndicatorCol(validation)
    return Pipeline(stages=[assembler(columns), gbt])


def forest(columns: list[str], label: str, classify: bool, trees: int = 100, depth: int = 10,
           seed: int = 42, weight: str | None = None) -> Pipeline:
    kind = RandomForestClassifier if classify else RandomForestRegressor
    model = kind(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    if weight:
        model = model.setWeightCol(weight)
    return Pipeline(stages=[assembler(columns), model])


def balanced_logistic(columns: list[str], label: str, weight: str = "weight",
                      iterations: int = 2000) -> Pipeline:
    return Pipeline(stages=[
        assembler(columns, "_raw"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(featuresCol="features", labelCol=label, weightCol=weight,
                           maxIter=iterations, standardization=False)])


def kmeans(df: DataFrame, k: int, vec: str = "features", seeds: int = 10, iterations: int = 300,
           tolerance: float = 1e-4, seed: int = 42):
    """Best of several seeded starts by training cost."""
    return _best(at_once(df, _starts(df, k, vec, seeds, iterations, tolerance, seed)))


def _starts(df: DataFrame, k: int, vec: str, seeds: int, iterations: int, tolerance: float,
            seed: int) -> list[Callable]:
    def start(s: int):
        model = KMeans(k=k, featuresCol=vec, predictionCol="cluster", maxIter=iterations,
                       tol=tolerance, seed=s).fit(df)
        return model.summary.trainingCost, model
    return [partial(start, seed + s) for s in range(seeds)]


def _best(started: list):
    """The first model of the least cost."""
    return min(started, key=lambda p: p[0])[1]


def _mllib_vector(row):
    if row[0] is None or not np.isfinite(row[0].toArray()).all():
        raise ValueError("a vector is null, or has a NaN or an infinite place")
    return Vectors.fromML(row[0])


def _first_centers(df: DataFrame, vec: str, wanted: list[tuple[int, int]]) -> list[np.ndarray]:
    """First centers by MLlib's k-means|| of every ``(k, seed)``: those that a fit on ``df`` starts from.

    The vectors are decoded once for all starts and lie in memory, or on disk, as objects.
    """
    context = df.sparkSession.sparkContext
    vectors = _py2java(context, with_vectors(df, vec).select(vec).rdd.map(_mllib_vector))
    vectors.persist(context._getJavaStorageLevel(StorageLevel.MEMORY_AND_DISK_DESER))

    def start(k: int, seed: int) -> np.ndarray:
        model = context._jvm.org.apache.spark.mllib.clustering.KMeans() \
            .setK(k).setSeed(seed).setMaxIterations(0).run(vectors.rdd())
        return np.array([c.toArray() for c in _java2py(context, model.clusterCenters())])

    try:
        return at_once(df, [partial(start, k, s) for k, s in wanted], 1 << 30)
    finally:
        vectors.unpersist()


def _packed(vec: str, shift: np.ndarray):
    """Arrays of a column, less ``shift``, as blocks of numbers."""
    def run(batches):
        for batch in batches:
            x = batch.column(vec).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(shift)) - shift
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i:i + BLOCK].tobytes() for i in range(0, len(x), BLOCK)], pa.binary())], ["x"])
    return run


def _moved(blocks, centers: np.ndarray, bounds: list[int]):
    """Per center the sum and number of the rows nearest to it, and per start the cost.

    ``centers`` of all starts lie under each other; a start begins at its bound. Of equally near centers
    the first one takes the row.
    """
    d = centers.shape[1]
    half = 0.5 * (centers * centers).sum(1)[:, None]
    sums, cost = np.zeros((len(centers), d + 1)), np.zeros(len(bounds) - 1)
    rows = max(1, HELD // len(centers))
    for block in blocks:
        whole = np.frombuffer(block).reshape(-1, d)
        for i in range(0, len(whole), rows):
            x = whole[i:i + rows]
            norms = (x * x).sum()
            gap = half - centers @ x.T  # half the squared distance, less half the row's squared norm
            for s, (a, b) in enumerate(zip(bounds, bounds[1:])):
                least = gap[a:b].min(axis=0)
                cost[s] += norms + 2.0 * least.sum()
                near = gap[a:b] == least
                if near.sum() != len(x):
                    near = np.arange(b - a)[:, None] == near.argmax(axis=0)
                gap[a:b] = near
            sums[:, :d] += gap @ x
            sums[:, d] += gap.sum(axis=1)
    yield sums, cost


def _settled(df: DataFrame, vec: str, starts: list[np.ndarray], iterations: int,
             tolerance: float) -> list[tuple[float, np.ndarray]]:
    """Training cost and centers that each of ``starts`` comes to by Lloyd's steps.

    The starts take their steps together: a job reads the rows once and moves the centers of all starts
    that have not settled. A start settles when none of its centers moves further than ``tolerance``; its
    cost is that of the centers before the last step, as in MLlib. Centers and sums of all starts
    are what the driver holds, once per task, and tasks are at most four per core.
    """
    context = df.sparkSession.sparkContext
    cores, shift = context.defaultParallelism, np.concatenate(starts).mean(axis=0)
    found = [(0.0, np.asarray(c) - shift) for c in starts]
    packed = with_arrays(df, vec).select(vec).mapInArrow(_packed(vec, shift), "x binary")
    packed = packed.repartition(max(cores, packed.rdd.getNumPartitions()))  # tasks of one length
    blocks = packed.rdd.map(lambda r: r[0]).persist(StorageLevel.MEMORY_AND_DISK)
    few = blocks.coalesce(4 * cores) if blocks.getNumPartitions() > 4 * cores else blocks
    left = list(range(len(found)))
    try:
        for _ in range(iterations):
            bounds = np.cumsum([0, *[len(found[s][1]) for s in left]]).tolist()
            sent = context.broadcast(np.concatenate([found[s][1] for s in left]))
            sums, costs = (sum(v) for v in zip(*few.mapPartitions(
                lambda b, c=sent, cut=bounds: _moved(b, c.value, cut)).collect()))
            sent.destroy()
            moving = []
            for s, cost, a, b in zip(left, costs, bounds, bounds[1:]):
                was, n = found[s][1], sums[a:b, -1:]
                now = np.where(n > 0, sums[a:b, :-1] / np.maximum(n, 1), was)
                found[s] = float(cost), now
                if (((now - was) ** 2).sum(axis=1) > tolerance ** 2).any():
                    moving.append(s)
            left = moving
            if not left:
                break
    finally:
        blocks.unpersist()
    return [(cost, c + shift) for cost, c in found]


def _model(df: DataFrame, centers: np.ndarray, vec: str) -> KMeansModel:
    """A k-means model of given centers."""
    spark, jvm = df.sparkSession, df.sparkSession._jvm
    parent = jvm.org.apache.spark.mllib.clustering.KMeansModel(
        _py2java(spark.sparkContext, [Vectors.dense(c) for c in centers]))
    model = KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(KMeans().uid, parent))
    return model.setFeaturesCol(vec).setPredictionCol("cluster")


def kmeans_minibatch(df: DataFrame, k: int, vec: str = "features", batch_rows: int = 1024,
                     rounds: int = 100, seed: int = 42) -> tuple[list, object]:
    """Mini-batch k-means: each round assigns about ``batch_rows`` rows and moves the centers by
    their mean.

    All rounds' rows are drawn in one pass, with replacement, and dealt to rounds; a round reads its
    share of that sample and never the table. A center moves by batch count over total count, so later
    rounds move it less.
    """
    n = max(df.count(), 1)
    start = KMeans(k=k, featuresCol=vec, maxIter=1, seed=seed).fit(
        df.sample(fraction=min(1.0, 10 * batch_rows / n), seed=seed))
    centers = np.array(start.clusterCenters())
    weight = np.zeros(len(centers))
    drawn = with_arrays(df, vec).select(vec).sample(True, rounds * batch_rows / n, seed) \
        .withColumn("_round", (F.rand(seed) * rounds).cast("int")).persist()
    try:
        for r in range(rounds):
            placed = center_distances_per_row(drawn.where(F.col("_round") == r), vec,
                                              list(range(len(centers))), centers)
            cells = placed.select("nearest", F.posexplode(vec)).groupBy("nearest", "pos") \
                .agg(F.avg("col").alias("m"), F.count(F.lit(1)).alias("n")).collect()  # k x d
            for c in cells:
                if c.pos == 0:
                    weight[c.nearest] += c.n
            for c in cells:
                centers[c.nearest, c.pos] += \
                    (c.m - centers[c.nearest, c.pos]) * c.n / weight[c.nearest]
    finally:
        drawn.unpersist()
    return list(range(len(centers))), centers


def k_search(df: DataFrame, ks: range = range(2, 11), vec: str = "features", seed: int = 42,
             seeds: int = 10, iterations: int = 300) -> DataFrame:
    """All four scores per k; ``is_best`` marks the largest silhouette.

    MLlib chooses the first centers of every start; from there all starts of all k go on together.
    """
    cached = df.persist()

    def scores(k: int, cost: float, centers: np.ndarray) -> tuple:
        placed = _model(cached, centers, vec).transform(cached)
        return (k, cost,
                float(silhouette_score(placed, vec, "cluster")),
                float(calinski_harabasz(placed, vec, "cluster").first()[0]),
                float(davies_bouldin(placed, vec, "cluster").first()[0]))

    try:
        chosen = _first_centers(cached, vec, [(k, seed + s) for k in ks for s in range(seeds)])
        settled = _settled(cached, vec, chosen, iterations, 1e-4)
        best = [min(settled[i * seeds:(i + 1) * seeds], key=lambda p: p[0]) for i in range(len(ks))]
        rows = at_once(cached, [partial(scores, k, *b) for k, b in zip(ks, best)], 1 << 30)
    finally:
        cached.unpersist()
    best = max(rows, key=lambda r: r[2])[0]
    return df.sparkSession.createDataFrame(
        [(*r, r[0] == best) for r in rows],
        "k int, inertia double, silhouette double, calinski_harabasz double, "
        "davies_bouldin double, is_best boolean")


def score_of(predictions: DataFrame, label: str, metric: str) -> float:
    """f1 and accuracy for classes, r2, mae and rmse for numbers."""
    if metric in ("f1", "accuracy"):
        return MulticlassClassificationEvaluator(labelCol=label, metricName=metric) \
            .evaluate(predictions)
    return RegressionEvaluator(labelCol=label, metricName=metric).evaluate(predictions)


def model_score(model, df: DataFrame, label: str, metric: str) -> float:
    """``score_of`` a model on ``df``; trees are walked once for all rows of a cell and class."""
    cells = tree_cells(model, df, [label]) if metric in ("f1", "accuracy") else None
    if cells is None:
        return score_of(model.transform(df), label, metric)
    return MulticlassClassificationEvaluator(labelCol=label, metricName=metric, weightCol="_n") \
        .evaluate(model.transform(cells))


def _walk(model, depths: list[int]) -> tuple | None:
    """Splits, children and class shares of the nodes of a forest, and where rows end per depth.

    A node's ``end`` at a depth is the leaf that the forest grown to that depth has there: the node itself,
    or the topmost node above it all of whose leaves predict the same. None for categorical splits.
    """
    path = scratch_path(SparkSession.active(), "forest")
    model.write().save(path)
    read = SparkSession.active().read.parquet(f"{path}/data").select("treeID", "nodeData.*").select(
        "*", "split.featureIndex", "split.numCategories",
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("cut")).drop("split").toPandas()
    nodes = read.sort_values(["treeID", "id"], ignore_index=True)
    if ((nodes["leftChild"] >= 0) & (nodes["numCategories"] != -1)).any():
        return None
    first = np.searchsorted(nodes["treeID"], np.arange(model.getNumTrees))
    base, inner = first[nodes["treeID"]], nodes["leftChild"].to_numpy() >= 0
    at = np.arange(len(nodes))
    left, right = (np.where(inner, base + nodes[c].to_numpy(), at) for c in ("leftChild", "rightChild"))
    feature = np.where(inner, nodes["featureIndex"], 0)
    cut = np.where(inner, nodes["cut"], np.inf).astype(float)
    counts = np.stack(nodes["impurityStats"].to_numpy()).astype(float)
    total = counts.sum(axis=1, keepdims=True)
    share = np.divide(counts, total, out=np.zeros_like(counts), where=total != 0)
    says, level, up = nodes["prediction"].to_numpy(), np.zeros(len(nodes), int), at.copy()
    rows, below = first, []
    while len(rows):
        below.append(rows)
        rows = rows[inner[rows]]
        for child in (left[rows], right[rows]):
            level[child], up[child] = len(below), rows
        rows = np.concatenate([left[rows], right[rows]])
    ends = []
    for depth in depths:
        leaf = ~inner | (level >= depth)
        for rows in below[:depth][::-1]:
            a, b = left[rows], right[rows]
            leaf[rows] |= leaf[a] & leaf[b] & (says[a] == says[b])
        end = at.copy()
        for rows in below[1:depth + 1]:
            above = end[up[rows]]
            end[rows] = np.where(leaf[above], above, rows)
        ends.append(end)
    return first, left, right, feature, cut, share, ends


def _pair_counts(sent, depths: list[int], columns: list[str]):
    """Numbers of rows per depth, part, class and predicted class, of each batch."""
    def run(batches):
        first, left, right, feature, cut, share, ends = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([batch.column(f"_x{i}").to_numpy(zero_copy_only=False)
                                 for i in range(len(columns))])
            row, votes = np.arange(len(x)), np.zeros((len(depths), len(x), share.shape[1]))
            for at in first:
                at = np.full(len(x), at)
                for step in range(max(depths) + 1):
                    for v in [v for v, depth in enumerate(depths) if depth == step]:
                        votes[v] += share[ends[v][at]]
                    at = np.where(x[row, feature[at]] <= cut[at], left[at], right[at])
            part, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_held", "_label"))
            for v, said in enumerate(votes.argmax(axis=2)):
                kind, n = np.unique(np.column_stack([part, label, said]).astype(float), axis=0,
                                    return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), v), pa.int32()), pa.array(kind[:, 0] > 0), pa.array(kind[:, 1]),
                     pa.array(kind[:, 2]), pa.array(n.astype(float))],
                    names=["_v", "_held", "label", "prediction", "_n"])
    return run


def _by_depth(estimators: list) -> bool:
    """Whether the estimators are forests of classes on the same numbers that only differ in their depth.

    Then the most deep one holds the others: a forest draws the features of its nodes level by level, and
    what a shallower one has as a leaf is an inner node there.
    """
    kinds = [e.getStages() if isinstance(e, Pipeline) else [] for e in estimators]
    if not all(len(s) == 2 and type(s[0]) is VectorAssembler and type(s[1]) is RandomForestClassifier
               and s[0].getHandleInvalid() == "keep" and s[0].getOutputCol() == s[1].getFeaturesCol()
               and not s[1].isSet("weightCol") and not s[1].isSet("thresholds") for s in kinds):
        return False

    def settings(stages):
        return [{p.name: v for p, v in s.extractParamMap().items() if p.name not in (
            "maxDepth", *(["outputCol"] if s is stages[0] else ["featuresCol"]))} for s in stages]
    return all(settings(s) == settings(kinds[0]) for s in kinds)


def _depth_scores(estimators: list, df: DataFrame, held: Column, label: str, metric: str) -> list | None:
    """``both_scores`` of forests that only differ in depth, from a fit of the most deep one and one pass.

    None where that fit may not hold the others: if MLlib cannot work on a whole level at once.
    """
    depths = [e.getStages()[1].getMaxDepth() for e in estimators]
    deepest = estimators[depths.index(max(depths))]
    model, columns = deepest.fit(df.where(~held)), deepest.getStages()[0].getInputCols()
    forest_ = model.stages[1]
    level = 8 * forest_.getNumTrees * 2 ** max(max(depths) - 1, 0) * len(columns) * \
        forest_.getMaxBins() * forest_.numClasses
    walked = _walk(forest_, depths) if forest_.numFeatures == len(columns) and \
        level <= forest_.getMaxMemoryInMB() << 20 else None
    if walked is None:
        return None
    sent = df.sparkSession.sparkContext.broadcast(walked)
    pairs = df.where(held.isNotNull()).select(
        held.alias("_held"), F.col(label).cast("double").alias("_label"),
        *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)]) \
        .mapInArrow(_pair_counts(sent, depths, columns),
                    "_v int, _held boolean, label double, prediction double, _n double") \
        .groupBy("_v", "_held", "label", "prediction").agg(F.sum("_n").alias("_n")).collect()
    sent.destroy()
    return [_scores_of(df, [r[1:] for r in pairs if r[0] == v], metric) for v in range(len(depths))]


def _scores_of(df: DataFrame, pairs: list, metric: str) -> tuple[float, float]:
    """Scores of the rows that are not held and of those that are, from counts per pair of classes."""
    evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName=metric, weightCol="_n")
    return tuple(float(evaluator.evaluate(df.sparkSession.createDataFrame(
        [tuple(r[1:]) for r in pairs if r[0] is part], "label double, prediction double, _n double").coalesce(1)))
        for part in (False, True))


def both_scores(model, df: DataFrame, held: Column, label: str, metric: str) -> tuple[float, float]:
    """``score_of`` a model on the rows that are not ``held`` and on those that are.

    Classes are predicted in one pass over all rows; the scores come from the counts per pair of classes.
    """
    if metric not in ("f1", "accuracy"):
        return tuple(float(score_of(model.transform(df.where(rows)), label, metric))
                     for rows in (~held, held))
    pairs = model.transform(df).groupBy(
        held.alias("_held"), F.col(label).cast("double").alias("label"), "prediction") \
        .agg(F.count(F.lit(1)).cast("double").alias("_n")).collect()
    return _scores_of(df, pairs, metric)


def cv_scores(df: DataFrame, estimator, label: str, key: str, metric: str, k: int = 5,
              stratify: bool = True, seed: int = 42) -> DataFrame:
    """Held-out score of each fold."""
    parts = folds(df, key, k, label if stratify else None, seed).persist()
    try:
        rows = []
        for i in range(k):
            model = estimator.fit(parts.where(F.col("fold") != i))
            rows.append((i, float(model_score(model, parts.where(F.col("fold") == i), label, metric))))
    finally:
        parts.unpersist()
    return df.sparkSession.createDataFrame(rows, "fold int, score double")


def validation_curve(df: DataFrame, build, values: list, label: str, key: str, metric: str,
                     k: int = 3, stratify: bool = True, seed: int = 42) -> DataFrame:
    """Training and held-out score per parameter value and fold; ``build(value)`` makes the model.

    A fit leaves the cores idle between its steps, so on a table below 128 MB fits run beside each other.
    Forests of classes that only differ in depth are scored from one fit a fold.
    """
    parts = folds(df, key, k, label if stratify else None, seed).persist()
    built = [build(v) for v in values]
    nested = len(built) > 1 and metric in ("f1", "accuracy") and _by_depth(built)

    def scores(estimator, i: int) -> tuple[float, float]:
        model = estimator.fit(parts.where(F.col("fold") != i))
        return both_scores(model, parts, F.col("fold") == i, label, metric)

    try:
        found = at_once(parts, [partial(_depth_scores, built, parts, F.col("fold") == i, label, metric)
                                for i in range(k)], 128 << 20) if nested else [None]
        if None in found:
            found = at_once(parts, [partial(scores, e, i) for i in range(k) for e in built], 128 << 20)
            found = [found[i * len(built):(i + 1) * len(built)] for i in range(k)]
        rows = [(float(v), i, *found[i][j]) for j, v in enumerate(values) for i in range(k)]
    finally:
        parts.unpersist()
    return df.sparkSession.createDataFrame(
        rows, "value double, fold int, train_score double, test_score double")


def learning_curve(df: DataFrame, estimator, label: str, key: str, metric: str,
                   fractions: list[float], k: int = 3, stratify: bool = True,
                   seed: int = 42) -> DataFrame:
    """Scores for nested training sizes and every fold."""
    parts = folds(df, key, k, label if stratify else None, seed).persist()
    rows = []
    try:
        for i in range(k):
            held = parts.where(F.col("fold") == i)
            sized = nested_sizes(parts.where(F.col("fold") != i), key, fractions, seed).persist()
            try:
                for f in fractions:
                    train = sized.where(F.col("train_fraction") == float(f))
                    model = estimator.fit(train)
                    rows.append((float(f), i,
                                 float(model_score(model, train, label, metric)),
                                 float(model_score(model, held, label, metric))))
            finally:
                sized.unpersist()
    finally:
        parts.unpersist()
    return df.sparkSession.createDataFrame(
        rows, "fraction double, fold int, train_score double, test_score double")


def recursive_elimination(df: DataFrame, build, columns: list[str], label: str, key: str,
                          metric: str, k: int = 3, stratify: bool = True, keep: int = 1,
                          seed: int = 42) -> DataFrame:
    """Drop the least important feature step by step; cross-validated score per count.

    ``build(columns)`` makes a pipeline that ends in a tree model.
    """
    left, rows = list(columns), []
    parts = folds(df, key, k, label if stratify else None, seed).persist()
    try:
        while len(left) >= keep:
            scores, weights = [], [0.0] * len(left)
            for i in range(k):
                model = build(left).fit(parts.where(F.col("fold") != i))
                held = parts.where(F.col("fold") == i)
                scores.append(float(model_score(model, held, label, metric)))
                for j, w in enumerate(model.stages[-1].featureImportances.toArray()):
                    weights[j] += float(w)
            rows.append((len(left), sum(scores) / len(scores), ",".join(left)))
            left.pop(min(range(len(left)), key=lambda j: weights[j]))
    finally:
        parts.unpersist()
    return df.sparkSession.createDataFrame(rows, "features int, score double, kept string")


def dropping_curve(df: DataFrame, build, columns: list[str], label: str, key: str, metric: str,
                   fractions: list[float], k: int = 3, stratify: bool = True,
                   seed: int = 42) -> DataFrame:
    """Score on random feature subsets of growing size."""
    out = None
    for f in fractions:
        chosen = feature_subset(columns, f, seed)
        one = cv_scores(df, build(chosen), label, key, metric, k, stratify, seed) \
            .agg(F.avg("score").alias("score")).select(
                F.lit(float(f)).alias("fraction"), F.lit(len(chosen)).alias("features"), "score")
        out = one if out is None else out.unionByName(one)
    return out


def classify(model, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Probability of the positive class and the label at a threshold."""
    scored = model.transform(df).withColumn("score", vector_to_array("probability")[1])
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def assign_clusters(df: DataFrame, vec: str, labels: list, centers) -> DataFrame:
    """Nearest center of every row."""
    return center_distances_per_row(df, vec, labels, centers) \
        .withColumnRenamed("nearest", "cluster").drop("d_own")
