"""Learners: results good enough, repeatable, and shaped as promised."""

import pytest
from pyspark.ml.functions import array_to_vector

from rtml.suite import ORACLES, QUERIES

ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def result(spark, folder):
    seen = {}

    def get(name):
        if name not in seen:
            seen[name] = QUERIES[name](spark, folder).collect()
        return seen[name]
    return get


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(name, result):
    assert len(result(name)) > 0


@pytest.mark.parametrize("name", ["gbt_classify", "logreg_balanced"])
def test_classifiers_learn(name, result):
    assert result(name)[0].roc_auc > 0.9


def test_regressor_learns(result):
    assert result("gbt_regress")[0].r2 > 0.8


def test_folds_scored(result):
    assert {r.fold for r in result("cv_scores")} == set(range(5))
    assert all(0 <= r.score <= 1 for r in result("cv_scores"))


def test_one_best_k_and_falling_cost(result):
    rows = sorted(result("kmeans_k_search"), key=lambda r: r.k)
    assert sum(r.is_best for r in rows) == 1
    assert rows[-1].inertia < rows[0].inertia


def test_variance_shares(result):
    rows = result("pca_variance")
    assert rows[-1].cumulative == pytest.approx(1.0) and rows[0].needed


def test_informative_feature_first(result):
    assert result("feature_importance")[0].feature == "k"


def test_dependence_rises(result):
    rows = sorted(result("partial_dependence"), key=lambda r: r.grid)
    assert rows[-1].average > rows[0].average


def test_decision_surface(spark):
    from pyspark.sql import functions as F
    from rtml.operators.analysis import decision_surface
    from rtml.operators.train import forest
    df = spark.range(200).select((F.col("id") % 20).cast("double").alias("a"),
                                 (F.col("id") % 7).cast("double").alias("b"),
                                 (F.col("id") % 20 > 9).cast("int").alias("y"))
    model = forest(["a", "b"], "y", True, 5, 4).fit(df)
    cells = decision_surface(model, spark, ("a", 0, 19), ("b", 0, 6), steps=20)
    assert cells.count() == 400 and cells.select("prediction").distinct().count() == 2


def test_minibatch_centers_find_separate_groups(spark):
    from rtml.operators.train import kmeans_minibatch
    rows = spark.range(3000).selectExpr("array(id % 3 * 50d + rand(1), id % 3 * -20d + rand(2)) as v") \
        .select(array_to_vector("v").alias("features"))
    _, centers = kmeans_minibatch(rows, 3, batch_rows=100, rounds=5)
    assert sorted(round(float(c[0]) / 50) for c in centers) == [0, 1, 2]
    _, few = kmeans_minibatch(rows.limit(30), 2, batch_rows=100, rounds=3)  # fewer rows than a batch
    assert len(few) == 2


def test_jobs_on_a_small_table_run_at_once_and_in_order(spark):
    import threading
    from rtml.operators.train import at_once
    together = threading.Barrier(3)
    rows = spark.range(10)
    assert at_once(rows, [lambda i=i: (together.wait(30), rows.where(f"id < {i}").count())[1]
                          for i in range(3)]) == [0, 1, 2]


def test_cells_score_as_rows_do(spark, monkeypatch):
    """Fewer rows than there are go through the trees; scores and averages are those of all rows."""
    from pyspark.sql import functions as F
    from rtml.operators import analysis as L, train as M
    df = spark.range(3000).select(
        F.when(F.col("id") % 50 > 0, F.rand(1) * 10).alias("a"),
        F.when(F.col("id") % 31 == 0, float("nan")).otherwise(F.rand(2)).alias("b"),
        (F.col("id") % 7).alias("c")).withColumn(
            "y", F.coalesce((F.col("a") + F.col("c") + F.rand(3) > 9).cast("int"), F.lit(1))).persist()
    model = M.forest(["a", "b", "c"], "y", True, 5, 4).fit(df.dropna())
    assert M.tree_cells(model, df, ["y"]).count() < 2500
    for metric in ("f1", "accuracy"):
        assert M.model_score(model, df, "y", metric) == pytest.approx(
            M.score_of(model.transform(df), "y", metric), rel=1e-12)
    for output in ("prediction", "probability"):
        found = {r.grid: r.average for r in L.partial_dependence(
            model, df, ["a", "b", "c"], "a", [0.0, 4.5, 9.0], output).collect()}
        for g, average in found.items():
            at = model.transform(df.withColumn("a", F.lit(g)))
            value = F.col(output) if output == "prediction" else L.vector_to_array(output)[1]
            assert average == pytest.approx(at.agg(F.avg(value)).first()[0], rel=1e-12)
    assert len(found) == 3


def test_starts_that_move_together_settle_where_fits_do(spark):
    """Costs and centers of MLlib's fits, one by one, from jobs that move all starts at once."""
    import numpy as np
    from pyspark.ml.clustering import KMeans
    from rtml.operators import train as M
    x = np.random.default_rng(5).normal(size=(400, 3)).round(1) + 50.0  # many rows at equal distances
    rows = spark.createDataFrame([(v.tolist(),) for v in [*x, *x[:90]]], "v array<double>") \
        .select(array_to_vector("v").alias("features")).repartition(3).persist()
    wanted = [(k, s) for k in (2, 4, 7) for s in (42, 43)]
    chosen = M._first_centers(rows, "features", wanted)
    for steps in (30, 2):
        found = M._settled(rows, "features", chosen, steps, 1e-4)
        for (k, s), (cost, centers) in zip(wanted, found):
            fit = KMeans(k=k, seed=s, maxIter=steps, tol=1e-4).fit(rows)
            assert cost == pytest.approx(fit.summary.trainingCost, rel=1e-9)
            assert np.allclose(centers, np.array(fit.clusterCenters()), atol=1e-9)
    context = spark.sparkContext
    context.setJobGroup("settle", "all starts")
    M._settled(rows, "features", chosen, 30, 1e-4)
    context.setLocalProperty("spark.jobGroup.id", None)
    assert 1 <= len(context.statusTracker().getJobIdsForGroup("settle")) <= 30  # not so many a start


def test_a_vector_without_a_place_is_refused(spark):
    from rtml.operators import train as M
    rows = spark.createDataFrame([([1.0, float("nan")],), ([1.0, 2.0],)], "v array<double>")
    with pytest.raises(Exception, match="NaN"):
        M.k_search(rows.select(array_to_vector("v").alias("features")), range(2, 3), seeds=1)


def test_fits_of_a_curve_run_beside_each_other_and_score_all_rows(spark):
    """Scores are those of fits made one by one, from one pass over all rows of a model."""
    import threading
    from pyspark.sql import functions as F
    from rtml.operators import train as M
    from rtml.operators.sample import folds
    df = spark.range(600).select("id", (F.rand(1) * 10).alias("a"), F.rand(2).alias("b")).withColumn(
        "y", (F.col("a") + 5 * F.col("b") + F.rand(3) > 8).cast("int")).persist()
    together = threading.Barrier(4)

    class Waits:
        def __init__(self, depth):
            self.inner = M.forest(["a", "b"], "y", True, 5, depth)

        def fit(self, rows):
            together.wait(60)
            return self.inner.fit(rows)

    for metric in ("f1", "accuracy"):
        found = M.validation_curve(df, Waits, [1, 3], "y", "id", metric, k=2).collect()
        parts = folds(df, "id", 2, "y").persist()
        assert [(r.value, r.fold) for r in found] == [(1, 0), (1, 1), (3, 0), (3, 1)]
        for r in found:
            train, held = parts.where(F.col("fold") != r.fold), parts.where(F.col("fold") == r.fold)
            model = M.forest(["a", "b"], "y", True, 5, int(r.value)).fit(train)
            assert r.train_score == pytest.approx(M.score_of(model.transform(train), "y", metric), rel=1e-12)
            assert r.test_score == pytest.approx(M.score_of(model.transform(held), "y", metric), rel=1e-12)


def test_depths_of_a_forest_come_from_one_fit(spark, monkeypatch):
    """A forest grown deep holds the shallow ones, which merge leaves that predict the same."""
    from pyspark.sql import functions as F
    from rtml.operators import train as M
    from rtml.operators.sample import folds
    df = spark.range(900).select(
        "id", F.round(F.rand(1) * 10, 1).alias("a"), F.rand(2).alias("b"),
        (F.col("id") % 7).alias("c")).withColumn("y", F.when(F.rand(4) < 0.15, 2).otherwise(
            (F.col("a") + 5 * F.col("b") + 4 * F.rand(3) > 9).cast("int"))).persist()
    parts = folds(df, "id", 2, "y").persist()
    wanted = {}
    for depth in (0, 1, 3, 6):
        for i in range(2):
            train, held = parts.where(F.col("fold") != i), parts.where(F.col("fold") == i)
            model = M.forest(["a", "b", "c"], "y", True, 7, depth).fit(train)
            wanted[depth, i] = [M.score_of(model.transform(p), "y", "f1") for p in (train, held)]
    fits = []
    fit = M.Pipeline._fit
    monkeypatch.setattr(M.Pipeline, "_fit", lambda self, rows: (fits.append(1), fit(self, rows))[1])
    for memory, values, n in ((256, [3, 0, 6, 1], 2), (0, [1, 2], 6)):  # 0: a level is worked on in pieces
        fits.clear()

        def build(depth):
            made = M.forest(["a", "b", "c"], "y", True, 7, depth)
            made.getStages()[1].setMaxMemoryInMB(memory)
            return made
        found = M.validation_curve(df, build, values, "y", "id", "f1", k=2).collect()
        assert len(found) == 2 * len(values) and len(fits) == n
        if memory:
            assert {(r.value, r.fold): [r.train_score, r.test_score] for r in found} == {
                k: pytest.approx(v, rel=1e-12) for k, v in wanted.items()}
