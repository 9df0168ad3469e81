"""Training, selection and scoring; iterative, so checked by rows and thresholds only."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from rtml.operators import analysis as L, train as M
from rtml.operators.encode import with_class_weight
from rtml.operators.metrics_cls import roc_auc, score_curve
from rtml.operators.metrics_reg import regression_metrics
from rtml.operators.rolling import lag_features
from rtml.operators.sample import hash_unit, random_split
from rtml.session import ensure_checkpoint_dir
from rtml.suite.base import query
from rtml.suite.roles import event_key

_X = ["k", "user_id", "hour", "weekday"]


def _rows(t):
    """Events with numeric features, a learnable label and target, and a split."""
    e = event_key(t.events).select(
        "event_id", "k", "user_id", F.hour("ts").alias("hour"), F.weekday("ts").alias("weekday"),
        "value")
    hot = (F.col("k") > 60) & (F.col("hour") > 6)
    return random_split(e.withColumns({
        "label": hot.cast("int"),
        "target": F.col("k") * 2.0 + F.col("hour") + F.col("value") / 100}), "event_id")


def _parts(t):
    rows = _rows(t)
    return rows.where("split = 'train'"), rows.where("split = 'test'")


def _with_held(train):
    """A tenth of the training rows decides when boosting stops."""
    return train.withColumn("held", hash_unit("event_id", 7) < 0.1)


@query("gbt_classify")
def gbt_classify(t):
    train, test = _parts(t)
    ensure_checkpoint_dir(t.spark)
    model = M.boosted_classifier(_X, "label", "weight", "held").fit(
        with_class_weight(_with_held(train), "label"))
    return roc_auc(score_curve(M.classify(model, test), "label", "score"))


@query("gbt_regress")
def gbt_regress(t):
    train, test = _parts(t)
    ensure_checkpoint_dir(t.spark)
    model = M.boosted_regressor(_X, "target", "held").fit(_with_held(train))
    return regression_metrics(model.transform(test), "target", "prediction")


@query("logreg_balanced")
def logreg_balanced(t):
    train, test = _parts(t)
    model = M.balanced_logistic(_X, "label", iterations=2000).fit(
        with_class_weight(train, "label"))
    return roc_auc(score_curve(M.classify(model, test), "label", "score"))


@query("forest_scores")
def forest_scores(t):
    """Every test row with its score and label at 0.5."""
    train, test = _parts(t)
    model = M.forest(_X, "label", True, trees=100, depth=10).fit(train)
    return M.classify(model, test).select("event_id", "score", "predicted")


@query("feature_importance")
def feature_importance(t):
    train, _ = _parts(t)
    model = M.forest(_X, "label", True, trees=100, depth=10).fit(train)
    return L.feature_importances(model.stages[-1], _X, train)


@query("partial_dependence")
def partial_dependence(t):
    train, _ = _parts(t)
    model = M.forest(_X, "target", False, trees=50, depth=10).fit(train)
    grid = L.grid_values(train, "k", 50)
    return L.partial_dependence(model, train, _X, "k", grid)


@query("cv_scores")
def cv_scores(t):
    rows = _rows(t).drop("split")
    return M.cv_scores(rows, M.forest(_X, "label", True, trees=50, depth=4), "label", "event_id",
                       "f1", 5)


@query("validation_curve")
def validation_curve(t):
    rows = _rows(t).drop("split")
    return M.validation_curve(rows, lambda d: M.forest(_X, "label", True, trees=50, depth=d),
                              [2, 4, 6, 8, 10], "label", "event_id", "f1", 3)


@query("learning_curve")
def learning_curve(t):
    rows = _rows(t).drop("split")
    return M.learning_curve(rows, M.forest(_X, "label", True, trees=50, depth=4), "label",
                            "event_id", "f1", [0.1, 0.325, 0.55, 0.775, 1.0], 3)


@query("recursive_elimination")
def recursive_elimination(t):
    rows = _rows(t).drop("split")
    return M.recursive_elimination(rows, lambda c: M.forest(c, "label", True, trees=50, depth=4),
                                   _X, "label", "event_id", "f1", 3)


@query("dropping_curve")
def dropping_curve(t):
    rows = _rows(t).drop("split")
    return M.dropping_curve(rows, lambda c: M.forest(c, "label", True, trees=50, depth=4), _X,
                            "label", "event_id", "f1", [0.25, 0.5, 0.75, 1.0], 3)


def _vectors(t):
    return t.embeddings.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>"))
                               .alias("features"))


@query("kmeans_k_search")
def kmeans_k_search(t):
    return M.k_search(_vectors(t))


@query("kmeans_minibatch")
def kmeans_minibatch(t):
    labels, centers = M.kmeans_minibatch(_vectors(t), 5)
    return M.assign_clusters(_vectors(t), "features", labels, centers) \
        .select("vec_id", "cluster", "d_nearest")


@query("seasonal_forecast")
def seasonal_forecast(t):
    """Lag features per event type and a linear model on them, scored on the later fifth."""
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import LinearRegression
    rows = event_key(t.events).select("event_id", "event_type", F.col("k").cast("double")
                                      .alias("y"))
    inputs = [f"lag_{i}" for i in range(1, 8)]
    lagged = lag_features(rows, ["event_type"], "event_id", "y").na.drop("any", subset=inputs)
    cut = lagged.approxQuantile("event_id", [0.8], 0.001)[0]
    model = Pipeline(stages=[M.assembler(inputs), LinearRegression(
        featuresCol="features", labelCol="y", regParam=0.01)]).fit(
            lagged.where(F.col("event_id") <= cut))
    return regression_metrics(model.transform(lagged.where(F.col("event_id") > cut)), "y",
                              "prediction")
