"""Classification, regression and clustering metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rtml.operators import metrics_clu as U, metrics_cls as C, metrics_reg as G
from rtml.suite.base import query
from rtml.suite.roles import PAIRS_SQL, SCORED_SQL, regression_pairs, scored

_CELLS = f"""(SELECT count(*) FILTER (y = 1 AND yhat = 1)::DOUBLE AS tp,
 count(*) FILTER (y = 0 AND yhat = 1)::DOUBLE AS fp, count(*) FILTER (y = 1 AND yhat = 0)::DOUBLE AS fn,
 count(*) FILTER (y = 0 AND yhat = 0)::DOUBLE AS tn, count(*)::DOUBLE AS n FROM {SCORED_SQL})"""
_CURVE = f"""(SELECT p AS threshold, sum(y) AS pos, count(*) - sum(y) AS neg,
 sum(sum(y)) OVER w AS tp, sum(count(*) - sum(y)) OVER w AS fp, sum(sum(y)) OVER () AS p_all,
 sum(count(*) - sum(y)) OVER () AS n_all FROM {SCORED_SQL} GROUP BY p WINDOW w AS (ORDER BY p DESC))"""


def _curve(t):
    return C.score_curve(scored(t.lineitem), "y", "p")


@query("confusion_matrix", f"SELECT y AS actual, yhat AS predicted, count(*) AS n FROM {SCORED_SQL} "
       "GROUP BY 1, 2", i="actual predicted")
def confusion_matrix(t):
    return C.confusion_counts(scored(t.lineitem), "y", "yhat")


@query("confusion_normalized", f"""SELECT y AS actual, yhat AS predicted, count(*) AS n,
 count(*) / sum(count(*)) OVER (PARTITION BY y) AS share FROM {SCORED_SQL} GROUP BY 1, 2""",
       d="share", i="actual predicted")
def confusion_normalized(t):
    return C.confusion_normalized(scored(t.lineitem), "y", "yhat")


@query("class_prediction_error", f"""SELECT y AS actual, count(*) FILTER (yhat = 0) AS predicted_0,
 count(*) FILTER (yhat = 1) AS predicted_1 FROM {SCORED_SQL} GROUP BY 1""", i="actual")
def class_prediction_error(t):
    return C.class_prediction_error(scored(t.lineitem), "y", "yhat", [0, 1])


@query("class_metrics", f"""SELECT tp, fp, fn, tn, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
 2 * tp / (2 * tp + fp + fn) AS f1, 5 * tp / (5 * tp + 4 * fn + fp) AS fbeta, (tp + tn) / n AS accuracy,
 (tp / (tp + fn) + tn / (tn + fp)) / 2 AS balanced_accuracy, (tp * tn - fp * fn) /
 sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) AS mcc, ((tp + tn) / n - e) / (1 - e) AS cohen_kappa,
 tp / (tp + fp + fn) AS jaccard, sqrt(tp / (tp + fn) * tn / (tn + fp)) AS geometric_mean FROM
 (SELECT *, ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n) AS e FROM {_CELLS})""",
       i="tp fp fn tn", d="precision recall f1 fbeta accuracy balanced_accuracy mcc cohen_kappa "
                          "jaccard geometric_mean")
def class_metrics(t):
    return C.class_metrics(scored(t.lineitem), "y", "yhat")


@query("likelihood_ratios", f"""SELECT (tp / (tp + fn)) / (1 - tn / (tn + fp)) AS lr_positive,
 (1 - tp / (tp + fn)) / (tn / (tn + fp)) AS lr_negative FROM {_CELLS}""",
       d="lr_positive lr_negative")
def likelihood_ratios(t):
    return C.likelihood_ratios(scored(t.lineitem), "y", "yhat")


_REPORT = """(SELECT c AS label, tp, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
 CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
 CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1, tp + fn AS support FROM
 (SELECT c, count(*) FILTER (a = c AND p = c) AS tp, count(*) FILTER (a <> c AND p = c) AS fp,
 count(*) FILTER (a = c AND p <> c) AS fn FROM (SELECT l_returnflag AS a, CASE WHEN l_tax > 0.05 THEN 'R'
 WHEN l_discount > 0.05 THEN 'A' ELSE 'N' END AS p FROM lineitem), (VALUES ('A'), ('N'), ('R')) v(c)
 GROUP BY c))"""


@query("classification_report", f"""SELECT label, precision, recall, f1, support FROM {_REPORT} UNION ALL
 SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM {_REPORT} UNION ALL
 SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
 sum(f1 * support) / sum(support), sum(support) FROM {_REPORT} UNION ALL SELECT 'accuracy',
 sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM {_REPORT}""",
       d="precision recall f1", i="support", digits=4)
def classification_report(t):
    rows = t.lineitem.select(F.col("l_returnflag").alias("a"), F.when(F.col("l_tax") > 0.05, "R")
                             .when(F.col("l_discount") > 0.05, "A").otherwise("N").alias("p"))
    return C.classification_report(rows, "a", "p")


@query("roc_points", f"SELECT threshold, fp / n_all AS fpr, tp / p_all AS tpr FROM {_CURVE}",
       d="threshold fpr tpr")
def roc_points(t):
    return C.roc_points(_curve(t))


@query("roc_auc", f"""SELECT sum(neg * (tp - pos + pos / 2.0)) / (max(p_all) * max(n_all)) AS roc_auc
 FROM {_CURVE}""", d="roc_auc")
def roc_auc(t):
    return C.roc_auc(_curve(t))


@query("roc_auc_50", f"""SELECT sum(neg * (tp - pos + pos / 2.0)) / (max(p_all) * max(n_all)) AS roc_auc FROM
 (SELECT k, sum(y) AS pos, count(*) - sum(y) AS neg, sum(sum(y)) OVER (ORDER BY k DESC) AS tp,
 sum(sum(y)) OVER () AS p_all, sum(count(*) - sum(y)) OVER () AS n_all FROM (SELECT y,
 (SELECT max(g) FROM range(0, 50) r(g) WHERE g / 49.0::DOUBLE <= p) AS k FROM {SCORED_SQL}) GROUP BY k)""",
       d="roc_auc")
def roc_auc_50(t):
    return C.roc_auc_fixed(scored(t.lineitem), "y", "p", 50)


@query("pr_points", f"""SELECT threshold, tp / (tp + fp) AS precision, tp / p_all AS recall
 FROM {_CURVE}""", d="threshold precision recall")
def pr_points(t):
    return C.pr_points(_curve(t))


@query("pr_average_precision", f"""SELECT sum(pos / p_all * (tp / (tp + fp))) AS average_precision
 FROM {_CURVE}""", d="average_precision")
def pr_average_precision(t):
    return C.average_precision(_curve(t))


@query("det_points", f"SELECT threshold, fp / n_all AS fpr, 1 - tp / p_all AS fnr FROM {_CURVE}",
       d="threshold fpr fnr")
def det_points(t):
    return C.det_points(_curve(t))


_TABLE = f"""(SELECT threshold, tp, fp, p_all - tp AS fn, n_all - fp AS tn, tp / (tp + fp) AS precision,
 tp / p_all AS recall, 2 * tp / (tp + fp + p_all) AS fscore, (tp + fp) / (p_all + n_all) AS queue_rate
 FROM {_CURVE})"""


@query("threshold_table", f"SELECT * FROM {_TABLE}", i="tp fp fn tn",
       d="threshold precision recall fscore queue_rate")
def threshold_table(t):
    return C.threshold_table(_curve(t))


@query("best_threshold", f"""SELECT threshold, fscore, precision, recall, queue_rate FROM {_TABLE}
 ORDER BY round(fscore, 12) DESC, threshold LIMIT 1""",
       d="threshold fscore precision recall queue_rate")
def best_threshold(t):
    return C.best_threshold(_curve(t))


@query("threshold_trials")
def threshold_trials(t):
    """Best thresholds on repeated hold-outs of the events."""
    from rtml.suite.roles import ordered_errors
    return C.threshold_trials(ordered_errors(t.events), "hit", "score", "event_id", trials=10)


@query("ks_statistic", f"""SELECT round(abs(tp / p_all - fp / n_all), 12) AS ks, threshold FROM {_CURVE}
 ORDER BY 1 DESC, 2 DESC LIMIT 1""", d="ks threshold")
def ks_statistic(t):
    return C.ks_statistic(_curve(t))


@query("gain_lift", f"""SELECT threshold, (tp + fp) / (p_all + n_all) AS population, tp / p_all AS gain,
 (tp / p_all) / ((tp + fp) / (p_all + n_all)) AS lift FROM {_CURVE}""",
       d="threshold population gain lift")
def gain_lift(t):
    return C.gain_lift(_curve(t))


@query("calibration_bins", f"""SELECT least(floor(p * 10), 9) AS bin, count(*) AS n, avg(p) AS mean_score,
 avg(y) AS positive_share FROM {SCORED_SQL} GROUP BY 1""", d="mean_score positive_share", i="bin")
def calibration_bins(t):
    return C.calibration_bins(scored(t.lineitem), "y", "p", 10)


@query("calibration_quantile_bins", f"""SELECT len(list_filter(q, lambda e: p > e)) AS bin, count(*) AS n,
 avg(p) AS mean_score, avg(y) AS positive_share FROM {SCORED_SQL}, (SELECT quantile_cont(p,
 [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM {SCORED_SQL}) GROUP BY 1""",
       d="mean_score positive_share", i="bin")
def calibration_quantile_bins(t):
    return C.calibration_bins(scored(t.lineitem), "y", "p", 10, "quantile")


@query("prob_losses", f"""SELECT log_loss, brier, 1 - log_loss / -(r * ln(r) + (1 - r) * ln(1 - r))
 AS d2_log_loss, 1 - brier / (r * (1 - r)) AS d2_brier FROM (SELECT avg(y) AS r, avg((p - y) * (p - y))
 AS brier, avg(-(y * ln(q) + (1 - y) * ln(1 - q))) AS log_loss FROM (SELECT y, p,
 least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS q FROM {SCORED_SQL}))""",
       d="log_loss brier d2_log_loss d2_brier")
def prob_losses(t):
    return C.prob_losses(scored(t.lineitem), "y", "p")


def _multi_curve(label: str) -> str:
    return f"""SELECT '{label}' AS curve, sum(neg * (tp - pos + pos / 2.0)) / (max(p_all) * max(n_all))
 AS roc_auc, sum(pos / p_all * (tp / (tp + fp))) AS average_precision FROM (SELECT s, sum(h) AS pos,
 count(*) - sum(h) AS neg, sum(sum(h)) OVER w AS tp, sum(count(*) - sum(h)) OVER w AS fp,
 sum(sum(h)) OVER () AS p_all, sum(count(*) - sum(h)) OVER () AS n_all FROM long
 WHERE '{label}' IN (c, 'micro') GROUP BY s WINDOW w AS (ORDER BY s DESC))"""


@query("multiclass_auc", f"""WITH long AS (SELECT 'A' AS c, (l_returnflag = 'A')::INT AS h,
 l_discount * 10 AS s FROM lineitem UNION ALL SELECT 'N', (l_returnflag = 'N')::INT, l_tax * 12 FROM lineitem
 UNION ALL SELECT 'R', (l_returnflag = 'R')::INT, 1 - l_discount * 10 FROM lineitem), each AS (
 {_multi_curve("A")} UNION ALL {_multi_curve("N")} UNION ALL {_multi_curve("R")}), micro AS (
 {_multi_curve("micro")}) SELECT * FROM each UNION ALL SELECT * FROM micro UNION ALL
 SELECT 'macro', avg(roc_auc), avg(average_precision) FROM each""", d="roc_auc average_precision")
def multiclass_auc(t):
    rows = t.lineitem.select("l_returnflag", (F.col("l_discount") * 10).alias("a"),
                             (F.col("l_tax") * 12).alias("n"),
                             (1 - F.col("l_discount") * 10).alias("r"))
    return C.multiclass_auc(rows, "l_returnflag", {"A": "a", "N": "n", "R": "r"})


@query("regression_metrics", f"""SELECT mae, mse, sqrt(mse) AS rmse, 1 - mse / vy AS r2,
 1 - ve / vy AS explained_variance, max_error FROM (SELECT avg(abs(y - yhat)) AS mae,
 avg((y - yhat) ** 2) AS mse, max(abs(y - yhat)) AS max_error, var_pop(y - yhat) AS ve,
 var_pop(y) AS vy FROM {PAIRS_SQL})""", d="mae mse rmse r2 explained_variance max_error", digits=4)
def regression_metrics(t):
    return G.regression_metrics(regression_pairs(t.lineitem), "y", "yhat")


@query("percentage_errors", f"""SELECT avg(abs((y - yhat) / y)) FILTER (y <> 0) * 100 AS mape,
 avg(2 * abs(yhat - y) / (abs(y) + abs(yhat))) FILTER (abs(y) + abs(yhat) <> 0) * 100 AS smape
 FROM {PAIRS_SQL}""", d="mape smape")
def percentage_errors(t):
    return G.percentage_errors(regression_pairs(t.lineitem), "y", "yhat")


@query("robust_errors", f"SELECT quantile_cont(abs(y - yhat), 0.5) AS median_ae FROM {PAIRS_SQL}",
       d="median_ae", digits=4)
def robust_errors(t):
    return G.median_absolute_error(regression_pairs(t.lineitem), "y", "yhat")


@query("log_errors", f"""SELECT avg((ln(1 + y) - ln(1 + yhat)) ** 2) AS msle,
 sqrt(avg((ln(1 + y) - ln(1 + yhat)) ** 2)) AS rmsle FROM {PAIRS_SQL}""", d="msle rmsle")
def log_errors(t):
    return G.log_errors(regression_pairs(t.lineitem), "y", "yhat")


@query("deviances", f"""SELECT avg(2 * (y * ln(y / yhat) - y + yhat)) AS poisson,
 avg(2 * (ln(yhat / y) + y / yhat - 1)) AS gamma, avg(2 * (y ** 0.5 / (-0.5 * 0.5) -
 y * yhat ** -0.5 / -0.5 + yhat ** 0.5 / 0.5)) AS tweedie FROM {PAIRS_SQL}""",
       d="poisson gamma tweedie", digits=4)
def deviances(t):
    return G.deviances(regression_pairs(t.lineitem), "y", "yhat")


@query("d2_scores", f"""SELECT pinball, 1 - mae / mae0 AS d2_absolute, 1 - pinball / (mae0 / 2) AS d2_pinball,
 1 - tw / tw0 AS d2_tweedie FROM (SELECT avg(abs(y - yhat)) AS mae, avg(abs(y - yhat)) / 2 AS pinball,
 avg(abs(y - med)) AS mae0, avg(2 * (y ** 0.5 / -0.25 + y * yhat ** -0.5 / 0.5 + yhat ** 0.5 / 0.5)) AS tw,
 avg(2 * (y ** 0.5 / -0.25 + y * m ** -0.5 / 0.5 + m ** 0.5 / 0.5)) AS tw0 FROM {PAIRS_SQL},
 (SELECT quantile_cont(y, 0.5) AS med, avg(y) AS m FROM {PAIRS_SQL}))""",
       d="pinball d2_absolute d2_pinball d2_tweedie", digits=4)
def d2_scores(t):
    return G.d2_scores(regression_pairs(t.lineitem), "y", "yhat")


@query("residual_histogram", f"""SELECT l_linestatus, least(floor((r - lo) / ((hi - lo) / 50)) + 1, 50) AS bin,
 count(*) AS n, avg(r) AS mean_residual FROM (SELECT y - yhat AS r, l_linestatus FROM {PAIRS_SQL}),
 (SELECT min(y - yhat) AS lo, max(y - yhat) AS hi FROM {PAIRS_SQL}) GROUP BY 1, 2""",
       d="mean_residual", i="bin", digits=3)
def residual_histogram(t):
    return G.residual_histogram(regression_pairs(t.lineitem), "y", "yhat", 50, ["l_linestatus"])


@query("fit_line", f"""SELECT regr_slope(yhat, y) AS slope, regr_intercept(yhat, y) AS intercept,
 regr_r2(yhat, y) AS r2 FROM {PAIRS_SQL}""", d="slope intercept r2", digits=4)
def fit_line(t):
    return G.fit_line(regression_pairs(t.lineitem), "y", "yhat")


_LONG = """WITH x AS (SELECT vec_id, label, unnest(range(64)) AS dim,
 unnest(embedding)::DOUBLE AS v FROM embeddings), c AS (SELECT label, dim, avg(v) AS m, count(*) AS n
 FROM x GROUP BY label, dim)"""
_DIST = _LONG + """, d AS (SELECT x.vec_id, x.label, c.label AS center, sqrt(sum((v - m) ** 2)) AS dist
 FROM x JOIN c USING (dim) GROUP BY ALL)"""


@query("inertia", f"""{_DIST} SELECT sum(best * best) AS inertia FROM (SELECT min(dist) AS best FROM d
 GROUP BY vec_id)""", d="inertia", digits=5)
def inertia(t):
    return U.inertia(t.embeddings, "embedding", "label")


@query("calinski_harabasz", f"""{_LONG}, g AS (SELECT dim, avg(v) AS gm FROM x GROUP BY dim)
 SELECT ((SELECT sum(n * (m - gm) ** 2) FROM c JOIN g USING (dim)) / (k - 1)) /
 ((SELECT sum((v - m) ** 2) FROM x JOIN c USING (label, dim)) / (n - k)) AS calinski_harabasz FROM
 (SELECT count(*) AS n, count(DISTINCT label) AS k FROM embeddings)""", d="calinski_harabasz",
       digits=5)
def calinski_harabasz(t):
    return U.calinski_harabasz(t.embeddings, "embedding", "label")


@query("davies_bouldin", f"""{_DIST}, s AS (SELECT label, avg(dist) AS s FROM d WHERE label = center
 GROUP BY label), m AS (SELECT a.label AS a, b.label AS b, sqrt(sum((a.m - b.m) ** 2)) AS dist FROM c a
 JOIN c b ON a.dim = b.dim AND a.label <> b.label GROUP BY 1, 2) SELECT avg(r) AS davies_bouldin FROM
 (SELECT max((sa.s + sb.s) / dist) AS r FROM m JOIN s sa ON sa.label = a JOIN s sb ON sb.label = b
 GROUP BY a)""", d="davies_bouldin", digits=5)
def davies_bouldin(t):
    return U.davies_bouldin(t.embeddings, "embedding", "label")


@query("center_distances", f"""{_LONG} SELECT a.label AS cluster_a, b.label AS cluster_b,
 max(a.n) AS size_a, max(b.n) AS size_b, sqrt(sum((a.m - b.m) ** 2)) AS distance FROM c a JOIN c b
 ON a.dim = b.dim AND a.label < b.label GROUP BY 1, 2""", d="distance", i="cluster_a cluster_b")
def center_distances(t):
    return U.center_distances(t.embeddings, "embedding", "label")


@query("stream_silhouette", f"""{_DIST} SELECT sum(own) / sum(second) AS stream_silhouette FROM
 (SELECT vec_id, min(dist) FILTER (label = center) AS own, list_sort(list(dist))[2] AS second FROM d
 GROUP BY vec_id)""", d="stream_silhouette")
def stream_silhouette(t):
    return U.stream_silhouette(t.embeddings, "embedding", "label")


@query("nearest_center", f"""{_DIST} SELECT vec_id, arg_min(center, dist) AS nearest,
 min(dist) AS d_nearest FROM d GROUP BY vec_id""", d="d_nearest", i="nearest")
def nearest_center(t):
    labels, centers, _ = U.centers_of(t.embeddings, "embedding", "label")
    placed = U.center_distances_per_row(t.embeddings, "embedding", labels, centers)
    return placed.select("vec_id", "nearest", "d_nearest")


@query("silhouette_by_cluster", """WITH x AS (SELECT vec_id, label, embedding::DOUBLE[64] AS e FROM
 embeddings), m AS (SELECT a.vec_id, a.label AS own, b.label AS other, CASE WHEN a.label = b.label THEN
 sum(array_distance(a.e, b.e) ** 2) / (count(*) - 1) ELSE avg(array_distance(a.e, b.e) ** 2) END AS d
 FROM x a, x b GROUP BY 1, 2, 3), s AS (SELECT vec_id, own, max(d) FILTER (own = other) AS i,
 min(d) FILTER (own <> other) AS o FROM m GROUP BY 1, 2) SELECT own AS label, count(*) AS n,
 avg((o - i) / greatest(o, i)) AS avg_silhouette, min((o - i) / greatest(o, i)) AS min_silhouette,
 max((o - i) / greatest(o, i)) AS max_silhouette FROM s GROUP BY 1""", i="label",
       d="avg_silhouette min_silhouette max_silhouette")
def silhouette_by_cluster(t):
    """The SQL side forms all pairs; the Spark side is linear."""
    return U.silhouette_by_cluster(t.embeddings, "embedding", "label")


_SIL = """(SELECT vec_id, (o - i) / greatest(o, i) AS s FROM (SELECT vec_id,
 max(d) FILTER (own = other) AS i, min(d) FILTER (own <> other) AS o FROM
 (SELECT a.vec_id, a.label AS own, b.label AS other,
 CASE WHEN a.label = b.label THEN sum({d}) / (count(*) - 1) ELSE avg({d}) END AS d
 FROM (SELECT vec_id, label, embedding::DOUBLE[64] AS e FROM embeddings) a,
 (SELECT vec_id, label, embedding::DOUBLE[64] AS e FROM embeddings) b GROUP BY 1, 2, 3) GROUP BY 1))"""


@query("silhouette_euclidean", f"SELECT vec_id, s AS silhouette FROM "
       f"{_SIL.format(d='array_distance(a.e, b.e)')}", d="silhouette")
def silhouette_euclidean(t):
    return U.silhouette_euclidean(t.embeddings, "embedding", "label", "vec_id") \
        .select("vec_id", "silhouette")


@query("silhouette_evaluator", f"SELECT avg(s) AS silhouette FROM "
       f"{_SIL.format(d='array_distance(a.e, b.e) ** 2')}", d="silhouette")
def silhouette_evaluator(t):
    score = U.silhouette_score(t.embeddings, "embedding", "label")
    return t.spark.createDataFrame([(score,)], "silhouette double")
