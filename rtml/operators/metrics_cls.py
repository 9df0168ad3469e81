"""Classification metrics and score curves.

All curve metrics share one table of counts per distinct score with chunked running totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rtml.plans.prefix import CHUNK, exact_quantiles, quantile_bounds, running_totals, with_chunk


def _ratio(a: Column, b: Column) -> Column:
    """a / b with 0 for a zero denominator."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("actual"), F.col(yhat).alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("n"))


def confusion_normalized(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Counts and their share of the true class."""
    counts = confusion_counts(df, y, yhat)
    rows = counts.groupBy(F.col("actual").alias("_a")).agg(F.sum("n").alias("_t"))
    return counts.join(rows, F.col("actual").eqNullSafe(F.col("_a"))).select(
        "actual", "predicted", "n", (F.col("n") / F.col("_t")).alias("share"))


def class_prediction_error(df: DataFrame, y: str, yhat: str, classes: list) -> DataFrame:
    """Predicted counts in columns, one row per true class."""
    counts = confusion_counts(df, y, yhat)
    return counts.groupBy("actual").agg(*[
        F.coalesce(F.sum(F.when(F.col("predicted") == F.lit(c), F.col("n"))), F.lit(0))
        .cast("long").alias(f"predicted_{c}") for c in classes])


def _binary(df: DataFrame, y: str, yhat: str, by: list[str]) -> DataFrame:
    a, p = F.col(y) == 1, F.col(yhat) == 1
    return df.groupBy(*by).agg(
        F.count_if(a & p).alias("tp"), F.count_if(~a & p).alias("fp"),
        F.count_if(a & ~p).alias("fn"), F.count_if(~a & ~p).alias("tn"))


def binary_rates(tp: Column, fp: Column, fn: Column, tn: Column,
                 beta: float = 2.0) -> dict[str, Column]:
    """Metric expressions over the four cells."""
    tp, fp, fn, tn = (c.cast("double") for c in (tp, fp, fn, tn))
    n = tp + fp + fn + tn
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    specificity = _ratio(tn, tn + fp)
    b2 = beta * beta
    agree = _ratio(tp + tn, n)
    chance = _ratio((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp), n * n)
    return {
        "precision": precision, "recall": recall,
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "fbeta": _ratio((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp),
        "accuracy": agree, "balanced_accuracy": (recall + specificity) / 2,
        "mcc": _ratio(tp * tn - fp * fn,
                      F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))),
        "cohen_kappa": _ratio(agree - chance, 1 - chance),
        "jaccard": _ratio(tp, tp + fp + fn),
        "geometric_mean": F.sqrt(recall * specificity),
    }


def class_metrics(df: DataFrame, y: str, yhat: str, beta: float = 2.0,
                  by: list[str] | None = None) -> DataFrame:
    """Cells and every threshold metric in one aggregation, per group if asked."""
    cells = _binary(df, y, yhat, by or [])
    rates = binary_rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"), beta)
    return cells.select("*", *[c.alias(n) for n, c in rates.items()])


def likelihood_ratios(df: DataFrame, y: str, yhat: str) -> DataFrame:
    cells = _binary(df, y, yhat, [])
    sens = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn"))
    spec = F.try_divide(F.col("tn").cast("double"), F.col("tn") + F.col("fp"))
    return cells.select(F.try_divide(sens, 1 - spec).alias("lr_positive"),
                        F.try_divide(1 - sens, spec).alias("lr_negative"))


def classification_report(df: DataFrame, y: str, yhat: str, decimals: int = 4) -> DataFrame:
    """Precision, recall, F1, support per class, then accuracy, macro and weighted averages."""
    cells = confusion_counts(df, y, yhat)
    a, p, n, zero = F.col("actual").cast("string"), F.col("predicted").cast("string"), \
        F.col("n"), F.lit(0).cast("long")

    def part(cls, tp, fp, fn):
        return F.struct(cls.alias("label"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))

    split = F.when(a == p, F.array(part(a, n, zero, zero))) \
        .otherwise(F.array(part(a, zero, zero, n), part(p, zero, n, zero)))
    per = cells.select(F.explode(split).alias("c")).groupBy("c.label").agg(
        F.sum("c.tp").alias("tp"), F.sum("c.fp").alias("fp"), F.sum("c.fn").alias("fn"))
    scored = per.select(
        "label", _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
        (F.col("tp") + F.col("fn")).alias("support"), "tp")

    def line(label, weight):
        return F.struct(label.alias("label"), weight.cast("double").alias("w"))

    lines = scored.withColumnRenamed("label", "_class").withColumn("l", F.explode(F.array(
        line(F.col("_class"), F.lit(1)), line(F.lit("macro avg"), F.lit(1)),
        line(F.lit("weighted avg"), F.col("support")))))
    averaged = lines.groupBy(F.col("l.label").alias("label")).agg(
        *[_ratio(F.sum(F.col(m) * F.col("l.w")), F.sum("l.w")).alias(m)
          for m in ("precision", "recall", "f1")], F.sum("support").alias("support"))
    accuracy = scored.agg(_ratio(F.sum("tp"), F.sum("support")).alias("v"),
                          F.sum("support").alias("support")) \
        .select(F.lit("accuracy").alias("label"), F.col("v").alias("precision"),
                F.col("v").alias("recall"), F.col("v").alias("f1"), "support")
    return averaged.unionByName(accuracy).select(
        "label", *[F.round(m, decimals).alias(m) for m in ("precision", "recall", "f1")],
        "support")


def score_curve(df: DataFrame, y: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Counts per distinct score and totals at or above it: threshold, pos, neg, tp, fp, p_all, n_all."""
    by = by or []
    present = df.where(F.col(score).isNotNull() & F.col(y).isNotNull())
    bounds = quantile_bounds(present, score)
    counts = present.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    run = running_totals(with_chunk(counts, "threshold", bounds), by,
                         [F.col("threshold").desc()],
                         {"tp": F.col("pos"), "fp": F.col("neg")}, descending=True).drop(CHUNK)
    if not by:
        totals = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("t"))
        return run.withColumn("_t", totals.scalar()).select(
            "threshold", "pos", "neg", "tp", "fp",
            F.col("_t.p").alias("p_all"), F.col("_t.n").alias("n_all"))
    totals = counts.groupBy(*[F.col(k).alias(f"_t_{k}") for k in by]).agg(
        F.sum("pos").alias("p_all"), F.sum("neg").alias("n_all"))
    match = None
    for k in by:
        same = F.col(k).eqNullSafe(F.col(f"_t_{k}"))
        match = same if match is None else match & same
    return run.join(totals, match).select(*by, "threshold", "pos", "neg", "tp", "fp",
                                          "p_all", "n_all")


def roc_points(curve: DataFrame) -> DataFrame:
    return curve.select("threshold", _ratio(F.col("fp"), F.col("n_all")).alias("fpr"),
                        _ratio(F.col("tp"), F.col("p_all")).alias("tpr"))


def _auc(pos: Column, neg: Column, tp: Column, p_all: Column, n_all: Column) -> Column:
    """Trapezoid area: each negative beats the positives above it and half of those tied."""
    area = F.sum(neg.cast("double") * (tp - pos + pos / 2.0))
    return F.try_divide(area, F.max(p_all).cast("double") * F.max(n_all))


def roc_auc(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    return curve.groupBy(*(by or [])).agg(_auc(
        F.col("pos"), F.col("neg"), F.col("tp"), F.col("p_all"), F.col("n_all")).alias("roc_auc"))


def pr_points(curve: DataFrame) -> DataFrame:
    return curve.select("threshold",
                        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                        _ratio(F.col("tp"), F.col("p_all")).alias("recall"))


def _precision_area() -> Column:
    return F.sum(F.try_divide(F.col("pos").cast("double"), F.col("p_all")) *
                 _ratio(F.col("tp"), F.col("tp") + F.col("fp")))


def average_precision(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sum over thresholds of recall gain times precision."""
    return curve.groupBy(*(by or [])).agg(_precision_area().alias("average_precision"))


def det_points(curve: DataFrame) -> DataFrame:
    return curve.select("threshold", _ratio(F.col("fp"), F.col("n_all")).alias("fpr"),
                        (1 - _ratio(F.col("tp"), F.col("p_all"))).alias("fnr"))


def threshold_table(curve: DataFrame, beta: float = 1.0) -> DataFrame:
    """Confusion cells, precision, recall, F and queue rate when predicting at each threshold."""
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("p_all") - tp, F.col("n_all") - fp
    rates = binary_rates(tp, fp, fn, tn, beta)
    return curve.select("threshold", "tp", "fp", fn.alias("fn"), tn.alias("tn"),
                        rates["precision"].alias("precision"), rates["recall"].alias("recall"),
                        rates["fbeta"].alias("fscore"),
                        _ratio(tp + fp, F.col("p_all") + F.col("n_all")).alias("queue_rate"))


def best_threshold(curve: DataFrame, beta: float = 1.0) -> DataFrame:
    """Threshold of the largest F score; the lowest threshold wins a tie."""
    table = threshold_table(curve, beta)
    return table.agg(F.max(F.struct(
        F.round("fscore", 12).alias("fscore"), (-F.col("threshold")).alias("_t"), "precision",
        "recall", "queue_rate")).alias("b")).select(
        (-F.col("b._t")).alias("threshold"), F.col("b.fscore").alias("fscore"),
        F.col("b.precision").alias("precision"), F.col("b.recall").alias("recall"),
        F.col("b.queue_rate").alias("queue_rate"))


def threshold_trials(df: DataFrame, y: str, score: str, key: str, trials: int = 10,
                     test_size: float = 0.1) -> DataFrame:
    """Best threshold on repeated stratified hold-outs: one row per trial."""
    from rtml.operators.sample import stratified_split
    parts = None
    for t in range(trials):
        held = stratified_split(df.select(y, score, key), y, key, test_size, seed=t) \
            .where("split = 'test'")
        one = best_threshold(score_curve(held, y, score)).select(F.lit(t).alias("trial"), "*")
        parts = one if parts is None else parts.unionByName(one)
    return parts


def ks_statistic(curve: DataFrame) -> DataFrame:
    gap = F.abs(_ratio(F.col("tp"), F.col("p_all")) - _ratio(F.col("fp"), F.col("n_all")))
    return curve.agg(F.max(F.struct(F.round(gap, 12).alias("ks"),
                                    F.col("threshold").alias("t"))).alias("b")) \
        .select(F.col("b.ks").alias("ks"), F.col("b.t").alias("threshold"))


def gain_lift(curve: DataFrame) -> DataFrame:
    """Share of the population at or above each score, gain of positives and lift."""
    share = _ratio(F.col("tp") + F.col("fp"), F.col("p_all") + F.col("n_all"))
    gain = _ratio(F.col("tp"), F.col("p_all"))
    return curve.select("threshold", share.alias("population"), gain.alias("gain"),
                        F.try_divide(gain, share).alias("lift"))


def roc_auc_fixed(df: DataFrame, y: str, score: str, thresholds: int = 50) -> DataFrame:
    """AUC over a fixed grid of thresholds in [0, 1]: the streaming approximation.

    Each row is counted once under the highest grid point it reaches; the curve is a suffix sum
    over that fixed grid.
    """
    last = thresholds - 1
    k = F.floor(F.col(score) * last)
    k = k - (k / F.lit(float(last)) > F.col(score)).cast("int") \
        + ((k + 1) / F.lit(float(last)) <= F.col(score)).cast("int")
    counts = df.groupBy(F.least(F.greatest(k, F.lit(-1)), F.lit(last)).alias("k")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    from pyspark.sql import Window
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("k").desc())  # at most thresholds + 1 rows
    run = counts.select("pos", "neg", F.sum("pos").over(w).alias("tp"))
    sums = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("t"))
    return run.withColumn("_t", sums.scalar()).agg(
        _auc(F.col("pos"), F.col("neg"), F.col("tp"), F.col("_t.p"), F.col("_t.n"))
        .alias("roc_auc"))


def one_vs_rest(df: DataFrame, y: str, scores: dict) -> DataFrame:
    """Long form ``(label, hit, score)`` for per-class and micro curves; ``scores``: class to column."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(str(c)).alias("label"),
                 (F.col(y).cast("string") == F.lit(str(c))).cast("int").alias("hit"),
                 F.col(col).cast("double").alias("score"))
        for c, col in scores.items()])).alias("p")).select("p.*")


def multiclass_auc(df: DataFrame, y: str, scores: dict) -> DataFrame:
    """ROC AUC and average precision per class, micro and macro."""
    long = one_vs_rest(df, y, scores)
    lines = long.select(F.explode(F.array("label", F.lit("micro"))).alias("curve"), "hit", "score")
    curve = score_curve(lines, "hit", "score", ["curve"])
    each = curve.groupBy("curve").agg(
        _auc(F.col("pos"), F.col("neg"), F.col("tp"), F.col("p_all"), F.col("n_all"))
        .alias("roc_auc"), _precision_area().alias("average_precision"))
    labels = F.array_compact(F.array("curve", F.when(F.col("curve") != "micro", "macro")))
    return each.withColumn("curve", F.explode(labels)).groupBy("curve").agg(
        F.avg("roc_auc").alias("roc_auc"), F.avg("average_precision").alias("average_precision"))


def calibration_bins(df: DataFrame, y: str, score: str, bins: int = 10,
                     strategy: str = "uniform") -> DataFrame:
    """Mean score and share of positives per score bin."""
    if strategy == "uniform":
        placed = df.withColumn("_bin", F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)))
    else:
        names = {f"q{i}": i / bins for i in range(1, bins)}
        edges = exact_quantiles(df, score, names)
        placed = df.withColumn("_q", edges.select(F.struct(*names)).scalar())
        number = F.lit(0)
        for q in names:
            number = number + (F.col(score) > F.col(f"_q.{q}")).cast("int")
        placed = placed.withColumn("_bin", number)
    return placed.groupBy(F.col("_bin").cast("long").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"),
        F.avg(F.col(y).cast("double")).alias("positive_share"))


def prob_losses(df: DataFrame, y: str, score: str, eps: float = 2.220446049250313e-16) -> DataFrame:
    """Log loss, Brier score and their D2 forms against the base rate, over complete rows."""
    df = df.where(F.col(y).isNotNull() & F.col(score).isNotNull())
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    hit = F.col(y).cast("double")
    base = df.agg(F.avg(hit).alias("rate"),
                  F.avg(-(hit * F.log(p) + (1 - hit) * F.log(1 - p))).alias("log_loss"),
                  F.avg((F.col(score) - hit) * (F.col(score) - hit)).alias("brier"))
    r = F.col("rate")
    null_log = -(r * F.log(r) + (1 - r) * F.log(1 - r))
    return base.select("log_loss", "brier",
                       (1 - F.try_divide(F.col("log_loss"), null_log)).alias("d2_log_loss"),
                       (1 - F.try_divide(F.col("brier"), r * (1 - r))).alias("d2_brier"))
