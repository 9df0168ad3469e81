"""Regression metrics, deviances, residual tables and fit lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rtml.plans.prefix import exact_quantiles


def complete(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Rows that have both a target and a prediction; every metric is over these."""
    return df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """MAE, MSE, RMSE, R2, explained variance and largest error in one pass."""
    df = complete(df, y, yhat)
    e = F.col(y) - F.col(yhat)
    base = df.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                  F.max(F.abs(e)).alias("max_error"), F.var_pop(e).alias("_ve"),
                  F.var_pop(y).alias("_vy"))
    return base.select("mae", "mse", F.sqrt("mse").alias("rmse"),
                       (1 - F.try_divide(F.col("mse"), F.col("_vy"))).alias("r2"),
                       (1 - F.try_divide(F.col("_ve"), F.col("_vy"))).alias("explained_variance"),
                       "max_error")


def percentage_errors(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """MAPE and SMAPE in percent; rows with a zero denominator are left out."""
    df = complete(df, y, yhat)
    t, p = F.col(y), F.col(yhat)
    size = F.abs(t) + F.abs(p)
    return df.agg(
        (F.avg(F.when(t != 0, F.abs((t - p) / t))) * 100).alias("mape"),
        (F.avg(F.when(size != 0, 2 * F.abs(p - t) / size)) * 100).alias("smape"))


def median_absolute_error(df: DataFrame, y: str, yhat: str) -> DataFrame:
    errors = complete(df, y, yhat).select(F.abs(F.col(y) - F.col(yhat)).alias("_e"))
    return exact_quantiles(errors, "_e", {"median_ae": 0.5})


def log_errors(df: DataFrame, y: str, yhat: str, floor: float = 1e-10) -> DataFrame:
    d = F.log1p(F.greatest(F.col(y), F.lit(floor))) - F.log1p(F.greatest(F.col(yhat), F.lit(floor)))
    return complete(df, y, yhat).agg(F.avg(d * d).alias("msle")).select("msle", F.sqrt("msle").alias("rmsle"))


def tweedie_terms(y: Column, mu: Column, power: float) -> Column:
    """Unit deviance of one row."""
    if power == 0:
        return (y - mu) * (y - mu)
    if power == 1:
        return 2 * (F.when(y > 0, y * F.log(y / mu)).otherwise(0.0) - y + mu)
    if power == 2:
        return 2 * (F.log(mu / y) + y / mu - 1)
    q = F.lit(float(power))
    first = F.pow(F.greatest(y, F.lit(0.0)), 2 - q) / ((1 - q) * (2 - q))
    return 2 * (first - y * F.pow(mu, 1 - q) / (1 - q) + F.pow(mu, 2 - q) / (2 - q))


def deviances(df: DataFrame, y: str, yhat: str, power: float = 1.5) -> DataFrame:
    t, p = F.col(y), F.col(yhat)
    return complete(df, y, yhat).agg(F.avg(tweedie_terms(t, p, 1)).alias("poisson"),
                  F.avg(tweedie_terms(t, p, 2)).alias("gamma"),
                  F.avg(tweedie_terms(t, p, power)).alias("tweedie"))


def pinball_terms(y: Column, yhat: Column, alpha: float) -> Column:
    d = y - yhat
    return F.when(d >= 0, d * alpha).otherwise(d * (alpha - 1))


def d2_scores(df: DataFrame, y: str, yhat: str, alpha: float = 0.5,
              power: float = 1.5) -> DataFrame:
    """Pinball loss and the share of absolute, pinball and Tweedie loss explained.

    Null predictions are the median, the alpha quantile and the mean of the target.
    """
    df = complete(df, y, yhat)
    null = exact_quantiles(df, y, {"med": 0.5, "qa": alpha}).select(F.struct("med", "qa")).scalar()
    mean = df.agg(F.avg(y)).scalar()
    t, p = F.col(y), F.col(yhat)
    rows = df.select(t, p, null.alias("_null"), mean.alias("_mean"))
    s = rows.agg(
        F.avg(pinball_terms(t, p, alpha)).alias("pinball"),
        F.avg(pinball_terms(t, F.col("_null.qa"), alpha)).alias("_pin0"),
        F.avg(F.abs(t - p)).alias("_abs"), F.avg(F.abs(t - F.col("_null.med"))).alias("_abs0"),
        F.avg(tweedie_terms(t, p, power)).alias("_tw"),
        F.avg(tweedie_terms(t, F.col("_mean"), power)).alias("_tw0"))
    return s.select("pinball", (1 - F.try_divide(F.col("_abs"), F.col("_abs0"))).alias("d2_absolute"),
                    (1 - F.try_divide(F.col("pinball"), F.col("_pin0"))).alias("d2_pinball"),
                    (1 - F.try_divide(F.col("_tw"), F.col("_tw0"))).alias("d2_tweedie"))


def residuals(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.withColumn("residual", F.col(y) - F.col(yhat))


def residual_histogram(df: DataFrame, y: str, yhat: str, bins: int = 50,
                       by: list[str] | None = None) -> DataFrame:
    """Residual counts in equal-width bins over the common range, per group (split)."""
    by = by or []
    r = residuals(df, y, yhat).select(*by, "residual")
    span = r.agg(F.struct(F.min("residual").alias("lo"), F.max("residual").alias("hi"))).scalar()
    placed = r.withColumn("_s", span)
    width = (F.col("_s.hi") - F.col("_s.lo")) / bins
    number = F.when(width == 0, 1).otherwise(
        F.least(F.floor((F.col("residual") - F.col("_s.lo")) / width) + 1, F.lit(bins)))
    return placed.groupBy(*by, number.cast("long").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("residual").alias("mean_residual"))


def fit_line(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Least-squares line of predicted on actual values."""
    return complete(df, y, yhat).agg(F.regr_slope(yhat, y).alias("slope"),
                  F.regr_intercept(yhat, y).alias("intercept"), F.regr_r2(yhat, y).alias("r2"))
