"""Online autoregression per series against least squares over all rows."""

import numpy as np
import pytest

from rtml.streaming.forecast import SeriesForecaster


def series(seed, n):
    draw = np.random.default_rng(seed)
    y = [3.0, 1.0, 2.0, 5.0]
    while len(y) < n:
        y.append(1.5 + 0.6 * y[-1] - 0.2 * y[-2] + 0.3 * y[-4] + draw.normal(0, 0.1))
    return y


def rows_of(spark, data, a, b):
    rows = [(t, k, y[t]) for k, y in data.items() for t in range(a, b)]
    return spark.createDataFrame([*rows, (b, None, 1.0), (b, "a", None)],
                                 "t long, k string, y double").repartition(3)


def plain(y, lags, fade_from=None):
    depth = max(lags)
    x = np.array([[1.0, *[y[t - g] for g in lags]] for t in range(depth, len(y))])
    return np.linalg.lstsq(x, np.array(y[depth:]), rcond=None)[0], x


@pytest.mark.parametrize("differences", [False, True])
def test_batches_equal_least_squares(spark, tmp_path, chunked, differences):
    data = {"a": series(1, 80), "b": series(2, 80)}
    make = lambda: SeriesForecaster(spark, str(tmp_path / "s"), "k", "t", "y", (1, 2, 4),
                                    differences=differences)
    for n, (a, b) in enumerate(((0, 3), (3, 30), (30, 31), (31, 80))):
        step = make()  # every batch after a restart
        step(rows_of(spark, data, a, b), n)
        if n == 1:
            step(rows_of(spark, data, a, b), n)  # and one run again
    found = {r.series: r for r in step.coefficients(3).collect()}
    ahead = {(r.series, r.step): r.forecast for r in step.forecast(3, 5).collect()}
    assert len(ahead) == 10
    for k, y in data.items():
        z = np.diff(y).tolist() if differences else y
        want, x = plain(z, (1, 2, 4))
        assert found[k].n == len(x)
        assert found[k].coefficients == pytest.approx(want.tolist(), abs=1e-5)
        level = y[-1]
        for s in range(1, 6):
            z = [*z, want[0] + want[1] * z[-1] + want[2] * z[-2] + want[3] * z[-4]]
            level = level + z[-1] if differences else z[-1]
            assert ahead[k, s] == pytest.approx(level, abs=1e-4)


def test_fading_follows_a_change(spark, tmp_path):
    draw, y = np.random.default_rng(5), [1.0, 2.0]
    for t in range(2, 200):
        y.append(5 + (0.8 if t < 100 else -0.8) * y[-1] + draw.normal(0, 1))
    step = SeriesForecaster(spark, str(tmp_path / "s"), "k", "t", "y", (1,), fade=0.01)
    for n in range(4):
        step(rows_of(spark, {"a": y}, n * 50, n * 50 + 50), n)
    assert step.coefficients(3).first().coefficients[1] < -0.4


def test_short_series_and_empty_batches(spark, tmp_path):
    step = SeriesForecaster(spark, str(tmp_path / "s"), "k", "t", "y", (1, 3))
    step(rows_of(spark, {}, 0, 5), 0)
    assert step.coefficients(0).count() == 0 and step.forecast(0, 2).count() == 0
    step(rows_of(spark, {"a": [2.0] * 9}, 0, 2), 1)
    assert step.forecast(1, 2).count() == 0
    step(rows_of(spark, {"a": [2.0] * 9}, 2, 9), 2)
    assert [r.forecast for r in step.forecast(2, 2).collect()] == pytest.approx([2.0, 2.0], abs=1e-3)
