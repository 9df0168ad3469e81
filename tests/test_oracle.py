"""Every registered query against DuckDB, and the ordered ones again on the chunked path."""

import pytest
from compare import connect, difference, duck_rows, spark_rows

import __spark_entry__ as entry_module

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()
ORDERED = [
    "running_scale", "lag_season_features", "first_seen_codes", "session_ids", "session_sequence",
    "running_accuracy_every_100", "rolling_mae_1000", "block_rolling_auc", "time_rolling_mae_5m", "roc_points", "roc_auc",
    "threshold_table", "best_threshold", "multiclass_auc", "running_positive_ratio",
    "counter_increments", "instant_rate", "alert_intervals", "word_dispersion", "metric_history",
]


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, folder, con):
    assert difference(spark_rows(QUERIES[name](spark, folder)), duck_rows(con, ORACLES[name])) is None


@pytest.mark.parametrize("name", ORDERED)
def test_matches_sql_in_chunks(name, spark, folder, con, chunked):
    assert difference(spark_rows(QUERIES[name](spark, folder)), duck_rows(con, ORACLES[name])) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
