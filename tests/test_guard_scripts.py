"""Queries that would run a command on the executors are refused."""

import pytest

from rtml.plans.sqlguard import check, execute

SCRIPTS = [
    "SELECT TRANSFORM(event_id) USING 'cat' AS (x STRING) FROM data",
    "select transform(event_id, value) using 'touch /tmp/x' from data",
    "FROM data MAP event_id USING 'cat' AS (x STRING)",
    "FROM data REDUCE event_id USING 'cat' AS x, y",
    "SELECT * FROM (SELECT TRANSFORM(event_id) USING 'cat' AS (x STRING) FROM data) t",
    "WITH t AS (SELECT TRANSFORM(event_id) USING 'cat' AS (x STRING) FROM data) SELECT x FROM t",
    "SELECT event_id FROM data WHERE event_id IN (SELECT TRANSFORM(event_id) USING 'cat' AS (x INT) FROM data)",
    "SELECT (SELECT MAX(x) FROM (SELECT TRANSFORM(event_id) USING 'cat' AS (x INT) FROM data)) AS m FROM data",
    "SELECT event_id FROM data UNION ALL SELECT TRANSFORM(event_id) USING 'cat' AS (x INT) FROM data",
    "SELECT TRANSFORM(event_id) ROW FORMAT DELIMITED FIELDS TERMINATED BY ',' USING 'cat' AS (x STRING) FROM data",
]


@pytest.mark.parametrize("mode", ["strict", "lax"])
@pytest.mark.parametrize("query", SCRIPTS)
def test_script_is_refused(spark, query, mode):
    assert check(spark, query, mode)


def test_nothing_runs(spark, tmp_path):
    data = spark.range(3).withColumnRenamed("id", "event_id")
    mark = tmp_path / "ran"
    out = execute(data, f"SELECT TRANSFORM(event_id) USING 'touch {mark}' AS (x STRING) FROM data")
    assert out.error and not mark.exists()


@pytest.mark.parametrize("query", [
    "SELECT transform(array(1, 2), x -> x + 1) AS t FROM data",
    "SELECT 'ScriptTransformation' AS word, map(1, 2) AS m FROM data",
    "SELECT reduce(array(1, 2), 0, (a, x) -> a + x) AS s FROM data"])
def test_functions_of_the_same_name_pass(spark, query):
    assert check(spark, query) is None
    data = spark.range(1)
    assert execute(data, query).error is None
