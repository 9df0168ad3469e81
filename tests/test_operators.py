"""Closed-form and edge-case checks on small hand-made tables."""

import math

import pytest
from pyspark.sql import functions as F

from rtml import schemas as S
from rtml.functions import scalars as X
from rtml.functions.validate import split_valid, validate
from rtml.operators import encode as E, metrics_cls as C, metrics_clu as U, metrics_reg as G, \
    profile as P, registry as K, sample as M
from rtml.plans import sqlguard as Q
from rtml.plans.canned import CANNED
from rtml.plans.features import customer_features, feature_dictionary, serving_features, \
    training_features


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- guarded SQL -----------------------------------------------------------

@pytest.mark.parametrize("text,part", [
    ("", "empty"), ("  ;", "empty"), ("SELECT 1; DROP TABLE x", "single"), ("DROP TABLE x", "single"),
    ("SELECT 1; SELECT 2", "single"), ("SELECT (1", "single"), ("SELECT 1 /* x", "single"),
    ("INSERT INTO data SELECT 1", "single"), ("CREATE TABLE t AS SELECT 1", "single"),
    ("SELECT * FROM parquet.`/etc`", "Only the table"),
    ("SELECT * FROM `parquet`.`/etc`", "Only the table"),
    ("SELECT * FROM csv/**/.`/etc`", "Only the table"),
    ("SELECT * FROM xml.`/etc`", "Only the table"),
    ("SELECT * FROM other_view", "Only the table"), ("TABLE other_view", "Only the table"),
    ("SELECT * FROM global_temp.other_view", "Only the table"),
    ("SELECT (SELECT max(id) FROM other_view) FROM data", "Only the table"),
    ("SELECT * FROM data WHERE id IN (SELECT id FROM other_view)", "Only the table"),
    ("SELECT * FROM (WITH other_view AS (SELECT 1 id) SELECT * FROM other_view) JOIN other_view",
     "Only the table"),
    ("SELECT 'CTE [other_view]' FROM other_view", "Only the table"),
    ("SELECT * FROM IDENTIFIER('other' || '_view')", "written out"),
    ("SELECT * FROM read_files('/etc')", "Table function"),
    ("SELECT reflect('java.lang.System', 'exit')", "not allowed"),
    ("SELECT `java_method`('java.lang.System', 'exit') FROM data", "not allowed"),
])
@pytest.mark.parametrize("mode", ["strict", "lax"])
def test_guard_refuses(spark, text, part, mode):
    spark.range(1).createOrReplaceTempView("other_view")
    try:
        assert part in Q.check(spark, text, mode)
    finally:
        spark.catalog.dropTempView("other_view")


def test_guard_accepts(spark):
    for text in ("SELECT 1;", "select a from data where offset_set > 1 -- a comment",
                 "WITH a AS (SELECT 1 x) SELECT * FROM a JOIN `data` ON true",
                 "SELECT replace(a, 'b', 'drop') FROM data", "SELECT * FROM data, range(3)",
                 "SELECT x FROM data LATERAL VIEW explode(array(1)) AS x"):
        assert Q.check(spark, text) is None and Q.check(spark, text, "lax") is None
    long = "SELECT '" + "x" * 5000 + "'"
    assert "too long" in Q.check(spark, long) and Q.check(spark, long, "lax") is None


def test_guard_limits_and_cleans(spark):
    df = spark.range(50).select("id", F.when(F.col("id") == 0, float("nan")).otherwise(1.0).alias("x"),
                                F.lit(5).alias("credit_limit"))
    assert Q.guarded(df, "SELECT id, credit_limit FROM data", 7).count() == 7
    assert Q.guarded(df, "SELECT x FROM data WHERE id = 0").first()[0] is None
    assert Q.guarded(df, "SELECT id FROM data ORDER BY id LIMIT 3").count() == 3
    assert Q.row_limit(10**6) == 10_000 and Q.row_limit(10**6, "lax") == 100_000
    done = Q.execute(df, "SELECT id FROM data", 50)
    assert done.row_count == 50 and not done.truncated and done.columns == ["id"] and not done.error
    assert Q.execute(df, "SELECT id FROM data", 49).truncated
    flagged = Q.guarded_flagged(df, "SELECT id FROM data", 49).collect()
    assert len(flagged) == 49 and all(r.truncated for r in flagged)
    assert not Q.guarded_flagged(df, "SELECT id FROM data", 50).first().truncated
    assert Q.execute(df, "SELECT nothing FROM data").error
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bound_")]
    with pytest.raises(ValueError):
        Q.guarded(df, "DELETE FROM data")


def test_grid(spark):
    df = spark.createDataFrame([("10", "Ann"), ("9", "bob"), ("x", None)], "a string, b string")
    assert rows(Q.grid_search(df, "BO")) == [("9", "bob")]
    assert [r[0] for r in rows(Q.grid_page(df, Q.grid_order("a")))] == ["9", "10", "x"]
    assert [r[0] for r in rows(Q.grid_page(df, Q.grid_order("a", True)))] == ["10", "9", "x"]
    assert Q.grid_page(spark.range(120), ["id"], page=3).count() == 20


# --- scalars and validation ------------------------------------------------

def test_scalars(spark):
    one = spark.range(1)

    def value(c):
        return one.select(c).first()[0]

    assert value(X.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))) == \
        pytest.approx(math.pi * 6371, abs=0.01)
    assert value(X.baseline_seconds(F.lit(0.1))) == 60 and value(X.baseline_seconds(F.lit(40.0))) == 3600
    assert value(X.to_number(F.lit("abc"))) == 0.0 and value(X.to_number(F.lit("NaN"))) == 0.0
    assert value(X.finite_or(F.lit(float("inf")), -1.0)) == -1.0
    assert value(X.url_slug(F.lit("Home & Garden Tools"))) == "home-garden-tools"
    assert value(X.query_of_url(X.query_url("https://a.b/s", F.lit("red shoe")))) == "red shoe"
    assert value(X.id_number(F.lit("merchant_65"), "merchant")) == 65
    assert value(X.id_number(F.lit("x_65"), "merchant")) is None
    assert value(X.parse_timestamp(F.lit("junk"))) is None
    assert value(X.bool_to_int(F.lit(True))) == 1


def test_json_keys_are_bounded(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"c": 2}}',), ("broken",), (None,)], "j string")
    flat = X.json_flatten(df, "j")
    assert flat.columns == ["j_a", "j_b"] and rows(flat)[0] == ("1", '{"c":2}')
    with pytest.raises(ValueError):
        X.json_keys(df, "j", max_keys=1)


def test_validation(spark):
    df = spark.createDataFrame([("1", "2.5", None), (None, "x", "7"), ("3", "1", "bad")],
                               "id string, amount string, extra string")
    good, bad = split_valid(validate(df, "id bigint, amount double", "extra int"))
    assert good.count() == 1 and good.first().id == 1
    assert sorted(tuple(r._failed) for r in bad.collect()) == [("extra",), ("id", "amount")]


# --- encoders --------------------------------------------------------------

def _ranked(df, column):
    return E.ranked_lists(E.distinct_values(df, [column]), {column: df.schema[column].dataType})[column]


def test_codes_put_null_last_and_agree_on_all_paths(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "c string")
    want = {"a": 0, "b": 1, "c": 2, None: 3}
    local = E.local_table(df, "c", _ranked(df, "c"))
    together = E.long_codes(E.distinct_values(df, ["c"]), ["c"])["c"]
    for table in (local, together, E.codes_of(df, "c"), E.codes_of(df, "c", large=True)):
        assert {r.value: r.code for r in table.collect()} == want
    assert sorted(r.c for r in E.label_encode(df, ["c"]).collect()) == [0, 0, 1, 2, 3]


def test_numeric_codes_follow_number_order(spark):
    df = spark.createDataFrame([(10,), (9,), (-1,)], "n int")
    assert _ranked(df, "n") == ["-1", "9", "10"]
    assert {r.value: r.code for r in E.label_dictionary(df, ["n"]).collect()} == \
        {"-1": 0, "9": 1, "10": 2}


def test_literal_codes_equal_joined_codes(spark):
    df = spark.createDataFrame(
        [(10, "x", "p1"), (-3, "", None), (None, None, "p2"), (2**40, "\u00e9", "p1"), (7, "x'y", "p3")],
        "n long, s string, p string").withColumn("m", (F.col("n") % 5).cast("int"))
    literal = {c: E.literal_code(df, c, _ranked(df, c)) for c in ("s", "p", "m")}
    assert E.literal_code(df, "n", _ranked(df, "n")) is None  # too wide a span for an array
    joined = E.label_encode(df, ["s", "p", "m"], suffix="_j", small_limit=0)
    for r in joined.withColumns({f"{c}_l": v for c, v in literal.items()}).collect():
        assert (r.s_l, r.p_l, r.m_l) == (r.s_j, r.p_j, r.m_j)
    only_null = spark.createDataFrame([(None, None)] * 2, "s string, m int")
    assert {tuple(r) for r in E.label_encode(only_null, ["s", "m"]).collect()} == {(0, 0)}
    assert E.label_encode(df.limit(0), ["s", "m", "n"]).count() == 0


def test_codes_of_a_foreign_dictionary_are_null_when_missing(spark):
    fit = spark.createDataFrame([("a", 1), ("b", 5)], "s string, n int")
    new = spark.createDataFrame([("b", 3), ("z", 9), (None, None), ("a", 1)], "s string, n int")
    out = E.label_encode(new, ["s", "n"], source=fit).collect()
    assert [tuple(r) for r in out] == [(1, None), (None, None), (None, None), (0, 0)]


def test_long_dictionaries_get_the_same_codes(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("c"))
    assert E.label_encode(df, ["c"], small_limit=10).agg(F.max("c")).first()[0] == 99


def test_unknown_modes(spark):
    known = spark.createDataFrame([("f", "a", 0), ("f", "b", 1)], "feature string, value string, code long")
    df = spark.createDataFrame([("a", "q"), ("z", "q")], "f string, g string")

    def codes(mode):
        return sorted((r.f, r.f_code, r.g_code) for r in
                      E.apply_dictionary(df, known, ["f", "g"], mode).collect())

    assert codes("zero") == [("a", 0, 0), ("z", 0, 0)]
    assert codes("overflow") == [("a", 0, 0), ("z", 3, 0)]
    assert codes("null") == [("a", 0, None), ("z", None, None)]


def test_scaling_edge_cases(spark):
    df = spark.createDataFrame([(1, 5.0, 2.0), (2, 5.0, 4.0)], "id int, c double, x double")
    assert [r.c_scaled for r in E.standard_scale(df, ["c", "x"]).collect()] == [0.0, 0.0]
    assert sorted(r.x_scaled for r in E.standard_scale(df, ["x"]).collect()) == [-1.0, 1.0]
    assert [r.c_norm for r in E.min_max_scale(df, ["c"]).collect()] == [0.0, 0.0]
    assert [r.c_scaled for r in E.running_scale(df, ["c"], "id").collect()] == [0.0, 0.0]


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    weights = {r.y: r.weight for r in E.class_weights(df, "y").collect()}
    assert weights == {1: pytest.approx(2.0), 0: pytest.approx(4 / 6)}


# --- sampling --------------------------------------------------------------

def test_splits_are_exact_disjoint_and_repeatable(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    a, b = (M.stratified_split(d, "y", "id") for d in (df, df.repartition(3)))
    assert a.exceptAll(b.select(a.columns)).count() == 0
    counts = {(r.y, r.split): r["count"] for r in a.groupBy("y", "split").count().collect()}
    assert counts == {(1, "test"): 20, (1, "train"): 80, (0, "test"): 180, (0, "train"): 720}


def test_folds_and_nested_sizes(spark):
    df = spark.range(103).withColumn("y", F.col("id") % 2)
    sizes = [r["count"] for r in M.folds(df, "id", 5, "y").groupBy("y", "fold").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 103
    nested = M.nested_sizes(df, "id", [0.1, 0.5, 1.0])
    groups = {r.train_fraction: set(r.ids) for r in nested.groupBy("train_fraction")
              .agg(F.collect_list("id").alias("ids")).collect()}
    assert groups[0.1] < groups[0.5] < groups[1.0] and len(groups[1.0]) == 103


def test_feature_subset_keeps_order():
    assert M.feature_subset(list("abcdef"), 0.5, 1) == sorted(M.feature_subset(list("abcdef"), 0.5, 1))
    assert len(M.feature_subset(list("abcdef"), 0.01)) == 1


# --- metrics ---------------------------------------------------------------

def test_perfect_single_class_and_tied_scores(spark):
    perfect = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)], "y int, p double")
    assert C.roc_auc(C.score_curve(perfect, "y", "p")).first()[0] == 1.0
    assert C.average_precision(C.score_curve(perfect, "y", "p")).first()[0] == 1.0
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, p double")
    assert C.roc_auc(C.score_curve(tied, "y", "p")).first()[0] == 0.5
    single = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, p double")
    assert C.roc_auc(C.score_curve(single, "y", "p")).first()[0] is None
    m = C.class_metrics(single.withColumn("h", F.lit(0)), "y", "h").first()
    assert m.precision == 0.0 and m.recall == 0.0 and m.f1 == 0.0 and m.mcc == 0.0


def test_auc_ignores_monotone_changes(spark):
    df = spark.range(300).select((F.pmod(F.hash("id"), F.lit(2))).alias("y"),
                                 (F.pmod(F.hash("id", F.lit(1)), F.lit(40)) / 40).alias("p"))
    a = C.roc_auc(C.score_curve(df, "y", "p")).first()[0]
    b = C.roc_auc(C.score_curve(df.withColumn("p", F.exp("p") * 3), "y", "p")).first()[0]
    assert a == pytest.approx(b)


def test_regression_edges(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0), (4.0, 4.0)], "y double, p double")
    assert G.percentage_errors(df, "y", "p").first().mape == pytest.approx(25.0)
    m = G.regression_metrics(df, "y", "p").first()
    assert (m.mae, m.mse, m.max_error) == (pytest.approx(2 / 3), pytest.approx(2 / 3), 1.0)
    assert m.r2 == pytest.approx(1 - (2 / 3) / (8 / 3))
    constant = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    assert G.regression_metrics(constant, "y", "p").first().r2 is None


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "y int, p double")
    assert C.score_curve(empty, "y", "p").count() == 0
    assert P.bucket_histogram(empty, "p", [1]).where("cumulative > 0").count() == 0
    assert G.regression_metrics(empty, "y", "p").first().mae is None


def test_silhouette_matches_pairwise_definition(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    pts = [(i, [float(v) for v in rng.normal(i % 3, 0.5, 4)], i % 3) for i in range(60)]
    df = spark.createDataFrame(pts, "id long, v array<double>, c int")
    x = np.array([p[1] for p in pts])
    c = np.array([p[2] for p in pts])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))

    def brute(dist):
        out = []
        for i in range(len(x)):
            own = (c == c[i]) & (np.arange(len(x)) != i)
            a = dist[i][own].mean()
            b = min(dist[i][c == k].mean() for k in set(c) if k != c[i])
            out.append((b - a) / max(a, b))
        return out

    plain = {r.id: r.silhouette for r in U.silhouette_euclidean(df, "v", "c", "id").collect()}
    squared = {r.id: r.silhouette for r in U.silhouette_rows(df, "v", "c").collect()}
    assert [plain[i] for i in range(60)] == pytest.approx(brute(d))
    assert [squared[i] for i in range(60)] == pytest.approx(brute(d ** 2))
    assert sum(squared.values()) / 60 == pytest.approx(U.silhouette_score(df, "v", "c"))


# --- registry, features ----------------------------------------------------

def test_best_run_fallback_and_direction(spark):
    runs = spark.createDataFrame([
        ("a", "FINISHED", "m", 1, True, 0.5), ("b", "FINISHED", "m", 3, True, 0.9),
        ("c", "RUNNING", "m", 9, True, 0.1), ("d", "FINISHED", "m", 5, False, 0.95),
        ("e", "FINISHED", "m", 4, True, None)],
        "run_id string, status string, name string, start_time int, has_artifact boolean, f double")
    assert K.best_run(runs, "m", "f", True).first().run_id == "b"
    assert K.best_run(runs, "m", "f", False).first().run_id == "a"
    assert K.best_run(runs, "m", "absent", True).first().run_id == "e"
    assert K.best_run(runs, "other", "f", True).count() == 0
    board = rows(K.run_leaderboard(runs, "f", True).orderBy("place").select("run_id", "is_best"))
    assert board[0] == ("d", True) and board[-1] == ("e", False)


def transactions(spark):
    data = [("t1", "2024-01-02T03:04:05.000006+00:00", 10.0, "USD", "m_2", "food", "buy", "card",
             '{"os": "ios", "browser": "x"}', 3, True, False, 0),
            ("t2", "2025-02-03T03:04:06.000000+00:00", 20.0, "EUR", "m_10", "food", "buy", "cash",
             None, 4, False, True, 1)]
    return spark.createDataFrame(
        data, "transaction_id string, timestamp string, amount double, currency string, "
        "merchant_id string, product_category string, transaction_type string, "
        "payment_method string, device_info string, account_age_days int, cvv_provided boolean, "
        "billing_address_match boolean, is_fraud int")


def test_training_and_serving_features_agree(spark):
    df = transactions(spark)
    train = training_features(df, "transaction_fraud_detection")
    assert train.columns == [*S.TFD_NUMERIC, *S.TFD_CATEGORICAL, S.TFD_TARGET]
    serve = serving_features(df, "transaction_fraud_detection",
                             feature_dictionary(df, "transaction_fraud_detection"))
    assert sorted(rows(train.drop("is_fraud"))) == sorted(rows(serve))
    assert sorted((r.amount, r.os, r.year, r.hour) for r in train.collect()) == \
        [(10.0, 0, 0, 0), (20.0, 1, 1, 0)]
    with pytest.raises(ValueError):
        training_features(df, "transaction_fraud_detection", sample_percent=10, max_rows=5)


def test_customer_features_columns(spark):
    from rtml.suite.roles import as_interactions
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert customer_features(as_interactions(events)).columns == ["customer_id", *S.CUSTOMER_FEATURES]


def test_every_canned_query_plans(spark):
    for table, ddl in S.TABLES.items():
        empty = spark.createDataFrame([], ddl)
        for fn in CANNED[table].values():
            fn(empty).collect()


# --- nulls, NaN and signed zero ----------------------------------------------

@pytest.mark.parametrize("small", [1_000_000, 3])
def test_codes_of_signed_zero_and_nan(spark, small):
    from rtml.operators.encode import label_encode
    values = [0.0, -0.0, 1.5, None, float("nan"), -2.0] * 5
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, x double")
    out = {r.id: r.c for r in label_encode(df.withColumn("c", F.col("x")), ["c"],
                                           small_limit=small).collect()}
    assert len(out) == 30 and df.count() == 30
    assert [out[i] for i in range(6)] == [1, 1, 2, 4, 3, 0]


def test_percent_sample_ignores_layout(spark):
    from rtml.operators.sample import percent_sample
    df = spark.range(20_000).select("id", (F.col("id") % 7).alias("k"))
    a = sorted(r.id for r in percent_sample(df, 10.0).collect())
    b = sorted(r.id for r in percent_sample(df.repartition(13, "k"), 10.0).collect())
    assert a == b and 1700 < len(a) < 2300


@pytest.mark.parametrize("block", [200_000, 4])
def test_rolling_means_null_nan_huge(spark, block):
    import math
    from rtml.operators.rolling import rolling_means, running_means, time_rolling_means
    x = [1.0, None, 1.0, float("nan"), 1.0, 1.0, 1.0, 1e17, 1.0, 1.0, 1.0, 1.0, 1.0, 3.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, x double") \
        .withColumn("ts", F.timestamp_seconds(F.col("i") * 60))

    def mean(values):
        values = [v for v in values if v is not None]
        return sum(values) / len(values) if values else None

    def same(a, b):
        return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))
    rolled = rolling_means(df, [], "i", {"m": F.col("x")}, rows=3, rows_per_block=block)
    assert all(same(r.m, mean(x[max(0, r.i - 2):r.i + 1])) for r in rolled.collect())
    run = {r.i: r.m for r in running_means(df.where("i < 3"), [], "i", {"m": F.col("x")}).collect()}
    assert run == {0: 1.0, 1: 1.0, 2: 1.0}
    timed = time_rolling_means(df.where("i < 7"), [], "ts", {"m": F.col("x")}, seconds=120)
    assert all(same(r.m, mean(x[max(0, r.i - 2):r.i + 1])) for r in timed.collect())


def test_metrics_use_complete_rows(spark):
    from rtml.operators.metrics_cls import prob_losses
    from rtml.operators.metrics_reg import d2_scores, regression_metrics
    pairs = [(1.0, 1.1), (3.0, 2.8), (1000.0, None), (None, 5.0)]
    df = spark.createDataFrame(pairs, "y double, p double")
    full = spark.createDataFrame(pairs[:2], "y double, p double")
    for metric in (regression_metrics, d2_scores):
        assert metric(df, "y", "p").first() == metric(full, "y", "p").first()
    labels = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, None), (None, 0.1)], "y int, p double")
    assert prob_losses(labels, "y", "p").first() == \
        prob_losses(labels.na.drop(), "y", "p").first()


def test_quantiles_ignore_nan_alike(spark, monkeypatch):
    from rtml.plans import prefix
    df = spark.range(3000).select(F.when(F.col("id") % 10 == 0, float("nan"))
                                  .otherwise(F.col("id")).alias("v"))
    plain = prefix.exact_quantiles(df, "v", {"a": 0.5, "b": 0.9}).first()
    monkeypatch.setattr(prefix, "_BRACKET_ROWS", 0)
    assert prefix.exact_quantiles(df, "v", {"a": 0.5, "b": 0.9}).first() == plain


def test_customer_features_of_hot_null_and_idle_customers(spark):
    from rtml.plans.features import customer_features
    row = ("2024-01-02T03:04:05", None, None, None, None, None, None)
    cols = ("timestamp string, event_type string, product_id string, product_category string, "
            "price double, quantity int, time_on_page_seconds int")
    rows = [("c1", "s1", "2024-01-02T03:04:05", "page_view", "p1", "k1", None, None, 4),
            ("c1", "s2", "2024-01-02T05:04:05", "page_view", "p2", "k1", None, None, 2),
            ("c1", "s2", "2024-01-03T05:00:00", "purchase", "p2", "k1", 2.5, 2, None),
            ("c1", None, "2024-01-03T03:00:00", "search", None, None, None, None, None),
            (None, "s9", *row), (None, None, *row)]
    df = spark.createDataFrame(rows, f"customer_id string, session_id string, {cols}") \
        .withColumn("location", F.lit('{"lat": 1.234, "lon": 2.0}'))
    out = {r.customer_id: r for r in customer_features(df).collect()}
    one, none = out["c1"], out[None]
    assert (one.total_events, one.total_sessions, one.unique_products_viewed,
            one.unique_categories_viewed, one.days_active, one.geo_diversity) == (4, 2, 2, 1, 2, 1)
    assert one.preferred_hour == 3 and one.total_revenue == 5.0  # hours 3 and 5 tie
    assert (none.total_events, none.total_sessions, none.unique_products_viewed,
            none.preferred_hour, none.total_revenue) == (2, 1, 0, 3, 0.0)


def test_service_histograms_against_plain_counts(spark):
    from rtml.operators import profile as P
    data = [("a", 0.0), ("a", 10.0), ("a", 10.5), ("a", None), ("b", 1e9), ("c", None)]
    df = spark.createDataFrame(data, "g string, v double")
    out = P.service_histograms(df, {m: "v" for m in P.BUCKETS}, ["g"]).collect()
    assert len(P.BUCKETS) == 9 and len(out) == 3 * sum(len(b) + 1 for b in P.BUCKETS.values())
    for r in out:
        mine = [v for g, v in data if g == r.g and v is not None]
        assert (r.n, r.total) == (len(mine), sum(mine))
        assert r.cumulative == sum(r.le is None or v <= r.le for v in mine)
    assert P.service_histograms(df.limit(0), {"sql_rows_returned": "v"}, ["g"]).count() == 0
