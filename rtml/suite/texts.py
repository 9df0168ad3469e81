"""Token statistics and feature analysis."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from rtml.operators import analysis as L, text as X
from rtml.suite.base import query
from rtml.suite.roles import KEYED_SQL, event_key

_STOP = ["the", "and", "of", "to", "in", "is", "that", "with", "for", "by", "le", "la", "les", "de",
         "une", "en", "die", "der", "und", "el", "los", "que"]
_STOP_SQL = ", ".join(f"'{w}'" for w in _STOP)


@query("token_frequency", f"""SELECT token, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id,
 unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS token FROM documents
 WHERE trim(text) <> '') WHERE token NOT IN ({_STOP_SQL}) GROUP BY token HAVING count(DISTINCT doc_id) >= 2
 ORDER BY n DESC, token LIMIT 50""")
def token_frequency(t):
    return X.token_frequency(t.documents, "doc_id", "text", _STOP, 2, 50)


_TOKENS = """(SELECT doc_id, unnest(l) AS token, unnest(range(len(l))) AS pos FROM (SELECT doc_id,
 list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS l FROM documents))"""
_TARGETS = f"""(SELECT token, n, f FROM (SELECT token, count(*) AS n, min({{'d': doc_id, 'p': pos}}) AS f
 FROM {_TOKENS} GROUP BY token ORDER BY n DESC, f LIMIT 50) WHERE length(token) > 2 AND n >= 3
 ORDER BY n DESC, f LIMIT 10)"""


@query("target_words", f"SELECT token, n FROM {_TARGETS}")
def target_words(t):
    return X.target_words(t.documents, "doc_id", "text")


def _targets(t):
    return [r.token for r in X.target_words(t.documents, "doc_id", "text").collect()]  # ten words


@query("word_dispersion", f"""SELECT token, doc_id, "offset" FROM (SELECT token, doc_id,
 row_number() OVER (ORDER BY doc_id, pos) - 1 AS "offset" FROM {_TOKENS})
 WHERE token IN (SELECT token FROM {_TARGETS})""")
def word_dispersion(t):
    return X.word_dispersion(t.documents, "doc_id", "text", _targets(t))


@query("word_correlation", f"""WITH t AS (SELECT token, row_number() OVER (ORDER BY n DESC, f) AS i
 FROM {_TARGETS}), p AS (SELECT doc_id, t.token, i, coalesce(h, 0) AS h FROM documents CROSS JOIN t
 LEFT JOIN (SELECT DISTINCT doc_id, token, 1 AS h FROM {_TOKENS}) USING (doc_id, token))
 SELECT a.token AS word_a, b.token AS word_b, corr(a.h, b.h) AS correlation FROM p a JOIN p b
 ON a.doc_id = b.doc_id AND a.i < b.i GROUP BY 1, 2""", d="correlation")
def word_correlation(t):
    return X.word_correlation(t.documents, "text", _targets(t))


@query("tfidf_terms")
def tfidf_terms(t):
    _, out = X.tfidf(t.documents.select("doc_id", "text"), "text", 100, 2, _STOP)
    return out.select("doc_id", F.col("tfidf").cast("string").alias("tfidf"))


@query("svd_embedding")
def svd_embedding(t):
    _, out = X.tfidf(t.documents.select("doc_id", "text"), "text", 100, 2, _STOP)
    return X.svd_embedding(out, "tfidf", 50, ["doc_id"]) \
        .select("doc_id", F.size("embedding").alias("size"), F.col("embedding")[0].alias("first"))


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PAIRS = [(a, b) for i, a in enumerate(_NUM) for b in _NUM[i + 1:]]


@query("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS correlation FROM lineitem"
    for a, b in _PAIRS), d="correlation")
def correlation_matrix(t):
    return L.correlation_matrix(t.lineitem, _NUM)


@query("target_correlation", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, (l_returnflag = 'R')::INT) AS correlation FROM lineitem"
    for c in _NUM), d="correlation")
def target_correlation(t):
    rows = t.lineitem.withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    return L.target_correlation(rows, _NUM, "y")


def _mi(feature: str, code: str) -> str:
    return f"""SELECT '{feature}' AS feature, sum(n / t * ln(n * t / (nx * ny))) AS mutual_information FROM
 (SELECT count(*)::DOUBLE AS n, sum(count(*)) OVER () AS t, sum(count(*)) OVER (PARTITION BY x) AS nx,
 sum(count(*)) OVER (PARTITION BY l_returnflag) AS ny FROM (SELECT {code} AS x, l_returnflag FROM lineitem)
 GROUP BY x, l_returnflag)"""


def _bin(c: str) -> str:
    return (f"least(floor(({c} - (SELECT min({c}) FROM lineitem)) / (SELECT max({c}) - min({c}) "
            f"FROM lineitem) * 10), 9)")


@query("mutual_information", " UNION ALL ".join(
    [_mi("l_linestatus", "l_linestatus"), _mi("l_quantity", _bin("l_quantity")),
     _mi("l_extendedprice", _bin("l_extendedprice"))]), d="mutual_information")
def mutual_information(t):
    return L.mutual_information(t.lineitem, ["l_linestatus"], ["l_quantity", "l_extendedprice"],
                                "l_returnflag", 10)


@query("mutual_information_numeric", " UNION ALL ".join(
    [_mi("l_linestatus", "l_linestatus"), _mi("l_quantity", _bin("l_quantity"))])
    .replace("l_returnflag", "yb").replace("yb FROM lineitem", f"{_bin('l_extendedprice')} AS yb "
                                           "FROM lineitem"), d="mutual_information")
def mutual_information_numeric(t):
    return L.mutual_information_numeric(t.lineitem, ["l_linestatus"], ["l_quantity"],
                                        "l_extendedprice", 10)


def _bin20(c: str) -> str:
    return _bin(c).replace("* 10), 9)", "* 20), 19)")


@query("joint_histogram", f"""SELECT {_bin20("l_quantity")} AS x_bin, {_bin20("l_extendedprice")} AS y_bin,
 count(*) AS n FROM lineitem GROUP BY 1, 2""", i="x_bin y_bin")
def joint_histogram(t):
    return L.joint_histogram(t.lineitem, "l_quantity", "l_extendedprice", 20)


_ANGLES = [2 * math.pi * i / 4 for i in range(4)]


def _weighted(values: list[float]) -> str:
    return " + ".join(f"n{i} * ({v!r})" for i, v in enumerate(values))


@query("radviz_points", f"""SELECT l_orderkey, l_linenumber, coalesce(({_weighted([math.cos(a) for a in _ANGLES])})
 / nullif(n0 + n1 + n2 + n3, 0), 0) AS x, coalesce(({_weighted([math.sin(a) for a in _ANGLES])})
 / nullif(n0 + n1 + n2 + n3, 0), 0) AS y FROM (SELECT l_orderkey, l_linenumber, """ + ", ".join(
    f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) AS n{i}"
    for i, c in enumerate(_NUM)) + " FROM lineitem)", d="x y", digits=5)
def radviz_points(t):
    return L.radviz_points(t.lineitem, _NUM, ["l_orderkey", "l_linenumber"])


@query("normality_score", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, n, m3 / m2 ** 1.5 AS skewness, m4 / (m2 * m2) - 3 AS kurtosis,
 n / 6.0 * ((m3 / m2 ** 1.5) ** 2 + (m4 / (m2 * m2) - 3) ** 2 / 4) AS jarque_bera FROM (SELECT count(*) AS n,
 avg((x - m) ** 2) AS m2, avg((x - m) ** 3) AS m3, avg((x - m) ** 4) AS m4 FROM (SELECT {c} AS x,
 avg({c}) OVER () AS m FROM lineitem))""" for c in _NUM), d="skewness kurtosis jarque_bera", digits=4)
def normality_score(t):
    return L.normality_scores(t.lineitem, _NUM)


@query("parallel_coordinates", """SELECT event_id, event_type, feature, value FROM (SELECT event_id, event_type,
 unnest(['value', 'k']) AS feature, unnest([v, kk]) AS value FROM (SELECT event_id, event_type,
 (value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()) AS v,
 (k - min(k) OVER ()) / (max(k) OVER () - min(k) OVER ()) AS kk FROM """ + KEYED_SQL + """)
 WHERE ('0x' || substr(md5(event_id::VARCHAR || ':42'), 1, 13))::BIGINT / 4503599627370496.0 < 0.05)""",
       d="value")
def parallel_coordinates(t):
    rows = event_key(t.events).select("event_id", "event_type", "value", "k")
    return L.parallel_coordinates(rows, ["value", "k"], "event_type", "event_id")


@query("pca_projection")
def pca_projection(t):
    return L.pca_projection(t.lineitem, _NUM, ["l_orderkey", "l_linenumber"])


@query("pca_variance")
def pca_variance(t):
    return L.explained_variance(t.lineitem, _NUM, 0.9)
