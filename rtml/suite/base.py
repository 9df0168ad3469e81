"""Query registry, table access and rounding shared by both sides of a comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Added before rounding so that exact halves do not round apart in two engines.
SHIFT = 0.000000012345


class Tables:
    """Parquet tables of one scale as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def present(df: DataFrame, digits: int) -> DataFrame:
    """Integers as long, floating numbers as rounded double, other types unchanged."""
    cols = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.round(c.cast("double") + F.lit(SHIFT), digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None, d: str = "", i: str = "", digits: int = 6):
    """Register ``fn(tables)``; ``d`` and ``i`` name the SQL's double and integer columns."""
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            spark.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
            return present(fn(Tables(spark, folder)), digits)

        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            casts = [f"round(({c})::DOUBLE + {SHIFT:.12f}, {digits}) AS {c}" for c in d.split()] + \
                    [f"({c})::BIGINT AS {c}" for c in i.split()]
            star = f"* REPLACE ({', '.join(casts)})" if casts else "*"
            ORACLES[name] = f"SELECT {star} FROM ({sql.strip()}) AS answer"
        return fn
    return register
