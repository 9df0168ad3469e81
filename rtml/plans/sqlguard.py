"""Read-only SQL over one table bound as ``data``, with row caps and clean results.

What SQL text cannot say without a nested loop, such as a range or as-of join, the caller passes as
named relations built from the table (``rtml.operators.joins``); the text reads them like tables.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rtml.functions.scalars import clean_non_finite

# Limits of the strict and the lax mode.
STRICT_MAX_ROWS = 10_000
STRICT_MAX_LENGTH = 5_000
LAX_DEFAULT_ROWS = 10_000
LAX_MAX_ROWS = 100_000
PAGE_SIZE = 50

#: Generators that make rows out of their arguments and read nothing.
TABLE_FUNCTIONS = {"range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline",
                   "inline_outer", "stack", "json_tuple", "sequence"}
#: Functions that call into the virtual machine.
REFLECTION = {"reflect", "try_reflect", "java_method"}

_RELATION = re.compile(r"'UnresolvedRelation \[([^\]]*)\]")
_TABLE_FUNCTION = re.compile(r"'UnresolvedTableValuedFunction \[([^\]]*)\]")
_CTE = re.compile(r"CTE \[([^\]]*)\]")
_CALL = re.compile(r"'([A-Za-z_.]+)\(")
#: TRANSFORM, MAP and REDUCE run a command of the operating system on every executor.
_SCRIPT = re.compile(r"^[\s:+\-]*'?ScriptTransformation\b|'?ScriptInputOutputSchema\b", re.M)
_NAME = re.compile(r"[a-z_][a-z0-9_]*")


def _statement(query: str | None) -> str:
    return (query or "").strip().rstrip(";").rstrip()


def parsed_plan(spark: SparkSession, query: str) -> str:
    """Text of the plan that Spark's parser makes of the query, taken as a subquery.

    Only a single query fits between the parentheses, so any other statement, a second statement or
    an open comment is a parse error. A new session is asked, in which paths are no tables and no view
    is known, so nothing is read.
    """
    apart = spark.newSession()
    apart.conf.set("spark.sql.runSQLOnFiles", "false")
    apart.conf.set("spark.sql.debug.maxToStringFields", "100000")
    text = apart.sql(f"EXPLAIN EXTENDED SELECT * FROM (\n{query}\n)").first()[0]
    return text.split("== Analyzed Logical Plan ==")[0]


def check(spark: SparkSession, query: str | None, mode: str = "strict",
          relations: Collection[str] = ()) -> str | None:
    """Reason for refusing the query, or None when it may run.

    Decided on the parsed plan: the text must be one query, and the only relations in it ``data``,
    the named ``relations``, names that the query itself defines (and that no table or view has), and
    row generators; script transformations are refused. The strict mode also bounds the length of
    the text.
    """
    if mode not in ("strict", "lax"):
        raise ValueError(f"mode must be strict or lax, not {mode!r}")
    text = _statement(query)
    if not text:
        return "Query cannot be empty"
    if mode == "strict" and len(text) > STRICT_MAX_LENGTH:
        return f"Query too long (max {STRICT_MAX_LENGTH} characters)"
    try:
        plan = parsed_plan(spark, text)
    except ParseException as e:
        return f"Only a single SELECT query is allowed: {(e.getMessage() or str(e)).splitlines()[0]}"
    if "PlanWithUnresolvedIdentifier" in plan:
        return "Table names must be written out"
    if _SCRIPT.search(plan):
        return "Script transformations are not allowed"
    given = {"data", *relations}
    own = {n.strip().lower() for names in _CTE.findall(plan) for n in names.split(",")}
    for name in (n.strip().lower() for n in _RELATION.findall(plan)):
        if name not in given and (name not in own or spark.catalog.tableExists(f"`{name}`")):
            return f"Only the table 'data' can be read, not '{name}'"
    for name in (n.strip().lower() for n in _TABLE_FUNCTION.findall(plan)):
        if name not in TABLE_FUNCTIONS:
            return f"Table function '{name}' is not allowed"
    for name in _CALL.findall(plan):
        if name.lower().split(".")[-1] in REFLECTION:
            return f"Function '{name}' is not allowed"
    return None


def row_limit(requested: int | None, mode: str = "strict") -> int:
    default, cap = (STRICT_MAX_ROWS, STRICT_MAX_ROWS) if mode == "strict" \
        else (LAX_DEFAULT_ROWS, LAX_MAX_ROWS)
    return min(default if requested is None else requested, cap)


def bind(table: DataFrame, query: str, relations: dict[str, DataFrame] | None = None) -> DataFrame:
    """Plan the query with ``table`` visible as ``data``, and ``relations`` under their names, and
    nothing left in the catalog."""
    spark = table.sparkSession
    bound = {"data": table, **(relations or {})}
    views = {name: f"bound_{uuid.uuid4().hex}" for name in bound}
    for name, df in bound.items():
        df.createOrReplaceTempView(views[name])
    try:
        named = ", ".join(f"{name} AS (SELECT * FROM {view})" for name, view in views.items())
        return spark.sql(f"WITH {named} (\n{_statement(query)}\n)")
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def _allowed(table: DataFrame, query: str, mode: str,
             relations: dict[str, DataFrame] | None = None) -> DataFrame:
    for name in relations or {}:
        if not _NAME.fullmatch(name) or name == "data":
            raise ValueError(f"{name!r} is no name of a relation")
    reason = check(table.sparkSession, query, mode, relations or ())
    if reason:
        raise ValueError(reason)
    return bind(table, query, relations)


def guarded(table: DataFrame, query: str, limit: int | None = None, mode: str = "strict",
            relations: dict[str, DataFrame] | None = None) -> DataFrame:
    """Checked, bound, capped and cleaned result; nothing runs until the caller acts.

    The cap is a limit around the query, so a column called ``credit_limit`` cannot hide it.
    """
    return clean_non_finite(_allowed(table, query, mode, relations).limit(row_limit(limit, mode)))


def guarded_flagged(table: DataFrame, query: str, limit: int | None = None,
                    mode: str = "strict") -> DataFrame:
    """As ``guarded``, with a column ``truncated`` that says whether the cap cut rows off."""
    n = row_limit(limit, mode)
    probed = _allowed(table, query, mode).limit(n + 1)
    total = probed.agg((F.count(F.lit(1)) > n).alias("cut"))
    return clean_non_finite(probed.limit(n).withColumn("truncated", total.scalar()))


@dataclass
class QueryResult:
    columns: list[str] = field(default_factory=list)
    data: list[dict] = field(default_factory=list)
    row_count: int = 0
    execution_time_ms: float = 0.0
    truncated: bool = False
    engine: str = "spark"
    error: str | None = None


def execute(table: DataFrame, query: str, limit: int | None = None,
            mode: str = "strict") -> QueryResult:
    """Result envelope with at most the capped number of rows; errors are reported, not raised."""
    started = time.perf_counter()
    n = row_limit(limit, mode)
    try:
        result = clean_non_finite(_allowed(table, query, mode).limit(n + 1))
        found = result.collect()  # at most the cap and one row
        rows = [r.asDict(recursive=True) for r in found[:n]]
        out = QueryResult(result.columns, rows, len(rows), truncated=len(found) > n)
    except Exception as e:  # the envelope carries the message to the user
        out = QueryResult(error=str(e))
    out.execution_time_ms = round((time.perf_counter() - started) * 1000, 2)
    return out


def grid_search(df: DataFrame, term: str) -> DataFrame:
    """Rows where any column contains the term, ignoring case."""
    needle = term.lower()
    hit = F.lit(False)
    for c in df.columns:
        hit = hit | F.coalesce(F.lower(F.col(c).cast("string")).contains(needle), F.lit(False))
    return df.where(hit)


def grid_order(column: str, descending: bool = False) -> list[Column]:
    """Numbers by value, then everything else as text."""
    number, text = F.col(column).cast("string").try_cast("double"), F.col(column).cast("string")
    return [number.desc_nulls_last(), text.desc_nulls_last()] if descending \
        else [number.asc_nulls_last(), text.asc_nulls_last()]


def grid_page(df: DataFrame, order: list[Column | str], page: int = 1,
              size: int = PAGE_SIZE) -> DataFrame:
    return df.orderBy(*order).offset((page - 1) * size).limit(size)
