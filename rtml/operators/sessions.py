"""Sessions over an event stream: ids, sequence numbers, funnel, activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rtml.plans.prefix import CHUNK, previous_value, running_totals, with_chunk, with_hot_chunk

INACTIVITY_SECONDS = 15 * 60
HOT_USER_ROWS = 5_000_000


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def session_ids(df: DataFrame, user: str, ts: str, gap_seconds: int = INACTIVITY_SECONDS,
                hot_rows: int | None = HOT_USER_ROWS) -> DataFrame:
    """Add ``session_no`` (1.. per user): a new session starts after more than the gap.

    Users with more than ``hot_rows`` events are cut into time chunks, so one user never fills one
    task; ``None`` cuts every user.
    """
    cut = with_chunk(df, ts) if hot_rows is None else with_hot_chunk(df, [user], ts, hot_rows)
    prev = previous_value(cut, [user], ts, [ts])
    gap = _micros(ts) - _micros(f"prev_{ts}")
    starts = F.when(F.col(f"prev_{ts}").isNull() | (gap > gap_seconds * 1_000_000), 1).otherwise(0)
    numbered = running_totals(prev, [user], [ts], {"session_no": starts.cast("long")}, peers=True)
    return numbered.drop(f"prev_{ts}", CHUNK)


def session_sequence(df: DataFrame, session: list[str], order: str,
                     hot_rows: int | None = HOT_USER_ROWS) -> DataFrame:
    """Add ``sequence`` (1.. within the session)."""
    cut = with_chunk(df, order) if hot_rows is None \
        else with_hot_chunk(df, session, order, hot_rows)
    return running_totals(cut, session, [order], {"sequence": F.lit(1).cast("long")}).drop(CHUNK)


def session_summary(df: DataFrame, session: list[str], ts: str) -> DataFrame:
    return df.groupBy(*session).agg(F.min(ts).alias("started"), F.max(ts).alias("ended"),
                                    F.count(F.lit(1)).alias("events"))


def session_windows(df: DataFrame, user: str, ts: str,
                    gap_seconds: int = INACTIVITY_SECONDS) -> DataFrame:
    """Sessions by the built-in session window (batch or streaming).

    Set ``spark.sql.sessionWindow.merge.sessions.in.local.partition`` (a default of this package's
    sessions), so a hot user's rows are merged into sessions before the shuffle.
    """
    return df.groupBy(user, F.session_window(F.col(ts).cast("timestamp"), f"{gap_seconds} seconds")
                      .alias("w")) \
        .agg(F.count(F.lit(1)).alias("events")) \
        .select(user, F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "events")


def funnel(df: DataFrame, session: list[str], kind: str, ts: str, steps: list[str]) -> DataFrame:
    """One row: sessions that reached each step in order, and step-to-step rates.

    A step counts when its first occurrence is not earlier than the first occurrence of every
    step before it.
    """
    first = df.where(F.col(kind).isin(steps)).groupBy(*session).agg(*[
        F.min(F.when(F.col(kind) == s, F.col(ts))).alias(f"_t{i}") for i, s in enumerate(steps)])
    reached, chain = [], F.lit(True)
    for i in range(len(steps)):
        ok = F.col(f"_t{i}").isNotNull()
        if i:
            ok = ok & (F.col(f"_t{i}") >= F.col(f"_t{i - 1}"))
        chain = chain & ok
        reached.append(chain)
    counts = first.agg(*[F.count_if(r).alias(f"sessions_{s}") for s, r in zip(steps, reached)])
    return counts.select("*", *[
        F.coalesce(F.try_divide(F.col(f"sessions_{b}").cast("double"),
                                F.col(f"sessions_{a}").cast("double")), F.lit(0.0))
        .alias(f"rate_{a}_{b}") for a, b in zip(steps, steps[1:])])


def active_sessions(df: DataFrame, session: list[str], ts: str, now: Column | None = None,
                    within_seconds: int = INACTIVITY_SECONDS) -> DataFrame:
    """Sessions whose last event is less than ``within_seconds`` before ``now`` (newest event)."""
    last = df.groupBy(*session).agg(F.max(_micros(ts)).alias("_last"))
    at = df.agg(F.max(_micros(ts))).scalar() if now is None \
        else F.unix_micros(now.cast("timestamp"))
    return last.agg(F.count(F.lit(1)).alias("sessions"),
                    F.count_if(at - F.col("_last") < within_seconds * 1_000_000)
                    .alias("active_sessions"))
