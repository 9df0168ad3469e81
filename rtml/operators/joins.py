"""Joins on ranges and on the latest earlier row, without a nested loop and without a hot task.

An interval join becomes an equality join on buckets of a width that doubles from level to level:
an interval lies in the level at which it touches two buckets at most, a point looks into one bucket
of every level in use. The exact condition is tested on what meets. An as-of join is no join at all:
both sides are one ordered sequence, in which the last right-hand row is carried on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rtml.plans.prefix import CHUNK, as_number, quantile_bounds, running_totals, with_chunk
from rtml.session import bounded

#: Points of one bucket beyond which the bucket is split by salt.
HOT_ROWS = 500_000
_LEVELS = 256


def _number(df: DataFrame, name: str) -> Column:
    """Ordering number of a numeric, date or time column; null where it is null or not finite."""
    n = as_number(df, name)
    return F.when(~F.isnan(n) & (F.abs(n) < float("inf")), n)


def _level(length: Column, unit: float) -> Column:
    """Smallest level whose buckets, ``unit * 2^level`` wide, are at least as long."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(length / unit, F.lit(1e-9))))).cast("int")


def _unit(ranges: DataFrame) -> float:
    """Bucket width of level 0: a tenth of the mean length, so that few levels are in use.

    Any width is right. It only decides how many candidates are tested.
    """
    mean = ranges.agg(F.avg(F.when(F.col("_to") > F.col("_from"), F.col("_to") - F.col("_from")))) \
        .first()[0]
    return max((mean or 1.0) / 10, 1e-6)


def _meeting(points: DataFrame, ranges: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Rows of ``points`` (``_at``) and ``ranges`` (``_from``, ``_to``, ends included) that meet.

    Both have the ``keys`` under the names ``_k0``, ``_k1``, .. and one struct of what to keep.
    """
    unit = _unit(ranges)
    placed = ranges.withColumn("_lv", _level(F.col("_to") - F.col("_from"), unit))
    levels = sorted(r[0] for r in placed.select("_lv").distinct().limit(_LEVELS).collect())
    width = F.lit(unit) * F.pow(F.lit(2.0), F.col("_lv"))
    first, last = F.floor(F.col("_from") / width), F.floor(F.col("_to") / width)
    placed = placed.withColumn("_bk", F.explode(F.sequence(first, last)))  # two at most
    probes = points.withColumn("_lv", F.explode(F.array(*[F.lit(v).cast("int") for v in levels]))) \
        .withColumn("_bk", F.floor(F.col("_at") / width)) if levels else \
        points.withColumn("_lv", F.lit(0)).withColumn("_bk", F.lit(0).cast("long")).where("false")
    on = [*keys, "_lv", "_bk"]
    hot = bounded(probes.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
                  .where(F.col("_n") > hot_rows)
                  .select(*on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts")))
    probes = probes.join(hot, on, "left").withColumn("_salt", F.pmod(
        F.xxhash64("_at", "_point"), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    placed = placed.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(
        F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    met = probes.join(placed, [*on, "_salt"])
    return met.where((F.col("_from") <= F.col("_at")) & (F.col("_at") <= F.col("_to")))


def _pair_totals(points: DataFrame, ranges: DataFrame, keys: list[str], sums: list[str],
                 closed: bool) -> DataFrame:
    """Number of pairs and sums over them per ``_by``: what lies up to a range's end less what lies
    before its start, from running totals over one order of points and ends.

    Values that are not finite are counted apart, since they do not cancel.
    """
    known = [F.col(k).isNotNull() for k in keys]
    for condition in known:
        points, ranges = points.where(condition), ranges.where(condition)
    parts = {"_n": F.count(F.lit(1))}
    for i in range(len(sums)):
        v = F.col(f"_v{i}")
        finite = ~F.isnan(v) & (F.abs(v) < float("inf"))
        parts |= {f"_s{i}": F.sum(F.when(finite, v)), f"_m{i}": F.count(v),
                  f"_x{i}": F.count_if(F.isnan(v)), f"_h{i}": F.count_if(v == float("inf")),
                  f"_l{i}": F.count_if(v == float("-inf"))}
    at = points.where("_at IS NOT NULL").groupBy(*keys, "_at").agg(
        *[c.alias(name) for name, c in parts.items()]).withColumn("_side", F.lit(1))
    same = [*keys, "_by", "_from", "_to"]
    alike = ranges.where("_from <= _to").groupBy(*same).agg(F.count(F.lit(1)).alias("_times"))
    ends = alike.select("*", F.explode(F.array(
        F.struct(F.col("_from").alias("at"), F.lit(0).alias("side"), F.lit(-1).alias("sign")),
        F.struct(F.col("_to").alias("at"), F.lit(2 if closed else 0).alias("side"),
                 F.lit(1).alias("sign")))).alias("_e")) \
        .select(*same, "_times", F.col("_e.at").alias("_at"), F.col("_e.side").alias("_side"),
                F.col("_e.sign").alias("_sign"))
    both = at.unionByName(ends, allowMissingColumns=True)
    totals = running_totals(with_chunk(both, "_at", quantile_bounds(at, "_at")), keys, ["_at", "_side"],
                            {f"_to{name}": F.col(name) for name in parts})
    held = totals.where("_sign IS NOT NULL").groupBy(*same, "_times").agg(*[
        F.sum(F.coalesce(F.col(f"_to{name}"), F.lit(0)) * F.col("_sign")).alias(name)
        for name in parts])
    out = held.where("_n > 0").groupBy("_by").agg(*[
        F.sum(F.col(name) * F.col("_times")).alias(name) for name in parts])

    def total(i: int) -> Column:
        odd, high, low = (F.col(f"_{c}{i}") > 0 for c in "xhl")
        return F.when(F.col(f"_m{i}") == 0, F.lit(None)).when(odd | (high & low), float("nan")) \
            .when(high, float("inf")).when(low, float("-inf")).otherwise(F.col(f"_s{i}"))

    return out.select("_by.*", F.col("_n").alias("n"),
                      *[total(i).alias(c) for i, c in enumerate(sums)])


def _keyed(df: DataFrame, keys: list[str]) -> list[Column]:
    return [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]


def _names(keys: list[str]) -> list[str]:
    return [f"_k{i}" for i in range(len(keys))]


def _renamed(df: DataFrame, suffix: str, taken: set[str]) -> list[Column]:
    out = []
    for c in df.columns:
        name = c
        while name.lower() in taken:
            name += suffix
        taken.add(name.lower())
        out.append(F.col(c).alias(name))
    return out


def interval_join(points: DataFrame, ranges: DataFrame, at: str, start: str, end: str,
                  keys: list[str] = (), how: str = "inner", closed: bool = True,
                  hot_rows: int = HOT_ROWS, by: list[str] = (), sums: list[str] = ()) -> DataFrame:
    """Every point with every range that holds it: ``start <= at <= end``, or ``at < end`` if not
    ``closed``, and equal ``keys``.

    With ``by``, columns of ``ranges``, the pairs are counted and not made: one row per value of these
    columns that has pairs, with their number ``n`` and the sums of the columns ``sums`` of ``points``.
    The work then grows with points and ranges, not with their pairs, and ``how`` has no meaning.

    Columns of ``points``, then those of ``ranges``; a name that is there already gets ``_r``.
    ``how="left"`` keeps points without a range. Points and ends that are null or not finite, and
    null keys, meet nothing. ``at`` and the ends are numbers, dates or times of one kind; numbers
    are compared as doubles. A bucket with more than ``hot_rows`` points is split by salt.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    keys, names = list(keys), _names(keys)
    if by:
        return _pair_totals(
            points.select(_number(points, at).alias("_at"), *_keyed(points, keys),
                          *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(sums)]),
            ranges.select(F.struct(*by).alias("_by"), _number(ranges, start).alias("_from"),
                          _number(ranges, end).alias("_to"), *_keyed(ranges, keys)),
            names, list(sums), closed)
    taken: set[str] = set()
    mine = _renamed(points, "_r", taken)
    theirs = _renamed(ranges, "_r", taken)
    left = points.select(F.struct(*mine).alias("_point"), _number(points, at).alias("_at"),
                         *_keyed(points, keys))
    right = ranges.select(F.struct(*theirs).alias("_range"), _number(ranges, start).alias("_from"),
                          _number(ranges, end).alias("_to"), *_keyed(ranges, keys)) \
        .where("_from <= _to")
    met = _meeting(left.where("_at IS NOT NULL"), right, names, hot_rows)
    if not closed:
        met = met.where(F.col("_at") < F.col("_to"))
    if how == "left":  # equal points meet the same ranges, so the values say which met none
        seen = met.select(F.col("_point").alias("_seen")).distinct()
        lonely = left.select("_point").join(seen, F.col("_point").eqNullSafe(F.col("_seen")),
                                            "left_anti")
        met = met.select("_point", "_range").unionByName(lonely, allowMissingColumns=True)
    return met.select("_point.*", "_range.*")


def overlap_join(left: DataFrame, right: DataFrame, left_range: tuple[str, str],
                 right_range: tuple[str, str], keys: list[str] = (),
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every pair of ranges that share at least a point (ends included), with equal ``keys``.

    Two ranges overlap if the left one starts inside the right one, or the right one starts inside
    the left one and after its start: two interval joins whose results do not meet.
    """
    keys, names = list(keys), _names(keys)
    taken: set[str] = set()
    mine, theirs = _renamed(left, "_r", taken), _renamed(right, "_r", taken)
    a = left.select(F.struct(*mine).alias("_a"), _number(left, left_range[0]).alias("_from"),
                    _number(left, left_range[1]).alias("_to"), *_keyed(left, keys)) \
        .where("_from <= _to")
    b = right.select(F.struct(*theirs).alias("_b"), _number(right, right_range[0]).alias("_from"),
                     _number(right, right_range[1]).alias("_to"), *_keyed(right, keys)) \
        .where("_from <= _to")

    def starts(side: DataFrame, kept: str) -> DataFrame:
        return side.select(F.col(kept).alias("_point"), F.col("_from").alias("_at"), *names)

    inside = _meeting(starts(a, "_a"), b, names, hot_rows) \
        .select(F.col("_point").alias("_a"), "_b")
    after = _meeting(starts(b, "_b"), a, names, hot_rows).where(F.col("_at") > F.col("_from")) \
        .select("_a", F.col("_point").alias("_b"))
    return inside.unionByName(after).select("_a.*", "_b.*")


def asof_join(left: DataFrame, right: DataFrame, left_at: str, right_at: str,
              keys: list[str] = (), tolerance: float | None = None, strict: bool = False,
              direction: str = "backward", chunks: int | None = None) -> DataFrame:
    """Every left row with the latest right row of its ``keys`` that is not later (``strict``:
    earlier); with ``direction="forward"`` the first one that is not earlier.

    Both sides are laid in one order and cut into even chunks of it, so a key with a third of all
    rows is spread. The last right row of each key and chunk enters the next chunks as one carry
    row. ``tolerance`` is the largest distance, in seconds for times and dates. Right rows of the
    same time: the one largest in its columns, in their order. Left rows without a time, or without
    a match, keep null columns; null keys match null keys, as in a window. Right columns whose names
    are there already get ``_r``.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction must be backward or forward, not {direction!r}")
    keys, names = list(keys), _names(keys)
    taken: set[str] = set()
    mine, theirs = _renamed(left, "_r", taken), _renamed(right, "_r", taken)
    sign = 1 if direction == "backward" else -1
    time = left.schema[left_at].dataType.typeName() in ("timestamp", "timestamp_ntz", "date")
    a = left.select(F.struct(*mine).alias("_left"), F.lit(None).alias("_right"),
                    (_number(left, left_at) * sign).alias("_at"), *_keyed(left, keys))
    b = right.select(F.lit(None).alias("_left"), F.struct(*theirs).alias("_right"),
                     (_number(right, right_at) * sign).alias("_at"), *_keyed(right, keys)) \
        .where("_at IS NOT NULL")
    if strict:
        side = F.when(F.col("_left").isNotNull(), 0).otherwise(1)
    else:
        side = F.when(F.col("_left").isNotNull(), 1).otherwise(0)
    both = a.unionByName(b).withColumn("_side", side)
    cut = with_chunk(both, "_at", quantile_bounds(both, "_at", chunks), chunks)
    found = F.when(F.col("_right").isNotNull(), F.struct("_at", "_right"))
    rows = cut.withColumn("_found", found)
    last = rows.where("_found IS NOT NULL").groupBy(*names, CHUNK) \
        .agg(F.max("_found").alias("_found"))
    # one row per key and later chunk that holds left rows and follows a chunk with right rows
    here = rows.where("_left IS NOT NULL").groupBy(*names, CHUNK).agg(F.lit(1).alias("_here"))
    before = Window.partitionBy(*names or [F.lit(0)]).orderBy(CHUNK) \
        .rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(f"_h{n}").eqNullSafe(F.col(n)) for n in [*names, CHUNK]]
    here = here.select("_here", *[F.col(n).alias(f"_h{n}") for n in [*names, CHUNK]])
    match = same[0]
    for s in same[1:]:
        match = match & s
    walked = last.join(here, match, "full").select(
        *[F.coalesce(F.col(n), F.col(f"_h{n}")).alias(n) for n in [*names, CHUNK]], "_here", "_found")
    carry = walked.withColumn("_carried", F.last("_found", ignorenulls=True).over(before)) \
        .where("_here = 1 AND _carried IS NOT NULL") \
        .select(*names, CHUNK, F.col("_carried").alias("_found"), F.lit(-1).alias("_side"))
    ordered = rows.unionByName(carry, allowMissingColumns=True)
    latest = Window.partitionBy(*names, CHUNK) \
        .orderBy(F.when(F.col("_side") == -1, float("-inf")).otherwise(F.col("_at")), "_side",
                 F.col("_found._right").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ordered.withColumn("_seen", F.last("_found", ignorenulls=True).over(latest)) \
        .where("_left IS NOT NULL")
    good = F.col("_at").isNotNull()
    if tolerance is not None:
        good = good & (F.col("_at") - F.col("_seen._at") <= tolerance * (1e6 if time else 1))
    seen = F.when(good, F.col("_seen._right"))
    return out.select("_left", seen.alias("_right")).select("_left.*", "_right.*")
