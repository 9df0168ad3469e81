"""Ordered computations that never put one whole group into one task.

A running total, a rank or a lag over a hot key would sort that key in a single task. Here the
order is cut into chunks at explicit bounds, each (key, chunk) is computed on its own, and what
the earlier chunks add is fed in as one extra *carry row* per (key, chunk), so the carry needs
neither a join nor a broadcast. Chunk numbers are a function of the row's values alone, hence the
same on every recomputation after a lost executor.

An input that Spark estimates below ``rtml.chunk.minBytes`` (32 MB of files) is one chunk and takes
a plain window; so do keys without a hot value.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from rtml.session import ensure_checkpoint_dir, plan_bytes, shuffle_partitions

CHUNK = "_chunk"
_SRC = "_src"
_MAX_CHUNKS = 4096
_ONE = {"one_chunk": True}


def _small(df: DataFrame) -> bool:
    limit = int(df.sparkSession.conf.get("rtml.chunk.minBytes", str(32 << 20)))
    return plan_bytes(df) < limit


def _whole(df: DataFrame) -> DataFrame:
    """Everything in chunk 0, marked so that no carry is computed."""
    return df.withColumn(CHUNK, F.lit(0).alias(CHUNK, metadata=_ONE))


def _is_whole(df: DataFrame, chunk: str) -> bool:
    return df.schema[chunk].metadata == _ONE


def as_number(df: DataFrame, name: str) -> Column:
    """Order-preserving double of a numeric, date or timestamp column."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def quantile_bounds(df: DataFrame, order: str, chunks: int | None = None) -> list[float]:
    """Cut points giving chunks of about equal row counts; one mergeable-sketch pass.

    The result holds at most ``_MAX_CHUNKS`` numbers whatever the table size.
    """
    n = min(chunks or shuffle_partitions(df.sparkSession), _MAX_CHUNKS)
    if n < 2 or (chunks is None and _small(df)):
        return []
    numbers = df.select(as_number(df, order).alias("v"))
    cuts = numbers.approxQuantile("v", [i / n for i in range(1, n)], 1 / (4 * n))
    return sorted(set(cuts))


def with_chunk(df: DataFrame, order: str, bounds: list[float] | None = None,
               chunks: int | None = None) -> DataFrame:
    """Add the chunk number of ``order``; equal values always share a chunk."""
    if bounds is None:
        bounds = quantile_bounds(df, order, chunks)
    if not bounds:
        return _whole(df)
    cutter = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="_order_number",
                        outputCol=CHUNK, handleInvalid="keep")
    numbered = df.withColumn("_order_number", as_number(df, order))
    return (cutter.transform(numbered).withColumn(CHUNK, F.col(CHUNK).cast("int"))
            .drop("_order_number"))


def with_hot_chunk(df: DataFrame, keys: list[str], order: str, hot_rows: int = 5_000_000,
                   chunks: int | None = None) -> DataFrame:
    """Chunk only keys that hold more than ``hot_rows`` rows; all other keys stay whole.

    At most ``rows / hot_rows`` keys can be hot, which bounds the table joined below; Spark still
    checks its size before choosing a broadcast.
    """
    hot = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
           .select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot")))
    if _small(df) or hot.isEmpty():
        return _whole(df)
    match = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_hot_{k}"))
        match = same if match is None else match & same
    cut = with_chunk(df, order, chunks=chunks).join(hot, match, "left")
    return (cut.withColumn(CHUNK, F.when(F.col("_hot"), F.col(CHUNK)).otherwise(0))
            .drop("_hot", *[f"_hot_{k}" for k in keys]))


def _by(keys: list[str], *more: str):
    cols = [*keys, *more]
    return Window.partitionBy(*cols) if cols else Window.partitionBy(F.lit(0))


def _framed(w: WindowSpec, peers: bool) -> WindowSpec:
    if peers:
        return w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_totals(df: DataFrame, keys: list[str], order: list[Column | str],
                   measures: dict[str, Column], descending: bool = False,
                   peers: bool = False, chunk: str = CHUNK) -> DataFrame:
    """Inclusive running sums per key in ``order``; ``df`` carries a chunk column.

    ``descending`` says that chunks are walked from the highest number down (the order columns
    must then descend too). ``peers`` includes all rows equal in order. The chunk column is kept.
    """
    if _is_whole(df, chunk):
        w = _framed(_by(keys).orderBy(*order), peers)
        return df.select("*", *[F.sum(col).over(w).alias(name) for name, col in measures.items()])
    tmp = {name: f"_in_{name}" for name in measures}
    rows = df.select("*", *[col.alias(tmp[name]) for name, col in measures.items()])
    totals = rows.groupBy(*keys, chunk).agg(*[F.sum(t).alias(t) for t in tmp.values()])
    chunk_order = F.col(chunk).desc() if descending else F.col(chunk).asc()
    before = _by(keys).orderBy(chunk_order).rowsBetween(Window.unboundedPreceding, -1)
    position = F.row_number().over(_by(keys).orderBy(chunk_order))
    carry = (totals.select(*keys, chunk, position.alias("_pos"),
                           *[F.sum(t).over(before).alias(t) for t in tmp.values()])
             .where("_pos > 1").drop("_pos").withColumn(_SRC, F.lit(0)))
    both = rows.withColumn(_SRC, F.lit(1)).unionByName(carry, allowMissingColumns=True)
    w = _framed(_by(keys, chunk).orderBy(_SRC, *order), peers)
    out = both.select("*", *[F.sum(tmp[name]).over(w).alias(name) for name in measures])
    return out.where(F.col(_SRC) == 1).drop(_SRC, *tmp.values())


def row_numbers(df: DataFrame, keys: list[str], order: list[Column | str],
                out: str = "rn", chunk: str = CHUNK) -> DataFrame:
    """1-based position per key; the chunk column is dropped."""
    return running_totals(df, keys, order, {out: F.lit(1).cast("long")}, chunk=chunk).drop(chunk)


def previous_value(df: DataFrame, keys: list[str], order: str, values: list[str],
                   prefix: str = "prev_", chunk: str = CHUNK) -> DataFrame:
    """Value of the preceding row of the same key, across chunk borders.

    ``order`` should be unique per key; among equal values any row may be the preceding one.
    """
    if _is_whole(df, chunk):
        w = _by(keys).orderBy(order)
        return df.select("*", *[F.lag(v).over(w).alias(f"{prefix}{v}") for v in values])
    last = (df.groupBy(*keys, chunk)
            .agg(F.max(order).alias(order),
                 *[F.max_by(v, order).alias(v) for v in values if v != order]))
    before = _by(keys).orderBy(chunk)
    carried = list(dict.fromkeys([order, *values]))
    carry = (last.select(*keys, chunk, F.row_number().over(before).alias("_pos"),
                         *[F.lag(v).over(before).alias(v) for v in carried])
             .where("_pos > 1").drop("_pos").withColumn(_SRC, F.lit(0)))
    both = df.withColumn(_SRC, F.lit(1)).unionByName(carry, allowMissingColumns=True)
    w = _by(keys, chunk).orderBy(_SRC, order)
    out = both.select("*", *[F.lag(v).over(w).alias(f"{prefix}{v}") for v in values])
    return out.where(F.col(_SRC) == 1).drop(_SRC)


def overlapped(df: DataFrame, position: str, rows_per_block: int, overlap: int,
               out: str = "_block", own: str = "_own") -> DataFrame:
    """Cut 1-based positions into blocks; the last ``overlap`` rows of a block are also copied to
    the next one, flagged ``own = false``, so a trailing frame of ``overlap + 1`` rows is complete
    inside each block."""
    if overlap >= rows_per_block:
        raise ValueError("a block must be longer than the overlap")
    block = F.floor((F.col(position) - 1) / F.lit(rows_per_block))
    in_tail = F.pmod(F.col(position) - 1, F.lit(rows_per_block)) >= rows_per_block - overlap
    copies = F.when(in_tail, F.array(F.struct(block.alias("b"), F.lit(True).alias("o")),
                                     F.struct((block + 1).alias("b"), F.lit(False).alias("o")))) \
        .otherwise(F.array(F.struct(block.alias("b"), F.lit(True).alias("o"))))
    return (df.withColumn("_copy", F.explode(copies))
            .select(*df.columns, F.col("_copy.b").alias(out), F.col("_copy.o").alias(own)))


def ordered_index(df: DataFrame, order: list[Column], out: str = "idx",
                  partitions: int | None = None) -> DataFrame:
    """0-based global position in ``order``, for any sortable type (strings included).

    Rows are range-partitioned and sorted, then fixed by a reliable checkpoint, so partition
    numbers cannot change on recomputation; per-partition counts (one row each) give the offsets.
    """
    ensure_checkpoint_dir(df.sparkSession)
    n = partitions or shuffle_partitions(df.sparkSession)
    fixed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint()
    placed = fixed.withColumn("_id", F.monotonically_increasing_id()) \
        .withColumn("_part", F.shiftright("_id", 33)) \
        .withColumn("_row", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part") \
        .rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # one row per partition: the bound for this broadcast is the partition count itself
    return (placed.join(F.broadcast(starts), "_part")
            .withColumn(out, F.col("_start") + F.col("_row"))
            .drop("_id", "_part", "_row", "_start"))


_SKETCH_ERROR = 1e-3
_BRACKET_ROWS = 500_000
_ALL = (float("-inf"), float("inf"))


def _brackets(df: DataFrame, columns: list[str], rows: int,
              wanted: list[float]) -> dict[tuple[str, float], tuple[float, float]]:
    """Value ranges that surely hold the wanted positions: the sketch's rank error, three times.

    Few rows need no narrowing.
    """
    if rows <= _BRACKET_ROWS:
        return {(c, q): _ALL for c in columns for q in wanted}
    margin = 3 * _SKETCH_ERROR
    probes = [p for q in wanted for p in (max(0.0, q - margin), min(1.0, q + margin))]
    out = {}
    for c, found in zip(columns, df.approxQuantile(columns, probes, _SKETCH_ERROR)):
        for q, lo, hi in zip(wanted, found[::2], found[1::2]):
            out[c, q] = (_ALL[0] if q <= margin else lo, _ALL[1] if q >= 1 - margin else hi)
    return out


def exact_quantiles_of(df: DataFrame, columns: list[str],
                       quantiles: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles, one row ``(column, <names>)`` per column; nulls and NaN ignored.

    A quantile sketch first brackets each position, then only the values inside the brackets (about
    six thousandths of the rows each) are counted and ordered, in chunks. No task holds all values,
    as the built-in exact ``percentile`` would. Three passes whatever the number of columns.
    """
    numbers = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c)
                          for c in columns])
    sizes = numbers.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    wanted = sorted(set(quantiles.values()))
    brackets = _brackets(numbers, columns, max(sizes.values()), wanted)
    slots = sorted({(c, *b) for (c, _), b in brackets.items()})
    index = {s: i for i, s in enumerate(slots)}

    found = F.array_compact(F.array(*[
        F.when((F.col(c) >= lo) & (F.col(c) <= hi), F.struct(F.lit(i).alias("i"),
                                                            F.col(c).alias("v")))
        for i, (c, lo, hi) in enumerate(slots)]))
    counts = numbers.select(F.explode(found).alias("p")) \
        .groupBy(F.col("p.i").alias("_i"), F.col("p.v").alias("_v")) \
        .agg(F.count(F.lit(1)).alias("_n"))
    if all(lo == _ALL[0] or hi == _ALL[1] for _, lo, hi in slots):
        cut = _whole(counts)
    else:
        n = shuffle_partitions(df.sparkSession)
        low = F.element_at(F.array(*[F.lit(s[1]) for s in slots]), F.col("_i") + 1)
        high = F.element_at(F.array(*[F.lit(s[2]) for s in slots]), F.col("_i") + 1)
        finite = (F.abs(low) < float("inf")) & (F.abs(high) < float("inf")) & (high > low)
        part = F.least(F.floor((F.col("_v") - low) / (high - low) * n), F.lit(n - 1))
        cut = counts.withColumn(CHUNK, F.when(finite, part).otherwise(0).cast("int"))
    cum = running_totals(cut, ["_i"], ["_v"], {"_cum": F.col("_n")}).drop(CHUNK)
    below = numbers.agg(F.array(*[F.count_if(F.col(c) < lo) for c, lo, _ in slots]))
    ranked = cum.withColumn("_below", below.scalar()) \
        .withColumn("_rank", F.col("_cum") + F.element_at("_below", F.col("_i") + 1))

    aggs = []
    for k, c in enumerate(columns):
        for m, q in enumerate(quantiles.values()):
            at = max(sizes[c] - 1, 0) * q
            low_at, high_at = int(at), -int(-at // 1)
            mine = F.col("_i") == index[c, *brackets[c, q]]
            first = F.min(F.when(mine & (F.col("_rank") > low_at), F.col("_v")))
            second = F.min(F.when(mine & (F.col("_rank") > high_at), F.col("_v")))
            aggs.append((first + (second - first) * (at - low_at)).alias(f"_{k}_{m}"))
    lines = F.array(*[F.struct(F.lit(c).alias("column"), *[
        F.col(f"_{k}_{m}").alias(name) for m, name in enumerate(quantiles)])
        for k, c in enumerate(columns)])
    return ranked.agg(*aggs).select(F.explode(lines).alias("p")).select("p.*")


def exact_quantiles(df: DataFrame, value: str, quantiles: dict[str, float]) -> DataFrame:
    """Quantiles of one column in one row."""
    return exact_quantiles_of(df, [value], quantiles).drop("column")


def grouped_quantiles(df: DataFrame, value: str, quantiles: dict[str, float],
                      keys: list[str]) -> DataFrame:
    """Linearly interpolated quantiles per key from value counts; nulls are ignored.

    Works on counts of distinct values and chunked running totals, so no task ever holds all
    values of a group (the built-in exact ``percentile`` would).
    """
    present = df.where(F.col(value).isNotNull()).select(*keys, value)
    bounds = quantile_bounds(present, value)
    counts = present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    cum = running_totals(with_chunk(counts, value, bounds), keys, [value], {"_cum": F.col("_n")})
    size = counts.groupBy(*[F.col(k).alias(f"_s_{k}") for k in keys]) \
        .agg(F.sum("_n").alias("_size"))
    match = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_s_{k}"))
        match = same if match is None else match & same
    ranked = cum.join(size, match)
    aggs = []
    for name, q in quantiles.items():
        pos = (F.col("_size") - 1) * F.lit(float(q))
        low, high = F.floor(pos), F.ceil(pos)
        at_low = F.min(F.when(F.col("_cum") > low, F.col(value)))
        at_high = F.min(F.when(F.col("_cum") > high, F.col(value)))
        frac = F.max(pos - low)
        aggs.append((at_low + (at_high - at_low) * frac).cast("double").alias(name))
    return ranked.groupBy(*keys).agg(*aggs)
