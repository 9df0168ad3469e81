"""Label dictionaries, encoders, scalers and class weights.

A label code comes from a dictionary of distinct values, never from a window over the fact table.
Dictionary sizes are checked first, over all rows: a small one is ranked in one window and broadcast,
a large one is ranked over range partitions and joined with a shuffle; both give the same codes.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StandardScaler, StringIndexer, \
    VectorAssembler
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rtml.plans.prefix import ordered_index, row_numbers, running_totals, with_chunk
from rtml.session import bounded, scratch_path

SMALL_DICTIONARY = 1_000_000
LOCAL_DICTIONARY = 20_000
LITERAL_TEXTS = 128
BROADCAST_BYTES = 64 << 20
_LOCAL_TYPES = (T.StringType, T.IntegralType, T.DoubleType, T.FloatType, T.BooleanType, T.DateType)


def _plain_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """-0.0 as 0.0 in floating columns, so that text and number agree on what is distinct."""
    out = {c: F.when(F.col(c) == 0, F.lit(0.0)).otherwise(F.col(c)).cast(df.schema[c].dataType)
           for c in columns if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(out) if out else df


def codes_of(df: DataFrame, column: str, large: bool = False) -> DataFrame:
    """Dictionary ``(value, code)`` of one column: codes 0.. in value order, null last."""
    values = _plain_zero(df.select(F.col(column).alias("value")), ["value"]).distinct()
    if large:
        # a null is ranked after all values without disturbing the range partitions
        ranked = ordered_index(values, [F.col("value").asc_nulls_last()], out="code")
        return ranked.select("value", F.col("code").cast("long").alias("code"))
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("value").asc_nulls_last())
    return values.select("value", (F.dense_rank().over(w) - 1).cast("long").alias("code"))


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct ``(feature, value)`` of several columns as text, from one pass over the rows."""
    return _plain_zero(df, columns).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("p")).select("p.feature", "p.value").distinct()


def value_sizes(values: DataFrame) -> dict[str, tuple[int, int]]:
    """Number of distinct values and length of the longest per feature."""
    rows = values.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.max(F.octet_length("value")), F.lit(0)).alias("longest")).collect()
    return {r.feature: (r.n, r.longest) for r in rows}  # one row per column


def ranked_lists(values: DataFrame, types: dict[str, T.DataType]) -> dict[str, list[str | None]]:
    """Values of counted, short features in the order of their own type, null last."""
    if not types:
        return {}
    found = values.where(F.col("feature").isin(list(types))).toArrow()
    out = {}
    for c, kind in types.items():
        listed = found.filter(pc.equal(found["feature"], c))["value"].to_pylist()
        texts = [v for v in listed if v is not None]
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            texts.sort(key=lambda v: (v == "NaN", float(v) if v != "NaN" else 0.0))
        elif isinstance(kind, T.IntegralType):
            texts.sort(key=int)
        else:
            texts.sort(key=lambda v: v.encode())
        out[c] = [*texts, *([None] if len(texts) < len(listed) else [])]
    return out


def local_table(df: DataFrame, column: str, ranked: list[str | None]) -> DataFrame:
    """``(value, code)`` of a ranked list, in the column's own type."""
    table = pa.table({"value": pa.array(ranked, pa.string()),
                      "code": pa.array(range(len(ranked)), pa.int64())})
    return df.sparkSession.createDataFrame(table) \
        .select(F.col("value").cast(df.schema[column].dataType).alias("value"), "code")


def literal_code(df: DataFrame, column: str, ranked: list[str | None]) -> Column | None:
    """Code of a column as an expression without a join, or None where a join serves better.

    Whole numbers of a narrow span address an array of codes by value; a few texts form a map, which
    Spark searches from the front.
    """
    kind = df.schema[column].dataType
    texts = [v for v in ranked if v is not None]
    codes = F.lit(None).cast("long")
    if texts and isinstance(kind, T.IntegralType):
        low, span = int(texts[0]), int(texts[-1]) - int(texts[0]) + 1
        if span > LOCAL_DICTIONARY:
            return None
        cells: list[int | None] = [None] * span
        for code, v in enumerate(texts):
            cells[int(v) - low] = code
        place = F.col(column).cast("long") - F.lit(low)
        inside = place.between(0, span - 1)
        codes = F.when(inside, F.get(F.lit(cells) if None not in cells else F.array(
            *[F.lit(c) for c in cells]), place.cast("int"))).cast("long")
    elif texts:
        if not isinstance(kind, T.StringType) or len(texts) > LITERAL_TEXTS:
            return None
        codes = F.element_at(F.create_map(*[F.lit(x) for code, v in enumerate(texts)
                                            for x in (v, code)]), F.col(column)).cast("long")
    if len(texts) < len(ranked):
        codes = F.when(F.col(column).isNull(), F.lit(len(texts)).cast("long")).otherwise(codes)
    return codes


def long_codes(values: DataFrame, columns: list[str]) -> dict[str, DataFrame]:
    """Dictionaries of several text features, ranked together in one window each.

    The result is a written table with a folder per feature, so a join reads its own dictionary only.
    """
    if not columns:
        return {}
    w = Window.partitionBy("feature").orderBy(F.col("value").asc_nulls_last())
    path = scratch_path(values.sparkSession, "codes")
    values.where(F.col("feature").isin(columns)) \
        .select("feature", "value", (F.row_number().over(w) - 1).cast("long").alias("code")) \
        .write.partitionBy("feature").parquet(path)
    table = values.sparkSession.read.schema("value string, code long, feature string").parquet(path)
    return {c: table.where(F.col("feature") == c).select("value", "code") for c in columns}


def dictionaries(df: DataFrame, columns: list[str], small_limit: int = SMALL_DICTIONARY
                 ) -> dict[str, tuple[DataFrame | list, bool]]:
    """``(value, code)`` table, or ranked list, of every column and whether it may be broadcast.

    One pass over the rows finds the distinct values of all columns; their counts only choose between
    equal ways: short dictionaries become lists, texts of up to ``small_limit`` values are ranked in a
    window per column, more over range partitions. A broadcast also needs values times longest text
    within a fixed bound.
    """
    types = {c: df.schema[c].dataType for c in columns}
    plain = [c for c in columns if isinstance(types[c], _LOCAL_TYPES)]
    values = distinct_values(df, columns).persist()
    try:
        sizes = value_sizes(values)
        sizes = {c: sizes.get(c, (0, 0)) for c in columns}
        short = {c: types[c] for c in plain if sizes[c][0] <= min(LOCAL_DICTIONARY, small_limit) and
                 sizes[c][0] * sizes[c][1] <= BROADCAST_BYTES // 8}
        found = {**ranked_lists(values, short), **long_codes(values, [
            c for c in plain if c not in short and sizes[c][0] <= small_limit and
            isinstance(types[c], T.StringType)])}
    finally:
        values.unpersist()
    out = {}
    for c in columns:
        n, longest = sizes[c]
        fits = n <= small_limit and n * (longest + 16) <= BROADCAST_BYTES
        out[c] = (found[c] if c in found else codes_of(df, c, n > small_limit), fits)
    return out


def label_dictionary(df: DataFrame, columns: list[str],
                     small_limit: int = SMALL_DICTIONARY) -> DataFrame:
    """Long dictionary ``(feature, value, code)``; values as text, codes in the value's own order."""
    tables = {c: local_table(df, c, t) if isinstance(t, list) else t
              for c, (t, _) in dictionaries(df, columns, small_limit).items()}
    parts = [tables[c].select(F.lit(c).alias("feature"), F.col("value").cast("string").alias("value"), "code")
             for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def label_encode(df: DataFrame, columns: list[str], suffix: str = "",
                 small_limit: int = SMALL_DICTIONARY, source: DataFrame | None = None) -> DataFrame:
    """Replace (or add, with a suffix) label codes; ``source`` supplies the dictionary rows.

    Short dictionaries become literals of one projection. Others are joined: with a broadcast where
    their size is counted and bounded, with a shuffle else.
    """
    base = df if source is None else source
    tables = dictionaries(base, columns, small_limit)
    out, coded = df, {}
    for c in columns:
        table, fits = tables[c]
        if isinstance(table, list):
            same = df.schema[c].dataType == base.schema[c].dataType
            code = literal_code(df, c, table) if same else None
            if code is not None:
                coded[f"{c}{suffix}"] = code
                continue
            table = local_table(base, c, table)
        codes = table.select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_c_{c}"))
        if fits:
            codes = F.broadcast(codes)
        out = out.join(codes, F.col(c).eqNullSafe(F.col(f"_v_{c}")), "left").drop(f"_v_{c}")
        coded[f"{c}{suffix}"] = F.col(f"_c_{c}")
    return out.withColumns(coded).drop(*[f"_c_{c}" for c in columns])


def apply_dictionary(df: DataFrame, dictionary: DataFrame, columns: list[str],
                     unknown: str = "zero", suffix: str = "_code",
                     small_limit: int = SMALL_DICTIONARY) -> DataFrame:
    """Encode with a given ``(feature, value, code)`` dictionary.

    ``unknown``: ``zero`` codes a missing value 0; ``overflow`` codes it dictionary size + 1 (0 when
    the feature has no dictionary at all); ``null`` leaves it null.
    """
    found = dictionary.where(F.col("feature").isin(columns)).groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes")).collect()
    sizes = {r.feature: r.n for r in found}  # one row per feature
    fits = {r.feature for r in found if r.n <= small_limit and
            r.bytes + 16 * r.n <= BROADCAST_BYTES}
    out = df
    for c in columns:
        codes = dictionary.where(F.col("feature") == c) \
            .select(F.col("value").alias("_value"), F.col("code").alias(f"{c}{suffix}"))
        if c in fits or c not in sizes:
            codes = F.broadcast(codes)
        out = out.join(codes, F.col(c).cast("string").eqNullSafe(F.col("_value")), "left") \
            .drop("_value")
        if unknown == "zero":
            fill = 0
        elif unknown == "overflow":
            fill = sizes[c] + 1 if c in sizes else 0
        elif unknown == "null":
            continue
        else:
            raise ValueError(f"unknown must be zero, overflow or null, not {unknown!r}")
        out = out.withColumn(f"{c}{suffix}",
                             F.coalesce(F.col(f"{c}{suffix}"), F.lit(fill).cast("long")))
    return out


def first_seen_dictionary(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """``(feature, value, first_at, code)``: codes by first appearance in ``order``, nulls included."""
    long = df.select(F.col(order).alias("first_at"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("p"))
    first = long.groupBy("p.feature", "p.value").agg(F.min("first_at").alias("first_at"))
    ranked = row_numbers(with_chunk(first, "first_at"), ["feature"], ["first_at", "value"])
    return ranked.select("feature", "value", "first_at", (F.col("rn") - 1).alias("code"))


def dictionary_as_map(dictionary: DataFrame, max_entries: int = SMALL_DICTIONARY) -> DataFrame:
    """Export form, one row per feature: ``mapping`` value to code and ``next_id``.

    Only for dictionaries of at most ``max_entries`` entries; larger ones stay a table.
    """
    n = dictionary.count()
    if n > max_entries:
        raise ValueError(f"{n} entries; export the table instead of a map")
    return dictionary.groupBy("feature").agg(
        F.map_from_entries(F.array_sort(F.collect_list(
            F.struct(F.coalesce("value", F.lit("None")).alias("k"), "code")))).alias("mapping"),
        (F.max("code") + 1).alias("next_id"))


def standard_scale(df: DataFrame, columns: list[str], suffix: str = "_scaled") -> DataFrame:
    """(x - mean) / population std over all rows; a constant column scales to 0."""
    stats = df.agg(F.struct(*[
        F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c)
        for c in columns]).alias("v")).scalar()
    tmp = df.withColumn("_stats", stats)
    out = {f"{c}{suffix}": (F.col(c) - F.col(f"_stats.{c}.m")) /
           F.when(F.col(f"_stats.{c}.s") == 0, 1.0).otherwise(F.col(f"_stats.{c}.s"))
           for c in columns}
    return tmp.withColumns(out).drop("_stats")


def min_max_scale(df: DataFrame, columns: list[str], suffix: str = "_norm") -> DataFrame:
    stats = df.agg(F.struct(*[
        F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c)
        for c in columns]).alias("v")).scalar()
    tmp = df.withColumn("_stats", stats)
    out = {f"{c}{suffix}": F.coalesce(F.try_divide(
        (F.col(c) - F.col(f"_stats.{c}.lo")).cast("double"),
        (F.col(f"_stats.{c}.hi") - F.col(f"_stats.{c}.lo")).cast("double")), F.lit(0.0))
        for c in columns}
    return tmp.withColumns(out).drop("_stats")


def running_scale(df: DataFrame, columns: list[str], order: str, keys: list[str] | None = None,
                  suffix: str = "_scaled") -> DataFrame:
    """Online scaling: the statistics include the current row; zero variance gives 0.

    Values are centred on the global mean first, which keeps the running sums of squares stable.
    """
    keys = keys or []
    base = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("v")).scalar()
    tmp = df.withColumn("_base", base)
    measures: dict[str, Column] = {}
    for c in columns:
        x = F.col(c) - F.col(f"_base.{c}")
        measures |= {f"_n_{c}": F.when(x.isNotNull(), 1).otherwise(0).cast("long"),
                     f"_s_{c}": F.coalesce(x, F.lit(0.0)), f"_q_{c}": F.coalesce(x * x, F.lit(0.0))}
    run = running_totals(with_chunk(tmp, order), keys, [order], measures)
    out = {}
    for c in columns:
        mean = F.col(f"_s_{c}") / F.col(f"_n_{c}")
        var = F.col(f"_q_{c}") / F.col(f"_n_{c}") - mean * mean
        scaled = (F.col(c) - F.col(f"_base.{c}") - mean) / F.sqrt(var)
        out[f"{c}{suffix}"] = F.when(F.col(c).isNull(), None) \
            .when((F.col(f"_n_{c}") > 1) & (var > 1e-12), scaled).otherwise(0.0)
    return run.withColumns(out).select(*df.columns, *out)


def hash_features(df: DataFrame, columns: list[str], num_features: int = 1024,
                  out: str = "hashed") -> DataFrame:
    return FeatureHasher(inputCols=columns, outputCol=out, numFeatures=num_features).transform(df)


def category_values(df: DataFrame, column: str, max_categories: int = 1000) -> list:
    """Sorted distinct values that become columns, hence bounded."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct() \
        .limit(max_categories + 1).collect()
    if len(rows) > max_categories:
        raise ValueError(f"{column} has more than {max_categories} categories; hash it instead")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, column: str, categories: list | None = None) -> DataFrame:
    """One 0/1 column per category; a value outside the list is all zeros."""
    categories = category_values(df, column) if categories is None else categories
    return df.withColumns({f"{column}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"),
                                                       F.lit(0)) for v in categories})


def column_transformer(numeric: list[str], binary: list[str], categorical: list[str],
                       out: str = "features") -> Pipeline:
    """Scaled numerics + untouched binaries + one-hot categoricals; fit it on the training part."""
    stages = [VectorAssembler(inputCols=numeric, outputCol="_num", handleInvalid="keep"),
              StandardScaler(inputCol="_num", outputCol="_num_scaled", withMean=True, withStd=True)]
    encoded = []
    for c in categorical:
        stages += [StringIndexer(inputCol=c, outputCol=f"_{c}_ix", handleInvalid="keep",
                                 stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCol=f"_{c}_ix", outputCol=f"_{c}_oh", dropLast=True)]
        encoded.append(f"_{c}_oh")
    stages.append(VectorAssembler(inputCols=["_num_scaled", *binary, *encoded], outputCol=out,
                                  handleInvalid="keep"))
    return Pipeline(stages=stages)


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop("any", subset=columns)


def assemble(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="keep").transform(df)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """One row per class: count and the balanced weight n / (classes * n_c)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).alias("t"))
    return counts.withColumn("_t", total.scalar()).select(
        label, "n", (F.col("_t.n") / (F.col("_t.k") * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(F.col(label).alias("_label"),
                                              F.col("weight").alias(out))
    return df.join(bounded(weights), F.col(label).eqNullSafe(F.col("_label")), "left").drop("_label")


def negative_positive_ratio(df: DataFrame, label: str) -> DataFrame:
    pos = F.count_if(F.col(label) == 1)
    neg = F.count_if(F.col(label) == 0)
    return df.agg(neg.alias("negatives"), pos.alias("positives"),
                  F.try_divide(neg.cast("double"), pos.cast("double")).alias("ratio"))
