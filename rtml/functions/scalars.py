"""Column expressions: JSON, time, numbers, text, distances. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed values of the trip domain.
EARTH_RADIUS_KM = 6371.0
BASE_SPEED_KMH = 40.0
MIN_TRAVEL_SECONDS = 60
MORNING_RUSH = (6, 9)
EVENING_RUSH = (16, 19)


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """Ordered feature projection: the column order is the contract."""
    return df.select(*columns)


def bool_to_int(c: Column) -> Column:
    return c.cast("boolean").cast("int")


def default_value(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def json_text(c: Column, key: str) -> Column:
    return F.get_json_object(c, f"$.{key}")


def json_struct(c: Column, ddl: str) -> Column:
    """Decode once into a struct; several fields then cost a single parse."""
    return F.from_json(c, ddl)


def json_or_default(c: Column, ddl: str, defaults: dict) -> Column:
    """Decode; an unreadable document or missing field gives the default."""
    parsed = F.from_json(c, ddl)
    fields = T.StructType.fromDDL(ddl)
    return F.struct(*[
        (F.coalesce(parsed[f.name], F.lit(defaults[f.name]).cast(f.dataType))
         if f.name in defaults else parsed[f.name]).alias(f.name) for f in fields])


def json_keys(df: DataFrame, column: str, max_keys: int = 1000) -> list[str]:
    """Names found in a JSON-object column. The answer is a column list, so it is bounded."""
    keys = (df.select(F.explode(F.map_keys(F.from_json(column, "map<string,string>"))).alias("k"))
            .distinct().limit(max_keys + 1).collect())
    if len(keys) > max_keys:
        raise ValueError(f"{column} has more than {max_keys} different keys")
    return sorted(r.k for r in keys)


def json_flatten(df: DataFrame, column: str, keys: list[str] | None = None) -> DataFrame:
    """One string column ``<column>_<key>`` per key; keys are discovered when not given."""
    keys = json_keys(df, column) if keys is None else keys
    parsed = df.withColumn("_map", F.from_json(column, "map<string,string>"))
    return parsed.select(*[c for c in df.columns if c != column],
                         *[F.try_element_at("_map", F.lit(k)).alias(f"{column}_{k}")
                           for k in keys])


def parse_timestamp(c: Column, fmt: str | None = None) -> Column:
    """Timestamp or null; ISO-8601 with offset when no format is given."""
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def time_parts(c: Column) -> dict[str, Column]:
    return {"year": F.year(c), "month": F.month(c), "day": F.day(c),
            "hour": F.hour(c), "minute": F.minute(c), "second": F.second(c)}


def merge_records(df: DataFrame, left: list[str], right: dict[str, Column]) -> DataFrame:
    """Record merge where the right side wins on equal names."""
    kept = [F.col(c) for c in left if c not in right]
    return df.select(*kept, *[col.alias(name) for name, col in right.items()])


def impute(df: DataFrame, columns: list[str], value) -> DataFrame:
    """Fill nulls of the listed columns with ``value``, read in each column's own type."""
    fill = {c: F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType)) for c in columns}
    return df.withColumns(fill)


def is_finite(c: Column) -> Column:
    return ~(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))


def finite_or_null(c: Column) -> Column:
    return F.when(is_finite(c), c)


def finite_or(c: Column, value: float = 0.0) -> Column:
    return F.coalesce(finite_or_null(c), F.lit(value))


def clean_non_finite(df: DataFrame) -> DataFrame:
    """NaN and infinities to null in every floating column."""
    return df.withColumns({f.name: finite_or_null(F.col(f.name)) for f in df.schema
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def to_number(c: Column, default: float | None = 0.0) -> Column:
    """Lenient number; anything unreadable becomes ``default``."""
    n = c.try_cast("double")
    return n if default is None else F.coalesce(finite_or_null(n), F.lit(default))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column,
                 decimals: int = 2) -> Column:
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    h = half_dlat * half_dlat + \
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    km = 2 * EARTH_RADIUS_KM * F.asin(F.least(F.sqrt(h), F.lit(1.0)))
    return F.round(km, decimals)


def baseline_seconds(distance_km: Column, speed_kmh: float = BASE_SPEED_KMH) -> Column:
    seconds = F.floor(distance_km / F.lit(speed_kmh) * 3600).cast("long")
    return F.greatest(seconds, F.lit(MIN_TRAVEL_SECONDS).cast("long"))


def calendar_flags(ts: Column) -> dict[str, Column]:
    hour, day = F.hour(ts), F.weekday(ts)
    return {"day_of_week": day, "hour_of_day": hour,
            "is_morning_rush": hour.between(*MORNING_RUSH),
            "is_evening_rush": hour.between(*EVENING_RUSH),
            "is_weekend": day >= 5}


def url_slug(c: Column) -> Column:
    return F.regexp_replace(F.replace(F.lower(c), F.lit(" & "), F.lit("-")), " ", "-")


def query_url(base: str, c: Column) -> Column:
    return F.concat(F.lit(f"{base}?q="), F.replace(c, F.lit(" "), F.lit("+")))


def query_of_url(url: Column) -> Column:
    return F.replace(F.try_parse_url(url, F.lit("QUERY"), F.lit("q")), F.lit("+"), F.lit(" "))


def make_id(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), n.cast("string"))


def id_number(c: Column, prefix: str) -> Column:
    return F.regexp_extract(c, rf"^{prefix}_(\d+)$", 1).try_cast("long")


def round_metric(c: Column, decimals: int = 4) -> Column:
    return F.round(c, decimals)
