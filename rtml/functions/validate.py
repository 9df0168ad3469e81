"""Record validation: typed required and optional fields, good and rejected rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def validate(df: DataFrame, required: str, optional: str = "") -> DataFrame:
    """Cast fields to the declared types and list the ones that fail.

    ``required`` and ``optional`` are DDL strings. A required field fails when it is null or
    unreadable, an optional field only when it is present but unreadable. Adds ``_failed``.
    """
    need = T.StructType.fromDDL(required)
    may = T.StructType.fromDDL(optional) if optional else T.StructType()
    checks, typed = [], {}
    for field, must in [(f, True) for f in need] + [(f, False) for f in may]:
        raw = F.col(field.name) if field.name in df.columns else F.lit(None)
        value = raw.try_cast(field.dataType)
        bad = value.isNull() if must else raw.isNotNull() & value.isNull()
        checks.append(F.when(bad, F.lit(field.name)))
        typed[field.name] = value
    failed = F.array_compact(F.array(*checks))
    return df.withColumn("_failed", failed).withColumns(typed)


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = checked.where(F.size("_failed") == 0).drop("_failed")
    return good, checked.where(F.size("_failed") > 0)
