"""Event streams into append-only tables, and reads of those tables.

A topic is a Kafka topic on a cluster; the same functions read a folder of JSON lines where the
Kafka connector is not installed. Delta and Parquet differ only in the ``fmt`` argument.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from rtml import schemas as S


@dataclass
class Topic:
    """One ingest job: where the events come from, their schema, where they go."""

    name: str
    schema: str
    path: str
    checkpoint: str
    servers: str | None = None
    folder: str | None = None
    options: dict = field(default_factory=dict)


def topic_table(root: str, servers: str | None = None, folder: str | None = None) -> list[Topic]:
    """The declared topics with a table path and a checkpoint each."""
    return [Topic(name, ddl, f"{root}/{name}", f"{root}/_checkpoints/{name}", servers,
                  f"{folder}/{name}" if folder else None) for name, ddl in S.TABLES.items()]


def _kafka_options(topic: str, servers: str, offsets: str | None) -> dict:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": offsets or "earliest", "failOnDataLoss": "false"}


def event_stream(spark: SparkSession, topic: Topic, offsets: str | None = None) -> DataFrame:
    """Raw stream with a text column ``value``."""
    if topic.servers:
        raw = spark.readStream.format("kafka").options(
            **_kafka_options(topic.name, topic.servers, offsets), **topic.options).load()
        return raw.withColumn("value", F.col("value").cast("string"))
    return spark.readStream.options(**topic.options).text(topic.folder)


def decode(raw: DataFrame, schema: str) -> DataFrame:
    """JSON text to typed columns; nested objects land as JSON text where declared string.

    A bad field becomes null, an unreadable document becomes nulls and keeps its text in
    ``_corrupt``.
    """
    fields = T.StructType.fromDDL(schema).add("_corrupt", T.StringType())
    parsed = F.from_json("value", fields, {"mode": "PERMISSIVE",
                                           "columnNameOfCorruptRecord": "_corrupt"})
    return raw.withColumn("_data", parsed).select("_data.*")


def split_corrupt(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the texts to quarantine."""
    return decoded.where(F.col("_corrupt").isNull()).drop("_corrupt"), \
        decoded.where(F.col("_corrupt").isNotNull()).select("_corrupt")


def tag_records(decoded: DataFrame) -> DataFrame:
    """Every row with ``record``, ``ok`` or ``unreadable``, so that one append keeps both kinds."""
    return decoded.withColumn("record", F.when(F.col("_corrupt").isNull(), "ok")
                              .otherwise("unreadable"))


def append_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                once: bool = False, interval: str = "10 seconds",
                name: str | None = None, partition_by: list[str] | None = None) -> StreamingQuery:
    """Exactly-once append; with Delta, new columns are merged into the table.

    ``partition_by`` (such as an event date) lets later reads skip whole folders.
    """
    writer = df.writeStream.format(fmt).outputMode("append") \
        .option("checkpointLocation", checkpoint).option("path", path)
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()


def start_ingest(spark: SparkSession, topics: list[Topic], fmt: str = "parquet",
                 once: bool = False, quarantine: bool = True) -> list[StreamingQuery]:
    """One query with its own checkpoint per topic, all in this session.

    Unreadable records land in the same exactly-once append as the others, in a folder of their own
    (``record=unreadable``), so a topic is read once: :func:`read_table` leaves them out and
    :func:`read_quarantine` returns them. Without ``quarantine`` they are dropped.
    """
    started = []
    for t in topics:
        rows = decode(event_stream(spark, t), t.schema)
        if quarantine:
            started.append(append_sink(tag_records(rows), t.path, t.checkpoint, fmt, once,
                                       partition_by=["record"]))
        else:
            started.append(append_sink(split_corrupt(rows)[0], t.path, t.checkpoint, fmt, once))
    return started


def run_until(queries: list[StreamingQuery], stop, poll_seconds: float = 5.0) -> None:
    """Keep the queries running until ``stop()`` is true or one ends, then stop all cleanly."""
    try:
        while not stop() and all(q.isActive for q in queries):
            for q in queries:
                q.awaitTermination(poll_seconds)
                if stop():
                    break
    finally:
        for q in queries:
            q.stop()
    for q in queries:
        if q.exception():
            raise q.exception()


def _landed(spark: SparkSession, path: str, fmt: str, merge_schema: bool) -> DataFrame:
    reader = spark.read.format(fmt)
    if merge_schema and fmt == "parquet":
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def _is_tagged(df: DataFrame) -> bool:
    return {"record", "_corrupt"} <= set(df.columns)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               merge_schema: bool = False) -> DataFrame:
    """Lake table without its quarantined records; of a table that keeps them, only the folder of
    readable ones is scanned. ``merge_schema`` reads Parquet files written with different columns."""
    df = _landed(spark, path, fmt, merge_schema)
    return df.where("record = 'ok'").drop("record", "_corrupt") if _is_tagged(df) else df


def read_quarantine(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Texts of the records of a lake table that could not be read, one column ``_corrupt``."""
    df = _landed(spark, path, fmt, False)
    if not _is_tagged(df):
        return spark.createDataFrame([], "_corrupt string")
    return df.where("record <> 'ok'").select("_corrupt")


def table_or_topic(spark: SparkSession, topic: Topic, fmt: str = "parquet") -> DataFrame:
    """The lake table, or, where it does not exist yet, the first event of the topic."""
    try:
        return read_table(spark, topic.path, fmt)
    except AnalysisException as e:
        kind = e.getCondition() or ""
        if kind not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA") and not kind.startswith("DELTA_"):
            raise
    if topic.servers:
        raw = spark.read.format("kafka").options(
            **_kafka_options(topic.name, topic.servers, None)).load() \
            .orderBy("partition", "offset").select(F.col("value").cast("string").alias("value"))
    else:
        raw = spark.read.text(topic.folder)
    return decode(raw.limit(1), topic.schema).drop("_corrupt")


def starting_offsets(topic: str, offsets: DataFrame) -> str:
    """Kafka ``startingOffsets`` for all partitions from ``(partition, next_offset)`` rows."""
    rows = offsets.select("partition", "next_offset").collect()  # one row per topic partition
    return json.dumps({topic: {str(r.partition): int(r.next_offset) for r in rows}})


def after_offset(df: DataFrame, offset: str, last: int) -> DataFrame:
    """Batch replay from the record after the last processed one."""
    return df.where(F.col(offset) > F.lit(last))


def schema_report(df: DataFrame) -> DataFrame:
    """Name, type and nullability of every column."""
    return df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)],
        "position int, column string, type string, nullable boolean")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def health_report(df: DataFrame) -> DataFrame:
    """Rows, files and columns of a table in one pass over file metadata and row counts."""
    files = df.select(F.col("_metadata.file_path").alias("f")).groupBy("f") \
        .agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows")) \
        .withColumn("columns", F.lit(len(df.columns)).cast("long"))


def table_report(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Schema of a lake table, one row per column, with its path and number of rows."""
    df = read_table(spark, path, fmt)
    return schema_report(df).withColumn("path", F.lit(path)) \
        .crossJoin(F.broadcast(row_count(df)))  # one row of counts


def table_version(spark: SparkSession, path: str, fmt: str = "parquet") -> int | None:
    """Latest version of a Delta table; other formats have none."""
    return delta_history(spark, path).agg(F.max("version")).first()[0] if fmt == "delta" else None


def full_health_report(df: DataFrame, order: list[str], version: int | None = None,
                       sample: int = 3) -> DataFrame:
    """One row: version, files, rows, columns, ``name: type`` of each column and the first rows.

    The first rows by ``order`` are a top-n and come as JSON texts; an empty table has none. Rows are
    counted from file footers, no column is read for it.
    """
    types = [f"{f.name}: {f.dataType.simpleString()}" for f in df.schema]
    top = df.orderBy(*order).limit(sample).select(
        F.struct(*order).alias("_o"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        .alias("_j")).agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_j"))),
                                      lambda x: x["_j"]).alias("first_rows"))  # ``sample`` rows
    return health_report(df).select(
        F.lit(version).cast("long").alias("version"), "files",
        F.coalesce("rows", F.lit(0)).alias("rows"), "columns",
        F.lit(types).alias("column_types")).crossJoin(F.broadcast(top))


def delta_history(spark: SparkSession, path: str) -> DataFrame:
    """Versions of a Delta table (needs the Delta package on the cluster)."""
    return spark.sql(f"DESCRIBE HISTORY delta.`{path}`")
