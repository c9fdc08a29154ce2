"""Message topics: a broker where its connector is installed, otherwise a folder of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery
from pyspark.sql import types as T

from fraudlens.schemas import TOPIC_RECORD
from fraudlens.session import exists

INTAKE_CAP = 50_000
INTAKE_BYTES = 1 << 30


def read_topic(
    spark: SparkSession,
    fmt: str = "parquet",
    path: str | None = None,
    servers: str | None = None,
    topic: str | None = None,
    starting: str = "earliest",
    cap: int | None = None,
    schema: T.StructType = TOPIC_RECORD,
    checkpoint: str | None = None,
) -> DataFrame:
    """Topic records as a stream.

    ``kafka`` subscribes to ``topic`` from the ``starting`` offsets with at most ``cap`` records
    per trigger.  A file format streams the files of ``path``, at most ``cap`` files per trigger or,
    without ``cap``, about 1 GiB of files.  There ``latest`` means files written after the first
    start of the stream, which is kept beside its ``checkpoint``.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        return (
            reader.option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .option("maxOffsetsPerTrigger", cap or INTAKE_CAP)
            .load()
        )
    records = _capped(reader, cap).schema(schema).load(path)
    if starting != "latest":
        return records
    if checkpoint is None:
        raise ValueError("starting at latest needs the checkpoint the first start is kept beside")
    since = F.timestamp_millis(F.lit(_first_start(spark, checkpoint)))
    return records.filter(F.col("_metadata.file_modification_time") > since)


def read_topic_now(
    spark: SparkSession, fmt: str = "parquet", path: str | None = None, servers: str | None = None
) -> DataFrame:
    """Everything a topic holds at the moment, as a table; ``path`` is its name or folder."""
    if fmt == "kafka":
        return spark.read.format(fmt).option("kafka.bootstrap.servers", servers).option("subscribe", path).load()
    return spark.read.format(fmt).schema(TOPIC_RECORD).load(path)


def _first_start(spark: SparkSession, checkpoint: str) -> int:
    """Milliseconds of the clock when a stream was first started."""
    path = f"{checkpoint.rstrip('/')}-started"
    if not exists(spark, f"{path}/_SUCCESS"):
        now = F.unix_millis(F.current_timestamp()).alias("started")
        spark.range(1).select(now).write.mode("overwrite").parquet(path)
    return spark.read.schema("started bigint").parquet(path).first().started


def _capped(reader: DataStreamReader, files: int | None) -> DataStreamReader:
    """A backlog of any size comes in micro-batches of bounded size."""
    if files:
        return reader.option("maxFilesPerTrigger", files)
    return reader.option("maxBytesPerTrigger", INTAKE_BYTES)


def read_table_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A table as a stream (S3), at most so many files or about 1 GiB of them per trigger."""
    reader = _capped(spark.readStream.format(fmt), files_per_trigger)
    return (reader if fmt == "delta" else reader.schema(schema)).load(path)


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start an append to a table (S2, S4); without ``every`` it drains the source and stops."""
    writer = df.writeStream.format(fmt).outputMode("append")
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)


def publish_stream(
    messages: DataFrame,
    checkpoint: str,
    fmt: str = "parquet",
    path: str | None = None,
    servers: str | None = None,
    topic: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start publishing (key, value) messages to a topic or a folder."""
    if fmt != "kafka":
        return append_stream(messages, path, checkpoint, fmt, every)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def drain(query: StreamingQuery) -> None:
    """Wait for a draining query to finish; a failure is raised here."""
    query.awaitTermination()
