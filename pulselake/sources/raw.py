"""Raw-layer readers and the event encoding, for files and topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from pulselake import schemas
from pulselake.functions.clean import epoch_to_timestamp

CORRUPT = "_corrupt_record"
NO_AGE = "36500d"  # Spark's own default would leave out files a week older than the newest


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A header CSV dimension. The schema is given: inference would cost a
    second scan and could change between loads."""
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("quote", '"').option("escape", '"').csv(path))


def _event_schema(with_id: bool, corrupt: bool) -> T.StructType:
    base = schemas.RAW_HEART_RATE_WITH_ID if with_id else schemas.RAW_HEART_RATE
    fields = list(base.fields)
    return T.StructType(fields + ([T.StructField(CORRUPT, T.StringType())] if corrupt else []))


def read_jsonl(spark: SparkSession, path: str, with_id: bool = False,
               modified_after: str | None = None) -> DataFrame:
    """All JSON Lines below ``path`` at any depth, plain ``YYYY/MM/DD/HH`` or
    ``year=/month=`` directories alike. ``meta`` stays JSON text. Lines that do
    not fit the schema are kept, with their text in ``_corrupt_record``."""
    reader = (spark.read.schema(_event_schema(with_id, True))
              .option("recursiveFileLookup", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT))
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.json(path)


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the source file and its modification time, the sync cursor."""
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"),
                     F.col("_metadata.file_modification_time").alias("_source_modified"))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that fit the schema, records that do not)."""
    return (df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT),
            df.filter(F.col(CORRUPT).isNotNull()))


def stream_jsonl(spark: SparkSession, path: str, with_id: bool = False,
                 max_files: int = 1000, max_age: str | None = None, archive: str | None = None) -> DataFrame:
    """New files below ``path``, ``max_files`` at a time, whatever their age.

    ``max_age`` is a look-back for those who ask for one: once there is history, a file
    older than the newest one by more than that is left alone. The first batch takes all.
    ``archive`` is a directory that files go to once a batch behind theirs has begun; else the
    source's list of files it has seen grows for ever, as does the listing of its directory.
    """
    reader = spark.readStream
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return (reader.schema(_event_schema(with_id, True))
            .option("recursiveFileLookup", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("maxFilesPerTrigger", max_files).option("maxFileAge", max_age or NO_AGE)
            .json(path))


# Topic ------------------------------------------------------------------------

def topic_reader(spark: SparkSession, servers: str, topic: str, max_offsets: int = 10_000_000,
                 **options: str) -> DataStreamReader:
    """A Kafka source; the connector package must be on the session's classpath.
    ``max_offsets`` bounds a micro-batch."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .option("maxOffsetsPerTrigger", max_offsets).options(**options))


def decode_events(messages: DataFrame, with_id: bool = False, lineage: bool = False) -> DataFrame:
    """Raw events from messages with a ``value`` of JSON text or bytes.

    Works on a batch or a stream and for any source of such messages. ``lineage`` keeps where a
    message was read: ``_topic``, ``_partition``, ``_offset`` and ``_message_time``.
    """
    schema = _event_schema(with_id, True)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    record = F.from_json(F.col("value").cast("string"), schema, options).alias("r")
    place = [F.col("topic").alias("_topic"), F.col("partition").alias("_partition"), F.col("offset").alias("_offset"),
             F.col("timestamp").alias("_message_time")] if lineage else []
    return messages.select(record, *place).select("r.*", *[f"_{c}" for c in ("topic", "partition", "offset", "message_time")
                                                          if lineage])


def encode_events(events: DataFrame) -> DataFrame:
    """(key, value) messages: the user id as text and the event as JSON, with
    ``meta`` nested rather than quoted."""
    body = [c for c in ["event_id", "user_id", "heart_rate", "timestamp"] if c in events.columns]
    meta = F.from_json("meta", schemas.META).alias("meta")
    return events.select(F.col("user_id").cast("string").alias("key"),
                         F.to_json(F.struct(*body, meta)).alias("value"))


def with_event_hour(events: DataFrame) -> DataFrame:
    """Add the lake's directory columns from the event time."""
    at = epoch_to_timestamp(F.col("timestamp"))
    return (events.withColumn("year", F.date_format(at, "yyyy"))
            .withColumn("month", F.date_format(at, "MM"))
            .withColumn("day", F.date_format(at, "dd"))
            .withColumn("hour", F.date_format(at, "HH")))


LAKE_PARTITIONS = ["year", "month", "day", "hour"]


def write_lake(events: DataFrame, path: str, mode: str = "append") -> None:
    """JSON files by event hour. The rebalance gathers an hour in few files yet
    splits an hour that is too big for one."""
    out = with_event_hour(events).hint("rebalance", *[F.col(c) for c in LAKE_PARTITIONS])
    out.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(*LAKE_PARTITIONS).json(path)


def write_lake_load(events: DataFrame, path: str, load: str) -> None:
    """The same with a directory for each load below the hour: written again, a load replaces itself."""
    parts = [*LAKE_PARTITIONS, "load"]
    out = with_event_hour(events).withColumn("load", F.lit(load)).hint("rebalance", *[F.col(c) for c in LAKE_PARTITIONS])
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).json(path)
