"""The event stream: flatten, land, deduplicate, aggregate, previous value."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pulselake.operators.keys import dedup_events
from pulselake.operators.ordered import with_previous
from pulselake.operators.skew import Hot
from pulselake.plans import refresh, silver
from pulselake.registry import BUCKET, Lake
from pulselake.session import remove_path
from pulselake.sources import raw


def drain(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process what is there, in rate-limited batches, and stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def flatten(events: DataFrame) -> DataFrame:
    """Silver readings from a raw stream: the batch transform, stateless. Records that do
    not fit the schema go to ``to_malformed``."""
    return silver.heart_rate(events.filter(F.col(raw.CORRUPT).isNull()).drop(raw.CORRUPT))


def to_malformed(events: DataFrame, path: str) -> DataStreamWriter:
    """The texts of the records that do not fit the schema, a directory for each batch."""
    def land(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()  # the file source will not read that column alone
        raw.split_corrupt(held)[1].select(raw.CORRUPT).write.mode("overwrite").text(f"{path}/batch={batch_id}")
        held.unpersist()

    return events.writeStream.foreachBatch(land)


def to_parquet(df: DataFrame, path: str) -> DataStreamWriter:
    return df.writeStream.format("parquet").option("path", path).outputMode("append")


def to_lake(events: DataFrame, path: str, malformed_path: str | None = None) -> DataStreamWriter:
    """JSON files by event hour; records that do not fit the schema keep their text, in
    files beside the lake. Each batch has directories of its own, so that one that is run again
    replaces itself."""
    beside = malformed_path or f"{path.rstrip('/')}-malformed"

    def land(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        good, bad = raw.split_corrupt(held)
        raw.write_lake_load(good, path, f"batch-{batch_id}")
        bad.select(raw.CORRUPT).write.mode("overwrite").text(f"{beside}/batch={batch_id}")
        held.unpersist()

    return events.writeStream.foreachBatch(land)


def to_topic(events: DataFrame, servers: str, topic: str) -> DataStreamWriter:
    """Encoded events to a topic; needs the Kafka connector package."""
    return (raw.encode_events(events).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic))


def incremental_append(spark: SparkSession, source: str, table: str, checkpoint: str,
                       with_id: bool = False, max_age: str | None = None, archive: str | None = None) -> StreamingQuery:
    """Append to ``table`` the records of files not seen before, malformed ones
    included, each with its file and that file's modification time. The table is
    partitioned by the day of arrival and the load, like a batch append to it, so both can
    be read together. Running it again without new files adds nothing. ``archive``: where
    loaded files go."""
    rows = raw.with_lineage(raw.stream_jsonl(spark, source, with_id, max_age=max_age, archive=archive))
    tag = hashlib.md5(checkpoint.encode()).hexdigest()[:8]

    def load(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("ingest_day", F.current_date()).withColumn("load", F.lit(f"stream-{tag}-{batch_id}"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("ingest_day", "load").parquet(table))

    return drain(rows.writeStream.foreachBatch(load), checkpoint)


def _label(checkpoint_or_job: str, batch_id: int) -> str:
    return f"stream-{hashlib.md5(checkpoint_or_job.encode()).hexdigest()[:8]}-{batch_id}"


def land_deltas(lake: Lake, batch: DataFrame, load: str) -> None:
    """Put a batch of silver readings beside the cleaned ones, under its event days and users' buckets;
    readings that break a rule go to the rejected table. Run again, a load replaces itself."""
    good, bad = refresh.split_readings(batch)
    lake.write(good.withColumn("load", F.lit(load)), "silver", "heart_rate_delta", only_partitions=True)
    lake.write(dedup_events(bad).withColumn("load", F.lit(load)), "silver", "heart_rate_rejected", only_partitions=True)


def dedup(readings: DataFrame, lake: Lake, job: str = "dedup") -> DataStreamWriter:
    """One row per event in the lake's cleaned readings, however late its copies arrive.

    Each batch writes files of its own, for the days and buckets it has readings of and no others; a reader
    of the cleaned readings merges them by the batch rule (``Lake.read``) until
    ``refresh.compact`` or a refresh has taken them in. No state grows, no
    watermark drops a late reading, and a batch that is run again changes nothing."""
    return readings.writeStream.foreachBatch(lambda batch, n: land_deltas(lake, batch, _label(job, n)))


STATS = ("user_id bigint, activity_id bigint, event_date date, max_heart_rate bigint, min_heart_rate bigint,"
         " avg_heart_rate double")


def daily_stats(readings: DataFrame, lake: Lake, path: str, job: str = "daily-stats") -> DataStreamWriter:
    """Daily statistics per user and activity below ``path``, of open days and for late readings too.

    After each batch the statistics of the (day, bucket of users) pairs that it has readings of are computed
    again and replace what stood there; all others are left alone."""
    def update(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        land_deltas(lake, held, _label(job, batch_id))
        pairs = (held.select(F.to_date("event_timestamp").alias("event_date"), F.expr(BUCKET).alias("bucket"))
                 .filter("event_date IS NOT NULL").distinct())
        days = sorted({r["event_date"] for r in pairs.collect()})  # at most days x buckets of the batch
        if days:
            listed = f"event_day IN ({', '.join(f"date'{d}'" for d in days)})"
            stats = (lake.read_if_any("silver", "heart_rate_cleaned", where=listed)
                     .withColumns({"event_date": F.to_date("event_timestamp"), "bucket": F.expr(BUCKET)})
                     .join(F.broadcast(pairs), ["event_date", "bucket"], "left_semi")
                     .groupBy("bucket", "user_id", "activity_id", "event_date")
                     .agg(F.max("heart_rate").alias("max_heart_rate"), F.min("heart_rate").alias("min_heart_rate"),
                          F.avg("heart_rate").alias("avg_heart_rate")))
            (stats.hint("rebalance", F.col("event_date"), F.col("bucket"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("event_date", "bucket").parquet(path))
        held.unpersist()

    return readings.writeStream.foreachBatch(update)


def read_daily_stats(spark: SparkSession, path: str) -> DataFrame:
    """The statistics of all days, as the batch computation has them."""
    return spark.read.schema(STATS).parquet(path).select(*[c.split()[0] for c in STATS.split(", ")])


@dataclass
class PreviousReading:
    """Streaming previous value, exact for events up to ``delay`` seconds late.

    Each batch holds readings back until the event clock is ``delay`` past them
    and emits the settled ones in order, with the batch operator. That operator
    takes hot users apart, which state keyed by user could not. Between batches
    ``root/state`` keeps the readings held back and each user's last settled reading, in ``buckets``
    of users, and per batch the clock: how far it is and which batch wrote each bucket last. A batch
    reads and writes the buckets it has readings to hold or settle of; users who are silent cost
    nothing. Every directory is named by batch id and
    overwritten, so a batch that is run again after a failure leaves the same
    result. Readings later than ``delay`` go to ``root/late`` and those without a time to
    ``root/untimed``; ``reconciled`` puts all of them into their place, and ``counts`` says how
    many there are.
    """

    spark: SparkSession
    root: str
    delay: int = 3600
    hot: Hot | None = None
    buckets: int = 64

    COLUMNS = ["user_id", "event_timestamp", "event_id", "heart_rate"]
    CLOCK = "line bigint, held map<int, bigint>, last map<int, bigint>"
    PARTS = ("held", "last")

    def _clock(self, batch_id: int) -> Row:
        """(line, held, last): the event clock behind a batch, and the batch that wrote each bucket."""
        if batch_id < 0:
            return Row(line=None, held={}, last={})
        return self.spark.read.schema(self.CLOCK).parquet(f"{self.root}/state/clock/batch={batch_id}").first()

    def _load(self, part: str, written: dict[int, int], like: DataFrame) -> DataFrame:
        paths = [f"{self.root}/state/{part}/batch={n}/bucket={b}" for b, n in sorted(written.items())]
        if not paths:
            return like.limit(0)
        return self.spark.read.schema(like.select(*self.COLUMNS).schema).parquet(*paths).select(
            *self.COLUMNS, self._bucket())

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("user_id"), F.lit(self.buckets)).cast("int").alias("bucket")

    def _save(self, part: str, rows: DataFrame, batch_id: int) -> None:
        (rows.withColumn("batch", F.lit(batch_id)).hint("rebalance", F.col("bucket"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch", "bucket").parquet(f"{self.root}/state/{part}"))

    def _forget(self, batch_id: int, kept: list[Row]) -> None:
        """Remove what only the clock behind ``batch_id`` names: no restart can ask for it any more."""
        if batch_id < 0:
            return
        old = self._clock(batch_id)
        for part in self.PARTS:
            named = {(n, b) for clock in kept for b, n in clock[part].items()}
            still = {n for n, _ in named}
            for b, n in old[part].items():
                if n not in still:
                    remove_path(self.spark, f"{self.root}/state/{part}/batch={n}")
                elif (n, b) not in named:
                    remove_path(self.spark, f"{self.root}/state/{part}/batch={n}/bucket={b}")
        remove_path(self.spark, f"{self.root}/state/clock/batch={batch_id}")

    @staticmethod
    def _buckets_of(rows: DataFrame) -> list[int]:
        return [r["bucket"] for r in rows.select("bucket").distinct().collect()]

    def process(self, batch: DataFrame, batch_id: int, final: bool = False) -> None:
        """The ``foreachBatch`` function; ``final`` settles everything."""
        everything = batch.select(*self.COLUMNS, self._bucket()).persist()
        second = F.unix_seconds("event_timestamp")
        (everything.filter("event_timestamp IS NULL").drop("bucket").write.mode("overwrite")
         .parquet(f"{self.root}/untimed/batch={batch_id}"))
        rows = everything.filter("event_timestamp IS NOT NULL")
        clock = self._clock(batch_id - 1)
        was = clock["line"]
        newest = rows.agg(F.max(second).alias("s")).first()["s"]
        lines = [x for x in (was, None if newest is None else newest - self.delay) if x is not None]
        line = max(lines, default=None)

        fresh, late = rows, rows.limit(0)
        if was is not None:
            fresh, late = rows.filter(second >= was), rows.filter(second < was)
        late.drop("bucket").write.mode("overwrite").parquet(f"{self.root}/late/batch={batch_id}")

        held = self._load("held", clock["held"], rows).unionByName(fresh).persist()
        settled = held if final else held.filter(second < F.lit(line))
        moved = self._buckets_of(settled)
        last = self._load("last", {b: n for b, n in clock["last"].items() if b in moved}, rows)
        seeded = last.withColumn("_seed", F.lit(True)).unionByName(
            settled.withColumn("_seed", F.lit(False)))
        emitted = with_previous(seeded, "user_id", "event_timestamp", "event_id", "heart_rate",
                                "previous_heart_rate", self.hot)
        (emitted.filter(~F.col("_seed")).drop("_seed", "bucket")
         .write.mode("overwrite").parquet(f"{self.root}/out/batch={batch_id}"))
        if not final:
            waiting = held.filter(second >= F.lit(line))
            kept, touched = self._buckets_of(waiting), {*moved, *self._buckets_of(fresh)}
            if touched.intersection(kept):
                self._save("held", waiting.filter(F.col("bucket").isin([*touched])), batch_id)
            if moved:
                newest_row = F.max(F.struct("event_timestamp", "event_id", "heart_rate")).alias("r")
                self._save("last", seeded.groupBy("user_id", "bucket").agg(newest_row).select("user_id", "r.*", "bucket"), batch_id)
            # The clock is written last: a batch without it did not complete.
            now = Row(line=line, held={b: batch_id if b in touched else clock["held"][b] for b in kept},
                      last={**clock["last"], **{b: batch_id for b in moved}})
            (self.spark.createDataFrame([now], self.CLOCK).coalesce(1)
             .write.mode("overwrite").parquet(f"{self.root}/state/clock/batch={batch_id}"))
            if batch_id >= 3:
                self._forget(batch_id - 3, [self._clock(batch_id - 2), self._clock(batch_id - 1), now])
        held.unpersist()
        everything.unpersist()

    def writer(self, readings: DataFrame) -> DataStreamWriter:
        return readings.select(*self.COLUMNS).writeStream.foreachBatch(self.process)

    def finish(self, last_batch_id: int) -> None:
        """Settle what is held back, for a stream that has ended."""
        empty = self.spark.createDataFrame(
            [], "user_id bigint, event_timestamp timestamp, event_id bigint, heart_rate bigint")
        self.process(empty, last_batch_id + 1, final=True)

    def result(self) -> DataFrame:
        """The settled readings, as they were emitted."""
        return self.spark.read.parquet(f"{self.root}/out").drop("batch")

    def _side(self, part: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{part}").select(*self.COLUMNS)

    def counts(self) -> DataFrame:
        """(part, readings): emitted, late and without a time; together all that came in."""
        parts = [self._side(part).agg(F.count(F.lit(1)).alias("readings")).select(F.lit(part).alias("part"), "readings")
                 for part in ("out", "late", "untimed")]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    def reconciled(self) -> DataFrame:
        """All readings with their previous value, the late and untimed ones in their place:
        the batch computation over what the stream took in."""
        rows = self._side("out").unionByName(self._side("late")).unionByName(self._side("untimed"))
        return with_previous(rows, "user_id", "event_timestamp", "event_id", "heart_rate", "previous_heart_rate", self.hot)


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left_rows, right_rows, differing): a multiset comparison in one shuffle,
    with copies of a row combined map-side."""
    columns = left.columns
    signed = (left.withColumn("_l", F.lit(1)).withColumn("_r", F.lit(0))
              .unionByName(right.select(*columns).withColumn("_l", F.lit(0)).withColumn("_r", F.lit(1))))
    per_row = signed.groupBy(*columns).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    return per_row.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_r"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.abs(F.col("_l") - F.col("_r"))), F.lit(0)).alias("differing"))
