"""The layered tables: where they live, what they hold, how they are written."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulselake import schemas
from pulselake.operators.keys import dedup_events
from pulselake.versions import PLAIN, Entry, Manifest


@dataclass(frozen=True)
class Table:
    layer: str
    key: str
    name: str
    schema: T.StructType
    # Storage partition: column name -> SQL expression over the table's columns.
    # A partition column outside ``schema`` is dropped again on read.
    partition: dict[str, str] = field(default_factory=dict)
    # Rows that hold a text here did not fit the schema; a plain read leaves them out.
    corrupt: str | None = None
    # Stored columns beyond the documented ones; a read names those it wants.
    extra: T.StructType = field(default_factory=T.StructType)
    # A table of the same layer whose rows belong to this one's partitions too; copies count once.
    delta: str | None = None


# The share of users that stream deltas and their statistics are filed under.
BUCKET = "CAST(pmod(xxhash64(user_id), 8) AS INT)"
_KINDS = {"load": "string", "bucket": "integer"}  # of partition columns; the others are days

_ALL = [
    Table("bronze", "raw_users", "raw_user", schemas.RAW_USER),
    Table("bronze", "raw_activities", "raw_activity", schemas.RAW_ACTIVITY),
    # By arrival, so that an incremental refresh need not open older files.
    Table("bronze", "heartrate_stream", "heartrate_stream", schemas.RAW_HEART_RATE_WITH_ID,
          {"ingest_day": "current_date()", "load": "'{load}'"}, corrupt="_corrupt_record"),
    Table("silver", "dim_users", "dim_users", schemas.DIM_USERS),
    Table("silver", "dim_activities", "dim_activities", schemas.DIM_ACTIVITIES),
    # Every version of the two with its key, and the snapshots that showed it.
    Table("silver", "dim_users_history", "dim_users_history", schemas.USERS_HISTORY, extra=schemas.SEEN),
    Table("silver", "dim_activities_history", "dim_activities_history", schemas.ACTIVITIES_HISTORY, extra=schemas.SEEN),
    # Records of the two that break a rule, with the rules' names, of the last load.
    Table("silver", "dim_users_rejected", "dim_users_rejected", schemas.USERS_REJECTED),
    Table("silver", "dim_activities_rejected", "dim_activities_rejected", schemas.ACTIVITIES_REJECTED),
    Table("silver", "heart_rate_cleaned", "heart_rate_cleaned", schemas.HEART_RATE_CLEANED,
          {"event_day": "to_date(event_timestamp)"}, delta="heart_rate_delta"),
    # What streams have brought and no refresh or compaction has taken in yet.
    Table("silver", "heart_rate_delta", "heart_rate_delta", schemas.HEART_RATE_CLEANED,
          {"event_day": "to_date(event_timestamp)", "bucket": BUCKET, "load": "'{load}'"}),
    # Each user's last reading of each day: what an incremental refresh needs to
    # know of the days before it.
    Table("silver", "last_readings", "last_readings", schemas.LAST_READINGS,
          {"event_day": "to_date(event_timestamp)"}),
    # Readings that break a rule, with the rules' names, by load: one that is run again replaces its own.
    Table("silver", "heart_rate_rejected", "heart_rate_rejected", schemas.HEART_RATE_REJECTED,
          {"load": "'{load}'"}),
    Table("silver", "dim_date", "dim_date", schemas.DIM_DATE, extra=schemas.MONTH_END),
    Table("silver", "dim_time", "dim_time", schemas.DIM_TIME),
    Table("gold", "fct_heart_rate", "fct_heart_rate", schemas.FCT_HEART_RATE,
          {"event_date": "event_date"}, extra=schemas.VERSION_KEYS),
    Table("gold", "dim_users", "dim_users", schemas.DIM_USERS),
    Table("gold", "dim_activities", "dim_activities", schemas.DIM_ACTIVITIES),
    Table("gold", "dim_users_history", "dim_users_history", schemas.USERS_HISTORY),
    Table("gold", "dim_activities_history", "dim_activities_history", schemas.ACTIVITIES_HISTORY),
    Table("gold", "dim_date", "dim_date", schemas.DIM_DATE, extra=schemas.MONTH_END),
    Table("gold", "dim_time", "dim_time", schemas.DIM_TIME),
]
TABLES = {(t.layer, t.key): t for t in _ALL}


class UnknownTable(KeyError):
    """No table is registered under that layer and key."""


class Lake:
    """Reads and writes the registered tables below one root.

    ``fmt`` and ``options`` go to the Spark reader and writer as they are, so a
    warehouse connector is a matter of configuration.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet",
                 options: dict[str, str] | None = None):
        zone = spark.conf.get("spark.sql.session.timeZone")
        if zone not in ("UTC", "Etc/UTC", "GMT", "Z"):
            raise ValueError(f"event days are UTC days, but spark.sql.session.timeZone is {zone}")
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self.options = dict(options or {})

    @staticmethod
    def table(layer: str, key: str) -> Table:
        try:
            return TABLES[(layer, key)]
        except KeyError:
            raise UnknownTable(f"{layer}.{key}; known: {sorted(TABLES)}") from None

    def path(self, layer: str, key: str) -> str:
        t = self.table(layer, key)
        return f"{self.root}/{t.layer}/{t.name}"

    def _manifest(self) -> Manifest:
        return Manifest(self.spark, self.root)

    def _entry(self, t: Table) -> Entry | None:
        """The published partitions of a table, None if it was never written in a transaction."""
        return self._manifest().current()[1].get(f"{t.layer}.{t.name}")

    def _load(self, t: Table, full: T.StructType) -> DataFrame:
        reader = self.spark.read.format(self.fmt).options(**self.options).schema(full)
        entry = self._entry(t)
        if entry is None:
            return reader.load(self.path(t.layer, t.key))
        own, base = self.path(t.layer, t.key), self._manifest().base(f"{t.layer}.{t.name}")
        parts = {PLAIN: (own, [f"{own}/{leaf}" for leaf, runs in entry.items() if PLAIN in runs]),
                 "run": (base, [f"{base}/run={run}/{leaf}" for leaf, runs in entry.items() for run in runs if run != PLAIN])}
        frames = [reader.option("basePath", at).load(paths).select(*full.names) for at, paths in parts.values() if paths]
        if not frames:
            return self.spark.createDataFrame([], full)
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def read(self, layer: str, key: str, where: str | None = None, extra: Sequence[str] = ()) -> DataFrame:
        """The table's declared columns and the stored ones named in ``extra``. ``where`` may
        name the storage partition column too, and then prunes directories.

        Rows of the table's deltas are merged in: only partitions that have some are shuffled for it."""
        t = self.table(layer, key)
        days = self.delta_days(key) if t.delta else []
        if not days:
            return self._stored(t, where, extra)
        (column,) = t.partition
        stored = self._stored(t, where, (*extra, column), missing_ok=True)
        with_deltas = F.coalesce(F.col(column).isin(days), F.lit(False))
        fresh = self._stored(self.table(layer, t.delta), where, extra)
        merged = dedup_events(stored.filter(with_deltas).drop(column).unionByName(fresh))
        return stored.filter(~with_deltas).drop(column).unionByName(merged)

    def delta_leaves(self, key: str) -> list[str]:
        """The directories of a table's deltas, one for each day, bucket and load."""
        delta = self.table("silver", self.table("silver", key).delta)
        return self._manifest().leaves(self.path("silver", delta.key), len(delta.partition))

    def delta_days(self, key: str) -> list[datetime.date]:
        delta = self.path("silver", self.table("silver", key).delta)
        return [datetime.date.fromisoformat(leaf.split("=")[1]) for leaf in self._manifest().leaves(delta, 1)]

    def drop_deltas(self, key: str, leaves: Sequence[str]) -> None:
        """Remove deltas that the table itself holds by now; those that came since stay."""
        path, files = self.path("silver", self.table("silver", key).delta), self._manifest().files
        for leaf in leaves:
            files.remove(f"{path}/{leaf}")
            at = leaf
            while "/" in at:  # directories that are empty now
                at = at.rsplit("/", 1)[0]
                if not [n for n in files.names(f"{path}/{at}") if not n.startswith((".", "_"))]:
                    files.remove(f"{path}/{at}")

    def _stored(self, t: Table, where: str | None, extra: Sequence[str], missing_ok: bool = False) -> DataFrame:
        full = T.StructType([*t.schema.fields, *t.extra.fields])
        for name in t.partition:
            if name not in t.schema.names:
                full = full.add(name, _KINDS.get(name, "date"))
        if t.corrupt:
            full = full.add(t.corrupt, "string")
        if missing_ok and not self.has(t.layer, t.key):
            df = self.spark.createDataFrame([], full)
        else:
            df = self._load(t, full)
        if t.corrupt:
            df = df.filter(F.col(t.corrupt).isNull())
        if where:
            df = df.filter(where)
        return df.select(*t.schema.names, *extra)

    def rejected(self, layer: str, key: str) -> DataFrame:
        """The texts of the records that did not fit the table's schema."""
        t = self.table(layer, key)
        df = self.spark.read.format(self.fmt).options(**self.options).schema(f"{t.corrupt} string, ingest_day date").load(
            self.path(layer, key))
        return df.filter(F.col(t.corrupt).isNotNull())

    def has(self, layer: str, key: str) -> bool:
        """Whether the table has been written."""
        t = self.table(layer, key)
        return self._entry(t) is not None or self._manifest().files.exists(self.path(layer, key))

    def read_if_any(self, layer: str, key: str, where: str | None = None, extra: Sequence[str] = ()) -> DataFrame:
        """``read``, or no rows if the table has not been written yet."""
        try:
            return self.read(layer, key, where, extra)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            t = self.table(layer, key)
            more = [f for f in t.extra.fields if f.name in extra]
            return self.spark.createDataFrame([], T.StructType([*t.schema.fields, *more]))

    @contextmanager
    def transaction(self) -> Iterator[Lake]:
        """A lake in which to write tables that nobody else sees yet. They are published together when
        the block ends, and removed if it fails; a transaction within one is part of it."""
        draft = _Draft(self)
        try:
            yield draft
        except BaseException:
            draft.discard()
            raise
        draft.publish()

    def write(self, df: DataFrame, layer: str, key: str, mode: str = "overwrite",
              only_partitions: bool = False, laid_out: bool = False) -> None:
        """Write a frame that matches the table's contract; the stored columns beyond it may be left out.

        ``only_partitions`` replaces just the partitions present in ``df``;
        ``laid_out`` says that its rows are gathered by partition already. Below a root with
        published tables each write is a transaction.
        """
        if self._entry(self.table(layer, key)) is not None:
            with self.transaction() as draft:
                draft.write(df, layer, key, mode, only_partitions, laid_out)
            return
        t = self.table(layer, key)
        self._save(df, t, self.path(layer, key), mode, only_partitions, laid_out)

    def _save(self, df: DataFrame, t: Table, path: str, mode: str, only_partitions: bool, laid_out: bool) -> None:
        given = [name for name in t.partition if name in df.columns and name not in t.schema.names]
        for f in t.extra.fields:
            if f.name not in df.columns:
                df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
        kept = {name: F.col(name) for name in given}
        whole = T.StructType([*t.schema.fields, *t.extra.fields])
        checked = schemas.check_contract(df.drop(*given), whole, f"{t.layer}.{t.key}")
        df = df.select(*checked.columns, *given) if given else checked
        overwrite = "dynamic" if only_partitions else "static"
        for name, expression in t.partition.items():
            if name not in kept:
                df = df.withColumn(name, F.expr(expression.replace("{load}", f"batch-{uuid.uuid4().hex[:12]}")))
        if t.partition and not laid_out:
            # Rebalance gives each partition value to few tasks, yet splits a
            # large one at the advisory size: no small-file burst, no hot task.
            df = df.hint("rebalance", *[F.col(name) for name in t.partition])
        writer = df.write.format(self.fmt).options(**self.options).mode(mode)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", overwrite)
        if t.partition:
            writer = writer.partitionBy(*t.partition)
        writer.save(path)


class _Draft(Lake):
    """A lake whose writes go to runs of their own; see ``Lake.transaction``."""

    def __init__(self, lake: Lake):
        super().__init__(lake.spark, lake.root, lake.fmt, lake.options)
        self.number, self.published = self._manifest().current()
        self.pending: dict[str, Entry] = {}
        self.runs: list[str] = []

    @contextmanager
    def transaction(self) -> Iterator[Lake]:
        yield self

    def _entry(self, t: Table) -> Entry | None:
        name = f"{t.layer}.{t.name}"
        return self.pending.get(name, self.published.get(name))

    def write(self, df: DataFrame, layer: str, key: str, mode: str = "overwrite",
              only_partitions: bool = False, laid_out: bool = False) -> None:
        t = self.table(layer, key)
        name, run, manifest = f"{t.layer}.{t.name}", uuid.uuid4().hex[:16], self._manifest()
        path = f"{manifest.base(name)}/run={run}"
        self.runs.append(path)
        self._save(df, t, path, "overwrite", False, laid_out)
        new = {leaf: [run] for leaf in manifest.leaves(path, len(t.partition))}
        was = self._entry(t)
        if was is None and (only_partitions or mode == "append"):
            own = self.path(layer, key)
            was = {leaf: [PLAIN] for leaf in manifest.leaves(own, len(t.partition))} if manifest.files.exists(own) else {}
        if mode == "append":
            new = {leaf: [*(was or {}).get(leaf, []), *new.get(leaf, [])] for leaf in {**(was or {}), **new}}
        elif only_partitions:
            new = {**(was or {}), **new}
        self.pending[name] = new

    def publish(self) -> None:
        if self.pending:
            try:
                self._manifest().publish(self.number, self.pending)
            except BaseException:
                self.discard()
                raise

    def discard(self) -> None:
        files = self._manifest().files
        for path in self.runs:
            files.remove(path)
