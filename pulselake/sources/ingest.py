"""Loading the bronze layer."""

from __future__ import annotations

from pulselake import schemas
from pulselake.registry import Lake
from pulselake.sources import raw
from pulselake.streaming import jobs


def load_users(lake: Lake, path: str) -> None:
    lake.write(raw.read_csv(lake.spark, path, schemas.RAW_USER), "bronze", "raw_users")


def load_activities(lake: Lake, path: str) -> None:
    lake.write(raw.read_csv(lake.spark, path, schemas.RAW_ACTIVITY), "bronze", "raw_activities")


def load_events(lake: Lake, path: str, checkpoint: str, max_age: str | None = None,
                archive: str | None = None) -> None:
    """Append the events of files not loaded before. The table gets lineage
    and corrupt-record columns beside its declared ones."""
    jobs.incremental_append(lake.spark, path, lake.path("bronze", "heartrate_stream"), checkpoint,
                            with_id=True, max_age=max_age, archive=archive)
