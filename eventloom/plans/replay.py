"""Replay: transform a window of raw logs again and replace the window in the tables."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventloom.operators.classify import collate
from eventloom.operators.decode import decode_edge_log
from eventloom.operators.schemas import TableSchema
from eventloom.plans.pipeline import Lookups
from eventloom.sinks.tables import load_tsv, table_folder, write_tables
from eventloom.sinks.versioned import VersionedTable
from eventloom.sources.edge_logs import read_edge_log, window_bounds
from eventloom.sources.files import path_exists

log = logging.getLogger(__name__)


def in_window(time: Column, start: datetime, end: datetime) -> Column:
    """Both ends inclusive; rows without a time are outside."""
    wall = lambda t: F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return F.coalesce(time.cast("timestamp_ntz").between(wall(start), wall(end)), F.lit(False))


def replace_window(
    target: DataFrame, replayed: DataFrame | None, start: datetime, end: datetime,
    time: str = "time", on_missing: str = "keep",
) -> DataFrame:
    """(target outside the window) and (replayed rows inside it).

    Without replayed data (None) the target stays as it is, or with ``on_missing='empty'``
    loses its window.  A union of two filters: nothing is shuffled.
    """
    if on_missing not in ("keep", "empty"):
        raise ValueError("on_missing is 'keep' or 'empty'")
    if replayed is None:
        return target if on_missing == "keep" else target.where(~in_window(F.col(time), start, end))
    kept = target.where(~in_window(F.col(time), start, end))
    return kept.unionByName(replayed.where(in_window(F.col(time), start, end)).select(*target.columns))


@dataclass
class Replaced:
    table: str
    deleted: int = 0
    inserted: int = 0
    error: str | None = None


def replace_window_table(
    spark: SparkSession, target: str | VersionedTable, replayed: DataFrame | None, start: datetime, end: datetime,
    *, run_tag: str, table: str = "", time: str = "time", day: str = "day", on_missing: str = "keep",
) -> Replaced:
    """Replace the window in a table with a folder per ``day`` (date of ``time``), as one transaction.

    Only the days the window touches are read and written, in one job; a plain table of ``day=…`` folders
    becomes versioned with its first replacement. Whatever breaks off before the commit leaves the table
    as it was. Read the table with ``VersionedTable.read``.
    """
    if replayed is None and on_missing == "keep":
        return Replaced(table)
    if not isinstance(target, VersionedTable):
        target = VersionedTable(target, time, day)
    inside = in_window(F.col(target.time), start, end)
    return Replaced(table, *target.replace(spark, inside, start, end, replayed, run_tag))


def new_run_tag(now: datetime | None = None, namespace: str | None = None) -> str:
    stamp = (now or datetime.now()).strftime("%Y%m%dT%H%M%S")
    return f"{namespace}-{stamp}" if namespace else stamp


def replay(
    spark: SparkSession,
    start: datetime,
    end: datetime,
    tables: list[str] | None,
    *,
    schemas: dict[str, TableSchema],
    log_path: str,
    output_path: str,
    target_path: str | None = None,
    lookups: Lookups = Lookups(),
    run_tag: str | None = None,
    namespace: str | None = None,
    skip_transform: bool = False,
    skip_load: bool = False,
    on_missing: str = "keep",
    pool_size: int = 4,
) -> list[Replaced]:
    """Transform the logs of ``[start, end]`` and replace that window in each table.

    ``tables=None`` means all tables, without the encoded-text prefilter.  Tables are
    independent: one that fails is reported and the others go on.
    """
    if skip_transform and skip_load:
        raise ValueError("nothing to do: transform and load are both skipped")
    if skip_transform and not run_tag:
        raise ValueError("skipping the transform needs the run tag of an earlier one")
    if not skip_load and not target_path:
        raise ValueError("loading needs a target path")
    aware_start, aware_end = window_bounds(start, end)
    run_tag = run_tag or new_run_tag(namespace=namespace)

    if not skip_transform:
        lines = read_edge_log(spark, log_path, start=aware_start, end=aware_end, events=tables)
        events, wanted = decode_edge_log(lines, "drop"), schemas
        if tables is not None:  # before the casts, and only the plans of these tables
            events = events.where(F.col("event").isin(list(tables)))
            wanted = {name: schemas[name] for name in tables if name in schemas}
        rows = collate(events, wanted, **lookups.as_options())
        write_tables(rows, output_path, run_tag=run_tag, mode="overwrite")
    if skip_load:
        return []

    wall = lambda t: t.replace(tzinfo=None)

    def load(name: str) -> Replaced:
        try:
            schema = schemas[name]
            folder = table_folder(f"{output_path}/run_tag={run_tag}", schema)
            replayed = load_tsv(spark, folder, schema) if path_exists(spark, folder) else None
            if replayed is None:
                log.error("no replayed files in %s", folder)
            return replace_window_table(
                spark, f"{target_path}/{name}", replayed, wall(start), wall(end),
                run_tag=run_tag, table=name, on_missing=on_missing,
            )
        except Exception as problem:  # the other tables go on
            log.exception("replacing the window of %s failed", name)
            return Replaced(name, error=str(problem))

    # Each load is a Spark job of its own; a few at a time keep the cluster busy.
    with ThreadPoolExecutor(pool_size) as pool:
        return list(pool.map(load, tables if tables is not None else list(schemas)))
