"""Batch job: source to collated store to tables, untracked events and streams."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from eventloom.operators.classify import UNTRACKED, WRITTEN, collate, with_record
from eventloom.operators.decode import decode_edge_log, expand_globs, explode_events, inflate_globs
from eventloom.operators.dedupe import DEFAULT_TTL_SECONDS, dedupe_globs
from eventloom.operators.fanout import (
    STREAM_KEY, fan_out, listed_rows, settings_of, stream_requests, stream_specs, stream_values, write_streams,
)
from eventloom.operators.lookups import KeyTable, RangeTable
from eventloom.operators.project import prepare_blocks, prepare_logins
from eventloom.operators.schemas import TableSchema
from eventloom.operators.streams import RecordFilter, StreamConfig, written
from eventloom.sinks.tables import of_route, write_tables, write_untracked


@dataclass
class Lookups:
    """Optional lookup tables of the projection, as DataFrames or already prepared."""

    geo: DataFrame | RangeTable | None = None
    asn: DataFrame | RangeTable | None = None
    logins: DataFrame | KeyTable | None = None
    dimensions: dict[str, DataFrame | KeyTable] = field(default_factory=dict)

    def prepared(self, **limits) -> Lookups:
        """The same tables measured and cut once, for use by many batches."""
        is_frame = lambda t: isinstance(t, DataFrame)
        return Lookups(
            prepare_blocks(self.geo, "geo", **limits) if is_frame(self.geo) else self.geo,
            prepare_blocks(self.asn, "asn", **limits) if is_frame(self.asn) else self.asn,
            prepare_logins(self.logins, **limits) if is_frame(self.logins) else self.logins,
            {k: prepare_logins(t, **limits) if is_frame(t) else t for k, t in self.dimensions.items()},
        )

    def as_options(self) -> dict:
        return {"geo": self.geo, "asn": self.asn, "logins": self.logins, "dimensions": self.dimensions}


@dataclass
class Sinks:
    """Where a batch goes; every part is optional. Streams are configs, or rows of ``settings``; with
    ``request_path`` their records are also cut into requests of each stream's size."""

    tables: str | None = None
    untracked: str | None = None
    streams: list[StreamConfig] | DataFrame = field(default_factory=list)
    stream_path: str | None = None
    request_path: str | None = None
    filters: dict[str, RecordFilter] = field(default_factory=dict)
    default_filter: RecordFilter | None = None
    run_tag: str | None = None


def decode_globs(globs: DataFrame, ttl_seconds: int = DEFAULT_TTL_SECONDS) -> DataFrame:
    """Globs (``value, arrival``) to events, repeated globs suppressed.

    The dedupe shuffles the packed bytes, which are several times smaller than the
    records in them; unpacking a surviving glob a second time is cheaper than moving it.
    """
    keyed = inflate_globs(globs.select("value", "arrival")).select("value", "arrival", "glob_key")
    kept = dedupe_globs(keyed, ttl_seconds=ttl_seconds)
    return explode_events(expand_globs(kept))


def collate_globs(globs: DataFrame, schemas: dict[str, TableSchema], lookups: Lookups = Lookups(), **options) -> DataFrame:
    return collate(decode_globs(globs), schemas, **lookups.as_options(), **options)


def collate_lines(
    lines: DataFrame, schemas: dict[str, TableSchema], lookups: Lookups = Lookups(),
    on_bad_line: str = "quarantine", **options,
) -> DataFrame:
    return collate(decode_edge_log(lines, on_bad_line), schemas, **lookups.as_options(), **options)


def route(rows: DataFrame) -> DataFrame:
    """Adds ``route``: tables, untracked or failed."""
    return rows.withColumn(
        "route",
        F.when(F.col("status").isin(*WRITTEN), F.lit("tables"))
        .when(F.col("status") == UNTRACKED, F.lit("untracked"))
        .otherwise(F.lit("failed")),
    )


def store_collated(rows: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write collated rows once, by route, and read them back.

    Every sink then scans only its route and columns, instead of decoding the input
    again; a written table also survives the loss of executors.
    """
    routed = route(rows)
    routed.write.mode(mode).partitionBy("route").parquet(path)
    # A batch without rows has no files to take the columns from.
    return rows.sparkSession.read.schema(routed.schema).parquet(path)


def _settings(rows: DataFrame, sinks: Sinks) -> DataFrame:
    return sinks.streams if isinstance(sinks.streams, DataFrame) else settings_of(rows.sparkSession, sinks.streams)


def stream_records(rows: DataFrame, sinks: Sinks, created_at: Column | None = None) -> DataFrame:
    """``stream_type, stream, value``: enveloped records of all streams, from one scan of ``rows``."""
    specs = stream_specs(_settings(rows, sinks), sinks.filters, sinks.default_filter)
    # The events any stream lists are picked before records are built.
    wanted = listed_rows(of_route(written(rows), "tables"), specs)
    packing = specs.where("compress").limit(1).count() > 0
    return stream_values(fan_out(with_record(wanted), specs), packing, created_at=created_at)


def write_sinks(stored: DataFrame, sinks: Sinks, mode: str = "overwrite") -> None:
    """Fan-out: every row to all sinks that want it."""
    if sinks.tables:
        write_tables(stored, sinks.tables, run_tag=sinks.run_tag, mode=mode)
    if sinks.untracked:
        write_untracked(stored, sinks.untracked, mode=mode)
    if sinks.stream_path:
        values = stream_records(stored, sinks)
        write_streams(values, sinks.stream_path, mode)
        if sinks.request_path:
            shape = StructType([*values.select("value").schema, *values.select(*STREAM_KEY).schema])
            written = stored.sparkSession.read.schema(shape).parquet(sinks.stream_path)
            stream_requests(written, _settings(stored, sinks)).write.mode(mode).partitionBy(*STREAM_KEY).parquet(sinks.request_path)


def run_batch(rows: DataFrame, store_path: str, sinks: Sinks, mode: str = "overwrite") -> DataFrame:
    """Collated rows to the store and from there to all sinks; returns the stored rows.

    A run that is repeated replaces what it wrote; ``append`` adds to what is there.
    """
    stored = store_collated(rows, store_path)
    write_sinks(stored, sinks, mode)
    return stored
