"""Downstream streams: filters, projection, entries and record envelopes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.functions.text import sorted_json, sorted_map
from eventloom.functions.variants import pinned
from eventloom.operators.classify import WRITTEN

RECORD_VERSION = 1

# Named filter operators (extension point): field value and array of listed values to a predicate.
FILTER_OPERATORS: dict[str, Callable[[Column, Column], Column]] = {
    "IN_SET": lambda value, values: F.array_contains(values, value),
}


def register_filter_operator(name: str, build: Callable[[Column, Column], Column]) -> None:
    FILTER_OPERATORS[name] = build


@dataclass(frozen=True)
class RecordFilter:
    """``operator`` applied to one record field; a missing field reads as ''."""

    operator: str
    field_name: str
    values: tuple[str, ...]

    def predicate(self, record: Column) -> Column:
        if self.operator not in FILTER_OPERATORS:
            raise ValueError(f"unknown filter operator {self.operator}")
        value = F.coalesce(F.try_element_at(record, F.lit(self.field_name)), F.lit(""))
        return FILTER_OPERATORS[self.operator](value, F.array(*map(F.lit, self.values)).cast("array<string>"))


@dataclass(frozen=True)
class StreamEvent:
    """What one stream takes of one event."""

    fields: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=dict)
    all_fields: bool = False
    filter_name: str = ""
    skip_default_filter: bool = False


@dataclass(frozen=True)
class StreamConfig:
    name: str
    stream_type: str = "stream"
    role: str = ""
    region: str = ""
    compress: bool = False
    warehouse: bool = False
    event_field: str = ""
    exclude_empty: bool = False
    events: dict[str, StreamEvent] = field(default_factory=dict)
    glob_size: int = 990_000
    batch_size: int = 990_000
    batch_entries: int = 500

    def __post_init__(self):
        if self.stream_type not in ("stream", "firehose"):
            raise ValueError(f"unknown stream type {self.stream_type}")
        if self.warehouse and (self.compress or self.stream_type != "firehose"):
            raise ValueError("warehouse mode needs an uncompressed delivery stream")
        if self.glob_size <= 0 or self.batch_size <= 0 or not (
            self.batch_entries == -1 or self.batch_entries > 0
        ):
            raise ValueError("sizes must be positive, entries positive or -1")
        for name, event in self.events.items():
            unknown = set(event.renames) - set(event.fields)
            if unknown and not event.all_fields:
                raise ValueError(f"renamed fields of {name} are not selected: {sorted(unknown)}")


def written(rows: DataFrame) -> DataFrame:
    """Rows that go to tables and streams."""
    return rows.where(F.col("status").isin(*WRITTEN))


def stream_filter(
    config: StreamConfig,
    filters: dict[str, RecordFilter] | None = None,
    default_filter: RecordFilter | None = None,
    event: str = "event",
    record: str = "record",
) -> Column:
    """Events the stream lists, minus what its named and default filters reject."""
    filters = filters or {}
    keep = F.lit(False)
    listed = F.col(event)
    grouped: dict[tuple[str, bool], list[str]] = {}
    for name, spec in config.events.items():
        grouped.setdefault((spec.filter_name, spec.skip_default_filter), []).append(name)
    for (filter_name, skip_default), names in grouped.items():
        test = listed.isin(names)
        if filter_name:
            if filter_name not in filters:
                raise ValueError(f"unknown filter {filter_name}")
            test = test & filters[filter_name].predicate(F.col(record))
        if default_filter is not None and not skip_default:
            test = test & default_filter.predicate(F.col(record))
        keep = keep | test
    return keep


def _selected(config: StreamConfig, name: str, spec: StreamEvent, record: Column) -> Column:
    """``MAP`` a stream gets of one event's record."""
    if spec.all_fields:
        if not config.event_field:
            return record
        # A data field of the same name wins over the event name.
        own = F.map_filter(
            F.create_map(F.lit(config.event_field), F.lit(name)),
            lambda k, _: ~F.map_contains_key(record, F.lit(config.event_field)),
        )
        return F.map_concat(own, record)
    out: dict[str, Column] = {}
    if config.event_field:
        out[config.event_field] = F.lit(name)
    for source in spec.fields:
        target = spec.renames.get(source) or source
        value = F.coalesce(F.try_element_at(record, F.lit(source)), F.lit(""))
        if config.exclude_empty:
            value = F.nullif(value, F.lit(""))
            # An empty field leaves the event name in place.
            value = F.coalesce(value, out[target]) if target in out else value
        out[target] = value
    if not out:
        return F.lit(None).cast("map<string,string>")
    pairs = [c for k, v in out.items() for c in (F.lit(k), v)]
    full = F.create_map(*pairs)
    return F.map_filter(full, lambda _, v: v.isNotNull()) if config.exclude_empty else full


def project_stream(
    rows: DataFrame,
    config: StreamConfig,
    filters: dict[str, RecordFilter] | None = None,
    default_filter: RecordFilter | None = None,
) -> DataFrame:
    """Filtered, projected copy of rows (``event, record``) for one stream.

    Output columns: ``event, fields MAP<STRING,STRING>``; rows whose projection holds no
    key at all are not sent.  Narrow.
    """
    kept = rows.where(stream_filter(config, filters, default_filter))
    fields = F.lit(None).cast("map<string,string>")
    for name, spec in config.events.items():
        fields = F.when(F.col("event") == name, _selected(config, name, spec, F.col("record"))).otherwise(fields)
    return kept.select("event", pinned(fields).alias("fields")).where(F.size("fields") > 0)


def compressed_entry(event: Column, fields: Column) -> Column:
    """``{"Name":…,"Fields":{…}}`` with sorted keys, the unit that is packed."""
    return F.to_json(F.struct(event.alias("Name"), sorted_map(fields).alias("Fields")))


def plain_entry(fields: Column) -> Column:
    """The flat map as JSON with sorted keys."""
    return sorted_json(fields)


def stream_entries(projected: DataFrame, config: StreamConfig) -> DataFrame:
    """``stream, entry`` ready for ``pack_globs`` (compressed) or ``batch_records``."""
    build = compressed_entry(F.col("event"), F.col("fields")) if config.compress else plain_entry(F.col("fields"))
    return projected.select(F.lit(config.name).alias("stream"), build.alias("entry"))


def strip_nuls(fields: Column) -> Column:
    return F.transform_values(fields, lambda _, v: F.replace(v, F.lit("\x00"), F.lit("")))


def creation_stamp(created_at: Column | None = None) -> Column:
    """Creation time in UTC without trailing zeros of the fraction; now, if none is given."""
    stamp = created_at if created_at is not None else F.date_format(
        F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd HH:mm:ss.SSS"
    )
    return F.regexp_replace(F.regexp_replace(stamp, r"([.]\d*?)0+$", "$1"), r"[.]$", "")


def wrap_records(
    rows: DataFrame,
    kind: str | Sequence[str],
    data: str,
    *,
    record_id: Column | None = None,
    created_at: Column | None = None,
) -> DataFrame:
    """Record envelopes: ``partition_key, value``.

    ``kind`` is ``stream`` (with creation time), ``delivery`` (creation time left empty,
    newline at the end) or ``warehouse`` (the flat map itself, NULs removed).  Of several kinds every
    row gives an envelope each, with an id of its own unless ``record_id`` is given, from one pass over
    the rows.  ``data`` is either a BINARY glob or a MAP of fields.
    """
    kinds = [kind] if isinstance(kind, str) else list(kind)
    unknown = set(kinds) - {"stream", "delivery", "warehouse"}
    if unknown or not kinds:
        raise ValueError(f"unknown envelope kind {sorted(unknown)}")
    is_glob = dict(rows.dtypes)[data] == "binary"
    if is_glob and "warehouse" in kinds:
        raise ValueError("warehouse records hold fields, not globs")
    ids = {f"_id{i}": record_id if record_id is not None else F.uuid() for i in range(len(kinds))}
    content = F.base64(data) if is_glob else sorted_map(F.col(data))
    rows = rows.select(*[c.alias(name) for name, c in ids.items()], content.alias("_content"))
    made = [F.struct(F.col(name).alias("partition_key"), _record_text(k, F.col(name), created_at).alias("value"))
            for name, k in zip(ids, kinds)]
    if len(made) == 1:
        return rows.select(made[0].alias("r")).select("r.*")
    return rows.select(F.explode(F.array(*made)).alias("r")).select("r.*")


def _record_text(kind: str, record_id: Column, created_at: Column | None) -> Column:
    """One record of ``_content``: the base64 text of a glob, or fields in order."""
    content = F.col("_content")
    if kind == "warehouse":
        return F.concat(F.to_json(strip_nuls(content)), F.lit("\n"))
    stamp = F.lit("") if kind == "delivery" else creation_stamp(created_at)
    envelope = F.to_json(F.struct(
        record_id.alias("UUID"), F.lit(RECORD_VERSION).alias("Version"), content.alias("Data"), stamp.alias("CreatedAt")))
    return F.concat(envelope, F.lit("\n")) if kind == "delivery" else envelope
