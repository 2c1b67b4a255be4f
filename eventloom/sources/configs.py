"""Configuration sources: table schemas, event metadata, stream sinks."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.operators.streams import RecordFilter, StreamConfig, StreamEvent

SCHEMA_CONFIG = (
    "EventName string, Version int, Columns array<struct<InboundName:string, OutboundName:string, "
    "Transformer:string, ColumnCreationOptions:string, SupportingColumns:string>>, CreatedTS string, "
    "TS string, UserName string, Dropped boolean, DropRequested boolean, Reason string"
)
METADATA_CONFIG = "map<string,map<string,struct<MetadataValue:string,TS:string,UserName:string,Version:int>>>"
# One entry of the sink list: its own keys, and the stream settings under a nested object.
STREAM_SETTINGS = (
    "StreamName string, StreamRole string, StreamType string, StreamRegion string, Compress boolean, "
    "FirehoseRedshiftStream boolean, EventNameTargetField string, ExcludeEmptyFields boolean, "
    "BufferSize int, MaxAttemptsPerRecord int, RetryDelay string, "
    "Events map<string,struct<Filter:string,Fields:array<string>,FieldRenames:map<string,string>,"
    "AllFields:boolean,SkipDefaultFilter:boolean>>, "
    "Globber struct<MaxSize:int,MaxAge:string,BufferLength:int>, "
    "Batcher struct<MaxSize:int,MaxEntries:int,MaxAge:string,BufferLength:int>"
)


def read_table_schemas(spark: SparkSession, path: str) -> DataFrame:
    """Table schemas from a JSON array (gzip or plain), with an explicit schema."""
    return spark.read.schema(SCHEMA_CONFIG).option("multiLine", True).option("mode", "FAILFAST").json(path)


def schema_events(schemas: DataFrame) -> DataFrame:
    """Names of all configured tables."""
    return schemas.select(F.col("EventName").alias("event")).distinct()


def read_event_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``event, metadata_type, metadata_value`` from a JSON map of maps."""
    whole = spark.read.option("wholetext", True).text(path)
    parsed = F.from_json("value", METADATA_CONFIG, {"mode": "FAILFAST"})
    per_event = whole.select(F.explode(parsed).alias("event", "_types"))
    return per_event.select("event", F.explode("_types").alias("metadata_type", "_row")).select(
        "event", "metadata_type", F.col("_row.MetadataValue").alias("metadata_value")
    )


def read_sink_configs(
    spark: SparkSession, path: str, static_sinks: list[StreamConfig] | None = None
) -> DataFrame:
    """Stream sinks ``account, stream_type, stream_name, stream_role, version, settings``.

    Entries with the same (role, type, name) as a static sink are removed.
    """
    whole = spark.read.option("wholetext", True).text(path)
    entries = whole.select(
        F.explode(F.from_json("value", "array<map<string,string>>", {"mode": "FAILFAST"})).alias("e")
    )
    # The settings are the one nested object that names a stream.
    nested = F.filter(F.map_values("e"), lambda v: F.get_json_object(v, "$.StreamName").isNotNull())
    fields = "struct<" + STREAM_SETTINGS.replace(" string", ":string").replace(" int", ":int").replace(
        " boolean", ":boolean").replace(" map<", ":map<").replace(" struct<", ":struct<") + ">"
    parsed = entries.select(
        F.col("e")["AWSAccount"].cast("bigint").alias("account"),
        F.col("e")["Version"].cast("int").alias("version"),
        F.from_json(F.try_element_at(nested, F.lit(1)), fields).alias("settings"),
    )
    sinks = parsed.select(
        "account",
        F.col("settings.StreamType").alias("stream_type"),
        F.col("settings.StreamName").alias("stream_name"),
        F.coalesce(F.col("settings.StreamRole"), F.lit("")).alias("stream_role"),
        "version",
        "settings",
    )
    if not static_sinks:
        return sinks
    taken = spark.createDataFrame(
        [(s.role, s.stream_type, s.name) for s in static_sinks],
        "stream_role string, stream_type string, stream_name string",
    )
    return sinks.join(taken, ["stream_role", "stream_type", "stream_name"], "left_anti").select(*sinks.columns)


SINK_KEYS = ["account", "stream_type", "stream_name"]


def _given(section: dict, key: str, default: int) -> int:
    """A setting as given, a zero too (the config refuses it); only a missing one has a default."""
    return default if section.get(key) is None else section[key]


def stream_config(settings: dict) -> StreamConfig:
    """One sink's settings as a validated :class:`StreamConfig`."""
    events = {
        name: StreamEvent(
            tuple(e.get("Fields") or ()), dict(e.get("FieldRenames") or {}),
            bool(e.get("AllFields")), e.get("Filter") or "", bool(e.get("SkipDefaultFilter")),
        )
        for name, e in (settings.get("Events") or {}).items()
    }
    globber, batcher = settings.get("Globber") or {}, settings.get("Batcher") or {}
    return StreamConfig(
        name=settings["StreamName"], stream_type=settings.get("StreamType") or "stream",
        role=settings.get("StreamRole") or "", region=settings.get("StreamRegion") or "",
        compress=bool(settings.get("Compress")), warehouse=bool(settings.get("FirehoseRedshiftStream")),
        event_field=settings.get("EventNameTargetField") or "",
        exclude_empty=bool(settings.get("ExcludeEmptyFields")), events=events,
        glob_size=_given(globber, "MaxSize", 990_000), batch_size=_given(batcher, "MaxSize", 990_000),
        batch_entries=_given(batcher, "MaxEntries", 500),
    )


def load_sink_configs(sinks: DataFrame) -> list[StreamConfig]:
    """Sinks as driver-side configs, taken partition by partition: each is a job of its own to run."""
    rows = sinks.select(F.to_json("settings").alias("s")).toLocalIterator()
    return [stream_config(json.loads(r["s"])) for r in rows]


def load_filters(config: dict[str, dict]) -> dict[str, RecordFilter]:
    """Named filters from ``{name: {Operator, Field, Values}}``."""
    return {
        name: RecordFilter(f["Operator"], f["Field"], tuple(f["Values"])) for name, f in config.items()
    }
