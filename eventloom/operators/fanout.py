"""Fan-out in one pass: stream settings are data, joined to the rows, so any number of streams costs
one scan.

A *spec* is one event of one stream: which fields it takes under which names, its tests, and how the
stream's records are made. Rows meet the specs of their event; each pair that passes the tests gives
the fields the stream gets.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventloom.functions.text import sorted_json
from eventloom.functions.variants import pinned
from eventloom.operators.batches import exact_batches
from eventloom.operators.pack import NO_LIMIT, Greedy, deflate
from eventloom.operators.streams import (
    FILTER_OPERATORS, RECORD_VERSION, RecordFilter, StreamConfig, compressed_entry, creation_stamp, strip_nuls,
)

STREAM_KEY = ["stream_type", "stream"]
#: Specs (rows of configuration, a few hundred bytes each) up to so many are broadcast; more are shuffled
#: by event, each event spread over ``SALTS`` keys.
BROADCAST_SPECS, SALTS = 100_000, 32
#: Records of a stream that one task cuts into requests at once.
ROWS_PER_SLICE = 20_000

SETTINGS = (
    "StreamName string, StreamRole string, StreamType string, Compress boolean, FirehoseRedshiftStream boolean, "
    "EventNameTargetField string, ExcludeEmptyFields boolean, "
    "Events map<string,struct<Filter:string,Fields:array<string>,FieldRenames:map<string,string>,"
    "AllFields:boolean,SkipDefaultFilter:boolean>>, Globber struct<MaxSize:int>, Batcher struct<MaxSize:int,MaxEntries:int>"
)
_TESTS = "array<struct<operator:string,field:string,values:array<string>>>"


def settings_of(spark: SparkSession, configs: list[StreamConfig]) -> DataFrame:
    """``settings`` rows of validated configs, in the shape configuration files have."""
    rows = [((
        c.name, c.role, c.stream_type, c.compress, c.warehouse, c.event_field, c.exclude_empty,
        {n: (e.filter_name, list(e.fields), dict(e.renames), e.all_fields, e.skip_default_filter) for n, e in c.events.items()},
        (c.glob_size,), (c.batch_size, c.batch_entries)),) for c in configs]
    fields = SETTINGS.replace(" string", ":string").replace(" boolean", ":boolean").replace(" map<", ":map<").replace(" struct<", ":struct<")
    return spark.createDataFrame(rows, f"settings struct<{fields}>")


def settings_problem(s: Column) -> Column:
    """Why the settings of a sink can't be used, or NULL: the rules of ``StreamConfig``."""
    kind = F.coalesce(F.nullif(s["StreamType"], F.lit("")), F.lit("stream"))
    warehouse, compress = F.coalesce(s["FirehoseRedshiftStream"], F.lit(False)), F.coalesce(s["Compress"], F.lit(False))
    size = lambda value: F.coalesce(value, F.lit(1))  # noqa: E731 - a missing size has a default
    entries = size(s["Batcher"]["MaxEntries"])
    stray = F.exists(
        F.map_values(s["Events"]),
        lambda e: ~F.coalesce(e["AllFields"], F.lit(False)) & (F.size(F.array_except(
            F.coalesce(F.map_keys(e["FieldRenames"]), F.array().cast("array<string>")),
            F.coalesce(e["Fields"], F.array().cast("array<string>")))) > 0))
    return (
        F.when(s.isNull() | s["StreamName"].isNull(), "no settings")
        .when(~kind.isin("stream", "firehose"), "unknown stream type")
        .when(warehouse & (compress | (kind != "firehose")), "warehouse mode needs an uncompressed delivery stream")
        .when((size(s["Globber"]["MaxSize"]) <= 0) | (size(s["Batcher"]["MaxSize"]) <= 0) | ~((entries == NO_LIMIT) | (entries > 0)),
              "sizes must be positive, entries positive or -1")
        .when(F.coalesce(stray, F.lit(False)), "renamed fields are not selected")
    )


def _filters(spark: SparkSession, filters: dict[str, RecordFilter]) -> DataFrame:
    rows = [(name, (f.operator, f.field_name, list(f.values))) for name, f in filters.items()]
    return spark.createDataFrame(rows, "filter string, test struct<operator:string,field:string,values:array<string>>")


def stream_specs(
    sinks: DataFrame, filters: dict[str, RecordFilter] | None = None, default_filter: RecordFilter | None = None
) -> DataFrame:
    """Specs of all streams of ``sinks`` (``settings``). A named filter that is unknown is an error."""
    spark, s = sinks.sparkSession, F.col("settings")
    unknown = {f.operator for f in [*(filters or {}).values(), *([default_filter] if default_filter else [])]} - set(FILTER_OPERATORS)
    if unknown:
        raise ValueError(f"unknown filter operators {sorted(unknown)}")
    false, none = F.lit(False), F.array().cast("array<string>")
    rows = sinks.select(
        F.coalesce(F.nullif(s["StreamType"], F.lit("")), F.lit("stream")).alias("stream_type"), s["StreamName"].alias("stream"),
        F.coalesce(s["Compress"], false).alias("compress"), F.coalesce(s["FirehoseRedshiftStream"], false).alias("warehouse"),
        F.coalesce(s["Globber"]["MaxSize"], F.lit(990_000)).alias("glob_size"),
        F.coalesce(s["EventNameTargetField"], F.lit("")).alias("event_field"),
        F.coalesce(s["ExcludeEmptyFields"], false).alias("exclude_empty"), F.explode(s["Events"]).alias("event", "e"))
    renames = F.coalesce(F.col("e.FieldRenames"), F.map_from_arrays(none, none))
    target = lambda f: F.coalesce(F.nullif(F.try_element_at(renames, f), F.lit("")), f)
    fields = F.transform(F.coalesce("e.Fields", none), lambda f: F.struct(f.alias("source"), target(f).alias("target")))
    rows = rows.withColumn("fields", fields).withColumn("filter", F.coalesce("e.Filter", F.lit("")))
    names = F.concat(F.transform("fields", lambda f: f["target"]), F.when(F.col("event_field") != "", F.array("event_field")).otherwise(none))
    named = rows.join(F.broadcast(_filters(spark, filters or {})), "filter", "left")
    lost = named.where((F.col("filter") != "") & F.col("test").isNull()).select("filter").first()
    if lost:
        raise ValueError(f"unknown filter {lost[0]}")
    own = F.when(F.col("test").isNotNull(), F.array("test")).otherwise(F.array()).cast(_TESTS)
    if default_filter is not None:
        d = default_filter
        general = F.array(F.struct(
            F.lit(d.operator).alias("operator"), F.lit(d.field_name).alias("field"),
            (F.array(*map(F.lit, d.values)) if d.values else F.array()).cast("array<string>").alias("values")))
        own = F.concat(own, F.when(F.coalesce("e.SkipDefaultFilter", false), F.array()).otherwise(general).cast(_TESTS))
    return named.select(
        *STREAM_KEY, F.when(F.col("warehouse"), "warehouse").when(F.col("stream_type") == "stream", "stream").otherwise("delivery").alias("kind"),
        "compress", "glob_size", "event", "event_field", "exclude_empty", F.coalesce("e.AllFields", false).alias("all_fields"),
        "fields", (F.size(F.array_distinct(names)) < F.size(names)).alias("clashing"), own.alias("tests"))


def _passes(record: Column) -> Column:
    """All tests of the row's spec; a field the record lacks reads as ''."""
    def one(test: Column) -> Column:
        value = F.coalesce(F.try_element_at(record, test["field"]), F.lit(""))
        cases = [(test["operator"] == name) & build(value, test["values"]) for name, build in FILTER_OPERATORS.items()]
        return reduce(lambda a, b: a | b, cases)

    return F.forall("tests", one)


def _projected(record: Column) -> Column:
    """The fields the row's spec takes of the record, as ``project_stream`` does for one stream."""
    pair = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    name, none = F.col("event_field"), F.array().cast("array<struct<key:string,value:string>>")
    own = F.when(name != "", F.array(pair(name, F.col("event")))).otherwise(none)
    listed = F.concat(own, F.transform("fields", lambda f: pair(f["target"], F.coalesce(F.try_element_at(record, f["source"]), F.lit("")))))
    kept = F.when(F.col("exclude_empty"), F.filter(listed, lambda e: e["value"] != "")).otherwise(listed)
    # Of equal names the last one holds.
    last = F.filter(kept, lambda e, i: ~F.exists(F.slice(kept, i + 2, F.size(kept)), lambda later: later["key"] == e["key"]))
    chosen = F.map_from_entries(F.when(F.col("clashing"), last).otherwise(kept))
    # A data field of the same name wins over the event name.
    added = (name != "") & ~F.map_contains_key(record, name)
    every = F.when(added, F.map_concat(F.create_map(name, F.col("event")), record)).otherwise(record)
    return F.when(F.col("all_fields"), every).otherwise(chosen)


def _met(rows: DataFrame, specs: DataFrame) -> DataFrame:
    if specs.count() <= BROADCAST_SPECS:
        return rows.join(F.broadcast(specs), "event")
    salted = rows.withColumn("_salt", F.floor(F.rand() * SALTS).cast("int"))
    return salted.join(specs.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["event", "_salt"]).drop("_salt")


def listed_rows(rows: DataFrame, specs: DataFrame) -> DataFrame:
    """Rows of events any stream lists: what is picked before records are built."""
    names = specs.select("event").distinct()
    return rows.join(F.broadcast(names) if specs.count() <= BROADCAST_SPECS else names, "event", "left_semi")


def fan_out(rows: DataFrame, specs: DataFrame) -> DataFrame:
    """``stream_type, stream, kind, compress, glob_size, event, fields`` of rows (``event, record``): one row
    for each stream that takes the event, passes the row and gets at least one field of it."""
    met = _met(rows.select("event", "record"), specs).where(_passes(F.col("record")))
    sent = met.select(*STREAM_KEY, "kind", "compress", "glob_size", "event", pinned(_projected(F.col("record"))).alias("fields"))
    return sent.where(F.size("fields") > 0)


def _packed(rows: DataFrame) -> DataFrame:
    """``stream_type, stream, kind, data``: entries of compressed streams packed into base64 globs, greedily
    in each task, with the stream's own size bound; entries of other streams as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers: dict[tuple, Greedy] = {}

        def emit(groups: list[tuple[tuple, str]]) -> pa.RecordBatch:
            columns = zip(*[(*key, data) for key, data in groups]) if groups else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in columns], ["stream_type", "stream", "kind", "data"])

        glob = lambda group: base64.b64encode(deflate(b"[" + ",".join(group).encode() + b"]")).decode()
        for batch in batches:
            out = []
            for stream_type, stream, kind, compress, size, entry in zip(*(c.to_pylist() for c in batch.columns)):
                key = (stream_type, stream, kind)
                if not compress:
                    out.append((key, entry))
                    continue
                if key not in packers:
                    packers[key] = Greedy(size, NO_LIMIT, True)
                group = packers[key].add(stream, entry)
                if group:
                    out.append((key, f'"{glob(group)}"'))
            yield emit(out)
        yield emit([(key, f'"{glob(group)}"') for key, p in packers.items() for group in p.open.values() if group])

    return rows.mapInArrow(run, "stream_type string, stream string, kind string, data string")


def stream_values(sent: DataFrame, packing: bool, record_id: Column | None = None, created_at: Column | None = None) -> DataFrame:
    """``stream_type, stream, value``: enveloped records of fanned-out rows. ``packing``: whether any stream
    compresses; only then rows pass through Python."""
    plain = F.when(F.col("kind") == "warehouse", sorted_json(strip_nuls(F.col("fields")))).otherwise(sorted_json(F.col("fields")))
    entry = F.when(F.col("compress"), compressed_entry(F.col("event"), F.col("fields"))).otherwise(plain)
    rows = sent.select(*STREAM_KEY, "kind", "compress", "glob_size", entry.alias("data"))
    rows = _packed(rows) if packing else rows.select(*STREAM_KEY, "kind", "data")
    head = F.to_json(F.struct((record_id if record_id is not None else F.uuid()).alias("UUID"), F.lit(RECORD_VERSION).alias("Version")))
    stamp = F.when(F.col("kind") == "stream", creation_stamp(created_at)).otherwise(F.lit(""))
    envelope = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"Data":'), F.col("data"), F.lit(',"CreatedAt":"'), stamp, F.lit('"}'))
    newline = F.when(F.col("kind") == "stream", "").otherwise("\n")
    return rows.select(*STREAM_KEY, F.concat(F.when(F.col("kind") == "warehouse", F.col("data")).otherwise(envelope), newline).alias("value"))


def request_limits(sinks: DataFrame) -> DataFrame:
    """``stream_type, stream, batch_size, batch_entries`` of ``sinks`` (``settings``)."""
    s = F.col("settings")
    return sinks.select(
        F.coalesce(F.nullif(s["StreamType"], F.lit("")), F.lit("stream")).alias("stream_type"), s["StreamName"].alias("stream"),
        F.coalesce(s["Batcher"]["MaxSize"], F.lit(990_000)).alias("batch_size"),
        F.coalesce(s["Batcher"]["MaxEntries"], F.lit(500)).alias("batch_entries"))


def stream_requests(values: DataFrame, sinks: DataFrame) -> DataFrame:
    """``stream_type, stream, batch_no, records ARRAY<STRING>`` of written stream values, read back as Parquet:
    exact batches in the order of files and rows, within each stream's bytes and entries."""
    limits = request_limits(sinks).groupBy(*STREAM_KEY).agg(F.max("batch_size").alias("batch_size"), F.max("batch_entries").alias("batch_entries"))
    rows = values.select(
        *STREAM_KEY, "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    rows = rows.join(F.broadcast(limits) if limits.count() <= BROADCAST_SPECS else limits, STREAM_KEY)
    rows = rows.withColumn("_key", F.to_json(F.struct(*STREAM_KEY)))
    part = F.concat_ws(":", "file", F.lpad(F.expr(f"row div {ROWS_PER_SLICE}").cast("string"), 12, "0"))
    cut = exact_batches(rows, "_key", ["file", "row"], part, F.octet_length("value"), F.col("batch_size"), F.col("batch_entries"))
    # A batch is bounded by its bytes.
    own = cut.groupBy(*STREAM_KEY, "batch_no").agg(F.sort_array(F.collect_list(F.struct("file", "row", "value"))).alias("records"))
    return own.select(*STREAM_KEY, "batch_no", F.col("records.value").alias("records"))


def write_streams(values: DataFrame, path: str, mode: str) -> None:
    """All streams in one write, a folder each. REBALANCE gathers the rows of a stream into few files and
    splits one that holds most of the rows."""
    values.hint("rebalance", *STREAM_KEY).write.mode(mode).partitionBy(*STREAM_KEY).parquet(path)
