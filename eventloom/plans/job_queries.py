"""Registered queries that run whole jobs: streams in several batches, fan-out, replacement, replay."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.functions.casts import Conversion, varchar_value
from eventloom.operators.addresses import address_blocks
from eventloom.operators.batches import exact_batches
from eventloom.operators.decode import decode_edge_log
from eventloom.operators.pack import deflate_text
from eventloom.operators.schemas import load_schemas, register_conversion, register_mapping
from eventloom.operators.streams import StreamConfig, StreamEvent
from eventloom.plans import derived as d
from eventloom.plans.pipeline import Sinks, stream_records
from eventloom.plans.queries import (
    EVENT_TYPES, RECORD_COLUMNS, RECORD_PROPS, WINDOW, collated, events, query, schema,
)
from eventloom.plans.replay import replace_window_table, replay
from eventloom.session import shared_folder
from eventloom.sinks.tables import load_tsv, table_folder, write_tables, write_untracked
from eventloom.sinks.versioned import VersionedTable
from eventloom.sources.configs import read_event_metadata, read_sink_configs, read_table_schemas, schema_events
from eventloom.sources.files import folder_names, set_modified
from eventloom.streaming.groups import age_millis, grouped_by_age
from eventloom.streaming.sink_table import SinkTable
from eventloom.streaming.stream import CollateStream, Refreshable


def _run_folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


# ---------------------------------------------------------------- streams in several batches

PARTS = 3
EMPTIED = (datetime(1998, 1, 15), datetime(1998, 3, 10))


@query
def stream_dedupe(spark, sf_dir):
    """Globs in order of time through keyed dedupe state: a batch for each third, every batch a restart."""
    folder = _run_folder(spark, "stream-dedupe")
    record = F.concat(F.lit("["), d.edge_line(
        d.payload(F.lit("{}")), uuid=F.concat(F.lit("u"), F.col("user_id").cast("string"))), F.lit("]"))
    globs = events(spark, sf_dir).select(deflate_text(record).alias("value"), F.col("ts").cast("timestamp").alias("arrival"))
    at = F.unix_micros("arrival")
    cuts = globs.agg(F.percentile_approx(at, [k / PARTS for k in range(1, PARTS)])).first()[0] or []
    job = CollateStream(
        Refreshable(lambda: schema([("time", "time", "f@timestamp@unix-utc")], EVENT_TYPES)), f"{folder}/store",
        Refreshable(Sinks), dedupe_seconds=6 * 3600)
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = globs.where((F.lit(low is None) | (at > F.lit(low))) & (F.lit(high is None) | (at <= F.lit(high))))
        part.write.mode("append").parquet(f"{folder}/globs")
        stream = spark.readStream.schema(globs.schema).parquet(f"{folder}/globs")
        job.start(stream, f"{folder}/checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{folder}/store")
    return rows.select("uuid", "event", F.unix_micros("received_at").alias("received_at"))


def _sink(version: int, name: str, events_of: dict, **settings) -> dict:
    return {"AWSAccount": 7, "Version": version, "Settings": {"StreamName": name, "Events": events_of, **settings}}


_NEWER = _sink(2, "alpha", {"view": {"Fields": ["other", "device"]}, "purchase": {"Fields": ["other"]}}, ExcludeEmptyFields=True)
_LISTED = _sink(1, "gamma", {"signup": {"Fields": ["country", "other"]}}, StreamType="firehose", FirehoseRedshiftStream=True)
#: The configured sinks as each batch finds them.
SINK_VERSIONS = [
    [_sink(1, "alpha", {"view": {"Fields": ["country", "other"], "FieldRenames": {"country": "land"}}}),
     _sink(1, "beta", {"click": {"AllFields": True}}, EventNameTargetField="event")],
    # Replaced, kept, added, and one of a type that doesn't exist.
    [_NEWER, _sink(1, "beta", {"click": {"AllFields": True}}, EventNameTargetField="event"), _LISTED,
     _sink(1, "broken", {"view": {"AllFields": True}}, StreamType="pigeon")],
    # An older version, a dropped one, a newer one that renames what it doesn't list.
    [_sink(1, "alpha", {"error": {"AllFields": True}}),
     _sink(2, "gamma", {"signup": {"Fields": ["other"], "FieldRenames": {"device": "d"}}}, StreamType="firehose", FirehoseRedshiftStream=True)],
    [_NEWER, _LISTED, _sink(3, "beta", {"error": {"Fields": ["device", "country"], "FieldRenames": {"device": "country"}}})],
]


@query
def stream_runtime_sinks(spark, sf_dir):
    """Sinks that are added, replaced, dropped and rejected while the stream runs."""
    folder = _run_folder(spark, "runtime-sinks")
    rows = events(spark, sf_dir)
    table = SinkTable(f"{folder}/sinks", lambda s: read_sink_configs(s, f"{folder}/config"))
    job = CollateStream(
        Refreshable(lambda: schema(RECORD_COLUMNS, EVENT_TYPES)), f"{folder}/store",
        Refreshable(lambda: Sinks(stream_path=f"{folder}/streams")), lines=True, sink_table=table)
    for k, sinks in enumerate(SINK_VERSIONS):
        part = d.event_lines(rows.where(F.col("event_id") % len(SINK_VERSIONS) == k), RECORD_PROPS)
        part.write.mode("append").parquet(f"{folder}/lines")
        spark.createDataFrame([(json.dumps(sinks),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/config")
        stream = spark.readStream.schema("value string").parquet(f"{folder}/lines")
        job.start(stream, f"{folder}/checkpoint").awaitTermination()
    sent = spark.read.parquet(f"{folder}/streams")
    flat = F.col("stream_type") == "firehose"
    return sent.select("batch_id", "stream", F.when(flat, F.regexp_replace("value", r"\n$", "")).otherwise(F.get_json_object("value", "$.Data")).alias("data"))


# ---------------------------------------------------------------- fan-out


@query
def fan_out_streams(spark, sf_dir):
    """A stream for every nation, its settings computed from the nation, all from one scan of the rows."""
    key = F.col("n_nationkey")
    event = lambda fields, renames, every: F.struct(
        F.lit("").alias("Filter"), fields.cast("array<string>").alias("Fields"), renames.alias("FieldRenames"),
        every.alias("AllFields"), F.lit(False).alias("SkipDefaultFilter"))
    none, no_names = F.array(), F.create_map().cast("map<string,string>")
    renamed = F.map_from_arrays(F.array(F.lit("other")), F.array(F.concat(F.lit("o"), key.cast("string"))))
    listed = F.map_from_entries(F.concat(
        F.array(F.struct(F.lit("view"), event(F.array(F.lit("country"), F.lit("other")), renamed, key % 5 == 4))),
        F.when(key % 3 == 0, F.array(F.struct(F.lit("click"), event(F.array(F.lit("device")), no_names, F.lit(False)))))
        .otherwise(F.array(F.struct(F.lit("error"), event(none, no_names, F.lit(True)))))))
    settings = F.struct(
        F.col("n_name").alias("StreamName"), F.lit("").alias("StreamRole"), F.lit("firehose").alias("StreamType"),
        F.lit(False).alias("Compress"), F.lit(True).alias("FirehoseRedshiftStream"),
        F.when(key % 2 == 0, "event").otherwise("").alias("EventNameTargetField"), (key % 4 == 0).alias("ExcludeEmptyFields"),
        listed.alias("Events"), F.struct(F.lit(1000).alias("MaxSize")).alias("Globber"),
        F.struct(F.lit(1000).alias("MaxSize"), F.lit(10).alias("MaxEntries")).alias("Batcher"))
    streams = d.table(spark, sf_dir, "nation").select(settings.alias("settings"))
    rows = collated(spark, sf_dir, RECORD_PROPS, RECORD_COLUMNS)
    return stream_records(rows, Sinks(streams=streams)).select("stream", F.regexp_replace("value", r"\n$", "").alias("data"))


@query
def batch_bytes(spark, sf_dir):
    """Requests of at most 500 bytes and 40 entries (no limit of entries for errors), cut as one pass would."""
    rows = events(spark, sf_dir).select("event_type", "event_id", (F.length("props") + F.col("event_id") % 90).alias("size"))
    entries = F.when(F.col("event_type") == "error", -1).otherwise(40)
    return exact_batches(rows, "event_type", ["event_id"], F.expr("event_id div 1000"), F.col("size"), F.lit(500), entries)


# ---------------------------------------------------------------- replacement


@query
def replace_window_versions(spark, sf_dir):
    """Orders as a table of months: a window replaced, another emptied, a third change broken off."""
    orders = d.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("timestamp_ntz").alias("time"))
    table = VersionedTable(f"{_run_folder(spark, 'orders')}/orders", period="month", pattern="yyyy-MM")
    table.append(orders)
    raised = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1000)
    replace_window_table(spark, table, raised, *WINDOW, run_tag="raise")
    replace_window_table(spark, table, None, *EMPTIED, run_tag="empty", on_missing="empty")
    table._stage(raised, "broken-off")  # written and never committed
    return table.read(spark).select("o_orderkey", "o_totalprice", F.date_format("time", "yyyy-MM-dd").alias("o_day"))


@query
def replaced_counts(spark, sf_dir):
    """What each replacement deleted and inserted."""
    orders = d.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("time"))
    table = VersionedTable(f"{_run_folder(spark, 'orders')}/orders", period="month", pattern="yyyy-MM")
    table.append(orders)
    odd = orders.where("o_orderkey % 2 = 1")
    done = [replace_window_table(spark, table, odd, *WINDOW, run_tag="odd", table="odd"),
            replace_window_table(spark, table, odd, *WINDOW, run_tag="again", table="again"),
            replace_window_table(spark, table, None, *EMPTIED, run_tag="none", table="none", on_missing="empty")]
    return spark.createDataFrame([(r.table, r.deleted, r.inserted) for r in done], "run string, deleted long, inserted long")


# ---------------------------------------------------------------- groups that close by age

AGES = {"view": "6h", "click": "1h30m", "purchase": "90m", "signup": "24h", "error": "3600s"}


@query
def stream_age_groups(spark, sf_dir):
    """Entries of each event type in groups of 400 bytes, 9 entries and the type's age, over three batches; by
    the time of the entries, so that the last groups are those the watermark has passed."""
    folder = _run_folder(spark, "age-groups")
    ages = F.element_at(F.create_map(*[F.lit(v) for pair in AGES.items() for v in pair]), F.col("event_type"))
    rows = events(spark, sf_dir).select(
        F.col("event_type").alias("stream"), F.date_trunc("second", "ts").cast("timestamp").alias("arrival"),
        F.concat(F.lpad(F.col("event_id").cast("string"), 9, "0"), F.repeat(F.lit("x"), (F.col("event_id") % 97).cast("int"))).alias("entry"),
        F.lit(400).alias("max_size"), F.lit(9).alias("max_entries"), age_millis(ages).alias("max_age"))
    at = F.unix_micros("arrival")
    cuts = rows.agg(F.percentile_approx(at, [k / PARTS for k in range(1, PARTS)])).first()[0] or []
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = rows.where((F.lit(low is None) | (at > F.lit(low))) & (F.lit(high is None) | (at <= F.lit(high))))
        part.write.mode("append").parquet(f"{folder}/entries")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/entries")
        closed = grouped_by_age(stream, by_event=True)
        write = lambda df, i: df.write.mode("overwrite").parquet(f"{folder}/groups/batch={i}")
        job = closed.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
        job.start().awaitTermination()
    groups = spark.read.parquet(f"{folder}/groups")
    return groups.select("stream", F.col("entries").cast("long").alias("entries"), "bytes", "closed_by", F.get("value", F.lit(0)).alias("first_entry"))


# ---------------------------------------------------------------- replay

#: In the wall clock of replay windows; its ends are ends of log files.
REPLAY_WINDOW = (datetime(2024, 1, 10), datetime(2024, 1, 13))
FILE_HOURS = 8
REPLAY_COLUMNS = [("time", "time", "f@timestamp@unix"), ("id", "id", "bigint"), ("v", "v", "bigint")]


def _write_logs(rows: DataFrame, path: str) -> None:
    """Gzip log files of eight hours each in folders by day, last written when their hours ended."""
    spark, hour = rows.sparkSession, F.hour("ts")
    lines = rows.select(
        F.date_format("ts", "yyyyMMdd").alias("day"), F.floor(hour / FILE_HOURS).cast("int").alias("part"),
        d.edge_line(d.payload(F.expr("concat('{\"id\":', CAST(event_id AS STRING), ',\"v\":', CAST(event_id + 1000 AS STRING), '}')"))).alias("value"))
    lines.repartition("day", "part").write.option("compression", "gzip").partitionBy("day", "part").text(path)
    for day in folder_names(spark, path):
        if not day.startswith("day="):
            continue
        for part in folder_names(spark, f"{path}/{day}"):
            ended = datetime.strptime(day, "day=%Y%m%d").replace(tzinfo=timezone.utc) + timedelta(
                hours=FILE_HOURS * (int(part.removeprefix("part=")) + 1), seconds=-1)
            set_modified(spark, f"{path}/{day}/{part}", ended)


@query
def replay_tables(spark, sf_dir):
    """Three days of raw logs transformed again and put in the place of those days, in the tables of all events."""
    folder, rows = _run_folder(spark, "replay"), events(spark, sf_dir)
    schemas = schema(REPLAY_COLUMNS)
    _write_logs(rows, f"{folder}/log")
    old = rows.select(
        F.convert_timezone(F.lit("UTC"), F.lit("America/Los_Angeles"), F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("time"),
        F.col("event_id").alias("id"), F.col("event_id").alias("v"), "event_type")
    for name in schemas:
        VersionedTable(f"{folder}/tables/{name}").append(old.where(F.col("event_type") == name).drop("event_type"))
    done = replay(spark, *REPLAY_WINDOW, None, schemas=schemas, log_path=f"{folder}/log", output_path=f"{folder}/out",
                  target_path=f"{folder}/tables", run_tag="run")
    failed = [r.error for r in done if r.error]
    if failed:
        raise RuntimeError(failed[0])
    tables = [VersionedTable(f"{folder}/tables/{n}").read(spark).withColumn("event", F.lit(n)) for n in schemas]
    return reduce(DataFrame.unionByName, tables).select("event", "id", "v", F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"))


# ---------------------------------------------------------------- configuration, payload forms, side outputs


def _config_file(rows: DataFrame, entry: Column, path: str) -> str:
    """A JSON array with an entry per row of a configuration."""
    rows.select(F.to_json(F.collect_list(entry)).alias("value")).coalesce(1).write.text(path)
    return path


@query
def config_tables(spark, sf_dir):
    """Table schemas, their events and event metadata from files: a table for every nation."""
    folder, nation = _run_folder(spark, "config"), d.table(spark, sf_dir, "nation")
    column = lambda i, o, t: F.struct(
        i.alias("InboundName"), o.alias("OutboundName"), F.lit(t).alias("Transformer"), F.lit("").alias("ColumnCreationOptions"),
        F.lit("").alias("SupportingColumns"))
    name, number = F.col("n_name"), (F.col("n_nationkey") % 4).cast("int")
    columns = F.array(column(F.lit("a"), name, "int"), column(F.lit("b"), F.concat(name, F.lit("_b")), "varchar"))
    entry = F.struct(name.alias("EventName"), number.alias("Version"), columns.alias("Columns"))
    read = read_table_schemas(spark, _config_file(nation, entry, f"{folder}/schemas"))
    compiled = load_schemas(read)
    tables = read.select(F.lit("table").alias("kind"), F.col("EventName").alias("name"), F.concat_ws(
        ",", F.col("Version").cast("string"), F.transform("Columns", lambda c: c["OutboundName"])).alias("value"))
    listed = schema_events(read).where(F.col("event").isin(list(compiled))).select(F.lit("event").alias("kind"), F.col("event").alias("name"), F.lit("").alias("value"))
    kind = F.when(number == 0, "comment").otherwise("edge_type")
    types = F.map_from_arrays(F.array(kind), F.array(F.struct(F.concat(F.lit("v"), number.cast("string")).alias("MetadataValue"), number.alias("Version"))))
    metadata = nation.select(F.to_json(F.map_from_entries(F.collect_list(F.struct(name, types)))).alias("value"))
    metadata.coalesce(1).write.text(f"{folder}/metadata")
    told = read_event_metadata(spark, f"{folder}/metadata").select(
        F.lit("metadata").alias("kind"), F.col("event").alias("name"), F.concat_ws(":", "metadata_type", "metadata_value").alias("value"))
    return tables.unionByName(listed).unionByName(told)


@query
def sink_configs(spark, sf_dir):
    """Sinks from a file, a stream for every nation, less those that are fixed."""
    nation, key = d.table(spark, sf_dir, "nation"), F.col("n_nationkey")
    settings = F.struct(
        F.col("n_name").alias("StreamName"), F.when(key % 2 == 0, "reader").otherwise("").alias("StreamRole"),
        F.when(key % 3 == 0, "firehose").otherwise("stream").alias("StreamType"))
    entry = F.struct((key * 11).alias("AWSAccount"), (key % 7).cast("int").alias("Version"), settings.alias("Whatever"))
    path = _config_file(nation, entry, f"{_run_folder(spark, 'sinks')}/sinks")
    fixed = [StreamConfig("NATION_2", role="reader"), StreamConfig("NATION_4", role="other"), StreamConfig("NATION_3", "firehose")]
    return read_sink_configs(spark, path, fixed).drop("settings")


@query
def payload_forms(spark, sf_dir):
    """Payloads in plain and URL-safe base64, with blanks for plus signs, and escaped."""
    text = F.concat(F.lit("~~~>>>???ÿþ"), F.col("event_id").cast("string"))
    body = F.to_json(F.struct(F.col("event_type").alias("event"), F.struct(text.alias("s")).alias("properties")))
    plain = F.base64(body.cast("binary"))
    form = F.col("event_id") % 4
    data = F.when(form == 0, plain).when(form == 1, F.translate(plain, "+/", "-_")).when(form == 2, F.replace(plain, F.lit("+"), F.lit(" "))).otherwise(
        F.url_encode(plain))
    line = F.to_json(F.struct(
        F.lit("2024-01-01T00:00:00Z").alias("receivedAt"), F.col("event_id").cast("string").alias("uuid"), data.alias("data")))
    found = decode_edge_log(events(spark, sf_dir).select(line.alias("value")))
    return found.select("uuid", "event", F.try_variant_get("properties", "$.s", "string").alias("s"))


@query
def untracked_files(spark, sf_dir):
    """Untracked events written to files and read back."""
    rows = collated(spark, sf_dir, "props", [("k", "k", "int")], tracked=["view", "click"])
    path = write_untracked(rows, f"{_run_folder(spark, 'untracked')}/files", rows_per_file=1000)
    dumped = spark.read.text(path)
    return dumped.groupBy(F.get_json_object("value", "$.event").alias("event")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.get_json_object("value", "$.properties.k").cast("long")).alias("k"))


@query
def tagged_tables(spark, sf_dir):
    """Two runs under tags of their own; loading one leaves the other out."""
    folder, tables = f"{_run_folder(spark, 'tagged')}/tables", schema([("n", "n", "bigint")])
    for tag, factor in (("first", 1), ("second", -1)):
        props = f"concat('{{\"n\":', CAST(event_id * {factor} AS STRING), '}}')"
        write_tables(collated(spark, sf_dir, props, [("n", "n", "bigint")]), folder, run_tag=tag)
    loaded = [load_tsv(spark, table_folder(f"{folder}/run_tag=second", t), t).withColumn("event", F.lit(n)) for n, t in tables.items()]
    return reduce(DataFrame.unionByName, loaded)


@query
def own_conversions(spark, sf_dir):
    """A registered conversion and a registered mapping with its own dimension."""
    register_conversion("shouted", Conversion("string", lambda raw, kind: F.upper(varchar_value(raw, kind))))
    register_mapping("nationMapping", "nations")
    nations = d.table(spark, sf_dir, "nation").select(F.col("n_name").alias("login"), (F.col("n_nationkey") + 500).alias("user_id"))
    props = ("concat('{\"word\":\"w', event_type, '\",\"id\":', CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS STRING) ELSE '\"\"' END, "
             "',\"nation\":\"NATION_', CAST(user_id % 30 AS STRING), '\"}')")
    rows = collated(spark, sf_dir, props, [("word", "word", "shouted"), ("id", "id", "nationMapping", "nation")],
                    lookups={"dimensions": {"nations": nations}})
    return rows.select("uuid", F.get("cells", F.lit(0)).alias("word"), F.get("cells", F.lit(1)).alias("id"))


@query
def warehouse_records(spark, sf_dir):
    """Flat records of a warehouse stream: NUL characters are taken out of the values."""
    props = "concat('{\"other\":\"a', chr(92), 'u0000', CAST(event_id AS STRING), chr(92), 'u0000\"}')"
    rows = collated(spark, sf_dir, props, [("other", "other", "varchar")])
    stream = StreamConfig("w", "firehose", warehouse=True, events={e: StreamEvent(("other",)) for e in EVENT_TYPES})
    return stream_records(rows, Sinks(streams=[stream])).select("stream", F.regexp_replace("value", r"\n$", "").alias("data"))


# ---------------------------------------------------------------- addresses of both families


@query
def geo_both_families(spark, sf_dir):
    """Client addresses of both families in nested blocks, the most specific wins; unreadable blocks are counted."""
    key, name = F.col("n_nationkey"), F.col("n_name")
    dec, six = key.cast("string"), F.lower(F.hex(key))
    block = lambda first, last, city: F.struct(first.alias("start_ip"), last.alias("end_ip"), city.alias("city"))
    none = F.lit(None).cast("string")
    blocks = F.array(
        block(F.concat(F.lit("10."), dec, F.lit(".0.0/16")), none, name),
        block(F.concat(F.lit("10."), dec, F.lit(".64.0")), F.when(key % 2 == 0, F.concat(F.lit("10."), dec, F.lit(".200.255"))).otherwise("10.x"),
              F.concat(name, F.lit("_in"))),
        block(F.concat(F.lit("2001:db8:"), six, F.lit("::/48")), none, F.concat(name, F.lit("_six"))),
        block(F.concat(F.lit("2001:db8:"), six, F.lit(":80::/57")), none, F.concat(name, F.lit("_deep"))))
    raw = d.table(spark, sf_dir, "nation").select(F.explode(blocks).alias("b")).select("b.*")
    whole = spark.createDataFrame([("2001:db8::/32", None, "ALL")], raw.schema)
    readable, unreadable = address_blocks(raw.unionByName(whole))
    geo = readable.select("lo", "hi", "city", F.lit("").alias("region"), F.lit("").alias("country"))
    place, part = F.col("user_id") % 30, F.col("event_id") % 256
    four = F.concat_ws(".", F.lit("10"), place.cast("string"), part.cast("string"), F.lit("7"))
    address = F.when(F.col("event_id") % 3 == 0, four).otherwise(
        F.concat(F.lit("2001:DB8:"), F.hex(place), F.lit(":"), F.hex(part), F.lit("::9")))
    rows = collated(spark, sf_dir, "'{}'", [("ip", "city", "ipCity")], lookups={"geo": geo}, client_ip=address)
    return rows.select("uuid", F.get("cells", F.lit(0)).alias("city"), F.lit(unreadable.count()).cast("long").alias("unreadable"))
