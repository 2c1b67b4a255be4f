"""Stream projection, envelopes, configuration sources and snapshots."""

import base64
import json
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventloom.operators import fanout, streams

from eventloom.operators.schemas import load_schemas
from eventloom.operators.snapshots import apply_snapshot, snapshot_diff
from eventloom.operators.streams import RecordFilter, StreamConfig, StreamEvent, project_stream, wrap_records
from eventloom.sources import configs
from eventloom.sources.configs import read_sink_configs
from eventloom.streaming.sink_table import SinkTable

FIELDS = ["aisle", "deck", "lot", "crate", "who"]
IN_PORT = RecordFilter("IN_SET", "deck", ("d1", "d2"))
NAMED = {"port": IN_PORT, "blank": RecordFilter("IN_SET", "lot", ("", "l0"))}


def plain(config, event, record, default=None):
    """What a stream gets of one record, in plain words; None for nothing."""
    spec = config.events.get(event)
    if spec is None:
        return None
    tests = [NAMED[spec.filter_name]] if spec.filter_name else []
    tests += [default] if default and not spec.skip_default_filter else []
    if any(record.get(t.field_name, "") not in t.values for t in tests):
        return None
    out = {config.event_field: event} if config.event_field else {}
    if spec.all_fields:
        out |= record
    else:
        for source in spec.fields:
            value = record.get(source, "")
            if value or not config.exclude_empty:
                out[spec.renames.get(source) or source] = value
    return out or None


def random_config(rng, name):
    events_of = {}
    for event in rng.sample(["load", "shift", "unload"], rng.randint(1, 3)):
        fields = tuple(rng.sample(FIELDS, rng.randint(0, 4)))
        # Renames may form chains, swap two fields or put several under one name.
        renames = {f: rng.choice([*FIELDS, "new", ""]) for f in fields if rng.random() < 0.5}
        events_of[event] = StreamEvent(
            fields, renames, rng.random() < 0.25, rng.choice(["", "", "port", "blank"]), rng.random() < 0.5)
    return StreamConfig(
        name, rng.choice(["stream", "firehose"]), event_field=rng.choice(["", "event", "who"]), exclude_empty=rng.random() < 0.5,
        events=events_of, glob_size=rng.choice([40, 990_000]), compress=rng.random() < 0.4)


def random_rows(rng, n):
    return [(rng.choice(["load", "shift", "unload", "other"]),
             {f: rng.choice(["", f[0] + str(rng.randrange(4)), "é\"x"]) for f in rng.sample(FIELDS, rng.randint(0, 5))}) for _ in range(n)]


SHAPE = "event string, record map<string,string>"


@pytest.mark.parametrize("default", [None, IN_PORT])
def test_fan_out_equals_each_stream_alone(spark, default):
    rng = random.Random(17)
    rows, config_list = random_rows(rng, 120), [random_config(rng, f"s{k}") for k in range(25)]
    frame = spark.createDataFrame(rows, SHAPE)
    specs = fanout.stream_specs(fanout.settings_of(spark, config_list), NAMED, default)
    sent = fanout.fan_out(frame, specs)
    key = lambda fields: json.dumps(fields, sort_keys=True)
    got = Counter((r.stream, r.event, key(r.fields)) for r in sent.collect())
    wanted = Counter()
    for config in config_list:
        for event, record in rows:
            fields = plain(config, event, record, default)
            if fields is not None:
                wanted[config.name, event, key(fields)] += 1
    assert got == wanted and len({s for s, _, _ in wanted}) > 20
    # Everything a stream gets is in its enveloped records, packed or not.
    values, unpacked = fanout.stream_values(sent, packing=True).collect(), Counter()
    for r in values:
        body = json.loads(r.value)
        assert r.value.endswith("\n") == (r.stream_type == "firehose") == (body["CreatedAt"] == "")
        if isinstance(body["Data"], str):
            entries = json.loads(zlib.decompress(base64.b64decode(body["Data"])[1:], -15))
            unpacked.update((r.stream, e["Name"], key(e["Fields"])) for e in entries)
        else:
            unpacked[r.stream, None, key(body["Data"])] += 1
    packs = {c.name for c in config_list if c.compress}
    merged = Counter()
    for (name, event, fields), n in wanted.items():
        merged[name, event if name in packs else None, fields] += n
    assert unpacked == merged
    # One stream by itself.
    for config in config_list[:4]:
        alone = project_stream(frame, config, NAMED, default).collect()
        assert Counter((config.name, r.event, key(r.fields)) for r in alone) == Counter(
            {k: n for k, n in wanted.items() if k[0] == config.name})


def test_one_scan_for_any_number_of_streams(spark, tmp_path):
    rng = random.Random(5)
    spark.createDataFrame(random_rows(rng, 50), SHAPE).write.parquet(f"{tmp_path}/rows")
    specs = fanout.stream_specs(fanout.settings_of(spark, [random_config(rng, f"s{k}") for k in range(300)]), NAMED)
    out = fanout.stream_values(fanout.fan_out(spark.read.parquet(f"{tmp_path}/rows"), specs), packing=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange hashpartitioning" not in plan


def test_many_specs_are_shuffled_alike(spark, monkeypatch):
    rng = random.Random(6)
    frame = spark.createDataFrame(random_rows(rng, 200), SHAPE)
    specs = fanout.stream_specs(fanout.settings_of(spark, [random_config(rng, f"s{k}") for k in range(6)]), NAMED)
    run = lambda: Counter((r.stream, r.event, str(sorted(r.fields.items()))) for r in fanout.fan_out(frame, specs).collect())
    small = run()
    monkeypatch.setattr(fanout, "BROADCAST_SPECS", 1)
    assert run() == small


def test_registered_filter_operator(spark, monkeypatch):
    monkeypatch.setitem(streams.FILTER_OPERATORS, "ONE_STARTS", lambda value, values: F.exists(values, lambda v: value.startswith(v)))
    starts = RecordFilter("ONE_STARTS", "lot", ("a", "b"))
    config = StreamConfig("s", events={"load": StreamEvent(("lot",), filter_name="f")})
    frame = spark.createDataFrame([("load", {"lot": v}) for v in ("ab", "b", "c", "")], SHAPE)
    specs = fanout.stream_specs(fanout.settings_of(spark, [config]), {"f": starts})
    for out in (fanout.fan_out(frame, specs), project_stream(frame, config, {"f": starts})):
        assert sorted(r.fields["lot"] for r in out.collect()) == ["ab", "b"]
    with pytest.raises(ValueError):
        fanout.stream_specs(fanout.settings_of(spark, [config]), {"g": starts})


def test_bad_settings():
    for bad in ({"stream_type": "queue"}, {"glob_size": 0}, {"batch_entries": 0}, {"warehouse": True}):
        with pytest.raises(ValueError):
            StreamConfig("s", **bad)
    with pytest.raises(ValueError):
        StreamConfig("s", events={"load": StreamEvent(fields=("a",), renames={"b": "c"})})


def test_envelopes(spark):
    rows = spark.createDataFrame([({"b": "left\x00right", "a": "\x00"},)], "fields map<string,string>")
    first = lambda *a, **k: wrap_records(rows, *a, **k).first()
    whole = first("warehouse", "fields")
    assert whole.value.endswith("\n") and json.loads(whole.value) == {"a": "", "b": "leftright"}
    kept = first("stream", "fields", record_id=F.lit("id"), created_at=F.lit("2024-01-01 00:00:00.100"))
    assert kept.partition_key == "id"
    assert json.loads(kept.value) == {
        "UUID": "id", "Version": 1, "Data": {"a": "\x00", "b": "left\x00right"}, "CreatedAt": "2024-01-01 00:00:00.1"}
    delivery = first("delivery", "fields")
    assert delivery.value.endswith("}\n") and json.loads(delivery.value)["CreatedAt"] == ""
    glob = spark.createDataFrame([(b"\x01abc",)], "value binary")
    packed = json.loads(wrap_records(glob, "stream", "value").first().value)
    assert packed["Data"] == "AWFiYw==" and len(packed["UUID"]) == 36 and len(packed["CreatedAt"]) >= 19


def test_config_sources(spark, tmp_path):
    (tmp_path / "schemas.json").write_text(json.dumps([{
        "EventName": "clip-start", "Version": 2, "DropRequested": True,
        "Columns": [{"InboundName": "a", "OutboundName": "b", "Transformer": "int", "ColumnCreationOptions": "", "SupportingColumns": ""}]}]))
    frame = configs.read_table_schemas(spark, str(tmp_path / "schemas.json"))
    schemas = load_schemas(frame)
    assert schemas["clip-start"].version == 2 and schemas["clip-start"].names == ["b"]
    assert [r.event for r in configs.schema_events(frame).collect()] == ["clip-start"]

    (tmp_path / "metadata.json").write_text(json.dumps({"shelf-scan": {"edge_type": {"MetadataValue": "internal", "Version": 1}}}))
    assert configs.read_event_metadata(spark, str(tmp_path / "metadata.json")).collect() == [("shelf-scan", "edge_type", "internal")]

    def sink(name, role=""):
        return {"ID": 1, "AWSAccount": 1234567, "Team": "t", "Version": 5, "Settings": {
            "StreamName": name, "StreamRole": role, "StreamType": "stream", "Compress": True, "EventNameTargetField": "",
            "ExcludeEmptyFields": False, "Events": {"shelf-scan": {"Filter": "", "Fields": ["time", "game"], "FieldRenames": {"game": "g"}}},
            "Globber": {"MaxSize": 990000, "MaxAge": "1s", "BufferLength": 1024},
            "Batcher": {"MaxSize": 990000, "MaxEntries": 500, "MaxAge": "1s", "BufferLength": 1024}}}

    (tmp_path / "sinks.json").write_text(json.dumps([sink("one"), sink("two", "r"), sink("two", "other")]))
    sinks = configs.read_sink_configs(spark, str(tmp_path / "sinks.json"), [StreamConfig("two", role="r")])
    assert sorted((r.account, r.stream_name, r.stream_role, r.version) for r in sinks.collect()) == [
        (1234567, "one", "", 5), (1234567, "two", "other", 5)]
    loaded = configs.load_sink_configs(sinks)
    assert loaded[0].compress and loaded[0].events["shelf-scan"].renames == {"game": "g"}
    for section, key in (("Globber", "MaxSize"), ("Batcher", "MaxSize"), ("Batcher", "MaxEntries")):
        settings = sink("zero")["Settings"]
        settings[section][key] = 0  # a given zero is refused, not replaced by a default
        with pytest.raises(ValueError):
            configs.stream_config(settings)
    assert loaded[0].events["shelf-scan"].fields == ("time", "game") and loaded[0].batch_entries == 500


def test_snapshots(spark):
    make = lambda *rows: spark.createDataFrame(list(rows), "kind string, name string, version int")
    def actions(old, new):
        return {(r.kind, r.name): r.action for r in snapshot_diff(old, new, ["kind", "name"]).collect()}
    older, newer = make(("delivery", "lane", 6), ("stream", "dock", 2)), make(("delivery", "lane", 8), ("stream", "dock", 2))
    wider = make(("stream", "lane", 1), ("delivery", "lane", 8), ("stream", "dock", 3))
    assert actions(older, newer) == {("delivery", "lane"): "REPLACE", ("stream", "dock"): "KEEP"}
    assert actions(newer, wider) == {("delivery", "lane"): "KEEP", ("stream", "lane"): "ADD", ("stream", "dock"): "REPLACE"}
    assert actions(wider, make(("stream", "lane", 1))) == {
        ("delivery", "lane"): "DROP", ("stream", "dock"): "DROP", ("stream", "lane"): "KEEP"}
    assert actions(newer, older) == {("delivery", "lane"): "REJECT", ("stream", "dock"): "KEEP"}
    assert sorted(apply_snapshot(newer, older, ["kind", "name"]).collect()) == [("delivery", "lane", 8), ("stream", "dock", 2)]


def sink_text(*sinks):
    return json.dumps([{"AWSAccount": 3, "Version": v, "Own": {"StreamName": n, "Events": {"load": {"AllFields": True}}, **more}}
                       for v, n, more in sinks])


def test_sink_table(spark, tmp_path):
    """Added, replaced, rejected, dropped; a batch that runs again keeps its version; unreadable files change nothing."""
    file = tmp_path / "sinks.json"
    table = SinkTable(f"{tmp_path}/table", lambda s: read_sink_configs(s, str(file)), keep=3)
    names = lambda batch: sorted((r.settings.StreamName, r.settings.Compress) for r in table.at(spark, batch).collect())
    actions = lambda batch: {(r.stream_type, r.stream_name): (r.action, r.version) for r in table.changes(spark, batch).collect()}

    file.write_text(sink_text((1, "a", {}), (4, "b", {"Compress": True}), (1, "bad", {"StreamType": "owl"})))
    assert names(0) == [("a", None), ("b", True)]
    assert actions(0) == {("stream", "a"): ("ADD", 1), ("stream", "b"): ("ADD", 4), ("owl", "bad"): ("REJECT", None)}
    file.write_text(sink_text((2, "a", {"Compress": True}), (3, "b", {}), (1, "c", {"StreamType": "firehose"}), (1, "c", {})))
    assert names(1) == [("a", True), ("b", True), ("c", None), ("c", None)]
    assert actions(1)["stream", "b"] == ("REJECT", 4) and actions(1)["stream", "a"] == ("REPLACE", 2)
    assert ("owl", "bad") not in actions(1)  # it was never in force
    # Settings that can't be used never replace a sink, however high their version; equal versions keep theirs.
    file.write_text(sink_text((9, "a", {"Globber": {"MaxSize": 0}}), (4, "b", {"Compress": True})))
    assert names(2) == [("a", True), ("b", True)]
    problems = {r.stream_name: r.problem for r in table.changes(spark, 2).collect()}
    assert problems["a"].startswith("sizes") and actions(2)["stream", "c"] == ("DROP", None)
    # Run again, batch 1 finds what it had; a broken file leaves the sinks as they are.
    assert names(1) == [("a", True), ("b", True), ("c", None), ("c", None)]
    file.write_text("[{")
    assert names(3) == [("a", True), ("b", True)]
    file.write_text("[]")
    assert names(4) == []


def test_first_read_of_sinks_must_succeed(spark, tmp_path):
    (tmp_path / "sinks.json").write_text("[{")
    with pytest.raises(Exception):
        SinkTable(f"{tmp_path}/table", lambda s: read_sink_configs(s, f"{tmp_path}/sinks.json")).at(spark, 0)
