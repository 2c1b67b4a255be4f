"""Globs, envelopes, payload alphabets, arrays and quarantine rows."""

import json
import zlib

import pytest
from pyspark.sql import functions as F

from eventloom.operators.decode import decode_edge_log, expand_globs, explode_events, inflate_globs
from eventloom.operators.pack import deflate
from tests.conftest import encode, record

LOGIN = '{"event":"login","properties":{"q":"a?>~b","n":1}}'


def decoded(lines, *rows, **options):
    out = decode_edge_log(lines(*rows), **options)
    return [tuple(r) for r in out.select("event", "uuid", "event_time", "client_ip", "failure").collect()]


def test_alphabets(lines):
    std = encode(LOGIN)
    assert "+" in std or "/" in std
    url_safe = std.replace("+", "-").replace("/", "_")
    escaped = std.replace("=", "%3D").replace("+", "%2B").replace("/", "%2F")
    # A bare plus is a blank after unescaping, which stands for plus again.
    for data in (std, url_safe, escaped):
        assert decoded(lines, record(data)) == [("login", "rec-a", 1614834367, "198.51.100.26", 0)]


def test_many_events_get_suffixed_ids(lines):
    four = encode("[" + ",".join([LOGIN] * 4) + "]")
    assert [r[1] for r in decoded(lines, record(four))] == ["rec-a-0", "rec-a-1", "rec-a-2", "rec-a-3"]
    assert [r[1] for r in decoded(lines, record(encode(f"[{LOGIN}]")))] == ["rec-a"]


@pytest.mark.parametrize("payload", [
    "[ {}]", "[]", "5", '{"event":5}', '{"event":"a"} x', '[{"event":"a"},5]', "junk", '{"event":"a",}'])
def test_unusable_payload(lines, payload):
    assert decoded(lines, record(encode(payload))) == [("Unknown", "rec-a", 1614834367, "", 1)]


@pytest.mark.parametrize("row,uuid,time", [
    ("{", "error", 0), ("", "error", 0), ("[]", "error", 0),
    (record("Qw3notreally", uuid="123abc", receivedAt="2014-12-10T00:50:23Z"), "123abc", 1418172623),
    (record("%zz"), "rec-a", 1614834367), (record("%zz", uuid=""), "error", 1614834367),
    (record("%zz", uuid="é" * 33), "error", 1614834367), (record("%zz", uuid="x" * 64), "x" * 64, 1614834367),
    (record(encode(LOGIN), receivedAt="yesterday"), "error", 0), (record(encode(LOGIN), clientIp="1.2.3"), "error", 0),
])
def test_quarantine(lines, row, uuid, time):
    assert decoded(lines, row) == [("Unknown", uuid, time, "", 1)]


def test_bad_lines_can_be_dropped(lines):
    assert [r[0] for r in decoded(lines, "{", record(encode(LOGIN)), on_bad_line="drop")] == ["login"]


def test_null_and_missing_parts(lines):
    rows = decode_edge_log(lines(
        record(encode("null"), uuid="1"), record(encode('{"properties":{}}'), uuid="2"),
        record(encode('{"event":null,"properties":null}'), uuid="3"), record(encode('{"event":"a"}'), uuid="4", clientIp=""),
    )).select("uuid", "event", F.to_json("properties").alias("p"), "client_ip").collect()
    assert {r.uuid: (r.event, r.p) for r in rows} == {"1": ("", None), "2": ("", "{}"), "3": ("", "null"), "4": ("a", None)}
    assert {r.uuid: r.client_ip for r in rows}["4"] == "<nil>"


def test_globs(spark):
    one = deflate(json.dumps([record(encode(LOGIN), uuid="x"), record(encode(LOGIN), uuid="y")]).encode())
    bad_version = b"\x02" + one[1:]
    cut = one[:-5]
    lone_object = deflate(json.dumps(record("")).encode())
    data = [(one,), (bad_version,), (cut,), (deflate(b"[]"),), (lone_object,), (b"",), (None,), (deflate(b"[1"),)]
    inflated = inflate_globs(spark.createDataFrame(data, "value binary"))
    seen = inflated.select("glob_key", "n_records").collect()
    assert sorted((r.glob_key, r.n_records) for r in seen if r.n_records is not None) == [("", 0), ("x", 2)]
    events = explode_events(expand_globs(inflated)).select("uuid", "event").collect()
    assert sorted(map(tuple, events)) == [("x", "login"), ("y", "login")]


def test_globs_with_wrong_parts_are_counted_as_failed(spark):
    """One bad record fails its glob: by a type, by what is no object, by broken JSON anywhere."""
    good = record(encode(LOGIN), uuid="x")
    bodies = [json.dumps(list(rows)) for rows in (
        [good, {**good, "uuid": 5}], [good, {**good, "data": ["a"]}], [{**good, "recordversion": "3"}], [good, 7], [None], [[good]],
        [{**good, "uuid": None, "other": {"uuid": 5}}], [good] * 3)]
    bodies += ['[{"uuid":"x"},]', '[{"uuid":"x"}] x', '[{"uuid":"x"', '[{"uuid":NaN}]', '[{"uuid":"x"} {"uuid":"y"}]', " \n[ ] ", "[" * 100_000]
    inflated = inflate_globs(spark.createDataFrame([(i, deflate(b.encode())) for i, b in enumerate(bodies)], "i int, value binary"))
    found = {r.i: (r.n_records, r.glob_key) for r in inflated.collect() if r.n_records is not None}
    assert found == {6: (1, ""), 7: (3, "x"), 13: (0, "")}
    assert expand_globs(inflated).count() == 4


def test_large_globs_are_expanded_whole(spark):
    """A glob of 200 MB of records, over what a VARIANT may hold, beside a broken one of that size."""
    big = json.dumps(record(encode(LOGIN), uuid="u", userAgent="a" * 2000))
    n = 200_000_000 // len(big)
    body = "[" + ",".join([big] * n) + "]"
    globs = spark.createDataFrame([(deflate(body.encode()),), (deflate((body[:-1] + ",1]").encode()),)], "value binary")
    facts = inflate_globs(globs).select("n_records", "glob_key").collect()
    assert sorted(facts, key=str) == sorted([(n, "u"), (None, "")], key=str)
    assert expand_globs(globs).where("record.uuid = 'u'").count() == n


def test_text_fields_of_lines_hold_text(lines):
    rows = [record(encode(LOGIN), uuid="a"), record(encode(LOGIN), uuid=5), record(encode(LOGIN), uuid=None), record(7),
            record(encode(LOGIN), uuid="b", extra={"uuid": 5}), record(encode(LOGIN), userAgent={"a": 1}, uuid="c")]
    found = decode_edge_log(lines(*rows), "drop").collect()
    assert sorted(r.uuid for r in found) in (["", "a", "b"], ["a", "b", "error"])


def test_inflates_only_once(spark):
    plan = explode_events(expand_globs(spark.createDataFrame([(b"",)], "value binary")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("MapInArrow") == 1 and "ArrowEvalPython" not in text and text.count("from_json") == 1
    from eventloom.operators.reports import glob_totals

    globs = spark.createDataFrame([(b"", None)], "value binary, arrival timestamp")
    assert glob_totals(inflate_globs(globs))._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
