"""Golden rows of the projection, classification, records and reports."""

import json

import pytest
from pyspark.sql import functions as F

from eventloom.operators import reports
from eventloom.operators.classify import collate, with_line, with_record
from eventloom.operators.decode import decode_edge_log
from eventloom.operators.project import cast_to_schema, typed_from_cells
from eventloom.operators.schemas import MAPPINGS, compile_schemas
from tests.conftest import encode, record


def columns(*rows):
    return [dict(zip(("InboundName", "OutboundName", "Transformer", "SupportingColumns"), r)) for r in rows]


MOORED = compile_schemas([{"EventName": "moored", "Version": 6, "Columns": columns(
    ("owner", "owner", "userIDWithMapping", "ship"), ("ship", "ship", "varchar"), ("draught", "draught", "float"),
    ("user_agent", "probe", "varchar"), ("berth", "berth", "int"), ("seen", "seen", "f@timestamp@unix-utc"))}])
GOOD = {"berth": 9, "draught": 3.125, "ship": "Vega", "seen": 1600000000, "owner": 77}
SEEN = "2020-09-13 12:26:40"


@pytest.fixture(scope="module")
def logins(spark):
    return spark.createDataFrame([("Vega", 77), ("Rigel", 78), ("Ghost", None)], "login string, user_id bigint")


def one(lines, logins, properties, event="moored", agent="Buoy/2", schemas=MOORED, **options):
    body = json.dumps({"event": event, "properties": properties}, ensure_ascii=False)
    rows = collate(decode_edge_log(lines(record(encode(body), userAgent=agent))), schemas, logins=logins, **options)
    return with_line(with_record(rows)).first()


def without(*names, **changes):
    return {k: v for k, v in {**GOOD, **changes}.items() if k not in names}


@pytest.mark.parametrize("limit", [600, 0])
@pytest.mark.parametrize("properties,agent,status,values", [
    (GOOD, "Buoy/2", 0, ["77", "Vega", "3.125", "Buoy/2", "9", SEEN]),
    (without(owner=None), "Buoy/2", 0, ["77", "Vega", "3.125", "Buoy/2", "9", SEEN]),
    (without("owner", ship="Ghost"), "Buoy/2", 0, ["", "Ghost", "3.125", "Buoy/2", "9", SEEN]),
    (without(berth="B9", draught="deep"), "Buoy/2", 6, ["77", "Vega", "", "Buoy/2", "", SEEN]),
    (without("seen", berth=None), "", 6, ["77", "Vega", "3.125", "", "", ""]),
    (without("ship", "owner"), "", 6, ["", "", "3.125", "", "9", SEEN]),
])
def test_rows(lines, logins, properties, agent, status, values, limit):
    row = one(lines, logins, properties, agent=agent, max_compiled_columns=limit)
    assert row.status == status and row.category == "moored" and row.version == 6
    assert row.line == "\t".join(f'"{v}"' for v in values)
    assert row.record == {k: v for k, v in zip(MOORED["moored"].names, values) if v}


@pytest.mark.parametrize("owner,ship,text,outcome", [
    (5, "x", "5", "id_set"), ("7", "x", "7", "id_set"), ("", "Rigel", "78", "hit"), ("", "\u2003Rigel\t", "78", "hit"),
    ("", "Ghost", "", "hit"), ("", "\r\n", None, "empty_lookup_value"), ("", False, None, "bad_lookup_value"),
    ("", "rigel", None, "fetch_failure"), (2.75, "Vega", "77", "hit"),
])
@pytest.mark.parametrize("broadcast", [True, False])
def test_mapping(lines, logins, owner, ship, text, outcome, broadcast):
    row = one(lines, logins, without(owner=owner, ship=ship), **({} if broadcast else {"broadcast_limit": 0}))
    assert row.cells[0] == text and row.lookups == [outcome]


@pytest.mark.parametrize("body,status,category,uuid", [
    ('{"event":"adrift","properties":{"z":null,"y":{"x":[]}}}', 2, "adrift", "rec-a"),
    ('{"event":"adrift"}', 2, "adrift", "rec-a"),
    ('{"event":"","properties":{"a":1}}', 5, "Unknown", "rec-a"),
    ('{"event":"moored"}', 5, "Unknown", "rec-a"),
    ('{"event":"moored","properties":[]}', 5, "Unknown", "rec-a"),
    ('{"event":"moored","properties":7}', 5, "Unknown", "rec-a"),
    ('{"event":"moored","properties":null}', 8, "Unknown", "error"),
    ("{moored}", 1, "Unknown", "rec-a"),
])
def test_other_statuses(lines, logins, body, status, category, uuid):
    row = with_line(collate(decode_edge_log(lines(record(encode(body)))), MOORED, logins=logins)).first()
    assert (row.status, row.category, row.uuid) == (status, category, uuid)
    assert row.cells is None
    if status == 2:
        assert json.loads(row.line)["event"] == "adrift"
    else:
        assert row.line == ""


def test_server_times_take_the_place_of_client_times(lines):
    table = compile_schemas([{"EventName": "moored", "Version": 6, "Columns": columns(
        ("time", "at", "f@timestamp@unix"), ("client_time", "told", "f@timestamp@unix-utc"), ("tide", "tide", "float"), ("tag", "tag", "varchar"))}])
    run = lambda properties: with_line(collate(decode_edge_log(lines(record(encode(
        json.dumps({"event": "moored", "properties": properties}))))), table)).first()
    assert run({"tag": "Kiel-07/β", "tide": 0.30000000000000004, "time": 1600000000}).line == (
        f'"2021-03-03 21:06:07"\t"{SEEN}"\t"0.30000000000000004"\t"Kiel-07/β"')
    empty = run({})
    assert empty.status == 6 and empty.line == '"2021-03-03 21:06:07"\t""\t""\t""'


def test_repeated_outbound_name_and_duplicate_keys(lines):
    table = compile_schemas([{"EventName": "t", "Version": 1, "Columns": columns(
        ("a", "x", "varchar"), ("b", "y", "varchar"), ("c", "x", "varchar"))}])
    def run(properties):
        body = '{"event":"t","properties":' + properties + "}"
        return with_line(with_record(collate(decode_edge_log(lines(record(encode(body)))), table))).first()
    assert run('{"a":"1","b":"2","c":"3"}').record == {"x": "3", "y": "2"}
    assert run('{"a":"1","c":""}').record == {"x": "1"}
    assert run('{"a":"1","a":"9","n":{"k":1,"k":2}}').record == {"x": "9"}
    events = decode_edge_log(lines(record(encode('{"event":"t","properties":{"a":"1","c":"3"}}'))))
    typed = cast_to_schema(events, table["t"])
    assert typed.columns == ["x", "y", "x_2"] and tuple(typed.first()) == ("1", None, "3")
    assert tuple(typed_from_cells(collate(events, table), table["t"]).first()) == ("1", None, "3")


def test_awkward_property_names(lines):
    names = ["$r", "h-c", "a.b", "it's", "what?", "q\"'?", "[0]"]
    table = compile_schemas([{"EventName": "t", "Version": 1, "Columns": columns(*[(n, n, "int") for n in names])}])
    body = json.dumps({"event": "t", "properties": {n: i for i, n in enumerate(names)}})
    for limit in (600, 0):
        row = collate(decode_edge_log(lines(record(encode(body)))), table, max_compiled_columns=limit).first()
        assert row.cells == [str(i) for i in range(len(names))]


def test_reports(lines, logins):
    bodies = [json.dumps({"event": "moored", "properties": p}) for p in (GOOD, without(berth="x"), without(owner=None))]
    rows = collate(decode_edge_log(lines(
        *[record(encode(b), userAgent="a") for b in bodies], record(encode(bodies[0]), edgeType="external", userAgent="a"),
        record("junk"))), MOORED, logins=logins)
    count = lambda df: {tuple(r)[:-1]: r[-1] for r in df.collect()}
    assert count(reports.status_counts(rows)) == {("Success",): 3, ("Missing One or More Columns",): 1, ("Malformed Data",): 1}
    assert count(reports.column_outcomes(rows)) == {
        ("moored", "success"): 23, ("moored", "skippedColumn"): 1, ("moored", "cache.id_set"): 3, ("moored", "cache.hit"): 1}
    assert count(reports.edge_type_counts(rows)) == {("moored", "internal"): 3, ("moored", "external"): 1}
    metadata = rows.sparkSession.createDataFrame(
        [("moored", "edge_type", "internal"), ("moored", "comment", "x")], "event string, metadata_type string, metadata_value string")
    assert count(reports.edge_type_mismatch(rows, metadata)) == {("moored", "external", "internal"): 1}
    assert {r.category: (r.success, r.fail) for r in reports.event_success_fail(rows).collect()} == {
        "moored": (4, 0), "Unknown": (0, 1)}


def test_projection_is_not_repeated_by_filters(lines, logins):
    rows = with_record(collate(decode_edge_log(lines(record("x"))), MOORED, logins=logins))
    plan = rows.where("status = 0").where(F.col("record")["name"] == "a")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 1


def test_plan_does_not_grow_with_tables(lines, spark):
    def run(tables):
        schemas = compile_schemas([
            {"EventName": f"e{i}", "Version": i, "Columns": columns(*[(f"p{j}", f"c{i}_{j}", t) for j, t in enumerate(
                ["int", "bigint", "float", "varchar", "bool"] * 4)])} for i in range(tables)])
        bodies = [json.dumps({"event": f"e{i}", "properties": {"p0": i, "p3": "x", "p4": True}}) for i in range(0, tables, 7)]
        return collate(decode_edge_log(lines(*[record(encode(b)) for b in bodies])), schemas)

    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    few, many = run(40), run(400)
    assert size(many) < 1.5 * size(few)
    got = with_record(many).collect()
    assert len(got) == 58 and all(r.version == int(r.event[1:]) for r in got)
    assert all(r.record == {f"c{r.version}_0": str(r.version), f"c{r.version}_3": "x", f"c{r.version}_4": "true"} for r in got)


def test_second_mapping(spark, lines, logins, monkeypatch):
    """A mapping registered with its own dimension looks up that one, not the logins."""
    monkeypatch.setitem(MAPPINGS, "clubMapping", "clubs")
    schemas = compile_schemas([{"EventName": "join", "Version": 1, "Columns": columns(
        ("id", "id", "userIDWithMapping", "name"), ("club", "club", "clubMapping", "name"), ("other", "other", "clubMapping", "team"))}])
    clubs = spark.createDataFrame([("Vega", 7000), ("north", 7001)], "login string, user_id bigint")
    row = one(lines, logins, {"name": "Vega", "team": "north"}, "join", schemas=schemas, dimensions={"clubs": clubs})
    assert row.cells == ["77", "7000", "7001"] and row.lookups == ["hit"] * 3
    missing = one(lines, logins, {"name": "Vega", "team": "north"}, "join", schemas=schemas)
    assert missing.cells == ["77", None, None]
