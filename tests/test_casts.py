"""Accept and reject tables of every converter."""

import pytest
from pyspark.sql import functions as F

from eventloom.functions import layouts, text
from eventloom.operators.schemas import compile_schemas, conversion_of

# The bounds are those of the types and of the accepted times; every other value was made up here.
INT = [("0", "0"), ("-3", "-3"), ('"88"', "88"), ("2147483647", "2147483647"), ('"-2147483648"', "-2147483648"), ("2147483648", None),
       ('"-2147483649"', None), ("6.75", None), ("7.0", None), ("5e2", None), ('"+31"', "31"), ('"007"', "7"), ('" 8"', None),
       ('"seven"', None), ('"7up"', None), ('"1_000"', None), ('""', None), ("true", None), ("null", None), ("[1]", None)]
BIGINT = [("31", "31"), ("2147483648", "2147483648"), ('"-60000000017"', "-60000000017"), ("9223372036854775807", "9223372036854775807"),
          ('"-9223372036854775808"', "-9223372036854775808"), ('"9223372036854775808"', None), ("98765432109876543210", None),
          ("8.5", None), ('"8."', None), ("false", None), ("null", None)]
FLOAT = [("2.5", "2.5"), ("640.0", "640"), ("640", "640"), ("-0.75", "-0.75"), ('"33.50"', "33.5"), ('"-.5"', "-0.5"), ("6e400", None),
         ('"-6e400"', None), ("7e-330", "0"), ('"-7e-330"', "0"), ('"9.' + "0" * 70 + '4"', "9"), ('"nAn"', ""), ('"+inf"', "+Inf"),
         ('"-infinity"', "-Inf"), ('"0b11"', None), ('"2f"', None), ("false", None), ("null", None), ("0.30000000000000004", "0.30000000000000004"),
         ("3e22", "3" + "0" * 22), ("2.25e-6", "0.00000225"), ("7e24", "7" + "0" * 24), ("90071992.5", "90071992.5")]
VARCHAR = [('"oak"', "oak"), ('"a\\r\\tb"', "a\r\tb"), ('"\\u00e9"', "é"), ('" "', " "), ('""', ""), ("3", None), ("2.50", None), ("false", None),
           ("null", None), ("[]", None), ('{"k":"v"}', None)]
BOOL = [("true", "true"), ("false", "false"), ("1", "true"), ("0", "false"), ("-1", None), ("3", None), ("0.0", None), ('"false"', None),
        ('"yes"', None), ('"0"', None), ("null", None)]
UNIX = [("1646092800.25", "2022-02-28 16:00:00.25"), ("1646092800", "2022-02-28 16:00:00"), ("1646092800.1", "2022-02-28 16:00:00.099"),
        ("1667721600", "2022-11-06 01:00:00"), ("1667725200", "2022-11-06 01:00:00"), ("1667728800", "2022-11-06 02:00:00"),
        ("164609280", None), ("999999999.5", None), ("13140000001", None), ('"soon"', None), ('"1646092800"', None), ("true", None)]
UTC = [("1646092800.25", "2022-03-01 00:00:00.25"), ("1646092800", "2022-03-01 00:00:00"), ("1000000000", "2001-09-09 01:46:40"),
       ("99999999", None), ('"later"', None)]
LAYOUT = [('"2020-02-29 23:59:58"', "2020-02-29 23:59:58"), ('"2021-02-29 23:59:58"', None), ('"2020-02-29 2359:58"', None),
          ('"2020-02-29T23:59:58Z"', None), ('"2020-02-29 23:59:58.0519"', "2020-02-29 23:59:58.051"), ("20200229", None), ('""', None)]
TABLE = {"int": INT, "bigint": BIGINT, "float": FLOAT, "varchar": VARCHAR, "bool": BOOL, "f@timestamp@unix": UNIX,
         "f@timestamp@unix-utc": UTC, "f@timestamp@2006-01-02 15:04:05": LAYOUT}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("name", TABLE)
def test_converter(spark, name, zone):
    conversion = conversion_of(name)
    rows = spark.createDataFrame([(j,) for j, _ in TABLE[name]], "j string")
    rows = rows.select("j", F.try_parse_json("j").alias("v"))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {r[0]: r[1] for r in rows.select("j", conversion.cell(F.col("v"), F.schema_of_variant("v"))).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == dict(TABLE[name])


@pytest.mark.parametrize("layout,value,want", [
    ("2006-01-02T15:04:05Z07:00", "2020-02-29T08:00:01+05:30", "2020-02-29 08:00:01"),
    ("Jan 2, 2006 at 3:04pm (MST)", "Dec 31, 2019 at 11:08am (CET)", "2019-12-31 11:08:00"),
    ("Monday, January 2 2006 03:04PM", "Tuesday, June 30 2015 12:45AM", "2015-06-30 00:45:00"),
    ("02/01/06", "09/05/21", "2021-05-09 00:00:00"),
    ("02/01/06", "09/05/72", "1972-05-09 00:00:00"),
    ("2006-01-02 15:04:05.000", "2020-02-29 08:00:01.370", "2020-02-29 08:00:01.37"),
    ("2006-01-02 15:04:05.000", "2020-02-29 08:00:01.37", None),
    ("2006-01-02 3:04PM", "2020-02-29 14:04PM", None),
])
def test_layouts(spark, layout, value, want):
    assert spark.range(1).select(layouts.parse(F.lit(value), layout).cast("string")).first()[0] == want


def test_quoted_fields_roundtrip(spark):
    texts = ["plain", "ta\tb", 'q"x\\', "\x00\x07\x0b\x7f", "é 😀", "​ ﻿", "\\n\\\\t\n", "", "\\", '"', "\\x41 \x01"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.quote_field(F.col("t")).alias("q"))
    got = rows.select("t", "q", text.unquote_field(F.col("q")).alias("back")).collect()
    assert all(r.t == r.back and "\t" not in r.q and "\n" not in r.q for r in got)
    assert {r.t: r.q for r in got}["\x00\x07\x0b\x7f"] == '"\\x00\\a\\v\\x7f"'
    assert {r.t: r.q for r in got}["​ ﻿"] == '"\\u200b\\u00a0\\ufeff"'


def test_unknown_transformer_leaves_the_table_out():
    column = lambda t: {"InboundName": "a", "OutboundName": "a", "Transformer": t}
    compiled = compile_schemas([
        {"EventName": "good", "Version": 1, "Columns": [column("int")]},
        {"EventName": "bad", "Version": 1, "Columns": [column("int"), column("nope")]},
        {"EventName": "layoutless", "Version": 1, "Columns": [column("f@timestamp")]},
        {"EventName": "good", "Version": 2, "Columns": [column("bigint")]},
    ])
    assert list(compiled) == ["good"] and compiled["good"].version == 2
