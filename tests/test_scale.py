"""What must not grow with the input: rows of a task, scans of a query, calls per key."""

import pytest
from pyspark.sql import functions as F

from eventloom import session
from eventloom.operators.decode import decode_edge_log
from eventloom.operators.project import cast_to_layout, cast_to_schema
from eventloom.operators.schemas import compile_schemas
from eventloom.operators.streams import wrap_records
from tests.conftest import encode, record


def test_rows_of_a_row_group_are_spread_over_tasks(spark, tmp_path):
    """A few compressed bytes with many rows: more tasks, no row lost."""
    n = 12 * session.ROWS_PER_TASK
    spark.range(n).coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = session.spread(spark.read.parquet(str(tmp_path / "t")))
    counts = [r[0] for r in rows.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(counts) == n and max(counts) <= 1.1 * session.ROWS_PER_TASK
    few = spark.range(10).repartition(20)
    assert session.spread(few).rdd.getNumPartitions() == 20


COLUMNS = [{"InboundName": a, "OutboundName": b, "Transformer": t} for a, b, t in (
    ("n", "n", "int"), ("n", "n", "varchar"), ("time", "at", "f@timestamp@unix-utc"), ("d", "d", "f@timestamp@3:04PM"))]


def test_tables_of_one_layout_in_one_pass(lines):
    schemas = compile_schemas([{"EventName": e, "Version": 1, "Columns": COLUMNS} for e in ("a", "b")])
    bodies = ['{"event":"%s","properties":{"n":%s,"d":"%s"}}' % b for b in (
        ("a", "1", "1:02PM"), ("b", '"7"', "1:02AM"), ("b", "null", "1:02pm"), ("c", "3", "1:02PM"))]
    events = decode_edge_log(lines(*[record(encode(b)) for b in [*bodies, '{"event":"a","properties":[]}']]))
    shown = lambda df: df.withColumn("d", F.col("d").cast("string"))  # noqa: E731 - of year 0
    out = shown(cast_to_layout(events, schemas, keep=("event",)))
    apart = [(name, *r) for name, s in schemas.items() for r in shown(cast_to_schema(events, s)).collect()]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(apart, key=str) and len(apart) == 3
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Generate posexplode") == 1
    schemas["b"] = compile_schemas([{"EventName": "b", "Version": 1, "Columns": COLUMNS[:1]}])["b"]
    with pytest.raises(ValueError):
        cast_to_layout(events, schemas)


def test_envelopes_of_all_kinds_in_one_pass(spark):
    rows = spark.createDataFrame([({"b": "x\x00", "a": ""},), ({"a": "1"},)], "fields map<string,string>")
    kinds, stamp = ("stream", "delivery", "warehouse"), F.lit("2024-01-01 00:00:00.100")
    every = wrap_records(rows, kinds, "fields", record_id=F.lit("id"), created_at=stamp)
    apart = [tuple(r) for k in kinds for r in wrap_records(rows, k, "fields", record_id=F.lit("id"), created_at=stamp).collect()]
    assert sorted(map(tuple, every.collect())) == sorted(apart)
    own = [r.partition_key for r in wrap_records(rows, kinds, "fields").collect()]
    assert len(set(own)) == 6
    with pytest.raises(ValueError):
        wrap_records(rows, ("stream", "letter"), "fields")
