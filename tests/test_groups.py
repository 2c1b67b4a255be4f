"""Groups that close by size, count or age, with the watermark as a clock the test moves."""

import json
import random
import zlib
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from eventloom.operators import fanout
from eventloom.operators.streams import StreamConfig
from eventloom.streaming.groups import age_millis, grouped_by_age, packed_group, with_limits

START = datetime(2024, 1, 1)
SHAPE = "stream string, arrival timestamp, entry string, max_size long, max_entries long, max_age long"
LIMITS = {"small": (40, -1, 60_000), "few": (10_000, 3, 3_600_000), "old": (10_000, -1, 5_000)}


def tick(spark, folder, rows, lanes=1):
    """One run over new entries (stream, second, text): the groups it closes."""
    frame = spark.createDataFrame([(s, START + timedelta(seconds=t), e, *LIMITS[s]) for s, t, e in rows], SHAPE)
    frame.write.mode("append").parquet(f"{folder}/in")
    closed = grouped_by_age(spark.readStream.schema(SHAPE).parquet(f"{folder}/in"), lanes=lanes, by_event=True)
    found = []
    writer = closed.writeStream.foreachBatch(lambda df, i: found.extend(df.collect()))
    writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return [(r.stream, [v.strip() for v in r.value], r.closed_by) for r in sorted(found, key=lambda r: (r.stream, r["first"], r.value))]


def test_groups_close_by_size_count_or_age(spark, tmp_path):
    wide = "w" * 30
    assert tick(spark, tmp_path, [("small", 0, "a" + wide), ("small", 1, "b" + wide), ("few", 2, "x"), ("old", 2, "p")]) == [
        ("small", ["a" + wide], "size")]
    # The clock moves on by entries of another stream: "old" has waited its five seconds.
    assert tick(spark, tmp_path, [("few", 10, "y")]) == [("old", ["p"], "age")]
    # Found again after a restart, the open groups go on; an oversized entry goes alone.
    assert tick(spark, tmp_path, [("few", 11, "z"), ("few", 12, "u"), ("old", 13, "q"), ("old", 19, "r"), ("small", 20, "h" * 99), ("small", 21, "i")]) == [
        ("few", ["x", "y", "z"], "size"), ("old", ["q"], "age"), ("small", ["b" + wide], "size"), ("small", ["h" * 99], "size")]
    # A long silence, then an hour passes.
    assert tick(spark, tmp_path, [("old", 4000, "s")]) == [
        ("few", ["u"], "age"), ("old", ["r"], "age"), ("small", ["i"], "age")]


def test_lanes_share_a_hot_stream(spark, tmp_path):
    rng = random.Random(2)
    rows = [("few", t, f"e{t}-{rng.random()}") for t in range(200)]
    groups = tick(spark, tmp_path, rows, lanes=4) + tick(spark, tmp_path, [("old", 9000, "end")], lanes=4)
    sent = [e for s, value, _ in groups if s == "few" for e in value]
    assert sorted(sent) == sorted(e for _, _, e in rows)
    assert max(len(value) for _, value, _ in groups) == 3 and sum(by == "age" for s, _, by in groups if s == "few") <= 4


def test_limits_of_configured_streams(spark):
    ages = spark.createDataFrame([(t,) for t in ("1s", "1m30s", "250ms", "1.5h", "soon", "", None)], "t string")
    assert [r[0] for r in ages.select(age_millis(F.col("t"))).collect()] == [1000, 90_000, 250, 5_400_000, None, None, None]
    sinks = fanout.settings_of(spark, [StreamConfig("a", batch_size=7, batch_entries=2, glob_size=9)])
    entries = spark.createDataFrame([("a", START, "x"), ("b", START, "y")], "stream string, arrival timestamp, entry string")
    limits = lambda section: [tuple(r)[3:] for r in with_limits(entries, sinks, section).collect()]
    assert limits("Batcher") == [(7, 2, 1000)] and limits("Globber") == [(9, -1, 1000)]
    glob = spark.createDataFrame([(['{"a":1}', '"b"'],)], "value array<string>").select(packed_group(F.col("value"))).first()[0]
    assert json.loads(zlib.decompress(bytes(glob)[1:], -15)) == [{"a": 1}, "b"]
