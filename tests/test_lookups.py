"""Lookups against brute force, in broadcast and in shuffled form, hot keys included."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators.lookups import (
    bucket_shift, ip_number, left_lookup, measured_bytes, prepare_keys, prepare_ranges, range_lookup,
)
from eventloom.sources.lookup_tables import build_login_dim, overlapping_blocks


@pytest.fixture(scope="module")
def blocks():
    rng = random.Random(7)
    cuts = sorted(rng.sample(range(0, 2**32), 400))
    # Disjoint blocks of very different widths, with gaps.
    return [(a, b - 1 - (b - a) // 3, f"c{i}") for i, (a, b) in enumerate(zip(cuts[::2], cuts[1::2]))]


@pytest.fixture(scope="module")
def addresses(blocks):
    rng = random.Random(8)
    edges = [x for a, b, _ in blocks for x in (a, b, a - 1, b + 1) if 0 <= x < 2**32]
    rows = [rng.randrange(2**32) for _ in range(500)] + edges
    dotted = [".".join(str(n >> s & 255) for s in (24, 16, 8, 0)) for n in rows]
    # A third of all rows carries one address; some have none that can be read.
    return dotted + [dotted[0]] * (len(dotted) // 2) + ["", "x", "1.2.3", "256.1.1.1", "::1", None] * 5


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_range_lookup(spark, blocks, addresses, limit):
    table = spark.createDataFrame(blocks, "start_ip long, end_ip long, city string")
    rows = spark.createDataFrame(list(enumerate(addresses)), "id long, ip string")
    out = range_lookup(rows, prepare_ranges(table, ["city"], broadcast_limit=limit), {"geo": F.col("ip")}, F.xxhash64("id"))
    starts = [b[0] for b in blocks]

    def want(ip):
        parts = (ip or "").split(".")
        if len(parts) != 4 or any(not p.isdigit() or int(p) > 255 for p in parts):
            return None
        n = sum(int(p) << s for p, s in zip(parts, (24, 16, 8, 0)))
        i = bisect.bisect_right(starts, n) - 1
        return blocks[i][2] if i >= 0 and n <= blocks[i][1] else None

    got = {r.id: r.geo and r.geo.city for r in out.collect()}
    assert out.count() == len(addresses)
    assert got == {i: want(ip) for i, ip in enumerate(addresses)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert ("BroadcastHashJoin" in plan) == (limit > 0)


def test_bucket_shift_follows_block_size(spark):
    narrow = spark.range(200_000).select((F.col("id") * 256).alias("start_ip"), (F.col("id") * 256 + 255).alias("end_ip"))
    wide = spark.createDataFrame([(0, 2**32 - 1)], "start_ip long, end_ip long")
    assert bucket_shift(narrow) <= 8 and bucket_shift(wide) >= 14


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_left_lookup_keeps_every_row(spark, limit):
    rows = spark.range(3000).select("id", F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN concat('k', id) END AS k"))
    table = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("v")).union(
        spark.createDataFrame([("hot", -1)], "key string, v long"))
    out = left_lookup(rows, prepare_keys(table, "key", ["v"], broadcast_limit=limit), {"a": F.col("k")}, F.xxhash64("id"))
    got = {r.id: r.a and r.a.v for r in out.collect()}
    assert got == {i: -1 if i % 3 == 0 else i if i % 3 == 1 and i < 2000 else None for i in range(3000)}
    assert out.count() == 3000


def test_measured_bytes_counts_rows_and_text(spark):
    assert measured_bytes(spark.createDataFrame([("ab", 1), (None, 23)], "a string, b int")) == 64 * 2 + 2 + 1 + 2


def test_ip_number(spark):
    rows = spark.createDataFrame([("10.20.30.40",), ("0.0.0.0",), ("255.255.255.255",), ("1.2.3.4.5",)], "ip string")
    assert [r[0] for r in rows.select(ip_number(F.col("ip"))).collect()] == [10 * 2**24 + 20 * 2**16 + 30 * 2**8 + 40, 0, 2**32 - 1, None]


def test_overlaps(spark):
    ok = [(0, 5), (6, 10), (1 << 24, (3 << 24) + 5), ((3 << 24) + 6, (3 << 24) + 9)]
    make = lambda rows: spark.createDataFrame(rows, "start_ip long, end_ip long")
    assert overlapping_blocks(make(ok)).count() == 0
    assert overlapping_blocks(make(ok + [((2 << 24), (2 << 24) + 1)])).count() == 1
    assert overlapping_blocks(make(ok + [(10, 12)])).count() == 1


def test_login_dimension(spark):
    bodies = [("cado", '{"results": [{"id": 96046250,"login": "cado"}]}'), ("none", '{"results": []}'), ("bad", "{"),
              ("text", '{"results":[{"id":"7"}]}')]
    out = build_login_dim(spark.createDataFrame(bodies, "login string, body string"))
    assert {r.login: r.user_id for r in out.collect()} == {"cado": 96046250, "none": None, "text": None}
