"""Exact percentiles against sorted values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import ranks

SHARES = {"p0": 0.0, "p50": 0.5, "p99": 0.99, "p100": 1.0}


@pytest.mark.parametrize("few", [100_000, 0])
def test_percentiles_equal_sorted_ranks(spark, monkeypatch, few):
    """Narrow, wide and single-valued keys, the whole 64-bit range, a key with most rows, nulls."""
    monkeypatch.setattr(ranks, "BROADCAST_KEYS", few)
    rng = random.Random(3)
    values = {"a": [rng.randint(0, 50) for _ in range(900)], "b": [rng.randint(-10**12, 10**12) for _ in range(300)],
              None: [7] * 40, "edge": [-2**63, 2**63 - 1, 0], "one": [5]}
    rows = [(k, v) for k, own in values.items() for v in own] + [("a", None), ("none", None)]
    frame = spark.createDataFrame(rng.sample(rows, len(rows)), "key string, v long").repartition(4)
    found = {r.key: r for r in ranks.exact_percentiles(frame, ["key"], F.col("v"), SHARES).collect()}
    assert found.keys() == values.keys()
    for key, own in values.items():
        for name, share in SHARES.items():
            assert found[key][name] == sorted(own)[max(math.ceil(len(own) * share), 1) - 1]


def test_without_keys_and_rows(spark):
    frame = spark.createDataFrame([(k,) for k in range(101)], "v long")
    assert [tuple(r) for r in ranks.exact_percentiles(frame, [], F.col("v"), {"p50": 0.5}).collect()] == [(50,)]
    assert ranks.exact_percentiles(frame.where("v < 0"), [], F.col("v"), {"p50": 0.5}).count() == 0
