"""Exact batches against the sequential rule."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.operators import batches


def rule(sizes, size, entries):
    """Batch numbers of one stream, entry by entry."""
    out, left, count, batch = [], 0, 0, 0
    for own in sizes:
        if count and (count == entries or left + own > size):
            left, count, batch = 0, 0, batch + 1
        left, count = left + own, count + 1
        out.append(batch)
    return out


@pytest.mark.parametrize("size,entries", [(100, 7), (100, -1), (1000, 3), (1, 5), (40, 1), (10_000, -1)])
def test_composed_tables_equal_the_rule(size, entries):
    """Any cut of the stream into slices, composed in any grouping, gives the state the rule has there."""
    rng, most = random.Random(size + entries), batches._most(entries)
    for _ in range(40):
        sizes = [rng.choice([0, 1, 5, 30, 99, 100, 101, 250]) for _ in range(rng.randint(1, 60))]
        cuts = sorted(rng.sample(range(1, len(sizes)), min(rng.randint(0, 8), len(sizes) - 1)))
        slices = [np.array(sizes[a:b], np.int64) for a, b in zip([0, *cuts], [*cuts, len(sizes)])]
        tables = [batches._of_sizes(s, size, most) for s in slices]
        middle = rng.randint(1, len(tables))
        both = [batches._composed(part, size, most) for part in (tables[:middle], tables[middle:]) if part]
        state = (np.array([0]), np.array([0]), np.array([0]))
        end = batches._composed(both, size, most).after(*state, size, most)
        numbers = rule(sizes, size, entries)
        last = [s for s, b in zip(sizes, numbers) if b == numbers[-1]]
        assert [int(v[0]) for v in end] == [sum(last), len(last), numbers[-1]]


@pytest.mark.parametrize("fan", [64, 2])
def test_batches_equal_the_rule(spark, monkeypatch, fan):
    """Several streams, one with a third of all rows, limits of their own, oversized and empty entries."""
    monkeypatch.setattr(batches, "FAN", fan)
    rng, rows = random.Random(fan), []
    limits = {"a": (120, 5), "b": (500, -1), None: (60, 50), "one": (10, 2)}
    for k in range(900):
        stream = "a" if rng.random() < 0.4 else rng.choice(["b", None, "a"])
        rows.append((k, stream, rng.choice([None, 0, 3, 20, 60, 61, 130, 700])))
    rows.append((900, "one", 99))
    frame = spark.createDataFrame(
        [(k, s, n, *limits[s], "x") for k, s, n in random.Random(1).sample(rows, len(rows))],
        "id long, stream string, n int, size int, entries int, rank string").repartition(5)
    out = batches.exact_batches(frame, "stream", ["id"], F.expr("id div 37"), F.col("n"), F.col("size"), F.col("entries")).collect()
    assert len(out) == len(rows) and out[0].rank == "x"
    for stream, (size, entries) in limits.items():
        own = sorted((r.id, r.batch_no) for r in out if r.stream == stream)
        assert [b for _, b in own] == rule([n or 0 for _, s, n in rows if s == stream], size, entries)


def test_empty(spark):
    frame = spark.createDataFrame([], "id long, stream string, n int")
    out = batches.exact_batches(frame, "stream", ["id"], F.expr("id div 10"), F.col("n"), F.lit(5), F.lit(5))
    assert out.count() == 0 and "batch_no" in out.columns
