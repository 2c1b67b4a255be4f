"""Vector codes against plain Lloyd rounds in whole numbers."""

import random
from pathlib import Path

import duckdb
import numpy as np
import pytest

from eventloom.llm import vector_codes
from eventloom.llm.queries import ORACLES, QUERIES

SCHEMA = "extra int, vec_id long, embedding array<float>, label int, code string, error int"


def lloyd(rows):
    """(codes with errors, codebooks) of rows (id, vector, label) of one length, in id order."""
    whole = [[int(np.floor(np.float32(x).astype(float) * 1024)) for x in r[1]] for r in rows]
    step = len(whole[0]) // 4
    parts = [[v[p * step : (p + 1) * step] for v in whole] for p in range(4)]
    books = [[list(v) for v in part[:256]] for part in parts]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, entry)), e) for e, entry in enumerate(book))

    for _ in range(4):
        for part, book in zip(parts, books):
            own = [nearest(v, book)[1] for v in part]
            for e in set(own):
                members = [v for v, o in zip(part, own) if o == e]
                book[e] = [sum(c) // len(members) for c in zip(*members)]
    found = [[nearest(part[k], book) for part, book in zip(parts, books)] for k in range(len(rows))]
    return [("".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f)) for f in found], books


def table(spark, rows):
    return spark.createDataFrame([(1, i, v, k, "x", 2) for i, v, k in rows], SCHEMA)


def clustered(n, width, seed):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 1, (6, width))
    return [(i, [float(x) for x in (centers[rng.integers(6)] + rng.normal(0, 0.2, width)).astype(np.float32)], int(rng.integers(3)))
            for i in range(n)]


@pytest.mark.parametrize("n, width, repeats", [(700, 8, 0), (300, 16, 200), (40, 4, 0)])
def test_codes_equal_plain_rounds(spark, n, width, repeats):
    """Clusters, one vector in a third of all rows, and fewer rows than entries."""
    rows = clustered(n, width, n)
    rows += [(n + k, rows[0][1], None) for k in range(repeats)]
    wanted, books = lloyd(rows)
    found, got = vector_codes.compressed(table(spark, random.Random(1).sample(rows, len(rows))).repartition(5))
    found = {r.vec_id: (r.code.hex(), r.error) for r in found.collect()}
    assert [found[i] for i, _, _ in rows] == wanted
    assert got.tolist() == books


def test_every_point_is_covered_once_and_whole_subtrees_are_assigned():
    rng = np.random.default_rng(3)
    centers = rng.integers(-900, 900, (40, 5))
    rows = (centers[rng.integers(0, 40, 3000)] + rng.integers(-4, 5, (3000, 5))).astype(np.int64)
    tree = vector_codes.cover_tree(rows)
    assert (tree["points"][tree["place"]] == rows).all() and tree["counts"].sum() == 3000
    for k in np.flatnonzero(tree["children"]):
        below = range(tree["first"][k], tree["first"][k] + tree["children"][k])
        assert [tree["lo"][k], *(tree["hi"][c] for c in below)] == [*(tree["lo"][c] for c in below), tree["hi"][k]]
        assert all(tree["radius"][c] <= tree["radius"][k] / vector_codes.BASE + 1e-9 for c in below)
    lo, hi, entry = vector_codes.assigned(tree, centers)
    spots = vector_codes._ranges(lo, hi - lo)
    assert sorted(spots.tolist()) == list(range(len(tree["points"])))
    nearest = vector_codes.squares(tree["points"].astype(np.int64), centers).argmin(1)
    assert (nearest[spots] == np.repeat(entry, hi - lo)).all()
    assert len(lo) < len(tree["points"]) / 3  # most points are assigned with their subtree


def test_odd_rows(spark):
    """Unsound vectors go; short ones are filled up; huge ones count as the bound; ids may be null or repeat."""
    rows = [(1, [1.0, 2.0, 3.0, 4.0], 1), (2, None, 1), (3, [1.0, None, 3.0, 4.0], 1), (4, [float("nan")] * 4, 1),
            (5, [float("inf"), 0.0, 0.0, 0.0], 1), (6, [], 2), (7, [1.0], None), (None, [2.0, 2.0, 2.0, 2.0], None),
            (8, [3e38, -3e38, 0.0, 0.0], 3), (9, [1.0] * 5, 3), (9, [1.0] * 5, 3)]
    found, books = vector_codes.compressed(table(spark, rows))
    assert sorted((r.vec_id or 0) for r in found.collect()) == [0, 1, 6, 7, 8, 9, 9]
    assert books.shape == (4, 7, 2) and np.abs(books).max() == vector_codes.LARGEST
    assert all(r.error == 0 for r in found.collect())
    empty, books = vector_codes.compressed(table(spark, []))
    assert empty.count() == 0 and books.shape[1] == 0


def test_large_components_are_exact():
    rng = np.random.default_rng(4)
    points, book = rng.integers(-(1 << 24), 1 << 24, (50, 3)), rng.integers(-(1 << 24), 1 << 24, (20, 3))
    wanted = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e)) for e in book] for p in points]
    assert vector_codes.squares(points, book).tolist() == wanted


def test_hot_labels_are_looked_up_alike(spark, monkeypatch):
    """One label on a third of all rows, null labels, and many labels of one row."""
    from eventloom.llm import common

    rows = spark.createDataFrame([(k, "hot" if k % 3 == 0 else f"l{k}") for k in range(6000)], "id long, key string")
    counted = rows.groupBy("key").count().withColumnRenamed("count", "times").withColumn("n", common.F.col("times"))
    plain = sorted(map(tuple, common.looked_up(rows, counted, ["key"]).collect()))
    monkeypatch.setattr(common, "SMALL_TABLE", 10)
    assert sorted(map(tuple, common.looked_up(rows, counted, ["key"]).collect())) == plain
    assert len(plain) == 6000 and plain[0] == ("hot", 0, 2000)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("driver tables not here")
    db = duckdb.connect()
    for file in folder.glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    out = QUERIES[name](spark, str(folder))
    cursor = db.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(out.columns)
    key = lambda row: tuple((v is None, v) for v in row)
    assert sorted(map(tuple, out.select(*names).collect()), key=key) == sorted(cursor.fetchall(), key=key)
