"""Vector codes of four bytes: Lloyd's rounds over partition-local cover trees.

Vectors become integers (floor of 1024 times each component) and are cut into ``PARTS`` equal
consecutive parts. Every part position has a codebook, which starts as that part of the vectors with
the ``ENTRIES`` smallest ids. A round assigns each part to its nearest entry and moves the entries to
the floored means.

Once, each partition builds a cover tree per part over blocks of its rows: a node holds a center, its
radius, and a range of the tree's point order; children cover the node's points within ``1 / BASE`` of
its radius. Prefix sums over the point order give the sum of any subtree. A round walks the trees from
the roots, all nodes of a depth at once: where the second nearest entry of a center is farther than the
nearest by over twice the radius, the triangle inequality gives the whole subtree to the nearest entry.
The other nodes descend with the entries still possible, and leaves compare them exactly. Only sums
and counts per entry leave a partition; trees are written to the shared folder once and read each round.

Distances are exact integers; equal ones go to the lower index. Rows whose vector is null or holds a
null, a NaN or an infinity are dropped. Components beyond 16,384 in size count as that, so that no sum of
squares overflows. A vector shorter than the longest kept one, the empty one too, is filled up with
zeros, as is a length no multiple of ``PARTS``. With fewer rows than ``ENTRIES`` there are fewer entries.
Null ids come last in the order of ids, equal ids are ordered by vector; repeated rows each count and
get their row. An empty table gives no rows. Other columns than the three named are ignored.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import looked_up, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LARGEST = 1 << 24
#: Rows of one tree at most; a node's children cover its points within 1 / BASE of its radius.
BLOCK, BASE, LEAF = 10_000, 1.5, 24
#: A node whose points need more children than this to be covered has no clusters: it is a leaf.
NET = 64


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): the sound rows, ``v`` as integers."""
    value = F.col("embedding").cast("array<double>")
    sound = F.coalesce(F.forall(value, lambda x: F.abs(x) < F.lit(float("inf"))), F.lit(False))
    whole = F.transform(value, lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))))
    return vectors.where(sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), whole.cast("array<long>").alias("v"))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of ``width``, shorter ones followed by zeros."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(offsets)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.values.to_numpy()[offsets[0] : offsets[-1]]
    return out


def squares(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all entries, as whole numbers."""
    largest = max(np.abs(points).max(initial=0), np.abs(book).max(initial=0))
    if largest < 1 << 20:  # every term and sum is below 2 ** 53: exact in floats
        a, b = points.astype(np.float64), book.astype(np.float64)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
    out = np.zeros((len(points), len(book)), np.int64)
    for k in range(points.shape[1]):
        out += (points[:, k, None] - book[None, :, k]) ** 2
    return out


def cover_tree(rows: np.ndarray) -> dict[str, np.ndarray]:
    """The tree of one block of parts. ``points`` are the distinct parts in tree order, ``counts`` how often
    each occurs, ``place`` the point of each row; node k covers points lo[k] to hi[k], with the nodes from
    first[k] on, ``children[k]`` of them, below it."""
    points, place, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    spots = points.astype(np.float64)
    order = np.arange(len(points))
    center, radius, lo, hi, first, children = [0], [0.0], [0], [len(points)], [0], [0]
    at = 0
    while at < len(center):
        own = order[lo[at] : hi[at]]
        near = np.sqrt(((spots[own] - spots[center[at]]) ** 2).sum(1))
        radius[at] = float(near.max())
        if len(own) > LEAF and radius[at] > 0:
            owner, net, cover = np.zeros(len(own), np.int64), [center[at]], radius[at] / BASE
            while near.max() > cover and len(net) <= NET:
                net.append(int(own[near.argmax()]))
                apart = np.sqrt(((spots[own] - spots[net[-1]]) ** 2).sum(1))
                closer = apart < near
                owner[closer], near[closer] = len(net) - 1, apart[closer]
            if len(net) <= NET:
                order[lo[at] : hi[at]] = own[np.argsort(owner, kind="stable")]
                ends = lo[at] + np.cumsum(np.bincount(owner, minlength=len(net)))
                first[at], children[at] = len(center), len(net)
                center += net
                radius += [0.0] * len(net)
                lo += [lo[at], *ends[:-1].tolist()]
                hi += ends.tolist()
                first += [0] * len(net)
                children += [0] * len(net)
        at += 1
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    whole = lambda values: np.array(values, np.int32)
    return {
        "points": points[order].astype(np.int32), "counts": counts[order], "place": whole(rank[place.reshape(-1)]),
        "center": whole(rank[center]), "radius": np.array(radius), "lo": whole(lo), "hi": whole(hi),
        "first": whole(first), "children": whole(children)}


def _ranges(lo: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """lo[0], lo[0] + 1, ... for ``sizes[0]`` numbers, then those of the next range."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - (ends - sizes), sizes)


def assigned(tree: dict[str, np.ndarray], book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lo, hi, entry): ranges of the tree's points, all points once, and the nearest entry of each."""
    points, found = tree["points"].astype(np.int64), []
    nodes, possible = np.array([0]), np.ones((1, len(book)), bool)
    while len(nodes):
        exact = np.where(possible, squares(points[tree["center"][nodes]], book), np.inf)
        nearest = exact.argmin(1)
        away = np.sqrt(exact)
        # A little more than the triangle inequality asks for, against rounding of roots.
        reach = (away[np.arange(len(nodes)), nearest] + 2 * tree["radius"][nodes]) * (1 + 1e-9) + 1e-6
        possible = away <= reach[:, None]
        alone = possible.sum(1) == 1
        found.append((tree["lo"][nodes[alone]], tree["hi"][nodes[alone]], nearest[alone]))
        leaf = ~alone & (tree["children"][nodes] == 0)
        lo, sizes = tree["lo"][nodes[leaf]], (tree["hi"] - tree["lo"])[nodes[leaf]]
        if len(lo):
            spots = _ranges(lo, sizes)
            exact = np.where(np.repeat(possible[leaf], sizes, axis=0), squares(points[spots], book), np.inf)
            found.append((spots, spots + 1, exact.argmin(1)))
        inner = ~alone & ~leaf
        sizes = tree["children"][nodes[inner]]
        possible = np.repeat(possible[inner], sizes, axis=0)
        nodes = _ranges(tree["first"][nodes[inner]], sizes)
    lo, hi, entry = (np.concatenate(values) for values in zip(*found))
    return lo.astype(np.int64), hi.astype(np.int64), entry.astype(np.int64)


def _packed(trees: list[dict[str, np.ndarray]]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{f"{p}_{name}": values for p, tree in enumerate(trees) for name, values in tree.items()})
    return out.getvalue()


def _trees(blob: bytes) -> list[dict[str, np.ndarray]]:
    with np.load(io.BytesIO(blob), allow_pickle=False) as arrays:
        out = [{} for _ in range(PARTS)]
        for name in arrays.files:
            part, _, field = name.partition("_")
            out[int(part)][field] = arrays[name]
    return out


def forest(kept: DataFrame, width: int) -> DataFrame:
    """(ids, labels, trees): a row per block, written to the shared folder."""
    step = width // PARTS

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                rows = _matrix(block.column("v"), width)
                trees = _packed([cover_tree(rows[:, p * step : (p + 1) * step]) for p in range(PARTS)])
                yield pa.RecordBatch.from_arrays([
                    pa.array([block.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([block.column("label").to_pylist()], pa.list_(pa.string())),
                    pa.array([trees], pa.binary())], ["ids", "labels", "trees"])

    return written(kept.mapInArrow(plant, "ids array<long>, labels array<string>, trees binary"), "cover-trees")


def _means(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    width = books.shape[2]

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for blob in batch.column("trees"):
                for p, tree in enumerate(_trees(blob.as_py())):
                    lo, hi, entry = assigned(tree, books[p])
                    many = np.append(0, np.cumsum(tree["counts"]))
                    below = np.vstack([np.zeros((1, width), np.int64), np.cumsum(tree["points"] * tree["counts"][:, None], axis=0)])
                    np.add.at(counts[p], entry, many[hi] - many[lo])
                    np.add.at(sums[p], entry, below[hi] - below[lo])
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]),
            pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    rows = trees.select("trees").mapInArrow(totals, "part int, entry int, n long, sums array<long>")
    total = rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width)))
    after = books.copy()
    for row in total.collect():  # PARTS * ENTRIES rows at most
        after[row.part, row.entry] = np.array(row[3:], np.int64) // row.n
    return after


def codebooks(kept: DataFrame, trees: DataFrame, width: int) -> np.ndarray:
    """Entries by part and index after all rounds."""
    starts = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()
    rows = np.array([[*r.v, *[0] * (width - len(r.v))] for r in starts], np.int64).reshape(len(starts), PARTS, width // PARTS)
    books = np.ascontiguousarray(rows.transpose(1, 0, 2))
    for _ in range(ROUNDS):
        books = _means(trees, books)
    return books


def coded(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code binary, error) of every row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, blob in enumerate(batch.column("trees")):
                codes, errors = [], 0
                for p, tree in enumerate(_trees(blob.as_py())):
                    lo, hi, entry = assigned(tree, books[p])
                    nearest = np.empty(len(tree["points"]), np.int64)
                    nearest[_ranges(lo, hi - lo)] = np.repeat(entry, hi - lo)
                    apart = ((tree["points"].astype(np.int64) - books[p][nearest]) ** 2).sum(1)
                    codes.append(nearest[tree["place"]].astype(np.uint8))
                    errors = errors + apart[tree["place"]]
                code = np.stack(codes, axis=1)
                yield pa.RecordBatch.from_arrays([
                    batch.column("ids")[k].values, batch.column("labels")[k].values,
                    pa.Array.from_buffers(pa.binary(PARTS), len(code), [None, pa.py_buffer(code.tobytes())]).cast(pa.binary()),
                    pa.array(errors)], ["vec_id", "label", "code", "error"])

    return trees.mapInArrow(encode, "vec_id long, label string, code binary, error long")


def compressed(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error), codebooks) of the vectors (vec_id, embedding, label)."""
    kept = kept_vectors(vectors)
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-longest // PARTS)) * PARTS
    trees = forest(kept, width)
    books = codebooks(kept, trees, width)
    return written(coded(trees, books), "vector-codes"), books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = rows.withColumn("unlabelled", F.col("label").isNull()).withColumn("label", F.coalesce("label", F.lit("")))
    errors = rows.groupBy("label", "unlabelled").agg(F.sum("error").alias("label_error"), F.count("*").alias("times"))
    found = looked_up(rows, written(errors, "label-errors"), ["label", "unlabelled"])
    return found.select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
