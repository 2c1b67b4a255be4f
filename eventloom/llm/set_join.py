"""Jaccard self-join of word n-gram sets by rare-first prefixes.

A text is the set of its distinct three-word shingles (64-bit hashes; a text of fewer words is one shingle).
Texts of equal sets are one node, so copies are never paired. Two nodes link if they have 90 % of their
union in common.

1. A lossless reduction, before rarity is known: in any one order of all shingles two similar sets share
   many of their first ones. Taken by hash, each set sends a fifth of its shingles; one that meets too few of
   them elsewhere to reach the bound has no partner and is done.
2. The others are put in order, rarest shingle first (exact document counts, ties by hash). A set's prefix
   is its first n - ceil(0.9 n) + 1 shingles; similar sets share a shingle of their prefixes. Shingles no other
   set holds need no rows: they only move the positions of the rest.
3. Sets meet under a prefix shingle if sizes allow the bound (length filter), what follows the shingle in
   either set suffices for it (positional filter), and the parities of ``SKETCH`` hash classes, whose
   differing ones are at most the sets' differing shingles, don't rule it out (suffix filter).
4. A pair is verified once, by the exact intersection of both sets.

Many near copies under one shingle are not paired with each other: in rounds, each set meets one hub per
shingle; what links is connected, and shingles whose sets are all connected are done. When a round settles
little more, the sets left under shingles with several components are compared across components, all of
them, in blocks of ``BLOCK`` under salted keys. That step is exact, so no link between different components
is lost.

Nulls: a null text has the empty set, as has a text without words; it links with nothing. A null doc_id keeps
its row and links, but never names a component unless all its ids are null. Rows equal in id and text each
get their row. Empty tables give no rows; other columns are ignored; whole texts are taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import documents, looked_up, text_slices, word_codes, written
from eventloom.llm.components import components

WORDS, SHARE = 3, 90  # shingle length, percent of the union
SKETCH = 512
BLOCK = 512
#: Hub rounds go on while they settle more than this share of the unsettled prefix shingles.
WORTHWHILE = 0.2
#: Tables of ids up to so many rows, and sets up to so many bytes in all, are broadcast; else shuffled.
BROADCAST_IDS, BROADCAST_BYTES = 500_000, 64 << 20

_MIX = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_NO_WORD = np.uint64(0x27D4EB2F165667C5)


def _least(n: int) -> int:
    """Shingles a similar set has in common with one of ``n``, at least."""
    return -(-SHARE * n // 100)


def _prefix(n: int) -> int:
    return n - _least(n) + 1


def shingle_sets(texts: pa.Array, size: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingle hashes in unsigned order."""
    from xxhash import xxh64_intdigest as digest

    offsets, codes, distinct = word_codes(texts)
    words = np.array([digest(w) for w in distinct.to_pylist()] or [0], np.uint64)[codes]
    padded = np.append(words, np.full(size - 1, _NO_WORD, np.uint64))
    hashes = np.zeros(len(words), np.uint64)
    for k in range(size):
        hashes = (hashes + padded[k : k + len(words)]) * _MIX[k % len(_MIX)]
        hashes ^= hashes >> np.uint64(29 + k)
    sets = []
    for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
        if b - a >= size or a == b:
            sets.append(np.unique(hashes[a : max(a, b - size + 1)]))
        else:
            sets.append(np.array([digest(words[a:b].tobytes(), b - a)], np.uint64))
    return sets


def _signed(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def text_rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))


def summaries(docs: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, n, s1, s2, low) of each row: hashes of the text and of its set, the set's size, and
    its first shingles by hash."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as digest

        for batch in batches:
            for piece in text_slices(batch):
                sets = shingle_sets(piece.column("text"))
                one, two = (np.array([digest(s.tobytes(), seed) for s in sets], np.uint64).view(np.int64) for seed in (0, 1))
                low = _signed([s[: 2 * _prefix(len(s)) - 1] for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in ("doc_id", "t1", "t2")), pa.array(np.array([len(s) for s in sets], np.int64)),
                     pa.array(one), pa.array(two), low], ["doc_id", "t1", "t2", "n", "s1", "s2", "low"])

    return text_rows(docs).mapInArrow(summary, "doc_id long, t1 long, t2 long, n long, s1 long, s2 long, low array<long>")


def _least_of(n: Column) -> Column:
    return F.ceil(n * SHARE / 100).cast("long")


def _prefix_of(n: Column) -> Column:
    return n - _least_of(n) + 1


def reduced(nodes: DataFrame) -> DataFrame:
    """(node, t1, t2) of the nodes that meet enough of their first shingles in other nodes."""
    low = nodes.select("node", "n", F.explode("low").alias("h"))
    shared = low.groupBy("h").agg(F.count("*").alias("sets")).where("sets > 1").select("h")
    met = low.join(shared, "h", "left_semi").groupBy("node").agg(F.count("*").alias("met"), F.first("n").alias("n"))
    # The smallest partner has least(n) shingles; the pair shares that one's prefix length at least.
    able = met.where(F.col("met") >= _prefix_of(_least_of(F.col("n")))).select("node")
    return nodes.select("node", "t1", "t2").join(able, "node")


def whole_sets(docs: DataFrame, wanted: DataFrame, size: int = WORDS) -> DataFrame:
    """(node, n, hashes, sketch) of the nodes ``wanted`` (node, t1, t2), from their texts."""

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch):
                sets = shingle_sets(piece.column("text"), size)
                classes = [np.bincount((s >> np.uint64(40)).astype(np.int64) % SKETCH, minlength=SKETCH) for s in sets]
                sketch = [np.packbits((c & 1).astype(np.uint8), bitorder="little").view(np.uint64) for c in classes]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("node"), pa.array(np.array([len(s) for s in sets], np.int64)), _signed(sets), _signed(sketch)],
                    ["node", "n", "hashes", "sketch"])

    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    texts = text_rows(docs).drop("doc_id").join(few, ["t1", "t2"]).dropDuplicates(["node"]).select("node", "text")
    return texts.mapInArrow(full, "node long, n long, hashes array<long>, sketch array<long>")


def prefixes(sets: DataFrame) -> DataFrame:
    """(h, node, n, place) of the shingles in prefixes that other sets hold too."""
    every = sets.select("node", "n", F.explode("hashes").alias("h"))
    counts = every.groupBy("h").agg(F.count("*").alias("sets")).where("sets > 1")
    order = F.sort_array(F.collect_list(F.struct("sets", "h")))
    own = every.join(counts, "h").groupBy("node").agg(F.first("n").alias("n"), order.alias("order"))
    alone = F.col("n") - F.size("order")  # shingles of this set only: the rarest, all before the others
    length = F.greatest(_prefix_of(F.col("n")) - alone, F.lit(0)).cast("int")
    first = own.select("node", "n", alone.alias("alone"), F.posexplode(F.slice("order", F.lit(1), length)).alias("at", "o"))
    return first.select(F.col("o.h").alias("h"), "node", "n", (F.col("alone") + F.col("at")).alias("place"))


def _possible(share: int) -> Column:
    """Length, positional and suffix filter of sets a and b under a common prefix shingle."""
    n, m = F.col("n_a"), F.col("n_b")
    common = F.ceil((n + m) * share / (100 + share)).cast("long")
    length = (100 * n >= share * m) & (100 * m >= share * n)
    positional = F.least(n - F.col("place_a"), m - F.col("place_b")) >= common
    words = [F.bit_count(F.get("sketch_a", F.lit(k)).bitwiseXOR(F.get("sketch_b", F.lit(k)))) for k in range(SKETCH // 64)]
    suffix = reduce(lambda x, y: x + y, words) <= n + m - 2 * common
    return length & positional & suffix


def _side(rows: DataFrame, side: str, *keys: str) -> DataFrame:
    return rows.select(*keys, *(F.col(c).alias(f"{c}_{side}") for c in ("node", "label", "n", "place", "sketch")))


def _with_hubs(members: DataFrame, turn: int, share: int) -> DataFrame:
    """(a, b): each member and the hub of its shingle, if they may link and are in different components."""
    rank = F.col("node") if turn == 0 else F.xxhash64("h", "node", F.lit(turn))
    hub = F.min(F.struct(rank.alias("rank"), *(F.col(c) for c in ("node", "label", "n", "place", "sketch")))).alias("hub")
    hubs = members.groupBy("h").agg(hub).select("h", *(F.col(f"hub.{c}").alias(f"{c}_b") for c in ("node", "label", "n", "place", "sketch")))
    met = _side(members, "a", "h").join(hubs, "h").where((F.col("label_a") != F.col("label_b")) & _possible(share))
    return _ordered(met)


def _across(members: DataFrame, share: int) -> DataFrame:
    """(a, b): all pairs of different components under a shingle that may link, in blocks of salted keys."""
    blocks = members.groupBy("h").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    salted = members.join(blocks, "h").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    salted = salted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    salted = salted.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    keys = ["h", "i", "j"]
    # Of the two blocks of a key, a is the first and b the second; in a block of its own, a is the smaller node.
    a = _side(salted.where("own = i"), "a", *keys)
    b = _side(salted.where("own = j"), "b", *keys)
    apart = (F.col("label_a") != F.col("label_b")) & ((a["i"] < a["j"]) | (F.col("node_a") < F.col("node_b")))
    on = reduce(lambda x, y: x & y, [a[k] == b[k] for k in keys])
    return _ordered(a.join(b, on & apart & _possible(share)).select("node_a", "node_b"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b")).distinct()


def _linked(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs whose sets have ``share`` percent of their union in common."""
    theirs = sets.join(pairs.select(F.col("b").alias("node")).distinct(), "node", "left_semi")
    size = theirs.agg(F.sum("n")).first()[0] or 0
    theirs = theirs.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("hashes").alias("other"))
    rows = pairs.join(sets.select(F.col("node").alias("a"), "n", "hashes"), "a")
    rows = rows.join(F.broadcast(theirs) if size * 8 <= BROADCAST_BYTES else theirs, "b")
    both = F.size(F.array_intersect("hashes", "other"))
    return written(rows.where(100 * both >= share * (F.col("n") + F.col("m") - both)).select("a", "b"), "set-links")


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their components, under shingles of several components only."""
    known = members.drop("label").join(labels.select("node", "label"), "node", "left")
    known = known.withColumn("label", F.coalesce("label", "node"))
    mixed = known.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("h")
    return written(known.join(mixed, "h"), "unsettled-sets")


def linked(members: DataFrame, sets: DataFrame, share: int = SHARE) -> DataFrame:
    """(node, label) of all nodes with links of ``share`` percent between sets that meet under a key.

    ``members`` (h, node, n, place) are the keys of the sets, ``sets`` a written table. ``turn`` counts the
    rounds, ``left`` and ``before`` the members that are not settled now and were not a round ago.
    """
    members = members.join(sets.select("node", "sketch"), "node")
    none = sets.sparkSession.createDataFrame([], "node long, label long")
    members = _unsettled(written(members, "set-prefixes"), none)
    links, labels, tested, turn, left = None, none, None, 0, members.count()
    before = 2 * left
    while left:
        last = left > before * (1 - WORTHWHILE)
        pairs = _across(members, share) if last else _with_hubs(members, turn, share)
        pairs = written(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "set-pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = _linked(pairs, sets, share)
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        if last:
            break
        members, before, turn = _unsettled(members, labels), left, turn + 1
        left = members.count()
    return labels


def similar_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n, component_id) of each row: its set's size and the smallest doc_id reachable by links."""
    rows = written(summaries(docs), "set-summaries")
    full = rows.where("n > 0")
    nodes = full.groupBy("s1", "s2").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("times"), F.first("n").alias("n"),
        F.min(F.struct("t1", "t2")).alias("text"), F.first("low").alias("low"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()).select("*", "text.*").drop("text"), "set-nodes")
    sets = written(whole_sets(docs, written(reduced(nodes), "set-candidates")), "sets")
    labels = linked(prefixes(sets), sets)
    classes = nodes.join(labels, "node", "left").select("s1", "s2", "first_id", "times", F.coalesce("label", "node").alias("label"))
    least = classes.groupBy("label").agg(F.min("first_id").alias("component_id"))
    classes = written(classes.join(least, "label").select("s1", "s2", "times", "component_id"), "set-classes")
    named = looked_up(full.select("doc_id", "n", "s1", "s2"), classes, ["s1", "s2"]).select("doc_id", "n", "component_id")
    empty = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return named.unionByName(empty)


def op13_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(documents(spark, sf_dir)).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
