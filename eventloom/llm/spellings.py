"""Spelling variants: words one edit apart, found by asymmetric chunks.

Words are runs of Latin letters in lower case (A-Z only); one run in ``DROP_EACH`` by a hash of document
and run loses a letter. Distinct results of at least ``MIN_LENGTH`` code points that occur at least
``MIN_TIMES`` times are compared. Two are near if one code point is inserted, deleted or replaced.

The shorter word of a pair (of equal lengths the smaller one) contributes two disjoint chunks, its halves
of q = length // 2 code points at its beginning and end. The other contributes its positional grams of
that q, for each length its partner may have. One edit leaves a chunk whole and moves it by one place at
most, so a chunk and a gram of the same letters that start within one place of each other make a pair a
candidate: where the gram may meet a chunk is part of the key. Each candidate is verified once by its edit
distance, inside the join, so that only near pairs leave it.

Dense keys: of the keys that more than ``DENSE`` words share, only the matches at the place a whole chunk
really has are needed (its own before the edit, moved by the difference of lengths after it). There the
edit lies in the rest of the word, whose own two halves are chunks again: the words get keys of the shared
part and one more half, and so on, until keys are sparse or the rest is one letter; no key of that kind is
shared by more words than there are letters for one place. No pairs of a whole dense group are made.

A word's form is its most frequent near word (ties: the smaller), if ``TIMES_MORE`` times as frequent.
Forms rise in frequency by that factor, so chains have under 28 links and ``DOUBLINGS`` doublings reach
every root.

Null texts hold no words; a null id counts as the empty text in the hash; repeated rows are counted each;
words without near words have no form and are their own root. Empty tables give no rows. Other columns
are ignored. Long texts are taken whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import documents, text_slices, written

MIN_LENGTH, MIN_TIMES, TIMES_MORE, DROP_EACH = 6, 5, 5, 199
DENSE, DOUBLINGS = 64, 5
#: Distinct words a task gathers before it hands their counts on; counts are added up afterwards.
GATHER = 400_000
#: Rows of a table of words (about 60 bytes each) that are broadcast, else it is shuffled.
BROADCAST_WORDS = 500_000

_RUNS = re.compile("[a-zÀ-ÿ]+")


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for piece in text_slices(batch):
                for name, text in zip(piece.column("name").to_pylist(), piece.column("text").to_pylist()):
                    if text:
                        _count_text(f"{name}:".encode(), text, found)
                if len(found) > GATHER:
                    yield _counted(found)
                    found.clear()
        yield _counted(found)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), F.col("text").cast("string").alias("text"))
    partial = rows.mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_TIMES)


def _count_text(prefix: bytes, text: str, found: Counter[str]) -> None:
    start = zlib.crc32(prefix)
    for run, times in Counter(_RUNS.findall(text.encode().lower().decode())).items():
        if len(run) < MIN_LENGTH:
            continue
        h = zlib.crc32(run.encode(), start)
        if h % DROP_EACH == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < MIN_LENGTH:
                continue
        found[run] += times


def _counted(found: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])


def _cut(word: Column | str, start: Column | int, length: Column | int) -> Column:
    """Code points from ``start`` (counted from 0) on."""
    word = F.col(word) if isinstance(word, str) else word
    whole = lambda v: v.cast("int") if isinstance(v, Column) else F.lit(v)
    return F.substring(word, whole(start) + F.lit(1), whole(length))


def _floor_half(value: Column) -> Column:
    return F.floor(value / 2).cast("int")


def _chunks(words: DataFrame) -> DataFrame:
    """(size, place, chunk, word): both disjoint chunks of each word under its own length."""
    size = F.length("word")
    q = _floor_half(size)
    both = F.array(*(F.struct(p.alias("place"), _cut("word", p, q).alias("chunk")) for p in (F.lit(0), size - q)))
    return words.select("word", size.alias("size"), F.explode(both).alias("c")).select("size", "c.place", "c.chunk", "word")


def _grams(words: DataFrame) -> DataFrame:
    """(size, place, chunk, own, word): the positional grams of each word that start within one place of
    ``place``, where words of length ``size`` have a chunk. ``own``: the gram is where that chunk is, if whole."""
    length = F.length("word")
    rows = words.withColumn("size", F.explode(F.array(length, length - 1))).where(F.col("size") >= MIN_LENGTH)
    size, q = F.col("size"), _floor_half(F.col("size"))
    kinds = F.array(*(
        F.struct(p.alias("place"), (p + shift).alias("at"), (F.lit(shift) == own).alias("own"))
        for p, own in ((F.lit(0), F.lit(0)), (size - q, length - size)) for shift in (-1, 0, 1)))
    rows = rows.withColumn("q", q).withColumn("length", length).withColumn("g", F.explode(kinds))
    rows = rows.where((F.col("g.at") >= 0) & (F.col("g.at") + F.col("q") <= F.col("length")))
    return rows.select("size", "g.place", _cut("word", F.col("g.at"), F.col("q")).alias("chunk"), "g.own", "word")


def _near(a: Column, b: Column) -> Column:
    """Edit distance one; ``a`` is the shorter word, or the smaller of two of one length."""
    ordered = (F.length(a) < F.length(b)) | (a < b)
    return ordered & (F.levenshtein(a, b, 1) == 1)


def _joined(chunks: DataFrame, grams: DataFrame, key: list[str]) -> DataFrame:
    a, b = chunks.select(*key, F.col("word").alias("a")), grams.select(*key, F.col("word").alias("b"))
    on = [a[k] == b[k] for k in key] + [_near(F.col("a"), F.col("b"))]
    return a.join(b, on).select("a", "b")


def _if_small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_WORDS else table


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b) of all words one edit apart, each pair once; ``words`` is a written table."""
    key = ["size", "place", "chunk"]
    chunks, grams = _chunks(words), _grams(words)
    members = grams.groupBy(*key).agg(F.count("*").alias("members")).where(F.col("members") > DENSE)
    dense = written(members.join(chunks.select(*key).distinct(), key, "left_semi").select(*key), "dense-chunks")
    many = _if_small(dense)
    found = [_joined(chunks.join(many, key, "left_anti"), grams.join(many, key, "left_anti"), key)]
    # The rest of the word: ``head`` letters are shared before it, ``tail`` letters after it.
    q, size = _floor_half(F.col("size")), F.col("size")
    first = F.col("place") == 0
    shared = [F.when(first, q).otherwise(0).alias("head"), F.when(first, 0).otherwise(q).alias("tail")]
    kept = ["word", "size", *shared]
    level = (chunks.join(many, key).select(*kept), grams.where("own").join(many, key).select(*kept))
    while dense.count():
        level = tuple(written(_halved(side), "halves") for side in level)
        key = ["size", "head", "tail", "before", "after"]
        rest = F.col("size") - F.col("head") - F.col("tail")
        members = level[1].groupBy(*key).agg(F.count("*").alias("members")).where((F.col("members") > DENSE) & (rest > 1))
        dense = written(members.join(level[0].select(*key).distinct(), key, "left_semi").select(*key), "dense-halves")
        many = _if_small(dense)
        found.append(_joined(*(side.join(many, key, "left_anti") for side in level), key))
        level = tuple(side.join(many, key).select("word", "size", "head", "tail") for side in level)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def _halved(side: DataFrame) -> DataFrame:
    """Each half of the rest added to what is shared, and the shared letters as part of the key."""
    rest = F.col("size") - F.col("head") - F.col("tail")
    half = _floor_half(rest)
    kinds = F.array(
        F.struct((F.col("head") + half).alias("head"), F.col("tail").alias("tail")),
        F.struct(F.col("head").alias("head"), (F.col("tail") + rest - half).alias("tail")))
    rows = side.select("word", "size", F.explode(F.array_distinct(kinds)).alias("k")).select("word", "size", "k.*").distinct()
    before, after = _cut("word", 0, F.col("head")), _cut("word", F.length("word") - F.col("tail"), F.col("tail"))
    return rows.select("word", "size", "head", "tail", before.alias("before"), after.alias("after"))


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the written table ``words`` (word, n)."""
    pairs = written(near_pairs(words), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    theirs = both.join(words.withColumnRenamed("word", "b"), "b")
    best = theirs.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    best = best.select(F.col("a").alias("word"), "n_near", "best.form", (-F.col("best.less")).alias("form_n"))
    enough = F.col("form_n") >= TIMES_MORE * F.col("n")
    rows = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"))
    rows = written(rows, "word-forms")
    roots = rows.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        onward = _if_small(written(roots, "roots"))
        further = onward.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = onward.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(written(word_counts(documents(spark, sf_dir)), "words"))
