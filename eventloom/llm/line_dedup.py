"""Repeated and nearly repeated lines: the earliest stays, later ones go, with Spark functions only.

Lines are compared in lower case without blanks at their ends. Equal lines of at least
``MIN_EXACT`` words are one line that occurs often; lines of at least ``MIN_NEAR`` words are near if
at most one word is inserted, deleted or replaced (a similarity of 0.9 or more). Order is (doc_id, text hash, line number); a
line goes if an equal or near line comes earlier.

Deletion neighbourhoods: every candidate line emits, for each place, a hashed key of the line
without the word there and a key of the line cut there. Two lines that lack the same place's word
and are equal otherwise differ by a replacement; a line cut where another lacks a word differs by
that word. Keys hold place, prefix hash, suffix hash and length. Per key only the earliest line of
either kind is kept as witness, so a key shared by many lines costs one aggregation, never their
pairs. Each (line, witness) is verified on the words.

Before that, an exact filter: of two near lines either the first or the second half is untouched,
so lines whose four half keys are all unique have no near line and emit nothing.

Nulls: a null text stays null; a null doc_id sorts first. Rows equal in doc_id and text are one
document and keep the same lines. Lines of fewer words (blank ones too) always stay. Empty tables
give no rows; other columns are carried as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventloom.llm.common import BLANKS, documents, written

MIN_EXACT, MIN_NEAR = 3, 10
#: Tables of line hashes are broadcast up to so many rows (about 40 bytes each), else shuffled.
BROADCAST_LINES = 500_000

_LINE = ["h1", "h2"]
_BLANK_CHARS = " \t\n\x0b\f\r"


def _if_small(table: DataFrame) -> DataFrame:
    """A written table, broadcast if its row count is within ``BROADCAST_LINES``."""
    return F.broadcast(table) if table.count() <= BROADCAST_LINES else table


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, t1, line, own, h1, h2) of all lines but blank ones; ``own`` is the compared text."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    rows = rows.select("doc_id", F.xxhash64("text").alias("t1"), F.posexplode(F.split("text", "\n")).alias("line", "own"))
    rows = rows.withColumn("own", F.btrim(F.lower("own"), F.lit(_BLANK_CHARS))).where("own != ''")
    return rows.withColumn("h1", F.xxhash64("own")).withColumn("h2", F.xxhash64(F.lit(1), "own"))


def _half_keys() -> Column:
    """Keys of the halves of a line of n words, taken as the longer (n) and as the shorter (n + 1)
    of a pair; null for lines too short to be near."""
    keys = []
    for m in (F.col("n"), F.col("n") + 1):
        half = F.floor(m / 2).cast("int")
        keys.append(F.xxhash64(m, F.lit("first"), F.slice("words", 1, half)))
        keys.append(F.xxhash64(m, F.lit("second"), F.slice("words", F.col("n") - (m - half) + 1, m - half)))
    return F.when(F.col("n") >= MIN_NEAR - 1, F.array(*keys))


def distinct_lines(docs: DataFrame) -> DataFrame:
    """(h1, h2, n, times, first, halves): ``first`` is (doc_id, t1, line) of the earliest occurrence."""
    rows = lines(docs).withColumn("words", F.split("own", BLANKS)).withColumn("n", F.size("words"))
    rows = rows.where(F.col("n") >= MIN_EXACT).withColumn("halves", _half_keys())
    return rows.groupBy(*_LINE).agg(
        F.first("n").alias("n"), F.count("*").alias("times"),
        F.min(F.struct("doc_id", "t1", "line")).alias("first"), F.first("halves").alias("halves"))


def candidates(distinct: DataFrame) -> DataFrame:
    """(h1) of the lines that share a half with another line."""
    keys = distinct.where("halves is not null").select("h1", F.explode("halves").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("lines")).where("lines > 1").select("key")
    return keys.join(shared, "key", "left_semi").select("h1").distinct()


def numbered(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(id, h1, h2, words) of the chosen lines; ids rise with the line's first occurrence."""
    every = lines(docs).join(_if_small(chosen), "h1")
    own = every.groupBy(*_LINE).agg(F.min(F.struct("doc_id", "t1", "line")).alias("first"), F.first("own").alias("own"))
    own = own.withColumn("words", F.split("own", BLANKS)).where(F.size("words") >= MIN_NEAR - 1)
    own = own.orderBy("first", *_LINE).select(F.monotonically_increasing_id().alias("id"), *_LINE, "words")
    return written(own, "line-words")


def neighbourhood(own: DataFrame) -> DataFrame:
    """(id, lacks, key, key2) of lines ``own`` (id, words): one row per place and kind."""
    rows = own.select("id", F.size("words").alias("n"), F.posexplode("words").alias("i", "word"))
    rows = rows.withColumn("p", F.xxhash64("i", "word")).withColumn("s", F.xxhash64(F.col("n") - F.col("i"), "word"))
    line = Window.partitionBy("id")
    before = line.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    rows = rows.drop("word").withColumn("prefix", F.coalesce(F.bit_xor("p").over(before), zero))
    rows = rows.withColumn("passed", F.coalesce(F.bit_xor("s").over(before), zero))
    rows = rows.withColumn("suffix", F.bit_xor("s").over(line).bitwiseXOR(F.col("passed")))  # with the word at i
    after = F.col("suffix").bitwiseXOR(F.col("s"))
    kind = lambda lacks, i, n, p, s: F.struct(
        F.lit(lacks).alias("lacks"), F.xxhash64(i, n, p, s).alias("key"), F.hash(s, p, n, i).alias("key2"))
    i, n, prefix = F.col("i"), F.col("n"), F.col("prefix")
    last = F.when(i == n - 1, kind(False, n, n, prefix.bitwiseXOR(F.col("p")), zero))  # cut after the last word
    kinds = F.array(kind(True, i, n - 1, prefix, after), kind(False, i, n, prefix, F.col("suffix")), last)
    return rows.select("id", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("k")).select("id", "k.*")


def near_lines(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(h1, h2) of the lines that have an earlier near line."""
    own = numbered(docs, written(candidates(distinct), "line-candidates"))
    rows = neighbourhood(own)
    least = rows.groupBy("key", "key2").agg(
        F.min(F.when(F.col("lacks"), F.col("id"))).alias("lacking"), F.min(F.when(~F.col("lacks"), F.col("id"))).alias("cut"),
        F.count("*").alias("members")).where("members > 1").drop("members")
    met = rows.join(least, ["key", "key2"])
    witness = F.when(F.col("lacks"), F.least("lacking", "cut")).otherwise(F.col("lacking"))
    pairs = met.select("id", witness.alias("witness")).where("witness < id").distinct()
    theirs = own.select(F.col("id").alias("witness"), F.col("words").alias("other"))
    pairs = pairs.join(own, "id").join(theirs, "witness")
    return pairs.where(_one_word_apart()).select(*_LINE).distinct()


def _one_word_apart() -> Column:
    """Common beginning and end of ``words`` and ``other`` leave at most one word of the longer; the
    shorter of a near pair has ``MIN_NEAR - 1`` words, the longer ``MIN_NEAR``, at least."""
    def same(a: Column, b: Column) -> Column:
        at = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False) - 1
        return F.when(at < 0, F.least(F.size(a), F.size(b))).otherwise(at)

    a, b = F.col("words"), F.col("other")
    longer = F.greatest(F.size(a), F.size(b))
    return (same(a, b) + same(F.reverse(a), F.reverse(b)) >= longer - 1) & (longer >= MIN_NEAR)


def removals(docs: DataFrame) -> DataFrame:
    """(doc_id, t1, exact, near): numbers of the lines that go, by document."""
    distinct = written(distinct_lines(docs), "lines")
    near = near_lines(docs, distinct).withColumn("near", F.lit(True))
    going = distinct.join(near, _LINE, "left").where("times > 1 or near")
    going = written(going.select(*_LINE, "first", F.coalesce("near", F.lit(False)).alias("near")), "going")
    met = lines(docs).select(*_LINE, "doc_id", "t1", "line").join(_if_small(going), _LINE)
    repeat = ~F.col("first").eqNullSafe(F.struct("doc_id", "t1", "line"))
    return met.withColumn("repeat", repeat).where("repeat or near").groupBy("doc_id", "t1").agg(
        F.sort_array(F.collect_set(F.when(F.col("repeat"), F.col("line")))).alias("exact"),
        F.sort_array(F.collect_set(F.when(~F.col("repeat"), F.col("line")))).alias("near"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with later repeats taken out of ``text``; adds ``n_lines``, ``n_exact``
    and ``n_near`` (lines of the text, lines that went)."""
    gone = removals(docs).select(
        F.col("doc_id").alias("_dedup_id"), F.col("t1").alias("_dedup_t1"), "exact", "near")
    gone = gone.select("_dedup_id", "_dedup_t1", F.struct("exact", "near").alias("_dedup_gone"))
    gone = _if_small(written(gone, "line-removals"))
    text = F.col("text").cast("string")
    rows = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_dedup_id"]) & (F.xxhash64(text) == gone["_dedup_t1"]), "left")
    rows = rows.withColumn("_dedup_lines", F.split(text, "\n"))
    out = F.concat("_dedup_gone.exact", "_dedup_gone.near")
    places = F.array_except(F.sequence(F.lit(0), F.size("_dedup_lines") - 1), out)
    kept = F.array_join(F.transform(places, lambda i: F.get(F.col("_dedup_lines"), i)), "\n")
    count = lambda c: F.greatest(F.size(c), F.lit(0)).cast("long")
    rows = rows.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(count("_dedup_lines")).cast("long"))
    rows = rows.withColumn("n_exact", F.coalesce(count("_dedup_gone.exact"), F.lit(0)))
    rows = rows.withColumn("n_near", F.coalesce(count("_dedup_gone.near"), F.lit(0)))
    rows = rows.withColumn("text", F.when(F.col("_dedup_gone").isNull(), text).otherwise(kept))
    return rows.drop("_dedup_id", "_dedup_t1", "_dedup_gone", "_dedup_lines")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_exact", "n_near", "text")
