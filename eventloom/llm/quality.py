"""Quality rules: counts per text, and a log-likelihood ratio against a trusted target.

Base rules reject texts of fewer than 10 words and texts with over a fifth of their words in
repeated five-word windows. The rest is judged by hashed unigrams and bigrams: a multinomial over
``BUCKETS`` is counted from the trusted documents (labels.quality 1, not toxic), another from all
documents; a text's score is the mean of log(target / raw) over its n-grams, and a text is kept if
the mean reaches ``THRESHOLD``. Both counts cover all documents and whole texts; every document is
judged by the same fixed threshold. Only Spark functions are used.

Tokens of the n-grams are runs of letters and digits, or of punctuation, so that odd punctuation
counts wherever it hangs on a word.

Nulls: a null text has no words and fails; null labels are ignored, of several labels the smallest
counts. A text without n-grams scores 0. Repeated rows are judged each. Without trusted documents
all ratios are 0. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import BLANKS, documents, written

MIN_WORDS, WINDOW, MAX_REPEATED_PERCENT = 10, 5, 20
BUCKETS, PRIOR = 1 << 14, 1000.0
#: Nats per n-gram. Ordinary texts of a less common language lie a little under 0, junk under -0.9.
THRESHOLD = -0.3
#: Trusted ids are broadcast up to so many (8 bytes each), else joined by a shuffle.
BROADCAST_IDS = 2_000_000

_SYMBOL, _NO_BLANK = r"[#*$%&|<>]", r"[^\x20\x09\x0A\x0B\x0C\x0D]"
#: Named one by one, as in ``BLANKS``: ASCII punctuation, and with it the ASCII controls and the blank.
_PUNCTUATION = "".join(rf"\x{k:02X}" for k in range(33, 127) if not chr(k).isalnum())
_TOKEN = "[^" + "".join(rf"\x{k:02X}" for k in [*range(33), 127]) + _PUNCTUATION + "]+|[" + _PUNCTUATION + "]+"


def _with_repeated_words(rows: DataFrame) -> DataFrame:
    """``rows`` with ``n_repeat_words``: words inside windows found twice or more.

    The windows' hashes are sorted, equal neighbours give the places, and places are merged in
    order: n log n for long texts, and nothing beyond the hashes for texts without repeats. Each
    step is a column of its own, so that no lambda computes an array again.
    """
    places = F.when(F.size("words") >= WINDOW, F.sequence(F.lit(0), F.size("words") - WINDOW)).otherwise(F.array())
    window = lambda i: F.xxhash64(*(F.get(F.col("words"), i + k) for k in range(WINDOW)))
    rows = rows.withColumn("hashes", F.transform(places, window))
    pairs = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    rows = rows.withColumn("pairs", F.when(repeats, pairs)).drop("hashes")
    near = lambda p, k: F.coalesce(F.get(F.col("pairs"), k)["h"] == p["h"], F.lit(False))
    again = F.filter("pairs", lambda p, k: near(p, k - 1) | near(p, k + 1))
    rows = rows.withColumn("found", F.sort_array(F.transform(again, lambda p: p["i"]))).drop("pairs")
    reach = F.transform("found", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("found"), k + 1) - i, F.lit(WINDOW))))
    covered = F.aggregate(reach, F.lit(0), lambda a, b: a + b)
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("found")


def base_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    rows = rows.withColumn("words", F.filter(F.split("text", BLANKS), lambda w: w != ""))
    rows = rows.withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(_NO_BLANK)))
    return _with_repeated_words(rows).select(
        "doc_id", "text", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(_SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words")


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


def _bucket(*words: Column) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(BUCKETS)).cast("int")


def _buckets(tokens: Column) -> Column:
    """Bucket numbers of all unigrams and bigrams, in order of their last token."""
    single = F.transform(tokens, lambda t: _bucket(t))
    double = F.transform(tokens, lambda t, i: F.when(i > 0, _bucket(F.get(tokens, i - 1), t)))
    return F.concat(single, F.filter(double, lambda b: b.isNotNull()))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(doc_id) of trusted documents, broadcast if they are few enough by count."""
    rows = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    ids = rows.where("doc_id is not null and quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    ids = written(ids.withColumn("trusted", F.lit(1)), "trusted")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def ratios(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row, ``ratio``: log(target share / raw share) of each bucket, in bucket order."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.join(trusted_ids(labels), "doc_id", "left").select("trusted", _tokens(F.col("text")).alias("tokens"))
    grams = rows.select("trusted", F.explode(_buckets(F.col("tokens"))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("trusted").alias("target"))
    counts = written(counts, "bucket-counts")
    raw, target = counts.agg(F.sum("raw"), F.sum("target")).first()
    every = docs.sparkSession.range(BUCKETS).withColumnRenamed("id", "bucket").join(counts, "bucket", "left")
    # The target's share of a bucket leans on the raw share by PRIOR n-grams, so few trusted
    # documents give ratios near 1 instead of near those of an even spread.
    expected = F.col("raw") / float(raw or 1)
    seen = (F.col("target") / expected + PRIOR) / (float(target or 0) + PRIOR)
    value = F.coalesce(F.log(seen), F.lit(0.0))
    # BUCKETS numbers, whatever the corpus.
    row = every.agg(F.sort_array(F.collect_list(F.struct("bucket", value.alias("v")))).alias("all"))
    return row.select(F.col("all.v").alias("ratio"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Base counts of every row with ``base_failed``, ``score`` and ``kept``."""
    model = written(ratios(docs, labels), "ratios")
    rows = base_counts(docs).withColumn("ratio", model.scalar()).withColumn("tokens", _tokens(F.col("text")))
    value = lambda *words: F.get(F.col("ratio"), _bucket(*words))
    pair = lambda t, i: F.when(i > 0, value(F.get(F.col("tokens"), i - 1), t)).otherwise(0.0)
    values = F.transform("tokens", lambda t, i: value(t) + pair(t, i))
    total = F.aggregate(values, F.lit(0.0), lambda s, v: s + v)
    grams = F.when(F.size("tokens") > 0, 2 * F.size("tokens") - 1)
    rows = rows.withColumn("score", F.coalesce(F.round(total / grams, 9), F.lit(0.0)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return rows.drop("text", "ratio", "tokens").withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
