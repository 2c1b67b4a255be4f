"""Log-likelihood of whole documents under a language model of the corpus.

1. Word counts of all training documents: partial counts per task, then one sum by word.
2. Words holding at least ``1 / HEAD_WORDS`` of all training tokens (so at most ``HEAD_WORDS`` of
   them, whatever the corpus) are sent to the tasks; the most frequent ``VOCABULARY`` are the
   recurrent model's outputs.
3. ``ROUNDS`` of training over all training documents: each task trains on its own part of them,
   then parameters are averaged by tokens in Spark.
4. One pass scores every document; its words outside the head are exploded, joined with the counts
   by word, and summed per document: no word is dropped.

The model's probability of a rare word is that of the rare class times its smoothed share of that
class, so both scores use the exact counts of all training text.

Nulls: a null text is empty (its end is one token); a null doc_id counts as the empty id text, so
it is in fold crc32('') mod 10 = 0, held out. Repeated rows count as often as they occur. Empty
tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import gated_lm
from eventloom.llm.common import doc_bucket, documents, text_slices, word_codes, written

FOLDS, SMOOTHING = 10, 0.1
HEAD_WORDS, VOCABULARY = 1_000_000, 2048
ROUNDS = 1
#: Text scored together; long documents fall behind a batch's others, so batches are large.
SCORE_BYTES = 8 << 20
END = ""  # never a word


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, train): ``train`` marks the documents that counts and parameters are learned from."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.withColumn("train", doc_bucket(F.col("doc_id"), FOLDS) != 0)


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) over all training documents; the end of a document is the word ``END``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, most=SCORE_BYTES):
                _, codes, distinct = word_codes(piece.column("text"))
                n = np.bincount(codes, minlength=len(distinct))
                seen = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [distinct.take(pa.array(seen)).cast(pa.string()), pa.array(n[seen])], ["word", "n"])
                yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([piece.num_rows])], ["word", "n"])

    partial = rows.where("train").select("text").mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


class Words:
    """The head of the counts: smoothed logs, and the recurrent model's word numbers."""

    def __init__(self, words: list[str], counts: np.ndarray) -> None:
        order = sorted(range(len(words)), key=lambda k: (-counts[k], words[k]))
        kept = [k for k in order[:VOCABULARY]]
        if END in words and words.index(END) not in kept:  # the end is always an output
            kept[-1] = words.index(END)
        self.place = {words[k]: r for r, k in enumerate(kept + sorted(set(order) - set(kept)))}
        self.head = pa.array(list(self.place), pa.large_string())
        self.n_outputs = len(kept)
        self.counts = np.array([counts[k] for k in kept + sorted(set(order) - set(kept))], float)
        self.logs = np.append(np.log10(self.counts + SMOOTHING), np.log10(SMOOTHING))

    def tokens(self, texts: pa.Array) -> tuple:
        """(offsets, place of each token in the head or -1, model inputs, codes, distinct words): ends included."""
        offsets, codes, distinct = word_codes(texts)
        place = pc.index_in(distinct, self.head)
        place = pc.fill_null(place, -1).to_numpy().astype(np.int64)
        known = (place >= 0) & (place < self.n_outputs)
        into = np.where(known, place, self.n_outputs + gated_lm.suffix_buckets(distinct))
        end = self.place.get(END, -1)
        place, into = np.append(place, end), np.append(into, end if end >= 0 else self.n_outputs)
        # Every text's words and then its end, which has the code after those of the words.
        with_end = np.full(len(codes) + len(offsets) - 1, len(distinct), np.int64)
        ends = offsets[1:] + np.arange(len(offsets) - 1)
        of_word = np.ones(len(with_end), bool)
        of_word[ends] = False
        with_end[of_word] = codes
        places, inputs = place.take(with_end), into.take(with_end)
        with_end[ends] = -1
        return offsets + np.arange(len(offsets)), places, inputs, with_end, distinct

    def sequences(self, texts: pa.Array) -> tuple:
        """(offsets, inputs, targets, places, codes, words): token t is the target of the state before
        it and the input of the state after it; target -1 is a word outside the vocabulary."""
        offsets, places, inputs, codes, words = self.tokens(texts)
        targets = np.where(places < self.n_outputs, places, -1)
        return offsets, inputs, targets, places, codes, words


def fit_parameters(rows: DataFrame, words: Words, rare: float) -> dict[str, np.ndarray]:
    """Recurrent parameters, trained where the documents are and averaged once per round."""
    p = gated_lm.fresh(words.counts[: words.n_outputs], rare)
    names, shapes = list(p), {k: v.shape for k, v in p.items()}
    sizes = [p[k].size for k in names]
    context = rows.sparkSession.sparkContext
    for _ in range(ROUNDS if words.n_outputs else 0):
        shared = context.broadcast((p, words))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, head = shared.value
            seen = 0
            for batch in batches:
                for piece in text_slices(batch):
                    offsets, inputs, targets, *_ = head.sequences(piece.column("text"))
                    own = gated_lm.train(own, inputs, targets, offsets)
                    seen += len(inputs)
            if seen:
                flat = np.concatenate([own[k].ravel() for k in names]) * np.float32(seen)
                values = np.append(flat, np.float32(seen))
                for a in range(0, len(values), 4096):
                    part = values[a : a + 4096]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.arange(a, a + len(part), dtype=np.int32)), pa.array(part.astype(np.float64))], ["k", "v"])

        sums = rows.where("train").select("text").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v"))
        found = sums.toPandas()  # as many rows as the model has parameters
        if found.empty:
            break
        values = found.sort_values("k")["v"].to_numpy()
        mean = (values[:-1] / values[-1]).astype(np.float32)
        p = {k: part.reshape(shapes[k]) for k, part in zip(names, np.split(mean, np.cumsum(sizes)[:-1]))}
    return p


def scored_parts(rows: DataFrame, words: Words, p: dict[str, np.ndarray]) -> DataFrame:
    """Per document what its head words give, and its other words with their counts."""
    shared = rows.sparkSession.sparkContext.broadcast((p, words))
    fields = ("row long, doc_id long, n_tokens long, n_known long, logs double, rare_logs double, n_rare long,"
              " model double, tail array<struct<word:string,n:long>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, head = shared.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for piece in text_slices(batch, most=SCORE_BYTES):
                offsets, inputs, targets, places, codes, names = head.sequences(piece.column("text"))
                n, lengths = piece.num_rows, np.diff(offsets)
                owner = np.repeat(np.arange(n), lengths)
                logs = head.logs[places]
                add = lambda w: np.bincount(owner, w, n)
                outside = (places < 0) & (codes >= 0)
                rare = (targets < 0) & ~outside & (codes >= 0)
                keys, counts = np.unique(owner[outside] * len(names) + codes[outside], return_counts=True)
                begins = np.searchsorted(keys, np.arange(n + 1) * len(names)) if len(names) else np.zeros(n + 1, int)
                tail = pa.StructArray.from_arrays([
                    names.take(pa.array(keys % max(len(names), 1))).cast(pa.string()), pa.array(counts)], ["word", "n"])
                model = gated_lm.score(own, inputs, targets, offsets) if head.n_outputs else np.zeros(n)
                integer = lambda v: pa.array(v.astype(np.int64))
                yield pa.RecordBatch.from_arrays([
                    pa.array(row + np.arange(n)), piece.column("doc_id"), pa.array(lengths),
                    integer(add(~outside & (places >= 0))), pa.array(add(np.where(outside, 0.0, logs))),
                    pa.array(add(np.where(rare, logs, 0.0))), integer(add((targets < 0) & (codes >= 0))), pa.array(model),
                    pa.ListArray.from_arrays(pa.array(begins, pa.int32()), tail),
                ], NAMES)
                row += n

    NAMES = ["row", "doc_id", "n_tokens", "n_known", "logs", "rare_logs", "n_rare", "model", "tail"]
    return rows.select("doc_id", "text").mapInArrow(run, fields)


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    rows = _rows(docs)
    counts = written(word_counts(rows), "word-counts")
    n_train, n_words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = counts.where((F.col("n") * HEAD_WORDS >= n_train) | (F.col("word") == END)).toPandas()
    words = Words(head["word"].tolist(), head["n"].to_numpy())
    n_rare = n_train - words.counts[: words.n_outputs].sum()
    rare_total = float(np.log10(n_rare + SMOOTHING * (n_words - words.n_outputs + 1)))
    total = float(np.log10(n_train + SMOOTHING * (n_words + 1)))
    parts = written(scored_parts(rows, words, fit_parameters(rows, words, n_rare)), "scored")
    tail = parts.select("row", F.explode("tail").alias("t")).select("row", "t.word", F.col("t.n").alias("times"))
    logs = F.log10(F.coalesce("n", F.lit(0)) + SMOOTHING)
    tail = tail.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * logs).alias("tail_logs"), F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("tail_known"))
    tail_logs = F.coalesce("tail_logs", F.lit(0.0))
    return parts.drop("tail").join(tail, "row", "left").select(
        "doc_id", (doc_bucket(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(int(n_train)).cast("long").alias("train_tokens"),
        (F.col("logs") + tail_logs - F.col("n_tokens") * total).alias("base_score"),
        (F.col("model") + F.col("rare_logs") + tail_logs - F.col("n_rare") * rare_total).alias("score"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
