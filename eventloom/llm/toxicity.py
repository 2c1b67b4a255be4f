"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max index.

Terms are whole words and word beginnings of 3 to 6 letters, so that unseen forms of a stem still
count. The vocabulary keeps the terms whose document frequency differs most between the labels
(chi-square). Examples are a sample of labelled rows, at most ``MAX_EXAMPLES``, the smallest
hashes of doc_id; only rows whose crc32(doc_id) mod ``FOLDS`` is not 0 are learned from.

Index: examples stand in blocks; every term keeps its largest weight per block. A document's upper
bound for a block is the sum of its weights times these maxima. The best blocks are scored first;
blocks whose bound lies under the k-th cosine found can't hold a nearer example and are skipped, so
the neighbours are exact. Their votes, weighted by cosine, are calibrated by isotonic regression on
the examples' own leave-one-out votes. Documents without a term have no neighbour and get the
share of toxic rows among examples without terms.

Nulls: a null text is empty; null labels are ignored; of several labels of one doc_id the largest
counts, of several texts the smallest is the example. Repeated rows are scored each. Without any
label every score is 0. Empty tables give no rows; extra columns never enter a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import doc_bucket, documents, text_slices, word_codes, written

FOLDS = 5
#: Bounds of what is collected and sent to executors: examples and terms (about 20 MB).
MAX_EXAMPLES, MAX_TERMS = 20_000, 4096
MIN_DOCUMENTS, MIN_CHI_SQUARE = 3, 25.0
NEIGHBOURS, BLOCK_EXAMPLES, FIRST_BLOCKS = 25, 32, 8
PREFIXES = (3, 4, 5, 6)
_PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def word_terms(word: str) -> list[str]:
    """Terms of one word: itself and its beginnings, marked by ``^``."""
    word = word.lower().strip(_PUNCTUATION)
    return [word, *("^" + word[:n] for n in PREFIXES if len(word) >= n)] if word else []


class Model:
    """Terms, examples and calibration; small, sent to every task."""

    def __init__(self, terms: list[str], idf: np.ndarray) -> None:
        self.terms, self.idf = {t: k for k, t in enumerate(terms)}, idf
        self.empty_score = 0.0
        self.steps = (np.array([0.0]), np.array([0.0]))

    def vectors(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """(term ids, weights of length 1) of each text."""
        offsets, codes, distinct = word_codes(texts, lower=False)
        known = [[self.terms[t] for t in word_terms(w) if t in self.terms] for w in distinct.to_pylist()]
        at = np.flatnonzero(np.array([bool(k) for k in known], bool)[codes]) if len(codes) else codes
        owner = np.searchsorted(offsets, at, side="right") - 1
        found: list[list[int]] = [[] for _ in range(len(offsets) - 1)]
        for d, c in zip(owner.tolist(), codes[at].tolist()):
            found[d] += known[c]
        return [self._vector(ids) for ids in found]

    def _vector(self, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        terms, n = np.unique(np.array(ids, np.int64), return_counts=True)
        weights = (1 + np.log(n)) * self.idf[terms] if len(terms) else np.empty(0)
        return terms, weights / (np.sqrt((weights**2).sum()) or 1.0)

    def learn(self, examples: list[tuple[int, int, np.ndarray, np.ndarray]]) -> None:
        """Index examples (doc_id, label, term ids, weights) and calibrate on them."""
        empty = [y for _, y, t, _ in examples if not len(t)]
        examples = [x for x in examples if len(x[2])]
        # Examples with the same strongest term stand together: block maxima stay close to weights.
        examples.sort(key=lambda x: (int(x[2][np.argmax(x[3])]), -float(x[3].max()), x[0]))
        self.ids = np.array([x[0] for x in examples], np.int64)
        self.labels = np.array([x[1] for x in examples], np.float64)
        sizes = np.array([len(x[2]) for x in examples], np.int64)
        self.starts = np.append(0, np.cumsum(sizes))
        self.term = np.concatenate([x[2] for x in examples]) if examples else np.empty(0, np.int64)
        self.weight = np.concatenate([x[3] for x in examples]) if examples else np.empty(0)
        self.row = np.repeat(np.arange(len(examples)), sizes)
        self.blocks = -(-len(examples) // BLOCK_EXAMPLES)
        key = self.term * max(self.blocks, 1) + self.row // BLOCK_EXAMPLES
        keys, place = np.unique(key, return_inverse=True)
        self.most = np.zeros(len(keys))
        np.maximum.at(self.most, place, self.weight)
        self.most_block = keys % max(self.blocks, 1)
        self.most_at = np.searchsorted(keys // max(self.blocks, 1), np.arange(len(self.terms) + 1))
        share = float(self.labels.mean()) if len(self.labels) else 0.0
        self.empty_score = (sum(empty) + share) / (len(empty) + 1) if examples or empty else 0.0
        votes = [self.vote(x[2], x[3], without=k) for k, x in enumerate(examples)]
        self.steps = isotonic(np.array(votes), self.labels, share)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the ``NEIGHBOURS`` nearest ones, exact; ties by index order."""
        n = self.most_at[terms + 1] - self.most_at[terms]
        place = np.repeat(self.most_at[terms] - np.cumsum(n) + n, n) + np.arange(n.sum())
        bound = np.bincount(self.most_block[place], np.repeat(weights, n) * self.most[place], self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        query = np.zeros(len(self.terms))
        query[terms] = weights
        rows, cosines = self._score(order[:FIRST_BLOCKS], query, without)
        least = np.sort(cosines)[-NEIGHBOURS] if len(cosines) >= NEIGHBOURS else 0.0
        rest = order[FIRST_BLOCKS:]
        more = self._score(rest[bound[rest] >= least - 1e-12], query, without)
        rows, cosines = np.concatenate([rows, more[0]]), np.concatenate([cosines, more[1]])
        best = np.lexsort((rows, -cosines))[:NEIGHBOURS]
        return rows[best], cosines[best]

    def _score(self, blocks: np.ndarray, query: np.ndarray, without: int) -> tuple[np.ndarray, np.ndarray]:
        if not len(blocks):
            return np.empty(0, np.int64), np.empty(0)
        first = blocks * BLOCK_EXAMPLES
        last = np.minimum(first + BLOCK_EXAMPLES, len(self.ids))
        a, n = self.starts[first], self.starts[last] - self.starts[first]
        place = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
        dots = np.bincount(self.row[place], self.weight[place] * query[self.term[place]], len(self.ids))
        rows = np.flatnonzero(dots > 1e-9)
        rows = rows[rows != without]
        return rows, dots[rows]

    def vote(self, terms: np.ndarray, weights: np.ndarray, without: int = -1) -> float:
        rows, cosines = self.nearest(terms, weights, without)
        return float((cosines * self.labels[rows]).sum() / cosines.sum()) if len(rows) else 0.0

    def score(self, terms: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """(calibrated score, neighbours, cosines)."""
        rows, cosines = self.nearest(terms, weights) if len(terms) and self.blocks else (np.empty(0, np.int64), np.empty(0))
        if not len(rows):
            return self.empty_score, rows, cosines
        vote = (cosines * self.labels[rows]).sum() / cosines.sum()
        return float(np.interp(vote, *self.steps)), rows, cosines


def isotonic(votes: np.ndarray, labels: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Rising calibration of votes: pooled neighbours, each pool drawn to ``share`` by one row."""
    pools: list[list[float]] = []  # rows, positives, sum of votes
    for v, y in sorted(zip(votes.tolist(), labels.tolist())):
        pools.append([1, y, v])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            n, p, s = pools.pop()
            pools[-1] = [pools[-1][0] + n, pools[-1][1] + p, pools[-1][2] + s]
    if not pools:
        return np.array([0.0]), np.array([share])
    at, value = np.array([[s / n, (p + share) / (n + 1)] for n, p, s in pools]).T
    return at, np.maximum.accumulate(value)


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, text) of at most ``MAX_EXAMPLES`` labelled rows outside the held-out fold."""
    rows = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("doc_id is not null and toxic is not null")
    rows = rows.where(doc_bucket(F.col("doc_id"), FOLDS) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_EXAMPLES)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # At most MAX_EXAMPLES ids and labels are broadcast.
    return texts.join(F.broadcast(rows), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))


def term_counts(sample: DataFrame) -> DataFrame:
    """(term, toxic, clean): documents of either label that hold a term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch):
                offsets, codes, distinct = word_codes(piece.column("text"), lower=False)
                terms = [word_terms(w) for w in distinct.to_pylist()]
                counts = (Counter(), Counter())
                for d, y in enumerate(piece.column("toxic").to_pylist()):
                    own = np.unique(codes[offsets[d] : offsets[d + 1]]).tolist()
                    counts[y > 0].update({t for c in own for t in terms[c]})
                names = list(counts[0].keys() | counts[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), *(pa.array([c[t] for t in names], pa.int64()) for c in reversed(counts))],
                    ["term", "toxic", "clean"])

    partial = sample.select("toxic", "text").mapInArrow(count, "term string, toxic long, clean long")
    return partial.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model of a bounded sample of labelled rows; what is collected is bounded by the sample."""
    sample = written(training_sample(docs, labels), "examples")
    of = {bool(y): n for y, n in sample.groupBy(F.col("toxic") > 0).count().collect()}
    a, b, n1, n0 = F.col("toxic"), F.col("clean"), of.get(True, 0), of.get(False, 0)
    if not n1 or not n0:
        model = Model([], np.empty(0))
        model.learn([])
        model.empty_score = 1.0 if n1 else 0.0
        return model
    cross = a * (n0 - b) - b * (n1 - a)
    rest = (a + b) * (n1 + n0 - a - b) * float(n1) * float(n0)
    chi = (cross.cast("double") * cross * float(n1 + n0)) / F.greatest(rest.cast("double"), F.lit(1.0))
    top = term_counts(sample).where(a + b >= MIN_DOCUMENTS).withColumn("chi", chi).where(F.col("chi") >= MIN_CHI_SQUARE)
    top = top.orderBy(F.desc("chi"), "term").limit(MAX_TERMS).select("term", (a + b).alias("n")).collect()
    model = Model([r.term for r in top], np.log((1 + n0 + n1) / (1 + np.array([r.n for r in top], float))) + 1)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch):
                found = model.vectors(piece.column("text"))
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), piece.column("toxic"),
                    pa.array([t for t, _ in found], pa.list_(pa.int64())), pa.array([w for _, w in found], pa.list_(pa.float64())),
                ], ["doc_id", "toxic", "terms", "weights"])

    rows = sample.select("doc_id", "toxic", "text").mapInArrow(vectors, "doc_id long, toxic int, terms array<long>, weights array<double>")
    model.learn([(r[0], int(r[1] > 0), np.array(r[2], np.int64), np.array(r[3], float)) for r in rows.toLocalIterator()])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, neighbours, terms): the evidence is the nearest examples and the terms found."""
    shared, fields = docs.sparkSession.sparkContext.broadcast(model), "doc_id long, score double, neighbours array<struct<doc_id:long,cosine:double,toxic:int>>, terms array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = list(own.terms)
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
        for batch in batches:
            for piece in text_slices(batch):
                found = [(t, *own.score(t, w)) for t, w in own.vectors(piece.column("text"))]
                near = [
                    [{"doc_id": int(own.ids[k]), "cosine": float(c), "toxic": int(own.labels[k])} for k, c in zip(rows, cosines)]
                    for _, _, rows, cosines in found
                ]
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), pa.array([f[1] for f in found], pa.float64()), pa.array(near, kind),
                    pa.array([[names[t] for t in f[0]] for f in found], pa.list_(pa.string())),
                ], ["doc_id", "score", "neighbours", "terms"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, fields)


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` (all columns) that score under the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for piece in text_slices(batch):
                yield piece.filter(pa.array([own.score(t, w)[0] < threshold for t, w in own.vectors(piece.column("text"))], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select(
        "doc_id", (doc_bucket(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
