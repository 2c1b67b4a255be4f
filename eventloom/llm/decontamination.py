"""Benchmark leaks: every passage of every document queries a BM25 index of the test items.

Passages are overlapping windows of two item lengths, so that each occurrence of an item lies in
one. Scores are divided by the score of the item's own text: 1 is a passage with all its words.
Verification takes no passage without most of the question, so for leaks only the question's words
count, and an item's limit is what they weigh without those that may be missing from a leak; by
itself, ``search`` takes whole items and ``THRESHOLD``. All pairs at or above the limit are retrieved
by block-max WAND, vectorised over the passages of a batch, without loss:

* Frequent terms are non-essential: in no item do they reach its limit alone, so a pair must
  share an essential term. Only essential postings are walked.
* Items stand in blocks. A passage's bound for a block is the sum of the block maxima of its
  essential terms plus the most that non-essential terms give there; lower blocks are skipped.
* Items of the remaining blocks are bounded alike, by their own essential terms and what their other terms
  weigh; those that can reach their limit are scored in full.

Retrieved pairs are then verified: shares of the question's and of the answer's five-word shingles
found in the passage (the answer is the item's last sentence). A leak has ``OVERLAP`` of the
question, and of the answer too unless the question alone has ``LONG_QUESTION`` words.

Index shards hold at most ``SHARD_BYTES`` of item text each, so what goes to executors has a fixed
bound; more items make more shards, each with one pass over the documents. Statistics (item count,
mean length, document frequencies) are those of all items.

Nulls: a null or empty text is no passage, a null or empty item can't leak; rows without an id are
kept and reported with a null id. Items of equal text are all reported, repeated item rows once.
Empty tables give no leak. Extra columns are ignored by ``leaks`` and kept by ``without_leaks``.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import BLANKS, documents, text_slices, word_codes

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, SHINGLE, LONG_QUESTION = 0.6, 0.8, 5, 13
BLOCK_ITEMS = 8
#: Pairs of a passage and a block whose bounds are held at once.
CELLS = 1 << 20
SHARD_BYTES = 8 << 20
#: A term in more than this share of the items, and more than 8, is non-essential at first.
FREQUENT = 0.02

_EDGE = r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$"
_PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def terms_of(text: str) -> list[str]:
    """Words in lower case without punctuation at their ends."""
    words = (w.decode().lower().strip(_PUNCTUATION) for w in text.encode().split())
    return [w for w in words if w]


def shingles(words: list[str], n: int) -> set[tuple[str, ...]]:
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def _expanded(at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``keys``, member) of all members ``at[key]:at[key + 1]`` of each key."""
    n = at[keys + 1] - at[keys]
    return np.repeat(np.arange(len(keys)), n), np.repeat(at[keys] - np.cumsum(n) + n, n) + np.arange(n.sum())


class Blocks(NamedTuple):
    """Impacts and limits of items, and what is known of blocks of them."""

    impacts: list[dict[int, float]]
    limits: np.ndarray
    least: np.ndarray
    essential: np.ndarray
    rest: np.ndarray
    at: np.ndarray
    block: np.ndarray
    most: np.ndarray
    item_at: np.ndarray
    item: np.ndarray
    weight: np.ndarray
    others: np.ndarray


class ItemIndex:
    """Impact-ordered blocks of one shard of items, with what verification needs."""

    def __init__(self, items: list[tuple[int, str]], n_items: int, mean_words: float,
                 frequency: dict[str, int], threshold: float) -> None:
        items = sorted({(i, t) for i, t in items if terms_of(t)}, key=lambda x: (len(terms_of(x[1])), x[0], x[1]))
        self.ids, self.threshold = [i for i, _ in items], threshold
        words = [terms_of(t) for _, t in items]
        self.longest = max(map(len, words), default=1)
        self.term_ids: dict[str, int] = {}
        self.impacts: list[dict[int, float]] = []
        for own in words:
            counts = defaultdict(int)
            for w in own:
                counts[self.term_ids.setdefault(w, len(self.term_ids))] += 1
            names = {self.term_ids[w]: w for w in own}
            length = K1 * (1 - B + B * len(own) / mean_words)
            idf = {t: math.log1p((n_items - n + 0.5) / (n + 0.5)) for t in counts for n in [frequency.get(names[t], 1)]}
            raw = {t: idf[t] * c * (K1 + 1) / (c + length) for t, c in counts.items()}
            self.impacts.append({t: v / sum(raw.values()) for t, v in raw.items()})
        self.parts = [self._question_answer(t) for _, t in items]
        self.whole = self._blocks(self.impacts, [threshold] * len(items), n_items, frequency)
        asked = [{self.term_ids[w] for part in question for w in part} for question, *_ in self.parts]
        questions = [{t: v for t, v in own.items() if t in of} for own, of in zip(self.impacts, asked)]
        limits = [self._limit(i, own) for i, own in enumerate(questions)]
        self.questions = self._blocks(questions, limits, n_items, frequency)

    @staticmethod
    def _question_answer(text: str) -> tuple:
        """Shingles of the question and of the answer, and the question's number of words."""
        sentences = [terms_of(s) for s in _SENTENCE.split(text.strip()) if terms_of(s)]
        answer = sentences.pop() if len(sentences) > 1 else []
        question = [w for s in sentences for w in s]
        return shingles(question, SHINGLE), shingles(answer, SHINGLE), len(question), len(answer)

    def _limit(self, item: int, weights: dict[int, float]) -> float:
        """A score of the question's words that every passage reaches which passes verification."""
        question = self.parts[item][0]

        def missing(parts: set) -> float:
            """At most the weight of terms that a passage with ``OVERLAP`` of the shingles lacks. It lacks all
            shingles of such a term, and a shingle has ``SHINGLE`` terms at most."""
            lacking = len(parts) - math.ceil(OVERLAP * len(parts) - 1e-9)
            room, lost = SHINGLE * lacking, 0.0
            holds = defaultdict(int)
            for part in parts:
                for w in set(part):
                    holds[self.term_ids[w]] += 1
            for t in sorted((t for t, n in holds.items() if n <= lacking), key=lambda t: -weights[t] / holds[t]):
                share = min(1.0, room / holds[t])
                room, lost = room - share * holds[t], lost + share * weights[t]
                if room <= 0:
                    break
            return lost

        return max(1e-6, math.fsum(weights.values()) - missing(question))

    def _blocks(self, impacts: list[dict[int, float]], limits: list[float], n_items: int, frequency: dict[str, int]) -> Blocks:
        often = max(8, FREQUENT * n_items)
        essential = np.array([frequency.get(w, 1) <= often for w in self.term_ids], bool)
        for own, limit in zip(impacts, limits):  # until no item can pass by non-essential terms alone
            left = sum(v for t, v in own.items() if not essential[t])
            for t in sorted((t for t in own if not essential[t]), key=lambda t: (-own[t], t)):
                if left < limit - 2e-9:
                    break
                essential[t], left = True, left - own[t]
        essential = np.append(essential, False)  # the last stands for words of no item
        n_blocks = -(-len(self.ids) // BLOCK_ITEMS)
        others = np.array([sum(v for t, v in own.items() if not essential[t]) for own in impacts])
        holders = defaultdict(list)
        for i, own in enumerate(impacts):
            for t, v in own.items():
                if essential[t]:
                    holders[t, i // BLOCK_ITEMS].append((i, v))
        keys = sorted(holders)
        at = np.searchsorted([t for t, _ in keys], np.arange(len(self.term_ids) + 1)) if keys else np.zeros(len(self.term_ids) + 1, int)
        limits = np.array(limits)
        begins = np.arange(0, len(limits), BLOCK_ITEMS)
        least, rest = (np.minimum.reduceat(limits, begins), np.maximum.reduceat(others, begins)) if n_blocks else (limits, others)
        of = [holder for k in keys for holder in holders[k]]
        return Blocks(
            impacts, limits, least, essential, rest, at, np.array([b for _, b in keys], np.int64),
            np.array([max(v for _, v in holders[k]) for k in keys]), np.cumsum([0, *(len(holders[k]) for k in keys)]),
            np.array([i for i, _ in of], np.int64), np.array([v for _, v in of]), others)

    def search(self, offsets: np.ndarray, terms: np.ndarray, by: Blocks | None = None) -> list[tuple[int, int, int, float]]:
        """(document, first word, item, score) of all passages that reach the item's limit in ``by``, else the threshold."""
        by = by or self.whole
        step, n_blocks, none = self.longest, len(by.rest), len(self.term_ids)
        at = np.flatnonzero(by.essential[terms])
        if not len(at) or not n_blocks:
            return []
        doc = np.searchsorted(offsets, at, side="right") - 1
        stride = (at - offsets[doc]) // step
        # Passage k of a document has the words [k * step, (k + 2) * step).
        doc, stride, at = np.tile(doc, 2), np.concatenate([stride, stride - 1]), np.tile(at, 2)
        keep = stride >= 0
        doc, stride, term = doc[keep], stride[keep], terms[at[keep]]
        begin = offsets[doc] + stride * step
        keys = np.sort(begin * (none + 1) + term)
        keys = keys[np.append(True, keys[1:] != keys[:-1])]  # each term once per passage
        begin, term = keys // (none + 1), keys % (none + 1)
        new = np.append(True, begin[1:] != begin[:-1])
        passage, begins = np.cumsum(new) - 1, begin[new]
        found, many = [], max(1, CELLS // n_blocks)
        for k in range(0, len(begins), many):
            part = slice(*np.searchsorted(passage, [k, k + many]))
            rows, items = self._reaching(passage[part] - k, term[part], by)
            last = None
            for row, i in zip(rows.tolist(), items.tolist()):
                if row != last:  # in order of passages
                    a, last = int(begins[k + row]), row
                    d = int(np.searchsorted(offsets, a, side="right") - 1)
                    own = set(terms[a : min(a + 2 * step, offsets[d + 1])].tolist())
                score = math.fsum(v for t, v in by.impacts[i].items() if t in own)
                if score >= by.limits[i] - 1e-9:
                    found.append((d, a - int(offsets[d]), i, score))
        return found

    @staticmethod
    def _reaching(passage: np.ndarray, term: np.ndarray, by: Blocks) -> tuple[np.ndarray, np.ndarray]:
        """(passage, item) of the pairs whose bound reaches the item's limit, of distinct (passage, term) in order."""
        n_blocks = len(by.rest)
        row, posting = _expanded(by.at, term)
        cell = passage[row] * n_blocks + by.block[posting]
        bound = np.bincount(cell, by.most[posting], (int(passage[-1]) + 1) * n_blocks).reshape(-1, n_blocks)
        left = ((bound > 0) & (bound + by.rest >= by.least - 2e-9)).ravel()
        pairs, number = np.flatnonzero(left), np.cumsum(left) - 1
        kept = left[cell]
        row, holder = _expanded(by.item_at, posting[kept])
        cell = number[cell[kept][row]] * BLOCK_ITEMS + by.item[holder] % BLOCK_ITEMS
        bound = np.bincount(cell, by.weight[holder], len(pairs) * BLOCK_ITEMS)
        at = np.flatnonzero(bound)
        pair = pairs[at // BLOCK_ITEMS]
        item = pair % n_blocks * BLOCK_ITEMS + at % BLOCK_ITEMS
        reaches = bound[at] + by.others[item] >= by.limits[item] - 2e-9
        return (pair // n_blocks)[reaches], item[reaches]

    def _ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Whether each word is a term once its punctuation is off, and its number, the last for terms of no item."""
        none = len(self.term_ids)
        terms = pc.ascii_lower(pc.utf8_trim(words, _PUNCTUATION))
        kept = pc.not_equal(terms, "").to_numpy(zero_copy_only=False)
        names = pa.array(list(self.term_ids), terms.type)
        ids = pc.fill_null(pc.index_in(terms, value_set=names), none).to_numpy(zero_copy_only=False).astype(np.int64)
        # Other alphabets have lower-case letters that only Python's ``lower`` knows.
        other = np.flatnonzero(pc.invert(pc.string_is_ascii(words)).to_numpy(zero_copy_only=False))
        for k, w in zip(other.tolist(), words.take(pa.array(other)).to_pylist()):
            ids[k] = self.term_ids.get(w.lower().strip(_PUNCTUATION), none)
        return kept, ids

    def leaks(self, texts: pa.Array) -> list[tuple[int, int, int, float, float, float]]:
        """(row, first word, item_id, score, question share, answer share) of verified pairs."""
        offsets, codes, distinct = word_codes(texts, lower=False)
        kept, ids = self._ids(distinct)
        before = np.concatenate([[0], np.cumsum(kept[codes])]) if len(codes) else np.zeros(1, np.int64)
        offsets, codes = before[offsets], codes[kept[codes]] if len(codes) else codes
        out = []
        for d, first, i, _ in self.search(offsets, ids[codes] if len(codes) else codes, self.questions):
            a = offsets[d] + first
            words = distinct.take(pa.array(codes[a : min(a + 2 * self.longest, offsets[d + 1])])).to_pylist()
            words = [w.lower().strip(_PUNCTUATION) for w in words]
            question, answer, n_question, n_answer = self.parts[i]
            q = len(question & shingles(words, min(SHINGLE, n_question))) / len(question)
            r = len(answer & shingles(words, min(SHINGLE, n_answer))) / len(answer) if answer else 1.0
            if q >= OVERLAP and (r >= OVERLAP or n_question >= LONG_QUESTION):
                own = {self.term_ids[w] for w in words if w in self.term_ids}
                score = math.fsum(v for t, v in self.impacts[i].items() if t in own)
                out.append((d, first, self.ids[i], score, q, r))
        return out


def item_indexes(items: DataFrame, threshold: float = THRESHOLD) -> Iterator[ItemIndex]:
    """Indexes over shards of ``items`` (item_id, text), with statistics of all items."""
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null").distinct()
    words = F.split(F.lower("text"), BLANKS)
    words = F.filter(F.transform(words, lambda w: F.regexp_replace(w, _EDGE, "")), lambda w: w != "")
    sized = items.withColumn("words", words).where(F.size("words") > 0)
    n, mean, size = sized.agg(F.count("*"), F.avg(F.size("words")), F.sum(F.octet_length("text"))).first()
    shards = max(1, -(-(size or 0) // SHARD_BYTES)) if n else 0
    sized = sized.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards or 1)))
    terms = sized.select("shard", F.explode(F.array_distinct("words")).alias("term"))
    counts = terms.groupBy("term").agg(F.count("*").alias("n"), F.collect_set("shard").alias("shards"))
    for k in range(shards):
        rows = [(r[0], r[1]) for r in sized.where(F.col("shard") == k).select("item_id", "text").collect()]
        frequency = dict(counts.where(F.array_contains("shards", k)).select("term", "n").collect())
        yield ItemIndex(rows, n, mean, frequency, threshold)


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, first_word, score, question_overlap, answer_overlap) of verified passages."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, first_word long, score double, question_overlap double, answer_overlap double"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = spark.createDataFrame([], schema)
    for index in item_indexes(items, threshold):
        out = out.unionByName(rows.mapInArrow(_finder(spark.sparkContext.broadcast(index)), schema))
    return out


def _finder(shared):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "item_id", "first_word", "score", "question_overlap", "answer_overlap"]
        for batch in batches:
            for piece in text_slices(batch):
                found = shared.value.leaks(piece.column("text"))
                row, first, item, *shares = zip(*found) if found else ([],) * 6
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id").take(pa.array(row, pa.int64())), pa.array(item, pa.int64()),
                    pa.array(first, pa.int64()), *(pa.array(s, pa.float64()) for s in shares)], names)

    return find


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` (all columns) in which no item leaks."""
    for index in item_indexes(items, threshold):
        docs = docs.mapInArrow(_filter(docs.sparkSession.sparkContext.broadcast(index)), docs.schema)
    return docs


def _filter(shared):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch):
                clean = np.ones(piece.num_rows, bool)
                clean[[row for row, *_ in shared.value.leaks(piece.column("text"))]] = False
                yield piece.filter(pa.array(clean))

    return keep


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaking (document, item) pairs, each with its best passage."""
    found = leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    best = F.max(F.struct("question_overlap", "answer_overlap", "score", (-F.col("first_word")).alias("place"))).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("best.place")).alias("first_word"), F.round("best.score", 6).alias("score"),
        F.col("best.question_overlap").alias("question_overlap"), F.col("best.answer_overlap").alias("answer_overlap"))
