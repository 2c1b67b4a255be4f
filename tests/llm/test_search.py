import math
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from eventloom.llm import decontamination as leak
from eventloom.llm import toxicity
from eventloom.llm.common import word_codes
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.01"


def items_of(spark, texts):
    return spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "item_id long, text string, doc_id int")


def made_items(rng, n):
    common, rare = ["the", "of", "and", "in"], [f"r{k}" for k in range(120)]
    return [" ".join(rng.choice(common if rng.random() < 0.6 else rare) for _ in range(rng.randint(5, 25))) + "." for _ in range(n)]


def scores(items, passage):
    """BM25 of every item for a passage, over the score of the item's own text."""
    words = [leak.terms_of(t) for t in items]
    n, mean = len(items), sum(map(len, words)) / len(items)
    often = Counter(w for own in words for w in set(own))
    out = []
    for own in words:
        part = {}
        for w, c in Counter(own).items():
            idf = math.log1p((n - often[w] + 0.5) / (often[w] + 0.5))
            part[w] = idf * c * (leak.K1 + 1) / (c + leak.K1 * (1 - leak.B + leak.B * len(own) / mean))
        out.append(sum(v for w, v in part.items() if w in passage) / sum(part.values()))
    return out


@pytest.mark.parametrize("threshold", [0.25, 0.6])
def test_search_finds_every_pair_above_the_threshold(spark, threshold):
    rng = random.Random(2)
    items = made_items(rng, 60)
    docs = [" ".join(made_items(rng, rng.randint(0, 12))) + " " + " ".join(rng.sample(items, 2)) for _ in range(8)] + [""]
    (index,) = leak.item_indexes(items_of(spark, items), threshold)
    step, words = index.longest, [leak.terms_of(d) for d in docs]
    offsets = np.cumsum([0, *map(len, words)])
    terms = np.array([index.term_ids.get(w, len(index.term_ids)) for own in words for w in own], np.int64)
    found = {(d, a, index.ids[i]): s for d, a, i, s in index.search(offsets, terms)}
    wanted = {}
    for d, own in enumerate(words):
        for a in range(0, max(len(own), 1), step):
            for i, s in enumerate(scores(items, set(own[a : a + 2 * step]))):
                if s >= threshold:
                    wanted[d, a, i] = s
    assert found.keys() == wanted.keys() and len(wanted) > 10
    assert all(abs(found[k] - wanted[k]) < 1e-9 for k in wanted)


def test_leaks_and_clean_rows(spark, table, monkeypatch):
    rng = random.Random(4)
    items = made_items(rng, 20) + [None, "", "Which of r1 r2 r3 r4 r5 r6 is it? The answer r7."]
    plain = " ".join(f"z{k}" for k in range(300))
    texts = [plain, plain + " " + items[3].upper() + " " + plain, items[22], None, "", plain, "which r1 r2"]
    docs = table(texts)
    for limit in (leak.SHARD_BYTES, 600):  # one shard, then several
        monkeypatch.setattr(leak, "SHARD_BYTES", limit)
        found = {(r.doc_id, r.item_id) for r in leak.leaks(docs, items_of(spark, items)).collect()}
        assert found == {(1, 3), (2, 22)}
        kept = leak.without_leaks(docs, items_of(spark, items))
        assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4, 5, 6] and kept.columns == docs.columns


def test_leaks_equal_verification_without_retrieval(spark, table):
    """Questions alone, whole items and parts of both: what verification takes is retrieved."""
    rng = random.Random(12)
    common = [f"c{k}" for k in range(30)]
    items = []
    for k in range(60):
        question = [rng.choice(common) if rng.random() < 0.7 else f"q{rng.randrange(200)}" for _ in range(rng.randint(6, 24))]
        answer = [f"a{k}x{j}" for j in range(rng.randint(1, 12))]
        items.append(" ".join(question) + "? " + " ".join(answer) + ".")
    texts = []
    for item in items:
        question, answer = item.split("? ")
        words = question.split()
        for at in rng.sample(range(len(words)), rng.choice([0, 0, 1])):
            words[at] = "other"
        texts.append("z " * rng.randrange(40) + " ".join(words) + rng.choice(["", " y y", " " + answer]) + " z" * rng.randrange(40))
    (index,) = leak.item_indexes(items_of(spark, items))
    wanted = set()
    for d, text in enumerate(texts):
        own = leak.terms_of(text)
        for a in range(0, max(len(own), 1), index.longest):
            words = own[a : a + 2 * index.longest]
            for i, (question, answer, n, m) in enumerate(index.parts):
                q = len(question & leak.shingles(words, min(leak.SHINGLE, n))) / len(question)
                r = len(answer & leak.shingles(words, min(leak.SHINGLE, m))) / len(answer)
                if q >= leak.OVERLAP and (r >= leak.OVERLAP or n >= leak.LONG_QUESTION):
                    wanted.add((d, a, index.ids[i]))
    found = {(r[0], r[1], r[2]) for r in index.leaks(pa.array(texts))}
    assert found == wanted and len({d for d, *_ in wanted}) > 25
    low = {(r[0], r[1], r[2]) for r in index.leaks(pa.array(texts)) if r[3] < leak.THRESHOLD}
    assert low  # these a limit of THRESHOLD would lose


def test_leaks_of_odd_and_empty_tables(spark, odd, table):
    assert leak.leaks(odd, items_of(spark, ["word " * 50, None])).where("question_overlap < 0.8").count() == 0
    assert leak.leaks(table([]), items_of(spark, ["a b c"])).count() == 0
    assert leak.leaks(odd, items_of(spark, [])).count() == 0
    assert leak.without_leaks(odd, items_of(spark, [])).count() == len(ODD)


def model_of(n_terms, examples):
    model = toxicity.Model([f"t{k}" for k in range(n_terms)], np.ones(n_terms))
    model.learn(examples)
    return model


def test_neighbours_are_exact():
    rng = np.random.default_rng(1)
    examples = []
    for k in range(700):
        terms = np.sort(rng.choice(80, rng.integers(0, 12), replace=False))
        weights = rng.random(len(terms)) + 0.1
        examples.append((k, int(rng.random() < 0.3), terms, weights / max(np.sqrt((weights**2).sum()), 1e-9)))
    model = model_of(80, examples)
    dense = np.zeros((len(model.ids), 80))
    dense[model.row, model.term] = model.weight
    for _ in range(60):
        terms = np.sort(rng.choice(80, rng.integers(1, 9), replace=False))
        weights = rng.random(len(terms)) + 0.01
        weights /= np.sqrt((weights**2).sum())
        query = np.zeros(80)
        query[terms] = weights
        wanted = np.sort((dense @ query)[dense @ query > 1e-9])[::-1][: toxicity.NEIGHBOURS]
        rows, cosines = model.nearest(terms, weights)
        assert np.allclose(cosines, wanted) and np.allclose((dense @ query)[rows], cosines)


def test_isotonic_rises():
    at, value = toxicity.isotonic(np.array([0.1, 0.2, 0.2, 0.5, 0.9]), np.array([0, 1, 0, 0, 1.0]), 0.4)
    assert (np.diff(at) > 0).all() and (np.diff(value) >= 0).all() and 0 <= value.min() and value.max() <= 1


def test_held_out_accuracy(spark):
    rows = toxicity.op7_toxicity(spark, "/root/testdata/sf0.1").where("held_out")
    rows = rows.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    caught = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    assert right >= 0.95 and caught >= 0.8


def test_toxicity_of_odd_and_empty_tables(spark, odd, table):
    labels = spark.createDataFrame([(1, 1, None), (2, None, 0), (None, 1, 1), (3, 1, 1), (3, 0, 0)], "doc_id long, toxic int, quality int")
    for rows in (labels, labels.where("false"), labels.where("doc_id = 1")):
        found = toxicity.score(odd, toxicity.fit(odd, rows)).collect()
        assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    kept = toxicity.without_toxic(odd, toxicity.fit(odd, labels.where("false")))
    assert kept.count() == len(ODD) and kept.columns == odd.columns
    assert toxicity.score(table([]), toxicity.fit(table([]), labels)).count() == 0


def test_labels_and_names_are_no_inputs(spark, table):
    texts = [f"bad{k % 3} word" if k % 2 else "good word" for k in range(60)]
    docs = table(texts)
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert "^bad" in model.terms
    ids, scores_ = zip(*((r.doc_id, r.score) for r in toxicity.score(docs, model).collect()))
    by_text = {}
    for i, s in zip(ids, scores_):
        by_text.setdefault(texts[i], set()).add(s)
    assert all(len(v) == 1 for v in by_text.values()) and min(by_text["bad1 word"]) > 0.8 > 0.2 > max(by_text["good word"])


def test_vectors_have_length_one(table):
    model = model_of(3, [])
    (empty, _), (terms, weights) = model.vectors(pa.array([None, "t0 T1, t1 zz"]))
    assert not len(empty) and terms.tolist() == [0, 1] and abs((weights**2).sum() - 1) < 1e-12


def test_only_items_within_reach_are_scored(monkeypatch):
    """A block that holds one item of a passage doesn't have its other items scored in full."""
    items = [(i, " ".join(f"w{i}x{j}" for j in range(12)) + " shared") for i in range(8)]
    frequency = {w: 1 for _, t in items for w in t.split()} | {"shared": 8}
    index = leak.ItemIndex(items, 8, 13.0, frequency, 0.6)
    offsets, codes, distinct = word_codes(pa.array([items[3][1], "w5x0 shared w6x1", None]), lower=False)
    ids = np.array([index.term_ids.get(w, len(index.term_ids)) for w in distinct.to_pylist()])
    scored = []
    monkeypatch.setattr(leak, "math", SimpleNamespace(fsum=lambda v: scored.append(1) or math.fsum(v)))
    found = index.search(offsets, ids[codes])
    assert [(d, first, i) for d, first, i, _ in found] == [(0, 0, 3)] and len(scored) == 1


def test_terms_of_many_alphabets_are_those_of_python():
    words = ["İstanbul,", "(ΣΑΣ)", "STRASSE.", "...", "ẞ'", "a-b!", "日本", "K"]
    index = leak.ItemIndex([(1, " ".join(words))], 1, 8.0, {}, 0.6)
    kept, ids = index._ids(pa.array([*words, "absent", "'Stanbul"], pa.large_string()))
    assert kept.tolist() == [True, True, True, False, True, True, True, True, True, True]
    terms = {v: k for k, v in index.term_ids.items()}
    wanted = [w.lower().strip(leak._PUNCTUATION) for w in words]
    assert [terms.get(i, "") for i in ids.tolist()[:8]] == [w if w else "" for w in wanted] and set(ids.tolist()[8:]) == {len(terms)}
