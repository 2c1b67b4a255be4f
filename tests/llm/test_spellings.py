"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from eventloom.llm import spellings


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def counts(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def forms(words):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and edits(v, w) == 1] for w in words}
    out = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        out[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        return w if out[w] is None else root(out[w])

    return {(w, out[w], root(w), words[w], len(near[w]), words[out[w]] if out[w] else None) for w in words}


def vocabulary(seed):
    """Words around few stems at one and two edits, so that prefixes and suffixes are shared by many."""
    rng = random.Random(seed)
    letters = "abcdeéßÿ"
    stems = ["".join(rng.choice(letters) for _ in range(n)) for n in (6, 7, 9, 12, 13)] + ["aaaaaaa", "abababab"]
    words = set(stems)
    for _ in range(500):
        word = rng.choice(stems)
        for _ in range(rng.randint(1, 2)):
            at, kind = rng.randrange(len(word)), rng.randrange(3)
            word = word[:at] + ("" if kind == 0 else rng.choice(letters)) + word[at + (kind != 1) :]
        words.add(word)
    return {w: rng.choice([5, 6, 30, 31, 200, 2000]) for w in words if len(w) >= 6}


@pytest.mark.parametrize("dense", [64, 2])
def test_variants_equal_all_pairs(spark, monkeypatch, dense):
    """Few keys are dense, then almost all, down to the last letter."""
    monkeypatch.setattr(spellings, "DENSE", dense)
    words = vocabulary(dense)
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    found = spellings.variants(table).collect()
    assert len(found) == len(words) and set(map(tuple, found)) == forms(words)
    assert any(r.root not in (r.word, r.form) for r in found)
    assert sum(r.n_near for r in found) > len(found)


def test_each_pair_comes_once_and_in_the_join(spark):
    words = spark.createDataFrame([(w, n) for w, n in vocabulary(3).items()], "word string, n long")
    pairs = [tuple(r) for r in spellings.near_pairs(words).collect()]
    assert len(pairs) == len(set(pairs)) and not {(b, a) for a, b in pairs} & set(pairs)


def test_counts_of_whole_texts(table, odd, monkeypatch):
    rng = random.Random(2)
    pool = ["Mañana", "Größere", "tomorrow", "ABERRANT", "kürzer", "naïvety", "étude", "x×y÷zabc", "İstanbul"]
    texts = [" ".join(rng.choices(pool, k=60)) + rng.choice([",", " ", "日本"]) for _ in range(120)] + ["longest " * 30_000, None, ""]
    ids = [*range(121), None, None]
    wanted = counts(zip(ids, texts))
    assert "ongest" not in wanted and any(len(w) < 8 and w not in (p.lower() for p in pool) for w in wanted)
    for gather in (spellings.GATHER, 3):
        monkeypatch.setattr(spellings, "GATHER", gather)
        assert {r.word: r.n for r in spellings.word_counts(table(texts, ids)).collect()} == wanted
    found = {r.word: r.n for r in spellings.word_counts(odd).collect()}
    assert found == counts((r.doc_id, r.text) for r in odd.collect())


def test_empty_and_lonely(spark, table):
    assert spellings.variants(spellings.word_counts(table([]))).count() == 0
    found = spellings.variants(spark.createDataFrame([("lonely", 7)], "word string, n long")).collect()
    assert list(map(tuple, found)) == [("lonely", None, "lonely", 7, 0, None)]
