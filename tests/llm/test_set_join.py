"""The set join against all pairs of sets."""

import random

import pyarrow as pa
import pytest

from eventloom.llm import set_join
from tests.llm.conftest import ODD


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def wanted(rows):
    """{(doc_id, n, component_id)} of rows (doc_id, text) with ids, over all pairs."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]) and label[a] != label[b]:
                x, y = label[a], label[b]
                label = [min(x, y) if v in (x, y) else v for v in label]
    least = {}
    for k, v in enumerate(label):
        least[v] = min(least.get(v, rows[k][0]), rows[k][0])
    return sorted((rows[k][0], len(sets[k]), least[v]) for k, v in enumerate(label))


def copies(seed, families, each, edits, sizes=(4, 9, 40, 120, 400)):
    """Families of texts, each a changed copy of one before, so that similarities lie on both sides of the bound."""
    rng = random.Random(seed)
    texts = []
    for _ in range(families):
        words = [f"w{rng.randrange(2000)}" for _ in range(rng.choice(sizes))]
        family = [words]
        for _ in range(each - 1):
            words = list(rng.choice(family))
            for _ in range(rng.choice(edits)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(2000)}"
            family.append(words)
        texts += [" ".join(w) for w in family]
    return texts


@pytest.mark.parametrize("block", [512, 3])
def test_components_equal_all_pairs(table, monkeypatch, block):
    monkeypatch.setattr(set_join, "BLOCK", block)
    texts = copies(block, 14, 9, [0, 1, 1, 2, 4]) + ["", "one", "one two", "ONE two", "one two three", None]
    ids = random.Random(1).sample(range(1000), len(texts))
    found = set_join.similar_sets(table(texts, ids)).collect()
    assert sorted(map(tuple, found)) == wanted(list(zip(ids, texts)))
    assert any(i != c for i, _, c in found)


@pytest.mark.parametrize("worthwhile", [0.2, 1.0])
def test_many_copies_around_one_text(table, monkeypatch, worthwhile):
    """One dense group at and below the bound: by hub rounds, and with everything left to the last step."""
    monkeypatch.setattr(set_join, "WORTHWHILE", worthwhile)
    monkeypatch.setattr(set_join, "BLOCK", 16)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(200)]
    texts = []
    for k in range(120):
        words = list(base)
        for at in rng.sample(range(200), rng.choice([2, 3, 4, 5])):
            words[at] = f"x{k}y{at}"
        texts.append(" ".join(words))
    found = set_join.similar_sets(table(texts)).collect()
    assert sorted(map(tuple, found)) == wanted(list(enumerate(texts)))
    assert 1 < len({r.component_id for r in found}) < 120


def test_copies_just_below_the_bound_make_no_pairs(spark, table):
    """Each differs from the base in shingles of its own; rare ones come first, so no prefix meets another."""
    base = [f"w{k}" for k in range(300)]
    texts = [" ".join(f"x{k}" if at % 28 == k % 28 else w for at, w in enumerate(base)) for k in range(100)]
    sets = set_join.whole_sets(table(texts), spark.createDataFrame(
        [(r.doc_id, r.t1, r.t2) for r in set_join.text_rows(table(texts)).collect()], "node long, t1 long, t2 long"))
    assert set_join.prefixes(sets).count() == 0
    assert {r.component_id for r in set_join.similar_sets(table(texts)).collect()} == set(range(100))


def test_bound_itself_links(table):
    """18 of 20 shingles in common: exactly 90 percent; 17 of 19 is less."""
    words = [f"w{k}" for k in range(21)]
    both = [" ".join(words[:20]), " ".join(words[1:21]), " ".join(words[:20]) + " q r s"]
    assert wanted(list(enumerate(both))) == sorted(map(tuple, set_join.similar_sets(table(both)).collect()))


def test_reduction_keeps_every_linked_pair(spark):
    rng = random.Random(9)
    universe = [rng.getrandbits(64) for _ in range(400)]
    for n in (1, 2, 9, 10, 11, 19, 20, 50, 99, 100, 300):
        x = set(rng.sample(universe, n))
        y = set(x)
        while 100 * len(x & y) >= 90 * len(x | y):
            last = set(y)
            y.remove(rng.choice(sorted(x & y)))
        low = [sorted(v)[: 2 * set_join._prefix(len(v)) - 1] for v in (x, last)]
        met = len(set(low[0]) & set(low[1]))
        assert all(met >= set_join._prefix(set_join._least(len(v))) for v in (x, last))


def test_sets_of_odd_texts():
    sets = set_join.shingle_sets(pa.array(ODD))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in ODD]
    one, two, three = set_join.shingle_sets(pa.array(["a", "a b", "a b c"]))
    assert len({*one.tolist(), *two.tolist(), *three.tolist()}) == 3
    assert (set_join.shingle_sets(pa.array(["x y z a B c", "q"]).slice(0, 1))[0] == set_join.shingle_sets(pa.array(["X y z a b c"]))[0]).all()


def test_odd_rows(odd, table):
    rows = set_join.similar_sets(odd).collect()
    assert len(rows) == len(ODD)
    assert {(r.doc_id, r.component_id) for r in rows if r.n == 0} == {(None, None), (5, 5)}
    same = set_join.similar_sets(table(["a b c d", "A  b c d", "a b c d", "z"], [None, 3, 3, None])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in same) == [(0, 0), (0, 3), (3, 3), (3, 3)]
    assert set_join.similar_sets(table([])).count() == 0
