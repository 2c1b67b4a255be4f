import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

import corpus_pipeline
from eventloom.llm import line_dedup, near_copies, simhash
from eventloom.llm.components import components
from tests.llm.conftest import ODD


def groups(n, pairs):
    label = list(range(n))
    for a, b in pairs:
        x, y = label[a], label[b]
        if x != y:
            label = [min(x, y) if v in (x, y) else v for v in label]
    return label


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(k, k + 1) for k in range(100, 140)]
    found = {r.node: r.label for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    wanted = groups(141, pairs)
    linked = {v for a, b in pairs if a != b for v in (a, b)}
    assert found == {v: wanted[v] for v in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(odd):
    assert sorted(r.fp % 2**64 for r in simhash.fingerprints(odd).collect()) == sorted(map(fingerprint, ODD))


@pytest.mark.parametrize("dense", [64, 2])
def test_links_give_all_components(spark, monkeypatch, dense):
    """Random centers, chains of flips around them, and a dense ball; either with the dense step."""
    monkeypatch.setattr(simhash, "DENSE", dense)
    rng = random.Random(dense)
    values = {0, 2**64 - 1, 1, 1 << 63}
    for _ in range(30):
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            values.add(v)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                v ^= 1 << b
    center = rng.getrandbits(64)
    values |= {center ^ (1 << a) ^ (1 << b) for a in range(8) for b in range(8)}
    values = sorted(values)
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    rows = spark.createDataFrame([(v,) for v in signed], "fp long")
    pairs = [(signed.index(r.a), signed.index(r.b)) for r in simhash.links(rows).collect()]
    assert all((values[a] ^ values[b]).bit_count() <= 3 for a, b in pairs)
    close = [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 3]
    assert groups(len(values), pairs) == groups(len(values), close)


def test_near_duplicates_of_odd_rows(odd, table):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    empty = [r for r in rows if r.fp == 0]
    assert {r.component_id for r in empty} == {5} and any(r.doc_id is None for r in empty)
    assert simhash.near_duplicates(table([])).count() == 0


def test_near_copy_stage_equals_brute_force(spark, table):
    """Chains of copies at all similarities: components of Jaccard 0.8 over five words, smallest row kept."""
    rng = random.Random(11)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([4, 30, 120, 300]))]
        for _ in range(8):
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(rng.choice([0, 1, 2, 6])):
                words[rng.randrange(len(words))] = f"w{rng.randrange(3000)}"
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[1] = ids[0]  # one id, and one with a text of its own
    texts[1] = "quite another text under the same id as the first one"

    def shingles(text):
        words = text.split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    sets = [shingles(t) for t in texts]
    near = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    label, least = groups(len(sets), near), {}
    for k, group in enumerate(label):
        least[group] = min(least.get(group, ids[k]), ids[k])
    docs = table(texts, ids)
    found = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    assert found == sorted(least.values())
    far = {r.doc_id for r in simhash.near_duplicates(docs).collect() if r.doc_id == r.component_id}
    assert len(found) < len(far)  # most of these copies are over 3 bits apart


def test_copies_just_below_the_bound_compare_no_sets(spark, table, monkeypatch):
    """Hundreds of texts about 0.75 alike share keys; sketches end their pairs, so hardly a set is fetched."""
    from eventloom.llm import set_join

    compared = []
    whole = set_join._linked
    monkeypatch.setattr(set_join, "_linked", lambda pairs, *a: compared.append(pairs.count()) or whole(pairs, *a))
    rng = random.Random(8)
    texts = []
    for k in range(300):
        words = [f"w{at}" for at in range(400)]
        for at in rng.sample(range(400), 13):
            words[at] = f"x{k}y{at}"
        texts.append(" ".join(words))
    kept = near_copies.near_copies(table(texts)).where("kept").count()
    assert kept == 300 and sum(compared) < 300


def test_no_pair_at_the_threshold_is_missed():
    rng = np.random.default_rng(1)
    missed = 0
    for _ in range(300):
        both, own, other = (rng.integers(0, 2**64, n, np.uint64) for n in (80, 10, 10))
        a, b = near_copies.band_keys([np.append(both, own), np.append(both, other)])
        missed += not (a == b).any()
    assert missed == 0


def kept_lines(texts, ids):
    """Brute force: every line against every earlier one."""
    def near(a, b):
        if max(len(a), len(b)) < line_dedup.MIN_NEAR or abs(len(a) - len(b)) > 1:
            return False
        short, long = sorted((a, b), key=len)
        if short == long:
            return True
        for i in range(len(long)):
            if long[:i] + long[i + 1 :] == (short if len(short) < len(long) else short[:i] + short[i + 1 :]):
                return True
        return False

    first = {}
    order = sorted((i, k) for k, i in enumerate(ids))
    plain = lambda x: x.lower().strip(" \t\n\x0b\f\r")
    lines = [(d, n, plain(x)) for _, d in order for n, x in enumerate((texts[d] or "").split("\n"))]
    for at, (d, n, own) in enumerate(lines):
        if len(own.split()) >= line_dedup.MIN_EXACT:
            first.setdefault(own, at)
    words = {own: tuple(own.split()) for own in first}
    gone = {w for w in first if any(first[v] < first[w] and near(words[v], words[w]) for v in first)}
    out = {d: [] for d in range(len(texts))}
    for at, (d, n, own) in enumerate(lines):
        if own not in first or (first[own] == at and own not in gone):
            out[d].append(texts[d].split("\n")[n] if texts[d] is not None else None)
    return [None if t is None else "\n".join(out[d]) for d, t in enumerate(texts)]


def test_line_dedup_equals_brute_force(table):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(40)]
    pool = [rng.choices(words, k=rng.choice([2, 3, 8, 9, 10, 11, 14, 15])) for _ in range(25)]

    def changed(line):
        line, i = list(line), rng.randrange(len(line))
        kind = rng.randrange(5)
        if kind == 0:
            del line[i]
        elif kind == 1:
            line.insert(i, rng.choice(words))
        elif kind == 2:
            line[i] = rng.choice(words)
        return " ".join(line).upper() if kind == 3 else "  ".join(line)

    texts = ["\n".join(changed(rng.choice(pool)) for _ in range(rng.randint(0, 6))) for _ in range(60)]
    texts += [None, "", "\n\n", "\n".join(f"row {k} of the very same table with ten words {k % 3}" for k in range(40))]
    found = {r.doc_id: r for r in line_dedup.dedup_lines(table(texts)).collect()}
    assert [found[d].text for d in range(len(texts))] == kept_lines(texts, range(len(texts)))
    assert sum(r.n_near for r in found.values()) > 20
    assert all(r.key == "k" and r.part == 2 for r in found.values())


def test_line_dedup_of_odd_rows(odd, table):
    rows = line_dedup.dedup_lines(odd).collect()
    assert sorted((r.text or "") for r in rows) == sorted((t or "") for t in ODD)
    same = table(["a b c\na b c"] * 2, [1, 1])  # one document in two rows
    assert [r.text for r in line_dedup.dedup_lines(same).collect()] == ["a b c"] * 2
    assert line_dedup.dedup_lines(table([])).count() == 0
