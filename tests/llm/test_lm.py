import math
import zlib
from collections import Counter

import numpy as np

from eventloom.llm import gated_lm, lm_scoring
from tests.llm.conftest import ODD


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10


def base(ids, texts):
    c = Counter(t for i, x in zip(ids, texts) if fold(i) for t in tokens(x))
    n, v = sum(c.values()), len(c)
    return [(len(tokens(x)), sum(c[t] > 0 for t in tokens(x)), n, sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(x))) for x in texts]


def test_base_scores(table, monkeypatch):
    texts = ODD + [" ".join(f"w{(k * j) % 17}" for j in range(k)) for k in range(40)]
    ids = [None, *range(len(texts) - 2), None]
    for head in (10**6, 5):  # all words in the head, then most of them outside
        monkeypatch.setattr(lm_scoring, "HEAD_WORDS", head)
        rows = lm_scoring.score(table(texts, ids)).collect()
        key = lambda r: (r[0], r[1], r[2], round(r[3], 6))
        assert sorted(key((r.n_tokens, r.n_known, r.train_tokens, r.base_score)) for r in rows) == sorted(map(key, base(ids, texts)))
        assert all(r.held_out == (fold(r.doc_id) == 0) and np.isfinite(r.score) and r.score < 0 for r in rows)
    assert lm_scoring.score(table([])).count() == 0


def small(n_words=130):
    rng = np.random.default_rng(0)
    p = gated_lm.fresh(np.sort(rng.random(n_words))[::-1] + 0.1, 5.0)
    return {k: (v + rng.standard_normal(v.shape) * 0.3 * (k not in ("word_bias", "class_bias"))).astype(np.float64) for k, v in p.items()}


def test_probabilities_sum_to_one():
    p = small()
    h = np.random.default_rng(1).standard_normal((3, gated_lm.HIDDEN))
    for row in h:
        y = np.array([-1, *range(130)])
        padded = 3 * gated_lm.CLASS_WORDS - 130  # places of no word hold almost nothing
        total = (10 ** gated_lm.log_probability(p, np.repeat(row[None], len(y), 0), y)).sum()
        assert 1 - 1e-3 * padded < total <= 1 + 1e-6


def test_score_carries_the_state_over_windows():
    p, rng = small(), np.random.default_rng(2)
    lengths = [0, 1, 70, 33, 32, 5]
    offsets = np.cumsum([0, *lengths])
    x, y = rng.integers(0, 130, offsets[-1]), rng.integers(-1, 130, offsets[-1])
    found = gated_lm.score(p, x, y, offsets, window=32)
    for k, (a, b) in enumerate(zip(offsets, offsets[1:])):
        h, total = np.zeros((1, gated_lm.HIDDEN), np.float32), 0.0
        for t in range(a, b):
            total += gated_lm.log_probability(p, h, y[t : t + 1])[0]
            h = gated_lm._step(p, x[t : t + 1], h)[0]
        assert abs(found[k] - total) < 1e-3


def test_gradients():
    p, rng = small(), np.random.default_rng(3)
    x, y = rng.integers(0, 130, (5, 3)), rng.integers(-1, 130, (5, 3))
    first = rng.random((5, 3)) < 0.2
    h0 = rng.standard_normal((3, gated_lm.HIDDEN))
    _, grads = gated_lm._gradients(p, x, y, first, h0)

    def loss():
        h, total = h0, 0.0
        for t in range(5):
            h = np.where(first[t][:, None], 0, h)
            total -= gated_lm.log_probability(p, h, y[t]).sum() * gated_lm.LOG10
            h = gated_lm._step(p, x[t], h)[0]
        return total / x.size

    for name, g in grads.items():
        for flat in np.argsort(-np.abs(g).ravel())[:3]:
            at = np.unravel_index(flat, g.shape)
            kept = p[name][at]
            p[name][at] = kept + 1e-3
            up = loss()
            p[name][at] = kept - 1e-3
            down = loss()
            p[name][at] = kept
            assert abs((up - down) / 2e-3 - g[at]) < 1e-3 + 0.02 * abs(g[at]), name


def test_training_learns_an_order():
    """Words that follow each other by rule: the recurrent score beats the unigram share."""
    line = [k % 7 for k in range(6000)]
    y = np.array(line)
    p, whole = gated_lm.fresh(np.full(7, 1000.0), 1.0), np.array([0, len(y)])
    before = gated_lm.score(p, y, y, whole)[0]
    after = gated_lm.score(gated_lm.train(p, y, y, whole), y, y, whole)[0]
    assert after > 0.3 * before


def test_training_uses_every_token():
    rng = np.random.default_rng(4)
    for n in (5, 100, 1000, 64 * 33 + 63):
        x, y = rng.integers(0, 130, n), rng.integers(0, 130, n)
        offsets, p = np.array([0, n]), small()
        last = y.copy()
        last[-1] = (last[-1] + 1) % 130
        one, two = (gated_lm.train(p, x, v, offsets) for v in (y, last))
        assert all(np.isfinite(v).all() for v in one.values())
        assert any((one[k] != two[k]).any() for k in one), n


def test_every_training_document_is_fitted(table):
    """A change of word order in any one training document changes the parameters."""
    ids = [k for k in range(12) if fold(k)]
    texts = ["a b c d e f g h " * 3] * len(ids)

    def fitted(texts):
        rows = lm_scoring._rows(table(texts, ids).coalesce(1))
        counts = lm_scoring.word_counts(rows).toPandas()
        return lm_scoring.fit_parameters(rows, lm_scoring.Words(counts["word"].tolist(), counts["n"].to_numpy()), 0.0)

    plain = fitted(texts)
    for k in range(0, len(ids), 3):
        other = fitted([t if i != k else "h g f e d c b a " * 3 for i, t in enumerate(texts)])
        assert any((plain[name] != other[name]).any() for name in plain), ids[k]


def test_inputs_are_the_tokens_before():
    """A token's own identity must not reach its score: the state has seen only tokens before it."""
    import pyarrow as pa

    words = lm_scoring.Words(["a", "b", ""], np.array([5, 3, 2]))
    offsets, inputs, targets, *_ = words.sequences(pa.array(["a b zz", None]))
    assert offsets.tolist() == [0, 4, 5] and targets.tolist() == [0, 1, -1, 2, 2]
    h = np.zeros((1, gated_lm.HIDDEN), np.float32)
    p = gated_lm.fresh(words.counts, 1.0)
    wanted = []
    for y, x in zip(targets[:4], inputs[:4]):
        wanted.append(gated_lm.log_probability(p, h, np.array([y]))[0])
        h = gated_lm._step(p, np.array([x]), h)[0]
    assert abs(gated_lm.score(p, inputs[:4], targets[:4], np.array([0, 4]))[0] - sum(wanted)) < 1e-4


def test_steps_do_not_grow_with_classes(monkeypatch):
    """The words of all classes go through one softmax, in training and in scoring."""
    class Counted:
        def __getattr__(self, name):
            calls.append(name)
            return getattr(np, name)

    rng, seen = np.random.default_rng(5), []
    for n_words in (2 * gated_lm.CLASS_WORDS, 32 * gated_lm.CLASS_WORDS):
        p, x, y = small(n_words), rng.integers(0, 130, (16, 64)), rng.integers(-1, n_words, (16, 64))
        calls = []
        with monkeypatch.context() as patch:
            patch.setattr(gated_lm, "np", Counted())
            gated_lm._gradients(p, x, y, np.zeros(x.shape, bool), np.zeros((64, gated_lm.HIDDEN)))
            gated_lm.log_probability(p, rng.standard_normal((1024, gated_lm.HIDDEN)), y.ravel())
        seen.append(calls.count("exp"))
    assert seen[0] == seen[1]


def test_suffix_buckets():
    import pyarrow as pa

    words = ["", "a", "ab", "abc", "walking", "日本語", "é"]
    wanted = [zlib.crc32(w.encode()[-gated_lm.SUFFIX_LETTERS :]) % gated_lm.SUFFIX_BUCKETS for w in words]
    assert gated_lm.suffix_buckets(pa.array(words, pa.large_string())).tolist() == wanted
    assert gated_lm.suffix_buckets(pa.array([], pa.large_string())).tolist() == []


def test_large_weights_stay_finite():
    """Logits beyond what exp can take are lowered first."""
    p = small()
    p["class_bias"] = p["class_bias"] + 2000.0
    p["word"] = p["word"] * 400
    y = np.arange(-1, 130)
    h = np.random.default_rng(6).standard_normal((len(y), gated_lm.HIDDEN))
    assert np.isfinite(gated_lm.log_probability(p, h, y)).all()
    _, grads = gated_lm._gradients(p, y[1:][None], y[1:][None], np.zeros((1, 130), bool), h[1:])
    assert all(np.isfinite(g).all() for g in grads.values())


def test_training_touches_only_what_a_window_holds(monkeypatch):
    """Like steps on all parameters, but inputs that a window lacks are left alone and bounds are not taken each time."""
    rng, windows = np.random.default_rng(8), 6
    n = gated_lm.STREAMS * gated_lm.WINDOW * windows
    p, x, y = gated_lm.fresh(np.arange(200.0, 0, -1), 5.0), rng.integers(0, 40, n), rng.integers(-1, 200, n)
    offsets = np.array([0, 700, 701, n])
    rows, bounds, window, most = [], [], gated_lm._window, gated_lm._most
    with monkeypatch.context() as patch:
        patch.setattr(gated_lm, "_window", lambda *args: rows.append(window(*args)) or rows[-1])
        patch.setattr(gated_lm, "_most", lambda weights: bounds.append(1) or most(weights))
        found = gated_lm.train(p, x, y, offsets)
    assert len(rows) == windows and len(bounds) < 2 * windows
    assert all(len(g["input"][0]) <= 40 and len(g["input"][1]) == len(g["input"][0]) for _, g in rows)
    laid = lambda v: v.reshape(gated_lm.STREAMS, -1).T
    first = np.zeros(n, bool)
    first[offsets[:-1]] = True
    q, squares = {k: v.copy() for k, v in p.items()}, {k: np.full_like(v, 1e-3) for k, v in p.items()}
    h = np.zeros((gated_lm.STREAMS, gated_lm.HIDDEN), np.float32)
    for a in range(0, n // gated_lm.STREAMS, gated_lm.WINDOW):
        h, grads = gated_lm._gradients(q, *(laid(v)[a : a + gated_lm.WINDOW] for v in (x, y, first)), h)
        for k, g in grads.items():
            squares[k] += g * g
            q[k] -= gated_lm.RATE * g / np.sqrt(squares[k])
    assert all(np.allclose(found[k], q[k], atol=1e-4) for k in p)


def test_places_of_words_in_the_head():
    import pyarrow as pa

    words = lm_scoring.Words(["b", "", "a", "é"], np.array([5, 4, 3, 1]))
    offsets, places, inputs, codes, distinct = words.tokens(pa.array([" B zz a", None, "é b "]))
    assert isinstance(distinct, pa.Array)  # words don't become Python objects
    assert offsets.tolist() == [0, 4, 5, 8] and places.tolist() == [0, -1, 2, 1, 1, 3, 0, 1]
    assert [distinct[c].as_py() if c >= 0 else None for c in codes.tolist()] == ["b", "zz", "a", None, None, "é", "b", None]
    assert inputs[1] == 4 + gated_lm.suffix_buckets(pa.array(["zz"], pa.large_string()))[0]
