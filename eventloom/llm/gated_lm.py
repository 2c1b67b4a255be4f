"""A gated recurrent language model in numpy: training by truncated backpropagation, and scoring.

Words of the vocabulary are outputs; every other word is the one member of class 0. The output is
factored: a softmax over classes, then one over the words of the class. Inputs are vocabulary
words, or for other words a bucket of their last letters, which tells their language and form.
A state is carried from window to window, so a document is scored as one sequence.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

HIDDEN, CLASS_WORDS, SUFFIX_BUCKETS, SUFFIX_LETTERS = 16, 64, 256, 3
WINDOW, STREAMS, RATE = 16, 64, 0.3
LOG10 = np.log(10.0)
#: Tokens, and sequences, that are scored at once: their numbers stay in a core's cache.
CHUNK, TOGETHER = 4096, 512
#: Rows of one class that are multiplied together.
BLOCK = 16
#: Logits whose ``exp`` is taken as they are.
MOST = 60


def suffix_buckets(words: pa.Array) -> np.ndarray:
    """Bucket of each word's last ``SUFFIX_LETTERS`` bytes."""
    ends = pc.binary_slice(words.cast(pa.large_binary()), -SUFFIX_LETTERS).dictionary_encode()
    buckets = np.array([zlib.crc32(end) % SUFFIX_BUCKETS for end in ends.dictionary.to_pylist()], np.int64)
    return buckets[ends.indices.to_numpy()] if len(words) else buckets


def fresh(counts: np.ndarray, rare: float) -> dict[str, np.ndarray]:
    """Parameters before training: biases give the unigram shares of the words (by rank) and of
    all rare words, the rest is small and fixed."""
    rng = np.random.default_rng(7)
    n_classes = -(-len(counts) // CLASS_WORDS)
    padded = np.full((n_classes, CLASS_WORDS), 1e-6)
    padded.flat[: len(counts)] = np.maximum(counts, 1e-6)
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    return {
        "input": small(len(counts) + SUFFIX_BUCKETS, 3 * HIDDEN), "state": small(HIDDEN, 3 * HIDDEN),
        "class": small(HIDDEN, 1 + n_classes),
        "class_bias": np.log(np.append(max(rare, 1e-6), padded.sum(axis=1))).astype(np.float32),
        "word": small(n_classes, HIDDEN, CLASS_WORDS),
        "word_bias": np.log(padded).astype(np.float32),
    }


def _advance(state: np.ndarray, a: np.ndarray, h: np.ndarray, out: tuple = (None, None, None, None)) -> tuple:
    """Next state, both gates, new part and the state's part of it; all with one column per sequence, as whole gates
    then lie together in memory. ``a`` are the input's parts, those of the gates negated, ``state`` the transposed weights of
    the state."""
    g = np.matmul(state, h, out=out[0])
    zr = np.subtract(a[: 2 * HIDDEN], g[: 2 * HIDDEN], out=out[1])
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    z, r = zr[:HIDDEN], zr[HIDDEN:]
    n = np.multiply(r, g[2 * HIDDEN :], out=out[2])
    n += a[2 * HIDDEN :]
    np.tanh(n, out=n)
    after = np.subtract(h, n, out=out[3])
    after *= z
    after += n
    return after, z, r, n, g[2 * HIDDEN :]


def _negated(table: np.ndarray) -> np.ndarray:
    """Rows of ``input`` with the gates' parts negated, as ``exp`` wants them."""
    return np.concatenate([-table[:, : 2 * HIDDEN], table[:, 2 * HIDDEN :]], axis=1)


def _step(p: dict, x: np.ndarray, h: np.ndarray) -> tuple:
    """Next state and gates for input rows ``x`` of ``input``, one row per sequence."""
    with np.errstate(over="ignore"):  # exp of a closed gate
        return tuple(v.T for v in _advance(p["state"].T, _negated(p["input"][x]).T, h.T))


def _exp(logits: np.ndarray, bounded: bool) -> tuple[np.ndarray, np.ndarray]:
    """exp of ``logits``, in place, less their largest where they aren't ``bounded``, and what was taken off."""
    top = np.zeros((len(logits), 1), logits.dtype) if bounded else logits.max(axis=1, keepdims=True)
    if not bounded:
        logits -= top
    return np.exp(logits, out=logits), top[:, 0]


def _sums(values: np.ndarray) -> np.ndarray:
    return values @ np.ones(values.shape[1], values.dtype)


def _most(weights: np.ndarray) -> float:
    """Bound of the logits that states, whose members lie between -1 and 1, get from ``weights`` with biases."""
    return float((np.abs(weights[..., :-1, :]).sum(axis=-2) + np.abs(weights[..., -1, :])).max(initial=0))


def _bounded(classes: np.ndarray, words: np.ndarray) -> tuple[bool, bool]:
    """Whether no state gives a class or word logit that ``exp`` can't take."""
    return _most(classes) < MOST, _most(words) < MOST


def _with_one(h: np.ndarray) -> np.ndarray:
    """States with a last column of ones, the input of the biases."""
    return np.concatenate([h, np.ones((len(h), 1), h.dtype)], axis=1)


def _outputs(p: dict) -> tuple[np.ndarray, np.ndarray]:
    """Class and word weights, each with its bias as the last row."""
    return np.vstack([p["class"], p["class_bias"]]), np.concatenate([p["word"], p["word_bias"][:, None]], axis=1)


def _with_bounds(p: dict) -> tuple:
    classes, words = _outputs(p)
    return classes, words, _bounded(classes, words)


def _blocks(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions whose target is a vocabulary word, class by class; their places in blocks of ``BLOCK`` rows of one
    class (from 0); the class of each block."""
    small = kinds.dtype.itemsize > 2 and kinds.max(initial=0) < 1 << 15
    order = np.argsort(kinds.astype(np.int16) if small else kinds, kind="stable")
    n = np.bincount(kinds, minlength=1)
    own, n = order[n[0] :], n[1:]
    blocks = -(-n // BLOCK)
    shift = (np.cumsum(blocks) - blocks) * BLOCK - (np.cumsum(n) - n)
    return own, np.arange(len(own)) + np.repeat(shift, n), np.repeat(np.arange(len(n)), blocks)


def _in_blocks(rows: np.ndarray, slots: np.ndarray, n_blocks: int) -> np.ndarray:
    out = np.zeros((n_blocks * BLOCK, rows.shape[1]), rows.dtype)
    out[slots] = rows
    return out.reshape(n_blocks, BLOCK, rows.shape[1])


def _targets(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and place in it: target -1 is a rare word, class 0."""
    return y // CLASS_WORDS + 1, y % CLASS_WORDS


def log_probability(p: dict, h: np.ndarray, y: np.ndarray, outputs: tuple | None = None) -> np.ndarray:
    """log10 of the probability of each target after each state. ``outputs`` are those of ``p`` with what ``_bounded``
    says, for many calls."""
    classes, words, bounded = outputs or _with_bounds(p)
    out = np.empty(len(y))
    for a in range(0, len(y), CHUNK):
        kind, place = _targets(y[a : a + CHUNK])
        states = _with_one(h[a : a + CHUNK])
        logits = states @ classes
        found = logits[np.arange(len(kind)), kind].astype(np.float64)
        logits, top = _exp(logits, bounded[0])
        found -= np.log(_sums(logits)) + top
        own, slots, of = _blocks(kind)
        logits = np.matmul(_in_blocks(states[own], slots, len(of)), words[of]).reshape(-1, CLASS_WORDS)[slots]
        inside = logits[np.arange(len(own)), place[own]].astype(np.float64)
        logits, top = _exp(logits, bounded[1])
        found[own] += inside - (np.log(_sums(logits)) + top)
        out[a : a + CHUNK] = found
    return out / LOG10


def score(p: dict, inputs: np.ndarray, targets: np.ndarray, offsets: np.ndarray, window: int = 32) -> np.ndarray:
    """log10 probability of each sequence i, the tokens ``offsets[i]:offsets[i + 1]``.

    ``TOGETHER`` sequences of like length advance together, longest first; those that end leave.
    Memory is one state per sequence and one window of states.
    """
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    total = np.zeros(len(order))
    outputs, p = _with_bounds(p), p | {"input": _negated(p["input"])}
    for a in range(0, len(order), TOGETHER):
        own = order[a : a + TOGETHER]
        total[own] = _score_together(p, outputs, inputs, targets, offsets[:-1][own], lengths[own], window)
    return total


def _score_together(p: dict, outputs: tuple, inputs: np.ndarray, targets: np.ndarray, begin: np.ndarray,
                    left: np.ndarray, window: int) -> np.ndarray:
    """Scores of the sequences of lengths ``left``, longest first; inputs of ``p`` are ``_negated``."""
    total = np.zeros(len(left))
    h, state = np.zeros((HIDDEN, len(left)), np.float32), np.ascontiguousarray(p["state"].T)
    rising, numbers = left[::-1], np.arange(len(left))
    for start in range(0, int(left.max(initial=0)), window):
        active = (len(left) - np.searchsorted(rising, np.arange(start, start + window), side="right")).tolist()
        states, wanted, owner = [], [], []
        with np.errstate(over="ignore"):
            for t, n in enumerate(active, start):
                if not n:
                    break
                at = begin[:n] + t
                h = np.ascontiguousarray(h[:, :n])
                states.append(h.T)
                wanted.append(targets.take(at))
                owner.append(numbers[:n])
                h = _advance(state, np.ascontiguousarray(p["input"].take(inputs.take(at), axis=0).T), h)[0]
        found = log_probability(p, np.concatenate(states), np.concatenate(wanted), outputs)
        total += np.bincount(np.concatenate(owner), found, len(total))
    return total


def train(p: dict, inputs: np.ndarray, targets: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Parameters after one pass over the sequences, laid end to end in ``STREAMS`` streams.

    The state is set to zero where a sequence begins; gradients stop at window edges. What fills the
    last streams up to equal length gives no gradient. Biases stand with their weights meanwhile, and
    inputs and classes that a window lacks are left alone, as they have no gradient.
    """
    weights = {"input": p["input"].copy(), "state": p["state"].copy()}
    weights["class"], weights["word"] = _outputs(p)
    squares = {k: np.full_like(v, 1e-3) for k, v in weights.items()}
    streams = max(1, min(STREAMS, len(inputs) // WINDOW))
    steps = -(-len(inputs) // streams)
    if not steps:
        return {k: v.copy() for k, v in p.items()}
    streams = -(-len(inputs) // steps)
    first = np.zeros(len(inputs), bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    laid = lambda v, fill: np.append(v, np.full(streams * steps - len(v), fill, v.dtype)).reshape(streams, steps).T
    x, y, fresh_at, real = laid(inputs, 0), laid(targets, -1), laid(first, False), laid(np.ones(len(inputs), bool), False)
    kinds, places = _targets(y)
    kinds = kinds.astype(np.int16) if kinds.max() < 1 << 15 else kinds
    h, sure, bounded = np.zeros((HIDDEN, streams), np.float32), 0, (False, False)
    for a in range(0, steps, WINDOW):
        if not sure:  # a window moves no weight by more than ``RATE``, so it need not be looked at each time
            most = _most(weights["class"]), _most(weights["word"])
            bounded = most[0] < MOST, most[1] < MOST
            sure = 1 + int((MOST - max(most)) / (1.01 * RATE * (HIDDEN + 1))) if all(bounded) else 1
        sure -= 1
        b = a + WINDOW
        h, grads = _window(weights, bounded, x[a:b], kinds[a:b], places[a:b], fresh_at[a:b], h, real[a:b])
        for k, (rows, g) in grads.items():
            _descend(weights[k], squares[k], rows, g)
    return {
        "input": weights["input"], "state": weights["state"], "class": weights["class"][:-1], "class_bias": weights["class"][-1],
        "word": weights["word"][:, :-1], "word_bias": weights["word"][:, -1],
    }


def _descend(weights: np.ndarray, squares: np.ndarray, rows: np.ndarray | None, g: np.ndarray) -> None:
    """One step against the clipped gradient ``g`` of the given rows, or of all; ``g`` is used up."""
    np.clip(g, -1, 1, out=g)
    square, step = squares if rows is None else squares[rows], g * g
    square += step
    if rows is not None:
        squares[rows] = square
    g *= RATE
    g /= np.sqrt(square, out=step)
    if rows is None:
        weights -= g
    else:
        weights[rows] -= g


def _gradients(p: dict, x: np.ndarray, y: np.ndarray, first: np.ndarray, h: np.ndarray,
               real: np.ndarray | None = None) -> tuple[np.ndarray, dict]:
    """State after a window and mean gradients of -log probability over its ``real`` tokens (else all), for all parameters."""
    classes, words, bounded = _with_bounds(p)
    weights = {"input": p["input"], "state": p["state"], "class": classes, "word": words}
    h, found = _window(weights, bounded, x, *_targets(y), first, np.ascontiguousarray(h.T), real)
    whole = {k: np.zeros_like(v) for k, v in weights.items()}
    for k, (rows, g) in found.items():
        whole[k][slice(None) if rows is None else rows] = np.clip(g, -1, 1)
    return np.ascontiguousarray(h.T), {
        "word": whole["word"][:, :-1], "word_bias": whole["word"][:, -1], "class": whole["class"][:-1],
        "class_bias": whole["class"][-1], "state": whole["state"], "input": whole["input"],
    }


def _window(weights: dict, bounded: tuple, x: np.ndarray, kind: np.ndarray, place: np.ndarray, first: np.ndarray,
            h: np.ndarray, real: np.ndarray | None) -> tuple[np.ndarray, dict]:
    """State after a window, one column per stream, and by parameter the rows it has gradients for (None: all) and
    these: mean gradients of -log probability over its ``real`` tokens (else all); the others are rare words at the
    ends of streams."""
    (steps, streams), m, kind, place = x.shape, x.size, kind.ravel(), place.ravel()
    table, classes, words = weights["input"], weights["class"], weights["word"]
    begins, keep = first.any(axis=1).tolist(), (~first).astype(h.dtype)
    flat_x = x.ravel()
    a = np.ascontiguousarray(table.take(flat_x, axis=0).reshape(steps, streams, 3 * HIDDEN).transpose(0, 2, 1))
    np.negative(a[:, : 2 * HIDDEN], out=a[:, : 2 * HIDDEN])
    state = np.ascontiguousarray(weights["state"].T)
    states = np.empty((steps + 1, HIDDEN, streams), h.dtype)
    n, zr, g = (np.empty((steps, k * HIDDEN, streams), h.dtype) for k in (1, 2, 3))
    states[0] = h
    with np.errstate(over="ignore"):
        for t in range(steps):
            if begins[t]:
                states[t] *= keep[t]
            _advance(state, a[t], states[t], (g[t], zr[t], n[t], states[t + 1]))
    before, z, r, gn = states[:-1], zr[:, :HIDDEN], zr[:, HIDDEN:], g[:, 2 * HIDDEN :]
    flat = _with_one(before.transpose(0, 2, 1).reshape(m, HIDDEN))
    n_real = m if real is None else int(np.count_nonzero(real))
    found = {}
    d, _ = _exp(flat @ classes, bounded[0])
    d /= _sums(d)[:, None]
    d[np.arange(m), kind] -= 1
    if n_real < m:
        d[~real.ravel()] = 0
    d /= n_real
    found["class"] = None, flat.T @ d
    dh = d @ classes[:-1].T
    own, slots, of = _blocks(kind)
    if len(own):
        rows, inside = _in_blocks(flat[own], slots, len(of)), words[of]
        d, _ = _exp(np.matmul(rows, inside).reshape(-1, CLASS_WORDS)[slots], bounded[1])
        d /= _sums(d)[:, None]
        d[np.arange(len(own)), place[own]] -= 1
        d /= n_real
        d = _in_blocks(d, slots, len(of))
        dh[own] += np.matmul(d, inside[:, :-1].transpose(0, 2, 1)).reshape(-1, HIDDEN)[slots]
        sums, new = np.matmul(rows.transpose(0, 2, 1), d), np.append(True, of[1:] != of[:-1])
        at, one = np.flatnonzero(new), sums[new]
        for to, block in zip((np.cumsum(new) - 1)[~new].tolist(), np.flatnonzero(~new).tolist()):  # a class of more than one block
            one[to] += sums[block]
        found["word"] = None if len(at) == len(words) else of[at], one
    dh = np.ascontiguousarray(dh.reshape(steps, streams, HIDDEN).transpose(0, 2, 1))
    # Gradients of the gates' inputs stand as new part, z, r, and the state's part of the new part.
    by, by_new = (np.empty((steps, 2, HIDDEN, streams), h.dtype) for _ in range(2))
    closed = 1 - z
    np.multiply(closed, 1 - n * n, out=by[:, 0])
    np.subtract(before, n, out=by[:, 1])
    by[:, 1] *= z
    by[:, 1] *= closed
    np.multiply(gn, r, out=by_new[:, 0])
    by_new[:, 0] *= 1 - r
    by_new[:, 1] = r
    dg, later, part = np.empty((steps, 4, HIDDEN, streams), h.dtype), np.zeros_like(h), np.empty_like(h)
    of_state = dg.reshape(steps, 4 * HIDDEN, streams)[:, HIDDEN:]
    for t in range(steps - 1, -1, -1):
        np.multiply(later, by[t], out=dg[t, :2])
        np.multiply(dg[t, 0], by_new[t], out=dg[t, 2:])
        later *= z[t]
        later += np.matmul(weights["state"], of_state[t], out=part)
        later += dh[t]
        if begins[t]:
            later *= keep[t]
    found["state"] = None, flat[:, :-1].T @ of_state.transpose(0, 2, 1).reshape(m, -1)
    rows = np.flatnonzero(np.bincount(flat_x))
    number = np.empty(rows[-1] + 1, np.intp)
    number[rows] = np.arange(len(rows))
    at = number.take(flat_x)
    columns = dg[:, :3].reshape(steps, 3 * HIDDEN, streams).transpose(1, 0, 2).astype(np.float64).reshape(3 * HIDDEN, m)
    sums = [np.bincount(at, column) for column in columns]
    found["input"] = rows, np.array(sums[HIDDEN:] + sums[:HIDDEN]).T.astype(h.dtype, order="C")
    return states[steps], found
