"""Token ids of whole texts by a public BPE vocabulary, fast enough for every document.

Words repeat, so ids are kept by word: a text is cut at ASCII blanks (where the vocabulary's own
pre-tokenizer always cuts too), each new word is encoded once by the ``tokenizers`` library and
later copied. A word made of lower-case Latin letters and ASCII punctuation is encoded run by run,
many runs in one call; every other word goes through the vocabulary's own normalizer.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from eventloom.llm.common import give_back, word_codes

END_ID = 1
#: Words kept per Python worker, about 80 MB; a full memory keeps the half that was met most often.
MEMORY_WORDS = 400_000

#: Runs that the pre-tokenizer cuts as they are: letters in NFC and lower case, and punctuation
#: without the apostrophe, which may start a contraction.
_RUNS = re.compile(r"[a-zß-öø-ſ]+|[!-&(-/:-@\[-`{-~]+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges of the given lengths, one after the other."""
    place = np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
    place += np.arange(len(place))
    return place


class WordEncoder:
    """Ids of texts; ``encode`` gives one flat array and where each text begins in it."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # For text that is already normal, cut at blanks and without special tokens; the vocabulary is held once.
        self.runs = Tokenizer(self.tokenizer.model)
        self.runs.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        names = sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])
        self.closes = np.zeros(names[-1][1] + 1, bool)
        self.closes[[i for name, i in names if name.endswith("</w>")]] = True
        self.slots: dict[str, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)
        self.met = np.empty(0, np.int64)

    def _shrink(self) -> None:
        """Drop the words met least often; ids of the others move together."""
        kept = np.sort(np.argsort(-self.met, kind="stable")[: MEMORY_WORDS // 2])
        words = list(self.slots)
        self.slots = {words[k]: i for i, k in enumerate(kept.tolist())}
        self.ids = self.ids[_ranges(self.starts[kept], self.lengths[kept])]
        self.lengths, self.met = self.lengths[kept], self.met[kept] // 2
        self.starts = np.cumsum(self.lengths) - self.lengths

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): equal to encoding each whole text by the library. Null is empty."""
        texts = pc.fill_null(texts, "")
        # Strings of special tokens are matched before lower-casing: whole texts, as they are.
        special = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False))
        if len(special):
            each = texts.to_pylist()
            whole = {k: self._whole(each[k]) for k in special}
            texts = pa.array(["" if k in whole else t for k, t in enumerate(each)], texts.type)
        offsets, codes, distinct = word_codes(texts)
        words = distinct.to_pylist()
        if len(self.slots) > MEMORY_WORDS:
            self._shrink()
        slots = np.fromiter(map(self.slots.get, words, repeat(-1)), np.int64, len(words))
        fresh, n = np.flatnonzero(slots < 0), len(self.slots)
        if len(fresh):
            self._learn([words[k] for k in fresh.tolist()])
            slots[fresh] = np.arange(n, n + len(fresh))
        self.met[slots] += 1
        slots = slots[codes]
        lengths = self.lengths[slots]
        offsets = np.append(0, np.cumsum(lengths))[offsets]
        ids = self.ids[_ranges(self.starts[slots], lengths)]
        if len(special):
            parts = [whole.get(k, ids[a:b]) for k, (a, b) in enumerate(zip(offsets, offsets[1:]))]
            offsets = np.cumsum([0, *map(len, parts)])
            ids = np.concatenate(parts)
        return offsets, ids

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, new: list[str]) -> None:
        """Keep the ids of new words, in slots after those taken."""
        parts, rest = [], []
        for word in new:
            low = word.lower()
            runs = _RUNS.findall(low)
            # Anything but known runs goes to the library's own normalizer.
            parts.append(runs if sum(map(len, runs)) == len(low) else None)
            if parts[-1] is None:
                rest.append(word)
        found, fresh = {}, []
        for r in {r for runs in parts if runs for r in runs}:
            slot = self.slots.get(r)
            if slot is None:
                fresh.append(r)
            else:
                found[r] = self.ids[self.starts[slot] : self.starts[slot] + self.lengths[slot]].tobytes()
        found |= self._encode_runs(fresh)
        for k in range(0, len(rest), 1000):
            batch = rest[k : k + 1000]
            for w, e in zip(batch, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)):
                found["", w] = np.array(e.ids, np.uint32).tobytes()
        flat = [
            b"".join([found[r] for r in runs]) if runs is not None else found["", word]
            for word, runs in zip(new, parts)
        ]
        lengths = np.fromiter(map(len, flat), np.int64, len(flat)) // 4
        self.slots.update(zip(new, range(len(self.slots), len(self.slots) + len(new))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(flat), np.uint32)])

    def _encode_runs(self, runs: list[str]) -> dict:
        found = {}
        for k in range(0, len(runs), 200):
            batch = runs[k : k + 200]
            ids = np.array(self.runs.encode(" ".join(batch), add_special_tokens=False).ids, np.uint32)
            ends = (np.flatnonzero(self.closes[ids]) + 1).tolist()
            raw = ids.tobytes()
            found.update(zip(batch, [raw[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]))
        return found


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a vocabulary; its word memory outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """The memory of this worker's encoders back to the system, for steps that hold much themselves."""
    if _ENCODERS:
        _ENCODERS.clear()
        give_back()
