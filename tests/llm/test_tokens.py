import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from eventloom.llm import packing, token_files, token_ids
from eventloom.llm.common import word_codes
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def encoder():
    return token_ids.WordEncoder(token_ids.default_vocabulary())


def library(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_word_codes_of_a_slice():
    texts = pa.array(["x"] * 3 + ODD).slice(3)
    offsets, codes, distinct = word_codes(texts)
    words = [[distinct[int(c)].as_py().encode() for c in codes[a:b]] for a, b in zip(offsets, offsets[1:])]
    assert words == [(t or "").encode().lower().split() for t in ODD]


def test_encoder_equals_library(encoder):
    rng = random.Random(3)
    letters = "abcdeTHE ßéÉñ.,;:!?'\"&$%|#_-0123 \n\t ́日Σς"
    made = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(400)]
    texts = ODD + made + ["It's L'été aren't x.'s 'tis ''t", "<|startoftext|> A<|ENDOFTEXT|>", "a\x1cb \x85 c"]
    offsets, ids = encoder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library(encoder, t) for t in texts]


def test_encoder_forgets_and_stays_right(encoder, monkeypatch):
    monkeypatch.setattr(token_ids, "MEMORY_WORDS", 50)
    own = token_ids.WordEncoder(token_ids.default_vocabulary())
    for k in range(6):
        texts = [" ".join(f"w{chr(97 + (k * i) % 26)}{chr(97 + i % 26)}" for i in range(80)), "the cat the end."]
        offsets, ids = own.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library(encoder, t) for t in texts]
    assert len(own.slots) < 200


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("window", [4, 2048])
def test_packing_places_every_id_once(spark, odd, encoder, window):
    pieces = packing.token_pieces(odd, window)
    rows = sorted(pieces.collect(), key=lambda r: (r.sequence_id, r.offset))
    place, line = 0, []
    for r in rows:
        assert r.sequence_id * window + r.offset == place
        assert r.ids_crc32 == crc(r.token_ids) and r.length == len(r.token_ids) > 0
        place += r.length
        line += r.token_ids
    wanted = sorted(library(encoder, t) + [1] for t in ODD)
    texts, at = [], 0
    for r in rows:  # pieces of a document follow each other
        if r.start == 0:
            texts.append(line[at : at + r.doc_tokens])
            at += r.doc_tokens
    assert sorted(texts) == wanted and at == len(line)
    found = sorted(packing.sequences(odd, window).collect(), key=lambda r: r.sequence_id)
    assert [t for r in found for t in r.token_ids] == line
    assert all(r.n_tokens == window for r in found[:-1]) and 0 < found[-1].n_tokens <= window
    assert [d for r in found for d in r.doc_ids] == [r.doc_id for r in rows]


def test_packing_of_nothing(table):
    pieces = packing.token_pieces(table([]))
    assert pieces.count() == 0 and packing.sequences(table([])).count() == 0


def test_token_files(spark, odd, encoder, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_token_files(odd, path)
    rows = sorted(token_files.checksums(token_files.read_token_files(spark, path)).collect(), key=lambda r: r.start)
    order = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert order == sorted(order) and len(rows) == len(ODD)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert sorted((r.n_tokens, r.ids_crc32) for r in rows) == sorted(
        (len(i), crc(i)) for i in (library(encoder, t) + [1] for t in ODD))
    file = max((tmp_path / "ids").glob("*.parquet"), key=lambda f: f.stat().st_size)
    group = pq.ParquetFile(file).metadata.row_group(0)
    columns = {c.path_in_schema: c for c in map(group.column, range(group.num_columns))}
    ids = next(c for name, c in columns.items() if name.startswith("token_ids"))
    assert "RLE_DICTIONARY" in ids.encodings and "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index


def test_token_files_of_nothing(spark, table, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(table([]), path)
    assert token_files.checksums(token_files.read_token_files(spark, path)).count() == 0


def test_words_are_looked_up_once():
    import pyarrow as pa

    class Counted(dict):
        n = 0

        def get(self, *key):
            Counted.n += 1
            return super().get(*key)

        def __getitem__(self, key):
            Counted.n += 1
            return super().__getitem__(key)

        def __contains__(self, key):
            Counted.n += 1
            return super().__contains__(key)

    words = token_ids.WordEncoder(token_ids.default_vocabulary())
    texts = pa.array(["one two one", None, "two three"])
    first = [v.tolist() for v in words.encode(texts)]
    words.slots = Counted(words.slots)
    assert [v.tolist() for v in words.encode(texts)] == first and Counted.n == 4  # and the empty word


def test_windows_are_put_together_without_the_encoder():
    path = token_ids.default_vocabulary()
    own = token_ids.encoder(path)
    assert own.runs.normalizer is None and not own.runs.get_added_tokens_decoder()  # of the vocabulary held once
    ids = pa.array([[5, 6, 1], [1]], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([7, 8]), pa.array([0, 3]), pa.array([3, 1]), ids], ["doc_id", "start", "n_tokens", "token_ids"])
    found = [r for b in packing._put_together(iter([batch]), 2) for r in b.to_pylist()]
    assert not token_ids._ENCODERS
    assert [[p["token_ids"] for p in r["pieces"]] for r in found] == [[[5, 6]], [[1], [1]]]
