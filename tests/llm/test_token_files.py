import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import ODD
from tokenizers import Tokenizer

from cohortloom.llm import token_files as T

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 24, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    data = T.pack(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert (T.unpack(data, bits, len(ids)) == ids).all()


def test_bits_of_a_vocabulary():
    assert [T.id_bits(n) for n in (1, 2, 3, 256, 257, 49_408, 65_537)] == [1, 1, 2, 8, 9, 16, 17]


@pytest.mark.parametrize("bits", [5, 16])
def test_any_range_of_a_shard_can_be_read(tmp_path, bits):
    ids = np.random.default_rng(1).integers(0, 1 << bits, 30_000).astype(np.uint32)
    lengths = np.array([0, 10_000, 1, 19_999])
    T.write_shard(f"{tmp_path}/a.ids", ids, np.array([3, 5, T.NULL_ID, 9]), lengths, bits)
    shard = T.open_shard(f"{tmp_path}/a.ids")
    assert shard.n_ids == len(ids) and shard.doc_ids.tolist() == [3, 5, T.NULL_ID, 9]
    for a, b in [(0, 30_000), (0, 0), (8191, 8193), (12_345, 29_999), (29_999, 30_000)]:
        assert (shard.ids(a, b) == ids[a:b]).all()


def test_word_by_word_encoding_is_that_of_whole_texts():
    tokenizer, encoder = Tokenizer.from_file(WORDS), T.WordEncoder(WORDS)
    assert encoder.splittable
    rng = np.random.default_rng(7)
    letters = list("aBcÉé́ ' s\n\t\x1c\x85.,!&$«…—12²½Ⅷ中かΣςİß<|#@-‍😀") + ["'s", "'ll", "<|endoftext|>", "<|ENDOFTEXT|>", "don't", "word,"]
    for _ in range(400):
        text = "".join(rng.choice(letters, rng.integers(0, 40)))
        ids, n = encoder.encode([text.encode(), b"x y"])
        assert ids[: n[0]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def expected(pairs):
    tokenizer, start, rows = Tokenizer.from_file(WORDS), 0, []
    for i, t in pairs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        rows.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    return rows


def test_files_hold_all_documents_in_order(work, docs_of):
    pairs = [(i * 37 % 101 + 1, f"text {i} of some length, {'again ' * (i % 9)}") for i in range(100)]
    manifest = T.write_token_files(work, docs_of(pairs), WORDS, 2, shard_ids=200)
    assert manifest.agg({'n_docs': 'sum'}).first()[0] == 100
    found = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in T.read_token_files(manifest).collect())
    assert found == expected(sorted(pairs))


def test_odd_rows(work, docs_of):
    rows = T.read_token_files(T.write_token_files(work, docs_of(ODD), WORDS, 2)).collect()
    assert len(rows) == len(ODD)
    want = sorted((-1 if i is None else i, n, c) for i, _, n, c in expected(ODD))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    starts = sorted((r["start"], r["n_tokens"]) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_no_rows(work, docs_of):
    assert T.read_token_files(T.write_token_files(work, docs_of([]), WORDS, 2)).count() == 0
