import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
from conftest import ODD
from tokenizers import Tokenizer

from cohortloom.llm import queries
from cohortloom.llm.bpe_codec import BpeCodec, Merges, byte_letters, decode_ids, encode_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return BpeCodec(PATH)


def slow_merge(merges: Merges, word: bytes) -> list[int]:
    ids = [merges.byte_ids[b] for b in word]
    while pairs := [(merges.merged[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges.merged]:
        rank, i = min(pairs)
        ids[i : i + 2] = [merges.merged[ids[i], ids[i + 1]][1]]
    return ids


def test_ids_are_those_of_the_library(codec, library):
    rng = np.random.default_rng(2)
    some = [*"aaabcdeé\u00df中の  \n\tstre1234!?.,xX\u00bdⅧ\u0558\U00010940\U0001f600\x1c\x85\u3000\u0301"]
    some += ["'s", "'LL", "'ll", "<|endoftext|>", "<|endof", "    ", "ing", " the", "\r\n"]
    texts = ["".join(rng.choice(some, rng.integers(0, 50))) for _ in range(3000)]
    texts += ["x" * 3000, "ab" * 2000 + " " + "qz" * 500, "".join(rng.choice(list("abcdefgh"), 5000)), ""]
    ids, n = codec.encode(texts)
    assert [p.tolist() for p in np.split(ids, np.cumsum(n)[:-1])] == [
        library.encode(t, add_special_tokens=False).ids for t in texts
    ]
    assert codec.decode(ids, n) == [library.decode(library.encode(t).ids, skip_special_tokens=False) for t in texts] == texts


def test_a_pair_fails_if_and_only_if_merging_its_bytes_gives_another_row(codec):
    merges, rng = codec.merges, np.random.default_rng(4)
    tokens = rng.integers(0, 50_000, (2, 3000))
    tokens[:, :2000] = rng.integers(64, 400, (2, 2000))
    failing = merges.failing(*tokens)
    assert 100 < failing.sum() < 2900
    for x, y, bad in zip(*tokens.tolist(), failing.tolist()):
        assert (slow_merge(merges, merges.tokens[x] + merges.tokens[y]) != [x, y]) == bad


@pytest.mark.parametrize("seed", range(20))
def test_words_of_small_vocabularies(seed):
    rng = np.random.default_rng(seed)
    vocab = {c: i for i, c in enumerate(byte_letters())}
    merges, made = [], ["a", "b", "c"]
    for _ in range(25):
        x, y = rng.choice(made, 2)
        if x + y not in vocab:
            vocab[x + y] = len(vocab)
            merges.append(f"{x} {y}")
            made.append(x + y)
    if seed % 5 == 0:
        merges.append("aa a" if "aa" in vocab else "a c")
        vocab.setdefault("".join(merges[-1].split()), len(vocab))
        merges.append("a aa" if "aa" in vocab else "c c")
        vocab.setdefault("".join(merges[-1].split()), len(vocab))
    codec = Merges(vocab, merges)
    words = ["".join(rng.choice(["a", "b", "c"], rng.integers(1, 14))).encode() for _ in range(300)] + [b"a" * 300, b"abc" * 90]
    ids, n = codec.encode_words(words)
    assert [p.tolist() for p in np.split(ids, np.cumsum(n)[:-1])] == [slow_merge(codec, w) for w in words]


def test_long_texts_are_cut_between_words(codec, library):
    text = ("some words, 12 of them  \n\n  and 'more' don't " * 40_000) + "end<|endoftext|>"
    ids, n = codec.encode([text, "after"])
    assert ids[: n[0]].tolist() == library.encode(text, add_special_tokens=False).ids
    assert codec.decode(ids, n) == [text, "after"]


def test_other_kinds_of_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError):
        BpeCodec(public_tokenizers.path("word_bpe_49k.json"))
    with open(PATH) as file:
        spec = json.load(file)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        BpeCodec(f"{tmp_path}/t.json")


def test_odd_rows(docs_of, library):
    rows = decode_ids(encode_texts(docs_of(ODD), PATH), PATH).collect()
    want = [(i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in ODD]
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r["doc_id"], r["ids"], r["text"]) for r in rows), key=order) == sorted(want, key=order)


def test_no_rows(docs_of):
    assert decode_ids(encode_texts(docs_of([]), PATH), PATH).count() == 0


def test_query(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op13_bpe_codec"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), texts[r["doc_id"]])]
        assert [r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]] == [len(ids), *digests]
