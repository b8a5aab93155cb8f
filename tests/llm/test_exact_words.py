"""Texts on which weak hashes of words collide."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridweave.llm import bpe, ngram_join, online_packing, quality, token_packing
from gridweave.llm import textkernel as K


def thue_morse(n, swap=False):
    """Two such words are equal under every polynomial hash modulo a power of two."""
    return "".join("ba"[(i.bit_count() & 1) ^ swap] for i in range(n))


PAIR = [thue_morse(1024), thue_morse(1024, True)]
LONG = [thue_morse(2048), thue_morse(2048, True)]


def library_ids(path, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(list(enumerate(PAIR + LONG)), "doc_id long, text string").coalesce(1)


def test_token_operators_tell_words_apart(pairs, tokenizer_file):
    want = {i: library_ids(tokenizer_file, t) for i, t in enumerate(PAIR + LONG)}
    for r in bpe.encoding_digests(pairs, tokenizer_file).collect():
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((PAIR + LONG)[r.doc_id].encode()).hexdigest()
    pieces = {}
    for r in online_packing.pack_online(pairs, tokenizer_file, with_ids=True).orderBy("doc_id", "start").collect():
        pieces[r.doc_id] = pieces.get(r.doc_id, []) + np.frombuffer(r.ids, "<u4").tolist()
    assert pieces == {i: [*x, 0] for i, x in want.items()}
    got = {}
    for r in token_packing.pack_documents(pairs, tokenizer_file).collect():
        ids = np.frombuffer(r.input_ids, "<u2")
        for k, doc in enumerate(r.doc_ids):
            got[doc] = ids[r.cu_seqlens[k] : r.cu_seqlens[k + 1]].tolist()
    assert got == {i: [*x, 50256] for i, x in want.items()}


def test_words_of_one_hash_are_compared(tokenizer_file, monkeypatch):
    """With a hash that knows lengths only, until the third seed, ids are right all the same."""
    real = K.run_hashes
    monkeypatch.setattr(K, "run_hashes", lambda codes, lens, seed=0: real(codes, lens, seed) if seed > 1 else lens.astype(np.uint64))
    encoder = bpe.TextEncoder(tokenizer_file)
    for texts in (["the cat", "sat on"], ["dog bit the fox"]):
        ids, ends = encoder.encode(*K.string_buffers(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [library_ids(tokenizer_file, t) for t in texts]


def test_many_special_tokens(tokenizer_file):
    text = "".join(f"<|endoftext|>{'x' * (i % 3)}" for i in range(20_000)) + "<|endoftext|> <|endof"
    ids, _ = bpe.TextEncoder(tokenizer_file).encode(*K.string_buffers(pa.array([text])))
    assert ids.tolist() == library_ids(tokenizer_file, text)


def test_ngram_join_and_quality_tell_words_apart(spark, pairs):
    assert all(r.component_id == r.doc_id for r in ngram_join.ngram_components(pairs).collect())
    lines = spark.createDataFrame([(1, "\n".join(LONG), "a"), (2, "\n".join([LONG[0]] * 2), "a")], "doc_id long, text string, source string")
    assert {r.doc_id: r.n_dup_lines for r in quality.quality_rules(lines).collect()} == {1: 0, 2: 1}
    words = K.Words(*K.string_buffers(pa.array([" ".join(PAIR + LONG)])))
    assert max(Counter(words.hashes().tolist()).values()) == 1
