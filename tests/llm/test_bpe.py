"""Byte-level BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from carelake.llm import bpe


@pytest.fixture(scope="module")
def pair():
    path = bpe.default_vocabulary()
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return bpe.ByteBpe(path), t


def texts():
    rng = random.Random(7)
    out = ["", " ", "a", "<|endoftext|>", "x<|endoftext|> y<|endoftext|><|endoftext|>", "aaaaaaa " * 50, "a" * 5000, " \n\n\t x", "don't we'll I'M éçê 你好 \U0001f600‍\U0001f600", "x\x1c\x1d y\x85z  w  1²٤ İ"]
    pool = [chr(c) for r in ((9, 14), (28, 127), (160, 700), (0x400, 0x460), (0x3040, 0x3060), (0x1F600, 0x1F610), (0x2000, 0x2030)) for c in range(*r)]
    for _ in range(300):
        out.append("".join(rng.choice(pool) * rng.choice((1, 1, 1, 2, 7)) for _ in range(rng.randrange(60))))
    return out


def test_ids_and_round_trip(pair):
    coder, t = pair
    want = [e.ids for e in t.encode_batch(texts(), add_special_tokens=False)]
    got = coder.encode(texts())
    for text, a, b in zip(texts(), got, want):
        assert a.tolist() == b, repr(text)
        assert coder.decode(a) == t.decode(b, skip_special_tokens=False) == text


def test_runs_of_pieces_join(pair, monkeypatch):
    coder, t = pair
    monkeypatch.setattr(bpe, "PIECES", 7)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    text = "the quick  brown fox's <|endoftext|> tail, \n\n and " * 30
    assert coder.encode([text, "", text])[2].tolist() == t.encode(text, add_special_tokens=False).ids


def test_query_rows(spark, pair):
    _, t = pair
    rows = [(1, "hello world", "c"), (None, None, "c"), (1, "hello world", "c"), (3, "", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    out = {(r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in bpe.bpe_encode(df).collect()}
    ids = np.array(t.encode("hello world").ids, "<u4").tobytes()
    assert out == {(1, 2, ids, "hello world"), (None, 0, b"", ""), (3, 0, b"", "")}
    assert bpe.bpe_encode(df).count() == 4
    assert bpe.bpe_encode(df.limit(0)).count() == 0


def test_corpus(spark, small_dir, pair):
    _, t = pair
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()}
    for r in bpe.op8_bpe(spark, small_dir).collect():
        ids = t.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
