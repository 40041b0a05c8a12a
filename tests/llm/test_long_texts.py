"""Long texts encoded in portions give what they give whole."""

import functools
import hashlib
import random
import struct

import pytest
from tokenizers import Tokenizer

from cuelake.llm import bpe, queries

PARTS = ["it's", "we're", "they'll", "I've", "'r", "e", "'", "l", " ", "  ", "\n", "\t\n ", "!?", "word", "Übung", "日本語", "é", "123", "²", "<|endoftext|>", "<|endof", "text|>", " ", " x", "\x1c", "\U0001f600"]


@pytest.fixture(scope="module")
def path():
    return queries.vocabulary()


@functools.cache
def library_of(path):
    return Tokenizer.from_file(path)


def whole(path, texts):
    library = library_of(path)
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        yield len(ids), struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("width", [1, 7, 40])
def test_portions(path, monkeypatch, width):
    rng = random.Random(width)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 120))) for _ in range(150)]
    texts += ["", " " * 90, "a" * 90, "we're" * 30, "<|endoftext|>" * 12, "x <|endoftext|> y" * 9, "'" * 50 + "ll" * 20]
    monkeypatch.setattr(bpe, "BATCH_CHARS", width)
    own = bpe.Encoder(path)
    for text in texts:
        parts = list(own.portions(text))
        assert [w for p in parts for w in p] == own.pieces(text)
        n, ids, raw = own.encode_long(text)
        assert (n, ids, bpe.decoded_text(raw)) == next(whole(path, [text]))
    assert max(len(list(own.portions(t))) for t in texts) > 1


def test_long_rows(spark, path, monkeypatch):
    rng = random.Random(5)
    long = "".join(rng.choice(["alpha ", "beta's ", "7 ", "gamma\n"]) for _ in range(450_000))
    assert len(long) > bpe.BATCH_CHARS
    texts = ["short", long, None, "", "x" * (bpe.LONG_WORD + 5), "last"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encode_digests(docs, path).collect()}
    for k, (n, ids, decoded) in enumerate(whole(path, [t or "" for t in texts])):
        assert got[k] == (n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_long_word_has_the_same_states(path, monkeypatch):
    words = [b"abcabcabd" * 40, b"abcabc", b"\xc3\xa9" * 30]
    plain = dict(bpe.Encoder(path).encode_words(words))
    monkeypatch.setattr(bpe, "LONG_WORD", 1)
    assert dict(bpe.Encoder(path).encode_words(words)) == plain
