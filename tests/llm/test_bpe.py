import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from meldstone.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def content():
    with open(PATH, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(content):
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines())}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    odd_spaces = [f"a{x}b {x}c {x} d{x}" for x in "\x1c\x1f\x85\xa0\u1680\u2003\u2028\u200b\u3000\ufeff\x0b\x00"]
    letters = "abcdefghijklmnopqrstuvwxyzéèßñ  \n\t.,'0123456789AÉ日本\U0001f600"
    odd = ["", " ", "   a", "a  b", "\n\n x", "it's we'll I'M", "<|endoftext|>", "aaaa" * 3000, " x", "é", "x" * 70_000]
    return odd + odd_spaces + ["".join(rng.choice(letters) for _ in range(rng.randrange(400))) for _ in range(400)]


def test_ids_equal_the_library(content, library):
    vocabulary = bpe.Vocabulary.parse(content, public_tokenizers.PATTERN)
    given = texts()
    for text, ids in zip(given, vocabulary.encode_all(given), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert vocabulary.decode(ids) == text.encode()


def test_merge_that_enables_an_earlier_rank():
    """Ranks that no training would give: merging b+c makes a+bc go before the other b+c."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"bc": 301, b"cb": 302, b"bcbc": 303, b"ab": 304}
    library = tiktoken.Encoding("t", pat_str=r"\w+|\W+", mergeable_ranks=ranks, special_tokens={})
    vocabulary = bpe.Vocabulary(ranks, r"\w+|\W+")
    rng = random.Random(5)
    given = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 14))) for _ in range(500)]
    for text, ids in zip(given, vocabulary.encode_all(given), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text


def test_blocks_and_forgetting_do_not_change_ids(content, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 50)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 700)
    monkeypatch.setattr(bpe, "KEPT_PIECES", 10)
    vocabulary = bpe.Vocabulary.parse(content, public_tokenizers.PATTERN)
    for given in (texts()[:60], texts()[30:90]):
        for text, ids in zip(given, vocabulary.encode_all(given), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)


def test_report(spark, library):
    rows = [(i, t) for i, t in enumerate([*texts()[:80], None, None])] + [(None, "x y"), (0, "")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, token_ids int")
    got = bpe.token_report(docs, bpe.Tokenizer(spark, PATH, public_tokenizers.PATTERN)).collect()
    want = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        want.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    tokenizer = bpe.Tokenizer(spark, PATH, public_tokenizers.PATTERN)
    one = bpe.tokenize(docs.where("doc_id < 20"), tokenizer, result="ids")
    parts = one.select("text", "ids", tokenizer.decode(one["ids"]).alias("back")).collect()
    assert all(bytes(r["back"]).decode() == (r["text"] or "") for r in parts) and len(parts) == 21
    assert bpe.token_report(docs.limit(0), bpe.Tokenizer(spark, PATH, public_tokenizers.PATTERN)).count() == 0


def test_a_batch_of_several_chunks(spark):
    docs = spark.range(30).selectExpr("id doc_id", "repeat(concat(' word', id, '.'), 80000) text").coalesce(1)
    report = bpe.token_report(docs, bpe.Tokenizer(spark, PATH, public_tokenizers.PATTERN))
    want = docs.selectExpr("doc_id", "sha2(text, 256) decoded_sha256")
    assert report.join(want, ["doc_id", "decoded_sha256"]).count() == report.count() == 30
