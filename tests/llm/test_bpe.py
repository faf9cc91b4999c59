"""Byte-level BPE against the library, words of any length and odd rows included."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from muster.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, key string, ids int, decoded int, n_tokens int"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def texts():
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    code = lambda: chr(rng.choice([
        rng.randrange(32, 127), rng.randrange(0xA0, 0x3000), rng.randrange(0x4E00, 0x9FFF),
        rng.randrange(0x1F300, 0x1F700), 9, 10, 13, 0x1C, 0x85, 0xA0]))
    return [
        "", " ", "a", "it's we'll  I'D\n\n x\t\ty", "<|endoftext|> 12345678901", "straße naïve 日本語のテキスト" * 20,
        "a" * 1000, "ab" * 700, "abc" * 3000, "abcde" * 1111, "-" * 5000, "\t \n" * 300, "\x00\x1f" * 90, "z" * 200_000,
        *["".join(rng.choice(letters) for _ in range(rng.randrange(100, 1500))) for _ in range(6)],
        *["".join(rng.choice("ab") for _ in range(rng.randrange(100, 1500))) for _ in range(6)],
        *["".join(rng.choice("etaoinshr") for _ in range(7)) * rng.randrange(20, 200) for _ in range(6)],
        *["".join(code() for _ in range(300)) for _ in range(30)],
        " ".join(rng.choice(letters) + str(rng.randrange(90)) for _ in range(20_000)),
    ]


def expected(library, text):
    ids = library.encode_ordinary(text)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())


def test_digests(spark, library):
    rows = [(i, t, "k", 1, 2, 3) for i, t in enumerate(texts())]
    rows += [(None, "no id at all", None, None, None, None), rows[3], rows[3], (900, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = bpe.digests(docs, PATH).collect()
    assert len(got) == len(rows)
    want = [(r[0], *expected(library, r[1] or "")) for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.digests(docs.limit(0), PATH).collect() == []


def test_ids_and_bytes(spark, library):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts()[:12])] + [(99, None)], "doc_id long, text string")
    for row in bpe.encode_texts(docs, PATH).collect():
        text = dict(enumerate(texts())).get(row.doc_id, "") if row.doc_id != 99 else ""
        assert row.ids == library.encode_ordinary(text)
        assert bytes(row.decoded) == text.encode()


def test_walk_equals_whole(library):
    """The way for words whose blocks share no border, on words of every kind."""
    coder = bpe.Bpe(PATH)
    rng = random.Random(8)
    for letters in ("ab", "abcdefgh", "-="):
        word = "".join(rng.choice(letters) for _ in range(700)).encode()
        assert coder._walk(word).tolist() == library._core_bpe.encode_single_piece(word)
        assert coder._long(word).tolist() == library._core_bpe.encode_single_piece(word)


def test_memo_starts_again(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 2000)
    monkeypatch.setattr(bpe, "WORDS", 40)
    text = " ".join(f"word{i} other{i % 7}" for i in range(500))
    found = bpe._Digests(PATH, [text, "", text])
    assert [(c, a.hexdigest(), b.hexdigest()) for c, a, b in zip(found.counts, found.ids, found.decoded)] == [
        expected(library, t) for t in (text, "", text)]
