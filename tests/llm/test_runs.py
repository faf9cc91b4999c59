"""Periodic runs against a plain scan of every period, odd rows included."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from muster.llm import runs

SCHEMA = "doc_id long, text string, key string, runs int, n_words int, collapsed string, start int"


def scan(words):
    """(start, period, length) of every run, by walking each period."""
    found = {}
    for p in range(1, len(words) // 3 + 1):
        i = 0
        while i + p < len(words):
            s = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i + p - s >= max(24, 3 * p):
                found.setdefault((s, i + p), p)
            i += 1
    return sorted((s, p, e - s) for (s, e), p in found.items())


def random_text(rng):
    k, n = rng.choice([1, 2, 3, 50]), rng.choice([0, 1, 5, 23, 24, 30, 100, 300])
    words = []
    while len(words) < n:
        if rng.random() < 0.4:
            words += [rng.randrange(k) for _ in range(rng.choice([1, 2, 3, 4, 7, 8, 9, 12, 31, 40]))] * rng.randrange(1, 9)
        else:
            words += [rng.randrange(k) for _ in range(rng.randrange(1, 30))]
    return words[:n]


@pytest.mark.parametrize("places, periods", [(1 << 20, 1 << 18), (50, 7)])
def test_find(monkeypatch, places, periods):
    monkeypatch.setattr(runs, "PLACES", places)
    monkeypatch.setattr(runs, "PERIODS", periods)
    rng = random.Random(places)
    for _ in range(60):
        texts = [random_text(rng) for _ in range(rng.randrange(1, 12))]
        start, length, period = runs.find(np.array([w for t in texts for w in t], np.int64), np.array([len(t) for t in texts]))
        want, offset = [], 0
        for text in texts:
            want += [(offset + s, n, p) for s, p, n in scan(text)]
            offset += len(text)
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == want


def test_names_are_equal_for_equal_words_only():
    rng = random.Random(1)
    words = np.array([*([rng.randrange(3) for _ in range(40)] * 6), *range(100, 100 + runs.COVER)], np.int64)
    plain = runs.Extensions(words)
    names = plain._names(np.arange(len(words) - runs.COVER))
    windows = [tuple(words[i:i + runs.COVER]) for i in range(len(words) - runs.COVER)]
    for i in range(0, len(windows), 7):
        for j in range(0, len(windows), 5):
            assert (names[i] == names[j]) == (windows[i] == windows[j])


def test_sampled_places_cover_all_distances():
    found = {(a - b) % runs.COVER for a in runs.SAMPLED for b in runs.SAMPLED}
    assert found == set(range(runs.COVER))


def answer(number, text):
    """The row of one document by the plain scan."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, check = len(words), zlib.crc32(str(number).encode())
    if number is not None and check % 10 == 0 and n:
        g = check // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = scan(words)
    gone = {i for s, p, length in found for i in range(s + p, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{p}\n" for s, p, length in found)
    return (number, len(found), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4),
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_rows(spark):
    rng = random.Random(6)
    texts = ["", None, " \n\t", "one", "a " * 23, "a " * 24, "a b c " * 8, "x y " * 40 + "tail", "été straße\x0b日本 " * 30,
             "u\x85v\xa0w\x1c " * 30, "b " * 30 + "c " * 30, "q r " * 30 + "q r s " * 20, "z" * 5000]
    texts += [" ".join(rng.choice("abcdefghijk") for _ in range(rng.randrange(400))) for _ in range(120)]
    texts += [" ".join("abcdefghijkl"[w % 12] for w in random_text(rng)) for _ in range(60)]
    rows = [(i * 3, t, "k", 1, 2, "c", 3) for i, t in enumerate(texts)]
    rows += [(None, "a " * 90, None, None, None, None, None), rows[7], rows[7]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = runs.digests(runs.collapse(runs.with_periods(docs))).collect()
    assert sorted(map(tuple, got), key=str) == sorted((answer(r[0], r[1]) for r in rows), key=str)
    assert runs.digests(runs.collapse(runs.with_periods(docs.limit(0)))).collect() == []


def test_collapse_keeps_texts_and_spans(spark):
    docs = spark.createDataFrame([(1, "start " + "la la  land\n" * 10 + "end")], "doc_id long, text string")
    row = runs.collapse(docs).first()
    assert (row.n_words, row.collapsed, row.strongest) == (32, "start la la land end", 0)
    assert [tuple(r) for r in row.runs] == [(1, 30, 3)]


def test_long_texts():
    rng = random.Random(3)
    part = [rng.randrange(5000) for _ in range(40_000)]
    for words, want in ((part * 5, [(0, 200_000, 40_000)]), ([1] * 100_000, [(0, 100_000, 1)]), (part, [])):
        found = runs.find(np.array(words, np.int64), np.array([len(words)]))
        assert list(zip(*(f.tolist() for f in found))) == want
