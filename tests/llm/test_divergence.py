"""Divergence of sources against a plain count and against SQL, odd rows included."""

import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from muster.llm import divergence, queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, place int, rank int"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    seen, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = {t for t, n in seen[lang].items() if n >= least}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


def corpus(sources, n, seed):
    rng = random.Random(seed)
    words = ["Alpha", "ALPHA", "beta", "été", "Été", "straße", "日本語", "x", "averyveryverylongword", "averyveryverylongwork",
             "12", "a1b", "don't", "eight888", "eightabc", "eightabcd", "z" * 40, "z" * 41, "\x85k"]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words) + rng.choice(["", "", "q", "\n", "."]) for _ in range(rng.randrange(60)))
        rows.append((i, text, rng.choice(["en", "en", "en", "fr", "", None]),
                     None if i % 17 == 0 else f"s{int(rng.random() ** 3 * sources)}", "t", 1, 2, 3))
    return rows + [(None, None, None, None, None, None, None, None), (1, None, "qq", "only", "t", 1, 2, 3),
                   (2, "rare words", "xx", "b", "t", 1, 2, 3), (3, "", "xx", "a", "t", 1, 2, 3), rows[5], rows[5]]


@pytest.mark.parametrize("sources, least, top", [(5, 3, 4), (150, 2, 50)])
def test_audit(spark, sources, least, top):
    """The second case has more sources than a block holds."""
    rows = corpus(sources, 400, sources)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(divergence.audit(docs, least, top)) == plain(rows, least, top)


def test_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert divergence.audit(docs).collect() == []


def test_one_hot_source_and_term(spark):
    rows = [(i, "the " * 50 + f"w{chr(97 + i % 26)}", "en", "big" if i % 3 else f"s{i % 5}", "t", 1, 2, 3) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(divergence.audit(docs, 2, 50)) == plain(rows, 2, 50)


def test_sorted_runs():
    """Pointers by term, equal ones in the order given."""
    rng = random.Random(2)
    terms = ["".join(rng.choice("ab") for _ in range(rng.choice([1, 7, 8, 9, 16, 17, 300]))) for _ in range(400)]
    terms += terms[:200]
    text = " ".join(terms).encode()
    buffer = np.frombuffer(text + bytes(divergence.DEEP), np.uint8).copy()
    starts, lengths, _ = divergence._pointers(buffer[:-divergence.DEEP], np.array([0, len(text)]))
    order, new = divergence._sorted_runs(buffer, starts, lengths)
    assert order.tolist() == sorted(range(len(terms)), key=lambda i: terms[i])
    ranked = [terms[i] for i in order]
    assert new.tolist() == [i == 0 or ranked[i] != ranked[i - 1] for i in range(len(ranked))]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
def test_sql_twin(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    df = queries.op13_divergence(spark, FOLDER)
    names = ", ".join(df.columns)
    want = con.execute(f"SELECT {names} FROM ({queries.ORACLES['op13_divergence']})").fetchall()
    assert got(df) == sorted(want)
