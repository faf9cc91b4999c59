"""The near-copy stage of the pipeline against brute force over all pairs of fingerprints."""

import random

import corpus_pipeline
from muster.llm import simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, mark int"


def edited(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def texts():
    rng, out = random.Random(8), []
    for size, copies in ((40, 3), (200, 30), (600, 120)):
        words = [f"w{rng.randrange(5000)}" for _ in range(size)]
        out += [edited(rng, words, k % 4) for k in range(copies)]
        out += [" ".join(f"w{rng.randrange(5000)}" for _ in range(size)) for _ in range(10)]
    return out + ["", " ", None, "one", "One", "one\ttwo", "x" * 50_000]


def groups(found):
    """Numbers of the texts of each group, by walking all pairs."""
    prints = [simhash.fingerprint(t) for t in found]
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4:
                root[max(top(i), top(j))] = min(top(i), top(j))
    out = {}
    for i in range(len(prints)):
        out.setdefault(top(i), []).append(i)
    return list(out.values())


def test_one_row_of_each_group_stays(spark):
    found = texts()
    rows = [(i * 7 % 1009, t, "en", "s", len(t or ""), "k", 1) for i, t in enumerate(found)]
    docs = spark.createDataFrame(rows + rows[:9], SCHEMA).repartition(4)
    kept = corpus_pipeline.near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    assert sorted(r[0] for r in got) == sorted(min(rows[i][0] for i in g) for g in groups(found))
    assert set(got) <= set(rows)


def test_null_and_repeated_ids_keep_their_texts(spark):
    rng = random.Random(3)
    prose = [" ".join(f"w{rng.randrange(5000)}" for _ in range(80)) for _ in range(6)]
    ids = [None, None, 5, 5, None, 1]
    rows = [(d, t, None, None, None, None, None) for d, t in zip(ids, prose)]
    rows += [rows[0], (2, prose[5], None, None, None, None, None), (None, prose[2], "x", None, None, None, None)]
    got = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(zip(ids, prose), key=str)
    assert corpus_pipeline.near_copies(spark, spark.createDataFrame([], SCHEMA), "").count() == 0
