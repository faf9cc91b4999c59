"""Long runs of lines that look like keys, in linear time; base spans against a scan of their own."""

import hashlib
import random
import re
import time

import pytest

from muster.llm import secrets

SCHEMA = "doc_id long, text string, spans string, row int, key string"


@pytest.mark.parametrize("line", [
    "A" * 64, "MIGf" + "MA0GCSqGSIb3DQEB" * 3, "30" * 32, "30819f" + "30" * 29, "MIM" + "P//8C" + "AQAC" * 14,
    "AAAAB3NzaC1yc2E" + "A" * 49, "b3BlbnNzaC1rZXktdjEA" + "AAAA" * 11,
])
def test_long_runs_take_linear_time(line):
    text = "\n".join([line] * (10_000_000 // (len(line) + 1)))
    begin = time.perf_counter()
    found = secrets.scan(text)
    assert time.perf_counter() - begin < 20
    assert not [s for s in found if s[0] not in secrets.BASE_KINDS]


def base_spans(text):
    """The three base kinds read letter by letter, leftmost and apart."""
    found, plain = [], set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    at = 0
    while at < len(text):
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if low.startswith(word, at):
                i = at + len(word)
                i += text[i:i + 1] in ('"', "'") and i < len(text)
                while text[i:i + 1] == " ":
                    i += 1
                if text[i:i + 1] in (":", "=") and i < len(text):
                    i += 1
                    while text[i:i + 1] == " ":
                        i += 1
                    i += text[i:i + 1] in ('"', "'") and i < len(text)
                    end = i
                    while end < len(text) and text[end] in plain:
                        end += 1
                    if end > i:
                        if end - i >= 6:
                            found.append(("assign", at, end))
                        at = end - 1
                        break
        at += 1
    for kind, first, letters, least in (("access", "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 20),
                                        ("hex", "", "0123456789abcdef", 24)):
        at = 0
        while at < len(text):
            end = at
            if text.startswith(first, at):
                end = at + len(first)
                while end < len(text) and text[end] in letters:
                    end += 1
            if end - at >= least:
                found.append((kind, at, end))
            at = max(end, at + 1)
    return sorted(found, key=lambda s: (s[1], secrets.BASE_KINDS.index(s[0])))


def test_base_spans_of_random_texts(spark):
    rng = random.Random(5)
    parts = ["password", "Passwd", "SECRET", "token", "apikey", "API_key", "api-key", "AKIA", "AKIA", ":", "=", " : ", " =", '"', "'", " ",
             "  ", "\n", "é", "日", "hunter2hunter2", "abc", "0123456789abcdef", "deadbeefdeadbeef", "ABCDEFGHIJ234567", "KLMN", ".", "-", "x" * 30]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(400)] + ["", None]
    docs = spark.createDataFrame([(i, t, "s", 1, "k") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = {r.doc_id: r for r in secrets.digests(secrets.find_secrets(docs)).collect()}
    some = 0
    for i, text in enumerate(texts):
        want = base_spans(text or "")
        counts = tuple(sum(s[0] == k for s in want) for k in secrets.BASE_KINDS)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == counts, text
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        some += bool(want)
    assert some > 100
