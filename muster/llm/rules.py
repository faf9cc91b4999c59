"""Quality rules combined by weak supervision.

Each rule reads a few counts of a text and votes good (1), bad (0) or abstains
(-1). Nobody says how far a rule can be trusted: expectation-maximisation
estimates how often each rule votes which way on good and on bad texts, and how many
texts are good, from how the votes fall together; the posterior probability of
quality decides, not a list of tests to pass all. Everything runs in built-in functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.common import cut

SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
FEW = 256  # repeated windows up to which a list search beats a sort


def _occurrences(text: Column, letters: str) -> Column:
    """How often any of the letters occurs, in code points."""
    return sum((F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in letters), F.lit(0))


def _covered(places: Column) -> Column:
    """Words under three-word windows that start at the given places."""
    one = F.transform(places, lambda i: i + 1)
    two = F.transform(places, lambda i: i + 2)
    return F.size(F.array_distinct(F.concat(places, one, two)))


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of counts per document, all of them long.

    Repeated words are those in a three-word window found twice or more. Windows
    are compared by 64-bit hashes made from the hashes of their words. Texts whose
    windows all differ are done after one set operation; the others look their
    windows up among the repeated ones, by list while those are few, else by sort.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(key).alias("key"), whole.alias("text"),
                       F.array_remove(F.split(whole, r"[ \t-\r]+"), "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^ \t-\r]"))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    first = base.select(
        "key",
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - _occurrences(F.col("text"), SPACE_CHARS)).cast("long").alias("word_chars"),
        _occurrences(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        _occurrences(F.col("text"), "!?").cast("long").alias("n_marks"),
        _occurrences(F.col("text"), ".").cast("long").alias("n_stops"),
        lines.alias("lines"),
        hashes.alias("h"),
    )
    n = F.greatest(F.size("h") - 2, F.lit(0))
    mix = lambda a, b: F.shiftleft(a, 5).bitwiseXOR(b)
    windows = F.zip_with(F.zip_with(F.slice("h", 1, n), F.slice("h", 2, n), mix), F.slice("h", 3, n), mix)
    second = first.select(
        "key", "n_words", "word_chars", "n_symbols", "n_marks", "n_stops",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = second.withColumn("sorted", F.when(some, F.sort_array("windows")))
    twice = F.filter("sorted", lambda x, i: (i > 0) & (x == F.get("sorted", i - 1)))
    third = ordered.withColumn("twice", F.array_distinct(twice)).drop("sorted")
    at = F.sequence(F.lit(0), F.size("windows") - 1)
    by_list = F.filter(at, lambda i: F.array_contains(F.col("twice"), F.get("windows", i)))
    placed = F.array_sort(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    fourth = third.withColumn("placed", F.when(F.size("twice") > FEW, placed))
    held = F.filter("placed", lambda x, i: F.coalesce(x["w"] == F.get("placed", i - 1)["w"], F.lit(False))
                    | F.coalesce(x["w"] == F.get("placed", i + 1)["w"], F.lit(False)))
    places = F.when(F.size("twice") <= FEW, by_list).when(F.size("twice") > FEW, F.transform(held, lambda x: x["i"]))
    fifth = fourth.withColumn("places", places)
    repeated = F.when(F.col("places").isNull(), 0).otherwise(_covered(F.col("places"))).cast("long")
    return fifth.select("key", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        repeated.alias("n_repeat_words"), "n_lines", "n_marks", "n_stops")


def votes() -> dict[str, Column]:
    """The rules. Each votes bad beyond one threshold, good on the safe side of another and
    abstains between the two. A kind of junk shows in several counts, and some counts
    have a strict and a lenient rule, so that votes on junk fall together."""
    words, lines, chars = (F.greatest(n, F.lit(1)) for n in ("n_words", "n_lines", "word_chars"))
    symbols, marks, stops = (F.col(n) / words for n in ("n_symbols", "n_marks", "n_stops"))
    again, repeats = F.col("n_dup_lines") / lines, F.col("n_repeat_words") / words
    punctuation = (F.col("n_symbols") + F.col("n_marks") + F.col("n_stops")) / chars
    letters, in_line = F.col("word_chars") / words, F.col("n_words") / lines
    rules = {
        "symbols": (symbols > 0.2, symbols <= 0.01),
        "some_symbols": (symbols > 0.05, symbols == 0),
        "marks": (marks > 0.2, marks <= 0.02),
        "some_marks": (marks > 0.08, marks == 0),
        "punctuation": (punctuation > 0.06, punctuation.between(0.005, 0.03)),
        "letters": (~letters.between(3.5, 6.5), letters.between(4.2, 5.8)),
        "stops": (~stops.between(0.01, 0.35), stops.between(0.03, 0.2)),
        "lines": (~in_line.between(4, 400), in_line.between(8, 150)),
        "dup_lines": ((again > 0.3) & (F.col("n_dup_lines") >= 3), again == 0),
        "repeats": (repeats > 0.3, repeats < 0.05),
        "some_repeats": (repeats > 0.1, repeats == 0),
    }
    some = F.col("n_words") > 0
    return {r: F.when(some & bad, 0).when(some & good, 1).otherwise(-1) for r, (bad, good) in rules.items()}


Rates = dict[str, dict[int, tuple[float, float]]]  # rule: {vote: (share among bad texts, among good ones)}
VOTES = (0, 1, -1)
START = {0: (0.3, 0.02), 1: (0.3, 0.8), -1: (0.4, 0.18)}  # rates before any text is seen
SHARE = 0.8  # of good texts, before any is seen


def fit(voted: DataFrame, names: list[str], trust: float = 0.1, rounds: int = 100,
        settled: float = 1e-5) -> tuple[float, Rates]:
    """(share of good texts, rates of votes) by expectation-maximisation.

    The expectation step gives each text its probability of quality under the current
    rates, the maximisation step counts each rule's votes on good and on bad texts by
    these probabilities. The rates it starts from weigh as ``trust`` times the texts of
    a class, a tenth, which keeps a rate from zero and says which class is the good one;
    all else is free. Both classes and their sizes are estimated, no label is read.

    Texts are first counted by vote pattern: at most ``3 ** rules`` rows whatever
    the corpus, so a round touches those alone and six sums a rule reach the driver.
    """
    patterns = cut(voted.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1))
    share, rates = SHARE, {r: dict(START) for r in names}
    for _ in range(rounds):
        good = posterior(share, rates)
        weighed = patterns.withColumn("good", F.col("n") * good).withColumn("bad", F.col("n") * (1 - good))
        sums = [F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad")]
        for r in names:
            for v in VOTES:
                sums += [F.sum(F.when(F.col(r) == v, F.col(c)).otherwise(0.0)).alias(f"{r} {v} {c}") for c in ("bad", "good")]
        found = weighed.agg(*sums).first()
        if not found["n"]:
            break
        new = {r: {v: tuple((found[f"{r} {v} {c}"] + trust * found[c] * start + 1e-9) / ((1 + trust) * found[c] + 3e-9)
                            for c, start in zip(("bad", "good"), START[v])) for v in VOTES} for r in names}
        moved = max(abs(a - b) for r in names for v in VOTES for a, b in zip(new[r][v], rates[r][v]))
        share, rates = min(1 - 1e-9, max(1e-9, found["good"] / found["n"])), new
        if moved < settled:
            break
    return share, rates


def posterior(share: float, rates: Rates) -> Column:
    """Probability that a text is good, given its votes."""
    odds = F.lit(math.log(share / (1 - share)))
    for r, by_vote in rates.items():
        steps = {v: math.log(good / bad) for v, (bad, good) in by_vote.items()}
        odds = odds + F.when(F.col(r) == 1, steps[1]).when(F.col(r) == 0, steps[0]).otherwise(steps[-1])
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(key, counts, votes, quality, base_failed, kept) of every row.

    A text fails the base where it has under 50 words or over half its words lie
    in repeated windows; else the posterior decides at ``threshold``. A null text
    has no words and fails; a null key stays null; repeated rows are judged each;
    an empty table gives no rows; other columns are left out. The counts are
    written once to the shared folder, texts are read once.
    """
    rules = votes()
    rows = cut(counted(docs, key, text).withColumns({f"vote_{r}": c for r, c in rules.items()}))
    share, rates = fit(rows, [f"vote_{r}" for r in rules])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        rows.withColumn("quality", posterior(share, rates))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("quality") >= threshold))
        .withColumnRenamed("key", key)
    )
