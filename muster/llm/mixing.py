"""Mixing sources by temperature, in built-in functions only.

Each source's share of the tokens is raised to an exponent between 0 (all alike)
and 1 (as they are) and normalised. The exponent is found by bisection, so that
the mix meets a target entropy or a limit on how often any source repeats. The
weights then become token budgets, and a budget becomes passes: whole passes
over the source, each in an order of its own, and a last one that stops at the
budget.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.common import GAPS, cut
from muster.operators.joins import split_join
from muster.session import shared_folder

BLOCK_ROWS = 10_000  # rows of a source that share a block of its permutation, on average


def word_count(text: Column) -> Column:
    """Words of a text, the token measure of a mix; a null text has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), GAPS), "")).cast("long")


def _group(source: Column) -> Column:
    """A join key that keeps null sources together and apart from empty ones."""
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit("+"), source.cast("string")))


def _measures(shares: DataFrame, exponents: list[float], budget: float) -> dict[float, tuple[float, float, float]]:
    """{exponent: (normaliser, entropy, most passes)}; a source row is met once per
    exponent and combined where it lies, one row an exponent reaches the driver."""
    raised = shares.select("share", "tokens", F.explode(F.array(*map(F.lit, exponents))).alias("a"))
    raised = raised.withColumn("w", F.pow("share", "a"))
    found = raised.groupBy("a").agg(F.sum("w").alias("z"), F.sum(F.col("w") * F.col("a") * F.log("share")).alias("s"),
                                    F.max(F.col("w") / F.col("tokens")).alias("m")).collect()
    return {r.a: (r.z, math.log(r.z) - r.s / r.z, budget * r.m / r.z) for r in found}


def exponent(shares: DataFrame, budget: float, max_passes: float | None, entropy: float | None,
             rounds: int = 10, ways: int = 16) -> tuple[float, float]:
    """(exponent, normaliser). Both measures fall as the exponent rises, so each
    round keeps the one of ``ways`` equal parts in which the goal is crossed,
    four bisections in a pass. With ``entropy`` (nats) the mix comes as near it as
    0..1 allows; with ``max_passes`` it is as even as the limit allows; with both
    the limit goes first. A limit below budget / tokens cannot be met: exponent 1."""

    def too_even(m):
        return (max_passes is not None and m[2] > max_passes) or (entropy is not None and m[1] > entropy)

    low, high = 0.0, 1.0
    at = _measures(shares, [low, high], budget)
    if not too_even(at[low]):
        return low, at[low][0]
    if too_even(at[high]):
        return high, at[high][0]
    for _ in range(rounds):
        points = [low + (high - low) * i / ways for i in range(ways + 1)]
        at = _measures(shares, points, budget)
        high = min(p for p in points if not too_even(at[p]))
        low = max(p for p in points if p < high)
    return high, at[high][0]


def plan(rows: DataFrame, budget: int | None, max_passes: float | None, entropy: float | None) -> DataFrame:
    """One row per source of ``rows(group, key, tokens)``: weight, whole passes and
    where the last pass ends (block, hash, key)."""
    sources = cut(rows.groupBy("group").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")).where("tokens > 0"))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = total if budget is None else budget
    shares = sources.withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    power, norm = exponent(shares, budget, max_passes, entropy) if total else (1.0, 1.0)
    weighed = shares.withColumn("weight", F.pow("share", F.lit(power)) / F.lit(norm)).withColumn(
        "budget", F.floor(F.col("weight") * F.lit(float(budget)) + 1e-6).cast("long")
    )
    passes = cut(weighed.select(
        "group", "weight", "budget", F.expr("budget div tokens").alias("passes"),
        F.expr("budget % tokens").alias("rest"), F.ceil(F.col("n") / BLOCK_ROWS).cast("long").alias("blocks"),
    ))
    placed = split_join(rows, passes, ["group"]).select(
        "group", "key", "tokens", "rest", _order("key", "passes").alias("h"), "blocks"
    ).withColumn("block", _block("h", "blocks"))
    totals = placed.groupBy("group", "block").agg(F.sum("tokens").alias("t"), F.first("rest").alias("rest"))
    before = F.expr("sum(t) OVER (PARTITION BY group ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    split = totals.select("group", "block", "rest", "t", before.alias("upto")).where("upto > rest")
    split = split.groupBy("group").agg(F.min(F.struct("block", (F.col("rest") - F.col("upto") + F.col("t")).alias("left"))).alias("x"))
    split = cut(split.select("group", F.col("x.block").alias("block"), F.col("x.left").alias("left")))
    # only the block in which a budget ends is put in order, some thousand rows a source
    upto = F.expr("sum(tokens) OVER (PARTITION BY group ORDER BY h, key, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    inside = placed.join(split, ["group", "block"]).select("group", "h", "key", "left", upto.alias("upto")).where("upto <= left")
    last = inside.groupBy("group").agg(F.max(F.struct("h", "key")).alias("last"))
    ends = split.select("group", F.col("block").alias("end_block")).join(last, "group", "left")
    return cut(passes.join(ends, "group", "left"))


def _order(key: str, number: str) -> Column:
    """Place of a row in a pass; every pass has its own order."""
    return F.xxhash64(F.col(key), F.col(number))


def _block(h: str, blocks: str) -> Column:
    """Equal ranges of the hash, from the smallest up."""
    unit = (F.shiftright(F.col(h), 11).cast("double") + F.lit(float(1 << 52))) / F.lit(float(1 << 53))
    return F.least(F.floor(unit * F.col(blocks)), F.col(blocks) - 1).cast("long")


def mix(docs: DataFrame, budget: int | None = None, max_passes: float | None = 4.0, entropy: float | None = None,
        key: str = "doc_id", source: str = "source", text: str = "text", tokens: str | None = None) -> DataFrame:
    """The rows of the mix: all columns of ``docs``, then mix_pass (from 0) and
    mix_order, the row's place in its source's pass.

    Tokens are words of ``text`` or the column ``tokens``. ``budget`` is in
    tokens, as many as there are by default. A source whose budget passes its
    tokens repeats; one whose budget is less keeps the rows first in its
    permutation. Rows of a null source form a source. A source without tokens has
    no weight and leaves the mix, as does a null count; a null key takes part;
    repeated rows are rows each, and equal rows at the end of a budget stay or go
    together. An empty table gives no rows. Columns of the input named like the two
    added ones are replaced.

    Sources are planned on (source, key, tokens). The plan has one row a source; it is
    joined to the rows where they lie if the planner finds it small, else the rows of a
    large source are dealt out over many tasks. No text moves in the first case.
    """
    measure = (F.col(tokens) if tokens else word_count(F.col(text))).cast("long")
    rows = docs.select(_group(F.col(source)).alias("group"), F.col(key).alias("key"), measure.alias("tokens"))
    path = f"{shared_folder(docs.sparkSession)}/mix-{uuid.uuid4().hex}"
    # a table, whose size the planner knows
    plan(cut(rows.where("tokens is not null")), budget, max_passes, entropy).write.parquet(path)
    ends = docs.sparkSession.read.parquet(path)
    kept = [c for c in docs.columns if c not in ("mix_pass", "mix_order")]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), _group(F.col(source)).alias("group"),
                       F.col(key).alias("key"), measure.alias("tokens")).where("tokens is not null")
    met = split_join(held, ends, ["group"], by=["key", "tokens"]).withColumn("h", _order("key", "passes")).withColumn("block", _block("h", "blocks"))
    early = (F.col("block") < F.col("end_block")) | (
        (F.col("block") == F.col("end_block"))
        & ((F.col("h") < F.col("last.h")) | ((F.col("h") == F.col("last.h")) & (F.col("key").isNull() | (F.col("key") <= F.col("last.key")))))
    )
    again = F.when((F.col("rest") > 0) & F.coalesce(early, F.lit(False)), 1).otherwise(0)
    times = F.col("passes") + again
    out = met.where(times > 0).select("row", "key", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)).alias("mix_pass"))
    return out.select("row.*", F.col("mix_pass").cast("int").alias("mix_pass"), _order("key", "mix_pass").alias("mix_order"))
