"""Conversations put in reply order by linking quotations.

A reply often quotes what it answers: lines led by ``>``, one mark a level. The
quoted passages of a message are taken out by level and normalised, and they, their
lines and their sentences are joined to what earlier messages wrote themselves; the
newest earlier message that wrote them is what the reply answers. Messages then follow what they
answer, and their own words remain without the quotations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.common import cut
from muster.operators.numbering import number_rows

SPAN = 10_000  # rows of a group read in one stretch

MARKS = r"^((?:[ \t]*>)*)[ \t]?(.*)$"
SENTENCE = r"(?<=[.!?…])[\"'”’)\]]*\s+|(?<=[。！？])"


def _lines(text: Column) -> Column:
    """(level, body) of every line; the level counts the leading quotation marks."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), r"\r\n|\n|\r"),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), r"[^>]", "")).alias("level"),
            F.regexp_extract(line, MARKS, 2).alias("body"),
        ),
    )


def _normal(text: Column) -> Column:
    """Lower case, only letters and digits, single spaces: line breaks and marks do not count."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def passages(messages: DataFrame) -> DataFrame:
    """(conv, at, level, part, passage, pieces) of ``messages(conv, at, lines)``, one row
    each: runs of lines of one level, cut at blank lines, normalised; those without a
    letter or digit are left out. Pieces are the lines and the sentences of a passage
    and the passage itself."""
    lines = messages.select("conv", "at", F.posexplode("lines").alias("i", "line"))
    lines = lines.select("conv", "at", "i", "line.level", F.col("line.body").alias("raw"), _normal(F.col("line.body")).alias("body"))
    # a passage starts where the level changes or after a line without words
    same = "OVER (PARTITION BY conv, at ORDER BY i)"
    starts = F.expr(f"CASE WHEN level <> lag(level) {same} OR lag(body) {same} = '' THEN 1 ELSE 0 END")
    numbered = lines.withColumn("start", starts).withColumn("part", F.expr(f"sum(start) {same}"))
    runs = numbered.where("body <> ''").groupBy("conv", "at", "part", "level").agg(
        F.array_sort(F.collect_list(F.struct("i", "body", "raw"))).alias("run")
    )
    bodies = F.transform("run", lambda x: x["body"])
    raw = F.array_join(F.transform("run", lambda x: x["raw"]), " ")
    sentences = F.transform(F.split(raw, SENTENCE), _normal)
    runs = runs.withColumn("passage", F.array_join(bodies, " "))
    pieces = F.array_distinct(F.array_remove(F.concat(bodies, sentences, F.array("passage")), ""))
    return runs.select("conv", "at", "level", "part", "passage", pieces.alias("pieces"))


def _running_max(rows: DataFrame, keys: list[str], place: str, value: str, name: str) -> DataFrame:
    """Add the largest ``value`` up to each row's place, from 1 in its group, null before the first.
    A group is read in stretches of ``SPAN`` rows and takes over the maxima of those before."""
    part = F.expr(f"({place} - 1) div {SPAN}")
    here = Window.partitionBy(*keys, "_part").orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = rows.withColumn("_part", part).withColumn("_here", F.max(value).over(here))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = marked.groupBy(*keys, "_part").agg(F.max(value).alias("_most"))
    parts = parts.select(*keys, "_part", F.max("_most").over(before).alias("_earlier"))
    return marked.join(parts, [*keys, "_part"]).withColumn(name, F.coalesce("_here", "_earlier")).drop("_part", "_here", "_earlier")


def _authors(found: DataFrame) -> DataFrame:
    """(conv, at, source) per message whose quotations meet an earlier message, its source.

    Each piece of a quotation goes to the latest message of an earlier turn that has it
    one level further out. A quoted passage goes to who has it as a whole passage, else
    to the message with most words of its pieces, then the latest; a message to the
    latest of its outermost passages that went to any. Writers and quotations of a
    piece are walked in turn order together, so no pairs are made.
    """
    rows = found.select("conv", "at", "level", "part", F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), F.col("passage").alias("piece"))),
        F.transform("pieces", lambda p: F.struct(F.lit(False).alias("whole"), p.alias("piece"))),
    )).alias("x")).select("conv", "at", "level", "part", "x.whole", "x.piece")
    wanted = rows.where("level > 0").withColumn("asks", F.lit(True))
    given = rows.withColumns({"level": F.col("level") + 1, "asks": F.lit(False)})
    given = given.join(wanted.select("conv", "level", "whole", "piece").distinct(), ["conv", "level", "whole", "piece"], "left_semi")
    # who quotes in a turn comes before who writes in it, so only earlier turns are seen
    every = wanted.unionByName(given).withColumns({"turn": F.col("at.turn"), "writes": ~F.col("asks"), "rank": F.col("at.rank")})
    of = ["conv", "level", "whole", "piece"]
    every = number_rows(every, of, ["turn", "writes", "rank", "part"]).withColumn("wrote", F.when(F.col("writes"), F.col("at")))
    met = _running_max(every, of, "place", "wrote", "source").where("asks and source is not null")
    words = F.sum(F.size(F.split("piece", " ")))
    covered = met.groupBy("conv", "at", "level", "part", "source").agg(F.max("whole").alias("whole"), words.alias("words"))
    chosen = covered.groupBy("conv", "at", "level", "part").agg(F.max_by("source", F.struct("whole", "words", "source")).alias("source"))
    return chosen.groupBy("conv", "at").agg(F.max_by("source", F.struct(-F.col("level"), "source")).alias("source"))


def link(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text without quotations, depth, n_quotes, parent_turn, linked, place) per message.

    A quotation at level 1 is matched to what messages of earlier turns of the
    conversation wrote at level 0, one at level n to what they quoted at level n - 1:
    as a whole passage, by its lines and by its sentences, short ones as well, always
    normalised and exact (see ``_authors``). A quotation that cuts lines and
    sentences alike meets nothing. The parent is the message that most of one of the
    outermost quotations comes from; without one it is the last message of the turn
    before (linked is false), the first has none. ``place`` numbers messages along the
    replies: by the turn of the conversation's branch, then by turn, so that an answer
    follows what it answers.

    A null text is empty; rows with a null conversation or turn are kept, link to
    nothing and have no place. Equal rows are one message and get the same values;
    rows of one (conversation, turn) that differ are a message each, with the smaller
    text first. An empty table gives no rows; other columns are left out. Only
    conversations with a quotation are taken apart.
    """
    rows = messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                           F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("lines", _lines(F.col("text")))
    depth = F.array_max(F.transform("lines", lambda x: x["level"]))
    own = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"]), "\n")
    row = F.xxhash64("text", "role", F.col("role").isNull())
    rows = rows.withColumns({"depth": depth, "own": own, "row": row})
    known = rows.where("conv is not null and turn is not null")
    kinds = known.groupBy("conv", "turn").agg(F.min("row").alias("one"), F.max("row").alias("other"))
    clash = kinds.where("one <> other").select("conv", "turn")
    ranks = known.join(clash, ["conv", "turn"], "left_semi").select("conv", "turn", "row", "text", "role").distinct()
    ranks = number_rows(ranks, ["conv", "turn"], ["text", "role", "row"], name="rank")
    ranks = cut(ranks.select("conv", "turn", "row", F.col("rank").cast("int").alias("rank")))
    at = F.struct("turn", F.coalesce("rank", F.lit(1)).alias("rank"))
    rows = rows.join(ranks, ["conv", "turn", "row"], "left").withColumn("at", at)
    quoting = rows.where("conv is not null and turn is not null and depth > 0").select("conv").distinct()
    taken = rows.where("turn is not null").select("conv", "at", "lines").join(quoting, "conv", "left_semi")
    found = cut(passages(taken.dropDuplicates(["conv", "at"])))
    quotes = found.where("level > 0").groupBy("conv", "at").agg(F.count("*").alias("n_quotes"))
    turns = kinds.select("conv", "turn").join(ranks.groupBy("conv", "turn").agg(F.max("rank").alias("last")), ["conv", "turn"], "left")
    turns = turns.withColumn("last", F.coalesce("last", F.lit(1)))
    turns = cut(number_rows(turns, ["conv"], ["turn"], name="no"))
    prior = turns.select("conv", (F.col("no") + 1).alias("no"), F.struct("turn", F.col("last").alias("rank")).alias("prior"))
    each = turns.join(prior, ["conv", "no"], "left").withColumn("rank", F.explode(F.sequence(F.lit(1), F.col("last"))))
    before = F.when(F.col("rank") > 1, F.struct("turn", (F.col("rank") - 1).alias("rank"))).otherwise(F.col("prior"))
    tree = each.select("conv", F.struct("turn", "rank").alias("at"), "prior", before.alias("before"))
    tree = tree.join(_authors(found), ["conv", "at"], "left").join(quotes, ["conv", "at"], "left")
    tree = tree.select("conv", F.col("at").alias("turn"), "before", F.coalesce("source", "prior").alias("parent"),
                       F.col("source").isNotNull().alias("linked"), F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"))
    placed = _in_reply_order(tree).withColumnRenamed("turn", "at")
    out = rows.join(placed, ["conv", "at"], "left")
    return out.select(F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role),
                      F.col("own").alias(text), "depth", F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
                      F.col("parent.turn").alias("parent_turn"), F.coalesce("linked", F.lit(False)).alias("linked"), "place")


def _in_reply_order(tree: DataFrame) -> DataFrame:
    """The tree with ``place``.

    Messages that each answer the one of the turn before form a run, which stands
    together: its next message is always the first of the answers. So only runs are
    put in order. Runs that answer one run come after it by place answered, latest
    first, then by own start. An Euler tour enters and leaves every run once; it is a
    chain of two links a run, whose distances to the end, in messages, are found by
    pointer doubling: each round a link skips as many others as the one it points to.
    A conversation of m runs takes log m rounds over 2 m rows, however they are nested.
    """
    numbered = number_rows(tree, ["conv"], ["turn"], name="no").withColumn("no", F.col("no").cast("long"))
    start = F.when(~F.col("parent").eqNullSafe(F.col("before")), F.col("no"))
    numbered = _running_max(numbered.withColumn("start", start), ["conv"], "no", "start", "run")
    numbered = cut(numbered.withColumn("run", F.coalesce("run", F.lit(1).cast("long"))))
    # a run is known by the number of its first message
    runs = numbered.groupBy("conv", "run").agg(F.count("*").alias("n"))
    heads = numbered.where("no = run").select("conv", "run", "parent")
    answered = numbered.select("conv", F.col("turn").alias("parent"), F.col("no").alias("at"), F.col("run").alias("up"))
    several = runs.where("run > 1").select("conv").distinct()
    zero = F.lit(0).cast("long")
    # what answers nothing hangs on run 0, which is none
    hung = heads.join(several, "conv", "left_semi").join(answered, ["conv", "parent"], "left").select(
        "conv", "run", F.coalesce("up", zero).alias("up"), F.coalesce(-F.col("at"), zero).alias("back"))
    hung = cut(number_rows(hung, ["conv", "up"], ["back", "run"]))
    child = hung.where("place = 1").select("conv", F.col("up").alias("run"), F.col("run").alias("child"))
    after = hung.select("conv", "up", (F.col("place") - 1).alias("place"), F.col("run").alias("sibling"))
    known = hung.join(after, ["conv", "up", "place"], "left").join(child, ["conv", "run"], "left").join(runs, ["conv", "run"])
    enter = F.struct((F.col("run") * 2).alias("id"), F.coalesce(F.col("child") * 2, F.col("run") * 2 + 1).alias("next"),
                     F.col("n").alias("left"))
    leave = F.struct((F.col("run") * 2 + 1).alias("id"),
                     F.coalesce(F.col("sibling") * 2, F.when(F.col("up") > 0, F.col("up") * 2 + 1)).alias("next"), zero.alias("left"))
    tour = cut(known.select("conv", F.inline(F.array(enter, leave))))
    while not tour.where("next is not null").isEmpty():
        ahead = tour.select("conv", F.col("id").alias("next"), F.col("left").alias("more"), F.col("next").alias("far"))
        gone = tour.where("next is not null").join(ahead, ["conv", "next"])
        gone = gone.select("conv", "id", F.col("far").alias("next"), (F.col("left") + F.col("more")).alias("left"))
        tour = cut(gone.union(tour.where("next is null").select("conv", "id", "next", "left")))
    left = tour.where("id % 2 = 0").select("conv", F.expr("id div 2").alias("run"), "left")
    sizes = runs.groupBy("conv").agg(F.sum("n").alias("all"))
    first = runs.join(sizes, "conv").join(left, ["conv", "run"], "left")
    first = first.select("conv", "run", (F.col("all") - F.coalesce("left", "all")).alias("before_run"))
    placed = numbered.join(first, ["conv", "run"])
    place = F.col("before_run") + F.col("no") - F.col("run") + 1
    return placed.withColumn("place", place.cast("int")).drop("no", "start", "run", "before_run", "before")
