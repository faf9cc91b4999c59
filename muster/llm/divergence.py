"""How far the sources of a language differ in their terms.

A task points at every term start in the Arrow buffer of its texts and sorts the
pointers by what they point at, eight bytes at a time: multikey quicksort, whose
slices of equal bytes go on to the next eight. Equal runs then give, without one
string having been made, each term's documents and its count per source. These
counts, added up over all tasks, decide which terms are kept and how likely each
source makes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from muster.llm.common import map_batches
from muster.session import shared_folder

SLICE = 8 << 20  # bytes of the texts sorted together
DEEP = 8  # bytes compared at once
BLOCK = 64  # sources compared with each other at once


def _pointers(texts: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text of every term: letters of ASCII, lower-cased before, and all
    beyond ASCII. No term crosses the border of two texts."""
    inside = ((texts >= 0x61) & (texts <= 0x7A)) | (texts >= 0x80)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < len(texts)]
    first[heads] = inside[heads]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts, np.searchsorted(offsets, starts, "right") - 1


def _sorted_runs(texts: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pointers' order by term, equal terms in the order given, and where runs of equal terms begin.

    ``texts`` ends with DEEP spare bytes. No term holds a zero byte, so a term that ends is padded with zeros.
    """
    windows = np.ndarray((len(texts) - DEEP + 1,), ">u8", texts.data, strides=(1,))
    masks = np.array([((1 << 64) - 1) ^ ((1 << (64 - 8 * n)) - 1) for n in range(DEEP + 1)], np.uint64)

    def character(rows: np.ndarray, depth: int) -> np.ndarray:
        rest = np.clip(lengths[rows] - depth, 0, DEEP)
        place = np.minimum(starts[rows] + depth, len(windows) - 1)
        return windows[place].astype(np.uint64) & masks[rest]

    order = np.arange(len(starts))
    new = np.zeros(len(starts), bool)
    new[:1] = True
    at, depth = order.copy(), 0  # places of the order that are not settled yet: slices of more than one pointer
    while len(at):
        rows = order[at]
        part = np.cumsum(new[at])
        char = character(rows, depth)
        turn = np.lexsort((char, part)) if depth else np.argsort(char, kind="stable")
        rows, char = rows[turn], char[turn]
        order[at] = rows
        new[at[1:]] |= char[1:] != char[:-1]  # a new slice is marked already
        depth += DEEP
        heads = np.flatnonzero(new[at])
        sizes = np.diff([*heads, len(at)])
        longest = np.maximum.reduceat(lengths[rows], heads)
        at = at[np.repeat((sizes > 1) & (longest > depth), sizes)]
    return order, new


def _gather(texts: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The pointed-at stretches as strings."""
    edges = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(lengths, out=edges[1:])
    flat = texts[np.arange(edges[-1]) + np.repeat(starts - edges[:-1], lengths)]
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(flat))


def _count(batch: pa.RecordBatch) -> dict:
    """Counts of one slice of rows (lang, source, text), by (lang, source, term)."""
    both = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], names=["lang", "source"])
    names = {}
    group = np.array([names.setdefault((r["lang"], r["source"]), len(names)) for r in both.to_pylist()], np.int64)
    order = np.argsort(group, kind="stable")
    group = group[order]
    column = batch.column(2).take(pa.array(order)).cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    texts = np.zeros(offsets[-1] - offsets[0] + DEEP, np.uint8)
    if len(texts) > DEEP:
        texts[:-DEEP] = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    upper = (texts >= 0x41) & (texts <= 0x5A)
    texts[upper] += 0x20
    starts, lengths, text = _pointers(texts[:-DEEP], offsets - offsets[0])
    order, new = _sorted_runs(texts, starts, lengths)
    owner, text = group[text[order]], text[order]
    cell = new.copy()
    cell[1:] |= owner[1:] != owner[:-1]
    row = cell.copy()
    row[1:] |= text[1:] != text[:-1]
    heads = np.flatnonzero(cell)
    langs, sources = zip(*names) if names else ((), ())
    kept = order[heads]
    return {
        "lang": pa.array(langs, pa.string()).take(pa.array(owner[heads])),
        "source": pa.array(sources, pa.string()).take(pa.array(owner[heads])),
        "term": _gather(texts, starts[kept], lengths[kept]),
        "n": np.diff([*heads, len(order)]),
        "docs": np.add.reduceat(row.astype(np.int64), heads) if len(heads) else np.empty(0, np.int64),
    }


def _cells(docs: DataFrame) -> DataFrame:
    """Per task and slice: (lang, source, term, n, docs), the term's count and its documents."""
    schema = "lang string, source string, term string, n long, docs long"
    types = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(batch.column(3).to_numpy())
            first = 0
            while first < batch.num_rows:
                before = sizes[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(sizes, before + SLICE, "right")))
                yield pa.RecordBatch.from_pydict(_count(batch.slice(first, last - first)), schema=types)
                first = last

    return docs.mapInArrow(run, schema)


def _written(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def _share(n: str, total: str, terms: str) -> Column:
    """Smoothed share of a term in billionths, from 1 up, in whole numbers."""
    return F.expr(f"1 + (cast(1000000000 as decimal(19, 0)) * cast({n} + 5 as decimal(19, 0))) "
                  f"div cast({total} + 5 * {terms} as decimal(38, 0))")


def _pair_sums(rows: DataFrame) -> DataFrame:
    """Sums of differences between two blocks of sources: rows (lang, x, y, xs, ys, seen) with the
    blocks' numbers, the shares of sources that lack the term, and (place, share) of those that have it."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            lang = batch.column(0).dictionary_encode()
            code, x, y = (c.to_numpy(zero_copy_only=False) for c in (lang.indices, batch.column(1), batch.column(2)))
            seen = batch.column(5)
            edges = seen.offsets.to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(edges))
            values = seen.values.slice(edges[0], edges[-1] - edges[0])
            place, share = (values.field(i).to_numpy() for i in range(2))
            order = np.lexsort((y, x, code))
            out: dict[str, list] = {"lang": [], "a": [], "b": [], "value": []}
            keys = np.stack([code, x, y])[:, order]
            heads = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), len(order)]
            where = np.empty(len(order), np.int64)
            where[order] = np.arange(len(order))
            entries = np.argsort(where[owner], kind="stable")
            at = np.searchsorted(where[owner][entries], heads)
            for low, high, first, last in zip(heads, heads[1:], at, at[1:]):
                row = order[low]
                mine = entries[first:last]
                line, spot, p = where[owner[mine]] - low, place[mine], share[mine]

                def filled(block, column):
                    dense = np.tile(np.array(batch.column(column)[int(row)].as_py(), np.int64), (high - low, 1))
                    inside = spot // BLOCK == block
                    dense[line[inside], spot[inside] % BLOCK] = p[inside]
                    return dense

                left, right = filled(x[row], 3), filled(y[row], 4)
                sums = np.stack([np.abs(left[:, [i]] - right).sum(axis=0) for i in range(left.shape[1])])
                a, b = np.indices(sums.shape).reshape(2, -1)
                a, b = a + x[row] * BLOCK, b + y[row] * BLOCK
                once = a < b
                out["lang"].append(np.full(once.sum(), lang.dictionary[int(code[row])].as_py(), object))
                for name, column in (("a", a), ("b", b), ("value", sums.reshape(-1))):
                    out[name].append(column[once])
            return {name: np.concatenate(parts) for name, parts in out.items()}
        return work

    return map_batches(rows, "lang string, a int, b int, value long", make)


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source's terms are from the other
    sources of its language (part ``pair``) and which terms it has more often than the language
    (part ``term``, ranks to ``top``). Terms in fewer than ``least_docs`` rows of a language
    do not count.

    Null text, language or source is ''. Each row is a document, repeated rows too. A group
    without terms takes part, with shares of its own; in a language without kept terms all
    values are 0. One source alone in a language has no pair. An empty table gives no rows.
    Other columns are left out. Ties of value go by the item's bytes.

    Texts are read once and only counts move. A row of counts a (lang, term) has an entry per
    source at most; sources are compared in blocks of ``BLOCK``, so no task holds more than one
    pair of blocks. Counts and sources are written to the shared folder.
    """
    folder = f"{shared_folder(docs.sparkSession)}/divergence-{uuid.uuid4().hex}"
    plain = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    # Dealt by term, then counted by source: one shuffle serves both.
    counted = _cells(plain.withColumn("size", F.octet_length("text").cast("long"))).repartition("lang", "term")
    cells = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    cells = cells.select(
        "lang", "term", "source", "n",
        F.sum("n").over(term).alias("n_lang"), F.sum("docs").over(term).alias("docs"),
        (F.row_number().over(term.orderBy("source")) == 1).cast("long").alias("one"),
    ).where(F.col("docs") >= least_docs)
    cells = _written(cells.drop("docs"), folder, "cells")

    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = cells.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("one").alias("terms"))
    groups = plain.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    place = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("place")
    groups = _written(groups.na.fill(0, ["total", "lang_total", "terms"]).select("*", place), folder, "groups")

    shares = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "place", _share("n", "total", "terms").alias("p"),
        _share("n_lang", "lang_total", "terms").alias("q"),
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                          (F.col("p") - F.col("q")).alias("value"))
    ranked = ranked.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    # The shares of a language's sources for a term they lack, in order of place.
    lacking = groups.where("terms > 0").groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("place", _share("0", "total", "terms").alias("p")))).alias("lacking"))
    seen = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("place", "p")).alias("seen"))
    rows = seen.join(lacking.select("lang", F.col("lacking.p").alias("lacking")), "lang")
    last = F.floor((F.size("lacking") - 1) / BLOCK).cast("int")
    rows = rows.withColumn("x", F.explode(F.sequence(F.lit(0), last))).withColumn("y", F.explode(F.sequence("x", last)))

    def block(number: str) -> Column:
        return F.slice("lacking", F.col(number) * BLOCK + 1, F.lit(BLOCK))

    def owned(e: Column) -> Column:
        return F.floor(e["place"] / BLOCK).isin(F.col("x"), F.col("y"))

    sums = _pair_sums(rows.select("lang", "x", "y", block("x").alias("xs"), block("y").alias("ys"),
                                  F.filter("seen", owned).alias("seen")))
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    # In a language without kept terms no source differs from another.
    silent = groups.where("terms = 0").select("lang", "place")
    zero = silent.withColumnRenamed("place", "a").join(silent.withColumnRenamed("place", "b"), "lang").where("a < b")
    sums = sums.unionByName(zero.withColumn("value", F.lit(0).cast("long")))
    ways = F.explode(F.array(F.struct(F.col("a").alias("of"), F.col("b").alias("to")),
                             F.struct(F.col("b").alias("of"), F.col("a").alias("to")))).alias("way")
    named = groups.select("lang", "source", "place")
    pairs = sums.select("lang", "value", ways).select("lang", "value", "way.*")
    pairs = pairs.join(named.withColumnRenamed("place", "of"), ["lang", "of"])
    pairs = pairs.join(named.select("lang", F.col("source").alias("item"), F.col("place").alias("to")), ["lang", "to"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(by_value)).unionByName(ranked)
