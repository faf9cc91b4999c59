"""Near copies by SimHash fingerprints, found through pigeonhole blocks.

A fingerprint is cut into ``blocks`` parts. Two fingerprints that differ in at
most ``distance`` bits agree in ``blocks - distance`` parts at least, so every
link is found among rows that share one of the combinations of that many parts.
Rows of a shared key are verified by their exact distance.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import re
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import cut, map_batches
from muster.llm.components import components
from muster.operators.joins import split_join

BITS = 64
UNIT = 1024  # fingerprints of one key compared in one piece; larger keys are dealt in pairs of pieces
_GAPS = re.compile(rb"[\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """SimHash of the word shingles, repeats counted; zero where there is no word."""
    parts = [w for w in _GAPS.split((text or "").encode("utf-8", "surrogatepass").translate(_LOWER)) if w]
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum([len(w) + 1 for w in parts])
    starts = [0, *ends[: len(parts) - words].tolist()]
    stops = (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], np.uint64)
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        some = hashes[at : at + 65_536]
        set_bits += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4) -> DataFrame:
    """(key, fp): the fingerprint as a signed long."""
    kind = docs.schema[key].dataType.simpleString()

    def make():
        return lambda batch: {
            "key": batch.column(0),
            "fp": np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64),
        }

    return map_batches(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), f"key {kind}, fp long", make)


def _forest(rows: np.ndarray, distance: int) -> np.ndarray:
    """Links (smallest member, member) that span the components of a few fingerprints."""
    n = len(rows)
    root = np.arange(n)
    close = np.bitwise_count(rows[:, None] ^ rows[None, :]) <= distance
    while True:
        least = np.where(close, root[None, :], n).min(1)
        least = np.minimum(least, least[least])
        if (least == root).all():
            break
        root = least
    return np.stack([rows[root], rows], 1)[root != np.arange(n)]


def _links(keys: DataFrame, distance: int) -> DataFrame:
    """Links among the rows of each unit; a task streams its units in order, so
    it holds one at a time."""

    def run(batches):
        held, unit = [], None

        def close():
            rows = np.unique(np.concatenate(held)) if held else np.zeros(0, np.int64)
            return _forest(rows.view(np.uint64), distance).view(np.int64) if len(rows) > 1 else np.zeros((0, 2), np.int64)

        for batch in batches:
            ids = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            fps = batch.column(4).to_numpy(zero_copy_only=False)
            change = np.any([i[1:] != i[:-1] for i in ids], axis=0)
            starts = np.concatenate([[0], np.flatnonzero(change) + 1, [len(fps)]])
            out = []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                now = tuple(i[a] for i in ids)
                if now != unit:
                    if held and len(held[0]) + len(held) > 2:
                        out.append(close())
                    held, unit = [], now
                held.append(fps[a:b])
            found = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])
        found = close()
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return keys.mapInArrow(run, "a long, b long")


def close_pairs(fps: DataFrame, distance: int = 4, blocks: int = 7, unit: int = UNIT) -> DataFrame:
    """Links (a, b) that connect exactly what pairs of distinct ``fp`` within
    ``distance`` bits connect; a spanning forest per key, never all pairs.

    Every key occurs ``C(blocks, distance)`` times; 7 blocks give 35 keys of
    27 bits, 8 give 70 of 32 bits for billions of fingerprints. A key with more
    than ``unit`` fingerprints is dealt into pieces, and pairs of pieces are
    compared in tasks of their own, so no key is bounded by one task and none is
    cut short.
    """
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - distance):
        bits = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        masks.append(bits - (1 << BITS) if bits >> (BITS - 1) else bits)
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("k"))
                       for t, m in enumerate(masks)])
    keys = fps.select("fp", F.inline(tables))
    shared = keys.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
    # Spark sizes the keys as if each fingerprint had one, and would broadcast them, or the shared ones
    rows = keys.join(shared.hint("merge"), ["t", "k"])
    pieces = F.ceil(F.col("n") / unit).cast("int")
    own = F.pmod(F.xxhash64(F.col("fp"), F.lit("piece")), pieces).cast("int")
    rows = rows.select("t", "k", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), pieces - 1)).alias("other"))
    units = rows.select("t", "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    units = units.repartition("t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j")
    return _links(units, distance).distinct()


def linked(fps: DataFrame, distance: int = 4, blocks: int = 7) -> DataFrame:
    """(fp, root) of every distinct fingerprint; root is one fingerprint of its group."""
    fps = fps.select("fp").distinct()
    roots = components(close_pairs(fps, distance, blocks)).withColumnRenamed("node", "fp")
    return fps.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_groups(docs: DataFrame, distance: int = 4, words: int = 4, blocks: int = 7,
                key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id, copies) of every row.

    component_id is the smallest key reachable over links of at most ``distance``
    differing bits, the row's own included; copies counts the rows of the same
    fingerprint. Equal fingerprints are one node from the start, so thousands of
    copies cost one. A null or empty text has fingerprint zero and links like any
    other. A row with a null key takes part and gets its group; a group of null
    keys only has a null id. Repeated rows are kept. An empty table gives no rows.
    """
    own = cut(fingerprints(docs, key, text, words))
    nodes = own.groupBy("fp").agg(F.min("key").alias("least"), F.count("*").alias("copies"))
    named = cut(nodes.join(linked(own, distance, blocks), "fp"))
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # a group may hold a third of all fingerprints
    named = split_join(named, groups, ["root"], by=["fp"]).select("fp", "copies", "component_id")
    return own.join(named, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "copies"
    )
