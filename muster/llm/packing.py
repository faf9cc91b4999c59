"""Packing by vector bin packing.

An example is a vector of demands: tokens, segments (one) and loss-bearing
tokens. A bin (sequence) has a capacity in each. Whole-length pieces fill bins
of their own; the remainders are packed by the dot-product heuristic: of the
items that fit, the open bin takes the one whose demands, weighted by how
scarce each resource is, point most towards what the bin has left. Where
nothing fits any more, the item is cut so that the bin closes full.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from muster.llm.tokens import Chunks, vocabulary

END_ID = 0


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence. ``window``: remainders a task holds to choose from."""

    tokens: int = 1024
    segments: int = 128
    loss: int = 1024
    window: int = 512


class Encoder:
    """Whole texts to ids as little-endian 32-bit integers."""

    def __init__(self, path: str):
        self._words = vocabulary(path)
        self._chunks = Chunks(path, self._ids)

    def _ids(self, pieces: list[str]) -> bytes:
        ids: list[int] = []
        for piece in pieces:
            token = self._words.whole.get(piece)
            ids.extend(self._words.merge(piece) if token is None else (token,))
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(
            np.array([self._words.special[part]], "<u4").tobytes() if i % 2 else b"".join(self._chunks.section(part))
            for i, part in enumerate(self._words.sections(text))
        )


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Packer:
    """Packs a stream of examples; memory holds ``limits.window`` remainders."""

    def __init__(self, limits: Limits, first_id: int = 0):
        self.limits, self._next = limits, first_id
        self._size = np.array([limits.tokens, limits.segments, limits.loss], float)
        self._items: list[list | None] = [None] * limits.window  # key, ids, start, prompt, tokens
        self._need = np.full((limits.window, 3), np.inf)  # demands of each slot; infinite: empty
        self._free = np.zeros(limits.window)  # tokens of the remainder that bear no loss
        self._empty = list(range(limits.window))
        self.rows: list[tuple] = []

    def _set(self, slot: int, item: list) -> None:
        """Enter what is left of an item, or empty its slot."""
        left = item[4] - item[2]
        if left:
            free = min(left, max(0, item[3] - item[2]))
            self._items[slot], self._free[slot] = item, free
            self._need[slot] = (left, 1, left - free)
        else:
            self._items[slot], self._need[slot] = None, np.inf
            self._empty.append(slot)

    def _put(self, item: list, length: int, sequence: int, offset: int) -> None:
        key, ids, start, _, total = item
        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
        self.rows.append((key, start, length, crc, total, sequence, offset))
        item[2] += length

    def add(self, key, ids: bytes, prompt: int = 1) -> None:
        item, whole = [key, memoryview(ids), 0, prompt, len(ids) // 4], self.limits.tokens
        while item[4] - item[2] >= whole and whole - max(0, prompt - item[2]) <= self.limits.loss:
            self._put(item, whole, self._next, 0)
            self._next += 1
        if item[2] < item[4]:
            while not self._empty:
                self._fill()
            self._set(self._empty.pop(), item)

    def close(self) -> None:
        while len(self._empty) < self.limits.window:
            self._fill()

    def _fill(self) -> None:
        """One bin from the remainders at hand."""
        need, left, offset = self._need, self._size.copy(), 0
        scarce = np.where(np.isinf(need), 0, need).sum(0)  # weight of a resource: the demand for it
        while left[0] > 0 and left[1] > 0:
            fits = (need <= left).all(1)
            if left[1] > 1 and fits.any():
                worth = np.where(fits[:, None], need, -1.0) @ (scarce * left / self._size**3)
                slot = int(worth.argmax())
                length = int(need[slot, 0])
            else:  # last segment, or nothing fits whole: cut the item that fills most
                room = np.minimum(np.where(np.isinf(need[:, 0]), 0, need[:, 0]), min(left[0], self.limits.tokens))
                room = np.minimum(room, self._free + left[2])
                slot = int(room.argmax())
                length = int(room[slot])
                if not length or self._items[slot] is None:
                    break
            item = self._items[slot]
            left -= (length, 1, length - min(length, self._free[slot]))
            self._put(item, length, self._next, offset)
            self._set(slot, item)
            offset += length
        self._next += 1


def pack(docs: DataFrame, path: str, limits: Limits = Limits(), key: str = "doc_id", text: str = "text",
         prompt: str | None = None) -> DataFrame:
    """Pieces (key, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Each row's ids, then ``END_ID``, lie in exactly one piece each. ``prompt``
    names a column with the count of leading ids that bear no loss, for
    instruction data; else only the first id, which nothing predicts, bears none.

    One narrow pass: a task packs its own rows, so nothing is shuffled and a lost
    task is simply run again. Padding is left in the last bin of a task and where
    the segment or loss limit closes a bin. A null text gives ``END_ID`` alone; a
    null key stays null; repeated rows are packed each; an empty table gives no
    rows; other columns are left out.
    """
    if min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError("every limit must be at least 1")
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        end = np.array([END_ID], "<u4").tobytes()
        packer = Packer(limits, TaskContext.get().partitionId() << 40)

        def done() -> pa.RecordBatch:
            columns = list(zip(*packer.rows)) or [[]] * len(types)
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)

        for batch in batches:
            for row, whole, free in zip(*(batch.column(i).to_pylist() for i in range(3))):
                packer.add(row, encode(whole) + end, free)
                if len(packer.rows) > 20_000:
                    yield done()
        packer.close()
        yield done()

    types = to_arrow_schema(_parse_datatype_string(schema))
    free = F.coalesce(F.col(prompt).cast("long"), F.lit(1)) if prompt else F.lit(1).cast("long")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), free.alias("prompt"))
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
