"""Byte-level BPE by recursive queries over token positions.

A task lists the distinct words of its texts as rows (word, position, token), one
per byte. A recursive query joins neighbouring tokens with the merge table and
contracts each word's leftmost pair of least rank until no pair of the word is in
the table. Texts are then id sequences, and an ordered aggregation over
(text, position, id) joined with the vocabulary gives the bytes back.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from itertools import islice

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import map_batches

MEMO = 224 << 20  # bytes of words a worker remembers before it starts again
ROWS = 1 << 20  # token positions of one recursive query
WORDS = 600_000  # words of the texts worked on together
BLOCK, STRIDE = 128, 64  # bytes of a block of a longer word, and from one block to the next
PLACE = 20  # bits of a position

# One round over rows that know the token after theirs: each pair by the merge table, and as
# best of the word the least number of rank, position and position after.
_PAIRS = f"""
    SELECT * FROM (
        WITH pairs AS MATERIALIZED (
            SELECT t.*, (m.rank::BIGINT << {2 * PLACE}) | (t.pos::BIGINT << {PLACE}) | t.after AS found
            FROM ({{rows}}) t LEFT JOIN merges m ON m.first = t.token AND m.second = t.following),
        least AS (SELECT word, min(found) AS best FROM pairs GROUP BY word)
        SELECT word, pos, token, after, following, best FROM pairs JOIN least USING (word))
"""
# The pair at ``best`` becomes one token: its second row goes, and the rows beside learn of it.
_HEAD, _MERGED, _GONE = (f"((s.best >> {PLACE}) & {(1 << PLACE) - 1})", f"(s.best >> {2 * PLACE})::INTEGER",
                         f"(s.best & {(1 << PLACE) - 1})")
_CONTRACTED = f"""
    SELECT s.word, s.pos,
           CASE WHEN s.pos = {_HEAD} THEN {_MERGED} ELSE s.token END AS token,
           CASE WHEN s.pos = {_HEAD} THEN gone.after ELSE s.after END AS after,
           CASE WHEN s.pos = {_HEAD} THEN gone.following WHEN s.after = {_HEAD} THEN {_MERGED} ELSE s.following END AS following
    FROM step s JOIN step gone ON gone.word = s.word AND gone.pos = {_GONE.replace("s.best", "gone.best")}
    WHERE s.best IS NOT NULL AND s.pos <> {_GONE}
"""
ENCODE = f"""
    WITH RECURSIVE step(word, pos, token, after, following, best) AS (
        {_PAIRS.format(rows="SELECT word, pos, token, after, following FROM pieces")}
        UNION ALL
        {_PAIRS.format(rows=_CONTRACTED)})
    SELECT word, list(token ORDER BY pos) AS tokens FROM step WHERE best IS NULL GROUP BY word ORDER BY word
"""
DECODE = """
    SELECT text, list(v.bytes ORDER BY pos) AS parts
    FROM ids JOIN vocabulary v USING (id) GROUP BY text ORDER BY text
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a line holds a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Bpe:
    """Encodes words and decodes ids over one vocabulary; it holds a database of two
    tables, merges and vocabulary, whose size is that of the vocabulary."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        # Any two tokens may merge whose bytes together are a token.
        splits = [(ranks[t[:i]], ranks[t[i:]], rank) for t, rank in ranks.items() for i in range(1, len(t))
                  if t[:i] in ranks and t[i:] in ranks]
        merges = np.array(splits, np.int32).reshape(-1, 3)
        self._single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self._base = duckdb.connect(config={"threads": 1, "memory_limit": "350MB", "temp_directory": ""})
        self._with(loaded=pa.table({"first": merges[:, 0], "second": merges[:, 1], "rank": merges[:, 2]}))
        self._base.execute("CREATE TABLE merges AS SELECT * FROM loaded")
        self._with(loaded=pa.table({"id": pa.array(list(ranks.values()), pa.int32()),
                                    "bytes": pa.array(list(ranks), pa.binary())}))
        self._base.execute("CREATE TABLE vocabulary AS SELECT * FROM loaded")
        self._tokens = {rank: token for token, rank in ranks.items()}
        self._memo: dict[str, bytes] = {}
        self._held = 0

    def _with(self, **tables: pa.Table) -> duckdb.DuckDBPyConnection:
        for name, table in tables.items():
            self._base.register(name, table)
        return self._base

    def _contract(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of words of at most ROWS bytes each, as little-endian unsigned 32-bit numbers;
        a query for about ROWS bytes."""
        first = 0
        while first < len(words):
            last, size = first, 0
            while last < len(words) and (last == first or size + len(words[last]) <= ROWS):
                size += len(words[last])
                last += 1
            part, first = words[first:last], last
            lengths = np.fromiter(map(len, part), np.int64, len(part))
            flat = np.frombuffer(b"".join(part), np.uint8)
            ends = np.cumsum(lengths)
            place = np.arange(len(flat)) - np.repeat(ends - lengths, lengths)
            ids = self._single[flat]
            last_byte = np.zeros(len(flat), bool)
            last_byte[ends - 1] = True
            pieces = pa.table({
                "word": np.repeat(np.arange(len(part), dtype=np.int32), lengths),
                "pos": place.astype(np.int32),
                "token": ids,
                "after": pa.array((place + 1).astype(np.int32), mask=last_byte),
                "following": pa.array(np.roll(ids, -1), mask=last_byte),
            })
            column = self._with(pieces=pieces).sql(ENCODE).to_arrow_table()["tokens"].combine_chunks()
            edges = (column.offsets.to_numpy() * 4).tolist()
            found = column.values.to_numpy().astype("<u4").tobytes()
            for a, b in zip(edges, edges[1:]):
                yield found[a:b]

    def _ids(self, words: list[bytes]) -> dict[bytes, np.ndarray]:
        distinct = list(dict.fromkeys(words))
        return {word: np.frombuffer(ids, "<u4") for word, ids in zip(distinct, self._contract(distinct))}

    def _apart(self, pairs: list[tuple[int, int]]) -> set[tuple[int, int]]:
        """The pairs of tokens that stay two tokens when their bytes are encoded."""
        pairs = list(dict.fromkeys(pairs))
        found = self._ids([self._tokens[a] + self._tokens[b] for a, b in pairs])
        return {(a, b) for a, b in pairs if found[self._tokens[a] + self._tokens[b]].tolist() == [a, b]}

    def _ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum([len(self._tokens[i]) for i in ids.tolist()])

    def _long(self, word: bytes) -> np.ndarray:
        """Ids of a word of any length, from blocks that overlap.

        Tokens of which each two neighbours, encoded alone, stay these two tokens
        are the encoding of their bytes: the first merge across one of their
        borders would be the least pair of those two alone as well. Neighbours
        from one block are such; where two blocks share a border, the pair that
        meets there is tested. Where no shared border will do, ``_walk`` goes on.
        """
        starts = list(range(0, max(len(word) - BLOCK, 0) + STRIDE, STRIDE))
        blocks = [word[s:s + BLOCK] for s in starts]
        found = self._ids(blocks)
        ends = {block: self._ends(ids) for block, ids in found.items()}
        open_to = []  # per join of two blocks its shared borders, the one nearest the middle first
        for s, left, right in zip(starts[1:], blocks, blocks[1:]):
            shared = np.intersect1d(ends[left] - STRIDE, ends[right])
            shared = shared[(shared > 0) & (shared < STRIDE)]
            nearest = shared[np.argsort(np.abs(shared - STRIDE // 2), kind="stable")].tolist()
            open_to.append([(s + p, (int(found[left][np.searchsorted(ends[left], p + STRIDE)]),
                                     int(found[right][np.searchsorted(ends[right], p, "right")]))) for p in nearest])
        joins: list[int | None] = [None] * len(open_to)
        todo = list(range(len(open_to)))
        while todo:
            todo = [k for k in todo if open_to[k]]
            apart = self._apart([open_to[k][0][1] for k in todo]) if todo else set()
            for k in todo:
                place, pair = open_to[k].pop(0)
                joins[k] = place if pair in apart else None
            todo = [k for k in todo if joins[k] is None]
        if None in joins:
            return self._walk(word)
        out = []
        for s, block, a, b in zip(starts, blocks, [0, *joins], [*joins, len(word)]):
            low, high = np.searchsorted(ends[block], [a - s, b - s], "right")
            out.append(found[block][low:high])
        return np.concatenate(out)

    def _walk(self, word: bytes) -> np.ndarray:
        """Ids of a word, block after block, each begun where the last trusted token
        ends; a block that does not fit there is begun earlier and made longer. For
        words of a short period, whose blocks come again."""
        memo: dict[bytes, list[int]] = {}
        apart: dict[tuple[int, int], bool] = {}
        out: list[int] = []
        place, size = 0, BLOCK
        while place < len(word):
            block = word[place:place + size]
            if block not in memo:
                memo[block] = self._ids([block])[block].tolist()
            ids = memo[block]
            if out:
                pair = (out[-1], ids[0])
                if pair not in apart:
                    apart[pair] = bool(self._apart([pair]))
                if not apart[pair]:
                    for token in out[-max(1, size // BLOCK):]:
                        place -= len(self._tokens[token])
                    del out[-max(1, size // BLOCK):]
                    size *= 2
                    continue
            if place + size < len(word):
                ids = ids[:max(1, len(ids) // 2)]
            out += ids
            place += sum(len(self._tokens[i]) for i in ids)
            size = BLOCK
        return np.array(out, "<u4")

    def learn(self, words: set[str]) -> None:
        """Make ``words`` known: their ids as little-endian unsigned 32-bit numbers."""
        if self._held > MEMO:
            self._memo.clear()
            self._held = 0
        new = [w for w in words if w not in self._memo]
        coded = [w.encode() for w in new]
        short = [i for i, w in enumerate(coded) if len(w) <= BLOCK]
        for i, ids in zip(short, self._contract([coded[i] for i in short])):
            self._memo[new[i]] = ids
        for i, word in enumerate(coded):
            if len(word) > BLOCK:
                self._memo[new[i]] = self._long(word).tobytes()
        self._held += sum(200 + len(w) + len(self._memo[w]) for w in new)

    def encode(self, words: list[str]) -> bytes:
        """Ids of known words in turn."""
        return b"".join(map(self._memo.__getitem__, words))

    def decode(self, ids: list[bytes]) -> list[memoryview]:
        """The bytes of each id sequence, by an ordered aggregation."""
        lengths = np.fromiter((len(part) // 4 for part in ids), np.int64, len(ids))
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        rows = pa.table({"text": np.repeat(np.arange(len(ids), dtype=np.int32), lengths),
                         "pos": np.arange(len(flat), dtype=np.int64), "id": flat})
        got = self._with(ids=rows).sql(DECODE).to_arrow_table()
        # The parts of a list lie one behind the other, so a text is a stretch of their bytes.
        column = got["parts"].combine_chunks()
        parts = column.values
        edges = parts.cast(pa.large_binary()).buffers()[1]
        places = np.frombuffer(edges, np.int64, len(parts) + 1, parts.offset * 8)[column.offsets.to_numpy()]
        stored = memoryview(parts.buffers()[2]) if len(parts) else memoryview(b"")
        out = [memoryview(b"")] * len(ids)
        for text, a, b in zip(got["text"].to_pylist(), places, places[1:]):
            out[text] = stored[a:b]
        return out


@functools.cache
def bpe(path: str) -> Bpe:
    """Loaded once per worker."""
    return Bpe(path)


@functools.cache
def pattern() -> regex.Pattern:
    return regex.compile(public_tokenizers.PATTERN)


def _portions(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(place of the text, some of its words in turn), at most WORDS at once."""
    for place, text in enumerate(texts):
        if len(text) <= WORDS:
            yield place, pattern().findall(text)
        else:
            words = (m.group() for m in pattern().finditer(text))
            while part := list(islice(words, WORDS)):
                yield place, part


class _Digests:
    """Token counts and digests of texts, worked on in portions."""

    def __init__(self, path: str, texts: list[str]):
        self._bpe = bpe(path)
        self.counts = [0] * len(texts)
        self.ids = [hashlib.sha256() for _ in texts]
        self.decoded = [hashlib.sha256() for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0
        for portion in _portions(texts):
            held.append(portion)
            size += len(portion[1])
            if size >= WORDS:
                self._flush(held)
                held, size = [], 0
        self._flush(held)

    def _flush(self, held: list[tuple[int, list[str]]]) -> None:
        self._bpe.learn({word for _, words in held for word in words})
        coded = [self._bpe.encode(words) for _, words in held]
        for (place, _), ids, back in zip(held, coded, self._bpe.decode(coded)):
            self.counts[place] += len(ids) // 4
            self.ids[place].update(ids)
            self.decoded[place].update(back)


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded) of every row: the token ids, and the bytes decoded from them.

    A null text is an empty one: no ids, no bytes. A null key stays null, repeated
    rows come out each, an empty table gives no rows, other columns are left out.
    One narrow pass.
    """

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            texts, coder = batch.column(1).to_pylist(), bpe(path)
            ids = [bytearray() for _ in texts]
            for place, words in _portions(texts):
                coder.learn(set(words))
                ids[place] += coder.encode(words)
            return {"key": batch.column(0), "ids": [np.frombuffer(i, "<u4").astype(np.int32) for i in ids],
                    "decoded": [bytes(b) for b in coder.decode([bytes(i) for i in ids])]}
        return work

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    found = map_batches(rows, f"key {kind}, ids array<int>, decoded binary", make)
    return found.select(F.col("key").alias(key), "ids", "decoded")


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row, without a text's ids ever
    being held as a whole. Odd rows as in ``encode_texts``; no digest is null."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            found = _Digests(path, batch.column(1).to_pylist())
            return {"key": batch.column(0), "n_tokens": found.counts,
                    "ids_sha256": [h.hexdigest() for h in found.ids],
                    "decoded_sha256": [h.hexdigest() for h in found.decoded]}
        return work

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    found = map_batches(rows, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
    return found.select(F.col("key").alias(key), "n_tokens", "ids_sha256", "decoded_sha256")
