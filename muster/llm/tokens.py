"""Token counts by a whole-token shortcut.

Offline, every vocabulary string is put through the merge rules alone; the
strings that come out as one token are known to count as one wherever they are
a whole pre-token. At run time such pre-tokens are counted by a lookup and only
the rest is merged. The counts equal those of the library that owns the
vocabulary, special strings inside texts included.
"""

from __future__ import annotations

import functools
import json
import re
import sys

import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from muster.llm.common import map_batches

MEMO = 1_000_000  # entries a worker remembers before it starts again
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _ranges(kind: str) -> str:
    """The code points of a Unicode class as ranges of a character set."""
    everything = "".join(map(chr, (c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)))
    return "".join(
        f"\\U{ord(run[0]):08x}-\\U{ord(run[-1]):08x}" for run in regex.findall(rf"\p{{{kind}}}+", everything)
    )


@functools.cache
def splitter() -> re.Pattern:
    """The byte-level pre-token rule, with its Unicode classes written out so
    that the faster standard matcher can run it."""
    letter, number = _ranges("L"), _ranges("N")
    return re.compile(
        f"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^{WHITE}{letter}{number}]+"
        f"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
    )


WHITE_SPACE = frozenset(c for c in map(chr, range(0x3001)) if re.fullmatch(f"[{WHITE}]", c))


def _byte_letters() -> dict[str, int]:
    """The letter a byte-level vocabulary writes for each byte: printable bytes
    stand for themselves, the others follow from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A byte-level vocabulary file, its proven whole tokens and its merge step.

    ``whole`` maps each string that encodes alone as one token to its id. The
    merge step runs in the library's core by rank; that is the file's own merge
    order, which ``__init__`` proves: every string of the vocabulary must come
    out of the file's rules whole, and ids must rise in merge order.
    """

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in k): i for k, i in spec["model"]["vocab"].items() if k not in self.special}
        merged = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        order = [spec["model"]["vocab"][m.replace(" ", "")] for m in merged]
        alone = {k: i for k, i in spec["model"]["vocab"].items()
                 if k not in self.special and [t.id for t in tokenizer.model.tokenize(k)] == [i]}
        if order != sorted(order) or len(alone) != len(ranks):
            raise ValueError(f"{path}: ids do not follow the merge order, so ranks cannot stand for merges")
        self.whole = {}
        for key, token in alone.items():
            try:
                self.whole[bytes(letters[c] for c in key).decode()] = token
            except UnicodeDecodeError:
                pass  # part of a character: never a whole pre-token
        self._core = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self._cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def merge(self, piece: str) -> list[int]:
        """Ids of a pre-token that is not whole."""
        return self._core.encode_single_piece(piece.encode())

    def sections(self, text: str) -> list[str]:
        """Ordinary text and special strings in turn; odd places hold the latter."""
        return self._cut.split(text) if self._cut else [text]


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """Loaded and proven once per worker."""
    return Vocabulary(path)


class _OddSpace(Exception):
    """A text may not be cut at every space."""


class Chunks(dict):
    """What has been worked out per chunk, a text's part between two spaces.

    A space between two visible characters always starts a pre-token, so there a
    text may be cut; where white space meets white space the text goes whole.
    ``make`` turns the pre-tokens of a chunk into what is remembered.
    """

    def __init__(self, path: str, make):
        self._words, self._find, self._make = vocabulary(path), splitter().findall, make

    def __missing__(self, chunk: str):
        if not chunk or chunk[0] in WHITE_SPACE or chunk[-1] in WHITE_SPACE:
            raise _OddSpace
        if len(self) > MEMO:
            self.clear()
        self[chunk] = found = self._make(self._find(" " + chunk))
        return found

    def section(self, text: str) -> list:
        first, *rest = text.split(" ")
        try:
            if rest and first and first[-1] in WHITE_SPACE:
                raise _OddSpace
            return [self._make(self._find(first)), *map(self.__getitem__, rest)]
        except _OddSpace:
            return [self._make(self._find(text))]


class Counter:
    """Counts tokens of texts: whole tokens count one each, the rest is merged."""

    def __init__(self, path: str):
        self._words = vocabulary(path)
        self._chunks = Chunks(path, self._count)

    def _count(self, pieces: list[str]) -> int:
        whole, merge = self._words.whole, self._words.merge
        return sum(1 if p in whole else len(merge(p)) for p in pieces)

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(i % 2 or sum(self._chunks.section(part)) for i, part in enumerate(self._words.sections(text)))


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row.

    A null text is an empty one: no bytes, no tokens. A null key stays null,
    repeated rows are counted each, an empty table gives no rows, other columns
    are left out whatever their names. One narrow pass, no shuffle.
    """
    kind = docs.schema[key].dataType.simpleString()

    def make():
        count = counter(path)
        return lambda batch: {
            "key": batch.column(0),
            "n_bytes": batch.column(2),
            "n_tokens": [count(t) for t in batch.column(1).to_pylist()],
        }

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), whole.alias("text"),
                       F.octet_length(whole).cast("long").alias("n_bytes"))
    counted = map_batches(rows, f"key {kind}, n_bytes long, n_tokens long", make)
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
