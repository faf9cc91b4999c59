"""Periodic runs of words, by longest common extensions over a difference cover.

A run is a stretch of words that repeats with some period and that no neighbour
extends. For each period a grid of places is laid so that every run long enough has
a grid place in it, from which the run is the common extension, forwards and
backwards, of that place and the place one period on. The grids of all periods of n
words have about n log n places.

A common extension compares at most ``COVER`` words until both places are sampled
ones; from there suffixes sorted at sampled places only, their common prefixes and a
table of range minima answer at once.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import map_batches

COVER = 31
SAMPLED = (1, 5, 11, 24, 25, 27)  # any two residues differ by the difference of two of these, modulo COVER
LEAST, TIMES = 24, 3  # a run has LEAST words and TIMES periods at least
SLICE = 200_000  # words of the texts worked on together
PLACES = 1 << 20  # grid places looked at together
PERIODS = 1 << 18  # periods of a text whose grids are laid together


@functools.cache
def _steps() -> np.ndarray:
    """By residue of a place and of the distance to the other one: words to go until both are sampled."""
    steps = np.empty((COVER, COVER), np.int64)
    for place in range(COVER):
        for distance in range(COVER):
            steps[place, distance] = next(h for h in range(COVER) if (place + h) % COVER in SAMPLED
                                          and (place + h + distance) % COVER in SAMPLED)
    return steps


class Extensions:
    """Common extensions to the right of places of ``words``. The last COVER numbers must
    occur nowhere else; no extension goes past a number that occurs once."""

    def __init__(self, words: np.ndarray):
        self._words = words

    @functools.cached_property
    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the suffix at each sampled place, and range minima of common prefixes, in blocks of COVER words."""
        words = self._words
        last = len(words) - COVER
        chains = [np.arange(r, last + 1, COVER) for r in SAMPLED]
        places = np.concatenate(chains)
        name = self._names(places)
        levels = [name]  # names of 1, 2, 4, .. blocks from each place on
        size = len(places)
        while levels[-1].max(initial=0) + 1 < size:
            name, step = levels[-1], 1 << (len(levels) - 1)
            after = np.zeros(size, np.int64)
            after[:-step] = name[step:] + 1
            levels.append(np.unique(name * (size + 1) + after, return_inverse=True)[1])
        rank = levels[-1]
        order = np.empty(size, np.int64)
        order[rank] = np.arange(size)
        left, right = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(left), np.int32)
        for level in range(len(levels) - 1, -1, -1):
            # a stretch that holds a number that occurs once is like no other, so none runs over an end
            inside = np.maximum(left, right) < size
            same = inside.copy()
            same[inside] = levels[level][left[inside]] == levels[level][right[inside]]
            common[same] += 1 << level
            left[same] += 1 << level
            right[same] += 1 << level
        minima = [common]
        while 2 << (len(minima) - 1) <= len(common):
            half = 1 << (len(minima) - 1)
            wider = minima[-1].copy()
            wider[:-half] = np.minimum(minima[-1][:-half], minima[-1][half:])
            minima.append(wider)
        by_place = np.full(len(words), -1, np.int64)
        by_place[places] = rank
        return by_place, np.stack(minima)

    def _names(self, places: np.ndarray) -> np.ndarray:
        """Numbers of the COVER words from each place on, equal for equal words only."""
        words = self._words
        mixed = np.zeros(len(places), np.uint64)
        for t in range(COVER):
            mixed = (mixed ^ words[places + t].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        _, first, name = np.unique(mixed, return_index=True, return_inverse=True)
        alike = places[first][name]
        if all((words[places + t] == words[alike + t]).all() for t in range(COVER)):
            return name
        windows = np.lib.stride_tricks.sliding_window_view(words, COVER)[places]
        return np.unique(windows, axis=0, return_inverse=True)[1].reshape(-1)

    def _compare(self, left: np.ndarray, right: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from left and right on, at most ``most``."""
        words, found = self._words, np.zeros(len(left), np.int64)
        open_to = np.flatnonzero(most > 0)
        while len(open_to):
            at = found[open_to]
            open_to = open_to[words[left[open_to] + at] == words[right[open_to] + at]]
            found[open_to] += 1
            open_to = open_to[found[open_to] < most[open_to]]
        return found

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair of different places."""
        steps = _steps()[left % COVER, (right - left) % COVER]
        found = self._compare(left, right, steps)
        synced = np.flatnonzero(found == steps)
        if len(synced):
            by_place, minima = self._sorted
            a, b = by_place[left[synced] + steps[synced]], by_place[right[synced] + steps[synced]]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            blocks = np.minimum(minima[level, low], minima[level, high - (1 << level)]).astype(np.int64)
            at = steps[synced] + blocks * COVER
            rest = np.full(len(synced), COVER, np.int64)
            found[synced] = at + self._compare(left[synced] + at, right[synced] + at, rest)
        return found


def _grid(starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid places of all periods of the texts, as (place, period). A run of period p has
    max(LEAST - p, (TIMES - 1) * p) places at least whose word one period on is in the run as well."""
    for low in range(1, int(lengths.max(initial=0)) // TIMES + 1, PERIODS):
        periods = np.clip(np.where(lengths >= LEAST, lengths // TIMES, 0) - low + 1, 0, PERIODS)
        text = np.repeat(np.arange(len(lengths)), periods)
        if not len(text):
            continue
        period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + low
        step = np.maximum(LEAST - period, (TIMES - 1) * period)
        places = -(-(lengths[text] - period) // step)
        upto = np.cumsum(places)
        first = 0
        while first < len(text):
            done = upto[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(upto, done + PLACES, "right")))
            n = places[first:last]
            row = np.repeat(np.arange(first, last), n)
            turn = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            yield starts[text[row]] + turn * step[row], period[row]
            first = last


def _least_period(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each stretch once, with its smallest period, by start, then period."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def find(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of texts given as numbered words, one text after the other: start, length and
    period by start, then period, starts counted over all texts."""
    # a number of its own before, between and after the texts
    ends = np.cumsum(lengths)
    texts = len(lengths)
    top = int(words.max(initial=0)) + 1
    # COVER numbers in front, one after each text, COVER more at the end
    shifts = np.repeat(np.arange(texts), lengths)
    spread = np.arange(top, top + len(words) + texts + 2 * COVER, dtype=np.int64)
    places = COVER + np.arange(len(words)) + shifts
    spread[places] = words
    starts = COVER + ends - lengths + np.arange(texts)
    right, left = Extensions(spread), Extensions(spread[::-1].copy())
    last = len(spread) - 1
    found = [np.empty((3, 0), np.int64)]
    for place, period in _grid(starts, lengths):
        same = spread[place] == spread[place + period]
        place, period = place[same], period[same]
        end = place + period + right(place, place + period)
        # mirrored, the place one period on comes first
        start = place - left(last - (place + period - 1), last - (place - 1))
        long = end - start >= np.maximum(LEAST, TIMES * period)
        found.append(np.stack(_least_period(start[long], end[long], period[long])))
    start, end, period = _least_period(*np.concatenate(found, axis=1))
    text = np.searchsorted(starts, start, "right") - 1
    return start - COVER - text, end - start, period


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about SLICE words together."""
    first, held = 0, 0
    for place, size in enumerate(sizes):
        if held and held + size > SLICE:
            yield first, place
            first, held = place, 0
        held += size
    if sizes:
        yield first, len(sizes)


def _collapse(texts: list[bytes]) -> tuple[list[int], list[np.ndarray], list[int | None], list[str]]:
    """Per text: words, its runs as rows (start, length, period), the strongest run's place, the text kept."""
    split = [text.split() for text in texts]  # at the six white-space bytes of ASCII, as WORD has it
    sizes = [len(words) for words in split]
    runs, strongest, kept = [], [], []
    for a, b in _slices(sizes):
        number = defaultdict(count().__next__)
        lengths = np.array(sizes[a:b], np.int64)
        total = int(lengths.sum())
        words = np.fromiter((number[w] for words in split[a:b] for w in words), np.int64, total)
        start, length, period = find(words, lengths)
        starts = np.cumsum(lengths) - lengths
        # words of a run after its first period
        depth = np.zeros(total + 1, np.int64)
        np.add.at(depth, start + period, 1)
        np.add.at(depth, start + length, -1)
        keep = np.cumsum(depth[:-1]) == 0
        edges = np.searchsorted(start, [*starts, total])
        # texts without a word share a start with the next one and have no runs
        edges[:-1][lengths == 0] = edges[1:][lengths == 0]
        for text, first, low, high in zip(split[a:b], starts.tolist(), edges, edges[1:]):
            rows = np.stack([start[low:high] - first, length[low:high], period[low:high]], axis=1)
            runs.append(rows)
            if len(rows):
                # as exact as fractions up to 10^7 words: two of them differ by more than a rounding
                strongest.append(int(np.argmax(rows[:, 1] / rows[:, 2])))
                text = [w for w, k in zip(text, keep[first:first + len(text)].tolist()) if k]
            else:
                strongest.append(None)
            kept.append(b" ".join(text).decode())
    return sizes, runs, strongest, kept


def collapse(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, runs, strongest, collapsed) of every row.

    ``runs`` holds (start, length, period) of every run of at least LEAST words and TIMES
    periods, by start, then period, words counted from 0; ``strongest`` is the place in it
    of the run of most periods, ties to the smallest start, then period, and null without
    a run. ``collapsed`` is the text's words, joined by one space, without those that a run
    repeats after its first period.

    A null text is an empty one: no words, no runs, an empty collapsed text. A null key
    stays null, repeated rows come out each, an empty table gives no rows, other columns
    are left out. One narrow pass; a text must fit into a worker several times over.
    """

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            sizes, runs, strongest, kept = _collapse(batch.column(1).cast(pa.binary()).to_pylist())
            flat = np.concatenate([np.empty((0, 3), np.int64), *runs])
            columns = [pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)]
            edges = np.cumsum([0, *map(len, runs)]).astype(np.int32)
            rows = pa.StructArray.from_arrays(columns, names=["start", "length", "period"])
            return {"key": batch.column(0), "n_words": sizes, "runs": pa.ListArray.from_arrays(pa.array(edges), rows),
                    "strongest": strongest, "collapsed": kept}
        return work

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = (f"key {kind}, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
              "strongest int, collapsed string")
    found = map_batches(rows, schema, make)
    return found.select(F.col("key").alias(key), "n_words", "runs", "strongest", "collapsed")


def with_periods(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text): every row's words joined by a space, those of about a tenth of the ids
    made periodic from some word on, by the id's checksum. A null id changes nothing."""
    from zlib import crc32

    def change(number, content: bytes) -> bytes:
        words = content.split()
        check = crc32(str(number).encode())
        if number is not None and check % 10 == 0 and words:
            g, n = check // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]
        return b" ".join(words)

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            return {"key": batch.column(0),
                    "text": [change(k, t).decode() for k, t in zip(batch.column(0).to_pylist(), texts)]}
        return work

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    changed = map_batches(rows, f"key {kind}, text string", make)
    return changed.select(F.col("key").alias(key), F.col("text").alias(text))


def digests(collapsed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and digests of the rows of ``collapse``: the strongest run, and checksums of all runs and of the text."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.get("runs", F.col("strongest"))
    return collapsed.select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(F.expr("(1000 * runs[strongest].length) div runs[strongest].period")).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
