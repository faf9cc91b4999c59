"""Long repeats across documents by an enhanced suffix array.

Suffixes that share their first bytes must meet in one place, so each is filed
under an anchor: of every window of ``MIN`` bytes, the run of ``GRAM`` bytes with
the least hash. Equal windows have equal anchors. Anchors that only one document
has are dropped before any text moves. What is left are short contexts around
the anchors two or more documents share; those of one anchor form the text of a
suffix array with its common-prefix lengths. A stack scan walks the tree of
common-prefix intervals; an interval of ``MIN`` bytes or more whose occurrences
differ in the byte before is a maximal repeat, and all its occurrences are known
at once, so the one in the smallest document stands and the others go.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import cut, map_batches, release

MIN = 50
GRAM = 16
REACH = MIN - GRAM  # bytes a window can begin before its anchor
SLAB = 1 << 17  # window starts worked on at once
CHUNK = 15_000  # contexts whose suffixes are sorted at once
HOT = 200_000  # contexts of one anchor from which on windows are met one by one
AGAIN = 1 << 14  # places of a run in one row


FACTOR = 0x9E3779B97F4A7C15
WIDTH = REACH + MIN  # bytes of a context, from REACH before its anchor on


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _scan(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, hash of the context) of the anchors in the joined pieces; windows
    keep to one piece, contexts may not and are then for the caller to hash."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    h, step, factor, steps = data.astype(np.uint64) + np.uint64(1), 1, FACTOR, {}
    while step < GRAM:
        h = h[:-step] * np.uint64(factor) + h[step:]
        factor, step = factor * factor % (1 << 64), step * 2
        steps[step] = h
    h = _mixed(h) | np.uint64(1)
    least, span = h, 1
    while span * 2 <= REACH + 1:
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    rest = REACH + 1 - span
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    ends = np.cumsum([len(p) for p in pieces])
    for end in ends[:-1].tolist():  # windows over a seam
        least[max(0, end - MIN + 1) : end] = 0
    most = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)])
    span = 1
    while span * 2 <= REACH + 1:
        most, span = np.maximum(most[:-span], most[span:]), span * 2
    if rest:
        most = np.maximum(most[:-rest], most[rest:])
    at = np.flatnonzero(h == most[: len(h)])
    start = np.clip(at - REACH, 0, max(0, len(data) - WIDTH))
    context = np.zeros(len(at), np.uint64)
    if len(data) >= WIDTH:
        for gone in range(0, WIDTH - GRAM + 1, GRAM):
            context = context * np.uint64(pow(FACTOR, GRAM, 1 << 64)) + steps[GRAM][start + gone]
        context = context * np.uint64(pow(FACTOR, WIDTH % GRAM, 1 << 64)) + steps[WIDTH % GRAM][start + WIDTH - WIDTH % GRAM]
    return at, h[at], _mixed(context)


def _context_hash(text: bytes, at: int) -> int:
    """What ``_scan`` says of a whole context; a context cut by an end of its text has its own."""
    part = text[max(0, at - REACH) : at + MIN]
    if len(part) < WIDTH:
        return xxhash.xxh3_64_intdigest(part, seed=1 + min(at, REACH))
    total = 0
    for byte in part:
        total = (total * FACTOR + byte + 1) % (1 << 64)
    return int(_mixed(np.array([total], np.uint64))[0])


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, hash, hash of the context) of the anchors of each text, each once."""
    out, pieces, owner, offset, total = [], [], [], [], 0

    def flush():
        at, h, c = _scan(pieces)
        sizes = np.array([len(p) for p in pieces])
        starts = np.cumsum(sizes) - sizes
        piece = np.searchsorted(starts, at, "right") - 1
        inside = at - starts[piece]
        who, place = np.array(owner)[piece], inside + np.array(offset)[piece]
        for i in np.flatnonzero((inside < REACH) | (inside + MIN > sizes[piece])).tolist():
            c[i] = _context_hash(texts[who[i]], int(place[i]))
        out.append((who, place, h, c))

    # pieces keep the order of texts, so anchors come out by text and place
    for i, text in enumerate(texts):
        for a in range(0, max(0, len(text) - MIN + 1), SLAB):
            pieces.append(text[a : a + SLAB + MIN - 1])
            owner.append(i)
            offset.append(a)
            total += len(pieces[-1])
            if total >= SLAB:
                flush()
                pieces, owner, offset, total = [], [], [], 0
    if pieces:
        flush()
    if not out:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    who, at, h, c = (np.concatenate(x) for x in zip(*out))
    if any(len(t) > SLAB for t in texts):  # the seams of a long text are scanned twice
        _, first = np.unique(np.stack([who, at]), axis=1, return_index=True)
        who, at, h, c = who[first], at[first], h[first], c[first]
    return who, at, h, c


def _packed(who: np.ndarray, at: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) per run of anchors: the number holds the place, how often it comes again
    and after how many bytes, and how far before it the windows begin that may have this
    anchor: those which do not reach a neighbouring anchor of a smaller hash.

    A text of a short period has anchors of one hash and one context at equal steps; they
    are one row, as what is found for one holds for all."""
    most, least = np.full(len(at), REACH), np.zeros(len(at), np.int64)
    gap, one = at[1:] - at[:-1], who[1:] == who[:-1]
    near = one & (gap <= REACH)
    back = near & (h[:-1] < h[1:])
    most[1:][back] = (gap - 1)[back]
    ahead = near & (h[1:] < h[:-1])
    least[:-1][ahead] = (REACH + 1 - gap)[ahead]
    alike = near & (h[1:] == h[:-1]) & (c[1:] == c[:-1]) & (most[1:] == most[:-1]) & (least[1:] == least[:-1])
    new = np.ones(len(at), bool)
    new[1:] = ~alike
    new[2:] |= alike[:-1] & (gap[1:] != gap[:-1])
    place = np.arange(len(at))
    inside = place - np.maximum.accumulate(np.where(new, place, 0))
    head = np.flatnonzero(inside % AGAIN == 0)
    again = np.diff([*head, len(at)]) - 1
    step = np.where(again > 0, np.append(gap, 0)[head], 0)
    return head, at[head] << 32 | again << 18 | step << 12 | most[head] << 6 | least[head]


def _more(packed: np.ndarray) -> np.ndarray:
    """Bytes from the first to the last place of a run."""
    return (packed >> 18 & (AGAIN - 1)) * (packed >> 12 & 63)


def repeat_groups(suffixes: np.ndarray, ends: np.ndarray, before: np.ndarray, least: int = MIN):
    """Maximal repeats of sorted suffixes: (length, from, to) over the sorted order.

    ``suffixes``: rows of bytes in order; ``ends``: their lengths; ``before``: the
    byte before each, negative and unlike any other where there is none. A run of
    adjacent common prefixes is scanned with a stack of open intervals; a closed
    interval counts if its suffixes do not all follow the same byte.
    """
    if len(suffixes) < 2:
        return
    differ = suffixes[1:] != suffixes[:-1]
    common = np.where(differ.any(1), differ.argmax(1), suffixes.shape[1])
    common = np.minimum(common, np.minimum(ends[1:], ends[:-1]))
    # changes of the byte before, counted up: an interval is diverse if its count moves
    moved = np.concatenate([[0], np.cumsum((before[1:] != before[:-1]) | (before[1:] < 0))])
    held = np.flatnonzero(common >= least)
    if not len(held):
        return
    breaks = np.flatnonzero(np.diff(held) > 1)
    for a, b in zip(np.concatenate([[0], breaks + 1]).tolist(), np.concatenate([breaks, [len(held) - 1]]).tolist()):
        first, last = int(held[a]), int(held[b])
        stack: list[tuple[int, int]] = []  # (length, from)
        for i, length in enumerate([*common[first : last + 1].tolist(), 0], first):
            start = i
            while stack and stack[-1][0] > length:
                depth, start = stack.pop()
                if moved[i] != moved[start]:
                    yield depth, start, i + 1
            if length and (not stack or stack[-1][0] < length):
                stack.append((length, start))


def _window_hashes(text: np.ndarray) -> np.ndarray:
    """Hashes of the ``MIN`` bytes from each of the first places of every row."""
    h, step, factor, powers = text.astype(np.uint64) + np.uint64(1), 1, FACTOR, {}
    total, at = np.zeros((len(text), REACH + 1), np.uint64), 0
    while step <= MIN:
        powers[step] = (h, factor)
        h = h[:, :-step] * np.uint64(factor) + h[:, step:]
        factor, step = factor * factor % (1 << 64), step * 2
    for step in sorted(powers, reverse=True):
        if MIN & step:
            h, factor = powers[step]
            total = total * np.uint64(factor) + h[:, at : at + REACH + 1]
            at += step
    return _mixed(total)


def _first_seen(group: np.ndarray, doc: np.ndarray, most: np.ndarray, least: np.ndarray,
                left: list[bytes], right: list[bytes]):
    """(row, from, to) in bytes relative to the anchor: what stands in a smaller
    document already. ``group`` numbers the anchors, rows of one stand together;
    windows begin ``most`` to ``least`` bytes before an anchor, the others are met at theirs."""
    n = len(doc)
    width = REACH + MIN
    text = np.zeros((n, width + 6), np.uint8)
    text[:, :REACH] = np.frombuffer(b"".join(x.rjust(REACH, b"\0") for x in left), np.uint8).reshape(n, REACH)
    text[:, REACH:width] = np.frombuffer(b"".join(x.ljust(MIN, b"\0") for x in right), np.uint8).reshape(n, MIN)
    ll, rl = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    text[:, width], text[:, width + 1] = ll, rl
    text[:, width + 2 :] = group.astype(">u4").view(np.uint8).reshape(n, 4)
    flat = text.view(f"S{width + 6}")[:, 0]
    order = np.argsort(doc, kind="stable")
    order = order[np.argsort(flat[order], kind="stable")]
    same = np.concatenate([[False], (text[order[1:]] == text[order[:-1]]).all(1)])
    head = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    first = doc[order[head]]
    later = (doc[order] > first) & (ll[order] + rl[order] >= MIN)
    rows = order[later]
    yield rows, -ll[rows], rl[rows]  # the whole context stands in a smaller document
    own = order[~same]  # one row per different context, in its smallest document
    # which may hold it more than once: those rows follow it in the order and lose what it loses
    alike = np.bincount(head[same & (doc[order] == first)], minlength=n) + 1
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    many = np.bincount(group[own], minlength=int(group.max()) + 1)[group[own]] > 1
    own = own[many]
    low = REACH - np.minimum(ll, most)
    high = np.minimum(REACH + rl - MIN, REACH - least)
    inside = [np.flatnonzero((low[own] <= o) & (o <= high[own])) for o in range(REACH + 1)]
    row = np.concatenate(inside)
    if not len(row):
        return
    offset = np.repeat(np.arange(REACH + 1), [len(r) for r in inside])
    # A window that occurs once is in no repeat: by its hash, so those of equal windows all stay.
    _, kind, times = np.unique(_window_hashes(text[own, :width])[row, offset], return_inverse=True, return_counts=True)
    again = times[kind] > 1
    row, offset = own[row[again]], offset[again]
    if not len(row):
        return
    suffix = np.zeros((len(row), 5 + width), np.uint8)
    suffix[:, :4] = text[row, width + 2 :]
    edges = np.searchsorted(offset, np.arange(REACH + 2))
    for o, (a, b) in enumerate(zip(edges, edges[1:])):
        suffix[a:b, 4 : 4 + width - o] = text[row[a:b], o:width]
    ends = 4 + REACH + rl[row] - offset
    suffix[:, -1] = ends  # a text may hold zeros, as what fills up does: the shorter goes first
    array = np.argsort(suffix.view(f"S{5 + width}")[:, 0], kind="stable")  # the suffix array
    row, offset, suffix, ends = row[array], offset[array], suffix[array, :-1], ends[array]
    before = np.where(offset > low[row], text[row, offset - 1].astype(np.int64), -1)
    out: list[tuple[np.ndarray, int, int]] = []
    for length, a, b in repeat_groups(suffix, ends, before, 4 + MIN):
        docs = doc[row[a:b]]
        gone = np.flatnonzero(docs > docs.min()) + a
        if len(gone):
            out.append((gone, length - 4))
    if out:
        gone = np.concatenate([g for g, _ in out])
        size = np.concatenate([np.full(len(g), s) for g, s in out])
        # two spans of one context overlap, as it is shorter than both: they are one
        by_row = np.argsort(row[gone], kind="stable")
        gone, size = gone[by_row], size[by_row]
        starts = np.flatnonzero(np.concatenate([[True], np.diff(row[gone]) > 0]))
        low = np.minimum.reduceat(offset[gone], starts)
        high = np.maximum.reduceat(offset[gone] + size, starts)
        at = place[row[gone[starts]]]
        times = alike[at]
        each = np.repeat(np.arange(len(at)), times)
        rows = order[at[each] + np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)]
        yield rows, low[each] - REACH, high[each] - REACH


OPEN, SEEN, COPY = 0, 1, 2  # what is known of a place: to be compared, context stands earlier, text is a copy


def _shared_anchors(texts: DataFrame) -> DataFrame:
    """(doc, tag, hot, kind, places) of the texts with anchors that two documents share.

    Rows are dealt and sorted by anchor, document and place, and a task streams them:
    it holds one anchor's rows, ``HOT`` of them at most, beyond which the anchor is
    known to be hot. Of the rows with one context the first stands and the others
    are SEEN whole; of an anchor with several contexts the first rows stay OPEN, for
    the suffix array. Each text adds a row for itself at place -1, filed by a hash of
    the whole; where that is shared, all but the smallest document are a COPY.
    """
    types = "doc long, tag int, at long, h long, c long"

    def make():
        def work(batch):
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            who, at, h, c = anchors(texts)
            whole = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64)
            head, at = _packed(who, at, h, c)
            who, h, c = who[head], h[head], c[head]
            at = np.concatenate([at, np.full(len(texts), -1)])
            who = pa.array(np.concatenate([who, np.arange(len(texts))]))
            return {"doc": batch.column(0).take(who), "tag": batch.column(1).take(who), "at": at,
                    "h": np.concatenate([h, whole]).view(np.int64),
                    "c": np.concatenate([c, np.zeros(len(texts), np.uint64)]).view(np.int64)}

        return work

    def shared(batches):
        names = ("doc", "tag", "at", "h", "c")
        held = {n: [] for n in names}
        hot = None  # hash and smallest document of the anchor being passed on

        def out(x, keep, kind, hot):
            kind = np.broadcast_to(kind, len(keep))[keep].astype(np.int32)
            return pa.RecordBatch.from_pydict({"doc": x["doc"][keep], "tag": x["tag"][keep], "at": x["at"][keep],
                                               "kind": kind, "hot": np.full(int(keep.sum()), hot)})

        def settle(x):
            """Rows of whole runs."""
            h, doc, at, tag, c = (x[n] for n in ("h", "doc", "at", "tag", "c"))
            starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            sizes = np.diff([*starts, len(h)])
            run = np.repeat(np.arange(len(starts)), sizes)
            text = at < 0
            one = np.minimum.reduceat(text, starts) & (np.minimum.reduceat(tag, starts) == np.maximum.reduceat(tag, starts))
            copy = text & one[run] & (doc > doc[starts][run])
            found = (doc[starts + sizes - 1] > doc[starts])[run] & ~text
            # stable, so the first row of a context is the one in its smallest document
            order = np.lexsort((c, run))
            first = np.concatenate([[True], (c[order][1:] != c[order][:-1]) | (run[order][1:] != run[order][:-1])])
            lead = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            seen = np.zeros(len(h), bool)
            seen[order] = doc[order] > doc[lead]
            leads = np.zeros(len(h), bool)
            leads[order[first]] = True
            several = (np.add.reduceat(leads, starts, dtype=np.int64) > 1)[run]
            open_ = found & ~seen & several & leads_of_doc(order, lead, doc, leads)
            kind = np.where(copy, COPY, np.where(seen, SEEN, OPEN))
            return out(x, copy | (found & seen) | open_, kind, False)

        def leads_of_doc(order, lead, doc, leads):
            """First rows of a context, and its other rows in the same document."""
            same = leads.copy()
            same[order] |= doc[order] == doc[lead]
            return same

        def pass_on(x, keep):
            keep = keep & ((x["at"] >= 0) | (x["doc"] > hot[1]))
            return out(x, keep, np.where(x["at"] < 0, COPY, OPEN), True)

        for batch in batches:
            for i, n in enumerate(names):
                held[n].append(batch.column(i).to_numpy())
            x = {n: np.concatenate(v) for n, v in held.items()}
            if hot is not None:
                mine = x["h"] == hot[0]
                if mine.any():
                    yield pass_on(x, mine)
                x = {n: v[~mine] for n, v in x.items()}
            if len(x["h"]) and not (x["h"][0] == x["h"][-1] and len(x["h"]) <= HOT):
                hot = None
                last = int(np.searchsorted(x["h"], x["h"][-1]))
                if last:
                    yield settle({n: v[:last] for n, v in x.items()})
                x = {n: v[last:] for n, v in x.items()}
                if len(x["h"]) > HOT and x["doc"][0] < x["doc"][-1]:
                    hot = (x["h"][0], x["doc"][0])
                    yield pass_on(x, np.ones(len(x["h"]), bool))
                    x = {n: v[:0] for n, v in x.items()}
            held = {n: [v] for n, v in x.items()}
        x = {n: np.concatenate(v) if v else np.zeros(0) for n, v in held.items()}
        if len(x["h"]):
            yield settle(x)

    rows = map_batches(texts, types, make).repartition("h").sortWithinPartitions("h", "doc")
    found = rows.mapInArrow(shared, "doc long, tag int, at long, kind int, hot boolean")
    return cut(found.groupBy("doc", "tag", "kind", "hot").agg(F.collect_list("at").alias("places")))


def _contexts(bodies: DataFrame, places: DataFrame) -> DataFrame:
    """(doc, tag, at, before, after, hot): the bytes before and from each shared anchor."""

    def make():
        def work(batch):
            out = {name: [] for name in ("doc", "tag", "at", "before", "after", "hot")}
            for doc, tag, body, found, hot in zip(*(batch.column(i).to_pylist() for i in range(5))):
                data = _opened(body)
                out["doc"] += [doc] * len(found)
                out["tag"] += [tag] * len(found)
                out["hot"] += [hot] * len(found)
                out["at"] += found
                out["before"] += [data[max(0, (p >> 32) - REACH) : p >> 32] for p in found]
                out["after"] += [data[p >> 32 : (p >> 32) + MIN] for p in found]
            return out

        return work

    met = bodies.join(places, KEYS).select("doc", "tag", "body", "places", "hot")
    return map_batches(met, "doc long, tag int, at long, before binary, after binary, hot boolean", make)


def _spans(contexts: DataFrame) -> DataFrame:
    """(doc, tag, span) of what a smaller document has, anchor by anchor. A span is
    its start, shifted by 32 bits, and its length."""
    types = "doc long, tag int, span long"

    def run(batches):
        held: list[pa.RecordBatch] = []

        def work(table: pa.Table) -> pa.RecordBatch:
            doc = table.column("doc").to_numpy()
            packed = table.column("at").to_numpy()
            at = packed >> 32
            after = table.column("after").to_pylist()
            grams = np.array([x[:GRAM] for x in after], f"V{GRAM}")
            group = np.cumsum(np.concatenate([[0], grams[1:] != grams[:-1]]))
            parts = list(_first_seen(group, doc, packed >> 6 & 63, packed & 63, table.column("before").to_pylist(), after))
            row, a, b = (np.concatenate([p[i] for p in parts]) for i in range(3))
            tag = table.column("tag").to_numpy()
            return pa.RecordBatch.from_pydict({
                "doc": doc[row], "tag": tag[row], "span": (at[row] + a) << 32 | (b - a + _more(packed[row])),
            })

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            if table.num_rows < CHUNK:
                continue
            # an anchor's contexts stay together: what may go on in the next batch waits
            after = table.column("after").slice(0)
            last = after[table.num_rows - 1].as_py()[:GRAM]
            keep = table.num_rows
            while keep and after[keep - 1].as_py()[:GRAM] == last:
                keep -= 1
            if keep:
                yield work(table.slice(0, keep))
                held = table.slice(keep).combine_chunks().to_batches()
        if held:
            yield work(pa.Table.from_batches(held))

    filed = contexts.where("not hot").drop("hot").withColumn("gram", F.substring("after", 1, GRAM))
    filed = filed.repartition("gram").sortWithinPartitions("gram").drop("gram")
    usual = filed.mapInArrow(run, types)
    # an anchor with very many contexts: its windows are suffixes of MIN bytes, so an
    # interval is a set of equal windows, whose smallest document is found by map-side combining
    whole = F.concat("before", "after")
    at = F.shiftright("at", 32).cast("int") - F.length("before")
    more = (F.shiftright("at", 18).bitwiseAND(F.lit(AGAIN - 1)) * F.shiftright("at", 12).bitwiseAND(F.lit(63))).alias("more")
    windows = contexts.where("hot").select(
        "doc", "tag", more, F.explode(F.transform(
            F.sequence(F.lit(0), F.length(whole) - MIN),
            lambda o: F.struct((at + o).alias("start"), whole.substr(o + 1, F.lit(MIN)).alias("w")),
        )).alias("x")).select("doc", "tag", "more", "x.start", "x.w")
    first = windows.groupBy("w").agg(F.min("doc").alias("first"))
    rest = windows.join(first, "w").where("doc > first")
    rest = rest.select("doc", "tag", (F.shiftleft(F.col("start").cast("long"), 32) + MIN + F.col("more")).alias("span"))
    return usual.union(rest)


KEYS = ["doc", "tag", "none"]


def _opened(body: bytes) -> bytes:
    return zstandard.decompress(body)


def _bodies(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, none, tag, body): the text compressed, as it crosses the shuffle. The key columns
    are never null, so both joins with it ask for the very same shuffle, which is made once."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("doc"), F.col(key).isNull().alias("none"),
                       F.hash(whole).alias("tag"), whole.alias("text"))

    def make():
        pack = zstandard.ZstdCompressor(level=3)

        def work(batch):
            texts = batch.column(3).cast(pa.binary()).to_pylist()
            return {"doc": batch.column(0), "none": batch.column(1), "tag": batch.column(2), "body": [pack.compress(t) for t in texts]}

        return work

    return map_batches(rows, "doc long not null, none boolean not null, tag int not null, body binary not null", make)


def _found(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, body, spans) of every row."""
    kind = docs.schema[key].dataType.simpleString()
    bodies = _bodies(docs, key, text)
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = rows.where("doc is not null").where(F.octet_length("text") >= MIN).select("doc", F.hash("text").alias("tag"), "text")
    places = _shared_anchors(texts).withColumn("none", F.lit(False))
    release(docs)
    spans = _spans(_contexts(bodies, places.where(F.col("kind") == OPEN)))
    spans = spans.select("doc", "tag", F.array("span").alias("spans"))

    def seen(place):
        run = F.shiftright(place, 18).bitwiseAND(F.lit(AGAIN - 1)) * F.shiftright(place, 12).bitwiseAND(F.lit(63))
        start = F.greatest(F.shiftright(place, 32) - REACH, F.lit(0))
        return F.shiftleft(start, 32) + (F.shiftright(place, 32) + MIN + run - start)

    whole = F.array(F.lit(-1).cast("long"))
    more = places.where(F.col("kind") != OPEN).select(
        "doc", "tag", F.when(F.col("kind") == COPY, whole).otherwise(F.transform("places", seen)).alias("spans"))
    known = spans.union(more).groupBy("doc", "tag", F.lit(False).alias("none")).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    met = bodies.join(known, KEYS, "left")
    owner = F.when(F.col("none"), F.lit(None)).otherwise(F.col("doc")).cast(kind)
    return met.select(owner.alias(key), "body", F.coalesce("spans", F.array().cast("array<bigint>")).alias("spans"))


def _merged(spans: pa.ListArray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of what is to go, in order and apart, and where each row's begin among them."""
    edges = spans.offsets.to_numpy()
    found = spans.values.to_numpy()[edges[0] : edges[-1]]
    owner = np.repeat(np.arange(len(spans)), np.diff(edges))
    start = np.where(found < 0, 0, found >> 32)
    end = np.where(found < 0, sizes[owner], np.minimum(start + (found & 0xFFFFFFFF), sizes[owner]))
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    reach = np.maximum.accumulate(owner << 32 | end)  # a later row's is beyond all of an earlier one
    new = np.ones(len(start), bool)
    new[1:] = (owner[1:] << 32 | start[1:]) > reach[:-1]
    heads = np.flatnonzero(new)
    last = np.append(heads, len(start))[1:] - 1
    return start[heads], reach[last] & 0xFFFFFFFF, np.searchsorted(owner[heads], np.arange(len(spans) + 1))


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, spans): per row the byte spans that a document of a smaller key has.

    Every byte under a window of ``MIN`` bytes that also starts in a document with a
    smaller key is in a span, (start, end) in order and apart; they are judged on the input.
    Equal texts, told by 96 bits of two hashes, are worked on once, in the row of the
    smallest key, so thousands of copies cost one; the other rows go whole. Equal
    contexts of an anchor are told by 128 bits of two hashes. A null text is an empty one. Rows of
    one key are parts of one document: they take nothing from each other. A row
    with a null key neither takes nor loses. An empty table gives no rows; other
    columns are left out.

    Texts are never grouped. They cross one shuffle, compressed, and meet there first
    the places of shared anchors, then the spans found. Hashes of anchors and the
    contexts of shared ones are dealt by content.
    """
    kind = docs.schema[key].dataType.simpleString()

    def make():
        def work(batch):
            texts = [_opened(body) for body in batch.column(1).to_pylist()]
            start, end, edges = _merged(batch.column(2), np.array([len(t) for t in texts]))
            spans = pa.StructArray.from_arrays([pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], names=["start", "end"])
            spans = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), spans)
            return {"key": batch.column(0), "text": [t.decode() for t in texts], "spans": spans}

        return work

    found = map_batches(_found(docs, key, text), f"key {kind}, text string, spans array<struct<start: int, end: int>>", make)
    return found.withColumnRenamed("key", key)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256): counts of the bytes and spans ``removed``
    finds, and the digest of the bytes that stay. Odd rows as there."""
    kind = docs.schema[key].dataType.simpleString()

    def make():
        def work(batch):
            texts = [_opened(body) for body in batch.column(1).to_pylist()]
            sizes = np.array([len(t) for t in texts])
            start, end, edges = _merged(batch.column(2), sizes)
            gone = np.append(0, np.cumsum(end - start))[edges]
            starts, ends, digests_ = start.tolist(), end.tolist(), []
            for text, low, high in zip(texts, edges.tolist(), edges[1:].tolist()):
                kept, at, data = hashlib.sha256(), 0, memoryview(text)
                for a, b in zip(starts[low:high], ends[low:high]):
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                digests_.append(kept.hexdigest())
            return {"key": batch.column(0), "n_bytes": sizes, "n_removed": np.diff(gone), "n_spans": np.diff(edges),
                    "kept_sha256": digests_}

        return work

    schema = f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return map_batches(_found(docs, key, text), schema, make).withColumnRenamed("key", key)
