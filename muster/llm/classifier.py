"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Every word owns a sparse random index vector, drawn from its hash. A word's
vector is the sum of the index vectors of its neighbours over the training
texts, its own added, so words used alike get vectors alike and words never met
still have one. A document is the mean of its word vectors, next to the mean of
its word shapes (case, digits, marks around the letters, same as the word
before), vectors of the same kind, and its length. A network of two layers,
trained here in numpy, turns that into a logit; a temperature fitted on rows
kept apart calibrates the probability.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import map_batches

WORDS = 1 << 14  # rows of the word table; words share them by hash
SHAPES = 1 << 10
DIMS = 48
SHAPE_DIMS = 24
NEAR = 2  # neighbours to either side
MEMO = 64 << 20  # bytes of words a task remembers before it starts again
LONG = 64  # characters; longer words are placed anew each time
_LETTERS = re.compile(r"[^\W\d_]+")
_RUNS = re.compile(r"(.)\1+")


def index_vectors(rows: int, dims: int, seed: int, ones: int = 4) -> np.ndarray:
    """Sparse vectors of +1 and -1, the same wherever they are drawn."""
    rng = np.random.default_rng(seed)
    out = np.zeros((rows, dims), np.float32)
    for _ in range(ones):
        out[np.arange(rows), rng.integers(0, dims, rows)] += rng.choice(np.array([-1, 1], np.float32), rows)
    return out


def _shape(word: str) -> str:
    """Case, digits and marks of a whole word, runs shortened: 'Xx', 'x,', 'X!'."""
    marked = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    return _RUNS.sub(r"\1", marked)


def _core(word: str) -> str:
    return "".join(_LETTERS.findall(word)).lower() or word


class _Places(dict):
    """Row of the word table times ``SHAPES`` plus row of the shape table, per word. A task
    has one of its own, so that nothing stays in a worker when the task ends."""

    held = 0

    def __missing__(self, word: str) -> int:
        if self.held > MEMO:
            self.clear()
            self.held = 0
        # plain words, alone or before a mark, are most; their core and shape need no look at each letter
        plain, mark = (word[:-1], word[-1]) if word[-1] in ".,;:!?" else (word, "")
        if plain.isalpha() and plain.islower():
            core, shape = plain.lower(), "x" + mark
        elif plain.isalpha() and plain[0].isupper() and plain[1:].islower():
            core, shape = plain.lower(), "Xx" + mark
        else:
            core, shape = _core(word), _shape(word)
        row = zlib.crc32(core.encode("utf-8", "surrogatepass")) % WORDS
        place = row * SHAPES + 1 + zlib.crc32(shape.encode("utf-8", "surrogatepass")) % (SHAPES - 1)
        if len(word) <= LONG:
            self[word] = place
            self.held += 200 + len(word)
        return place


def read(text: str | None, places: _Places) -> tuple[np.ndarray, np.ndarray]:
    """Word and shape rows of a text; shape 0 marks a word equal to the one before."""
    words = (text or "").split()
    found = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
    shapes = found % SHAPES
    for at in np.flatnonzero(found[1:] == found[:-1]) + 1:  # equal places are seldom different words
        if words[at] == words[at - 1]:
            shapes[at] = 0
    return found // SHAPES, shapes


@dataclass
class Model:
    """Fixed in size whatever the corpus: two tables and two layers."""

    words: np.ndarray
    shapes: np.ndarray
    mean: np.ndarray = field(default=None)
    spread: np.ndarray = field(default=None)
    layers: list = field(default_factory=list)
    temperature: float = 1.0

    def pooled(self, text: str | None, places: _Places) -> np.ndarray:
        words, shapes = read(text, places)
        n = len(words)
        out = np.zeros(DIMS + SHAPE_DIMS + 2, np.float32)
        out[-1] = np.log1p(n)
        if n:
            total = np.zeros(DIMS, np.float64)
            for at in range(0, n, 4096):
                total += self.words[words[at : at + 4096]].sum(0)
            out[:DIMS] = total / n
            counts = np.bincount(shapes, minlength=SHAPES)
            rows = counts.nonzero()[0]
            out[DIMS : DIMS + SHAPE_DIMS] = counts[rows].astype(np.float64) @ self.shapes[rows].astype(np.float64) / n
            out[-2] = float((shapes == 0).mean())
        return out

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        (w1, b1), (w2, b2) = self.layers
        return (np.maximum((pooled - self.mean) / self.spread @ w1 + b1, 0) @ w2 + b2)[:, 0]

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        z = np.clip(self.logit(pooled) / self.temperature, -60, 60)
        return 1 / (1 + np.exp(-z))


def context_sums(texts: DataFrame, text: str = "text", block: int = 512) -> np.ndarray:
    """Sum of neighbours' index vectors per word row: partial tables per task,
    added block by block on Spark; the result is ``WORDS`` rows."""
    schema = "block int, part binary"

    def run(batches):
        index = index_vectors(WORDS, DIMS, 1)
        table = np.zeros((WORDS, DIMS), np.float32)
        places = _Places()
        for batch in batches:
            for words in (read(t, places)[0] for t in batch.column(0).to_pylist()):
                for gap in range(1, NEAR + 1):
                    if len(words) > gap:
                        np.add.at(table, words[gap:], index[words[:-gap]])
                        np.add.at(table, words[:-gap], index[words[gap:]])
        parts = [table[a : a + block].tobytes() for a in range(0, WORDS, block)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())],
                                         names=["block", "part"])

    def add(rows):
        total = sum(np.frombuffer(p, np.float32) for p in rows["part"])
        return rows.iloc[:1].assign(part=[np.float32(total).tobytes()])

    parts = texts.select(text).mapInArrow(run, schema).groupBy("block").applyInPandas(add, schema)
    out = np.zeros((WORDS, DIMS), np.float32)
    for row in parts.collect():
        out[row.block * block : (row.block + 1) * block] = np.frombuffer(row.part, np.float32).reshape(-1, DIMS)
    return out


def train(x: np.ndarray, y: np.ndarray, hidden: int = 32, rounds: int = 300, rate: float = 0.01,
          decay: float = 1e-3, seed: int = 7) -> list:
    """Two layers by Adam on the full sample, classes weighted alike."""
    rng = np.random.default_rng(seed)
    layers = [(rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden)),
              (rng.normal(0, (1 / hidden) ** 0.5, (hidden, 1)), np.zeros(1))]
    state = [[np.zeros_like(p) for p in pair] for pair in layers for _ in range(2)]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    for step in range(1, rounds + 1):
        (w1, b1), (w2, b2) = layers
        h = np.maximum(x @ w1 + b1, 0)
        p = 1 / (1 + np.exp(-np.clip(h @ w2 + b2, -60, 60)[:, 0]))
        g = ((p - y) * weight / len(y))[:, None]
        gh = (g @ w2.T) * (h > 0)
        grads = [(x.T @ gh + decay * w1, gh.sum(0)), (h.T @ g + decay * w2, g.sum(0))]
        fresh = []
        for i, (pair, grad) in enumerate(zip(layers, grads)):
            new = []
            for j in (0, 1):
                m, v = state[2 * i], state[2 * i + 1]
                m[j] = 0.9 * m[j] + 0.1 * grad[j]
                v[j] = 0.999 * v[j] + 0.001 * grad[j] ** 2
                new.append(pair[j] - rate * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.999**step)) + 1e-8))
            fresh.append(tuple(new))
        layers = fresh
    return layers


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least loss on rows not trained on."""
    if not len(y):
        return 1.0
    tried = np.geomspace(0.2, 10, 80)
    z = np.clip(logits[None, :] / tried[:, None], -60, 60)
    return float(tried[(np.logaddexp(0, z) - z * y).mean(1).argmin()])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, key: str = "doc_id", text: str = "text",
        label: str = "quality") -> Model:
    """A model from labelled rows whose crc32(key) mod 5 is not 0.

    Of those at most ``max_rows`` are used, chosen by a hash of the key: the fit
    is of a fixed size. A fifth of them (mod 5 is 1) calibrates the temperature
    and trains nothing. Rows with a null or odd label, text or key teach nothing. With one class or no
    row at all the network stays untrained and every score is the share of good
    rows, one half without any.
    """
    fold = F.crc32(F.col(key).cast("string").cast("binary")) % 5
    known = labels.select(key, F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & (fold != 0))
    known = known.orderBy(F.xxhash64(key), key).limit(max_rows)
    sample = docs.select(key, F.col(text).alias("text")).where("text is not null").join(F.broadcast(known), key)
    sample = sample.select("text", "y", fold.alias("fold")).repartition(16)
    model = Model(context_sums(sample), index_vectors(SHAPES, SHAPE_DIMS, 2))
    model.words += index_vectors(WORDS, DIMS, 1)
    norm = np.linalg.norm(model.words, axis=1, keepdims=True)
    model.words /= np.where(norm > 0, norm, 1)

    def make():
        places = _Places()
        return lambda batch: {
            "x": [model.pooled(t, places).tobytes() for t in batch.column(0).to_pylist()],
            "y": batch.column(1), "fold": batch.column(2),
        }

    rows = map_batches(sample.select("text", "y", F.col("fold").cast("int")), "x binary, y int, fold int", make).collect()
    width = DIMS + SHAPE_DIMS + 2
    x = np.array([np.frombuffer(r.x, np.float32) for r in rows], np.float64).reshape(-1, width)
    y, folds = np.array([r.y for r in rows], float), np.array([r.fold for r in rows])
    order = np.lexsort(x.T) if len(x) else []
    x, y, folds = x[order], y[order], folds[order]
    model.mean = x.mean(0) if len(x) else np.zeros(width)
    model.spread = np.where(x.std(0) > 1e-9, x.std(0), 1) if len(x) else np.ones(width)
    own, apart = folds != 1, folds == 1
    if len(set(y[own])) < 2:
        share = np.clip(y.mean(), 0.01, 0.99) if len(y) else 0.5
        model.layers = [(np.zeros((width, 1)), np.zeros(1)), (np.zeros((1, 1)), np.array([np.log(share / (1 - share))]))]
        return model
    model.layers = train((x[own] - model.mean) / model.spread, y[own])
    model.temperature = temperature(model.logit(x[apart]), y[apart])
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.3, key: str = "doc_id", text: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """(key, held_out, score, predicted) of every row, and the columns of ``keep``.

    Only the text enters a score. A null or empty text scores by its length of no
    words; a null key stays null and counts as not held out; repeated rows are
    scored each; an empty table gives no rows. One narrow pass, no shuffle.
    """
    kept = keep or []
    kinds = {c: docs.schema[c].dataType.simpleString() for c in [key, *kept]}
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size, see Model

    def make():
        own, places = shared.value, _Places()

        def work(batch):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            pooled = np.array([own.pooled(t, places) for t in texts])
            return {f"c{i}": batch.column(i) for i in range(len(kinds))} | {"score": own.probability(pooled)}

        return work

    columns = [F.col(c).alias(f"c{i}") for i, c in enumerate(kinds)]
    schema = ", ".join([*(f"c{i} {k}" for i, k in enumerate(kinds.values())), "score double"])
    scored = map_batches(docs.select(*columns, F.col(text).alias("t")), schema, make)
    fold = F.crc32(F.col("c0").cast("string").cast("binary")) % 5
    return scored.select(
        F.col("c0").alias(key), F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(kinds) if i],
    )
