"""Approximate nearest neighbours by NN-descent.

A neighbour of a neighbour is probably a neighbour. From a first graph of exact
neighbours within random cells, every round joins each node's neighbours, and
those it is a neighbour of, with each other; pairs better than what a node has
enter its list, until few do. Queries walk the graph greedily: the best nodes
met so far are expanded, what they point to is scored, the best are kept, until
all of those have been expanded.

Nearness is the inner product. Vectors are filed into shells by length, each four times
as long as the one before. Within a shell every vector gets one more component that
brings all to the length of the longest there, which turns the largest inner product
into the smallest angle; so no vector, however long, blurs the others. A shell has a
graph of its own, and a query walks all of them.
"""

from __future__ import annotations

import math
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.common import cut, each_group, map_batches, release
from muster.operators.joins import split_join

CELL = 256  # nodes of a random cell, on average at most


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v) without vectors that are null, zero, of another length than most,
    or hold a null or non-finite component."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("v", lambda x: x != 0)
    rows = rows.select(F.col(key).alias("vec_id"), F.col(vector).alias("v")).where("vec_id is not null and v is not null")
    rows = rows.where(fine & F.coalesce(some, F.lit(False)))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (usual.d if usual else 0))


def _half(nodes: DataFrame) -> DataFrame:
    """(node, shell, b): the lengthened vector in half precision, scaled by its shell, for the graph alone."""

    def make():
        def work(batch):
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)
            # scaled first, as squares of very long or short vectors do not fit
            peak = np.frexp(np.abs(v).max(axis=1, initial=0))[1]
            v = np.ldexp(v, -peak[:, None])
            # lengths from 1/2 to 2 are shell 0, so those about 1 are not torn apart
            shell = (peak + np.frexp(np.sqrt((v * v).sum(1)))[1]) // 2
            v = np.ldexp(v, (peak - 2 * shell - 1)[:, None])
            rest = np.sqrt(np.maximum(0, 1 - (v * v).sum(1, keepdims=True)))
            half = np.concatenate([v, rest], 1).astype(np.float16)
            return {"node": batch.column(0), "shell": shell.astype(np.int32), "b": [x.tobytes() for x in half]}

        return work

    return map_batches(nodes.select("node", "v"), "node long, shell int, b binary", make)


def _matrix(b: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(b.to_pylist()), np.float16).reshape(len(b), -1).astype(np.float32)


def _cells(half: DataFrame, n: int, dims: int, k: int, tables: int = 3) -> DataFrame:
    """First graph: exact neighbours within cells of random hyperplanes. A cell that
    holds more than its share is dealt out by hash; this only starts the search."""
    bits = max(0, math.ceil(math.log2(max(1, n / CELL))))  # a smaller shell has emptier cells
    planes = np.random.default_rng(5).normal(size=(tables, dims, bits))

    def make():
        def work(batch):
            x = _matrix(batch.column(2))[:, :dims]
            code = [((x @ p) > 0) @ (1 << np.arange(bits)) if bits else np.zeros(len(x), int) for p in planes]
            rows = np.tile(np.arange(len(x)), tables)
            return {"t": np.repeat(np.arange(tables), len(x)), "shell": batch.column(1).take(pa.array(rows)),
                    "cell": np.concatenate(code).astype(np.int64),
                    "node": batch.column(0).take(pa.array(rows)), "b": batch.column(2).take(pa.array(rows))}

        return work

    rows = cut(map_batches(half, "t int, shell int, cell long, node long, b binary", make))
    sizes = rows.groupBy("t", "shell", "cell").agg(F.ceil(F.count("*") / (2 * CELL)).cast("int").alias("pieces"))
    rows = rows.join(sizes, ["t", "shell", "cell"]).withColumn("piece", F.pmod(F.xxhash64("node", "t"), "pieces").cast("int"))

    def near(g):
        x, node = _matrix(g["b"]), g["node"]
        sims = x @ x.T
        np.fill_diagonal(sims, -9)
        m = min(k, len(node) - 1)
        best = np.argpartition(-sims, m - 1, axis=1)[:, :m] if m > 0 else np.zeros((len(node), 0), int)
        return {"node": np.repeat(node, m), "near": node[best].ravel(), "score": np.take_along_axis(sims, best, 1).ravel()}

    return each_group(rows.select("t", "shell", "cell", "piece", "node", "b"), ["t", "shell", "cell", "piece"],
                      "node long, near long, score float", near)


def _top(rows: DataFrame, by: str, k: int) -> DataFrame:
    """The k best rows of each ``by``; ranks are cut on the map side too."""
    order = "near" if by == "node" else "node"
    rank = F.expr(f"row_number() OVER (PARTITION BY {by} ORDER BY score DESC, {order})")
    return rows.withColumn("r", rank).where(f"r <= {k}").drop("r")


def build(half: DataFrame, n: int, dims: int, k: int = 32, settled: float = 0.02) -> DataFrame:
    """The neighbour graph (node, near, score): ``k`` a node, written each round. Lists only
    get better, and rounds go on until less than a share ``settled`` of the entries are new."""
    start = _cells(half, n, dims, k).groupBy("node", "near").agg(F.max("score").alias("score"))
    graph = cut(_top(start, "node", k).withColumn("new", F.lit(True)))

    def local_join(g):
        x, who, new, worst = _matrix(g["b"]), g["member"], g["new"], g["worst"]
        sims = x @ x.T
        good = (new[:, None] | new[None, :]) & (sims > worst[:, None]) & (who[:, None] != who[None, :])
        a, b = np.nonzero(good)
        return {"node": who[a], "near": who[b], "score": sims[a, b]}

    vectors = half.select("node", "b")
    while True:
        worst = graph.groupBy("node").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(-9.0).cast("float").alias("worst"))
        back = _top(graph, "near", k).select(F.col("near").alias("m"), F.col("node").alias("member"), "new")
        members = graph.select(F.col("node").alias("m"), F.col("near").alias("member"), "new").union(back)
        members = members.groupBy("m", "member").agg(F.max("new").alias("new"))
        dealt = members.join(vectors.join(worst, "node", "left").withColumnRenamed("node", "member"), "member")
        found = each_group(dealt.select("m", "member", "new", F.coalesce("worst", F.lit(-9.0)).cast("float").alias("worst"), "b"),
                           ["m"], "node long, near long, score float", local_join)
        every = graph.select("node", "near", "score", F.lit(False).alias("new"))
        every = every.union(found.select("node", "near", "score", F.lit(True).alias("new")))
        every = every.groupBy("node", "near").agg(F.max("score").alias("score"), F.min("new").alias("new"))
        graph = cut(_top(every, "node", k))
        release(graph)
        if graph.where("new").count() <= settled * k * n:
            return graph.select("node", "near", "score")


def search(half: DataFrame, graph: DataFrame, queries: DataFrame, beam: int = 160, width: int = 24,
           seeds: int = 64) -> DataFrame:
    """(q, node): for each shell the ``beam`` best nodes met by greedy search from the query's own
    node, if it lies there, and ``seeds`` nodes of the shell, the same for all, so that no query
    is shut up in a small part of the graph and a shell of no more nodes is met whole. The
    search ends when the best nodes of all queries have been expanded."""
    arcs = cut(graph.select("node", "near").union(
        _top(graph, "near", 32).select(F.col("near").alias("node"), F.col("node").alias("near"))).distinct())
    asked = cut(queries.join(half, queries["q"] == half["node"]).select("q", F.col("shell").alias("own"), F.col("b").alias("bq")))

    def make():
        def work(batch):
            q, x = _matrix(batch.column(3)), _matrix(batch.column(4))
            return {"q": batch.column(0), "shell": batch.column(1), "near": batch.column(2), "score": (q[:, :-1] * x[:, :-1]).sum(1)}

        return work

    def scored(pairs):
        met = pairs.join(half.withColumnRenamed("node", "near").drop("shell"), "near").join(asked, "q")
        return map_batches(met.select("q", "shell", "near", "bq", "b"), "q long, shell int, near long, score float", make)

    # lengths of doubles have some 2,100 exponents, so there are at most half as many shells
    place = F.expr("row_number() OVER (PARTITION BY shell ORDER BY xxhash64(node), node)")
    spread = half.select("shell", "node").withColumn("place", place).where(f"place <= {seeds}").collect()
    if not spread:
        return queries.select("q", F.col("q").alias("node")).limit(0)
    starts = F.array(*[F.struct(F.lit(r.shell).alias("shell"), F.lit(r.node).alias("near")) for r in spread])
    first = asked.select("q", F.inline(starts)).union(asked.select("q", "own", F.col("q").alias("near"))).distinct()
    state = cut(scored(first).withColumn("done", F.lit(False)))
    while True:
        turn = F.expr("row_number() OVER (PARTITION BY q, shell ORDER BY done, score DESC, near)")
        ranked = state.withColumn("turn", turn)
        front = ranked.where(f"not done and turn <= {width}").select("q", "shell", F.col("near").alias("node"))
        ahead = front.join(arcs, "node").select("q", "shell", "near").distinct().join(state, ["q", "near"], "left_anti")
        kept = ranked.select("q", "shell", "near", "score", (F.col("done") | (F.col("turn") <= width)).alias("done"))
        every = kept.union(scored(ahead).withColumn("done", F.lit(False)))
        rank = F.expr("row_number() OVER (PARTITION BY q, shell ORDER BY score DESC, near)")
        state = cut(every.withColumn("r", rank).where(f"r <= {beam}").drop("r"))
        release(state)
        if state.where("not done").isEmpty():
            return state.select("q", F.col("near").alias("node"))


def _node_key(vectors: DataFrame) -> Column:
    """A number for each of the distinct vectors ``v``: a hash, of the first seed that tells all of them apart."""
    for seed in count():
        key = F.xxhash64("v", F.lit(seed))
        if vectors.groupBy(key.alias("node")).count().where("count > 1").isEmpty():
            return key


def nearest(rows: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vector: str = "embedding",
            degree: int = 32, beam: int = 160) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found to each row whose key
    ``every`` divides, its own row apart, nearest first, ties to the smaller key.

    Scores are inner products of the original vectors in double precision. Vectors
    that are null, zero, or hold a null or non-finite component take no part, nor
    do those of another length than most. Rows equal in key and vector are one row.
    A key with several vectors has a row for each: as candidates they are ranked each,
    as queries each gets its own list, without its own row. Equal vectors are
    one node, which remembers its ``k + 1`` smallest keys, all that can ever be asked
    for; a vector with a third of all rows is no hot spot. Fewer candidates give fewer
    ranks, an empty table no rows; other columns are left out.
    """
    found = usable(rows, key, vector).distinct()
    place = F.expr("row_number() OVER (PARTITION BY v ORDER BY vec_id)")
    few = cut(found.withColumn("place", place).where(f"place <= {k + 1}"))
    node = _node_key(few.where("place = 1"))
    few = few.withColumn("node", node)
    nodes = few.where("place = 1").select("node", "v")
    size = nodes.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    half = cut(_half(nodes))
    graph = build(half, size.n, size.d or 1, degree)
    asked = cut(found.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), node.alias("q")))
    met = search(half, graph, asked.select("q").distinct(), beam)
    pairs = met.join(nodes.select(F.col("node").alias("q"), F.col("v").alias("x")), "q").join(nodes, "node")
    product = F.aggregate(F.zip_with("x", "v", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, p: s + p)
    pairs = pairs.select("q", "node", product.alias("score"))
    near = pairs.join(few.select("node", "vec_id"), "node")
    # one more than asked for, as a query's own row goes
    near = near.withColumn("r", F.expr("row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id)")).where(f"r <= {k + 1}")
    # many keys may ask with one vector
    out = split_join(asked, near.select("q", "node", "vec_id", "score"), ["q"])
    rank = F.expr("row_number() OVER (PARTITION BY query_id, q ORDER BY score DESC, vec_id)")
    out = out.where("query_id <> vec_id OR node <> q").withColumn("rank", rank.cast("int")).where(f"rank <= {k}")
    return out.select("query_id", "rank", "vec_id", "score")
