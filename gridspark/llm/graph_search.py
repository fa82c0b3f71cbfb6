"""Nearest neighbours by a robust-pruned directed graph in every shard.

Vectors are dealt to shards of bounded size by a hash. In a shard, greedy searches over the graph so far
propose neighbours for each vector, relaxed distance pruning keeps a diverse few of them, and the reverse
edges are added and pruned likewise. A query is searched in every shard by beam search; the beams are rescored
in double precision on the original vectors and merged. Largest inner products are nearest neighbours after
one more component levels all norms, so the graph is built on distances.

Equal vectors are one node that names its smallest ids, as many as a result can hold, so copies neither crowd
the graph nor get lost. Shards of a few vectors are compared exhaustively. Queries meet the shards in blocks:
the group of a (shard, block) holds one shard and one block, however large the table.

Cases: vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do rows
without an id. Repeated rows count once. Vectors of different lengths never meet. With fewer candidates than
``k`` all come back. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.common import Run, read

SHARD_ROWS, BLOCK_ROWS = 4096, 2048
DEGREE, BUILD_BEAM, BEAM, ALPHA = 28, 56, 72, 1.2
EXPAND = 4  # nodes of a beam that are expanded at a time
BATCH = 512
EXHAUSTIVE = 256  # shards of at most so many vectors are scanned


def _products(vectors: np.ndarray, queries: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.matmul(vectors[at], queries[:, :, None])[:, :, 0]


def beam_search(vectors: np.ndarray, edges: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nodes of largest inner product that greedy walks find, for all queries at once, with their
    products; -1 where there are fewer."""
    n, b = len(vectors), len(queries)
    beam = min(beam, n)
    seen = np.zeros((b, n + 1), bool)  # the last column stands for "no edge"
    seen[:, -1] = True
    ids = np.full((b, beam), -1)
    values = np.full((b, beam), -np.inf, np.float32)
    starts = starts[:beam]
    ids[:, : len(starts)], seen[:, starts] = starts, True
    values[:, : len(starts)] = queries @ vectors[starts].T
    done = ids < 0
    rows = np.arange(b)
    while len(rows):
        open_ = np.where(done[rows], -np.inf, values[rows])
        rows = rows[np.isfinite(open_.max(1))]
        if not len(rows):
            break
        open_ = np.where(done[rows], -np.inf, values[rows])
        width = min(EXPAND, beam)
        pick = np.argpartition(-open_, width - 1, axis=1)[:, :width]
        node = np.where(np.isfinite(np.take_along_axis(open_, pick, 1)), ids[rows[:, None], pick], -1)
        done[rows[:, None], pick] = True
        near = np.where(node[:, :, None] >= 0, edges[node], -1).reshape(len(rows), -1)
        near = np.sort(near, axis=1)
        fresh = ~seen[rows[:, None], near]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[rows[:, None], near] = True
        value = np.where(fresh, _products(vectors, queries[rows], near), -np.inf)
        all_ids = np.concatenate((ids[rows], np.where(fresh, near, -1)), axis=1)
        all_values = np.concatenate((values[rows], value), axis=1)
        all_done = np.concatenate((done[rows], ~fresh), axis=1)
        best = np.argpartition(-all_values, beam - 1, axis=1)[:, :beam]
        ids[rows], values[rows] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_values, best, 1)
        done[rows] = np.take_along_axis(all_done, best, 1)
    return ids, values


def robust_prune(vectors: np.ndarray, points: np.ndarray, candidates: np.ndarray, alpha: float) -> np.ndarray:
    """Up to DEGREE diverse neighbours of each point: the nearest candidate stays and drops those that are
    ``alpha`` times nearer to it than to the point; then the next."""
    candidates = np.sort(candidates, axis=1)
    bad = (candidates < 0) | (candidates == points[:, None])
    bad[:, 1:] |= candidates[:, 1:] == candidates[:, :-1]
    x = vectors[candidates]
    own = vectors[points]
    squares = (x * x).sum(2)
    far = np.where(bad, np.inf, squares + (own * own).sum(1)[:, None] - 2 * np.matmul(x, own[:, :, None])[:, :, 0])
    between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
    out, alive, rows = np.full((len(points), DEGREE), -1), far.copy(), np.arange(len(points))
    for k in range(DEGREE):
        pick = alive.argmin(1)
        on = np.isfinite(alive[rows, pick])
        if not on.any():
            break
        out[on, k] = candidates[rows, pick][on]
        alive[alpha * alpha * between[rows, pick] <= far] = np.inf
        alive[rows, pick] = np.inf
    return out


def build(vectors: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Edges (n, DEGREE; -1 for none) and start nodes of a graph over the vectors."""
    n, rng = len(vectors), np.random.default_rng(seed)
    norms = (vectors * vectors).sum(1)
    level = np.sqrt(np.maximum(norms.max() - norms, 0))
    points = np.concatenate((vectors, level[:, None]), axis=1).astype(np.float32)
    center = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    starts = np.unique(np.concatenate(([center], rng.integers(0, n, 7))))
    edges = np.full((n, DEGREE), -1)
    edges[:, : DEGREE // 2] = rng.integers(0, n, (n, DEGREE // 2))
    # All points have one length, so the nearest are those of the largest inner product.
    for alpha in (1.0, ALPHA):
        order = rng.permutation(n)
        for low in range(0, n, BATCH):
            own = order[low : low + BATCH]
            found, _ = beam_search(points, edges, starts, points[own], BUILD_BEAM)
            edges[own] = robust_prune(points, own, np.concatenate((found, edges[own]), axis=1), alpha)
            target, source = edges[own].ravel(), np.repeat(own, DEGREE)
            target, source = target[target >= 0], source[target >= 0]
            by = np.argsort(target, kind="stable")
            target, source = target[by], source[by]
            node, first, counts = np.unique(target, return_index=True, return_counts=True)
            place = np.arange(len(target)) - np.repeat(first, counts)
            # A node with very many new edges takes them in turns, so that the matrices stay small.
            for turn in range(0, int(counts.max(initial=0)), DEGREE):
                on = (place >= turn) & (place < turn + DEGREE)
                touched, which = np.unique(target[on], return_inverse=True)
                came = np.full((len(touched), DEGREE), -1)
                came[which, place[on] - turn] = source[on]
                edges[touched] = robust_prune(points, touched, np.concatenate((edges[touched], came), axis=1), alpha)
    return edges, starts


def _index(table: pa.Table) -> pa.Table:
    """One row per shard: vectors, ids, edges and start nodes, as bytes."""
    size = table.column("dim")[0].as_py()
    vectors = table.column("embedding").combine_chunks().flatten().to_numpy().reshape(-1, size)
    ids = table.column("ids").combine_chunks()
    edges, starts = build(vectors.astype(np.float32)) if len(vectors) > EXHAUSTIVE else (np.zeros((0, 0), int), np.zeros(0, int))
    return pa.table({
        "shard": table.column("shard").slice(0, 1), "dim": table.column("dim").slice(0, 1),
        "vectors": pa.array([vectors.tobytes()], pa.binary()), "ids": pa.array([ids.flatten().to_numpy().tobytes()], pa.binary()),
        "counts": pa.array([ids.value_lengths().to_numpy().astype(np.int64).tobytes()], pa.binary()),
        "edges": pa.array([edges.astype(np.int32).tobytes()], pa.binary()),
        "starts": pa.array([starts.astype(np.int32).tobytes()], pa.binary()),
    })


def _search(k: int, beam: int):
    schema = pa.schema([("query", pa.int64()), ("mark", pa.int64()), ("vec_ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])

    def run(queries: pa.Table, index: pa.Table) -> pa.Table:
        if not queries.num_rows or not index.num_rows:
            return schema.empty_table()
        row = index.slice(0, 1).to_pylist()[0]
        size = row["dim"]
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, size)
        ids, counts = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["counts"], np.int64)
        edges, starts = np.frombuffer(row["edges"], np.int32), np.frombuffer(row["starts"], np.int32)
        asked = queries.column("embedding").combine_chunks().flatten().to_numpy().reshape(-1, size)
        small, first, out_ids, out_scores = vectors.astype(np.float32), np.cumsum(counts) - counts, [], []
        for low in range(0, len(asked), BATCH):
            some = asked[low : low + BATCH]
            if len(edges):
                found, _ = beam_search(small, edges.reshape(len(vectors), -1), starts, some.astype(np.float32), beam)
            else:
                found = np.broadcast_to(np.arange(len(vectors)), (len(some), len(vectors)))
            exact = np.einsum("qnd,qd->qn", vectors[found], some)
            for nodes, scores in zip(found, exact, strict=True):
                scores, nodes = scores[nodes >= 0], nodes[nodes >= 0]
                take = np.concatenate([ids[first[i] : first[i] + counts[i]] for i in nodes])
                score = np.repeat(scores, counts[nodes])
                best = np.lexsort((take, -score))[:k]
                out_ids.append(take[best])
                out_scores.append(score[best])
        return pa.table([queries.column("query"), queries.column("mark"), pa.array(out_ids, pa.list_(pa.int64())),
                         pa.array(out_scores, pa.list_(pa.float64()))], schema=schema)

    return run


def nearest(vectors: DataFrame, queries: DataFrame, run: Run, *, k: int = 20, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its ``k`` nearest rows of ``vectors`` by inner
    product, without itself. Both have vec_id and embedding."""
    good = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    usable = lambda df: (
        df.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(F.col("vec_id").isNotNull() & good).distinct())
    # The smallest ids of equal vectors, one more than k since a query leaves out its own row.
    order = Window.partitionBy("embedding").orderBy("vec_id")
    first = usable(vectors).withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    nodes = run.write(first.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "nodes")
    shards = max(1, -(-nodes.count() // SHARD_ROWS))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int")).withColumn("dim", F.size("embedding"))
    index = run.write(
        dealt.groupBy("shard", "dim").applyInArrow(
            _index, "shard int, dim int, vectors binary, ids binary, counts binary, edges binary, starts binary"),
        "index",
    )
    asking = run.write(usable(queries), "queries").withColumn("mark", F.xxhash64("embedding"))
    asked = run.write(asking.groupBy("embedding", "mark").agg(F.min("vec_id").alias("query")), "asked")
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    spread = asked.select(
        "query", "mark", "embedding", F.size("embedding").alias("dim"), F.pmod("mark", F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    keys = ["shard", "dim", "block"]
    found = spread.groupBy(keys).cogroup(
        index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).groupBy(keys)
    ).applyInArrow(_search(k + 1, beam), "query long, mark long, vec_ids array<long>, scores array<double>")
    pairs = found.select("query", "mark", F.explode(F.arrays_zip("vec_ids", "scores")).alias("p")).select(
        "query", "mark", F.col("p.vec_ids").alias("vec_id"), F.col("p.scores").alias("score"))
    by = Window.partitionBy("query", "mark").orderBy(F.desc("score"), "vec_id")
    best = pairs.withColumn("n", F.row_number().over(by)).where(F.col("n") <= k + 1)
    lists = run.write(best.groupBy("query", "mark").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("best")), "best")
    asked_by = asking.join(asked.select("query", "mark", "embedding"), ["embedding", "mark"]).select("vec_id", "query", "mark")
    answered = asked_by.join(lists, ["query", "mark"]).select(
        F.col("vec_id").alias("query_id"), F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("vec_id")), 1, k).alias("best"))
    return answered.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``embeddings``: the 20 nearest rows of every row whose id is divisible by 20."""
    vectors = read(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), Run(spark, "op5"))
