import numpy as np
import pytest

from gridspark.llm import graph_search
from gridspark.llm.common import Run

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def brute(rows, queries, k=20):
    def usable(r):
        return r[0] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    table = {(r[0], tuple(np.float32(r[1]).astype(float))) for r in rows if usable(r)}
    out = {}
    for q in {(r[0], tuple(np.float32(r[1]).astype(float))) for r in queries if usable(r)}:
        found = sorted((-float(np.dot(q[1], v)), i) for i, v in table if i != q[0] and len(v) == len(q[1]))[:k]
        out[q[0]] = [(i, -s) for s, i in found]
    return {q: f for q, f in out.items() if f}


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def test_recall_on_the_sample_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = answers(graph_search.op5_nearest_neighbours(spark, "/root/testdata/sf0.1"))
    wanted = brute(rows, [r for r in rows if r[0] % 20 == 0])
    assert sorted(got) == sorted(wanted)
    right = [len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) / len(wanted[q]) for q in wanted]
    assert np.mean(right) >= 0.97, np.mean(right)
    exact = {q: dict(brute(rows, [r for r in rows if r[0] == q], len(rows))[q]) for q in list(wanted)[:5]}
    assert all(abs(s - exact[q][i]) < 1e-12 for q in exact for i, s in got[q])


def test_small_shards_are_exact_and_odd_rows_take_no_part(spark, monkeypatch):
    monkeypatch.setattr(graph_search, "SHARD_ROWS", 50)
    monkeypatch.setattr(graph_search, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 5)], "x", 1) for i in range(200)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, -1.0, 3.0], None, None) for i in range(60)]  # one very common vector
    rows += [(2000, None, "x", 1), (2020, [], "x", 1), (2040, [0.0] * 5, "x", 1), (2060, [1.0, None, 1.0, 1.0, 1.0], "x", 1),
             (2080, [float("nan")] * 5, "x", 1), (2100, [float("inf"), 1.0, 1.0, 1.0, 1.0], "x", 1), (None, [1.0] * 5, "x", 1),
             (2120, [1.0, 2.0], "x", 1), (2140, [3.0, -2.0], "x", 1), (20, rows[20][1], "y", 2), (2160, [1.0, 1.0, 1.0], "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = answers(graph_search.nearest(docs, docs.where("vec_id % 20 = 0"), Run(spark, "test")))
    assert got == brute(rows, [r for r in rows if r[0] is not None and r[0] % 20 == 0])


def test_graph_keeps_norms_apart():
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((1500, 16)) * rng.uniform(0.2, 3, (1500, 1))).astype(np.float32)
    edges, starts = graph_search.build(vectors)
    assert edges.shape == (1500, graph_search.DEGREE) and edges.max() < 1500
    queries = rng.standard_normal((50, 16)).astype(np.float32)
    found, _ = graph_search.beam_search(vectors, edges, starts, queries, graph_search.BEAM)
    best = np.argsort(-(queries @ vectors.T), axis=1)[:, :20]
    assert np.mean([len(set(f) & set(b)) / 20 for f, b in zip(found.tolist(), best.tolist())]) > 0.95


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0], None, None)], [(0, [1.0, 2.0], None, None), (1, [2.0, 2.0], None, None)]])
def test_tiny_tables(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = answers(graph_search.nearest(docs, docs.where("vec_id % 20 = 0"), Run(spark, "test")))
    assert got == brute(rows, rows[:1])
