import random

import numpy as np
from pyspark.sql import functions as F

from gridspark.llm import bit_sliced
from gridspark.llm.bit_sliced import OP13_SQL, SlicedIndex, op13_exact_top_k, quantised, signed_digits, top_k
from gridspark.llm.common import Run
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


def brute(rows, queries, k):
    """(query, rank, vec, score) by plain sums over all rows."""
    out = []
    for own, q in set(queries):
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in set(rows) if i != own and len(v) == len(q))
        out += [(own, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def answers(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_signed_digits_add_up():
    for value in (0, 1, -1, 7, -1024, 123456789, -(1 << 63), (1 << 63) - 1):
        digits = signed_digits(value)
        assert sum(s << e for e, s in digits) == value
        assert all(b[0] - a[0] > 1 for a, b in zip(digits, digits[1:], strict=False))


def test_slices_hold_whole_scores():
    rng = random.Random(3)
    for width in (0, 1, 5, 40, 62):
        values = [[rng.randint(-(1 << width), 1 << width) for _ in range(5)] for _ in range(130)]
        index = SlicedIndex.build(np.array(values, np.int64))
        query = [rng.randint(-(1 << width), 1 << width) for _ in range(5)]
        rows, scores = index.top(query, 200)
        assert dict(zip(rows.tolist(), scores, strict=True)) == {i: sum(a * b for a, b in zip(query, v, strict=True)) for i, v in enumerate(values)}


def test_equals_brute_force_over_shards_and_ties(spark, monkeypatch):
    monkeypatch.setattr(bit_sliced, "SHARD_ROWS", 100)
    monkeypatch.setattr(bit_sliced, "BLOCK_QUERIES", 7)
    rng = random.Random(5)
    # A third of the rows are one vector, so boundaries are large; few values make ties.
    rows = [(i, (1, -2, 3) if i % 3 == 0 else tuple(rng.randint(-3, 3) for _ in range(3))) for i in range(600)]
    df = spark.createDataFrame([(i, list(v)) for i, v in rows], "vec_id long, values array<long>")
    queries = [r for r in rows if r[0] % 20 == 0]
    assert answers(top_k(df, df.where("vec_id % 20 = 0"), Run(spark, "t"), k=10)) == brute(rows, queries, 10)


def test_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [0.5, -0.25]), (0, [0.5, -0.25]), (100, [0.0, 0.0]), (2, [0.5, None]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (None, [1.0, 1.0]), (6, [1.0]), (7, []), (200, []), (8, [1e300, -1e300]), (9, [-0.0001, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, values string, rank int")
    got = quantised(df, 1024)
    held = [(r.vec_id, tuple(r["values"])) for r in got.collect()]
    top = (1 << 63) - 1
    assert sorted(held) == [(0, (512, -256)), (6, (1024,)), (7, ()), (8, (top, -top - 1)), (9, (-1, 0)), (100, (0, 0)), (200, ())]
    wanted = [(q, r, i, max(-top - 1, min(top, s))) for q, r, i, s in brute(held, [h for h in held if h[0] % 100 == 0], 10)]
    assert answers(top_k(got, got.where("vec_id % 100 = 0"), Run(spark, "t"))) == wanted
    empty = got.limit(0)
    assert answers(top_k(empty, empty, Run(spark, "t"))) == []
    assert answers(top_k(got, empty, Run(spark, "t"))) == []


def test_query_equals_sql(spark):
    assert compare(op13_exact_top_k(spark, SF), SF, OP13_SQL) is None
