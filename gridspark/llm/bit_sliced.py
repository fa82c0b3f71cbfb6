"""Exact top-k search by integer inner product over a bit-sliced index.

Vectors are quantised to integers and dealt to shards of bounded size. In a shard, attribute ``j`` becomes a
few bitmaps over the rows, one for each binary digit of its distance from the shard's least value of ``j``. The
scores of all rows for one query are built from those bitmaps alone: a component of the query is a sum of signed
powers of two, so each of its digits adds the attribute's bitmaps, shifted, into columns of equal weight (a
negative digit adds their complements and a constant). Carry-save adders shrink every column to one bitmap, the
digit slices of the score. The top rows are then taken from the most significant slice downward: rows with the
digit set go first while they are no more than ``k``. Rows that agree in every slice are the boundary; the
smallest ids of those fill up.

Nothing is approximate: the slices hold whole scores at any width. A (shard, block of queries) is one group, at
most ``SHARD_ROWS`` rows against about ``BLOCK_QUERIES`` queries, and gives ``k`` rows a query; a window with a
group limit keeps the best of all shards.

Cases: vectors that are null or hold a null or non-finite component take no part, nor do rows without an id;
empty vectors do, as do zero ones. Vectors of different lengths never meet. A row that repeats both id and vector
counts once; rows of one id never answer each other. Equal scores go to the smaller id; answers that repeat id and
score too, for an id with several vectors, keep both. Components beyond the range of a long saturate there, and so
does a returned score. With fewer candidates than ``k`` all come back. Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.common import Run, read

SHARD_ROWS, BLOCK_QUERIES = 1 << 15, 256
_LONG = (1 << 63) - 1


@lru_cache(maxsize=1 << 16)
def signed_digits(value: int) -> tuple[tuple[int, int], ...]:
    """(exponent, sign) of the powers of two that add up to ``value``, no two exponents adjacent."""
    digits, exponent = [], 0
    while value:
        if value & 1:
            sign = 2 - (value & 3)
            digits.append((exponent, sign))
            value -= sign
        value >>= 1
        exponent += 1
    return tuple(digits)


class SlicedIndex:
    """Bitmaps of one shard: for attribute j the slices ``first[j] .. first[j] + widths[j] - 1``, and their complements."""

    def __init__(self, slices: np.ndarray, base: list[int], widths: list[int], rows: int):
        self.rows, self.base, self.widths = rows, base, widths
        self.first = np.concatenate(([0], np.cumsum(widths, dtype=np.int64))).tolist()
        self.total = self.first[-1]
        self.slices = np.concatenate((slices, ~slices))
        self.all = bitmap(np.ones(rows, bool))

    @classmethod
    def build(cls, values: np.ndarray) -> SlicedIndex:
        """From a matrix of 64-bit integers, one row a vector."""
        rows, found, base, widths = len(values), [], [], []
        for column in values.T:
            base.append(int(column.min()))
            above = column.astype(np.uint64) - np.uint64(base[-1] % (1 << 64))  # below 2^64, whatever the range
            widths.append(int(above.max()).bit_length())
            found += [bitmap((above >> np.uint64(b)) & np.uint64(1)) for b in range(widths[-1])]
        words = -(-rows // 64)
        return cls(np.array(found, np.uint64).reshape(len(found), words), base, widths, rows)

    def scores(self, query: list[int]) -> tuple[list[np.ndarray], int]:
        """Digit slices of all rows' scores, least significant first, and the constant that is added to each."""
        columns, constant = defaultdict(list), 0
        for j, value in enumerate(query):
            constant += value * self.base[j]
            first, width = self.first[j], self.widths[j]
            for exponent, sign in signed_digits(value) if width else ():
                at = first if sign > 0 else first + self.total
                for b in range(width):
                    columns[exponent + b].append(at + b)
                if sign < 0:  # -u is the complement of u, less all its digits
                    constant -= ((1 << width) - 1) << exponent
        out, carried, weight, last = [], [], 0, max(columns, default=-1)
        while weight <= last or carried:
            column = [self.slices[columns[weight]]] if columns.get(weight) else []
            bits, carried = _shrink(column + carried)
            out.append(bits if bits is not None else np.zeros_like(self.all))
            weight += 1
        return out, constant

    def top(self, query: list[int], k: int, without: np.ndarray | None = None) -> tuple[np.ndarray, list[int]]:
        """The ``k`` rows of largest score (earlier rows first where scores agree) and their scores."""
        slices, constant = self.scores(query)
        open_, sure, have = self.all if without is None else self.all & ~without, np.zeros_like(self.all), 0
        for digit in reversed(slices):
            with_digit = open_ & digit
            n = have + int(np.bitwise_count(with_digit).sum())
            if n > k:
                open_ = with_digit
            else:
                sure, have, open_ = sure | with_digit, n, open_ & ~digit
            if have == k:
                break
        rows = np.concatenate((members(sure), members(open_)[: k - have]))
        scores = [constant] * len(rows)
        for weight, digit in enumerate(slices):
            for i in np.flatnonzero((digit[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)):
                scores[i] += 1 << weight
        return rows, scores


def _shrink(parts: list[np.ndarray]) -> tuple[np.ndarray | None, list[np.ndarray]]:
    """Bitmaps of one weight become one; the others go on as bitmaps of twice the weight."""
    if not parts:
        return None, []
    stack, carried = np.concatenate(parts), []
    while len(stack) > 2:
        n = len(stack) // 3
        a, b, c = stack[:n], stack[n : 2 * n], stack[2 * n : 3 * n]
        half = a ^ b
        carried.append((a & b) | (half & c))
        stack = np.concatenate((half ^ c, stack[3 * n :])) if len(stack) > 3 * n else half ^ c
    if len(stack) == 2:
        carried.append(stack[:1] & stack[1:])
        stack = stack[:1] ^ stack[1:]
    return stack[0], carried


def bitmap(bits: np.ndarray) -> np.ndarray:
    """64 rows a word, the first row in the lowest bit."""
    packed = np.packbits(bits.astype(bool), bitorder="little")
    return np.concatenate((packed, np.zeros(-len(packed) % 8, np.uint8))).view("<u8")


def members(bits: np.ndarray) -> np.ndarray:
    """The rows of a bitmap, ascending."""
    words = np.flatnonzero(bits)
    set_ = np.unpackbits(bits[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, bit = np.nonzero(set_)
    return words[word] * 64 + bit


def _matrix(table: pa.Table) -> np.ndarray:
    values = table.column("values").combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1 if len(values.flatten()) else 0)


_INDEX = "shard int, dim int, ids binary, base array<long>, widths array<int>, slices binary"


def _index(table: pa.Table) -> pa.Table:
    """One row per shard: ids in ascending order and the bitmaps of their vectors."""
    table = table.sort_by("vec_id")
    index = SlicedIndex.build(_matrix(table))
    return pa.table({
        "shard": table.column("shard").slice(0, 1), "dim": table.column("dim").slice(0, 1),
        "ids": pa.array([table.column("vec_id").to_numpy().tobytes()], pa.binary()),
        "base": pa.array([index.base], pa.list_(pa.int64())), "widths": pa.array([index.widths], pa.list_(pa.int32())),
        "slices": pa.array([index.slices[: index.total].tobytes()], pa.binary()),
    })


def _search(k: int):
    schema = pa.schema([("mark", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()),
                        ("high", pa.string())])

    def run(queries: pa.Table, index: pa.Table) -> pa.Table:
        if not queries.num_rows or not index.num_rows:
            return schema.empty_table()
        shard = index.slice(0, 1).to_pylist()[0]
        ids = np.frombuffer(shard["ids"], np.int64)
        words = -(-len(ids) // 64)
        slices = np.frombuffer(shard["slices"], np.uint64).reshape(sum(shard["widths"]), words)
        sliced = SlicedIndex(slices, shard["base"], shard["widths"], len(ids))
        out = []
        for mark, own, values in zip(queries.column("mark").to_pylist(), queries.column("vec_id").to_pylist(),
                                     queries.column("values").to_pylist(), strict=True):
            low, high = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
            own_rows = np.zeros(len(ids), bool)
            own_rows[low:high] = True
            rows, scores = sliced.top(values, k, bitmap(own_rows) if high > low else None)
            for row, score in zip(rows.tolist(), scores, strict=True):
                clipped = max(-_LONG - 1, min(_LONG, score))
                # Scores beyond a long are still told apart, by a text that sorts like the number.
                out.append((mark, own, int(ids[row]), clipped, f"{score + (1 << 200):070d}" if abs(clipped) >= _LONG else ""))
        columns = list(zip(*out, strict=True)) or [[]] * len(schema)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, values): floor(scale * x) of each component of the usable vectors, each row once."""
    good = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & good).select(
        F.col("vec_id").cast("long"), F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("values")
    ).distinct()


def top_k(rows: DataFrame, queries: DataFrame, run: Run, *, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the ``k`` rows of largest integer inner product
    among ``rows``, without its own id. Both have vec_id and values, an array of longs."""
    rows = run.write(rows.withColumn("dim", F.size("values")), "rows")
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    index = run.write(
        rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "values"), F.lit(shards)).cast("int"))
        .groupBy("shard", "dim").applyInArrow(_index, _INDEX), "index")
    asked = run.write(queries.withColumns({"dim": F.size("values"), "mark": F.xxhash64("values")}), "queries")
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    spread = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "mark"), F.lit(blocks)).cast("int")).withColumn("shard", every(shards))
    keys = ["shard", "dim", "block"]
    found = spread.groupBy(keys).cogroup(index.withColumn("block", every(blocks)).groupBy(keys)).applyInArrow(
        _search(k), "mark long, query_id long, vec_id long, score long, high string")
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), F.desc("high"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``embeddings``: the 10 highest scores of every row whose id is divisible by 100."""
    run = Run(spark, "op13")
    rows = run.write(quantised(read(spark, sf_dir, "embeddings"), 1024), "quantised")
    return top_k(rows, rows.where("vec_id % 100 = 0"), run)


OP13_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS a
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, q.a AS qa, c.vec_id,
         list_sum(list_transform(range(1, len(q.a) + 1), lambda i: q.a[i] * c.a[i]))::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.a) = len(c.a)
), ranked AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY query_id, qa ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
