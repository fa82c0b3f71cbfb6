"""Ranked lexical search by an Aho-Corasick scan of the texts, without an index of the documents.

The distinct terms of all items become one automaton, broadcast to the executors. Every term is guarded by a
blank on either side; a text is scanned with its A-Z lower-cased and all that is no part of a term turned into
blanks, so a match is always a whole term. One scan counts how often each term occurs in each document (and how
many terms the document has at all); outputs of the automaton are numbers of terms, which map to the items that
hold them. Document frequencies and lengths are sums over that table. A second pass turns the counts into
scores, adds them up per item, and keeps the best of a task for each item; a window keeps the best of those.

What is broadcast is bounded: items are taken in blocks of at most ``BLOCK_BYTES`` of term bytes (one item alone
may be larger), one scan a block. The items are drawn to the driver block by block, never all at once. Counts
grow with the documents and stay in a written table. A document is one row throughout, and no group holds more
than the best rows of each task.

Cases: a null or empty text has no term; such a document counts in nothing, such an item has no answer. Repeated
rows of documents are documents each, and all may be answers. Repeated rows of items, also of one ``item_id``, are
items each. A null ``doc_id`` comes after all others where scores agree. Very long texts are scanned whole. Extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.common import Run, read
from gridspark.llm.words import arrow_bytes, slices

#: Bytes of distinct terms in one automaton; a byte takes some 60 in memory.
BLOCK_BYTES = 512 << 10
#: Cells of the documents x items matrix that is added up at a time.
CELLS = 1 << 21

_BLANK = 32
#: What a byte of a text is scanned as: digits, letters (lower-cased) and all beyond ASCII are parts of terms.
_SCANNED = np.full(256, _BLANK, np.uint8)
_SCANNED[48:58], _SCANNED[97:123], _SCANNED[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(128, 256)
_SCANNED[65:91] = np.arange(97, 123)


def terms_of(text: str | None) -> list[str]:
    """The terms of a text, in order."""
    return [t.decode() for t in (text or "").encode().translate(_SCANNED.tobytes()).split()]


class Scanner:
    """A boundary-guarded automaton of terms; counts their occurrences in texts."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for number, term in enumerate(terms):
            self.automaton.add_word(f" {term} ", number)
        self.automaton.make_automaton()

    def count(self, scanned: str) -> list[tuple[int, int]]:
        """(term number, occurrences) in order; ``scanned`` begins and ends with a blank."""
        return sorted(Counter(map(itemgetter(1), self.automaton.iter(scanned))).items())


def _scan(scanner):
    """Batches of (doc_id, text) to one row per document that has terms: its length and the counts of known terms."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            data, offsets = arrow_bytes(batch.column("text"))
            scanned = _SCANNED[data]
            inside = np.concatenate((scanned != _BLANK, [False]))
            begins = inside[:-1] & ~np.concatenate(([False], inside[:-2])) if len(data) else inside[:-1]
            first = offsets[:-1][offsets[:-1] < len(data)]
            begins[first] = inside[first]  # a document may start right after another one's last term
            lengths = np.diff(np.concatenate(([0], np.cumsum(begins)))[offsets])
            rows = np.flatnonzero(lengths)
            counts = [scanner.value.count(f" {scanned[offsets[i]:offsets[i + 1]].tobytes().decode()} ") for i in rows]
            yield pa.record_batch([
                batch.column("doc_id").take(pa.array(rows)), pa.array(lengths[rows]),
                pa.array([[t for t, _ in c] for c in counts], pa.list_(pa.int32())),
                pa.array([[f for _, f in c] for c in counts], pa.list_(pa.int64())),
            ], schema=schema)

    return run


class Postings:
    """For each term number, the items that hold it and its weight there times its repeats."""

    def __init__(self, items: list[tuple[int, dict[str, int]]], numbers: dict[str, int], weights: list[int]):
        self.ids = [i for i, _ in items]
        held = sorted((numbers[t], at, n * weights[numbers[t]]) for at, (_, terms) in enumerate(items) for t, n in terms.items())
        term, self.items, self.weights = np.array(held, np.int64).reshape(-1, 3).T
        self.first = np.searchsorted(term, np.arange(len(numbers) + 1))


def _best(found: np.ndarray, k: int) -> np.ndarray:
    """Of rows (item, score, null id, id), the first ``k`` of each item, best first."""
    found = found[np.lexsort((found[:, 3], found[:, 2], -found[:, 1], found[:, 0]))]
    starts = np.flatnonzero(np.concatenate(([True], found[1:, 0] != found[:-1, 0]))) if len(found) else np.zeros(0, int)
    place = np.arange(len(found)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(found)]))))
    return found[place < k]


def _score(postings, total: int, terms_total: int, k: int):
    """Batches of counts to the task's ``k`` best documents of each item."""
    schema = pa.schema([("item", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Postings = postings.value
        best, least = np.zeros((0, 4), np.int64), np.ones(len(held.ids), np.int64)
        step = max(1, CELLS // len(held.ids))
        for batch in (whole.slice(i, step) for whole in batches for i in range(0, whole.num_rows, step)):
            ids, terms = batch.column("doc_id"), batch.column("terms")
            n = batch.column("n").to_numpy()
            counts = terms.value_lengths().to_numpy()
            doc = np.repeat(np.arange(len(n)), counts)
            term, tf = terms.flatten().to_numpy(), batch.column("tfs").flatten().to_numpy()
            m = 75 + 25 * n * total // terms_total
            gain = 10**9 * tf // (1000 * tf + 12 * m[doc])
            scores = np.zeros((len(n), len(held.ids)), np.int64)
            by = np.argsort(term, kind="stable")
            edges = np.flatnonzero(np.diff(term[by], prepend=-1, append=-1))
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                own, t = by[low:high], term[by[low]]
                to = slice(held.first[t], held.first[t + 1])
                scores[np.ix_(doc[own], held.items[to])] += np.outer(gain[own], held.weights[to])
            row, item = np.nonzero(scores >= least)
            nulls = ids.is_null().to_numpy(zero_copy_only=False)
            names = ids.fill_null(0).to_numpy()
            best = _best(np.concatenate((best, np.stack((item, scores[row, item], nulls[row], names[row]), axis=1))), k)
            full = np.flatnonzero(np.bincount(best[:, 0], minlength=len(held.ids)) == k)
            at, lowest = np.unique(best[::-1, 0], return_index=True)  # the last row of each item, from the end
            least[full] = best[::-1][lowest[np.isin(at, full)], 1]
        yield pa.record_batch([
            pa.array(best[:, 0], pa.int32()), pa.array([held.ids[i] for i in best[:, 0]], pa.int64()),
            pa.array(best[:, 3], mask=best[:, 2].astype(bool)), pa.array(best[:, 1]),
        ], schema=schema)

    return run


def blocks(items: DataFrame, limit: int | None = None) -> Iterator[list[tuple[int, dict[str, int]]]]:
    """Items as (item_id, repeats of each term), in blocks of bounded term bytes; items without a term are left out."""
    block, size, limit = [], 0, limit or BLOCK_BYTES
    for row in items.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        terms = Counter(terms_of(row["text"]))
        own = sum(len(t.encode()) + 8 for t in terms)
        if block and size + own > limit:
            yield block
            block, size = [], 0
        if terms:
            block.append((row["item_id"], dict(terms)))
            size += own
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, run: Run, *, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its ``k`` documents of highest score above 0."""
    spark, parts = run.spark, []
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    for b, block in enumerate(blocks(items)):
        numbers = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}))}
        scanner = spark.sparkContext.broadcast(Scanner(list(numbers)))
        counts = run.write(texts.mapInArrow(_scan(scanner), "doc_id long, n long, terms array<int>, tfs array<long>"), f"counts-{b}")
        total, terms_total = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not total:
            continue
        # One number per term of the block, so the block bounds what comes back.
        holders = dict(counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        weights = [math.floor(1000 * math.log((2 * total + 2) / (2 * holders.get(i, 0) + 1))) for i in range(len(numbers))]
        postings = spark.sparkContext.broadcast(Postings(block, numbers, weights))
        found = run.write(
            counts.where(F.size("terms") > 0).mapInArrow(_score(postings, total, terms_total, k), "item int, item_id long, doc_id long, score long"),
            f"found-{b}")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        parts.append(ranked.select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` for every item of ``benchmark``: the 20 documents of highest score."""
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), Run(spark, "op12"))


_SQL_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
OP12_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, {_SQL_TERMS} AS terms FROM documents
), s AS (
  SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0
), tf AS (
  SELECT row, doc_id, n, term, count(*) AS tf
  FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL
), i AS (
  SELECT item, item_id, term, count(*) AS repeats
  FROM (SELECT row_number() OVER () AS item, item_id, unnest({_SQL_TERMS}) AS term FROM benchmark) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, s WHERE term IN (SELECT term FROM i) GROUP BY term
), scored AS (
  SELECT item, item_id, row, doc_id,
         sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN tf USING (term), s GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
