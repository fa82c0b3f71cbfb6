"""Repeated passages by difference-cover anchors.

Two equal runs of ``window`` words, wherever they start in their documents, hold an equal run of
``window - period + 1`` words that starts at a cover position (modulo ``period``) in both, since every
difference modulo the period is a difference of two cover positions. So only runs at cover positions are
hashed at first (anchors). Where an anchor occurs twice, the windows around it are extended to their full
length and hashed again, and the earliest start of each is found.

Documents are dealt to chunks of some megabytes, in a table bucketed by chunk that each step reads
without a shuffle. A step sends each distinct hash once per chunk to the bucket of its hash and gets one
answer back per chunk, so a passage that a third of all documents share costs an entry per chunk, not per
occurrence, and no group holds pairs. Hashes of windows have 64 bits within their bucket; the number of
buckets grows with the data, so a bucket holds about a million at any size.

Cases: null texts have no words. A null ``doc_id`` counts as larger than all others. Rows that repeat a
``doc_id`` are one document with starts of their own: equal windows at equal starts of it are both
earliest. Texts shorter than a window lose nothing. Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.common import Run, read
from gridspark.llm.words import Words, ragged, slices, split_words, window_counts, windows

WINDOW = 20
#: Perfect difference covers: every remainder is a difference of two of the positions.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
PERIOD = 7
CHUNK_BYTES = 8 << 20
BUCKET_HASHES = 1_000_000
_LAST = np.iinfo(np.int64).max


class _Chunk:
    """The documents of one chunk in the order of their ids, and the hashes of their words and windows."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks().sort_by("doc_id")
        self.table, parts, first, hashes = table, [], [0], []
        for batch in table.to_batches():
            for part in slices(batch):
                words = split_words(part.column("text"))
                parts.append((part, words))
                first.extend(words.first[1:] + first[-1] - words.first[0])
                hashes.append(np.stack([words.hashes(0), words.hashes(1)]))
        self.parts, self.first = parts, np.array(first)
        self.hashes = np.concatenate(hashes, axis=1) if hashes else np.zeros((2, 0), np.uint64)
        ids = table.column("doc_id").to_numpy(zero_copy_only=False) if table.column("doc_id").null_count == 0 else \
            table.column("doc_id").fill_null(_LAST).to_numpy()
        self.ids = np.asarray(ids, np.int64)

    def windows(self, width: int, halves=(0,)) -> tuple[list[np.ndarray], np.ndarray]:
        """Hashes of the windows within documents, and their first words (numbered over the chunk)."""
        counts = window_counts(Words(None, None, None, self.first), width)
        at = ragged(self.first[:-1], counts)
        return [windows(self.hashes[h], width, h)[at] for h in halves], at

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, "right") - 1


def _anchors(chunk: _Chunk, window: int, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of the anchors of a chunk."""
    (hashes,), at = chunk.windows(window - period + 1)
    start = at - chunk.first[chunk.document(at)]
    on = np.isin(np.arange(period), COVERS[period])[start % period]
    return hashes[on], at[on]


def _place(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of an anchor and its 32-bit name there; a chance agreement only adds a candidate."""
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), hashes.astype(np.uint32)


def _cut(bucket: np.ndarray, columns: list[np.ndarray]):
    """Columns cut by bucket: (bucket, pieces); rows must be sorted by bucket."""
    edges = np.flatnonzero(np.diff(bucket)) + 1
    lows, highs = [0, *edges], [*edges, len(bucket)]
    for low, high in zip(lows, highs, strict=True):
        if high > low:
            yield int(bucket[low]), [c[low:high] for c in columns]


def _rows(rows: list[tuple], names: list[str]) -> pa.Table:
    types = {"chunk": pa.int64(), "bucket": pa.int64()}
    return pa.table({n: pa.array([r[i] for r in rows], types.get(n, pa.binary())) for i, n in enumerate(names)})


def _ask_anchors(window: int, period: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        number, chunk = table.column("chunk")[0].as_py(), _Chunk(table)
        bucket, name = _place(_anchors(chunk, window, period)[0], buckets)
        key, counts = np.unique(bucket.astype(np.uint64) << np.uint64(32) | name, return_counts=True)
        rows = [(b, number, n.tobytes(), np.packbits(m).tobytes()) for b, (n, m) in
                _cut((key >> np.uint64(32)).astype(np.int64), [key.astype(np.uint32), counts > 1])]
        return _rows(rows, ["bucket", "chunk", "names", "twice"])

    return run


def _answer_anchors(table: pa.Table) -> pa.Table:
    """Per chunk, its anchors that occur twice or more in all chunks."""
    names = [np.frombuffer(x, np.uint32) for x in table.column("names").to_pylist()]
    twice = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(n)) for x, n in zip(table.column("twice").to_pylist(), names)]
    name, index, counts = np.unique(np.concatenate(names), return_inverse=True, return_counts=True)
    counts = counts + np.bincount(index, np.concatenate(twice), len(name)).astype(int)
    again, at, rows, bucket = counts[index] > 1, 0, [], table.column("bucket")[0].as_py()
    for number, own in zip(table.column("chunk").to_pylist(), names, strict=True):
        hit = own[again[at : at + len(own)]]
        at += len(own)
        if len(hit):
            rows.append((number, bucket, hit.tobytes()))
    return _rows(rows, ["chunk", "bucket", "names"])


def _ask_windows(window: int, period: int, buckets: int, places: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["bucket", "chunk", "hashes", "docs", "starts"]
        if not table.num_rows or not answers.num_rows:
            return _rows([], names)
        number, chunk = table.column("chunk")[0].as_py(), _Chunk(table)
        wanted = np.sort(np.concatenate([
            np.frombuffer(x, np.uint32) | np.uint64(b) << np.uint64(32)
            for b, x in zip(answers.column("bucket").to_pylist(), answers.column("names").to_pylist(), strict=True)
        ]))
        hashes, at = _anchors(chunk, window, period)
        bucket, name = _place(hashes, buckets)
        shared = at[_among(bucket.astype(np.uint64) << np.uint64(32) | name, wanted)]
        # A window extends an anchor if it starts at most period - 1 words before it.
        near = np.zeros(chunk.hashes.shape[1] + 1, np.int64)
        np.add.at(near, np.maximum(shared - (period - 1), 0), 1)
        np.add.at(near, shared + 1, -1)
        (full, other), at = chunk.windows(window, (0, 1))
        on = np.cumsum(near)[at] > 0
        full, other, at = full[on], other[on], at[on]
        _, first = np.unique(full, return_index=True)
        first.sort()
        full, at, place = full[first], at[first], (other[first] % np.uint64(places)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        full, at, place = full[order], at[order], place[order]
        doc = chunk.document(at)
        rows = [(b, number, h.tobytes(), d.tobytes(), s.tobytes()) for b, (h, d, s) in
                _cut(place, [full, chunk.ids[doc], at - chunk.first[doc]])]
        return _rows(rows, names)

    return run


def _answer_windows(table: pa.Table) -> pa.Table:
    """Per chunk, its windows that start earlier in another chunk."""
    hashes, docs, starts = (
        [np.frombuffer(x, t) for x in table.column(c).to_pylist()]
        for c, t in (("hashes", np.uint64), ("docs", np.int64), ("starts", np.int64))
    )
    chunk = np.repeat(np.array(table.column("chunk").to_pylist()), [len(h) for h in hashes])
    every, doc, start = np.concatenate(hashes), np.concatenate(docs), np.concatenate(starts)
    order = np.lexsort((start, doc, every))
    every, chunk = every[order], chunk[order]
    later = np.concatenate(([False], every[1:] == every[:-1]))
    every, chunk = every[later], chunk[later]
    order = np.argsort(chunk, kind="stable")
    rows = [(c, h.tobytes()) for c, (h,) in _cut(chunk[order], [every[order]])]
    return _rows(rows, ["chunk", "hashes"])


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values if len(ordered) else np.zeros(len(values), bool)


def _kept_texts(part: pa.RecordBatch, words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each document, joined by one space."""
    lengths = np.where(kept, words.ends - words.starts + 1, 0)
    at = ragged(words.starts, lengths)
    data = np.concatenate((words.data, [32])).astype(np.uint8)[at]
    ends = np.cumsum(lengths)
    data[ends[kept] - 1] = 32
    ends = np.concatenate(([0], ends))[words.first]
    texts = data.tobytes()
    return pa.array([texts[a : max(a, b - 1)] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())


def _remove(window: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.binary())])

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        chunk = _Chunk(table)
        (full,), at = chunk.windows(window)
        earlier = [np.frombuffer(x, np.uint64) for x in answers.column("hashes").to_pylist()] if answers.num_rows else []
        later = _among(full, np.sort(np.concatenate(earlier))) if earlier else np.zeros(len(full), bool)
        # Within the chunk: windows stand in the order of document and start.
        order = np.argsort(full, kind="stable")
        new = np.concatenate(([True], full[order][1:] != full[order][:-1]))[: len(order)]
        head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        doc = chunk.document(at)
        start = at - chunk.first[doc]
        later[order] |= (chunk.ids[doc[order]] != chunk.ids[doc[head]]) | (start[order] != start[head])
        cover = np.zeros(chunk.hashes.shape[1] + 1, np.int64)
        cover[at[later]] += 1
        cover[at[later] + window] -= 1
        kept, low, out = np.cumsum(cover)[:-1] <= 0, 0, []
        for part, words in chunk.parts:
            n, own = words.counts(), kept[low : low + len(words.starts)]
            low += len(words.starts)
            gone = np.concatenate(([0], np.cumsum(~own)))[words.first]
            out.append(pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(np.diff(gone), pa.int64()),
                 _kept_texts(part, words, own)], schema=schema))
        return pa.Table.from_batches(out, schema)

    return run


def dedup_passages(docs: DataFrame, run: Run, *, window: int = WINDOW, period: int = PERIOD) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_text.

    A word goes if a window of ``window`` words covers it that also starts earlier: in a document of
    smaller id, or earlier in the same one.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, grams = -(-size // CHUNK_BYTES) or 1, size // 6
    buckets = max(2, grams * len(COVERS[period]) // period // BUCKET_HASHES)
    places = max(2, grams // 4 // BUCKET_HASHES)
    tasks = min(chunks, 50_000)
    name = f"chunks_{zlib.crc32(run.folder.encode()):08x}"
    dealt = docs.select(F.col("doc_id").cast("long"), "text", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk"))
    (
        dealt.repartition(tasks, "chunk").write.format("parquet").option("path", f"{run.folder}/chunks")
        .bucketBy(tasks, "chunk").sortBy("chunk").saveAsTable(name)
    )
    by_chunk = spark.table(name).groupBy("chunk")
    asked = by_chunk.applyInArrow(
        _ask_anchors(window, period, buckets), "bucket long, chunk long, names binary, twice binary"
    )
    anchors = run.write(
        asked.groupBy("bucket").applyInArrow(_answer_anchors, "chunk long, bucket long, names binary"), "anchors"
    )
    asked = by_chunk.cogroup(anchors.groupBy("chunk")).applyInArrow(
        _ask_windows(window, period, buckets, places),
        "bucket long, chunk long, hashes binary, docs binary, starts binary",
    )
    later = run.write(asked.groupBy("bucket").applyInArrow(_answer_windows, "chunk long, hashes binary"), "later")
    kept = by_chunk.cogroup(later.groupBy("chunk")).applyInArrow(
        _remove(window), "doc_id long, n_words long, n_removed long, kept_text binary"
    )
    return kept.withColumn("kept_text", F.col("kept_text").cast("string"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: what is left of each when passages of 20 words seen earlier are removed."""
    kept = dedup_passages(read(spark, sf_dir, "documents"), Run(spark, "op7"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), t AS (
  SELECT doc_id, len(words) AS n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d
), w AS (
  SELECT doc_id, i, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS window_text FROM t
), f AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY sha256(window_text) ORDER BY doc_id, i) > 1 AS again FROM w WHERE i + 19 <= n
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i, true AS gone FROM f WHERE again
), k AS (
  SELECT t.doc_id, count(*) AS n_words, count(gone) AS n_removed, string_agg(word, ' ' ORDER BY t.i) FILTER (WHERE gone IS NULL) AS kept
  FROM t LEFT JOIN covered USING (doc_id, i) GROUP BY t.doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
