"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths run over fixed-length windows, each filter keeps its maximum
over a window, and a softmax gives the languages. The network is trained in numpy on the driver from a
bounded sample of labelled windows. A whole text is cut into windows without overlap, the last one padded,
and the text's scores are the mean of its windows' probabilities, weighted by their bytes.

Cases: a text that is null or has no letter is ``und`` with score 0, and so is every text if there is
nothing to learn from. Rows without an id or a language are not learned from; a row without an id is
reported as held out. With one known language every text with a letter gets it. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.common import Adam, read, remainder
from gridspark.llm.words import arrow_bytes, ragged, slices

UNKNOWN = "und"
LENGTH = 128  # bytes of a window
WIDTHS, FILTERS, EMBEDDED = (2, 3, 4), 12, 8
#: Bounds of the training sample: rows in all, rows of a language, and windows of a row.
SAMPLE_ROWS, SAMPLE_OF_LANGUAGE, SAMPLE_WINDOWS = 4000, 800, 3
EPOCHS, BATCH, RATE = 6, 64, 0.004
_AT_ONCE = 512  # windows of a product


@dataclass
class ByteNet:
    """Weights and languages. All filters are one matrix of the widest width, with zeros to the right."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str]) -> ByteNet:
        rng = np.random.default_rng(0)
        n = FILTERS * len(WIDTHS)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        net = cls(languages, {
            "bytes": normal(256, EMBEDDED, scale=0.5), "filters": normal(max(WIDTHS) * EMBEDDED, n, scale=0.25),
            "shift": np.zeros(n, np.float32), "out": normal(n, len(languages), scale=0.2),
            "bias": np.zeros(len(languages), np.float32),
        })
        net.weights["bytes"][0] = 0
        net.weights["filters"] *= net.mask()
        return net

    @staticmethod
    def mask() -> np.ndarray:
        """Which rows of the filter matrix each filter reaches."""
        rows = np.arange(max(WIDTHS) * EMBEDDED)[:, None] // EMBEDDED
        return (rows < np.repeat(WIDTHS, FILTERS)[None]).astype(np.float32)

    def patches(self, windows: np.ndarray) -> np.ndarray:
        embedded = self.weights["bytes"][windows].reshape(len(windows), -1)
        view = np.lib.stride_tricks.sliding_window_view(embedded, max(WIDTHS) * EMBEDDED, axis=1)
        return np.ascontiguousarray(view[:, ::EMBEDDED])

    def forward(self, windows: np.ndarray):
        w = self.weights
        patches = self.patches(windows)
        mapped = (patches.reshape(-1, patches.shape[2]) @ w["filters"]).reshape(len(windows), -1, len(w["shift"]))
        pooled = mapped.max(1) + w["shift"]
        hidden = np.maximum(pooled, 0)
        logits = hidden @ w["out"] + w["bias"]
        chances = np.exp(logits - logits.max(1, keepdims=True))
        return patches, mapped, hidden, chances / chances.sum(1, keepdims=True)

    def predict(self, windows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(windows[i : i + _AT_ONCE])[3] for i in range(0, len(windows), _AT_ONCE)])

    def gradients(self, windows: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        patches, mapped, hidden, chances = self.forward(windows)
        error = chances
        error[np.arange(len(windows)), wanted] -= 1
        error *= weight[:, None] / len(windows)
        back = (error @ w["out"].T) * (hidden > 0)
        at = mapped.argmax(1)  # the position that each filter kept
        chosen = patches[np.arange(len(windows))[:, None], at]
        per_patch = back[:, :, None] * w["filters"].T[None]
        grads = {"out": hidden.T @ error, "bias": error.sum(0), "shift": back.sum(0),
                 "filters": np.einsum("bfk,bf->kf", chosen, back) * self.mask(), "bytes": np.zeros_like(w["bytes"])}
        for j in range(max(WIDTHS)):
            byte = windows[np.arange(len(windows))[:, None], at + j]
            np.add.at(grads["bytes"], byte, per_patch[:, :, j * EMBEDDED : (j + 1) * EMBEDDED])
        grads["bytes"][0] = 0
        return grads


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fixed-length windows of texts, zero-padded; the text each is of, and its bytes."""
    counts = -(-np.diff(offsets) // LENGTH)
    text = np.repeat(np.arange(len(counts)), counts)
    starts = offsets[text] + ragged(np.zeros(len(counts), np.int64), counts) * LENGTH
    lengths = np.minimum(offsets[text + 1] - starts, LENGTH)
    at = starts[:, None] + np.arange(LENGTH)
    inside = np.arange(LENGTH) < lengths[:, None]
    return np.where(inside, data[np.minimum(at, len(data) - 1)] if len(data) else 0, 0), text, lengths


def _sample_windows(batches):
    """Some windows of each sampled text, spread over its length."""
    for batch in batches:
        for part in slices(batch):
            windows, text, _ = cut(*arrow_bytes(part.column("text")))
            counts = np.bincount(text, minlength=part.num_rows)
            take = np.minimum(counts, SAMPLE_WINDOWS)
            k = ragged(np.zeros(len(take), np.int64), take)
            of = np.repeat(np.arange(len(take)), take)
            chosen = windows[(np.cumsum(counts) - counts)[of] + (2 * k + 1) * counts[of] // (2 * take[of])]
            ends = np.cumsum(take)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(name) for name in ("doc_id", "lang", "name")),
                 pa.array([chosen[e - n : e].astype(np.uint8).tobytes() for n, e in zip(take, ends, strict=True)], pa.binary())],
                ["doc_id", "lang", "name", "windows"],
            )


def train(rows: DataFrame) -> ByteNet | None:
    """A network from the doc_id, text and lang of ``rows``; None if there is nothing to learn from.

    The sample takes the same number of rows of each language, as far as there are, in the order of a hash.
    """
    usable = rows.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string")).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = usable.select("doc_id", "lang").distinct()
    # Ids below a threshold of the hash, some three times as many as are wanted of a language, so that no window
    # holds a large language. The counts are one row a language, and at most SAMPLE_ROWS languages can be sampled.
    counts = known.groupBy("lang").count().orderBy("lang").limit(SAMPLE_ROWS)
    place = (F.xxhash64("doc_id").cast("double") + 2.0**63) / 2.0**64
    near = known.join(F.broadcast(counts), "lang").where(place * F.col("count") < 3 * SAMPLE_OF_LANGUAGE)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (
        near.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= SAMPLE_OF_LANGUAGE).orderBy("rank", "lang").limit(SAMPLE_ROWS).select("doc_id", "lang")
    )
    # At most SAMPLE_ROWS keys: a bounded broadcast keeps the texts in place. Of rows that repeat a key one is taken,
    # the least by the hash of its text.
    texts = usable.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi").withColumn("name", F.xxhash64("text"))
    found = texts.mapInArrow(_sample_windows, "doc_id long, lang string, name long, windows binary")
    one = found.groupBy("doc_id", "lang").agg(F.min(F.struct("name", "windows"))["windows"].alias("windows"))
    sample = [(r.lang, w) for r in one.collect() for w in (bytes(r.windows)[i : i + LENGTH] for i in range(0, len(r.windows), LENGTH))]
    if not sample:
        return None
    sample.sort()
    languages = sorted({lang for lang, _ in sample})
    windows = np.frombuffer(b"".join(window for _, window in sample), np.uint8).reshape(-1, LENGTH)
    wanted = np.array([languages.index(lang) for lang, _ in sample])
    share = np.bincount(wanted, minlength=len(languages)) / len(wanted)
    weight = (1 / (share * len(languages)))[wanted].astype(np.float32)
    net, rng = ByteNet.fresh(languages), np.random.default_rng(1)
    steps = Adam(net.weights, RATE)
    for _ in range(max(EPOCHS, -(-EPOCHS * 1000 // len(sample)))):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), BATCH):
            b = order[i : i + BATCH]
            steps.step(net.gradients(windows[b], wanted[b], weight[b]))
    return net


def predict(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """``docs`` with lang_pred and score, in place of columns of these names."""
    docs = docs.drop("lang_pred", "score")
    if net is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                windows, text, lengths = cut(*arrow_bytes(part.column("text")))
                scores = np.zeros((part.num_rows, len(net.languages)))
                np.add.at(scores, text, net.predict(windows) * lengths[:, None] if len(windows) else scores[:0])
                scores /= np.maximum(scores.sum(1, keepdims=True), 1e-9)
                best = scores.argmax(1)
                names = pa.array(net.languages, pa.string()).take(pa.array(best))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, names, pa.array(scores[np.arange(len(best)), best])],
                    [*part.schema.names, "_lang", "_score"],
                )

    columns = docs.columns
    scored = docs.mapInArrow(run, docs.select("*", F.lit("").alias("_lang"), F.lit(0.0).alias("_score")).schema)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return scored.select(
        *columns, F.when(letters, F.col("_lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(letters, F.least(F.lit(1.0), F.col("_score"))).otherwise(0.0).alias("score"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: the language of each text, learned from four fifths of the rows."""
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(True)).alias("held_out")
    net = train(docs.where(~held_out))
    return predict(docs.select("doc_id", held_out, "text"), net).drop("text")
