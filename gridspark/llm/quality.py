"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of some words. Every passage is encoded from embeddings of its words and of
their shapes; gated attention weights the passages; the weighted passage representation is scored. All parts
are learned together in numpy from document labels alone, on a bounded sample of labelled rows, and applied
to every passage of every whole text.

Cases: null and empty texts are one passage without words and get a score like any other. Labels that are
null, or whose document is missing, teach nothing; of several labels of a document the smallest counts.
Without both labels to learn from, every score is the share of label 1 (0.5 without any). A row without an
id is reported as held out. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.common import Adam, read, remainder
from gridspark.llm.words import Words, ragged, slices, split_words

PASSAGE = 50  # words
TOKENS = 1 << 14  # rows of each of the two embedding tables: words and shapes
EMBEDDED, ENCODED, ATTENTION = 12, 16, 12
#: Bounds of the training sample: rows of a label, and bytes of a text that may be drawn.
SAMPLE_OF_LABEL, SAMPLE_BYTES = 2000, 1 << 16
EPOCHS, BATCH, RATE = 5, 32, 0.004

#: Byte classes: blank, lower, upper, digit, beyond ASCII, end of clause, joining marks, other signs.
_CLASS = np.full(256, 7, np.uint8)
for _class, _bytes in enumerate((bytes([32, *range(9, 14)]), bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789",
                                 bytes(range(128, 256)), b".,;:!?", b"'\"()-")):
    _CLASS[list(_bytes)] = _class
_BIT = np.concatenate(([0], 1 << np.arange(7))).astype(np.uint8)[_CLASS]


def tokens(words: Words) -> np.ndarray:
    """Two token numbers per word: its hash, and its shape (first and last byte class, classes in it,
    length, and whether it repeats the word before)."""
    hashes = words.hashes()
    if not len(hashes):
        return np.zeros((0, 2), np.int64)
    size = words.ends - words.starts
    shape = np.bitwise_or.reduceat(_BIT[words.data], words.starts).astype(np.int64)
    shape = shape * 8 + _CLASS[words.data[words.starts]]
    shape = shape * 8 + _CLASS[words.data[words.ends - 1]]
    shape = shape * 5 + np.searchsorted([2, 4, 8, 16], size)
    shape = shape * 2 + np.concatenate(([False], hashes[1:] == hashes[:-1]))
    return np.stack([hashes % np.uint64(TOKENS), TOKENS + shape * 40503 % TOKENS], axis=1).astype(np.int64)


def passages(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Passage number of each word, and document of each passage. Every document has one at least."""
    counts = words.counts()
    held = np.maximum(-(-counts // PASSAGE), 1)
    base = np.cumsum(held) - held
    return np.repeat(base, counts) + ragged(np.zeros(len(counts), np.int64), counts) // PASSAGE, np.repeat(np.arange(len(counts)), held)


def _sums(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows per group; groups ascend and may be missing."""
    out = np.zeros((n, *values.shape[1:]), values.dtype)
    if len(groups):
        heads = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
        out[groups[heads]] = np.add.reduceat(values, heads, axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class GatedBags:
    """The network: embeddings, passage encoder, the two attention branches, and the score."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls) -> GatedBags:
        rng = np.random.default_rng(0)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return cls({
            "tokens": normal(2 * TOKENS, EMBEDDED, scale=0.1), "encode": normal(EMBEDDED, ENCODED, scale=0.4),
            "encode_shift": np.zeros(ENCODED, np.float32), "tanh": normal(ENCODED, ATTENTION, scale=0.3),
            "gate": normal(ENCODED, ATTENTION, scale=0.3), "attend": normal(ATTENTION, scale=0.3),
            "score": normal(ENCODED, scale=0.3), "bias": np.zeros(1, np.float32),
        })

    def forward(self, token: np.ndarray, passage: np.ndarray, document: np.ndarray, n: int) -> dict:
        w, m = self.weights, len(document)
        size = np.maximum(np.bincount(passage, minlength=m), 1)[:, None].astype(w["score"].dtype)
        mean = _sums(w["tokens"][token[:, 0]] + w["tokens"][token[:, 1]], passage, m) / size
        h = np.tanh(mean @ w["encode"] + w["encode_shift"])
        t, g = np.tanh(h @ w["tanh"]), _sigmoid(h @ w["gate"])
        e = np.exp(np.clip((t * g) @ w["attend"], -30, 30))
        a = e / _sums(e, document, n)[document]
        z = _sums(a[:, None] * h, document, n)
        return {"size": size, "mean": mean, "h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ w["score"] + w["bias"])}

    def gradients(self, token, passage, document, wanted, weight) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(token, passage, document, len(wanted))
        error = (f["p"] - wanted) * weight / len(wanted)
        back_z = error[:, None] * w["score"]
        back_a = (back_z[document] * f["h"]).sum(1)
        held = _sums(f["a"] * back_a, document, len(wanted))[document]
        back_s = f["a"] * (back_a - held)
        back_t, back_g = back_s[:, None] * w["attend"] * f["g"], back_s[:, None] * w["attend"] * f["t"]
        back_t, back_g = back_t * (1 - f["t"] ** 2), back_g * f["g"] * (1 - f["g"])
        back_h = f["a"][:, None] * back_z[document] + back_t @ w["tanh"].T + back_g @ w["gate"].T
        back_h = back_h * (1 - f["h"] ** 2)
        per_word = ((back_h @ w["encode"].T) / f["size"])[passage]
        grads = {"score": f["z"].T @ error, "bias": error.sum(keepdims=True), "attend": (f["t"] * f["g"]).T @ back_s,
                 "tanh": f["h"].T @ back_t, "gate": f["h"].T @ back_g, "encode": f["mean"].T @ back_h,
                 "encode_shift": back_h.sum(0), "tokens": np.zeros_like(w["tokens"])}
        np.add.at(grads["tokens"], token[:, 0], per_word)
        np.add.at(grads["tokens"], token[:, 1], per_word)
        return grads


def _bags(batches):
    for batch in batches:
        for part in slices(batch):
            words = split_words(part.column("text"))
            token = tokens(words).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [part.column("quality").cast(pa.int32()),
                 pa.array([token[a:b].tobytes() for a, b in zip(words.first[:-1], words.first[1:], strict=True)], pa.binary())],
                ["quality", "token"],
            )


def train(docs: DataFrame, labels: DataFrame) -> GatedBags | float:
    """A network from (doc_id, text) and (doc_id, quality), or a constant where only one label is known."""
    labels = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    usable = docs.select("doc_id", "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES)
    known = labels.join(usable.select("doc_id"), "doc_id", "left_semi")
    # A sort with a limit keeps no more than the sample in any task, however large a label is.
    some = lambda label: known.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_OF_LABEL)
    ids = some(0).unionByName(some(1)).select("doc_id", "quality")
    # Two labels of at most SAMPLE_OF_LABEL ids each: a bounded broadcast keeps the other texts in place. Of rows that
    # repeat an id one text is taken, the least by its hash.
    texts = usable.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t"))
    sample = texts.select("t.text", "quality").mapInArrow(_bags, "quality int, token binary").collect()
    wanted = np.array([r.quality for r in sample], np.float32)
    if not len(sample) or wanted.min() == wanted.max():
        return float(wanted.mean()) if len(sample) else 0.5
    sample.sort()
    wanted = np.array([r.quality for r in sample], np.float32)
    bags = [np.frombuffer(bytes(r.token), np.uint16).reshape(-1, 2) for r in sample]
    ones = wanted.mean()
    weight = np.where(wanted == 1, 0.5 / ones, 0.5 / (1 - ones)).astype(np.float32)
    net, rng = GatedBags.fresh(), np.random.default_rng(1)
    steps = Adam(net.weights, RATE)
    for _ in range(max(EPOCHS, -(-EPOCHS * 1000 // len(sample)))):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), BATCH):
            b = order[i : i + BATCH]
            counts = np.array([len(bags[k]) for k in b])
            passage, document = passages(Words(None, None, None, np.concatenate(([0], np.cumsum(counts)))))
            steps.step(net.gradients(np.concatenate([bags[k] for k in b]).astype(np.int64), passage, document, wanted[b], weight[b]))
    return net


def score(docs: DataFrame, net: GatedBags | float) -> DataFrame:
    """``docs`` with a ``score`` from 0 to 1, in place of a column of that name."""
    docs = docs.drop("score")
    if not isinstance(net, GatedBags):
        return docs.withColumn("score", F.lit(net))

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                words = split_words(part.column("text"))
                passage, document = passages(words)
                p = net.forward(tokens(words), passage, document, part.num_rows)["p"]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p.astype(np.float64))], [*part.schema.names, "_score"])

    scored = docs.mapInArrow(run, docs.select("*", F.lit(0.0).alias("_score")).schema)
    return scored.select(*docs.columns, F.col("_score").alias("score"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: the quality of each, learned from three quarters of the labelled rows."""
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(True)).alias("held_out")
    net = train(docs.where(~held_out), read(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", held_out, "text"), net).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
