import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from gridspark.llm import quality
from gridspark.llm.words import split_words

TABLES = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in quality.op3_quality_classifier(spark, TABLES).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{TABLES}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{TABLES}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    held = [(got[d].predicted, q) for d, q in labels.items() if got[d].held_out]
    assert np.mean([p == q for p, q in held]) > 0.95
    assert np.mean([p for p, q in held if q == 1]) > 0.97


def test_gradients_are_right():
    net = quality.GatedBags.fresh()
    net.weights = {k: w.astype(np.float64) for k, w in net.weights.items()}
    rng = random.Random(1)
    words = split_words(pa.array([" ".join(rng.choice(["a", "B!", "c3", "dd"]) for _ in range(n)) for n in (120, 0, 7, 60)]))
    token, (passage, document) = quality.tokens(words), quality.passages(words)
    wanted, weight = np.array([1.0, 0, 0, 1]), np.array([1.0, 2, 1, 0.5])
    p = lambda: net.forward(token, passage, document, 4)["p"]
    loss = lambda: (-weight * (wanted * np.log(p()) + (1 - wanted) * np.log(1 - p()))).mean()
    grads = net.gradients(token, passage, document, wanted, weight)
    for name, at in (("score", (2,)), ("bias", (0,)), ("attend", (1,)), ("tanh", (3, 4)), ("gate", (3, 4)),
                     ("encode", (1, 1)), ("encode_shift", (2,)), ("tokens", (int(token[0, 0]), 1)), ("tokens", (int(token[5, 1]), 3))):
        w, step = net.weights[name], 1e-6
        w[at] += step
        up = loss()
        w[at] -= 2 * step
        down = loss()
        w[at] += step
        assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-6, name


SCHEMA = "doc_id long, text string, quality string, score string"


def test_defined_cases(spark):
    good = [(i, "plain words go here " * (1 + i), "x", "y") for i in range(12)]
    bad = [(100 + i, "BUY!! NOW!! " * (1 + i), None, None) for i in range(12)]
    odd = [(200, None, "x", "y"), (201, "", "x", "y"), (None, "plain", "x", "y"), (202, "go " * 50_000, "x", "y"), (5, good[5][1], "x", "y")]
    docs = spark.createDataFrame(good + bad + odd, SCHEMA)
    rows = [(i, 1, 0) for i in range(12)] + [(100 + i, 0, 0) for i in range(12)] + [(5, 1, 1), (None, 1, 0), (201, None, 0), (999, 1, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    net = quality.train(docs, labels)
    out = quality.score(docs.select("doc_id", "text"), net).collect()
    assert len(out) == 29 and all(0 <= r.score <= 1 for r in out)
    assert all((r.score > 0.5) == (r.doc_id < 100) for r in out if r.doc_id is not None and r.doc_id < 200)
    assert len({r.score for r in out if r.doc_id in (200, 201)}) == 1


@pytest.mark.parametrize(("labels", "wanted"), [([], 0.5), ([(1, 1)], 1.0), ([(1, 0)], 0.0), ([(1, None)], 0.5)])
def test_nothing_to_learn_from(spark, labels, wanted):
    docs = spark.createDataFrame([(1, "text"), (2, None)], "doc_id long, text string")
    net = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert [r.score for r in quality.score(docs, net).collect()] == [wanted] * 2
    assert quality.score(docs.limit(0), quality.GatedBags.fresh()).collect() == []


def test_repeated_rows_do_not_grow_the_sample(spark, monkeypatch):
    """One id that repeats 30,000 times lends one text."""
    rows = [(7, f"the same words {i}") for i in range(30_000)] + [(i, f"some other words of number {i}") for i in range(100, 200)]
    labels = spark.createDataFrame([(7, 1), *((i, i % 2) for i in range(100, 200))], "doc_id long, quality int")
    seen = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda self: seen.append(collect(self)) or seen[-1])
    quality.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    monkeypatch.undo()
    assert max(len(s) for s in seen) == 101
