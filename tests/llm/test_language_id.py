import zlib

import numpy as np
import pytest

from gridspark.llm import language_id
from gridspark.llm.language_id import ByteNet, predict, train

TABLES = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = language_id.op8_language_id(spark, TABLES).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out]
    assert np.mean(held) > 0.97


def test_gradients_are_right():
    net, rng = ByteNet.fresh(["a", "b"]), np.random.default_rng(3)
    net.weights = {k: w.astype(np.float64) for k, w in net.weights.items()}
    windows, wanted = rng.integers(0, 256, (5, language_id.LENGTH)).astype(np.uint8), np.array([0, 1, 1, 0, 1])
    loss = lambda: -np.log(net.forward(windows)[3][np.arange(5), wanted]).mean()
    grads = net.gradients(windows, wanted, np.ones(5))
    for name, at in (("out", (3, 1)), ("filters", (2, 5)), ("shift", (5,)), ("bytes", (int(windows[0, 4]), 2))):
        w, step = net.weights[name], 1e-6
        w[at] += step
        up = loss()
        w[at] -= 2 * step
        down = loss()
        w[at] += step
        assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-5


SCHEMA = "doc_id long, text string, lang string, lang_pred string"


def test_defined_cases(spark):
    english = [(i, "the of and that " * (1 + i % 9), "en", None) for i in range(20)]
    german = [(100 + i, "der und nicht schön " * (1 + i % 9), "de", None) for i in range(20)]
    odd = [(200, None, "en", None), (201, "", "en", None), (202, "12 !!", "en", "x"), (203, "the of", None, None),
           (None, "und der", "de", None), (204, "der nicht " * 40_000, "fr", None), (204, "x", "fr", None)]
    docs = spark.createDataFrame(english + german + odd, SCHEMA)
    net = train(docs.where("doc_id < 200"))
    assert net.languages == ["de", "en"]
    out = predict(docs, net)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    rows = out.collect()
    assert all(r.lang_pred == r.lang for r in rows if r.doc_id is not None and r.doc_id < 200)
    said = {(r.doc_id, r.text if r.text is None else r.text[:8]): (r.lang_pred, r.score) for r in rows}
    assert said[200, None] == said[201, ""] == said[202, "12 !!"] == ("und", 0.0)
    assert said[203, "the of"][0] == "en" and said[None, "und der"][0] == "de" and said[204, "der nich"][0] == "de"


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None, None)], SCHEMA)
    assert train(docs) is None and train(docs.limit(0)) is None
    assert [(r.lang_pred, r.score) for r in predict(docs, None).collect()] == [("und", 0.0)]
    one = train(spark.createDataFrame([(1, "text", "en", None)], SCHEMA))
    assert [(r.lang_pred, round(r.score, 6)) for r in predict(docs, one).collect()] == [("en", 1.0)]
    assert predict(docs.limit(0), one).collect() == []


def test_repeated_rows_do_not_grow_the_sample(spark, monkeypatch):
    """One id that repeats 30,000 times lends one text; the windows that reach the driver stay below the bound."""
    rows = [(7, f"the same words {i}", "en") for i in range(30_000)] + [(i, f"some other words of number {i}", "en") for i in range(100, 400)]
    rows += [(i, f"encore des mots du document {i}", "fr") for i in range(1000, 1300)]
    seen = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda self: seen.append(collect(self)) or seen[-1])
    net = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    monkeypatch.undo()
    assert net.languages == ["en", "fr"] and max(len(s) for s in seen) == 601
