import random
import re

import pytest

from gridspark.llm import substring_dedup
from gridspark.llm.common import Run

SCHEMA = "doc_id long, text string, chunk string, kept_text string"


def brute(rows, window):
    documents = [(r[0] if r[0] is not None else 2**63 - 1, re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    first = {}
    for doc, words in documents:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, (doc, i)), (doc, i))
    out = []
    for (doc, words), row in zip(documents, rows, strict=True):
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < (doc, i):
                gone.update(range(i, i + window))
        out.append((row[0], len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=repr)


def report(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


def corpus(rng, n, shared):
    rows = []
    for doc in range(n):
        words = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(0, 90))]
        for passage in shared:
            if rng.random() < 0.4:
                at, low = rng.randrange(len(words) + 1), rng.randrange(0, 12)
                words[at:at] = passage[low : rng.randrange(low, len(passage) + 1)]
        if rng.random() < 0.2:
            words += words
        rows.append((doc, "".join(w + rng.choice([" ", "\n", " \t ", "\x0b"]) for w in words), "x", None))
    return rows


@pytest.mark.parametrize(("window", "period"), [(20, 7), (20, 13), (8, 3)])
def test_equals_brute_force(spark, monkeypatch, window, period):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(substring_dedup, "BUCKET_HASHES", 300)
    rng = random.Random(window * period)
    shared = [[f"s{k}.{i}" for i in range(45)] for k in range(4)]
    rows = corpus(rng, 120, shared)
    rows += [(500, None, "x", "y"), (501, "", "x", "y"), (502, "one", "x", "y"), (None, rows[3][1], "x", "y"), (None, "é " * 50, "x", "y"),
             (9, rows[9][1], "x", "y"), (11, " ".join(shared[0]), "x", "y"), (503, "long " * 30_000, "x", "y")]
    rng.shuffle(rows)
    got = substring_dedup.dedup_passages(spark.createDataFrame(rows, SCHEMA), Run(spark, "test"), window=window, period=period)
    assert report(got) == brute(rows, window)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)]])
def test_empty(spark, rows):
    got = substring_dedup.dedup_passages(spark.createDataFrame(rows, SCHEMA), Run(spark, "test"))
    assert report(got) == brute(rows, 20)


def test_covers():
    for period, cover in substring_dedup.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
