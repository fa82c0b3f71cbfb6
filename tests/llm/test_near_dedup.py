import random
import re

import numpy as np
import pyarrow as pa
import pytest

from gridspark.llm import near_dedup
from gridspark.llm.common import Run
from gridspark.llm.words import split_words, windows

SCHEMA = "doc_id long, text string, component_id string, mark string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent=85):
    sets = [shingles(r[1]) for r in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(s), least.get(root(i)), r[0] == least.get(root(i))) for i, (r, s) in enumerate(zip(rows, sets))), key=repr)


def report(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


def near(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(rng):
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [rng.choice(vocabulary) for _ in range(30)]
    texts = []
    for _ in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(6, 260))]
        if rng.random() < 0.5:
            words[3:3] = shared
        texts += [near(rng, words, rng.randrange(0, 6)) for _ in range(rng.randrange(1, 6))]
    return texts


def test_words_and_windows():
    texts = ["a b\tc\x0bd", None, "", "  ", "ü—x y", "a b"]
    words = split_words(pa.array(texts))
    assert list(words.counts()) == [4, 0, 0, 0, 2, 2]
    hashes = words.hashes()
    assert list(hashes[:2]) == list(hashes[-2:]) and len(set(hashes.tolist())) == 6
    numbers = np.arange(100, dtype=np.uint64) % np.uint64(7)
    for width in (1, 2, 3, 5, 14, 20, 100):
        got = windows(numbers, width)
        assert len(got) == 101 - width
        for i in range(len(got)):
            for j in range(i):
                assert (got[i] == got[j]) == (list(numbers[i : i + width]) == list(numbers[j : j + width]))


def test_long_word_hash():
    long = "x" * 700_000
    words = split_words(pa.array([f"a {long} b", f"{long} a", "b"]))
    h = words.hashes()
    assert h[0] == h[4] and h[1] == h[3] and h[2] == h[5] and len(set(h.tolist())) == 3


def test_hashes_tell_patterned_words_apart():
    """Words that sums of powers modulo 2^64 cannot tell apart, of 2^7 to 2^13 letters; and runs of such patterns of words."""
    for bits in range(7, 14):
        pattern = [i.bit_count() & 1 for i in range(1 << bits)]
        a, b = ("".join("ab"[x ^ flip] for x in pattern) for flip in (0, 1))
        words = split_words(pa.array([f"{a} {b} {a}"]))
        for half in (0, 1):
            h = words.hashes(half)
            assert h[0] == h[2] != h[1]
        numbers = np.array([[5, 9][x] for x in pattern] + [[9, 5][x] for x in pattern], np.uint64)
        for half in (0, 1):
            got = windows(numbers, len(pattern), half)
            assert got[0] != got[-1]


def test_components_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, t, "x", None) for i, t in enumerate(corpus(rng))]
    rows += [(900, None, None, None), (901, "", "x", "y"), (902, " \t", "x", "y"), (903, "One two", "x", "y"),
             (904, "one  TWO", "x", "y"), (None, rows[0][1], "x", "y"), (None, "no id at all", "x", "y"),
             (905, "z " * 50_000, "x", "y"), (5, rows[5][1], "x", "y"), (5, rows[5][1], "x", "y"), (7, "other text same id", "x", "y")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = near_dedup.near_duplicates(docs, Run(spark, "test"))
    assert report(got) == brute(rows)
    kept = near_dedup.survivors(docs, got)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r[3] for r in brute(rows))


def test_large_nodes_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LEAF_ROWS", 12)
    monkeypatch.setattr(near_dedup, "PIVOTS", 2)
    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    texts = [near(rng, base, rng.randrange(0, 4)) for _ in range(160)]
    # A chain: each text is like the one before it, the ends are unlike.
    words = list(base)
    for k in range(25):
        words[6 * k : 6 * k + 2] = [f"c{k}", f"d{k}"]
        texts.append(" ".join(words))
    rows = [(i * 7 % 1009, t, None, None) for i, t in enumerate(texts)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), Run(spark, "test"), depth=2)
    assert report(got) == brute(rows)


def bridged(seed):
    """Two dense clusters, unlike each other, and one chain of texts between them."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    other = [f"v{i}" if i >= 90 else w for i, w in enumerate(base)]
    texts = [near(rng, words, rng.randrange(0, 2)) for words in (base, other) for _ in range(60)]
    texts += [" ".join(other[:90] + other[90 : 90 + k] + base[90 + k :]) for k in range(6, 60, 6)]
    rng.shuffle(texts)
    return [(i * 7 % 1009, t, None, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [0, 1])
def test_a_bridge_between_clusters_that_pivots_tie(spark, monkeypatch, seed):
    monkeypatch.setattr(near_dedup, "LEAF_ROWS", 12)
    monkeypatch.setattr(near_dedup, "PIVOTS", 6)
    rows = bridged(seed)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), Run(spark, "test"), trees=2, depth=1)
    assert report(got) == brute(rows)


def test_templates_do_not_meet(spark, monkeypatch):
    """Texts that share most shingles and are no near duplicates stay apart; leaves are bounded, pairs are found."""
    monkeypatch.setattr(near_dedup, "LEAF_ROWS", 12)
    monkeypatch.setattr(near_dedup, "PIVOTS", 2)
    sizes, leaf_runs = spark.sparkContext.accumulator(0), near_dedup._runs

    def counted(batches, key):
        for table in leaf_runs(batches, key):
            if key == "leaf" and table.num_rows > 60:  # blocks are of 6 rows, by hash, and pivots
                sizes.add(1)
            yield table

    monkeypatch.setattr(near_dedup, "_runs", counted)
    rows = [(i, f"one two three four five six seven n{i}", None, None) for i in range(200)]
    long = [f"w{i}" for i in range(60)]
    rows += [(300 + i, " ".join([*long, *(f"n{i}x{k}" for k in range(4 if i % 10 else 10))]), None, None) for i in range(80)]
    rows += [(500 + i, " ".join([*long, *(f"n{i}x{k}" for k in range(5))]), None, None) for i in range(1, 10)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), Run(spark, "test"), trees=6, depth=1)
    assert report(got) == brute(rows)
    assert sizes.value == 0


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)]])
def test_empty(spark, rows):
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), Run(spark, "test"))
    assert report(got) == [(r[0], 0, r[0], True) for r in rows]


def test_components_of_chains_and_hubs(spark):
    from gridspark.llm.components import components

    chain = [(i, i + 1) for i in range(1000, 1040)]
    hub = [(5, i) for i in range(10, 200)]
    rows = [*chain, *hub, (9, 199), (7, 7), (2000, 1990), (1990, 1980), (1980, 2000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(rows, "a long, b long"), Run(spark, "test")).collect()}
    wanted = {i: 1000 for i in range(1001, 1041)} | {i: 5 for i in [*range(10, 200), 9]} | {1990: 1980, 2000: 1980}
    assert got == wanted
