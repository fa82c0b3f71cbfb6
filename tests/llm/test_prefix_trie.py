import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np

from gridspark.llm import prefix_trie as module
from gridspark.llm.common import Run
from gridspark.llm.prefix_trie import OP11_SQL, Slots, numbered, op11_prefix_trie, prefix_trie, rebuilt
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """All nodes by dictionaries of whole paths."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(turns.get(c - int(math.fmod(c, 100)), [])[:h] + ts[h:])  # a remainder has the sign of c
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    sums = {}
    for path in sorted(members, key=len, reverse=True):
        leaves = sum(sums[k][0] for k in kids[path]) or 1
        saved = (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
        sums[path] = (leaves, saved + sum(sums[k][1] for k in kids[path]))
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if whole[c] == path)
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(kids[path]), *sums[path],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def answers(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn int, role string, text string, depth int")
    run = Run(spark, "t")
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie(*rebuilt(numbered(df, run)), run).collect()), key=str)


def test_slots_are_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (1, 2, 17, 5000):
        keys = rng.integers(0, 1 << 63, (3, n)).astype(np.uint64)
        keys[0] %= np.uint64(50)
        slots = Slots.build(keys)
        assert sorted(slots.find(keys)) == list(range(n))
        again = Slots([b.copy() for b in slots.levels])
        assert (again.find(keys) == slots.find(keys)).all()


def test_equals_brute_force_over_bands_and_shards(spark, monkeypatch):
    monkeypatch.setattr(module, "SHARD_ROWS", 60)
    monkeypatch.setattr(module, "BAND", 3)
    monkeypatch.setattr(module, "CHUNK_BITS", 2)
    rng = random.Random(4)
    say = lambda: (rng.choice(["user", "bot"]), rng.choice(["a", "bb", "ccc"]))
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(301, 310)]:
        rows += [(c, i, *say()) for i in range(rng.randint(1, 12))]
    same = [say() for _ in range(8)]
    rows += [(c, i, *t) for c in range(1000, 1060) for i, t in enumerate(same)]  # many equal conversations
    rows += [(2000, i, *say()) for i in range(150)]  # one holds many of all rows
    rng.shuffle(rows)
    assert answers(spark, rows) == brute(rows)


def test_band_of_one_turn(spark, monkeypatch):
    monkeypatch.setattr(module, "BAND", 1)
    rows = [(c, i, "r", "x" * (i % 3)) for c in (0, 1, 2, 7) for i in range(c + 4)]
    assert answers(spark, rows) == brute(rows)


def test_cases(spark):
    rows = [(0, None, None, None), (0, None, "", "x"), (0, 1, "a", "b"), (0, 1, "a", "b"), (0, 1, "A", "é" * 30_000), (None, 1, "a", "b"),
            (5, 1, "ab", "c"), (6, 1, "a", "bc"), (-7, 2, "q", ""), (-7, 2, None, "q"), (1234567890123, 1, "x", "y"), (207, 0, "z", "z")]
    assert answers(spark, rows) == brute(rows)
    assert answers(spark, rows[5:6]) == []
    assert answers(spark, rows[-1:]) == brute(rows[-1:])


def test_query_equals_sql(spark):
    assert compare(op11_prefix_trie(spark, SF), SF, OP11_SQL) is None
