import math
import random
import re
from collections import Counter

from gridspark.llm import lexical_search
from gridspark.llm.common import Run
from gridspark.llm.lexical_search import OP12_SQL, op12_lexical_search, search, terms_of
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return TERM.findall(lower)


def brute(docs, items, k):
    """(item_id, rank, doc_id, score) by counting every term of every document."""
    docs = [(i, Counter(t), len(t)) for i, t in ((i, terms(x)) for i, x in docs) if t]
    total, length, out = len(docs), sum(n for _, _, n in docs), []
    df = Counter(t for _, c, _ in docs for t in c)
    for item_id, text in items:
        scored = []
        for doc_id, counts, n in docs:
            m = 100 - 25 + 25 * n * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
                        for t in terms(text) if counts[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def answers(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def tables(spark, docs, items):
    return (spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, term string, n int"),
            spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, doc_id int"))


def test_terms():
    for text in (None, "", " .,", "A-b É9 Éé\x00z　x\x7fy", "ÀÁ", "a" * 70_000 + "!B"):
        assert terms_of(text) == terms(text)


def test_equals_brute_force_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 40)
    monkeypatch.setattr(lexical_search, "CELLS", 64)
    rng = random.Random(2)
    words = ["a", "ab", "abc", "bc", "Über", "ü", "日本", "THE", "the", "x1", "1x", "é"]
    say = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "-", "\n", "\x00"]) for _ in range(n))
    docs = [(i, say(rng.randint(0, 30))) for i in range(300)] + [(1000 + i, "the the abc") for i in range(150)]
    items = [(i, say(rng.randint(0, 9))) for i in range(25)]
    got = search(*tables(spark, docs, items), Run(spark, "t"), k=7)
    assert answers(got) == brute(docs, items, 7)


def test_cases(spark):
    docs = [(1, None), (2, ""), (3, " ., "), (4, "one two"), (4, "one two"), (None, "one two"), (5, "One"), (6, "x" * 300_000 + " two")]
    items = [(1, "one"), (1, "TWO two"), (None, "one two"), (2, None), (3, ""), (4, "absent")]
    assert answers(search(*tables(spark, docs, items), Run(spark, "t"))) == brute(docs, items, 20)
    for some in ((docs[:3], items), ([], items), (docs, []), (docs, items[3:5])):
        assert answers(search(*tables(spark, *some), Run(spark, "t"))) == []


def test_query_equals_sql(spark):
    assert compare(op12_lexical_search(spark, SF), SF, OP12_SQL) is None
