import hashlib
import random
import re

import pytest

from gridspark.llm import pii
from gridspark.llm.common import Run

TABLES = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
            "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def brute(text):
    spans = [(m.start(), k, m.end(), kind) for k, kind in enumerate(PLAIN) for m in re.finditer(PLAIN[kind], text or "") if valid(kind, m[0])]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))


def test_sample_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}
    got = pii.op9_pii(spark, TABLES).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        base = brute(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(base.count(f"{k}:") for k in PLAIN)
        assert set(filter(None, base.split(","))) <= set(filter(None, r.spans.split(",")))


SCHEMA = "doc_id long, text string, spans string, mark string"


def base(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    return sorted(((r.doc_id, r.b) for r in pii.base_spans(docs).select("doc_id", pii.as_text("base").alias("b")).collect()), key=repr)


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(5)
    bits = ["a@b.c", "x_@y.z", "@", ".", "-", "+", "1", "12", "255", "256", "001", "4539578763621486", "+1 (499) 555-6503", " ", "é😀", "q", "%", "_",
            "1.2.3.4", "\n", "(", ")", "5105 1051 0510 5100", "0000000000000", "a@b", "@c.d-e.f", "_x@y.zz"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))), "x", None) for i in range(3000)]
    rows += [(9000, None, "x", "y"), (9001, "", None, None), (9002, "7" * 100_000, "x", "y"), (9003, "a" * 200_000 + "@b.c", "x", "y"),
             (9004, "é a@b.cd " * 3000, "x", "y"), (9005, "+1" + "(" * 50_000, "x", "y"), (None, "a@b.c", "x", "y"), (9000, "a@b.c", "x", "y"),
             (9006, "1-" * 40_000 + "1", "x", "y"), (9007, "a@b" + ".c" * 30_000, "x", "y")]
    assert base(spark, rows) == sorted(((r[0], brute(r[1])) for r in rows), key=repr)


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(i, f"word{i} please write to clerk{i}@example.org for word{i}", "x", "y") for i in range(6)]
    rows += [(10, "ö please write to jürgen@office for more", "x", "y"), (11, "about 1234567 things for 99999999", "x", "y"),
             (10, "ö please write to jürgen@office for more", "x", "y"), (10, "other", "x", "y"), (12, "please write to 123456789 for more", "x", "y")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = pii.find(docs, Run(spark, "test"))
    spans = [(r.doc_id, r.s) for r in found.select("doc_id", pii.as_text("spans").alias("s")).collect()]
    assert len(spans) == len(rows)
    assert [s for d, s in spans if d == 10] in ([""] * 0 + ["email:18:31", "email:18:31", ""], ["email:18:31", "", "email:18:31"], ["", "email:18:31", "email:18:31"])
    assert [s for d, s in spans if d in (11, 12)] == ["", ""]
    out = pii.redact(docs, found)
    assert out.columns == docs.columns and out.count() == len(rows)
    texts = {r.text for r in out.collect()}
    assert "ö please write to <email> for more" in texts and "word3 please write to <email> for word3" in texts
    assert rows[7][1] in texts


def test_redact_joins_overlaps(spark):
    docs = spark.createDataFrame([(1, "call +4539578763621 now", "x", "y"), (2, None, None, None), (3, "plain", None, None)], SCHEMA)
    out = {r.doc_id: r.text for r in pii.redact(docs, pii.find(docs, Run(spark, "test"))).collect()}
    assert out[2] is None and out[3] == "plain" and out[1] in ("call <phone> now",)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)]])
def test_empty(spark, rows):
    found = pii.find(spark.createDataFrame(rows, SCHEMA), Run(spark, "test"))
    assert [(r.doc_id, r.spans) for r in found.collect()] == [(r[0], []) for r in rows]
