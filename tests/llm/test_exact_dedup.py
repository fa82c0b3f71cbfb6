import hashlib

import pytest

from gridspark.llm.common import Run
from gridspark.llm.exact_dedup import DigestIndex, dedup, new_index, survivors

SCHEMA = "doc_id long, text string, digest string, kept string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = {}
    for doc, text, *_ in rows:
        groups.setdefault(lower(text), []).append(doc)
    out = []
    for doc, text, *_ in rows:
        group = groups[lower(text)]
        keep = max((d for d in group if d is not None), default=None)
        out.append((doc, keep, len(group), doc == keep, hashlib.sha256(lower(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def report(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in df.collect()), key=repr)


ROWS = [
    (1, "Abc", "x", "y"), (2, "abc", None, None), (3, None, "x", None), (4, "", "x", "y"), (5, "ÄBC", "x", "y"),
    (6, "äbc", "x", "y"), (7, "only", "x", "y"), (7, "only", "x", "y"), (None, "abc", "x", "y"), (None, "lost", "x", "y"),
    (8, "x " * 200_000, "x", "y"),
]


@pytest.mark.parametrize("rows", [ROWS, []])
def test_report_and_survivors(spark, rows):
    docs, run = spark.createDataFrame(rows, SCHEMA), Run(spark, "test")
    index = new_index(run, len(rows))
    assert report(dedup(docs, index, run)) == brute(rows)
    left = survivors(docs, index)
    assert left.columns == docs.columns
    wanted = [2, 4, 5, 6, 7, 8, None] if rows else []
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted(wanted, key=repr)


def test_hot_group_is_whole(spark):
    rows = [(i, "same" if i % 3 == 0 else f"text {i}", None, None) for i in range(3000)]
    run = Run(spark, "test")
    assert report(dedup(spark.createDataFrame(rows, SCHEMA), new_index(run, 1), run)) == brute(rows)


def test_index_outlives_batches_and_sessions(spark):
    run = Run(spark, "test")
    index = DigestIndex(spark, f"{run.folder}/index", 4)
    first = spark.createDataFrame([(1, "a", None, None), (2, "b", None, None)], SCHEMA)
    again = report(dedup(first, index, Run(spark, "test")))
    assert report(dedup(first, index, Run(spark, "test"))) == again
    spark.sql(f"DROP TABLE {index.table}")
    reopened = DigestIndex(spark, f"{run.folder}/index", 4)
    batch = spark.createDataFrame([(9, "A", None, None), (10, "c", None, None)], SCHEMA)
    assert [(d, k, kept) for d, k, _, kept, _ in report(dedup(batch, reopened, Run(spark, "test")))] == [
        (10, 10, True), (9, 1, False)]
    assert [r.doc_id for r in survivors(batch, reopened).collect()] == [10]
    assert reopened.entries().count() == 3


def test_index_is_read_bucket_by_bucket(spark):
    run = Run(spark, "test")
    index = DigestIndex(spark, f"{run.folder}/index", 4)
    dedup(spark.createDataFrame([(1, "a", None, None)], SCHEMA), index, run)
    groups = spark.createDataFrame([(b"x", 1)], "digest binary, keep_id long")
    plan = index.missing(groups)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_index_over_sessions_and_layouts(spark):
    """An index is reopened as it was laid out, also by another catalog; another count is refused, a copy has it."""
    docs = spark.createDataFrame([(i, f"text {i}", None, None) for i in range(2000)], SCHEMA)
    run = Run(spark, "test")
    folder = f"{run.folder}/index"
    dedup(docs, DigestIndex(spark, folder, 8), run)
    spark.sql(f"DROP TABLE {DigestIndex(spark, folder).table}")  # a catalog that has never seen it
    again = DigestIndex(spark, folder)
    assert again.buckets == 8
    with pytest.raises(ValueError):
        DigestIndex(spark, folder, 16)
    with pytest.raises(ValueError):
        DigestIndex(spark, f"{run.folder}/nowhere")
    with pytest.raises(ValueError):
        DigestIndex(spark, run.folder, 8)
    more = spark.createDataFrame([(i, f"text {i - 10_000}", None, None) for i in range(10_000, 12_100)], SCHEMA)
    assert dedup(more, again, Run(spark, "test")).where("kept").count() == 100
    wide = again.copied(f"{run.folder}/wide", 16)
    assert wide.buckets == 16 and wide.entries().count() == 2100
    assert dedup(more, wide, Run(spark, "test")).where("kept").count() == 100
    assert dedup(docs, wide, Run(spark, "test")).where("not kept").count() == 0
