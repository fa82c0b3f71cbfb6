import re

from public_tokenizers import path
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import test_exact_dedup, test_near_dedup, test_pii

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    english = "the of and that with from this which were have been their".split()
    german = "der die und nicht mit von schön über auch nach wird durch".split()
    rows = []
    for i in range(60):
        words = english if i % 3 else german
        text = " ".join(words[(i * k + k * k) % 12] + ("" if k % 7 else f"{i}x{k}") for k in range(1, 60 + i))
        rows.append((i, text, "en" if i % 3 else "de", f"src{i % 4}", len(text)))
    rows += [(100 + i, rows[i][1].upper() if i % 3 else rows[i][1], rows[i][2], "src0", 1) for i in range(6)]
    rows += [(200 + i, rows[20 + i][1] + " und noch mehr", rows[20 + i][2], "src1", 1) for i in range(6)]
    rows += [(300, "write to a.b@mail.example.com or call +1 (499) 555-6503 that with from", "en", "src2", 1),
             (301, None, "en", "src2", None), (302, "", None, None, 0), (303, "12345 !!", "en", "src2", 8),
             (304, "the of and that with from this which were", None, None, 1)]
    return rows


def redacted(text):
    spans = sorted(tuple(map(int, s.split(":")[1:])) + (s.split(":")[0],) for s in test_pii.brute(text).split(",") if s)
    for a, b, kind in reversed(spans):
        text = f"{text[:a]}<{kind}>{text[b:]}"
    return text


def brute(rows):
    """What the stages keep, by plain loops: (doc_id, text)."""
    rows = [r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])]
    keep = {r[1] for r in test_exact_dedup.brute(rows)}
    rows = [r for r in rows if r[0] in keep]
    kept = {r[0] for r in test_near_dedup.brute(rows) if r[3]}
    return sorted((r[0], redacted(r[1])) for r in rows if r[0] in kept)


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        if name == "pii":
            kept = docs.collect()
    wanted = brute(rows)
    assert sorted((r.doc_id, r.text) for r in kept) == wanted
    assert all(r.n_chars == len(r.text) for r in kept) and {r.lang for r in kept} == {"en", "de"}
    tokenizer = Tokenizer.from_file(path("word_bpe_49k.json"))
    sizes = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in wanted}
    pieces = docs.collect()
    assert {p.doc_id: p.doc_tokens for p in pieces} == sizes and sum(p.length for p in pieces) == sum(sizes.values())


def test_near_copies_from_a_similarity_of_80_percent(spark):
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(words), " ".join([*words[:25], "other", *words[26:]]), " ".join([*words[:15], "a", *words[16:30], "b", *words[31:]])]
    rows = [(i, t, "en", "src", len(t)) for i, t in enumerate(texts)]
    # 41 of 51 shingles are shared by the first two; the third is below 0.8 to both.
    wanted = [r[0] for r in test_near_dedup.brute(rows, 80) if r[3]]
    kept = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert sorted(r.doc_id for r in kept.collect()) == wanted == [0, 2]


def test_pipeline_on_an_empty_table_and_extra_columns(spark, tmp_path):
    extra = SCHEMA + ", score string, lang_pred string, kept string, mark string"
    for name, rows in (("none", []), ("few", [(*r, "s", "l", None, "m") for r in documents()[:8]])):
        spark.createDataFrame(rows, extra).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{name}/documents.parquet")
        for stage in (corpus_pipeline.languages, corpus_pipeline.exact_copies, corpus_pipeline.near_copies, corpus_pipeline.personal_data):
            docs = stage(spark, docs, "")
            assert sorted(docs.columns) == sorted(spark.createDataFrame([], extra).columns), stage
        assert docs.count() == len(rows)
        assert (corpus_pipeline.packed(spark, docs, "").count() > 0) == bool(rows)


def test_run_writes_all_stages(spark, tmp_path):
    spark.createDataFrame(documents()[:30], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == 30
