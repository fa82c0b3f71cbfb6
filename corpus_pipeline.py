"""The corpus pipeline: languages, exact copies, near copies, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next stage's ``docs``. All stages but the last return the columns of ``documents``, and extra ones if there
are any. Each works on all that the stage before kept, also on an empty table, and its decisions take effect.

No stage can be said in SQL alone: the first learns a network, the third draws its candidates by hashes, the last
needs a tokenizer. So ``ORACLE_SQL`` is None and the tests compare with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm import exact_dedup, language_id, near_dedup, packing, pii
from gridspark.llm.common import Run, read


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled rows teach; those without a letter are rejected. A null ``lang`` is filled by the prediction."""
    net = language_id.train(docs)
    if net is None:  # nothing is labelled, so nothing can be rejected for its language
        return docs.where(F.col("text").rlike(r"\p{L}"))
    named = language_id.predict(docs.withColumnsRenamed({"lang_pred": "docs lang_pred", "score": "docs score"}), net)
    # A low score alone is no reason: very short clean texts have one.
    kept = named.where(F.col("lang_pred") != language_id.UNKNOWN)
    kept = kept.withColumn("lang", F.coalesce("lang", "lang_pred")).drop("lang_pred", "score")
    return kept.withColumnsRenamed({"docs lang_pred": "lang_pred", "docs score": "score"})


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    run = Run(spark, "exact-copies")
    index = exact_dedup.new_index(run, docs.count())
    exact_dedup.dedup(docs, index, run)
    return exact_dedup.survivors(docs, index)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, similar by 0.8 or more, the document with the smallest id."""
    # 18 trees: a pair at 0.8 in leaves of depth four is missed with probability 8e-5.
    report = near_dedup.near_duplicates(docs, Run(spark, "near-copies"), percent=80, trees=18)
    return near_dedup.survivors(docs, report)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind, and their new length."""
    hidden = pii.redact(docs, pii.find(docs, Run(spark, "personal-data")))
    return hidden.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, each with the mixture of sources."""
    from public_tokenizers import path

    pieces = packing.pack(docs, Run(spark, "packed"), path("word_bpe_49k.json"))
    return packing.with_checks(pieces)


STAGES = [
    ("language_id", languages), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("pii", personal_data),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, tables = read(spark, sf_dir, "documents"), Run(spark, "pipeline")
    for name, stage in STAGES:
        docs = tables.write(stage(spark, docs, sf_dir), name)
    return docs


REPORTS = {"pipeline": (run, ORACLE_SQL)}
