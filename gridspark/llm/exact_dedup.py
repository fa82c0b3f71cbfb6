"""Exact deduplication against a persistent digest index [DataFrame functions only].

The index is a Parquet table of SHA-256 digests, bucketed and sorted by digest. A batch is reduced to
one row per digest, joined to the index by a sort-merge anti join in which the index is read bucket by
bucket and not shuffled, and the digests that are new are appended.

Cases: a null text counts as empty, and all empty texts are equal. A null ``doc_id`` never wins over
another; a group without any ``doc_id`` keeps all its rows in the report. Rows that repeat both
``doc_id`` and text cannot be told apart and get the same report row; :func:`survivors` keeps one of
them. Extra columns are ignored by the report and carried by :func:`survivors`. An empty batch gives
an empty report and appends nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.common import Run, join_hot, plain_lower, read

#: Digests per bucket that a default index is laid out for; 2 million rows are about 80 MB.
BUCKET_ROWS = 2_000_000


def digest_of(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased, as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(plain_lower(F.coalesce(text, F.lit(""))), 256))


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


class DigestIndex:
    """The digests kept so far and the document that stays for each, in a folder that outlives sessions.

    The number of buckets is fixed when the folder is made and stored in it. Opening takes the stored one; asking for
    another is an error, since a bucket read with another layout would miss its digests. :meth:`copied` writes the
    index anew, with more buckets or to have one file a bucket again.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark, self.folder = spark, folder
        layout = f"{folder}/_layout"
        if _exists(spark, layout):
            stored = spark.read.schema("buckets int").json(layout).first()[0]
            if buckets not in (None, stored):
                raise ValueError(f"The index has {stored} buckets, not {buckets}: {folder}")
            buckets = stored
        elif buckets is None:
            raise ValueError(f"There is no index yet: {folder}")
        elif _exists(spark, folder):
            raise ValueError(f"The folder holds something else: {folder}")
        else:
            spark.range(0, 1, 1, 1).select(F.lit(buckets).cast("int").alias("buckets")).write.json(layout)
        self.buckets = buckets
        self.table = f"digest_index_{hashlib.sha256(folder.encode()).hexdigest()[:40]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )

    def copied(self, folder: str, buckets: int | None = None) -> DigestIndex:
        """The same entries in a new folder: one file a bucket, in as many buckets as before or as given."""
        other = DigestIndex(self.spark, folder, buckets or self.buckets)
        other.append(self.entries())
        return other

    def entries(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def missing(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` (one per digest) whose digest is not in the index."""
        return groups.join(self.entries().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        """Add digests with the document that stays. One task writes one bucket, sorted."""
        (
            groups.select("digest", "keep_id").repartition(self.buckets, "digest")
            .write.mode("append").format("parquet").option("path", self.folder)
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table)
        )


def dedup(docs: DataFrame, index: DigestIndex, run: Run) -> DataFrame:
    """Report per row of ``docs``: doc_id, digest, keep_id, group_size (equal rows in this batch), kept.

    Of equal texts of one batch the largest ``doc_id`` stays, unless the index already names another
    document. A batch that is run again after a failure finds its own entries and gives the same report.
    """
    rows = run.write(docs.select(F.col("doc_id").cast("long"), digest_of(F.col("text")).alias("digest")), "digests")
    groups = run.write(
        rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups"
    )
    index.append(run.write(index.missing(groups), "new"))
    facts = groups.drop("keep_id").join(index.entries().hint("merge"), "digest")
    report = join_hot(rows, facts, "digest", "group_size", rows.count())
    return report.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def survivors(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that the index names, each once, with all their columns.

    The join is on digest and document together, so a text with very many copies spreads.
    """
    keys = index.entries().select(F.col("digest").alias("_digest"), F.col("keep_id").alias("_keep"))
    rows = docs.withColumn("_digest", digest_of(F.col("text"))).withColumn("_keep", F.col("doc_id").cast("long"))
    # A group that has no doc_id at all is entered with a null one, which no plain equality finds.
    joined = rows.join(
        keys, (rows["_digest"] == keys["_digest"]) & rows["_keep"].eqNullSafe(keys["_keep"]), "left_semi"
    )
    return joined.dropDuplicates(["_digest", "_keep"]).drop("_digest", "_keep")


def new_index(run: Run, rows: int) -> DigestIndex:
    """An empty index in the run folder, laid out for ``rows`` digests."""
    return DigestIndex(run.spark, f"{run.folder}/index", max(8, -(-rows // BUCKET_ROWS)))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` as the first batch of an empty index: which rows stay, and for which others."""
    docs, run = read(spark, sf_dir, "documents"), Run(spark, "op1")
    report = dedup(docs, new_index(run, docs.count()), run)
    return report.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP1_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d
"""
