"""Exact deduplication against a persistent digest index (DataFrame operations only).

The index is a Parquet table bucketed and sorted by the SHA-256 of the
normalised text.  A batch is first reduced to one row per digest (partial
aggregation in every scan task, so a text that makes up a third of all rows is
collapsed before the shuffle), then sort-merge anti-joined with the index and
the rows that are new are appended bucket by bucket: the index itself is never
shuffled again.  Of digests the index knows, the batch appends how many rows it
had, so that group sizes count all batches; ``compact`` turns the appended rows
back into one per digest.

Defined cases: a null text counts as empty; empty texts are equal to each other
and to texts of white space only; of equal texts the one with the most code
points, then the smallest doc_id stays (a null doc_id comes last); what an earlier
batch kept stays kept, also when a later one brings a longer text of the group, as
it has been handed on by then; rows repeated
with the same doc_id and text are one document to the decision (``decide`` marks
each of them, ``drop_duplicates`` keeps one); an empty table gives an empty
result; other columns, whatever their names, are carried along untouched.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import WHITE_SPACE, stage

#: Groups holding at least this part of all rows are joined by broadcast; there are at most so many.
HEAVY_SHARE = 1 / 10_000
INDEX_SCHEMA = "digest string, keep_id long, keep_chars int, group_size long"


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for ch in WHITE_SPACE:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


class DigestIndex:
    """Bucketed digest table at ``path`` (a folder all executors see)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} ({INDEX_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def table(self) -> DataFrame:
        """One row per digest: the row of its first batch, and the group's size over all batches."""
        return (self.spark.table(self.name).groupBy("digest")
                .agg(F.first("keep_id", ignorenulls=True).alias("keep_id"), F.max("keep_chars").alias("keep_chars"),
                     F.sum("group_size").alias("group_size")))

    def new_of(self, groups: DataFrame) -> DataFrame:
        """Groups whose digest the index does not have yet (sort-merge anti-join)."""
        return groups.join(self.spark.table(self.name).select("digest").hint("merge"), "digest", "left_anti")

    def repeated_of(self, groups: DataFrame) -> DataFrame:
        """Counts of the groups whose digest the index has: rows without a document of their own."""
        known = self.spark.table(self.name).filter("keep_chars >= 0").select("digest").hint("merge")
        return groups.join(known, "digest", "left_semi").select(
            "digest", F.lit(None).cast("long").alias("keep_id"), F.lit(-1).alias("keep_chars"), "group_size")

    def compact(self, path: str) -> DigestIndex:
        """The index in a new folder with one row per digest, a sorted file per bucket; this one is given up."""
        whole = DigestIndex(self.spark, path, self.buckets)
        whole.append(self.table())
        self.close()
        return whole

    def close(self) -> None:
        """Take the table out of the catalog; its files stay where they are."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def append(self, groups: DataFrame) -> None:
        cols = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]
        (groups.select(*cols).repartition(self.buckets, "digest").write.format("parquet").mode("append")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))
        self.spark.catalog.refreshTable(self.name)


def groups_of(rows: DataFrame) -> DataFrame:
    """One row per digest of ``rows`` (doc_id, digest, n_cp): who stays, and how many there are."""
    best = F.min(F.struct((-F.col("n_cp")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    return (rows.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
            .select("digest", F.col("best.doc_id").alias("keep_id"), (-F.col("best.less")).alias("keep_chars"),
                    "group_size"))


def ingest(docs: DataFrame, index: DigestIndex) -> tuple[DataFrame, DataFrame]:
    """Add a batch to the index; returns its rows (doc_id, digest, n_cp) and its new groups, each written once."""
    rows = stage(docs.select("doc_id", digest(F.col("text")).alias("digest"),
                             F.char_length(F.coalesce("text", F.lit(""))).alias("n_cp")), "digests")
    # What is appended is written before, as an append would otherwise read the table it adds to.
    groups = stage(groups_of(rows), "batch_digests")
    new, repeated = stage(index.new_of(groups), "new_digests"), stage(index.repeated_of(groups), "repeated_digests")
    index.append(new.unionByName(repeated))
    return rows, new


def decide(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows, _ = ingest(docs, index)
    groups = index.table().select("digest", "keep_id", "group_size")
    n_rows = groups.agg(F.sum("group_size")).first()[0] or 0
    heavy = F.col("group_size") > F.lit(max(1.0, n_rows * HEAVY_SHARE))
    # Heavy groups: at most 1 / HEAVY_SHARE rows by construction, so their broadcast is bounded.
    by_heavy = rows.join(F.broadcast(groups.filter(heavy)), "digest")
    heavy_keys = F.broadcast(groups.filter(heavy).select("digest"))
    by_light = rows.join(heavy_keys, "digest", "left_anti").join(groups.filter(~heavy), "digest")
    return by_heavy.unionByName(by_light).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def new_index(spark: SparkSession) -> DigestIndex:
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return DigestIndex(spark, scratch_path(spark, "digest-index"), buckets)


def drop_duplicates(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Documents that stay, with all their columns; one row of each group new to the index."""
    cols = docs.columns
    mark = f"digest_{uuid.uuid4().hex[:8]}"
    _, groups = ingest(docs, index)
    keys = groups.select(F.col("digest").alias(mark), F.col("keep_id").alias(f"{mark}_id"),
                         F.col("keep_chars").alias(f"{mark}_cp"))
    marked = docs.withColumn(mark, digest(F.col("text")))
    same = (F.col("doc_id").eqNullSafe(F.col(f"{mark}_id"))
            & (F.char_length(F.coalesce("text", F.lit(""))) == F.col(f"{mark}_cp")))
    return marked.join(keys, mark).filter(same).dropDuplicates([mark]).select(*cols)
