"""Sharding by jump consistent hashing.

A document's key (its doc_id) and the number of shards alone decide its shard:
no ring, no table.  Appending one shard moves 1 / (n + 1) of the rows, and only
into the new shard.  Slots number the rows of a shard without a gap; they come
from a range sort of small digest rows (never the texts), a running count per
(partition, shard) and the offsets of those counts, so no shard is gathered in
one task.

Defined cases: a null text has size 8 and the crc32 of the empty text; a null
doc_id is keyed as 0; repeated rows get slots of their own; ties in the sort are
between equal rows only, which a running number splits over partitions; an
empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Fixed values of the published algorithm: multiplier of its linear congruential generator, and 2**31.
JUMP_MULTIPLIER = 2862933555777941757
JUMP_RANGE = 1 << 31


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key, for all keys at once; the loop ends after O(log shards) turns."""
    key = keys.astype(np.int64).view(np.uint64).copy()
    at = np.zeros(len(key), np.int64)
    ahead = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        at[live] = ahead[live]
        with np.errstate(over="ignore"):
            key[live] = key[live] * np.uint64(JUMP_MULTIPLIER) + np.uint64(1)
        step = (key[live] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[live] = ((at[live] + 1).astype(np.float64) * (JUMP_RANGE / step)).astype(np.int64)
        live = live[ahead[live] < shards]
    return at


def assign(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, shard and grown_shard (with one shard more) of every row."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))

    def place(batches):
        for batch in batches:
            keys = np.nan_to_num(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(jump_hash(keys, shards), pa.int32()),
                 pa.array(jump_hash(keys, shards + 1), pa.int32())],
                names=["doc_id", "size", "text_crc32", "shard", "grown_shard"])

    return rows.mapInArrow(place, "doc_id long, size long, text_crc32 long, shard int, grown_shard int")


def number(rows: DataFrame, shards: int) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... within each shard, by doc_id, text_crc32 and size."""
    spark = rows.sparkSession
    rows = stage(rows.withColumn("seq", F.monotonically_increasing_id()), "shard_rows")
    order = ["doc_id", "text_crc32", "size", "seq"]

    def count(batches):
        seen = np.zeros(shards, np.int64)
        for batch in batches:
            shard = batch.column("shard").to_numpy(zero_copy_only=False)
            by = np.argsort(shard, kind="stable")
            starts = np.searchsorted(shard[by], np.arange(shards))
            place = np.empty(len(shard), np.int64)
            place[by] = np.arange(len(shard)) - starts[shard[by]] + seen[shard[by]]
            seen += np.bincount(shard, minlength=shards)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*batch.schema.names, "place"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = stage(ordered.withColumn("part", F.spark_partition_id())
                   .mapInArrow(count, "doc_id long, size long, text_crc32 long, shard int, grown_shard int, "
                                      "seq long, part int, place long"), "shard_places")
    # One row per (partition, shard): the running sum is over partitions, not documents.
    ahead = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
              .select("shard", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start")))
    return (placed.join(starts, ["shard", "part"])
            .withColumn("slot", F.col("start") + F.col("place")).drop("start", "place", "part", "seq"))


def write_shards(docs: DataFrame, shards: int, path: str) -> str:
    """Write whole documents to one folder per shard, each from the task that reads it: only the ids pass through Python.

    Returns the name of the folder column: ``shard``, with as many underscores behind it as set it apart from the
    table's own columns.
    """
    name = "shard"
    while name.lower() in map(str.lower, docs.columns):
        name += "_"

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(ids.to_numpy(), shards), dtype="int32")

    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))
    docs.withColumn(name, shard_of(key)).write.partitionBy(name).parquet(path)
    return name
