"""File listings as tables: what lies in a folder now, and what changed since the last snapshot.

Paths and sizes come from Spark's file source without reading a byte of
content.  A snapshot is a table of its own, so the next listing is compared
with it by a join on the path, not by looking at the files again.  Spark's
source passes over empty files, so a file counts from its first byte on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .rasters import read_binary


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """path, file (last part of the path), n_bytes of every file below a folder."""
    files = read_binary(spark, folder, glob).select("path", F.col("length").alias("n_bytes"))
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), "n_bytes")


def write_snapshot(listing: DataFrame, path: str) -> DataFrame:
    """Keep a listing as a table; the table."""
    listing.write.mode("error").parquet(path)
    return listing.sparkSession.read.schema(listing.schema).parquet(path)


def compare(now: DataFrame, last: DataFrame) -> DataFrame:
    """file, n_bytes and ``state`` of every path of either listing: new, changed (other size), same or gone."""
    a, b = now.select("path", "file", "n_bytes", F.lit(True).alias("_now")), last.select("path", F.col("file").alias("_f"), F.col("n_bytes").alias("_n"))
    state = (F.when(F.col("_n").isNull(), "new").when(F.col("_now").isNull(), "gone")
             .when(F.col("n_bytes") != F.col("_n"), "changed").otherwise("same"))
    return a.join(b, "path", "full").select("path", F.coalesce("file", "_f").alias("file"), F.coalesce("n_bytes", "_n").alias("n_bytes"), state.alias("state"))


def against_spine(states: DataFrame, spine: DataFrame, name_col: str = "archive") -> DataFrame:
    """Every expected file of ``spine`` with its state; one that is in neither listing is missing."""
    found = states.groupBy(F.col("file").alias(name_col)).agg(F.max("state").alias("state"))
    return spine.join(found, name_col, "left").withColumn("state", F.coalesce("state", F.lit("missing")))
