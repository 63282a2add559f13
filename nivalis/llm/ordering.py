"""Positions and running sums in an order, group by group, without gathering a group in one task.

Rows are range-partitioned on (group, order) and written once with the number
of their range; a window runs inside every (group, range), and what lies in the
ranges ahead is added from one row per (group, range).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage


def place(rows: DataFrame, group: list[str], order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """Write the rows range-partitioned, with the number of their range as ``part``."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(rows.repartitionByRange(parts, *group, *order).withColumn("part", F.spark_partition_id()), name)


def running(placed: DataFrame, group: list[str], order: list[str], sums: list[str]) -> DataFrame:
    """Add ``pos`` (from 0 in each group) and ``<name>_run``, the sum of each of ``sums`` up to and with the row.

    ``placed`` is a table of ``place`` or any part of its rows; equal places in
    ``order`` are numbered in any way, so it should end with a unique column.
    """
    ahead = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in sums])
    starts = totals.select(*group, "part", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"{c}_ahead")
                                             for c in ["n", *sums]])
    inside = Window.partitionBy(*group, "part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mine = placed.select("*", F.row_number().over(inside).alias("n_here"),
                         *[F.sum(c).over(upto).alias(f"{c}_here") for c in sums])
    return mine.join(starts, [*group, "part"]).select(
        *placed.columns, (F.col("n_ahead") + F.col("n_here") - 1).alias("pos"),
        *[(F.col(f"{c}_ahead") + F.col(f"{c}_here")).alias(f"{c}_run") for c in sums])
