"""Idempotent product-file registration from a stream of candidates.

The uniqueness rule (product, version, datetime) is unbounded state, so it
is not kept in streaming state: each micro-batch is anti-joined with the
registry as stored, inside ``foreachBatch``.  Batch b writes only the
folder ``batch=b`` and ignores that folder when reading the registry, so a
replay of b recomputes the same inserts and overwrites them.  The registry is
partitioned by the month of ``datetime``; a batch reads only its own months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..operators import catalog as C
from ..session import scratch_path

COLUMNS = ["file_id", "product_id", "datetime", "version"]


def month_of(col: str = "datetime"):
    """yyyymm as a number; 0 where there is no datetime."""
    return F.coalesce(F.year(col) * 100 + F.month(col), F.lit(0)).alias("month")


def write_batch(rows: DataFrame, registry_path: str, batch_id: int) -> None:
    by_month = rows.select(*COLUMNS, month_of())
    (by_month.repartition("month").write.mode("overwrite").partitionBy("month")
     .parquet(f"{registry_path}/batch={batch_id}"))


def registry_rows(spark: SparkSession, registry_path: str, batch_id: int | None = None, months: list[int] | None = None) -> DataFrame:
    """The registry as stored, without one batch and of some months only (both prune folders)."""
    rows = spark.read.parquet(registry_path)
    if batch_id is not None:
        rows = rows.where(F.col("batch") != batch_id)
    if months is not None:
        rows = rows.where(F.col("month").isin(months))
    return rows.select(*COLUMNS)


def upsert_batch(registry_path: str):
    def sink(df: DataFrame, batch_id: int):
        months = [r.month for r in df.select(month_of()).distinct().collect()]   # at most the months of a calendar
        if months:
            current = registry_rows(df.sparkSession, registry_path, batch_id, months)
            write_batch(C.registry_inserts(df.select(*COLUMNS), current), registry_path, batch_id)
    return sink


def run_registry_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    from ..plans.q_records import _existing
    reg = scratch_path(spark, "registry")
    write_batch(C.with_default_version(_existing(fx)), reg, -1)
    schema = fx.t("orders").schema
    orders = (spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet")
              .option("maxFilesPerTrigger", 1).parquet(sf_dir))
    cand = Fixtures.productfile_of(orders)
    q = (cand.writeStream.foreachBatch(upsert_batch(reg))
         .option("checkpointLocation", scratch_path(spark, "registry-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return registry_rows(spark, reg)
