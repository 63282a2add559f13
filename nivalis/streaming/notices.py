"""Notification stream: new object -> parse -> validate -> route -> register.

Structured Streaming over the arriving records; each micro-batch is registered
by ``foreachBatch`` and written into its own folder keyed by batch id, so a
replayed batch overwrites itself (idempotent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..fixtures import Fixtures
from ..operators import catalog as C
from ..session import scratch_path


def run_notice_stream(spark: SparkSession, sf_dir: str, trigger_files: int = 1) -> DataFrame:
    """Registry rows of all notices, taken as they arrive.

    A micro-batch is a plain table inside ``foreachBatch``, so its files meet
    their inventories in the same plan as in batch.
    """
    from ..plans.q_records import ROUTE_PREFIX, announced_of, band_inventory_json, filetype_products

    fx = Fixtures(spark, sf_dir)
    schema = fx.t("events").schema
    events = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .option("maxFilesPerTrigger", trigger_files).parquet(sf_dir))
    inventories = scratch_path(spark, "inventories")
    band_inventory_json(fx).write.parquet(inventories)
    out, ckpt = scratch_path(spark, "notice-sink"), scratch_path(spark, "notice-ckpt")

    def register_batch(batch: DataFrame, batch_id: int) -> None:
        rows = C.registrations(announced_of(batch), fx.acquirable, spark.read.parquet(inventories), C.recipes(spark), filetype_products(fx), ROUTE_PREFIX)
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = (Fixtures.notice_of(events).writeStream.foreachBatch(register_batch)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).drop("batch")
