"""Average overview pyramid and exact band statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Overview factors of every product.
OVERVIEW_LEVELS = (2, 4, 8, 16, 32, 64, 128, 256, 512, 1024, 2048)


def levels_for(n_rows: int, n_cols: int, levels=OVERVIEW_LEVELS) -> list[int]:
    """Factors that still fit the lattice (a level beyond it would repeat the last block)."""
    return [f for f in levels if f <= max(n_rows, n_cols)]


def overview_pyramid(cells: DataFrame, levels=OVERVIEW_LEVELS, value_col: str = "v", keys=("t",)) -> DataFrame:
    """Mean of valid base cells per block at every level (powers of two), carried as (sum, count).

    Each level is aggregated from the one below, so the shuffles move a
    quarter, a sixteenth, ... of the base: a third of it in all.  A level's
    exchange feeds both its output and the next level (exchange reuse).
    Carrying sum and count keeps each level the exact mean of its base cells.
    """
    v, below, out = F.col(value_col), cells, None
    total, count = F.sum(v).alias("s"), F.count(v).alias("n")
    for level in range(1, max(int(f) for f in levels).bit_length()):
        below = below.groupBy(*keys, F.floor(F.col("r") / 2).cast("int").alias("r"),
                              F.floor(F.col("c") / 2).cast("int").alias("c")).agg(total, count)
        total, count = F.sum("s").alias("s"), F.sum("n").alias("n")
        if 1 << level in levels:
            mean = below.select(*keys, F.lit(1 << level).alias("level"), F.col("r").alias("br"), F.col("c").alias("bc"),
                                (F.col("s") / F.col("n")).alias("v_mean"), F.col("n").alias("v_count"))
            out = mean if out is None else out.unionByName(mean)
    return out


def band_statistics(cells: DataFrame, value_col: str = "v", keys=("t",)) -> DataFrame:
    """Exact min, max, mean, population stddev of valid cells per grid."""
    v = F.col(value_col)
    return cells.groupBy(*keys).agg(
        F.min(v).alias("v_min"), F.max(v).alias("v_max"),
        F.avg(v).alias("v_mean"), F.stddev_pop(v).alias("v_stddev"),
        F.count(v).alias("v_count"))
