"""Grid sinks: tables of georeferenced tiles; header CSV."""

from __future__ import annotations

import json
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # executors need no installed package

TILE = 256   # cells per side of a stored tile


# ------------------------------------------------------- georeferenced grids
#: Name of the metadata entry that a band's column carries through Parquet.
GRID_INFO = "grid"


def z_order(a, b, bits: int = 16) -> Column:
    """Bits of two tile numbers interleaved: neighbours on the map are near on this curve."""
    def bit(x, i: int, to: int):
        return F.shiftleft(F.shiftright(x, i).bitwiseAND(F.lit(1)).cast("long"), to)

    out = F.lit(0).cast("long")
    for i in range(bits):
        out = out.bitwiseOR(bit(F.col(a), i, 2 * i + 1)).bitwiseOR(bit(F.col(b), i, 2 * i))
    return out


def write_grid(cells: DataFrame, corners: DataFrame, path: str, bands, n_rows: int, n_cols: int, crs: str,
               nodata: float = -9999.0, tile: int = TILE, partitions: int | None = None) -> None:
    """Persist grids (t, r, c, one column per band) as a table of tiles with their place on the map.

    ``corners`` (t, ulx, uly, lrx, lry) places each step.  A row is a tile: its
    rows and columns (r0, c0, h, w), its box in map units (xmin, ymin, xmax,
    ymax) and per band a float array, row by row, with ``nodata`` for missing
    cells.  CRS, nodata, lattice and tile size stand in the metadata of the
    band columns, which Parquet keeps with the table.  Steps are folders;
    within one, tiles follow a space-filling curve, so a file covers a compact
    area and its statistics let a window skip it.
    """
    info = json.dumps({"crs": crs, "nodata": nodata, "n_rows": n_rows, "n_cols": n_cols, "tile": tile})
    bands = list(bands)
    tiled = cells.select("t", "r", "c", *[F.col(b).cast("float").alias(b) for b in bands]).select(
        "*", F.floor(F.col("r") / tile).cast("int").alias("tr"), F.floor(F.col("c") / tile).cast("int").alias("tc"))
    schema = T.StructType([cells.schema["t"], *[T.StructField(n, T.IntegerType()) for n in ("tr", "tc", "r0", "c0", "h", "w")],
                           *[T.StructField(b, T.ArrayType(T.FloatType())) for b in bands]])

    def pack(table: pa.Table) -> pa.Table:
        tr, tc = table.column("tr")[0].as_py(), table.column("tc")[0].as_py()
        r0, c0 = tr * tile, tc * tile
        h, w = min(tile, n_rows - r0), min(tile, n_cols - c0)
        at = (table.column("r").to_numpy().astype(np.int64) - r0) * w + table.column("c").to_numpy().astype(np.int64) - c0
        arrays = []
        for b in bands:
            v = table.column(b).to_numpy(zero_copy_only=False).astype(np.float32)
            full = np.full(h * w, nodata, np.float32)
            full[at] = np.where(np.isnan(v), np.float32(nodata), v)
            arrays.append(pa.ListArray.from_arrays(pa.array([0, h * w], pa.int32()), pa.array(full)))
        numbers = [pa.array([x], pa.int32()) for x in (tr, tc, r0, c0, h, w)]
        return pa.Table.from_arrays([table.column("t").slice(0, 1).combine_chunks(), *numbers, *arrays], names=schema.names)

    tiles = tiled.groupBy("t", "tr", "tc").applyInArrow(pack, schema).join(corners.select("t", "ulx", "uly", "lrx", "lry"), "t")
    dx, dy = (F.col("lrx") - F.col("ulx")) / n_cols, (F.col("uly") - F.col("lry")) / n_rows
    placed = tiles.select(
        "t", z_order("tr", "tc").alias("z"), "r0", "c0", "h", "w",
        (F.col("ulx") + F.col("c0") * dx).alias("xmin"), (F.col("uly") - (F.col("r0") + F.col("h")) * dy).alias("ymin"),
        (F.col("ulx") + (F.col("c0") + F.col("w")) * dx).alias("xmax"), (F.col("uly") - F.col("r0") * dy).alias("ymax"),
        *[F.col(b).alias(b, metadata={GRID_INFO: info}) for b in bands])
    n = partitions or int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (placed.repartitionByRange(n, "t", "z").sortWithinPartitions("t", "z")
     .write.mode("overwrite").partitionBy("t").option("compression", "zstd").parquet(path))


def grid_info(tiles: DataFrame) -> dict:
    """CRS, nodata, lattice and tile size of a table of tiles, and its bands."""
    found = {f.name: f.metadata[GRID_INFO] for f in tiles.schema.fields if GRID_INFO in f.metadata}
    if not found:
        raise ValueError("no band of this table carries a georeference")
    return {**json.loads(next(iter(found.values()))), "bands": list(found)}


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_area(spark: SparkSession, path: str, xmin: float, ymin: float, xmax: float, ymax: float, t_from=None, t_to=None) -> DataFrame:
    """Tiles that touch a window in map units: steps by folder, tiles by the statistics of their boxes."""
    cond = (F.col("xmin") < xmax) & (F.col("xmax") > xmin) & (F.col("ymin") < ymax) & (F.col("ymax") > ymin)
    if t_from is not None:
        cond = cond & (F.col("t") >= t_from)
    if t_to is not None:
        cond = cond & (F.col("t") < t_to)
    return read_grid(spark, path).where(cond)


def grid_cells(tiles: DataFrame, area=None, bands=None) -> DataFrame:
    """Tiles as cells: t, r, c, centre x, y in map units, one column per band (nodata as NULL).

    With ``area`` (xmin, ymin, xmax, ymax) only cells whose centre lies in it.
    """
    info = grid_info(tiles)
    bands = list(bands or info["bands"])
    values = F.posexplode(F.arrays_zip(*bands)).alias("i", "v")
    x = tiles.select("t", "r0", "c0", "h", "w", "xmin", "ymin", "xmax", "ymax", values)
    row, col = F.floor(F.col("i") / F.col("w")), F.col("i") % F.col("w")
    out = x.select(
        "t", (F.col("r0") + row).cast("int").alias("r"), (F.col("c0") + col).cast("int").alias("c"),
        (F.col("xmin") + (col + 0.5) * (F.col("xmax") - F.col("xmin")) / F.col("w")).alias("x"),
        (F.col("ymax") - (row + 0.5) * (F.col("ymax") - F.col("ymin")) / F.col("h")).alias("y"),
        *[F.nullif(F.col("v")[b].cast("double"), F.lit(float(info["nodata"]))).alias(b) for b in bands])
    if area is None:
        return out
    xmin, ymin, xmax, ymax = area
    return out.where((F.col("x") >= xmin) & (F.col("x") < xmax) & (F.col("y") > ymin) & (F.col("y") <= ymax))


def append_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", "false").csv(path)
