"""Zones (polygons) on a cell lattice: edges, scanline rasterisation, zonal statistics.

A zone arrives as a vertex table ``(zone keys..., i, x, y)`` in lattice units
(x = column, y = row; the centre of cell (r, c) is (c + 0.5, r + 0.5)).  A
cell belongs to a zone when its centre is inside under the even-odd rule.

Spark will not plan a pure range predicate (``xa <= c + 0.5 < xb``) as
anything but a nested-loop join, so the rasteriser gives every piece an equi
key itself: edges are exploded onto the rows they cross (``sequence``), and the
crossings in a row, of all rings of the zone (holes and parts), are paired
into spans of cells by a window over (zone, row).  Spans are cut at column
tiles, so they meet the value grid in an equi join on (row, column tile) with
the span as a residual test.  The membership grows with the outline, not with
the covered area.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COLUMN_TILE = 64


def _int_range(lo: Column, hi: Column) -> Column:
    """``sequence(lo, hi)`` that is empty (not descending) when lo > hi."""
    lo, hi = lo.cast("int"), hi.cast("int")
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def zone_edges(vertices: DataFrame, keys=("z",)) -> DataFrame:
    """Closed ring edges: each vertex to the next of its ring, the last one back to the first."""
    rings = ["ring"] if "ring" in vertices.columns else []
    w = Window.partitionBy(*keys, *rings).orderBy("i")
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return vertices.select(
        *keys, "i",
        F.col("x").alias("x1"), F.col("y").alias("y1"),
        F.coalesce(F.lead("x").over(w), F.first("x").over(w_all)).alias("x2"),
        F.coalesce(F.lead("y").over(w), F.first("y").over(w_all)).alias("y2"),
    )


def crossing_x(x1, y1, x2, y2, yc) -> Column:
    """x where the edge meets the horizontal line y = yc."""
    return x1 + (yc - y1) * (x2 - x1) / (y2 - y1)


def zone_spans(edges: DataFrame, n_rows: int, keys=("z",)) -> DataFrame:
    """Per (zone, row): half-open column spans [xa, xb) inside the polygon."""
    x1, y1, x2, y2 = (F.col(n) for n in ("x1", "y1", "x2", "y2"))
    r0 = F.greatest(F.ceil(F.least(y1, y2) - 0.5) - 1, F.lit(0))
    r1 = F.least(F.ceil(F.greatest(y1, y2) - 0.5), F.lit(n_rows - 1))
    rows = edges.where(y1 != y2).select(*keys, "x1", "y1", "x2", "y2",
                                        F.explode(_int_range(r0, r1)).alias("r"))
    yc = F.col("r") + 0.5
    crossings = rows.where((y1 <= yc) != (y2 <= yc)).select(
        *keys, "r", crossing_x(x1, y1, x2, y2, yc).alias("xi"))
    w = Window.partitionBy(*keys, "r").orderBy("xi")
    ranked = crossings.select(
        *keys, "r", F.col("xi").alias("xa"),
        F.lead("xi").over(w).alias("xb"),
        F.row_number().over(w).alias("k"),
    )
    return ranked.where((F.col("k") % 2 == 1) & F.col("xb").isNotNull()).drop("k")


def zone_members(vertices: DataFrame, n_rows: int, n_cols: int, keys=("z",)) -> DataFrame:
    """Membership (zone keys, r, ct, lo, hi): columns lo..hi of row r, within column tile ct, lie inside the zone."""
    return edge_members(zone_edges(vertices, keys), n_rows, n_cols, keys)


def edge_members(edges: DataFrame, n_rows: int, n_cols: int, keys=("z",)) -> DataFrame:
    """:func:`zone_members` of the edges (zone keys, x1, y1, x2, y2) of closed rings in lattice units."""
    spans = zone_spans(edges, n_rows, keys)
    # Cell c is inside when xa <= c + 0.5 < xb.
    cells = spans.select(*keys, "r", F.greatest(F.ceil(F.col("xa") - 0.5), F.lit(0)).cast("int").alias("c0"),
                         F.least(F.ceil(F.col("xb") - 0.5) - 1, F.lit(n_cols - 1)).cast("int").alias("c1"))
    tiles = cells.where("c0 <= c1").select("*", F.explode(F.sequence(
        F.floor(F.col("c0") / COLUMN_TILE).cast("int"), F.floor(F.col("c1") / COLUMN_TILE).cast("int"))).alias("ct"))
    return tiles.select(*keys, "r", "ct", F.greatest("c0", F.col("ct") * COLUMN_TILE).alias("lo"),
                        F.least("c1", (F.col("ct") + 1) * COLUMN_TILE - 1).alias("hi"))


def zone_cells(vertices: DataFrame, n_rows: int, n_cols: int, keys=("z",)) -> DataFrame:
    """Membership cell by cell (zone keys, r, c): cells whose centre lies inside the zone."""
    return zone_members(vertices, n_rows, n_cols, keys).select(*keys, "r", F.explode(F.sequence("lo", "hi")).alias("c"))


def zone_cell_join(values: DataFrame, members: DataFrame) -> DataFrame:
    """Attach zone keys to value cells: equi join on (r, column tile), the span as residual test.

    The value side is first cut to the envelope of all zones (one scalar
    subquery, evaluated before the scan).  Which side travels is Spark's
    choice by size: the membership is broadcast where it is below
    ``spark.sql.autoBroadcastJoinThreshold``, and only there.
    """
    env = members.agg(F.struct(F.min("r").alias("r0"), F.max("r").alias("r1"),
                               F.min("lo").alias("c0"), F.max("hi").alias("c1")).alias("e")).scalar()
    cut = values.where(F.col("r").between(env["r0"], env["r1"]) & F.col("c").between(env["c0"], env["c1"]))
    tiled = cut.withColumn("ct", F.floor(F.col("c") / COLUMN_TILE).cast("int"))
    return tiled.join(members, ["r", "ct"]).where(F.col("c").between(F.col("lo"), F.col("hi"))).drop("ct", "lo", "hi")


def zonal_stats(values: DataFrame, members: DataFrame, zone_names: DataFrame,
                value_col: str = "v", time_col: str = "t", prefix: str = "",
                keys=("z",), times: DataFrame | None = None) -> DataFrame:
    """min, max, mean, count of valid cells per (time, zone).

    ``zone_names`` holds one row per zone (keys + descriptive columns).  Every
    zone appears for every time step; a zone without valid cells gets count 0
    and NULL statistics.  The (time x zone) frame is produced by exploding the
    set of time steps on each zone row, not by a join without keys.
    ``times`` (one column ``time_col``) names the steps when they are known
    without scanning the values, e.g. from the partition list of the grid.
    """
    joined = zone_cell_join(values.select(time_col, "r", "c", value_col), members)
    v = F.col(value_col)
    stats = joined.groupBy(time_col, *keys).agg(
        F.min(v).alias(f"{prefix}min"), F.max(v).alias(f"{prefix}max"),
        F.avg(v).alias("_mean"), F.count(v).alias(f"{prefix}count"),
    )
    src = times if times is not None else values
    steps = src.agg(F.collect_set(time_col).alias("ts")).select("ts").scalar()
    frame = zone_names.select("*", F.explode(steps).alias(time_col))
    out = frame.join(stats, on=[time_col, *keys], how="left")
    return out.select(
        *frame.columns,
        f"{prefix}min", f"{prefix}max",
        F.col("_mean").alias(f"{prefix}mean"),
        F.coalesce(F.col(f"{prefix}count"), F.lit(0)).cast("bigint").alias(f"{prefix}count"),
    )


def zone_envelope(vertices: DataFrame, keys=("z",)) -> DataFrame:
    """Envelope (xmin, ymin, xmax, ymax) of every zone."""
    return vertices.groupBy(*keys).agg(
        F.min("x").alias("xmin"), F.min("y").alias("ymin"),
        F.max("x").alias("xmax"), F.max("y").alias("ymax"))


# --------------------------------------------------------------------- oracle
def sql_zone_members(zone_view="v_zone", lattice_sql="select r, c, c + 0.5 as px, r + 0.5 as py from (select distinct r, c from v_lattice) x",
                     ring="z") -> list[tuple[str, str]]:
    """DuckDB CTEs ``z_edges`` and ``z_inside`` by ray casting (crossing count parity over all rings).

    ``lattice_sql`` gives the cells and their centres (px, py) in the units of the zones.
    """
    return [
        ("z_edges", f"""
select z, x as x1, y as y1,
       coalesce(lead(x) over (partition by z, {ring} order by i), first_value(x) over (partition by z, {ring} order by i)) as x2,
       coalesce(lead(y) over (partition by z, {ring} order by i), first_value(y) over (partition by z, {ring} order by i)) as y2
from {zone_view}"""),
        ("z_inside", f"""
select e.z, p.r, p.c
from ({lattice_sql}) p join z_edges e
  on (e.y1 <= p.py) <> (e.y2 <= p.py)
 and p.px < e.x1 + (p.py - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
group by e.z, p.r, p.c
having count(*) % 2 = 1"""),
    ]
