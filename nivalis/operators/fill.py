"""Gap filling: nearest valid cell per quadrant within a distance, inverse-distance mean.

Definition: for a NULL cell, look in each quadrant (dx <= 0 or > 0, dy <= 0
or > 0) for the nearest valid cell with Euclidean distance <= D (ties: the
smaller |dx|).  The filled value is ``sum(v * d^-p) / sum(d^-p)`` over the
quadrants that found one (p = 1 by default), NULL if none.  Valid cells are
left alone; only original valid cells are used as sources.

Plan: the grid is cut into square tiles; a valid cell within D of a
neighbouring tile is copied to it as halo (a factor (1 + 2D / TILE)^2 on the
rows, 1.3 at the published D = 35), so every tile holds all the sources of its own
cells.  One shuffle on (keys, tile) brings the tiles together, and an
Arrow kernel fills each: two running passes over the columns give the nearest valid
row above and below every cell, and because within a quadrant and a column
offset only that cell can be the nearest, each hole looks at 2(2D + 1)
candidates, one column offset at a time for all holes of the tile.  Work is
linear in the cells, whatever the shape of the grid, and a task
holds one tile, never a grid.

Where only windows of the grid are wanted (``windows``: boxes of rows r0..r1
and columns c0..c1), they go through the fill as window plus D: the cells are
first cut to the windows' envelope, then to the windows, empty cells to the
windows themselves and valid ones to D around them, by a semi-join on tiles.
What is shuffled and filled grows with the windows, not with the grid.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # executors need no installed package

TILE = 512
FAR = 1 << 20           # a row offset no tile has; key = d^2 * FAR + |dx| orders by distance, then by |dx|


def quadrants(grid: np.ndarray, i: np.ndarray, j: np.ndarray, D: int):
    """For holes (i, j) of a dense array (NaN = no value): (d2, value) arrays of shape 4 x holes, d2 = -1 for none.

    Quadrant q = 2 * (dx > 0) + (dy > 0).
    """
    rows, cols = grid.shape
    valid, at = ~np.isnan(grid), np.arange(rows)[:, None]
    up = np.maximum.accumulate(np.where(valid, at, -FAR), axis=0)
    below = np.minimum.accumulate(np.where(valid, at, FAR)[::-1], axis=0)[::-1]
    down = np.full_like(below, FAR)
    down[:-1] = below[1:]
    none = np.iinfo(np.int64).max
    best = np.full((4, len(i)), none)
    row, col = np.zeros((4, len(i)), np.int64), np.zeros((4, len(i)), np.int64)
    for k in range(-D, D + 1):
        jj = j + k
        inside = (jj >= 0) & (jj < cols)
        jj = np.where(inside, jj, 0)
        for q, nearest in ((2 * (k > 0), up), (2 * (k > 0) + 1, down)):
            source = nearest[i, jj]
            d2 = (source - i) ** 2 + k * k
            key = d2 * FAR + abs(k)
            closer = inside & (d2 <= D * D) & (key < best[q])
            best[q][closer], row[q][closer], col[q][closer] = key[closer], source[closer], jj[closer]
    found = best < none
    return np.where(found, best // FAR, -1), np.where(found, grid[np.where(found, row, 0), np.where(found, col, 0)], np.nan)


def weighted_mean(d2: np.ndarray, v: np.ndarray, power: float) -> np.ndarray:
    """Inverse-distance mean over the quadrants that found a source; NaN where none did."""
    found = d2 >= 0
    w = np.where(found, np.power(np.sqrt(np.where(found, d2, 1).astype(np.float64)), -power), 0.0)
    den = w.sum(0)
    return np.where(den > 0, (np.where(found, v, 0.0) * w).sum(0) / np.where(den > 0, den, 1.0), np.nan)


def _tiles(cells: DataFrame, D: int, value_col: str, keys) -> DataFrame:
    """Cells with the tiles (tr, tc) they belong to, and valid cells also with those they are halo of."""
    def span(col: str) -> Column:
        return F.sequence(F.greatest(F.floor((F.col(col) - D) / TILE), F.lit(0)).cast("int"),
                          F.floor((F.col(col) + D) / TILE).cast("int"))

    r, c = F.col("r"), F.col("c")
    tiled = (cells.select(*keys, "r", "c", F.col(value_col).cast("double").alias("v"))
             .select("*", F.explode(span("r")).alias("tr")).select("*", F.explode(span("c")).alias("tc")))
    own = (F.floor(r / TILE) == F.col("tr")) & (F.floor(c / TILE) == F.col("tc"))
    return tiled.where(own | F.col("v").isNotNull())


WINDOW_TILE = 128       # cells per side of the tiles on which cells and windows meet


def window_cells(cells: DataFrame, windows: DataFrame, D: int, value_col: str = "v") -> DataFrame:
    """The cells that filling the windows needs: those inside one, and valid ones within D of one."""
    wide = windows.select("r0", "r1", "c0", "c1", (F.col("r0") - D).alias("_r0"), (F.col("r1") + D).alias("_r1"),
                          (F.col("c0") - D).alias("_c0"), (F.col("c1") + D).alias("_c1"))

    def tiles(lo: str, hi: str):
        return F.explode(F.sequence(F.floor(F.greatest(F.col(lo), F.lit(0)) / WINDOW_TILE).cast("int"),
                                    F.floor(F.greatest(F.col(hi), F.lit(0)) / WINDOW_TILE).cast("int")))

    boxes = wide.where("r0 <= r1 and c0 <= c1").select("*", tiles("_r0", "_r1").alias("_tr")).select("*", tiles("_c0", "_c1").alias("_tc"))
    env = wide.agg(F.struct(*[f(c).alias(c) for f, c in ((F.min, "_r0"), (F.max, "_r1"), (F.min, "_c0"), (F.max, "_c1"))])).scalar()
    r, c = F.col("r"), F.col("c")
    near = r.between(env["_r0"], env["_r1"]) & c.between(env["_c0"], env["_c1"])
    tiled = cells.where(near).select("*", F.floor(r / WINDOW_TILE).cast("int").alias("_tr"), F.floor(c / WINDOW_TILE).cast("int").alias("_tc"))
    a, b = tiled.alias("a"), boxes.alias("b")
    inside = F.col("a.r").between(F.col("b.r0"), F.col("b.r1")) & F.col("a.c").between(F.col("b.c0"), F.col("b.c1"))
    source = (F.col(f"a.{value_col}").isNotNull() & F.col("a.r").between(F.col("b._r0"), F.col("b._r1"))
              & F.col("a.c").between(F.col("b._c0"), F.col("b._c1")))
    return a.join(b, (F.col("a._tr") == F.col("b._tr")) & (F.col("a._tc") == F.col("b._tc")) & (inside | source), "left_semi").drop("_tr", "_tc")


def _per_tile(cells: DataFrame, D: int, value_col: str, keys, schema: T.StructType, make) -> DataFrame:
    """Run ``make(own table, own cells' holes mask, d2, values)`` on every tile."""
    tile = TILE

    def run(table: pa.Table) -> pa.Table:
        r, c = (table.column(x).to_numpy().astype(np.int64) for x in ("r", "c"))
        v = table.column("v").to_numpy(zero_copy_only=False).astype(np.float64)  # NULL reads as NaN
        tr, tc = table.column("tr")[0].as_py(), table.column("tc")[0].as_py()
        own = (r // tile == tr) & (c // tile == tc)
        grid = np.full((r.max() - r.min() + 1, c.max() - c.min() + 1), np.nan)
        grid[r - r.min(), c - c.min()] = v
        hole = own & np.isnan(v)
        d2, found = quadrants(grid, r[hole] - r.min(), c[hole] - c.min(), D)
        return make(table.filter(pa.array(own)), hole[own], d2, found)

    return _tiles(cells, D, value_col, keys).groupBy(*keys, "tr", "tc").applyInArrow(run, schema)


def _schema(cells: DataFrame, keys, extra) -> T.StructType:
    return T.StructType([*[cells.schema[k] for k in (*keys, "r", "c")], *extra])


def nearest_valid(cells: DataFrame, max_distance: int, value_col: str = "v", keys=("t",)) -> DataFrame:
    """One row per (NULL cell, quadrant q) that found a source: keys, r, c, q, v, d2."""
    names = [*keys, "r", "c"]

    def make(own, hole, d2, v):
        holes = own.select(names).filter(pa.array(hole))
        q, i = np.nonzero(d2 >= 0)
        picked = holes.take(pa.array(i))
        return pa.Table.from_arrays([*picked.columns, pa.array(q.astype(np.int32)), pa.array(v[q, i]),
                                     pa.array(d2[q, i].astype(np.int32))], names=[*names, "q", "v", "d2"])

    schema = _schema(cells, keys, [T.StructField("q", T.IntegerType()), T.StructField("v", T.DoubleType()),
                                   T.StructField("d2", T.IntegerType())])
    return _per_tile(cells, int(max_distance), value_col, keys, schema, make)


def fill_nodata(cells: DataFrame, max_distance: int = 35, value_col: str = "v",
                keys=("t",), power: float = 1.0, flag: str | None = None, windows: DataFrame | None = None) -> DataFrame:
    """Whole grid with NULL cells filled where a source lies within ``max_distance``.

    With ``windows`` (r0, r1, c0, c1) only what they need is read and filled:
    every cell inside a window is as in the whole grid's fill, and of the
    others some valid ones, within ``max_distance`` of a window, come along.

    With ``flag`` a boolean column of that name tells which cells were NULL
    before the fill.  ``keys`` may hold several grids at once (e.g. product
    and t): they are filled by the same plan, each within its own tiles.
    """
    names = [*keys, "r", "c"]

    def make(own, hole, d2, v):
        out = own.column("v").to_numpy(zero_copy_only=False).astype(np.float64)
        out[hole] = weighted_mean(d2, v, power)
        cols = [*own.select(names).columns, pa.array(out, mask=np.isnan(out))]
        return pa.Table.from_arrays([*cols, pa.array(hole)] if flag else cols, names=[*names, value_col, *([flag] if flag else [])])

    if windows is not None:
        cells = window_cells(cells, windows, int(max_distance), value_col)
    extra = [T.StructField(value_col, T.DoubleType())] + ([T.StructField(flag, T.BooleanType())] if flag else [])
    return _per_tile(cells, int(max_distance), value_col, keys, _schema(cells, keys, extra), make)


def idw_average(cells: DataFrame, max_distance: int, value_col: str = "v", keys=("t",), power: float = 1.0) -> DataFrame:
    """Filled value of every NULL cell that found a source: keys, r, c, v_fill."""
    filled = fill_nodata(cells, max_distance, value_col, keys, power, flag="was_null")
    return filled.where(F.col("was_null") & F.col(value_col).isNotNull()).select(*keys, "r", "c", F.col(value_col).alias("v_fill"))


# --------------------------------------------------------------------- oracle
def sql_fill(src: str, D: int, name: str = "filled", power: float = 1.0, width: int = 64) -> list[tuple[str, str]]:
    """DuckDB CTEs over a (t, r, c, v) relation ``src``: column neighbours by windows, gathered as one list per row of cells,
    in which every hole looks at its column offsets."""
    def best(side: str, first: str, last: str) -> str:
        d2 = f"(r - {side}r[c + k + 1]) * (r - {side}r[c + k + 1]) + k * k"
        return (f"list_min(list_transform(range({first}, {last}), lambda k: case when {d2} <= {D * D} "
                f"then ({d2}) * 1048576 + abs(k) end))")
    left, right = (f"greatest(-c, {-D})", "1"), ("1", f"least({width - 1} - c, {D}) + 1")
    picks = ",\n       ".join(f"{best(side, *span)} as k{q}" for q, (side, span) in enumerate(
        (("u", left), ("d", left), ("u", right), ("d", right))))
    values = ", ".join(f"{side}v[c + 1 {sign} k{q} % 1048576] as v{q}" for q, (side, sign) in enumerate(
        (("u", "-"), ("d", "-"), ("u", "+"), ("d", "+"))))
    w = {q: f"pow(sqrt(k{q} // 1048576), {-power})" for q in range(4)}
    num = " + ".join(f"coalesce(v{q} * {w[q]}, 0)" for q in range(4))
    den = " + ".join(f"coalesce({w[q]}, 0)" for q in range(4))
    return [
        (f"{name}_nb", f"""
select l.t, l.r, l.c,
       last_value(case when v is not null then l.r end ignore nulls) over up as ur, last_value(v ignore nulls) over up as uv,
       last_value(case when v is not null then l.r end ignore nulls) over dn as dr, last_value(v ignore nulls) over dn as dv
from (select t, r, unnest(range({width})) as c from (select distinct t, r from {src}) x) l
left join {src} s on s.t = l.t and s.r = l.r and s.c = l.c
window up as (partition by l.t, l.c order by l.r rows between unbounded preceding and current row),
       dn as (partition by l.t, l.c order by l.r desc rows between unbounded preceding and 1 preceding)"""),
        (f"{name}_rows", f"""
select t, r, list(cast(ur as bigint) order by c) as ur, list(uv order by c) as uv,
       list(cast(dr as bigint) order by c) as dr, list(dv order by c) as dv from {name}_nb group by t, r"""),
        (f"{name}_quad", f"""
select t, r, c, k0, k1, k2, k3, {values}
from (select t, r, c, uv, dv, {picks}
      from (select n.t, cast(n.r as bigint) as r, cast(n.c as bigint) as c, b.ur, b.uv, b.dr, b.dv
            from {src} n join {name}_rows b on b.t = n.t and b.r = n.r where n.v is null) h) x"""),
        (f"{name}_idw", f"""
select t, r, c, ({num}) / ({den}) as v_fill from {name}_quad where coalesce(k0, k1, k2, k3) is not null"""),
        (name, f"""
select s.t, s.r, s.c, coalesce(s.v, f.v_fill) as v from {src} s left join {name}_idw f
  on f.t = s.t and f.r = s.r and f.c = s.c"""),
    ]


def sql_nearest(name: str) -> str:
    """DuckDB text: one row per hole and quadrant from the CTEs of :func:`sql_fill`."""
    return "\nunion all ".join(f"select t, cast(r as int) as r, cast(c as int) as c, {q} as q, v{q} as v, cast(k{q} // 1048576 as int) as d2 "
                               f"from {name}_quad where k{q} is not null" for q in range(4))
