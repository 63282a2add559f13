"""Georeference rules, equal-area projection and bilinear reprojection.

The projection is the Albers equal-area conic on GRS80 with standard
parallels 29.5 / 45.5 and origin 23 N / 96 W (the CONUS equal-area grid),
in closed form (Snyder, USGS Professional Paper 1395): the forward formula
uses the q-function, the inverse the authalic-latitude series, so neither
side iterates and both stay Column expressions.  The expressions are
produced as SQL text so the same arithmetic runs in Spark and in the oracle.

Warping works by target tiles.  The inverse-projected footprint of a tile (the
least and largest source row and column its cells look at) says which source
cells it needs; the footprints are a small table by source block, so each cell
learns its tiles there, goes to them in one exchange and an array kernel warps
the tile.  The table depends on the lattices, not on the number of grids.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # executors need no installed package

# Ellipsoid and projection parameters.
A = 6378137.0
E2 = 0.00669438002290
LAT1, LAT2, LAT0, LON0 = 29.5, 45.5, 23.0, -96.0

# Corner coordinates (ulx, uly, lrx, lry) by dataset and first valid day.
GEOREF_RULES = [
    ("unmasked", "2009-12-09", -130.517083333332, 58.2329166666655, -62.2504166666677, 24.0995833333335),
    ("unmasked", "2013-10-01", -130.516666666661, 58.2333333333310, -62.2499999999975, 24.0999999999990),
    ("masked", "2003-09-30", -124.73375000, 52.87458333, -66.94208333, 24.87458333),
    ("masked", "2013-10-01", -124.73333333, 52.87500000, -66.94166667, 24.95000000),
]


def _consts():
    e = math.sqrt(E2)

    def q(phi):
        s = math.sin(phi)
        return (1 - E2) * (s / (1 - E2 * s * s) - (1 / (2 * e)) * math.log((1 - e * s) / (1 + e * s)))

    def m(phi):
        s = math.sin(phi)
        return math.cos(phi) / math.sqrt(1 - E2 * s * s)

    p1, p2, p0 = (math.radians(x) for x in (LAT1, LAT2, LAT0))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    rho0 = A * math.sqrt(c - n * q(p0)) / n
    qp = q(math.pi / 2)
    return e, n, c, rho0, qp


E, N_, C_, RHO0, QP = _consts()
# authalic-latitude series coefficients
S2 = E2 / 3 + 31 * E2 ** 2 / 180 + 517 * E2 ** 3 / 5040
S4 = 23 * E2 ** 2 / 360 + 251 * E2 ** 3 / 3780
S6 = 761 * E2 ** 3 / 45360


def forward_sql(lon: str, lat: str) -> tuple[str, str]:
    """SQL expressions (easting, northing) in metres for degree columns."""
    s = f"sin(radians({lat}))"
    q = f"({1 - E2!r} * ({s} / (1 - {E2!r} * {s} * {s}) - {1 / (2 * E)!r} * ln((1 - {E!r} * {s}) / (1 + {E!r} * {s}))))"
    rho = f"({A!r} * sqrt({C_!r} - {N_!r} * {q}) / {N_!r})"
    theta = f"({N_!r} * radians({lon} - ({LON0!r})))"
    return f"({rho} * sin({theta}))", f"({RHO0!r} - {rho} * cos({theta}))"


def inverse_sql(x: str, y: str) -> tuple[str, str]:
    """SQL expressions (lon, lat) in degrees for easting / northing columns."""
    dy = f"({RHO0!r} - {y})"
    rho = f"sqrt({x} * {x} + {dy} * {dy})"
    theta = f"atan2({x}, {dy})"
    q = f"(({C_!r} - {rho} * {rho} * {N_ * N_ / (A * A)!r}) / {N_!r})"
    beta = f"asin({q} / {QP!r})"
    lat = f"degrees({beta} + {S2!r} * sin(2 * {beta}) + {S4!r} * sin(4 * {beta}) + {S6!r} * sin(6 * {beta}))"
    lon = f"({LON0!r} + degrees({theta} / {N_!r}))"
    return lon, lat


def albers_forward(lon, lat) -> tuple[Column, Column]:
    ex, ny = forward_sql(lon, lat)
    return F.expr(ex), F.expr(ny)


def albers_inverse(x, y) -> tuple[Column, Column]:
    lo, la = inverse_sql(x, y)
    return F.expr(lo), F.expr(la)


# ---------------------------------------------------------------- georeference
def georef_table(spark: SparkSession) -> DataFrame:
    """The rules as a table: dataset, valid_from and the corners."""
    rows = ", ".join(f"('{d}', date '{f}', {a!r}D, {b!r}D, {c!r}D, {e!r}D)" for d, f, a, b, c, e in GEOREF_RULES)
    return spark.sql(f"select * from values {rows} as v(dataset, valid_from, ulx, uly, lrx, lry)")


def georef_rules(spark: SparkSession) -> DataFrame:
    """Rule table with validity intervals [valid_from, valid_to)."""
    w = Window.partitionBy("dataset").orderBy("valid_from")
    return georef_table(spark).withColumn("valid_to", F.lead("valid_from").over(w))


def month_number(date) -> Column:
    return (F.year(date) * 12 + F.month(date)).cast("int")


def asof(df: DataFrame, rules: DataFrame, date_col: str = "d", keys=("dataset",), start: str = "valid_from") -> DataFrame:
    """Every row with the rule of its keys in force on its date: the latest that starts on or before it.

    Rules come from any table.  They are laid out by month over the months of
    the table of rules, and dates before or after these count as the first or
    last of them, so the interval lookup is an equi join on (keys, month) with
    the interval as residual test: it streams on both sides, a busy month is
    split like any skewed key, and Spark broadcasts the rules where they are
    below its size threshold.  Rows before a key's first rule take that rule; a
    row without a date or whose keys have no rule keeps nulls.  Of rules of one
    key that start on the same day the largest by its other columns stays.
    ``valid_to`` is the start of the key's next rule, or null.
    """
    others = [c for c in rules.columns if c not in (*keys, start)]
    single = rules.groupBy(*keys, start).agg(F.max(F.struct(*others)).alias("_o")).select(*keys, start, "_o.*")
    w = Window.partitionBy(*keys).orderBy(start)
    spans = single.select("*", F.lead(start).over(w).alias("valid_to"), (F.row_number().over(w) == 1).alias("_first"))
    low, high = (rules.agg(f(month_number(F.col(start))).alias("m")).scalar() for f in (F.min, F.max))
    begin = F.when(F.col("_first"), low).otherwise(month_number(F.col(start)))
    laid = spans.select("*", begin.alias("_from"), F.coalesce(month_number(F.date_sub("valid_to", 1)), high).alias("_to"))
    laid = laid.where("_from <= _to").select("*", F.explode(F.sequence("_from", "_to")).alias("_ym"))
    named = {k: f"_k{i}" for i, k in enumerate(keys)}
    r = laid.select(*[F.col(k).alias(n) for k, n in named.items()], start, *others, "valid_to", "_first", "_ym")
    d = F.col(date_col)
    at = df.withColumn("_month", F.greatest(F.least(month_number(d), high), low))
    inside = (F.col("_first") | (d >= F.col(start))) & (F.col("valid_to").isNull() | (d < F.col("valid_to")))
    same = [F.col(k) == F.col(n) for k, n in named.items()]
    return at.join(r, [*same, F.col("_month") == F.col("_ym"), d.isNotNull(), inside], "left").drop("_ym", "_month", "_first", *named.values())


def georef_asof(df: DataFrame, rules: DataFrame, date_col: str = "d", dataset_col: str = "dataset") -> DataFrame:
    """As-of join with a table of georeference rules."""
    named = rules.drop("valid_to")
    if dataset_col != "dataset":
        named = named.withColumnRenamed("dataset", dataset_col)
    return asof(df, named, date_col, (dataset_col,))


def cell_centres(n_rows: int, n_cols: int) -> tuple[Column, Column]:
    """Cell-centre longitude / latitude from corner columns ulx, uly, lrx, lry."""
    x = F.col("ulx") + (F.col("c") + 0.5) * (F.col("lrx") - F.col("ulx")) / n_cols
    y = F.col("uly") + (F.col("r") + 0.5) * (F.col("lry") - F.col("uly")) / n_rows
    return x, y


def target_lattice(spark: SparkSession, x0: float, y0: float, size: float, n_cols: int, n_rows: int) -> DataFrame:
    """Equal-area target lattice (tr, tc, ex, ny): rows from ``range`` (distributed), columns exploded."""
    parts = min(n_rows, 1 + n_rows * n_cols // 200_000)
    rows = spark.range(0, n_rows, numPartitions=parts).select(F.col("id").cast("int").alias("tr"))
    cells = rows.select("tr", F.explode(F.sequence(F.lit(0), F.lit(n_cols - 1))).alias("tc"))
    return cells.select("tr", "tc", (F.lit(x0) + (F.col("tc") + 0.5) * size).alias("ex"),
                        (F.lit(y0) - (F.col("tr") + 0.5) * size).alias("ny"))


def bilinear_weights(targets: DataFrame, n_rows: int, n_cols: int) -> DataFrame:
    """Target cell -> its 4 source neighbours (r, c, w) on a georeferenced source lattice.

    ``targets`` carries lon, lat and the source corners ulx, uly, lrx, lry.
    Neighbours outside the source lattice are dropped here.
    """
    fc = (F.col("lon") - F.col("ulx")) / ((F.col("lrx") - F.col("ulx")) / n_cols) - 0.5
    fr = (F.col("lat") - F.col("uly")) / ((F.col("lry") - F.col("uly")) / n_rows) - 0.5
    x = targets.select("*", fc.alias("fc"), fr.alias("fr"))
    x = x.select("*", F.floor("fc").cast("int").alias("c0"), F.floor("fr").cast("int").alias("r0"))
    x = x.select("*", (F.col("fc") - F.col("c0")).alias("wx"), (F.col("fr") - F.col("r0")).alias("wy"))
    wx, wy = F.col("wx"), F.col("wy")
    nbrs = F.array(
        F.struct(F.col("r0").alias("r"), F.col("c0").alias("c"), ((1 - wx) * (1 - wy)).alias("w")),
        F.struct(F.col("r0").alias("r"), (F.col("c0") + 1).alias("c"), (wx * (1 - wy)).alias("w")),
        F.struct((F.col("r0") + 1).alias("r"), F.col("c0").alias("c"), ((1 - wx) * wy).alias("w")),
        F.struct((F.col("r0") + 1).alias("r"), (F.col("c0") + 1).alias("c"), (wx * wy).alias("w")),
    )
    keep = [c for c in targets.columns if c not in ("lon", "lat", "ulx", "uly", "lrx", "lry")]
    e = x.select(*keep, F.explode(nbrs).alias("n")).select(*keep, "n.r", "n.c", "n.w")
    return e.where(F.col("r").between(0, n_rows - 1) & F.col("c").between(0, n_cols - 1))


TARGET_TILE = 64        # target cells per side of a warped tile
SOURCE_BLOCK = 32       # source cells per side of a block of the footprint table
BLOCK_ROWS = 200_000    # footprint blocks that are broadcast; a larger table is joined
MAX_RULES = 1_000       # georeference periods in one warp


def inverse_arrays(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The inverse projection of :func:`inverse_sql` on arrays."""
    dy = RHO0 - y
    rho = np.sqrt(x * x + dy * dy)
    beta = np.arcsin((C_ - rho * rho * (N_ * N_ / (A * A))) / N_ / QP)
    lat = np.degrees(beta + S2 * np.sin(2 * beta) + S4 * np.sin(4 * beta) + S6 * np.sin(6 * beta))
    return LON0 + np.degrees(np.arctan2(x, dy) / N_), lat


def rule_corners(rules: DataFrame) -> dict:
    """Rule to corners (ulx, uly, lrx, lry): a catalog of periods, small by nature; more than MAX_RULES is an error."""
    found = rules.select("rule", "ulx", "uly", "lrx", "lry").limit(MAX_RULES + 1).collect()
    if len(found) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} georeference periods in one warp")
    return {r.rule: (r.ulx, r.uly, r.lrx, r.lry) for r in found}


def corner_array(corners: dict) -> Column:
    """The corners as an array literal of struct(rule, ulx, uly, lrx, lry)."""
    return F.array(*[F.struct(F.lit(rule).alias("rule"), *[F.lit(float(x)).alias(n) for x, n in zip(box, ("ulx", "uly", "lrx", "lry"))])
                     for rule, box in corners.items()])


def footprints(spark: SparkSession, corners: dict, target: dict, n_rows: int, n_cols: int, tile: int) -> DataFrame:
    """Source rows r0..r1 and columns c0..c1 that the cells of each target tile (wr, wc) look at, per rule."""
    lon, lat = albers_inverse("ex", "ny")
    cells = target_lattice(spark, **target).select("tr", "tc", lon.alias("lon"), lat.alias("lat"))
    at = cells.select("tr", "tc", "lon", "lat", F.explode(corner_array(corners)).alias("u")).select(
        "u.rule", F.floor(F.col("tr") / tile).cast("int").alias("wr"), F.floor(F.col("tc") / tile).cast("int").alias("wc"),
        F.floor((F.col("lat") - F.col("u.uly")) / ((F.col("u.lry") - F.col("u.uly")) / n_rows) - 0.5).cast("int").alias("r"),
        F.floor((F.col("lon") - F.col("u.ulx")) / ((F.col("u.lrx") - F.col("u.ulx")) / n_cols) - 0.5).cast("int").alias("c"))
    box = at.groupBy("rule", "wr", "wc").agg(
        F.greatest(F.min("r"), F.lit(0)).alias("r0"), F.least(F.max("r") + 1, F.lit(n_rows - 1)).alias("r1"),
        F.greatest(F.min("c"), F.lit(0)).alias("c0"), F.least(F.max("c") + 1, F.lit(n_cols - 1)).alias("c1"))
    return box.where("r0 <= r1 and c0 <= c1")


def warp(values: DataFrame, steps: DataFrame, rules: DataFrame, target: dict, n_rows: int, n_cols: int,
         keys=("t",), value_col: str = "v", tile: int | None = None, tiles: DataFrame | None = None) -> DataFrame:
    """Bilinear warp of source grids (keys, r, c, v) to a target lattice: keys, tr, tc, v for every target cell.

    ``steps`` has the keys and the ``rule`` of each grid, ``rules`` the corners
    (rule, ulx, uly, lrx, lry) of each rule.  A target cell is the mean of its
    valid neighbours by bilinear weights, null without one.  The cells are
    exchanged once, on (keys, target tile); beside them a tile gets one row
    that names it, so tiles without any source have their rows too.  With
    ``tiles`` (wr, wc) only those target tiles are made, and only the cells
    they look at leave their tasks.
    """
    tile = tile or TARGET_TILE
    corners = rule_corners(rules)
    boxes = footprints(values.sparkSession, corners, target, n_rows, n_cols, tile)
    if tiles is not None:
        boxes = boxes.join(tiles, ["wr", "wc"], "left_semi")

    def blocks(lo: str, hi: str):
        return F.explode(F.sequence(F.floor(F.col(lo) / SOURCE_BLOCK).cast("int"), F.floor(F.col(hi) / SOURCE_BLOCK).cast("int")))

    needed = (boxes.select("*", blocks("r0", "r1").alias("br")).select("*", blocks("c0", "c1").alias("bc"))
              .groupBy("rule", "br", "bc").agg(F.collect_list(F.struct("wr", "wc", "r0", "r1", "c0", "c1")).alias("tiles")))
    if len(corners) * -(-n_rows // SOURCE_BLOCK) * -(-n_cols // SOURCE_BLOCK) <= BLOCK_ROWS:
        needed = F.broadcast(needed)
    r, c = F.col("r"), F.col("c")
    cells = values.where(F.col(value_col).isNotNull()).select(*keys, "r", "c", F.col(value_col).cast("double").alias("v"))
    cells = cells.join(steps.select(*keys, "rule"), list(keys)).select(
        *keys, "rule", "r", "c", "v", F.floor(r / SOURCE_BLOCK).cast("int").alias("br"), F.floor(c / SOURCE_BLOCK).cast("int").alias("bc"))
    own = (r.between(F.col("x.r0"), F.col("x.r1")) & c.between(F.col("x.c0"), F.col("x.c1")))
    sent = (cells.join(needed, ["rule", "br", "bc"]).select(*keys, "rule", "r", "c", "v", F.explode("tiles").alias("x"))
            .where(own).select(*keys, "rule", "x.wr", "x.wc", "r", "c", "v"))

    def numbers(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(-(-n // tile) - 1)))

    names = steps.select(*keys, "rule", numbers(target["n_rows"]).alias("wr")).select("*", numbers(target["n_cols"]).alias("wc"))
    if tiles is not None:
        names = names.join(tiles, ["wr", "wc"], "left_semi")
    names = (names.select(*keys, "rule", "wr", "wc", F.lit(None).cast("int").alias("r"), F.lit(None).cast("int").alias("c"), F.lit(None).cast("double").alias("v")))
    schema = T.StructType([*[values.schema[k] for k in keys], T.StructField("tr", T.IntegerType()),
                           T.StructField("tc", T.IntegerType()), T.StructField(value_col, T.DoubleType())])

    def run(table: pa.Table) -> pa.Table:
        wr, wc = table.column("wr")[0].as_py(), table.column("wc")[0].as_py()
        tr = np.arange(wr * tile, min((wr + 1) * tile, target["n_rows"]))
        tc = np.arange(wc * tile, min((wc + 1) * tile, target["n_cols"]))
        lon, lat = inverse_arrays((target["x0"] + (tc + 0.5) * target["size"])[None, :], (target["y0"] - (tr + 0.5) * target["size"])[:, None])
        ulx, uly, lrx, lry = corners[table.column("rule")[0].as_py()]
        found = table.filter(table.column("r").is_valid())
        rows, cols = found.column("r").to_numpy().astype(np.int64), found.column("c").to_numpy().astype(np.int64)
        v = bilinear_tile(rows, cols, found.column("v").to_numpy(), (lon - ulx) / ((lrx - ulx) / n_cols) - 0.5,
                          (lat - uly) / ((lry - uly) / n_rows) - 0.5)
        key = [pa.repeat(table.column(k)[0], v.size) for k in keys]
        return pa.Table.from_arrays([*key, pa.array(np.repeat(tr, len(tc)).astype(np.int32)), pa.array(np.tile(tc, len(tr)).astype(np.int32)),
                                     pa.array(v.ravel(), mask=np.isnan(v).ravel())], names=schema.names)

    return sent.unionByName(names).groupBy(*keys, "wr", "wc").applyInArrow(run, schema)


def bilinear_tile(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, fc: np.ndarray, fr: np.ndarray) -> np.ndarray:
    """sum(w * v) / sum(w) over the valid ones of the four cells around source positions (fr, fc); NaN without one."""
    if not len(rows):
        return np.full(fc.shape, np.nan)
    r_min, c_min = rows.min(), cols.min()
    grid = np.full((rows.max() - r_min + 1, cols.max() - c_min + 1), np.nan)
    grid[rows - r_min, cols - c_min] = values
    r0, c0 = np.floor(fr).astype(np.int64), np.floor(fc).astype(np.int64)
    total, weight = np.zeros(fc.shape), np.zeros(fc.shape)
    for dr, wr in ((0, 1 - (fr - r0)), (1, fr - r0)):
        for dc, wc in ((0, 1 - (fc - c0)), (1, fc - c0)):
            i, j = r0 + dr - r_min, c0 + dc - c_min
            inside = (i >= 0) & (i < grid.shape[0]) & (j >= 0) & (j < grid.shape[1])
            v = np.where(inside, grid[np.where(inside, i, 0), np.where(inside, j, 0)], np.nan)
            valid = ~np.isnan(v)
            w = np.where(valid, wr * wc, 0.0)
            total += w * np.where(valid, v, 0.0)
            weight += w
    return np.where(weight > 0, total / np.where(weight > 0, weight, 1.0), np.nan)


# ----------------------------------------------------------- zones in degrees
#: Parts of a target cell that a projected edge may lie off its curve.
CHORD = 1e-3


def to_lattice_sql(lon: str, lat: str, target: dict) -> tuple[str, str]:
    """SQL expressions (x, y) in cells of the target lattice for degree expressions."""
    e, n = forward_sql(lon, lat)
    return f"(({e} - ({target['x0']!r})) / {target['size']!r})", f"((({target['y0']!r}) - {n}) / {target['size']!r})"


def project_edges(edges: DataFrame, target: dict, chord: float = CHORD) -> DataFrame:
    """Edges in degrees (x1, y1, x2, y2) as edges in cells of the target lattice.

    An edge is straight in degrees and a curve in the projection, so it is cut
    into equal pieces until the chord of each is within ``chord`` of a cell of
    the curve.  The deviation is measured at three points of the edge and falls
    with the square of the number of pieces; twice the pieces this asks for
    leave room for uneven curvature.  Neighbouring pieces share their points
    exactly, so rings stay closed.
    """
    def at(f: str) -> tuple[str, str]:
        return to_lattice_sql(f"(x1 + (x2 - x1) * {f})", f"(y1 + (y2 - y1) * {f})", target)

    ends = [to_lattice_sql("x1", "y1", target), to_lattice_sql("x2", "y2", target)]
    off = []
    for f in ("0.25D", "0.5D", "0.75D"):
        x, y = at(f)
        off.append(f"hypot({x} - ({ends[0][0]} * (1 - {f}) + {ends[1][0]} * {f}), {y} - ({ends[0][1]} * (1 - {f}) + {ends[1][1]} * {f}))")
    pieces = F.greatest(F.lit(1), F.ceil(2 * F.sqrt(F.expr(f"greatest({', '.join(off)})") / chord))).cast("int")
    keep = [c for c in edges.columns if c not in ("x1", "y1", "x2", "y2")]
    cut = edges.select("*", pieces.alias("_n")).select("*", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_k"))

    def point(k, a: str, b: str) -> Column:
        inner = F.col(a) + (F.col(b) - F.col(a)) * (k / F.col("_n"))
        return F.when(k == 0, F.col(a)).when(k == F.col("_n"), F.col(b)).otherwise(inner)

    pts = cut.select(*keep, *[point(F.col("_k") + d, a, b).alias(name) for d, names in ((0, ("_a", "_b")), (1, ("_c", "_d")))
                              for (a, b), name in zip((("x1", "x2"), ("y1", "y2")), names)])
    first, second = to_lattice_sql("_a", "_b", target), to_lattice_sql("_c", "_d", target)
    return pts.select(*keep, *[F.expr(e).alias(n) for e, n in zip((*first, *second), ("x1", "y1", "x2", "y2"))])
