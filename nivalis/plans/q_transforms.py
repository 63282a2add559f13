"""Registered grid queries: point-wise keys, gap filling, interpolated snow products,
pyramids, statistics, georeference and reprojection, basin clips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import LATTICE, Fixtures, sql_ctes
from ..functions import names as N
from ..operators import catalog as C
from ..operators import cells as K
from ..operators import fill as FL
from ..operators import projection as P
from ..operators import pyramid as PY
from ..operators import zones as Z
from .q_grid import _SQL_G, raw_grid, zone_names
from .registry import register

FILL_DISTANCE = 16          # the published interpolated products use a 16-cell search
SQL_MASK = ("m", "select r, c, m from v_mask")
LEVELS = PY.levels_for(LATTICE, LATTICE)


def shifted_date(t) -> "F.Column":
    """First day of month ``t`` (yyyymm) moved 14 years forward (fixture calendar)."""
    tt = F.col(t) if isinstance(t, str) else t
    return F.add_months(F.make_date(F.floor(tt / 100).cast("int"), (tt % 100).cast("int"), F.lit(1)), 14 * 12)


SQL_SHIFT = "(make_date(cast(t // 100 as int), cast(t % 100 as int), 1) + interval 14 year)"


def one(fx: Fixtures, col: str) -> DataFrame:
    """Single-product grid (t, r, c, v) with NULL nodata."""
    return raw_grid(fx).select("t", "r", "c", F.col(col).alias("v"))


def materialize(df: DataFrame, name: str = "grid", by: str | None = None) -> DataFrame:
    """Write a grid that several consumers read once to the shared folder (partitioned by ``by``) and read it."""
    from ..session import scratch_path
    path = scratch_path(df.sparkSession, name)
    out = df.write.option("compression", "zstd")
    (out.partitionBy(by) if by else out).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_pyramid(base: DataFrame, keys=("t",)) -> DataFrame:
    """Base cells as level 1, then the average overviews that end every product: keys, level, r, c, v."""
    up = PY.overview_pyramid(base, LEVELS, keys=keys).select(
        *keys, "level", F.col("br").alias("r"), F.col("bc").alias("c"), F.col("v_mean").alias("v"))
    return base.select(*keys, F.lit(1).alias("level"), "r", "c", "v").unionByName(up)


def sql_pyramid(src: str, keys: str = "t") -> str:
    """DuckDB text of :func:`with_pyramid` over a relation with v, rounded to 6 places."""
    return f"""
select {keys}, 1 as level, r, c, round(v, 6) as v from {src}
union all
select {keys}, f as level, cast(floor(r / f) as int) as r, cast(floor(c / f) as int) as c, round(sum(v) / count(v), 6) as v
from {src}, (select unnest({LEVELS}) as f) ff group by {keys}, f, floor(r / f), floor(c / f)"""


def rounded(df: DataFrame, col: str = "v") -> DataFrame:
    """Registered queries compare at 6 places; operators do not round."""
    return df.withColumn(col, F.round(col, 6))


# ----------------------------------------------------------------- point-wise
@register("nodata_to_null", sql_ctes(("v_grid",), [_SQL_G], "select t, r, c, swe, temp_k, melt, depth from g"))
def nodata_to_null(spark, sf_dir):
    return raw_grid(Fixtures(spark, sf_dir))


@register("scale_values", sql_ctes(("v_grid",), [_SQL_G], "select t, r, c, melt * 0.01 as melt_mm from g"))
def scale_values(spark, sf_dir):
    g = raw_grid(Fixtures(spark, sf_dir))
    return g.select("t", "r", "c", K.scale_values("melt", K.MELT_TO_MM).alias("melt_mm"))


@register("kelvin_to_celsius", sql_ctes(("v_grid",), [_SQL_G], "select t, r, c, temp_k - 273.15 as temp_c from g"))
def kelvin_to_celsius(spark, sf_dir):
    g = raw_grid(Fixtures(spark, sf_dir))
    return g.select("t", "r", "c", K.kelvin_to_celsius("temp_k").alias("temp_c"))


SQL_CC_EXPR = ("case when {t} - 273.15 >= 0 then 0.0 when {s} is null or {t} - 273.15 is null then null "
               "else {s} * 2114 * ({t} - 273.15) / 333000 end")


@register("cold_content", sql_ctes(("v_grid",), [_SQL_G], f"""
select t, r, c, {SQL_CC_EXPR.format(t='temp_k', s='swe')} as cc from g"""))
def cold_content(spark, sf_dir):
    g = raw_grid(Fixtures(spark, sf_dir))
    return g.select("t", "r", "c", K.cold_content("temp_k", "swe").alias("cc"))


@register("cell_align_join", sql_ctes(("v_grid",), [_SQL_G], """
select a.t, a.r, a.c, a.swe, b.temp_k from g a join g b on a.t = b.t and a.r = b.r and a.c = b.c
where a.swe is not null and b.temp_k is not null"""))
def cell_align_join(spark, sf_dir):
    """Two grids stored apart (valid cells only) meet on the shared lattice key."""
    fx = Fixtures(spark, sf_dir)
    a = one(fx, "swe").where(F.col("v").isNotNull()).withColumnRenamed("v", "swe")
    b = one(fx, "temp_k").where(F.col("v").isNotNull()).withColumnRenamed("v", "temp_k")
    return K.cell_align_join(a, b).select("t", "r", "c", "swe", "temp_k")


def lake_fix(cells: DataFrame, mask: DataFrame, wanted=None) -> DataFrame:
    """The lake fix on the days it is due (and on the rows where ``wanted`` holds)."""
    due = N.lakefix_applies(shifted_date("t"), F.lit("1034"))
    due = due & wanted if wanted is not None else due
    j = cells.join(mask, on=["r", "c"], how="left")
    return j.select(*[c for c in cells.columns if c != "v"],
                    F.when(due, K.lakefix_zero_to_nodata("v", "m")).otherwise(F.col("v")).alias("v"))


def lakefixed(fx: Fixtures, col: str) -> DataFrame:
    return lake_fix(one(fx, col), fx.mask)


SQL_LAKEFIX = ("swe_in", f"""
select g.t, g.r, g.c,
       case when {SQL_SHIFT} >= date '2014-10-09' and g.swe = 0 and m.m = -9999.0 then null else g.swe end as v
from g left join v_mask m on m.r = g.r and m.c = g.c""")


@register("lakefix_zero_to_nodata", sql_ctes(("v_grid", "v_mask"), [_SQL_G, SQL_LAKEFIX], "select t, r, c, v from swe_in"))
def lakefix_zero_to_nodata(spark, sf_dir):
    return lakefixed(Fixtures(spark, sf_dir), "swe").select("t", "r", "c", "v")


@register("grid_conformity", sql_ctes(("v_grid",), [("shapes", """
select t, p, max(r) + 1 as n_rows, max(c) + 1 as n_cols
from (select t, r, c, unnest(['swe', 'temp_k', 'melt']) as p from v_grid) x group by t, p""")], """
select t, count(*) as n_grids, min(n_rows) as min_rows, max(n_rows) as max_rows,
       min(n_cols) as min_cols, max(n_cols) as max_cols,
       (count(*) = 3 and min(n_rows) = max(n_rows) and min(n_cols) = max(n_cols)) as conform
from shapes group by t"""))
def grid_conformity(spark, sf_dir):
    """Shape of the three grids of each step, nodata edges included, and whether they agree."""
    fx = Fixtures(spark, sf_dir)
    long = fx.grid.select("t", "r", "c", F.explode(F.array(*[F.lit(p) for p in ("swe", "temp_k", "melt")])).alias("grid"))
    return conformity(K.grid_shape(long))


def conformity(shapes: DataFrame, n_grids: int = 3) -> DataFrame:
    g = shapes.groupBy("t").agg(
        F.count(F.lit(1)).alias("n_grids"), F.min("n_rows").alias("min_rows"), F.max("n_rows").alias("max_rows"),
        F.min("n_cols").alias("min_cols"), F.max("n_cols").alias("max_cols"))
    return g.withColumn("conform", (F.col("n_grids") == n_grids) & (F.col("min_rows") == F.col("max_rows"))
                        & (F.col("min_cols") == F.col("max_cols")))


# ------------------------------------------------------------------ filling
SQL_SWE = ("swe_raw", "select t, r, c, swe as v from g")


@register("nearest_valid_join", sql_ctes(("v_grid",), [_SQL_G, SQL_SWE, *FL.sql_fill("swe_raw", FILL_DISTANCE, "f")],
                                         FL.sql_nearest("f")))
def nearest_valid_join(spark, sf_dir):
    return FL.nearest_valid(one(Fixtures(spark, sf_dir), "swe"), FILL_DISTANCE)


@register("idw_average", sql_ctes(("v_grid",), [_SQL_G, SQL_SWE, *FL.sql_fill("swe_raw", FILL_DISTANCE, "f")],
                                  "select t, cast(r as int) as r, cast(c as int) as c, round(v_fill, 6) as v_fill from f_idw"))
def idw_average(spark, sf_dir):
    return rounded(FL.idw_average(one(Fixtures(spark, sf_dir), "swe"), FILL_DISTANCE), "v_fill")


@register("fill_nodata", sql_ctes(("v_grid",), [_SQL_G, SQL_SWE, *FL.sql_fill("swe_raw", FILL_DISTANCE, "f")],
                                  "select t, r, c, round(v, 6) as v from f"))
def fill_nodata(spark, sf_dir):
    return rounded(FL.fill_nodata(one(Fixtures(spark, sf_dir), "swe"), FILL_DISTANCE))


SQL_TEMP_RAW = ("temp_raw", "select t, r, c, case when temp_k in (-9999.0, 55537.0) then null else temp_k end as v from v_grid")


@register("interpolate", sql_ctes(("v_grid",), [SQL_TEMP_RAW, *FL.sql_fill("temp_raw", FILL_DISTANCE, "f")],
                                  "select t, r, c, round(v, 6) as v from f"))
def interpolate(spark, sf_dir):
    """Mark the sentinel(s) as nodata, then fill (snowpack temperature grid)."""
    g = Fixtures(spark, sf_dir).grid
    cells = g.select("t", "r", "c", K.nodata_sentinels_to_null("temp_k").alias("v"))
    return rounded(FL.fill_nodata(cells, FILL_DISTANCE))


def interpolated_swe_df(fx: Fixtures) -> DataFrame:
    return FL.fill_nodata(lakefixed(fx, "swe"), FILL_DISTANCE)


def interpolated_depth_df(fx: Fixtures) -> DataFrame:
    return FL.fill_nodata(lakefixed(fx, "depth"), FILL_DISTANCE)


def restored_fill(raw: DataFrame, swe_i: DataFrame, keys=("t",)) -> DataFrame:
    """Fill grid(s), then set back to NULL where a cell was nodata and filled SWE is 0.

    The fill flags the cells it filled, so only filled SWE is joined (on t, r, c).
    """
    filled = FL.fill_nodata(raw, FILL_DISTANCE, keys=keys, flag="was_null")
    j = filled.join(swe_i.withColumnRenamed("v", "swe_f"), ["t", "r", "c"])
    before = F.when(~F.col("was_null"), F.lit(0.0))          # NULL exactly where the input was NULL
    return j.select(*keys, "r", "c", K.restore_nodata("v", before, "swe_f").alias("v"))


def interpolated_restored(fx: Fixtures, col: str, swe_i: DataFrame) -> DataFrame:
    """Fill one grid, then restore its legitimate nodata by filled SWE."""
    return restored_fill(one(fx, col), swe_i)


_SQL_SWE_F = [_SQL_G, SQL_LAKEFIX, *FL.sql_fill("swe_in", FILL_DISTANCE, "swe_f")]
_SQL_DEPTH_F = [_SQL_G, (SQL_LAKEFIX[0].replace("swe", "depth"), SQL_LAKEFIX[1].replace("swe", "depth")),
                *FL.sql_fill("depth_in", FILL_DISTANCE, "depth_f")]


def _sql_restored(col: str, name: str) -> list[tuple[str, str]]:
    return [(f"{name}_raw", f"select t, r, c, {col} as v from g"),
            *FL.sql_fill(f"{name}_raw", FILL_DISTANCE, f"{name}_fill"),
            (name, f"""
select a.t, a.r, a.c, case when s.v = 0 and b.v is null then null else a.v end as v
from {name}_fill a join {name}_raw b on b.t = a.t and b.r = a.r and b.c = a.c
join swe_f s on s.t = a.t and s.r = a.r and s.c = a.c""")]


@register("interpolated_swe", sql_ctes(("v_grid", "v_mask"), _SQL_SWE_F, sql_pyramid("swe_f")))
def interpolated_swe(spark, sf_dir):
    """Lake fix if due, fill, overviews."""
    return rounded(with_pyramid(interpolated_swe_df(Fixtures(spark, sf_dir))))


@register("interpolated_snowdepth", sql_ctes(("v_grid", "v_mask"), _SQL_DEPTH_F, sql_pyramid("depth_f")))
def interpolated_snowdepth(spark, sf_dir):
    """The same recipe on the depth band, a grid of its own."""
    return rounded(with_pyramid(interpolated_depth_df(Fixtures(spark, sf_dir))))


@register("restore_nodata", sql_ctes(("v_grid", "v_mask"), [*_SQL_SWE_F, *_sql_restored("melt", "melt_i")], """
select b.t, b.r, b.c, b.v is null as was_null, round(f.v, 6) as filled, round(i.v, 6) as restored
from melt_i_raw b join melt_i_fill f on f.t = b.t and f.r = b.r and f.c = b.c
join melt_i i on i.t = b.t and i.r = b.r and i.c = b.c"""))
def restore_nodata(spark, sf_dir):
    """The step itself, on the melt grid: each cell before, after the fill, and with its nodata restored."""
    fx = Fixtures(spark, sf_dir)
    filled = FL.fill_nodata(one(fx, "melt"), FILL_DISTANCE, flag="was_null").withColumnRenamed("v", "filled")
    j = K.cell_align_join(filled, interpolated_swe_df(fx).withColumnRenamed("v", "swe_f"))
    before = F.when(~F.col("was_null"), F.lit(0.0))          # NULL exactly where the input was NULL
    out = j.select("t", "r", "c", "was_null", "filled", K.restore_nodata("filled", before, "swe_f").alias("restored"))
    return rounded(rounded(out, "filled"), "restored")


@register("interpolated_snowtemp", sql_ctes(("v_grid", "v_mask"), [*_SQL_SWE_F, *_sql_restored("temp_k", "temp_i")],
                                            sql_pyramid("temp_i")))
def interpolated_snowtemp(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return rounded(with_pyramid(interpolated_restored(fx, "temp_k", interpolated_swe_df(fx))))


@register("interpolated_snowmelt", sql_ctes(("v_grid", "v_mask"), [*_SQL_SWE_F, *_sql_restored("melt", "melt_i")],
                                            sql_pyramid("melt_i")))
def interpolated_snowmelt(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return rounded(with_pyramid(interpolated_restored(fx, "melt", interpolated_swe_df(fx))))


_SQL_CCI = ("cc_i", f"""
select s.t, s.r, s.c, {SQL_CC_EXPR.format(t='tt.v', s='s.v')} as v
from swe_f s join temp_i tt on tt.t = s.t and tt.r = s.r and tt.c = s.c""")


@register("interpolated_coldcontent", sql_ctes(("v_grid", "v_mask"),
                                               [*_SQL_SWE_F, *_sql_restored("temp_k", "temp_i"), _SQL_CCI],
                                               sql_pyramid("cc_i")))
def interpolated_coldcontent(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    swe_i = materialize(interpolated_swe_df(fx), "swe_i")      # read by the restore step and by cold content
    temp_i = interpolated_restored(fx, "temp_k", swe_i)
    j = K.cell_align_join(swe_i.withColumnRenamed("v", "swe"), temp_i.withColumnRenamed("v", "temp"))
    return rounded(with_pyramid(j.select("t", "r", "c", K.cold_content("temp", "swe").alias("v"))))


def interpolate_all(fx: Fixtures) -> DataFrame:
    """All five interpolated products for every time step, one long table.

    The grid is written once; SWE, depth, temperature and melt are filled by
    one plan, keyed by product, and written partitioned by product, so each
    reader below prunes to its own.
    """
    cells = raw_grid(fx)
    values = F.array(*[F.struct(F.lit(p).alias("p"), e.alias("v")) for p, e in (
        ("swe", F.col("swe")), ("depth", F.col("depth")), ("temp", F.col("temp_k")), ("melt", F.col("melt")))])
    long = cells.select("t", "r", "c", F.explode(values).alias("x")).select("x.p", "t", "r", "c", "x.v")
    long = lake_fix(long, fx.mask, F.col("p").isin("swe", "depth"))
    filled = materialize(FL.fill_nodata(long, FILL_DISTANCE, keys=("p", "t"), flag="was_null"), "filled", by="p")

    def product(p: str) -> DataFrame:
        return filled.where(F.col("p") == p).drop("p")

    swe_i, depth_i = product("swe").drop("was_null"), product("depth").drop("was_null")
    swe_f = swe_i.withColumnRenamed("v", "swe_f")

    def restored(p: str) -> DataFrame:
        before = F.when(~F.col("was_null"), F.lit(0.0))
        return K.cell_align_join(product(p), swe_f).select("t", "r", "c", K.restore_nodata("v", before, "swe_f").alias("v"))

    temp_i, melt_i = materialize(restored("temp"), "temp_i"), restored("melt")
    cc = K.cell_align_join(swe_f, temp_i.withColumnRenamed("v", "temp")).select(
        "t", "r", "c", K.cold_content("temp", "swe_f").alias("v"))
    out = None
    for name, df in zip(INTERPOLATED, (swe_i, depth_i, temp_i, melt_i, cc)):
        d = df.select(F.lit(name).alias("product"), "t", "r", "c", "v")
        out = d if out is None else out.unionByName(d)
    return out


#: Names of the interpolated products.
INTERPOLATED = ("nohrsc_snodas_swe_interpolated", "nohrsc_snodas_snowdepth_interpolated",
                "nohrsc_snodas_snowpack_avg_temperature_interpolated", "nohrsc_snodas_snowmelt_interpolated",
                "nohrsc_snodas_coldcontent_interpolated")
_SQL_ALL = ("all_i", "\nunion all ".join(
    f"select '{name}' as product, t, r, c, v from {src}"
    for name, src in zip(INTERPOLATED, ("swe_f", "depth_f", "temp_i", "melt_i", "cc_i"))))


#: Up to all_i (product, t, r, c, v), the five interpolated products.
SQL_INTERPOLATE_ALL = [*_SQL_SWE_F, *_SQL_DEPTH_F[1:], *_sql_restored("temp_k", "temp_i"), *_sql_restored("melt", "melt_i"),
                       _SQL_CCI, _SQL_ALL]


@register("interpolate_for_datetime", sql_ctes(("v_grid", "v_mask"), SQL_INTERPOLATE_ALL, sql_pyramid("all_i", "product, t")))
def interpolate_for_datetime(spark, sf_dir):
    return rounded(with_pyramid(interpolate_all(Fixtures(spark, sf_dir)), keys=("product", "t")))


# ------------------------------------------------------- pyramids, statistics


@register("overview_pyramid", sql_ctes(("v_grid",), [_SQL_G], f"""
select t, f as level, cast(floor(r / f) as int) as br, cast(floor(c / f) as int) as bc,
       round(sum(swe) / count(swe), 6) as v_mean, count(swe) as v_count
from g, (select unnest({LEVELS}) as f) ff
group by t, f, floor(r / f), floor(c / f)"""))
def overview_pyramid(spark, sf_dir):
    return rounded(PY.overview_pyramid(one(Fixtures(spark, sf_dir), "swe"), LEVELS), "v_mean")


@register("band_statistics", sql_ctes(("v_grid",), [_SQL_G], """
select t, min(swe) as v_min, max(swe) as v_max, round(avg(swe), 6) as v_mean,
       round(stddev_pop(swe), 6) as v_stddev, count(swe) as v_count from g group by t"""))
def band_statistics(spark, sf_dir):
    return rounded(rounded(PY.band_statistics(one(Fixtures(spark, sf_dir), "swe")), "v_mean"), "v_stddev")


# ------------------------------------------------------------------- zonal
_ZT = ("zt", "select distinct z, n, t from v_zone, (select distinct t from v_grid) tt")


@register("zonal_stats", sql_ctes(("v_grid", "v_zone"), [_SQL_G, *Z.sql_zone_members(), _ZT], """
select zt.t, zt.z as zone_id, zt.n as zone_name, min(g.swe) as v_min, max(g.swe) as v_max,
       round(avg(g.swe), 6) as v_mean, count(g.swe) as v_count
from zt left join z_inside i on i.z = zt.z left join g on g.t = zt.t and g.r = i.r and g.c = i.c
group by zt.t, zt.z, zt.n"""))
def zonal_stats(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    members = Z.zone_members(fx.zones, LATTICE, LATTICE)
    out = rounded(Z.zonal_stats(one(fx, "swe"), members, zone_names(fx), prefix="v_", times=fx.times), "v_mean")
    return out.select("t", F.col("z").alias("zone_id"), F.col("n").alias("zone_name"),
                      "v_min", "v_max", "v_mean", "v_count")


def holed_zones(fx: Fixtures) -> DataFrame:
    """The zone triangles with their vertices drawn towards the middle of the envelope as a second ring, for even z."""
    v = fx.zones.select("z", F.lit(0).alias("ring"), "i", "x", "y")
    env = Z.zone_envelope(fx.zones)
    hole = v.where("z % 2 = 0").join(env, "z").select(
        "z", F.lit(1).alias("ring"), "i", (F.col("x") * 0.4 + (F.col("xmin") + F.col("xmax")) * 0.3).alias("x"),
        (F.col("y") * 0.4 + (F.col("ymin") + F.col("ymax")) * 0.3).alias("y"))
    return v.unionByName(hole)


SQL_HOLED = ("hz", """
select z, 0 as ring, i, x, y from v_zone
union all
select z, 1, i, x * 0.4e0 + (min(x) over (partition by z) + max(x) over (partition by z)) * 0.3e0,
       y * 0.4e0 + (min(y) over (partition by z) + max(y) over (partition by z)) * 0.3e0 from v_zone where z % 2 = 0""")


@register("zone_cell_join", sql_ctes(("v_zone", "v_lattice"), [SQL_HOLED, *Z.sql_zone_members("hz", ring="ring")],
                                     "select z, r, c from z_inside"))
def zone_cell_join(spark, sf_dir):
    """Cells of zones with holes."""
    return Z.zone_cells(holed_zones(Fixtures(spark, sf_dir)), LATTICE, LATTICE)


@register("zone_envelope", sql_ctes(("v_zone",), [], """
select z, min(x) as xmin, min(y) as ymin, max(x) as xmax, max(y) as ymax from v_zone group by z"""))
def zone_envelope(spark, sf_dir):
    return Z.zone_envelope(Fixtures(spark, sf_dir).zones)


def buffered(env: DataFrame, cells_col, size_col) -> DataFrame:
    """Snap an envelope out to whole cells and pad n cells; unchanged when size or n is 0."""
    n, s = F.col(cells_col), F.col(size_col)
    off = (n == 0) | (s == 0)
    down = lambda v: (F.floor(F.col(v) / s) - n) * s
    up = lambda v: (F.ceil(F.col(v) / s) + n) * s
    return env.select(
        "*",
        F.when(off, F.col("xmin")).otherwise(down("xmin")).alias("bxmin"),
        F.when(off, F.col("ymin")).otherwise(down("ymin")).alias("bymin"),
        F.when(off, F.col("xmax")).otherwise(up("xmax")).alias("bxmax"),
        F.when(off, F.col("ymax")).otherwise(up("ymax")).alias("bymax"),
    )


@register("buffered_extent", sql_ctes(("v_zone",), [("e", """
select z, min(x) as xmin, min(y) as ymin, max(x) as xmax, max(y) as ymax, z % 3 as n, 0.5 as s from v_zone group by z""")], """
select z, case when n = 0 or s = 0 then xmin else (floor(xmin / s) - n) * s end as bxmin,
          case when n = 0 or s = 0 then ymin else (floor(ymin / s) - n) * s end as bymin,
          case when n = 0 or s = 0 then xmax else (ceil(xmax / s) + n) * s end as bxmax,
          case when n = 0 or s = 0 then ymax else (ceil(ymax / s) + n) * s end as bymax
from e"""))
def buffered_extent(spark, sf_dir):
    env = Z.zone_envelope(Fixtures(spark, sf_dir).zones)
    env = env.withColumn("n", F.col("z") % 3).withColumn("s", F.lit(0.5))
    return buffered(env, "n", "s").select("z", "bxmin", "bymin", "bxmax", "bymax")


CLIP_TILE = 32          # rows per tile of the clip's join key


def basin_windows(zones: DataFrame, pad_cells: int = 2, cell_size: float = 1.0) -> DataFrame:
    """Rows r0..r1 and columns c0..c1 of each basin: cells of the lattice whose centre is in its buffered envelope."""
    env = Z.zone_envelope(zones).withColumn("n", F.lit(pad_cells)).withColumn("s", F.lit(cell_size))
    return buffered(env, "n", "s").select(
        "z", F.greatest(F.floor(F.col("bymin") - 0.5) + 1, F.lit(0)).cast("int").alias("r0"),
        F.least(F.floor(F.col("bymax") - 0.5), F.lit(LATTICE - 1)).cast("int").alias("r1"),
        F.greatest(F.ceil(F.col("bxmin") - 0.5), F.lit(0)).cast("int").alias("c0"),
        F.least(F.ceil(F.col("bxmax") - 0.5) - 1, F.lit(LATTICE - 1)).cast("int").alias("c1")).where("r0 <= r1 and c0 <= c1")


def basin_clip(values: DataFrame, windows: DataFrame) -> DataFrame:
    """One clipped grid per basin: z, the columns of the cells, and the corner r0, c0 of its window.

    A window becomes one row per (row tile, column tile) it touches, so the
    join is an equi join on the tile with the window as residual test, and
    the basin side grows with basins times tiles, not with cells.
    """
    def tiles(lo: str, hi: str):
        return F.explode(Z._int_range(F.floor(F.col(lo) / CLIP_TILE), F.floor(F.col(hi) / CLIP_TILE)))

    boxes = windows.select("*", tiles("r0", "r1").alias("rt")).select("*", tiles("c0", "c1").alias("ct"))
    tiled = values.select("*", F.floor(F.col("r") / CLIP_TILE).cast("int").alias("rt"), F.floor(F.col("c") / CLIP_TILE).cast("int").alias("ct"))
    inside = F.col("r").between(F.col("r0"), F.col("r1")) & F.col("c").between(F.col("c0"), F.col("c1"))
    return tiled.join(boxes, ["rt", "ct"]).where(inside).select("z", *values.columns, "r0", "c0")


_SQL_CLIP = ("clip", """
select z, (floor(min(x)) - 2) * 1.0 as bxmin, (floor(min(y)) - 2) * 1.0 as bymin,
          (ceil(max(x)) + 2) * 1.0 as bxmax, (ceil(max(y)) + 2) * 1.0 as bymax from v_zone group by z""")


@register("basin_clip_join", sql_ctes(("v_grid", "v_zone"), [_SQL_G, _SQL_CLIP], """
select b.z, g.t, g.r, g.c, g.swe as v from g join clip b
  on g.c + 0.5 >= b.bxmin and g.c + 0.5 < b.bxmax and g.r + 0.5 > b.bymin and g.r + 0.5 <= b.bymax"""))
def basin_clip_join(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return basin_clip(one(fx, "swe"), basin_windows(fx.zones)).select("z", "t", "r", "c", "v")


SERIES = (199201, 200301)       # first step and the step after the last: the whole calendar of the tables


def in_series(col: str = "t") -> "F.Column":
    return (F.col(col) >= SERIES[0]) & (F.col(col) < SERIES[1])


def basin_series(fx: Fixtures) -> DataFrame:
    """Filled SWE of every basin's window and step of [start, end): z, t, r, c (from the window's corner), v.

    The windows go through the fill: only they and their surroundings are read and filled.
    """
    windows = basin_windows(fx.zones)
    swe = FL.fill_nodata(lakefixed(fx, "swe").where(in_series()), FILL_DISTANCE, windows=windows)
    return basin_clip(swe, windows).select("z", "t", (F.col("r") - F.col("r0")).alias("r"), (F.col("c") - F.col("c0")).alias("c"), "v")


_SQL_BASIN = [_SQL_CLIP, ("bs", f"""
select b.z, s.t, cast(s.r - greatest(floor(b.bymin - 0.5) + 1, 0) as int) as r, cast(s.c - greatest(ceil(b.bxmin - 0.5), 0) as int) as c, s.v
from swe_f s join clip b
  on s.c + 0.5 >= b.bxmin and s.c + 0.5 < b.bxmax and s.r + 0.5 > b.bymin and s.r + 0.5 <= b.bymax
where s.t >= {SERIES[0]} and s.t < {SERIES[1]}""")]


@register("basin_series_interpolated", sql_ctes(("v_grid", "v_zone", "v_mask"), [*_SQL_SWE_F, *_SQL_BASIN], sql_pyramid("bs", "z, t")))
def basin_series_interpolated(spark, sf_dir):
    """Filled SWE per basin (buffered envelope) for every time step of the range, each grid with its overviews."""
    return rounded(with_pyramid(basin_series(Fixtures(spark, sf_dir)), keys=("z", "t")))


_SQL_BASIN_ID = dict(C.PUBLISH_IDS)["nohrsc_snodas_swe_interpolated"]


@register("basin_series_manifest", sql_ctes(("v_grid", "v_zone", "v_mask"), [*_SQL_SWE_F, *_SQL_BASIN], f"""
select bs.z, bs.t, '{_SQL_BASIN_ID}' as product,
       concat(lower(replace(n, ' ', '')), '_swe_interpolated_', strftime({SQL_SHIFT.replace(' t ', ' bs.t ')}, '%Y%m%d'), '_cog.tif') as file,
       strftime(cast({SQL_SHIFT} as timestamp), '%Y-%m-%dT%H:%M:%S') as datetime,
       max(r) + 1 as n_rows, max(c) + 1 as n_cols, count(v) as n_valid, round(min(v), 6) as v_min, round(max(v), 6) as v_max
from bs join (select distinct z, n from v_zone) q on q.z = bs.z group by bs.z, bs.t, n"""))
def basin_series_manifest(spark, sf_dir):
    """The publish call of every grid of the basin series: product id, file, datetime, and what the grid holds."""
    fx = Fixtures(spark, sf_dir)
    grids = basin_series(fx).groupBy("z", "t").agg(
        (F.max("r") + 1).alias("n_rows"), (F.max("c") + 1).alias("n_cols"), F.count("v").alias("n_valid"),
        F.round(F.min("v"), 6).alias("v_min"), F.round(F.max("v"), 6).alias("v_max"))
    when = shifted_date("t")
    return grids.join(zone_names(fx), "z").select(
        "z", "t", F.lit(_SQL_BASIN_ID).alias("product"),
        F.concat(F.lower(F.replace("n", F.lit(" "), F.lit(""))), F.lit("_swe_interpolated_"), F.date_format(when, "yyyyMMdd"),
                 F.lit("_cog.tif")).alias("file"),
        N.iso_text(when.cast("timestamp_ntz")).alias("datetime"), "n_rows", "n_cols", "n_valid", "v_min", "v_max")


def inches_stats(fx: Fixtures, swe: DataFrame, start: int | None = None, end: int | None = None, members=None) -> DataFrame:
    """Statistics in inches per step of [start, end) and zone; a zone without valid cells has count 0 and no values."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col("t") >= start)
    if end is not None:
        inside = inside & (F.col("t") < end)
    members = Z.zone_members(fx.zones, LATTICE, LATTICE) if members is None else members
    g = Z.zonal_stats(swe.where(inside), members, zone_names(fx), times=fx.times.where(inside))
    return g.select("t", "z", "n", N.mm_to_inches("min").alias("min_inches"), N.mm_to_inches("max").alias("max_inches"),
                    N.mm_to_inches("mean").alias("mean_inches"), "count")


_SQL_INCH = """
select zt.t, zt.z, zt.n, round(min(g.v) * 0.0393701, 3) as min_inches, round(max(g.v) * 0.0393701, 3) as max_inches,
       round(avg(g.v) * 0.0393701, 3) as mean_inches, count(g.v) as count
from (select distinct z, n, t from v_zone, (select distinct t from v_grid) tt) zt
left join z_inside i on i.z = zt.z left join {src} g on g.t = zt.t and g.r = i.r and g.c = i.c
group by zt.t, zt.z, zt.n"""


@register("mm_to_inches", sql_ctes(("v_grid", "v_zone"), [_SQL_G, SQL_SWE, *Z.sql_zone_members()],
                                   "select t, z, min_inches, max_inches, mean_inches from ("
                                   + _SQL_INCH.format(src="swe_raw") + ") q"))
def mm_to_inches(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return inches_stats(fx, one(fx, "swe")).select("t", "z", "min_inches", "max_inches", "mean_inches")


@register("zone_properties", sql_ctes(("v_grid", "v_zone"), [_SQL_G, SQL_SWE, *Z.sql_zone_members()],
                                      "select t, n as HU_10, n as HU_10_NAME, min_inches, max_inches, mean_inches, count from ("
                                      + _SQL_INCH.format(src="swe_raw") + ") q"))
def zone_properties(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    s = inches_stats(fx, one(fx, "swe"))
    props = F.struct(F.col("n").alias("HU_10"), F.col("n").alias("HU_10_NAME"), "min_inches", "max_inches",
                     "mean_inches", "count").alias("p")
    return s.select("t", props).select("t", "p.*")


# ------------------------------------------------------- georeference, projection
_SQL_RULES = ("rules", """
select dataset, valid_from, cast(ulx as double) as ulx, cast(uly as double) as uly,
       cast(lrx as double) as lrx, cast(lry as double) as lry,
       lead(valid_from) over (partition by dataset order by valid_from) as valid_to,
       min(valid_from) over (partition by dataset) as first_from
from (values """ + ", ".join(f"('{d}', date '{f}', {a!r}, {b!r}, {c!r}, {e!r})" for d, f, a, b, c, e in P.GEOREF_RULES)
              + ") as v(dataset, valid_from, ulx, uly, lrx, lry)")
_SQL_ASOF = """join rules u on u.dataset = {ds} and ({d} >= u.valid_from or u.valid_from = u.first_from)
  and (u.valid_to is null or {d} < u.valid_to)"""


def georef_times(fx: Fixtures) -> DataFrame:
    """Each grid step with its fixture date and the unmasked-dataset corners in force."""
    ts = fx.times.select("t", shifted_date("t").alias("d"), F.lit("unmasked").alias("dataset"))
    return P.georef_asof(ts, P.georef_table(fx.spark))


@register("georef_asof_join", sql_ctes((), [("dates", "select distinct cast(o_orderdate + interval 14 year as date) as d from orders"),
                                            _SQL_RULES], f"""
select x.d, x.dataset, u.valid_from, u.ulx, u.uly, u.lrx, u.lry
from (select d, unnest(['unmasked', 'masked']) as dataset from dates) x
{_SQL_ASOF.format(ds='x.dataset', d='x.d')}"""))
def georef_asof_join(spark, sf_dir):
    d = Fixtures(spark, sf_dir).shifted_dates
    x = d.select("d", F.explode(F.array(F.lit("unmasked"), F.lit("masked"))).alias("dataset"))
    return P.georef_asof(x, P.georef_table(spark)).select("d", "dataset", "valid_from", "ulx", "uly", "lrx", "lry")


def georeferenced(fx: Fixtures) -> DataFrame:
    """Lattice cells with cell-centre longitude / latitude by the rule of their date."""
    g = raw_grid(fx).join(georef_times(fx).select("t", "ulx", "uly", "lrx", "lry"), "t")
    x, y = P.cell_centres(LATTICE, LATTICE)
    return g.select("t", "r", "c", "swe", x.alias("lon"), y.alias("lat"), "ulx", "uly", "lrx", "lry")


_SQL_GEO = ("geo", f"""
select g.t, g.r, g.c, g.swe, u.ulx, u.uly, u.lrx, u.lry,
       u.ulx + (g.c + 0.5) * (u.lrx - u.ulx) / {LATTICE} as lon,
       u.uly + (g.r + 0.5) * (u.lry - u.uly) / {LATTICE} as lat
from g, (select distinct t, {SQL_SHIFT} as d from v_grid) tt
{_SQL_ASOF.format(ds="'unmasked'", d='tt.d')}
where tt.t = g.t""")


@register("assign_georef", sql_ctes(("v_grid",), [_SQL_G, _SQL_RULES, _SQL_GEO], """
select t, r, c, round(lon, 9) as lon, round(lat, 9) as lat from geo"""))
def assign_georef(spark, sf_dir):
    g = georeferenced(Fixtures(spark, sf_dir))
    return g.select("t", "r", "c", F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"))


CROP = (-110.0, 35.0, -90.0, 48.0)   # xmin, ymin, xmax, ymax (degrees)


@register("crop_extent", sql_ctes(("v_grid",), [_SQL_G, _SQL_RULES, _SQL_GEO], f"""
select t, r, c, swe from geo
where lon >= {CROP[0]} and lon < {CROP[2]} and lat > {CROP[1]} and lat <= {CROP[3]}"""))
def crop_extent(spark, sf_dir):
    g = georeferenced(Fixtures(spark, sf_dir))
    xmin, ymin, xmax, ymax = CROP
    lon, lat = F.col("lon"), F.col("lat")
    return g.where((lon >= xmin) & (lon < xmax) & (lat > ymin) & (lat <= ymax)).select("t", "r", "c", "swe")


_FE, _FN = P.forward_sql("lon", "lat")
_IL, _IA = P.inverse_sql("ex", "ny")


@register("albers_project", sql_ctes(("v_grid",), [_SQL_G, _SQL_RULES, _SQL_GEO,
                                                   ("prj", f"select t, r, c, {_FE} as ex, {_FN} as ny from geo")], f"""
select t, r, c, round(ex, 4) as easting, round(ny, 4) as northing,
       round({_IL}, 8) as lon_back, round({_IA}, 8) as lat_back from prj"""))
def albers_project(spark, sf_dir):
    g = georeferenced(Fixtures(spark, sf_dir))
    ex, ny = P.albers_forward("lon", "lat")
    p = g.select("t", "r", "c", ex.alias("ex"), ny.alias("ny"))
    lo, la = P.albers_inverse("ex", "ny")
    return p.select("t", "r", "c", F.round("ex", 4).alias("easting"), F.round("ny", 4).alias("northing"),
                    F.round(lo, 8).alias("lon_back"), F.round(la, 8).alias("lat_back"))


# target lattice: 50 km equal-area cells over the conterminous grid
TARGET = dict(x0=-2300000.0, y0=3150000.0, size=50000.0, n_cols=80, n_rows=56)


UNMASKED_RULES = [r for r in P.GEOREF_RULES if r[0] == "unmasked"]


def target_weights(spark) -> DataFrame:
    """Per rule period: target cell -> its 4 source neighbours with bilinear weights.

    The rule set is fixed (two periods of the unmasked grid), so each target
    cell is exploded over a literal array of rule corners; no join is needed.
    """
    tl = P.target_lattice(spark, **TARGET)
    lon, lat = P.albers_inverse("ex", "ny")
    tl = tl.select("tr", "tc", lon.alias("lon"), lat.alias("lat"))
    rules = F.array(*[F.struct(F.to_date(F.lit(f)).alias("rule_from"), F.lit(a).alias("ulx"), F.lit(b).alias("uly"),
                               F.lit(c).alias("lrx"), F.lit(e).alias("lry"))
                      for _, f, a, b, c, e in UNMASKED_RULES])
    t2 = tl.select("tr", "tc", "lon", "lat", F.explode(rules).alias("u")).select("tr", "tc", "lon", "lat", "u.*")
    return P.bilinear_weights(t2, LATTICE, LATTICE)


_SQL_TW = [
    ("tl", f"""
select tr, tc, {TARGET['x0']!r} + (tc + 0.5) * {TARGET['size']!r} as ex, {TARGET['y0']!r} - (tr + 0.5) * {TARGET['size']!r} as ny
from (select cast(range as int) as tr from range({TARGET['n_rows']})) a, (select cast(range as int) as tc from range({TARGET['n_cols']})) b"""),
    ("tll", f"select tr, tc, {_IL} as lon, {_IA} as lat from tl"),
    ("fx", f"""
select tr, tc, valid_from as rule_from,
       (lon - ulx) / ((lrx - ulx) / {LATTICE}) - 0.5 as fc, (lat - uly) / ((lry - uly) / {LATTICE}) - 0.5 as fr
from tll, (select * from rules where dataset = 'unmasked') u"""),
    ("wx", """
select tr, tc, rule_from, cast(floor(fr) as int) as r0, cast(floor(fc) as int) as c0,
       fc - floor(fc) as wx, fr - floor(fr) as wy from fx"""),
    ("nb", f"""
select * from (
  select tr, tc, rule_from, r0 as r, c0 as c, (1 - wx) * (1 - wy) as w from wx
  union all select tr, tc, rule_from, r0, c0 + 1, wx * (1 - wy) from wx
  union all select tr, tc, rule_from, r0 + 1, c0, (1 - wx) * wy from wx
  union all select tr, tc, rule_from, r0 + 1, c0 + 1, wx * wy from wx) q
where r between 0 and {LATTICE - 1} and c between 0 and {LATTICE - 1}"""),
]


@register("bilinear_join", sql_ctes(("v_grid",), [_SQL_RULES, *_SQL_TW], f"""
select rule_from, tr, tc, r, c, round(w, 6) as w from nb where rule_from in (
  select u.valid_from from (select distinct {SQL_SHIFT} as d from v_grid) tt {_SQL_ASOF.format(ds="'unmasked'", d='tt.d')})"""))
def bilinear_join(spark, sf_dir):
    """Target cells of the equal-area lattice with their source neighbours and weights,
    for every georeference period in force over the grid steps of the tables."""
    fx = Fixtures(spark, sf_dir)
    used = georef_times(fx).select("valid_from").distinct().withColumnRenamed("valid_from", "rule_from")
    w = target_weights(spark).join(used, "rule_from", "left_semi")
    return w.select("rule_from", "tr", "tc", "r", "c", F.round("w", 6).alias("w"))


def warp_steps(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    """Each step with its georeference rule (named by its first day), and the corners of the rules."""
    steps = georef_times(fx).select("t", F.col("valid_from").alias("rule"))
    rules = P.georef_table(fx.spark).where("dataset = 'unmasked'").select(F.col("valid_from").alias("rule"), "ulx", "uly", "lrx", "lry")
    return steps, rules


def _sql_warped(src: str, name: str) -> list[tuple[str, str]]:
    """DuckDB CTE ``name``: a (t, r, c, v) relation warped to the target lattice (cells with a value)."""
    return [_SQL_RULES, *_SQL_TW, (f"{name}_vals", f"""
select g.t, u.valid_from as rule_from, g.r, g.c, g.v
from {src} g, (select distinct t, {SQL_SHIFT} as d from v_grid) tt
{_SQL_ASOF.format(ds="'unmasked'", d='tt.d')}
where tt.t = g.t"""), (name, f"""
select v.t, n.tr as r, n.tc as c, sum(n.w * v.v) / sum(n.w) as v
from {name}_vals v join nb n on n.rule_from = v.rule_from and n.r = v.r and n.c = v.c
where v.v is not null group by v.t, n.tr, n.tc""")]


@register("reproject_grid", sql_ctes(("v_grid",), [_SQL_G, SQL_SWE, *_sql_warped("swe_raw", "warped")], """
select f.t, f.tr, f.tc, round(x.v, 6) as v
from (select t, tr, tc from (select distinct t from v_grid) a, tl) f
left join warped x on x.t = f.t and x.r = f.tr and x.c = f.tc"""))
def reproject_grid(spark, sf_dir):
    """SWE warped to 50 km equal-area cells by bilinear weights (valid neighbours only); every target cell has a row."""
    fx = Fixtures(spark, sf_dir)
    return rounded(P.warp(one(fx, "swe"), *warp_steps(fx), TARGET, LATTICE, LATTICE))


# ------------------------------------------------- statistics over projected zones
#: Corners that place the stand-in zones (in lattice units) on the globe.
ZONE_CORNERS = UNMASKED_RULES[-1][2:]
_LON = f"({ZONE_CORNERS[0]!r} + x * ({ZONE_CORNERS[2] - ZONE_CORNERS[0]!r}) / {LATTICE})"
_LAT = f"({ZONE_CORNERS[1]!r} + y * ({ZONE_CORNERS[3] - ZONE_CORNERS[1]!r}) / {LATTICE})"


def degree_zones(fx: Fixtures) -> DataFrame:
    """The stand-in zones with holes, their vertices in degrees."""
    return holed_zones(fx).select("z", "ring", "i", F.expr(_LON).alias("x"), F.expr(_LAT).alias("y"))


def degree_windows(zones: DataFrame, rules: DataFrame) -> DataFrame:
    """Source cells (r0..r1, c0..c1) around each zone in degrees that warping its cells may look at, under any of the rules."""
    at = Z.zone_envelope(zones).select("*", F.explode(P.corner_array(P.rule_corners(rules))).alias("u"))

    def place(value: str, first: str, last: str):
        return F.floor((F.col(value) - F.col(f"u.{first}")) / ((F.col(f"u.{last}") - F.col(f"u.{first}")) / LATTICE) - 0.5)

    return at.groupBy("z").agg(
        F.greatest(F.min(place("ymax", "uly", "lry")), F.lit(0)).cast("int").alias("r0"),
        F.least(F.max(place("ymin", "uly", "lry")) + 1, F.lit(LATTICE - 1)).cast("int").alias("r1"),
        F.greatest(F.min(place("xmin", "ulx", "lrx")), F.lit(0)).cast("int").alias("c0"),
        F.least(F.max(place("xmax", "ulx", "lrx")) + 1, F.lit(LATTICE - 1)).cast("int").alias("c1")).where("r0 <= r1 and c0 <= c1")


def projected_members(zones: DataFrame) -> DataFrame:
    """Cells of the target lattice inside zones in degrees."""
    return Z.edge_members(P.project_edges(Z.zone_edges(zones), TARGET), TARGET["n_rows"], TARGET["n_cols"])


_SQL_DEGREE_ZONES = [SQL_HOLED, ("zd", f"select z, ring, i, {_LON} as x, {_LAT} as y from hz"),
                     *Z.sql_zone_members("zd", "select tr as r, tc as c, lon as px, lat as py from tll", ring="ring")]


@register("zone_projected_cells", sql_ctes(("v_zone", "v_lattice"), [_SQL_RULES, *_SQL_TW[:2], *_SQL_DEGREE_ZONES], "select z, r, c from z_inside"))
def zone_projected_cells(spark, sf_dir):
    """Equal-area cells whose centre lies inside a zone given in degrees (with holes)."""
    members = projected_members(degree_zones(Fixtures(spark, sf_dir)))
    return members.select("z", "r", F.explode(F.sequence("lo", "hi")).alias("c"))


@register("zonal_series", sql_ctes(("v_grid", "v_zone", "v_mask"), [*_SQL_SWE_F, *_sql_warped("swe_f", "warped"), *_SQL_DEGREE_ZONES],
                                   f"select t, max_by(n, z) as zone_name, max_by(min_inches, z) as min_inches, max_by(max_inches, z) as max_inches, "
                                   "max_by(mean_inches, z) as mean_inches, max_by(count, z) as count from ("
                                   + _SQL_INCH.format(src="warped") + f") q where t >= {SERIES[0]} and t < {SERIES[1]} group by t, n"))
def zonal_series(spark, sf_dir):
    """Per time step of [start, end) and zone name: statistics of filled SWE, warped to equal-area cells, in inches.

    The zones come in degrees.  Only the source windows around them are filled
    and only the target tiles that hold cells of theirs are warped.  Of equal
    names the last zone's row stays.
    """
    fx = Fixtures(spark, sf_dir)
    zones = degree_zones(fx)
    steps, rules = warp_steps(fx)
    members = materialize(projected_members(zones), "members")
    tiles = members.select(F.floor(F.col("r") / P.TARGET_TILE).cast("int").alias("wr"), F.explode(F.sequence(
        F.floor(F.col("lo") / P.TARGET_TILE).cast("int"), F.floor(F.col("hi") / P.TARGET_TILE).cast("int"))).alias("wc")).distinct()
    swe = FL.fill_nodata(lakefixed(fx, "swe").where(in_series()), FILL_DISTANCE, windows=degree_windows(zones, rules))
    warped = P.warp(swe, steps.where(in_series()), rules, TARGET, LATTICE, LATTICE, tiles=tiles)
    s = inches_stats(fx, warped.select("t", F.col("tr").alias("r"), F.col("tc").alias("c"), "v"), *SERIES, members=members)
    return C.last_per_key(s, ["t", "n"], "z").select("t", F.col("n").alias("zone_name"), "min_inches", "max_inches", "mean_inches", "count")


# --------------------------------------------------------- daily products
DAILY_PRODUCTS = [  # filetype, name pattern key
    ("nohrsc_snodas_swe", "nohrsc_snodas_swe"),
    ("nohrsc_snodas_snowdepth", "nohrsc_snodas_snowdepth"),
    ("nohrsc_snodas_snowpack_average_temperature", "nohrsc_snodas_snowpack_average_temperature"),
    ("nohrsc_snodas_snowmelt", "nohrsc_snodas_snowmelt"),
    ("nohrsc_snodas_coldcontent", "nohrsc_snodas_coldcontent"),
    ("nohrsc_snodas_snowmelt", "nohrsc_snodas_snowmeltmm"),
]
_ALL_NAMES = {**N.SNOW_PARAMETERS, **N.COMPUTED_PRODUCTS}


def _sql_member_t(pattern):
    head, mid, tail = pattern.split("{}")
    return f"concat('{head}', 'zz', '{mid}', strftime(dt, '%Y%m%d'), '{tail}', '_cloud_optimized.tif')"


_SQL_DAILY = ("daily", "select t, filetype, file, strftime(dt, '%Y-%m-%dT%H:%M:%S') as datetime, "
              "cast(null as varchar) as version from (select *, row_number() over (partition by t, filetype "
              "order by seq desc) as k from (select tt.t, tt.dt, e.* from (select distinct t, "
              f"cast({SQL_SHIFT} as timestamp) + interval 6 hour as dt from v_grid) tt, (values "
              + ", ".join(f"({i}, '{ft}', '{k}')" for i, (ft, k) in enumerate(DAILY_PRODUCTS))
              + ") as e(seq, filetype, pk)) x) y where k = 1")


def _sql_daily_files():
    cases = " ".join(f"when '{k}' then {_sql_member_t(p)}" for k, p in _ALL_NAMES.items())
    return ("daily", _SQL_DAILY[1].replace("select tt.t, tt.dt, e.*",
                                           f"select tt.t, tt.dt, e.seq, e.filetype, case e.pk {cases} end as file"))


_DAILY_SQL = {"nohrsc_snodas_swe": "swe", "nohrsc_snodas_snowdepth": "depth", "nohrsc_snodas_snowpack_average_temperature": "temp_k",
              "nohrsc_snodas_snowmelt": "melt", "nohrsc_snodas_coldcontent": SQL_CC_EXPR.format(t="temp_k", s="swe"),
              "nohrsc_snodas_snowmeltmm": "melt * 0.01"}


@register("snow_daily_products", sql_ctes(("v_grid",), [_SQL_G, _sql_daily_files(), ("pk_of", """
select * from (values """ + ", ".join(f"('{ft}', '{k}')" for ft, k in dict(DAILY_PRODUCTS).items()) + ") as p(filetype, pk)")],
    "select d.t, d.filetype, d.file, d.datetime, d.version, g.r, g.c, round(case p.pk "
    + " ".join(f"when '{k}' then {e}" for k, e in _DAILY_SQL.items()) + """ end, 6) as v
from daily d join pk_of p on p.filetype = d.filetype join g on g.t = d.t"""))
def snow_daily_products(spark, sf_dir):
    """The grids of each day's products with their files: four parameters, cold content, and melt in mm in place of raw melt."""
    fx = Fixtures(spark, sf_dir)
    g = raw_grid(fx)
    values = {"nohrsc_snodas_swe": F.col("swe"), "nohrsc_snodas_snowdepth": F.col("depth"),
              "nohrsc_snodas_snowpack_average_temperature": F.col("temp_k"), "nohrsc_snodas_snowmelt": F.col("melt"),
              "nohrsc_snodas_coldcontent": K.cold_content("temp_k", "swe"), "nohrsc_snodas_snowmeltmm": K.scale_values("melt", K.MELT_TO_MM)}
    when = shifted_date("t").cast("timestamp_ntz") + F.expr("interval 6 hours")
    # One pass over the cells: of the products of one filetype the last in the list stays.
    products = F.array(*[F.struct(F.lit(ft).alias("filetype"),
                                  F.concat(N.member_name(_ALL_NAMES[k], when, F.lit("unmasked")), F.lit("_cloud_optimized.tif")).alias("file"),
                                  values[k].alias("v")) for ft, k in dict(DAILY_PRODUCTS).items()])
    x = g.select("t", "r", "c", when.alias("dt"), F.explode(products).alias("p"))
    return rounded(x.select("t", "p.filetype", "p.file", N.iso_text("dt").alias("datetime"),
                            F.lit(None).cast("string").alias("version"), "r", "c", "p.v"))


@register("product_union", sql_ctes(("v_grid",), [_SQL_G], f"""
select 'swe' as product, t, r, c, swe as v from g
union all select 'coldcontent', t, r, c, {SQL_CC_EXPR.format(t='temp_k', s='swe')} from g
union all select 'snowmeltmm', t, r, c, melt * 0.01 from g"""))
def product_union(spark, sf_dir):
    """Outputs of several steps collected into one long product table, in one pass over the grid."""
    g = raw_grid(Fixtures(spark, sf_dir))
    products = F.array(*[F.struct(F.lit(name).alias("product"), v.alias("v")) for name, v in (
        ("swe", F.col("swe")), ("coldcontent", K.cold_content("temp_k", "swe")),
        ("snowmeltmm", K.scale_values("melt", K.MELT_TO_MM)))])
    return g.select("t", "r", "c", F.explode(products).alias("p")).select("p.product", "t", "r", "c", "p.v")


_SHORT = ["swe", "snowdepth", "snowpack_average_temperature", "snowmelt", "coldcontent", "snowmeltmm"]


@register("publish_id_join", sql_ctes(("v_cells",), [(
    "publish_ids", "select * from (values " + ", ".join(f"('{a}', '{b}')" for a, b in C.PUBLISH_IDS)
    + ") as v(name, product_uuid)")], f"""
select t, name, product_uuid from (select distinct t from v_cells) tt,
  (select unnest([{', '.join(repr(s) for s in _SHORT)}]) as name) nn
join publish_ids using (name)"""))
def publish_id_join(spark, sf_dir):
    """Daily product names of every step mapped to their published ids (unknown names drop out)."""
    ts = Fixtures(spark, sf_dir).times
    x = ts.select("t", F.explode(F.array(*[F.lit(s) for s in _SHORT])).alias("name"))
    return x.join(F.broadcast(C.publish_ids(spark)), "name", "inner").select("t", "name", "product_uuid")
