"""Registered queries over the stand-in grids: point-wise, zonal, cold content."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import LATTICE, Fixtures, sql_ctes
from ..operators import cells as K
from ..operators import zones as Z
from .registry import register

GRID_VIEWS = ("v_grid",)


def raw_grid(fx: Fixtures):
    """v_grid with both sentinels turned into NULL."""
    g = fx.grid
    return g.select("t", "r", "c",
                    K.nodata_to_null("swe").alias("swe"),
                    K.nodata_to_null("temp_k").alias("temp_k"),
                    K.nodata_to_null("melt").alias("melt"),
                    K.nodata_to_null("depth").alias("depth"))


_SQL_G = ("g", "select t, r, c, nullif(swe, -9999.0) as swe, nullif(temp_k, -9999.0) as temp_k, "
               "nullif(melt, -9999.0) as melt, nullif(depth, -9999.0) as depth from v_grid")
_SQL_CC = ("cc", """
select t, r, c,
       case when temp_k - 273.15 >= 0 then 0.0
            when swe is null or temp_k - 273.15 is null then null
            else swe * 2114 * (temp_k - 273.15) / 333000 end as v
from g""")


def zone_names(fx: Fixtures):
    return fx.zones.select("z", "n").distinct()


def zonal_coldcontent_df(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    g = raw_grid(fx)
    cc = g.select("t", "r", "c", K.cold_content("temp_k", "swe").alias("v"))
    members = Z.zone_members(fx.zones, LATTICE, LATTICE)
    out = Z.zonal_stats(cc, members, zone_names(fx), prefix="cc_", times=fx.times)
    return out.select("t", F.col("z").alias("zone_id"), F.col("n").alias("zone_name"),
                      "cc_min", "cc_max", F.round("cc_mean", 6).alias("cc_mean"), "cc_count")


register("zonal_coldcontent", sql_ctes(
    ("v_grid", "v_zone"),
    [_SQL_G, _SQL_CC, *Z.sql_zone_members(),
     ("zt", "select distinct z, n, t from v_zone, (select distinct t from v_grid) tt")],
    """
select zt.t, zt.z as zone_id, zt.n as zone_name,
       min(cc.v) as cc_min, max(cc.v) as cc_max, round(avg(cc.v), 6) as cc_mean,
       cast(count(cc.v) as bigint) as cc_count
from zt left join z_inside i on i.z = zt.z
left join cc on cc.t = zt.t and cc.r = i.r and cc.c = i.c
group by zt.t, zt.z, zt.n"""))(zonal_coldcontent_df)
