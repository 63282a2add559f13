"""Registered queries for sources, sinks and streams.

Every query writes what it needs (derived from the driver tables by Spark)
into a fresh folder under the shared ``spark.checkpoint.dir`` and reads it
back through the real source, so the scan and sink code paths are the ones
being checked.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixtures import LATTICE, Fixtures, sql_ctes
from ..functions import names as N
from ..operators import catalog as C
from ..operators import cells as K
from ..operators import zones as Z
from ..session import scratch_path
from ..sinks import documents as D
from ..sinks import grids as S
from ..sources import rasters as R
from .q_grid import _SQL_G, raw_grid
from .q_records import SQL_PRODUCTS, SQL_REGISTRATIONS, _sql_hv, band_inventory_json
from .q_records import SQL_EXISTING, SQL_FRESH, SQL_INSERTS, SQL_DEF, product_table
from .q_transforms import _SQL_GEO, _SQL_RULES, CROP, SQL_CC_EXPR, SQL_HOLED, SQL_INTERPOLATE_ALL, SQL_SHIFT, georef_times, holed_zones
from .q_transforms import interpolate_all, materialize, shifted_date, zone_names
from .registry import register

_SQL_RAW_SWE = f"""
select t, r, c, case when swe = -9999.0 then null else round(swe) end as v from v_grid"""


def _grid_files(fx: Fixtures, kind: str) -> str:
    """Write the SWE grids in one raw container format; return the folder."""
    base = scratch_path(fx.spark, "rawgrids")
    cells = raw_grid(fx).select("t", "r", "c", F.col("swe").alias("v"))
    R.write_grid_files(cells, base, LATTICE, LATTICE, headers=fx.header, kinds=(kind,)).write.format("noop").mode("overwrite").save()
    return base


def _t_from_path(pattern: str):
    return F.regexp_extract("path", pattern, 1).cast("int")


def _scan(fx: Fixtures, sub: str, glob: str, kind: str, member_of=None) -> DataFrame:
    base = _grid_files(fx, kind)
    files = R.read_binary(fx.spark, os.path.join(base, sub), glob)
    cells = R.tiles_to_cells(R.decode_grids(files, LATTICE, kind, member_of, n_rows=LATTICE))
    return cells.select(_t_from_path(r"grid_(\d+)").alias("t"), "r", "c", "v")


@register("flat_grid_scan", sql_ctes(("v_grid",), [], _SQL_RAW_SWE))
def flat_grid_scan(spark, sf_dir):
    """Headerless big-endian int16 grids decoded in the tasks."""
    return _scan(Fixtures(spark, sf_dir), "raw", "*.bil", "raw")


@register("gz_member_scan", sql_ctes(("v_grid",), [], _SQL_RAW_SWE))
def gz_member_scan(spark, sf_dir):
    return _scan(Fixtures(spark, sf_dir), "gz", "*.bil.gz", "gz")


@register("zipped_grid_scan", sql_ctes(("v_grid",), [], _SQL_RAW_SWE))
def zipped_grid_scan(spark, sf_dir):
    """``<name>.bil`` read from inside ``<name>_bil.zip``."""
    member = lambda p: os.path.basename(p).replace("_bil.zip", ".bil")
    return _scan(Fixtures(spark, sf_dir), "zip", "*_bil.zip", "zip", member)


def _index(fx: Fixtures) -> DataFrame:
    """Index of the members of the daily archives, with the step of the archive."""
    index = R.archive_index(fx.spark, os.path.join(_grid_files(fx, "tar"), "tar"), "*.tar")
    return index.select(_t_from_path(r"archive_(\d+)\.tar").alias("t"), "path", "member", "offset", "size")


_SQL_TAR = ("tars", """
select distinct t, concat('grid_', t, '.dat.gz') as member, 8192 as n_bytes from v_grid
union all
select h.t, concat('grid_', h.t, '.txt.gz'), octet_length(encode(h.content)) from v_header h
where h.t in (select t from v_grid)""")


@register("archive_member_scan", sql_ctes(("v_grid", "v_header"), [_SQL_TAR],
                                          "select cast(t as int) as t, member, cast(n_bytes as int) as n_bytes from tars"))
def archive_member_scan(spark, sf_dir):
    """Every member of the daily tar archives, unpacked one by one in the tasks: (t, member, bytes)."""
    m = R.archive_members(_index(Fixtures(spark, sf_dir)))
    return m.select(_t_from_path(r"archive_(\d+)\.tar").alias("t"), "member", F.length("data").alias("n_bytes"))


@register("header_text_scan", sql_ctes(("v_grid", "v_header"), [], f"""
select cast(t as int) as t, {_sql_hv('Number of columns')} as cols, {_sql_hv('Number of rows')} as rows,
       {_sql_hv('No data value')} as nodata
from v_header where t in (select t from v_grid)"""))
def header_text_scan(spark, sf_dir):
    """Header member of each archive, decoded and parsed by keyword; the index is filtered, so no grid is read."""
    wanted = _index(Fixtures(spark, sf_dir)).where(F.col("member").endswith(".txt.gz"))
    txt = R.archive_members(wanted).select(_t_from_path(r"archive_(\d+)\.tar").alias("t"), F.decode("data", "UTF-8").alias("content"))
    return txt.select("t", N.header_value("content", "Number of columns").alias("cols"),
                      N.header_value("content", "Number of rows").alias("rows"),
                      N.header_value("content", "No data value").alias("nodata"))


# -------------------------------------------------------------- band inventory
INVENTORY = T.StructType([T.StructField("bands", T.ArrayType(T.StructType([
    T.StructField("band", T.IntegerType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))),
])))])


@register("band_inventory_scan", sql_ctes(("v_band",), [], """
select file_id, cast(row_number() over (partition by file_id order by band) - 1 as int) as pos, band,
       valid_time, comment from v_band where file_id % 13 <> 0"""))
def band_inventory_scan(spark, sf_dir):
    """Band list of each file from its JSON inventory; unparsable text gives zero bands."""
    inv = band_inventory_json(Fixtures(spark, sf_dir))
    parsed = inv.select("file_id", F.from_json("info", INVENTORY, {"mode": "PERMISSIVE"}).alias("j"))
    bands = parsed.select("file_id", F.posexplode(F.coalesce(F.col("j.bands"), F.array())).alias("pos", "b"))
    return bands.select("file_id", "pos", F.col("b.band").alias("band"),
                        F.col("b.metadata")[""]["GRIB_VALID_TIME"].alias("valid_time"),
                        F.col("b.metadata")[""]["GRIB_COMMENT"].alias("comment"))


# ------------------------------------------------------------------- catalog
@register("catalog_scan", sql_ctes(("v_acquirable",), [SQL_PRODUCTS], "select name, product_id from products"))
def catalog_scan(spark, sf_dir):
    """Catalog tables persisted as Parquet and read back with only the used columns."""
    fx = Fixtures(spark, sf_dir)
    base = scratch_path(spark, "catalog")
    fx.acquirable.write.mode("overwrite").parquet(f"{base}/acquirable")
    product_table(fx).withColumn("description", F.lit("stand-in product")) \
        .write.mode("overwrite").parquet(f"{base}/product")
    acq = spark.read.parquet(f"{base}/acquirable").select("name")
    prod = spark.read.parquet(f"{base}/product").select("name", "product_id")
    return prod.join(acq, "name", "left_semi")


# --------------------------------------------------------------------- sinks
BANDS = ("swe", "temp_k", "melt")


def _written_grid(fx: Fixtures) -> str:
    path = scratch_path(fx.spark, "grid")
    S.write_grid(raw_grid(fx), georef_times(fx), path, BANDS, LATTICE, LATTICE, "EPSG:4269", tile=16)
    return path


@register("grid_write", sql_ctes(("v_grid",), [_SQL_G, _SQL_RULES, _SQL_GEO], """
select g.t, g.r, g.c, g.swe, g.temp_k, g.melt, round(lon, 9) as x, round(lat, 9) as y, 'EPSG:4269' as crs
from g join geo on geo.t = g.t and geo.r = g.r and geo.c = g.c"""))
def grid_write(spark, sf_dir):
    """Grids written as georeferenced tiles, then read back whole: values, places and the CRS the table carries."""
    tiles = S.read_grid(spark, _written_grid(Fixtures(spark, sf_dir)))
    return S.grid_cells(tiles).select(F.col("t").cast("int").alias("t"), "r", "c", *BANDS, F.round("x", 9).alias("x"), F.round("y", 9).alias("y"),
                                      F.lit(S.grid_info(tiles)["crs"]).alias("crs"))


WINDOW_STEPS = (199701, 199801)


@register("grid_window_read", sql_ctes(("v_grid",), [_SQL_G, _SQL_RULES, _SQL_GEO], f"""
select t, r, c, swe, round(lon, 9) as x, round(lat, 9) as y from geo
where lon >= {CROP[0]} and lon < {CROP[2]} and lat > {CROP[1]} and lat <= {CROP[3]}
  and t >= {WINDOW_STEPS[0]} and t < {WINDOW_STEPS[1]}"""))
def grid_window_read(spark, sf_dir):
    """The cells of one band inside a window in degrees: steps pruned by folder, tiles by their boxes."""
    tiles = S.read_area(spark, _written_grid(Fixtures(spark, sf_dir)), *CROP, *WINDOW_STEPS)
    cells = S.grid_cells(tiles, CROP, bands=["swe"])
    return cells.select(F.col("t").cast("int").alias("t"), "r", "c", "swe", F.round("x", 9).alias("x"), F.round("y", 9).alias("y"))


_SQL_ZI = """
select zt.t, zt.n as zone_name, round(min(g.swe) * 0.0393701, 3) as min_inches, round(max(g.swe) * 0.0393701, 3) as max_inches,
       round(avg(g.swe) * 0.0393701, 3) as mean_inches, count(g.swe) as count
from (select distinct z, n, t from v_zone, (select distinct t from v_grid) tt) zt
left join z_inside i on i.z = zt.z left join g on g.t = zt.t and g.r = i.r and g.c = i.c
group by zt.t, zt.n"""
STATS_PRODUCT = "nohrsc_snodas_swe"
STATS_RUN = "zones"
_SQL_DAY = "cast({} as date)".format(SQL_SHIFT)


def _documents(spark, sf_dir) -> str:
    """Write the statistics documents of a run over all steps; the folder."""
    from .q_transforms import inches_stats, materialize, one, shifted_date
    fx = Fixtures(spark, sf_dir)
    began = time.time()
    s = C.last_per_key(inches_stats(fx, one(fx, "swe")), ["t", "n"], "z")          # equal names: the last zone's entry stays
    s = materialize(s.withColumn("day", shifted_date("t")), "zone_stats")
    first, last = (d.strftime("%Y%m%d") for d in s.agg(F.min("day"), F.date_add(F.max("day"), 1)).first())
    folder = scratch_path(spark, "documents")
    # Spark fuses warp and statistics, so the run has one time.
    D.write_documents(D.statistics_pieces(s, STATS_PRODUCT, first, last, 0, round(time.time() - began)), folder, STATS_RUN)
    return folder


def _kind(spark, sf_dir, pattern: str) -> DataFrame:
    return D.read_documents(spark, _documents(spark, sf_dir), STATS_RUN).where(F.col("name").rlike(pattern))


@register("stats_json", sql_ctes(("v_grid", "v_zone"), [_SQL_G, *Z.sql_zone_members(), ("zi", _SQL_ZI)], f"""
select concat('statistics__{STATS_PRODUCT}__', strftime({_SQL_DAY}, '%Y%m%d'), '.json') as file, zone_name, min_inches, max_inches, mean_inches, count from zi"""))
def stats_json(spark, sf_dir):
    """Per-day statistics documents (zone name -> properties, "NA" for missing) in compact JSON, read back by the run's list."""
    docs = _kind(spark, sf_dir, r"^statistics__\w+__\d{8}\.json$")
    x = docs.select(F.col("name").alias("file"), F.explode(F.from_json("text", f"struct<{D.TIMES}, result:map<string, {D.ZONE}>>")["result"]).alias("zone_name", "p"))
    return x.select("file", "zone_name", *D.zone_columns("p"))


@register("stats_run_document", sql_ctes(("v_grid", "v_zone"), [_SQL_G, *Z.sql_zone_members(), ("zi", _SQL_ZI), ("days", f"select *, {_SQL_DAY} as d from zi")], f"""
select concat('statistics__{STATS_PRODUCT}__', strftime((select min(d) from days), '%Y%m%d'), '_to_',
              strftime((select max(d) + 1 from days), '%Y%m%d'), '.json') as file,
       strftime(d, '%Y_%m_%d') as day, zone_name, min_inches, max_inches, mean_inches, count from days"""))
def stats_run_document(spark, sf_dir):
    """The document of the entire run (day -> the day's document), read back."""
    docs = _kind(spark, sf_dir, r"_to_\d{8}\.json$")
    x = docs.select(F.col("name").alias("file"), F.explode(F.from_json("text", f"map<string, struct<{D.TIMES}, result:map<string, {D.ZONE}>>>")).alias("day", "d"))
    return x.select("file", "day", F.explode("d.result").alias("zone_name", "p")).select("file", "day", "zone_name", *D.zone_columns("p"))


@register("stats_basin_documents", sql_ctes(("v_grid", "v_zone"), [_SQL_G, *Z.sql_zone_members(), ("zi", _SQL_ZI)], f"""
select concat('statistics__', lower(replace(zone_name, ' ', '')), '__{STATS_PRODUCT}__', strftime({_SQL_DAY}, '%Y%m%d'), '-000000.json') as file,
       zone_name, min_inches, max_inches, mean_inches, count from zi"""))
def stats_basin_documents(spark, sf_dir):
    """One document per (basin, product file), read back."""
    docs = _kind(spark, sf_dir, r"__\d{8}-\d{6}\.json$")
    x = docs.select(F.col("name").alias("file"), F.explode(F.from_json("text", f"struct<{D.TIMES}, result:array<{D.ZONE}>>")["result"]).alias("p"))
    return x.select("file", F.col("p.HU_10_NAME").alias("zone_name"), *D.zone_columns("p"))


HEADER_CSV = "yyyymmdd string, cols string, rows string, nodata string, xmin string, xmax string, ymin string, ymax string"


@register("header_csv_append", sql_ctes(("v_header",), [], f"""
select concat(cast(t as varchar), '01') as yyyymmdd,
       {', '.join(f"{_sql_hv(kw)} as {k}" for k, kw in N.HEADER_KEYWORDS.items())} from v_header"""))
def header_csv_append(spark, sf_dir):
    """Header values appended as CSV lines (one per step) and read back with a fixed schema."""
    h = Fixtures(spark, sf_dir).header
    vals = h.select(F.concat(F.col("t").cast("string"), F.lit("01")).alias("yyyymmdd"),
                    *[N.header_value("content", kw).alias(k) for k, kw in N.HEADER_KEYWORDS.items()])
    path = scratch_path(spark, "headers")
    early = vals.where(F.col("yyyymmdd") < "19980601")
    late = vals.where(F.col("yyyymmdd") >= "19980601")
    S.append_csv(early, path)
    S.append_csv(late, path)
    return spark.read.schema(HEADER_CSV).csv(path)


# The five daily products and what each one's files hold.
PUBLISHED = {"swe": "swe", "snowdepth": "depth", "snowpack_average_temperature": "temp_k", "snowmelt": "melt",
             "coldcontent": SQL_CC_EXPR.format(t="temp_k", s="swe")}
#: Cells of a file are 16-bit integers, so a file holds its grid divided by the smallest of these that makes all cells fit.
SCALES = [10**i for i in range(10)]
CELL_MOST = 32767
#: Files are numbered by product and step.
STEP_ROOM = 1_000_000

_SQL_PUB = [
    ("pub", "select * from all_i union all " + " union all ".join(
        f"select '{name}' as product, t, r, c, {v} as v from g" for name, v in PUBLISHED.items())),
    ("pub_scale", "select product, t, case " + " ".join(
        f"when coalesce(max(abs(round(v, 6))), 0) < {CELL_MOST * s} then {s}" for s in SCALES)
        + f" else {SCALES[-1]} end as scale from pub group by product, t"),
    ("pub_cell", """
select p.product, p.t, p.r, p.c, s.scale, cast(coalesce(floor(round(p.v, 6) / s.scale + 0.5), -9999) as int) as n
from pub p join pub_scale s on s.product = p.product and s.t = p.t"""),
    ("pub_file", f"""
select l.product, l.t, l.scale, md5(unhex(string_agg(printf('%04x', (coalesce(x.n, -9999) + 65536) % 65536), '' order by l.r, l.c))) as md5
from (select s.product, s.t, s.scale, rr.r, cc.c from pub_scale s, (select unnest(range({LATTICE})) as r) rr,
             (select unnest(range({LATTICE})) as c) cc) l
left join pub_cell x on x.product = l.product and x.t = l.t and x.r = l.r and x.c = l.c group by l.product, l.t, l.scale"""),
]


def file_scales(grids: DataFrame) -> DataFrame:
    """product, t, scale: the smallest of SCALES that makes all cells of the grid fit 16 bits."""
    largest = grids.groupBy("product", "t").agg(F.coalesce(F.max(F.abs(F.round("v", 6))), F.lit(0.0)).alias("largest"))
    scale = F.lit(SCALES[-1])
    for s in reversed(SCALES):
        scale = F.when(F.col("largest") < CELL_MOST * s, F.lit(s)).otherwise(scale)
    return largest.select("product", "t", scale.cast("int").alias("scale"))


def scaled(grids: DataFrame, scales: DataFrame) -> DataFrame:
    """The grids with their scales, cells as the whole numbers that their files hold (null for nodata)."""
    whole = F.floor(F.round("v", 6) / F.col("scale") + 0.5)
    return grids.join(scales, ["product", "t"]).withColumn("v", whole)


@register("publish_manifest", sql_ctes(("v_grid", "v_mask"), [*SQL_INTERPOLATE_ALL, *_SQL_PUB], f"""
select cast(f.t as int) as t, f.product as product_name, i.uuid as product, f.scale, f.md5,
       strftime(cast({SQL_SHIFT} as timestamp), '%Y-%m-%dT%H:%M:%S') as datetime
from pub_file f join (select * from (values {', '.join(f"('{n}', '{u}')" for n, u in C.PUBLISH_IDS)}) as v(name, uuid)) i on i.name = f.product"""))
def publish_manifest(spark, sf_dir):
    """Payload of each publish call, each of the ten products with its own files: product id, scale, md5 of the bytes, datetime."""
    fx = Fixtures(spark, sf_dir)
    daily = F.array(*[F.struct(F.lit(name).alias("product"), v.alias("v")) for name, v in (
        ("swe", F.col("swe")), ("snowdepth", F.col("depth")), ("snowpack_average_temperature", F.col("temp_k")),
        ("snowmelt", F.col("melt")), ("coldcontent", K.cold_content("temp_k", "swe")))])
    grids = raw_grid(fx).select("t", "r", "c", F.explode(daily).alias("p")).select("p.product", "t", "r", "c", "p.v")
    # Read twice, for the scales and for the files.
    grids = materialize(grids.unionByName(interpolate_all(fx)), "published_grids")
    files = F.lit(0)
    for i, (name, _) in enumerate(C.PUBLISH_IDS):
        files = F.when(F.col("product") == name, F.lit(i)).otherwise(files)
    scales = file_scales(grids).withColumn("file", (files * STEP_ROOM + F.col("t")).cast("int"))
    cells = scaled(grids, scales).select(F.col("file").alias("t"), "r", "c", "v")
    base = scratch_path(spark, "published")
    R.write_grid_files(cells, base, LATTICE, LATTICE, kinds=("raw",)).write.format("noop").mode("overwrite").save()
    written = R.read_binary(spark, os.path.join(base, "raw"), "*.bil").select(
        _t_from_path(r"grid_(\d+)").alias("file"), F.md5("content").alias("md5"))
    ids = F.broadcast(C.publish_ids(spark))          # a fixed table
    x = written.join(scales, "file").join(ids, F.col("product") == F.col("name"))
    return x.select("t", F.col("product").alias("product_name"), F.col("product_uuid").alias("product"), "scale", "md5",
                    N.iso_text(shifted_date("t").cast("timestamp_ntz")).alias("datetime"))


# ------------------------------------------------------------------- streams
@register("notice_stream", sql_ctes(("v_notice", "v_acquirable", "v_band"), SQL_REGISTRATIONS, "select * from registrations"))
def notice_stream(spark, sf_dir):
    """From the arriving notices to registry rows: catalog check, recipe, bands of the file, times, version, name, product, routed key."""
    from ..streaming.notices import run_notice_stream
    return run_notice_stream(spark, sf_dir)


@register("registry_stream", sql_ctes(("v_productfile",), [SQL_EXISTING, SQL_FRESH, SQL_INSERTS], f"""
select file_id, product_id, datetime, {SQL_DEF.format(v='version')} as version from existing
union all select file_id, product_id, datetime, version from inserts"""))
def registry_stream(spark, sf_dir):
    from ..streaming.registry import run_registry_stream
    return run_registry_stream(spark, sf_dir)


@register("zone_scan", sql_ctes(("v_zone",), [SQL_HOLED], """
select z, form, name, cast(ring as int) as ring, cast(i as int) as i, x, y
from (select 'wkt' as form, z, null as name, ring, i, x, y from hz
      union all select 'feature', hz.z, q.n, ring, i, x, y from hz join (select distinct z, n from v_zone) q on q.z = hz.z) u"""))
def zone_scan(spark, sf_dir):
    """Zones published as WKT text and as JSON features (with holes; some as multipolygons), parsed back to vertices."""
    from ..sources.zones import features_to_vertices, vertices_to_features, vertices_to_wkt, wkt_to_vertices
    fx = Fixtures(spark, sf_dir)
    zones = holed_zones(fx)
    wkt = vertices_to_wkt(zones)
    multi = F.concat(F.lit("multipolygon(("), F.regexp_extract("wkt", r"^POLYGON\((.*)\)$", 1), F.lit("))"))
    v = wkt_to_vertices(wkt.select("z", F.when(F.col("z") % 3 == 0, multi).otherwise(F.col("wkt")).alias("wkt")))
    features = vertices_to_features(zones.join(zone_names(fx), "z"), name_property="HU_10_NAME", multi=F.col("z") % 3 == 0)
    f = features_to_vertices(features, name_property="HU_10_NAME")

    def shown(df, form, name):
        return df.select("z", F.lit(form).alias("form"), name.alias("name"), F.col("ring").cast("int").alias("ring"),
                         F.col("i").cast("int").alias("i"), "x", "y")
    return shown(v, "wkt", F.lit(None).cast("string")).unionByName(shown(f, "feature", F.col("name")))


REJECTED = [  # what becomes of a zone's feature, and the reason it is rejected for
    ('{"type": "Feature", "properties": {"HU_10_NAME": "a"}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}}', "no polygon"),
    ('{"type": "Feature", "properties": {"HU_10_NAME": "a"}, "geometry": null}', "no geometry"),
    ('{"type": "Feature", "properties": {"HU_10_NAME": "a"}, "geometry": {"type": "Polygon", "coordinates": [[[1.0], [2.0, 3.0], [4.0, 4.0]]]}}',
     "broken coordinates"),
    ('{"type": "Feature", "properties": {"other": "a"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [0, 1], [0, 0]]]}}', "no name"),
    ("not JSON", "no geometry"),
]


@register("zone_feature_rejects", "select cast(n_nationkey as int) as z, 0 as feature, case n_nationkey % 6 "
          + " ".join(f"when {i} then '{reason}'" for i, (_, reason) in enumerate(REJECTED))
          + " end as reason from nation where n_nationkey % 6 < 5")
def zone_feature_rejects(spark, sf_dir):
    """Features that are no named polygon, each with its reason; every sixth zone's is good and has no row."""
    from ..sources.zones import feature_rejects, vertices_to_features
    fx = Fixtures(spark, sf_dir)
    good = vertices_to_features(holed_zones(fx).join(zone_names(fx), "z"), name_property="HU_10_NAME")
    text = F.element_at(F.array(*[F.lit(t) for t, _ in REJECTED], F.col("feature")), (F.col("z") % 6 + 1).cast("int"))
    return feature_rejects(good.select(F.col("z").cast("int").alias("z"), text.alias("feature")), name_property="HU_10_NAME").select(
        "z", F.col("feature").cast("int").alias("feature"), "reason")
