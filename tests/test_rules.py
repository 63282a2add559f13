"""Rules at their boundaries, on literal inputs."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from nivalis.functions import names as N
from nivalis.operators import cells as K
from nivalis.operators import zones as Z


def one_row(spark, **cols):
    return spark.createDataFrame([tuple(cols.values())], list(cols))


def test_nodata_by_date(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 1),), (dt.date(2011, 1, 23),), (dt.date(2011, 1, 24),),
                                (dt.date(2019, 1, 1),)], "d date")
    got = [r[0] for r in df.orderBy("d").select(N.nodata_by_date("d")).collect()]
    assert got == ["55537", "55537", "-9999", "-9999"]


def test_lakefix_applies(spark):
    rows = [(dt.date(2019, 1, 1), "1034", True), (dt.date(2019, 1, 1), "1036", True),
            (dt.date(2019, 1, 1), "100000", False), (dt.date(2013, 1, 1), "1034", False),
            (dt.date(2014, 10, 8), "1034", False), (dt.date(2014, 10, 9), "1036", True)]
    df = spark.createDataFrame(rows, "d date, code string, want boolean")
    assert all(r[0] == r[1] for r in df.select(N.lakefix_applies("d", "code"), "want").collect())
    # an integer code is accepted as well
    df2 = spark.createDataFrame([(dt.date(2019, 1, 1), 1036)], "d date, code int")
    assert df2.select(N.lakefix_applies("d", "code")).first()[0] is True


def test_cold_content_order_of_rules(spark):
    rows = [(273.15, 10.0), (280.0, None), (263.15, None), (None, 10.0), (263.15, 100.0)]
    df = spark.createDataFrame(rows, "temp double, swe double")
    got = [r[0] for r in df.select(K.cold_content("temp", "swe")).collect()]
    assert got[0] == 0.0          # degC = 0 -> 0
    assert got[1] == 0.0          # warm wins over missing SWE
    assert got[2] is None         # cold and missing SWE
    assert got[3] is None         # missing temperature
    assert abs(got[4] - 100.0 * 2114 * -10.0 / 333000) < 1e-9


def test_raw_file_names_types(spark):
    df = spark.createDataFrame([(dt.date(2019, 1, 1), t) for t in ("unmasked", "UnMasked", "masked", "Masked")],
                               "d date, ty string")
    got = [r[0] for r in df.select(N.raw_archive_name("d", "ty")).collect()]
    assert got == ["SNODAS_unmasked_20190101.tar"] * 2 + ["SNODAS_20190101.tar"] * 2
    pre = [r[0] for r in df.select(N.dataset_prefix("ty")).collect()]
    assert pre == ["zz", "zz", "us", "us"]


def test_date_from_name(spark):
    df = spark.createDataFrame([("SNODAS_unmasked_20200615.tar",), ("PRISM_ppt_early_4kmD2_20200712_bil.zip",),
                                ("SNODAS_unmasked_20201315.tar",), ("other.tar",)], "name string")
    got = [r[0] for r in df.select(N.date_from_name("name")).collect()]
    assert got[0] == dt.datetime(2020, 6, 15, 6)
    assert got[1] == dt.datetime(2020, 7, 12)
    assert got[2] is None and got[3] is None


def test_header_values_missing_keyword(spark):
    text = "Number of columns: 8192\nNumber of rows: 4096\nNo data value: -9999\n"
    df = one_row(spark, content=text)
    r = df.select(N.header_value("content", "Number of columns").alias("a"),
                  N.header_value("content", "Minimum x-axis coordinate").alias("b")).first()
    assert r.a == "8192" and r.b is None


def test_key_parts_plus_is_space(spark):
    df = one_row(spark, k="incoming/prism_ppt_early/PRISM+ppt%5Fearly.zip")
    kp = N.key_parts("k")
    r = df.select(kp["acquirable"], kp["filename"]).first()
    assert r[0] == "prism_ppt_early" and r[1] == "PRISM ppt_early.zip"


def test_grib_time_and_names(spark):
    df = one_row(spark, s="1599008400 sec UTC", n="MRMS_QPE_01H_00.00_20200902-200000.grib2.gz")
    r = df.select(N.iso_text(N.grib_time("s")), N.output_name(F.lit("cut_grib2gz"), "n"),
                  N.output_name(F.lit("cog_suffix"), F.lit("PRISM_ppt_early_4kmD2_20200712_bil.zip"))).first()
    assert r[0] == "2020-09-02T01:00:00"
    assert r[1] == "MRMS_QPE_01H_00.00_20200902-200000.tif"
    assert r[2] == "PRISM_ppt_early_4kmD2_20200712_bil_cloud_optimized.tif"


def test_empty_zone_gets_count_zero(spark):
    # a sliver triangle that contains no cell centre
    verts = spark.createDataFrame([(1, "tiny", 0, 0.1, 0.1), (1, "tiny", 1, 0.3, 0.1), (1, "tiny", 2, 0.2, 0.3),
                                   (2, "big", 0, 0.0, 0.0), (2, "big", 1, 4.0, 0.0), (2, "big", 2, 0.0, 4.0)],
                                  "z int, n string, i int, x double, y double")
    cells = spark.createDataFrame([(1, r, c, float(r * 10 + c)) for r in range(4) for c in range(4)],
                                  "t int, r int, c int, v double")
    members = Z.zone_members(verts, 4, 4)
    out = {r.z: r for r in Z.zonal_stats(cells, members, verts.select("z", "n").distinct()).collect()}
    assert out[1]["count"] == 0 and out[1]["min"] is None
    # centres (c+.5, r+.5) strictly inside x + y < 4: 6 cells
    assert out[2]["count"] == 6


def test_buffered_extent_zero_cell_size(spark):
    from nivalis.plans.q_transforms import buffered
    env = spark.createDataFrame([(1.3, 2.7, 5.2, 6.9, 2, 0.0), (1.3, 2.7, 5.2, 6.9, 0, 1.0), (1.3, 2.7, 5.2, 6.9, 1, 1.0)],
                                "xmin double, ymin double, xmax double, ymax double, n int, s double")
    got = [tuple(r) for r in buffered(env, "n", "s").select("bxmin", "bymin", "bxmax", "bymax").collect()]
    assert got[0] == (1.3, 2.7, 5.2, 6.9)
    assert got[1] == (1.3, 2.7, 5.2, 6.9)
    assert got[2] == (0.0, 1.0, 7.0, 8.0)


def test_zone_with_hole_multipolygon_and_rejects(spark):
    from nivalis.sources.zones import wkt_rejects, wkt_to_vertices
    texts = [(1, "POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (3 3, 7 3, 7 7, 3 7, 3 3))"),
             (2, "multipolygon(((0 0,2 0,2 2,0 2,0 0)),((4 4,6 4,6 6,4 6,4 4)))"),
             (3, "POLYGON EMPTY"), (4, "POLYGON((0 0, x 1, 2 2))"), (5, "POINT(1 2)"), (6, None), (7, " Polygon ((0 0 5, 1e0 0 5, 1 1 5, 0 0 5))")]
    df = spark.createDataFrame(texts, "z int, wkt string")
    assert sorted(r.z for r in wkt_rejects(df).collect()) == [3, 4, 5, 6]
    v = wkt_to_vertices(df)
    assert sorted({r.z for r in v.collect()}) == [1, 2, 7]
    cells = Z.zone_cells(v, 10, 10).collect()
    assert sum(r.z == 1 for r in cells) == 84 and sum(r.z == 2 for r in cells) == 8
    hole = {(r.r, r.c) for r in cells if r.z == 1}
    assert (4, 4) not in hole and (2, 2) in hole


def test_wide_spans_are_cut_at_column_tiles(spark):
    v = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 200.0, 0.0), (1, 2, 200.0, 2.0), (1, 3, 0.0, 2.0)], "z int, i int, x double, y double")
    members = Z.zone_members(v, 2, 200)
    assert {(r.ct, r.lo, r.hi) for r in members.where("r = 0").collect()} == {(0, 0, 63), (1, 64, 127), (2, 128, 191), (3, 192, 199)}
    cells = spark.range(400).select(F.lit(1).alias("t"), (F.col("id") % 2).cast("int").alias("r"),
                                    F.floor(F.col("id") / 2).cast("int").alias("c"), F.lit(1.0).alias("v"))
    assert Z.zone_cell_join(cells, members).count() == 400


def test_malformed_grib_time_is_null(spark):
    df = spark.createDataFrame([("1599008400 sec UTC",), ("soon",), (None,), ("",)], "s string")
    got = [r.t for r in df.select(N.grib_time("s").alias("t")).collect()]
    assert got[0] is not None and got[1:] == [None, None, None]


def test_conformity_counts_nodata_edges(spark):
    from nivalis.plans.q_transforms import conformity
    rows = [(1, g, r, c, None if r == 3 else 1.0) for g in "ab" for r in range(4) for c in range(3)] + [(2, "a", 0, 0, 1.0), (2, "b", 5, 0, 1.0)]
    cells = spark.createDataFrame(rows, "t int, grid string, r int, c int, v double")
    got = {r.t: (r.min_rows, r.max_rows, r.conform) for r in conformity(K.grid_shape(cells), 2).collect()}
    assert got == {1: (4, 4, True), 2: (1, 6, False)}


def test_outputs_that_cannot_be_registered_are_reported(spark):
    from nivalis.operators import catalog as C
    from nivalis.plans.registry import QUERIES
    got = QUERIES["product_recipes"](spark, SF_SMALL).collect()
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert len({r.file_id for r in got}) == events and {r.recipe for r in got} == {r[0] for r in C.RECIPES}
    assert {r.reason for r in got} == {None, "no bands", "no band by the rule of the recipe", "no time", "unknown filetype"}
    for r in got:
        if r.reason is None:
            assert r.datetime and r.out_file
        if r.recipe == "wpc_qpf_2p5km" and r.band is not None:
            assert r.version < r.datetime
        if r.recipe == "ncep_rtma_ru_anl" and r.band is not None:
            assert r.band == 3 and r.out_file.startswith(r.datetime[:10].replace("-", "") + "_rtma")


def test_every_target_cell_has_a_row(spark):
    from nivalis.plans.q_transforms import TARGET
    from nivalis.plans.registry import QUERIES
    got = QUERIES["reproject_grid"](spark, SF_SMALL)
    steps = got.select("t").distinct().count()
    assert got.count() == steps * TARGET["n_rows"] * TARGET["n_cols"] and got.where("v is null").count() > 0


def test_pretty_notification_files(spark, tmp_path):
    import json
    from nivalis.sources.notices import read_notices
    record = {"eventVersion": "2.1", "eventTime": "2020-01-01T00:00:00Z", "eventName": "ObjectCreated:Put",
              "s3": {"bucket": {"name": "b"}, "object": {"key": "obs/a+b%5Fc/x.grib2.gz", "size": 3}}}
    (tmp_path / "two.json").write_text(json.dumps({"Records": [record, record]}, indent=2))
    (tmp_path / "none.json").write_text(json.dumps({"Event": "test"}, indent=2))
    got = read_notices(spark, f"file://{tmp_path}").collect()
    assert [(r.record_no, r.bucket, r.key) for r in got] == [(0, "b", "obs/a b_c/x.grib2.gz"), (1, "b", "obs/a b_c/x.grib2.gz")]
