"""Georeferenced tile tables, members of archives read alone, zone features."""

import gzip
import io
import json
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from nivalis.session import scratch_path
from nivalis.sinks import grids as S
from nivalis.sources import rasters as R
from nivalis.sources import zones as Z

CORNERS = (-130.0, 58.0, -62.0, 24.0)


def stored(spark, n_rows=70, n_cols=90, tile=16, partitions=12):
    cells = spark.range(2 * n_rows * n_cols).select(
        (F.lit(199801) + (F.col("id") / (n_rows * n_cols)).cast("int")).alias("t"),
        ((F.col("id") % (n_rows * n_cols)) / n_cols).cast("int").alias("r"), (F.col("id") % n_cols).cast("int").alias("c"))
    cells = cells.where("(r * 7 + c) % 11 <> 3").select(
        "*", F.when(F.col("c") % 5 != 0, F.col("r") * 1000.0 + F.col("c")).alias("a"), F.lit(0.5).alias("b"))
    corners = spark.createDataFrame([(199801, *CORNERS), (199802, *[x + 0.25 for x in CORNERS])], "t int, ulx double, uly double, lrx double, lry double")
    path = scratch_path(spark, "t-grid")
    S.write_grid(cells, corners, path, ["a", "b"], n_rows, n_cols, "EPSG:4269", tile=tile, partitions=partitions)
    return cells, path


def test_grid_comes_back_with_its_place_and_missing_cells(spark):
    cells, path = stored(spark)
    tiles = S.read_grid(spark, path)
    assert S.grid_info(tiles) == {"crs": "EPSG:4269", "nodata": -9999.0, "n_rows": 70, "n_cols": 90, "tile": 16, "bands": ["a", "b"]}
    got = {(x.t, x.r, x.c): x for x in S.grid_cells(tiles).collect()}
    assert len(got) == 2 * 70 * 90                                     # absent cells come back as nodata
    want = {(x.t, x.r, x.c): (x.a, x.b) for x in cells.collect()}
    for key, x in got.items():
        assert (x.a, x.b) == want.get(key, (None, None))
        shift = 0.25 if x.t == 199802 else 0.0
        assert x.x == pytest.approx(CORNERS[0] + shift + (x.c + 0.5) * 68 / 90) and x.y == pytest.approx(CORNERS[1] + shift - (x.r + 0.5) * 34 / 70)


def test_window_in_degrees_skips_files_by_statistics(spark):
    _, path = stored(spark, tile=8, partitions=40)
    area = (-100.0, 40.0, -95.0, 44.0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def scanned(df):
            df.collect()
            leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
            return leaf.metrics().get("numOutputRows").get().value()
        every, some = scanned(S.read_grid(spark, path).select("t", "xmin")), scanned(S.read_area(spark, path, *area).select("t", "xmin"))
        one = scanned(S.read_area(spark, path, *area, t_from=199802).select("t", "xmin"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert some < every / 2 and one < some
    cells = S.grid_cells(S.read_area(spark, path, *area), area, bands=["a"])
    whole = S.grid_cells(S.read_grid(spark, path), bands=["a"]).where(
        (F.col("x") >= area[0]) & (F.col("x") < area[2]) & (F.col("y") > area[1]) & (F.col("y") <= area[3]))
    assert sorted(map(str, cells.collect())) == sorted(map(str, whole.collect())) and cells.count() > 20


def test_a_table_without_georeference_is_an_error(spark):
    with pytest.raises(ValueError, match="georeference"):
        S.grid_info(spark.range(1))


class Counted:
    """A file in memory that counts the bytes read."""

    def __init__(self, data):
        self.data, self.read = data, 0

    def read_at(self, n, offset):
        out = self.data[offset : offset + n]
        self.read += len(out)
        return out


@pytest.mark.parametrize("form", [tarfile.GNU_FORMAT, tarfile.PAX_FORMAT, tarfile.USTAR_FORMAT])
def test_members_are_found_by_their_headers_alone(form):
    files = {"grid.dat.gz": gzip.compress(os.urandom(3_000_000)), "head.txt.gz": gzip.compress(b"Number of rows: 4\n"), "empty": b""}
    if form != tarfile.USTAR_FORMAT:
        files["d/" * 80 + "é" * 60 + ".txt"] = b"long name"
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w", format=form) as tar:
        folder = tarfile.TarInfo("folder")
        folder.type = tarfile.DIRTYPE
        tar.addfile(folder)
        for name, data in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    f = Counted(buf.getvalue())
    found = {name: f.data[offset : offset + size] for name, offset, size in R.tar_entries(f)}
    assert found == files
    assert f.read < 16_000 < len(f.data) / 100
    assert list(R.tar_entries(Counted(b""))) == []


def test_only_wanted_members_are_read_and_one_a_batch(spark):
    base = scratch_path(spark, "t-tar")
    cells = spark.range(3 * 64).select((F.col("id") / 64).cast("int").alias("t"), ((F.col("id") % 64) / 8).cast("int").alias("r"),
                                       (F.col("id") % 8).cast("int").alias("c"), F.col("id").cast("double").alias("v"))
    headers = spark.createDataFrame([(t, f"header {t}") for t in range(3)], "t int, content string")
    R.write_grid_files(cells, base, 8, 8, headers=headers, kinds=("tar",)).collect()
    index = R.archive_index(spark, base + "/tar", "*.tar")
    assert index.count() == 6
    got = R.archive_members(index.where(F.col("member").endswith(".txt.gz"))).collect()
    assert sorted(bytes(x.data) for x in got) == [b"header 0", b"header 1", b"header 2"]
    packed = R.archive_members(index, unpack=False).collect()
    assert {x.member: len(x.data) for x in packed} == {x.member: x.size for x in index.collect()}
    assert {len(x.data) for x in R.archive_members(index).collect() if "dat" in x.member} == {128}


def feature(name, geometry, **more):
    return {"type": "Feature", "properties": {"name": name, "area": 3, "tags": [1, {"a": 2}]}, "geometry": geometry, **more}


def test_collections_of_features(spark):
    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole = [[1, 1], [2, 1], [2, 2.5]]
    docs = [
        (1, json.dumps({"type": "FeatureCollection", "features": [
            feature("A", {"type": "Polygon", "coordinates": [square, hole]}, id=7),
            feature("B", {"type": "MultiPolygon", "coordinates": [[square], [hole]]}),
            feature("C", {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}),
            feature(None, {"type": "Polygon", "coordinates": [square]}),
            feature("D", {"type": "Polygon", "coordinates": [[["x", 0], [1, 1], [2, 2]]]}),
            feature("E", {"type": "Polygon", "coordinates": []}),
            feature("F", {"type": "Polygon"})]})),
        (2, json.dumps(feature("A", {"type": "polygon", "coordinates": [[[0, 0, 9], [1e1, 0, 9], [0, 2, 9]]]}))),
        (3, "{"), (4, None), (5, json.dumps({"type": "FeatureCollection", "features": []}))]
    df = spark.createDataFrame(docs, "z int, feature string")
    got = {}
    for x in sorted(Z.features_to_vertices(df).collect(), key=lambda x: (x.z, x.feature, x.ring, x.i)):
        got.setdefault((x.z, x.feature, x.name, x.ring), []).append([x.x, x.y])
    assert got == {(1, 0, "A", 0): square[:-1], (1, 0, "A", 1): hole, (1, 1, "B", 0): square[:-1], (1, 1, "B", 1): hole,
                   (2, 0, "A", 0): [[0, 0], [10, 0], [0, 2]]}
    bad = sorted((x.z, x.feature, x.reason) for x in Z.feature_rejects(df).collect())
    assert bad == [(1, 2, "no polygon"), (1, 3, "no name"), (1, 4, "broken coordinates"), (1, 5, "broken coordinates"),
                   (1, 6, "broken coordinates"), (3, 0, "no geometry"), (4, 0, "no geometry"), (5, 0, "no geometry")]


def pieces(spark, rows):
    return spark.createDataFrame(rows, "name string, seq int, text string")


def folder_state(folder):
    return {n: open(f"{folder}/{n}", encoding="utf-8").read() for n in os.listdir(folder) if n.endswith(".json")}


def test_documents_of_a_run_again_and_with_fewer_rows(spark):
    from nivalis.sinks import documents as D
    folder = scratch_path(spark, "t-docs")
    os.makedirs(folder)
    rows = [("b.json", k, f"[{k}] é\n") for k in range(50)] + [("a.json", 0, "{}"), ("old.json", 1, "x")]
    D.write_documents(pieces(spark, rows).repartition(4), folder, "r")
    D.write_documents(pieces(spark, [("other.json", 0, "o")]), folder, "s")
    want = {"a.json": "{}", "b.json": "".join(t for n, _, t in rows if n == "b.json"), "old.json": "x", "other.json": "o"}
    assert folder_state(folder) == want
    D.write_documents(pieces(spark, rows), folder, "r")
    assert folder_state(folder) == want
    D.write_documents(pieces(spark, [r for r in rows if r[0] != "old.json"]), folder, "r")      # its own file goes, others stay
    del want["old.json"]
    assert folder_state(folder) == want
    assert {r.name: r.text for r in D.read_documents(spark, folder, "r").collect()} == {k: v for k, v in want.items() if k != "other.json"}
    assert not [n for n in os.listdir(folder) if n.startswith(".") and not n.endswith(".crc")]
    with open(f"{folder}/unlisted.json", "w", encoding="utf-8") as f:
        f.write("half a run")
    assert D.read_documents(spark, folder, "r").count() == 2
    with open(f"{folder}/a.json", "w", encoding="utf-8") as f:
        f.write("{ }")
    with pytest.raises(Exception, match="a.json has changed"):
        D.read_documents(spark, folder, "r").collect()
    with pytest.raises(ValueError, match="no list"):
        D.read_documents(spark, folder, "never")


def test_statistics_documents_are_json_with_na_and_times(spark):
    from nivalis.sinks import documents as D
    rows = [("2015-02-01", 'A "x"', 1.5, None, 0.001, 3), ("2015-02-01", "B", None, None, None, 0), ("2015-02-03", "B", 2.0, 2.0, 2.0, 1)]
    stats = spark.createDataFrame(rows, "day string, n string, min_inches double, max_inches double, mean_inches double, count long").withColumn(
        "day", F.to_date("day"))
    folder = scratch_path(spark, "t-docs")
    os.makedirs(folder)
    D.write_documents(D.statistics_pieces(stats, "p", "20150201", "20150204", 4, 9), folder, "r")
    docs = {n: json.loads(t) for n, t in folder_state(folder).items()}
    a = {"HU_10": 'A "x"', "HU_10_NAME": 'A "x"', "min_inches": 1.5, "max_inches": "NA", "mean_inches": 0.001, "count": 3}
    b = {"HU_10": "B", "HU_10_NAME": "B", "min_inches": "NA", "max_inches": "NA", "mean_inches": "NA", "count": 0}
    b2 = {**b, "min_inches": 2.0, "max_inches": 2.0, "mean_inches": 2.0, "count": 1}
    times = {"time_sec_download_warp": 4, "time_sec_stats": 9}
    first, third = {**times, "result": {'A "x"': a, "B": b}}, {**times, "result": {"B": b2}}
    assert docs["statistics__p__20150201.json"] == first and docs["statistics__p__20150203.json"] == third
    assert docs["statistics__p__20150201_to_20150204.json"] == {"2015_02_01": first, "2015_02_03": third}
    assert docs["statistics__b__p__20150203-000000.json"] == {**times, "result": [b2]}
    assert len(docs) == 6


def test_listings_are_compared_without_contents(spark):
    from nivalis.sources import listing as L
    folder = scratch_path(spark, "t-list")
    os.makedirs(f"{folder}/sub")

    def put(name, text):
        with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    for name in ("a.tar", "b.tar", "c.tar", "note.txt"):
        put(name, "x")
    last = L.write_snapshot(L.list_files(spark, folder, "*.tar"), scratch_path(spark, "t-snap"))
    os.remove(f"{folder}/b.tar")
    put("c.tar", "longer")
    put("sub/d.tar", "y")
    put("empty.tar", "")                                               # not there yet
    states = L.compare(L.list_files(spark, folder, "*.tar"), last)
    assert {x.file: x.state for x in states.collect()} == {"a.tar": "same", "b.tar": "gone", "c.tar": "changed", "d.tar": "new"}
    spine = spark.createDataFrame([("a.tar",), ("d.tar",), ("z.tar",)], "archive string")
    assert {x.archive: x.state for x in L.against_spine(states, spine).collect()} == {"a.tar": "same", "d.tar": "new", "z.tar": "missing"}


def test_published_cells_fit_their_files(spark):
    from nivalis.plans import q_io

    rows = [("a", 1, 0, 0, 88_000.0), ("a", 1, 0, 1, -15.0), ("a", 1, 0, 2, None), ("a", 2, 0, 0, 32_766.4), ("b", 1, 0, 0, None),
            ("b", 2, 0, 0, 32_767.0), ("b", 3, 0, 0, -5e8)]
    grids = spark.createDataFrame(rows, "product string, t int, r int, c int, v double")
    scales = q_io.file_scales(grids)
    assert {(r.product, r.t): r.scale for r in scales.collect()} == {
        ("a", 1): 10, ("a", 2): 1, ("b", 1): 1, ("b", 2): 10, ("b", 3): 100_000}
    got = {(r.product, r.t, r.c): r.v for r in q_io.scaled(grids, scales).collect()}
    assert got == {("a", 1, 0): 8_800, ("a", 1, 1): -1, ("a", 1, 2): None, ("a", 2, 0): 32_766, ("b", 1, 0): None,
                   ("b", 2, 0): 3_277, ("b", 3, 0): -5_000}
