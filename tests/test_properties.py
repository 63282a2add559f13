"""Properties: fill against brute force, pyramid bookkeeping, projection round trip,
idempotent registration, stream equals batch, binary round trips."""

import gzip
import io
import math
import os
import tarfile
import tempfile
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from nivalis.operators import fill as FL
from nivalis.operators import projection as P
from nivalis.operators import pyramid as PY
from nivalis.sources import rasters as R


def brute_fill(grid, D):
    out = grid.copy()
    n_r, n_c = grid.shape
    for r in range(n_r):
        for c in range(n_c):
            if not np.isnan(grid[r, c]):
                continue
            best = {}
            for rr in range(max(0, r - D), min(n_r, r + D + 1)):
                for cc in range(max(0, c - D), min(n_c, c + D + 1)):
                    v = grid[rr, cc]
                    dx, dy = cc - c, rr - r
                    d2 = dx * dx + dy * dy
                    if np.isnan(v) or d2 > D * D:
                        continue
                    q = (2 if dx > 0 else 0) + (1 if dy > 0 else 0)
                    key = (d2, abs(dx))
                    if q not in best or key < best[q][0]:
                        best[q] = (key, v)
            if best:
                w = [1 / math.sqrt(k[0]) for k, _ in best.values()]
                out[r, c] = sum(wi * v for wi, (_, v) in zip(w, best.values())) / sum(w)
    return out


def cells_of(spark, g):
    rows = [(1, r, c, None if np.isnan(g[r, c]) else float(g[r, c])) for r in range(g.shape[0]) for c in range(g.shape[1])]
    return spark.createDataFrame(rows, "t int, r int, c int, v double").repartition(3)


@pytest.mark.parametrize("shape, D, tile, share", [((20, 24), 5, 512, 0.7), ((33, 21), 6, 8, 0.9), ((30, 40), 35, 512, 0.97), ((24, 24), 35, 16, 0.98)])
def test_fill_matches_brute_force_and_keeps_valid_cells(spark, monkeypatch, shape, D, tile, share):
    monkeypatch.setattr(FL, "TILE", tile)
    rng = np.random.default_rng(7)
    g = rng.integers(0, 100, size=shape).astype(float)
    g[rng.random(g.shape) < share] = np.nan
    got = {(r.r, r.c): r.v for r in FL.fill_nodata(cells_of(spark, g), D).collect()}
    exp = brute_fill(g, D)
    assert len(got) == g.size
    for (r, c), v in got.items():
        e = exp[r, c]
        assert v is None if np.isnan(e) else v is not None and abs(v - e) < 1e-9, (r, c, v, e)


def test_fill_is_linear_in_the_cells():
    """Equal cells as short and as long columns: the kernel's time must not grow with the column."""
    rng = np.random.default_rng(3)
    times = {}
    for rows in (64, 4096):
        g = rng.random((rows, 262_144 // rows))
        g[rng.random(g.shape) < 0.3] = np.nan
        i, j = np.nonzero(np.isnan(g))
        best = []
        for _ in range(3):
            t0 = time.process_time()
            FL.quadrants(g, i, j, 16)
            best.append(time.process_time() - t0)
        times[rows] = min(best)
    assert times[4096] < 2 * times[64]


def test_fill_plan_is_one_shuffle_without_join(spark):
    cells = spark.range(64).select(F.lit(1).alias("t"), F.col("id").cast("int").alias("r"), F.lit(0).alias("c"), F.lit(1.0).alias("v"))
    plan = FL.fill_nodata(cells, 35)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and "Window" not in plan


def test_pyramid_counts_add_up(spark):
    rows = [(1, r, c, None if (r * c) % 3 == 0 else float(r + c)) for r in range(16) for c in range(16)]
    cells = spark.createDataFrame(rows, "t int, r int, c int, v double")
    p = PY.overview_pyramid(cells, [2, 4, 8, 16])
    n_valid = sum(1 for x in rows if x[3] is not None)
    for lvl, n in p.groupBy("level").agg(F.sum("v_count")).collect():
        assert n == n_valid
    top = p.where("level = 16").first()
    mean = sum(x[3] for x in rows if x[3] is not None) / n_valid
    assert abs(top.v_mean - mean) < 1e-9


def test_projection_round_trip(spark):
    pts = spark.createDataFrame([(lon, lat) for lon in (-125.0, -96.0, -70.0) for lat in (25.0, 23.0, 49.0)],
                                "lon double, lat double")
    ex, ny = P.albers_forward("lon", "lat")
    fw = pts.select("lon", "lat", ex.alias("ex"), ny.alias("ny"))
    lo, la = P.albers_inverse("ex", "ny")
    for r in fw.select("lon", "lat", "ex", "ny", lo.alias("lo"), la.alias("la")).collect():
        assert abs(r.lo - r.lon) < 1e-7 and abs(r.la - r.lat) < 1e-7
        if r.lon == -96.0 and r.lat == 23.0:
            assert abs(r.ex) < 1e-6 and abs(r.ny) < 1e-6


def test_second_upsert_adds_nothing(spark):
    from nivalis.fixtures import Fixtures
    from nivalis.operators import catalog as C
    fx = Fixtures(spark, SF_SMALL)
    once = C.registry_upsert(fx.productfile, fx.productfile.limit(0))
    again = C.registry_inserts(fx.productfile, once)
    assert again.count() == 0


def test_stream_equals_batch(spark):
    import __spark_entry__ as e
    from nivalis.fixtures import Fixtures
    from nivalis.operators import catalog as C
    from nivalis.plans.q_records import registrations_df
    q = e.queries()
    fx = Fixtures(spark, SF_SMALL)
    stream = q["notice_stream"](spark, SF_SMALL)
    batch = registrations_df(fx)
    assert stream.columns == batch.columns
    a = sorted((tuple(r) for r in stream.collect()), key=str)
    assert a == sorted((tuple(r) for r in batch.collect()), key=str) and len({r[1] for r in a}) == len(C.RECIPES)
    s = sorted(tuple(r) for r in q["registry_stream"](spark, SF_SMALL).collect())
    u = sorted(tuple(r) for r in q["registry_upsert"](spark, SF_SMALL).collect())
    assert s == u


def test_binary_round_trips(spark):
    d = tempfile.mkdtemp(prefix="nivalis-test-")
    grid = np.arange(12 * 10, dtype=float).reshape(12, 10)
    grid[3, 4] = np.nan
    raw = np.where(np.isnan(grid), -9999, np.rint(grid)).astype(">i2").tobytes()
    with open(os.path.join(d, "a.bil"), "wb") as f:
        f.write(raw)
    with tarfile.open(os.path.join(d, "b.tar"), "w") as t:
        data = gzip.compress(raw)
        info = tarfile.TarInfo("x.dat.gz")
        info.size = len(data)
        t.addfile(info, io.BytesIO(data))
    flat = R.tiles_to_cells(R.decode_grids(R.read_binary(spark, d, "*.bil"), 10, "raw", tile_rows=5))
    tar = R.tiles_to_cells(R.decode_grids(R.read_binary(spark, d, "*.tar"), 10, "tar", lambda p: "x.dat.gz"))
    for df in (flat, tar):
        got = {(r.r, r.c): r.v for r in df.collect()}
        assert len(got) == 120 and got[(3, 4)] is None and got[(11, 9)] == 119.0


def test_zonal_stats_same_with_and_without_broadcast(spark):
    import __spark_entry__ as e
    q = e.queries()["zonal_stats"]
    with_bc = sorted(tuple(r) for r in q(spark, SF_SMALL).collect())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = q(spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert sorted(tuple(r) for r in df.collect()) == with_bc
        assert "NestedLoop" not in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_truncated_grid_is_an_error(spark):
    d = tempfile.mkdtemp(prefix="nivalis-cut-")
    for name, n in (("short.bil", 57), ("odd.bil", 60)):
        with open(os.path.join(d, name), "wb") as f:
            f.write(np.arange(n, dtype=">i2").tobytes())
    for glob, rows in (("short.bil", None), ("odd.bil", 7)):
        with pytest.raises(Exception, match="are no grid"):
            R.decode_grids(R.read_binary(spark, d, glob), 10, "raw", n_rows=rows).collect()
    assert R.decode_grids(R.read_binary(spark, d, "odd.bil"), 10, "raw", n_rows=6).count() == 1


def test_values_that_do_not_fit_a_cell_are_errors(spark):
    for v in (88000.0, 32768.0, -32769.0, float("inf")):
        cells = spark.createDataFrame([(1, 0, 0, 5.0), (1, 0, 1, v)], "t int, r int, c int, v double")
        with pytest.raises(Exception, match="does not fit 16 bits"):
            R.write_grid_files(cells, tempfile.mkdtemp(prefix="nivalis-wide-"), 1, 2, kinds=("raw",)).collect()
    base = tempfile.mkdtemp(prefix="nivalis-wide-")
    cells = spark.createDataFrame([(1, 0, 0, 32767.4), (1, 0, 1, -32768.0), (1, 0, 2, None)], "t int, r int, c int, v double")
    R.write_grid_files(cells, base, 1, 3, kinds=("raw",)).collect()
    with open(os.path.join(base, "raw/grid_1.bil"), "rb") as f:
        assert np.frombuffer(f.read(), ">i2").tolist() == [32767, -32768, -9999]


def test_grid_files_on_a_uri_with_gaps_and_headers(spark):
    base = "file://" + tempfile.mkdtemp(prefix="nivalis-uri-")
    rows = [(t, r, c, None if c == 1 else float(r * 10 + c)) for t in (1, 2) for r in range(1, 4) for c in range(3)]
    cells = spark.createDataFrame(rows, "t int, r int, c int, v double").repartition(5)
    headers = spark.createDataFrame([(1, "Number of rows: 5"), (9, "x")], "t int, content string")
    assert sorted(map(tuple, R.write_grid_files(cells, base, 5, 4, headers).collect())) == [(1, 4), (2, 4)]
    members = [(r.path[-13:], r.member) for r in R.archive_index(spark, base + "/tar", "*.tar").collect()]
    assert sorted(m for _, m in members) == ["grid_1.dat.gz", "grid_1.txt.gz", "grid_2.dat.gz"]
    for sub, kind, member in (("raw", "raw", None), ("gz", "gz", None), ("zip", "zip", lambda p: os.path.basename(p).replace("_bil.zip", ".bil"))):
        got = R.tiles_to_cells(R.decode_grids(R.read_binary(spark, f"{base}/{sub}", "*grid*"), 4, kind, member, n_rows=5)).collect()
        assert len(got) == 40
        assert {(r.r, r.c): r.v for r in got if "grid_1" in r.path and r.v is not None} == {(r, c): v for t, r, c, v in rows if t == 1 and v is not None}


def test_notices_meet_the_catalog_without_a_shuffle(spark):
    from nivalis.plans.registry import QUERIES
    for key in ("acquirable_semi_join", "product_id_join"):
        plan = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(acquirable" not in plan and "BroadcastHashJoin" in plan, key


@pytest.mark.parametrize("n_files", [6, 60])
def test_bands_are_picked_by_comment_after_one_shuffle_by_rows(spark, tmp_path, monkeypatch, n_files):
    from nivalis import fixtures as FX
    from nivalis.plans.registry import QUERIES
    flags = [None, "", "A", "AA", "B", "N", "NA", "R"]
    rows = [(None if f % 6 == 5 else f, None if (f + b) % 9 == 8 else b, flags[(f * 3 + b * 5 + k) % 8], None if (f + b + k) % 7 == 6 else (f + 3 * b + k) * 3600)
            for f in range(n_files) for b in range(1, 8) for k in range(3)]
    (spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_returnflag string, s long")
     .withColumn("l_shipdate", F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)")).drop("s").write.parquet(f"{tmp_path}/lineitem.parquet"))
    monkeypatch.setattr(FX, "BAND_ROWS", 100, raising=False)
    got = QUERIES["band_by_comment"](spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "hashpartitioning(file_id#" in plan and f", {1 + len(rows) // 100}), REPARTITION_BY_NUM" in plan
    bands = {}
    for f, b, flag, s in rows:
        had = bands.setdefault(f, {}).setdefault(b, ([], []))
        had[0].extend([flag] if flag is not None else [])
        had[1].extend([s] if s is not None else [])
    want = set()
    for f, of in bands.items():
        order = sorted(of, key=lambda b: (b is not None, b))
        for search, flag in (("Total precipitation", "A"), ("Temperature [C]", "N")):
            b = next((b for b in order if min(of[b][0], default=None) == flag), order[-1])
            want.add((f, search, b, f"{min(of[b][1])} sec UTC" if of[b][1] else None))
    found = [tuple(r) for r in got.select("file_id", "search", "band", "valid_time").collect()]
    assert len(found) == len(want) and set(found) == want


def test_registry_batch_reads_its_months_only(spark):
    from nivalis.session import scratch_path
    from nivalis.streaming import registry as REG
    path = scratch_path(spark, "t-registry")
    rows = spark.sql("select 1L file_id, 1 product_id, timestamp_ntz'2001-01-05 00:00:00' datetime, 'a' version "
                     "union all select 2L, 1, timestamp_ntz'2002-02-05 00:00:00', 'a'")
    REG.write_batch(rows, path, -1)
    df = REG.registry_rows(spark, path, 5, [200101])
    assert [r.file_id for r in df.collect()] == [1]
    assert "PartitionFilters: [" in df._jdf.queryExecution().toString() and "month" in df._jdf.queryExecution().toString()
    REG.upsert_batch(path)(rows, 7)
    assert REG.registry_rows(spark, path).count() == 2


def test_series_window_is_half_open_and_keeps_empty_zones(spark):
    from nivalis.fixtures import Fixtures
    from nivalis.plans.q_transforms import inches_stats, one
    fx = Fixtures(spark, SF_SMALL)
    got = inches_stats(fx, one(fx, "swe"), 199601, 199604).collect()
    assert {r.t for r in got} == {199601, 199602, 199603} and len(got) == 3 * 25
