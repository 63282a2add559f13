"""Warping by target tiles, zones in degrees, window-first fills and as-of rules."""

import datetime
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from nivalis.operators import fill as FL
from nivalis.operators import projection as P
from nivalis.operators import zones as Z

TARGET = dict(x0=-2300000.0, y0=3150000.0, size=70000.0, n_cols=50, n_rows=37)
CORNERS = {"a": (-130.5, 58.2, -62.3, 24.1), "b": (-125.0, 53.0, -67.0, 25.0)}
ROWS, COLS = 41, 53


def grid(seed, share=0.3):
    g = np.random.default_rng(seed).normal(size=(ROWS, COLS))
    g[np.random.default_rng(seed + 1).random(g.shape) < share] = np.nan
    return g


def cells_of(spark, grids):
    rows = [(t, r, c, None if np.isnan(g[r, c]) else float(g[r, c])) for t, g in grids.items() for r in range(ROWS) for c in range(COLS)]
    return spark.createDataFrame(rows, "t int, r int, c int, v double")


def warp_one(g, box, r, c):
    """Weighted mean of the valid ones of the four source cells around one target cell."""
    lon, lat = P.inverse_arrays(np.array(TARGET["x0"] + (c + 0.5) * TARGET["size"]), np.array(TARGET["y0"] - (r + 0.5) * TARGET["size"]))
    ulx, uly, lrx, lry = box
    fc, fr = (lon - ulx) / ((lrx - ulx) / COLS) - 0.5, (lat - uly) / ((lry - uly) / ROWS) - 0.5
    c0, r0 = int(np.floor(fc)), int(np.floor(fr))
    num = den = 0.0
    for i, wr in ((r0, 1 - (fr - r0)), (r0 + 1, fr - r0)):
        for j, wc in ((c0, 1 - (fc - c0)), (c0 + 1, fc - c0)):
            if 0 <= i < ROWS and 0 <= j < COLS and not np.isnan(g[i, j]):
                num, den = num + wr * wc * g[i, j], den + wr * wc
    return num / den if den > 0 else None


@pytest.mark.parametrize("tile, blocks", [(64, 200_000), (16, 200_000), (7, 0)])
def test_warp_against_single_cells(spark, monkeypatch, tile, blocks):
    monkeypatch.setattr(P, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(P, "SOURCE_BLOCK", 8)
    grids = {1: grid(1), 2: grid(2), 3: np.full((ROWS, COLS), np.nan)}
    steps = spark.sql("select * from values (1, 'a'), (2, 'b'), (3, 'a') as v(t, rule)")
    rules = spark.createDataFrame([(k, *v) for k, v in CORNERS.items()], "rule string, ulx double, uly double, lrx double, lry double")
    out = P.warp(cells_of(spark, grids), steps, rules, TARGET, ROWS, COLS, tile=tile).collect()
    assert len(out) == 3 * TARGET["n_rows"] * TARGET["n_cols"] == len({(x.t, x.tr, x.tc) for x in out})
    rule = {1: "a", 2: "b", 3: "a"}
    for x in out:
        want = warp_one(grids[x.t], CORNERS[rule[x.t]], x.tr, x.tc)
        assert (x.v is None) == (want is None) and (want is None or abs(x.v - want) < 1e-9)


def test_warped_cells_are_exchanged_once(spark):
    cells = spark.range(4000).select(F.lit(1).alias("t"), (F.col("id") / 64).cast("int").alias("r"), (F.col("id") % 64).cast("int").alias("c"), F.lit(1.0).alias("v"))
    steps = spark.sql("select * from values (1, 'a') as v(t, rule)")
    rules = spark.sql("select * from values ('a', -130.5D, 58.2D, -62.3D, 24.1D) as v(rule, ulx, uly, lrx, lry)")
    plan = P.warp(cells, steps, rules, TARGET, 64, 64)._jdf.queryExecution().executedPlan().toString()
    head = plan[: plan.index("BroadcastExchange")]
    assert head.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def inside(x, y, ring):
    """Even-odd rule on one ring, straight edges."""
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def test_zones_in_degrees_hold_the_cells_of_their_projected_centres(spark):
    rng = random.Random(4)
    zones = {}
    for z in range(12):
        x, y, n = rng.uniform(-118, -78), rng.uniform(28, 48), rng.randint(3, 7)
        angles = sorted(rng.uniform(0, 2 * np.pi) for _ in range(n))
        zones[z] = [[(x + 14 * np.cos(a), y + 6 * np.sin(a)) for a in angles]]
        if z % 3 == 0:
            zones[z].append([(x + 4 * np.cos(a), y + 2 * np.sin(a)) for a in angles])
    rows = [(z, k, i, float(px), float(py)) for z, rings in zones.items() for k, ring in enumerate(rings) for i, (px, py) in enumerate(ring)]
    vertices = spark.createDataFrame(rows, "z int, ring int, i int, x double, y double")
    members = Z.edge_members(P.project_edges(Z.zone_edges(vertices), TARGET), TARGET["n_rows"], TARGET["n_cols"])
    got = {(x.z, x.r, x.c) for x in members.select("z", "r", F.explode(F.sequence("lo", "hi")).alias("c")).collect()}
    r, c = np.mgrid[0 : TARGET["n_rows"], 0 : TARGET["n_cols"]]
    lon, lat = P.inverse_arrays(TARGET["x0"] + (c + 0.5) * TARGET["size"], TARGET["y0"] - (r + 0.5) * TARGET["size"])
    want = {(z, i, j) for z, rings in zones.items() for i in range(r.shape[0]) for j in range(r.shape[1])
            if sum(inside(lon[i, j], lat[i, j], ring) for ring in rings) % 2}
    assert len(want) > 200 and got == want


def test_pieces_of_edges_stay_near_their_curve_and_meet(spark):
    rng = random.Random(9)
    edges = [(k, rng.uniform(-125, -70), rng.uniform(25, 50), rng.uniform(-125, -70), rng.uniform(25, 50)) for k in range(40)]
    edges.append((99, -100.0, 40.0, -100.0, 40.0))
    df = spark.createDataFrame(edges, "k int, x1 double, y1 double, x2 double, y2 double")
    got = P.project_edges(df, TARGET).collect()
    for k, x1, y1, x2, y2 in edges:
        mine = [r for r in got if r.k == k]
        ends = {(r.x2, r.y2) for r in mine}
        assert sum((r.x1, r.y1) not in ends for r in mine) <= 1       # every piece starts where another ends
        n = len(mine)
        lon = x1 + (x2 - x1) * (np.arange(8 * n + 1) / (8 * n))
        lat = y1 + (y2 - y1) * (np.arange(8 * n + 1) / (8 * n))
        pts = spark.createDataFrame([(float(a), float(b)) for a, b in zip(lon, lat)], "a double, b double") if k in (0, 1) else None
        if pts is not None:
            ex, ny = P.to_lattice_sql("a", "b", TARGET)
            for p in pts.select(F.expr(ex).alias("x"), F.expr(ny).alias("y")).collect():
                near = min(distance(p.x, p.y, r) for r in mine)
                assert near <= P.CHORD
    assert max(sum(r.k == k for r in got) for k, *_ in edges) > 4


def distance(x, y, r):
    dx, dy = r.x2 - r.x1, r.y2 - r.y1
    f = 0.0 if dx == dy == 0 else min(1.0, max(0.0, ((x - r.x1) * dx + (y - r.y1) * dy) / (dx * dx + dy * dy)))
    return float(np.hypot(x - r.x1 - f * dx, y - r.y1 - f * dy))


def test_filled_windows_equal_the_clipped_fill_and_read_what_they_need(spark, monkeypatch):
    monkeypatch.setattr(FL, "WINDOW_TILE", 16)
    cells = cells_of(spark, {1: grid(5, 0.6), 2: grid(6, 0.9)})
    boxes = [(3, 9, 5, 12), (8, 14, 10, 20), (30, 40, 45, 52), (20, 20, 0, 0)]
    windows = spark.createDataFrame(boxes, "r0 int, r1 int, c0 int, c1 int")
    D = 4

    def kept(df):
        return sorted((x.t, x.r, x.c, None if x.v is None else round(x.v, 12)) for x in df.collect()
                      if any(a <= x.r <= b and c <= x.c <= d for a, b, c, d in boxes))
    assert kept(FL.fill_nodata(cells, D, windows=windows)) == kept(FL.fill_nodata(cells, D))
    read = FL.window_cells(cells, windows, D)
    near = [(x.t, x.r, x.c) for x in cells.collect() if any(
        (a <= x.r <= b and c <= x.c <= d) or (x.v is not None and a - D <= x.r <= b + D and c - D <= x.c <= d + D) for a, b, c, d in boxes)]
    assert sorted((x.t, x.r, x.c) for x in read.collect()) == sorted(near)
    assert FL.window_cells(cells, windows.limit(1), D).count() < read.count() < cells.count() / 2
    assert FL.fill_nodata(cells, D, windows=windows.limit(0)).count() == 0


def test_asof_rules_from_a_table_against_an_asof_join(spark):
    rng = random.Random(2)
    day = datetime.date(2003, 9, 30)
    rules = [(k, day + datetime.timedelta(days=rng.randint(0, 4000)), float(i)) for k in ("u", "m") for i in range(10)]
    rows = [(i, rng.choice(["u", "u", "u", "m", "other", None]), day + datetime.timedelta(days=rng.randint(-900, 6000))) for i in range(3000)]
    rows += [(9000 + i, k, d) for i, (k, d, _) in enumerate(rules)] + [(9990, "u", None)]
    r = spark.createDataFrame(rules, "dataset string, valid_from date, ulx double")
    got = P.asof(spark.createDataFrame(rows, "id int, dataset string, d date"), r).collect()
    con = duckdb.connect()
    con.execute("create table r (dataset varchar, valid_from date, ulx double)")
    con.execute("create table x (id int, dataset varchar, d date)")
    con.executemany("insert into r values (?, ?, ?)", rules)
    con.executemany("insert into x values (?, ?, ?)", rows)
    want = con.sql("""
        with f as (select dataset, min(valid_from) as first_from from r group by 1)
        select x.id, r.valid_from, r.ulx from (select x.id, x.dataset, greatest(x.d, f.first_from) as d from x left join f using (dataset) where x.d is not null) x
        asof left join r on x.dataset = r.dataset and x.d >= r.valid_from
        union all select id, null, null from x where d is null""").fetchall()
    assert len(got) == len(rows)
    assert sorted((x.id, str(x.valid_from), str(x.ulx)) for x in got) == sorted((i, str(f), str(u)) for i, f, u in want)


def test_rules_of_the_same_day_and_none(spark):
    rows = spark.sql("select * from values ('u', date '2010-05-05'), ('v', date '1999-01-01') as v(dataset, d)")
    rules = spark.sql("select * from values ('u', date '2009-01-01', 1.0D), ('u', date '2009-01-01', 2.0D) as v(dataset, valid_from, ulx)")
    assert sorted((x.dataset, x.ulx) for x in P.asof(rows, rules).collect()) == [("u", 2.0), ("v", None)]
    assert [x.ulx for x in P.asof(rows, rules.limit(0)).collect()] == [None, None]
