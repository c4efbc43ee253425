"""Worked arithmetic, invariants and edges of the raster functions."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import color, geo, masks, mgrs, text
from gridloom.operators import focal, graph, mosaic, resample, tiles
from gridloom.plans import cover, scenes, settings, units


def values(spark, numbers, f):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(numbers)], "i int, v double")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_soft_knee(spark):
    assert values(spark, [0, 0.2, 0.5, 0.8, 1], color.soft_knee) == pytest.approx([0, 0.28, 0.6, 0.85, 0.95], abs=1e-5)


def test_exposure_alone(spark):
    assert values(spark, [0.2, 0.5, 1], lambda c: color.soft_knee(c, 0.5, (0.3, 0.75, 1, 1, 1))) == pytest.approx([0.1, 0.25, 0.5])


def rgb(spark, pixel, f):
    df = spark.createDataFrame([tuple(map(float, pixel))], "r double, g double, b double")
    out = f(tuple(F.col(c) for c in "rgb"))
    return df.select(*(c.alias(n) for c, n in zip(out if isinstance(out, tuple) else (out,), "rgb"))).first()


def test_preview_grade_of_grey(spark):
    assert list(rgb(spark, (0.5, 0.5, 0.5), lambda p: color.grade(p, color.PREVIEW))) == pytest.approx([0.35] * 3)


def test_neutral_controls_leave_no_trace(spark):
    assert list(rgb(spark, (0.1, 0.6, 0.9), lambda p: color.grade(p, color.Grade()))) == pytest.approx([0.1, 0.6, 0.9])
    c = F.col("x")
    assert color.black_white(c, 0, 1) is c and color.shoulder(c, 1, 0.5) is c and color.piecewise(c, 0.2, 0.8, 1, 1, 1) is c


def test_highlight_weight(spark):
    assert rgb(spark, (0.97, 0.96, 0.95), color.hdr_weight)[0] > 0.9
    assert rgb(spark, (0.95, 0.4, 0.1), color.hdr_weight)[0] < 0.1


def test_curve_validation():
    with pytest.raises(ValueError):
        color.piecewise(F.col("x") if False else None, 0.8, 0.2, 1, 1, 2)
    with pytest.raises(ValueError):
        color.high_slope(0.5, 0.8, 2, 1)
    assert color.high_slope(0.5, 1.0, 1, 1) == 1


def test_terrarium_round_trip(spark):
    heights = [-11000.25, -1.0, 0.0, 1234.5, 8848.0]
    df = spark.createDataFrame([(h,) for h in [*heights, None, -32768.0]], "v double")
    r, g, b = color.terrarium(F.col("v"), -32768.0)
    rows = df.select("v", color.terrarium_decode(r, g, b).alias("back")).collect()
    assert all(abs(x.v - x.back) <= 1 / 256 for x in rows[:5]) and [x.back for x in rows[5:]] == [-32768.0] * 2


def test_tiles_hold_their_own_bounds(spark):
    b = [c.alias(n) for c, n in zip(geo.tile_bounds(7, F.lit(3), F.lit(4)), ("a", "b", "c", "d"))]
    df = spark.range(1).select(*b)
    assert list(df.select(*geo.tile_range(*(F.col(c) for c in "abcd"), 7)).first()) == [3, 4, 3, 4]


def test_touching_bounds_do_not_overlap(spark):
    lit = lambda *v: tuple(map(F.lit, v))
    df = spark.range(1)
    assert not df.select(geo.overlaps(lit(0, 0, 1, 1), lit(1, 0, 2, 1))).first()[0]
    assert not df.select(geo.envelopes_overlap(lit(0, 1, 0, 1), lit(1, 2, 0, 1))).first()[0]
    assert df.select(geo.intersection(lit(0, 0, 1, 1), lit(1, 0, 2, 1))).first()[0] is None


def test_bad_bbox(spark):
    df = spark.createDataFrame([("1,2,3,4",)], "t string")
    assert df.select(geo.parse_bbox(F.col("t"))).first()[0] == [1, 2, 3, 4]
    with pytest.raises(Exception, match="bounding box"):
        df.select(geo.parse_bbox(F.lit("1,2,x,4"))).collect()


def test_seasons(spark):
    summer = values(spark, [1.5, 0.7, 0, -0.7, -1.5], geo.season_weight)
    winter = values(spark, [1.5, 0.7, 0, -0.7, -1.5], lambda c: geo.season_weight(c, winter=True))
    assert summer[0] == 1 and summer[4] == 0 and summer[2] == pytest.approx(0.5) and summer == sorted(summer, reverse=True)
    assert [a + b for a, b in zip(summer, winter)] == pytest.approx([1] * 5)


def test_masks(spark):
    assert values(spark, [-200, -50, -20, 10, -32767], lambda c: masks.discovery(c, False, -32767.0)) == [False, True, True, True, False]
    assert values(spark, [-5, 0, 0.0005, 10], masks.drop_positive) == [-5, 0, 0.0005, None]
    assert values(spark, [255, 128, 0], lambda c: masks.alpha(F.lit(True), c)) == [0, 127, 255]
    assert values(spark, [50, None], lambda c: masks.has_enough_land(c, 60)) == [False, True]


def test_over_and_folds(spark):
    df = spark.createDataFrame([(0, 0, 200, 0, 0, 255), (0, 1, 0, 100, 0, 0), (0, 2, 0, 0, 200, 128), (1, 0, 9, 9, 9, 0)], "k int, seq int, r int, g int, b int, a int")
    out = {r.k: tuple(r)[1:] for r in tiles.fold_layers(df, ["k"], "seq").collect()}
    assert out[0] == (100, 0, 100, 255) and out[1] == (0, 0, 0, 0)
    under = spark.createDataFrame([(1, 1, 2, 3, 255), (2, 4, 5, 6, 255)], "k int, r int, g int, b int, a int")
    out = {r.k: tuple(r)[1:] for r in tiles.fold_layers(df, ["k"], "seq", under).collect()}
    assert out[0][3] == 255 and out[1] == (1, 2, 3, 255) and out[2] == (4, 5, 6, 255)


def grid(spark, a, name="v"):
    return spark.createDataFrame([(1, i, j, float(v)) for i, row in enumerate(a) for j, v in enumerate(row)], f"k int, row int, col int, {name} double")


def back(df, name, shape):
    out = np.full(shape, np.nan)
    for r in df.select("row", "col", name).collect():
        out[r.row, r.col] = np.nan if r[name] is None else r[name]
    return out


def test_morphology_equals_brute_force(spark):
    rnd = np.random.default_rng(0)
    a = rnd.random((9, 11)) < 0.7
    df = grid(spark, a).withColumn("on", F.col("v") == 1)
    pad = np.pad(a, 2, constant_values=True)
    want = np.array([[pad[i : i + 5, j : j + 5].all() for j in range(11)] for i in range(9)])
    assert (back(focal.erode(df, ["k"], "on", 2), "eroded", a.shape) == want).all()
    pad = np.pad(a, 2, constant_values=False)
    want = np.array([[pad[i : i + 5, j : j + 5].all() for j in range(11)] for i in range(9)])
    assert (back(focal.erode(df, ["k"], "on", 2, outside=False), "eroded", a.shape) == want).all()
    pad = np.pad(a, 1)
    want = np.array([[pad[i : i + 3, j : j + 3].any() for j in range(11)] for i in range(9)])
    assert (back(focal.dilate(df, ["k"], "on"), "dilated", a.shape) == want).all()


def test_components_over_blocks(spark):
    a = np.zeros((10, 10), int)
    a[1:9, 1] = a[8, 1:9] = a[4:9, 8] = 1  # a snake inside
    a[0, 5] = a[1, 6] = a[2, 5] = 1  # diagonal steps to the edge
    df = grid(spark, a).withColumn("on", F.col("v") == 1)
    for block in (3, 256):
        got = back(focal.reached_from_edge(df, "k", "on", block), "open", a.shape)
        assert got.sum() == 3 and got[0, 5] and got[1, 6] and got[2, 5]


def test_blur_keeps_constants_and_no_data(spark):
    a = np.full((6, 7), 3.0)
    got = back(focal.blur(grid(spark, a), ["k"], "v", 1.0), "blurred", a.shape)
    assert np.allclose(got, 3)
    a[2, 3] = -1
    got = back(focal.blur(grid(spark, a), ["k"], "v", 1.0, nodata=-1), "blurred", a.shape)
    assert got[2, 3] == -1 and got[2, 2] < 3


@pytest.mark.parametrize("farthest", [1024, 8])
def test_nearest_fill(spark, monkeypatch, farthest):
    monkeypatch.setattr(focal, "FARTHEST", farthest)
    rnd = np.random.default_rng(1)
    a = rnd.random((12, 12))
    ok = rnd.random((12, 12)) < 0.1
    df = grid(spark, a).join(grid(spark, ok, "ok"), ["k", "row", "col"]).withColumns({"valid": F.col("ok") == 1, "fill": F.col("col") != 5})
    want = a.copy()
    good = np.argwhere(ok)
    for i in range(12):
        for j in range(12):
            if not ok[i, j] and j != 5:
                want[i, j] = a[tuple(min(map(tuple, good), key=lambda p: ((p[0] - i) ** 2 + (p[1] - j) ** 2, *p)))]
    for block in (4, 64):
        assert np.allclose(back(focal.fill_nearest(df, ["k"], ["v"], "valid", "fill", block=block), "v", a.shape), want)


def test_blocks_do_not_show(spark):
    rnd = np.random.default_rng(2)
    a = rnd.random((21, 17)) * 9
    df = grid(spark, a).withColumn("tag", F.concat(F.lit("x"), F.col("row").cast("string")))
    for name, f in (("blurred", lambda b: focal.blur(df, ["k"], "v", 1.0, block=b)), ("shade", lambda b: focal.hillshade(df, ["k"], "v", block=b)), ("eroded", lambda b: focal.erode(df.withColumn("on", F.col("v") > 1), ["k"], "on", 2, block=b))):
        one, many = back(f(256), name, a.shape), back(f(5), name, a.shape)
        assert np.array_equal(np.isnan(one), np.isnan(many)) and np.allclose(one, many, equal_nan=True)
    assert {r.tag for r in focal.dilate(df.withColumn("on", F.col("v") > 8), ["k"], "on", block=4).collect()} == {f"x{i}" for i in range(21)}
    t = spark.createDataFrame([(1, f"t{i}", float(x), float(y)) for i, (x, y) in enumerate(rnd.random((40, 2)) * (19, 23) - 1)], "k int, name string, sx double, sy double")
    for method in resample.RADIUS:
        one, many = ({r.name: r.v for r in resample.gather(t, df, ["k", "name"], ["k"], ["v"], method, block=b).collect()} for b in (256, 4))
        assert len(one) == 40 and all(one[n] == pytest.approx(many[n]) for n in one) and any(v is None for v in one.values())


def test_places_in_a_global_order(spark):
    rnd = np.random.default_rng(3)
    df = spark.createDataFrame([(i, int(x)) for i, x in enumerate(rnd.integers(0, 50, 400))], "i int, x int").repartition(7)
    got = {r.i: r.place for r in graph.places(df, [F.col("x").desc(), F.col("i")]).collect()}
    want = sorted(df.collect(), key=lambda r: (-r.x, r.i))
    assert [got[r.i] for r in want] == list(range(1, 401))


def test_flat_ground_is_lit_evenly(spark):
    got = [r.shade for r in focal.hillshade(grid(spark, np.zeros((4, 4))), ["k"], "v").collect()]
    assert got == pytest.approx([1 + 254 * math.sin(math.radians(45))] * 4)


def test_weighted_mean_falls_back(spark):
    df = spark.createDataFrame([(1, 0, 10.0, 1.0, 1.0), (1, 1, 20.0, 1.0, 1.0), (2, 0, None, 1.0, 1.0), (2, 1, 100.0, 1.0, 1.0), (3, 0, None, 1.0, 1.0)], "k int, d int, r double, g double, b double")
    w = F.when(F.col("d") == 0, 1.0).otherwise(0.0)
    out = {r.k: (r.r, r.valid) for r in mosaic.weighted_mean(df, ["k"], w).collect()}
    assert out == {1: (10, True), 2: (100, True), 3: (None, False)}


def test_kernels_reproduce_constants(spark):
    src = grid(spark, np.full((8, 8), 5.0))
    t = spark.createDataFrame([(1, i, 0.7 * i + 0.3, 0.9 * i + 0.2) for i in range(8)], "k int, i int, sx double, sy double")
    for method in resample.RADIUS:
        assert all(r.v == pytest.approx(5) for r in resample.gather(t, src, ["k", "i"], ["k"], ["v"], method).collect())


def test_equal_outlines_are_taken_once(monkeypatch):
    asked, own = [], cover.parts
    monkeypatch.setattr(cover, "parts", lambda r: asked.append(1) or own(r))
    one, two = [(0, 0), (0.5, 0), (0.5, 1), (0, 1)], [(0.25, 0), (0.75, 0), (0.75, 1), (0.25, 1)]
    assert cover.chosen([(0, 0), (1, 0), (1, 1), (0, 1)], [one, None, *[one] * 50, two, *[two, one] * 50]) == [0, 52] and len(asked) == 3


def test_equal_boxes_go_to_the_points_once(spark):
    rows = [(i, f"2020-01-{1 + i % 7:02d}" if i % 3 else None, i % 2, 0.0, 0.0, 0.5, 0.5 + i % 4 / 8) for i in range(60)]
    df = spark.createDataFrame(rows, "seq long, start string, cell int, a double, b double, c double, d double")
    plan_ = scenes.greedy_cover(df, "cell", "start", ("a", "b", "c", "d"))
    text_ = plan_._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in text_[text_.rindex("Generate") :]
    best = {}
    for seq, start, cell, *box in rows:
        for i in range(16):
            for j in range(16):
                if box[0] <= (i + 0.5) / 16 <= box[2] and box[1] <= (j + 0.5) / 16 <= box[3]:
                    best[cell, i, j] = max(best.get((cell, i, j), ("", -99)), (start or "", -seq))
    assert {r.seq for r in plan_.collect()} == {-s for _, s in best.values()}


def test_outlines_are_projected_together(monkeypatch):
    calls, own = [], mgrs.utm_inverse
    monkeypatch.setattr(mgrs, "utm_inverse", lambda *a: calls.append(1) or own(*a))
    some = ["31UDQ", None, "18TWL", "ZAG", "56HLH", "61UDQ", "32VKN"]
    got = mgrs.outlines(some)
    assert len(calls) == 1 and [r is None for r in got] == [False, True, False, True, False, True, False]
    assert got == [mgrs.outline(c) for c in some] and mgrs.outlines([]) == []
    for code, ring in zip(some, got, strict=True):
        if ring and code != "32VKN":  # a widened zone's squares reach over
            assert mgrs.codes([sum(p["lon"] for p in ring[:4]) / 4], [sum(p["lat"] for p in ring[:4]) / 4]) == [code]


def test_a_histogram_of_nothing_has_no_shares(spark):
    none = mosaic.histogram(spark.createDataFrame([], "v double"), F.col("v"), 4).collect()
    assert [(r.bin, r["count"], r.share) for r in sorted(none)] == [(i, 0, None) for i in range(4)]
    some = mosaic.histogram(spark.createDataFrame([(0.1,), (1.0,), (0.9,)], "v double"), F.col("v"), 4).collect()
    assert [(r["count"], r.share) for r in sorted(some)] == [(1, 0.5), (0, 0.0), (0, 0.0), (2, 1.0)]


def test_samples_over_the_last_meridian_have_codes(spark):
    assert mgrs.codes([180.5], [0.5]) == [None] and mgrs.codes([180.5], [0.5], 360.0) == mgrs.codes([180.5], [0.5], 181.0) != [None]
    got = {r.code for r in mgrs.codes_in(spark.createDataFrame([(1, 179.7, 0.2, 180.5, 0.8)], "id int, minx double, miny double, maxx double, maxy double")).collect()}
    assert {*mgrs.codes([179.7], [0.2]), *mgrs.codes([180.5], [0.8], 360.0)} <= got and len(got) > 1


def test_grid_codes():
    assert mgrs.codes([2.35, -74.0, 151.2, 5.3, 15.6], [48.85, 40.7, -33.87, 60.39, 78.2]) == ["31UDQ", "18TWL", "56HLH", "32VKN", "33XWG"]
    assert mgrs.codes([0, float("nan"), 0], [89.9, 0, 91]) == ["ZAG", None, None]
    lon, lat = np.random.default_rng(0).uniform(-179, 179, 500), np.random.default_rng(1).uniform(-79, 83, 500)
    z = mgrs.zone(lon, lat)
    back_lon, back_lat = mgrs.utm_inverse(*mgrs.utm(lon, lat, z), z, lat < 0)
    assert np.allclose(back_lon, lon, atol=1e-7) and np.allclose(back_lat, lat, atol=1e-7)
    ring = mgrs.outline("31UDQ")
    assert len(ring) == 5 and mgrs.outline("31IDQ") is None and mgrs.outline(None) is None
    assert mgrs.codes([np.mean([p["lon"] for p in ring[:4]])], [np.mean([p["lat"] for p in ring[:4]])]) == ["31UDQ"]


def test_batches_break_at_gaps_and_width(spark):
    slabs = spark.createDataFrame([(0, 1, 1, 5), (1, 1, 4, 5), (0, 2, 0, 0), (0, 2, 2, 2)], "seq int, ty int, tx_min int, tx_max int")
    out = sorted((r.ty, r.tx_min, r.tx_max, tuple(r.ids)) for r in units.batches(units.contributors(slabs), 2).collect())
    assert out == [(1, 1, 2, (0,)), (1, 3, 3, (0,)), (1, 4, 5, (0, 1)), (2, 0, 0, (0,)), (2, 2, 2, (0,))]


def test_halos_and_start_cells(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 10.0, 1000.0, 1e6)], "p double")
    assert [r[0] for r in df.select(units.ocean_halo(F.col("p"))).collect()] == [512, 125, 4, 3]
    t = spark.createDataFrame([(1, 0, 1)], "z int, tx int, ty int")
    r = units.tile_plan(t, 256, "gauss").first()
    assert (r.xoff, r.yoff, r.width, r.height, r.core_x, r.core_y) == (0, 254, 258, 258, 0, 2) and r.minx == -geo.HALF_WORLD and r.miny == pytest.approx(-geo.HALF_WORLD)
    with pytest.raises(ValueError):
        units.tile_plan(t, 256, "cubic")
    assert scenes.start_cells((1, 1, 9, 5)) == [(1, 1, 9, 5)] and scenes.start_cells((1, 1, 10, 5)) == [(1, 1, 8, 5), (8, 1, 10, 5)]
    w, h = F.lit(4), F.lit(2)
    assert list(spark.range(1).select(*geo.raster_bounds((10, 1, 0, 20, 0, -1), w, h)).first()) == [10, 18, 14, 20]
    assert list(spark.range(1).select(*geo.raster_bounds((0, 0, 1, 0, 1, 0), w, h)).first()) == [0, 0, 2, 4]


def test_quadtree_splits_only_full_cells(spark):
    pts = spark.createDataFrame([(0.1, 0.1)] * 5 + [(0.9, 0.9)], "x double, y double")
    out = sorted(tuple(r) for r in scenes.quadtree(pts, "x", "y", (0, 0, 1, 1), most=4, depth=3).collect())
    assert out == [(1, 1, 1, 1), (3, 0, 0, 5)]
    assert [tuple(r) for r in scenes.quadtree(pts, "x", "y", (0, 0, 1, 1), most=9, depth=3).collect()] == [(0, 0, 0, 6)]


def test_exact_outline_decides_not_its_envelope(spark):
    ring = [(0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4)]
    df = spark.createDataFrame([(0, 2.0, 2.0, 3.0, 3.0), (1, 0.5, 2.0, 3.0, 3.0), (2, -1.0, -1.0, 5.0, 5.0), (3, 5.0, 5.0, 6.0, 6.0)], "i int, a double, b double, c double, d double")
    got = df.select("i", scenes.touches_ring(tuple(F.col(c) for c in "abcd"), ring).alias("t")).collect()
    assert [r.t for r in sorted(got)] == [False, True, True, False]


def test_cover_of_polygons_is_exact(spark):
    square = ((0, 0), (1, 0), (1, 1), (0, 1))
    ell = [(0, 0), (1, 0), (1, 0.5), (0.5, 0.5), (0.5, 1), (0, 1)]
    assert sum(map(cover.area, cover.triangles(ell))) == pytest.approx(0.75) and sum(map(cover.area, cover.triangles(ell[::-1]))) == pytest.approx(0.75)
    corner = [(0.4, 0.4), (1, 0.4), (1, 1), (0.4, 1)]
    assert cover.chosen(square, [ell, [(0, 0), (0.4, 0), (0.4, 0.4), (0, 0.4)], None, [(5, 5), (6, 5), (6, 6)], corner, [(0.6, 0.6), (0.7, 0.6), (0.7, 0.7)], square]) == [0, 4]
    rnd = np.random.default_rng(5)
    for _ in range(10):
        at = rnd.random((7, 2))
        turn = rnd.random(7) * 6
        rings = [[(x + 0.3 * math.cos(t + k * math.pi / 2), y + 0.3 * math.sin(t + k * math.pi / 2)) for k in range(4)] for (x, y), t in zip(at, turn)]
        left, gone = cover.triangles(square), 0.0
        for r in rings:
            for t in cover.triangles(r):
                left, part = cover.without(left, t)
                gone += part
        assert gone + sum(map(cover.area, left)) == pytest.approx(1)
        p = rnd.random((40000, 2))
        inside = np.zeros(len(p), bool)
        for r in rings:
            inside |= np.all([(b[0] - a[0]) * (p[:, 1] - a[1]) - (b[1] - a[1]) * (p[:, 0] - a[0]) >= 0 for a, b in zip(r, [*r[1:], r[0]])], axis=0)
        assert gone == pytest.approx(inside.mean(), abs=0.02)
    rows = [(1, 1, "2020", [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]), (1, 2, "2021", [[0.0, 0.0], [0.6, 0.0], [0.6, 1.0], [0.0, 1.0]]), (1, 3, None, [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]]), (2, 4, "2020", None)]
    df = spark.createDataFrame(rows, "cell int, seq int, start string, ring array<array<double>>")
    assert sorted(tuple(r) for r in cover.greedy_cover(df, "cell", "start", "ring", square).collect()) == [(1, 1), (1, 2)]


def test_settings(spark):
    a = settings.to_frame(spark, "a", {"x": {"y": (1, 2), "z": 1}, "gone": True})
    b = settings.to_frame(spark, "b", {"x": {"y": [1, 2], "z": 2}, "new": "v"})
    assert sorted(r.change for r in settings.differences(a, b).collect()) == ["gone: true -> <missing>", 'new: <missing> -> "v"', "x.z: 1 -> 2"]
    same = settings.signature(a.unionByName(a.withColumn("run", F.lit("c")))).collect()
    assert same[0].digest == same[1].digest


def test_names(spark):
    df = spark.createDataFrame([("a_b_2024_Q3_10TEK_0_1",), ("short",)], "f string")
    rows = df.select(text.folder_parts(F.col("f")).alias("p"), text.cache_name(F.col("f")).alias("c")).collect()
    assert (rows[0].p.code, rows[0].p.unit, rows[0].c) == ("10TEK", "10TEK_0_1", "10TEK_0_1") and rows[1].p.code is None
    assert values(spark, [None, 0, 61, 3661], text.eta) == ["calculating", "0s", "1m 01s", "1h 01m 01s"]


def test_assets_of_overlapping_features(spark):
    feature = lambda box, *hrefs: {"bbox": box, "assets": {f"a{i}": {"href": h} for i, h in enumerate(hrefs)}}
    collection = {"features": [feature([0, 0, 1, 1], "x.json", "one.tif", "two.tif"), feature([1, 0, 2, 1], "far.tif"), feature([0.2, 0.2, 0.4, 0.4], "none.txt")]}
    rows = spark.createDataFrame([("near", json.dumps(collection)), ("far", json.dumps(collection))], "dataset string, json string")
    sets = spark.createDataFrame([("near", [0.0, 0.0, 5.0, 5.0]), ("far", [7.0, 7.0, 8.0, 8.0])], "dataset string, bbox array<double>")
    assert [tuple(r) for r in scenes.stac_assets(rows, (0.1, 0.1, 1.0, 1.0), sets).collect()] == [("near", "one.tif")]


def test_aligned_windows():
    at = resample.aligned_window
    assert at((0, 100), 10, (10, 10), (20, 50, 40, 80), 10) == (2, 2, 2, 3)
    assert at((0, 100), 10, (10, 10), (21, 50, 41, 80), 10) is None and at((0, 100), 10, (10, 10), (20, 50, 40, 80), 9.9) is None
    assert at((0, 100), 10, (10, 10), (90, 50, 120, 80), 10) is None and at((0, 100), 10, (10, 10), (20, 50, 40, 80), 10, same_crs=False) is None


def test_recent_falls_back_where_nothing_is_recent(spark):
    df = spark.createDataFrame([(1, "2020-01-01"), (1, "2024-05-01"), (1, None), (2, "2019-01-01")], "cell int, start string")
    assert sorted((r.cell, r.start or "") for r in scenes.recent(df, "cell", "start", "2021-01-01").collect()) == [(1, ""), (1, "2024-05-01"), (2, "2019-01-01")]


def test_option_choice(spark):
    rows = [(1, 1, "GeoTIFF", True), (1, 2, "JPEG2000 a", True), (1, 3, "JPEG2000 b", True), (2, 1, "GeoTIFF", True), (2, 2, "x.jp2", True), (2, 3, "y.jp2", True), (3, 1, "jp2", False), (3, 2, "GeoTIFF", True), (3, 3, "other", True)]
    df = spark.createDataFrame(rows, "entity int, seq int, name string, available boolean")
    assert {r.entity: r.seq for r in scenes.preferred_option(df, "entity", "name", "seq").collect()} == {1: 3, 2: 2, 3: 2}
