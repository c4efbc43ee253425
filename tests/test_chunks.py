"""Warps, backgrounds in several runs, pyramids brought up to date."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import mgrs
from gridloom.operators import arrays, tiles, warp
from gridloom.plans import background

PLACE = {"minx": 1_200_000.0, "maxy": 6_300_000.0, "pixel": 38.0, "x0": 600_000.0, "y0": 5_500_000.0, "px": 10.0, "zone": 32, "south": False}


def test_lattices_are_as_good_as_asked_for():
    at = warp.exact(warp.from_mercator_to_utm, PLACE)
    true = at(*np.meshgrid(np.arange(256) + 0.5, np.arange(256) + 0.5))
    steps = []
    for tolerance in (10.0, 0.125, 1e-4, 0.0):
        x, y, step = warp.approximate(at, 256, tolerance)
        assert max(np.abs(x - true[0]).max(), np.abs(y - true[1]).max()) <= max(1.5 * tolerance, 1e-9)
        steps.append(step)
    assert steps == sorted(steps, reverse=True) and steps[0] == 16 and steps[-1] == 1
    # Strong bends need finer lattices; a tile of one pixel has none.
    bent = lambda c, r: (c + 3 * np.sin(c / 2), r + 3 * np.cos(r / 2))
    x, _, step = warp.approximate(bent, 64, 0.125)
    assert step <= 2 and np.abs(x - bent(np.meshgrid(np.arange(64) + 0.5, np.arange(64) + 0.5)[0], 0)[0]).max() < 0.2
    assert warp.approximate(at, 1)[2] == 1


def test_zones_of_the_south():
    x, y = np.array([500_000.0, 700_000.0]), np.array([9_000_000.0, 7_000_000.0])
    lon, lat = mgrs.utm_inverse(x, y, np.array([33, 33]), np.array([True, True]))
    mx, my = lon * warp.geo.HALF_WORLD / 180, np.log(np.tan((90 + lat) * np.pi / 360)) / np.pi * warp.geo.HALF_WORLD
    e, n = warp.from_mercator_to_utm(mx, my, {"zone": 33, "south": True})
    assert np.allclose(e, x, atol=1e-3) and np.allclose(n, y, atol=1e-3)
    # Just across the equator northings of the southern grid go on beyond 10,000 km.
    _, n = warp.from_mercator_to_utm(np.array([15.0 / 180 * warp.geo.HALF_WORLD] * 2), np.array([-1.0, 1.0]), {"zone": 33, "south": True})
    assert n[0] < 1e7 < n[1] and n[1] - n[0] < 3


def test_kernels_widen_and_areas_are_covered():
    rnd = np.random.default_rng(3)
    a = rnd.standard_normal((60, 80))
    sx, sy = np.meshgrid((np.arange(30) + 0.5) * 2.5, (np.arange(20) + 0.5) * 3)
    mean = warp.gathered(a, sx, sy, "average", (2.5, 3.0))
    fine = a.repeat(2, 1)[:, :150]  # halves of cells: five to a pixel
    assert np.allclose(mean, fine.reshape(20, 3, 30, 5).mean((1, 3)))
    # A wave too short for the target's pixels goes, where a kernel that is not widened would alias it.
    wave = np.sin(np.arange(80) * np.pi * 0.9)[None, :].repeat(60, 0)
    wide, narrow = (np.abs(warp.gathered(wave, sx[2:-2, 3:-3], sy[2:-2, 3:-3], "lanczos", s)).mean() for s in ((2.5, 3.0), (1.0, 1.0)))
    assert wide < 0.05 < 0.3 < narrow
    flat = warp.gathered(np.full((9, 9), 7.0), *np.meshgrid([-1.0, 0.5, 4.5, 8.9, 9.1], [4.5]), "lanczos", (1.5, 1.5))
    assert np.isnan(flat[0, [0, 4]]).all() and np.allclose(flat[0, 1:4], 7.0)


@pytest.mark.parametrize("method", ["nearest", "bilinear", "lanczos", "average"])
def test_tiles_do_not_depend_on_blocks(spark, method):
    rnd = np.random.default_rng(1)
    a = np.where(rnd.random((90, 70)) < 0.05, np.nan, rnd.standard_normal((90, 70)))
    cells = spark.createDataFrame([(1, i, j, None if np.isnan(a[i, j]) else float(a[i, j])) for i in range(90) for j in range(70)], "key int, row int, col int, v double")
    places = spark.createDataFrame([(1, 600_000.0, 5_500_000.0, 25.0, 32, False)], "key int, x0 double, y0 double, px double, zone int, south boolean")
    lon, lat = mgrs.utm_inverse(np.array([600_000.0]), np.array([5_500_000.0]), np.array([32]), np.array([False]))
    x, y = float(lon[0]) / 180 * warp.geo.HALF_WORLD, float(np.log(np.tan((90 + lat[0]) * np.pi / 360)) / np.pi * warp.geo.HALF_WORLD)
    tiles_ = spark.createDataFrame([(1, i, j, x - 900 + j * 1600, y + 700 - i * 1600, 100.0, 16) for i in range(4) for j in range(4)], "key int, i int, j int, minx double, maxy double, pixel double, size int")
    out = []
    for block in (16, 128):
        blocks = arrays.from_cells(cells, ["key"], ["v"], block)
        made = warp.warp(blocks, places, tiles_, ["key"], ["i", "j"], method=method, block=block).collect()
        out.append({(r.i, r.j): np.frombuffer(r.data, "<f8") for r in made if not np.isnan(np.frombuffer(r.data, "<f8")).all()})
    assert out[0].keys() == out[1].keys() and len(out[0]) > 3
    assert all(np.allclose(out[0][k], out[1][k], equal_nan=True) for k in out[0])
    # Each pixel by itself.
    at = warp.exact(warp.from_mercator_to_utm, {"minx": x - 900, "maxy": y + 700, "pixel": 100.0, "x0": 600_000.0, "y0": 5_500_000.0, "px": 25.0, "zone": 32, "south": False})
    sx, sy = at(*np.meshgrid(np.arange(16) + 0.5, np.arange(16) + 0.5))
    want = warp.gathered(a, sx, sy, method, warp.stretch(at, 16)).ravel()
    assert np.isnan(want).any() and np.allclose(out[0][0, 0], want, atol=0.02, equal_nan=True)


SETTINGS = {"z_factor": 5.0, "pixel": 30.0, "erosion": 1, "sigma": 0.5, "fade": -30.0, "source": 1}


def raster(spark, shift=0.0):
    rnd = np.random.default_rng(2)
    a = np.cumsum(rnd.standard_normal((40, 50)), 0) * 20 - 60 + shift
    a[:10, :10] = 50.0
    return spark.createDataFrame([(i, j, float(a[i, j])) for i in range(40) for j in range(50)], "row int, col int, depth double").repartition(3)


def test_runs_make_what_is_missing(spark, tmp_path):
    cells, path = raster(spark), str(tmp_path / "one")
    first = {(r.chunk, r.status) for r in background.build(cells, path, SETTINGS, 10, only=cells.selectExpr("'0_0' as chunk").union(cells.selectExpr("'2_3' as chunk")).distinct()).collect()}
    assert first == {("0_0", "empty"), ("2_3", "rendered")} and background.made(spark, path).count() > 0
    second = {r.chunk for r in background.build(cells, path, SETTINGS, 10).collect()}
    assert len(second) == 18 and not second & {"0_0", "2_3"}
    assert background.build(cells, path, SETTINGS, 10).count() == 0
    once = str(tmp_path / "two")
    background.build(cells, once, SETTINGS, 10)
    rows = lambda p: sorted(map(tuple, background.made(spark, p).collect()))
    whole = rows(once)
    assert rows(path) == whole and len(whole) > 500
    # Chunks do not show in the result: one chunk for all gives the same pixels.
    one = str(tmp_path / "three")
    background.build(cells, one, SETTINGS, 64)
    by = {r[:2]: r for r in rows(one)}
    assert all(by[r[:2]] == r for r in whole)


def test_other_settings_replace_and_cut_off_runs_do_not_count(spark, tmp_path):
    cells, path = raster(spark), str(tmp_path / "b")
    background.build(cells, path, SETTINGS, 10)
    other = SETTINGS | {"fade": -1e6}
    assert background.digest(other) != background.digest(dict(reversed(list(SETTINGS.items())))) == background.digest(SETTINGS)
    assert {r.status for r in background.build(cells, path, other, 10).collect()} == {"empty"} and background.made(spark, path).count() == 0
    # Cells without a manifest, as a run leaves them that is cut off in between.
    again = SETTINGS | {"z_factor": 9.0}
    background.build(cells, path, again, 10)
    before = background.made(spark, path).count()
    stale = spark.createDataFrame([("none", "rendered", "1_1")], background.MANIFEST)
    stale.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk").parquet(f"{path}/manifest")
    assert background.made(spark, path).count() < before
    assert [r.chunk for r in background.build(cells, path, again, 10).collect()] == ["1_1"] and background.made(spark, path).count() == before


def pixels(spark, at, r):
    rows = [(3, x, y, i, j, (r + x + i) % 256, y, j, 255) for x, y in at for i in range(4) for j in range(4)]
    return spark.createDataFrame(rows, "z int, tx int, ty int, row int, col int, r int, g int, b int, a int")


@pytest.mark.parametrize("changed,gone", [([(0, 0), (7, 7)], []), ([(6, 1)], [(0, 0), (3, 3)]), ([], [(1, 1)]), ([(5, 6), (5, 7)], [(4, 6), (4, 7)]), ([], [])])
def test_updates_equal_rebuilds(spark, changed, gone):
    there = [(x, y) for x in range(6) for y in range(5)] + [(7, 7), (4, 6), (4, 7)]
    base = pixels(spark, there, 0)
    levels = tiles.pyramid(base, 4, 0, 3)
    new = pixels(spark, changed, 90)
    keys = spark.createDataFrame([(3, x, y) for x, y in gone], "z int, tx int, ty int")
    now, made = tiles.update_pyramid(levels, new, keys, 4, 0, 3)
    rest = base.join(new.select("z", "tx", "ty").union(keys).distinct(), ["z", "tx", "ty"], "left_anti").select(*base.columns)
    want = tiles.pyramid(rest.unionByName(new), 4, 0, 3)
    order = base.columns
    assert sorted(map(tuple, now.select(*order).collect())) == sorted(map(tuple, want.select(*order).collect()))
    dirty = {(3 - k, x >> k, y >> k) for x, y in changed + gone for k in range(4)} & {(r.z, r.tx, r.ty) for r in want.select("z", "tx", "ty").distinct().collect()}
    assert {tuple(r) for r in made.collect()} == dirty and made.count() == len(dirty)


def test_nothing_to_warp(spark):
    none = arrays.from_cells(spark.createDataFrame([], "key int, row int, col int, v double"), ["key"], ["v"], 16)
    places = spark.createDataFrame([(1, 0.0, 0.0, 1.0)], "key int, x0 double, y0 double, px double")
    far = spark.createDataFrame([(1, 0, 1e6, 1e6, 1.0, 16)], "key int, i int, minx double, maxy double, pixel double, size int")
    assert warp.warp(none, places, far, ["key"], ["i"], project=warp.same, block=16).count() == 0
    assert warp.tile_targets(spark.createDataFrame([(1, 1, 1, 0)], "key int, z int, tx int, ty int"), 256).select("minx", "maxy", F.round("pixel", 3).alias("p")).first().p == round(2 * warp.geo.HALF_WORLD / 512, 3)


def test_chunks_are_written_by_many_tasks(spark, tmp_path):
    cells = spark.range(64 * 4).select((F.col("id") % 64).cast("int").alias("row"), F.floor(F.col("id") / 64).cast("int").alias("col"), F.lit(-500.0).alias("depth"))
    background.build(cells, str(tmp_path), {"fade": -30.0}, 4)
    parts = {f.name.split("-")[1] for f in (tmp_path / "manifest").rglob("*.parquet")}
    assert len(parts) > 1 and background.manifest(spark, str(tmp_path)).count() == 16
