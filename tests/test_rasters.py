"""Rasters by byte ranges, tiled files, and kernels on block arrays."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import arrays, focal, mosaic
from gridloom.sources import parts, rasters, sinks, tiff


def shuffled_bytes(spark, run):
    """Bytes that ``run`` writes to shuffles."""
    store, jvm = spark._jsc.sc().statusStore(), spark._jvm

    def stages():
        found = store.stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        it, out = found.iterator(), {}
        while it.hasNext():
            x = it.next()
            out[x.stageId()] = x.shuffleWriteBytes()
        return out

    before = stages()
    run()
    spark._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    return sum(v for k, v in stages().items() if k not in before)


def cells_of(a, bands=("v",)):
    rows = []
    for i in range(a.shape[0]):
        for j in range(a.shape[1]):
            v = a[i, j] if a.ndim == 3 else [a[i, j]]
            rows.append((1, i, j, *(None if np.isnan(x) else float(x) for x in v)))
    return rows, "key int, row int, col int, " + ", ".join(f"{b} double" for b in bands)


@pytest.fixture(scope="module")
def image():
    rnd = np.random.default_rng(7)
    a = rnd.standard_normal((150, 210, 2)) * 60
    a[rnd.random(a.shape[:2]) < 0.05] = np.nan
    return a


def written(spark, image, where, **how):
    rows, schema = cells_of(image, ("v", "w"))
    blocks = arrays.from_cells(spark.createDataFrame(rows, schema).repartition(5), ["key"], ["v", "w"], 32).withColumnsRenamed({"br": "by", "bc": "bx"})
    placed = blocks.withColumns({"path": F.lit("a.tif"), "x0": F.lit(1000.0), "y0": F.lit(5000.0), "px": F.lit(10.0)})
    done = parts.write_files(parts.tiled_geotiffs(placed, 32, 2, **how), str(where)).collect()
    assert [r.path for r in done] == ["a.tif"] and done[0].bytes == (where / "a.tif").stat().st_size
    return str(where / "a.tif")


def whole(blocks, image, side=32):
    out = np.full(image.shape, np.nan)
    for r in blocks.collect():
        out[r.by * side : r.by * side + r.height, r.bx * side : r.bx * side + r.width] = np.frombuffer(r.data, "<f8").reshape(r.height, r.width, r.bands)
    return out


def test_tiled_file_and_its_reduced_images(spark, image, tmp_path):
    path = written(spark, image, tmp_path, levels=3)
    content = open(path, "rb").read()
    assert content[:4] == b"II+\0" and not [x for x in tmp_path.iterdir() if x.name.startswith(".a")]
    assert np.array_equal(whole(rasters.scan(spark, path, part=10_000), image), image.astype("f4").astype(float), equal_nan=True)
    found = tiff.images(lambda at, n: content[at : at + n])
    assert [(m.height, m.width, m.bands, m.scale[0]) for m in found] == [(150, 210, 2, 10.0), (75, 105, 2, 20.0), (38, 53, 2, 210 * 10 / 53)]
    half = np.nanmean(image.reshape(75, 2, 105, 2, 2), (1, 3))
    got = whole(rasters.scan(spark, path, pixel=20.0), half)
    assert np.allclose(got, half, atol=1e-4, equal_nan=True)


def test_only_blocks_within_are_read(spark, image, tmp_path):
    path = written(spark, image, tmp_path, levels=2)
    content, asked = open(path, "rb").read(), []

    def read(at, n):
        asked.append((at, n))
        return content[at : at + n]

    m = tiff.images(read)[0]
    head = sum(n for _, n in asked)
    assert head < 3000
    bounds = (1000 + 330.0, 5000 - 700.0, 1000 + 700.0, 5000 - 330.0)
    span = tiff.within(m, bounds)
    assert span == (1, 2, 1, 2)
    asked.clear()
    got = list(tiff.blocks(read, m, range(span[0], span[1] + 1), span[2:]))
    assert [(by, bx) for by, bx, _ in got] == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert len(asked) == 2 * 2 + 4 and sum(n for _, n in asked) < 0.2 * len(content)
    assert rasters.scan(spark, path, bounds).count() == 4
    for edge, want in (((1000, 4900, 1320, 5000), (0, 3, 0, 0)), ((1320, 4680, 1321, 4681), (0, 0, 1, 1)), ((3100, 0, 4000, 6000), None), ((1000, 5000, 2000, 5100), None), ((1500, 4000, 1500, 4500), None)):
        assert (tiff.within(m, edge) is None) == (want is None)
    # Windows of a table: each block once, and the right level.
    asked = spark.createDataFrame([(1, *bounds, 10.0), (2, *bounds, 15.0), (3, *bounds, 20.0), (4, 0.0, 0.0, 10.0, 10.0, 10.0), (5, 3000.0, 3000.0, 9000.0, 9000.0, 1.0)], "window long, minx double, miny double, maxx double, maxy double, pixel double")
    needs, blocks = rasters.windows(rasters.images(spark.createDataFrame([(path,)], "path string")), asked, 700.0)
    assert blocks.where("level = 0").count() == len({(0, r.by, r.bx) for r in needs.where("level = 0").collect()}) and {r.window for r in needs.collect()} == {1, 2, 3, 5}
    cells = {(r.window, r.row, r.col): r.v for r in rasters.window_cells(needs, blocks, ["v"]).collect()}
    fine = {(k, i, j) for k in (1, 2) for i in range(33, 70) for j in range(33, 70)} | {(3, i, j) for i in range(16, 35) for j in range(16, 35)} | {(5, i, j) for i in range(150) for j in range(200, 210)}
    assert set(cells) == fine
    assert all(np.isnan(image[i, j, 0]) if v is None else abs(v - image[i, j, 0]) < 1e-4 for (k, i, j), v in cells.items() if k != 3)


def test_filters_are_pushed(spark, image, tmp_path):
    path = written(spark, image, tmp_path)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        near = rasters.scan(spark, path).where("bx < 2 and by >= 3 and height = 32")
        assert sorted((r.by, r.bx) for r in near.collect()) == [(3, 0), (3, 1)]
        reader = rasters.FilteredReader({"path": path})
        from pyspark.sql.datasource import EqualTo, IsNull

        assert list(reader.pushFilters([EqualTo(("by",), 3), IsNull(("bx",))])) == [IsNull(("bx",))]
        got = [b for p in reader.partitions() for b in reader.read(p)]
        assert {b.column("by")[0].as_py() for b in got} == {3} and len(got) == 7
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_kinds_of_files():
    """Strips, planes, differences and packings, big and small ends; masks and unknown kinds."""
    data = np.arange(5 * 7 * 3, dtype=">u2").reshape(5, 7, 3)

    def file(order, packing, differs, apart, sample="u2", form=1):
        rows, planes = 2, [data[:, :, k : k + 1] for k in range(3)] if apart else [data]
        strips = []
        for plane in planes:
            for a in range(0, 5, rows):
                x = plane[a : a + rows].astype(order + sample)
                if differs == 2:
                    x = np.concatenate([x[:, :1], x[:, 1:] - x[:, :-1]], 1)
                raw = x.astype(order + sample).tobytes()
                if differs == 3:
                    n, stride = x.shape[0], x.shape[2]
                    spread = x.astype(">" + sample).reshape(n, -1).view(np.uint8).reshape(n, -1, 4).transpose(0, 2, 1).reshape(n, -1).copy()
                    spread[:, stride:] -= spread[:, :-stride].copy()
                    raw = spread.tobytes()
                strips.append(zlib.compress(raw) if packing == 8 else raw)
        bits = np.dtype(sample).itemsize * 8
        tags = [(256, 4, [7]), (257, 4, [5]), (258, 3, [bits] * 3), (259, 3, [packing]), (273, 4, []), (277, 3, [3]), (278, 4, [rows]), (279, 4, [len(s) for s in strips]), (284, 3, [2 if apart else 1]), (317, 3, [differs]), (339, 3, [form] * 3)]
        at, body, places = 8, b"".join(strips), []
        for s in strips:
            places.append(at)
            at += len(s)
        tags = [(t, k, places if t == 273 else v) for t, k, v in tags]
        extra, entries, start = b"", b"", at + 2 + 12 * len(tags) + 4
        for t, k, v in tags:
            raw = struct.pack(f"{order}{len(v)}{'H' if k == 3 else 'I'}", *v)
            if len(raw) > 4:
                entries += struct.pack(f"{order}HHII", t, k, len(v), start + len(extra))
                extra += raw
            else:
                entries += struct.pack(f"{order}HHI", t, k, len(v)) + raw.ljust(4, b"\0")
        return (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(f"{order}I", at) + body + struct.pack(f"{order}H", len(tags)) + entries + bytes(4) + extra

    for order in "<>":
        for packing, differs, apart, sample, form in ((1, 1, False, "u2", 1), (8, 2, False, "u2", 1), (8, 2, True, "u2", 1), (1, 1, True, "f4", 3), (8, 3, False, "f4", 3), (8, 3, True, "f4", 3)):
            content = file(order, packing, differs, apart, sample, form)
            read = lambda at, n, c=content: c[at : at + n]
            (m,) = tiff.images(read)
            got = np.concatenate([x for _, _, x in tiff.blocks(read, m, range(m.down))])
            assert np.array_equal(got, data), (order, packing, differs, apart, sample)
    for bad in (b"nothing at all..", file("<", 7, 1, False), file("<", 8, 2, False, "f4", 3)):
        with pytest.raises(ValueError):
            tiff.images(lambda at, n, c=bad: c[at : at + n])
    old = sinks.geotiff_bytes(np.ones((3, 4), "f4"), 0.0, 0.0, 1.0)
    assert tiff.images(lambda at, n: old[at : at + n])[0].width == 4


def test_kernels_on_arrays_equal_those_on_cells(spark, image):
    rows, schema = cells_of(image[:, :, :1])
    cells = spark.createDataFrame(rows, schema).repartition(4)
    blocks = arrays.stored(arrays.from_cells(cells, ["key"], ["v"], 32), ["key"], 4)
    back = arrays.to_cells(blocks, ["key"], {"data": ["v"]}, 32)
    assert sorted(map(str, back.collect())) == sorted(map(str, cells.collect()))
    pairs = [
        (arrays.blur(blocks, ["key"], "data", 2.0, "o"), focal.blur(cells, ["key"], "v", 2.0).withColumnRenamed("blurred", "o")),
        (arrays.hillshade(blocks, ["key"], "data", 5.0, 30.0, out="o"), focal.hillshade(cells, ["key"], "v", 5.0, 30.0).withColumnRenamed("shade", "o")),
    ]
    for ours, theirs in pairs:
        got = {(r.row, r.col): r.o for r in arrays.to_cells(ours, ["key"], {"o": ["o"]}, 32).collect() if r.o is not None}
        want = {(r.row, r.col): r.o for r in theirs.collect() if r.o is not None}
        assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9
    flags = arrays.stored(arrays.from_cells(cells.withColumn("v", (F.col("v") > 80).cast("double")), ["key"], ["v"], 32), ["key"], 4)
    grown = {(r.row, r.col): r.o == 1 for r in arrays.to_cells(arrays.spread(flags, ["key"], "data", 3, out="o"), ["key"], {"o": ["o"]}, 32).collect()}
    on = np.nan_to_num(image[:, :, 0]) > 80
    for i in range(150):
        for j in range(210):
            assert grown[i, j] == on[max(0, i - 3) : i + 4, max(0, j - 3) : j + 4].any()


def test_only_rims_are_shuffled(spark, image):
    rows, schema = cells_of(image[:, :, :1])
    cells = spark.createDataFrame(rows, schema).repartition(4)
    blocks = arrays.stored(arrays.from_cells(cells, ["key"], ["v"], 64), ["key"], 4)
    made = arrays.blur(blocks, ["key"], "data", 1.0)
    run = lambda df: lambda: df.write.format("noop").mode("overwrite").save()
    ours, theirs = shuffled_bytes(spark, run(made)), shuffled_bytes(spark, run(focal.blur(cells.withColumn("at", F.lit(1)), ["key"], "v", 1.0, block=64)))
    # Twelve blocks of 64 x 64 hold 150 x 210 values; rims of 4 are 8 bytes a value.
    assert 0 < ours < 150 * 210 * 8 * 0.5 and ours < theirs
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    two = arrays.hillshade(arrays.stored(made, ["key"], 4), ["key"], "blurred")
    assert two._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_blocks_of_a_ragged_raster_and_of_none(spark):
    cells = spark.createDataFrame([(1, 0, 0, 1.0), (1, 9, 2, 5.0), (2, 0, 0, 3.0)], "key int, row int, col int, v double")
    blocks = arrays.from_cells(cells, ["key"], ["v"], 4)
    assert sorted((r.key, r.br, r.bc, r.height, r.width) for r in blocks.collect()) == [(1, 0, 0, 4, 3), (1, 1, 0, 4, 3), (1, 2, 0, 2, 3), (2, 0, 0, 1, 1)]
    assert {(r.key, r.row, r.col): r.v for r in arrays.to_cells(blocks, ["key"], {"data": ["v"]}, 4).collect() if r.v is not None} == {(1, 0, 0): 1.0, (1, 9, 2): 5.0, (2, 0, 0): 3.0}
    none = arrays.from_cells(cells.limit(0), ["key"], ["v"], 4)
    assert none.count() == 0 and arrays.blur(none, ["key"], "data", 1.0).count() == 0


def test_mosaics_by_footprints(spark):
    rnd = np.random.default_rng(8)
    side, sources, rows = 4, {}, []
    for seq, (r0, r1, c0, c1, gaps, px) in enumerate([(0, 12, 0, 12, 0.0, 1.0), (0, 8, 0, 8, 0.0, 1.0), (4, 12, 4, 10, 0.3, 1.0), (0, 3, 9, 12, 0.0, 1.0), (0, 12, 0, 12, 0.0, 9.0)]):
        a = np.full((12, 12), np.nan)
        a[r0:r1, c0:c1] = np.where(rnd.random((r1 - r0, c1 - c0)) < gaps, np.nan, rnd.standard_normal((r1 - r0, c1 - c0)))
        sources[seq] = a
        rows += [(f"s{seq}", i, j, float(a[i, j])) for i in range(12) for j in range(12) if not np.isnan(a[i, j])]
        sources[f"s{seq}"] = (f"s{seq}", seq, r0, r1, c0, c1, px)
    cells = spark.createDataFrame(rows, "source string, row int, col int, v double")
    blocks = arrays.from_cells(cells, ["source"], ["v"], side).withColumn("whole", mosaic.is_whole("data", "height", "width", F.lit(side)))
    prints = spark.createDataFrame([sources[f"s{k}"] for k in range(5)], "source string, seq int, r0 int, r1 int, c0 int, c1 int, px double")
    for window, pixel, used in ((None, None, range(5)), (None, 1.0, range(4)), ((0, 3, 9, 12), 1.0, (0, 3)), ((20, 30, 0, 5), None, ())):
        made = mosaic.by_footprints(blocks, prints, window, pixel, side).collect()
        want, top = np.full((12, 12), np.nan), np.full((12, 12), np.nan)
        for k in used:
            there = ~np.isnan(sources[k])
            want[there], top[there] = sources[k][there], k
        assert bool(made) == bool(used)
        for r in made:
            at = slice(r.br * side, r.br * side + r.height), slice(r.bc * side, r.bc * side + r.width)
            assert np.array_equal(np.frombuffer(r.data, "<f8").reshape(r.height, r.width), want[at], equal_nan=True)
            assert np.array_equal(np.frombuffer(r.top, "<f8").reshape(r.height, r.width), top[at], equal_nan=True)
        if pixel and not window:  # the second source hides the first; the third has gaps; a corner is contested
            assert {(r.br, r.bc) for r in made if r.mixed} == {(0, 2), (1, 1), (1, 2), (2, 1), (2, 2)} and len(made) == 9


def test_blocks_are_made_of_batches_of_cells(spark):
    """Not of lists of a block's cells, of which a call of Python would hold as many blocks as a batch has rows."""
    rows = [(key, i, j, float(i * 100 + j)) for key in (None, 2**53, 2**53 + 1) for i in range(5) for j in range(7) if (i, j) != (4, 6) or key]
    rows += [(7, -1, 2, 1.0), (7, 9, 0, 2.0), (7, None, 0, 3.0)]
    blocks = arrays.from_cells(spark.createDataFrame(rows, "key long, row int, col int, v double"), ["key"], ["v"], 4)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "MapInPandas" in plan
    assert blocks.dtypes == [("key", "bigint"), ("br", "int"), ("bc", "int"), ("height", "int"), ("width", "int"), ("data", "binary")]
    got = {(r.key, r.br, r.bc): np.frombuffer(r.data, "<f8").reshape(r.height, r.width) for r in blocks.collect()}
    assert len(got) == 3 * 4 + 3 and {k: v.shape for k, v in got.items() if k[0] == 7} == {(7, 0, 0): (4, 3), (7, 1, 0): (4, 3), (7, 2, 0): (2, 3)}
    assert np.isnan(got[7, 0, 0]).all() and got[7, 2, 0][1, 0] == 2.0
    want = np.add.outer(np.arange(5) * 100.0, np.arange(7))
    for key in (None, 2**53, 2**53 + 1):
        a = np.block([[got[key, i, j] for j in range(2)] for i in range(2)])
        assert np.array_equal(a.ravel()[:-1], want.ravel()[:-1]) and (a[4, 6] == want[4, 6] if key else np.isnan(a[4, 6]))
