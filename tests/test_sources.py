"""Files in, files out, and streams."""

import io
import json
import sqlite3
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import geo
from gridloom.operators.tiles import extent
from gridloom.sources import files, sinks
from gridloom.streaming import tiles as streams


def test_geotiff_round_trip(spark, tmp_path):
    data = np.arange(12, dtype="f4").reshape(3, 4)
    (tmp_path / "a.tif").write_bytes(sinks.geotiff_bytes(data, 100.0, 200.0, 10.0))
    (tmp_path / "b.tif").write_bytes(sinks.geotiff_bytes(data.astype("u1"), 0.0, 0.0, 1.0, 4326))
    blocks = files.geotiff(files.binary(spark, str(tmp_path), "*.tif")).collect()
    assert sorted(tuple(b.data) for b in blocks) == [tuple(map(float, range(12)))] * 2
    a = next(b for b in blocks if b.path.endswith("a.tif"))
    assert (a.x0, a.y0, a.px, a.width, a.height) == (100, 200, 10, 4, 3)
    px = files.block_pixels(files.geotiff(files.binary(spark, str(tmp_path), "a.tif")), nodata=5.0).collect()
    assert {(p.x, p.y): p.value for p in px}[115.0, 185.0] is None and len(px) == 12
    with pytest.raises(ValueError):
        list(files.read_geotiff(b"nothing at all"))


def lzw(data):
    table, width, out, bits = {bytes([i]): i for i in range(256)}, 9, [], lambda code, w: f"{code:0{w}b}"
    free, word = 258, b""
    out.append(bits(256, 9))
    for i in data:
        if word + bytes([i]) in table:
            word += bytes([i])
            continue
        out.append(bits(table[word], width))
        table[word + bytes([i])] = free
        free, word = free + 1, bytes([i])
        if free > (1 << width) - 1:
            width += 1
        if free == 4094:
            out.append(bits(256, 12))
            table, width, free = {bytes([k]): k for k in range(256)}, 9, 258
    out += [bits(table[word], width), bits(257, width + (free + 1 > (1 << width) - 1 and width < 12))]
    text = "".join(out)
    return int(text.ljust(-(-len(text) // 8) * 8, "0"), 2).to_bytes(-(-len(text) // 8), "big")


def test_tiff_of_lzw_and_differences(spark, tmp_path):
    rnd = np.random.default_rng(1)
    data = np.cumsum(rnd.integers(-3, 4, (60, 80)), 1).astype("i2") + 500
    for raw in (bytes(rnd.integers(0, 4, 30000, np.uint8)), b"a" * 5000, bytes(rnd.integers(0, 256, 9000, np.uint8))):
        assert files.unlzw(lzw(raw)) == raw
    steps = np.diff(data, axis=1, prepend=0).astype("<i2").tobytes()
    plain = sinks.geotiff_bytes(data, 0.0, 0.0, 1.0)
    packed = zlib.compress(data.astype("<i2").tobytes(), 6)
    at = plain.index(packed)
    body = lzw(steps)
    moved = bytearray(plain + body)
    head = struct.unpack_from("<I", plain, 4)[0]
    (n,) = struct.unpack_from("<H", plain, head)
    for i in range(n):
        tag, kind, count = struct.unpack_from("<HHI", plain, head + 2 + 12 * i)
        where = head + 10 + 12 * i
        if tag == 259:
            struct.pack_into("<HH", moved, where, 5, 0)
        elif tag == 273:
            struct.pack_into("<I", moved, where, len(plain))
        elif tag == 279:
            struct.pack_into("<I", moved, where, len(body))
        elif tag == 284:  # planar configuration gives its place to the predictor
            struct.pack_into("<HHIHH", moved, head + 2 + 12 * i, 317, 3, 1, 2, 0)
    assert at > 0
    blocks = list(files.read_geotiff(bytes(moved)))
    assert len(blocks) == 1 and (blocks[0][-1] == data).all()


def test_zip_and_tree(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("b.tif", b"2")
        z.writestr("a.tif", b"1")
        z.writestr("c.txt", b"3")
    (tmp_path / "x.zip").write_bytes(buf.getvalue())
    zips = files.binary(spark, str(tmp_path), "*.zip")
    assert files.fresh(zips, F.current_timestamp()).count() == 1
    assert files.fresh(zips, F.current_timestamp() + F.make_dt_interval(F.lit(91))).count() == 0
    rows = files.zip_members(files.binary(spark, str(tmp_path), "*.zip"), ".tif").collect()
    assert [(r.member, bytes(r.content)) for r in rows] == [("a.tif", b"1"), ("b.tif", b"2")]
    at = tmp_path / "tree/3/4"
    at.mkdir(parents=True)
    (at / "5.webp").write_bytes(b"t")
    assert [tuple(r)[:3] for r in files.tile_tree(spark, str(tmp_path / "tree")).collect()] == [(3, 4, 5)]


def test_lists_and_sidecars(spark, tmp_path):
    (tmp_path / "l.list").write_text('# codes {"source": "x"}\n31UDQ\n18TWL\n\n31UDQ\n')
    assert sorted(r.code for r in files.code_list(spark, str(tmp_path / "l.list")).collect()) == ["18TWL", "31UDQ"]
    assert files.code_list_header(spark, str(tmp_path / "l.list"), "source string").first().source == "x"
    (tmp_path / "good.json").write_text('{"a": 1}')
    (tmp_path / "bad.json").write_text('{"a": ')
    assert [r.a for r in files.sidecar(spark, str(tmp_path / "good.json"), "a int").collect()] == [1]
    assert files.sidecar(spark, str(tmp_path / "bad.json"), "a int").count() == 0
    ring = [[0, 0], [4, 0], [4, 3], [0, 0]]
    shapes = {"features": [{"geometry": {"type": "Polygon", "coordinates": [ring]}}, {"geometry": {"type": "MultiPolygon", "coordinates": [[ring], [[[9, 9], [10, 9], [9, 9]]]]}}]}
    (tmp_path / "o.json").write_text(json.dumps(shapes))
    rings = files.outlines(spark, str(tmp_path / "o.json"))
    assert rings.count() == 3 and list(files.envelope(rings).first()) == [0, 0, 10, 9]


def test_listings_and_outlines_in_metres(spark, tmp_path):
    for d, f in (("2024/07/01", "a"), ("2024/07/01", "b"), ("2024/01/01", "a")):
        (tmp_path / "store" / d / f).mkdir(parents=True)
        (tmp_path / "store" / d / f / "x.tif").write_bytes(b"1")
    (tmp_path / "store" / "notes.tif").write_bytes(b"1")
    assert sorted(tuple(r) for r in files.listing(spark, str(tmp_path / "store"), "*.tif").collect()) == [("2024/01/01", "a"), ("2024/07/01", "a"), ("2024/07/01", "b")]
    ring = [[0, 0], [geo.HALF_WORLD / 2, 0], [geo.HALF_WORLD / 2, geo.HALF_WORLD], [0, 0]]
    shapes = {"crs": {"properties": {"name": "urn:ogc:def:crs:EPSG::3857"}}, "features": [{"geometry": {"type": "Polygon", "coordinates": [ring]}}]}
    (tmp_path / "m.json").write_text(json.dumps(shapes))
    assert list(files.envelope(files.outlines(spark, str(tmp_path / "m.json"))).first()) == pytest.approx([0, 0, 90, 85.0511287798066])


def tiles(spark, n=40):
    return spark.range(n).select(F.lit(4).alias("z"), (F.col("id") % 16).cast("int").alias("tx"), F.floor(F.col("id") / 16).cast("int").alias("ty"), F.encode(F.concat(F.lit("tile"), F.col("id").cast("string")), "UTF-8").alias("content"))


def test_png(spark):
    px = spark.createDataFrame([(0, 0, 0, 0, 0, 1, 2, 3, 255), (0, 1, 0, 0, 0, 1, 2, 3, 0)], "z int, tx int, ty int, row int, col int, r int, g int, b int, a int")
    rows = sinks.png_tiles(px, 2).collect()
    assert [r.tx for r in rows] == [0]
    raw = bytes(rows[0].content)
    assert struct.unpack(">II", raw[16:24]) == (2, 2) and raw[25] == 6
    body = zlib.decompress(raw[raw.index(b"IDAT") + 4 :][: struct.unpack(">I", raw[raw.index(b"IDAT") - 4 :][:4])[0]])
    assert body[:5] == bytes([0, 1, 2, 3, 255])


def test_mbtiles_round_trip(spark):
    chunks = sinks.mbtiles_chunks(tiles(spark), {"name": "n"}, side=8)
    assert chunks.count() == 2
    rows = files.mbtiles(chunks.select(F.col("chunk").alias("path"), "content")).collect()
    assert {(r.tile_column, 15 - r.tile_row): bytes(r.tile_data) for r in rows} == {(r.tx, r.ty): bytes(r.content) for r in tiles(spark).collect()}
    db = sqlite3.connect(":memory:")
    db.deserialize(chunks.first().content)
    assert db.execute("SELECT value FROM metadata WHERE name = 'name'").fetchone() == ("n",)
    junk = spark.createDataFrame([("j", b"no store")], "path string, content binary")
    assert files.mbtiles(junk).count() == 0


def test_hilbert_order(spark):
    at = [(0, 0, 0), (1, 0, 0), (1, 0, 1), (1, 1, 1), (1, 1, 0), (2, 0, 0), (3, 0, 0)]
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(at)], "i int, z int, x int, y int")
    assert [r[1] for r in sorted(df.select("i", sinks.hilbert_id("z", "x", "y")).collect())] == [0, 1, 2, 3, 4, 5, 21]
    level = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y")).select("x", "y", sinks.hilbert_id(F.lit(3), "x", "y").alias("h")).orderBy("h").collect()
    assert [r.h for r in level] == list(range(21, 85)) and all(abs(a.x - b.x) + abs(a.y - b.y) == 1 for a, b in zip(level, level[1:]))


def test_pmtiles_parts(spark, tmp_path):
    import gzip

    path = str(tmp_path / "a.pmtiles")
    sinks.save_parts(sinks.pmtiles_parts(tiles(spark), {"name": "n"}, leaf=16), path)
    raw = open(path, "rb").read()
    assert raw[:8] == b"PMTiles\x03"
    root_at, root_n, meta_at, meta_n, leaf_at, leaf_n, data_at, data_n, n, *_ = struct.unpack_from("<11Q", raw, 8)
    assert n == 40 and data_at + data_n == len(raw) and json.loads(gzip.decompress(raw[meta_at : meta_at + meta_n])) == {"name": "n"}

    def entries(blob):
        data, at = gzip.decompress(blob), 0

        def num():
            nonlocal at
            shift = out = 0
            while True:
                byte = data[at]
                at += 1
                out |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return out

        k = num()
        ids = np.cumsum([num() for _ in range(k)]).tolist()
        runs, sizes, spots = [num() for _ in range(k)], [num() for _ in range(k)], []
        for i in range(k):
            o = num()
            spots.append(o - 1 if o else spots[-1] + sizes[i - 1])
        return list(zip(ids, runs, sizes, spots))

    assert 127 + root_n <= 16_384
    west, south, east, north, _, lon, lat = struct.unpack_from("<iiiiBii", raw, 102)
    e = extent(tiles(spark)).first()
    assert (west, south, east, north, lon, lat) == tuple(round(x * 1e7) for x in (e.west, e.south, e.east, e.north, e.center_lon, e.center_lat))
    assert [x[:1] + x[3:] for x in entries(raw[root_at : root_at + root_n])] == [(i, o) for i, o, _, _ in files.read_directory(raw[root_at : root_at + root_n])]
    found = []
    for _, run, size, at in entries(raw[root_at : root_at + root_n]):
        assert run == 0
        for _, _, s, o in entries(raw[leaf_at + at : leaf_at + at + size]):
            found.append(raw[data_at + o : data_at + o + s])
    assert sorted(found) == sorted(bytes(r.content) for r in tiles(spark).collect())


def test_sidecars_and_code_lists_are_written_whole(spark, tmp_path):
    path = str(tmp_path / "s.json")
    for payload in ({"b": 1, "a": [1, 2]}, {"a": None}):
        sinks.sidecar(spark, path, payload)
        assert json.load(open(path)) == payload
    assert sorted(p.name for p in tmp_path.iterdir() if "temp" in p.name and not p.name.endswith(".crc")) == []


def test_root_directory_keeps_its_place(spark, monkeypatch):
    monkeypatch.setattr(sinks, "LEAVES", 3)
    parts = sinks.pmtiles_parts(tiles(spark, 200), {}, leaf=4).collect()
    assert sum(r.kind == -2 for r in parts) <= 3 and sum(r.kind == -1 for r in parts) == 200
    monkeypatch.setattr(sinks, "LEAVES", 2000)
    monkeypatch.setattr(sinks, "ROOT_BYTES", 45)
    assert sum(r.kind == -2 for r in sinks.pmtiles_parts(tiles(spark, 200), {}, leaf=1).collect()) < 100
    empty = sinks.pmtiles_parts(tiles(spark, 0), {}).collect()
    assert [len(r.content) for r in empty if (r.kind, r["sub"]) == (-3, 0)] == [127]


def test_png_of_all_filters_and_hilbert_back(spark):
    rnd = np.random.default_rng(0)
    image = rnd.integers(0, 256, (7, 5, 4), np.uint8)
    lines, above = b"", np.zeros(20, int)
    for i, line in enumerate(image.reshape(7, 20).astype(int)):
        left, corner = np.r_[np.zeros(4, int), line[:-4]], np.r_[np.zeros(4, int), above[:-4]]
        paeth = [min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2] for a, b, c in zip(left, above, corner)]
        guess = (0, left, above, (left + above) // 2, np.array(paeth))[i % 5]
        lines += bytes([i % 5]) + ((line - guess) % 256).astype(np.uint8).tobytes()
        above = line
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 5, 7, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")
    assert (files.png_rows(png) == image).all() and (files.png_rows(sinks.png_bytes(image)) == image).all()
    df = spark.range(3000).select((F.col("id") % 12).alias("z"), F.col("id").alias("k")).select("z", F.expr("k * 7919 % shiftleft(1L, cast(z as int))").alias("x"), F.expr("k * 104729 % shiftleft(1L, cast(z as int))").alias("y"))
    rows = df.select("*", sinks.hilbert_id("z", "x", "y").alias("h")).collect()
    z, x, y = files.hilbert_tile(np.array([r.h for r in rows]))
    assert [(r.z, r.x, r.y) for r in rows] == list(zip(z.tolist(), x.tolist(), y.tolist()))


def test_stream_upserts(spark, tmp_path):
    land, target = str(tmp_path / "land"), str(tmp_path / "target")
    schema = "z int, tx int, ty int, seq int, v string"
    for i, rows in enumerate(([(1, 0, 0, 1, "a"), (1, 0, 1, 1, "b")], [(1, 0, 0, 2, "c"), (1, 0, 0, 3, "d")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        streams.upsert_tiles(streams.landing(spark, land, schema), target, str(tmp_path / "cp")).awaitTermination()
        del i
    assert sorted((r.ty, r.v) for r in streams.current(spark, target).collect()) == [(0, "d"), (1, "b")]
