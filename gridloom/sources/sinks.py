"""Tiles and rasters as bytes: PNG, GeoTIFF, MBTiles and PMTiles.

Each encoder works on a bounded group (one tile, one block of a raster, one chunk of a tile store) and gives rows with the
bytes, which any Spark sink takes. A single archive file is by nature a sequence of bytes: its parts are
made in Spark, and ``save_parts`` streams them in order, one at a time."""

from __future__ import annotations

import gzip
import io
import json
import sqlite3
import struct
import zipfile
import zlib
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.staging import per_group, staged
from ..operators.tiles import extent


def png_bytes(pixels: np.ndarray) -> bytes:
    """A PNG of rows x columns x 3 or 4 bytes."""
    h, w, n = pixels.shape
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = np.concatenate([np.zeros((h, 1), np.uint8), pixels.reshape(h, w * n)], axis=1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {3: 2, 4: 6}[n], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def png_tiles(pixels: DataFrame, size: int) -> DataFrame:
    """(z, tx, ty, content) of pixels (z, tx, ty, row, col, r, g, b, a): no tile where none shows, no alpha where all are opaque."""
    def run(t: dict[str, np.ndarray]) -> tuple | None:
        image = np.zeros((size, size, 4), np.uint8)
        image[t["row"], t["col"]] = np.stack([t[c] for c in "rgba"], 1)
        shown = image[:, :, 3]
        return (t["z"][0], t["tx"][0], t["ty"][0], png_bytes(image[:, :, :3] if (shown == 255).all() else image)) if shown.any() else None

    ints = [F.col(c).cast("int").alias(c) for c in ("z", "tx", "ty", "row", "col", "r", "g", "b", "a")]
    return per_group(pixels.select(*ints), ["z", "tx", "ty"], run, "z int, tx int, ty int, content binary")


def geotiff_bytes(data: np.ndarray, x0: float, y0: float, pixel: float, epsg: int = 3857) -> bytes:
    """A deflated GeoTIFF of one strip: rows x columns, of one or more bands."""
    data = data[:, :, None] if data.ndim == 2 else data
    h, w, n = data.shape
    kind = {"u": 1, "i": 2, "f": 3}[data.dtype.kind]
    body = zlib.compress(np.ascontiguousarray(data.astype(data.dtype.newbyteorder("<"))).tobytes(), 6)
    keys = struct.pack("<16H", 1, 1, 0, 3, 1024, 0, 1, 2 if epsg == 4326 else 1, 1025, 0, 1, 1, 2048 if epsg == 4326 else 3072, 0, 1, epsg)
    tags = [
        (256, 4, [w]), (257, 4, [h]), (258, 3, [data.dtype.itemsize * 8] * n), (259, 3, [8]), (262, 3, [2 if n >= 3 else 1]), (273, 4, [8]), (277, 3, [n]), (278, 4, [h]), (279, 4, [len(body)]),
        (284, 3, [1]), (339, 3, [kind] * n), (33550, 12, [pixel, pixel, 0.0]), (33922, 12, [0.0, 0.0, 0.0, x0, y0, 0.0]), (34735, 3, list(struct.unpack("<16H", keys))),
    ]
    code = {3: "H", 4: "I", 12: "d"}
    at = 8 + len(body) + len(body) % 2
    extra, entries = b"", b""
    start = at + 2 + 12 * len(tags) + 4
    for tag, t, values in tags:
        raw = struct.pack(f"<{len(values)}{code[t]}", *values)
        if len(raw) > 4:
            entries += struct.pack("<HHII", tag, t, len(values), start + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
        else:
            entries += struct.pack("<HHI", tag, t, len(values)) + raw.ljust(4, b"\0")
    return b"II*\0" + struct.pack("<I", at) + body + b"\0" * (len(body) % 2) + struct.pack("<H", len(tags)) + entries + struct.pack("<I", 0) + extra


def geotiffs(cells: DataFrame, key: str, value: str, x0: str, y0: float, pixel: float, epsg: int = 3857) -> DataFrame:
    """(key, content): each raster's cells (key, row, col, value, and x0, its western edge) as a GeoTIFF in single precision; missing cells are NaN."""
    def run(t: dict[str, np.ndarray]) -> tuple:
        data = np.full((int(t["row"].max()) + 1, int(t["col"].max()) + 1), np.nan, "f4")
        data[t["row"], t["col"]] = t["value"]
        return t["key"][0], geotiff_bytes(data, float(t["x0"][0]), y0, pixel, epsg)

    rows = cells.select(F.col(key).alias("key"), "row", "col", F.col(value).cast("double").alias("value"), F.col(x0).alias("x0"))
    return per_group(rows, ["key"], run, f"`{key}` {dict(cells.dtypes)[key]}, content binary")


def zips(members: DataFrame, archive: str, name: str, content: str = "content") -> DataFrame:
    """(archive, content): members (archive, name, content) packed into zip archives, each a bounded group."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            for n, data in sorted(zip(pdf["name"], pdf["content"], strict=True)):
                z.writestr(n, data)
        return pd.DataFrame({archive: [pdf["archive"].iloc[0]], "content": [buffer.getvalue()]})

    rows = members.select(F.col(archive).alias("archive"), F.col(name).alias("name"), F.col(content).alias("content"))
    return rows.groupBy("archive").applyInPandas(run, f"`{archive}` {dict(members.dtypes)[archive]}, content binary")


def code_list(codes: DataFrame, path: str, header: Mapping[str, object]) -> None:
    """Distinct codes in order, one a line, below a comment line with the header as JSON: one small text file."""
    spark = codes.sparkSession
    head = spark.createDataFrame([(0, "# " + json.dumps(dict(header), sort_keys=True))], "part int, value string")
    rows = codes.select("code").where("code is not null").distinct().select(F.lit(1).alias("part"), F.col("code").alias("value"))
    head.unionByName(rows).orderBy("part", "value").select("value").coalesce(1).write.text(path)


def sidecar(spark: SparkSession, path: str, payload: Mapping[str, object]) -> None:
    """A mapping as a JSON file with sorted keys, by any file system that Spark knows: written beside its place and renamed when whole."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".temp_{where.getName()}")
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps(dict(payload), indent=2, sort_keys=True).encode()))
    out.close()
    fs.delete(where, False)
    if not fs.rename(beside, where):
        raise OSError(f"cannot move {beside} to {where}")


def mbtiles_bytes(rows: Sequence[tuple[int, int, int, bytes]], metadata: Mapping[str, str]) -> bytes:
    db = sqlite3.connect(":memory:")
    db.executescript("CREATE TABLE metadata (name TEXT, value TEXT); CREATE TABLE tiles (zoom_level INTEGER, tile_column INTEGER, tile_row INTEGER, tile_data BLOB); CREATE UNIQUE INDEX tile_index ON tiles (zoom_level, tile_column, tile_row);")
    db.executemany("INSERT INTO metadata VALUES (?, ?)", sorted(metadata.items()))
    db.executemany("INSERT OR REPLACE INTO tiles VALUES (?, ?, ?, ?)", rows)
    db.commit()
    out = db.serialize()
    db.close()
    return out


def mbtiles_chunks(tiles: DataFrame, metadata: Mapping[str, str], side: int = 64) -> DataFrame:
    """(chunk, content): XYZ tiles (z, tx, ty, content) as MBTiles stores of at most ``side`` x ``side`` tiles, rows counted from the south."""
    known = dict(metadata)

    def run(t: dict[str, np.ndarray]) -> tuple:
        rows = [(z, x, 2**z - 1 - y, bytes(c)) for z, x, y, c in zip(*(t[c].tolist() for c in ("z", "tx", "ty", "content")), strict=True)]
        return t["chunk"][0], mbtiles_bytes(sorted(rows), known)

    part = lambda c: F.floor(F.col(c) / side).cast("int").cast("string")
    name = F.concat_ws("-", F.col("z").cast("string"), part("tx"), part("ty"))
    return per_group(tiles.select("z", "tx", "ty", "content", name.alias("chunk")), ["chunk"], run, "chunk string, content binary")


@F.pandas_udf(T.LongType())
def hilbert_id(z: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
    """The place of a tile along the Hilbert curves of all levels."""
    z, x, y = (s.to_numpy(np.int64, copy=True) for s in (z, x, y))
    out = (4**z - 1) // 3
    side = np.left_shift(1, z) >> 1
    while side.any():
        rx, ry = ((x & side) > 0).astype(np.int64), ((y & side) > 0).astype(np.int64)
        live = side > 0
        out += np.where(live, side * side * ((3 * rx) ^ ry), 0)
        flip = live & (ry == 0)
        turn = flip & (rx == 1)
        x, y = np.where(turn, side - 1 - x, x), np.where(turn, side - 1 - y, y)
        x, y = np.where(flip, y, x), np.where(flip, x, y)
        side >>= 1
    return pd.Series(out)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def directory(entries: Sequence[tuple[int, int, int, int]]) -> bytes:
    """A PMTiles directory of entries (tile id, offset, length, run), compressed."""
    out, last = [_varint(len(entries))], 0
    for tile, *_ in entries:
        out.append(_varint(tile - last))
        last = tile
    out += [_varint(e[3]) for e in entries] + [_varint(e[2]) for e in entries]
    for i, (_, offset, _, _) in enumerate(entries):
        out.append(_varint(0 if i and offset == entries[i - 1][1] + entries[i - 1][2] else offset + 1))
    return gzip.compress(b"".join(out), mtime=0)


#: The header and the root directory of a PMTiles archive lie within its first 16,384 bytes.
ROOT_BYTES, LEAVES = 16_384 - 127, 2000


def pmtiles_parts(tiles: DataFrame, metadata: Mapping[str, object], tile_type: int = 2, leaf: int = 4096) -> DataFrame:
    """(kind, sub, content): the bytes of a PMTiles archive, version 3, in order of kind and sub: header, directories, metadata, then tiles by Hilbert id.

    tiles: (z, tx, ty, content). A leaf directory holds a range of ``leaf`` ids; the range is doubled until at most ``LEAVES`` are left and the
    root fits its place. Leaves are made in tasks; the driver sees a size for each, so a bounded number."""
    spark = tiles.sparkSession
    known = staged(tiles.select(hilbert_id("z", "tx", "ty").alias("id"), "z", "tx", "ty", "content").withColumn("length", F.octet_length("content")), "tiles")
    total = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.min("z").alias("low"), F.max("z").alias("high"), F.min("id").alias("first"), F.max("id").alias("last")).first()
    while total.n and total.last // leaf - total.first // leaf >= LEAVES and known.select(F.floor(F.col("id") / leaf)).distinct().limit(LEAVES + 1).count() > LEAVES:
        leaf *= 2

    def leaves(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(zip(pdf["id"].tolist(), pdf["offset"].tolist(), pdf["length"].tolist(), strict=True))
        return pd.DataFrame({"leaf": [pdf["leaf"].iloc[0]], "content": [directory([(*r, 1) for r in rows])]})

    while True:
        cut = known.withColumn("leaf", F.col("id") - F.col("id") % leaf)
        sums = sorted((r.leaf, r.bytes) for r in cut.groupBy("leaf").agg(F.sum("length").alias("bytes")).collect())
        starts = spark.createDataFrame([(i, at) for (i, _), at in zip(sums, np.cumsum([0, *(n for _, n in sums)]).tolist(), strict=False)], "leaf long, start long")
        within = Window.partitionBy("leaf").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
        placed = cut.join(F.broadcast(starts), "leaf").withColumn("offset", F.col("start") + F.coalesce(F.sum("length").over(within), F.lit(0)))
        dirs = staged(placed.select("leaf", "id", "offset", "length").groupBy("leaf").applyInPandas(leaves, "leaf long, content binary"), "leaves")
        sizes = sorted((r.leaf, r.n) for r in dirs.select("leaf", F.octet_length("content").alias("n")).collect())
        ends = np.cumsum([0, *(n for _, n in sizes)]).tolist()
        root = directory([(leaf_id, at, n, 0) for (leaf_id, n), at in zip(sizes, ends, strict=False)])
        if len(root) <= ROOT_BYTES:
            break
        leaf *= 2
    meta = gzip.compress(json.dumps(dict(metadata), sort_keys=True).encode(), mtime=0)
    e = extent(known).first() if total.n else None
    head = _header(len(root), len(meta), ends[-1], total.bytes, (total.n, total.n, total.n), tile_type, (total.low or 0, total.high or 0), e)
    first = spark.createDataFrame([(-3, 0, head), (-3, 1, root), (-3, 2, meta)], "kind long, sub long, content binary")
    parts = first.unionByName(dirs.select(F.lit(-2).cast("long").alias("kind"), F.col("leaf").alias("sub"), "content")).unionByName(placed.select(F.lit(-1).cast("long").alias("kind"), F.col("id").alias("sub"), "content"))
    return parts.orderBy("kind", "sub")


def shared_pmtiles(tiles: DataFrame, metadata: Mapping[str, object], tile_type: int = 2, leaf: int = 4096) -> DataFrame:
    """(kind, sub, content) as ``pmtiles_parts`` gives, but equal contents are stored once, and neighbours of equal content are one entry with a run length.

    Tiles become runs within each leaf's range of ids before anything is joined, so a content that most tiles have is a few rows by then, and no
    window sees more than a leaf. Contents lie in the order of the first tile that has them."""
    spark = tiles.sparkSession
    known = tiles.select(hilbert_id("z", "tx", "ty").alias("id"), "z", "tx", "ty", "content", F.sha2("content", 256).alias("hash"))
    light = staged(known.select("id", "z", "tx", "ty", "hash"), "ids")
    contents = known.groupBy("hash").agg(F.min("id").alias("first"), F.first("content").alias("content")).withColumn("length", F.octet_length("content").cast("long"))
    contents = staged(contents, "contents")
    total = light.agg(F.count("*").alias("n"), F.min("z").alias("low"), F.max("z").alias("high"), F.min("id").alias("first"), F.max("id").alias("last")).first()
    while total.n and total.last // leaf - total.first // leaf >= LEAVES and light.select(F.floor(F.col("id") / leaf)).distinct().limit(LEAVES + 1).count() > LEAVES:
        leaf *= 2

    def leaves(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(zip(*(pdf[c].tolist() for c in ("id", "offset", "length", "run")), strict=True))
        return pd.DataFrame({"leaf": [pdf["leaf"].iloc[0]], "content": [directory(rows)]})

    while True:
        at = contents.select("hash", "first", "length", (F.col("first") - F.col("first") % leaf).alias("leaf"))
        sums = sorted((r.leaf, r.bytes) for r in at.groupBy("leaf").agg(F.sum("length").alias("bytes")).collect())
        starts = spark.createDataFrame([(i, x) for (i, _), x in zip(sums, np.cumsum([0, *(n for _, n in sums)]).tolist(), strict=False)], "leaf long, start long")
        before = Window.partitionBy("leaf").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
        placed = at.join(F.broadcast(starts), "leaf").select("hash", "length", (F.col("start") + F.coalesce(F.sum("length").over(before), F.lit(0))).alias("offset"))
        own = Window.partitionBy("leaf").orderBy("id")
        fresh = F.coalesce(((F.lag("id").over(own) != F.col("id") - 1) | (F.lag("hash").over(own) != F.col("hash"))).cast("int"), F.lit(1))
        cut = light.withColumn("leaf", F.col("id") - F.col("id") % leaf).withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(own))
        runs = staged(cut.groupBy("leaf", "island").agg(F.min("id").alias("id"), F.count("*").alias("run"), F.first("hash").alias("hash")), "runs")
        dirs = staged(runs.join(placed, "hash").select("leaf", "id", "offset", "length", "run").groupBy("leaf").applyInPandas(leaves, "leaf long, content binary"), "leaves")
        sizes = sorted((r.leaf, r.n) for r in dirs.select("leaf", F.octet_length("content").alias("n")).collect())
        ends = np.cumsum([0, *(n for _, n in sizes)]).tolist()
        root = directory([(leaf_id, x, n, 0) for (leaf_id, n), x in zip(sizes, ends, strict=False)])
        if len(root) <= ROOT_BYTES:
            break
        leaf *= 2
    sums = contents.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count("*").alias("n")).first()
    e = extent(light).first() if total.n else None
    meta = gzip.compress(json.dumps(dict(metadata), sort_keys=True).encode(), mtime=0)
    head = _header(len(root), len(meta), ends[-1], sums.bytes, (total.n, runs.count(), sums.n), tile_type, (total.low or 0, total.high or 0), e)
    first = spark.createDataFrame([(-3, 0, head), (-3, 1, root), (-3, 2, meta)], "kind long, sub long, content binary")
    return first.unionByName(dirs.select(F.lit(-2).cast("long").alias("kind"), F.col("leaf").alias("sub"), "content")).unionByName(contents.select(F.lit(-1).cast("long").alias("kind"), F.col("first").alias("sub"), "content"))


def _header(root: int, meta: int, leaves: int, data: int, counts: tuple[int, int, int], tile_type: int, zooms: tuple[int, int], e) -> bytes:
    """The header of an archive: root, metadata, leaves and data follow it in this order. counts: tiles, entries, contents."""
    spots = np.cumsum([127, root, meta, leaves]).tolist()
    whole = lambda *degrees: struct.pack(f"<{len(degrees)}i", *(round(d * 1e7) for d in degrees))
    head = b"PMTiles\x03" + struct.pack("<11Q", 127, root, spots[1], meta, spots[2], leaves, spots[3], data, *counts)
    head += struct.pack("<6B", 1, 2, 1, tile_type, *zooms)
    return head + ((whole(e.west, e.south, e.east, e.north) + struct.pack("<B", zooms[1]) + whole(e.center_lon, e.center_lat)) if e else bytes(25))


def save_parts(parts: DataFrame, path: str) -> int:
    """Streams ordered bytes to one file, a part at a time, and puts it in its place when whole; an empty file is an error."""
    import os

    staged, n = os.path.join(os.path.dirname(path), f".temp_{os.path.basename(path)}"), 0
    with open(staged, "wb") as f:
        for row in parts.select("content").toLocalIterator(prefetchPartitions=True):
            n += f.write(row.content)
    if not n:
        os.unlink(staged)
        raise ValueError("nothing to write")
    os.replace(staged, path)
    return n

