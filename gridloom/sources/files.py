"""Files that Spark has no reader for: archives, tile stores, rasters, code lists, sidecars and outlines.

All are read through Spark's binary and text readers, so any file system that Spark knows will do."""

from __future__ import annotations

import gzip
import io
import sqlite3
import struct
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from . import rasters, tiff
from .tiff import unlzw  # noqa: F401  callers know it by this module

BLOCK = "path string, bx int, by int, x0 double, y0 double, px double, width int, height int, data array<float>"


def binary(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(date_path, folder) of a store with files at year/month/day/folder/file: one listing, and no file is opened."""
    name = r"/(\d{4}/\d{2}/\d{2})/([^/]+)/[^/]+$"
    found = binary(spark, path, pattern, recursive=True).select(F.regexp_extract("path", name, 1).alias("date_path"), F.regexp_extract("path", name, 2).alias("folder"))
    return found.where("date_path != ''").distinct()


def fresh(files: DataFrame, now: Column, days: int = 90) -> DataFrame:
    """Cached files that are younger than so many days."""
    return files.where(F.col("modificationTime") >= now - F.make_dt_interval(F.lit(days)))


def zip_members(files: DataFrame, suffix: str = "") -> DataFrame:
    """(path, member, content) of archives, members in order of name."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in sorted(n for n in z.namelist() if n.endswith(suffix)):
                        yield pd.DataFrame({"path": [path], "member": [name], "content": [z.read(name)]})

    return files.select("path", "content").mapInPandas(run, "path string, member string, content binary")


def tile_tree(spark: SparkSession, path: str, suffix: str = "webp") -> DataFrame:
    """(z, x, y, content) of a tree of z/x/y files; a path of another form is an error."""
    name = rf"/(\d+)/(\d+)/(\d+)\.{suffix}$"
    part = lambda i: F.regexp_extract("path", name, i)
    files = binary(spark, path, f"*.{suffix}", recursive=True)
    checked = F.when(part(1) != "", part(1)).otherwise(F.raise_error(F.concat(F.lit("not a tile's path: "), "path")).cast("string"))
    return files.select(checked.cast("int").alias("z"), part(2).cast("int").alias("x"), part(3).cast("int").alias("y"), "content")


def mbtiles(files: DataFrame) -> DataFrame:
    """(path, zoom_level, tile_column, tile_row, tile_data) of MBTiles stores; a file that is none has no rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                db = sqlite3.connect(":memory:")
                try:
                    db.deserialize(content)
                    rows = db.execute("SELECT zoom_level, tile_column, tile_row, tile_data FROM tiles ORDER BY 1, 2, 3")
                    while part := rows.fetchmany(1000):
                        yield pd.DataFrame([(path, *r) for r in part], columns=["path", "zoom_level", "tile_column", "tile_row", "tile_data"])
                except sqlite3.DatabaseError:
                    continue
                finally:
                    db.close()

    return files.select("path", "content").mapInPandas(run, "path string, zoom_level int, tile_column int, tile_row int, tile_data binary")


def png_rows(content: bytes) -> np.ndarray:
    """Rows x columns x 3 or 4 of a PNG of 8-bit colours that is not interlaced."""
    if content[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, body = 8, b""
    while at < len(content):
        (n,) = struct.unpack_from(">I", content, at)
        kind, data = content[at + 4 : at + 8], content[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            w, h, depth, colours, _, _, interlaced = struct.unpack(">IIBBBBB", data)
        elif kind == b"IDAT":
            body += data
        at += 12 + n
    if depth != 8 or interlaced or colours not in (2, 6):
        raise ValueError("this kind of PNG is not supported")
    n = {2: 3, 6: 4}[colours]
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * n)
    out, above = np.zeros((h, w * n), np.uint8), np.zeros(w * n, np.uint8)
    for i in range(h):
        how, line = raw[i, 0], raw[i, 1:]
        if how == 0:
            above = line
        elif how == 2:
            above = line + above
        elif how == 1:
            above = np.add.accumulate(line.reshape(w, n), 0, dtype=np.uint8).reshape(-1)
        else:
            now, up = line.astype(int), above.astype(int)
            for k in range(w * n):
                a, b, c = (now[k - n] if k >= n else 0), up[k], (up[k - n] if k >= n else 0)
                p = (a + b) // 2 if how == 3 else min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
                now[k] = (now[k] + p) % 256
            above = now.astype(np.uint8)
        out[i] = above
    return out.reshape(h, w, n)


PIXELS = 1 << 16  # small images share a frame of so many


def png_pixels(tiles: DataFrame) -> DataFrame:
    """(z, tx, ty, row, col, r, g, b, a) of tiles (z, tx, ty, content) in PNG; without an alpha all are opaque."""
    names = ["z", "tx", "ty", "row", "col", *"rgba"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts, held = [], 0
            for z, x, y, content in zip(b["z"], b["tx"], b["ty"], b["content"], strict=True):
                image = png_rows(content)
                h, w, n = image.shape
                part = np.full((h * w, 9), 255, np.int32)
                part[:, 0], part[:, 1], part[:, 2] = z, x, y
                part[:, 3], part[:, 4] = np.divmod(np.arange(h * w), w)
                part[:, 5 : 5 + n] = image.reshape(-1, n)
                parts.append(part)
                held += h * w
                if held >= PIXELS:
                    yield pd.DataFrame(np.concatenate(parts), columns=names)
                    parts, held = [], 0
            if parts:
                yield pd.DataFrame(np.concatenate(parts), columns=names)

    return tiles.select("z", "tx", "ty", "content").mapInPandas(run, "z int, tx int, ty int, row int, col int, r int, g int, b int, a int")


def hilbert_tile(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(z, x, y) of places along the Hilbert curves of all levels."""
    levels = (4 ** np.arange(32, dtype=object) - 1) // 3
    z = np.searchsorted(np.array([int(v) for v in levels if v < 1 << 62], np.int64), ids, "right") - 1
    rest = ids - np.array([int(levels[k]) for k in z], np.int64)
    x, y = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    for k in range(int(z.max(initial=0))):
        side, live = np.int64(1 << k), k < z
        rx, ry = rest // 2 & 1, (rest ^ (rest // 2)) & 1
        turn = live & (ry == 0) & (rx == 1)
        x, y = np.where(turn, side - 1 - x, x), np.where(turn, side - 1 - y, y)
        x, y = np.where(live & (ry == 0), y, x), np.where(live & (ry == 0), x, y)
        x, y = np.where(live, x + side * rx, x), np.where(live, y + side * ry, y)
        rest = np.where(live, rest // 4, rest)
    return z, x, y


def read_directory(content: bytes) -> list[tuple[int, int, int, int]]:
    """Entries (tile id, offset, length, run) of a compressed PMTiles directory."""
    data, at = gzip.decompress(content), 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    n, last = number(), 0
    ids = [last := last + number() for _ in range(n)]
    runs, lengths, offsets = [number() for _ in range(n)], [number() for _ in range(n)], []
    for i in range(n):
        v = number()
        offsets.append(v - 1 if v else offsets[-1] + lengths[i - 1])
    return list(zip(ids, offsets, lengths, runs, strict=True))


def directory_entries(leaves: DataFrame) -> DataFrame:
    """(id, z, tx, ty, offset, length, follows) of leaf directories (content); follows: whether an entry begins where the one before ends, or is the first."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                ids, offsets, lengths, _ = (np.array(x, np.int64) for x in zip(*read_directory(content), strict=True))
                z, x, y = hilbert_tile(ids)
                yield pd.DataFrame({"id": ids, "z": z, "tx": x, "ty": y, "offset": offsets, "length": lengths, "follows": np.r_[True, offsets[1:] == offsets[:-1] + lengths[:-1]]})

    return leaves.mapInPandas(run, "id long, z int, tx int, ty int, offset long, length long, follows boolean")


def pmtiles(wanted: DataFrame, path: str) -> DataFrame:
    """(z, tx, ty, content) of the tiles ``wanted`` (z, tx, ty) that an archive has, by byte ranges: the header and the root once, then for each leaf that is needed its
    directory and the contents. The root, of at most 16 KB by the format, goes to the tasks; tiles meet in tasks by their leaf."""
    read, file = rasters.opened(path)
    with file:
        head = read(0, 127)
        if head[:8] != b"PMTiles\x03":
            raise ValueError("not a PMTiles archive")
        root_at, root_size, _, _, leaves_at, _, data_at, _ = struct.unpack_from("<8Q", head, 8)
        root = read_directory(read(root_at, root_size))
    starts = np.array([e[0] for e in root], np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read, file = rasters.opened(path)
        last, entries, ids = -1, [], np.zeros(0, np.int64)
        with file:
            for b in batches:
                out = []
                for z, x, y, tile, leaf in zip(*(b[c].tolist() for c in ("z", "tx", "ty", "id", "leaf")), strict=True):
                    if leaf < 0:
                        continue
                    if leaf != last:
                        _, at, size, run_ = root[leaf]
                        entries = [root[leaf]] if run_ else read_directory(read(leaves_at + at, size))
                        ids, last = np.array([e[0] for e in entries], np.int64), leaf
                    i = int(np.searchsorted(ids, tile, "right")) - 1
                    if i >= 0 and tile < entries[i][0] + entries[i][3]:
                        out.append((z, x, y, read(data_at + entries[i][1], entries[i][2])))
                yield pd.DataFrame(out, columns=["z", "tx", "ty", "content"])

    @F.pandas_udf("int")
    def leaf_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, ids.to_numpy(np.int64), "right") - 1, dtype="int32")

    from .sinks import hilbert_id

    found = wanted.select("z", "tx", "ty", hilbert_id("z", "tx", "ty").alias("id")).withColumn("leaf", leaf_of("id"))
    return found.repartition("leaf").sortWithinPartitions("leaf", "id").mapInPandas(run, "z int, tx int, ty int, content binary")


def code_list(spark: SparkSession, path: str) -> DataFrame:
    """(code) of a text of one code a line; lines that begin with # are not codes."""
    return spark.read.text(path).select(F.trim("value").alias("code")).where("code != '' and not startswith(code, '#')").distinct()


def code_list_header(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The JSON in the first comment line of a code list, as columns; what cannot be parsed has null columns."""
    head = spark.read.text(path).where("startswith(value, '#') and contains(value, '{')").select(F.from_json(F.regexp_extract("value", r"(\{.*\})", 1), schema).alias("h"))
    return head.select("h.*")


def sidecar(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON file as one row; one that does not parse has no row."""
    return spark.read.schema(f"{schema}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(path, multiLine=True).cache().where("_bad is null").drop("_bad")


def outlines(spark: SparkSession, path: str) -> DataFrame:
    """(feature, ring) of a GeoJSON's polygons: the outer rings as arrays of (lon, lat); Web Mercator, where the file names it, becomes degrees.
    ``plans.cover.union_area`` and ``envelope`` bring them together."""
    shape = "crs struct<properties:struct<name:string>>, features array<struct<geometry:struct<type:string,coordinates:string>>>"
    f = spark.read.schema(shape).json(path, multiLine=True).select(F.col("crs.properties.name").alias("crs"), F.posexplode("features").alias("feature", "f"))
    one = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    many = F.transform(F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>"), lambda p: p[0])
    rings = F.when(F.col("f.geometry.type") == "Polygon", F.array(one[0])).when(F.col("f.geometry.type") == "MultiPolygon", many)
    degrees = lambda p: F.array(geo.longitude(p[0]), geo.latitude(p[1]))
    ring = F.when(F.col("crs").contains("3857"), F.transform("ring", degrees)).otherwise(F.col("ring"))
    return f.select("feature", "crs", F.explode(rings).alias("ring")).select("feature", ring.alias("ring"))


def polygons(spark: SparkSession, path: str) -> DataFrame:
    """(feature, part, rings) of a GeoJSON's polygons, the outer ring first and holes after it, in the file's own coordinates. ``plans.overlay`` unites them by cells."""
    f = spark.read.schema("features array<struct<geometry:struct<type:string,coordinates:string>>>").json(path, multiLine=True).select(F.posexplode("features").alias("feature", "f"))
    one = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    many = F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>")
    found = F.when(F.col("f.geometry.type") == "Polygon", F.array(one)).when(F.col("f.geometry.type") == "MultiPolygon", many)
    return f.select("feature", F.posexplode(found).alias("part", "rings"))


def envelope(rings: DataFrame) -> DataFrame:
    """(minx, miny, maxx, maxy) of all rings together."""
    p = rings.select(F.explode("ring").alias("p")).select(F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))
    return p.agg(F.min("x").alias("minx"), F.min("y").alias("miny"), F.max("x").alias("maxx"), F.max("y").alias("maxy"))


def read_geotiff(content: bytes) -> Iterator[tuple[int, int, float, float, float, int, int, np.ndarray]]:
    """Blocks (bx, by, x0, y0, pixel, width, height, values of the first band) of a file that is held whole; ``rasters`` reads parts of files."""
    read = lambda at, n: content[at : at + n]
    image = tiff.images(read)[0]
    for by, bx, data in tiff.blocks(read, image, range(image.down)):
        yield bx, by, *tiff.corner(image, by, bx), image.scale[0], data.shape[1], data.shape[0], data[:, :, 0].astype("f4")


def geotiff(files: DataFrame) -> DataFrame:
    """Rasters as rows of blocks."""
    names = [x.split()[0] for x in BLOCK.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts, held = [], 0
            for path, content in zip(b["path"], b["content"], strict=True):
                for *rest, data in read_geotiff(content):
                    parts.append((path, *rest, data.ravel()))
                    held += data.size
                    if held >= PIXELS:
                        yield pd.DataFrame(parts, columns=names)
                        parts, held = [], 0
            if parts:
                yield pd.DataFrame(parts, columns=names)

    return files.select("path", "content").mapInPandas(run, BLOCK)


def block_pixels(blocks: DataFrame, nodata: float | None = None) -> DataFrame:
    """(path, bx, by, x, y, value): one row a pixel, at its centre; no data as null."""
    p = blocks.select("path", "bx", "by", "x0", "y0", "px", "width", F.posexplode("data").alias("i", "v"))
    v = F.col("v").cast("double")
    x, y = F.col("x0") + (F.col("i") % F.col("width") + 0.5) * F.col("px"), F.col("y0") - (F.floor(F.col("i") / F.col("width")) + 0.5) * F.col("px")
    return p.select("path", "bx", "by", x.alias("x"), y.alias("y"), (v if nodata is None else F.when(v != nodata, v)).alias("value"))
