"""Files put together from parts that are made in many tasks: tiled GeoTIFFs with reduced images, and whatever else is a sequence of bytes.

A part is a row (path, kind, level, by, bx, content); a file's parts follow each other in the order of these numbers. What stands before
a part is known from sums of lengths, taken by rows of tiles first, so that no window sees all tiles; no byte passes through the driver."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.staging import staged
from .tiff import BANDS, BITS, DEFLATE, FORMAT, HEIGHT, KIND, NODATA, PACKING, PLANAR, SCALE, TIE, TILE_BYTES, TILE_HEIGHT, TILE_WIDTH, TILES, WIDTH

PART = "path string, kind int, level int, by int, bx int, content binary"
ORDER = ["kind", "level", "by", "bx"]


def write_files(parts: DataFrame, folder: str) -> DataFrame:
    """Writes each path's parts to one file of ``folder``, or of folders in it, and gives (path, bytes). A task streams a file's parts, one held at a time, to a place beside
    the file's and moves it when whole, so a task that runs again or twice leaves the same file. A file is a sequence of
    bytes and so one task's; files are written side by side."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        path, out, size = None, None, 0

        def closed() -> pa.RecordBatch:
            out.close()
            fs.move(beside, f"{base}/{path}")
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64())], names=["path", "bytes"])

        for batch in batches:
            for at, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                if at != path:
                    if out:
                        yield closed()
                    path, size = at, 0
                    inside, _, name = at.rpartition("/")
                    if inside:
                        fs.create_dir(f"{base}/{inside}", recursive=True)
                    beside = "/".join(x for x in (base, inside, f".{name}.{uuid.uuid4().hex}") if x)
                    out = fs.open_output_stream(beside)
                size += out.write(content.as_buffer())
        if out:
            yield closed()

    rows = parts.select("path", *(c for c in ORDER if c in parts.columns), "content")
    return staged(rows.repartition("path").sortWithinPartitions("path", *(c for c in ORDER if c in parts.columns)).select("path", "content").mapInArrow(run, "path string, bytes long"), "written")


def reduced(blocks: DataFrame, side: int, bands: int) -> DataFrame:
    """Blocks (path, by, bx, height, width, data) of the image of half the size: means of what is there of four cells; a group is four blocks."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = np.full((2 * side, 2 * side, bands), np.nan)
        high = wide = 0
        for by, bx, h, w, data in zip(*(pdf[c] for c in ("by", "bx", "height", "width", "data")), strict=True):
            top, left = by % 2 * side, bx % 2 * side
            whole[top : top + h, left : left + w] = np.frombuffer(data, "<f8").reshape(h, w, bands)
            high, wide = max(high, top + h), max(wide, left + w)
        four = whole.reshape(side, 2, side, 2, bands)
        there = ~np.isnan(four)
        n = there.sum((1, 3))
        mean = np.where(n > 0, np.where(there, four, 0).sum((1, 3)) / np.maximum(n, 1), np.nan)[: -(-high // 2), : -(-wide // 2)]
        first = pdf.iloc[0]
        return pd.DataFrame({"path": [first["path"]], "by": [first["by"] // 2], "bx": [first["bx"] // 2], "height": [mean.shape[0]], "width": [mean.shape[1]], "data": [mean.astype("<f8").tobytes()]})

    return blocks.groupBy("path", F.floor(F.col("by") / 2), F.floor(F.col("bx") / 2)).applyInPandas(run, "path string, by int, bx int, height int, width int, data binary")


def tiled_geotiffs(blocks: DataFrame, side: int, bands: int = 1, levels: int = 1, sample: str = "f4", epsg: int = 3857, nodata: float | None = None) -> DataFrame:
    """The parts of tiled, deflated BigTIFFs: blocks (path, by, bx, height, width, data; x0, y0, px, the raster's corner and pixel) of ``side`` x ``side``
    cells, and ``levels`` images, each half the size of the one before. Tiles are packed in many tasks; tiles that are missing are left out of the file."""
    own = ["path", "by", "bx", "height", "width", "data"]
    blocks = staged(blocks, "blocks")  # they are read for each image and for the corners
    image = blocks.select(*own)
    chain = [image.withColumn("level", F.lit(0))]
    for level in range(1, levels):
        image = staged(reduced(image, side, bands), "reduced")
        chain.append(image.withColumn("level", F.lit(level)))
    all_ = chain[0]
    for x in chain[1:]:
        all_ = all_.unionByName(x)
    kind = np.dtype(f"<{sample}")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = []
            for h, w, data in zip(batch.column("height").to_pylist(), batch.column("width").to_pylist(), batch.column("data"), strict=True):
                whole = np.full((side, side, bands), np.nan)
                whole[:h, :w] = np.frombuffer(data.as_buffer(), "<f8").reshape(h, w, bands)
                if kind.kind != "f" or nodata is not None:
                    whole = np.nan_to_num(whole, nan=nodata or 0)
                whole = np.rint(whole) if kind.kind != "f" else whole
                content.append(zlib.compress(whole.astype(kind).tobytes(), 6))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("path", "level", "by", "bx", "height", "width")), pa.array(content, pa.binary()), pa.array([len(c) for c in content], pa.int64())], names=["path", "level", "by", "bx", "height", "width", "content", "length"])

    packed = staged(all_.select("path", "level", "by", "bx", "height", "width", "data").mapInArrow(pack, "path string, level int, by int, bx int, height int, width int, content binary, length long"), "tiles")
    # Where a tile lies: what the rows of tiles before its row hold, and what stands before it in its row.
    rows = packed.groupBy("path", "level", "by").agg(F.sum("length").alias("bytes"))
    before = lambda keys, order: Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.withColumn("start", 16 + F.coalesce(F.sum("bytes").over(before(["path"], ["level", "by"])), F.lit(0))).drop("bytes")
    within = F.coalesce(F.sum("length").over(before(["path", "level", "by"], ["bx"])), F.lit(0))
    placed = packed.select("path", "level", "by", "bx", "length").join(starts, ["path", "level", "by"]).withColumn("at", F.col("start") + within)
    # A file's images: their shapes, and the tiles' bytes.
    size = packed.where("level = 0").groupBy("path").agg(F.max(F.col("by") * side + F.col("height")).alias("h"), F.max(F.col("bx") * side + F.col("width")).alias("w"))
    total = packed.groupBy("path").agg(F.sum("length").alias("bytes"))
    lone = placed.groupBy("path", "level").agg(F.min(F.struct("by", "bx", "at", "length")).alias("t")).groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("level", F.struct("t.at", "t.length")))).alias("lone"))
    corner = blocks.groupBy("path").agg(F.first("x0").alias("x0"), F.first("y0").alias("y0"), F.first("px").alias("px"))
    files = staged(size.join(total, "path").join(lone, "path").join(corner, "path"), "files")
    shapes = files.select("path", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), lambda k: F.struct(*(F.ceil(F.col(c) / F.pow(F.lit(2.0), k) / side).cast("int").alias(n) for c, n in (("h", "down"), ("w", "across")))))).alias("level", "n"))
    every = shapes.select("path", "level", "n.across", F.explode(F.sequence(F.lit(0), F.col("n.down") - 1)).alias("by"))
    held = placed.groupBy("path", "level", "by").agg(F.collect_list("bx").alias("bx"), F.collect_list("at").alias("at"), F.collect_list("length").alias("length"))

    def tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path, level, by, across, bx, at, length in zip(*(b[c] for c in ("path", "level", "by", "across", "bx", "at", "length")), strict=True):
                for k, v in ((2, at), (3, length)):
                    table = np.zeros(across, "<u8")
                    if bx is not None:
                        table[bx] = v
                    out.append((path, k, level, by, 0, table.tobytes()))
            yield pd.DataFrame(out, columns=["path", "kind", "level", "by", "bx", "content"])

    entries = every.join(held, ["path", "level", "by"], "left").mapInPandas(tables, PART)

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path, h, w, bytes_, lone, x0, y0, px in zip(*(b[c] for c in ("path", "h", "w", "bytes", "lone", "x0", "y0", "px")), strict=True):
                first, content = directories(int(h), int(w), int(bytes_), {k: (v["at"], v["length"]) for k, v in lone.items()}, side, bands, levels, kind, (x0, y0, px), epsg, nodata)
                out += [(path, 0, 0, 0, 0, b"II" + struct.pack("<HHHQ", 43, 8, 0, first)), (path, 4, 0, 0, 0, content)]
            yield pd.DataFrame(out, columns=["path", "kind", "level", "by", "bx", "content"])

    tiles = packed.select("path", F.lit(1).alias("kind"), "level", "by", "bx", "content")
    return tiles.unionByName(entries).unionByName(files.mapInPandas(heads, PART))


def directories(height: int, width: int, tiles: int, lone: dict[int, tuple[int, int]], side: int, bands: int, levels: int, kind: np.dtype, place: tuple[float, float, float], epsg: int, nodata: float | None) -> tuple[int, bytes]:
    """Where the first directory lies and the bytes of all: they come last, behind the tiles and the tables of the tiles' places and lengths."""
    shape = [(-(-height // 2**k), -(-width // 2**k)) for k in range(levels)]
    counts = [-(-h // side) * -(-w // side) for h, w in shape]
    at = first = 16 + tiles + 16 * sum(counts)
    out = b""
    for level, ((h, w), n) in enumerate(zip(shape, counts, strict=True)):
        table = 16 + tiles + 8 * sum(counts[:level])
        sizes = table + 8 * sum(counts)
        keys = [1, 1, 0, 3, 1024, 0, 1, 2 if epsg == 4326 else 1, 1025, 0, 1, 1, 2048 if epsg == 4326 else 3072, 0, 1, epsg]
        tags = [
            (KIND, "I", [int(level > 0)]), (WIDTH, "I", [w]), (HEIGHT, "I", [h]), (BITS, "H", [kind.itemsize * 8] * bands), (PACKING, "H", [DEFLATE]), (262, "H", [2 if bands >= 3 else 1]), (BANDS, "H", [bands]), (PLANAR, "H", [1]),
            (TILE_WIDTH, "I", [side]), (TILE_HEIGHT, "I", [side]), (TILES, "Q", table), (TILE_BYTES, "Q", sizes),
            *([(338, "H", [2])] if bands == 4 else []), (FORMAT, "H", [{"u": 1, "i": 2, "f": 3}[kind.kind]] * bands),
            *([(SCALE, "d", [place[2], place[2], 0.0]), (TIE, "d", [0.0, 0.0, 0.0, place[0], place[1], 0.0]), (34735, "H", keys)] if not level else []),
            *([(NODATA, "c", [bytes([c]) for c in f"{nodata:g}".encode() + b"\0"])] if nodata is not None and not level else []),
        ]
        code = {"c": 2, "H": 3, "I": 4, "d": 12, "Q": 16}
        extra, entries = b"", b""
        behind = at + 8 + 20 * len(tags) + 8
        for tag, c, v in tags:
            if isinstance(v, int):  # a table; of one entry it is the entry itself
                raw = struct.pack("<Q", v if n > 1 else lone.get(level, (0, 0))[tag == TILE_BYTES])
                entries += struct.pack("<HHQ", tag, code[c], n) + raw
                continue
            raw = struct.pack(f"<{len(v)}{c}", *v)
            if len(raw) > 8:
                entries += struct.pack("<HHQQ", tag, code[c], len(v), behind + len(extra))
                extra += raw + b"\0" * (-len(raw) % 8)
            else:
                entries += struct.pack("<HHQ", tag, code[c], len(v)) + raw.ljust(8, b"\0")
        end = behind + len(extra)
        out += struct.pack("<Q", len(tags)) + entries + struct.pack("<Q", end if level + 1 < levels else 0) + extra
        at = end
    return first, out
