"""Rasters read block by block: a header, the tables' entries that are wanted, and the byte ranges of these blocks, nothing else.

Files are opened in the tasks by Arrow's file systems (local, HDFS, object stores). A block is one row: where it lies, and ``data``, its
values as little-endian doubles, row by row, the bands of a cell together; no data is NaN. ``GeoTiffBlocks`` is a data source for ``spark.read``;
``windows`` reads the windows of a table, each block once however many windows want it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from . import tiff

PLACE = "path string, level int, by int, bx int, height int, width int, x0 double, y0 double, px double, py double, bands int"
BLOCKS = f"{PLACE}, data binary"
IMAGES = "path string, level int, width int, height int, bh int, bw int, bands int, px double, py double, minx double, miny double, maxx double, maxy double"
COMPARE = {EqualTo: "__eq__", GreaterThan: "__gt__", GreaterThanOrEqual: "__ge__", LessThan: "__lt__", LessThanOrEqual: "__le__"}


def opened(path: str) -> tuple[tiff.Read, pa.NativeFile]:
    fs, where = pafs.FileSystem.from_uri(path)
    file = fs.open_input_file(where)
    return (lambda at, n: file.read_at(n, at)), file


def place(path: str, level: int, image: tiff.Image, by: int, bx: int) -> tuple:
    """A block's columns but its data; all of them are known before it is read."""
    (h, w), (x0, y0) = image.block, tiff.corner(image, by, bx)
    return path, level, by, bx, min(h, image.height - by * h), min(w, image.width - bx * w), x0, y0, *image.scale, image.bands


def values(data: np.ndarray, image: tiff.Image) -> bytes:
    data = data.astype("<f8")
    if image.nodata is not None:
        data[data == image.nodata] = np.nan
    return data.tobytes()


@dataclass
class Part(InputPartition):
    """The k-th of n ranges of a file's rows of blocks."""

    path: str
    k: int
    n: int


class GeoTiffBlocks(DataSource):
    """``spark.read.format("geotiff_blocks")``, once ``spark.dataSource.register(GeoTiffBlocks)`` is done.

    Options: ``path``, a file or a folder; ``bounds`` (minx,miny,maxx,maxy), of which the blocks that meet them are read; ``pixel``, the size wanted: the
    coarsest image of the chain that is as fine; ``part``, the bytes of a file for each task; ``filters``, true where Spark pushes filters down to Python
    sources (spark.sql.python.filterPushdown.enabled): comparisons of the columns but ``data`` are then settled before a block is read."""

    @classmethod
    def name(cls) -> str:
        return "geotiff_blocks"

    def schema(self) -> str:
        return BLOCKS

    def reader(self, schema) -> DataSourceReader:
        return (FilteredReader if self.options.get("filters") == "true" else BlockReader)(self.options)


class BlockReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.part = options["path"], int(options.get("part", 64 << 20))
        self.bounds = tuple(float(x) for x in options["bounds"].split(",")) if "bounds" in options else None
        self.pixel = float(options["pixel"]) if "pixel" in options else None
        self.filters: list[tuple[int, str, object]] = []

    def partitions(self) -> list[Part]:
        """From the listing alone; headers are read by the tasks."""
        fs, where = pafs.FileSystem.from_uri(self.path)
        info = fs.get_file_info(where)
        files = [info] if info.is_file else [x for x in fs.get_file_info(pafs.FileSelector(where, recursive=True)) if x.is_file and x.base_name.lower().endswith((".tif", ".tiff"))]
        prefix = self.path[: self.path.index(where)] if where in self.path else ""
        return [Part(prefix + x.path, k, n) for x in sorted(files, key=lambda x: x.path) for n in [max(1, -(-(x.size or 0) // self.part))] for k in range(n)]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        read, file = opened(part.path)
        with file:
            found = tiff.images(read)
            level = tiff.level_for(found, self.pixel)
            image = found[level]
            span = tiff.within(image, self.bounds) if self.bounds else (0, image.down - 1, 0, image.across - 1)
            if not span:
                return
            for by in range(max(span[0], part.k * image.down // part.n), min(span[1] + 1, (part.k + 1) * image.down // part.n)):
                wanted = [bx for bx in range(span[2], span[3] + 1) if (at := place(part.path, level, image, by, bx)) and all(getattr(at[i], op)(v) is True for i, op, v in self.filters)]
                for a, b in _runs(wanted):
                    for _, bx, data in tiff.blocks(read, image, range(by, by + 1), (a, b)):
                        yield _batch([(*place(part.path, level, image, by, bx), values(data, image))])


class FilteredReader(BlockReader):
    """Takes the comparisons that Spark pushes down; Spark refuses such a reader while it pushes none."""

    def pushFilters(self, filters: list[Filter]):
        names = [x.split()[0] for x in PLACE.split(", ")]
        for f in filters:
            if type(f) in COMPARE and f.attribute[0] in names and len(f.attribute) == 1:
                self.filters.append((names.index(f.attribute[0]), COMPARE[type(f)], f.value))
            else:
                yield f


def _runs(numbers: list[int]) -> list[tuple[int, int]]:
    """Sorted numbers as runs (first, last)."""
    cuts = [i for i, (a, b) in enumerate(zip(numbers, numbers[1:], strict=False), 1) if b != a + 1]
    return [(numbers[a], numbers[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(numbers)], strict=True)] if numbers else []


KINDS = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}


def _batch(rows: list[tuple], shape: str = BLOCKS) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in shape.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))


def images(files: DataFrame) -> DataFrame:
    """(path, level, width, height, bh, bw, bands, px, py, minx, miny, maxx, maxy) of the images of files (path); only headers are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                read, file = opened(path)
                with file:
                    found = tiff.images(read)
                yield _batch([(path, i, m.width, m.height, *m.block, m.bands, *m.scale, m.corner[0], m.corner[1] - m.height * m.scale[1], m.corner[0] + m.width * m.scale[0], m.corner[1]) for i, m in enumerate(found)], IMAGES)

    return files.select("path").mapInArrow(run, IMAGES)


def fetch(wanted: DataFrame) -> DataFrame:
    """The blocks (path, level, by, bx) that are ``wanted``, each once, by their byte ranges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, read, file, found = None, None, None, []
        try:
            for batch in batches:
                for at, level, by, bx in zip(*(batch.column(c).to_pylist() for c in ("path", "level", "by", "bx")), strict=True):
                    if at != path:
                        if file:
                            file.close()
                        path, (read, file) = at, opened(at)
                        found = tiff.images(read)
                    for _, _, data in tiff.blocks(read, found[level], range(by, by + 1), (bx, bx)):
                        yield _batch([(*place(path, level, found[level], by, bx), values(data, found[level]))])
        finally:
            if file:
                file.close()

    # Neighbours of a file go to one task, a few rows of blocks to each.
    dealt = wanted.select("path", "level", "by", "bx").distinct().repartition("path", "level", F.floor(F.col("by") / 16)).sortWithinPartitions("path", "level", "by", "bx")
    return dealt.mapInArrow(run, BLOCKS)


def windows(found: DataFrame, asked: DataFrame, cell: float) -> tuple[DataFrame, DataFrame]:
    """Which blocks each window needs, and how they are cut: (window, path, level, by, bx, r0, r1, c0, c1, ...).

    found: ``images``. asked: (window, minx, miny, maxx, maxy, pixel): bounds, and the pixel size wanted. Images and windows meet by the cells of a grid of
    size ``cell``; a window takes the coarsest image of a file that is as fine as asked for, or the full one. Its pixels are those that its
    bounds touch, r0 to r1 and c0 to c1 (the last left out) of the image, never outside. Gives (needs, blocks): the second has the data."""
    spread = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell)))
    on = lambda df: df.withColumn("cx", spread("minx", "maxx")).withColumn("cy", spread("miny", "maxy"))
    full = found.where("level = 0").select("path", "minx", "miny", "maxx", "maxy")
    boxes = asked.select("window", *(F.col(c).alias(f"w_{c}") for c in ("minx", "miny", "maxx", "maxy")), "pixel")
    met = on(full).join(on(asked).select("window", "cx", "cy"), ["cx", "cy"]).select("path", "window").distinct().join(boxes, "window").join(found, "path")
    overlap = met.where("w_minx < maxx and w_maxx > minx and w_miny < maxy and w_maxy > miny and w_minx < w_maxx and w_miny < w_maxy")
    fits = F.col("px") <= F.col("pixel") * (1 + 1e-9)
    chosen = overlap.groupBy("window", "path").agg(F.max_by(F.struct(*(c for c in found.columns if c != "path"), *(f"w_{c}" for c in ("minx", "miny", "maxx", "maxy"))), F.when(fits, F.col("px")).otherwise(-F.col("px"))).alias("i")).select("window", "path", "i.*")
    span = lambda low, high, size: (F.greatest(F.floor(low), F.lit(0)).cast("int"), F.least(F.ceil(high), F.col(size)).cast("int"))
    (r0, r1), (c0, c1) = span((F.col("maxy") - F.col("w_maxy")) / F.col("py"), (F.col("maxy") - F.col("w_miny")) / F.col("py"), "height"), span((F.col("w_minx") - F.col("minx")) / F.col("px"), (F.col("w_maxx") - F.col("minx")) / F.col("px"), "width")
    cut = chosen.select("window", "path", "level", r0.alias("r0"), r1.alias("r1"), c0.alias("c0"), c1.alias("c1"), "bh", "bw")
    steps = lambda a, b, size: F.explode(F.sequence(F.floor(F.col(a) / F.col(size)).cast("int"), F.floor((F.col(b) - 1) / F.col(size)).cast("int")))
    needs = cut.withColumn("by", steps("r0", "r1", "bh")).withColumn("bx", steps("c0", "c1", "bw"))
    return needs, fetch(needs)


def window_cells(needs: DataFrame, blocks: DataFrame, names: list[str]) -> DataFrame:
    """(window, path, level, row, col, names): the cells of the windows, one column a band; row and col are the image's."""
    shape = f"window long, path string, level int, row int, col int, {', '.join(f'{n} double' for n in names)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                data = np.frombuffer(r["data"], "<f8").reshape(r["height"], r["width"], r["bands"])
                top, left = r["by"] * r["bh"], r["bx"] * r["bw"]
                a, b = max(r["r0"] - top, 0), max(r["c0"] - left, 0)
                own = data[a : r["r1"] - top, b : r["c1"] - left]
                row, col = np.divmod(np.arange(own.shape[0] * own.shape[1]), own.shape[1])
                bands = own.reshape(-1, own.shape[2]).T
                same = lambda v, kind: pa.array([v] * len(row), kind)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [same(r["window"], pa.int64()), same(r["path"], pa.string()), same(r["level"], pa.int32()), pa.array(row + top + a, pa.int32()), pa.array(col + left + b, pa.int32()), *(pa.array(v, pa.float64(), mask=np.isnan(v)) for v in bands[: len(names)])],
                    names=[x.split()[0] for x in shape.split(", ")],
                )

    rows = needs.join(blocks, ["path", "level", "by", "bx"]).select(F.col("window").cast("long"), "path", "level", "by", "bx", "r0", "r1", "c0", "c1", "bh", "bw", "height", "width", "bands", "data")
    return rows.mapInArrow(run, shape)


def scan(spark: SparkSession, path: str, bounds: tuple[float, float, float, float] | None = None, pixel: float | None = None, part: int = 64 << 20) -> DataFrame:
    """The blocks of rasters by the data source."""
    spark.dataSource.register(GeoTiffBlocks)
    pushes = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false").lower()
    reader = spark.read.format("geotiff_blocks").option("path", path).option("part", part).option("filters", pushes)
    reader = reader.option("bounds", ",".join(map(repr, bounds))) if bounds else reader
    return (reader.option("pixel", repr(float(pixel))) if pixel else reader).load()
