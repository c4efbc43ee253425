"""Rasters as arrays: one row a block, (keys, br, bc, height, width, data), data being its values as little-endian doubles, row by row.

Blocks stay where they are. A kernel needs what its neighbours hold along their rims: each block cuts strips for the up to
eight around it, only these are shuffled, and they meet their block by an equality join. ``stored`` keeps blocks as a table bucketed
by their keys, so that the join finds them dealt out already and sends the strips alone. A raster is dense: null and missing cells are NaN inside it.

Against cells in rows (``blocks.on_blocks``), which sends every cell with all its columns, and those of the rims more than once, what is sent
are 8 bytes for each value of a rim."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .focal import SQUARE, gaussian
from .staging import folder, per_group

#: Where a neighbour lies: (rows, columns) from the block.
AROUND = tuple((i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0))
STRIP = "array<struct<side:int,height:int,width:int,data:binary>>"

# kernel(padded array, (above, below, left, right) cells that were added) -> array of the block's shape
Kernel = Callable[[np.ndarray, tuple[int, int, int, int]], np.ndarray]


def from_cells(cells: DataFrame, keys: Sequence[str], values: Sequence[str], block: int = 256, name: str = "data") -> DataFrame:
    """Cells (keys, row, col, values) as blocks of the rectangle that each raster's cells reach, the values of a cell together. One shuffle of
    the cells; a task holds a batch of them and the block that is open, however many blocks it makes. Blocks without any cell come from the raster's extent."""
    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(math.nan))
    part = lambda c: F.floor(F.col(c) / block).cast("int")
    sizes = cells.groupBy(*keys).agg((F.max("row") + 1).alias("_h"), (F.max("col") + 1).alias("_w"))
    steps = lambda c: F.explode(F.sequence(F.lit(0), F.floor((F.col(c) - 1) / block).cast("int")))
    size = lambda c, k: F.least(F.lit(block), F.col(c) - F.col(k) * block).cast("int")
    kinds, names = dict(cells.dtypes), [f"_v{i}" for i in range(len(values))]
    # In pandas whole numbers beside a null would be floats, so they go as text.
    carried = [F.col(k).cast("string").alias(k) if cells.schema[k].nullable and kinds[k] in ("tinyint", "smallint", "int", "bigint") else F.col(k) for k in keys]
    own = cells.select(*carried, part("row").alias("br"), part("col").alias("bc"), (F.col("row") % block).cast("int").alias("_r"), (F.col("col") % block).cast("int").alias("_c"), *(number(v).alias(n) for v, n in zip(values, names, strict=True))).where("br >= 0 and bc >= 0")
    # A row more of each block, without values, says how large it is; so it is there without any cell too.
    every = sizes.where("_h > 0 and _w > 0").withColumn("br", steps("_h")).withColumn("bc", steps("_w"))
    every = every.select(*carried, "br", "bc", size("_h", "br").alias("_r"), size("_w", "bc").alias("_c"), *(F.lit(0.0).alias(n) for n in names))
    of = [*keys, "br", "bc"]

    def dense(t: dict[str, np.ndarray]) -> tuple | None:
        extent = np.flatnonzero(t["_extent"])
        if not len(extent):
            return None
        h, w = int(t["_r"][extent[0]]), int(t["_c"][extent[0]])
        cell = ~t["_extent"]
        data = np.full((h, w, len(values)), np.nan)
        data[t["_r"][cell], t["_c"][cell]] = np.stack([t[n][cell] for n in names], 1)
        return (*(t[k][0] for k in of), h, w, data.astype("<f8").tobytes())

    rows = own.withColumn("_extent", F.lit(False)).unionByName(every.withColumn("_extent", F.lit(True)))
    blocks = per_group(rows, of, dense, ", ".join(f"`{k}` {kind}" for k, kind in rows.select(*of).dtypes) + f", height int, width int, `{name}` binary")
    return blocks.withColumns({k: F.col(k).cast(kinds[k]) for k in keys})


def to_cells(blocks: DataFrame, keys: Sequence[str], arrays: Mapping[str, Sequence[str]], block: int) -> DataFrame:
    """Blocks as cells (keys, row, col, values), NaN as null. arrays: of each array the names of the values that a cell has in it; block: a whole block's side."""
    kinds, names = dict(blocks.dtypes), [n for v in arrays.values() for n in v]
    shape = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "row int, col int", *(f"`{n}` double" for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = zip(*(batch.column(c).to_pylist() for c in ("br", "bc", "height", "width")), strict=True)
            for i, (br, bc, h, w) in enumerate(at):
                row, col = np.divmod(np.arange(h * w), w)
                own = batch.select(list(keys)).take(pa.array(np.full(h * w, i, np.int64)))
                found = [pa.array(row + br * block, pa.int32()), pa.array(col + bc * block, pa.int32())]
                for n, inside in arrays.items():
                    v = np.frombuffer(batch.column(n)[i].as_buffer(), "<f8").reshape(h * w, len(inside))
                    found += [pa.array(x, pa.float64(), mask=np.isnan(x)) for x in v.T]
                yield pa.RecordBatch.from_arrays([*own.columns, *found], names=[*keys, "row", "col", *names])

    return blocks.select(*keys, "br", "bc", "height", "width", *arrays).mapInArrow(run, shape)


def stored(blocks: DataFrame, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``blocks`` as a table in the shared folder, in buckets by (keys, br, bc), a task each: kernels on it shuffle no block, and lineage is cut.
    The number of buckets is the session's number of shuffle partitions unless given; blocks that come from a kernel on such a table are in
    their places already. The session's catalogue knows the table until it ends."""
    spark = blocks.sparkSession
    name, n = f"blocks_{uuid.uuid4().hex}", buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks.write.format("parquet").option("path", folder(spark, "blocks")).bucketBy(n, *keys, "br", "bc").saveAsTable(name)
    return spark.table(name)


def strips(blocks: DataFrame, keys: Sequence[str], name: str, width: int) -> DataFrame:
    """What each block lends its neighbours: (keys, br, bc: the neighbour's, strips: at most eight)."""

    @F.pandas_udf("array<struct<side:int,br:int,bc:int,height:int,width:int,data:binary>>")
    def lent(data: pd.Series, h: pd.Series, w: pd.Series, br: pd.Series, bc: pd.Series) -> pd.Series:
        out = []
        for x, a, b, r, c in zip(data, h, w, br, bc, strict=True):
            own = np.frombuffer(x, "<f8").reshape(a, b)
            lends = []
            for i, j in AROUND:  # the neighbour at (i, j) gets the rim on its side, and sees this block at (-i, -j)
                rim = own[slice(0, width) if i < 0 else slice(max(0, a - width), a) if i > 0 else slice(None), slice(0, width) if j < 0 else slice(max(0, b - width), b) if j > 0 else slice(None)]
                if r + i >= 0 and c + j >= 0:
                    lends.append({"side": AROUND.index((-i, -j)), "br": r + i, "bc": c + j, "height": rim.shape[0], "width": rim.shape[1], "data": rim.tobytes()})
            out.append(lends)
        return pd.Series(out)

    each = blocks.select(*keys, F.explode(lent(name, "height", "width", "br", "bc")).alias("s")).select(*keys, "s.br", "s.bc", F.struct("s.side", "s.height", "s.width", "s.data").alias("s"))
    return each.groupBy(*keys, "br", "bc").agg(F.collect_list("s").alias("_strips"))


def padded(own: np.ndarray, lent: Sequence[dict] | None) -> tuple[np.ndarray, tuple[int, int, int, int]]:
    """A block with its neighbours' rims, NaN where a corner is missing, and how many cells were added above, below, left and right."""
    found = {AROUND[s["side"]]: np.frombuffer(s["data"], "<f8").reshape(s["height"], s["width"]) for s in (lent if lent is not None else ())}
    size = lambda side, axis: found[side].shape[axis] if side in found else 0
    add = size((-1, 0), 0), size((1, 0), 0), size((0, -1), 1), size((0, 1), 1)
    h, w = own.shape
    out = np.full((add[0] + h + add[1], add[2] + w + add[3]), np.nan)
    out[add[0] : add[0] + h, add[2] : add[2] + w] = own
    rows = {-1: (0, add[0]), 0: (add[0], h), 1: (add[0] + h, add[1])}
    cols = {-1: (0, add[2]), 0: (add[2], w), 1: (add[2] + w, add[3])}
    for (i, j), strip in found.items():
        (r, m), (c, n) = rows[i], cols[j]
        m, n = min(m, strip.shape[0]), min(n, strip.shape[1])
        out[r : r + m, c : c + n] = strip[:m, :n]
    return out, add


def on_arrays(blocks: DataFrame, keys: Sequence[str], name: str, width: int, kernel: Kernel, out: str) -> DataFrame:
    """``blocks`` with the array ``out`` that ``kernel`` makes of the array ``name`` and what lies within ``width`` cells of it; beyond the raster
    nothing is added. The blocks' sides, but for the last of a row or column, must be at least ``width``."""

    @F.pandas_udf(T.BinaryType())
    def run(data: pd.Series, h: pd.Series, w: pd.Series, lent: pd.Series) -> pd.Series:
        return pd.Series([np.ascontiguousarray(kernel(*padded(np.frombuffer(x, "<f8").reshape(a, b), s)), "<f8").tobytes() for x, a, b, s in zip(data, h, w, lent, strict=True)])

    if not width:
        none = F.lit(None).cast(STRIP)
        return blocks.withColumn(out, run(name, "height", "width", none))
    # Strips are the small side and at most eight a block: they are hashed, so that blocks need not be sorted.
    joined = blocks.join(strips(blocks, keys, name, width).hint("shuffle_hash"), [*keys, "br", "bc"], "left")
    return joined.withColumn(out, run(name, "height", "width", "_strips")).drop("_strips")


def _cut(a: np.ndarray, add: tuple[int, int, int, int]) -> np.ndarray:
    return a[add[0] : a.shape[0] - add[1], add[2] : a.shape[1] - add[3]]


def blur(blocks: DataFrame, keys: Sequence[str], name: str, sigma: float, out: str = "blurred") -> DataFrame:
    """A Gaussian blur, mirrored at the raster's edges. No data counts as 0 and stays no data."""
    weights = gaussian(sigma)
    radius = len(weights) // 2

    def kernel(a: np.ndarray, add: tuple[int, int, int, int]) -> np.ndarray:
        gap = np.isnan(a)
        now = np.where(gap, 0.0, a)
        for axis, (low, high) in enumerate((add[:2], add[2:])):
            n = now.shape[axis] - low - high
            wide = np.pad(now, [(radius - low, radius - high) if k == axis else (0, 0) for k in range(2)], mode="symmetric")
            now = sum(w * np.take(wide, range(k, k + n), axis) for k, w in enumerate(weights))
        return np.where(_cut(gap, add), np.nan, now)

    return on_arrays(blocks, keys, name, radius, kernel, out)


def _around(a: np.ndarray, add: tuple[int, int, int, int], outside: float) -> np.ndarray:
    """The block with one more cell on each side, ``outside`` beyond the raster."""
    return np.pad(a, ((1 - add[0], 1 - add[1]), (1 - add[2], 1 - add[3])), constant_values=outside)


def hillshade(blocks: DataFrame, keys: Sequence[str], name: str, z_factor: float = 5.0, pixel: float = 1.0, altitude: float = 45.0, out: str = "shade") -> DataFrame:
    """Light (1 to 255) from four sides, as ``focal.hillshade`` has it; NaN where a neighbour is missing."""
    alt = math.radians(altitude)

    def kernel(a: np.ndarray, add: tuple[int, int, int, int]) -> np.ndarray:
        z = _around(a, add, np.nan)
        h, w = z.shape[0] - 2, z.shape[1] - 2
        there = lambda i, j: z[1 + i : 1 + i + h, 1 + j : 1 + j + w]
        x, y = (sum(there(i, j) * d * (1 if e else 2) for i, j in SQUARE for d, e in [(j, i) if east else (i, j)] if (i, j) != (0, 0)) / 8 * z_factor / pixel for east in (True, False))
        steep = x * x + y * y
        total = 0.0
        for azimuth in (225.0, 270.0, 315.0, 360.0):
            b = math.radians(azimuth)
            lit = np.maximum((math.sin(alt) - math.cos(alt) * (x * math.sin(b) - y * math.cos(b))) / np.sqrt(1 + steep), 0.0)
            across = x * math.cos(b) + y * math.sin(b)
            total = total + np.where(steep > 0, across * across / np.where(steep > 0, steep, 1.0), 0.5) * lit
        return np.where(np.isnan(there(0, 0)), np.nan, 1 + 254 * total / 2)

    return on_arrays(blocks, keys, name, 1, kernel, out)


def spread(blocks: DataFrame, keys: Sequence[str], name: str, times: int = 1, grow: bool = True, outside: bool | None = None, out: str = "spread") -> DataFrame:
    """Flags (1, else not) grown (``grow``) or shrunk by a square of side 2 ``times`` + 1; outside: what lies beyond the raster, by default nothing that changes a flag."""
    beyond = (not grow) if outside is None else outside

    def kernel(a: np.ndarray, add: tuple[int, int, int, int]) -> np.ndarray:
        on = a == 1
        for axis, (low, high) in enumerate((add[:2], add[2:])):
            wide = np.pad(on, [(times - low, times - high) if k == axis else (0, 0) for k in range(2)], constant_values=beyond)
            seen = np.lib.stride_tricks.sliding_window_view(wide, 2 * times + 1, axis)
            on = seen.any(-1) if grow else seen.all(-1)
        return on.astype(float)

    return on_arrays(blocks, keys, name, times, kernel, out)
