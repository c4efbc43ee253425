"""Resampling of rasters: targets meet the block of source cells that they lie in, with the cells around it that the kernel reaches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .blocks import halo, stacks, whole_groups

RADIUS = {"nearest": 0, "bilinear": 1, "cubic": 2, "cubicspline": 2, "lanczos": 3, "gauss": 2}


def kernel(name: str, d: np.ndarray) -> np.ndarray:
    """The weight at a distance in source cells, by the published filters."""
    a = np.abs(d)
    if name == "bilinear":
        return np.maximum(1 - a, 0.0)
    if name == "cubic":  # Keys, a = -1/2
        return np.where(a <= 1, (1.5 * a - 2.5) * a * a + 1, np.where(a < 2, ((-0.5 * a + 2.5) * a - 4) * a + 2, 0.0))
    if name == "cubicspline":
        return np.where(a <= 1, 2 / 3 - a * a + a**3 / 2, np.where(a < 2, (2 - a) ** 3 / 6, 0.0))
    if name == "gauss":
        return np.where(a < 2, np.exp(-2 * a * a), 0.0)
    if name == "lanczos":
        return np.where(a < 3, np.sinc(a) * np.sinc(a / 3), 0.0)
    raise ValueError(f"no such kernel: {name}")


def gather(targets: DataFrame, source: DataFrame, keys: list[str], source_keys: list[str], values: list[str], method: str = "bilinear", block: int = 256) -> DataFrame:
    """(keys, values): ``targets`` have sx and sy, their places in source cells (a cell's centre is at a half); ``source``
    has row and col. Cells that are missing or null take no part; their weights are shared by the others. Where the
    cell at the place itself is missing, so is the result. One shuffle: of the targets, and of the source's blocks with their rims."""
    if method not in RADIUS:
        raise ValueError(f"no such kernel: {method}")
    row, col = F.floor("sy").cast("int"), F.floor("sx").cast("int")
    if method == "nearest":
        here = source.select(*source_keys, F.col("row").alias("_r"), F.col("col").alias("_c"), *values)
        return targets.withColumns({"_r": row, "_c": col}).join(here, [*source_keys, "_r", "_c"], "left").select(*keys, *values)
    r = RADIUS[method]
    kinds, group, rest = dict(targets.dtypes), [*source_keys, "_br", "_bc"], [k for k in keys if k not in source_keys]
    cells = halo(source.select(*source_keys, "row", "col", *(F.col(v).cast("double").alias(v) for v in values)), source_keys, max(block, r), r)
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    cells = cells.select(*source_keys, F.col("br").alias("_br"), F.col("bc").alias("_bc"), F.lit(False).alias("_wants"), "row", "col", none("double", "sx"), none("double", "sy"), *(none(kinds[k], k) for k in rest), *values)
    place = lambda c: F.floor(F.floor(c) / max(block, r)).cast("int")
    wants = targets.select(*source_keys, place("sy").alias("_br"), place("sx").alias("_bc"), F.lit(True).alias("_wants"), none("int", "row"), none("int", "col"), F.col("sx").cast("double").alias("sx"), F.col("sy").cast("double").alias("sy"), *rest, *(none("double", v) for v in values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, start in whole_groups(batches, group):
            of = np.repeat(np.arange(len(start)), np.diff(np.r_[start, table.num_rows]))
            asks = table.column("_wants").to_numpy()
            mine, theirs = np.flatnonzero(asks), np.flatnonzero(~asks)
            if not len(mine):
                continue
            out = {v: np.full(len(mine), np.nan) for v in values}
            if len(theirs):
                have, own = table.take(pa.array(theirs)), of[theirs]
                y, x = (table.column(c).to_numpy()[mine] for c in ("sy", "sx"))
                rows_, cols_ = (have.column(c).to_numpy().astype(np.int64) for c in ("row", "col"))
                for rows, arrays, _, at in stacks(have, np.flatnonzero(np.r_[True, own[1:] != own[:-1]]), values):
                    stack, top, left = np.full(len(start), -1), np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
                    stack[own[rows]], top[own[rows]], left[own[rows]] = at[0], rows_[rows] - at[1], cols_[rows] - at[2]
                    now = np.flatnonzero(stack[of[mine]] >= 0)
                    g = of[mine[now]]
                    i0, j0 = np.floor(y[now]).astype(np.int64), np.floor(x[now]).astype(np.int64)
                    for v, a in arrays.items():
                        out[v][now] = _weighted(a, stack[g], i0 - top[g], j0 - left[g], y[now] - i0, x[now] - j0, method, r)
            found = table.select(keys).take(pa.array(mine))
            for v, a in out.items():
                found = found.append_column(v, pa.array(a, mask=np.isnan(a)))
            yield from found.combine_chunks().to_batches()

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), *(f"`{v}` double" for v in values)])
    both = cells.unionByName(wants)
    return both.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, schema)


def _weighted(a: np.ndarray, g: np.ndarray, i0: np.ndarray, j0: np.ndarray, dy: np.ndarray, dx: np.ndarray, method: str, r: int) -> np.ndarray:
    """Weighted means around cells (i0, j0) of the stack's arrays g; dy and dx: the places within the cells."""
    _, h, w = a.shape
    total, weight, centre = np.zeros(len(g)), np.zeros(len(g)), np.zeros(len(g), bool)
    for i in range(-r, r + 1):
        wi, ii = kernel(method, i + 0.5 - dy), i0 + i
        for j in range(-r, r + 1):
            jj = j0 + j
            found = a[g, np.clip(ii, 0, h - 1), np.clip(jj, 0, w - 1)]
            ok = (ii >= 0) & (ii < h) & (jj >= 0) & (jj < w) & ~np.isnan(found)
            use = np.where(ok, wi * kernel(method, j + 0.5 - dx), 0.0)
            total += use * np.where(ok, found, 0.0)
            weight += use
            if i == j == 0:
                centre = ok
    return np.where(centre & (weight != 0), total / np.where(weight != 0, weight, 1.0), np.nan)


def mercator_targets(pixels: DataFrame, x: Column, y: Column, origin: tuple[Column, Column], size: tuple[float, float]) -> DataFrame:
    """``pixels`` with sx and sy: the places, in cells of a north-up raster in degrees, of Web Mercator points x, y. origin: the raster's
    north-west corner (longitude, latitude); size: a cell's (width, height) in degrees."""
    return pixels.withColumns({"sx": (geo.longitude(x) - origin[0]) / size[0], "sy": (origin[1] - geo.latitude(y)) / size[1]})


def average(source: DataFrame, keys: list[str], values: list[str], factor: int) -> DataFrame:
    """Blocks of ``factor`` x ``factor`` cells as one, by the mean of what is there."""
    half = [F.floor(F.col(c) / factor).cast("int").alias(c) for c in ("row", "col")]
    return source.groupBy(*keys, *half).agg(*(F.avg(v).alias(v) for v in values))


def aligned_window(origin: tuple[float, float], pixel: float, size: tuple[int, int], bounds: tuple[float, float, float, float], target_pixel: float, same_crs: bool = True) -> tuple[int, int, int, int] | None:
    """(column, row, width, height) of north-up source pixels that are just the target's, so that a crop will do; None if they must be resampled.

    Pixel sizes may differ by 1e-9, bounds by 1e-6."""
    if not same_crs or abs(pixel - target_pixel) > 1e-9:
        return None
    minx, miny, maxx, maxy = bounds
    col, row = round((minx - origin[0]) / pixel), round((origin[1] - maxy) / pixel)
    width, height = round((maxx - minx) / pixel), round((maxy - miny) / pixel)
    fitted = (origin[0] + col * pixel, origin[1] - (row + height) * pixel, origin[0] + (col + width) * pixel, origin[1] - row * pixel)
    if any(abs(a - b) > 1e-6 for a, b in zip(fitted, bounds, strict=True)):
        return None
    return (col, row, width, height) if col >= 0 and row >= 0 and col + width <= size[0] and row + height <= size[1] else None
