"""Reprojection of rasters in blocks onto tiles: places are projected back exactly on a lattice and interpolated between, kernels widen when pixels grow.

Each target tile names the source blocks that its footprint and its kernel reach, meets them by an equality join and is made in one call. Such a group is a
tile and the blocks below it, so its size goes with the tile's size in source pixels; where pixels grow much, start from a reduced image."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo, mgrs
from .resample import RADIUS
from .resample import kernel as weight_at

# (x, y in the target's projection, the source's row of places) -> (x, y in the source's projection)
Project = Callable[[np.ndarray, np.ndarray, dict], tuple[np.ndarray, np.ndarray]]
TARGET = "minx double, maxy double, pixel double, size int"


def from_mercator_to_utm(x: np.ndarray, y: np.ndarray, place: dict) -> tuple[np.ndarray, np.ndarray]:
    """Web Mercator to the zone (``zone``, ``south``) of a source."""
    lon, lat = x / geo.HALF_WORLD * 180.0, np.degrees(np.arctan(np.sinh(y * np.pi / geo.HALF_WORLD)))
    e, n = mgrs.utm(lon, lat, np.full(np.shape(x), place["zone"]))
    return e, n + np.where((lat >= 0) & bool(place["south"]), 1e7, 0.0) - np.where((lat < 0) & (not place["south"]), 1e7, 0.0)


def from_mercator_to_degrees(x: np.ndarray, y: np.ndarray, place: dict) -> tuple[np.ndarray, np.ndarray]:
    return x / geo.HALF_WORLD * 180.0, np.degrees(np.arctan(np.sinh(y * np.pi / geo.HALF_WORLD)))


def same(x: np.ndarray, y: np.ndarray, place: dict) -> tuple[np.ndarray, np.ndarray]:
    return x, y


def exact(project: Project, row: dict) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Target pixels (column, row; a centre is at a half) to source pixels, of a row that holds both grids."""
    def at(col: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y = project(row["minx"] + col * row["pixel"], row["maxy"] - line * row["pixel"], row)
        return (x - row["x0"]) / row["px"], (row["y0"] - y) / row["px"]

    return at


def approximate(at: Callable, size: int, tolerance: float = 0.125, step: int = 16) -> tuple[np.ndarray, np.ndarray, int]:
    """Source places (size x size) of a tile's pixels: exact on a lattice, bilinear between. The lattice is halved until the middles of its cells
    are off by ``tolerance`` source pixels at most; with tolerance 0 every place is exact. Also gives the step that was enough."""
    pixels = np.arange(size) + 0.5
    while True:
        ticks = np.unique(np.r_[np.arange(0, size, step), size - 1])
        if tolerance <= 0 or step <= 1 or size == 1:
            return *at(*np.meshgrid(pixels, pixels)), 1
        known = at(*np.meshgrid(pixels[ticks], pixels[ticks]))
        i = np.clip(np.searchsorted(ticks, np.arange(size), "right") - 1, 0, len(ticks) - 2)
        f = (np.arange(size) - ticks[i]) / (ticks[i + 1] - ticks[i])

        def between(v: np.ndarray, r: np.ndarray, fr: np.ndarray, c: np.ndarray, fc: np.ndarray) -> np.ndarray:
            top = v[r][:, c] * (1 - fc) + v[r][:, c + 1] * fc
            low = v[r + 1][:, c] * (1 - fc) + v[r + 1][:, c + 1] * fc
            return top * (1 - fr)[:, None] + low * fr[:, None]

        k = np.arange(len(ticks) - 1)
        half = np.full(len(k), 0.5)
        middle = (pixels[ticks][:-1] + pixels[ticks][1:]) / 2
        true = at(*np.meshgrid(middle, middle))
        edges = at(*np.meshgrid(middle, pixels[ticks]))
        whole = np.full(len(ticks), 0.0)
        rows = np.minimum(np.arange(len(ticks)), len(ticks) - 2)
        whole[-1] = 1.0
        off = max(np.abs(between(v, k, half, k, half) - t).max() for v, t in zip(known, true, strict=True))
        off = max(off, *(np.abs(between(v, rows, whole, k, half) - t).max() for v, t in zip(known, edges, strict=True)))
        if off <= tolerance:
            return *(between(v, i, f, i, f) for v in known), step
        step //= 2


def stretch(at: Callable, size: int) -> tuple[float, float]:
    """How many source pixels a target pixel is wide and high in the middle of the tile, at least one."""
    c = np.array([size / 2, size / 2 + 1, size / 2]), np.array([size / 2, size / 2, size / 2 + 1])
    x, y = at(*c)
    return max(1.0, float(np.hypot(x[1] - x[0], y[1] - y[0]))), max(1.0, float(np.hypot(x[2] - x[0], y[2] - y[0])))


def reach(method: str, scale: float) -> float:
    return 0.5 + scale / 2 if method == "average" else max(RADIUS[method], 1) * scale


def weights(method: str, d: np.ndarray, scale: float) -> np.ndarray:
    """Of a source cell whose centre is d source cells from the place; average: how much of the cell the pixel covers."""
    if method == "average":
        return np.clip(np.minimum(d + 0.5, scale / 2) - np.maximum(d - 0.5, -scale / 2), 0, 1)
    return weight_at(method, d / scale)


def gathered(source: np.ndarray, sx: np.ndarray, sy: np.ndarray, method: str, scale: tuple[float, float]) -> np.ndarray:
    """Weighted means of ``source`` around the places; missing cells take no part. NaN where the cell at the place itself is missing, or for
    average where the pixel covers none."""
    h, w = source.shape
    i0, j0 = np.floor(sy).astype(np.int64), np.floor(sx).astype(np.int64)
    cell = lambda i, j: np.where((i >= 0) & (i < h) & (j >= 0) & (j < w), source[np.clip(i, 0, h - 1), np.clip(j, 0, w - 1)], np.nan)
    centre = cell(i0, j0)
    if method == "nearest":
        return centre
    total, weight = np.zeros(sx.shape), np.zeros(sx.shape)
    ry, rx = (int(np.ceil(reach(method, s))) for s in scale[::-1])
    for i in range(-ry, ry + 1):
        wy = weights(method, i0 + i + 0.5 - sy, scale[1])
        for j in range(-rx, rx + 1):
            found = cell(i0 + i, j0 + j)
            use = np.where(np.isnan(found), 0.0, wy * weights(method, j0 + j + 0.5 - sx, scale[0]))
            total += use * np.nan_to_num(found)
            weight += use
    ok = weight > 1e-12 if method == "average" else ~np.isnan(centre) & (weight != 0)
    return np.where(ok, total / np.where(ok, weight, 1.0), np.nan)


def warp(source: DataFrame, places: DataFrame, targets: DataFrame, keys: Sequence[str], ids: Sequence[str], project: Project = from_mercator_to_utm, method: str = "lanczos", block: int = 256, tolerance: float = 0.125) -> DataFrame:
    """(keys, ids, height, width, data): the tiles that meet a raster, made of its blocks.

    source: blocks (keys, br, bc, height, width, data) of sides of ``block``. places: (keys, x0, y0: the north-west corner, px, and what ``project`` wants). targets: (keys, ids, minx,
    maxy: the north-west corner, pixel, size). Kernels are widened by the size of a target pixel in source pixels where that is over one."""
    kinds = dict(targets.dtypes)
    columns = [c for c in targets.columns if c not in keys] + [c for c in places.columns if c not in keys]
    wants = targets.join(places, list(keys))
    schema = ", ".join([f"`{c}` {dict(wants.dtypes)[c]}" for c in [*keys, *columns]] + ["br int", "bc int"])

    def footprint(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = []
            for n, row in enumerate(b.to_dict("records")):
                at, size = exact(project, row), int(row["size"])
                ticks = np.linspace(0, size, min(size, 16) + 1)
                sx, sy = at(*np.meshgrid(ticks, ticks))
                if not (np.isfinite(sx).all() and np.isfinite(sy).all()):
                    continue
                scale = stretch(at, size)
                # Between the ticks an edge bulges by less than a cell of the lattice.
                rx, ry = (reach(method, s) + 1 + s * size / 128 for s in scale)
                (c0, c1), (r0, r1) = ((max(0, int(np.floor((v.min() - r) / block))), int(np.floor((v.max() + r) / block))) for v, r in ((sx, rx), (sy, ry)))
                found += [(n, i, j) for i in range(r0, r1 + 1) for j in range(c0, c1 + 1)]
            at_ = [x[0] for x in found]
            yield b.iloc[at_].assign(br=np.array([x[1] for x in found], np.int32), bc=np.array([x[2] for x in found], np.int32))

    def render(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0].to_dict()
        size, at = int(row["size"]), exact(project, row)
        sx, sy, _ = approximate(at, size, tolerance)
        r0, c0 = int(pdf["br"].min()), int(pdf["bc"].min())
        whole = np.full(((int(pdf["br"].max()) - r0 + 1) * block, (int(pdf["bc"].max()) - c0 + 1) * block), np.nan)
        for br, bc, h, w, data in zip(*(pdf[c] for c in ("br", "bc", "height", "width", "data")), strict=True):
            whole[(br - r0) * block : (br - r0) * block + h, (bc - c0) * block : (bc - c0) * block + w] = np.frombuffer(data, "<f8").reshape(h, w)
        made = gathered(whole, sx - c0 * block, sy - r0 * block, method, stretch(at, size))
        return pd.DataFrame({**{k: [row[k]] for k in [*keys, *ids]}, "height": [size], "width": [size], "data": [made.astype("<f8").tobytes()]})

    needs = wants.select(*keys, *columns).mapInPandas(footprint, schema)
    met = needs.join(source.select(*keys, "br", "bc", "height", "width", "data"), [*keys, "br", "bc"])
    out = ", ".join([*(f"`{k}` {kinds[k]}" for k in [*keys, *ids]), "height int", "width int", "data binary"])
    return met.groupBy(*keys, *ids).applyInPandas(render, out)


def tile_targets(tiles: DataFrame, size: int = 256) -> DataFrame:
    """XYZ tiles (z, tx, ty and others) as targets: (…, minx, maxy, pixel, size)."""
    side = F.lit(2 * geo.HALF_WORLD) / F.pow(F.lit(2.0), F.col("z"))
    return tiles.withColumns({"minx": F.col("tx") * side - geo.HALF_WORLD, "maxy": F.lit(geo.HALF_WORLD) - F.col("ty") * side, "pixel": side / size, "size": F.lit(size)})
