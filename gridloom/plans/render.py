"""Renders put together from the operators: land tiles, ocean chunks, terrain, arbitrary bounds, mask previews, overviews by kernels."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import color, geo, masks
from ..operators import blocks, focal, mosaic, resample, tiles
from ..sources import sinks

RGB = ("r", "g", "b")
AT = ("row", "col")
# The colours of a mask preview.
LAND_COLOUR, EDGE_COLOUR, FADE_COLOUR = (0.72, 0.66, 0.5), (1.0, 0.25, 0.1), (0.0, 0.7, 1.0)


def crop(cells: DataFrame, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """The cells of a core window, its ends included."""
    return cells.where(F.col("row").between(*rows) & F.col("col").between(*cols))


def land_tile(observations: DataFrame, mask: DataFrame, keys: list[str], weight: Column, core: tuple[tuple[int, int], tuple[int, int]], grade: color.Grade = color.LAND) -> DataFrame:
    """(keys, row, col, r, g, b, a) bytes of land: dated observations (keys, row, col, date, r, g, b) are averaged, gaps where the mask (keys,
    row, col, alpha, covered) lets land show are filled by the nearest valid cell, styled, given their alpha, and cropped to the core.

    Only cells that the mask covers and that touch allowed ones are there."""
    at = [*keys, *AT]
    mean = mosaic.weighted_mean(observations, at, weight)
    allowed = F.coalesce(masks.fill_allowed(F.col("alpha"), F.col("covered")), F.lit(False))
    known = mosaic.align(mean, mask.select(*at, "alpha", "covered"), at).withColumn("allowed", allowed)
    near = focal.dilate(known, keys, "allowed").where("covered and dilated").drop("dilated")
    filled = focal.fill_nearest(near, keys, list(RGB), "valid", "allowed")
    shown = color.land_style(tuple(color.normalise(F.col(c)) for c in RGB), grade)
    alpha = masks.alpha(F.col("valid"), F.col("alpha"), allowed=F.col("allowed"), covered=F.col("covered"), filled=~F.col("valid") & F.col("allowed"))
    out = filled.select(*at, *(color.to_byte(c).alias(n) for c, n in zip(shown, RGB, strict=True)), alpha.alias("a"))
    return crop(out, *core)


def tiles_with_land(mask: DataFrame, keys: list[str], alpha: str = "alpha", covered: str = "covered", nodata: float | None = None) -> DataFrame:
    """Keys of the tiles whose mask shows land: a covered cell that is allowed or touches an allowed one."""
    allowed = masks.fill_allowed(F.col(alpha), F.col(covered), nodata)
    near = focal.dilate(mask.withColumn("_allowed", F.coalesce(allowed, F.lit(False))), keys, "_allowed")
    return near.where(F.col(covered) & F.col("dilated")).select(*keys).distinct()


def ocean_chunk(cells: DataFrame, key: str, depth: str, core: tuple[tuple[int, int], tuple[int, int]], sigma: float = 0.0, erosion: int = 0, z_factor: float = 5.0, pixel: float = 1.0, scale: float = 1.0, grade: color.Grade | None = None) -> DataFrame:
    """(key, row, col, r, g, b, a) bytes of ocean: alpha from the depth, colour by the ramp, light by the slopes, cropped to the core.

    ``cells`` hold the core and as many cells around it as the kernels reach; ``scale`` turns depths into metres for the ramp."""
    wet = focal.ocean_alpha(cells.withColumn("_depth", F.col(depth)), key, depth, sigma, erosion)
    lit = focal.hillshade(wet, [key], "_depth", z_factor, pixel)
    rgb = color.hillshade_modulate(color.ramp(F.col("_depth") * scale), F.col("shade"))
    rgb = color.grade(rgb, grade) if grade else rgb
    return crop(lit.select(key, *AT, *(color.to_byte(c).alias(n) for c, n in zip(rgb, RGB, strict=True)), F.col("alpha").alias("a")), *core)


def mask_preview(cells: DataFrame, key: str, depth: str, sigma: float = 0.0, erosion: int = 0, nodata: float = -32767.0, scale: float = 1.0) -> DataFrame:
    """(key, row, col, r, g, b): ocean in its ramp, land in one colour, the border of the final mask and, outside of it, of the raw depth contour."""
    raw = cells.withColumns({"_depth": F.col(depth), "_raw": F.coalesce(masks.ocean(F.col(depth), nodata), F.lit(False))})
    raw = focal.dilate(raw, [key], "_raw", cross=True).withColumn("_fade", F.col("dilated") != F.col("_raw")).drop("dilated")
    if sigma:
        raw = focal.blur(raw, [key], depth, sigma, nodata).drop(depth).withColumnRenamed("blurred", depth)
    wet = raw.withColumn("_wet", F.coalesce(masks.ocean(F.col(depth), nodata), F.lit(False)))
    wet = focal.reached_from_edge(wet, key, "_wet").drop("_wet").withColumnRenamed("open", "_wet")
    if erosion:  # without a border of ocean around the preview
        wet = focal.erode(wet, [key], "_wet", erosion, outside=False).drop("_wet").withColumnRenamed("eroded", "_wet")
    seen = focal.dilate(wet, [key], "_wet", cross=True).withColumn("_edge", F.col("dilated") != F.col("_wet"))
    ramp = color.ramp(F.col("_depth") * scale)
    pick = lambda k: F.when(F.col("_edge"), EDGE_COLOUR[k]).when(F.col("_fade"), FADE_COLOUR[k]).when(F.col("_wet"), ramp[k]).otherwise(LAND_COLOUR[k])
    return seen.select(key, *AT, *(pick(k).alias(c) for k, c in enumerate(RGB)))


def terrain(targets: DataFrame, elevation: DataFrame, keys: list[str], source_keys: list[str], value: str, method: str = "cubicspline", digits: int | None = None) -> DataFrame:
    """(keys, r, g, b): Terrarium bytes of an elevation raster warped to ``targets`` (keys, sx, sy). digits: to round elevations to before they are encoded."""
    warped = resample.gather(targets, elevation, keys, source_keys, [value], method)
    height = F.col(value) if digits is None else F.round(value, digits)
    return warped.select(*keys, *(c.alias(n) for c, n in zip(color.terrarium(height), RGB, strict=True)))


def render_bounds(views: DataFrame, source: DataFrame, key: str, values: list[str], size: tuple[int, int]) -> DataFrame:
    """(key, row, col, values): each view's bounds (minx, miny, maxx, maxy, in source cells, rows from the top) as ``size`` (width, height)
    pixels, by the nearest cell of the overlap with the raster (its width and height: w, h); 0 outside.

    The overlap's window in the output is rounded to whole pixels, halves to even."""
    width, height = size
    x0, y0, x1, y1 = F.greatest("minx", F.lit(0.0)), F.greatest("miny", F.lit(0.0)), F.least("maxx", "w"), F.least("maxy", "h")
    part = lambda v, low, high, n: F.least(F.greatest(F.bround((v - F.col(low)) * n / (F.col(high) - F.col(low)), 0), F.lit(0)), F.lit(n)).cast("int")
    cut = {"a0": part(x0, "minx", "maxx", width), "a1": part(x1, "minx", "maxx", width), "b0": part(y0, "miny", "maxy", height), "b1": part(y1, "miny", "maxy", height)}
    placed = views.withColumns({"x0": x0, "x1": x1, "y0": y0, "y1": y1}).withColumns(cut)
    grid = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(height - 1))).alias("row")).select("*", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("col"))
    there = (F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1")) & (F.col("col") >= F.col("a0")) & (F.col("col") < F.col("a1")) & (F.col("row") >= F.col("b0")) & (F.col("row") < F.col("b1"))
    sx = F.when(there, F.floor(F.col("x0") + (F.col("col") - F.col("a0") + 0.5) * (F.col("x1") - F.col("x0")) / (F.col("a1") - F.col("a0")))).cast("int")
    sy = F.when(there, F.floor(F.col("y0") + (F.col("row") - F.col("b0") + 0.5) * (F.col("y1") - F.col("y0")) / (F.col("b1") - F.col("b0")))).cast("int")
    here = source.select(key, F.col("row").alias("_r"), F.col("col").alias("_c"), *values)
    out = grid.select(key, *AT, sy.alias("_r"), sx.alias("_c")).join(here, [key, "_r", "_c"], "left")
    return out.select(key, *AT, *(F.coalesce(v, F.lit(0)).alias(v) for v in values))


def overview_weights(size: int, method: str) -> np.ndarray:
    """Weights (size, 2 size) of halving a row of 2 ``size`` pixels: the kernel at twice its width, cut at the ends and normalised."""
    reach = resample.RADIUS[method]
    centre = 2 * np.arange(size)[:, None] + 1.0
    d = (np.arange(2 * size)[None, :] + 0.5 - centre) / 2
    w = np.where(np.abs(d) < reach, resample.kernel(method, d), 0.0)
    return w / w.sum(1, keepdims=True)


def overview(pixels: DataFrame, size: int, method: str) -> DataFrame:
    """One level up by a kernel: pixels (z, tx, ty, row, col, r, g, b, a) of whole tiles of ``size``; missing children are transparent. Colours
    are weighted by their alpha, and rounded once. ``average`` is ``tiles.downsample``."""
    if method == "average":
        return tiles.downsample(pixels, size)
    w = overview_weights(size, "bilinear" if method == "gauss" else "cubic" if method == "cubicspline" else method)
    half = lambda c: F.floor(F.col(c) / 2).cast("int")
    at = pixels.select((F.col("z") - 1).alias("z"), half("tx").alias("tx"), half("ty").alias("ty"), (F.col("ty") % 2 * size + F.col("row")).cast("int").alias("row"), (F.col("tx") % 2 * size + F.col("col")).cast("int").alias("col"), *tiles.RGBA)

    def kernel(arrays, there):
        n, h, wide = there.shape
        full = {c: np.zeros((n, 2 * size, 2 * size)) for c in tiles.RGBA}
        # A stack begins at its first child's corner; the corner's own row and column say which.
        top, left = int(np.nanmin(arrays["_row"])), int(np.nanmin(arrays["_col"]))
        for c, a in full.items():
            a[:, top : top + h, left : left + wide] = np.nan_to_num(arrays[c])
        alpha = w @ full["a"] @ w.T
        out = {}
        for c in RGB:
            total = w @ (full[c] * full["a"]) @ w.T
            out[c] = np.where(alpha > 0, total / np.where(alpha > 0, alpha, 1.0), 0.0)
        out["a"] = alpha
        made = {}
        for c, a in out.items():
            spread = np.full((n, 2 * size, 2 * size), np.nan)
            spread[:, ::2, ::2] = np.clip(np.floor(a + 0.5 + 1e-9), 0, 255)
            made[f"_{c}"] = spread[:, top : top + h, left : left + wide]
        return made

    # Tiles whose children differ in place are told apart, so that all of a stack begin at the same corner.
    corner = at.groupBy("z", "tx", "ty").agg(F.min("row").alias("_top"), F.min("col").alias("_left"))
    told = at.join(corner, ["z", "tx", "ty"]).withColumns({"_row": F.col("row"), "_col": F.col("col")})
    made = blocks.on_blocks(told, ["_top", "_left", "z", "tx", "ty"], [*tiles.RGBA, "_row", "_col"], 0, kernel, {f"_{c}": "int" for c in tiles.RGBA}, 2 * size, drop=True)
    return made.select("z", "tx", "ty", (F.col("row") / 2).cast("int").alias("row"), (F.col("col") / 2).cast("int").alias("col"), *(F.col(f"_{c}").alias(c) for c in tiles.RGBA))


def direct_tiles(pixels: DataFrame, size: int, levels: int, method: str = "average") -> DataFrame:
    """(z, tx, ty, content): opaque PNG tiles of a raster's pixels (z, tx, ty, row, col, r, g, b, a) and of ``levels`` overviews; its alpha is dropped."""
    level = pixels.withColumn("a", F.lit(255))
    out = level
    for _ in range(levels):
        level = overview(level, size, method).withColumn("a", F.lit(255))
        out = out.unionByName(level.select(*out.columns))
    return sinks.png_tiles(out, size)


def ocean_tiles(chunk: DataFrame, place: Mapping[str, Column], size: int) -> DataFrame:
    """(z, tx, ty, content): an ocean chunk's pixels as tiles of their own, transparent where land is; wholly transparent ones are left out.
    place: z, tx, ty of a chunk."""
    return sinks.png_tiles(chunk.select(*(c.alias(n) for n, c in place.items()), *AT, *tiles.RGBA), size)


def masked_codes(cells: DataFrame, lon: Column, lat: Column, shown: Column) -> DataFrame:
    """(code): the 100 km squares of the cells that a mask shows; places without a code are left out."""
    from ..functions import mgrs

    return cells.where(shown).select(mgrs.code_of(lon, lat).alias("code")).where("code is not null").distinct()


def sample_window(observations: DataFrame, keys: list[str], order: str, window: tuple[tuple[int, int], tuple[int, int]], low: float = 0.0, high: float = 9000.0) -> DataFrame:
    """(keys, row, col, r, g, b) of the newest date that has all three bands somewhere, within a window, as 0..1; no data is 0."""
    whole = observations.where(F.col("r").isNotNull() & F.col("g").isNotNull() & F.col("b").isNotNull())
    newest = whole.groupBy(*keys).agg(F.max(order).alias(order))
    part = crop(observations.join(newest, [*keys, order], "left_semi"), *window)
    return part.select(*keys, *AT, *(color.normalise(F.col(c), low, high).alias(c) for c in RGB))


def mercator_grid(rasters: DataFrame, size: int, cells: int, degrees: float) -> DataFrame:
    """``rasters`` (with lon0 and lat1, their north-west corners) as size x size target pixels (orow, ocol) in Web Mercator over
    ``cells`` x ``cells`` source cells of so many degrees, with sx and sy."""
    side = cells * degrees
    steps = F.sequence(F.lit(0), F.lit(size - 1))
    grid = rasters.select("*", F.explode(steps).alias("orow")).select("*", F.explode(steps).alias("ocol"))
    west, east = geo.mercator_x(F.col("lon0")), geo.mercator_x(F.col("lon0") + side)
    north, south = geo.mercator_y(F.col("lat1")), geo.mercator_y(F.col("lat1") - side)
    x = west + (F.col("ocol") + 0.5) * (east - west) / size
    y = north - (F.col("orow") + 0.5) * (north - south) / size
    return resample.mercator_targets(grid, x, y, (F.col("lon0"), F.col("lat1")), (degrees, degrees))
