"""Tile pyramids: layers, overviews, extents, and rasters cut into tiles."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import color, geo
from .staging import per_group

RGBA = ("r", "g", "b", "a")


def fold_layers(layers: DataFrame, keys: list[str], seq: str, under: DataFrame | None = None) -> DataFrame:
    """Straight-alpha bytes composited in the order of ``seq``; ``under`` lies below where the result is not opaque.

    The layers of one pixel are folded in order, for ``over`` does not commute."""
    stack = layers.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(seq, *(F.col(c).cast("int").alias(c) for c in RGBA)))).alias("stack"))
    empty = F.struct(*(F.lit(0).alias(c) for c in RGBA))
    step = lambda acc, x: F.struct(*(v.alias(c) for v, c in zip(color.over([acc[c] for c in RGBA], [x[c] for c in RGBA]), RGBA, strict=True)))
    out = stack.select(*keys, F.aggregate("stack", empty, step).alias("p")).select(*keys, "p.*")
    if under is None:
        return out
    both = out.join(under.select(*keys, *(F.col(c).cast("int").alias(f"u_{c}") for c in RGBA)), keys, "full_outer")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in RGBA}
    low = [F.coalesce(F.col(f"u_{c}"), F.lit(0)) for c in RGBA]
    mixed = color.over(low, [zero[c] for c in RGBA])
    return both.select(*keys, *(F.when(zero["a"] == 255, zero[c]).otherwise(m).alias(c) for c, m in zip(RGBA, mixed, strict=True)))


def over_bytes(bottom: np.ndarray, top: np.ndarray) -> np.ndarray:
    """``color.over`` on arrays (rows, columns, 4) of bytes."""
    t, u = top.astype(np.int64), bottom.astype(np.int64)
    a, rest = t[..., 3:], u[..., 3:] * (255 - t[..., 3:])
    total = a * 255 + rest
    colour = np.where(total == 0, 0, (2 * (t[..., :3] * a * 255 + u[..., :3] * rest) + total) // np.maximum(2 * total, 1))
    return np.concatenate([colour, (total + 127) // 255], -1).astype(np.uint8)


def merge_trees(trees: DataFrame, layer: str = "layer") -> DataFrame:
    """(z, tx, ty, content, decoded): trees of PNG tiles (layer, z, tx, ty, content) merged, greater layers on top.

    Settled by kind before any image is opened: a PNG without alpha hides what lies below it, which is dropped; where one tile is left its bytes go on as they are. Only
    tiles with something to mix are decoded, folded from below and encoded again; a tile that then shows nothing is left out. A group is one tile's layers."""
    key = ["z", "tx", "ty"]
    opaque = F.substring("content", 26, 1) == F.lit(b"\x02")  # a PNG's kind of colours: no alpha
    kinds = trees.select(*key, F.col(layer).alias("layer"), opaque.alias("opaque"))
    floor = kinds.groupBy(*key).agg(F.max(F.when(F.col("opaque"), F.col("layer"))).alias("floor"), F.sort_array(F.collect_list("layer")).alias("layers"))
    floor = floor.select(*key, "floor", F.size(F.filter("layers", lambda x: F.col("floor").isNull() | (x >= F.col("floor")))).alias("left"))
    seen = trees.withColumnRenamed(layer, "layer").join(floor, key).where(F.col("floor").isNull() | (F.col("layer") >= F.col("floor")))

    def fold(t: dict[str, np.ndarray]) -> tuple | None:
        from ..sources import files, sinks

        now = None
        for i in np.argsort(t["layer"], kind="stable"):
            image = files.png_rows(t["content"][i])
            if image.shape[2] == 3:
                image = np.concatenate([image, np.full((*image.shape[:2], 1), 255, np.uint8)], 2)
            now = over_bytes(np.zeros_like(image) if now is None else now, image)
        alpha = now[:, :, 3]
        return (*(t[k][0] for k in key), sinks.png_bytes(now[:, :, :3] if (alpha == 255).all() else now)) if alpha.any() else None

    shape = "z int, tx int, ty int, content binary"
    mixed = per_group(seen.where("left > 1").select(*key, "layer", "content"), key, fold, shape)
    return seen.where("left = 1").select(*key, "content", F.lit(False).alias("decoded")).unionByName(mixed.withColumn("decoded", F.lit(True)))


def tile_kind(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, kind): empty where no pixel shows, rgb where all are opaque, else rgba."""
    kind = F.when(F.max("a") == 0, "empty").when(F.min("a") == 255, "rgb").otherwise("rgba")
    return pixels.groupBy(*keys).agg(kind.alias("kind"))


def backfill(tiles: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """``tiles``, and those of ``more`` whose keys are missing."""
    return tiles.unionByName(more.join(tiles.select(*keys).distinct(), keys, "left_anti").select(*tiles.columns))


def first_wins(tiles: DataFrame, keys: list[str], source: Column, last: bool = False) -> DataFrame:
    """One row a key: of the first source, or of the last."""
    order = Window.partitionBy(*keys).orderBy(source.desc() if last else source)
    return tiles.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def parents(tiles: DataFrame) -> DataFrame:
    """Tiles with the coordinates of the tiles above them."""
    half = lambda c: F.floor(F.col(c) / 2).cast("int")
    return tiles.withColumns({"z": F.col("z") - 1, "tx": half("tx"), "ty": half("ty")})


def missing_parents(tiles: DataFrame, existing: DataFrame) -> DataFrame:
    return parents(tiles.select("z", "tx", "ty")).distinct().join(existing.select("z", "tx", "ty"), ["z", "tx", "ty"], "left_anti")


def downsample(pixels: DataFrame, size: int) -> DataFrame:
    """One level up: pixels (z, tx, ty, row, col, r, g, b, a) of tiles of ``size``, 2 x 2 averaged; missing children are transparent.

    One shuffle a level, on the parent's pixel: four children at most meet."""
    row, col = F.col("ty") % 2 * size + F.col("row"), F.col("tx") % 2 * size + F.col("col")
    up = parents(pixels.withColumns({"prow": F.floor(row / 2).cast("int"), "pcol": F.floor(col / 2).cast("int")}))
    mean = [F.floor(F.sum(F.col(c)) / 4 + 0.5).cast("int").alias(c) for c in RGBA]
    return up.groupBy("z", "tx", "ty", F.col("prow").alias("row"), F.col("pcol").alias("col")).agg(*mean)


def pyramid(pixels: DataFrame, size: int, top: int, bottom: int, keep=lambda level: level) -> DataFrame:
    """All levels from ``bottom`` up to ``top``, each from the one below it. keep: how a level is stored before the next uses it."""
    out, level = pixels, pixels
    for _ in range(bottom - top):
        level = keep(downsample(level, size))
        out = out.unionByName(level.select(*out.columns))
    return out


def update_pyramid(levels: DataFrame, changed: DataFrame, gone: DataFrame, size: int, top: int, bottom: int, keep=lambda df: df) -> tuple[DataFrame, DataFrame]:
    """A pyramid after some of its deepest tiles have changed: (pixels of all levels, keys (z, tx, ty) of the tiles made anew).

    levels: pixels (z, tx, ty, row, col, r, g, b, a) of the levels ``bottom`` to ``top``. changed: all pixels of deepest tiles that are new or other; gone: keys of
    those that are no more. A tile is made anew if one below it is, from its children as they are now; a level's other tiles are neither read for
    that nor written. Work goes with the changed tiles, not with the pyramid. keep: how an intermediate table is stored."""
    key = ["z", "tx", "ty"]
    dirty = keep(changed.select(*key).unionByName(gone.select(*key)).distinct())
    fresh, touched = changed.select(*levels.columns), dirty
    out, made = fresh, changed.select(*key).distinct()
    for z in range(bottom - 1, top - 1, -1):
        dirty_up = keep(parents(dirty).select(*key).distinct())
        # Children of the tiles to be made: those that were not touched, as they stand, and those made anew.
        above = {"z": F.col("z") - 1, "tx": F.floor(F.col("tx") / 2).cast("int"), "ty": F.floor(F.col("ty") / 2).cast("int")}
        kids = levels.where(F.col("z") == z + 1).join(dirty, key, "left_anti").select("*", *(c.alias(f"_{n}") for n, c in above.items()))
        wanted = dirty_up.select(*(F.col(c).alias(f"_{c}") for c in key))
        old = kids.join(wanted, [f"_{c}" for c in key], "left_semi").select(*levels.columns)
        fresh = keep(downsample(old.unionByName(fresh), size).select(*levels.columns))
        out, made = out.unionByName(fresh), made.unionByName(fresh.select(*key).distinct())
        dirty, touched = dirty_up, touched.unionByName(dirty_up)
    return levels.join(touched, key, "left_anti").unionByName(out), made


def extent(tiles: DataFrame) -> DataFrame:
    """(min_zoom, max_zoom, west, south, east, north, center_lon, center_lat) of XYZ tiles (z, tx, ty), by the tiles of the deepest level."""
    by_zoom = tiles.groupBy("z").agg(*(f(c).alias(f"{n}_{c}") for c in ("tx", "ty") for n, f in (("lo", F.min), ("hi", F.max))))
    deep = by_zoom.agg(F.min("z").alias("min_zoom"), F.max("z").alias("max_zoom"), F.max_by(F.struct("lo_tx", "hi_tx", "lo_ty", "hi_ty"), "z").alias("e"))
    n = F.pow(F.lit(2.0), F.col("max_zoom"))
    lon = lambda t: t / n * 360.0 - 180.0
    lat = lambda t: F.degrees(F.atan(F.sinh(F.pi() * (1 - 2 * t / n))))
    out = deep.select("min_zoom", "max_zoom", lon(F.col("e.lo_tx")).alias("west"), lat(F.col("e.hi_ty") + 1).alias("south"), lon(F.col("e.hi_tx") + 1).alias("east"), lat(F.col("e.lo_ty")).alias("north"))
    return out.withColumns({"center_lon": (F.col("west") + F.col("east")) / 2, "center_lat": (F.col("south") + F.col("north")) / 2})


def min_zoom(tiles: DataFrame, size: int = 256) -> DataFrame:
    """(max_zoom, min_zoom): up from the deepest level until its extent in pixels, halved each time, fits a tile."""
    by_zoom = tiles.groupBy("z").agg((F.max("tx") - F.min("tx") + 1).alias("w"), (F.max("ty") - F.min("ty") + 1).alias("h"))
    deep = by_zoom.agg(F.max("z").alias("max_zoom"), F.max_by(F.greatest("w", "h"), "z").alias("side")).where("max_zoom is not null")
    levels = F.sequence(F.lit(0), F.col("max_zoom"))
    fits = F.filter(levels, lambda k: F.floor(F.col("side") * size / F.pow(F.lit(2.0), k)) <= size)
    return deep.select("max_zoom", F.greatest(F.col("max_zoom") - F.coalesce(F.array_min(fits), F.col("max_zoom")), F.lit(0)).alias("min_zoom"))


def grid_pixels(tiles: DataFrame, size: int, pixels: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Every pixel of the tiles; what has no source is 0."""
    at = tiles.select("z", "tx", "ty", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("row")).select("*", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("col"))
    return at.join(pixels, ["z", "tx", "ty", "row", "col"], "left").fillna(0, list(bands))


def in_ring(x: Column, y: Column, ring: Sequence[tuple[float, float]]) -> Column:
    """Whether a point lies in a polygon, by crossings of its edges; the cutline of a raster."""
    inside = F.lit(False)
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
        if y1 == y2:
            continue
        crosses = ((F.lit(y1) > y) != (F.lit(y2) > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
        inside = inside != crosses
    return inside


def enumerate_tiles(bounds: DataFrame, keys: list[str], zoom: int) -> DataFrame:
    """The tiles that bounds (minx, miny, maxx, maxy) touch."""
    x0, y0, x1, y1 = geo.tile_range(*(F.col(c) for c in ("minx", "miny", "maxx", "maxy")), zoom)
    return bounds.select(*keys, F.explode(F.sequence(y0, y1)).alias("ty"), x0.alias("x0"), x1.alias("x1")).select(*keys, "ty", F.explode(F.sequence("x0", "x1")).alias("tx"))
