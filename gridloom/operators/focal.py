"""Neighbourhood operators on gridded cells: (keys, row, col, value). Kernels run on blocks with halos."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import on_blocks
from .graph import components
from .staging import staged as cut

SQUARE = tuple((i, j) for i in (-1, 0, 1) for j in (-1, 0, 1))
CROSS = ((0, 0), (-1, 0), (1, 0), (0, -1), (0, 1))


def _shifted(a: np.ndarray, i: int, j: int, outside) -> np.ndarray:
    """What stands i rows and j columns on."""
    wide = np.pad(a, ((0, 0), (abs(i), abs(i)), (abs(j), abs(j))), constant_values=outside)
    return wide[:, abs(i) + i : abs(i) + i + a.shape[1], abs(j) + j : abs(j) + j + a.shape[2]]


def _flags(cells: DataFrame, flag: str, name: str) -> DataFrame:
    return cells.withColumn(name, F.coalesce(F.col(flag).cast("int"), F.lit(0)))


def dilate(cells: DataFrame, keys: list[str], flag: str, cross: bool = False, block: int = 256) -> DataFrame:
    """Adds ``dilated``: whether a cell or one of its 8 (or 4) neighbours has the flag. Missing cells have none."""
    def kernel(arrays, there):
        on = arrays["_flag"] == 1
        return {"dilated": np.any([_shifted(on, i, j, False) for i, j in (CROSS if cross else SQUARE)], axis=0)}

    return on_blocks(_flags(cells, flag, "_flag"), keys, ["_flag"], 1, kernel, {"dilated": "boolean"}, block).drop("_flag")


def erode(cells: DataFrame, keys: list[str], flag: str, times: int = 1, outside: bool = True, block: int = 256) -> DataFrame:
    """Adds ``eroded``: whether the whole square of side 2 ``times`` + 1 has the flag. ``outside``: what lies beyond the raster, which must be dense."""
    def kernel(arrays, there):
        on = np.where(there, arrays["_flag"] == 1, outside)
        for axis in (1, 2):  # the square is separable
            wide = np.pad(on, [(times, times) if k == axis else (0, 0) for k in range(3)], constant_values=outside)
            on = np.lib.stride_tricks.sliding_window_view(wide, 2 * times + 1, axis).all(-1)
        return {"eroded": on}

    return on_blocks(_flags(cells, flag, "_flag"), keys, ["_flag"], times, kernel, {"eroded": "boolean"}, block).drop("_flag")


def gaussian(sigma: float) -> list[float]:
    """Weights of a Gaussian cut off at four standard deviations."""
    radius = int(4 * sigma + 0.5)
    w = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-radius, radius + 1)]
    return [x / sum(w) for x in w]


def blur(cells: DataFrame, keys: list[str], value: str, sigma: float, nodata: float | None = None, block: int = 256) -> DataFrame:
    """Adds ``blurred``: a Gaussian blur of a dense raster, mirrored at its edges (d c b a | a b c d | d c b a). No data counts as 0 and
    stays no data; the weights are not adjusted for it."""
    weights = gaussian(sigma)
    radius = len(weights) // 2

    def kernel(arrays, there):
        v = arrays["_v"]
        gap = np.isnan(v) if nodata is None else np.isnan(v) | (v == nodata)
        now = np.where(gap, 0.0, v)
        for axis in (1, 2):
            n = now.shape[axis]
            wide = np.pad(now, [(radius, radius) if k == axis else (0, 0) for k in range(3)], mode="symmetric")
            now = sum(w * np.take(wide, range(k, k + n), axis) for k, w in enumerate(weights))
        return {"blurred": np.where(gap, v, now)}

    return on_blocks(cells.withColumn("_v", F.col(value).cast("double")), keys, ["_v"], radius, kernel, {"blurred": "double"}, block).drop("_v")


def hillshade(cells: DataFrame, keys: list[str], value: str, z_factor: float = 5.0, pixel: float = 1.0, altitude: float = 45.0, block: int = 256) -> DataFrame:
    """Adds ``shade`` (1..255): light from 225, 270, 315 and 360 degrees, weighted by the squared sine of aspect less azimuth; slopes by
    Horn's 3 x 3 weights. Only cells with all neighbours."""
    alt = math.radians(altitude)

    def kernel(arrays, there):
        z = arrays["_z"]
        x, y = (sum(_shifted(z, i, j, np.nan) * d(i, j) * (1 if d(j, i) else 2) for i, j in SQUARE if (i, j) != (0, 0)) / 8 * z_factor / pixel for d in (lambda i, j: j, lambda i, j: i))
        steep = x * x + y * y
        root, total = np.sqrt(1 + steep), 0.0
        for azimuth in (225.0, 270.0, 315.0, 360.0):
            a = math.radians(azimuth)
            # Light from azimuth a (clockwise from north) on a surface that rises by x to the east and by y to the south.
            lit = np.maximum((math.sin(alt) - math.cos(alt) * (x * math.sin(a) - y * math.cos(a))) / root, 0.0)
            across = x * math.cos(a) + y * math.sin(a)
            total = total + np.where(steep > 0, across * across / np.where(steep > 0, steep, 1.0), 0.5) * lit
        return {"shade": np.where(np.isnan(z), np.nan, 1 + 254 * total / 2)}

    return on_blocks(cells.withColumn("_z", F.col(value).cast("double")), keys, ["_z"], 1, kernel, {"shade": "double"}, block, drop=True).drop("_z")


def _nearest(valid: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Squared distance, row and column of the nearest valid cell within ``width`` columns, ties to the smaller row, then column."""
    n, h, w = valid.shape
    i, far = np.arange(h)[None, :, None], 1 << 20
    up = np.maximum.accumulate(np.where(valid, i, -far), 1)
    down = np.minimum.accumulate(np.where(valid, i, far)[:, ::-1], 1)[:, ::-1]
    near = np.where(i - up <= down - i, up, down)  # of its own column, ties upwards
    best = np.full(valid.shape, 4 * far**2, np.int64)
    row, col = np.zeros(valid.shape, np.int64), np.zeros(valid.shape, np.int64)
    for d in range(-min(width, w - 1), min(width, w - 1) + 1):  # from left to right
        here, there = slice(max(0, -d), w - max(0, d)), slice(max(0, d), w + min(0, d))
        r = near[:, :, there]
        d2 = (r - i) ** 2 + d * d
        less = (d2 < best[:, :, here]) | ((d2 == best[:, :, here]) & (r < row[:, :, here]))
        for a, b in ((best, d2), (row, r), (col, np.broadcast_to(np.arange(w)[there], r.shape))):
            a[:, :, here] = np.where(less, b, a[:, :, here])
    return best, row, col


def fill_nearest(cells: DataFrame, keys: list[str], values: list[str], valid: str, fillable: str, block: int = 128) -> DataFrame:
    """Invalid fillable cells take the values of the nearest valid cell of their raster; ties go to the smaller row, then column.

    Each block is searched with a halo of a quarter of its side. A cell is settled if its nearest lies within the halo; only blocks with
    cells left are searched again, with sides and halos twice as long, up to ``FARTHEST``; what is left then looks through the rest of its raster,
    block by block. At most blocks of bounded size are held by a task."""
    kinds = dict(cells.dtypes)
    todo = (~F.col(valid) & F.col(fillable)).cast("int")
    now = cells.withColumns({"_valid": F.coalesce(F.col(valid).cast("int"), F.lit(0)), "_open": F.coalesce(todo, F.lit(0)), **{f"_v{k}": F.col(v).cast("double") for k, v in enumerate(values)}})
    base = now.select(*keys, "row", "col", "_valid", "_open", *(f"_v{k}" for k in range(len(values))))
    names = [f"_v{k}" for k in range(len(values))]
    spans = base.where("_valid = 1").groupBy(*keys).agg(F.min("row").alias("_r0"), F.max("row").alias("_r1"), F.min("col").alias("_c0"), F.max("col").alias("_c1"))
    found, left, side = None, None, max(block, 4)
    while True:
        width = side // 4

        def kernel(arrays, there, width=width):
            ok = arrays["_valid"] == 1
            d2, r, c = _nearest(ok, width)
            hit = (arrays["_open"] == 1) & (d2 <= width * width)
            at = np.broadcast_to(np.arange(len(ok))[:, None, None], ok.shape), np.where(hit, r, 0), np.where(hit, c, 0)
            return {"_hit": np.where(hit, 1.0, np.where(arrays["_open"] == 1, 0.0, np.nan)), **{f"_n{k}": np.where(hit, arrays[v][at], np.nan) for k, v in enumerate(names)}}

        part = base
        if left is not None:  # only the surroundings of what is left
            near = lambda c, side=side, width=width: F.array_distinct(F.transform(F.array(F.lit(-width), F.lit(0), F.lit(width)), lambda d: F.floor((F.col(c) + d) / side).cast("int")))
            live = left.select(*keys, F.floor(F.col("row") / side).cast("int").alias("_lr"), F.floor(F.col("col") / side).cast("int").alias("_lc")).distinct()
            part = base.withColumns({"_lr": F.explode(near("row"))}).withColumns({"_lc": F.explode(near("col"))}).join(live, [*keys, "_lr", "_lc"], "left_semi").drop("_lr", "_lc").distinct()
            part = part.withColumn("_open", F.lit(0)).join(left.withColumn("_again", F.lit(1)), [*keys, "row", "col"], "left").withColumn("_open", F.coalesce("_again", F.lit(0))).drop("_again")
        tried = cut(on_blocks(part, keys, ["_valid", "_open", *names], width, kernel, {"_hit": "int", **{f"_n{k}": "double" for k in range(len(names))}}, side, drop=False).where("_hit is not null"))
        got = tried.where("_hit = 1").select(*keys, "row", "col", *(f"_n{k}" for k in range(len(names))))
        found = got if found is None else found.unionByName(got)
        left = tried.where("_hit = 0").select(*keys, "row", "col").join(spans.select(*keys), keys, "left_semi")
        if left.isEmpty():
            break
        side *= 2
        if side > FARTHEST:
            found = found.unionByName(_look_everywhere(left, base.where("_valid = 1"), keys, names, FARTHEST // 4))
            break
    out = cells.join(found, [*keys, "row", "col"], "left")
    return out.withColumns({v: F.coalesce(F.col(f"_n{k}").cast(kinds[v]), F.col(v)) for k, v in enumerate(values)}).drop(*(f"_n{k}" for k in range(len(names))))


FARTHEST = 1024


def _look_everywhere(left: DataFrame, good: DataFrame, keys: list[str], names: list[str], block: int) -> DataFrame:
    """The nearest of ``good`` for cells that have none within a quarter of ``FARTHEST``: first the blocks that can hold the nearest of any cell of
    a block, by the least and largest distances of the two, then the cells of those blocks."""
    at = lambda c: F.floor(F.col(c) / block).cast("int")
    boxes = lambda df, n: df.groupBy(*keys, at("row").alias(f"{n}r"), at("col").alias(f"{n}c")).agg(*(f(c).alias(f"{n}_{c}{i}") for c in ("row", "col") for i, f in ((0, F.min), (1, F.max))))
    gap = lambda c: F.greatest(F.col(f"b_{c}0") - F.col(f"a_{c}1"), F.col(f"a_{c}0") - F.col(f"b_{c}1"), F.lit(0))
    span = lambda c: F.greatest(F.col(f"b_{c}1") - F.col(f"a_{c}0"), F.col(f"a_{c}1") - F.col(f"b_{c}0"))
    pairs = boxes(left, "a").join(boxes(good, "b"), keys).select(*keys, "ar", "ac", "br", "bc", (gap("row") ** 2 + gap("col") ** 2).alias("low"), (span("row") ** 2 + span("col") ** 2).alias("high"))
    pairs = pairs.join(pairs.groupBy(*keys, "ar", "ac").agg(F.min("high").alias("most")), [*keys, "ar", "ac"]).where("low <= most").select(*keys, "ar", "ac", "br", "bc")
    have = good.select(*keys, F.col("row").alias("vr"), F.col("col").alias("vc"), at("row").alias("br"), at("col").alias("bc"), *names)
    want = left.select(*keys, "row", "col", at("row").alias("ar"), at("col").alias("ac")).join(pairs, [*keys, "ar", "ac"])
    d2 = (F.col("row") - F.col("vr")) ** 2 + (F.col("col") - F.col("vc")) ** 2
    best = want.join(have, [*keys, "br", "bc"]).groupBy(*keys, "row", "col").agg(F.min(F.struct(d2.alias("d2"), "vr", "vc", *names)).alias("n"))
    return best.select(*keys, "row", "col", *(F.col(f"n.{v}").alias(f"_n{k}") for k, v in enumerate(names)))


def _labels(on: np.ndarray) -> np.ndarray:
    """8-connected components of flagged cells: the place of each one's first cell. By hooking and shortcutting, all at once."""
    n, h, w = on.shape
    place = np.arange(on.size).reshape(on.shape)
    pairs = []
    for i, j in ((0, 1), (1, -1), (1, 0), (1, 1)):
        a = place[:, : h - i, max(0, -j) : w - max(0, j)]
        b = place[:, i:, max(0, j) : w + min(0, j)]
        both = on.reshape(-1)[a] & on.reshape(-1)[b]
        pairs.append((a[both], b[both]))
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    root = place.reshape(-1).copy()
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if not (differ := low < high).any():
            return root.reshape(on.shape)
        np.minimum.at(root, high[differ], low[differ])
        while (after := root[root]).tobytes() != root.tobytes():
            root = after


def reached_from_edge(cells: DataFrame, key: str, flag: str, block: int = 256) -> DataFrame:
    """Adds ``open``: whether a flagged cell is 8-connected to the raster's edge by flagged cells.

    Components are labelled within blocks; labels that touch across the blocks' borders are linked, and those on the raster's edge with the
    edge itself, a node of its own; star contraction then finds what hangs together in a number of rounds that grows with the logarithm of the longest way."""
    size = cells.groupBy(key).agg(*(f(c).alias(f"{n}_{c}") for c in ("row", "col") for n, f in (("lo", F.min), ("hi", F.max))))

    def kernel(arrays, there):
        on = arrays["_on"] == 1
        first = _labels(on)
        n, h, w = on.shape
        r, c = arrays["_r"].reshape(-1)[first], arrays["_c"].reshape(-1)[first]
        return {"lr": np.where(on, r, np.nan), "lc": np.where(on, c, np.nan)}

    marked = cells.select(key, "row", "col", F.coalesce(F.col(flag).cast("int"), F.lit(0)).alias("_on"), F.col("row").alias("_r"), F.col("col").alias("_c"))
    labelled = cut(on_blocks(marked, [key], ["_on", "_r", "_c"], 0, kernel, {"lr": "int", "lc": "int"}, block, drop=True).select(key, "row", "col", F.struct(F.col(key), "lr", "lc").alias("label")))
    rim = labelled.where((F.pmod("row", F.lit(block))).isin(0, block - 1) | (F.pmod("col", F.lit(block))).isin(0, block - 1))
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 1), (1, -1), (1, 0), (1, 1))))
    moved = rim.select(key, F.explode(steps).alias("m"), "row", "col", F.col("label").alias("a")).select(key, (F.col("row") + F.col("m.i")).alias("row"), (F.col("col") + F.col("m.j")).alias("col"), "a")
    links = moved.join(rim.select(key, "row", "col", F.col("label").alias("b")), [key, "row", "col"]).select("a", "b").distinct()
    outside = F.struct(F.col(key), (F.col("lo_row") - 1).alias("lr"), (F.col("lo_col") - 1).alias("lc"))
    edge = (F.col("row") == F.col("lo_row")) | (F.col("row") == F.col("hi_row")) | (F.col("col") == F.col("lo_col")) | (F.col("col") == F.col("hi_col"))
    ends = labelled.join(size, key).where(edge).select(outside.alias("a"), F.col("label").alias("b")).distinct()
    found = components(links.unionByName(ends))
    # The edge is the least node of its raster.
    reached = found.join(size.select(outside.alias("root")), "root", "left_semi").select(F.col("node").alias("label"))
    open_ = labelled.join(reached, "label", "left_semi").select(key, "row", "col", F.lit(True).alias("open"))
    return cells.join(open_, [key, "row", "col"], "left").withColumn("open", F.coalesce("open", F.lit(False)))


def ocean_alpha(cells: DataFrame, key: str, depth: str, sigma: float = 0.0, erosion: int = 0, nodata: float = -32767.0) -> DataFrame:
    """Adds ``alpha``: blur, threshold, drop of enclosed water, erosion; 255 where the ocean stays."""
    from ..functions import masks

    if sigma:
        cells = blur(cells, [key], depth, sigma, nodata).drop(depth).withColumnRenamed("blurred", depth)
    wet = cells.withColumn("wet", F.coalesce(masks.ocean(F.col(depth), nodata), F.lit(False)))
    wet = reached_from_edge(wet, key, "wet").drop("wet").withColumnRenamed("open", "wet")
    if erosion:
        wet = erode(wet, [key], "wet", erosion).drop("wet").withColumnRenamed("eroded", "wet")
    return wet.withColumn("alpha", F.when(F.col("wet"), F.lit(255)).otherwise(F.lit(0))).drop("wet")


def row_slabs(height: int = 24) -> Column:
    """The slab of full-width rows that a cell belongs to."""
    return F.floor(F.col("row") / height).cast("int")
