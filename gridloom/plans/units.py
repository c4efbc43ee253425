"""Planning of work units, row slabs and output tiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, masks, text


def resolve_folders(units: DataFrame, date_paths: Sequence[str], catalogue: DataFrame, prefix: str, first_only: bool = False) -> DataFrame:
    """(unit, date_idx, date_path, folder) of the listed folders, dates in the order given.

    The dates are a short list written by hand, so each unit is exploded over them; no join of everything with everything."""
    dates = F.array(*(F.struct(F.lit(i).alias("date_idx"), F.lit(d).alias("date_path")) for i, d in enumerate(date_paths)))
    wanted = units.select("unit", F.explode(dates).alias("d")).select("unit", "d.*")
    wanted = wanted.withColumn("folder", text.folder(prefix, F.col("date_path"), F.col("unit")))
    found = wanted.join(catalogue.select("date_path", "folder").distinct(), ["date_path", "folder"], "left_semi")
    if first_only:
        return found.groupBy("unit").agg(F.min(F.struct("date_idx", "date_path", "folder")).alias("m")).select("unit", "m.*")
    return found.select("unit", "date_idx", "date_path", "folder")


def land_codes(codes: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Codes that the catalogue has a folder for."""
    listed = catalogue.select(text.folder_parts(F.col("folder"))["code"].alias("code")).where("code is not null").distinct()
    return codes.select("code").distinct().join(listed, "code", "left_semi")


def available_units(codes: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The quarter units of codes that are listed."""
    listed = catalogue.select(text.folder_parts(F.col("folder"))["unit"].alias("unit")).where("unit is not null").distinct()
    return codes.select(F.explode(geo.subtiles(F.col("code"))).alias("unit")).join(listed, "unit", "left_semi")


# The pixels a kernel reaches beyond a tile, and the area of water that a chunk must be able to see whole, in square metres.
HALO = {"average": 1, "bilinear": 1, "gauss": 2, "lanczos": 3}
WATER = 1_500_000.0


def ocean_halo(pixel: Column) -> Column:
    """How many pixels a chunk of ocean needs around it."""
    return F.least(F.greatest(F.ceil(F.lit(math.sqrt(WATER)) / pixel) + 2, F.lit(1)), F.lit(512)).cast("int")


def tile_plan(tiles: DataFrame, size: int, method: str) -> DataFrame:
    """``tiles`` (z, tx, ty) with the window of pixels to render (xoff, yoff, width, height), a halo wider than the tile but within the world; where in it
    the tile lies (core_x, core_y); and the window's bounds (minx, miny, maxx, maxy) in Web Mercator."""
    if method not in HALO:
        raise ValueError(f"no halo is known for {method}")
    world = (F.pow(F.lit(2.0), F.col("z")) * size).cast("long")
    low = lambda t: F.greatest(F.col(t).cast("long") * size - HALO[method], F.lit(0))
    high = lambda t: F.least((F.col(t).cast("long") + 1) * size + HALO[method], world)
    at = lambda c: F.col(c) * geo.pixel_size("z", size)
    out = tiles.withColumns({"xoff": low("tx"), "yoff": low("ty"), "width": high("tx") - low("tx"), "height": high("ty") - low("ty")})
    out = out.withColumns({"core_x": F.col("tx") * size - F.col("xoff"), "core_y": F.col("ty") * size - F.col("yoff"), "_x1": F.col("xoff") + F.col("width"), "_y1": F.col("yoff") + F.col("height")})
    bounds = {"minx": at("xoff") - geo.HALF_WORLD, "miny": geo.HALF_WORLD - at("_y1"), "maxx": at("_x1") - geo.HALF_WORLD, "maxy": geo.HALF_WORLD - at("yoff")}
    return out.withColumns(bounds).drop("_x1", "_y1")


def prefetch(wanted: DataFrame, land: DataFrame, cached: DataFrame, threshold: float) -> DataFrame:
    """(folder, date_path) to fetch ahead, each once however many units want it: of units with enough land (or an unknown share), not cached yet.

    wanted: (unit, folder, date_path); land: (unit, land percent); cached: (folder)."""
    rows = wanted.join(land, "unit", "left").where(masks.has_enough_land(F.col("land"), threshold))
    return rows.select("folder", "date_path").distinct().join(cached.select("folder").distinct(), "folder", "left_anti")


def prune_blocks(blocks: DataFrame, candidates: DataFrame, side: float) -> DataFrame:
    """Blocks (minx, miny, maxx, maxy and others) whose envelopes overlap a candidate's; touching edges do not. Both meet by equal cells of a grid
    of squares of ``side``, so no block is compared with all candidates."""
    span = lambda a, b: F.sequence(F.floor(F.col(a) / side), F.floor(F.col(b) / side))
    spread = lambda df: df.withColumn("_gx", F.explode(span("minx", "maxx"))).withColumn("_gy", F.explode(span("miny", "maxy")))
    box = ("minx", "miny", "maxx", "maxy")
    dealt = spread(candidates.select(*box).distinct()).select("_gx", "_gy", *(F.col(c).alias(f"_{c}") for c in box))
    on = geo.overlaps(tuple(F.col(c) for c in box), tuple(F.col(f"_{c}") for c in box))
    kept = spread(blocks).alias("b").join(dealt.alias("c"), on & (F.col("b._gx") == F.col("c._gx")) & (F.col("b._gy") == F.col("c._gy")), "left_semi")
    return kept.select(*blocks.columns).distinct()


def merge_slabs(slabs: DataFrame, *keys: str) -> DataFrame:
    """The hull of each row's slabs; it may bridge gaps."""
    return slabs.groupBy(*keys, "ty").agg(F.min("tx_min").alias("tx_min"), F.max("tx_max").alias("tx_max"))


def clip_slabs(slabs: DataFrame, tx: tuple[int, int], ty: tuple[int, int]) -> DataFrame:
    """Slabs within a range of tiles."""
    inside = slabs.where(F.col("ty").between(*ty)).withColumns({"tx_min": F.greatest("tx_min", F.lit(tx[0])), "tx_max": F.least("tx_max", F.lit(tx[1]))})
    return inside.where("tx_min <= tx_max")


def contributors(slabs: DataFrame, seq: str = "seq") -> DataFrame:
    """(ty, tx, ids): for each tile what contributes, in the order of ``seq``."""
    cells = slabs.select(seq, "ty", F.explode(F.sequence("tx_min", "tx_max")).alias("tx"))
    return cells.groupBy("ty", "tx").agg(F.sort_array(F.collect_set(seq)).alias("ids"))


def batches(tiles: DataFrame, width: int = 32) -> DataFrame:
    """Runs of neighbouring tiles with the same contributors, at most ``width`` long: (ty, island, batch, tx_min, tx_max, ids)."""
    if width < 1:
        raise ValueError("a batch has at least one tile")
    row = Window.partitionBy("ty").orderBy("tx")
    fresh = (F.lag("tx").over(row).isNull() | (F.lag("tx").over(row) != F.col("tx") - 1) | (F.lag("ids").over(row) != F.col("ids"))).cast("int")
    island = tiles.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(row))
    within = Window.partitionBy("ty", "island").orderBy("tx")
    cut = island.withColumn("batch", F.floor((F.row_number().over(within) - 1) / width).cast("int"))
    return cut.groupBy("ty", "island", "batch").agg(F.min("tx").alias("tx_min"), F.max("tx").alias("tx_max"), F.first("ids").alias("ids"))


def reference_counts(slabs: DataFrame, unit: str = "unit") -> DataFrame:
    """How many tiles each unit contributes to."""
    return slabs.groupBy(unit).agg(F.sum((F.col("tx_max") - F.col("tx_min") + 1).cast("long")).alias("tiles"))


def reuse(wanted: DataFrame, cached: DataFrame, compute, key: str = "unit") -> DataFrame:
    """Cached rows of the wanted keys, and ``compute`` of the keys that are missing."""
    missing = wanted.select(key).distinct().join(cached.select(key).distinct(), key, "left_anti")
    return cached.join(wanted.select(key).distinct(), key, "left_semi").unionByName(compute(missing))


def pending(planned: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    return planned.join(done, list(keys), "left_anti")


def preferred(rows: DataFrame, group: str, date: str, order: Sequence[str], most: int = 2) -> DataFrame:
    """The first rows of each group: listed dates in their order, then the others, newest first."""
    rank: Column = F.coalesce(*(F.when(F.col(date) == d, F.lit(i)) for i, d in enumerate(order)), F.lit(len(order))) if order else F.lit(0)
    by = Window.partitionBy(group).orderBy(rank, F.desc(date))
    return rows.withColumn("place", F.row_number().over(by)).where(F.col("place") <= most)


def estimates(units: int, tile_dates: int, workers: int) -> dict[str, float]:
    """What a run needs: hours of work, memory, traffic and disk, by fixed costs."""
    w = max(workers, 1)
    return {
        "seconds": tile_dates * 15 / w + units * (30 / w + 2), "memory_gb": 8.0 * w, "network_gb": tile_dates * 600 / 1024,
        "peak_gb": (60 * tile_dates + 50 * w + 5 * units + 100) / 1024, "final_mb": 4.0 * units,
    }
