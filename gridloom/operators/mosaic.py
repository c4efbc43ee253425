"""Mosaicking of dated pixels: weighted means, masks, seams, histograms."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import masks
from .focal import dilate
from .staging import few

RGB = ("r", "g", "b")


def weighted_mean(pixels: DataFrame, keys: list[str], weight: Column, bands: tuple[str, ...] = RGB) -> DataFrame:
    """(keys, bands, valid): the weighted mean of complete observations; their plain mean where all weights are zero."""
    whole = masks.complete_rgb(*(F.col(b) for b in bands))
    w = F.when(whole, weight)
    sums = [F.sum(w * F.col(b)).alias(f"w_{b}") for b in bands] + [F.sum(F.when(whole, F.col(b))).alias(f"s_{b}") for b in bands]
    rows = pixels.groupBy(*keys).agg(F.sum(w).alias("w"), F.count_if(whole).alias("n"), *sums)
    mean = lambda b: F.when(F.col("w") > 0, F.col(f"w_{b}") / F.col("w")).when(F.col("n") > 0, F.col(f"s_{b}") / F.col("n"))
    return rows.select(*keys, *(mean(b).alias(b) for b in bands), (F.col("n") > 0).alias("valid"))


def stack_bands(rows: DataFrame, keys: list[str], band: str, value: str, bands: tuple[str, ...] = RGB) -> DataFrame:
    """One row a cell from one row a cell and band; a missing band is null."""
    return rows.groupBy(*keys).agg(*(F.max(F.when(F.col(band) == b, F.col(value))).alias(b) for b in bands))


def apply_mask(mosaic: DataFrame, keys: list[str]) -> DataFrame:
    """Null outside of ``allowed``; covered cells beside valid ones become seams; what is further than a cell from valid ones ends.

    mosaic: keys, row, col, r, g, b, valid, covered, allowed. Adds seam and keep."""
    own = mosaic.withColumns({b: F.when(F.col("allowed"), F.col(b)) for b in RGB} | {"valid": F.col("valid") & F.col("allowed")})
    near = dilate(own, keys, "valid").withColumnRenamed("dilated", "near")
    seam = F.col("covered") & ~F.col("allowed") & F.col("near")
    return near.withColumn("seam", seam).withColumn("keep", (F.col("allowed") | F.col("seam")) & F.col("near")).drop("near")


def align(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A raster joined to another cell by cell; without a partner the columns are null."""
    return left.join(right, keys, "left")


def latest_source(sources: DataFrame, keys: list[str], priority: str, alpha: str = "a") -> DataFrame:
    """A virtual mosaic: for each cell the row of the highest priority that is not transparent."""
    rest = [c for c in sources.columns if c not in keys]
    top = F.max_by(F.struct(*rest), priority).alias("top")
    return sources.where(F.col(alpha) > 0).groupBy(*keys).agg(top).select(*keys, "top.*")


@F.pandas_udf(T.BooleanType())
def is_whole(data: pd.Series, height: pd.Series, width: pd.Series, side: pd.Series) -> pd.Series:
    """Whether a block has all ``side`` x ``side`` cells and a value in each."""
    return pd.Series([h == w == n and not np.isnan(np.frombuffer(x, "<f8")).any() for x, h, w, n in zip(data, height, width, side, strict=True)])


def by_footprints(blocks: DataFrame, footprints: DataFrame, window: tuple[int, int, int, int] | None = None, pixel: float | None = None, side: int = 256) -> DataFrame:
    """A virtual mosaic in blocks, greater ``seq`` on top: (br, bc, height, width, data, top, mixed); top: for each cell the source's seq, NaN where none has a value.

    blocks: (source, br, bc, height, width, data, whole) on one grid. footprints: (source, seq, r0, r1, c0, c1: its cells, the last left out, px). What is read is
    settled before any value is: sources whose footprint misses the window (r0, r1, c0, c1) or whose pixels are coarser than ``pixel`` are out, and so are
    blocks outside of it. Where a whole block lies on others it hides them, and where one block is left it goes on as it is; only
    contested blocks are folded cell by cell, a group being the sources that overlap there."""
    used = footprints if pixel is None else footprints.where(F.col("px") <= pixel * (1 + 1e-9))
    kept = blocks
    if window:
        r0, r1, c0, c1 = window
        used = used.where((F.col("r0") < r1) & (F.col("r1") > r0) & (F.col("c0") < c1) & (F.col("c1") > c0))
        kept = kept.where((F.col("br") * side < r1) & ((F.col("br") + 1) * side > r0) & (F.col("bc") * side < c1) & ((F.col("bc") + 1) * side > c0))
    used = used.select("source", "seq", *(F.col(c).alias(f"_{c}") for c in ("r0", "r1", "c0", "c1")))
    meets = (F.col("br") * side < F.col("_r1")) & ((F.col("br") + 1) * side > F.col("_r0")) & (F.col("bc") * side < F.col("_c1")) & ((F.col("bc") + 1) * side > F.col("_c0"))
    kept = kept.join(F.broadcast(used) if few(used) else used, "source").where(meets).select("seq", "br", "bc", "height", "width", "whole", "data")
    at = ["br", "bc"]
    floor = kept.groupBy(*at).agg(F.max(F.when(F.col("whole"), F.col("seq"))).alias("floor"), F.collect_list("seq").alias("all"))
    floor = floor.select(*at, "floor", F.size(F.filter("all", lambda x: F.col("floor").isNull() | (x >= F.col("floor")))).alias("left"))
    seen = kept.join(floor, at).where(F.col("floor").isNull() | (F.col("seq") >= F.col("floor")))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        h, w = int(pdf["height"].max()), int(pdf["width"].max())
        data, top = np.full((h, w), np.nan), np.full((h, w), np.nan)
        for seq, a, b, raw in sorted(zip(*(pdf[c] for c in ("seq", "height", "width", "data")), strict=True)):
            own = np.frombuffer(raw, "<f8").reshape(a, b)
            there = ~np.isnan(own)
            data[:a, :b][there], top[:a, :b][there] = own[there], seq
        return pd.DataFrame({"br": pdf["br"].iloc[:1], "bc": pdf["bc"].iloc[:1], "height": [h], "width": [w], "data": [data.astype("<f8").tobytes()], "top": [top.astype("<f8").tobytes()]})

    @F.pandas_udf("binary")
    def alone(seq: pd.Series, data: pd.Series) -> pd.Series:
        return pd.Series([np.where(np.isnan(v := np.frombuffer(x, "<f8")), np.nan, float(s)).tobytes() for s, x in zip(seq, data, strict=True)])

    shape = "br int, bc int, height int, width int, data binary, top binary"
    one = seen.where("left = 1").select(*at, "height", "width", "data", alone("seq", "data").alias("top"), F.lit(False).alias("mixed"))
    return one.unionByName(seen.where("left > 1").select("seq", *at, "height", "width", "data").groupBy(*at).applyInPandas(fold, shape).withColumn("mixed", F.lit(True)))


def histogram(values: DataFrame, value: Column, bins: int = 128) -> DataFrame:
    """(bin, count, share of the largest bin) of values within 0..1, the last bin closed on both sides; empty bins too. Without any value there is no largest bin, and shares are null."""
    spark = values.sparkSession
    counts = values.select(value.alias("v")).where("v >= 0 and v <= 1").groupBy(F.least(F.floor(F.col("v") * bins), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("count"))
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin")).join(counts, "bin", "left").fillna(0, ["count"])
    top = counts.agg(F.max("count").alias("top"))
    return all_bins.join(F.broadcast(top)).select("bin", "count", (F.col("count") / F.col("top")).alias("share"))
