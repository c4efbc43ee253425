"""The ocean's background of one large raster, chunk by chunk, in runs that go on where the last one stopped.

A chunk is cut with as many cells around it as the kernels reach. Two tables in one folder, both partitioned by chunk, hold what has been made:
``cells``, and ``manifest`` with the digest of the settings that made a chunk and whether anything of it shows. A run
computes the chunks whose manifest is missing or of other settings, replaces the partitions of these alone, cells first and the manifest last; a run
that is cut off in between leaves chunks that count as not made. A chunk without anything to show is marked and has no cells."""

from __future__ import annotations

import json
from collections.abc import Mapping
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import color, masks
from ..operators import focal
from ..operators.blocks import halo
from ..operators.staging import staged, unstaged

CELLS = "row int, col int, r int, g int, b int, a int, digest string, chunk string"
MANIFEST = "digest string, status string, chunk string"
RENDERED, EMPTY = "rendered", "empty"


def digest(settings: Mapping[str, object]) -> str:
    """One digest of settings, whatever their order."""
    return sha256(json.dumps(dict(settings), sort_keys=True).encode()).hexdigest()


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(digest, status, chunk) of what has been made."""
    return _table(spark, f"{path}/manifest", MANIFEST)


def made(spark: SparkSession, path: str) -> DataFrame:
    """(row, col, r, g, b, a) of the chunks that show something, each by the settings that its manifest names."""
    known = manifest(spark, path).where(F.col("status") == RENDERED)
    return _table(spark, f"{path}/cells", CELLS).join(known, ["chunk", "digest"], "left_semi").select("row", "col", "r", "g", "b", "a")


def reach(settings: Mapping[str, object]) -> int:
    """How far the kernels look: slopes one cell, the blur and the erosion as they are set, one after the other."""
    sigma = float(settings.get("sigma", 0.0))
    return max(1, int(settings.get("erosion", 0)) + (int(4 * sigma + 0.5) if sigma else 0))


def render(cells: DataFrame, settings: Mapping[str, object]) -> DataFrame:
    """(chunk, row, col, own, r, g, b, a) of chunks' cells (chunk, row, col, own, depth)."""
    sigma, nodata = float(settings.get("sigma", 0.0)), float(settings.get("nodata", -32767.0))
    now = cells.withColumn("_depth", F.col("depth"))
    if sigma:
        now = focal.blur(now, ["chunk"], "depth", sigma, nodata).drop("depth").withColumnRenamed("blurred", "depth")
    wet = now.withColumn("_wet", F.coalesce(masks.ocean(F.col("depth"), nodata, float(settings.get("fade", -50.0))), F.lit(False)))
    if settings.get("erosion"):
        wet = focal.erode(wet, ["chunk"], "_wet", int(settings["erosion"])).drop("_wet").withColumnRenamed("eroded", "_wet")
    lit = focal.hillshade(wet, ["chunk"], "_depth", float(settings.get("z_factor", 5.0)), float(settings.get("pixel", 1.0)))
    rgb = color.hillshade_modulate(color.ramp(F.col("_depth") * float(settings.get("scale", 1.0))), F.col("shade"))
    return lit.select("chunk", "row", "col", "own", *(color.to_byte(c).alias(n) for c, n in zip(rgb, "rgb", strict=True)), F.when(F.col("_wet"), 255).otherwise(0).alias("a"))


def build(cells: DataFrame, path: str, settings: Mapping[str, object], chunk: int = 8192, only: DataFrame | None = None) -> DataFrame:
    """Brings the background in ``path`` up to date with the raster ``cells`` (row, col, depth) and the settings, and gives (chunk, status)
    of the chunks that this run made, of those in ``only`` (chunk) if that is given. What the settings name as ``source`` stands for the raster: change it when the raster does."""
    spark, own = cells.sparkSession, digest(settings)
    name = lambda r, c: F.concat_ws("_", r.cast("string"), c.cast("string"))
    planned = cells.select(name(F.floor(F.col("row") / chunk), F.floor(F.col("col") / chunk)).alias("chunk")).distinct()
    planned = planned.join(only, "chunk", "left_semi") if only is not None else planned
    todo = staged(planned.join(manifest(spark, path).where(F.col("digest") == own), "chunk", "left_anti"), "todo")
    wide = halo(cells.select("row", "col", "depth"), [], chunk, reach(settings)).withColumn("chunk", name(F.col("br"), F.col("bc"))).drop("br", "bc").withColumnRenamed("core", "own")
    shown = staged(render(wide.join(todo, "chunk", "left_semi"), settings).where("own").drop("own"), "chunks")
    status = todo.join(shown.groupBy("chunk").agg(F.max("a").alias("a")), "chunk", "left").select("chunk", F.when(F.col("a") > 0, RENDERED).otherwise(EMPTY).alias("status"))
    status = staged(status, "status")
    # A file a chunk takes a task longer than its few bytes tell: an even share of the chunks for each task, which is not to be merged with others.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    visible = shown.join(status.where(F.col("status") == RENDERED), "chunk", "left_semi").withColumn("digest", F.lit(own))
    for rows, part in ((visible.select("row", "col", "r", "g", "b", "a", "digest", "chunk").repartition(tasks, "chunk"), "cells"), (status.select(F.lit(own).alias("digest"), "status", "chunk").repartition(tasks, "chunk"), "manifest")):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk").parquet(f"{path}/{part}")
    unstaged(shown)
    return status
