"""The star schema's tables seen as rasters, tiles, catalogues and scenes: integer arithmetic on keys,
so that any engine derives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as places: (id, lon, lat)."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("id"), ((k * 7919) % 360000 / 1000.0 - 180.0).alias("lon"), ((k * 10473) % 170000 / 1000.0 - 85.0).alias("lat")
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as two-date pixels: (unit, row, col, date_idx, r, g, b); one row a cell and date, no data as null."""
    raw = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 64).cast("int").alias("unit"), (F.col("l_suppkey") % 32).cast("int").alias("row"), (F.col("l_partkey") % 32).cast("int").alias("col"),
        (F.col("l_linenumber") % 2).alias("date_idx"), (F.col("l_returnflag") == "R").alias("bad"),
        (F.floor("l_quantity") * 180).alias("r"), F.floor(F.col("l_extendedprice") / 12).alias("g"), F.floor(F.col("l_discount") * 90000 + 0.5).alias("b"),
    )
    mean = lambda c: F.when(~F.bool_or("bad"), F.expr(f"sum({c}) div count(*)")).cast("long").alias(c)
    return raw.groupBy("unit", "row", "col", "date_idx").agg(mean("r"), mean("g"), mean("b"))


def grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 8 x 8 rasters of depth: (raster_id, row, col, depth)."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("raster_id"), F.posexplode("embedding").alias("pos", "v"))
    return e.select("raster_id", F.floor(F.col("pos") / 8).cast("int").alias("row"), (F.col("pos") % 8).alias("col"), (F.col("v").cast("double") * 400 - 20).alias("depth"))


def mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rasters of ``grids`` side by side, 64 to a row, as one raster: (raster_id, row, col, depth)."""
    i = F.col("raster_id")
    row, col = F.floor(i / 64) * 8 + F.col("row"), i % 64 * 8 + F.col("col")
    return grids(spark, sf_dir).select("raster_id", row.cast("int").alias("row"), col.cast("int").alias("col"), "depth")


def slabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as row slabs of work units: (seq, unit, ty, tx_min, tx_max)."""
    o = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        o.alias("seq"), (o % 97).cast("int").alias("unit"), (F.col("o_custkey") % 64).cast("int").alias("ty"), (o % 50).cast("int").alias("tx_min"), (o % 50 + o % 7).cast("int").alias("tx_max")
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a store's listing: (date_path, folder)."""
    d, k = F.col("o_orderdate"), F.col("o_custkey")
    date_path = F.concat(F.year(d), F.lit("/"), F.lpad((F.quarter(d) * 3 - 2).cast("string"), 2, "0"), F.lit("/01"))
    unit = F.concat(F.lpad((k % 60 + 1).cast("string"), 2, "0"), F.lit("T"), F.chr(65 + k % 8), F.chr(65 + (k / 8).cast("long") % 8), F.lit("_"), (k % 2).cast("string"), F.lit("_"), ((k / 2).cast("long") % 2).cast("string"))
    listed = table(spark, sf_dir, "orders").select(date_path.alias("date_path"), unit.alias("unit"))
    return listed.select("date_path", F.concat(F.lit("Scene_mosaic_"), F.split_part("date_path", F.lit("/"), F.lit(1)), F.lit("_Q"), F.floor((F.substring("date_path", 6, 2).cast("int") + 2) / 3).cast("string"), F.lit("_"), F.col("unit")).alias("folder"), "unit").distinct()


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scene records: (seq, entity, start string, k), every eleventh without a start."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), F.when(F.col("event_id") % 13 != 0, F.col("user_id")).alias("entity"),
        F.when(F.col("event_id") % 11 != 0, F.date_format("ts", "yyyy-MM-dd")).alias("start"), F.get_json_object("props", "$.k").alias("k"),
    )
