"""Streams over landing folders: tiles kept up to date by key, and scenes counted by windows of event time.

An addition of this engine: what it extends has no stream of its own, only runs that resume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.staging import folder


def landing(spark: SparkSession, path: str, schema: str, files_at_once: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def upsert_tiles(stream: DataFrame, target: str, checkpoint: str, keys: tuple[str, ...] = ("z", "tx", "ty"), order: str = "seq") -> StreamingQuery:
    """Appends each micro-batch's last row of a key as a version of its own under ``target``; a batch that is repeated replaces itself.

    ``current`` reads the newest version of each key, so writes never rewrite what is there."""

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = Window.partitionBy(*keys).orderBy(F.desc(order))
        rows = batch.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n").withColumn("batch", F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, target: str, keys: tuple[str, ...] = ("z", "tx", "ty")) -> DataFrame:
    newest = Window.partitionBy(*keys).orderBy(F.desc("batch"))
    return spark.read.parquet(target).withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def settled(counts: DataFrame) -> DataFrame:
    """What a stream's aggregate comes to when all that is there has been read, as a table in the shared folder."""
    spark = counts.sparkSession
    path = folder(spark, "stream")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{path}/out/at={batch_id}")

    query = counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.lastProgress is None:
        return spark.createDataFrame([], counts.schema)
    rows = spark.read.schema(counts.schema.add("batch", "long")).parquet(f"{path}/out")
    return rows.join(F.broadcast(rows.agg(F.max("batch").alias("batch"))), "batch").drop("batch", "at")


def scene_counts(stream: DataFrame, at: str = "ts", kind: str = "event_type", window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts by window and kind; rows later than the watermark are dropped."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")
