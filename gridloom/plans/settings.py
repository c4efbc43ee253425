"""Run settings: differences, digests, and statistics of a run."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def flatten(settings: Mapping[str, Any], prefix: str = "") -> dict[str, str]:
    """Dotted keys to values as JSON; tuples are lists."""
    out = {}
    for key, value in settings.items():
        name = f"{prefix}{key}"
        if isinstance(value, Mapping):
            out |= flatten(value, f"{name}.")
        else:
            out[name] = json.dumps(value, sort_keys=True)
    return out


def to_frame(spark: SparkSession, run: str, settings: Mapping[str, Any]) -> DataFrame:
    return spark.createDataFrame([(run, k, v) for k, v in flatten(settings).items()], "run string, key string, value string")


def differences(old: DataFrame, new: DataFrame, missing: str = "<missing>") -> DataFrame:
    """(key, change) of the keys whose values differ, as ``key: old -> new``."""
    a, b = old.select("key", F.col("value").alias("old")), new.select("key", F.col("value").alias("new"))
    both = a.join(b, "key", "full_outer").where(~F.col("old").eqNullSafe(F.col("new")))
    show = lambda c: F.coalesce(c, F.lit(missing))
    return both.select("key", F.concat("key", F.lit(": "), show("old"), F.lit(" -> "), show("new")).alias("change"))


def signature(settings: DataFrame) -> DataFrame:
    """(run, digest): one digest of all of a run's settings, whatever their order."""
    pairs = F.array_sort(F.collect_list(F.concat_ws("=", "key", "value")))
    return settings.groupBy("run").agg(F.sha2(F.array_join(pairs, "\n"), 256).alias("digest"))


def render_statistics(tiles: DataFrame, status: str = "status") -> DataFrame:
    """(status, n) with a row ``total``."""
    return tiles.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("n")).unionByName(tiles.agg(F.count("*").alias("n")).select(F.lit("total").alias("status"), "n"))
