"""Tables written to the folder that the cluster shares and read again: cut lineage that survives lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own if unset.

    Only a session on one machine may leave it unset; on a cluster each executor would write to a disk of its own."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    sc = spark.sparkContext
    if (own := sc._jsc.sc().getCheckpointDir()).isEmpty():
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='spark-')}")
        own = sc._jsc.sc().getCheckpointDir()
    return own.get()


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def staged(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts the lineage in a form that survives lost executors and is smaller than a checkpoint of rows."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstaged(df: DataFrame) -> None:
    """Delete the folder of a ``staged`` table that nothing reads any more."""
    for place in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        jpath = df.sparkSession._jvm.org.apache.hadoop.fs.Path(place)
        jpath.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jpath, True)


def few(df: DataFrame, rows: int = 20_000) -> bool:
    """Whether a table is small enough to broadcast."""
    return df.limit(rows + 1).count() <= rows


def per_group(rows: DataFrame, keys: Sequence[str], make: Callable[[dict[str, np.ndarray]], tuple | None], schema: str) -> DataFrame:
    """A row, or none, of each group of rows: ``make`` gets the group's columns. The rows of a partition come in order of the keys and in batches, so that small
    groups share a call, and no more is held than a batch and the group that is open."""
    names = [c.split()[0].strip("`") for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[dict[str, np.ndarray]] = []

        def closed() -> tuple | None:
            whole = held[0] if len(held) == 1 else {c: np.concatenate([h[c] for h in held]) for c in held[0]}
            held.clear()
            return make(whole)

        for b in batches:
            if not len(b):
                continue
            now = {c: b[c].to_numpy() for c in b.columns}
            fresh = np.zeros(len(b), bool)
            for k in keys:
                fresh[1:] |= now[k][1:] != now[k][:-1]
                fresh[0] |= bool(held) and held[-1][k][-1] != now[k][0]
            cuts = [*np.flatnonzero(fresh).tolist(), len(b)]
            out, at = [], 0
            for i, cut in enumerate(cuts):
                if cut > at:
                    held.append({c: v[at:cut] for c, v in now.items()})
                if i < len(cuts) - 1:
                    out.append(closed())
                at = cut
            # A view would keep the batch for as long as the group is open.
            held[-1] = {c: v.copy() for c, v in held[-1].items()}
            yield pd.DataFrame([r for r in out if r is not None], columns=names)
        if held:
            yield pd.DataFrame([r for r in [closed()] if r is not None], columns=names)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)
