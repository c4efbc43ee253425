"""What several of the corpus operators share: reading tables, cutting lineage, components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import components
from ..operators.staging import few, shared_dir, staged, unstaged

__all__ = ["carried", "components", "few", "kind_of", "map_texts", "restored", "shared_dir", "staged", "table", "unstaged", "with_hot"]

HOT = 20_000

WHOLE = ("tinyint", "smallint", "int", "bigint")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data folder, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_hot(rows: DataFrame, small: DataFrame, by: list[str], n: str, how: str = "inner", bound: int = HOT) -> DataFrame:
    """``rows`` joined (inner or left) with ``small``, one row a key, of which ``n`` says how many rows it meets. Keys with over ``bound`` rows are broadcast, so that
    their rows stay where they are; there are few of them, which is checked, and the other keys are dealt out as in any join. No key is null."""
    hot = small.where(F.col(n) > bound)
    if hot.isEmpty() or not few(hot):
        return rows.join(small, by, how)
    rest = rows.join(F.broadcast(hot.select(*by)), by, "left_anti").join(small.where(F.col(n) <= bound), by, how)
    return rows.join(F.broadcast(hot), by).unionByName(rest)


def map_texts(rows: DataFrame, text: str, made: Callable[[], Callable[[str | None], Iterable[tuple]]], out: str, limit: int = 20_000) -> DataFrame:
    """The other columns of ``rows`` and the columns ``out`` (a schema), a row for each tuple that ``made()``, called once a task,
    gives for a text. Texts are decoded one at a time and what is made leaves in parts of about ``limit`` rows, so that a
    task holds no more than Spark's own batch; the other columns pass through Arrow unchanged, nulls and large numbers too."""
    kept = [c for c in rows.columns if c != text]
    schema = ", ".join([*(f"`{c}` {kind_of(rows, c)}" for c in kept), out])
    made_schema = _arrow_schema(rows.sparkSession, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = made()

        def part(batch: pa.RecordBatch, at: list[int], found: list[tuple]) -> pa.RecordBatch:
            own = [batch.column(c).take(pa.array(at, pa.int32())) for c in kept]
            new = [pa.array(v, f.type) for v, f in zip(zip(*found, strict=True) if found else [[]] * len(made_schema), made_schema, strict=True)]
            return pa.RecordBatch.from_arrays([*own, *new], names=[*kept, *made_schema.names])

        for batch in batches:
            at, found = [], []
            for i, x in enumerate(batch.column(text)):
                for values in of(x.as_py()):
                    at.append(i)
                    found.append(values)
                if len(at) >= limit:
                    yield part(batch, at, found)
                    at, found = [], []
            yield part(batch, at, found)

    return rows.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def kind_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def carried(df: DataFrame, name: str) -> tuple[Column, str]:
    """A key as it goes through pandas, and its type there: whole numbers go as text, as pandas turns them into floats, exact only
    below 2^53, where a null stands beside them. ``restored`` turns them back."""
    kind = kind_of(df, name)
    return (F.col(name).cast("string"), "string") if kind in WHOLE else (F.col(name), kind)


def restored(df: DataFrame, name: str, kind: str, to: str | None = None) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(kind)}).withColumnRenamed(name, to or name)
