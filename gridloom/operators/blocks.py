"""Kernels over blocks of a raster: each block gets the cells around it that the kernel reaches, and is worked on as an array.

One shuffle carries the cells and the rims; a block is a bounded group, and many small ones share a call. The cells'
other columns are carried along unchanged."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Arrays = dict[str, np.ndarray]
ROOM = 1 << 22  # cells of a stack of blocks


def halo(cells: DataFrame, keys: list[str], block: int, width: int) -> DataFrame:
    """Cells with the blocks (br, bc) whose kernels need them: their own, and neighbours within ``width`` cells; core tells which is their own."""
    if width > block:
        raise ValueError("a halo is at most a block wide")
    near = lambda c: F.array_distinct(F.transform(F.array(F.lit(-width), F.lit(0), F.lit(width)), lambda d: F.floor((F.col(c) + d) / block).cast("int")))
    wide = cells.select("*", F.explode(near("row")).alias("br")).select("*", F.explode(near("col")).alias("bc"))
    return wide.withColumn("core", (F.floor(F.col("row") / block) == F.col("br")) & (F.floor(F.col("col") / block) == F.col("bc")))


def _codes(table: pa.Table, names: Sequence[str]) -> np.ndarray:
    """One row of numbers for each row of the table, equal where all of the columns are; nulls are equal."""
    out = []
    for n in names:
        found = table.column(n).combine_chunks().dictionary_encode()
        found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
        out.append(found.indices.fill_null(-1).to_numpy(zero_copy_only=False))
    return np.stack(out, 1)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    """A column as doubles, null as NaN."""
    return table.column(name).cast(pa.float64()).to_numpy().astype(float)


def whole_groups(batches: Iterator[pa.RecordBatch], by: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, from batches that are sorted by their columns ``by``, and where each group begins."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.concat_tables([*held, pa.Table.from_batches([batch])])
        code = _codes(table, by)
        start = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]).any(1)])
        if start[-1]:
            yield table.slice(0, start[-1]), start[:-1]
        held = [table.slice(start[-1])]
    if held:
        yield held[0], np.zeros(1, np.int64)


def stacks(table: pa.Table, start: np.ndarray, names: Sequence[str]) -> Iterator[tuple[np.ndarray, Arrays, np.ndarray, tuple]]:
    """Groups of cells of the same shape as stacks: (rows of the table, arrays by name with NaN where no cell is, whether a cell
    is there, (stack, row, col) of each of the rows)."""
    row, col = (table.column(c).to_numpy().astype(np.int64) for c in ("row", "col"))
    group = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(row)]))
    r0, c0 = np.minimum.reduceat(row, start), np.minimum.reduceat(col, start)
    shape = np.stack([np.maximum.reduceat(row, start) - r0 + 1, np.maximum.reduceat(col, start) - c0 + 1], 1)
    values = {n: _numbers(table, n) for n in names}
    for h, w in np.unique(shape, axis=0).tolist():
        same = np.flatnonzero((shape == (h, w)).all(1))
        for part in np.array_split(same, -(-len(same) * h * w // ROOM)):
            place = np.full(len(start), -1)
            place[part] = np.arange(len(part))
            rows = np.flatnonzero(place[group] >= 0)
            g = group[rows]
            at = place[g], row[rows] - r0[g], col[rows] - c0[g]
            there = np.zeros((len(part), h, w), bool)
            there[at] = True
            arrays = {n: np.full((len(part), h, w), np.nan) for n in names}
            for n, a in arrays.items():
                a[at] = values[n][rows]
            yield rows, arrays, there, at


def on_blocks(cells: DataFrame, keys: list[str], values: Sequence[str], width: int, kernel: Callable[[Arrays, np.ndarray], Arrays], out: Mapping[str, str], block: int = 256, drop: bool = False) -> DataFrame:
    """``cells`` (keys, row, col and others, one row a cell) and the columns ``out`` (name and type) that ``kernel`` makes.

    kernel: takes the values as arrays (stack, row, col), NaN where null or no cell is, and whether a cell is there; gives arrays of that
    shape, right where all within ``width`` cells is there or beyond the raster. NaN is null, or with ``drop`` leaves the row out."""
    width = max(width, 0)
    block = max(block, width)
    group = [*keys, "_br", "_bc"]
    carried = cells.columns
    dealt = halo(cells, keys, block, width).withColumnsRenamed({"br": "_br", "bc": "_bc", "core": "_core"})
    dealt = dealt.repartition(*group).sortWithinPartitions(*group)
    types = {"double": pa.float64(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, start in whole_groups(batches, group):
            core = table.column("_core").to_numpy()
            for rows, arrays, there, at in stacks(table, start, values):
                keep = core[rows]
                if not keep.any():
                    continue
                made = {n: a[at] for n, a in kernel(arrays, there).items()}
                if drop:
                    keep = keep & ~np.any([np.isnan(a) for a in made.values() if a.dtype.kind == "f"], axis=0)
                found = table.select(carried).take(pa.array(rows[keep]))
                for n, kind in out.items():
                    a = made[n][keep]
                    null = np.isnan(a) if a.dtype.kind == "f" else None
                    if null is not None and kind != "double":
                        a = np.where(null, 0, a)
                    found = found.append_column(n, pa.array(a, mask=null).cast(types[kind]))
                yield from found.combine_chunks().to_batches()

    kinds = dict(cells.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in carried), *(f"`{n}` {t}" for n, t in out.items())])
    return dealt.mapInArrow(run, schema)
