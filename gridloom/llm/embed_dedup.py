"""Embedding near-duplicates by counting collisions of one-dimensional projections.

Unit vectors are projected onto an orthonormal basis, a fixed random rotation. For a pair with cosine >= c the squared
differences of all projections sum to at most 2 - 2c, so at most (2 - 2c) / w^2 of them can lie outside a window of
half-width w around the query's value. The count that a pair must reach among ``COUNTED`` projections is
calibrated by this bound: its recall is 1, whatever the data. Pairs that reach it are verified in double precision.

1. Each label's most selective projection, that of the largest variance, files its rows by cells as wide as the largest
   difference that a link allows, so partners stand in the same cell or the next. Full cells are dealt out as pairs of blocks.
2. In a pair of blocks every projection's values are sorted. A query's windows are looked up in all the sorted
   lists, and how often each row stands in them is counted: rows outside of the windows are never touched.
3. Rows with enough collisions are verified. A task emits counts of links and a spanning forest, never the pairs.

Exact copies are collapsed before, by 128-bit hashes. A label whose vectors point everywhere is narrowed little by one projection,
so that its work grows with the square of its size.

Defined cases: a null label, a null, empty or zero vector, and one with null or non-finite
components link with nothing; vectors of different length never link; a null vec_id keeps its row; rows repeated with the same id are
vectors of their own; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, few, staged, table, with_hot

COSINE, WINDOW, COUNTED, BLOCK, SALTS = 0.98, 0.05, 32, 2048, 16


@functools.lru_cache(16)
def rotation(dim: int) -> np.ndarray:
    """A fixed random orthonormal basis, by columns."""
    return np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))[0]


def projections(x: np.ndarray, counted: int) -> np.ndarray:
    """The projections of unit vectors, by columns."""
    return ((x / np.linalg.norm(x, axis=1)[:, None]) @ rotation(x.shape[1])[:, :counted]).astype(np.float32)


def allowed_misses(cosine: float, window: float) -> int:
    return math.ceil((2 - 2 * cosine + 1e-9) / window**2) - 1


def collisions(a: np.ndarray, b: np.ndarray, window: float, misses: int) -> Iterator[np.ndarray]:
    """For each row of ``a`` (projections by columns) the rows of ``b`` that stand in enough of its windows."""
    lists = [np.argsort(b[:, k], kind="stable") for k in range(b.shape[1])]
    half = np.float32(window + 1e-5)
    ends = [(np.searchsorted(b[at, k], a[:, k] - half, "left"), np.searchsorted(b[at, k], a[:, k] + half, "right")) for k, at in enumerate(lists)]
    low, high = (np.array([e[s] for e in ends]).T.tolist() for s in (0, 1))
    need = b.shape[1] - misses
    for x, y in zip(low, high, strict=True):
        met = np.concatenate([at[p:q] for at, p, q in zip(lists, x, y, strict=True)])
        yield np.flatnonzero(np.bincount(met, minlength=len(b)) >= need)


def meeting(a: np.ndarray, b: np.ndarray, cosine: float, window: float, counted: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of a and b with enough collisions and the cosine; same: a is b, pairs once."""
    pa, pb = projections(a, counted), projections(b, counted)
    norm_a, norm_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, j in enumerate(collisions(pa, pb, window, allowed_misses(cosine, window))):
        j = j[j > i] if same else j
        j = j[(b[j] * a[i]).sum(1) / (norm_a[i] * norm_b[j]) >= cosine]
        left.append(np.full(len(j), i))
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def near_duplicates(vectors: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding", cosine: float = COSINE, window: float = WINDOW, counted: int = COUNTED, block: int = BLOCK) -> DataFrame:
    """Rows (key, n_links long, component_id, kept boolean)."""
    reach = math.sqrt(2 - 2 * cosine) + 1e-5  # projections are single precision
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), v.alias("v"))
    fine = F.coalesce(fine_at("label", "v"), F.lit(False))
    rows = rows.select("*", F.when(fine, F.xxhash64("label", "v")).alias("h1"), F.when(fine, F.xxhash64(F.lit("again"), "v", "label")).alias("h2"))
    rows = staged(rows, "vectors")
    own = rows.where("h1 is not null").groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("key").alias("least"), F.first("label").alias("label"), F.first("v").alias("v"))
    own = staged(own.withColumn("node", F.monotonically_increasing_id()), "distinct")

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            values = np.empty(len(b), object)
            for at in b.groupby(b["v"].map(len)).indices.values():
                for i, x in zip(at, projections(np.stack(b["v"].iloc[at].to_list()), counted), strict=True):
                    values[i] = x
            yield b.assign(dim=b["v"].map(len), p=values)

    kinds = dict(rows.dtypes)
    filed = own.select("label", "node", "n", "v").mapInPandas(project, f"label {kinds['label']}, node long, n long, v array<double>, dim int, p array<float>")
    filed = staged(filed, "projected")
    spread = filed.groupBy("label", "dim").agg(*(F.var_pop(F.get("p", F.lit(i))).alias(f"s{i}") for i in range(counted)))
    widths = F.array(*(F.coalesce(F.col(f"s{i}"), F.lit(-1.0)) for i in range(counted)))
    spread = staged(spread.select("label", "dim", (F.array_position(widths, F.array_max(widths)) - 1).cast("int").alias("axis")), "axes")
    filed = _with_few(filed, spread, ["label", "dim"]).withColumn("cell", F.floor(F.get("p", F.col("axis")) / reach).cast("int")).drop("p", "axis")
    size = staged(filed.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "cells")
    after = size.select("label", "dim", (F.col("cell") - 1).alias("cell"), F.col("blocks").alias("next"))
    before = size.select("label", "dim", (F.col("cell") + 1).alias("cell"), F.col("blocks").alias("prev"))
    where = ["label", "dim", "cell"]
    size = size.join(after, where, "left").join(before, where, "left")
    cut = _with_few(filed, size, where).withColumn("sub", F.pmod(F.hash("node"), F.col("blocks")))
    # Each row goes to its block's meetings: with the blocks of its cell, and with those of the next and the previous cell.
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    meet = F.concat(
        F.transform(upto(F.col("blocks")), lambda i: F.struct(F.col("cell").alias("cell"), F.lit(0).alias("gap"), F.least("sub", i).alias("p"), F.greatest("sub", i).alias("q"), (F.col("sub") <= i).alias("first"), (F.col("sub") == i).alias("same"))),
        F.transform(upto(F.coalesce("next", F.lit(0))), lambda i: F.struct(F.col("cell").alias("cell"), F.lit(1).alias("gap"), F.col("sub").alias("p"), i.alias("q"), F.lit(True).alias("first"), F.lit(False).alias("same"))),
        F.transform(upto(F.coalesce("prev", F.lit(0))), lambda i: F.struct((F.col("cell") - 1).alias("cell"), F.lit(1).alias("gap"), i.alias("p"), F.col("sub").alias("q"), F.lit(False).alias("first"), F.lit(False).alias("same"))),
    )
    met = cut.select("label", "dim", "node", "n", "v", F.explode(meet).alias("m")).select("label", "dim", F.col("m.cell").alias("cell"), "m.gap", "m.p", "m.q", "m.first", "m.same", "node", "n", "v")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        same = bool(pdf["same"].iloc[0])
        left = pdf[pdf["first"]]
        right = left if same else pdf[~pdf["first"]]
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "links": [], "to": []}).astype({"node": "int64", "links": "int64", "to": "Int64"})
        a, b = np.stack(left["v"].to_list()), np.stack(right["v"].to_list())
        i, j = meeting(a, b, cosine, window, counted, same)
        na, nb = left["node"].to_numpy(), right["node"].to_numpy()
        links: dict[int, int] = {}
        for own, other, weight in ((na[i], nb[j], right["n"].to_numpy()[j]), (nb[j], na[i], left["n"].to_numpy()[i])):
            nodes, at = np.unique(own, return_inverse=True)
            for x, s in zip(nodes.tolist(), np.bincount(at, weight).tolist(), strict=True):
                links[x] = links.get(x, 0) + int(s)
        root = {x: x for x in links}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for x, y in zip(na[i].tolist(), nb[j].tolist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
        return pd.DataFrame({"node": list(links), "links": list(links.values()), "to": pd.array([find(x) for x in links], "Int64")})

    found = staged(met.groupBy("label", "dim", "cell", "gap", "p", "q").applyInPandas(count, "node long, links long, to long"), "links")
    groups = components(found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    total = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = own.select("h1", "h2", "node", "n", "least").join(total, "node", "left").join(groups, "node", "left")
    named = named.select("h1", "h2", "n", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    named = staged(named, "named")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(named.join(ids, "root").select("h1", "h2", "n", "n_links", "component_id"), "ids")
    # Vectors that take no part have no hash and meet nothing; those of many copies stay where they are.
    out = with_hot(rows.where("h1 is not null").select("key", "h1", "h2"), named, ["h1", "h2"], "n").select("key", "n_links", "component_id")
    none = rows.where("h1 is null").select("key", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast(kinds["key"]).alias("component_id"))
    out = out.unionByName(none)
    # A vector that takes no part is its own component, and so is one whose component has no id.
    return out.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "key").alias("component_id"),
    ).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def fine_at(label: str, v: str):
    """Whether a vector takes part: a label, components that are numbers, and not all of them zero."""
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(label).isNotNull() & F.col(v).isNotNull() & ~odd & F.exists(v, lambda x: x != 0)


def _with_few(rows: DataFrame, small: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` joined with a table of its groups: broadcast if checked to be small, else dealt by salted keys."""
    if few(small):
        return rows.join(F.broadcast(small), by)
    salted = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.hash("node"), F.lit(SALTS))).join(salted, [*by, "salt"]).drop("salt")


def op6_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")
