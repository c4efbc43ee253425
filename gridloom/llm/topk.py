"""Exact top-k by integer inner product, with a precomputed table of distances to many pivots.

Components become floor(64 x). The table holds each row's distances to ``PIVOTS`` pivots: the origin, and rows of a sample
of at most ``SAMPLE``, each the farthest from those before (the sample only shapes the index; every row is
filed and searched). By the triangle inequality the largest difference of two vectors' distances to a pivot bounds
their distance from below, and so their score from above: q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2.

1. Rows are filed by their nearest pivot, then in rings by the distance to it, then by hash: blocks of about ``CANDIDATES``.
2. Each query is answered within its own block. Its k-th best score there is its threshold everywhere else.
3. The table's ranges over a block of queries and a block of candidates bound all scores between them; pairs of blocks
   that stay below all thresholds are eliminated.
4. In what is left, candidates are evaluated in the order of their own bounds, in steps, while the thresholds
   rise, until every bound left is below them; equal bounds are still evaluated, for ties.

Vectors that point nowhere in particular are about equally far from every pivot, so that little is eliminated; the
evaluation in steps is then a product of two blocks, and the work grows as queries times candidates.

Defined cases: vectors null or with null or non-finite components take no part; only vectors of the same length are
compared; a query's own row is left out, and no other with its id: rows that share an id are queries and candidates
of their own; a null vec_id takes no part; fewer candidates than k give all; ties go to the smaller id; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import few, staged, table

TOP, SCALE, EVERY, PIVOTS, SAMPLE, CANDIDATES, QUERIES = 20, 64, 20, 24, 2048, 16_384, 8192
CHUNK, STEP, EARLY, RINGS, LENGTHS = 128, 2048, 6, 64, 10
EXACT = 1 << 53  # doubles hold whole numbers below this


def farthest(x: np.ndarray, n: int) -> np.ndarray:
    """The origin, and rows far from each other: each next one is the farthest from those before."""
    found = [np.zeros(x.shape[1])]
    far = (x**2).sum(1)
    while len(found) < n and far.max(initial=0) > 0:
        found.append(x[far.argmax()])
        far = np.minimum(far, ((x - found[-1]) ** 2).sum(1))
    return np.array(found)


def distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] + (p**2).sum(1) - 2.0 * (x @ p.T), 0))


def upper(q_far: np.ndarray, x_far: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores of each query and candidate, by their rows of the pivot table. Stops adding
    pivots if the first ``EARLY`` eliminate next to nothing: fewer pivots give weaker bounds, but true ones."""
    q, x = np.ascontiguousarray(q_far.T, np.float32), np.ascontiguousarray(x_far.T, np.float32)
    slack = 1e-5 * (1 + max(float(q_far.max()), float(x_far.max())))
    both = (q_far[:, 0] ** 2)[:, None] + x_far[:, 0] ** 2  # the first pivot is the origin
    low, diff = np.zeros(both.shape, np.float32), np.empty(both.shape, np.float32)
    for k in range(len(q)):
        np.subtract(q[k][:, None], x[k], out=diff)
        np.maximum(low, np.abs(diff, out=diff), out=low)
        if k + 1 in (EARLY, len(q)):
            bound = (both * (1 + 1e-9) - np.maximum(low - slack, 0.0).astype(float) ** 2) / 2 + 1e-6
            if (bound < least[:, None]).mean() < 0.1:
                break
    return bound


def search(q: np.ndarray, q_far: np.ndarray, least: np.ndarray, own: np.ndarray, x: np.ndarray, x_far: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places of queries, places of candidates, scores) of each query's best k rows of ``x`` that reach ``least``. own: the
    place of the query's own row in ``x``, or -1."""
    plain = bool(q_far[:, 0].max() * x_far[:, 0].max() < EXACT)
    if plain:  # whole numbers, exact as doubles
        q, x = q.astype(float), x.astype(float)
    for a in range(0, len(q), CHUNK):
        part, t = q[a : a + CHUNK], least[a : a + CHUNK].astype(float)
        top, found = np.full((len(part), k), -np.inf), []
        order = np.arange(len(x))
        if plain:
            bound = upper(q_far[a : a + CHUNK], x_far, t)
            over = (bound - np.where(np.isfinite(t), t, bound.min(1) - 1)[:, None]).max(0)
            order = np.argsort(-over, kind="stable")
            order = order[over[order] >= 0]
        while len(order):
            at, order = order[:STEP], order[STEP:]
            score = part @ x[at].T
            mine = own[a : a + CHUNK, None] == at
            seen = np.where(mine, -np.inf, score)
            top = np.partition(np.concatenate([top, seen], 1), len(at), 1)[:, len(at) :]
            t = np.maximum(t, top.min(1))
            i, j = np.nonzero((seen >= t[:, None]) & ~mine)
            found.append((i, at[j], score[i, j]))
            if plain and len(order):
                order = order[(bound[:, order] >= t[:, None]).any(0)]
        if found:
            i, j, s = (np.concatenate(z) for z in zip(*found, strict=True))
            i, j, s = (z[s >= t[i]] for z in (i, j, s))
            by = np.lexsort((ids[j], -s, i))
            i, j, s = i[by], j[by], s[by]
            first = np.searchsorted(i, i)
            keep = np.arange(len(i)) - first < k
            yield i[keep] + a, j[keep], s[keep]


def _matrix(column: pd.Series, kind: type) -> np.ndarray:
    return np.array(column.to_list(), kind).reshape(len(column), -1)


def pivot_table(rows: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """``rows`` (with dim and v) and far array<double>: the distances to the pivots of their length."""
    some: dict[int, list] = {}
    for r in rows.select("dim", "v").orderBy(F.xxhash64("row")).limit(sample).collect():
        some.setdefault(r.dim, []).append(r.v)
    by_length = {d: farthest(np.array(v, float).reshape(len(v), d), pivots) for d, v in some.items()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            far = np.empty(len(b), object)
            for d, at in b.groupby("dim").indices.items():
                own = distances(_matrix(b["v"].iloc[at], float), by_length.get(d, np.zeros((1, d))))
                for i, x in zip(at, own, strict=True):
                    far[i] = x
            yield b.assign(far=far)

    return rows.mapInPandas(run, f"{', '.join(f'{n} {t}' for n, t in rows.dtypes)}, far array<double>")


def _nearest(blocks: Column) -> Column:
    """The nearest of as many pivots as there are blocks, without the origin; 0 if there is none."""
    near = F.slice("far", 2, F.least(blocks, F.lit(PIVOTS)).cast("int"))
    return F.coalesce(F.array_position(near, F.array_min(near)), F.lit(0)).cast("int")


def _joined(rows: DataFrame, small: DataFrame, by: list[str], light: bool) -> DataFrame:
    """``rows`` joined with a table of their groups, which is broadcast if it is known to be small."""
    return rows.join(F.broadcast(small) if light else small, by)


def _filed(rows: DataFrame, sizes: DataFrame, size: int, light: bool) -> DataFrame:
    """``rows`` and the name ``block`` of a block of about ``size`` rows: by nearest pivot, ring, and hash. A length of
    vectors has at most PIVOTS cells of RINGS rings each, so the tables of these are small if that of the lengths is."""
    rows = _joined(rows, sizes.select("dim", F.ceil(F.col("n") / size).alias("b")), ["dim"], light).withColumn("cell", _nearest(F.col("b")))
    rows = rows.withColumn("near", F.coalesce(F.try_element_at("far", F.col("cell") + 1), F.lit(0.0)))
    cells = rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / size).alias("c"), F.percentile_approx("near", [i / RINGS for i in range(1, RINGS)], 1000).alias("cuts"))
    rows = _joined(rows, staged(cells, "cells"), ["dim", "cell"], light)
    ring = F.when(F.col("c") > 1, F.floor(F.size(F.filter("cuts", lambda x: x < F.col("near"))) * F.least(F.col("c"), F.lit(RINGS)) / RINGS)).otherwise(0)
    rows = rows.withColumn("ring", ring.cast("int"))
    rings = staged(rows.groupBy("dim", "cell", "ring").agg(F.ceil(F.count("*") / size).alias("r")), "rings")
    rows = _joined(rows, rings, ["dim", "cell", "ring"], light)
    name = F.concat_ws("/", "dim", "cell", "ring", F.pmod(F.xxhash64("row"), "r"))
    return rows.withColumn("block", name).drop("b", "c", "r", "cell", "near", "cuts", "ring")


def _asking(rows: DataFrame, sizes: DataFrame, size: int, light: bool) -> DataFrame:
    """Queries and the name ``asking`` of a block of about ``size`` of them: by nearest pivot and hash."""
    rows = _joined(rows, sizes.select("dim", F.ceil(F.col("m") / size).alias("b")), ["dim"], light).withColumn("cell", _nearest(F.col("b")))
    cells = staged(rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / size).alias("c")), "asking")
    name = F.concat_ws("/", "dim", "cell", F.pmod(F.xxhash64("row"), "c"))
    return _joined(rows, cells, ["dim", "cell"], light).withColumn("asking", name).drop("b", "c", "cell")


def _ranges(rows: DataFrame, by: str, *more: Column) -> DataFrame:
    ends = [f(F.get("far", F.lit(i))) for f in (F.min, F.max) for i in range(PIVOTS)]
    ends = [e.alias(f"e{i}") for i, e in enumerate(ends)]
    out = rows.groupBy("dim", by).agg(*ends, *more)
    low, high = (F.filter(F.array(*(f"e{i}" for i in r)), lambda x: x.isNotNull()) for r in (range(PIVOTS), range(PIVOTS, 2 * PIVOTS)))
    return out.select("dim", by, low.alias("low"), high.alias("high"), *(c for c in out.columns if not c.startswith("e") and c not in ("dim", by)))


def top_k(vectors: DataFrame, query: Column, k: int = TOP, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, candidates: int = CANDIDATES, queries: int = QUERIES) -> DataFrame:
    """Rows (query_id, rank int from 1, key, score long) for the rows of ``vectors`` that ``query`` holds for."""
    v = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(~odd).select(F.col(key).cast("long").alias("id"), v.alias("v"), F.coalesce(query, F.lit(False)).alias("asks"))
    rows = staged(rows.withColumn("dim", F.size("v")).withColumn("row", F.monotonically_increasing_id()), "rows")
    sizes = staged(rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("asks").alias("m")), "sizes")
    light = few(sizes, LENGTHS)
    filed = staged(_filed(staged(pivot_table(rows), "pivots"), sizes, candidates, light), "filed")
    shape = "row long, query_id long, id long, score long, least long"

    def answers(q: pd.DataFrame, x: pd.DataFrame, least: np.ndarray, own: np.ndarray) -> pd.DataFrame:
        out = []
        if len(q) and len(x):
            ids, row, qid = x["id"].to_numpy(), q["row"].to_numpy(), q["id"].to_numpy()
            for i, j, s in search(_matrix(q["v"], np.int64), _matrix(q["far"], float), least, own, _matrix(x["v"], np.int64), _matrix(x["far"], float), ids, k):
                n = np.bincount(i, minlength=len(q))[i]
                last = s[np.searchsorted(i, i, "right") - 1]  # a query's lowest; its threshold if there are k
                out.append(pd.DataFrame({"row": row[i], "query_id": qid[i], "id": ids[j], "score": s.astype(np.int64), "least": np.where(n >= k, last, np.iinfo(np.int64).min).astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({c: np.empty(0, np.int64) for c in ("row", "query_id", "id", "score", "least")})

    def home(x: pd.DataFrame) -> pd.DataFrame:
        own = np.flatnonzero(x["asks"].to_numpy())
        return answers(x.iloc[own], x, np.full(len(own), -np.inf), own)

    near = staged(filed.groupBy("block").applyInPandas(home, shape), "near")
    floor = near.groupBy("row").agg(F.max("least").alias("least"))
    asked = filed.where("asks").select("row", "id", "v", "dim", "far", F.col("block").alias("home"))
    asked = staged(_asking(asked, sizes, queries, light).join(floor, "row", "left").withColumn("least", F.coalesce("least", F.lit(-(1 << 63)))), "asked")
    # What the ranges of two blocks allow at most.
    offer = staged(_ranges(filed, "block", F.count("*").alias("n")).select("dim", "block", F.col("low").alias("c_low"), F.col("high").alias("c_high")), "ranges")
    asks = _ranges(asked, "asking", F.min("least").alias("least"))
    gap = F.zip_with(F.zip_with("low", "c_high", lambda x, y: x - y), F.zip_with("c_low", "high", lambda x, y: x - y), lambda x, y: F.greatest(x, y))
    slack = lambda x: F.greatest(x - 1e-6 * (1 + F.get("high", F.lit(0)) + F.get("c_high", F.lit(0))), F.lit(0.0))
    best = (F.pow(F.get("high", F.lit(0)), 2) + F.pow(F.get("c_high", F.lit(0)), 2)) * (1 + 1e-9) / 2 - F.pow(slack(F.coalesce(F.array_max(gap), F.lit(0.0))), 2) / 2 + 1e-6
    pairs = _joined(asks, offer, ["dim"], few(offer)).where(best >= F.col("least")).select("asking", "block")
    pairs = staged(pairs, "pairs")
    meet = few(pairs)
    sides = [
        _joined(asked, pairs, ["asking"], meet).select("asking", "block", F.lit(True).alias("asks"), "row", "id", "v", "far", "home", "least"),
        _joined(filed, pairs, ["block"], meet).select("asking", "block", F.lit(False).alias("asks"), "row", "id", "v", "far", F.lit("").alias("home"), F.lit(0).cast("long").alias("least")),
    ]

    def away(pdf: pd.DataFrame) -> pd.DataFrame:
        q, x = pdf[pdf["asks"] & (pdf["home"] != pdf["block"])], pdf[~pdf["asks"]]
        least = q["least"].to_numpy().astype(float)
        least[q["least"].to_numpy() == -(1 << 63)] = -np.inf
        return answers(q, x, least, np.full(len(q), -1))

    parts = near.unionByName(sides[0].unionByName(sides[1]).groupBy("asking", "block").applyInPandas(away, shape))
    order = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0).select("query_id", "rank", "vec_id", "score")
