"""Scene records: search by quadtree, manifests, deduplication, choice of products, cover."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import places

MAX_ROWS, MAX_DEPTH, CELL_DEGREES, TTL_DAYS = 3980, 12, 8.0, 90


def deduplicate(scenes: DataFrame, identity: Column, seq: str = "seq") -> DataFrame:
    """The first record of each identity; records without one are told apart by ``identity``'s last resort."""
    by = Window.partitionBy(identity).orderBy(seq)
    return scenes.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def recent(scenes: DataFrame, cell: str, start: str, since: str) -> DataFrame:
    """Records that start on ``since`` or later or have no start; all of a cell that would be left with none."""
    fresh = scenes.withColumn("_ok", F.col(start).isNull() | (F.substring(start, 1, 10) >= since))
    some = fresh.groupBy(cell).agg(F.bool_or("_ok").alias("_some"))
    return fresh.join(some, cell).where("_ok or not _some").drop("_ok", "_some")


def newest_first(scenes: DataFrame, start: str = "start", seq: str = "seq") -> DataFrame:
    """Scenes with their places, from 1: by start, newest first, those without one last; then by ``seq``."""
    return places(scenes, [F.coalesce(start, F.lit("")).desc(), F.col(seq)])


def preferred_option(options: DataFrame, entity: str, name: str, seq: str, available: str = "available") -> DataFrame:
    """One product an entity: the first available named jp2, else the last JPEG2000, else the first."""
    low = F.lower(name)
    jp2, j2k = low.contains("jp2"), low.contains("jp2") | low.contains("jpeg2000")
    rank = F.when(jp2, F.struct(F.lit(0).alias("k"), F.col(seq).alias("s"))).when(j2k, F.struct(F.lit(1).alias("k"), (-F.col(seq)).alias("s"))).otherwise(F.struct(F.lit(2).alias("k"), F.col(seq).alias("s")))
    return options.where(available).withColumn("_n", F.row_number().over(Window.partitionBy(entity).orderBy(rank))).where("_n = 1").drop("_n")


def latest(manifest: DataFrame, key: Sequence[str], at: str, now: Column, days: int = TTL_DAYS) -> DataFrame:
    """The newest record of each key that has not expired; empty results are records too."""
    by = Window.partitionBy(*key).orderBy(F.desc(at))
    kept = manifest.where(F.col(at) >= now - F.make_dt_interval(F.lit(days)))
    return kept.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def from_lines(lines: DataFrame, schema: str) -> DataFrame:
    """Records of JSON lines (value); lines that do not parse, and lines without a record's first two fields, are left out."""
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    rows = lines.select(F.from_json("value", schema).alias("r")).select("r.*")
    return rows.where(F.col(names[0]).isNotNull() & F.col(names[1]).isNotNull())


def upsert(manifest: DataFrame, fresh: DataFrame, key: Sequence[str], at: str) -> DataFrame:
    """One record a key: of ``fresh`` where it is as new, else of ``manifest``; by a full outer join on the key."""
    rest = [c for c in manifest.columns if c not in key]
    old, new = (df.select(*key, F.struct(*rest).alias(n)) for df, n in ((manifest, "_old"), (fresh, "_new")))
    best = F.when(F.col("_old").isNull() | (F.col(f"_new.{at}") >= F.col(f"_old.{at}")), F.col("_new"))
    return old.join(new, list(key), "full_outer").select(*key, F.coalesce(best, F.col("_old")).alias("_r")).select(*key, "_r.*")


def quadtree(rows: DataFrame, x: str, y: str, bounds: tuple[float, float, float, float], most: int = MAX_ROWS, depth: int = MAX_DEPTH, keep=lambda df: df, within: Sequence[tuple[float, float]] | None = None) -> DataFrame:
    """Cells (depth, i, j, n) that hold at most ``most`` rows, or are at the full depth: a cell with more is split into four.

    The cells of the deepest level are counted once; the levels above are sums of four. keep: how the counts are stored.
    within: an outline; cells that do not meet it are left out, as they would not be asked for."""
    x0, y0, x1, y1 = bounds
    n = 2**depth
    at = lambda c, a, b: F.least(F.greatest(F.floor((F.col(c) - a) / (b - a) * n), F.lit(0)), F.lit(n - 1)).cast("int")
    level = keep(rows.select(at(x, x0, x1).alias("i"), at(y, y0, y1).alias("j")).groupBy("i", "j").agg(F.count("*").alias("n")))
    levels = [level.withColumn("depth", F.lit(depth))]
    for d in range(depth - 1, -1, -1):
        half = [F.floor(F.col(c) / 2).cast("int").alias(c) for c in ("i", "j")]
        level = keep(level.groupBy(*half).agg(F.sum("n").alias("n")))
        levels.append(level.withColumn("depth", F.lit(d)))
    cells = levels[0]
    for more in levels[1:]:
        cells = cells.unionByName(more)
    up = cells.withColumns({"pd": F.col("depth") - 1, "pi": F.floor(F.col("i") / 2).cast("int"), "pj": F.floor(F.col("j") / 2).cast("int")})
    split = cells.where(F.col("n") > most).select(F.col("depth").alias("pd"), F.col("i").alias("pi"), F.col("j").alias("pj"))
    leaf = (F.col("n") <= most) | (F.col("depth") == depth)
    # A cell is reached if it is the root or its parent was split; a parent with too many rows has such parents itself.
    out = up.where(leaf).join(split, ["pd", "pi", "pj"], "left_semi").unionByName(up.where(leaf & (F.col("depth") == 0))).select("depth", "i", "j", "n")
    if within is None:
        return out
    side = F.pow(F.lit(0.5), F.col("depth"))
    box = (x0 + F.col("i") * side * (x1 - x0), y0 + F.col("j") * side * (y1 - y0), x0 + (F.col("i") + 1) * side * (x1 - x0), y0 + (F.col("j") + 1) * side * (y1 - y0))
    return out.where(touches_ring(box, within))


def start_cells(bounds: tuple[float, float, float, float], side: float = CELL_DEGREES) -> list[tuple[float, float, float, float]]:
    """Where a search begins: the bounds themselves, or if they span more than ``side`` degrees the cells of a grid aligned to it, cut to the bounds."""
    x0, y0, x1, y1 = bounds
    if x1 - x0 <= side and y1 - y0 <= side:
        return [bounds]
    steps = lambda a, b: range(math.floor(a / side), math.ceil(b / side))
    return [(max(x0, i * side), max(y0, j * side), min(x1, (i + 1) * side), min(y1, (j + 1) * side)) for j in steps(y0, y1) for i in steps(x0, x1)]


def greedy_cover(scenes: DataFrame, cell: str, start: str, area: Sequence[str], seq: str = "seq", grid: int = 16) -> DataFrame:
    """Scenes of each cell, newest first, that cover something of it that none before did.

    Areas are boxes (minx, miny, maxx, maxy) within 0..1 of the cell, taken on a grid of points: an approximation of exact polygons.
    The first scene to cover a point is the newest that does, so no fold over scenes is needed and no cell meets in one task; of equal boxes only the newest
    goes to the points."""
    x0, y0, x1, y1 = (F.col(c) for c in area)
    newest = F.max(F.struct(F.coalesce(F.col(start), F.lit("")).alias("start"), (-F.col(seq)).alias("seq"))).alias("_s")
    rows = scenes.groupBy(cell, *area).agg(newest)
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("_i")).where(((F.col("_i") + 0.5) / grid).between(x0, x1))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("_j")).where(((F.col("_j") + 0.5) / grid).between(y0, y1))
    taken = rows.groupBy(cell, "_i", "_j").agg(F.max("_s").alias("_s")).select(cell, (-F.col("_s.seq")).alias(seq)).distinct()
    return scenes.join(taken, [cell, seq], "left_semi")


def stac_assets(collections: DataFrame, query: tuple[float, float, float, float], datasets: DataFrame) -> DataFrame:
    """(dataset, href): the first asset ending in .tif of each feature that overlaps the query, of data sets that do."""
    touches = lambda b: (b[0] < query[2]) & (b[2] > query[0]) & (b[1] < query[3]) & (b[3] > query[1])
    live = datasets.where(touches(F.col("bbox"))).select("dataset")
    shape = "struct<features:array<struct<bbox:array<double>,assets:map<string,struct<href:string>>>>>"
    found = collections.join(live, "dataset", "left_semi").select("dataset", F.explode(F.from_json("json", shape)["features"]).alias("f")).where(touches(F.col("f.bbox")))
    tif = F.filter(F.map_values("f.assets"), lambda a: a["href"].endswith(".tif"))
    return found.select("dataset", F.get(tif, F.lit(0))["href"].alias("href")).where("href is not null")


def touches_ring(box: Sequence[Column], ring: Sequence[tuple[float, float]]) -> Column:
    """Whether a box (minx, miny, maxx, maxy) meets a polygon: envelopes first, then a corner of one in the other, or crossing edges."""
    x0, y0, x1, y1 = box
    xs, ys = [x for x, _ in ring], [y for _, y in ring]
    near = (x0 <= max(xs)) & (x1 >= min(xs)) & (y0 <= max(ys)) & (y1 >= min(ys))
    names = ("ax", "ay", "bx", "by")
    edges = F.array(*(F.struct(*(F.lit(float(v)).alias(n) for n, v in zip(names, (*p, *q), strict=True))) for p, q in zip(ring, [*ring[1:], ring[0]], strict=True)))
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    side = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    # A level edge is crossed by no level ray.
    passes = lambda e, x, y: F.when((e["ay"] > y) != (e["by"] > y), x < (e["bx"] - e["ax"]) * (y - e["ay"]) / (e["by"] - e["ay"]) + e["ax"]).otherwise(F.lit(False))
    inside = lambda x, y: F.size(F.filter(edges, lambda e: passes(e, x, y))) % 2 == 1

    def crosses(e: Column) -> Column:
        p, q = (e["ax"], e["ay"]), (e["bx"], e["by"])
        found = (x0 < p[0]) & (x1 > p[0]) & (y0 < p[1]) & (y1 > p[1])  # a vertex in the box
        for r, s in zip(corners, [*corners[1:], corners[0]], strict=True):
            found = found | ((side(p, q, r) * side(p, q, s) < 0) & (side(r, s, p) * side(r, s, q) < 0))
        return found

    meets = F.exists(edges, crosses)
    for x, y in corners:
        meets = meets | inside(x, y)
    return F.when(near, meets).otherwise(F.lit(False))
