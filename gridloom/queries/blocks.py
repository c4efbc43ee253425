"""Rasters in blocks: kernels that send only rims, files read and written block by block."""

from pyspark.sql import functions as F

from ..operators import arrays, focal
from ..operators import mosaic as mosaics
from ..operators.staging import folder, staged
from ..sources import parts, rasters
from ..sources.tables import mosaic, table
from .focal import SQUARE, TAPS, _shade_sql
from .registry import MOSAIC, query



def _whole(spark, sf_dir, side, flag=None):
    """The mosaic as one raster in blocks, kept by key."""
    m = mosaic(spark, sf_dir)
    m = m.withColumn("depth", F.when(F.col("depth") >= -100, F.col("depth")) if flag is None else flag.cast("int"))
    return arrays.stored(arrays.from_cells(m.select(F.lit(0).alias("raster"), "row", "col", "depth"), ["raster"], ["depth"], side, "depth"), ["raster"])


def _cells(blocks, side, *names):
    return arrays.to_cells(blocks, ["raster"], {n: [n] for n in names}, side).drop("raster")


# The rectangle of the mosaic, with nulls where no cell is.
FULL = f"""{MOSAIC}, dim AS (SELECT max("row") + 1 AS h, max(col) + 1 AS w FROM mosaic),
whole AS (SELECT CAST(r.r AS INTEGER) AS "row", CAST(c.c AS INTEGER) AS col, m.depth FROM dim CROSS JOIN range(h) r(r) CROSS JOIN range(w) c(c) LEFT JOIN mosaic m ON m."row" = r.r AND m.col = c.c)"""


def _mirror(x, n):
    turn = f"((({x}) % (2 * {n}) + 2 * {n}) % (2 * {n}))"
    return f"CASE WHEN {turn} < {n} THEN {turn} ELSE 2 * {n} - 1 - {turn} END"


@query("q_block_blur", f"""WITH {FULL}, taps(k, x) AS (VALUES {TAPS}), v AS (SELECT "row", col, coalesce(CASE WHEN depth >= -100 THEN depth END, 0.0) AS v, coalesce(depth < -100, true) AS gap FROM whole),
a AS (SELECT v."row", v.col, sum(x * b.v) AS v FROM v CROSS JOIN dim CROSS JOIN taps JOIN v b ON b."row" = {_mirror('v."row" + k', 'h')} AND b.col = v.col GROUP BY ALL),
b AS (SELECT a."row", a.col, sum(x * c.v) AS v FROM a CROSS JOIN dim CROSS JOIN taps JOIN a c ON c.col = {_mirror('a.col + k', 'w')} AND c."row" = a."row" GROUP BY ALL)
SELECT v."row", v.col, CASE WHEN NOT gap THEN round(b.v, 5) END AS blurred FROM v JOIN b USING ("row", col)""")
def q_block_blur(spark, sf_dir):
    """One large raster in blocks of 16, blurred; only rims of four cells are sent."""
    return _cells(arrays.blur(_whole(spark, sf_dir, 16), ["raster"], "depth", 1.0), 16, "blurred").select("row", "col", F.round("blurred", 5).alias("blurred"))


@query("q_block_hillshade", f"""WITH {MOSAIC}, grids_ AS (SELECT * FROM mosaic WHERE depth >= -100), n AS (SELECT a."row", a.col, sum(b.depth * j * CASE WHEN i = 0 THEN 2 ELSE 1 END) / 8 AS dzdx, sum(b.depth * i * CASE WHEN j = 0 THEN 2 ELSE 1 END) / 8 AS dzdy, count(*) AS n
  FROM grids_ a CROSS JOIN (VALUES (-1), (0), (1)) i(i) CROSS JOIN (VALUES (-1), (0), (1)) j(j) JOIN grids_ b ON b."row" = a."row" + i AND b.col = a.col + j GROUP BY ALL) SELECT "row", col, round(1 + 254 * ({_shade_sql()}) / 2, 5) AS shade FROM n WHERE n = 9""")
def q_block_hillshade(spark, sf_dir):
    shaded = _cells(arrays.hillshade(_whole(spark, sf_dir, 32), ["raster"], "depth", 5.0, 30.0), 32, "shade")
    return shaded.where("shade is not null").select("row", "col", F.round("shade", 5).alias("shade"))


@query("q_block_edges", f"""WITH {FULL}, f AS (SELECT "row", col, coalesce(depth < -10, false) AS f FROM whole), p AS (SELECT DISTINCT "row" + i AS "row", col + j AS col FROM f, (VALUES (-2), (-1), (0), (1), (2)) i(i), (VALUES (-2), (-1), (0), (1), (2)) j(j) WHERE f),
m AS (SELECT f."row", f.col, p."row" IS NOT NULL AS g FROM f LEFT JOIN p USING ("row", col)), q AS (SELECT DISTINCT "row" + i AS "row", col + j AS col FROM m, {SQUARE} WHERE NOT g)
SELECT m."row", m.col, g AS grown, q."row" IS NULL AS closed FROM m LEFT JOIN q USING ("row", col)""")
def q_block_edges(spark, sf_dir):
    """Flags grown by two cells and shrunk by one, kernel after kernel on stored blocks."""
    grown = arrays.stored(arrays.spread(_whole(spark, sf_dir, 16, F.col("depth") < -10), ["raster"], "depth", 2, out="grown"), ["raster"])
    cells = _cells(arrays.spread(grown, ["raster"], "grown", 1, grow=False, out="closed"), 16, "grown", "closed")
    return cells.select("row", "col", (F.col("grown") == 1).alias("grown"), (F.col("closed") == 1).alias("closed"))


@query("q_mosaic_nearest", f"""WITH {MOSAIC}, c AS (SELECT "row", col, depth, depth > -5 AS valid FROM mosaic), d AS (SELECT i, j FROM range(-12, 13) a(i), range(-12, 13) b(j)),
p AS (SELECT a."row", a.col, min({{'d': i * i + j * j, 'r': b."row", 'c': b.col, 'v': b.depth}}) AS n FROM c a CROSS JOIN d JOIN c b ON b.valid AND b."row" = a."row" + i AND b.col = a.col + j WHERE NOT a.valid GROUP BY ALL)
SELECT c."row", c.col, round(coalesce(p.n.v, c.depth), 6) AS depth FROM c LEFT JOIN p USING ("row", col)""")
def q_mosaic_nearest(spark, sf_dir):
    """Nearest fill across blocks of 16."""
    c = mosaic(spark, sf_dir).select(F.lit(0).alias("raster"), "row", "col", "depth", (F.col("depth") > -5).alias("valid"), F.lit(True).alias("fillable"))
    return focal.fill_nearest(c, ["raster"], ["depth"], "valid", "fillable", block=16).select("row", "col", F.round("depth", 6).alias("depth"))


SCENE = 32  # rows of a file: four rows of rasters


def _written(spark, sf_dir, values, levels=1, sample="f4", side=16):
    """The mosaic as files of ``SCENE`` rows each, 10 metres a cell: the folder and the paths."""
    row = F.col("row")
    scene = F.floor(row / SCENE).cast("int")
    cells = mosaic(spark, sf_dir).select(scene.alias("scene"), (row % SCENE).alias("row"), "col", *values)
    names = cells.columns[3:]
    blocks = arrays.from_cells(cells, ["scene"], names, side).withColumnsRenamed({"br": "by", "bc": "bx"})
    placed = blocks.select(F.concat(F.lit("s"), F.col("scene").cast("string"), F.lit(".tif")).alias("path"), "by", "bx", "height", "width", "data", F.lit(0.0).alias("x0"), (F.col("scene") * -10.0 * SCENE).alias("y0"), F.lit(10.0).alias("px"))
    where = folder(spark, "rasters")
    files = parts.write_files(parts.tiled_geotiffs(placed, side, len(names), levels, sample), where)
    return where, files.select(F.concat(F.lit(f"{where}/"), "path").alias("path"))


WINDOWS = """asked AS (SELECT n_nationkey AS "window", (n_nationkey * 397) % 470 * 10 + 3 AS minx, (n_nationkey * 397) % 470 * 10 + 3 + 140 + n_nationkey * 5 AS maxx, -((n_nationkey * 53) % 60 * 10) - 4 AS maxy,
  -((n_nationkey * 53) % 60 * 10) - 4 - 90 - n_nationkey * 3 AS miny, 10 + n_nationkey % 2 * 12 AS pixel FROM nation)"""


@query("q_window_scan", f"""WITH {MOSAIC}, {WINDOWS}, fine AS (SELECT "row" // {SCENE} AS scene, "row" % {SCENE} AS "row", col, CAST(CAST(depth AS FLOAT) AS DOUBLE) AS depth, CAST(CAST(raster_id AS FLOAT) AS DOUBLE) AS id FROM mosaic),
coarse AS (SELECT "row" // {SCENE} AS scene, "row" % {SCENE} // 2 AS "row", col // 2 AS col, CAST(CAST(avg(depth) AS FLOAT) AS DOUBLE) AS depth, CAST(CAST(avg(raster_id) AS FLOAT) AS DOUBLE) AS id FROM mosaic GROUP BY ALL),
c AS (SELECT 10 AS px, 0 AS level, * FROM fine UNION ALL SELECT 20, 1, * FROM coarse)
SELECT "window", 's' || scene || '.tif' AS file, CAST(level AS INTEGER) AS level, CAST("row" AS INTEGER) AS "row", CAST(col AS INTEGER) AS col, round(depth, 3) AS depth, id FROM c JOIN asked
  ON level = CASE WHEN pixel >= 20 THEN 1 ELSE 0 END AND col * px < maxx AND (col + 1) * px > minx AND -(scene * {SCENE * 10}) - "row" * px > miny AND -(scene * {SCENE * 10}) - ("row" + 1) * px < maxy""")
def q_window_scan(spark, sf_dir):
    """Windows of rasters at two resolutions: headers, the blocks that are needed, nothing else."""
    where, files = _written(spark, sf_dir, [F.col("depth"), F.col("raster_id").cast("double").alias("id")], levels=2)
    k = F.col("n_nationkey")
    minx, maxy = k * 397 % 470 * 10 + 3, -(k * 53 % 60 * 10) - 4
    asked = table(spark, sf_dir, "nation").select(k.alias("window"), minx.cast("double").alias("minx"), (maxy - 90 - k * 3).cast("double").alias("miny"), (minx + 140 + k * 5).cast("double").alias("maxx"), maxy.cast("double").alias("maxy"), (10 + k % 2 * 12).cast("double").alias("pixel"))
    needs, blocks = rasters.windows(rasters.images(files), asked, 1000.0)
    cells = rasters.window_cells(needs, blocks, ["depth", "id"]).where("id is not null")
    return cells.select("window", F.substring_index("path", "/", -1).alias("file"), "level", "row", "col", F.round("depth", 3).alias("depth"), "id")


@query("q_geotiff_tiled", f"""WITH {MOSAIC} SELECT 's' || "row" // {SCENE} || '.tif' AS file, CAST("row" % {SCENE} AS INTEGER) AS "row", col, CAST(floor(abs(depth)) AS BIGINT) % 256 AS r, "row" * 3 % 256 AS g, col % 256 AS b, CASE WHEN depth < -40 THEN 0 ELSE 255 END AS a FROM mosaic""")
def q_geotiff_tiled(spark, sf_dir):
    """Colours and alpha as tiled files with 64-bit places, and back by the data source."""
    byte = [(F.floor(F.abs("depth")) % 256).alias("r"), (F.col("row") * 3 % 256).alias("g"), (F.col("col") % 256).alias("b"), F.when(F.col("depth") < -40, 0).otherwise(255).alias("a"), F.lit(1).alias("there")]
    where, _ = _written(spark, sf_dir, byte, levels=2, sample="u1")
    blocks = rasters.scan(spark, where, part=1 << 14).withColumnsRenamed({"by": "br", "bx": "bc"})
    cells = arrays.to_cells(blocks, ["path"], {"data": ["r", "g", "b", "a", "there"]}, 16).where("there = 1")
    return cells.select(F.substring_index("path", "/", -1).alias("file"), "row", "col", *(F.col(c).cast("long").alias(c) for c in "rgb"), F.col("a").cast("int").alias("a"))


SOURCES = f"""{MOSAIC}, k AS (SELECT CAST(k AS INTEGER) AS k FROM range(5) a(k)), s AS (SELECT k, "row", col, depth + 1000 * k AS depth FROM mosaic CROSS JOIN k WHERE ("row" // 16 + k) % 3 <> 0 AND NOT (k % 2 = 1 AND ("row" * 7 + col * 3 + k) % 11 = 0))"""


@query("q_mosaic_footprints", f"""WITH {SOURCES} SELECT "row", col, round(arg_max(depth, k), 6) AS depth, max(k) AS source FROM s WHERE k < 4 AND "row" BETWEEN 8 AND 39 AND col BETWEEN 100 AND 299 GROUP BY "row", col""")
def q_mosaic_footprints(spark, sf_dir):
    """Five overlapping sources, one of them too coarse: a window of their mosaic."""
    row, col, k = F.col("row"), F.col("col"), F.col("source")
    cells = staged(mosaic(spark, sf_dir).select(F.explode(F.sequence(F.lit(0), F.lit(4))).alias("source"), "row", "col", (F.col("depth") + 1000 * k).alias("depth")).where(((F.floor(row / 16) + k) % 3 != 0) & ~((k % 2 == 1) & ((row * 7 + col * 3 + k) % 11 == 0))), "sources")
    blocks = arrays.stored(arrays.from_cells(cells, ["source"], ["depth"], 16).withColumn("whole", mosaics.is_whole("data", "height", "width", F.lit(16))), ["source"])
    spans = cells.groupBy("source").agg(F.min("row").alias("r0"), (F.max("row") + 1).alias("r1"), F.min("col").alias("c0"), (F.max("col") + 1).alias("c1"))
    prints = spans.select("source", k.alias("seq"), "r0", "r1", "c0", "c1", F.when(k < 4, 10.0).otherwise(40.0).alias("px"))
    made = mosaics.by_footprints(blocks, prints, (8, 40, 100, 300), 20.0, 16).withColumn("raster", F.lit(0))
    shown = _cells(made, 16, "data", "top").where("top is not null and row between 8 and 39 and col between 100 and 299")
    return shown.select("row", "col", F.round("data", 6).alias("depth"), F.col("top").cast("int").alias("source"))
