"""Reprojection onto tiles, backgrounds that are built in several runs, pyramids brought up to date."""

from pyspark.sql import functions as F

from ..functions import geo, mgrs
from ..operators import arrays, tiles, warp
from ..operators.staging import folder, staged
from ..plans import background
from ..sources.tables import mosaic
from .colour import _clip, _ramp_sql
from .focal import _shade_sql
from .registry import MOSAIC, query
from .renders import _number
from .tiling import BASE, ZOOM, _base, _level

# The mosaic as a raster of zone 31, a kilometre a cell, and tiles of 16 pixels of 1,700 m of Web Mercator over it.
X0, Y0, PX, WEST, NORTH, PIXEL, SIDE, ACROSS = 244000.0, 5000000.0, 1000.0, -30000.0, 5650000.0, 1700.0, 16, 27


def _source(spark, sf_dir):
    cells = mosaic(spark, sf_dir).select(F.lit(0).alias("raster"), "row", "col", "depth")
    return arrays.stored(arrays.from_cells(cells, ["raster"], ["depth"], 32), ["raster"]), cells


def _targets(cells, pixel, west, north, across, step):
    """Tiles over the raster: as many to the south as its rows need."""
    down = cells.groupBy("raster").agg((F.floor(F.max("row") * step / (pixel * SIDE)) + 2).cast("int").alias("down"))
    t = down.select("raster", F.explode(F.sequence(F.lit(0), F.col("down") - 1)).alias("ty")).select("*", F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("tx"))
    return t.select("raster", "tx", "ty", (F.lit(west) + F.col("tx") * SIDE * pixel).alias("minx"), (F.lit(north) - F.col("ty") * SIDE * pixel).alias("maxy"), F.lit(pixel).alias("pixel"), F.lit(SIDE).alias("size"))


def _warped(made):
    cells = arrays.to_cells(made.withColumnsRenamed({"ty": "br", "tx": "bc"}), ["raster"], {"data": ["depth"]}, SIDE)
    return cells.where("depth is not null").select("row", "col", F.round("depth", 4).alias("depth"))


def _utm_sql():
    e, k = float(mgrs.E), f"({_number(mgrs.SCALE)} * {_number(mgrs.RADIUS)})"
    series = lambda own, a, b: " + ".join([own, *(f"{_number(c)} * {a}(2 * {j} * xi) * {b}(2 * {j} * eta)" for j, c in enumerate(mgrs.ALPHA, 1))])
    return f"""u0 AS (SELECT *, radians(x / {_number(geo.HALF_WORLD)} * 180 - 3) AS d, tanh(y * pi() / {_number(geo.HALF_WORLD)}) AS s FROM m), u1 AS (SELECT *, sinh(atanh(s) - {_number(e)} * atanh({_number(e)} * s)) AS t FROM u0),
u2 AS (SELECT *, atan2(t, cos(d)) AS xi, asinh(sin(d) / sqrt(t * t + cos(d) * cos(d))) AS eta FROM u1),
u AS (SELECT * EXCLUDE (d, s, t, xi, eta), (500000 + {k} * ({series('eta', 'cos', 'sinh')}) - {_number(X0)}) / {_number(PX)} AS sx, ({_number(Y0)} - {k} * ({series('xi', 'sin', 'cosh')})) / {_number(PX)} AS sy FROM u2)"""


LANCZOS = "CASE WHEN abs({0}) >= 3 THEN 0 WHEN abs({0}) < 1e-9 THEN 1 ELSE sin(pi() * {0}) / (pi() * {0}) * sin(pi() * {0} / 3) / (pi() * {0} / 3) END"
PLACES = f"""dim AS (SELECT CAST(floor(max("row") * {{step}} / {{tile}}) AS INTEGER) + 2 AS down FROM mosaic), tiles AS (SELECT CAST(j AS INTEGER) AS tx, CAST(i AS INTEGER) AS ty FROM dim CROSS JOIN range(down) a(i) CROSS JOIN range({{across}}) b(j))"""


@query("q_warp_utm", f"""WITH {MOSAIC}, {PLACES.format(step=1420.0, tile=PIXEL * SIDE, across=ACROSS)},
g AS (SELECT tx, ty, CAST(i AS DOUBLE) + 0.5 AS pr, CAST(j AS DOUBLE) + 0.5 AS pc, 0 AS probe FROM tiles CROSS JOIN range({SIDE}) a(i) CROSS JOIN range({SIDE}) b(j) UNION ALL
  SELECT tx, ty, {SIDE // 2}.0 + CASE WHEN k = 2 THEN 1 ELSE 0 END, {SIDE // 2}.0 + CASE WHEN k = 1 THEN 1 ELSE 0 END, 1 + k FROM tiles CROSS JOIN range(3) a(k)),
m AS (SELECT *, {_number(WEST)} + (tx * {SIDE} + pc) * {_number(PIXEL)} AS x, {_number(NORTH)} - (ty * {SIDE} + pr) * {_number(PIXEL)} AS y FROM g), {_utm_sql()},
p AS (SELECT tx, ty, max(sx) FILTER (probe = 1) AS ax, max(sy) FILTER (probe = 1) AS ay, max(sx) FILTER (probe = 2) AS bx, max(sy) FILTER (probe = 2) AS by_, max(sx) FILTER (probe = 3) AS cx, max(sy) FILTER (probe = 3) AS cy FROM u WHERE probe > 0 GROUP BY tx, ty),
s AS (SELECT tx, ty, greatest(1.0, sqrt((bx - ax) ** 2 + (by_ - ay) ** 2)) AS kx, greatest(1.0, sqrt((cx - ax) ** 2 + (cy - ay) ** 2)) AS ky FROM p),
t AS (SELECT u.*, kx, ky FROM u JOIN s USING (tx, ty) JOIN mosaic c ON c."row" = floor(sy) AND c.col = floor(sx) WHERE probe = 0),
n AS (SELECT t.*, c.depth, {LANCZOS.format('((c."row" + 0.5 - sy) / ky)')} * {LANCZOS.format('((c.col + 0.5 - sx) / kx)')} AS w FROM t CROSS JOIN range(-6, 7) a(i) CROSS JOIN range(-6, 7) b(j) JOIN mosaic c ON c."row" = floor(sy) + i AND c.col = floor(sx) + j)
SELECT CAST(ty * {SIDE} + floor(pr) AS INTEGER) AS "row", CAST(tx * {SIDE} + floor(pc) AS INTEGER) AS col, round(sum(w * depth) / sum(w), 4) AS depth FROM n GROUP BY ty, tx, pr, pc""")
def q_warp_utm(spark, sf_dir):
    """From a zone's grid to Web Mercator tiles by a kernel that widens with the pixels, every place projected exactly."""
    source, cells = _source(spark, sf_dir)
    places = cells.select("raster").distinct().select("raster", F.lit(X0).alias("x0"), F.lit(Y0).alias("y0"), F.lit(PX).alias("px"), F.lit(31).alias("zone"), F.lit(False).alias("south"))
    targets = _targets(cells, PIXEL, WEST, NORTH, ACROSS, 1420.0)
    return _warped(warp.warp(source, places, targets, ["raster"], ["tx", "ty"], method="lanczos", block=32, tolerance=0.0))


RATIO = 2.75


@query("q_warp_area", f"""WITH {MOSAIC}, {PLACES.format(step=1.0, tile=RATIO * SIDE, across=12)}, m AS (SELECT CAST(ty * {SIDE} + i AS INTEGER) AS r, CAST(tx * {SIDE} + j AS INTEGER) AS c FROM tiles CROSS JOIN range({SIDE}) a(i) CROSS JOIN range({SIDE}) b(j)),
w AS (SELECT r, c, depth, greatest(least("row" + 1, (r + 1) * {_number(RATIO)}) - greatest("row", r * {_number(RATIO)}), 0) * greatest(least(col + 1, (c + 1) * {_number(RATIO)}) - greatest(col, c * {_number(RATIO)}), 0) AS w
  FROM m CROSS JOIN range(4) a(i) CROSS JOIN range(4) b(j) JOIN mosaic ON "row" = floor(r * {_number(RATIO)}) + i AND col = floor(c * {_number(RATIO)}) + j)
SELECT r AS "row", c AS col, round(sum(w * depth) / sum(w), 4) AS depth FROM w WHERE w > 0 GROUP BY r, c""")
def q_warp_area(spark, sf_dir):
    """Means weighted by the covered area, at a ratio of pixels that is no whole number."""
    source, cells = _source(spark, sf_dir)
    places = cells.select("raster").distinct().select("raster", F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(1.0).alias("px"))
    return _warped(warp.warp(source, places, _targets(cells, RATIO, 0.0, 0.0, 12, 1.0), ["raster"], ["tx", "ty"], project=warp.same, method="average", block=32))


CHUNK = 24
OLD, NEW = ({"z_factor": z, "pixel": 30.0, "scale": 60.0, "erosion": 1, "fade": -30.0, "source": "mosaic"} for z in (2.0, 5.0))
OCEAN = f"""{MOSAIC.replace('grids AS', 'small AS').replace('FROM grids', 'FROM small')}, grids AS (SELECT 0 AS raster_id, "row", col, depth FROM mosaic),
f AS (SELECT *, {_clip('(depth * 60 - -11000.0) / 11000.0')} * 20 AS pos, depth > -32766.9 AND depth < -30 AS wet FROM grids), i AS (SELECT *, CAST(least(floor(pos), 19) AS INTEGER) AS i FROM f),
n AS (SELECT a."row", a.col, sum(b.depth * j * CASE WHEN i = 0 THEN 2 ELSE 1 END) / 8 AS dzdx, sum(b.depth * i * CASE WHEN j = 0 THEN 2 ELSE 1 END) / 8 AS dzdy, count(*) AS n, min(CAST(b.wet AS INTEGER)) AS core
  FROM f a CROSS JOIN (VALUES (-1), (0), (1)) y(i) CROSS JOIN (VALUES (-1), (0), (1)) x(j) JOIN f b ON b."row" = a."row" + i AND b.col = a.col + j GROUP BY ALL),
s AS (SELECT "row", col, core, 1 + 254 * ({_shade_sql()}) / 2 AS hs FROM n WHERE n = 9),
o AS (SELECT "row" // {CHUNK} AS cr, col // {CHUNK} AS cc, "row", col, {', '.join(f'CAST(floor({_clip(f"{_ramp_sql(k)} * (0.35 + 0.65 * hs / 255.0)")} * 255) AS INTEGER) AS {c}' for k, c in enumerate('rgb'))}, core * 255 AS a FROM i JOIN s USING ("row", col)),
shown AS (SELECT cr, cc FROM o GROUP BY cr, cc HAVING max(a) > 0)"""


@query("q_ocean_resume", f"""WITH {OCEAN}, c AS (SELECT DISTINCT "row" // {CHUNK} AS cr, col // {CHUNK} AS cc FROM mosaic)
SELECT 'cell' AS kind, "row", col, r, g, b, a, '' AS status FROM o JOIN shown USING (cr, cc)
UNION ALL SELECT 'ran', CAST(cr AS INTEGER), CAST(cc AS INTEGER), 0, 0, 0, 0, CASE WHEN shown.cr IS NULL THEN 'empty' ELSE 'rendered' END FROM c LEFT JOIN shown USING (cr, cc) WHERE (cr + cc) % 2 = 1 OR cc % 3 = 0""")
def q_ocean_resume(spark, sf_dir):
    """A background of which half the chunks are there, some by old settings: the whole, and which chunks the last run made."""
    cells, path = mosaic(spark, sf_dir).select("row", "col", "depth"), folder(spark, "ocean")
    r, c = F.floor(F.col("row") / CHUNK), F.floor(F.col("col") / CHUNK)
    # The runs before, stopped early.
    _part(cells, (r + c) % 2 == 0, path, NEW)
    _part(cells, ((r + c) % 2 == 0) & (c % 3 == 0), path, OLD)
    ran = background.build(cells, path, NEW, CHUNK)
    at = F.split("chunk", "_")
    zero = [F.lit(0).alias(x) for x in "rgba"]
    done = ran.select(F.lit("ran").alias("kind"), at[0].cast("int").alias("row"), at[1].cast("int").alias("col"), *zero, "status")
    return background.made(spark, path).select(F.lit("cell").alias("kind"), "row", "col", *"rgba", F.lit("").alias("status")).unionByName(done)


def _part(cells, which, path, settings):
    """A run for some of the chunks."""
    chunk = F.concat_ws("_", F.floor(F.col("row") / CHUNK).cast("string"), F.floor(F.col("col") / CHUNK).cast("string"))
    background.build(cells, path, settings, CHUNK, only=cells.where(which).select(chunk.alias("chunk")).distinct())


CHANGED = "tx % 5 = 0 AND ty % 2 = 0"


@query("q_pyramid_update", f"""WITH {BASE.replace('l0 AS', 'was AS')}, l0 AS (SELECT z, tx, ty, "row", col, CAST(CASE WHEN {CHANGED} THEN (r + 40) % 256 ELSE r END AS INTEGER) AS r, g, b, a FROM was WHERE NOT (tx % 7 = 3 AND ty % 3 = 1)), {_level(1)}, {_level(2)}, {_level(3)}, {_level(4)},
every AS (SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3 UNION ALL SELECT * FROM l4),
touched AS (SELECT DISTINCT {ZOOM} - k AS z, CAST(tx // (1 << k) AS INTEGER) AS tx, CAST(ty // (1 << k) AS INTEGER) AS ty FROM was CROSS JOIN range(5) a(k) WHERE ({CHANGED}) OR tx % 7 = 3 AND ty % 3 = 1)
SELECT e.*, t.z IS NOT NULL AS fresh FROM every e LEFT JOIN touched t USING (z, tx, ty)""")
def q_pyramid_update(spark, sf_dir):
    """Some tiles change, some go: only what lies above them is made anew, and the whole equals a new pyramid."""
    base = _base(spark, sf_dir)
    key = ["z", "tx", "ty"]
    levels = staged(tiles.pyramid(base, 8, ZOOM - 4, ZOOM), "levels")
    is_gone = (F.col("tx") % 7 == 3) & (F.col("ty") % 3 == 1)
    changed = base.where(F.expr(CHANGED) & ~is_gone).withColumn("r", ((F.col("r") + 40) % 256).cast("int"))
    now, made = tiles.update_pyramid(levels, changed, base.where(is_gone).select(*key).distinct(), 8, ZOOM - 4, ZOOM, staged)
    return now.join(made.withColumn("fresh", F.lit(True)), key, "left").select(*levels.columns, F.coalesce("fresh", F.lit(False)).alias("fresh"))
