"""Neighbourhoods on grids."""

import math

from pyspark.sql import functions as F

from ..functions import masks
from ..operators import focal
from ..sources.tables import grids
from .registry import GRIDS, query

AT = ["raster_id", "row", "col"]
WET = f'{GRIDS}, wet AS (SELECT raster_id, "row", col, depth, depth > -32766.9 AND depth < -30 AS wet FROM grids)'
SQUARE = "(VALUES (-1), (0), (1)) i(i), (VALUES (-1), (0), (1)) j(j)"


def _wet(spark, sf_dir):
    return grids(spark, sf_dir).withColumn("wet", masks.ocean(F.col("depth"), fade=-30.0))


@query("q_ocean_mask", f'WITH {GRIDS} SELECT raster_id, "row", col, depth > -32766.9 AND depth < -50 AS ocean, CASE WHEN NOT depth > 0.001 THEN round(depth, 6) END AS below FROM grids')
def q_ocean_mask(spark, sf_dir):
    d = F.col("depth")
    return grids(spark, sf_dir).select(*AT, masks.ocean(d).alias("ocean"), F.round(masks.drop_positive(d), 6).alias("below"))


ALPHA = f'{GRIDS}, m AS (SELECT raster_id, "row", col, depth, CAST((raster_id + "row" * 37 + col * 11) % 256 AS INTEGER) AS a, (raster_id + "row") % 5 <> 0 AS covered FROM grids)'


@query("q_fill_allowed", f'WITH {ALPHA} SELECT raster_id, "row", col, a < 254.5 AND covered AND a <> 7 AS allowed FROM m')
def q_fill_allowed(spark, sf_dir):
    i, r, c = (F.col(x) for x in AT)
    return grids(spark, sf_dir).select(*AT, masks.fill_allowed((i + r * 37 + c * 11) % 256, (i + r) % 5 != 0, 7).alias("allowed"))


@query("q_discovery_mask", f'WITH {ALPHA} SELECT raster_id, "row", col, depth > -32766.9 AND depth >= -50 AS by_depth, a < 254.5 AND a <> 0 AS by_alpha FROM m')
def q_discovery_mask(spark, sf_dir):
    i, r, c = (F.col(x) for x in AT)
    a = (i + r * 37 + c * 11) % 256
    return grids(spark, sf_dir).select(*AT, masks.discovery(F.col("depth"), False, -32767.0).alias("by_depth"), masks.discovery(a, True, 0).alias("by_alpha"))


@query("q_dilate", f"""WITH {WET}, d AS (SELECT DISTINCT raster_id, "row" + i AS "row", col + j AS col FROM wet, {SQUARE} WHERE wet)
  SELECT w.raster_id, w."row", w.col, d.raster_id IS NOT NULL AS dilated FROM wet w LEFT JOIN d USING (raster_id, "row", col)""")
def q_dilate(spark, sf_dir):
    return focal.dilate(_wet(spark, sf_dir), ["raster_id"], "wet").select(*AT, "dilated")


@query("q_dilate_cross", f"""WITH {WET}, d AS (SELECT DISTINCT raster_id, "row" + i AS "row", col + j AS col FROM wet, {SQUARE} WHERE wet AND abs(i) + abs(j) < 2)
  SELECT w.raster_id, w."row", w.col, d.raster_id IS NOT NULL AS dilated FROM wet w LEFT JOIN d USING (raster_id, "row", col)""")
def q_dilate_cross(spark, sf_dir):
    return focal.dilate(_wet(spark, sf_dir), ["raster_id"], "wet", cross=True).select(*AT, "dilated")


ROWS = 'min(CAST(wet AS INTEGER)) OVER (PARTITION BY raster_id, "row" ORDER BY col ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)'
COLS = 'min(m) OVER (PARTITION BY raster_id, col ORDER BY "row" ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)'


@query("q_erode", f"""WITH {WET}, a AS (SELECT raster_id, "row", col, {ROWS} AS m FROM wet), b AS (SELECT raster_id, "row", col, {COLS} = 1 AS eroded FROM a)
  SELECT raster_id, "row", col, eroded, eroded AND "row" BETWEEN 2 AND 5 AND col BETWEEN 2 AND 5 AS bare FROM b""")
def q_erode(spark, sf_dir):
    wet = _wet(spark, sf_dir)
    padded = focal.erode(wet, ["raster_id"], "wet", 2)
    return focal.erode(padded.withColumnRenamed("eroded", "padded"), ["raster_id"], "wet", 2, outside=False).select(*AT, F.col("padded").alias("eroded"), F.col("eroded").alias("bare"))


TAPS = ", ".join(f"({k - 4}, {x!r})" for k, x in enumerate(focal.gaussian(1.0)))
MIRROR = "CASE WHEN ({0} % 16 + 16) % 16 < 8 THEN ({0} % 16 + 16) % 16 ELSE 15 - ({0} % 16 + 16) % 16 END"


@query("q_blur", f"""WITH {GRIDS}, taps(k, x) AS (VALUES {TAPS}), v AS (SELECT raster_id, "row", col, CASE WHEN depth < -100 THEN 0.0 ELSE depth END AS v, depth < -100 AS gap, depth FROM grids),
h AS (SELECT a.raster_id, a."row", a.col, sum(x * b.v) AS v FROM v a CROSS JOIN taps JOIN v b ON b.raster_id = a.raster_id AND b."row" = {MIRROR.format('(a."row" + k)')} AND b.col = a.col GROUP BY ALL),
w AS (SELECT a.raster_id, a."row", a.col, sum(x * b.v) AS v FROM h a CROSS JOIN taps JOIN h b ON b.raster_id = a.raster_id AND b.col = {MIRROR.format('(a.col + k)')} AND b."row" = a."row" GROUP BY ALL)
SELECT v.raster_id, v."row", v.col, CASE WHEN gap THEN -32767.0 ELSE round(w.v, 5) END AS blurred FROM v JOIN w USING (raster_id, "row", col)""")
def q_blur(spark, sf_dir):
    g = grids(spark, sf_dir).withColumn("depth", F.when(F.col("depth") < -100, -32767.0).otherwise(F.col("depth")))
    return focal.blur(g, ["raster_id"], "depth", 1.0, -32767.0).select(*AT, F.round("blurred", 5).alias("blurred"))


def _shade_sql():
    x, y = "(dzdx * 5.0 / 30.0)", "(dzdy * 5.0 / 30.0)"
    steep = f"({x} * {x} + {y} * {y})"
    total = []
    for az in (225.0, 270.0, 315.0, 360.0):
        a = math.radians(az)
        lit = f"greatest(({math.sin(math.radians(45))!r} - {math.cos(math.radians(45))!r} * ({x} * {math.sin(a)!r} - {y} * {math.cos(a)!r})) / sqrt(1 + {steep}), 0.0)"
        total.append(f"(CASE WHEN {steep} > 0 THEN pow({x} * {math.cos(a)!r} + {y} * {math.sin(a)!r}, 2) / {steep} ELSE 0.5 END) * {lit}")
    return " + ".join(total)


@query("q_hillshade", f"""WITH {GRIDS}, n AS (SELECT a.raster_id, a."row", a.col, sum(b.depth * j * CASE WHEN i = 0 THEN 2 ELSE 1 END) / 8 AS dzdx, sum(b.depth * i * CASE WHEN j = 0 THEN 2 ELSE 1 END) / 8 AS dzdy, count(*) AS n
  FROM grids a, {SQUARE} JOIN grids b ON b.raster_id = a.raster_id AND b."row" = a."row" + i AND b.col = a.col + j GROUP BY ALL) SELECT raster_id, "row", col, round(1 + 254 * ({_shade_sql()}) / 2, 5) AS shade FROM n WHERE n = 9""")
def q_hillshade(spark, sf_dir):
    return focal.hillshade(grids(spark, sf_dir), ["raster_id"], "depth", 5.0, 30.0).select(*AT, F.round("shade", 5).alias("shade"))


@query("q_nearest", f"""WITH {GRIDS}, c AS (SELECT *, depth > -40 AS valid, (raster_id + col) % 3 <> 0 AS fillable FROM grids), p AS (SELECT a.raster_id, a."row", a.col, b.depth AS v,
  row_number() OVER (PARTITION BY a.raster_id, a."row", a.col ORDER BY (a."row" - b."row") ** 2 + (a.col - b.col) ** 2, b."row", b.col) AS n FROM c a JOIN c b ON b.raster_id = a.raster_id AND b.valid WHERE NOT a.valid AND a.fillable)
  SELECT c.raster_id, c."row", c.col, round(coalesce(p.v, c.depth), 6) AS depth FROM c LEFT JOIN p ON p.n = 1 AND p.raster_id = c.raster_id AND p."row" = c."row" AND p.col = c.col""")
def q_nearest(spark, sf_dir):
    c = grids(spark, sf_dir).withColumns({"valid": F.col("depth") > -40, "fillable": (F.col("raster_id") + F.col("col")) % 3 != 0})
    return focal.fill_nearest(c, ["raster_id"], ["depth"], "valid", "fillable").select(*AT, F.round("depth", 6).alias("depth"))


REACHED = f"""reached AS (SELECT raster_id, "row", col FROM wet WHERE wet AND ("row" IN (0, 7) OR col IN (0, 7)) UNION SELECT w.raster_id, w."row", w.col FROM reached r, {SQUARE} JOIN wet w ON w.wet AND w.raster_id = r.raster_id AND w."row" = r."row" + i AND w.col = r.col + j)"""


@query("q_components", f"""WITH RECURSIVE {WET}, {REACHED} SELECT w.raster_id, w."row", w.col, w.wet, r.raster_id IS NOT NULL AS "open" FROM wet w LEFT JOIN (SELECT DISTINCT * FROM reached) r USING (raster_id, "row", col)""")
def q_components(spark, sf_dir):
    return focal.reached_from_edge(_wet(spark, sf_dir), "raster_id", "wet", block=4).select(*AT, "wet", "open")


@query("q_ocean_alpha", f"""WITH RECURSIVE {WET.replace('depth < -30', 'depth < -50')}, {REACHED}, r AS (SELECT DISTINCT * FROM reached), o AS (SELECT w.raster_id, w."row", w.col, r.raster_id IS NOT NULL AS wet FROM wet w LEFT JOIN r USING (raster_id, "row", col)),
a AS (SELECT raster_id, "row", col, {ROWS.replace('2 PRE', '1 PRE').replace('2 FOL', '1 FOL')} AS m FROM o) SELECT raster_id, "row", col, CASE WHEN {COLS.replace('2 PRE', '1 PRE').replace('2 FOL', '1 FOL')} = 1 THEN 255 ELSE 0 END AS alpha FROM a""")
def q_ocean_alpha(spark, sf_dir):
    return focal.ocean_alpha(grids(spark, sf_dir), "raster_id", "depth", erosion=1).select(*AT, "alpha")


@query("q_row_slabs", f'WITH {GRIDS} SELECT raster_id, CAST("row" // 3 AS INTEGER) AS slab, count(*) AS n FROM grids GROUP BY ALL')
def q_row_slabs(spark, sf_dir):
    return grids(spark, sf_dir).select("raster_id", focal.row_slabs(3).alias("slab")).groupBy("raster_id", "slab").agg(F.count("*").alias("n"))
