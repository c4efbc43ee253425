"""Mosaics of dated pixels."""

from pyspark.sql import functions as F

from ..functions import color, geo, masks
from ..operators import mosaic, tiles
from ..sources.tables import grids, pixels
from .registry import GRIDS, PIXELS, query

CELL = ["unit", "row", "col"]
H = geo.SEASON_METRES / geo.METRES_PER_DEGREE
T = f"least(greatest((\"row\" / 8.0 - 2.0 + {H!r}) / (2 * {H!r}), 0.0), 1.0)"
S = f"({T} * {T} * (3 - 2 * {T}))"
WEIGHTED = f"""{PIXELS}, w AS (SELECT *, CASE WHEN date_idx = 0 THEN {S} ELSE 1 - {S} END AS w FROM pixels WHERE r IS NOT NULL AND g IS NOT NULL AND b IS NOT NULL),
cells AS (SELECT DISTINCT unit, "row", col FROM pixels),
m AS (SELECT unit, "row", col, sum(w) AS sw, count(*) AS n, sum(w * r) AS wr, sum(w * g) AS wg, sum(w * b) AS wb, sum(r) AS sr, sum(g) AS sg, sum(b) AS sb FROM w GROUP BY unit, "row", col),
mosaic AS (SELECT c.unit, c."row", c.col, {', '.join(f'CASE WHEN sw > 0 THEN w{c} / sw WHEN n > 0 THEN s{c} / n END AS {c}' for c in 'rgb')}, coalesce(n, 0) > 0 AS valid FROM cells c LEFT JOIN m USING (unit, "row", col))"""


def season(date_idx="date_idx"):
    """Of rows as latitudes either side of the equator."""
    lat = F.col("row") / 8.0 - 2.0
    return F.when(F.col(date_idx) == 0, geo.season_weight(lat)).otherwise(geo.season_weight(lat, winter=True))


def weighted(spark, sf_dir):
    return mosaic.weighted_mean(pixels(spark, sf_dir), CELL, season())


@query("q_weighted_mean", f'WITH {WEIGHTED} SELECT unit, "row", col, round(r, 5) AS r, round(g, 5) AS g, round(b, 5) AS b FROM mosaic')
def q_weighted_mean(spark, sf_dir):
    return weighted(spark, sf_dir).select(*CELL, *(F.round(c, 5).alias(c) for c in "rgb"))


@query("q_fallback_mean", f"""WITH {PIXELS} SELECT unit, "row", col, round(CASE WHEN sum(CASE WHEN date_idx = 0 THEN 0.0 ELSE 1.0 END) FILTER (r IS NOT NULL) > 0 THEN sum(CASE WHEN date_idx = 0 THEN 0.0 ELSE r END) FILTER (r IS NOT NULL) / sum(CASE WHEN date_idx = 0 THEN 0.0 ELSE 1.0 END) FILTER (r IS NOT NULL)
  ELSE avg(r) END, 5) AS r FROM pixels GROUP BY unit, "row", col""")
def q_fallback_mean(spark, sf_dir):
    w = F.when(F.col("date_idx") == 0, F.lit(0.0)).otherwise(F.lit(1.0))
    return mosaic.weighted_mean(pixels(spark, sf_dir), CELL, w).select(*CELL, F.round("r", 5).alias("r"))


@query("q_valid_or", f'WITH {PIXELS} SELECT unit, "row", col, bool_or(r IS NOT NULL) AS valid FROM pixels GROUP BY unit, "row", col')
def q_valid_or(spark, sf_dir):
    return weighted(spark, sf_dir).select(*CELL, "valid")


@query("q_band_stack", f"""WITH {PIXELS} SELECT unit, "row", col, max(CASE WHEN date_idx = 0 THEN r END) AS r, max(CASE WHEN date_idx = 1 THEN r END) AS g FROM pixels GROUP BY unit, "row", col""")
def q_band_stack(spark, sf_dir):
    rows = pixels(spark, sf_dir).select(*CELL, F.when(F.col("date_idx") == 0, "r").otherwise("g").alias("band"), F.col("r").alias("value"))
    return mosaic.stack_bands(rows, CELL, "band", "value", ("r", "g"))


MASKED = f"""{WEIGHTED}, a AS (SELECT *, (unit + "row" * 3 + col) % 4 <> 0 AS allowed, (unit + col) % 9 <> 0 AS covered FROM mosaic),
o AS (SELECT unit, "row", col, CASE WHEN allowed THEN r END AS r, valid AND allowed AS valid, allowed, covered FROM a),
near AS (SELECT DISTINCT unit, "row" + i.i AS "row", col + j.j AS col FROM o, (VALUES (-1), (0), (1)) i(i), (VALUES (-1), (0), (1)) j(j) WHERE valid)"""


@query("q_seam_fill", f"""WITH {MASKED} SELECT o.unit, o."row", o.col, round(r, 5) AS r, valid, covered AND NOT allowed AND n.unit IS NOT NULL AS seam, (allowed OR covered) AND n.unit IS NOT NULL AS keep
  FROM o LEFT JOIN near n ON n.unit = o.unit AND n."row" = o."row" AND n.col = o.col""")
def q_seam_fill(spark, sf_dir):
    u, r, c = (F.col(x) for x in CELL)
    m = weighted(spark, sf_dir).withColumns({"allowed": (u + r * 3 + c) % 4 != 0, "covered": (u + c) % 9 != 0})
    out = mosaic.apply_mask(m, ["unit"])
    return out.select(*CELL, F.round("r", 5).alias("r"), "valid", "seam", "keep")


@query("q_mask_join", f"""WITH {PIXELS}, {GRIDS} SELECT p.unit, p."row", p.col, p.date_idx, p.r, g.depth < -50 AND g.depth > -32766.9 AS wet FROM pixels p LEFT JOIN grids g ON g.raster_id = p.unit AND g."row" = p."row" AND g.col = p.col""")
def q_mask_join(spark, sf_dir):
    mask = grids(spark, sf_dir).select(F.col("raster_id").alias("unit"), "row", "col", masks.ocean(F.col("depth")).alias("wet"))
    return mosaic.align(pixels(spark, sf_dir).select(*CELL, "date_idx", "r"), mask, CELL)


@query("q_virtual_mosaic", f"""WITH {PIXELS}, s AS (SELECT *, CASE WHEN r IS NULL THEN 0 ELSE 255 END AS a FROM pixels) SELECT "row", col, arg_max(r, unit * 2 + date_idx) AS r, max(unit * 2 + date_idx) AS prio FROM s WHERE a > 0 GROUP BY "row", col""")
def q_virtual_mosaic(spark, sf_dir):
    s = pixels(spark, sf_dir).select("row", "col", "r", (F.col("unit") * 2 + F.col("date_idx")).alias("prio"), F.when(F.col("r").isNull(), 0).otherwise(255).alias("a"))
    return mosaic.latest_source(s, ["row", "col"], "prio").select("row", "col", "r", "prio")


@query("q_histogram", f"""WITH {PIXELS}, v AS (SELECT 0.2126 * least(r / 9000.0, 1.0) + 0.7152 * least(g / 9000.0, 1.0) + 0.0722 * least(b / 9000.0, 1.0) AS v FROM pixels WHERE r IS NOT NULL),
h AS (SELECT CAST(least(floor(v * 128), 127) AS INTEGER) AS bin, count(*) AS n FROM v WHERE v BETWEEN 0 AND 1 GROUP BY 1), t AS (SELECT max(n) AS top FROM h)
SELECT CAST(b.b AS INTEGER) AS bin, coalesce(n, 0) AS "count", round(coalesce(n, 0) / top, 9) AS share FROM range(128) b(b) LEFT JOIN h ON h.bin = b.b CROSS JOIN t""")
def q_histogram(spark, sf_dir):
    p = pixels(spark, sf_dir).where("r is not null")
    value = color.luma(tuple(color.normalise(F.col(c)) for c in "rgb"))
    return mosaic.histogram(p, value).withColumn("share", F.round("share", 9))


@query("q_land_pct", f'WITH {GRIDS} SELECT raster_id, 100.0 * count(*) FILTER (NOT (depth > -32766.9 AND depth < -50)) / count(*) AS land, 100.0 * count(*) FILTER (NOT (depth > -32766.9 AND depth < -50)) / count(*) >= 60 AS enough FROM grids GROUP BY raster_id')
def q_land_pct(spark, sf_dir):
    share = 100.0 * F.count_if(~masks.ocean(F.col("depth"))) / F.count("*")
    return grids(spark, sf_dir).groupBy("raster_id").agg(share.alias("land")).withColumn("enough", masks.has_enough_land(F.col("land"), 60))


@query("q_mosaic_pyramid", f"""WITH {WEIGHTED}, s AS (SELECT unit, "row", col, {', '.join(f'CAST(floor(255 * least(greatest(CASE WHEN {c} / 9000 < 0.3 THEN {c} / 9000 * 1.4 WHEN {c} / 9000 < 0.75 THEN 0.42 + ({c} / 9000 - 0.3) * 0.9 ELSE 0.825 + (least({c} / 9000, 1) - 0.75) * 0.5 END, 0), 1) + 1e-9) AS INTEGER) AS {c}' for c in 'rgb')} FROM mosaic WHERE valid)
  SELECT 9 AS z, CAST((unit % 8 * 32 + col) // 32 // 2 AS INTEGER) AS tx, CAST((unit // 8 * 32 + "row") // 32 // 2 AS INTEGER) AS ty, round(avg(r), 4) AS r, round(avg(g), 4) AS g, round(avg(b), 4) AS b, count(*) AS n FROM s GROUP BY ALL""")
def q_mosaic_pyramid(spark, sf_dir):
    """Two dates as one, toned, in bytes, on a grid of tiles, rolled up by one level."""
    tone = lambda c: F.floor(255 * color.soft_knee(color.normalise(F.col(c))) + 1e-9).cast("int").alias(c)
    m = weighted(spark, sf_dir).where("valid").select(*CELL, *(tone(c) for c in "rgb"))
    at = m.select(F.lit(10).alias("z"), (F.col("unit") % 8).alias("tx"), F.floor(F.col("unit") / 8).cast("int").alias("ty"), "r", "g", "b")
    return tiles.parents(at).groupBy("z", "tx", "ty").agg(*(F.round(F.avg(c), 4).alias(c) for c in "rgb"), F.count("*").alias("n"))
