"""Catalogues, work units, slabs and batches."""

from pyspark.sql import functions as F

from ..functions import geo, text
from ..plans import overlay, units
from ..sources.tables import catalogue, points, slabs, table
from .registry import CATALOGUE, POINTS, SLABS, query

DATES = ("1998/01/01", "1998/07/01", "1997/10/01")
PREFIX = "Scene_mosaic"


def _units(spark, sf_dir):
    return catalogue(spark, sf_dir).select("unit").distinct()


FOLDERS = f"""{CATALOGUE}, dates(date_idx, date_path) AS (VALUES {', '.join(f"({i}, '{d}')" for i, d in enumerate(DATES))}),
wanted AS (SELECT u.unit, d.date_idx, d.date_path, 'Scene_mosaic_' || split_part(d.date_path, '/', 1) || '_' || CASE WHEN d.date_path LIKE '%07/01%' THEN 'Q3' WHEN d.date_path LIKE '%10/01%' THEN 'Q4'
  WHEN d.date_path LIKE '%04/01%' THEN 'Q2' WHEN d.date_path LIKE '%01/01%' THEN 'Q1' ELSE 'Q3' END || '_' || u.unit AS folder FROM (SELECT DISTINCT unit FROM catalogue) u CROSS JOIN dates d)"""


@query("q_catalogue_semi", f"WITH {FOLDERS} SELECT unit, CAST(date_idx AS INTEGER) AS date_idx, date_path, folder FROM wanted w WHERE EXISTS (SELECT 1 FROM catalogue c WHERE c.date_path = w.date_path AND c.folder = w.folder)")
def q_catalogue_semi(spark, sf_dir):
    return units.resolve_folders(_units(spark, sf_dir), DATES, catalogue(spark, sf_dir), PREFIX)


@query("q_first_folder", f"WITH {FOLDERS} SELECT unit, CAST(min(date_idx) AS INTEGER) AS date_idx, arg_min(folder, date_idx) AS folder FROM wanted w WHERE EXISTS (SELECT 1 FROM catalogue c WHERE c.date_path = w.date_path AND c.folder = w.folder) GROUP BY unit")
def q_first_folder(spark, sf_dir):
    return units.resolve_folders(_units(spark, sf_dir), DATES, catalogue(spark, sf_dir), PREFIX, first_only=True).select("unit", "date_idx", "folder")


@query("q_band_path", f"""WITH {CATALOGUE} SELECT DISTINCT folder, CASE WHEN length(folder) + ascii(substr(unit, 4, 1)) % 2 = 24 THEN 'keep/' WHEN ascii(substr(unit, 5, 1)) % 3 = 0 THEN 'scratch/' ELSE 'remote/' END || folder AS path FROM catalogue""")
def q_band_path(spark, sf_dir):
    c = catalogue(spark, sf_dir).select("folder", "unit").distinct()
    keep = c.where((F.length("folder") + F.ascii(F.substring("unit", 4, 1)) % 2) == 24).select("folder", F.concat(F.lit("keep/"), "folder").alias("a")).distinct()
    scratch = c.where(F.ascii(F.substring("unit", 5, 1)) % 3 == 0).select("folder", F.concat(F.lit("scratch/"), "folder").alias("b")).distinct()
    best = F.coalesce("a", "b", F.concat(F.lit("remote/"), "folder"))
    return c.select("folder").distinct().join(keep, "folder", "left").join(scratch, "folder", "left").select("folder", best.alias("path"))


CODES = "codes AS (SELECT DISTINCT lpad(CAST(c_custkey % 60 + 1 AS VARCHAR), 2, '0') || 'T' || chr(CAST(65 + c_custkey % 26 AS INTEGER)) || chr(CAST(65 + (c_custkey // 26) % 26 AS INTEGER)) AS code FROM customer)"


def _codes(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(F.concat(F.lpad((k % 60 + 1).cast("string"), 2, "0"), F.lit("T"), F.chr(65 + k % 26), F.chr(65 + F.floor(k / 26).cast("long") % 26)).alias("code")).distinct()


@query("q_code_semi", f"WITH {CATALOGUE}, {CODES} SELECT code FROM codes WHERE code IN (SELECT split_part(folder, '_', 5) FROM catalogue)")
def q_code_semi(spark, sf_dir):
    return units.land_codes(_codes(spark, sf_dir), catalogue(spark, sf_dir))


@query("q_subtiles", f"""WITH {CATALOGUE}, {CODES}, s AS (SELECT code || x.x AS unit FROM codes CROSS JOIN (VALUES ('_0_0'), ('_0_1'), ('_1_0'), ('_1_1')) x(x))
  SELECT unit FROM s WHERE unit IN (SELECT unit FROM catalogue)""")
def q_subtiles(spark, sf_dir):
    return units.available_units(_codes(spark, sf_dir), catalogue(spark, sf_dir))


@query("q_subtile_expand", f"WITH {CODES} SELECT code, code || x.x AS unit FROM codes CROSS JOIN (VALUES ('_0_0'), ('_0_1'), ('_1_0'), ('_1_1')) x(x)")
def q_subtile_expand(spark, sf_dir):
    return _codes(spark, sf_dir).select("code", F.explode(geo.subtiles(F.col("code"))).alias("unit"))


@query("q_folder_parse", f"""WITH {CATALOGUE} SELECT DISTINCT folder, split_part(folder, '_', 5) AS code, split_part(folder, '_', 5) || '_' || split_part(folder, '_', 6) || '_' || split_part(folder, '_', 7) AS unit,
  split_part(folder, '_', 5) || '_' || split_part(folder, '_', 6) || '_' || split_part(folder, '_', 7) AS cached FROM catalogue""")
def q_folder_parse(spark, sf_dir):
    return catalogue(spark, sf_dir).select("folder", text.folder_parts(F.col("folder")).alias("p"), text.cache_name(F.col("folder")).alias("cached")).select("folder", "p.code", "p.unit", "cached").distinct()


@query("q_quarter", """WITH d AS (SELECT DISTINCT strftime(o_orderdate, '%Y/%m/%d') AS p FROM orders) SELECT p AS date_path, split_part(p, '/', 1) AS "year",
  CASE WHEN p LIKE '%07/01%' THEN 'Q3' WHEN p LIKE '%10/01%' THEN 'Q4' WHEN p LIKE '%04/01%' THEN 'Q2' WHEN p LIKE '%01/01%' THEN 'Q1' ELSE 'Q3' END AS q FROM d""")
def q_quarter(spark, sf_dir):
    p = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy/MM/dd").alias("date_path")).distinct()
    return p.select("date_path", text.year(F.col("date_path")).alias("year"), text.quarter(F.col("date_path")).alias("q"))


@query("q_slab_merge", f"WITH {SLABS} SELECT unit, ty, min(tx_min) AS tx_min, max(tx_max) AS tx_max FROM slabs GROUP BY ALL")
def q_slab_merge(spark, sf_dir):
    return units.merge_slabs(slabs(spark, sf_dir), "unit")


@query("q_slab_clip", f"WITH {SLABS}, c AS (SELECT seq, unit, ty, greatest(tx_min, 10) AS tx_min, least(tx_max, 30) AS tx_max FROM slabs WHERE ty BETWEEN 5 AND 40) SELECT * FROM c WHERE tx_min <= tx_max")
def q_slab_clip(spark, sf_dir):
    return units.clip_slabs(slabs(spark, sf_dir), (10, 30), (5, 40))


TILES = f"{SLABS}, cells AS (SELECT DISTINCT unit, ty, unnest(range(tx_min, tx_max + 1)) AS tx FROM slabs), tiles AS (SELECT ty, CAST(tx AS INTEGER) AS tx, list(unit ORDER BY unit) AS ids FROM cells GROUP BY ty, tx)"


def _tiles(spark, sf_dir):
    return units.contributors(slabs(spark, sf_dir), "unit")


@query("q_contributors", f"WITH {SLABS}, cells AS (SELECT DISTINCT unit, ty, unnest(range(tx_min, tx_max + 1)) AS tx FROM slabs) SELECT ty, CAST(tx AS INTEGER) AS tx, string_agg(CAST(unit AS VARCHAR), ',' ORDER BY unit) AS ids FROM cells GROUP BY ty, tx")
def q_contributors(spark, sf_dir):
    return units.contributors(slabs(spark, sf_dir), "unit").select("ty", "tx", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@query("q_batches", f"""WITH {TILES}, f AS (SELECT *, CASE WHEN lag(tx) OVER w = tx - 1 AND lag(ids) OVER w = ids THEN 0 ELSE 1 END AS fresh FROM tiles WINDOW w AS (PARTITION BY ty ORDER BY tx)),
i AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY ty ORDER BY tx) AS BIGINT) AS island FROM f),
n AS (SELECT *, CAST((row_number() OVER (PARTITION BY ty, island ORDER BY tx) - 1) // 2 AS INTEGER) AS batch FROM i)
SELECT ty, island, batch, min(tx) AS tx_min, max(tx) AS tx_max, CAST(len(any_value(ids)) AS INTEGER) AS n_ids FROM n GROUP BY ty, island, batch""")
def q_batches(spark, sf_dir):
    return units.batches(_tiles(spark, sf_dir), 2).select("ty", "island", "batch", "tx_min", "tx_max", F.size("ids").alias("n_ids"))


PIXEL = f"({2 * geo.HALF_WORLD!r} / (256.0 * 64))"


@query("q_tile_plan", f"""WITH {SLABS}, t AS (SELECT DISTINCT 6 AS z, tx_min AS tx, ty FROM slabs), w AS (SELECT *, greatest(tx * 256 - 3, 0) AS xoff, greatest(ty * 256 - 3, 0) AS yoff, least((tx + 1) * 256 + 3, 16384) AS x1, least((ty + 1) * 256 + 3, 16384) AS y1 FROM t)
  SELECT z, tx, ty, CAST(xoff AS BIGINT) AS xoff, CAST(yoff AS BIGINT) AS yoff, CAST(x1 - xoff AS BIGINT) AS width, CAST(y1 - yoff AS BIGINT) AS height, CAST(tx * 256 - xoff AS BIGINT) AS core_x, CAST(ty * 256 - yoff AS BIGINT) AS core_y,
  round(xoff * {PIXEL} - {geo.HALF_WORLD!r}, 4) AS minx, round({geo.HALF_WORLD!r} - y1 * {PIXEL}, 4) AS miny, round(x1 * {PIXEL} - {geo.HALF_WORLD!r}, 4) AS maxx, round({geo.HALF_WORLD!r} - yoff * {PIXEL}, 4) AS maxy FROM w""")
def q_tile_plan(spark, sf_dir):
    """Windows to render for final tiles, with the halo that a Lanczos kernel needs."""
    t = slabs(spark, sf_dir).select(F.lit(6).alias("z"), F.col("tx_min").alias("tx"), "ty").distinct()
    out = units.tile_plan(t, 256, "lanczos")
    return out.withColumns({c: F.round(c, 4) for c in ("minx", "miny", "maxx", "maxy")})


@query("q_prefetch", f"""WITH {FOLDERS}, f AS (SELECT unit, folder, date_path FROM wanted w WHERE EXISTS (SELECT 1 FROM catalogue c WHERE c.date_path = w.date_path AND c.folder = w.folder)), l AS (SELECT unit, CAST(ascii(substr(unit, 4, 1)) * 10 % 101 AS DOUBLE) AS land FROM (SELECT DISTINCT unit FROM catalogue) WHERE unit NOT LIKE '%_1_1')
  SELECT DISTINCT folder, date_path FROM f LEFT JOIN l USING (unit) WHERE (land IS NULL OR land >= 50) AND folder NOT IN (SELECT folder FROM catalogue WHERE unit LIKE '%_0_0')""")
def q_prefetch(spark, sf_dir):
    """What to fetch ahead: listed folders of units with enough land, or an unknown share, that no cache holds."""
    c = catalogue(spark, sf_dir)
    wanted = units.resolve_folders(_units(spark, sf_dir), DATES, c, PREFIX)
    land = _units(spark, sf_dir).where("unit not like '%_1_1'").select("unit", (F.ascii(F.substring("unit", 4, 1)) * 10 % 101).cast("double").alias("land"))
    return units.prefetch(wanted, land, c.where("unit like '%_0_0'").select("folder"), 50.0)


@query("q_refcount", f"WITH {SLABS} SELECT unit, CAST(sum(tx_max - tx_min + 1) AS BIGINT) AS tiles FROM slabs GROUP BY unit")
def q_refcount(spark, sf_dir):
    return units.reference_counts(slabs(spark, sf_dir))


@query("q_cache_reuse", f"""WITH {SLABS}, cached AS (SELECT unit, ty, tx_min, tx_max, 'cached' AS origin FROM slabs WHERE unit % 3 = 0),
fresh AS (SELECT unit, ty, tx_min, tx_max, 'fresh' AS origin FROM slabs WHERE unit % 3 <> 0 AND unit % 2 = 0) SELECT * FROM cached WHERE unit % 2 = 0 UNION ALL SELECT * FROM fresh""")
def q_cache_reuse(spark, sf_dir):
    s = slabs(spark, sf_dir).select("unit", "ty", "tx_min", "tx_max")
    cached = s.where("unit % 3 = 0").withColumn("origin", F.lit("cached"))
    return units.reuse(s.where("unit % 2 = 0").select("unit"), cached, lambda missing: s.join(missing, "unit", "left_semi").withColumn("origin", F.lit("fresh")))


@query("q_resume", f"WITH {SLABS} SELECT DISTINCT unit, ty FROM slabs WHERE NOT (unit % 5 = 1 AND ty % 2 = 0)")
def q_resume(spark, sf_dir):
    planned = slabs(spark, sf_dir).select("unit", "ty").distinct()
    return units.pending(planned, planned.where("unit % 5 = 1 and ty % 2 = 0"), "unit", "ty")


@query("q_preferred_dates", f"""WITH {CATALOGUE}, r AS (SELECT unit, date_path, CAST(row_number() OVER (PARTITION BY unit ORDER BY CASE date_path WHEN '1998/07/01' THEN 0 WHEN '1998/01/01' THEN 1 ELSE 2 END, date_path DESC) AS INTEGER) AS place
  FROM (SELECT DISTINCT unit, date_path FROM catalogue)) SELECT * FROM r WHERE place <= 2""")
def q_preferred_dates(spark, sf_dir):
    rows = catalogue(spark, sf_dir).select("unit", "date_path").distinct()
    return units.preferred(rows, "unit", "date_path", ("1998/07/01", "1998/01/01")).select("unit", "date_path", "place")


@query("q_estimates", f"""WITH {CATALOGUE}, n AS (SELECT count(DISTINCT unit) AS u, count(*) AS t FROM catalogue) SELECT round(t * 15 / 12.0 + u * (30 / 12.0 + 2), 3) AS seconds, CAST(96.0 AS DOUBLE) AS memory_gb,
  round(t * 600 / 1024.0, 3) AS network_gb, round((60 * t + 50 * 12 + 5 * u + 100) / 1024.0, 3) AS peak_gb, CAST(4.0 * u AS DOUBLE) AS final_mb FROM n""")
def q_estimates(spark, sf_dir):
    n = catalogue(spark, sf_dir).agg(F.count_distinct("unit").alias("u"), F.count("*").alias("t")).first()
    return spark.createDataFrame([{k: round(v, 3) for k, v in units.estimates(n.u, n.t, 12).items()}], "seconds double, memory_gb double, network_gb double, peak_gb double, final_mb double")


LATTICE = f"""{POINTS}, r AS (SELECT id, id % 4 AS owner, CAST(floor(lon) AS BIGINT) AS x, CAST(floor(lat) AS BIGINT) AS y, 2 + id % 11 AS w, 1 + id % 13 AS h FROM points),
squares AS (SELECT id, owner, x + i AS x, y + j AS y FROM r CROSS JOIN range(12) a(i) CROSS JOIN range(13) b(j) WHERE i < w AND j < h AND NOT (w > 2 AND h > 2 AND i = 1 AND j = 1))"""


def _lattice(spark, sf_dir):
    """Rectangles on whole degrees, those of three by three and more with a hole."""
    i = F.col("id")
    r = points(spark, sf_dir).select("id", (i % 4).alias("owner"), F.floor("lon").cast("double").alias("x"), F.floor("lat").cast("double").alias("y"), (2 + i % 11).alias("w"), (1 + i % 13).alias("h"))
    ring = lambda x, y, w, h: F.array(F.array(x, y), F.array(x + w, y), F.array(x + w, y + h), F.array(x, y + h))
    x, y = F.col("x"), F.col("y")
    outer = ring(x, y, F.col("w"), F.col("h"))
    return r.select("id", "owner", F.when((F.col("w") > 2) & (F.col("h") > 2), F.array(outer, ring(x + 1, y + 1, F.lit(1.0), F.lit(1.0)))).otherwise(F.array(outer)).alias("rings"))


@query("q_union_outline", f"""WITH {LATTICE}, u AS (SELECT DISTINCT owner, x, y FROM squares)
SELECT owner, CAST(count(*) AS DOUBLE) AS area, CAST((SELECT count(*) FROM u a CROSS JOIN (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) d(i, j) LEFT JOIN u b ON b.owner = a.owner AND b.x = a.x + i AND b.y = a.y + j WHERE a.owner = u.owner AND b.x IS NULL) AS DOUBLE) AS perimeter FROM u GROUP BY owner""")
def q_union_outline(spark, sf_dir):
    """Areas and outlines of unions with holes, by cells."""
    cells = overlay.union(_lattice(spark, sf_dir), ["owner"], 12.5)
    length = F.aggregate("outline", F.lit(0.0), lambda s, e: s + F.sqrt((e["x2"] - e["x1"]) ** 2 + (e["y2"] - e["y1"]) ** 2))
    return cells.groupBy("owner").agg(F.round(F.sum("area"), 6).alias("area"), F.round(F.sum(length), 6).alias("perimeter"))


@query("q_overlaps", f"""WITH {LATTICE} SELECT a.id AS "left", b.id AS "right", CAST(count(*) AS DOUBLE) AS area FROM squares a JOIN squares b ON a.x = b.x AND a.y = b.y WHERE a.owner = 0 AND b.owner <> 0 GROUP BY a.id, b.id""")
def q_overlaps(spark, sf_dir):
    """Polygons of one owner against all others', by the area that they share. On whole degrees areas are exact."""
    p = _lattice(spark, sf_dir)
    return overlay.overlaps(p.where("owner = 0"), p.where("owner <> 0"), 12.5)
