"""Grid codes, resampling, archives and streams: what SQL has no words for, and nearest neighbours, which it has."""

import functools

from pyspark.sql import functions as F

from ..functions import geo, mgrs
from ..operators import resample, tiles
from ..operators.staging import folder, staged
from ..sources import files, parts, sinks
from ..sources.tables import grids, points, table
from ..streaming import tiles as streams
from .geodesy import EPS9, SIZE9, R
from .registry import GRIDS, POINTS, query
from .renders import MERC_Y, footprint_sql, mgrs_sql
from .tiling import BASE, ZOOM, _base, _over_sql


@query("q_mgrs_code", f"WITH {POINTS}, {mgrs_sql('points', 'id')} SELECT id, code, CASE WHEN length(code) = 5 THEN 5 END AS corners FROM coded")
def q_mgrs_code(spark, sf_dir):
    p = points(spark, sf_dir).withColumn("code", mgrs.code_of("lon", "lat"))
    ring = mgrs.outline_of("code")
    return p.select("id", "code", F.when(ring.isNotNull(), F.size(ring)).alias("corners"))


@query("q_mgrs_bbox", f"""WITH {POINTS}, x AS (SELECT id, lat, lon + 0.8 AS maxx, lat + 0.6 AS maxy, lon, CAST(floor(((lon + 0.8) - lon) / 0.1) AS INTEGER) + 1 AS nx, CAST(floor(((lat + 0.6) - lat) / 0.1) AS INTEGER) + 1 AS ny FROM points),
g AS (SELECT id, least(lon + i * 0.1, maxx) AS lon, least(lat + j * 0.1, maxy) AS lat FROM (SELECT *, unnest(range(0, nx + 1)) AS i FROM x) a, LATERAL (SELECT unnest(range(0, a.ny + 1)) AS j) b),
{mgrs_sql('g', 'id')} SELECT DISTINCT id, code FROM coded WHERE code IS NOT NULL""")
def q_mgrs_bbox(spark, sf_dir):
    b = points(spark, sf_dir).select("id", F.col("lon").alias("minx"), F.col("lat").alias("miny"), (F.col("lon") + 0.8).alias("maxx"), (F.col("lat") + 0.6).alias("maxy"))
    return mgrs.codes_in(b)


CLAMPED = f"least(greatest(lat, {-geo.MAX_LATITUDE!r}), {geo.MAX_LATITUDE!r})"


@query("q_footprint", f"""WITH {POINTS}, {mgrs_sql('points', 'id')}, {footprint_sql()}, b AS (SELECT unit, min(lon * {R} / 180.0) AS minx, max(lon * {R} / 180.0) AS maxx, min({MERC_Y.format(CLAMPED)}) AS miny, max({MERC_Y.format(CLAMPED)}) AS maxy FROM corners GROUP BY unit),
r AS (SELECT unit, {', '.join(f'CAST(least(greatest(floor(({v}) / {SIZE9!r}), 0), 511) AS INTEGER) AS {n}' for n, v in (('x0', f'minx + {EPS9!r} + {R}'), ('x1', f'maxx - {EPS9!r} + {R}'), ('y0', f'{R} - maxy + {EPS9!r}'), ('y1', f'{R} - miny - {EPS9!r}')))} FROM b)
  SELECT unit, CAST(unnest(range(y0, y1 + 1)) AS INTEGER) AS ty, x0 AS tx_min, x1 AS tx_max FROM r""")
def q_footprint(spark, sf_dir):
    """Outlines of codes as row slabs of tiles."""
    ring = points(spark, sf_dir).select(mgrs.code_of("lon", "lat").alias("unit")).distinct().select("unit", F.explode(mgrs.outline_of("unit")).alias("p"))
    box = ring.groupBy("unit").agg(*(f(m(F.col(f"p.{c}"))).alias(n) for n, f, m, c in (("minx", F.min, geo.mercator_x, "lon"), ("miny", F.min, geo.mercator_y, "lat"), ("maxx", F.max, geo.mercator_x, "lon"), ("maxy", F.max, geo.mercator_y, "lat"))))
    x0, y0, x1, y1 = geo.tile_range(*(F.col(c) for c in ("minx", "miny", "maxx", "maxy")), 9)
    return box.select("unit", F.explode(F.sequence(y0, y1)).alias("ty"), x0.alias("tx_min"), x1.alias("tx_max"))


TARGETS = f"{GRIDS}, t AS (SELECT raster_id, CAST(r AS INTEGER) AS orow, CAST(c AS INTEGER) AS ocol, (c + 0.5) * 8 / 5.0 AS sx, (r + 0.5) * 8 / 5.0 AS sy FROM (SELECT DISTINCT raster_id FROM grids), range(5) a(r), range(5) b(c))"


def _targets(spark, sf_dir):
    steps = F.sequence(F.lit(0), F.lit(4))
    t = grids(spark, sf_dir).select("raster_id").distinct().select("raster_id", F.explode(steps).alias("orow")).select("*", F.explode(steps).alias("ocol"))
    return t.withColumns({"sx": (F.col("ocol") + 0.5) * 8 / 5.0, "sy": (F.col("orow") + 0.5) * 8 / 5.0})


KEYS = ["raster_id", "orow", "ocol"]


@query("q_warp_nearest", f'WITH {TARGETS} SELECT t.raster_id, orow, ocol, round(g.depth, 6) AS depth FROM t LEFT JOIN grids g ON g.raster_id = t.raster_id AND g."row" = floor(sy) AND g.col = floor(sx)')
def q_warp_nearest(spark, sf_dir):
    return resample.gather(_targets(spark, sf_dir), grids(spark, sf_dir), KEYS, ["raster_id"], ["depth"], "nearest").select(*KEYS, F.round("depth", 6).alias("depth"))


@query("q_warp_bilinear", f"""WITH {TARGETS}, w AS (SELECT t.raster_id, orow, ocol, greatest(1 - abs(g."row" + 0.5 - sy), 0.0) * greatest(1 - abs(g.col + 0.5 - sx), 0.0) AS w, g.depth FROM t JOIN grids g ON g.raster_id = t.raster_id AND abs(g."row" + 0.5 - sy) < 1 AND abs(g.col + 0.5 - sx) < 1)
  SELECT raster_id, orow, ocol, round(sum(w * depth) / sum(w), 5) AS depth FROM w GROUP BY ALL""")
def q_warp_bilinear(spark, sf_dir):
    return resample.gather(_targets(spark, sf_dir), grids(spark, sf_dir), KEYS, ["raster_id"], ["depth"], "bilinear").select(*KEYS, F.round("depth", 5).alias("depth"))


@query("q_warp_lanczos", f"""WITH {TARGETS}, d AS (SELECT t.raster_id, orow, ocol, abs(g."row" + 0.5 - sy) AS dy, abs(g.col + 0.5 - sx) AS dx, g.depth FROM t JOIN grids g ON g.raster_id = t.raster_id AND abs(g."row" + 0.5 - sy) < 3 AND abs(g.col + 0.5 - sx) < 3),
w AS (SELECT raster_id, orow, ocol, depth, CASE WHEN dx < 1e-9 THEN 1 ELSE sin(pi() * dx) / (pi() * dx) * sin(pi() * dx / 3) / (pi() * dx / 3) END * CASE WHEN dy < 1e-9 THEN 1 ELSE sin(pi() * dy) / (pi() * dy) * sin(pi() * dy / 3) / (pi() * dy / 3) END AS w FROM d)
  SELECT raster_id, orow, ocol, round(sum(w * depth) / sum(w), 4) AS depth FROM w GROUP BY ALL""")
def q_warp_lanczos(spark, sf_dir):
    return resample.gather(_targets(spark, sf_dir), grids(spark, sf_dir), KEYS, ["raster_id"], ["depth"], "lanczos").select(*KEYS, F.round("depth", 4).alias("depth"))


@query("q_average", f'WITH {GRIDS} SELECT raster_id, CAST("row" // 3 AS INTEGER) AS "row", CAST(col // 3 AS INTEGER) AS col, round(avg(depth), 5) AS depth FROM grids GROUP BY ALL')
def q_average(spark, sf_dir):
    return resample.average(grids(spark, sf_dir), ["raster_id"], ["depth"], 3).select("raster_id", "row", "col", F.round("depth", 5).alias("depth"))


@query("q_halo", f"""WITH {GRIDS}, b AS (SELECT DISTINCT raster_id, "row", col, CAST(floor(("row" + i) / 4.0) AS INTEGER) AS br, CAST(floor((col + j) / 4.0) AS INTEGER) AS bc FROM grids, (VALUES (-1), (0), (1)) i(i), (VALUES (-1), (0), (1)) j(j))
  SELECT raster_id, br, bc, count(*) AS n, count(*) FILTER ("row" // 4 = br AND col // 4 = bc) AS core FROM b GROUP BY ALL""")
def q_halo(spark, sf_dir):
    return resample.halo(grids(spark, sf_dir), ["raster_id"], 4, 1).groupBy("raster_id", "br", "bc").agg(F.count("*").alias("n"), F.count_if("core").alias("core"))


@query("q_pan_view", f"""WITH {POINTS}, v AS (SELECT id, CAST(1024 + id % 700 AS INTEGER) AS full_width, least(greatest(lon / 180, -1.0), 1.0) AS pan FROM points) SELECT id, least(full_width, 1024) AS width, CAST(round_even((full_width - least(full_width, 1024)) * least(greatest(pan, 0.0), 1.0), 0) AS INTEGER) AS xoff FROM v""")
def q_pan_view(spark, sf_dir):
    full = (F.col("id") % 700 + 1024).cast("int")
    width = F.least(full, F.lit(1024))
    return points(spark, sf_dir).select("id", width.alias("width"), F.bround((full - width) * F.least(F.greatest(F.col("lon") / 180, F.lit(0.0)), F.lit(1.0)), 0).cast("int").alias("xoff"))


def _png(spark, sf_dir):
    return sinks.png_tiles(_base(spark, sf_dir), 8)


@query("q_png_tiles", f"WITH {BASE} SELECT * FROM l0")
def q_png_tiles(spark, sf_dir):
    """Tiles as PNG and back."""
    return files.png_pixels(_png(spark, sf_dir))


@query("q_mbtiles_roundtrip", f"""WITH {GRIDS} SELECT DISTINCT {ZOOM} AS zoom_level, CAST(raster_id % 64 AS INTEGER) AS tile_column, CAST({2**ZOOM - 1} - raster_id // 64 AS INTEGER) AS tile_row FROM grids""")
def q_mbtiles_roundtrip(spark, sf_dir):
    chunks = sinks.mbtiles_chunks(_png(spark, sf_dir), {"name": "tiles", "format": "png", "type": "baselayer", "version": "1"}, side=2)
    return files.mbtiles(chunks.select(F.col("chunk").alias("path"), "content")).select("zoom_level", "tile_column", "tile_row")


@query("q_pmtiles_tiles", f"WITH {BASE} SELECT DISTINCT z, tx, ty, true AS whole FROM l0")
def q_pmtiles_tiles(spark, sf_dir):
    """An archive's directories read back: which tiles they name, and whether each names bytes of the tile's length right behind the tile before."""
    parts = staged(sinks.pmtiles_parts(_png(spark, sf_dir), {"name": "tiles"}), "parts")
    named = files.directory_entries(parts.where("kind = -2").select("content"))
    return named.join(parts.where("kind = -1").select(F.col("sub").alias("id"), "content"), "id").select("z", "tx", "ty", ((F.octet_length("content") == F.col("length")) & F.col("follows")).alias("whole"))


@query("q_stream_counts", "SELECT CAST(time_bucket(INTERVAL 1 DAY, ts) AS VARCHAR) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def q_stream_counts(spark, sf_dir):
    """The events as a stream, in one go."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    counts = streams.scene_counts(stream.withColumn("ts", F.col("ts").cast("timestamp")))
    return streams.settled(counts).select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


@query("q_over_tiles", f"""WITH {BASE}, l AS (SELECT * FROM l0 WHERE tx % 2 = 0), t AS (SELECT z, tx, ty, "row", col, 255 AS r, g, b, 128 AS a FROM l)
  SELECT l.z, l.tx, l.ty, l."row", l.col, {_over_sql('l', 't')} FROM l JOIN t USING (z, tx, ty, "row", col) UNION ALL SELECT * FROM l0 WHERE tx % 2 <> 0""")
def q_over_tiles(spark, sf_dir):
    """A tile tree committed into another: new tiles over those that are there."""
    base = _base(spark, sf_dir)
    key = ["z", "tx", "ty", "row", "col"]
    layers = base.withColumn("seq", F.lit(0)).unionByName(base.where("tx % 2 = 0").withColumns({"seq": F.lit(1), "a": F.lit(128), "r": F.lit(255)}))
    return tiles.fold_layers(layers, key, "seq")


FLAT = f"{BASE}, flat AS (SELECT DISTINCT z, tx, ty, CAST(tx // 4 % 3 * 80 AS INTEGER) AS r, CAST(ty % 2 * 90 AS INTEGER) AS g FROM l0)"


def _flat(spark, sf_dir):
    """An archive of tiles of one colour each, six colours in all, as a file in the shared folder."""
    colour = {"r": (F.floor(F.col("tx") / 4) % 3 * 80).cast("int"), "g": (F.col("ty") % 2 * 90).cast("int"), "b": F.lit(7), "a": F.lit(255)}
    made = staged(sinks.shared_pmtiles(sinks.png_tiles(_base(spark, sf_dir).withColumns(colour), 8), {"name": "flat"}, leaf=64), "parts")
    where = folder(spark, "archive")
    parts.write_files(made.select(F.lit("flat.pmtiles").alias("path"), "kind", F.col("sub").alias("level"), "content"), where).collect()
    return made, f"{where}/flat.pmtiles"


@query("q_pmtiles_runs", f"WITH {FLAT} SELECT z, tx, ty, r, g, (SELECT count(DISTINCT r * 1000 + g) FROM flat) AS contents FROM flat")
def q_pmtiles_runs(spark, sf_dir):
    """Equal tiles stored once, neighbours as runs: all tiles read back, and how many contents there are."""
    made, path = _flat(spark, sf_dir)
    contents = made.where("kind = -1").count()
    tiles_ = files.pmtiles(_base(spark, sf_dir).select("z", "tx", "ty").distinct(), path)
    return files.png_pixels(tiles_).where("row = 3 and col = 5").select("z", "tx", "ty", "r", "g", F.lit(contents).cast("long").alias("contents"))


@query("q_pmtiles_bbox", f"WITH {FLAT} SELECT z, tx, ty, r, g FROM flat WHERE tx BETWEEN 5 AND 41 AND ty BETWEEN 1 AND 9")
def q_pmtiles_bbox(spark, sf_dir):
    """The tiles of a box, by header, root and the leaves that are needed."""
    _, path = _flat(spark, sf_dir)
    box = spark.range(5, 42).select(F.lit(ZOOM).alias("z"), F.col("id").cast("int").alias("tx"), F.explode(F.sequence(F.lit(1), F.lit(9))).alias("ty"))
    return files.png_pixels(files.pmtiles(box, path)).where("row = 0 and col = 0").select("z", "tx", "ty", "r", "g")


@query("q_tree_merge", f"""WITH {BASE}, low AS (SELECT * FROM l0 WHERE tx % 2 = 1), mid AS (SELECT z, tx, ty, "row", col, 200 AS r, g, b, CAST("row" * 30 AS INTEGER) AS a FROM l0 WHERE ty % 2 = 0), top AS (SELECT z, tx, ty, "row", col, r, 10 AS g, b, 255 AS a FROM l0 WHERE tx % 3 = 0),
both_ AS (SELECT l.z, l.tx, l.ty, l."row", l.col, {_over_sql('l', 't')} FROM low l JOIN mid t USING (z, tx, ty, "row", col))
SELECT *, false AS decoded FROM top UNION ALL SELECT *, true FROM both_ WHERE tx % 3 <> 0 UNION ALL SELECT *, false FROM low WHERE tx % 3 <> 0 AND ty % 2 <> 0 UNION ALL SELECT *, false FROM mid WHERE tx % 3 <> 0 AND tx % 2 <> 1""")
def q_tree_merge(spark, sf_dir):
    """Three trees of tiles merged; only tiles with something to mix are decoded."""
    base = _base(spark, sf_dir)
    trees = [base.where("tx % 2 = 1"), base.where("ty % 2 = 0").withColumns({"r": F.lit(200), "a": (F.col("row") * 30).cast("int")}), base.where("tx % 3 = 0").withColumn("g", F.lit(10))]
    encoded = functools.reduce(lambda a, b: a.unionByName(b), (sinks.png_tiles(t, 8).withColumn("layer", F.lit(i)) for i, t in enumerate(trees)))
    merged = tiles.merge_trees(staged(encoded, "trees"))
    return files.png_pixels(merged).join(merged.select("z", "tx", "ty", "decoded"), ["z", "tx", "ty"])


@query("q_tile_tree", f"WITH {BASE} SELECT * FROM l0")
def q_tile_tree(spark, sf_dir):
    """A tree of z/x/y files, written by many tasks and read back."""
    where = folder(spark, "tree")
    name = F.concat(F.concat_ws("/", *(F.col(c).cast("string") for c in ("z", "tx", "ty"))), F.lit(".png"))
    parts.write_files(_png(spark, sf_dir).select(name.alias("path"), "content"), where).collect()
    return files.png_pixels(files.tile_tree(spark, where, "png").withColumnsRenamed({"x": "tx", "y": "ty"}))
