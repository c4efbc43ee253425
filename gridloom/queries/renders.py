"""Renders put together, and files written and read back."""

import math

from pyspark.sql import functions as F

from ..functions import color, geo, masks, mgrs
from ..operators.staging import folder, staged
from ..plans import render, scenes, units
from ..sources import files, sinks
from ..sources.tables import grids, pixels, points
from .colour import RAMPED, _clip, _grade_sql, _ramp_sql
from .focal import COLS, REACHED, ROWS, SQUARE, _shade_sql
from .geodesy import REGISTRY, _registry
from .mosaics import CELL, WEIGHTED, season
from .records import PARTS, STEPS
from .registry import GRIDS, PIXELS, POINTS, query
from .tiling import BASE, RING, ZOOM, _base, _ring_sql

RGB = ("r", "g", "b")


def _number(x):
    """A double in SQL; without an exponent it would be a decimal."""
    text = repr(float(x))
    return text if "e" in text else f"{text}e0"


MASKS = 'CASE WHEN (unit * 3 + "row" + col) % 4 = 0 THEN 255 ELSE 100 END AS alpha, (unit + "row") % 7 <> 0 AS covered'


def _land_mask(spark, sf_dir):
    u, r, c = (F.col(x) for x in CELL)
    return pixels(spark, sf_dir).select(*CELL).distinct().withColumns({"alpha": F.when((u * 3 + r + c) % 4 == 0, 255).otherwise(100), "covered": (u + r) % 7 != 0})


LAND = f"""{WEIGHTED}, k AS (SELECT *, {MASKS} FROM mosaic), al AS (SELECT *, alpha < 254.5 AND covered AS allowed FROM k),
nb AS (SELECT DISTINCT unit, "row" + i.i AS "row", col + j.j AS col FROM al, {SQUARE} WHERE allowed),
kept AS (SELECT al.* FROM al JOIN nb USING (unit, "row", col) WHERE covered),
every AS (SELECT u.unit, CAST(i AS INTEGER) AS "row", CAST(j AS INTEGER) AS col FROM (SELECT DISTINCT unit FROM kept) u CROSS JOIN range(32) a(i) CROSS JOIN range(32) b(j)),
held AS (SELECT e.*, CASE WHEN k.valid THEN e."row" END AS v FROM every e LEFT JOIN kept k USING (unit, "row", col)),
sides AS (SELECT *, max(v) OVER (PARTITION BY unit, col ORDER BY "row") AS up, min(v) OVER (PARTITION BY unit, col ORDER BY "row" DESC) AS down FROM held),
column_ AS (SELECT unit, "row", col AS vc, CASE WHEN down IS NULL OR "row" - up <= down - "row" THEN up ELSE down END AS vr FROM sides WHERE up IS NOT NULL OR down IS NOT NULL),
found AS (SELECT o.unit, o."row", o.col, min({{'d2': (o."row" - c.vr) * (o."row" - c.vr) + (o.col - c.vc) * (o.col - c.vc), 'vr': c.vr, 'vc': c.vc}}) AS n
  FROM kept o JOIN column_ c ON c.unit = o.unit AND c."row" = o."row" WHERE NOT o.valid AND o.allowed GROUP BY o.unit, o."row", o.col),
near_ AS (SELECT f.unit, f."row", f.col, {{'r': v.r, 'g': v.g, 'b': v.b}} AS n FROM found f JOIN kept v ON v.unit = f.unit AND v."row" = f.n.vr AND v.col = f.n.vc),
filled AS (SELECT k.unit, k."row", k.col, 0 AS date_idx, k.allowed, k.covered, k.valid, {', '.join(f'coalesce(n.n.{c}, k.{c}) AS {c}' for c in RGB)} FROM kept k LEFT JOIN near_ n ON n.unit = k.unit AND n."row" = k."row" AND n.col = k.col),
t AS (SELECT unit, "row", col, date_idx, {', '.join(f'{_clip(f"coalesce({_clip(f"{c} / 9000.0")}, 0.0) * 2.5")} AS {c}' for c in RGB)} FROM filled), {_grade_sql('t', color.LAND, 'd')}"""


@query("q_land_tile", f"""WITH {LAND} SELECT f.unit, f."row", f.col, {', '.join(f'CAST(floor(d.{c} * 255) AS INTEGER) AS {c}' for c in RGB)}, CASE WHEN f.covered THEN CASE WHEN (NOT f.valid AND f.allowed) OR f.allowed THEN 255 ELSE 0 END ELSE 0 END AS a
  FROM filled f JOIN d USING (unit, "row", col) WHERE f."row" BETWEEN 1 AND 30 AND f.col BETWEEN 1 AND 30""")
def q_land_tile(spark, sf_dir):
    """Mask, mean of dates, fill, style, alpha and crop of each unit."""
    return render.land_tile(pixels(spark, sf_dir), _land_mask(spark, sf_dir), ["unit"], season(), ((1, 30), (1, 30)))


OCEAN_MASK = f'{GRIDS}, m AS (SELECT raster_id, "row", col, CASE WHEN depth < 60 THEN 255 ELSE 0 END AS alpha, (raster_id + "row") % 3 <> 0 AS covered FROM grids)'


@query("q_land_tiles", f"""WITH {OCEAN_MASK}, al AS (SELECT *, alpha < 254.5 AND covered AS allowed FROM m), nb AS (SELECT DISTINCT raster_id, "row" + i.i AS "row", col + j.j AS col FROM al, {SQUARE} WHERE allowed)
  SELECT DISTINCT al.raster_id FROM al JOIN nb USING (raster_id, "row", col) WHERE al.covered""")
def q_land_tiles(spark, sf_dir):
    """Tiles that are not all ocean."""
    m = grids(spark, sf_dir).withColumns({"alpha": F.when(F.col("depth") < 60, 255).otherwise(0), "covered": (F.col("raster_id") + F.col("row")) % 3 != 0})
    return render.tiles_with_land(m, ["raster_id"])


WET = 'wet AS (SELECT raster_id, "row", col, depth, depth > -32766.9 AND depth < -50 AS wet FROM grids)'
ALPHA = f"""{WET}, {REACHED}, r_ AS (SELECT DISTINCT * FROM reached), o AS (SELECT w.raster_id, w."row", w.col, r_.raster_id IS NOT NULL AS wet FROM wet w LEFT JOIN r_ USING (raster_id, "row", col)),
a_ AS (SELECT raster_id, "row", col, {ROWS.replace('2 PRE', '1 PRE').replace('2 FOL', '1 FOL')} AS m FROM o), alpha AS (SELECT raster_id, "row", col, CASE WHEN {COLS.replace('2 PRE', '1 PRE').replace('2 FOL', '1 FOL')} = 1 THEN 255 ELSE 0 END AS a FROM a_)"""
SHADE = f"""n AS (SELECT a.raster_id, a."row", a.col, sum(b.depth * j * CASE WHEN i = 0 THEN 2 ELSE 1 END) / 8 AS dzdx, sum(b.depth * i * CASE WHEN j = 0 THEN 2 ELSE 1 END) / 8 AS dzdy, count(*) AS n
  FROM grids a, {SQUARE} JOIN grids b ON b.raster_id = a.raster_id AND b."row" = a."row" + i AND b.col = a.col + j GROUP BY ALL), shade AS (SELECT raster_id, "row", col, 1 + 254 * ({_shade_sql()}) / 2 AS hs FROM n WHERE n = 9)"""
CHUNK = f"""{RAMPED.replace('i AS (SELECT *', 'ramped AS (SELECT *')}, {ALPHA}, {SHADE}, chunk AS (SELECT p.raster_id, p."row", p.col, {', '.join(f'CAST(floor({_clip(f"{_ramp_sql(k)} * (0.35 + 0.65 * hs / 255.0)")} * 255) AS INTEGER) AS {c}' for k, c in enumerate(RGB))}, a
  FROM ramped p JOIN alpha USING (raster_id, "row", col) JOIN shade USING (raster_id, "row", col))"""


def _ocean(spark, sf_dir, erosion):
    return render.ocean_chunk(grids(spark, sf_dir), "raster_id", "depth", ((1, 6), (1, 6)), erosion=erosion, z_factor=5.0, pixel=30.0, scale=60.0)


@query("q_ocean_chunk", f"WITH RECURSIVE {CHUNK} SELECT * FROM chunk")
def q_ocean_chunk(spark, sf_dir):
    """Alpha, light, colour and crop of each chunk."""
    return _ocean(spark, sf_dir, 1)


BARE = CHUNK.replace("CASE WHEN " + COLS.replace("2 PRE", "1 PRE").replace("2 FOL", "1 FOL") + " = 1 THEN 255 ELSE 0 END AS a FROM a_", "CASE WHEN wet THEN 255 ELSE 0 END AS a FROM o")


@query("q_ocean_archive", f"""WITH RECURSIVE {BARE}, shown AS (SELECT raster_id FROM chunk GROUP BY raster_id HAVING max(a) > 0)
  SELECT {ZOOM} AS z, CAST(raster_id % 64 AS INTEGER) AS tx, CAST(raster_id // 64 AS INTEGER) AS ty, "row" - 1 AS "row", col - 1 AS col, r, g, b, a FROM chunk JOIN shown USING (raster_id)""")
def q_ocean_archive(spark, sf_dir):
    """The ocean as an archive of its own, read back."""
    i = F.col("raster_id")
    cells = _ocean(spark, sf_dir, 0).withColumns({"row": F.col("row") - 1, "col": F.col("col") - 1})
    made = render.ocean_tiles(cells, {"z": F.lit(ZOOM), "tx": (i % 64).cast("int"), "ty": F.floor(i / 64).cast("int")}, 6)
    parts = sinks.pmtiles_parts(made, {"name": "ocean"})
    data = parts.where("kind = -1").select(F.col("sub").alias("id"), "content")
    named = files.directory_entries(parts.where("kind = -2").select("content"))
    return files.png_pixels(named.join(data, "id"))


PREVIEW = f"""{RAMPED.replace('i AS (SELECT *', 'ramped AS (SELECT *')}, {WET}, {REACHED}, r_ AS (SELECT DISTINCT * FROM reached), o AS (SELECT w.raster_id, w."row", w.col, w.wet AS raw, r_.raster_id IS NOT NULL AS wet FROM wet w LEFT JOIN r_ USING (raster_id, "row", col)),
a_ AS (SELECT *, {ROWS.replace('2 PRE', '1 PRE').replace('2 FOL', '1 FOL')} AS m FROM o), e AS (SELECT raster_id, "row", col, raw, {COLS.replace('2 PRE', '1 PRE').replace('2 FOL', '1 FOL')} = 1 AND "row" BETWEEN 1 AND 6 AND col BETWEEN 1 AND 6 AS wet FROM a_),
dr AS (SELECT DISTINCT raster_id, "row" + i AS "row", col + j AS col FROM e, {SQUARE} WHERE raw AND abs(i) + abs(j) < 2), dw AS (SELECT DISTINCT raster_id, "row" + i AS "row", col + j AS col FROM e, {SQUARE} WHERE wet AND abs(i) + abs(j) < 2),
b_ AS (SELECT e.*, (dr.raster_id IS NOT NULL) <> e.raw AS fade, (dw.raster_id IS NOT NULL) <> e.wet AS edge FROM e LEFT JOIN dr USING (raster_id, "row", col) LEFT JOIN dw USING (raster_id, "row", col))"""


@query("q_mask_preview", f"""WITH RECURSIVE {PREVIEW} SELECT p.raster_id, p."row", p.col, {', '.join(f'round(CASE WHEN edge THEN {render.EDGE_COLOUR[k]} WHEN fade THEN {render.FADE_COLOUR[k]} WHEN wet THEN {_ramp_sql(k)} ELSE {render.LAND_COLOUR[k]} END, 6) AS {c}' for k, c in enumerate(RGB))}
  FROM ramped p JOIN b_ USING (raster_id, "row", col)""")
def q_mask_preview(spark, sf_dir):
    seen = render.mask_preview(grids(spark, sf_dir), "raster_id", "depth", erosion=1, scale=60.0)
    return seen.select("raster_id", "row", "col", *(F.round(c, 6).alias(c) for c in RGB))


MERC = f"{geo.HALF_WORLD!r}"
MERC_Y = f"(ln(tan((90.0 + ({{}})) * pi() / 360.0)) / (pi() / 180.0) * {MERC} / 180.0)"
TERRAIN = f"""{GRIDS}, p AS (SELECT DISTINCT raster_id, raster_id % 36 * 10.0 - 180.0 AS lon0, 80.0 - raster_id // 36 % 16 * 10.0 AS lat1 FROM grids),
q AS (SELECT *, lon0 * {MERC} / 180.0 AS west, (lon0 + 10.0) * {MERC} / 180.0 AS east, {MERC_Y.format('lat1')} AS north, {MERC_Y.format('lat1 - 10.0')} AS south FROM p),
t AS (SELECT raster_id, CAST(i AS INTEGER) AS orow, CAST(j AS INTEGER) AS ocol, ((west + (j + 0.5) * (east - west) / 6) / {MERC} * 180.0 - lon0) / 1.25 AS sx, (lat1 - degrees(atan(sinh((north - (i + 0.5) * (north - south) / 6) * pi() / {MERC})))) / 1.25 AS sy FROM q, range(6) a(i), range(6) b(j)),
w AS (SELECT t.raster_id, orow, ocol, greatest(1 - abs(g."row" + 0.5 - sy), 0.0) * greatest(1 - abs(g.col + 0.5 - sx), 0.0) AS w, g.depth FROM t JOIN grids g ON g.raster_id = t.raster_id AND abs(g."row" + 0.5 - sy) < 1 AND abs(g.col + 0.5 - sx) < 1),
h AS (SELECT raster_id, orow, ocol, round(sum(w * depth) / sum(w), 5) AS depth FROM w GROUP BY ALL), v AS (SELECT *, least(greatest(depth + 32768.0, 0.0), 65535.99609375) AS v FROM h)"""


@query("q_terrain", f"WITH {TERRAIN} SELECT raster_id, orow, ocol, CAST(floor(floor(v) / 256) AS INTEGER) AS r, CAST(CAST(floor(v) AS BIGINT) % 256 AS INTEGER) AS g, CAST(floor((v - floor(v)) * 256) AS INTEGER) AS b FROM v")
def q_terrain(spark, sf_dir):
    """Elevations in degrees, warped to Web Mercator and encoded."""
    i, g = F.col("raster_id"), grids(spark, sf_dir)
    at = g.select("raster_id").distinct().withColumns({"lon0": i % 36 * 10.0 - 180.0, "lat1": 80.0 - F.floor(i / 36) % 16 * 10.0})
    return render.terrain(render.mercator_grid(at, 6, 8, 1.25), g, ["raster_id", "orow", "ocol"], ["raster_id"], "depth", "bilinear", 5)


VIEWS = f"""{GRIDS}, v AS (SELECT DISTINCT raster_id, raster_id % 11 - 4.0 AS minx, raster_id % 7 - 3.0 AS miny, raster_id % 11 - 4.0 + 3.0 + raster_id % 5 AS maxx, raster_id % 7 - 3.0 + 4.0 + raster_id % 3 AS maxy FROM grids),
x AS (SELECT *, greatest(minx, 0.0) AS x0, least(maxx, 8.0) AS x1, greatest(miny, 0.0) AS y0, least(maxy, 8.0) AS y1 FROM v),
c AS (SELECT *, {', '.join(f'CAST(least(greatest(round_even(({e} - min{d}) * 10 / (max{d} - min{d}), 0), 0), 10) AS INTEGER) AS {n}' for n, e, d in (('a0', 'x0', 'x'), ('a1', 'x1', 'x'), ('b0', 'y0', 'y'), ('b1', 'y1', 'y')))} FROM x),
p AS (SELECT c.*, CAST(i AS INTEGER) AS "row", CAST(j AS INTEGER) AS col, x0 < x1 AND y0 < y1 AND j >= a0 AND j < a1 AND i >= b0 AND i < b1 AS there FROM c, range(10) r(i), range(10) s(j))"""


@query("q_render_bounds", f"""WITH {VIEWS} SELECT p.raster_id, p."row", p.col, round(coalesce(g.depth, 0), 6) AS depth FROM p LEFT JOIN grids g ON p.there AND g.raster_id = p.raster_id
  AND g."row" = floor(y0 + (p."row" - b0 + 0.5) * (y1 - y0) / (b1 - b0)) AND g.col = floor(x0 + (p.col - a0 + 0.5) * (x1 - x0) / (a1 - a0))""")
def q_render_bounds(spark, sf_dir):
    """Bounds of any place and size, padded with nothing."""
    i, g = F.col("raster_id"), grids(spark, sf_dir)
    minx, miny = i % 11 - 4.0, i % 7 - 3.0
    views = g.select("raster_id").distinct().withColumns({"minx": minx, "miny": miny, "maxx": minx + 3.0 + i % 5, "maxy": miny + 4.0 + i % 3, "w": F.lit(8.0), "h": F.lit(8.0)})
    return render.render_bounds(views, g, "raster_id", ["depth"], (10, 10)).withColumn("depth", F.round("depth", 6))


def _overview_sql(method):
    w = render.overview_weights(8, method)
    rows = ", ".join(f"({i}, {k}, {_number(w[i, k])})" for i in range(8) for k in range(16) if w[i, k])
    return f"""{BASE}, k(o, s, w) AS (VALUES {rows}),
m AS (SELECT z - 1 AS z, tx // 2 AS tx, ty // 2 AS ty, ty % 2 * 8 + "row" AS y, tx % 2 * 8 + col AS x, r, g, b, a FROM l0), here AS (SELECT DISTINCT z, tx, ty, y // 2 AS "row", x // 2 AS col FROM m),
s AS (SELECT m.z, m.tx, m.ty, ky.o AS "row", kx.o AS col, sum(ky.w * kx.w * a) AS wa, {', '.join(f'sum(ky.w * kx.w * a * {c}) AS {c}' for c in RGB)} FROM m JOIN k ky ON ky.s = m.y JOIN k kx ON kx.s = m.x GROUP BY ALL)
SELECT z, CAST(tx AS INTEGER) AS tx, CAST(ty AS INTEGER) AS ty, CAST("row" AS INTEGER) AS "row", CAST(col AS INTEGER) AS col, {', '.join(f'CAST(least(greatest(floor(CASE WHEN wa > 0 THEN {c} / wa ELSE 0 END + 0.5 + 1e-9), 0), 255) AS INTEGER) AS {c}' for c in RGB)},
  CAST(least(greatest(floor(wa + 0.5 + 1e-9), 0), 255) AS INTEGER) AS a FROM s JOIN here USING (z, tx, ty, "row", col)"""


@query("q_overview_bilinear", f"WITH {_overview_sql('bilinear')}")
def q_overview_bilinear(spark, sf_dir):
    return render.overview(_base(spark, sf_dir), 8, "bilinear")


@query("q_overview_lanczos", f"WITH {_overview_sql('lanczos')}")
def q_overview_lanczos(spark, sf_dir):
    return render.overview(_base(spark, sf_dir), 8, "lanczos")


@query("q_direct_mbtiles", f"WITH {BASE}, o AS (WITH {_overview_sql('cubic')}) SELECT z, tx, ty, \"row\", col, r, g, b, 255 AS a FROM l0 UNION ALL SELECT z, tx, ty, \"row\", col, r, g, b, 255 FROM o")
def q_direct_mbtiles(spark, sf_dir):
    """A raster straight into tile stores with an overview, read back."""
    made = render.direct_tiles(_base(spark, sf_dir), 8, 1, "cubic")
    chunks = sinks.mbtiles_chunks(made, {"name": "tiles", "format": "png"}, side=16)
    back = files.mbtiles(chunks.select(F.col("chunk").alias("path"), "content"))
    top = F.pow(F.lit(2.0), F.col("zoom_level")).cast("int")
    at = back.select(F.col("zoom_level").alias("z"), F.col("tile_column").alias("tx"), (top - 1 - F.col("tile_row")).alias("ty"), F.col("tile_data").alias("content"))
    # A parent with missing children holds transparent pixels that are made opaque: only those of children are compared.
    there = _base(spark, sf_dir).select("z", "tx", "ty").distinct()
    up = there.select((F.col("z") - 1).alias("z"), F.floor(F.col("tx") / 2).cast("int").alias("tx"), F.floor(F.col("ty") / 2).cast("int").alias("ty"), (F.col("ty") % 2).alias("qy"), (F.col("tx") % 2).alias("qx"))
    shown = files.png_pixels(at).withColumns({"qy": F.floor(F.col("row") / 4).cast("int"), "qx": F.floor(F.col("col") / 4).cast("int")})
    return shown.where(F.col("z") == ZOOM).unionByName(shown.where(F.col("z") < ZOOM).join(up, ["z", "tx", "ty", "qy", "qx"], "left_semi")).drop("qy", "qx")


@query("q_sample_window", f"""WITH {PIXELS}, n AS (SELECT unit, max(date_idx) AS date_idx FROM pixels WHERE r IS NOT NULL AND g IS NOT NULL AND b IS NOT NULL GROUP BY unit)
  SELECT unit, "row", col, {', '.join(f'round(coalesce({_clip(f"{c} / 9000.0")}, 0.0), 9) AS {c}' for c in RGB)} FROM pixels JOIN n USING (unit, date_idx) WHERE "row" BETWEEN 4 AND 19 AND col BETWEEN 8 AND 23""")
def q_sample_window(spark, sf_dir):
    return render.sample_window(pixels(spark, sf_dir), ["unit"], "date_idx", ((4, 19), (8, 23))).select("unit", "row", "col", *(F.round(c, 9).alias(c) for c in RGB))


@query("q_block_prune", f"""WITH {POINTS}, {REGISTRY}, b AS (SELECT id, CAST(k AS INTEGER) AS block, lon AS minx, lon + 4 AS maxx, lat + k * 0.5 AS miny, lat + (k + 1) * 0.5 AS maxy FROM points, range(8) r(k))
  SELECT id, block FROM b WHERE EXISTS (SELECT 1 FROM registry WHERE minx < x1 AND maxx > x0 AND miny < y1 AND maxy > y0)""")
def q_block_prune(spark, sf_dir):
    """Row blocks of rasters whose envelopes overlap a candidate's."""
    k = F.col("block")
    b = points(spark, sf_dir).select("id", "lon", "lat", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("block")).select("id", "block", F.col("lon").alias("minx"), (F.col("lon") + 4).alias("maxx"), (F.col("lat") + k * 0.5).alias("miny"), (F.col("lat") + (k + 1) * 0.5).alias("maxy"))
    boxes = _registry(spark, sf_dir).select(F.col("x0").alias("minx"), F.col("x1").alias("maxx"), F.col("y0").alias("miny"), F.col("y1").alias("maxy"))
    return units.prune_blocks(b, boxes, 10.0).select("id", "block")


def _touch_sql():
    corners = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")]
    inside = [_ring_sql().replace("lat", y).replace("lon", x) for x, y in corners]
    held = [f"(x0 < {x} AND {x} < x1 AND y0 < {y} AND {y} < y1)" for x, y in RING]
    side = lambda a, b, c: f"(({b[0]} - {a[0]}) * ({c[1]} - {a[1]}) - ({b[1]} - {a[1]}) * ({c[0]} - {a[0]}))"
    cross = []
    for p, q in zip(RING, [*RING[1:], RING[0]], strict=True):
        for r, s in zip(corners, [*corners[1:], corners[0]], strict=True):
            p_, q_ = (tuple(f"({v})" for v in e) for e in (p, q))
            cross.append(f"({side(p_, q_, r)} * {side(p_, q_, s)} < 0 AND {side(r, s, p_)} * {side(r, s, q_)} < 0)")
    return " OR ".join(["(" + x + ")" for x in inside] + held + cross)


@query("q_polygon_touch", f"WITH {POINTS}, b AS (SELECT id, lon AS x0, lat AS y0, lon + 9 AS x1, lat + 7 AS y1 FROM points) SELECT id FROM b WHERE {_touch_sql()}")
def q_polygon_touch(spark, sf_dir):
    """Boxes that meet an outline, not only its envelope."""
    boxes = points(spark, sf_dir).select("id", F.col("lon").alias("x0"), F.col("lat").alias("y0"), (F.col("lon") + 9).alias("x1"), (F.col("lat") + 7).alias("y1"))
    return boxes.where(scenes.touches_ring(tuple(F.col(c) for c in ("x0", "y0", "x1", "y1")), RING)).select("id")


@query("q_quadtree_within", f"""WITH {POINTS}, {STEPS}, c AS ({PARTS}), b AS (SELECT *, -180.0 + i * pow(0.5, depth) * 360.0 AS x0, -90.0 + j * pow(0.5, depth) * 180.0 AS y0, -180.0 + (i + 1) * pow(0.5, depth) * 360.0 AS x1, -90.0 + (j + 1) * pow(0.5, depth) * 180.0 AS y1 FROM c)
  SELECT depth, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, n FROM b WHERE {_touch_sql()}""")
def q_quadtree_within(spark, sf_dir):
    """The quadtree's cells that meet an outline."""
    return scenes.quadtree(points(spark, sf_dir), "lon", "lat", (-180.0, -90.0, 180.0, 90.0), most=40, depth=5, keep=staged, within=RING)


AFFINE = (500000.0, 9.5, 1.25, 4000000.0, 0.75, -10.5)


@query("q_affine", f"""WITH {GRIDS} SELECT raster_id, "row", col, {_number(AFFINE[0])} + (col + 0.5e0) * {_number(AFFINE[1])} + ("row" + 0.5e0) * {_number(AFFINE[2])} AS x, {_number(AFFINE[3])} + (col + 0.5e0) * {_number(AFFINE[4])} + ("row" + 0.5e0) * {_number(AFFINE[5])} AS y FROM grids""")
def q_affine(spark, sf_dir):
    x, y = geo.affine(AFFINE, F.col("col") + 0.5, F.col("row") + 0.5)
    return grids(spark, sf_dir).select("raster_id", "row", "col", x.alias("x"), y.alias("y"))


def mgrs_sql(source, carried):
    """SQL for the 100 km square of places (lon, lat): steps from ``source`` to ``coded`` (carried columns and code)."""
    e, scale = float(mgrs.E), f"{_number(mgrs.SCALE)} * {_number(mgrs.RADIUS)}"
    conformal = lambda s: f"sinh(atanh(least({s}, {_number(1 - 1e-16)})) - {_number(e)} * atanh({_number(e)} * least({s}, {_number(1 - 1e-16)})))"
    series = lambda own, a, b: " + ".join([own, *(f"{_number(c)} * {a}(2 * {j} * xi) * {b}(2 * {j} * eta)" for j, c in enumerate(mgrs.ALPHA, 1))])
    k = math.sqrt((1 + e) ** (1 + e) * (1 - e) ** (1 - e))
    letters = lambda text, i: f"CASE WHEN {i} BETWEEN 0 AND length({text}) - 1 THEN substr({text}, CAST({i} AS INTEGER) + 1, 1) END"
    cols = "CASE z % 3 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(mgrs.COLUMNS)) + " END"
    polar_cols = {**mgrs.POLAR_COLUMNS, "Y": mgrs.POLAR_COLUMNS["Y"][5:]}
    first = "CASE WHEN lat > 0 THEN CASE WHEN px >= 2000000 THEN 'Z' ELSE 'Y' END ELSE CASE WHEN px >= 2000000 THEN 'B' ELSE 'A' END END"
    return f"""z_ AS (SELECT {carried}, CASE WHEN lon = 180 THEN -180.0 ELSE lon END AS lon, lat FROM {source}),
z0 AS (SELECT *, lat >= -80 AND lat < 84 AS mid, CAST(CASE WHEN lat >= 56 AND lat < 64 AND lon >= 3 AND lon < 12 THEN 32 WHEN lat >= 72 AND lat <= 84 AND lon >= 0 AND lon < 9 THEN 31 WHEN lat >= 72 AND lat <= 84 AND lon >= 9 AND lon < 21 THEN 33
  WHEN lat >= 72 AND lat <= 84 AND lon >= 21 AND lon < 33 THEN 35 WHEN lat >= 72 AND lat <= 84 AND lon >= 33 AND lon < 42 THEN 37 ELSE least(floor((lon + 180) / 6) + 1, 60) END AS INTEGER) AS z FROM z_),
z1 AS (SELECT *, radians(lon - (z * 6 - 183)) AS d, {conformal('sin(radians(lat))')} AS t, {conformal('sin(radians(abs(lat)))')} AS pt FROM z0),
z2 AS (SELECT *, atan2(t, cos(d)) AS xi, asinh(sin(d) / sqrt(t * t + cos(d) * cos(d))) AS eta, 2 * {_number(mgrs.A)} * 0.994e0 / {_number(k)} / (sqrt(1 + pt * pt) + pt) AS rho FROM z1),
z3 AS (SELECT *, 500000 + {scale} * ({series('eta', 'cos', 'sinh')}) AS e_, {scale} * ({series('xi', 'sin', 'cosh')}) + CASE WHEN lat < 0 THEN 1e7 ELSE 0e0 END AS n_,
  2000000 + rho * sin(radians(lon)) AS px, 2000000 + CASE WHEN lat >= 0 THEN -1 ELSE 1 END * rho * cos(radians(lon)) AS py FROM z2),
z4 AS (SELECT *, least(floor((lat + 80) / 8), 19) AS band, least(greatest(trunc(e_ / 100000) - 1, 0), 7) AS ci, (CAST(trunc(n_ / 100000) AS BIGINT) + CASE WHEN z % 2 = 0 THEN 5 ELSE 0 END) % 20 AS ri, {first} AS f_ FROM z3),
z5 AS (SELECT *, CASE f_ {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in polar_cols.items())} END AS pl, CASE WHEN lat > 0 THEN '{mgrs.POLAR_ROWS[True]}' ELSE '{mgrs.POLAR_ROWS[False]}' END AS pr,
  trunc((px - CASE WHEN f_ IN ('Z', 'B') THEN 2000000 WHEN lat > 0 THEN 1300000 ELSE 800000 END) / 100000) AS pc, trunc((py - CASE WHEN lat > 0 THEN 1300000 ELSE 800000 END) / 100000) AS pq FROM z4),
coded AS (SELECT {carried}, CASE WHEN mid THEN lpad(CAST(z AS VARCHAR), 2, '0') || {letters(f"'{mgrs.BANDS}'", 'band')} || {letters(f'({cols})', 'ci')} || {letters(f"'{mgrs.ROWS}'", 'ri')} ELSE f_ || {letters('pl', 'pc')} || {letters('pr', 'pq')} END AS code FROM z5)"""


def footprint_sql():
    """SQL from ``coded`` to the corners (unit, lon, lat) of its squares: steps to ``corners``."""
    e, k = float(mgrs.E), f"({_number(mgrs.SCALE)} * {_number(mgrs.RADIUS)})"
    sums = lambda table, a, b, x, y: " + ".join(f"{_number(c)} * {a}(2 * {j} * {x}) * {b}(2 * {j} * {y})" for j, c in enumerate(table, 1))
    cols = "CASE z % 3 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(mgrs.COLUMNS)) + " END"
    south = "CASE WHEN band < 10 THEN 1e7 ELSE 0e0 END"
    lat0 = "radians(band * 8 - 80e0 + 1e-9)"
    flat = f"atan(sinh(atanh(sin({lat0})) - {_number(e)} * atanh({_number(e)} * sin({lat0}))))"
    steps = []
    for n in range(5):
        own = f"(t * sqrt(1 + s * s) - s * sqrt(1 + t * t))"
        steps.append(f"n{n} AS (SELECT * EXCLUDE (t), t + (want - {own}) / sqrt(1 + {own} * {own}) * (1 + {_number(1 - e**2)} * t * t) / ({_number(1 - e**2)} * sqrt(1 + t * t)) AS t FROM (SELECT *, sinh({_number(e)} * atanh({_number(e)} * t / sqrt(1 + t * t))) AS s FROM {'i3' if n == 0 else f'(SELECT * EXCLUDE (s) FROM n{n - 1})'}))")
    return f"""i0 AS (SELECT unit, CAST(substr(unit, 1, 2) AS INTEGER) AS z, strpos('{mgrs.BANDS}', substr(unit, 3, 1)) - 1 AS band FROM (SELECT DISTINCT code AS unit FROM coded WHERE length(code) = 5)),
i1 AS (SELECT *, strpos({cols}, substr(unit, 4, 1)) * 1e5 AS x0, (strpos('{mgrs.ROWS}', substr(unit, 5, 1)) - 1 - CASE WHEN z % 2 = 0 THEN 5 ELSE 0 END + 20) % 20 * 1e5 AS r0, {flat} AS f, {south} AS fn FROM i0),
i2 AS (SELECT *, r0 + 2e6 * greatest(0, floor(({k} * (f + {" + ".join(f"{_number(c)} * sin(2 * {j} * f)" for j, c in enumerate(mgrs.ALPHA, 1))}) + fn - 2e5 - r0) / 2e6) + 1) AS y0 FROM i1),
p_ AS (SELECT unit, z, fn, (y0 + dy - fn) / {k} AS a, (x0 + dx - 5e5) / {k} AS b FROM i2, (VALUES (0, 0), (99999, 0), (99999, 99999), (0, 99999)) c(dx, dy)),
q_ AS (SELECT unit, z, a - ({sums(mgrs.BETA, 'sin', 'cosh', 'a', 'b')}) AS xi, b - ({sums(mgrs.BETA, 'cos', 'sinh', 'a', 'b')}) AS eta FROM p_),
i3 AS (SELECT *, sin(xi) / sqrt(sinh(eta) * sinh(eta) + cos(xi) * cos(xi)) AS want, sin(xi) / sqrt(sinh(eta) * sinh(eta) + cos(xi) * cos(xi)) AS t FROM q_), {", ".join(steps)},
corners AS (SELECT unit, degrees(atan2(sinh(eta), cos(xi))) + z * 6 - 183 AS lon, degrees(atan(t)) AS lat FROM n4)"""


@query("q_utm", f"WITH {POINTS}, {mgrs_sql('points', 'id')} SELECT id, z AS zone, round(e_, 4) AS easting, round(n_, 4) AS northing FROM z3 WHERE mid")
def q_utm(spark, sf_dir):
    p = points(spark, sf_dir).where("lat >= -80 and lat < 84").select("id", mgrs.utm_of("lon", "lat").alias("u"))
    return p.select("id", "u.zone", F.round("u.easting", 4).alias("easting"), F.round("u.northing", 4).alias("northing"))


@query("q_mask_codes", f"""WITH {GRIDS}, c AS (SELECT raster_id % 36 * 10.0 - 180.0 + (col + 0.5) * 1.25 AS lon, 80.0 - raster_id // 36 % 16 * 10.0 - ("row" + 0.5) * 1.25 AS lat FROM grids WHERE depth > -32766.9 AND depth >= -50),
{mgrs_sql('c', '1 AS one')} SELECT DISTINCT code FROM coded WHERE code IS NOT NULL""")
def q_mask_codes(spark, sf_dir):
    """Grid squares of the cells where land may be."""
    i = F.col("raster_id")
    lon = i % 36 * 10.0 - 180.0 + (F.col("col") + 0.5) * 1.25
    lat = 80.0 - F.floor(i / 36) % 16 * 10.0 - (F.col("row") + 0.5) * 1.25
    return render.masked_codes(grids(spark, sf_dir), lon, lat, masks.discovery(F.col("depth"), False, -32767.0))


GEO = f'WITH {GRIDS} SELECT raster_id, raster_id * 100 + (col + 0.5e0) * 10 AS x, 5000 - ("row" + 0.5e0) * 10 AS y, round(CAST(CAST(depth AS FLOAT) AS DOUBLE), 3) AS depth FROM grids'


def _geotiffs(spark, sf_dir):
    at = grids(spark, sf_dir).select(F.concat(F.lit("r"), F.col("raster_id").cast("string"), F.lit(".tif")).alias("path"), (F.col("raster_id") * 100.0).alias("x0"), "row", "col", "depth")
    return sinks.geotiffs(at, "path", "depth", "x0", 5000.0, 10.0)


def _read(blocks):
    return files.block_pixels(blocks).select(F.regexp_extract("path", r"r(\d+)", 1).cast("long").alias("raster_id"), "x", "y", F.round("value", 3).alias("depth"))


@query("q_geotiff", GEO)
def q_geotiff(spark, sf_dir):
    """Rasters as GeoTIFF and back."""
    return _read(files.geotiff(_geotiffs(spark, sf_dir)))


@query("q_zip_mosaic", GEO)
def q_zip_mosaic(spark, sf_dir):
    """Rasters in archives of sixteen each, read as one mosaic."""
    zips = sinks.zips(_geotiffs(spark, sf_dir).withColumn("archive", F.floor(F.regexp_extract("path", r"r(\d+)", 1).cast("long") / 16).cast("string")), "archive", "path")
    members = files.zip_members(zips.select(F.col("archive").alias("path"), "content"), ".tif")
    return _read(files.geotiff(members.select(F.col("member").alias("path"), "content")))


STAC = f"""{POINTS}, f AS (SELECT id, id // 50 AS dataset, lon AS x0, lat AS y0, lon + 6 AS x1, lat + 5 AS y1 FROM points), d AS (SELECT dataset, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM f GROUP BY dataset)"""


@query("q_stac_assets", f"WITH {STAC} SELECT CAST(f.dataset AS VARCHAR) AS dataset, 'scene-' || f.id || '.tif' AS href FROM f JOIN d USING (dataset) WHERE f.x0 < 60 AND f.x1 > 0 AND f.y0 < 45 AND f.y1 > 0 AND d.x0 < 60 AND d.x1 > 0 AND d.y0 < 45 AND d.y1 > 0")
def q_stac_assets(spark, sf_dir):
    """Assets of catalogues as JSON, fifty features each."""
    f = points(spark, sf_dir).select("id", F.floor(F.col("id") / 50).cast("string").alias("dataset"), F.array(F.col("lon"), F.col("lat"), F.col("lon") + 6, F.col("lat") + 5).alias("bbox"))
    name = lambda end: F.struct(F.concat(F.lit("scene-"), F.col("id").cast("string"), F.lit(end)).alias("href"))
    feature = F.struct("bbox", F.create_map(F.lit("thumb"), name(".png"), F.lit("image"), name(".tif")).alias("assets"))
    json = f.groupBy("dataset").agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("json"))
    ends = F.array(*(g(F.get("bbox", F.lit(i))) for i, g in enumerate((F.min, F.min, F.max, F.max))))
    return scenes.stac_assets(json, (0.0, 0.0, 60.0, 45.0), f.groupBy("dataset").agg(ends.alias("bbox")))


@query("q_code_list", "SELECT DISTINCT lpad(CAST(c_custkey % 60 + 1 AS VARCHAR), 2, '0') || chr(CAST(67 + c_custkey % 5 AS INTEGER)) || 'AA' AS code, 'customers' AS source FROM customer")
def q_code_list(spark, sf_dir):
    """A list of codes with a header, written and read back."""
    i, path = F.col("id"), folder(spark, "codes")
    sinks.code_list(points(spark, sf_dir).select(F.concat(F.lpad((i % 60 + 1).cast("string"), 2, "0"), F.chr(67 + i % 5), F.lit("AA")).alias("code")), path, {"source": "customers"})
    return files.code_list(spark, path).join(F.broadcast(files.code_list_header(spark, path, "source string")))

