"""Tiles, layers and pyramids."""

from pyspark.sql import functions as F

from ..operators import tiles
from ..sources.tables import grids, pixels, points, slabs
from .geodesy import BOX, EPS9, METRES, SIZE9, R, _boxes
from .registry import GRIDS, PIXELS, POINTS, SLABS, query

# Two layers of bytes on a grid: even and odd dates, with an alpha of its own for each.
LAYERS = f"""{PIXELS}, layers AS (SELECT unit, "row", col, date_idx AS seq, CAST(least(r // 36, 255) AS INTEGER) AS r, CAST(least(g // 36, 255) AS INTEGER) AS g, CAST(least(b // 36, 255) AS INTEGER) AS b,
  CAST((unit * 29 + "row" * 7 + col * 13 + date_idx * 90) % 256 AS INTEGER) AS a FROM pixels WHERE r IS NOT NULL)"""


def _layers(spark, sf_dir):
    byte = lambda c: F.least(F.floor(F.col(c) / 36), F.lit(255)).cast("int").alias(c)
    a = ((F.col("unit") * 29 + F.col("row") * 7 + F.col("col") * 13 + F.col("date_idx") * 90) % 256).cast("int")
    return pixels(spark, sf_dir).where("r is not null").select("unit", "row", "col", F.col("date_idx").alias("seq"), byte("r"), byte("g"), byte("b"), a.alias("a"))


def _over_sql(low, top):
    t = f"({top}.a * 255 + {low}.a * (255 - {top}.a))"
    ch = lambda c: f"CASE WHEN {t} = 0 THEN 0 ELSE CAST(floor(({top}.{c} * {top}.a * 255 + {low}.{c} * {low}.a * (255 - {top}.a) + {t} / 2) / {t}) AS INTEGER) END AS {c}"
    return ", ".join(map(ch, "rgb")) + f", CAST(floor(({t} + 127) / 255) AS INTEGER) AS a"


EMPTY = "(SELECT 0 AS r, 0 AS g, 0 AS b, 0 AS a)"


FOLDED = f"""{LAYERS}, l AS (SELECT * FROM layers WHERE seq = 0), u AS (SELECT * FROM layers WHERE seq = 1),
l0 AS (SELECT l.unit, l."row", l.col, {_over_sql('e', 'l')} FROM l, {EMPTY} e), k AS (SELECT DISTINCT unit, "row", col FROM layers),
low AS (SELECT k.unit, k."row", k.col, coalesce(l0.r, 0) AS r, coalesce(l0.g, 0) AS g, coalesce(l0.b, 0) AS b, coalesce(l0.a, 0) AS a, u.unit IS NOT NULL AS two, u.r AS ur, u.g AS ug, u.b AS ub, u.a AS ua
  FROM k LEFT JOIN l0 USING (unit, "row", col) LEFT JOIN u USING (unit, "row", col)),
top AS (SELECT unit, "row", col, ur AS r, ug AS g, ub AS b, ua AS a FROM low WHERE two),
folded AS (SELECT low.unit, low."row", low.col, {_over_sql('low', 'top')} FROM low JOIN top USING (unit, "row", col) UNION ALL SELECT unit, "row", col, r, g, b, a FROM low WHERE NOT two)"""


@query("q_over", f"WITH {FOLDED} SELECT * FROM folded")
def q_over(spark, sf_dir):
    return tiles.fold_layers(_layers(spark, sf_dir), ["unit", "row", "col"], "seq")


@query("q_underlay", f"""WITH {FOLDED} SELECT f.unit, f."row", f.col, {_over_sql('u', 'f')} FROM folded f, (SELECT 10 AS r, 30 AS g, 90 AS b, 255 AS a) u""")
def q_underlay(spark, sf_dir):
    layers = _layers(spark, sf_dir)
    base = layers.select("unit", "row", "col").distinct().select("*", F.lit(10).alias("r"), F.lit(30).alias("g"), F.lit(90).alias("b"), F.lit(255).alias("a"))
    return tiles.fold_layers(layers, ["unit", "row", "col"], "seq", base)


@query("q_opaque", f"""WITH {LAYERS}, o AS (SELECT unit, "row", CASE WHEN unit % 3 = 0 THEN 0 WHEN unit % 3 = 1 THEN 255 ELSE a END AS a FROM layers)
  SELECT unit, "row", CASE WHEN max(a) = 0 THEN 'empty' WHEN min(a) = 255 THEN 'rgb' ELSE 'rgba' END AS kind FROM o GROUP BY ALL""")
def q_opaque(spark, sf_dir):
    a = F.when(F.col("unit") % 3 == 0, 0).when(F.col("unit") % 3 == 1, 255).otherwise(F.col("a"))
    return tiles.tile_kind(_layers(spark, sf_dir).withColumn("a", a), ["unit", "row"])


TILES = f"{POINTS}, tiles AS (SELECT DISTINCT 10 AS z, CAST((id * 37) % 300 AS INTEGER) AS tx, CAST((id * 53) % 200 AS INTEGER) AS ty, id % 3 AS src FROM points)"


def _tiles(spark, sf_dir):
    i = F.col("id")
    return points(spark, sf_dir).select(F.lit(10).alias("z"), (i * 37 % 300).cast("int").alias("tx"), (i * 53 % 200).cast("int").alias("ty"), (i % 3).alias("src")).distinct()


KEY = ["z", "tx", "ty"]


@query("q_backfill", f"""WITH {TILES}, a AS (SELECT * FROM tiles WHERE src = 0), b AS (SELECT z, tx % 150 AS tx, ty, min(src) AS src FROM tiles WHERE src <> 0 GROUP BY ALL)
  SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.z = b.z AND a.tx = b.tx AND a.ty = b.ty)""")
def q_backfill(spark, sf_dir):
    t = _tiles(spark, sf_dir)
    more = t.where("src <> 0").withColumn("tx", F.col("tx") % 150).groupBy(*KEY).agg(F.min("src").alias("src"))
    return tiles.backfill(t.where("src = 0"), more, KEY)


@query("q_merge_first_wins", f"WITH {TILES} SELECT z, tx % 40 AS tx, ty % 40 AS ty, min(src) AS src FROM tiles GROUP BY ALL")
def q_merge_first_wins(spark, sf_dir):
    t = _tiles(spark, sf_dir).withColumns({"tx": F.col("tx") % 40, "ty": F.col("ty") % 40})
    return tiles.first_wins(t, KEY, F.col("src"))


@query("q_merge_last_wins", f"WITH {TILES} SELECT z, tx % 40 AS tx, ty % 40 AS ty, max(src) AS src FROM tiles GROUP BY ALL")
def q_merge_last_wins(spark, sf_dir):
    t = _tiles(spark, sf_dir).withColumns({"tx": F.col("tx") % 40, "ty": F.col("ty") % 40})
    return tiles.first_wins(t, KEY, F.col("src"), last=True)


@query("q_parents_missing", f"""WITH {TILES}, p AS (SELECT DISTINCT z - 1 AS z, tx // 2 AS tx, ty // 2 AS ty FROM tiles), e AS (SELECT DISTINCT z - 1 AS z, tx // 2 AS tx, ty // 2 AS ty FROM tiles WHERE src = 1)
  SELECT z, CAST(tx AS INTEGER) AS tx, CAST(ty AS INTEGER) AS ty FROM (SELECT * FROM p EXCEPT SELECT * FROM e)""")
def q_parents_missing(spark, sf_dir):
    t = _tiles(spark, sf_dir)
    return tiles.missing_parents(t, tiles.parents(t.where("src = 1")).select(*KEY).distinct())


ZOOM = 20  # every raster is a tile of its own: 64 to a row, up to 67 million of them


def _level(n):
    return f"""l{n} AS (SELECT z - 1 AS z, CAST(tx // 2 AS INTEGER) AS tx, CAST(ty // 2 AS INTEGER) AS ty, CAST((ty % 2 * 8 + "row") // 2 AS INTEGER) AS "row", CAST((tx % 2 * 8 + col) // 2 AS INTEGER) AS col,
  {', '.join(f'CAST(floor(sum({c}) / 4.0 + 0.5) AS INTEGER) AS {c}' for c in 'rgba')} FROM l{n - 1} GROUP BY ALL)"""


BASE = f"""{GRIDS}, l0 AS (SELECT {ZOOM} AS z, CAST(raster_id % 64 AS INTEGER) AS tx, CAST(raster_id // 64 AS INTEGER) AS ty, "row", col, CAST(CAST(floor(abs(depth)) AS BIGINT) % 256 AS INTEGER) AS r, CAST("row" * 30 AS INTEGER) AS g, CAST(col * 30 AS INTEGER) AS b, 255 AS a FROM grids)"""


def _base(spark, sf_dir):
    i = F.col("raster_id")
    return grids(spark, sf_dir).select(
        F.lit(ZOOM).alias("z"), (i % 64).cast("int").alias("tx"), F.floor(i / 64).cast("int").alias("ty"), "row", "col",
        (F.floor(F.abs("depth")) % 256).cast("int").alias("r"), (F.col("row") * 30).alias("g"), (F.col("col") * 30).alias("b"), F.lit(255).alias("a"),
    )


@query("q_downsample", f"WITH {BASE}, {_level(1)} SELECT * FROM l1")
def q_downsample(spark, sf_dir):
    return tiles.downsample(_base(spark, sf_dir), 8)


@query("q_pyramid", f"WITH {BASE}, {_level(1)}, {_level(2)}, {_level(3)}, {_level(4)} SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3 UNION ALL SELECT * FROM l4")
def q_pyramid(spark, sf_dir):
    return tiles.pyramid(_base(spark, sf_dir), 8, ZOOM - 4, ZOOM)


LAT = "degrees(atan(sinh(pi() * (1 - 2 * ({}) / 1024.0))))"


@query("q_extent", f"""WITH {TILES}, e AS (SELECT min(tx) AS x0, max(tx) AS x1, min(ty) AS y0, max(ty) AS y1 FROM tiles), b AS (SELECT x0 / 1024.0 * 360.0 - 180.0 AS west, {LAT.format('y1 + 1')} AS south, (x1 + 1) / 1024.0 * 360.0 - 180.0 AS east, {LAT.format('y0')} AS north FROM e)
  SELECT 9 AS min_zoom, 10 AS max_zoom, round(west, 8) AS west, round(south, 8) AS south, round(east, 8) AS east, round(north, 8) AS north, round((west + east) / 2, 8) AS center_lon, round((south + north) / 2, 8) AS center_lat FROM b""")
def q_extent(spark, sf_dir):
    t = _tiles(spark, sf_dir).select(*KEY)
    e = tiles.extent(t.unionByName(tiles.parents(t)))
    return e.select("min_zoom", "max_zoom", *(F.round(c, 8).alias(c) for c in ("west", "south", "east", "north", "center_lon", "center_lat")))


@query("q_min_zoom", f"""WITH {TILES}, s AS (SELECT greatest(max(tx) - min(tx) + 1, max(ty) - min(ty) + 1) AS side FROM tiles), k AS (SELECT min(k) AS k FROM s, range(11) r(k) WHERE floor(side * 256 / pow(2.0, k)) <= 256) SELECT 10 AS max_zoom, CAST(10 - k AS INTEGER) AS min_zoom FROM k""")
def q_min_zoom(spark, sf_dir):
    return tiles.min_zoom(_tiles(spark, sf_dir))


@query("q_enumerate_tiles", f"""WITH {METRES}, {BOX}, r AS (SELECT id, CAST(least(greatest(floor((minx + {EPS9!r} + {R}) / {SIZE9!r}), 0), 511) AS INTEGER) AS x0, CAST(least(greatest(floor(({R} - maxy + {EPS9!r}) / {SIZE9!r}), 0), 511) AS INTEGER) AS y0,
  CAST(least(greatest(floor((maxx - {EPS9!r} + {R}) / {SIZE9!r}), 0), 511) AS INTEGER) AS x1, CAST(least(greatest(floor(({R} - miny - {EPS9!r}) / {SIZE9!r}), 0), 511) AS INTEGER) AS y1 FROM b),
  y AS (SELECT id, x0, x1, unnest(range(y0, y1 + 1)) AS ty FROM r) SELECT id, CAST(ty AS INTEGER) AS ty, CAST(unnest(range(x0, x1 + 1)) AS INTEGER) AS tx FROM y""")
def q_enumerate_tiles(spark, sf_dir):
    return tiles.enumerate_tiles(_boxes(spark, sf_dir), ["id"], 9)


RING = ((-60.0, -50.0), (80.0, -40.0), (120.0, 30.0), (20.0, 10.0), (-20.0, 60.0), (-90.0, 20.0))


def _ring_sql():
    edges = [f"CASE WHEN ({y1} > lat) <> ({y2} > lat) AND lon < ({x2} - {x1}) * (lat - {y1}) / ({y2} - {y1}) + {x1} THEN 1 ELSE 0 END" for (x1, y1), (x2, y2) in zip(RING, [*RING[1:], RING[0]], strict=True)]
    return f"({' + '.join(edges)}) % 2 = 1"


@query("q_cutline", f"WITH {POINTS} SELECT id FROM points WHERE {_ring_sql()}")
def q_cutline(spark, sf_dir):
    return points(spark, sf_dir).where(tiles.in_ring(F.col("lon"), F.col("lat"), RING)).select("id")


@query("q_prune_tiles", f"""WITH {SLABS}, {GRIDS}, land AS (SELECT CAST(raster_id % 64 AS INTEGER) AS ty FROM grids GROUP BY 1 HAVING bool_or(depth > 60)) SELECT unit, ty, tx_min, tx_max FROM slabs WHERE ty IN (SELECT ty FROM land)""")
def q_prune_tiles(spark, sf_dir):
    land = grids(spark, sf_dir).groupBy((F.col("raster_id") % 64).cast("int").alias("ty")).agg(F.bool_or(F.col("depth") > 60).alias("land")).where("land")
    return slabs(spark, sf_dir).join(land, "ty", "left_semi").select("unit", "ty", "tx_min", "tx_max")
