"""Places, tiles and bounds."""

from pyspark.sql import functions as F

from ..functions import geo
from ..sources.tables import points, table
from .registry import POINTS, query

R = geo.HALF_WORLD
MX = f"lon * {R} / 180.0"
MY = f"ln(tan((90.0 + least(greatest(lat, -85.0511287798066), 85.0511287798066)) * pi() / 360.0)) / (pi() / 180.0) * {R} / 180.0"
METRES = f"{POINTS}, m AS (SELECT id, lon, lat, {MX} AS x, {MY} AS y FROM points)"


def _metres(spark, sf_dir):
    return points(spark, sf_dir).select("id", "lon", "lat", geo.mercator_x("lon").alias("x"), geo.mercator_y("lat").alias("y"))


def _tile_sql(z):
    size = 2 * R / 2**z
    return f"CAST(floor((x + {R}) / {size!r}) AS INTEGER) AS tx, CAST(floor(({R} - y) / {size!r}) AS INTEGER) AS ty"


@query("q_mercator", f"WITH {METRES} SELECT id, round(x, 4) AS x, round(y, 4) AS y FROM m")
def q_mercator(spark, sf_dir):
    return _metres(spark, sf_dir).select("id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query("q_mercator_tile", f"WITH {METRES}, t AS (SELECT {_tile_sql(8)} FROM m) SELECT tx, ty, count(*) AS n FROM t GROUP BY ALL")
def q_mercator_tile(spark, sf_dir):
    tx, ty = geo.tile_at("x", "y", 8)
    return _metres(spark, sf_dir).select(tx.alias("tx"), ty.alias("ty")).groupBy("tx", "ty").agg(F.count("*").alias("n"))


def _bounds_sql(z):
    n = float(2**z)
    lat = lambda t: f"degrees(atan(sinh(pi() * (1 - 2 * ({t}) / {n}))))"
    y = lambda t: MY.replace("lat", f"({lat(t)})")
    return f"((tx / {n} * 360.0 - 180.0) * {R} / 180.0) AS minx, {y('ty + 1')} AS miny, (((tx + 1) / {n} * 360.0 - 180.0) * {R} / 180.0) AS maxx, {y('ty')} AS maxy"


@query("q_tile_bounds", f"WITH {METRES}, t AS (SELECT DISTINCT {_tile_sql(7)} FROM m), b AS (SELECT tx, ty, {_bounds_sql(7)} FROM t) SELECT tx, ty, round(minx, 3) + 0.0 AS minx, round(miny, 3) + 0.0 AS miny, round(maxx, 3) + 0.0 AS maxx, round(maxy, 3) + 0.0 AS maxy FROM b")
def q_tile_bounds(spark, sf_dir):
    tx, ty = geo.tile_at("x", "y", 7)
    tiles = _metres(spark, sf_dir).select(tx.alias("tx"), ty.alias("ty")).distinct()
    names = ("minx", "miny", "maxx", "maxy")
    # Adding zero makes a negative zero a plain one.
    return tiles.select("tx", "ty", *((F.round(c, 3) + 0.0).alias(n) for c, n in zip(geo.tile_bounds(7, F.col("tx"), F.col("ty")), names, strict=True)))


SIZE9 = 2 * R / 2**9
BOX = "b AS (SELECT id, x - 50000.0 AS minx, y - 30000.0 AS miny, x + 40000.0 AS maxx, y + 60000.0 AS maxy FROM m)"


def _boxes(spark, sf_dir):
    x, y = F.col("x"), F.col("y")
    return _metres(spark, sf_dir).select("id", (x - 50000.0).alias("minx"), (y - 30000.0).alias("miny"), (x + 40000.0).alias("maxx"), (y + 60000.0).alias("maxy"))


def _box():
    return tuple(F.col(c) for c in ("minx", "miny", "maxx", "maxy"))


EPS9 = max(1e-8, SIZE9 * 1e-9)


@query("q_tile_range", f"""WITH {METRES}, {BOX} SELECT id, CAST(least(greatest(floor((minx + {EPS9!r} + {R}) / {SIZE9!r}), 0), 511) AS INTEGER) AS tx_min,
  CAST(least(greatest(floor(({R} - maxy + {EPS9!r}) / {SIZE9!r}), 0), 511) AS INTEGER) AS ty_min, CAST(least(greatest(floor((maxx - {EPS9!r} + {R}) / {SIZE9!r}), 0), 511) AS INTEGER) AS tx_max,
  CAST(least(greatest(floor(({R} - miny - {EPS9!r}) / {SIZE9!r}), 0), 511) AS INTEGER) AS ty_max FROM b""")
def q_tile_range(spark, sf_dir):
    names = ("tx_min", "ty_min", "tx_max", "ty_max")
    return _boxes(spark, sf_dir).select("id", *(c.alias(n) for c, n in zip(geo.tile_range(*_box(), 9), names, strict=True)))


@query("q_snap", f"""WITH {METRES}, {BOX} SELECT id, round(floor((minx + {R}) / 611.5) * 611.5 - {R}, 4) AS minx, round(ceil((maxx + {R}) / 611.5) * 611.5 - {R}, 4) AS maxx,
  round(floor((miny + {R}) / 611.5) * 611.5 - {R}, 4) AS miny, round(ceil((maxy + {R}) / 611.5) * 611.5 - {R}, 4) AS maxy FROM b""")
def q_snap(spark, sf_dir):
    x0, y0, x1, y1 = _box()
    (a, b), (c, d) = geo.snap(x0, x1, 611.5), geo.snap(y0, y1, 611.5)
    return _boxes(spark, sf_dir).select("id", F.round(a, 4).alias("minx"), F.round(b, 4).alias("maxx"), F.round(c, 4).alias("miny"), F.round(d, 4).alias("maxy"))


@query("q_tms", f"WITH {METRES}, t AS (SELECT id, {_tile_sql(12)} FROM m) SELECT id, tx, ty, 4095 - ty AS tms FROM t")
def q_tms(spark, sf_dir):
    tx, ty = geo.tile_at("x", "y", 12)
    return _metres(spark, sf_dir).select("id", tx.alias("tx"), ty.alias("ty")).withColumn("tms", geo.tms_row(12, "ty"))


@query("q_pixel_size", f"SELECT n_nationkey AS zoom, round(2 * {R} / (256.0 * pow(2.0, n_nationkey)), 9) AS size FROM nation")
def q_pixel_size(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("zoom"), F.round(geo.pixel_size("n_nationkey"), 9).alias("size"))


@query("q_pixel_window", f"""WITH {METRES}, {BOX}, w AS (SELECT id, greatest(floor((minx + {R}) / 40000.0) - 2, 0) AS f, least(ceil((maxx + {R}) / 40000.0) + 2, 1000) AS l FROM b)
  SELECT id, CAST(f AS INTEGER) AS xoff, CAST(greatest(l - f, 0) AS INTEGER) AS width FROM w""")
def q_pixel_window(spark, sf_dir):
    off, size = geo.pixel_window(F.col("minx"), F.col("maxx"), -R, 40000.0, 1000, halo=2)
    return _boxes(spark, sf_dir).select("id", off.alias("xoff"), size.alias("width"))


@query("q_row_latitude", f"WITH {METRES} SELECT id, round(degrees(atan(sinh(y * pi() / {R}))), 8) AS lat, round(x / {R} * 180.0, 8) AS lon FROM m")
def q_row_latitude(spark, sf_dir):
    return _metres(spark, sf_dir).select("id", F.round(geo.latitude("y"), 8).alias("lat"), F.round(geo.longitude("x"), 8).alias("lon"))


H = geo.SEASON_METRES / geo.METRES_PER_DEGREE


@query("q_season_weight", f"""WITH {POINTS}, t AS (SELECT id, least(greatest((lat / 20 + {H!r}) / (2 * {H!r}), 0.0), 1.0) AS t FROM points)
  SELECT id, round(t * t * (3 - 2 * t), 9) AS summer, round(1 - t * t * (3 - 2 * t), 9) AS winter FROM t""")
def q_season_weight(spark, sf_dir):
    lat = F.col("lat") / 20
    return points(spark, sf_dir).select("id", F.round(geo.season_weight(lat), 9).alias("summer"), F.round(geo.season_weight(lat, winter=True), 9).alias("winter"))


REGISTRY = "registry AS (SELECT n_nationkey AS dataset, -180.0 + n_nationkey * 14 AS x0, -80.0 + n_nationkey * 6 AS y0, -160.0 + n_nationkey * 14 AS x1, -62.0 + n_nationkey * 6 AS y1 FROM nation)"


def _registry(spark, sf_dir):
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(k.alias("dataset"), (k * 14 - 180.0).alias("x0"), (k * 6 - 80.0).alias("y0"), (k * 14 - 160.0).alias("x1"), (k * 6 - 62.0).alias("y1"))


@query("q_point_in_bbox", f"WITH {POINTS}, {REGISTRY} SELECT dataset, count(*) AS n FROM points JOIN registry ON lon BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1 GROUP BY ALL")
def q_point_in_bbox(spark, sf_dir):
    # The registry has a fixed number of rows, one for each data set.
    at = F.col("lon").between(F.col("x0"), F.col("x1")) & F.col("lat").between(F.col("y0"), F.col("y1"))
    return points(spark, sf_dir).join(F.broadcast(_registry(spark, sf_dir)), at).groupBy("dataset").agg(F.count("*").alias("n"))


@query("q_bbox_overlap", f"WITH {POINTS}, {REGISTRY} SELECT id, dataset FROM points JOIN registry ON lon - 1 < x1 AND lon + 1 > x0 AND lat - 1 < y1 AND lat + 1 > y0")
def q_bbox_overlap(spark, sf_dir):
    lon, lat = F.col("lon"), F.col("lat")
    on = geo.overlaps((lon - 1, lat - 1, lon + 1, lat + 1), tuple(F.col(c) for c in ("x0", "y0", "x1", "y1")))
    return points(spark, sf_dir).join(F.broadcast(_registry(spark, sf_dir)), on).select("id", "dataset")


@query("q_env_overlap", f"WITH {REGISTRY} SELECT a.dataset AS a, b.dataset AS b FROM registry a JOIN registry b ON a.dataset < b.dataset AND a.x0 < b.x1 AND a.x1 > b.x0 AND a.y0 < b.y1 AND a.y1 > b.y0")
def q_env_overlap(spark, sf_dir):
    r = _registry(spark, sf_dir)
    a, b = r.select(*(F.col(c).alias(f"a_{c}") for c in r.columns)), r.select(*(F.col(c).alias(f"b_{c}") for c in r.columns))
    env = lambda s: tuple(F.col(f"{s}_{c}") for c in ("x0", "x1", "y0", "y1"))
    on = (F.col("a_dataset") < F.col("b_dataset")) & geo.envelopes_overlap(env("a"), env("b"))
    return a.join(F.broadcast(b), on).select(F.col("a_dataset").alias("a"), F.col("b_dataset").alias("b"))


@query("q_bounds_intersection", f"""WITH {POINTS}, i AS (SELECT id, greatest(lon - 2, 0.0) AS minx, greatest(lat - 2, 0.0) AS miny, least(lon + 2, 90.0) AS maxx, least(lat + 2, 45.0) AS maxy FROM points)
  SELECT id, minx, miny, maxx, maxy FROM i WHERE minx < maxx AND miny < maxy""")
def q_bounds_intersection(spark, sf_dir):
    lon, lat = F.col("lon"), F.col("lat")
    both = geo.intersection((lon - 2, lat - 2, lon + 2, lat + 2), tuple(F.lit(v) for v in (0.0, 0.0, 90.0, 45.0)))
    return points(spark, sf_dir).select("id", both.alias("i")).where("i is not null").select("id", "i.*")


@query("q_parse_bbox", f"WITH {POINTS} SELECT id, round(lon, 3) AS minx, round(lat + 1, 3) AS maxy FROM points")
def q_parse_bbox(spark, sf_dir):
    num = lambda c: c.cast("decimal(9,3)").cast("string")
    lon, lat = F.col("lon"), F.col("lat")
    text = F.concat_ws(",", num(lon), num(lat), num(lon + 1), num(lat + 1))
    return points(spark, sf_dir).select("id", geo.parse_bbox(text).alias("b")).select("id", F.round(F.col("b")[0], 3).alias("minx"), F.round(F.col("b")[3], 3).alias("maxy"))
