"""Scenes, manifests and settings."""

from pyspark.sql import functions as F

from ..functions import text
from ..operators.staging import staged
from ..plans import cover, settings
from ..plans import scenes as plan
from ..sources.tables import points, scenes, slabs, table
from .registry import POINTS, SCENES, SLABS, query


@query("q_scene_dedupe", f"""WITH {SCENES}, n AS (SELECT *, row_number() OVER (PARTITION BY coalesce(CAST(entity AS VARCHAR), 'k' || k) ORDER BY seq) AS n FROM scenes) SELECT seq, entity, start, k FROM n WHERE n = 1""")
def q_scene_dedupe(spark, sf_dir):
    return plan.deduplicate(scenes(spark, sf_dir), F.coalesce(F.col("entity").cast("string"), F.concat(F.lit("k"), "k")))


@query("q_scene_recency", f"""WITH {SCENES}, c AS (SELECT *, seq % 50 AS cell, CASE WHEN start IS NULL THEN seq % 50 > 5 ELSE start >= '2024-01-20' AND seq % 50 > 3 END AS ok FROM scenes), s AS (SELECT cell, bool_or(ok) AS any_ok FROM c GROUP BY cell)
  SELECT seq, cell, start FROM c JOIN s USING (cell) WHERE ok OR NOT any_ok""")
def q_scene_recency(spark, sf_dir):
    cell = F.col("seq") % 50
    rows = scenes(spark, sf_dir).withColumn("cell", cell)
    # The first cells hold old scenes only; in the next two those without a start are old.
    old = F.when(F.col("start").isNull() & (cell <= 5), "1999-01-01").when(cell <= 3, F.concat(F.lit("1999"), F.substring("start", 5, 6)))
    rows = rows.withColumn("when", F.coalesce(old, F.col("start")))
    return plan.recent(rows, "cell", "when", "2024-01-20").select("seq", "cell", "start")


@query("q_scene_order", f"WITH {SCENES} SELECT seq, CAST(row_number() OVER (ORDER BY coalesce(start, '') DESC, seq) AS INTEGER) AS place FROM scenes")
def q_scene_order(spark, sf_dir):
    return plan.newest_first(scenes(spark, sf_dir)).select("seq", F.col("place").cast("int").alias("place"))


@query("q_option_pref", f"""WITH {SCENES}, o AS (SELECT seq, entity, CASE WHEN CAST(k AS INTEGER) % 7 = 0 THEN 'Full JP2 file' WHEN CAST(k AS INTEGER) % 3 = 0 THEN 'JPEG2000 tile' ELSE 'GeoTIFF' END AS name, seq % 4 <> 0 AS available FROM scenes WHERE entity IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY CASE WHEN name LIKE '%JP2%' THEN 0 WHEN name LIKE 'JPEG2000%' THEN 1 ELSE 2 END, CASE WHEN name LIKE 'JPEG2000%' THEN -seq ELSE seq END) AS n FROM o WHERE available) SELECT entity, seq, name FROM n WHERE n = 1""")
def q_option_pref(spark, sf_dir):
    k = F.col("k").cast("int")
    o = scenes(spark, sf_dir).where("entity is not null").select("seq", "entity", F.when(k % 7 == 0, "Full JP2 file").when(k % 3 == 0, "JPEG2000 tile").otherwise("GeoTIFF").alias("name"), (F.col("seq") % 4 != 0).alias("available"))
    return plan.preferred_option(o, "entity", "name", "seq").select("entity", "seq", "name")


@query("q_manifest_latest", """WITH m AS (SELECT user_id AS bbox_key, ts AS queried_at, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS n FROM events WHERE ts >= TIMESTAMP '2024-04-14 00:00:00' - INTERVAL 90 DAY) SELECT bbox_key, event_id FROM m WHERE n = 1""")
def q_manifest_latest(spark, sf_dir):
    m = table(spark, sf_dir, "events").select(F.col("user_id").alias("bbox_key"), F.col("ts").alias("queried_at"), "event_id")
    return plan.latest(m, ["bbox_key"], "queried_at", F.lit("2024-04-14 00:00:00").cast("timestamp_ntz")).select("bbox_key", "event_id")


def _levels(depth):
    steps = [f"l{depth} AS (SELECT {depth} AS depth, CAST(least(greatest(floor((lon + 180) / 360 * {2**depth}), 0), {2**depth - 1}) AS INTEGER) AS i, CAST(least(greatest(floor((lat + 90) / 180 * {2**depth}), 0), {2**depth - 1}) AS INTEGER) AS j, count(*) AS n FROM points GROUP BY ALL)"]
    for d in range(depth - 1, -1, -1):
        steps.append(f"l{d} AS (SELECT {d} AS depth, i // 2 AS i, j // 2 AS j, CAST(sum(n) AS BIGINT) AS n FROM l{d + 1} GROUP BY ALL)")
    parts = [f"SELECT depth, i, j, n FROM l0 WHERE n <= 40{' OR TRUE' if depth == 0 else ''}"]
    for d in range(1, depth + 1):
        keep = "TRUE" if d == depth else "c.n <= 40"
        parts.append(f"SELECT c.depth, c.i, c.j, c.n FROM l{d} c JOIN l{d - 1} p ON p.i = c.i // 2 AND p.j = c.j // 2 WHERE p.n > 40 AND {keep}")
    return ", ".join(steps), " UNION ALL ".join(parts)


STEPS, PARTS = _levels(5)


@query("q_quadtree", f"WITH {POINTS}, {STEPS} SELECT depth, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, n FROM ({PARTS})")
def q_quadtree(spark, sf_dir):
    return plan.quadtree(points(spark, sf_dir), "lon", "lat", (-180.0, -90.0, 180.0, 90.0), most=40, depth=5, keep=staged)


COVER = """cover AS (SELECT seq, start, seq % 20 AS cell, (seq * 7 % 10) / 20.0 AS minx, (seq * 3 % 10) / 20.0 AS miny, (seq * 7 % 10) / 20.0 + 0.3 AS maxx, (seq * 3 % 10) / 20.0 + 0.4 AS maxy FROM scenes)"""


@query("q_greedy_cover", f"""WITH {SCENES}, {COVER}, p AS (SELECT cell, i, j, seq, row_number() OVER (PARTITION BY cell, i, j ORDER BY coalesce(start, '') DESC, seq) AS n FROM cover, range(16) a(i), range(16) b(j) WHERE (i + 0.5) / 16 BETWEEN minx AND maxx AND (j + 0.5) / 16 BETWEEN miny AND maxy)
  SELECT DISTINCT cell, seq FROM p WHERE n = 1""")
def q_greedy_cover(spark, sf_dir):
    s = F.col("seq")
    minx, miny = s * 7 % 10 / 20.0, s * 3 % 10 / 20.0
    rows = scenes(spark, sf_dir).select("seq", "start", (s % 20).alias("cell"), minx.alias("minx"), miny.alias("miny"), (minx + 0.3).alias("maxx"), (miny + 0.4).alias("maxy"))
    return plan.greedy_cover(rows, "cell", "start", ("minx", "miny", "maxx", "maxy")).select("cell", "seq")


UNIT_SQUARE = ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0))


def _rings(spark, sf_dir):
    s = F.col("seq")
    x, y = s * 7 % 10 / 20.0, s * 3 % 10 / 20.0
    ring = F.array(*(F.array(a, b) for a, b in ((x, y), (x + 0.3, y), (x + 0.3, y + 0.4), (x, y + 0.4))))
    # A bounded number of scenes a cell; every ninth has no outline.
    return scenes(spark, sf_dir).select("seq", "start", F.floor(s / 100).alias("cell"), F.when(s % 9 != 0, ring).alias("ring"))


EXACT = COVER.replace("seq % 20 AS cell", "seq // 100 AS cell") + """, p AS (SELECT cell, i, j, seq, row_number() OVER (PARTITION BY cell, i, j ORDER BY coalesce(start, '') DESC, seq) AS n
  FROM cover, range(20) a(i), range(20) b(j) WHERE seq % 9 <> 0 AND (i + 0.5) / 20 BETWEEN minx AND maxx AND (j + 0.5) / 20 BETWEEN miny AND maxy)"""


# The outlines' corners lie on a grid of twentieths, so that areas are counts of squares.
@query("q_exact_cover", f"WITH {SCENES}, {EXACT} SELECT DISTINCT cell, seq FROM p WHERE n = 1")
def q_exact_cover(spark, sf_dir):
    return cover.greedy_cover(_rings(spark, sf_dir), "cell", "start", "ring", UNIT_SQUARE)


@query("q_union_area", f"WITH {SCENES}, {EXACT} SELECT cell, round(count(*) / 400.0, 9) AS area FROM p WHERE n = 1 GROUP BY cell")
def q_union_area(spark, sf_dir):
    rows = _rings(spark, sf_dir).where("ring is not null")
    return cover.union_area(rows, "cell", "ring", UNIT_SQUARE).withColumn("area", F.round("area", 9))


@query("q_manifest_merge", """WITH l AS (SELECT user_id, event_id, ts FROM events WHERE event_id % 17 <> 0 AND ts >= TIMESTAMP '2024-04-14 00:00:00' - INTERVAL 90 DAY),
old AS (SELECT user_id AS bbox_key, arg_max(event_id, ts) AS event_id, max(ts) AS queried_at FROM l WHERE user_id % 2 = 0 GROUP BY 1), new AS (SELECT user_id AS bbox_key, arg_max(event_id, ts) AS event_id, max(ts) AS queried_at FROM l WHERE user_id % 3 = 0 AND event_id % 2 = 0 GROUP BY 1)
  SELECT bbox_key, coalesce(CASE WHEN new.queried_at >= old.queried_at OR old.queried_at IS NULL THEN new.event_id END, old.event_id) AS event_id FROM old FULL OUTER JOIN new USING (bbox_key)""")
def q_manifest_merge(spark, sf_dir):
    """An old list of JSON lines, some broken or expired, taken into a manifest, and newer answers over it."""
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    line = F.to_json(F.struct(F.col("user_id").alias("bbox_key"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("queried_at"), "event_id"))
    lines = e.select("user_id", i, F.when(i % 17 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value"))
    now = F.lit("2024-04-14 00:00:00").cast("timestamp_ntz")
    known = lambda part: plan.latest(plan.from_lines(part.select("value"), "bbox_key long, queried_at timestamp_ntz, event_id long"), ["bbox_key"], "queried_at", now, 90)
    old, new = known(lines.where("user_id % 2 = 0")), known(lines.where("user_id % 3 = 0 and event_id % 2 = 0"))
    return plan.upsert(old, new, ["bbox_key"], "queried_at").select("bbox_key", "event_id")


@query("q_json_fields", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, '{\"k\":' || json_extract_string(props, '$.k') || '}' AS compact FROM events")
def q_json_fields(spark, sf_dir):
    parsed = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int").alias("p"))
    return parsed.select("event_id", "p.k", F.to_json("p").alias("compact"))


RUN = "'run' || CAST(o_custkey AS VARCHAR)"


@query("q_settings_diff", """WITH s AS (SELECT 'k' || CAST(o_custkey AS VARCHAR) AS key, o_orderkey % 2 AS run, CAST(max(CAST(floor(o_totalprice / 100000) AS BIGINT)) AS VARCHAR) AS value FROM orders GROUP BY ALL)
  SELECT coalesce(a.key, b.key) AS key, coalesce(a.key, b.key) || ': ' || coalesce(a.value, '<missing>') || ' -> ' || coalesce(b.value, '<missing>') AS change FROM (SELECT * FROM s WHERE run = 0) a FULL OUTER JOIN (SELECT * FROM s WHERE run = 1) b ON a.key = b.key WHERE a.value IS DISTINCT FROM b.value""")
def q_settings_diff(spark, sf_dir):
    s = table(spark, sf_dir, "orders").groupBy(F.concat(F.lit("k"), F.col("o_custkey").cast("string")).alias("key"), (F.col("o_orderkey") % 2).alias("run")).agg(F.max(F.floor(F.col("o_totalprice") / 100000)).cast("string").alias("value"))
    return settings.differences(s.where("run = 0"), s.where("run = 1"))


@query("q_signature", f"SELECT {RUN} AS run, sha256(string_agg('o' || CAST(o_orderkey AS VARCHAR) || '=' || o_orderstatus, chr(10) ORDER BY 'o' || CAST(o_orderkey AS VARCHAR) || '=' || o_orderstatus)) AS digest FROM orders GROUP BY 1")
def q_signature(spark, sf_dir):
    """A customer's orders as a run's settings: a run is a bounded group."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("run"), F.col("o_custkey").cast("string")).alias("run"), F.concat(F.lit("o"), k.cast("string")).alias("key"), F.col("o_orderstatus").alias("value"))
    return settings.signature(rows)


@query("q_namespace", "WITH p AS (SELECT '/data/' || CASE WHEN p_partkey % 9 = 0 THEN '' ELSE replace(p_name, ' ', '-') || '.v' || CAST(p_size AS VARCHAR) || '.pmtiles' END AS path, p_partkey FROM part) SELECT p_partkey, CASE WHEN path = '/data/' THEN 'output' ELSE regexp_replace(split_part(path, '/', 3), '[.][^.]*$', '') END || '_' || substr(sha256(path), 1, 8) AS name FROM p")
def q_namespace(spark, sf_dir):
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(".v"), F.col("p_size").cast("string"), F.lit(".pmtiles"))
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("/data/"), F.when(F.col("p_partkey") % 9 == 0, "").otherwise(name)).alias("path"))
    return p.select("p_partkey", text.namespace(F.col("path")).alias("name"))


@query("q_eta", """WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(floor(o_totalprice / CASE WHEN o_orderkey % 3 = 0 THEN 5000 ELSE 20 END) AS BIGINT) END AS s FROM orders)
  SELECT o_orderkey, CASE WHEN s IS NULL THEN 'calculating' WHEN s >= 3600 THEN CAST(s // 3600 AS VARCHAR) || 'h ' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm ' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's'
  WHEN s >= 60 THEN CAST(s // 60 AS VARCHAR) || 'm ' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' ELSE CAST(s AS VARCHAR) || 's' END AS eta FROM s""")
def q_eta(spark, sf_dir):
    k = F.col("o_orderkey")
    seconds = F.when(k % 10 != 0, F.col("o_totalprice") / F.when(k % 3 == 0, 5000).otherwise(20))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.eta(seconds).alias("eta"))


@query("q_render_stats", f"WITH {SLABS}, t AS (SELECT CASE seq % 4 WHEN 0 THEN 'rendered' WHEN 1 THEN 'cached' WHEN 2 THEN 'empty' ELSE 'skipped' END AS status FROM slabs) SELECT status, count(*) AS n FROM t GROUP BY status UNION ALL SELECT 'total', count(*) FROM t")
def q_render_stats(spark, sf_dir):
    kinds = F.array(*(F.lit(x) for x in ("rendered", "cached", "empty", "skipped")))
    return settings.render_statistics(slabs(spark, sf_dir).select(F.get(kinds, (F.col("seq") % 4).cast("int")).alias("status")))


@query("q_set_operations", f"WITH {SLABS}, a AS (SELECT DISTINCT ty FROM slabs WHERE unit % 2 = 0 AND tx_min < 9), b AS (SELECT DISTINCT ty FROM slabs WHERE unit % 3 = 0 AND tx_max > 45) SELECT 'both' AS op, ty FROM (SELECT ty FROM a INTERSECT SELECT ty FROM b) UNION ALL SELECT 'either', ty FROM (SELECT ty FROM a UNION SELECT ty FROM b) UNION ALL SELECT 'first', ty FROM (SELECT ty FROM a EXCEPT SELECT ty FROM b)")
def q_set_operations(spark, sf_dir):
    s = slabs(spark, sf_dir)
    a, b = s.where("unit % 2 = 0 and tx_min < 9").select("ty").distinct(), s.where("unit % 3 = 0 and tx_max > 45").select("ty").distinct()
    named = lambda df, op: df.select(F.lit(op).alias("op"), "ty")
    return named(a.intersect(b), "both").unionByName(named(a.union(b).distinct(), "either")).unionByName(named(a.exceptAll(b), "first"))
