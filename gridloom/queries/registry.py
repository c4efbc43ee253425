"""Names of queries and of the SQL beside them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The projections of gridloom.sources.tables in SQL.
POINTS = "points AS (SELECT c_custkey AS id, ((c_custkey * 7919) % 360000) / 1000.0 - 180.0 AS lon, ((c_custkey * 10473) % 170000) / 1000.0 - 85.0 AS lat FROM customer)"
PIXELS = """pixels AS (SELECT CAST(l_orderkey % 64 AS INTEGER) AS unit, CAST(l_suppkey % 32 AS INTEGER) AS "row", CAST(l_partkey % 32 AS INTEGER) AS col, l_linenumber % 2 AS date_idx,
  CASE WHEN NOT bool_or(l_returnflag = 'R') THEN CAST(sum(CAST(floor(l_quantity) AS BIGINT) * 180) // count(*) AS BIGINT) END AS r,
  CASE WHEN NOT bool_or(l_returnflag = 'R') THEN CAST(sum(CAST(floor(l_extendedprice / 12) AS BIGINT)) // count(*) AS BIGINT) END AS g,
  CASE WHEN NOT bool_or(l_returnflag = 'R') THEN CAST(sum(CAST(floor(l_discount * 90000 + 0.5) AS BIGINT)) // count(*) AS BIGINT) END AS b
  FROM lineitem GROUP BY ALL)"""
GRIDS = """grids AS (SELECT vec_id AS raster_id, CAST(floor((pos - 1) / 8) AS INTEGER) AS "row", CAST((pos - 1) % 8 AS INTEGER) AS col, CAST(v AS DOUBLE) * 400 - 20 AS depth
  FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings))"""
MOSAIC = f"""{GRIDS}, mosaic AS (SELECT raster_id, CAST(raster_id // 64 * 8 + "row" AS INTEGER) AS "row", CAST(raster_id % 64 * 8 + col AS INTEGER) AS col, depth FROM grids)"""
SLABS = """slabs AS (SELECT o_orderkey AS seq, CAST(o_orderkey % 97 AS INTEGER) AS unit, CAST(o_custkey % 64 AS INTEGER) AS ty, CAST(o_orderkey % 50 AS INTEGER) AS tx_min,
  CAST(o_orderkey % 50 + o_orderkey % 7 AS INTEGER) AS tx_max FROM orders)"""
CATALOGUE = """listed AS (SELECT CAST(year(o_orderdate) AS VARCHAR) || '/' || lpad(CAST(quarter(o_orderdate) * 3 - 2 AS VARCHAR), 2, '0') || '/01' AS date_path, quarter(o_orderdate) AS q,
  lpad(CAST(o_custkey % 60 + 1 AS VARCHAR), 2, '0') || 'T' || chr(CAST(65 + o_custkey % 8 AS INTEGER)) || chr(CAST(65 + (o_custkey // 8) % 8 AS INTEGER)) || '_' || CAST(o_custkey % 2 AS VARCHAR) || '_' || CAST((o_custkey // 2) % 2 AS VARCHAR) AS unit FROM orders),
catalogue AS (SELECT DISTINCT date_path, 'Scene_mosaic_' || split_part(date_path, '/', 1) || '_Q' || CAST(q AS VARCHAR) || '_' || unit AS folder, unit FROM listed)"""
SCENES = """scenes AS (SELECT event_id AS seq, CASE WHEN event_id % 13 <> 0 THEN user_id END AS entity, CASE WHEN event_id % 11 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS start,
  json_extract_string(props, '$.k') AS k FROM events)"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add
