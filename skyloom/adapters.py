"""The reference-shaped relations over the star-schema test tables: one text for Spark and for the oracle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ADAPTERS = {
    "cells": """SELECT CAST(s_suppkey AS INT) AS cell_id, CAST(2000 + floor(s_suppkey/25) AS INT) AS projection,
  CAST(5 + floor((s_suppkey % 25)/5) AS INT) AS y, CAST(5 + s_suppkey % 5 AS INT) AS x,
  'skycell.' || CAST(CAST(2000 + floor(s_suppkey/25) AS INT) AS STRING) || '.0' || CAST(CAST(5 + floor((s_suppkey % 25)/5) AS INT) AS STRING)
     || CAST(CAST(5 + s_suppkey % 5 AS INT) AS STRING) AS name,
  6240 AS naxis1, 6240 AS naxis2, 30e0 + 4e0*(CAST(floor(s_suppkey/25) AS INT) % 40) AS crval1,
  -20e0 + 4e0*CAST(floor(CAST(floor(s_suppkey/25) AS INT)/40) AS INT) AS crval2,
  3120e0 - (CAST(s_suppkey % 5 AS INT) - 2)*5760e0 AS crpix1, 3120e0 - (CAST(floor((s_suppkey % 25)/5) AS INT) - 2)*5760e0 AS crpix2,
  1e0 AS pc1_1, 0e0 AS pc1_2, 0e0 AS pc2_1, 1e0 AS pc2_2, -25e-2/3600 AS cdelt1, 25e-2/3600 AS cdelt2 FROM {supplier}""",
    "pixels": """SELECT CAST(l_suppkey AS INT) AS cell_id, CAST(l_orderkey % 32 AS INT) AS y, CAST(l_partkey % 32 AS INT) AS x, CAST(l_linenumber % 4 AS INT) AS band,
  CASE WHEN (l_orderkey % 32 * 32 + l_partkey % 32 + l_suppkey) % 97 = 0 THEN CAST('NaN' AS DOUBLE) ELSE round(max(l_discount)*20e0 + max(l_tax)*10e0, 4) END AS value,
  round(max(l_tax)*10e0 + 5e-1, 4) AS weight, bit_or(1 << CAST(CAST(l_quantity AS INT) % 15 AS INT)) AS mask
FROM {lineitem} GROUP BY l_suppkey, l_orderkey % 32, l_partkey % 32, l_linenumber % 4""",
    "assignment": """SELECT DISTINCT cell_id, y, x, CAST(CASE WHEN (y + x) % 7 = 0 THEN -1 ELSE floor(y/4)*8 + floor(x/4) + 64*(cell_id % 3) END AS INT) AS pix FROM {pixels}""",
    "stars": """SELECT c_custkey AS source_id, 30e0 + (c_custkey*37 % 4000)/1000e0 - 2e0 AS ra, -20e0 + (c_custkey*91 % 4000)/1000e0 - 2e0 AS dec,
  round(10e0 + (c_acctbal + 1000e0)/1100e0, 4) AS phot_rp_mean_mag FROM {customer}""",
    "offsets": """SELECT * FROM (VALUES (0, 0e0, 0e0), (1, -122e-4, -154e-4), (2, -441e-4, -1133e-4)) AS t(offset_id, dx, dy)""",
    "frames": """SELECT event_id AS frame_id, CAST(user_id % 16 AS INT) AS detector, ts AS date_obs, 290e0 + value*1e-3 AS crval1, value*1e-9 AS a_2_0, value*value*1e-12 AS a_1_2 FROM {events}""",
    "padding": """SELECT o_orderkey AS req_id, c.name, c.projection, c.y, c.x, CAST(o_orderkey % 8 AS INT) AS dir,
  CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN p.name WHEN 3 THEN p.name || '/' || c.name ELSE ' ' || p.name || ' , ' END AS pad_skycell
FROM {orders} JOIN {cells} c ON c.cell_id = o_custkey % 10 JOIN {cells} p ON p.cell_id = o_orderkey % 10""",
    "inventory": """SELECT CAST(s_suppkey AS INT) AS cell_id, a.name AS array_name, (s_suppkey*5 + a.i) % 13 <> 0 AS readable, CAST(1024*(1 + a.i) AS BIGINT) AS size_bytes
FROM {supplier} CROSS JOIN (VALUES (0,'r'),(1,'r_mask'),(2,'r_wt'),(3,'i'),(4,'i_mask'),(5,'i_wt'),(6,'z'),(7,'z_mask'),(8,'z_wt'),(9,'y'),(10,'y_mask'),(11,'y_wt'),(12,'r_temp_1'),(13,'extra')) AS a(i, name)
WHERE (s_suppkey*7 + a.i) % 11 <> 0 AND NOT (a.i >= 12 AND s_suppkey % 4 <> 0)""",
    # whole-pixel shifts of the cells for each offset, one of them larger than the raster
    "shifts": """SELECT o.offset_id, c.cell_id, CAST(o.offset_id * (c.cell_id % 5 - 2) + CASE WHEN c.cell_id % 11 = 0 THEN 40 * o.offset_id ELSE 0 END AS INT) AS sx,
  CAST(o.offset_id * (c.cell_id % 3 - 1) AS INT) AS sy FROM {cells} c CROSS JOIN {offsets} o WHERE NOT (c.cell_id % 17 = 3 AND o.offset_id = 2)""",
    "image": """SELECT cell_id, y, x, sum(CASE WHEN isnan(value) THEN 0e0 ELSE value END) AS value, bit_or(mask) AS mask FROM {pixels} GROUP BY cell_id, y, x""",
    "grid": """SELECT CAST(floor(o_orderkey / 32) AS INT) % 32 AS y, CAST(o_orderkey % 32 AS INT) AS x, round(max(o_totalprice) / 1000e0, 3) AS value FROM {orders} GROUP BY 1, 2""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings")


def _names(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or an adapter as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = ADAPTERS[name]
    return spark.sql(sql, **{n: relation(spark, sf_dir, n) for n in _names(sql)})


def with_ctes(sql: str) -> str:
    """The oracle's text with the adapters it names as common table expressions. sql: a query, or `WITH ...` of its own."""
    needed: list[str] = []

    def need(text: str) -> None:
        for n in re.findall(r"\b(\w+)\b", text):
            if n in ADAPTERS and n not in needed and re.search(rf"(FROM|JOIN|,)\s+\{{?{n}\b", text):
                need(ADAPTERS[n])
                if n not in needed:
                    needed.append(n)

    need(sql)
    ctes = ", ".join(f"{n} AS ({re.sub(r'[{}]', '', ADAPTERS[n])})" for n in needed)
    sql = sql.strip()
    if not ctes:
        return sql
    return f"WITH {ctes}, {sql[5:]}" if sql.upper().startswith("WITH ") else f"WITH {ctes} {sql}"
