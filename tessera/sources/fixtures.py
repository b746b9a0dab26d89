"""Rasters derived from relational tables, each the same rows in Spark and in DuckDB.

``SPARK`` and ``DUCK`` hold a named query for each raster; all run over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Suppliers whose blobs one task draws, some 127 pixels each.
BLOBS = 1000
LI_SHAPE = (358, 50)
EV_WIDTH = 720

SPARK = {
    "emb_px": """SELECT CAST(vec_id AS INT) y, CAST(x AS INT) x, CAST(FLOOR((CAST(v AS DOUBLE)+1)*127.5) AS INT) v
        FROM {embeddings} LATERAL VIEW posexplode(embedding) AS x, v""",
    "ev_px": """SELECT CAST(user_id AS INT) y, datediff(CAST(ts AS DATE), DATE'2024-01-01')*24+hour(ts) x, CAST(COUNT(*) AS INT) v
        FROM {events} GROUP BY 1, 2""",
    "blob_px": """WITH o AS (SELECT CAST(s_suppkey+1 AS BIGINT) lab, CAST(5+s_nationkey%4 AS INT) r,
            CAST(24*(s_suppkey%32)+12+(s_suppkey*7)%5-2 AS INT) cx, CAST(24*FLOOR(s_suppkey/32)+12+(s_suppkey*11)%5-2 AS INT) cy FROM {supplier}),
        e AS (SELECT *, explode(sequence(-8, 8)) dy FROM o), f AS (SELECT *, explode(sequence(-8, 8)) dx FROM e)
        SELECT lab, cy+dy y, cx+dx x, CAST(FLOOR(255*(r*r-dx*dx-dy*dy)/(r*r)) AS INT) v FROM f WHERE dx*dx+dy*dy < r*r""",
    "li_px": """WITH g AS (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END c,
            CAST(FLOOR(datediff(CAST(l_shipdate AS DATE), DATE'1995-01-01')/7) AS INT) y, CAST(l_quantity AS INT)-1 x, COUNT(*) n FROM {lineitem} GROUP BY 1, 2, 3),
        r AS (SELECT CAST(id AS INT) y, explode(sequence(0, 49)) x FROM range(358)), d AS (SELECT y, x, explode(array(0, 1, 2)) c FROM r),
        m AS (SELECT MAX(n) mx FROM g)
        SELECT d.c, d.y, d.x, CAST(FLOOR(255*COALESCE(g.n,0)/(SELECT mx FROM m)) AS INT) v FROM d LEFT JOIN g ON g.c=d.c AND g.y=d.y AND g.x=d.x""",
}

DUCK = {
    "emb_px": """SELECT CAST(vec_id AS INT) y, CAST(i-1 AS INT) x, CAST(FLOOR((CAST(embedding[i] AS DOUBLE)+1)*127.5) AS INT) v FROM embeddings, range(1,65) r(i)""",
    "ev_px": """SELECT CAST(user_id AS INT) y, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))*24+hour(ts) AS INT) x, CAST(COUNT(*) AS INT) v FROM events GROUP BY 1,2""",
    "blob_px": """SELECT lab, CAST(cy+dy AS INT) y, CAST(cx+dx AS INT) x, CAST(FLOOR(255*(r*r-dx*dx-dy*dy)/(r*r)) AS INT) v
        FROM (SELECT CAST(s_suppkey+1 AS BIGINT) lab, 5+s_nationkey%4 r, 24*(s_suppkey%32)+12+(s_suppkey*7)%5-2 cx,
        24*CAST(FLOOR(s_suppkey/32) AS INT)+12+(s_suppkey*11)%5-2 cy FROM supplier) o, range(-8,9) a(dx), range(-8,9) b(dy) WHERE dx*dx+dy*dy < r*r""",
    "li_px": """SELECT CAST(d.c AS INT) c, CAST(d.y AS INT) y, CAST(d.x AS INT) x, CAST(FLOOR(255*COALESCE(g.n,0)/m.mx) AS INT) v
        FROM (SELECT a.c, b.y, e.x FROM range(3) a(c), range(358) b(y), range(50) e(x)) d CROSS JOIN
        (SELECT MAX(n) mx FROM (SELECT COUNT(*) n FROM lineitem GROUP BY l_returnflag, CAST(FLOOR(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE))/7) AS INT), l_quantity)) m
        LEFT JOIN (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END c, CAST(FLOOR(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE))/7) AS INT) y,
        CAST(l_quantity AS INT)-1 x, COUNT(*) n FROM lineitem GROUP BY 1,2,3) g ON g.c=d.c AND g.y=d.y AND g.x=d.x""",
}


def raster(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the rasters, from the tables under ``sf_dir``."""
    table = {"emb_px": "embeddings", "ev_px": "events", "blob_px": "supplier", "li_px": "lineitem"}[name]
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if name == "blob_px":  # a small file is one task, and all its pixels would be drawn there
        tasks = -(-rows.count() // BLOBS)
        rows = rows.repartitionByRange(tasks, "s_suppkey") if tasks > 1 else rows
    return spark.sql(SPARK[name].replace("{" + table + "}", "{t}"), t=rows)
