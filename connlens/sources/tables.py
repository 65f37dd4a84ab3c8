"""Driver tables and the two fixture views every report runs on.

``scored`` turns ``events`` into classifier output (row id, attack name, score);
``conn`` turns ``lineitem ⋈ orders ⋈ part`` into connection records.  Each view is
written once with the DataFrame API and once as a SQL CTE for the DuckDB oracle,
and both must stay in step.

No join here carries a broadcast hint: ``orders`` and ``part`` grow with the data,
so the join strategy is left to Spark's size estimate (broadcast below
``spark.sql.autoBroadcastJoinThreshold``, sort-merge above it, AQE re-plans at
runtime from real shuffle sizes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table (filters/projections push down into the scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# scored: classifier-output view over events
# ---------------------------------------------------------------------------

def _score_shift(event_type: Column) -> Column:
    return (F.when(event_type == "error", F.lit(40.0))
            .when(event_type == "signup", F.lit(20.0))
            .otherwise(F.lit(0.0)))


def scored_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    et = F.col("event_type")
    shifted = F.col("value") + _score_shift(et)
    return ev.select(
        F.col("event_id").alias("row_id"),
        F.when(et == "signup", "neptune").when(et == "purchase", "warezclient")
         .when(et == "error", "mscan").otherwise("normal").alias("class"),
        (shifted / (shifted + F.lit(50.0))).alias("score"),
    )


SCORED_CTE = """scored AS (
  SELECT event_id AS row_id,
         CASE event_type WHEN 'signup' THEN 'neptune' WHEN 'purchase' THEN 'warezclient'
                         WHEN 'error' THEN 'mscan' ELSE 'normal' END AS class,
         (value + CASE event_type WHEN 'error' THEN 40.0 WHEN 'signup' THEN 20.0 ELSE 0.0 END)
       / (value + CASE event_type WHEN 'error' THEN 40.0 WHEN 'signup' THEN 20.0 ELSE 0.0 END + 50.0) AS score
  FROM events)"""


# ---------------------------------------------------------------------------
# conn: connection-record view over lineitem, orders, part
# ---------------------------------------------------------------------------

CONN_KEY = ["l_orderkey", "l_partkey", "dst_host", "l_linenumber", "count_"]


def conn_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_returnflag",
        "l_linestatus", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_type")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    ptype = F.col("p_type")
    return j.select(
        "l_orderkey", "l_partkey",
        F.col("l_suppkey").alias("dst_host"),
        "l_linenumber",
        F.col("o_custkey").alias("src_host"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_returnflag").alias("protocol_type"),
        F.col("p_brand").alias("service"),
        F.concat("l_linestatus", "o_orderstatus").alias("flag"),
        F.col("p_size").alias("duration"),
        F.col("l_extendedprice").alias("src_bytes"),
        F.col("o_totalprice").alias("dst_bytes"),
        F.col("l_quantity").alias("count_"),
        F.when(F.col("l_quantity") >= 48, F.col("l_quantity")).otherwise(F.lit(0.0)).alias("hot"),
        (F.col("l_discount") + F.lit(0.0)).alias("serror_rate"),
        (F.col("l_tax") + F.lit(0.0)).alias("rerror_rate"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("logged_in"),
        F.lit(0).alias("num_outbound_cmds"),
        F.when(ptype == "STANDARD", "normal").when(ptype == "ECONOMY", " Normal ")
         .when(ptype == "SMALL", "neptune").when(ptype == "MEDIUM", "satan")
         .when(ptype == "LARGE", "mscan").otherwise("zzz_unknown").alias("class"),
    )


CONN_CTE = """conn AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey AS dst_host, l.l_linenumber, o.o_custkey AS src_host,
         l.l_shipdate AS ts, l.l_returnflag AS protocol_type, p.p_brand AS service,
         concat(l.l_linestatus, o.o_orderstatus) AS flag,
         p.p_size AS duration, l.l_extendedprice AS src_bytes, o.o_totalprice AS dst_bytes,
         l.l_quantity AS count_,
         CASE WHEN l.l_quantity >= 48 THEN l.l_quantity ELSE 0.0 END AS hot,
         l.l_discount + 0.0 AS serror_rate, l.l_tax + 0.0 AS rerror_rate,
         CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 0 END AS logged_in,
         0 AS num_outbound_cmds,
         CASE p.p_type WHEN 'STANDARD' THEN 'normal' WHEN 'ECONOMY' THEN ' Normal ' WHEN 'SMALL' THEN 'neptune'
                       WHEN 'MEDIUM' THEN 'satan' WHEN 'LARGE' THEN 'mscan' ELSE 'zzz_unknown' END AS class
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
