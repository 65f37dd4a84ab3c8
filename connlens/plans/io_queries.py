"""Source / sink queries: write data Spark derives from the tables, read it back."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from connlens.functions.core import md5_uniform, r6
from connlens.plans import sqlfrag as Q
from connlens.plans.registry import register
from connlens.sources import io as IO
from connlens.sources.tables import table

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


@register("scan_csv", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_scan_csv(spark, sf_dir):
    path = IO.scratch(spark, "events_csv")
    IO.write_csv(table(spark, sf_dir, "events"), path)
    return IO.read_csv_headerless(spark, path, EVENT_SCHEMA)


@register("scan_parquet", """
SELECT l_orderkey, l_extendedprice, l_discount FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_discount > 0.05""")
def q_scan_parquet(spark, sf_dir):
    # filter and projection reach the scan: PushedFilters + a 4-column ReadSchema
    li = table(spark, sf_dir, "lineitem")
    return li.where((F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz")) & (F.col("l_discount") > 0.05)
                    ).select("l_orderkey", "l_extendedprice", "l_discount")


REPORT_SCHEMA = T.StructType([
    T.StructField("event_type", T.StringType()), T.StructField("n", T.LongType()),
    T.StructField("mean_value", T.DoubleType()), T.StructField("class_specific", T.StringType())])


@register("scan_report_csv", f"""
SELECT event_type, CAST(count(*) AS BIGINT) AS n, {Q.r6('avg(value)')} AS mean_value,
       {Q.r6("avg(CASE WHEN value > 100 THEN 1.0 ELSE 0.0 END)")} AS share_over_100
FROM events GROUP BY event_type""")
def q_scan_report_csv(spark, sf_dir):
    """A leaderboard-like CSV with a header and a dict-as-string column, read back with
    an explicit schema; the dict column is parsed with ``from_json``."""
    e = table(spark, sf_dir, "events")
    rep = e.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("value")).alias("mean_value"),
        r6(F.avg(F.when(F.col("value") > 100, 1.0).otherwise(0.0))).alias("s"))
    rep = rep.select("event_type", "n", "mean_value",
                     F.to_json(F.create_map(F.lit("share_over_100"), F.col("s"))).alias("class_specific"))
    path = IO.scratch(spark, "report_csv")
    IO.write_csv(rep, path, header=True)
    back = IO.read_report_csv(spark, path, REPORT_SCHEMA)
    m = F.from_json("class_specific", "map<string,double>")
    return back.select("event_type", "n", "mean_value", m["share_over_100"].alias("share_over_100"))


JSON_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])


@register("scan_json_records", f"""
SELECT event_id, user_id, event_type, CASE WHEN {Q.md5_uniform('event_id', 31)} < 0.05 THEN NULL ELSE value END AS value,
       {Q.md5_uniform('event_id', 31)} >= 0.05 AS valid FROM events""")
def q_scan_json_records(spark, sf_dir):
    """Request records as JSON lines; ~5 % lack the required ``value`` field and are
    flagged invalid (the rejects of the scoring contract)."""
    e = table(spark, sf_dir, "events")
    drop = md5_uniform("event_id", 31) < 0.05
    rec = e.select(F.when(drop, F.to_json(F.struct("event_id", "user_id", "event_type")))
                   .otherwise(F.to_json(F.struct("event_id", "user_id", "event_type", "value"))).alias("value"))
    path = IO.scratch(spark, "records_json")
    rec.write.mode("overwrite").text(path)
    back = IO.read_json_records(spark, path, JSON_SCHEMA, ["event_id", "user_id", "event_type", "value"])
    return back.select("event_id", "user_id", "event_type", "value", "valid")


@register("sink_parquet", f"""
SELECT CASE WHEN {Q.md5_uniform('event_id', 42)} < 0.8 THEN 'train' ELSE 'test' END AS split,
       CAST(count(*) AS BIGINT) AS n, {Q.r6('sum(value)')} AS total_value FROM events GROUP BY 1""")
def q_sink_parquet(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn(
        "split", F.when(md5_uniform("event_id", 42) < 0.8, "train").otherwise("test"))
    path = IO.scratch(spark, "splits")
    IO.write_partitioned(e, path, "split")
    back = spark.read.parquet(path)  # partition column restored from the directory names
    return back.groupBy("split").agg(F.count(F.lit(1)).cast("long").alias("n"), r6(F.sum("value")).alias("total_value"))


@register("sink_csv", f"""
SELECT event_type, printf('%.6f', avg(value)) AS mean_value, printf('%.6f', max(value)) AS max_value
FROM events GROUP BY event_type""")
def q_sink_csv(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    m = e.groupBy("event_type").agg(IO.fixed6(F.avg("value")).alias("mean_value"),
                                    IO.fixed6(F.max("value")).alias("max_value"))
    path = IO.scratch(spark, "metrics_csv")
    IO.write_csv(m, path, header=True)
    sch = "event_type string, mean_value string, max_value string"
    return spark.read.schema(sch).option("header", "true").csv(path)


MANIFEST_SCHEMA = ("n_rows long, n_users long, n_event_types long, n_errors long, "
                   "first_ts timestamp_ntz, last_ts timestamp_ntz")


@register("sink_manifest_json", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
       CAST(count(DISTINCT event_type) AS BIGINT) AS n_event_types,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS n_errors, min(ts) AS first_ts, max(ts) AS last_ts
FROM events""")
def q_sink_manifest_json(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    man = e.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("user_id").alias("n_users"),
                F.count_distinct("event_type").alias("n_event_types"),
                F.count_if(F.col("event_type") == "error").alias("n_errors"),
                F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    path = IO.scratch(spark, "manifest")
    IO.write_json_manifest(man, path)
    txt = spark.read.text(path)
    return txt.select(F.from_json("value", MANIFEST_SCHEMA, {"timestampNTZFormat": IO.JSON_TS_FORMAT})
                      .alias("m")).select("m.*")
