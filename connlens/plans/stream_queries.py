"""Streaming queries: each runs to completion (Trigger.AvailableNow) over the events
file and returns what its sink wrote.  Where the result is deterministic the oracle is
the equivalent batch SQL."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from connlens.functions.core import md5_uniform, r6
from connlens.operators import hybrid as H
from connlens.operators import labels as L
from connlens.plans import sqlfrag as Q
from connlens.plans import traffic_queries as TQ
from connlens.plans.metric_queries import multi_pred
from connlens.plans.registry import register
from connlens.sources.tables import table
from connlens.streaming import jobs as S
from connlens.streaming import sink as SINK

DELAY = "1 hour"
def _err():
    return F.col("event_type") == "error"


def _newest(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(F.max("ts").alias("ts"))


@register("stream_tumbling", f"""
SELECT window_start, window_end, event_type, CAST(n AS BIGINT) AS n, CAST(errors AS BIGINT) AS errors FROM (
  SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
         event_type, count(*) AS n, sum(CAST(event_type = 'error' AS INTEGER)) AS errors
  FROM events GROUP BY 1, 2, 3)""")
def q_stream_tumbling(spark, sf_dir):
    out, _ = S.run_to_table(S.tumbling_counts(S.event_stream(spark, sf_dir), "event_type", "1 day", DELAY, _err()),
                            "tumbling", mode="update")
    return S.last_emissions(out, ["window_start", "window_end", "event_type"]).withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn(
        "window_end", F.col("window_end").cast("timestamp_ntz"))


@register("stream_sliding", f"""
WITH b AS (SELECT ts, event_type, CAST(event_type = 'error' AS DOUBLE) AS e,
                  time_bucket(INTERVAL 6 HOUR, ts) AS b0 FROM events),
w AS (SELECT b0 - INTERVAL (6 * k) HOUR AS window_start, event_type, e FROM b, range(0, 4) r(k))
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, CAST(count(*) AS BIGINT) AS n,
       {Q.r6('avg(e)')} AS error_rate
FROM w GROUP BY window_start, event_type""")
def q_stream_sliding(spark, sf_dir):
    s = S.sliding_counts(S.event_stream(spark, sf_dir), "event_type", "1 day", "6 hours", DELAY, _err())
    out, _ = S.run_to_table(s, "sliding", mode="update")
    return S.last_emissions(out, ["window_start", "window_end", "event_type"]).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_type", "n",
                      r6("error_rate").alias("error_rate"))


@register("stream_session", f"""
WITH e AS (SELECT user_id, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
g AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, CAST(count(*) AS BIGINT) AS n_events,
       {Q.r6('sum(value)')} AS total_value
FROM g GROUP BY user_id, sid""")
def q_stream_session(spark, sf_dir):
    """A session is emitted when the watermark has passed its end, those still open when the data end at the end of the
    stream."""
    out, _ = S.run_until_closed(S.event_stream(spark, sf_dir), _newest(spark, sf_dir),
                                lambda events: S.sessions(events, "user_id", "30 minutes", DELAY), "sessions", "30 minutes", DELAY)
    return out.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                      F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n_events",
                      r6("total_value").alias("total_value"))


REPEATED = "substr(md5(concat_ws('|', '60', cast(event_id as string))), 1, 1) IN ('0', '1')"


@register("stream_dedup", """
SELECT event_id, user_id, event_type, ts FROM (
  SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev FROM events)
WHERE prev IS NULL OR ts - prev >= INTERVAL 1 HOUR""")
def q_stream_dedup(spark, sf_dir):
    """The stream delivers one event in eight twice: copies are dropped first.  Of a user's events of one type less than
    an hour apart, the first is then kept."""
    def job(events):
        twice = events.withColumn("again", F.explode(F.when(F.expr(REPEATED), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        once = S.dedup(twice, ["event_id", "user_id", "event_type", "ts"], DELAY)
        return S.burst_firsts(once, ["user_id", "event_type"], "1 hour")

    out, _ = S.run_until_closed(S.event_stream(spark, sf_dir), _newest(spark, sf_dir), job, "dedup", "1 hour", DELAY)
    return out.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))


@register("stream_late", """
WITH b AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS cut, max(ts) - INTERVAL 10 MINUTE AS mark FROM events),
r AS (SELECT CASE WHEN ts >= cut THEN 0 ELSE 1 END AS batch_id, ts < cut AND ts < mark AS late FROM events, b)
SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS input_rows,
       CAST(count(*) FILTER (WHERE NOT late) AS BIGINT) AS accepted_rows, CAST(count(*) FILTER (WHERE late) AS BIGINT) AS late_rows
FROM r GROUP BY batch_id""")
def q_stream_late(spark, sf_dir):
    """Bounded lateness.  The later half of the timeline is replayed first; then the query is restarted from its
    checkpoint with the earlier half added.  Rows behind the watermark (10 minutes) are dropped by Spark; per batch with
    rows, the counts come from the query's progress (read, late) and an observed metric (accepted)."""
    from connlens.sources import io as IO
    ev = table(spark, sf_dir, "events")
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    cut = F.lit(lo + (hi - lo) / 2)
    source, root = IO.scratch(spark, "late_replay"), IO.scratch(spark, "late_run")
    batches = []
    for half in (F.col("ts") >= cut, F.col("ts") < cut):
        ev.where(half).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ev.schema).parquet(source).withColumn("ts", F.col("ts").cast("timestamp"))
        _, stats = S.run_to_table(S.late_counts(stream, "event_id", "10 minutes"), "late", root=root)
        batches += [p for p in stats["progress"] if p["input"]]
    rows = [(k, p["input"], p["observed"]["accepted"]["n"], p["late"]) for k, p in enumerate(batches)]  # one a micro-batch
    return spark.createDataFrame(rows, "batch_id long, input_rows long, accepted_rows long, late_rows long")


def _staged_stream(s):
    shift = F.when(F.col("event_type") == "error", 40.0).when(F.col("event_type") == "signup", 20.0).otherwise(0.0)
    v = F.col("value") + shift
    cls = (F.when(F.col("event_type") == "signup", "neptune").when(F.col("event_type") == "purchase", "warezclient")
           .when(F.col("event_type") == "error", "mscan").otherwise("normal"))
    sc = s.select(F.col("event_id").alias("row_id"), cls.alias("class"), (v / (v + 50.0)).alias("score"))
    d1 = F.lit(0.45) - F.col("score")
    s2 = F.when(md5_uniform("row_id", 5) < 0.3, F.lit(0)).otherwise(L.family_label("class"))
    top = 0.7 + 0.3 * md5_uniform("row_id", 6)
    st = sc.select("row_id", d1.alias("d1"), (d1 < 0).alias("s1_anomaly"), s2.alias("s2_pred"), top.alias("_top"))
    probs = F.transform(F.sequence(F.lit(0), F.lit(4)),
                        lambda k: F.when(k == F.col("s2_pred"), F.col("_top")).otherwise((1 - F.col("_top")) / 4))
    return st.withColumn("probs", probs)


def _serve_sql():
    from connlens.plans.model_queries import _serve_sql as serve
    return serve(None)


@register("stream_score", _serve_sql())
def q_stream_score(spark, sf_dir):
    st = _staged_stream(S.event_stream(spark, sf_dir))
    r = st.select("row_id", H.serve("s1_anomaly", "s2_pred", "d1", "probs", None).alias("r"))
    out, _ = S.run_to_table(r.select("row_id", "r.is_attack", "r.attack_family", r6("r.confidence").alias("confidence"),
                                     r6("r.stage1_score").alias("stage1_score")), "score")
    return out.drop("batch")


def _truncated(props, event_id):
    bad = md5_uniform(event_id, 50) < 0.02
    return F.when(bad, F.expr(f"substring({props}, 1, length({props}) - 1)")).otherwise(F.col(props))


@register("stream_rejects", f"""
WITH r AS (SELECT event_id, CASE WHEN {Q.md5_uniform('event_id', 50)} < 0.02 THEN substr(props, 1, length(props) - 1)
                                 ELSE props END AS raw FROM events)
SELECT event_id, raw, NOT json_valid(raw) AS rejected,
       CASE WHEN json_valid(raw) THEN CAST(json_extract(raw, '$.k') AS INTEGER) END AS k FROM r""")
def q_stream_rejects(spark, sf_dir):
    """Malformed records (every ~50th props string truncated) are routed to a rejects
    sink; valid ones to the accepted sink -- two writes per micro-batch."""
    s = S.event_stream(spark, sf_dir).select("event_id", _truncated("props", "event_id").alias("raw"))
    parsed = s.select("event_id", "raw", F.from_json("raw", "k INT", {"mode": "PERMISSIVE"}).alias("j"))

    def per_batch(batch, epoch, root):
        batch = batch.withColumn("rejected", F.col("j").isNull() | F.col("j.k").isNull())
        S.write_batch(batch.where("rejected").select("event_id", "raw"), os.path.join(root, "rejects"), epoch)
        S.write_batch(batch.where("NOT rejected").select("event_id", "raw", F.col("j.k").alias("k")), os.path.join(root, "accepted"), epoch)

    _, stats = S.run_to_table(parsed, "rejects", per_batch=per_batch)
    acc = S.read_if_exists(spark, os.path.join(stats["root"], "accepted")).drop("batch").withColumn("rejected", F.lit(False))
    rej = S.read_if_exists(spark, os.path.join(stats["root"], "rejects"))
    if rej is None:
        return acc
    return acc.unionByName(rej.select("event_id", "raw", F.lit(True).alias("rejected"), F.lit(None).cast("int").alias("k")))


@register("stream_alert_rollup", (
    "WITH " + _serve_sql()[len("WITH "):].split("SELECT row_id, (", 1)[0] + f"""
SELECT {Q.family_name('pred')} AS attack_family, CAST(count(*) AS BIGINT) AS n_alerts
FROM (SELECT CASE WHEN NOT s1_anomaly THEN 0 WHEN s2_pred <> 0 THEN s2_pred ELSE 3 END AS pred FROM st) GROUP BY 1"""))
def q_stream_alert_rollup(spark, sf_dir):
    st = _staged_stream(S.event_stream(spark, sf_dir))
    dec = st.select(L.family_name(H.decide("s1_anomaly", "s2_pred", "d1", None)).alias("attack_family"))
    agg = dec.groupBy("attack_family").agg(F.count(F.lit(1)).cast("long").alias("n_alerts"))  # <= 5 keys of state
    out, _ = S.run_to_table(agg, "alerts", mode="complete")
    return out.drop("batch")


@register("stream_recent", """
SELECT user_id, CAST(rk AS INTEGER) AS rank, event_id, ts, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk FROM events) WHERE rk <= 5""")
def q_stream_recent(spark, sf_dir):
    s = S.event_stream(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    out, _ = S.run_to_table(S.last_n_per_key(s, "user_id", 5, ["event_type"]), "recent", mode="update")
    return S.latest_per_key(out, "user_id").select("user_id", "rank", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type")


@register("stream_host_window", TQ.HOST_SQL)
def q_stream_host_window(spark, sf_dir):
    se, re = TQ._err()
    s = TQ.with_source(S.event_stream(spark, sf_dir)).select(
        "event_id", "ts", "user_id", "event_type", "src_host", "src_port", se.cast("int").alias("se"), re.cast("int").alias("re"))
    online = S.host_window_online("user_id", "event_type", "src_host", "src_port", TQ.LAST_N, "se", "re")
    _, stats = S.run_to_table(s, "hostwin", per_batch=online)
    return S.read_if_exists(spark, os.path.join(stats["root"], "out")).drop("batch")


@register("drift_monitor", f"""
WITH base AS (SELECT avg(value) AS mu, stddev_samp(value) AS sd FROM events),
seen AS (SELECT DISTINCT event_type FROM events WHERE ts < (SELECT min(ts) FROM events) + INTERVAL 1 DAY),
d AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, e.event_type, value,
             CASE WHEN s.event_type IS NULL THEN 1.0 ELSE 0.0 END AS unseen
      FROM events e LEFT JOIN seen s ON e.event_type = s.event_type)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, CAST(count(*) AS BIGINT) AS n,
       {Q.r6('avg(unseen)')} AS unseen_share, {Q.r6('(avg(value) - max(mu)) / max(sd)')} AS mean_shift_z
FROM d, base GROUP BY window_start""")
def q_drift_monitor(spark, sf_dir):
    """Daily windows of the stream joined to a static baseline computed from the table
    (categories seen on the first day; mean and std of value)."""
    ev = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first = ev.agg(F.min("ts")).scalar()
    seen = ev.where(F.col("ts") < first + F.expr("INTERVAL 1 DAY")).select("event_type").distinct().withColumn(
        "_seen", F.lit(1))
    base = ev.agg(F.avg("value").alias("mu"), F.stddev_samp("value").alias("sd"))
    s = S.event_stream(spark, sf_dir).join(seen, "event_type", "left")  # stream-static join; Spark sizes the static side
    agg = (s.withWatermark("ts", DELAY).groupBy(F.window("ts", "1 day").alias("w"))
           .agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("_seen").isNull(), 1.0).otherwise(0.0)).alias("u"),
                F.avg("value").alias("m")))
    out, _ = S.run_to_table(agg, "drift", mode="update")
    out = S.last_emissions(out, ["w"])
    b = base.first()  # two numbers
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), F.col("n").cast("long").alias("n"),
                      r6("u").alias("unseen_share"), r6((F.col("m") - F.lit(b["mu"])) / F.lit(b["sd"])).alias("mean_shift_z"))


@register("foreach_report", (
    "WITH " + _serve_sql()[len("WITH "):].split("SELECT row_id, (", 1)[0] + """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(CASE WHEN pred <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS attacks
FROM (SELECT CASE WHEN NOT s1_anomaly THEN 0 WHEN s2_pred <> 0 THEN s2_pred ELSE 3 END AS pred FROM st)"""))
def q_foreach_report(spark, sf_dir):
    """Decisions written by the committing sink, whose failed micro-batches leave nothing visible; totals over them."""
    from connlens.session import ship_package
    from connlens.sources import io as IO
    ship_package(spark)
    spark.dataSource.register(SINK.CommittedParquet)
    root = IO.scratch(spark, "foreach_report")
    st = _staged_stream(S.event_stream(spark, sf_dir, max_files=1))
    dec = st.select("row_id", H.decide("s1_anomaly", "s2_pred", "d1", None).alias("pred"))
    q = (dec.writeStream.format("committed_parquet").option("path", os.path.join(root, "sink"))
         .option("checkpointLocation", os.path.join(root, "checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    rows = SINK.committed(spark, os.path.join(root, "sink"), dec.schema)
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum((F.col("pred") != 0).cast("long")), F.lit(0)).alias("attacks"))
