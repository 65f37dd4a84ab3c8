"""Traffic-window queries over ``events`` (host = user_id, service = event_type)."""

from __future__ import annotations

from pyspark.sql import functions as F

from connlens.operators import traffic as TR
from connlens.plans import sqlfrag as Q
from connlens.plans.registry import register
from connlens.sources.tables import table

T_SECONDS = 2          # the window of the record format
DAY_SECONDS = 86400    # at the density of the driver's events 2 s hold few rows, a day many
LAST_N = 100


def _err():
    return F.col("event_type") == "error", F.col("value") > 400


SOURCE_SQL = "CAST(json_extract(props, '$.k') AS INTEGER) AS src_host, CAST(floor(value / 100) AS BIGINT) AS src_port"
ERR_SQL = "CAST(event_type = 'error' AS INTEGER) AS se, CAST(value > 400 AS INTEGER) AS re"


def _win(part, frame):
    return f"OVER (PARTITION BY {part} ORDER BY ts {frame})"


def _time_sql(interval):
    def over(part):
        return _win(part, f"RANGE BETWEEN INTERVAL {interval} PRECEDING AND CURRENT ROW")

    return f"""
WITH e AS (SELECT event_id, ts, user_id, event_type, {ERR_SQL} FROM events),
w AS (SELECT event_id,
        count(*) {over('user_id')} AS hc, sum(se) {over('user_id')} AS hse, sum(re) {over('user_id')} AS hre,
        count(*) {over('event_type')} AS sc, sum(se) {over('event_type')} AS sse, sum(re) {over('event_type')} AS sre,
        count(*) {over('user_id, event_type')} AS hsc
      FROM e)
SELECT event_id, CAST(hc AS BIGINT) AS count, CAST(sc AS BIGINT) AS srv_count,
       {Q.r6(Q.sdiv('hse', 'hc'))} AS serror_rate, {Q.r6(Q.sdiv('sse', 'sc'))} AS srv_serror_rate,
       {Q.r6(Q.sdiv('hre', 'hc'))} AS rerror_rate, {Q.r6(Q.sdiv('sre', 'sc'))} AS srv_rerror_rate,
       {Q.r6(Q.sdiv('hsc', 'hc'))} AS same_srv_rate, {Q.r6('1.0 - ' + Q.sdiv('hsc', 'hc'))} AS diff_srv_rate,
       {Q.r6('1.0 - ' + Q.sdiv('hsc', 'sc'))} AS srv_diff_host_rate FROM w"""


def _time_window(spark, sf_dir, seconds):
    se, re = _err()
    return TR.traffic_time_window(table(spark, sf_dir, "events"), "event_id", "ts", "user_id", "event_type", se, re, seconds)


@register("traffic_time_window", _time_sql("1 DAY"))
def q_traffic_time_window(spark, sf_dir):
    return _time_window(spark, sf_dir, DAY_SECONDS)


@register("traffic_time_window_2s", _time_sql("2 SECOND"))
def q_traffic_time_window_2s(spark, sf_dir):
    return _time_window(spark, sf_dir, T_SECONDS)


HOST_SQL = f"""
WITH e AS (SELECT event_id, ts, user_id, event_type, {ERR_SQL}, {SOURCE_SQL},
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rk FROM events),
w AS (SELECT event_id,
        count(*) OVER (PARTITION BY user_id ORDER BY rk RANGE BETWEEN {LAST_N - 1} PRECEDING AND CURRENT ROW) AS dc,
        sum(se) OVER (PARTITION BY user_id ORDER BY rk RANGE BETWEEN {LAST_N - 1} PRECEDING AND CURRENT ROW) AS dse,
        sum(re) OVER (PARTITION BY user_id ORDER BY rk RANGE BETWEEN {LAST_N - 1} PRECEDING AND CURRENT ROW) AS dre,
        count(*) OVER (PARTITION BY user_id, event_type ORDER BY rk
                       RANGE BETWEEN {LAST_N - 1} PRECEDING AND CURRENT ROW) AS sc,
        sum(se) OVER (PARTITION BY user_id, event_type ORDER BY rk
                      RANGE BETWEEN {LAST_N - 1} PRECEDING AND CURRENT ROW) AS sse,
        sum(re) OVER (PARTITION BY user_id, event_type ORDER BY rk
                      RANGE BETWEEN {LAST_N - 1} PRECEDING AND CURRENT ROW) AS sre,
        count(*) OVER (PARTITION BY user_id, src_port ORDER BY rk
                       RANGE BETWEEN {LAST_N - 1} PRECEDING AND CURRENT ROW) AS pc,
        count(DISTINCT src_host) OVER (PARTITION BY user_id, event_type ORDER BY rk
                                       RANGE BETWEEN {LAST_N - 1} PRECEDING AND CURRENT ROW) AS hosts FROM e)
SELECT event_id, CAST(dc AS BIGINT) AS dst_host_count, CAST(sc AS BIGINT) AS dst_host_srv_count,
       {Q.r6(Q.sdiv('sc', 'dc'))} AS dst_host_same_srv_rate, {Q.r6('1.0 - ' + Q.sdiv('sc', 'dc'))} AS dst_host_diff_srv_rate,
       {Q.r6(Q.sdiv('pc', 'dc'))} AS dst_host_same_src_port_rate, {Q.r6(Q.sdiv('hosts', 'sc'))} AS dst_host_srv_diff_host_rate,
       {Q.r6(Q.sdiv('dse', 'dc'))} AS dst_host_serror_rate, {Q.r6(Q.sdiv('sse', 'sc'))} AS dst_host_srv_serror_rate,
       {Q.r6(Q.sdiv('dre', 'dc'))} AS dst_host_rerror_rate, {Q.r6(Q.sdiv('sre', 'sc'))} AS dst_host_srv_rerror_rate
FROM w"""


def with_source(events):
    return events.withColumn("src_host", F.get_json_object("props", "$.k").cast("int")).withColumn("src_port", F.floor(F.col("value") / 100))


@register("traffic_host_window", HOST_SQL)
def q_traffic_host_window(spark, sf_dir):
    e = with_source(table(spark, sf_dir, "events"))
    se, re = _err()
    return TR.traffic_host_window(e, "event_id", "ts", "user_id", "event_type", "src_host", "src_port", se, re, LAST_N)
