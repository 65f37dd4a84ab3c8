"""Profiling / data-quality queries over the ``conn`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from connlens.operators import labels as L
from connlens.operators import quality as QL
from connlens.plans import sqlfrag as Q
from connlens.plans.registry import register
from connlens.sources.tables import CONN_CTE, conn_view, with_ctes

W = with_ctes(CONN_CTE)
CONN_COLS = ["l_orderkey", "l_partkey", "dst_host", "l_linenumber", "src_host", "ts", "protocol_type",
             "service", "flag", "duration", "src_bytes", "dst_bytes", "count_", "hot", "serror_rate",
             "rerror_rate", "logged_in", "num_outbound_cmds", "class"]
NUM_COLS = ["duration", "src_bytes", "dst_bytes", "count_", "hot", "serror_rate", "rerror_rate"]
CAT_COLS = ["protocol_type", "service", "flag"]
FAMILIES = ["DoS", "Normal", "Probe", "R2L", "U2R"]


def _unpivot_sql(cols, fmt, name="column", val="v"):
    return " UNION ALL ".join(f"SELECT '{c}' AS {name}, {fmt.format(c=c)} AS {val} FROM conn" for c in cols)


@register("contract_check", W + f"""
SELECT CAST(sum(c) AS BIGINT) AS num_samples, CAST({len(CONN_COLS)} AS BIGINT) AS num_features,
       CAST(sum(c - 1) AS BIGINT) AS duplicate_count, CAST(sum(nt) AS BIGINT) AS null_targets,
       CASE WHEN sum(c) = 0 THEN 'fail: empty' WHEN sum(nt) > 0 THEN 'fail: null target' ELSE 'success' END AS status
FROM (SELECT count(*) AS c, count(*) FILTER (WHERE class IS NULL) AS nt FROM conn
      GROUP BY ALL_COLS_BUT_CLASS)""".replace("ALL_COLS_BUT_CLASS", ", ".join(c for c in CONN_COLS if c != "class")))
def q_contract_check(spark, sf_dir):
    return QL.contract_report(conn_view(spark, sf_dir), CONN_COLS, "class", CAT_COLS)


@register("missing_counts", W + " UNION ALL ".join(
    [f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM conn"
     for c in CONN_COLS]
    + ["SELECT '__total__' AS column, CAST(" + " + ".join(
        f"count(*) FILTER (WHERE {c} IS NULL)" for c in CONN_COLS) + " AS BIGINT) AS nulls FROM conn"]))
def q_missing_counts(spark, sf_dir):
    return QL.missing_counts(conn_view(spark, sf_dir), CONN_COLS)


@register("duplicate_count", W + f"""
SELECT CAST(COALESCE(sum(c - 1), 0) AS BIGINT) AS duplicate_count
FROM (SELECT count(*) AS c FROM conn GROUP BY {", ".join(c for c in CONN_COLS if c != "class")})""")
def q_duplicate_count(spark, sf_dir):
    return QL.duplicate_count(conn_view(spark, sf_dir), [c for c in CONN_COLS if c != "class"])


@register("row_col_counts", W + f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST({len(CONN_COLS)} AS BIGINT) AS n_cols,
       CAST(4 AS BIGINT) AS n_string_cols, CAST(14 AS BIGINT) AS n_numeric_cols,
       CAST(1 AS BIGINT) AS n_timestamp_cols FROM conn""")
def q_row_col_counts(spark, sf_dir):
    return QL.row_col_counts(conn_view(spark, sf_dir))


UNIQ = ["protocol_type", "service", "flag", "dst_host", "src_host", "class"]


@register("nunique", W + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(DISTINCT {c}) AS BIGINT) AS nunique FROM conn" for c in UNIQ))
def q_nunique(spark, sf_dir):
    return QL.nunique(conn_view(spark, sf_dir), UNIQ)


@register("distinct_values", W + "SELECT DISTINCT class AS value FROM conn WHERE class IS NOT NULL")
def q_distinct_values(spark, sf_dir):
    return conn_view(spark, sf_dir).where(F.col("class").isNotNull()).select(F.col("class").alias("value")).distinct()


@register("value_counts", W + f"""
SELECT service AS value, CAST(count(*) AS BIGINT) AS n,
       {Q.r6("count(*) * 1.0 / sum(count(*)) OVER ()")} AS share
FROM conn WHERE service IS NOT NULL GROUP BY service""")
def q_value_counts(spark, sf_dir):
    return QL.value_counts(conn_view(spark, sf_dir), "service")


@register("share_of_total", W + f"""
SELECT protocol_type, CAST(count(*) AS BIGINT) AS n,
       {Q.r6("count(*) * 1.0 / sum(count(*)) OVER ()")} AS share
FROM conn GROUP BY protocol_type""")
def q_share_of_total(spark, sf_dir):
    g = conn_view(spark, sf_dir).groupBy("protocol_type").agg(F.count(F.lit(1)).alias("n"))
    return QL.share_of_total(g, "n")


@register("describe_numeric", W + " UNION ALL ".join(f"""
SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, {Q.r6(f"avg({c})")} AS mean,
       {Q.r6(f"stddev_samp({c})")} AS std, {Q.r6(f"min({c})")} AS min,
       {Q.r6(f"quantile_cont({c}, 0.25)")} AS q25, {Q.r6(f"quantile_cont({c}, 0.5)")} AS q50,
       {Q.r6(f"quantile_cont({c}, 0.75)")} AS q75, {Q.r6(f"max({c})")} AS max FROM conn""" for c in NUM_COLS))
def q_describe_numeric(spark, sf_dir):
    return QL.describe_numeric(conn_view(spark, sf_dir), NUM_COLS)


@register("quantile_fit", W + " UNION ALL ".join(f"""
SELECT '{c}' AS column, {Q.r6(f"quantile_cont({c}, 0.25)")} AS q25, {Q.r6(f"quantile_cont({c}, 0.5)")} AS q50,
       {Q.r6(f"quantile_cont({c}, 0.75)")} AS q75 FROM conn""" for c in NUM_COLS))
def q_quantile_fit(spark, sf_dir):
    from connlens.operators.features import quantile_fit
    return quantile_fit(conn_view(spark, sf_dir), NUM_COLS).select(
        "column", *[F.round(c, 6).alias(c) for c in ("q25", "q50", "q75")])


@register("skewness_g1", W + " UNION ALL ".join(
    f"SELECT '{c}' AS column, {Q.r6(f'skewness({c})')} AS skewness FROM conn" for c in NUM_COLS))
def q_skewness_g1(spark, sf_dir):
    return QL.skewness_g1(conn_view(spark, sf_dir), NUM_COLS)


@register("histogram", W + f"""
, mm AS (SELECT min(src_bytes) AS lo, max(src_bytes) AS hi FROM conn),
b AS (SELECT CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor((src_bytes - lo) / ((hi - lo) / 50)) AS INTEGER), 49) END AS bin
      FROM conn, mm WHERE src_bytes IS NOT NULL),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT g.bin, {Q.r6("lo + g.bin * (hi - lo) / 50")} AS lo, {Q.r6("lo + (g.bin + 1) * (hi - lo) / 50")} AS hi,
       CAST(COALESCE(c.n, 0) AS BIGINT) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(50)) g CROSS JOIN mm LEFT JOIN c ON g.bin = c.bin""")
def q_histogram(spark, sf_dir):
    return QL.histogram(conn_view(spark, sf_dir), "src_bytes", 50)


@register("crosstab", W + f"""
SELECT protocol_type, {", ".join(f"CAST(count(*) FILTER (WHERE cat = '{v}') AS BIGINT) AS {v}" for v in FAMILIES)}
FROM (SELECT protocol_type, {Q.eda_category()} AS cat FROM conn) GROUP BY protocol_type""")
def q_crosstab(spark, sf_dir):
    df = conn_view(spark, sf_dir).select("protocol_type", L.eda_category("class").alias("cat"))
    return QL.crosstab(df, "protocol_type", "cat", FAMILIES)


@register("correlation_matrix", W + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {Q.r6(f'corr({a}, {b})')} AS r FROM conn"
    for i, a in enumerate(NUM_COLS) for b in NUM_COLS[i + 1:]))
def q_correlation_matrix(spark, sf_dir):
    return QL.correlation_matrix(conn_view(spark, sf_dir), NUM_COLS)


ZV = NUM_COLS + ["num_outbound_cmds", "logged_in"]


@register("zero_variance", W + " UNION ALL ".join(
    f"SELECT '{c}' AS column, (CAST(min({c}) AS VARCHAR) IS NOT DISTINCT FROM CAST(max({c}) AS VARCHAR)) AS constant "
    f"FROM conn" for c in ZV))
def q_zero_variance(spark, sf_dir):
    return QL.zero_variance(conn_view(spark, sf_dir), ZV)


@register("class_distribution", W + f"""
SELECT CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE b = 0) AS BIGINT) AS binary_0, CAST(count(*) FILTER (WHERE b = 1) AS BIGINT) AS binary_1,
       {", ".join(f"CAST(count(*) FILTER (WHERE f = {v}) AS BIGINT) AS family_{v}" for v in range(5))}
FROM (SELECT {Q.binary_label()} AS b, {Q.family_label()} AS f FROM conn)""")
def q_class_distribution(spark, sf_dir):
    df = conn_view(spark, sf_dir).select(L.binary_label().alias("b"), L.family_label().alias("f"))
    return QL.class_distribution(df, "b", "f")


@register("rollup_quality", W + f"""
SELECT protocol_type, seg AS segment, CAST(count(*) AS BIGINT) AS n, {Q.r6("avg(b)")} AS attack_rate,
       CAST(grouping(protocol_type, seg) AS INTEGER) AS grouping_id
FROM (SELECT protocol_type, {Q.segment()} AS seg, {Q.binary_label()} AS b FROM conn)
GROUP BY ROLLUP (protocol_type, seg)""")
def q_rollup_quality(spark, sf_dir):
    df = conn_view(spark, sf_dir).select("protocol_type", L.segment().alias("segment"), L.binary_label().alias("b"))
    return (df.rollup("protocol_type", "segment")
            .agg(F.count(F.lit(1)).cast("long").alias("n"), F.round(F.avg("b"), 6).alias("attack_rate"),
                 F.grouping_id().cast("int").alias("grouping_id")))


@register("select_dtype", W + "SELECT protocol_type, service, flag, class FROM conn")
def q_select_dtype(spark, sf_dir):
    df = conn_view(spark, sf_dir)
    return df.select(*QL.columns_of_type(df, "string"))


@register("drop_columns", W + "SELECT * EXCLUDE (num_outbound_cmds, class) FROM conn")
def q_drop_columns(spark, sf_dir):
    return conn_view(spark, sf_dir).drop("num_outbound_cmds", "class")


@register("preview_head", W + """
SELECT * FROM conn ORDER BY l_orderkey, l_partkey, dst_host, l_linenumber, count_ LIMIT 3""")
def q_preview_head(spark, sf_dir):
    # head(3) is the feature: a top-3 by a total key order, executed as TakeOrdered
    return conn_view(spark, sf_dir).orderBy("l_orderkey", "l_partkey", "dst_host", "l_linenumber", "count_").limit(3)
