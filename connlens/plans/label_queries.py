"""Label, predicate, scalar-function, set-operation and join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from connlens import config
from connlens.functions import arrays as A
from connlens.functions.core import md5_uniform, r6
from connlens.operators import joins as J
from connlens.operators import labels as L
from connlens.plans import sqlfrag as Q
from connlens.plans.registry import register
from connlens.sources.tables import CONN_CTE, SCORED_CTE, conn_view, scored_view, table, with_ctes

WC = with_ctes(CONN_CTE)
WS = with_ctes(SCORED_CTE)
KEY = ["l_orderkey", "l_partkey", "dst_host", "l_linenumber", "count_"]
KEYS = ", ".join(KEY)


# ---------------------------------------------------------------------------
# labels / segments
# ---------------------------------------------------------------------------

@register("label_binary", WC + f"SELECT {KEYS}, class, {Q.binary_label()} AS target_label FROM conn")
def q_label_binary(spark, sf_dir):
    return conn_view(spark, sf_dir).select(*KEY, "class", L.binary_label().alias("target_label"))


@register("label_multiclass", WC + f"SELECT {KEYS}, class, {Q.family_label()} AS multiclass_label FROM conn")
def q_label_multiclass(spark, sf_dir):
    return conn_view(spark, sf_dir).select(*KEY, "class", L.family_label().alias("multiclass_label"))


@register("label_category_eda", WC + f"SELECT {KEYS}, class, {Q.eda_category()} AS attack_category FROM conn")
def q_label_category_eda(spark, sf_dir):
    return conn_view(spark, sf_dir).select(*KEY, "class", L.eda_category().alias("attack_category"))


@register("segment_seen_novel", WS + f"SELECT row_id, class, {Q.segment()} AS segment FROM scored")
def q_segment_seen_novel(spark, sf_dir):
    return scored_view(spark, sf_dir).select("row_id", "class", L.segment().alias("segment"))


@register("family_name", WC + f"""
SELECT {KEYS}, {Q.family_label()} AS multiclass_label, {Q.family_name(Q.family_label())} AS attack_family FROM conn""")
def q_family_name(spark, sf_dir):
    f = L.family_label()
    return conn_view(spark, sf_dir).select(*KEY, f.alias("multiclass_label"), L.family_name(f).alias("attack_family"))


@register("collapse_to_binary", WC + f"""
SELECT {KEYS}, CAST({Q.family_label()} <> 0 AS INTEGER) AS is_attack FROM conn""")
def q_collapse_to_binary(spark, sf_dir):
    return conn_view(spark, sf_dir).select(*KEY, (L.family_label() != 0).cast("int").alias("is_attack"))


# ---------------------------------------------------------------------------
# filters and predicates
# ---------------------------------------------------------------------------

@register("filter_equal", WS + "SELECT row_id, class, score FROM scored WHERE class = 'neptune'")
def q_filter_equal(spark, sf_dir):
    return scored_view(spark, sf_dir).where(F.col("class") == "neptune")


@register("filter_normal_only", WS + f"SELECT row_id, class, score FROM scored WHERE {Q.binary_label()} = 0")
def q_filter_normal_only(spark, sf_dir):
    return scored_view(spark, sf_dir).where(L.binary_label() == 0)


@register("filter_regex", WC + f"""
SELECT {KEYS}, service FROM conn WHERE regexp_matches(service, 'brand#1[0-9]$', 'i')""")
def q_filter_regex(spark, sf_dir):
    return conn_view(spark, sf_dir).where(F.col("service").rlike("(?i)brand#1[0-9]$")).select(*KEY, "service")


@register("filter_not_null", WS + """
SELECT row_id, t FROM (SELECT row_id, CASE WHEN class = 'normal' THEN NULL ELSE score END AS t FROM scored)
WHERE t IS NOT NULL""")
def q_filter_not_null(spark, sf_dir):
    s = scored_view(spark, sf_dir)
    t = F.when(F.col("class") == "normal", F.lit(None)).otherwise(F.col("score"))
    return s.select("row_id", t.alias("t")).where(F.col("t").isNotNull())


@register("threshold_predict", WS + "SELECT row_id, CAST(score >= 0.5 AS INTEGER) AS pred FROM scored")
def q_threshold_predict(spark, sf_dir):
    return scored_view(spark, sf_dir).select("row_id", (F.col("score") >= 0.5).cast("int").alias("pred"))


@register("outlier_to_label", WS + """
SELECT row_id, raw, CASE WHEN raw = -1 THEN 1 ELSE 0 END AS pred
FROM (SELECT row_id, CASE WHEN score >= 0.5 THEN -1 ELSE 1 END AS raw FROM scored)""")
def q_outlier_to_label(spark, sf_dir):
    raw = F.when(F.col("score") >= 0.5, -1).otherwise(1)
    s = scored_view(spark, sf_dir).select("row_id", raw.alias("raw"))
    return s.select("row_id", "raw", F.when(F.col("raw") == -1, 1).otherwise(0).alias("pred"))


@register("engineered_features", WC + f"""
SELECT {KEYS}, {Q.r6("src_bytes / (dst_bytes + 1)")} AS bytes_ratio,
       {Q.r6("serror_rate + rerror_rate")} AS error_index,
       {Q.r6("ln(src_bytes + 1) * logged_in")} AS payload_density FROM conn""")
def q_engineered_features(spark, sf_dir):
    c = conn_view(spark, sf_dir)
    return c.select(*KEY, r6(F.col("src_bytes") / (F.col("dst_bytes") + 1)).alias("bytes_ratio"),
                    r6(F.col("serror_rate") + F.col("rerror_rate")).alias("error_index"),
                    r6(F.log(F.col("src_bytes") + 1) * F.col("logged_in")).alias("payload_density"))


# ---------------------------------------------------------------------------
# scalar functions
# ---------------------------------------------------------------------------

@register("fn_string", WC + f"""
SELECT {KEYS}, trim(class) AS t, lower(trim(class)) AS lo, replace(lower(trim(class)), '_', ' ') AS sp,
       upper(class) AS up, CAST(duration AS VARCHAR) AS dur_s FROM conn""")
def q_fn_string(spark, sf_dir):
    c = conn_view(spark, sf_dir)
    lo = F.lower(F.trim("class"))
    return c.select(*KEY, F.trim("class").alias("t"), lo.alias("lo"), F.replace(lo, F.lit("_"), F.lit(" ")).alias("sp"),
                    F.upper("class").alias("up"), F.col("duration").cast("string").alias("dur_s"))


@register("fn_math", WC + f"""
SELECT {KEYS}, {Q.r6("ln(1 + src_bytes)")} AS log1p_src, {Q.r6("abs(serror_rate - 0.05)")} AS abs_dev,
       {Q.r6("exp(-count_ / 10.0)")} AS decay, {Q.r6("round(src_bytes / dst_bytes, 4)")} AS ratio4,
       {Q.r6("greatest(least(serror_rate * 10, 0.5), 0.1)")} AS clamped FROM conn""")
def q_fn_math(spark, sf_dir):
    c = conn_view(spark, sf_dir)
    return c.select(*KEY, r6(F.log1p("src_bytes")).alias("log1p_src"), r6(F.abs(F.col("serror_rate") - 0.05)).alias("abs_dev"),
                    r6(F.exp(-F.col("count_") / 10.0)).alias("decay"),
                    r6(F.round(F.try_divide("src_bytes", "dst_bytes"), 4)).alias("ratio4"),
                    r6(F.greatest(F.least(F.col("serror_rate") * 10, F.lit(0.5)), F.lit(0.1))).alias("clamped"))


DIMS, LABELS = range(64), range(10)


@register("fn_softmax", f"""
SELECT vec_id, {", ".join(Q.r6(f"exp(e{i} - m) / s") + f" AS p{i}" for i in DIMS)}
FROM (SELECT *, {" + ".join(f"exp(e{i} - m)" for i in DIMS)} AS s
      FROM (SELECT *, greatest({", ".join(f"e{i}" for i in DIMS)}) AS m
            FROM (SELECT vec_id, {", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in DIMS)}
                  FROM embeddings)))""")
def q_fn_softmax(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", A.softmax(F.col("embedding")).alias("p"))
    return e.select("vec_id", *[r6(F.element_at("p", i + 1)).alias(f"p{i}") for i in DIMS])


@register("fn_argmax", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax FROM embeddings""")
def q_fn_argmax(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", A.argmax(F.col("embedding")).alias("argmax"))


@register("fn_onehot_array", f"""
SELECT vec_id, label AS cls, concat_ws(',', {", ".join(f"CASE WHEN label = {i} THEN 1 ELSE 0 END" for i in LABELS)}) AS onehot
FROM embeddings""")
def q_fn_onehot_array(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("cls"))
    oh = F.transform(A.onehot_array("cls", len(LABELS)), lambda x: x.cast("int").cast("string"))
    return e.select("vec_id", "cls", F.array_join(oh, ",").alias("onehot"))


@register("fn_isnull", WC + f"""
SELECT {KEYS}, (CASE WHEN hot > 0 THEN hot END) IS NULL AS hot_missing,
       isnan(CASE WHEN hot > 0 THEN hot ELSE 'NaN'::DOUBLE END) AS hot_nan FROM conn""")
def q_fn_isnull(spark, sf_dir):
    c = conn_view(spark, sf_dir)
    return c.select(*KEY, F.when(F.col("hot") > 0, F.col("hot")).isNull().alias("hot_missing"),
                    F.isnan(F.when(F.col("hot") > 0, F.col("hot")).otherwise(F.lit(float("nan")))).alias("hot_nan"))


@register("fn_format", WS + """
SELECT row_id, printf('%.2f', round(score * 100, 2)) AS score_pct FROM scored""")
def q_fn_format(spark, sf_dir):
    s = scored_view(spark, sf_dir)
    return s.select("row_id", F.format_string("%.2f", F.round(F.col("score") * 100, 2)).alias("score_pct"))


@register("fn_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       '{"event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":' || user_id || '}' AS record
FROM events""")
def q_fn_json(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.from_json("props", "k INT")["k"].alias("k"),
                    F.to_json(F.struct("event_id", "event_type", "user_id")).alias("record"))


@register("fn_map", WS + f"""
SELECT class, {Q.r6("avg(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END)")} AS recall_at_half
FROM scored GROUP BY class""")
def q_fn_map(spark, sf_dir):
    s = scored_view(spark, sf_dir)
    per = s.groupBy("class").agg(F.avg((F.col("score") >= 0.5).cast("double")).alias("r"))
    # per-class metric map (one entry per class: bounded), then read back by key
    m = per.agg(F.map_from_entries(F.collect_list(F.struct("class", "r"))).alias("m"))
    return m.select(F.explode("m").alias("class", "r")).select("class", r6("r").alias("recall_at_half"))


@register("fn_time")
def q_fn_time(spark, sf_dir):
    e = table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("n_rows"))
    return e.select("n_rows", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"))


# ---------------------------------------------------------------------------
# set operations
# ---------------------------------------------------------------------------

def _split_col(key="l_orderkey"):
    return md5_uniform(key) < F.lit(config.TRAIN_RATIO)


SPLIT_SQL = f"{Q.md5_uniform('l_orderkey')} < {config.TRAIN_RATIO}"


@register("novel_labels_except", WC + f"""
SELECT DISTINCT lower(trim(class)) AS label FROM conn WHERE NOT ({SPLIT_SQL})
EXCEPT SELECT DISTINCT lower(trim(class)) FROM conn WHERE {SPLIT_SQL} AND lower(trim(class)) <> 'mscan'""")
def q_novel_labels_except(spark, sf_dir):
    c = conn_view(spark, sf_dir).select(F.lower(F.trim("class")).alias("label"), _split_col().alias("is_train"))
    # distinct first: the set difference joins its sides by label, which would send all rows of a label to one task
    train = c.where("is_train AND label <> 'mscan'").select("label").distinct()
    hold = c.where("NOT is_train").select("label").distinct()
    return hold.subtract(train)


@register("intersect_labels", WC + f"""
SELECT DISTINCT lower(trim(class)) AS label FROM conn WHERE NOT ({SPLIT_SQL})
INTERSECT SELECT attack FROM (VALUES {", ".join(f"('{a}')" for a in config.SEEN_ATTACKS)}) s(attack)""")
def q_intersect_labels(spark, sf_dir):
    c = conn_view(spark, sf_dir).where(~_split_col()).select(F.lower(F.trim("class")).alias("label")).distinct()
    return c.intersect(J.seen_table(spark).withColumnRenamed("attack", "label"))


@register("distinct_dedup", WC + "SELECT DISTINCT protocol_type, service, flag FROM conn")
def q_distinct_dedup(spark, sf_dir):
    return conn_view(spark, sf_dir).dropDuplicates(["protocol_type", "service", "flag"]).select(
        "protocol_type", "service", "flag")


_SCALARS = ["protocol_type", "service", "flag", "duration", "src_bytes", "dst_bytes", "hot",
            "serror_rate", "rerror_rate", "logged_in", "num_outbound_cmds", "class"]


@register("columns_except", WC + f"""
, n AS (SELECT {", ".join(f"count({c}) AS {c}" for c in _SCALARS)} FROM conn),
filled AS (SELECT name FROM (UNPIVOT n ON COLUMNS(*) INTO NAME name VALUE k) WHERE k > 0)
SELECT e.pos, e.name FROM (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(config.RAW_COLUMNS))}) e(pos, name)
WHERE e.name NOT IN (SELECT name FROM filled)""")
def q_columns_except(spark, sf_dir):
    # the columns of the raw record that no row of the table fills
    c = conn_view(spark, sf_dir)
    counts = c.agg(*[F.count(n).alias(n) for n in _SCALARS])
    filled = counts.unpivot([], _SCALARS, "name", "k").where("k > 0").select("name")
    expected = J.names_table(spark, config.RAW_COLUMNS)
    return expected.join(filled, "name", "left_anti").select("pos", "name")


# ---------------------------------------------------------------------------
# joins
# ---------------------------------------------------------------------------

@register("join_lookup_broadcast", WC + f"""
SELECT {KEYS}, class, COALESCE(m.family, 3) AS family
FROM conn LEFT JOIN (VALUES {", ".join(f"('{k}', {v})" for k, v in config.ATTACK_FAMILY.items())}) m(name, family)
  ON lower(trim(conn.class)) = m.name""")
def q_join_lookup_broadcast(spark, sf_dir):
    c = conn_view(spark, sf_dir).select(*KEY, "class")
    m = J.mapping_table(spark, config.ATTACK_FAMILY, "name", "family")
    return J.join_lookup_broadcast(c, m, lambda k: F.lower(F.trim(F.col("class"))) == k, "name", "family",
                                   "family", config.UNKNOWN_FAMILY)


@register("join_semi_seen", WC + f"""
SELECT {KEYS}, class FROM conn WHERE lower(trim(class)) IN ({Q.seen_list()})""")
def q_join_semi_seen(spark, sf_dir):
    return J.semi_seen(conn_view(spark, sf_dir).select(*KEY, "class"))


@register("join_anti_novel", WC + f"""
SELECT {KEYS}, class FROM conn WHERE lower(trim(class)) <> 'normal'
  AND lower(trim(class)) NOT IN ({Q.seen_list()})""")
def q_join_anti_novel(spark, sf_dir):
    return J.anti_novel(conn_view(spark, sf_dir).select(*KEY, "class"))


@register("join_rows_by_key", WS + """
SELECT s.row_id, s.class, s.score, e.user_id, e.ts FROM scored s JOIN events e ON s.row_id = e.event_id""")
def q_join_rows_by_key(spark, sf_dir):
    s = scored_view(spark, sf_dir)
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return s.join(e, s.row_id == e.event_id).select("row_id", "class", "score", "user_id", "ts")


@register("join_class_weight", f"""
SELECT l.doc_id, l.toxic, {Q.r6("w.weight")} AS weight
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
JOIN (SELECT toxic, (SELECT count(*) FROM labels l2 JOIN documents d2 ON l2.doc_id = d2.doc_id) * 1.0
             / (count(*) OVER () * count(*)) AS weight
      FROM labels l3 JOIN documents d3 ON l3.doc_id = d3.doc_id GROUP BY toxic) w ON l.toxic = w.toxic""")
def q_join_class_weight(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    out = J.join_class_weight(lab.select("doc_id", "toxic"), "toxic")
    return out.select("doc_id", "toxic", r6("weight").alias("weight"))


DIFF_SQL = """j AS (SELECT COALESCE(e.pos, a.pos) AS pos, e.pos AS ep, a.pos AS ap, e.name AS en, a.name AS an,
             e.name <> a.name AS mism FROM e FULL OUTER JOIN a ON e.pos = a.pos),
fm AS (SELECT min(pos) FILTER (WHERE mism) AS p FROM j)
SELECT CAST(count(ep) AS BIGINT) AS expected_count, CAST(count(ap) AS BIGINT) AS actual_count,
       CASE WHEN max(fm.p) IS NOT NULL THEN 'DEVIATION_DETECTED'
            WHEN count(ep) <> count(ap) THEN 'INCOMPATIBLE' ELSE 'COMPATIBLE' END AS status,
       max(fm.p) AS first_mismatch_pos, max(en) FILTER (WHERE pos = fm.p) AS expected_name,
       max(an) FILTER (WHERE pos = fm.p) AS actual_name
FROM j, fm"""  # of the name lists e (expected) and a (actual)


@register("manifest_diff", WC + """
, cats AS (SELECT flag, count(*) AS n FROM conn GROUP BY flag),
e AS (SELECT CAST(row_number() OVER (ORDER BY flag) - 1 AS INTEGER) AS pos, 'cat__flag_' || flag AS name FROM cats),
a AS (SELECT CAST(row_number() OVER (ORDER BY n DESC, flag) - 1 AS INTEGER) AS pos, 'cat__flag_' || flag AS name
      FROM cats),
""" + DIFF_SQL)
def q_manifest_diff(spark, sf_dir):
    # the manifests are derived from the data: expected = sorted flag categories, actual = the
    # same list re-ordered by frequency, so the first deviation is data-dependent
    c = conn_view(spark, sf_dir)
    cats = c.groupBy("flag").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    exp = cats.select((F.row_number().over(Window.orderBy("flag")) - 1).cast("int").alias("pos"),
                      F.concat(F.lit("cat__flag_"), "flag").alias("name"))
    act = cats.select((F.row_number().over(Window.orderBy(F.col("n").desc(), "flag")) - 1).cast("int").alias("pos"),
                      F.concat(F.lit("cat__flag_"), "flag").alias("name"))
    return J.manifest_diff(exp, act)
