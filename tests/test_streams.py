"""Every streaming query over a table stored as several files, one file a micro-batch:
the result must equal the batch SQL, however the rows fall into batches."""

import functools
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from connlens.plans import stream_queries
from connlens.streaming import jobs
from tools.check_oracle import norm

SF = "/root/testdata/sf0.001"
STREAMS = ["stream_tumbling", "stream_sliding", "stream_session", "stream_dedup", "stream_late", "stream_score", "stream_rejects",
           "stream_alert_rollup", "stream_recent", "stream_host_window", "drift_monitor", "foreach_report"]


@pytest.fixture(scope="module")
def replay(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("replay")
    events = spark.read.parquet(f"{SF}/events.parquet")
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    thirds = [lo + (hi - lo) * k / 3 for k in (1, 2)]
    parts = [F.col("ts") < F.lit(thirds[0]), (F.col("ts") >= F.lit(thirds[0])) & (F.col("ts") < F.lit(thirds[1])), F.col("ts") >= F.lit(thirds[1])]
    for part in parts:
        events.where(part).coalesce(1).write.mode("append").parquet(str(root / "events.parquet"))
    return str(root)


@pytest.mark.parametrize("name", STREAMS)
def test_batches_do_not_change_the_result(spark, replay, monkeypatch, name):
    monkeypatch.setattr(stream_queries.S, "event_stream", functools.partial(jobs.event_stream, max_files=1))
    df = E.queries()[name](spark, replay)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{replay}/events.parquet/*.parquet')")
    res = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    want = Counter(tuple(norm(r[names.index(c)]) for c in sorted(names)) for r in res.fetchall())
    got = Counter(tuple(norm(r[c]) for c in sorted(names)) for r in df.collect())
    assert sorted(df.columns) == sorted(names) and got == want


def test_run_resumes_from_its_checkpoint(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "run")
    schema = "event_id long, ts timestamp, user_id long"
    for k in range(2):
        spark.range(10 * k, 10 * k + 10).select(F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), (F.col("id") % 2).alias("user_id")).write.mode("append").parquet(source)
        out, _ = jobs.run_to_table(jobs.last_n_per_key(spark.readStream.schema(schema).parquet(source), "user_id", 3, []), "resume", "update", root=root)
    last = jobs.latest_per_key(out, "user_id")
    assert sorted((r.user_id, r["rank"], r.event_id) for r in last.collect()) == [(0, 1, 18), (0, 2, 16), (0, 3, 14), (1, 1, 19), (1, 2, 17), (1, 3, 15)]


def test_text_columns_keep_their_type_in_state(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = "event_id long, ts timestamp, user_id long, port string"
    root = str(tmp_path / "run")
    for k in range(2):
        spark.range(5 * k, 5 * k + 5).select(F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), F.lit(1).cast("long").alias("user_id"), F.lit("080").alias("port")).write.mode("append").parquet(source)
        out, _ = jobs.run_to_table(jobs.last_n_per_key(spark.readStream.schema(schema).parquet(source), "user_id", 7, ["port"]), "text", "update", root=root)
    assert {r.port for r in jobs.latest_per_key(out, "user_id").collect()} == {"080"}


def _hours(spark, source, batches):
    """One file a micro-batch of (event_id, hour)."""
    schema = "event_id long, ts timestamp"
    for rows in batches:
        df = spark.createDataFrame(rows, "event_id long, h double").select("event_id", F.timestamp_seconds(F.col("h") * 3600 + 999_997_200).alias("ts"))
        df.coalesce(1).write.mode("append").parquet(source)
        yield spark.readStream.schema(schema).parquet(source)


def test_dedup_state_falls_behind_the_watermark(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "run")
    batches = [[(k, 0.0) for k in range(100)] + [(5, 0.1)], [(7, 0.5), (200, 0.6), (None, 0.6), (None, 0.7)], [(300, 9.0)], [(8, 8.9), (9, 1.0)], []]
    states, late = [], []
    for stream in _hours(spark, source, batches):
        out, stats = jobs.run_to_table(jobs.dedup(stream, ["event_id"], "1 hour"), "dedup", root=root)
        states += [p["state"] for p in stats["progress"]]
        late += [p["late"] for p in stats["progress"]]
    got = Counter(r.event_id for r in out.collect())
    # 8 comes again after its state has gone, 9 behind the watermark
    assert got == Counter([*range(100), 200, None, 300, 8])
    assert max(states) >= 102 and states[-1] <= 2 and sum(late) == 1


def test_late_rows_are_counted_where_spark_drops_them(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "run")
    seen = []
    for stream in _hours(spark, source, [[(1, 10.0), (2, 0.0)], [(3, 9.99), (4, 5.0), (5, 1.0), (6, 12.0)], [(7, 11.0)]]):
        _, stats = jobs.run_to_table(jobs.late_counts(stream, "event_id", "10 minutes"), "late", root=root)
        seen += [(p["input"], p["observed"]["accepted"]["n"], p["late"]) for p in stats["progress"] if p["input"]]
    assert seen == [(2, 2, 0), (4, 2, 2), (1, 0, 1)]


@pytest.mark.parametrize("kind", ["tumbling", "sessions"])
def test_window_state_is_bounded_by_the_watermark(spark, tmp_path, kind):
    source, root = str(tmp_path / "in"), str(tmp_path / "run")
    states = []
    for stream in _hours(spark, source, [[(k, 24.0 * d + k / 10) for k in range(20)] for d in range(6)]):
        keyed = stream.withColumn("key", F.lit(1)).withColumn("value", F.lit(1.0))
        if kind == "tumbling":
            out, stats = jobs.run_to_table(jobs.tumbling_counts(keyed, "key", "1 hour", "1 hour", F.lit(False)), kind, mode="update", root=root)
        else:
            out, stats = jobs.run_to_table(jobs.sessions(keyed, "key", "30 minutes", "1 hour"), kind, root=root)
        states.append(stats["progress"][-1]["state"])
    assert max(states) <= 2
    if kind == "tumbling":
        rows = jobs.last_emissions(out, ["window_start", "window_end", "key"]).collect()
        assert len(rows) == 12 and {r["n"] for r in rows} == {10}
    else:
        assert [r["n_events"] for r in out.collect()] == [20] * 5  # the sixth is still open


def test_sessions_open_at_the_end_of_the_data_come_out(spark):
    got = E.queries()["stream_session"](spark, SF)
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert got.agg(F.sum("n_events")).first()[0] == events.count()
    assert got.agg(F.max("session_end")).first()[0] == events.agg(F.max("ts") + F.expr("INTERVAL 30 MINUTES")).first()[0]


def test_repeats_within_the_hour_are_dropped(spark, tmp_path):
    rows = [(1, 0, 1, "a"), (2, 50, 1, "a"), (3, 109, 1, "a"), (4, 170, 1, "a"), (5, 10, 1, "b"), (6, 10, 2, "a"), (7, 10, 2, "a"), (None, 300, 3, "a"), (None, 300, 4, "a")]
    df = spark.createDataFrame(rows, "event_id long, m int, user_id long, event_type string").withColumn("ts", F.timestamp_seconds(F.col("m") * 60 + 999_997_200))
    df.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", F.lit(1.0).alias("value"), F.lit("{}").alias("props")).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = [(r.event_id, r.user_id) for r in E.queries()["stream_dedup"](spark, str(tmp_path)).collect()]
    assert Counter(got) == Counter([(1, 1), (4, 1), (5, 1), (6, 2), (None, 3), (None, 4)])
