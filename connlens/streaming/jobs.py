"""Structured Streaming jobs over a file source of connection events.

Sources are file streams over the table's own path (a file or a folder) with an
explicit schema (never inferred).  Sinks write through ``foreachBatch`` into one
folder per micro-batch id, with overwrite, so a retried batch replaces its own rows;
the query's checkpoint lies beside them.  A caller that passes ``root`` can restart
the query there and it resumes after the last committed batch.  Nothing is collected
on the driver: the memory sink is not used.

Operators
  tumbling / sliding windows     withWatermark + window()           update, each window's last emission counts
  sessions                       session_window()                   append, a session once it is over
  dedup                          dropDuplicatesWithinWatermark      append
  bursts                         session_window()                   append, a burst's first row once it is over
  late-data policy               rows behind Spark's own watermark, from the queries' progress and observed metrics
  scoring / rejects              stateless projection; two sinks per micro-batch
  alert rollup                   stateful groupBy over a bounded key space (families)
  last-N per key                 applyInPandasWithState, list state capped at N
  last-N host features           batch windows per micro-batch, last N-1 rows per host kept between them
  drift monitor                  windowed aggregate joined to a static baseline   update
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from connlens.operators.traffic import host_features
from connlens.session import checkpoint_dir, materialize


def event_stream(spark: SparkSession, sf_dir: str, name: str = "events", max_files: int | None = None) -> DataFrame:
    """File stream over one table's parquet file(s) with the batch schema; ``ts`` as
    TIMESTAMP (watermarks need a zone-aware timestamp)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    s = r.parquet(f"{sf_dir.rstrip('/')}/{{{name}}}.parquet")  # as a pattern it may name a file or a folder
    if "ts" in s.columns:
        s = s.withColumn("ts", F.col("ts").cast("timestamp"))
    return s


def _run_dir(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def write_batch(rows: DataFrame, folder: str, epoch: int) -> None:
    """Write a micro-batch's rows under its id; a retry replaces them."""
    rows.write.mode("overwrite").parquet(f"{folder}/batch={epoch}")


def run_to_table(stream: DataFrame, name: str, mode: str = "append",
                 per_batch: Callable[[DataFrame, int, str], None] | None = None,
                 root: str | None = None) -> tuple[DataFrame, dict]:
    """Run ``stream`` with Trigger.AvailableNow into parquet; return (result, stats).

    The result has the sink's rows with their ``batch`` id: all batches' rows in
    'append' and 'update' mode, those of the last batch in 'complete' mode.  ``root``
    holds the sink and the checkpoint; pass an earlier one to resume."""
    spark = stream.sparkSession
    root = root or _run_dir(spark, name)
    out = os.path.join(root, "out")

    def sink(batch: DataFrame, epoch: int) -> None:
        if per_batch is not None:
            per_batch(batch, epoch, root)
        else:
            write_batch(batch, out, epoch)

    q = (stream.writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", os.path.join(root, "checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    progress = q.recentProgress
    stats = {
        "input_rows": sum(p.get("numInputRows", 0) for p in progress),
        "dropped_by_watermark": sum(sum(s.get("numRowsDroppedByWatermark", 0) for s in p.get("stateOperators", []))
                                    for p in progress),
        "batches": len(progress),
        "progress": [_progress(p) for p in progress],
        "root": root,
    }
    found = read_if_exists(spark, out) if per_batch is None else None
    if found is not None and mode == "complete":
        found = found.where(F.col("batch") == found.agg(F.max("batch")).scalar())
    return found, stats


def run_until_closed(events: DataFrame, newest: DataFrame, job: Callable[[DataFrame], DataFrame], name: str, gap: str,
                     delay: str) -> tuple[DataFrame, dict]:
    """Run the append-mode ``job`` over ``events``, then end the stream: the query resumes from its checkpoint and reads
    one row of nulls later than the ``newest`` time (a table of one ``ts``) by ``gap`` and ``delay``.  The watermark then
    passes the end of every window of the events, so that those open when the data ended come out too."""
    spark = events.sparkSession
    root = _run_dir(spark, name)
    ends = os.path.join(root, "end")
    spark.createDataFrame([], events.schema).write.parquet(ends)
    whole = events.unionByName(spark.readStream.schema(events.schema).parquet(ends))
    run_to_table(job(whole), name, root=root)
    end = newest.where("ts IS NOT NULL").select(
        *[(F.col("ts").cast("timestamp") + F.expr(f"INTERVAL {gap}") + F.expr(f"INTERVAL {delay}") + F.expr("INTERVAL 1 second")).alias("ts")
          if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema.fields])
    end.write.mode("append").parquet(ends)
    return run_to_table(job(whole), name, root=root)


def _progress(p) -> dict:
    """Of a micro-batch: its id, rows read, rows behind the watermark, rows in the state, and observed metrics."""
    operators = p.get("stateOperators", [])
    return {"batch": p.get("batchId"), "input": p.get("numInputRows", 0), "late": sum(o.get("numRowsDroppedByWatermark", 0) for o in operators),
            "state": sum(o.get("numRowsTotal", 0) for o in operators), "observed": {k: dict(v if isinstance(v, dict) else v.asDict()) for k, v in p.get("observedMetrics", {}).items()}}


def last_emissions(emitted: DataFrame, keys: list[str]) -> DataFrame:
    """Of an update-mode sink's rows, each key's last one (one row a key and micro-batch)."""
    rest = F.struct(*[c for c in emitted.columns if c not in keys])
    return emitted.groupBy(*keys).agg(F.max_by(rest, "batch").alias("_e")).select(*keys, "_e.*").drop("batch")


def read_if_exists(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame | None:
    """Parquet (or another ``kind``) at ``path`` (any Hadoop filesystem), or None if nothing was written."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.format(kind).load(path) if fs.exists(p) else None


# ---------------------------------------------------------------------------
# windowed aggregations
# ---------------------------------------------------------------------------

def tumbling_counts(events: DataFrame, key: str, width: str, delay: str, error: Column) -> DataFrame:
    return (events.withWatermark("ts", delay)
            .groupBy(F.window("ts", width).alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(error.cast("int")).alias("errors"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key,
                    F.col("n").cast("long").alias("n"), F.col("errors").cast("long").alias("errors")))


def sliding_counts(events: DataFrame, key: str, width: str, slide: str, delay: str, error: Column) -> DataFrame:
    return (events.withWatermark("ts", delay)
            .groupBy(F.window("ts", width, slide).alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n"), F.avg(error.cast("double")).alias("error_rate"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key,
                    F.col("n").cast("long").alias("n"), "error_rate"))


def sessions(events: DataFrame, key: str, gap: str, delay: str) -> DataFrame:
    return (events.withWatermark("ts", delay)
            .groupBy(F.session_window("ts", gap).alias("s"), key)
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value"))
            .select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    F.col("n_events").cast("long").alias("n_events"), "total_value"))


def dedup(events: DataFrame, keys: list[str], delay: str) -> DataFrame:
    """Each key's first row, repeats dropped that come within ``delay`` of it in event time (append).  A key leaves the
    state when the watermark has passed its first row by ``delay``."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)


def burst_firsts(events: DataFrame, keys: list[str], gap: str) -> DataFrame:
    """Of rows with the same ``keys`` that follow each other less than ``gap`` apart, the first by (ts, event_id), once
    its burst is over (append; ``events`` carry their watermark)."""
    firsts = events.groupBy(F.session_window("ts", gap).alias("s"), *keys).agg(F.min(F.struct("ts", "event_id")).alias("first"))
    return firsts.select("first.*", *keys)


def late_counts(events: DataFrame, key: str, delay: str) -> DataFrame:
    """Distinct rows by ``key``; what comes behind Spark's watermark is dropped and counted by its late-row metric, what
    stays by the observed metric ``accepted``."""
    kept = events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])
    return kept.observe("accepted", F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# stateful last-N per key (bounded list state, one typed array per column)
# ---------------------------------------------------------------------------

#: How far rows may come behind the newest event, and how long a key without rows keeps its state.
IDLE_DAYS = 60


def _expire(state: GroupState, newest: pd.Timestamp, idle_days: int) -> None:
    due = int((newest + pd.Timedelta(days=idle_days)).timestamp() * 1000)
    state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))


def _state_schema(events: DataFrame, cols: list[str]) -> str:
    return ", ".join(f"{c} array<{'long' if t == 'timestamp' else t}>" for c, t in _types(events, cols))


def _saved(frame: pd.DataFrame, cols: list[str]) -> tuple:
    return tuple((frame[c].astype("datetime64[us]").astype("int64") if c == "ts" else frame[c]).tolist() for c in cols)


def _loaded(state: GroupState, like: pd.DataFrame, cols: list[str]) -> pd.DataFrame:
    """The rows in the state, with the column types of the new rows."""
    if not state.exists:
        return like.iloc[0:0]
    columns = {c: pd.Series(list(v)) for c, v in zip(cols, state.get)}
    columns["ts"] = columns["ts"].astype("int64").astype("datetime64[us]")
    return pd.DataFrame({c: columns[c].astype(like[c].dtype) for c in cols})


def last_n_per_key(events: DataFrame, key: str, n: int, value_cols: list[str], idle_days: int = IDLE_DAYS) -> DataFrame:
    """The latest ``n`` rows per key by (ts, event_id).  The state per key holds at most
    ``n`` rows; every micro-batch emits the current last-n of the keys it touched
    (``latest_per_key`` keeps the last emission).  Each chunk of a key's new rows is cut
    to ``n`` as it arrives, so a hot key never has all its rows in memory."""
    cols = ["event_id", "ts", *value_cols]
    out_schema = ", ".join([f"{key} long, rank int, event_id long, ts timestamp", *[f"{c} {t}" for c, t in _types(events, value_cols)]])

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = None
        for new in pdfs:
            held = _loaded(state, new[cols], cols) if held is None else held
            held = pd.concat([held, new[cols]], ignore_index=True).sort_values(["ts", "event_id"]).tail(n)
        state.update(_saved(held, cols))
        _expire(state, held["ts"].max(), idle_days)
        out = held.iloc[::-1].reset_index(drop=True)
        out.insert(0, "rank", range(1, len(out) + 1))
        out.insert(0, key, k[0])
        yield out

    late = events.withWatermark("ts", f"{idle_days} days")
    return late.groupBy(key).applyInPandasWithState(fn, out_schema, _state_schema(events, cols), "update",
                                                    GroupStateTimeout.EventTimeTimeout)


def latest_per_key(emitted: DataFrame, key: str) -> DataFrame:
    """Of an update-mode sink's rows, those of each key's last micro-batch."""
    last = emitted.groupBy(F.col(key).alias("_key")).agg(F.max("batch").alias("_last"))
    return emitted.join(last, F.col(key).eqNullSafe(F.col("_key")) & (F.col("batch") == F.col("_last"))).drop("_key", "_last")


def host_window_online(dest: str, service: str, src_host: str, src_port: str, n: int, serror: str, rerror: str,
                       idle_days: int = IDLE_DAYS) -> Callable[[DataFrame, int, str], None]:
    """Online last-N destination features (the ten of ``traffic_host_window``), as a ``per_batch`` of ``run_to_table``:
    per destination the previous n-1 connections are kept from batch to batch (folder ``state``, of which the two last
    batches' stay, so that a retried batch finds its predecessor's); each new connection is scored against them in
    arrival order, those of one batch by (ts, event_id).  Ranks come from (destination, hour) partitions and sums
    from blocks of n ranks, so no task holds all rows of a hot destination.  Rows over ``idle_days`` behind the
    newest event of earlier batches are dropped; a destination without rows for so long again loses its state."""
    cols = [dest, "event_id", "ts", service, src_host, src_port, serror, rerror]
    idle = F.expr(f"INTERVAL {int(idle_days)} DAYS")

    def per_batch(batch: DataFrame, epoch: int, root: str) -> None:
        spark = batch.sparkSession
        prev = read_if_exists(spark, f"{root}/state/batch={epoch - 1}")
        new = batch.select(*cols)
        mark = prev.agg(F.max("_newest")).first()[0] if prev is not None else None
        if mark is not None:
            new = new.where(F.col("ts").isNull() | (F.col("ts") > F.lit(mark) - idle))
        hour = F.floor(F.unix_micros("ts") / 3_600_000_000)
        new = new.withColumn("_h", hour).withColumn("_local", F.row_number().over(Window.partitionBy(dest, "_h").orderBy("ts", "event_id")))
        per = new.groupBy(dest, "_h").agg(F.count(F.lit(1)).alias("_n"), F.max("ts").alias("_last"))
        if prev is not None:  # a destination's state counts as one more hour, without ranks above 0
            held = prev.groupBy(dest).agg(F.lit(None).cast("long").alias("_h"), F.lit(0).cast("long").alias("_n"), F.max("_newest").alias("_last"))
            per = per.unionByName(held.withColumn("_held", F.lit(1)), allowMissingColumns=True)
        else:
            per = per.withColumn("_held", F.lit(None).cast("int"))
        earlier = Window.partitionBy(dest).orderBy(F.col("_held").desc_nulls_last(), F.col("_h").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
        all_of = Window.partitionBy(dest)
        per = per.select(F.col(dest).alias("_dest"), F.col("_h").alias("_hour"), "_held", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"),
                         F.sum("_n").over(all_of).alias("_total"), F.max("_last").over(all_of).alias("_newest"))
        own = F.col(dest).eqNullSafe(F.col("_dest"))
        rows = new.join(per.where(F.col("_held").isNull()), own & F.col("_h").eqNullSafe(F.col("_hour")))
        rows = rows.select(*cols, (F.col("_local") + F.col("_off")).cast("long").alias("_rank"), "_total", "_newest")
        if prev is not None:
            rows = rows.unionByName(prev.drop("_newest").join(per.where(F.col("_held") == 1), own).select(*cols, "_rank", "_total", "_newest"))
        rows = materialize(rows, "ranked-connections")  # read by the features and by the next state
        features = host_features(rows, "event_id", dest, service, src_host, src_port, F.col(serror), F.col(rerror), n)
        write_batch(features.join(rows.where("_rank > 0").select("event_id"), "event_id", "left_semi"), os.path.join(root, "out"), epoch)
        last = rows.where(F.col("_rank") > F.col("_total") - (n - 1)).withColumn("_rank", F.col("_rank") - F.col("_total"))
        if mark is not None:
            last = last.where(F.col("_newest") + idle > F.lit(mark) - idle)
        write_batch(last.drop("_total"), os.path.join(root, "state"), epoch)
        _delete(spark, f"{root}/state/batch={epoch - 2}")

    return per_batch


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


# ---------------------------------------------------------------------------
# scoring with a model that changes between micro-batches
# ---------------------------------------------------------------------------

def publish_model(model, root: str, version: str) -> None:
    """Save a fitted PipelineModel as ``version`` below ``root`` and point to it (the pointer is written last)."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{root}/versions/{version}")
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("append").text(f"{root}/pointer/{int(time.time() * 1000):015d}")


def current_version(spark: SparkSession, root: str) -> str:
    """The version that was published last."""
    found = spark.read.text(f"{root}/pointer/*").select("value", F.input_file_name().alias("f"))
    return found.agg(F.max_by("value", "f")).first()[0]  # one row a publication


def score_online(models: str, parse: Callable[[DataFrame], DataFrame], score: Callable[[DataFrame, object], DataFrame],
                 reject: str = "NOT valid") -> Callable[[DataFrame, int, str], None]:
    """Scoring as a ``per_batch`` of ``run_to_table``: each micro-batch is parsed, its rejects go to their own sink, and the
    rest are scored by the model that is current when the batch first runs.  The version is kept under the batch's id
    before anything else is written, so a batch that runs again uses the same model; rows carry it."""
    from pyspark.ml import PipelineModel

    held: dict = {}

    def per_batch(batch: DataFrame, epoch: int, root: str) -> None:
        spark = batch.sparkSession
        chosen = read_if_exists(spark, f"{root}/version/batch={epoch}")
        version = chosen.first()["version"] if chosen is not None else current_version(spark, models)
        if chosen is None:
            write_batch(spark.createDataFrame([(version,)], "version string").coalesce(1), f"{root}/version", epoch)
        if held.get("version") != version:
            held.update(version=version, model=PipelineModel.load(f"{models}/versions/{version}"))
        rows = parse(batch)
        write_batch(rows.where(reject).withColumn("model_version", F.lit(version)), f"{root}/rejects", epoch)
        write_batch(score(rows.where(f"NOT ({reject})"), held["model"]).withColumn("model_version", F.lit(version)), f"{root}/out", epoch)

    return per_batch


def _types(df: DataFrame, cols: list[str]):
    return [(c, df.schema[c].dataType.simpleString()) for c in cols]
