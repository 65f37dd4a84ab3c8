"""Traffic-window features (the NSL-KDD "time-based" and "host-based" families).

A plain ``Window.partitionBy(service)`` would put every connection of a popular
service into one task.  Both operators bound their window partitions instead:

* time window [ts - T, ts], few rows in any T: it is what the row's stretch of length T
  holds up to ts and what the stretch before holds from ts - T on.  A window partition
  holds one key's traffic in one stretch.
* time window [ts - T, ts], many rows: time is cut into slices much shorter than T.  Every row
  asks for two running totals of its key, up to ts and up to just before ts - T; each
  is the total of the earlier slices (prefix sums of the slice table) plus a running
  sum inside one slice.  A window partition holds one key's traffic in one slice.
* last-N window: every row gets its rank within the destination (computed per
  (destination, coarse time bucket) plus the prefix of earlier buckets), rows are
  grouped into blocks of N ranks, each row also emitted once as a *ghost* into the next
  block, and windows run over RANGE of ranks.  Partition size <= 2N rows.  Distinct
  counts come from the rank of a value's previous occurrence: a row counts from the
  rank at which that occurrence has left the window until it leaves itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from connlens.functions.core import r6, safe_div


def _ghosted(df: DataFrame, bucket: Column) -> DataFrame:
    real = df.withColumn("_b", bucket.cast("long")).withColumn("_ghost", F.lit(False))
    ghost = real.withColumn("_b", F.col("_b") + 1).withColumn("_ghost", F.lit(True))
    return real.unionByName(ghost)


NO_TIME = -(2**60)      # rows without a time are peers of one another
STRETCH_ROWS = 2048   # rows of all keys in a stretch of the window's length that windows run over undivided: with as many probes what Spark keeps of a partition in memory
SLICES_PER_BLOCK = 4096  # slices of a key whose prefix sums one task computes


def _named(*columns: Column) -> Column:
    """An unambiguous string of a key's columns; nulls have their own."""
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.concat_ws("|", *parts)


def time_window_totals(rows: DataFrame, keys: dict[str, list[str]], at: str, width: int, measures: Sequence[str],
                       row_id: str, slices: int = 64) -> DataFrame:
    """For each row (``row_id`` is unique) and each named key: the sums of the long columns ``measures`` over rows of
    the same key with ``at`` (long, any unit) in [at - width, at], as columns <key>_<measure>.

    Time slices are width / ``slices`` long.  One shuffle brings rows and the probes at the window's start to their
    (key, slice), one joins the prefix sums of the slice table, one adds up a row's totals."""
    length = max(1, width // slices)
    time = F.coalesce(F.col(at), F.lit(NO_TIME))
    asked = []
    for name, columns in keys.items():
        key = F.concat(F.lit(f"{name}="), _named(*[F.col(c) for c in columns]))
        for sign, when, order in ((1, time, 2 * time + 1), (-1, time - width, 2 * (time - width))):
            held = [(F.col(m).cast("long") if sign > 0 else F.lit(0).cast("long")).alias(m) for m in measures]
            asked.append(F.struct(F.lit(name).alias("_name"), key.alias("_key"), F.lit(sign).alias("_sign"),
                                  F.floor(when / length).cast("long").alias("_slice"), order.alias("_order"), *held))
    probes = rows.select(row_id, F.explode(F.array(*asked)).alias("a")).select(row_id, "a.*")
    inside = Window.partitionBy("_key", "_slice").orderBy("_order").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local = probes.select(row_id, "_name", "_key", "_sign", "_slice", *[F.sum(m).over(inside).alias(m) for m in measures])
    # the slice table: at most two rows a row and key, prefix-summed in blocks of slices
    table = probes.groupBy("_key", "_slice").agg(*[F.sum(m).alias(m) for m in measures]).withColumn("_block", F.floor(F.col("_slice") / SLICES_PER_BLOCK))
    before = Window.partitionBy("_key", "_block").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    blocks = table.groupBy("_key", "_block").agg(*[F.sum(m).alias(m) for m in measures])
    earlier = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_key", "_block", *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_far_{m}") for m in measures])
    prefix = (table.select("_key", "_slice", "_block", *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_near_{m}") for m in measures])
              .join(offsets, ["_key", "_block"]).drop("_block"))
    found = local.join(prefix, ["_key", "_slice"])
    return found.groupBy(row_id).agg(*[
        F.sum(F.when(F.col("_name") == name, F.col("_sign") * (F.col(m) + F.col(f"_near_{m}") + F.col(f"_far_{m}")))).alias(f"{name}_{m}")
        for name in keys for m in measures])


def time_stretch_totals(rows: DataFrame, keys: dict[str, list[str]], at: str, width: int, measures: Sequence[str], row_id: str) -> DataFrame:
    """What ``time_window_totals`` gives, by stretches of length ``width``: a row and its probe at the window's start lie
    in successive ones, so no prefix sums over stretches are needed, and every key is a window over the same two rows."""
    time = F.coalesce(F.col(at), F.lit(NO_TIME))
    stretch = ((time - F.pmod(time, F.lit(width).cast("long"))) / width).cast("long")
    asked = [F.struct(F.lit(True).alias("_own"), stretch.alias("_stretch"), (2 * time + 1).alias("_order"), *[F.col(m).cast("long").alias(m) for m in measures]),
             F.struct(F.lit(False).alias("_own"), (stretch - 1).alias("_stretch"), (2 * (time - width)).alias("_order"), *[F.lit(0).cast("long").alias(m) for m in measures])]
    names = sorted({c for columns in keys.values() for c in columns})
    out = rows.select(row_id, *names, F.explode(F.array(*asked)).alias("a")).select(row_id, *names, "a.*")
    for name, columns in keys.items():
        order = Window.partitionBy(*columns, "_stretch").orderBy("_order")
        upto = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        out = out.select("*", *[F.when(F.col("_own"), F.sum(m).over(upto)).otherwise(F.sum(m).over(whole) - F.sum(m).over(upto)).alias(f"{name}_{m}") for m in measures])
    return out.groupBy(row_id).agg(*[F.sum(f"{name}_{m}").alias(f"{name}_{m}") for name in keys for m in measures])


def most_rows_in_a_stretch(rows: DataFrame, at: str, width: int) -> int:
    """The largest number of rows, of whatever keys, in one stretch of length ``width``."""
    per = rows.groupBy(F.floor((F.col(at) - F.pmod(F.col(at), F.lit(width).cast("long"))) / width)).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.max("n")).first()[0] or 0


def traffic_time_window(events: DataFrame, row_id: str, ts: str, host: str, service: str,
                        serror: Column, rerror: Column, seconds: float, slices: int = 64, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """count, srv_count and the seven rate features over the last ``seconds``; by slices if more than ``stretch_rows``
    rows lie in one stretch of that length."""
    base = events.select(row_id, host, service, F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"), F.lit(1).cast("long").alias("count"),
                         F.coalesce(serror.cast("long"), F.lit(0)).alias("se"), F.coalesce(rerror.cast("long"), F.lit(0)).alias("re"))
    keys, width, measures = {"h": [host], "hs": [host, service], "s": [service]}, int(seconds * 1_000_000), ["count", "se", "re"]
    if most_rows_in_a_stretch(base, "_us", width) <= stretch_rows:
        j = time_stretch_totals(base, keys, "_us", width, measures, row_id)
    else:
        j = time_window_totals(base, keys, "_us", width, measures, row_id, slices)
    same = safe_div("hs_count", "h_count")
    return j.select(
        row_id, F.col("h_count").alias("count"), F.col("s_count").alias("srv_count"),
        r6(safe_div("h_se", "h_count")).alias("serror_rate"), r6(safe_div("s_se", "s_count")).alias("srv_serror_rate"),
        r6(safe_div("h_re", "h_count")).alias("rerror_rate"), r6(safe_div("s_re", "s_count")).alias("srv_rerror_rate"),
        r6(same).alias("same_srv_rate"), r6(F.lit(1.0) - same).alias("diff_srv_rate"),
        r6(F.lit(1.0) - safe_div("hs_count", "s_count")).alias("srv_diff_host_rate"))


def rank_within_key(df: DataFrame, key: str, ts_us: str, tiebreak: str, bucket_seconds: int = 3600) -> DataFrame:
    """1-based rank of each row within ``key`` by (ts, tiebreak).  Computed per
    (key, coarse time bucket) plus the count of the key's earlier buckets, so no task
    holds all rows of a key."""
    span = int(bucket_seconds) * 1_000_000
    d = df.withColumn("_tb", F.floor(F.col(ts_us) / span))
    local = d.withColumn("_lr", F.row_number().over(Window.partitionBy(key, "_tb").orderBy(ts_us, tiebreak)))
    per = d.groupBy(key, "_tb").agg(F.count(F.lit(1)).alias("_n"))
    # one row per (key, bucket): the window below runs over the bucket table
    off = per.select(key, "_tb", F.coalesce(F.sum("_n").over(
        Window.partitionBy(key).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    off = off.select(F.col(key).alias("_k"), F.col("_tb").alias("_t"), "_off")
    found = local.join(off, F.col(key).eqNullSafe(F.col("_k")) & F.col("_tb").eqNullSafe(F.col("_t")))
    return found.withColumn("_rank", F.col("_lr") + F.col("_off")).drop("_tb", "_lr", "_off", "_k", "_t")


def last_n_sums(df: DataFrame, keys: Sequence[str], rank: str, n: int, measures: dict[str, Column],
                prefix: str) -> DataFrame:
    """count and sums over rows of the same ``keys`` whose ``rank`` lies in (rank - n, rank]."""
    g = _ghosted(df, F.floor((F.col(rank) - 1) / n))
    w = Window.partitionBy(*keys, "_b").orderBy(F.col(rank)).rangeBetween(-(n - 1), 0)
    out = g.select("*", F.count(F.lit(1)).over(w).alias(f"{prefix}count"),
                   *[F.sum(m).over(w).alias(f"{prefix}{k}") for k, m in measures.items()])
    return out.where(~F.col("_ghost")).drop("_b", "_ghost")


def last_n_distinct(df: DataFrame, keys: Sequence[str], value: str, row_id: str, rank: str, n: int, name: str) -> DataFrame:
    """(row_id, name): distinct values, null being one, among rows of the same ``keys`` whose rank lies in (rank - n, rank].

    A row counts in the windows that end at a rank from ``since`` (its own, or n past its value's previous one) to its
    own + n - 1; so a running sum of +1 at ``since`` and -1 at own + n, in blocks of n ranks, gives the count."""
    block = F.floor((F.col(rank) - 1) / n)
    same = _ghosted(df.select(*keys, value, row_id, rank), block)
    back = Window.partitionBy(*keys, value, "_b").orderBy(F.col(rank)).rangeBetween(-(n - 1), -1)
    known = same.withColumn("_before", F.max(rank).over(back)).where(~F.col("_ghost")).drop("_b", "_ghost")
    since = F.coalesce(F.col("_before") + n, F.col(rank))
    marks = F.array(F.struct(since.alias("at"), F.lit(1).alias("d"), F.lit(False).alias("asks")),
                    F.struct((F.col(rank) + n).alias("at"), F.lit(-1).alias("d"), F.lit(False).alias("asks")),
                    F.struct(F.col(rank).alias("at"), F.lit(0).alias("d"), F.lit(True).alias("asks")))
    events = _ghosted(known, block).select(*keys, row_id, "_b", "_ghost", F.explode(marks).alias("e"))
    running = Window.partitionBy(*keys, "_b").orderBy("e.at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = events.select(row_id, "_ghost", "e.asks", F.sum("e.d").over(running).alias(name))
    return counted.where(F.col("asks") & ~F.col("_ghost")).select(row_id, name)


def traffic_host_window(events: DataFrame, row_id: str, ts: str, dest: str, service: str, src_host: str, src_port: str,
                        serror: Column, rerror: Column, n: int = 100, bucket_seconds: int = 3600) -> DataFrame:
    """The ten dst_host_* features over the last ``n`` connections to the same destination; those of the same service
    among them make the srv family.  ``dst_host_same_src_port_rate`` is the share that come from the row's own source
    port, ``dst_host_srv_diff_host_rate`` the number of distinct source hosts over the number of connections."""
    base = events.select(row_id, dest, service, F.col(src_host).alias("_host"), F.col(src_port).alias("_port"),
                         F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"), serror.cast("int").alias("_se"), rerror.cast("int").alias("_re"))
    ranked = rank_within_key(base, dest, "_us", row_id, bucket_seconds)
    return host_features(ranked, row_id, dest, service, "_host", "_port", F.col("_se"), F.col("_re"), n)


def host_features(rows: DataFrame, row_id: str, dest: str, service: str, src_host: str, src_port: str, serror: Column, rerror: Column, n: int) -> DataFrame:
    """The ten features of rows that have their rank within ``dest`` in ``_rank`` (any consecutive numbers)."""
    m = {"se": serror, "re": rerror}
    d = last_n_sums(rows, [dest], "_rank", n, m, "d_")
    ds = last_n_sums(rows, [dest, service], "_rank", n, m, "ds_")
    dp = last_n_sums(rows, [dest, src_port], "_rank", n, {}, "dp_")
    hosts = last_n_distinct(rows, [dest, service], src_host, row_id, "_rank", n, "hosts")
    j = d.join(ds.select(row_id, "ds_count", "ds_se", "ds_re"), row_id).join(dp.select(row_id, "dp_count"), row_id).join(hosts, row_id)
    same = safe_div("ds_count", "d_count")
    return j.select(
        row_id, F.col("d_count").cast("long").alias("dst_host_count"),
        F.col("ds_count").cast("long").alias("dst_host_srv_count"),
        r6(same).alias("dst_host_same_srv_rate"), r6(F.lit(1.0) - same).alias("dst_host_diff_srv_rate"),
        r6(safe_div("dp_count", "d_count")).alias("dst_host_same_src_port_rate"),
        r6(safe_div("hosts", "ds_count")).alias("dst_host_srv_diff_host_rate"),
        r6(safe_div("d_se", "d_count")).alias("dst_host_serror_rate"),
        r6(safe_div("ds_se", "ds_count")).alias("dst_host_srv_serror_rate"),
        r6(safe_div("d_re", "d_count")).alias("dst_host_rerror_rate"),
        r6(safe_div("ds_re", "ds_count")).alias("dst_host_srv_rerror_rate"))
