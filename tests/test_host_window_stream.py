import random

import pandas as pd
from pyspark.sql import functions as F

from connlens.streaming import jobs


def test_last_100_over_batches_matches_brute_force(spark, tmp_path, monkeypatch):
    """Hosts with many more than 100 rows, null hosts and services, rows that come late; no Python worker gets a host's rows."""
    monkeypatch.setattr(pd, "concat", None)
    rng, source, root = random.Random(1), str(tmp_path / "in"), str(tmp_path / "run")
    schema = "event_id long, ts timestamp, host long, svc string, src long, port long, se int, re int"
    want, history, k = {}, {}, 0
    for batch in range(4):
        rows = []
        for _ in range(600):
            rows.append((k, 100000 * batch + rng.randrange(120000), rng.choice([1, 1, 1, 2, None]), rng.choice(["a", "b", None]), rng.choice([1, 2, 3, 4, None]),
                         rng.choice([80, 443]), rng.randrange(2), rng.randrange(2)))
            k += 1
        for i, t, h, s, src, port, se, re in sorted(rows, key=lambda r: (r[1], r[0])):
            own = history.setdefault(h, [])
            own.append((s, src, port, se, re))
            last = own[-100:]
            same = [x for x in last if x[0] == s]
            want[i] = (len(last), len(same), *(round(x, 6) for x in (
                len(same) / len(last), 1 - len(same) / len(last), sum(x[2] == port for x in last) / len(last), len({x[1] for x in same}) / len(same),
                sum(x[3] for x in last) / len(last), sum(x[3] for x in same) / len(same), sum(x[4] for x in last) / len(last), sum(x[4] for x in same) / len(same))))
        df = spark.createDataFrame(rows, "event_id long, t long, host long, svc string, src long, port long, se int, re int")
        df.withColumn("ts", F.timestamp_seconds("t")).drop("t").coalesce(1).write.mode("append").parquet(source)
        online = jobs.host_window_online("host", "svc", "src", "port", 100, "se", "re")
        jobs.run_to_table(spark.readStream.schema(schema).parquet(source), "hosts", root=root, per_batch=online)
    out = jobs.read_if_exists(spark, f"{root}/out").drop("batch").collect()
    got = {r[0]: tuple(round(x, 6) for x in r[1:]) for r in out}
    assert len(out) == 2400 and max(w[0] for w in want.values()) == 100
    assert all(abs(x - y) < 2e-6 for i in want for x, y in zip(got[i], want[i])) and got.keys() == want.keys()
    state = jobs.read_if_exists(spark, f"{root}/state/batch=3").groupBy("host").count().collect()
    assert len(state) == 3 and all(r["count"] == 99 for r in state)
    assert jobs.read_if_exists(spark, f"{root}/state/batch=1") is None
