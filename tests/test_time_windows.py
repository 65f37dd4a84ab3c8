"""The two forms of the time windows agree, and few rows in a window need no table of slices."""

import random

from pyspark.sql import functions as F

from connlens.operators import traffic as TR


def test_stretches_and_slices_agree(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, 1, 2]), rng.choice(["a", "b", None]), None if i % 40 == 0 else 1_000_000 * rng.randrange(-30, 30) + rng.choice([0, 0, 1, 999_999]),
             rng.random() < 0.3) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, host int, svc string, us long, err boolean").withColumn("ts", F.timestamp_micros("us"))
    for seconds in (2, 7):
        few, many = (TR.traffic_time_window(df, "id", "ts", "host", "svc", F.col("err"), ~F.col("err"), seconds, stretch_rows=n) for n in (400, 0))
        assert "Join" not in few._jdf.queryExecution().optimizedPlan().toString() and "Join" in many._jdf.queryExecution().optimizedPlan().toString()
        got, want = ({r["id"]: tuple(r) for r in d.collect()} for d in (few, many))
        assert got == want and len(got) == 400
        for i, host, svc, us, _ in rows:
            near = [r for r in rows if (r[3] is None) == (us is None) and (us is None or us - seconds * 1_000_000 <= r[3] <= us)]
            assert got[i][1:3] == (sum(r[1] == host for r in near), sum(r[2] == svc for r in near))
