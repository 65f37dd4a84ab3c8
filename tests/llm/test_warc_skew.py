from pyspark.sql import functions as F

from connlens.llm import warc as W


def test_equal_small_payloads_share_no_lookup_key(spark, monkeypatch):
    seen, lookup = [], W.lookup_skew_safe

    def spy(rows, key, *rest, **named):
        seen.append(rows.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"), F.max("size").alias("size")).collect())
        return lookup(rows, key, *rest, **named)

    monkeypatch.setattr(W, "lookup_skew_safe", spy)
    rows = [(i if i % 2 else None, f"http://a.org/{i}", None if i < 30 else "tiny" if i < 60 else "long " * 40) for i in range(90)]
    got = W.records(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.n == 1 for r in seen[0] if r["size"] < W.REVISIT_LEAST) and sum(r.n for r in seen[0]) == 90
    assert len(got) == 90 and sum("WARC-Type: revisit" in r.value for r in got) == 29
