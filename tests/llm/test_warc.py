import hashlib
import random

import pytest
from pyspark.sql import functions as F

from connlens.llm import warc as W


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, digest string, first int")


def brute(rows):
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        same = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        first = min(same, default=None)
        again = len(body) >= 100 and first is not None and i != first
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


BIG = "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 20
ROWS = [(5, "http://www.B.example.com/X?q=1#f", BIG), (2, "http://b.example.com/x?q=1", BIG), (9, None, BIG), (1, "https://a.org", None), (3, "https://a.org/", ""),
        (4, "bad url\r\nX: y", "x" * 99), (6, "bad url\r\nX: y", "x" * 99), (7, "http://a.org:80/y", "x" * 100), (8, "http://[bad", "x" * 100),
        (None, "http://z.org/", "x" * 100), (None, "http://z.org/", "only " * 50), (2, "http://b.example.com/x?q=1", BIG), (10, "http://long.org/", "y" * 3_000_000)]


def test_round_trip_matches_brute_force(spark):
    got = W.report(pages(spark, ROWS), records_per_file=3).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(ROWS)
    assert sorted(r.position for r in got) == list(range(len(ROWS)))
    assert W.report(pages(spark, [])).count() == 0


def test_history_is_in_global_order(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h{rng.choice([0, 0, 0, 1, 2, 3])}.org/p{rng.randrange(3)}", f"page {i} " * rng.randrange(1, 30)) for i in range(700)]
    rng.shuffle(rows)
    got = sorted(W.report(pages(spark, rows).repartition(5), records_per_file=40).collect(), key=lambda r: r.position)
    assert [(r.url_key, r.page_id) for r in got] == sorted((W.url_key(u), i) for i, u, _ in rows)
    assert len({r.archive for r in got}) >= 15


def test_archives_are_plain_warc_files(spark, tmp_path):
    path = str(tmp_path / "a")
    W.write(pages(spark, ROWS), path, records_per_file=4)
    seen = []
    for f in sorted((tmp_path / "a").glob("part-*")):
        data = f.read_bytes()
        for place, length, fields, block in W.parse(data):
            assert data[place:place + 9] == b"WARC/1.1\r" and data[place + length - 4:place + length] == b"\r\n\r\n"
            assert len(block) == int(fields["Content-Length"])
            seen.append(fields["WARC-Type"])
    assert sorted(seen) == sorted(r[3] for r in brute(ROWS))
    with pytest.raises(ValueError):
        list(W.parse(data[:-3]))


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(runs):
    rng = random.Random(runs)
    lists = [sorted(rng.randrange(50) for _ in range(rng.choice([0, 1, 7, 30]))) for _ in range(runs)]
    assert list(W.LoserTree(lists, lambda x: (x,))) == sorted(x for r in lists for x in r)


def test_url_keys():
    assert W.url_key("http://www2.Example.COM:8080/A/b?C=d#e") == "com,example)/a/b?c=d"
    assert W.url_key("https://a.org") == "org,a)/" and W.url_key(None) == "-" and W.url_key("") == "-"


def test_hot_payload(spark):
    rows = [(i, f"http://h.org/{i}", "z" * 150 if i % 3 else f"own {i} " * 30) for i in range(900)]
    got = W.report(pages(spark, rows))
    assert got.groupBy("record_type").agg(F.count("*").alias("n"), F.max("refers_to").alias("r")).orderBy("n").collect()[1][:] == ("revisit", 599, 1)
    assert got.where("record_type = 'revisit'").agg(F.min("payload_bytes"), F.max("payload_bytes")).first()[:] == (150, 150)
