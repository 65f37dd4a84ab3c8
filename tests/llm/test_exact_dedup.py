import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from connlens.llm import exact_dedup as X

ROWS = [(5, "a  b"), (2, "a\tb"), (9, "a b"), (1, None), (4, ""), (7, "long " * 40000), (8, "long " * 40000), (3, "A b"),
        (None, "a\n b"), (None, "lone"), (6, "rep"), (6, "rep"), (10, " a b")]


def brute(rows):
    groups = defaultdict(list)
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    for (i, _), t in zip(rows, norm):
        groups[t].append(i)
    out = []
    for (i, _), t in zip(rows, norm):
        keep = min((x for x in groups[t] if x is not None), default=None)
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_verdicts_match_brute_force(frame):
    got = X.verdicts(frame(ROWS)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(ROWS)


def test_colliding_digests_are_told_apart_by_content(frame):
    weak = lambda norm: F.substring(F.sha2(norm, 256), 1, 1)
    got = X.verdicts(frame(ROWS * 2 + [(i, f"t{i}") for i in range(20, 60)]), digest=weak).collect()
    want = brute(ROWS * 2 + [(i, f"t{i}") for i in range(20, 60)])
    assert sorted((tuple(r) for r in got), key=str) == want
    kept = X.kept_rows(frame(ROWS + [(i, f"t{i}") for i in range(20, 60)]), digest=weak)
    assert kept.count() == 47


def test_kept_rows_have_one_row_a_text_and_all_columns(frame):
    kept = X.kept_rows(frame(ROWS))
    assert kept.columns == ["doc_id", "text", "id", "__row", "group"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([2, 1, 7, 3, None, 6, 10], key=str)
    assert [r.text for r in kept.where("doc_id = 2").collect()] == ["a\tb"]


def test_hot_group_and_empty_table(spark, frame):
    hot = frame([(i, "same text") for i in range(5000)] + [(i, f"t{i}") for i in range(5000, 9000)])
    got = X.verdicts(hot).groupBy("keep_id").agg(F.count("*").alias("n"), F.max("group_size").alias("g")).where("n > 1").collect()
    assert [tuple(r) for r in got] == [(0, 5000, 5000)]
    assert X.verdicts(frame([])).count() == 0 and X.kept_rows(frame([])).count() == 0


def test_main_path_has_no_python(spark, frame):
    plan = X.verdicts(frame(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
