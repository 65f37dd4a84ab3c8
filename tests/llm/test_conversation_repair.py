"""Conversation repair against all edit sequences of short conversations."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from connlens.llm import conversation_repair as C

SPACE = " \t\n\x0b\x0c\r"
GRAMMAR = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, id string, __row string, signature long"


def brute(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) of rows (turn, role, text), in order."""
    seen, faults = set(), []
    for turn, role, text in rows:
        bare = text.strip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    best = None
    inserts = [("", []), ("I", ["user"]), ("I", ["assistant"]), ("II", ["user", "assistant"]), ("II", ["assistant", "user"])]
    each = []
    for (_, role, text), fault in zip(rows, faults):
        late = int(fault == "truncated")
        options = [("D", 3, [])]
        if fault not in ("blank", "duplicate"):
            options += [("K", late, [(role, text)]), ("R", 2 + late, [("user", text)]), ("R", 2 + late, [("assistant", text)])]
        each += [[(a, 2 * len(a), [(n, "") for n in ns]) for a, ns in inserts], options]
    each.append([(a, 2 * len(a), [(n, "") for n in ns]) for a, ns in inserts])
    for chosen in itertools.product(*each):
        out = [r for _, _, rs in chosen for r in rs]
        if GRAMMAR.fullmatch("".join(r[0][:1] for r in out)) and all(r[0] for r in out):
            found = (sum(c for _, c, _ in chosen), "".join(a for a, _, _ in chosen), out)
            if best is None or found[:2] < best[:2]:
                best = found
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in best[2]).encode()).hexdigest()
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, best[0], best[1], digest


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def random_conversations(n, seed=3):
    rng = random.Random(seed)
    roles, texts = ["system", "user", "assistant", "tool", "", "agent", "User"], ["Hi.", "Hi", "Why?", "", " \t\n", "ok! ", "é", "Hi.", "\xa0"]
    return {c: [(rng.choice([None, 0, 1, 2, 3, 5, 9]) if rng.random() < 0.4 else k, rng.choice(roles), rng.choice(texts)) for k in range(rng.randrange(1, 4))] for c in range(n)}


def test_repairs_equal_all_edit_sequences(spark):
    convs = random_conversations(120)
    data = [(c, t, r, x, "a", "b", 1) for c, rows in convs.items() for t, r, x in rows]
    got = C.repair(spark.createDataFrame(data, SCHEMA)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {c: brute(ordered(rows)) for c, rows in convs.items()} and len(got) == len(convs)


def test_nodes_are_made_once_and_long_signatures_are_linear():
    rng = random.Random(5)
    signatures = {"".join(rng.choice("suaoSUAOx") for _ in range(rng.randrange(0, 9))) + rng.choice(["", "ua", "uaua", "uaU"]) for _ in range(400)}
    made = []
    found = list(C.audits(iter(sorted(signatures, key=lambda s: s[::-1])), made.append))
    assert sum(made) == len({s[i:] for s in signatures for i in range(len(s))})
    alone = {s: next(C.audits(iter([s]))) for s in signatures}
    assert dict(zip(sorted(signatures, key=lambda s: s[::-1]), found)) == alone
    cost, audit = next(C.audits(iter(["s" + "ua" * 200_000])))
    assert cost == 0 and audit == "K" * 400_001


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if hit:
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            out += [(c, t, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def damaged_cases():
    rows = [(c, t, r, x) for c, turns in random_conversations(250, 8).items() for t, r, x in turns]
    rows += [(None, 1, "user", "a."), (None, None, None, None), (None, 1, "user", "a."), (700, None, "user", "b."), (700, None, "assistant", None)]
    dropped = next(c for c in range(1000, 3000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*rows, (dropped, 0, "user", "gone.")], dropped


def test_report_equals_brute_force_and_its_sql(spark):
    rows, dropped = damaged_cases()
    got = {r[0]: tuple(r)[1:] for r in C.report(spark.createDataFrame([(*r, "a", "b", 1) for r in rows], SCHEMA)).collect()}
    want = {c: brute(ordered([r[1:] for r in damaged(rows) if r[0] == c])) for c in {r[0] for r in rows}}
    assert got == want
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert {r[0]: tuple(r[1:]) for r in con.execute(C.REPORT_SQL).fetchall()} == want


def test_a_hot_conversation_and_very_long_texts(spark):
    data = [(1, k, ("user", "assistant")[k % 2], f"line {k}.", "a", "b", 1) for k in range(20_000)] + [(2, 0, "user", "word " * 100_000, "a", "b", 1)]
    data += [(c, k, ("user", "assistant")[k], "same.", "a", "b", 1) for c in range(3, 3000) for k in range(2)]
    got = {r[0]: tuple(r)[1:] for r in C.repair(spark.createDataFrame(data, SCHEMA).repartition(7)).collect()}
    assert len(got) == 2999
    assert got[1][5:7] == (0, "K" * 20_000)
    assert got[1][7] == hashlib.sha256("\n".join(f"{r[2]}:{r[3]}" for r in data[:20_000]).encode()).hexdigest()
    assert got[2][5:7] == (3, "D") and got[2][3] == 1
    assert {got[c] for c in range(3, 3000)} == {(0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:same.\nassistant:same.").hexdigest())}


def test_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.report(empty).collect() == [] and C.repair(empty).collect() == []
