"""Cheapest repair of conversation structure by a suffix-shared automaton.

A conversation's rows in order of turn become a signature, one symbol a row: the initial of its role and its first
fault.  A row is blank (no character but ASCII white space), a duplicate (role and text occur earlier in the
conversation) or truncated (its last such character is not one of ``.!?``).  Edits turn the role initials into
``(s?(ua)+)?``: keep (K, 0), rerole to user or assistant (R, 2), delete (D, 3; blank and duplicate rows must go),
insert an empty user or assistant row (I, 2); a truncated row that stays adds 1.

Distinct signatures are sorted from their ends, so those with a common suffix are neighbours, and the automaton is
built from the end: a node is a distinct suffix, and only the path of the current signature is held.  Each node gets,
once for all conversations and for each state of the grammar, its cost-to-go and the first edit of the best
audit suffix with a link to the rest of it, so a node is constant in size.  (Tasks share no memory: the nodes on the
path of a task's first signature are made there too.)  Two best edits of a node never begin with the same letter,
so "the ASCII-least of the cheapest" is settled by that letter.

Signatures are made from narrow rows, and the repaired texts are hashed row by row as they stream past in order; no
task holds a conversation's rows.  One conversation's hash is sequential, so its rows do pass through one task.

Defined results: null roles and texts count as one space; null turns come first, rows of one turn go by role, then by
the text's SHA-256; rows with a null conversation id are one conversation; equal rows are duplicates but for the
first; a conversation without rows (``ids`` names it) has zeros, an empty audit and the hash of an empty string; an
empty table gives an empty result; other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connlens.llm.bpe import slices, tidy
from connlens.llm.common import lookup_skew_safe
from connlens.session import materialize, ship_package

BLANKS = " \t\n\x0b\x0c\r"
#: A signature's symbols: a role initial (o: another), in capitals if truncated, or x for a row that must go.
MUST_GO = "x"
#: The states of the grammar: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
_TURNS_TO = (USER, USER, ASSISTANT, USER)  # the state after an inserted or reroled row
_KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_NAMES = {USER: "user", ASSISTANT: "assistant"}


def damage(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (id, turn, role, text) damaged by crc32 of ``id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes
    its ``.!?``, 3 repeats it, 4 makes its role user.  Nulls count as one space."""
    rows = convs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{turn_col}`").alias("turn"), *_filled(role_col, text_col))
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("id", ":", "turn")])
    hit = rows.withColumn("hit", F.crc32(name) % 20).where("hit <> 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("hit") == 3, 2).otherwise(1)))
    return hit.select("id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("c")).drop("c")


def _filled(role_col: str, text_col: str):
    return [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))]


STATS = "signature string, gaps long, blank long, duplicate long, truncated long, illegal long"


def _signatures(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """id, signature and counts of every conversation in ``rows`` (id, turn, role, text) or ``ids`` (id)."""
    bare = F.btrim("text", F.lit(BLANKS))
    kind = F.when(bare == "", 1).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    whose = F.when(F.col("id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("id").cast("string")))
    key = F.sha2(F.concat_ws(":", whose, F.length("role"), "role", "text"), 256)
    narrow = rows.select("id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), kind.alias("kind"), key.alias("key"))
    order = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    repeats = materialize(narrow.groupBy("key").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1"), "repeated-rows")
    later = lookup_skew_safe(narrow, "key", repeats, ["first"], "n", F.concat_ws(":", F.lit("hot"), "key", F.monotonically_increasing_id()))
    marked = later.select("id", "turn", "role", "digest", "kind", F.coalesce(F.col("first") < order, F.lit(False)).alias("later"), F.lit(True).alias("row"))
    marks = ids.select("id", *[F.lit(None).cast(marked.schema[c].dataType).alias(c) for c in ("turn", "role", "digest", "kind", "later")], F.lit(False).alias("row"))
    dealt = marked.unionByName(marks).repartition("id").sortWithinPartitions(F.col("id").asc_nulls_first(), "row", F.col("turn").asc_nulls_first(), "role", "digest")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, out, sig, counts, low, turn_before, distinct, before = None, [], bytearray(), [0] * 5, None, None, 0, None

        def close():
            gaps = turn_before - low + 1 - distinct if distinct else 0
            out.append((here[0], sig.decode(), gaps, counts[1], counts[2], counts[3], counts[4]))

        def batch():
            cols = [pa.array([o[j] for o in out], t) for j, t in enumerate((id_kind, pa.string(), *[pa.int64()] * 5))]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, ["id", *[f.split()[0] for f in STATS.split(", ")]])

        id_kind = None
        for whole in batches:
            id_kind = whole.schema.field(0).type
            for id_, turn, role, digest, kind, later, real in zip(*[c.to_pylist() for c in whole.columns]):
                if here is None or here[0] != id_:
                    if here is not None:
                        close()
                        if len(out) >= 4096:
                            yield batch()
                    here, sig, counts, low, turn_before, distinct, before = (id_,), bytearray(), [0] * 5, None, None, 0, None
                if not real:
                    continue
                if turn is not None and turn != turn_before:
                    low, turn_before, distinct = turn if low is None else low, turn, distinct + 1
                fault = 2 if kind != 1 and (later or before == (turn, role, digest)) else kind
                counts[fault] += 1
                if before is not None and before[1][:1] + role[:1] not in ("su", "ua", "au"):
                    counts[4] += 1
                initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
                sig += (MUST_GO if fault in (1, 2) else initial.upper() if fault == 3 else initial).encode()
                before = (turn, role, digest)
        if here is not None:
            close()
        if out:
            yield batch()

    return dealt.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {STATS}")


#: A layer: for each grammar state (cost-to-go, (first edit, rest) or None).
END = ((0, None), (4, ("I", ("I", None))), (2, ("I", None)), (0, None))


def node(symbol: str, after: tuple) -> tuple:
    """The layer of the suffix ``symbol`` + s, where ``after`` is the layer of s."""
    role, extra = symbol.lower(), int(symbol.isupper())
    best = []
    for state in range(4):
        options = [(3 + after[state][0], "D", after[state][1])]
        if role != MUST_GO:
            cost, rest = after[_TURNS_TO[state]]
            options.append((2 + extra + cost, "R", rest))
            kept = _KEPT[state].get(role)
            if kept is not None:
                options.append((extra + after[kept][0], "K", after[kept][1]))
        cost, edit, rest = min(options, key=lambda o: o[:2])
        best.append((cost, (edit, rest)))

    def inserted(state: int, source: tuple) -> tuple:
        cost, rest = source
        return min(best[state], (2 + cost, ("I", rest)), key=lambda o: (o[0], o[1][0]))

    user, assistant = inserted(USER, best[ASSISTANT]), inserted(ASSISTANT, best[USER])
    return inserted(START, user), inserted(SYSTEM, user), user, assistant


def audits(signatures: Iterator[str], made=lambda n: None) -> Iterator[tuple[int, str]]:
    """(cost, audit) of each signature; those given in the order of their reversed strings share every common node."""
    path, layers = "", [END]
    for signature in signatures:
        from_end = signature[::-1]
        same, most = 0, min(len(path), len(from_end))
        while same < most and path[same:same + 64] == from_end[same:same + 64]:
            same += 64
        same = min(same, most)
        while same < most and path[same] == from_end[same]:
            same += 1
        del layers[same + 1:]
        for symbol in from_end[same:]:
            layers.append(node(symbol, layers[-1]))
        made(len(from_end) - same)
        path = from_end
        cost, rest = layers[-1][START]
        edits = []
        while rest is not None:
            edits.append(rest[0])
            rest = rest[1]
        yield cost, "".join(edits)


def _decided(signatures: DataFrame) -> DataFrame:
    """Every distinct signature with n (how many conversations have it), cost and audit."""
    counted = materialize(signatures.groupBy("signature").agg(F.count("*").alias("n")), "signatures")
    spread = counted.repartitionByRange(F.reverse("signature")).sortWithinPartitions(F.reverse("signature"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def each():
            for whole in batches:
                for batch in slices(whole, 0):
                    held.append(batch)
                    yield from batch.column(0).to_pylist()

        found = audits(each())
        costs, texts = [], []
        for cost, audit in found:
            costs.append(cost)
            texts.append(audit)
            if len(costs) == held[0].num_rows:
                batch = held.pop(0)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(costs, pa.int64()), pa.array(texts, pa.string())], ["signature", "n", "cost", "audit"])
                costs, texts = [], []

    return spread.select("signature", "n").mapInArrow(run, "signature string, n long, cost long, audit string")


def _repaired(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """id, text pieces in order: ``decided`` (id, audit) applied to ``rows``; hashed as they stream past."""
    here = rows.select("id", F.lit(True).alias("row"), "turn", "role", F.sha2("text", 256).alias("digest"), "text")
    plans = decided.select("id", F.lit(False).alias("row"), *[F.lit(None).cast(here.schema[c].dataType).alias(c) for c in ("turn", "role", "digest")], F.col("audit").alias("text"))
    dealt = here.unionByName(plans).repartition("id").sortWithinPartitions(F.col("id").asc_nulls_first(), "row", F.col("turn").asc_nulls_first(), "role", "digest")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, out, kind = None, [], None
        for whole in batches:
            kind = whole.schema.field(0).type
            for batch in slices(whole, 3):
                for id_, real, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                    if real:
                        repair.row(role, text)
                    else:
                        if repair is not None:
                            out.append((repair.id, repair.done()))
                        repair = Repair(id_, text)
            if len(out) >= 4096:
                yield rows_of(out, kind)
                out = []
        if repair is not None:
            out.append((repair.id, repair.done()))
        if out:
            yield rows_of(out, kind)

    def rows_of(out, kind):
        return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], kind), pa.array([o[1] for o in out], pa.string())], ["id", "sha256"])

    return dealt.select("id", "row", "role", "text").mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, sha256 string")


class Repair:
    """Applies an audit to a conversation's rows, given one by one, and hashes the repaired rows."""

    def __init__(self, id_, audit: str):
        self.id, self.audit, self.at, self.state, self.hash, self.some = id_, audit, 0, START, hashlib.sha256(), False

    def _put(self, role: str, text: str, state: int) -> None:
        self.hash.update(f"{chr(10) if self.some else ''}{role}:{text}".encode())
        self.some, self.state = True, state

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            to = _TURNS_TO[self.state]
            self._put(_NAMES[to], "", to)
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role, text, _KEPT[self.state][role[:1]])
        elif edit == "R":
            to = _TURNS_TO[self.state]
            self._put(_NAMES[to], text, to)

    def done(self) -> str:
        self._inserts()
        return self.hash.hexdigest()


def repair(rows: DataFrame, ids: DataFrame | None = None, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation of ``rows`` or ``ids`` (a table with the id column): id, gaps in the turns, blank,
    duplicate, truncated, illegal (neighbours whose role initials are none of su, ua, au), cost, audit, repaired_sha256."""
    ship_package(rows.sparkSession)
    own = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{turn_col}`").alias("turn"), *_filled(role_col, text_col))
    named = (own if ids is None else ids.select(F.col(f"`{id_col}`").alias("id"))).select("id").distinct()
    signed = materialize(_signatures(own, named), "conversation-signatures")
    plans = materialize(_decided(signed), "audits")
    spread = F.concat_ws(":", F.lit("hot"), F.monotonically_increasing_id())
    decided = materialize(lookup_skew_safe(signed, "signature", plans, ["cost", "audit"], "n", spread), "decided")
    hashes = _repaired(own, decided)
    return (decided.alias("d").join(hashes.alias("h"), F.col("d.id").eqNullSafe(F.col("h.id")))
            .select(F.col("d.id").alias(id_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha256").alias("repaired_sha256")))


def report(convs: DataFrame) -> DataFrame:
    """The repair of the damaged conversations, for every original conv_id."""
    rows = damage(convs)
    return repair(rows.withColumnRenamed("id", "conv_id"), convs)


_BLANK_CLASS = r"[\x20\x09-\x0D]"
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""


def _option(cost: str, edit: str, rest: str, piece: str = "''") -> str:
    return f"{{'cost': {cost} + {rest}.cost, 'audit': '{edit}' || {rest}.audit, 'rows': {piece} || {rest}.rows}}"


def _consumed(state: int) -> str:
    to, name = _TURNS_TO[state], _NAMES[_TURNS_TO[state]]
    keep = " ".join(f"WHEN initial = '{i}' THEN {_option('late', 'K', f'v{s}', 'line')}" for i, s in _KEPT[state].items())
    delete = _option("3", "D", f"v{state}")
    rerole = _option("2 + late", "R", f"v{to}", f"chr(10) || '{name}:' || text")
    return f"CASE WHEN gone THEN {delete} ELSE list_sort([{delete}, {rerole}, CASE {keep} ELSE {delete} END])[1] END AS c{state}"


def _with_insert(state: int, source: str) -> str:
    return f"list_sort([c{state}, {_option('2', 'I', source, f'chr(10) || {chr(39)}{_NAMES[_TURNS_TO[state]]}:{chr(39)}')}])[1]"


REPORT_SQL = f"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS h FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE h <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM damaged),
faults AS (
  SELECT *, NOT regexp_matches(text, '[^{_BLANK_CLASS[1:]}') AS is_blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
         NOT regexp_matches(text, '[.!?]{_BLANK_CLASS}*\\z') AS cut,
         lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS role_before
  FROM placed),
marked AS (
  SELECT coalesce(conv_id::VARCHAR, 'null') AS c, turn, i, role, text, chr(10) || role || ':' || text AS line, left(role, 1) AS initial,
         is_blank, seen AND NOT is_blank AS is_seen, cut AND NOT is_blank AND NOT seen AS is_cut,
         is_blank OR seen AS gone, CASE WHEN cut AND NOT is_blank AND NOT seen THEN 1 ELSE 0 END AS late,
         role_before IS NOT NULL AND left(role_before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS bad
  FROM faults),
counted AS (
  SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(is_blank::INT) AS blank,
         sum(is_seen::INT) AS duplicate, sum(is_cut::INT) AS truncated, sum(bad::INT) AS illegal
  FROM marked GROUP BY c),
walk AS (
  SELECT c, n + 1 AS i, {{'cost': 0, 'audit': '', 'rows': ''}} AS v0, {{'cost': 4, 'audit': 'II', 'rows': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS v1,
         {{'cost': 2, 'audit': 'I', 'rows': chr(10) || 'assistant:'}} AS v2, {{'cost': 0, 'audit': '', 'rows': ''}} AS v3
  FROM counted
  UNION ALL
  SELECT c, i, {_with_insert(0, 'u')} AS v0, {_with_insert(1, 'u')} AS v1, u AS v2, {_with_insert(3, 'c2')} AS v3
  FROM (SELECT *, {_with_insert(2, 'c3')} AS u FROM (
    SELECT m.c, m.i, {', '.join(_consumed(s) for s in range(4))}
    FROM walk JOIN marked m ON m.c = walk.c AND m.i = walk.i - 1)))
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v0.cost, 0)::BIGINT AS cost,
       coalesce(v0.audit, '') AS audit, sha256(coalesce(substr(v0.rows, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted ON counted.c = coalesce(o.conv_id::VARCHAR, 'null')
LEFT JOIN walk ON walk.c = counted.c AND walk.i = 1
"""
