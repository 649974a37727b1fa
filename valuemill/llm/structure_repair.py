"""Cheapest repair of the structure of conversations by rank-convergence parallel Viterbi.

A conversation is well formed when the first letters of its roles give ``(s?(ua)+)?``: states E (nothing yet), S, U and A, and
from each state one letter of u and a that may follow. Rows are kept, reroled to that letter, or deleted; rows without text are
inserted. Costs run backwards over a conversation's rows as vectors of four states; of equal costs the least edit letter wins
(D, I, K, R), so a forward walk along the backward costs gives the ASCII-least cheapest edits.

A long conversation is cut into chunks that are worked on at the same time. Each starts from a speculative cost vector at its end;
fix-up passes run a chunk again from the vector that its successor really has, until the new vectors differ from the earlier ones
by a constant only. Then every chunk says for each state it may be entered in which one it is left in, these are stitched in
order, and each chunk traces its own edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from valuemill.llm.line_dedup import STRIPPED
from valuemill.llm.turns import Placed
from valuemill.session import materialize

# ---------------------------------------------------------------------------
# Costs of edits, states and what may follow them.
# ---------------------------------------------------------------------------
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
E, S, U, A = range(4)
#: The one state that a user or assistant row leads to; that kept rows by initial s, u, a and other lead to (None: not allowed).
FOLLOWS = (U, U, A, U)
KEPT = ((S, U, None, None), (None, U, None, None), (None, None, A, None), (None, U, None, None))
ACCEPT = (0, 2 * INSERT, INSERT, 0)
ROLE = {U: "user", A: "assistant"}
#: Faults of a row, the first that it has.
NONE, BLANK, DUPLICATE, CUT = range(4)
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Rows of a chunk.
CHUNK = 1024


@lru_cache(maxsize=1 << 16)
def row_table(after: tuple[int, ...], code: int):
    """(costs before a row up to a constant, that constant, edit for each state) from the costs ``after`` it.

    ``code``: initial + 4 * fault. An edit is (letter, state it leads to, cost). Costs differ by a bounded amount, so few vectors occur.
    """
    initial, fault = code % 4, code // 4
    more = TRUNCATED if fault == CUT else 0
    ways = []
    for q in range(4):
        own = [(DELETE + after[q], "D", q, DELETE)]
        if fault not in (BLANK, DUPLICATE):
            if KEPT[q][initial] is not None:
                own.append((more + after[KEPT[q][initial]], "K", KEPT[q][initial], more))
            own.append((REROLE + more + after[FOLLOWS[q]], "R", FOLLOWS[q], REROLE + more))
        ways.append(own)
    cost = [min(w[0] for w in own) for own in ways]
    for _ in range(3):  # rows inserted before this one
        cost = [min(cost[q], INSERT + cost[FOLLOWS[q]]) for q in range(4)]
    edits = tuple(min([w[1:] for w in own if w[0] == cost[q]] + [("I", FOLLOWS[q], INSERT)] * (INSERT + cost[FOLLOWS[q]] == cost[q])) for q, own in enumerate(ways))
    least = min(cost)
    return tuple(c - least for c in cost), least, edits


def start_costs(codes: list[int], after: tuple[int, ...]) -> tuple[int, ...]:
    """The costs before the first row, up to a constant."""
    for code in reversed(codes):
        after = row_table(after, code)[0]
    return after


def fixed_up(codes: list[int], old: tuple[int, ...], new: tuple[int, ...], start: tuple[int, ...]) -> tuple[int, ...]:
    """As ``start_costs(codes, new)``, where ``start`` is that of ``old``: ends as soon as the two differ by a constant only."""
    for code in reversed(codes):
        if old == new:
            return start
        old, new = row_table(old, code)[0], row_table(new, code)[0]
    return new


def edits_of(codes: list[int], after: tuple[int, ...]) -> list:
    """For each row its edit for each state."""
    tables = []
    for code in reversed(codes):
        after, _, edits = row_table(after, code)
        tables.append(edits)
    return tables[::-1]


def trace(tables: list, state: int, last: bool):
    """(edits (row, letter, state it leads to), cost, state at the end); the last chunk also inserts what is lacking at the end."""
    out, cost = [], 0
    for i, edits in enumerate(tables):
        letter = "I"
        while letter == "I":
            letter, state, paid = edits[state]
            out.append((i, letter, state))
            cost += paid
    while last and ACCEPT[state]:
        state = FOLLOWS[state]
        out.append((len(tables), "I", state))
        cost += INSERT
    return out, cost, state


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies): rows damaged by crc32(conv_id:turn) % 20, nulls read as one blank.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it (copies = 2), 4 sets its role to user.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    return conversations.where(kind != 0).select(F.col("conv_id").alias("conv"), "turn", F.when(kind == 4, "user").otherwise(blank("role")).alias("role"),
                                                 text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("copies"))


def _digest() -> Column:
    return F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")))


_VECTOR = "array<int>"


def _chunks(rows: DataFrame) -> DataFrame:
    """(conv, chunk, codes, turns, digests, counts of faults, ``tail``: whether it is the last, initial of the next chunk's first row), written."""
    stripped = F.rtrim(F.col("text"), F.lit(STRIPPED))
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3)
    fault = F.when(stripped == "", BLANK).when(F.right(stripped, F.lit(1)).isin(".", "!", "?"), NONE).otherwise(CUT)
    light = rows.select("conv", "turn", _digest().alias("digest"), initial.alias("initial"), fault.alias("fault"), F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")
    placed = Placed(light, "conv", [F.col("turn").asc_nulls_first(), F.col("digest")], "turns").positioned()
    # A row is the first of its kind where its place is the least; (conversation, place) is unique, so the join has no hot key.
    first = placed.groupBy("conv", "digest").agg(F.min("pos").alias("at")).select(F.col("conv").alias("of"), "at")
    known = placed.join(first, F.col("conv").eqNullSafe(F.col("of")) & (F.col("pos") == F.col("at")), "left")
    fault = F.when((F.col("fault") != BLANK) & F.col("at").isNull(), DUPLICATE).otherwise(F.col("fault"))
    row = F.struct("pos", (F.col("initial") + 4 * F.col("fault")).alias("code"), "turn", "digest")
    count = lambda k, name: F.sum((F.col("fault") == k).cast("long")).alias(name)
    chunks = (known.withColumn("fault", fault).groupBy("conv", F.floor(F.col("pos") / CHUNK).alias("chunk"))
              .agg(F.array_sort(F.collect_list(row)).alias("rows"), count(BLANK, "blank"), count(DUPLICATE, "duplicate"), count(CUT, "truncated")))
    chunks = materialize(chunks.select("conv", "chunk", F.col("rows.code").alias("codes"), F.col("rows.turn").alias("turns"), F.col("rows.digest").alias("digests"),
                                       "blank", "duplicate", "truncated"), "chunks")
    following = chunks.where("chunk > 0").select(F.col("conv").alias("of"), (F.col("chunk") - 1).alias("at"), (F.get("codes", F.lit(0)) % 4).alias("next_initial"))
    same = F.col("conv").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("at"))
    return materialize(chunks.join(following, same, "left").select(*chunks.columns, "next_initial", F.col("at").isNull().alias("tail")), "chunks")


def _vectors(rows: DataFrame, kind: str) -> DataFrame:
    """``start`` of each row (conv, chunk, codes, end, and for fix-ups the earlier ``was`` and ``start``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, end = batch.column(2).to_pylist(), [tuple(v) for v in batch.column(3).to_pylist()]
            if batch.num_columns == 4:
                start = [start_costs(c, e) for c, e in zip(codes, end, strict=True)]
            else:
                was, start = ([tuple(v) for v in batch.column(i).to_pylist()] for i in (4, 5))
                start = [fixed_up(c, o, e, s) for c, e, o, s in zip(codes, end, was, start, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(start, pa.list_(pa.int32()))], ["conv", "chunk", "end", "start"])

    return rows.mapInArrow(run, f"conv {kind}, chunk long, end {_VECTOR}, start {_VECTOR}")


def _converged(chunks: DataFrame) -> DataFrame:
    """(conv, chunk, end): the true costs after each chunk of a conversation of several, up to a constant."""
    kind = chunks.schema["conv"].dataType.simpleString()
    codes = chunks.select("conv", "chunk", "codes")
    accept = F.array(*map(F.lit, ACCEPT)).cast(_VECTOR)
    state = materialize(_vectors(codes.select("*", accept.alias("end")), kind), "vectors")
    while True:
        following = state.select(F.col("conv").alias("of"), (F.col("chunk") - 1).alias("at"), F.col("start").alias("real"))
        same = F.col("conv").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("at"))
        seen = materialize(state.join(following, same, "left").select("conv", "chunk", "end", "start", F.coalesce("real", accept).alias("real")), "vectors")
        moved = seen.where("real <> end")
        if moved.isEmpty():
            return seen.select("conv", "chunk", "end")
        keys = moved.select(F.col("conv").alias("of"), F.col("chunk").alias("at"), F.col("real").alias("new"), F.col("end").alias("was"), "start")
        again = codes.join(keys, same).select("conv", "chunk", "codes", "new", "was", "start")
        state = materialize(_vectors(again, kind).unionByName(seen.where("real = end").select("conv", "chunk", "end", "start")), "vectors")


def _entered(chunks: DataFrame) -> DataFrame:
    """(conv, chunk, state): the state in which each chunk is entered. ``chunks`` hold codes and the true ``end``."""
    kind = chunks.schema["conv"].dataType.simpleString()

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for codes, end in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                tables = edits_of(codes, tuple(end))
                maps.append([trace(tables, q, False)[2] for q in range(4)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.list_(pa.int32()))], ["conv", "chunk", "leaves"])

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state = (), E
        for batch in batches:
            states = []
            for conv, leaves in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if own != (conv,):
                    own, state = (conv,), E
                states.append(state)
                state = leaves[state]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(states, pa.int32())], ["conv", "chunk", "state"])

    maps = chunks.select("conv", "chunk", "codes", "end").mapInArrow(leave, f"conv {kind}, chunk long, leaves {_VECTOR}")
    # One row for each chunk of a long conversation passes through the task of that conversation; none is held.
    return maps.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(stitch, f"conv {kind}, chunk long, state int")


def _edits(chunks: DataFrame) -> DataFrame:
    """(conv, chunk, cost, audit, illegal, edits) of each chunk; ``edits``: what is written, in order, with the row it is or stands before."""
    kind, turn = (chunks.schema[c].dataType for c in ("conv", "turns"))
    fields = f"array<struct<turn: {turn.elementType.simpleString()}, digest: binary, at: int, inserted: boolean, role: string, tail: boolean>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, listed = {c: batch.column(c).to_pylist() for c in ("codes", "turns", "digests", "next_initial", "tail", "end", "state")}, []
            for codes, turns, digests, following, tail, end, state in zip(*rows.values(), strict=True):
                found, cost, _ = trace(edits_of(codes, tuple(end)), state, tail)
                own = []
                for n, (i, letter, to) in enumerate(found):
                    if letter != "D":
                        past = i == len(codes)
                        own.append({"turn": None if past else turns[i], "digest": None if past else digests[i], "at": n, "inserted": letter == "I",
                                    "role": None if letter == "K" else ROLE[to], "tail": past})
                initials = [c % 4 for c in codes] + ([] if following is None else [following])
                illegal = sum(pair not in LEGAL for pair in zip(initials, initials[1:], strict=False))
                listed.append((cost, "".join(e[1] for e in found), illegal, own))
            cost, audit, illegal, own = zip(*listed, strict=True) if listed else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("chunk"), pa.array(cost, pa.int64()), pa.array(audit, pa.string()),
                                              pa.array(illegal, pa.int64()), pa.array(own, schema_of_edits)], ["conv", "chunk", "cost", "audit", "illegal", "edits"])

    schema_of_edits = pa.list_(pa.struct([("turn", to_arrow_type(turn.elementType)), ("digest", pa.binary()), ("at", pa.int32()), ("inserted", pa.bool_()),
                                          ("role", pa.string()), ("tail", pa.bool_())]))
    return (chunks.select("conv", "chunk", "codes", "turns", "digests", "next_initial", "tail", "end", "state")
            .mapInArrow(run, f"conv {kind.simpleString()}, chunk long, cost long, audit string, illegal long, edits {fields}"))


def _repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv, repaired_sha256). Texts move once: each goes to its conversation's task in order, after its edits, and is hashed and let go.

    A digest runs over its conversation in order, so a very long conversation is one task's work, though not its memory.
    """
    events = edits.select("conv", "chunk", F.explode("edits").alias("e")).select("conv", F.col("e.tail").alias("tail"), "e.turn", "e.digest", F.lit(0).alias("kind"), "chunk",
                                                                                "e.at", "e.inserted", "e.role", F.lit(None).cast("string").alias("text"))
    texts = rows.select("conv", F.lit(False).alias("tail"), "turn", _digest().alias("digest"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("chunk"), F.lit(0).alias("at"),
                        F.lit(False).alias("inserted"), "role", "text")
    merged = events.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "tail", F.col("turn").asc_nulls_first(), F.col("digest").asc_nulls_first(), "kind", "chunk", "at")
    kind = rows.schema["conv"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, key, waiting, lines = (), None, None, [], 0

        def write(role: str, text: str) -> None:
            nonlocal lines
            state.update(f"\n{role}:{text}".encode() if lines else f"{role}:{text}".encode())
            lines += 1

        for batch in batches:
            done = []
            for c, tail, turn, digest, what, inserted, role, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if conv != (c,):
                    if conv:
                        done.append((conv[0], state.hexdigest()))
                    conv, state, waiting, key, lines = (c,), hashlib.sha256(), [], None, 0
                if tail:
                    write(role, "")
                elif what == 0:
                    if key != (turn, digest):
                        waiting, key = [], (turn, digest)
                    waiting.append((inserted, role))
                elif key == (turn, digest):  # of equal rows the first is written, the rest are duplicates
                    for new, other in waiting:
                        write(other or role, "" if new else text)
                    waiting = []
            if done:
                yield pack(done)
        if conv:
            yield pack([(conv[0], state.hexdigest())])

    arrow = to_arrow_type(kind)
    pack = lambda done: pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], arrow), pa.array([d for _, d in done], pa.string())], ["conv", "repaired_sha256"])
    return merged.select("conv", "tail", "turn", "digest", "kind", "inserted", "role", "text").mapInArrow(run, f"conv {kind.simpleString()}, repaired_sha256 string")


def repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: the faults of its ``rows`` (as ``damaged`` gives them) and their cheapest repair.

    gaps, blank, duplicate, truncated, illegal, cost (long), audit (letters of the edits in order) and repaired_sha256. Rows go by
    turn, nulls first, equal turns by digest. A conversation without rows has zeros, an empty audit and the digest of an empty
    text; a null conv_id is a conversation of its own; an empty table gives no rows; other columns are ignored.
    """
    chunks = _chunks(rows)
    accept = F.array(*map(F.lit, ACCEPT)).cast(_VECTOR)
    single = chunks.where("tail and chunk = 0").withColumns({"end": accept, "state": F.lit(E)})
    several = chunks.where("not (tail and chunk = 0)")
    if not several.isEmpty():
        same = lambda: F.col("conv").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("at"))
        named = lambda df: df.withColumnsRenamed({"conv": "of", "chunk": "at"})
        several = materialize(several.join(named(_converged(several)), same()).select(*chunks.columns, "end"), "chunks")
        several = several.join(named(_entered(several)), same()).select(*chunks.columns, "end", "state")
        single = single.unionByName(several)
    edits = materialize(_edits(single), "edits")
    counts = chunks.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    parts = edits.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
                                      F.array_join(F.array_sort(F.collect_list(F.struct("chunk", "audit")))["audit"], "").alias("audit"))
    turns = rows.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    out = conversations.select(F.col("conv_id")).distinct()
    for i, part in enumerate((counts, parts, turns, _repaired(rows, edits))):
        out = out.join(part.withColumnRenamed("conv", f"of{i}"), F.col("conv_id").eqNullSafe(F.col(f"of{i}")), "left").drop(f"of{i}")
    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c)
    return out.select("conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def _repair_sql() -> str:
    """DuckDB: costs, edits and lines of the four states carried forward row by row; CRC-32 byte by byte."""
    def ext(v: str, cost: str, letter: str, line: str | None) -> str:
        lines = f"{v}.r" if line is None else f"list_append({v}.r, {line})"
        return f"CASE WHEN {v} IS NOT NULL THEN {{'c': {v}.c + {cost}, 'x': {v}.x || '{letter}', 'r': {lines}}} END"

    least = lambda *vs: f"list_aggregate([{', '.join(vs)}], 'min')"
    insert = lambda v, role: ext(v, str(INSERT), "I", f"'{role}:'")
    kept = lambda v, i: f"CASE WHEN f NOT IN (1, 2) AND i0 = '{i}' THEN {ext(v, 'pen', 'K', 'role || chr(58) || text')} END"
    to = lambda v, i, role: f"CASE WHEN f NOT IN (1, 2) AND i0 <> '{i}' THEN {ext(v, f'pen + {REROLE}', 'R', chr(39) + role + ':' + chr(39) + ' || text')} END"
    drop = lambda v: ext(v, str(DELETE), "D", None)
    closed = (f"SELECT conv_id, i, e, s, u, {least('a', insert('u', 'assistant'))} AS a FROM ("
              f"SELECT conv_id, i, e, s, {least('u', insert('e', 'user'), insert('s', 'user'), insert('a', 'user'))} AS u, a FROM (@)) ")
    none = "NULL::STRUCT(c BIGINT, x VARCHAR, r VARCHAR[])"
    begin = f"SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'x': '', 'r': []::VARCHAR[]}} AS e, {none} AS s, {none} AS u, {none} AS a FROM ids"
    step = (f"SELECT v.conv_id, v.i + 1 AS i, {drop('e')} AS e, {least(drop('s'), kept('e', 's'))} AS s, "
            f"{least(drop('u'), *[w for q in ('e', 's', 'a') for w in (kept(q, 'u'), to(q, 'u', 'user'))])} AS u, "
            f"{least(drop('a'), kept('u', 'a'), to('u', 'a', 'assistant'))} AS a FROM v JOIN f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.i = v.i + 1")
    return r"""
WITH RECURSIVE tab AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS crc
  FROM range(256) r(n)),
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(k)), lambda i: ('0x' || substr(hex(encode(k)), 2 * i + 1, 2))::BIGINT)),
                lambda c, x: xor(c >> 8, tab.crc[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS what FROM src, tab),
dam AS (
  SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role, unnest(range(CASE WHEN what = 3 THEN 2 ELSE 1 END)) AS copy,
         CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM kinds WHERE what <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d, copy) AS i FROM (SELECT *, md5(strlen(role) || ':' || role || text) AS d FROM dam)),
f AS (
  SELECT *, substr(role, 1, 1) AS i0, CASE WHEN f = 3 THEN 5 ELSE 0 END AS pen,
         coalesce(substr(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1, 1) || substr(role, 1, 1) NOT IN ('su', 'ua', 'au') AND i > 1, false) AS ill
  FROM (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, d ORDER BY i) > 1 THEN 2
                       WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS f FROM o)),
ids AS (SELECT DISTINCT conv_id FROM conversations),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (f = 1) AS blank, count(*) FILTER (f = 2) AS duplicate,
         count(*) FILTER (f = 3) AS truncated, count(*) FILTER (ill) AS illegal, max(i) AS n FROM f GROUP BY conv_id),
v AS (""" + closed.replace("@", begin) + " UNION ALL " + closed.replace("@", step) + r"""),
z AS (
  SELECT ids.conv_id, g.* EXCLUDE (conv_id), """ + least("v.e", "v.a") + r""" AS b
  FROM ids LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM ids.conv_id JOIN v ON v.conv_id IS NOT DISTINCT FROM ids.conv_id AND v.i = coalesce(g.n, 0))
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, b.c AS cost, b.x AS audit, sha256(array_to_string(b.r, chr(10))) AS repaired_sha256 FROM z
"""


REPAIR_SQL = _repair_sql()
