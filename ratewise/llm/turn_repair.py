"""Cheapest repair of the role structure of conversations, in linear space.

A conversation is well formed if the initials of its roles read
``(s?(ua)+)?``. Its turns may be kept (0), given the role user or assistant (1)
or deleted (2), and empty turns of user or assistant inserted anywhere (5);
blank turns and turns whose role and text came before must go, and a truncated
turn that stays costs 5 more. Among the cheapest repairs the one whose audit,
the initials of its edits in order, is least is taken.

Four states (nothing, system, user or assistant last) tell all that matters of
what came before. A vector holds, for each state, the least cost and the rank of
the least audit among the states. The forward vector of the first half and the
backward vector of the second meet in the middle; the cheapest crossing with the
least audit is fixed and both halves are solved alone (Hirschberg). Audits of
one state and cost are never prefixes of each other, so ranks are enough and no
audit is carried along. Halves of LEAF turns are traced directly.

The same step joins tasks. Turns, without their texts, are sorted by ranges of
(conversation, turn, role, text), so that a conversation of any length is cut
into segments. Segments that are not a whole conversation become a table of
least costs and ranks from state to state; the tables of one conversation, at
most one for each task, give the states at its cuts, and each segment is then
solved by its own task. Equal turns of one conversation travel as one row with
a count. Texts are joined to the turns that stay.

Defined results: turns are ordered by ``turn``, those without one first, then by
role and by a hash of the text; a null role or text is as empty; turns without
conv_id are one conversation; other columns are not read; an empty table gives
no rows. The gap of turns further apart than 64 bits can tell is null.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.sizes import text_key
from ratewise.session import checkpointed

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
LATE = 5
LEAF = 32
#: Turns that one row of the result of a task holds.
PIECE = 4096
_BLANK = " \t\n\u000b\f\r"

# Codes of a turn: its initial (s, u, a, other), 4 more if truncated; turns that must go; the end.
_MUST_GO, _END = 8, 9

Move = tuple[int, int, int, str]


def _next(state: int) -> int:
    return ASSISTANT if state == USER else USER


@functools.cache
def moves(code: int) -> tuple[Move, ...]:
    """(from, to, cost, audit) of every way through one turn; insertions before it belong to it.

    Two insertions before a turn, or one before a deletion, are never in the least audit.
    """
    if code == _END:
        return ((NOTHING, NOTHING, 0, ""), (ASSISTANT, NOTHING, 0, ""), (USER, NOTHING, 5, "I"), (SYSTEM, NOTHING, 10, "II"))
    made = [(s, s, COST["D"], "D") for s in range(4)]
    if code == _MUST_GO:
        return tuple(made)
    kind, late = code % 4, LATE if code & 4 else 0
    for state in range(4):
        for lead, at in (("", state), ("I", _next(state))):
            paid = late + COST["I"] * len(lead)
            made.append((state, _next(at), paid + COST["R"], lead + "R"))
            if kind + 1 in ({_next(at), SYSTEM} if state == NOTHING and not lead else {_next(at)}):
                made.append((state, kind + 1, paid + COST["K"], lead + "K"))
    return tuple(made)


# A vector maps a key to (cost, rank); the last item of the key is a state.


def _ranked(best: dict) -> dict:
    ranks = {key: i for i, key in enumerate(sorted({value[1:] for value in best.values()}))}
    return {key: (value[0], ranks[value[1:]]) for key, value in best.items()}


def _less(best: dict, key, value) -> None:
    if key not in best or value < best[key]:
        best[key] = value


def forward(vector: dict, code: int) -> dict:
    """The vector after one more turn; keys are (start, state)."""
    best: dict = {}
    steps = moves(code)
    for (start, state), (cost, rank) in vector.items():
        for p, q, paid, word in steps:
            if p == state:
                _less(best, (start, q), (cost + paid, rank, word))
    return _ranked(best)


def backward(vector: dict, code: int) -> dict:
    """The vector before one more turn; keys are states."""
    best: dict = {}
    for p, q, paid, word in moves(code):
        if q in vector:
            cost, rank = vector[q]
            _less(best, p, (cost + paid, word, rank))
    return _ranked(best)


def transfer(codes: bytes, starts=range(4)) -> dict:
    """Cost and rank of the best way from each start to each state over all turns."""
    vector = {(s, s): (0, 0) for s in starts}
    for code in codes:
        vector = forward(vector, code)
    return vector


def _traced(codes: bytes, enter: int, leave: int) -> list[str]:
    vector, back = {(enter, enter): (0, 0)}, []
    for code in codes:
        best, source = {}, {}
        for (_, state), (cost, rank) in vector.items():
            for p, q, paid, word in moves(code):
                value = (cost + paid, rank, word)
                if p == state and ((enter, q) not in best or value < best[enter, q]):
                    best[enter, q], source[q] = value, (p, word)
        back.append(source)
        vector = _ranked(best)
    words, state = [], leave
    for source in reversed(back):
        state, word = source[state]
        words.append(word)
    return words[::-1]


def solve(codes: bytes, enter: int, leave: int) -> list[str]:
    """The audit of each turn on the best way from one state to another."""
    if len(codes) <= LEAF:
        return list(_short(codes, enter, leave))
    middle = len(codes) // 2
    first = transfer(codes[:middle], (enter,))
    second = {leave: (0, 0)}
    for code in reversed(codes[middle:]):
        second = backward(second, code)
    crossing = min(
        (cost + second[s][0], rank, second[s][1], s) for (_, s), (cost, rank) in first.items() if s in second
    )[-1]
    return solve(codes[:middle], enter, crossing) + solve(codes[middle:], crossing, leave)


@functools.lru_cache(maxsize=1 << 16)
def _short(codes: bytes, enter: int, leave: int) -> tuple[str, ...]:
    return tuple(_traced(codes, enter, leave))


def crossings(tables: list[dict]) -> list[int]:
    """States at the cuts of a conversation, from the tables of its segments, the first cut being its start."""
    rests = [backward({NOTHING: (0, 0)}, _END)]
    for table in reversed(tables[1:]):
        best: dict = {}
        for (p, q), (cost, rank) in table.items():
            if q in rests[-1]:
                _less(best, p, (cost + rests[-1][q][0], rank, rests[-1][q][1]))
        rests.append(_ranked(best))
    states = [NOTHING]
    for table, rest in zip(tables[:-1], reversed(rests)):
        here = states[-1]
        ways = [(cost + rest[q][0], rank, rest[q][1], q) for (p, q), (cost, rank) in table.items() if p == here and q in rest]
        states.append(min(ways)[-1])
    return states


# --- turns of all conversations -------------------------------------------------------

_CONV = ["has_conv", "conv"]
_KEY = [*_CONV, "has_turn", "turn0", "role", "text_key"]


def _keyed(turns: DataFrame) -> DataFrame:
    """Turns with keys that hold no null."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return turns.select(
        F.col("conv_id").isNotNull().alias("has_conv"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("turn").isNotNull().alias("has_turn"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn0"),
        role.alias("role"),
        text_key().alias("text_key"),
        text.alias("text"),
    )


def _faults(keyed: DataFrame) -> DataFrame:
    """One row for each distinct turn of a conversation: its code, its fault and its number of copies."""
    bare = F.rtrim("text", F.lit(_BLANK))
    initial = F.substring("role", 1, 1)
    told = keyed.select(
        *_KEY,
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("kind"),
        (F.length(bare) == 0).alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("late"),
    )
    counted = told.groupBy(*_KEY, "kind", "blank", "late").agg(F.count(F.lit(1)).alias("copies"))
    said = [*_CONV, "role", "text_key"]
    first = counted.groupBy(*said).agg(F.min(F.struct("has_turn", "turn0")).alias("first"))
    first = first.select(*said, "first.has_turn", "first.turn0", F.lit(True).alias("new"))
    return counted.join(first, _KEY, "left").withColumn("new", F.coalesce("new", F.lit(False)))


_TURN = "has_turn: boolean, turn0: long, role: string, text_key: binary, part: int, copies: long, new_role: string, edit: string"
_PIECE = (
    "has_conv boolean, conv long, segment int, piece int, rows long, blank long, duplicate long, late long, illegal long, "
    "distinct_turns long, low_turn long, high_turn long, first_kind int, last_kind int, cost long, audit string, "
    f"stays array<struct<{_TURN}>>"
)
_TABLE = "has_conv boolean, conv long, segment int, cells array<struct<p: int, q: int, cost: long, rank: int>>"


def _schema(ddl: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    parsed = _parse_datatype_string(ddl)
    return parsed, to_arrow_schema(parsed)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one conversation at a time, from batches sorted by it."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["has_conv"], row["conv"]) != (held[0]["has_conv"], held[0]["conv"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _code(row: dict) -> int:
    return _MUST_GO if row["blank"] or not row["new"] else row["kind"] + 4 * row["late"]


def _codes(rows: list[dict]) -> bytes:
    return bytes(map(_code, rows))


def _tables(ordered: DataFrame) -> DataFrame:
    """Tables of the first and last segment of each task; only these can be part of a longer conversation.

    Further copies of a turn are deleted in any case and add the same to all ways.
    """
    schema, arrow = _schema(_TABLE)

    def row(rows):
        cells = [{"p": p, "q": q, "cost": c, "rank": r} for (p, q), (c, r) in transfer(_codes(rows)).items()]
        return {"has_conv": rows[0]["has_conv"], "conv": rows[0]["conv"], "segment": rows[0]["segment"], "cells": cells}

    def run(batches):
        made, last = [], None
        for rows in _segments(batches):
            if not made:
                made.append(row(rows))
            else:
                last = rows
        if last:
            made.append(row(last))
        yield pa.RecordBatch.from_pylist(made, schema=arrow)

    return ordered.mapInArrow(run, schema)


def _cuts(ordered: DataFrame) -> DataFrame:
    """(has_conv, conv, segment, enter, leave) of the segments of conversations that lie in several tasks."""
    schema, arrow = _schema("has_conv boolean, conv long, segment int, enter int, leave int")

    def run(batches):
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                parts = sorted(row["parts"], key=lambda part: part["segment"])
                tables = [{(c["p"], c["q"]): (c["cost"], c["rank"]) for c in part["cells"]} for part in parts]
                states = crossings(tables)
                for part, enter, leave in zip(parts, states, [*states[1:], None]):
                    made.append({**{k: row[k] for k in _CONV}, "segment": part["segment"], "enter": enter, "leave": leave})
            yield pa.RecordBatch.from_pylist(made, schema=arrow)

    found = _tables(ordered).groupBy(*_CONV).agg(F.collect_list(F.struct("segment", "cells")).alias("parts"))
    return found.where(F.size("parts") > 1).mapInArrow(run, schema)


def _pieces(rows: list[dict]) -> Iterator[dict]:
    """The solved segment, in rows of at most PIECE turns."""
    enter, leave = rows[0]["enter"], rows[0]["leave"]
    whole = enter is None
    codes, last = _codes(rows), whole or leave is None
    words = solve(codes + bytes([_END]) if last else codes, enter or NOTHING, NOTHING if last else leave)
    state, turn = enter or NOTHING, ("has_turn", "turn0", "role", "text_key")
    for at in range(0, len(rows), PIECE):
        part, stays, audit, cost = rows[at : at + PIECE], [], [], 0
        for i, row in enumerate(part, at):
            extra = row["copies"] - 1
            edits = [(0, e) for e in words[i][:-1]] + [(1, words[i][-1])]
            if last and i == len(rows) - 1:
                edits += [(2 + k, e) for k, e in enumerate(words[-1])]
            for place, edit in edits:
                audit.append(edit + "D" * extra if place == 1 else edit)
                cost += COST[edit]
                if edit == "D":
                    continue
                cost += LATE if place == 1 and row["late"] else 0
                role = row["role"]
                state = row["kind"] + 1 if edit == "K" else _next(state)
                if edit != "K":
                    role = "user" if state == USER else "assistant"
                stays.append({**{k: row[k] for k in turn}, "part": place, "copies": row["copies"], "new_role": role, "edit": edit})
            cost += COST["D"] * extra
        pairs = zip(part, part[1:])
        turns = [r["turn0"] for r in part if r["has_turn"]]
        yield {
            **{k: part[0][k] for k in (*_CONV, "segment")},
            "piece": at // PIECE,
            "rows": sum(r["copies"] for r in part),
            "blank": sum(r["copies"] for r in part if r["blank"]),
            "duplicate": sum(r["copies"] - r["new"] for r in part if not r["blank"]),
            "late": sum(r["new"] and r["late"] for r in part if not r["blank"]),
            "illegal": sum(r["copies"] - 1 for r in part) + sum((a["kind"], b["kind"]) not in _LEGAL for a, b in pairs),
            "distinct_turns": len(set(turns)),
            "low_turn": min(turns, default=None),
            "high_turn": max(turns, default=None),
            "first_kind": part[0]["kind"],
            "last_kind": part[-1]["kind"],
            "cost": cost,
            "audit": "".join(audit),
            "stays": stays,
        }


_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _solved(ordered: DataFrame) -> DataFrame:
    schema, arrow = _schema(_PIECE)

    def run(batches):
        made, size = [], 0
        for rows in _segments(batches):
            for piece in _pieces(rows):
                made.append(piece)
                size += len(piece["stays"]) + 1
                if size >= PIECE:
                    yield pa.RecordBatch.from_pylist(made, schema=arrow)
                    made, size = [], 0
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=arrow)

    # At most two rows for each task: a bounded broadcast.
    cuts = F.broadcast(checkpointed(_cuts(ordered)))
    return checkpointed(ordered.join(cuts, [*_CONV, "segment"], "left").mapInArrow(run, schema))


def _conv_id() -> Column:
    return F.when(F.col("has_conv"), F.col("conv")).alias("conv_id")


def _report(solved: DataFrame) -> DataFrame:
    before = Window.partitionBy(*_CONV).orderBy("segment", "piece")
    last = F.lag("last_kind").over(before)
    legal = functools.reduce(lambda x, y: x | y, [(last == a) & (F.col("first_kind") == b) for a, b in sorted(_LEGAL)])
    seams = solved.drop("stays").withColumns(
        {
            "_seam": F.when(last.isNull() | legal, 0).otherwise(1).cast("long"),
            "_same": (F.lag("high_turn").over(before) == F.col("low_turn")).cast("long"),
        }
    )
    total = lambda name: F.sum(name).alias(name)
    wide = "decimal(38,0)"
    summed = seams.groupBy(*_CONV).agg(
        (F.max("high_turn").cast(wide) - F.min("low_turn").cast(wide) + 1).alias("_span"),
        (F.sum("distinct_turns") - F.coalesce(F.sum("_same"), F.lit(0))).alias("_distinct"),
        total("blank"),
        total("duplicate"),
        F.sum("late").alias("truncated"),
        (F.sum("illegal") + F.sum("_seam")).alias("illegal"),
        total("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "piece", "audit"))), lambda s: s["audit"]), "").alias("audit"),
    )
    gap = F.when(F.col("_span").isNull(), F.lit(0)).otherwise((F.col("_span") - F.col("_distinct")).try_cast("long")).alias("gaps")
    return summed.select(_conv_id(), gap, "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def repair(turns: DataFrame, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """A report of each conversation and the turns of the repaired ones.

    ``turns`` has conv_id, turn, role and text. The report has conv_id, gaps,
    blank, duplicate, truncated, illegal, cost and audit. Repaired turns have
    conv_id, ``place``, which orders the turns of a conversation, turn, role, text and edit.
    ``partitions`` fixes the number of ranges that turns are sorted into.
    """
    keyed = _keyed(turns)
    faults = _faults(keyed)
    ordered = faults.repartitionByRange(partitions, *_KEY).sortWithinPartitions(*_KEY) if partitions else faults.orderBy(*_KEY)
    ordered = checkpointed(ordered.withColumn("segment", F.spark_partition_id()))
    solved = _solved(ordered)

    stays = solved.select(*_CONV, F.inline("stays"))
    texts = keyed.groupBy(*_KEY).agg(F.any_value("text").alias("text"))
    old = stays.where(F.col("part") == 1).join(texts, _KEY)
    new = stays.where(F.col("part") != 1).withColumn("text", F.lit(""))
    repaired = old.unionByName(new).select(
        _conv_id(),
        F.struct("has_turn", "turn0", "role", "text_key", "part").alias("place"),
        F.when(F.col("has_turn"), F.col("turn0")).alias("turn"),
        F.col("new_role").alias("role"),
        "text",
        "edit",
    )
    return _report(solved), repaired


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the lines ``role:text`` of each conversation.

    A digest is made in order, so a conversation is read by one task; it is
    streamed, not held.
    """
    schema, arrow = _schema("conv_id long, sha256 string")

    def run(batches):
        current, digest, made = None, None, []
        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if digest is None or conv != current:
                    if digest is not None:
                        made.append((current, digest.hexdigest()))
                    current, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode("utf-8"))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*made), arrow)], schema=arrow)
                made = []
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([digest.hexdigest()])], schema=arrow)

    dealt = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return dealt.select("conv_id", "role", "text").mapInArrow(run, schema)
