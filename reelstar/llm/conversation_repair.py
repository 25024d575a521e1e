"""Cheapest repair of conversations by Hirschberg's divide and conquer.

A repaired conversation reads, by the first letters of its roles, like
``(s?(ua)+)?``: nothing, or turns of user and assistant, with one system row before
them at most. Edits and their costs: Keep a row 0, Rerole it to user or assistant
1, Delete it 2 (blank rows and repeats have to go), Insert an empty row of a user or an
assistant 5; a truncated row that stays costs 5 more. Of all cheapest sequences of
edits the one of the least audit string (their initials, as ASCII) is taken.

The grammar has four states: nothing yet, after a system row, after a user row,
after an assistant row. A row is a 4 x 4 transfer: what it costs, inserts before it
included, to get from one state to another. ``boundaries`` meets forward and backward
cost vectors in the middle of a sequence, picks the crossing state on the cheapest way,
and recurses on both halves, so no table of all vectors is kept. Which of
several cheapest crossings has the least audit is known from the forward vector: it
carries, beside four costs, the order of the four states' least audits. (Each audit
ends in the edit of the same row, so none is the beginning of another, and
what follows can't change their order.)

Rows are dealt to tasks by ranges of (conversation, turn, role, text), so a
conversation of any length is spread over many tasks in order. Each task cuts what it
reads into pieces of at most ``PIECE_ROWS`` rows or ``PIECE_CHARS`` characters. A
conversation that is whole in one piece is settled there. The pieces of others
are met once more: first sightings of a row across pieces come from a window over
hashes, a piece's transfer is the product of its rows', and the same ``boundaries``
over the transfers of a conversation's pieces gives each piece its end states.

Defined results: rows are ordered by turn (nulls first), then role, then text; equal
rows are counted, not carried along. A null role or text is one space, a
null conversation is a conversation of its own. A row of no copies counts for nothing, but its
conversation is reported. Further columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstar.llm.common import arrow_batches, durable

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: A piece ends with the row that reaches either bound.
PIECE_ROWS = 2_000
PIECE_CHARS = 1_000_000
#: Characters of a text that help to deal rows to tasks.
RANGE_CHARS = 64

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"
LEGAL = frozenset({"su", "ua", "au"})
INF = 1 << 40
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a kept row of that initial.
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The state after an inserted or reroled row.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: Inserts that end a conversation in each state.
CLOSING = ("", "II", "I", "")
CLOSE_COST = tuple(INSERT * len(c) for c in CLOSING)
#: From any state the future of any other can be had for this much more: two
#: inserts, or an insert and a deletion. States further behind are never on a cheapest way.
SLACK = 2 * INSERT

Matrix = tuple[tuple[int, ...], ...]
Transfer = tuple[Matrix, Matrix]                              # costs, and the order of ends for each start
Vector = tuple[tuple[int, ...], tuple[int, ...]]              # costs, and the order of states


def row_edits(code: str) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest edits of a row, least audit first, by start and end state. ``code``
    is the initial of its role (x: none of s, u, a), in upper case if the row is
    truncated, or d if it has to go."""
    out: dict[tuple[int, int], tuple[int, str]] = {}
    extra = TRUNCATED if code.isupper() else 0
    for start in range(4):
        state, prefix = start, ""
        for _ in range(3):
            ways = [(state, DELETE, "D")]
            if code != "d":
                kept = STEP.get((state, code.lower()))
                if kept is not None:
                    ways.append((kept, KEEP + extra, "K"))
                ways.append((NEXT[state], REROLE + extra, "R"))
            for end, cost, edit in ways:
                found = (cost + INSERT * len(prefix), prefix + edit)
                out[start, end] = min(out.get((start, end), (INF, "")), found)
            state, prefix = NEXT[state], prefix + "I"
    return out


CODES = "suaxSUAXd"
EDITS = {c: row_edits(c) for c in CODES}


def _ordered(cells: list[tuple | None]) -> tuple[int, ...]:
    """Place of each cell among all that are there."""
    rank = {c: i for i, c in enumerate(sorted(c for c in cells if c is not None))}
    return tuple(rank[c] if c is not None else len(cells) for c in cells)


def _row_transfer(code: str) -> Transfer:
    edits = EDITS[code]
    costs = tuple(tuple(edits.get((p, t), (INF, ""))[0] for t in range(4)) for p in range(4))
    order = tuple(_ordered([(edits[p, t][1],) if (p, t) in edits else None for t in range(4)]) for p in range(4))
    return costs, order


ROW = {c: _row_transfer(c) for c in CODES}


def unit(state: int) -> Vector:
    return tuple(0 if s == state else INF for s in range(4)), tuple(0 if s == state else 4 for s in range(4))


@lru_cache(maxsize=200_000)
def _forward(vector: Vector, transfer: Transfer) -> tuple[int, Vector]:
    (costs, order), (steps, ends) = vector, transfer
    best = [min((costs[p] + steps[p][t], order[p], ends[p][t]) for p in range(4)) for t in range(4)]
    least = min(b[0] for b in best)
    alive = [b if b[0] < INF and b[0] <= least + SLACK else None for b in best]
    return least, (tuple(INF if b is None else b[0] - least for b in alive),
                   _ordered([None if b is None else b[1:] for b in alive]))


@lru_cache(maxsize=200_000)
def _backward(costs: tuple[int, ...], steps: Matrix) -> tuple[int, tuple[int, ...]]:
    out = [min(min(steps[p][t] + costs[t] for t in range(4)), INF) for p in range(4)]
    least = min(out)
    return least, tuple(c - least if c < INF else INF for c in out)


def forward(vector: Vector, transfers: Sequence[Transfer], lo: int, hi: int) -> tuple[int, Vector]:
    """Cost vector after the transfers lo..hi, and what was taken off its costs."""
    total = 0
    for i in range(lo, hi):
        least, vector = _forward(vector, transfers[i])
        total += least
    return total, vector


def backward(costs: tuple[int, ...], transfers: Sequence[Transfer], lo: int, hi: int) -> tuple[int, ...]:
    """Costs, up to a constant, from each state before ``lo`` to the end."""
    for i in range(hi - 1, lo - 1, -1):
        costs = _backward(costs, transfers[i][0])[1]
    return costs


def _least(vector: Vector, costs: Sequence[int]) -> int:
    return min(range(4), key=lambda s: (vector[0][s] + costs[s], vector[1][s]))


def boundaries(transfers: Sequence[Transfer], start: int, end: int) -> list[int]:
    """States before, between and after the transfers, on the cheapest way of the least audit."""
    states = [start] * (len(transfers) + 1)
    states[-1] = end
    work = [(0, len(transfers))]
    while work:
        lo, hi = work.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        ahead = forward(unit(states[lo]), transfers, lo, mid)[1]
        states[mid] = _least(ahead, backward(unit(states[hi])[0], transfers, mid, hi))
        work += [(lo, mid), (mid, hi)]
    return states


def last_state(transfers: Sequence[Transfer]) -> int:
    """Where the best repair of a whole conversation ends, before its closing inserts."""
    return _least(forward(unit(START), transfers, 0, len(transfers))[1], CLOSE_COST)


def product(transfers: Sequence[Transfer]) -> Transfer:
    """One transfer for a whole piece."""
    costs, order = [], []
    for p in range(4):
        total, (end, ends) = forward(unit(p), transfers, 0, len(transfers))
        costs.append(tuple(total + c if c < INF else INF for c in end))
        order.append(ends)
    return tuple(costs), tuple(order)


Row = tuple[int | None, str, str, int]                        # turn, role, text, copies


def key_of(role: str, text: str) -> bytes:
    head = role.encode("utf-8", "surrogatepass")
    return hashlib.sha256(b"%d:%b%b" % (len(head), head, text.encode("utf-8", "surrogatepass"))).digest()


def examine(rows: list[Row], known: frozenset[int] | set[int] = frozenset()) -> dict:
    """Faults of a piece; ``known`` are the places of rows that an earlier piece has, too."""
    seen: set[tuple[str, str]] = set()
    codes: list[str] = []
    out = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    before = None
    for i, (_, role, text, copies) in enumerate(rows):
        body = text.rstrip(SPACE)
        initial = role[:1]
        if not body:
            out["blank"] += copies
            codes.append("d" * copies)
        else:
            code, again = initial if initial in "sua" and initial else "x", copies - 1
            if i in known or (role, text) in seen:
                code, again = "d", copies
            elif body[-1] not in ENDS:
                out["truncated"] += 1
                code = code.upper()
            seen.add((role, text))
            out["duplicate"] += again
            codes.append(code + "d" * (copies - 1))
        if before is not None and before + initial not in LEGAL:
            out["illegal"] += 1
        out["illegal"] += copies - 1                          # equal initials never follow one another
        before = initial
    turns = [t for t, _ in groupby(r[0] for r in rows) if t is not None]
    return out | {"codes": "".join(codes), "rows": sum(r[3] for r in rows),
                  "first_initial": rows[0][1][:1] if rows else None, "last_initial": before,
                  "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
                  "turns": len(turns)}


def apply(rows: list[Row], codes: str, states: list[int], closing: bool) -> tuple[int, str, list[str]]:
    """Cost, audit and repaired ``role:text`` lines of a piece."""
    cost, audit, lines = 0, [], []
    spread = ((role, text) for _, role, text, copies in rows for _ in range(copies))
    for i, (role, text) in enumerate(spread):
        price, edits = EDITS[codes[i]][states[i], states[i + 1]]
        cost += price
        audit.append(edits)
        state = states[i]
        for e in edits:
            if e == "I":
                state = NEXT[state]
                lines.append(ROLE_OF[state] + ":")
            elif e == "K":
                lines.append(f"{role}:{text}")
            elif e == "R":
                lines.append(f"{ROLE_OF[NEXT[state]]}:{text}")
    if closing:
        state = states[-1]
        audit.append(CLOSING[state])
        cost += CLOSE_COST[state]
        for _ in CLOSING[state]:
            state = NEXT[state]
            lines.append(ROLE_OF[state] + ":")
    return cost, "".join(audit), lines


FACTS = ("rows long, blank long, duplicate long, truncated long, illegal long, first_initial string, "
         "last_initial string, first_turn long, last_turn long, turns long")
RESULT = f"{FACTS}, cost long, audit string, repaired string"
ROWS = "array<struct<turn: bigint, role: string, text: string, copies: bigint>>"


def _result(rows: list[Row], facts: dict, start: int | None, end: int | None) -> dict:
    """A piece's result; without end states it is a whole conversation."""
    transfers = [ROW[c] for c in facts["codes"]]
    closing = end is None
    if closing:
        start, end = START, last_state(transfers)
    cost, audit, lines = apply(rows, facts["codes"], boundaries(transfers, start, end), closing)
    return {k: v for k, v in facts.items() if k != "codes"} | {
        "cost": cost, "audit": audit, "repaired": "\n".join(lines) if lines else None}


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(schema_like: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema_like.schema)


def _empty(spark, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def cut(dealt: DataFrame, kind: str, piece_rows: int, piece_chars: int) -> DataFrame:
    """Pieces of the sorted partitions of ``dealt``: whole conversations with their
    result, the others with their rows."""
    out_schema = f"_c {kind}, piece long, whole boolean, {RESULT}, items {ROWS}"
    arrow = _arrow(_empty(dealt.sparkSession, out_schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # pieces are numbered in the order of the partitions, and within one
        base = TaskContext.get().partitionId() << 32
        made, ready, size = 0, [], 0

        def emit(conv, rows: list[Row], whole: bool) -> None:
            nonlocal made, size
            row = {"_c": conv, "piece": base + made, "whole": whole, "items": None}
            if whole:
                row |= _result(rows, examine(rows), None, None)
            else:
                row["items"] = [dict(zip(("turn", "role", "text", "copies"), r, strict=True)) for r in rows]
            made += 1
            size += sum(len(r[2]) for r in rows) + len(rows) * 20
            ready.append(row)

        current, rows, chars, n, split, first, started = None, [], 0, 0, False, True, False
        for batch in batches:
            for conv, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True):
                if not started or conv != current:
                    if started:
                        # the first conversation of a partition may have begun in an earlier one
                        emit(current, rows, not (split or first))
                        first = False
                    current, rows, chars, n, split, started = conv, [], 0, 0, False, True
                while copies > 0:
                    take = min(copies, piece_rows - n)
                    rows.append((turn, role, text, take))
                    copies, n, chars = copies - take, n + take, chars + len(text)
                    if n >= piece_rows or chars >= piece_chars:
                        emit(current, rows, False)
                        rows, chars, n, split = [], 0, 0, True
                if size >= 2_000_000:
                    yield _table(ready, arrow)
                    ready, size = [], 0
        if started:
            emit(current, rows, False)                        # and the last may go on in a later one
        if ready:
            yield _table(ready, arrow)

    return dealt.mapInArrow(run, out_schema)


def _earlier(pieces: DataFrame, kind: str) -> DataFrame:
    """``(_c, piece, known)``: places of the rows that an earlier piece has, too."""
    schema = f"_c {kind}, piece long, place int, seen binary"
    arrow = _arrow(_empty(pieces.sparkSession, schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, met = [], set()
            for conv, piece, items in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                met.clear()
                for i, r in enumerate(items):
                    if r["text"].rstrip(SPACE):
                        key = key_of(r["role"], r["text"])
                        if key not in met:
                            met.add(key)
                            out.append({"_c": conv, "piece": piece, "place": i, "seen": key})
            yield _table(out, arrow)

    keys = pieces.select("_c", "piece", "items").mapInArrow(run, schema)
    # a piece names a row once, so a window holds no more rows than a conversation has pieces
    window = Window.partitionBy("_c", "seen").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    return (keys.withColumn("before", F.min("piece").over(window)).filter("before IS NOT NULL")
            .groupBy("_c", "piece").agg(F.collect_list("place").alias("known")))


def _rows_of(items: list[dict]) -> list[Row]:
    return [(r["turn"], r["role"], r["text"], r["copies"]) for r in items]


def settle(pieces: DataFrame, kind: str) -> DataFrame:
    """Results of pieces whose conversations have several."""
    spark = pieces.sparkSession
    known = _earlier(pieces, kind)
    same = pieces["_c"].eqNullSafe(known["_c"]) & (pieces["piece"] == known["piece"])
    open_ = durable(pieces.join(known, same, "left").select(pieces["_c"], pieces["piece"], "items", "known"), "open")

    sums_schema = f"_c {kind}, piece long, costs array<long>, orders array<int>"
    sums_arrow = _arrow(_empty(spark, sums_schema))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, piece, items, known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes = examine(_rows_of(items), set(known or ()))["codes"]
                costs, order = product([ROW[c] for c in codes])
                out.append({"_c": conv, "piece": piece, "costs": [c for r in costs for c in r],
                            "orders": [o for r in order for o in r]})
            yield _table(out, sums_arrow)

    ends_schema = f"_c {kind}, piece long, start int, end int, closing boolean"
    ends_arrow = _arrow(_empty(spark, ends_schema))

    def meet(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("piece", "costs", "orders", "_c")), strict=True))
        square = lambda flat: tuple(tuple(flat[i:i + 4]) for i in range(0, 16, 4))
        transfers = [(square(costs), square(orders)) for _, costs, orders, _ in rows]
        states = boundaries(transfers, START, last_state(transfers))
        return pa.Table.from_pylist(
            [{"_c": r[3], "piece": r[0], "start": states[i], "end": states[i + 1], "closing": i == len(rows) - 1}
             for i, r in enumerate(rows)], schema=ends_arrow)

    # sixteen numbers a piece come together by conversation, no rows of it
    ends = (open_.mapInArrow(sums, sums_schema).groupBy("_c").applyInArrow(meet, ends_schema))

    schema = f"_c {kind}, piece long, whole boolean, {RESULT}"
    arrow = _arrow(_empty(spark, schema))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, piece, items, known, start, end, closing in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                rows = _rows_of(items)
                facts = examine(rows, set(known or ()))
                states = boundaries([ROW[c] for c in facts["codes"]], start, end)
                cost, audit, lines = apply(rows, facts.pop("codes"), states, closing)
                out.append(facts | {"_c": conv, "piece": piece, "whole": False, "cost": cost, "audit": audit,
                                    "repaired": "\n".join(lines) if lines else None})
            yield _table(out, arrow)

    same = open_["_c"].eqNullSafe(ends["_c"]) & (open_["piece"] == ends["piece"])
    return (open_.join(ends, same).select(open_["_c"], open_["piece"], "items", "known", "start", "end", "closing")
            .mapInArrow(finish, schema))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", copies_col: str | None = None, piece_rows: int = PIECE_ROWS,
           piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Repaired conversations in pieces: ``(conv, piece, whole, rows, blank,
    duplicate, truncated, illegal, first_initial, last_initial, first_turn, last_turn,
    turns, cost, audit, repaired)``.

    ``whole`` pieces are whole conversations; the others follow one another by
    ``piece``, and ``together`` adds them up. ``repaired`` has the
    ``role:text`` lines, null if there is none.
    """
    spark = rows.sparkSession
    kind = rows.schema[conv_col].dataType.simpleString()
    copies = F.col(copies_col).cast("long") if copies_col else F.lit(1).cast("long")
    there = copies > 0
    text = lambda c: F.when(there, F.coalesce(F.col(c), F.lit(" "))).otherwise(F.lit(""))
    one = rows.select(F.col(conv_col).alias("_c"), F.when(there, F.col(turn_col).cast("long")).alias("_t"),
                      text(role_col).alias("_r"), text(text_col).alias("_x"), F.greatest(copies, F.lit(0)).alias("_n"))
    counted = one.groupBy("_c", "_t", "_r", "_x").agg(F.sum("_n").alias("_n"))
    with arrow_batches(spark, 256):
        dealt = (counted.repartitionByRange("_c", "_t", "_r", F.substring("_x", 1, RANGE_CHARS))
                 .sortWithinPartitions("_c", "_t", "_r", "_x"))
        pieces = durable(cut(dealt, kind, piece_rows, piece_chars), "pieces")
        rest = durable(settle(pieces.filter(~F.col("whole")), kind), "settled")
    return (pieces.filter("whole").drop("items").unionByName(rest)
            .withColumnRenamed("_c", conv_col))


def together(pieces: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation: ``(conv, rows, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256)``. The hash of a conversation in several
    pieces is taken piece by piece in order; nothing but the audit grows with it."""
    spark = pieces.sparkSession
    kind = pieces.schema[conv_col].dataType.simpleString()
    names = "rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    schema = f"_c {kind}, {names}, repaired_sha256 string"
    arrow = _arrow(_empty(spark, schema))
    summed = ("rows", "blank", "duplicate", "truncated", "illegal", "cost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None

        def done() -> pa.RecordBatch:
            span = 0 if state["first_turn"] is None else state["last_turn"] - state["first_turn"] + 1 - state["turns"]
            row = {k: state[k] for k in ("_c", *summed)}
            return _table([row | {"gaps": span, "audit": "".join(state["audit"]),
                                  "repaired_sha256": state["hash"].hexdigest()}], arrow)

        for batch in batches:
            for r in batch.to_pylist():
                if state is None or r["_c"] != state["_c"]:
                    if state is not None:
                        yield done()
                    state = {"_c": r["_c"], "audit": [], "hash": hashlib.sha256(), "any": False, "turns": 0,
                             "first_turn": None, "last_turn": None, "last_initial": None} | dict.fromkeys(summed, 0)
                for k in summed:
                    state[k] += r[k]
                state["audit"].append(r["audit"])
                if r["repaired"] is not None:
                    state["hash"].update((b"\n" if state["any"] else b"")
                                         + r["repaired"].encode("utf-8", "surrogatepass"))
                    state["any"] = True
                if r["rows"]:
                    if state["last_initial"] is not None and state["last_initial"] + r["first_initial"] not in LEGAL:
                        state["illegal"] += 1
                    state["last_initial"] = r["last_initial"]
                if r["turns"]:
                    # a turn cut in two counts once
                    state["turns"] += r["turns"] - (state["last_turn"] == r["first_turn"])
                    if state["first_turn"] is None:
                        state["first_turn"] = r["first_turn"]
                    state["last_turn"] = r["last_turn"]
        if state is not None:
            yield done()

    named = pieces.withColumnRenamed(conv_col, "_c")
    whole = named.filter("whole").select(
        "_c", "rows", F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0).cast("long"))
        .alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(F.coalesce("repaired", F.lit("")), 256).alias("repaired_sha256"))
    with arrow_batches(spark, 16):
        rest = durable(named.filter(~F.col("whole")).repartition("_c").sortWithinPartitions("_c", "piece")
                       .mapInArrow(run, schema), "together")
    return whole.unionByName(rest).withColumnRenamed("_c", conv_col)
