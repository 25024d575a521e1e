"""Conversation repair against all repairs of small conversations."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from reelstar.llm import conversation_repair as cr
from reelstar.llm.queries import damaged

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def legal(roles: str) -> bool:
    rest = roles[1:] if roles[:1] == "s" else roles
    return not roles or (len(rest) > 0 and rest == "ua" * (len(rest) // 2))


def faults(rows):
    """Fault of each (role, text) of a conversation in order."""
    out, seen = [], set()
    for role, text in rows:
        body = text.strip(SPACE)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows, found):
    """(cost, audit, lines) by trying everything up to the best cost."""
    best = {}

    def go(i, roles, cost, audit, lines, inserts):
        if cost > best.get("cost", 10 ** 9):
            return
        if i == len(rows) and legal(roles):
            if (cost, audit) < (best.get("cost", 10 ** 9), best.get("audit", "Z")):
                best.update(cost=cost, audit=audit, lines=list(lines))
        if inserts < 2:
            for r in ("user", "assistant"):
                go(i, roles + r[0], cost + 5, audit + "I", [*lines, r + ":"], inserts + 1)
        if i == len(rows):
            return
        role, text = rows[i]
        go(i + 1, roles, cost + 2, audit + "D", lines, 0)
        if found[i] in ("blank", "duplicate"):
            return
        extra = 5 if found[i] == "truncated" else 0
        go(i + 1, roles + (role[:1] or "?"), cost + extra, audit + "K", [*lines, f"{role}:{text}"], 0)
        for r in ("user", "assistant"):
            go(i + 1, roles + r[0], cost + extra + 1, audit + "R", [*lines, f"{r}:{text}"], 0)

    # an upper bound first: delete all
    best.update(cost=2 * len(rows), audit="D" * len(rows), lines=[])
    go(0, "", 0, "", [], 0)
    return best["cost"], best["audit"], best["lines"]


def expected(rows):
    """Result of (turn, role, text) rows after damage, in order."""
    pairs = [(r or " " if r is None else r, " " if x is None else x) for _, r, x in rows]
    found = faults(pairs)
    cost, audit, lines = brute(pairs, found)
    turns = [t for t, _, _ in rows if t is not None]
    return {"rows": len(rows), "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            "blank": found.count("blank"), "duplicate": found.count("duplicate"),
            "truncated": found.count("truncated"),
            "illegal": sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:], strict=False)),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, " " if r[1] is None else r[1],
                                       " " if r[2] is None else r[2]))


def some_rows(rng, n):
    text = ["Yes.", "No!", "cut off", "", " \t", "Why?", "Yes. ", "ü。", None, "one two."]
    return [(rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]),
             rng.choice(text)) for _ in range(n)]


def by_conversation(df):
    return {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in df.collect()}


@pytest.mark.parametrize("piece_rows", [1, 2, 3, 2000])
def test_equals_all_repairs(spark, piece_rows):
    rng = random.Random(piece_rows)
    convs = {i if i else None: some_rows(rng, rng.randint(1, 6)) for i in range(60)}
    data = [(c, *r) for c, rows in convs.items() for r in rows]
    rng.shuffle(data)
    got = by_conversation(cr.together(cr.repair(spark.createDataFrame(data, SCHEMA), piece_rows=piece_rows)))
    assert got == {c: expected(ordered(rows)) for c, rows in convs.items()}


def test_long_conversation_in_pieces_equals_whole(spark):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Ja.", "nein", f"t{t}.", ""])) for t in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = by_conversation(cr.together(cr.repair(df, piece_rows=10_000)))
    cut = cr.repair(df, piece_rows=50)
    assert cut.filter("NOT whole").count() >= 18
    assert by_conversation(cr.together(cut)) == whole
    audit = whole[7]["audit"]
    assert whole[7]["rows"] == 900 and len(audit) - audit.count("I") == 900


def test_one_row_repeated_many_times(spark):
    df = spark.range(5000).selectExpr("1L AS conv_id", "3L AS turn", "'user' AS role", "'Hi.' AS text")
    got = by_conversation(cr.together(cr.repair(df, piece_rows=300)))[1]
    assert (got["duplicate"], got["illegal"], got["rows"], got["gaps"]) == (4999, 4999, 5000, 0)
    assert got["cost"] == 2 * 5000 and got["audit"] == "D" * 5000


def test_damage_and_gone_conversations(spark):
    convs = [(c, t, role, "Well, so be it! Yes.") for c in range(200) for t, role in enumerate(["user", "assistant"])]
    df = spark.createDataFrame(convs, SCHEMA)
    after = {}
    for c, t, role, text in convs:
        fault = zlib.crc32(f"{c}:{t}".encode()) % 20
        rows = after.setdefault(c, [])
        if fault == 0:
            continue
        row = (t, "user" if fault == 4 else role, "" if fault == 1 else "Well, so be it Yes" if fault == 2 else text)
        rows += [row] * (2 if fault == 3 else 1)
    got = by_conversation(cr.together(cr.repair(damaged(df), copies_col="copies")))
    assert got == {c: expected(rows) for c, rows in after.items()}
    gone = [c for c, rows in after.items() if not rows]
    for c in gone:
        assert got[c]["audit"] == "" and got[c]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_conversation_of_dropped_rows_alone(spark):
    dropped = [(c, 0, "user", "x.") for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = by_conversation(cr.together(cr.repair(damaged(spark.createDataFrame(dropped, SCHEMA)), copies_col="copies")))
    assert len(got) == len(dropped) > 0
    assert all(g == expected([]) for g in got.values())


def test_empty_table_long_text_and_clashing_columns(spark):
    assert cr.together(cr.repair(spark.createDataFrame([], SCHEMA))).count() == 0
    long = "word " * 400_000 + "."
    df = spark.createDataFrame([("c", 1, "user", long, 1, 2), ("c", 2, "assistant", "Ok.", 1, 2), ("d", 1, "user", "Hm.", 1, 2)],
                               "conv_id string, turn int, role string, text string, piece int, _c int")
    got = by_conversation(cr.together(cr.repair(df)))
    assert got["c"] == expected([(1, "user", long), (2, "assistant", "Ok.")])
    assert got["d"]["audit"] == "D"
