"""Repair of conversations against a plain search over all edits."""

import hashlib
import random
import zlib

import pytest
from logquarry.llm import repair
from pyspark.sql import functions as F

SPACES = " \t\n\v\f\r"


def plain(rows):
    """The contract's columns of one conversation's rows ``(turn, role, text)``, by dynamic programming
    over whole audits and texts."""
    n = len(rows)
    seen, fault = set(), []
    for turn, role, text in rows:
        solid = text.rstrip(SPACES)
        fault.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    named = {"u": "user", "a": "assistant"}
    best = {q: (0, "", ()) for q in ("", "a")}
    for i in range(n, -1, -1):
        if i < n:
            (_, role, text), after, best = rows[i], best, {}
            extra = 5 if fault[i] == "t" else 0
            for q in ("", "s", "u", "a"):
                tries = [(after[q][0] + 2, "D" + after[q][1], after[q][2])]
                if fault[i] not in ("b", "d"):
                    to = follows[q]
                    line = (named[to] + ":" + text,)
                    tries.append((after[to][0] + 1 + extra, "R" + after[to][1], line + after[to][2]))
                    k = role[:1]
                    if k and (k == to or (k == "s" and q == "")):
                        tries.append((after[k][0] + extra, "K" + after[k][1], (role + ":" + text,) + after[k][2]))
                best[q] = min(tries)
        for _ in range(3):
            for q, to in follows.items():
                if to in best:
                    c, audit, lines = best[to]
                    new = (c + 5, "I" + audit, (named[to] + ":",) + lines)
                    best[q] = min(best.get(q, new), new)
    cost, audit, lines = best[""]
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, fault.count("b"), fault.count("d"),
            fault.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damage(table):
    """Rows by conversation, as the contract damages them."""
    out = {}
    for conv, turn, role, text in table:
        rows = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        role = "user" if fate == 4 else role
        rows += [(turn, role, text)] * (2 if fate == 3 else 1)
    for rows in out.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def table_of(rng, convs, turns):
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, turns)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "why", "Was? ", " \n", None, "Été. \v", "a b c", "one.", f"t{turn}."])
            rows.append((conv, rng.choice([turn, turn, None, 3]), role, text))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("chunk_rows,fixups", [(1 << 15, 4), (3, 4), (3, 0), (1, 1)])
def test_against_plain_search(spark, chunk_rows, fixups):
    rng = random.Random(chunk_rows)
    table = table_of(rng, 40, 30) + [(None, 1, "user", "a."), (None, None, None, None)]
    df = spark.createDataFrame(table, SCHEMA).withColumns({"n": F.lit(1), "code": F.lit("x"), "place": F.lit(2)})
    wanted = {c: plain(rows) for c, rows in damage(table).items()}
    assert found(repair.repair(df, chunk_rows, fixups)) == wanted


def test_one_long_conversation_in_chunks(spark):
    """Users alone: chunks that never forget what they started from."""
    table = [(7, i, "user", f"line {i}.") for i in range(400)] + [(8, 0, "user", "x."), (8, 0, "user", "x.")] * 300
    df = spark.createDataFrame(table, SCHEMA)
    wanted = {c: plain(rows) for c, rows in damage(table).items()}
    for fixups in (0, 2):
        assert found(repair.repair(df, 16, fixups)) == wanted


def test_empty_table_and_types(spark):
    assert repair.repair(spark.createDataFrame([], SCHEMA)).count() == 0
    named = spark.createDataFrame([("c", 0, "user", "a."), ("c", 1, "assistant", "b!")], "conv_id string, turn int, role string, text string")
    assert {r.conv_id for r in repair.repair(named).collect()} == {"c"}
