"""Conversation repair against an enumeration of all edits."""

import hashlib
import random
import re
import zlib

import pytest

from climagrid.llm import repair

GOAL = re.compile("(s?(ua)+)?")
SPACE = " \t\n\v\f\r"


def brute_damage(rows):
    """(turn, role, text) of one conversation after damage, in order."""
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, f"{r[1]}:{r[2]}".encode()))


def brute_repair(rows):
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
    best = [5 * len(rows) + 50, None, None]

    def go(i, cost, audit, made):
        if cost > best[0]:
            return
        initials = "".join(r[:1] if r[:1] in ("s", "u", "a") else "x" for r, _ in made)
        if not re.fullmatch("(s?(ua)*u?)?", initials):
            return
        if i == len(rows) and GOAL.fullmatch(initials):
            if (cost, audit) < (best[0], best[1] or "~"):
                best[:] = [cost, audit, made]
        if i < len(rows):
            _, role, text = rows[i]
            go(i + 1, cost + 2, audit + "D", made)
            extra = 5 if faults[i] == "truncated" else 0
            if faults[i] not in ("blank", "duplicate"):
                go(i + 1, cost + extra, audit + "K", [*made, (role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, cost + extra + 1, audit + "R", [*made, (new, text)])
        if len(audit) - i < 4:
            for new in ("user", "assistant"):
                go(i, cost + 5, audit + "I", [*made, (new, "")])

    go(0, 0, "", [])
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [(a[1][:1] + b[1][:1]) for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(p not in ("su", "ua", "au") for p in pairs), best[0], best[1],
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in best[2]).encode()).hexdigest(),
    )


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return {key: (0,) * 6 + ("", hashlib.sha256(b"").hexdigest()) if not brute_damage(g) else brute_repair(brute_damage(g)) for key, g in groups.items()}


def random_rows(count, longest, seed):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "No", "a b!", "", " \n", None, "why?", "é 😀.", "so: then"]
    for conv in [None, *range(count)]:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]) if rng.random() < 0.4 else ("user", "assistant")[turn % 2]
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 2]), role, rng.choice(texts) if rng.random() < 0.6 else f"text {turn}."))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block_rows", [repair.BLOCK_ROWS, 2])
def test_repair_is_the_cheapest_and_least(spark, block_rows):
    rows = random_rows(60, 6, block_rows)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "turn AS block", "role AS audit", "text AS n")
    found = repair.repair(repair.damaged(table), block_rows=block_rows).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in found} == brute(rows) and len(found) == 61


def test_walk_needs_no_more_than_checkpoints():
    rng = random.Random(5)
    codes = [rng.choice([0, 1, 2, 3, 5, 6, 8]) for _ in range(3000)]
    again = [0] * len(codes)
    made = list(repair.walk(codes, again, repair.FINISH, repair.START))
    assert [i for i, _, _ in made] == list(range(3000))
    cost, state = 0, repair.START
    for i, edits, after in made:
        for one in edits:
            late = 5 if codes[i] & 4 and codes[i] != 8 else 0
            cost += {"I": 5, "K": late, "R": 1 + late, "D": 2}[one]
        cost += 2 * (codes[i] == 8)
        state = after
    total, relative = repair._back(repair.FINISH, codes, again, 0, len(codes))
    assert cost + repair.FINISH[state] == total + relative[repair.START]


def test_one_conversation_of_many_rows(spark):
    """A conversation over many partitions and blocks equals the same one in a single block."""
    roles = ["user", "assistant", "assistant", "system", "user"]
    rows = [(7, i, roles[i % 5], f"text {i % 700}" + (".", "", "?")[i % 3]) for i in range(5000)] + [(7, 3, "user", "same.")] * 2000
    table = repair.damaged(spark.createDataFrame(rows, SCHEMA).repartition(8))
    parts = repair.repair(table, block_rows=37).collect()
    order = sorted(table.collect(), key=lambda r: (r["turn"] is not None, r["turn"] or 0, f"{r['role']}:{r['text']}".encode()))
    whole = repair._repair_whole(*[[r[c] for r in order] for c in ("role", "text", "n", "turn")])
    assert len(parts) == 1 and parts[0].asDict() == {"conv_id": 7, **whole}


def test_repair_of_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.report(empty).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    long_text = "word " * 200_000 + "."
    rows = [(dropped, 0, "user", "gone."), (-5, None, None, None), (-6, 1, "user", long_text), (-6, 2, "assistant", long_text)]
    found = {r["conv_id"]: tuple(r)[1:] for r in repair.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == brute(rows)
    assert found[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
