"""Repair of conversation structure by a checkpointed dynamic program.

A conversation is repaired by edits of its rows until the initials of its roles read ``(s?(ua)+)?``: Keep costs 0, Rerole (to user or
assistant) 1, Delete 2, Insert (an empty user or assistant row, anywhere) 5; a truncated row that is not deleted costs 5 more; blank and
duplicate rows must be deleted. Of the cheapest edits those with the ASCII-least initials are taken.

The pattern is an automaton of four states, so what lies behind a row is summed up by four costs, one per state. They are computed from
the end: every sqrt(n) rows they are kept as a checkpoint, all others are forgotten. Walking forward, the costs between two
checkpoints are computed again, and in each state the first tight edit in the order Delete, Insert, Keep, Rerole is written. Memory is
of the order of sqrt(n) vectors.

Rows are sorted by ranges of (conversation, turn) and cut into blocks of at most ``BLOCK_ROWS`` rows and ``BLOCK_BYTES`` of text. A
conversation inside one block, with its neighbours next to it, is repaired where it lies. The others are repaired by blocks, so that
one conversation may hold any part of the table:

1. each block gives the costs from every state before it to every state behind it, and from these the costs behind each block follow,
   one small row per block;
2. each block walks from every state and tells in which state it ends, from which the state before each block follows;
3. each block writes its edits and rows. They are put through the digest in order, block by block.

Defined results: equal rows of a conversation are counted before they move and are neighbours; rows with one turn are in order of their
``role:text``; NULL role and text are one space, as is a NULL turn or conversation in the hash; NULL is a conversation of its own; a
role is known by its first character, and an empty one fits nowhere; a conversation without rows after damage has zeros, an empty audit
and the digest of nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climagrid.llm.common import bound_batches, stored

BLOCK_ROWS = 16_384
BLOCK_BYTES = 4 << 20
# Characters of ``role:text`` that take part in cutting ranges.
RANGE_CHARS = 128
_SPACE = " \t\n\v\f\r"
_ENDS = ".!?"

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
# The state after the row that Insert or Rerole can make in a state, and its role.
_MADE = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
# Codes of rows: the initial's class, plus 4 if truncated; 8 for rows that must go.
_CLASS = {"s": 0, "u": 1, "a": 2}
_OTHER, _TRUNCATED, GONE = 3, 4, 8
_KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
_LEGAL = {(0, 1), (1, 2), (2, 1)}
Costs = tuple[float, float, float, float]


def _closed(costs: list[float]) -> list[float]:
    """Costs after any number of inserts; two are enough, since two more lead back."""
    for _ in range(2):
        costs = [min(costs[q], INSERT + costs[_MADE[q]]) for q in STATES]
    return costs


# Behind the last row a conversation may be empty or end with an assistant row.
FINISH: Costs = tuple(_closed([0.0, math.inf, math.inf, 0.0]))


def _kept(state: int, code: int) -> int | None:
    return _KEPT.get((state, code & 3)) if code & 3 != _OTHER else None


@lru_cache(1 << 16)
def before(costs: Costs, code: int) -> tuple[float, Costs]:
    """The least cost before a row and how much more each state costs, from the costs behind the row."""
    if code == GONE:
        found = [DELETE + c for c in costs]
    else:
        extra = TRUNCATED if code & _TRUNCATED else 0
        found = []
        for q in STATES:
            keep = _kept(q, code)
            kept = math.inf if keep is None else extra + costs[keep]
            found.append(min(DELETE + costs[q], kept, REROLE + extra + costs[_MADE[q]]))
        found = _closed(found)
    least = min(found)
    return least, tuple(c - least for c in found)


@lru_cache(1 << 16)
def edit(costs: Costs, code: int, state: int) -> tuple[str, int]:
    """The ASCII-least tight edits up to and including a row, and the state behind it; ``costs`` are those behind the row."""
    least, relative = before(costs, code)
    made = ""
    while True:
        left = least + relative[state]
        if DELETE + costs[state] == left:
            return made + "D", state
        following = _MADE[state]
        if INSERT + least + relative[following] == left:
            made, state = made + "I", following
            continue
        extra = TRUNCATED if code & _TRUNCATED else 0
        keep = _kept(state, code)
        if keep is not None and extra + costs[keep] == left:
            return made + "K", keep
        return made + "R", following


class Rows:
    """The rows of a block as codes; a row stands for itself and ``again`` further copies, which must go."""

    def __init__(self, roles: Sequence[str], texts: Sequence[str], counts: Sequence[int], firsts: Sequence[int] | None = None):
        """``firsts`` are the rows whose role and text have not been seen before; without it, all other rows are in the block."""
        self.codes, self.again = bytearray(), []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.opening, self.closing = None, None
        seen, new = set(), None if firsts is None else set(firsts)
        for i, (role, text, n) in enumerate(zip(roles, texts, counts)):
            if not n:  # stands for dropped rows
                self.codes.append(GONE)
                self.again.append(-1)
                continue
            kind = _CLASS.get(role[:1], _OTHER)
            if self.closing is None:
                self.opening = kind
            elif (self.closing, kind) not in _LEGAL:
                self.illegal += 1
            self.closing = kind
            self.illegal += n - 1
            bare = text.rstrip(_SPACE)
            if new is None:
                key = (role, text)
                known = key in seen
                seen.add(key)
            else:
                known = i not in new
            code = GONE
            if not bare:
                self.blank += n
            elif known:
                self.duplicate += n
            else:
                self.duplicate += n - 1
                cut_off = bare[-1] not in _ENDS
                self.truncated += cut_off
                code = kind + _TRUNCATED * cut_off
            self.codes.append(code)
            self.again.append(n - 1)


def _back(costs: Costs, codes: Sequence[int], again: Sequence[int], first: int, last: int, keep: list | None = None) -> tuple[float, Costs]:
    """(cost, relative costs) before row ``first`` from those behind row ``last - 1``; ``keep`` takes the costs behind each row."""
    total = 0.0
    for i in range(last - 1, first - 1, -1):
        if keep is not None:
            keep.append(costs)
        if codes[i] == GONE:
            total += DELETE * (again[i] + 1)  # the same for every state
        else:
            least, costs = before(costs, codes[i])
            total += least + DELETE * again[i]
    return total, costs


def walk(codes: Sequence[int], again: Sequence[int], costs: Costs, state: int) -> Iterator[tuple[int, str, int]]:
    """(row, edits, state behind it) from ``state``, with the costs behind the last row."""
    stride = math.isqrt(len(codes)) + 1
    starts = range(0, len(codes), stride)
    checkpoints = []
    for first in reversed(starts):
        checkpoints.append(costs)
        costs = _back(costs, codes, again, first, min(first + stride, len(codes)))[1]
    for first in starts:
        last = min(first + stride, len(codes))
        behind: list[Costs] = []
        _back(checkpoints.pop(), codes, again, first, last, behind)
        for i in range(first, last):
            made, state = ("", state) if codes[i] == GONE else edit(behind.pop(), codes[i], state)
            if codes[i] == GONE:
                behind.pop()
            yield i, made, state


def through(codes: Sequence[int], again: Sequence[int]) -> list[float]:
    """The least cost from every state before the rows to every state behind them, state by state before them."""
    columns = []
    for q in STATES:
        total, relative = _back(tuple(_closed([0.0 if p == q else math.inf for p in STATES])), codes, again, 0, len(codes))
        columns.append([total + c for c in relative])
    return [columns[q][p] for p in STATES for q in STATES]


def written(roles: Sequence[str], texts: Sequence[str], rows: Rows, costs: Costs, state: int, last: bool) -> tuple[str, bytes]:
    """The audit and the repaired rows of a block, as ``role:text`` lines."""
    audit, lines, at = [], [], state
    for i, made, after in walk(rows.codes, rows.again, costs, state):
        for one in made:
            if one == "I":
                at = _MADE[at]
                lines.append(f"{_ROLE[at]}:")
            elif one == "K":
                lines.append(f"{roles[i]}:{texts[i]}")
            elif one == "R":
                lines.append(f"{_ROLE[_MADE[at]]}:{texts[i]}")
        at = after
        audit.append(made + "D" * (rows.again[i] + (rows.codes[i] == GONE)))
    while last and at in (SYSTEM, USER):
        at = _MADE[at]
        audit.append("I")
        lines.append(f"{_ROLE[at]}:")
    return "".join(audit), "\n".join(lines).encode("utf-8", "surrogatepass")


def turn_span(turns: Sequence[int | None]) -> list[int] | None:
    """First, last and number of distinct turns of sorted ones."""
    known = [t for t in turns if t is not None]
    return [known[0], known[-1], 1 + sum(a != b for a, b in zip(known, known[1:]))] if known else None


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): rows after damage and how often each occurs; n is 0 where rows were dropped."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    gone = kind == 0
    return rows.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"), F.when(gone, "").otherwise(role).alias("role"),
        F.when(gone, "").otherwise(text).alias("text"), F.when(gone, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("n"),
    ).groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
BLOCKS = f"conv_id long, block long, whole boolean, {RESULT}, roles array<string>, texts array<string>, counts array<long>, turns array<long>"
_TYPES = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "int": pa.int32(),
          "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_pylist(rows, pa.schema([(name, _TYPES[kind]) for name, kind in fields]))


def _repair_whole(roles: list[str], texts: list[str], counts: list[int], turns: list[int | None]) -> dict:
    rows, span = Rows(roles, texts, counts), turn_span(turns)
    total, relative = _back(FINISH, rows.codes, rows.again, 0, len(rows.codes))
    audit, lines = written(roles, texts, rows, FINISH, START, True)
    return {
        "gaps": span[1] - span[0] + 1 - span[2] if span else 0, "blank": rows.blank, "duplicate": rows.duplicate, "truncated": rows.truncated,
        "illegal": rows.illegal, "cost": int(total + relative[START]), "audit": audit, "repaired_sha256": hashlib.sha256(lines).hexdigest(),
    }


def _blocks(block_rows: int, block_bytes: int):
    """Sorted rows to repaired conversations, and to blocks of those that may go on in other partitions or blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        conversation, held, size, whole = None, ([], [], [], []), 0, False
        started, out = False, []

        def flush(complete: bool) -> None:
            nonlocal number, held, size
            turns, roles, texts, counts = held
            row = {"conv_id": conversation, "block": part << 32 | number, "whole": complete}
            if complete:
                row |= _repair_whole(roles, texts, counts, turns)
            else:
                row |= {"roles": roles, "texts": texts, "counts": counts, "turns": turn_span(turns)}
            out.append(row)
            number, held, size = number + 1, ([], [], [], []), 0

        for batch in batches:
            for conv_id, *row in zip(*(column.to_pylist() for column in batch.columns)):
                if not started:
                    started, conversation, whole = True, conv_id, False  # the first one may have begun before
                elif conv_id != conversation:
                    flush(whole)
                    conversation, whole = conv_id, True
                elif len(held[0]) >= block_rows or size >= block_bytes:
                    flush(False)
                    whole = False
                for values, value in zip(held, row):
                    values.append(value)
                size += 4 * len(row[2])  # a bound of its bytes
            if out:
                yield _batch(out, BLOCKS)
                out.clear()
        if started:
            flush(False)  # the last one may go on
            yield _batch(out, BLOCKS)

    return run


SUMMARY = (
    "conv_id long, block long, codes binary, again array<long>, through array<double>, blank long, duplicate long, truncated long, "
    "illegal long, opening int, closing int, turns array<long>"
)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            rows = Rows(row["roles"], row["texts"], row["counts"], row["firsts"] or [])
            yield _batch([{
                "conv_id": row["conv_id"], "block": row["block"], "codes": bytes(rows.codes), "again": rows.again,
                "through": through(rows.codes, rows.again), "blank": rows.blank, "duplicate": rows.duplicate, "truncated": rows.truncated,
                "illegal": rows.illegal, "opening": rows.opening, "closing": rows.closing, "turns": row["turns"],
            }], SUMMARY)


CHAINED = "conv_id long, block long, behind array<double>, last boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _chain(table: pa.Table) -> pa.Table:
    """The costs behind each block of a conversation; its first block gets the sums of all."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    behind, total, made = FINISH, 0.0, []
    for row in reversed(rows):
        made.append({"conv_id": row["conv_id"], "block": row["block"], "behind": list(behind), "last": not made})
        found = [min(row["through"][4 * p + q] + behind[q] for q in STATES) for p in STATES]
        least = min(found)
        total, behind = total + least, tuple(c - least for c in found)
    ends = [(r["opening"], r["closing"]) for r in rows if r["opening"] is not None]
    spans = [r["turns"] for r in rows if r["turns"]]
    distinct = sum(s[2] for s in spans) - sum(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    made[-1] |= {name: sum(r[name] for r in rows) for name in ("blank", "duplicate", "truncated", "illegal")}
    made[-1]["illegal"] += sum((a[1], b[0]) not in _LEGAL for a, b in zip(ends, ends[1:]))
    made[-1] |= {"cost": int(total + behind[START]), "gaps": spans[-1][1] - spans[0][0] + 1 - distinct if spans else 0}
    return pa.Table.from_batches([_batch(made, CHAINED)])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            exits = []
            for state in STATES:
                for _, _, state in walk(row["codes"], row["again"], tuple(row["behind"]), state):
                    pass
                exits.append(state)
            yield _batch([{"conv_id": row["conv_id"], "block": row["block"], "exits": exits}], "conv_id long, block long, exits array<long>")


def _entries(table: pa.Table) -> pa.Table:
    state, made = START, []
    for row in sorted(table.to_pylist(), key=lambda r: r["block"]):
        made.append({"block": row["block"], "entry": state})
        state = row["exits"][state]
    return pa.Table.from_batches([_batch(made, "block long, entry int")])


_SUMS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PIECES = f"conv_id long, block long, {', '.join(f'{s} long' for s in _SUMS)}, audit string, lines binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            rows = Rows(row["roles"], row["texts"], row["counts"], row["firsts"] or [])
            audit, lines = written(row["roles"], row["texts"], rows, tuple(row["behind"]), row["entry"], row["last"])
            yield _batch([{c: row[c] for c in ("conv_id", "block", *_SUMS)} | {"audit": audit, "lines": lines}], PIECES)


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of (conversation, block) to one row per conversation; texts pass through the digest one by one."""
    sums, audit, digest, any_line = None, [], None, False

    def done() -> pa.RecordBatch:
        return _batch([sums | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], f"conv_id long, {RESULT}")

    for batch in batches:
        for row in batch.to_pylist():
            if row["cost"] is not None:  # the first block
                if sums is not None:
                    yield done()
                sums, audit, digest, any_line = {c: row[c] for c in ("conv_id", *_SUMS)}, [], hashlib.sha256(), False
            audit.append(row["audit"])
            if row["lines"]:
                digest.update((b"\n" if any_line else b"") + row["lines"])
                any_line = True
    if sums is not None:
        yield done()


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Faults, cost, audit and digest of each conversation of (conv_id, turn, role, text, n)."""
    bound_batches(rows.sparkSession)
    line = F.concat("role", F.lit(":"), "text")
    chosen = rows.select("conv_id", "turn", "role", "text", "n", F.substring(line, 1, RANGE_CHARS).alias("_begin"))
    ranged = chosen.repartitionByRange("conv_id", "turn", "_begin").sortWithinPartitions("conv_id", "turn", line)
    blocks = stored(ranged.select("conv_id", "turn", "role", "text", "n").mapInArrow(_blocks(block_rows, block_bytes), BLOCKS), "repair-blocks")
    names = [x.split()[0] for x in f"conv_id long, {RESULT}".split(", ")]
    whole = blocks.where("whole").select(*names)
    parts = blocks.where("not whole").select("conv_id", "block", "roles", "texts", "counts", "turns")

    rows_of = parts.select("conv_id", "block", F.posexplode(F.arrays_zip("roles", "texts", "counts")).alias("at", "r")).where("r.counts > 0")
    key = F.sha2(F.concat(F.length("r.roles").cast("string"), F.lit(":"), "r.roles", "r.texts"), 256)
    first = rows_of.groupBy("conv_id", key.alias("_key")).agg(F.min(F.struct("block", "at")).alias("f"))
    firsts = first.groupBy(F.col("f.block").alias("block")).agg(F.collect_list(F.col("f.at").cast("long")).alias("firsts"))
    known = stored(parts.join(firsts, "block", "left"), "repair-firsts")
    texts = known.select("conv_id", "block", "roles", "texts", "counts", "turns", "firsts")
    summary = stored(texts.mapInArrow(_summaries, SUMMARY), "repair-summaries")
    chained = stored(summary.drop("codes", "again").groupBy("conv_id").applyInArrow(_chain, CHAINED), "repair-costs")
    exits = summary.select("conv_id", "block", "codes", "again").join(chained.select("block", "behind"), "block").mapInArrow(
        _exits, "conv_id long, block long, exits array<long>"
    )
    entries = exits.groupBy("conv_id").applyInArrow(_entries, "block long, entry int")
    pieces = texts.join(chained.drop("conv_id"), "block").join(entries, "block").mapInArrow(_pieces, PIECES)
    joined = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_join_pieces, f"conv_id long, {RESULT}")
    return whole.unionByName(joined.select(*names))


def report(conversations: DataFrame) -> DataFrame:
    """Damage the table and repair it: one row per conversation."""
    return repair(damaged(conversations))
