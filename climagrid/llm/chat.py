r"""Chat formatting with a grammar round trip.

A conversation is rendered as ``<|im_start|>role\ntext<|im_end|>\n`` per turn, reparsed by a deterministic
grammar, and compared with its source. Content that does not come back is escaped and the conversation is rendered
again, until the recovered turns are identical:

* round 0 escapes nothing;
* round 1 escapes the roles and texts that were not recovered by themselves;
* round 2 escapes all contents of conversations that still differ.

Escaping adds one backslash to each ``<``, backslashes, ``|`` of a text (and of a role, whose backslashes and line breaks
become ``\\`` and ``\n``); the parser takes it off again. Escaped contents cannot hold a mark, so round 2 is always identical.

Only DataFrame functions are used. A conversation becomes one text, so its turns meet in one row; only that result bounds
its size. Defined results: NULL text and role count as empty; turns are ordered by turn (NULL first), then role and text, so
ties and repeated rows have one order; NULL is a conversation of its own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
CONFLICT_TEXT = "<|im_end|><|im_start|>assistant ok"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape_text(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    mark = F.lit("\x00")  # a NUL in a role is kept apart by doubling
    plain = unescape_text(role)
    halves = F.replace(F.replace(plain, mark, F.lit("\x00\x01")), F.lit("\\\\"), F.lit("\x00\x02"))
    lines = F.replace(halves, F.lit("\\n"), F.lit("\n"))
    return F.replace(F.replace(lines, F.lit("\x00\x02"), F.lit("\\")), F.lit("\x00\x01"), mark)


def _render(turns: Column, escape: Column | None) -> Column:
    """Text of an array of (role, text[, escape flag])."""

    def one(turn: Column) -> Column:
        role, text = turn["role"], turn["text"]
        if escape is not None:
            role = F.when(turn["escape"], escape_role(role)).otherwise(role)
            text = F.when(turn["escape"], escape_text(text)).otherwise(text)
        return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))

    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """Recovered (role, text) turns; what does not follow the grammar is cut off at its first mark."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    pieces = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def one(piece: Column) -> Column:
        line = F.locate("\n", piece)
        role = F.substring(piece, F.lit(1), line - 1)
        rest = F.substring(piece, line + 1, F.length(piece))
        return F.struct(unescape_role(role).alias("role"), unescape_text(F.split_part(rest, F.lit(END), F.lit(1))).alias("text"))

    return F.transform(pieces, one)


def _recovered_alone(turn: Column) -> Column:
    """Whether one turn comes back by itself, unescaped."""
    role, text = turn["role"], turn["text"]
    safe_text = ~text.contains(START) & ~text.contains(END) & (unescape_text(text) == text)
    safe_role = ~role.contains(START) & ~role.contains(END) & ~role.contains("\n") & (unescape_role(role) == role)
    # A text may also end in a part of a mark that the closing mark completes.
    closed = F.concat(text, F.lit(END))
    return safe_text & safe_role & (F.locate(END, closed) == F.length(text) + 1)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, rounds, loss_spans): the text, and [start, end) of each assistant text in it.

    ``rounds`` is the round whose text was identical to the source after reparsing.
    """
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_rows"))
    turns = F.transform("_rows", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))

    def flagged(flag) -> Column:
        return F.transform(
            "_turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"), flag(x).alias("escape"))
        )

    step = grouped.select("conv_id", turns.alias("_turns"))
    step = step.withColumn("formatted", _render(F.col("_turns"), None)).withColumn("rounds", F.lit(0))
    step = step.withColumn("_flags", flagged(lambda x: F.lit(False)))
    for number, flag in ((1, lambda x: ~_recovered_alone(x)), (2, lambda x: F.lit(True))):
        # Only conversations that differ are rendered again.
        step = step.withColumn("_same", parse(F.col("formatted")) == F.col("_turns"))
        step = step.withColumn("_flags", F.when(F.col("_same"), F.col("_flags")).otherwise(flagged(flag)))
        step = step.withColumn(
            "formatted", F.when(F.col("_same"), F.col("formatted")).otherwise(_render(F.col("_flags"), F.lit(True)))
        ).withColumn("rounds", F.when(F.col("_same"), F.col("rounds")).otherwise(F.lit(number)))
    return step.select("conv_id", "formatted", "rounds", loss_spans(F.col("formatted")).alias("loss_spans"))


def loss_spans(formatted: Column) -> Column:
    """[start, end) in code points of each assistant text, read from the formatted text."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    pieces = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    state = F.struct(
        F.lit(0).cast("int").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")
    )

    def step(acc: Column, piece: Column) -> Column:
        begin = acc["at"] + len(START)
        line = F.locate("\n", piece)
        start = begin + line
        end = begin + F.length(piece) - len(END) - 1
        is_loss = unescape_role(F.substring(piece, F.lit(1), line - 1)) == "assistant"
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            (begin + F.length(piece)).alias("at"),
            F.when(is_loss, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    return F.aggregate(pieces, state, step, lambda acc: acc["spans"])


def with_conflict(conversations: DataFrame, spark: SparkSession) -> DataFrame:
    """The table and conversation -1, whose texts hold the template's own marks."""
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONFLICT_TEXT).alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests, read back from the formatted text and its loss spans."""
    turns = parse(F.col("formatted"))
    all_turns = F.array_join(F.transform("_turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    texts = F.transform("loss_spans", lambda s: unescape_text(F.substring("formatted", s["start"] + 1, s["end"] - s["start"])))
    loss = F.array_join(texts, "")
    return formatted.withColumn("_turns", turns).select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(all_turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "rounds",
    )
