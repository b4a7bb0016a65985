r"""Secret scans: three fixed patterns, and character Markov models for everything else.

Two first-order Markov models of characters are trained from labelled samples, one on random strings and one on ordinary
identifiers and words. A run of at least ``LEAST`` token characters is reported when its log-likelihood ratio (random against ordinary)
is above ``MARGIN`` for the whole run and above ``MEAN`` per step, unless it overlaps a pattern's match.

Matches are located without Python: ``\G`` and a lazy gap cut a text into pieces that end in a match, so that lengths of pieces
add up to offsets; a text is read through once per pattern, and only if a cheap test finds what the pattern needs.

Labelled samples come from a bounded number of documents (the first ``SAMPLE_ROWS`` ids in hash order): values found by the patterns, and
digests of the ids in hexadecimal and base64, are random; other words are ordinary. The tables of the models have one number per pair of
characters, whatever the input.

Defined results: NULL and empty texts have no spans; spans count code points, the end is excluded; overlapping spans of
different patterns are all kept; empty tables give an empty result; without samples all ratios are 0 and the models add nothing.
Rows are scored one by one, so repeated rows are reported each, and other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climagrid.llm.common import let, text_or_empty

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]{14,})"
HEX = r"([0-9a-f]{16,})"
LEAST = 16
RUN = r"([A-Za-z0-9+/_=-]{16,})"
KINDS = ("assign", "access", "hex", "model")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SAMPLE_ROWS = 4_000
MARGIN = 12.0
MEAN = 0.6
# Weight of a character's own frequency against its frequency after another one.
PRIOR = 10.0
_SPANS = "array<struct<start:int,end:int>>"


def _none() -> Column:
    return F.array().cast(_SPANS)


def spans(text: Column, pattern: str, least: int = 0, keep=None) -> Column:
    """Spans of the leftmost non-overlapping matches whose group 1 has ``least`` characters and passes ``keep``."""
    pieces = F.regexp_extract_all(text, F.lit(r"\G[\s\S]*?" + pattern), F.lit(0))
    cut = F.transform(
        pieces,
        lambda p: F.struct(
            F.length(p).alias("size"),
            F.length(F.regexp_extract(p, pattern, 0)).alias("match"),
            F.regexp_extract(p, pattern, 1).alias("value"),
        ),
    )
    state = F.struct(F.lit(0).alias("at"), _none().alias("found"))

    def step(s: Column, p: Column) -> Column:
        end = s["at"] + p["size"]
        good = F.length(p["value"]) >= least
        good = good & keep(p["value"]) if keep is not None else good
        one = F.array(F.struct((end - p["match"]).alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(good, F.concat(s["found"], one)).otherwise(s["found"]).alias("found"))

    return F.aggregate(cut, state, step, lambda s: s["found"])


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of the three patterns, each looked for only where it can occur."""
    low = F.lower(text)
    words = ("password", "passwd", "secret", "token", "apikey", "api_key")
    named = low.contains(words[0])
    for word in words[1:]:
        named = named | low.contains(word)
    return {
        "assign": F.when(named, spans(text, ASSIGN, 12)).otherwise(_none()),
        "access": F.when(text.contains("AKIA"), spans(text, ACCESS)).otherwise(_none()),
        "hex": F.when(text.rlike(r"[0-9a-f]{16}"), spans(text, HEX)).otherwise(_none()),
    }


def _codes(value: Column) -> Column:
    """Numbers of the characters in the alphabet, from 1; 0 for others."""
    return F.transform(F.split(value, ""), lambda c: F.when(c == "", 0).otherwise(F.instr(F.lit(ALPHABET), c)))


def _pairs(value: Column) -> Column:
    """Number of each pair of neighbouring characters."""
    width = len(ALPHABET) + 1

    def steps(codes: Column) -> Column:
        following = F.slice(codes, F.lit(2), F.greatest(F.size(codes) - 1, F.lit(0)))
        return F.filter(F.zip_with(codes, following, lambda a, b: a * width + b), lambda x: x.isNotNull())

    return let(F.filter(_codes(value), lambda c: c > 0), steps)


def labelled_samples(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(value, is_random) from the first ``rows`` ids in hash order."""
    ids = docs.select(F.col("doc_id").alias("sample_id")).where(F.col("sample_id").isNotNull()).distinct()
    ids = ids.orderBy(F.xxhash64("sample_id"), "sample_id").limit(rows)
    text = text_or_empty()
    chosen = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("sample_id")).select("doc_id", text.alias("text"))
    digest = F.sha2(F.col("doc_id").cast("string"), 256)
    patterns = [F.regexp_extract_all("text", F.lit(p), F.lit(1)) for p in (ASSIGN, ACCESS, HEX)]
    random = F.concat(F.array(digest, F.regexp_replace(F.base64(F.unhex(digest)), "=+$", "")), *patterns)
    ordinary = F.filter(F.split("text", r"[^A-Za-z0-9+/_=-]+"), lambda w: (F.length(w) >= 4) & ~w.rlike(r"AKIA[A-Z0-9]{14}|[0-9a-f]{16}|[0-9]{6}"))
    both = F.concat(
        F.transform(random, lambda v: F.struct(v.alias("value"), F.lit(True).alias("is_random"))),
        F.transform(F.array_except(ordinary, random), lambda v: F.struct(v.alias("value"), F.lit(False).alias("is_random"))),
    )
    return chosen.select(F.explode(both).alias("s")).select("s.value", "s.is_random")


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of characters; the counts that come back are one number per pair and label."""
    width = len(ALPHABET) + 1
    rows = (
        samples.where(F.col("value").isNotNull())
        .select("is_random", F.explode(_pairs(F.col("value"))).alias("pair"))
        .groupBy("is_random", "pair")
        .count()
        .collect()
    )
    if not rows:
        return [0.0] * (width * width)
    counts = {flag: [0.0] * (width * width) for flag in (True, False)}
    for row in rows:
        counts[row["is_random"]][row["pair"]] += row["count"]
    logs = {}
    for flag, pairs in counts.items():
        second = [sum(pairs[i::width]) + 0.5 for i in range(width)]
        share = [c / sum(second) for c in second]
        # Rare first characters fall back on how often the second one occurs at all.
        logs[flag] = []
        for first in range(width):
            own = pairs[first * width : (first + 1) * width]
            logs[flag] += [math.log((own[i] + PRIOR * share[i]) / (sum(own) + PRIOR)) for i in range(width)]
    return [a - b for a, b in zip(logs[True], logs[False])]


def scan(docs: DataFrame, model: list[float]) -> DataFrame:
    """doc_id with the spans of each kind: assign, access, hex and model."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")

    def is_random(value: Column) -> Column:
        def decide(steps: Column) -> Column:
            total = F.aggregate(steps, F.lit(0.0), lambda s, p: s + F.coalesce(F.get(table, p), F.lit(0.0)))
            return (total > MARGIN) & (total > MEAN * F.size(steps))

        return let(_pairs(value), decide)

    text = F.col("text")
    found = docs.select("doc_id", text_or_empty().alias("text"))
    found = found.withColumns(base_spans(text) | {"runs": F.when(text.rlike(RUN), spans(text, RUN, LEAST, is_random)).otherwise(_none())})
    taken = F.concat("assign", "access", "hex")

    def free(known: Column) -> Column:
        return F.filter("runs", lambda m: ~F.exists(known, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))

    return found.select("doc_id", *KINDS[:3], F.when(F.size("runs") > 0, let(taken, free)).otherwise(_none()).alias("model"))


def joined(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans by start, then kind as listed, comma-joined."""

    def numbered(kind: int) -> Column:
        one = lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))
        return F.transform(kinds[kind], one)

    names = F.array(*[F.lit(k) for k in kinds])
    text = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.sort_array(F.concat(*[numbered(i) for i in range(len(kinds))])), text), ",")


def report(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts, digest of the patterns' spans and the list of all spans of every document."""
    found = scan(docs, train(labelled_samples(docs, sample_rows)))
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(KINDS[:3]), 256).alias("base_sha256"), joined(KINDS).alias("spans"),
    )
