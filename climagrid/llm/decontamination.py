"""Benchmark decontamination by winnowing.

A window is 13 consecutive words of a benchmark item (a shorter item is one window). Texts and items keep the smallest hash
of each run of w = 13 - k + 1 successive k-word sequences. A shared span of 13 words holds such a run whole, so both sides keep the
same hash: no shared window is missed. Documents that share a fingerprint with any item are read again, and the hits are
extended: their 13-word sequences are compared with the items' windows, first by hash, then word by word.

Only DataFrame functions are used; documents are never shuffled with their texts unless the list of candidates is
too long to broadcast. Fingerprints of documents meet those of the items in a join, and nothing lists pairs of documents and
items except the occurring windows themselves.

Defined results: NULL and wordless texts have no words and no hits; wordless items have no windows; short items use
shorter sequences (k is at most their length); item ids that repeat are one item with all windows; rows with the same id and text get the same
result; an empty table on either side gives zero hits; clashing column names are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climagrid.llm.common import broadcast_if_bounded, free, let, lower_ascii, stored, text_or_empty

WINDOW = 13
GRAM = 5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(name: str = "text") -> Column:
    """Words of letters, digits and everything outside ASCII, A-Z lowered."""
    return F.array_remove(F.split(lower_ascii(text_or_empty(name)), SEPARATORS), "")


def _every(words: Column, length: int, value) -> Column:
    """``value(i)`` for each start i (from 1) of a sequence of ``length`` words; empty for shorter texts."""
    starts = F.when(F.size(words) >= length, F.sequence(F.lit(1), F.size(words) - (length - 1)))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), value)


def fingerprints(words: Column, window: int = WINDOW, gram: int = GRAM) -> Column:
    """Distinct minima of the k-word hashes; ``window`` is hashed too, so that lengths do not mix."""
    k = min(gram, window)
    run = window - k + 1

    def minima(grams: Column) -> Column:
        if run == 1:
            return F.array_distinct(grams)
        starts = F.when(F.size(grams) >= run, F.sequence(F.lit(1), F.size(grams) - (run - 1)))
        starts = F.coalesce(starts, F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.array_min(F.slice(grams, i, F.lit(run)))))

    def prints(known: Column) -> Column:
        return let(_every(known, k, lambda i: F.xxhash64(F.lit(window), F.slice(known, i, F.lit(k)))), minima)

    return let(words, prints)


def _row_key() -> list[Column]:
    """Two numbers that tell (doc_id, text) apart; never NULL."""
    return [
        F.xxhash64("doc_id", text_or_empty()).alias("key_a"),
        F.xxhash64(F.lit(1), text_or_empty(), "doc_id").alias("key_b"),
    ]


KEY = ["key_a", "key_b"]


def measured(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row of ``docs``: doc_id, the row key, n_words, n_hit, n_items and items_sha256."""
    items = stored(
        benchmark.select("item_id", words_of().alias("words"))
        .where(F.size("words") > 0)
        .select("item_id", "words", F.least(F.size("words"), F.lit(window)).alias("length")),
        "items",
    )
    # At most ``window`` different lengths.
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())

    def by_length(make) -> Column:
        return F.concat(*[make(n) for n in lengths]) if lengths else F.array().cast("array<bigint>")

    own_prints = F.concat(
        *[F.when(F.col("length") == n, fingerprints(F.col("words"), n, gram)).otherwise(F.array().cast("array<bigint>")) for n in lengths]
    ) if lengths else F.array().cast("array<bigint>")
    prints = stored(items.select(F.explode(own_prints).alias("print")).distinct(), "prints")
    # Words are split once per row, in a projection of their own below the hashes.
    split = docs.select("doc_id", *_row_key(), words_of().alias("words"))
    base = stored(
        split.select("doc_id", *KEY, F.size("words").cast("long").alias("n_words"), by_length(lambda n: fingerprints(F.col("words"), n, gram)).alias("prints")),
        "fingerprints",
    )
    near = (
        base.select(*KEY, F.explode("prints").alias("print"))
        .join(broadcast_if_bounded(prints, 16), "print", "left_semi")
        .select(*KEY)
        .distinct()
    )
    near = broadcast_if_bounded(stored(near, "candidates"), 32)

    def sequences(length_of) -> Column:
        return F.concat(*[length_of(n) for n in lengths])

    def rows_of(words: Column, n: int) -> Column:
        return let(
            words,
            lambda known: _every(
                known, n, lambda i: F.struct(i.alias("at"), F.lit(n).alias("length"), F.slice(known, i, F.lit(n)).alias("words"))
            ),
        )

    if not lengths:
        return base.select("doc_id", *KEY, "n_words", *_no_hits())
    w = F.col("words")
    windows = items.select("item_id", F.explode(sequences(lambda n: F.when(F.col("length") == n, rows_of(w, n)).otherwise(F.filter(rows_of(w, n), lambda x: F.lit(False))))).alias("w"))
    windows = windows.select("item_id", F.xxhash64("w.words").alias("hash"), F.col("w.words").alias("item_words")).distinct()
    windows = stored(windows, "windows")
    widest = windows.agg(F.coalesce(F.max(F.octet_length(F.array_join("item_words", " "))), F.lit(0))).first()[0]
    windows = broadcast_if_bounded(windows, 2 * widest + 24 * window + 64)  # words, and what an array of them takes besides
    places = (
        docs.select(*_row_key(), text_or_empty().alias("text"))
        .join(near, KEY, "left_semi")
        .select(*KEY, words_of().alias("words"))
        .select(*KEY, F.explode(sequences(lambda n: rows_of(w, n))).alias("p"))
        .select(*KEY, F.xxhash64("p.words").alias("hash"), "p.at", "p.length", "p.words")
    )
    hits = places.join(windows, "hash").where(F.col("words") == F.col("item_words"))
    spans = F.sort_array(F.collect_set(F.struct("at", "length")))
    state = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("covered"))
    covered = F.aggregate(
        "spans",
        state,
        lambda s, x: F.struct(
            F.greatest(s["end"], x["at"] + x["length"]).alias("end"),
            (s["covered"] + F.greatest(F.lit(0), x["at"] + x["length"] - F.greatest(s["end"], x["at"]))).alias("covered"),
        ),
        lambda s: s["covered"],
    )
    found = (
        hits.groupBy(*KEY)
        .agg(spans.alias("spans"), F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
        .select(*KEY, covered.alias("_n_hit"), F.size("ids").cast("long").alias("_n_items"), F.sha2(F.array_join("ids", ","), 256).alias("_sha"))
    )
    none = _no_hits()
    return base.select("doc_id", *KEY, "n_words").join(broadcast_if_bounded(stored(found, "hits"), 160), KEY, "left").select(
        "doc_id", *KEY, "n_words",
        F.coalesce("_n_hit", none[0]).alias("n_hit"), F.coalesce("_n_items", none[1]).alias("n_items"), F.coalesce("_sha", none[2]).alias("items_sha256"),
    )


def _no_hits() -> list[Column]:
    zero = F.lit(0).cast("long")
    return [zero.alias("n_hit"), zero.alias("n_items"), F.sha2(F.lit(""), 256).alias("items_sha256")]


def contaminated() -> Column:
    """A hit, and at least one word in twenty hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return measured(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", contaminated().alias("contaminated")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that are not contaminated, with all columns of ``docs``, whatever their names."""
    own = [free(k, docs) for k in KEY]
    bad = stored(measured(docs, benchmark).where(contaminated()).select(*[F.col(k).alias(o) for k, o in zip(KEY, own)]).distinct(), "contaminated")
    a, b = _row_key()
    same = (a == F.col(own[0])) & (b == F.col(own[1]))
    return docs.join(broadcast_if_bounded(bad, 32), same, "left_anti")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, w[i : i + least(13, len(w)) - 1] AS g
  FROM b, LATERAL (SELECT unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i) WHERE len(w) > 0),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT d.rid, ns.n, i, d.w[i : i + ns.n - 1] AS g
  FROM d, ns, LATERAL (SELECT unnest(generate_series(1, len(d.w) - ns.n + 1)) AS i)),
h AS (SELECT dw.rid, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
c AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM h) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS s FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
  coalesce(t.s, sha256('')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)
"""
