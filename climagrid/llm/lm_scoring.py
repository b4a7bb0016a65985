"""Language-model scores from a log-frequency Bloom filter.

The model is a bigram model. Counts of words and word pairs are quantised to ``1 + floor(log_b(count))`` levels; for a level
of q, the entries (n-gram, 1) to (n-gram, q) are put into a Bloom filter. A count is read back by probing levels 1, 2, ... until one is
missing; errors are one-sided and rare beyond one level. Probabilities are smoothed with a Dirichlet prior,

    P(w | h) = (c(h w) + mu * P(w)) / (c(h) + mu),    P(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)),

with all counts from the filter, c(h w) not above c(h) or c(w), N training tokens and V distinct ones. The history of a first word is the end mark.

* Counting: tasks count n-grams of their batches and deal them, packed by ranges of the hash, to shards. A shard adds up its counts
  and makes the part of the filter that belongs to its range. The number of shards follows the corpus.
* Scoring: the filter is broadcast if its measured size is at most ``filter_bytes``. A larger one stays in its shards: documents
  are put into pieces, the distinct n-grams of a piece are sent to their shards, a shard looks each of its n-grams up once for all
  pieces, and the levels come back in the order of the n-grams, without them. Both ways read the same bits.
* The exact counts of the baseline score: the most frequent words, ``HEAD`` at most, are broadcast, the others are joined as rows.

Words are compared by 64-bit hashes (see ``tokens``). Defined results: NULL text is empty (one end token); a NULL id counts as
empty text when rows are dealt to training and held-out; repeated rows are scored each; with no training rows all counts are 0
(score and base are those of the prior); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climagrid.llm import tokens
from climagrid.llm.common import bound_batches, id_hash_mod, scratch_scope, shuffles_dropped, stored

BASE = 1.25
PRIOR = 32.0
BITS_PER_ENTRY = 8
PROBES = 5
HEAD = 1 << 17
FILTER_BYTES = 192 << 20
# Text per shard; about 1.4 million pairs.
SHARD_BYTES = 8 << 20
FLUSH_BYTES = 8 << 20
# Text whose distinct pairs are looked up together: in a broadcast filter, and in its shards.
PIECE_BYTES = 1 << 20
FAR_PIECE_BYTES = 8 << 20
SLICE = 1 << 17
MAX_LEVEL = 255
_END = np.uint64(0xA0761D6478BD642F)
_U = np.uint64


def quantise(counts: np.ndarray) -> np.ndarray:
    """Level of each count; 0 for 0."""
    safe = np.maximum(counts, 1)
    level = 1 + np.floor(np.log(safe) / np.log(BASE) + 1e-9)
    return np.where(counts > 0, np.minimum(level, MAX_LEVEL), 0).astype(np.int64)


# Expected count of a level: the middle of the whole numbers that have it.
_low = np.ceil(BASE ** np.arange(MAX_LEVEL) - 1e-9)
_high = np.maximum(_low, np.ceil(BASE ** np.arange(1, MAX_LEVEL + 1) - 1e-9) - 1)
DECODED = np.concatenate(([0.0], (_low + _high) / 2))


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Whether a key of an ordered array is the first of its value."""
    return np.concatenate(([True], ordered[1:] != ordered[:-1]))[: len(ordered)]


def distinct_keys(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in order. Sorting takes a small part of the time of ``np.unique``, which hashes where only values are asked for."""
    ordered = np.sort(keys)
    return ordered[_firsts(ordered)]


def for_each(keys: np.ndarray, values_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """A value for each key, where ``values_of`` gives those of the distinct keys in order."""
    order = np.argsort(keys)
    ordered = keys[order]
    firsts = np.flatnonzero(_firsts(ordered))
    values = values_of(ordered[firsts])
    out = np.empty(len(keys), values.dtype)
    out[order] = np.repeat(values, np.diff(np.append(firsts, len(keys))))
    return out


def planes(keys: np.ndarray) -> bytes:
    """Keys as all their first bytes, then all their second bytes, and so on: the high bytes of ordered keys compress well."""
    return keys.view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: pa.Scalar) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data.as_buffer(), np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Range of the hash that a key lies in; it does not decrease with the key."""
    return ((keys >> _U(32)) * _U(shards)) >> _U(32)


def _entry(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the entry (key, level); probe i is at the first plus i times the second."""
    with np.errstate(over="ignore"):
        one = tokens.mix(keys + _U(0x9E3779B97F4A7C15) * _U(level))
    return one, (one >> _U(32)) | _U(1)


def _position(one: np.ndarray, two: np.ndarray, probe: int, size: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((one + two * _U(probe)) & _U(0xFFFFFFFF)) * size >> _U(32)


def build_filter(keys: np.ndarray, counts: np.ndarray, bits_per_entry: int = BITS_PER_ENTRY) -> np.ndarray:
    """Bytes of the filter of one shard, sized for its entries."""
    levels = quantise(counts)
    size = max(64, int(levels.sum()) * bits_per_entry + 63 & ~63)
    flags = np.zeros(size, bool)
    level = 1
    while len(keys):
        one, two = _entry(keys, level)
        for probe in range(PROBES):
            flags[_position(one, two, probe, _U(size)).astype(np.int64)] = True
        level += 1
        more = levels >= level
        keys, levels = keys[more], levels[more]
    return np.packbits(flags, bitorder="little")


class Filter:
    """Shards put together; ``parts`` holds the bytes of shard 0, 1, ... of one kind of n-gram."""

    def __init__(self, parts: list[np.ndarray]):
        self._place([len(p) for p in parts] or [8])
        for i, part in enumerate(parts):
            self.put(i, part)

    @classmethod
    def of_sizes(cls, sizes: list[int]) -> Filter:
        """An empty filter whose shards are put in one by one."""
        made = cls.__new__(cls)
        made._place(sizes)
        return made

    def _place(self, sizes: list[int]) -> None:
        self.bits = np.zeros(sum(sizes), np.uint8)
        self.sizes = np.array(sizes, np.uint64) * _U(8)
        self.starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.uint64)

    def put(self, shard: int, part: np.ndarray) -> None:
        start = int(self.starts[shard])
        self.bits[start : start + len(part)] = part

    def _present(self, one: np.ndarray, two: np.ndarray, size: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Numbers of the entries whose probes are all set; ``size`` and ``start`` are those of their shards."""
        at, step, rest = one.astype(np.uint32), two.astype(np.uint32), np.arange(len(one))
        there = np.ones(len(one), bool)
        for probe in range(PROBES):
            place = at * size >> _U(32)
            byte = self.bits.take((start + (place >> _U(3))).view(np.int64))
            there &= (byte >> (place.astype(np.uint8) & np.uint8(7))) & np.uint8(1) == 1
            at = at + step
            # Most entries of known keys pass all probes; arrays are copied only where many don't.
            if probe + 1 == PROBES or np.count_nonzero(there) < 0.7 * len(there):
                keep = np.flatnonzero(there)
                rest, there = rest[keep], there[keep]
                at, step, size, start = at[keep], step[keep], size[keep], start[keep]
        return rest

    def levels(self, keys: np.ndarray, upto: np.ndarray | None = None) -> np.ndarray:
        """Levels of the keys: the last of the unbroken run of present ones, which is followed up to ``upto``."""
        out = np.zeros(len(keys), np.uint8)
        active, level = np.arange(len(keys)) if upto is None else np.flatnonzero(upto), 1
        keys, last = keys[active], None if upto is None else upto[active]
        shard = shard_of(keys, len(self.sizes)).view(np.int64)
        size, start = self.sizes[shard], self.starts[shard]
        while len(active) and level <= MAX_LEVEL:
            keep = self._present(*_entry(keys, level), size, start)
            out[active[keep]] = level
            if last is not None:
                keep = keep[last[keep] > level]
                last = last[keep]
            active, keys, size, start = active[keep], keys[keep], size[keep], start[keep]
            level += 1
        return out


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens with an end after each text, the pair ending at each token, and the first token of each text."""
    words, first, _ = tokens.hashes(texts, tokens.BY_SPACE)
    stream = np.insert(words, first[1:], _END)
    begin = first[:-1] + np.arange(len(texts))
    history = np.empty_like(stream)
    history[1:] = stream[:-1]
    history[begin] = _END
    with np.errstate(over="ignore"):
        pairs = tokens.mix(history * _U(0xD6E8FEB86659FD93) + stream + _U(1))
    return stream, pairs, begin


def ngrams_in_parts(texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``ngrams`` of at least one text, in parts: hashing needs many times the memory of the text that is hashed at once."""
    found, part, used, before = [], [], 0, 0

    def add() -> None:
        nonlocal part, used, before
        stream, pairs, begin = ngrams(part)
        found.append((stream, pairs, begin + before))
        part, used, before = [], 0, before + len(stream)

    for text in texts:
        if part and used + len(text) > tokens.CHUNK_BYTES:
            add()
        part.append(text)
        used += len(text)
    add()
    return tuple(np.concatenate(x) for x in zip(*found))


def _packed(kind: int, keys: np.ndarray, counts: np.ndarray | None, shards: int) -> Iterator[dict]:
    """Rows of one range of the hash each; ``keys`` are sorted."""
    cuts = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1, dtype=np.uint64))
    for shard in np.flatnonzero(np.diff(cuts)):
        part = slice(cuts[shard], cuts[shard + 1])
        yield {"kind": kind, "shard": int(shard), "keys": planes(keys[part])} | ({} if counts is None else {"counts": counts[part].astype(np.uint32).tobytes()})


COUNTED = "kind int, shard int, keys binary, counts binary"
_SHARD_TYPES = pa.schema(
    [("kind", pa.int32()), ("shard", pa.int32()), ("bits", pa.binary()), ("total", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]
)
SHARDS = "kind int, shard int, bits binary, total long, keys binary, counts binary"


def count_ngrams(docs: DataFrame, shards: int, bits_per_entry: int = BITS_PER_ENTRY) -> DataFrame:
    """One row per kind (0 words, 1 pairs) and shard: its filter, and for words the exact counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts: list) -> Iterator[pa.RecordBatch]:
            for kind in (0, 1):
                keys, counts = np.unique(np.concatenate([p[kind] for p in parts]), return_counts=True)
                rows = list(_packed(kind, keys, counts, shards))
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))

        parts, used = [], 0
        for batch in batches:
            for texts in tokens.chunks(batch.column(0).to_pylist()):
                parts.append(ngrams(texts)[:2])
                used += sum(map(len, texts))
                if used >= FLUSH_BYTES:
                    yield from flush(parts)
                    parts, used = [], 0
        if parts:
            yield from flush(parts)

    def add(table: pa.Table) -> pa.Table:
        kind, shard = table["kind"][0].as_py(), table["shard"][0].as_py()
        keys = np.concatenate([from_planes(x) for x in table["keys"]])
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table["counts"]])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order].astype(np.int64)
        firsts = np.flatnonzero(_firsts(keys))
        keys, counts = keys[firsts], np.add.reduceat(counts, firsts)
        row = {"kind": kind, "shard": shard, "bits": build_filter(keys, counts, bits_per_entry).tobytes(), "total": int(counts.sum())}
        row |= {"keys": keys.tobytes(), "counts": counts.tobytes()} if kind == 0 else {"keys": b"", "counts": b""}
        return pa.Table.from_pylist([row], _SHARD_TYPES)

    packed = docs.select("text").mapInArrow(count, COUNTED)
    return packed.groupBy("kind", "shard").applyInArrow(add, SHARDS)


def _near(texts: list[bytes], filters: list[Filter]) -> tuple:
    """(tokens, first of each text, distinct ones, place of each token in them, their levels, level of each pair) by filters at hand.

    A pair's count is cut to those of its two words, so a distinct pair is looked up once, to the level of the rarer word, and not
    at all if a word is unknown.
    """
    stream, pairs, begin = ngrams_in_parts(texts)
    words, place = np.unique(stream, return_inverse=True)
    word_levels = filters[0].levels(words)
    rarer = np.minimum(*_around(words, place, begin, word_levels))
    asked = np.flatnonzero(rarer)
    keys, firsts, back = np.unique(pairs[asked], return_index=True, return_inverse=True)
    found = np.zeros(len(pairs), np.uint8)
    found[asked] = filters[1].levels(keys, rarer[asked][firsts])[back]
    return stream, begin, words, place, word_levels, found


def _around(words: np.ndarray, place: np.ndarray, begin: np.ndarray, word_levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Levels of each token and of its history."""
    here = word_levels[place]
    before = np.concatenate((np.zeros(1, np.uint8), here[:-1]))
    before[begin] = word_levels[np.searchsorted(words, _END)]
    return here, before


def _log_probabilities(looked_up: tuple, total: int, distinct: int) -> np.ndarray:
    """Score of each text."""
    _, begin, words, place, word_levels, found = looked_up
    here, before = _around(words, place, begin, word_levels)
    single = (DECODED + 0.5) / (total + 0.5 * (distinct + 1))
    logs = DECODED[np.minimum(found, np.minimum(here, before))]
    logs += (PRIOR * single)[here]
    logs /= (DECODED + PRIOR)[before]
    return np.add.reduceat(np.log10(logs, out=logs), begin)


def frequent(vocabulary: DataFrame, most: int) -> DataFrame:
    """The words above the smallest count that no more than ``most`` words exceed; no task sees more than its own rows."""
    groups = vocabulary.groupBy("c").agg(F.count(F.lit(1)).alias("words")).toPandas().sort_values("c", ascending=False)
    fit = int((groups["words"].cumsum() <= most).sum())
    return vocabulary.where(F.col("c") > (0 if fit == len(groups) else int(groups["c"].iloc[fit])))


def score(
    docs: DataFrame, held_out, filter_bytes: int = FILTER_BYTES, head: int = HEAD, shard_bytes: int = SHARD_BYTES, bits_per_entry: int = BITS_PER_ENTRY
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score; ``held_out`` is a boolean column."""
    spark = docs.sparkSession
    bound_batches(spark)
    # What only scoring needs goes before the tail is joined.
    with shuffles_dropped(spark), scratch_scope(spark):
        scored, vocabulary, total, norm = _scored(docs, held_out, filter_bytes, head, shard_bytes, bits_per_entry)
    tail = scored.select("_row", F.explode(F.arrays_zip("tail", "tail_n")).alias("t")).select("_row", F.col("t.tail").alias("word"), F.col("t.tail_n").alias("n"))
    unknown = F.coalesce("c", F.lit(0))
    found = tail.join(vocabulary, "word", "left").groupBy("_row").agg(
        F.sum(F.when(unknown > 0, F.col("n")).otherwise(0)).alias("_known"),
        F.sum(F.col("n") * (F.log10(unknown + 0.5) - F.lit(float(norm)))).alias("_base"),
    )
    return scored.drop("tail", "tail_n").join(found, "_row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"), "score",
    )


def _scored(docs: DataFrame, held_out, filter_bytes: int, head: int, shard_bytes: int, bits_per_entry: int) -> tuple:
    """(rows with their scores, counts of the words, training tokens, logarithm that counts are divided by); both frames are stored."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = rows.where(~F.col("held_out"))
    size = train.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = size // shard_bytes + 1
    model = stored(count_ngrams(train, shards, bits_per_entry), "ngrams")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1)):
                k, c = np.frombuffer(keys.as_buffer(), np.int64), np.frombuffer(counts.as_buffer(), np.int64)
                for i in range(0, len(k), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(k[i : i + 100_000]), pa.array(c[i : i + 100_000])], ["word", "c"])

    vocabulary = stored(model.where("kind = 0").select("keys", "counts").mapInArrow(unpack, "word long, c long"), "words", outer=True)
    total, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = frequent(vocabulary, head).toPandas()
    top = top.sort_values("word", key=lambda x: x.to_numpy(np.int64).view(np.uint64))
    head_words, head_counts = top["word"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    measured = model.agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0]
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    shared = spark.sparkContext.broadcast((head_words, head_counts))
    norm = np.log10(total + 0.5 * (distinct + 1))

    def results(ids: list, looked_up: Iterable[tuple]) -> pa.RecordBatch:
        """One row per text: head part of the baseline, score, and the words outside the head with their counts."""
        words_head, counts_head = shared.value
        columns: dict[str, list] = {k: [] for k in ("n_tokens", "head_known", "head_base", "score", "tail", "tail_n")}
        for found in looked_up:
            stream, begin, words, place = found[:4]
            at = np.searchsorted(words_head, words)
            in_head = np.zeros(len(words), bool)
            inside = at < len(words_head)
            in_head[inside] = words_head[at[inside]] == words[inside]
            logs = np.zeros(len(words))
            logs[in_head] = np.log10(counts_head[at[in_head]] + 0.5) - norm
            token_in_head = in_head[place]
            ends = np.append(begin[1:], len(stream))
            columns["n_tokens"] += (ends - begin).tolist()
            columns["head_known"] += np.add.reduceat(token_in_head.astype(np.int64), begin).tolist()
            columns["head_base"] += np.add.reduceat(logs[place], begin).tolist()
            columns["score"] += _log_probabilities(found, total, distinct).tolist()
            for b, e in zip(begin, ends):
                outside = stream[b:e][~token_in_head[b:e]]
                keys, counts = np.unique(outside, return_counts=True)
                columns["tail"].append(keys.view(np.int64))
                columns["tail_n"].append(counts)
        types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        arrays = [pa.array(v, t) for v, t in zip(columns.values(), types)]
        return pa.RecordBatch.from_arrays([*ids, *arrays], ["_row", "doc_id", "held_out", *columns])

    fields = "_row long, doc_id long, held_out boolean, n_tokens long, head_known long, head_base double, score double, tail array<long>, tail_n array<long>"
    source = numbered.select("_row", F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text")
    if measured <= filter_bytes:
        sizes = [[8] * shards, [8] * shards]
        for row in model.select("kind", "shard", F.octet_length("bits").alias("size")).collect():
            sizes[row["kind"]][row["shard"]] = row["size"]
        made = [Filter.of_sizes(s) for s in sizes]
        for row in model.select("kind", "shard", "bits").toLocalIterator():
            made[row["kind"]].put(row["shard"], np.frombuffer(row["bits"], np.uint8))
        filters = spark.sparkContext.broadcast(made)
        del made

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            both = filters.value
            for batch in batches:
                if batch.num_rows:
                    yield results(list(batch.columns[:3]), (_near(t, both) for t in tokens.chunks(batch.column(3).to_pylist(), PIECE_BYTES)))

        scored = source.mapInArrow(near, fields)
    else:
        scored = _score_in_shards(source, model, shards, results, fields)
    return stored(scored, "scored", outer=True), vocabulary, total, norm


_PIECE = pa.schema([
    ("piece", pa.int64()), ("_row", pa.list_(pa.int64())), ("doc_id", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())),
    ("sizes", pa.list_(pa.int32())), ("texts", pa.binary()),
])
PIECE = "piece long, _row array<long>, doc_id array<long>, held_out array<boolean>, sizes array<int>, texts binary"
_ASKED = pa.schema([("piece", pa.int64()), ("kind", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary())])
_ANSWERED = pa.schema([("piece", pa.int64()), ("kind", pa.int32()), ("shard", pa.int32()), ("levels", pa.binary())])


def pieces(batches: Iterator[pa.RecordBatch], size: int = FAR_PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows (_row, doc_id, held_out, text) as one row per ``size`` bytes of text, which are one compressed frame."""
    ids, texts, used = [[], [], []], [], 0

    def flush() -> pa.RecordBatch:
        frame = pa.compress(b"".join(texts), codec="zstd", asbytes=True)
        row = {"piece": ids[0][0], "sizes": [len(t) for t in texts], "texts": frame} | dict(zip(("_row", "doc_id", "held_out"), ids))
        return pa.RecordBatch.from_pylist([row], _PIECE)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            for part, value in zip(ids, row):
                part.append(value)
            texts.append(tokens.encode(row[3]))
            # A text without words is a token and a row, too.
            used += len(texts[-1]) + 8
            if used >= size:
                yield flush()
                ids, texts, used = [[], [], []], [], 0
    if texts:
        yield flush()


def piece_ngrams(sizes: list[int], frame: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``ngrams`` of the texts of a piece."""
    data = memoryview(pa.decompress(frame, sum(sizes), codec="zstd"))
    return ngrams_in_parts(bytes(data[end - n : end]) for end, n in zip(np.cumsum(sizes).tolist(), sizes))


def ask(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of pieces (piece, sizes, texts), in a row for each kind and shard."""
    for batch in batches:
        for row in batch.to_pylist():
            stream, pairs, _ = piece_ngrams(row["sizes"], row["texts"])
            for kind, keys in enumerate((stream, pairs)):
                rows = [{"piece": row["piece"]} | x for x in _packed(kind, distinct_keys(keys), None, shards)]
                yield pa.RecordBatch.from_pylist(rows, _ASKED)


def answer(asked: pa.Table, part: pa.Table) -> pa.Table:
    """The levels of what pieces ask of a shard, in order; each n-gram is looked up once."""
    keys = [from_planes(x) for x in asked["keys"]]
    levels = [np.zeros(len(k), np.uint8) for k in keys]
    if keys and part.num_rows:
        bits, ends = Filter([np.frombuffer(part["bits"][0].as_buffer(), np.uint8)]), np.cumsum([len(k) for k in keys])
        keys = np.concatenate(keys)
        # In slices, for their many arrays.
        found = for_each(keys, lambda once: np.concatenate([bits.levels(once[i : i + SLICE]) for i in range(0, len(once), SLICE)]))
        levels = np.split(found, ends[:-1])
    return asked.select(["piece", "kind", "shard"]).append_column("levels", pa.array([x.tobytes() for x in levels], pa.binary())).cast(_ANSWERED)


def _score_in_shards(source: DataFrame, model: DataFrame, shards: int, results, fields: str) -> DataFrame:
    """Scores with a filter that is too large to broadcast: n-grams of pieces visit the shards."""
    dealt = stored(source.mapInArrow(pieces, PIECE), "pieces")

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        stream, pairs, begin = piece_ngrams(table["sizes"][0].as_py(), table["texts"][0].as_py())
        known = []
        for kind in (0, 1):
            mine = answers.filter(pc.equal(answers["kind"], kind)).sort_by("shard")
            known.append(np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in mine["levels"]]))
        found = for_each(pairs, lambda _: known[1])
        del pairs
        words, place = np.unique(stream, return_inverse=True)
        ids = [table[c][0].values for c in ("_row", "doc_id", "held_out")]
        return pa.Table.from_batches([results(ids, [(stream, begin, words, place, known[0], found)])])

    asked = dealt.select("piece", "sizes", "texts").mapInArrow(lambda batches: ask(batches, shards), "piece long, kind int, shard int, keys binary")
    # Stored, so that what is asked has gone before the texts are moved.
    answers = stored(
        asked.groupBy("kind", "shard")
        .cogroup(model.select("kind", "shard", "bits").groupBy("kind", "shard"))
        .applyInArrow(answer, "piece long, kind int, shard int, levels binary"),
        "answers",
    )
    return dealt.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(finish, fields)


def score_documents(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Learns from the rows whose crc32 of the id, modulo 5, is not 1, and scores all rows."""
    return score(docs, id_hash_mod(5) == 1, filter_bytes)
