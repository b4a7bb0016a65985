"""Token ids of documents in ORC files.

A folder holds two ORC tables:

* ``data``: one row per document, (doc_id, part, part_start, n_tokens, ids), in ascending doc_id order over all files. Ids are a
  list of 32-bit integers, which ORC stores with its integer run-length encoding. Stripes are small enough that one file is read by
  several tasks, row indexes are kept every ``ROW_INDEX_STRIDE`` rows, and a Bloom filter on doc_id lets readers skip the row
  groups whose range holds an id but which do not contain it.
* ``parts``: (part, start), the number of ids in all parts before a part. A document starts at start + part_start.

Texts are dealt to parts by ranges of (doc_id, text hash, place) and encoded where they arrive, so every text is moved and encoded
once, and a row of ids is never shuffled. A text is cut where the vocabulary's own split pattern cuts it in any context, before a
single space between two characters that are not white space; pieces are encoded once per Python worker while they stay in a
bounded table. Cutting, looking up and joining the ids are Arrow's work on columns of pieces; only new pieces become Python strings.
The ids are those of the whole text.

Defined results: NULL text is empty (only the end id); a NULL doc_id comes first; rows with one doc_id are ordered by the hash of
their text, equal rows are interchangeable, and the place spreads them over parts; an empty table gives empty files and an empty result;
special strings in a text get their special ids, as the library does by default; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from climagrid.llm.common import bound_batches, broadcast_if_bounded

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
STRIPE_BYTES = 16 << 20
ROW_INDEX_STRIDE = 1_000
# Pieces, and as many words, that a Python worker remembers at most, and their bytes with the ids.
REMEMBERED, REMEMBERED_BYTES = 600_000, 64 << 20
# New pieces or words that are Python strings at a time.
STRINGS = 200_000
# Texts of so many bytes, or one longer text, are encoded at a time: more of their pieces are equal.
TOGETHER_BYTES = 8 << 20
# Characters the library gets at a time; it needs far more memory for their tokens.
LIBRARY_CHARS = 1 << 20
# Characters that some reading of the split pattern takes for white space, besides those of str.isspace.
_DOUBTFUL = "᠎​⁠﻿"
# A space that every reading cuts before: its neighbours are white space by none.
_BLANK = rf"\s\x1c-\x1f\x85{_DOUBTFUL}"
_INNER = f"[^{_BLANK}]"
_CUT = re.compile(f"(?<={_INNER}) (?={_INNER})")
# A space that is not such, as Arrow's engine has it.
_WHITE = "".join(rf"\x{{{ord(c):x}}}" for c in re.findall(f"[{_BLANK}]", "".join(map(chr, range(sys.maxunicode + 1)))))
_OTHER_SPACE = rf"(?:\A|[{_WHITE}]) | (?:[{_WHITE}]|\z)"
# The vocabulary's published split pattern, used for characters below _LAST: Latin letters, whose classes no library sees otherwise.
# With its classes written out for these characters, the standard library's quicker engine runs it.
_LAST = "\u0250"


def _spelled(pattern: str) -> re.Pattern:
    letters, numbers, spaces = (
        "".join(re.escape(chr(c)) for c in range(ord(_LAST)) if regex.fullmatch(kind, chr(c))) for kind in (r"\p{L}", r"\p{N}", r"\s")
    )
    others = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
    for kind, members in ((r"\p{L}", letters), (r"\p{N}", numbers), (r"\s", spaces), (r"\S", f"^{spaces}")):
        others = others.replace(kind, f"[{members}]")
    return re.compile(others)


_WORDS = _spelled(public_tokenizers.PATTERN)
_LATIN = re.compile(rf"[\0-{chr(ord(_LAST) - 1)}]*")
# A space and a piece of such characters without another space, and without white space at its ends.
_END = rf"[^{_BLANK}{_LAST}-\U0010ffff]"
_PLAIN = re.compile(rf" {_END}(?:[^ {_LAST}-\U0010ffff]*{_END})?")

DATA = "doc_id long, part int, part_start long, n_tokens int, ids array<int>"
_DATA = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.int32()), ("part_start", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.list_(pa.int32()))]
)
_IDS = pa.list_(pa.int32())


def _lists(sizes, ids) -> pa.ListArray:
    """Lists of so many of the ids, one after another."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.asarray(ids, np.int32)))


def _joined(lists: pa.ListArray, starts: np.ndarray) -> pa.ListArray:
    """Longer lists: the lists from each start up to the next one in a row."""
    return pa.ListArray.from_arrays(pa.array(lists.offsets.to_numpy()[starts]), lists.values)


def _groups(items: Iterable, size: Callable, most: int) -> Iterator[list]:
    """Lists of the items in order, each of that size at most or of one larger item."""
    group, total = [], 0
    for item in items:
        if group and total + size(item) > most:
            yield group
            group, total = [], 0
        group.append(item)
        total += size(item)
    if group:
        yield group


class Table:
    """Ids of texts; when there are too many, those not in the last call are forgotten, and all if that isn't enough."""

    def __init__(self, encode):
        self.encode = encode  # a list of texts to the ids of each
        self.texts, self.lists = pa.array([], pa.string()), pa.array([], _IDS)

    def ids(self, texts: pa.StringArray) -> pa.ListArray:
        known = pc.index_in(texts, value_set=self.texts)
        is_new = known.is_null()
        new = texts.filter(is_new).dictionary_encode()
        places = known.fill_null(0).to_numpy().copy()
        places[is_new.to_numpy(zero_copy_only=False)] = len(self.texts) + new.indices.to_numpy()
        if len(new):
            learned = new.dictionary
            lists = [self.encode(learned[a : a + STRINGS].to_pylist()) for a in range(0, len(learned), STRINGS)]
            self.texts, self.lists = pa.concat_arrays([self.texts, learned]), pa.concat_arrays([self.lists, *lists])
        found = self.lists.take(pa.array(places))
        for kept in (places, places[:0]):
            if len(self.texts) > REMEMBERED or self.texts.nbytes + self.lists.nbytes > REMEMBERED_BYTES:
                of_call = np.zeros(len(self.texts), bool)
                of_call[kept] = True
                self.texts, self.lists = self.texts.filter(pa.array(of_call)), self.lists.filter(pa.array(of_call))
                places = (np.cumsum(of_call) - 1)[places]
        return found


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen, else one from 256 upwards."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(0x100) if b not in set(seen)]
    return {b: chr(b) for b in seen} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of whole texts.

    With a byte-level vocabulary, texts are cut into pieces that are encoded once. A new piece of letters whose classes never change
    is split by the published pattern, and the library's model encodes the words that are new; any other piece, and
    any text for another kind of vocabulary, goes through the library as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        form = json.loads(self.library.to_str())
        split = form["pre_tokenizer"] or {}
        self.by_bytes = form["normalizer"] is None and split.get("type") == "ByteLevel" and not split["add_prefix_space"] and split.get("use_regex", True)
        self.special = [token["content"] for token in form["added_tokens"]]
        self.letters = _byte_letters()
        self.inner = {byte: letter for byte, letter in self.letters.items() if byte}
        self.words, self.pieces = Table(self._by_model), Table(self._by_words)

    def _whole(self, texts: list[str]) -> list[bytes]:
        groups = _groups(texts, len, LIBRARY_CHARS)
        return [array("i", x.ids).tobytes() for group in groups for x in self.library.encode_batch_fast(group, add_special_tokens=False)]

    def _by_library(self, texts: list[str]) -> pa.ListArray:
        found = self._whole(texts)
        return _lists([len(x) // 4 for x in found], np.frombuffer(b"".join(found), np.int32))

    def _by_model(self, words: list[str]) -> pa.ListArray:
        tokenize, joined = self.library.model.tokenize, "\0".join(words)
        if joined.count("\0") == len(words) - 1:  # all words in one go; the zero byte has no letter of its own then
            shown = joined.encode("utf-8").decode("latin-1").translate(self.inner).split("\0")
        else:
            shown = [w.encode("utf-8").decode("latin-1").translate(self.letters) for w in words]
        sizes, ids, id_of = [], [], attrgetter("id")
        for word in shown:
            tokens = tokenize(word)
            sizes.append(len(tokens))
            ids += map(id_of, tokens)
        return _lists(sizes, ids)

    def _by_words(self, pieces: list[str]) -> pa.ListArray:
        """The ids of each piece, with the space that it has before it.

        Plain pieces are split in one go, one after another: the pattern cuts before their spaces, and they have no others.
        """
        ways = np.array([0 if _PLAIN.fullmatch(p) else 1 if _LATIN.fullmatch(p) else 2 for p in pieces], np.int8)
        order = np.argsort(ways, kind="stable")
        plain, latin, others = ([pieces[i] for i in order[ways[order] == way]] for way in range(3))
        words = pa.array(_WORDS.findall("".join(plain)) if plain else [], pa.string())
        split = [_WORDS.findall(p) for p in latin]
        begins = np.flatnonzero(pc.starts_with(words, " ").to_numpy(zero_copy_only=False))
        starts = np.concatenate([begins, np.cumsum([len(words), *map(len, split)])])
        of_words = self.words.ids(pa.concat_arrays([words, pa.array(chain.from_iterable(split), pa.string())]))
        found = pa.concat_arrays([_joined(of_words, starts), self._by_library(others)])
        return found.take(pa.array(np.argsort(order)))

    def _by_pieces(self, texts: pa.ListArray) -> pa.ListArray:
        """The ids of texts that were cut into pieces; the spaces between them are gone."""
        starts, coded = texts.offsets.to_numpy(), texts.values.dictionary_encode()
        del texts  # the pieces take more memory than the rest
        places, firsts = coded.indices.to_numpy(), starts[:-1]
        is_later = np.ones(len(places), bool)
        is_later[firsts] = False
        used = np.zeros(len(coded.dictionary), bool)
        used[places[is_later]] = True
        later = pc.binary_join_element_wise(" ", coded.dictionary.filter(pa.array(used)), "")
        ids = self.pieces.ids(pa.concat_arrays([later, coded.dictionary.take(pa.array(places[firsts]))]))
        places = (np.cumsum(used, dtype=np.int32) - 1)[places]
        places[firsts] = len(later) + np.arange(len(firsts))
        return _joined(ids.take(pa.array(places)), starts)

    def lists(self, texts: pa.StringArray) -> pa.ListArray:
        """The ids of each text."""
        ways = np.zeros(len(texts), np.int8)  # cut at every space, cut at some, whole
        ways[pc.match_substring_regex(texts, _OTHER_SPACE).to_numpy(zero_copy_only=False)] = 1
        for special in self.special:
            ways[pc.match_substring(texts, special).to_numpy(zero_copy_only=False)] = 2
        if not self.by_bytes:
            ways[:] = 2
        if not ways.any():
            return self._by_pieces(pc.split_pattern(texts, " "))
        order = np.argsort(ways, kind="stable")
        every, some, whole = (texts.take(pa.array(order[ways[order] == way])) for way in range(3))
        cut = [pc.split_pattern(every, " "), pa.array([_CUT.split(t) for t in some.to_pylist()], pa.list_(pa.string()))]
        found = pa.concat_arrays([self._by_pieces(pa.concat_arrays(cut)), self._by_library(whole.to_pylist())])
        return found.take(pa.array(np.argsort(order)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes of little-endian 32-bit integers."""
        found = self.lists(pa.array(texts, pa.string()))
        ids, ends = found.values.to_numpy(), found.offsets.to_numpy()
        return [ids[a:b].astype("<i4").tobytes() for a, b in zip(ends[:-1], ends[1:])]


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """The rows of ``data``, in order over the partitions."""
    order = ["doc_id", "_hash", "_place"]
    placed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_place"), "text"
    )
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for group in _groups(batches, lambda batch: batch.nbytes, TOGETHER_BYTES):
            doc_ids, texts = (pa.chunked_array([batch.column(i) for batch in group]).combine_chunks() for i in range(2))
            sizes = [batch.num_rows for batch in group]
            group.clear()
            lists = encoder(tokenizer).lists(texts.cast(pa.string()).fill_null(""))
            ends = lists.offsets.to_numpy()
            ids = np.insert(lists.values.to_numpy(), ends[1:], end_id)
            offsets = ends.astype(np.int64) + np.arange(len(ends))
            columns = [
                doc_ids, pa.array(np.full(len(lists), part, np.int32)), pa.array(start + offsets[:-1]),
                pa.array(np.diff(offsets).astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
            ]
            start += int(offsets[-1])
            found = pa.RecordBatch.from_arrays(columns, schema=_DATA)
            for end, size in zip(np.cumsum(sizes).tolist(), sizes):  # in batches as small as they came
                yield found.slice(end - size, size)

    return ordered.mapInArrow(encode, DATA)


def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> None:
    """Encode ``docs`` into the files of a new folder."""
    bound_batches(docs.sparkSession)
    settings = {
        "orc.stripe.size": STRIPE_BYTES, "orc.row.index.stride": ROW_INDEX_STRIDE, "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": 0.01, "compression": "zstd",
    }
    encoded(docs, tokenizer, end_id).write.options(**settings).orc(f"{path}/data")
    sums = docs.sparkSession.read.schema(DATA).orc(f"{path}/data").groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    # One row per part, so one window task sees as many rows as there are files.
    before = W.partitionBy().orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = sums.select("part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).cast("long").alias("start"))
    parts.write.orc(f"{path}/parts")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files. Conditions on doc_id reach the stripes and row indexes."""
    data = spark.read.schema(DATA).orc(f"{path}/data")
    parts = spark.read.schema("part int, start long").orc(f"{path}/parts")
    rows = data.join(broadcast_if_bounded(parts, 12), "part")
    return rows.select("doc_id", (F.col("start") + F.col("part_start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def report(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ids, ends = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            sizes = pa.array(np.diff(ends).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), sizes, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    rows = read(spark, path).select("doc_id", "start", "ids")
    return rows.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
