"""Token files against the library on whole texts."""

import random
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from odd_tables import no_docs, odd_docs  # noqa: F401
from tokenizers import Tokenizer

from climagrid.llm import token_files


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_files.TOKENIZER)


def brute(library, docs):
    out, start = [], 0
    for row in sorted(docs, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids + [token_files.END_ID]
        out.append((row["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def by_start(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: r[1])


def test_pieces_give_the_ids_of_whole_texts(library):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "\xa0", "　", "​", "᠎", "﻿", "\x1c", "\x85", " ", "a", "Word", "é", "漢字", "12", "'s", "'", "!", "<|endoftext|>", "😀", "́", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    found = token_files.Encoder(token_files.TOKENIZER).encode(texts)
    expected = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(f, "<i4").tolist() for f in found] == expected


def test_every_latin_character_between_letters(library):
    """Characters of the short way, alone and next to letters, digits, spaces and marks."""
    texts = [f"{a}{chr(c)}{b}" for c in range(0x250) for a in ("", "a", "1 ", "é ", "!") for b in ("", "b", " 2", "'s", " ")]
    found = token_files.Encoder(token_files.TOKENIZER).encode(texts)
    assert [np.frombuffer(f, "<i4").tolist() for f in found] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_other_vocabularies_are_left_to_the_library():
    path = token_files.public_tokenizers.path("word_bpe_49k.json")
    texts = ["Hello  World, it's", "", " a"]
    plain = [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(f, "<i4").tolist() for f in token_files.Encoder(path).encode(texts)] == plain


def test_forgetting_pieces_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 3)
    encoder = token_files.Encoder(token_files.TOKENIZER)
    for text in ("one two three four five", "six seven eight nine ten", "one six two seven", "nine one three", "x"):
        assert np.frombuffer(encoder.encode([text])[0], "<i4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoder.encode([]) == []


def test_files_of_odd_rows(spark, odd_docs, no_docs, folder, library):
    docs = odd_docs.selectExpr("*", "doc_id AS part", "text AS ids", "doc_id AS start")
    token_files.write(docs, folder)
    found = by_start(token_files.report(spark, folder).collect())
    assert found == brute(library, odd_docs.collect())
    token_files.write(no_docs, folder + "-empty")
    assert token_files.report(spark, folder + "-empty").count() == 0


def test_round_trip_over_many_parts(spark, data_dir, folder, library):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    hot = docs.selectExpr("if(doc_id % 3 = 0, cast(null as bigint), doc_id) AS doc_id", "text").repartition(8)
    token_files.write(docs.repartition(8), folder)
    assert by_start(token_files.report(spark, folder).collect()) == brute(library, docs.collect())
    ids = [r["ids"] for r in token_files.read(spark, folder).orderBy("start").limit(5).collect()]
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(5).collect()]
    assert [library.decode(i[:-1]) for i in ids] == texts
    token_files.write(hot, folder + "-hot")
    rows = by_start(token_files.report(spark, folder + "-hot").collect())
    sizes = [r[2] for r in rows]
    assert [r[1] for r in rows] == [sum(sizes[:i]) for i in range(len(sizes))]
    assert sorted(r[2:] for r in rows) == sorted(r[2:] for r in brute(library, docs.collect()))


def test_files_have_indexes_and_readers_use_them(spark, data_dir, folder):
    """Every stripe has row indexes and Bloom filters of doc_id; a reader's condition reaches the scan."""
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    token_files.write(docs, folder)
    found = token_files.read(spark, folder).where("doc_id = 17")
    assert found.count() == 1
    assert "EqualTo(doc_id,17)" in found._jdf.queryExecution().executedPlan().toString()
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    kinds, last = set(), None
    for file in sorted(Path(folder, "data").glob("part-*.orc")):
        path = jvm.org.apache.hadoop.fs.Path(str(file))
        reader = jvm.org.apache.orc.OrcFile.createReader(path, jvm.org.apache.orc.OrcFile.readerOptions(conf))
        assert reader.getRowIndexStride() == token_files.ROW_INDEX_STRIDE
        rows = reader.rows()
        for stripe in reader.getStripes():
            for stream in rows.readStripeFooter(stripe).getStreamsList():
                kinds.add((stream.getColumn(), stream.getKind().toString()))
        rows.close()
        low = reader.getStatistics()[1]
        if reader.getNumberOfRows():
            assert last is None or low.getMinimum() > last  # files and their statistics ascend
            last = low.getMaximum()
    assert (1, "ROW_INDEX") in kinds and (1, "BLOOM_FILTER_UTF8") in kinds


def test_latin_texts_are_split_as_published():
    """The written-out classes cut as the published pattern does, and words joined for the model get the library's ids."""
    published, picked = regex.compile(public_tokenizers.PATTERN), random.Random(4)
    letters = "ab'st're ²½ªµ×÷ÿɏ09_-.\n\t \x1c\x85\xa0\0  'll"
    texts = ["".join(picked.choice(letters) for _ in range(picked.randint(0, 30))) for _ in range(3000)]
    texts += [chr(c) + "a " + chr(c) for c in range(ord(token_files._LAST))]
    assert [token_files._WORDS.findall(t) for t in texts] == [published.findall(t) for t in texts]
    encoder = token_files.Encoder(token_files.TOKENIZER)
    assert encoder.encode(texts) == encoder._whole(texts)


def test_new_pieces_are_split_in_one_go(monkeypatch):
    calls = []

    class Counted:
        def findall(self, text, split=token_files._WORDS.findall):
            calls.append(text)
            return split(text)

    monkeypatch.setattr(token_files, "_WORDS", Counted())
    texts = [" ".join(f"wörd{i}x, isn't{j}" for i in range(50)) for j in range(20)]
    encoder = token_files.Encoder(token_files.TOKENIZER)
    assert encoder.encode(texts) == encoder._whole(texts)
    assert len(calls) <= 2


def test_repeated_pieces_do_not_become_strings():
    """Only pieces that are new cost a Python string each; the others stay in Arrow's columns."""
    picked = random.Random(5)
    words = [f"word{i}" for i in range(500)]
    texts = [" ".join(picked.choices(words, k=1000)) for _ in range(300)]
    encoder = token_files.Encoder(token_files.TOKENIZER)
    encoder.encode(texts)
    tracemalloc.start()
    found = encoder.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == encoder._whole(texts)
    assert peak - sum(map(len, found)) < 45 * 1000 * len(texts)  # a string alone takes 50 bytes and more


def test_groups_of_batches():
    """Items and their order stay; one above the bound stays alone."""
    items = ["ab", "", "cde", "f" * 20, "g", "hijk", "l"]
    assert list(token_files._groups(iter(items), len, 5)) == [["ab", "", "cde"], ["f" * 20], ["g", "hijk"], ["l"]]
    assert list(token_files._groups([], len, 5)) == []


def test_columns_of_texts(library):
    """Slices of columns are read as they are, and rows of all kinds keep their order."""
    texts = ["one two", "", " a  b ", "x" * 1000, "<|endoftext|> a", "漢字 漢 字", "é\n \nè"] * 5
    column, encoder = pa.array(texts), token_files.Encoder(token_files.TOKENIZER)
    expected = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert encoder.lists(column).to_pylist() == expected
    assert [encoder.lists(column.slice(a, 3)).to_pylist() for a in range(35)] == [expected[a : a + 3] for a in range(35)]


def test_memory_of_pieces_is_bounded(monkeypatch, library):
    """By bytes too, for texts without spaces; new pieces become strings, and texts go to the library, a few at a time."""
    for name, most in (("REMEMBERED_BYTES", 5000), ("STRINGS", 7), ("LIBRARY_CHARS", 50)):
        monkeypatch.setattr(token_files, name, most)
    encoder = token_files.Encoder(token_files.TOKENIZER)
    sizes, whole = [], encoder.library.encode_batch_fast

    class Counted:
        def encode_batch_fast(self, texts, **options):
            sizes.append((len(texts), sum(map(len, texts))))
            return whole(texts, **options)

        model = encoder.library.model

    encoder.library = Counted()
    for i in range(30):
        texts = ["漢字" * 60 + str(i), *(f"字{i} {j} word{i}-{j}" for j in range(20)), "a b"]
        found = [np.frombuffer(x, "<i4").tolist() for x in encoder.encode(texts)]
        assert found == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
        for table in (encoder.pieces, encoder.words):
            assert table.texts.nbytes + table.lists.nbytes <= 5000
    assert all(n == 1 or size <= 50 for n, size in sizes)
