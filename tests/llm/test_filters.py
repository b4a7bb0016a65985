"""Exact dedup, n-gram join, decontamination and mixing against brute force."""

import hashlib
import random
import re

import pytest
from conftest import rows
from odd_tables import no_docs, odd_docs, swapped_twins  # noqa: F401

from climagrid.llm import common, decontamination, exact_dedup, mixing, ngram_join


def normal(text):
    return re.sub(r"[ \t-\r]+", " ", text or "")


def test_exact_dedup_on_odd_rows(odd_docs, no_docs):
    found = [r.asDict() for r in exact_dedup.report(odd_docs, bucket_entries=1).collect()]
    docs = odd_docs.collect()
    assert len(found) == len(docs)
    groups = {}
    for r in docs:
        groups.setdefault(normal(r["text"]), []).append(r["doc_id"])
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in found:
        ids = by_sha[r["text_sha256"]]
        assert r["group_size"] == len(ids) and r["keep_id"] == min((i for i in ids if i is not None), default=None)
    assert sum(r["kept"] for r in found) == len(groups)
    kept = exact_dedup.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len(groups)
    assert exact_dedup.report(no_docs).count() == 0 and exact_dedup.deduplicated(no_docs).count() == 0


def test_directory_splits_overfull_buckets(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    keys = docs.select(exact_dedup.key_of(exact_dedup.normal_text()).alias("key"))
    cells = exact_dedup.directory(keys, bucket_entries=20)
    index = exact_dedup.build_index(docs, cells)
    loads = [r["count"] for r in index.groupBy("local_depth", "bucket").count().collect()]
    assert sum(loads) == 500 and max(loads) <= 20 and len(loads) > 20
    depths = {r["local_depth"] for r in index.select("local_depth").distinct().collect()}
    assert len(depths) > 1  # only overfull buckets were split further
    alike = spark.createDataFrame([(i << 20,) for i in range(40)], "key long")  # differ in their last bits only
    deep = exact_dedup.directory(alike, bucket_entries=4).collect()
    assert {r["depth"] for r in deep} == {42} and max(r["local_depth"] for r in deep) == 42


@pytest.mark.parametrize("bits", [1, 8])
def test_chains_tell_texts_with_one_key_apart(spark, bits):
    """With few bits most keys are shared; the chains still hold every text, and the results stay the same."""
    docs = spark.range(600).selectExpr("id AS doc_id", "concat('text  ', id % 400) AS text")
    cells = exact_dedup.directory(docs.select(exact_dedup.key_of(exact_dedup.normal_text(), bits).alias("key")).distinct(), 3)
    index = exact_dedup.build_index(docs, cells, bits)
    assert index.count() == 400 and index.select("key", "chain").distinct().count() == 400
    assert index.agg({"chain": "max"}).first()[0] > (100 if bits == 1 else 3)
    assert rows(exact_dedup.report(docs, 3, bits)) == rows(exact_dedup.report(docs))


def test_lookups_need_the_directory(spark, monkeypatch):
    """Without its cells, no document finds its chain."""
    docs = spark.range(50).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    monkeypatch.setattr(exact_dedup, "directory", lambda keys, n: keys.select("key", exact_dedup.F.lit(0).alias("cell")).selectExpr(
        "cell", "0 AS local_depth", "0L AS bucket", "64 AS depth").where("false"))
    assert exact_dedup.report(docs).count() == 0


def shingles(text):
    words = [w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower()) if w]
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute_classes(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    links, root = dict.fromkeys(sets, 0), {i: i for i in sets}
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
    return root, links


@pytest.mark.parametrize("block", [1024, 4])
def test_ngram_join_equals_brute_force(spark, monkeypatch, block):
    """Chains, copies and a group of near copies; with small blocks, components are verified in parts."""
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", block)
    base = [f"w{i}" for i in range(60)]
    texts = {i: " ".join(base[:20] + [f"x{i}"] + base[21:]) for i in range(12)}
    texts |= {20 + i: " ".join([f"y{j + 3 * i}" for j in range(60)]) for i in range(8)}
    texts |= {40: texts[0], 41: texts[0].upper(), 50: "", 51: "a b", 52: "A  b!", 53: " ".join(f"z{i}" for i in range(30))}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    root, links = brute_classes(texts)
    found = {r["doc_id"]: r for r in ngram_join.report(docs).collect()}
    assert {i: r["class_id"] for i, r in found.items()} == root
    assert {i: r["n_links"] for i, r in found.items()} == links
    assert sorted(i for i, r in found.items() if r["kept"]) == sorted(set(root.values()))
    left = ngram_join.one_of_each(docs)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(root.values()))


def test_words_that_mirror_each_other_are_told_apart(spark):
    one, other = (w.decode() for w in swapped_twins())
    docs = spark.createDataFrame([(1, f"{one} b c d e f"), (2, f"{other} b c d e f")], "doc_id long, text string")
    assert brute_classes({r["doc_id"]: r["text"] for r in docs.collect()})[1] == {1: 0, 2: 0}
    assert {r["doc_id"]: (r["n_links"], r["kept"]) for r in ngram_join.report(docs).collect()} == {1: (0, True), 2: (0, True)}


def test_ngram_join_on_given_documents(spark, data_dir):
    """No link between the given documents is lost, and none is made up."""
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()}
    root, links = brute_classes(texts)
    found = {r["doc_id"]: r for r in ngram_join.report(spark.read.parquet(f"{data_dir}/documents.parquet")).collect()}
    assert sum(links.values()) > 0
    assert {i: (r["class_id"], r["n_links"]) for i, r in found.items()} == {i: (root[i], links[i]) for i in texts}


def test_ngram_join_on_odd_rows(odd_docs, no_docs):
    found = ngram_join.report(odd_docs).collect()
    assert len(found) == odd_docs.count()
    assert ngram_join.report(no_docs).count() == 0
    assert ngram_join.one_of_each(odd_docs).columns == odd_docs.columns


def test_bands_reach_the_recall():
    bands, rows_each = ngram_join.choose_bands(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows_each) ** bands >= 0.9999 and bands * rows_each <= ngram_join.MAX_HASHES


def test_decontamination_of_short_and_long_items(spark, odd_docs, no_docs):
    words = [f"v{i}" for i in range(40)]
    docs = spark.createDataFrame(
        [
            (1, " ".join(words[:13]), "x"), (2, " ".join(words[1:13] + ["no"]), "x"), (3, "Say HELLO, there now", "x"),
            (4, "hello", "x"), (5, None, "x"), (6, "pre " + " ".join(words[5:30]) + " post", "x"), (6, "other", "x"),
        ],
        "doc_id long, text string, item_id string",
    )
    items = spark.createDataFrame([(7, " ".join(words)), (8, "hello there"), (9, ""), (None, "now")], "item_id long, text string")
    found = rows(decontamination.report(docs, items).select("doc_id", "n_words", "n_hit", "n_items", "contaminated"))
    assert found == sorted(
        [(1, 13, 13, 1, True), (2, 13, 0, 0, False), (3, 4, 3, 1, True), (4, 1, 0, 0, False), (5, 0, 0, 0, False), (6, 27, 25, 1, True), (6, 1, 0, 0, False)],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
    left = decontamination.decontaminated(docs, items)
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 4, 5, 6] and left.columns == docs.columns
    assert decontamination.report(odd_docs, items.limit(0)).where("contaminated").count() == 0
    assert decontamination.report(no_docs, items).count() == 0


def test_mixing_targets_and_odd_rows(spark, odd_docs, no_docs):
    mix = mixing.mix(odd_docs).collect()
    assert len(mix) == odd_docs.count()
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) and r["target"] <= 2 * r["source_size"] for r in mix)
    assert mixing.mix(no_docs).count() == 0
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), (None, 10)], "source string, size long")
    targets = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert targets == {"a": 200.0, "b": pytest.approx(1110 * 1.5 - 220), None: 20.0}


def test_shared_neighbours_leave_one_edge_per_node(spark):
    """As in a group of near copies: each of 300 nodes is linked with the same 20, both ways round; some nodes stand alone."""
    edges = [(n, p) if n % 2 else (p, n) for n in range(20, 320) for p in range(20)] + [(900, 901), (950, 950)]
    frame = spark.createDataFrame(edges, "a long, b long")
    assert common.thinned(frame).count() <= 300 + 20 + 2
    found = {r.node: r.root for r in common.components(frame).collect()}
    assert found == {n: 0 for n in range(320)} | {900: 900, 901: 900, 950: 950}


def test_components_of_random_edges(spark):
    picked = random.Random(3)
    edges = [(picked.randrange(400), picked.randrange(400)) for _ in range(260)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()} == root
