"""Merkle manifest against a tree built level by level in Python."""

import hashlib
import zlib

import duckdb
import pytest
from odd_tables import no_docs, odd_docs  # noqa: F401

from climagrid.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root, and the siblings of every node as (left, right) per level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            run = i // 16 * 16
            path.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 16])))
        at = [i // 16 for i in at]
        nodes = [digest(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(docs):
    sources = {}
    for row in docs:
        sources.setdefault(row["source"], []).append((row, leaf(row, row["text"])))
    ordered = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in ordered:
        members = sorted(sources[source], key=lambda m: (m[0]["doc_id"] is not None, m[0]["doc_id"] or 0, m[1]))
        trees.append((members, *tree([h for _, h in members])))
    root, tops = tree([t[1] for t in trees])
    out = []
    for (members, subroot, paths), top in zip(trees, tops):
        for (row, h), path in zip(members, paths):
            path, text = path + top, row["text"]
            if text is not None and row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(row, text)
            for left, right in path:
                node = digest(left, node, right)
            out.append((row["doc_id"], h, subroot, root, digest(*(a + b for a, b in path)), node, node == root))
    return out


def key(row):
    return tuple(str(v) for v in row)


def test_manifest_of_odd_rows(odd_docs, no_docs):
    found = merkle.report(odd_docs.selectExpr("*", "doc_id AS pos", "text AS hash", "lang AS members", "source AS root"))
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute(odd_docs.collect()), key=key)
    assert merkle.report(no_docs).count() == 0


@pytest.mark.parametrize("levels", [1, 2])
def test_blocks_of_any_height_give_the_same_tree(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 16**levels)
    docs = spark.range(1200).selectExpr(
        "id AS doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 40)) AS source", "'en' AS lang", "id AS n_chars", "concat('Text ', id) AS text"
    )
    found = merkle.report(docs)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute(docs.collect()), key=key)


def test_sizes_around_full_runs(spark):
    """Sources of 1 to 257 rows, and 17 of them, so that the top tree has a run of one."""
    sizes = [1, 2, 15, 16, 17, 31, 32, 33, 255, 256, 257, *[1] * 6]
    rows = [(1000 * s + i, f"s{s:02d}", "en", i, f"Text {i}") for s, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert sorted(map(tuple, merkle.report(docs).collect()), key=key) == sorted(brute(docs.collect()), key=key)


def test_oracle_agrees(spark, data_dir):
    rows = [tuple(r) for r in merkle.report(spark.read.parquet(f"{data_dir}/documents.parquet")).collect()]
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{data_dir}/documents.parquet'")
        assert sorted(map(key, rows)) == sorted(map(key, db.execute(merkle.ORACLE).fetchall()))
    assert any(r[-1] for r in rows) and not all(r[-1] for r in rows)


def test_tampered_text_breaks_the_proof_and_shares_do_not_matter(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "'a' AS source", "'en' AS lang", "1 AS n_chars", "concat('Text ', id) AS text")
    one = merkle.manifest(docs).select("doc_id", "root").distinct()
    other = merkle.manifest(docs.repartition(13)).select("doc_id", "root").distinct()
    assert one.exceptAll(other).count() == 0
    path = merkle.manifest(docs).where("doc_id = 7").withColumn("folded", merkle.fold(merkle.F.col("leaf"), merkle.F.col("path"))).first()
    assert path["folded"] == path["root"] and [len(s["left"] + s["right"]) for s in path["path"]] == [15 * 64, 15 * 64, 64]
