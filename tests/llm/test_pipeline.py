"""The corpus pipeline: each stage with clashing columns, and all stages against brute force."""

import hashlib
import re
from pathlib import Path

import duckdb
import pytest
from odd_tables import odd_docs  # noqa: F401
from test_filters import brute_classes, normal

import corpus_pipeline
from climagrid.llm import exact_dedup, mixing, toxicity
from climagrid.llm.common import scratch_scope
from climagrid.session import shared_dir

# Names that operators use for columns of their own.
CLASHES = [
    "dedup_id", "dedup_sha256", "row_key", "again_key", "ngram_key", "key_a", "key_b", "_key", "key_0", "row", "toxicity_score", "score", "label_id",
    "size", "source_size", "target", "taken", "node", "words", "kept", "keep_id", "group_size", "_text", "_row", "item_id", "hash", "doc_key",
]


@pytest.fixture
def clashing(odd_docs):
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    return plain.selectExpr("*", *[f"concat('{c} ', coalesce(cast(doc_id as string), 'none'), '/', {i}) AS `{c}`" for i, c in enumerate(CLASHES)])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_keep_clashing_columns(spark, clashing, data_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, clashing, data_dir)
    shown = {"size_": "size", "source_size_": "source_size", "target_": "target", "taken_": "taken"} if name == "mixing" else {}
    assert len(set(out.columns)) == len(out.columns)
    assert set(clashing.columns) <= {shown.get(c, c) for c in out.columns}
    before = {tuple(str(v) for v in r) for r in clashing.collect()}
    back = out.select(*[next(o for o in out.columns if shown.get(o) == c or (o == c and c not in shown.values())) for c in clashing.columns])
    after = [tuple(str(v) for v in r) for r in back.collect()]
    assert after and set(after) <= before
    empty = stage(spark, clashing.limit(0), data_dir)
    assert empty.count() == 0 and empty.columns == out.columns


def test_repeated_rows_are_picked_by_all_columns(spark, data_dir):
    """Whatever the order of the input, the same one of the rows with one id and one text stays."""
    docs = spark.range(40).selectExpr("id % 2 AS doc_id", "'one two three four five six' AS text", "'en' AS lang", "cast(37 * id % 40 as string) AS source", "id AS n_chars")
    stages = dict(corpus_pipeline.STAGES)
    for name in ("exact_dedup", "ngram_join"):
        picks = {tuple(stages[name](spark, docs.repartition(n, "n_chars"), data_dir).first()) for n in (1, 3, 7)}
        assert picks == {(0, "one two three four five six", "en", "0", 0)}


def words(text):
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def test_pipeline_equals_brute_force(spark, data_dir):
    """The model says which documents are toxic; every later stage is done again by brute force on what was kept."""
    table = spark.read.parquet(f"{data_dir}/documents.parquet")
    judged = toxicity.classify(table, spark.read.parquet(f"{data_dir}/labels.parquet"))
    clean = {r["doc_id"] for r in judged.where("predicted = 0").collect()}
    texts = {r["doc_id"]: r["text"] for r in table.collect() if r["doc_id"] in clean}
    firsts = {}
    for doc_id in sorted(texts):
        firsts.setdefault(hashlib.sha256(normal(texts[doc_id]).encode()).digest(), doc_id)
    texts = {i: texts[i] for i in firsts.values()}
    root, _ = brute_classes(texts)
    texts = {i: t for i, t in texts.items() if root[i] == i}
    items = [words(r["text"]) for r in spark.read.parquet(f"{data_dir}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + min(13, len(w))]) for w in items if w for i in range(len(w) - min(13, len(w)) + 1)}
    kept = {}
    for doc_id, text in texts.items():
        own, hit = words(text), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                if tuple(own[i : i + n]) in windows:
                    hit.update(range(i, i + n))
        if not hit or 20 * len(hit) < len(own):
            kept[doc_id] = text
    out = corpus_pipeline.run(spark, data_dir)
    assert set(out.columns) == {*table.columns, "size", "source_size", "target", "taken"}
    found = sorted(tuple(r) for r in out.select("doc_id", "size", "source_size", "target", "taken").collect())
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{data_dir}/documents.parquet' WHERE doc_id IN ({','.join(map(str, kept))})")
        expected = sorted(db.execute(mixing.ORACLE).fetchall())
    assert [r[:3] + r[4:] for r in found] == [r[:3] + r[4:] for r in expected]
    assert all(abs(a[3] - b[3]) < 1e-6 for a, b in zip(found, expected))


def test_scope_removes_what_operators_store(spark, odd_docs, folder):
    def left():
        return {p.name for p in Path(shared_dir(spark).removeprefix("file://")).glob("climagrid-*")}

    before = left()
    with scratch_scope(spark):
        exact_dedup.deduplicated(odd_docs).write.parquet(folder)
        assert left() > before
    assert left() == before and spark.read.parquet(folder).count() > 0
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        mixing.mix(odd_docs)
        1 / 0
    assert left() == before


def test_rows_without_ids_are_spread(spark):
    """A third of all rows without an id do not share one stretch of their queue, and the mix repeats."""
    docs = spark.range(900).selectExpr("if(id % 3 = 0, null, id) AS doc_id", "'s' AS source", "concat('word ', id) AS text")
    mixed = [sorted(map(str, mixing.mix(d).collect())) for d in (docs, docs.repartition(7))]
    assert mixed[0] == mixed[1]
    taken = [r["taken"] for r in mixing.mix(docs).where("doc_id IS NULL").collect()]
    assert len(set(taken)) > 1  # not all or none of them
