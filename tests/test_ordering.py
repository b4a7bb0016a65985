import random
import re

import pytest
from pyspark.sql import functions as F

from climagrid.operators import ordering as O

from conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def brute_lag(pairs):
    """(group, value, value before it) with NULL last."""
    out = []
    for group in {g for g, _ in pairs}:
        values = sorted((v for g, v in pairs if g == group), key=lambda v: (v is None, v))
        out += [(group, v, values[i - 1] if i else None) for i, v in enumerate(values)]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def final_plan(df):
    """The executed plan; what was reused stands in it once."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(autouse=True, params=[12, 10_000])
def sample_rows(request, monkeypatch):
    """Groups are cut on a sample of a few rows, or of all rows."""
    monkeypatch.setattr(O, "SAMPLE_ROWS", request.param)
    monkeypatch.setattr(O, "SAMPLE_PER_SLICE", request.param // 10)


def counted(df):
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))


def test_cuts_follow_distinct_values(spark, monkeypatch):
    """A value that fills most of the table does not move the cuts."""
    monkeypatch.setattr(O, "SAMPLE_ROWS", 2_000)
    monkeypatch.setattr(O, "SAMPLE_PER_SLICE", 20)
    many = spark.range(20_000).select(F.lit(1).alias("g"), F.col("id").alias("v"))
    df = many.unionAll(spark.range(200_000).select(F.lit(1), F.lit(77).cast("long")))
    sizes = O._in_slices(counted(df), ["v"], ["g"], "n", 32).groupBy("_slice").count().collect()
    assert len(sizes) >= 32 and max(r["count"] for r in sizes) < 3 * 20_000 / 32
    near = O.with_neighbours(counted(df), ["v"], ["g"], slices=32)
    assert near.where("_before.value_0 <=> nullif(v, 0) - 1 and _after.value_0 <=> nullif(v, 19999) + 1").count() == 20_000


def test_slices_count_the_cuts_below(spark):
    """Slices ascend with the order, over all groups there are at most as many cuts as asked for, and light groups have none."""
    df = spark.range(5_000).selectExpr("if(id % 5 = 0, 'light' || id, 'hot') AS g", "id % 1000 AS v", "if(id % 7 = 0, null, id) AS w")
    found = O._in_slices(counted(df), ["v", "w"], ["g"], "n", 8)
    order = [(r["g"], r["v"], r["w"] is None, r["w"], r["_slice"]) for r in found.collect()]
    assert {s for g, *_, s in order if g != "hot"} == {-1}
    hot = [s for g, *_, s in sorted(r for r in order if r[0] == "hot")]
    assert hot == sorted(hot) and 1 < len(set(hot)) <= 9


@pytest.mark.parametrize("slices", [1, 3, 8, 40])
def test_neighbours_in_any_number_of_slices(spark, slices):
    random.seed(slices)
    keys = [None, "a", "b"]
    pairs = {(random.choice(keys), random.choice([None, *range(80)])) for _ in range(160)}
    df = spark.createDataFrame(list(pairs), "g string, v int")
    out = O.with_neighbours(counted(df), ["v"], ["g"], slices=slices, largest=F.col("v"))
    expected = {}
    for g in keys:
        values = sorted((v for k, v in pairs if k == g), key=lambda v: (v is None, v))
        top = max((v for v in values if v is not None), default=None)
        for i, v in enumerate(values):
            expected[(g, v)] = (values[i - 1 : i] if i else None, values[i + 1 : i + 2] or None, top)

    def shown(key):
        return None if key is None else [key["value_0"]]

    assert {(r.g, r.v): (shown(r._before), shown(r._after), r._largest) for r in out.collect()} == expected


def test_the_input_is_read_once(spark, folder):
    """The sample, the ends and the windows share the shuffled counts."""
    spark.range(3_000).selectExpr("id % 4 AS g", "id DIV 3 AS lo", "id DIV 3 + 5 AS up").write.parquet(folder)
    df = spark.read.parquet(folder)
    for out, most in ((O.counted_lag(df, "lo", ["g"]), 4), (O.counted_ranges(df, "lo", "up", ["g"]), 4), (O.counted_lag(df, "lo"), 4)):
        text = final_plan(out)
        # Without groups the cuts are a subquery; its plan, which reads the input, is not printed to the end.
        assert text.count("FileScan parquet") <= 1
        assert len(re.findall(r"^[\W\d]*Exchange ", text, re.M)) <= most


def test_building_a_frame_runs_no_job(spark, folder):
    spark.range(100).selectExpr("id % 4 AS g", "id AS lo", "id AS up").write.parquet(folder)
    df = spark.read.parquet(folder)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        O.lag_step(df, "lo"), O.lag_step(df, "lo", ["g"]), O.lead_gap(df, "lo", "up", ["g"])
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()


def test_lag_with_a_hot_group_and_hot_value(spark):
    random.seed(5)
    pairs = [("hot", random.randint(0, 50)) for _ in range(600)] + [("hot", 7)] * 400
    pairs += [(random.choice("abc"), random.choice([None, 1, 2, 3])) for _ in range(100)]
    df = spark.createDataFrame(pairs, "g string, v int")
    assert rows(O.lag_step(df, "v", ["g"])) == brute_lag(pairs)
    whole = [(0, v) for _, v in pairs]
    assert [r[1:] for r in brute_lag(whole)] == rows(O.lag_step(df.select("v"), "v"))


def test_lag_on_empty_and_on_text(spark):
    assert O.lag_step(spark.createDataFrame([], "g string, v int"), "v", ["g"]).collect() == []
    assert O.lag_step(spark.createDataFrame([], "v int"), "v").collect() == []
    words = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "v string")
    assert rows(O.lag_step(words, "v")) == [("a", "a"), ("a", None), ("b", "a"), (None, "b")]


def brute_ranges(triples):
    out = []
    for group in {g for g, _, _ in triples}:
        own = sorted(((lo, up) for g, lo, up in triples if g == group), key=lambda r: (r[0] is None, r[0], r[1] is None, r[1]))
        known = [lo for lo, _ in own if lo is not None]
        top = max(known) if known else None
        ups = [up for lo, up in own if lo == top and up is not None]
        last = (top, max(ups) if ups else None)
        marks = [i for i, r in enumerate(own) if r == last]
        for i, (lo, up) in enumerate(own):
            following = own[i + 1][0] if i + 1 < len(own) else None
            out.append((group, lo, up, following, i == marks[-1]))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_ranges_with_nulls_copies_and_one_hot_bound(spark):
    random.seed(11)
    number = lambda top: random.choice([None, *range(top)])
    triples = [(random.choice("ab"), number(6), number(6)) for _ in range(120)]
    triples += [("hot", 3, random.randint(0, 4)) for _ in range(60)] + [("nulls", None, None)] * 3
    df = spark.createDataFrame(triples, "g string, lo int, up int")
    assert rows(O.lead_gap(df, "lo", "up", ["g"])) == brute_ranges(triples)


def test_repeat_rows_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(O, "REPEAT_CHUNK", 4)
    df = spark.createDataFrame([("a", 9), ("b", 0), ("c", 1), ("d", 4)], "k string, n bigint")
    assert {r["k"]: r["count"] for r in O.repeat_rows(df, "n").groupBy("k").count().collect()} == {"a": 9, "c": 1, "d": 4}


def test_top1_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")
    out = O.deduplicate(df, ["user_id"], [F.desc("version")])
    assert rows(out) == [(1, "play", 2), (2, "pause", 1)]
    text = plan(out)
    assert "WindowGroupLimit" in text and "Partial" in text


def test_deduplicate_keeps_rows_with_nulls(spark):
    df = spark.createDataFrame([(None, None), (None, 1), (2, None)], "k int, v int")
    assert rows(O.deduplicate(df, ["k"], [F.asc_nulls_last("v")])) == [(2, None), (None, 1)]
    assert rows(O.deduplicate(df, ["k"], [F.asc_nulls_last("v")], keep_nulls=False)) == []
    full = df.unionAll(spark.createDataFrame([(5, 6), (5, 7)], df.schema))
    assert rows(O.deduplicate(full, ["k"], [F.desc("v")], keep_nulls=False)) == [(5, 7)]


def test_sorts(spark):
    df = spark.createDataFrame([(3, "c"), (1, "b"), (1, "a")], "k int, v string")
    assert [tuple(r) for r in O.sort_mart(df, ["k"], ["v"]).collect()] == [(1, "a"), (1, "b"), (3, "c")]
    stored = O.storage_order(df, ["k"], ["v"])
    assert [tuple(r) for r in stored.collect()] == [(1, "a"), (1, "b"), (3, "c")]
    assert "rangepartitioning" in plan(stored)
