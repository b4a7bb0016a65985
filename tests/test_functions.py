import random

import duckdb
import pytest
from pyspark.sql import functions as F

from climagrid.functions import arithmetic as A
from climagrid.functions import text as X

from conftest import rows


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_surrogate_key_goldens(spark):
    df = spark.createDataFrame(
        [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)], "x string, y string, z string"
    )
    assert column(df, X.surrogate_key(df, ["x"])) == [
        "0cc175b9c0f1b6a831c399e269772661",
        "0cc175b9c0f1b6a831c399e269772661",
        "f14cc5cdce0420f4a5a6b6d9d7b85f39",
        "f14cc5cdce0420f4a5a6b6d9d7b85f39",
    ]
    assert column(df, X.surrogate_key(df, ["x", "y", "z"])) == [
        "7b193b3d33184464106f41ddf733783b",
        "4f32a73dc87b7bbb7a654d8898d58c7e",
        "d9c538b129f1a3ad6ecfe55345c32a05",
        "2fa5491950d66d153d23cfbcfea4e164",
    ]


def test_blank_null_marker_merges_null_and_empty(spark):
    df = spark.createDataFrame([("", 1), (None, 1)], "x string, y int")
    first, second = column(df, X.surrogate_key(df, ["x", "y"], null_value=""))
    assert first == second
    first, second = column(df, X.surrogate_key(df, ["x", "y"]))
    assert first != second


def test_float_text_reads_like_the_stored_keys(spark):
    random.seed(3)
    values = [0.1, 11.2, 41.75, 43.0, -0.0, 1e-4, 2.5e-4, 1e-5, 1.5e-5, 1e7, 12345678.9, 1e15, 1e16, 1.5e20, 1e-300, 2.5e300]
    values += [random.uniform(-1, 1) * 10 ** random.randint(-4, 15) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    con = duckdb.connect()
    expected = [con.execute("select cast(? as double)::varchar", [v]).fetchall()[0][0] for v in values[:16]]
    assert column(df, X.float_text("x"))[:16] == expected
    assert [float(t) for t in column(df, X.float_text("x"))] == values


@pytest.mark.parametrize(
    "value, expected", [("!Hell0 world-hi", "hell0_world_hi"), ("0Hell0 world-hi", "_0hell0_world_hi"), ("", "")]
)
def test_slugify(value, expected):
    assert X.slugify(value) == expected


def test_safe_arithmetic_goldens(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert column(df, A.safe_add("a", "b", "c")) == [6, 4, 2, 0]
    df = spark.createDataFrame([(3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert column(df, A.safe_subtract("a", "b", "c")) == [0, 1, -2, 0]
    with pytest.raises(ValueError):
        A.safe_add(["a", "b"])


def test_safe_divide_goldens(spark):
    pairs = [(6, 0), (10, 5), (None, None), (None, 0), (17, None), (0, None), (None, 9), (0, 5)]
    df = spark.createDataFrame(pairs, "n int, d int")
    assert column(df, A.safe_divide("n", "d")) == [None, 2, None, None, None, None, None, 0]
    df = spark.createDataFrame([(6, 3, 2), (4, 0, 4), (0, 2, 6)], "n int, a int, b int")
    assert column(df, A.safe_divide("n", F.col("a") * F.col("b"))) == [1, None, 0]


def test_width_bucket_goldens(spark):
    amounts = [190000.0, 290000.0, 320000.0, 399999.99, 400000.0, 470000.0, 510000.0, 610000.0]
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    assert column(df, A.width_bucket("a", 200000.0, 600000.0, 4)) == [0, 1, 2, 2, 3, 3, 4, 5]
    above = spark.createDataFrame([(700000.0,)], "a double")
    assert column(above, A.width_bucket("a", 200000.0, 600000.0, 4)) == [6]


def test_haversine_goldens(spark):
    df = spark.createDataFrame([(48.864716, 2.349014, 52.379189, 4.899431)], "a double, b double, c double, d double")
    assert round(column(df, A.haversine("a", "b", "c", "d", unit="km"))[0]) == 430
    assert round(column(df, A.haversine("a", "b", "c", "d"))[0]) == 267
    with pytest.raises(ValueError):
        A.haversine("a", "b", "c", "d", unit="nm")


def test_rounding_decides_ties_like_duckdb(spark):
    values = [(k * 10 + 5) / 1000 - 50 for k in range(10_000)] + [0.0, -0.004999, 1e17]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    con = duckdb.connect()
    expected = [r[0] for r in con.execute("select round(x, 2) from (select unnest(?::double[]) as x)", [values]).fetchall()]
    assert column(df, A.round_half_away("x", 2)) == expected


def test_rounding_keeps_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),)], "x double")
    null, nan, inf = column(df, A.round_half_away("x", 2))
    assert null is None and nan != nan and inf == float("inf")


def test_url_goldens(spark):
    hosts = {
        "www.google.co.uk?utm_source=google&utm_medium=cpc&utm_campaign=spring-summer": "www.google.co.uk",
        "http://witanddelight.com/2018/01/tips-tricks-how-run-half-marathon-first-time/": "witanddelight.com",
        "https://www.nytimes.com/2018/01/01/blog": "www.nytimes.com",
        "android-app://m.facebook.com/": "m.facebook.com",
        "docs.nytimes.com/2021/01/01/index.js?utm_source=google": "docs.nytimes.com",
        "https://m.facebook.com/": "m.facebook.com",
    }
    df = spark.createDataFrame([(u,) for u in hosts], "url string")
    assert column(df, X.url_host("url")) == list(hosts.values())
    paths = {
        "www.google.co.uk?utm_source=google&utm_medium=cpc": "",
        "http://witanddelight.com/2018/01/tips/?utm_source=google": "2018/01/tips/",
        "https://www.nytimes.com/2018/01/01/blog": "2018/01/01/blog",
        "www.example.com": "www.example.com",
        "www.example.com?next=/a/b": "a/b",
    }
    df = spark.createDataFrame([(u,) for u in paths], "url string")
    assert column(df, X.url_path("url")) == list(paths.values())
    df = spark.createDataFrame(
        [("http://drewbanin.com/milky?utm_medium=organic",), ("http://drewbanin.com/milky?utm_medium=organic&utm_source=github",), ("x?a=",), ("x?ba=1",)],
        "url string",
    )
    assert rows(df.select(X.url_parameter("url", "utm_medium"), X.url_parameter("url", "utm_source"), X.url_parameter("url", "a"))) == [
        ("organic", "github", None),
        ("organic", None, None),
        (None, None, "1"),
        (None, None, None),
    ]


def test_urls_match_duckdb_on_odd_texts(spark):
    random.seed(9)
    pieces = ["http://", "https://", "android-app://", "a.b", "/", "//", "?", "&", "a=", "ba=", "é", "#x", " ", "=", "x"]
    texts = ["", "?", "/", "a=", None] + ["".join(random.choices(pieces, k=random.randint(1, 7))) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, url string")
    found = df.orderBy("id").select(X.url_host("url"), X.url_path("url"), X.url_parameter("url", "a")).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id INT, url VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(texts)))
    host = "replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', '')"
    path = "replace(replace(url, 'http://', ''), 'https://', '')"
    expected = con.execute(
        f"""SELECT split_part(split_part({host}, '/', 1), '?', 1),
              split_part("right"({path}, length({path}) - coalesce(nullif(strpos({path}, '/'), 0), strpos({path}, '?') - 1)), '?', 1),
              nullif(split_part(split_part(url, 'a=', 2), '&', 1), '') FROM t ORDER BY id"""
    ).fetchall()
    assert [tuple(r) for r in found] == expected


def test_width_bucket_matches_duckdb(spark):
    random.seed(2)
    values = [random.choice([None, round(random.uniform(-20, 120), 2), float(random.randint(-20, 120))]) for _ in range(3000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    found = column(df.orderBy("id"), A.width_bucket("v", 10.0, 90.0, 7))
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id INT, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    size = "((90.0::DOUBLE - 10.0) / 7)"
    expected = con.execute(
        f"""SELECT (CASE WHEN mod(TRY_CAST(v AS DECIMAL(28,6)), TRY_CAST({size} AS DECIMAL(28,6))) = 0 THEN 1 ELSE 0 END
              + least(ceil((v - 10.0) / {size}), 8))::BIGINT FROM t ORDER BY id"""
    ).fetchall()
    assert [(f,) for f in found] == expected
    # LEAST passes over a missing position, so a missing value lands above the maximum.
    assert {f for f, v in zip(found, values) if v is None} == {8}
