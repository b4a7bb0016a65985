from datetime import datetime

import pytest
from pyspark.sql import functions as F

from climagrid.operators import sets, shape

from conftest import rows


def test_star(spark):
    df = spark.createDataFrame([("a", "b", "c")], "field_1 string, field_2 string, field_3 string")
    assert shape.star_except(df, ["FIELD_3"]).columns == ["field_1", "field_2"]
    assert shape.star_except(df, prefix="prefix_", suffix="_suffix").columns == [f"prefix_field_{i}_suffix" for i in (1, 2, 3)]
    assert shape.star_except(df, ["field_1", "field_2", "field_3"]).columns == []
    aliased = df.alias("t").select(*shape.star_columns(df, ["field_1"], relation_alias="t"))
    assert aliased.columns == ["field_2", "field_3"]


def test_star_as_group_keys(spark):
    df = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("c", "d", 3), ("c", "e", 4)], "g string, h string, v int")
    assert rows(df.groupBy(*shape.star_columns(df, ["v"])).agg(F.sum("v"))) == [("a", "b", 3), ("c", "d", 3), ("c", "e", 4)]
    assert rows(shape.group_by_n(df, 1, F.sum("v").alias("s"))) == [("a", 3), ("c", 7)]


def test_nullif_empty_table(spark):
    df = spark.createDataFrame([("a", "", 1), ("", "b", 2), ("", "", 3)], "x string, y string, z int")
    assert rows(shape.nullif_empty_table(df)) == [("a", None, 1), (None, "b", 2), (None, None, 3)]


def test_column_values(spark):
    df = spark.createDataFrame([(c,) for c in "abcdefggggg"], "field string")
    values = shape.column_values(df, "field")
    assert values.first()["value"] == "g"
    assert {r["value"]: r["n"] for r in values.collect()} == {**dict.fromkeys("abcdef", 1), "g": 5}
    assert shape.value_list(values, 2) == ["g", "a"]
    assert shape.value_list(shape.column_values(df, "field", where="field = 'z'"), 5, default=["q"]) == ["q"]


COLORS = [("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")]


def test_pivot(spark):
    df = spark.createDataFrame(COLORS, "size string, color string")
    out = shape.pivot(df, ["size"], "color", ["red", "blue"])
    assert out.columns == ["size", "red", "blue"] and rows(out) == [("M", 1, 0), ("S", 1, 1)]
    out = shape.pivot(df, ["size"], "color", ["red", "blue", "blue's"], quote_identifiers=False)
    assert out.columns == ["size", "red", "blue", "blues"] and rows(out) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    out = shape.pivot(df, ["size"], "color", ["red"], agg="count", cmp="!=", distinct=True, else_value=None, prefix="not_")
    assert out.columns == ["size", "not_red"] and rows(out) == [("M", 0), ("S", 1)]
    out = shape.pivot(df, ["size"], "color", ["BLUE%"], cmp="ilike", suffix="_like")
    assert rows(out) == [("M", 0), ("S", 2)]


def test_unpivot_keeps_nulls_and_case(spark):
    df = spark.createDataFrame(
        [(123, "active", True, 1.5), (567, "churned", None, 10000000.0)],
        "Customer_Id int, sTaTuS string, is_updated boolean, amount double",
    )
    out = shape.unpivot(df, exclude=["Customer_Id"], remove=["AMOUNT"], field_name="prop", value_name="val")
    assert out.columns == ["Customer_Id", "prop", "val"]
    assert set(rows(out)) == {
        (123, "is_updated", "true"),
        (123, "sTaTuS", "active"),
        (567, "is_updated", None),
        (567, "sTaTuS", "churned"),
    }
    assert out.count() == 4
    numbers = shape.unpivot(df, cast_to="double", exclude=["Customer_Id"], remove=["status", "is_updated"])
    assert rows(numbers) == [(123, "amount", 1.5), (567, "amount", 10000000.0)]
    texts = shape.unpivot(df, exclude=["Customer_Id"], remove=["status", "is_updated"])
    assert rows(texts) == [(123, "amount", "1.5"), (567, "amount", "10000000.0")]
    with pytest.raises(ValueError):
        shape.unpivot(df, exclude=["Customer_Id"], remove=["sTaTuS", "is_updated", "amount"])


def test_scalar_value(spark):
    df = spark.createDataFrame([(datetime(2017, 1, 1), 3.3, 19, "string_a")], "d timestamp_ntz, f double, i int, s string")
    one = spark.range(1)
    assert one.select(shape.scalar_value(df.select("i"))).first()[0] == 19
    assert one.select(shape.scalar_value(df.select("s"))).first()[0] == "string_a"
    assert one.select(shape.scalar_value(df.where("false").select("s"), "none")).first()[0] == "none"
    assert one.select(shape.scalar_value(df.select(F.lit(None).cast("string").alias("n")), "none")).first()[0] is None


def union_inputs(spark):
    a = spark.createDataFrame([(1, "drew", "pi"), (2, "bob", "e"), (3, "alice", "4")], "id int, name string, favorite_number string")
    b = spark.createDataFrame([(1, "green", 7), (2, "pink", 13)], "id int, favorite_color string, favorite_number int")
    return {"a": a, "b": b}


def test_union_relations(spark):
    out = sets.union_relations(union_inputs(spark))
    assert out.columns == [sets.SOURCE_COLUMN, "id", "name", "favorite_number", "favorite_color"]
    assert rows(out.select("id", "name", "favorite_color", "favorite_number")) == [
        (1, "drew", None, "pi"), (1, None, "green", "7"), (2, "bob", None, "e"), (2, None, "pink", "13"), (3, "alice", None, "4"),
    ]
    out = sets.union_relations(union_inputs(spark), exclude=["NAME"], source_column_name=None)
    assert out.columns == ["id", "favorite_number", "favorite_color"]
    out = sets.union_relations(union_inputs(spark), include=["ID"], column_override={"id": "bigint"}, where="id = 1")
    assert out.schema["id"].dataType.simpleString() == "bigint" and rows(out) == [("a", 1), ("b", 1)]
    with pytest.raises(ValueError):
        sets.union_relations(union_inputs(spark), include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        sets.union_relations(union_inputs(spark), include=["nope"])


def test_union_by_pattern(spark):
    for day, (first, second) in enumerate([(1, 2), (3, 4), (5, 6)], 1):
        frame = spark.createDataFrame([(first, "play"), (second, "pause")], "user_id int, event string")
        frame.createOrReplaceTempView(f"data_events_2018010{day}")
    out = sets.union_by_pattern(spark, "%", "DATA_events_%", source_column_name=None)
    assert rows(out) == [(1, "play"), (2, "pause"), (3, "play"), (4, "pause"), (5, "play"), (6, "pause")]
    assert list(sets.relations_by_prefix(spark, "%", "data_events_2018", exclude="%03")) == ["data_events_20180101", "data_events_20180102"]
    assert sets.relations_by_pattern(spark, "no_such_schema", "%") == {}


def test_except_both_ways(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "z"), (3, "z")], "k int, v string")
    out = sets.except_both_ways(a, b)
    assert rows(out) == [("a_minus_b", 2, "x"), ("a_minus_b", 3, "y"), ("b_minus_a", 3, "z")]


def test_join_natural(spark):
    a = spark.createDataFrame([(1, "p"), (2, "q")], "k int, v string")
    b = spark.createDataFrame([(1, 10)], "K int, w int")
    assert rows(sets.join_natural(a, b)) == [(1, "p", 10)]
    with pytest.raises(ValueError):
        sets.join_natural(a.select("v"), b)
