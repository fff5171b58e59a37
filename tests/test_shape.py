import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelspark.operators import catalog, series, shape


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_deduplicate_keeps_rows_with_null(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, None, 5)], "user_id int, event string, version int")
    assert rows(shape.deduplicate(df, ["user_id"], [F.desc("version")]), "user_id") == [(1, "play", 2), (2, None, 5)]


def test_pivot(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    out = df.groupBy("size").agg(*shape.pivot_columns("color", ["red", "blue", "blue's"])).orderBy("size")
    assert out.columns == ["size", "red", "blue", "blue's"]
    assert rows(out) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    named = df.groupBy("size").agg(*shape.pivot_columns("color", ["red"], prefix="Is ", suffix="-x", quote_identifiers=False))
    assert named.columns == ["size", "is_red_x"]
    least = df.groupBy("size").agg(*shape.pivot_columns("color", ["red"], F.min, "!=", then_value="no", else_value="yes"))
    assert rows(least, "size") == [("M", "yes"), ("S", "no")]


def test_unpivot_booleans_and_nulls(spark):
    df = spark.createDataFrame([(123, "2017-01-01", "active", "tier 1", True), (567, "2017-03-01", "churned", None, None)],
                               "customer_id int, created_at string, status string, segment string, is_updated boolean")
    out = shape.unpivot(df, exclude=["CUSTOMER_ID"], remove=["Created_At"], field_name="prop", value_name="val")
    assert rows(out, "customer_id", "prop") == [
        (123, "is_updated", "true"), (123, "segment", "tier 1"), (123, "status", "active"),
        (567, "is_updated", None), (567, "segment", None), (567, "status", "churned")]


def test_union_relations(spark):
    one = spark.createDataFrame([(1, "drew", "pi"), (2, "bob", "e")], "id int, name string, favorite_number string")
    two = spark.createDataFrame([(1, "green", 7)], "id int, favorite_color string, favorite_number int")
    out = shape.union_relations({"t1": one, "t2": two}, source_column_name="src")
    assert out.columns == ["src", "id", "name", "favorite_number", "favorite_color"]
    assert rows(out, "src", "id") == [("t1", 1, "drew", "pi", None), ("t1", 2, "bob", "e", None), ("t2", 1, None, "7", "green")]
    for skip in ("name", "NAME"):
        less = shape.union_relations({"t1": one, "t2": two}, exclude=[skip], source_column_name=None)
        assert less.columns == ["id", "favorite_number", "favorite_color"]
    assert shape.union_relations({"t1": one, "t2": two}, where="id = 2").count() == 1
    assert dict(shape.union_relations({"t1": one}, {"id": "bigint"}).dtypes)["id"] == "bigint"
    with pytest.raises(ValueError):
        shape.union_relations({"t1": one}, include=["id"], exclude=["id"])
    with pytest.raises(ValueError):
        shape.union_relations({"t1": one}, include=["absent"])


def test_star_and_nullcheck(spark):
    df = spark.createDataFrame([("a", "", 3)], "field_1 string, field_2 string, field_3 int")
    assert df.select(shape.star(df, ["FIELD_3"], "p_", "_s")).columns == ["p_field_1_s", "p_field_2_s"]
    assert shape.filtered_columns(df, ["Field_1"]) == ["field_2", "field_3"]
    assert df.alias("x").select(shape.star(df, relation_alias="x")).columns == df.columns
    assert rows(shape.nullcheck(df)) == [("a", None, 3)]
    assert rows(shape.group_by_first(df, 2).agg(F.sum("field_3"))) == [("a", "", 3)]


def test_column_values(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 0), ("c", 1), ("c", 1), ("c", 0)], "field string, keep int")
    assert shape.column_value_list(df, "field") == ["c", "b", "a"]
    assert shape.column_value_list(df, "field", max_records=1, where="keep = 1") == ["c"]
    assert shape.column_value_list(df, "field", order_by=[F.col("value")]) == ["a", "b", "c"]
    assert shape.column_value_list(None, "field", default=["d"]) == ["d"]
    assert shape.column_value_list(df.where("false"), "field", default=["d"]) == ["d"]
    with pytest.raises(ValueError):
        shape.column_value_list(None, "field")
    pivoted = shape.pivot_map(df, ["keep"], "field").collect()
    assert {r.keep: r.field for r in pivoted} == {0: {"b": 1, "c": 1}, 1: {"a": 1, "b": 1, "c": 2}}


def test_query_results(spark):
    df = spark.createDataFrame([(1, None), (2, True)], "a int, b boolean").coalesce(1)
    assert shape.results_as_dict(df) == {"a": [1, 2], "b": [None, True]}
    assert shape.single_value(df) == 1
    assert shape.single_value(df.where("a = 9"), "none") == "none"
    assert shape.single_value(df.select("b"), "none") is None


def test_series(spark):
    assert [r[0] for r in series.generate_series(spark, 10).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        series.generate_series(spark, 0)
    bounds = spark.createDataFrame([(dt.date(2018, 1, 1), dt.date(2018, 1, 10))], "start date, end date")
    days = [r[0] for r in series.date_spine(bounds, "day").collect()]
    assert len(days) == 9 and days[0] == dt.datetime(2018, 1, 1) and days[-1] == dt.datetime(2018, 1, 9)
    assert series.date_spine(bounds, "hour").count() == 216
    assert series.date_spine(bounds, "year").count() == 0
    year = spark.createDataFrame([(dt.date(2017, 11, 30), dt.date(2018, 12, 1))], "start date, end date")
    assert [r[0].month for r in series.date_spine(year, "quarter").collect()] == [11, 2, 5, 8]
    months = spark.createDataFrame([(dt.date(2018, 1, 31), dt.date(2018, 2, 1))], "a date, b date")
    gap = months.select(*[series.intervals_between(F.col("a"), F.col("b"), p) for p in ("day", "month", "year", "week")])
    assert tuple(gap.first()) == (1, 1, 0, 0)


def test_catalog(spark):
    for day in ("20180101", "20180102", "20180103"):
        spark.createDataFrame([(1, day)], "user_id int, event string").createOrReplaceTempView(f"data_events_{day}")
    found = catalog.relations_by_pattern(spark, "DATA_EVENTS_%", exclude="%20180102")
    assert sorted(r.table_name for r in found.collect()) == ["data_events_20180101", "data_events_20180103"]
    by_prefix = catalog.relations_by_prefix(spark, "data_events_")
    assert shape.union_relations(catalog.read_relations(spark, by_prefix)).count() == 3
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "player_id int, team_id string")
    assert rows(catalog.null_profile(df, "t"), "column_name") == [
        ("t", 3, "player_id", "int", 0, 0.0), ("t", 3, "team_id", "string", 2, 66.67)]
    assert catalog.null_profile(df.where("false")).select(F.max("null_pct")).first()[0] == 0.0
    assert rows(catalog.column_inventory({"t": df}), "ordinal_position") == [
        ("t", 1, "player_id", "int", "PK,FK", 3, 3), ("t", 2, "team_id", "string", "FK", 3, 1)]
    seasons = spark.createDataFrame([("2024",), ("2025",), ("2025",)], "season_id string")
    assert tuple(catalog.load_audit(seasons, 33).first()) == (2, 33)
    assert tuple(catalog.load_audit(seasons, 33, main_period="2026", fallback_period="2024").first()) == (1, 33)
    assert tuple(catalog.load_audit(seasons, 33, main_period="2026", fallback_period="2020").first()) == (0, 33)
