import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelspark.operators import quality as Q


def frame(spark, schema, *rows):
    return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_accepted_range(spark):
    df = frame(spark, "id int", -1, 11, None)
    assert found(Q.accepted_range(df, "id", -1, 11)) == []
    assert found(Q.accepted_range(df, "id", 0)) == [(-1,)]
    assert found(Q.accepted_range(df, "id", -1, 11, inclusive=False)) == [(-1,), (11,)]
    assert found(Q.accepted_range(df, "id")) == []


def test_at_least_one(spark):
    df = frame(spark, "g int, v string", (1, None), (1, "x"), (2, None))
    assert found(Q.at_least_one(df, "v")) == []
    assert found(Q.at_least_one(df, "v", ["g"])) == [(2, 0)]
    assert found(Q.at_least_one(df.where("g = 2"), "v")) == [(0,)]


def test_cardinality_equality(spark):
    a = frame(spark, "x int", 1, 2, 2)
    assert found(Q.cardinality_equality(a, "x", frame(spark, "y int", 2, 1, 2), "y")) == []
    assert found(Q.cardinality_equality(a, "x", frame(spark, "y int", 2, 1, None), "y")) == [(2, 1), (2, 2), (None, 1)]


def test_row_counts(spark):
    a, b = frame(spark, "g int", 1, 1, 2), frame(spark, "g int", 1, 2, 3, 3)
    assert found(Q.equal_rowcount(a, b)) == [(3, 4, 1)]
    assert found(Q.equal_rowcount(a, b, ["g"])) == [(1, 2, 1, 1)]
    assert found(Q.equal_rowcount(a, b, ["g"], strict=True)) == [(1, 2, 1, 1), (3, 0, 2, 2)]
    assert found(Q.fewer_rows_than(a, b)) == []
    assert found(Q.fewer_rows_than(b, a)) == [(4, 3, 1)]
    assert found(Q.fewer_rows_than(a, b, ["g"])) == [(1, 2, 1, 1), (2, 1, 1, 1)]


def test_equality(spark):
    a = frame(spark, "id int, n string", (1, "x"), (1, "x"), (2, None))
    assert found(Q.equality(a, a.distinct())) == []
    b = frame(spark, "id int, n string", (1, "x"), (3, "y"), (4, "z"))
    diff = Q.equality(a, b)
    assert found(diff) == [("a_minus_b", 2, None), ("b_minus_a", 3, "y"), ("b_minus_a", 4, "z")]
    assert diff.agg(Q.equality_failures()).first()[0] == 4
    assert found(Q.equality(a, b, ["id"])) == [("a_minus_b", 2), ("b_minus_a", 3), ("b_minus_a", 4)]


def test_equality_shuffles_rows_of_differing_buckets_only(spark):
    a = spark.range(20_000).select("id", (F.col("id") % 7).cast("string").alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 77, "changed").otherwise(F.col("v")))
    assert found(Q.equality(a, b)) == [("a_minus_b", 77, "0"), ("b_minus_a", 77, "changed")]
    assert found(Q.equality(a, a.unionByName(a))) == []  # repeated rows change digests, not the result
    assert found(Q.equality(a, a.repartition(5))) == []
    zeros = frame(spark, "x double", 0.0, float("nan"), None)
    assert found(Q.equality(zeros, frame(spark, "x double", -0.0, float("nan"), None))) == []
    assert found(Q.equality(zeros.where("false"), a.select(F.col("id").cast("double").alias("x")).limit(1))) == [("b_minus_a", 0.0)]
    # copies that would cancel out in an exclusive or
    assert found(Q.equality(frame(spark, "x int", 1, 1), frame(spark, "x int", 2, 2))) == [("a_minus_b", 1), ("b_minus_a", 2)]

    def kept(left, right):
        both = left.withColumns({"__a": F.lit(1)}).unionByName(right.withColumns({"__a": F.lit(0)})).withColumn(
            "__bucket", F.pmod(F.xxhash64("id", "v"), F.lit(Q.DIGEST_BUCKETS)))
        return both.join(Q._differing_buckets(both, ["id", "v"]), "__bucket", "left_semi").count()
    assert kept(a, a) == 0 and 0 < kept(a, b) < 100


def test_expression(spark):
    df = frame(spark, "a double, b double", (0.5, 0.5), (0.5, 0.6), (None, 1.0))
    assert found(Q.expression_is_true(df, "a + b = 1")) == [(0.5, 0.6)]
    assert found(Q.expression_is_true(df, "= 0.5", "b")) == [(0.5, 0.6), (None, 1.0)]


def test_mutually_exclusive_ranges(spark):
    def bad(rows, **options):
        df = frame(spark, "g int, lo int, hi int", *rows)
        return found(Q.mutually_exclusive_ranges(df, "lo", "hi", **options))
    touching = [(1, 0, 1), (1, 1, 2), (1, 2, 4)]
    assert bad(touching, gaps="not_allowed") == bad(touching) == []
    assert bad(touching, gaps="required") == [(0, 1, 1, 1), (1, 2, 2, 1)]
    gapped = [(1, 0, 1), (1, 2, 3), (2, 0, 5)]
    assert bad(gapped, partition_by=["g"], gaps="required") == bad(gapped, partition_by=["g"]) == []
    assert bad(gapped, partition_by=["g"], gaps="not_allowed") == [(1, 0, 1, 2, 1)]
    assert bad([(1, 0, 1), (1, 1, 1)]) == [(1, 1, None, 1)]
    assert bad([(1, 0, 1), (1, 1, 1)], zero_length_range_allowed=True) == []
    assert bad([(1, 3, 1)]) == [(3, 1, None, 1)]
    assert bad([(1, 0, None), (1, None, 3)]) == [(0, None, None, 1), (None, 3, None, 1)]
    # three copies of one range overlap pairwise, the last one meets the next bound
    assert bad([(1, 0, 2)] * 3 + [(1, 2, 3)]) == [(0, 2, 0, 2)]
    with pytest.raises(ValueError):
        bad(touching, gaps="maybe")
    words = frame(spark, "lo string, hi string", ("a", "c"), ("b", "d"), ("x", "y"))
    assert found(Q.mutually_exclusive_ranges(words, "lo", "hi")) == [("a", "c", "b", 1)]


def test_sequential_values(spark):
    even = frame(spark, "g string, v int", *[("a", 2 * i) for i in range(6)], ("b", 1), ("b", 3), ("b", 3), ("b", 7), ("b", None))
    assert found(Q.sequential_values(even.where("g = 'a'"), "v", 2)) == []
    assert found(Q.sequential_values(even, "v", 2, None, ["g"])) == [("b", 3, 3, 1), ("b", 7, 3, 1)]
    stamps = frame(spark, "t timestamp_ntz", *[dt.datetime(2024, 1, 1, h) for h in (0, 1, 2, 5)])
    assert found(Q.sequential_values(stamps, "t", 1, "hour")) == [
        (dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 2), 1)]


def test_values(spark):
    df = frame(spark, "id int, city string", (1, "Rome"), (2, "Oslo"), (3, "Oslo"), (4, None))
    assert found(Q.not_accepted_values(df, "city", ["Oslo", "Bonn"])) == [("Oslo",)]
    assert found(Q.accepted_values(df, "city", ["Rome"])) == [("Oslo", 2)]
    assert found(Q.not_null(df, "city")) == [(4, None)]
    assert found(Q.unique(df, "city")) == [("Oslo", 2)]
    assert found(Q.unique_combination(df, ["id", "city"])) == []
    assert found(Q.not_constant(df, "city")) == []
    assert found(Q.not_constant(df.where("city = 'Oslo'"), "city")) == [(1,)]
    assert found(Q.not_constant(df.where("city IS NULL"), "city")) == []
    assert found(Q.assert_equal(frame(spark, "a int, e int", (1, 1), (1, 2), (None, 2)), "a", "e")) == [(1, 2)]


def test_not_empty_string(spark):
    df = frame(spark, "s string", "a", " ", "", None)
    assert found(Q.not_empty_string(df, "s")) == [(" ",), ("",)]
    assert found(Q.not_empty_string(df, "s", trim_whitespace=False)) == [("",)]


def test_not_null_proportion(spark):
    df = frame(spark, "g int, v int", (1, 1), (1, None), (2, 1), (2, 1))
    assert found(Q.not_null_proportion(df, "v", 0.75)) == []
    assert found(Q.not_null_proportion(df, "v", 0.8)) == [(0.75,)]
    assert found(Q.not_null_proportion(df, "v", 0, 0.9, ["g"])) == [(2, 1.0)]


def test_recency_and_freshness(spark):
    now = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    df = frame(spark, "g int, t timestamp_ntz", (1, dt.datetime(2024, 1, 9, 13)), (2, dt.datetime(2024, 1, 7)), (3, None))
    assert found(Q.recency(df, "t", "hour", 23, now)) == []
    assert found(Q.recency(df, "t", "day", 1, now, group_by=["g"])) == [
        (2, dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 9, 12))]
    assert found(Q.recency(df, "t", "day", 3, now, True, ["g"])) == []
    assert Q.recency(df, "t", "day", 1).count() == 1
    assert [(r.g, r.status) for r in Q.freshness(df, "t", now, group_by=["g"]).orderBy("g").collect()] == [
        (1, "pass"), (2, "error"), (3, "pass")]


def test_relationships(spark):
    child, parent = frame(spark, "id int", 1, 2, 3, 3, None), frame(spark, "id int", 1, 2, 4, None)
    assert found(Q.relationships_where(child, "id", parent, "id")) == [(3, 2)]
    assert found(Q.relationships_where(child, "id", parent, "id", "id <> 3")) == []
    assert found(Q.relationships_where(child, "id", parent, "id", "id <> 3", "id > 1")) == [(1, 1)]


def test_columns(spark):
    df = frame(spark, "id int, city string", (1, None), (2, "x"))
    assert found(Q.columns_match_set(df, ["ID", "City"])) == []
    assert found(Q.columns_match_set(df, ["id", "land"])) == [("city", "unexpected", 1), ("land", "missing", None)]


def test_report(spark):
    df = frame(spark, "id int", 1, 2, 3)
    report = Q.run_checks([
        Q.Check("passes", Q.accepted_range(df, "id", 1)),
        Q.Check("fails", Q.accepted_range(df, "id", 2)),
        Q.Check("warns", Q.accepted_range(df, "id", 2), error_if="> 10"),
        Q.Check("must fail", Q.accepted_range(df, "id", 1), error_if="< 1", warn_if="< 1"),
        Q.Check("prefiltered", Q.accepted_range(df.where("id > 1"), "id", 2)),
    ])
    assert [tuple(r) for r in report.collect()] == [
        ("passes", 0, "pass"), ("fails", 1, "error"), ("warns", 1, "warn"), ("must fail", 0, "error"),
        ("prefiltered", 0, "pass")]


def test_failures_are_rows_of_the_table(spark):
    orders = frame(spark, "id int, c int, v int", *[(i, 7, 1) for i in range(5)], (5, 1, 2), (6, 1, 9), (7, None, 9))
    customers = frame(spark, "c int", (1,))
    report = Q.run_checks([
        Q.Check("orphans", Q.relationships_where(orders, "c", customers, "c")),
        Q.Check("orphans of late rows", lambda t: Q.relationships_where(t, "c", customers, "c"), table=orders, where="id > 2"),
        Q.Check("sequence", Q.sequential_values(orders, "v")),
        Q.Check("counts of itself", Q.equal_rowcount(orders, orders, ["c"])),
        Q.Check("counts", Q.equal_rowcount(orders, customers, ["c"], strict=True)),
        Q.Check("fewer", Q.fewer_rows_than(orders, orders)),
        Q.Check("reversed", Q.mutually_exclusive_ranges(orders.where("c = 7"), "c", "v")),
    ]).collect()
    assert {r.name: r.failures for r in report} == {
        "orphans": 5, "orphans of late rows": 2, "sequence": 6, "counts of itself": 0, "counts": 7, "fewer": 1, "reversed": 5}
    with pytest.raises(ValueError):
        Q.run_checks([Q.Check("no table", orders, where="id > 2")])


RULES = {
    "range": lambda: Q.rules.accepted_range("v", 0, 6), "open range": lambda: Q.rules.accepted_range("v", 0, 6, False),
    "expression": lambda: Q.rules.expression_is_true("v + 1 < 8"), "column expression": lambda: Q.rules.expression_is_true("> 1", "v"),
    "empty text": lambda: Q.rules.not_empty_string("t"), "empty text as it is": lambda: Q.rules.not_empty_string("t", False),
    "not null": lambda: Q.rules.not_null("v"), "equal": lambda: Q.rules.assert_equal("v", "w"),
    "accepted": lambda: Q.rules.accepted_values("v", [1, 2, 3]), "forbidden": lambda: Q.rules.not_accepted_values("v", [1, 2, 99]),
    "known": lambda: Q.rules.at_least_one("v"), "known by group": lambda: Q.rules.at_least_one("v", ["g"]),
    "constant": lambda: Q.rules.not_constant("v"), "constant by group": lambda: Q.rules.not_constant("v", ["g", "h"]),
    "share": lambda: Q.rules.not_null_proportion("v", 0.9), "share by group": lambda: Q.rules.not_null_proportion("v", 0.6, 0.9, ["g"]),
    "recent": lambda: Q.rules.recency("d", "day", 3, F.lit(dt.datetime(2024, 1, 9)).cast("timestamp_ntz")),
    "recent by group": lambda: Q.rules.recency("d", "day", 3, F.lit(dt.datetime(2024, 1, 9)).cast("timestamp_ntz"), group_by=["h"]),
    "combination": lambda: Q.rules.unique_combination(["g", "v"]), "unique": lambda: Q.rules.unique("v"),
}


def mixed_table(spark, n):
    rows = [(i % 5 if i % 7 else None, "ab"[i % 2], None if i % 4 == 0 else i % 9, i % 3, ["", "  ", "x", None][i % 4],
             dt.datetime(2024, 1, 1 + i % 9)) for i in range(n)]
    return frame(spark, "g int, h string, v int, w int, t string, d timestamp_ntz", *rows).repartition(3)


@pytest.mark.parametrize("n,where", [(0, None), (40, None), (40, "g IS NOT NULL AND v IS NULL"), (1, "w > 100")])
def test_shared_scan_counts_what_each_check_returns(spark, n, where):
    df = mixed_table(spark, n)
    rules = {name: make() for name, make in RULES.items()}
    report = Q.run_checks([Q.Check(name, rule, table=df, where=where) for name, rule in rules.items()])
    got = {r["name"]: r["failures"] for r in report.collect()}
    rows = df.where(where) if where else df
    want = {}
    for name, rule in rules.items():
        found = rule.rows(rows)
        want[name] = found.agg(F.coalesce(Q.failure_count(found), F.lit(0))).first()[0]
    assert got == want


def test_rules_on_one_table_scan_it_once(spark, tmp_path):
    """Row rules, table rules and two groupings: one scan; another table and a check on order stay apart."""
    mixed_table(spark, 50).write.parquet(str(tmp_path / "t"))
    df, other = spark.read.parquet(str(tmp_path / "t")), frame(spark, "g int", 1, 1, 2)
    names = ["range", "empty text", "known by group", "constant by group", "combination", "not null", "share"]
    shared = [Q.Check(n, RULES[n](), table=spark.read.parquet(str(tmp_path / "t"))) for n in names]
    report = Q.run_checks([*shared, Q.Check("other", Q.rules.unique("g"), table=other, warn_if="> 0", error_if="> 5")])
    text = report._sc._jvm.PythonSQLUtils.explainString(report._jdf.queryExecution(), "formatted").split("\n\n")[0]
    assert text.count("Scan parquet") == 1 and text.count("Exchange") <= 5
    assert {r["name"]: r["status"] for r in report.collect()}["other"] == "warn"
    kept = Q.failing_rows([Q.Check(n, RULES[n](), table=df, where=w) for n, w in (
        ("range", None), ("not null", "h = 'a'"), ("empty text", None))]).collect()
    plain = df.collect()
    assert len(kept) == sum(bool((r["v"] or 0) > 6 or (r["v"] is None and r["h"] == "a") or (r["t"] or "x").strip() == "")
                            for r in plain)
    assert all(r["failed_checks"] for r in kept)
    with pytest.raises(ValueError):
        Q.failing_rows([Q.Check("known", Q.rules.at_least_one("v"), table=df)])
