"""Queries for the data-quality checks, each on tables that break the rule somewhere."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, quality as Q
from ..operators.quality import Check
from .registry import q9, query, r9, table


def orders(spark, sf, where=None):
    rows = table(spark, sf, "orders")
    return rows.where(where) if where else rows


AS_OF = "2024-01-31 00:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


@query("chk_accepted_range", """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE NOT (l_quantity >= 3) OR NOT (l_quantity <= 48)""")
def chk_accepted_range(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return Q.accepted_range(lines, "l_quantity", 3, 48)


@query("chk_accepted_range_exclusive", """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE NOT (l_quantity > 3)""")
def chk_accepted_range_exclusive(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return Q.accepted_range(lines, "l_quantity", 3, inclusive=False)


@query("chk_at_least_one", """SELECT o_custkey, count(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS n_known FROM orders
GROUP BY 1 HAVING count(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) = 0""")
def chk_at_least_one(spark, sf):
    priced = orders(spark, sf).select("o_custkey", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("p"))
    return Q.at_least_one(priced, "p", ["o_custkey"])


@query("chk_cardinality_equality", """WITH a AS (SELECT o_custkey AS value, count(*) AS num_rows FROM orders GROUP BY 1),
b AS (SELECT user_id AS value, count(*) AS num_rows FROM events GROUP BY 1)
(SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def chk_cardinality_equality(spark, sf):
    return Q.cardinality_equality(orders(spark, sf), "o_custkey", table(spark, sf, "events"), "user_id")


_COUNTS = """a AS (SELECT o_custkey, count(*) AS count_a FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
b AS (SELECT o_custkey, count(*) AS count_b FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
c AS (SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, count_a, count_b FROM a FULL JOIN b ON a.o_custkey = b.o_custkey)"""


def _two_statuses(spark, sf):
    return orders(spark, sf, "o_orderstatus = 'F'"), orders(spark, sf, "o_orderstatus = 'O'")


@query("chk_equal_rowcount", f"WITH {_COUNTS} SELECT o_custkey, count_a, count_b, abs(count_a - count_b) AS diff_count FROM c WHERE count_a <> count_b")
def chk_equal_rowcount(spark, sf):
    return Q.equal_rowcount(*_two_statuses(spark, sf), ["o_custkey"])


@query("chk_equal_rowcount_strict", f"""WITH {_COUNTS} SELECT o_custkey, coalesce(count_a, 0) AS count_a, coalesce(count_b, 0) AS count_b,
  abs(coalesce(count_a, 0) - coalesce(count_b, 0)) AS diff_count FROM c WHERE coalesce(count_a, 0) <> coalesce(count_b, 0)""")
def chk_equal_rowcount_strict(spark, sf):
    return Q.equal_rowcount(*_two_statuses(spark, sf), ["o_custkey"], strict=True)


@query("chk_fewer_rows", f"""WITH {_COUNTS} SELECT o_custkey, count_a, count_b, CAST(CASE WHEN count_a > count_b THEN count_a - count_b
  WHEN count_a = count_b THEN 1 ELSE 0 END AS BIGINT) AS row_count_delta FROM c WHERE count_a >= count_b""")
def chk_fewer_rows(spark, sf):
    return Q.fewer_rows_than(*_two_statuses(spark, sf), ["o_custkey"])


_EQUALITY = """a AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'),
b AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O'),
d AS (SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
  UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a))"""


@query("chk_equality", f"WITH {_EQUALITY} SELECT * FROM d")
def chk_equality(spark, sf):
    return Q.equality(*_two_statuses(spark, sf), ["o_custkey", "o_orderpriority"])


@query("chk_expression", """SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem WHERE NOT (l_extendedprice > 1000 * l_quantity)""")
def chk_expression(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    return Q.expression_is_true(lines, "l_extendedprice > 1000 * l_quantity")


@query("chk_expression_column", """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders WHERE NOT (nullif(o_orderstatus, 'P') = 'F')""")
def chk_expression_column(spark, sf):
    rows = orders(spark, sf).select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"))
    return Q.expression_is_true(rows, "= 'F'", "status")


def _ranges_sql(source: str, keys: str, gap: str, length: str) -> str:
    lead = f"PARTITION BY {keys} " if keys else ""
    out = f"{keys}, " if keys else ""
    return f"""WITH r AS ({source}),
w AS (SELECT *, lead(lower_bound) OVER ({lead}ORDER BY lower_bound, upper_bound) AS next_lower_bound,
  row_number() OVER ({lead}ORDER BY lower_bound DESC, upper_bound DESC) = 1 AS is_last FROM r)
SELECT {out}lower_bound, upper_bound, next_lower_bound, count(*) AS n_rows FROM w
WHERE NOT (coalesce(lower_bound {length} upper_bound, false) AND coalesce(upper_bound {gap} next_lower_bound, is_last, false))
GROUP BY ALL"""


_SHIP = "SELECT l_suppkey, l_partkey AS lower_bound, l_partkey + CAST(l_quantity AS BIGINT) % 5 AS upper_bound FROM lineitem"
_SESSIONS = "SELECT event_id * 2 AS lower_bound, event_id * 2 + user_id % 4 AS upper_bound FROM events"


def _ship(spark, sf):
    return table(spark, sf, "lineitem").selectExpr("l_suppkey", "l_partkey AS lo",
                                                   "l_partkey + CAST(l_quantity AS BIGINT) % 5 AS hi")


@query("chk_exclusive_ranges", _ranges_sql(_SHIP, "l_suppkey", "<=", "<"))
def chk_exclusive_ranges(spark, sf):
    return Q.mutually_exclusive_ranges(_ship(spark, sf), "lo", "hi", ["l_suppkey"])


@query("chk_exclusive_ranges_split", _ranges_sql(_SHIP, "l_suppkey", "<", "<="))
def chk_exclusive_ranges_split(spark, sf):
    """Gaps required and empty ranges allowed."""
    return Q.mutually_exclusive_ranges(_ship(spark, sf), "lo", "hi", ["l_suppkey"], "required", True)


@query("chk_exclusive_ranges_ungrouped", _ranges_sql(_SESSIONS, "", "=", "<="))
def chk_exclusive_ranges_ungrouped(spark, sf):
    sessions = table(spark, sf, "events").selectExpr("event_id * 2 AS lo", "event_id * 2 + user_id % 4 AS hi")
    return Q.mutually_exclusive_ranges(sessions, "lo", "hi", (), "not_allowed", True)


@query("chk_not_accepted", """SELECT DISTINCT event_type AS value_field FROM events WHERE event_type IN ('error', 'signup', 'absent')""")
def chk_not_accepted(spark, sf):
    return Q.not_accepted_values(table(spark, sf, "events"), "event_type", ["error", "signup", "absent"])


@query("chk_not_constant", """SELECT o_custkey, count(DISTINCT o_orderstatus) AS n_distinct FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 1""")
def chk_not_constant(spark, sf):
    return Q.not_constant(orders(spark, sf), "o_orderstatus", ["o_custkey"])


@query("chk_not_empty_string", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '  ' ELSE o_orderpriority END AS note FROM orders WHERE o_orderstatus = 'P'""")
def chk_not_empty_string(spark, sf):
    notes = orders(spark, sf).select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.col("o_orderpriority")).alias("note"))
    return Q.not_empty_string(notes, "note")


@query("chk_not_null_proportion", """SELECT user_id, round(avg(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END), 9) + 0.0 AS not_null_proportion
FROM events GROUP BY 1 HAVING avg(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) < 0.8""")
def chk_not_null_proportion(spark, sf):
    typed = table(spark, sf, "events").select("user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("t"))
    return Q.not_null_proportion(typed, "t", 0.8, group_by=["user_id"]).select("user_id", r9("not_null_proportion"))


@query("chk_recency", f"""SELECT user_id, max(ts)::TIMESTAMP AS most_recent, TIMESTAMP '{AS_OF}' - INTERVAL 36 HOUR AS threshold
FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '{AS_OF}' - INTERVAL 36 HOUR""")
def chk_recency(spark, sf):
    return Q.recency(table(spark, sf, "events"), "ts", "hour", 36, as_of(), group_by=["user_id"])


@query("chk_recency_date", """SELECT event_type, max(ts)::DATE AS most_recent, DATE '2024-02-08' AS threshold
FROM events GROUP BY 1 HAVING max(ts)::DATE < DATE '2024-02-08'""")
def chk_recency_date(spark, sf):
    later = F.lit("2024-02-10 12:00:00").cast("timestamp_ntz")
    return Q.recency(table(spark, sf, "events"), "ts", "day", 2, later, True, ["event_type"])


@query("chk_relationships", """SELECT o_custkey AS value, count(*) AS n_rows FROM orders
WHERE o_orderstatus <> 'P' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1""")
def chk_relationships(spark, sf):
    return Q.relationships_where(orders(spark, sf), "o_custkey", table(spark, sf, "customer"), "c_custkey",
                                 "o_orderstatus <> 'P'", "c_acctbal > 0")


@query("chk_sequential_values", """WITH w AS (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS previous_value FROM lineitem)
SELECT l_orderkey, l_linenumber, previous_value, count(*) AS n_rows FROM w WHERE NOT (l_linenumber = previous_value + 1) GROUP BY ALL""")
def chk_sequential_values(spark, sf):
    return Q.sequential_values(table(spark, sf, "lineitem"), "l_linenumber", 1, None, ["l_orderkey"])


_HOURS = """WITH h AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS hour FROM events),
w AS (SELECT hour, lag(hour) OVER (ORDER BY hour) AS previous_value FROM h)
SELECT hour, previous_value, count(*) AS n_rows FROM w WHERE NOT (hour = previous_value + INTERVAL 1 HOUR) GROUP BY ALL"""


def _hours(spark, sf):
    return table(spark, sf, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))


@query("chk_sequential_hours", _HOURS)
def chk_sequential_hours(spark, sf):
    return Q.sequential_values(_hours(spark, sf), "hour", 1, "hour")


@query("chk_sequential_hours_split", _HOURS)
def chk_sequential_hours_split(spark, sf):
    return Q.sequential_values(_hours(spark, sf), "hour", 1, "hour")


@query("chk_unique_combination", """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def chk_unique_combination(spark, sf):
    return Q.unique_combination(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("chk_columns_match_set", """SELECT 'o_orderdate' AS column_name, 'unexpected' AS problem, count(o_orderdate) AS n_filled FROM orders
UNION ALL SELECT 'o_orderpriority', 'unexpected', count(o_orderpriority) FROM orders
UNION ALL SELECT 'o_clerk', 'missing', CAST(NULL AS BIGINT)""")
def chk_columns_match_set(spark, sf):
    return Q.columns_match_set(orders(spark, sf), ["O_ORDERKEY", "o_custkey", "o_orderstatus", "o_totalprice", "o_clerk"])


@query("chk_assert_equal", """SELECT l_orderkey, l_partkey, l_discount AS actual, l_tax AS expected FROM lineitem WHERE NOT (l_discount = l_tax)""")
def chk_assert_equal(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_partkey", "l_discount AS actual", "l_tax AS expected")
    return Q.assert_equal(lines, "actual", "expected")


@query("chk_not_null", """SELECT l_orderkey, l_partkey, nullif(l_returnflag, 'N') AS flag FROM lineitem WHERE nullif(l_returnflag, 'N') IS NULL""")
def chk_not_null(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_partkey", "nullif(l_returnflag, 'N') AS flag")
    return Q.not_null(lines, "flag")


@query("chk_unique", """SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def chk_unique(spark, sf):
    return Q.unique(orders(spark, sf), "o_custkey")


@query("chk_accepted_values", """SELECT event_type AS value_field, count(*) AS n_rows FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1""")
def chk_accepted_values(spark, sf):
    return Q.accepted_values(table(spark, sf, "events"), "event_type", ["click", "view"])


@query("check_report", f"""WITH {_COUNTS}, {_EQUALITY.replace("a AS", "e1 AS", 1).replace("b AS (", "e2 AS (", 1).replace("FROM a", "FROM e1").replace("FROM b", "FROM e2")},
f AS (
  SELECT 'price is positive' AS name, count(*) FILTER (WHERE NOT (o_totalprice > 0)) AS failures FROM orders
  UNION ALL SELECT 'price is below a limit', count(*) FILTER (WHERE NOT (o_totalprice <= 300000)) FROM orders
  UNION ALL SELECT 'expected to fail', count(*) FILTER (WHERE o_orderstatus = 'P') FROM orders
  UNION ALL SELECT 'same row counts', sum(coalesce(abs(count_a - count_b), 0)) FROM c
  UNION ALL SELECT 'same rows', count(*) + coalesce(abs(sum(CASE WHEN which_diff = 'a_minus_b' THEN 1 ELSE 0 END)
    - sum(CASE WHEN which_diff = 'b_minus_a' THEN 1 ELSE 0 END)), 0) FROM d
  UNION ALL SELECT 'same row counts as itself', 0
  UNION ALL SELECT 'fewer rows', sum(CASE WHEN count_a > count_b THEN count_a - count_b WHEN count_a = count_b THEN 1 ELSE 0 END) FROM c
  UNION ALL SELECT 'customers place orders', count(*) FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)
  UNION ALL SELECT 'keys follow each other', count(*) FROM (SELECT o_orderkey, lag(o_orderkey) OVER (ORDER BY o_orderkey) AS p
    FROM orders WHERE o_orderstatus <> 'P') WHERE o_orderkey <> p + 1
  UNION ALL SELECT 'periods exclude each other', count(*) FROM (SELECT o_orderdate + INTERVAL 30 DAY AS e,
    lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE e > n)
SELECT name, CAST(failures AS BIGINT) AS failures, CASE
  WHEN name = 'expected to fail' AND failures < 1 THEN 'error' WHEN name = 'price is below a limit' AND failures > 1000000000 THEN 'error'
  WHEN name NOT IN ('expected to fail', 'price is below a limit') AND failures > 0 THEN 'error'
  WHEN name = 'expected to fail' AND failures < 1 THEN 'warn' WHEN name <> 'expected to fail' AND failures > 0 THEN 'warn'
  ELSE 'pass' END AS status FROM f""")
def check_report(spark, sf):
    every = orders(spark, sf)
    first, second = _two_statuses(spark, sf)
    return Q.run_checks([
        Check("price is positive", Q.rules.expression_is_true("o_totalprice > 0"), table=every),
        Check("price is below a limit", Q.rules.accepted_range("o_totalprice", max_value=300000), table=every,
              error_if="> 1000000000"),
        Check("expected to fail", Q.rules.expression_is_true("<> 'P'", "o_orderstatus"), table=every, error_if="< 1",
              warn_if="< 1"),
        Check("same row counts", Q.equal_rowcount(first, second, ["o_custkey"])),
        Check("same row counts as itself", Q.equal_rowcount(first, first, ["o_custkey"], strict=True)),
        Check("fewer rows", Q.fewer_rows_than(first, second, ["o_custkey"])),
        Check("customers place orders", lambda t: Q.relationships_where(t, "c_custkey", every, "o_custkey"),
              table=table(spark, sf, "customer"), where="c_acctbal > 0"),
        Check("keys follow each other", lambda t: Q.sequential_values(t, "o_orderkey"), table=every,
              where="o_orderstatus <> 'P'"),
        Check("periods exclude each other", Q.mutually_exclusive_ranges(
            every.selectExpr("o_custkey", "o_orderdate AS b", "o_orderdate + INTERVAL 30 DAY AS e"), "b", "e",
            ["o_custkey"])),
        Check("same rows", Q.equality(first, second, ["o_custkey", "o_orderpriority"]), Q.equality_failures()),
    ])


@query("freshness_audit", f"""WITH l AS (SELECT user_id, max(ts)::TIMESTAMP AS last_load, count(*) AS n_rows FROM events GROUP BY 1)
SELECT user_id, last_load, n_rows, CASE WHEN last_load < TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR THEN 'error'
  WHEN last_load < TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR THEN 'warn' ELSE 'pass' END AS status FROM l""")
def freshness_audit(spark, sf):
    return Q.freshness(table(spark, sf, "events"), "ts", as_of(), group_by=["user_id"])


@query("newest_rows", f"""SELECT event_id, ts, user_id, {q9("value")} FROM events ORDER BY ts DESC, event_id LIMIT 20""")
def newest_rows(spark, sf):
    rows = metrics.newest_rows(table(spark, sf, "events"), "ts", 20, [F.asc("event_id")])
    return rows.select("event_id", "ts", "user_id", r9("value"))
