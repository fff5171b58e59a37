"""Queries for projection, reshaping, series, cleaning and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions import (clean_age, clean_numeric, fold_name, haversine_distance, safe_add, safe_divide, safe_subtract,
                         sanitize_name, slugify, table_name_of, url_host, url_parameter, url_path, width_bucket,
                         width_bucket_compat)
from ..operators import catalog, series, shape
from .registry import query, r9, table


def _n(count_name="n"):
    return F.count(F.lit(1)).alias(count_name)


# --- shape ------------------------------------------------------------------

@query("star_select", """SELECT c_custkey AS pre_c_custkey_post, c_name AS pre_c_name_post, c_mktsegment AS pre_c_mktsegment_post
FROM customer""")
def star_select(spark, sf):
    customers = table(spark, sf, "customer")
    return customers.select(*shape.star(customers, ["C_NATIONKEY", "c_acctbal"], "pre_", "_post"))


@query("star_group_by", """SELECT o_custkey, o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2, 3""")
def star_group_by(spark, sf):
    orders = table(spark, sf, "orders")
    kept = shape.star(orders, ["o_orderkey", "o_totalprice", "o_orderdate"])
    return orders.groupBy(*kept).agg(_n())


@query("filtered_columns", """SELECT field_name, count(value) AS n_filled FROM
  (UNPIVOT (SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier) ON s_suppkey, s_name INTO NAME field_name VALUE value)
GROUP BY field_name""")
def filtered_columns(spark, sf):
    suppliers = table(spark, sf, "supplier")
    kept = suppliers.select(shape.filtered_columns(suppliers, ["S_NATIONKEY", "s_acctbal"]))
    return shape.unpivot(kept).groupBy("field_name").agg(F.count("value").alias("n_filled"))


@query("nullcheck_table", """SELECT o_orderkey, nullif(replace(o_orderstatus, 'P', ''), '') AS status,
  nullif(replace(o_orderpriority, '5-LOW', ''), '') AS priority FROM orders""")
def nullcheck_table(spark, sf):
    blanked = table(spark, sf, "orders").select(
        "o_orderkey", F.replace("o_orderstatus", F.lit("P"), F.lit("")).alias("status"),
        F.replace("o_orderpriority", F.lit("5-LOW"), F.lit("")).alias("priority"))
    return shape.nullcheck(blanked)


@query("group_by_n", """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS qty
FROM lineitem GROUP BY 1, 2""")
def group_by_n(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    qty = F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("double").alias("qty")
    return shape.group_by_first(lines, 2).agg(_n(), qty)


_EVENTS = ["click", "error", "purchase", "signup", "view"]


@query("pivot_counts", "SELECT user_id, " + ", ".join(
    f"CAST(sum(CASE WHEN event_type = '{e}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{e}_events" for e in _EVENTS)
    + " FROM events GROUP BY user_id")
def pivot_counts(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(
        *shape.pivot_columns("event_type", _EVENTS, prefix="n_", suffix="_events"))


@query("pivot_values", """SELECT user_id,
  count(DISTINCT CASE WHEN event_type <> 'click' THEN CAST(floor(value) AS BIGINT) ELSE -1 END) AS not_click,
  count(DISTINCT CASE WHEN event_type <> 'view' THEN CAST(floor(value) AS BIGINT) ELSE -1 END) AS not_view
FROM events GROUP BY user_id""")
def pivot_values(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(*shape.pivot_columns(
        "event_type", ["click", "view"], F.count, "!=", "Not ", then_value=F.floor("value"),
        else_value=F.lit(-1).cast("bigint"), quote_identifiers=False, distinct=True))


@query("pivot_discovered", """WITH c AS (SELECT l_shipdate::DATE AS day, l_returnflag AS f, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT day, string_agg(f || '=' || n, ',' ORDER BY f) AS flags FROM c GROUP BY 1""")
def pivot_discovered(spark, sf):
    day = F.col("l_shipdate").cast("date").alias("day")
    pivoted = shape.pivot_map(table(spark, sf, "lineitem"), [day], "l_returnflag")
    cells = F.transform(F.map_entries("l_returnflag"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return pivoted.select("day", F.array_join(cells, ",").alias("flags"))


@query("unpivot_long", """SELECT c_custkey, 'c_nationkey' AS prop, CAST(c_nationkey AS VARCHAR) AS val FROM customer
UNION ALL SELECT c_custkey, 'c_mktsegment', nullif(c_mktsegment, 'MACHINERY') FROM customer
UNION ALL SELECT c_custkey, 'rich', CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END FROM customer""")
def unpivot_long(spark, sf):
    customers = table(spark, sf, "customer").withColumns({
        "c_mktsegment": F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")), "rich": F.col("c_acctbal") > 0})
    return shape.unpivot(customers, exclude=["C_CUSTKEY"], remove=["c_name", "c_acctbal"], field_name="prop",
                         value_name="val")


_REGION_NATION = """SELECT '{a}' AS {src}, CAST(r_regionkey AS BIGINT) AS key, r_name AS name, CAST(NULL AS INT) AS parent FROM region
UNION ALL SELECT '{b}', CAST(c_custkey AS BIGINT), c_name, c_nationkey FROM customer"""


def _two_relations(spark, sf):
    regions = table(spark, sf, "region").selectExpr("CAST(r_regionkey AS BIGINT) AS key", "r_name AS name")
    customers = table(spark, sf, "customer").selectExpr("c_custkey AS key", "c_name AS name", "c_nationkey AS parent")
    return {"region": regions, "customer": customers}


@query("union_relations", _REGION_NATION.format(a="region", b="customer", src=V.SOURCE_COLUMN))
def union_relations(spark, sf):
    return shape.union_relations(_two_relations(spark, sf))


@query("union_relations_where", """SELECT 'region' AS origin, CAST(r_regionkey AS VARCHAR) AS key, CAST(NULL AS INT) AS parent FROM region
  WHERE r_regionkey > 2
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), c_nationkey FROM customer WHERE c_custkey > 2""")
def union_relations_where(spark, sf):
    return shape.union_relations(_two_relations(spark, sf), {"key": "string"}, include=["KEY", "parent"],
                                 source_column_name="origin", where="key > 2")


@query("union_relations_exclude", """SELECT CAST(r_regionkey AS BIGINT) AS key, CAST(NULL AS INT) AS parent FROM region
UNION ALL SELECT c_custkey, c_nationkey FROM customer""")
def union_relations_exclude(spark, sf):
    return shape.union_relations(_two_relations(spark, sf), exclude=["NAME"], source_column_name=None)


@query("union_by_name", """SELECT CAST(r_regionkey AS BIGINT) AS key, r_name AS name, CAST(NULL AS INT) AS parent FROM region
UNION ALL SELECT c_custkey, c_name, c_nationkey FROM customer""")
def union_by_name(spark, sf):
    return shape.union_by_name(list(_two_relations(spark, sf).values()))


def _years(spark, sf):
    """Orders by year, from the first to the last year that occurs."""
    orders = table(spark, sf, "orders")
    first, last = orders.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    return {str(y): orders.where((F.col("o_orderdate") >= f"{y}-01-01") & (F.col("o_orderdate") < f"{y + 1}-01-01"))
            for y in (range(first, last + 1) if first else ())}


@query("union_periods", """SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS VARCHAR) AS source_season_id FROM orders
WHERE o_orderdate IS NOT NULL""")
def union_periods(spark, sf):
    dated = table(spark, sf, "orders").where("o_orderdate IS NOT NULL").select("o_orderkey", "o_custkey", "o_orderdate")
    return shape.tag_period(dated, F.year("o_orderdate")).drop("o_orderdate")


@query("union_periods_frames", """SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS VARCHAR) AS source_season_id FROM orders
WHERE o_orderdate IS NOT NULL""")
def union_periods_frames(spark, sf):
    return shape.union_periods(_years(spark, sf)).select("o_orderkey", "o_custkey", "source_season_id")


@query("period_row_counts", """SELECT CAST(year(o_orderdate) AS VARCHAR) AS season_id, count(*) AS n_rows FROM orders GROUP BY 1""")
def period_row_counts(spark, sf):
    orders = table(spark, sf, "orders").withColumn("season_id", F.year("o_orderdate").cast("string"))
    return catalog.period_row_counts(orders)


@query("deduplicate", """SELECT user_id, event_type, event_id, round(value, 9) + 0.0 AS value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) = 1""")
def deduplicate(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    first = shape.deduplicate(events, ["user_id", "event_type"], [F.desc("value"), F.asc("event_id")])
    return first.select("user_id", "event_type", "event_id", r9("value"))


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("column_values", """SELECT p_brand AS value, count(*) AS n FROM part WHERE p_size > 10 GROUP BY 1 ORDER BY n DESC, value LIMIT 15""")
def column_values(spark, sf):
    return shape.column_values(table(spark, sf, "part"), "p_brand", max_records=15, where="p_size > 10")


@query("single_value", """SELECT l_shipdate::DATE AS day, count(*) AS n,
  (SELECT max(o_totalprice) FROM orders) AS top_price FROM lineitem GROUP BY 1""")
def single_value(spark, sf):
    top = shape.single_value(table(spark, sf, "orders").agg(F.max("o_totalprice")), 0.0)
    day = F.col("l_shipdate").cast("date").alias("day")
    return table(spark, sf, "lineitem").groupBy(day).agg(_n()).withColumn("top_price", F.lit(top))


# --- series ------------------------------------------------------------------

@query("generate_series", """SELECT g AS generated_number, p_name FROM
  (SELECT unnest(range(1, (SELECT max(p_partkey) FROM part) + 1)) AS g) LEFT JOIN part ON p_partkey = g""")
def generate_series(spark, sf):
    parts = table(spark, sf, "part")
    upper = shape.single_value(parts.agg(F.max("p_partkey")))
    numbers = series.generate_series(spark, upper)
    return numbers.join(parts, F.col("generated_number") == F.col("p_partkey"), "left").select(
        "generated_number", "p_name")


def _spine_sql(part: str) -> str:
    return f"""WITH b AS (SELECT date_trunc('{part}', min(o_orderdate))::TIMESTAMP AS lo, max(o_orderdate)::TIMESTAMP AS hi FROM orders),
spine AS (SELECT unnest(range(lo, lo + to_days(0) + INTERVAL 1 {part} * date_diff('{part}', lo, hi), INTERVAL 1 {part})) AS d FROM b),
daily AS (SELECT date_trunc('{part}', o_orderdate)::TIMESTAMP AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT d AS date_{part}, coalesce(n, 0) AS n FROM spine LEFT JOIN daily USING (d)"""


def _spine(spark, sf, part):
    orders = table(spark, sf, "orders")
    bounds = orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("end")).select(
        F.date_trunc(part, "lo").cast("timestamp_ntz").alias("start"), "end")
    counts = orders.groupBy(F.date_trunc(part, "o_orderdate").cast("timestamp_ntz").alias(f"date_{part}")).agg(_n())
    spine = series.date_spine(bounds, part)
    return spine.join(counts, f"date_{part}", "left").na.fill(0, ["n"])


@query("date_spine", _spine_sql("day"))
def date_spine(spark, sf):
    return _spine(spark, sf, "day")


@query("date_spine_month", _spine_sql("month"))
def date_spine_month(spark, sf):
    return _spine(spark, sf, "month")


_PARTS = ["second", "minute", "hour", "day", "week", "month", "quarter", "year"]


@query("intervals_between", "SELECT l_orderkey, l_partkey, o_orderdate, l_shipdate, " + ", ".join(
    f"date_diff('{p}', o_orderdate, l_shipdate) AS n_{p}" for p in _PARTS)
    + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def intervals_between(spark, sf):
    shipped = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    gaps = [series.intervals_between(F.col("o_orderdate"), F.col("l_shipdate"), p).alias(f"n_{p}") for p in _PARTS]
    return shipped.select("l_orderkey", "l_partkey", "o_orderdate", "l_shipdate", *gaps)


# --- cleaning and arithmetic ----------------------------------------------------

_MESSY_SQL = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Player' ELSE concat('p', o_custkey) END AS player,
  CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '2-HIGH' THEN 'n/a' WHEN '1-URGENT' THEN concat(o_custkey % 9, '.5')
    ELSE concat(1 + o_custkey // 1000, ',', lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0')) END AS minutes,
  CASE o_orderpriority WHEN '3-MEDIUM' THEN CAST(17 + o_custkey % 20 AS VARCHAR)
    ELSE concat(17 + o_custkey % 20, '-', o_orderkey % 365) END AS age_text FROM orders"""


def _messy(spark, sf):
    key = F.col("o_custkey")
    grouped = F.concat((F.lit(1) + F.floor(key / 1000)).cast("string"), F.lit(","),
                       F.lpad((key % 1000).cast("string"), 3, "0"))
    priority = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "Player").otherwise(F.concat(F.lit("p"), key)).alias("player"),
        F.when(priority == "5-LOW", "").when(priority == "2-HIGH", "n/a")
        .when(priority == "1-URGENT", F.concat((key % 9).cast("string"), F.lit(".5"))).otherwise(grouped).alias("minutes"),
        F.when(priority == "3-MEDIUM", (17 + key % 20).cast("string"))
        .otherwise(F.concat((17 + key % 20).cast("string"), F.lit("-"), (F.col("o_orderkey") % 365).cast("string")))
        .alias("age_text"))


@query("clean_numeric", f"""WITH m AS ({_MESSY_SQL})
SELECT o_orderkey, minutes, TRY_CAST(replace(minutes, ',', '') AS INTEGER) AS minutes_int,
  TRY_CAST(replace(minutes, ',', '') AS DOUBLE) AS minutes_number FROM m""")
def clean_numeric_query(spark, sf):
    return _messy(spark, sf).select("o_orderkey", "minutes", clean_numeric(F.col("minutes")).alias("minutes_int"),
                                    clean_numeric(F.col("minutes"), "double").alias("minutes_number"))


@query("clean_age", f"""WITH m AS ({_MESSY_SQL})
SELECT o_orderkey, age_text, TRY_CAST(split_part(age_text, '-', 1) AS INTEGER) AS age FROM m""")
def clean_age_query(spark, sf):
    return _messy(spark, sf).select("o_orderkey", "age_text", clean_age(F.col("age_text")).alias("age"))


@query("clean_stage", f"""WITH m AS ({_MESSY_SQL})
SELECT o_orderkey, player, TRY_CAST(replace(minutes, ',', '') AS INTEGER) AS minutes,
  TRY_CAST(minutes AS DOUBLE) AS minutes_90s, TRY_CAST(split_part(age_text, '-', 1) AS INTEGER) AS age
FROM m WHERE player <> 'Player'""")
def clean_stage(spark, sf):
    from ..functions import to_double
    from ..plans.staging import drop_headers
    return drop_headers(_messy(spark, sf), "player").select(
        "o_orderkey", "player", clean_numeric(F.col("minutes")).alias("minutes"),
        to_double(F.col("minutes")).alias("minutes_90s"), clean_age(F.col("age_text")).alias("age"))


@query("safe_divide", """SELECT l_orderkey, l_partkey, round(l_extendedprice / nullif(l_tax, 0), 4) + 0.0 AS price_per_tax,
  round((l_quantity - 1) / nullif(l_quantity - l_linenumber, 0), 9) + 0.0 AS expression_ratio FROM lineitem""")
def safe_divide_query(spark, sf):
    ratio = safe_divide(F.col("l_quantity") - 1, F.col("l_quantity") - F.col("l_linenumber"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey",
        (F.round(safe_divide(F.col("l_extendedprice"), F.col("l_tax")), 4) + 0.0).alias("price_per_tax"),
        r9(ratio, "expression_ratio"))


def _nullable_lines(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_linenumber", "nullif(l_linenumber, 2) AS a", "nullif(l_linenumber * 3, 9) AS b")


@query("safe_add", """SELECT l_orderkey, l_partkey, l_linenumber + coalesce(nullif(l_linenumber, 2), 0) + coalesce(nullif(l_linenumber * 3, 9), 0) AS total
FROM lineitem""")
def safe_add_query(spark, sf):
    total = safe_add([F.col("l_linenumber"), F.col("a"), F.col("b")])
    return _nullable_lines(spark, sf).select("l_orderkey", "l_partkey", total.alias("total"))


@query("safe_subtract", """SELECT l_orderkey, l_partkey, l_linenumber - coalesce(nullif(l_linenumber, 2), 0) - coalesce(nullif(l_linenumber * 3, 9), 0) AS rest
FROM lineitem""")
def safe_subtract_query(spark, sf):
    rest = safe_subtract([F.col("l_linenumber"), F.col("a"), F.col("b")])
    return _nullable_lines(spark, sf).select("l_orderkey", "l_partkey", rest.alias("rest"))


@query("width_bucket", """SELECT o_orderkey, CAST(CASE WHEN o_totalprice < 100000 THEN 0 WHEN o_totalprice >= 400000 THEN 7
  ELSE floor((o_totalprice - 100000) / 50000) + 1 END AS BIGINT) AS bucket FROM orders""")
def width_bucket_query(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", width_bucket(F.col("o_totalprice"), 100000.0, 400000.0, 6).alias("bucket"))


@query("width_bucket_compat", """SELECT o_orderkey, CAST(
  CASE WHEN CAST(o_totalprice AS DECIMAL(28,6)) % CAST(50000 AS DECIMAL(28,6)) = 0 THEN 1 ELSE 0 END
  + least(ceil((o_totalprice - 100000) / 50000), 7) AS BIGINT) AS bucket FROM orders""")
def width_bucket_compat_query(spark, sf):
    bucket = width_bucket_compat(F.col("o_totalprice"), 100000.0, 400000.0, 6)
    return table(spark, sf, "orders").select("o_orderkey", bucket.cast("bigint").alias("bucket"))


_GEO = {"lat1": "CAST(c_custkey % 180 - 90 AS DOUBLE)", "lon1": "CAST(c_custkey % 360 - 180 AS DOUBLE)",
        "lat2": "CAST(c_nationkey * 3 - 30 AS DOUBLE)", "lon2": "CAST(c_nationkey * 7 - 80 AS DOUBLE)"}


@query("haversine", f"""WITH g AS (SELECT c_custkey, {", ".join(f"{e} AS {n}" for n, e in _GEO.items())} FROM customer),
m AS (SELECT c_custkey, 2 * 3961 * asin(sqrt(pow(sin(radians((lat2 - lat1) / 2)), 2)
  + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians((lon2 - lon1) / 2)), 2))) AS mi FROM g)
SELECT c_custkey, round(mi, 5) + 0.0 AS miles, round(mi * 1.60934::DOUBLE, 5) + 0.0 AS kilometres FROM m""")
def haversine(spark, sf):
    points = table(spark, sf, "customer").select("c_custkey", *[F.expr(e).alias(n) for n, e in _GEO.items()])
    args = [F.col(n) for n in _GEO]
    return points.select("c_custkey", (F.round(haversine_distance(*args), 5) + 0.0).alias("miles"),
                         (F.round(haversine_distance(*args, unit="km"), 5) + 0.0).alias("kilometres"))


# --- text and URLs ----------------------------------------------------------------

@query("slugify", """WITH s AS (SELECT doc_id, regexp_replace(regexp_replace(lower(text), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g') AS t
  FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(t, '^[0-9]') THEN '_' || t ELSE t END AS slug FROM s""")
def slugify_query(spark, sf):
    return table(spark, sf, "documents").select("doc_id", slugify(F.col("text")).alias("slug"))


@query("sanitize_name", r"""SELECT page_id, replace(lower(regexp_replace(url, '[\\/*?:"<>|]', '', 'g')), ' ', '_') AS file_name,
  replace(replace(url || '_2023-2024.csv', '.csv', ''), '-', '_') AS table_name FROM pages""")
def sanitize_name_query(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", sanitize_name(F.col("url")).alias("file_name"),
        table_name_of(F.concat("url", F.lit("_2023-2024.csv"))).alias("table_name"))


_FOLDED_SQL = "strip_accents(replace(replace(replace(replace({t}, 'ı', 'i'), 'İ', 'I'), 'ø', 'o'), 'ß', 'ss'))"


@query("fold_names", f"SELECT doc_id, {_FOLDED_SQL.format(t='text')} AS folded FROM documents")
def fold_names(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fold_name(F.col("text")).alias("folded"))


_BARE = "replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', '')"
_BARE_PATH = "replace(replace(url, 'http://', ''), 'https://', '')"


@query("url_host", f"SELECT page_id, url, split_part(split_part({_BARE}, '/', 1), '?', 1) AS host FROM pages")
def url_host_query(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", url_host(F.col("url")).alias("host"))


@query("url_path", f"""WITH b AS (SELECT page_id, url, {_BARE_PATH} AS bare FROM pages)
SELECT page_id, url, split_part(substr(bare, CAST(coalesce(nullif(position('/' IN bare), 0), position('?' IN bare) - 1) AS INT) + 1), '?', 1) AS path
FROM b""")
def url_path_query(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", url_path(F.col("url")).alias("path"))


@query("url_parameter", r"""SELECT page_id, url, nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page_param,
  nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref_param,
  nullif(regexp_extract(url, '[?&]page=([^&]*)', 1), '') AS strict_page FROM pages""")
def url_parameter_query(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", "url", url_parameter(url, "page").alias("page_param"), url_parameter(url, "ref").alias("ref_param"),
        url_parameter(url, "page", whole_name=True).alias("strict_page"))


# --- catalog and profiles -----------------------------------------------------------

def _register_years(spark, sf, prefix):
    for year, rows in _years(spark, sf).items():
        rows.select("o_orderkey", "o_custkey").createOrReplaceTempView(f"{prefix}_{year}")


_YEARLY = """SELECT '{p}_' || year(o_orderdate) AS {src}, o_orderkey, o_custkey FROM orders
WHERE year(o_orderdate) <> 1997"""


@query("relations_by_pattern", _YEARLY.format(p="period_orders", src=V.SOURCE_COLUMN))
def relations_by_pattern(spark, sf):
    _register_years(spark, sf, "period_orders")
    found = catalog.relations_by_pattern(spark, "PERIOD_ORD%", exclude="%_1997")
    return shape.union_relations(catalog.read_relations(spark, found))


@query("relations_by_prefix", _YEARLY.format(p="prefix_orders", src=V.SOURCE_COLUMN))
def relations_by_prefix(spark, sf):
    _register_years(spark, sf, "prefix_orders")
    found = catalog.relations_by_prefix(spark, "Prefix_Orders", exclude="%_1997")
    return shape.union_relations(catalog.read_relations(spark, found))


@query("column_inventory", """SELECT 'events' AS table_name, CAST(i AS INT) AS ordinal_position, c AS column_name, t AS data_type, k AS key_flags,
  (SELECT count(*) FROM events) AS n_rows, (SELECT count(*) FROM events) AS n_filled
FROM (VALUES (1, 'event_id', 'bigint', 'FK'), (2, 'ts', 'timestamp_ntz', ''), (3, 'user_id', 'bigint', 'PK,FK'),
  (4, 'event_type', 'string', ''), (5, 'value', 'double', ''), (6, 'props', 'string', '')) v(i, c, t, k)""")
def column_inventory(spark, sf):
    return catalog.column_inventory({"events": table(spark, sf, "events")}, primary="user_id")


@query("null_profile", """WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS status, CASE WHEN o_totalprice > 200000 THEN o_totalprice END AS price FROM orders),
n AS (SELECT count(*) AS row_count, count(*) - count(o_orderkey) AS a, count(*) - count(status) AS b, count(*) - count(price) AS c FROM o)
SELECT 'orders' AS table_name, row_count, v.column_name, v.data_type, v.null_count,
  CASE WHEN row_count > 0 THEN round(CAST(v.null_count AS DOUBLE) * 100.0 / row_count, 2) ELSE 0.0 END AS null_pct
FROM n, LATERAL (VALUES ('o_orderkey', 'bigint', a), ('status', 'string', b), ('price', 'double', c)) v(column_name, data_type, null_count)""")
def null_profile(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("status"),
        F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice")).alias("price"))
    return catalog.null_profile(orders, "orders")


@query("browse_table", """SELECT o_orderkey, o_custkey, (SELECT count(*) FROM orders) AS total_rows FROM orders ORDER BY o_orderkey LIMIT 50""")
def browse_table(spark, sf):
    return catalog.browse(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 50, ["o_orderkey"])


@query("adhoc_sql", """SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1""")
def adhoc_sql(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("adhoc_orders")
    return spark.sql("SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM adhoc_orders GROUP BY 1")


@query("load_audit", """SELECT count(*) AS main_rows, (SELECT max(year(o_orderdate)) - min(year(o_orderdate)) + 1 FROM orders)::INT AS n_tables
FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""")
def load_audit(spark, sf):
    orders = table(spark, sf, "orders").withColumn("season_id", F.year("o_orderdate"))
    _register_years(spark, sf, "audit_orders")
    found = catalog.relations_by_prefix(spark, "audit_orders")
    return catalog.load_audit(orders, len(catalog.read_relations(spark, found)))


@query("load_audit_fallback", """SELECT count(*) AS main_rows, 1 AS n_tables FROM orders
WHERE year(o_orderdate) = (SELECT min(year(o_orderdate)) FROM orders)""")
def load_audit_fallback(spark, sf):
    """The main season was not loaded; the season before all others stands in."""
    orders = table(spark, sf, "orders").withColumn("season_id", F.year("o_orderdate"))
    first = orders.agg(F.min("season_id")).scalar()
    return catalog.load_audit(orders, 1, main_period=-1, fallback_period=first)
