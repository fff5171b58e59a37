"""Queries for raw files, names and web pages; the files and pages are derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import new_path
from ..sources.files import read_category
from ..sources.names import with_normalized_names
from ..sources.pages import extract_glossary, extract_links, extract_table_cells, table_rows
from .registry import query, table


@query("load_periods", """SELECT year(o_orderdate) || '_' || (year(o_orderdate) + 1) AS season_id, CAST(o_orderkey AS VARCHAR) AS order_rk,
  CAST(o_custkey AS VARCHAR) AS c_1, o_orderpriority AS c FROM orders""")
def load_periods(spark, sf):
    """Orders written as one folder of CSV files per season, then loaded like raw statistics."""
    season = F.concat_ws("-", F.year("o_orderdate"), F.year("o_orderdate") + 1)
    raw = table(spark, sf, "orders").select(
        season.alias("season"), F.col("o_orderkey").alias("Order Rk"), F.col("o_orderpriority").alias("C"),
        F.col("o_custkey").alias("C%"))
    path = new_path(spark, "raw")
    raw.write.partitionBy("season").option("header", True).csv(path)
    loaded = read_category(spark, f"{path}/*/*.csv")
    return loaded.select("season_id", "order_rk", "c_1", "c")


@query("normalize_names", """SELECT l_orderkey AS unnamed_0_level_0_rk, l_quantity AS expected_psxg, l_extendedprice AS expected_psxg_1,
  l_discount AS launched_cmp, l_tax AS launched_cmp_1, l_returnflag AS sweeper_opa, l_linestatus AS _90s, l_partkey AS _order,
  l_suppkey AS moyenne_agee FROM lineitem""")
def normalize_names_query(spark, sf):
    messy = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("Unnamed: 0_level_0_Rk"), F.col("l_quantity").alias("Expected_PSxG"),
        F.col("l_extendedprice").alias("Expected_PSxG+/-"), F.col("l_discount").alias("Launched_Cmp"),
        F.col("l_tax").alias("Launched_Cmp%"), F.col("l_returnflag").alias("Sweeper_#OPA"),
        F.col("l_linestatus").alias("90s"), F.col("l_partkey").alias("Order"),
        F.col("l_suppkey").alias("Moyenne âgée"))
    return with_normalized_names(messy)


_TARGETS = ["The", "the", "of", "and", "to", "de", "der", "la", "le", "und", "que"]
_TARGET_SQL = ", ".join(f"'{t}'" for t in _TARGETS)


@query("extract_links", rf"""WITH v AS (SELECT page_id, regexp_replace(html, '(?s)<!--.*?-->|<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>', '', 'g') AS h FROM pages),
a AS (SELECT page_id, unnest(regexp_extract_all(h, '(?s)<a href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href,
  unnest(regexp_extract_all(h, '(?s)<a href="([^"]*)"[^>]*>(.*?)</a>', 2)) AS t FROM v)
SELECT DISTINCT page_id, trim(t) AS text, 'https://stats.example.org' || replace(href, '&amp;', '&') AS url FROM a
WHERE trim(t) IN ({_TARGET_SQL}) AND NOT contains(href, 'squads') ORDER BY ALL""")
def extract_links_query(spark, sf):
    return extract_links(table(spark, sf, "pages"), _TARGETS, "https://stats.example.org")


def _supplier_pages(spark, sf):
    """One page per supplier with a two-level header table."""
    return table(spark, sf, "supplier").select("s_suppkey", F.concat(
        F.lit("<html><body><p>x</p><table><thead><tr><th></th><th colspan='2'>Account</th></tr>"
              "<tr><th>Name</th><th>Balance</th><th>Nation</th></tr></thead><tbody><tr><td>"),
        "s_name", F.lit("</td><td>"), F.floor("s_acctbal").cast("string"), F.lit("</td><td> "),
        F.col("s_nationkey").cast("string"),
        F.lit("</td></tr><tr><th>Name</th><td>&amp;</td><td></td></tr></tbody></table>"
              "<table><tr><td>second</td></tr></table></body></html>")).alias("html"))


_CELLS = "s_suppkey, {r} AS row_no, CAST({c} AS INT) AS column_no, '{n}' AS column_name, {v} AS value"


@query("extract_table_cells", " UNION ALL ".join(f"SELECT {_CELLS.format(r=r, c=c, n=n, v=v)} FROM supplier" for r, c, n, v in [
    (1, 0, "Unnamed: 0_level_0_Name", "s_name"), (1, 1, "Account_Balance", "CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR)"),
    (1, 2, "Account_Nation", "CAST(s_nationkey AS VARCHAR)"), (2, 0, "Unnamed: 0_level_0_Name", "'Name'"),
    (2, 1, "Account_Balance", "'&'"), (2, 2, "Account_Nation", "CAST(NULL AS VARCHAR)")]))
def extract_table_cells_query(spark, sf):
    return extract_table_cells(_supplier_pages(spark, sf), key="s_suppkey")


@query("table_rows", """SELECT s_suppkey, 1 AS row_no, s_name AS "Unnamed: 0_level_0_Name", CAST(s_nationkey AS VARCHAR) AS "Account_Nation" FROM supplier
UNION ALL SELECT s_suppkey, 2, 'Name', NULL FROM supplier""")
def table_rows_query(spark, sf):
    cells = extract_table_cells(_supplier_pages(spark, sf), key="s_suppkey")
    return table_rows(cells, ["Unnamed: 0_level_0_Name", "Account_Nation"], "s_suppkey")


@query("extract_glossary", """SELECT p_type AS table_name, p_brand AS column_name, 'Size ' || arg_min(p_size, p_partkey) AS definition
FROM part GROUP BY 1, 2
UNION ALL SELECT p_type, 'Name', 'Part ' || arg_min(p_name, p_partkey) FROM part GROUP BY 1""")
def extract_glossary_query(spark, sf):
    """One page per part whose header cells carry tooltips."""
    pages = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("table_name"), F.concat(
        F.lit("<table><thead><tr><th title='no'>Wrong</th></tr></thead></table><table class='a stats_table'><thead><tr>"
              "<th>Silent</th><th data-tip='<b>Size</b>&amp;nbsp;"), F.col("p_size").cast("string"), F.lit("'> "), "p_brand",
        F.lit(" </th><th><span data-tip='Part "), "p_name",
        F.lit("'>Name</span></th><th title='none'> </th></tr></thead></table>")).alias("html"))
    return extract_glossary(pages, order="p_partkey")
