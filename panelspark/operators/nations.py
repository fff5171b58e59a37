"""Nation codes to display names and flag codes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as V
from ..functions.text import nation_code


def _looked_up(code: Column, names: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())]), code)


def iso_countries(spark: SparkSession) -> DataFrame:
    """(code, name, alpha_2) of all ISO countries, from the locale data of the Java runtime."""
    locale = spark._jvm.java.util.Locale
    rows = []
    for alpha_2 in locale.getISOCountries():
        place = locale("", alpha_2)
        rows.append((place.getISO3Country(), place.getDisplayCountry(locale.ENGLISH), alpha_2))
    return spark.createDataFrame(rows, "code string, name string, alpha_2 string")


def display_nation(df: DataFrame, iso_names: DataFrame, nation: str = "nation") -> DataFrame:
    """Add ``nation_code`` and ``display_nation``: exceptions first, then an ISO (code, name) table, else the code.

    The ISO table is small enough for the planner to broadcast it by its size.
    """
    coded = df.withColumn("nation_code", nation_code(F.col(nation)))
    known = iso_names.select(F.col("code").alias("nation_code"), F.col("name").alias("__iso"))
    named = coded.join(known, "nation_code", "left")
    shown = F.coalesce(_looked_up(F.col("nation_code"), V.NATION_NAMES), F.col("__iso"), F.col("nation_code"))
    return named.select(*df.columns, "nation_code", shown.alias("display_nation"))


def flag_code(df: DataFrame, iso_codes: DataFrame, nation: str = "nation") -> DataFrame:
    """Add ``flag_code``: exceptions first, then an ISO (code, alpha_2) table in lower case, else NULL."""
    coded = df.withColumn("__code", nation_code(F.col(nation)))
    known = iso_codes.select(F.col("code").alias("__code"), F.col("alpha_2").alias("__alpha_2"))
    named = coded.join(known, "__code", "left")
    found = F.coalesce(_looked_up(F.col("__code"), V.NATION_FLAG_CODES), F.lower("__alpha_2"))
    return named.select(*df.columns, found.alias("flag_code"))
