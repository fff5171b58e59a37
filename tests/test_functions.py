import unicodedata

import pytest
from pyspark.sql import functions as F

from panelspark import fixed_values as V
from panelspark.functions import (clean_age, clean_numeric, cohort_flag, entity_key, fold_name, haversine_distance,
                                  nation_code, performance_tier, quadrant, rate_or_zero, risk_rating, role_of,
                                  safe_add, safe_divide, safe_subtract, sanitize_name, slugify, slugify_text,
                                  surrogate_key, to_double, url_host, url_parameter, url_path, value_estimate,
                                  width_bucket, width_bucket_compat, without_country)


def values(spark, rows, schema, column):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema).coalesce(1)
    return [r[0] for r in df.select(column).collect()]


def normalized(text):
    for old, new in V.FOLD_PAIRS:
        text = text.replace(old, new)
    return "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")


def test_clean_numeric(spark):
    texts = ["1,020", "1.5", "-0.5", "1e3", "", None, "n/a", "12", "99999999999"]
    assert values(spark, texts, "x string", clean_numeric(F.col("x"))) == [1020, 2, -1, 1000, None, None, None, 12, None]
    assert values(spark, ["1,020.5"], "x string", clean_numeric(F.col("x"), "double")) == [1020.5]
    long = ["9,007,199,254,740,993", "-9223372036854775808", "9223372036854775808", "2.5"]
    assert values(spark, long, "x string", clean_numeric(F.col("x"), "bigint"))[:2] == [2**53 + 1, -2**63]
    assert values(spark, long, "x string", clean_numeric(F.col("x"), "bigint"))[3] == 3
    assert values(spark, ["1.5", "1,5", ""], "x string", to_double(F.col("x"))) == [1.5, None, None]


def test_clean_age(spark):
    assert values(spark, ["24-340", "22", "", None, "x-1"], "x string", clean_age(F.col("x"))) == [24, 22, None, None, None]


def test_divisions(spark):
    rows = [(6, 3), (6, 0), (6, None), (None, 3)]
    assert values(spark, rows, "a int, b int", safe_divide(F.col("a"), F.col("b"))) == [2.0, None, None, None]
    assert values(spark, rows, "a int, b int", rate_or_zero(F.col("a"), F.col("b"))) == [2.0, 0.0, 0.0, None]
    assert values(spark, [(6, 1), (1, 1)], "a int, b int", safe_divide(F.col("a") + 2, F.col("b") - 1)) == [None, None]


def test_safe_sums(spark):
    rows = [(1, 2, 3), (1, None, 3), (None, None, None)]
    columns = [F.col(c) for c in "abc"]
    assert values(spark, rows, "a int, b int, c int", safe_add(columns)) == [6, 4, 0]
    assert values(spark, rows, "a int, b int, c int", safe_subtract(columns)) == [-4, -2, 0]
    for operator in (safe_add, safe_subtract):
        with pytest.raises(TypeError):
            operator(F.col("a"))


def test_width_bucket(spark):
    amounts = [190000.0, 290000.0, 320000.0, 399999.99, 400000.0, 470000.0, 510000.0, 610000.0]
    assert values(spark, amounts, "x double", width_bucket(F.col("x"), 2e5, 6e5, 4)) == [0, 1, 2, 2, 3, 3, 4, 5]
    assert values(spark, amounts, "x double", width_bucket_compat(F.col("x"), 2e5, 6e5, 4)) == [0, 1, 2, 2, 3, 3, 4, 5]
    assert values(spark, [0.0, 7e5], "x double", width_bucket_compat(F.col("x"), 2e5, 6e5, 4)) == [-1, 6]


def test_haversine(spark):
    points = [(48.864716, 2.349014, 52.377956, 4.897070)]
    args = [F.col(c) for c in "abcd"]
    schema = "a double, b double, c double, d double"
    assert round(values(spark, points, schema, haversine_distance(*args, unit="km"))[0]) == 430
    assert round(values(spark, points, schema, haversine_distance(*args))[0]) == 267
    with pytest.raises(ValueError):
        haversine_distance(*args, unit="m")


def test_surrogate_key(spark):
    rows = [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)]
    schema = "x string, y string, z string"
    assert values(spark, rows, schema, surrogate_key([F.col(c) for c in "xyz"])) == [
        "7b193b3d33184464106f41ddf733783b", "4f32a73dc87b7bbb7a654d8898d58c7e",
        "d9c538b129f1a3ad6ecfe55345c32a05", "2fa5491950d66d153d23cfbcfea4e164"]
    assert values(spark, rows[:1] + rows[2:3], schema, surrogate_key([F.col("x")])) == [
        "0cc175b9c0f1b6a831c399e269772661", "f14cc5cdce0420f4a5a6b6d9d7b85f39"]
    empty = values(spark, [(None, "b")], "x string, y string", surrogate_key([F.col("x"), F.col("y")], True))
    assert empty == values(spark, [("-b",)], "x string", F.md5("x"))


def test_entity_key(spark):
    got = values(spark, [("Ann", None, "fr FRA")], "n string, b string, c string",
                 entity_key(F.col("n"), F.col("b"), F.col("c")))
    assert got == values(spark, ["Ann--fr FRA"], "x string", F.md5("x"))


def test_urls(spark):
    urls = ["www.google.co.uk?utm_source=google&utm_medium=cpc", "http://witanddelight.com/2018/01/tips/",
            "https://www.nytimes.com/2018/01/01/blog", "android-app://m.facebook.com/", "bare.org",
            "http://a.com/p/?utm_source=x&y=1"]
    assert values(spark, urls, "u string", url_host(F.col("u"))) == [
        "www.google.co.uk", "witanddelight.com", "www.nytimes.com", "m.facebook.com", "bare.org", "a.com"]
    assert values(spark, urls[:3] + urls[4:], "u string", url_path(F.col("u"))) == [
        "", "2018/01/tips/", "2018/01/01/blog", "bare.org", "p/"]
    tagged = ["http://d.com/m?utm_medium=organic", "http://d.com/m?utm_medium=organic&utm_source=github",
              "http://d.com/?source="]
    assert values(spark, tagged, "u string", url_parameter(F.col("u"), "source")) == [None, "github", None]
    assert values(spark, tagged, "u string", url_parameter(F.col("u"), "source", whole_name=True)) == [None] * 3
    assert values(spark, tagged[:2], "u string", url_parameter(F.col("u"), "utm_medium", True)) == ["organic"] * 2


def test_names(spark):
    names = ["Türkıye İø ß", "Crème Brûlée", "Ø", None, "Łódź"]
    assert values(spark, names, "n string", fold_name(F.col("n"))) == ["Turkiye Io ss", "Creme Brulee", "Ø", None, "Łodz"]
    odd = ["한국 Ünal", "e\u0301té", "Ǻ ḯ ﬁ 𝒜", "Việt Nam", "\u0958 \u09cb \u1100", "plain"]
    want = [normalized(t) for t in odd]
    assert values(spark, odd, "n string", fold_name(F.col("n"))) == want
    assert values(spark, ["!Hell0 world-hi", "0Hell0 world-hi"], "n string", slugify(F.col("n"))) == [
        "hell0_world_hi", "_0hell0_world_hi"]
    assert [slugify_text(t) for t in ("!Hell0 world-hi", "0Hell0 world-hi")] == ["hell0_world_hi", "_0hell0_world_hi"]
    assert values(spark, ['Goal & Shot: "A/B"?'], "n string", sanitize_name(F.col("n"))) == ["goal_&_shot_ab"]
    assert values(spark, ["eng ENG", "France", "x Abc", None], "n string", nation_code(F.col("n"))) == [
        "ENG", "France", "x Abc", None]


def test_labels(spark):
    positions = [None, "GK", "MF,FW", "FW,MF", "DF,MF", "FW", "MF", "DF", "XX", "DF,FW"]
    assert values(spark, positions, "p string", role_of(F.col("p"))) == [
        "Unknown", "Goalkeeper", "Winger/AM", "Winger/AM", "Wingback/DM", "Attacker", "Midfielder", "Defender", "Other",
        "Attacker"]
    assert values(spark, [2003, 2002, None], "b int", cohort_flag(F.col("b"))) == [True, False, False]
    rows = [(0.95, 0.1), (0.1, 0.95), (0.8, None), (0.6, 0.1), (0.5, 0.5), (None, None)]
    assert values(spark, rows, "a double, d double", performance_tier(F.col("a"), F.col("d"))) == [
        V.TIER_S, V.TIER_S, V.TIER_A, V.TIER_B, V.TIER_C, V.TIER_C]
    rows = [(1, None, 0.0), (2, 0.3, -0.5), (2, 0.1, -0.2), (2, 0.1, 0.0)]
    assert values(spark, rows, "s int, v double, f double", risk_rating(F.col("s"), F.col("v"), F.col("f"))) == [
        V.RISK_NEW, V.RISK_HIGH, V.RISK_DECLINING, V.RISK_SAFE]
    rows = [(1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0), (None, 1.0)]
    assert values(spark, rows, "x double, y double", quadrant(F.col("x"), F.col("y"), F.lit(0.5), F.lit(0.5))) == [
        "Elite", "Specialist", "Efficient", "Developing", None]


def test_value_estimate(spark):
    rows = [(0.5, 2.0, 22, "eng Premier League"), (0.5, 2.0, 25, "it Serie A"), (0.5, 2.0, 31, "xx Other"),
            (0.5, 2.0, 25, "La Liga")]
    got = values(spark, rows, "a double, d double, age int, c string",
                 value_estimate(F.col("a"), F.col("d"), F.col("age"), F.col("c")))
    assert got == [105.0, 42.0, 17.5, 52.5]
    assert values(spark, [(0.2469999996, 0.0, 25, "xx Other")], "a double, d double, age int, c string",
                  value_estimate(F.col("a"), F.col("d"), F.col("age"), F.col("c"))) == [12.3]
    assert values(spark, ["eng Premier League", "Ligue 1"], "c string", without_country(F.col("c"))) == [
        "Premier League", "Ligue 1"]
