import glob

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from panelspark.operators import compare, metrics, ranking, similarity
from panelspark.session import materialize, shared_dir


@pytest.fixture(scope="module")
def frame():
    """One group holds most rows; values have ties, one very hot value and gaps."""
    rng = np.random.default_rng(7)
    n = 3000
    group = np.where(rng.random(n) < 0.7, "hot", rng.choice(list("abc"), n))
    value = np.where(rng.random(n) < 0.35, 0.0, np.round(rng.gamma(1.0, 20.0, n), 1))
    out = pd.DataFrame({"id": range(n), "g": group, "v": value, "w": rng.integers(0, 40, n).astype(float)})
    out.loc[rng.random(n) < 0.05, "v"] = np.nan
    out.loc[rng.random(n) < 0.02, "g"] = None
    return out


@pytest.fixture(scope="module")
def df(spark, frame):
    cells = frame.astype(object).where(frame.notna(), None)
    return spark.createDataFrame([tuple(r) for r in cells.itertuples(index=False)],
                                 "id int, g string, v double, w double").repartition(5)


def expected(frame, column, ascending=True):
    return frame.groupby("g", dropna=False)[column].rank(pct=True, ascending=ascending)


def test_tie_percentiles_match_pandas(df, frame):
    out = ranking.tie_percentiles(df, ["g"], {"pv": "v", "pw": "w"}, ["w"]).toPandas().sort_values("id")
    np.testing.assert_allclose(out["pv"].astype(float), expected(frame, "v"))
    np.testing.assert_allclose(out["pw"].astype(float), expected(frame, "w", False))
    assert list(out.columns) == ["id", "g", "v", "w", "pv", "pw"]


def windowed(df, column, name):
    """PERCENT_RANK as the window function gives it."""
    order = Window.partitionBy("g").orderBy(F.col(column).asc_nulls_last())
    return df.withColumn(name, F.percent_rank().over(order))


def test_ranks_equal_the_window_function(df):
    ours = ranking.percent_ranks(df, ["g"], {"p": "v", "q": "w"}).toPandas().sort_values("id")
    theirs = windowed(windowed(df, "v", "p"), "w", "q").toPandas().sort_values("id")
    np.testing.assert_array_equal(ours[["p", "q"]].to_numpy(), theirs[["p", "q"]].to_numpy())


def test_ranks_of_any_type(df):
    """Text, dates, booleans and NaN, one hot value, in one call with numbers."""
    typed = df.select("id", "g", F.col("v").cast("string").alias("text"), F.date_add(F.lit("2020-01-01").cast("date"),
                      F.col("w").cast("int")).alias("day"), (F.col("w") > 3).alias("flag"),
                      F.when(F.col("w") == 5, float("nan")).otherwise(F.col("v")).alias("odd"), "w")
    outputs = {f"p_{c}": c for c in ("text", "day", "flag", "odd", "w")}
    ours = ranking.percent_ranks(typed, ["g"], outputs).toPandas().sort_values("id")
    theirs = typed
    for name, column in outputs.items():
        theirs = windowed(theirs, column, name)
    theirs = theirs.toPandas().sort_values("id")
    np.testing.assert_array_equal(ours[list(outputs)].to_numpy(), theirs[list(outputs)].to_numpy())


def test_wide_rows_are_never_stored(spark, df):
    before = set(glob.glob(f"{shared_dir(spark)}/panelspark/*/values-*"))
    ranking.percent_ranks(df.withColumn("ballast", F.lit("x")), ["g"], {"p": "v"}).count()
    for path in set(glob.glob(f"{shared_dir(spark)}/panelspark/*/values-*")) - before:
        assert set(spark.read.parquet(path).columns) == {"__m", "g", "__v", "__ties", "__place"}


def test_a_value_that_holds_half_the_rows(spark):
    """Half the rows share a value, some share all of them: one cell each, and the ranks of a window."""
    rows = [(i, None if i % 11 == 0 else i % 3, 0.0 if i % 2 else float(i % 50), 7 if i % 2 else i % 20,
             None if i % 5 == 0 else i % 4) for i in range(4000)]
    typed = spark.createDataFrame(rows, "id int, g int, v double, w int, x bigint")
    outputs = {f"p_{c}": c for c in "vwx"}
    before = set(glob.glob(f"{shared_dir(spark)}/panelspark/*/profiles-*"))
    ranked = ranking.tie_percentiles(typed, ["g"], outputs, ["w"]).toPandas().sort_values("id")
    stored = set(glob.glob(f"{shared_dir(spark)}/panelspark/*/profiles-*")) - before
    assert [spark.read.parquet(p).count() < 2000 for p in stored] == [True]
    frame = typed.toPandas().sort_values("id")
    for c in "vwx":
        theirs = frame.groupby("g", dropna=False)[c].rank(pct=True, ascending=c != "w")
        np.testing.assert_allclose(ranked[f"p_{c}"].to_numpy(float), theirs.to_numpy(float), equal_nan=True)


def test_ranks_are_joined_back_once(spark, df):
    """One join per data type in long form, one regroup, one join of the wide rows, however many measures."""
    wide = materialize(df.withColumns({f"m{i}": F.col("v") + i for i in range(12)}).withColumn("ballast", F.lit("x")))

    def exchanges(measures):
        out = ranking.percent_ranks(wide, ["g"], {f"p_{m}": m for m in measures})
        text = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
        tree = text.split("\n\n")[0]
        return tree.count("Exchange ("), tree.count("Join")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few, many = exchanges(["v"]), exchanges([f"m{i}" for i in range(12)])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert few == many and many[0] <= 9 and many[1] == 3


@pytest.mark.parametrize("keys", [["g"], []])
def test_quantiles(df, frame, keys):
    out = ranking.group_quantiles(df, keys, "v", {"q1": 0.25, "med": 0.5, "top": 1.0}).toPandas()
    grouped = frame.groupby("g", dropna=False) if keys else frame.groupby(lambda _: 0)
    for q, name in ((0.25, "q1"), (0.5, "med"), (1.0, "top")):
        want = sorted(grouped["v"].quantile(q))
        np.testing.assert_allclose(sorted(out[name]), want)
    assert out["n"].sum() == frame["v"].notna().sum()


@pytest.mark.parametrize("keys", [["g"], []])
def test_neighbours(df, frame, keys):
    out = ranking.value_neighbours(df, keys, "v").toPandas()
    out["g"] = out["g"].fillna("-") if keys else "all"
    groups = frame["g"].fillna("-") if keys else pd.Series("all", index=frame.index)
    for g, values in frame["v"].groupby(groups):
        distinct = np.sort(values.dropna().unique())
        mine = out[out["g"] == g].sort_values("v")
        np.testing.assert_array_equal(mine["v"], distinct)
        np.testing.assert_array_equal(mine["__prev"].iloc[1:], distinct[:-1])
        np.testing.assert_array_equal(mine["__next"].iloc[:-1], distinct[1:])
        assert pd.isna(mine["__prev"].iloc[0]) and pd.isna(mine["__next"].iloc[-1])


def test_one_row_group_and_empty(spark):
    one = spark.createDataFrame([("a", 1.0)], "g string, v double")
    assert ranking.percent_ranks(one, ["g"], {"p": "v"}).first()["p"] == 0.0
    assert ranking.percent_ranks(one.where("false"), ["g"], {"p": "v"}).count() == 0


def test_composite_score_skips_missing(spark):
    df = spark.createDataFrame([(1, "A", 1.0, None), (2, "A", 2.0, 5.0), (3, "A", 2.0, 7.0)],
                               "id int, role string, a double, b double")
    out = {r.id: round(r.score, 4) for r in metrics.composite_score(df, ["role"], ["a", "b", "none"], "score").collect()}
    assert out == {1: 33.3333, 2: round((2.5 / 3 + 0.5) / 2 * 100, 4), 3: round((2.5 / 3 + 1) / 2 * 100, 4)}
    assert metrics.composite_score(df, ["role"], ["none"], "score").first()["score"] == 0.0


def test_role_scores_match_one_role_at_a_time(spark):
    rows = [(i, r, float(i * 7 % 11), float(i * 5 % 13), float(i % 4)) for i, r in
            enumerate(["Attacker", "Defender", "Other"] * 9)]
    df = spark.createDataFrame(rows, "id int, scouting_role string, npxg double, goals double, interceptions double")
    out = {r.id: r.overall_score for r in metrics.role_scores(df).collect()}
    for role, names in (("Attacker", ["npxg", "goals"]), ("Defender", ["interceptions"])):
        part = metrics.composite_score(df.where(f"scouting_role = '{role}'"), [], names, "s").collect()
        for r in part:
            assert out[r.id] == pytest.approx(r.s)
    assert {out[i] for i in range(2, 27, 3)} == {0.0}


def test_profile_and_comparison(spark):
    rows = [(f"p{i}", "s1", "2024", "FW", float(i), float(-i)) for i in range(10)] + [("x", "s1", "2024", "DF", 99.0, 0.0)]
    df = spark.createDataFrame(rows, "player_id string, squad string, season_id string, primary_position string, npxg double, goals double")
    menu = [("Attacking", "npxg", "npxG"), ("Attacking", "absent", "None"), ("Attacking", "goals", "Goals")]

    def profile(p):
        return compare.metric_profile(df, compare.newest_record(df, df.player_id == p), menu)
    best, worst = materialize(profile("p9")), materialize(profile("p0"))
    assert [(r.metric, r.percentile, r.raw) for r in best.orderBy("menu_position").collect()] == [
        ("npxG", 100.0, 9.0), ("Goals", 10.0, -9.0)]
    inverted = compare.metric_profile(df, compare.newest_record(df, df.player_id == "p9"), menu, lower_is_better=["goals"])
    assert [r.percentile for r in inverted.orderBy("menu_position").collect()] == [100.0, 100.0]
    notes = [(r.side, r.metric) for r in compare.strengths_weaknesses(best).collect()]
    assert notes == [("strength", "npxG"), ("weakness", "Goals")]
    edges = {(r.better, r.metric, r["diff"]) for r in compare.head_to_head(best, worst).collect()}
    assert edges == {("first", "npxG", 90.0), ("second", "Goals", -90.0)}
    texts = [(r.first, r.second) for r in compare.comparison_table(best, worst).collect()]
    assert texts == [("9.00 (100%)", "0.00 (10%)"), ("-9.00 (10%)", "0.00 (100%)")] or texts[0] == ("9.00 (100%)", "0.00 (10%)")


def test_similar_entities_match_brute_force(spark):
    rng = np.random.default_rng(3)
    data = pd.DataFrame({"player_id": [f"p{i:02}" for i in range(40)], "squad": "s", "season_id": "1",
                         "primary_position": ["FW", "DF"] * 20, "a": rng.random(40), "b": rng.random(40) * 100, "c": 5.0})
    df = spark.createDataFrame([tuple(r) for r in data.itertuples(index=False)],
                               "player_id string, squad string, season_id string, primary_position string, a double, b double, c double")
    got = similarity.similar_entities(df, df.where("player_id = 'p04'"), ["a", "b", "c"]).collect()
    peers = data[data.primary_position == "FW"].set_index("player_id")[["a", "b"]]
    z = (peers - peers.mean()) / peers.std()
    distance = np.sqrt(((z - z.loc["p04"]) ** 2).sum(axis=1)).drop("p04").sort_values()
    assert [r.player_id for r in got] == list(distance.index[:5])
    np.testing.assert_allclose([r.distance for r in got], distance[:5])
    few = df.where("player_id IN ('p00', 'p02', 'p04', 'p06', 'p08')")
    assert similarity.similar_entities(few, df.where("player_id = 'p04'"), ["a"]).count() == 0
    assert similarity.style_columns(df) == ["a", "b", "c"]


def test_entity_absent_from_target(spark):
    df = spark.createDataFrame([("p", "s", "1", "FW", 1.0)], "player_id string, squad string, season_id string, primary_position string, a double")
    assert similarity.similar_entities(df, df.where("false"), ["a"]).count() == 0
