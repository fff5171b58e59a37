import datetime as dt
import gzip
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from panelspark.operators import nations, panel as P
from panelspark.plans import refresh
from panelspark.plans.staging import CATEGORIES, DECIMAL, WHOLE
from panelspark.session import materialize, new_path, scratch
from panelspark.sources import files, pages, runs
from panelspark.sources.names import normalize_names
from panelspark.suite import build_queries

COMMON = ["Unnamed: 0_level_0_Rk", "Unnamed: 1_level_0_Player", "Unnamed: 2_level_0_Nation", "Unnamed: 3_level_0_Pos",
          "Unnamed: 4_level_0_Squad", "Unnamed: 5_level_0_Comp", "Unnamed: 6_level_0_Age", "Unnamed: 7_level_0_Born"]


def test_normalize_names():
    assert normalize_names(["Unnamed: 0_level_0_Rk", "Expected_PSxG", "Expected_PSxG+/-", "Launched_Cmp%", "Launched_Cmp",
                            "Sweeper_#OPA", "90s", "Order", "Âge"]) == [
        "unnamed_0_level_0_rk", "expected_psxg", "expected_psxg_1", "launched_cmp", "launched_cmp_1", "sweeper_opa",
        "_90s", "_order", "age"]


def write_category(root, season, category, players, value):
    """A raw file: header, data rows with the value for every measure, the header repeated in the middle."""
    sources = [s for s in list(WHOLE[category].values()) + list(DECIMAL.get(category, {}).values())
               if not s.startswith("unnamed_7")]
    header = COMMON + sources + ["Unnamed: 99_level_0_Matches"]
    lines = [",".join(header)]
    for i, (name, position, squad, rank) in enumerate(players):
        if i == 1:
            lines.append(",".join(["Rk", "Player", "Nation", "Pos", "Squad", "Comp", "Age", "Born"] + ["x"] * len(sources) + ["M"]))
        cells = [str(i), name, "eng ENG", f'"{position}"', squad, "eng Premier League", "24-100", "2001"]
        cells += ['"1,200"' if s == "playing_time_min" else "13.3" if s == "playing_time_90s" else str(value + rank)
                  for s in sources]
        lines.append(",".join(cells + ["Matches"]))
    folder = root / season
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{category}_{season}.csv").write_text("\n".join(lines) + "\n")


def write_season(root, season, value):
    outfield = [(f"Player {i}", ["FW", "MF,DF", "DF"][i % 3], "Leeds", i) for i in range(9)]
    keepers = [(f"Keeper {i}", "GK", "Leeds", i) for i in range(3)]
    for c in CATEGORIES:
        write_category(root, season, c, keepers if "goalkeeping" in c else outfield + keepers, value)


def test_build_and_refresh(spark, tmp_path):
    raw, marts = tmp_path / "raw", str(tmp_path / "marts")
    write_season(raw, "2023-2024", 10)
    write_season(raw, "2024-2025", 20)
    built = refresh.build(spark, str(raw), marts)
    panel = built["player_panel"]
    assert panel.count() == 24 and {r[0] for r in panel.select("season_id").distinct().collect()} == {"2023_2024", "2024_2025"}
    row = panel.where("player_name = 'Player 2' AND season_id = '2023_2024'").first()
    assert (row.minutes_played, row.minutes_90s, row.goals, row.touches, row.age, row.birth_year) == (1200, 13.3, 12, 12, 24, 2001)
    assert built["keeper_panel"].count() == 6
    score = built["scouting"].where("player_name = 'Player 8' AND season_id = '2024_2025'").first()
    assert score.percentile_attacking == 1.0 and score.scouting_role == "Defender"
    assert score.expected_contribution_per_90 == pytest.approx(56 / 13.3)
    keeper = built["trends"].where("player_name = 'Keeper 1'").orderBy("season_id").collect()
    assert len(keeper) == 2 and keeper[1].yoy_change_specialist == pytest.approx(10 / 13.3)
    assert built["players"].count() == 12 and built["consistency"].count() == 12
    assert built["valuation"].count() == 24

    write_season(raw, "2024-2025", 50)
    write_season(raw, "2023-2024", 99)  # not refreshed, so not read
    fresh = refresh.refresh(spark, str(raw), marts, ["2024-2025"])
    goals = {(r.player_name, r.season_id): r.goals for r in fresh["player_panel"].collect()}
    assert goals[("Player 0", "2023_2024")] == 10 and goals[("Player 0", "2024_2025")] == 50
    assert len(goals) == 24
    trend = fresh["trends"].where("player_name = 'Player 0' AND season_id = '2024_2025'").first()
    assert trend.yoy_change_scoring == pytest.approx(80 / 13.3)


def rows_of(marts):
    return {n: sorted(map(str, df.select(*sorted(df.columns)).collect())) for n, df in marts.items()}


def test_refresh_that_dies_leaves_the_published_marts(spark, tmp_path, monkeypatch):
    raw, target = tmp_path / "raw", str(tmp_path / "marts")
    write_season(raw, "2023-2024", 10)
    write_season(raw, "2024-2025", 20)
    before = rows_of(refresh.build(spark, str(raw), target))
    write_season(raw, "2024-2025", 50)

    def dies(_):
        raise RuntimeError("lost")
    with monkeypatch.context() as patch:
        patch.setattr(refresh.M, "consistency_mart", dies)  # seven marts of the new run are written by then
        with pytest.raises(RuntimeError, match="lost"):
            refresh.refresh(spark, str(raw), target, ["2024-2025"])
    assert rows_of(refresh.open_marts(spark, target)) == before
    # A manifest that its writer did not finish is passed over, and its number is not taken again.
    (tmp_path / "marts" / runs.MANIFESTS / "2.json").write_text('{"players": ')
    assert rows_of(refresh.open_marts(spark, target)) == before
    after = rows_of(refresh.refresh(spark, str(raw), target, ["2024-2025"]))
    assert runs.manifest_numbers(runs.Files(spark, target), target) == [1, 2, 3]
    assert after == rows_of(refresh.build(spark, str(raw), str(tmp_path / "anew")))
    gone = runs.drop_old_runs(spark, target, keep=1)
    assert len(gone) == len({g for g in gone if "/run=00000" in g}) > 0
    assert rows_of(refresh.open_marts(spark, target)) == after
    assert runs.drop_old_runs(spark, target, keep=1) == []


def test_refresh_derives_only_the_entities_it_touches(spark, tmp_path, monkeypatch):
    raw, target = tmp_path / "raw", str(tmp_path / "marts")
    write_season(raw, "2023-2024", 10)
    write_season(raw, "2024-2025", 20)
    for c in CATEGORIES:  # Player 0 leaves, Player 99 comes, most others are in no replaced season
        keeper = "goalkeeping" in c
        write_category(raw, "2025-2026", c, [("Keeper 0", "GK", "Leeds", 0)] if keeper else [("Player 0", "FW", "Leeds", 0)], 30)
    refresh.build(spark, str(raw), target)
    for c in CATEGORIES:
        keeper = "goalkeeping" in c
        write_category(raw, "2025-2026", c, [("Keeper 0", "GK", "Leeds", 1)] if keeper else [("Player 99", "FW", "Leeds", 0)], 40)
    seen = {}

    def watched(name):
        derive = getattr(refresh.M, name)

        def run(*frames):
            seen[name] = {r.player_name for f in frames for r in f.select("player_name").distinct().collect()}
            return derive(*frames)
        return run
    with monkeypatch.context() as patch:
        for name in ("trends_mart", "consistency_mart", "players_dim"):
            patch.setattr(refresh.M, name, watched(name))
        fresh = rows_of(refresh.refresh(spark, str(raw), target, ["2025-2026"]))
    assert all(names <= {"Player 0", "Player 99", "Keeper 0"} and "Player 0" in names for names in seen.values())
    assert len(seen) == 3
    assert fresh == rows_of(refresh.build(spark, str(raw), str(tmp_path / "anew")))


def test_runs(spark, tmp_path):
    target, schema = str(tmp_path / "m"), "season_id string, goals int"
    with pytest.raises(ValueError, match="no published marts"):
        runs.open_all(spark, target)
    first = runs.Run(spark, target)
    assert first.published("m") is None
    first.write("m", spark.createDataFrame([("a/b c", 1), ("2024", 2), (None, 3)], schema), "season_id")
    first.write("none", spark.createDataFrame([], schema), "season_id")
    first.publish()
    assert runs.open_all(spark, target)["none"].count() == 0
    rival, second = runs.Run(spark, target), runs.Run(spark, target)
    assert [tuple(r) for r in second.published("m", ["a/b c"]).collect()] == [(1, "a/b c")]
    added = second.write("m", spark.createDataFrame([("2025", 9)], schema), "season_id", ["a/b c", "2025"])
    assert [tuple(r) for r in added.collect()] == [(9, "2025")]
    second.publish()
    assert sorted(map(str, runs.open_all(spark, target)["m"].collect())) == [
        "Row(goals=2, season_id='2024')", "Row(goals=3, season_id=None)", "Row(goals=9, season_id='2025')"]
    with pytest.raises(RuntimeError, match="another run"):
        rival.publish()


def test_headers_of_many_files_take_one_job(spark, tmp_path):
    heads = ["Player,Gls", "Player,\"Gls\"", "Player,Ast"]
    for i in range(60):
        (tmp_path / f"x_{i:02}.csv").write_text(f"{heads[i % 3]}\n" + f"A,{i}\n" * 3)
    (tmp_path / "x_60.csv").write_text("\n  \nPlayer,Ast\nA,60\n")
    (tmp_path / "x_61.csv").write_text("")
    (tmp_path / "x_62.csv").write_text("Player,Gls\n" + "A,62\n" * 300_000)
    (tmp_path / "x_63 é.csv").write_text("Player,Gls")
    spark.sparkContext.setJobGroup("headers", "")
    found = files.headers_of(spark, f"{tmp_path}/x_*.csv")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {h: len(p) for h, p in found.items()} == {("Player", "Gls"): 42, ("Player", "Ast"): 21, (): 1}
    assert sum(len(p) for p in found.values()) == 64 and len(jobs) <= 1 + 5  # and one per different first line


def test_read_category_keeps_text(spark, tmp_path):
    folder = tmp_path / "2025-2026"
    folder.mkdir()
    (folder / "x_2025-2026.csv").write_text('A%,A\n"1,000",\nA%,A\n')
    out = files.read_category(spark, f"{tmp_path}/*/x_*.csv")
    assert out.columns == ["a", "a_1", "season_id", "load_timestamp"]
    assert [tuple(r)[:3] for r in out.collect()] == [("1,000", None, "2025_2026"), ("A%", "A", "2025_2026")]


def test_every_file_is_read_by_its_own_header(spark, tmp_path):
    texts = {"2023-2024": "Player,Gls,Ast\nA,1,2\n", "2024-2025": "Player,Ast,Gls,New\nA,4,3,x\n",
             "2025-2026": "Player,Gls\nA,5\n"}
    for season, text in texts.items():
        (tmp_path / season).mkdir()
        (tmp_path / season / f"x_{season}.csv").write_text(text)
    out = files.read_category(spark, f"{tmp_path}/*/x_*.csv", required=["player", "gls"])
    rows = {r.season_id: (r.player, r.gls, r.ast, r.new) for r in out.collect()}
    assert rows == {"2023_2024": ("A", "1", "2", None), "2024_2025": ("A", "3", "4", "x"),
                    "2025_2026": ("A", "5", None, None)}
    with pytest.raises(ValueError, match="2025-2026.* lacks ast"):
        files.read_category(spark, f"{tmp_path}/*/x_*.csv", required=["ast"])


def test_refresh_empties_a_season_that_lost_its_rows(spark, tmp_path):
    path = str(tmp_path / "mart")
    df = spark.createDataFrame([("2023", 1), ("2024", 2), ("2025", 3)], "season_id string, goals int").select("goals", "season_id")
    files.save_mart(df, path, ["season_id"])
    fresh = spark.createDataFrame([(9, "2024")], "goals int, season_id string")
    out = files.refresh_period(fresh, path, periods=["2024", "2025"])
    assert sorted((r.season_id, r.goals) for r in out.collect()) == [("2023", 1), ("2024", 9)]
    emptied = files.refresh_period(fresh.where("false"), path, periods=["2024"])
    assert [(r.season_id, r.goals) for r in emptied.collect()] == [("2023", 1)]


def test_links(spark):
    html = ("<a class=x href='/p/players?a=1&amp;b=2'> Shooting </a><!-- <a href='/c'>Passing</a> -->"
            "<script>var s = \"<a href='/s'>Passing</a>\";</script><A HREF=/bare>Pass<b>ing</b></A>"
            '<a href="/squads/1">Shooting</a><a href="/other">Other</a><a href="/bare">Passing</a><a>Passing</a>')
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    out = pages.extract_links(df, ["Shooting", "Passing"], "https://x.org")
    assert sorted((r.text, r.url) for r in out.collect()) == [
        ("Passing", "https://x.org/bare"), ("Shooting", "https://x.org/p/players?a=1&b=2")]
    assert pages.extract_links(df, ["Shooting", "Passing"], by_url=True).count() == 2


def test_table_cells(spark):
    html = ("<table><thead><tr><th></th><th colspan=2>Top &amp; More</th><th rowspan=2>Tall</th></tr>"
            "<tr><th>Rk</th><th>A</th><th>B</th></tr></thead>"
            "<tr><td>1</td><td rowspan=2>x</td><td>y</td><td> z  z </td></tr><tr><td>2</td><td></td><td>w</td></tr></table>")
    df = spark.createDataFrame([(7, html), (8, "<p>none</p>"), (9, None)], "page_id int, html string")
    cells = pages.extract_table_cells(df)
    assert [tuple(r) for r in cells.orderBy("row_no", "column_no").collect()] == [
        (7, 1, 0, "Unnamed: 0_level_0_Rk", "1"), (7, 1, 1, "Top & More_A", "x"), (7, 1, 2, "Top & More_B", "y"),
        (7, 1, 3, "Tall_Tall", "z z"),
        (7, 2, 0, "Unnamed: 0_level_0_Rk", "2"), (7, 2, 1, "Top & More_A", "x"), (7, 2, 2, "Top & More_B", None),
        (7, 2, 3, "Tall_Tall", "w")]
    wide = pages.table_rows(cells, ["Top & More_A", "Tall_Tall"]).orderBy("row_no").collect()
    assert [tuple(r) for r in wide] == [(7, 1, "x", "z z"), (7, 2, "x", "w")]


def test_hostile_spans(spark):
    page = ("<table><tr><th>a</th><th colspan='10000000'>b</th><th colspan='2'>c</th><th colspan='\u00b2'>d</th></tr>"
            f"<tr><td rowspan='{'9' * 5000}'>1</td><td>2</td><td>3</td><td>4</td><td>5</td></tr><tr><td>6</td></tr></table>")
    cells = pages._grid(pages._tables(page)[0]["rows"])
    assert cells == [["a", "b", "c", "c", "d"], ["1", "2", "3", "4", "5"], ["1", "6"]]


def test_tables_are_read_in_pieces_and_no_further_than_needed(monkeypatch):
    inner = "<table><tr><td>x &amp; y</td></tr></table>"
    page = (f"<p>a</p><table class='big'><thead><tr><th title='t'>A</th></tr></thead><tr><td>1{inner}</td><td>2</td></tr></table>"
            "<script>if (a < b) '<table>'</script><table class='stats_table'><thead><tr><th data-tip='u'>B</th></tr></thead></table>"
            f"<!-- <table> --> {inner}")
    def joined(tables):
        return [{**t, "rows": [{**r, "cells": [{**c, "text": "".join(c["text"])} for c in r["cells"]]} for r in t["rows"]]}
                for t in tables]
    for piece in (1, 7, 64):
        assert joined(pages._tables(page, piece=piece)) == joined(pages._tables(page))
        monkeypatch.setattr(pages._tables, "__defaults__", (pages._tables.__defaults__[0], piece))
        assert pages._first_table(page) == [(1, 0, "A", "1"), (1, 1, "Unnamed: 1", "2")]
        assert pages._glossary(page) == [(1, "B", "u")]
    first = pages._tables(page, lambda found: bool(found) and not found[0]["open"], 8)
    assert len(first) < len(pages._tables(page)) and not first[0]["open"]
    read = []
    feed = pages._Tables.feed
    monkeypatch.setattr(pages._Tables, "feed", lambda self, text: (read.append(len(text)), feed(self, text)))
    monkeypatch.setattr(pages._tables, "__defaults__", (pages._tables.__defaults__[0], pages.PIECE))
    assert len(pages._first_table(page + "<p>more</p>" * 1_000_000)) == 2 and sum(read) <= pages.PIECE


def test_glossary(spark):
    first = ("<table><thead><tr><th title='wrong'>A</th></tr></thead></table><table class='sortable stats_table'><thead>"
             "<tr><th title='Over'>Group</th></tr><tr><th data-tip='<b>Goals</b>&amp;nbsp;scored'>Gls</th><th>Rk</th>"
             "<th><span data-tip='Inner'>In</span></th><th title='again'>Gls</th></tr></thead></table>")
    df = spark.createDataFrame([(1, "Shooting", first), (2, "Shooting", first.replace("Over", "Later"))],
                               "page_id int, table_name string, html string")
    out = pages.extract_glossary(df)
    assert sorted(map(tuple, out.collect())) == [
        ("Shooting", "Gls", "Goals scored"), ("Shooting", "Group", "Over"), ("Shooting", "In", "Inner")]


def test_nations(spark):
    df = spark.createDataFrame([("eng ENG",), ("fr FRA",), ("xx QQQ",), (None,)], "nation string")
    iso = spark.createDataFrame([("FRA", "France", "FR")], "code string, name string, alpha_2 string")
    assert [r.display_nation for r in nations.display_nation(df, iso).collect()] == ["England", "France", "QQQ", None]
    assert [r.flag_code for r in nations.flag_code(df, iso).collect()] == ["gb-eng", "fr", None, None]


def test_dim_skips_unknown_values(spark):
    df = spark.createDataFrame([("p", "s", "1", "old", 1990), ("p", "s", "2", None, 1991)],
                               "player_id string, squad string, season_id string, nation string, birth_year int")
    assert tuple(P.dim_entity(df, "player_id", ["nation"], ["birth_year"]).first()) == ("p", "old", 1991)


def test_facets(spark):
    df = spark.createDataFrame([("1", "L1", "A", 20, "FW"), ("2", "L2", "B", 30, "DF")],
                               "season_id string, competition string, squad string, age int, scouting_role string")
    assert P.facet_filter(df, ["1"], ["L1", "L2"], ages=(18, 25)).count() == 1
    assert P.facet_filter(df, under_23=True).count() == 1
    assert P.facet_filter(df.drop("competition", "age"), leagues=["none"], ages=(0, 1)).count() == 2
    assert P.facet_filter(df, squads=["B"], role="DF").count() == 1
    assert [tuple(r) for r in P.facet_values(df, ["L2"]).collect()] == [
        ("league", "L1"), ("league", "L2"), ("max_age", "30"), ("min_age", "20"), ("season", "2"), ("season", "1"),
        ("squad", "B")]
    assert [tuple(r) for r in P.facet_values(df.where("false")).collect()] == [("max_age", "45"), ("min_age", "15")]


def test_history_prefers_keepers(spark):
    schema = "player_name string, season_id string, squad string"
    keepers = spark.createDataFrame([("Ann", "2", "A"), ("Ann", "1", "A")], schema)
    field = spark.createDataFrame([("Ann", "3", "A"), ("Bob", "1", "B")], schema)
    columns = ["player_name", "season_id", "squad"]
    ann = P.entity_history(F.col("player_name") == "Ann", keepers, field, columns).collect()
    assert [r.season_id for r in ann] == ["1", "2"]
    assert P.entity_history(F.col("player_name") == "Bob", keepers, field, columns).count() == 1


def test_stamp_load(spark):
    stamp = files.stamp_load(spark.range(1)).first()["processed_at"]
    assert abs((dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - stamp).total_seconds()) < 86400


def test_period_of_equals_the_pattern_on_the_whole_path(spark):
    paths = ["file:/a/b/c/2023-2024/x.csv", "/r/season=2023/x.csv", "/a=b=c/x.csv", "2023/x.csv", "/2023/x.csv", "/x.csv",
             "x.csv", "", None, "/a/=2023/x.csv", "/a//x.csv", "s3://b/season=2023/x.csv", "/a/2023/"]
    found = spark.createDataFrame([(p,) for p in paths], "path string").select(
        files.period_of(F.col("path")).alias("cut"), F.regexp_extract("path", r"/(?:[^/=]+=)?([^/=]+)/[^/]+$", 1).alias("whole"))
    rows = found.collect()
    assert [r.cut for r in rows] == [r.whole for r in rows]
    assert rows[0].cut == "2023-2024" and rows[1].cut == "2023"
    assert "substring_index" in str(files.period_of(F.col("path")))  # the pattern sees the end of a path only


def test_raw_categories_share_one_shuffle(spark, monkeypatch):
    rows = spark.createDataFrame(
        [("p", "s", str(1990 + i % 3), "name", "eng ENG", "GK" if i % 2 else "FW", "eng L", 20, 2000, i) for i in range(40)],
        "player_id string, squad string, season_id string, player_name string, nation string, primary_position string, "
        "competition string, age int, birth_year int, goals bigint")
    monkeypatch.setattr(build_queries, "panel_with_keepers", lambda spark, sf: rows)
    context = spark.sparkContext
    context.setJobGroup("raw categories", "")
    try:
        root = build_queries.write_raw(spark, "")
        jobs = len(context.statusTracker().getJobIdsForGroup("raw categories"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= len(build_queries.WHOLE) + 3  # a shuffle of its own is one more job for each category
    for category in build_queries.WHOLE:
        stored = files.read_category(spark, f"{root}/{category}/*/*.csv").groupBy("season_id").count().collect()
        keepers = category in build_queries.KEEPER_CATEGORIES
        expected = {"1990": 14, "1991": 13, "1992": 13} if not keepers else {"1990": 7, "1991": 7, "1992": 6}
        assert {r.season_id: r["count"] for r in stored} == expected


def test_portions_of_seasons():
    assert refresh.portions({"c": 4, "a": 5, "b": 3, "d": 9, "e": 0}, 7) == [["a"], ["b", "c"], ["d"], ["e"]]
    assert refresh.portions({"a": 1, "b": 2}, 0) == [["a"], ["b"]]
    assert refresh.portions({"": 0}, 0) == [[""]] and refresh.portions({}, 9) == []


def test_marts_by_portions_of_seasons_are_those_of_one_go(spark, tmp_path, monkeypatch):
    raw, whole, parts = tmp_path / "raw", str(tmp_path / "whole"), str(tmp_path / "parts")
    seasons = ["2022-2023", "2023 é%20-2024", "2024-2025"]
    for i, season in enumerate(seasons):
        write_season(raw, season, 10 * i)
    before = rows_of(refresh.build(spark, str(raw), whole))
    derived = []
    panel = refresh.M.player_panel
    monkeypatch.setattr(refresh, "PORTION", 0)
    monkeypatch.setattr(refresh.M, "player_panel", lambda stages: derived.append(1) or panel(stages))
    assert rows_of(refresh.build(spark, str(raw), parts)) == before and len(derived) == 3
    assert len(before["player_panel"]) == 36 and len(before["squad_profile"]) > 0
    assert rows_of(refresh.refresh(spark, str(raw), parts, [seasons[0], seasons[2]])) == before and len(derived) == 3 + 2


def test_only_files_of_the_portion_are_read(spark, tmp_path):
    for season in ("2023-2024", "2024-2025", "2025-2026"):
        (tmp_path / season).mkdir()
        (tmp_path / season / f"x_{season}.csv").write_text("Player,Gls\nA,1\n")
    chosen = files.read_category(spark, f"{tmp_path}/*/x_*.csv").where(F.col("season_id").isin(["2024_2025"]))
    assert [r.season_id for r in chosen.collect()] == ["2024_2025"]
    (tmp_path / "2023-2024" / "x_2023-2024.csv").unlink()  # it is not opened
    assert [r.season_id for r in chosen.collect()] == ["2024_2025"]


def test_gzipped_files_are_read_and_a_gzipped_copy_is_not(spark, tmp_path):
    texts = {"2023-2024": "Player,Gls\nA,1\n", "2024-2025": "Player,Gls\nB,2\n", "2025-2026": "Player,Gls,Ast\nC,3,4\n"}
    for season, text in texts.items():
        (tmp_path / season).mkdir()
        (tmp_path / season / f"x_{season}.csv.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "2023-2024" / "x_2023-2024.csv").write_text(texts["2023-2024"])
    (tmp_path / "2023-2024" / "x_old.csv.bak").write_text("Player,Gls\nZ,9\n")
    pattern = f"{tmp_path}/*/x_*.csv"
    rows = files.read_category(spark, pattern).collect()
    assert sorted((r.player, r.gls, r.ast, r.season_id) for r in rows) == [
        ("A", "1", None, "2023_2024"), ("B", "2", None, "2024_2025"), ("C", "3", "4", "2025_2026")]
    sizes = files.season_bytes(spark, [pattern])
    assert set(sizes) == {"2023_2024", "2024_2025", "2025_2026"}
    assert sizes["2024_2025"] == 8 * (tmp_path / "2024-2025" / "x_2024-2025.csv.gz").stat().st_size


def test_scratch_deletes_its_own_tables(spark):
    kept = materialize(spark.range(3), "kept")
    with scratch(spark):
        outer = new_path(spark, "outer")
        with pytest.raises(RuntimeError), scratch(spark):
            inner = new_path(spark, "inner")
            spark.range(2).write.parquet(inner)
            raise RuntimeError
        assert not Path(inner).exists()
        spark.range(2).write.parquet(outer)
        assert spark.read.parquet(outer).count() == 2
    assert not Path(outer).exists() and kept.count() == 3


def test_a_build_leaves_its_marts_only(spark, monkeypatch):
    rows = spark.createDataFrame(
        [("p", "s", str(1990 + i % 3), f"name {i}", "eng ENG", "GK" if i % 2 else "FW", "eng L", 20, 2000, i, 9.0)
         for i in range(40)],
        "player_id string, squad string, season_id string, player_name string, nation string, primary_position string, "
        "competition string, age int, birth_year int, goals bigint, minutes_90s double")
    monkeypatch.setattr(build_queries, "panel_with_keepers", lambda spark, sf: rows)
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    seen = {}
    read = refresh.read_stages

    def watched(spark, source, *rest, **named):
        seen["root"] = Path(source)
        seen["raw"] = [p.name for p in Path(source).rglob("part-*")]
        return read(spark, source, *rest, **named)
    monkeypatch.setattr(refresh, "read_stages", watched)

    def shuffled():
        return {b for b in map(lambda i: blocks_now.apply(i).name(), range(blocks_now.size())) if b.startswith("shuffle_")}
    blocks_now = blocks.getAllBlocks()
    before, folders = shuffled(), set(Path(build_queries.new_path(spark, "x")).parent.iterdir())
    marts = build_queries.built(spark, "")
    assert seen["raw"] and all(name.endswith(".csv.gz") for name in seen["raw"])
    assert not seen["root"].exists()
    new = set(seen["root"].parent.iterdir()) - folders
    assert [p.name.split("-")[0] for p in new] == ["marts"]
    for _ in range(60):  # files go after the action
        blocks_now = blocks.getAllBlocks()
        if not shuffled() - before:
            break
        time.sleep(0.5)
    assert not shuffled() - before
    assert marts["player_panel"].count() == 40 and marts["scouting"].count() == 40 and marts["trends"].count() == 40
