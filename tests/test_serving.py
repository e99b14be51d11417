"""The reference's serving expectations, checked on our DataFrame functions
after one pipeline run over the league's literal batches."""

import tempfile

import pytest
from pyspark.sql import functions as F

from terrace.plans import lookups as L
from terrace.plans import views
from terrace.plans.pipeline import run_pipeline
from terrace.sources.sinks import read_quality_report
from terrace.sources.warehouse import Warehouse
from tests import fixtures as FX


@pytest.fixture(scope="module")
def gold(spark):
    root = tempfile.mkdtemp(prefix="terrace-serving-")
    wh = Warehouse(spark, f"{root}/gold")
    rep = run_pipeline(spark, FX.raw_batches(spark), root, batch_id="s1", warehouse=wh,
                       silver_formats=("parquet",))
    t = wh.tables()
    return rep, t["clubs"], t["players"], t["matches"], t["standings"]


def test_quality_report(spark, gold):
    rep = gold[0]
    q = rep["quality"]
    assert (q["status"], q["source_records"], q["processed_records"], q["rejected_records"],
            q["missing_fields"], q["duplicates"]) == ("PASS", 55, 55, 0, 0, 0)
    f = read_quality_report(spark, rep["transformation"]["quality_report"]).first()
    assert sorted(d["dataset"] for d in f["dataset_details"]) == ["clubs", "matches", "players", "standings"]


def test_clubs(gold):
    _, clubs, *_ = gold
    rows = L.clubs(clubs).collect()
    assert len(rows) == 10 and [r["name"] for r in rows] == sorted(r["name"] for r in rows)
    assert {"club_id", "name", "short_name", "stadium", "capacity", "city", "founded_year"} <= set(rows[0].asDict())
    london = L.clubs(clubs, "London").collect()
    assert london and all(r["city"] == "London" for r in london)
    assert {"Arsenal FC", "Chelsea FC"} <= {r["name"] for r in london}
    assert L.clubs(clubs, "Nowhere").count() == 0


def test_club_detail(gold):
    _, clubs, players, matches, standings = gold
    d = L.club_detail(clubs, players, matches, standings, 1)
    prof = L.first_or_raise(d["profile"], "club")
    assert prof["name"] == "Arsenal FC" and prof["squad_count"] == d["squad"].count() == 4
    assert prof["standing"] is not None and prof["standing"]["points"] == 11
    dates = [r["match_date"] for r in d["matches"].collect()]
    assert dates and dates == sorted(dates, reverse=True)
    with pytest.raises(L.NotFound):
        L.first_or_raise(L.club_detail(clubs, players, matches, standings, 99999)["profile"], "club")


def test_players(gold):
    _, clubs, players, *_ = gold
    all_ = L.players(players, clubs).collect()
    assert len(all_) == 20 and all_[0]["goals"] >= all_[1]["goals"]
    assert {"player_id", "name", "position", "goals", "assists", "appearances"} <= set(all_[0].asDict())
    assert all(r["club_id"] == 2 for r in L.players(players, clubs, club_id=2).collect())
    fw = L.players(players, clubs, position="Forward").collect()
    assert fw and all("Forward" in r["position"] for r in fw)
    h = L.players(players, clubs, search="haaland").collect()
    assert len(h) == 1 and h[0]["name"] == "Erling Haaland"
    assert L.players(players, clubs, limit=5).count() == 5
    for bad in (0, 101):
        with pytest.raises(ValueError):
            L.players(players, clubs, limit=bad)
    p = L.first_or_raise(L.player_detail(players, clubs, 111), "player")
    assert (p["name"], p["position"], p["goals"], p["appearances"]) == ("Erling Haaland", "Forward", 27, 31)
    with pytest.raises(L.NotFound):
        L.first_or_raise(L.player_detail(players, clubs, 99999), "player")


def test_matches(gold):
    _, clubs, _, matches, _ = gold
    all_ = L.matches(matches, clubs).collect()
    assert len(all_) == 15 and all_[0]["home_club_name"] and all_[0]["away_club_name"]
    assert all(r["gameweek"] == 1 for r in L.matches(matches, clubs, gameweek=1).collect())
    c1 = L.matches(matches, clubs, club_id=1).collect()
    assert c1 and all(r["home_club_id"] == 1 or r["away_club_id"] == 1 for r in c1)
    assert L.matches(matches, clubs, gameweek=99).count() == 0


def test_standings_scorers_summary(gold):
    _, clubs, players, _, standings = gold
    table = L.standings(clubs, standings).collect()
    assert len(table) == 10 and [r["dynamic_rank"] for r in table] == list(range(1, 11))
    assert {"club_name", "points", "goal_difference", "form"} <= set(table[0].asDict())
    top = L.top_scorers(players, clubs, 5).collect()
    assert len(top) == 5 and top[0]["scorer_rank"] == 1
    assert (top[0]["player_name"], top[0]["goals"]) == ("Erling Haaland", 27)
    assert all(r["goals"] > 0 for r in top)
    with pytest.raises(ValueError):
        L.top_scorers(players, clubs, 0)
    summary = L.club_summary(clubs, players, standings).collect()
    assert len(summary) == 10 and [r["league_position"] for r in summary] == sorted(r["league_position"] for r in summary)
    assert all(isinstance(r["avg_player_appearances"], float) for r in summary if r["squad_size"])
