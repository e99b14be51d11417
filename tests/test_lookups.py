import pytest

from terrace.plans import lookups as L


@pytest.fixture
def data(spark):
    clubs = spark.createDataFrame([(1, "Arsenal FC", "London"), (2, "Aston Villa", "Birmingham"),
                                   (3, "Newcastle", "Newcastle upon Tyne")], "club_id long, name string, city string")
    players = spark.createDataFrame(
        [(101, 1, "Bukayo Saka", "Forward", 10, 5), (102, 1, "Martin Ødegaard", "Midfielder", 8, 9),
         (103, 2, "Ollie 100%", "Forward", 15, 2), (104, 3, "Bruno", "Midfielder", 3, 3)],
        "player_id long, club_id long, name string, position string, goals int, assists int")
    matches = spark.createDataFrame(
        [(1, 1, 1, 2, "2024-08-17 15:00:00", 2, 0), (2, 2, 3, 1, "2024-08-24 15:00:00", 1, 1),
         (3, 2, 2, 3, "2024-08-25 15:00:00", 0, 3)],
        "match_id long, gameweek int, home_club_id long, away_club_id long, match_date string, home_score int, away_score int")
    standings = spark.createDataFrame([(1, 1, 10)], "club_id long, position int, points long")
    return clubs, players, matches, standings


def test_clubs_city_filter(data):
    clubs = data[0]
    assert [r["club_id"] for r in L.clubs(clubs, "LON").collect()] == [1]
    assert L.clubs(clubs, "").count() == 3          # empty string = no filter
    assert L.clubs(clubs, "%").count() == 3         # user wildcard is not escaped
    assert [r["name"] for r in L.clubs(clubs).collect()] == ["Arsenal FC", "Aston Villa", "Newcastle"]


def test_players_filters_and_limits(data):
    clubs, players = data[0], data[1]
    assert [r["player_id"] for r in L.players(players, clubs, position="for").collect()] == [103, 101]
    assert [r["player_id"] for r in L.players(players, clubs, club_id=1, search="ØDE").collect()] == [102]
    assert L.players(players, clubs, limit=1).count() == 1
    for bad in (0, 101):
        with pytest.raises(ValueError):
            L.players(players, clubs, limit=bad)
    assert L.players(players, clubs).first()["club_name"] == "Aston Villa"


def test_player_detail_and_not_found(data):
    clubs, players = data[0], data[1]
    assert L.first_or_raise(L.player_detail(players, clubs, 101), "player")["club_name"] == "Arsenal FC"
    with pytest.raises(L.NotFound):
        L.first_or_raise(L.player_detail(players, clubs, 999), "player")


def test_matches_filters(data):
    clubs, _, matches, _ = data
    assert [r["match_id"] for r in L.matches(matches, clubs, club_id=1).collect()] == [1, 2]
    m = L.matches(matches, clubs, gameweek=2, club_id=3).collect()
    assert [r["match_id"] for r in m] == [2, 3]
    assert (m[0]["home_club_name"], m[0]["away_club_name"], m[0]["score"]) == ("Newcastle", "Arsenal FC", "1 - 1")


def test_club_detail(data):
    clubs, players, matches, standings = data
    d = L.club_detail(clubs, players, matches, standings, 1)
    prof = d["profile"].first()
    assert prof["squad_count"] == 2 and prof["standing"]["points"] == 10
    assert [r["match_id"] for r in d["matches"].collect()] == [2, 1]  # newest first
    counts = {r["club_id"]: r for r in L.club_detail_counts(clubs, players, matches, standings).collect()}
    assert (counts[1]["squad_count"], counts[1]["match_count"], counts[1]["has_standing"]) == (2, 2, True)
    assert (counts[2]["match_count"], counts[2]["has_standing"]) == (2, False)


def test_dashboard_filters(data):
    clubs, players, matches, _ = data
    assert sorted(r["club_id"] for r in L.club_search(clubs, "newcastle").collect()) == [3]
    assert sorted(r["club_id"] for r in L.club_search(clubs, "bIRM").collect()) == [2]
    assert L.player_search(players, "100%").count() == 1  # literal, no wildcards
    assert [r["player_id"] for r in L.player_search(players, "", position="Forward", club_id=2).collect()] == [103]
    assert L.gameweek_filter(matches, 2).count() == 2
    assert [r["name"] for r in L.club_options(clubs).collect()][0] == "Arsenal FC"
    h = {r["table_name"]: r["readable"] for r in L.health(clubs.sparkSession, {"clubs": clubs}).collect()}
    assert h == {"clubs": True}


def test_not_found_paths(spark, data, scratch):
    from terrace.sources.sinks import ReportNotGenerated, read_quality_report
    clubs, players, matches, standings = data
    with pytest.raises(L.NotFound):
        L.first_or_raise(L.club_detail(clubs, players, matches, standings, 999)["profile"], "club")
    with pytest.raises(ReportNotGenerated):
        read_quality_report(spark, f"{scratch}/no/report")
