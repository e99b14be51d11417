
from pyspark.sql import functions as F

from terrace.operators.clean import clean_clubs, clean_matches, clean_players, clean_standings
from terrace.operators.form import club_form
from terrace.plans import views
from terrace.schemas import RAW_SCHEMAS
from tests import fixtures as FX

STANDINGS_SCHEMA = ("club_id long, played long, won long, drawn long, lost long, goals_for long, "
                    "goals_against long, points long")
CLEAN_STANDINGS_SCHEMA = ("position int, club_id long, played long, won long, drawn long, lost long, "
                          "goals_for long, goals_against long, goal_difference long, points long, "
                          "points_per_game double, win_percentage double, form string")


def league(spark):
    clubs = clean_clubs(spark.createDataFrame([r + (None, None) for r in FX.clubs_rows()], RAW_SCHEMAS["clubs"]),
                        checks="eager")
    matches = clean_matches(spark.createDataFrame([r + (None, None) for r in FX.MATCHES], RAW_SCHEMAS["matches"]),
                            checks="eager")
    standings = clean_standings(spark.createDataFrame(FX.STANDINGS, STANDINGS_SCHEMA), matches, checks="eager")
    return clubs, matches, standings


def test_golden_league_table(spark):
    clubs, matches, standings = league(spark)
    got = [(r["position"], r["club_id"], r["points"], r["goal_difference"], r["points_per_game"],
            r["win_percentage"], r["form"]) for r in standings.orderBy("position").collect()]
    assert got == FX.GOLDEN_TABLE
    lt = views.league_table(clubs, standings).orderBy("dynamic_rank").collect()
    assert [r["dynamic_rank"] for r in lt] == list(range(1, 11))
    assert lt[0]["club_id"] == 5 and lt[0]["points"] == 13 and len(lt[0].asDict()) == 17


def test_form_na_for_club_without_matches(spark):
    _, matches, _ = league(spark)
    extra = spark.createDataFrame([(11, 0, 0, 0, 0, 0, 0, 0)], STANDINGS_SCHEMA)
    st = clean_standings(extra, matches, checks="eager").first()
    assert st["form"] == "N/A"


def test_form_ties_on_date_broken_by_id(spark):
    raw = spark.createDataFrame([(1, 1, 1, 2, "2024-01-01 10:00:00", "1 - 0", None, None, None),
                                 (2, 1, 2, 1, "2024-01-01 10:00:00", "1 - 0", None, None, None)],
                                RAW_SCHEMAS["matches"])
    f = {r["club_id"]: r["form"] for r in club_form(clean_matches(raw)).collect()}
    assert f == {1: "W-L", 2: "L-W"}


def _standings(spark, rows):
    return spark.createDataFrame([(i + 1, cid, 10, 0, 0, 0, gf, ga, gf - ga, pts, 0.0, 0.0, "N/A")
                                  for i, (cid, pts, gf, ga) in enumerate(rows)], CLEAN_STANDINGS_SCHEMA)


def _clubs(spark, ids):
    return clean_clubs(spark.createDataFrame([FX.clubs_rows(max(ids))[i - 1] + (None, None) for i in ids],
                                             RAW_SCHEMAS["clubs"]))


def test_dense_rank_ties_and_keys(spark):
    # full tie on all four keys shares a rank, no gap
    st = _standings(spark, [(1, 18, 20, 10), (2, 18, 20, 10), (3, 15, 30, 5)])
    r = {x["club_id"]: x["dynamic_rank"] for x in views.league_table(_clubs(spark, [1, 2, 3]), st).collect()}
    assert r == {1: 1, 2: 1, 3: 2}
    # tie on points broken by GD, then GF, negative GD ordering
    st = _standings(spark, [(1, 20, 14, 4), (2, 20, 10, 6)])
    assert {x["club_id"]: x["dynamic_rank"] for x in views.league_table(_clubs(spark, [1, 2]), st).collect()} == {1: 1, 2: 2}
    st = _standings(spark, [(1, 20, 15, 5), (2, 20, 25, 15)])
    assert {x["club_id"]: x["dynamic_rank"] for x in views.league_table(_clubs(spark, [1, 2]), st).collect()} == {2: 1, 1: 2}
    st = _standings(spark, [(1, 5, 10, 22), (2, 5, 10, 13)])
    assert {x["club_id"]: x["dynamic_rank"] for x in views.league_table(_clubs(spark, [1, 2]), st).collect()} == {2: 1, 1: 2}


def test_inner_join_drops_club_without_standing(spark):
    st = _standings(spark, [(1, 10, 5, 5)])
    assert views.league_table(_clubs(spark, [1, 2]), st).count() == 1


def _players(spark, rows):
    raw = spark.createDataFrame([(pid, cid, f"P{pid}", "fwd", "X", 9, g, a, apps, None, None)
                                 for pid, cid, g, a, apps in rows], RAW_SCHEMAS["players"])
    return clean_players(raw)


def test_top_scorers_order_ties_and_limits(spark):
    clubs = _clubs(spark, [1])
    p = _players(spark, [(1, 1, 10, 4, 20), (2, 1, 10, 10, 20), (3, 1, 10, 10, 18), (4, 1, 0, 5, 5),
                         (5, 1, 7, 0, 3), (6, 1, 7, 0, 3), (7, 1, 2, 1, 1), (8, 1, 1, 0, 1), (9, 1, 3, 0, 1)])
    full = views.top_scorers_view(p, clubs, window_rows=10**6).orderBy("scorer_rank").collect()
    assert [r["player_id"] for r in full] == [3, 2, 1, 5, 6, 9, 7, 8]  # goals>0 only; assists desc, apps asc
    assert sorted(r["scorer_rank"] for r in full) == list(range(1, 9))  # full ties get distinct numbers
    for k, n in [(1, 1), (3, 3), (50, 8)]:
        top = views.top_scorers(p, clubs, k).orderBy("scorer_rank").collect()
        assert len(top) == n and [r["player_id"] for r in top] == [r["player_id"] for r in full[:n]]
    ranged = views.top_scorers_view(p, clubs).orderBy("scorer_rank").collect()
    assert [r["player_id"] for r in ranged] == [r["player_id"] for r in full]


def test_club_analytics_aggregates_and_empties(spark):
    clubs = _clubs(spark, [1, 2, 3, 4])
    p = _players(spark, [(1, 1, 12, 8, 30), (2, 1, 6, 4, 25), (3, 1, 0, 1, 20), (4, 3, 1, 1, 2)])
    st = _standings(spark, [(1, 10, 5, 5), (2, 7, 3, 4)])
    rows = {r["club_id"]: r for r in views.club_analytics(clubs, p, st).collect()}
    assert len(rows[1].asDict()) == 15
    assert (rows[1]["squad_size"], rows[1]["squad_goals"], rows[1]["squad_assists"],
            rows[1]["avg_player_appearances"]) == (3, 18, 13, 25.0)
    assert (rows[2]["squad_size"], rows[2]["squad_goals"], rows[2]["avg_player_appearances"]) == (0, 0, None)
    assert (rows[3]["league_position"], rows[3]["points"], rows[3]["goal_difference"], rows[3]["form"]) == (0, 0, 0, None)
    assert (rows[4]["squad_size"], rows[4]["league_position"], rows[4]["avg_player_appearances"]) == (0, 0, None)


def test_views_lifecycle_and_live_recompute(spark):
    clubs, matches, standings = league(spark)
    players = _players(spark, [(111, 5, 27, 5, 5)])
    names = views.create_views(spark, clubs, players, standings)
    assert all(spark.catalog.tableExists(v) for v in names)
    views.create_views(spark, clubs, players, standings)  # replace is idempotent
    assert spark.sql("SELECT count(*) c FROM vw_league_table").first()["c"] == 10
    # V9: the view function over new inputs reflects them at once
    players2 = _players(spark, [(111, 5, 29, 5, 5)])
    assert views.top_scorers(players2, clubs, 1).first()["goals"] == 29
    views.drop_views(spark)
    views.drop_views(spark)
    assert not spark.catalog.tableExists("vw_league_table")


def test_views_follow_the_tables(spark, scratch):
    """Nothing of a view is computed before it is queried; registering the tables' new state runs no job."""
    path = f"{scratch}/players"
    P = ("player_id long, club_id long, name string, position string, nationality string, jersey_number int, appearances int, "
         "goals int, assists int, goal_contributions int, goals_per_game double")
    spark.createDataFrame([(1, 1, "A", "Forward", "X", 9, 5, 3, 1, 4, 0.6)], P).write.parquet(path)
    clubs = spark.createDataFrame([(1, "Club", "CLB", "St", 10, "City", 1900, "#fff")],
                                  "club_id long, name string, short_name string, stadium string, capacity int, city string, "
                                  "founded_year int, primary_color string")
    standings = spark.createDataFrame([(1, 1, 3, 2, "W")], "club_id long, position int, points long, goal_difference long, form string") \
        .selectExpr("*", "1L AS played", "1L AS won", "0L AS drawn", "0L AS lost", "2L AS goals_for", "0L AS goals_against",
                    "3.0D AS points_per_game", "100.0D AS win_percentage")
    views.create_views(spark, clubs, spark.read.parquet(path), standings)
    assert [r["player_id"] for r in spark.table("vw_top_scorers").collect()] == [1]
    spark.createDataFrame([(2, 1, "B", "Forward", "X", 10, 6, 9, 2, 11, 1.5)], P).write.mode("append").parquet(path)
    views.create_views(spark, clubs, spark.read.parquet(path), standings)
    assert [(r["scorer_rank"], r["player_id"]) for r in views.query_top_scorers_sql(spark, 5).collect()] == [(1, 2), (2, 1)]
    assert [r["player_id"] for r in spark.table("vw_top_scorers").orderBy("scorer_rank").collect()] == [2, 1]
    assert spark.table("vw_club_analytics").first()["squad_size"] == 2
    views.drop_views(spark)


def test_creating_views_runs_no_job(spark):
    from terrace.plans import derive
    lg = derive.league(spark, "/root/testdata/sf0.001")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("views", "views")
    tables = lg.clubs, lg.players, lg.standings
    before = len(tracker.getJobIdsForGroup("views"))
    views.create_views(spark, *tables)
    assert len(tracker.getJobIdsForGroup("views")) == before
    spark.sparkContext.setJobGroup("rest", "rest")


def test_live_views_are_made_once(spark, scratch):
    """Tables change, the three views are not registered again, and show the change."""
    from terrace.sources.warehouse import Warehouse
    clubs, matches, standings = league(spark)
    wh = Warehouse(spark, f"{scratch}/live")
    players = _players(spark, [(111, 5, 27, 5, 5), (112, 5, 3, 1, 5)])
    wh.publish({"clubs": clubs, "players": players, "standings": standings}, check=False)
    views.create_live_views(spark, wh)
    top = lambda: [(r["scorer_rank"], r["player_id"], r["goals"]) for r in spark.table("vw_top_scorers").orderBy("scorer_rank").collect()]
    assert top() == [(1, 111, 27), (2, 112, 3)]
    wh.publish_upserts({"players": _players(spark, [(112, 5, 30, 1, 5), (113, 5, 1, 0, 5)])}, check=False)
    assert top() == [(1, 112, 30), (2, 111, 27), (3, 113, 1)]
    assert views.query_top_scorers_sql(spark, 1).first()["player_id"] == 112
    assert spark.table("vw_club_analytics").where("club_id = 5").first()["squad_goals"] == 58
    leader = spark.table("vw_league_table").where("dynamic_rank = 1").first()["club_id"]
    other = standings.where(f"club_id <> {leader}").limit(1).withColumn("points", F.lit(999).cast(standings.schema["points"].dataType))
    wh.publish_upserts({"standings": other}, check=False)
    first = spark.table("vw_league_table").where("dynamic_rank = 1").first()
    assert first["club_id"] != leader and first["points"] == 999
    assert all(r["status"] == "PASS" for r in views.verify_views(spark).collect() if r["check_name"].startswith("required"))
    views.drop_views(spark)
    for t in ("clubs", "players", "standings"):
        spark.catalog.dropTempView(f"live_{t}")
