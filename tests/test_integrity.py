from terrace.operators import integrity as I
from terrace.operators.upsert import cascade_delete, table_counts
from terrace.schemas import LEAGUE_TABLES

CLUBS = "club_id long, name string, capacity int, founded_year int"


def test_fk_violations(spark):
    clubs = spark.createDataFrame([(1, "A", 100, 1900)], CLUBS)
    players = spark.createDataFrame([(10, 1), (11, 99), (12, None)], "player_id long, club_id long")
    orphans = I.fk_orphans(players, clubs, ["club_id"], ["club_id"]).collect()
    assert [r["player_id"] for r in orphans] == [11]  # null FK is not checked
    v = I.fk_violations(players, clubs, "players", ["club_id"], ["club_id"], "fk").first()
    assert v["violations"] == 1


def test_check_and_unique(spark):
    clubs = spark.createDataFrame([(1, "A", 0, 1600), (2, "A", 10, None), (3, "B", 5, 1900)], CLUBS)
    checks = {r["constraint_name"]: r["violations"] for r in
              I.check_violations(clubs, "clubs", LEAGUE_TABLES["clubs"].checks).collect()}
    assert checks == {"check_capacity_positive": 1, "check_founded_year": 1}  # NULL passes a CHECK
    dups = I.duplicate_keys(clubs, "clubs", ["name"], "unique_name").collect()
    assert [(r["key_value"], r["occurrences"]) for r in dups] == [("A", 2)]


def test_pk_and_not_null(spark):
    d = spark.createDataFrame([(1, "x"), (1, None), (None, "y")], "k long, v string")
    pk = {r["constraint_name"]: r["occurrences"] for r in I.pk_violations(d, "t", ["k"]).collect()}
    assert pk == {"primary_key": 2, "primary_key_not_null": 1}
    nn = {r["column_name"]: r["null_count"] for r in I.not_null_counts(d, "t").collect()}
    assert nn == {"k": 1, "v": 1}


def test_order_and_sequence_checks(spark):
    good = spark.createDataFrame([(1, 10), (1, 10), (2, 9), (3, 9)], "r long, p long")
    assert I.order_violations(good, "r", "p").count() == 0
    bad = spark.createDataFrame([(1, 10), (2, 11)], "r long, p long")
    assert I.order_violations(bad, "r", "p").count() == 1
    assert I.rank_sequence(spark.createDataFrame([(1,), (2,), (3,)], "r long"), "r").first()[0] == 0
    assert I.rank_sequence(spark.createDataFrame([(1,), (3,)], "r long"), "r").first()[0] == 1


def test_integrity_report_and_metadata(spark):
    clubs = spark.createDataFrame([(1, "A", 10, 1900)], CLUBS)
    players = spark.createDataFrame([(10, 2, 1, 1, 1)], "player_id long, club_id long, goals int, assists int, appearances int")
    rep = {(r["table_name"], r["constraint_name"]): (r["violations"], r["status"])
           for r in I.integrity_report({"clubs": clubs, "players": players}, LEAGUE_TABLES).collect()}
    assert rep[("players", "fk_players_club")] == (1, "FAIL")
    assert rep[("clubs", "primary_key")] == (0, "PASS")
    assert I.missing_columns(clubs, ["club_id", "stadium"]) == ["stadium"]
    assert I.missing_tables(spark, ["no_such_table_here"]) == ["no_such_table_here"]


def test_cascade_delete(spark):
    clubs = spark.createDataFrame([(1, "A", 10, 1900), (2, "B", 10, 1900), (3, "C", 10, 1900)], CLUBS)
    players = spark.createDataFrame([(10, 1), (11, 2), (12, 3)], "player_id long, club_id long")
    matches = spark.createDataFrame([(100, 1, 2), (101, 2, 3), (102, 3, 1)], "match_id long, home_club_id long, away_club_id long")
    standings = spark.createDataFrame([(1,), (2,), (3,)], "club_id long")
    out = cascade_delete({"clubs": clubs, "players": players, "matches": matches, "standings": standings},
                         "clubs", "club_id", spark.createDataFrame([(1,)], "club_id long"),
                         {"players": ["club_id"], "matches": ["home_club_id", "away_club_id"],
                          "standings": ["club_id"]})
    counts = {r["table_name"]: r["row_count"] for r in table_counts(out).collect()}
    assert counts == {"clubs": 2, "players": 2, "matches": 1, "standings": 2, "total": 7}
