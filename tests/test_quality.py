import pytest
from pyspark.sql import functions as F

from terrace.operators.quality import (QualityGateError, Rule, audit, audit_spec, banner, gate,
                                       quality_report)
from terrace.schemas import RAW_SCHEMAS, league_audit_specs
from terrace.sources.sinks import stamp_record_index


def specs_for(dfs):
    return league_audit_specs({k: v.columns for k, v in dfs.items()})


CLUB = (1, "Test FC", "TST", "Test Arena", 30000, "London", 1900, "#fff", None, None)


def clubs_df(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMAS["clubs"])


def metrics(res):
    return res.metrics.first().asDict()


def test_valid_club(spark):
    d = stamp_record_index(clubs_df(spark, [CLUB]))
    res = audit_spec(d, specs_for({"clubs": d, "players": d, "matches": d, "standings": d})["clubs"])
    m = metrics(res)
    assert (m["source_count"], m["valid_count"], m["rejected_count"], m["missing_fields_count"],
            m["duplicate_count"], m["validation_error_count"]) == (1, 1, 0, 0, 0, 0)


def test_missing_fields(spark):
    # empty name on one record, stadium absent (null) on another
    rows = [(1, "", "A", "S", 100, "C", 1900, None, None, None),
            (2, "B", "B", None, 100, "C", 1900, None, None, None)]
    d = clubs_df(spark, rows)
    res = audit(d, "clubs", "club_id", ["club_id", "name", "stadium"], order=["club_id"])
    m = metrics(res)
    assert m["rejected_count"] == 2 and m["missing_fields_count"] == 2
    errs = sorted(r["error"] for r in res.issues.collect())
    assert errs == ["Missing required field: 'name'", "Missing required field: 'stadium'"]


def test_duplicate_first_wins(spark):
    d = spark.createDataFrame([(0, 101, "a"), (1, 101, "b"), (2, 102, "c")], "seq long, player_id long, name string")
    res = audit(d, "players", "player_id", ["player_id"], order=["seq"])
    m = metrics(res)
    assert (m["valid_count"], m["rejected_count"], m["duplicate_count"]) == (2, 1, 1)
    assert res.rejected.select("name").first()["name"] == "b"
    assert res.issues.first()["error"] == "Duplicate primary key 'player_id'=101"


def test_invalid_first_duplicate_rejects_both(spark):
    d = spark.createDataFrame([(0, 7, -1), (1, 7, 5)], "seq long, k long, goals long")
    res = audit(d, "p", "k", ["k"], [Rule("Goals cannot be negative", F.col("goals") >= 0)], order=["seq"])
    m = metrics(res)
    assert (m["valid_count"], m["rejected_count"], m["duplicate_count"], m["validation_error_count"]) == (0, 2, 1, 1)


def test_null_key_twice_is_missing_not_duplicate(spark):
    d = spark.createDataFrame([(0, None), (1, None)], "seq long, k long")
    m = metrics(audit(d, "x", "k", ["k"], order=["seq"]))
    assert (m["missing_fields_count"], m["duplicate_count"], m["rejected_count"]) == (2, 0, 2)


def test_blank_key_counts_as_duplicate(spark):
    d = spark.createDataFrame([(0, " "), (1, " ")], "seq long, k string")
    m = metrics(audit(d, "x", "k", [], order=["seq"]))
    assert m["duplicate_count"] == 1


def test_identical_copies_keep_one(spark):
    d = spark.createDataFrame([(5, "x")] * 4 + [(6, "y")], "k long, v string")
    m = metrics(audit(d, "x", "k", ["k"], order=["k", "v"]))
    assert (m["valid_count"], m["duplicate_count"]) == (2, 3)


def test_standings_invariant(spark):
    d = spark.createDataFrame([(1, 5, 4, 0, 0, 10, 2, 12)], "club_id long, played long, won long, drawn long, lost long, goals_for long, goals_against long, points long").withColumn("_record_index", F.lit(0).cast("long"))
    spec = league_audit_specs({"clubs": [], "players": [], "matches": [], "standings": d.columns})["standings"]
    m = metrics(audit_spec(d, spec))
    assert m["validation_error_count"] == 1 and m["rejected_count"] == 1


def test_absent_vs_null_field(spark):
    # absent column -> default 0 passes; explicit null -> validator exception
    absent = spark.createDataFrame([(1,)], "player_id long")
    specs = league_audit_specs({"clubs": [], "players": absent.columns, "matches": [], "standings": []})
    rules = [r for r in specs["players"].rules if r.description.startswith("Goals")]
    assert metrics(audit(absent, "p", "player_id", [], rules, order=["player_id"]))["valid_count"] == 1
    explicit = spark.createDataFrame([(1, None)], "player_id long, goals long")
    specs = league_audit_specs({"clubs": [], "players": explicit.columns, "matches": [], "standings": []})
    rules = [r for r in specs["players"].rules if r.description.startswith("Goals")]
    res = audit(explicit, "p", "player_id", [], rules, order=["player_id"])
    assert metrics(res)["rejected_count"] == 1
    assert res.issues.first()["error"].startswith("Validator exception: Goals cannot be negative")


def test_match_rules(spark):
    d = spark.createDataFrame([(1, 1, 2, 2, "1 - 0"), (2, 40, 1, 2, "HT 1-0"), (3, 5, None, None, "2:2")],
                              "match_id long, gameweek long, home_club_id long, away_club_id long, raw_score string")
    spec = league_audit_specs({"clubs": [], "players": [], "matches": d.columns, "standings": []})["matches"]
    res = audit(d, "matches", "match_id", [], spec.rules, order=["match_id"])
    errs = {(r["record_index"]["match_id"], r["error"]) for r in res.issues.collect()}
    assert (1, "Validation failure: Home and away clubs must be distinct") in errs
    assert (2, "Validation failure: Score format must match 'X - Y'") in errs
    assert (2, "Validation failure: Gameweek must be between 1 and 38") in errs
    assert (3, "Validation failure: Home and away clubs must be distinct") in errs


@pytest.mark.parametrize("bad,status", [(0, "PASS"), (9, "WARN"), (10, "FAIL")])
def test_status_edges(spark, bad, status):
    d = spark.createDataFrame([(i, -1 if i < bad else 1) for i in range(100)], "k long, v long")
    res = audit(d, "x", "k", ["k"], [Rule("v positive", F.col("v") > 0)], order=["k"])
    rep = quality_report([res]).first().asDict()
    assert rep["status"] == status and rep["rejected_records"] == bad
    if status == "FAIL":
        with pytest.raises(QualityGateError):
            gate(quality_report([res]))
    else:
        assert gate(quality_report([res]))["status"] == status


def test_pooled_status_small_table_fully_rejected_is_warn(spark):
    big = audit(spark.createDataFrame([(i,) for i in range(100)], "k long"), "big", "k", ["k"], order=["k"])
    small = audit(spark.createDataFrame([(None,)], "k long"), "small", "k", ["k"], order=["k"])
    assert quality_report([big, small]).first()["status"] == "WARN"


def test_banner(spark):
    res = audit(spark.createDataFrame([(1,)], "k long"), "x", "k", ["k"], order=["k"])
    text = banner(quality_report([res]).first().asDict())
    lines = text.splitlines()
    assert len(lines) == 9 and lines[2] == "Source records:       1" and lines[-1].endswith("PASS")


def test_valid_plus_rejected_equals_source(spark):
    d = spark.range(0, 500).select((F.col("id") % 97).alias("k"), (F.col("id") % 5 - 1).alias("v"),
                                   F.col("id").alias("seq"))
    res = audit(d, "x", "k", ["k"], [Rule("v >= 0", F.col("v") >= 0)], order=["seq"])
    assert res.valid.count() + res.rejected.count() == 500


def test_absent_vs_null_per_record_from_raw_json(spark, scratch):
    from terrace.operators.quality import flatten_records
    from terrace.sources.sinks import read_bronze_raw
    path = f"{scratch}/players.json"
    with open(path, "w") as fh:
        fh.write('{"player_id": 1, "club_id": 1, "name": "A", "position": "gk", "jersey_number": 1}\n')
        fh.write('{"player_id": 2, "club_id": 1, "name": "B", "position": "gk", "jersey_number": 2, "goals": null}\n')
        fh.write('{"player_id": 3, "club_id": 1, "name": " ", "position": "gk", "jersey_number": 3, "goals": 4}\n')
    fields = ["player_id", "club_id", "name", "position", "jersey_number", "goals", "assists", "appearances"]
    flat = flatten_records(read_bronze_raw(spark, path), fields)
    spec = league_audit_specs({"clubs": [], "players": flat.columns, "matches": [], "standings": []})["players"]
    res = audit(flat, "players", "player_id", spec.required, spec.rules, order=["player_id"])
    got = {r["player_id"]: r["_rejection_reasons"] for r in res.audited.collect()}
    assert got["1"] == []                       # goals absent -> default 0
    assert got["2"] == ["Validator exception: Goals cannot be negative (null or non-numeric input)"]
    assert got["3"] == ["Missing required field: 'name'"]


def test_an_audit_needs_a_record_order(spark):
    with pytest.raises(ValueError, match="record order"):
        audit(spark.createDataFrame([(1,)], "k long"), "x", "k", ["k"])


def test_first_wins_follows_the_batch_through_bronze(spark, scratch):
    """The first record lies in a small file, the second in a larger one that Spark reads first."""
    from terrace.operators.quality import RECORD_INDEX
    from terrace.sources.sinks import read_bronze, write_bronze
    raw = spark.createDataFrame([(1, "first")], "k long, v string").unionAll(
        spark.createDataFrame([(1, "second")] + [(i, "x" * 500) for i in range(2, 400)], "k long, v string"))
    back = read_bronze(spark, write_bronze(stamp_record_index(raw), scratch, "t", "b1"))
    res = audit(back, "t", "k", ["k"], order=[RECORD_INDEX])
    assert res.valid.where("k = 1").first()["v"] == "first"
    assert [r["v"] for r in res.rejected.collect()] == ["second"]


@pytest.mark.parametrize("persist", [True, False])
def test_equal_rows_and_conflicting_payloads(spark, persist):
    """Counting and per-row outputs agree, with an order that does not tell equal rows apart."""
    rows = [(1, "a", 5)] * 3 + [(1, "b", -1), (2, "a", -1), (2, "b", 5), (3, "c", 1), (None, "z", 1), (None, "z", 1)] + [(4, "q", 1)] * 50
    d = spark.createDataFrame(rows, "k long, v string, n long")
    res = audit(d, "x", "k", [], [Rule("n", F.col("n") > 0)], order=["k", "v", "n"], persist=persist)
    m = metrics(res)
    # key 1: one good first row stays; key 2: its first is bad, its second a duplicate; key 4: 49 duplicates
    assert (m["source_count"], m["duplicate_count"], m["valid_count"]) == (59, 3 + 1 + 49, 1 + 1 + 2 + 1)
    assert res.valid.count() == m["valid_count"] and res.rejected.count() == m["rejected_count"]
    assert sorted(r["v"] for r in res.valid.collect()) == ["a", "c", "q", "z", "z"]


def test_required_fields_of_the_league():
    specs = league_audit_specs({n: [] for n in ("clubs", "players", "matches", "standings")})
    assert specs["clubs"].required == ["club_id", "name", "short_name", "stadium", "capacity", "founded_year"]


def test_column_defaults(spark):
    from terrace.schemas import LEAGUE_TABLES, with_defaults
    d = spark.createDataFrame([(1, None)], "match_id long, status string")
    assert with_defaults(d, LEAGUE_TABLES["matches"]).first()["status"] == "FINISHED"
    d = with_defaults(spark.createDataFrame([(1, 3)], "player_id long, goals long"), LEAGUE_TABLES["players"]).first()
    assert (d["goals"], d["assists"], d["goals_per_game"]) == (3, 0, 0.0)
