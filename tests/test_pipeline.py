import glob
import json

import pytest
from pyspark.sql import functions as F

from terrace.operators.quality import QualityGateError
from terrace.plans import views
from terrace.plans.pipeline import run_pipeline
from terrace.sources.warehouse import Warehouse
from tests import fixtures as FX


def test_end_to_end_pass_golden_and_idempotent(spark, scratch):
    raw = FX.raw_batches(spark)
    wh = Warehouse(spark, f"{scratch}/gold")
    rep = run_pipeline(spark, raw, scratch, batch_id="b1", warehouse=wh, silver_formats=("parquet", "csv"))
    assert rep["quality_status"] == "PASS"
    assert rep["ingestion"]["total_records"] == 55 and rep["transformation"]["total_processed_rows"] == 55
    assert rep["load"]["counts"] == {"clubs": 10, "players": 20, "matches": 15, "standings": 10}
    st = wh.read("standings")
    got = [(r["position"], r["club_id"], r["points"], r["goal_difference"], r["points_per_game"],
            r["win_percentage"], r["form"]) for r in st.orderBy("position").collect()]
    assert got == FX.GOLDEN_TABLE
    top = views.top_scorers(wh.read("players"), wh.read("clubs"), 1).first()
    assert (top["player_id"], top["goals"]) == (111, 27)
    squads = views.club_analytics(wh.read("clubs"), wh.read("players"), wh.read("standings"))
    assert squads.agg(F.sum("squad_size")).first()[0] == 20
    sizes = {r["short_name"]: r["squad_size"] for r in squads.collect()}
    assert sizes["MCI"] == 4 and sizes["BHA"] == 0 and sizes["WHU"] == 0
    lt = views.query_league_table(wh.read("clubs"), wh.read("standings")).collect()
    assert [r["dynamic_rank"] for r in lt] == list(range(1, 11))
    assert (lt[0]["short_name"], lt[0]["points"]) == ("MCI", 13)
    names = {r["player_id"]: (r["name"], r["position"]) for r in wh.read("players").collect()}
    assert names[101] == ("Bukayo Saka", "Forward") and names[102] == ("Martin Ødegaard", "Midfielder")
    diag = {r["check_name"]: r["status"] for r in wh.diagnostics().collect()}
    assert diag and all(v == "PASS" for v in diag.values()), diag
    assert diag["constraint:players:fk_players_club"] == "PASS"
    # idempotency: two more runs keep counts and content
    before = {t: wh.read(t).drop("transformed_at") for t in ("clubs", "players", "matches", "standings")}
    before = {t: spark.createDataFrame(df.collect(), df.schema) for t, df in before.items()}
    for b in ("b2", "b3"):
        run_pipeline(spark, raw, scratch, batch_id=b, warehouse=wh, silver_formats=("parquet",))
    for t, df in before.items():
        now = wh.read(t).drop("transformed_at")
        assert now.columns == df.columns
        assert now.count() == df.count()
        assert now.exceptAll(df).isEmpty() and df.exceptAll(now).isEmpty()
    # in-place mutation: goals of 111 from 27 to 29, row count unchanged
    raw2 = dict(raw, players=raw["players"].withColumn(
        "goals", F.when(F.col("player_id") == 111, F.lit(29)).otherwise(F.col("goals"))))
    run_pipeline(spark, raw2, scratch, batch_id="b4", warehouse=wh, silver_formats=("parquet",))
    p = wh.read("players")
    assert p.count() == 20 and p.where("player_id = 111").first()["goals"] == 29


def test_gate_fail_writes_report_first(spark, scratch):
    raw = FX.raw_batches(spark)
    raw["players"] = raw["players"].withColumn("jersey_number", F.lit(0))  # 20 of 55 rejected
    with pytest.raises(QualityGateError):
        run_pipeline(spark, raw, scratch, batch_id="bad", silver_formats=("parquet",))
    files = glob.glob(f"{scratch}/quality/batch_id=bad/*.json")
    assert files and json.loads(open(files[0]).readline())["status"] == "FAIL"


def test_streaming_incremental_upsert(spark, scratch):
    from terrace.streaming.incremental import start_incremental_load
    landing = f"{scratch}/landing"
    wh = Warehouse(spark, f"{scratch}/gold")
    players = FX.raw_batches(spark)["players"]
    players.where("player_id < 111").coalesce(1).write.json(f"{landing}/part1")
    q = start_incremental_load(spark, f"{landing}/*", "players", wh, quarantine=f"{scratch}/q")
    q.awaitTermination(120)
    assert wh.read("players").count() == 10
    # second file: the rest plus an update of 101 and one invalid row (jersey 0)
    upd = players.where("player_id >= 111").unionByName(
        players.where("player_id = 101").withColumn("goals", F.lit(50))).unionByName(
        players.where("player_id = 102").withColumn("player_id", F.lit(999)).withColumn("jersey_number", F.lit(0)))
    upd.coalesce(1).write.json(f"{landing}/part2")
    q = start_incremental_load(spark, f"{landing}/*", "players", wh, quarantine=f"{scratch}/q")
    q.awaitTermination(120)
    p = wh.read("players")
    assert p.count() == 20 and p.where("player_id = 101").first()["goals"] == 50
    assert spark.read.parquet(f"{scratch}/q/players").count() == 1


def test_idempotency_proof_and_view_verification(spark, scratch):
    from terrace.plans.pipeline import idempotency_proof
    raw = FX.raw_batches(spark)
    wh = Warehouse(spark, f"{scratch}/gold")
    proof = idempotency_proof(spark, raw, scratch, runs=2, warehouse=wh).collect()
    assert all(r["same_as_first_run"] for r in proof)
    assert {(r["run"], r["table_name"]): r["row_count"] for r in proof}[(2, "players")] == 20
    views.create_views(spark, wh.read("clubs"), wh.read("players"), wh.read("standings"))
    checks = views.verify_views(spark).collect()
    assert checks and all(r["status"] == "PASS" for r in checks), [tuple(r) for r in checks]
    views.drop_views(spark)
    assert {r["check_name"]: r["violations"] for r in views.verify_views(spark).collect()}[
        "view_exists:vw_league_table"] == 1
