"""Counted rows, hot equal rows, bounded child lists, folders of written tables."""

import os

from pyspark.sql import functions as F

from terrace.operators.quality import audit
from terrace.operators.rows import repeat_rows
from terrace.plans.lookups import clubs_with_newest
from terrace.session import discard_tables, materialize, tables_root


def test_repeat_rows_matches_brute_force(spark):
    rows = [("a", 1), ("b", 0), ("c", None), ("d", 25), (None, 7), ("e", 10), ("f", 11), ("d", 3), ("g", -2)]
    df = spark.createDataFrame(rows, "k string, n long")
    got = sorted(((r.k, r.i) for r in repeat_rows(df, "n", "i", block=10).collect()), key=str)
    assert got == sorted([(k, i) for k, n in rows for i in range(1, (n or 0) + 1)], key=str)
    assert repeat_rows(df.where("false"), "n").count() == 0
    assert repeat_rows(df, "n").columns == ["k"]


def test_no_task_makes_all_copies_of_a_row(spark):
    df = spark.createDataFrame([("hot", 400_000), ("cold", 3)], "k string, n long")
    out = repeat_rows(df, "n").groupBy(F.spark_partition_id().alias("p")).count().collect()
    counts = [r["count"] for r in out]
    assert sum(counts) == 400_003 and max(counts) < 200_000, counts
    p = repeat_rows(df, "n")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" in p


def test_audit_with_a_third_of_all_rows_equal(spark):
    base = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"))
    hot = spark.range(10_000).select(F.lit(5).cast("long").alias("k"), F.lit(9).cast("long").alias("v"))
    a = audit(base.unionByName(hot), "t", "k", ["k"], [], order=["k", "v"], persist=False)
    dup = a.audited.where("_is_dup")
    assert a.audited.count() == 30_000 and dup.count() == 10_000
    # the row with the smaller value comes first, so every hot copy is a duplicate
    assert dup.where("v = 9").count() == 10_000
    only = audit(hot, "t", "k", ["k"], [], order=["k", "v"], persist=False)
    assert only.valid.count() == 1 and only.rejected.count() == 9_999


def test_clubs_with_newest_bounds_its_lists(spark):
    clubs = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "club_id long, name string")
    players = spark.createDataFrame([(1, 1), (2, 1), (3, None)], "player_id long, club_id long")
    rows = [(i, 1, 2, 1, 0, f"2024-01-{1 + i % 28:02d} 12:00:00") for i in range(200)] + [(900, 2, 1, 0, 0, None)]
    matches = spark.createDataFrame(rows, "match_id long, home_club_id long, away_club_id long, home_score int, away_score int, match_date string")
    out = clubs_with_newest(clubs, players, matches, newest=4)
    got = {r.club_id: r for r in out.collect()}
    expect = [r[0] for r in sorted(rows, key=lambda r: (r[5] or "", r[0]), reverse=True)[:4]]
    for club in (1, 2):
        assert [m.match_id for m in got[club].matches] == expect and got[club].match_count == 201
        assert [m.place for m in got[club].matches] == [1, 2, 3, 4]
    assert (got[1].squad_count, got[2].squad_count) == (2, 0)
    assert got[3].matches == [] and got[3].match_count == 0
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    none = clubs_with_newest(clubs, players, matches.where("false")).collect()
    assert all(r.matches == [] for r in none)


def test_discard_leaves_the_tables_of_other_applications(spark):
    root = tables_root(spark).removeprefix("file:")
    other = os.path.join(os.path.dirname(root), "app-of-others", "t")
    os.makedirs(other)
    materialize(spark.range(3), "mine")
    assert [f for f in os.listdir(root) if f.startswith("mine-")]
    discard_tables(spark)
    assert not os.path.exists(root) and os.path.isdir(other)
