"""The three analytical views (V1-V3), their ordered queries (V6-V8) and the
temp-view lifecycle (V4, V5).

The functions take DataFrames.  The registered temp views are SQL text over named relations: creating them runs no job,
every query ranks what the tables hold then, by ranges of the order and never in one task.  Over the views of
``Warehouse.create_live_views`` they show each version that is published later (V9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import scalars as S
from terrace.operators.ranking import dense_rank_sql, global_rank, parse_order, row_number_sql, top_k_ranked

LEAGUE_RANK_ORDER = ["-points", "-goal_difference", "-goals_for", "goals_against"]
SCORER_ORDER = ["-goals", "-assists", "appearances", "player_id"]

VIEW_NAMES = ("vw_league_table", "vw_top_scorers", "vw_club_analytics")


LEAGUE_COLUMNS = ("dynamic_rank", "club_id", "club_name", "short_name", "stadium", "primary_color", "played", "won",
                  "drawn", "lost", "goals_for", "goals_against", "goal_difference", "points", "points_per_game",
                  "win_percentage", "form")


def _league_base(clubs: DataFrame, standings: DataFrame) -> DataFrame:
    c = clubs.select("club_id", F.col("name").alias("club_name"), "short_name", "stadium",
                     "primary_color")
    s = standings.select("club_id", "played", "won", "drawn", "lost", "goals_for",
                         "goals_against", "goal_difference", "points", "points_per_game",
                         "win_percentage", "form")
    return s.join(c, "club_id", "inner")


def league_table(clubs: DataFrame, standings: DataFrame, window_rows: int | None = None) -> DataFrame:
    """V1: standings INNER JOIN clubs, DENSE_RANK over the 4 league keys (full ties
    share a rank).  ``window_rows``: a bound on the clubs allows the plain window."""
    ranked = global_rank(_league_base(clubs, standings), LEAGUE_RANK_ORDER, out="dynamic_rank", kind="dense_rank",
                         window_rows=window_rows)
    return ranked.select(*LEAGUE_COLUMNS)


def _scorers_base(players: DataFrame, clubs: DataFrame) -> DataFrame:
    c = clubs.select("club_id", F.col("name").alias("club_name"),
                     F.col("short_name").alias("club_short_name"),
                     F.col("primary_color").alias("club_color"))
    p = players.where(F.col("goals") > 0).select(
        "player_id", "club_id", F.col("name").alias("player_name"), "position", "nationality",
        "jersey_number", "appearances", "goals", "assists", "goal_contributions", "goals_per_game")
    return p.join(c, "club_id", "inner")


SCORER_COLUMNS = ("scorer_rank", "player_id", "player_name", "club_name", "club_short_name",
                  "club_color", "position", "nationality", "jersey_number", "appearances",
                  "goals", "assists", "goal_contributions", "goals_per_game")


def top_scorers_view(players: DataFrame, clubs: DataFrame, window_rows: int | None = None) -> DataFrame:
    """V2 over all scorers: ROW_NUMBER by goals DESC, assists DESC, appearances ASC,
    player_id ASC (the last key makes full ties deterministic)."""
    # the order ends with player_id, the primary key; the numbering checks that it does not repeat
    ranked = global_rank(_scorers_base(players, clubs), SCORER_ORDER, out="scorer_rank",
                         kind="row_number", window_rows=window_rows, keys_unique=True)
    return ranked.select(*SCORER_COLUMNS)


def top_scorers(players: DataFrame, clubs: DataFrame, limit: int = 10) -> DataFrame:
    """The first ``limit`` rows of V2 (1 <= limit <= 50), ranked top-k."""
    if not 1 <= int(limit) <= 50:
        raise ValueError("limit must be between 1 and 50")
    ranked = top_k_ranked(_scorers_base(players, clubs), SCORER_ORDER, int(limit), out="scorer_rank")
    return ranked.select(*SCORER_COLUMNS)


def _squad_aggregate(players: DataFrame) -> DataFrame:
    """Players pre-aggregated per club before any join (J3 at scale)."""
    return players.groupBy("club_id").agg(
        F.count_distinct("player_id").alias("squad_size"),
        F.sum("goals").alias("_goals"),
        F.sum("assists").alias("_assists"),
        F.sum("appearances").alias("_apps"),
        F.count("appearances").alias("_napps"))


def club_analytics(clubs: DataFrame, players: DataFrame, standings: DataFrame) -> DataFrame:
    """V3: clubs LEFT JOIN players LEFT JOIN standings, grouped per club.

    Players are aggregated per club first, so the joins see one row per club and
    the result equals the reference's join-then-group as long as standings hold
    one row per club (UNIQUE).  AVG is SQL half-up rounding to 1 decimal (R2).
    """
    sq = _squad_aggregate(players)
    st = standings.select("club_id", "position", "points", "goal_difference", "form")
    out = clubs.join(sq, "club_id", "left").join(st, "club_id", "left")
    return out.select(
        "club_id", F.col("name").alias("club_name"), "short_name", "stadium", "capacity", "city",
        "primary_color",
        F.coalesce(F.col("squad_size"), F.lit(0)).cast("long").alias("squad_size"),
        F.coalesce(F.col("_goals"), F.lit(0)).cast("long").alias("squad_goals"),
        F.coalesce(F.col("_assists"), F.lit(0)).cast("long").alias("squad_assists"),
        S.avg_half_up("_apps", "_napps", 1).alias("avg_player_appearances"),
        F.coalesce(F.col("position"), F.lit(0)).cast("long").alias("league_position"),
        F.coalesce(F.col("points"), F.lit(0)).cast("long").alias("points"),
        F.coalesce(F.col("goal_difference"), F.lit(0)).cast("long").alias("goal_difference"),
        "form")


def club_squad_only(clubs: DataFrame, players: DataFrame) -> DataFrame:
    """The dashboard variant, clubs LEFT JOIN players only."""
    sq = _squad_aggregate(players)
    return clubs.join(sq, "club_id", "left").select(
        "club_id", F.col("name").alias("club_name"), "capacity",
        F.coalesce(F.col("squad_size"), F.lit(0)).cast("long").alias("squad_size"),
        F.coalesce(F.col("_goals"), F.lit(0)).cast("long").alias("squad_goals"),
        F.coalesce(F.col("_assists"), F.lit(0)).cast("long").alias("squad_assists"),
        S.avg_half_up("_apps", "_napps", 1).alias("avg_player_appearances"))


# V6-V8: ordered queries over the views
def query_league_table(clubs, standings, window_rows: int | None = None) -> DataFrame:
    return league_table(clubs, standings, window_rows).orderBy("dynamic_rank", "club_id")


def query_top_scorers(players, clubs, limit: int = 10) -> DataFrame:
    return top_scorers(players, clubs, limit).orderBy("scorer_rank")


def query_club_analytics(clubs, players, standings) -> DataFrame:
    return club_analytics(clubs, players, standings).orderBy("league_position", "club_id")


_SCORER_SQL_ORDER = ", ".join(f"{c} {'ASC' if asc else 'DESC'}" for c, asc in parse_order(SCORER_ORDER))


def query_top_scorers_sql(spark: SparkSession, limit: int = 10) -> DataFrame:
    """V7 through the SQL API with a bound parameter (F10): the first ``limit`` of the unranked view
    (per-partition top-k), numbered afterwards, so that only ``limit`` rows meet in one task (X2)."""
    if not 1 <= int(limit) <= 50:
        raise ValueError("limit must be between 1 and 50")
    rest = ", ".join(c for c in SCORER_COLUMNS if c != "scorer_rank")
    return spark.sql(f"""
        SELECT row_number() OVER (ORDER BY {_SCORER_SQL_ORDER}) AS scorer_rank, {rest}
        FROM (SELECT * FROM {SCORERS_VIEW} ORDER BY {_SCORER_SQL_ORDER} LIMIT :limit)
        ORDER BY scorer_rank""", args={"limit": int(limit)})


#: The scorers without a rank, which the bounded query reads.
SCORERS_VIEW = "vw_scorers_unranked"


#: What the views read where tables are given as DataFrames.
SOURCES = {"clubs": "vw_source_clubs", "players": "vw_source_players", "standings": "vw_source_standings"}


def _league_rows_sql(clubs: str, standings: str) -> str:
    return f"""
        SELECT s.club_id, c.name AS club_name, c.short_name, c.stadium, c.primary_color, s.played, s.won, s.drawn, s.lost,
               s.goals_for, s.goals_against, s.goal_difference, s.points, s.points_per_game, s.win_percentage, s.form
        FROM {standings} AS s JOIN {clubs} AS c ON s.club_id = c.club_id"""


def _scorer_rows_sql(players: str, clubs: str) -> str:
    return f"""
        SELECT p.player_id, p.name AS player_name, c.name AS club_name, c.short_name AS club_short_name,
               c.primary_color AS club_color, p.position, p.nationality, p.jersey_number, p.appearances, p.goals, p.assists,
               p.goal_contributions, p.goals_per_game
        FROM {players} AS p JOIN {clubs} AS c ON p.club_id = c.club_id WHERE p.goals > 0"""


def _analytics_sql(clubs: str, players: str, standings: str) -> str:
    """Squads are aggregated before they are joined; the average is rounded half up to one decimal in exact integers."""
    return f"""
        SELECT c.club_id, c.name AS club_name, c.short_name, c.stadium, c.capacity, c.city, c.primary_color,
               coalesce(q.squad_size, 0L) AS squad_size, coalesce(q.goals, 0L) AS squad_goals,
               coalesce(q.assists, 0L) AS squad_assists,
               CASE WHEN q.n > 0 THEN CAST((20 * q.apps + q.n) DIV (2 * q.n) AS DOUBLE) / 10 END AS avg_player_appearances,
               CAST(coalesce(s.position, 0) AS BIGINT) AS league_position, CAST(coalesce(s.points, 0) AS BIGINT) AS points,
               CAST(coalesce(s.goal_difference, 0) AS BIGINT) AS goal_difference, s.form
        FROM {clubs} AS c
        LEFT JOIN (SELECT club_id, count(DISTINCT player_id) AS squad_size, sum(goals) AS goals, sum(assists) AS assists,
                          sum(appearances) AS apps, count(appearances) AS n FROM {players} GROUP BY club_id) AS q ON q.club_id = c.club_id
        LEFT JOIN {standings} AS s ON s.club_id = c.club_id"""


def create_views(spark: SparkSession, clubs, players, standings) -> list[str]:
    """V4: create or replace the three views as temp views (replace semantics).  Nothing runs here.

    Tables are DataFrames or names of relations; over live relations the views are live.
    """
    given = {"clubs": clubs, "players": players, "standings": standings}
    for name, table in given.items():
        if not isinstance(table, str):
            table.createOrReplaceTempView(SOURCES[name])
            given[name] = SOURCES[name]
    rest = [c for c in SCORER_COLUMNS if c != "scorer_rank"]
    scorers = _scorer_rows_sql(given["players"], given["clubs"])
    texts = {
        "vw_league_table": f"SELECT {', '.join(LEAGUE_COLUMNS)} FROM (" + dense_rank_sql(
            _league_rows_sql(given["clubs"], given["standings"]), [c for c in LEAGUE_COLUMNS if c != "dynamic_rank"],
            LEAGUE_RANK_ORDER, "dynamic_rank") + ")",
        SCORERS_VIEW: scorers,
        "vw_top_scorers": f"SELECT {', '.join(SCORER_COLUMNS)} FROM (" + row_number_sql(scorers, rest, SCORER_ORDER, "scorer_rank") + ")",
        "vw_club_analytics": _analytics_sql(given["clubs"], given["players"], given["standings"]),
    }
    for name, text in texts.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {text}")
    return list(VIEW_NAMES)


def create_live_views(spark: SparkSession, warehouse, prefix: str = "live_") -> list[str]:
    """V9: the three views over the warehouse's live tables: made once, they follow every publish."""
    warehouse.create_live_views(prefix)
    return create_views(spark, f"{prefix}clubs", f"{prefix}players", f"{prefix}standings")


def drop_views(spark: SparkSession) -> None:
    """V5: idempotent drop."""
    for v in (*VIEW_NAMES, SCORERS_VIEW, *SOURCES.values()):
        spark.catalog.dropTempView(v)


# Columns each view must expose.
REQUIRED_VIEW_COLUMNS = {
    "vw_league_table": ["dynamic_rank", "club_name", "short_name", "played", "won", "drawn", "lost", "goals_for",
                        "goals_against", "goal_difference", "points"],
    "vw_top_scorers": ["scorer_rank", "player_name", "club_name", "club_short_name", "appearances", "goals", "assists",
                       "goal_contributions"],
    "vw_club_analytics": ["club_id", "club_name", "short_name", "squad_size", "squad_goals", "squad_assists",
                          "avg_player_appearances", "league_position", "points", "goal_difference"],
}


def verify_views(spark: SparkSession) -> DataFrame:
    """Diagnostics over the registered views (E1, E2, W7, W8): one row per check
    with its violation count and PASS/FAIL."""
    from functools import reduce
    from terrace.operators.integrity import missing_tables, order_violations, rank_sequence
    missing = missing_tables(spark, list(VIEW_NAMES))
    rows = [spark.createDataFrame([(f"view_exists:{v}", 1 if v in missing else 0)],
                                  "check_name string, violations long") for v in VIEW_NAMES]
    present = {v: spark.table(v) for v in VIEW_NAMES if v not in missing}
    for v, df in present.items():
        gone = [c for c in REQUIRED_VIEW_COLUMNS[v] if c not in df.columns]
        rows.append(spark.createDataFrame([(f"required_columns:{v}", len(gone))],
                                          "check_name string, violations long"))
    if "vw_league_table" in present:
        lt = present["vw_league_table"]
        rows.append(order_violations(lt, "dynamic_rank", "points").agg(
            F.count(F.lit(1)).alias("violations")).select(F.lit("league_points_order").alias("check_name"),
                                                         "violations"))
    if "vw_top_scorers" in present:
        rows.append(rank_sequence(present["vw_top_scorers"], "scorer_rank").select(
            F.lit("scorer_rank_sequence").alias("check_name"), "violations"))
    if "vw_club_analytics" in present:
        ca = present["vw_club_analytics"].where(F.col("league_position") > 0)
        rows.append(order_violations(ca, "league_position", "points").agg(
            F.count(F.lit(1)).alias("violations")).select(F.lit("club_position_order").alias("check_name"),
                                                         "violations"))
    out = reduce(DataFrame.unionByName, rows)
    return out.withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))
