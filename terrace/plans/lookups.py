"""Parameterised serving queries (L1-L15, F*) as DataFrame functions.

Each returns a lazy DataFrame; "not found" is an empty result or, for the
point lookups, a typed error raised by ``first_or_raise``.  Optional
predicates are folded with AND (F7) and pushed into the scans by Catalyst.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions import scalars as S
from terrace.plans import views


class NotFound(LookupError):
    pass


def _and_all(preds: list[Column | None]) -> Column | None:
    preds = [p for p in preds if p is not None]
    return reduce(lambda a, b: a & b, preds) if preds else None


def _where(df: DataFrame, preds: list[Column | None]) -> DataFrame:
    p = _and_all(preds)
    return df if p is None else df.where(p)


def _check_range(name: str, value: int, lo: int, hi: int) -> int:
    """out-of-range parameters are rejected before planning."""
    if value is None or not lo <= int(value) <= hi:
        raise ValueError(f"{name} must be between {lo} and {hi}")
    return int(value)


def ilike_contains(c, text: str) -> Column:
    """case-insensitive substring; the user's % and _ stay wildcards."""
    return S.col_of(c).ilike(f"%{text}%")


def contains_ci(c, text: str) -> Column:
    """literal case-insensitive containment (no wildcards)."""
    return F.lower(S.col_of(c)).contains(text.lower())


def first_or_raise(df: DataFrame, what: str) -> dict:
    """F3 for a caller that needs the row: one row or NotFound."""
    row = df.limit(1).collect()
    if not row:
        raise NotFound(f"{what} not found")
    return row[0].asDict(recursive=True)


# L1
def clubs(clubs_df: DataFrame, city: str | None = None) -> DataFrame:
    """Clubs, optionally with city ILIKE %city% (empty string = no filter), by name."""
    return _where(clubs_df, [ilike_contains("city", city) if city else None]).orderBy("name", "club_id")


# L2
def club_detail(clubs_df: DataFrame, players: DataFrame, matches: DataFrame, standings: DataFrame,
                club_id: int) -> dict[str, DataFrame]:
    """J6 without nesting an unbounded child list into one row: the profile (one
    row with squad_count and the standing), the squad and the club's matches
    (newest first) are separate DataFrames over the same filter."""
    prof = clubs_df.where(F.col("club_id") == club_id)
    squad = players.where(F.col("club_id") == club_id)
    cnt = squad.groupBy("club_id").agg(F.count(F.lit(1)).alias("squad_count"))
    st = standings.where(F.col("club_id") == club_id).select(
        "club_id", F.struct(*[c for c in standings.columns if c != "club_id"]).alias("standing"))
    profile = prof.join(cnt, "club_id", "left").join(st, "club_id", "left") \
        .withColumn("squad_count", F.coalesce(F.col("squad_count"), F.lit(0)).cast("long"))
    club_matches = matches.where((F.col("home_club_id") == club_id) | (F.col("away_club_id") == club_id)) \
        .orderBy(F.col("match_date").desc(), F.col("match_id").desc())
    return {"profile": profile, "squad": squad.orderBy("player_id"), "matches": club_matches}


def clubs_with_newest(clubs_df: DataFrame, players: DataFrame, matches: DataFrame, newest: int = 5) -> DataFrame:
    """J6 nested with a bound: every club with its squad_count, match_count and ``matches``, the array of its newest
    ``newest`` matches (match_date, match_id descending; empty without any).

    A parent of any size is no problem: the counts are partial aggregates, and of the matches every map task
    sends at most ``newest`` rows per club (WindowGroupLimit), so no list is longer than that.  A null date comes last.
    """
    from terrace.operators.form import match_sides
    sides = match_sides(matches.select("match_id", "home_club_id", "away_club_id", "home_score", "away_score", "match_date"))
    order = Window.partitionBy("club_id").orderBy(F.col("match_date").desc_nulls_last(), F.col("match_id").desc())
    top = sides.withColumn("place", F.row_number().over(order)).where(F.col("place") <= _check_range("newest", newest, 1, 100))
    child = F.struct("place", *[c for c in sides.columns if c != "club_id"])
    lists = top.groupBy("club_id").agg(F.sort_array(F.collect_list(child)).alias("matches"))
    counts = sides.groupBy("club_id").agg(F.count(F.lit(1)).alias("match_count"))
    squad = players.groupBy("club_id").agg(F.count(F.lit(1)).alias("squad_count"))
    empty = F.array().cast(lists.schema["matches"].dataType)
    zero = F.lit(0).cast("long")
    return (clubs_df.join(squad, "club_id", "left").join(counts, "club_id", "left").join(lists, "club_id", "left")
            .select(*clubs_df.columns, F.coalesce("squad_count", zero).alias("squad_count"),
                    F.coalesce("match_count", zero).alias("match_count"), F.coalesce("matches", empty).alias("matches")))


def club_detail_counts(clubs_df: DataFrame, players: DataFrame, matches: DataFrame,
                       standings: DataFrame) -> DataFrame:
    """L2 flattened for every club: squad_count, match_count, has_standing, and
    the date of the newest match.  Both children are aggregated per club before
    the joins (matches through the side unpivot, no OR join)."""
    from terrace.operators.form import match_sides
    sq = players.groupBy("club_id").agg(F.count(F.lit(1)).alias("squad_count"))
    ms = match_sides(matches.select("match_id", "home_club_id", "away_club_id", "home_score",
                                    "away_score", "match_date")) \
        .groupBy("club_id").agg(F.count(F.lit(1)).alias("match_count"),
                                # a timestamp, not its text: text has no place in a hash aggregate
                                F.max(F.to_timestamp("match_date")).alias("_latest")) \
        .withColumn("latest_match_date", S.format_ts(F.col("_latest")))
    st = standings.select("club_id", F.lit(True).alias("has_standing"), "points")
    return clubs_df.select("club_id", F.col("name").alias("club_name")) \
        .join(sq, "club_id", "left").join(ms, "club_id", "left").join(st, "club_id", "left") \
        .select("club_id", "club_name",
                F.coalesce("squad_count", F.lit(0)).cast("long").alias("squad_count"),
                F.coalesce("match_count", F.lit(0)).cast("long").alias("match_count"),
                "latest_match_date",
                F.coalesce("has_standing", F.lit(False)).alias("has_standing"),
                F.col("points").cast("long").alias("points"))


def _with_club_name(players: DataFrame, clubs_df: DataFrame) -> DataFrame:
    """N:1 lookup of the parent's name, one left join (no N+1)."""
    return players.join(clubs_df.select("club_id", F.col("name").alias("club_name")), "club_id", "left")


# L3
def players(players_df: DataFrame, clubs_df: DataFrame, club_id: int | None = None,
            position: str | None = None, search: str | None = None, limit: int = 50) -> DataFrame:
    """Filters folded with AND, ordered by goals DESC, assists DESC (player_id breaks
    ties), top ``limit`` (1..100)."""
    limit = _check_range("limit", limit, 1, 100)
    p = _where(players_df, [F.col("club_id") == club_id if club_id is not None else None,
                            ilike_contains("position", position) if position else None,
                            ilike_contains("name", search) if search else None])
    order = [F.col("goals").desc(), F.col("assists").desc(), F.col("player_id").asc()]
    top = p.orderBy(*order).limit(limit)
    # a join does not keep order: sort the (at most ``limit``) joined rows again
    return _with_club_name(top, clubs_df).orderBy(*order)


# L4
def player_detail(players_df: DataFrame, clubs_df: DataFrame, player_id: int) -> DataFrame:
    return _with_club_name(players_df.where(F.col("player_id") == player_id), clubs_df)


# L5
def matches(matches_df: DataFrame, clubs_df: DataFrame, gameweek: int | None = None,
            club_id: int | None = None) -> DataFrame:
    """Filter by gameweek and/or participation (home OR away for one id), both
    club names by two aliased left joins (J5), score label (P11), ordered by
    gameweek, date, match_id."""
    m = _where(matches_df, [F.col("gameweek") == gameweek if gameweek is not None else None,
                            ((F.col("home_club_id") == club_id) | (F.col("away_club_id") == club_id))
                            if club_id is not None else None])
    names = clubs_df.select("club_id", "name")
    home = names.select(F.col("club_id").alias("home_club_id"), F.col("name").alias("home_club_name"))
    away = names.select(F.col("club_id").alias("away_club_id"), F.col("name").alias("away_club_name"))
    return (m.join(home, "home_club_id", "left").join(away, "away_club_id", "left")
            .withColumn("score", S.score_label("home_score", "away_score"))
            .orderBy("gameweek", "match_date", "match_id"))


# L6-L8
def standings(clubs_df, standings_df) -> DataFrame:
    return views.query_league_table(clubs_df, standings_df)


def top_scorers(players_df, clubs_df, limit: int = 10) -> DataFrame:
    return views.query_top_scorers(players_df, clubs_df, _check_range("limit", limit, 1, 50))


def club_summary(clubs_df, players_df, standings_df) -> DataFrame:
    return views.query_club_analytics(clubs_df, players_df, standings_df)


# Dashboard-side filters
def club_search(clubs_df: DataFrame, q: str = "") -> DataFrame:
    """name OR city contains q (case-insensitive, literal)."""
    return clubs_df.where(contains_ci("name", q) | contains_ci("city", q)) if q else clubs_df


def player_search(players_df: DataFrame, q: str = "", position: str | None = None,
                  club_id: int | None = None) -> DataFrame:
    """F8: name contains q AND position equals (exact here) AND club equals."""
    return _where(players_df, [contains_ci("name", q) if q else None,
                               F.col("position") == position if position else None,
                               F.col("club_id") == club_id if club_id is not None else None])


def gameweek_filter(matches_df: DataFrame, gameweek: int | None = None) -> DataFrame:
    return matches_df if gameweek is None else matches_df.where(F.col("gameweek") == gameweek)


def club_options(clubs_df: DataFrame) -> DataFrame:
    """(club_id, name) ordered by name."""
    return clubs_df.select("club_id", "name").orderBy("name", "club_id")


# L15
def health(spark, tables: dict[str, DataFrame]) -> DataFrame:
    """Each gold table readable?  One cheap limit(1) probe per table."""
    rows = []
    for name, df in tables.items():
        try:
            df.limit(1).collect()
            ok = True
        except (PySparkException, Py4JJavaError):  # the probe reports what Spark cannot read
            ok = False
        rows.append((name, ok))
    return spark.createDataFrame(rows, "table_name string, readable boolean")
