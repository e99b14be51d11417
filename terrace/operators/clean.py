"""Cleaners for the four entities (P*, T*, Q40-Q46) and the standings step.

Each cleaner is a projection; its hard-fail assertions (the cleaners' second
line of defence) run either inside the plan (``checks="lazy"``: the first
offending row aborts the job with ``raise_error``; no extra pass over the data)
or as one aggregate job up front (``checks="eager"``: a report of every
violated assertion with counts).  ``checks="count"`` returns the counts in place of the rows,
``checks="off"`` skips them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import scalars as S
from terrace.operators.form import club_form, match_sides
from terrace.operators.ranking import global_rank

# Defaults the reference fills in for missing values.
DEFAULT_PRIMARY_COLOR = "#1E293B"
DEFAULT_STATUS = "FINISHED"
NO_FORM = "N/A"
# The cleaner's founded-year floor (the audit and DDL use 1800).
CLEANER_MIN_FOUNDED_YEAR = 1850

LEAGUE_ORDER = ["-points", "-goal_difference", "-goals_for", "goals_against"]


class AssertionViolation(ValueError):
    """A cleaner's hard-fail assertion found offending rows."""


def batch_timestamp() -> str:
    return _dt.datetime.now(_dt.timezone.utc).isoformat()


def require_none(df: DataFrame, checks: dict[str, Column]) -> None:
    """Eager form: one aggregate job counting every violated assertion."""
    if not checks:
        return
    row = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"c{i}")
                   for i, c in enumerate(checks.values())]).first()
    bad = {msg: row[f"c{i}"] for i, msg in enumerate(checks) if row[f"c{i}"]}
    if bad:
        raise AssertionViolation("; ".join(f"{m} ({n} rows)" for m, n in bad.items()))


def assertion_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(assertion, violations): one row for every assertion, from one pass."""
    wide = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"c{i}") for i, c in enumerate(checks.values())])
    rows = F.array(*[F.struct(F.lit(m).alias("assertion"), F.col(f"c{i}").alias("violations")) for i, m in enumerate(checks)])
    return wide.select(F.explode(rows).alias("x")).select("x.*")


def guard(df: DataFrame, checks: dict[str, Column], carrier: str, mode: str = "lazy") -> DataFrame:
    """Attach assertions to ``df``.

    lazy: a filter that is true for good rows and raises for a violating one, so
    the check runs in the same pass that produces the data.  Unlike a rewritten
    column, a filter is never pruned away; the error names the offending row's
    ``carrier`` value.  The always-true nondeterministic conjunct pins the filter
    where it stands: otherwise Catalyst may merge it with upstream filters (or a
    join condition) and evaluate it first, raising on rows the input would have
    dropped.  The price is that later filters are not pushed below it -- use
    ``eager`` (one aggregate job up front) when the input is re-read anyway.
    count: no rows but the assertions' violation counts (see ``assertion_counts``).
    """
    if mode == "off" or not checks:
        return df
    if mode == "count":
        return assertion_counts(df, checks)
    if mode == "eager":
        require_none(df, checks)
        return df
    if mode != "lazy":
        raise ValueError(f"unknown check mode {mode!r}")
    ok = F.lit(True)
    for msg, cond in reversed(list(checks.items())):
        text = F.concat(F.lit(f"{msg}: {carrier}="), F.coalesce(F.col(carrier).cast("string"), F.lit("null")))
        ok = F.when(F.coalesce(cond, F.lit(False)), F.raise_error(text).cast("boolean")).otherwise(ok)
    return df.where(ok & (F.spark_partition_id() >= 0))


def clean_clubs(raw: DataFrame, batch_ts: str | None = None, checks: str = "lazy",
                min_year: int = CLEANER_MIN_FOUNDED_YEAR, max_year: int | None = None) -> DataFrame:
    """P1-P3, T1, T2, Q40, Q41."""
    max_year = max_year or _dt.date.today().year
    df = raw.select(
        S.strict_int("club_id").alias("club_id"),
        S.strip("name").alias("name"),
        F.upper(S.strip("short_name")).alias("short_name"),
        S.strip("stadium").alias("stadium"),
        S.strict_int("capacity").cast("int").alias("capacity"),
        S.strip("city").alias("city"),
        S.strict_int("founded_year").cast("int").alias("founded_year"),
        S.strip(F.coalesce(F.col("primary_color"), F.lit(DEFAULT_PRIMARY_COLOR))).alias("primary_color"),
        F.lit(batch_ts or batch_timestamp()).alias("transformed_at"),
    )
    return guard(df, {
        "invalid stadium capacity": F.col("capacity") <= 0,
        "invalid founded_year": (F.col("founded_year") < min_year) | (F.col("founded_year") > max_year),
    }, "club_id", checks)


def clean_players(raw: DataFrame, batch_ts: str | None = None, checks: str = "lazy",
                  aliases: dict | None = None) -> DataFrame:
    """T1, T5, P2-P5, Q42."""
    df = raw.select(
        S.strict_int("player_id").alias("player_id"),
        S.strict_int("club_id").alias("club_id"),
        S.strip("name").alias("name"),
        S.normalise_position("position", aliases).alias("position"),
        S.strip("nationality").alias("nationality"),
        S.strict_int("jersey_number").cast("int").alias("jersey_number"),
        S.strict_int(F.coalesce(F.col("appearances"), F.lit(0))).cast("int").alias("appearances"),
        S.strict_int(F.coalesce(F.col("goals"), F.lit(0))).cast("int").alias("goals"),
        S.strict_int(F.coalesce(F.col("assists"), F.lit(0))).cast("int").alias("assists"),
    )
    df = df.select(
        "player_id", "club_id", "name", "position", "nationality", "jersey_number",
        "appearances", "goals", "assists",
        (F.col("goals") + F.col("assists")).alias("goal_contributions"),
        F.when(F.col("appearances") > 0, S.ratio("goals", "appearances", 2))
         .otherwise(F.lit(0.0)).alias("goals_per_game"),
        F.lit(batch_ts or batch_timestamp()).alias("transformed_at"),
    )
    return guard(df, {f"negative values in player column {c}": F.col(c) < 0
                      for c in ("goals", "assists", "appearances", "jersey_number")},
                 "player_id", checks)


def clean_matches(raw: DataFrame, batch_ts: str | None = None, checks: str = "lazy") -> DataFrame:
    """T7, T9, P6, P7, P2, P3, Q43, Q46.  ``match_date`` becomes 'yyyy-MM-dd HH:mm:ss'."""
    home, away = S.parse_score("raw_score")
    md = F.col("match_date")
    ts = md if dict(raw.dtypes)["match_date"].startswith("timestamp") else S.parse_timestamp(md)
    df = raw.select(
        S.strict_int("match_id").alias("match_id"),
        S.strict_int("gameweek").cast("int").alias("gameweek"),
        S.strict_int("home_club_id").alias("home_club_id"),
        S.strict_int("away_club_id").alias("away_club_id"),
        S.format_ts(ts).alias("match_date"),
        home.alias("home_score"), away.alias("away_score"),
        F.upper(S.strip(F.coalesce(F.col("status"), F.lit(DEFAULT_STATUS)))).alias("status"),
        S.score_is_parseable("raw_score").alias("_parseable"),
    )
    df = df.select(
        "match_id", "gameweek", "home_club_id", "away_club_id", "match_date",
        "home_score", "away_score",
        (F.col("home_score") + F.col("away_score")).alias("total_goals"),
        S.match_result("home_score", "away_score").alias("result"),
        "status", "_parseable",
        F.lit(batch_ts or batch_timestamp()).alias("transformed_at"),
    )
    df = guard(df, {
        "home club equals away club": F.col("home_club_id") == F.col("away_club_id"),
        "unable to parse score": ~F.col("_parseable"),
    }, "match_id", checks)
    return df.drop("_parseable")


def standings_from_matches(matches: DataFrame) -> DataFrame:
    """Raw standings (club_id, played, won, drawn, lost, goals_for, goals_against,
    points) aggregated from both sides of every match.  Partial aggregation runs
    before the shuffle, so a club with a huge share of matches is not a hot task."""
    sides = matches.select("match_id", "home_club_id", "away_club_id", "home_score", "away_score",
                           "match_date")
    s = match_sides(sides)
    agg = s.groupBy("club_id").agg(
        F.count(F.lit(1)).alias("played"),
        F.count_if(F.col("outcome") == "W").alias("won"),
        F.count_if(F.col("outcome") == "D").alias("drawn"),
        F.count_if(F.col("outcome") == "L").alias("lost"),
        F.sum("goals_for").alias("goals_for"),
        F.sum("goals_against").alias("goals_against"),
    )
    return agg.withColumn("points", F.col("won") * 3 + F.col("drawn"))


def clean_standings(raw: DataFrame, matches: DataFrame | None = None, batch_ts: str | None = None,
                    checks: str = "lazy", form_n: int = 5, window_rows: int | None = None) -> DataFrame:
    """P2, P8-P10, Q44, Q45, W3 (form) and W4 (position: row number after the
    4-key league sort, ties broken by club_id; ``window_rows`` as in ``global_rank``)."""
    cols = ["club_id", "played", "won", "drawn", "lost", "goals_for", "goals_against", "points"]
    df = raw.select(*[S.strict_int(c).alias(c) for c in cols])
    df = guard(df, {
        "inconsistent games played": F.col("played") != F.col("won") + F.col("drawn") + F.col("lost"),
        "inconsistent points": F.col("points") != F.col("won") * 3 + F.col("drawn"),
    }, "club_id", checks)
    if checks == "count":
        return df
    df = df.select(
        *cols,
        (F.col("goals_for") - F.col("goals_against")).alias("goal_difference"),
        S.ratio("points", "played", 2).alias("points_per_game"),
        S.ratio("won", "played", 1, scale=100.0).alias("win_percentage"),
    )
    if matches is not None:
        form = club_form(matches, n=form_n)
        df = df.join(form, "club_id", "left")
        df = df.withColumn("form", F.coalesce(F.col("form"), F.lit(NO_FORM)))
    else:
        df = df.withColumn("form", F.lit(NO_FORM))
    df = global_rank(df, LEAGUE_ORDER + ["club_id"], out="position", kind="row_number",
                     window_rows=window_rows, keys_unique=True)
    return df.select(
        F.col("position").cast("int").alias("position"), "club_id", "played", "won", "drawn", "lost",
        "goals_for", "goals_against", "goal_difference", "points", "points_per_game",
        "win_percentage", "form", F.lit(batch_ts or batch_timestamp()).alias("transformed_at"))
