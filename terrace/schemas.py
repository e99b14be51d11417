"""Entity schemas, audit specs (Q12, Q20-Q30) and table constraints.

The football schema is configuration: operators take DataFrames and column
names, and these specs are just one instance of them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions import scalars as S
from terrace.operators.quality import RECORD_INDEX, AuditSpec, Rule

L, I, D, STR = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


RAW_SCHEMAS = {
    "clubs": _schema(("club_id", L), ("name", STR), ("short_name", STR), ("stadium", STR),
                     ("capacity", L), ("city", STR), ("founded_year", L), ("primary_color", STR),
                     ("_ingested_at", STR), ("_source", STR)),
    "players": _schema(("player_id", L), ("club_id", L), ("name", STR), ("position", STR),
                       ("nationality", STR), ("jersey_number", L), ("goals", L), ("assists", L),
                       ("appearances", L), ("_ingested_at", STR), ("_source", STR)),
    "matches": _schema(("match_id", L), ("gameweek", L), ("home_club_id", L), ("away_club_id", L),
                       ("match_date", STR), ("raw_score", STR), ("status", STR),
                       ("_ingested_at", STR), ("_source", STR)),
    "standings": _schema(("club_id", L), ("played", L), ("won", L), ("drawn", L), ("lost", L),
                         ("goals_for", L), ("goals_against", L), ("points", L),
                         ("_ingested_at", STR), ("_source", STR)),
}

#: Bronze batches: the raw columns and the place of the record in its batch.
BRONZE_SCHEMAS = {n: T.StructType(s.fields + [T.StructField(RECORD_INDEX, L)]) for n, s in RAW_SCHEMAS.items()}

CLEAN_COLUMNS = {
    "clubs": ["club_id", "name", "short_name", "stadium", "capacity", "city", "founded_year",
              "primary_color", "transformed_at"],
    "players": ["player_id", "club_id", "name", "position", "nationality", "jersey_number",
                "appearances", "goals", "assists", "goal_contributions", "goals_per_game",
                "transformed_at"],
    "matches": ["match_id", "gameweek", "home_club_id", "away_club_id", "match_date", "home_score",
                "away_score", "total_goals", "result", "status", "transformed_at"],
    "standings": ["position", "club_id", "played", "won", "drawn", "lost", "goals_for",
                  "goals_against", "goal_difference", "points", "points_per_game",
                  "win_percentage", "form", "transformed_at"],
}


def _num(columns, c) -> Column:
    """T14 on a field, or the default 0 when the field is absent: absent from the
    whole batch, or -- for raw records flattened with ``_has_<field>`` flags --
    absent from this record.  An explicit null yields null (the exception branch)."""
    if c not in columns:
        return F.lit(0).cast("long")
    if f"_has_{c}" in columns:
        return F.when(F.col(f"_has_{c}"), S.lenient_int(c)).otherwise(F.lit(0).cast("long"))
    return S.lenient_int(c)


# The rule descriptions below (Q20-Q30) are the reference's
# messages, which appear verbatim in the issue log.


def club_rules(columns) -> list[Rule]:
    return [
        Rule("Stadium capacity must be greater than 0", _num(columns, "capacity") > 0),
        Rule("Founded year must be 1800 or later", _num(columns, "founded_year") >= 1800),
    ]


def player_rules(columns) -> list[Rule]:
    return [
        Rule("Goals cannot be negative", _num(columns, "goals") >= 0),
        Rule("Assists cannot be negative", _num(columns, "assists") >= 0),
        Rule("Appearances cannot be negative", _num(columns, "appearances") >= 0),
        Rule("Jersey number must be between 1 and 99", _num(columns, "jersey_number").between(1, 99)),
    ]


def match_rules(columns) -> list[Rule]:
    h = F.col("home_club_id") if "home_club_id" in columns else F.lit(None)
    a = F.col("away_club_id") if "away_club_id" in columns else F.lit(None)
    score = F.col("raw_score") if "raw_score" in columns else F.lit("")
    if "_has_home_club_id" in columns:
        h = F.when(F.col("_has_home_club_id"), h)
    if "_has_away_club_id" in columns:
        a = F.when(F.col("_has_away_club_id"), a)
    return [
        Rule("Home and away clubs must be distinct", ~h.eqNullSafe(a)),
        Rule("Score format must match 'X - Y'", S.score_format_ok(score)),
        Rule("Gameweek must be between 1 and 38", _num(columns, "gameweek").between(1, 38)),
    ]


def standings_rules(columns) -> list[Rule]:
    n = lambda c: _num(columns, c)
    return [
        Rule("Games played invariant: played == won + drawn + lost",
             n("played") == n("won") + n("drawn") + n("lost")),
        Rule("Points invariant: points == (won * 3) + drawn",
             n("points") == n("won") * 3 + n("drawn")),
    ]


def league_audit_specs(columns_by_dataset: dict[str, list[str]]) -> dict[str, AuditSpec]:
    """Q12: key and required fields per dataset (fixed values); records come in the order of the index that
    ingestion stamped (W6)."""
    cols = columns_by_dataset
    order = [RECORD_INDEX]
    return {
        "clubs": AuditSpec("clubs", "club_id",
                           ["club_id", "name", "short_name", "stadium", "capacity", "founded_year"],
                           club_rules(cols["clubs"]), order),
        "players": AuditSpec("players", "player_id",
                             ["player_id", "club_id", "name", "position", "jersey_number"],
                             player_rules(cols["players"]), order),
        "matches": AuditSpec("matches", "match_id",
                             ["match_id", "gameweek", "home_club_id", "away_club_id", "raw_score"],
                             match_rules(cols["matches"]), order),
        "standings": AuditSpec("standings", "club_id",
                               ["club_id", "played", "won", "drawn", "lost", "goals_for",
                                "goals_against", "points"],
                               standings_rules(cols["standings"]), order),
    }


@dataclass
class ForeignKey:
    columns: list[str]
    parent: str
    parent_columns: list[str]
    name: str = ""


@dataclass
class TableSpec:
    """Declarative constraints Spark's file tables do not enforce."""
    name: str
    primary_key: list[str]
    unique: list[list[str]] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    checks: dict[str, str] = field(default_factory=dict)  # name -> SQL boolean expression
    foreign_keys: list[ForeignKey] = field(default_factory=list)
    defaults: dict[str, object] = field(default_factory=dict)  # applied by ``with_defaults`` (I15)


def with_defaults(df, spec: TableSpec):
    """The declared defaults where the column is absent from ``df`` or null."""
    for column, value in spec.defaults.items():
        c = F.col(column) if column in df.columns else F.lit(None)
        df = df.withColumn(column, F.coalesce(c, F.lit(value)))
    return df


LEAGUE_TABLES = {
    "clubs": TableSpec(
        "clubs", ["club_id"], unique=[["name"]],
        not_null=["club_id", "name", "short_name", "stadium", "capacity", "city", "founded_year",
                  "primary_color", "transformed_at"],
        checks={"check_capacity_positive": "capacity > 0",
                "check_founded_year": "founded_year >= 1800"},
        defaults={"primary_color": "#1E293B"}),
    "players": TableSpec(
        "players", ["player_id"],
        not_null=["player_id", "club_id", "name", "position", "nationality", "jersey_number",
                  "appearances", "goals", "assists", "goal_contributions", "goals_per_game",
                  "transformed_at"],
        checks={"check_appearances_non_negative": "appearances >= 0",
                "check_goals_non_negative": "goals >= 0",
                "check_assists_non_negative": "assists >= 0"},
        foreign_keys=[ForeignKey(["club_id"], "clubs", ["club_id"], "fk_players_club")],
        defaults={"appearances": 0, "goals": 0, "assists": 0, "goal_contributions": 0,
                  "goals_per_game": 0.0}),
    "matches": TableSpec(
        "matches", ["match_id"],
        not_null=["match_id", "gameweek", "home_club_id", "away_club_id", "match_date",
                  "home_score", "away_score", "total_goals", "result", "status", "transformed_at"],
        checks={"check_home_away_distinct": "home_club_id <> away_club_id",
                "check_home_score_non_negative": "home_score >= 0",
                "check_away_score_non_negative": "away_score >= 0"},
        foreign_keys=[ForeignKey(["home_club_id"], "clubs", ["club_id"], "fk_matches_home"),
                      ForeignKey(["away_club_id"], "clubs", ["club_id"], "fk_matches_away")],
        defaults={"status": "FINISHED"}),
    "standings": TableSpec(
        "standings", ["club_id"], unique=[["club_id"]],
        not_null=["club_id", "position", "played", "won", "drawn", "lost", "goals_for",
                  "goals_against", "goal_difference", "points", "points_per_game",
                  "win_percentage", "transformed_at"],
        checks={"check_played_non_negative": "played >= 0",
                "check_points_non_negative": "points >= 0"},
        foreign_keys=[ForeignKey(["club_id"], "clubs", ["club_id"], "fk_standings_club")]),
}

# Dependency order for loading (parents first) and cascading deletes.
LOAD_ORDER = ["clubs", "players", "matches", "standings"]
