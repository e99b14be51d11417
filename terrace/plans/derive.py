"""Star schema -> league roles (§7.4 of the blueprint).

The driver's tables are mapped onto raw bronze batches of the four league
entities with integer arithmetic only, so that an independent SQL oracle can
rebuild the same rows:

* club   = nation x region
* player = customer x nation
* match  = orders x customer (home = customer's nation, away = orderkey mod 25,
           self-matches dropped)
* standings = aggregate of both sides of every match

The raw batches carry the same kind of dirt as the reference's literal batches
(outer blanks, mixed-case positions, lower-case codes, missing colours and
statuses), so the cleaners do real work.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.operators.clean import (clean_clubs, clean_matches, clean_players,
                                     clean_standings, standings_from_matches)
from terrace.operators.quality import RECORD_INDEX
from terrace.sources.tables import Tables

N_CLUBS = 25  # nations in the driver's schema


def raw_clubs(t: Tables) -> DataFrame:
    n, r = t.nation, t.region
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("long").alias("club_id"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("name"),
        F.lower(F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))).alias("short_name"),
        F.concat(F.col("n_name"), F.lit(" Arena")).alias("stadium"),
        (F.lit(1000) * (F.col("n_nationkey") + 1)).alias("capacity"),
        F.col("r_name").alias("city"),
        (F.lit(1850) + F.col("n_nationkey")).alias("founded_year"),
        F.when(F.col("n_regionkey") == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("#00000"), F.col("n_regionkey").cast("string"))).alias("primary_color"),
    )


def raw_players(t: Tables) -> DataFrame:
    c, n = t.customer, t.nation.select("n_nationkey", "n_name")
    seg = F.col("c_mktsegment")
    position = (F.when(seg == "AUTOMOBILE", "FORWARD").when(seg == "BUILDING", " midfielder ")
                .when(seg == "FURNITURE", "gk").when(seg == "HOUSEHOLD", "Def").otherwise(seg))
    k = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        k.alias("player_id"),
        F.col("c_nationkey").cast("long").alias("club_id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("name"),
        position.alias("position"),
        F.col("n_name").alias("nationality"),
        (F.lit(1) + k % 99).alias("jersey_number"),
        (k % 38).alias("appearances"),
        (k % 28).alias("goals"),
        ((k * 7) % 14).alias("assists"),
    )


def raw_matches(t: Tables) -> DataFrame:
    o, c = t.orders, t.customer.select("c_custkey", "c_nationkey")
    k = F.col("o_orderkey")
    away = k % N_CLUBS
    h, a = (k % 5).cast("string"), ((k * 3) % 4).cast("string")
    raw_score = F.when(k % 7 == 0, F.concat(h, F.lit(":"), a)).otherwise(F.concat(h, F.lit(" - "), a))
    status = (F.when(F.col("o_orderstatus") == "F", "finished")
              .when(F.col("o_orderstatus") == "O", " scheduled "))
    return (o.join(c, o.o_custkey == c.c_custkey)
            .where(F.col("c_nationkey") != away)
            .select(k.alias("match_id"),
                    (F.lit(1) + k % 38).alias("gameweek"),
                    F.col("c_nationkey").cast("long").alias("home_club_id"),
                    away.alias("away_club_id"),
                    F.col("o_orderdate").alias("match_date"),
                    raw_score.alias("raw_score"),
                    status.alias("status")))


def _twice(df: DataFrame, where) -> DataFrame:
    """``df`` with the rows that ``where`` holds for a second time, marked ``again``, out of one scan."""
    both = F.when(where, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return df.select("*", F.explode(both).alias("again"))


def dirty_batches(t: Tables) -> dict[str, DataFrame]:
    """The raw batches with the dirt that the league's rules look for, as functions of the keys, and a
    declared record order.  Repeated keys carry conflicting values: the second record of a key is the good or
    the bad one by turns, so the survivor shows which came first."""
    k = F.col("club_id")
    clubs = _twice(raw_clubs(t), k % 8 == 0).select(
        (k * 10 + F.col("again").cast("int")).alias(RECORD_INDEX), "club_id", "name", "short_name", "stadium",
        F.when((k % 6 == 1) != F.col("again"), -F.col("capacity")).otherwise(F.col("capacity")).alias("capacity"),
        F.when(k % 4 == 2, F.lit(None)).otherwise(F.col("city")).alias("city"),
        F.when(k % 5 == 3, F.lit(None)).when(k % 7 == 4, F.lit(1799)).otherwise(F.col("founded_year")).alias("founded_year"),
        "primary_color")

    k = F.col("player_id")
    # the repeated record comes before the first one for even keys, with a negative count of games
    players = _twice(raw_players(t), k % 13 == 0).select(
        (k * 10 + 5 + F.when(~F.col("again"), 0).when(k % 2 == 0, -1).otherwise(1)).alias(RECORD_INDEX), "player_id", "club_id",
        F.when(k % 101 == 7, F.lit("  ")).otherwise(F.col("name")).alias("name"), "position", "nationality",
        F.when(k % 37 == 4, F.lit(0)).otherwise(F.col("jersey_number")).alias("jersey_number"),
        F.when(F.col("again"), F.lit(-3).cast("long")).otherwise(F.col("appearances")).alias("appearances"),
        F.when(k % 41 == 9, F.lit(-1)).otherwise(F.col("goals")).alias("goals"),
        F.when(k % 43 == 5, F.lit(None).cast("long")).otherwise(F.col("assists")).alias("assists"))

    k = F.col("match_id")
    matches = raw_matches(t).select(
        k.alias(RECORD_INDEX), "match_id", F.when(k % 29 == 3, F.lit(0)).otherwise(F.col("gameweek")).alias("gameweek"),
        "home_club_id", F.when(k % 31 == 6, F.col("home_club_id")).otherwise(F.col("away_club_id")).alias("away_club_id"),
        "match_date", F.when(k % 23 == 2, F.concat(F.lit("FT "), F.col("raw_score"))).when(k % 47 == 1, F.lit(None))
        .when(k % 53 == 8, F.lit("postponed")).otherwise(F.col("raw_score")).alias("raw_score"), "status")
    c = F.col("club_id")
    standings = standings_from_matches(clean_matches(raw_matches(t), checks="off")).select(
        c.alias(RECORD_INDEX), "club_id", F.when(c % 9 == 2, F.col("played") + 1).otherwise(F.col("played")).alias("played"),
        "won", "drawn", "lost", "goals_for", "goals_against",
        F.when(c % 10 == 3, F.col("points") - 1).otherwise(F.col("points")).alias("points"))
    return {"clubs": clubs, "players": players, "matches": matches, "standings": standings}


class League:
    """Silver/gold tables of the four roles, each built on first use only (plan
    analysis is not free, and most queries need one or two of them).

    The derived raw batches satisfy the cleaners' assertions by construction
    (self-matches are dropped, counts are non-negative), so ``checks`` defaults
    to "off" and Catalyst keeps full freedom to push filters into the scans; the
    pipeline runs the assertions eagerly on real batches.
    """

    def __init__(self, spark, sf_dir: str, checks: str = "off",
                 batch_ts: str = "1970-01-01T00:00:00+00:00", window_rows: int | None = N_CLUBS):
        self.t = Tables(spark, sf_dir)
        self.checks, self.batch_ts, self.window_rows = checks, batch_ts, window_rows

    @cached_property
    def clubs(self) -> DataFrame:
        return clean_clubs(raw_clubs(self.t), self.batch_ts, self.checks)

    @cached_property
    def players(self) -> DataFrame:
        return clean_players(raw_players(self.t), self.batch_ts, self.checks)

    @cached_property
    def matches(self) -> DataFrame:
        return clean_matches(raw_matches(self.t), self.batch_ts, self.checks)

    @cached_property
    def standings(self) -> DataFrame:
        """One plan at every size; the plan's two readers of the matches (aggregate and form)
        share what Catalyst can share, and nothing is written."""
        return clean_standings(standings_from_matches(self.matches), self.matches, self.batch_ts,
                               self.checks, window_rows=self.window_rows)


def league(spark, sf_dir: str, checks: str = "off", batch_ts: str = "1970-01-01T00:00:00+00:00",
           window_rows: int | None = N_CLUBS) -> League:
    """Silver/gold tables of the four roles derived from ``sf_dir``.  ``window_rows``: the bound on the number
    of clubs that allows a plain ranking window (None: the scalable numbering)."""
    return League(spark, sf_dir, checks, batch_ts, window_rows)
