"""Side unpivot (X3) and last-N form strings (W3 + A10).

A club plays either at home or away.  Joining clubs to matches on
``home = id OR away = id`` plans as a nested-loop join; instead every match is
exploded into its two sides (a narrow, shuffle-free step) and everything after
that is an equi-grouping by club.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def match_sides(matches: DataFrame, *, match_id: str = "match_id",
                home: str = "home_club_id", away: str = "away_club_id",
                home_score: str = "home_score", away_score: str = "away_score",
                when_col: str = "match_date", extra: tuple = ()) -> DataFrame:
    """Two rows per match: (match_id, club_id, opponent_id, is_home, goals_for,
    goals_against, outcome W/D/L, <when_col>, *extra)."""
    def side(is_home: bool):
        me, other = (home, away) if is_home else (away, home)
        gf, ga = (home_score, away_score) if is_home else (away_score, home_score)
        return F.struct(
            F.col(me).alias("club_id"), F.col(other).alias("opponent_id"),
            F.lit(is_home).alias("is_home"),
            F.col(gf).alias("goals_for"), F.col(ga).alias("goals_against"))

    s = F.explode(F.array(side(True), side(False))).alias("_s")
    out = matches.select(F.col(match_id), F.col(when_col), *[F.col(c) for c in extra], s)
    out = out.select(match_id, "_s.*", when_col, *extra)
    return out.withColumn(
        "outcome",
        F.when(F.col("goals_for") > F.col("goals_against"), "W")
         .when(F.col("goals_for") < F.col("goals_against"), "L").otherwise("D"))


def last_n_form(events: DataFrame, key: str, order_by: list[str], letter: str,
                n: int = 5, sep: str = "-", out: str = "form") -> DataFrame:
    """Per key, the letters of the last ``n`` events joined oldest -> newest.

    ``order_by`` must be a total order inside a key (e.g. date, then id): ties on
    the date alone would make the choice arbitrary.  The filter on row_number
    lets Catalyst insert a partial WindowGroupLimit before the shuffle, so every
    map task forwards at most ``n`` rows per key: a key that owns a third of all
    rows costs no more shuffle than any other.
    """
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order_by])
    last = (events.select(key, *order_by, letter)
            .withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= n))
    ordered = F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in order_by],
                                                     F.col(letter).alias("_l"))))
    return last.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["_l"]), sep).alias(out))


def club_form(matches: DataFrame, n: int = 5, **side_kw) -> DataFrame:
    """Form string per club from cleaned matches (club_id, form); clubs without
    matches are absent here -- callers default them to 'N/A'."""
    sides = match_sides(matches, **side_kw)
    return last_n_form(sides, "club_id", [side_kw.get("when_col", "match_date"),
                                          side_kw.get("match_id", "match_id")],
                       "outcome", n=n)
