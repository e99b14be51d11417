"""Registered queries: one callable (spark, sf_dir) -> DataFrame per blueprint key."""

from __future__ import annotations

from collections.abc import Callable

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions.scalars import (format_ts, normalise_position, parse_timestamp, result_label, score_label,
                                       signed_display, split_form, thousands, zone_badge)
from terrace.operators.clean import clean_clubs, clean_matches, clean_players, clean_standings
from terrace.operators.form import last_n_form
from terrace.operators.integrity import (check_violations, duplicate_keys, fingerprint, fk_report,
                                         integrity_report, not_null_counts, order_violations,
                                         pk_violations, rank_sequence)
from terrace.operators.quality import audit_spec
from terrace.operators.quality import quality_report as build_quality_report
from terrace.operators.ranking import global_rank
from terrace.operators.upsert import (assign_surrogate_keys, cascade_delete, table_counts as count_tables,
                                      upsert, upsert_counts)
from terrace.plans import derive, lookups, views
from terrace.plans import star_audits as SA
from terrace.plans.star_audits import STAR_TABLE_SPECS
from terrace.schemas import LEAGUE_TABLES, league_audit_specs, with_defaults
from terrace.session import tables_root
from terrace.sources.sinks import (batch_manifest, file_order_index, read_bronze, read_silver_csv, stamp_lineage,
                                   write_bronze, write_silver)
from terrace.sources.tables import Tables

#: Upper bound of the founded year in the registered query, so that its result does not depend on the day.
CLEANER_MAX_YEAR = 2025

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def longs(df: DataFrame) -> DataFrame:
    """Widen every integral column to BIGINT (type parity with the oracle)."""
    return df.select(*[F.col(f.name).cast("long").alias(f.name)
                       if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType))
                       else F.col(f.name) for f in df.schema.fields])


@register("league_table")
def league_table(spark, sf_dir):
    lg = derive.league(spark, sf_dir)
    return longs(views.league_table(lg.clubs, lg.standings, lg.window_rows))


def _league(spark, sf_dir, **kw):
    return derive.league(spark, sf_dir, **kw)


@register("league_table_rint")
def league_table_rint(spark, sf_dir):
    """Points per game and win % rounded half-even."""
    s = _league(spark, sf_dir).standings
    return longs(s.select("club_id", "played", "won", "points", "points_per_game", "win_percentage"))


@register("standings_position")
def standings_position(spark, sf_dir):
    """Row number after the 4-key sort, club_id breaking full ties."""
    s = _league(spark, sf_dir).standings
    return longs(s.select("position", "club_id", "points", "goal_difference", "goals_for",
                          "goals_against"))


@register("top_scorers")
def top_scorers(spark, sf_dir):
    """V2/V7, J2, F1, W2 via ranked top-k (X2), limit 10."""
    lg = _league(spark, sf_dir)
    return longs(views.top_scorers(lg.players, lg.clubs, 10))


@register("club_analytics")
def club_analytics(spark, sf_dir):
    """V3: J3 + A1-A5 + R2."""
    lg = _league(spark, sf_dir)
    return longs(views.club_analytics(lg.clubs, lg.players, lg.standings))


@register("club_squad_only")
def club_squad_only(spark, sf_dir):
    """Clubs LEFT JOIN players only."""
    lg = _league(spark, sf_dir)
    return longs(views.club_squad_only(lg.clubs, lg.players))


@register("club_form_last5")
def club_form_last5(spark, sf_dir):
    """W3 + A10: last five results per club, oldest first; 'N/A' without matches."""
    s = _league(spark, sf_dir).standings
    return longs(s.select("club_id", "form"))


@register("event_form_last5")
def event_form_last5(spark, sf_dir):
    """W3 generic: the initials of each user's last five event types (ts, then event_id)."""
    e = Tables(spark, sf_dir).events.select(
        "user_id", "ts", "event_id", F.upper(F.substring("event_type", 1, 1)).alias("letter"))
    return last_n_form(e, "user_id", ["ts", "event_id"], "letter", n=5)


@register("form_letter_counts")
def form_letter_counts(spark, sf_dir):
    """Split the form strings, explode, count letters."""
    s = _league(spark, sf_dir).standings
    return (s.select(F.explode(split_form("form")).alias("letter"))
            .groupBy("letter").agg(F.count(F.lit(1)).alias("occurrences")))


@register("match_results")
def match_results(spark, sf_dir):
    """T7, P6, P7, P11, P17 over every cleaned match."""
    m = _league(spark, sf_dir).matches
    return longs(m.select("match_id", "gameweek", "home_club_id", "away_club_id", "match_date",
                          "home_score", "away_score", "total_goals", "result", "status",
                          score_label("home_score", "away_score").alias("score_label"),
                          result_label("result").alias("result_label")))


@register("position_normalise")
def position_normalise(spark, sf_dir):
    """Player positions through the alias dictionary, part names through
    strip + capitalize (the dictionary's fallback)."""
    t = Tables(spark, sf_dir)
    players = derive.raw_players(t).select(
        F.lit("player").alias("entity"), F.col("player_id").alias("entity_id"),
        F.col("position").alias("raw_value"), normalise_position("position").alias("normalised"))
    parts = t.part.select(
        F.lit("part").alias("entity"), F.col("p_partkey").alias("entity_id"),
        F.col("p_name").alias("raw_value"), normalise_position("p_name").alias("normalised"))
    return longs(players.unionByName(parts))


@register("zone_badges")
def zone_badges(spark, sf_dir):
    """P14, P15, P16 on the league table."""
    lg = _league(spark, sf_dir)
    lt = views.league_table(lg.clubs, lg.standings, lg.window_rows)
    return longs(lt.join(lg.clubs.select("club_id", "capacity"), "club_id").select(
        "club_id", "dynamic_rank", signed_display("goal_difference").alias("gd_display"),
        zone_badge("dynamic_rank").alias("zone"), thousands("capacity").alias("capacity_display")))


@register("rank_sequence_check")
def rank_sequence_check(spark, sf_dir):
    """W7 + W8 on the league table, the standings and the full scorer ranking."""
    lg = _league(spark, sf_dir)
    lt = views.league_table(lg.clubs, lg.standings, lg.window_rows)
    sc = views.top_scorers_view(lg.players, lg.clubs)
    parts = [
        order_violations(lt, "dynamic_rank", "points").agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit("league_points_non_increasing").alias("check_name"), "violations"),
        order_violations(lg.standings, "position", "points").agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit("standings_points_non_increasing").alias("check_name"), "violations"),
        rank_sequence(lg.standings, "position").select(
            F.lit("standings_position_sequence").alias("check_name"), "violations"),
        rank_sequence(sc, "scorer_rank").select(F.lit("scorer_rank_sequence").alias("check_name"),
                                                "violations"),
        order_violations(sc, "scorer_rank", "goals").agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit("scorer_goals_non_increasing").alias("check_name"), "violations"),
    ]
    return longs(reduce(DataFrame.unionByName, parts))


@register("table_counts")
def table_counts(spark, sf_dir):
    """Rows per gold table plus the total."""
    lg = _league(spark, sf_dir)
    return count_tables({"clubs": lg.clubs, "players": lg.players, "matches": lg.matches,
               "standings": lg.standings})


@register("manifest")
def manifest(spark, sf_dir):
    """S11 + A12: record count per raw (bronze) batch and the grand total."""
    t = Tables(spark, sf_dir)
    return batch_manifest({"clubs": derive.raw_clubs(t), "players": derive.raw_players(t),
                           "matches": derive.raw_matches(t)})


def _star_audits(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return [audit_spec(t.lineitem.select(*SA.LINEITEM_COLUMNS), SA.lineitem_spec(), persist=False),
            audit_spec(t.customer, SA.customer_spec(), persist=False),
            audit_spec(t.orders, SA.orders_spec(), persist=False)]


@register("audit_metrics")
def audit_metrics(spark, sf_dir):
    """Q1-Q7: metrics row per audited dataset (lineitem has duplicate keys,
    customer negative balances)."""
    return reduce(DataFrame.unionByName, [a.metrics for a in _star_audits(spark, sf_dir)])


@register("audit_issues_count")
def audit_issues_count(spark, sf_dir):
    """Q6: issue log rows per dataset and kind (duplicate messages grouped)."""
    return reduce(DataFrame.unionByName, [a.issue_counts() for a in _star_audits(spark, sf_dir)])


@register("quality_report")
def quality_report(spark, sf_dir):
    """Pooled totals and PASS/WARN/FAIL."""
    return build_quality_report(_star_audits(spark, sf_dir)).select(
        "source_records", "processed_records", "rejected_records", "missing_fields", "duplicates",
        "validation_errors", "status")


@register("audit_first_wins")
def audit_first_wins(spark, sf_dir):
    """Per order, valid / rejected / duplicate line rows after first-wins dedup
    over the total record order (all columns), from the per-key summary."""
    g = _star_audits(spark, sf_dir)[0].key_summary()
    return g.groupBy("l_orderkey").agg(
        F.sum(F.col("_c") - F.col("_rejected")).cast("long").alias("valid_rows"),
        F.sum("_rejected").cast("long").alias("rejected_rows"),
        F.sum("_dups").cast("long").alias("duplicate_rows"))


def _league_tables(lg) -> dict:
    return {"clubs": lg.clubs, "players": lg.players, "matches": lg.matches, "standings": lg.standings}


def _star_tables(spark, sf_dir) -> dict:
    t = Tables(spark, sf_dir)
    return {n: t[n] for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")}


def _fk_only(tables, specs):
    parts = [fk_report(tables[name], name, spec.foreign_keys, tables) for name, spec in specs.items()
             if name in tables and any(fk.parent in tables for fk in spec.foreign_keys)]
    return reduce(DataFrame.unionByName, parts)


@register("fk_violations")
def fk_violations_q(spark, sf_dir):
    """Orphans per foreign key on the star and league tables, and on the
    league state after deleting the clubs of region AFRICA *without* cascade
    (the orphans a cascade has to remove)."""
    lg = _league(spark, sf_dir)
    lt = _league_tables(lg)
    africa = Tables(spark, sf_dir).region.where(F.col("r_name") == "AFRICA") \
        .select(F.col("r_name").alias("city"))
    remaining = dict(lt, clubs=lg.clubs.join(africa, "city", "left_anti"))
    after = _fk_only(remaining, LEAGUE_TABLES).withColumn(
        "constraint_name", F.concat(F.lit("after_delete_"), F.col("constraint_name")))
    return (_fk_only(_star_tables(spark, sf_dir), STAR_TABLE_SPECS)
            .unionByName(_fk_only(lt, LEAGUE_TABLES)).unionByName(after))


@register("check_violations")
def check_violations_q(spark, sf_dir):
    """I4-I13 on the league tables plus CHECKs on the star tables (customer has
    negative balances); NULL passes a CHECK."""
    lt = _league_tables(_league(spark, sf_dir))
    st = _star_tables(spark, sf_dir)
    parts = [check_violations(lt[n], n, s.checks) for n, s in LEAGUE_TABLES.items() if s.checks]
    parts += [check_violations(st[n], n, s.checks) for n, s in STAR_TABLE_SPECS.items() if s.checks]
    return reduce(DataFrame.unionByName, parts)


@register("pk_duplicates")
def pk_duplicates(spark, sf_dir):
    """Duplicate primary keys (lineitem's (orderkey, linenumber)) and
    duplicate UNIQUE values (part names, nation names), one row per key."""
    st = _star_tables(spark, sf_dir)
    parts = []
    for n, s in STAR_TABLE_SPECS.items():
        parts.append(pk_violations(st[n], n, s.primary_key))
        for u in s.unique:
            parts.append(duplicate_keys(st[n], n, u, "unique_" + "_".join(u)))
    return reduce(DataFrame.unionByName, parts)


@register("not_null_report")
def not_null_report(spark, sf_dir):
    """Nulls per column of the league tables and of orders LEFT JOIN lineitem
    (orders without lines give nulls)."""
    lt = _league_tables(_league(spark, sf_dir))
    t = Tables(spark, sf_dir)
    ol = t.orders.select("o_orderkey", "o_orderdate").join(
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity",
                          "l_shipdate"), "o_orderkey", "left")
    parts = [not_null_counts(df.drop("transformed_at"), n) for n, df in lt.items()]
    parts.append(not_null_counts(ol, "orders_lineitem"))
    return reduce(DataFrame.unionByName, parts)


_PLAYER_COLS = ["player_id", "club_id", "name", "position", "nationality", "jersey_number",
                "appearances", "goals", "assists", "goal_contributions", "goals_per_game"]


def _upsert_inputs(spark, sf_dir):
    """Base table: every player but the 'Machinery' ones; batch: re-cleaned
    'Machinery' (new keys) and 'Midfielder' (existing keys) players, each with
    one more goal."""
    t = Tables(spark, sf_dir)
    lg = _league(spark, sf_dir)
    base = lg.players.where(F.col("position") != "Machinery")
    raw = derive.raw_players(t).withColumn("goals", F.col("goals") + 1)
    batch = clean_players(raw, "1970-01-02T00:00:00+00:00").where(
        F.col("position").isin("Machinery", "Midfielder"))
    return base, batch


@register("upsert_players")
def upsert_players(spark, sf_dir):
    """M1: existing keys take the batch's values, new keys are inserted, keys
    absent from the batch stay."""
    base, batch = _upsert_inputs(spark, sf_dir)
    return longs(upsert(base, batch, "player_id", check_keys=False).select(*_PLAYER_COLS))


@register("upsert_counts")
def upsert_counts_q(spark, sf_dir):
    """M3: processed / inserted / updated for the same upsert."""
    base, batch = _upsert_inputs(spark, sf_dir)
    return upsert_counts(base, batch, "player_id")


@register("cascade_delete")
def cascade_delete_q(spark, sf_dir):
    """I16: delete the clubs of region AFRICA with ON DELETE CASCADE semantics;
    row counts of the new versions."""
    lg = _league(spark, sf_dir)
    africa = Tables(spark, sf_dir).region.where(F.col("r_name") == "AFRICA") \
        .select(F.col("r_name").alias("city"))
    deleted = lg.clubs.join(africa, "city", "left_semi").select("club_id")
    out = cascade_delete(_league_tables(lg), "clubs", "club_id", deleted,
                         {"players": ["club_id"], "matches": ["home_club_id", "away_club_id"],
                          "standings": ["club_id"]})
    return count_tables(out)


@register("clubs_by_city")
def clubs_by_city(spark, sf_dir):
    """City ILIKE '%ri%' ordered by name."""
    return longs(lookups.clubs(_league(spark, sf_dir).clubs, city="ri").drop("transformed_at"))


@register("club_detail_counts")
def club_detail_counts(spark, sf_dir):
    """L2, J6 flattened: squad and match counts per club."""
    lg = _league(spark, sf_dir)
    return lookups.club_detail_counts(lg.clubs, lg.players, lg.matches, lg.standings)


@register("clubs_with_newest")
def clubs_with_newest(spark, sf_dir):
    """J6, L2 nested: each club with its counts and its newest three matches as one bounded list."""
    lg = _league(spark, sf_dir)
    out = lookups.clubs_with_newest(lg.clubs.select("club_id", "name"), lg.players, lg.matches, newest=3)
    line = F.transform("matches", lambda m: F.concat_ws(":", m["place"], m["match_id"], m["match_date"], m["opponent_id"],
                                                         m["goals_for"], m["goals_against"]))
    return out.select("club_id", "name", "squad_count", "match_count", F.array_join(line, ";").alias("newest"))


@register("club_matches_newest")
def club_matches_newest(spark, sf_dir):
    """The newest 20 matches of club 3 by the order of the club's page."""
    lg = _league(spark, sf_dir)
    out = lookups.club_detail(lg.clubs, lg.players, lg.matches, lg.standings, 3)["matches"].limit(20)
    return longs(out.select("match_id", "match_date", "home_club_id", "away_club_id", "result"))


@register("players_filtered")
def players_filtered(spark, sf_dir):
    """Position ILIKE '%mid%' AND name ILIKE '%0001%', top 50."""
    lg = _league(spark, sf_dir)
    out = lookups.players(lg.players, lg.clubs, position="mid", search="0001", limit=50)
    return longs(out.select(*_PLAYER_COLS, "club_name"))


@register("player_detail")
def player_detail(spark, sf_dir):
    """One player by key with the club name."""
    lg = _league(spark, sf_dir)
    return longs(lookups.player_detail(lg.players, lg.clubs, 7).select(*_PLAYER_COLS, "club_name"))


@register("matches_of_club")
def matches_of_club(spark, sf_dir):
    """Every match of club 3 (home or away) with both names."""
    lg = _league(spark, sf_dir)
    return longs(lookups.matches(lg.matches, lg.clubs, club_id=3).select(
        "match_id", "gameweek", "match_date", "home_club_id", "home_club_name", "away_club_id",
        "away_club_name", "home_score", "away_score", "score", "result"))


@register("matches_gameweek")
def matches_gameweek(spark, sf_dir):
    """Gameweek 7 only, both filters folded (club unset)."""
    lg = _league(spark, sf_dir)
    return longs(lookups.matches(lg.matches, lg.clubs, gameweek=7).select(
        "match_id", "gameweek", "match_date", F.substring("match_date", 1, 10).alias("match_day"),
        "home_club_name", "away_club_name", "score"))


@register("player_search")
def player_search(spark, sf_dir):
    """F5, F8 (L12): name contains '12' (literal, case-insensitive) AND position = 'Forward'."""
    p = _league(spark, sf_dir).players
    return longs(lookups.player_search(p, q="12", position="Forward").select(*_PLAYER_COLS))


@register("club_search")
def club_search(spark, sf_dir):
    """F9 (L11) + L14: name or city contains 'nation_1' / 'asia', as (club_id, name)."""
    c = _league(spark, sf_dir).clubs
    a = lookups.club_search(c, "nation_1")
    b = lookups.club_search(c, "asia")
    return longs(lookups.club_options(a.unionByName(b).distinct()))


@register("global_rank_scaled")
def global_rank_scaled(spark, sf_dir):
    """DENSE_RANK over o_totalprice DESC on all orders without a
    single-partition window (range-partitioned numbering + offsets)."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    return global_rank(o, ["-o_totalprice"], out="price_rank", kind="dense_rank")


@register("top_scorers_full")
def top_scorers_full(spark, sf_dir):
    """V2 over every scorer with the scalable ROW_NUMBER."""
    lg = _league(spark, sf_dir)
    return longs(views.top_scorers_view(lg.players, lg.clubs))


@register("top_scorers_sql")
def top_scorers_sql(spark, sf_dir):
    """V4 + V7 + F10: the views registered as temp views, queried through
    spark.sql with a bound :limit parameter (5)."""
    lg = _league(spark, sf_dir)
    views.create_views(spark, lg.clubs, lg.players, lg.standings)
    return longs(views.query_top_scorers_sql(spark, 5))


def _views(spark, sf_dir):
    lg = _league(spark, sf_dir)
    views.create_views(spark, lg.clubs, lg.players, lg.standings)


@register("top_scorers_view")
def top_scorers_view(spark, sf_dir):
    """V2 + V4 + W2: the registered view read whole, numbered by ranges in one lazy plan."""
    _views(spark, sf_dir)
    return longs(spark.table("vw_top_scorers"))


@register("league_table_view")
def league_table_view(spark, sf_dir):
    """V1 + V6 + W1: the registered view read whole, dense ranks over the different keys."""
    _views(spark, sf_dir)
    return longs(spark.table("vw_league_table"))


@register("club_analytics_view")
def club_analytics_view(spark, sf_dir):
    """V3 + V8 through the registered view."""
    _views(spark, sf_dir)
    return longs(spark.table("vw_club_analytics"))


@register("order_gaps")
def order_gaps(spark, sf_dir):
    """W7 over a rank with gaps and ties: customers (many without orders) after which the next customer with
    orders has a larger one than their smallest."""
    o = Tables(spark, sf_dir).orders.select("o_custkey", "o_totalprice")
    return longs(order_violations(o, "o_custkey", "o_totalprice"))


@register("record_order")
def record_order(spark, sf_dir):
    """The place of each order in its file, from split starts and counts, whatever task read it."""
    return longs(file_order_index(Tables(spark, sf_dir).orders.select("o_orderkey"), "record_index"))


@register("upsert_fingerprints")
def upsert_fingerprints(spark, sf_dir):
    """M5 + M6: the content after the same batch is applied once, twice and three times, and with one value changed."""
    base, batch = _upsert_inputs(spark, sf_dir)
    cols = [c for c in _PLAYER_COLS if c != "goals_per_game"]
    now, out = base.select(*_PLAYER_COLS), []
    batch = batch.select(*_PLAYER_COLS)
    for step in range(1, 4):
        now = upsert(now, batch, "player_id", check_keys=False)
        out.append(fingerprint(now, cols).withColumn("step", F.lit(f"run {step}")))
    least = now.agg(F.min("player_id").alias("player_id")).withColumn("_least", F.lit(1))
    changed = now.join(least, "player_id", "left").withColumn("goals", F.col("goals") + F.coalesce("_least", F.lit(0)))
    out.append(fingerprint(changed, cols).withColumn("step", F.lit("one changed")))
    return reduce(DataFrame.unionByName, out).select("step", "row_count", "sum_a", "sum_b")


@register("standings_surrogate_ids")
def standings_surrogate_ids(spark, sf_dir):
    """Surrogate ids for standings rows; clubs already holding an id (an
    earlier load of the clubs of region AMERICA) keep it, the others are
    numbered after the current maximum in club_id order."""
    lg = _league(spark, sf_dir)
    st = lg.standings.select("club_id", "points")
    america = lg.clubs.where(F.col("city") == "AMERICA").select("club_id")
    # one row per club: the bound allows the plain window
    earlier = assign_surrogate_keys(None, st.join(america, "club_id", "left_semi"), "club_id",
                                    window_rows=lg.window_rows)
    return longs(assign_surrogate_keys(earlier, st, "club_id", window_rows=lg.window_rows))


@register("integrity_report")
def integrity_report_q(spark, sf_dir):
    """M8: every declared constraint of the league and star tables with its
    violation count and PASS/FAIL (customer's negative balances fail)."""
    lt = {n: df.drop("transformed_at") for n, df in _league_tables(_league(spark, sf_dir)).items()}
    tables = dict(_star_tables(spark, sf_dir), **lt)
    return integrity_report(tables, dict(STAR_TABLE_SPECS, **LEAGUE_TABLES))


@register("audit_issue_log")
def audit_issue_log(spark, sf_dir):
    """Q5/Q6 per row: every issue of every rejected record (dataset, pk, error),
    through the per-row path (first occurrence per key joined back)."""
    return reduce(DataFrame.unionByName,
                  [a.issues.select(F.lit(a.name).alias("dataset"), "pk", "error")
                   for a in _star_audits(spark, sf_dir)])


def _league_audits(spark, sf_dir):
    raw = derive.dirty_batches(Tables(spark, sf_dir))
    specs = league_audit_specs({n: df.columns for n, df in raw.items()})
    return [audit_spec(df, specs[n], persist=False) for n, df in raw.items()]


@register("league_audit_metrics")
def league_audit_metrics(spark, sf_dir):
    """Metrics of the four league batches with dirt."""
    return reduce(DataFrame.unionByName, [a.metrics for a in _league_audits(spark, sf_dir)])


@register("league_audit_issues")
def league_audit_issues(spark, sf_dir):
    """Q6: every issue of every rejected league record (dataset, record_index, pk, error)."""
    return reduce(DataFrame.unionByName,
                  [a.issues.select(F.lit(a.name).alias("dataset"), "record_index", "pk", "error")
                   for a in _league_audits(spark, sf_dir)])


@register("league_quarantine")
def league_quarantine(spark, sf_dir):
    """Q5: the rejected players as they came, with their reasons in order and their place in the batch."""
    players = _league_audits(spark, sf_dir)[1]
    return longs(players.rejected.select(
        "player_id", "name", "jersey_number", "appearances", "goals", "assists",
        F.array_join("_rejection_reasons", "; ").alias("reasons"), F.col("_record_index").alias("record_index")))


@register("league_first_wins")
def league_first_wins(spark, sf_dir):
    """The players that pass, one per key: where a key repeats with conflicting values, the
    record that came first is the one that counts, good or bad."""
    return longs(_league_audits(spark, sf_dir)[1].valid.select("player_id", "appearances", "goals"))


@register("cleaner_assertions")
def cleaner_assertions(spark, sf_dir):
    """Q40-Q46: each cleaner assertion with its violations on the league batches with dirt."""
    raw = derive.dirty_batches(Tables(spark, sf_dir))
    parts = [clean_clubs(raw["clubs"], checks="count", max_year=CLEANER_MAX_YEAR).select(F.lit("clubs").alias("dataset"), "*"),
             clean_players(raw["players"], checks="count").select(F.lit("players").alias("dataset"), "*"),
             clean_matches(raw["matches"], checks="count").select(F.lit("matches").alias("dataset"), "*"),
             clean_standings(raw["standings"], checks="count").select(F.lit("standings").alias("dataset"), "*")]
    return reduce(DataFrame.unionByName, parts)


@register("mixed_dates")
def mixed_dates(spark, sf_dir):
    """Order dates written in seven ways by turns, one of them no date, parsed and written in one."""
    o = Tables(spark, sf_dir).orders
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    turn = k % 7
    text = (F.when(turn == 0, F.date_format(d, "yyyy-MM-dd HH:mm:ss")).when(turn == 1, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(turn == 2, F.date_format(d, "dd/MM/yyyy HH:mm")).when(turn == 3, F.date_format(d, "yyyy/MM/dd"))
            .when(turn == 4, F.concat(F.lit("  "), F.date_format(d, "yyyy-MM-dd'T'HH:mm"), F.lit(" ")))
            .when(turn == 5, F.concat(F.date_format(d, "yyyy-MM-dd HH:mm:ss"), F.lit(".250+02:00"))).otherwise("to be announced"))
    return o.select(k.cast("long").alias("match_id"), format_ts(parse_timestamp(text)).alias("match_date"))


@register("load_defaults")
def load_defaults(spark, sf_dir):
    """Rows by status as they are loaded, where the raw status is absent from every second row, and players
    loaded without any of their counters."""
    t = Tables(spark, sf_dir)
    m = t.orders.select(F.col("o_orderkey").alias("match_id"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("status"))
    m = with_defaults(m, LEAGUE_TABLES["matches"]).groupBy(F.lit("matches").alias("table_name"), F.col("status").alias("value"))
    p = with_defaults(t.customer.select(F.col("c_custkey").alias("player_id")), LEAGUE_TABLES["players"])
    p = p.groupBy(F.lit("players").alias("table_name"), F.concat_ws("/", *[F.col(c).cast("long") for c in (
        "appearances", "goals", "assists", "goal_contributions", "goals_per_game")]).alias("value"))
    n = F.count(F.lit(1)).alias("row_count")
    return m.agg(n).unionByName(p.agg(n))


@register("layer_round_trip")
def layer_round_trip(spark, sf_dir):
    """The raw players through bronze JSON lines, the clean ones through silver CSV and JSON, read again."""
    lg = _league(spark, sf_dir)
    root = f"{tables_root(spark)}/layers-{uuid.uuid4().hex}"
    raw = stamp_lineage(derive.raw_players(lg.t), "players", "1970-01-01T00:00:00+00:00")
    clean = lg.players.select(*_PLAYER_COLS)
    bronze = read_bronze(spark, write_bronze(raw, root, "players", "b1"), raw.schema)
    csv = read_silver_csv(spark, write_silver(clean, root, "players", "csv"), clean.schema)
    js = read_bronze(spark, write_silver(clean, f"{root}/json", "players", "json"), clean.schema)
    sums = [F.sum(F.col(c).cast("long")).alias(c) for c in ("player_id", "goals", "assists")]
    return reduce(DataFrame.unionByName, [
        d.agg(F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("row_count"), *sums,
              F.sum(F.length("name").cast("long")).alias("name_chars"), F.sum(F.length("position").cast("long")).alias("position_chars"),
              F.count_if(stamped).alias("stamped"))
        for layer, d, stamped in (("bronze json", bronze, F.col("_source") == "players"), ("silver csv", csv, F.lit(False)),
                                  ("silver json", js, F.lit(False)))])
