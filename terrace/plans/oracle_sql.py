"""Independent DuckDB SQL for every registered query (the correctness oracle).

``ROLES`` rebuilds the derivation layer of ``terrace.plans.derive`` and the
cleaners' results directly in SQL; each query appends its final SELECT.
Integers are cast to BIGINT and ratios use half-even rounding so that values
hash identically to the Spark side.
"""

ROLES = """
WITH
clubs AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS club_id, n.n_name AS name,
         upper('N' || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0')) AS short_name,
         n.n_name || ' Arena' AS stadium,
         CAST(1000 * (n.n_nationkey + 1) AS INTEGER) AS capacity,
         r.r_name AS city, CAST(1850 + n.n_nationkey AS INTEGER) AS founded_year,
         CASE WHEN n.n_regionkey = 0 THEN '#1E293B'
              ELSE '#00000' || CAST(n.n_regionkey AS VARCHAR) END AS primary_color
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
players0 AS (
  SELECT c.c_custkey AS player_id, CAST(c.c_nationkey AS BIGINT) AS club_id, c.c_name AS name,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'FORWARD' WHEN 'BUILDING' THEN ' midfielder '
              WHEN 'FURNITURE' THEN 'gk' WHEN 'HOUSEHOLD' THEN 'Def' ELSE c.c_mktsegment END AS raw_position,
         n.n_name AS nationality,
         CAST(1 + c.c_custkey % 99 AS INTEGER) AS jersey_number,
         CAST(c.c_custkey % 38 AS INTEGER) AS appearances,
         CAST(c.c_custkey % 28 AS INTEGER) AS goals,
         CAST((c.c_custkey * 7) % 14 AS INTEGER) AS assists
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
players AS (
  SELECT player_id, club_id, name,
         CASE lower(trim(raw_position))
              WHEN 'goalkeeper' THEN 'Goalkeeper' WHEN 'gk' THEN 'Goalkeeper'
              WHEN 'defender' THEN 'Defender' WHEN 'def' THEN 'Defender'
              WHEN 'midfielder' THEN 'Midfielder' WHEN 'mid' THEN 'Midfielder'
              WHEN 'forward' THEN 'Forward' WHEN 'fwd' THEN 'Forward' WHEN 'striker' THEN 'Forward'
              ELSE upper(substr(trim(raw_position), 1, 1)) || lower(substr(trim(raw_position), 2)) END
           AS position,
         nationality, jersey_number, appearances, goals, assists,
         CAST(goals + assists AS INTEGER) AS goal_contributions,
         CASE WHEN appearances > 0
              THEN round_even(CAST(goals AS DOUBLE) / CAST(appearances AS DOUBLE) * 100.0, 0) / 100.0
              ELSE 0.0 END AS goals_per_game
  FROM players0
),
matches AS (
  SELECT o.o_orderkey AS match_id, CAST(1 + o.o_orderkey % 38 AS INTEGER) AS gameweek,
         CAST(c.c_nationkey AS BIGINT) AS home_club_id, o.o_orderkey % 25 AS away_club_id,
         strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS match_date,
         CAST(o.o_orderkey % 5 AS INTEGER) AS home_score,
         CAST((o.o_orderkey * 3) % 4 AS INTEGER) AS away_score,
         CASE o.o_orderstatus WHEN 'O' THEN 'SCHEDULED' ELSE 'FINISHED' END AS status
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE c.c_nationkey <> o.o_orderkey % 25
),
matches_c AS (
  SELECT *, CAST(home_score + away_score AS INTEGER) AS total_goals,
         CASE WHEN home_score > away_score THEN 'HOME_WIN'
              WHEN home_score < away_score THEN 'AWAY_WIN' ELSE 'DRAW' END AS result
  FROM matches
),
sides AS (
  SELECT match_id, match_date, home_club_id AS club_id, away_club_id AS opponent_id, TRUE AS is_home,
         home_score AS goals_for, away_score AS goals_against FROM matches
  UNION ALL
  SELECT match_id, match_date, away_club_id, home_club_id, FALSE,
         away_score, home_score FROM matches
),
sides_o AS (
  SELECT *, CASE WHEN goals_for > goals_against THEN 'W'
                 WHEN goals_for < goals_against THEN 'L' ELSE 'D' END AS outcome
  FROM sides
),
form AS (
  SELECT club_id, string_agg(outcome, '-' ORDER BY match_date, match_id) AS form
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY club_id ORDER BY match_date DESC, match_id DESC) AS rn
        FROM sides_o) WHERE rn <= 5
  GROUP BY club_id
),
standings0 AS (
  SELECT club_id, CAST(COUNT(*) AS BIGINT) AS played,
         CAST(SUM(CASE WHEN outcome = 'W' THEN 1 ELSE 0 END) AS BIGINT) AS won,
         CAST(SUM(CASE WHEN outcome = 'D' THEN 1 ELSE 0 END) AS BIGINT) AS drawn,
         CAST(SUM(CASE WHEN outcome = 'L' THEN 1 ELSE 0 END) AS BIGINT) AS lost,
         CAST(SUM(goals_for) AS BIGINT) AS goals_for,
         CAST(SUM(goals_against) AS BIGINT) AS goals_against
  FROM sides_o GROUP BY club_id
),
standings1 AS (
  SELECT s.*, won * 3 + drawn AS points, goals_for - goals_against AS goal_difference,
         round_even(CAST(won * 3 + drawn AS DOUBLE) / CAST(NULLIF(played, 0) AS DOUBLE) * 100.0, 0) / 100.0
           AS points_per_game,
         round_even(CAST(won AS DOUBLE) / CAST(NULLIF(played, 0) AS DOUBLE) * 100.0 * 10.0, 0) / 10.0
           AS win_percentage,
         COALESCE(f.form, 'N/A') AS form
  FROM standings0 s LEFT JOIN form f USING (club_id)
),
standings AS (
  SELECT ROW_NUMBER() OVER (ORDER BY points DESC, goal_difference DESC, goals_for DESC,
                            goals_against ASC, club_id ASC) AS position, *
  FROM standings1
),
league AS (
  SELECT CAST(DENSE_RANK() OVER (ORDER BY s.points DESC, s.goal_difference DESC, s.goals_for DESC,
                                 s.goals_against ASC) AS BIGINT) AS dynamic_rank,
         c.club_id, c.name AS club_name, c.short_name, c.stadium, c.primary_color,
         s.played, s.won, s.drawn, s.lost, s.goals_for, s.goals_against, s.goal_difference,
         s.points, s.points_per_game, s.win_percentage, s.form
  FROM standings s JOIN clubs c ON s.club_id = c.club_id
)
"""


def q(body: str) -> str:
    return ROLES + body


SQL: dict[str, str] = {}

SQL["league_table"] = q("SELECT * FROM league")

SQL["league_table_rint"] = q(
    "SELECT club_id, played, won, points, points_per_game, win_percentage FROM standings")

SQL["standings_position"] = q("""
SELECT CAST(position AS BIGINT) AS position, club_id, points, goal_difference, goals_for, goals_against
FROM standings""")

_SCORERS = """
scorers AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY p.goals DESC, p.assists DESC, p.appearances ASC,
                                 p.player_id ASC) AS BIGINT) AS scorer_rank,
         p.player_id, p.name AS player_name, c.name AS club_name, c.short_name AS club_short_name,
         c.primary_color AS club_color, p.position, p.nationality,
         CAST(p.jersey_number AS BIGINT) AS jersey_number, CAST(p.appearances AS BIGINT) AS appearances,
         CAST(p.goals AS BIGINT) AS goals, CAST(p.assists AS BIGINT) AS assists,
         CAST(p.goal_contributions AS BIGINT) AS goal_contributions, p.goals_per_game
  FROM players p JOIN clubs c ON p.club_id = c.club_id
  WHERE p.goals > 0
)
"""

SQL["top_scorers"] = q("," + _SCORERS + "SELECT * FROM scorers WHERE scorer_rank <= 10")

SQL["club_analytics"] = q("""
SELECT c.club_id, c.name AS club_name, c.short_name, c.stadium, CAST(c.capacity AS BIGINT) AS capacity,
       c.city, c.primary_color,
       CAST(COUNT(DISTINCT p.player_id) AS BIGINT) AS squad_size,
       CAST(COALESCE(SUM(p.goals), 0) AS BIGINT) AS squad_goals,
       CAST(COALESCE(SUM(p.assists), 0) AS BIGINT) AS squad_assists,
       CAST(ROUND(AVG(p.appearances), 1) AS DOUBLE) AS avg_player_appearances,
       CAST(COALESCE(s.position, 0) AS BIGINT) AS league_position,
       CAST(COALESCE(s.points, 0) AS BIGINT) AS points,
       CAST(COALESCE(s.goal_difference, 0) AS BIGINT) AS goal_difference,
       s.form
FROM clubs c
LEFT JOIN players p ON c.club_id = p.club_id
LEFT JOIN standings s ON c.club_id = s.club_id
GROUP BY c.club_id, c.name, c.short_name, c.stadium, c.capacity, c.city, c.primary_color,
         s.position, s.points, s.goal_difference, s.form""")

SQL["club_squad_only"] = q("""
SELECT c.club_id, c.name AS club_name, CAST(c.capacity AS BIGINT) AS capacity,
       CAST(COUNT(DISTINCT p.player_id) AS BIGINT) AS squad_size,
       CAST(COALESCE(SUM(p.goals), 0) AS BIGINT) AS squad_goals,
       CAST(COALESCE(SUM(p.assists), 0) AS BIGINT) AS squad_assists,
       CAST(ROUND(AVG(p.appearances), 1) AS DOUBLE) AS avg_player_appearances
FROM clubs c LEFT JOIN players p ON c.club_id = p.club_id
GROUP BY c.club_id, c.name, c.capacity""")

SQL["club_form_last5"] = q("SELECT club_id, form FROM standings")

SQL["event_form_last5"] = """
SELECT user_id, string_agg(letter, '-' ORDER BY ts, event_id) AS form
FROM (SELECT user_id, ts, event_id, upper(substr(event_type, 1, 1)) AS letter,
             ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events)
WHERE rn <= 5
GROUP BY user_id"""

SQL["form_letter_counts"] = q("""
SELECT letter, CAST(COUNT(*) AS BIGINT) AS occurrences
FROM (SELECT unnest(string_split(form, '-')) AS letter FROM standings WHERE form <> 'N/A')
GROUP BY letter""")

SQL["match_results"] = q("""
SELECT match_id, CAST(gameweek AS BIGINT) AS gameweek, home_club_id, away_club_id, match_date,
       CAST(home_score AS BIGINT) AS home_score, CAST(away_score AS BIGINT) AS away_score,
       CAST(total_goals AS BIGINT) AS total_goals, result, status,
       CAST(home_score AS VARCHAR) || ' - ' || CAST(away_score AS VARCHAR) AS score_label,
       replace(result, '_', ' ') AS result_label
FROM matches_c""")

SQL["position_normalise"] = q("""
SELECT 'player' AS entity, player_id AS entity_id, raw_position AS raw_value,
       CASE lower(trim(raw_position))
            WHEN 'goalkeeper' THEN 'Goalkeeper' WHEN 'gk' THEN 'Goalkeeper'
            WHEN 'defender' THEN 'Defender' WHEN 'def' THEN 'Defender'
            WHEN 'midfielder' THEN 'Midfielder' WHEN 'mid' THEN 'Midfielder'
            WHEN 'forward' THEN 'Forward' WHEN 'fwd' THEN 'Forward' WHEN 'striker' THEN 'Forward'
            ELSE upper(substr(trim(raw_position), 1, 1)) || lower(substr(trim(raw_position), 2)) END
         AS normalised
FROM players0
UNION ALL
SELECT 'part', p_partkey, p_name,
       CASE lower(trim(p_name))
            WHEN 'goalkeeper' THEN 'Goalkeeper' WHEN 'gk' THEN 'Goalkeeper'
            WHEN 'defender' THEN 'Defender' WHEN 'def' THEN 'Defender'
            WHEN 'midfielder' THEN 'Midfielder' WHEN 'mid' THEN 'Midfielder'
            WHEN 'forward' THEN 'Forward' WHEN 'fwd' THEN 'Forward' WHEN 'striker' THEN 'Forward'
            ELSE upper(substr(trim(p_name), 1, 1)) || lower(substr(trim(p_name), 2)) END
FROM part""")

SQL["zone_badges"] = q("""
SELECT l.club_id, l.dynamic_rank,
       CASE WHEN l.goal_difference > 0 THEN '+' || CAST(l.goal_difference AS VARCHAR)
            ELSE CAST(l.goal_difference AS VARCHAR) END AS gd_display,
       CASE WHEN l.dynamic_rank <= 4 THEN 'top-4' WHEN l.dynamic_rank = 5 THEN 'europa' END AS zone,
       format('{:,}', c.capacity) AS capacity_display
FROM league l JOIN clubs c ON l.club_id = c.club_id""")

SQL["rank_sequence_check"] = q("," + _SCORERS + """
SELECT 'league_points_non_increasing' AS check_name,
       CAST(COUNT(*) FILTER (WHERE points > prev_points) AS BIGINT) AS violations
FROM (SELECT points, LAG(points) OVER (ORDER BY dynamic_rank, points DESC) AS prev_points FROM league)
UNION ALL
SELECT 'standings_points_non_increasing',
       CAST(COUNT(*) FILTER (WHERE points > prev_points) AS BIGINT)
FROM (SELECT points, LAG(points) OVER (ORDER BY position) AS prev_points FROM standings)
UNION ALL
SELECT 'standings_position_sequence',
       CAST(CASE WHEN COUNT(*) = 0 OR (COUNT(*) = MAX(position) AND COUNT(*) = COUNT(DISTINCT position)
                                       AND MIN(position) = 1) THEN 0 ELSE 1 END AS BIGINT)
FROM standings
UNION ALL
SELECT 'scorer_rank_sequence',
       CAST(CASE WHEN COUNT(*) = 0 OR (COUNT(*) = MAX(scorer_rank) AND COUNT(*) = COUNT(DISTINCT scorer_rank)
                                       AND MIN(scorer_rank) = 1) THEN 0 ELSE 1 END AS BIGINT)
FROM scorers
UNION ALL
SELECT 'scorer_goals_non_increasing',
       CAST(COUNT(*) FILTER (WHERE goals > prev_goals) AS BIGINT)
FROM (SELECT goals, LAG(goals) OVER (ORDER BY scorer_rank) AS prev_goals FROM scorers)""")

SQL["table_counts"] = q("""
SELECT 'clubs' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM clubs
UNION ALL SELECT 'players', COUNT(*) FROM players
UNION ALL SELECT 'matches', COUNT(*) FROM matches
UNION ALL SELECT 'standings', COUNT(*) FROM standings
UNION ALL SELECT 'total', (SELECT COUNT(*) FROM clubs) + (SELECT COUNT(*) FROM players)
                          + (SELECT COUNT(*) FROM matches) + (SELECT COUNT(*) FROM standings)""")

SQL["manifest"] = q("""
SELECT 'clubs' AS dataset, CAST(COUNT(*) AS BIGINT) AS record_count, CAST(NULL AS VARCHAR) AS path FROM clubs
UNION ALL SELECT 'players', COUNT(*), NULL FROM players0
UNION ALL SELECT 'matches', COUNT(*), NULL FROM matches
UNION ALL SELECT 'total', (SELECT COUNT(*) FROM clubs) + (SELECT COUNT(*) FROM players0)
                          + (SELECT COUNT(*) FROM matches), NULL""")

_AUDIT = """
WITH
li AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                                        l_extendedprice, l_discount, l_tax, l_returnflag,
                                        l_linestatus, l_shipdate) AS rn
  FROM lineitem
),
li_f AS (
  SELECT l_orderkey,
         (CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END) + (CASE WHEN l_partkey IS NULL THEN 1 ELSE 0 END)
         + (CASE WHEN l_suppkey IS NULL THEN 1 ELSE 0 END) + (CASE WHEN l_linenumber IS NULL THEN 1 ELSE 0 END)
         + (CASE WHEN l_returnflag IS NULL OR trim(l_returnflag) = '' THEN 1 ELSE 0 END)
         + (CASE WHEN l_linestatus IS NULL OR trim(l_linestatus) = '' THEN 1 ELSE 0 END)
         + (CASE WHEN l_shipdate IS NULL THEN 1 ELSE 0 END) AS n_missing,
         CASE WHEN l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND rn > 1 THEN 1 ELSE 0 END AS is_dup,
         CASE WHEN l_quantity BETWEEN 1 AND 50 THEN 0 ELSE 1 END AS r1,
         CASE WHEN l_discount BETWEEN 0.0 AND 0.1 THEN 0 ELSE 1 END AS r2,
         CASE WHEN l_tax BETWEEN 0.0 AND 0.08 THEN 0 ELSE 1 END AS r3,
         CASE WHEN l_extendedprice > 0 THEN 0 ELSE 1 END AS r4
  FROM li
),
cu AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY c_custkey) AS rn FROM customer
),
cu_f AS (
  SELECT (CASE WHEN c_custkey IS NULL THEN 1 ELSE 0 END)
         + (CASE WHEN c_name IS NULL OR trim(c_name) = '' THEN 1 ELSE 0 END)
         + (CASE WHEN c_nationkey IS NULL THEN 1 ELSE 0 END)
         + (CASE WHEN c_mktsegment IS NULL OR trim(c_mktsegment) = '' THEN 1 ELSE 0 END) AS n_missing,
         CASE WHEN c_custkey IS NOT NULL AND rn > 1 THEN 1 ELSE 0 END AS is_dup,
         CASE WHEN c_acctbal >= 0 THEN 0 ELSE 1 END AS r1,
         CASE WHEN c_nationkey BETWEEN 0 AND 24 THEN 0 ELSE 1 END AS r2,
         0 AS r3, 0 AS r4
  FROM cu
),
oo AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY o_orderkey) AS rn FROM orders
),
oo_f AS (
  SELECT (CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END)
         + (CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END)
         + (CASE WHEN o_orderdate IS NULL THEN 1 ELSE 0 END)
         + (CASE WHEN o_orderstatus IS NULL OR trim(o_orderstatus) = '' THEN 1 ELSE 0 END) AS n_missing,
         CASE WHEN o_orderkey IS NOT NULL AND rn > 1 THEN 1 ELSE 0 END AS is_dup,
         CASE WHEN o_totalprice > 0 THEN 0 ELSE 1 END AS r1,
         CASE WHEN o_orderstatus IN ('F', 'O', 'P') THEN 0 ELSE 1 END AS r2,
         0 AS r3, 0 AS r4
  FROM oo
),
flags AS (
  SELECT 'lineitem' AS dataset, n_missing, is_dup, r1, r2, r3, r4 FROM li_f
  UNION ALL SELECT 'customer', n_missing, is_dup, r1, r2, r3, r4 FROM cu_f
  UNION ALL SELECT 'orders', n_missing, is_dup, r1, r2, r3, r4 FROM oo_f
),
metrics AS (
  SELECT dataset, CAST(COUNT(*) AS BIGINT) AS source_count,
         CAST(SUM(CASE WHEN n_missing + is_dup + r1 + r2 + r3 + r4 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS valid_count,
         CAST(SUM(CASE WHEN n_missing + is_dup + r1 + r2 + r3 + r4 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS rejected_count,
         CAST(SUM(n_missing) AS BIGINT) AS missing_fields_count,
         CAST(SUM(is_dup) AS BIGINT) AS duplicate_count,
         CAST(SUM(r1 + r2 + r3 + r4) AS BIGINT) AS validation_error_count
  FROM flags GROUP BY dataset
)
"""

SQL["audit_metrics"] = _AUDIT + "SELECT * FROM metrics"

SQL["audit_issues_count"] = _AUDIT + """
SELECT dataset, kind, CAST(SUM(n) AS BIGINT) AS issue_count FROM (
  SELECT dataset, 'Duplicate primary key' AS kind, is_dup AS n FROM flags
  UNION ALL SELECT 'lineitem', 'Validation failure: Quantity must be between 1 and 50', r1 FROM li_f
  UNION ALL SELECT 'lineitem', 'Validation failure: Discount must be between 0 and 0.1', r2 FROM li_f
  UNION ALL SELECT 'lineitem', 'Validation failure: Tax must be between 0 and 0.08', r3 FROM li_f
  UNION ALL SELECT 'lineitem', 'Validation failure: Extended price must be positive', r4 FROM li_f
  UNION ALL SELECT 'customer', 'Validation failure: Account balance cannot be negative', r1 FROM cu_f
  UNION ALL SELECT 'customer', 'Validation failure: Nation key must be between 0 and 24', r2 FROM cu_f
  UNION ALL SELECT 'orders', 'Validation failure: Total price must be positive', r1 FROM oo_f
  UNION ALL SELECT 'orders', 'Validation failure: Order status must be F, O or P', r2 FROM oo_f
) GROUP BY dataset, kind HAVING SUM(n) > 0"""

SQL["quality_report"] = _AUDIT + """
SELECT CAST(SUM(source_count) AS BIGINT) AS source_records,
       CAST(SUM(valid_count) AS BIGINT) AS processed_records,
       CAST(SUM(rejected_count) AS BIGINT) AS rejected_records,
       CAST(SUM(missing_fields_count) AS BIGINT) AS missing_fields,
       CAST(SUM(duplicate_count) AS BIGINT) AS duplicates,
       CAST(SUM(validation_error_count) AS BIGINT) AS validation_errors,
       CASE WHEN SUM(rejected_count) = 0 THEN 'PASS'
            WHEN CAST(SUM(rejected_count) AS DOUBLE) < CAST(SUM(source_count) AS DOUBLE) * 0.1 THEN 'WARN'
            ELSE 'FAIL' END AS status
FROM metrics"""

SQL["audit_first_wins"] = _AUDIT + """
SELECT l_orderkey,
       CAST(SUM(CASE WHEN n_missing + is_dup + r1 + r2 + r3 + r4 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS valid_rows,
       CAST(SUM(CASE WHEN n_missing + is_dup + r1 + r2 + r3 + r4 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS rejected_rows,
       CAST(SUM(is_dup) AS BIGINT) AS duplicate_rows
FROM li_f GROUP BY l_orderkey"""

SQL["fk_violations"] = q("""
, remaining_clubs AS (SELECT * FROM clubs WHERE city NOT IN (SELECT r_name FROM region WHERE r_name = 'AFRICA'))
SELECT 'customer' AS table_name, 'fk_customer_nation' AS constraint_name,
       CAST(COUNT(*) AS BIGINT) AS violations
FROM customer WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'supplier', 'fk_supplier_nation', COUNT(*)
FROM supplier WHERE s_nationkey IS NOT NULL AND s_nationkey NOT IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'orders', 'fk_orders_customer', COUNT(*)
FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'lineitem', 'fk_lineitem_orders', COUNT(*)
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'lineitem', 'fk_lineitem_part', COUNT(*)
FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'lineitem', 'fk_lineitem_supplier', COUNT(*)
FROM lineitem WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'nation', 'fk_nation_region', COUNT(*)
FROM nation WHERE n_regionkey IS NOT NULL AND n_regionkey NOT IN (SELECT r_regionkey FROM region)
UNION ALL SELECT 'players', 'fk_players_club', COUNT(*)
FROM players WHERE club_id NOT IN (SELECT club_id FROM clubs)
UNION ALL SELECT 'matches', 'fk_matches_home', COUNT(*)
FROM matches WHERE home_club_id NOT IN (SELECT club_id FROM clubs)
UNION ALL SELECT 'matches', 'fk_matches_away', COUNT(*)
FROM matches WHERE away_club_id NOT IN (SELECT club_id FROM clubs)
UNION ALL SELECT 'standings', 'fk_standings_club', COUNT(*)
FROM standings WHERE club_id NOT IN (SELECT club_id FROM clubs)
UNION ALL SELECT 'players', 'after_delete_fk_players_club', COUNT(*)
FROM players WHERE club_id NOT IN (SELECT club_id FROM remaining_clubs)
UNION ALL SELECT 'matches', 'after_delete_fk_matches_home', COUNT(*)
FROM matches WHERE home_club_id NOT IN (SELECT club_id FROM remaining_clubs)
UNION ALL SELECT 'matches', 'after_delete_fk_matches_away', COUNT(*)
FROM matches WHERE away_club_id NOT IN (SELECT club_id FROM remaining_clubs)
UNION ALL SELECT 'standings', 'after_delete_fk_standings_club', COUNT(*)
FROM standings WHERE club_id NOT IN (SELECT club_id FROM remaining_clubs)""")

SQL["check_violations"] = q("""
SELECT 'clubs' AS table_name, 'check_capacity_positive' AS constraint_name,
       CAST(COUNT(*) FILTER (WHERE NOT (capacity > 0)) AS BIGINT) AS violations FROM clubs
UNION ALL SELECT 'clubs', 'check_founded_year', COUNT(*) FILTER (WHERE NOT (founded_year >= 1800)) FROM clubs
UNION ALL SELECT 'players', 'check_appearances_non_negative', COUNT(*) FILTER (WHERE NOT (appearances >= 0)) FROM players
UNION ALL SELECT 'players', 'check_goals_non_negative', COUNT(*) FILTER (WHERE NOT (goals >= 0)) FROM players
UNION ALL SELECT 'players', 'check_assists_non_negative', COUNT(*) FILTER (WHERE NOT (assists >= 0)) FROM players
UNION ALL SELECT 'matches', 'check_home_away_distinct', COUNT(*) FILTER (WHERE NOT (home_club_id <> away_club_id)) FROM matches
UNION ALL SELECT 'matches', 'check_home_score_non_negative', COUNT(*) FILTER (WHERE NOT (home_score >= 0)) FROM matches
UNION ALL SELECT 'matches', 'check_away_score_non_negative', COUNT(*) FILTER (WHERE NOT (away_score >= 0)) FROM matches
UNION ALL SELECT 'standings', 'check_played_non_negative', COUNT(*) FILTER (WHERE NOT (played >= 0)) FROM standings
UNION ALL SELECT 'standings', 'check_points_non_negative', COUNT(*) FILTER (WHERE NOT (points >= 0)) FROM standings
UNION ALL SELECT 'customer', 'check_acctbal_non_negative', COUNT(*) FILTER (WHERE NOT (c_acctbal >= 0)) FROM customer
UNION ALL SELECT 'supplier', 'check_acctbal_non_negative', COUNT(*) FILTER (WHERE NOT (s_acctbal >= 0)) FROM supplier
UNION ALL SELECT 'part', 'check_size_positive', COUNT(*) FILTER (WHERE NOT (p_size > 0)) FROM part
UNION ALL SELECT 'part', 'check_retailprice_positive', COUNT(*) FILTER (WHERE NOT (p_retailprice > 0)) FROM part
UNION ALL SELECT 'orders', 'check_totalprice_positive', COUNT(*) FILTER (WHERE NOT (o_totalprice > 0)) FROM orders
UNION ALL SELECT 'lineitem', 'check_quantity_positive', COUNT(*) FILTER (WHERE NOT (l_quantity > 0)) FROM lineitem
UNION ALL SELECT 'lineitem', 'check_discount_range', COUNT(*) FILTER (WHERE NOT (l_discount BETWEEN 0 AND 0.1)) FROM lineitem
UNION ALL SELECT 'lineitem', 'check_ship_after_order_year', COUNT(*) FILTER (WHERE NOT (year(l_shipdate) >= 1990)) FROM lineitem""")

SQL["pk_duplicates"] = """
SELECT table_name, constraint_name, key_value, CAST(occurrences AS BIGINT) AS occurrences FROM (
  SELECT 'customer' AS table_name, 'primary_key' AS constraint_name, CAST(c_custkey AS VARCHAR) AS key_value,
         COUNT(*) AS occurrences FROM customer WHERE c_custkey IS NOT NULL GROUP BY c_custkey HAVING COUNT(*) > 1
  UNION ALL SELECT 'supplier', 'primary_key', CAST(s_suppkey AS VARCHAR), COUNT(*) FROM supplier
    WHERE s_suppkey IS NOT NULL GROUP BY s_suppkey HAVING COUNT(*) > 1
  UNION ALL SELECT 'part', 'primary_key', CAST(p_partkey AS VARCHAR), COUNT(*) FROM part
    WHERE p_partkey IS NOT NULL GROUP BY p_partkey HAVING COUNT(*) > 1
  UNION ALL SELECT 'part', 'unique_p_name', p_name, COUNT(*) FROM part
    WHERE p_name IS NOT NULL GROUP BY p_name HAVING COUNT(*) > 1
  UNION ALL SELECT 'orders', 'primary_key', CAST(o_orderkey AS VARCHAR), COUNT(*) FROM orders
    WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey HAVING COUNT(*) > 1
  UNION ALL SELECT 'lineitem', 'primary_key', CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR),
         COUNT(*) FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
    GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
  UNION ALL SELECT 'nation', 'primary_key', CAST(n_nationkey AS VARCHAR), COUNT(*) FROM nation
    WHERE n_nationkey IS NOT NULL GROUP BY n_nationkey HAVING COUNT(*) > 1
  UNION ALL SELECT 'nation', 'unique_n_name', n_name, COUNT(*) FROM nation
    WHERE n_name IS NOT NULL GROUP BY n_name HAVING COUNT(*) > 1
  UNION ALL SELECT 'customer', 'primary_key_not_null', 'NULL', COUNT(*) FROM customer WHERE c_custkey IS NULL HAVING COUNT(*) > 0
  UNION ALL SELECT 'supplier', 'primary_key_not_null', 'NULL', COUNT(*) FROM supplier WHERE s_suppkey IS NULL HAVING COUNT(*) > 0
  UNION ALL SELECT 'part', 'primary_key_not_null', 'NULL', COUNT(*) FROM part WHERE p_partkey IS NULL HAVING COUNT(*) > 0
  UNION ALL SELECT 'orders', 'primary_key_not_null', 'NULL', COUNT(*) FROM orders WHERE o_orderkey IS NULL HAVING COUNT(*) > 0
  UNION ALL SELECT 'lineitem', 'primary_key_not_null', 'NULL', COUNT(*) FROM lineitem
    WHERE l_orderkey IS NULL OR l_linenumber IS NULL HAVING COUNT(*) > 0
  UNION ALL SELECT 'nation', 'primary_key_not_null', 'NULL', COUNT(*) FROM nation WHERE n_nationkey IS NULL HAVING COUNT(*) > 0
)"""

_NN = "CAST(COUNT(*) - COUNT({c}) AS BIGINT)"


def _nn_rows(table: str, src: str, cols: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, {_NN.format(c=c)} AS null_count FROM {src}"
        for c in cols)


SQL["not_null_report"] = q("""
, ol AS (SELECT o.o_orderkey, o.o_orderdate, l.l_linenumber, l.l_quantity, l.l_shipdate
         FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey)
""" + "\nUNION ALL ".join([
    _nn_rows("clubs", "clubs", ["club_id", "name", "short_name", "stadium", "capacity", "city",
                                "founded_year", "primary_color"]),
    _nn_rows("players", "players", ["player_id", "club_id", "name", "position", "nationality",
                                    "jersey_number", "appearances", "goals", "assists",
                                    "goal_contributions", "goals_per_game"]),
    _nn_rows("matches", "matches_c", ["match_id", "gameweek", "home_club_id", "away_club_id",
                                      "match_date", "home_score", "away_score", "total_goals",
                                      "result", "status"]),
    _nn_rows("standings", "standings", ["position", "club_id", "played", "won", "drawn", "lost",
                                        "goals_for", "goals_against", "goal_difference", "points",
                                        "points_per_game", "win_percentage", "form"]),
    _nn_rows("orders_lineitem", "ol", ["o_orderkey", "o_orderdate", "l_linenumber", "l_quantity",
                                       "l_shipdate"]),
]))

_UPSERT = """
, batch AS (
  SELECT player_id, club_id, name, position, nationality, jersey_number, appearances,
         CAST(goals + 1 AS INTEGER) AS goals, assists,
         CAST(goals + 1 + assists AS INTEGER) AS goal_contributions,
         CASE WHEN appearances > 0
              THEN round_even(CAST(goals + 1 AS DOUBLE) / CAST(appearances AS DOUBLE) * 100.0, 0) / 100.0
              ELSE 0.0 END AS goals_per_game
  FROM players WHERE position IN ('Machinery', 'Midfielder')
),
base AS (SELECT * FROM players WHERE position <> 'Machinery')
"""

_PCOLS = """player_id, club_id, name, position, nationality, CAST(jersey_number AS BIGINT) AS jersey_number,
       CAST(appearances AS BIGINT) AS appearances, CAST(goals AS BIGINT) AS goals,
       CAST(assists AS BIGINT) AS assists, CAST(goal_contributions AS BIGINT) AS goal_contributions,
       goals_per_game"""

SQL["upsert_players"] = q(_UPSERT + f"""
SELECT {_PCOLS} FROM base WHERE player_id NOT IN (SELECT player_id FROM batch)
UNION ALL SELECT {_PCOLS} FROM batch""")

SQL["upsert_counts"] = q(_UPSERT + """
SELECT CAST(COUNT(*) AS BIGINT) AS processed,
       CAST(COUNT(*) FILTER (WHERE player_id NOT IN (SELECT player_id FROM base)) AS BIGINT) AS inserted,
       CAST(COUNT(*) FILTER (WHERE player_id IN (SELECT player_id FROM base)) AS BIGINT) AS updated
FROM batch""")

SQL["cascade_delete"] = q("""
, gone AS (SELECT club_id FROM clubs WHERE city = 'AFRICA'),
kc AS (SELECT * FROM clubs WHERE club_id NOT IN (SELECT club_id FROM gone)),
kp AS (SELECT * FROM players WHERE club_id NOT IN (SELECT club_id FROM gone)),
km AS (SELECT * FROM matches WHERE home_club_id NOT IN (SELECT club_id FROM gone)
                               AND away_club_id NOT IN (SELECT club_id FROM gone)),
ks AS (SELECT * FROM standings WHERE club_id NOT IN (SELECT club_id FROM gone))
SELECT 'clubs' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM kc
UNION ALL SELECT 'players', COUNT(*) FROM kp
UNION ALL SELECT 'matches', COUNT(*) FROM km
UNION ALL SELECT 'standings', COUNT(*) FROM ks
UNION ALL SELECT 'total', (SELECT COUNT(*) FROM kc) + (SELECT COUNT(*) FROM kp)
                          + (SELECT COUNT(*) FROM km) + (SELECT COUNT(*) FROM ks)""")

SQL["clubs_by_city"] = q("""
SELECT club_id, name, short_name, stadium, CAST(capacity AS BIGINT) AS capacity, city,
       CAST(founded_year AS BIGINT) AS founded_year, primary_color
FROM clubs WHERE city ILIKE '%ri%'""")

SQL["club_detail_counts"] = q("""
SELECT c.club_id, c.name AS club_name,
       CAST((SELECT COUNT(*) FROM players p WHERE p.club_id = c.club_id) AS BIGINT) AS squad_count,
       CAST((SELECT COUNT(*) FROM matches m WHERE m.home_club_id = c.club_id OR m.away_club_id = c.club_id)
            AS BIGINT) AS match_count,
       (SELECT MAX(match_date) FROM matches m WHERE m.home_club_id = c.club_id OR m.away_club_id = c.club_id)
         AS latest_match_date,
       EXISTS (SELECT 1 FROM standings s WHERE s.club_id = c.club_id) AS has_standing,
       (SELECT s.points FROM standings s WHERE s.club_id = c.club_id) AS points
FROM clubs c""")

SQL["players_filtered"] = q(f"""
SELECT {_PCOLS}, club_name FROM (
  SELECT p.*, c.name AS club_name FROM (
    SELECT * FROM players WHERE position ILIKE '%mid%' AND name ILIKE '%0001%'
    ORDER BY goals DESC, assists DESC, player_id ASC LIMIT 50) p
  LEFT JOIN clubs c ON p.club_id = c.club_id)""")

SQL["player_detail"] = q(f"""
SELECT {_PCOLS}, club_name FROM (
  SELECT p.*, c.name AS club_name FROM players p LEFT JOIN clubs c ON p.club_id = c.club_id
  WHERE p.player_id = 7)""")

SQL["matches_of_club"] = q("""
SELECT m.match_id, CAST(m.gameweek AS BIGINT) AS gameweek, m.match_date, m.home_club_id,
       h.name AS home_club_name, m.away_club_id, a.name AS away_club_name,
       CAST(m.home_score AS BIGINT) AS home_score, CAST(m.away_score AS BIGINT) AS away_score,
       CAST(m.home_score AS VARCHAR) || ' - ' || CAST(m.away_score AS VARCHAR) AS score, m.result
FROM matches_c m LEFT JOIN clubs h ON m.home_club_id = h.club_id
LEFT JOIN clubs a ON m.away_club_id = a.club_id
WHERE m.home_club_id = 3 OR m.away_club_id = 3""")

SQL["matches_gameweek"] = q("""
SELECT m.match_id, CAST(m.gameweek AS BIGINT) AS gameweek, m.match_date,
       substr(m.match_date, 1, 10) AS match_day,
       h.name AS home_club_name, a.name AS away_club_name,
       CAST(m.home_score AS VARCHAR) || ' - ' || CAST(m.away_score AS VARCHAR) AS score
FROM matches m LEFT JOIN clubs h ON m.home_club_id = h.club_id
LEFT JOIN clubs a ON m.away_club_id = a.club_id
WHERE m.gameweek = 7""")

SQL["player_search"] = q(f"""
SELECT {_PCOLS} FROM players WHERE contains(lower(name), '12') AND position = 'Forward'""")

SQL["club_search"] = q("""
SELECT DISTINCT club_id, name FROM clubs
WHERE contains(lower(name), 'nation_1') OR contains(lower(city), 'nation_1')
   OR contains(lower(name), 'asia') OR contains(lower(city), 'asia')""")

SQL["global_rank_scaled"] = """
SELECT o_orderkey, o_totalprice,
       CAST(DENSE_RANK() OVER (ORDER BY o_totalprice DESC) AS BIGINT) AS price_rank
FROM orders"""

SQL["top_scorers_full"] = q("," + _SCORERS + "SELECT * FROM scorers")

SQL["top_scorers_sql"] = q("," + _SCORERS + "SELECT * FROM scorers WHERE scorer_rank <= 5")

SQL["standings_surrogate_ids"] = q("""
, earlier AS (
  SELECT s.club_id, CAST(ROW_NUMBER() OVER (ORDER BY s.club_id) AS BIGINT) AS id
  FROM standings s JOIN clubs c ON s.club_id = c.club_id WHERE c.city = 'AMERICA'
)
SELECT s.club_id, s.points, e.id FROM standings s JOIN earlier e ON s.club_id = e.club_id
UNION ALL
SELECT s.club_id, s.points,
       (SELECT COALESCE(MAX(id), 0) FROM earlier) + ROW_NUMBER() OVER (ORDER BY s.club_id) AS id
FROM standings s WHERE s.club_id NOT IN (SELECT club_id FROM earlier)""")


# Written out constraint by constraint: nothing here comes from the specs that it checks.
_INTEGRITY = [
    ("customer", "primary_key",
     "SELECT count(*) - count(DISTINCT c_custkey) FROM customer"),
    ("customer", "not_null",
     "SELECT 4 * count(*) - count(c_custkey) - count(c_name) - count(c_nationkey) - count(c_acctbal) FROM customer"),
    ("customer", "check_acctbal_non_negative",
     "SELECT count(*) FROM customer WHERE c_acctbal < 0"),
    ("customer", "fk_customer_nation",
     "SELECT count(*) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)"),
    ("supplier", "primary_key",
     "SELECT count(*) - count(DISTINCT s_suppkey) FROM supplier"),
    ("supplier", "check_acctbal_non_negative",
     "SELECT count(*) FROM supplier WHERE s_acctbal < 0"),
    ("supplier", "fk_supplier_nation",
     "SELECT count(*) FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation)"),
    ("part", "primary_key",
     "SELECT count(*) - count(DISTINCT p_partkey) FROM part"),
    ("part", "unique_p_name",
     "SELECT count(p_name) - count(DISTINCT p_name) FROM part"),
    ("part", "check_size_positive",
     "SELECT count(*) FROM part WHERE p_size <= 0"),
    ("part", "check_retailprice_positive",
     "SELECT count(*) FROM part WHERE p_retailprice <= 0"),
    ("orders", "primary_key",
     "SELECT count(*) - count(DISTINCT o_orderkey) FROM orders"),
    ("orders", "check_totalprice_positive",
     "SELECT count(*) FROM orders WHERE o_totalprice <= 0"),
    ("orders", "fk_orders_customer",
     "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
    ("lineitem", "primary_key",
     "SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem"),
    ("lineitem", "check_quantity_positive",
     "SELECT count(*) FROM lineitem WHERE l_quantity <= 0"),
    ("lineitem", "check_discount_range",
     "SELECT count(*) FROM lineitem WHERE l_discount < 0 OR l_discount > 0.1"),
    ("lineitem", "check_ship_after_order_year",
     "SELECT count(*) FROM lineitem WHERE year(l_shipdate) < 1990"),
    ("lineitem", "fk_lineitem_orders",
     "SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
    ("lineitem", "fk_lineitem_part",
     "SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)"),
    ("lineitem", "fk_lineitem_supplier",
     "SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)"),
    ("nation", "primary_key",
     "SELECT count(*) - count(DISTINCT n_nationkey) FROM nation"),
    ("nation", "unique_n_name",
     "SELECT count(n_name) - count(DISTINCT n_name) FROM nation"),
    ("nation", "fk_nation_region",
     "SELECT count(*) FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)"),
    ("clubs", "primary_key",
     "SELECT count(*) - count(DISTINCT club_id) FROM clubs"),
    ("clubs", "unique_name",
     "SELECT count(name) - count(DISTINCT name) FROM clubs"),
    ("clubs", "not_null",
     "SELECT 8 * count(*) - count(club_id) - count(name) - count(short_name) - count(stadium) - count(capacity) - count(city) - count(founded_year) - count(primary_color) FROM clubs"),
    ("clubs", "check_capacity_positive",
     "SELECT count(*) FROM clubs WHERE capacity <= 0"),
    ("clubs", "check_founded_year",
     "SELECT count(*) FROM clubs WHERE founded_year < 1800"),
    ("players", "primary_key",
     "SELECT count(*) - count(DISTINCT player_id) FROM players"),
    ("players", "not_null",
     "SELECT 11 * count(*) - count(player_id) - count(club_id) - count(name) - count(position) - count(nationality) - count(jersey_number) - count(appearances) - count(goals) - count(assists) - count(goal_contributions) - count(goals_per_game) FROM players"),
    ("players", "check_appearances_non_negative",
     "SELECT count(*) FROM players WHERE appearances < 0"),
    ("players", "check_goals_non_negative",
     "SELECT count(*) FROM players WHERE goals < 0"),
    ("players", "check_assists_non_negative",
     "SELECT count(*) FROM players WHERE assists < 0"),
    ("players", "fk_players_club",
     "SELECT count(*) FROM players WHERE club_id NOT IN (SELECT club_id FROM clubs)"),
    ("matches", "primary_key",
     "SELECT count(*) - count(DISTINCT match_id) FROM matches_c"),
    ("matches", "not_null",
     "SELECT 10 * count(*) - count(match_id) - count(gameweek) - count(home_club_id) - count(away_club_id) - count(match_date) - count(home_score) - count(away_score) - count(total_goals) - count(result) - count(status) FROM matches_c"),
    ("matches", "check_home_away_distinct",
     "SELECT count(*) FROM matches_c WHERE home_club_id = away_club_id"),
    ("matches", "check_home_score_non_negative",
     "SELECT count(*) FROM matches_c WHERE home_score < 0"),
    ("matches", "check_away_score_non_negative",
     "SELECT count(*) FROM matches_c WHERE away_score < 0"),
    ("matches", "fk_matches_home",
     "SELECT count(*) FROM matches_c WHERE home_club_id NOT IN (SELECT club_id FROM clubs)"),
    ("matches", "fk_matches_away",
     "SELECT count(*) FROM matches_c WHERE away_club_id NOT IN (SELECT club_id FROM clubs)"),
    ("standings", "primary_key",
     "SELECT count(*) - count(DISTINCT club_id) FROM standings"),
    ("standings", "unique_club_id",
     "SELECT count(club_id) - count(DISTINCT club_id) FROM standings"),
    ("standings", "not_null",
     "SELECT 12 * count(*) - count(club_id) - count(position) - count(played) - count(won) - count(drawn) - count(lost) - count(goals_for) - count(goals_against) - count(goal_difference) - count(points) - count(points_per_game) - count(win_percentage) FROM standings"),
    ("standings", "check_played_non_negative",
     "SELECT count(*) FROM standings WHERE played < 0"),
    ("standings", "check_points_non_negative",
     "SELECT count(*) FROM standings WHERE points < 0"),
    ("standings", "fk_standings_club",
     "SELECT count(*) FROM standings WHERE club_id NOT IN (SELECT club_id FROM clubs)"),
]

SQL["integrity_report"] = q("""
SELECT table_name, constraint_name, CAST(violations AS BIGINT) AS violations,
       CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (""" + "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS constraint_name, ({sql}) AS violations" for t, c, sql in _INTEGRITY) + ")")


SQL["audit_issue_log"] = _AUDIT.replace("""li_f AS (
  SELECT l_orderkey,""", """li_f AS (
  SELECT l_orderkey, l_linenumber,""").replace("""cu_f AS (
  SELECT (CASE""", """cu_f AS (
  SELECT c_custkey, (CASE""").replace("""oo_f AS (
  SELECT (CASE""", """oo_f AS (
  SELECT o_orderkey, (CASE""") + """
SELECT 'lineitem' AS dataset, CAST(l_orderkey AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR) AS pk,
       'Duplicate primary key ''l_orderkey,l_linenumber''=' || CAST(l_orderkey AS VARCHAR) || ','
         || CAST(l_linenumber AS VARCHAR) AS error
FROM li_f WHERE is_dup = 1
UNION ALL SELECT 'lineitem', CAST(l_orderkey AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR),
       'Validation failure: Quantity must be between 1 and 50' FROM li_f WHERE r1 = 1
UNION ALL SELECT 'lineitem', CAST(l_orderkey AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR),
       'Validation failure: Discount must be between 0 and 0.1' FROM li_f WHERE r2 = 1
UNION ALL SELECT 'lineitem', CAST(l_orderkey AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR),
       'Validation failure: Tax must be between 0 and 0.08' FROM li_f WHERE r3 = 1
UNION ALL SELECT 'lineitem', CAST(l_orderkey AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR),
       'Validation failure: Extended price must be positive' FROM li_f WHERE r4 = 1
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR),
       'Duplicate primary key ''c_custkey''=' || CAST(c_custkey AS VARCHAR) FROM cu_f WHERE is_dup = 1
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR),
       'Validation failure: Account balance cannot be negative' FROM cu_f WHERE r1 = 1
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR),
       'Validation failure: Nation key must be between 0 and 24' FROM cu_f WHERE r2 = 1
UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR),
       'Duplicate primary key ''o_orderkey''=' || CAST(o_orderkey AS VARCHAR) FROM oo_f WHERE is_dup = 1
UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR),
       'Validation failure: Total price must be positive' FROM oo_f WHERE r1 = 1
UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR),
       'Validation failure: Order status must be F, O or P' FROM oo_f WHERE r2 = 1"""


def _missing_issue_rows() -> str:
    specs = [("lineitem", "li", "CAST(l_orderkey AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR)",
              [("l_orderkey", False), ("l_partkey", False), ("l_suppkey", False), ("l_linenumber", False),
               ("l_returnflag", True), ("l_linestatus", True), ("l_shipdate", False)]),
             ("customer", "cu", "CAST(c_custkey AS VARCHAR)",
              [("c_custkey", False), ("c_name", True), ("c_nationkey", False), ("c_mktsegment", True)]),
             ("orders", "oo", "CAST(o_orderkey AS VARCHAR)",
              [("o_orderkey", False), ("o_custkey", False), ("o_orderdate", False), ("o_orderstatus", True)])]
    rows = []
    for ds, src, pk, fields in specs:
        for f, is_text in fields:
            cond = f"{f} IS NULL" + (f" OR trim({f}) = ''" if is_text else "")
            rows.append(f"UNION ALL SELECT '{ds}', {pk}, 'Missing required field: ''{f}''' FROM {src} WHERE {cond}")
    return "\n".join(rows)


SQL["audit_issue_log"] = SQL["audit_issue_log"] + "\n" + _missing_issue_rows()


# The league batches with dirt: the same functions of the keys as in the derivation, and the audit's
# messages and required fields written out by hand.
_DIRTY = ROLES + """,
dc0 AS (
  SELECT club_id * 10 AS ri, club_id, ' ' || name || ' ' AS name, lower(short_name) AS short_name, stadium,
         CASE WHEN club_id % 6 = 1 THEN -capacity ELSE capacity END AS capacity,
         CASE WHEN club_id % 5 = 3 THEN NULL WHEN club_id % 7 = 4 THEN 1799 ELSE founded_year END AS founded_year
  FROM clubs),
dc AS (SELECT * FROM dc0 UNION ALL SELECT * REPLACE (ri + 1 AS ri, -capacity AS capacity) FROM dc0 WHERE club_id % 8 = 0),
dp0 AS (
  SELECT player_id * 10 + 5 AS ri, player_id, club_id, CASE WHEN player_id % 101 = 7 THEN '  ' ELSE ' ' || name || ' ' END AS name,
         raw_position AS position, CASE WHEN player_id % 37 = 4 THEN 0 ELSE jersey_number END AS jersey_number, appearances,
         CASE WHEN player_id % 41 = 9 THEN -1 ELSE goals END AS goals,
         CASE WHEN player_id % 43 = 5 THEN NULL ELSE assists END AS assists
  FROM players0),
dp AS (SELECT * FROM dp0 UNION ALL
       SELECT * REPLACE (ri + CASE WHEN player_id % 2 = 0 THEN -1 ELSE 1 END AS ri, -3 AS appearances) FROM dp0 WHERE player_id % 13 = 0),
dm AS (
  SELECT match_id AS ri, match_id, CASE WHEN match_id % 29 = 3 THEN 0 ELSE gameweek END AS gameweek, home_club_id,
         CASE WHEN match_id % 31 = 6 THEN home_club_id ELSE away_club_id END AS away_club_id,
         CASE WHEN match_id % 23 = 2 THEN 'FT ' || s WHEN match_id % 47 = 1 THEN NULL WHEN match_id % 53 = 8 THEN 'postponed' ELSE s END AS raw_score
  FROM (SELECT *, home_score || CASE WHEN match_id % 7 = 0 THEN ':' ELSE ' - ' END || away_score AS s FROM matches)),
ds AS (
  SELECT club_id AS ri, club_id, CASE WHEN club_id % 9 = 2 THEN played + 1 ELSE played END AS played, won, drawn, lost,
         CASE WHEN club_id % 10 = 3 THEN points - 1 ELSE points END AS points
  FROM standings),
fc AS (SELECT club_id, min(ri) AS f FROM dc GROUP BY 1), fp AS (SELECT player_id, min(ri) AS f FROM dp GROUP BY 1),
audited AS (
  SELECT 'clubs' AS dataset, ri, CAST(club_id AS VARCHAR) AS pk,
         [CASE WHEN founded_year IS NULL THEN 'Missing required field: ''founded_year''' END] AS missing,
         [CASE WHEN ri <> f THEN 'Duplicate primary key ''club_id''=' || club_id END] AS dup,
         [CASE WHEN capacity <= 0 THEN 'Validation failure: Stadium capacity must be greater than 0' END,
          CASE WHEN founded_year IS NULL THEN 'Validator exception: Founded year must be 1800 or later (null or non-numeric input)'
               WHEN founded_year < 1800 THEN 'Validation failure: Founded year must be 1800 or later' END] AS rules
  FROM dc JOIN fc USING (club_id)
  UNION ALL
  SELECT 'players', ri, CAST(player_id AS VARCHAR),
         [CASE WHEN trim(name) = '' THEN 'Missing required field: ''name''' END],
         [CASE WHEN ri <> f THEN 'Duplicate primary key ''player_id''=' || player_id END],
         [CASE WHEN goals < 0 THEN 'Validation failure: Goals cannot be negative' END,
          CASE WHEN assists IS NULL THEN 'Validator exception: Assists cannot be negative (null or non-numeric input)' END,
          CASE WHEN appearances < 0 THEN 'Validation failure: Appearances cannot be negative' END,
          CASE WHEN jersey_number NOT BETWEEN 1 AND 99 THEN 'Validation failure: Jersey number must be between 1 and 99' END]
  FROM dp JOIN fp USING (player_id)
  UNION ALL
  SELECT 'matches', ri, CAST(match_id AS VARCHAR),
         [CASE WHEN raw_score IS NULL THEN 'Missing required field: ''raw_score''' END], [],
         [CASE WHEN home_club_id = away_club_id THEN 'Validation failure: Home and away clubs must be distinct' END,
          CASE WHEN raw_score IS NULL OR NOT regexp_full_match(raw_score, '[0-9]+ *[-:] *[0-9]+') THEN 'Validation failure: Score format must match ''X - Y''' END,
          CASE WHEN gameweek NOT BETWEEN 1 AND 38 THEN 'Validation failure: Gameweek must be between 1 and 38' END]
  FROM dm
  UNION ALL
  SELECT 'standings', ri, CAST(club_id AS VARCHAR), [], [],
         [CASE WHEN played <> won + drawn + lost THEN 'Validation failure: Games played invariant: played == won + drawn + lost' END,
          CASE WHEN points <> won * 3 + drawn THEN 'Validation failure: Points invariant: points == (won * 3) + drawn' END]
  FROM ds),
issues AS (
  SELECT dataset, ri, pk, list_filter(missing, lambda x: x IS NOT NULL) AS missing, list_filter(dup, lambda x: x IS NOT NULL) AS dup,
         list_filter(rules, lambda x: x IS NOT NULL) AS rules FROM audited)
"""

SQL["league_audit_metrics"] = _DIRTY + """
SELECT dataset, count(*) AS source_count, count(*) FILTER (WHERE n = 0) AS valid_count, count(*) FILTER (WHERE n > 0) AS rejected_count,
       CAST(sum(len(missing)) AS BIGINT) AS missing_fields_count, CAST(sum(len(dup)) AS BIGINT) AS duplicate_count,
       CAST(sum(len(rules)) AS BIGINT) AS validation_error_count
FROM (SELECT *, len(missing) + len(dup) + len(rules) AS n FROM issues) GROUP BY dataset"""

SQL["league_audit_issues"] = _DIRTY + """
SELECT dataset, CAST(ri AS BIGINT) AS record_index, pk, unnest(missing || dup || rules) AS error FROM issues"""

SQL["league_quarantine"] = _DIRTY + """
SELECT player_id, name, CAST(jersey_number AS BIGINT) AS jersey_number, CAST(appearances AS BIGINT) AS appearances,
       CAST(goals AS BIGINT) AS goals, CAST(assists AS BIGINT) AS assists,
       array_to_string(missing || dup || rules, '; ') AS reasons, CAST(ri AS BIGINT) AS record_index
FROM issues JOIN dp USING (ri) WHERE dataset = 'players' AND len(missing) + len(dup) + len(rules) > 0"""

SQL["league_first_wins"] = _DIRTY + """
SELECT player_id, CAST(appearances AS BIGINT) AS appearances, CAST(goals AS BIGINT) AS goals
FROM issues JOIN dp USING (ri) WHERE dataset = 'players' AND len(missing) + len(dup) + len(rules) = 0"""

SQL["cleaner_assertions"] = _DIRTY + """
SELECT 'clubs' AS dataset, 'invalid stadium capacity' AS assertion, count(*) AS violations FROM dc WHERE capacity <= 0
UNION ALL SELECT 'clubs', 'invalid founded_year', count(*) FROM dc WHERE founded_year < 1850 OR founded_year > 2025
UNION ALL SELECT 'players', 'negative values in player column goals', count(*) FROM dp WHERE goals < 0
UNION ALL SELECT 'players', 'negative values in player column assists', count(*) FROM dp WHERE assists < 0
UNION ALL SELECT 'players', 'negative values in player column appearances', count(*) FROM dp WHERE appearances < 0
UNION ALL SELECT 'players', 'negative values in player column jersey_number', count(*) FROM dp WHERE jersey_number < 0
UNION ALL SELECT 'matches', 'home club equals away club', count(*) FROM dm WHERE home_club_id = away_club_id
UNION ALL SELECT 'matches', 'unable to parse score', count(*) FROM dm WHERE raw_score = 'postponed'
UNION ALL SELECT 'standings', 'inconsistent games played', count(*) FROM ds WHERE played <> won + drawn + lost
UNION ALL SELECT 'standings', 'inconsistent points', count(*) FROM ds WHERE points <> won * 3 + drawn"""

SQL["top_scorers_view"] = SQL["top_scorers_full"]
SQL["league_table_view"] = SQL["league_table"]
SQL["club_analytics_view"] = SQL["club_analytics"]

SQL["order_gaps"] = """
WITH per AS (SELECT o_custkey, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey)
SELECT o_custkey FROM (SELECT o_custkey, lo, lead(hi) OVER (ORDER BY o_custkey) AS next_hi FROM per) WHERE next_hi > lo"""

_TEXT_COLS = "player_id, club_id, name, position, nationality, jersey_number, appearances, goals, assists, goal_contributions"
_ROW_TEXT = " || '|' || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in _TEXT_COLS.split(", "))

SQL["upsert_fingerprints"] = q(_UPSERT + f"""
, after AS (SELECT {_TEXT_COLS} FROM base WHERE player_id NOT IN (SELECT player_id FROM batch)
            UNION ALL SELECT {_TEXT_COLS} FROM batch),
other AS (SELECT * REPLACE (CASE WHEN player_id = (SELECT min(player_id) FROM after) THEN goals + 1 ELSE goals END AS goals) FROM after),
a AS (SELECT md5({_ROW_TEXT}) AS h FROM after), o AS (SELECT md5({_ROW_TEXT}) AS h FROM other),
fa AS (SELECT count(*) AS row_count, CAST(sum(CAST(('0x' || substr(h, 1, 15)) AS BIGINT)) AS VARCHAR) AS sum_a,
              CAST(sum(CAST(('0x' || substr(h, 16, 15)) AS BIGINT)) AS VARCHAR) AS sum_b FROM a),
fo AS (SELECT count(*) AS row_count, CAST(sum(CAST(('0x' || substr(h, 1, 15)) AS BIGINT)) AS VARCHAR) AS sum_a,
              CAST(sum(CAST(('0x' || substr(h, 16, 15)) AS BIGINT)) AS VARCHAR) AS sum_b FROM o)
SELECT step, fa.* FROM fa, (SELECT unnest(['run 1', 'run 2', 'run 3']) AS step)
UNION ALL SELECT 'one changed', fo.* FROM fo""")

SQL["record_order"] = "SELECT o_orderkey, row_number() OVER () - 1 AS record_index FROM orders"

SQL["clubs_with_newest"] = q("""
SELECT c.club_id, c.name,
       CAST((SELECT COUNT(*) FROM players p WHERE p.club_id = c.club_id) AS BIGINT) AS squad_count,
       CAST((SELECT COUNT(*) FROM sides s WHERE s.club_id = c.club_id) AS BIGINT) AS match_count,
       coalesce(t.newest, '') AS newest
FROM clubs c LEFT JOIN (
  SELECT club_id, string_agg(rn || ':' || match_id || ':' || match_date || ':' || opponent_id || ':' || goals_for || ':'
                             || goals_against, ';' ORDER BY rn) AS newest
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY club_id ORDER BY match_date DESC, match_id DESC) AS rn FROM sides)
  WHERE rn <= 3 GROUP BY club_id) t USING (club_id)
""")

SQL["club_matches_newest"] = q("""
SELECT match_id, match_date, home_club_id, away_club_id, result FROM matches_c
WHERE home_club_id = 3 OR away_club_id = 3 ORDER BY match_date DESC, match_id DESC LIMIT 20
""")

SQL["mixed_dates"] = """
SELECT CAST(o_orderkey AS BIGINT) AS match_id,
       CASE o_orderkey % 7
            WHEN 2 THEN strftime(date_trunc('minute', CAST(o_orderdate AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S')
            WHEN 3 THEN strftime(date_trunc('day', CAST(o_orderdate AS TIMESTAMP)), '%Y-%m-%d 00:00:00')
            WHEN 4 THEN strftime(date_trunc('minute', CAST(o_orderdate AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S')
            WHEN 6 THEN NULL
            ELSE strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') END AS match_date
FROM orders
"""

SQL["load_defaults"] = """
SELECT 'matches' AS table_name, CASE WHEN o_orderkey % 2 = 0 AND o_orderstatus IS NOT NULL THEN o_orderstatus ELSE 'FINISHED' END AS value,
       COUNT(*) AS row_count
FROM orders GROUP BY ALL
UNION ALL SELECT 'players', '0/0/0/0/0', COUNT(*) FROM customer HAVING COUNT(*) > 0
"""

SQL["layer_round_trip"] = q(""",
layers AS (
  SELECT 'bronze json' AS layer, player_id, goals, assists, length(name) + 2 AS name_chars, length(raw_position) AS position_chars, 1 AS stamped
  FROM players0
  UNION ALL
  SELECT l.layer, player_id, goals, assists, length(name), length(position), 0
  FROM players, (SELECT unnest(['silver csv', 'silver json']) AS layer) l
)
SELECT layer, COUNT(*) AS row_count, CAST(SUM(player_id) AS BIGINT) AS player_id, CAST(SUM(goals) AS BIGINT) AS goals,
       CAST(SUM(assists) AS BIGINT) AS assists, CAST(SUM(name_chars) AS BIGINT) AS name_chars,
       CAST(SUM(position_chars) AS BIGINT) AS position_chars, CAST(SUM(stamped) AS BIGINT) AS stamped
FROM layers GROUP BY layer
""")
