"""Small literal batches for operator tests.

Fixed values: the league's sample standings snapshot and fixture list (10 clubs,
15 matches), with the golden league table they produce.
"""

STANDINGS_COLUMNS = ["club_id", "played", "won", "drawn", "lost", "goals_for", "goals_against", "points"]
STANDINGS = [
    (5, 5, 4, 1, 0, 13, 5, 13),
    (4, 5, 4, 0, 1, 10, 1, 12),
    (1, 5, 3, 2, 0, 8, 3, 11),
    (3, 5, 3, 1, 1, 11, 5, 10),
    (2, 5, 3, 1, 1, 9, 6, 10),
    (7, 5, 3, 1, 1, 7, 6, 10),
    (9, 5, 2, 3, 0, 8, 4, 9),
    (8, 5, 2, 1, 2, 9, 5, 7),
    (6, 5, 2, 1, 2, 5, 5, 7),
    (10, 5, 1, 1, 3, 5, 11, 4),
]

MATCH_COLUMNS = ["match_id", "gameweek", "home_club_id", "away_club_id", "match_date", "raw_score", "status"]
MATCHES = [
    (1001, 1, 6, 9, "2024-08-16 20:00:00", "1 - 0", "FINISHED"),
    (1002, 1, 1, 10, "2024-08-17 15:00:00", "2 - 0", "FINISHED"),
    (1003, 1, 3, 5, "2024-08-18 16:30:00", "0 - 2", "FINISHED"),
    (1004, 1, 7, 2, "2024-08-17 17:30:00", "1 - 0", "FINISHED"),
    (1005, 1, 8, 4, "2024-08-19 20:00:00", "1 - 1", "FINISHED"),
    (1006, 2, 5, 9, "2024-08-24 15:00:00", "4 - 1", "FINISHED"),
    (1007, 2, 2, 1, "2024-08-24 17:30:00", "0 - 2", "FINISHED"),
    (1008, 2, 4, 10, "2024-08-25 16:30:00", "2 - 0", "FINISHED"),
    (1009, 2, 10, 3, "2024-08-25 14:00:00", "2 - 6", "FINISHED"),
    (1010, 3, 1, 9, "2024-08-31 12:30:00", "1 - 1", "FINISHED"),
    (1011, 3, 6, 4, "2024-09-01 16:00:00", "0 - 3", "FINISHED"),
    (1012, 3, 7, 8, "2024-09-01 13:30:00", "2 - 1", "FINISHED"),
    (1013, 4, 8, 1, "2024-09-15 14:00:00", "0 - 1", "FINISHED"),
    (1014, 4, 5, 10, "2024-09-14 15:00:00", "3 - 1", "FINISHED"),
    (1015, 5, 5, 1, "2024-09-22 16:30:00", "2 - 2", "FINISHED"),
]

# position, club_id, points, goal_difference, points_per_game, win_percentage, form
GOLDEN_TABLE = [
    (1, 5, 13, 8, 2.6, 80.0, "W-W-W-D"),
    (2, 4, 12, 9, 2.4, 80.0, "D-W-W"),
    (3, 1, 11, 5, 2.2, 60.0, "W-W-D-W-D"),
    (4, 3, 10, 6, 2.0, 60.0, "L-W"),
    (5, 2, 10, 3, 2.0, 60.0, "L-L"),
    (6, 7, 10, 1, 2.0, 60.0, "W-W"),
    (7, 9, 9, 4, 1.8, 40.0, "L-L-D"),
    (8, 8, 7, 4, 1.4, 40.0, "D-L-L"),
    (9, 6, 7, 0, 1.4, 40.0, "W-L"),
    (10, 10, 4, -6, 0.8, 20.0, "L-L-L-L"),
]

CLUB_COLUMNS = ["club_id", "name", "short_name", "stadium", "capacity", "city", "founded_year",
                "primary_color"]


# The league's sample club batch (outer blanks kept as in the source).
CLUBS = [
    (1, " Arsenal FC ", "ARS", "Emirates Stadium", 60704, "London", 1886, "#EF0107"),
    (2, "Aston Villa", "AVL", "Villa Park", 42640, "Birmingham", 1874, "#95BFE5"),
    (3, "Chelsea FC", "CHE", "Stamford Bridge", 40343, "London", 1905, "#034694"),
    (4, "Liverpool FC", "LIV", "Anfield", 61276, "Liverpool", 1892, "#C8102E"),
    (5, "Manchester City", "MCI", "Etihad Stadium", 53400, "Manchester", 1880, "#6CABDD"),
    (6, "Manchester United", "MUN", "Old Trafford", 74310, "Manchester", 1878, "#DA291C"),
    (7, "Newcastle United", "NEW", "St. James' Park", 52305, "Newcastle upon Tyne", 1892, "#241F20"),
    (8, "Tottenham Hotspur", "TOT", "Tottenham Hotspur Stadium", 62850, "London", 1882, "#132257"),
    (9, "Brighton & Hove Albion", "BHA", "Amex Stadium", 31876, "Brighton", 1901, "#0057B8"),
    (10, "West Ham United", "WHU", "London Stadium", 62500, "London", 1895, "#7A263A"),
]

# The league's sample player batch
# (player_id, club_id, name, position, nationality, jersey_number, goals, assists, appearances).
PLAYERS = [
    (101, 1, " Bukayo Saka ", "FORWARD", "England", 7, 14, 9, 32),
    (102, 1, "Martin Ødegaard", "midfielder", "Norway", 8, 8, 10, 31),
    (103, 1, "William Saliba", "Defender", "France", 2, 2, 1, 35),
    (104, 1, "David Raya", "Goalkeeper", "Spain", 22, 0, 0, 32),
    (105, 3, "Cole Palmer", "MIDFIELDER", "England", 20, 22, 11, 33),
    (106, 3, "Nicolas Jackson", "Forward", "Senegal", 15, 14, 5, 35),
    (107, 3, "Moisés Caicedo", "midfielder", "Ecuador", 25, 1, 3, 34),
    (108, 4, "Mohamed Salah", "forward", "Egypt", 11, 18, 10, 32),
    (109, 4, "Virgil van Dijk", "Defender", "Netherlands", 4, 2, 2, 36),
    (110, 4, "Alexis Mac Allister", "Midfielder", "Argentina", 10, 5, 5, 33),
    (111, 5, " Erling Haaland ", "Forward", "Norway", 9, 27, 5, 31),
    (112, 5, "Kevin De Bruyne", "Midfielder", "Belgium", 17, 4, 10, 18),
    (113, 5, "Phil Foden", "Forward", "England", 47, 19, 8, 35),
    (114, 5, "Rodri", "Midfielder", "Spain", 16, 8, 9, 34),
    (115, 6, "Bruno Fernandes", "Midfielder", "Portugal", 8, 10, 8, 35),
    (116, 6, "Alejandro Garnacho", "Forward", "Argentina", 17, 7, 4, 36),
    (117, 6, "Kobbie Mainoo", "Midfielder", "England", 37, 3, 1, 24),
    (118, 2, "Ollie Watkins", "Forward", "England", 11, 19, 13, 37),
    (119, 7, "Alexander Isak", "Forward", "Sweden", 14, 21, 2, 30),
    (120, 8, "Son Heung-min", "Forward", "South Korea", 7, 17, 10, 35),
]


def clubs_rows(n=10):
    return list(CLUBS[:n])


def df(spark, rows, columns, schema=None):
    if schema is not None:
        return spark.createDataFrame(rows, schema)
    return spark.createDataFrame(rows, columns)


def players_rows():
    return list(PLAYERS)


def raw_batches(spark):
    from terrace.schemas import RAW_SCHEMAS
    drop = ["_ingested_at", "_source"]
    mk = lambda rows, n: spark.createDataFrame([r + (None, None) for r in rows], RAW_SCHEMAS[n]).drop(*drop)
    return {"clubs": mk(clubs_rows(), "clubs"), "players": mk(players_rows(), "players"),
            "matches": mk(MATCHES, "matches"),
            "standings": spark.createDataFrame(STANDINGS, ", ".join(f"{c} long" for c in STANDINGS_COLUMNS))}
