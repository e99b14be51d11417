"""Standings and last-5 form against a brute-force per-club loop (the
reference's algorithm: filter the club's matches, sort by date, take the last
five), on random matches where one club plays in a third of them."""

import random
from collections import defaultdict

import pytest

from terrace.operators.clean import clean_matches, clean_standings, standings_from_matches
from terrace.schemas import RAW_SCHEMAS


def brute(matches):
    by_club = defaultdict(list)
    for mid, h, a, date, hs, as_ in matches:
        by_club[h].append((date, mid, hs, as_, True))
        by_club[a].append((date, mid, hs, as_, False))
    out = {}
    for club, ms in by_club.items():
        ms.sort()  # date, then match_id breaks ties
        letters, won = [], 0
        for date, mid, hs, as_, home in ms:
            gf, ga = (hs, as_) if home else (as_, hs)
            letters.append("W" if gf > ga else "L" if gf < ga else "D")
        w, d = letters.count("W"), letters.count("D")
        out[club] = (len(ms), w, d, letters.count("L"), 3 * w + d, "-".join(letters[-5:]))
    return out


@pytest.mark.parametrize("seed", [5, 6])
def test_standings_and_form_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for mid in range(1, 801):
        h = 1 if rnd.random() < 1 / 3 else rnd.randrange(2, 40)
        a = rnd.choice([x for x in range(1, 40) if x != h])
        day = f"2024-{rnd.randrange(1, 13):02d}-{rnd.randrange(1, 28):02d} 15:00:00"  # many equal dates
        rows.append((mid, h, a, day, rnd.randrange(5), rnd.randrange(5)))
    raw = spark.createDataFrame([(m, 1, h, a, d, f"{hs} - {as_}", None, None, None) for m, h, a, d, hs, as_ in rows],
                                RAW_SCHEMAS["matches"]).repartition(5)
    matches = clean_matches(raw)
    st = clean_standings(standings_from_matches(matches), matches, checks="eager")
    got = {r["club_id"]: (r["played"], r["won"], r["drawn"], r["lost"], r["points"], r["form"])
           for r in st.collect()}
    assert got == brute(rows)
