from pyspark.sql import functions as F

from terrace.functions import scalars as S


def one(spark, expr, value, dtype="string"):
    d = spark.createDataFrame([(value,)], f"x {dtype}")
    return d.select(expr(F.col("x")).alias("y")).first()["y"]


def test_strip_unicode_whitespace(spark):
    assert one(spark, S.strip, "\tabc\n") == "abc"
    assert one(spark, S.strip, "  x y  ") == "x y"
    assert one(spark, S.strip, None) is None
    assert one(spark, S.strip, "\u3000abc\u00a0\x1f") == "abc"
    assert one(spark, S.strip, "a\u200bb") == "a\u200bb"  # zero-width space is not whitespace
    assert one(spark, S.strip, "") == ""


def test_capitalize_is_not_initcap(spark):
    assert one(spark, S.capitalize_first, "wing BACK") == "Wing back"
    assert one(spark, S.capitalize_first, "") == ""


def test_normalise_position(spark):
    for raw, want in [("FORWARD", "Forward"), (" midfielder ", "Midfielder"), ("gk", "Goalkeeper"),
                      ("Def", "Defender"), ("striker", "Forward"), ("MID", "Midfielder"),
                      ("fwd", "Forward"), ("wing BACK", "Wing back")]:
        assert one(spark, S.normalise_position, raw) == want


def test_parse_score(spark):
    d = spark.createDataFrame([("3 - 1",), ("0:0",), ("HT 1-0, FT 2-1",), ("  ",), (None,), ("abc",)], "s string")
    h, a = S.parse_score("s")
    got = [(r[0], r[1]) for r in d.select(h, a).collect()]
    assert got == [(3, 1), (0, 0), (1, 0), (0, 0), (0, 0), (None, None)]


def test_score_format_anchored(spark):
    d = spark.createDataFrame([("2 - 1",), (" 2:1 ",), ("HT 1-0",), (None,), ("",)], "s string")
    assert [r[0] for r in d.select(S.score_format_ok("s")).collect()] == [True, True, False, False, False]


def test_round_half_even_matches_pandas(spark):
    import pandas as pd
    vals = [0.125, 0.375, 2.675, 1.005, 0.5, 1.5, 2.5, 1 / 3, 2 / 3, 0.0]
    d = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in d.select(S.round_half_even("x", 2)).collect()]
    assert got == list(pd.Series(vals).round(2))
    assert one(spark, lambda c: S.round_half_even(c, 2), 0.125, "double") == 0.12


def test_avg_half_up(spark):
    d = spark.createDataFrame([(75, 3), (25, 2), (1, 20), (3, 20), (0, 0)], "s long, n long")
    assert [r[0] for r in d.select(S.avg_half_up("s", "n")).collect()] == [25.0, 12.5, 0.1, 0.2, None]


def test_ratio_zero_denominator_is_null(spark):
    d = spark.createDataFrame([(13, 5), (0, 0), (3, 0)], "a long, b long")
    assert [r[0] for r in d.select(S.ratio("a", "b", 2)).collect()] == [2.6, None, None]


def test_display_helpers(spark):
    d = spark.createDataFrame([(5, 1, 60704, "HOME_WIN"), (0, 5, None, None), (-3, 6, 1000, "DRAW")],
                              "gd int, r int, cap int, res string")
    rows = d.select(S.signed_display("gd"), S.zone_badge("r"), S.thousands("cap"),
                    S.result_label("res")).collect()
    assert [tuple(r) for r in rows] == [("+5", "top-4", "60,704", "HOME WIN"),
                                        ("0", "europa", "N/A", "FINISHED"),
                                        ("-3", None, "1,000", "DRAW")]


def test_split_form(spark):
    d = spark.createDataFrame([("W-D-L",), ("N/A",), (None,)], "f string")
    assert [r[0] for r in d.select(S.split_form("f")).collect()] == [["W", "D", "L"], [], []]


def test_parse_timestamp_formats(spark):
    d = spark.createDataFrame([("2024-08-16 20:00:00",), ("2024-08-16T20:00:00+01:00",), ("2024-08-16",),
                               ("16/08/2024",), ("garbage",)], "s string")
    got = [r[0] for r in d.select(S.format_ts(S.parse_timestamp("s"))).collect()]
    assert got == ["2024-08-16 20:00:00", "2024-08-16 20:00:00", "2024-08-16 00:00:00",
                   "2024-08-16 00:00:00", None]


def test_lenient_int(spark):
    d = spark.createDataFrame([(" 7 ",), ("5.5",), (None,), ("5",)], "s string")
    assert [r[0] for r in d.select(S.lenient_int("s")).collect()] == [7, None, None, 5]
