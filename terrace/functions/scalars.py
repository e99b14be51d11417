"""Column -> Column scalar functions (T*, R*, P14-P17).

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "strip", "is_blank", "capitalize_first", "normalise_position",
    "POSITION_ALIASES", "SCORE_SEARCH", "SCORE_FULL", "parse_score",
    "score_is_parseable", "score_format_ok", "DATE_FORMATS", "parse_timestamp",
    "format_ts", "round_half_even", "avg_half_up", "ratio", "signed_display",
    "zone_badge", "thousands", "result_label", "split_form", "score_label",
    "match_result", "strict_int", "lenient_int",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Python's str.strip() removes every character for which str.isspace() is true
# (29 code points); Spark's trim removes only U+0020 and Java's \s differs.  The
# set is generated by that rule, so strip() here is exactly Python's.
WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())
_WS_CLASS = "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in WHITESPACE) + "]"
_STRIP_RE = f"^{_WS_CLASS}+|{_WS_CLASS}+$"


def _is_ws(ch: Column) -> Column:
    return F.instr(F.lit(WHITESPACE), ch) > 0


def strip(c) -> Column:
    """Python-style strip.  The regex only runs for values that start or end
    with whitespace; everything else costs two one-character lookups."""
    c = col_of(c).cast("string")
    edge = _is_ws(F.substring(c, 1, 1)) | _is_ws(F.substring(c, -1, 1))
    return F.when(edge, F.regexp_replace(c, _STRIP_RE, "")).otherwise(c)


def is_blank(c) -> Column:
    """null, or a string that is empty after T1."""
    c = col_of(c)
    return c.isNull() | (strip(c) == F.lit(""))


def capitalize_first(c) -> Column:
    """T4: first character upper, the rest lower (str.capitalize, not initcap)."""
    c = col_of(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


# Position aliases -> canonical position (must equal the reference).
POSITION_ALIASES = {
    "goalkeeper": "Goalkeeper",
    "gk": "Goalkeeper",
    "defender": "Defender",
    "def": "Defender",
    "midfielder": "Midfielder",
    "mid": "Midfielder",
    "forward": "Forward",
    "fwd": "Forward",
    "striker": "Forward",
}


def normalise_position(c, aliases: dict | None = None) -> Column:
    """T5: dictionary lookup on the stripped lower-case key, else T4 of the stripped value.

    A small dictionary is an inline literal map; a large one is joined
    (``normalise_with_table``).
    """
    aliases = POSITION_ALIASES if aliases is None else aliases
    c = col_of(c)
    stripped = strip(c)
    mapping = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return F.coalesce(F.try_element_at(mapping, F.lower(stripped)), capitalize_first(stripped))


def normalise_with_table(df, column: str, aliases, out: str = "normalised"):
    """T5 with the dictionary in a table (alias, canonical; one row per alias, aliases lower-case): a join
    whose strategy Spark picks by the table's size."""
    stripped = strip(F.col(column))
    a = aliases.select(F.col("alias").alias("_alias"), F.col("canonical").alias("_canonical"))
    return (df.withColumn("_key", F.lower(stripped)).join(a, F.col("_key") == F.col("_alias"), "left")
            .withColumn(out, F.coalesce("_canonical", capitalize_first(stripped))).drop("_key", "_alias", "_canonical"))


# Score patterns (unanchored search for parsing, anchored for the audit).
SCORE_SEARCH = r"(\d+)\s*[-:]\s*(\d+)"
SCORE_FULL = r"^\d+\s*[-:]\s*\d+$"


def score_is_parseable(c) -> Column:
    """True when T7 can parse the value (blank counts as parseable to 0-0)."""
    c = col_of(c)
    return is_blank(c) | strip(c).rlike(SCORE_SEARCH)


def parse_score(c) -> tuple[Column, Column]:
    """(home, away) from the first `d - d` / `d:d` found; blank or null -> (0, 0).

    A non-blank value without a match yields null; callers report it as a
    violation (the reference raises).
    """
    c = col_of(c)
    s = strip(c)
    blank = is_blank(c)

    def part(i):
        g = F.regexp_extract(s, SCORE_SEARCH, i)
        return (F.when(blank, F.lit(0))
                .when(s.rlike(SCORE_SEARCH), g.try_cast("int"))
                .otherwise(F.lit(None).cast("int")))

    return part(1), part(2)


def score_format_ok(c) -> Column:
    """Anchored match on the stripped text; null fails (never null)."""
    return F.coalesce(strip(col_of(c)).rlike(SCORE_FULL), F.lit(False))


# Accepted date formats, tried in order.
DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm",
    "yyyy-MM-dd",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "dd/MM/yyyy HH:mm",
    "dd/MM/yyyy",
)
_OFFSET_RE = r"(Z|[+-]\d{2}:?\d{2})$"


def parse_timestamp(c, formats=DATE_FORMATS) -> Column:
    """First format that parses; fractional seconds dropped, a zone offset is
    dropped (wall clock kept), unparseable -> null."""
    s = F.regexp_replace(F.regexp_replace(strip(col_of(c)), _OFFSET_RE, ""), r"\.\d+$", "")
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats])


def format_ts(c, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(col_of(c), fmt)


def round_half_even(c, digits: int) -> Column:
    """Pandas Series.round -- rint(x * 10^d) / 10^d, half to even."""
    scale = float(10 ** digits)
    return F.rint(col_of(c) * F.lit(scale)) / F.lit(scale)


def avg_half_up(total, n, digits: int = 1) -> Column:
    """R2: SQL ROUND(AVG(x), d) for non-negative integers, in exact integer arithmetic.

    round_half_up(total / n, d) = floor((2 * 10^d * total + n) / (2 * n)) / 10^d;
    null when n = 0 (AVG of an empty group).
    """
    scale = 10 ** digits
    total, n = col_of(total).cast("long"), col_of(n).cast("long")
    q = F.floor((F.lit(2 * scale) * total + n) / (F.lit(2) * n))
    return F.when(n > 0, q.cast("double") / F.lit(float(scale)))


def ratio(num, den, digits: int, scale: float = 1.0) -> Column:
    """R1(num / den * scale); null when den = 0 (ANSI-safe)."""
    q = F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))
    if scale != 1.0:
        q = q * F.lit(float(scale))
    return round_half_even(q, digits)


def signed_display(c) -> Column:
    """P14: '+n' for positive values, plain text otherwise."""
    c = col_of(c)
    return F.when(c > 0, F.concat(F.lit("+"), c.cast("string"))).otherwise(c.cast("string"))


def zone_badge(rank) -> Column:
    """Rank 1-4 'top-4', rank 5 'europa', otherwise null."""
    r = col_of(rank)
    return F.when(r <= 4, F.lit("top-4")).when(r == 5, F.lit("europa"))


def thousands(c) -> Column:
    """60704 -> '60,704'; null -> 'N/A'."""
    return F.coalesce(F.format_number(col_of(c), 0), F.lit("N/A"))


def result_label(c) -> Column:
    """First '_' becomes a blank (HOME_WIN -> HOME WIN); null -> FINISHED."""
    return F.coalesce(F.regexp_replace(col_of(c), "^([^_]*)_", "$1 "), F.lit("FINISHED"))


def split_form(c) -> Column:
    """T11: 'W-D-L' -> ['W','D','L']; null or 'N/A' -> empty array."""
    c = col_of(c)
    return F.when(c.isNull() | (c == "N/A") | (c == ""), F.array().cast("array<string>")) \
        .otherwise(F.split(c, "-"))


def score_label(home, away) -> Column:
    """P11: '{home} - {away}'."""
    return F.concat_ws(" - ", col_of(home).cast("string"), col_of(away).cast("string"))


def match_result(home, away) -> Column:
    """HOME_WIN / AWAY_WIN / DRAW."""
    h, a = col_of(home), col_of(away)
    return F.when(h > a, "HOME_WIN").when(h < a, "AWAY_WIN").otherwise("DRAW")


def lenient_int(c) -> Column:
    """Python int() of a value: ' 7 ' -> 7, 5.7 -> 5, '5.5'/None -> null."""
    c = col_of(c)
    return c.try_cast("long")


def strict_int(c) -> Column:
    """ANSI cast; raises on unparseable text (pandas astype(int))."""
    return col_of(c).cast("long")
