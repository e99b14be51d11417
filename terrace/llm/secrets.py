"""Secret scans with a battery of randomness tests.

Base kinds are found by their patterns (assign, access, hex).  Besides, every run of 20 or
more symbols of an encoding is a candidate.  Its encoding is inferred from the
symbols that it uses (hex, base32, base36 of either case, base62, base64; a run that mixes digits
or both cases but fits none of these is tested whole, over the symbols of its classes; runs of
one class of symbols are words or numbers and belong to none).  The parts of 20 or more letters
and digits between separators (- _ / +) are candidates too, because a run can hold a token after
a name or in a path; a run that is kept stands for its parts.  Three tests ask whether the symbols
of a candidate could be uniform and independent over the alphabet of its encoding:

* chi-squared uniformity, with the exact mean and variance for sparse counts;
* the number of runs above and below the middle of the alphabet;
* the serial correlation at lag 1.

The p-value of the battery is three times the smallest.  Short strings have little power, so
what is kept is decided for each encoding and class of length from all candidates of
the corpus: the share of random strings is estimated from the p-values above one half, and the
smallest cut-off is taken at which no more than ``fdr`` of the strings kept are estimated
not to be random.  Kept strings that touch no base span are added as kind ``random``.

Only DataFrame functions are used.  The texts are read once; what they give, one
short row per document, is written to a table, and the cut-offs (one for each of at most
10 encodings x 8 classes of length) are read from it.

Defined cases: null or empty text has no spans; equal rows give equal results; an empty
table gives no rows; a very long text costs its length, and n log n for n matches in it; offsets are code points; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.session import materialize

#: Base patterns (fixed values).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "random")

LEAST_RUN = 20
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}" % LEAST_RUN
#: A part of a run: letters and digits up to a separator on at least one side.
PART = r"(?<![A-Za-z0-9])(?:(?<=[+/_-])[A-Za-z0-9]{%d,}+|[A-Za-z0-9]{%d,}+(?=[+/_-]))" % (LEAST_RUN, LEAST_RUN)
_UP, _LOW, _DIG = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = {
    "hex": _DIG + "abcdef",
    "base32": _UP + "234567",
    "base36": _DIG + _LOW,
    "base36up": _DIG + _UP,
    "base52": _UP + _LOW,
    "base62": _UP + _LOW + _DIG,
    # with separators, - read as + and _ as /
    "base38": _DIG + _LOW + "+/",
    "base38up": _DIG + _UP + "+/",
    "base54": _UP + _LOW + "+/",
    "base64": _UP + _LOW + _DIG + "+/",
}
SEPARATED = ("base38", "base38up", "base54", "base64")
LENGTH_CLASSES = (20, 24, 32, 40, 48, 64, 96, 128)
CUT_OFFS = (0.0001, 0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2)
_SPAN = "array<struct<start:int,end:int,hit:string>>"
_KEPT = "array<struct<start:int,kind:int,end:int>>"
_FAR = 2**31 - 1


def _let(x: Column, f) -> Column:
    """``f`` of ``x``, which is computed once however often ``f`` uses it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def running(values: Column, join, neutral: int) -> Column:
    """Running totals of an int array under the associative ``join``: in each round every place takes in
    the place 1, 2, 4, ... before it, so n values cost n log n."""
    steps = F.array(*[F.lit(1 << r) for r in range(31)])
    return _let(values, lambda v: F.aggregate(
        F.filter(steps, lambda p: p < F.size(v)), v,
        lambda a, p: F.zip_with(a, F.concat(F.array_repeat(F.lit(neutral), p), F.slice(a, 1, F.size(a) - p)), lambda x, y: join(x, y))))


def located(text: Column, pattern: str, least: Column | None = None, group: int = 0) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as (start, end, hit): a match ends
    where the texts between the matches and the matches up to it end.  ``hit`` is ``group``."""
    def walked(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(hits))
        ends = running(F.zip_with(gaps, hits, lambda g, h: F.length(g) + F.length(h)), lambda a, b: a + b, 0)
        shown = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
        at = F.zip_with(ends, hits, lambda e, h: F.struct((e - F.length(h)).alias("start"), e.alias("end")))
        return F.zip_with(at, shown, lambda x, h: F.struct(x["start"].alias("start"), x["end"].alias("end"), h.alias("hit")))

    none = F.array().cast(_SPAN)
    return F.when(text.rlike(pattern), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), walked)).otherwise(none)


def _erfc(x: Column) -> Column:
    """Complementary error function for x >= 0 by the usual rational approximation (error below 2e-7)."""
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return poly * F.exp(-x * x)


def _p(z: Column) -> Column:
    """Two-sided p-value of a standard normal value."""
    return _erfc(F.abs(z) / F.sqrt(F.lit(2.0)))


def _encoding(s: Column) -> Column:
    """Name of the encoding whose symbols ``s`` uses; null if all its letters and digits are of one class."""
    digit, up, low = s.rlike("[0-9]"), s.rlike("[A-Z]"), s.rlike("[a-z]")
    plain = ~s.rlike("[-_+/]")
    return (F.when(digit & s.rlike("^([0-9a-f]*[a-f][0-9a-f]*|[0-9A-F]*[A-F][0-9A-F]*)$"), "hex")
            .when(digit & s.rlike("^[A-Z2-7]*[A-Z][A-Z2-7]*$"), "base32")
            .when(digit & up & low, F.when(plain, "base62").otherwise("base64"))
            .when(digit & low, F.when(plain, "base36").otherwise("base38"))
            .when(digit & up, F.when(plain, "base36up").otherwise("base38up"))
            .when(up & low, F.when(plain, "base52").otherwise("base54")))


def battery(spans: Column) -> Column:
    """(start, end, encoding, p) of the candidates in ``spans`` that have an encoding."""
    known = F.filter(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"), _encoding(s["hit"]).alias("enc"))),
        lambda s: s["enc"].isNotNull())
    abc = F.create_map(*[F.lit(x) for kv in ALPHABETS.items() for x in kv])
    coded = F.transform(known, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["enc"].alias("enc"), F.element_at(abc, s["enc"]).alias("abc"),
        F.when(s["enc"] == "hex", F.lower(s["hit"])).when(s["enc"].isin(*SEPARATED), F.translate(s["hit"], "-_", "+/"))
         .otherwise(s["hit"]).alias("hit")))
    # symbol values, alphabet size and length
    valued = F.transform(coded, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["enc"].alias("enc"),
        F.length(s["abc"]).cast("double").alias("k"), F.length(s["hit"]).cast("double").alias("n"),
        F.transform(F.filter(F.split(s["hit"], ""), lambda c: c != ""),
                    lambda c: F.call_function("instr", s["abc"], c) - 1).alias("v")))

    def total(a: Column, f) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + f(x).cast("double"))

    def tested(s: Column) -> Column:
        k, n, v = s["k"], s["n"], s["v"]
        head, tail = F.slice(v, 1, F.size(v) - 1), F.slice(v, 2, F.size(v) - 1)
        squares = total(F.array_distinct(v), lambda x: F.pow(F.size(F.filter(v, lambda y: y == x)).cast("double"), F.lit(2.0)))
        chi = k / n * squares - n
        # too even is no sign of words, so only the upper side counts
        z_chi = F.greatest(F.lit(0.0), (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n))
        changes = total(F.zip_with(head, tail, lambda a, b: (a * 2 >= k) != (b * 2 >= k)), lambda x: x.cast("int"))
        z_runs = (changes - (n - 1) / 2) / (F.sqrt(n - 1) / 2)
        mid = (k - 1) / 2
        z_serial = total(F.zip_with(head, tail, lambda a, b: (a - mid) * (b - mid)), lambda x: x) / ((k * k - 1) / 12 * F.sqrt(n - 1))
        p = F.least(F.lit(1.0), 3 * F.least(_p(z_chi), _p(z_runs), _p(z_serial)))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["enc"].alias("enc"), p.alias("p"))

    return F.transform(valued, tested)


def length_class(n: Column) -> Column:
    c = F.lit(LENGTH_CLASSES[0])
    for low in LENGTH_CLASSES[1:]:
        c = F.when(n >= low, low).otherwise(c)
    return c


def cut_offs(found: DataFrame, fdr: float) -> dict[str, float]:
    """For each stratum (encoding and class of length) the p-value above which its candidates are
    kept; strata without a cut-off that holds ``fdr`` are left out."""
    p = F.col("c.p")
    rows = (found.select(F.explode("tested").alias("c"))
            .groupBy(_stratum(F.col("c")).alias("stratum"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum((p > 0.5).cast("int")).alias("upper"),
                 *[F.sum((p > t).cast("int")).alias(f"kept{i}") for i, t in enumerate(CUT_OFFS)]).collect())
    cuts = {}
    for r in rows:
        random = min(float(r["n"]), 2.0 * r["upper"])  # strings that are estimated to be random
        for i, t in enumerate(CUT_OFFS):
            kept = r[f"kept{i}"]
            if kept and 1 - random * (1 - t) / kept <= fdr:
                cuts[r["stratum"]] = t
                break
    return cuts


def _stratum(c: Column) -> Column:
    return F.concat_ws(":", c["enc"], length_class(c["end"] - c["start"]).cast("string"))


def _kind(spans: Column, number: int, least: int) -> Column:
    """Spans that are long enough, as (start, kind number, end)."""
    return F.transform(F.filter(spans, lambda s: F.length(s["hit"]) >= least),
                       lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")))


def as_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, fdr: float = 0.1) -> DataFrame:
    """doc_id, ``base`` and ``spans``: arrays of (start, kind number, end), sorted."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = (docs.select("doc_id", located(text, ASSIGN, group=2).alias("assign"), located(text, ACCESS).alias("access"),
                         # shorter runs fail anyway and a run cannot begin inside another
                         located(text, HEX.replace("+", "{%d,}" % LEAST["hex"])).alias("hex"),
                         F.concat(located(text, RUN), located(text, PART)).alias("runs"))
             .select("doc_id", F.array_sort(F.concat(*[_kind(F.col(k), i, LEAST[k]) for i, k in enumerate(KINDS[:3])])).alias("base"),
                     battery(F.col("runs")).alias("tested")))
    found = materialize(found, "secrets")
    cuts = cut_offs(found, fdr)
    keep = F.filter("tested", lambda c: F.lit(False))
    if cuts:
        table = F.create_map(*[F.lit(x) for kv in sorted(cuts.items()) for x in kv])
        keep = F.filter("tested", lambda c: F.coalesce(c["p"] > table[_stratum(c)], F.lit(False)))
    random = F.transform(keep, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    added = F.when(F.size(random) > 0, _let(F.array_sort(F.concat("base", random)), lambda a: outermost(clear_of_base(a))))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce(added, F.array().cast(_KEPT)))).alias("spans"))


def clear_of_base(spans: Column) -> Column:
    """The random spans among ``spans`` (sorted) that overlap no base span: the base spans that begin before one
    end before it, and the next base span begins behind it."""
    reach = running(F.transform(spans, lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(0)), F.greatest, 0)
    following = F.reverse(running(F.reverse(F.transform(spans, lambda s: F.when(s["kind"] < 3, s["start"]).otherwise(_FAR))), F.least, _FAR))
    sides = F.zip_with(reach, following, lambda a, b: F.struct(a.alias("before"), b.alias("next")))
    seen = F.zip_with(spans, sides, lambda s, x: F.struct(
        s.alias("s"), ((s["kind"] == 3) & (x["before"] <= s["start"]) & (x["next"] >= s["end"])).alias("clear")))
    return F.transform(F.filter(seen, lambda x: x["clear"]), lambda x: x["s"])


def outermost(spans: Column) -> Column:
    """``spans`` without those inside another: by start, the longer first, a span that ends before the end reached lies inside one."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"))))

    def kept(a: Column) -> Column:
        ends = running(F.transform(a, lambda x: -x["back"]), F.greatest, 0)
        # (the end reached before it, the span)
        both = F.zip_with(F.slice(F.concat(F.array(F.lit(0)), ends), 1, F.size(a)), a, lambda to, x: F.struct(to.alias("to"), x.alias("x")))
        return F.transform(F.filter(both, lambda b: -b["x"]["back"] > b["to"]), lambda b: F.struct(
            b["x"]["start"].alias("start"), F.lit(3).alias("kind"), (-b["x"]["back"]).alias("end")))

    return _let(ordered, kept)
