"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols (insult, threat, target, link, negation, report, quotation mark, other).  Five
transducers, each a transition table over symbols, read a clause (up to the next full stop, question or
exclamation mark, semicolon or line end; a mark right before a closing quotation mark ends none):

* negation marks insults and threats that stand shortly behind it;
* reported speech marks what stands behind a word of saying or naming, and what stands between quotation marks
  with such a word behind them ("You idiot", he said);
* target remembers whether the clause names somebody;
* threat remembers threats; insult remembers insults and whether a link (a form of to be, or this and that) stood before one.

Their composition, built state by state into one table, runs over the clause.  Its last state says what matched:
insults match beside a target, behind a link or beside another insult, threats only beside a target.
A single insult without any of these matches nothing: isolated words are not scored.  Clauses with such bare
insults match together, at half their weight, where a text has two or more of them.  A matched clause weighs the
sum of its insults and threats, more beside a target, less where marked as negated or reported.

What is learned, from a bounded sample of labelled training documents: the insult lexicon
(whole words, and stems of 4 to 6 letters for inflected ones) with log-odds weights,
counted by Spark, and a logistic curve over the matched clauses' weights.  Threats,
targets, links, negation and reported speech are given word lists.

Defined cases: null or empty text has no clause and gets the score of a text without matches;
without labelled rows of both kinds the curve keeps its starting values and the lexicon
only the seed words; repeated rows score alike; an empty table gives no rows; columns other
than those used are passed through or ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Hashable, Iterable
from dataclasses import dataclass, field
from functools import cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from terrace.llm.common import held_out, small_batches, struct_type, with_columns_free

#: Bounds of the labelled sample (documents by label) and of the lexicon.
SAMPLE_TOXIC, SAMPLE_CLEAN, LEXICON_TERMS = 3000, 6000, 4000
#: Terms that a worker counts before it hands them on.
PORTION = 50_000
#: Least log-likelihood ratio of a lexicon term against chance, and the least share of toxic documents in it.
LEAST_G2, LEAST_ODDS = 25.0, 3.0
MAX_WEIGHT = 6.0

#: Given word lists of the transducers.
SEED_INSULTS = {w: 3.0 for w in (
    "idiot", "idiots", "moron", "morons", "scum", "imbecile", "dumbass", "asshole", "bastard", "bitch", "retard",
    "worthless", "pathetic", "disgusting", "loser", "arschloch", "wichser", "connard", "salope", "cabron", "pendejo",
)}
THREATS = frozenset("kill murder hurt beat destroy stab shoot burn strangle töten umbringen tuer matar".split())
TARGETS = frozenset("you your yourself they them he she him her everyone people du dich dir ihr euch sie tu te toi "
                    "vous eux usted ustedes ellos".split())
LINKS = frozenset("is are was were be am being this that these those such bist ist sind seid war diese dieser es est "
                  "sont suis ce cet cette ces eres son este esta estos".split())
NEGATIONS = frozenset("not no never nobody isn wasn aren don doesn nicht kein keine nie pas jamais aucun nunca ningún".split())
REPORTS = frozenset("said says say called calls quoted quote reported writes wrote claims claimed word term means sagte nannte "
                    "wort dit appelle mot dijo llamó palabra".split())

#: Words, quotation marks (with a mark before them; an apostrophe inside a word is none) and ends of clauses.
_TOKEN = re.compile(r"[^\W_]+|[.,!?]?(?:[\"“”„«»]|(?<!\w)[\'‘]|(?<=[\w.,!?])[\'’](?!\w))|[.!?;\n]", re.UNICODE)
_WORD = re.compile(r"[^\W_]+|[.!?;\n]", re.UNICODE)
NEG_REACH, QUOTE_REACH = 2, 3
NEG_FACTOR, REPORT_FACTOR, TARGET_FACTOR, VOLLEY_FACTOR, THREAT_WEIGHT = 0.3, 0.5, 1.5, 0.5, 4.0

#: Input symbols; the transducers add marks to insults and threats.
OTHER, INSULT, THREAT, TARGET, LINK, NEGATION, REPORT, QUOTE = SYMBOLS = range(8)
NEGATED, REPORTED, QUOTED = 1, 2, 4
Symbol = tuple[int, int]    # kind, marks
_WEIGHED = (INSULT, THREAT)


@dataclass(frozen=True)
class Transducer:
    """A table (state, symbol) -> (state, symbol) that starts in ``start``; what it found is in its last state."""

    start: Hashable
    table: dict[tuple[Hashable, Symbol], tuple[Hashable, Symbol]]

    def run(self, symbols: Iterable[Symbol]) -> tuple[Hashable, list[Symbol]]:
        state, out = self.start, []
        for s in symbols:
            state, s = self.table[state, s]
            out.append(s)
        return state, out


def tabulated(start: Hashable, alphabet: Iterable[Symbol], step: Callable) -> Transducer:
    """The table of ``step(state, kind, marks) -> (state, marks)`` over the states that can be reached."""
    alphabet, table, open_, seen = list(alphabet), {}, [start], {start}
    while open_:
        state = open_.pop()
        for kind, marks in alphabet:
            after, marked = step(state, kind, marks)
            table[state, (kind, marks)] = after, (kind, marked)
            if after not in seen:
                seen.add(after)
                open_.append(after)
    return Transducer(start, table)


def outputs(t: Transducer) -> list[Symbol]:
    return sorted({s for _, s in t.table.values()})


def composed(first: Transducer, second: Transducer) -> Transducer:
    """``second`` reading what ``first`` puts out; states are pairs."""
    alphabet = {s for _, s in first.table}
    table, open_, seen = {}, [(first.start, second.start)], {(first.start, second.start)}
    while open_:
        a, b = open_.pop()
        for s in alphabet:
            a2, between = first.table[a, s]
            b2, out = second.table[b, between]
            table[(a, b), s] = (a2, b2), out
            if (a2, b2) not in seen:
                seen.add((a2, b2))
                open_.append((a2, b2))
    return Transducer((first.start, second.start), table)


def _negation(left, kind, marks):
    if kind == NEGATION:
        return NEG_REACH, marks
    return max(0, left - 1), marks | NEGATED if left and kind in _WEIGHED else marks


def _report(state, kind, marks):
    # said: a report word came before; quote: 0 outside, -1 inside, n > 0: n words behind a closing mark; told: a quotation was reported
    said, quote, told = state
    if kind == QUOTE:
        return (said, QUOTE_REACH if quote == -1 else -1, told), marks
    if kind in _WEIGHED:
        marks |= REPORTED if said else QUOTED if quote == -1 else 0
    if kind == REPORT:
        return (True, -1 if quote == -1 else 0, told or quote > 0), marks
    return (said, max(-1, quote - 1) if quote > 0 else quote, told), marks


def _target(seen, kind, marks):
    return seen or kind == TARGET, marks


def _threat(seen, kind, marks):
    return seen or kind == THREAT, marks


def _insult(state, kind, marks):
    # insults so far (at most 2 matter), a link came, an insult stood behind one
    n, link, linked = state
    if kind == INSULT:
        return (min(2, n + 1), link, linked or link), marks
    return (n, link or kind == LINK, linked), marks


def transducers() -> tuple[Transducer, ...]:
    """Negation, reported speech, target, threat and insult, each over what the ones before it put out."""
    out, alphabet = [], [(k, 0) for k in SYMBOLS]
    for start, step in ((0, _negation), ((False, 0, False), _report), (False, _target), (False, _threat), ((0, False, False), _insult)):
        out.append(tabulated(start, alphabet, step))
        alphabet = outputs(out[-1])
    return tuple(out)


def accepted(report, target: bool, threat: bool, insult) -> tuple[bool, bool, float, float]:
    """From the last states: do insults match, do threats, the factor of the clause and that of its quotations."""
    n, _, linked = insult
    return (n > 0 and (target or linked or n > 1), threat and target, TARGET_FACTOR if target else 1.0,
            REPORT_FACTOR if report[2] else 1.0)


class Machine:
    """The composition with numbered states: ``step[state * 8 + symbol]`` is (state * 8, marks), ``last[state]`` what it accepts."""

    def __init__(self):
        parts = transducers()
        whole = reduce(composed, parts)
        number = {s: i for i, s in enumerate(dict.fromkeys([whole.start, *(s for s, _ in whole.table)]))}
        self.step = [(0, 0)] * (8 * len(number))
        for (state, (kind, _)), (after, (_, marks)) in whole.table.items():
            self.step[8 * number[state] + kind] = 8 * number[after], marks
        self.last = [accepted(r, g, t, i) for ((((_, r), g), t), i) in number]

    def weight(self, clause: list[tuple[int, float]]) -> tuple[float, float]:
        """Weight of a clause of (symbol, weight), 0 where nothing matches, and the weight of its insult if that stands bare."""
        state, step = 0, self.step
        sums = [[0.0, 0.0], [0.0, 0.0]]    # insults and threats, each outside and inside quotations
        for symbol, w in clause:
            state, marks = step[state + symbol]
            if w:
                w *= (NEG_FACTOR if marks & NEGATED else 1.0) * (REPORT_FACTOR if marks & REPORTED else 1.0)
                sums[symbol == THREAT][bool(marks & QUOTED)] += w
        insults, threats, factor, quoted = self.last[state >> 3]
        insulting, threatening = (a + quoted * b for a, b in sums)
        return factor * (insults * insulting + threats * threatening), 0.0 if insults else insulting


@cache
def machine() -> Machine:
    return Machine()


_PLAIN, _ENDS = (OTHER, 0.0), frozenset(".!?;\n")


@dataclass
class Grammar:
    """The learned weights: ``words`` and ``stems`` map to insult weights, ``curve`` is the logistic."""

    words: dict[str, float] = field(default_factory=lambda: dict(SEED_INSULTS))
    stems: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, float, float] = (-3.0, 0.6, 0.8)

    def insult(self, word: str) -> float:
        w = self.words.get(word, 0.0)
        if self.stems:
            for n in (4, 5, 6):
                w = max(w, self.stems.get(word[:n], 0.0))
        return w

    def symbol(self, token: str) -> tuple[int, float]:
        """Symbol and weight of a word or quotation mark."""
        for kind, words in ((NEGATION, NEGATIONS), (REPORT, REPORTS), (TARGET, TARGETS), (LINK, LINKS)):
            if token in words:
                return kind, 0.0
        if token in THREATS:
            return THREAT, THREAT_WEIGHT
        if not token[0].isalnum():
            return QUOTE, 0.0
        weight = self.insult(token)
        return (INSULT, weight) if weight else _PLAIN

    def clauses(self, text: str) -> list[float]:
        """Weights of the matched clauses, and of a volley of bare insults in several clauses."""
        tokens = _TOKEN.findall(text.lower())
        symbols = {t: self.symbol(t) for t in set(tokens) if t not in _ENDS}
        if not any(w for _, w in symbols.values()):
            return []
        found, bare, clause, weighed = [], [], [], False
        for token in tokens + ["."]:
            if token in _ENDS:
                # only clauses that hold an insult or a threat can match
                if weighed:
                    total, alone = machine().weight(clause)
                    found += [total] if total else []
                    bare += [alone] if alone else []
                clause, weighed = [], False
                continue
            s = symbols[token]
            clause.append(s)
            weighed = weighed or s[1] > 0
        return found + ([VOLLEY_FACTOR * sum(bare)] if len(bare) > 1 else [])

    def features(self, text: str | None) -> tuple[float, float]:
        """Heaviest clause, and the logarithm of all clauses' weight."""
        found = self.clauses(text) if text else []
        return (max(found), math.log1p(sum(found))) if found else (0.0, 0.0)

    def score(self, text: str | None) -> float:
        a, b, c = self.curve
        x, y = self.features(text)
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def labelled_sample(docs: DataFrame, labels: DataFrame, n_toxic: int = SAMPLE_TOXIC, n_clean: int = SAMPLE_CLEAN) -> DataFrame:
    """At most so many training documents of each label, in the order of a hash of the id: (text, toxic).
    Copies count once, for else the words of a copied document would look like insults."""
    lab = (labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("h", F.xxhash64("doc_id")))
    picked = [lab.where(F.col("toxic") == t).orderBy("h", "doc_id").limit(n) for t, n in ((1, n_toxic), (0, n_clean))]
    # at most n_toxic + n_clean ids: a bound that holds at any size
    ids = F.broadcast(picked[0].unionAll(picked[1]))
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(ids, "doc_id")
    return (rows.groupBy("toxic", _copy_group("text").alias("group"))
            .agg(F.min_by("text", F.struct("h", "doc_id", "text")).alias("text")).select("text", "toxic"))


@pandas_udf(T.LongType())
def _copy_group(texts: pd.Series) -> pd.Series:
    """The smallest hash of three words in a row: mostly the same for near copies, and hardly ever for others."""
    out = []
    for text in texts:
        words = _WORD.findall(text.lower())
        runs = map(" ".join, zip(words, words[1:], words[2:])) if len(words) > 2 else [text]
        out.append(min(zlib.crc32(r.encode("utf-8", "surrogatepass")) for r in runs))
    return pd.Series(out, dtype="int64")


def _terms(batches):
    """Distinct words and stems of the documents with their labels, counted ahead in bounded portions."""
    counts: dict[tuple[str, bool], list[int]] = {}

    def portion():
        out = pd.DataFrame([(t, s, n[0], n[1]) for (t, s), n in counts.items()], columns=["term", "stem", "clean", "toxic"])
        counts.clear()
        return out

    for pdf in batches:
        for text, toxic in zip(pdf["text"], pdf["toxic"]):
            words = set(_WORD.findall(text.lower()))
            terms = {(w, False) for w in words if len(w) > 2}
            terms |= {(w[:n], True) for w in words for n in (4, 5, 6) if len(w) >= n}
            for t in terms:
                counts.setdefault(t, [0, 0])[int(toxic)] += 1
            if len(counts) > PORTION:
                yield portion()
    if counts:
        yield portion()


def learn_lexicon(sample: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems that stand in toxic documents beyond chance, with their log-odds."""
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return {}, {}
    counts = (sample.mapInPandas(_terms, "term string, stem boolean, clean long, toxic long")
              .groupBy("term", "stem").agg(F.sum("clean").alias("b"), F.sum("toxic").alias("a")))
    odds = F.log((F.col("a") + 0.5) / (n1 + 1.0)) - F.log((F.col("b") + 0.5) / (n0 + 1.0))
    seen = F.col("a") + F.col("b")

    def part(x, share):
        return F.when(x > 0, x * F.log(x / (seen * share))).otherwise(0.0)

    g2 = 2 * (part(F.col("a"), n1 / (n1 + n0)) + part(F.col("b"), n0 / (n1 + n0)))
    rows = (counts.withColumn("odds", odds).withColumn("g2", g2)
            .where((F.col("odds") >= LEAST_ODDS) & (F.col("g2") >= LEAST_G2))
            .orderBy(F.desc("g2"), "term", "stem").limit(LEXICON_TERMS).collect())
    words = {r["term"]: min(MAX_WEIGHT, r["odds"]) for r in rows if not r["stem"]}
    stems = {r["term"]: min(MAX_WEIGHT, r["odds"]) for r in rows if r["stem"]}
    return words, stems


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> tuple[float, float, float]:
    """Logistic regression by damped Newton steps; no negative slope: a heavier match never lowers a score."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = a.T @ (a * (p * (1 - p))[:, None]) + ridge * np.eye(3)
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w += step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
    return float(w[0]), float(max(w[1], 0.0)), float(max(w[2], 0.0))


def train(docs: DataFrame, labels: DataFrame) -> Grammar:
    """A grammar learned from the labelled training rows; reruns agree."""
    sample = labelled_sample(small_batches(docs), labels)
    words, stems = learn_lexicon(sample)
    g = Grammar(words=SEED_INSULTS | words, stems=stems)

    @pandas_udf(struct_type(x="double", y="double"))
    def features(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([g.features(t) for t in texts], columns=["x", "y"])

    # (x, y, label) counts: at most as many rows as the sample has
    rows = (sample.select(features("text").alias("f"), "toxic").groupBy("f.x", "f.y", "toxic").count()
            .orderBy("x", "y", "toxic").collect())
    n = np.array([r["count"] for r in rows], dtype=np.int64)
    y = np.repeat([float(r["toxic"]) for r in rows], n)
    x = np.repeat(np.array([(r["x"], r["y"]) for r in rows]).reshape(-1, 2), n, axis=0)
    if len(set(y)) == 2:
        g.curve = fit_curve(x, y)
    return g


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """``docs`` with a column toxicity (0 to 1)."""

    @pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([grammar.score(t) for t in texts], dtype="float64")

    return with_columns_free(small_batches(docs), ["toxicity"]).withColumn("toxicity", of(F.col("text")))


def drop_toxic(docs: DataFrame, labels: DataFrame, training: DataFrame | None = None, limit: float = 0.5) -> DataFrame:
    """``docs`` without the documents that score ``limit`` or more."""
    scored = score(docs.withColumn("_all", F.struct(*docs.columns)), train(training if training is not None else docs, labels))
    return scored.where(F.col("toxicity") < limit).select("_all.*")
