"""Language identification with a linear-chain conditional random field.

Every word of a text gets a label.  The emission scores come from features of the word: its
affixes, character n-grams, the word itself (all hashed) and its membership in the lexicons
of the most frequent words of each language; the transition scores are learned along with them.
Training sequences are put together from stretches of documents of different languages, so
that the chain learns how often code-switched text changes its language.  Forward-backward
gives each word's label probabilities; a document's language is the label with the largest
sum over its words, its score that label's share.

Training uses a bounded sample of labelled training documents (DOCS_PER_LANG of each
language, chosen by a hash of the id, STRETCHES stretches of STRETCH words each spread over
the whole text); texts are labelled whole.  A chain covers at most CHAIN words; longer
texts are read as consecutive chains.

Defined cases: null text or text without a letter is ``und`` with score 0; without any training
rows everything is ``und``; equal rows give equal results; an empty table gives no rows;
columns other than those used are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from terrace.llm.common import held_out, struct_type
from terrace.llm.hashing import U, letters, mix, spelled

DOCS_PER_LANG, MAX_LANGS = 400, 64
STRETCH, STRETCHES = 16, 16
SEQUENCE = 4          # stretches of a training sequence
CHAIN = 256
BUCKETS = 1 << 16
LEXICON = 200         # words of a language's lexicon
EPOCHS, RATE, RIDGE = 30, 0.5, 1e-5
CACHE = 200_000       # words whose scores a worker keeps
GROUP = 400_000       # words whose chains are walked together

_WORD = re.compile(r"[^\W\d_]+")


def word_features(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed features of lower-cased words, kind by kind as (buckets, first of each word): the word,
    its affixes of three letters, its pairs and triples of letters with the borders as letters (which holds the
    shorter affixes).  Every word has at least one feature of each kind."""
    code, n, begin = letters(words, "\x01", "\x02")
    two = (code[:-1] << U(21)) + code[1:]
    three = (two[:-1] << U(21)) + code[2:]
    last = begin + n - 1
    long = n > 4
    prefix = three[begin] * U(0x100000001B3) + np.where(long, code[np.minimum(begin + 3, last)], 0)
    suffix = three[last - 2] * U(0x100000001B3) + np.where(long, code[np.maximum(last - 3, begin)], 0)
    one = np.arange(len(words))

    def hashed(values, kind):
        return (mix(values + U(kind << 50)) % U(BUCKETS)).astype(np.int64)

    def inside(values, count, kind):
        # the values that begin in the first ``count`` places of each word
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        at = np.repeat(begin - first, count) + np.arange(count.sum())
        return hashed(values[at], kind), first

    return [(hashed(spelled(code, n, begin), 1), one), (hashed(prefix, 2), one), (hashed(suffix, 3), one),
            inside(two, n - 1, 4), inside(three, n - 2, 5)]


def word_scores(words: list[str], weights: np.ndarray, lexicons: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Emission scores of the words: the weights of their features, scaled by the root of their number."""
    total, number = np.zeros((len(words), weights.shape[1])), np.zeros(len(words))
    for buckets, first in word_features(words):
        total += np.add.reduceat(weights[buckets], first, axis=0)
        number += np.diff(np.append(first, len(buckets)))
    for i in [i for i, w in enumerate(words) if w in lexicons]:
        total[i] += weights[[BUCKETS + x for x in lexicons[words[i]]]].sum(axis=0)
        number[i] += len(lexicons[words[i]])
    return total / np.sqrt(number)[:, None]


@dataclass
class Crf:
    langs: list[str]
    weights: np.ndarray                 # (BUCKETS + languages, languages)
    move: np.ndarray                    # transition scores
    lexicons: dict[str, tuple[int, ...]]
    _index: dict[str, int] = field(default_factory=dict, repr=False)
    _kept: list[np.ndarray] = field(default_factory=list, repr=False)

    def __getstate__(self):
        return {"langs": self.langs, "weights": self.weights, "move": self.move, "lexicons": self.lexicons,
                "_index": {}, "_kept": []}

    def scores(self, words: list[str]) -> np.ndarray:
        """Emission scores of the words, from a bounded cache."""
        index = self._index
        if len(index) > CACHE:
            index.clear()
            self._kept.clear()
        if new := sorted(set(words).difference(index)):
            index.update(zip(new, range(len(index), len(index) + len(new))))
            self._kept = [np.concatenate([*self._kept, word_scores(new, self.weights, self.lexicons)])]
        return self._kept[0][np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))]

    def marginals(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Label probabilities of the words of each text."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        flat = [w for t in texts for w in t]
        if not flat or not self.langs:
            return [np.zeros((0, len(self.langs))) for _ in texts]
        e = self.scores(flat)
        starts, lengths = [], []
        for first, n in zip(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes):
            for a in range(0, n, CHAIN):
                starts.append(first + a)
                lengths.append(min(CHAIN, n - a))
        gamma = forward_backward(e, np.array(starts), np.array(lengths), self.move)[0]
        return np.split(gamma, np.cumsum(sizes)[:-1])


def forward_backward(e: np.ndarray, starts: np.ndarray, lengths: np.ndarray, move: np.ndarray):
    """Marginals of every position of chains laid out in ``e`` (position ``t`` of a chain is
    row ``start + t``), and the expected transitions.  Chains are walked side by side."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    k = e.shape[1]
    x = np.exp(e - e.max(axis=1, keepdims=True))
    m = np.exp(move)
    alpha = np.empty_like(x)
    scale = np.ones(len(x))
    active = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(int(lengths[0]))] if len(lengths) else []
    for t, n in enumerate(active):
        at = starts[:n] + t
        a = x[at] if t == 0 else (alpha[at - 1] @ m) * x[at]
        s = a.sum(axis=1)
        scale[at] = s
        alpha[at] = a / s[:, None]
    gamma = alpha.copy()
    moved = np.zeros((k, k))
    beta = np.ones_like(x)
    for t in range(len(active) - 1, 0, -1):
        at = starts[:active[t]] + t
        b = beta[at] * x[at] / scale[at][:, None]
        moved += (alpha[at - 1].T @ b) * m
        beta[at - 1] = b @ m.T
    gamma *= beta
    gamma /= gamma.sum(axis=1, keepdims=True)
    return gamma, moved


def training_sample(docs: DataFrame, per_lang: int = DOCS_PER_LANG) -> DataFrame:
    """At most ``per_lang`` training documents of each language, by a hash of the id; (lang, text)."""
    rows = (docs.select("doc_id", "text", "lang")
            .where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
            .withColumn("h", F.xxhash64("doc_id")))
    # ids only: salted so that a language with a third of all rows is cut down in many tasks first
    ids = rows.select("doc_id", "lang", "h").withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(64)))
    for part in (["lang", "salt"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*part).orderBy("h", "doc_id"))
        ids = ids.withColumn("rank", rank).where(F.col("rank") <= per_lang).drop("rank")
    picked = ids.groupBy("lang", "doc_id").agg(F.first("h").alias("h")).orderBy("h", "doc_id").limit(per_lang * MAX_LANGS)
    return rows.drop("h").join(F.broadcast(picked.drop("h")), ["lang", "doc_id"], "left_semi").select("doc_id", "lang", "text")


def _stretches(batches):
    for pdf in batches:
        rows = []
        for doc, lang, text in zip(pdf["doc_id"], pdf["lang"], pdf["text"]):
            words = _WORD.findall(text.lower())
            n = min(STRETCHES, -(-len(words) // STRETCH))
            for i in range(n):
                a = (len(words) - STRETCH) * i // max(1, n - 1) if len(words) > STRETCH else 0
                rows.append((doc, i, lang, " ".join(words[a:a + STRETCH])))
        yield pd.DataFrame(rows, columns=["doc_id", "i", "lang", "words"])


def train(docs: DataFrame) -> Crf:
    """A chain fitted by AdaGrad on the sample; reruns agree."""
    rows = (training_sample(docs).mapInPandas(
        _stretches, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, i int, lang string, words string")
            .orderBy("doc_id", "i", "lang", "words").collect())
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return Crf([], np.zeros((BUCKETS, 0)), np.zeros((0, 0)), {})
    k = len(langs)
    number = {x: i for i, x in enumerate(langs)}
    counts: dict[str, Counter] = {x: Counter() for x in langs}
    for r in rows:
        counts[r["lang"]].update(r["words"].split())
    lexicons: dict[str, tuple[int, ...]] = {}
    for x in langs:
        for w, _ in sorted(counts[x].items(), key=lambda wc: (-wc[1], wc[0]))[:LEXICON]:
            lexicons[w] = lexicons.get(w, ()) + (number[x],)
    # sequences: stretches in a fixed random order, SEQUENCE of them in a row
    order = np.random.default_rng(7).permutation(len(rows))
    types: dict[str, int] = {}
    word_of, label_of, starts, lengths = [], [], [], []
    for j, at in enumerate(order):
        if j % SEQUENCE == 0:
            starts.append(len(word_of))
            lengths.append(0)
        words = rows[at]["words"].split()
        word_of += [types.setdefault(w, len(types)) for w in words]
        label_of += [number[rows[at]["lang"]]] * len(words)
        lengths[-1] += len(words)
    word, label = np.array(word_of), np.array(label_of)
    starts, lengths = np.array(starts), np.array(lengths)
    kinds = word_features(list(types))
    known = [(BUCKETS + x, i) for i, t in enumerate(types) for x in lexicons.get(t, ())]
    flat = np.concatenate([f for f, _ in kinds] + [np.array([x for x, _ in known], dtype=np.int64)])
    owner = np.concatenate([np.repeat(np.arange(len(types)), np.diff(np.append(first, len(f)))) for f, first in kinds]
                           + [np.array([i for _, i in known], dtype=np.int64)])
    by_word = np.argsort(owner, kind="stable")
    flat, owner = flat[by_word], owner[by_word]
    sizes = np.bincount(owner, minlength=len(types))
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    share = 1 / np.sqrt(sizes)
    w, move = np.zeros((BUCKETS + k, k)), np.zeros((k, k))
    gw, gm = np.full_like(w, 1e-8), np.full_like(move, 1e-8)
    is_next = np.ones(len(word), dtype=bool)
    is_next[starts] = False
    nxt = np.flatnonzero(is_next)
    seen = np.zeros((k, k))
    np.add.at(seen, (label[nxt - 1], label[nxt]), 1.0)
    truth = np.zeros((len(word), k))
    truth[np.arange(len(word)), label] = 1.0
    for _ in range(EPOCHS):
        e = np.add.reduceat(w[flat], begin, axis=0) * share[:, None]
        gamma, moved = forward_backward(e[word], starts, lengths, move)
        by_type = np.column_stack([np.bincount(word, (truth - gamma)[:, c], len(types)) for c in range(k)]) * share[:, None]
        grad = np.column_stack([np.bincount(flat, by_type[owner, c], len(w)) for c in range(k)]) / len(starts) - RIDGE * w
        step = (seen - moved) / len(starts) - RIDGE * move
        gw += grad * grad
        gm += step * step
        w += RATE * grad / np.sqrt(gw)
        move += 0.2 * RATE * step / np.sqrt(gm)
    return Crf(langs, w.astype(np.float32), move, lexicons)


def _grouped(texts):
    """Texts as lists of words, in groups of bounded size."""
    group, n = [], 0
    for text in texts:
        words = _WORD.findall(text.lower()) if text else []
        if not any(c.isalpha() for w in words for c in w):   # superscripts and the like are no letters
            words = []
        group.append(words)
        n += len(words)
        if n >= GROUP:
            yield group
            group, n = [], 0
    if group:
        yield group


def identify(docs: DataFrame, model: Crf) -> DataFrame:
    """doc_id, lang_pred, score and the number of stretches in one language (n_segments)."""

    @pandas_udf(struct_type(lang_pred="string", score="double", n_segments="int"))
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for group in _grouped(texts):
            for p in model.marginals(group):
                if not len(p) or not model.langs:
                    rows.append(("und", 0.0, 0))
                    continue
                total = p.sum(axis=0)
                best = int(total.argmax())
                switches = int(np.count_nonzero(np.diff(p.argmax(axis=1))))
                rows.append((model.langs[best], float(min(1.0, total[best] / len(p))), switches + 1))
        return pd.DataFrame(rows, columns=["lang_pred", "score", "n_segments"])

    return docs.select("doc_id", of(F.col("text")).alias("p")).select("doc_id", "p.*")


def label_words(docs: DataFrame, model: Crf) -> DataFrame:
    """The stretches of a text in one language: doc_id, lang, first_word, last_word (from 0)."""

    @pandas_udf(T.ArrayType(struct_type(lang="string", first_word="int", last_word="int")))
    def runs(texts: pd.Series) -> pd.Series:
        out = []
        for group in _grouped(texts):
            for p in model.marginals(group):
                if not len(p) or not model.langs:
                    out.append([])
                    continue
                best = p.argmax(axis=1)
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(best)) + 1, [len(best)]])
                out.append([{"lang": model.langs[best[a]], "first_word": int(a), "last_word": int(b) - 1} for a, b in zip(cuts, cuts[1:])])
        return pd.Series(out, dtype=object)

    return docs.select("doc_id", F.explode(runs("text")).alias("s")).select("doc_id", "s.*")
