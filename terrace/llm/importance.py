"""Quality by importance resampling of hashed n-gram models.

Two generative models are counted over the same hashed n-grams (words, word pairs, and the shapes
of tokens and token pairs): one over the raw corpus, all of it, and one over target
documents, a bounded sample of the training documents labelled as good.  A document's
importance is the log-ratio of its likelihoods, averaged over its n-grams.

``resample`` draws a share of the documents without replacement in proportion to their
importance weights, by Gumbel top-k: noise from a hash of the id is added to the log-weight and
the k largest sums are kept.  The k-th sum is found from a histogram over all documents;
only the documents in its one bin are ranked.

``score`` maps the log-ratio to the probability of a good label (a logistic curve fitted on a
bounded labelled sample).

Defined cases: null or empty text has no n-grams, log-ratio ``EMPTY`` and so the lowest
score, and is drawn last; without target rows all log-ratios are 0; repeated rows share
their noise and count as rows of their own; an empty table gives no rows; columns other than those
used are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from terrace.llm.common import held_out, struct_type
from terrace.llm.hashing import U, mix, spelled
from terrace.operators.rows import repeat_rows
from terrace.session import materialize

BUCKETS = 1 << 15
SMOOTH = 1.0
TARGET_DOCS, OTHER_DOCS = 6000, 6000   # bounds of the labelled sample
TEMPERATURE = 20.0                     # n-grams whose evidence a weight stands for
KEEP = 0.5
EMPTY = -20.0
BIN = 64                               # histogram bins for one unit of a noisy log-weight
EDGE_ROWS = 100_000                    # rows of the histogram's edge that are ranked in one task
SUB, FINER = 4096, 4                   # parts of a bin at each refinement, and refinements at most: then doubles end
GROUP = 1_500_000                      # characters whose n-grams are counted together
SHAPE = 8                              # runs of one class of letters that make a token's shape

#: Classes of letters for shapes: capitals, small letters (and all beyond ASCII), digits; others are their own.
_CLASS = np.arange(129, dtype=np.uint64)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128] = 65, 97, 48, 97


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the blank-separated tokens of all texts, the tokens' lengths, where each begins, and the
    number of the text that it belongs to."""
    code = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    solid = (code != 32) & ((code < 9) | (code > 13))
    at = np.flatnonzero(solid)
    starts = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1])) if len(at) else at
    ends_of_texts = np.cumsum([len(t) + 1 for t in texts])
    return (code[at].astype(U), np.diff(np.append(starts, len(at))), starts,
            np.searchsorted(ends_of_texts, at[starts], side="right"))


def shapes(code: np.ndarray, n: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Hashes of the tokens' first runs of classes of letters."""
    kind = _CLASS[np.minimum(code, U(128)).astype(np.int64)]
    starts = np.concatenate([[True], kind[1:] != kind[:-1]])
    starts[begin] = True
    first = np.flatnonzero(starts)                       # runs, and the place of each within its token
    runs = np.add.reduceat(starts.astype(np.int64), begin)
    token = np.concatenate([[0], np.cumsum(runs)[:-1]])
    place = np.arange(len(first)) - np.repeat(token, runs)
    value = np.where(place < SHAPE, mix(kind[first] * U(0x9E3779B97F4A7C15) + place.astype(U)), U(0))
    return mix(np.add.reduceat(value, token))


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, and the number of the text that each belongs to.  Words and
    shapes are hashed into halves of their own."""
    texts = [t or "" for t in texts]
    code, n, begin, owner = _tokens(texts)
    if not len(n):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    shape = shapes(code, n, begin)
    words = spelled(*_tokens([t.lower() for t in texts])[:3])
    half = U(BUCKETS // 2)
    inner = np.flatnonzero(owner[1:] == owner[:-1])     # pairs inside a text

    def pairs(x):
        return mix(x[inner] * U(0x9E3779B97F4A7C15) + x[inner + 1])

    # a token that repeats the one before is an n-gram of its own kind
    again = inner[words[inner] == words[inner + 1]]
    grams = [words % half, pairs(words) % half, half + shape % half, half + pairs(shape) % half, np.full(len(again), half + U(7))]
    return (np.concatenate(grams).astype(np.int64),
            np.concatenate([owner, owner[inner], owner, owner[inner], owner[again]]))


def _pieces(text: str):
    """A text in pieces of bounded length, cut at blanks where there are any."""
    while len(text) > GROUP:
        cut = text.rfind(" ", 1, GROUP)
        cut = GROUP if cut < 0 else cut
        yield text[:cut]
        text = text[cut:]
    yield text


def _grouped(texts):
    """Pieces of the texts in groups of bounded size, with the number of each piece's text."""
    group, numbers, n = [], [], 0
    for i, text in enumerate(texts):
        for piece in _pieces(text or ""):
            group.append(piece)
            numbers.append(i)
            n += len(piece)
            if n >= GROUP:
                yield group, np.array(numbers)
                group, numbers, n = [], [], 0
    if group:
        yield group, np.array(numbers)


@dataclass
class Importance:
    ratio: np.ndarray                  # log target minus log raw probability of a bucket
    curve: tuple[float, float] = (0.0, 1.0)

    def log_ratios(self, texts) -> np.ndarray:
        n, total = np.zeros(len(texts)), np.zeros(len(texts))
        for group, numbers in _grouped(texts):
            grams, owner = ngrams(group)
            np.add.at(n, numbers, np.bincount(owner, minlength=len(group)))
            np.add.at(total, numbers, np.bincount(owner, self.ratio[grams], minlength=len(group)))
        return np.where(n > 0, total / np.maximum(n, 1), EMPTY)

    def score(self, x: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return np.where(x == EMPTY, 0.0, 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30))))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most TARGET_DOCS good and OTHER_DOCS other training documents, by a hash of the id: (text, good)."""
    lab = (labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
           .groupBy("doc_id").agg(F.max("quality").alias("good")).withColumn("h", F.xxhash64("doc_id")))
    picked = [lab.where(F.col("good") == g).orderBy("h", "doc_id").limit(n) for g, n in ((1, TARGET_DOCS), (0, OTHER_DOCS))]
    # at most TARGET_DOCS + OTHER_DOCS ids at any size
    ids = F.broadcast(picked[0].unionAll(picked[1]).select("doc_id", "good"))
    return docs.select("doc_id", "text").join(ids, "doc_id").select("text", "good")


def _counted(batches):
    """Counts of the n-grams of a whole partition."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for pdf in batches:
        for group, _ in _grouped(pdf["text"]):
            total += np.bincount(ngrams(group)[0], minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pd.DataFrame({"bucket": at, "n": total[at]})


def counts(docs: DataFrame) -> np.ndarray:
    """n-gram counts over all of ``docs``: at most BUCKETS numbers."""
    rows = (docs.select("text").mapInPandas(_counted, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(BUCKETS)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def train(docs: DataFrame, labels: DataFrame) -> Importance:
    sample = labelled_sample(docs, labels)
    target, raw = counts(sample.where(F.col("good") == 1)), counts(docs)
    model = Importance(np.zeros(BUCKETS))
    if target.sum() and raw.sum():
        model.ratio = (np.log((target + SMOOTH) / (target.sum() + SMOOTH * BUCKETS))
                       - np.log((raw + SMOOTH) / (raw.sum() + SMOOTH * BUCKETS)))

    @pandas_udf(struct_type(x="double"))
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"x": model.log_ratios(texts)})

    # no filter on x here: Catalyst would move it, and the function, below the join
    rows = sample.select(of("text").alias("f"), "good").select("f.x", "good").collect()
    x, y = np.array(sorted((r["x"], r["good"]) for r in rows if r["x"] != EMPTY)).reshape(-1, 2).T
    if len(set(y)) == 2:
        model.curve = fit_curve(x, y)
    return model


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Logistic curve by Newton steps, both labels weighing the same; its slope is never negative."""
    a = np.column_stack([np.ones(len(x)), x])
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = a.T @ (a * (share * p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, a.T @ (share * (y - p)) - 1e-3 * w)
        w += step * min(1.0, 10.0 / max(1e-9, np.abs(step).max()))
    return float(w[0]), float(max(0.0, w[1]))


def score(docs: DataFrame, model: Importance) -> DataFrame:
    """doc_id, log_ratio, score."""

    @pandas_udf(struct_type(log_ratio="double", score="double"))
    def of(texts: pd.Series) -> pd.DataFrame:
        x = model.log_ratios(texts)
        return pd.DataFrame({"log_ratio": x, "score": model.score(x)})

    return docs.select("doc_id", of(F.col("text")).alias("p")).select("doc_id", "p.*")


def resample(scored: DataFrame, keep: float = KEEP, temperature: float = TEMPERATURE, seed: int = 17,
             edge_rows: int = EDGE_ROWS) -> DataFrame:
    """``scored`` with noisy_weight and selected: the ``keep`` share of all rows with the largest
    log-weight plus Gumbel noise.  Only the histogram's edge is ranked, in one task: its bin is made finer until at most
    ``edge_rows`` different rows are in it."""
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    s = materialize(scored.withColumn("noisy_weight", F.col("log_ratio") * temperature - F.log(-F.log(u)))
                    .withColumn("bin", F.floor(F.col("noisy_weight") * BIN)), "weights")
    total = s.count()
    k = int(total * keep)
    # one row per bin; the bins' number depends on the range of the weights only
    run = Window.orderBy(F.desc("bin"))
    bins = s.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(run))
    edge = bins.where(F.col("upto") > k).orderBy(F.desc("bin")).limit(1).collect()
    if not edge:  # every row is kept, or there is none
        return s.withColumn("selected", F.lit(True)).drop("bin")
    edge_bin, left = edge[0]["bin"], k - (edge[0]["upto"] - edge[0]["n"])
    out = s.where(F.col("bin") != edge_bin).withColumn("selected", F.col("bin") > edge_bin)
    inside, n = s.where(F.col("bin") == edge_bin), edge[0]["n"]
    # finer bins inside the edge bin until it holds few rows, or rows whose weights differ by rounding at most
    for step in range(1, FINER + 1):
        if n <= edge_rows:
            break
        fine = F.floor((F.col("noisy_weight") * BIN - F.floor(F.col("noisy_weight") * BIN)) * float(SUB ** step))
        part = inside.withColumn("fine", fine)
        bins = part.groupBy("fine").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(Window.orderBy(F.desc("fine"))))
        # the bin holds more than what is left to select, so one of its parts reaches past that
        cut = bins.where(F.col("upto") > left).orderBy(F.desc("fine")).limit(1).collect()
        out = out.unionByName(part.where(F.col("fine") != cut[0]["fine"]).withColumn("selected", F.col("fine") > cut[0]["fine"]).drop("fine"))
        inside, n, left = part.where(F.col("fine") == cut[0]["fine"]).drop("fine"), cut[0]["n"], left - (cut[0]["upto"] - cut[0]["n"])
    # equal rows are counted: a row of the corpus can be there any number of times
    earlier = Window.orderBy(F.desc("noisy_weight"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    counted = inside.groupBy(*inside.columns).agg(F.count(F.lit(1)).alias("copies")) \
        .withColumn("chosen", F.greatest(F.lit(0), F.least(F.col("copies"), F.lit(left) - F.coalesce(F.sum("copies").over(earlier), F.lit(0)))))
    each = F.filter(F.array(F.struct(F.lit(True).alias("selected"), F.col("chosen").cast("long").alias("n")),
                            F.struct(F.lit(False).alias("selected"), (F.col("copies") - F.col("chosen")).cast("long").alias("n"))),
                    lambda x: x["n"] > 0)
    ranked = repeat_rows(counted.select(*inside.columns, F.explode(each).alias("x")).select(*inside.columns, "x.*"), "n")
    return out.unionByName(ranked).drop("bin")
