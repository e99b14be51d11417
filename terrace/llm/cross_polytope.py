"""Approximate nearest neighbours by largest inner product with cross-polytope hashing.

A unit vector is turned by a pseudo-rotation (three rounds of random signs and a fast
Hadamard transform) and hashed to its nearest signed axis.  Every candidate lies in one bucket of each
of TABLES tables; a query probes, in each table, the signed axes nearest to it.  What shares
a bucket meets in one task, where exact inner products are computed and the best of
the bucket are kept; the best over all tables are the answer.

* Inner products are brought to angles by norm classes: vectors whose norms lie within a factor of
  two share a class, and where norms in a class differ, a further coordinate
  ``sqrt(max^2 - norm^2)`` makes them equal.  Queries probe each class.
* Equal vectors are searched once and stand for all their ids (a list needs no more than the
  ``k + 1`` smallest), so a vector that a third of all rows share is one candidate.
* Buckets with more than BLOCK candidates or queries are dealt into blocks; every block of
  queries meets every block of candidates.  No candidate is dropped.
* The share of the axes that a query probes falls with the number n of vectors, as ``n ** -0.19`` (among more vectors the
  nearest are nearer, so fewer axes find them); the measured recall sets its level.  Below some 500 vectors the ``k`` nearest are
  a large part of all, and the share rises to 1 at ``k`` vectors.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part;
only vectors of the same length are compared; rows that repeat id and vector are one; ties
go to the smaller id; with fewer candidates than ``k`` all are returned; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TABLES = 8
#: Shares of the axes that are probed in a table, as (level, power) of ``k / n``; the larger one holds.
PROBED = ((0.258, 0.19), (1.0, 0.6))
BLOCK = 4096
K = 20
SEED = 11


def usable(v: Column) -> Column:
    """True for vectors that take part."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2)
        h *= 2
    return x.reshape(n, d) / np.sqrt(d)


def rotate(x: np.ndarray, table: int, dim: int) -> np.ndarray:
    """Pseudo-rotation number ``table`` of the rows, padded to ``dim`` (a power of two)."""
    y = np.zeros((len(x), dim))
    y[:, :x.shape[1]] = x
    signs = np.random.default_rng((SEED, table, dim)).choice([-1.0, 1.0], (3, dim))
    for s in signs:
        y = hadamard(y * s)
    return y


def lift(x: np.ndarray, top: float, even: bool) -> np.ndarray:
    """Candidates with the coordinate that makes their norms ``top``; as they are if norms are even."""
    if even:
        return x
    rest = np.sqrt(np.maximum(0.0, top * top - (x * x).sum(axis=1)))
    return np.column_stack([x, rest])


class Plan:
    """Norm classes of a table: for each (length, class) its largest norm, and whether all are equal."""

    def __init__(self, rows, k: int = K):
        self.k = k
        self.classes = {(r["dim"], r["cls"]): (r["top"], r["top"] - r["low"] <= 1e-5 * r["top"], r["n"]) for r in rows}

    def dim(self, d: int, even: bool) -> int:
        n = 2
        while n < d + (not even):
            n *= 2
        return n

    def probes(self, d: int, cls: int) -> int:
        """Axes that a query probes in a table."""
        _, even, n = self.classes[d, cls]
        axes = 2 * self.dim(d, even)
        return int(np.ceil(axes * probed_share(n, self.k)))


def probed_share(n: int, k: int) -> float:
    """Share of the axes of a table that a query probes among ``n`` vectors."""
    # k + 1: a query is no candidate of its own
    few = min(1.0, (k + 1) / max(1, n))
    return max(level * few ** power for level, power in PROBED)


def vectors(table: DataFrame) -> DataFrame:
    """Usable distinct (vec_id, embedding)."""
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & usable(F.col("embedding"))).distinct()


def unique_vectors(rows: DataFrame, k: int = K) -> DataFrame:
    """One row per distinct vector: rep (smallest id), ids (the k + 1 smallest), embedding, dim, norm class."""
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id")))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return (ranked.where(F.col("r") <= k + 1)
            .groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
            .select(F.element_at("ids", 1).alias("rep"), "ids", "embedding", F.size("embedding").alias("dim"), norm.alias("norm"))
            .withColumn("cls", F.floor(F.log2("norm") + 0.5).cast("int")))


_KEY = ("dim", "cls", "tab", "axis")
_ROW = "dim int, cls int, tab int, axis int, rep long"


def _arrays(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in pdf["embedding"]])


def _hashed(plan: Plan, as_query: bool, with_vector: bool):
    """Rows of a vector in the tables: its bucket as a candidate, or the buckets it probes as a query."""
    def run(batches):
        for pdf in batches:
            for (d, own), part in pdf.groupby(["dim", "cls"], sort=True):
                x, reps = _arrays(part), part["rep"].to_numpy()
                vecs = part["embedding"].to_numpy()
                for cls in ([c for dd, c in sorted(plan.classes) if dd == d] if as_query else [own]):
                    top, even, _ = plan.classes[d, cls]
                    dim = plan.dim(d, even)
                    y0 = x / np.linalg.norm(x, axis=1, keepdims=True) if as_query else lift(x, top, even)
                    for t in range(TABLES):
                        y = rotate(y0, t, dim)
                        signed = np.concatenate([y, -y], axis=1)   # axis a, and its negative at dim + a
                        if as_query:
                            p = plan.probes(d, cls)
                            axes = np.argsort(-signed, axis=1, kind="stable")[:, :p]
                        else:
                            axes = signed.argmax(axis=1)[:, None]
                        p = axes.shape[1]
                        out = pd.DataFrame({"dim": d, "cls": cls, "tab": t, "axis": axes.ravel(), "rep": np.repeat(reps, p)})
                        if with_vector:
                            out["embedding"] = np.repeat(vecs, p)
                        yield out
    return run


def _rank_block(k: int):
    def run(cand: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        if not len(cand) or not len(query):
            return pd.DataFrame({"query": pd.Series(dtype="int64"), "rep": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        x, reps = _arrays(cand), cand["rep"].to_numpy()
        out_q, out_r, out_s = [], [], []
        for a in range(0, len(query), 512):
            part = query.iloc[a:a + 512]
            q = _arrays(part.rename(columns={"q_embedding": "embedding"}))
            rough = q @ x.T
            if rough.shape[1] > k + 1:
                edge = np.partition(rough, -(k + 1), axis=1)[:, -(k + 1)][:, None]
            else:
                edge = np.full((len(q), 1), -np.inf)
            # every candidate that could be among the best, then its product summed in one fixed order
            i, j = np.nonzero(rough >= edge - 1e-9 * np.maximum(1.0, np.abs(edge)))
            exact = (q[i] * x[j]).sum(axis=1)
            out_q.append(part["q_rep"].to_numpy()[i])
            out_r.append(reps[j])
            out_s.append(exact)
        return pd.DataFrame({"query": np.concatenate(out_q), "rep": np.concatenate(out_r), "score": np.concatenate(out_s)})
    return run


def _blocks(rows: DataFrame, counts: DataFrame, mine: str, other: str) -> DataFrame:
    """``rows`` with blocks (c, q): each row in its own block of its side, and in every block of the other side."""
    r = rows.join(counts, list(_KEY), "left")
    n_mine = F.coalesce(F.col(f"{mine}_blocks"), F.lit(1))
    n_other = F.coalesce(F.col(f"{other}_blocks"), F.lit(1))
    r = r.withColumn(f"{mine}_block", F.pmod(F.xxhash64("rep"), n_mine).cast("int"))
    return r.withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), n_other - 1))).drop("c_blocks", "q_blocks")


def search(table: DataFrame, queries: Column, k: int = K, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found to each row for which ``queries`` holds."""
    rows = vectors(table)
    uniq = unique_vectors(rows, k)
    info = (uniq.groupBy("dim", "cls").agg(F.max("norm").alias("top"), F.min("norm").alias("low"), F.count(F.lit(1)).alias("n"))
            .collect())  # one row for each vector length and power of two of a norm
    plan = Plan(info, k)
    asked = rows.where(queries).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("asked"))
    who = asked.join(uniq.select("rep", "embedding"), F.col("asked") == F.col("embedding")).select("query_id", "rep")
    seekers = uniq.join(who.select("rep").distinct(), "rep", "left_semi")
    kind = table.schema["embedding"].dataType.simpleString()
    cols = ["rep", "embedding", "dim", "cls"]

    def placed(df: DataFrame, as_query: bool, with_vector: bool) -> DataFrame:
        schema = _ROW + (f", embedding {kind}" if with_vector else "")
        return df.select(*cols).mapInPandas(_hashed(plan, as_query, with_vector), schema)

    def crowded(as_query: bool, name: str) -> DataFrame:
        n = placed(seekers if as_query else uniq, as_query, False).groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"))
        return n.where(F.col("n") > block).select(*_KEY, F.ceil(F.col("n") / block).cast("int").alias(name))

    counts = crowded(False, "c_blocks").join(crowded(True, "q_blocks"), list(_KEY), "full")
    cand = _blocks(placed(uniq, False, True), counts, "c", "q")
    query = _blocks(placed(seekers, True, True), counts, "q", "c").select(
        *[F.col(c).alias(f"q_{c}") for c in _KEY], F.col("c_block").alias("qc"), F.col("q_block").alias("qq"),
        F.col("rep").alias("q_rep"), F.col("embedding").alias("q_embedding"))
    near = (cand.groupBy(*_KEY, "c_block", "q_block")
            .cogroup(query.groupBy(*[f"q_{c}" for c in _KEY], "qc", "qq"))
            .applyInPandas(_rank_block(k), "query long, rep long, score double"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    near = (near.groupBy("query", "rep").agg(F.max("score").alias("score"))
            .withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r"))
    # distinct vectors back to ids, and the list of a vector to each query that has it
    ids = near.join(uniq.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = (ids.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1)
             .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("found")))
    own = who.join(lists, who["rep"] == lists["query"]).select(
        "query_id", F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("found"))
    return own.select("query_id", F.posexplode("found").alias("pos", "f")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score"))
