"""Exact n-gram Jaccard join as a metric-space join: pivots, Voronoi regions, triangle-inequality windows.

The Jaccard distance of shingle sets is a metric.  Two sets link at distance ``1 - t`` or less.

1. *First regions.*  In a corpus nearly all distances are 1, so document pivots alone cannot
   part it.  The first pivots are therefore partial sets: the space of shingle hashes is cut into classes,
   and the part of a document in a class is the pivot whose region it falls into.  Two linked
   sets of sizes a and c differ in at most ``g = floor((1 - t) / (1 + t) * (a + c))`` shingles, hence in at most
   ``g`` classes; a document that falls into the regions of its first ``g + 1`` non-empty
   classes shares one with each of its partners.  The number of classes follows the size
   band of the larger set, and a document near the border of a band (the window of sizes that can
   still link) is replicated into the next.  Where a document has too few non-empty classes, it takes
   all of them and those of a finer division, until it has enough.
2. Sharing a region says little where a common passage fills it.  The triangle inequality on further fixed
   pivots, parts of the hash space, thins the regions: by how much two sets' numbers of shingles in the
   parts differ is a lower bound of the number of shingles in which they differ.  Members of a region are
   compared with its smallest; those that could link with it are settled, the others are
   compared with all.  Only pairs whose bound leaves a link possible make a candidate.
3. Candidates are joined into connected groups.  Exact copies are one set throughout.
4. A group that fits a task is joined there: a pivot's distances to all members
   are computed at once, the triangle inequality on earlier pivots' distances rules members
   out, and the join ends when all are one component.
5. A larger group is cut by document pivots into Voronoi regions.  Members that link with their
   region's pivot are settled: they are one component, whatever their number, and are never
   compared with each other.  The others, and the members of other regions whose distance
   to the pivot exceeds that to their own by at most ``2 * (1 - t)``, are open: they meet the
   settled ones block by block, and among themselves they form a region that is cut again.
   Where pivots no longer part a region, its open members meet in pairs of blocks.
6. The links found are joined into components.

No pairs are emitted: a task returns one edge for each component that it merged into another.

Defined cases: a document without words has an empty set, links with nothing and is its own
component; one with fewer words than a shingle has the whole sequence as its one shingle; equal
sets always link; rows of a repeated id are documents of their own; rows without id link as all others do, but a
null id is no component id (a component of rows without id only has a null one); an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from terrace.llm.common import one_of_each, small_batches, without
from terrace.llm.hashing import U, mix
from terrace.session import materialize

WORDS, NUM, DEN = 4, 85, 100     # shingle length; threshold NUM / DEN
BAND = 1.5       # sizes of a band differ by at most this factor
LIMIT_SETS, LIMIT_SHINGLES = 2000, 1_000_000   # what one task joins
PIVOTS = 8
PARTS, PART_SIZE = 64, 4         # fixed pivots of the thinning: 64 at least, and one for every 4 to 8 shingles
LOOKUP_BUCKETS = 1 << 18         # proven bound of the broadcast that thins the texts


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.zeros(0, dtype=U)
    h = np.fromiter(map(xxhash.xxh64_intdigest, tokens), dtype=U, count=len(tokens))
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, n, dtype=U)
    for i in range(n):
        out = mix(out * U(0x9E3779B97F4A7C15) + h[i:len(h) - n + 1 + i])
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def band_of(n: int) -> int:
    return int(np.floor(np.log(n) / np.log(BAND) + 1e-9))


def band_top(band: int) -> int:
    return int(np.ceil(BAND ** (band + 1)))


def signatures(s: np.ndarray, num: int = NUM, den: int = DEN) -> np.ndarray:
    """Regions of a set's partial-set pivots, as 64-bit numbers."""
    n, out = len(s), []
    if not n:
        return np.zeros(0, dtype=np.int64)
    scrambled = mix(s + U(0x5851F42D4C957F2D))
    largest = n * den // num
    first = band_of(n)
    for band in range(first, band_of(largest) + 1):
        top = min(largest, band_top(band))
        need = (den - num) * (n + top) // (den + num) + 1
        widest = (den - num) * 2 * band_top(band) // (den + num) + 2
        classes, level = widest, 0
        while True:
            # classes are ranges of the hash space, so a class is a run of the sorted set
            c = _scaled(s, classes)
            begin = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            part = np.add.reduceat(scrambled, begin)
            size = np.diff(np.concatenate([begin, [n]])).astype(U)
            key = U((band << 40) | (level << 32))
            sig = mix(mix(part + size * U(0xD6E8FEB86659FD93)) ^ mix(c[begin] + key))
            if len(begin) >= need:
                out.append(sig[:need])
                break
            out.append(sig)
            classes, level = classes * 2, level + 1
    return np.concatenate(out).view(np.int64)


def sketch_of(s: np.ndarray) -> bytes:
    """Numbers of shingles in the parts, up to 255.  The number of parts is a power of two; adding up halves
    of a sketch gives the sketch of half as many parts."""
    parts = PARTS
    while parts * 2 * PART_SIZE <= len(s):
        parts *= 2
    return np.minimum(np.bincount((s & U(parts - 1)).astype(np.int64), minlength=parts), 255).astype(np.uint8).tobytes()


def _scaled(s: np.ndarray, classes: int) -> np.ndarray:
    """Class of each hash: its place in the hash space times the number of classes."""
    high = s >> U(32)
    return (high * U(classes)) >> U(32)


def profiles(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, hash of the text, set size, key of the set and its first regions; reads the texts once."""

    @pandas_udf(T.StructType([T.StructField("n", T.LongType()), T.StructField("key", T.LongType()),
                              T.StructField("sketch", T.BinaryType()), T.StructField("sigs", T.ArrayType(T.LongType()))]))
    def of(texts: pd.Series) -> pd.DataFrame:
        n, key, sketch, sigs = [], [], [], []
        for text in texts:
            s = shingles(text, words)
            n.append(len(s))
            key.append(_key(s) if len(s) else None)
            sketch.append(sketch_of(s))
            sigs.append(signatures(s, num, den))
        # nullable integers: floats would round the keys
        return pd.DataFrame({"n": n, "key": pd.array(key, dtype="Int64"), "sketch": sketch, "sigs": sigs})

    return small_batches(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), of("text").alias("p")).select("doc_id", "text_hash", "p.*")


def _key(s: np.ndarray) -> int:
    """64-bit name of a set."""
    return xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63)


# --- components -----------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(v, root) for all ends of ``edges`` (a, b): the smallest vertex that can be reached.

    Each round hooks a vertex to its smallest neighbour if that is smaller, follows the hooks twice further and
    moves the edges' ends along; it ends when no edge is left.  Rounds are written tables."""
    first = e = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                            .where("a <> b").distinct(), "edges")
    found = first.select(F.col("a").alias("v")).union(first.select("b")).distinct().withColumn("root", F.col("v"))
    while not e.isEmpty():
        hook = e.groupBy(F.col("b").alias("r")).agg(F.min("a").alias("to"))
        for _ in range(2):
            up = hook.select(F.col("r").alias("to"), F.col("to").alias("above"))
            hook = hook.join(up, "to", "left").select("r", F.coalesce("above", "to").alias("to"))
        hook = materialize(hook, "hooks")
        moved = e
        for end in ("a", "b"):
            moved = moved.join(hook.select(F.col("r").alias(end), F.col("to").alias(f"{end}_to")), end, "left")
        a, b = F.coalesce("a_to", "a"), F.coalesce("b_to", "b")
        e = materialize(moved.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct(), "edges")
        found = found.join(hook.select(F.col("r").alias("root"), "to"), "root", "left").select("v", F.coalesce("to", "root").alias("root"))
    return found


# --- joining inside a task ---------------------------------------------------

class _Region:
    """Sets of a region with numbered shingles; distances of a pivot to many members at once."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, dtype=U)
        names, ids = np.unique(flat, return_inverse=True)
        self.ids, self.begin = ids, np.concatenate([[0], np.cumsum(self.sizes)])
        self.mark = np.zeros(len(names), dtype=np.int64)
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)

    def common(self, i: int, members: np.ndarray) -> np.ndarray:
        """Intersection sizes of set ``i`` with ``members``."""
        own = self.ids[self.begin[i]:self.begin[i + 1]]
        self.mark[own] = 1
        if len(members) * 2 > len(self.sizes):
            got = np.bincount(self.owner, self.mark[self.ids], len(self.sizes)).astype(np.int64)[members]
        else:
            got = np.array([self.mark[self.ids[self.begin[m]:self.begin[m + 1]]].sum() for m in members], dtype=np.int64)
        self.mark[own] = 0
        return got


def link_region(sets: list[np.ndarray], home: np.ndarray, num: int = NUM, den: int = DEN,
                settled: np.ndarray | None = None) -> np.ndarray:
    """For each member the smallest member of its component, over all linked pairs with at least one
    end at ``home``; ``settled`` members are one component from the start."""
    n = len(sets)
    root = np.arange(n)
    todo = np.ones(n, dtype=bool)     # not yet a pivot
    if settled is not None and settled.any():
        root[settled] = np.flatnonzero(settled)[0]
        todo = ~settled               # every pair left has an open end
    region = _Region(sets)
    far = 1 - num / den + 1e-9
    seen: list[np.ndarray] = []       # distances to the first pivots
    order = np.argsort(-region.sizes, kind="stable")
    nearness = np.zeros(n)
    for _ in range(int(todo.sum())):
        if (root == root[0]).all():
            break
        # the next pivot: the member that most of the pivots before it were near to, for it links most
        left = np.flatnonzero(todo)
        i = int(left[np.argmax(nearness[left])]) if seen else int(order[todo[order]][0])
        todo[i] = False
        if len(seen) < PIVOTS:
            members = np.arange(n)
        else:
            others = root != root[i]
            if not home[i]:
                others &= home
            for d in seen:
                others &= np.abs(d - d[i]) <= far   # triangle inequality
            members = np.flatnonzero(others)
            if not len(members):
                continue
        common = region.common(i, members)
        union = region.sizes[i] + region.sizes[members] - common
        linked = members[(den * common >= num * union) & (home[members] | home[i]) & (members != i)]
        if len(seen) < PIVOTS:
            d = 1 - common / np.maximum(union, 1)
            seen.append(d)
            nearness += (d <= 2 * far)
        if len(linked):
            merge = np.isin(root, np.unique(root[np.append(linked, i)]))
            root[merge] = root[merge].min()
    return root


_EDGE = "a long, b long"


def _as_sets(column) -> list[np.ndarray]:
    return [np.asarray(s, dtype=np.int64).view(U) for s in column]


def _join_task(num: int, den: int):
    """Edges that a task's members add: one for each component merged into another."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # a member that has several parts here has the strongest: settled, then home
        pdf = (pdf.sort_values(["settled", "home", "key"], ascending=[False, False, True]).drop_duplicates("key").sort_values("key"))
        keys, settled = pdf["key"].to_numpy(), pdf["settled"].to_numpy(dtype=bool)
        root = link_region(_as_sets(pdf["shingles"]), pdf["home"].to_numpy(dtype=bool), num, den, settled)
        stands = ~settled
        stands[np.flatnonzero(settled)[:1]] = True   # one settled member stands for all
        own = np.flatnonzero(stands & (root != np.arange(len(root))))
        return pd.DataFrame({"a": keys[own], "b": keys[root[own]]})
    return run


def _assign_chunk(num: int, den: int, depth: int):
    """Regions of a chunk's members: (cell, key, home, settled), and the pivot that a settled member links with."""
    def run(pdf: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf) or not len(pivots):
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("region", "int64"), ("cell", "int64"), ("key", "int64"),
                                                                    ("home", "bool"), ("settled", "bool"), ("pivot", "int64"))})
        pivots = pivots.sort_values("pivot")
        region, m = _Region(_as_sets(list(pdf["shingles"]) + list(pivots["p_shingles"]))), len(pdf)
        distances, links = [], []
        for p in range(m, m + len(pivots)):
            common = region.common(p, np.arange(m + len(pivots)))[:m]
            union = region.sizes[p] + region.sizes[:m] - common
            distances.append(1 - common / np.maximum(union, 1))
            links.append(den * common >= num * union)
        # pivots that link are one: their regions are merged, and a member's distance is that to the nearest of them
        own = _as_sets(pivots["p_shingles"])
        group = link_region(own, np.ones(len(own), dtype=bool), num, den)
        names = np.unique(group)
        d = np.array([np.min([distances[p] for p in np.flatnonzero(group == g)], axis=0) for g in names])
        linked = np.array([np.any([links[p] for p in np.flatnonzero(group == g)], axis=0) for g in names])
        nearest = d.argmin(axis=0)
        at, who = np.nonzero(d <= d.min(axis=0) + 2 * (1 - num / den) + 1e-9)
        base, keys = int(pivots["p_region"].iloc[0]), pivots["p_key"].to_numpy()
        cells = np.array([xxhash.xxh64_intdigest(f"{base}|{depth}|{g}") - (1 << 63) for g in names])
        home = pdf["home"].to_numpy(dtype=bool)[who] & (nearest[who] == at)
        return pd.DataFrame({"region": base, "cell": cells[at], "key": pdf["key"].to_numpy()[who], "home": home,
                             "settled": home & linked[at, who], "pivot": keys[names[at]]})
    return run


def _chunks(sets, total, limit_sets: int, limit_shingles: int):
    return F.greatest(F.lit(1), F.ceil(F.greatest(sets / limit_sets, total / limit_shingles)).cast("int"))


def _block_tasks(rows: DataFrame, salt: int) -> DataFrame:
    """Tasks (task, key, home, settled) in which every pair of a cell's members with an open end meets.  ``rows``: cell,
    key, home, settled, s (settled members of the cell), s_blocks, u_blocks, again (open members
    need not meet each other here)."""
    block = F.pmod(F.xxhash64("key", F.lit(-1 - salt)), F.when(F.col("settled"), F.col("s_blocks")).otherwise(F.col("u_blocks"))).cast("int")
    rows = rows.withColumn("block", block)
    # settled and open members: every pair of a settled and an open block
    other = F.when(F.col("settled"), F.col("u_blocks")).otherwise(F.col("s_blocks"))
    across = (rows.where(F.col("s") > 0).withColumn("other", F.explode(F.sequence(F.lit(0), other - 1)))
              .select(F.xxhash64("cell", F.when(F.col("settled"), F.col("block")).otherwise(F.col("other")),
                                 F.when(F.col("settled"), F.col("other")).otherwise(F.col("block"))).alias("task"), "key", "home", "settled"))
    # open members among themselves: every pair of blocks
    among = (rows.where(~F.col("settled") & ~F.col("again"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("u_blocks") - 1)))
             .select(F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other"), F.lit("open")).alias("task"),
                     "key", "home", "settled"))
    return across.unionByName(among)


# --- thinning by fixed pivots -----------------------------------------------------

class _Sketches:
    """Sketches of many sets, by their number of parts."""

    def __init__(self, sketches, n: np.ndarray):
        self.n = n
        self.parts = np.fromiter(map(len, sketches), dtype=np.int64, count=len(sketches))
        self.row = np.zeros(len(sketches), dtype=np.int64)
        self.table: dict[tuple[int, int], np.ndarray] = {}
        for p in np.unique(self.parts):
            at = np.flatnonzero(self.parts == p)
            self.row[at] = np.arange(len(at))
            own = np.frombuffer(b"".join([sketches[i] for i in at]), dtype=np.uint8).reshape(len(at), p).astype(np.int16)
            self.table[p, p] = own
            if p > PARTS:   # folded once: sets that can link differ in parts by a factor of two at most
                self.table[p, p // 2] = own[:, :p // 2] + own[:, p // 2:]

    def near(self, i: int, members: np.ndarray, num: int, den: int) -> np.ndarray:
        """Those of ``members`` that could link with set ``i``."""
        n, p = self.n[i], self.parts[i]
        members = members[(self.n[members] * den >= n * num) & (self.n[members] * num <= n * den)]
        out = []
        for q in {int(x) for x in np.unique(self.parts[members])}:
            at, low = members[self.parts[members] == q], min(p, q)
            apart = np.abs(self.table[q, low][self.row[at]] - self.table[p, low][self.row[i]]).sum(axis=1, dtype=np.int64)
            out.append(at[(den + num) * apart <= (den - num) * (self.n[at] + n)])
        return np.concatenate(out) if out else members


def _may_link(num: int, den: int):
    @pandas_udf(T.BooleanType())
    def near(n: pd.Series, sketch: pd.Series, m: pd.Series, other: pd.Series) -> pd.Series:
        out = []
        for a, x, b, y in zip(n, sketch, m, other):
            x, y = (np.frombuffer(v, dtype=np.uint8).astype(np.int64) for v in (x, y))
            while len(x) > len(y):
                x = x[:len(x) // 2] + x[len(x) // 2:]
            while len(y) > len(x):
                y = y[:len(y) // 2] + y[len(y) // 2:]
            out.append(bool((den + num) * np.abs(x - y).sum() <= (den - num) * (a + b)))
        return pd.Series(out, dtype=bool)
    return near


def _flood(pdf: pd.DataFrame, num: int, den: int) -> tuple[list, list]:
    """Edges that connect the members of one task that could link, all settled ones being connected."""
    pdf = pdf.sort_values(["settled", "key"], ascending=[False, True]).drop_duplicates("key")
    keys, settled = pdf["key"].to_numpy(), int(pdf["settled"].sum())
    sketches = _Sketches(pdf["sketch"].tolist(), pdf["n"].to_numpy())
    left = np.ones(len(keys), dtype=bool)
    a, b, begin = [], [], 0
    while left.any():
        # the settled members come first and grow together; then one after the other
        todo = list(range(settled)) if begin == 0 and settled else [int(np.argmax(left))]
        begin, first = 1, todo[0]
        left[todo] = False
        while todo and left.any():
            near = sketches.near(int(todo.pop()), np.flatnonzero(left), num, den)
            left[near] = False
            todo.extend(near.tolist())
            a += [keys[first]] * len(near)
            b += keys[near].tolist()
    return a, b


def _flood_tasks(num: int, den: int):
    """Edges of the tasks of a partition, which come sorted; a task may go over into the next batch."""
    def run(batches):
        kept = None
        for pdf in batches:
            if kept is not None:
                pdf = pd.concat([kept, pdf], ignore_index=True)
            last = pdf["task"].iloc[-1] if len(pdf) else None
            kept = pdf[pdf["task"] == last]
            yield found(pdf[pdf["task"] != last])
        if kept is not None:
            yield found(kept)

    def found(pdf):
        a, b = [], []
        for _, part in pdf.groupby("task", sort=False):
            if len(part) > 1:
                x, y = _flood(part, num, den)
                a += x
                b += y
        return pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})
    return run


def candidate_edges(prof: DataFrame, num: int = NUM, den: int = DEN, limit: int = LIMIT_SETS) -> DataFrame:
    """Edges that connect sets which share a first region and could link."""
    sigs = (prof.select("key", F.explode_outer("sigs").alias("sig")).where(F.col("sig").isNotNull())
            .repartition(F.col("sig")))
    shared = (sigs.groupBy("sig").agg(F.min("key").alias("low"), F.max("key").alias("high"))
              .where(F.col("low") != F.col("high")).select("sig", "low"))
    rows = materialize(sigs.join(shared.hint("shuffle_hash"), "sig").select("sig", "key", "low").distinct(), "shared")
    sketches = prof.where(F.col("key").isNotNull()).groupBy("key").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    low = sketches.toDF("low", "low_n", "low_sketch")
    stars = materialize(rows.where(F.col("key") != F.col("low")).select("key", "low").distinct().join(sketches, "key").join(low, "low")
                        .select("key", "low", _may_link(num, den)("n", "sketch", "low_n", "low_sketch").alias("near")), "stars")
    # regions in which a member could not link with the smallest
    tagged = rows.join(stars, ["key", "low"], "left").select(
        F.col("sig").alias("cell"), "key", F.lit(True).alias("home"), F.coalesce("near", F.lit(True)).alias("settled"))
    half = limit / 2
    plan = tagged.groupBy("cell").agg(F.sum(F.col("settled").cast("int")).alias("s"), F.sum((~F.col("settled")).cast("int")).alias("u")).where("u > 0").select(
        "cell", "s", F.greatest(F.lit(1), F.ceil(F.col("s") / half).cast("int")).alias("s_blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("u") / half).cast("int")).alias("u_blocks"), F.lit(False).alias("again"))
    tasks = _block_tasks(tagged.join(plan, "cell"), 0).select("task", "key", "settled")
    found = (tasks.join(sketches, "key").repartition(F.col("task")).sortWithinPartitions("task")
             .mapInPandas(_flood_tasks(num, den), _EDGE))
    return stars.where("near").select(F.col("key").alias("a"), F.col("low").alias("b")).unionByName(found)


def cut_region(members: DataFrame, depth: int, num: int, den: int, limit_sets: int, limit_shingles: int):
    """One cut of the regions of ``members`` (region, key, home, shingles): the edges found, and the members
    of the regions to be cut again."""
    sized = members.join(members.groupBy("region").agg(F.count(F.lit(1)).alias("sets"), F.sum(F.size("shingles")).alias("total")), "region")
    order = Window.partitionBy("region").orderBy(F.xxhash64("key", F.lit(depth)), "key")
    n_chunks = _chunks(F.col("sets"), F.col("total"), limit_sets, limit_shingles)
    chosen = sized.withColumn("pivot", F.row_number().over(order)).where(F.col("pivot") <= PIVOTS)
    # the pivots of a region go to each of its chunks
    sent = chosen.select("region", F.explode(F.sequence(F.lit(0), n_chunks - 1)).alias("chunk"), "key", "pivot", "shingles").toDF(
        "p_region", "p_chunk", "p_key", "pivot", "p_shingles")
    dealt = sized.select("region", F.pmod(F.xxhash64("key", F.lit(depth)), n_chunks).cast("int").alias("chunk"), "key", "home", "shingles")
    cells = materialize(dealt.groupBy("region", "chunk").cogroup(sent.groupBy("p_region", "p_chunk")).applyInPandas(
        _assign_chunk(num, den, depth), "region long, cell long, key long, home boolean, settled boolean, pivot long"), "cells")
    to_pivot = cells.where(F.col("settled") & (F.col("key") != F.col("pivot"))).select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    weight = members.select("key", F.size("shingles").alias("w")).distinct()
    is_open = (~F.col("settled")).cast("int")
    counts = (cells.join(weight, "key").groupBy("region", "cell")
              .agg(F.sum(1 - is_open).alias("s"), F.sum((1 - is_open) * F.col("w")).alias("sw"),
                   F.sum(is_open).alias("u"), F.sum(is_open * F.col("w")).alias("uw"), F.max("home").alias("any_home")))
    of_region = counts.groupBy("region").agg(F.sum(F.col("u") * F.col("u")).alias("u2")).join(
        sized.groupBy("region").agg(F.max("sets").alias("sets"), F.max("total").alias("total")), "region")
    half = (limit_sets / 2, limit_shingles / 2)
    s_blocks, u_blocks = _chunks(F.col("s"), F.col("sw"), *half), _chunks(F.col("u"), F.col("uw"), *half)
    # a cut is of use if it leaves fewer pairs than there were; else the region stays one cell without settled members
    useful = F.col("u2") <= 0.5 * F.col("sets") * F.col("sets")
    parted = counts.join(of_region.where(useful), "region").where(F.col("any_home") & (F.col("u") > 0)).select(
        "cell", "s", s_blocks.alias("s_blocks"), u_blocks.alias("u_blocks"), (u_blocks > 2).alias("again"))
    whole = of_region.where(~useful).select(
        "region", F.lit(0).cast("long").alias("s"), F.lit(1).alias("s_blocks"),
        _chunks(F.col("sets"), F.col("total"), *half).alias("u_blocks"), F.lit(False).alias("again"))
    placed = cells.select("cell", "key", "home", "settled").join(parted, "cell")
    unparted = members.select("region", "key", "home", F.lit(False).alias("settled")).join(whole, "region").withColumnRenamed("region", "cell")
    placed = materialize(placed.unionByName(unparted), "placed")
    sets = members.select("key", "shingles").dropDuplicates(["key"])
    found = (_block_tasks(placed, depth).join(sets, "key").select("task", "key", "home", "settled", "shingles")
             .groupBy("task").applyInPandas(_join_task(num, den), _EDGE))
    again = placed.where(~F.col("settled") & F.col("again")).select(F.col("cell").alias("region"), "key", "home").join(sets, "key")
    return to_pivot.unionByName(found), again.select("region", "key", "home", "shingles")


def join_small(members: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """Edges inside regions that fit a task."""
    return (members.withColumn("settled", F.lit(False)).select("region", "key", "home", "settled", "shingles")
            .groupBy("region").applyInPandas(_join_task(num, den), _EDGE))


def join_large(members: DataFrame, num: int = NUM, den: int = DEN, limit_sets: int = LIMIT_SETS,
               limit_shingles: int = LIMIT_SHINGLES) -> DataFrame:
    """Edges inside regions of any size."""
    edges, depth = members.sparkSession.createDataFrame([], _EDGE), 0
    members = materialize(members.dropDuplicates(["region", "key"]), "members")
    while not members.isEmpty():
        found, again = cut_region(members, depth, num, den, limit_sets, limit_shingles)
        edges, members, depth = edges.unionByName(found), materialize(again, "members"), depth + 1
    return edges


# --- the join ------------------------------------------------------------------

_MEMBER = "region long, key long, home boolean, shingles array<long>"


def _shingled(words: int):
    def run(batches):
        for pdf in batches:
            rows = []
            for region, key, text in zip(pdf["region"], pdf["key"], pdf["text"]):
                s = shingles(text, words)
                if len(s) and _key(s) == key:
                    rows.append((region, key, True, s.view(np.int64)))
            yield pd.DataFrame(rows, columns=["region", "key", "home", "shingles"])
    return run


def link_documents(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN,
                   limit_sets: int = LIMIT_SETS, limit_shingles: int = LIMIT_SHINGLES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id of its component), text_hash and
    comp, which tell the rows and components of a repeated id apart."""
    prof = materialize(profiles(docs, words, num, den), "profiles")
    groups = components(candidate_edges(prof, num, den, limit_sets))          # v: set key, root: its group
    # the text that stands for a set; its id does not matter and may be null
    reps = prof.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("text_hash").alias("text_hash"), F.max("n").alias("n"))
    grouped = groups.join(reps, F.col("v") == F.col("key")).select("key", F.col("root").alias("region"), "text_hash", "n")
    sizes = grouped.groupBy("region").agg(((F.count(F.lit(1)) > limit_sets) | (F.sum("n") > limit_shingles)).alias("large"))
    wanted = materialize(grouped.join(sizes, "region").select("key", "region", "text_hash", "large"), "wanted")
    # at most LOOKUP_BUCKETS rows whatever the corpus: it only keeps most other texts out of the shuffle
    bucket = F.pmod(F.col("text_hash"), F.lit(LOOKUP_BUCKETS))
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").where(F.col("text").isNotNull()).withColumn("bucket", bucket)

    def members(large: bool) -> DataFrame:
        some = wanted.where(F.col("large") == large)
        lookup = F.broadcast(some.select(bucket.alias("bucket")).distinct())
        # one row a text: copies meet before the shuffle, and a set reaches its task once
        each = texts.join(lookup, "bucket", "left_semi").groupBy("text_hash").agg(F.first("text").alias("text"))
        return each.join(some, "text_hash").select("region", "key", "text").mapInPandas(_shingled(words), _MEMBER)

    edges = join_small(members(False), num, den)
    if not wanted.where("large").isEmpty():
        edges = edges.unionByName(join_large(members(True), num, den, limit_sets, limit_shingles))
    linked = components(edges)
    # sets to components of documents: through equal sets, links, and repeated ids
    comp = prof.where(F.col("key").isNotNull()).select("doc_id", "text_hash", "n", "key").join(
        linked.withColumnRenamed("v", "key"), "key", "left").withColumn("comp", F.coalesce("root", "key"))
    smallest = comp.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    out = comp.join(smallest, "comp").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "text_hash", "comp")
    empty = prof.where(F.col("key").isNull()).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "text_hash", F.lit(None).cast("long").alias("comp"))
    return out.unionByName(empty)


def keep_one(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (null before all; of rows
    with that id, the smallest text hash; of rows that are equal in both, any one).  Documents without words all stay."""
    links = materialize(link_documents(docs, words, num, den).where(F.col("n_shingles") > 0), "links")
    stays = links.groupBy("comp").agg(F.min(F.struct("doc_id", "text_hash")).alias("stay"))
    told = links.join(stays, "comp").withColumn("stays", F.struct("doc_id", "text_hash").eqNullSafe(F.col("stay")))
    rows = materialize(told.groupBy("doc_id", "text_hash", "stays").agg(F.count(F.lit(1)).alias("n")).where("NOT stays OR n > 1"), "leaving")
    left = without(docs, rows.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_text")))
    repeated = rows.where("stays").select(F.col("doc_id").alias("twice_id"), F.col("text_hash").alias("twice_text"))
    return left.unionByName(one_of_each(docs, repeated))
