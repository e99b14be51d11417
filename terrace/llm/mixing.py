"""Mixing sources to target weights with a hypergeometric splitting tree.

Every document has a pseudo-random permutation key.  A source is cut into 256
blocks by the key's first two hex digits, and into 4096 cells by the first three.

1. Targets: sources share ``epochs_total`` of all words by weight; a target stops at
   ``cap`` times its source's words and the excess goes to the others by weight
   (water filling, solved in closed form over the source table).
2. Drawing: a source's target is a number of whole passes plus a rest.  The rest is
   the first words in permuted order, found from cell sums; only the order inside
   a cell is looked at per document.
3. Splitting tree: every pass over a block is a token.  At each node of the tree
   the tokens are drawn without replacement into children of exactly equal size, so
   a child's counts by source are multivariate hypergeometric.  The leaves hold the
   exact block quotas of the output shards.
4. The quotas of a source cut its permuted block list into disjoint runs, one for
   each shard, and ``shuffle_key`` orders documents inside a shard.

What meets in one task: the source table (one row per source) and the token
table (at most 512 rows per source, whatever their size).  Documents are shuffled
without text, by (source, cell); a source of any share spreads over 4096 cells, and rows that share id, source and
size are one counted row there, so that a hot id does not fill its cell; they are repeated in blocks at the end.
``mix_texts`` shuffles the texts once more to where the rows of the mix are, and only streams them.

Defined cases: null text has size 0 and takes nothing; a null source is a source of its
own, ordered last; an empty table gives no rows; repeated rows are drawn as rows of their
own (ties in the key are broken by id and size, further ties are interchangeable);
columns other than the four used are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import count_blank_words
from terrace.operators.rows import repeat_rows
from terrace.session import materialize

WEIGHTS = (5, 2, 1)
SEED = "mix"
FANOUT = 4
DEPTH = 3  # FANOUT ** DEPTH output shards
MAX_PASSES = 3  # cap 2 gives at most two whole passes and a rest


def _key(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def source_targets(cells: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source: src, source_size, target, whole passes and the words of the rest."""
    n = len(weights)
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("src"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("pos") % n + 1).cast("int"))
    s = (cells.groupBy("src").agg(F.sum("cell_size").alias("source_size"))
         .withColumn("pos", F.row_number().over(by_name) - 1)
         .withColumn("weight", w)
         .withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
         .withColumn("top", F.col("source_size") * F.lit(float(cap))))
    # water level: the sources with the smallest top / weight are full first
    order = Window.orderBy(F.col("top") / F.col("weight"), F.col("pos"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = order.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("top").over(before), F.lit(0.0)))
                     / F.sum("weight").over(from_here))
    level = F.min(F.when(F.col("level") <= F.col("top") / F.col("weight"), F.struct("pos2", "level"))).over(every)
    s = (s.withColumn("pos2", F.row_number().over(order))
         .withColumn("water", level["level"])
         .withColumn("target", F.when(F.col("water").isNull(), F.col("top"))
                     .otherwise(F.least(F.col("top"), F.col("water") * F.col("weight")))))
    words = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(F.lit(0))
    return s.select("src", "source_size", "target", passes.cast("long").alias("passes"),
                    (words - passes * F.col("source_size")).cast("long").alias("rest"))


def split_tree(tokens: DataFrame, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """Quotas: for each source the shard of every one of its tokens (src, n, shard).

    At each level a node's tokens are ranked by a fresh hash and cut into ``fanout``
    children of equal size: drawing without replacement, hence exact
    hypergeometric counts per source, summing to the source's tokens.
    """
    t = tokens.withColumn("node", F.lit(0))
    for level in range(depth):
        toss = _key(F.lit(f"{SEED}-tree-{level}"), "src", F.col("pass").cast("string"), "block")
        node = Window.partitionBy("node")
        rank = F.row_number().over(node.orderBy(toss, "src", "pass", "block")) - 1
        size = F.count(F.lit(1)).over(node)
        t = (t.withColumn("rank", rank).withColumn("size", size)
             .withColumn("node", F.col("node") * fanout
                         + F.floor(F.col("rank") * fanout / F.col("size")).cast("int"))
             .drop("rank", "size"))
    quotas = t.groupBy("src", F.col("node").alias("shard")).agg(F.count(F.lit(1)).alias("quota"))
    run = Window.partitionBy("src").orderBy("shard")
    return quotas.withColumn("first", F.sum("quota").over(run) - F.col("quota"))


def draw_blocks(tokens: DataFrame, quotas: DataFrame) -> DataFrame:
    """The shard of every (src, pass, block): a source's permuted blocks are dealt out in
    disjoint runs as long as its quotas."""
    perm = Window.partitionBy("src").orderBy(
        _key(F.lit(f"{SEED}-draw"), F.col("src"), F.col("pass").cast("string"), F.col("block")), "pass", "block")
    at = tokens.withColumn("n", F.row_number().over(perm) - 1)
    slots = quotas.select("src", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("quota") - 1)).alias("n"))
    return at.join(slots, ["src", "n"]).select("src", "pass", "block", "shard")


def mix(docs: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, shuffle_key and
    ``shards`` (the shard of each of its passes, in order; empty when nothing is taken); ``how`` as in ``mix_counted``."""
    return repeat_rows(mix_counted(docs, **how), "n")


def mix_counted(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0,
                fanout: int = FANOUT, depth: int = DEPTH, carry: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``mix`` with their number ``n``: documents equal in id, source, size and ``carry`` are one row up
    to three outcomes (taken of in full, in part, or not, where the rest of their source ends among them).
    Columns in ``carry`` are grouped by, sorted and buffered: they have to be short.  Texts are attached by
    ``mix_texts``."""
    carried = [F.struct(*carry).alias("carried")] if carry else []
    d = (docs.select("doc_id", "source", count_blank_words(F.col("text")).alias("size"), *carried)
         # code point order with null last: every name gets a leading 0, null alone is 1
         .withColumn("src", F.coalesce(F.concat(F.lit("0"), "source"), F.lit("1")))
         .withColumn("shuffle_key", _key(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
         .withColumn("cell", F.substring("shuffle_key", 1, 3)))
    cells = d.drop("carried").groupBy("src", "cell").agg(F.sum("size").alias("cell_size"))
    sources = source_targets(cells, weights, share, cap)
    upto = Window.partitionBy("src").orderBy("cell")
    cells = (cells.withColumn("cell_first", F.sum("cell_size").over(upto) - F.col("cell_size"))
             .join(sources, "src")
             .withColumn("block", F.substring("cell", 1, 2)))
    # passes that touch a block: the whole ones, and the rest if it begins before the block ends
    blocks = cells.groupBy("src", "block").agg(
        F.max("passes").alias("passes"), F.max((F.col("cell_first") < F.col("rest")).cast("int")).alias("part"))
    tokens = (blocks.where(F.col("passes") + F.col("part") > 0)
              .select("src", "block", F.explode(F.sequence(F.lit(1), (F.col("passes") + F.col("part")).cast("int"))).alias("pass")))
    dealt = (draw_blocks(tokens, split_tree(tokens, fanout, depth))
             .groupBy("src", "block")
             .agg(*[F.max(F.when(F.col("pass") == p, F.col("shard"))).alias(f"shard{p}") for p in range(1, MAX_PASSES + 1)]))
    cells = cells.join(dealt, ["src", "block"], "left")
    # equal rows are counted first: one id, or no id, can be a third of all rows and has one cell
    counted = d.groupBy("src", "cell", "shuffle_key", "doc_id", "source", "size", *(["carried"] if carry else [])) \
        .agg(F.count(F.lit(1)).alias("copies"))
    inside = Window.partitionBy("src", "cell").orderBy("shuffle_key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    # copy i begins at ``at`` + i * size: the first ``full`` lie before the end of the rest, one may be cut by it
    m = (counted.join(cells.drop("cell_size", "block"), ["src", "cell"])
         .withColumn("at", F.col("cell_first") + F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0)))
         .withColumn("before", F.greatest(F.lit(0).cast("long"), F.col("rest") - F.col("at")))
         .withColumn("full", F.when(F.col("size") > 0, F.least(F.col("copies"), F.floor(F.col("before") / F.col("size")))).otherwise(F.lit(0)))
         .withColumn("cut", F.when(F.col("full") < F.col("copies"), F.least(F.col("size"), F.col("before") - F.col("full") * F.col("size"))).otherwise(F.lit(0))))
    one = F.when(F.col("cut") > 0, F.lit(1)).otherwise(F.lit(0)).cast("long")
    outcomes = [(F.col("size"), F.col("full").cast("long")), (F.col("cut").cast("long"), one),
                (F.lit(0).cast("long"), F.col("copies") - F.col("full") - one)]
    each = F.filter(F.array(*[F.struct(p.alias("part"), n.alias("n")) for p, n in outcomes]), lambda x: x["n"] > 0)
    m = (m.withColumn("outcome", F.explode(each)).withColumn("part", F.col("outcome.part"))
         .withColumn("taken", F.col("passes") * F.col("size") + F.col("part")))
    used = [F.when((F.col("size") > 0) & (F.lit(p) <= F.col("passes") + (F.col("part") > 0).cast("int")), F.col(f"shard{p}"))
            for p in range(1, MAX_PASSES + 1)]
    return m.select("doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"),
                    F.concat_ws(",", *[c.cast("string") for c in used]).alias("shards"), "shuffle_key",
                    *(["carried.*"] if carry else []), F.col("outcome.n").alias("n"))


def mix_texts(docs: DataFrame, carry: tuple[str, ...] = ("lang", "text", "n_chars"), **how) -> DataFrame:
    """``mix`` with the columns in ``carry``, which may be long: one row per row of ``docs``.

    The mix is made of short rows and written.  Its rows are matched by id and a hash of the whole row, one row for
    each such pair, and make the hash table of a join through which the texts only pass: they are neither sorted nor
    put in a window.  Rows that are equal in all columns can differ in what is taken of them only where the rest of a
    source ends, so for at most one pair of each source; of those one row is read and repeated.
    """
    cols = list(dict.fromkeys(("doc_id", "source", "text", *carry)))
    d = docs.select(*cols, F.xxhash64(*cols, *[F.col(c).isNull() for c in cols]).alias("row_hash"))
    plan = materialize(mix_counted(d, carry=("row_hash",), **how), "mix")
    shown = [c for c in plan.columns if c not in ("doc_id", "source", "row_hash", "n")]
    dealt = (plan.groupBy("doc_id", "row_hash").agg(F.collect_list(F.struct(*shown, "n")).alias("dealt"))
             .withColumnRenamed("doc_id", "plan_id").withColumnRenamed("row_hash", "plan_hash"))

    def texts(part: DataFrame) -> DataFrame:
        same = F.col("doc_id").eqNullSafe(F.col("plan_id")) & (F.col("row_hash") == F.col("plan_hash"))
        return d.join(part.hint("shuffle_hash"), same)

    def out(rows: DataFrame, dealt: Column) -> DataFrame:
        return rows.select("doc_id", "source", *[dealt[c].alias(c) for c in shown], *carry)

    mixed = out(texts(dealt.where(F.size("dealt") == 1)), F.col("dealt")[0])
    edge = dealt.where(F.size("dealt") > 1)
    if not edge.isEmpty():
        one = texts(edge).dropDuplicates(["doc_id", "row_hash"]).withColumn("one", F.explode("dealt"))
        mixed = mixed.unionByName(out(repeat_rows(one.drop("dealt").withColumn("repeats", F.col("one.n")), "repeats"), F.col("one")))
    return mixed
