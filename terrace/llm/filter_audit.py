"""What each text filter takes away in every order of the filters.

A document fails a set of filters, its *mask*.  Documents are counted by part and mask first (at most 32 cells a
part), and each cell then folds across an array literal of all orders: ``aggregate`` walks an order's filters with
the state (still there, steps so far), ``transform`` does so for the 120 orders, and the 600 structs that come out are weighted
with the cell's counts.  Cells of a part are merged by elementwise sums: position by position, in a partial
aggregation, so at most 600 rows a part leave a task.

Filter E asks whether a smaller id has the same text anywhere in the table.  Equal rows of (text, id, part) are
counted before any other shuffle; the smallest id of every text comes from a hash aggregate on the
text's SHA-256, and is joined back on (text, id), so copies of one text, however many, spread over the tasks by
their ids.  Texts themselves are never shuffled.

Defined cases: null text counts as empty; null source is the part ''; a null id is neither smaller than another nor
larger, so its row never fails E; rows that repeat id and text are one document each and none is smaller than
the other; a document has a label if any row of the labels table says so; labels without id match nothing; an
empty table has no parts and gives no rows; extra columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_BLANK = r"[\x20\x09-\x0D]+"


def word_counts(text: Column) -> Column:
    """Struct (n, different) of the text's blank-separated words.  The words live inside one expression only:
    as a column they would be copied into rows."""
    inner = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    words = F.when(inner != "", F.split(inner, _BLANK, -1)).otherwise(F.array().cast("array<string>"))
    return F.transform(F.array(words), lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("different")))[0]


def text_mask(text: Column, words: Column) -> Column:
    """Bits 0 to 3: whether the text fails A, B, C, D; ``words`` is its ``word_counts``."""
    fails = (words["n"] < 50,
             100 * words["different"] < 65 * words["n"],
             100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text),
             text.rlike("[#$%&*|]"))
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, n_good, n_toxic): documents by part and the filters they fail."""
    base = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).alias("text"))
    words = base.withColumn("words", word_counts(F.col("text")))
    rows = words.select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("same"),
                        text_mask(F.col("text"), F.col("words")).alias("mask")) \
        .groupBy("same", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("same").agg(F.min("doc_id").alias("doc_id")).where(F.col("doc_id").isNotNull()) \
        .withColumn("is_first", F.lit(True))
    tagged = rows.join(first, ["same", "doc_id"], "left")
    fails_e = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    label = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                         F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    return tagged.withColumn("mask", F.col("mask") + F.when(fails_e, 16).otherwise(0)) \
        .join(label, "doc_id", "left").groupBy("part", "mask").agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("n_good"),
            F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("n_toxic"))


def all_orders() -> Column:
    """The array of all orders, each a string of filters; one literal once constants are folded."""
    return F.split(F.lit(",".join("".join(o) for o in permutations(FILTERS))), ",")


def fold(mask: Column, order: Column, n: Column, n_good: Column, n_toxic: Column) -> Column:
    """The steps of one order for a cell: an array of structs, each with the cell's counts at that step."""
    none = F.lit(0).cast("long")
    shape = ("array<struct<filter_order:string,step:int,filter:string,"
             + ",".join(f"{c}:bigint" for c in COUNTS) + ">>")
    start = F.struct(F.lit(True).alias("there"), F.array().cast(shape).alias("steps"))

    def walk(acc: Column, f: Column) -> Column:
        fails = F.getbit(mask, F.ascii(f) - ord(FILTERS[0])) == 1
        there = acc["there"]
        taken = there & fails
        out = F.struct(
            order.alias("filter_order"), (F.size(acc["steps"]) + 1).alias("step"), f.alias("filter"),
            F.when(there & ~fails, n).otherwise(none).alias("kept"),
            F.when(taken, n).otherwise(none).alias("removed"),
            F.when(~there & fails, n).otherwise(none).alias("redundant"),
            F.when(fails & (F.bit_count(mask) == 1), n).otherwise(none).alias("unique_fails"),
            F.when(taken, n_good).otherwise(none).alias("good_lost"),
            F.when(taken, n_toxic).otherwise(none).alias("toxic_lost"))
        return F.struct((there & ~fails).alias("there"), F.concat(acc["steps"], F.array(out)).alias("steps"))

    return F.aggregate(F.split(order, ""), start, walk, lambda acc: acc["steps"])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: (part, filter_order, step, the counts, shapley)."""
    folded = cells(docs, labels).select("part", F.flatten(F.transform(all_orders(), lambda o: fold(
        F.col("mask"), o, F.col("n"), F.col("n_good"), F.col("n_toxic")))).alias("steps"))
    merged = folded.select("part", F.inline("steps")).groupBy("part", "filter_order", "step", "filter").agg(
        *[F.sum(c).alias(c) for c in COUNTS])
    share = merged.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return merged.join(share, ["part", "filter"]).select("part", "filter_order", "step", *COUNTS, "shapley")
