"""Benchmark decontamination with a broadcast set of normalised n-grams.

A window is ``width`` consecutive words of a benchmark item; a shorter item is one
window.  Looking every training position up would hash each word ``width`` times,
so a document only looks up its aligned ``probe``-word pieces, one every ``stride``
positions with ``probe + stride - 1 <= width``: any occurrence of a window holds
exactly one aligned piece.  A piece that is in the broadcast table is verified against
the words of each window holding it.

The broadcast table has one row for each (piece, window) and its size is checked: at most
``max_rows`` rows are sent at once; a larger benchmark is cut into as many parts by
hash, each scanned in its own pass, with the same result.

Defined cases: null or wordless text has no words and no hits; null or wordless items are
no windows; repeated items count by item_id; a null item_id is ignored; repeated
documents each get their row; empty tables give no hits or no rows; other columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import alnum_words, without
from terrace.operators.rows import repeat_rows

WIDTH = 10
MAX_ROWS = 200_000
#: Bits for a window's length in a packed occurrence (start * 64 + length).
LEN_BASE = 64


def piece_plan(width: int) -> tuple[int, int]:
    """(piece length, stride) for windows of ``width`` words."""
    probe = (width + 1) // 2
    return probe, width + 1 - probe


def windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct windows: gram (words joined by a blank), len, items (sorted text ids)."""
    b = benchmark.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("string").alias("item"), alnum_words(F.col("text")).alias("w"))
    n = F.size("w")
    length = F.least(n, F.lit(width))
    starts = F.sequence(F.lit(1), n - length + 1)
    return (b.where(n > 0).select("item", length.alias("len"), F.explode_outer(F.transform(
                starts, lambda i: F.array_join(F.slice(F.col("w"), i, length), " "))).alias("gram"))
            .groupBy("gram", "len").agg(F.collect_set("item").alias("items")))


def pieces(wins: DataFrame) -> DataFrame:
    """One row for each (piece, window) with the piece's offset in the window."""
    w = F.split("gram", " ")
    probe = F.floor((F.col("len") + 1) / 2).cast("int")
    stride = F.col("len") + 1 - probe
    return (wins.select("gram", "len", "items", w.alias("w"), probe.alias("probe"), stride.alias("stride"))
            .select("gram", "len", "items", F.explode_outer(F.transform(
                F.sequence(F.lit(0), F.col("stride") - 1),
                lambda o: F.struct(o.alias("off"), F.xxhash64(F.col("len"), F.array_join(F.slice(F.col("w"), o + 1, F.col("probe")), " ")).alias("h")))).alias("p"))
            .select("gram", "len", "items", "p.off", "p.h"))


def _probes(words: Column, length: int) -> Column:
    probe, stride = piece_plan(length)
    n = F.size(words)
    return F.when(n >= length, F.transform(
        F.sequence(F.lit(0), n - probe, F.lit(stride)),
        lambda i: F.struct(i.cast("int").alias("q"), F.xxhash64(
            F.lit(length), F.array_join(F.slice(words, i + 1, probe), " ")).alias("h"))))


def hit_groups(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row for each (doc_id, text_hash) with the number of its rows, ``copies``; else as ``find_hits``."""
    table = pieces(windows(benchmark, width))
    sizes = {r["len"]: r["n"] for r in table.groupBy("len").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = max(1, -(-sum(sizes.values()) // max_rows))
    lengths = sorted(sizes) or [width]
    d = docs.select("doc_id", alnum_words(F.col("text")).alias("words"), F.xxhash64("text").alias("text_hash"))
    none = F.array(F.struct(F.lit(-1).alias("q"), F.lit(0).cast("long").alias("h")))
    probes = reduce(lambda a, b: F.concat(a, b), [F.coalesce(_probes(F.col("words"), m), F.slice(none, 1, 0)) for m in lengths], none)
    # explode_outer: for a plain explode Catalyst would filter on the array's size at the scan
    # and so evaluate the words anew for every position
    rows = (d.select("doc_id", "text_hash", "words", probes.alias("probes"))
            .select("doc_id", "text_hash", "words", F.explode_outer("probes").alias("p"))
            .select("doc_id", "text_hash", "words", F.col("p.q").alias("q"), F.col("p.h").alias("ph")))
    start = F.col("q") - F.col("off")
    found = []
    for k in range(parts):
        part = table if parts == 1 else table.where(F.pmod(F.xxhash64("h"), F.lit(parts)) == k)
        on = ((F.col("ph") == F.col("h")) & (F.col("q") >= F.col("off"))
              & (F.array_join(F.slice(F.col("words"), F.greatest(start, F.lit(0)) + 1, F.col("len")), " ") == F.col("gram")))
        hit = rows.join(F.broadcast(part), on, "left").where(F.col("h").isNotNull() | (F.col("q") < 0))
        found.append(hit.select(
            "doc_id", "text_hash", F.when(F.col("q") < 0, F.size("words")).alias("n"),
            F.lit(k).alias("part"), F.when(F.col("h").isNotNull(), start * LEN_BASE + F.col("len")).alias("span"), "items"))
    hits = reduce(DataFrame.unionAll, found)
    per_doc = hits.groupBy("doc_id", "text_hash").agg(
        F.max("n").alias("n_words"),
        F.sum((F.col("n").isNotNull() & (F.col("part") == 0)).cast("int")).alias("copies"),
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    # words covered by the union of the occurrences, walked in order of their starts
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), F.floor(s / LEN_BASE).cast("int") + s % LEN_BASE - F.greatest(a["end"], F.floor(s / LEN_BASE).cast("int")))).cast("int").alias("n"),
            F.greatest(a["end"], F.floor(s / LEN_BASE).cast("int") + s % LEN_BASE).cast("int").alias("end")),
        lambda a: a["n"])
    return per_doc.select("doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"),
                          covered.cast("long").alias("n_hit"), "items", "spans", F.col("copies").cast("long").alias("copies"))


def find_hits(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per document row: ``docs``' doc_id, text_hash, n_words, n_hit, items, spans (packed
    start * 64 + length of every occurrence).  Rows equal in id and text are looked up as one and repeated in blocks."""
    return repeat_rows(hit_groups(docs, benchmark, width, max_rows), "copies")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` without the documents that hold any benchmark window."""
    hits = hit_groups(docs, benchmark, width, max_rows).where(F.col("n_hit") > 0)
    return without(docs, hits.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_text")))
