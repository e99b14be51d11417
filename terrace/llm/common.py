"""Column helpers shared by the training-data operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word for sizes and shingles: a run without blanks.
BLANK_WORD = r"[^\x20\x09-\x0D]+"
#: What separates words of letters and digits; every code point from U+0080 is part of a word.
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TRAIN_MOD = 5


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other scripts keep their case."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def alnum_words(text: Column) -> Column:
    """Lower-cased words of ``text`` as an array; null text has none."""
    low = ascii_lower(F.coalesce(text, F.lit("")))
    return F.filter(F.split(low, WORD_GAP, -1), lambda w: w != "")


def count_blank_words(text: Column) -> Column:
    """Number of blank-separated words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(BLANK_WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """True for the rows no model may learn labels from; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % TRAIN_MOD == 0, F.lit(True))


#: Bound of the broadcast in ``without``.
MARKS = 1 << 18


def without(docs: DataFrame, gone: DataFrame, marks: int = MARKS) -> DataFrame:
    """``docs`` without the rows whose (doc_id, text) is in ``gone`` (gone_id, gone_text: the id and
    xxhash64 of the text).

    Long texts are not shuffled where that can be seen at once: ids are dealt into ``marks`` numbers, and
    the numbers that ``gone`` uses are broadcast, at most ``marks`` rows whatever its size.  Rows
    with an unused number stay; the others are compared exactly.
    """
    low = {c.lower() for c in docs.columns}
    number = next(n for n in ("mark", "_mark", "__mark") if n not in low)
    at = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(marks)), F.lit(-1))
    used = F.broadcast(gone.select(F.coalesce(F.pmod(F.xxhash64("gone_id"), F.lit(marks)), F.lit(-1)).alias(number)).distinct())
    numbered = docs.withColumn(number, at)
    sure = numbered.join(used, number, "left_anti")
    doubt = numbered.join(used, number, "left_semi").alias("d")
    exact = F.col("d.doc_id").eqNullSafe(F.col("gone_id")) & (F.xxhash64(F.col("d.text")) == F.col("gone_text"))
    kept = doubt.join(gone.select("gone_id", "gone_text"), exact, "left_anti")
    return sure.select(docs.columns).unionByName(kept.select(docs.columns))


def one_of_each(docs: DataFrame, twice: DataFrame, marks: int = MARKS) -> DataFrame:
    """Of the rows of ``docs`` whose (doc_id, text) is in ``twice`` (twice_id, twice_text as in ``without``), one for each
    pair.  Equal rows meet in a partial aggregation, so that a pair held by a third of all rows leaves a task as one row."""
    names = [n for n in ("_mark", "_id", "_text", "__mark", "__id", "__text") if n not in {c.lower() for c in docs.columns}]
    mark, who, what = names[:3]

    def at(c: str) -> Column:
        return F.coalesce(F.pmod(F.xxhash64(c), F.lit(marks)), F.lit(-1))

    used = F.broadcast(twice.select(at("twice_id").alias(mark)).distinct())
    maybe = docs.withColumn(mark, at("doc_id")).join(used, mark, "left_semi").withColumns(
        {who: F.xxhash64("doc_id", F.col("doc_id").isNull()), what: F.xxhash64("text")})
    keys = twice.select(F.xxhash64("twice_id", F.col("twice_id").isNull()).alias(who), F.col("twice_text").alias(what)).distinct()
    return maybe.dropDuplicates([who, what]).join(keys, [who, what], "left_semi").select(docs.columns)


def small_batches(df: DataFrame, size: int = 2 << 20) -> DataFrame:
    """``df``, after bounding what its session hands to Python at once to ``size`` bytes: several copies of a batch live in
    a worker (Arrow, strings, results), and workers keep the memory of their largest batch."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf = df.sparkSession.conf
    now = conf.get(name, None) or str(size + 1)
    if not now.rstrip("b").isdigit() or int(now.rstrip("b")) > size:
        conf.set(name, str(size))
    return df


def with_columns_free(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns named like ``names``: an operator's outputs win over clashing extras."""
    low = {n.lower() for n in names}
    return df.select([c for c in df.columns if c.lower() not in low])


_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
          "boolean": T.BooleanType()}


def struct_type(**fields: str) -> T.StructType:
    """A struct type from names and simple type names; needs no session, so modules can use it when imported."""
    return T.StructType([T.StructField(k, _TYPES[v]) for k, v in fields.items()])
