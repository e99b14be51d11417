"""Counted rows back to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that one counted row makes in one place at most.
BLOCK = 4096


def repeat_rows(df: DataFrame, count: str, out: str | None = None, block: int = BLOCK) -> DataFrame:
    """Each row of ``df`` as many times as its column ``count`` says (null or less than 1: not at all); the column goes.
    ``out`` numbers the copies from 1.

    A count can be a third of a table, so no array is as long as a count and no task makes all copies of a row: the
    row is cut into blocks of at most ``block`` copies, the blocks are dealt out by what they are and each makes its own.
    They are dealt to a stated number of partitions: AQE would join partitions of few blocks, whose rows it cannot foresee.
    """
    kept = [c for c in df.columns if c != count]
    n = F.col(count).cast("long")
    # a count of blocks is 1/4096 of a count of rows; explode streams them, and each block is one short row
    blocks = df.where(n > 0).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / block)))) \
        .withColumn("_size", F.least(F.lit(block).cast("long"), n - F.col("_block") * block))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.repartition(parts, F.xxhash64(*[F.col(c) for c in kept], "_block"))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_size"))).alias("_copy")
    made = dealt.select(*kept, "_block", copy)
    return made.select(*kept, *([(F.col("_block") * block + F.col("_copy")).alias(out)] if out else []))
