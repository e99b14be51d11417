"""Global ranking (W1, W2, W4) at any scale (X1) and ranked top-k.

A window without PARTITION BY sorts the whole input in one task.  The default here
instead:

1. collapses the input to its distinct sort keys with a count (partial
   aggregation, so a key holding a third of all rows is one row here);
2. range-partitions those keys, sorts inside each partition and numbers them
   locally (vectorised, per partition);
3. writes that once (a table in the folder of ``spark.checkpoint.dir``) so the
   sampled range bounds and partition ids cannot change between passes;
4. adds per-partition offsets -- one row per range partition, a size bounded by
   the partition count: the totals are collected, prefix-summed and broadcast;
5. joins the numbered keys back (skewed keys are split by AQE skew-join, the
   other side holds one row per key).

``order`` is a list of column names, a leading ``-`` meaning descending.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.session import materialize


def parse_order(order: list[str]) -> list[tuple[str, bool]]:
    return [(o[1:], False) if o.startswith("-") else (o, True) for o in order]


def order_columns(order: list[str]) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in parse_order(order)]


def _local_numbering(batches):
    idx = 0
    before = 0
    for pdf in batches:
        cnt = pdf["_cnt"].to_numpy(dtype=np.int64)
        m = len(pdf)
        csum = np.cumsum(cnt)
        pdf["_local_idx"] = np.arange(idx, idx + m, dtype=np.int64)
        pdf["_local_before"] = before + csum - cnt
        idx += m
        before += int(csum[-1]) if m else 0
        yield pdf


# Executors need not have this package installed: the per-partition function is
# shipped by value with the task instead of being imported by name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _numbered_keys(keys_df: DataFrame, order: list[str], num_partitions: int | None):
    """(keys..., _cnt) with unique keys -> (DataFrame with _dense and _rank, both
    1-based; the largest _cnt, i.e. the size of the biggest tie group)."""
    spark = keys_df.sparkSession
    ocols = order_columns(order)
    # Without an explicit count AQE sizes the range partitions (coalescing
    # adjacent ones keeps them ordered), so tiny inputs do not become hundreds
    # of tasks and large ones still get spark.sql.shuffle.partitions ranges.
    ranged = ((keys_df.repartitionByRange(num_partitions, *ocols) if num_partitions
               else keys_df.repartitionByRange(*ocols))
              .sortWithinPartitions(*ocols)
              .withColumn("_pid", F.spark_partition_id()))
    schema = T.StructType(ranged.schema.fields + [
        T.StructField("_local_idx", T.LongType(), False),
        T.StructField("_local_before", T.LongType(), False)])
    local = materialize(ranged.mapInPandas(_local_numbering, schema), "numbered")
    # Per-partition totals: one row per range partition, so at most ``n`` rows
    # reach the driver; their prefix sums are the partitions' offsets.
    per_part = sorted(local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"),
                                               F.sum("_cnt").alias("_rows"),
                                               F.max("_cnt").alias("_maxc")).collect())
    rows, idx_off, row_off = [], 0, 0
    max_cnt = max([int(r["_maxc"]) for r in per_part], default=0)
    for r in per_part:
        rows.append((int(r["_pid"]), idx_off, row_off))
        idx_off += int(r["_n"])
        row_off += int(r["_rows"])
    offsets = spark.createDataFrame(rows, "_pid int, _idx_off long, _row_off long")
    # bounded by n rows: safe to broadcast
    numbered = (local.join(F.broadcast(offsets), "_pid")
                .withColumn("_dense", F.col("_idx_off") + F.col("_local_idx") + 1)
                .withColumn("_rank", F.col("_row_off") + F.col("_local_before") + 1)
                .drop("_pid", "_idx_off", "_row_off", "_local_idx", "_local_before"))
    return numbered, max_cnt


def _null_safe_join(df: DataFrame, numbered: DataFrame, keys: list[str]) -> DataFrame:
    ren = numbered.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                          *[c for c in numbered.columns if c not in keys])
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(ren[f"_k_{k}"])
        cond = c if cond is None else cond & c
    return df.join(ren, cond, "inner").drop(*[f"_k_{k}" for k in keys])


def _unique_row_numbers(df: DataFrame, order: list[str], out: str, num_partitions: int | None) -> DataFrame:
    """ROW_NUMBER over unique keys: the whole rows go through one range exchange and are numbered
    there, so nothing is joined back.  Equal keys meet in one range partition next to each other; the
    numbering pass looks for them and the call fails if there are any."""
    keys = [c for c, _ in parse_order(order)]
    ocols = order_columns(order)
    ranged = ((df.repartitionByRange(num_partitions, *ocols) if num_partitions else df.repartitionByRange(*ocols))
              .sortWithinPartitions(*ocols).withColumn("_pid", F.spark_partition_id()))
    schema = T.StructType(ranged.schema.fields + [T.StructField("_local_idx", T.LongType(), False),
                                                  T.StructField("_tie", T.BooleanType(), False)])
    local = materialize(ranged.mapInArrow(_number_rows(keys), schema), "numbered")
    # one row per range partition: bounded by the partition count
    per_part = sorted(local.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"), F.count_if("_tie").alias("ties")).collect())
    ties = sum(r["ties"] for r in per_part)
    if ties:
        raise ValueError(f"row_number needs a total order: {ties} rows repeat the key {keys} of another row")
    rows, before = [], 0
    for r in per_part:
        rows.append((r["_pid"], before))
        before += r["n"]
    offsets = df.sparkSession.createDataFrame(rows, "_pid int, _before long")
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_before") + F.col("_local_idx") + 1).select(*df.columns, out))


def _number_rows(keys: list[str]):
    def run(batches):
        import pyarrow as pa
        n, last = 0, None
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            rows = list(zip(*[batch.column(k).to_pylist() for k in keys]))
            ties = [row == prev for row, prev in zip(rows, [last, *rows])]
            n, last = n + m, rows[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.arange(n - m, n, dtype=np.int64)), pa.array(ties, pa.bool_())],
                names=[*batch.schema.names, "_local_idx", "_tie"])
    return run


def global_rank(df: DataFrame, order: list[str], out: str = "rank", kind: str = "dense_rank",
                window_rows: int | None = None, num_partitions: int | None = None,
                keys_unique: bool = False) -> DataFrame:
    """Add a global ``dense_rank`` / ``rank`` / ``row_number`` column ordered by ``order``.

    The default scales to any row count.  A caller that knows a small bound on the number of rows (a league
    table has one row per club) states it as ``window_rows`` and gets the plain one-task window, which is
    lazy; more rows than stated make the query fail rather than crawl.

    ``row_number`` needs a total order (end ``order`` with a unique key); ties
    are otherwise arbitrary, which the operator refuses to produce silently.  ``keys_unique`` says
    that the keys do not repeat; the numbering checks it and then needs no join.
    """
    if kind not in ("dense_rank", "rank", "row_number"):
        raise ValueError(f"unknown rank kind {kind!r}")
    if window_rows is not None:
        w = Window.orderBy(*order_columns(order))
        fn = {"dense_rank": F.dense_rank, "rank": F.rank, "row_number": F.row_number}[kind]
        too_many = F.row_number().over(w) > int(window_rows)
        checked = F.when(too_many, F.raise_error(F.lit(f"more than the stated {int(window_rows)} rows to rank")).cast("int"))
        return df.withColumn(out, F.coalesce(checked, fn().over(w)).cast("long"))
    keys = [c for c, _ in parse_order(order)]
    if kind == "row_number" and keys_unique:
        return _unique_row_numbers(df, order, out, num_partitions)
    keys_df = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    numbered, max_cnt = _numbered_keys(keys_df, order, num_partitions)
    if kind == "row_number" and max_cnt > 1:
        raise ValueError(f"row_number needs a total order: {max_cnt} rows tie on {keys}; "
                         "end the order with a unique key")
    col = "_dense" if kind == "dense_rank" else "_rank"
    numbered = numbered.select(*keys, F.col(col).alias(out))
    return _null_safe_join(df, numbered, keys)


def top_k_ranked(df: DataFrame, order: list[str], k: int, out: str = "rank") -> DataFrame:
    """The first ``k`` rows by ``order`` numbered 1..k.

    Top-k by the real keys first (TakeOrderedAndProject: per-partition top-k,
    then a merge of k rows per partition), then number only those k rows.
    ``order`` must be total for a deterministic result.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    top = df.orderBy(*order_columns(order)).limit(k)
    return top.withColumn(out, F.row_number().over(Window.orderBy(*order_columns(order))).cast("long"))


# --- lazy ranks in one plan ----------------------------------------------------

#: Ranges of a lazy rank, and about how many keys the split points are taken from.
RANGES, SAMPLE = 200, 8192


def _order_key(order: list[str]) -> str:
    """A struct that compares like ``order`` over numeric columns (descending: nulls last; ascending: nulls first)."""
    parts = [f"`{c}` IS NOT NULL, `{c}`" if asc else f"`{c}` IS NULL, -`{c}`" for c, asc in parse_order(order)]
    return f"struct({', '.join(parts)})"


def row_number_sql(rows: str, columns: list[str], order: list[str], out: str, ranges: int = RANGES, sample: int = SAMPLE) -> str:
    """W2 as one SQL statement without a job of its own, fit for a view: ``rows`` (a SELECT with unique keys
    ``order``, numeric) numbered by ranges of the order.

    Split points come from the keys whose hash falls on a share that leaves about ``sample`` of them (a scalar subquery, and
    the same whenever it is evaluated); a row finds its range by halving the sorted split points (eight comparisons for 200
    ranges, not 199); a window per range numbers the rows, and ranges before it are counted on a side
    of at most ``ranges`` rows.  Keys are unique, so a value held by a third of all rows is split like any other.
    """
    if ranges < 2:
        raise ValueError("ranges must be 2 or more")
    key, names = _order_key(order), ", ".join(f"`{c}`" for c, _ in parse_order(order))
    by = ", ".join(f"`{c}` {'ASC' if asc else 'DESC'}" for c, asc in parse_order(order))
    steps = ", ".join(str(1 << i) for i in reversed(range((ranges - 1).bit_length())))
    return f"""
        WITH _rows AS ({rows}),
        _cuts AS (
          SELECT filter(transform(sequence(1, {ranges - 1}), i -> get(s, CAST(i * size(s) DIV {ranges} AS INT))), c -> c IS NOT NULL) AS cuts
          FROM (SELECT array_sort(collect_list({key})) AS s FROM _rows
                WHERE pmod(xxhash64({names}), greatest(1L, (SELECT count(*) FROM _rows) DIV {sample}L)) = 0)),
        _placed AS (
          SELECT * EXCEPT (_key, _split), aggregate(array({steps}), 0, (n, s) -> IF(get(_split, n + s - 1) <= _key, n + s, n)) AS _range
          FROM (SELECT *, {key} AS _key, (SELECT cuts FROM _cuts) AS _split FROM _rows)),
        _before AS (
          SELECT _range, coalesce(sum(n) OVER (ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS _offset
          FROM (SELECT _range, count(*) AS n FROM _placed GROUP BY _range))
        SELECT /*+ BROADCAST(_before) */ {", ".join(f"`{c}`" for c in columns)},
               _offset + row_number() OVER (PARTITION BY _placed._range ORDER BY {by}) AS `{out}`
        FROM _placed JOIN _before ON _placed._range = _before._range"""


def dense_rank_sql(rows: str, columns: list[str], order: list[str], out: str, ranges: int = RANGES, sample: int = SAMPLE) -> str:
    """W1 as one SQL statement: the different keys are numbered as in ``row_number_sql`` and joined back."""
    keys = [c for c, _ in parse_order(order)]
    distinct = f"SELECT DISTINCT {', '.join(f'`{c}`' for c in keys)} FROM ({rows})"
    on = " AND ".join(f"_r.`{c}` <=> _k.`{c}`" for c in keys)
    return f"""
        SELECT {", ".join(f"_r.`{c}`" for c in columns)}, _k.`{out}`
        FROM ({rows}) AS _r JOIN ({row_number_sql(distinct, keys, order, out, ranges, sample)}) AS _k ON {on}"""
