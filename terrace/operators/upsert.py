"""Set-based upsert (M1-M3, M6) and cascading delete (I16).

File tables have no MERGE: the new version of a table is
``target LEFT ANTI JOIN batch ON key  UNION ALL  batch`` -- existing keys take
the batch's values, new keys are inserted, keys absent from the batch stay.
Both sides are shuffled by key once; when the batch is small AQE turns the
anti join into a broadcast at runtime (its size is measured, not assumed).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.operators.integrity import duplicate_keys


class DuplicateBatchKey(ValueError):
    """M2: the batch holds a key twice; never resolved silently."""


def check_batch_keys(batch: DataFrame, key: list[str], table: str = "batch") -> None:
    dups = duplicate_keys(batch, table, key, "primary_key")
    # the total and the five smallest keys as an example
    row = dups.agg(F.count(F.lit(1)).alias("n")).first()
    if row["n"]:
        some = dups.orderBy("key_value").limit(5).collect()
        raise DuplicateBatchKey(f"{table}: {row['n']} duplicate keys in batch, for example "
                                + ", ".join(r["key_value"] for r in some))


def upsert(target: DataFrame, batch: DataFrame, key: list[str] | str,
           check_keys: bool = True) -> DataFrame:
    """M1: merged table; the batch's columns are aligned to the target by name."""
    key = [key] if isinstance(key, str) else list(key)
    if check_keys:
        check_batch_keys(batch, key)
    b = batch.select(*target.columns)
    kept = target.join(b.select(*key), key, "left_anti").select(*target.columns)
    return kept.unionByName(b)


def upsert_counts(target: DataFrame, batch: DataFrame, key: list[str] | str) -> DataFrame:
    """M3: processed (= batch rows, the reference's counter), inserted, updated."""
    key = [key] if isinstance(key, str) else list(key)
    b = batch.select(*key)
    new = b.join(target.select(*key), key, "left_anti")
    tagged = b.select(F.lit(False).alias("_new")).unionByName(new.select(F.lit(True).alias("_new")))
    return tagged.agg(F.count_if(~F.col("_new")).alias("processed"),
                      F.count_if(F.col("_new")).alias("inserted")) \
        .withColumn("updated", F.col("processed") - F.col("inserted"))


def cascade_delete(tables: dict[str, DataFrame], parent: str, parent_key: str,
                   deleted_keys: DataFrame, children: dict[str, list[str]]) -> dict[str, DataFrame]:
    """I16: remove the deleted parents and every child row referencing them.

    ``children`` maps a child table to its referencing columns (a match has two:
    home and away -- one anti join per column, never an OR join).
    """
    keys = deleted_keys.select(F.col(parent_key).alias("_del"))  # anti joins: no distinct needed
    out = dict(tables)
    out[parent] = tables[parent].join(keys, F.col(parent_key) == F.col("_del"), "left_anti")
    for child, cols in children.items():
        out[child] = reduce(lambda df, c: df.join(keys, F.col(c) == F.col("_del"), "left_anti"),
                            cols, tables[child])
    return out


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table plus a total row."""
    per = reduce(DataFrame.unionByName,
                 [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"),
                                                                      "row_count")
                  for n, df in tables.items()])
    total = per.agg(F.lit("total").alias("table_name"), F.sum("row_count").cast("long").alias("row_count"))
    return per.unionByName(total)


def assign_surrogate_keys(target: DataFrame | None, batch: DataFrame, natural_key: str,
                          id_col: str = "id", window_rows: int | None = None) -> DataFrame:
    """Stable surrogate ids.  Rows whose natural key already exists keep
    their id; new keys get max(id) + 1, 2, ... in natural-key order (``window_rows`` as in
    ``global_rank``).  Without a bound the numbering is scalable and runs at once."""
    from terrace.operators.ranking import global_rank
    if target is None:
        existing = batch.sparkSession.createDataFrame([], f"{natural_key} {dict(batch.dtypes)[natural_key]}, "
                                                      f"{id_col} long")
    else:
        existing = target.select(natural_key, F.col(id_col).cast("long").alias(id_col))
    known = batch.join(existing, natural_key, "inner")
    new = batch.join(existing.select(natural_key), natural_key, "left_anti")
    numbered = global_rank(new, [natural_key], out="_n", kind="row_number", window_rows=window_rows, keys_unique=True)
    # the current maximum is a scalar subquery: nothing runs here
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top")).scalar()
    fresh = numbered.withColumn(id_col, top + F.col("_n")).drop("_n")
    return known.unionByName(fresh.select(*known.columns))
