"""Warehouse integrity checks.

Spark's file tables accept NULLs in NOT NULL columns and reject CHECK/PRIMARY
KEY DDL, so constraints are declared (``terrace.schemas.TableSpec``) and checked
by these operators, each returning a violations DataFrame.  All counts come
from partially aggregated group-bys or anti-joins; nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.schemas import TableSpec

_SUMMARY_COLS = ["table_name", "constraint_name", "violations"]


def _key_text(cols: list[str]):
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols])


def duplicate_keys(df: DataFrame, table: str, key: list[str], constraint: str) -> DataFrame:
    """Every non-null key that occurs more than once, with its count."""
    nn = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    return (df.where(nn).groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1)
            .select(F.lit(table).alias("table_name"), F.lit(constraint).alias("constraint_name"),
                    _key_text(key).alias("key_value"), "occurrences"))


def pk_violations(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Duplicate keys plus rows with a null key component (reported as key 'NULL')."""
    dups = duplicate_keys(df, table, key, "primary_key")
    anynull = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    nulls = (df.where(anynull).agg(F.count(F.lit(1)).alias("occurrences"))
             .where(F.col("occurrences") > 0)
             .select(F.lit(table).alias("table_name"), F.lit("primary_key_not_null").alias("constraint_name"),
                     F.lit("NULL").alias("key_value"), "occurrences"))
    return dups.unionByName(nulls)


def not_null_counts(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """Null count per column in one pass (table_name, column_name, null_count)."""
    columns = columns or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "null_count") \
               .select(F.lit(table).alias("table_name"), "column_name",
                       F.col("null_count").cast("long").alias("null_count"))


def check_violations(df: DataFrame, table: str, checks: dict[str, str]) -> DataFrame:
    """Rows failing each CHECK; as in SQL, a NULL result passes."""
    if not checks:
        return df.sparkSession.createDataFrame([], "table_name string, constraint_name string, violations long")
    wide = df.agg(*[F.count_if(F.coalesce(~F.expr(e), F.lit(False))).alias(n) for n, e in checks.items()])
    return wide.unpivot([], list(checks), "constraint_name", "violations") \
               .select(F.lit(table).alias("table_name"), "constraint_name",
                       F.col("violations").cast("long").alias("violations"))


def fk_orphans(child: DataFrame, parent: DataFrame, columns: list[str], parent_columns: list[str]) -> DataFrame:
    """Child rows whose non-null key has no parent (left anti join; an
    anti join never multiplies rows, so the parent keys need no distinct --
    that would be one more shuffle of the parent table)."""
    p = parent.select(*[F.col(pc).alias(c) for pc, c in zip(parent_columns, columns)])
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return child.where(nn).join(p, columns, "left_anti")


def fk_violations(child: DataFrame, parent: DataFrame, table: str, columns: list[str],
                  parent_columns: list[str], constraint: str) -> DataFrame:
    return (fk_orphans(child, parent, columns, parent_columns)
            .agg(F.count(F.lit(1)).alias("violations"))
            .select(F.lit(table).alias("table_name"), F.lit(constraint).alias("constraint_name"),
                    "violations"))


#: Ranks that one window compares, and how often edges are stitched.
STITCH_WIDTH, STITCH_LEVELS = 1000, 3


def order_violations(df: DataFrame, rank_col: str, value_col: str, descending: bool = True,
                     width: int = STITCH_WIDTH, levels: int = STITCH_LEVELS) -> DataFrame:
    """Along ``rank_col`` (integers, with ties and gaps) the value must be non-increasing (``descending``) or
    non-decreasing; the ranks after which the next rank that exists breaks the order.

    Ranks are reduced to their smallest and largest value.  Neighbours are compared inside ranges of ``width``
    ranks; the edges of the ranges become the rows of the next level, where ranges of ranges are compared
    in the same way.  After ``levels`` of them one row is left for every ``width ** levels`` ranks, and these meet in one
    window.  Null ranks take no part, and a null value breaks nothing.
    """
    value = F.col(value_col)
    cells = df.where(F.col(rank_col).isNotNull()).groupBy(F.col(rank_col).cast("long").alias("id")).agg(
        F.min(value).alias("first_lo"), F.max(value).alias("first_hi"))
    cells = cells.select("id", "first_lo", "first_hi", F.col("first_lo").alias("last_lo"), F.col("first_hi").alias("last_hi"),
                         F.col("id").alias("rank"))
    found = []
    for level in range(levels + 1):
        part = F.floor(F.col("id") / width) if level < levels else F.lit(0)
        along = Window.partitionBy(part).orderBy("id")
        bad = (F.lead("first_hi").over(along) > F.col("last_lo")) if descending else (F.lead("first_lo").over(along) < F.col("last_hi"))
        found.append(cells.withColumn("bad", bad).where("bad").select(F.col("rank").alias(rank_col)))
        if level < levels:
            cells = cells.groupBy(F.floor(F.col("id") / width).alias("id")).agg(
                *[F.min_by(c, F.col("id")).alias(c) for c in ("first_lo", "first_hi")],
                *[F.max_by(c, F.col("id")).alias(c) for c in ("last_lo", "last_hi", "rank")])
            cells = cells.select("id", "first_lo", "first_hi", "last_lo", "last_hi", "rank")
    return reduce(DataFrame.unionByName, found)


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """M5/M6: the content of a table whatever its order, as one row: (row_count, sum_a, sum_b), the sums of two 60-bit
    hashes of each row.  Partial sums merge in any order; equal rows count as often as they occur, and a
    null, an empty string and neighbouring values never run into each other."""
    cols = columns or df.columns
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in cols]
    md5 = F.md5(F.concat_ws("|", *parts).cast("binary"))
    half = [F.conv(F.substring(md5, at, 15), 16, 10).cast("decimal(20,0)") for at in (1, 16)]
    return df.select(half[0].alias("a"), half[1].alias("b")).agg(
        F.count(F.lit(1)).alias("row_count"), *[F.coalesce(F.sum(c), F.lit(0)).cast("string").alias(f"sum_{c}") for c in "ab"])


def rank_sequence(df: DataFrame, rank_col: str) -> DataFrame:
    """Ranks are exactly 1..N (count = max = count_distinct and min = 1); one row."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.max(rank_col).alias("mx"),
                  F.min(rank_col).alias("mn"), F.count_distinct(rank_col).alias("nd")) \
        .select(F.when((F.col("n") == 0) | ((F.col("n") == F.col("mx")) & (F.col("n") == F.col("nd"))
                                            & (F.col("mn") == 1)), 0).otherwise(1)
                .cast("long").alias("violations"))


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Schema metadata only, no job."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def missing_tables(spark: SparkSession, expected: list[str]) -> list[str]:
    """Expected tables/views absent from the catalog."""
    return [t for t in expected if not spark.catalog.tableExists(t)]


def _with_parents(df: DataFrame, fks, parents: dict[str, DataFrame]):
    """``df`` with a flag ``_orphan<i>`` for each foreign key whose parent is at hand: a non-null key without a
    parent row.  The parents' keys are made distinct, so no row multiplies."""
    used = [fk for fk in fks if fk.parent in parents]
    for i, fk in enumerate(used):
        keys = [F.col(pc).alias(f"_p{i}_{j}") for j, pc in enumerate(fk.parent_columns)]
        p = parents[fk.parent].select(*keys).distinct().withColumn(f"_found{i}", F.lit(True))
        on = [F.col(c) == F.col(f"_p{i}_{j}") for j, c in enumerate(fk.columns)]
        nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fk.columns])
        df = (df.join(p, reduce(lambda a, b: a & b, on), "left")
              .withColumn(f"_orphan{i}", (nn & F.col(f"_found{i}").isNull()).cast("long")).drop(f"_found{i}", *[f"_p{i}_{j}" for j in range(len(keys))]))
    return df, used


def _fk_name(table: str, fk) -> str:
    return fk.name or f"fk_{table}_{'_'.join(fk.columns)}"


def _long_form(wide: DataFrame, table: str, names: list[str]) -> DataFrame:
    """One-row counts c0, c1, ... as (table_name, constraint_name, violations) rows."""
    rows = F.array(*[F.struct(F.lit(n).alias("constraint_name"), F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias("violations"))
                     for i, n in enumerate(names)])
    return wide.select(F.explode(rows).alias("x")).select(F.lit(table).alias("table_name"), "x.constraint_name", "x.violations")


def fk_report(child: DataFrame, table: str, fks, parents: dict[str, DataFrame]) -> DataFrame:
    """Orphans of every foreign key of ``table``, in one pass over it."""
    df, used = _with_parents(child, fks, parents)
    wide = df.agg(*[F.sum(f"_orphan{i}").alias(f"c{i}") for i in range(len(used))])
    return _long_form(wide, table, [_fk_name(table, fk) for fk in used])


def table_violations(tables: dict[str, DataFrame], specs: dict[str, TableSpec],
                     parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Summary (table_name, constraint_name, violations) for PK, UNIQUE, NOT NULL,
    CHECK and FK constraints of every table present in ``tables``.

    Each table is read once: its rows get a found-flag per FK, then one partially
    aggregated group-by on the primary key counts the rows of a key and sums its row-level
    violations.  Each UNIQUE key other than the primary key is a group-by of its own.
    ``parents`` (default: ``tables``) are the tables FKs are resolved against -- e.g. a new
    batch checked against the full staged parents.
    """
    parents = tables if parents is None else parents
    parts = []
    for name, spec in specs.items():
        if name not in tables:
            continue
        pk = spec.primary_key
        df, fks = _with_parents(tables[name], spec.foreign_keys, parents)
        checks = {}
        cols = [c for c in spec.not_null if c in df.columns]
        if cols:
            checks["not_null"] = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") for c in cols])
        for n, e in spec.checks.items():
            checks[n] = F.coalesce(~F.expr(e), F.lit(False)).cast("long")
        for i, fk in enumerate(fks):
            checks[_fk_name(name, fk)] = F.col(f"_orphan{i}")
        keyed = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("_rows"),
                                    *[F.sum(c).alias(f"_v{i}") for i, c in enumerate(checks.values())])
        null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in pk])
        # rows without a key, and all but one of the rows of a key
        wide = keyed.agg(F.sum(F.when(null_key, F.col("_rows")).otherwise(F.col("_rows") - 1)).alias("c0"),
                         *[F.sum(f"_v{i}").alias(f"c{i + 1}") for i in range(len(checks))])
        parts.append(_long_form(wide, name, ["primary_key", *checks]))
        for u in spec.unique:
            cname = "unique_" + "_".join(u)
            d = duplicate_keys(tables[name], name, u, cname)
            parts.append(_long_form(d.agg(F.sum(F.col("occurrences") - 1).alias("c0")), name, [cname]))
    return reduce(DataFrame.unionByName, parts).select(*_SUMMARY_COLS)


def integrity_report(tables: dict[str, DataFrame], specs: dict[str, TableSpec],
                     parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """M8: one row per check with violations and PASS/FAIL."""
    return table_violations(tables, specs, parents).withColumn(
        "status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))
