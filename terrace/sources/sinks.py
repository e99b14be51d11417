"""Bronze/silver writers and readers, manifests, the quality report file
(S5-S14).  Writers never overwrite a batch: every batch lands in its own
``batch_id=`` partition, which makes the bronze layer immutable in fact."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators.quality import RECORD_INDEX


def stamp_lineage(df: DataFrame, source: str, ingested_at: str | None = None) -> DataFrame:
    """One batch timestamp and a source label on every record."""
    ts = ingested_at or _dt.datetime.now(_dt.timezone.utc).isoformat()
    return df.withColumn("_ingested_at", F.lit(ts)).withColumn("_source", F.lit(source))


def file_order_index(df: DataFrame, out: str = RECORD_INDEX) -> DataFrame:
    """The place of each record of a batch read from files, counted from 0 without gaps: files by path, records
    as they stand in them.  How Spark packs splits into tasks does not matter: records are numbered inside their
    split (one window a split, as large as what one task read), and the records of earlier splits, one row a split, are
    added up in front of them.  ``df`` is a scan, perhaps filtered; after a shuffle the order inside a split is gone."""
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_row"))
    blocks = placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_file", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_row"))
    return placed.join(blocks, ["_file", "_block"]).withColumn(out, (F.col("_before") + within - 1).cast("long")) \
        .select(*[c for c in df.columns if c != out], out)


def stamp_record_index(df: DataFrame) -> DataFrame:
    """The place of each record in its batch: the order of the files where the batch is read from files, else that of
    the input's partitions.  To be called once, on what is written: the index is then read back, never made again."""
    try:
        df.select("_metadata.file_path")
    except AnalysisException:
        return df.withColumn(RECORD_INDEX, F.monotonically_increasing_id())
    return file_order_index(df)


def write_bronze(df: DataFrame, root: str, dataset: str, batch_id: str) -> str:
    """Raw batch as JSON lines under <root>/<dataset>_raw/batch_id=<id>."""
    path = f"{root.rstrip('/')}/{dataset}_raw/batch_id={batch_id}"
    df.write.mode("error").json(path)
    return path


def read_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None,
                multiline: bool = False) -> DataFrame:
    """JSON batch with an explicit schema.  ``multiline`` reads a JSON array
    file (one unsplittable task per file -- large inputs should be JSON lines)."""
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_bronze_raw(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Records as ``map<string,string>`` so an *absent* key differs from an
    explicit null (Q1/Q3): ``map_contains_key(record, k)``."""
    if multiline:
        return spark.read.text(path, wholetext=True).select(
            F.explode(F.from_json("value", "array<map<string,string>>")).alias("record"))
    return spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("record"))


def write_silver(df: DataFrame, root: str, dataset: str, fmt: str = "parquet",
                 mode: str = "error") -> str:
    """S8/S9 (+ Parquet as the primary format): <root>/<dataset>_clean.<fmt>."""
    path = f"{root.rstrip('/')}/{dataset}_clean.{fmt}"
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)
    return path


def read_silver_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a declared schema; the text 'N/A' stays text."""
    return spark.read.schema(schema).option("header", True).csv(path)


def batch_manifest(datasets: dict[str, DataFrame], paths: dict[str, str] | None = None) -> DataFrame:
    """(dataset, record_count, path) per dataset plus a 'total' row."""
    paths = paths or {}
    per = reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("dataset"), "record_count",
            F.lit(paths.get(name)).cast("string").alias("path"))
        for name, df in datasets.items()])
    total = per.agg(F.lit("total").alias("dataset"),
                    F.sum("record_count").cast("long").alias("record_count"),
                    F.lit(None).cast("string").alias("path"))
    return per.unionByName(total)


def write_quality_report(report: DataFrame, path: str) -> str:
    """Written before the gate decides, so a FAIL leaves the artefact."""
    report.coalesce(1).write.mode("overwrite").json(path)
    return path


class ReportNotGenerated(FileNotFoundError):
    pass


def read_quality_report(spark: SparkSession, path: str) -> DataFrame:
    """Typed error when no report exists yet."""
    try:
        return spark.read.json(path)
    except AnalysisException as e:
        if not path_missing(e):
            raise
        raise ReportNotGenerated("Quality report has not been generated yet.") from e


def path_missing(e: AnalysisException) -> bool:
    """True if a read failed because its path does not exist (and not, say, for want of permission)."""
    return e.getCondition() == "PATH_NOT_FOUND"
