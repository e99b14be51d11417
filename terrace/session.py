"""SparkSession helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for a large cluster (~100 TB inputs, ~1000 executors).  Shuffle
# partitions start high and AQE coalesces them to the advisory size, so one
# value fits every stage; skewed partitions above 5x the median and 256 MB are
# split; file splits of 512 MB keep scan tasks in the tens of thousands.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "terrace",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    where = master or SparkConf().get("spark.master", "local[*]")
    conf = dict(DEFAULT_CONF if where.startswith("local") else CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in spark.checkpoint.dir.

    A scratch folder is made only where nothing is configured and the master is local (tests): on a
    cluster the executors could not read the driver's folder, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="terrace-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def tables_root(spark: SparkSession) -> str:
    """The folder of this application's written tables; others may share the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/terrace-tables/{spark.sparkContext.applicationId}"


def materialize(df, name: str = "table"):
    """Write ``df`` once as Parquet under the shared ``spark.checkpoint.dir`` and
    return a DataFrame reading it back.

    This cuts the lineage like ``checkpoint()`` (the files survive executor
    loss) but the re-read is a Parquet scan: later consumers still get column
    pruning and filter pushdown.
    """
    path = f"{tables_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


def discard_tables(spark: SparkSession) -> None:
    """Delete what ``materialize`` wrote in this application, once nothing reads it any more; tables of other
    applications that share the checkpoint folder stay."""
    root = spark._jvm.org.apache.hadoop.fs.Path(tables_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
