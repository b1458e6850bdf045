"""Spark session helpers.

The library never creates its own session inside operators; these helpers
are for scripts, tests and the benchmark.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants: AQE for runtime re-planning (partition coalescing,
# skew-join splitting, broadcast conversion by measured size), UTC so dates
# never shift, Arrow for the few pandas-backed operators.
BASE_CONF: dict[str, str] = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "demandgrid",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with :data:`BASE_CONF` applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """Where stored intermediates go: the cluster's shared checkpoint folder
    (``spark.checkpoint.dir``) if the session names one, else the warehouse
    folder. Never a machine-local temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/demandgrid-work"


def scratch_folder(spark: SparkSession) -> str:
    """A new name under :func:`work_folder`; what is written there goes when the
    application ends."""
    path = f"{work_folder(spark)}/{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under :func:`work_folder` and read it back: cuts
    lineage on reliable storage, keeps column pruning and filter pushdown. The
    files go when the application ends."""
    spark = df.sparkSession
    path = scratch_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (file-system metadata only,
    read on the driver; no data is scanned)."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(hconf).getContentSummary(path).getLength()
    return int(total)


def scale_conf(input_size: int, total_cores: int, shuffle_fraction: float = 0.1,
               partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a large run, from the input size and the cores.

    * scans: ``maxPartitionBytes`` = ``partition_bytes`` (about 400k scan
      tasks for 100 TB, some 50 waves on 8,000 cores);
    * shuffles: the widest shuffle is the fact join on the pruned key and
      date columns, about ``shuffle_fraction`` of the input; it starts with
      one partition per ``partition_bytes`` of it (at least 3 per core) and
      AQE coalesces small ones to the same advisory size and splits skewed
      ones (a hot key holding a third of the rows).
    """
    if input_size < 0 or total_cores < 1:
        raise ValueError("input_size must be >= 0 and total_cores >= 1")
    shuffle_bytes = int(input_size * shuffle_fraction)
    n = max(3 * total_cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }
