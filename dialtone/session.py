"""Session helpers.

A cluster passes its own settings (master, shuffle partitions, checkpoint
folder); these helpers only fill in what is unset, which is what tests and the
local bench need.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

# Results depend on these: timestamps in the driver's parquet are timestamp_ntz; pin the
# zone so date ids and hour differences never depend on the host.
REQUIRED_CONF = {"spark.sql.session.timeZone": "UTC"}
# Only plans depend on these; a session that pins another value keeps it.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# What a task that sorts its whole partition reads at most; rows in a sort take some 20 times their compressed bytes.
SORTED_BYTES = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "dialtone", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the required settings.

    ``master`` and ``shuffle_partitions`` are only applied when given, so a
    cluster launcher keeps control of them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in (REQUIRED_CONF | PLAN_CONF).items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Set the runtime settings the operators rely on (idempotent); raises where a session
    keeps another value of one that results depend on."""
    for k, v in (REQUIRED_CONF | PLAN_CONF).items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k) != v:
            raise RuntimeError(f"{k} must be {v}, not {spark.conf.get(k)}")


def _bytes(size: str) -> int:
    """The bytes that a size setting such as ``64MB`` or ``134217728b`` names."""
    n, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", size.lower()).groups()
    return int(n) << 10 * " kmgtp".index(unit or " ")


def bound_sorts(spark: SparkSession) -> None:
    """Keep the partitions of queries that sort them whole small, so that a task's memory stays as the
    tables grow and only the number of tasks grows; a session with smaller ones keeps them. Shuffles are coalesced to that
    size, from ``spark.sql.shuffle.partitions`` on, which ``scale_conf`` sizes for larger inputs."""
    for k, most in SORTED_BYTES.items():
        if _bytes(spark.conf.get(k)) > most:
            spark.conf.set(k, str(most))


def scale_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 256,
               most_partitions: int = 65_536) -> dict[str, str]:
    """Settings sized for a large input (e.g. 100 TB on 1000 executors).

    * shuffle partitions: about one per ``target_partition_mb`` of the largest
      shuffle (the detail's joins move roughly the input once), at least two
      waves of the cluster's cores; AQE then coalesces small partitions and
      splits skewed ones at run time;
    * beyond ``most_partitions`` partitions grow instead of their number. The driver keeps about a
      bit per (map, reduce) pair, 0.5 GB for 65,536 of each; 100 TB then makes partitions
      of 1.5 GB, which a task sorts and aggregates within 1 to 2 GB of execution memory and spills beyond;
    * file splits of the same size as partitions up to 1 GB, so that maps stay as few;
    * AQE advisory size equal to the target, so coalescing aims for it.
    """
    mb = 1024 * 1024
    target = max(target_partition_mb * mb, -(-input_bytes // most_partitions))
    parts = max(2 * total_cores, -(-input_bytes // target))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(min(target, 1024 * mb)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
    }


def scale_session(spark: SparkSession, paths: list[str]) -> None:
    """Apply ``scale_conf`` for the files under ``paths`` (any Hadoop file system)."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    size = 0
    for p in map(path_of, paths):
        fs = p.getFileSystem(hadoop)
        if fs.exists(p):
            size += fs.getContentSummary(p).getLength()
    for k, v in scale_conf(size, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(k, v)
