"""Session construction and lineage cutting.

The library never creates a session implicitly; ``build_session`` is for
scripts, tests and the bench.  All configuration is public Spark SQL config.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time

from pyspark.sql import DataFrame, Observation, SparkSession

# Settings that the operators rely on or benefit from.
BASE_CONF = {
    # Wall clocks are TimestampNTZ; LTZ <-> NTZ casts must be identity.
    "spark.sql.session.timeZone": "UTC",
    # AQE: runtime join re-planning (broadcast only when the *measured* side is
    # small), partition coalescing and skew-join splitting of hot keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Broadcast only what is measured small (Spark's 10MB default); the AQE
    # threshold applies to runtime sizes of shuffle stages.
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "orderlens", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
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
    """Use the cluster's ``spark.checkpoint.dir``; only in local mode (tests,
    bench) fall back to a fresh scratch folder when the setting is unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a shared (HDFS/S3/...) folder is required on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="orderlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return configured


def materialize_table(df: DataFrame, name: str, partition_by=()) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Columnar and compressed (later scans prune columns and push filters),
    reliable across executor loss, and it cuts the lineage of a table that
    several downstream jobs reuse.  The table goes when the application ends.
    """
    return materialize_parts([df], name, partition_by)[0]


def materialize_parts(parts: list[DataFrame], name: str, partition_by=(), release: bool = False) -> tuple[DataFrame, list[DataFrame]]:
    """``materialize_table`` of a table given in parts, which are written one after another: the whole table, and its parts.

    With ``release`` the shuffles of a part go before the next one is written, so that the disk holds those of one part.
    A table with partition columns is one folder that is not read by part.
    """
    import uuid

    spark, df = parts[0].sparkSession, parts[0]
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/orderlens-tables/{name}-{uuid.uuid4().hex[:12]}"
    folders = [path] * len(parts) if partition_by or len(parts) == 1 else [f"{path}/{i}" for i in range(len(parts))]
    for part, folder in zip(parts, folders):
        w = part.write.mode("append").option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(folder)
        if release:
            release_shuffles(spark)
    drop_at_exit(spark, path)

    # the schema is known; an empty partitioned table has no file that holds it
    def read(*where):
        return spark.read.schema(df.schema).parquet(*where)

    out = read(*dict.fromkeys(folders))
    return (out.select(*df.columns), []) if partition_by else (out, [read(f) for f in folders])


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the files of shuffles that no plan refers to any more.  It notices them at collections of the driver's
    garbage only, so otherwise they stay, and add up over the stages, until the driver happens to need memory.
    The first collection frees the finished executions, the next one the shuffles that they held."""
    for _ in range(2):
        gc.collect()
        spark._jvm.java.lang.System.gc()
        time.sleep(0.5)


def observed(seen: Observation) -> dict:
    """Metrics that a write observed; none where the optimizer found that there are no rows to read."""
    return seen.get if seen._jo.getRow().schema() is not None else {}


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system remove a temporary table when the application ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def temporary_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder that goes when the application ends."""
    import uuid

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
    drop_at_exit(spark, path)
    return path
