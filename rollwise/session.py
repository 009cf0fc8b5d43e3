"""Session helpers: one place for the settings every job in the package relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that hold for any deployment: adaptive execution re-plans joins and
# coalesces small shuffle partitions at runtime, skewed join partitions are split.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rollwise") -> SparkSession:
    """A local session for tests and the bench; a cluster passes its own session."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    b = (
        b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ROLLWISE_DRIVER_MEMORY", "4g"))
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
        # Small local inputs: keep post-shuffle stages spread over the cores; the array work
        # in them is CPU-bound, not I/O-bound.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int, *, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings to pass to a cluster session for a job reading ``input_bytes`` on ``total_cores``.

    Shuffle partitions start at about one per ``target_partition_bytes`` of input (never
    fewer than 2 per core), so every post-shuffle task fits in executor memory and spills
    little; adaptive execution then coalesces small ones and splits skewed ones. Scans use
    ``maxPartitionBytes`` splits of the same size. The values are a starting point.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that has none (tests) gets a scratch folder; a cluster must name one.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir()
    if hasattr(current, "isDefined"):
        current = current.get() if current.isDefined() else None
    if current:
        return str(current)
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="rollwise-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a materialised intermediate table."""
    return ensure_checkpoint_dir(spark).rstrip("/") + "/" + name
