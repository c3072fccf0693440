"""Session settings the operators rely on, and the folder they may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Timestamps at rest carry no zone (TIMESTAMP_NTZ); elapsed times are taken in UTC.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Streaming state on local disk instead of the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# What the retail tables' plans count on besides.
TABLE_CONF = {
    # Groups of rows that are sorted already are summed up as they pass, not in a table of all groups.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # Packed tables are larger in memory; joins should not broadcast them by their size on disk.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # Sales and returns that lie by order are joined by order and sale id where they are, without another shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime settings the operators assume; cluster sizing is left alone."""
    return _set(spark, REQUIRED_CONF)


def prepare_tables(spark: SparkSession) -> SparkSession:
    """As :func:`prepare`, for sessions that build the retail tables."""
    return _set(spark, REQUIRED_CONF | TABLE_CONF)


def _set(spark: SparkSession, conf: dict[str, str]) -> SparkSession:
    for key, value in conf.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("retailloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Small files would otherwise be packed into fewer tasks than there are cores.
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))
    )
    for key, value in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the session.

    Only a local-mode session without the setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    own = tempfile.mkdtemp(prefix="retailloom-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing is overwritten."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/retailloom/{app}/{label}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when it does not exist."""
    if not path_exists(spark, path):
        return []
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in fs.listStatus(jvm_path)]
