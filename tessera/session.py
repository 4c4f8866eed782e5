"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job expects. ANSI stays on (the 4.x default); time zone is UTC
# so timestamps, windows and partition dates agree across executors.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partition values such as "01" stay strings when read back (D7)
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(master: str = "local[*]", app: str = "tessera", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (UI off, no servers)."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the library needs to an existing session."""
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at shared storage;
    it is read from the session. Only when it is unset and the master is
    local (tests) a folder of our own is created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        sc = None
    path = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = sc.master if sc else spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared folder "
                               "(a machine-local folder is not valid on a cluster)")
        path = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return (sc.getCheckpointDir() if sc else None) or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once into a scratch table and read back: lineage ends at files
    every executor reaches."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def partition_settings(input_bytes: int, bytes_per_partition: int = 512 * 1024 * 1024,
                       max_partitions: int = 65536) -> dict[str, str]:
    """Shuffle / scan sizing for an input of ``input_bytes``.

    About one shuffle partition per 512 MiB of input (capped so the shuffle
    block count stays manageable); AQE coalesces small ones and splits skewed
    ones at runtime. Scan splits of 256 MiB keep a task's input well inside
    executor memory.
    """
    n = max(8, min(max_partitions, -(-int(input_bytes) // bytes_per_partition)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    }


def apply_partition_settings(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    settings = partition_settings(input_bytes)
    for k, v in settings.items():
        spark.conf.set(k, v)
    return settings
