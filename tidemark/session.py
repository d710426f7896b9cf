"""Session construction and the few session-level settings the library relies on.

Operators never set configuration themselves; they only read it. ``build_session`` is a
convenience for scripts and tests. On a cluster the caller's own session is used as is.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job here is planned around. AQE turns a shuffled join into a broadcast
# join only after measuring the small side at run time, splits skewed join partitions,
# and coalesces tiny shuffle outputs; the UI stays off (no server is started).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MIB = 1 << 20


def cluster_conf(input_bytes: int, executor_cores: int = 4) -> dict[str, str]:
    """Settings for a large cluster, sized from the bytes the biggest job reads.

    Shuffles start with one partition per ~128 MiB of input (AQE then coalesces to
    ~256 MiB partitions and splits skewed join partitions), scan tasks read up to 512 MiB,
    and broadcasts are decided at run time on measured sizes below 64 MiB. Executors being
    decommissioned hand their shuffle blocks over, so a lost node does not force the
    stages it served to rerun. ``spark.checkpoint.dir`` must be set by the caller to shared
    storage.
    """
    shuffle = max(input_bytes // (128 * MIB), 200)
    return {
        **DEFAULT_CONF,
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MIB),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MIB),
        "spark.sql.files.maxPartitionBytes": str(512 * MIB),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MIB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MIB),
        "spark.executor.cores": str(executor_cores),
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.storage.decommission.rddBlocks.enabled": "true",
    }


def build_session(
    master: str = "local[8]",
    app_name: str = "tidemark",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
    catalog_dir: str | None = None,
) -> SparkSession:
    """A session with ``DEFAULT_CONF``. With ``catalog_dir`` the catalog persists across
    processes (D7): a Hive metastore kept in an embedded Derby database and the managed
    tables' warehouse, both under that folder, so an incremental run finds the tables and
    marks of the previous one. Without it the in-memory catalog forgets tables at exit."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if catalog_dir:
        conf["spark.sql.warehouse.dir"] = f"{catalog_dir}/warehouse"
        conf["spark.hadoop.javax.jdo.option.ConnectionURL"] = (
            f"jdbc:derby:;databaseName={catalog_dir}/metastore_db;create=true"
        )
        conf["spark.driver.extraJavaOptions"] = f"-Dderby.system.home={catalog_dir}"
        builder = builder.enableHiveSupport()
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where none is configured.

    On a cluster the folder must be shared storage named by ``spark.checkpoint.dir``; a
    machine-local folder would not survive the loss of an executor, so a missing setting
    is an error there. In local mode (tests) a fresh temporary folder is used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage before running "
            "jobs that cut lineage"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    return sc.getCheckpointDir()

