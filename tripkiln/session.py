"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.driver.memory": "8g",
}


def local_session(cores: int | str = 8, app: str = "tripkiln", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: The JVM never compiles a method of more than 8,000 bytes of bytecode, and compiles
#: long ones late and poorly (the gold stage took twice as long with 8000 as with 3000).
LARGEST_METHOD = 3000


def compiled_stages(spark: SparkSession) -> None:
    """Keep wide projections compiled.

    Spark fuses a stage into one method, which for rows of fifty columns is
    larger than the JVM compiles: every row is then interpreted. With this
    limit such a stage runs operator by operator, whose code Spark splits
    into small methods. A lower limit that the session has already is kept."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit, "65535")) > LARGEST_METHOD:
        spark.conf.set(limit, str(LARGEST_METHOD))


#: Bytes of files whose rows are shuffled together where a job works in slices
#: (shuffled rows take some four times the bytes they have in files).
SLICE_BYTES = 512 << 20


def slices_of(df: DataFrame, times: int = 1, size: int | None = None) -> int:
    """In how many slices to shuffle the rows of ``df`` (of ``times`` SLICE_BYTES each), by
    their ``size`` or the planner's estimate (for files: their size); one where nothing is
    known. Every slice reads the input once, so there are 64 at most."""
    try:
        size = size if size is not None else int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:  # Spark Connect
        return 1
    return min(64, max(1, -(-size // (times * SLICE_BYTES))))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (``spark.checkpoint.dir``).

    On a cluster the folder must be configured (a shared file system); only
    a local-mode session without one gets a fresh temporary folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: configuration only
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    master = sc.master if sc else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="tripkiln-ckpt-")
    if sc:
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for an input of ``input_bytes`` on a cluster.

    * scan splits of ``target_partition_bytes`` (fewer, larger tasks);
    * initial shuffle partitions so that a shuffle as large as the input
      lands near the target size per partition (the gold stage shuffles
      whole rows), at least 200; AQE then coalesces small ones;
    * AQE skew-join split of partitions 5x the median and over the target;
    * broadcast threshold 64 MB (hot-key and small count tables).
    """
    partitions = max(200, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
