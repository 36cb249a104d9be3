"""Session helpers: local sessions for tests/bench, reliable materialisation."""

from __future__ import annotations

import logging
import tempfile
import zipfile
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "segmint") -> SparkSession:
    """A local session for tests and the bench. Production callers pass their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the session's Python workers (once per application).

    A driver that has the package only on its own ``sys.path`` would otherwise leave
    the workers with ``ModuleNotFoundError``. ``spark-submit --py-files`` does the same.
    """
    sc = spark.sparkContext
    if getattr(sc, "_segmint_shipped", False):
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="segmint-zip-")) / "segmint_package.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(Path(root.name) / f.relative_to(root)))
    sc.addPyFile(str(path))
    sc._segmint_shipped = True


def ensure_checkpoint_dir(spark: SparkSession, fallback_local: bool = False) -> str | None:
    """Point the context at the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Only when that is unset and
    ``fallback_local`` is asked for and the session is a local one (tests, single
    machine) a fresh temporary folder is used; on a cluster that is an error, as
    the executors don't share the driver's folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if fallback_local:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="segmint-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
        sc.setCheckpointDir(path)
        return path
    return None


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several jobs will read.

    With a shared checkpoint folder the frame is checkpointed (survives lost
    executors without recomputing joins). Without one it is persisted to
    memory and disk; lost blocks are then recomputed from lineage.
    """
    spark = df.sparkSession
    if ensure_checkpoint_dir(spark):
        return df.checkpoint(eager=True)
    log.warning("spark.checkpoint.dir is unset; persisting instead of checkpointing")
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def materialize_table(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Cut the lineage by writing a parquet table into the shared checkpoint folder.

    Unlike ``checkpoint()``, a table partitioned by ``partition_by`` lets later
    filters on those columns read only their own folders (partition pruning).
    Without a checkpoint folder the frame is persisted instead.
    """
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    if not base:
        log.warning("spark.checkpoint.dir is unset; persisting instead of writing a table")
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = f"{base.rstrip('/')}/table-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)
