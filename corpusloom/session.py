"""Session construction and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a scan up to which :func:`spread` may deal its rows out anew.
SPREAD_BYTES = 1 << 30

_STAGED: dict[str, SparkSession] = {}


def build_session(app: str = "corpusloom", cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the operators are tuned for; on a cluster pass the cluster's own session instead."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session, or a temporary one where it is unset (local tests)."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    now = spark.sparkContext._jsc.sc().getCheckpointDir()
    if now.isDefined():
        return now.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, removed like a staged table."""
    path = f"{shared_folder(spark).rstrip('/')}/corpusloom/{name}-{uuid.uuid4().hex}"
    _STAGED[path] = spark
    return path


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: cuts lineage, is columnar and survives lost executors.

    The table is removed when the application ends or by :func:`drop_staged`.
    """
    spark = df.sparkSession
    path = own_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores if it is a small table: one file would keep one core busy with all parsing and scoring.

    A scan of more than :data:`SPREAD_BYTES` (by the files' sizes) stays as it is, so no large table is ever shuffled for this; its splits follow
    ``spark.sql.files.maxPartitionBytes``.  Columns and filters still reach the scan.
    """
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > SPREAD_BYTES:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores else df.repartition(cores)


def drop_staged() -> None:
    """Remove every table written by :func:`stage` in this process."""
    for path, spark in list(_STAGED.items()):
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM may be gone already
            pass
        _STAGED.pop(path, None)


atexit.register(drop_staged)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once per application; nothing to do where they import it already."""
    sc = spark.sparkContext
    if getattr(sc, "_corpusloom_shipped", False):
        return
    import shutil
    from pathlib import Path

    package = Path(__file__).resolve().parent
    if package.suffix != ".zip" and package.parent.suffix != ".zip":
        folder = tempfile.mkdtemp(prefix="corpusloom-ship-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.addPyFile(shutil.make_archive(str(Path(folder) / "corpusloom_pkg"), "zip", root_dir=package.parent, base_dir=package.name))
    sc._corpusloom_shipped = True
