"""Spark session settings and intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a stored table from which joins do not send it to all executors: compressed keys shrink twentyfold.
LARGE = 1 << 20
#: Blocks of what the driver sends: below half a region (1 MB) of a heap of up to 2 GB.
SENT_IN = "256k"

_written: list[tuple[SparkSession, str]] = []


def session(app: str = "kinfold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect (UTC, adaptive plans)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.broadcast.blockSize": SENT_IN,
    } | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset and the master is
    local (driver and executors are one process) a temporary folder is made; on a cluster it
    is an error, as executors would write to disks of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = "file://" + tempfile.mkdtemp(prefix="kinfold-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def fresh_path(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A new path below the shared folder, removed when the driver exits unless ``keep``."""
    path = f"{shared_dir(spark)}/kinfold-{label}-{uuid.uuid4().hex}"
    if not keep:
        _written.append((spark, path))
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    Cuts the lineage: a lost executor costs no recomputation of what is written.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kinfold_path = path
    return out


def unsent(df: DataFrame, *stored: DataFrame) -> DataFrame:
    """``df``, made of tables that ``materialize`` gave: joins do not take it for small by the bytes of a large one's files.

    A broadcast is built in the driver's memory. The hint goes through all that has one input,
    but is lost in unions and joins, whose results need it anew.
    """
    return df.hint("merge") if any(_bytes(t) > LARGE for t in stored) else df


def tidy(spark: SparkSession) -> None:
    """Collect the driver's garbage once its heap has grown to over half of its bound.

    Plans, their metrics and broadcasts that nothing needs any more fill a heap up to its bound
    before the JVM collects them, however little is in use; a collection also gives memory back,
    and lets Spark remove the shuffles and broadcasts of steps that have ended.
    """
    jvm = spark.sparkContext._jvm
    heap = jvm.java.lang.Runtime.getRuntime()
    if heap.totalMemory() > heap.maxMemory() // 2:
        jvm.java.lang.System.gc()


def small_blocks(spark: SparkSession) -> None:
    """Have the driver send things in blocks of ``SENT_IN``, unless the session says in which; results are the same.

    The tasks of every stage and the settings of every scan are broadcasts of a few KB. Each takes
    a whole block of the driver's heap, of 4 MB by Spark's default: five regions in a row, for
    which the heap grows where no such row is free, however little of it is in use. Spark reads
    the setting at each broadcast, so that it also holds for a session that was made elsewhere.
    """
    spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().conf().setIfMissing("spark.broadcast.blockSize", SENT_IN)


def _bytes(table: DataFrame) -> int:
    spark = table.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._kinfold_path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def release(*tables: DataFrame) -> None:
    """Delete what ``materialize`` wrote for ``tables``, once nothing will read them any more."""
    for table in tables:
        path = table.__dict__.pop("_kinfold_path", None)
        if path is not None:
            discard(table.sparkSession, path)
            _written.remove((table.sparkSession, path))


def discard(spark: SparkSession, path: str) -> None:
    """Delete ``path`` in whatever store holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _discard_all() -> None:
    for spark, path in _written:
        try:
            discard(spark, path)
        except Exception:  # the session has ended; the cluster's own retention removes the folder
            return
