"""Session helper and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC so that dates and timestamps agree with the oracle,
# AQE for runtime coalescing and skew splitting.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Only for a local master: one JVM holds driver and executors, and tables are small; short row groups
# let the scan of a written layer use all cores (a cluster's tables have enough of the usual ones).
_LOCAL = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
          "spark.hadoop.parquet.block.size": str(4 << 20)}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "ledgerstar",
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster ``master`` stays None: the submitter decides on memory and partition
    counts, nothing of the kind is set here. Tests pass ``local[*]``; a local master gets
    few shuffle partitions unless told otherwise.
    """
    b = SparkSession.builder.appName(app)
    conf = dict(_DEFAULTS)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            conf |= _LOCAL
            shuffle_partitions = shuffle_partitions or 8
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Driver and executors are one process (``local-cluster`` starts executors of its own)."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; that value always wins. When it is
    unset, a local master gets a private scratch folder; any other master is an error,
    since executors could not see a folder of the driver.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(sc.master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder (master {sc.master})")
        d = tempfile.mkdtemp(prefix="ledgerstar-ckpt-", dir=os.environ.get("LEDGERSTAR_SCRATCH", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediate tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Jobs that write a table and are done with their shuffles: Spark deletes those files when the write ends, not
    when the driver's collector finds them, so they do not add up on the executors' disks."""
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, before)


_SENT: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application, by a file in the shared folder."""
    sc = spark.sparkContext
    if sc.applicationId in _SENT:
        return
    root, data = Path(__file__).parent, io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = f"{scratch_path(spark, 'code')}/{root.name}.zip"
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(data.getvalue())
    out.close()
    sc.addPyFile(path)
    _SENT.add(sc.applicationId)


_WRITTEN: list[tuple[SparkSession, str]] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs scan the files, and a lost executor
    costs nothing above them. :func:`drop_written` (also at interpreter exit) deletes them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_written() -> None:
    """Delete the tables of :func:`written`; results that read them can no longer be computed."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        sc = spark.sparkContext
        if sc._jsc is not None:
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _at_exit() -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone by then
        drop_written()
