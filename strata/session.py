"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job expects. ANSI stays on (parsing uses try_* forms);
# the session zone is pinned so zone shifts are not applied twice.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "strata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict | None = None,
    persistent_catalog: bool = False,
) -> SparkSession:
    """Build (or reuse) a session with the library's base settings.

    ``persistent_catalog`` keeps databases and tables beyond the process (a
    Hive metastore, configured by the deployment); jobs that run as separate
    processes and name tables by ``layer.table`` need it.

    On a cluster leave ``master`` unset so spark-submit decides; size
    ``shuffle_partitions`` to the data (about 128-256 MB per partition),
    AQE coalesces what turns out smaller.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if persistent_catalog:
        builder = builder.enableHiveSupport()
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in settings.items():
        if not key.startswith("spark.ui") and not key.startswith("spark.driver"):
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf on an existing session
                pass
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Jobs that must cut lineage or stage files write below it. Only a local
    session that names none (tests) gets a private folder, registered so
    later calls agree; on a cluster an unset folder is an error, never a
    machine-local temp folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


_scratch: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder, removed by ``clear_scratch`` or when the process ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _scratch[path] = spark
    return path


def clear_scratch() -> None:
    """Remove the scratch folders of this process; frames that read them must have been consumed."""
    while _scratch:
        path, spark = _scratch.popitem()
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the JVM has gone before the process: the folder's retention policy applies
            pass


atexit.register(clear_scratch)

