"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

_local_scratch: dict[str, str] = {}


def build_session(app: str = "cardrail", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and times in UTC; ``conf`` wins over the defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # HotSpot leaves methods above 8000 bytes uncompiled; past that, per-operator code is faster
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster session without it is an
    error, since a machine-local folder would not be seen by the other executors.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="cardrail-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_folder(spark).rstrip('/')}/cardrail/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def kept_small(rows: DataFrame, name: str) -> DataFrame:
    """A small table, one row for each split or file, worked out now, stored, and sent to every task by joins.

    Left as a plan, the other side of its join is shuffled whole before its size is known; as a broadcast that is not
    worked out yet it runs into the broadcast's time limit on large inputs.
    """
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return F.broadcast(rows.sparkSession.read.schema(rows.schema).parquet(path))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder, in one step where the file system can; parents are made."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    system = new.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def subfolders(spark: SparkSession, path: str, with_times: bool = False) -> list:
    """The names of the folders right below ``path``, with the milliseconds of their last change if asked for; none if
    it is not there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(jvm_path):
        return []
    found = [(s.getPath().getName(), s.getModificationTime()) for s in system.listStatus(jvm_path) if s.isDirectory()]
    return found if with_times else [name for name, _ in found]


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder with what is in it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
