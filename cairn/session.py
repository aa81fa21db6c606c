"""Session construction and the shared working folder that iterative operators write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "cairn", master: str | None = None, **conf: str) -> SparkSession:
    """Return the active session, or build one with adaptive execution and UTC on.

    Settings given as keyword arguments use ``__`` for the dots of a Spark key.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir``, or a fresh local one where it is unset.

    The local fallback is for single-machine runs (tests, benchmarks); a cluster names its own folder, and without one
    a RuntimeError says so.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="cairn-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


#: Whether Spark deletes the shuffle files of a plan once it has run; else they stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Workspace:
    """Parquet tables of one operator run, under one folder of :func:`shared_dir`.

    Writing a table cuts the lineage at a point that survives lost executors: every executor rereads it, and the
    shuffle files of its plan are deleted.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, tag: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{tag}"

    def save(self, df: DataFrame, tag: str) -> DataFrame:
        path = self.path(tag)
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete a saved table that nothing will read again."""
        for path in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
            if path.startswith(self.root) or path.split(":", 1)[-1].lstrip("/").startswith(self.root.split(":", 1)[-1].lstrip("/")):
                jvm = self.spark.sparkContext._jvm
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
