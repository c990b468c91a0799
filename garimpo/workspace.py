"""Session, shared scratch space and versioned state folders.

Everything an operator has to keep between jobs is a Parquet table below the folder the cluster names in
``spark.checkpoint.dir``: it outlives executors, cuts lineage, and needs no machine-local folder.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "garimpo", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the driver brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. A temporary one is made only in local mode and only if none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="garimpo-"))
        found = spark.sparkContext.getCheckpointDir()
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/garimpo/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and a lost executor costs nothing."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_WRITTEN: dict[tuple, str] = {}


def load_of(df: DataFrame) -> str:
    """What a table was read from: its files with sizes and times. Another load has another name."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for name in sorted(df.inputFiles()):
        at = jvm.org.apache.hadoop.fs.Path(name)
        status = at.getFileSystem(conf).getFileStatus(at)
        seen.append((name, status.getLen(), status.getModificationTime()))
    return hashlib.sha256(json.dumps(seen).encode()).hexdigest()


def once_a_load(source: DataFrame, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()``, written once for each load of ``source`` and session, and read by whoever asks again."""
    spark = source.sparkSession
    key = (spark.sparkContext.applicationId, shared_dir(spark), name, load_of(source))
    at = _WRITTEN.get(key)
    if at is not None:
        jvm = spark.sparkContext._jvm
        done = jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
        if done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
            return spark.read.parquet(at)
    df, at = build(), fresh(spark, name)
    df.write.parquet(at)
    _WRITTEN[key] = at
    return spark.read.schema(df.schema).parquet(at)


def clear(spark: SparkSession) -> None:
    """Remove everything written with ``fresh`` or ``cut``; call it when no result that reads from there is needed any more."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/garimpo")
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class Versions:
    """A folder of table versions with one pointer file that is swapped by rename.

    A reader sees the old state or the new one, never a mixture: all tables of a version are written first, the pointer
    last. A writer that dies leaves an unreferenced folder.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, name: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(name)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def current(self) -> dict:
        fs, p = self._fs(f"{self.path}/_manifest.json")
        if not fs.exists(p):
            return {"version": 0, "tables": {}}
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def table(self, name: str) -> DataFrame | None:
        at = self.current()["tables"].get(name)
        return None if at is None else self.spark.read.parquet(*([at] if isinstance(at, str) else at))

    def stage(self, name: str, version: int) -> str:
        return f"{self.path}/v{version:06d}-{uuid.uuid4().hex[:8]}/{name}"

    def publish(self, tables: dict, **extra) -> dict:
        """Swap the pointer; ``tables`` maps a name to its path or list of paths."""
        old = self.current()
        new = {"version": old["version"] + 1, "tables": old["tables"] | tables} | extra
        fs, tmp = self._fs(f"{self.path}/_manifest.{uuid.uuid4().hex}")
        out = fs.create(tmp, True)
        out.write(bytearray(json.dumps(new).encode()))
        out.close()
        jvm = self.spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(tmp.toUri() if tmp.toUri().getScheme() else fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(tmp, jvm.org.apache.hadoop.fs.Path(f"{self.path}/_manifest.json"), overwrite)
        return new
