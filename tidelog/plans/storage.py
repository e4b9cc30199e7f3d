"""Shared folders and the Hadoop file system."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: The option by which stores create a file only if it isn't there, and schemes whose plain creation is so (fixed values).
CONDITIONAL = "fs.option.create.conditional.overwrite"
EXCLUSIVE = ("file", "hdfs", "webhdfs", "viewfs", "abfs", "abfss", "gs")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local session (tests) gets a
    temporary folder of its own; on a cluster that is an error, as no machine would see another's files."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: lineage is cut, and later reads take only the columns they need."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def plain(path: str) -> str:
    """The path of a file URI on this machine."""
    return "/" + path.removeprefix("file:").lstrip("/")


class Files:
    """Moves and listings that only touch names, on whatever file system the root is on."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)
        self.local = self.fs.getScheme() == "file"

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def create(self, name: str, text: str) -> None:
        """Create the small file name; if it is there with another text, raise. Of several writers at once one succeeds.

        Stores that create on condition are made to (a store that can't obey the option fails); otherwise only file
        systems whose creation is exclusive are accepted.
        """
        at = self.path(name)
        if self.fs.hasPathCapability(at, CONDITIONAL):
            build = lambda: self.fs.createFile(at).overwrite(False).must(CONDITIONAL, "true").recursive().build()
        elif self.fs.getScheme() in EXCLUSIVE:
            build = lambda: self.fs.create(at, False)
        else:
            raise ValueError(f"{self.fs.getScheme()} offers no creation that only one writer can do; the archive can't be written safely")
        try:
            out = build()
            out.write(text.encode())
            out.close()
        except Exception as e:
            if not self.fs.exists(at):
                raise
            if self.text(name) != text:
                raise FileExistsError(f"{name}: another writer has committed here") from e

    def text(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        return [x.getPath().getName() for x in self.fs.listStatus(self.path(folder))]

    def stale(self, folder: str, before_ms: int) -> list[str]:
        """What lies in folder and hasn't changed since before_ms."""
        at = self.path(folder)
        return [x.getPath().toString() for x in self.fs.listStatus(at) if x.getModificationTime() < before_ms] if self.fs.exists(at) else []

    def make(self, folder: str) -> None:
        self.fs.mkdirs(self.path(folder))

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)
