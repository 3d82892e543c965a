"""Session helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of the data folder `sf_dir`."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.

    Only a local session without that setting (as in tests) gets a folder of its own.
    """
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="stratagrid-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


_OPEN = threading.local()


def opened() -> list[Workspace]:
    """Workspaces of this thread that have not been removed, in the order they were opened."""
    if not hasattr(_OPEN, "spaces"):
        _OPEN.spaces = []
    return _OPEN.spaces


class Workspace:
    """Tables written to the shared folder to cut lineage; a lost executor rereads them.

    Results read them lazily; `remove` deletes them once a result has been written.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._count = 0
        opened().append(self)

    def remove(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        if self in opened():
            opened().remove(self)

    def cut(self, df: DataFrame) -> DataFrame:
        """`df`, written once and read back."""
        self._count += 1
        path = f"{self.root}/{self._count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def discard(self, *frames: DataFrame) -> None:
        """Delete tables that no later result reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for df in frames for f in df.inputFiles()}:
            if "/".join(self.root.split("/")[-1:]) in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)
