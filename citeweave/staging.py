"""Written intermediate tables.

A staged table cuts lineage, survives the loss of executors, and gives the planner the true
size of what follows: Spark then broadcasts it only if its files are below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise. The library therefore
carries no broadcast hints.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, the warehouse.

    Executors share both. A machine's temporary folder is never used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def broadcastable(staged: DataFrame) -> bool:
    """Whether the planner would broadcast a written table by its size."""
    size = int(str(staged._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= staged.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


class Staging:
    """One run's folder of written tables below the shared folder.

    The folder goes away with ``release`` (or at the end of a ``with`` block), and at the
    latest when the application ends.
    """

    def __init__(self, spark: SparkSession, label: str = "run"):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/citeweave/{label}-{uuid.uuid4().hex}"
        self._count = 0
        self._folder = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._files = self._folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._files.mkdirs(self._folder)
        self._files.deleteOnExit(self._folder)

    def path(self, name: str) -> str:
        """A path in this folder that no earlier call has returned."""
        self._count += 1
        return f"{self.root}/{self._count:03d}-{name}"

    def write(self, df: DataFrame, name: str = "table") -> DataFrame:
        """Write ``df`` and return the table read back."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_some(self, df: DataFrame, name: str = "table") -> tuple[DataFrame, bool]:
        """As ``write``, and whether any row was written, as seen by the write itself."""
        seen = Observation()
        # A repeated task may be seen twice, so this is no exact count.
        table = self.write(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
        try:
            return table, seen.get["rows"] > 0
        except Py4JJavaError:
            # Spark leaves the counter out of a plan that it finds to be empty.
            return table, not table.isEmpty()

    def release(self) -> None:
        """Delete the folder once nothing reads from it any more."""
        self._files.delete(self._folder, True)

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *_exc) -> None:
        self.release()
