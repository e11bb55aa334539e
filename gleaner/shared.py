"""Tables in the folder that all executors share, to cut lineage between the phases of a run."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only under a local master, as in tests, a temporary folder is made and set
    where none is named; on a cluster that would be each machine's own.
    """
    found = spark.conf.get(CHECKPOINT_DIR, None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="gleaner-")
        spark.conf.set(CHECKPOINT_DIR, found)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: Ids that are broadcast at most; more meet by shuffle.
BROADCAST_ROWS = 2_000_000


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer partitions than there are cores, dealt out anew; others as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    planned = df._jdf.queryExecution().executedPlan().toString()
    return df.repartition(cores) if "Exchange" not in planned and df.rdd.getNumPartitions() < cores else df


def deal(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by a key for a costly pass: four parts a core, or as many as there are if that is more.

    The parts of a scan say little of where its rows are: a file is cut by bytes, but a
    row group, which may hold all of them, goes to one part.
    """
    return df.repartition(max(4 * df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()), key)


def pick(wide: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """Rows of ``wide`` whose key a written table ``chosen`` has, with its columns: without a shuffle of ``wide`` if the chosen are few."""
    few = chosen.count() <= BROADCAST_ROWS
    return wide.join(F.broadcast(chosen) if few else chosen, key)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table that this run wrote into the shared folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


class Shared:
    """Tables in the shared folder: written once, read again, so they survive the loss of any executor.

    ``drop`` deletes those that no later read needs; the others go when the Python
    process ends.
    """

    def __init__(self, spark: SparkSession, name: str = "run"):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/gleaner-{name}-{uuid.uuid4().hex[:12]}"
        atexit.register(self._end)

    def _end(self) -> None:
        try:
            drop_path(self.spark, self.root)
        except Exception:  # the JVM may be gone already; the folder is the cluster's scratch space
            pass

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def add(self, df: DataFrame, name: str, part: int) -> None:
        """Writes a part of a table that grows by rounds; a part that is written again is replaced."""
        df.write.mode("overwrite").parquet(f"{self.path(name)}/part={part}")

    def parts(self, name: str, schema: str) -> DataFrame:
        """All parts of such a table as one scan, with their numbers in ``part``."""
        return self.spark.read.schema(f"{schema}, part int").parquet(self.path(name))

    def drop(self, name: str) -> None:
        drop_path(self.spark, self.path(name))
