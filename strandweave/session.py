"""Session helpers: the shared folder, and tables that cut a plan's lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, as in tests, a temporary one, on a local master only."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="strandweave-"))
    return _OWN[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by keys to a number of parts of its own, for joins that make far more bytes than they read.

    Parts of a plain shuffle are put together at run time by the few bytes they read, so that some tasks hold all.
    """
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


class Cut:
    """``df`` written once as Parquet in the shared folder; ``.df`` rereads it, so a lost executor costs no recomputation.

    ``drop()`` deletes the files as soon as nothing later reads them.
    """

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = fresh_path(self.spark, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
