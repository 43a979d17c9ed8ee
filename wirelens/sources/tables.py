"""Where intermediate tables live."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def durable_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only a local master may leave it unset, as in
    tests; on a cluster a folder of this machine would be one that executors don't see."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("wirelens.shared.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("wirelens.shared.dir", folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used; what is written there is removed when the application ends."""
    path = f"{durable_folder(spark)}/wirelens-{uuid.uuid4().hex}/{label}"
    parent = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    parent.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(parent)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again, so that lost executors cost no recomputation and
    what follows isn't merged with what made it. The table is removed when the application ends.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` over all cores: for rows that come from few row groups and then take long to work on."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)
