"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text column as a string, null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. A session that runs on this machine alone may name
    none and gets a folder under /tmp; on a cluster that is an error, since executors would write to
    disks of their own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.partition("[")[0] == "local":
        return "/tmp/checkpoints"
    raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of intermediate results, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key written as text, modulo ``folds``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % folds
