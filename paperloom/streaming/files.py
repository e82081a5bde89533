"""New files as a stream: each batch is extracted and appended as it comes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, folder: str, pattern: str = "*.pdf", files_a_batch: int = 1000) -> DataFrame:
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    return reader.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_a_batch).load(folder)


def extract_stream(source: DataFrame, extract: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Runs ``extract`` on what has arrived, then stops. Every batch goes to a folder of its own
    number, so a batch that is repeated after a failure replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        extract(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
