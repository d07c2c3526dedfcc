"""JSON lines as a stream; every row-wise operator takes the resulting DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_jsonl_stream(
    spark: SparkSession, folder: str, schema: str | T.StructType, files_per_batch: int = 1000
) -> DataFrame:
    """New files of a folder, one object per line."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def write_jsonl_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows that are there now, exactly once, and end."""
    return (
        df.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("ignoreNullFields", False)
        .trigger(availableNow=True)
        .start()
    )
