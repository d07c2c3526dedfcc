"""JSON lines and columnar tables, in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.operators.reports import modified_documents
from gristmill.sources.observed import Written, write_whole


def read_jsonl(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType | None = None,
    on_error: str = "fail",
    text_col: str | None = None,
) -> DataFrame:
    """Read one object per line from files, folders or globs.

    ``on_error="fail"`` stops at a bad line, ``"drop"`` skips it. With ``text_col`` a
    missing text becomes empty. Give a schema; without one the files are read twice.
    """
    modes = {"fail": "FAILFAST", "drop": "DROPMALFORMED"}
    if on_error not in modes:
        raise ValueError(f"unknown on_error: {on_error}")
    reader = spark.read.option("mode", modes[on_error])
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    if text_col is None:
        return df
    return df.withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))


def write_jsonl(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write one object per line; null fields are kept and characters are not escaped."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read a columnar table."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def write_table(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write a columnar table."""
    df.write.mode(mode).parquet(path)


def write_guarded(
    df: DataFrame, path: str, kind: str = "json", from_scratch: bool = False, text_col: str = "text"
) -> Written:
    """Write unless the path exists or there are no rows; tells whether it wrote, and how much.

    The input is read once. The result appears under its path when it is whole, so a
    failed job leaves no part of it. ``from_scratch`` replaces an existing result, which
    the input may read.
    """
    options = {"ignoreNullFields": False} if kind == "json" else {}
    return write_whole(df, path, kind, from_scratch, text_col, **options)


def write_step_checks(
    before: DataFrame,
    after: DataFrame,
    folder: str,
    index: int,
    step: str,
    n: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    from_scratch: bool = False,
) -> Written:
    """Save the rows that a step changed as ``<folder>/<index>_<step>_checks``."""
    changed = modified_documents(before, after, n, id_col, text_col)
    return write_guarded(changed, f"{folder}/{index}_{step}_checks", "parquet", from_scratch, text_col)


def write_clusters(clusters: DataFrame, path: str, mode: str = "error") -> None:
    """Save the mapping from document to cluster."""
    write_table(clusters, path, mode)
