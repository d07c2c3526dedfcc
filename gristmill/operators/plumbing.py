"""Columns, metadata, row numbers, samples and language tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.staging import stage

META_SCHEMA = "url string, id string"


def parse_meta(meta: Column | str) -> Column:
    """Struct ``(url, id)`` from a literal such as ``{'url': '…', 'id': '…'}``; never evaluated."""
    meta = F.col(meta) if isinstance(meta, str) else meta
    return F.from_json(meta, META_SCHEMA, {"allowSingleQuotes": "true"})


def concat_columns(left: DataFrame, right: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The columns of two tables side by side; an id on one side only is an error.

    The check is part of the join: the row that lacks a side stops the job.
    """
    left = left.withColumn("_left", F.lit(True))
    right = right.withColumn("_right", F.lit(True))
    joined = left.join(right, id_col, "full")
    missing = F.concat(F.lit("id on one side only: "), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    complete = F.when(
        F.col("_left").isNotNull() & F.col("_right").isNotNull(), F.lit(True)
    ).otherwise(F.raise_error(missing).cast("boolean"))
    return joined.filter(complete).drop("_left", "_right")


def add_row_index(df: DataFrame, order_by: list[str], name: str = "row_index") -> DataFrame:
    """Consecutive numbers from 0 in the given order.

    Rows are range-partitioned and numbered within their partition; the partition
    offsets, one number per partition, are the only thing that meets in one place.
    Equal sort keys stay in one partition, so the columns should identify a row.
    """
    ranged = stage(
        df.repartitionByRange(*order_by).withColumn("_part", F.spark_partition_id()), "ranged"
    )
    local = Window.partitionBy("_part").orderBy(*order_by)
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (
        ranged.withColumn("_row", F.row_number().over(local) - 1)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_base") + F.col("_row"))
        .select(*df.columns, name)
    )


def sample_order(seed: int, id_col: str) -> Column:
    """A random but fixed order of ids: the MD5 digest of ``<seed>:<id>``, a missing id being empty."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def sample_rows(
    df: DataFrame, n: int, id_col: str = "doc_id", seed: int = 1234, by: str | None = None
) -> DataFrame:
    """``n`` random rows, or all when there are fewer; the same rows on every run.

    With ``by`` that many of each of its values, null being one. The first ``n`` in the
    order of :func:`sample_order`: every task keeps its best ``n`` rows, of each value,
    before anything is shuffled, and only those meet.
    """
    order = sample_order(seed, id_col)
    if by is None:
        return df.orderBy(order, F.col(id_col)).limit(n)
    best = Window.partitionBy(by).orderBy("_order", id_col)
    ordered = df.withColumn("_order", order).withColumn("_place", F.row_number().over(best))
    return ordered.filter(F.col("_place") <= n).drop("_order", "_place")


def language_tag(path: Column | str) -> Column:
    """First two characters of the last path part without ``indic-`` and ``lm_``."""
    path = F.col(path) if isinstance(path, str) else path
    last = F.element_at(F.split(path, "/"), -1)
    for prefix in ("indic-", "lm_"):
        last = F.replace(last, F.lit(prefix), F.lit(""))
    return F.substring(last, 1, 2)


def catalogue_language(name: Column | str) -> Column:
    """Language in ``lm_<language>_…``, with the two Chinese scripts told apart."""
    name = F.col(name) if isinstance(name, str) else name
    language = F.regexp_extract(name, r"lm_([^_]+)_", 1)
    return (
        F.when(language.isin("zh", "zhs", "zh-cn"), F.lit("zhs"))
        .when(language.isin("zht", "zh-tw"), F.lit("zht"))
        .when(language.startswith("zh"),
              F.raise_error(F.concat(F.lit("unknown Chinese variant: "), language)))
        .otherwise(language)
    )


def dataset_name(path: Column | str, catalogue: str, prefix: str = "") -> Column:
    """``<catalogue>/<name>`` from a path with an optional prefix and ``/data`` suffix."""
    path = F.col(path) if isinstance(path, str) else path
    pattern = rf"^(?:\Q{prefix}\E)?(\Q{catalogue}\E/[^/]+)(?:/data)?\z"
    return F.regexp_extract(path, pattern, 1)
