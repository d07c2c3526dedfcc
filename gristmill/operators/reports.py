"""Size reports and lists of changed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.operators.plumbing import concat_columns, sample_rows

# ---- fixed values --------------------------------------------------------
SAMPLE_ROWS = 10_000
SAMPLE_SEED = 1991
# ---- end of fixed values -------------------------------------------------


def size_bytes(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row ``(rows, bytes)`` of UTF-8 text."""
    length = F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))
    return df.agg(F.count("*").alias("rows"), length.alias("bytes"))


def estimate_size(
    df: DataFrame, text_col: str = "text", id_col: str = "doc_id", n: int = SAMPLE_ROWS,
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """One row ``(bytes)``: bytes of ``n`` random rows, scaled to all rows."""
    lengths = df.select(id_col, F.octet_length(text_col).alias("_bytes"))
    zero = F.lit(0).cast("bigint")
    sample = sample_rows(lengths, n, id_col, seed).agg(
        F.sum("_bytes").alias("size"), F.count("*").alias("taken"), zero.alias("rows")
    )
    whole = df.agg(zero.alias("size"), zero.alias("taken"), F.count("*").alias("rows"))
    sums = sample.unionByName(whole).agg(*[F.sum(c).alias(c) for c in sample.columns])
    scaled = F.try_divide(F.col("size") * F.col("rows"), F.col("taken"))
    return sums.select(F.coalesce(scaled, F.lit(0.0)).alias("bytes"))


def step_report(before: DataFrame, after: DataFrame, text_col: str = "text") -> DataFrame:
    """One row of row and byte counts before and after a step, with the share removed."""
    marked = before.select(F.lit(0).alias("_after"), text_col).unionAll(
        after.select(F.lit(1).alias("_after"), text_col))
    size = F.octet_length(text_col)

    def total(value, side: int, name: str):
        chosen = F.when(F.col("_after") == side, value)
        return F.coalesce(F.sum(chosen), F.lit(0)).alias(name)

    counts = marked.agg(
        total(F.lit(1), 0, "rows_before"), total(F.lit(1), 1, "rows_after"),
        total(size, 0, "bytes_before"), total(size, 1, "bytes_after"),
    )
    removed = counts.withColumn(
        "rows_removed", F.col("rows_before") - F.col("rows_after")
    ).withColumn("bytes_removed", F.col("bytes_before") - F.col("bytes_after"))
    for unit in ("rows", "bytes"):
        share = F.try_divide(F.col(f"{unit}_removed") * 100.0, F.col(f"{unit}_before"))
        removed = removed.withColumn(f"{unit}_removed_percent", F.round(share, 2))
    return removed


def modified_documents(
    before: DataFrame, after: DataFrame, n: int | None = None, id_col: str = "doc_id",
    text_col: str = "text", seed: int = 1234,
) -> DataFrame:
    """Rows of ``after`` whose text differs, with ``old_text``; all or ``n`` random ones.

    Both tables must have the same ids; the join itself stops at one that is missing.
    """
    old = before.select(id_col, F.col(text_col).alias("old_text"))
    changed = concat_columns(after, old, id_col).filter(~F.col("old_text").eqNullSafe(F.col(text_col)))
    return changed if n is None else sample_rows(changed, n, id_col, seed)
