"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.operators.skew import MIN_HOT_ROWS, join_groups
from gristmill.staging import new_path


def _stars(links: DataFrame, total: int, min_hot_rows: int) -> tuple[DataFrame, DataFrame]:
    minima = links.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("n"))
    minima = minima.withColumn("m", F.least("u", "low")).drop("low")
    return minima, join_groups(links, minima, ["u"], "n", ["v"], total, min_hot_rows)


def _large_star(edges: DataFrame, total: int, min_hot_rows: int) -> DataFrame:
    # Every larger neighbour of a node moves to the smallest node of its neighbourhood.
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    _, joined = _stars(both, 2 * total, min_hot_rows)
    return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, total: int, min_hot_rows: int) -> DataFrame:
    # A node and its smaller neighbours move to the smallest of them.
    minima, joined = _stars(edges, total, min_hot_rows)
    moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(minima.select("u", F.col("m").alias("v"))).distinct()


def connected_components(
    edges: DataFrame, left: str, right: str, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its smallest node.

    Each round is written to one of two alternating shared folders, so neither the
    lineage nor the disk use grows with the number of rounds. The loop ends when a
    round changes no edge; every node then points at its root directly.
    """
    spark = edges.sparkSession
    root = new_path(spark, "components")
    schema = "u bigint, v bigint"

    def write(df: DataFrame, turn: int) -> tuple[DataFrame, tuple]:
        path = f"{root}/turn{turn % 2}"
        df.write.mode("overwrite").parquet(path)
        table = spark.read.schema(schema).parquet(path)
        print_ = table.agg(
            F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
        ).first()
        return table, tuple(print_)

    start = edges.select(
        F.greatest(left, right).cast("bigint").alias("u"),
        F.least(left, right).cast("bigint").alias("v"),
    ).filter("u <> v").distinct()
    turn = 0
    table, seen = write(start, turn)
    while seen[0]:
        turn += 1
        large = _large_star(table, seen[0], min_hot_rows)
        table, now = write(_small_star(large, seen[0], min_hot_rows), turn)
        if now == seen:
            break
        seen = now
    members = table.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = table.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
