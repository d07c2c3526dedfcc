"""Joining rows to the aggregate of their own group when groups may be huge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.staging import stage

# At most this many keys can exceed 1/MAX_HOT_KEYS of all rows, whatever the data.
MAX_HOT_KEYS = 10_000
# Groups below this size are never worth splitting.
MIN_HOT_ROWS = 1_000_000


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: list[str],
    weight: str,
    spread_by: list[str],
    total: int | None = None,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Inner join of ``rows`` to ``groups`` (one row per key) that splits hot keys.

    ``weight`` is the number of rows of the key and is dropped. A key above
    ``limit = max(min_hot_rows, total / MAX_HOT_KEYS)`` is hot; weights add up to
    ``total``, so fewer than ``MAX_HOT_KEYS`` keys are, and their list may be
    broadcast. The rows of a hot key go to ``ceil(weight / limit)`` salts by the
    hash of ``spread_by``; its group row is repeated once per salt, which adds at
    most ``2 * MAX_HOT_KEYS`` rows. No task gets more than about ``limit`` rows of
    one key.
    """
    if total is not None and total <= min_hot_rows:
        return rows.join(groups.drop(weight), keys)
    groups = stage(groups, "groups")
    total, largest = groups.agg(
        F.coalesce(F.sum(weight), F.lit(0)), F.coalesce(F.max(weight), F.lit(0))
    ).first()
    limit = max(min_hot_rows, -(-total // MAX_HOT_KEYS))
    if largest <= limit:
        return rows.join(groups.drop(weight), keys)
    parts = F.ceil(F.col(weight) / F.lit(limit)).cast("int")
    hot = F.broadcast(
        groups.filter(F.col(weight) > limit).select(*keys, parts.alias("_parts"))
    )
    salt = F.pmod(F.xxhash64(*spread_by), F.coalesce("_parts", F.lit(1))).cast("int")
    salted_rows = rows.join(hot, keys, "left").withColumn("_salt", salt).drop("_parts")
    salts = F.when(F.col(weight) > limit, F.sequence(F.lit(0), parts - 1)).otherwise(
        F.array(F.lit(0))
    )
    salted_groups = groups.withColumn("_salt", F.explode(salts)).drop(weight)
    return salted_rows.join(salted_groups, [*keys, "_salt"]).drop("_salt")
