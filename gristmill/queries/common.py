"""Table access and SQL fragments shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gristmill.functions import text as tx
from gristmill.staging import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A whole table of the folder, read in as many partitions as there are cores."""
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))


def quote(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def chars(points) -> str:
    """SQL expression for a string of code points."""
    return "||".join(f"chr({p})" for p in points)


def strip_sql(x: str) -> str:
    return f"trim({x}, {chars(tx.STRIP_POINTS)})"


def unify_punctuation_sql(x: str) -> str:
    single = {k: v for k, v in tx.PUNCTUATION_MAP.items() if len(v) == 1}
    for key, value in tx.PUNCTUATION_MAP.items():
        if len(value) > 1:
            x = f"replace({x}, {quote(key)}, {quote(value)})"
    return f"translate({x}, {quote(''.join(single))}, {quote(''.join(single.values()))})"


def unify_whitespace_sql(x: str) -> str:
    return f"translate({x}, {chars(tx.SPACE_POINTS)}, repeat(' ', {len(tx.SPACE_POINTS)}))"


def collapse_sql(x: str) -> str:
    split = f"regexp_extract_all({x}, '(?s).')"
    return (
        f"array_to_string(list_transform(list_filter(list_zip({split}, "
        f"list_prepend('', {split})), "
        r"lambda p: NOT (p[1] IS NOT NULL AND p[2] IS NOT NULL AND p[1] = p[2] "
        r"AND regexp_matches(p[1], '\p{P}'))), lambda p: p[1]), '')"
    )


def lm_normalize_sql(x: str) -> str:
    digits = rf"regexp_replace({strip_sql(x)}, '\p{{Nd}}', '0', 'g')"
    return rf"regexp_replace({unify_punctuation_sql(digits)}, '[\x00-\x1f\x7f-\x{{9f}}]', '', 'g')"


def letters_sql(x: str) -> str:
    blank = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
    return rf"regexp_replace({x}, '[{blank}\p{{Nd}}!-/:-@\[-`{{-~]', '', 'g')"
