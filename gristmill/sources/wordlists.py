"""Keyword and stopword files."""

from __future__ import annotations

import codecs
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.batches import joined, parts
from gristmill.functions.text import STRIP_CHARS, strip

# Charsets whose line ends are the bytes of ASCII, which are part of no other character.
_BY_LINE = frozenset(
    {"utf-8", "ascii", "gb2312", "gbk", "gb18030", "big5", "big5hkscs", "cp950", "euc_jp", "euc_kr", "cp949", "shift_jis", "cp932"}
    | {f"iso8859-{k}" for k in (*range(1, 12), *range(13, 17))} | {f"cp{k}" for k in (*range(1250, 1259), 874)} | {"koi8-r", "koi8-u"})


def _whole_files(files: DataFrame, charset: str) -> DataFrame:
    # Line ends may be more than one byte, so a file is decoded whole.
    @F.pandas_udf("array<string>")
    def decoded(files: pd.Series) -> pd.Series:
        return files.map(lambda data: re.split("\r\n|[\r\n]", bytes(data).decode(charset)))

    return files.select(F.explode(decoded("content")).alias("line"))


def _split_files(lines: DataFrame, charset: str) -> DataFrame:
    # Lines are read from any part of a file and decoded one by one, then parted at the other line ends.
    @F.arrow_udf("string")
    def decoded(lines: pa.Array) -> pa.Array:
        return joined(
            [pa.array([bytes(x).decode(charset) for x in part.to_pylist()], pa.string()) for part in parts(lines)], pa.string())

    line = F.validate_utf8("value") if charset == "utf-8" else decoded(F.col("value").cast("binary"))
    return lines.select(F.explode(F.split(line, "\r", -1)).alias("line"))


def _lines(spark: SparkSession, folder: str, charset: str) -> DataFrame:
    charset = codecs.lookup(charset).name
    binary = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    if charset not in _BY_LINE:
        return _whole_files(binary, charset)
    # The reader of lines takes a byte-order mark away. Such a file is larger than its lines
    # with their ends; it is decoded whole, and the mark stays.
    lines = spark.read.option("pathGlobFilter", "*.txt").option("lineSep", "\n").text(folder)
    sizes = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.octet_length("value").alias("n"))
    marked = sizes.groupBy("path").agg(F.max("size").alias("size"), F.sum(F.col("n") + 1).alias("n")).filter("size > n")
    found = [r["path"] for r in marked.select("path").collect()]
    if not found:
        return _split_files(lines, charset)
    kept = lines.filter(~F.col("_metadata.file_path").isin(found))
    whole = binary.filter(F.col("_metadata.file_path").isin(found))
    return _split_files(kept, charset).unionByName(_whole_files(whole, charset))


def load_keywords(spark: SparkSession, folder: str, charset: str = "UTF-8") -> DataFrame:
    """Distinct ``keyword`` of all ``*.txt`` files, one per line.

    White space at both ends and then commas at the end are removed; a comma hides
    the blanks before it from the first strip, and they stay. Any charset that Python
    knows is read. Files of the charsets in use, UTF-8 among them, are split among tasks
    line by line; a file of another one (UTF-16, UTF-32, UTF-7, ISO-2022), or with a
    byte-order mark, is held by one task, which list files are small enough for.
    """
    keyword = F.rtrim(strip("line"), F.lit(","))
    lines = _lines(spark, folder, charset)
    return lines.select(keyword.alias("keyword")).filter("keyword <> ''").distinct()


def load_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """``word`` per line, without trailing white space."""
    return spark.read.text(path).select(
        F.rtrim(F.col("value"), F.lit(STRIP_CHARS)).alias("word")
    )
