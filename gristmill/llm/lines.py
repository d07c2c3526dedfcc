"""Line dedup: suffix array over line-id sequences by distributed prefix doubling.

Every line has an identifier; a document is the sequence of its lines. Suffixes with the
same first ``h`` lines are one bucket, an interval of the suffix array in which common
prefixes have ``h`` lines or more. A round pairs the bucket of a line with the bucket of
the line ``h`` further on and so doubles the depth; suffixes that are alone in their
bucket are finished and leave. At the depth asked for, all but the first suffix of an
interval begin a run of lines that has come before. Runs that overlap or touch, also of
different origin, are deleted as one. Depths beyond the one asked for are not computed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.blocks import join_ids
from gristmill.operators.skew import join_groups
from gristmill.staging import stage


def _shared(rows: DataFrame, label: str) -> DataFrame:
    """Suffixes whose bucket holds another one, with the first of the bucket."""
    first = F.min(F.struct("_id", "_key", "_pos")).alias("_first")
    buckets = rows.groupBy("_bucket").agg(first, F.count("*").alias("_weight")).filter("_weight > 1")
    return stage(join_groups(rows, buckets, ["_bucket"], "_weight", ["_key", "_pos"]), label)


def _identity(*values: Column) -> Column:
    # Two hashes of 64 bits; the second one starts from another seed.
    return F.struct(F.xxhash64(*values).alias("a"), F.xxhash64(F.lit(1), *values).alias("b"))


class _Delete:
    """mapInArrow over (id, text, lines of runs): text without them, and the runs."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first_line", pa.int64()), ("n_lines", pa.int64())]))
        for batch in batches:
            texts, counts, runs = [], [], []
            for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                lines = text.split("\n") if text else []
                counts.append(len(lines))
                if not gone:
                    texts.append(text)
                    runs.append([])
                    continue
                # Positions count the lines that are not blank.
                solid = np.array([k for k, line in enumerate(lines) if line.strip(" \t\r")])
                gone = np.sort(np.array(gone))
                cut = np.flatnonzero(np.diff(gone) > 1) + 1
                dropped = set(solid[gone].tolist())
                runs.append([{"first_line": int(solid[r[0]]), "n_lines": len(r)} for r in np.split(gone, cut)])
                texts.append("\n".join(line for k, line in enumerate(lines) if k not in dropped))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(runs, kind)],
                ["doc_id", "text", "n_lines", "runs"])


def _solid_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: F.length(F.regexp_replace(x, r"[ \t\r]+", "")) > 0)


def delete_repeated_lines(
    docs: DataFrame, min_lines: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, text, n_lines, runs``: texts without runs of lines that have come before.

    A run is ``min_lines`` or more lines in a row that also stand, in that order, earlier:
    in a document with a smaller id (a missing id is the largest) or further up in the
    same one. Lines are compared by 128 bits of hashes. Blank lines are kept and passed over, so a run
    may go across them. ``runs`` lists the deleted ones (``first_line`` from 0, and how
    many lines). Null and empty texts stay as they are. Rows with the same id and text
    are one document and get the same result. An empty table gives an empty result; other
    columns are not read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text")).withColumn(
        "_id", F.coalesce("doc_id", F.lit((1 << 63) - 1))).withColumn(
        "_key", F.unhex(F.md5(F.concat(F.col("_id").cast("string"), F.lit(" "), F.coalesce("_text", F.lit(""))).cast("binary"))))
    lines = base.select("_key", "_id", F.posexplode(F.transform(_solid_lines(F.col("_text")), lambda line: _identity(line))).alias("_pos", "_bucket"))
    rows, depth = _shared(lines.dropDuplicates(["_key", "_pos"]), "depth-1").drop("_first"), 1
    while depth < min_lines:
        step = min(depth, min_lines - depth)
        later = rows.select("_key", (F.col("_pos") - step).alias("_pos"), F.col("_bucket").alias("_later"))
        paired = rows.join(later, ["_key", "_pos"]).withColumn("_bucket", _identity(F.col("_bucket"), F.col("_later"))).drop("_later")
        depth += step
        rows = _shared(paired, f"depth-{depth}")
        if depth < min_lines:
            rows = rows.drop("_first")
    if min_lines == 1:
        rows = _shared(lines.dropDuplicates(["_key", "_pos"]), "depth-1")
    again = rows.filter(F.struct("_id", "_key", "_pos") != F.col("_first"))
    covered = again.select("_key", F.explode(F.sequence(F.col("_pos"), F.col("_pos") + min_lines - 1)).alias("_pos"))
    gone = stage(covered.groupBy("_key").agg(F.collect_set("_pos").alias("_gone")), "gone")
    joined = join_ids(base, gone, "_key", "left", F.size("_gone") * 8 + 64)
    return joined.select("doc_id", "_text", "_gone").mapInArrow(
        _Delete(), "doc_id long, text string, n_lines long, runs array<struct<first_line:long,n_lines:long>>")


def lines_sql(docs: str = "documents") -> str:
    """DuckDB SQL of the same with runs of two lines."""
    return rf"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) line,
  generate_subscripts(string_split(text, chr(10)), 1) no FROM {docs} WHERE text <> ''),
solid AS (SELECT doc_id, no, line, lead(line) OVER w following, lead(no) OVER w next_no FROM lines
  WHERE trim(line, ' ' || chr(9) || chr(13)) <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY no)),
pairs AS (SELECT *, row_number() OVER (PARTITION BY line, following ORDER BY doc_id, no) k FROM solid WHERE following IS NOT NULL),
gone AS (SELECT doc_id, no FROM pairs WHERE k > 1 UNION SELECT doc_id, next_no FROM pairs WHERE k > 1),
left_over AS (SELECT l.doc_id, count(*) n_lines, count(g.no) n_removed, string_agg(line, chr(10) ORDER BY l.no) FILTER (g.no IS NULL) kept
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.no = g.no GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) n_lines, coalesce(n_removed, 0) n_removed,
  sha256(CASE WHEN n_lines IS NULL THEN coalesce(d.text, '') ELSE coalesce(kept, '') END) kept_sha256
FROM {docs} d LEFT JOIN left_over USING (doc_id)"""
