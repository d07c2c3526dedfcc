"""Template-line removal, exact de-duplication and segment concatenation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text as tx
from gristmill.functions import urls
from gristmill.operators.skew import MIN_HOT_ROWS, join_groups
from gristmill.staging import stage

# ---- fixed values --------------------------------------------------------
SOFT_TEMPLATE = {"min_size": 15, "min_occurrence": 10}
NEWSPAPER_TEMPLATE = {"min_size": 0, "min_occurrence": 2}
DEFAULT_STEPS = ["dedup_template_soft", "dedup_document"]
# ---- end of fixed values -------------------------------------------------


def line_array(text: Column | str) -> Column:
    """The stripped lines of a text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), tx.strip)


def split_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, pos, line)``: one row per line, positions from 0."""
    return df.select(id_col, F.posexplode(line_array(text_col)).alias("pos", "line"))


def template_lines(
    df: DataFrame, min_size: int, min_occurrence: int, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(hash, n)`` of the lines that occur at least ``min_occurrence`` times."""
    lines = split_lines(df, id_col, text_col).filter(F.length("line") >= min_size)
    return (
        lines.groupBy(F.md5("line").alias("hash"))
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_occurrence)
    )


def remove_template_lines(
    df: DataFrame,
    min_size: int = SOFT_TEMPLATE["min_size"],
    min_occurrence: int = SOFT_TEMPLATE["min_occurrence"],
    id_col: str = "doc_id",
    text_col: str = "text",
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Remove frequent lines everywhere and strip the others; no row is dropped.

    Line texts are never shuffled: their hashes are counted with partial aggregates,
    and only ``(id, position)`` of the lines to remove goes back to the documents.
    """
    templates = template_lines(df, min_size, min_occurrence, id_col, text_col)
    positions = (
        split_lines(df, id_col, text_col)
        .filter(F.length("line") >= min_size)
        .select(id_col, "pos", F.md5("line").alias("hash"))
    )
    hits = join_groups(
        positions, templates, ["hash"], "n", [id_col, "pos"], min_hot_rows=min_hot_rows
    )
    removed = stage(
        hits.groupBy(id_col).agg(F.collect_list("pos").alias("_removed")), "template-lines"
    )
    lines = F.col("_lines")
    kept = F.array_except(
        F.sequence(F.lit(0), F.size(lines) - 1),
        F.coalesce("_removed", F.array().cast("array<int>")),
    )
    text = F.array_join(F.transform(kept, lambda p: F.element_at(lines, p + 1)), "\n")
    return (
        df.join(removed, id_col, "left")
        .withColumn("_lines", line_array(text_col))
        .withColumn(text_col, text)
        .select(df.columns)
    )


def copies(df: DataFrame, key: Column, id_col: str = "doc_id", algorithm: str = "md5") -> DataFrame:
    """Ids of the rows whose key already occurs at a smaller id, as a written table.

    The smallest id per hash is a partial aggregate, so one key may hold most rows.
    """
    first = (
        df.select(F.col(id_col), tx.text_hash(key, algorithm).alias("hash"))
        .groupBy("hash")
        .agg(F.min(id_col).alias(id_col))
        .select(id_col)
    )
    return stage(df.select(id_col).join(first, id_col, "left_anti"), "copies")


def dedup_document(
    df: DataFrame,
    key: Column | None = None,
    mode: str = "blank",
    id_col: str = "doc_id",
    text_col: str = "text",
    algorithm: str = "md5",
) -> DataFrame:
    """Keep the first row per key; later rows get an empty text or are dropped.

    The default key is the text without white space, digits and ASCII punctuation.
    """
    if mode not in ("blank", "drop"):
        raise ValueError(f"unknown mode: {mode}")
    repeated = copies(df, tx.letters_only(text_col) if key is None else key, id_col, algorithm)
    if mode == "drop":
        return df.join(repeated, id_col, "left_anti")
    marked = df.join(repeated.withColumn("_copy", F.lit(True)), id_col, "left")
    text = F.when(F.col("_copy"), F.lit("")).otherwise(F.col(text_col))
    return marked.withColumn(text_col, text).select(df.columns)


def concat_segments(
    df: DataFrame, id_col: str = "id", text_col: str = "text", separator: str = "_id_"
) -> DataFrame:
    """Join the segments ``<doc>_id_<n>`` of each document by number.

    The id and text columns keep their names, so other steps can follow. A result row holds one whole document, so its segments do meet in one task.
    """
    parts = F.split(F.col(id_col), separator, 2)
    segment = F.struct(
        parts[1].cast("bigint").alias("n"), parts[1].alias("label"), F.col(text_col).alias("text")
    )
    grouped = df.select(parts[0].alias(id_col), segment.alias("segment")).groupBy(id_col).agg(
        F.array_sort(F.collect_list("segment")).alias("segments")
    )
    return grouped.select(
        id_col, F.array_join(F.transform("segments", lambda s: s["text"]), "\n").alias(text_col)
    )


Step = Callable[..., DataFrame]


def _on_url(function: Callable[[Column], Column]) -> Step:
    def step(df: DataFrame, id_col: str, text_col: str, url_col: str) -> DataFrame:
        return dedup_document(df, function(F.col(url_col)), "blank", id_col, text_col)

    return step


# name -> (step, whether row counts stay and changed rows can be listed)
STEPS: dict[str, tuple[Step, bool]] = {
    "dedup_template_soft": (
        lambda df, id_col, text_col, url_col: remove_template_lines(
            df, **SOFT_TEMPLATE, id_col=id_col, text_col=text_col), True),
    "dedup_pseudocrawl_newspapers": (
        lambda df, id_col, text_col, url_col: remove_template_lines(
            df, **NEWSPAPER_TEMPLATE, id_col=id_col, text_col=text_col), True),
    "dedup_document": (
        lambda df, id_col, text_col, url_col: dedup_document(
            df, id_col=id_col, text_col=text_col), True),
    "dedup_document_on_url": (_on_url(urls.without_query), True),
    "dedup_document_on_url_without_amp": (_on_url(urls.without_amp), True),
    "dedup_document_on_url_parameters": (
        _on_url(lambda url: urls.with_query_parameters(url, urls.QUERY_PARAMETERS)), True),
    "dedup_document_on_full_url": (_on_url(lambda url: url), True),
    "concat_segments": (
        lambda df, id_col, text_col, url_col: concat_segments(df, id_col, text_col), False),
}


def apply_step(
    df: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text",
    url_col: str = "meta.url",
) -> DataFrame:
    """Run a named step; an unknown name is an error."""
    if name not in STEPS:
        raise NotImplementedError(f"unknown step {name}; known: {sorted(STEPS)}")
    return STEPS[name][0](df, id_col, text_col, url_col)
