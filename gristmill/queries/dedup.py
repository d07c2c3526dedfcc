"""Template lines, exact de-duplication, segments and step reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text as tx
from gristmill.functions import urls
from gristmill.operators import exact, reports
from gristmill.plans.corpus import apply_steps
from gristmill.queries.common import letters_sql, strip_sql, table

_LINES = (
    "lines AS (SELECT doc_id, generate_subscripts(parts, 1) - 1 AS pos, "
    f"{strip_sql('unnest(parts)')} AS line FROM "
    "(SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))"
)


def template_sql(size: int, occurrence: int) -> str:
    return (
        f"{_LINES}, template AS (SELECT line FROM lines WHERE length(line) >= {size} "
        f"GROUP BY line HAVING count(*) >= {occurrence}), "
        "kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM lines "
        "WHERE line NOT IN (SELECT line FROM template) GROUP BY doc_id), "
        "cleaned AS (SELECT doc_id, coalesce(kept.text, '') AS text, lang "
        "FROM documents LEFT JOIN kept USING (doc_id))"
    )


def _lines(spark, folder) -> DataFrame:
    lines = exact.split_lines(table(spark, folder, "documents"))
    return lines.withColumn("pos", F.col("pos").cast("bigint"))


def _soft(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return exact.remove_template_lines(docs, **exact.SOFT_TEMPLATE)


def _newspapers(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return exact.remove_template_lines(docs, **exact.NEWSPAPER_TEMPLATE)


def _template_lines(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return exact.template_lines(docs, **exact.SOFT_TEMPLATE)


def _first_sql(key: str, source: str = "documents", row: str = "doc_id") -> str:
    return f"row_number() OVER (PARTITION BY md5({strip_sql(key)}) ORDER BY {row}) = 1"


def _blank(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return exact.dedup_document(docs).select("doc_id", "text", "lang")


def _drop(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return exact.dedup_document(docs, mode="drop").select("doc_id", "text", "lang")


def _raw(algorithm: str):
    def query(spark, folder) -> DataFrame:
        docs = table(spark, folder, "documents")
        return exact.dedup_document(docs, F.col("text"), "drop", algorithm=algorithm).select(
            "doc_id", "source")

    return query


def _pages(spark, folder) -> DataFrame:
    # Every page and three further addresses of it.
    pages = table(spark, folder, "pages").select(
        "page_id", "url", F.col("html").alias("text"))
    path = F.regexp_extract("url", "^([^?#]*)", 1)
    variants = F.array(
        F.col("url"),
        F.concat(path, F.lit("?news-id="), F.col("page_id").cast("string"), F.lit("&x=1")),
        F.concat(path, F.lit("?id="), F.col("page_id").cast("string"), F.lit("&y=a%20b")),
        F.concat(path, F.lit("/amp?z=2")),
    )
    return pages.select(
        "page_id", "text", F.posexplode(variants).alias("n", "url")
    ).select((F.col("page_id") * 4 + F.col("n")).alias("doc_id"), "url", "text")


_PAGES_SQL = (
    "base AS (SELECT page_id, url, html AS text, "
    "regexp_extract(url, '^([^?#]*)', 1) AS path FROM pages), "
    "variants AS (SELECT page_id * 4 AS doc_id, url, text FROM base UNION ALL "
    "SELECT page_id * 4 + 1, path || '?news-id=' || page_id || '&x=1', text FROM base UNION ALL "
    "SELECT page_id * 4 + 2, path || '?id=' || page_id || '&y=a%20b', text FROM base UNION ALL "
    "SELECT page_id * 4 + 3, path || '/amp?z=2', text FROM base)"
)
_AMP_SQL = "split_part(split_part(url, '?', 1), '/amp', 1)"
_WITHOUT_QUERY_SQL = "regexp_extract(url, '^(.[^?]*)', 1)"
# Values of the derived addresses need no decoding; other parameters are dropped.
_KEPT = (
    r"array_to_string(list_transform(list_filter(string_split(split_part(split_part(url, '#', 1), "
    r"'?', 2), '&'), lambda p: regexp_matches(p, '^(news-)?id=.')), "
    r"lambda p: regexp_replace(p, '^(news-)?id=', 'id=')), '&')"
)
_PARAMETERS_SQL = (
    "split_part(split_part(url, '#', 1), '?', 1) || "
    f"CASE WHEN {_KEPT} <> '' THEN '?' || {_KEPT} ELSE '' END || "
    "regexp_extract(url, '(#.+)$', 1)"
)


def _url_keys(function):
    def query(spark, folder) -> DataFrame:
        return _pages(spark, folder).select("doc_id", function(F.col("url")).alias("key"))

    return query


def _on_url(step: str):
    def query(spark, folder) -> DataFrame:
        return exact.apply_step(_pages(spark, folder), step, url_col="url")

    return query


def _on_url_sql(key: str) -> str:
    return (
        f"WITH {_PAGES_SQL} SELECT doc_id, url, CASE WHEN {_first_sql(key)} THEN text ELSE '' END "
        "AS text FROM variants"
    )


def _steps(spark, folder) -> DataFrame:
    return apply_steps(table(spark, folder, "documents").select("doc_id", "text", "lang"))


def _segments(spark, folder) -> DataFrame:
    turns = table(spark, folder, "conversations")
    named = turns.select(
        F.concat_ws("_id_", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
        .alias("id"), "text")
    return exact.concat_segments(named)


def _segments_then_copies(spark, folder) -> DataFrame:
    turns = table(spark, folder, "conversations")
    named = turns.select(
        F.concat_ws("_id_", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
        .alias("doc_id"), "text")
    return apply_steps(named, ["concat_segments", "dedup_document"])


def _size(spark, folder) -> DataFrame:
    return reports.size_bytes(table(spark, folder, "documents"))


def _estimate(spark, folder) -> DataFrame:
    return reports.estimate_size(table(spark, folder, "documents"))


def _report(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return reports.step_report(docs, exact.dedup_document(docs, mode="drop"))


def _modified(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return reports.modified_documents(docs, exact.dedup_document(docs))


_LETTERS = letters_sql("text")
_BYTES = "sum(strlen(text))::BIGINT"

QUERIES = {
    "d01_split_lines": (_lines, f"WITH {_LINES} SELECT doc_id, pos::BIGINT AS pos, line FROM lines"),
    "d03_template_lines": (
        _template_lines,
        f"WITH {_LINES} SELECT md5(line) AS hash, count(*) AS n FROM lines "
        "WHERE length(line) >= 15 GROUP BY line HAVING count(*) >= 10"),
    "d04_remove_template_lines_soft": (
        _soft, f"WITH {template_sql(15, 10)} SELECT doc_id, text, lang FROM cleaned"),
    "d05_remove_template_lines_newspapers": (
        _newspapers, f"WITH {template_sql(0, 2)} SELECT doc_id, text, lang FROM cleaned"),
    "d07_dedup_document_blank": (
        _blank,
        f"SELECT doc_id, CASE WHEN {_first_sql(_LETTERS)} THEN text ELSE '' END AS text, lang "
        "FROM documents"),
    "d08_dedup_document_drop": (
        _drop,
        f"SELECT doc_id, text, lang FROM documents QUALIFY {_first_sql(_LETTERS)}"),
    "d09_url_without_query": (
        _url_keys(urls.without_query),
        f"WITH {_PAGES_SQL} SELECT doc_id, {_WITHOUT_QUERY_SQL} AS key FROM variants"),
    "d09_dedup_on_url": (_on_url("dedup_document_on_url"), _on_url_sql(_WITHOUT_QUERY_SQL)),
    "d10_url_without_amp": (
        _url_keys(urls.without_amp),
        f"WITH {_PAGES_SQL} SELECT doc_id, {_AMP_SQL} AS key FROM variants"),
    "d10_dedup_on_url_without_amp": (
        _on_url("dedup_document_on_url_without_amp"), _on_url_sql(_AMP_SQL)),
    "d11_url_parameters": (
        _url_keys(lambda url: urls.with_query_parameters(url, urls.QUERY_PARAMETERS)),
        f"WITH {_PAGES_SQL} SELECT doc_id, {_PARAMETERS_SQL} AS key FROM variants"),
    "d11_dedup_on_url_parameters": (
        _on_url("dedup_document_on_url_parameters"), _on_url_sql(_PARAMETERS_SQL)),
    "d12_dedup_on_full_url": (_on_url("dedup_document_on_full_url"), _on_url_sql("url")),
    "d13_dedup_raw_text": (
        _raw("md5"), f"SELECT doc_id, source FROM documents QUALIFY {_first_sql('text')}"),
    "d13_dedup_raw_text_sha1": (
        _raw("sha1"), f"SELECT doc_id, source FROM documents QUALIFY {_first_sql('text')}"),
    "d14_default_steps": (
        _steps,
        f"WITH {template_sql(15, 10)} SELECT doc_id, CASE WHEN {_first_sql(_LETTERS)} THEN text "
        "ELSE '' END AS text, lang FROM cleaned"),
    "d15_concat_segments": (
        _segments,
        "SELECT conv_id::VARCHAR AS id, string_agg(text, chr(10) ORDER BY turn, text) AS text "
        "FROM conversations GROUP BY conv_id"),
    "d14_concat_then_dedup": (
        _segments_then_copies,
        "WITH whole AS (SELECT conv_id::VARCHAR AS doc_id, string_agg(text, chr(10) ORDER BY turn, text) "
        "AS text FROM conversations GROUP BY conv_id) "
        f"SELECT doc_id, CASE WHEN {_first_sql(_LETTERS)} THEN text ELSE '' END AS text FROM whole"),
    "r01_size_bytes": (
        _size, f"SELECT count(*) AS rows, {_BYTES} AS bytes FROM documents"),
    "r01_estimate_size": (
        _estimate,
        # Up to 10,000 rows the sample is the whole table.
        "SELECT sum(strlen(text))::DOUBLE AS bytes FROM documents"),
    "r02_step_report": (
        _report,
        f"WITH after AS (SELECT text FROM documents QUALIFY {_first_sql(_LETTERS)}), "
        f"a AS (SELECT count(*) AS n, {_BYTES} AS b FROM documents), "
        f"z AS (SELECT count(*) AS n, {_BYTES} AS b FROM after) "
        "SELECT a.n AS rows_before, z.n AS rows_after, a.b AS bytes_before, z.b AS bytes_after, "
        "a.n - z.n AS rows_removed, a.b - z.b AS bytes_removed, "
        "round((a.n - z.n) * 100.0::DOUBLE / a.n, 2) AS rows_removed_percent, "
        "round((a.b - z.b) * 100.0::DOUBLE / a.b, 2) AS bytes_removed_percent FROM a, z"),
    "r03_modified_documents": (
        _modified,
        f"SELECT doc_id, '' AS text, text AS old_text FROM documents "
        f"QUALIFY NOT {_first_sql(_LETTERS)} AND text <> ''"),
}
