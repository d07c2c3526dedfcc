"""Readers, writers and row plumbing, on files that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text as tx
from gristmill.operators import plumbing
from gristmill.operators.exact import remove_template_lines
from gristmill.operators.fuzzy import fuzzy_clusters
from gristmill.queries.common import strip_sql, table, unify_whitespace_sql
from gristmill.queries.dedup import template_sql
from gristmill.queries.fuzzy import clusters_sql
from gristmill.sources import jsonl, wordlists
from gristmill.staging import new_path
from gristmill.streaming.jsonl import read_jsonl_stream, write_jsonl_stream

_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
_COLUMNS = "SELECT doc_id, text, lang, source, n_chars FROM documents"


def _strict(spark, folder) -> DataFrame:
    path = new_path(spark, "jsonl")
    jsonl.write_jsonl(table(spark, folder, "documents"), path)
    return jsonl.read_jsonl(spark, path, _SCHEMA)


def _tolerant(spark, folder) -> DataFrame:
    # Lines of German documents lose their last brace; Spanish ones have no text.
    path = new_path(spark, "broken-jsonl")
    docs = table(spark, folder, "documents")
    line = F.to_json(F.struct("doc_id", F.when(F.col("lang") != "es", F.col("text")).alias("text"),
                              "lang"))
    docs.select("lang", line.alias("line")).select(
        F.when(F.col("lang") == "de", F.expr("left(line, length(line) - 1)"))
        .otherwise(F.col("line")).alias("value")).write.text(path)
    return jsonl.read_jsonl(spark, path, "doc_id bigint, text string, lang string", "drop", "text")


def _glob(spark, folder) -> DataFrame:
    path = new_path(spark, "by-source")
    table(spark, folder, "documents").write.partitionBy("source").json(path)
    return jsonl.read_jsonl(spark, f"{path}/source=*/*.json", "doc_id bigint, text string, lang string")


def _columnar(spark, folder) -> DataFrame:
    path = new_path(spark, "columnar")
    jsonl.write_table(table(spark, folder, "documents"), path)
    return jsonl.read_table(spark, path)


def _unescaped(spark, folder) -> DataFrame:
    # The raw lines: characters are not escaped and null fields are written.
    path = new_path(spark, "lines")
    docs = table(spark, folder, "documents")
    nulls = docs.select("doc_id", F.when(F.col("lang") != "en", F.col("lang")).alias("lang"), "text")
    jsonl.write_jsonl(nulls, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def _guarded(spark, folder) -> DataFrame:
    # The second write finds a result and leaves it; empty input writes nothing.
    path = new_path(spark, "guarded")
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    jsonl.write_guarded(docs, path)
    jsonl.write_guarded(docs.withColumn("lang", F.lit("other")), path)
    jsonl.write_guarded(docs.filter("doc_id < 0"), path, from_scratch=True)
    return jsonl.read_jsonl(spark, path, "doc_id bigint, lang string, text string")


def _keywords(spark, folder) -> DataFrame:
    # Keyword files with all lines of the documents.
    path = new_path(spark, "keywords")
    lines = table(spark, folder, "documents").select(F.explode(F.split("text", "\n", -1)).alias("line"))
    lines.select(F.concat("line", F.lit(",")).alias("value")).write.text(path)
    return wordlists.load_keywords(spark, path)


def _stopwords(spark, folder) -> DataFrame:
    path = new_path(spark, "stopwords")
    words = F.explode(F.split("text", r"\s"))
    table(spark, folder, "benchmark").select(words.alias("value")).write.text(path)
    return wordlists.load_stopwords(spark, path)


def _checks(spark, folder) -> DataFrame:
    path = new_path(spark, "checks")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    jsonl.write_step_checks(docs, remove_template_lines(docs), path, 0, "dedup_template_soft")
    return jsonl.read_table(spark, f"{path}/0_dedup_template_soft_checks")


def _cluster_table(spark, folder) -> DataFrame:
    path = new_path(spark, "clusters")
    jsonl.write_clusters(fuzzy_clusters(table(spark, folder, "documents")), path)
    return jsonl.read_table(spark, path)


def _stream(spark, folder) -> DataFrame:
    source, sink, log = (new_path(spark, p) for p in ("stream-in", "stream-out", "stream-log"))
    jsonl.write_jsonl(table(spark, folder, "documents").select("doc_id", "text"), source)
    stream = read_jsonl_stream(spark, source, "doc_id bigint, text string")
    cleaned = stream.withColumn("text", tx.unify_whitespace("text"))
    write_jsonl_stream(cleaned, sink, log).awaitTermination()
    return jsonl.read_jsonl(spark, sink, "doc_id bigint, text string")


def _columns(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.drop("source").withColumnRenamed("n_chars", "characters").select(
        "doc_id", "lang", "characters")


def _meta(spark, folder) -> DataFrame:
    pages = table(spark, folder, "pages")
    literal = F.concat(F.lit("{'url': '"), F.col("url"), F.lit("', 'id': '"), F.col("page_id"),
                       F.lit("'}"))
    return pages.select("page_id", plumbing.parse_meta(literal).alias("meta")).select(
        "page_id", "meta.url", "meta.id")


def _side_by_side(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return plumbing.concat_columns(
        docs.select("doc_id", F.col("text").alias("old_text")),
        docs.select("doc_id", tx.unify_whitespace("text").alias("text")))


def _row_index(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents").select("lang", "doc_id")
    return plumbing.add_row_index(docs, ["lang", "doc_id"])


def _sample(spark, folder) -> DataFrame:
    return plumbing.sample_rows(table(spark, folder, "documents"), 10).select("doc_id", "text")


def _strata(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("stratum", F.col("doc_id") % 7)
    return plumbing.sample_rows(docs, 5, by="stratum").select("stratum", "doc_id", "text")


def _language_tag(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    path = F.concat_ws("/", F.lit("data"), "source", F.concat(F.lit("lm_indic-"), "lang", F.lit("_web")))
    return docs.select("doc_id", plumbing.language_tag(path).alias("tag"))


def _catalogue_language(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    language = F.when(F.col("lang") == "de", F.lit("zh-cn")).when(
        F.col("lang") == "fr", F.lit("zh-tw")).otherwise(F.col("lang"))
    name = F.concat(F.lit("catalogue/lm_"), language, F.lit("_"), "source")
    return docs.select("doc_id", plumbing.catalogue_language(name).alias("language"))


def _dataset_name(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    path = F.concat(F.lit("/mnt/data/catalogue/lm_"), "lang", F.lit("_"), "source",
                    F.when(F.col("lang") == "en", F.lit("/data")).otherwise(""))
    return docs.select(
        "doc_id", plumbing.dataset_name(path, "catalogue", "/mnt/data/").alias("name"))


QUERIES = {
    "s01_read_jsonl_strict": (_strict, _COLUMNS),
    "s02_read_jsonl_tolerant": (
        _tolerant,
        "SELECT doc_id, CASE WHEN lang = 'es' THEN '' ELSE text END AS text, lang "
        "FROM documents WHERE lang <> 'de'"),
    "s03_read_jsonl_glob": (_glob, "SELECT doc_id, text, lang FROM documents"),
    "s04_columnar": (_columnar, _COLUMNS),
    "s05_write_jsonl": (
        _unescaped,
        "SELECT '{\"doc_id\":' || doc_id || ',\"lang\":' || CASE WHEN lang = 'en' THEN 'null' "
        "ELSE '\"' || lang || '\"' END || ',\"text\":' || to_json(text) || '}' AS line FROM documents"),
    "s06_guarded_write": (_guarded, "SELECT doc_id, lang, text FROM documents"),
    "s07_load_keywords": (
        _keywords,
        f"SELECT DISTINCT keyword FROM (SELECT rtrim({strip_sql("line || ','")}, ',') AS keyword "
        "FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) WHERE keyword <> ''"),
    "s08_load_stopwords": (
        _stopwords,
        r"SELECT unnest(regexp_split_to_array(text, '\s')) AS word FROM benchmark"),
    "s09_step_checks": (
        _checks,
        f"WITH {template_sql(15, 10)} SELECT doc_id, c.text, d.text AS old_text FROM cleaned c "
        "JOIN documents d USING (doc_id) WHERE c.text IS DISTINCT FROM d.text"),
    "s10_cluster_table": (
        _cluster_table, f"WITH RECURSIVE {clusters_sql(4, 6)} SELECT doc_id, cluster FROM clusters"),
    "stream_jsonl": (
        _stream, f"SELECT doc_id, {unify_whitespace_sql('text')} AS text FROM documents"),
    "j01_columns": (_columns, "SELECT doc_id, lang, n_chars AS characters FROM documents"),
    "j02_parse_meta": (
        _meta, "SELECT page_id, url, page_id::VARCHAR AS id FROM pages"),
    "j03_concat_columns": (
        _side_by_side,
        f"SELECT doc_id, text AS old_text, {unify_whitespace_sql('text')} AS text FROM documents"),
    "j04_row_index": (
        _row_index,
        "SELECT lang, doc_id, row_number() OVER (ORDER BY lang, doc_id) - 1 AS row_index "
        "FROM documents"),
    "j05_sample_rows": (
        _sample, "SELECT doc_id, text FROM documents ORDER BY md5('1234:' || doc_id), doc_id LIMIT 10"),
    "j05_sample_strata": (
        _strata,
        "SELECT doc_id % 7 AS stratum, doc_id, text FROM documents QUALIFY row_number() OVER "
        "(PARTITION BY doc_id % 7 ORDER BY md5('1234:' || doc_id), doc_id) <= 5"),
    "j06_language_tag": (
        _language_tag, "SELECT doc_id, substr(lang, 1, 2) AS tag FROM documents"),
    "j07_catalogue_language": (
        _catalogue_language,
        "SELECT doc_id, CASE lang WHEN 'de' THEN 'zhs' WHEN 'fr' THEN 'zht' ELSE lang END "
        "AS language FROM documents"),
    "j08_dataset_name": (
        _dataset_name,
        "SELECT doc_id, 'catalogue/lm_' || lang || '_' || source AS name FROM documents"),
}
