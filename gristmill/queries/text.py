"""Text functions, keyword filter and rule filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import encoding
from gristmill.functions import text as tx
from gristmill.operators import filters, script
from gristmill.queries.common import (
    collapse_sql,
    letters_sql,
    lm_normalize_sql,
    quote,
    strip_sql,
    table,
    unify_punctuation_sql,
    unify_whitespace_sql,
)

_KEYWORDS = ["ass", "password", "Confidential", "http", "zzz"]
_MAPPING = {"ä": "a", "ö": "o", "ü": "u", "é": "e", "ß": "ss", "sch": "sh", "ción": "cion"}


def _text(function):
    def query(spark, folder) -> DataFrame:
        docs = table(spark, folder, "documents")
        return docs.select("doc_id", function("text").alias("text"))

    return query


def _sql(expression: str) -> str:
    return f"SELECT doc_id, {expression} AS text FROM documents"


_FIXED = (
    r"nfc_normalize(regexp_replace(translate(regexp_replace(text, '\r\n|[\r\x{85}\x{2028}\x{2029}]', "
    "chr(10), 'g'), " + quote(tx.FULLWIDTH_CHARS + chr(0x3000) + "‘’‚‛“”„‟") + ", "
    + quote(tx.HALFWIDTH_CHARS + " " + "'" * 4 + '"' * 4)
    + r"), '[\x00-\x08\x0b\x0e-\x1f\x7f\x{206a}-\x{206f}\x{feff}\x{fff9}-\x{fffb}]', '', 'g'))"
)
for _key, _value in tx.LIGATURES.items():
    _FIXED = f"replace({_FIXED}, {quote(_key)}, {quote(_value)})"


def _ratio(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.round(tx.punctuation_ratio("text"), 9).alias("ratio"))


_RATIO = r"len(regexp_extract_all({0}, '\p{{P}}')) / length({0})"


def _ratio_filter(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return filters.filter_punctuation_ratio(docs, 0.03).select("doc_id", "n_chars")


def _length_filter(spark, folder) -> DataFrame:
    return filters.filter_length(table(spark, folder, "documents")).select("doc_id", "n_chars")


def _keyword_filter(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return filters.sensitive_filter(docs, _KEYWORDS).select("doc_id", "text")


def _benchmark_words(spark, folder) -> DataFrame:
    lines = table(spark, folder, "benchmark").select(
        F.explode(F.split("text", r"[.\n]")).alias("line"))
    return lines.select(F.trim("line").alias("keyword")).filter("keyword <> ''")


def _keyword_table_filter(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return filters.sensitive_filter(docs, _benchmark_words(spark, folder)).select("doc_id", "lang")


def _keyword_list_filter(spark, folder) -> DataFrame:
    # A bound of 0 bytes sends the list through its index.
    docs = table(spark, folder, "documents")
    found = filters.sensitive_filter(docs, _benchmark_words(spark, folder), max_keyword_bytes=0)
    return found.select("doc_id", "text", "lang")


def _simplified(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", filters.to_simplified("text", _MAPPING).alias("text"))


# Phrases of 1 to 8 characters from the words of ``benchmark``, each backwards and marked.
_PHRASE = r"SELECT DISTINCT word[1:1 + length(word) % 8] AS source FROM (SELECT unnest(regexp_extract_all(text, '\pL+')) AS word FROM benchmark)"


def _converted(spark, folder) -> DataFrame:
    words = F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0)))
    source = F.substring("word", F.lit(1), F.length("word") % 8 + 1)
    mapping = table(spark, folder, "benchmark").select(words.alias("word")).select(source.alias("source")).distinct()
    mapping = mapping.withColumn("target", F.concat(F.reverse("source"), F.lit("~")))
    return script.convert_script(table(spark, folder, "documents").select("doc_id", "text"), mapping)


def _repaired(spark, folder) -> DataFrame:
    # Documents with an odd id were decoded with the wrong character set, some of them twice.
    docs = table(spark, folder, "documents").select("doc_id", "text")
    wrong = lambda text: F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    once = F.when(F.col("doc_id") % 2 == 1, wrong(F.col("text"))).otherwise(F.col("text"))
    twice = F.when(F.col("doc_id") % 10 == 1, wrong(F.col("text"))).otherwise(F.col("text"))
    broken = docs.withColumn("text", once).withColumn("text", twice)
    return encoding.repair_encoding(broken, encoding.pair_costs(encoding.byte_pairs(docs)))


_SIMPLIFIED = (
    "translate(replace(replace(replace(text, 'sch', 'sh'), 'ción', 'cion'), 'ß', 'ss'), "
    "'äöüé', 'aoue')"
)


def rules_sql(x: str) -> str:
    return strip_sql(collapse_sql(unify_whitespace_sql(unify_punctuation_sql(x))))


_RULES = rules_sql(_FIXED)


def _rules(spark, folder) -> DataFrame:
    return filters.rule_filter(table(spark, folder, "documents")).select("doc_id", "text", "lang")


QUERIES = {
    "f01_sensitive_filter": (
        _keyword_filter,
        "SELECT doc_id, text FROM documents WHERE "
        + " AND ".join(f"NOT contains(text, {quote(k)})" for k in _KEYWORDS)),
    "f01_sensitive_filter_word_table": (
        _keyword_table_filter,
        r"WITH words AS (SELECT DISTINCT trim(unnest(regexp_split_to_array(text, '[.\n]')), ' ') "
        "AS keyword FROM benchmark) SELECT doc_id, lang FROM documents d WHERE NOT EXISTS "
        "(SELECT 1 FROM words w WHERE keyword <> '' AND contains(d.text, w.keyword))"),
    "f01_sensitive_filter_long_list": (
        _keyword_list_filter,
        r"WITH words AS (SELECT DISTINCT trim(unnest(regexp_split_to_array(text, '[.\n]')), ' ') "
        "AS keyword FROM benchmark) SELECT doc_id, text, lang FROM documents d WHERE NOT EXISTS "
        "(SELECT 1 FROM words w WHERE keyword <> '' AND contains(d.text, w.keyword))"),
    "f03_unify_punctuation": (_text(tx.unify_punctuation), _sql(unify_punctuation_sql("text"))),
    "f04_unify_whitespace": (_text(tx.unify_whitespace), _sql(unify_whitespace_sql("text"))),
    "f05_collapse_punctuation": (_text(tx.collapse_punctuation), _sql(collapse_sql("text"))),
    "f06_strip": (_text(tx.strip), _sql(strip_sql("text"))),
    "f07_punctuation_ratio": (
        _ratio,
        f"SELECT doc_id, round({_RATIO.format('text')}, 9) AS ratio FROM documents"),
    "f08_filter_punctuation_ratio": (
        _ratio_filter,
        f"SELECT doc_id, n_chars FROM documents WHERE {_RATIO.format('text')} <= 0.03"),
    "f09_filter_length": (
        _length_filter, "SELECT doc_id, n_chars FROM documents WHERE length(text) >= 128"),
    "f10_to_simplified": (_simplified, _sql(_SIMPLIFIED)),
    "f10_convert_script": (
        _converted,
        f"WITH pairs AS ({_PHRASE}), held AS (SELECT string_agg(source, '|' ORDER BY length(source) DESC, source) || '|(?s:.)' AS p, "
        "map(list(source), list(reverse(source) || '~')) AS m FROM pairs) SELECT doc_id, array_to_string(list_transform("
        "regexp_extract_all(text, p), lambda t: coalesce(m[t], t)), '') AS text FROM documents, held"),
    "f11_repair_encoding": (_repaired, "SELECT doc_id, text FROM documents"),
    "f11_fix_text": (_text(tx.fix_text), _sql(_FIXED)),
    "f12_rule_filter": (
        _rules,
        f"WITH cleaned AS (SELECT doc_id, lang, {_RULES} AS text FROM documents WHERE text <> '') "
        f"SELECT doc_id, text, lang FROM cleaned WHERE length(text) >= 128 "
        f"AND {_RATIO.format('text')} <= 0.5"),
    "l01_lm_normalize": (_text(tx.normalize_for_lm), _sql(lm_normalize_sql("text"))),
    "l02_strip_accents": (
        _text(tx.strip_accents), _sql("strip_accents(nfc_normalize(text))")),
    "l03_digits_to_zero": (
        _text(tx.digits_to_zero), _sql(r"regexp_replace(text, '\p{Nd}', '0', 'g')")),
    "l04_delete_unicode_punctuation": (
        _text(tx.delete_unicode_punctuation),
        _sql(f"translate(text, {quote(''.join(tx.PUNCTUATION_MAP))}, '')")),
    "l05_remove_control_characters": (
        _text(tx.remove_control_characters),
        _sql(r"regexp_replace(text, '[\x00-\x1f\x7f-\x{9f}]', '', 'g')")),
    "d06_normalize_letters": (_text(tx.letters_only), _sql(letters_sql("text"))),
    "d02_hash_text": (_text(tx.text_hash), _sql(f"md5({strip_sql('text')})")),
    "m15_normalize_for_dedup": (
        _text(tx.normalize_for_dedup),
        _sql(rf"regexp_replace(regexp_replace(lower({strip_sql('text')}), '\p{{Nd}}', '0', 'g'), "
             r"'[\p{P}\p{C}\p{S}]+', '', 'g')")),
}
