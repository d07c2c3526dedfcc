"""Quality evaluation; responses are derived from ``labels``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import subwords
from gristmill.operators import evaluate, plumbing, word_units
from gristmill.queries.common import quote, strip_sql, table

_TEMPLATE = "Rate this text:\n{corpus}\nScores:"
# One aspect line each; of documents with an id that ends in 7 one aspect is unknown,
# with an id that ends in 3 a line is missing.
_NAMES = evaluate.ASPECTS


def _score(i: int) -> Column:
    return (F.col("doc_id") * (i + 3) + F.col("quality") * 4 + F.col("toxic")) % 11


def _responses(spark, folder) -> DataFrame:
    labels = table(spark, folder, "labels")
    last = F.col("doc_id") % 10
    lines = []
    for i, name in enumerate(_NAMES):
        # One document in ten answers with fullwidth digits.
        score = F.when(last == 8, F.translate(_score(i).cast("string"), "0123456789", "０１２３４５６７８９")).otherwise(
            _score(i).cast("string"))
        label = F.when((last == 7) & F.lit(i == 2), F.lit("other")).otherwise(F.lit(name))
        line = F.concat(F.lit("【"), label, F.lit("】:reason "), F.col("doc_id").cast("string"),
                        F.lit("【分数】"), score)
        lines.append(F.when((last == 3) & F.lit(i == 4), F.lit(None)).otherwise(line))
    return labels.select("doc_id", F.concat_ws("\n", *lines).alias("response"))


_VALID = "doc_id % 10 NOT IN (3, 7)"


def _score_sql(i: int) -> str:
    return f"((doc_id * {i + 3} + quality * 4 + toxic) % 11)"


_QUALITY_SQL = " UNION ALL ".join(
    f"SELECT doc_id, {quote(name)} AS aspect, "
    f"CASE WHEN {_VALID} THEN 'reason ' || doc_id ELSE '' END AS reason, "
    f"(CASE WHEN {_VALID} THEN {_score_sql(i)} ELSE -1 END)::INTEGER AS score FROM labels"
    for i, name in enumerate(_NAMES)
)


def _parsed(spark, folder) -> DataFrame:
    parsed = _responses(spark, folder).select(
        "doc_id", F.explode(evaluate.parse_scores("response")).alias("aspect", "result"))
    return parsed.select("doc_id", "aspect", "result.reason", "result.score")


def _scored(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return evaluate.attach_scores(docs, _responses(spark, folder))


def _attached(spark, folder) -> DataFrame:
    rows = _scored(spark, folder).select("doc_id", "lang", F.explode("quality").alias("aspect", "result"))
    return rows.select("doc_id", "lang", "aspect", "result.score")


def _summary(spark, folder) -> DataFrame:
    found = evaluate.score_summary(_scored(spark, folder))
    return found.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


def _histogram(spark, folder) -> DataFrame:
    found = evaluate.score_histogram(_scored(spark, folder))
    return found.withColumn("low", F.round("low", 6)).withColumn("high", F.round("high", 6))


def _density(spark, folder) -> DataFrame:
    found = evaluate.score_density(_scored(spark, folder))
    return found.withColumn("x", F.round("x", 6)).withColumn("density", F.round("density", 6))


_SCORES = f"scores AS (SELECT * FROM ({_QUALITY_SQL}) WHERE score >= 0)"
_HISTOGRAM = (
    f"WITH {_SCORES}, ends AS (SELECT aspect, min(score)::DOUBLE AS a, max(score)::DOUBLE AS b "
    "FROM scores GROUP BY aspect), bins AS (SELECT aspect, a, (b - a) / 10 AS w, "
    "unnest(range(10))::INTEGER AS bin FROM ends), "
    "placed AS (SELECT aspect, least(floor(round((score - a) / ((b - a) / 10), 9)), 9)::INTEGER AS bin, "
    "count(*) AS n FROM scores JOIN ends USING (aspect) GROUP BY ALL) "
    "SELECT aspect, bin, round(a + bin * w, 6) AS low, round(a + (bin + 1) * w, 6) AS high, "
    "coalesce(n, 0) AS n FROM bins LEFT JOIN placed USING (aspect, bin)"
)
_DENSITY = (
    f"WITH {_SCORES}, m AS (SELECT aspect, count(*) AS t, min(score) AS a, max(score) AS b, "
    "stddev_samp(score) * pow(count(*), -0.2) AS h FROM scores GROUP BY aspect), "
    "grid AS (SELECT *, a - 3 * h AS lo, b + 3 * h AS hi, unnest(range(200))::INTEGER AS point FROM m), "
    "xs AS (SELECT *, lo + point * (hi - lo) / 199 AS x FROM grid) "
    "SELECT aspect, point, round(x, 6) AS x, "
    "round(sum(exp(-0.5 * pow((x - score) / h, 2))) / (t * h * sqrt(2 * pi())), 6) AS density "
    "FROM xs JOIN scores USING (aspect) GROUP BY aspect, point, x, t, h"
)


def _sampled(spark, folder) -> DataFrame:
    return plumbing.sample_rows(table(spark, folder, "documents"), 10).select("doc_id", "text")


def _truncated(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", evaluate.truncate_tokens("text", 100).alias("text"))


def _truncated_units(spark, folder) -> DataFrame:
    import public_tokenizers

    cut = subwords.truncate_units("text", public_tokenizers.path("byte_bpe_50k.json"), 100)
    return table(spark, folder, "documents").select("doc_id", cut.alias("text"))


def _prompts(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return evaluate.build_prompts(docs, _TEMPLATE).select("doc_id", "prompt")


def _cut(n: int) -> str:
    word = r"\p{L}\p{M}\p{N}\p{Pc}"
    blank = r"\s\x0b\x{85}\p{Z}"
    tokens = (
        f"regexp_extract_all({strip_sql('text')}, "
        f"{quote(f'[{blank}]*(?:[{word}]+|[^{blank}{word}])')})"
    )
    return f"CASE WHEN len({tokens}) > {n} THEN array_to_string({tokens}[1:{n}], '') ELSE text END"


def _stopwords(spark, folder) -> DataFrame:
    words = F.explode(F.split("text", r"\W+"))
    return table(spark, folder, "benchmark").select(words.alias("word"))


def _words(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = evaluate.word_frequencies(docs, _stopwords(spark, folder))
    return found.withColumn("weight", F.round("weight", 9))


_WORDS = (
    r"WITH stop AS (SELECT DISTINCT lower(unnest(regexp_split_to_array(text, '\W+'))) AS word "
    r"FROM benchmark), words AS (SELECT unnest(regexp_extract_all(lower(text), "
    r"'[\p{L}\p{M}\p{N}\p{Pc}]{2,}')) AS word FROM documents), "
    "top AS (SELECT word, count(*) AS n FROM words WHERE word NOT IN (SELECT word FROM stop) "
    "GROUP BY word ORDER BY n DESC, word LIMIT 500) "
    "SELECT word, n, round(n / max(n) OVER (), 9) AS weight FROM top"
)

# Texts in a script without blanks: every letter becomes a Han character, and blanks go.
_LETTERS = "abcdefghijklmnopqrstuvwxyzñéóíäöüß"
_HAN = "".join(chr(0x4E00 + 7 * k) for k in range(len(_LETTERS)))


def _without_blanks(spark, folder) -> DataFrame:
    text = F.translate(F.lower("text"), _LETTERS + " ", _HAN)
    return table(spark, folder, "documents").select("doc_id", text.alias("text"))


def _learned(spark, folder) -> DataFrame:
    found = word_units.learn_words(_without_blanks(spark, folder))
    return found.withColumn("cohesion", F.round("cohesion", 6)).withColumn("entropy", F.round("entropy", 6))


def _unit_frequencies(spark, folder) -> DataFrame:
    docs = _without_blanks(spark, folder)
    found = evaluate.word_frequencies(docs, words=word_units.learn_words(docs))
    return found.withColumn("weight", F.round("weight", 9))


_WINDOWS = " UNION ALL ".join(
    f"SELECT n, unnest(list_transform(range(1, length(r) - {k - 2}), lambda i: r[i:i + {k - 1}])) AS gram FROM marked"
    for k in range(1, word_units.LONGEST + 2))
_PLAIN = "NOT contains(gram, chr(2)) AND NOT contains(gram, chr(3))"
_LEARNED = (
    "WITH runs AS (SELECT unnest(regexp_extract_all("
    f"translate(lower(text), {quote(_LETTERS + ' ')}, {quote(_HAN)}), '\\p{{Han}}+')) AS r FROM documents), "
    "marked AS (SELECT chr(2) || r || chr(3) AS r, count(*) AS n FROM runs GROUP BY 1), "
    f"grams AS MATERIALIZED (SELECT gram, sum(n)::BIGINT AS n FROM ({_WINDOWS}) GROUP BY gram), "
    f"total AS (SELECT sum(n)::DOUBLE AS t FROM grams WHERE length(gram) = 1 AND {_PLAIN}), "
    + ", ".join(
        f"{side} AS (SELECT {inner} AS gram, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS h FROM grams WHERE length(gram) > 2 GROUP BY 1)"
        for side, inner in (("after", "gram[:length(gram) - 1]"), ("before", "gram[2:]")))
    + f", words AS (SELECT gram, n, least(a.h, b.h) AS entropy FROM grams JOIN after a USING (gram) JOIN before b USING (gram) "
    f"WHERE length(gram) BETWEEN 2 AND {word_units.LONGEST} AND n >= {word_units.MIN_COUNT} AND {_PLAIN} "
    f"AND least(a.h, b.h) >= {word_units.MIN_ENTROPY}), "
    "splits AS (SELECT gram, n, unnest(range(1, length(gram))) AS k FROM words), "
    "cohesions AS (SELECT s.gram, min(log2(s.n::DOUBLE * t / x.n / y.n)) AS cohesion FROM splits s "
    "JOIN grams x ON x.gram = s.gram[:k] JOIN grams y ON y.gram = s.gram[k + 1:], total GROUP BY s.gram) "
    "SELECT gram AS word, n, round(cohesion, 6) AS cohesion, round(entropy, 6) AS entropy FROM words JOIN cohesions USING (gram) "
    f"WHERE cohesion >= {word_units.MIN_COHESION}"
)

QUERIES = {
    "e09_word_units": (_learned, _LEARNED),
    "e09_word_unit_frequencies": (_unit_frequencies, None),
    "e01_sample_documents": (
        _sampled, "SELECT doc_id, text FROM documents ORDER BY md5('1234:' || doc_id), doc_id LIMIT 10"),
    "e02_truncate_tokens": (_truncated, f"SELECT doc_id, {_cut(100)} AS text FROM documents"),
    "e02_truncate_subwords": (_truncated_units, None),
    "e03_build_prompts": (
        _prompts,
        f"SELECT doc_id, replace({quote(_TEMPLATE)}, '{{corpus}}', {_cut(1000)}) AS prompt "
        "FROM documents"),
    "e04_parse_scores": (_parsed, _QUALITY_SQL),
    "e05_attach_scores": (
        _attached,
        f"WITH scores AS ({_QUALITY_SQL}), aspects AS (SELECT unnest(["
        + ", ".join(map(quote, _NAMES))
        + "]) AS aspect) SELECT d.doc_id, d.lang, a.aspect, coalesce(s.score, -1)::INTEGER AS score "
        "FROM documents d CROSS JOIN aspects a LEFT JOIN scores s "
        "ON s.doc_id = d.doc_id AND s.aspect = a.aspect"),
    "e06_score_summary": (
        _summary,
        f"WITH {_SCORES} SELECT aspect, round(avg(score), 6) AS mean, "
        "round(stddev_pop(score), 6) AS std, min(score) AS min, max(score) AS max, "
        "count(*) AS count FROM scores GROUP BY aspect"),
    "e07_score_histogram": (_histogram, _HISTOGRAM),
    "e08_score_density": (_density, _DENSITY),
    "e09_word_frequencies": (_words, _WORDS),
}
