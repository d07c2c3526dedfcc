"""Language detection, language model and classifiers, trained on the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import subwords
from gristmill.operators import classify, filters, kneser_ney, langid, ngram_lm
from gristmill.queries.common import lm_normalize_sql, strip_sql, table
from gristmill.queries.text import _FIXED as FIXED
from gristmill.queries.text import _RATIO as RATIO
from gristmill.queries.text import rules_sql


def _langid_model(spark, folder) -> DataFrame:
    return langid.train_langid(table(spark, folder, "documents"))


_CHARS = "regexp_extract_all(lower(text), '(?s).')"
_GRAMS_SQL = (
    "CASE WHEN len(c) < 3 THEN [] ELSE list_transform(range(1, len(c) - 1), "
    "lambda i: c[i] || c[i+1] || c[i+2]) END"
)
_MODEL_SQL = (
    f"chars AS (SELECT doc_id, lang, {_CHARS} AS c FROM documents), "
    f"grams AS (SELECT doc_id, lang, unnest({_GRAMS_SQL}) AS gram FROM chars), "
    f"model AS (SELECT lang, gram, count(*) AS n FROM grams GROUP BY lang, gram)"
)


def _scores_sql(counted: str = "grams") -> str:
    return (
        "totals AS (SELECT lang, sum(n) AS total FROM model GROUP BY lang), "
        "vocabulary AS (SELECT count(DISTINCT gram) AS v FROM model), "
        f"counted AS (SELECT doc_id, gram, count(*) AS times FROM {counted} GROUP BY doc_id, gram), "
        "scores AS (SELECT doc_id, totals.lang, "
        "sum(times * ln((coalesce(n, 0) + 1) / (total + v)::DOUBLE)) AS score "
        "FROM counted CROSS JOIN totals CROSS JOIN vocabulary "
        "LEFT JOIN model ON model.lang = totals.lang AND model.gram = counted.gram "
        "GROUP BY doc_id, totals.lang), "
        "best AS (SELECT doc_id, lang AS language FROM scores QUALIFY row_number() OVER "
        "(PARTITION BY doc_id ORDER BY round(score, 6) DESC, lang) = 1)"
    )


_SCORES_SQL = f"{_MODEL_SQL}, {_scores_sql()}"
# The language of repaired texts, then the other rules.
_ENGLISH_SQL = (
    f"WITH {_MODEL_SQL}, fixed AS (SELECT doc_id, lang, {FIXED} AS text FROM documents WHERE text <> ''), "
    f"fixed_chars AS (SELECT doc_id, {_CHARS} AS c FROM fixed), "
    f"fixed_grams AS (SELECT doc_id, unnest({_GRAMS_SQL}) AS gram FROM fixed_chars), "
    f"{_scores_sql('fixed_grams')}, cleaned AS (SELECT doc_id, lang, {rules_sql('text')} AS text FROM fixed JOIN best USING (doc_id) "
    f"WHERE language = 'en') SELECT doc_id, text, lang FROM cleaned WHERE length(text) >= 128 AND {RATIO.format('text')} <= 0.5"
)


def _train_langid(spark, folder) -> DataFrame:
    return _langid_model(spark, folder)


def _scores(spark, folder) -> DataFrame:
    found = langid.language_scores(table(spark, folder, "documents"), _langid_model(spark, folder))
    return found.select("doc_id", "lang", F.round("score", 3).alias("score"))


def _detected(spark, folder) -> DataFrame:
    return langid.detect_language(table(spark, folder, "documents"), _langid_model(spark, folder))


def _in_english(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = _langid_model(spark, folder)
    return langid.language_filter(docs, "en", model).select("doc_id", "text", "lang")


def _rules_in_english(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = _langid_model(spark, folder)
    return filters.rule_filter(docs, "en", model).select("doc_id", "text", "lang")


# The language model is trained on the passages of ``benchmark``.
_WORDS = (
    "list_filter(regexp_split_to_array({x}, '[\\s\\x0b\\x{{85}}\\p{{Z}}]+'), lambda w: w <> '')"
)


def _bigrams_sql(source: str, key: str) -> str:
    words = _WORDS.format(x=strip_sql(lm_normalize_sql("text")))
    return (
        f"(SELECT {key}, w[i] AS context, w[i + 1] AS token FROM (SELECT {key}, w, "
        "unnest(range(1, len(w))) AS i FROM (SELECT "
        f"{key}, list_concat(['<s>'], {words}, ['</s>']) AS w FROM {source})))"
    )


_LM_SQL = (
    f"trained AS (SELECT context, token, count(*) AS n FROM {_bigrams_sql('benchmark', 'item_id')} "
    "GROUP BY context, token), "
    "size AS (SELECT sum(n) AS total, count(DISTINCT token) AS v FROM trained), "
    "single AS (SELECT token, (sum(n) + 1) / (SELECT (total + v + 1)::DOUBLE FROM size) AS p "
    "FROM trained GROUP BY token), "
    "contexts AS (SELECT context, sum(n)::DOUBLE AS c, 0.75::DOUBLE * count(*) / sum(n) AS left_over "
    "FROM trained GROUP BY context), "
    "pairs AS (SELECT context, token, (n - 0.75::DOUBLE) / c + left_over * p AS p FROM trained "
    "JOIN contexts USING (context) JOIN single USING (token)), "
    "model AS (SELECT context, token, log10(p) AS log10_prob FROM pairs UNION ALL "
    "SELECT NULL, token, log10(p) FROM single UNION ALL "
    "SELECT context, NULL, log10(left_over) FROM contexts UNION ALL "
    "SELECT NULL, NULL, log10(1 / (total + v + 1)::DOUBLE) FROM size)"
)
_PERPLEXITY_SQL = (
    f"{_LM_SQL}, counted AS (SELECT doc_id, context, token, count(*) AS times FROM "
    f"{_bigrams_sql('documents', 'doc_id')} GROUP BY ALL), "
    "unseen AS (SELECT log10(1 / (total + v + 1)::DOUBLE) AS u FROM size), "
    "scored AS (SELECT doc_id, times, coalesce(log10(pairs.p), coalesce(log10(left_over), 0) + "
    "coalesce(log10(single.p), u)) AS lp FROM counted CROSS JOIN unseen "
    "LEFT JOIN pairs USING (context, token) LEFT JOIN single ON single.token = counted.token "
    "LEFT JOIN contexts ON contexts.context = counted.context), "
    "perplexities AS (SELECT doc_id, round(pow(10, -sum(times * lp) / sum(times)), 1) AS perplexity "
    "FROM scored GROUP BY doc_id)"
)


def _tokens_sql(source: str, key: str) -> str:
    return f"SELECT {key}, list_concat(['<s>'], {_WORDS.format(x=strip_sql(lm_normalize_sql('text')))}, ['</s>']) AS w FROM {source}"


def _kneser_ney_sql(order: int) -> str:
    """Model tables ``p1`` … (gram, p) and ``c1`` … (gram, backoff) of the passages of ``benchmark``."""
    parts = [f"told AS MATERIALIZED ({_tokens_sql('benchmark', 'item_id')})"]
    for n in range(order, 0, -1):
        if n == order:
            rows = (f"SELECT array_to_string(w[i:i + {n - 1}], ' ') AS gram FROM "
                    f"(SELECT w, unnest(range(1, len(w) - {n - 2})) AS i FROM told)")
        else:
            rows = f"SELECT regexp_replace(gram, '^[^ ]+ ', '') AS gram FROM g{n + 1}"
            if n > 1:
                rows += f" UNION ALL SELECT array_to_string(w[1:{n}], ' ') FROM told WHERE len(w) >= {n}"
        parts.append(f"g{n} AS MATERIALIZED (SELECT gram, count(*) AS a FROM ({rows}) GROUP BY gram)")
    for n in range(1, order + 1):
        counts = ", ".join(f"count(*) FILTER (a = {k})::DOUBLE AS t{k}" for k in range(1, 5))
        found = [f"{k} - {k + 1} * (t1 / (t1 + 2 * t2)) * t{k + 1} / t{k}" for k in (1, 2, 3)]
        valid = " AND ".join(["t1 * t2 * t3 > 0", *(f"{f} BETWEEN 0 AND {k}" for k, f in enumerate(found, 1))])
        sizes = ", ".join(
            f"CASE WHEN {valid} THEN {f} ELSE {fallback}::DOUBLE END AS d{k}"
            for k, (f, fallback) in enumerate(zip(found, kneser_ney.FALLBACK), 1))
        lower = "1.0::DOUBLE / (SELECT count(*) + 1 FROM g1)" if n == 1 else "shorter.p"
        other = "" if n == 1 else f" JOIN p{n - 1} AS shorter ON shorter.gram = regexp_replace(r.gram, '^[^ ]+ ', '')"
        parts += [
            f"d{n} AS MATERIALIZED (SELECT {sizes} FROM (SELECT {counts} FROM g{n}))",
            f"r{n} AS (SELECT gram, a, regexp_replace(gram, ' ?[^ ]+$', '') AS context, "
            f"CASE a WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END AS d FROM g{n}, d{n})",
            f"c{n} AS MATERIALIZED (SELECT context, sum(a)::DOUBLE AS total, sum(d) / sum(a) AS backoff FROM r{n} GROUP BY context)",
            f"p{n} AS MATERIALIZED (SELECT r.gram, (a - d) / total + backoff * {lower} AS p FROM r{n} r JOIN c{n} USING (context){other})"]
    return ", ".join(parts)


_UNSEEN = "(SELECT log10(backoff / (SELECT count(*) + 1 FROM g1)) FROM c1)"


def _kneser_ney_model_sql(order: int) -> str:
    rows = [f"SELECT 0 AS n, '' AS gram, {_UNSEEN} AS log10_prob, NULL::DOUBLE AS log10_backoff"]
    for n in range(1, order):
        kind = "FULL" if n == 1 else "LEFT"
        rows.append(f"SELECT {n}, coalesce(p.gram, c.context), log10(p), log10(backoff) FROM p{n} p {kind} JOIN c{n + 1} c ON c.context = p.gram")
    rows.append(f"SELECT {order}, gram, log10(p), NULL FROM p{order}")
    return (f"WITH {_kneser_ney_sql(order)} SELECT n, gram, round(log10_prob, 9) AS log10_prob, "
            f"round(log10_backoff, 9) AS log10_backoff FROM ({' UNION ALL '.join(rows)})")


def _kneser_ney_perplexity_sql(order: int) -> str:
    score, joins = _UNSEEN, ""
    for n in range(1, order + 1):
        left = f"coalesce(log10(c{n}.backoff), 0) + " if n > 1 else ""
        score = f"coalesce(log10(p{n}.p), {left}{score})"
        joins += f" LEFT JOIN p{n} ON p{n}.gram = CASE WHEN len(x) >= {n} THEN array_to_string(x[-{n}:], ' ') END"
        if n > 1:
            joins += f" LEFT JOIN c{n} ON c{n}.context = CASE WHEN len(x) >= {n} THEN array_to_string(x[-{n}:-2], ' ') END"
    return (
        f"WITH {_kneser_ney_sql(order)}, asked AS ({_tokens_sql('documents', 'doc_id')}), "
        f"windows AS MATERIALIZED (SELECT doc_id, x, count(*) AS times FROM (SELECT doc_id, w[greatest(1, i - {order - 1}):i] AS x FROM "
        "(SELECT doc_id, w, unnest(range(2, len(w) + 1)) AS i FROM asked)) GROUP BY doc_id, x), "
        f"scores AS (SELECT x, {score} AS lp FROM (SELECT DISTINCT x FROM windows){joins}), "
        "perplexities AS (SELECT doc_id, round(pow(10, -sum(times * lp) / sum(times)), 1) AS perplexity FROM windows JOIN scores USING (x) GROUP BY doc_id)")


def _kneser_ney(spark, folder) -> DataFrame:
    return kneser_ney.train_kneser_ney(table(spark, folder, "benchmark"))


def _kneser_ney_table(spark, folder) -> DataFrame:
    rounded = [F.round(c, 9).alias(c) for c in ("log10_prob", "log10_backoff")]
    return _kneser_ney(spark, folder).select("n", "gram", *rounded)


def _perplexity_5(spark, folder) -> DataFrame:
    return kneser_ney.perplexity_kneser_ney(table(spark, folder, "documents"), _kneser_ney(spark, folder))


def _perplexity_5_filter(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = kneser_ney.perplexity_filter_kneser_ney(docs, _kneser_ney(spark, folder), 800.0)
    return found.select("doc_id", "text", "lang")


def _perplexity_of_units(spark, folder) -> DataFrame:
    # The path of the tokenizer file is a parameter; its module is needed here only.
    import public_tokenizers

    units = subwords.units(public_tokenizers.path("byte_bpe_50k.json"))
    model = kneser_ney.train_kneser_ney(table(spark, folder, "benchmark"), units=units)
    return kneser_ney.perplexity_kneser_ney(table(spark, folder, "documents"), model, units=units)


def _lm(spark, folder) -> DataFrame:
    return ngram_lm.train_ngram_lm(table(spark, folder, "benchmark"))


def _lm_counts(spark, folder) -> DataFrame:
    return ngram_lm.bigram_counts(table(spark, folder, "documents"))


def _lm_table(spark, folder) -> DataFrame:
    return _lm(spark, folder).withColumn("log10_prob", F.round("log10_prob", 9))


def _perplexity(spark, folder) -> DataFrame:
    return ngram_lm.perplexity(table(spark, folder, "documents"), _lm(spark, folder))


def _perplexity_filter(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return ngram_lm.perplexity_filter(docs, _lm(spark, folder), 800.0).select("doc_id", "text", "lang")


def _labelled(spark, folder) -> DataFrame:
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")


def _relevance(spark, folder) -> DataFrame:
    model = classify.train_classifier(_labelled(spark, folder), "quality")
    return classify.relevance_filter(table(spark, folder, "documents"), model).select("doc_id", "lang")


def _risk(spark, folder) -> DataFrame:
    model = classify.train_classifier(_labelled(spark, folder), "toxic")
    return classify.risk_filter(table(spark, folder, "documents"), model).select("doc_id", "lang")


QUERIES = {
    "f02_language_filter": (
        _in_english,
        f"WITH {_SCORES_SQL} SELECT doc_id, text, lang FROM documents JOIN best USING (doc_id) "
        "WHERE language = 'en'"),
    "f02a_train_langid": (_train_langid, f"WITH {_MODEL_SQL} SELECT lang, gram, n FROM model"),
    "f02b_language_scores": (
        _scores, f"WITH {_SCORES_SQL} SELECT doc_id, lang, round(score, 3) AS score FROM scores"),
    "f02b_detect_language": (
        _detected, f"WITH {_SCORES_SQL} SELECT doc_id, language FROM best"),
    "f12_rule_filter_english": (_rules_in_english, _ENGLISH_SQL),
    "l06_bigram_counts": (
        _lm_counts,
        f"SELECT context, token, count(*) AS n FROM {_bigrams_sql('documents', 'doc_id')} "
        "GROUP BY context, token"),
    "l06_train_ngram_lm": (
        _lm_table,
        f"WITH {_LM_SQL} SELECT context, token, round(log10_prob, 9) AS log10_prob FROM model"),
    "l07_perplexity": (
        _perplexity, f"WITH {_PERPLEXITY_SQL} SELECT doc_id, perplexity FROM perplexities"),
    "l08_perplexity_filter": (
        _perplexity_filter,
        f"WITH {_PERPLEXITY_SQL} SELECT doc_id, text, lang FROM documents "
        "JOIN perplexities USING (doc_id) WHERE perplexity <= 800"),
    "l06_train_kneser_ney": (_kneser_ney_table, _kneser_ney_model_sql(kneser_ney.ORDER)),
    "l07_perplexity_order5": (
        _perplexity_5,
        f"{_kneser_ney_perplexity_sql(kneser_ney.ORDER)} SELECT doc_id, perplexity FROM perplexities"),
    "l08_perplexity_filter_order5": (
        _perplexity_5_filter,
        f"{_kneser_ney_perplexity_sql(kneser_ney.ORDER)} SELECT doc_id, text, lang FROM documents "
        "JOIN perplexities USING (doc_id) WHERE perplexity <= 800"),
    "l07_perplexity_subwords": (_perplexity_of_units, None),
    "c01_relevance_filter": (_relevance, None),
    "c02_risk_filter": (_risk, None),
}
