"""Quality evaluation: prompts out, responses in, score and word statistics."""

from __future__ import annotations

import math
import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions import text as tx
from gristmill.operators.word_units import han_runs, segmenter
from gristmill.staging import stage

# ---- fixed values --------------------------------------------------------
ASPECTS = ["语言质量", "信息量", "新颖性", "连贯性", "纯净度"]
RESPONSE_PATTERN = r"【(.*?)】:(.*?)【分数】(\p{Nd}+)\n"
MAX_TOKENS = 1000
TOP_WORDS = 500
BINS = 10
# ---- end of fixed values -------------------------------------------------

# Decimal digits of all scripts and their values, by the Unicode rule.
_DIGITS = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Nd"]
_ASCII_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)

PROMPT = (
    "Score the text between the marks for five aspects, 0 to 10 points each: "
    + ", ".join(ASPECTS)
    + ".\nAnswer with one line per aspect in the form 【aspect】:reason【分数】points\n"
    "【text】\n{corpus}\n【end】"
)
QUALITY_TYPE = "map<string,struct<reason:string,score:int>>"


def _col(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def truncate_tokens(text: Column | str, max_tokens: int = MAX_TOKENS) -> Column:
    """The first tokens of a longer text; a shorter one is unchanged.

    A token is a Han character, another word run or a single mark, with the white
    space before it, so the kept tokens joined are a prefix of the stripped text.
    """
    text = _col(text)
    pattern = r"(?U)\s*(?:\p{IsHan}|[\w&&[^\p{IsHan}]]+|[^\w\s])"
    tokens = F.regexp_extract_all(tx.strip(text), F.lit(pattern), F.lit(0))
    return F.transform(
        F.array(tokens),
        lambda t: F.when(F.size(t) > max_tokens, F.array_join(F.slice(t, 1, max_tokens), ""))
        .otherwise(text),
    )[0]


def build_prompts(
    df: DataFrame, template: str = PROMPT, text_col: str = "text", max_tokens: int = MAX_TOKENS
) -> DataFrame:
    """Add ``prompt``: the template with the cut text."""
    prompt = F.replace(F.lit(template), F.lit("{corpus}"), truncate_tokens(text_col, max_tokens))
    return df.withColumn("prompt", prompt)


def _unscored() -> Column:
    blank = F.struct(F.lit("").alias("reason"), F.lit(-1).alias("score"))
    return F.map_from_arrays(
        F.array(*map(F.lit, ASPECTS)), F.array(*[blank for _ in ASPECTS])
    )


def parse_scores(response: Column | str) -> Column:
    """``quality`` map from a response; -1 for all aspects unless it is well formed.

    Exactly one hit per aspect is counted for, whatever the aspects; an unknown aspect
    makes the response invalid, and of a repeated aspect the last hit counts.
    """
    body = F.concat(F.coalesce(_col(response), F.lit("")), F.lit("\n"))
    pattern = F.lit("(?d)" + RESPONSE_PATTERN)
    aspects, reasons, scores = (
        F.regexp_extract_all(body, pattern, F.lit(group)) for group in (1, 2, 3)
    )
    hits = F.arrays_zip(
        aspects.alias("aspect"), reasons.alias("reason"), scores.alias("score")
    )
    known = F.array(*map(F.lit, ASPECTS))

    def last(aspect: str) -> Column:
        own = F.filter(hits, lambda h: h["aspect"] == aspect)
        hit = F.try_element_at(own, F.lit(-1))
        return F.struct(
            F.coalesce(hit["reason"], F.lit("")).alias("reason"),
            F.coalesce(
                F.translate(hit["score"], "".join(_DIGITS), _ASCII_DIGITS).try_cast("int"), F.lit(-1)
            ).alias("score"),
        )

    parsed = F.map_from_arrays(known, F.array(*[last(a) for a in ASPECTS]))
    valid = (F.size(aspects) == len(ASPECTS)) & (F.size(F.array_except(aspects, known)) == 0)
    return F.when(valid, parsed).otherwise(_unscored())


def attach_scores(
    df: DataFrame, responses: DataFrame, id_col: str = "doc_id", response_col: str = "response"
) -> DataFrame:
    """Add ``quality`` to every document; without a response no aspect is scored."""
    answers = responses.select(id_col, F.col(response_col).alias("_response"))
    joined = df.join(answers, id_col, "left")
    return joined.withColumn("quality", parse_scores("_response")).drop("_response")


def aspect_scores(df: DataFrame) -> DataFrame:
    """``(aspect, score, n)``: how often each score was given; unscored is left out."""
    return (
        df.select(F.explode("quality").alias("aspect", "result"))
        .select("aspect", F.col("result.score").alias("score"))
        .filter("score >= 0")
        .groupBy("aspect", "score")
        .agg(F.count("*").alias("n"))
    )


def score_summary(df: DataFrame) -> DataFrame:
    """``(aspect, mean, std, min, max, count)`` with the population deviation."""
    scores = df.select(F.explode("quality").alias("aspect", "result")).select(
        "aspect", F.col("result.score").alias("score")).filter("score >= 0")
    return scores.groupBy("aspect").agg(
        F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"),
        F.min("score").alias("min"), F.max("score").alias("max"), F.count("*").alias("count"),
    )


def score_histogram(df: DataFrame, bins: int = BINS) -> DataFrame:
    """``(aspect, bin, low, high, n)``: equal bins from minimum to maximum, the last closed.

    Only ``(aspect, score)`` counts are binned, not documents. A single score gets
    bins around it, one wide in total.
    """
    per = Window.partitionBy("aspect")
    counts = aspect_scores(df).select(
        "aspect", "score", "n", F.min("score").over(per).alias("a"),
        F.max("score").over(per).alias("b"),
    )
    same = F.col("a") == F.col("b")
    low = F.when(same, F.col("a") - 0.5).otherwise(F.col("a").cast("double"))
    width = F.when(same, F.lit(1.0 / bins)).otherwise((F.col("b") - F.col("a")) / F.lit(bins))
    placed = counts.withColumn("low", low).withColumn("width", width).withColumn(
        "bin",
        F.least(F.floor(F.round((F.col("score") - F.col("low")) / F.col("width"), 9)),
                F.lit(bins - 1)).cast("int"),
    )
    filled = placed.groupBy("aspect", "low", "width", "bin").agg(F.sum("n").alias("n"))
    every = filled.groupBy("aspect", "low", "width").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found")
    )
    return every.select(
        "aspect", "low", "width", "found",
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
    ).select(
        "aspect", "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("low"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("high"),
        F.coalesce(F.try_element_at("found", F.col("bin")), F.lit(0)).alias("n"),
    )


def score_density(df: DataFrame, points: int = 200, cut: float = 3.0) -> DataFrame:
    """``(aspect, point, x, density)``: Gaussian density with Scott's bandwidth.

    The grid reaches ``cut`` bandwidths beyond the scores. Aspects with a single score
    value have no density. Work is one row per distinct score and grid point; no row holds
    the scores of an aspect.
    """
    counts = stage(aspect_scores(df), "scores")
    moments = counts.groupBy("aspect").agg(
        F.sum("n").alias("total"),
        F.sum(F.col("n") * F.col("score")).alias("s1"),
        F.sum(F.col("n") * F.col("score") * F.col("score")).alias("s2"),
        F.min("score").alias("a"), F.max("score").alias("b"),
    ).filter("b > a")
    variance = (F.col("s2") - F.col("s1") * F.col("s1") / F.col("total")) / (F.col("total") - 1)
    bandwidth = F.sqrt(variance) * F.pow(F.col("total").cast("double"), F.lit(-0.2))
    ends = moments.withColumn("h", bandwidth).select(
        "aspect", "total", "h",
        (F.col("a") - cut * F.col("h")).alias("left"), (F.col("b") + cut * F.col("h")).alias("right"),
    )
    grid = counts.join(ends, "aspect").withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("left") + F.col("point") * (F.col("right") - F.col("left")) / (points - 1)
    placed = grid.withColumn("x", x)
    z = (F.col("x") - F.col("score")) / F.col("h")
    kernel = F.col("n") * F.exp(-0.5 * z * z)
    return placed.groupBy("aspect", "point", "x", "total", "h").agg(
        F.sum(kernel).alias("mass")
    ).select(
        "aspect", "point", "x",
        (F.col("mass") / (F.col("total") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"),
    )


def word_frequencies(
    df: DataFrame, stopwords: DataFrame | None = None, top: int = TOP_WORDS, text_col: str = "text",
    words: DataFrame | None = None,
) -> DataFrame:
    """``(word, n, weight)`` of the most frequent words, relative to the first.

    Lower-cased word runs longer than one character, without stopwords. With ``words``
    (see :func:`gristmill.operators.word_units.learn_words`) runs of Han characters are
    cut into these words; otherwise such a run is one word. Words are counted before they
    meet the stopwords; ties go to the smaller word.
    """
    lowered = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    if words is None:
        found = F.regexp_extract_all(lowered, F.lit(r"(?U)\w{2,}"), F.lit(0))
    else:
        runs = han_runs(lowered)
        cut = segmenter(words)(F.when(F.size(runs) > 0, runs))
        others = F.regexp_extract_all(lowered, F.lit(r"(?U)[\w&&[^\p{IsHan}]]{2,}"), F.lit(0))
        longer = F.filter(F.coalesce(cut, F.array().cast("array<string>")), lambda w: F.length(w) > 1)
        found = F.concat(others, longer)
    counts = df.select(F.explode(found).alias("word")).groupBy("word").agg(
        F.count("*").alias("n"))
    if stopwords is not None:
        stop = stopwords.select(F.lower(F.col(stopwords.columns[0])).alias("word")).distinct()
        counts = counts.join(stop, "word", "left_anti")
    best = counts.orderBy(F.desc("n"), "word").limit(top)
    largest = F.max("n").over(Window.partitionBy(F.lit(0)))
    return best.select("word", "n", (F.col("n") / largest).alias("weight"))
