"""Language models of higher order: modified Kneser-Ney smoothing, trained by Spark.

The tokens of a text are its words between ``<s>`` and ``</s>``. N-grams of the highest
order, and those that begin with ``<s>``, are counted; a lower one counts the different
tokens that stand before it. With ``a`` for that count, ``h`` for the tokens before ``w``
and one discount for counts of 1, 2 and more:

``p(w | h) = (a(hw) - D(a(hw))) / a(h.) + b(h) p(w | h')``, ``b(h) = sum D_i N_i(h) / a(h.)``

where ``h'`` is ``h`` without its first token; single words are interpolated with one over
the number of distinct ones, the unseen one included. Scoring backs off: an n-gram of the
model has its probability, any other one ``b(h)`` times that of the next shorter one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators.ngram_lm import (
    END, MAX_BROADCAST_ROWS, MAX_PERPLEXITY, SCALE, START, _hash, _in_parts, _marked_hashes, _perplexity_of, words,
)
from gristmill.operators.skew import MIN_HOT_ROWS, join_groups
from gristmill.staging import spread, stage

ORDER = 5
# Discounts of counts 1, 2 and more where a corpus is too small to estimate them.
FALLBACK = (0.5, 1.0, 1.5)


Units = Callable[[str], Column]


def _padded(text_col: str, units: Units) -> Column:
    return F.concat(F.array(F.lit(START)), units(text_col), F.array(F.lit(END)))


def _grams(tokens: Column, n: int, first: Column, count: Column) -> Column:
    """``count`` n-grams, joined by blanks, from the ``first`` place on."""
    return F.transform(
        F.when(count > 0, F.sequence(first, first + count - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.array_join(F.slice(tokens, i, n), " "))


def _suffix(gram: Column, n: int) -> Column:
    return F.substring_index(gram, " ", 1 - n) if n > 1 else F.lit("")


def _prefix(gram: Column, n: int) -> Column:
    return F.substring_index(gram, " ", n - 1) if n > 1 else F.lit("")


def adjusted_counts(
    df: DataFrame, order: int = ORDER, text_col: str = "text", units: Units = words
) -> list[DataFrame]:
    """``(gram, a)`` of orders 1 to ``order``, as written tables; ``<s>`` is no word."""
    tokens = spread(df.select(text_col)).select(_padded(text_col, units).alias("_tokens"))
    size = F.size("_tokens")
    one = F.lit(1)
    whole = tokens.select(F.explode(_grams(F.col("_tokens"), order, one, size - (order - 1))).alias("gram"))
    out = [stage(whole.groupBy("gram").agg(F.count("*").alias("a")), f"grams-{order}")]
    for n in range(order - 1, 0, -1):
        inner = out[0].select(_suffix(F.col("gram"), n + 1).alias("gram")).groupBy("gram").agg(F.count("*").alias("a"))
        if n > 1:
            opening = tokens.filter(size >= n).select(F.array_join(F.slice("_tokens", 1, n), " ").alias("gram"))
            inner = inner.unionByName(opening.groupBy("gram").agg(F.count("*").alias("a")))
        out.insert(0, stage(inner, f"grams-{n}"))
    return out


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Discounts of adjusted counts of 1, 2 and more, from the counts of counts."""
    t = counts.agg(*[F.count_if(F.col("a") == k) for k in range(1, 5)]).first()
    if not all(t[:3]):
        return FALLBACK
    y = t[0] / (t[0] + 2 * t[1])
    found = tuple(k + 1 - (k + 2) * y * t[k + 1] / t[k] for k in range(3))
    return found if all(0 <= d <= k + 1 for k, d in enumerate(found)) else FALLBACK


def train_kneser_ney(
    df: DataFrame, order: int = ORDER, text_col: str = "text", units: Units = words
) -> DataFrame:
    """``(n, gram, log10_prob, log10_backoff)``, one row per n-gram of orders 1 to ``order``.

    The row of order 0 is the unseen word. ``<s>`` has no probability, and an n-gram that
    nothing follows has no back-off. ``units`` gives the tokens of a text, by default its
    words; see :mod:`gristmill.functions.subwords`. N-grams are strings of words joined by blanks; only
    they are shuffled, and the rows of frequent contexts and endings are spread over salts.
    """
    counts = adjusted_counts(df, order, text_col, units)
    vocabulary = counts[0].count() + 1
    lower, out, contexts = None, [], []
    for n, table in enumerate(counts, 1):
        d1, d2, d3 = discounts(table)
        discount = F.when(F.col("a") == 1, d1).when(F.col("a") == 2, d2).otherwise(d3)
        split = table.select("gram", "a", _prefix(F.col("gram"), n).alias("context"), _suffix(F.col("gram"), n).alias("ending"))
        followed = stage(split.groupBy("context").agg(
            F.sum("a").alias("total"), F.count("*").alias("_n"),
            *[F.count_if(test).alias(f"n{k}") for k, test in enumerate((F.col("a") == 1, F.col("a") == 2, F.col("a") > 2), 1)],
        ).withColumn("backoff", (d1 * F.col("n1") + d2 * F.col("n2") + d3 * F.col("n3")) / F.col("total")), f"contexts-{n}")
        rows = join_groups(split, followed.select("context", "total", "backoff", "_n"), ["context"], "_n", ["gram"])
        own = (F.col("a") - discount) / F.col("total")
        if n == 1:
            left = (followed.first() or {"backoff": 1.0})["backoff"]
            probabilities = rows.select("gram", (own + F.col("backoff") / vocabulary).alias("p"))
        else:
            ending = split.groupBy("ending").agg(F.count("*").alias("_n")).join(
                lower.select(F.col("gram").alias("ending"), F.col("p").alias("shorter")), "ending")
            rows = join_groups(rows, ending, ["ending"], "_n", ["gram"])
            probabilities = rows.select("gram", (own + F.col("backoff") * F.col("shorter")).alias("p"))
            contexts.append(followed.select("context", "backoff"))
        lower = stage(probabilities, f"probabilities-{n}")
        out.append(lower)
    spark, empty = df.sparkSession, F.lit(None).cast("double")
    model = spark.range(1).select(
        F.lit(0).alias("n"), F.lit("").alias("gram"), F.log10(F.lit(left / vocabulary)).alias("log10_prob"), empty.alias("log10_backoff"))
    for n, table in enumerate(out, 1):
        if n < order:
            joined = table.join(contexts[n - 1].withColumnRenamed("context", "gram"), "gram", "full" if n == 1 else "left")
        else:
            joined = table.withColumn("backoff", empty)
        model = model.unionByName(joined.select(
            F.lit(n).alias("n"), "gram", F.log10("p").alias("log10_prob"), F.log10("backoff").alias("log10_backoff")))
    return model


def _integers(model: DataFrame) -> DataFrame:
    # Sums of integers do not depend on their order.
    fixed = lambda c: F.floor(F.col(c) * SCALE + F.lit(0.5)).cast("bigint")
    return model.select("n", "gram", fixed("log10_prob").alias("p"), F.coalesce(fixed("log10_backoff"), F.lit(0)).alias("b"))


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _row_perplexity(model: DataFrame, text_col: str, units: Units) -> Column:
    """Perplexity of a text in its row, from a model as sorted arrays of hashed n-grams."""
    rows = model.toPandas()
    order = int(rows["n"].max())
    tables = []
    for n in range(1, order + 1):
        mine = rows[rows["n"] == n]
        keys = np.zeros(len(mine), np.uint64)
        parts = mine["gram"].str.split(" ", expand=True)
        for k in range(n if len(mine) else 0):
            keys = keys * _ODD + _hash(parts[k].to_numpy())
        place = np.argsort(keys)
        tables.append((
            keys[place], mine["p"].fillna(0).to_numpy(np.int64)[place], mine["p"].notna().to_numpy()[place],
            mine["b"].to_numpy(np.int64)[place]))
    unseen = int(rows["p"][rows["n"] == 0].iloc[0])
    shared = model.sparkSession.sparkContext.broadcast((tables, unseen, _hash([START, END])))

    def score(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        tables, unseen, marks = shared.value
        sizes, full = _marked_hashes(tokens, *marks)
        first = np.cumsum(sizes + 2) - sizes - 2
        place = np.arange(len(full)) - np.repeat(first, sizes + 2)
        value, key = np.full(len(full), unseen, np.int64), np.zeros(len(full), np.uint64)
        power, context = np.uint64(1), None
        for n, (known, p, real, b) in enumerate(tables, 1):
            # The key of the last n tokens, and of the n - 1 before the last.
            earlier = np.r_[np.zeros(n - 1, np.uint64), full][:len(full)]
            context = np.r_[np.uint64(0), key[:-1]] if len(key) else key
            key = key + earlier * power
            power = np.uint64(int(power) * int(_ODD) & (1 << 64) - 1)
            inside = place >= n - 1

            def look_up(wanted, held):
                keys, values, usable = held
                if not len(keys):
                    return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                return values[at], (keys[at] == wanted) & usable[at] & inside

            if n > 1:
                keys, _, _, backoff = tables[n - 2]
                less, there = look_up(context, (keys, backoff, np.ones(len(keys), bool)))
                value = value + np.where(there, less, 0)
            whole, there = look_up(key, (known, p, real))
            value = np.where(there, whole, value)
        value[first] = 0
        return np.add.reduceat(value, first), sizes + 1

    @F.arrow_udf("sum bigint, n int")
    def log10_sum(tokens: pa.Array) -> pa.Array:
        return _in_parts(tokens, score)

    # Not deterministic for the planner only, which then leaves the call where it is. Tokens
    # are counted there, too, so that they are made once.
    found = log10_sum.asNondeterministic()(units(text_col))
    return F.transform(F.array(found), lambda s: _perplexity_of(s["sum"], s["n"]))[0]


def _log10_by_join(
    texts: DataFrame, model: DataFrame, order: int, text_col: str, id_col: str, units: Units, min_hot_rows: int
) -> DataFrame:
    """``(id, log10_sum, length)``: every distinct window of tokens backs off until the model holds it."""
    tokens = texts.select(id_col, _padded(text_col, units).alias("_tokens"))
    window = F.transform(
        F.sequence(F.lit(2), F.size("_tokens")),
        lambda i: F.array_join(F.slice("_tokens", F.greatest(i - (order - 1), F.lit(1)), F.least(i, F.lit(order))), " "))
    windows = stage(tokens.select(id_col, F.explode(window).alias("window")).groupBy(id_col, "window").agg(
        F.count("*").alias("times")), "windows")
    open_ = windows.groupBy("window").agg(F.count("*").alias("_weight")).select(
        "window", "_weight", F.col("window").alias("gram"), F.lit(0).cast("bigint").alias("sum"))
    unseen = model.filter("n = 0").first()["p"]
    done = None
    for n in range(order, 0, -1):
        # Windows at the start of a text are shorter; they wait for their order.
        size = F.size(F.split("gram", " "))
        open_ = stage(open_, "open")
        ready, waiting = open_.filter(size == n), open_.filter(size < n)
        held = model.filter((F.col("n") == n) & F.col("p").isNotNull()).select("gram", "p")
        wanted = ready.groupBy("gram").agg(F.count("*").alias("_n")).join(held, "gram", "left")
        scored = stage(join_groups(ready, wanted, ["gram"], "_n", ["window"], min_hot_rows=min_hot_rows), "scored")
        found = scored.filter("p IS NOT NULL").select("window", "_weight", (F.col("sum") + F.col("p")).alias("value"))
        done = found if done is None else done.unionByName(found)
        rest = scored.filter("p IS NULL").drop("p")
        if n == 1:
            done = done.unionByName(rest.select("window", "_weight", (F.col("sum") + unseen).alias("value")))
            break
        rest = rest.withColumn("context", _prefix(F.col("gram"), n))
        backoffs = model.filter(F.col("n") == n - 1).select(F.col("gram").alias("context"), "b")
        wanted = rest.groupBy("context").agg(F.count("*").alias("_n")).join(backoffs, "context", "left")
        rest = join_groups(rest, wanted, ["context"], "_n", ["window"], min_hot_rows=min_hot_rows)
        open_ = waiting.unionByName(rest.select(
            "window", "_weight", _suffix(F.col("gram"), n).alias("gram"), (F.col("sum") + F.coalesce("b", F.lit(0))).alias("sum")))
    scores = join_groups(windows, done, ["window"], "_weight", [id_col], min_hot_rows=min_hot_rows)
    return scores.groupBy(id_col).agg(
        F.sum(F.col("times") * F.col("value")).alias("log10_sum"), F.sum("times").alias("length"))


def perplexity_kneser_ney(
    df: DataFrame,
    model: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    units: Units = words,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """``(id, perplexity)``: ``10 ** (-sum of log10 / (tokens + 1))``, to one decimal.

    A model of at most ``max_broadcast_rows`` rows is sent to the workers, and every text
    is scored in its row. Of a larger one only the n-grams of the texts meet the model,
    each distinct window once an order. Both add the same integers.
    """
    model = stage(_integers(model), "model")
    texts = spread(df.select(id_col, text_col), id_col)
    if model.count() <= max_broadcast_rows:
        return texts.select(id_col, _row_perplexity(model, text_col, units).alias("perplexity"))
    order = model.agg(F.max("n")).first()[0]
    sums = _log10_by_join(texts, model, order, text_col, id_col, units, min_hot_rows)
    return sums.select(id_col, _perplexity_of(F.col("log10_sum"), F.col("length")).alias("perplexity"))


def perplexity_filter_kneser_ney(
    df: DataFrame,
    model: DataFrame,
    max_perplexity: float = MAX_PERPLEXITY,
    text_col: str = "text",
    id_col: str = "doc_id",
    units: Units = words,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Keep the rows whose perplexity is at most the limit; in the row when the model fits."""
    model = stage(model, "model")
    if model.count() <= max_broadcast_rows:
        held = stage(_integers(model), "model")
        return df.filter(_row_perplexity(held, text_col, units) <= max_perplexity)
    scores = perplexity_kneser_ney(df, model, text_col, id_col, units, max_broadcast_rows)
    worse = stage(scores.filter(F.col("perplexity") > max_perplexity).select(id_col), "perplexed")
    return df.join(worse, id_col, "left_anti")
