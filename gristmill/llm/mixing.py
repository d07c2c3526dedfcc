"""Mixing sources to target weights by entropy balancing, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.operators.plumbing import add_row_index
from gristmill.staging import stage

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: Newton ends when each constraint is met to this share of its target.
TOLERANCE = 1e-13
#: Documents of a source are rounded in tiers: above 1/20 of it, above 1/200, the rest.
TIERS = (20, 200)


def word_count(text: Column) -> Column:
    """Runs of characters other than blank and U+0009 to U+000D; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sources: DataFrame, weights: tuple[int, ...], share: float, most: float
) -> DataFrame:
    """``sources`` (``_key``, ``_total``: one row each) with ``_target``.

    Sources in the order of ``_key`` weigh ``weights``, repeating. They share ``share``
    times all tokens by weight, but none gets more than ``most`` times its own; what is
    cut off is shared by weight among the rest. That is ``min(most * total, c * weight)``
    for one level ``c``: with sources in the order of ``most * total / weight`` the capped
    ones come first, so ``c`` follows from running sums.
    """
    if share > most:
        raise ValueError("the sources cannot give that many tokens")
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy("_key")) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = sources.withColumn("_weight", weight).withColumn("_cap", F.col("_total") * F.lit(most))
    before = Window.orderBy(F.col("_cap") / F.col("_weight"), "_key").rowsBetween(
        Window.unboundedPreceding, -1)
    rest = F.sum("_total").over(everything) * F.lit(share) - F.coalesce(
        F.sum("_cap").over(before), F.lit(0.0))
    left = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    rows = rows.withColumn("_level", rest / left)
    fits = F.when(F.col("_level") <= F.col("_cap") / F.col("_weight"), F.col("_level"))
    rows = rows.withColumn("_level", F.max(fits).over(everything))
    target = F.least("_cap", F.coalesce(F.col("_level") * F.col("_weight"), F.col("_cap")))
    return rows.select("_key", "_total", target.alias("_target"))


def balance(cells: DataFrame, targets: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Targets with ``_rate``, the exponentially tilted rate of each constraint.

    Rates minimise the token-weighted relative entropy to "take everything once", subject
    to ``sum(tokens * rate) = target`` per constraint, so ``rate = exp(tilt)``. The dual is
    convex. A round of Newton's method sums the gradient ``tokens * exp(tilt) - target``
    and the curvature ``tokens * exp(tilt)`` over the cells; as no document is in two
    constraints the Hessian is diagonal and each constraint takes its own step. Steps are
    at most 1 (damped), and rounds end when all constraints are met. ``cells`` has
    ``_key, _tokens``; ``targets`` may have rates to begin with, ``_start``. A target of 0
    has rate 0.
    """
    start = F.when(F.col("_start") > 0, F.log("_start")).otherwise(F.lit(0.0)) if "_start" in targets.columns else F.lit(0.0)
    state = targets.withColumn("_tilt", start).drop("_start")
    for _ in range(most_rounds):
        sums = cells.join(state.select("_key", "_tilt"), "_key").groupBy("_key").agg(
            F.sum(F.col("_tokens") * F.exp("_tilt")).alias("_taken"))
        state = stage(state.join(sums, "_key"), "newton")
        gap = F.col("_taken") - F.col("_target")
        open_ = (F.col("_target") > 0) & (F.abs(gap) > F.col("_target") * TOLERANCE)
        if state.filter(open_).isEmpty():
            break
        step = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(-gap, F.col("_taken"))))
        state = state.withColumn("_tilt", F.when(open_, F.col("_tilt") + step).otherwise(F.col("_tilt")))
        state = state.drop("_taken")
    rate = F.when(F.col("_target") > 0, F.exp("_tilt")).otherwise(F.lit(0.0))
    return state.select("_key", "_total", "_target", F.round(rate, 12).alias("_rate"))


def _round_tier(rows: DataFrame, rates: DataFrame, most: float) -> DataFrame:
    """Whole copies of one tier: the k-th document of a source in size order gets the k-th step of rate * k.

    Places come from ranges of the order over all sources, so no task holds a source.
    """
    numbered = stage(add_row_index(rows, ["_key", "_size", "doc_id"], "_index"), "places")
    first = numbered.groupBy("_key").agg(F.min("_index").alias("_first"))
    place = F.col("_index") - F.col("_first") + 1
    step = lambda k: F.floor(F.col("_rate") * k + F.lit(0.5))
    copies = F.least(F.lit(int(most)), F.greatest(F.lit(0), step(place) - step(place - 1)))
    placed = numbered.join(first, "_key").join(rates, "_key")
    return placed.withColumn("_copies", copies.cast("long")).drop("_rate", "_index", "_first")


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` and ``copies`` for every row.

    Rates come from :func:`balance`; they become whole copies, at most ``most`` of a
    document. Rounding goes from large to small documents: what the tiers before have left
    open is balanced anew over the rest, and inside a tier documents are rounded in size
    order, so that a source misses its target by about half a document of its smallest
    tier. The rule is the same at every size.

    A null source is a source of its own, the last one. A null or blank text has size 0
    and takes nothing. Rows that repeat are rows of their own. An empty table gives an
    empty result. Other columns, whatever their names, are not read. Needs no random
    numbers, so reruns agree. The table of sources (one row each) is sorted in one task
    and broadcast when below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    key = F.coalesce(F.concat(F.lit("a"), F.col(source_col)), F.lit("b"))
    rows = stage(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), key.alias("_key"),
        word_count(F.col(text_col)).alias("_size")), "sizes")
    cells = stage(rows.groupBy("_key").agg(
        F.sum("_size").cast("double").alias("_tokens")), "cells")
    totals = cells.withColumnRenamed("_tokens", "_total")
    rates = balance(cells, source_targets(totals, weights, share, most))
    rows = rows.join(rates.select("_key", "_total", "_target"), "_key")
    tier = sum(
        (F.col("_size") * n <= F.col("_total")).cast("int") for n in TIERS)
    rows = stage(rows.withColumn("_tier", F.when(F.col("_size") > 0, tier).otherwise(len(TIERS))), "tiers")
    rest = rates.select("_key", F.col("_target").alias("_open"), F.col("_total").alias("_left"), "_rate")
    done = None
    for number in range(len(TIERS) + 1):
        part = rows.filter(F.col("_tier") == number)
        if number:
            # What rounding left open is balanced again over the documents that are left.
            open_ = F.greatest(F.lit(0.0), F.least(F.col("_open"), F.col("_left") * most))
            again = balance(
                rest.select("_key", F.col("_left").cast("double").alias("_tokens")),
                rest.select("_key", F.col("_left").alias("_total"), open_.alias("_target"), F.col("_rate").alias("_start")))
            rest = stage(rest.drop("_rate").join(again.select("_key", "_rate"), "_key"), "rates")
        rounded = stage(_round_tier(part, rest.select("_key", "_rate"), most), "rounded")
        done = rounded if done is None else done.unionByName(rounded)
        sums = rounded.groupBy("_key").agg(
            F.sum(F.col("_size") * F.col("_copies")).alias("_taken"), F.sum("_size").alias("_had"))
        rest = stage(rest.join(sums, "_key", "left").select(
            "_key", "_rate", (F.col("_open") - F.coalesce("_taken", F.lit(0))).alias("_open"),
            (F.col("_left") - F.coalesce("_had", F.lit(0))).alias("_left")), "open")
    return done.select(
        "doc_id", F.col("_size").alias("size"), F.col("_total").cast("long").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"),
        F.col("_copies").alias("copies"))


#: The same mix: sizes, water level, then three tiers of rounding.
def mixing_sql(docs: str = "documents", tail: str = "") -> str:
    """DuckDB SQL of the default mix; needs no Newton, as one margin has a closed form."""
    tier = lambda n, rate: f"""
r{n} AS (SELECT *, least(2, greatest(0, floor(rate * k + 0.5) - floor(rate * (k - 1) + 0.5)))::BIGINT copies FROM (
  SELECT t.*, {rate} AS rate, row_number() OVER (PARTITION BY t.key ORDER BY size, doc_id NULLS FIRST) k
  FROM tiers t JOIN open{n} USING (key) WHERE tier = {n})),
open{n + 1} AS (SELECT key, o.opened - coalesce(sum(size * copies), 0) opened, o.remains - coalesce(sum(size), 0) remains
  FROM open{n} o LEFT JOIN r{n} USING (key) GROUP BY key, o.opened, o.remains)"""  # noqa: E731
    again = "greatest(0.0, least(2.0, CASE WHEN remains > 0 THEN round(opened / remains, 12) ELSE 0 END))"
    return rf"""WITH sizes AS (SELECT doc_id, coalesce('a' || source, 'b') AS key,
  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT size FROM {docs}),
totals AS (SELECT key, sum(size)::DOUBLE total FROM sizes GROUP BY key),
weighed AS (SELECT *, 2 * total cap, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY key) - 1) % 3]::DOUBLE weight FROM totals),
levels AS (SELECT *, (sum(total) OVER () * 1.5 - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) lev
  FROM weighed WINDOW b AS (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT key, total, least(cap, coalesce(weight * max(CASE WHEN lev <= cap / weight THEN lev END) OVER (), cap)) target FROM levels),
tiers AS (SELECT s.*, total, target, CASE WHEN size > 0 THEN (size * 20 <= total)::INT + (size * 200 <= total)::INT ELSE 2 END tier
  FROM sizes s JOIN targets USING (key)),
open0 AS (SELECT key, target opened, total remains FROM targets),
{tier(0, "round(target / total, 12)")},{tier(1, again)},{tier(2, again)}
SELECT doc_id, size, total::BIGINT source_size, target, size * copies taken, copies
FROM (FROM r0 UNION ALL FROM r1 UNION ALL FROM r2){tail}"""
