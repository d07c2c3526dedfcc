"""Detection and redaction of personal data.

Email, user, address and id patterns run in the JVM, each behind a cheap test of a
character that every hit must have. The key pattern repeats a group, which the JVM
matcher evaluates by recursion, so keys are found on Arrow batches in Python, in linear
time; only texts that pass a necessary condition are sent there.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions import patterns as pt
from gristmill.functions.patterns import key_hits
from gristmill.operators.plumbing import sample_rows

# The reference order of tags is not defined; this one is fixed, because overlapping
# values are replaced in it.
DEFAULT_TAGS = ("EMAIL", "IP_ADDRESS", "KEY", "USER")
ALL_TAGS = (*DEFAULT_TAGS, "ID", "IPv4", "IPv6")
# What every address begins with, so that the many alternatives are tried at few places.
_IPV4_AHEAD = r"(?=[0-9]{1,3}+\.)"
_IPV6_AHEAD = r"(?=[0-9a-fA-F]{0,4}+:)"
_ADDRESS_AHEAD = r"(?=[0-9]{1,3}+\.|[0-9a-fA-F]{0,4}+:)"
_PATTERNS = {
    "EMAIL": pt.for_jvm(pt.EMAIL_LINEAR),
    "USER": pt.for_jvm(pt.USER),
    "IP_ADDRESS": pt.for_jvm(f"{pt.OPENING}{_ADDRESS_AHEAD}({pt.IPV4}|{pt.IPV6}){pt.CLOSING_IP}"),
    "ID": pt.for_jvm(pt.OPENING + pt.ID_BODY + pt.OPENING.replace("^", "$")),
    "IPv4": f"{_IPV4_AHEAD}({pt.IPV4})",
    "IPv6": f"{_IPV6_AHEAD}({pt.IPV6})",
}
_NEEDED = {
    "EMAIL": r"@",
    "USER": r"@",
    "IP_ADDRESS": r"[.:](?:(?<=[0-9]\.)[0-9]|(?<=:):|(?<=[0-9a-fA-F]:)[0-9a-fA-F]|(?<=fe80:))",
    "ID": r"(?U)\d",
    "IPv4": r"[0-9]\.[0-9]",
    "IPv6": r":(?::|(?<=[0-9a-fA-F]:)[0-9a-fA-F]|(?<=fe80:))",
}
# Four groups of letters and symbols have such a run of runs; three groups with
# digits have a digit before four more characters of the class.
_KEY_NEEDED = (
    r"(?U)[A-Za-z][\p{Nd}\p{Pd}/+=:_]+[A-Za-z]+[\p{Nd}\p{Pd}/+=:_]"
    r"|\p{Nd}[A-Z\p{Nd}\p{Pd} ]{4}"
)
_DATE = "|".join(pt.for_jvm(f"^{pt.DATE_OPENING}{d}{pt.DATE_CLOSING}", False) for d in pt.DATES)


_FOUND = T.ArrayType(
    T.StructType()
    .add("value", T.StringType())
    .add("start", T.IntegerType())
    .add("end", T.IntegerType())
)


@F.pandas_udf(_FOUND)
def _key_hits(texts: pd.Series) -> pd.Series:
    def one(text: str | None) -> list[dict]:
        if text is None:
            return []
        return [{"value": v, "start": s, "end": e} for v, s, e in key_hits(text)]

    return texts.map(one)


def _native_hits(text: Column, tag: str) -> Column:
    pattern = F.lit(_PATTERNS[tag])
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    # These have no boundaries, so the match is the value.
    values = whole if tag in ("IPv4", "IPv6") else F.regexp_extract_all(text, pattern, F.lit(1))
    gaps = F.split(text, _PATTERNS[tag], -1)
    rows = F.arrays_zip(
        whole.alias("whole"), values.alias("value"), F.slice(gaps, 1, F.size(whole)).alias("gap")
    )
    empty = F.struct(
        F.lit(0).alias("at"),
        F.array().cast(_FOUND).alias("hits"),
    )

    def step(state: Column, row: Column) -> Column:
        start = state["at"] + F.length(row["gap"])
        end = start + F.length(row["whole"])
        if tag == "EMAIL":  # nothing but the value, whatever was passed over before it
            start = end - F.length(row["value"])
        hit = F.struct(row["value"].alias("value"), start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.array_append(state["hits"], hit).alias("hits"))

    found = F.aggregate(rows, empty, step, lambda state: state["hits"])
    return F.when(text.rlike(_NEEDED[tag]), found).otherwise(empty["hits"])


def looks_like_date(value: Column) -> Column:
    """Whether a value starts with a year range, a date or a month."""
    return value.rlike(_DATE)


def detect(text: Column | str, tag: str, lang: Column | None = None) -> Column:
    """Hits of one tag, left to right: ``array<struct<tag,value,start,end,lang>>``.

    Addresses must hold a digit; addresses and ids that start like a date are
    screened out. Spans cover the whole match with its boundaries.
    """
    text = F.col(text) if isinstance(text, str) else text
    if tag == "KEY":
        hits = _key_hits(F.when(text.rlike(_KEY_NEEDED), text))
    elif tag in _PATTERNS:
        hits = _native_hits(text, tag)
    else:
        raise ValueError(f"unknown tag: {tag}")

    def keep(hit: Column) -> Column:
        kept = hit["value"] != ""
        if tag == "IP_ADDRESS":
            kept = kept & hit["value"].rlike(r"(?U)\d")
        if tag in ("IP_ADDRESS", "ID"):
            kept = kept & ~looks_like_date(hit["value"])
        return kept

    language = F.lit(None).cast("string") if lang is None else lang
    return F.transform(
        F.filter(F.coalesce(hits, F.array().cast(_FOUND)),
                 keep),
        lambda h: F.struct(
            F.lit(tag).alias("tag"), h["value"].alias("value"), h["start"].alias("start"),
            h["end"].alias("end"), language.alias("lang"),
        ),
    )


def detect_pii(
    text: Column | str, lang: Column | None = None, tags: tuple[str, ...] = DEFAULT_TAGS
) -> Column:
    """Hits of all tags, in the order of ``tags``."""
    return F.concat(*[detect(text, tag, lang) for tag in tags])


def redact_pii(text: Column | str, hits: Column) -> Column:
    """Replace every occurrence of each value by ``PI:<TAG>``, in the order of the first hits."""
    text = F.col(text) if isinstance(text, str) else text
    once = F.array_distinct(
        F.transform(hits, lambda h: F.struct(h["tag"].alias("tag"), h["value"].alias("value"))))
    return F.aggregate(
        once, text,
        lambda t, hit: F.replace(t, hit["value"], F.concat(F.lit("PI:"), hit["tag"])),
    )


def run_pii(
    df: DataFrame,
    text_col: str = "text",
    lang: Column | None = None,
    tags: tuple[str, ...] = DEFAULT_TAGS,
    audit: bool = False,
) -> DataFrame:
    """Redact a text column; ``audit`` adds ``regex_metadata``, ``old_text`` and ``modified``."""
    found = df.withColumn("regex_metadata", detect_pii(text_col, lang, tags))
    # As the only element of an array the redacted text is made once; a plain column would be
    # made again by every later filter and for each use in an expression.
    once = F.array(redact_pii(text_col, F.col("regex_metadata")))
    out = (
        found.select("*", F.explode(once).alias("_redacted"))
        .withColumn("old_text", F.col(text_col))
        .withColumn("modified", F.size("regex_metadata") > 0)
        .withColumn(text_col, F.col("_redacted"))
        .drop("_redacted")
    )
    return out if audit else out.drop("regex_metadata", "old_text", "modified")


def modified_rows(
    audited: DataFrame, n: int | None = None, id_col: str = "doc_id", seed: int = 1234
) -> DataFrame:
    """The redacted rows of an audited table, all of them or ``n`` random ones."""
    # A filter would be pushed below the detection and run it a second time.
    once = F.when(F.col("modified"), F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    changed = audited.select("*", F.explode(once).alias("_changed")).drop("_changed")
    return changed if n is None else sample_rows(changed, n, id_col, seed)
