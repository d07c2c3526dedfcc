"""Personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import patterns as pt
from gristmill.operators import pii
from gristmill.queries.common import quote, table

# The SQL engine has no look-around, so boundaries are consumed there.
_EMAIL = (
    r"(?m)(?:^|[\x08\s@,?!;:)('\".\p{Han}<])"
    r"([^\x08\s@?!;,:)('\"<]+@[^\x08\s@!?;,/]*[^\x08\s@?!;,/:)('\">.]\.\p{L}[\p{L}\p{N}_]+)"
    r"(?:$|[\x08\s@,?!;:)('\".\p{Han}>])"
)
_USER = r"(?m)(?:^|[)(\s@,?!;:'\"\p{Han}])(@[^)(\s@,?!;:'\"]{3,})"
_IP = f"(?m){pt.OPENING}({pt.IPV4}|{pt.IPV6}){pt.CLOSING_IP}"
_KEY = f"(?m){pt.OPENING}{pt.KEY_BODY}{pt.CLOSING_KEY}"
_ID = (
    f"(?m){pt.OPENING}"
    r"([A-Za-z]*(?:[\p{Pd}]*\p{Nd}){6,})" + pt.OPENING.replace("^", "$")
)
_DATE = "|".join(f"^{pt.DATE_OPENING}{d}{pt.DATE_CLOSING}" for d in pt.DATES)


def _all(pattern: str, group: int = 1) -> str:
    return f"regexp_extract_all(text, {quote(pattern)}, {group})"


_ADDRESSES = (
    f"list_filter({_all(_IP)}, lambda v: regexp_matches(v, '[0-9]') "
    f"AND NOT regexp_matches(v, {quote(_DATE)}))"
)
_IDS = f"list_filter({_all(_ID)}, lambda v: NOT regexp_matches(v, {quote(_DATE)}))"
_SQL_VALUES = {
    "EMAIL": _all(_EMAIL),
    "USER": _all(_USER),
    "IP_ADDRESS": _ADDRESSES,
    "KEY": _all(_KEY),
    "ID": _IDS,
    "IPv4": _all(f"({pt.IPV4})"),
    "IPv6": _all(f"({pt.IPV6})"),
}


def _rows(values: str, source: str = "documents") -> str:
    return (
        f"WITH found AS (SELECT doc_id, {values} AS hits FROM {source}) "
        "SELECT doc_id, (generate_subscripts(hits, 1) - 1)::BIGINT AS n, unnest(hits) AS value "
        "FROM found WHERE len(hits) > 0"
    )


# The tables have no user names and no IPv6 addresses, so these are written into the texts.
_WRITTEN_IN = {
    "USER": {" the ": " @thefirst ", "la ": "(@la ", "und ": "und,@und_und "},
    "IPv6": {", ": " :: ", " the ": " fe80::1%eth0 ", " und ": " 2001:db8::a:1 ", "la ": "abcd::\n"},
}


def _documents(spark, folder, tag: str = "") -> DataFrame:
    text = F.col("text")
    for old, new in _WRITTEN_IN.get(tag, {}).items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return table(spark, folder, "documents").withColumn("text", text)


def _documents_sql(tag: str) -> str:
    text = "text"
    for old, new in _WRITTEN_IN[tag].items():
        text = f"replace({text}, {quote(old)}, {quote(new)})"
    return f"(SELECT doc_id, {text} AS text FROM documents)"


def _detect(tag: str, written_in: str = ""):
    def query(spark, folder) -> DataFrame:
        docs = _documents(spark, folder, written_in)
        hits = docs.select("doc_id", F.posexplode(pii.detect("text", tag)).alias("n", "hit"))
        return hits.select("doc_id", F.col("n").cast("bigint").alias("n"), "hit.value")

    return query


_TAGGED = "list_concat(" * 3 + (
    "list_transform({EMAIL}, lambda v: 'EMAIL|' || v), "
    "list_transform({IP_ADDRESS}, lambda v: 'IP_ADDRESS|' || v)), "
    "list_transform({KEY}, lambda v: 'KEY|' || v)), "
    "list_transform({USER}, lambda v: 'USER|' || v))"
).format(**_SQL_VALUES)


def _detect_all(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    hits = docs.select("doc_id", F.posexplode(pii.detect_pii("text")).alias("n", "hit"))
    value = F.concat_ws("|", "hit.tag", "hit.value")
    return hits.select("doc_id", F.col("n").cast("bigint").alias("n"), value.alias("value"))


def _spans(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    hits = docs.select(
        "doc_id", "text", F.explode(pii.detect_pii("text", F.col("lang"))).alias("hit"))
    return hits.select(
        "doc_id", "hit.tag", "hit.value", "hit.start", "hit.end", "hit.lang",
        F.substring("text", F.col("hit.start") + 1, F.col("hit.end") - F.col("hit.start"))
        .alias("whole"),
    )


_REDACTED = (
    "list_reduce(list_prepend(text, tagged), lambda t, h: replace(t, "
    "substr(h, strpos(h, '|') + 1), 'PI:' || split_part(h, '|', 1)))"
)
_REDACT_SQL = f"WITH found AS (SELECT *, {_TAGGED} AS tagged FROM documents) "


def _redact(spark, folder) -> DataFrame:
    return pii.run_pii(table(spark, folder, "documents")).select("doc_id", "text", "lang", "source")


def _audit(spark, folder) -> DataFrame:
    audited = pii.run_pii(table(spark, folder, "documents"), audit=True)
    return audited.select(
        "doc_id", "old_text", "text", F.col("modified").cast("bigint").alias("modified"),
        F.size("regex_metadata").cast("bigint").alias("hits"),
    )


def _modified(spark, folder) -> DataFrame:
    audited = pii.run_pii(table(spark, folder, "documents"), audit=True)
    return pii.modified_rows(audited).select("doc_id", "old_text", "text")


QUERIES = {
    "p01_detect_email": (_detect("EMAIL"), _rows(_SQL_VALUES["EMAIL"])),
    "p02_detect_user": (
        _detect("USER", "USER"), _rows(_SQL_VALUES["USER"], _documents_sql("USER"))),
    "p03_detect_ip_address": (_detect("IP_ADDRESS"), _rows(_SQL_VALUES["IP_ADDRESS"])),
    "p04_detect_key": (_detect("KEY"), _rows(_SQL_VALUES["KEY"])),
    "p05_detect_id": (_detect("ID"), _rows(_SQL_VALUES["ID"])),
    "p06_detect_ipv4": (_detect("IPv4"), _rows(_SQL_VALUES["IPv4"])),
    "p03_detect_ipv6_address": (
        _detect("IP_ADDRESS", "IPv6"), _rows(_SQL_VALUES["IP_ADDRESS"], _documents_sql("IPv6"))),
    "p06_detect_ipv6": (
        _detect("IPv6", "IPv6"), _rows(_SQL_VALUES["IPv6"], _documents_sql("IPv6"))),
    "p09_detect_pii": (_detect_all, _rows(_TAGGED)),
    "p10_match_spans": (_spans, None),
    "p11_redact_pii": (
        _redact, _REDACT_SQL + f"SELECT doc_id, {_REDACTED} AS text, lang, source FROM found"),
    "p12_run_pii_audit": (
        _audit,
        _REDACT_SQL + f"SELECT doc_id, text AS old_text, {_REDACTED} AS text, "
        "(len(tagged) > 0)::BIGINT AS modified, len(tagged)::BIGINT AS hits FROM found"),
    "p13_modified_rows": (
        _modified,
        _REDACT_SQL + f"SELECT doc_id, text AS old_text, {_REDACTED} AS text FROM found "
        "WHERE len(tagged) > 0"),
}


def _date_screen(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    words = docs.select("doc_id", F.explode(F.regexp_extract_all(
        "text", F.lit(r"[0-9][^\s]*"), F.lit(0))).alias("value"))
    return words.select("doc_id", "value",
                        pii.looks_like_date(F.col("value")).cast("bigint").alias("is_date"))


def _digit_screen(spark, folder) -> DataFrame:
    hits = _documents(spark, folder, "IPv6").select(
        "doc_id", F.explode(pii.detect("text", "IPv6")).alias("hit"))
    return hits.select("doc_id", "hit.value",
                       F.col("hit.value").rlike(r"(?U)\d").cast("bigint").alias("has_digit"))


QUERIES["p07_ip_digit_screen"] = (
    _digit_screen,
    f"WITH found AS (SELECT doc_id, unnest({_SQL_VALUES['IPv6']}) AS value "
    f"FROM {_documents_sql('IPv6')}) "
    "SELECT doc_id, value, regexp_matches(value, '[0-9]')::BIGINT AS has_digit FROM found",
)
QUERIES["p08_date_screen"] = (
    _date_screen,
    r"WITH found AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9][^\s]*')) AS value "
    f"FROM documents) SELECT doc_id, value, regexp_matches(value, {quote(_DATE)})::BIGINT "
    "AS is_date FROM found",
)
