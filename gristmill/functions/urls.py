"""URL keys for exact de-duplication."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values --------------------------------------------------------
QUERY_PARAMETERS = {"id": "id", "news-id": "id"}
# ---- end of fixed values -------------------------------------------------


def _col(url: Column | str) -> Column:
    return F.col(url) if isinstance(url, str) else url


def without_query(url: Column | str) -> Column:
    """Everything before the first ``?`` that is not the first character."""
    return F.regexp_extract(_col(url), r"^(.[^?]*)", 1)


def without_amp(url: Column | str) -> Column:
    """Path segments up to the first ``?`` or the first segment that starts with ``amp``."""
    return F.regexp_extract(_col(url), r"^([^?]*?)(?:/amp|\?|\z)", 1)


def _decode(part: Column) -> Column:
    # A percent sign that does not start a code stands for itself.
    kept = F.regexp_replace(part, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(kept)


def _encode(part: Column) -> Column:
    # The JVM keeps ``*`` and encodes ``~``; URLs here do the opposite.
    return F.replace(F.replace(F.url_encode(part), F.lit("*"), F.lit("%2A")),
                     F.lit("%7E"), F.lit("~"))


def with_query_parameters(url: Column | str, renames: dict[str, str] | None = None) -> Column:
    """Keep and rename the listed query parameters, drop the others and blank values."""
    url = _col(url)
    scheme = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*:", 0)
    base = F.concat(
        F.lower(scheme),
        F.regexp_extract(url, r"(?s)^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?([^?#]*)", 1),
    )
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"(?s)^[^#]*(#.+)", 1)
    kept = F.lit("")
    if renames:
        names = F.create_map(*[F.lit(item) for pair in renames.items() for item in pair])
        pairs = F.transform(
            F.split(query, "&"),
            lambda p: F.struct(
                _decode(F.substring_index(p, "=", 1)).alias("key"),
                F.when(p.contains("="), F.regexp_extract(p, r"(?s)=(.*)", 1))
                .otherwise(F.lit("")).alias("value"),
            ),
        )
        wanted = F.filter(pairs, lambda p: F.map_contains_key(names, p["key"])
                          & (p["value"] != ""))
        kept = F.array_join(
            F.transform(
                wanted,
                lambda p: F.concat(
                    _encode(F.element_at(names, p["key"])), F.lit("="),
                    _encode(_decode(p["value"])),
                ),
            ),
            "&",
        )
    return F.concat(base, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""), fragment)
