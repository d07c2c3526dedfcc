"""Text normalisation as column expressions; Arrow is used for NFC and NFD only."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values --------------------------------------------------------
PUNCTUATION_MAP = {
    "，": ",",
    "。": ".",
    "、": ",",
    "„": '"',
    "”": '"',
    "“": '"',
    "«": '"',
    "»": '"',
    "１": '"',
    "」": '"',
    "「": '"',
    "《": '"',
    "》": '"',
    "´": "'",
    "∶": ":",
    "：": ":",
    "？": "?",
    "！": "!",
    "（": "(",
    "）": ")",
    "；": ";",
    "–": "-",
    "—": " - ",
    "．": ". ",
    "～": "~",
    "’": "'",
    "…": "...",
    "━": "-",
    "〈": "<",
    "〉": ">",
    "【": "[",
    "】": "]",
    "％": "%",
    "►": "-",
}
# Code points turned into a space; the line feed is not one of them.
SPACE_POINTS = (
    [0x20, 0x09]
    + list(range(0x2000, 0x200B))
    + [0xA0, 0x202F, 0x205F, 0x3000]
    + list(range(0x200B, 0x200E))
    + [0x2060, 0xFFFC, 0x84]
)
# Code points that Python's str.strip removes.
STRIP_POINTS = (
    list(range(0x09, 0x0E))
    + list(range(0x1C, 0x21))
    + [0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
LIGATURES = {
    "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "ſt", "ﬆ": "st",
    "Ĳ": "IJ", "ĳ": "ij", "ŉ": "ʼn", "Ǆ": "DŽ", "ǅ": "Dž", "ǆ": "dž",
    "Ǉ": "LJ", "ǈ": "Lj", "ǉ": "lj", "Ǌ": "NJ", "ǋ": "Nj", "ǌ": "nj",
    "Ǳ": "DZ", "ǲ": "Dz", "ǳ": "dz",
}
# ---- end of fixed values -------------------------------------------------

SPACE_CHARS = "".join(map(chr, SPACE_POINTS))
STRIP_CHARS = "".join(map(chr, STRIP_POINTS))
FULLWIDTH_CHARS = "".join(map(chr, range(0xFF01, 0xFF5F)))
HALFWIDTH_CHARS = "".join(map(chr, range(0x21, 0x7F)))


def _col(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def replace_characters(text: Column | str, mapping: dict[str, str]) -> Column:
    """Replace single characters; values may have any length.

    A multi-character value must not contain a key of the mapping.
    """
    out = _col(text)
    single = {k: v for k, v in mapping.items() if len(v) == 1}
    for key, value in mapping.items():
        if len(value) != 1:
            out = F.replace(out, F.lit(key), F.lit(value))
    if single:
        out = F.translate(out, "".join(single), "".join(single.values()))
    return out


def is_ascii(text: Column | str) -> Column:
    """Whether every character takes one byte; far cheaper than a pattern."""
    return F.octet_length(_col(text)) == F.length(_col(text))


def unify_punctuation(text: Column | str) -> Column:
    """Map 34 typographic and East Asian punctuation marks to ASCII."""
    # Bound once, because the text may be a long expression.
    return F.transform(
        F.array(_col(text)),
        lambda t: F.when(is_ascii(t), t).otherwise(replace_characters(t, PUNCTUATION_MAP)),
    )[0]


def delete_unicode_punctuation(text: Column | str) -> Column:
    """Delete the marks that :func:`unify_punctuation` maps."""
    return F.translate(_col(text), "".join(PUNCTUATION_MAP), "")


def unify_whitespace(text: Column | str) -> Column:
    """Turn 23 blank code points into a plain space; line feeds stay."""
    return F.translate(_col(text), SPACE_CHARS, " " * len(SPACE_CHARS))


def collapse_punctuation(text: Column | str) -> Column:
    """Keep one of several equal punctuation characters in a row."""
    return F.regexp_replace(_col(text), r"(\p{P})\1+", "$1")


def strip(text: Column | str) -> Column:
    """Strip every kind of white space at both ends."""
    return F.trim(_col(text), F.lit(STRIP_CHARS))


def punctuation_ratio(text: Column | str) -> Column:
    """Share of punctuation characters; null for empty text."""
    text = _col(text)
    return F.try_divide(F.regexp_count(text, F.lit(r"\p{P}")).cast("double"), F.length(text))


@F.pandas_udf(T.StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


@F.pandas_udf(T.StringType())
def _nfd(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFD", t), na_action="ignore")


def _normal_form(source: Column, ready: Column, udf, changes: Column) -> Column:
    # Only rows whose source has characters that the form may change go to Python.
    return F.when(changes, udf(F.when(changes, ready))).otherwise(ready)


# Marks, conjoining letters and the blocks whose characters have another composed form.
NOT_ALWAYS_NFC = (
    r"[[^\x00-\x{2ff}]&&[\p{M}\x{374}\x{37e}\x{387}\x{958}-\x{95f}\x{9dc}-\x{9df}\x{a33}-\x{a5e}\x{b5c}\x{b5d}"
    r"\x{f43}-\x{f69}\x{1100}-\x{11ff}\x{1f70}-\x{1fff}\x{2000}\x{2001}\x{2126}-\x{212b}"
    r"\x{2329}\x{232a}\x{2adc}\x{f900}-\x{faff}\x{fb1d}-\x{fb4f}\x{1d15e}-\x{1d1c0}"
    r"\x{2f800}-\x{2fa1f}]]"
)


def _may_change_nfc(source: Column) -> Column:
    # Cheap tests first; the last one is a long class.
    return ~is_ascii(source) & source.rlike(r"[^\x00-\x{2ff}]") & source.rlike(NOT_ALWAYS_NFC)


def to_nfc(text: Column | str) -> Column:
    """Unicode normal form C."""
    return _normal_form(_col(text), _col(text), _nfc, _may_change_nfc(_col(text)))


def strip_accents(text: Column | str) -> Column:
    """Normal form D without combining marks; ASCII text stays in the JVM."""
    text = _col(text)
    plain = _normal_form(text, text, _nfd, ~is_ascii(text))
    return F.when(is_ascii(text), text).otherwise(F.regexp_replace(plain, r"\p{Mn}", ""))


def fix_text(text: Column | str) -> Column:
    """Unify line ends, widths, quotes and ligatures, drop control characters, apply NFC."""
    source = _col(text)
    # Every pattern begins with one class, and what a text rarely needs is behind a test.
    line_ends = F.when(F.contains(source, F.lit("\r")), F.regexp_replace(source, r"\r\n?", "\n")).otherwise(source)
    ascii_only = F.regexp_replace(line_ends, r"[\p{Cntrl}&&[^\t\n\f\r]]", "")
    out = F.regexp_replace(source, r"[\r\x85\x{2028}\x{2029}](?:(?<=\r)\n)?", "\n")
    out = F.when(source.rlike(r"[\x{2018}-\x{201f}\x{3000}\x{ff01}-\x{ff5e}]"), F.translate(
        out,
        FULLWIDTH_CHARS + chr(0x3000) + "‘’‚‛“”„‟",
        HALFWIDTH_CHARS + " " + "'" * 4 + '"' * 4,
    )).otherwise(out)
    ligatures = r"[[^\x00-\x{131}]&&[" + "".join(LIGATURES) + "]]"
    out = F.when(source.rlike(ligatures), replace_characters(out, LIGATURES)).otherwise(out)
    controls = r"[[\p{Cntrl}&&[^\t\n\f\r]][[^\x00-\x{2069}]&&[\x{206a}-\x{206f}\x{feff}\x{fff9}-\x{fffb}]]]"
    full = _normal_form(
        source, F.regexp_replace(out, controls, ""), _nfc, _may_change_nfc(source)
    )
    return F.when(is_ascii(source), ascii_only).otherwise(full)


def digits_to_zero(text: Column | str) -> Column:
    """Every decimal digit of any script becomes ``0``."""
    return F.regexp_replace(_col(text), r"\p{Nd}", "0")


def remove_control_characters(text: Column | str) -> Column:
    """Delete U+0000-001F and U+007F-009F, line feeds included."""
    return F.regexp_replace(_col(text), r"[\x00-\x1f\x7f-\x9f]", "")


def normalize_for_lm(
    text: Column | str,
    accent: bool = False,
    case: bool = False,
    numbers: bool = True,
    punctuation: int = 1,
) -> Column:
    """Normal form scored by the language model (``accent`` and ``case`` remove, not keep)."""
    out = strip(text)
    if case:
        out = F.lower(out)
    if accent:
        out = strip_accents(out)
    if numbers:
        out = digits_to_zero(out)
    if punctuation == 1:
        out = unify_punctuation(out)
    elif punctuation == 2:
        out = delete_unicode_punctuation(out)
    return remove_control_characters(out)


def normalize_for_dedup(text: Column | str) -> Column:
    """Lower-case, digits to ``0``, no punctuation, symbols, control or unassigned characters."""
    out = digits_to_zero(F.lower(strip(text)))
    return F.regexp_replace(out, r"[\p{P}\p{C}\p{S}]+", "")


def letters_only(text: Column | str) -> Column:
    """Remove white space, digits and the 32 ASCII punctuation characters."""
    # White space as Python's ``\s`` has it: U+001C-001F count, too.
    return F.regexp_replace(
        _col(text), r"(?U)\s+|[\x1c-\x1f]+|\p{Nd}+|[!-/:-@\[-`{-~]+", ""
    )


def text_hash(text: Column | str, algorithm: str = "md5") -> Column:
    """Hex digest of the stripped text; null counts as empty."""
    body = strip(F.coalesce(_col(text), F.lit("")))
    if algorithm == "md5":
        return F.md5(body)
    if algorithm == "sha1":
        return F.sha1(body)
    if algorithm in ("sha256", "sha384", "sha512"):
        return F.sha2(body, int(algorithm[3:]))
    raise ValueError(f"unknown hash: {algorithm}")
