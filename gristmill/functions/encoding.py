"""Repair of texts that were decoded with the wrong character set.

UTF-8 bytes read as Latin-1 or Windows-1252 show every character beyond ASCII as two to
four others. A line that can only be such bytes is encoded and decoded back by native
expressions; a model of neighbouring bytes, learned from the corpus, decides whether the
repaired line is more like the corpus than the line itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values --------------------------------------------------------
# The characters of Windows-1252 at 0x80 to 0x9F, and their bytes.
WINDOWS = {
    "€": 0x80, "‚": 0x82, "ƒ": 0x83, "„": 0x84, "…": 0x85, "†": 0x86, "‡": 0x87, "ˆ": 0x88, "‰": 0x89,
    "Š": 0x8A, "‹": 0x8B, "Œ": 0x8C, "Ž": 0x8E, "‘": 0x91, "’": 0x92, "“": 0x93, "”": 0x94, "•": 0x95,
    "–": 0x96, "—": 0x97, "˜": 0x98, "™": 0x99, "š": 0x9A, "›": 0x9B, "œ": 0x9C, "ž": 0x9E, "Ÿ": 0x9F,
}
# UTF-8 sequences of two, three and four bytes, each byte as the character of the same number.
SEQUENCE = r"[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}"
# ---- end of fixed values -------------------------------------------------

# A text may have been decoded wrongly this many times.
ROUNDS = 2


def _bytes_as_characters(line: Column) -> Column:
    return F.translate(line, "".join(WINDOWS), "".join(map(chr, WINDOWS.values())))


def decoded_again(line: Column) -> Column:
    """The line whose UTF-8 bytes this line shows as characters; null when it shows none.

    All characters beyond ASCII must be part of a whole sequence, and there must be one.
    """
    shown = _bytes_as_characters(line)
    rest = F.regexp_replace(shown, SEQUENCE, "")
    able = (F.length(rest) < F.length(shown)) & (F.octet_length(rest) == F.length(rest))
    # Over-long forms and surrogates pass the pattern, so decoding may still fail.
    repaired = F.try_validate_utf8(F.encode(F.when(able, shown), "ISO-8859-1").cast("string"))
    return repaired


def byte_pairs(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each byte follows each byte in all texts, 65,536 numbers."""
    def count(batches):
        for batch in batches:
            total = np.zeros(65536, np.int64)
            for text in batch["text"]:
                data = np.frombuffer((text or "").encode(), np.uint8).astype(np.int64)
                total += np.bincount(data[:-1] << 8 | data[1:], minlength=65536) if len(data) > 1 else 0
            some = np.flatnonzero(total)
            yield pd.DataFrame({"pair": some, "n": total[some]})

    rows = df.select(F.col(text_col).alias("text")).mapInPandas(count, "pair long, n long")
    out = np.zeros(65536, np.int64)
    for pair, n in rows.groupBy("pair").agg(F.sum("n")).collect():
        out[pair] = n
    return out


def pair_costs(counts: np.ndarray) -> np.ndarray:
    """Bits that each byte costs after each byte, add-one smoothed."""
    table = counts.reshape(256, 256) + 1.0
    return -np.log2(table / table.sum(axis=1, keepdims=True))


def repair_encoding(df: DataFrame, costs: np.ndarray | None = None, text_col: str = "text") -> DataFrame:
    """Texts with their wrongly decoded lines repaired; the others stay as they are.

    ``costs`` come from :func:`pair_costs`, by default of these texts. A line is repaired
    when the repaired line costs fewer bits in all, up to ``ROUNDS`` times. Only texts
    with a line that may be repaired go to Python.
    """
    if costs is None:
        costs = pair_costs(byte_pairs(df, text_col))
    held = df.sparkSession.sparkContext.broadcast(costs)

    @F.pandas_udf("string")
    def choose(lines: pd.Series, repaired: pd.Series) -> pd.Series:
        table = held.value

        def cost(line: str) -> float:
            data = np.frombuffer(line.encode(), np.uint8)
            return float(table[data[:-1], data[1:]].sum()) if len(data) > 1 else 0.0

        def one(old, new) -> str | None:
            if old is None or new is None:
                return None
            return "\n".join(b if b is not None and cost(b) < cost(a) else a for a, b in zip(old, new))

        return pd.Series([one(o, n) for o, n in zip(lines, repaired)], dtype=object)

    out = df
    for _ in range(ROUNDS):
        # A sequence begins with one of these characters; most texts have none of them.
        text = F.col(text_col)
        lines = F.split(text, "\n", -1)
        maybe = F.coalesce(_bytes_as_characters(text).rlike(SEQUENCE), F.lit(False))
        wanted = F.when(maybe, lines)
        new = F.transform(wanted, decoded_again)
        out = out.withColumn(text_col, F.when(maybe, choose(wanted, new)).otherwise(text))
    return out.select(df.columns)
