"""Sub-word units of a public tokenizer file, for cutting texts and for language models.

The file is read on the driver and sent with the job; nothing is trained. Texts are
encoded in Arrow batches by the ``tokenizers`` library, a part of a batch at a time.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions import text as tx
from gristmill.functions.batches import joined, parts

# Bytes of text that are encoded together; an encoding takes some hundred bytes a unit.
ENCODED_BYTES = 1 << 18

_loaded: dict[str, object] = {}


def _tokenizer(settings: str):
    # One per worker process.
    from tokenizers import Tokenizer

    if settings not in _loaded:
        _loaded.clear()
        _loaded[settings] = Tokenizer.from_str(settings)
    return _loaded[settings]


def _settings(tokenizer_file: str) -> str:
    with open(tokenizer_file, encoding="utf-8") as file:
        return file.read()


def _encoded(settings: str, texts: pa.Array) -> pa.Array:
    """The units of each text; encodings and their strings are held for one part of the texts at a time."""
    kind = pa.list_(pa.string())

    def of_part(part: pa.Array) -> pa.Array:
        found = _tokenizer(settings).encode_batch(part.to_pylist(), add_special_tokens=False)
        # A blank would part the units of an n-gram.
        return pa.array([[t.replace(" ", "▁") for t in e.tokens] for e in found], kind)

    return joined([of_part(part) for part in parts(texts, ENCODED_BYTES)], kind)


def units(tokenizer_file: str) -> Callable[[Column | str], Column]:
    """A function of a text column that gives its units, normalised as language models do."""
    settings = _settings(tokenizer_file)

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def encode(texts: pa.Array) -> pa.Array:
        return _encoded(settings, texts)

    def of(text: Column | str) -> Column:
        text = F.col(text) if isinstance(text, str) else text
        return encode(tx.strip(tx.normalize_for_lm(F.coalesce(text, F.lit("")))))

    return of


def truncate_units(text: Column | str, tokenizer_file: str, max_units: int = 1000) -> Column:
    """The first units of a longer text, stripped; a shorter one is unchanged.

    Units of a part of a character are left out at the end, so the result is a prefix of
    the stripped text.
    """
    text = F.col(text) if isinstance(text, str) else text
    settings = _settings(tokenizer_file)

    @F.pandas_udf(T.StringType())
    def cut(texts: pd.Series) -> pd.Series:
        def one(source: str) -> str:
            body = source.strip()
            spans = _tokenizer(settings).encode(body, add_special_tokens=False).offsets
            if len(spans) <= max_units:
                return source
            keep = max_units
            while keep and spans[keep - 1][1] > spans[keep][0]:
                keep -= 1
            return body[:spans[keep - 1][1]] if keep else ""

        return texts.map(one, na_action="ignore")

    # A text has no more units than bytes.
    longer = F.octet_length(text) > max_units
    return F.when(longer, cut(F.when(longer, text))).otherwise(text)
