"""Tokens, n-grams, SHA-1 integers, MinHash signatures and Jaccard similarity."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha1

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.batches import joined, parts

# ---- fixed values --------------------------------------------------------
PERMUTATION_SEED = 42
MERSENNE_PRIME = (1 << 61) - 1
MAX_HASH = (1 << 32) - 1
# ---- end of fixed values -------------------------------------------------

_BLOCK = 1 << 12


def ascii_tokens(text: Column | str) -> Column:
    """Split at each character outside ``[A-Za-z_0-9]``; empty tokens stay.

    Without the Unicode flag ``\\W`` is that class, and far faster than writing it out.
    """
    return F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")),
                   r"\W", -1)


def unicode_tokens(text: Column | str) -> Column:
    """Letter and digit runs of any script, Han characters one by one."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(
        F.coalesce(text, F.lit("")), F.lit(r"(?U)\p{IsHan}|(?:(?!\p{IsHan})\w)+"), F.lit(0)
    )


def _with(value: Column, body) -> Column:
    # Binds ``value`` once; inside a lambda it would be computed per element.
    return F.transform(F.array(value), body)[0]


def ngrams(tokens: Column, n: int = 5, min_length: int = 5, separator: str = " ") -> Column:
    """Joined n-grams: none below ``min_length`` tokens, one of all tokens below ``n``."""

    def slide(words: Column) -> Column:
        size = F.size(words)
        joined = F.transform(
            F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1))),
            lambda i: F.array_join(F.slice(words, i, n), separator),
        )
        return F.when(size >= min_length, joined).otherwise(F.array().cast("array<string>"))

    return _with(tokens, slide)


def shingles(tokens: Column, n: int = 5, min_length: int = 5) -> Column:
    """Distinct n-grams."""
    return F.array_distinct(ngrams(tokens, n, min_length))


def characters(text: Column | str) -> Column:
    """Array of single characters."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(text, ""), lambda c: c != "")


def sha1_integer(data: Column, bits: int = 32) -> Column:
    """First ``bits`` of SHA-1 as a little-endian integer: bigint (32) or decimal (64)."""
    if bits not in (32, 64):
        raise ValueError("32 or 64 bits")
    digest = F.sha1(data)
    swapped = F.concat(*[F.substring(digest, i, 2) for i in range(bits // 4 - 1, 0, -2)])
    return F.conv(swapped, 16, 10).cast("bigint" if bits == 32 else "decimal(20,0)")


@cache
def permutations(num_perm: int) -> tuple[tuple[int, int], ...]:
    """Coefficient pairs ``(a, b)`` of the hash permutations."""
    rng = np.random.RandomState(PERMUTATION_SEED)
    return tuple(
        (
            int(rng.randint(1, MERSENNE_PRIME, dtype=np.uint64)),
            int(rng.randint(0, MERSENNE_PRIME, dtype=np.uint64)),
        )
        for _ in range(num_perm)
    )


def spaced_tokens(text: Column | str, tokenizer: str = "ascii") -> Column:
    """The tokens joined by single spaces."""
    text = F.col(text) if isinstance(text, str) else text
    if tokenizer == "ascii":
        return F.regexp_replace(F.coalesce(text, F.lit("")), r"\W", " ")
    if tokenizer == "unicode":
        return F.array_join(unicode_tokens(text), " ")
    raise ValueError(f"unknown tokenizer: {tokenizer}")


def _digests(spaced: str, n: int, min_length: int, size: int) -> Iterator[bytes]:
    """The first ``size`` bytes of SHA-1 of every n-gram of tokens joined by spaces, in blocks."""
    data = spaced.encode()
    spaces = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 32).tolist()
    starts, ends = [0, *[p + 1 for p in spaces]], [*spaces, len(data)]
    if len(starts) < min_length:
        return
    last = ends[min(n, len(ends)) - 1 :]
    for at in range(0, len(last), _BLOCK):
        yield b"".join(
            [sha1(data[s:e]).digest()[:size] for s, e in zip(starts[at : at + _BLOCK], last[at : at + _BLOCK])])


def _modulo(numbers: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers modulo ``2**61 - 1``, without a division."""
    prime = np.uint64(MERSENNE_PRIME)
    folded = (numbers & prime) + (numbers >> np.uint64(61))
    # A difference below zero wraps to a large number.
    return np.minimum(folded, folded - prime)


def bit_counts(spaced: Column, n: int) -> Column:
    """Array of 65: how many n-grams there are, and in how many of their 64-bit hashes bit 0, 1, … 63 is set.

    ``spaced`` holds the tokens joined by spaces; the hash is the first eight bytes of
    SHA-1, the first one highest.
    """

    @F.arrow_udf("array<bigint>")
    def counts(rows: pa.Array) -> pa.Array:
        def one(row: str) -> np.ndarray:
            out = np.zeros(65, np.int64)
            for words in _digests(row, n, 1, 8):
                bits = np.unpackbits(np.frombuffer(words, np.uint8).reshape(-1, 8), axis=1)
                out[0] += len(bits)
                out[1:] += bits.sum(axis=0, dtype=np.int64)[::-1]
            return out

        kind = pa.list_(pa.int64())
        return joined([pa.array([one(row) for row in part.to_pylist()], kind) for part in parts(rows)], kind)

    return counts(spaced)


def minhash_signature(
    spaced: Column, n: int = 5, min_length: int = 5, num_perm: int = 25
) -> Column:
    """Array of ``num_perm`` minima over the n-grams; all ``2^32-1`` without n-grams.

    ``spaced`` holds the tokens joined by spaces, so an n-gram is a byte range of it.
    numpy's unsigned 64-bit product wraps as the permutation needs. Repeated
    n-grams do not change a minimum and are not removed.
    """
    pairs = np.array(permutations(num_perm), dtype=np.uint64)

    @F.arrow_udf("array<bigint>")
    def minima(rows: pa.Array) -> pa.Array:
        a, b = pairs[:, :1], pairs[:, 1:]

        def one(row: str) -> np.ndarray:
            low = np.full(num_perm, MAX_HASH, dtype=np.uint64)
            for words in _digests(row, n, min_length, 4):
                hashes = np.frombuffer(words, dtype="<u4").astype(np.uint64)
                np.minimum(low, (_modulo(hashes * a + b) & np.uint64(MAX_HASH)).min(axis=1), out=low)
            return low.astype(np.int64)

        kind = pa.list_(pa.int64())
        return joined([pa.array([one(row) for row in part.to_pylist()], kind) for part in parts(rows)], kind)

    return minima(spaced)


def jaccard(left: Column, right: Column) -> Column:
    """Shared over all distinct elements of two arrays; 0 when both are empty."""

    def share(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]
        shared = F.size(F.array_intersect(a, b)).cast("double")
        return shared / F.greatest(F.lit(1), F.size(F.array_union(a, b)))

    return _with(F.struct(left.alias("a"), right.alias("b")), share)


def jaccard_similarity(left: Column, right: Column, n: int = 8, min_length: int = 0) -> Column:
    """Jaccard similarity of the n-grams of two token arrays (see :func:`characters`)."""
    return jaccard(ngrams(left, n, min_length), ngrams(right, n, min_length))


def character_jaccard(left: Column | str, right: Column | str, n: int = 8) -> Column:
    """Jaccard similarity of the n-character windows of two texts; a shorter text is one window.

    The same as ``jaccard_similarity(characters(left), characters(right), n)``, in Arrow
    batches: an array of single characters takes many times the room of its text.
    """

    def windows(text: str | None) -> set[str]:
        text = text or ""
        return {text[i : i + n] for i in range(max(1, len(text) - n + 1))}

    @F.arrow_udf("double")
    def share(a: pa.Array, b: pa.Array) -> pa.Array:
        out: list[float] = []
        for part in parts(a):
            other = b.slice(len(out), len(part))
            for first, second in zip(part, other):
                x, y = windows(first.as_py()), windows(second.as_py())
                shared = len(x & y)
                out.append(shared / (len(x) + len(y) - shared))
        return pa.array(out, pa.float64())

    return share(left, right)
