import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from gristmill.functions import shingles as sh
from gristmill.functions import text as tx
from gristmill.operators import filters, fuzzy


def apply(spark, function, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[1] for r in rows.select("i", function(F.col("t"))).orderBy("i").collect()]


def test_punctuation_and_blanks(spark):
    assert apply(spark, tx.unify_punctuation, "a—b…c１", "plain") == ['a - b...c"', "plain"]
    assert apply(spark, tx.unify_whitespace, "a　b\nc​d") == ["a b\nc d"]
    assert apply(spark, tx.collapse_punctuation, "wow!!..$$", "——") == ["wow!.$$", "—"]
    assert apply(spark, tx.strip, "　 a b\x1f\n", "\t") == ["a b", ""]
    assert apply(spark, tx.punctuation_ratio, "a.b!", "") == [0.5, None]


@pytest.mark.parametrize("function", [
    tx.unify_punctuation, tx.unify_whitespace, tx.collapse_punctuation, tx.strip, tx.fix_text])
def test_idempotent(spark, function):
    rng = random.Random(3)
    alphabet = "ab \n\t!!..$—…１。　​é" + "ﬁ\r\x85’"
    texts = ["".join(rng.choice(alphabet) for _ in range(30)) for _ in range(200)]
    once = apply(spark, function, *texts)
    assert apply(spark, function, *once) == once


def test_fix_text(spark):
    got = apply(spark, tx.fix_text, "ＡＢＣ１", "a\r\nb\rc d", "é", "ﬁne “x” ‘y’", "a\x00b")
    assert got == ["ABC1", "a\nb\nc\nd", "é", "fine \"x\" 'y'", "ab"]


def test_nfc_test_covers_every_character(spark):
    points = [
        c for c in range(0x110000)
        if not 0xD800 <= c < 0xE000 and unicodedata.normalize("NFC", chr(c)) != chr(c)
    ]
    rows = spark.createDataFrame([(chr(c),) for c in points], "t string")
    assert rows.filter(~F.col("t").rlike(tx.NOT_ALWAYS_NFC)).count() == 0


def test_language_model_normal_form(spark):
    assert apply(spark, tx.normalize_for_lm, " line1\nline2 ", "１") == ["line0line0", "0"]
    assert apply(spark, lambda t: tx.normalize_for_lm(t, punctuation=2), "a—b。") == ["ab"]
    assert apply(spark, lambda t: tx.normalize_for_lm(t, accent=True, case=True), "ÉÀ x") == ["ea x"]


def test_dedup_normal_form(spark):
    assert apply(spark, tx.normalize_for_dedup, "Hello, world!", "Hello, 123!\n\t\b") == [
        "hello world", "hello 000"]
    assert apply(spark, tx.letters_only, "a 1,b\n—c\x1c") == ["ab—c"]


def test_simplified(spark):
    mapping = {"體": "体", "頭髮": "头发", "發": "发", "髮": "发", "甲乙": "丙"}
    got = apply(spark, lambda t: filters.to_simplified(t, mapping), "頭髮體發", "甲甲乙", "abc")
    assert got == ["头发体发", "甲丙", "abc"]


def test_tokens_and_ngrams(spark):
    tokens = apply(spark, sh.ascii_tokens, "中文中文中文 abc")[0]
    assert tokens == [""] * 7 + ["abc"]
    words = F.split(F.col("t"), " ")
    assert apply(spark, lambda t: sh.ngrams(words, 2, 1), "a b c d") == [["a b", "b c", "c d"]]
    assert apply(spark, lambda t: sh.ngrams(words, 2, 5), "a b c d") == [[]]
    assert apply(spark, lambda t: sh.ngrams(words, 3, 1), "a b") == [["a b"]]


def test_sha1(spark):
    assert apply(spark, lambda t: sh.sha1_integer(t, 32), "hello world") == [896314922]
    assert int(apply(spark, lambda t: sh.sha1_integer(t, 64), "hello world")[0]) == 13028719972609469994


def test_signatures(spark):
    short = apply(spark, lambda t: sh.minhash_signature(sh.spaced_tokens(t)), "one two", "a b c")
    assert short[0] == short[1] == [sh.MAX_HASH] * 25
    one = apply(spark, lambda t: sh.minhash_signature(sh.spaced_tokens(t), 1, 0, 250), "hello world")
    assert len(one[0]) == 250
    # Exact integers give the same minima.
    import hashlib
    hashes = [int.from_bytes(hashlib.sha1(w.encode()).digest()[:4], "little") for w in ("hello", "world")]
    expected = [
        min((h * a + b) % (1 << 64) % sh.MERSENNE_PRIME & sh.MAX_HASH for h in hashes)
        for a, b in sh.permutations(250)
    ]
    assert one[0] == expected
    swapped = apply(spark, lambda t: sh.minhash_signature(sh.spaced_tokens(t), 1, 0, 250), "world hello")
    assert swapped == one


def test_jaccard(spark):
    frame = spark.createDataFrame([("hello world", "hello world!")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    row = frame.select(
        sh.jaccard_similarity(sh.characters(a), sh.characters(a)),
        sh.jaccard_similarity(sh.characters(a), sh.characters(b)),
        sh.jaccard_similarity(F.split(a, " "), F.split(b, " "), 1),
    ).first()
    assert row[0] == 1.0 and row[1] == 0.8 and row[2] == pytest.approx(1 / 3)
    texts = ["hello world", "hello world!", "", None, "short", "中文中文中文中文中文 abc", "a\nb\nc\nd\ne\nf", "aaaaaaaaaaaa"]
    pairs = spark.createDataFrame([(x, y) for x in texts for y in texts], "a string, b string")
    slow = sh.jaccard_similarity(sh.characters(F.coalesce(a, F.lit(""))), sh.characters(F.coalesce(b, F.lit(""))))
    rows = pairs.select(sh.character_jaccard("a", "b").alias("x"), slow.alias("y")).collect()
    assert all(r.x == r.y for r in rows)


def test_optimal_bands():
    assert fuzzy.optimal_bands(0.75, 256) == (21, 12)
    assert fuzzy.optimal_bands(0.75, 256, 0.1, 0.9) == (28, 9)
    assert fuzzy.optimal_bands(0.7, 25) == (4, 6)
    assert fuzzy.optimal_bands(0.8, 25) == (3, 8)
