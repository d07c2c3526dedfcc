"""What a task holds is bounded by bytes, not by the rows of a batch."""

import hashlib
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gristmill.functions import batches, patterns, shingles, subwords, tries
from gristmill.functions import text as tx
from gristmill.operators import filters, kneser_ney, langid, pii, script, simhash, word_units
from gristmill.sources import wordlists


def test_parts_are_bounded_and_whole():
    texts = pa.array(["ab", None, "", "c" * 9, "de", "f"])
    found = [p.to_pylist() for p in batches.parts(texts, 4)]
    assert found == [["ab", None, ""], ["c" * 9], ["de", "f"]]
    lists = pa.array([["a"] * 3, [], None, ["b"] * 3, ["c"]])
    assert [len(p) for p in batches.parts(lists, 6)] == [3, 1, 1]
    assert [len(p) for p in batches.parts(lists.slice(1), 6)] == [3, 1]
    assert list(batches.parts(texts.slice(0, 0), 4)) == []
    assert [p.to_pylist() for p in batches.parts(texts.slice(3, 2), 4)] == [["c" * 9], ["de"]]


def test_units_are_made_for_a_part_of_a_batch(monkeypatch):
    sizes = []

    class Found:
        def __init__(self, text):
            self.tokens = text.split(",")

    class Tokenizer:
        def encode_batch(self, texts, add_special_tokens):
            sizes.append(sum(map(len, texts)))
            return [Found(t) for t in texts]

    monkeypatch.setattr(subwords, "_tokenizer", lambda settings: Tokenizer())
    texts = [f"{k}, {k}," + "x" * 1000 for k in range(1000)]
    found = subwords._encoded("", pa.array(texts))
    assert max(sizes) <= subwords.ENCODED_BYTES < sum(sizes)
    assert found.to_pylist() == [[str(k), f"▁{k}", "x" * 1000] for k in range(1000)]


def test_a_batch_with_one_short_text_has_a_perplexity_of_order_five(spark):
    docs = spark.createDataFrame([(k, "a b c d e f g") for k in range(9)], "doc_id bigint, text string")
    model = kneser_ney.train_kneser_ney(docs)
    one = spark.createDataFrame([(1, ""), (2, "a")], "doc_id bigint, text string").repartition(1)
    rows = {r[0]: r[1] for r in kneser_ney.perplexity_kneser_ney(one.filter("doc_id = 1"), model).collect()}
    joined = {r[0]: r[1] for r in kneser_ney.perplexity_kneser_ney(one, model, max_broadcast_rows=0).collect()}
    assert rows == {1: joined[1]}


def test_keyword_files_are_read_in_parts(spark, tmp_path):
    lines = [f"word {k} 坏 ,".encode() for k in range(20000)]
    ends = [b"\n", b"\r\n", b"\r"]
    data = b"".join(line + ends[k % 3] for k, line in enumerate(lines))
    (tmp_path / "a.txt").write_bytes(data)
    (tmp_path / "b.txt").write_bytes(b"\xef\xbb\xbfmarked\nplain")
    (tmp_path / "c.log").write_bytes(b"other")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = wordlists.load_keywords(spark, str(tmp_path))
        got = [r["keyword"] for r in found.collect()]
        plan = wordlists._lines(spark, str(tmp_path), "UTF-8")
        rows = plan.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got) == sorted([f"word {k} 坏 " for k in range(20000)] + ["﻿marked", "plain"])
    assert len(rows) > 4 and max(r["count"] for r in rows) < 10000


@pytest.mark.parametrize("charset, data", [("UTF-8", b"a\xff\n"), ("GBK", b"a\n\xff\n"), ("UTF-16LE", b"a\0\n\0b")])
def test_broken_keyword_files_are_errors(spark, tmp_path, charset, data):
    (tmp_path / "a.txt").write_bytes(data)
    with pytest.raises(Exception):
        wordlists.load_keywords(spark, str(tmp_path), charset).collect()


def test_strings_are_counted_in_parts(spark, monkeypatch):
    draw = random.Random(5)
    texts = ["".join(draw.choice("中文字词𠀀, a") for _ in range(draw.randrange(40))) for _ in range(200)] + ["", None, "  中"]
    wanted = Counter()
    for text in texts:
        for run in "".join(c if c in "中文字词𠀀" else " " for c in text or "").split():
            marked = word_units.BEGIN + run + word_units.END
            wanted.update(marked[i:i + k] for k in range(1, 6) for i in range(len(marked) - k + 1))
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    assert {r.gram: r.n for r in word_units.gram_counts(docs).collect()} == wanted
    monkeypatch.setattr(word_units, "COUNTED", 50)
    monkeypatch.setattr(word_units, "NAMED", 7)
    monkeypatch.setattr(batches.parts, "__defaults__", (30,))
    runs = [word_units.BEGIN + (word_units.END + word_units.BEGIN).join(
        "".join(c if c in "中文字词𠀀" else " " for c in t or "").split()) + word_units.END for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array([r for r in runs if len(r) > 2])], ["_runs"])
    found, most = Counter(), 0
    for part in word_units._Counts(5)([batch, batch]):
        most = max(most, part.num_rows)
        found.update(dict(zip(part.column(0).to_pylist(), part.column(1).to_pylist())))
    assert most <= 7 and found == {k: 2 * n for k, n in wanted.items()}


def test_runs_are_cut_by_the_most_probable_path(monkeypatch):
    draw = random.Random(7)
    words = {"".join(draw.choice("中文字词") for _ in range(draw.randrange(1, 5))): draw.random() * 3 for _ in range(40)}

    def one(run):
        best, step = [0.0], [0]
        for end in range(1, len(run) + 1):
            found = [(best[end - 1] + words.get(run[end - 1], 2.5), 1)] + [
                (best[end - k] + words[run[end - k:end]], k) for k in range(2, min(4, end) + 1) if run[end - k:end] in words]
            cost, size = min(found)
            best.append(cost)
            step.append(size)
        out, at = [], len(run)
        while at:
            out.append(run[at - step[at]:at])
            at -= step[at]
        return out[::-1]

    rows = [None, []] + [["".join(draw.choice("中文字词典") for _ in range(draw.randrange(1, 30))) for _ in range(draw.randrange(5))] for _ in range(80)]
    wanted = [None if row is None else [w for run in row for w in one(run)] for row in rows]
    lexicon = word_units._Lexicon(words, 2.5)
    for few, bytes_ in ((0, 1 << 20), (16, 1 << 20), (3, 100)):
        monkeypatch.setattr(word_units, "FEW", few)
        monkeypatch.setattr(word_units, "CUT", bytes_)
        assert word_units._cut_in_parts(lexicon, pa.array(rows, pa.list_(pa.string()))).to_pylist() == wanted
    assert word_units._Lexicon({}, 1.0).cut(["中文"]) == [["中", "文"]]


def test_address_patterns_look_ahead_and_find_the_same(spark):
    draw = random.Random(11)
    pieces = ["fe80::1%eth0", "::", ":", "1", "25", "255", "2001:db8::a:1", "abcd", "a", ".", "1.2.3.4", "256.1.1.1", "::ffff:1.2.3.4", " ", ",",
              "g", "é", "中", "\n", "\x08", "1234.5.6.7", "fe80:", "%x", "12345:1:2"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randrange(1, 14))) for _ in range(3000)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    plain = {
        "IPv4": f"({patterns.IPV4})", "IPv6": f"({patterns.IPV6})",
        "IP_ADDRESS": patterns.for_jvm(f"{patterns.OPENING}({patterns.IPV4}|{patterns.IPV6}){patterns.CLOSING_IP}")}
    for tag, pattern in plain.items():
        assert "(?=" in pii._PATTERNS[tag]
        found = docs.select("text", *[
            F.regexp_extract_all("text", F.lit(p), F.lit(g)).alias(f"{n}{g}")
            for n, p in (("was", pattern), ("now", pii._PATTERNS[tag])) for g in (0, 1)])
        assert found.filter("was0 <> now0 OR was1 <> now1").count() == 0 < found.filter("size(was1) > 0").count()
        hits = docs.select("text", F.explode(pii._native_hits(F.col("text"), tag)).alias("hit")).collect()
        for row in hits:
            assert row.hit.value in row.text[row.hit.start:row.hit.end]
            assert tag == "IP_ADDRESS" or row.text[row.hit.start:row.hit.end] == row.hit.value


def test_mapping_takes_the_longest_match_at_each_place():
    draw = random.Random(13)
    for _ in range(60):
        pairs = {"".join(draw.choice("abc𠀀") for _ in range(draw.randrange(1, 5))): draw.choice(["", "x", "yz", "c"]) for _ in range(draw.randrange(1, 9))}
        text = "".join(draw.choice("abc𠀀d") for _ in range(80))
        out, at = [], 0
        while at < len(text):
            size = next((k for k in range(4, 0, -1) if text[at:at + k] in pairs and len(text[at:at + k]) == k), 0)
            out.append(pairs[text[at:at + size]] if size else text[at])
            at += size or 1
        mapping = script.Mapping({"": "none", **pairs})
        assert mapping.convert(text) == "".join(out) and mapping.convert("") == ""
    assert script.converted(mapping, pa.array([None, text], pa.string())).to_pylist() == [None, "".join(out)]


def test_a_trie_names_every_string_at_every_place():
    draw = random.Random(17)
    strings = sorted({"".join(draw.choice("ab𠀀") for _ in range(draw.randrange(1, 5))) for _ in range(20)})
    text = "".join(draw.choice("ab𠀀c") for _ in range(300))
    found = sorted((p, k, n) for k, place, number in tries.Trie(strings).walk(tries.points_of(text)) for p, n in zip(place.tolist(), number.tolist()))
    assert found == sorted((p, len(x), n) for n, x in enumerate(strings) for p in range(len(text)) if text.startswith(x, p))
    assert list(tries.Trie([]).walk(tries.points_of(text))) == []


def test_hashes_modulo_the_prime():
    draw = np.random.default_rng(3)
    prime = shingles.MERSENNE_PRIME
    edges = [0, 1, prime - 1, prime, prime + 1, 2 * prime, 8 * prime, (1 << 64) - 1, 7 * prime - 1]
    numbers = np.r_[np.array(edges, np.uint64), draw.integers(0, 1 << 64, 1000, np.uint64, False)]
    assert shingles._modulo(numbers).tolist() == [x % prime for x in numbers.tolist()]


def test_bits_are_counted_in_the_row_and_rows_of_one_id_are_added(spark):
    texts = [(1, "a b c d"), (1, "e"), (2, "x y"), (3, "é, 中文 b-c"), (None, "a b"), (4, None), (5, " ,"), (6, "one two three four five six " * 900)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    wanted: dict[int, list[int]] = {}
    for key, text in texts:
        if key in (None, 4, 5):
            continue
        words = re.split("[^A-Za-z0-9_]", text)
        for gram in [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]:
            wanted.setdefault(key, []).append(int.from_bytes(hashlib.sha1(gram.encode()).digest()[:8], "big"))
    found = {r.doc_id: r.signature & (1 << 64) - 1 for r in simhash.simhash_signatures(docs).collect()}
    assert found == {key: sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) for key, hashes in wanted.items()}
    plan = simhash.simhash_signatures(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_python_steps_take_parts_of_a_batch(spark, monkeypatch):
    monkeypatch.setattr(langid, "NAMED", 3)
    monkeypatch.setattr(langid, "FLUSH", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(["en", None, "en"]), pa.array(["abcdefgh", "", "abcxyz" * 9])], ["lang", "text"])
    found = Counter()
    for part in langid._count_batches([batch, batch]):
        assert part.num_rows <= 3
        for language, gram, times in zip(*(c.to_pylist() for c in part.columns)):
            found[language, gram] += times
    texts = ["abcdefgh", "abcxyz" * 9] * 2
    assert found == Counter(("en", t[i:i + 3]) for t in texts for i in range(len(t) - 2))
    pairs = spark.createDataFrame([("a" * 9, None), ("abcdefghij", "abcdefghix"), (None, None)], "a string, b string")
    assert [r[0] for r in pairs.select(shingles.character_jaccard("a", "b")).collect()] == [0.0, 0.5, 1.0]


def test_texts_are_redacted_once_in_a_chain(spark):
    docs = spark.createDataFrame([(1, "mail a.b@example.org now " * 9), (2, None), (3, ""), (4, "plain words, more of them " * 9)], "doc_id bigint, text string")
    chain = filters.rule_filter(filters.sensitive_filter(pii.run_pii(docs), ["password"]))
    plan = chain._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_key_hits") <= 2 and plan.count("aggregate(array_distinct") == 1
    assert [r.doc_id for r in chain.orderBy("doc_id").collect()] == [1, 4]
    assert {r.doc_id: r.text for r in pii.run_pii(docs).collect()} == {
        1: "mail PI:EMAIL now " * 9, 2: None, 3: "", 4: "plain words, more of them " * 9}
    assert pii.run_pii(docs, audit=True).columns == ["doc_id", "text", "regex_metadata", "old_text", "modified"]


def test_faster_patterns_match_the_same(spark):
    draw = random.Random(19)
    pieces = ["\r", "\n", "\r\n", "\x85", " ", " ", "\x00", "\x0b", "\x0c", "\t", "\x1f", "\x7f", "a", "é", "Ａ", "　", "‘", "„", "‟", "ﬁ", "𠀀", "\u206a", "\ufeff", "\ufffb", "ĳ", "\u0301", "\u1fff", "\U0002f800", "\u2126", "e",
              "fe80:", ":", "::", "1.2", ".", "f:0", "0"]
    plain = [[p for p in pieces if p.isascii()], pieces]
    texts = ["".join(draw.choice(plain[k % 2]) for _ in range(draw.randrange(1, 7))) for k in range(4000)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    needed = {"IP_ADDRESS": r"[0-9]\.[0-9]|::|[0-9a-fA-F]:[0-9a-fA-F]|fe80:", "IPv6": r"::|[0-9a-fA-F]:[0-9a-fA-F]|fe80:"}
    for tag, pattern in needed.items():
        assert docs.filter(F.col("text").rlike(pattern) != F.col("text").rlike(pii._NEEDED[tag])).count() == 0
    fixed = {r.text: r.fixed for r in docs.select("text", tx.fix_text("text").alias("fixed")).collect()}
    marks = str.maketrans({**{chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}, "　": " ", **dict.fromkeys("‘’‚‛", "'"), **dict.fromkeys("“”„‟", '"'), "ﬁ": "fi", "ĳ": "ij"})
    for text in texts:
        ends = "\r\n|\r" if text.isascii() else "\r\n|[\r\x85  ]"
        cleaned = re.sub("[\x00-\x08\x0b\x0e-\x1f\x7f\u206a-\u206f\ufeff\ufff9-\ufffb]", "", re.sub(ends, "\n", text).translate(marks))
        assert fixed[text] == unicodedata.normalize("NFC", cleaned)
