"""SimHash, long keyword lists, whole writes, one move of texts, Kneser-Ney models, script and encoding repair."""

import os
import re

import numpy as np
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from gristmill.functions import encoding, subwords
from gristmill.operators import evaluate, filters, kneser_ney, plumbing, script, simhash, word_units
from gristmill.plans.corpus import clean_corpus
from gristmill.sources import jsonl
from gristmill.sources.observed import RunLog
from gristmill.staging import buckets_for


SMALL = "/root/testdata/sf0.001"


# SimHash

@pytest.mark.parametrize(("blocks", "most"), [(None, 4096), (5, 4096), (6, 2), (4, 1), (7, 3)])
def test_hamming_pairs_equal_brute_force(spark, monkeypatch, blocks, most):
    if blocks:
        monkeypatch.setattr(simhash, "blocks_for", lambda *_: blocks)
    rng = np.random.default_rng(blocks or 1)
    base = rng.integers(0, 1 << 63, 20, np.int64)
    values = set(base.tolist())
    for value in base.tolist():
        for _ in range(15):
            bits = rng.choice(64, int(rng.integers(1, 6)), replace=False)
            values.add(int(np.int64(value) ^ np.bitwise_xor.reduce(np.left_shift(np.int64(1), bits.astype(np.int64)))))
    # Many that agree in all but the lowest bits, so that keys overflow.
    values |= {int(base[0]) & ~0xFF | k for k in range(60)}
    rows = list(enumerate(sorted(values)))
    want = {(a, b) for a, x in rows for b, y in rows if x < y and ((x ^ y) & (1 << 64) - 1).bit_count() <= 3}
    got = simhash.hamming_pairs(spark.createDataFrame(rows, "_id long, signature long"), most_key_rows=most).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_keys_grow_with_the_table():
    assert simhash.blocks_for(1000, 3, 4) == 4 and simhash.blocks_for(10**8, 3, 4) == 5
    assert simhash.blocks_for(10**11, 3, 4) == 6
    with pytest.raises(ValueError):
        simhash.hamming_pairs(None, bit_diff=4, num_bucket=4)


def test_simhash_awkward(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, ""), (5, "?!"), (6, "word"), (7, "word"), (None, "word")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.cluster for r in simhash.simhash_clusters(docs).collect()} == {1: 1, 2: 1, 6: 6, 7: 6}
    assert sorted(str(r.doc_id) for r in simhash.simhash_dedup(docs).collect()) == ["1", "3", "4", "5", "6", "None"]
    assert simhash.simhash_dedup(docs.filter("false")).count() == 0


# Long keyword lists

def test_keyword_index_equals_search(spark):
    rng = np.random.default_rng(8)
    letters = list("abé中 ")
    text = lambda n: "".join(rng.choice(letters, n))
    docs = [(k, text(int(rng.integers(0, 200)))) for k in range(300)] + [(900, None), (901, "")]
    words = {text(int(n)) for n in rng.integers(1, 15, 60)} | {docs[5][1][3:40], docs[9][1][:30], "nowhere to be found", "中", "é" * 30}
    words = {w for w in words if w.strip() and len(w) > 3} | {"中é中", "zz"}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    listed = spark.createDataFrame([(w,) for w in words] + [(None,), ("",)], "word string")
    want = sorted(k for k, t in docs if not any(w in (t or "") for w in words))
    got = filters.sensitive_filter(frame, listed, max_keyword_bytes=0)
    assert sorted(r.doc_id for r in got.collect()) == want and got.columns == frame.columns
    assert 0 < len(want) < len(docs)
    assert filters.sensitive_filter(frame, listed.filter("false"), max_keyword_bytes=-1).count() == len(docs)


# Whole writes

def _jobs(spark, body):
    group = f"jobs-{os.urandom(4).hex()}"
    spark.sparkContext.setJobGroup(group, "")
    body()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_writes_are_whole_and_read_their_input_once(spark, tmp_path):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("äb").alias("text")).repartition(3)
    out = str(tmp_path / "out")
    written = []
    plain = _jobs(spark, lambda: docs.write.parquet(str(tmp_path / "plain")))
    assert _jobs(spark, lambda: written.append(jsonl.write_guarded(docs, out, "parquet"))) == plain
    assert written[0] and (written[0].rows, written[0].bytes) == (100, 300) and written[0].seconds > 0
    assert not jsonl.write_guarded(docs, out, "parquet")
    # The result replaces what it was read from.
    again = spark.read.parquet(out).filter("doc_id < 7")
    assert jsonl.write_guarded(again, out, "parquet", from_scratch=True).rows == 7
    assert spark.read.parquet(out).count() == 7
    # No rows: nothing new, and what stood there stays.
    assert not jsonl.write_guarded(docs.filter("doc_id < 0"), out, "parquet", from_scratch=True)
    assert not jsonl.write_guarded(docs.limit(0), str(tmp_path / "none"))
    assert spark.read.parquet(out).count() == 7
    broken = docs.select(F.raise_error(F.lit("broken")).alias("text"))
    with pytest.raises(Exception, match="broken"):
        jsonl.write_guarded(broken, str(tmp_path / "broken"))
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["out", "plain"]


# One move of texts

def _text_exchanges(plan: str) -> int:
    return len(re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[[^\]]*\b(?:text|_text|_lines)#", plan))


def test_texts_move_once(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plain = sorted((r.doc_id, r.text) for r in clean_corpus(docs).select("doc_id", "text").collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans = []
    explained = lambda df: df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    for name in ("parquet", "saveAsTable"):
        def write(self, *args, _old=getattr(DataFrameWriter, name), **options):
            plans.append(explained(self._df))
            return _old(self, *args, **options)
        monkeypatch.setattr(DataFrameWriter, name, write)
    try:
        log = RunLog()
        last = clean_corpus(docs, log=log)
        plans.append(explained(last))
        rows = sorted((r.doc_id, r.text) for r in last.select("doc_id", "text").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    assert rows == plain
    assert sum(map(_text_exchanges, plans)) == 1
    report = {r.step: r for r in log.report(spark).collect()}
    assert set(report) == {"by-rules", "lines", "exact"} and all(r.rows > 0 and r.bytes > 0 for r in report.values())


# Kneser-Ney

def test_probabilities_after_a_context_add_up_and_both_paths_agree(spark):
    rng = np.random.default_rng(3)
    text = lambda: " ".join("w" + chr(96 + min(int(rng.geometric(0.2)), 12)) for _ in range(int(rng.integers(0, 30))))
    train = spark.createDataFrame([(text(),) for _ in range(200)] + [(None,), ("",)], "text string")
    model = kneser_ney.train_kneser_ney(train, 3)
    rows = {r.gram: (r.log10_prob, r.log10_backoff) for r in model.collect()}
    words = [g for g, (p, _) in rows.items() if g and " " not in g and p is not None]

    def p(context, word):
        gram = " ".join([*context, word])
        if gram in rows and rows[gram][0] is not None:
            return 10 ** rows[gram][0]
        if not context:
            return 10 ** rows[""][0]
        left = rows.get(" ".join(context), (None, None))[1]
        return 10 ** (left or 0.0) * p(context[1:], word)

    for context in ([], ["wa"], ["wb", "wa"], ["<s>"], ["<s>", "wa"], ["wl", "wk"]):
        assert sum(p(context, w) for w in [*words, "never seen"]) == pytest.approx(1, abs=1e-9)
    docs = spark.createDataFrame([(k, text()) for k in range(50)] + [(60, None), (61, ""), (62, "new words wa wb")], "doc_id long, text string")
    small = {r.doc_id: r.perplexity for r in kneser_ney.perplexity_kneser_ney(docs, model).collect()}
    joined = {r.doc_id: r.perplexity for r in kneser_ney.perplexity_kneser_ney(docs, model, max_broadcast_rows=0).collect()}
    assert small == joined and len(small) == 53
    seq = ["<s>", *docs.filter("doc_id = 3").first().text.split(), "</s>"]
    log = sum(np.log10(p(seq[max(0, i - 2):i], seq[i])) for i in range(1, len(seq)))
    assert small[3] == pytest.approx(10 ** (-log / (len(seq) - 1)), abs=0.06)
    limit = float(np.median(list(small.values())))
    for rows_ in (500_000, 0):
        kept = kneser_ney.perplexity_filter_kneser_ney(docs, model, limit, max_broadcast_rows=rows_)
        assert {r.doc_id for r in kept.collect()} == {k for k, v in small.items() if v <= limit}


# Script

def _convert_by_hand(text, pairs):
    out, at = [], 0
    while at < len(text):
        size = next((s for s in range(8, 0, -1) if len(text[at:at + s]) == s and text[at:at + s] in pairs), 0)
        out.append(pairs[text[at:at + size]] if size else text[at])
        at += size or 1
    return "".join(out)


def test_both_paths_convert_the_longest_match_first(spark):
    rng = np.random.default_rng(4)
    letters = list("體臺灣發髮里裡ab \U0002070e")
    word = lambda n: "".join(rng.choice(letters, n))
    pairs = {word(int(n)): word(int(rng.integers(0, 4))).replace("a", "X") for n in rng.integers(1, 9, 60)} | {"體": "体", "臺": "台", "臺灣": "台湾!"}
    texts = [word(int(n)) for n in rng.integers(0, 80, 200)] + ["", None, "plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    mapping = spark.createDataFrame([*pairs.items(), (None, "x"), ("", "y"), ("q", None)], "source string, target string")
    want = {k: None if t is None else _convert_by_hand(t, pairs) for k, t in enumerate(texts)}
    for bound in (1 << 20, 0):
        got = script.convert_script(docs, mapping, max_mapping_bytes=bound)
        assert {r.doc_id: r.text for r in got.collect()} == want and got.columns == docs.columns
    assert script.convert_script(docs, mapping.filter("false")).count() == len(texts)


# Encoding

def test_wrongly_decoded_lines_come_back_and_others_stay(spark):
    once = lambda t: t.encode().decode("latin-1")
    windows = lambda t: "".join(
        bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in t.encode())
    clean = ["Überall schöne Wörter und Straßen", "le café déjà vu — “où” ça ?", "mañana será otro día", "plain ascii", "", "中文 and ß", "Ã is a letter, Â too", None]
    rows = [(k, t) for k, t in enumerate(clean * 20)]
    broken = [(1000, once(clean[0]), clean[0]), (1001, windows(clean[1]), clean[1]), (1002, once(once(clean[2])), clean[2]),
              (1003, f"{clean[0]}\n{windows(clean[1])}\nend", f"{clean[0]}\n{clean[1]}\nend"), (1004, once(clean[5]), clean[5])]
    docs = spark.createDataFrame(rows + [(k, t) for k, t, _ in broken], "doc_id long, text string")
    got = {r.doc_id: r.text for r in encoding.repair_encoding(docs).collect()}
    assert got == dict(rows) | {k: t for k, _, t in broken}


# Strata

def test_strata_have_their_rows_and_agree_with_the_whole(spark):
    docs = spark.createDataFrame([(k, None if k % 3 == 0 else "ab"[k % 2]) for k in range(60)], "doc_id long, kind string")
    rows = plumbing.sample_rows(docs, 4, by="kind").collect()
    assert sorted(str(r.kind) for r in rows) == sorted(["None", "a", "b"] * 4)
    alone = plumbing.sample_rows(docs.filter("kind = 'a'"), 4).collect()
    assert {r.doc_id for r in rows if r.kind == "a"} == {r.doc_id for r in alone}


# Word units

def test_frequent_words_of_a_made_corpus_are_found(spark):
    rng = np.random.default_rng(6)
    letters = [chr(0x4E00 + 11 * k) for k in range(80)]
    made = ["".join(rng.choice(letters, int(n), replace=False)) for n in rng.choice([2, 2, 3, 4], 40)]
    texts = ["".join(rng.choice(made, int(rng.integers(5, 40)), p=None)) + "。" for _ in range(300)] + [None, "", "latin only"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = word_units.learn_words(docs, min_cohesion=3.0)
    learned = {r.word: r.n for r in words.collect()}
    whole = "".join(t or "" for t in texts)
    found = [w for w in made if w in learned]
    assert len(found) / len(set(made)) > 0.9 and all(learned[w] <= whole.count(w) * 2 for w in found)
    top = evaluate.word_frequencies(docs, words=words, top=30).collect()
    assert sum(r.word in made for r in top) >= 27 and top[0].weight == 1.0
    # Without learned words a run is one word.
    assert max(len(r.word) for r in evaluate.word_frequencies(docs).collect()) > 20
    assert word_units.learn_words(docs.filter("doc_id > 299")).count() == 0


# Sub-word units

def test_texts_are_cut_after_whole_units_and_models_take_units(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ["some words and more words " * 20, " short \n", "", None, "\U0001f600" * 40, "é" * 100, "中文字" * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cut = {r.doc_id: r.text for r in docs.select("doc_id", subwords.truncate_units("text", path, 10).alias("text")).collect()}
    for k, text in enumerate(texts):
        ids = library.encode((text or "").strip(), add_special_tokens=False).ids
        if text is None or len(ids) <= 10:
            assert cut[k] == text
        else:
            whole = library.decode(ids[:10]).rstrip("�")
            assert cut[k] == whole and text.strip().startswith(cut[k]) and cut[k]
    units = subwords.units(path)
    model = kneser_ney.train_kneser_ney(docs, 3, units=units)
    small = {r.doc_id: r.perplexity for r in kneser_ney.perplexity_kneser_ney(docs, model, units=units).collect()}
    joined = {r.doc_id: r.perplexity for r in kneser_ney.perplexity_kneser_ney(docs, model, units=units, max_broadcast_rows=0).collect()}
    assert small == joined and len(small) == len(texts) and small[0] < small[1]


def test_buckets_follow_the_size_of_what_is_read(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1, "a")]), "doc_id long, text string")
    assert buckets_for(docs) is None and buckets_for(unknown) is None
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # A join does not multiply the sizes of its sides.
        assert buckets_for(docs) == buckets_for(docs.crossJoin(docs.select("lang"))) == spark.sparkContext.defaultParallelism
        assert buckets_for(unknown) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
