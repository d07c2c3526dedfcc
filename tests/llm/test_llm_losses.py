"""Cases in which rows were lost or results changed with the size of the input."""

import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest_paths import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gristmill.llm import byte_cnn, chat, decontaminate, jaccard, mixing, neighbours, quality, token_file
from gristmill.llm.blocks import hash_below, hash_bound
from gristmill.llm.queries import QUERIES
from test_llm_edges import unit_vectors


@pytest.mark.parametrize("share", [3000 / 5e10, 40_000 / 1e12, 1e-9, 0.3])
def test_small_shares_are_not_rounded_to_nothing(share):
    assert (hash_bound(share) + 2**63) / 2**64 == pytest.approx(share, rel=1e-6)
    assert hash_bound(1.0) == hash_bound(7.0) == 2**63 - 1


def test_samples_near_their_size(spark):
    ids = spark.range(200_000)
    assert 1700 < ids.filter(hash_below(0.01, F.col("id"))).count() < 2300
    assert ids.filter(hash_below(3.0, F.col("id"))).count() == 200_000


def test_models_learn_from_small_samples_and_smallest_labels(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    twice = labels.unionByName(labels.withColumn("quality", 1 - F.col("quality")))
    a = quality.train_quality(docs, twice)
    b = quality.train_quality(docs, twice.repartition(7))
    assert np.array_equal(a.value, b.value)
    network = byte_cnn.train_language_id(docs, F.lit(True), sample=40)
    assert network.languages


def test_a_hundred_neighbours(spark):
    x = unit_vectors(1500, 3, 1.0, 5)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = {}
    for r in neighbours.nearest(frame, frame.filter("vec_id % 30 = 0").select("vec_id"), k=100).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    hits = []
    for i, mine in found.items():
        scores = x @ x[i]
        scores[i] = -np.inf
        assert sorted(mine) == list(range(1, 101))
        hits.append(len(set(np.argsort(-scores)[:100].tolist()) & set(mine.values())) / 100)
    assert len(found) == 50 and np.mean(hits) >= 0.9


def test_vectors_of_another_length_and_repeated_ids(spark):
    rows = [(i, [1.0, float(i), 2.0]) for i in range(1, 9)] + [(20, [1.0, 2.0]), (21, [5.0]), (3, [9.0, 9.0, 9.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    first = neighbours.nearest(frame, frame.select("vec_id")).collect()
    again = neighbours.nearest(frame.repartition(5), frame.select("vec_id")).collect()
    assert {r.query_id for r in first} == set(range(1, 9)) and sorted(first) == sorted(again)


def test_an_id_with_two_texts_keeps_the_links_of_both(spark):
    a = " ".join(f"a{k}" for k in range(60))
    b = " ".join(f"b{k}" for k in range(60))
    near = b + " one more word"
    docs = spark.createDataFrame([(1, a), (5, a), (5, b), (9, near), (7, "something else entirely here now")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.ngram_jaccard(docs).collect()}
    assert got == {1: 1, 5: 1, 9: 1, 7: 7}


def test_places_in_a_mix_follow_one_order(spark):
    rows = [(k, "w " * (k % 13 + 1), f"s{k % 3}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = sorted(map(tuple, mixing.mix_sources(docs).collect()))
    again = sorted(map(tuple, mixing.mix_sources(docs.repartition(17)).collect()))
    assert first == again
    import duckdb

    base = duckdb.connect()
    base.register("documents", docs.toPandas())
    want = base.sql(mixing.mixing_sql()).fetchall()
    assert first == sorted(want)


def test_rows_without_an_id_stay_in_the_mix(spark):
    rows = [(None, f"word{k} " * 30, "en", "a", 5) for k in range(6)] + [(k, f"other{k} " * 30, "en", "a", 5) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.mixing_stage(spark, docs, SMALL)
    assert kept.columns == docs.columns
    assert {r.text for r in kept.collect() if r.doc_id is None}
    mixed = mixing.mix_sources(docs)
    assert kept.count() == mixed.agg(F.sum("copies")).first()[0]


def test_bad_turn_order_shows(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "assistant", "c"), (3, 0, "system", "d"), (3, 1, "system", "e"), (4, 0, "user", "f"), (4, 1, "user", "g")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.in_order for r in chat.read_back(chat.format_chat(turns)).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}
    assert {"in_order"} <= set(QUERIES["op1_chat_format"][0](spark, SMALL).columns)


# Token files

def _ids(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("change", [
    {}, {"normalizer": {"type": "Lowercase"}},
    {"pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Digits", "individual_digits": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}]}},
    {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}},
    {"truncation": {"direction": "Right", "max_length": 3, "strategy": "LongestFirst", "stride": 0}},
])
def test_ids_are_those_of_the_library_for_other_tokenizer_files(spark, tmp_path, change):
    settings = json.load(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))
    path = str(tmp_path / "tokenizer.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(settings | change, file)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y", "One 1234 two", "  blanks  here ", "", "<|endoftext", "end <|endoftext|>\n\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = token_file.read_token_files(spark, token_file.write_token_files(docs, path)).collect()
    want = {k: zlib.crc32(np.array([*_ids(path, t), 0], "<u4").tobytes()) for k, t in enumerate(texts)}
    assert {r.doc_id: r.ids_crc32 for r in rows} == want


def test_shards_are_read_by_many_tasks_and_folders_have_a_scheme(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(token_file, "SHARD_IDS", 100)
    monkeypatch.setattr(token_file, "READ_IDS", 500)
    docs = spark.createDataFrame([(k, "some words to encode " * 10) for k in range(200)], "doc_id long, text string")
    folder = token_file.write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "tokens"))
    assert folder.startswith("file:///")
    read = token_file.read_token_files(spark, folder)
    assert read.rdd.getNumPartitions() > 5 and read.count() == 200
    assert token_file.qualified(spark, "file:/a/b") == "file:///a/b"


# Decontamination

def test_long_texts_are_searched_in_stretches(monkeypatch):
    rng = np.random.default_rng(1)
    letters = lambda n: bytes(rng.integers(97, 123, n, np.uint8))
    texts = [letters(60) for _ in range(5)]
    items = decontaminate.Items(list(range(5)), [t.decode() for t in texts], 15)
    import pyarrow as pa

    spot = letters(1000) + texts[2] + letters(500) + texts[4][:30] + b"#" + texts[4][30:] + letters(77)
    rows = [spot, letters(3000), texts[0]]
    column = pa.array([r.decode() for r in rows])
    whole = items.search(column)
    for size in (64, 100, 250, 999):
        monkeypatch.setattr(decontaminate, "SEARCHED_BYTES", size)
        assert [f[:3] for f in items.search(column)] == [f[:3] for f in whole]
    assert [f[:3] for f in whole] == [(0, 2, 0), (0, 4, 1), (2, 0, 0)]


def test_query_finds_what_a_search_of_every_pair_finds(spark):
    import duckdb

    items = duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet' ORDER BY item_id LIMIT 12").fetchall()
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' WHERE strlen(text) < 3000 ORDER BY doc_id LIMIT 60").fetchall()
    rng = np.random.default_rng(9)
    for k, (item, text) in enumerate(items):
        changed = list(text)
        for _ in range(len(text) * int(rng.integers(8, 22)) // 100):
            changed[int(rng.integers(len(changed)))] = "~"
        docs.append((10_000 + k, f"{docs[k][1]} {''.join(changed)} {docs[k + 1][1]}"))
    fold = lambda t: decontaminate.fold(np.frombuffer(t.encode(), np.uint8)).tobytes()
    want = {}
    for doc, text in docs:
        for item, other in items:
            small = fold(other)
            distance = decontaminate.edit_end(small, fold(text))[0]
            if distance <= len(small) * 15 // 100:
                want[doc, item] = distance
    loaded = decontaminate.load_items(spark.createDataFrame(items, "item_id long, text string"))
    found = decontaminate.find_items(spark.createDataFrame(docs, "doc_id long, text string"), loaded).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in found} == want and len(want) > 3


def test_the_mix_depends_on_its_balance(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(k, "w " * int(rng.integers(1, 60)), f"s{k % 3}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")

    def gaps():
        by = mixing.mix_sources(docs).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
        return max(abs(r.taken - r.target) / r.target for r in by)

    assert gaps() < 0.01
    monkeypatch.setattr(mixing, "balance", lambda cells, targets: targets.withColumn("_rate", F.lit(1.0)))
    assert gaps() > 0.05
