"""Ranked search, quality rules and resampling against brute force, awkward rows and cut stretches."""

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import pytest
import xxhash
from conftest_paths import LARGER, SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, database

from gristmill.llm import ranked, resampling, rules, terms
from gristmill.llm.queries import QUERIES

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return TERMS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def flat(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])


@given(st.lists(st.text(alphabet="aB9é中 \n._"), max_size=8), st.integers(1, 12))
@settings(deadline=None, max_examples=200)
def test_stretches_cut_no_word_and_cross_no_text(texts, limit):
    data, offsets = flat(texts)
    got = [(int(r), data[a:b].tobytes().decode()) for _, _, s, e, rows in terms.stretches(data, offsets, terms.TERM, limit)
           for a, b, r in zip(s, e, rows)]
    assert got == [(k, w) for k, text in enumerate(texts) for w in TERMS.findall(text)]


# Ranked search

def ranked_by_hand(docs, items, k):
    words = [lowered(t) for _, t in docs]
    full = [w for w in words if w]
    n, length = len(full), sum(map(len, full))
    df = Counter(t for w in full for t in set(w))
    out = []
    asked = {}
    for item, text in set(items):
        asked.setdefault(item, []).extend(lowered(text))
    for item, query in asked.items():
        scores = []
        for (doc, _), w in zip(docs, words):
            tf, m = Counter(w), 75 + (25 * len(w) * n) // length if w else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in query if tf[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def test_ranks_equal_brute_force_over_many_trees(spark, monkeypatch):
    monkeypatch.setattr(ranked, "LEAF", 3)
    monkeypatch.setattr(ranked, "TREE_BYTES", 2000)
    monkeypatch.setattr(terms, "STRETCH_BYTES", 64)
    rng = np.random.default_rng(1)
    word = lambda: f"w{min(int(rng.geometric(0.08)), 60)}"
    docs = [(k, " ".join(word() for _ in range(int(rng.integers(0, 60))))) for k in range(300)]
    docs += [(1000 + k, docs[7][1]) for k in range(40)] + [(None, docs[7][1]), (2000, None), (2001, "?!")]
    items = [(k, " ".join(word().upper() for _ in range(int(rng.integers(1, 9))))) for k in range(25)]
    items += [(None, "w1 w9"), (50, None), (51, "no such thing"), (3, "w59 w2"), items[4]]
    frame, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = ranked_by_hand(docs, items, 7)
    got = ranked.rank_documents(frame.repartition(3), asked, k=7)
    assert sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == want
    monkeypatch.setattr(ranked, "PASS_TERMS", 20)
    got = ranked.rank_documents(frame, asked, k=7)
    assert sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == want


def test_trees_leave_subtrees_out():
    rng = np.random.default_rng(3)
    # Documents of 40 topics with 30 terms each.
    vectors = [np.unique(k % 40 * 30 + rng.integers(0, 30, 12)) for k in range(4000)]
    ranks, offsets = np.concatenate(vectors), np.cumsum([0] + [len(v) for v in vectors])
    tree = ranked.Tree(ranks, np.ones(len(ranks), np.int64), offsets, np.full(4000, 100))
    assert sorted(tree.order.tolist()) == list(range(4000))
    assert all(not c or (tree.begin[k], tree.end[k]) == (tree.begin[c[0]], tree.end[c[-1]]) for k, c in enumerate(tree.children))
    best = ranked.Best(20)
    scored = tree.search(np.array([40, 55, 58, 700]), np.array([4000, 6000, 8000, 5000]), best, np.arange(4000), np.ones(4000, bool))
    assert len(best.score) == 20 and scored < 400


def test_terms_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(ranked.RangeHash, "of", lambda self, a, b: np.zeros(len(a), np.uint64))
    data, offsets = flat(["aa bb cc aa ccc"])
    (_, _, starts, ends, _), = terms.stretches(data, offsets, terms.TERM)
    found, term = ranked.Vocabulary([b"aa", b"cc", b"zz"]).find(data, starts, ends)
    assert sorted(zip(found.tolist(), term.tolist())) == [(0, 0), (2, 1), (3, 0)]


def test_ranked_awkward(spark, awkward, empty):
    items = spark.createDataFrame([(1, "quick brown words", "x"), (2, None, "y")], "item_id long, text string, doc_id string")
    rows = ranked.rank_documents(awkward, items).collect()
    assert {r.item_id for r in rows} == {1} and [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1, len(rows) + 1))
    assert ranked.rank_documents(empty, items).count() == 0
    assert ranked.rank_documents(awkward, items.filter("false")).count() == 0


# Quality rules

def base_by_hand(text):
    words = WORDS.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        dup += bool(WORDS.search(line)) and line in seen
        seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed)


@given(st.lists(st.text(alphabet="ab#|é中 \t\n\x0b\x1c\x85"), max_size=6), st.integers(1, 9))
@settings(deadline=None, max_examples=200)
def test_base_statistics_of_small_texts(texts, limit):
    before, terms.STRETCH_BYTES = terms.STRETCH_BYTES, limit
    try:
        base, features = rules.statistics(*flat(texts))
    finally:
        terms.STRETCH_BYTES = before
    assert [(*map(int, b), bool(f)) for b, f in zip(base, rules.base_failed(base))] == [base_by_hand(t) for t in texts]
    assert features.min(initial=0) >= 0 and features.max(initial=0) <= 1


def test_base_statistics_against_sql(spark):
    def base(session, folder):
        return QUERIES["op12_quality_rules"][0](session, folder).drop("kept")

    assert compare(spark, database(SMALL), "op12", base, rules.base_sql(), SMALL).startswith("ok")


def path_by_hand(forest, row):
    total = 0
    for node in forest.roots.tolist():
        while forest.left[node] != node:
            node = forest.left[node] if row[forest.feature[node]] <= forest.cut[node] else forest.right[node]
        total += forest.length[node]
    return total / len(forest.roots) / forest.usual


def test_paths_and_thresholds():
    rng = np.random.default_rng(5)
    x = (rng.random((500, len(rules.FEATURES))) * 0.1).astype(np.float32)
    forest = rules.grow(x)
    odd = x[:50].copy()
    odd[:, 2] = 0.9
    assert forest.paths(x[:20]) == pytest.approx([path_by_hand(forest, r) for r in x[:20]])
    good = np.arange(550) < 500
    forest.least = rules.calibrate(forest.paths(np.r_[x, odd]), good)
    assert forest.keeps(x).all() and not forest.keeps(odd).any()
    assert rules.calibrate(forest.paths(x), np.ones(500, bool)) == 0
    mixed = rules.calibrate(np.arange(1000.0), np.arange(1000) % 2 == 0)
    assert (np.arange(0, 1000, 2) < mixed).mean() <= rules.LOSS


def test_rules_keep_good_documents_and_reject_bad_ones_of_the_other_half(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    forest = rules.train_rules(docs, labels.filter("doc_id % 2 = 0"))
    truth = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{LARGER}/labels.parquet' WHERE doc_id % 2 = 1").fetchall())
    rows = [r for r in rules.apply_rules(docs, forest).collect() if r.doc_id in truth]
    assert len(rows) == len(truth) > 100
    assert not any(r.kept for r in rows if r.base_failed)
    judged = [(r.kept, bool(truth[r.doc_id])) for r in rows if not r.base_failed]
    assert sum(k == t for k, t in judged) / len(judged) >= 0.98


def test_rules_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (None, 1), (77, 0), (9, None)], "doc_id long, quality int")
    forest = rules.train_rules(awkward, labels)
    rows = rules.apply_rules(awkward, forest).collect()
    assert sorted((str(r.doc_id), *tuple(r)[1:7]) for r in rows) == sorted((str(r.doc_id), *base_by_hand(r.text)) for r in awkward.collect())
    assert rules.apply_rules(empty, rules.train_rules(empty, labels)).count() == 0
    untrained = rules.train_rules(awkward, labels.filter("false"))
    assert all(r.kept == (not r.base_failed) for r in rules.apply_rules(awkward, untrained).collect())


# Resampling

@given(st.lists(st.binary(max_size=70), max_size=20))
@settings(deadline=None, max_examples=200)
def test_keys_are_xxhash64(ranges):
    data = np.frombuffer(b"".join(ranges), np.uint8)
    ends = np.cumsum([len(r) for r in ranges], dtype=np.int64)
    starts = ends - [len(r) for r in ranges] if ranges else ends
    got = resampling.xxhash64(terms.Lanes(data), starts, ends)
    assert got.tolist() == [xxhash.xxh64_intdigest(r) for r in ranges]


def test_interned_grams_whose_keys_collide_are_told_apart(monkeypatch):
    monkeypatch.setattr(resampling, "xxhash64", lambda lanes, a, b: (b - a).astype(np.uint64))
    words = [f"{k % 37:02d}{'tail of more than eight bytes' if k % 3 else ''}" for k in range(500)]
    data, offsets = flat(words)
    table = resampling.Table(terms.Lanes(data), offsets[:-1], offsets[1:], 1000)
    slots = {}
    for word, slot in zip(words, table.slot.tolist()):
        assert slots.setdefault(word, slot) == slot
    assert len(set(slots.values())) == len(slots)
    assert all(table.bucket[s] == zlib.crc32(w.encode()) % 1000 and table.count[s] == words.count(w) for w, s in slots.items())


def resampled_by_hand(docs, target, n, buckets, percent, least):
    def grams(text):
        w = lowered(text)
        return [" ".join(w[i:i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]

    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    source, wanted = Counter(bucket(g) for _, t in docs for g in grams(t)), Counter(bucket(g) for t in target for g in grams(t))
    s_all, t_all = sum(source.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets))))
    rows = []
    for doc, text in docs:
        mine = grams(text)
        weight = sum(gain(bucket(g)) for g in mine)
        h = int(sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(mine), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(lowered(text))])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    place = {id(r): k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return sorted(((*r[:4], place.get(id(r))) for r in rows), key=str)


@pytest.mark.parametrize(("n", "stretch"), [(1, 1 << 20), (3, 1 << 20), (3, 40)])
def test_draw_equals_brute_force(spark, monkeypatch, n, stretch):
    monkeypatch.setattr(terms, "STRETCH_BYTES", stretch)
    rng = np.random.default_rng(2)
    text = lambda k: " ".join(f"W{min(int(rng.geometric(0.1)), 40)}{'é' * int(rng.integers(2))}," for _ in range(k))
    docs = [(k, text(int(rng.integers(0, 40)))) for k in range(150)] + [(900, None), (901, ""), (None, text(30))]
    target = [text(50), None, "w1 w1 w2"]
    got = resampling.resample(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(t,) for t in target], "text string"),
        n=n, buckets=50, percent=30)
    assert sorted((tuple(r) for r in got.collect()), key=str) == resampled_by_hand(docs, target, n, 50, 30, 20)


def test_resample_awkward(spark, awkward, empty):
    target = awkward.select("text").limit(3)
    rows = resampling.resample(awkward, target, percent=100, least_words=1)
    assert rows.count() == awkward.count()
    ranks = sorted(r["rank"] for r in rows.collect() if r["rank"])
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == sum(1 for r in awkward.collect() if lowered(r.text))
    assert resampling.resample(empty, target).count() == 0
    assert resampling.resample(awkward, target.filter("false")).count() == awkward.count()
