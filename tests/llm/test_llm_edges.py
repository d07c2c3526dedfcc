"""Awkward rows, empty tables and small brute-force comparisons of each operator."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from gristmill.llm import (
    byte_cnn, chat, decontaminate, jaccard, lines, mixing, neighbours, quality, repeats, token_file,
)
from conftest_paths import SMALL
from test_llm_queries import repeats_by_hand


# Chat formatting

@given(st.text(alphabet="\\<>/s[]INSTrole \n") | st.text())
@settings(deadline=None, max_examples=200)
def test_escapes_are_reversible_and_hide_control_strings(text):
    escaped = chat.DEFAULT.escape(text)
    assert chat.DEFAULT.unescape(escaped) == text
    assert not any(c in escaped for c in chat.DEFAULT.controls)


def test_chat_order_and_awkward_rows(spark):
    rows = [
        (1, 0, "user", "a"), (1, 1, "assistant", None), (2, 0, "assistant", "first"), (3, 0, "user", "x"), (3, 0, "user", "x"),
        (4, None, None, "no role"), (None, 1, "user", "no id"), (5, 1, "narrator</role>", "<end>"), (6, 0, "system", ""), (6, 1, "user", "q"),
        (6, 2, "assistant", "y" * 100_000),
    ]
    turns = spark.createDataFrame([(*r, 1, 1) for r in rows], "conv_id long, turn long, role string, text string, segment int, loss int")
    segments = chat.format_chat(turns)
    assert segments.count() == 3 * len(rows)
    read = {r.conv_id: r for r in chat.read_back(segments).collect()}
    assert {k: r.n_turns for k, r in read.items()} == {1: 2, 2: 1, 3: 2, 4: 1, None: 1, 5: 1, 6: 3}
    assert {k for k, r in read.items() if r.in_order} == {1, None, 6}
    assert read[6].loss_chars == 100_000 and read[5].loss_chars == 0
    none = turns.filter("false")
    assert chat.read_back(chat.format_chat(none)).count() == 0


def test_templates_whose_marks_overlap_are_refused():
    with pytest.raises(ValueError):
        chat.Template({"user": ("aba", "x")}, ("r", "s", "t"), frozenset(), {})


# Jaccard join

def _jaccard_by_hand(docs):
    sets = {}
    for i, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        n = max(1, len(words) - 4)
        sets[i] = {tuple(words[k:k + 5]) for k in range(n)} if words else set()
    root = {i: i for i in docs}
    for _ in docs:
        for a in docs:
            for b in docs:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    return {i: (len(sets[i]), root[i]) for i in docs}


def test_jaccard_matches_brute_force_around_the_threshold(spark, monkeypatch):
    rng = np.random.default_rng(1)
    docs, k = {}, 0
    for base in range(5):
        words = [f"w{base}x{i}" for i in range(int(rng.integers(4, 120)))]
        for _ in range(9):
            mine = list(words)
            for _ in range(int(rng.integers(0, 6))):
                mine[int(rng.integers(len(mine)))] = f"n{rng.integers(10**6)}"
            docs[k := k + 1] = " ".join(mine).upper() if k % 3 else " ".join(mine)
    docs |= {900: None, 901: "", 902: "one", 903: "ONE", 904: "  \t\n"}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    want = _jaccard_by_hand(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.ngram_jaccard(frame).collect()} == want
    # Blocks that are dealt over tasks give the same classes.
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 150)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.ngram_jaccard(frame).collect()} == want


def test_jaccard_awkward(spark, awkward, empty):
    got = [(r.doc_id, r.component_id) for r in jaccard.ngram_jaccard(awkward).collect()]
    assert len(got) == awkward.count()
    assert dict(got)[2] == 1 and dict(got)[6] == 5 and dict(got)[14] == 13 and dict(got)[3] == 3
    assert [c for d, c in got if d is None] == [None, None]
    assert jaccard.ngram_jaccard(empty).count() == 0


# Token files

def test_token_files_awkward(spark, awkward, empty, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_file, "SHARD_IDS", 100)
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = token_file.read_token_files(spark, token_file.write_token_files(awkward, path)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted([r.doc_id for r in awkward.collect()], key=lambda d: (d is not None, d or 0))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    words = token_file.WordIds(tokenizer, 2)
    for text in ["", " ", "  a  b ", "a\n b \n\nc", "x <|endoftext|> y'", " \u3000 a\x1c b", "it's 's 't x's", "a.. b,, c!!! d.\ne", "é ñ 中 文",
                 "tab\tx \x85 y", "1st 2nd x1 1x", "don't. 'll ", "\u01c5 \u0301x"]:
        assert np.frombuffer(words([text])[0], np.uint16).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert token_file.read_token_files(spark, token_file.write_token_files(empty, path)).count() == 0


@given(st.lists(st.integers(0, 5000), max_size=400))
@settings(deadline=None)
def test_elias_fano_round_trip(steps):
    values = np.cumsum(steps).tolist()
    held, used = token_file.EliasFano.from_bytes(token_file.EliasFano.encode(np.array(values, np.uint64)).to_bytes())
    assert held.all().tolist() == values
    assert [held.select(i) for i in range(len(values))] == values


# Repeats

@pytest.mark.parametrize("block", [512 << 10, 300])
def test_repeats_match_brute_force_on_small_lengths(spark, monkeypatch, block):
    monkeypatch.setattr(repeats, "BLOCK", block)
    rng = np.random.default_rng(4)
    shared = bytes(rng.integers(97, 123, 120, np.uint8)).decode()
    texts = []
    for _ in range(30):
        own = bytes(rng.integers(97, 123, int(rng.integers(0, 300)), np.uint8)).decode()
        a, b = sorted(rng.integers(0, 121, 2))
        texts.append(own[:50] + shared[a:b] + own[50:])
    texts += [texts[0], "ab" * 200, "\0" * 200, "é" * 90, "", None, "x" * 31]
    frame = spark.createDataFrame([(1, t) for t in texts], "doc_id long, text string")
    got = sorted((r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans)) for r in repeats.remove_repeats(frame, 40).collect())
    want = repeats_by_hand([(t or "").encode() for t in texts], 40)
    assert got == sorted(w[:3] for w in want)


def test_repeats_awkward(spark, awkward, empty):
    rows = repeats.remove_repeats(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r.doc_id: len(r.kept) for r in rows if r.doc_id in (5, 6)} == {5: 0, 6: 3}
    assert repeats.remove_repeats(empty).count() == 0


# Mixing

def test_mixing_awkward(spark, awkward, empty):
    rows = mixing.mix_sources(awkward).toPandas()
    assert len(rows) == awkward.count() and (rows["taken"] <= 2 * rows["size"]).all()
    assert rows["target"].sum() > 0 and mixing.mix_sources(empty).count() == 0
    assert rows.sort_values(list(rows)).equals(mixing.mix_sources(awkward.repartition(5)).toPandas().sort_values(list(rows))) or (
        sorted(map(str, rows.itertuples(index=False))) == sorted(map(str, mixing.mix_sources(awkward.repartition(5)).toPandas().itertuples(index=False))))


# Models

def test_models_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (2, 1), (12, 0), (None, 1), (77, 0), (9, None)], "doc_id long, quality int")
    model = quality.train_quality(awkward, labels)
    rows = quality.score_quality(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    untrained = quality.train_quality(empty, labels)
    assert quality.score_quality(empty, untrained).count() == 0
    assert quality.keep_quality(awkward, model).columns == awkward.columns
    network = byte_cnn.train_language_id(awkward, awkward["doc_id"] > 0)
    found = [(r.doc_id, r.lang_pred, r.score) for r in byte_cnn.predict_language(awkward, network).collect()]
    assert len(found) == awkward.count()
    assert {p for d, p, _ in found if d in (3, 4, 8, 12)} == {"und"} and all(0 <= s <= 1 for _, _, s in found)
    nothing = byte_cnn.train_language_id(empty, empty["doc_id"] > 0)
    assert {r.lang_pred for r in byte_cnn.predict_language(awkward, nothing).collect()} == {"und"}


# Neighbours

def test_neighbours_awkward(spark):
    bad = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (None, [1.0, 1.0])]
    good = [(10 + i, [1.0, float(i % 4)]) for i in range(12)] + [(10, [1.0, 0.0])]
    frame = spark.createDataFrame([(*r, 5) for r in bad + good], "vec_id long, embedding array<float>, score int")
    asked = frame.select("vec_id")
    rows = neighbours.nearest(frame, asked).collect()
    assert {r.query_id for r in rows} == set(range(10, 22)) and len(rows) == 12 * 11
    first = sorted((r["rank"], r.vec_id, r.score) for r in rows if r.query_id == 10)
    assert [f[1] for f in first] == list(range(11, 22)) and {f[2] for f in first} == {1.0}
    assert [r.vec_id for r in rows if r.query_id == 13 and r["rank"] <= 2] == [17, 21]
    assert neighbours.nearest(frame.filter("false"), asked).count() == 0


def neighbours_recall(spark, x):
    """Share of the true 20 nearest that 100 queries get."""
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = {}
    for r in neighbours.nearest(frame, frame.filter(f"vec_id % {len(x) // 100} = 0").select("vec_id")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for i, mine in found.items():
        scores = x @ x[i]
        scores[i] = -np.inf
        hits.append(len(set(np.argsort(-scores)[:20].tolist()) & mine) / 20)
    return np.mean(hits)


def unit_vectors(n, centres, noise, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(centres, 64))[rng.integers(centres, size=n)] + noise * rng.normal(size=(n, 64))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_leaves_above_the_bound_are_split_differently_in_each_tree(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 100)
    x = unit_vectors(3000, 1, 0.1, 3)
    nodes = neighbours.stage(spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(x)], "_node long, _vec binary"), "nodes")
    trees = neighbours._Trees(x[:40], 1, 64)
    leaves = nodes.mapInArrow(neighbours._Leaves(trees, "<f4"), "_group long, _node long, _vec binary")
    rows = neighbours._split(leaves, nodes, 1, "<f4").select("_group", "_node").collect()
    groups, pairs = {}, {}
    for r in rows:
        groups.setdefault(r._group, []).append(r._node)
    assert max(map(len, groups.values())) <= 100 and len(rows) == 3000 * neighbours.TREES
    assert len({(r._group >> 40, r._node) for r in rows}) == len(rows)
    for g, members in groups.items():
        if 0 in members:
            pairs[g >> 40] = set(members) - {0}
    assert len(pairs) == neighbours.TREES and len(set.union(*pairs.values())) > 3 * max(map(len, pairs.values()))


@pytest.mark.parametrize("n", [2000, 6000])
def test_neighbours_recall_on_tables_many_times_a_leaf(spark, monkeypatch, n):
    monkeypatch.setattr(neighbours, "LEAF", 100)
    monkeypatch.setattr(neighbours, "TREE_SAMPLE", 400)
    assert neighbours_recall(spark, unit_vectors(n, n // 1000, 1.0, 4)) >= 0.9


# Decontamination

def test_edit_distance_is_exact():
    def by_hand(item, text):
        row = [0] * (len(text) + 1)
        for i, a in enumerate(item, 1):
            new = [i]
            for j, b in enumerate(text, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (a != b)))
            row = new
        return min(row)

    rng = np.random.default_rng(2)
    for _ in range(200):
        item = bytes(rng.integers(97, 100, int(rng.integers(1, 12)), np.uint8))
        text = bytes(rng.integers(97, 100, int(rng.integers(0, 20)), np.uint8))
        assert decontaminate.edit_end(item, text)[0] == by_hand(item, text)


def test_edited_items_are_found_and_clean_texts_are_not(spark, awkward, empty):
    rng = np.random.default_rng(6)
    words = lambda n: " ".join("".join(map(chr, rng.integers(97, 123, 6))) for _ in range(n))
    items = [(i, words(30)) for i in range(40)] + [(90, None), (91, ""), (92, "tiny item")]
    rows, want = [], set()
    for i, text in items[:40]:
        changed = list(text)
        for _ in range(i % 20):
            changed[int(rng.integers(len(changed)))] = "#"
        rows.append((i, words(50) + " " + "".join(changed).upper() + " " + words(50)))
        want.add((i, i))
    rows += [(100 + i, words(200)) for i in range(40)] + [(200, "a TINY\titem here"), (201, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    loaded = decontaminate.load_items(benchmark)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_items(docs, loaded).collect()}
    assert found <= want | {(200, 92)} and (200, 92) in found and len(want - found) <= 1
    assert decontaminate.find_items(empty, loaded).count() == 0
    assert decontaminate.drop_contaminated(awkward, loaded).count() == awkward.count()
    none = decontaminate.load_items(benchmark.filter("false"))
    assert decontaminate.find_items(docs, none).count() == 0


@pytest.mark.parametrize("size", [7, 13, 14, 20, 24, 30, 50, 100, 300])
def test_all_edits_at_the_limit_are_found(size):
    rng = np.random.default_rng(size)
    letters = lambda n: bytes(rng.integers(97, 123, n, np.uint8))
    texts = [letters(size) for _ in range(20)]
    items, most = decontaminate.Items(list(range(20)), [t.decode() for t in texts], 15), size * 15 // 100
    rows = []
    for text in texts:
        even, mixed = bytearray(text), bytearray(text)
        for k in range(most):
            even[(2 * k + 1) * size // (2 * most)] = 35
            at = int(rng.integers(len(mixed)))
            mixed[at:at + int(rng.integers(2))] = b"#" * int(rng.integers(2))
        rows += [letters(50) + bytes(even) + letters(50), bytes(even), letters(50) + bytes(mixed) + letters(50)]
    offsets = np.cumsum([0] + [len(r) for r in rows])
    found = {(r, i): d for r, i, d, _ in items.find(np.frombuffer(b"".join(rows), np.uint8), offsets)}
    assert all(found.get((k, k // 3), size) <= most for k in range(len(rows)))
    assert all(d == decontaminate.edit_end(texts[i], rows[r])[0] for (r, i), d in found.items())


# Lines

def test_lines_awkward(spark, awkward, empty):
    rows = {r.doc_id: r for r in lines.delete_repeated_lines(awkward).collect()}
    assert rows[15].text == "a\n\nb\nc\nd\n" and [tuple(r) for r in rows[15].runs] == [(5, 2)]
    assert rows[4].text is None and rows[3].text == "" and rows[3].n_lines == 0
    assert lines.delete_repeated_lines(empty).count() == 0


# Pipeline

def test_pipeline_stages_chain(spark, awkward, empty):
    for start in (awkward, empty):
        docs = start
        for name, function in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.stage(function(spark, docs, SMALL), name)
            assert docs.columns == start.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count()


def test_pipeline_keeps_clean_documents_and_drops_the_rest(spark):
    import duckdb

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, SMALL).select("doc_id").collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SMALL}/labels.parquet'").fetchall()
    assert all((d in kept) == bool(q) for d, q in labels)
    classes = {r.doc_id: r.component_id for r in jaccard.ngram_jaccard(docs).collect()}
    single = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, SMALL).select("doc_id").collect()}
    assert single == {d for d, c in classes.items() if d == c}
    assert corpus_pipeline.run(spark, SMALL).count() > 0
