"""Registered queries against their SQL, or against brute force where SQL cannot say it."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from conftest_paths import LARGER, SMALL
from oracle import compare, database
from tokenizers import Tokenizer

from gristmill.llm.queries import QUERIES


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_sql(spark, name):
    function, sql = QUERIES[name]
    assert compare(spark, database(SMALL), name, function, sql, SMALL).startswith("ok")


def _documents(folder=SMALL):
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall())


def test_token_files_hold_what_the_library_encodes(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op3_token_file"][0](spark, SMALL).collect()}
    at, want = 0, {}
    for doc_id, text in _documents().items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want[doc_id] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == want


def repeats_by_hand(texts, length):
    seen, out = {}, []
    for text in texts:
        for i in range(len(text) - length + 1):
            seen[text[i:i + length]] = seen.get(text[i:i + length], 0) + 1
    for text in texts:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if seen[text[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_match_brute_force(spark):
    docs = _documents()
    want = dict(zip(docs, repeats_by_hand([(t or "").encode() for t in docs.values()], 400)))
    rows = QUERIES["op4_repeats"][0](spark, SMALL).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
    assert sum(w[1] for w in want.values()) > 0


def test_mix_comes_near_its_targets(spark):
    rows = QUERIES["op5_mixing"][0](spark, LARGER).toPandas()
    assert (rows["taken"] <= 2 * rows["size"]).all() and (rows["copies"] * rows["size"] == rows["taken"]).all()
    by = rows.groupby(["source_size", "target"])["taken"].sum().reset_index()
    assert (abs(by["taken"] - by["target"]) / by["target"]).max() < 0.02
    assert by["target"].sum() == pytest.approx(1.5 * by["source_size"].sum())


@pytest.mark.parametrize(
    ("name", "column", "sql", "modulus", "rest"),
    [
        ("op6_quality", "predicted", f"SELECT doc_id, quality FROM '{LARGER}/labels.parquet'", 3, 1),
        ("op9_language_id", "lang_pred", f"SELECT doc_id, lang FROM '{LARGER}/documents.parquet'", 4, 2),
    ],
)
def test_held_out_accuracy(spark, name, column, sql, modulus, rest):
    truth = dict(duckdb.sql(sql).fetchall())
    rows = QUERIES[name][0](spark, LARGER).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest) for r in rows)
    held = [(r[column], truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and sum(a == b for a, b in held) / len(held) >= 0.97


def test_neighbours_recall(spark):
    found = {}
    for r in QUERIES["op7_neighbours"][0](spark, LARGER).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{LARGER}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    hits = []
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        mine = sorted(found[int(ids[i])])
        assert [m[0] for m in mine] == list(range(1, 21))
        assert all(abs(s - scores[np.searchsorted(ids, v)]) < 1e-12 for _, v, s in mine)
        hits.append(len(best & {v for _, v, _ in mine}) / 20)
    assert len(hits) == len(found) and np.mean(hits) >= 0.9


def test_items_that_stand_in_documents_are_found(spark):
    found = {(r.doc_id, r.item_id) for r in QUERIES["op8_decontaminate"][0](spark, LARGER).collect()}
    items = duckdb.sql(f"SELECT item_id, text FROM '{LARGER}/benchmark.parquet'").fetchall()
    exact = {(d, i) for d, text in _documents(LARGER).items() for i, item in items if item in (text or "")}
    assert exact and exact <= found and len(found) < 1.2 * len(exact)
