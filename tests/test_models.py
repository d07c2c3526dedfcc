import math

import pytest
from pyspark.sql import functions as F

from gristmill.operators import evaluate, filters, langid, ngram_lm
from gristmill.plans.corpus import apply_steps
from gristmill.sources import jsonl, wordlists
from gristmill.streaming.jsonl import read_jsonl_stream, write_jsonl_stream


def frame(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def ids(df):
    return {r["doc_id"] for r in df.collect()}


@pytest.mark.parametrize("ways", ["native", "automaton", "join"])
def test_keywords(spark, ways):
    docs = frame(spark, "class", "CLASS", "bad word here", "", None, "zz")
    words = ["ass", "bad word"] + ([f"unused{i}" for i in range(50)] if ways == "automaton" else [])
    if ways == "join":
        table = spark.createDataFrame([(w,) for w in words], "keyword string")
        kept = filters.sensitive_filter(docs, table, max_keyword_bytes=1)
    else:
        kept = filters.sensitive_filter(docs, words)
    assert ids(kept) == {1, 3, 4, 5}


def test_rules(spark):
    docs = frame(spark, "a" * 128, "a" * 127, "ab.cd!" * 2 + "", ".a" * 64, "!?." * 60, "", None)
    kept = filters.rule_filter(docs, min_length=128)
    assert ids(kept) == {0, 3}
    with pytest.raises(ValueError):
        filters.rule_filter(docs, "en")


def test_language(spark):
    train = spark.createDataFrame(
        [("en", "the cat and the dog"), ("de", "der hund und die katze"), ("en", "this is the end")],
        "lang string, text string")
    model = langid.train_langid(train)
    counted = {(r["lang"], r["gram"]): r["n"] for r in model.collect()}
    assert counted[("en", "the")] == 3 and counted[("de", "und")] == 2
    docs = frame(spark, "the dog", "die katze", "no", "xyz xyz")
    small = {r["doc_id"]: r["language"] for r in langid.detect_language(docs, model).collect()}
    joined = langid.detect_language(docs, model, max_table_rows=0).collect()
    assert small == {r["doc_id"]: r["language"] for r in joined}
    assert small[0] == "en" and small[1] == "de" and 2 not in small
    assert ids(langid.language_filter(docs, "en", model)) >= {0}


@pytest.mark.parametrize("rows,hot", [(1000, 1000), (0, 1000), (0, 2)])
def test_perplexity(spark, rows, hot):
    train = frame(spark, "a b a", "a c")
    docs = frame(spark, "a b", "z", "", "a a a a")
    model = ngram_lm.train_ngram_lm(train)
    probabilities = {(r["context"], r["token"]): r["log10_prob"] for r in model.collect()}
    # N = 7 tokens (a b a </s> a c </s>), V = 4; c(<s>, a) = c(<s>) = 2, one follower.
    p_a = 4 / 12
    assert probabilities[(None, "a")] == pytest.approx(math.log10(p_a))
    assert probabilities[("<s>", "a")] == pytest.approx(math.log10(1.25 / 2 + 0.375 * p_a))
    got = {r["doc_id"]: r["perplexity"]
           for r in ngram_lm.perplexity(docs, model, max_broadcast_rows=rows, min_hot_rows=hot).collect()}

    def log10(h, w):
        if (h, w) in probabilities:
            return probabilities[(h, w)]
        return probabilities.get((h, None), 0.0) + probabilities.get((None, w), probabilities[(None, None)])

    for i, text in enumerate(["a b", "z", "", "a a a a"]):
        words = ["<s>", *text.split(), "</s>"]
        total = sum(log10(h, w) for h, w in zip(words, words[1:]))
        assert got[i] == pytest.approx(10 ** (-total / (len(words) - 1)), abs=0.051)
    for most in (0, 10_000):
        kept = ngram_lm.perplexity_filter(docs, model, got[0], max_broadcast_rows=most)
        assert ids(kept) == {i for i in got if got[i] <= got[0]}


def line(aspect, score, reason="r"):
    return f"【{aspect}】:{reason}【分数】{score}"


def test_scores(spark):
    full = [line(a, i + 3, f"r{i}") for i, a in enumerate(evaluate.ASPECTS)]
    answers = [
        "\n".join(full), "\n".join(full[:4]), "\n".join([*full[:4], line("other", 1)]),
        "\n".join([*full[:4], line(evaluate.ASPECTS[0], 9, "last")]), None,
    ]
    rows = spark.createDataFrame(list(enumerate(answers)), "i int, response string")
    got = [r[0] for r in rows.orderBy("i").select(evaluate.parse_scores("response")).collect()]
    assert [got[0][a]["score"] for a in evaluate.ASPECTS] == [3, 4, 5, 6, 7]
    assert got[0][evaluate.ASPECTS[1]]["reason"] == "r1"
    for bad in (1, 2, 4):
        assert {v["score"] for v in got[bad].values()} == {-1}
    assert got[3][evaluate.ASPECTS[0]]["score"] == 9 and got[3][evaluate.ASPECTS[4]]["score"] == -1


def scored(spark, scores):
    rows = spark.createDataFrame([(s,) for s in scores], "s int")
    value = F.struct(F.lit("").alias("reason"), F.col("s").alias("score"))
    return rows.select(F.create_map(F.lit("x"), value).alias("quality"))


def test_statistics(spark):
    row = evaluate.score_summary(scored(spark, [8, -1, 6])).first()
    assert (row["count"], row["mean"], row["std"], row["min"], row["max"]) == (2, 7.0, 1.0, 6, 8)
    bins = evaluate.score_histogram(scored(spark, list(range(11)))).orderBy("bin").collect()
    assert [r["n"] for r in bins] == [1] * 9 + [2]
    one = evaluate.score_histogram(scored(spark, [4, 4])).collect()
    assert len(one) == 10 and sum(r["n"] for r in one) == 2
    curve = evaluate.score_density(scored(spark, [1, 2, 2, 5])).orderBy("point").collect()
    width = curve[1]["x"] - curve[0]["x"]
    assert len(curve) == 200 and sum(r["density"] for r in curve) * width == pytest.approx(1, abs=0.01)


def test_prompts(spark):
    docs = frame(spark, "one two, three 中文", "short")
    cut = [r[0] for r in docs.select(evaluate.truncate_tokens("text", 5)).collect()]
    assert cut == ["one two, three 中", "short"]
    prompt = evaluate.build_prompts(docs, "<{corpus}>").orderBy("doc_id").first()["prompt"]
    assert prompt == "<one two, three 中文>"
    words = evaluate.word_frequencies(
        frame(spark, "Bee bee cat a the"), spark.createDataFrame([("THE",)], "w string")).collect()
    assert [(r["word"], r["n"], r["weight"]) for r in words] == [("bee", 2, 1.0), ("cat", 1, 0.5)]


def test_files(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('{"doc_id": 1, "text": "é"}\n{broken\n{"doc_id": 2}\n', encoding="utf-8")
    schema = "doc_id bigint, text string"
    got = jsonl.read_jsonl(spark, str(path), schema, "drop", "text").collect()
    assert [(r["doc_id"], r["text"]) for r in got] == [(1, "é"), (2, "")]
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, str(path), schema).collect()
    out = str(tmp_path / "out")
    docs = frame(spark, "é", None)
    assert jsonl.write_guarded(docs, out) and not jsonl.write_guarded(docs, out)
    assert not jsonl.write_guarded(docs.limit(0), str(tmp_path / "empty"))
    assert not (tmp_path / "empty").exists()
    assert jsonl.write_guarded(docs.limit(1), out, from_scratch=True)
    lines = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("part*"))
    assert '"text":"é"' in lines


@pytest.mark.parametrize("charset", ["UTF-8", "GBK", "UTF-16", "UTF-16LE"])
def test_wordlists(spark, tmp_path, charset):
    (tmp_path / "a.txt").write_bytes(" bad word, \n\n坏,,\n".encode(charset))
    (tmp_path / "b.txt").write_bytes('坏\n"quoted"\r\nvery\x01odd\n'.encode(charset))
    (tmp_path / "c.csv").write_bytes(b"ignored\n")
    got = {r["keyword"] for r in wordlists.load_keywords(spark, str(tmp_path), charset).collect()}
    assert got == {"bad word", "坏", '"quoted"', "very\x01odd"}


def test_steps_and_checks(spark, tmp_path):
    docs = frame(spark, "a\n" * 2, "A text", "A text")
    checks = str(tmp_path / "checks")
    out = apply_steps(docs, checks=checks)
    assert {r["doc_id"]: r["text"] for r in out.collect()}[2] == ""
    saved = spark.read.parquet(f"{checks}/1_dedup_document_checks").collect()
    assert [(r["doc_id"], r["old_text"]) for r in saved] == [(2, "A text")]


def test_rowwise_steps_on_a_stream(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    jsonl.write_jsonl(frame(spark, "mail a@b.com now", "x" * 130), source)
    stream = read_jsonl_stream(spark, source, "doc_id bigint, text string")
    from gristmill.operators.pii import run_pii
    cleaned = filters.rule_filter(run_pii(stream), min_length=10)
    write_jsonl_stream(cleaned, sink, str(tmp_path / "log")).awaitTermination()
    got = {r["doc_id"]: r["text"] for r in spark.read.json(sink).collect()}
    assert got == {0: "mail PI:EMAIL now", 1: "x" * 130}


def test_language_filter_paths_agree_and_the_small_one_has_no_join(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train_langid(docs)
    near = langid.language_filter(docs, "de", model)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    far = langid.language_filter(docs, "de", model, max_table_rows=0)
    assert {r.doc_id for r in near.collect()} == {r.doc_id for r in far.collect()} != set()
    assert langid.language_filter(docs, "xx", model).count() == 0
