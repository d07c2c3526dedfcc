import random

import pytest
from pyspark.sql import functions as F

from gristmill.functions import urls
from gristmill.operators import exact, fuzzy, plumbing, reports
from gristmill.operators.components import connected_components
from gristmill.operators.skew import join_groups
from gristmill.plans.corpus import apply_steps
from gristmill.staging import spread


def frame(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def texts(df, key="doc_id"):
    return {r[key]: r["text"] for r in df.collect()}


def components(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("hot", [1_000_000, 5])
@pytest.mark.parametrize("shape", ["random", "path", "hub"])
def test_components(spark, shape, hot):
    rng = random.Random(1)
    edges = {
        "random": [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)],
        "path": [(i, i + 1) for i in range(60)],
        "hub": [(99, i) for i in range(100, 200)] + [(7, 99), (8, 150)],
    }[shape]
    edges = [(u, v) for u, v in edges if u != v]
    table = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(table, "a", "b", hot).collect()}
    assert got == components(edges)


def test_hot_groups_are_split(spark):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    groups = rows.groupBy("k").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    got = join_groups(rows, groups, ["k"], "n", ["id"], min_hot_rows=100)
    plain = rows.join(groups.drop("n"), "k")
    assert got.columns == plain.columns
    assert sorted(got.collect()) == sorted(plain.collect())


def test_hot_bucket_edges(spark):
    banded = spark.range(500).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("band"),
        F.when(F.col("id") < 300, "same").otherwise(F.col("id").cast("string")).alias("band_key"))
    got = fuzzy.lsh_edges(banded, min_hot_rows=10)
    assert {(r["src"], r["dst"]) for r in got.collect()} == {(i, 0) for i in range(1, 300)}


def test_fuzzy(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from the hunter"
    docs = frame(spark, base, base + ".", "short", "tiny text", "quite another text with more than five words")
    kept = {r["doc_id"]: r["cluster"] for r in fuzzy.fuzzy_dedup(docs).collect()}
    assert kept == {0: 0, 2: 2, 4: 4}
    alone = {r["doc_id"] for r in fuzzy.fuzzy_dedup(docs, short_docs="keep").collect()}
    assert alone == {0, 2, 3, 4}
    dropped = {r["doc_id"]: r["cluster"] for r in fuzzy.fuzzy_duplicates(docs).collect()}
    assert dropped == {1: 0, 3: 2}
    han = frame(spark, "天地玄黄宇宙洪荒", "日月盈昃辰宿列张")
    assert fuzzy.fuzzy_dedup(han).count() == 1
    assert fuzzy.fuzzy_dedup(han, tokenizer="unicode").count() == 2


@pytest.mark.parametrize("hot", [1_000_000, 3])
def test_template_lines(spark, hot):
    docs = frame(spark, " menu \na\nb", "menu\nb", "menu", "c\n\nd", "menu\nmenu")
    got = exact.remove_template_lines(docs, 2, 3, min_hot_rows=hot)
    assert texts(got) == {0: "a\nb", 1: "b", 2: "", 3: "c\n\nd", 4: ""}
    assert texts(exact.remove_template_lines(docs, 0, 2, min_hot_rows=hot)) == {
        0: "a", 1: "", 2: "", 3: "c\n\nd", 4: ""}


def test_exact(spark):
    docs = frame(spark, "Hello, 1!", "Hello 2", "other", "", None)
    assert texts(exact.dedup_document(docs)) == {0: "Hello, 1!", 1: "", 2: "other", 3: "", 4: ""}
    assert set(texts(exact.dedup_document(docs, mode="drop"))) == {0, 2, 3}
    once = exact.dedup_document(docs)
    assert texts(exact.dedup_document(once)) == texts(once)
    with pytest.raises(NotImplementedError):
        exact.apply_step(docs, "no_such_step")


def test_url_keys(spark):
    rows = spark.createDataFrame([
        (0, "https://x.com/a?p=1"), (1, "https://x.com/news/foo/amp"), (2, "https://x.com/ample/foo"),
        (3, "HTTP://h/p?news-id=7&x=1#f"), (4, "http://h/p?id=a+b%2Fc&id=&id=%zz~*"),
    ], "i int, url string")
    got = rows.select(
        urls.without_query("url"), urls.without_amp("url"),
        urls.with_query_parameters("url", urls.QUERY_PARAMETERS),
        urls.with_query_parameters("url"),
    ).collect()
    assert got[0][0] == "https://x.com/a"
    assert got[1][1] == "https://x.com/news/foo" and got[2][1] == "https://x.com"
    assert got[3][2] == "http://h/p?id=7#f" and got[3][3] == "http://h/p#f"
    assert got[4][2] == "http://h/p?id=a+b%2Fc&id=%25zz~%2A"


def test_segments(spark):
    rows = spark.createDataFrame(
        [("a_id_10", "ten"), ("a_id_2", "two"), ("b_id_1", "x")], "id string, text string")
    assert texts(exact.concat_segments(rows), "id") == {"a": "two\nten", "b": "x"}
    named = rows.toDF("doc_id", "text")
    after = apply_steps(named, ["concat_segments", "dedup_document"])
    assert texts(after, "doc_id") == {"a": "two\nten", "b": "x"}


def test_columns_side_by_side_need_both_sides(spark):
    two = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id int, x string")
    same = spark.createDataFrame([(2, "d"), (1, "c")], "doc_id int, y string")
    assert sorted(map(tuple, plumbing.concat_columns(two, same).collect())) == [(1, "a", "c"), (2, "b", "d")]
    for left, right in ((two, same.limit(1)), (two.limit(1), same)):
        with pytest.raises(Exception, match="one side only"):
            plumbing.concat_columns(left, right).collect()


def test_spreading_starts_no_job(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(100).write.parquet(path)
    rows = spark.read.parquet(path)
    grouped = rows.join(rows.groupBy("id").count(), "id")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("spread", "")
    spread(grouped)
    assert not tracker.getJobIdsForGroup("spread")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_plumbing(spark):
    names = spark.createDataFrame([("c/lm_zh-cn_x",), ("c/lm_zht_x",), ("c/lm_en_x/data",)], "n string")
    got = [r[0] for r in names.select(plumbing.catalogue_language("n")).collect()]
    assert got == ["zhs", "zht", "en"]
    bad = spark.createDataFrame([("c/lm_zhx_x",)], "n string")
    with pytest.raises(Exception, match="zhx"):
        bad.select(plumbing.catalogue_language("n")).collect()
    rows = spark.range(100).withColumnRenamed("id", "doc_id")
    sample = plumbing.sample_rows(rows, 10).collect()
    assert len(sample) == 10 and sample == plumbing.sample_rows(rows, 10).collect()
    assert plumbing.sample_rows(rows, 1000).count() == 100
    numbered = plumbing.add_row_index(rows.repartition(7), ["doc_id"]).collect()
    assert all(r["doc_id"] == r["row_index"] for r in numbered)


def test_reports(spark):
    docs = frame(spark, "abc", "é", "abc")
    after = exact.dedup_document(docs)
    changed = reports.modified_documents(docs, after).collect()
    assert [(r["doc_id"], r["old_text"], r["text"]) for r in changed] == [(2, "abc", "")]
    with pytest.raises(Exception, match="one side only"):
        reports.modified_documents(docs, docs.limit(1)).collect()
    row = reports.step_report(docs, after).first()
    assert (row["bytes_before"], row["bytes_after"], row["rows_removed"]) == (8, 5, 0)
    assert reports.estimate_size(docs).first()["bytes"] == 8.0
