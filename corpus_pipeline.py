"""The training-data pipeline: stages over documents, each written and read again.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows of ``docs`` and returns a
DataFrame; all but the last return the columns of ``documents``. A stage tells nothing to
the next one but its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import decontaminate, jaccard, mixing, quality, token_file
from gristmill.llm.blocks import join_ids
from gristmill.staging import stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects (score below 0.5).

    Null and empty texts are scored like others; repeated rows stay or go together.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_quality(docs, quality.train_quality(docs, labels))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every class of near copies.

    Rows without an id are kept: they are in no class. Rows that share an id are told
    apart by nothing, so all of them stay or go.
    """
    classes = jaccard.ngram_jaccard(docs)
    later = stage(classes.filter("doc_id <> component_id").select("doc_id").distinct(), "later")
    return join_ids(docs, later, "doc_id", "left_anti").select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item.

    Null and empty texts hold none and stay; repeated rows stay or go together.
    """
    items = decontaminate.load_items(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontaminate.drop_contaminated(docs, items)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it, 0 to 2 times.

    A document without words adds nothing to the mix and is dropped; null and empty texts
    are such. Rows without an id go by a hash of their content, so equal ones are taken
    equally often, as are rows that share an id.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text", "source", "lang"))
    keyed = docs.select(key.alias("_mix_id"), F.struct(*docs.columns).alias("_row"))
    mixed = mixing.mix_sources(
        keyed.select("_mix_id", F.col("_row.text").alias("text"), F.col("_row.source").alias("source")), id_col="_mix_id")
    copies = stage(mixed.filter("copies > 0").groupBy("doc_id").agg(F.max("copies").alias("_copies")), "copies")
    times = copies.select(
        F.col("doc_id").alias("_mix_id"), F.array_repeat(F.lit(0), F.col("_copies").cast("int")).alias("_times"))
    taken = join_ids(keyed, times, "_mix_id").select("_row", F.explode("_times"))
    return taken.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns what they hold, document by document.

    A null or empty text has the end id alone; repeated rows are documents of their own.
    """
    # The path of the tokenizer file is a parameter; its module is needed by this stage only.
    import public_tokenizers

    folder = token_file.write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return token_file.read_token_files(spark, folder)


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mixing_sources", mixing_stage),
    ("token_output", token_stage),
]

#: Trained models and similarity classes cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the whole table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
