"""Registered queries of this subpackage: name -> (function of session and folder, SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import (
    byte_cnn, chat, decontaminate, jaccard, lines, mixing, neighbours, quality, ranked, repeats, resampling, rules, token_file,
)
from gristmill.staging import stage


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _remainder(modulus: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


#: A conversation that says the template's own control strings.
AWKWARD = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    extra = spark.sql(
        f"SELECT -7L AS conv_id, turn, role, '{AWKWARD}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    turns = _table(spark, folder, "conversations").select(columns).unionByName(extra)
    segments = stage(chat.format_chat(turns), "segments")
    return chat.read_back(segments)


def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.ngram_jaccard(_table(spark, folder, "documents"))


def op3_token_file(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    written = token_file.write_token_files(
        _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_file.read_token_files(spark, written)


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = _remainder(3) == 1
    labels = _table(spark, folder, "labels").filter(~held_out)
    model = quality.train_quality(docs, labels.select("doc_id", "quality"))
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op4_repeats(spark: SparkSession, folder: str) -> DataFrame:
    left = repeats.remove_repeats(_table(spark, folder, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return left.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents"))


def op7_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    return neighbours.nearest(rows, rows.filter("vec_id % 20 = 0").select("vec_id"))


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    items = decontaminate.load_items(_table(spark, folder, "benchmark"))
    return decontaminate.find_items(_table(spark, folder, "documents"), items)


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = _remainder(4) == 2
    model = byte_cnn.train_language_id(docs, ~held_out)
    found = byte_cnn.predict_language(docs, model)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = lines.delete_repeated_lines(_table(spark, folder, "documents"))
    gone = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["n_lines"])
    return left.select(
        "doc_id", "n_lines", gone.alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.rank_documents(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    forest = rules.train_rules(docs, _table(spark, folder, "labels"))
    return rules.apply_rules(docs, forest).drop("path")


def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES = {
    "op7_neighbours": (op7_neighbours, None),
    "op10_line_dedup": (op10_line_dedup, lines.lines_sql()),
    "op9_language_id": (op9_language_id, None),
    "op1_chat_format": (op1_chat_format, chat.chat_sql(
        "SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -7, t, r, x FROM (VALUES "
        f"(0, 'user', '{AWKWARD}'), (1, 'assistant', '{AWKWARD}')) v(t, r, x)")),
    "op8_decontaminate": (op8_decontaminate, None),
    "op2_ngram_jaccard": (op2_ngram_jaccard, jaccard.jaccard_sql()),
    "op3_token_file": (op3_token_file, None),
    "op6_quality": (op6_quality, None),
    "op4_repeats": (op4_repeats, None),
    "op5_mixing": (op5_mixing, mixing.mixing_sql()),
    "op11_ranked_search": (op11_ranked_search, ranked.ranked_sql()),
    "op12_quality_rules": (op12_quality_rules, None),
    "op13_resampling": (op13_resampling, resampling.resample_sql()),
}
