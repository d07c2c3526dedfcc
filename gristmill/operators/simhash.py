"""Near-duplicate removal by SimHash: signed bit sums, a Hamming-ball join, connected components."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import shingles
from gristmill.operators.components import connected_components
from gristmill.operators.skew import MIN_HOT_ROWS, join_groups
from gristmill.staging import spread, stage

# ---- fixed values --------------------------------------------------------
DEFAULT_NGRAM = 3
DEFAULT_BITS = 64
DEFAULT_BIT_DIFF = 3
DEFAULT_BUCKETS = 4
# ---- end of fixed values -------------------------------------------------

# Signatures that one key is expected to hold at most; more lead to more, wider keys.
KEY_ROWS = 64
# A key that holds more than this is divided by further bits.
MOST_KEY_ROWS = 4096
MOST_BLOCKS = 7


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(positions: list[int], blocks: int, open_: int) -> list[int]:
    """Masks of all choices of ``blocks - open_`` of the blocks that the positions are cut into.

    Two numbers that differ in at most ``open_`` of the positions agree under one of them.
    """
    cuts = [len(positions) * k // blocks for k in range(blocks + 1)]
    parts = [sum(1 << p for p in positions[a:b]) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - open_)]


def blocks_for(rows: int, bit_diff: int, num_bucket: int) -> int:
    """The least number of blocks, ``num_bucket`` or more, whose keys hold about ``KEY_ROWS`` signatures."""
    for blocks in range(num_bucket, max(num_bucket, MOST_BLOCKS) + 1):
        width = min(m.bit_count() for m in _masks(list(range(DEFAULT_BITS)), blocks, bit_diff))
        if rows <= KEY_ROWS << width:
            break
    return blocks


def simhash_signatures(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ngram: int = DEFAULT_NGRAM,
    tokenizer: str = "ascii",
) -> DataFrame:
    """``(id, signature)`` of the texts with a word; the signature is a 64-bit integer.

    Bit k is set when it is set in more than half of the hashes of the n-grams, repeats
    counted, that is when the signed sum of the bit is positive. Bits are counted in the
    row of a text; rows that share an id are one document, whose counts are added.
    """
    texts = df.filter(F.col(id_col).isNotNull() & F.col(text_col).rlike(r"(?U)\w"))
    counted = texts.select(
        id_col, shingles.bit_counts(shingles.spaced_tokens(text_col, tokenizer), ngram).alias("_counts"))
    bits = range(DEFAULT_BITS)
    sums = counted.groupBy(id_col).agg(
        F.sum(F.col("_counts")[0]).alias("_n"), *[F.sum(F.col("_counts")[k + 1]).alias(f"_bit{k}") for k in bits])
    signature = F.lit(0).cast("bigint")
    for k in bits:
        signature = signature.bitwiseOR(F.when(F.col(f"_bit{k}") * 2 > F.col("_n"), F.lit(_signed(1 << k))).otherwise(F.lit(0)))
    return sums.select(id_col, signature.alias("signature"))


def _pairs(keyed: DataFrame, keys: list[str], bit_diff: int) -> DataFrame:
    left = keyed.select(*keys, F.col("_id").alias("src"), F.col("signature").alias("_a"))
    right = keyed.select(*keys, F.col("_id").alias("dst"), F.col("signature").alias("_b"))
    near = F.bit_count(F.col("_a").bitwiseXOR(F.col("_b"))) <= bit_diff
    return left.join(right, keys).filter((F.col("_a") < F.col("_b")) & near).select("src", "dst")


def hamming_pairs(
    signatures: DataFrame, bit_diff: int = DEFAULT_BIT_DIFF, num_bucket: int = DEFAULT_BUCKETS,
    most_key_rows: int = MOST_KEY_ROWS,
) -> DataFrame:
    """``(src, dst)`` of all signatures (``_id``, ``signature``; distinct) within ``bit_diff`` bits.

    Signatures are cut into blocks; of those within ``bit_diff`` bits, all but that many
    blocks are equal. One key is made per choice of the equal blocks, and the number of
    blocks grows with the table, so that a key stays wide enough to hold few signatures. A
    key that holds many all the same is divided by the same rule over its remaining bits.
    Every pair found is verified. No pair is lost at any size.
    """
    if num_bucket <= bit_diff:
        raise ValueError("more buckets than differing bits are needed")
    signatures = stage(signatures, "signatures")
    blocks = blocks_for(signatures.count(), bit_diff, num_bucket)
    every = list(range(DEFAULT_BITS))
    masks = _masks(every, blocks, bit_diff)
    choices = F.array(*[F.lit(_signed(m)) for m in masks])
    keyed = signatures.select("_id", "signature", F.posexplode(choices).alias("_choice", "_mask")).select(
        "_id", "signature", "_choice", F.col("signature").bitwiseAND(F.col("_mask")).alias("_key"))
    full = keyed.groupBy("_choice", "_key").agg(F.count("*").alias("_n")).filter(F.col("_n") > most_key_rows)
    full = stage(full, "full-keys")
    if full.isEmpty():
        return _pairs(keyed, ["_choice", "_key"], bit_diff).distinct()
    marked = keyed.join(full.withColumn("_full", F.lit(True)).drop("_n"), ["_choice", "_key"], "left")
    marked = stage(marked, "keys")
    rest = [_masks([p for p in every if not m >> p & 1], blocks, bit_diff) for m in masks]
    finer = F.array(*[F.array(*[F.lit(_signed(m)) for m in row]) for row in rest])
    divided = marked.filter("_full").select(
        "_id", "signature", "_choice", "_key", F.posexplode(F.element_at(finer, F.col("_choice") + 1)).alias("_part", "_mask"))
    divided = divided.withColumn("_rest", F.col("signature").bitwiseAND(F.col("_mask")))
    near = _pairs(marked.filter("_full IS NULL"), ["_choice", "_key"], bit_diff)
    return near.unionByName(_pairs(divided, ["_choice", "_key", "_part", "_rest"], bit_diff)).distinct()


def simhash_clusters(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ngram: int = DEFAULT_NGRAM,
    bit_diff: int = DEFAULT_BIT_DIFF,
    num_bucket: int = DEFAULT_BUCKETS,
    tokenizer: str = "ascii",
    min_hot_rows: int = MIN_HOT_ROWS,
    most_key_rows: int = MOST_KEY_ROWS,
) -> DataFrame:
    """``(id, cluster)`` of the documents linked with another one; the cluster is the smallest id.

    Documents link when their signatures differ in at most ``bit_diff`` bits. Equal
    signatures are a star around their smallest id, and only that one is compared with
    others. Texts without a word link with nothing.
    """
    source = spread(df.select(id_col, text_col), id_col)
    found = stage(simhash_signatures(source, id_col, text_col, ngram, tokenizer), "simhash")
    groups = stage(found.groupBy("signature").agg(F.min(id_col).alias("_id"), F.count("*").alias("_n")), "distinct")
    equal = join_groups(
        found, groups.filter("_n > 1").withColumnRenamed("_id", "dst"), ["signature"], "_n", [id_col], min_hot_rows=min_hot_rows)
    stars = equal.filter(F.col(id_col) != F.col("dst")).select(F.col(id_col).alias("src"), "dst")
    near = hamming_pairs(groups.select("_id", "signature"), bit_diff, num_bucket, most_key_rows)
    found = connected_components(stars.unionByName(near), "src", "dst", min_hot_rows)
    return found.select(F.col("node").alias(id_col), F.col("component").alias("cluster"))


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The first document of every cluster, with its ``cluster``."""
    clusters = simhash_clusters(df, id_col, **options)
    dropped = stage(clusters.filter(F.col("cluster") != F.col(id_col)).select(id_col), "copies")
    return df.join(dropped, id_col, "left_anti").withColumn("cluster", F.col(id_col))
