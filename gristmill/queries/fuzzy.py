"""Near-duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import shingles as sh
from gristmill.operators import fuzzy, simhash
from gristmill.operators.exact import dedup_document
from gristmill.queries.common import letters_sql, table
from gristmill.sources.observed import RunLog
from gristmill.staging import stage

_NONE = str(sh.MAX_HASH)


def _number(x: str, bits: int = 32) -> str:
    pairs = "||".join(f"substr(sha1({x}), {i}, 2)" for i in range(bits // 4 - 1, 0, -2))
    return f"('0x'||{pairs})::HUGEINT"


_TOKENS = "regexp_split_to_array(text, '[^A-Za-z_0-9]')"
_FOUR = " || ' ' || ".join(["token", *(f"lead(token, {i}) OVER w" for i in range(1, 5))])
_GRAMS = (
    f"words AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos FROM "
    f"(SELECT doc_id, {_TOKENS} AS t FROM documents)), "
    f"slides AS (SELECT doc_id, pos, {_FOUR} AS gram FROM words "
    "WINDOW w AS (PARTITION BY doc_id ORDER BY pos)), "
    "grams AS (SELECT doc_id, pos, gram FROM slides WHERE gram IS NOT NULL)"
)
_SHINGLES = (
    f"{_GRAMS}, shingles AS MATERIALIZED (SELECT DISTINCT doc_id, gram FROM grams), "
    f"hashes AS MATERIALIZED (SELECT doc_id, {_number('gram')} AS h FROM shingles)"
)
_MINIMA = ", ".join(
    f"min(((h * {a}::HUGEINT + {b}::HUGEINT) % 18446744073709551616::HUGEINT "
    f"% {sh.MERSENNE_PRIME}::HUGEINT) % 4294967296::HUGEINT)::BIGINT"
    for a, b in sh.permutations(25)
)
_SIGNATURES = (
    f"{_SHINGLES}, found AS (SELECT doc_id, [{_MINIMA}] AS s FROM hashes GROUP BY doc_id), "
    "signatures AS MATERIALIZED (SELECT doc_id, coalesce(s, list_transform(range(25), lambda i: "
    f"{_NONE}::BIGINT)) AS s FROM documents LEFT JOIN found USING (doc_id))"
)


def _bands_sql(bands: int, rows: int) -> str:
    parts = " UNION ALL ".join(
        f"SELECT doc_id, {i}::BIGINT AS band, array_to_string(s[{i * rows + 1}:{(i + 1) * rows}], ',') "
        "AS band_key FROM signatures" for i in range(bands)
    )
    return f"{_SIGNATURES}, bands AS ({parts})"


def _edges_sql(bands: int, rows: int) -> str:
    return (
        f"{_bands_sql(bands, rows)}, edges AS (SELECT DISTINCT doc_id AS src, low AS dst FROM "
        "(SELECT doc_id, min(doc_id) OVER (PARTITION BY band, band_key) AS low FROM bands) "
        "WHERE doc_id <> low)"
    )


def clusters_sql(bands: int, rows: int) -> str:
    return (
        f"{_edges_sql(bands, rows)}, links AS MATERIALIZED (SELECT src AS u, dst AS v FROM edges UNION "
        "SELECT dst, src FROM edges), reach AS (SELECT u AS node, u AS root FROM links UNION "
        "SELECT links.v, reach.root FROM reach JOIN links ON links.u = reach.node), "
        "clusters AS (SELECT node AS doc_id, min(root) AS cluster FROM reach GROUP BY node)"
    )


def _tokens(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    exploded = docs.select("doc_id", F.posexplode(sh.ascii_tokens("text")).alias("pos", "token"))
    return exploded.groupBy("doc_id").agg(
        F.count("*").alias("tokens"),
        F.count_if(F.col("token") == "").alias("empty"),
        F.max(F.when(F.col("token") != "", F.col("pos"))).cast("bigint").alias("last"),
        F.sum(F.length("token")).alias("characters"),
    )


def _ngrams(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    grams = docs.select("doc_id", F.posexplode(sh.ngrams(sh.ascii_tokens("text"))).alias("pos", "gram"))
    return grams.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "gram")


def _shingles(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.explode(sh.shingles(sh.ascii_tokens("text"))).alias("gram"))


def _hashes(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    words = docs.select(F.explode(sh.ascii_tokens("text")).alias("token")).distinct()
    return words.select("token", sh.sha1_integer(F.col("token"), 32).alias("short"),
                        sh.sha1_integer(F.col("token"), 64).cast("string").alias("long"))


def _signatures(spark, folder) -> DataFrame:
    found = fuzzy.minhash_signatures(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.array_join(F.col("signature").cast("array<string>"), ",").alias("signature"))


def _bands(spark, folder) -> DataFrame:
    found = fuzzy.minhash_signatures(table(spark, folder, "documents"))
    return fuzzy.lsh_bands(found, 4, 6).withColumn("band", F.col("band").cast("bigint"))


def _edges(spark, folder) -> DataFrame:
    found = fuzzy.minhash_signatures(table(spark, folder, "documents"))
    # The bands are read twice, so they are written once.
    return fuzzy.lsh_edges(stage(fuzzy.lsh_bands(found, 4, 6), "bands"))


def _components(spark, folder) -> DataFrame:
    found = fuzzy.fuzzy_clusters(table(spark, folder, "documents"))
    return found


def _assigned(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return fuzzy.assign_clusters(docs, fuzzy.fuzzy_clusters(docs)).select("doc_id", "lang", "cluster")


def _kept(threshold: float):
    def query(spark, folder) -> DataFrame:
        docs = table(spark, folder, "documents")
        return fuzzy.fuzzy_dedup(docs, threshold=threshold).select("doc_id", "text", "cluster")

    return query


def _dropped(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return fuzzy.fuzzy_duplicates(docs).select("doc_id", "text", "cluster")


def _counts(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    kept = fuzzy.fuzzy_dedup(docs).agg(F.count("*").alias("n"))
    both = docs.agg(F.count("*").alias("n")).select(F.lit("before").alias("stage"), "n")
    return both.unionByName(kept.select(F.lit("after").alias("stage"), "n"))


def _report(spark, folder) -> DataFrame:
    # Every number comes from the job that writes the stage.
    log = RunLog()
    docs = log.stage(table(spark, folder, "documents").select("doc_id", "text"), "documents")
    docs = log.stage(fuzzy.fuzzy_dedup(docs).drop("cluster"), "fuzzy_dedup")
    log.stage(dedup_document(docs, mode="drop"), "dedup_document")
    return log.report(spark).drop("seconds")


def _by_token(left: str, right: str):
    return sh.jaccard_similarity(sh.ascii_tokens(left), sh.ascii_tokens(right), 1)


def _jaccard(function):
    # Texts are paired first; their token arrays are many times larger.
    def query(spark, folder) -> DataFrame:
        docs = table(spark, folder, "documents").select("doc_id", "text")
        following = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("next"))
        value = function("text", "next")
        pairs = docs.join(following, "doc_id")
        return pairs.select("doc_id", F.round(value, 9).alias("similarity"))

    return query


def _jaccard_sql(items: str) -> str:
    return (
        f"{items}SELECT a.doc_id, round(len(list_intersect(a.g, b.g)) / greatest(1, "
        "len(list_distinct(list_concat(a.g, b.g)))), 9) AS similarity "
        "FROM items a JOIN items b ON b.doc_id = a.doc_id + 1"
    )


_EIGHT = ", ".join(["token", *(f"lead(token, {i}) OVER w" for i in range(1, 8))])
_CHARACTER_GRAMS_SQL = (
    "WITH letters AS (SELECT doc_id, unnest(c) AS token, generate_subscripts(c, 1) AS pos FROM "
    "(SELECT doc_id, regexp_extract_all(text, '(?s).') AS c FROM documents)), "
    f"slides AS (SELECT doc_id, pos, lead(token, 7) OVER w AS eighth, concat_ws(' ', {_EIGHT}) AS g "
    "FROM letters WINDOW w AS (PARTITION BY doc_id ORDER BY pos)), "
    "grams AS (SELECT doc_id, list(DISTINCT g) AS g FROM slides WHERE eighth IS NOT NULL OR pos = 1 "
    "GROUP BY doc_id), items AS MATERIALIZED (SELECT doc_id, coalesce(g, ['']) AS g FROM documents "
    "LEFT JOIN grams USING (doc_id)) "
)

_THREE = (
    f"WITH RECURSIVE parts AS (SELECT doc_id, {_TOKENS} AS t FROM documents WHERE "
    r"regexp_matches(text, '[\pL\p{Nd}_]')), "
    "grams AS (SELECT doc_id, unnest(CASE WHEN len(t) < 3 THEN [array_to_string(t, ' ')] ELSE list_transform("
    "range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]) END) AS gram FROM parts), "
    "hashes AS (SELECT doc_id, ('0x' || substr(sha1(gram), 1, 16))::UBIGINT AS h FROM grams), "
    "signatures AS MATERIALIZED (SELECT doc_id, "
    + " + ".join(f"(CASE WHEN 2 * sum((h >> {k}) & 1) > count(*) THEN {1 << k}::UHUGEINT ELSE 0 END)" for k in range(64))
    + " AS s FROM hashes GROUP BY doc_id)"
)


def _simhash_signatures(spark, folder) -> DataFrame:
    found = simhash.simhash_signatures(table(spark, folder, "documents"))
    return found.select("doc_id", F.hex("signature").alias("signature"))


def _simhash(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return simhash.simhash_dedup(docs).select("doc_id", "text", "cluster")


QUERIES = {
    "m18_simhash_signature": (
        _simhash_signatures, f"{_THREE} SELECT doc_id, to_hex(s::UBIGINT) AS signature FROM signatures"),
    "m18_simhash_dedup": (
        _simhash,
        f"{_THREE}, links AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS v FROM signatures a JOIN signatures b "
        "ON a.doc_id <> b.doc_id AND bit_count(xor(a.s::UBIGINT, b.s::UBIGINT)::BIT) <= 3), "
        "reach AS (SELECT u AS node, u AS root FROM links UNION SELECT links.v, reach.root FROM reach JOIN links "
        "ON links.u = reach.node), clusters AS (SELECT node AS doc_id, min(root) AS cluster FROM reach GROUP BY node) "
        "SELECT doc_id, text, doc_id AS cluster FROM documents LEFT JOIN clusters USING (doc_id) "
        "WHERE coalesce(cluster, doc_id) = doc_id"),
    "m01_ascii_tokens": (
        _tokens,
        f"WITH parts AS (SELECT doc_id, {_TOKENS} AS t FROM documents), "
        "rows_ AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos FROM parts) "
        "SELECT doc_id, count(*) AS tokens, count(*) FILTER (token = '') AS empty, "
        "max(pos) FILTER (token <> '') AS last, sum(length(token))::BIGINT AS characters "
        "FROM rows_ GROUP BY doc_id"),
    "m02_ngrams": (
        _ngrams, f"WITH {_GRAMS} SELECT doc_id, pos::BIGINT AS pos, gram FROM grams"),
    "m03_shingles": (_shingles, f"WITH {_GRAMS} SELECT DISTINCT doc_id, gram FROM grams"),
    "m04_sha1_integer": (
        _hashes,
        f"WITH words AS (SELECT DISTINCT unnest({_TOKENS}) AS token FROM documents) "
        f"SELECT token, {_number('token')}::BIGINT AS short, {_number('token', 64)}::VARCHAR AS long "
        "FROM words"),
    "m06_minhash_signature": (
        _signatures,
        f"WITH {_SIGNATURES} SELECT doc_id, array_to_string(s, ',') AS signature FROM signatures"),
    "m08_lsh_bands": (
        _bands, f"WITH {_bands_sql(4, 6)} SELECT doc_id, band, band_key FROM bands"),
    "m09_lsh_edges": (_edges, f"WITH {_edges_sql(4, 6)} SELECT src, dst FROM edges"),
    "m10_connected_components": (
        _components, f"WITH RECURSIVE {clusters_sql(4, 6)} SELECT doc_id, cluster FROM clusters"),
    "m11_assign_clusters": (
        _assigned,
        f"WITH RECURSIVE {clusters_sql(4, 6)} SELECT doc_id, lang, coalesce(cluster, doc_id) "
        "AS cluster FROM documents LEFT JOIN clusters USING (doc_id)"),
    "m12_fuzzy_dedup": (
        _kept(0.7),
        f"WITH RECURSIVE {clusters_sql(4, 6)} SELECT doc_id, text, doc_id AS cluster "
        "FROM documents LEFT JOIN clusters USING (doc_id) WHERE coalesce(cluster, doc_id) = doc_id"),
    "m13_fuzzy_duplicates": (
        _dropped,
        f"WITH RECURSIVE {clusters_sql(4, 6)} SELECT doc_id, text, cluster FROM documents "
        "JOIN clusters USING (doc_id) WHERE cluster <> doc_id"),
    "m14_jaccard_tokens": (_jaccard(_by_token), _jaccard_sql(
            f"WITH items AS (SELECT doc_id, list_distinct({_TOKENS}) AS g FROM documents) ")),
    "m14_jaccard_characters": (_jaccard(sh.character_jaccard), _jaccard_sql(_CHARACTER_GRAMS_SQL)),
    "m16_fuzzy_dedup_stricter": (
        _kept(0.8),
        f"WITH RECURSIVE {clusters_sql(3, 8)} SELECT doc_id, text, doc_id AS cluster "
        "FROM documents LEFT JOIN clusters USING (doc_id) WHERE coalesce(cluster, doc_id) = doc_id"),
    "m17_run_report": (
        _report,
        f"WITH RECURSIVE {clusters_sql(4, 6)}, kept AS (SELECT doc_id, text FROM documents LEFT JOIN clusters "
        "USING (doc_id) WHERE coalesce(cluster, doc_id) = doc_id), single AS (SELECT text FROM kept QUALIFY "
        f"row_number() OVER (PARTITION BY md5({letters_sql('text')}) ORDER BY doc_id) = 1) "
        + " UNION ALL ".join(
            f"SELECT '{step}' AS step, count(*) AS rows, sum(strlen(text))::BIGINT AS bytes FROM {name}"
            for step, name in (("documents", "documents"), ("fuzzy_dedup", "kept"), ("dedup_document", "single")))),
    "m17_before_after": (
        _counts,
        f"WITH RECURSIVE {clusters_sql(4, 6)} SELECT 'before' AS stage, count(*) AS n FROM documents "
        "UNION ALL SELECT 'after', count(*) FROM documents LEFT JOIN clusters USING (doc_id) "
        "WHERE coalesce(cluster, doc_id) = doc_id"),
}
