"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    divergence,
    mtree,
    orchard,
    packing,
    pieces,
    quality,
    rlz,
    secrets,
    simhash,
    spotsigs,
    suffixes,
    toxicity,
    urls,
)
from .common import ship

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Token pieces of every document in sequences of at most 4096 tokens."""
    found = packing.token_pieces(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))
    return packing.pack(found)


def op2_rlz_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document without the passages that earlier documents hold."""
    return rlz.remove(table(spark, folder, "documents"))


def op3_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document, of its edited text, and their likeness."""
    return spotsigs.fingerprints(table(spark, folder, "documents"))


def op4_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's URL under the fixed rules."""
    return urls.judge(table(spark, folder, "pages"), urls.rule_table(spark, URL_RULES))


def op5_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 greatest inner products of every twentieth vector."""
    return mtree.top_k(table(spark, folder, "embeddings"))


HELD_OUT = "coalesce(crc32(cast(doc_id AS string)) % 5 = 0, false)"


def quality_weights(spark: SparkSession, folder: str):
    """The quality model, fitted on labels of rows that are not held out."""
    labels = table(spark, folder, "labels").where(f"NOT {HELD_OUT}").select("doc_id", F.col("quality").alias("label"))
    return quality.train(table(spark, folder, "documents"), labels)


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    scores = quality.score(table(spark, folder, "documents"), quality_weights(spark, folder))
    return scores.select(
        "doc_id", F.expr(HELD_OUT).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    )


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and what they decode to, as digests."""
    return pieces.digests(table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document without strings of 400 bytes that occur elsewhere."""
    return suffixes.remove(table(spark, folder, "documents"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.find_secrets(table(spark, folder, "documents"))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    documents = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").where(f"NOT {HELD_OUT}").select("doc_id", F.col("toxic").alias("label"))
    scores = toxicity.score(documents, toxicity.train(documents, labels))
    return scores.select(
        "doc_id", F.expr(HELD_OUT).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def op12_orchard(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters of all vectors of 64 components around 40 centroids."""
    return orchard.cluster(table(spark, folder, "embeddings"), k=40, rounds=5, dim=64)


def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How the sources of each language differ in their terms."""
    return divergence.audit(table(spark, folder, "documents"))


_OP4 = """
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS cut FROM pages
), r AS (
  SELECT page_id, CASE WHEN cut > 0 THEN substr(url, cut + 3) ELSE '' END AS rest FROM u
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM r
), rules(rule, verdict) AS (
  VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')
), parts AS (
  SELECT rule, verdict, substr(rule, 1, strpos(rule, '/') - 1) AS rhost, substr(rule, strpos(rule, '/')) AS rpath FROM rules
), fits AS (
  SELECT DISTINCT host, path, rule, verdict FROM (SELECT DISTINCT host, path FROM h) d JOIN parts
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
), best AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fits GROUP BY host, path
)
SELECT h.page_id, h.host, h.path, best.rule, coalesce(best.verdict, 'allow') AS verdict
FROM h LEFT JOIN best ON h.host = best.host AND h.path = best.path
"""


_OP5 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def _op12() -> str:
    """Five rounds, each two common table expressions."""
    good = (
        "embedding IS NOT NULL AND len(embedding) = 64 "
        "AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    )
    parts = [
        "v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e "
        f"FROM embeddings WHERE {good})",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, e) - 1 AS c, e FROM (SELECT sha256('2:' || vec_id) AS h, e FROM v "
        "WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT 40) AS s)",
    ]
    for n in range(6):
        parts.append(
            f"a{n} AS MATERIALIZED (SELECT vec_id, e, unnest(least_of.c) AS cluster, unnest(least_of.d) AS distance FROM ("
            f"SELECT v.vec_id, v.e, struct_pack(c := [arg_min(k.c, (d, k.c))], d := [min(d)]) AS least_of FROM "
            f"(SELECT row_number() OVER () AS r, * FROM v) AS v JOIN (SELECT * FROM c{n}) AS k ON true, "
            "LATERAL (SELECT CAST(list_sum(list_transform(list_zip(v.e, k.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d) AS m "
            "GROUP BY v.r, v.vec_id, v.e) AS t)"
        )
        if n < 5:
            parts.append(
                f"c{n + 1} AS MATERIALIZED (SELECT k.c, coalesce(m.e, k.e) AS e FROM c{n} AS k LEFT JOIN (SELECT cluster, "
                "list(f ORDER BY i) AS e FROM (SELECT cluster, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS f "
                f"FROM (SELECT cluster, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{n}) AS x GROUP BY cluster, i) AS g "
                "GROUP BY cluster) AS m ON m.cluster = k.c)"
            )
    return "WITH " + ",\n".join(parts) + """
SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, a.distance,
  CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.e, ',')) AS centroid_sha256
FROM a5 AS a JOIN c5 AS k ON k.c = a.cluster"""


_OP13 = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), occ AS MATERIALIZED (
  SELECT r, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
), kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), g AS MATERIALIZED (
  SELECT DISTINCT lang, source FROM d
), c AS MATERIALIZED (
  SELECT o.lang, o.source, o.term, count(*) AS n FROM occ AS o JOIN kept AS k ON o.lang = k.lang AND o.term = k.term GROUP BY 1, 2, 3
), ln AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), gn AS (
  SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source
), p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(gn.total, 0) + 5 * ln.v) AS BIGINT) AS p,
    CAST(1 + (1000000000::HUGEINT * (k.n + 5)) // (ln.total + 5 * ln.v) AS BIGINT) AS q
  FROM g JOIN kept AS k ON k.lang = g.lang JOIN ln ON ln.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN gn ON gn.lang = g.lang AND gn.source = g.source
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums AS s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, term AS item, p - q AS value,
    row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS rank FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term' AS part, item, value, CAST(rank AS INTEGER) AS rank FROM terms WHERE rank <= 50
"""


def queries() -> dict[str, Query]:
    own = [v for k, v in globals().items() if k.startswith("op") and callable(v)]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op4_url_filters": _OP4, "op5_top_k": _OP5, "op12_orchard": _op12(), "op13_divergence": _OP13}
