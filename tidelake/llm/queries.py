"""The registered queries of this package: each operator on its whole table, with its full result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import bpe, decontamination, language_id, lattice_lm, license_scan, line_dedup, parity_join, quality_classifier
from tidelake.llm import block_whitening, hadamard_clusters, quality_rules, quotation_links, sharding
from tidelake.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER_FILE = public_tokenizers.path("word_bpe_49k.json")
PIECES_FILE = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def ids_text(ids: str) -> F.Column:
    return F.array_join(F.col(ids).cast("array<string>"), " ")


def crc_mod(n: int) -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licences of every document: of its whole text, and of its lines."""
    found = license_scan.scan(table(spark, folder, "documents"), license_scan.known_digests(), ["doc_id"])
    return found.withColumn("line_licenses", F.array_join("line_licenses", ","))


ORACLE["op1_license_scan"] = license_scan.oracle_sql(license_scan.known_digests())


@query
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    coded = bpe.encode_decode(table(spark, folder, "documents").select("doc_id", "text"), TOKENIZER_FILE)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids_text("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document after line dedup, with the number of lines taken out."""
    return line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard of every document under the byte limit, as told by the shards written with the whole documents."""
    return sharding.write_shards(table(spark, folder, "documents")).select("doc_id", "shard", "depth", "page", "row_bytes")


#: Each depth's prefix sums in one table; a document's shard is its shortest prefix within the limit.
ORACLE["op4_sharding"] = f"""
WITH hashed AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS row_bytes,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h FROM documents),
deep AS (SELECT doc_id, row_bytes, h, depth, h >> CAST(60 - depth AS INT) AS prefix FROM hashed, range(0, 61) r(depth)),
fits AS (SELECT depth, prefix FROM deep GROUP BY ALL HAVING sum(row_bytes) <= {sharding.SHARD_BYTES}),
least AS (SELECT doc_id, row_bytes, h, min(depth) AS depth FROM deep JOIN fits USING (depth, prefix) GROUP BY ALL)
SELECT doc_id, substr(right(repeat('0', 60) || bin(h), 60), 1, CAST(depth AS INT)) AS shard, CAST(depth AS INT) AS depth,
  CAST(0 AS BIGINT) AS page, row_bytes FROM least"""


@query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality_rules.judge(documents, labels, ["doc_id"])


@query
def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, learned from labels of four fifths of the ids."""
    documents, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    agreed = labels.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("_most")).where("label = _most")
    scored = quality_classifier.classify(documents, documents.where(crc_mod(5) != 0), agreed, ["doc_id"])
    return scored.select("doc_id", (crc_mod(5) == 0).alias("held_out"), "score", "predicted")


@query
def op7_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    """Reply-ordered conversations without quotes, in parts."""
    return quotation_links.conversations(table(spark, folder, "conversations"))


@query
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of a document and a benchmark item found in it."""
    return decontamination.leaked_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from three quarters of the ids."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    told = language_id.identify(documents, documents.where(crc_mod(4) != 2), ["doc_id"])
    return told.select("doc_id", (crc_mod(4) == 2).alias("held_out"), "lang_pred", "score", "accepted")


@query
def op10_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return parity_join.near_duplicates(table(spark, folder, "documents"))


@query
def op11_lattice_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Marginal subword likelihood of every document, learned from six sevenths of the ids."""
    documents = table(spark, folder, "documents").select("doc_id", "text").withColumn("held_out", crc_mod(7) == 2)
    scored = lattice_lm.score(documents, ~F.col("held_out"), lattice_lm.read_vocabulary(PIECES_FILE), ["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op12_block_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened coordinates of every embedding on the leading components of the distinct ones."""
    whitened = block_whitening.whiten(table(spark, folder, "embeddings"))
    deviation = F.col("deviation").try_cast("long").alias("deviation")
    return whitened.select("vec_id", "component", "n", deviation, "whitened", "explained", "identity_error")


@query
def op13_hadamard_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster of every embedding after the rounds."""
    return hadamard_clusters.cluster(table(spark, folder, "embeddings"))


def clusters_sql(rounds: int, centroids: int) -> str:
    """All distances of every round, in plain SQL."""
    parts = [
        """vectors AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(CAST(c AS DOUBLE)))) = 64)""",
        f"""c0 AS (SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS cluster, x FROM (
SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, x FROM vectors ORDER BY h NULLS LAST, x LIMIT {centroids}))""",
    ]
    for k in range(rounds + 1):
        parts.append(f"""a{k} AS (SELECT r, vec_id, vectors.x AS x, min({{'d': list_sum(list_transform(list_zip(vectors.x, c{k}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'cluster': cluster}}) AS best
FROM vectors, c{k} GROUP BY ALL)""")
        parts.append(f"""m{k} AS (SELECT cluster, list(m ORDER BY i) AS x FROM (SELECT cluster, i, CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM (
SELECT best.cluster AS cluster, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{k}) GROUP BY cluster, i) GROUP BY cluster)""")
        parts.append(f"c{k + 1} AS (SELECT cluster, coalesce(m{k}.x, c{k}.x) AS x FROM c{k} LEFT JOIN m{k} USING (cluster))")
    last = f"a{rounds}"
    return "WITH " + ",\n".join(parts[: 2 + 3 * rounds + 1]) + f"""
SELECT vec_id, best.cluster AS cluster, CAST(best.d AS BIGINT) AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM {last} JOIN c{rounds} ON c{rounds}.cluster = best.cluster"""


ORACLE["op13_hadamard_clusters"] = clusters_sql(hadamard_clusters.ROUNDS, hadamard_clusters.CENTROIDS)
