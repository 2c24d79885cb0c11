"""The registered queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.llm.common import table
from vitrine.llm.contamination import contained_items
from vitrine.llm.language import identify_languages
from vitrine.llm.lattice_hash import near_vectors
from vitrine.llm.line_dedup import dedup_lines
from vitrine.llm.main_text import extract_main_text
from vitrine.llm.order_minhash import near_duplicate_groups
from vitrine.llm.packing import pack_documents
from vitrine.llm.rotated_clusters import cluster_vectors
from vitrine.llm.segment_search import search
from vitrine.llm.sharding import shard_documents
from vitrine.llm.tokens import tokens_round_trip
from vitrine.llm.toxicity import score_toxicity
from vitrine.llm.turn_repair import damaged, repair_report

Query = Callable[[SparkSession, str], DataFrame]


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op4_lattice_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_round_trip(table(spark, sf_dir, "documents"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "group_id", (F.col("doc_id") == F.col("group_id")).alias("kept"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op11_segment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(damaged(conversations), conversations)


def op13_rotated_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_main_text": op1_main_text,
    "op2_toxicity": op2_toxicity,
    "op3_language_id": op3_language_id,
    "op4_lattice_hashing": op4_lattice_hashing,
    "op5_sharding": op5_sharding,
    "op6_packing": op6_packing,
    "op7_token_files": op7_token_files,
    "op8_order_minhash": op8_order_minhash,
    "op9_decontamination": op9_decontamination,
    "op10_line_dedup": op10_line_dedup,
    "op11_segment_search": op11_segment_search,
    "op12_turn_repair": op12_turn_repair,
    "op13_rotated_clusters": op13_rotated_clusters,
}


def _cluster_rounds() -> str:
    """SQL of the centroids of operator 13: the first ones, then one step a round."""
    steps = ["""c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k, v AS c
                 FROM kept QUALIFY k < 16)"""]
    for i in range(4):
        steps.append(f"""a{i} AS (SELECT vec_id, v, k AS cluster,
                list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
            FROM kept, c{i} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, k) = 1)""")
        if i < 3:
            steps.append(f"""s{i} AS (SELECT cluster, pos, sum(x)::BIGINT AS total, count(*) AS n FROM (
                SELECT cluster, unnest(v) AS x, unnest(range(64)) AS pos FROM a{i}) GROUP BY ALL)""")
            steps.append(f"""m{i} AS (SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY pos) AS c
                FROM s{i} GROUP BY cluster)""")
            steps.append(f"""c{i + 1} AS (SELECT k, coalesce(m{i}.c, c{i}.c) AS c
                FROM c{i} LEFT JOIN m{i} ON k = cluster)""")
    return ",\n".join(steps)


ORACLE: dict[str, str] = {
    "op9_decontamination": r"""
        WITH texts AS (SELECT 0 AS kind, doc_id AS id, text FROM documents
                       UNION ALL SELECT 1, item_id, text FROM benchmark),
        words AS (SELECT kind, id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
                                               lambda w: w <> '') AS w FROM texts),
        placed AS (SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5),
        shingles AS (SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS s FROM placed),
        sizes AS (SELECT id AS item_id, count(*) AS item_shingles FROM shingles WHERE kind = 1 GROUP BY 1),
        shared AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared FROM shingles d
                   JOIN shingles b ON d.s = b.s AND d.kind = 0 AND b.kind = 1 GROUP BY ALL)
        SELECT doc_id, item_id, shared, item_shingles, shared / item_shingles AS containment
        FROM shared JOIN sizes USING (item_id) WHERE shared / item_shingles >= 0.8""",
    "op10_line_dedup": r"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts
                      FROM documents),
        lines AS (SELECT r, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM docs),
        keyed AS (SELECT r, doc_id, pos, line, translate(
            trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
        repeated AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10
                     GROUP BY k HAVING count(DISTINCT doc_id) > 1),
        marked AS (SELECT r, keyed.doc_id, pos, line, owner IS NOT NULL AND keyed.doc_id > owner AS gone
                   FROM keyed LEFT JOIN repeated USING (k))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY r, doc_id""",
    "op11_segment_search": """
        WITH rows AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
                      FROM embeddings WHERE embedding IS NOT NULL
                      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (SELECT q.vec_id AS query_id, r.vec_id,
                   list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2]))::BIGINT AS score
                   FROM rows q JOIN rows r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
               vec_id, score FROM scored QUALIFY rank <= 5""",
    "op13_rotated_clusters": f"""
        WITH kept AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
                      FROM embeddings WHERE len(embedding) = 64
                      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        {_cluster_rounds()}
        SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance,
               (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
               (sum(distance) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a3 JOIN c3 ON k = cluster""",
}
