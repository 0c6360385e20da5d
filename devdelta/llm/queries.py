"""The registered queries of this package and their DuckDB SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devdelta.llm.common import table
from devdelta.llm.exact_dedup import exact_groups
from devdelta.llm.jaccard_join import similar_components
from devdelta.llm.license_scan import license_scan
from devdelta.llm.mixing import LEAF, mix
from devdelta.llm.packing import pack
from devdelta.llm.quality_qda import quality_scores
from devdelta.llm.quality_rules import quality_rules
from devdelta.llm.resampling import resample
from devdelta.llm.secret_scan import secret_scan
from devdelta.llm.suffix_dedup import remove_repeats
from devdelta.llm.toxicity import toxicity_scores
from devdelta.llm.warc import archive_history
from devdelta.llm.whitening import whitened_vectors

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents")).drop("uid", "kept")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of all tokens, shared out equally over four groups of sources, their languages and sources, in up to two epochs."""
    domain = F.concat(F.lit("group"), F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % 4)
    mixed = mix(table(spark, sf_dir, "documents"), fraction=0.5, epochs=2, domain=domain)
    return mixed.select("doc_id", *LEAF, "epoch", "tokens")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("uid")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = archive_history(table(spark, sf_dir, "pages"))
    return history.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_vectors(table(spark, sf_dir, "embeddings"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_qda": op1_quality_qda,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_mixing": op3_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_warc": op5_warc,
    "op6_packing": op6_packing,
    "op7_license_scan": op7_license_scan,
    "op8_quality_rules": op8_quality_rules,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_resampling": op12_resampling,
    "op13_secret_scan": op13_secret_scan,
}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op2_jaccard_join": f"""
        WITH RECURSIVE d AS MATERIALIZED (
                 SELECT doc_id, list_filter(regexp_split_to_array({LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
             s AS MATERIALIZED (
                 SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g
                 FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
             n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
             met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
                      FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
             link AS MATERIALIZED (
                 SELECT x, y FROM met JOIN n AS a ON a.doc_id = x JOIN n AS b ON b.doc_id = y
                 WHERE 100 * c >= 85 * (a.n + b.n - c)),
             reach(doc_id, other) AS (
                 SELECT x, y FROM link UNION SELECT r.doc_id, y FROM reach AS r JOIN link ON x = r.other)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
        FROM documents LEFT JOIN n USING (doc_id)
             LEFT JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY ALL) USING (doc_id)""",
    "op4_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
             d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest FROM p),
             g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS best FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN best END AS refers_to
        FROM g""",
    "op9_suffix_dedup": """
        WITH t AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
             w AS MATERIALIZED (
                 SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 800)) AS g
                 FROM (SELECT doc_id, h, unnest(range(0, strlen(h) // 2 - 399)) AS i FROM t WHERE strlen(h) >= 800)),
             twice AS (SELECT g FROM w GROUP BY g HAVING count(*) > 1),
             hit AS (SELECT doc_id, i, i > lag(i, 1, -401) OVER (PARTITION BY doc_id ORDER BY i) + 400 AS starts
                     FROM w JOIN twice USING (g)),
             run AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b
                     FROM (SELECT doc_id, i, sum(starts::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM hit)
                     GROUP BY doc_id, k),
             cuts AS (SELECT doc_id, a, b FROM run UNION ALL SELECT doc_id, strlen(h) // 2, NULL FROM t),
             kept AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b NULLS LAST), 0) AS since FROM cuts)
        SELECT doc_id, any_value(strlen(h) // 2) AS n_bytes,
               CAST(coalesce(sum(b - a), 0) AS BIGINT) AS n_removed, count(b) AS n_spans,
               sha256(unhex(string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a, b NULLS LAST))) AS kept_sha256
        FROM kept JOIN t USING (doc_id) GROUP BY doc_id""",
}
