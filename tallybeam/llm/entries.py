"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallybeam.llm import bpe, exact_dedup, fim, licenses, mixing, quality, rank_bpe, sharding, simhash, topk, urls, warc
from tallybeam.llm.common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_embeddings(table(spark, sf_dir, "embeddings"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


def op12_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_bpe.digests(table(spark, sf_dir, "documents"))


QUERIES = (op1_license_scan, op2_url_filter, op3_sharding, op4_exact_dedup, op5_quality_classifier, op6_warc, op7_bpe, op8_source_mix, op9_simhash, op10_exact_top_k, op11_fill_in_middle, op12_rank_bpe)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def shard_sql(shards: int = sharding.SHARDS) -> str:
    """Draws at every node, then the way from the top; CRC-32 byte by byte from a table made by its polynomial."""

    def rows(top: sharding.Node) -> list[str]:
        return [f"('{top.name}', '{c.name}', {c.weight}::DOUBLE, {'NULL' if c.shard is None else c.shard})" for c in top.children] + [r for c in top.children for r in rows(c)]

    def way(name: str, top: sharding.Node) -> str:
        return f"""
            {name}_t(parent, child, weight, shard) AS (VALUES {", ".join(rows(top))}),
            {name}_w AS (SELECT key, parent, arg_max((child, shard), (ln((('0x' || substr(md5('{sharding.SEED}|' || child || '|' || key), 1, 13))::BIGINT + 1)::DOUBLE / 4503599627370496.0) / weight, child)) AS w
                         FROM keys, {name}_t GROUP BY key, parent),
            {name} AS (SELECT a.key, c.w[2]::INT AS shard FROM {name}_w a JOIN {name}_w b ON a.parent = '' AND b.key = a.key AND b.parent = a.w[1] JOIN {name}_w c ON c.key = b.key AND c.parent = b.w[1])"""

    return f"""
            WITH t AS (SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
            b AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS key, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM documents),
            d AS (SELECT doc_id, key, len(b)::BIGINT + 8 AS size, xor(list_reduce([4294967295] || b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)::BIGINT AS text_crc32 FROM b, t),
            keys AS (SELECT DISTINCT key FROM d),{way("now", sharding.tree(shards))},{way("grown", sharding.tree(shards + 1))}
            SELECT doc_id, size, text_crc32, 'key' AS law, now.shard,
                   row_number() OVER (PARTITION BY now.shard ORDER BY ('0x' || substr(md5('{sharding.SEED}-slot|' || d.key || '|' || text_crc32), 1, 13))::BIGINT, doc_id, text_crc32, size) - 1 AS slot,
                   grown.shard AS grown_shard
            FROM d JOIN now ON now.key = d.key JOIN grown ON grown.key = d.key"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_sharding": shard_sql(),
        "op4_exact_dedup": """
            WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
            FROM d WINDOW w AS (PARTITION BY text_sha256)""",
        "op6_warc": """
            WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
            g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
            SELECT page_id, payload_bytes, payload_digest,
                   CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
                   CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
            FROM g""",
        "op8_source_mix": """
            WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+'))::BIGINT AS size,
                              ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT AS place FROM documents),
            s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
            r AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w, 3 * source_size AS cap FROM s),
            f AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS left_words, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS left_weight
                  FROM r WINDOW b AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
            c AS (SELECT *, left_words::DOUBLE * w >= cap::DOUBLE * left_weight AS clamped FROM f),
            t AS (SELECT source, source_size, CASE WHEN clamped THEN cap::DOUBLE ELSE least(w::DOUBLE * (
                        ((SELECT sum(source_size) FROM c)::DOUBLE - (SELECT coalesce(sum(cap), 0) FROM c WHERE clamped)::DOUBLE)
                        / (SELECT sum(w) FROM c WHERE NOT clamped)::DOUBLE), cap::DOUBLE) END AS target FROM c),
            e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
            o AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.whole, e.target - (e.whole * e.source_size)::DOUBLE AS rest,
                         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
                  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
            SELECT doc_id, size, source_size, target,
                   (size * (whole + CASE WHEN rest > 0 AND upto - size / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM o""",
        "op10_exact_top_k": """
            WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS w FROM embeddings
                       WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
            s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
                  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
            r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM s)
            SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
        "op11_fill_in_middle": """
            WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS x FROM documents),
            h AS (SELECT *, len(u)::BIGINT AS n, list_transform(range(4), lambda i: ('0x' || substr(x, (8 * i + 1)::INT, 8))::BIGINT) AS h FROM d),
            f AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
                         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
            p AS (SELECT doc_id, n, form, text, array_to_string(u[1 : a], '') AS prefix, array_to_string(u[a + 1 : b], '') AS middle, array_to_string(u[b + 1 : n], '') AS suffix FROM f)
            SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
                   sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
                   sha256(text) AS restored_sha256
            FROM p""",
    }
