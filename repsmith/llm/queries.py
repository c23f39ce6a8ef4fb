"""The registered queries of the training-data operators, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repsmith.llm import arc_convert, bag_ranking, decontaminate, html_blocks, id_files, line_frequency, minhash_dedup, packing, sharded_lloyd, sharding, sparse_suffix, token_counts, toxicity_pu

SHARDS = 16
DIMS, CLUSTERS, ROUNDS = 64, 16, 3
#: Rows per Arrow batch: with texts of megabytes a task's batch must stay small.
ARROW_ROWS = "512"


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_convert.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = sharding.bounded_ring(rows, SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op4_rare_seed_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.line_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


def op6_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op7_minhash_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op8_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_pu.score(docs, toxicity_pu.train(docs, table(spark, sf_dir, "labels"))).drop("text_hash")


def op9_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op10_sparse_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sparse_suffix.repeated_passages(table(spark, sf_dir, "documents")).drop("text_hash")


def op11_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded_lloyd.lloyd(table(spark, sf_dir, "embeddings"), DIMS, CLUSTERS, ROUNDS)


def op12_bag_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_ranking.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_files.round_trip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_arc_to_warc, op2_bounded_ring, op3_best_two_fit, op4_rare_seed_alignment, op5_line_frequency,
                            op6_html_blocks, op7_minhash_stars, op8_nnpu_toxicity, op9_trie_token_counts, op10_sparse_suffix, op11_sharded_lloyd, op12_bag_ranking, op13_context_mixing)}

def _lloyd_sql(dims: int, clusters: int, rounds: int) -> str:
    """Lloyd's rounds unrolled: s (start) or m (means) give c0, c1, ...; a0, a1, ... are the assignments."""
    steps = [f"""v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
                  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {dims})""",
             f"c0 AS (SELECT row_number() OVER (ORDER BY vec_id IS NULL, sha256('1:' || vec_id), x) - 1 AS cluster, x AS c FROM v QUALIFY cluster < {clusters})"]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS (SELECT r, min(struct_pack(distance := d, cluster := cluster)) AS best FROM (SELECT r, cluster, CAST(list_sum(list_transform(generate_series(1, {dims}), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS BIGINT) AS d FROM v, c{k}) GROUP BY r)""")
        if k < rounds:
            steps.append(f"""m{k} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (SELECT best.cluster AS cluster, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM v JOIN a{k} USING (r), (SELECT unnest(generate_series(1, {dims})) AS i) GROUP BY 1, 2) GROUP BY cluster)""")
            steps.append(f"c{k + 1} AS (SELECT c{k}.cluster, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (cluster))")
    return "WITH " + ",\n".join(steps) + f"""
        SELECT vec_id, CAST(best.cluster AS INT) AS cluster, best.distance AS distance, CAST(sum(best.distance) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(best.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM v JOIN a{rounds} USING (r) JOIN c{rounds} ON c{rounds}.cluster = best.cluster"""


ORACLE_SQL: dict[str, str] = {
    "op11_sharded_lloyd": _lloyd_sql(DIMS, CLUSTERS, ROUNDS),
    "op12_bag_ranking": r"""
        WITH t AS (SELECT r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
                   FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
        d AS (SELECT r, doc_id, len(ws) AS n, ws FROM t WHERE len(ws) > 0),
        s AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d),
        q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
        tf AS (SELECT r, w, count(*) AS tf FROM (SELECT r, unnest(ws) AS w FROM d) WHERE w IN (SELECT w FROM q) GROUP BY r, w),
        df AS (SELECT w, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, s GROUP BY w, nn),
        m AS (SELECT r, doc_id, 50 + (50 * n * nn) // ll AS m FROM d, s),
        p AS (SELECT r, doc_id, w, weight * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS part FROM tf JOIN m USING (r) JOIN df USING (w)),
        x AS (SELECT item_id, r, doc_id, CAST(sum(part) AS BIGINT) AS score FROM p JOIN q USING (w) GROUP BY item_id, r, doc_id HAVING sum(part) > 0)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM x QUALIFY rank <= 50""",
    "op1_arc_to_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM g""",
    "op5_line_frequency": r"""
        WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
        w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
        windows AS (SELECT r, i, array_to_string(ws[i:i+7], ' ') AS g FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w WHERE len(ws) >= 8)),
        twice AS (SELECT r, g FROM windows GROUP BY r, g HAVING count(*) > 1),
        covered AS (SELECT r, count(DISTINCT i + k) AS n FROM windows JOIN twice USING (r, g), (SELECT unnest(generate_series(0, 7)) AS k) GROUP BY r),
        lines AS (SELECT r, doc_id, source, lower(array_to_string(regexp_extract_all(l, '[^\x20\x09-\x0D]+'), ' ')) AS l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
                  FROM (SELECT r, doc_id, source, unnest(ls) AS l FROM w)),
        hosts AS (SELECT source, count(DISTINCT doc_id) AS docs FROM documents GROUP BY source),
        above AS (SELECT source, l FROM lines JOIN hosts USING (source) GROUP BY source, l, docs HAVING count(DISTINCT doc_id) > 20 AND count(DISTINCT doc_id) > docs * 0.01),
        removed AS (SELECT r, sum(n) AS n FROM lines JOIN above USING (source, l) GROUP BY r),
        c AS (SELECT doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                     CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                     coalesce(covered.n, 0) AS n_repeat_words, CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed_words
              FROM w LEFT JOIN covered USING (r) LEFT JOIN removed USING (r)),
        f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, n_words - n_removed_words AS rest FROM c)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND rest >= 20 AND rest >= 0.5 * n_words AS kept, n_removed_words
        FROM f""",
    "op7_minhash_stars": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS g
              FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS i FROM d WHERE len(ws) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        rare AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
        both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id WHERE a.g IN (SELECT g FROM rare) GROUP BY 1, 2),
        links AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
        e AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
        least_ AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id, d.doc_id <= coalesce(m, d.doc_id) AS kept
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_ ON least_.a = d.doc_id""",
}
