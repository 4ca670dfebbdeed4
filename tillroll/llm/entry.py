"""The registered queries of this package: thin digests over the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe, crosstoken, decontaminate, html, jaccard, langid, licenses
from tillroll.llm import quality, resample, substring, suffix_dedup, topk, warc
from tillroll.llm.common import stored, table, work_dir


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    marked = warc.mark_revisits(pages, "page_id", "html")
    written = warc.write_archives(marked, work_dir(spark, "warc"), "page_id", "url", "html")
    blocks = warc.read_index(stored(written, "manifest"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    records = warc.read_records(blocks.repartition(parts, "archive", "first"), payload=False)
    return records.select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", "refers_to",
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(docs, path, public_tokenizers.PATTERN, ids=False, digests=True)


def _remainder(n: int) -> Column:
    """crc32 of doc_id as text modulo ``n`` (0 for a null id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n, F.lit(0))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), _remainder(5) == 0
    )
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.classify(docs, _remainder(4) == 2)


def op5_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = suffix_dedup.remove_repeats(docs, kept=False, digest=True)
    return done.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256"
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a file tree: each source is a top directory with a directory per
    1,000 doc_ids and below it one per 100; in each of the lower ones the documents of
    0..4 modulo 100 are licence files, and those of 0..4 modulo 1,000 stand one level up."""
    i = F.col("doc_id")
    top = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(i / 1000))
    folder = F.when(i % 1000 < 5, top).otherwise(F.concat_ws("/", top, F.floor(i / 100)))
    name = F.when(i % 100 < 5, F.concat(F.lit("LICENSE."), i)).otherwise(F.concat(F.lit("doc-"), i))
    files = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.concat(folder, F.lit("/"), name).alias("path")
    )
    return licenses.scan(files, licenses.templates(spark))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return joined.select("doc_id", "n_shingles", F.col("component").alias("component_id"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages, html.fit(pages))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark"), keep_text=False,
    )
    ids = F.array_sort(F.transform("item_ids", lambda x: x.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0)


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resample.resample(docs, table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_crosstoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as files

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = crosstoken.align(
        docs, files.path("byte_bpe_50k.json"), files.path("piece_bpe_32k.model"), files.PATTERN
    )
    return aligned.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op13_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_windows(docs, columns=("n_words", "n_removed", "kept_sha256"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_bpe": op2_bpe,
    "op3_quality": op3_quality,
    "op4_langid": op4_langid,
    "op5_suffix": op5_suffix,
    "op6_licenses": op6_licenses,
    "op7_jaccard": op7_jaccard,
    "op8_html": op8_html,
    "op9_decontaminate": op9_decontaminate,
    "op10_topk": op10_topk,
    "op11_resample": op11_resample,
    "op12_crosstoken": op12_crosstoken,
    "op13_substring": op13_substring,
}

_TEMPLATES = ", ".join(
    "('{}', '{}')".format(k, v.replace("'", "''")) for k, v in licenses.TEMPLATES
)

ORACLE_SQL = {
    "op6_licenses": f"""
WITH tpl(license_id, template) AS (VALUES {_TEMPLATES}),
tok AS (
    SELECT license_id, token, count(*) AS tf
    FROM (SELECT license_id, unnest(regexp_extract_all(lower(template), '[a-z0-9]+(?:\\.[0-9]+)*')) AS token FROM tpl)
    GROUP BY ALL
), idf AS (
    SELECT token, ln((SELECT count(*) FROM tpl) + 1.0) - ln(count(*) + 1.0) + 1 AS idf FROM tok GROUP BY token
), tw AS (
    SELECT license_id, token, tf * idf AS w,
           sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY license_id)) AS norm
    FROM tok JOIN idf USING (token)
), files AS (
    SELECT doc_id, text, regexp_replace(path, '/?[^/]*$', '') AS dir, path,
           regexp_matches(path, '(^|/)LICENSE[.][^/]*$') AS is_license
    FROM (
        SELECT doc_id, text,
               coalesce(source, 'none') || '/' || (doc_id // 1000)
               || CASE WHEN doc_id % 1000 < 5 THEN '' ELSE '/' || (doc_id // 100) END || '/'
               || CASE WHEN doc_id % 100 < 5 THEN 'LICENSE.' ELSE 'doc-' END || doc_id AS path
        FROM documents WHERE doc_id IS NOT NULL
    )
), seg AS (
    SELECT DISTINCT path, segment FROM (
        SELECT path, unnest(string_split(text, chr(10))) AS segment FROM files
        UNION ALL
        SELECT path, text FROM files WHERE is_license
    ) WHERE regexp_matches(segment, '(?i)licen[sc]|copyright|spdx')
), st AS (
    SELECT path, segment, token, count(*) AS tf
    FROM (SELECT path, segment, unnest(regexp_extract_all(lower(segment), '[a-z0-9]+(?:\\.[0-9]+)*')) AS token FROM seg)
    GROUP BY ALL
), sw AS (
    SELECT path, segment, token,
           tf * coalesce(idf, ln((SELECT count(*) FROM tpl) + 1.0) + 1) AS w
    FROM st LEFT JOIN idf USING (token)
), sn AS (
    SELECT path, segment, sqrt(sum(w * w)) AS norm FROM sw GROUP BY ALL
), dots AS (
    SELECT sw.path, sw.segment, license_id, sum(sw.w * tw.w / tw.norm) AS dot
    FROM sw JOIN tw USING (token) GROUP BY ALL
), own AS (
    SELECT path, license_id, score FROM (
        SELECT path, license_id, round(dot / norm, 6) AS score,
               row_number() OVER (PARTITION BY path ORDER BY round(dot / norm, 6) DESC, license_id) AS r
        FROM dots JOIN sn USING (path, segment)
        WHERE round(dot / norm, 6) >= 0.6
    ) WHERE r = 1
), holders AS (
    SELECT dir, min(path) AS license_path, arg_min(own.license_id, path) AS license_id
    FROM own JOIN files USING (path) WHERE is_license GROUP BY dir
)
SELECT doc_id, path, coalesce(own.license_id, h2.license_id, h1.license_id, h0.license_id) AS license_id,
       own.score AS score,
       CASE WHEN own.license_id IS NOT NULL THEN 'own'
            WHEN coalesce(h2.license_id, h1.license_id, h0.license_id) IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN own.license_id IS NOT NULL THEN path
            ELSE coalesce(h2.license_path, h1.license_path, h0.license_path) END AS license_path
FROM files LEFT JOIN own USING (path)
LEFT JOIN holders h2 ON h2.dir = files.dir
LEFT JOIN holders h1 ON h1.dir = regexp_replace(files.dir, '/?[^/]*$', '')
LEFT JOIN holders h0 ON h0.dir = regexp_replace(regexp_replace(files.dir, '/?[^/]*$', ''), '/?[^/]*$', '')""",
    "op1_warc": """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
    SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
           sha256(payload) AS payload_digest
    FROM p
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id
            THEN first_id END AS refers_to
FROM f""",
    "op10_topk": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0 AND len(q.v) = len(c.v)
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""",
}
