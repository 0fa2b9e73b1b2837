"""One query per operator over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import alignment, ann, chat, decontaminate, html, language, lines, packing, sharding, simhash, substring, warc, whitening
from tripmill.llm.common import bounded, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SHARDS = 16
SHARD_SEED = 20_240_607


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(bounded(spark), sf_dir)
    return fn


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sharded = sharding.shuffle_into_shards(docs, ["doc_id"], SHARDS, SHARD_SEED)
    text = F.coalesce(F.col("text"), F.lit(""))
    return sharded.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, log_probs = language.learn(docs, train=~held_out())
    found = language.identify(docs.select("doc_id", "text"), langs, log_probs)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


#: A crawl made of the pages: each page is fetched, some again later with a changed body, and each is revisited.
#: Both Spark and the checking engine read this SQL.
CAPTURES = """
    SELECT page_id * 4 AS record_id, url AS uri, 1000000 + (page_id % 997) * 100 AS captured, 200 AS status,
           CASE WHEN page_id % 11 != 0 THEN md5(html) END AS etag, 'day ' || (page_id % 5) AS modified,
           'text/html' AS kind, html AS payload
    FROM pages
    UNION ALL
    SELECT page_id * 4 + 1, url, 1005000 + (page_id % 997) * 100, 200, md5(html || '<!-- 2 -->'),
           'day ' || (page_id % 5 + 1), 'text/html', html || '<!-- 2 -->'
    FROM pages WHERE page_id % 3 = 0
    UNION ALL
    SELECT page_id * 4 + 2, replace(url, 'http', 'HTTP') || '#top',
           1003000 + (page_id % 997) * 100 + (page_id % 2) * 4000, 304,
           CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 5 = 0 THEN 'W/' || md5(html) ELSE md5(html) END,
           CASE WHEN page_id % 13 != 0 THEN 'day ' || (page_id % 5) END, 'text/plain', NULL
    FROM pages
    UNION ALL
    SELECT page_id * 4 + 3, url, 999000 + (page_id % 997) * 10, 304, md5(html), NULL, 'text/plain', NULL
    FROM pages WHERE page_id % 13 = 0
"""


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = spark.sql(CAPTURES.replace("FROM pages", "FROM {pages}"), pages=table(spark, sf_dir, "pages"))
    named = F.map_from_arrays(
        F.array(*map(F.lit, ("ETag", "Last-Modified", "Content-Type", "Date", "Connection"))),
        F.array("etag", "modified", "kind", F.col("captured").cast("string"), F.lit("close")),
    )
    headers = F.map_filter(named, lambda k, v: v.isNotNull())
    found = warc.resolve_revisits(captures.withColumn("headers", headers))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select(
        "record_id", "uri", "captured", "resolution", "response_id",
        F.array_join(lines, "\n").alias("headers"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )


@query
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.sql("SELECT -7L AS conv_id, id AS turn, if(id = 0, 'user', 'assistant') AS role FROM range(2)")
    return chat.read_back(chat.expand(turns.unionByName(extra.withColumn("text", F.lit(said)))))


@query
def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def word_vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), word_vocabulary)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), "id % 20 = 0", k=20)


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "contaminated", "n_items", "best_item", "coverage")


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query
def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def both_vocabularies() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups, 256))
    found = alignment.align_tokens(table(spark, sf_dir, "documents"), both_vocabularies, keep=digest)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=4)
    # n times a number may pass 64 bits on very large tables; the operator's decimal is exact there too.
    deviation = F.col("deviation").try_cast("long").alias("deviation")
    return found.select("vec_id", "component", "n", deviation, "whitened", "explained", "identity_error")


@query
def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES: dict[str, str] = {
    "op3_warc": f"""
        WITH captures AS ({CAPTURES}),
        parts AS (
            SELECT *, regexp_extract(uri, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^#]*)', ['scheme', 'host', 'rest']) AS p
            FROM captures
        ),
        named AS (
            SELECT * EXCLUDE (uri, p),
                   CASE WHEN p.scheme = '' THEN regexp_replace(uri, '#.*$', '', 's')
                        ELSE lower(p.scheme) || '://'
                             || regexp_replace(regexp_replace(lower(p.host), '^.*@', ''),
                                               CASE lower(p.scheme) WHEN 'http' THEN ':80$' WHEN 'https' THEN ':443$' ELSE '^$' END, '')
                             || CASE WHEN starts_with(p.rest, '/') THEN p.rest ELSE '/' || p.rest END END AS uri
            FROM parts
        ),
        full_responses AS (
            SELECT uri, captured, max(record_id) AS record_id FROM named
            WHERE status = 200 AND payload IS NOT NULL GROUP BY uri, captured
        ),
        matched AS (
            SELECT v.*, f.record_id AS response_id
            FROM (SELECT * FROM named WHERE status = 304) v
            ASOF LEFT JOIN full_responses f ON v.uri = f.uri AND v.captured > f.captured
        ),
        judged AS (
            SELECT m.*, r.etag AS r_etag, r.modified AS r_modified, r.kind AS r_kind, r.payload AS r_payload,
                   CASE WHEN m.response_id IS NULL THEN 'no_response'
                        WHEN m.etag IS NOT NULL AND r.etag IS NOT NULL
                            THEN CASE WHEN regexp_replace(m.etag, '^W/', '') = r.etag THEN 'resolved' ELSE 'changed' END
                        WHEN m.modified IS NOT NULL AND r.modified IS NOT NULL
                            THEN CASE WHEN m.modified = r.modified THEN 'resolved' ELSE 'changed' END
                        ELSE 'unverified' END AS resolution
            FROM matched m LEFT JOIN named r ON m.response_id = r.record_id
        )
        SELECT record_id, uri, captured, resolution, response_id,
               CASE WHEN resolution IN ('resolved', 'unverified') THEN
                   'connection: close' || chr(10) || 'content-type: ' || r_kind || chr(10) || 'date: ' || captured
                   || coalesce(chr(10) || 'etag: ' || coalesce(etag, r_etag), '')
                   || coalesce(chr(10) || 'last-modified: ' || coalesce(modified, r_modified), '') END AS headers,
               CASE WHEN resolution IN ('resolved', 'unverified') THEN sha256(r_payload) END AS payload_sha256,
               CASE WHEN resolution IN ('resolved', 'unverified') THEN CAST(strlen(r_payload) AS BIGINT) END AS payload_bytes
        FROM judged
    """,
    "op4_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ),
        sized AS (
            SELECT *, role = 'assistant' AS reply,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos,
                   count(*) OVER (PARTITION BY conv_id) AS n,
                   14 + length(role) + length(text) + length(regexp_replace(role, '[^\\#<:]', '', 'g'))
                      + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS chars
            FROM turns
        ),
        summed AS (
            SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM sized
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE reply), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE reply), '')) AS loss_sha256,
               CAST(sum(prefix) FILTER (WHERE reply OR pos = n) AS BIGINT) AS formatted_chars
        FROM summed GROUP BY conv_id
    """,
    "op5_substring": r"""
        WITH words AS MATERIALIZED (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ),
        windows AS MATERIALIZED (
            SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
        ),
        repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
        gone AS (
            SELECT DISTINCT doc_id, i + j AS pos
            FROM windows JOIN repeated USING (h), (SELECT unnest(range(35)) AS j)
        ),
        placed AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM words
        ),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept FROM placed ANTI JOIN gone USING (doc_id, pos)
            GROUP BY doc_id
        ),
        lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM words LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op13_lines": r"""
        WITH split AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM split
        ),
        shared AS (
            SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ),
        judged AS (SELECT k.*, coalesce(doc_id != keeper, false) AS gone FROM keyed k LEFT JOIN shared USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
}
