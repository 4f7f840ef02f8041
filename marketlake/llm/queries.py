"""One query per operator, over its whole table with the settings for production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import chaining, fingerprints, language, licences, merkle, mixing, packing, pca_tiles, phrases, sentencepieces, setsketch, shards, warc
from marketlake.llm.book import QUERIES, SQL, query, table, tokenizer_file

__all__ = ["QUERIES", "SQL"]


@query()
def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    written = shards.shard_table(table(spark, folder, "documents"))
    text = F.col("record.text")
    return written.select(
        F.col("record.doc_id").alias("doc_id"),
        shards.text_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))


@query()
def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepieces.encode_documents(table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query("""
    WITH RECURSIVE worded AS (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
        FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(words) > 0 THEN
            list_distinct(list_transform(range(1, greatest(len(words) - 4, 1) + 1), lambda i: array_to_string(words[i:i + 4], ' '))) ELSE [] END AS items
        FROM worded
    ), sized AS (SELECT doc_id, len(items) AS n FROM sets),
    posted AS MATERIALIZED (SELECT doc_id, unnest(items) AS item FROM sets),
    shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM posted a JOIN posted b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY ALL
    ), links AS MATERIALIZED (
        SELECT a, b FROM shared JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)
    ), reached AS (
        SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
    )
    SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, least_id AS component_id, doc_id = least_id AS kept
    FROM sized JOIN (SELECT a, min(b) AS least_id FROM reached GROUP BY a) ON a = doc_id""")
def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = setsketch.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("""
    WITH RECURSIVE good AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links AS MATERIALIZED (
        SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        WHERE list_cosine_similarity(a.v, b.v) >= 0.98
    ), reached AS (
        SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
    )
    SELECT vec_id, (SELECT count(*) FROM links l WHERE l.a = vec_id) AS n_links, least_id AS component_id, vec_id = least_id AS kept
    FROM embeddings JOIN (SELECT a, min(b) AS least_id FROM reached GROUP BY a) ON a = vec_id""")
def op3_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return pca_tiles.near_vectors(table(spark, folder, "embeddings"))


@query()
def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query()
def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


@query()
def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan_documents(table(spark, folder, "documents"))


@query("""
    WITH payloads AS (
        SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
    ), hashed AS (
        SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM payloads
    ), marked AS (
        SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS original FROM hashed
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN original IS NOT NULL AND original IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN original IS DISTINCT FROM page_id THEN original END AS refers_to
    FROM marked
""")
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.archive_pages(table(spark, folder, "pages"))
    return records.filter("gap_reason is null").select(
        warc.page_id_of("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        warc.page_id_of("refers_to").alias("refers_to"),
    )


@query()
def op4_passages(spark: SparkSession, folder: str) -> DataFrame:
    return chaining.passages(table(spark, folder, "documents"))


@query("""
    WITH RECURSIVE crc AS (
        SELECT list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
    ), chosen AS (
        SELECT *, xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
            lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0 AS tampered
        FROM documents, crc
    ), fields AS (
        SELECT doc_id, source,
            coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
            || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head,
            coalesce(octet_length(encode(text)) || ':' || text, '-') AS body,
            CASE WHEN tampered THEN translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE body END AS new_body
        FROM chosen
    ), leaves AS MATERIALIZED (
        SELECT doc_id, source, sha256(head || body) AS leaf, sha256(head || new_body) AS new_leaf,
            row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, sha256(head || body)) - 1 AS rank, count(*) OVER (PARTITION BY source) AS n
        FROM fields
    ), nodes AS (
        SELECT coalesce(source, '') AS source, source IS NULL AS none, 0 AS height, rank, n, leaf AS digest FROM leaves
        UNION ALL
        SELECT source, none, height + 1, rank // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY rank))
        FROM nodes WHERE n > 1 GROUP BY source, none, height, rank // 16
    ), subroots AS MATERIALIZED (
        SELECT source, none, height, digest, row_number() OVER (ORDER BY none DESC, encode(source)) - 1 AS rank, count(*) OVER () AS n FROM nodes WHERE n = 1
    ), tops AS (
        SELECT 0 AS height, rank, n, digest FROM subroots
        UNION ALL
        SELECT height + 1, rank // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY rank)) FROM tops WHERE n > 1 GROUP BY height, rank // 16
    ), sides AS MATERIALIZED (
        SELECT a.source, a.none, a.height, a.rank, coalesce(string_agg(b.digest, '' ORDER BY b.rank) FILTER (b.rank < a.rank), '') AS before,
            coalesce(string_agg(b.digest, '' ORDER BY b.rank) FILTER (b.rank > a.rank), '') AS after
        FROM nodes a JOIN nodes b ON a.source = b.source AND a.none = b.none AND a.height = b.height AND a.rank // 16 = b.rank // 16
        WHERE a.n > 1 GROUP BY ALL
    ), top_sides AS MATERIALIZED (
        SELECT a.height, a.rank, coalesce(string_agg(b.digest, '' ORDER BY b.rank) FILTER (b.rank < a.rank), '') AS before,
            coalesce(string_agg(b.digest, '' ORDER BY b.rank) FILTER (b.rank > a.rank), '') AS after
        FROM tops a JOIN tops b ON a.height = b.height AND a.rank // 16 = b.rank // 16 WHERE a.n > 1 GROUP BY ALL
    ), lower_fold AS (
        SELECT doc_id, coalesce(source, '') AS source, source IS NULL AS none, leaf, rank AS place, 0 AS height, rank, n, new_leaf AS digest, '' AS proof FROM leaves
        UNION ALL
        SELECT f.doc_id, f.source, f.none, f.leaf, f.place, f.height + 1, f.rank // 16, (f.n + 15) // 16, sha256(s.before || f.digest || s.after), f.proof || s.before || s.after
        FROM lower_fold f JOIN sides s ON f.source = s.source AND f.none = s.none AND f.height = s.height AND f.rank = s.rank
    ), upper_fold AS (
        SELECT f.doc_id, f.leaf, f.source, f.none, f.place, 0 AS height, r.rank, r.n, r.digest AS subroot, f.digest, f.proof
        FROM lower_fold f JOIN subroots r ON f.source = r.source AND f.none = r.none WHERE f.n = 1
        UNION ALL
        SELECT f.doc_id, f.leaf, f.source, f.none, f.place, f.height + 1, f.rank // 16, (f.n + 15) // 16, f.subroot, sha256(s.before || f.digest || s.after), f.proof || s.before || s.after
        FROM upper_fold f JOIN top_sides s ON f.height = s.height AND f.rank = s.rank
    )
    SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, f.digest AS folded_root, f.digest = t.digest AS verified
    FROM upper_fold f, (SELECT digest FROM tops WHERE n = 1) t WHERE f.n = 1""")
def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.audited(table(spark, folder, "documents"), tampered, {"text": merkle.lowered(F.col("text"))})


@query("""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents
    ), worded AS (
        SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
    ), placed AS (SELECT id, lang, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM worded),
    sized AS (SELECT lang, count(*) AS n FROM placed GROUP BY lang),
    windows AS (
        SELECT lang, [word, lead(word, 1) OVER pieced, lead(word, 2) OVER pieced, lead(word, 3) OVER pieced] AS words
        FROM placed WINDOW pieced AS (PARTITION BY id ORDER BY place)
    ), grams AS (
        SELECT lang, size, words[:size] AS words FROM windows, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE words[size] IS NOT NULL
    ), found AS MATERIALIZED (
        SELECT lang, size, words, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
    ), halves AS MATERIALIZED (
        SELECT lang, words, f AS a, k, words[:k] AS left_part, words[k + 1:] AS right_part FROM found, (SELECT unnest([1, 2, 3]) AS k) WHERE k < size
    ), cuts AS (
        SELECT h.lang, h.words, a, k, x.f AS l, y.f AS r, 2000000::HUGEINT * a // (x.f + y.f) AS score
        FROM halves h JOIN found x ON x.lang = h.lang AND x.words = left_part JOIN found y ON y.lang = h.lang AND y.words = right_part
    ), best AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
    ), inner_parts AS (
        SELECT lang, words[s:s + m - 1] AS words, max(f) AS most
        FROM found, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS s) WHERE m < size AND s + m - 1 <= size GROUP BY ALL
    ), ranked AS (
        SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(array_to_string(b.words, ' '))) AS rank,
            array_to_string(b.words, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score
        FROM best b LEFT JOIN inner_parts i ON i.lang = b.lang AND i.words = b.words WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sized USING (lang) WHERE rank <= 2000""")
def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


@query()
def op12_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(
        table(spark, folder, "documents"), F.array("source"), mixing.in_turn([5, 2, 1]), mixing.word_count(F.col("text"))
    )
    own = F.col("by_source")[0]
    return mixed.select("doc_id", "size", own["source_size"].alias("source_size"), own["target"].alias("target"), "taken")
