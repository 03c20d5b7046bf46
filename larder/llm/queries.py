"""The registered queries of this package, with production settings, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import alignment, decontaminate, embedding_dedup, fingerprint, line_dedup, lm_scoring, main_text, pieces, prefix_trie, simhash, token_counts, toxicity, warc
from larder.session import materialize, prepare


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP2_SQL = """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS line_no FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), owners AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT k.doc_id, k.line, k.line_no, o.owner IS NOT NULL AND o.owner <> k.doc_id AS gone
  FROM keyed k LEFT JOIN owners o ON k.key = o.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).drop("text")


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.compare_with_next(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint",
                        "edited_fingerprint", "near_edited", "near_next", "near_edited_extended", "near_next_extended")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, max_distance=2)
    return found.select("doc_id", simhash.hex_fingerprint(found["fp"]).alias("fingerprint"), "component_id")


def _model_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def op6_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    model = _model_file(model_path or public_tokenizers.path("piece_bpe_32k.model"))
    coded = pieces.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), model, decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op8_token_counts(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    tokenizer = _model_file(tokenizer_path or public_tokenizers.path("word_bpe_49k.json")).decode()
    counted = token_counts.prefix_counts(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    legacy = warc.write_arc(_table(spark, sf_dir, "pages"))
    archives = materialize(warc.convert(legacy), "warc")
    return warc.records(archives, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first_id FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.first_id < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id < p.page_id THEN f.first_id END AS refers_to
FROM payloads p LEFT JOIN firsts f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.pseudo_likelihood(_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    a_json = _model_file(a_path or public_tokenizers.path("byte_bpe_50k.json")).decode()
    b_model = _model_file(b_path or public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.statistics(_table(spark, sf_dir, "documents").select("doc_id", "text"), a_json, b_model)


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(prepare(spark), sf_dir, "embeddings").select("vec_id", "embedding"), threshold=0.9)


OP12_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, row_number() OVER () AS n FROM embeddings
), comparable AS (
  SELECT * FROM vectors
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.n, b.n AS other FROM comparable a JOIN comparable b ON a.n <> b.n AND len(a.v) = len(b.v)
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) END >= 0.9
), reached AS (
  SELECT n, n AS other FROM vectors
  UNION
  SELECT r.n, l.other FROM reached r JOIN links l ON r.other = l.n
), named AS (
  SELECT r.n, min(v.vec_id) AS component_id FROM reached r JOIN vectors v ON r.other = v.n GROUP BY r.n
)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.n = v.n) AS n_links, c.component_id,
       v.vec_id IS NOT DISTINCT FROM c.component_id AS kept
FROM vectors v JOIN named c ON v.n = c.n
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = F.col("conv_id")
    return prefix_trie.rebuilt_trie(_table(prepare(spark), sf_dir, "conversations"), base=of - of % 5,
                                    taken=F.crc32(of.cast("string").cast("binary")) % 9)


OP13_SQL = """
WITH RECURSIVE turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), plan AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(
           [4294967295] || flatten(list_transform(string_split(conv_id::VARCHAR, ''),
             lambda c: [ascii(c)::BIGINT] || list_transform(range(8), lambda i: -1))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 9 AS taken
  FROM (SELECT DISTINCT conv_id FROM turns)
), parts AS (
  SELECT p.conv_id, 0 AS part, t.place, t.role, t.text FROM plan p JOIN turns t ON t.conv_id = p.base AND t.place < p.taken
  UNION ALL
  SELECT p.conv_id, 1, t.place, t.role, t.text FROM plan p JOIN turns t ON t.conv_id = p.conv_id AND t.place >= p.taken
), rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth,
         sha256(length(role) || ':' || role || text) AS d, octet_length(encode(text)) AS size
  FROM parts
), paths AS (
  SELECT conv_id, 0 AS depth, '' AS name, CAST(NULL AS VARCHAR) AS up, 0 AS size FROM plan
  UNION ALL
  SELECT r.conv_id, r.depth, sha256(p.name || r.d), p.name, r.size FROM paths p JOIN rebuilt r ON r.conv_id = p.conv_id AND r.depth = p.depth + 1
), nodes AS (
  SELECT name, depth, any_value(up) AS up, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs FROM paths GROUP BY name, depth
), children AS (
  SELECT up, count(*) AS n FROM nodes GROUP BY up
), above AS (
  SELECT DISTINCT a.name, a.depth, u.name AS under FROM paths a JOIN paths u ON a.conv_id = u.conv_id AND a.depth <= u.depth
), totals AS (
  SELECT a.name, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves, sum((u.n_convs - 1) * u.size)::BIGINT AS saved_tokens
  FROM above a JOIN nodes u ON a.under = u.name LEFT JOIN children c ON c.up = u.name GROUP BY a.name
), ends AS (
  SELECT name, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, name, depth, max(depth) OVER (PARTITION BY conv_id) AS n FROM paths) WHERE depth = n GROUP BY name
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       t.n_leaves, t.saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.up = p.name AND n.depth > 0 LEFT JOIN children c ON c.up = n.name
JOIN totals t ON t.name = n.name LEFT JOIN ends e ON e.name = n.name
"""


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_line_dedup": op2_line_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_html_extraction": op7_html_extraction,
    "op8_token_counts": op8_token_counts,
    "op9_warc": op9_warc,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_token_alignment": op11_token_alignment,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op2_line_dedup": OP2_SQL,
    "op9_warc": OP9_SQL,
    "op12_embedding_dedup": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
