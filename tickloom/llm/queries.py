"""The named queries of the operators and their SQL."""

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.chat import format_pairs, pairs_with_borrowed_turns
from tickloom.llm.common import id_remainder, read_table
from tickloom.llm.fingerprint import fingerprints
from tickloom.llm.hnsw import build_index, search
from tickloom.llm.html_tree import extract
from tickloom.llm.langid import fit_languages, identify
from tickloom.llm.lexical import ranked
from tickloom.llm.mixing import mixed
from tickloom.llm.ngram_join import ngram_join
from tickloom.llm.packing import packed, token_pieces
from tickloom.llm.pieces import encode_texts
from tickloom.llm.shards import balanced_shards
from tickloom.llm.toxicity import fit_toxicity, score_toxicity
from tickloom.llm.whitening import whitened_rows


def op1_pfair_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Sources of ``documents`` by the power 0.8 of their sizes, in blocks of 8 documents."""
    return mixed(read_table(spark, folder, "documents"))


def op2_tree_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Every page, also those without html, whose text is empty."""
    return extract(read_table(spark, folder, "pages").select("page_id", "url", "html"))


def op3_piecewise_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(read_table(spark, folder, "documents"))


def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join(read_table(spark, folder, "documents"), words=4, percent=85)


def piece_model() -> str:
    """Where the SentencePiece model lies, on every machine alike."""
    return os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return encode_texts(docs, piece_model()).select("doc_id", "n_tokens", "ids", "round_trip")


def op6_nearest_centroid(spark: SparkSession, folder: str) -> DataFrame:
    """The classifier never rejects here: the contract wants a learnt value for every text with a letter."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder("doc_id", 3) == 1
    model = fit_languages(docs.where(~held_out))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op7_small_world(spark: SparkSession, folder: str) -> DataFrame:
    """Queries are the rows whose id is divisible by 50; every row is indexed."""
    vectors = read_table(spark, folder, "embeddings").select("vec_id", "embedding")
    k = 5
    return search(build_index(vectors, keep=k + 1), vectors.where(F.col("vec_id") % 50 == 0), k=k)


def op8_preference_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation against itself with the partner conversation's turns from the first differing reply on.

    Spans are written as text, "start-end" with commas between.
    """
    def text_of(column: str) -> Column:
        spans = F.transform(column, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(spans, ",").alias(column)

    pairs = format_pairs(pairs_with_borrowed_turns(read_table(spark, folder, "conversations")))
    return pairs.select(
        "pair_id", "common_turns", "prompt", "chosen", "rejected", text_of("chosen_spans"), text_of("rejected_spans"))


def op9_compression_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    held_out = id_remainder("doc_id", 4) == 2
    labels = read_table(spark, folder, "labels").select("doc_id", "toxic").where(~held_out)
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_differencing_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = balanced_shards(read_table(spark, folder, "documents"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """``deviation`` is null where the exact number does not fit a long."""
    rows = whitened_rows(read_table(spark, folder, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


def pack_tokenizer() -> str:
    """Where the tokenizer for packing lies, on every machine alike."""
    import public_tokenizers

    return os.environ.get("PACK_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")


def op12_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packed(token_pieces(read_table(spark, folder, "documents"), pack_tokenizer()))


def op13_presence_masks(spark: SparkSession, folder: str) -> DataFrame:
    return ranked(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


QUERIES = {
    "op1_pfair_mixing": op1_pfair_mixing,
    "op2_tree_scoring": op2_tree_scoring,
    "op3_piecewise_fingerprints": op3_piecewise_fingerprints,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_nearest_centroid": op6_nearest_centroid,
    "op7_small_world": op7_small_world,
    "op8_preference_chat": op8_preference_chat,
    "op9_compression_toxicity": op9_compression_toxicity,
    "op10_differencing_shards": op10_differencing_shards,
    "op11_whitening": op11_whitening,
    "op12_best_fit": op12_best_fit,
    "op13_presence_masks": op13_presence_masks,
}

# Runs of letters and digits, and of anything beyond ASCII.
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES: dict[str, str] = {
    "op4_ngram_jaccard": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
      WHEN len(ws) = 0 THEN []
      WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * i >= 85 * (na.n + nb.n - i)
), r(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
""",
    # The sides part at the first pair of replies that differ; without one, the last turn is the completion.
    "op8_preference_chat": """
WITH n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)
), replies AS (
  SELECT conv_id, k, text, row_number() OVER (PARTITION BY conv_id ORDER BY k) AS place FROM n WHERE role = 'assistant'
), cuts AS (
  SELECT a.conv_id, arg_min(a.k, place) AS own, arg_min(b.k, place) AS other
  FROM replies a JOIN replies b USING (place) WHERE b.conv_id = xor(a.conv_id, 1) AND a.text <> b.text GROUP BY a.conv_id
), ids AS (
  SELECT conv_id, max(k) AS m FROM n GROUP BY conv_id
), p AS (
  SELECT ids.conv_id, coalesce(own, m) AS start, other FROM ids LEFT JOIN cuts USING (conv_id)
), sides AS (
  SELECT p.conv_id, 'prompt' AS side, n.* EXCLUDE (conv_id) FROM p JOIN n ON n.conv_id = p.conv_id AND k < start
  UNION ALL
  SELECT p.conv_id, 'chosen', n.* EXCLUDE (conv_id) FROM p JOIN n ON n.conv_id = p.conv_id AND k >= start
  UNION ALL
  SELECT p.conv_id, 'rejected', n.* EXCLUDE (conv_id) FROM p JOIN n ON n.conv_id = xor(p.conv_id, 1) AND k >= other
), placed AS (
  SELECT *, coalesce(sum(length(rendered)) OVER (
    PARTITION BY conv_id, side ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM sides
), texts AS (
  SELECT conv_id, side, string_agg(rendered, '' ORDER BY k) AS body,
         coalesce(string_agg((place + 22) || '-' || (place + length(rendered) - 1), ',' ORDER BY k)
                  FILTER (role = 'assistant'), '') AS spans
  FROM placed GROUP BY conv_id, side
)
SELECT p.conv_id AS pair_id, CAST(start - 1 AS INTEGER) AS common_turns, coalesce(t.body, '') AS prompt,
  c.body AS chosen, r.body AS rejected, c.spans AS chosen_spans, r.spans AS rejected_spans
FROM p
LEFT JOIN texts t ON t.conv_id = p.conv_id AND t.side = 'prompt'
LEFT JOIN texts c ON c.conv_id = p.conv_id AND c.side = 'chosen'
LEFT JOIN texts r ON r.conv_id = p.conv_id AND r.side = 'rejected'
""",
    "op13_presence_masks": rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS ws
  FROM documents
), whole AS (
  SELECT CAST(count(*) FILTER (len(ws) > 0) AS BIGINT) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM d
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS term FROM benchmark
), t AS (
  SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(ws) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY row_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM t, whole GROUP BY term
), lengths AS (
  SELECT row_id, doc_id, 10 + (90 * len(ws) * n_docs) // n_terms AS m FROM d, whole
), scores AS (
  SELECT item_id, row_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS score
  FROM q JOIN t USING (term) JOIN weights USING (term) JOIN lengths USING (row_id) GROUP BY item_id, row_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scores JOIN lengths USING (row_id) WHERE score > 0
)
WHERE rank <= 10
""",
}
