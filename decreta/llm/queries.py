"""The thin queries of the operators over whole tables, and the SQL that checks them."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from decreta.llm.chat import chat_trees, read_conversations
from decreta.llm.hard_negatives import hard_negatives
from decreta.llm.langid import predict_languages, train_languages
from decreta.llm.lexical import lexical_search
from decreta.llm.packing import pack_documents
from decreta.llm.pieces import encode_pieces
from decreta.llm.quality import quality
from decreta.llm.secrets import scan_secrets
from decreta.llm.simhash import simhash_components
from decreta.llm.substring import substring_dedup
from decreta.llm.token_files import read_tokens, write_tokens
from decreta.llm.toxicity import toxicity
from decreta.llm.vectors import near_vectors
from decreta.session import shared_folder

QUERIES, ORACLES = {"pipeline": corpus_pipeline.run}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_simhash_near_dedup")
def op2(spark, d):
    return simhash_components(table(spark, d, "documents"))


@query("op6_quality_rules")
def op6(spark, d):
    return quality(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op10_substring_dedup", r"""
WITH w AS (
  SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(words) - 48)) AS i, words FROM w WHERE len(words) >= 50),
windows AS (SELECT doc_id, i, sha256(array_to_string(words[i:i + 49], ' ')) AS h FROM starts),
earlier AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM windows JOIN earlier USING (h) WHERE doc_id > first),
removed AS (SELECT doc_id, list(i) AS places FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN places IS NULL THEN words ELSE
    [words[j] FOR j IN range(1, len(words) + 1) IF NOT list_contains(places, j)] END, ' ')) AS kept_sha256
FROM w LEFT JOIN removed USING (doc_id)""")
def op10(spark, d):
    return substring_dedup(table(spark, d, "documents"))


@query("op5_best_fit_packing")
def op5(spark, d):
    return pack_documents(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=0)


@query("op9_token_files")
def op9(spark, d):
    path = f"{shared_folder(spark)}/staged/token-files-{uuid.uuid4().hex}"
    write_tokens(table(spark, d, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return read_tokens(spark, path)


@query("op3_secret_scan")
def op3(spark, d):
    return scan_secrets(table(spark, d, "documents"))


@query("op1_near_vectors", """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM sound UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(component_id, vec_id) AS component_id,
  coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id""")
def op1(spark, d):
    return near_vectors(table(spark, d, "embeddings"))


# The escape that the template puts into control strings, and the marks around a turn.
_FORMATTED = r"""regexp_replace({}, '([<\[])(\\*)(/?s>|/?INST\]|\|)', '\1\\\2\3', 'g')"""


@query("op4_chat_trees", rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
s AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length('<|im_start|>') + length({_FORMATTED.format("replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n')")}) + 1
      + length({_FORMATTED.format("text")}) + length('<|im_end|>') + 1) AS chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(chars AS BIGINT) AS formatted_chars FROM s""")
def op4(spark, d):
    extra = spark.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return read_conversations(*chat_trees(rows, tokenizer), tokenizer)


@query("op7_language_id")
def op7(spark, d):
    docs = table(spark, d, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    model = train_languages(docs.filter(~held_out & F.col("doc_id").isNotNull()))
    return predict_languages(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op8_sentence_pieces")
def op8(spark, d):
    return encode_pieces(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_toxicity")
def op11(spark, d):
    return toxicity(table(spark, d, "documents"), table(spark, d, "labels"), F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1)


@query("op12_hard_negatives", """
WITH sound AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x) OR abs(256 * CAST(x AS DOUBLE)) > 67108864]) = 0),
asked AS (SELECT row_number() OVER () AS a, * FROM (SELECT DISTINCT vec_id, label, v FROM sound WHERE vec_id % 100 = 0)),
pairs AS (
  SELECT a, asked.vec_id AS anchor_id, s.vec_id, s.label = asked.label AS same, CAST(list_inner_product(asked.v, s.v) AS BIGINT) AS score
  FROM asked JOIN sound s ON len(asked.v) = len(s.v) AND s.vec_id IS DISTINCT FROM asked.vec_id),
positives AS (
  SELECT a, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST) AS p
  FROM pairs WHERE same QUALIFY p <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.a, p.p ORDER BY n.score DESC, n.vec_id NULLS LAST) AS INTEGER) AS rank,
  n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.a = p.a AND NOT n.same AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
QUALIFY rank <= 10""")
def op12(spark, d):
    return hard_negatives(table(spark, d, "embeddings"))


# Terms of a text, with only A-Z lower-cased.
_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@query("op13_lexical_search", rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
totals AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
wanted AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
counts AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
known AS (SELECT counts.* FROM counts SEMI JOIN wanted USING (term)),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM known, totals GROUP BY term, n_docs),
lengths AS (SELECT r, doc_id, 10 + (90 * len(terms) * n_docs) // n_terms AS m FROM d, totals),
gains AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS gain FROM known JOIN weights USING (term) JOIN lengths USING (r)),
scores AS (SELECT item_id, r, doc_id, CAST(sum(gain) AS BIGINT) AS score FROM wanted JOIN gains USING (term) GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10""")
def op13(spark, d):
    return lexical_search(table(spark, d, "documents"), table(spark, d, "benchmark"))
