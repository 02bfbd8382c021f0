"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidegate.llm import bpe, chat
from tidegate.llm.common import table
from tidegate.llm.exact_dedup import exact_groups
from tidegate.llm.language import identify
from tidegate.llm.near_dedup import near_classes
from tidegate.llm.packing import pack_documents
from tidegate.llm.quality import score_quality
from tidegate.llm.runs import periodic_runs
from tidegate.llm.sharding import shard_documents
from tidegate.llm.substring import remove_repeats
from tidegate.llm.topk import search
from tidegate.llm.toxicity import score_toxicity
from tidegate.llm.whitening import whiten

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_factorization_machine(spark, sf_dir):
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", parts=5, part=0)


def op2_tree_bpe(spark, sf_dir):
    tokens = bpe.encode(table(spark, sf_dir, "documents"), RANKS)
    return bpe.digests(bpe.decode(tokens, RANKS))


def op3_ftrl_ngrams(spark, sf_dir):
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", parts=3, part=1)


def op4_prob_min_hash(spark, sf_dir):
    return near_classes(table(spark, sf_dir, "documents"), threshold=0.8).drop("key")


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), m AS (
  SELECT array_to_string(words, ' ') AS norm, any_value(words) AS words, min(doc_id) AS node, count(*) AS copies FROM w GROUP BY 1
), g AS (
  SELECT DISTINCT node, hash(array_to_string(words[p:p + 4], ' ')) AS gram FROM (SELECT node, words, unnest(range(1, len(words) - 3)) AS p FROM m)
), size AS (
  SELECT node, count(*) AS n FROM g GROUP BY node
), common AS (
  SELECT x.node AS a, y.node AS b, count(*) AS c FROM g x JOIN g y ON x.gram = y.gram AND x.node < y.node GROUP BY 1, 2
), link AS (
  SELECT a, b FROM common JOIN size s ON s.node = a JOIN size t ON t.node = b WHERE c * 10 >= 8 * (s.n + t.n - c)
), both_ways AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT node, node AS other FROM m UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.other = e.a
), label AS (
  SELECT node, min(other) AS class_id FROM reach GROUP BY node
), class AS (
  SELECT class_id, CAST(sum(copies) AS BIGINT) AS class_size FROM label JOIN m USING (node) GROUP BY class_id
)
SELECT doc_id, class_id, node AS copy_of, class_size, doc_id = class_id AS kept
FROM w JOIN m ON array_to_string(w.words, ' ') = m.norm JOIN label USING (node) JOIN class USING (class_id)
"""


def op5_uniform_threshold(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter("vec_id % 50 = 0"), k=5, scale=256.0)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


def op6_jump_shards(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"), shards=24)


OP6_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size,
         xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda p: CAST('0x' || p AS BIGINT))),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS UBIGINT) AS key
  FROM documents, crc_table
), jump AS (
  SELECT DISTINCT key, CAST(key AS HUGEINT) AS state, CAST(0 AS BIGINT) AS reach FROM d
  UNION ALL
  SELECT key, state, CAST(floor((reach + 1) * (CAST(2147483648 AS DOUBLE) / CAST(state // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT key, reach, (state * 2862933555777941757 + 1) % 18446744073709551616 AS state FROM jump WHERE reach < 25)
), shards AS (
  SELECT key, CAST(max(reach) FILTER (reach < 24) AS INTEGER) AS shard, CAST(max(reach) FILTER (reach < 25) AS INTEGER) AS grown_shard FROM jump GROUP BY key
), prints AS (
  SELECT *, md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), size, text_crc32)) AS print, greatest(64, (count(*) OVER () + 65535) // 65536) AS blocks FROM d
), dealt AS (
  SELECT *, count(*) OVER (PARTITION BY print) >= 65536 AS crowd, CAST('0x' || substr(print, 1, 15) AS BIGINT) % blocks AS block FROM prints
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY CASE WHEN crowd THEN print ELSE '' END, CASE WHEN crowd THEN 0 ELSE block END,
                          doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
FROM dealt JOIN shards USING (key)
"""


def op7_preference_pairs(spark, sf_dir):
    chosen, rejected = chat.swapped_replies(table(spark, sf_dir, "conversations"))
    pairs = chat.render(chat.segments(chosen, rejected))

    def written_out(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")

    return pairs.select(
        F.col("pair_id").alias("conv_id"), "prompt", "chosen", "rejected", written_out("chosen_loss").alias("chosen_loss"),
        written_out("rejected_loss").alias("rejected_loss"), F.col("prompt_turns").cast("long").alias("prompt_turns"),
    )


OP7_SQL = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), last AS (
  SELECT conv_id, turn, text FROM t WHERE role = 'assistant'
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) = 1
), reply AS (
  SELECT conv_id, turn,
         CASE WHEN count(*) OVER (PARTITION BY conv_id // 64) = 1 THEN ''
              ELSE coalesce(lead(text) OVER (PARTITION BY conv_id // 64 ORDER BY conv_id),
                            first_value(text) OVER (PARTITION BY conv_id // 64 ORDER BY conv_id)) END AS reply
  FROM last
), rejected AS (
  SELECT DISTINCT t.conv_id, t.turn, t.role, CASE WHEN t.role = 'assistant' AND r.reply IS NOT NULL THEN r.reply ELSE t.text END AS text
  FROM t LEFT JOIN reply r ON t.conv_id = r.conv_id AND t.turn = r.turn
), u AS (
  SELECT conv_id, turn, role, text, max(c) AS c, max(r) AS r
  FROM (SELECT *, 1 AS c, 0 AS r FROM t UNION ALL SELECT *, 0, 1 FROM rejected) GROUP BY conv_id, turn, role, text
), d AS (
  SELECT conv_id, min(turn) AS parting FROM u WHERE c + r < 2 GROUP BY conv_id
), s AS (
  SELECT u.conv_id, turn, role, text, c, r, coalesce(turn < parting, true) AS common,
         '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered
  FROM u LEFT JOIN d USING (conv_id)
), p AS (
  SELECT *, 'prompt' AS part FROM s WHERE common
  UNION ALL SELECT *, 'chosen' FROM s WHERE NOT common AND c = 1
  UNION ALL SELECT *, 'rejected' FROM s WHERE NOT common AND r = 1
), e AS (
  SELECT *, sum(length(rendered)) OVER (PARTITION BY conv_id, part ORDER BY turn, role, text) AS stop FROM p
), m AS (
  SELECT *, CASE WHEN role = 'assistant' THEN CAST(stop - length(rendered) + length(role) + 5 AS VARCHAR) || '-' || CAST(stop AS VARCHAR) END AS span FROM e
)
SELECT conv_id,
       coalesce(string_agg(rendered, '' ORDER BY turn, role, text) FILTER (part = 'prompt'), '') AS prompt,
       coalesce(string_agg(rendered, '' ORDER BY turn, role, text) FILTER (part = 'chosen'), '') AS chosen,
       coalesce(string_agg(rendered, '' ORDER BY turn, role, text) FILTER (part = 'rejected'), '') AS rejected,
       coalesce(string_agg(span, ',' ORDER BY turn, role, text) FILTER (part = 'chosen'), '') AS chosen_loss,
       coalesce(string_agg(span, ',' ORDER BY turn, role, text) FILTER (part = 'rejected'), '') AS rejected_loss,
       count(*) FILTER (part = 'prompt') AS prompt_turns
FROM m GROUP BY conv_id
"""


def op8_residual_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), RANKS, capacity=1024, end_id=2)


def op9_suffix_automata(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"), window=13)


def op10_chunk_recipes(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents")).drop("key")


def op11_viterbi_spans(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"), parts=4, part=2)


def op12_dyadic_runs(spark, sf_dir):
    return periodic_runs(table(spark, sf_dir, "documents"), least_exponent=4, least_length=6, plant=True)


def op13_whitened_components(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"), components=8)


OP9_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), g AS (
  SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM w)
), hit AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY win) AS least FROM g) WHERE least < doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS place FROM hit
), word AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) AS BIGINT) - coalesce(kept.n, 0) AS n_removed,
       sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""

QUERIES = {
    "op1_factorization_machine": op1_factorization_machine,
    "op2_tree_bpe": op2_tree_bpe,
    "op3_ftrl_ngrams": op3_ftrl_ngrams,
    "op4_prob_min_hash": op4_prob_min_hash,
    "op5_uniform_threshold": op5_uniform_threshold,
    "op6_jump_shards": op6_jump_shards,
    "op7_preference_pairs": op7_preference_pairs,
    "op8_residual_packing": op8_residual_packing,
    "op9_suffix_automata": op9_suffix_automata,
    "op10_chunk_recipes": op10_chunk_recipes,
    "op11_viterbi_spans": op11_viterbi_spans,
    "op12_dyadic_runs": op12_dyadic_runs,
    "op13_whitened_components": op13_whitened_components,
}

ORACLES = {
    "op4_prob_min_hash": OP4_SQL,
    "op6_jump_shards": OP6_SQL,
    "op7_preference_pairs": OP7_SQL,
    "op5_uniform_threshold": OP5_SQL,
    "op9_suffix_automata": OP9_SQL,
    "op10_chunk_recipes": OP10_SQL,
}
