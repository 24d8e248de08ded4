"""The registered queries of this subpackage, one for each operator, and SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import (
    attention_lm, bpe_tokens, chat_windows, collocations, conversation_trie, fingerprints, neighbour_graph, ngram_join, packing, private_data, quality, sentence_pieces, suffix_dedup,
)
from rowloom.llm.common import table
from rowloom.session import durable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 512


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


CHAT_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) t(i)
), sized AS (
  SELECT *, CAST(ceil(strlen(text) / 4) AS BIGINT) + 4 AS tokens,
    12 + length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(' || chr(8288) || '*)\|', '<' || chr(8288) || '\1|', 'g'))
    + 1 + length(regexp_replace(text, '<(' || chr(8288) || '*)\|', '<' || chr(8288) || '\1|', 'g')) + 11 AS chars
  FROM given
), placed AS (
  SELECT *, row_number() OVER o AS place, sum(tokens) OVER o - tokens AS start, count(*) OVER (PARTITION BY conv_id) AS turns,
    CASE WHEN first_value(role) OVER o = 'system' THEN first_value(tokens) OVER o ELSE 0 END AS system_tokens
  FROM sized WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, tokens, text ROWS UNBOUNDED PRECEDING)
), halved AS (
  SELECT *, greatest((768 - system_tokens) // 2, 1) AS half, place = 1 AND role = 'system' AS leads FROM placed
), counted AS (
  SELECT *, tokens > half AS is_long, sum(CASE WHEN tokens > half THEN 1 ELSE 0 END) OVER o AS longs,
    sum(CASE WHEN tokens > half THEN 0 ELSE tokens END) OVER o - CASE WHEN tokens > half THEN 0 ELSE tokens END AS short_start
  FROM halved WINDOW o AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)
), spans AS (
  SELECT conv_id, longs, CASE WHEN is_long THEN -1 ELSE short_start // half END AS bucket, min(place) AS first_place, min(start) AS span_start,
    any_value(turns) AS turns
  FROM counted WHERE NOT leads OR turns = 1 GROUP BY ALL
), repeated AS (
  SELECT s.conv_id, sum(c.chars) AS chars FROM spans s JOIN counted c ON s.conv_id IS NOT DISTINCT FROM c.conv_id
  WHERE s.turns > 1 AND (c.leads AND s.first_place > 2 OR NOT c.leads AND c.place < s.first_place AND c.start >= s.span_start - 256)
  GROUP BY s.conv_id
), told AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS loss, sum(chars) AS chars
  FROM counted GROUP BY conv_id
)
SELECT told.conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(told.chars + coalesce(repeated.chars, 0) AS BIGINT) AS formatted_chars
FROM told LEFT JOIN repeated ON told.conv_id IS NOT DISTINCT FROM repeated.conv_id
"""


@query("op1_chat_windows", CHAT_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of all conversations and of one that consists of markers, read back from the formatted text."""
    said = "<|im_end|><|im_start|>assistant ok"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    back = chat_windows.read_back(chat_windows.chat_windows(given.unionByName(marked)))
    ordered = back.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("window_start", "turns", "targets"))).alias("w"), F.sum(F.length("formatted")).alias("formatted_chars"))
    turns = F.flatten(F.transform("w", lambda x: x["turns"]))
    told = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.flatten(F.transform("w", lambda x: x["targets"])), "")
    return ordered.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


REPEATS_SQL = r"""
WITH given AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), pieces AS (
  SELECT doc_id, n, b, substring(h, 512 * b + 1, 610) AS part FROM (SELECT *, unnest(range(0, (n + 206) // 256)) AS b FROM given WHERE n >= 50)
), starts AS (
  SELECT doc_id, b, part, unnest(range(0, least(256, n - 49 - 256 * b))) AS j FROM pieces
), strings AS (
  SELECT doc_id, 256 * b + j AS i, substring(part, 2 * j + 1, 100) AS w FROM starts
), firsts AS (
  SELECT w, min(doc_id) AS first_id FROM strings GROUP BY w HAVING min(doc_id) < max(doc_id)
), repeats AS (
  SELECT doc_id, i, lag(i) OVER o AS earlier, lead(i) OVER o AS later
  FROM strings JOIN firsts USING (w) WHERE first_id < doc_id
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), cuts AS (
  SELECT doc_id, CAST(sum(least(50, coalesce(later - i, 50))) AS BIGINT) AS n_removed,
    count(*) FILTER (WHERE earlier IS NULL OR i > earlier + 50) AS n_spans,
    string_agg(substring(h, 2 * coalesce(earlier + 50, 0) + 1, 2 * greatest(0, i - coalesce(earlier + 50, 0))), '' ORDER BY i) AS kept,
    max(i) + 50 AS last_end
  FROM repeats JOIN given USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(last_end, 0) + 1))) AS kept_sha256
FROM given LEFT JOIN cuts USING (doc_id)
"""


@query("op2_suffix_dedup", REPEATS_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), min_bytes=50)
    return cut.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_private_data")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = private_data.redact(docs, private_data.fit_private(docs))
    spans = F.col("private_spans")

    def listed(of) -> Column:
        return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter(spans, lambda s: s["kind"].isin(*private_data.BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in private_data.BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans"),
        F.sha2("text", 256).alias("redacted_sha256"), *[count(k) for k in ("contact", "number", "secret")],
    )


@query("op4_cotrained_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_cotraining(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs, model)
    return scored.select(
        F.col("id").alias("doc_id"), "content_score", "metadata_score", "score", (F.col("score") >= quality.KEEP_FROM).alias("keep")
    )


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), 2048, 0)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


SIMILAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\r\f\x0B]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN ['']
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s
  FROM words
), items AS (SELECT doc_id, unnest(s) AS x FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b, i, p.n AS pn, q.n AS qn FROM shared JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
  WHERE 5 * i >= 4 * (p.n + q.n - i)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT documents.doc_id, (SELECT min(b) FROM reach WHERE reach.a = documents.doc_id) AS class_id,
  (SELECT count(*) FROM links WHERE links.a = documents.doc_id) AS n_links,
  (SELECT count(*) FROM links WHERE links.a = documents.doc_id AND i = pn AND i = qn) AS n_copies
FROM documents
"""


@query("op6_ngram_jaccard_join", SIMILAR_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = ngram_join.similar_documents(table(spark, sf_dir, "documents"), threshold=0.8, shingle_words=5)
    return classes.select(F.col("id").alias("doc_id"), "class_id", "n_links", "n_copies")


@query("op7_sentence_pieces", None)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every whole text, and whether their text is the one given."""
    path = public_tokenizers.path(PIECES)
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    encoded = sentence_pieces.encode_pieces(docs.select("doc_id", "text", F.sha2("text", 256).alias("text_sha256")).select("doc_id", "text_sha256", "text"), path).drop("text")
    decoded = sentence_pieces.decode_pieces(encoded, path)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_xxhash64"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"),
    )


@query("op8_simhash_fingerprints")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op9_graph_neighbours")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbour_graph.nearest_by_product(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = bpe_tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return counted.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


TRIE_SQL = r"""
WITH given AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
    lambda c, b: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
    4294967295), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM given)
), leads AS (
  SELECT ids.conv_id, base, h, count(g.place) AS k FROM ids LEFT JOIN given g ON g.conv_id = base AND g.place <= h GROUP BY ALL
), rebuilt AS (
  SELECT c.conv_id, g.place, role, text FROM leads c JOIN given g ON g.conv_id = c.base AND g.place <= c.h
  UNION ALL
  SELECT c.conv_id, g.place - c.h + c.k, role, text FROM leads c JOIN given g ON g.conv_id = c.conv_id AND g.place > c.h
), paths AS (
  SELECT conv_id, place AS depth, length(text) AS points,
    sha256(string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY place)) AS path
  FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, 'root' FROM ids
), ended AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM paths
), nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(points) AS points, bool_and(ends) AS leaf,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM ended GROUP BY depth, path
), parents AS (
  SELECT n.depth, n.path, p.path AS parent FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
), children AS (
  SELECT depth - 1 AS depth, parent AS path, count(*) AS n_children FROM parents GROUP BY ALL
), below AS (
  SELECT a.depth, a.path, sum((n.n_convs - 1) * n.points) AS saved_tokens, count(*) FILTER (WHERE n.leaf) AS n_leaves
  FROM nodes n JOIN paths a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.depth, a.path
)
SELECT n.conv_id, n.depth, t.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, b.n_leaves,
  CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.depth = n.depth AND b.path = n.path
LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path
LEFT JOIN parents p ON p.depth = n.depth AND p.path = n.path
LEFT JOIN nodes t ON t.depth = n.depth - 1 AND t.path = p.parent
"""


@query("op11_conversation_trie", TRIE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each rebuilt to begin with turns that its hundred share."""
    turns = durable(conversation_trie.placed_turns(table(spark, sf_dir, "conversations")))
    return conversation_trie.prefix_trie(*conversation_trie.with_shared_openings(turns))


PHRASES_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
  FROM documents
), parted AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM parted GROUP BY lang
), phrases AS (
  SELECT lang, m, w[i:i + m - 1] AS p, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM parted, (SELECT unnest(range(1, 6)) AS m))
  GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT c.lang, c.m, c.p, c.f AS a, t.n, h.f AS l, g.f AS r, h.m AS k,
    CAST((CAST(1000 AS HUGEINT) * c.f * t.n) // (CAST(h.f AS HUGEINT) * g.f) AS BIGINT) AS score
  FROM phrases c JOIN totals t USING (lang) JOIN phrases h ON h.lang = c.lang AND h.m < c.m AND h.p = c.p[1:h.m]
  JOIN phrases g ON g.lang = c.lang AND g.m = c.m - h.m AND g.p = c.p[h.m + 1:c.m]
  WHERE c.m > 1
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), absorbed AS (
  SELECT DISTINCT s.lang, s.p FROM best s JOIN best g ON g.lang = s.lang AND g.m > s.m AND 100 * g.a >= 100 * s.a
    AND list_contains(list_transform(range(1, g.m - s.m + 2), lambda i: g.p[i:i + s.m - 1]), s.p)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
  array_to_string(p, ' ') AS phrase, a, l, r, n, score
FROM best b WHERE NOT EXISTS (SELECT 1 FROM absorbed x WHERE x.lang = b.lang AND x.p = b.p)
QUALIFY rank <= 2000
"""


@query("op12_collocations", PHRASES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), min_count=100, most_words=5, top=2000, absorb_percent=100)


@query("op13_attention_scores")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by what those outside the held-out fold teach."""
    docs = table(spark, sf_dir, "documents")
    apart = attention_lm.held_out(F.col("doc_id"))
    model = attention_lm.fit_language_model(docs.where(~apart).select("text"), public_tokenizers.path(BYTE_BPE))
    scored = attention_lm.score_texts(docs, model)
    return scored.select(
        F.col("id").alias("doc_id"), attention_lm.held_out(F.col("id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
