"""The registered queries of the training-data operators, with their SQL where SQL can say it.

Each is the thin form of an operator: it applies the operator to its whole
table and derives the columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import collocations, languageid, packing, perspectives, pieces, pii, prefixtrie, quality, repeats, sharding, simhash, tokenfiles, topk
from meterlake.llm.common import table
from meterlake.plans.session import work_folder

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 40
SEGMENTATIONS = 3
PASSAGE = 200  # bytes of 50 words of few letters


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = quality.judge(docs, table(spark, folder, "labels"))
    return judged.select("row.doc_id", "quality.*")


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    path = work_folder(spark, "token-files")
    tokenfiles.write_token_files(tokenfiles.encoded(docs), path)
    found = tokenfiles.scan(spark, path).withColumn("number", tokenfiles.file_number())
    named = found.join(tokenfiles.positions(docs), ["number", "ordinal"], "left")
    return named.select(
        F.col("id").alias("doc_id"), F.col("number").alias("file"), "ordinal", "start", "n_tokens", "ended"
    )


def op3_nbest_pieces(spark: SparkSession, folder: str) -> DataFrame:
    found = pieces.encode(table(spark, folder, "documents"), SEGMENTATIONS, with_ids=False)
    return found.withColumnRenamed("id", "doc_id")


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeats.cut_repeats(table(spark, folder, "documents").select("doc_id", "text"), passage=PASSAGE)
    return cut.select(
        "row.doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # Beyond the contract: what strings of PASSAGE bytes that also start elsewhere cover, which is not cut.
        F.size("passages").cast("long").alias("n_passages"),
        F.expr("aggregate(passages, 0L, (n, s) -> n + s.end - s.start)").alias("passage_bytes"),
    )


def op5_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", topk.whole_numbers(F.col("embedding")).alias("vector"))
    queries = vectors.where("vec_id % 50 = 0")
    # Row counts come from the files' footers; they set the number of parts only.
    n = table(spark, folder, "embeddings").count()
    shards, blocks = topk.parts(n, topk.SHARD_ROWS), topk.parts(n // 50, topk.QUERY_BLOCK)
    return topk.top_k(queries, vectors, 5, shards, blocks)


OP5_SQL = """
WITH whole AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


def op6_pii_sanitisation(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.sanitise(table(spark, folder, "documents").select("doc_id", "text"), with_text=False)
    counts = [
        F.expr(f"size(filter(spans, s -> s.name = '{kind}'))").cast("long").alias(f"n_{kind}") for kind in pii.KINDS[:pii.BASE]
    ]
    return found.select(
        "row.doc_id", *counts, F.sha2(pii.listing("spans", base_only=True).cast("binary"), 256).alias("base_sha256"),
        pii.listing("spans").alias("spans"),
    )


_PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PII_MATCHES = " UNION ALL ".join(
    f"SELECT rid, {n} AS kind, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS gs FROM docs"
    for n, p in enumerate(_PII_PATTERNS.values())
)
_PII_SIDE = r"""SELECT rid, kind, i, entity, context, '{side}' AS side, {offset} AS base, full_{side} AS whole,
  unnest(string_split_regex({side}, '[^\p{{L}}]')) AS w, generate_subscripts(string_split_regex({side}, '[^\p{{L}}]'), 1) AS k,
  len(string_split_regex({side}, '[^\p{{L}}]')) AS n FROM found"""
OP6_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
matched AS ({_PII_MATCHES}),
each AS (SELECT rid, kind, ms, gs, unnest(generate_series(1, len(ms))) AS i FROM matched WHERE len(ms) > 0),
placed AS (
  SELECT rid, kind, i, ms[i] AS value, right(gs[i], {pii.CONTEXT}) AS before, left(gs[i + 1], {pii.CONTEXT}) AS after,
    (sum(length(gs[i]) + length(ms[i])) OVER (PARTITION BY rid, kind ORDER BY i))::BIGINT AS "end" FROM each),
digits AS (SELECT *, "end" - length(value) AS "start", regexp_replace(value, '[^0-9]', '', 'g') AS d FROM placed),
found AS (
  SELECT *, kind::VARCHAR || ':' || lower(value) AS entity, before || chr(1) || after AS context,
    length(before) = {pii.CONTEXT} AS full_before, length(after) = {pii.CONTEXT} AS full_after
  FROM digits WHERE kind = 0
    OR (kind = 1 AND len([x for x in string_split(value, '.') if length(ltrim(x, '0')) > 3 OR
      (length(ltrim(x, '0')) = 3 AND ltrim(x, '0') > '255')]) = 0)
    OR (kind = 2 AND length(d) BETWEEN 12 AND 19 AND list_sum([
      CASE WHEN j % 2 = 1 THEN substr(reverse(d), j, 1)::INT
        WHEN substr(reverse(d), j, 1)::INT > 4 THEN 2 * substr(reverse(d), j, 1)::INT - 9
        ELSE 2 * substr(reverse(d), j, 1)::INT END for j in range(1, length(d) + 1)]) % 10 = 0)
    OR (kind = 3 AND length(d) BETWEEN 9 AND 15)),
words AS ({_PII_SIDE.format(side="before", offset='"start" - length(before)')}
  UNION ALL {_PII_SIDE.format(side="after", offset='"end"')}),
located AS (
  SELECT *, base + coalesce(sum(length(w) + 1) OVER (PARTITION BY rid, kind, i, side ORDER BY k
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "start" FROM words),
near AS (
  SELECT rid, entity, context, lower(w) AS term, "start", "start" + length(w) AS "end" FROM located
  WHERE length(w) >= {pii.TERM_LENGTH} AND NOT (whole AND k = CASE side WHEN 'before' THEN 1 ELSE n END)),
pairs AS (
  SELECT entity, term, count(DISTINCT rid) AS n_both FROM near GROUP BY 1, 2 HAVING count(DISTINCT context) > 1),
by_entity AS (SELECT entity, count(DISTINCT rid) AS n_entity FROM near GROUP BY 1),
by_term AS (
  SELECT term, count(*) AS n_term FROM (SELECT unnest(list_distinct(string_split_regex(lower(t), '[^\p{{L}}]+'))) AS term FROM docs)
  GROUP BY 1),
told AS (
  SELECT entity, term, log2(n_both * n::DOUBLE / (n_term * n_entity)) / log2(n::DOUBLE / n_entity) AS disclosure
  FROM pairs JOIN by_entity USING (entity) JOIN by_term USING (term), (SELECT count(*) AS n FROM docs)
  WHERE n > n_entity),
tells AS (
  SELECT term, max(CASE WHEN disclosure >= {pii.REMOVE} THEN 5 ELSE 4 END) AS kind FROM told
  WHERE disclosure >= {pii.GENERALISE} GROUP BY term),
said AS (
  SELECT rid, unnest(string_split_regex(t, '[^\p{{L}}]')) AS w, generate_subscripts(string_split_regex(t, '[^\p{{L}}]'), 1) AS k FROM docs),
spoken AS (
  SELECT rid, w, coalesce(sum(length(w) + 1) OVER (PARTITION BY rid ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "start"
  FROM said),
terms AS (
  SELECT rid, max(kind) AS kind, "start", "end" FROM (
    SELECT rid, kind, "start", "end" FROM near JOIN tells USING (term)
    UNION ALL SELECT rid, kind, "start", "start" + length(w) AS "end" FROM spoken JOIN tells ON term = lower(w))
  GROUP BY rid, "start", "end"),
every AS (SELECT rid, kind, "start", "end" FROM found UNION ALL SELECT rid, kind, "start", "end" FROM terms),
edged AS (
  SELECT *, max(CASE WHEN kind < 4 THEN "end" END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
    min(CASE WHEN kind < 4 THEN "start" END) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r
  FROM every WINDOW w AS (PARTITION BY rid ORDER BY "start", kind)),
named AS (
  SELECT rid, kind, "start", {list(pii.KINDS)}[kind + 1] || ':' || "start" || ':' || "end" AS item FROM edged
  WHERE kind < 4 OR (coalesce(l, 0) <= "start" AND coalesce(r, "end") >= "end")),
listed AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip, count(*) FILTER (kind = 2) AS n_card,
    count(*) FILTER (kind = 3) AS n_phone, string_agg(item, ',' ORDER BY "start", kind) FILTER (kind < 4) AS base,
    string_agg(item, ',' ORDER BY "start", kind) AS spans FROM named GROUP BY rid)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (rid)"""


def op7_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    return perspectives.rotate(table(spark, folder, "conversations"))


OP7_SQL = r"""
WITH words AS (
  SELECT conv_id, turn::BIGINT AS turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS body FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM words WHERE speaker <> 'system'),
parts AS (
  SELECT w.*, p.perspective, w.speaker = p.perspective AS own,
    CASE WHEN w.speaker = p.perspective THEN '<|im_start|>assistant' || chr(10)
      WHEN w.speaker = 'system' THEN '<|im_start|>system' || chr(10)
      ELSE '<|im_start|>user name=' || replace(replace(w.speaker, chr(10), ' '), '<|im_', '<| im_') || chr(10) END AS head,
    replace(w.body, '<|im_', '<| im_') || '<|im_end|>' AS said
  FROM words w JOIN people p ON w.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, sum(length(head) + length(said) + 1) OVER (PARTITION BY conv_id, perspective
    ORDER BY turn NULLS FIRST, speaker, body ROWS UNBOUNDED PRECEDING)::BIGINT AS "end" FROM parts)
SELECT conv_id, perspective, turn, speaker, head || said || chr(10) AS segment,
  "end" - length(head) - length(said) - 1 AS "start", "end",
  CASE WHEN own THEN "end" - length(said) - 1 ELSE "end" END AS loss_start,
  CASE WHEN own THEN "end" - 1 ELSE "end" END AS loss_end
FROM placed"""


def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, folder, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), simhash.hex_of().alias("fingerprint"), F.col("component").alias("component_id")
    )


def op9_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard(table(spark, folder, "documents"), SHARDS)
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, folder, "documents"))
    return packed.withColumnRenamed("id", "doc_id")


def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    found = languageid.identify(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "held_out", "lang_pred", "score")


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.trie(table(spark, folder, "conversations"))


OP12_SQL = rf"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, count(*) AS n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, (r & 1) * 3988292384)))) % {prefixtrie.HEADS} AS h
  FROM t GROUP BY c),
sized AS (
  SELECT v.c, v.c - v.c % {prefixtrie.EVERY} AS b, h, least(h, coalesce((SELECT n FROM convs w WHERE w.c = v.c - v.c % {prefixtrie.EVERY}), 0)) AS taken
  FROM convs v),
rebuilt AS (
  SELECT s.c, pos AS d, role, text FROM sized s JOIN t ON t.c = s.b AND pos <= h
  UNION ALL SELECT s.c, pos - h + taken AS d, role, text FROM sized s JOIN t ON t.c = s.c AND pos > h),
members AS (
  SELECT c, d, strlen(text) AS n_bytes, list(struct_pack(role, text)) OVER (PARTITION BY c ORDER BY d) AS k FROM rebuilt
  UNION ALL SELECT c, 0 AS d, 0 AS n_bytes, [] AS k FROM sized),
nodes AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, min(n_bytes) AS n_bytes FROM members GROUP BY d, k),
held AS (SELECT m.c, m.d, n.conv_id, n.n_convs, n.n_bytes FROM members m JOIN nodes n USING (d, k)),
up AS (
  SELECT n.conv_id, n.d AS depth, n.n_convs, n.n_bytes, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN held p ON p.c = n.conv_id AND p.d = n.d - 1),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM up WHERE depth > 0 GROUP BY 1, 2),
tree AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN children USING (conv_id, depth)),
below AS (
  SELECT a.conv_id, a.d AS depth, count(*) FILTER (x.n_children = 0) AS n_leaves, sum((x.n_convs - 1) * x.n_bytes)::BIGINT AS saved_tokens
  FROM tree x JOIN held a ON a.c = x.conv_id AND a.d <= x.depth GROUP BY 1, 2),
lengths AS (SELECT c, max(d) AS d FROM members GROUP BY c),
ends AS (
  SELECT a.conv_id, a.d AS depth, sha256(string_agg(l.c::VARCHAR, ',' ORDER BY l.c)) AS ends
  FROM lengths l JOIN held a USING (c, d) GROUP BY 1, 2)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM tree JOIN below USING (conv_id, depth) LEFT JOIN ends USING (conv_id, depth)"""


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


OP13_SQL = rf"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?
-
]')) AS piece FROM docs),
words AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM words),
phrases AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM starts, (SELECT unnest(generate_series(1, {collocations.LONGEST})) AS k) WHERE i + k - 1 <= len(w) GROUP BY 1, 2, 3),
candidates AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE k > 1 AND f >= {collocations.LEAST}),
inside AS (
  SELECT lang, a, w, i, unnest(generate_series(i + 1, len(w))) AS j
  FROM (SELECT *, unnest(generate_series(1, len(w) - 1)) AS i FROM candidates)),
longer AS (
  SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(a) AS most FROM inside WHERE j - i + 1 < len(w) GROUP BY 1, 2),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN longer USING (lang, phrase)
  WHERE most IS NULL OR 100 * most < {collocations.PERCENT} * a),
cuts AS (SELECT *, unnest(generate_series(1, len(w) - 1)) AS j FROM kept),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE k = 1 GROUP BY 1),
scored AS (
  SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r, n, j, (1000::HUGEINT * a * n // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN totals USING (lang) JOIN phrases x ON x.lang = c.lang AND x.phrase = array_to_string(w[:j], ' ')
    JOIN phrases y ON y.lang = c.lang AND y.phrase = array_to_string(w[j + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {collocations.TOP}"""


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_counts": op2_token_counts,
    "op3_nbest_pieces": op3_nbest_pieces,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_pii_sanitisation": op6_pii_sanitisation,
    "op7_chat_perspectives": op7_chat_perspectives,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_shards": op9_shards,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_language_id": op11_language_id,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_collocations": op13_collocations,
}

SQL: dict[str, str] = {
    "op5_exact_top_k": OP5_SQL,
    "op6_pii_sanitisation": OP6_SQL,
    "op7_chat_perspectives": OP7_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
