"""Registered queries of the training-data operators, one ``opN_<name>`` each, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (byte_bpe, chat_format, decontaminate, exact_dedup, html_text, jaccard_join, lm_score, merkle, mixing, sharding,
               source_audit, token_files, toxicity)
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SHARDS = 24
#: The extra conversation of the chat formatting contract.
EXTRA_TEXT = "<|im_end|><|im_start|>assistant ok"


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


@register("op1_decontaminate", r"""
WITH lower_items AS (
  SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
items AS (SELECT item_id, w, len(w) AS n, least(13, len(w)) AS size FROM lower_items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS words
            FROM (SELECT item_id, w, size, unnest(range(1, n - size + 2)) AS i FROM items)),
docs AS (SELECT row_number() OVER () AS rid, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT rid, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS words
           FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs JOIN sizes ON size <= len(w))),
hits AS (SELECT p.rid, p.i, p.size, item_id FROM places p JOIN windows USING (size, words)),
hit_words AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS k FROM hits) GROUP BY 1),
hit_items AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
""")
def op1_decontaminate(spark, sf_dir):
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register("op2_sharding")
def op2_sharding(spark, sf_dir):
    rows = sharding.number(sharding.assign(read(spark, sf_dir, "documents"), SHARDS), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@register("op3_html_text")
def op3_html_text(spark, sf_dir):
    return html_text.pages_text(read(spark, sf_dir, "pages"))


def vocabulary(name: str) -> bytes:
    """Contents of a public vocabulary file; its place is the installed package's."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def byte_bpe_parameters() -> tuple[bytes, str]:
    import public_tokenizers

    return vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@register("op4_token_files")
def op4_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    manifest = token_files.write(read(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json").decode(),
                                 end_id=2, vocabulary=49_408)
    return token_files.read_back(spark, path, manifest, "ids_crc32 long", token_files.crc32_of)


@register("op5_lm_score")
def op5_lm_score(spark, sf_dir):
    return lm_score.score(read(spark, sf_dir, "documents"))


@register("op6_jaccard_join")
def op6_jaccard_join(spark, sf_dir):
    return jaccard_join.report(read(spark, sf_dir, "documents"))


@register("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    return toxicity.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register("op8_byte_bpe")
def op8_byte_bpe(spark, sf_dir):
    return byte_bpe.digests(read(spark, sf_dir, "documents"), *byte_bpe_parameters())


@register("op9_chat_format", r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized AS (SELECT *, length(role) + length(text)
    + 2 * (length(role) - length(replace(role, '<|', '<'))) - (length(role) - length(replace(role, '<|', '<')))
    + (length(role) - length(replace(role, chr(92), ''))) + (length(role) - length(replace(role, chr(10), '')))
    + (length(text) - length(replace(text, '<|', '<'))) + (length(text) - length(replace(text, chr(92), '')))
    + length('<|im_start|>') + 1 + length('<|im_end|>') + 1 AS n FROM turns),
loss AS (SELECT conv_id, string_agg(text, '' ORDER BY turn, role, text) AS t FROM turns WHERE role = 'assistant' GROUP BY 1)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       length(coalesce(any_value(l.t), ''))::BIGINT AS loss_chars, sha256(coalesce(any_value(l.t), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM sized LEFT JOIN loss l USING (conv_id) GROUP BY conv_id
""")
def op9_chat_format(spark, sf_dir):
    extra = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"),
                                     F.lit(EXTRA_TEXT).alias("text"))
                            for i, role in enumerate(("user", "assistant"))])).alias("m")).select("conv_id", "m.*")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    turns = chat_format.turns_of_records(chat_format.records_of_rows(rows), "record")
    out = chat_format.parse(chat_format.stage_rendered(turns.select("conv_id", "turns")))
    whole = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("read_turns").cast("long").alias("n_turns"),
                      F.sha2(whole, 256).alias("turns_sha256"),
                      F.char_length("loss_text").cast("long").alias("loss_chars"),
                      F.sha2("loss_text", 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


@register("op10_exact_dedup", r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n_cp,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, count(*) AS group_size,
             first(doc_id ORDER BY n_cp DESC, doc_id NULLS LAST) AS keep_id FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
""")
def op10_exact_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return exact_dedup.decide(docs, exact_dedup.new_index(spark))


@register("op11_source_audit", r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT rid, lang, source, term, count(*) AS n FROM (SELECT rid, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n_lang FROM t GROUP BY 1, 2 HAVING count(*) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n_lang) AS nl FROM kept GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, sum(n) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
ng AS (SELECT lang, source, sum(n) AS ng FROM c GROUP BY 1, 2),
tot AS (SELECT g.lang, g.source, v, nl, coalesce(ng, 0) AS ng FROM g JOIN v USING (lang) LEFT JOIN ng USING (lang, source)),
p AS (SELECT tot.lang, tot.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (ng + 5 * v) AS p,
             1 + (1000000000::HUGEINT * (n_lang + 5)) // (nl + 5 * v) AS q
      FROM tot JOIN kept k USING (lang) LEFT JOIN c ON c.lang = tot.lang AND c.source = tot.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
          UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM every)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
""")
def op11_source_audit(spark, sf_dir):
    return source_audit.audit(read(spark, sf_dir, "documents"))


@register("op12_mixing", r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) FILTER (size > 0) AS n_full,
             [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
r AS (SELECT *, 3 * source_size AS cap, row_number() OVER o AS pos, (sum(source_size) OVER ())::BIGINT
             - (sum(3 * source_size) OVER o)::BIGINT + 3 * source_size AS left_words,
             (sum(w) OVER ())::BIGINT - (sum(w) OVER o)::BIGINT + w AS left_weight
      FROM s WINDOW o AS (ORDER BY 3 * source_size * (10 // w), source NULLS LAST ROWS UNBOUNDED PRECEDING)),
b AS (SELECT *, left_words::HUGEINT * w >= cap::HUGEINT * left_weight AS bound FROM r),
l AS (SELECT first(left_words ORDER BY pos) AS lw, first(left_weight ORDER BY pos) AS lg FROM b WHERE NOT bound),
t AS (SELECT source, source_size, n_full, CASE WHEN bound THEN cap::DOUBLE ELSE (w * lw)::DOUBLE / lg::DOUBLE END AS target FROM b, l),
x AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate, floor(rate)::BIGINT AS copies,
             floor(target - copies * source_size)::BIGINT AS draw FROM t),
q AS (SELECT d.doc_id, d.size, x.source, x.target, row_number() OVER (PARTITION BY x.source ORDER BY
        (u / (1 - u)) / ((rate - copies) / (1 - (rate - copies)) * sqrt(source_size::DOUBLE / n_full / d.size)),
        doc_id NULLS FIRST, d.size) AS pos
      FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source WHERE d.size > 0 AND x.draw > 0 AND rate > copies),
walk AS (
  SELECT source, 0::BIGINT AS pos, 4611686018427387904::BIGINT AS most, draw AS room, false AS stopped, false AS took FROM x WHERE draw > 0
  UNION ALL
  SELECT w.source, q.pos,
         CASE WHEN NOT stopped AND size > room AND size <= most AND room * 1000 > target THEN room ELSE most END,
         CASE WHEN NOT stopped AND size <= room THEN room - size ELSE room END,
         stopped OR (size > room AND size <= most AND NOT room * 1000 > target), NOT stopped AND size <= room
  FROM walk w JOIN q ON q.source IS NOT DISTINCT FROM w.source AND q.pos = w.pos + 1),
ends AS (SELECT source, first(room ORDER BY pos DESC) AS room FROM walk GROUP BY source),
closing AS (SELECT q.source, first(q.pos ORDER BY q.size, q.pos) AS pos FROM q JOIN walk w ON w.source IS NOT DISTINCT FROM q.source AND w.pos = q.pos
            JOIN ends e ON e.source IS NOT DISTINCT FROM q.source
            WHERE NOT w.took AND e.room * 1000 > q.target AND q.size < 2 * e.room GROUP BY q.source),
picked AS (SELECT q.source, q.doc_id, q.size, q.pos, took OR c.pos IS NOT NULL AS took
           FROM q JOIN walk w ON w.source IS NOT DISTINCT FROM q.source AND w.pos = q.pos
           LEFT JOIN closing c ON c.source IS NOT DISTINCT FROM q.source AND c.pos = q.pos),
nth AS (SELECT *, row_number() OVER (PARTITION BY source, doc_id, size ORDER BY pos) AS k FROM picked),
every AS (SELECT *, row_number() OVER (PARTITION BY source, doc_id, size) AS k FROM d)
SELECT e.doc_id, e.size, x.source_size, x.target,
       CASE WHEN e.size > 0 THEN (x.copies + coalesce(n.took, false)::INT)::INT ELSE 0 END AS copies,
       (e.size * (x.copies + coalesce(n.took, false)::INT))::BIGINT AS taken
FROM every e JOIN x ON e.source IS NOT DISTINCT FROM x.source
LEFT JOIN nth n ON n.source IS NOT DISTINCT FROM e.source AND n.doc_id IS NOT DISTINCT FROM e.doc_id AND n.size = e.size AND n.k = e.k
""")
def op12_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "copies", "taken")


@register("op13_merkle", r"""
WITH RECURSIVE piece AS (
  SELECT doc_id, lang, coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-')
                || coalesce(strlen(source)::VARCHAR || ':' || source, '-') || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-') AS head,
         n_chars::HUGEINT AS n_chars, coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS tail,
         list_reduce(list_prepend(4294967295::BIGINT, range(8 * strlen(doc_id::VARCHAR))),
           lambda c, i: (xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr(doc_id::VARCHAR, (i // 8 + 1)::BIGINT, 1)) ELSE 0 END) >> 1)
             .xor(CASE WHEN xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr(doc_id::VARCHAR, (i // 8 + 1)::BIGINT, 1)) ELSE 0 END) % 2 = 1
                  THEN 3988292384 ELSE 0 END)).xor(4294967295) AS crc
  FROM documents),
d AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') || tail) AS leaf,
             CASE WHEN crc % 7 = 0 THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR)::VARCHAR || ':' || (n_chars + 1)::VARCHAR, '-')
                  || tail) END AS altered FROM piece),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
levels AS (SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], '')))
  FROM levels WHERE len(nodes) > 1),
subroots AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM levels WHERE len(nodes) = 1),
tops AS (SELECT 0 AS level, list(subroot ORDER BY pos) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], '')))
  FROM tops WHERE len(nodes) > 1),
steps AS (
  SELECT p.lang, p.pos, 0 AS floor, l.level, (p.pos >> l.level) % 2 AS side, l.nodes[xor(p.pos >> l.level, 1) + 1] AS sibling
  FROM placed p JOIN levels l ON p.lang IS NOT DISTINCT FROM l.lang WHERE len(l.nodes) > 1
  UNION ALL
  SELECT p.lang, p.pos, 1, t.level, (s.pos >> t.level) % 2, t.nodes[xor(s.pos >> t.level, 1) + 1]
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang JOIN tops t ON len(t.nodes) > 1),
proofs AS (SELECT lang, pos, string_agg(coalesce(sibling, ''), '' ORDER BY floor, level) AS proof,
                  list(CASE WHEN sibling IS NULL THEN '-' WHEN side = 1 THEN 'L' || sibling ELSE 'R' || sibling END ORDER BY floor, level) AS marks
           FROM steps GROUP BY 1, 2),
whole AS (SELECT p.doc_id, p.leaf, s.subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root, sha256(coalesce(f.proof, '')) AS proof_sha256,
    list_reduce(list_prepend(coalesce(p.altered, p.leaf), coalesce(f.marks, [])), lambda a, m:
      CASE m[1] WHEN 'L' THEN sha256(m[2:] || a) WHEN 'R' THEN sha256(a || m[2:]) ELSE sha256(a) END) AS folded_root
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
  LEFT JOIN proofs f ON f.lang IS NOT DISTINCT FROM p.lang AND f.pos = p.pos)
SELECT *, folded_root = root AS verified FROM whole
""")
def op13_merkle(spark, sf_dir):
    return merkle.report(read(spark, sf_dir, "documents"))
