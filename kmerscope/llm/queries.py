"""The registered queries of the training-data operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (anchor_dedup, chat, decontaminate, fill_middle, jaccard_groups, maxent_lm, merkle_manifest, mixing, packing, quality_zstd,
               rules_cascade, suffix_dedup, toxicity)
from .common import fold, quoted, table, words


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, fold(quoted("doc_id"), 5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (fold(quoted("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(quoted("doc_id"), 7) == 2
    return maxent_lm.score(docs, ~held_out, levels=maxent_lm.LEVELS).withColumn("held_out", held_out)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = chat.exchanges_as_calls(table(spark, sf_dir, "conversations"))
    schemas = {"reply": {"prompt": chat.Param("string"), "words": chat.Param("integer")}}
    return chat.format_chats(messages, schemas).withColumn("linked_turn", F.coalesce("linked_turn", F.lit(-1)))


def op5_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups.jaccard_join(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op7_quality_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_zstd.fit(docs, labels, fold(quoted("doc_id"), 4) != 2)
    return quality_zstd.score(docs, model).select(
        "doc_id", (fold(quoted("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    slim = docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"))
    m = mixing.systematic_mix(slim, F.col("size"))
    return m.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchor_dedup.digests(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_cascade.judge(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    other = merkle_manifest.leaf([more if c == "n_chars" else F.col(c) for c in fields])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, other)
    m = merkle_manifest.build(table(spark, sf_dir, "documents"), fields, keep={"tampered": tampered})
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    folded = merkle_manifest.fold(F.coalesce("kept.tampered", "leaf"), F.col("path"))
    return merkle_manifest.proofs(m).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle_manifest.digest(siblings).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    placed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return placed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    fim = fill_middle.transformed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = fill_middle.restored(F.col("fim.output"), F.col("fim.form"))
    return fim.select(
        "doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
        F.sha2(F.col("fim.output").cast("binary"), 256).alias("output_sha256"), F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_maxent_lm": op2_maxent_lm,
    "op3_decontaminate": op3_decontaminate,
    "op4_chat_tools": op4_chat_tools,
    "op5_jaccard_groups": op5_jaccard_groups,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality_zstd": op7_quality_zstd,
    "op8_source_mix": op8_source_mix,
    "op9_anchor_dedup": op9_anchor_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_fill_middle": op13_fill_middle,
}

# [^\x20\x09-\x0D]+ as RE2 writes it.
_WORD = r"[^\x20\x09-\x0D]+"

_OP8 = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS ord
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, source_size * 3 AS most,
         coalesce(sum(source_size * 3) OVER w, 0)::BIGINT AS full_before,
         coalesce(sum(weight) OVER w, 0)::BIGINT AS weight_before
  FROM s WINDOW w AS (ORDER BY source_size * 3 / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT max(((SELECT sum(source_size) FROM s)::BIGINT - full_before) / ((SELECT sum(weight) FROM s)::BIGINT - weight_before)) AS level FROM f),
t AS (
  SELECT source, source_size, least(most::DOUBLE, level * weight) AS target,
         ('0x' || substr(md5('mix' || CASE WHEN source IS NULL THEN '-' ELSE '+' || source END), 1, 5))::BIGINT AS start
  FROM f, l),
r AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 1.0::DOUBLE END AS expected, t.start / 1048576.0::DOUBLE AS u,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.ord, d.doc_id) AS rnk
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * least(floor(rnk * expected + u) - floor((rnk - 1) * expected + u), 3))::BIGINT AS taken
FROM r"""

_OP10 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
         row_number() OVER () AS rid
  FROM documents),
w AS (
  SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
win AS (
  SELECT rid, pos, word, lead(word, 1) OVER p AS w1, lead(word, 2) OVER p AS w2, lead(word, 3) OVER p AS w3, lead(word, 4) OVER p AS w4
  FROM w WINDOW p AS (PARTITION BY rid ORDER BY pos)),
starts AS (
  SELECT rid, pos FROM win WHERE w4 IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY rid, word, w1, w2, w3, w4) > 1),
rep AS (
  SELECT rid, count(DISTINCT pos + k) AS n FROM starts, range(5) AS o(k) GROUP BY rid),
b AS (
  SELECT d.doc_id, d.text, d.words, len(d.words)::BIGINT AS n_words,
         length(array_to_string(d.words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(d.text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         list_filter(string_split(d.text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (rid)),
c AS (
  SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         len(regexp_extract_all(text, '\p{{Lu}}')) AS upper_letters, len(regexp_extract_all(text, '\p{{L}}')) AS letters
  FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * n_symbols > n_words
            OR 2 * n_dup_lines > len(string_split(text, chr(10)))
            OR 5 * len(regexp_extract_all(text, '!')) > n_words
            OR 2 * upper_letters > letters
            OR 2 * letters < word_chars
            OR 4 * len(list_filter(words, lambda x, i: i > 1 AND words[i - 1] = x)) > n_words
            OR 4 * len(list_distinct(words)) < least(n_words, 100)) AS kept
FROM c"""

_OP3 = r"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS rid, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS toks
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS toks
  FROM benchmark),
tp AS (SELECT doc_id, rid, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos FROM t),
bp AS (SELECT item_id, len(toks) AS n, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos FROM b),
-- Every way to lay an item over a document that agrees in enough tokens, found without seeds.
hit AS (
  SELECT rid, item_id, tp.pos - bp.pos AS shift FROM tp JOIN bp ON tp.tok = bp.tok
  GROUP BY ALL HAVING count(*) >= ceil(least(13, any_value(n)) * 0.8 - 1e-9)),
al AS (
  SELECT hit.rid, hit.item_id, hit.shift, bp.n, bp.pos, coalesce((tp.tok = bp.tok)::INT, 0) AS same
  FROM hit JOIN bp USING (item_id) LEFT JOIN tp ON tp.rid = hit.rid AND tp.pos = bp.pos + hit.shift),
win AS (
  SELECT *, sum(same) OVER (PARTITION BY rid, item_id, shift ORDER BY pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS near FROM al),
line AS (SELECT rid, item_id, shift, any_value(n) AS n, max(near) AS best, sum(same) AS total FROM win GROUP BY ALL)
SELECT doc_id, item_id, max(best)::BIGINT AS n_best, max(total)::BIGINT AS n_agree
FROM line JOIN t USING (rid) WHERE best >= ceil(least(13, n) * 0.8 - 1e-9)
GROUP BY doc_id, item_id"""

_OP4 = rf"""
WITH c AS (
  SELECT conv_id, turn, role, text, conv_id || ':' || turn AS own, conv_id || ':' || (turn - 1) AS before FROM conversations),
calls AS (SELECT conv_id, own AS id, min(turn) AS turn FROM c WHERE role = 'user' GROUP BY ALL),
results AS (SELECT conv_id, before AS id, min(turn) AS turn FROM c WHERE role = 'assistant' GROUP BY ALL)
SELECT c.conv_id, c.turn, 0 AS sub, c.turn AS place, 0 AS "order", 0 AS lift,
       CASE c.role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
       CASE c.role WHEN 'user' THEN own WHEN 'assistant' THEN before END AS call_id,
       coalesce(CASE c.role WHEN 'user' THEN r.turn WHEN 'assistant' THEN k.turn END, -1) AS linked_turn,
       CASE WHEN c.role = 'user' AND r.turn IS NULL THEN 'unanswered'
            WHEN c.role = 'user' THEN 'valid'
            WHEN c.role = 'assistant' AND k.turn IS NULL THEN 'orphan' ELSE 'ok' END AS status,
       CASE c.role
         WHEN 'user' THEN '{{"arguments":{{"prompt":' || to_json(text) || ',"words":' || len(regexp_extract_all(text, '{_WORD}'))
                          || '}},"id":"' || own || '","kind":"call","name":"reply","role":"assistant"}}'
         WHEN 'assistant' THEN '{{"content":' || to_json(text) || ',"id":"' || before || '","kind":"result","role":"tool"}}'
         ELSE '{{"content":' || to_json(text) || ',"kind":"message","role":"' || c.role || '"}}' END AS json
FROM c LEFT JOIN results r ON c.role = 'user' AND r.conv_id = c.conv_id AND r.id = c.own
       LEFT JOIN calls k ON c.role = 'assistant' AND k.conv_id = c.conv_id AND k.id = c.before"""

_OP5 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents),
s AS (
  SELECT doc_id, rid, CASE WHEN len(w) >= 3 THEN list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)])
                           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END AS sh FROM d),
e AS (SELECT rid, len(sh) AS n, unnest(sh) AS x FROM s),
half AS (
  SELECT a.rid AS a, b.rid AS b FROM e a JOIN e b ON a.x = b.x AND a.rid < b.rid
  GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (SELECT rid AS a, rid AS b FROM s UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT reach.a AS rid, min(doc_id) AS component_id FROM reach JOIN s ON s.rid = reach.b GROUP BY reach.a)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, component_id, (SELECT count(*) FROM links WHERE links.a = s.rid)::BIGINT AS n_links
FROM s JOIN low USING (rid)"""

_OP6 = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, rid, i, substr(h, 2 * i + 1, 200) AS s
        FROM (SELECT *, unnest(range(0, greatest(len(h) // 2 - 99, 0))) AS i FROM d)),
later AS (SELECT rid, i FROM win QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, rid, i) > 1),
step AS (SELECT rid, i, coalesce((i > lag(i) OVER w + 100)::INT, 1) AS fresh FROM later WINDOW w AS (PARTITION BY rid ORDER BY i)),
run AS (SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS k FROM step),
span AS (SELECT rid, k, min(i) AS a, max(i) + 100 AS b FROM run GROUP BY rid, k),
cut AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM span),
part AS (
  SELECT cut.rid, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS tail,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM cut JOIN d USING (rid) GROUP BY cut.rid)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN part USING (rid)"""

_OP9 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (SELECT rid, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT *, unnest(range(1, greatest(len(w) - 33, 1))) AS i FROM d)),
twice AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY s) > 1),
gone AS (SELECT DISTINCT rid, i + k AS pos FROM twice, range(35) AS o(k)),
word AS (SELECT rid, unnest(w) AS x, generate_subscripts(w, 1) AS pos FROM d),
kept AS (SELECT rid, string_agg(x, ' ' ORDER BY pos) AS t FROM word ANTI JOIN gone USING (rid, pos) GROUP BY rid),
n AS (SELECT rid, count(*) AS n_removed FROM gone GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN n USING (rid) LEFT JOIN kept USING (rid)"""



def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({value}::VARCHAR)) || ':' || {value} END"


_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""

_OP11 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('+' || lang, '') AS g,
         {' || '.join(_field(c) for c in ('doc_id', 'source', 'lang'))} AS head, {_field('n_chars')} AS n, {_field('(n_chars::HUGEINT + 1)')} AS more,
         {_field('text')} AS body, coalesce({_CRC32} % 7 = 0, false) AS tamper
  FROM documents),
e AS (SELECT rid, doc_id, g, sha256(head || n || body) AS leaf, sha256(head || CASE WHEN tamper THEN more ELSE n END || body) AS shown FROM d),
place AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM e),
node AS (
  SELECT g, 0 AS h, i, leaf AS x, count(*) OVER (PARTITION BY g) AS n FROM place
  UNION ALL
  SELECT g, h + 1, i // 2, sha256(string_agg(x, '' ORDER BY i)), (n + 1) // 2 FROM node WHERE n > 1 GROUP BY g, h, i // 2, n),
sub AS (SELECT g, h AS height, x AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS j FROM node WHERE n = 1),
top AS (
  SELECT 0 AS h, j, subroot AS x, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT h + 1, j // 2, sha256(string_agg(x, '' ORDER BY j)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY h, j // 2, n),
step AS (
  SELECT rid, node.h AS k, (i >> node.h) & 1 AS digit, other.x AS sibling
  FROM place JOIN sub USING (g) JOIN (SELECT DISTINCT g, h FROM node WHERE n > 1) node USING (g)
    LEFT JOIN (SELECT g, h, i AS at, x FROM node) other ON other.g = place.g AND other.h = node.h AND other.at = xor(i >> node.h, 1)
  UNION ALL
  SELECT rid, height + up.h, (j >> up.h) & 1, other.x
  FROM place JOIN sub USING (g), (SELECT DISTINCT h FROM top WHERE n > 1) up
    LEFT JOIN (SELECT h, j AS at, x FROM top) other ON other.h = up.h AND other.at = xor(sub.j >> up.h, 1)),
fold AS (
  SELECT rid, 0 AS k, shown AS x FROM place
  UNION ALL
  SELECT rid, k + 1, sha256(CASE WHEN digit = 1 THEN sibling || x ELSE x || coalesce(sibling, '') END) FROM fold JOIN step USING (rid, k)),
proof AS (SELECT rid, string_agg(sibling, '' ORDER BY k) AS p, count(*) AS steps FROM step GROUP BY rid)
SELECT doc_id, leaf, subroot, top.x AS root, sha256(coalesce(p, '')) AS proof_sha256, fold.x AS folded_root, fold.x = top.x AS verified
FROM place JOIN sub USING (g) JOIN top ON top.n = 1 LEFT JOIN proof USING (rid) JOIN fold ON fold.rid = place.rid AND fold.k = coalesce(steps, 0)"""

_OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x
  FROM documents),
h AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3,
         ('0x' || x[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM h),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""

ORACLES = {
    "op3_decontaminate": _OP3,
    "op4_chat_tools": _OP4,
    "op5_jaccard_groups": _OP5,
    "op6_suffix_dedup": _OP6,
    "op8_source_mix": _OP8,
    "op9_anchor_dedup": _OP9,
    "op10_quality_rules": _OP10,
    "op11_merkle_manifest": _OP11,
    "op13_fill_middle": _OP13,
}
