"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from shipcast.llm import (digest, divergence, lattice, licenses, lines, merkle, mixing, packing, pii, quality, sharding,
                          simhash, substring)
from shipcast.llm.common import read


def op1_best_fit_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), capacity=2048)


def op2_source_mixing(spark, sf_dir):
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    first = F.try_element_at("_mix_positions", F.lit(1))
    return mixed.select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (F.col("_mix_size") * F.size("_mix_positions")).cast("long").alias("taken"),
        first.alias("first_position")).orderBy(F.col("first_position").asc_nulls_last(), "doc_id")


def op3_quality_attention(spark, sf_dir):
    scored = quality.classify(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality.held_out().alias("held_out"), F.col("_q_score").alias("score"),
                         (F.col("_q_score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op4_line_dedup(spark, sf_dir):
    cleaned = lines.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", F.col("_ln_total").alias("n_lines"), F.col("_ln_removed").alias("n_removed"),
                          F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP4_SQL = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
    FROM documents),
bare AS (SELECT *, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line FROM lines),
firsts AS (
    SELECT line, length(line) AS n, min({'doc_id': doc_id, 'line_no': line_no}) AS place
    FROM bare WHERE line <> '' GROUP BY line),
halves AS (
    SELECT line, n, place, n + more AS longer, unnest([
        'first' || left(line, CAST(floor((n + more - 1) / 2) AS INT)),
        'last' || right(line, CAST(floor((n + more - 1) / 2) AS INT))]) AS half
    FROM firsts, (VALUES (0), (1)) AS m(more) WHERE n >= 20),
late AS (
    SELECT DISTINCT a.line FROM halves a JOIN halves b
        ON a.longer = b.longer AND a.half = b.half AND b.place < a.place
    WHERE levenshtein(a.line, b.line) = 1),
judged AS (
    SELECT b.doc_id, b.line_no, b.raw, b.line = '' OR (
        f.place = {'doc_id': b.doc_id, 'line_no': b.line_no} AND b.line NOT IN (SELECT line FROM late)) AS stays
    FROM bare b LEFT JOIN firsts f ON b.line = f.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_removed,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (stays), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def op5_quartile_digest(spark, sf_dir):
    return digest.edited(read(spark, sf_dir, "documents"))


def op6_e8_lattice(spark, sf_dir):
    return lattice.near_duplicates(read(spark, sf_dir, "embeddings"))


def op7_substring_dedup(spark, sf_dir):
    cleaned = substring.dedup(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = """
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS word,
           generate_subscripts(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), 1) AS pos
    FROM documents WHERE text IS NOT NULL),
windows AS (
    SELECT *, CASE WHEN count(*) OVER ahead = 13 THEN string_agg(word, ' ') OVER ahead END AS run
    FROM words WINDOW ahead AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
firsts AS (SELECT run, min(doc_id) AS first_id FROM windows WHERE run IS NOT NULL GROUP BY run),
covered AS (
    SELECT w.doc_id, w.pos, w.word, coalesce(max(CASE WHEN f.first_id < w.doc_id THEN 1 ELSE 0 END) OVER (
        PARTITION BY w.doc_id ORDER BY w.pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), 0) = 1 AS gone
    FROM windows w LEFT JOIN firsts f ON w.run = f.run)
SELECT d.doc_id, count(c.pos) AS n_words, count(*) FILTER (c.gone) AS n_removed,
       sha256(coalesce(string_agg(c.word, ' ' ORDER BY c.pos) FILTER (NOT c.gone), '')) AS kept_sha256
FROM documents d LEFT JOIN covered c ON d.doc_id = c.doc_id GROUP BY d.doc_id
"""


def op8_simhash_near_dedup(spark, sf_dir):
    near = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, radius=4)
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_license_scan(spark, sf_dir):
    return licenses.scan(read(spark, sf_dir, "documents")).drop("block")


def op10_pii(spark, sf_dir):
    found = pii.find(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
              for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts,
                        F.sha2(F.array_join(F.transform(base, pii.label), ","), 256).alias("base_sha256"),
                        F.array_join(F.transform("spans", pii.label), ",").alias("spans"))


def op11_merkle_manifest(spark, sf_dir):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    made = merkle.documents_manifest(read(spark, sf_dir, "documents"), tampered)
    return made.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"),
                       "folded_root", "verified")


#: DuckDB has no crc32: eight shifts a byte of the decimal doc_id.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)), lambda crc, byte: list_reduce(
    list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))))"""
_FRAMED = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FRAMED.format(c) for c in ("doc_id", "source", "lang", "{0}", "text")) + ")"
OP11_SQL = f"""
WITH RECURSIVE rows AS (
    SELECT row_number() OVER () AS r, doc_id, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS g,
           {_LEAF.format('n_chars')} AS leaf, {_LEAF.format('(n_chars + 1)')} AS more,
           n_chars IS NOT NULL AND {_CRC32.format('doc_id::VARCHAR')} % 7 = 0 AS tampered
    FROM documents),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
           count(*) OVER (PARTITION BY g) AS n FROM rows),
tree AS (
    SELECT g, 0 AS level, idx, n, leaf AS node FROM leaves
    UNION ALL
    SELECT g, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY idx))
    FROM tree WHERE n > 1 GROUP BY g, level, idx // 2, n),
subroots AS (
    SELECT g, level AS height, node AS subroot, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n
    FROM tree WHERE n = 1),
top AS (
    SELECT 0 AS level, idx, n, subroot AS node FROM subroots
    UNION ALL
    SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY idx))
    FROM top WHERE n > 1 GROUP BY level, idx // 2, n),
steps AS (
    SELECT l.r, t.level, l.idx >> t.level AS at, s.node AS sibling
    FROM leaves l JOIN tree t ON t.g = l.g AND t.idx = l.idx >> t.level AND t.n > 1
    LEFT JOIN tree s ON s.g = t.g AND s.level = t.level AND s.idx = xor(t.idx, 1)
    UNION ALL
    SELECT l.r, b.height + t.level, b.idx >> t.level, s.node
    FROM leaves l JOIN subroots b ON b.g = l.g JOIN top t ON t.idx = b.idx >> t.level AND t.n > 1
    LEFT JOIN top s ON s.level = t.level AND s.idx = xor(t.idx, 1)),
proofs AS (
    SELECT r, string_agg(coalesce(sibling, ''), '' ORDER BY level) AS siblings, count(*) AS height FROM steps GROUP BY r),
fold AS (
    SELECT r, 0 AS level, CASE WHEN tampered THEN more ELSE leaf END AS node FROM leaves
    UNION ALL
    SELECT f.r, f.level + 1, sha256(CASE WHEN s.at & 1 = 1 THEN coalesce(s.sibling, '') || f.node
                                         ELSE f.node || coalesce(s.sibling, '') END)
    FROM fold f JOIN steps s ON s.r = f.r AND s.level = f.level)
SELECT l.doc_id, l.leaf, b.subroot, t.node AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
       f.node AS folded_root, f.node = t.node AS verified
FROM leaves l JOIN subroots b ON b.g = l.g JOIN top t ON t.n = 1 LEFT JOIN proofs p ON p.r = l.r
JOIN fold f ON f.r = l.r AND f.level = coalesce(p.height, 0)
"""


def op12_source_divergence(spark, sf_dir):
    return divergence.audit(read(spark, sf_dir, "documents"), least_docs=30, top=50)


_SHARE = "CAST(1 + (1000000000::HUGEINT * ({0} + 5)) // ({1} + 5 * {2}) AS BIGINT)"
OP12_SQL = rf"""
WITH docs AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
terms AS (
    SELECT lang, source, r, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM terms GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
used AS (SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT DISTINCT lang, source FROM docs),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n) AS total FROM used GROUP BY lang, source),
shares AS (
    SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
           {_SHARE.format('coalesce(u.n, 0)', 'coalesce(t.total, 0)', 'l.v')} AS p, {_SHARE.format('k.n', 'l.total', 'l.v')} AS q
    FROM groups g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
    LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
               FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
               GROUP BY ALL) f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
both_parts AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM both_parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def op13_sampled_sharding(spark, sf_dir):
    placed = sharding.shard(read(spark, sf_dir, "documents"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_source_mixing, op3_quality_attention, op4_line_dedup, op5_quartile_digest, op6_e8_lattice,
    op7_substring_dedup, op8_simhash_near_dedup, op9_license_scan, op10_pii, op11_merkle_manifest, op12_source_divergence,
    op13_sampled_sharding)}
ORACLE = {"op4_line_dedup": OP4_SQL, "op7_substring_dedup": OP7_SQL, "op11_merkle_manifest": OP11_SQL,
          "op12_source_divergence": OP12_SQL}
