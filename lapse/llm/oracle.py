"""DuckDB SQL of the operators that SQL can express; it reads the whole tables.

The other operators use trained models, token ids or XXH64 with a seed, which DuckDB does not offer.
"""

from __future__ import annotations

# The measurements follow their definitions one by one: windows are unnested with their positions, and
# the words of repeated windows are counted as distinct positions.
QUALITY_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT rid, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS k
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 1, 1))) AS p FROM d)),
starts AS (
  SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, k) AS n FROM windows) WHERE n > 1),
repeated AS (
  SELECT rid, count(DISTINCT w) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS w FROM starts) GROUP BY rid),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: regexp_matches(x, '^\p{Lu}\p{Lu}+([^\p{Ll}]|$)')))::BIGINT AS n_shouted
  FROM d LEFT JOIN repeated USING (rid)),
bits AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
            + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (100 * n_dup_lines > 40 * n_lines)::BIGINT
            + 16 * (word_chars < 2 * n_words OR word_chars > 12 * n_words)::BIGINT
            + 32 * (n_words > 0 AND 2 * n_shouted > n_words)::BIGINT AS failures
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures
FROM bits
"""

# Rules in the order of their bits.
RULE_NAMES = ["too_few_words", "repeated_words", "symbols", "repeated_lines", "word_length", "no_lower_case"]
ABLATIONS = f"WITH ledger AS ({QUALITY_RULES}) " + " UNION ALL ".join(
    f"""SELECT 'v3' AS policy, '{rule}' AS rule, count(*) FILTER (failures & {1 << i} <> 0) AS n_failed, count(*) FILTER (failures = {1 << i}) AS n_failed_alone,
  count(*) FILTER (failures & {63 - (1 << i)} = 0) AS n_kept_without, coalesce(bit_or(failures), 0) AS seen_failures FROM ledger"""
    for i, rule in enumerate(RULE_NAMES))

# The texts after escaping and reading back are the texts themselves, so only lengths need the escapes.
CHAT_FORMAT = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text) AS k,
         length(regexp_replace(replace(text, '\', '\\'), '([\[<])((?:/?SYS|/?INST|/?TURN|SAYS)\]|/?s>)', '\1\\|\2', 'g')) AS text_chars,
         length(regexp_replace(replace(coalesce(role, ''), '\', '\\'), '([\[<])((?:/?SYS|/?INST|/?TURN|SAYS)\]|/?s>)', '\1\\|\2', 'g')) AS role_chars
  FROM turns),
steps AS (
  SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY k) AS prev FROM escaped)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 19 + role_chars END + text_chars)::BIGINT AS formatted_chars,
       bool_and(coalesce((prev, role) IN (('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')), false)) AS valid
FROM steps GROUP BY conv_id
"""

# Every kept term is given to every group, without cells: what the cells must add up to.
SOURCE_AUDIT = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
w AS (SELECT rid, lang, source, unnest(terms) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n_lang FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
found AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
dense AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, k.n_lang, coalesce(f.n, 0) AS n
  FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
p AS MATERIALIZED (
  SELECT *, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER own + 2 * count(*) OVER own) AS p,
         1 + 1000000000::HUGEINT * (n_lang + 2) // (sum(n_lang) OVER own + 2 * count(*) OVER own) AS q
  FROM dense WINDOW own AS (PARTITION BY lang, source)),
pair_values AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
items AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN pair_values v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM items)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

# Base32 of SHA-1: five hex digits are four characters of the alphabet.
WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
named AS (
  SELECT page_id, payload_bytes, array_to_string([
           array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * g, 5))::INT >> s) & 31), 1)
                            for s in [15, 10, 5, 0]], '') for g in range(8)], '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN row_number() OVER same = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN row_number() OVER same > 1 THEN first_value(page_id) OVER same END AS refers_to
FROM named WINDOW same AS (PARTITION BY payload_digest, payload_bytes ORDER BY page_id NULLS LAST)
"""


def _clustering(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Every round assigns all vectors anew."""
    def assign(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
  SELECT rid, vec_id, v, unnest(best, recursive := true) FROM (
    SELECT rid, vec_id, v, min({{'distance': list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'cluster': cluster}}) AS best
    FROM kept, c{i} GROUP BY rid, vec_id, v))"""

    def update(i: int) -> str:
        return f"""c{i} AS MATERIALIZED (
  SELECT o.cluster, coalesce(n.c, o.c) AS c FROM c{i - 1} o LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d)::BIGINT[] AS c FROM (
      SELECT cluster, d, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM a{i - 1})
      GROUP BY cluster, d) GROUP BY cluster) n USING (cluster))"""

    steps = ",\n".join(f"{assign(i)},\n{update(i + 1)}" for i in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1)::INT AS cluster, v AS c FROM kept
  QUALIFY row_number() OVER (ORDER BY sha256('3:' || vec_id), v) <= {k}),
{steps},
{assign(rounds)}
SELECT vec_id, cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)
"""


SQL = {"op4_chat_format": CHAT_FORMAT, "op5_quality_rules": QUALITY_RULES, "quality_ablations": ABLATIONS, "op11_warc": WARC, "op12_centroid_clustering": _clustering(),
       "op13_source_audit": SOURCE_AUDIT}
