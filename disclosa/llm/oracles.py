"""SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from disclosa.llm import chat, covertree, mixing, quality_rules, secrets

SPACE = r"[\x20\x09-\x0D]+"
WORDS = rf"list_filter(string_split_regex(coalesce(text, ''), '{SPACE}'), lambda x: x <> '')"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _secrets() -> str:
    parts = []
    for rank, r in enumerate(secrets.RULES):
        p = _quoted(r.pattern)
        parts.append(
            f"SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, unnest(range(1, len(found) + 1)) AS i, gaps, found, held, {r.at_least} AS least FROM (SELECT doc_id, "
            f"string_split_regex(text, {p}) AS gaps, regexp_extract_all(text, {p}, 0) AS found, regexp_extract_all(text, {p}, {r.group}) AS held FROM d WHERE regexp_matches(text, {p}))"
        )
    n_base = len(secrets.BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (rank = {k}) AS n_{r.kind}" for k, r in enumerate(secrets.BASE_RULES))
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), m AS ({' UNION ALL '.join(parts)}),
 s AS (SELECT doc_id, rank, kind, length(array_to_string(list_slice(gaps, 1, i), '')) + length(array_to_string(list_slice(found, 1, i - 1), '')) AS a, length(found[i]) AS n, length(held[i]) >= least AS ok FROM m),
 k AS (SELECT doc_id, rank, kind, a, a + n AS b FROM s WHERE ok),
 g AS (SELECT doc_id, {counts}, string_agg(kind || ':' || a::VARCHAR || ':' || b::VARCHAR, ',' ORDER BY a, rank, b) FILTER (rank < {n_base}) AS base, string_agg(kind || ':' || a::VARCHAR || ':' || b::VARCHAR, ',' ORDER BY a, rank, b) AS every FROM k GROUP BY 1)
 SELECT d.doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in secrets.BASE_RULES)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans FROM d LEFT JOIN g ON g.doc_id = d.doc_id"""


def _mixing() -> str:
    w = mixing.WEIGHTS
    return f"""WITH d AS (SELECT doc_id, source, len({WORDS}) AS size, substr(md5('{mixing.KEY}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 15) AS h FROM documents),
 s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
 c AS (SELECT *, [{', '.join(map(str, w))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(w)} + 1] AS w, {mixing.MOST} * source_size AS cap FROM s),
 l AS (SELECT *, ({mixing.SHARE}::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM c),
 t AS (SELECT source, source_size, CASE WHEN cap < w * lev THEN cap::DOUBLE ELSE w * max(CASE WHEN cap >= w * lev THEN lev END) OVER () END AS target FROM l),
 q AS (SELECT *, round(target)::BIGINT AS quota FROM t), z AS (SELECT sum(quota)::BIGINT AS total, greatest(1, least({mixing.BLOCK_WORDS}, sum(quota)::BIGINT // {mixing.SLOTS})) AS block FROM q),
 p AS (SELECT d.doc_id, d.size, d.source, q.source_size, q.target, q.quota, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d JOIN q ON q.source IS NOT DISTINCT FROM d.source),
 e AS (SELECT source, quota, floor((sum(target) OVER upto - target) / sum(target) OVER () * {mixing.UNIT})::BIGINT AS a, floor(sum(target) OVER upto / sum(target) OVER () * {mixing.UNIT})::BIGINT AS b FROM q WHERE target > 0 WINDOW upto AS (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
 f AS (SELECT source, quota, coalesce(lag(b) OVER (ORDER BY source NULLS LAST), 0) AS a, b FROM e),
 g AS (SELECT i AS slot, ((i % {1 << 31}) * {mixing.GOLDEN}) % {mixing.UNIT} AS u FROM z, range((total + block - 1) // block) AS r(i)),
 k AS (SELECT f.source, slot, row_number() OVER (PARTITION BY f.source ORDER BY slot) - 1 AS rank FROM g JOIN f ON u >= a AND u < b),
 n AS (SELECT q.source, coalesce(max(rank) + 1, 0) AS given, (max(quota) + max(block) - 1) // max(block) AS need FROM q CROSS JOIN z LEFT JOIN k ON k.source IS NOT DISTINCT FROM q.source GROUP BY 1),
 m AS (SELECT *, coalesce(sum(need - given) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM n WHERE given < need),
 o AS (SELECT source, rank, slot FROM k UNION ALL SELECT source, r, (total + block - 1) // block + earlier - given + r FROM (SELECT m.*, unnest(range(given, need)) AS r FROM m), z),
 x AS (SELECT p.*, before // block AS rank FROM p, z)
 SELECT doc_id, size, source_size, round(target, 6) AS target, (greatest(0, least(before + size, quota) - before) + greatest(0, least(before + source_size + size, quota) - before - source_size))::BIGINT AS taken,
 CASE WHEN size > 0 AND before < quota THEN o.slot END::BIGINT AS first_slot FROM x LEFT JOIN o ON o.source IS NOT DISTINCT FROM x.source AND o.rank = x.rank"""


def _chat() -> str:
    controls = r"<\|turn\|>|<\|text\|>|<\|done\|>|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|</?s>|<</?SYS>>|\[/?INST\]"
    size = lambda c: f"(length({c}) + length({c}) - length(replace({c}, chr(92), '')) + len(regexp_extract_all({c}, '{controls}')))"
    frame = len(chat.OPEN) + len(chat.BODY) + len(chat.CLOSE)
    return f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) AS v(conv_id, turn, role, text)),
 g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns, coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss, sum({frame} + {size('role')} + {size('text')})::BIGINT AS formatted_chars FROM c GROUP BY 1)
 SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g"""


def _quality() -> str:
    n = quality_rules.WINDOW
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
 i AS (SELECT doc_id, w, unnest(range(1, len(w) - {n} + 2)) AS i FROM d WHERE len(w) >= {n}),
 k AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + {n - 1}), ' ') AS k FROM i),
 r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM k),
 v AS (SELECT doc_id, least({n}, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, {n})) AS n FROM r WHERE c > 1),
 s AS (SELECT doc_id, sum(n)::BIGINT AS n FROM v GROUP BY 1),
 m AS (SELECT d.doc_id, text, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(s.n, 0) AS n_repeat_words FROM d LEFT JOIN s ON s.doc_id = d.doc_id),
 b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR n_symbols * 10 > n_words OR word_chars < 2 * n_words OR word_chars > 14 * n_words OR n_dup_lines * 3 > len(string_split(text, chr(10))) OR length(regexp_replace(text, '[^A-Z]+', '', 'g')) * 2 > word_chars OR length(regexp_replace(text, '[^!]+', '', 'g')) * 4 > n_words) AS kept FROM b"""


def _embeddings() -> str:
    norm = "sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)))"
    return f"""WITH RECURSIVE n AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e, {norm} AS r FROM embeddings),
 g AS (SELECT vec_id, e, r FROM n WHERE isfinite(r) AND r > 0),
 l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / (a.r * b.r) >= {covertree.LEAST}::DOUBLE),
 t AS (SELECT a, b FROM l UNION SELECT t.a, l.b FROM t JOIN l ON l.a = t.b),
 c AS (SELECT a, min(b) AS least FROM t GROUP BY 1), k AS (SELECT a, count(*) AS n FROM l GROUP BY 1)
 SELECT n.vec_id, coalesce(k.n, 0) AS n_links, least(n.vec_id, coalesce(c.least, n.vec_id)) AS component_id, coalesce(c.least, n.vec_id) >= n.vec_id AS kept FROM n LEFT JOIN c ON c.a = n.vec_id LEFT JOIN k ON k.a = n.vec_id"""


ORACLES: dict[str, str] = {
    "op1_secret_scans": _secrets(),
    "op4_source_mixing": _mixing(),
    "op5_chat_formatting": _chat(),
    "op6_quality_rules": _quality(),
    "op9_embedding_near_dedup": _embeddings(),
}
