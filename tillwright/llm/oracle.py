"""DuckDB SQL for the operators that SQL can express, written from their definitions."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op1_url_filters"] = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), split AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
           regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
    FROM cut
), parts AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
    FROM split
), rules(rule_host, rule_path, verdict) AS (VALUES
    ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fitting AS (
    SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(verdict, length(rule_host || rule_path)) AS verdict
    FROM (SELECT DISTINCT host, path FROM parts)
    JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY host, path
)
SELECT page_id, parts.host, parts.path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fitting ON parts.host = fitting.host AND parts.path = fitting.path
"""

ORACLE["op5_exact_dedup"] = r"""
WITH rows AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM rows WINDOW same AS (PARTITION BY text_sha256)
"""


def _mixing(targets={"source": 0.5, "lang": 0.7, "topic": 0.8}, rounds: int = 25, keep: float = 0.75) -> str:
    """The rounds of raking, written out one after the other."""
    parts = ["""rows AS MATERIALIZED (
    SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
           CASE WHEN contains(t, 'icense') OR contains(t, 'opyright') THEN 'legal'
                WHEN contains(t, '@') THEN 'contact' WHEN contains(t, '=') THEN 'technical'
                ELSE 'prose' END AS topic,
           len(regexp_extract_all(t, '\\S+')) AS tokens,
           ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, md5(t))), 1, 13))::BIGINT / 4503599627370496.0 AS draw
    FROM (SELECT *, coalesce(text, '') AS t FROM documents)
)""", """cells AS MATERIALIZED (
    SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens, sum(tokens)::DOUBLE AS weight
    FROM rows GROUP BY ALL HAVING sum(tokens) > 0
)"""]
    for dimension, power in targets.items():
        parts.append(f"""share_{dimension} AS MATERIALIZED (
    SELECT {dimension}, pow(sum(tokens), {power}) / sum(pow(sum(tokens), {power})) OVER () AS share
    FROM cells GROUP BY {dimension}
)""")
    last = "cells"
    for number in range(rounds):
        for dimension in targets:
            name = f"round_{number}_{dimension}"
            parts.append(f"""{name} AS MATERIALIZED (
    SELECT c.* EXCLUDE (weight, share), c.weight * share * (SELECT sum(tokens) FROM cells)
           / sum(c.weight) OVER (PARTITION BY {dimension}) AS weight
    FROM (SELECT * FROM {last} JOIN share_{dimension} USING ({dimension})) c
)""")
            last = name
    parts.append(f"""ordered AS MATERIALIZED (
    SELECT *, coalesce(sum(tokens) OVER earlier, 0) AS taken, coalesce(sum(weight) OVER earlier, 0) AS used
    FROM {last}
    WINDOW earlier AS (ORDER BY weight / tokens DESC, source, lang, topic
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), factor AS (
    SELECT arg_min(({keep} * total - taken) / (mass - used), taken) AS c FROM (
        SELECT *, sum(tokens) OVER () AS total, sum(weight) OVER () AS mass FROM ordered)
    WHERE {keep} * total > taken AND ({keep} * total - taken) / (mass - used) * weight <= tokens
), chances AS (
    SELECT source, lang, topic, least(1.0, weight * c / tokens) AS chance FROM ordered, factor
)""")
    return "WITH " + ", ".join(parts) + """
SELECT doc_id, source, lang, topic, tokens, round(coalesce(chance, 0), 6) AS chance,
       draw < coalesce(chance, 0) AS sampled
FROM rows LEFT JOIN chances USING (source, lang, topic)
"""


ORACLE["op10_mixing"] = _mixing()

ORACLE["op3_embedding_dedup"] = """
WITH RECURSIVE unit AS MATERIALIZED (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0
), links AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach(vec_id, other) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""

ORACLE["op9_jaccard_join"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '(?:[a-z0-9]|[^\x00-\x7F])+') AS w FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(list_transform(
        range(1, greatest(len(w) - 4, least(len(w), 1)) + 1), lambda i: array_to_string(w[i:i + 4], ' ')
    )) AS s FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS MATERIALIZED (
    SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE shared.n >= 0.8 * (p.n + q.n - shared.n)
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT doc_id, coalesce(n_links, 0) AS n_links, class_id, doc_id = class_id AS kept
FROM (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a) USING (doc_id)
"""

ORACLE["op8_suffix_dedup"] = """
WITH bytes AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS MATERIALIZED (
    SELECT doc_id, h, length(h) // 2 AS n FROM bytes
), windows AS MATERIALIZED (
    SELECT doc_id, unnest(range(0, greatest(n - 199, 0))) AS p,
           unnest(list_transform(range(0, greatest(n - 199, 0)), lambda i: md5(substr(h, 2 * i + 1, 400)))) AS m
    FROM sized
), again AS MATERIALIZED (
    SELECT m FROM windows GROUP BY m HAVING count(*) > 1
), steps AS (
    SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 200, true) AS fresh
    FROM windows SEMI JOIN again USING (m)
), numbered AS (
    SELECT doc_id, p, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM steps
), spans AS MATERIALIZED (
    SELECT doc_id, min(p) AS first, max(p) + 200 AS stop FROM numbered GROUP BY doc_id, span
), gaps AS (
    SELECT doc_id, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY first), 0) AS first, first AS stop FROM spans
    UNION ALL
    SELECT doc_id, coalesce(max(spans.stop), 0), n FROM sized LEFT JOIN spans USING (doc_id) GROUP BY doc_id, n
), kept AS (
    SELECT doc_id, string_agg(substr(h, 2 * first + 1, 2 * (stop - first)), '' ORDER BY first) AS h
    FROM gaps JOIN sized USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(runs, 0) AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM sized JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, sum(stop - first) AS gone, count(*) AS runs FROM spans GROUP BY doc_id) USING (doc_id)
"""

ORACLE["op11_fill_middle"] = r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS s,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
    FROM documents
), drawn AS (
    SELECT doc_id, t, u, len(u) AS n,
           least(('0x' || s[1:8])::BIGINT % (len(u) + 1), ('0x' || s[9:16])::BIGINT % (len(u) + 1)) AS low,
           greatest(('0x' || s[1:8])::BIGINT % (len(u) + 1), ('0x' || s[9:16])::BIGINT % (len(u) + 1)) AS high,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                     OR ('0x' || s[17:24])::BIGINT % 100 >= 50 THEN 'plain'
                WHEN ('0x' || s[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM units
), cut AS (
    SELECT doc_id, t, n, form, array_to_string(u[1:low], '') AS prefix,
           array_to_string(u[low + 1:high], '') AS middle, array_to_string(u[high + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""

ORACLE["op13_conversation_trie"] = """
WITH own AS MATERIALIZED (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS MATERIALIZED (
    SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(str_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
        lambda crc, byte: list_reduce(
            [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))
    ), 4294967295::BIGINT) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM own)
), kept AS MATERIALIZED (
    SELECT convs.conv_id, 0 AS part, pos, role, text FROM convs JOIN own ON own.conv_id = base AND pos <= h
    UNION ALL
    SELECT conv_id, 1, pos, role, text FROM convs JOIN own USING (conv_id) WHERE pos > h
), turns AS MATERIALIZED (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM kept
), paths AS MATERIALIZED (
    SELECT conv_id, depth, octet_length(encode(text)) AS bytes,
           md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY depth)) || depth AS node
    FROM turns
    UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs
), ending AS (
    SELECT conv_id, max(depth) AS len FROM paths GROUP BY conv_id
), nodes AS MATERIALIZED (
    SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
           string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len) AS ends
    FROM paths JOIN ending USING (conv_id) GROUP BY node
), linked AS MATERIALIZED (
    SELECT nodes.*, up.node AS parent FROM nodes LEFT JOIN paths up ON up.conv_id = nodes.conv_id AND up.depth = nodes.depth - 1
), children AS MATERIALIZED (
    SELECT parent AS node, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent
), below AS MATERIALIZED (
    SELECT up.node, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * nodes.bytes) AS saved
    FROM nodes LEFT JOIN children USING (node)
    JOIN paths up ON up.conv_id = nodes.conv_id AND up.depth <= nodes.depth GROUP BY up.node
)
SELECT linked.conv_id, linked.depth, parents.conv_id AS parent_conv_id, linked.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(linked.ends, '')) AS ends_sha256
FROM linked JOIN below ON below.node = linked.node LEFT JOIN children ON children.node = linked.node
LEFT JOIN nodes parents ON parents.node = linked.parent
"""
