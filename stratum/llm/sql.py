"""DuckDB SQL of the queries of this subpackage that SQL can express."""

_ESCAPED = "regexp_replace(text, '~([012])', '~0\\1', 'g')"
for _control in ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE ", "[/ROLE]"):
    _ESCAPED = f"replace({_ESCAPED}, '{_control}', '~{1 if _control[0] == '<' else 2}{_control[1:]}')"

SQL = {
    "op1_vp_trees": """
        WITH e AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        s AS (SELECT q.vec_id AS query_id, e.vec_id, list_inner_product(q.v, e.v) AS score
              FROM e AS q JOIN e ON q.vec_id <> e.vec_id WHERE q.vec_id % 20 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
    """,
    "op6_prefix_targets": f"""
        WITH t AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        m AS (SELECT *, {_ESCAPED} AS body,
                     CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 15 WHEN 'assistant' THEN 4
                          ELSE 14 + coalesce(len(hex(role)), 1) END AS marks FROM t)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(len(body) + marks) AS BIGINT) AS formatted_chars
        FROM m GROUP BY conv_id
    """,
    "op5_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
        g AS (SELECT *, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
                     row_number() OVER (PARTITION BY body ORDER BY doc_id) AS nth FROM t)
        SELECT doc_id, keep_id, group_size, nth = 1 AS kept, sha256(body) AS text_sha256 FROM g
    """,
    "op12_era_collocations": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                          unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                   FROM documents),
        w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
        s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0),
        g AS (SELECT lang, array_to_string(ws[i:i + size - 1], ' ') AS phrase, size
              FROM s, (SELECT unnest([1, 2, 3]) AS size) WHERE i + size - 1 <= len(ws)),
        f AS (SELECT lang, phrase, size, count(*) AS a FROM g GROUP BY ALL),
        n AS (SELECT lang, sum(a) AS n FROM f WHERE size = 1 GROUP BY lang),
        c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE size > 1 AND a >= 10),
        k AS (SELECT *, unnest(range(1, size)) AS k FROM c),
        v AS (SELECT k.*, l.a AS l, r.a AS r, (1000000::HUGEINT * k.a * k.a) // (l.a::HUGEINT * r.a) AS score
              FROM k JOIN f AS l ON l.lang = k.lang AND l.phrase = array_to_string(k.ws[1:k.k], ' ')
                     JOIN f AS r ON r.lang = k.lang AND r.phrase = array_to_string(k.ws[k.k + 1:k.size], ' ')),
        b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inner_of AS (SELECT lang, array_to_string(ws[i:i + 1], ' ') AS phrase, max(a) AS most
                     FROM c, (SELECT unnest([1, 2]) AS i) WHERE size = 3 GROUP BY ALL),
        e AS (SELECT b.* FROM b LEFT JOIN inner_of o ON o.lang = b.lang AND o.phrase = b.phrase
              WHERE o.most IS NULL OR 100 * o.most < 50 * b.a)
        SELECT e.lang, rank, phrase, a, l, r, CAST(n.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM e) AS e
        JOIN n ON n.lang = e.lang WHERE rank <= 2000
    """,
}
