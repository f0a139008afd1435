"""DuckDB SQL of the queries that SQL expresses."""
from __future__ import annotations

ORACLE_SQL: dict[str, str] = {
    "op1_topk_search": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
                 CAST(coalesce(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1),
                                              lambda i: a.q[i] * b.q[i])), 0) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
        r AS (
          SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                 vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op11_k2treap_search": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, lower_az AS t FROM (
               SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)),
        w AS (SELECT r, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        tf AS (SELECT r, doc_id, term, count(*) AS tf FROM w GROUP BY ALL),
        n AS (SELECT r, count(*) AS n FROM w GROUP BY r),
        c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        i AS (SELECT row_number() OVER () AS q, item_id,
                     regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
        it AS (SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
        s AS (SELECT q, item_id, r, doc_id,
                     sum(times * floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT
                         * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))))::BIGINT AS score
              FROM it JOIN tf USING (term) JOIN df USING (term) JOIN n USING (r) CROSS JOIN c GROUP BY ALL)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
        WHERE rank <= 20""",
    "op12_phrase_collocations": r"""
        WITH t AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        p AS (SELECT r, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
        n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
        g AS (SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: ws[i:i + size - 1])) AS phrase
              FROM w, (VALUES (1), (2), (3)) s(size) WHERE len(ws) >= size),
        f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 10),
        c AS (SELECT lang, size, phrase, f AS a, unnest(range(1, size)) AS k FROM f WHERE size > 1),
        x AS (SELECT c.*, p.f AS l, q.f AS r, (1000000::HUGEINT * a * a) // (p.f::HUGEINT * q.f) AS score
              FROM c JOIN f p ON p.lang = c.lang AND p.phrase = c.phrase[1:c.k]
                     JOIN f q ON q.lang = c.lang AND q.phrase = c.phrase[c.k + 1:c.size]),
        best AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        around AS (SELECT lang, part, max(a) AS f FROM (
              SELECT lang, f AS a, unnest([phrase[1:2], phrase[2:3]]) AS part FROM f WHERE size = 3) GROUP BY ALL),
        kept AS (SELECT best.* FROM best LEFT JOIN around u ON u.lang = best.lang AND u.part = best.phrase
                 WHERE u.f IS NULL OR 100 * u.f < 50 * a),
        ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank,
                          array_to_string(phrase, ' ') AS phrase, a, l, r, score::BIGINT AS score FROM kept)
        SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
}
