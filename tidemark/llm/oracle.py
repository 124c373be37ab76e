"""The corpus queries that SQL can express, as DuckDB SQL."""

ORACLE: dict[str, str] = {
    "op5_poisson_mixing": """
        WITH sizes AS (
            SELECT source, sum(strlen(coalesce(text, ''))) AS size FROM documents GROUP BY source
        ), rates AS (
            SELECT source,
                   CASE WHEN size > 0 THEN pow(size, 0.7) / (SELECT sum(pow(size, 0.7)) FROM sizes WHERE size > 0)
                        * (SELECT sum(size) FROM sizes) / size ELSE 0 END AS rate
            FROM sizes
        ), terms AS (
            SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
            FROM rates, range(0, 400) steps(k) WHERE rate > 0
        ), distribution AS (
            SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms
        ), draws AS (
            SELECT d.*, (CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|1'), 1, 13) AS BIGINT)
                         + 0.5) / 4503599627370496.0 AS u
            FROM documents d
        ), counted AS (
            SELECT draws.*, CAST((SELECT count(*) FROM distribution t
                                  WHERE t.source IS NOT DISTINCT FROM draws.source AND t.c < draws.u) AS INTEGER) AS copies
            FROM draws
        )
        SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(1, copies + 1)) AS INTEGER) AS copy, copies
        FROM counted WHERE copies > 0
    """,
    "op6_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_stripe_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        ), lists AS (
            SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
        ), places AS (
            SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists
        ), phrases AS (
            SELECT lang, k, w[i : i + k - 1] AS p, count(*) AS f
            FROM places, (VALUES (1), (2), (3)) sizes(k) WHERE i + k - 1 <= len(w) GROUP BY ALL
        ), sizes AS (
            SELECT lang, sum(f) AS n FROM phrases WHERE k = 1 GROUP BY lang
        ), candidates AS (
            SELECT * FROM phrases WHERE k >= 2 AND f >= 10
        ), cuts AS (
            SELECT c.lang, c.k, c.p, c.f AS a, x.k AS cut, x.f AS l, y.f AS r,
                   CAST((CAST(1000000 AS HUGEINT) * c.f * c.f) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM candidates c
            JOIN phrases x ON x.lang = c.lang AND x.k < c.k AND x.p = c.p[1 : x.k]
            JOIN phrases y ON y.lang = c.lang AND y.k = c.k - x.k AND y.p = c.p[x.k + 1 : c.k]
        ), scored AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
        ), longer AS (
            SELECT lang, p, max(f) AS m FROM (
                SELECT lang, p[1 : 2] AS p, f FROM candidates WHERE k = 3
                UNION ALL SELECT lang, p[2 : 3], f FROM candidates WHERE k = 3)
            GROUP BY ALL
        ), kept AS (
            SELECT s.lang, array_to_string(s.p, ' ') AS phrase, s.a, s.l, s.r, s.score
            FROM scored s LEFT JOIN longer o ON o.lang = s.lang AND o.p = s.p
            WHERE o.m IS NULL OR 100 * o.m < 50 * s.a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
               a, l, r, CAST(n AS BIGINT) AS n, score
        FROM kept JOIN sizes USING (lang)
        QUALIFY rank <= 2000
    """,
    "op12_ball_tree_search": """
        WITH counted AS (
            SELECT doc_id, row_number() OVER () AS place,
                   regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
            FROM documents
        ), size AS (
            SELECT count(*) AS docs, sum(len(t)) AS terms FROM counted WHERE len(t) > 0
        ), tfs AS (
            SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(t) AS term FROM counted) GROUP BY ALL
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tfs, size GROUP BY term, docs
        ), impacts AS (
            SELECT doc_id, place, term,
                   (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(t) * docs) // terms)) AS x
            FROM tfs JOIN counted USING (place), size
        ), asked AS (
            SELECT item_id, row_number() OVER () AS item, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM benchmark
        ), scores AS (
            SELECT item, item_id, place, doc_id, CAST(sum(w * x) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL HAVING score > 0
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, place) AS INTEGER) AS rank,
               doc_id, score
        FROM scores QUALIFY rank <= 10
    """,
}
