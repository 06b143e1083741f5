"""Reference SQL for the registered queries that SQL can express."""

from __future__ import annotations

MIX = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS k
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS rank
    FROM d GROUP BY source
), w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM s
), f AS (
    SELECT *, (2 * source_size) * sum(weight) OVER later
        < weight * (budget - coalesce(sum(2 * source_size) OVER earlier, 0)) AS stops
    FROM w
    WINDOW earlier AS (ORDER BY 2 * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        later AS (ORDER BY 2 * source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), t AS (
    SELECT source, source_size, rank, budget, CASE WHEN stops THEN 2.0::DOUBLE * source_size ELSE least(2.0::DOUBLE * source_size,
        weight * (budget - coalesce(sum(2 * source_size) FILTER (stops) OVER (), 0))::DOUBLE
        / (sum(weight) FILTER (NOT stops) OVER ())::DOUBLE) END AS target
    FROM f
), q AS (
    SELECT d.*, source_size, rank, target, budget, row_number() OVER () AS id,
        CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k ROWS UNBOUNDED PRECEDING) AS BIGINT) AS queued
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
    SELECT id, size, budget, sum(size) OVER (ORDER BY (queued + turn * source_size) / target, rank, queued + turn * source_size
        ROWS UNBOUNDED PRECEDING) AS used
    FROM q, (SELECT unnest([0, 1]) AS turn) WHERE size > 0
), n AS (SELECT id, count(*) AS turns FROM c WHERE used <= budget GROUP BY id)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * coalesce(turns, 0) AS BIGINT) AS taken
FROM q LEFT JOIN n USING (id)
"""

RUNS = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), h AS (
    SELECT *, len(w) AS n, xor(list_reduce(list_concat([4294967295],
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))), lambda c, x:
        list_reduce(list_concat([xor(c, x)], CAST(range(8) AS BIGINT[])), lambda e, y:
            CASE WHEN e & 1 = 1 THEN xor(e >> 1, 3988292384) ELSE e >> 1 END)), 4294967295) AS h
    FROM d
), g AS (
    SELECT *, CASE WHEN n > 0 THEN (h // 10) % n ELSE 0 END AS a FROM h
), p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM g
), x AS (
    SELECT id, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: CASE WHEN i >= a THEN w[1 + a + (i - a) % p] ELSE w[1 + i] END)
        ELSE w END AS w
    FROM p
), t AS (SELECT id, unnest(w) AS word, unnest(range(n)) AS i FROM x
), e AS (
    SELECT a.id, b.i - a.i AS p, a.i, a.i - row_number() OVER (PARTITION BY a.id, b.i - a.i ORDER BY a.i) AS island
    FROM t a JOIN t b ON a.id = b.id AND a.word = b.word AND b.i > a.i
), m AS (
    SELECT id, p, min(i) AS s, count(*) + p AS len FROM e GROUP BY id, p, island
    HAVING count(*) >= p AND count(*) + p >= 12
), r AS (SELECT id, s, len, min(p) AS q FROM m GROUP BY id, s, len
), k AS (
    SELECT t.id, t.word, t.i FROM t
    ANTI JOIN (SELECT DISTINCT id, unnest(range(s + q, s + len)) AS i FROM r) AS c ON c.id = t.id AND c.i = t.i
), f AS (
    SELECT id, count(*) AS n_runs, sha256(string_agg(concat(s, ',', len, ',', q, chr(10)), '' ORDER BY s, q)) AS runs_sha256,
        first({'s': s, 'len': len, 'q': q} ORDER BY len DESC, s, q) AS best
    FROM r GROUP BY id
), c AS (SELECT id, sha256(string_agg(word, ' ' ORDER BY i)) AS collapsed_sha256 FROM k GROUP BY id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, CAST(best.len AS BIGINT) AS length, best.q AS period,
    CAST(1000 * best.len // best.q AS BIGINT) AS exponent_milli,
    coalesce(runs_sha256, sha256('')) AS runs_sha256, coalesce(collapsed_sha256, sha256('')) AS collapsed_sha256
FROM x LEFT JOIN f USING (id) LEFT JOIN c USING (id)
"""

PHRASES = r"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), g AS (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
    FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE len(w) >= size
), f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100
), c AS (SELECT lang, size, phrase, f AS a FROM f WHERE size >= 2
), k AS (
    SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM c AS o WHERE o.lang = c.lang AND o.size > c.size
        AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * o.a >= 100 * c.a)
), s AS (
    SELECT lang, phrase, a, size, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS first,
        array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
    FROM k, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE k < size
), t AS (
    SELECT s.lang, s.phrase, s.a, n.n, min({'score': 1000::HUGEINT * s.a * n.n // (l.f::HUGEINT * r.f), 'k': s.k, 'l': l.f, 'r': r.f}) AS cut
    FROM s JOIN f AS l ON l.lang = s.lang AND l.phrase = s.first JOIN f AS r ON r.lang = s.lang AND r.phrase = s.rest
        JOIN n ON n.lang = s.lang
    GROUP BY ALL
)
SELECT lang, row_number() OVER best AS rank, phrase, a, cut.l AS l, cut.r AS r, n, CAST(cut.score AS BIGINT) AS score
FROM t WINDOW best AS (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase)
QUALIFY row_number() OVER best <= 2000
"""

# The permutation's constants are stated again: multipliers of the round function and of the keys.
SHARDS = r"""
WITH RECURSIVE c AS (
    SELECT 13787848793156543929::UHUGEINT AS step, 11400714819323198485::UHUGEINT AS golden, 18446744073709551616::UHUGEINT AS wrap,
        20240601::UHUGEINT AS seed
), k AS (
    SELECT *, [(seed * step + i::UHUGEINT * golden) % wrap FOR i IN [1, 2, 3, 4, 5, 6]] AS keys FROM c
), d AS (
    SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id NULLS FIRST, octet_length(encode(text))) - 1 AS place,
        count(*) OVER () AS n
    FROM documents
), w AS (
    SELECT place, n, greatest(1, (length(bin(greatest(n, 2) - 1)) + 1) // 2)::BIGINT AS h,
        (place >> greatest(1, (length(bin(greatest(n, 2) - 1)) + 1) // 2)::BIGINT)::UHUGEINT AS l,
        (place % (1 << greatest(1, (length(bin(greatest(n, 2) - 1)) + 1) // 2)::BIGINT))::UHUGEINT AS r, 0 AS i
    FROM d
    UNION ALL
    SELECT place, n, h, r, xor(l, xor(t, t >> 29::UHUGEINT) % (1::BIGINT << h)::UHUGEINT), i + 1
    FROM (
        SELECT w.*, (xor(u, u >> 31::UHUGEINT) * golden) % wrap AS t
        FROM (SELECT w.*, golden, wrap, (xor(r, keys[i % 6 + 1]) * step) % wrap AS u FROM w, k) AS w
        WHERE NOT (i > 0 AND i % 6 = 0 AND l * (1::BIGINT << h)::UHUGEINT + r < n)
    ) AS w
), p AS (
    SELECT place AS row_number, CAST(l * (1::BIGINT << h)::UHUGEINT + r AS BIGINT) AS spot FROM w
    WHERE i > 0 AND i % 6 = 0 AND l * (1::BIGINT << h)::UHUGEINT + r < n
), crc AS (
    SELECT list(list_reduce(list_concat([b], CAST(range(8) AS BIGINT[])), lambda e, y:
        CASE WHEN e & 1 = 1 THEN xor(e >> 1, 3988292384) ELSE e >> 1 END) ORDER BY b) AS tab
    FROM (SELECT unnest(range(256)) AS b)
)
SELECT doc_id, CAST(octet_length(encode(text)) + 8 AS BIGINT) AS size,
    xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(text)), '..'),
        lambda x: CAST('0x' || x AS BIGINT))), lambda s, x: xor(tab[(xor(s, x) & 255) + 1], s >> 8)), 4294967295) AS text_crc32,
    'rows' AS law, CAST(spot % 24 AS INT) AS shard, spot // 24 AS slot, CAST(NULL AS INT) AS grown_shard, row_number
FROM d JOIN p ON row_number = place, crc
"""

ORACLES = {"op3_mix_sources": MIX, "op6_shuffle_shards": SHARDS, "op12_periodic_runs": RUNS, "op13_collocations": PHRASES}
