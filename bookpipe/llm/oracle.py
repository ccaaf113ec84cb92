"""SQL counterparts, for DuckDB, of the queries that SQL can express."""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op5_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({LOWERED}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    # Shingles stand as texts joined by a tab, which no word holds. Links are followed to the end.
    "op9_minhash_dedup": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex({LOWERED}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 3
                THEN list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], chr(9)))
                WHEN len(words) > 0 THEN [array_to_string(words, chr(9))] ELSE [] END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
        reached(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id, min(r.b) = d.doc_id AS kept
        FROM documents d JOIN reached r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n""",
    # Every distance q: stretches where words q apart are equal, without those that a divisor of q explains. CRC-32 is spelled out, bit by bit.
    "op11_periodic_runs": """
        WITH h AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
                xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda c, b:
                    list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) AS h FROM documents),
        g AS (SELECT doc_id, words, h, len(words) AS n, CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a FROM h),
        p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM g),
        w AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE words END AS words FROM p),
        t AS (SELECT doc_id, n, unnest(words) AS word, unnest(range(n)) AS i FROM w),
        e AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
        s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (
                SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e) GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
        r AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM s b WHERE b.doc_id = s.doc_id AND b.q < s.q AND s.q % b.q = 0 AND b.start <= s.start AND b.start + b.length >= s.start + s.length)),
        a AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed,
                list({'l': length, 's': -start, 'q': -q} ORDER BY length DESC, start, q)[1] AS best FROM r GROUP BY doc_id),
        k AS (SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.i) AS kept FROM t
              WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = t.doc_id AND t.i >= r.start + r.q AND t.i < r.start + r.length) GROUP BY t.doc_id)
        SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, -best.s AS start, best.l AS length, -best.q AS period, 1000 * best.l // -best.q AS exponent_milli,
               sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
        FROM documents d LEFT JOIN a USING (doc_id) LEFT JOIN k USING (doc_id)""",
    # Sources in the order in which rising water reaches their caps; all from the first one on that stays below share the rest.
    "op12_source_mixing": """
        WITH d AS (SELECT doc_id, source, md5('mixture:' || doc_id) AS key,
                          len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
        o AS (SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source) AS place FROM w),
        r AS (SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                     sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM o),
        f AS (SELECT min(place) AS place FROM r WHERE rest * weight <= 3 * source_size * weights),
        t AS (SELECT r.source, r.source_size, CASE WHEN r.place < f.place THEN 3.0 * r.source_size
                     ELSE r.weight * x.rest::DOUBLE / x.weights END AS target FROM r, f JOIN r x ON x.place = f.place),
        n AS (SELECT d.doc_id, d.size, t.source_size, t.target, least(3 * t.source_size, floor(t.target + 0.5))::BIGINT AS need,
                     sum(d.size) OVER (PARTITION BY d.source ORDER BY key ROWS UNBOUNDED PRECEDING) - d.size AS before
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target::DOUBLE AS target, CASE WHEN size = 0 THEN 0 ELSE need // source_size * size
               + greatest(0, least(size, need % source_size - before)) END::BIGINT AS taken FROM n""",
    # Phrases stand as texts; a word holds no blank.
    "op13_phrases": f"""
        WITH p AS (SELECT lang, row_number() OVER () AS piece, words FROM (
                SELECT lang, list_filter(string_split_regex(part, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM (
                    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWERED}, '[.,;:!?\\x0A-\\x0D]')) AS part FROM documents))),
        w AS (SELECT lang, piece, unnest(words) AS word, unnest(range(len(words))) AS i FROM p),
        g AS (SELECT lang, word, lead(word) OVER s AS second, lead(word, 2) OVER s AS third FROM w WINDOW s AS (PARTITION BY piece ORDER BY i)),
        f AS (SELECT lang, 1 AS words, word AS phrase, count(*) AS f FROM g GROUP BY lang, phrase
              UNION ALL SELECT lang, 2, word || ' ' || second AS phrase, count(*) FROM g WHERE second IS NOT NULL GROUP BY lang, phrase
              UNION ALL SELECT lang, 3, word || ' ' || second || ' ' || third AS phrase, count(*) FROM g WHERE third IS NOT NULL GROUP BY lang, phrase),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
        c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS parts, unnest(range(1, words)) AS k FROM f WHERE words > 1 AND f >= 10),
        s AS (SELECT c.*, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f))::BIGINT AS score FROM c
              JOIN f x ON x.lang = c.lang AND x.words = c.k AND x.phrase = array_to_string(c.parts[1:c.k], ' ')
              JOIN f y ON y.lang = c.lang AND y.words = c.words - c.k AND y.phrase = array_to_string(c.parts[c.k + 1:], ' ')),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        i AS (SELECT lang, a, unnest([array_to_string(parts[1:2], ' '), array_to_string(parts[2:3], ' ')]) AS phrase FROM b WHERE words = 3),
        m AS (SELECT lang, phrase, max(a) AS longer FROM i GROUP BY lang, phrase),
        r AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, b.l, b.r, b.score
              FROM b LEFT JOIN m ON m.lang = b.lang AND m.phrase = b.phrase WHERE m.longer IS NULL OR 100 * m.longer < 50 * b.a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000""",
}
