"""SQL for the queries of this package that SQL can express, for another engine."""

LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

ORACLE: dict[str, str] = {
    "op2_decontamination": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
            FROM documents
        ), b AS (
            SELECT item_id::VARCHAR AS item_id, ws, least(len(ws), 10) AS n
            FROM (SELECT item_id,
                         regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
                  FROM benchmark)
            WHERE len(ws) > 0
        ), starts AS (
            SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS spot FROM b
        ), grams AS (
            SELECT DISTINCT item_id, n, array_to_string(list_slice(ws, spot, spot + n - 1), ' ') AS gram FROM starts
        ), places AS (
            SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS spot
            FROM d, (SELECT DISTINCT n FROM grams)
            WHERE len(ws) >= n
        ), hits AS (
            SELECT r, spot, p.n, item_id
            FROM (SELECT r, spot, n, array_to_string(list_slice(ws, spot, spot + n - 1), ' ') AS gram FROM places) p
            JOIN grams g ON g.gram = p.gram
        ), marked AS (
            SELECT r, count(DISTINCT word) AS n_hit
            FROM (SELECT r, unnest(range(spot, spot + n)) AS word FROM hits) GROUP BY r
        ), items AS (
            SELECT r, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items
            FROM hits GROUP BY r
        )
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN marked USING (r) LEFT JOIN items USING (r)
    """,
    "op5_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (same ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(body) AS text_sha256
        FROM (SELECT doc_id, {LOWERED} AS body FROM documents)
        WINDOW same AS (PARTITION BY body)
    """,
    "op7_superkmer_dedup": """
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws
            FROM documents
        ), windows AS (
            SELECT r, doc_id, spot, array_to_string(list_slice(ws, spot, spot + 49), ' ') AS passage
            FROM (SELECT *, unnest(range(1, len(ws) - 48)) AS spot FROM d WHERE len(ws) >= 50)
        ), again AS (
            SELECT r, spot
            FROM (SELECT r, spot, min(doc_id) OVER (PARTITION BY passage)
                         < coalesce(doc_id, 9223372036854775807) AS earlier FROM windows)
            WHERE earlier
        ), gone AS (
            SELECT DISTINCT r, unnest(range(spot, spot + 50)) AS i FROM again
        ), kept AS (
            SELECT r, string_agg(word, ' ' ORDER BY i) AS body
            FROM (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d)
            ANTI JOIN gone USING (r, i)
            GROUP BY r
        ), counted AS (
            SELECT r, count(*) AS n FROM gone GROUP BY r
        )
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
               sha256(coalesce(body, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r) LEFT JOIN counted USING (r)
    """,
    "op12_importance": f"""
        WITH RECURSIVE remainders AS (
            SELECT b, 0 AS step, b AS c FROM range(256) t(b)
            UNION ALL
            SELECT b, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
            FROM remainders WHERE step < 8
        ), crc AS (
            SELECT list(c ORDER BY b) AS entries FROM remainders WHERE step = 8
        ), d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
            FROM documents
        ), b AS (
            SELECT regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
            FROM benchmark
        ), words AS (
            SELECT r, unnest(ws) AS word FROM d
        ), target AS (
            SELECT unnest(ws) AS word FROM b
        ), coded AS (
            SELECT word, xor(list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(word))),
                           lambda i: ('0x' || substr(hex(word), 2 * i + 1, 2))::BIGINT)),
                       lambda c, x: xor(c >> 8, entries[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM (SELECT word FROM words UNION SELECT word FROM target), crc
        ), counts AS (
            SELECT bucket, sum(s) AS s, sum(t) AS t
            FROM (SELECT word, count(*) AS s, 0 AS t FROM words GROUP BY word
                  UNION ALL SELECT word, 0, count(*) FROM target GROUP BY word)
            JOIN coded USING (word) GROUP BY bucket
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                       / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
            FROM counts
        ), weights AS (
            SELECT r, floor(sum(gain) / count(*))::BIGINT AS weight
            FROM words JOIN coded USING (word) JOIN gains USING (bucket) GROUP BY r
        ), scored AS (
            SELECT r, doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln(
                       (('0x' || left(sha256('2024:' || doc_id::VARCHAR), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE
                   )))::BIGINT AS score
            FROM d LEFT JOIN weights USING (r)
        ), eligible AS (
            SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
            FROM scored WHERE n_features >= 20 AND doc_id IS NOT NULL
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
        FROM scored LEFT JOIN eligible USING (r)
    """,
}
