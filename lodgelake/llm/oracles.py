"""DuckDB SQL of the operators that SQL can express, written from their definitions."""

TOP_K = """
WITH whole AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON c.r <> q.r AND len(c.v) = len(q.v)
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# crc32 byte by byte: the table entry of x is eight conditional shifts of x
SHARDING = """
WITH RECURSIVE steps(x, c, k) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL
    SELECT x, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc_table AS (
    SELECT list(c ORDER BY x) AS t FROM steps WHERE k = 8
), digits AS (
    SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size,
           string_split(hex(encode(coalesce(text, ''))), '') AS h
    FROM documents
), octets AS (
    SELECT doc_id, size, CASE WHEN size = 1 THEN [4294967295::BIGINT] ELSE list_prepend(4294967295::BIGINT, list_transform(range(1, size), lambda i:
               (16 * (strpos('0123456789ABCDEF', h[2 * i - 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i]) - 1)::BIGINT)) END AS b
    FROM digits
), sums AS (
    SELECT doc_id, size,
           xor(list_reduce(b, lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS text_crc32
    FROM octets, crc_table
), running AS (
    SELECT doc_id, size, text_crc32,
           sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto,
           sum(size) OVER () AS total
    FROM sums
), placed AS (
    SELECT *, CAST(((2 * upto - size) * 8) // (2 * total) AS INTEGER) AS shard FROM running
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}'), []) AS w
    FROM documents
), item AS (
    SELECT item_id,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}'), []) AS w
    FROM benchmark
), windows AS (
    SELECT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS p
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)
), lengths AS (
    SELECT DISTINCT n FROM windows
), places AS (
    SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, lengths WHERE len(w) >= n)
), occurs AS (
    SELECT r, n, i, item_id FROM places JOIN windows USING (n, p)
), hit AS (
    SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM occurs) GROUP BY r
), named AS (
    SELECT r, count(DISTINCT item_id) AS n_items,
           coalesce(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)), '') AS ids
    FROM occurs GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

SUBSTRINGS = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS place,
           coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
    FROM documents
), windows AS (
    SELECT r, place, i, array_to_string(w[i:i + 49], ' ') AS p
    FROM (SELECT r, place, w, unnest(range(1, len(w) - 48)) AS i FROM doc WHERE len(w) >= 50)
), earliest AS (
    SELECT p, min(place) AS least FROM windows GROUP BY p
), gone AS (
    SELECT DISTINCT r, unnest(range(i, i + 50)) AS k FROM windows JOIN earliest USING (p) WHERE least < place
), words AS (
    SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM doc
), kept AS (
    SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY k) AS text FROM words ANTI JOIN gone USING (r, k) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""

SPELLING = """
WITH RECURSIVE steps(x, c, k) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL
    SELECT x, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc_table AS (
    SELECT list(c ORDER BY x) AS t FROM steps WHERE k = 8
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-z\\x{00C0}-\\x{00FF}]+')) AS run
    FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS c, string_split(hex(encode(concat(doc_id, ':', run))), '') AS h
    FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run
), octets AS (
    SELECT doc_id, run, c, list_prepend(4294967295::BIGINT, list_transform(range(1, len(h) // 2 + 1), lambda i:
               (16 * (strpos('0123456789ABCDEF', h[2 * i - 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i]) - 1)::BIGINT)) AS b
    FROM counted
), hashed AS (
    SELECT doc_id, run, c, xor(list_reduce(b, lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h
    FROM octets, crc_table
), results AS (
    SELECT CASE WHEN doc_id IS NOT NULL AND h % 199 = 0
                THEN left(run, CAST(h % length(run) AS BIGINT)) || substring(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, c
    FROM hashed
), lexicon AS (
    SELECT word, CAST(sum(c) AS BIGINT) AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
), shorter AS (
    SELECT word, n, i, left(word, i - 1) || substring(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM lexicon)
), pairs AS (
    SELECT a.word, a.n, b.word AS other, b.n AS m FROM shorter a JOIN shorter b USING (i, rest) WHERE a.word <> b.word
    UNION
    SELECT s.word, s.n, l.word, l.n FROM shorter s JOIN lexicon l ON l.word = s.rest
    UNION
    SELECT l.word, l.n, s.word, s.n FROM shorter s JOIN lexicon l ON l.word = s.rest
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY word ORDER BY m DESC, encode(other)) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
), formed AS (
    SELECT l.word, l.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * l.n THEN other END AS form, CASE WHEN m >= 5 * l.n THEN m END AS form_n
    FROM lexicon l LEFT JOIN ranked r ON r.word = l.word AND r.k = 1
), chain(word, last) AS (
    SELECT word, word FROM formed
    UNION ALL
    SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.last WHERE formed.form IS NOT NULL
), ends AS (
    SELECT chain.word, chain.last AS root FROM chain JOIN formed ON formed.word = chain.last WHERE formed.form IS NULL
)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM formed JOIN ends USING (word)
"""
