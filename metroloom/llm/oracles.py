"""DuckDB SQL with the same results as the queries, where SQL can express them."""

#: Of the formatted length of a text: each of these strings and each backslash adds one sign.
_CONTROLS = ["<|turn|>", "<|end|>", "<|image:", "<|audio:", "<|document:", "<|endoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\"]


def _escaped(column: str) -> str:
    added = [f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in _CONTROLS]
    return f"(length({column}) + {' + '.join(added)})"


ORACLES: dict[str, str] = {
    "op1_chat_format": f"""
        WITH rows AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(8 + length(role) + 1 + {_escaped("text")} + 7 + 1)::BIGINT AS formatted_chars
        FROM rows GROUP BY conv_id
    """,
    "op3_url_lists": r"""
        WITH captures AS (
          SELECT page_id, nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '') AS host,
                 DATE '2024-01-01' + ((page_id * 37) % 366)::INT AS fetched FROM pages),
        hosts AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM captures WHERE host IS NOT NULL),
        patterns AS (SELECT host AS pattern FROM hosts UNION SELECT array_to_string(l[greatest(len(l) - 1, 1):], '.') FROM hosts),
        numbered AS (SELECT pattern, ('0x' || substr(md5(pattern), 1, 6))::BIGINT AS n FROM patterns),
        entries AS (
          SELECT pattern, DATE '2024-01-01' + (n % 90)::INT AS date, 'block' AS action FROM numbered
          UNION ALL SELECT pattern, DATE '2024-01-01' + (n % 90 + 40 + n % 7)::INT, 'allow' FROM numbered
          UNION ALL SELECT pattern, DATE '2024-01-01' + (n % 90 + 120 + n % 11)::INT, 'review' FROM numbered),
        held AS (SELECT *, lead(date) OVER (PARTITION BY pattern ORDER BY date) AS until FROM entries),
        met AS (
          SELECT c.page_id, h.pattern, h.date, h.action, row_number() OVER (PARTITION BY c.page_id ORDER BY length(h.pattern) DESC) AS k
          FROM captures c JOIN held h ON (c.host = h.pattern OR ends_with(c.host, '.' || h.pattern)) AND h.date <= c.fetched AND (h.until IS NULL OR c.fetched < h.until))
        SELECT c.page_id, c.host, c.fetched::VARCHAR AS fetched, m.pattern, m.date::VARCHAR AS listed_since, coalesce(m.action, 'allow') AS verdict
        FROM captures c LEFT JOIN met m ON m.page_id = c.page_id AND m.k = 1
    """,
    "op4_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages),
        w AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS top FROM p)
        SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
        FROM w
    """,
    "op5_near_dup": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
        reach(doc_id, to_id) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.to_id)
        SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(to_id) AS component_id, r.doc_id = min(to_id) AS kept
        FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
    """,
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op8_sharding": """
        WITH steps AS (SELECT list_transform(range(256), lambda c: list_reduce(range(8), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, c)) AS t),
        docs AS (SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, sha256(coalesce(text, '')) AS digest,
                        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes FROM documents),
        crcs AS (SELECT doc_id, size, digest, xor(list_reduce(bytes, lambda a, v: xor(a >> 8, t[(xor(a, v) & 255) + 1]), 4294967295), 4294967295) AS text_crc32 FROM docs, steps),
        placed AS (SELECT *, sum(size) OVER (ORDER BY digest, doc_id ROWS UNBOUNDED PRECEDING) - size AS before, row_number() OVER (ORDER BY digest, doc_id) AS place, sum(size) OVER () AS total FROM crcs),
        cut AS (SELECT *, least((2 * before + size) * 24 // (2 * total), 23) AS part FROM placed),
        whole AS (SELECT digest, min(part) AS home FROM cut GROUP BY digest HAVING min(part) < max(part) AND sum(size) <= max(total) * (0.01 / 24)),
        dealt AS (SELECT cut.*, coalesce(home, part)::INT AS shard FROM cut LEFT JOIN whole USING (digest))
        SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, place - min(place) OVER (PARTITION BY shard) AS slot, NULL::INT AS grown_shard FROM dealt
    """,
}
