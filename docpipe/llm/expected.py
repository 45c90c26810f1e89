"""SQL for DuckDB that gives the rows of the queries, where SQL can express them."""

# Five-word shingles as lists of words; a word ends at ASCII white space and punctuation.
_SHINGLES = r"""
        {name}_words AS (
          SELECT {id}, string_split(trim(regexp_replace(lower(text),
                   '[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+', ' ', 'g')), ' ') AS w
          FROM {table} WHERE text IS NOT NULL
        ), {name} AS (
          SELECT DISTINCT {id}, list_slice(w, i, i + 4) AS s
          FROM (SELECT {id}, w, unnest(range(1, len(w) - 3)) AS i FROM {name}_words)
        )"""


def _shingle_tables(name: str, id_column: str, table: str) -> str:
    return _SHINGLES.format(name=name, id=id_column, table=table)


_NEAREST = """
        a{n} AS (
          SELECT row_id, c, d FROM (
            SELECT row_id, c, d, row_number() OVER (PARTITION BY row_id ORDER BY d, c) AS r
            FROM (SELECT row_id, c, sum((x - y) * (x - y)) AS d
                  FROM kept JOIN c{n} USING (pos) GROUP BY row_id, c))
          WHERE r = 1
        )"""
_MEANS = """
        m{n} AS (
          SELECT c, pos, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS y
          FROM a{n} JOIN kept USING (row_id) GROUP BY c, pos
        ), c{next} AS (
          SELECT c, pos, coalesce(m{n}.y, c{n}.y) AS y FROM c{n} LEFT JOIN m{n} USING (c, pos)
        )"""


def _clusters(rounds: int = 3) -> str:
    """Every vector with every centroid, round by round; one row per component."""
    steps = [part.format(n=n, next=n + 1) for n in range(rounds) for part in (_NEAREST, _MEANS)]
    return f"""
        WITH whole AS (
          SELECT vec_id, row_number() OVER () AS row_id, embedding FROM embeddings
          WHERE len(embedding) = 64
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), kept AS (
          SELECT row_id, unnest(range(1, 65)) AS pos,
                 unnest(list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::HUGEINT)) AS x
          FROM whole
        ), first AS (
          SELECT row_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c FROM whole
        ), c0 AS (SELECT c, pos, x AS y FROM first JOIN kept USING (row_id) WHERE c < 16),
        {",".join(steps)},{_NEAREST.format(n=rounds)},
        digests AS (
          SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY pos)) AS digest
          FROM c{rounds} GROUP BY c
        )
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
               CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
               CAST(sum(d) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
        FROM a{rounds} JOIN whole USING (row_id) JOIN digests USING (c)
    """


EXPECTED = {
    # a text of one to four words is one shingle; equal texts are linked even without words
    "op2_probminhash_classes": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, text, string_split(trim(regexp_replace(lower(text),
                   '[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+', ' ', 'g')), ' ') AS w
          FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL
        ), d AS (
          SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS s
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i
                FROM w WHERE w <> [''])
        ), n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
        common AS (
          SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
          FROM d x JOIN d y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY ALL
        ), links AS (
          SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE c / (na.n + nb.n - c) >= 0.8
          UNION
          SELECT x.doc_id, y.doc_id FROM w x JOIN w y USING (text) WHERE x.doc_id <> y.doc_id
        ), reach AS (
          SELECT DISTINCT doc_id AS a, doc_id AS b FROM documents WHERE doc_id IS NOT NULL
          UNION
          SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), class AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a)
        SELECT doc_id, class_id FROM documents LEFT JOIN class ON doc_id = a
    """,
    "op6_benchmark_containment": f"""
        WITH {_shingle_tables("d", "doc_id", "documents")},
        {_shingle_tables("b", "item_id", "benchmark")},
        sizes AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id)
        SELECT doc_id, item_id, count(*) / any_value(n) AS containment
        FROM d JOIN b USING (s) JOIN sizes USING (item_id)
        GROUP BY doc_id, item_id HAVING count(*) / any_value(n) >= 0.8
    """,
    "op4_cover_tree_topk": """
        WITH whole AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
          SELECT q.vec_id AS query_id, b.vec_id,
                 CAST(list_inner_product(q.v, b.v) AS BIGINT) AS score
          FROM whole q JOIN whole b ON q.vec_id <> b.vec_id AND len(q.v) = len(b.v)
          WHERE q.vec_id % 50 = 0
        ), ranked AS (
          SELECT query_id, CAST(row_number() OVER (
                   PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                 vec_id, score
          FROM scored
        )
        SELECT * FROM ranked WHERE rank <= 5
    """,
    "op8_warc_revisits": """
        WITH payloads AS (
          SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                 sha1(coalesce(html, '')) AS payload_digest
          FROM pages
        ), newest AS (
          SELECT payload_digest, max(page_id) AS original
          FROM payloads WHERE payload_bytes >= 1000 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < original THEN original END AS refers_to
        FROM payloads LEFT JOIN newest USING (payload_digest)
    """,
    "op11_fill_in_middle": """
        WITH draws AS (
          SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS cut,
                 sha256('7:' || doc_id) AS h
          FROM documents
        ), units AS (
          SELECT doc_id, text, list_transform(cut[1:len(cut) - 1], lambda x: x || chr(10))
                   || CASE WHEN cut[len(cut)] = '' THEN [] ELSE [cut[len(cut)]] END AS u,
                 CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                 CAST('0x' || h[25:32] AS BIGINT) AS h4
          FROM draws
        ), cuts AS (
          SELECT *, CAST(len(u) AS BIGINT) AS n,
                 least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
                 greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                        OR contains(text, '<M>') THEN 'plain'
                      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
          FROM units
        ), parts AS (
          SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
                 array_to_string(u[b + 1:], '') AS suffix
          FROM cuts
        )
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
                 AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
    "op13_heap_kmeans": _clusters(),
}
