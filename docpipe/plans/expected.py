"""What the queries should give, in SQL straight from the input tables.

The receipts are printed, read and flattened by Spark; here their contents are computed from
the order tables by joins, defects included. The two share no code.
"""

from __future__ import annotations

_LINES = """
merged AS (
  SELECT l_orderkey AS k, (greatest(l_linenumber, 1) - 1) // 100 AS sheet, l_linenumber, l_partkey,
         l_suppkey, CAST(CAST(l_quantity AS BIGINT) * count(*) AS BIGINT) AS qty
  FROM lineitem
  GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT)
),
line AS (
  SELECT k, sheet, l_suppkey, p_name AS item_name, qty,
         CAST(round(p_retailprice * 100) AS BIGINT) AS unit,
         row_number() OVER (
           PARTITION BY k, sheet
           ORDER BY l_linenumber, l_partkey, l_suppkey, qty,
                    CAST(round(p_retailprice * 100) AS BIGINT)
         ) - 1 AS pos
  FROM merged LEFT JOIN part ON l_partkey = p_partkey
),
item AS (
  SELECT k, sheet, pos, item_name, qty, unit,
         qty * unit + CASE WHEN k % 67 = 6 AND pos = 0 THEN 1 ELSE 0 END AS amount
  FROM line
),
per_order AS (
  SELECT k, sheet, min(l_suppkey) AS seller, CAST(sum(qty * unit) AS BIGINT) AS subtotal,
         count(*) AS n_lines
  FROM line GROUP BY k, sheet
),
doc AS (
  SELECT o_orderkey AS k, sheet,
         CAST(o_orderkey AS VARCHAR) || CASE WHEN sheet > 0 THEN '/' || sheet ELSE '' END AS doc_id,
         o_orderkey % 97 <> 0 AS readable,
         n_lines IS NOT NULL AS has_lines,
         coalesce(n_lines, 0) AS n_lines,
         CASE WHEN o_orderkey % 79 = 3 THEN strftime(o_orderdate, '%Y/%m/%d')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS issue_date,
         c_name AS billing_name,
         n_lines IS NOT NULL AND o_orderkey % 71 = 5 AS zip_missing,
         CASE WHEN n_lines IS NOT NULL AND o_orderkey % 71 <> 5 THEN
           lpad(CAST(s_nationkey AS VARCHAR), 3, '0')
           || CASE WHEN o_orderkey % 73 = 4 THEN '' ELSE '-' END
           || lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0') END AS supplier_zip,
         n_name || ', ' || r_name AS supplier_address,
         CASE WHEN n_lines IS NULL THEN NULL WHEN o_orderkey % 61 = 7 THEN '' ELSE s_name END
           AS supplier_company,
         CAST(NULL AS VARCHAR) AS supplier_department,
         coalesce(subtotal, 0) AS true_subtotal,
         n_lines IS NOT NULL AND o_orderkey % 89 = 1 AND subtotal >= 1000 AS commas,
         coalesce(subtotal, 0) // 10 AS tax,
         coalesce(subtotal, 0) + coalesce(subtotal, 0) // 10
           + CASE WHEN o_orderkey % 83 = 2 THEN 1 ELSE 0 END AS total,
         o_orderpriority AS remarks
  FROM orders
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN per_order ON o_orderkey = k
  LEFT JOIN supplier ON seller = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
),
text AS (
  SELECT doc_id,
         CASE WHEN NOT readable THEN 'unreadable scan ' || k ELSE
           'Issue date: ' || issue_date || chr(10)
           || 'Billed to: ' || billing_name || chr(10)
           || CASE WHEN NOT has_lines THEN 'Supplier:' || chr(10) ELSE
                CASE WHEN zip_missing THEN '' ELSE 'Supplier zip: ' || supplier_zip || chr(10) END
                || 'Supplier address: ' || supplier_address || chr(10)
                || 'Supplier company: '
                || CASE WHEN supplier_company = '' THEN '""' ELSE supplier_company END || chr(10)
                || 'Supplier department:' || chr(10)
                || (SELECT string_agg('ITEM' || chr(9) || pos || chr(9) || item_name || chr(9)
                                      || qty || chr(9) || unit || chr(9) || amount || chr(10), ''
                                      ORDER BY pos)
                    FROM item WHERE item.k = doc.k AND item.sheet = doc.sheet) END
           || 'Subtotal: '
           || CASE WHEN commas THEN format('{:,}', true_subtotal)
                   ELSE CAST(true_subtotal AS VARCHAR) END || chr(10)
           || 'Tax: ' || tax || chr(10) || 'Total: ' || total || chr(10)
           || 'Remarks: ' || remarks END AS text
  FROM doc
),
header AS (
  SELECT k, sheet, doc_id, readable, has_lines, n_lines,
         CASE WHEN readable THEN issue_date END AS issue_date,
         CASE WHEN readable THEN billing_name END AS billing_name,
         CASE WHEN readable THEN supplier_zip END AS supplier_zip,
         CASE WHEN readable THEN supplier_address END AS supplier_address,
         CASE WHEN readable THEN supplier_company END AS supplier_company,
         supplier_department,
         CASE WHEN readable AND NOT commas THEN true_subtotal END AS subtotal,
         CASE WHEN readable THEN tax END AS consumption_tax,
         CASE WHEN readable THEN total END AS total_amount_with_tax,
         CASE WHEN readable THEN remarks END AS remarks
  FROM doc
),
gold AS (
  SELECT h.doc_id, i.pos, sha256('{"doc_id":"' || h.doc_id || '","pos":' || i.pos || '}') AS id,
         issue_date, billing_name, supplier_zip, supplier_address, supplier_company,
         supplier_department, item_name, qty AS item_qty, unit AS item_unit_price,
         amount AS item_amount, subtotal, consumption_tax, total_amount_with_tax, remarks
  FROM header h JOIN item i ON h.k = i.k AND h.sheet = i.sheet WHERE readable
)
"""

_FLAT = """issue_date, billing_name, supplier_zip, supplier_address, supplier_company,
  supplier_department, item_name, item_qty, item_unit_price, item_amount, subtotal,
  consumption_tax, total_amount_with_tax, remarks"""

_OUTER = """SELECT h.doc_id, CAST(g.pos AS INTEGER) AS pos,
              sha256('{"doc_id":"' || h.doc_id || '","pos":' || coalesce(CAST(g.pos AS VARCHAR), 'null')
                     || '}') AS id, h.issue_date, h.billing_name,
              h.supplier_zip, h.supplier_address, h.supplier_company, h.supplier_department,
              g.item_name, g.item_qty, g.item_unit_price, g.item_amount, h.subtotal,
              h.consumption_tax, h.total_amount_with_tax, h.remarks
            FROM header h LEFT JOIN gold g ON h.doc_id = g.doc_id"""

_VIOLATION = """
violation AS (
  SELECT doc_id, 'required' AS rule, 'supplier.zip_code' AS field, CAST(NULL AS INTEGER) AS pos,
         CAST(NULL AS VARCHAR) AS observed
  FROM doc WHERE readable AND zip_missing
  UNION ALL
  SELECT doc_id, 'type', 'subtotal', NULL, '"' || format('{:,}', true_subtotal) || '"'
  FROM doc WHERE readable AND commas
  UNION ALL
  SELECT doc_id, 'not_null', 'supplier', NULL, 'null' FROM doc WHERE readable AND NOT has_lines
  UNION ALL
  SELECT doc_id, 'not_blank', 'supplier.company_name', NULL, '""'
  FROM doc WHERE readable AND supplier_company = ''
  UNION ALL
  SELECT doc_id, 'format', 'issue_date', NULL, '"' || issue_date || '"'
  FROM doc WHERE readable AND k % 79 = 3
  UNION ALL
  SELECT doc_id, 'format', 'supplier.zip_code', NULL, '"' || supplier_zip || '"'
  FROM doc WHERE readable AND k % 73 = 4 AND supplier_zip IS NOT NULL
  UNION ALL
  SELECT doc_id, 'line_amount', 'details[].item_amount', 0, CAST(amount AS VARCHAR)
  FROM doc JOIN item USING (k, sheet) WHERE readable AND pos = 0 AND k % 67 = 6
  UNION ALL
  SELECT doc_id, 'subtotal', 'subtotal', NULL, CAST(true_subtotal AS VARCHAR)
  FROM doc WHERE readable AND has_lines AND k % 67 = 6 AND NOT commas
  UNION ALL
  SELECT doc_id, 'total', 'total_amount', NULL, CAST(total AS VARCHAR)
  FROM doc WHERE readable AND k % 83 = 2 AND NOT commas
)
"""


def _receipts(select: str) -> str:
    return f"WITH {_LINES} {select}"


def _violations(*rules: str) -> str:
    named = ", ".join(f"'{r}'" for r in rules)
    return f"WITH {_LINES}, {_VIOLATION} SELECT * FROM violation WHERE rule IN ({named})"


_TYPED = """SELECT h.doc_id, t.text AS input, issue_date, billing_name, supplier_company,
  CASE WHEN readable THEN CAST(n_lines AS INTEGER) END AS n_details,
  total_amount_with_tax AS total_amount,
  CASE WHEN NOT readable THEN 'NO_FIELDS_FOUND' END AS error
  FROM header h JOIN text t ON h.doc_id = t.doc_id"""

# Page text: the steps of the page reader, inside out.
_PAGE_STEPS = (
    ("(?s)<!--.*?-->", ""),
    ("(?is)<script[^>]*>.*?</script>", ""),
    ("(?is)<style[^>]*>.*?</style>", ""),
    ("(?i)</?(?:p|div|br|hr|h[1-6]|[uo]l|li|table|tr|td|th|nav|article|section|header|footer"
     "|main|html|head|body|title)(?:[ \\t\\r\\n][^>]*)?/?>", "\n"),
    ("<[^>]*>", ""),
)
_REFERENCES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
               ("&amp;", "&"))


def _page_text() -> str:
    text = "html"
    for pattern, by in _PAGE_STEPS:
        by = "chr(10)" if by == "\n" else "''"
        text = f"regexp_replace({text}, '{pattern}', {by}, 'g')"
    for reference, character in _REFERENCES:
        text = f"replace({text}, '{reference}', '{character}')"
    text = f"regexp_replace({text}, '[ \\t\\r]+', ' ', 'g')"
    text = f"regexp_replace({text}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"SELECT page_id, trim({text}, ' ' || chr(10)) AS text FROM pages"


def _stated(pattern: str, name: str) -> str:
    blanks = "' ' || chr(9) || chr(10) || chr(13)"
    return f"nullif(trim(regexp_extract(html, '{pattern}', 1), {blanks}), '') AS {name}"


def _dictionary() -> str:
    # The comments have to read as given.
    columns = [
        ("id", "string", "自動採番したユニークID"),
        ("issue_date", "string", "発行日"),
        ("billing_name", "string", "請求先名"),
        ("supplier_zip", "string", "請求元 郵便番号"),
        ("supplier_address", "string", "請求元 住所"),
        ("supplier_company", "string", "請求元 企業名"),
        ("supplier_department", "string", "請求元 部署名"),
        ("item_name", "string", "明細 商品名"),
        ("item_qty", "bigint", "明細 数量"),
        ("item_unit_price", "bigint", "明細 単価"),
        ("item_amount", "bigint", "明細 金額"),
        ("subtotal", "bigint", "小計（税抜）"),
        ("consumption_tax", "bigint", "消費税金額"),
        ("total_amount_with_tax", "bigint", "合計金額（税込）"),
        ("remarks", "string", "備考"),
    ]
    return _receipts(
        " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS position, '{name}' AS column_name, "
            f"'{kind}' AS data_type, '{comment}' AS comment, count(*) AS n_rows, "
            f"count(*) - count({name}) AS n_nulls FROM gold"
            for i, (name, kind, comment) in enumerate(columns, 1)
        )
    )


def _summary() -> str:
    rules = ("required", "type", "not_null", "not_blank", "format", "line_amount", "subtotal", "total")
    names = ", ".join(f"('{r}')" for r in rules)
    return f"""WITH {_LINES}, {_VIOLATION},
      checked AS (SELECT count(*) AS n FROM doc WHERE readable),
      per_rule AS (SELECT rule, count(DISTINCT doc_id) AS failed, count(*) AS found
                   FROM violation GROUP BY rule)
      SELECT r.rule, n AS documents_checked, coalesce(failed, 0) AS documents_failed,
             coalesce(found, 0) AS violations,
             round(coalesce(failed, 0) / n, 6) AS failure_rate
      FROM (VALUES {names}) r(rule) CROSS JOIN checked LEFT JOIN per_rule p ON r.rule = p.rule"""


def _not_null_counts() -> str:
    names = ("id", "issue_date", "supplier_zip", "subtotal")
    return _receipts(
        " UNION ALL ".join(
            f"SELECT '{n}' AS column_name, count(*) AS n_rows, count(*) - count({n}) AS n_nulls "
            "FROM gold"
            for n in names
        )
    )


def _key_check() -> str:
    columns = ("id", "issue_date", "item_name", "subtotal")
    nulls = " UNION ALL ".join(
        f"SELECT 'null {c}' AS problem, count(*) AS n_rows, count(*) - count({c}) AS n_bad FROM o"
        for c in columns
    )
    return f"""WITH {_LINES}, o AS ({_OUTER}) {nulls} UNION ALL
      SELECT 'repeated id', count(*), count(*) - count(DISTINCT id) FROM o"""


def _inferred() -> str:
    fixed = {
        "billing_name": "STRING", "consumption_tax": "BIGINT", "details": "ARRAY",
        "details[].item_amount": "BIGINT", "details[].item_name": "STRING",
        "details[].item_quantity": "BIGINT", "details[].item_unit_price": "BIGINT",
        "issue_date": "STRING", "remarks": "STRING", "supplier": "OBJECT",
        "supplier.address": "STRING", "supplier.company_name": "STRING",
        "supplier.department_name": "VOID", "supplier.zip_code": "STRING",
        "total_amount": "BIGINT",
    }
    rows = ", ".join(f"('{path}', '{kind}')" for path, kind in fixed.items())
    return f"""WITH {_LINES}
      SELECT DISTINCT key AS path,
             CASE json_type(props, '$.' || key) WHEN 'UBIGINT' THEN 'BIGINT'
                  WHEN 'VARCHAR' THEN 'STRING' ELSE json_type(props, '$.' || key) END AS type,
             'events' AS source
      FROM (SELECT props, unnest(json_keys(props)) AS key FROM events)
      UNION ALL
      SELECT path, type, 'receipts' FROM (VALUES {rows}) f(path, type)
      UNION ALL
      SELECT 'subtotal',
             CASE WHEN bool_or(commas) AND NOT bool_and(commas) THEN 'VARIANT'
                  WHEN bool_or(commas) THEN 'STRING' ELSE 'BIGINT' END, 'receipts'
      FROM doc WHERE readable"""


_TOPK = """
        WITH part AS (
          SELECT label, i AS dim, avg(CAST(embedding[i] AS DOUBLE)) AS x
          FROM embeddings, range(1, 65) r(i) WHERE embedding IS NOT NULL GROUP BY label, i),
        centre AS (SELECT label, list(x ORDER BY dim) AS q FROM part GROUP BY label),
        scored AS (
          SELECT centre.label, vec_id,
                 round(list_cosine_similarity(q, CAST(embedding AS DOUBLE[])), 10) AS s
          FROM centre, embeddings WHERE embedding IS NOT NULL),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id) AS rank
          FROM scored)
        SELECT CAST(label AS BIGINT) AS label, vec_id, round(s, 6) AS score,
               CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 10"""

_WORD_WEIGHTS = r"""
        WITH token AS (
          SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '\s+'),
                                            lambda w: w <> '')) AS w
          FROM documents),
        counted AS (
          SELECT doc_id, CAST(('0x' || substr(md5(w), 1, 8)) AS BIGINT) % {dims} AS bucket,
                 count(*) AS n
          FROM token GROUP BY ALL),
        frequency AS (SELECT bucket, count(*) AS f FROM counted GROUP BY bucket),
        total AS (SELECT count(*) AS docs FROM documents),
        weighed AS (
          SELECT doc_id, bucket, n * ln((docs + 1) / (f + 1)) AS w
          FROM counted JOIN frequency USING (bucket) CROSS JOIN total),
        norm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY doc_id)
"""


# Order lines as records: up to three charges, two of them with up to three steps.
_CHARGES = """
        WITH charge AS (
          SELECT l_orderkey, l_linenumber, l_partkey AS part,
                 list_filter([l_suppkey, l_suppkey + 1, l_suppkey + 2], lambda x: x % 5 <> 0) AS steps,
                 CAST(unnest(range(0, l_linenumber % 3 + 1)) AS INTEGER) AS i
          FROM lineitem WHERE l_linenumber % 7 <> 3),
        step AS (
          SELECT *, unnest(steps) AS "at", CAST(unnest(range(0, len(steps))) AS INTEGER) AS j
          FROM charge WHERE i <> 1)"""

EXPECTED: dict[str, str] = {
    "gold_nested": _CHARGES
    + """
        SELECT l_orderkey, l_linenumber, i || '.' || j AS pos,
               sha256('{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber
                      || ',"pos":[' || i || ',' || j || ']}') AS id,
               part, 'c' || i AS kind, "at"
        FROM step""",
    "inferred_paths": _CHARGES
    + """,
        counted AS (
          SELECT count(*) AS n, count_if(l_linenumber % 7 <> 3) AS listed,
                 count_if(l_returnflag IS NULL) + count_if(l_linestatus IS NULL) AS no_flag,
                 (SELECT count(*) FROM charge) AS charges,
                 (SELECT count(*) FROM charge WHERE i <> 1) AS stepped,
                 (SELECT count(*) FROM step) AS steps
          FROM lineitem),
        paths(path, parents, present, nulls, kinds, element) AS (
          SELECT '$', n, n, 0, 'object', false FROM counted
          UNION ALL SELECT 'part', n, n, 0, 'integer', false FROM counted
          UNION ALL SELECT 'charges', n, listed, 0, 'array', false FROM counted
          UNION ALL SELECT 'charges[]', listed, charges, 0, 'object', true FROM counted
          UNION ALL SELECT 'charges[].kind', charges, charges, 0, 'string', false FROM counted
          UNION ALL SELECT 'charges[].steps', charges, stepped, 0, 'array', false FROM counted
          UNION ALL SELECT 'charges[].steps[]', stepped, steps, 0, 'object', true FROM counted
          UNION ALL SELECT 'charges[].steps[].at', steps, steps, 0, 'integer', false FROM counted
          UNION ALL SELECT 'flags', n, n, 0, 'array', false FROM counted
          UNION ALL SELECT 'flags[]', n, 3 * n, n + no_flag, 'string', true FROM counted)
        SELECT path, CAST(parents AS BIGINT) AS parents, CAST(present AS BIGINT) AS present,
               CAST(nulls AS BIGINT) AS nulls, kinds,
               element OR present = parents AS required, nulls > 0 AS nullable
        FROM paths WHERE present > 0""",
    "check_nested": _CHARGES
    + """,
        flag AS (
          SELECT l_orderkey, l_linenumber, unnest(range(0, 3)) AS i,
                 unnest([l_returnflag, NULL, l_linestatus]) AS f
          FROM lineitem)
        SELECT l_orderkey, l_linenumber, 'required' AS rule, 'charges' AS field, NULL AS pos,
               NULL AS observed
        FROM lineitem WHERE l_linenumber % 7 = 3
        UNION ALL
        SELECT l_orderkey, l_linenumber, 'required', 'charges[].steps', CAST(i AS VARCHAR), NULL
        FROM charge WHERE i = 1
        UNION ALL
        SELECT l_orderkey, l_linenumber, 'choice', 'charges[].kind', CAST(i AS VARCHAR),
               '"c' || i || '"'
        FROM charge WHERE i NOT IN (0, 1)
        UNION ALL
        SELECT l_orderkey, l_linenumber, 'type', 'charges[].steps[].at', i || '.' || j,
               '"' || "at" || '"'
        FROM step WHERE "at" % 10 = 1
        UNION ALL
        SELECT l_orderkey, l_linenumber, CASE WHEN f IS NULL THEN 'not_null' ELSE 'choice' END,
               'flags[]', CAST(i AS VARCHAR), CASE WHEN f IS NULL THEN 'null' ELSE '"' || f || '"' END
        FROM flag WHERE f IS NULL OR f NOT IN ('A', 'F', 'N', 'O')""",
    "bronze_receipts": _receipts("SELECT doc_id, text FROM text"),
    "bronze_pages_text": _page_text(),
    "file_ranges": """
        SELECT coalesce(lang, 'none') AS lang,
               CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS n_bytes,
               CAST(coalesce(sum(length(text) - length(replace(text, chr(10), ''))), 0) + count(*) AS BIGINT) AS n_line_ends
        FROM documents GROUP BY 1""",
    "silver_extract": _receipts(_TYPED),
    "silver_callable": _receipts(_TYPED),
    "silver_distinct_texts": _receipts(_TYPED),
    "silver_resumed": _receipts(_TYPED),
    "silver_sql": _receipts(_TYPED),
    "preview_extract": _receipts(f"{_TYPED} ORDER BY h.doc_id LIMIT 10"),
    "lateral_alias": """SELECT doc_id, "text" AS input, CAST(length(input) AS INTEGER) AS n_input
        FROM documents""",
    "silver_roundtrip": _receipts(
        """SELECT d.doc_id, CASE WHEN readable THEN issue_date END AS issue_date,
             CASE WHEN readable THEN supplier_zip END AS supplier_zip,
             CASE WHEN readable THEN item_name END AS first_item,
             CASE WHEN NOT readable THEN NULL WHEN commas THEN format('{:,}', true_subtotal)
                  ELSE CAST(true_subtotal AS VARCHAR) END AS subtotal
           FROM doc d LEFT JOIN item i ON d.k = i.k AND d.sheet = i.sheet AND i.pos = 0"""
    ),
    "silver_paths": _receipts(
        """SELECT doc_id, issue_date, supplier_zip AS supplier_zip_code,
             total_amount_with_tax AS total_amount
           FROM header WHERE total_amount_with_tax >= 200000"""
    ),
    "error_summary": _receipts(
        """SELECT CASE WHEN NOT readable THEN 'NO_FIELDS_FOUND' WHEN has_lines THEN 'flattened'
             ELSE 'no_lines' END AS outcome, count(*) AS documents FROM doc GROUP BY 1"""
    ),
    "pages_extract": "SELECT page_id, CAST(NULL AS VARCHAR) AS error, "
    + ", ".join(
        (
            _stated("(?is)<title[^>]*>(.*?)</title>", "title"),
            _stated('(?i)<html[^>]* lang="([^"]*)"', "lang"),
            _stated("(?is)<h1[^>]*>(.*?)</h1>", "heading"),
        )
    )
    + " FROM pages",
    "gold_flatten": _receipts(f"SELECT id, {_FLAT} FROM gold"),
    "gold_flatten_outer": _receipts(_OUTER),
    "gold_flatten_variant": _receipts(
        f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, id, {_FLAT} FROM gold"
    ),
    "gold_exact_numbers": _receipts(
        f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, id, {_FLAT} FROM gold"
    ),
    "gold_documents": _receipts(
        """SELECT doc_id, issue_date, billing_name, supplier_zip, supplier_address,
             supplier_company, supplier_department, subtotal, consumption_tax,
             total_amount_with_tax, remarks,
             CASE WHEN readable THEN CAST(n_lines AS INTEGER) END AS line_count FROM header"""
    ),
    "parse_rejects": _receipts(
        """SELECT doc_id, CAST(NULL AS BIGINT) AS subtotal, total AS total_amount,
             format('{:,}', true_subtotal) AS printed_subtotal FROM doc WHERE readable AND commas"""
    ),
    "check_required": _violations("required"),
    "check_types": _violations("type"),
    "check_not_null": _violations("not_null", "not_blank"),
    "check_formats": _violations("format"),
    "check_line_amount": _violations("line_amount"),
    "check_totals": _violations("subtotal", "total"),
    "check_summary": _summary(),
    "gold_watched_summary": _summary(),
    "key_violations": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "key_clashes": """SELECT l_orderkey, l_linenumber FROM lineitem
        WHERE l_shipdate >= DATE '1998-01-01'
        INTERSECT SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate < DATE '1998-01-01'""",
    "not_null_counts": _not_null_counts(),
    "gold_dictionary": _dictionary(),
    "gold_key_check": _key_check(),
    "inferred_schema": _inferred(),
    "page_manifest": r"""
        WITH named AS (
          SELECT page_id, strlen(html) AS length,
                 nullif(regexp_extract(regexp_replace(url, '[?#].*$', ''), '[^/]*$'), '') AS name
          FROM pages)
        SELECT page_id, name, CAST(length AS BIGINT) AS length,
               CASE WHEN name IS NOT NULL THEN count(*) OVER (PARTITION BY name) END AS same_name
        FROM named""",
    "check_element_types": """
        WITH line AS (
          SELECT l_orderkey, l_partkey,
                 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
                                    l_suppkey, CAST(l_quantity AS BIGINT)) - 1 AS pos
          FROM lineitem)
        SELECT l_orderkey AS order_id, 'type' AS rule, 'lines[]' AS field,
               CAST(pos AS INTEGER) AS pos,
               CASE WHEN l_partkey % 101 = 5 THEN '"loose"' ELSE '[7]' END AS observed
        FROM line WHERE l_partkey % 101 = 5 OR l_partkey % 103 = 6
        UNION ALL
        SELECT l_orderkey, 'type', 'lines[].part', CAST(pos AS INTEGER),
               '"' || l_partkey || '"'
        FROM line WHERE l_partkey % 107 = 7 AND NOT (l_partkey % 101 = 5 OR l_partkey % 103 = 6)""",
    "silver_concurrent": _receipts(_TYPED),
    "embed_documents": _WORD_WEIGHTS.format(dims=256)
    + """
        SELECT doc_id, CAST(bucket AS INTEGER) AS bucket, round(w / norm, 6) AS weight
        FROM weighed JOIN norm USING (doc_id) WHERE w > 0""",
    "document_neighbours": _WORD_WEIGHTS.format(dims=64)
    + """,
        rounded AS (
          SELECT doc_id, bucket, round(w / norm, 6) AS weight
          FROM weighed JOIN norm USING (doc_id) WHERE w > 0),
        texts AS (SELECT DISTINCT doc_id FROM rounded WHERE weight > 0),
        vector AS (
          SELECT doc_id, list(coalesce(weight, 0) ORDER BY bucket) AS v
          FROM (SELECT doc_id, bucket FROM texts, range(64) r(bucket))
          LEFT JOIN rounded USING (doc_id, bucket) GROUP BY doc_id),
        scored AS (
          SELECT q.doc_id AS query_id, b.doc_id AS vec_id,
                 round(list_cosine_similarity(q.v, b.v), 10) AS s
          FROM vector q, vector b WHERE q.doc_id % 50 = 0),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank
          FROM scored)
        SELECT query_id, vec_id, round(s, 6) AS score, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE rank <= 5""",
    "vector_topk": _TOPK,
    "vector_index_topk": _TOPK,
}
