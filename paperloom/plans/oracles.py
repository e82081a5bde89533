"""DuckDB SQL that computes each query's rows afresh from the tables."""

from __future__ import annotations

AS_OF = "1998-12-01"

_ITEMS = """
raw AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS line_no FROM lineitem
), base AS (
  SELECT l_orderkey AS doc_id, CAST(line_no AS INTEGER) AS line_no, l_partkey AS part, l_orderkey + line_no AS k,
    CAST(l_quantity AS DECIMAL(12,2)) AS q, CAST(l_extendedprice AS DECIMAL(14,2)) AS p, CAST(l_discount * 100 AS DECIMAL(6,2)) AS percent FROM raw
), priced AS (
  SELECT *, CAST(CASE WHEN k % 5 = 0 THEN CAST(q * p AS DECIMAL(18,4)) * CAST(100 - percent AS DECIMAL(6,2)) * CAST(0.01 AS DECIMAL(3,2))
    WHEN k % 5 = 1 THEN q * p - 10 ELSE q * p END AS DECIMAL(18,4)) AS expected0 FROM base
), items AS (
  SELECT doc_id, line_no, part, 'Part ' || part AS description,
    CASE WHEN k % 7 = 0 THEN '12A4' WHEN k % 7 = 3 THEN lpad(CAST(part % 1000000 AS VARCHAR), 6, '0') WHEN k % 7 <> 1 THEN lpad(CAST(part % 10000 AS VARCHAR), 4, '0') END AS hsn_code,
    CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN 'n/a' ELSE CAST(q AS VARCHAR) END AS quantity,
    CASE WHEN k % 3 = 0 THEN '₹ ' ELSE '' END || CAST(p AS VARCHAR) AS unit_price,
    CASE WHEN k % 103 <> 0 THEN CAST(CAST(expected0 + CAST([0, 0.005, 0.006, 0.01, 0.011, 1][k % 6 + 1] AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS VARCHAR) END AS total_amount,
    CASE WHEN k % 101 = 0 THEN 'abc' WHEN k % 5 = 0 THEN CAST(percent AS VARCHAR) WHEN k % 5 = 1 THEN '10.00' ELSE '0' END AS discount,
    CASE WHEN k % 5 = 0 THEN 'percentage' ELSE 'amount' END AS discount_type,
    CASE WHEN k % 107 <> 0 THEN CAST([0, 5, 12, 18, 28][part % 5 + 1] AS VARCHAR) END AS gst_rate
  FROM priced
), read AS (
  SELECT *, TRY_CAST(regexp_replace(quantity, '[₹,$\\s]', '', 'g') AS DECIMAL(12,2)) AS q, TRY_CAST(regexp_replace(unit_price, '[₹,$\\s]', '', 'g') AS DECIMAL(14,2)) AS p,
    TRY_CAST(total_amount AS DECIMAL(18,4)) AS t, TRY_CAST(discount AS DECIMAL(6,2)) AS d, TRY_CAST(gst_rate AS DECIMAL(4,0)) AS r FROM items
)"""

_HEADERS = """
headers AS (
  SELECT o_orderkey AS doc_id, o_custkey AS customer, CAST(o_orderdate AS DATE) AS day, lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') AS four,
    CASE WHEN o_orderkey % 11 = 0 THEN 'inv?' ELSE 'INV-' END || strftime(o_orderdate, '%Y') || '-' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') AS invoice_number,
    CASE WHEN o_orderkey % 29 = 0 THEN '2024-15-05' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS invoice_date,
    strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 - 10 AS INTEGER), '%Y-%m-%d') AS due_date,
    lpad(CAST(o_custkey % 37 + 1 AS VARCHAR), 2, '0') || 'ABCDE' || lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') || 'F1' || CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE 'Z' END || '5' AS gst_number,
    'ABCDE' || lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') || CASE WHEN o_orderkey % 13 = 0 THEN '9' ELSE 'F' END AS pan_number,
    CASE WHEN o_orderkey % 17 = 0 THEN '012345' ELSE CAST(o_custkey % 900000 + 100000 AS VARCHAR) END AS pincode,
    CASE WHEN o_orderkey % 19 = 0 THEN '12345' ELSE '9' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS phone,
    CASE WHEN o_orderkey % 23 = 0 THEN 'no mail' ELSE 'user' || o_custkey || '@example.com' END AS email,
    'PO-' || o_custkey AS po_number
  FROM orders
)"""

_INVOICES = f"""{_ITEMS}, {_HEADERS}, sums AS (
  SELECT doc_id, sum(t) AS s, sum(CAST(t * r * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(20,6))) AS g, sum(CASE WHEN t IS NULL THEN 1 ELSE 0 END) AS unread FROM read GROUP BY doc_id
), inv0 AS (
  SELECT h.*, coalesce(s, 0) AS s, coalesce(g, 0) AS g, coalesce(unread, 0) AS unread,
    CAST(coalesce(s, 0) + CAST([0, 0.005, 0.006, 0.01, 0.011, 1][doc_id % 6 + 1] AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS sub,
    CAST(CASE WHEN doc_id % 4 = 0 THEN 50 ELSE 0 END AS DECIMAL(18,4)) AS disc,
    CAST(coalesce(g, 0) + CASE WHEN doc_id % 9 = 0 THEN 2.5 ELSE 0 END AS DECIMAL(18,4)) AS gst
  FROM headers h LEFT JOIN sums USING (doc_id)
), inv AS (
  SELECT *, CASE WHEN doc_id % 31 <> 0 THEN sub END AS subtotal,
    CAST(sub - disc + gst + CAST([0, 0.005, 0.006, 0.01, 0.011, 1][doc_id // 6 % 6 + 1] AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS final FROM inv0
)"""

_CHECKED = """
checked0 AS (
  SELECT *, q IS NOT NULL AND p IS NOT NULL AS known,
    CASE WHEN q IS NULL OR p IS NULL OR d IS NULL THEN NULL WHEN d <= 0 THEN CAST(q * p AS DECIMAL(18,4))
      WHEN discount_type = 'percentage' THEN CAST(CAST(q * p AS DECIMAL(18,4)) * CAST(100 - d AS DECIMAL(6,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4))
      ELSE CAST(q * p - d AS DECIMAL(18,4)) END AS expected FROM read
), checked AS (
  SELECT *, abs(expected - t) AS difference,
    CASE WHEN abs(expected - t) > 0.01 THEN 1 ELSE 0 END + CASE WHEN known AND d IS NULL THEN 1 ELSE 0 END AS n_errors,
    CASE WHEN abs(expected - t) > 0.005 AND abs(expected - t) <= 0.01 THEN 1 ELSE 0 END + CASE WHEN NOT known THEN 1 ELSE 0 END
      + CASE WHEN known AND d IS NOT NULL AND t IS NULL THEN 1 ELSE 0 END + CASE WHEN NOT regexp_full_match(hsn_code, '[0-9]{4}|[0-9]{6}|[0-9]{8}') THEN 1 ELSE 0 END AS n_warnings
  FROM checked0
)"""

_FORMATS = f"""
formats0 AS (
  SELECT doc_id, TRY_STRPTIME(invoice_date, '%Y-%m-%d') AS a, TRY_STRPTIME(due_date, '%Y-%m-%d') AS b, subtotal, final, gst,
    CASE WHEN regexp_full_match(invoice_number, '[A-Z0-9\\-/]{{3,20}}') THEN 0 ELSE 1 END
    + CASE WHEN regexp_full_match(gst_number, '[0-9]{{2}}[A-Z]{{5}}[0-9]{{4}}[A-Z][1-9A-Z]Z[0-9A-Z]') THEN 0 ELSE 1 END
    + CASE WHEN regexp_full_match(pan_number, '[A-Z]{{5}}[0-9]{{4}}[A-Z]') THEN 0 ELSE 1 END + CASE WHEN regexp_full_match(pincode, '[1-9][0-9]{{5}}') THEN 0 ELSE 1 END
    + CASE WHEN regexp_full_match(phone, '[6-9][0-9]{{9}}') THEN 0 ELSE 1 END
    + CASE WHEN regexp_full_match(email, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}') THEN 0 ELSE 1 END AS wrong
  FROM inv
), formats AS (
  SELECT doc_id, wrong + CASE WHEN a IS NULL OR b IS NULL THEN 1 ELSE 0 END AS n_errors,
    CASE WHEN b < a THEN 1 ELSE 0 END + CASE WHEN a > DATE '{AS_OF}' + 30 AND b IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN a < DATE '{AS_OF}' - 3650 AND b IS NOT NULL THEN 1 ELSE 0 END
    + CASE WHEN subtotal < 0 THEN 1 ELSE 0 END + CASE WHEN final < 0 THEN 1 ELSE 0 END + CASE WHEN gst < 0 THEN 1 ELSE 0 END
    + CASE WHEN final > 0 AND final < subtotal * 0.5 THEN 1 ELSE 0 END AS n_warnings FROM formats0
)"""

_SUBTOTAL = """
subtotals AS (
  SELECT doc_id, s AS calculated, subtotal AS extracted, abs(s - subtotal) AS difference,
    CASE WHEN abs(s - subtotal) > 0.01 THEN 1 ELSE 0 END AS n_errors,
    unread + CASE WHEN abs(s - subtotal) > 0.005 AND abs(s - subtotal) <= 0.01 THEN 1 ELSE 0 END + CASE WHEN subtotal IS NULL THEN 1 ELSE 0 END AS n_warnings FROM inv
)"""

_FINAL = """
finals AS (
  SELECT doc_id, coalesce(subtotal, 0) - disc + gst AS calculated, final AS extracted, abs(coalesce(subtotal, 0) - disc + gst - final) AS difference FROM inv
), finalchecks AS (
  SELECT *, CASE WHEN difference > 0.01 THEN 1 ELSE 0 END AS n_errors, CASE WHEN difference > 0.005 AND difference <= 0.01 THEN 1 ELSE 0 END AS n_warnings FROM finals
)"""

_CHECKS = f"""{_INVOICES}, {_CHECKED}, {_FORMATS}, {_SUBTOTAL}, {_FINAL}, itemchecks AS (
  SELECT doc_id, sum(n_errors) AS n_errors, sum(n_warnings) AS n_warnings FROM checked GROUP BY doc_id
), checks AS (
  SELECT doc_id, 'line_items' AS name, coalesce(n_errors, 0) AS n_errors, coalesce(n_warnings, 0) AS n_warnings FROM inv LEFT JOIN itemchecks USING (doc_id)
  UNION ALL SELECT doc_id, 'subtotal', n_errors, n_warnings FROM subtotals
  UNION ALL SELECT doc_id, 'final_total', n_errors, n_warnings FROM finalchecks
  UNION ALL SELECT doc_id, 'formats', n_errors, n_warnings FROM formats
  UNION ALL SELECT doc_id, 'gst', CASE WHEN abs(g - gst) > 0.01 THEN 1 ELSE 0 END, 0 FROM inv
), flags0 AS (
  SELECT doc_id, CAST(sum(n_errors) AS BIGINT) AS n_errors, CAST(sum(n_warnings) AS BIGINT) AS n_warnings, count(*) AS n_checks, count(*) FILTER (n_errors = 0) AS n_passed,
    bool_and(n_errors = 0) FILTER (name = 'line_items') AS line_items_valid, bool_and(n_errors = 0) FILTER (name = 'final_total') AS calculations_valid,
    bool_and(n_errors = 0) FILTER (name = 'formats') AS formats_valid, bool_and(n_errors = 0) FILTER (name = 'gst') AS gst_valid
  FROM checks GROUP BY doc_id
), flags AS (
  SELECT *, round(greatest(CAST(0 AS DOUBLE), CAST(n_passed AS DOUBLE) / n_checks - least(n_errors * CAST(0.1 AS DOUBLE), CAST(0.5 AS DOUBLE)) - least(n_warnings * CAST(0.02 AS DOUBLE), CAST(0.2 AS DOUBLE))), 6) AS confidence_score,
    CASE WHEN n_errors = 0 AND n_warnings = 0 THEN 'valid' WHEN n_errors = 0 AND n_warnings <= 3 THEN 'valid_with_warnings' WHEN n_errors = 0 THEN 'questionable' WHEN n_errors <= 2 THEN 'invalid_minor' ELSE 'invalid_major' END AS overall_status,
    CASE WHEN n_errors = 0 AND n_warnings = 0 THEN 'approved' WHEN n_errors = 0 AND n_warnings <= 3 THEN 'approved_with_review' WHEN n_errors <= 2 THEN 'manual_review_required' ELSE 'rejected' END AS recommendation
  FROM flags0
)"""

_TEXTS = f"""{_HEADERS}, dated AS (
  SELECT *, CASE doc_id % 5 WHEN 0 THEN strftime(day, '%d/%m/%Y') WHEN 1 THEN strftime(day, '%m/%d/%Y') WHEN 2 THEN strftime(day, '%d-%m-%y')
    WHEN 3 THEN strftime(day, '%d %b %Y') ELSE strftime(day, '%B %d, %Y') END AS date_text FROM headers
), texts AS (
  SELECT doc_id, date_text, email, phone, pincode, array_to_string(['TAX INVOICE',
    CASE WHEN doc_id % 3 = 0 THEN 'Bill No: ' ELSE 'Invoice Number: ' END || invoice_number, 'Date: ' || date_text, 'GSTIN: ' || gst_number, 'PO Number: ' || po_number,
    CASE WHEN doc_id % 4 = 1 THEN 'Ship To: ' ELSE 'Bill To:' END, 'Customer ' || customer, '  ' || customer || ' Main Street',
    CASE WHEN doc_id % 2 = 0 THEN 'Phone: ' || phone ELSE 'City ' || pincode END,
    CASE WHEN doc_id % 8 = 0 THEN 'Net Amount: Rs. ' ELSE 'Grand Total: ₹' END || customer || ',' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') || '.50'], chr(10)) AS text FROM dated
)"""


def _all(text: str, patterns: tuple[str, ...]) -> str:
    return "list_concat(" + ", ".join(f"regexp_extract_all({text}, '{p}', 1)" for p in patterns) + ")"


def _iso(s: str) -> str:
    """A date as ISO text; formats of four-digit years are guarded, since they accept two digits too."""
    s = f"regexp_replace(trim({s}), '\\s+', ' ', 'g')"
    parts = []
    for sep in "/-":
        for y, digits in (("Y", 4), ("y", 2)):
            form = f"[0-9]{{1,2}}{sep}[0-9]{{1,2}}{sep}[0-9]{{{digits}}}"
            both = ", ".join(f"try_strptime({s}, '%{a}{sep}%{b}{sep}%{y}')" for a, b in (("d", "m"), ("m", "d")))
            parts.append(f"CASE WHEN regexp_full_match({s}, '{form}') THEN coalesce({both}) END")
    named = ", ".join(f"try_strptime({s}, '{f}')" for f in ("%d %B %Y", "%d %b %Y", "%B %d, %Y", "%b %d, %Y"))
    return f"strftime(coalesce({', '.join(parts)}, CASE WHEN regexp_matches({s}, '[0-9]{{4}}$') THEN coalesce({named}) END), '%Y-%m-%d')"


def _first(items: str) -> str:
    return f"list_filter({items}, lambda x: x IS NOT NULL)[1]"


# The patterns, written out for RE2 on their own, so that a wrong one in the library shows.
_ENDS = "phone|tel|mobile|email|website|gstin|gst|invoice|bill|date|po number|order"
_STARTS = "ship to|shipping address|deliver to|delivery address|bill to|billing address|address|consignee"
_DMY, _DMON = "[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{2,4}", "[0-9]{1,2}\\s+(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[\\p{L}\\p{N}_]*\\s+[0-9]{2,4}"
_AFTER = {  # a field's labels, in order; what follows each label is the field
    "invoice": ("invoice\\s*(?:no|number|#)", "inv\\s*(?:no|#)", "bill\\s*(?:no|number|#)", "receipt\\s*(?:no|number|#)"),
    "po": ("po\\s*(?:no|number)", "purchase\\s*order", "order\\s*(?:no|number)", "ref\\s*(?:no|number)"),
    "gst": ("GSTIN", "GST\\s*(?:NO|NUMBER)", "TAX\\s*(?:ID|NUMBER)"),
    "date": ("date", "invoice\\s*date", "bill\\s*date"),
    "amount": ("total[\\s:]*(?:amount)?[\\s:]*", "grand\\s*total[\\s:]*", "final\\s*amount[\\s:]*", "net\\s*amount[\\s:]*"),
}
_GSTIN15 = "[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][A-Z0-9]Z[A-Z0-9]"
_P_INVOICE = tuple(x + "[\\s:]*([\\p{L}\\p{N}_\\-/]+)" for x in _AFTER["invoice"])
_P_PO = tuple(x + "[\\s:]*([\\p{L}\\p{N}_\\-/]+)" for x in _AFTER["po"])
_P_GST = (*(x + f"[\\s:]*({_GSTIN15}|[A-Z0-9]{{15}})" for x in _AFTER["gst"]), f"({_GSTIN15})")
_P_DATE = (*(x + f"[\\s:]*({_DMY}|{_DMON})" for x in _AFTER["date"]), f"({_DMY})", f"({_DMON})")
_P_AMOUNT = tuple(x + "(?:rs\\.?|₹)?\\s*([0-9,]+\\.?[0-9]*)" for x in _AFTER["amount"])
_VALID_GST = "[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][A-Z0-9]Z[A-Z0-9]"
_GSTS = f"list_filter({_all('upper(text)', _P_GST)}, lambda x: regexp_full_match(x, '{_VALID_GST}'))"
_DATES = _first(f"list_transform({_all('lower(text)', _P_DATE)}, lambda s: {_iso('s')})")
_LONG = "lambda x: length(x) > 2"
_HEADER_FIELDS = f"""{_TEXTS}, cut AS (
  SELECT *, list_transform(string_split(text, chr(10)), lambda x: trim(x)) AS lines FROM texts
), start AS (
  SELECT *, coalesce(list_position(list_transform(lines, lambda x: regexp_matches(lower(x), '{_STARTS}')), true), 0) AS head FROM cut
), below AS (
  SELECT *, CASE WHEN head > 0 THEN lines[head + 1:head + 5] ELSE [] END AS own FROM start
), stops AS (
  SELECT *, coalesce(list_position(list_transform(own, lambda x: regexp_matches(lower(x), '{_ENDS}') OR length(x) < 3), true), 0) AS stop FROM below
), kept AS (
  SELECT *, CASE WHEN stop > 0 THEN own[1:stop - 1] ELSE own END AS address FROM stops
), found AS (
  SELECT doc_id, upper(list_filter({_all('lower(text)', _P_INVOICE)}, {_LONG})[1]) AS invoice_number, {_DATES} AS invoice_date,
    upper(list_filter({_all('lower(text)', _P_PO)}, {_LONG})[1]) AS po_number, list_distinct({_GSTS})[1] AS vendor_gst, CAST(NULL AS VARCHAR) AS buyer_gst,
    CASE WHEN len(address) > 0 THEN array_to_string(address, chr(10)) END AS shipping_address,
    list_filter(list_transform({_all('lower(text)', _P_AMOUNT)}, lambda x: replace(x, ',', '')), lambda x: regexp_full_match(x, '[0-9]+\\.?[0-9]*'))[1] AS final_total
  FROM kept
)"""

_FIELDS = """fields AS (
  SELECT o_orderkey AS doc_id, unnest(['invoice_number', 'invoice_date', 'vendor', 'line_items', 'totals']) AS field, unnest([(o_orderkey * 13 + i * 29) % 101 / 100 for i in [0, 1, 2, 3, 4]]) AS confidence FROM orders
)"""
_CATEGORY = "CASE WHEN confidence > 0.8 THEN 'high' WHEN confidence > 0.5 THEN 'medium' ELSE 'low' END"

_BLOCKS = f"""{_ITEMS}, cells AS (
  SELECT doc_id, line_no, [description, coalesce(hsn_code, '-'), coalesce(quantity, '-'), unit_price, coalesce(total_amount, '-')] AS c FROM items
  UNION ALL SELECT DISTINCT doc_id, 0, ['Description', 'HSN', 'Qty', 'Rate', 'Amount'] FROM items
), blocks AS (
  SELECT doc_id, line_no, col, line_no * 5 + col AS block_pos, c[col + 1] AS text, (50 + (doc_id * 7 + line_no * 11 + col * 3) % 50) / 100 AS confidence, 50 + 100 * col AS x1,
    100 + 30 * line_no + (doc_id + line_no * 3 + col * 5) % 7 AS y1, 130 + 100 * col AS x2, 120 + 30 * line_no + (doc_id + line_no * 3 + col * 5) % 7 AS y2
  FROM (SELECT *, unnest([0, 1, 2, 3, 4]) AS col FROM cells)
)"""

_OCR = f"""{_ITEMS}, words AS (
  SELECT doc_id, line_no % 2 + 1 AS page_number, line_no AS block_pos, CASE WHEN part % 4 = 0 THEN 'two words' ELSE 'w' || part END AS text, part * 7 % 101 / 100 AS confidence,
    line_no * 20 + part % 9 AS x1, line_no // 4 * 30 AS y1, line_no * 20 + part % 9 + 12 AS x2, line_no // 4 * 30 + 20 AS y2, CASE WHEN part % 2 = 0 THEN 'tesseract' ELSE 'easyocr' END AS engine FROM items
)"""

_REGIONS = f"""{_ITEMS}, regions AS (
  SELECT doc_id, line_no AS region_id, ['circular_seal', 'signature_box', 'handwritten_signature'][line_no % 3 + 1] AS type, part % 97 / 100 AS confidence, part * 37 % 900 AS x1, (part * 53 + line_no * 71) % 900 AS y1,
    part * 37 % 900 + 80 + part % 300 AS x2, (part * 53 + line_no * 71) % 900 + 80 + part % 170 AS y2 FROM items
)"""

_NUM = "coalesce(TRY_CAST(nullif(regexp_extract(regexp_replace(x, '[₹$€£, ]', '', 'g'), '([0-9]+\\.?[0-9]*)', 1), '') AS DOUBLE), 0)"
_DOUBLES = "CAST(calculated AS DOUBLE) AS calculated, CAST(extracted AS DOUBLE) AS extracted, CAST(difference AS DOUBLE) AS difference"


def sql() -> dict[str, str]:
    w = "WITH "
    parse = lambda c: f"TRY_CAST(trim(regexp_replace({c}, '[,₹$]', '', 'g')) AS DOUBLE)"
    return {
        "verify_line_items": f"{w}{_ITEMS}, {_CHECKED} SELECT doc_id, line_no, CAST(expected AS DOUBLE) AS expected, CAST(difference AS DOUBLE) AS difference, n_errors = 0 AS is_valid, n_errors, n_warnings FROM checked",
        "verify_items_by_document": f"{w}{_ITEMS}, {_CHECKED} SELECT doc_id, bool_and(n_errors = 0) AS is_valid, count(*) AS n_items, count(*) FILTER (n_errors = 0) AS n_valid, CAST(sum(n_errors) AS INTEGER) AS n_errors, CAST(sum(n_warnings) AS INTEGER) AS n_warnings FROM checked GROUP BY doc_id",
        "verify_subtotal": f"{w}{_INVOICES}, {_SUBTOTAL} SELECT doc_id, n_errors = 0 AS is_valid, n_errors, CAST(n_warnings AS INTEGER) AS n_warnings, {_DOUBLES} FROM subtotals",
        "verify_final_total": f"{w}{_INVOICES}, {_FINAL} SELECT doc_id, n_errors = 0 AS is_valid, n_errors, n_warnings, {_DOUBLES} FROM finalchecks",
        "gst_by_rate": f"{w}{_ITEMS} SELECT doc_id, CAST(r AS DOUBLE) AS gst_rate, CAST(sum(t) AS DOUBLE) AS taxable_amount, CAST(sum(CAST(t * r * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(20,6))) AS DOUBLE) AS gst_amount, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS items FROM read WHERE r IS NOT NULL AND t IS NOT NULL GROUP BY doc_id, r",
        "verify_gst": f"{w}{_INVOICES} SELECT doc_id, abs(g - gst) <= 0.01 AS is_valid, CAST(g AS DOUBLE) AS calculated, CAST(gst AS DOUBLE) AS extracted, CAST(abs(g - gst) AS DOUBLE) AS difference FROM inv",
        "gst_components": f"""{w}{_INVOICES}, c AS (
            SELECT doc_id, subtotal, 'cgst' AS component, CAST(doc_id % 2 * 9 AS DECIMAL(4,0)) AS rate, CAST(100 AS DECIMAL(18,4)) AS amount FROM inv
            UNION ALL SELECT doc_id, subtotal, 'sgst', 9, CAST(CAST(CAST(subtotal * 9 AS DECIMAL(20,4)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS DECIMAL(18,4)) FROM inv
            UNION ALL SELECT doc_id, subtotal, 'igst', 18, NULL FROM inv WHERE doc_id % 5 = 0)
            SELECT doc_id, component, CAST(CAST(subtotal * rate * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(28,6)) AS DOUBLE) AS calculated, CAST(amount AS DOUBLE) AS amount,
              abs(CAST(subtotal * rate * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(28,6)) - coalesce(amount, 0)) <= 0.01 AS check_passed FROM c""",
        "validate_formats": f"{w}{_INVOICES}, {_FORMATS} SELECT doc_id, n_errors = 0 AS is_valid, n_errors, n_warnings FROM formats",
        "verify_flags": f"{w}{_CHECKS} SELECT * FROM flags",
        "data_integrity": f"{w}{_CHECKS} SELECT doc_id, CAST(n_passed AS DOUBLE) / n_checks AS data_integrity_score FROM flags",
        "confidence_report": f"""{w}{_FIELDS}, r AS (SELECT doc_id, avg(confidence) AS m, count(*) AS n, count(*) FILTER (confidence > 0.8) AS h, count(*) FILTER (confidence > 0.5 AND confidence <= 0.8) AS md, count(*) FILTER (confidence <= 0.5) AS l,
            coalesce(string_agg(field, ',' ORDER BY field) FILTER (confidence <= 0.5), '') AS low_fields FROM fields GROUP BY doc_id)
            SELECT doc_id, round(m, 6) AS overall_confidence, n AS total_fields, h AS high_count, md AS medium_count, l AS low_count, low_fields, round(h / n * 100, 6) AS high_percentage,
              CASE WHEN round(m, 9) < 0.7 THEN 1 ELSE 0 END + CASE WHEN l > 0 THEN 1 ELSE 0 END + CASE WHEN h / n * 100 < 50 THEN 1 ELSE 0 END AS n_recommendations FROM r""",
        "confidence_categories": f"{w}{_FIELDS} SELECT field, {_CATEGORY} AS category, CASE WHEN confidence >= 0.9 THEN 'HIGH' WHEN confidence >= 0.7 THEN 'MEDIUM' WHEN confidence >= 0.5 THEN 'LOW' ELSE 'VERY_LOW' END AS grade, count(*) AS n FROM fields GROUP BY ALL",
        "ocr_confidence_join": f"{w}{_FIELDS} SELECT doc_id, field, confidence, CASE WHEN confidence >= 0.2 THEN round(1 - confidence, 2) END AS ocr_confidence, {_CATEGORY} AS category FROM fields",
        "missing_fields": f"""{w}{_HEADER_FIELDS} SELECT doc_id, array_to_string(list_filter([CASE WHEN invoice_number IS NULL THEN 'invoice_number' END, CASE WHEN invoice_date IS NULL THEN 'invoice_date' END, CASE WHEN po_number IS NULL THEN 'po_number' END,
            CASE WHEN vendor_gst IS NULL THEN 'vendor_gst' END, CASE WHEN shipping_address IS NULL THEN 'shipping_address' END, CASE WHEN final_total IS NULL THEN 'final_total' END], lambda x: x IS NOT NULL), ',') AS missing FROM found""",
        "likely_ocr_errors": f"""{w}{_ITEMS}, c AS (SELECT doc_id, line_no, unnest(['quantity', 'unit_price', 'total_amount']) AS f, unnest([(doc_id * 17 + line_no * 31 + i * 37) % 101 / 100 for i in [0, 1, 2]]) AS v FROM items)
            SELECT doc_id, line_no, string_agg(f, ',' ORDER BY f) AS low_fields FROM c WHERE v < 0.5 GROUP BY doc_id, line_no""",
        "weighted_confidence": f"""{w}{_FIELDS}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY field) AS i FROM fields)
            SELECT doc_id, round(sum(confidence * i) / sum(i), 6) AS weighted, round(greatest(0, least(1, (max(confidence) FILTER (i = 1) - 0.2) / (CAST(0.8 AS DOUBLE) - 0.2))), 6) AS normalised FROM r GROUP BY doc_id""",
        "field_confidence": f"""{w}{_HEADER_FIELDS} SELECT doc_id, CASE WHEN invoice_number IS NULL THEN NULL ELSE round(greatest(0, least(1, doc_id % 100 / 100 + CASE WHEN length(invoice_number) >= 5 THEN 0.1 WHEN length(invoice_number) <= 2 THEN -0.2 ELSE 0 END
            + CASE WHEN regexp_full_match(invoice_number, '[A-Za-z0-9\\-/]+') THEN 0.1 ELSE 0 END - CASE WHEN regexp_matches(invoice_number, '[^\\p{{L}}\\p{{N}}_\\s\\-/.,]') THEN 0.1 ELSE 0 END)), 6) END AS confidence FROM found""",
        "amounts_parsed": f"""{w}{_ITEMS} SELECT doc_id, line_no, CAST(p AS DOUBLE) AS unit_price, coalesce({parse('quantity')}, 0) AS quantity, list_transform([coalesce(hsn_code, '')], lambda x: {_NUM})[1] AS number_in_hsn,
            coalesce(regexp_full_match(hsn_code, '[0-9]{{4}}|[0-9]{{6}}|[0-9]{{8}}'), false) AS hsn_is_valid, CASE WHEN coalesce({parse('quantity')}, 0) = 0 THEN 0 ELSE coalesce({parse('total_amount')}, 0) / {parse('quantity')} END AS unit_total FROM read""",
        "extract_header": f"{w}{_HEADER_FIELDS} SELECT * FROM found",
        "extract_gst_all": f"{w}{_TEXTS}, g AS (SELECT doc_id, {_GSTS} AS l FROM texts) SELECT doc_id, CAST(i AS INTEGER) AS pos, l[i + 1] AS gst_number FROM (SELECT *, unnest(range(len(l))) AS i FROM g)",
        "normalize_date": f"{w}{_TEXTS} SELECT doc_id, {_iso('date_text')} AS iso_date FROM texts",
        "clean_text": "WITH c AS (SELECT doc_id, coalesce(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '[^\\p{L}\\p{N}_\\s.\\-()\\[\\]/\\\\:;,@#]', '', 'g'), '') AS t FROM documents) SELECT doc_id, length(t) AS n_clean, md5(t) AS digest FROM c",
        "numbers_from_text": "WITH n AS (SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[0-9]+\\.?[0-9]*'), lambda x: TRY_CAST(x AS DOUBLE)) AS l FROM documents) SELECT doc_id, len(l) AS n_numbers, list_max(l) AS largest FROM n",
        "contact_formats": f"{w}{_TEXTS} SELECT doc_id, regexp_full_match(email, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}') AS email, regexp_full_match(regexp_replace(phone, '[^0-9+]', '', 'g'), '(\\+91|91)?[0-9]{{10}}') AS phone, regexp_full_match(trim(pincode), '[0-9]{{6}}') AS pincode FROM texts",
        "near_keyword": f"{w}{_TEXTS} SELECT doc_id, substring(text, greatest(strpos(lower(text), 'gstin') - 20, 1), strpos(lower(text), 'gstin') - greatest(strpos(lower(text), 'gstin') - 20, 1) + 25) AS context FROM texts",
        "filter_by_confidence": f"{w}{_OCR} SELECT doc_id, page_number, block_pos, text, confidence FROM words WHERE confidence >= 0.8",
        "confidence_buckets": f"{w}{_OCR} SELECT doc_id, page_number, CASE WHEN confidence >= 0.9 THEN 'high' WHEN confidence >= 0.6 THEN 'medium' ELSE 'low' END AS bucket, count(*) AS n_blocks, round(avg(confidence), 6) AS average_confidence FROM words GROUP BY ALL",
        "blocks_in_region": f"{w}{_OCR}, r AS (SELECT * FROM (VALUES (0, 0, 0, 70, 25), (1, 60, 20, 130, 45)) AS v(region_id, a, b, c, d)) SELECT doc_id, page_number, region_id, block_pos, text FROM words JOIN r ON x1 < c AND x2 > a AND y1 < d AND y2 > b",
        "merge_blocks": f"""{w}{_OCR}, m AS (SELECT *, CASE WHEN x1 - max(x2) OVER (PARTITION BY doc_id, page_number, y1 ORDER BY x1, block_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 12 THEN 1 ELSE 0 END AS far FROM words),
            i AS (SELECT *, sum(far) OVER (PARTITION BY doc_id, page_number, y1 ORDER BY x1, block_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM m)
            SELECT doc_id, page_number, y1, string_agg(text, ' ' ORDER BY x1, block_pos) AS merged_text, round(avg(confidence), 6) AS mean_confidence, count(*) AS n_merged, min(x1) AS "left", min(y1) AS top, max(x2) AS "right", max(y2) AS bottom FROM i GROUP BY doc_id, page_number, y1, island""",
        "best_engine": f"""{w}{_OCR}, e AS (SELECT doc_id, page_number, engine, count(*) AS n_blocks, round(avg(confidence), 9) AS a FROM words GROUP BY ALL),
            pr AS (SELECT * FROM e WHERE engine = 'tesseract'), fb AS (SELECT * FROM e WHERE engine = 'easyocr'),
            b AS (SELECT coalesce(pr.doc_id, fb.doc_id) AS doc_id, coalesce(pr.page_number, fb.page_number) AS page_number, pr.a AS pa, fb.a AS fa, pr.n_blocks AS pn, fb.n_blocks AS fn FROM pr FULL JOIN fb ON pr.doc_id = fb.doc_id AND pr.page_number = fb.page_number),
            c AS (SELECT *, pa IS NULL OR (pa < 0.6 AND fa IS NOT NULL AND fa > pa) AS f FROM b)
            SELECT doc_id, page_number, CASE WHEN f THEN 'easyocr' ELSE 'tesseract' END AS engine, CASE WHEN f THEN fn ELSE pn END AS n_blocks, round(CASE WHEN f THEN fa ELSE pa END, 6) AS average_confidence, f AS fallback_used FROM c""",
        "combine_pages": f"""{w}{_OCR}, p AS (SELECT doc_id, page_number, string_agg(text, ' ' ORDER BY block_pos) AS t, count(*) FILTER (text <> 'two words') AS n, avg(confidence) AS a FROM words GROUP BY ALL)
            SELECT doc_id, string_agg(t, chr(10) || chr(10) ORDER BY page_number) AS combined_text, CAST(sum(n) AS BIGINT) AS total_word_count, round(coalesce(avg(a) FILTER (a > 0), 0), 6) AS average_confidence, count(*) AS total_pages,
              CASE WHEN min(page_number) = 1 AND max(page_number) = 2 THEN 'easyocr,tesseract' WHEN min(page_number) = 1 THEN 'tesseract' ELSE 'easyocr' END AS engines_used FROM p GROUP BY doc_id""",
        "table_rows": f"{w}{_BLOCKS} SELECT doc_id, line_no AS row_no, array_to_string(c, '|') AS cells FROM cells",
        "table_regions_ocr": f"""{w}{_BLOCKS} SELECT h.doc_id, h.block_pos AS header_pos, min(b.x1) AS x1, min(b.y1) AS y1, max(b.x2) AS x2, max(b.y2) AS y2, count(*) AS n_blocks
            FROM blocks h JOIN blocks b ON h.doc_id = b.doc_id AND abs(b.y1 - h.y2) < 200 AND abs(b.x1 - h.x1) < 500 WHERE h.line_no = 0 GROUP BY ALL HAVING count(*) >= 2""",
        "column_roles": f"{w}{_ITEMS} SELECT doc_id, col AS at, ['description', 'hsn', 'quantity', 'unit_price', 'total'][col + 1] AS role FROM (SELECT DISTINCT doc_id FROM items), unnest([0, 1, 2, 3, 4]) AS u(col)",
        "line_items_parsed": f"""{w}{_BLOCKS}, n AS (SELECT *, list_transform(c, lambda x: {_NUM}) AS nums FROM cells WHERE line_no > 0)
            SELECT doc_id, line_no AS row_no, c[1] AS description, c[2] AS hsn_code, coalesce(nullif(nums[3], 0), list_filter(nums, lambda x: x > 0 AND x <= 1000)[1], 0) AS quantity,
              coalesce(nullif(nums[4], 0), list_min(list_filter(nums, lambda x: x > 0)), 0) AS unit_price, coalesce(nullif(nums[5], 0), list_max(list_filter(nums, lambda x: x > 0)), 0) AS total_amount FROM n""",
        "locate_field": f"""{w}{_BLOCKS}, f AS (SELECT doc_id, line_no AS line, 'item_' || line_no AS field, description AS value FROM items),
            m AS (SELECT f.doc_id, field, value, b.confidence, b.x1, b.y1, b.text, row_number() OVER (PARTITION BY f.doc_id, line ORDER BY b.confidence DESC, b.block_pos) AS i FROM f JOIN blocks b USING (doc_id) WHERE contains(lower(trim(value)), lower(trim(b.text))) OR contains(lower(trim(b.text)), lower(trim(value))))
            SELECT doc_id, field, value, confidence, x1, y1, text AS source_text FROM m WHERE i = 1""",
        "nearest_block": f"""{w}{_BLOCKS}, k AS (SELECT doc_id, x1 AS kx, y1 AS ky, block_pos AS kp FROM blocks WHERE line_no = 0 AND col = 2),
            r AS (SELECT doc_id, text, row_number() OVER (PARTITION BY doc_id ORDER BY (x1 - kx) * (x1 - kx) + (y1 - ky) * (y1 - ky), block_pos) AS i FROM blocks JOIN k USING (doc_id) WHERE block_pos <> kp) SELECT doc_id, text FROM r WHERE i = 1""",
        "iou_pairs": f"""{w}{_REGIONS}, p AS (SELECT a.doc_id, a.region_id, b.region_id AS other_id, greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS i,
            (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) AS s FROM regions a JOIN regions b ON a.doc_id = b.doc_id AND a.region_id < b.region_id) SELECT doc_id, region_id, other_id, round(i / (s - i), 9) AS iou FROM p WHERE i > 0""",
        "seal_presence": f"""{w}{_REGIONS}, r AS (SELECT * FROM regions), t AS (SELECT doc_id, type, count(*) AS n FROM r GROUP BY ALL), l AS (SELECT doc_id, string_agg(type || '=' || n, ',' ORDER BY type) AS seal_types FROM t GROUP BY doc_id),
            a AS (SELECT doc_id, count(*) AS n, max(confidence) AS top, round(avg(confidence), 9) AS m FROM r GROUP BY doc_id)
            SELECT o_orderkey AS doc_id, n IS NOT NULL AS has_seals, coalesce(n, 0) AS total_detections, coalesce(seal_types, '') AS seal_types, coalesce(top, 0) AS highest_confidence, round(coalesce(m, 0), 6) AS average_confidence,
              CASE WHEN n IS NULL THEN 'no_seals_detected' WHEN m > 0.7 THEN 'high_confidence' WHEN m > 0.4 THEN 'medium_confidence' ELSE 'low_confidence' END AS validation_status
            FROM (SELECT DISTINCT o_orderkey FROM orders) LEFT JOIN a ON a.doc_id = o_orderkey LEFT JOIN l ON l.doc_id = o_orderkey""",
        "seal_candidates": """WITH c AS (SELECT l_orderkey AS doc_id, l_partkey AS contour, CAST(l_partkey * 13 % 60000 AS DOUBLE) AS area, CAST(l_partkey * 7 % 900 + 1 AS DOUBLE) AS perimeter, l_partkey % 11 AS v,
              (l_partkey % 300 + 1) / (l_partkey % 90 + 1) AS aspect, l_partkey % 61 / 60 AS cd, l_partkey % 51 / 100 AS sd, l_partkey % 99 / 100 AS so FROM lineitem)
            SELECT doc_id, contour, 'circular_seal' AS type, round(least(4 * pi() * area / (perimeter * perimeter) * 2, 1), 9) AS confidence FROM c WHERE area > 500 AND area < 50000 AND 4 * pi() * area / (perimeter * perimeter) > 0.4
            UNION ALL SELECT doc_id, contour, 'signature_box', round(least(cd * 2, 1), 9) FROM c WHERE area > 500 AND area < 50000 AND v BETWEEN 4 AND 8 AND aspect > 0.2 AND aspect < 5 AND cd > 0.1
            UNION ALL SELECT doc_id, contour, 'handwritten_signature', round(least((1 - so) * sd * 3, 1), 9) FROM c WHERE area > 200 AND area < 20000 AND aspect > 1.5 AND aspect < 8 AND sd > 0.05 AND sd < 0.4 AND so < 0.8""",
        "otsu_threshold": """WITH h AS (SELECT l_orderkey % 500 AS page, (l_partkey * 7 + l_suppkey) % 256 AS value, count(*) AS n FROM lineitem GROUP BY ALL),
            c AS (SELECT page, value, sum(n) OVER w AS w0, sum(n * value) OVER w AS s0, sum(n) OVER (PARTITION BY page) AS w, sum(n * value) OVER (PARTITION BY page) AS s FROM h WINDOW w AS (PARTITION BY page ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
            b AS (SELECT page, value, CASE WHEN w > w0 THEN round(CAST(w0 AS DOUBLE) * CAST(w - w0 AS DOUBLE) * pow(s0 / w0 - (s - s0) / (w - w0), 2) / (CAST(w AS DOUBLE) * CAST(w AS DOUBLE)), 6) ELSE 0 END AS between_ FROM c)
            SELECT page, value AS threshold FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY between_ DESC, value) AS i FROM b) WHERE i = 1""",
        "deskew_angle": "WITH a AS (SELECT l_orderkey AS page, l_partkey % 1200 / 10 - 60 AS angle FROM lineitem), m AS (SELECT page, median(angle) AS angle FROM a WHERE abs(angle) <= 45 GROUP BY page) SELECT page, round(CASE WHEN abs(angle) > 0.5 THEN angle ELSE 0 END, 6) AS angle FROM m",
        "invoice_json": f"""{w}{_INVOICES}, l AS (SELECT doc_id, count(*) AS n, max(line_no) AS last FROM items GROUP BY doc_id)
            SELECT doc_id, invoice_number, gst_number AS vendor_gst, coalesce(CAST(subtotal AS DOUBLE), 0) AS subtotal, CAST(disc AS DOUBLE) AS discount, CAST(gst AS DOUBLE) AS total_gst, CAST(final AS DOUBLE) AS final_total,
              coalesce(n, 0) AS n_items, a.description AS first_description, CASE WHEN b.doc_id IS NOT NULL THEN coalesce({parse('b.quantity')}, 0) END AS last_quantity
            FROM inv LEFT JOIN l USING (doc_id) LEFT JOIN (SELECT doc_id, description FROM items WHERE line_no = 1) a USING (doc_id) LEFT JOIN (SELECT i.doc_id, i.quantity FROM items i JOIN l ON i.doc_id = l.doc_id AND i.line_no = l.last) b USING (doc_id)""",
        "summary_sheet": f"""{w}{_INVOICES}, s AS (SELECT doc_id, unnest(range(19)) AS i, ['Field', 'Invoice Number', 'Invoice Date', 'PO Number', 'Vendor Name', 'Vendor GST', 'Buyer Name', 'Buyer GST', '', 'Financial Summary', 'Subtotal', 'Discount', 'Total GST', 'Final Total', '', 'Processing Info', 'Extraction Date', 'Source File', 'Total Pages'] AS f,
              ['Value', invoice_number, invoice_date, po_number, '', gst_number, '', '', '', '', NULL, NULL, NULL, NULL, '', '', '', '', NULL] AS v,
              [NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, coalesce(CAST(subtotal AS DOUBLE), 0), CAST(disc AS DOUBLE), CAST(gst AS DOUBLE), CAST(final AS DOUBLE), NULL, NULL, NULL, NULL, 1] AS n FROM inv)
            SELECT doc_id, CAST(i AS INTEGER) AS pos, f[i + 1] AS field, n[i + 1] AS number, v[i + 1] AS text FROM s""",
        "verification_sheet": f"""{w}{_CHECKS} SELECT doc_id, CAST(i AS INTEGER) AS pos, ['Overall Confidence', 'Line Item Calculations', 'Subtotal Verification', 'Total Verification', 'Seals Detected'][i + 1] AS item,
            ['INFO', CASE WHEN line_items_valid THEN 'PASS' ELSE 'FAIL' END, 'PASS', CASE WHEN calculations_valid THEN 'PASS' ELSE 'FAIL' END, 'NO'][i + 1] AS status FROM (SELECT *, unnest(range(5)) AS i FROM flags)""",
        "verification_report": f"{w}{_CHECKS} SELECT doc_id, confidence_score AS overall_confidence, overall_status AS verification_status, gst_valid AS mathematical_verification_gst_calculations, true AS mathematical_verification_subtotal_verification, CAST(0 AS DOUBLE) AS field_confidence_scores_totals FROM flags",
        "run_status": f"{w}{_CHECKS} SELECT overall_status, recommendation, count(*) AS n FROM flags GROUP BY ALL",
    }
