"""DuckDB SQL for the queries of ``queries_more``."""

from __future__ import annotations

from . import oracles as O

_MON = "(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
_DATES = f"""list_concat(regexp_extract_all(text, '\\b([0-9]{{1,2}}[/-][0-9]{{1,2}}[/-][0-9]{{2,4}})\\b', 1), regexp_extract_all(text, '\\b([0-9]{{2,4}}[/-][0-9]{{1,2}}[/-][0-9]{{1,2}})\\b', 1),
  regexp_extract_all(text, '(?i)\\b[0-9]{{1,2}}\\s+{_MON}[a-z]*\\s+[0-9]{{2,4}}\\b', 1), regexp_extract_all(text, '(?i)\\b{_MON}[a-z]*\\s+[0-9]{{1,2}},?\\s+[0-9]{{2,4}}\\b', 1))"""
_BOXES = """boxes AS (
  SELECT o_orderkey AS doc_id, unnest([1, 2, 3]) AS box_id, unnest([o_orderkey % 60, 240, 0]) AS x1, unnest([90, o_orderkey % 90 + 60, 0]) AS y1,
    unnest([o_orderkey % 300 + 250, 600, 150]) AS x2, unnest([230, o_orderkey % 90 + 180, o_orderkey % 400 + 20]) AS y2 FROM orders
), held AS (
  SELECT r.doc_id, r.box_id, r.x2 - r.x1 AS w, r.y2 - r.y1 AS h, b.line_no, b.x1, b.block_pos, b.text FROM boxes r JOIN blocks b ON r.doc_id = b.doc_id AND b.x1 >= r.x1 AND b.x2 <= r.x2 AND b.y1 >= r.y1 AND b.y2 <= r.y2
)"""
_NAMES = "CASE name WHEN 'line_items' THEN 1 WHEN 'subtotal' THEN 2 WHEN 'final_total' THEN 3 WHEN 'formats' THEN 4 ELSE 5 END"


def sql() -> dict[str, str]:
    w = "WITH "
    return {
        "files_to_headers": f"""{w}{O._HEADER_FIELDS}, bad AS (SELECT doc_id, contains(text, 'Phone: 12345' || chr(10)) AS failed FROM texts)
            SELECT doc_id, CASE WHEN NOT failed THEN invoice_number END AS invoice_number, CASE WHEN NOT failed THEN invoice_date END AS invoice_date, CASE WHEN NOT failed THEN po_number END AS po_number, CASE WHEN NOT failed THEN vendor_gst END AS vendor_gst, buyer_gst,
              CASE WHEN NOT failed THEN shipping_address END AS shipping_address, CASE WHEN NOT failed THEN final_total END AS final_total, 1 AS n_pages, CASE WHEN failed THEN 'unreadable page' END AS error FROM found JOIN bad USING (doc_id)""",
        "dates_in_text": f"{w}{O._TEXTS}, g AS (SELECT doc_id, {_DATES} AS l FROM texts) SELECT doc_id, CAST(i AS INTEGER) AS pos, l[i + 1] AS found FROM (SELECT *, unnest(range(len(l))) AS i FROM g)",
        "gst_normalised": f"""{w}{O._HEADERS} SELECT doc_id, CASE WHEN length(email) > 18 THEN CASE WHEN regexp_full_match(replace(gst_number, 'F1', 'FQ1'), '[0-9]{{2}}[A-Z0-9]{{10}}[A-Z][0-9][A-Z][0-9A-Z]') THEN replace(gst_number, 'F1', 'FQ1')
            ELSE lower(substring(gst_number, 1, 2) || ' ' || replace(substring(gst_number, 3), 'F1', 'FQ1')) END ELSE gst_number END AS gst FROM headers""",
        "standard_dates": f"{w}{O._HEADERS} SELECT doc_id, CASE WHEN month(day) % 5 <> 4 THEN strftime(day, '%d/%m/%Y') END AS standard FROM headers",
        "pattern_strength": f"""{w}{O._HEADERS}, g AS (SELECT doc_id, CASE WHEN month(day) = 1 THEN substring(invoice_number, 1, 8) WHEN month(day) = 2 THEN invoice_number || 'x' ELSE invoice_number END AS n FROM headers)
            SELECT doc_id, CASE WHEN regexp_full_match(n, 'INV-[0-9]{{4}}-[0-9]{{6}}') THEN 1.0 WHEN regexp_matches(n, '^INV-[0-9]{{4}}-[0-9]{{6}}') THEN 0.8 WHEN regexp_matches(n, '^INV-[0-9]{{4}}-') THEN 0.75
              WHEN regexp_matches(n, '^INV-[0-9]{{4}}') THEN 0.5 WHEN starts_with(n, 'INV-') THEN 0.25 ELSE 0 END AS strength FROM g""",
        "nested_values": f"{w}{O._HEADERS} SELECT doc_id, invoice_number AS number, CASE WHEN month(day) > 6 THEN CAST(customer AS VARCHAR) ELSE 'none' END AS buyer, CAST(NULL AS VARCHAR) AS missing FROM headers",
        "passed_flags": f"""{w}{O._CHECKS} SELECT doc_id, bool_and(n_errors = 0) FILTER (name = 'line_items') AS all_line_items_verified, bool_and(n_errors = 0) FILTER (name IN ('subtotal', 'final_total')) AS totals_verified,
            bool_and(n_errors = 0) AS overall_verification_passed, coalesce(string_agg(name, ',' ORDER BY {_NAMES}) FILTER (n_errors > 0), '') AS failed_checks FROM checks GROUP BY doc_id""",
        "sectioned_report": f"""{w}{O._FIELDS}, {O._OCR}, f AS (SELECT doc_id, count(*) AS n_fields, count(*) FILTER (confidence >= 0.1) AS n_present, bool_and(confidence >= 0.8) AS all_fields_confident, round(avg(confidence), 6) AS average_field_confidence,
            coalesce(string_agg(field, ',' ORDER BY field) FILTER (confidence < 0.8), '') AS low_confidence_fields, max(confidence) FILTER (field = 'vendor') AS vendor FROM fields GROUP BY doc_id),
            i AS (SELECT doc_id, count(*) AS n, arg_min(confidence, block_pos) AS c FROM words GROUP BY doc_id)
            SELECT f.*, CAST(coalesce(n, 0) AS INTEGER) AS n_items, c AS first_item FROM f LEFT JOIN i USING (doc_id)""",
        "verification_summary": f"""{w}{O._CHECKS}, {O._FIELDS}, c AS (SELECT doc_id, count(*) FILTER (n_errors > 0) AS failed FROM checks GROUP BY doc_id), f AS (SELECT doc_id, round(avg(confidence), 6) AS overall_confidence, count(*) FILTER (confidence < 0.8) AS low FROM fields GROUP BY doc_id)
            SELECT doc_id, overall_confidence, failed = 0 AND low = 0 AS verification_passed, failed + low AS issues_found, CASE WHEN failed > 0 THEN 1 ELSE 0 END + CASE WHEN low > 0 THEN 1 ELSE 0 END AS n_recommendations FROM f JOIN c USING (doc_id)""",
        "verification_score": "SELECT o_orderkey AS doc_id, round((o_orderkey * 7 % 101 / 100 + o_orderkey * 11 % 101 / 100 + o_orderkey * 13 % 101 / 100) / 3, 6) AS score FROM orders",
        "bucket_texts": f"""{w}{O._OCR} SELECT doc_id, page_number, coalesce(string_agg(text, '|' ORDER BY block_pos) FILTER (confidence >= 0.9), '') AS high, coalesce(string_agg(text, '|' ORDER BY block_pos) FILTER (confidence >= 0.6 AND confidence < 0.9), '') AS medium,
            coalesce(string_agg(text, '|' ORDER BY block_pos) FILTER (confidence < 0.6), '') AS low FROM words GROUP BY doc_id, page_number""",
        "region_text": f"""{w}{O._OCR} SELECT doc_id, page_number, 1 AS region_id, string_agg(text, ' ' ORDER BY block_pos) AS text, count(*) AS n_blocks, round(avg(confidence), 6) AS average_confidence
            FROM words WHERE x1 < 110 AND x2 > 40 AND y1 < 40 AND y2 > 0 GROUP BY doc_id, page_number""",
        "ocr_metrics": f"""{w}{O._OCR}, p AS (SELECT doc_id, page_number, count(*) AS n, avg(confidence) AS c FROM words GROUP BY ALL), t AS (SELECT o_orderkey AS doc_id, unnest([1, 2]) AS page_number, o_orderkey % 7 / 2 AS seconds FROM orders)
            SELECT doc_id, page_number, seconds AS processing_time, coalesce(n, 0) AS text_blocks_detected, round(coalesce(c, 0), 6) AS average_confidence, CASE WHEN seconds = 0 THEN 0 ELSE round(coalesce(n, 0) / seconds, 6) END AS blocks_a_second FROM t LEFT JOIN p USING (doc_id, page_number)""",
        "table_regions": f"""{w}{O._BLOCKS}, heads AS (SELECT * FROM blocks WHERE line_no = 0 AND confidence >= 0.75), found AS (
            SELECT h.doc_id, h.block_pos, min(b.x1) AS x1, min(b.y1) AS y1, max(b.x2) AS x2, max(b.y2) AS y2 FROM heads h JOIN blocks b ON h.doc_id = b.doc_id AND abs(b.y1 - h.y2) < 200 AND abs(b.x1 - h.x1) < 500 GROUP BY h.doc_id, h.block_pos HAVING count(*) >= 2)
            SELECT doc_id, x1, y1, x2, y2, 0.8 AS confidence, 1 AS method FROM found
            UNION ALL SELECT doc_id, min(x1), min(y1), max(x2), max(y2), 0.6, 3 FROM blocks WHERE doc_id NOT IN (SELECT doc_id FROM found) GROUP BY doc_id HAVING count(DISTINCT line_no) >= 2""",
        "table_regions_grid": f"{w}{O._BLOCKS} SELECT doc_id, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, count(DISTINCT line_no) AS n_rows FROM blocks GROUP BY doc_id HAVING count(DISTINCT line_no) >= 2",
        "table_regions_boxes": f"{w}{O._BLOCKS}, {_BOXES} SELECT doc_id, box_id, count(*) AS n_blocks, 0.7 AS confidence FROM held WHERE w > 200 AND h > 100 GROUP BY doc_id, box_id HAVING count(*) >= 2",
        "rows_in_regions": f"""{w}{O._BLOCKS}, {_BOXES}, n AS (SELECT *, dense_rank() OVER (PARTITION BY doc_id, box_id ORDER BY line_no) - 1 AS row_no FROM held)
            SELECT doc_id, box_id AS region_id, CAST(row_no AS INTEGER) AS row_no, string_agg(text, '|' ORDER BY x1, block_pos) AS cells FROM n GROUP BY doc_id, box_id, row_no""",
        "content_density": "SELECT l_orderkey AS doc_id, round(count(*) FILTER (l_partkey * 7 % 256 <= 200) / count(*), 9) AS density FROM lineitem GROUP BY l_orderkey",
        "suppress_overlaps": f"""WITH RECURSIVE {O._REGIONS}, o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY confidence DESC, region_id) AS i FROM regions), walk AS (
            SELECT doc_id, 1 AS i, [region_id] AS kept FROM o WHERE i = 1
            UNION ALL SELECT k.doc_id, k.i + 1, CASE WHEN EXISTS (SELECT 1 FROM o p WHERE p.doc_id = n.doc_id AND list_contains(k.kept, p.region_id)
                AND greatest(0, least(p.x2, n.x2) - greatest(p.x1, n.x1)) * greatest(0, least(p.y2, n.y2) - greatest(p.y1, n.y1)) >
                  0.3 * ((p.x2 - p.x1) * (p.y2 - p.y1) + (n.x2 - n.x1) * (n.y2 - n.y1) - greatest(0, least(p.x2, n.x2) - greatest(p.x1, n.x1)) * greatest(0, least(p.y2, n.y2) - greatest(p.y1, n.y1))))
              THEN k.kept ELSE list_append(k.kept, n.region_id) END FROM walk k JOIN o n ON n.doc_id = k.doc_id AND n.i = k.i + 1),
            last AS (SELECT doc_id, unnest(arg_max(kept, i)) AS region_id FROM walk GROUP BY doc_id)
            SELECT doc_id, region_id, type, confidence FROM last JOIN regions USING (doc_id, region_id)""",
        "item_sheet": f"""{w}{O._ITEMS} SELECT doc_id, line_no, description, coalesce(hsn_code, '') AS hsn_code, coalesce(TRY_CAST(quantity AS DOUBLE), 0) AS quantity, coalesce(CAST(p AS DOUBLE), 0) AS unit_price, coalesce(CAST(t AS DOUBLE), 0) AS total_amount,
            coalesce(CAST(r AS DOUBLE), 0) AS gst_rate, CAST(0 AS DOUBLE) AS gst_amount FROM read""",
        "sheet_widths": f"""{w}{O._ITEMS}, c AS (SELECT unnest(['description', 'hsn_code', 'quantity', 'unit_price', 'total_amount']) AS "column", unnest([length(description), length(hsn_code), length(quantity), length(unit_price), length(total_amount)]) AS n FROM items)
            SELECT "column", CAST(least(greatest(coalesce(max(n), 0), length("column")) + 2, 50) AS INTEGER) AS width FROM c GROUP BY "column" """,
        "amount_helpers": f"""{w}{O._ITEMS} SELECT doc_id, line_no, CASE WHEN t IS NULL OR t = 0 OR p IS NULL THEN 0 ELSE round(CAST(p AS DOUBLE) * 100 / CAST(t AS DOUBLE), 6) END AS share, CAST(round(t, 2) AS DOUBLE) AS rounded,
            coalesce(abs(t - round(t, 2)) <= 0.01, false) AS is_near FROM read""",
        "fields_kept": f"""{w}{O._HEADERS} SELECT doc_id, 'invoice_number' || CASE WHEN month(day) > 9 THEN ',note' ELSE '' END || CASE WHEN month(day) > 3 THEN ',phone' ELSE '' END || ',pincode' AS kept FROM headers""",
    }
