"""The registered queries once more, as plain SQL over the given tables.

Patterns and wording are the fixed values of the library; the rest is written independently of the Spark code: window forms instead of aggregates with ``max_by``, global ``row_number``
instead of ranges, integer cents instead of decimal division.
"""

from __future__ import annotations

from invoicemill.functions import fixed_values as fv

AS_OF = "DATE '2001-08-01'"
SPLIT = "TIMESTAMP '2000-01-01 00:00:00'"


def half_up(numerator: str, denominator: str) -> str:
    """Rounded quotient of two whole numbers, denominator positive."""
    return f"((2 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS BIGINT)"


def from_cents(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) / 100 AS DECIMAL(12,2))"


def headers(faults: bool) -> str:
    f = faults
    email = "'AP' || o_custkey || '@Example.com" + (" '" if f else "'")
    number = ("CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN 'INV ' || o_orderkey "
              "ELSE 'INV-' || o_orderkey END" if f else "'INV-' || o_orderkey")
    due = ("CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 50 = 0 THEN CAST(issued - 1 AS DATE) "
           "ELSE CAST(issued + 30 AS DATE) END" if f else "CAST(issued + 30 AS DATE)")
    subtotal = "sub" if f else "coalesce(sub, CAST(0 AS DECIMAL(12,2)))"
    tax = f"CAST(round({subtotal} * CAST(0.08 AS DECIMAL(4,2)), 2) AS DECIMAL(12,2))"
    if f:
        tax = f"CAST({tax} + CASE WHEN o_orderkey % 59 = 0 THEN 1 ELSE 0 END AS DECIMAL(12,2))"
    total = f"CAST({subtotal} + {tax} AS DECIMAL(12,2))"
    if f:
        total = (f"CASE WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) "
                 f"ELSE {total} END")
    return f"""
line_sums AS (
  SELECT l_orderkey, count(*) AS n_items, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS items_total
  FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT o.*, c.c_name, c.c_nationkey, c.c_mktsegment, n.n_nationkey, r.r_name, coalesce(s.n_items, 0) AS n_items,
    coalesce(s.items_total, 0) AS items_total, TRY_CAST(s.items_total AS DECIMAL(12,2)) AS sub,
    CAST(o.o_orderdate AS DATE) AS issued
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey LEFT JOIN line_sums s ON o.o_orderkey = s.l_orderkey),
headers AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS document_id, c_name AS vendor_name, 'Unit ' || c_nationkey AS vendor_address,
    'Nation ' || chr(65 + n_nationkey) AS vendor_city, upper(substr(r_name, 1, 2)) AS vendor_state,
    lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0') AS vendor_zip,
    CASE WHEN o_custkey % 7 <> 0 THEN '(217) 555-' || lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') END AS vendor_phone,
    CASE WHEN o_custkey % 7 <> 0 THEN {email} END AS vendor_email,
    {number} AS invoice_number, issued AS invoice_date, {due} AS due_date, 'PO-' || o_orderkey AS po_number,
    {subtotal} AS subtotal, CAST(0.08 AS DECIMAL(10,8)) AS tax_rate, {tax} AS tax_amount, {total} AS total_amount,
    {"'usd '" if f else "'USD'"} AS currency,
    c_mktsegment || ' Purchasing' AS bill_to_name, 'Dock ' || c_nationkey AS bill_to_address, r_name AS bill_to_city,
    'US' AS bill_to_state, lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS bill_to_zip,
    n_items, items_total, o_orderdate AS parse_timestamp, o_orderkey, o_orderstatus, o_orderpriority, o_orderdate
  FROM base)"""


def text(x: str) -> str:
    """An amount as a float prints."""
    return f"regexp_replace(CAST(CAST({x} AS DECIMAL(12,2)) AS VARCHAR), '0$', '')"


EXPECTED_TOTAL = "(subtotal + coalesce(tax_amount, 0))"
EXPECTED_TAX = "CAST(round(subtotal * tax_rate, 2) AS DECIMAL(12,2))"
NULLS = {"field": "NULL", "expected": "NULL", "actual": "NULL"}


def _rules() -> list[tuple[int, str, str, str, str, str, str, str]]:
    """(number, name, passed, severity, message, field, expected, actual)"""
    rows = []
    for n, (label, col, word, severity) in enumerate([
            ("invoice_number", "invoice_number", "Required", "error"), ("vendor.name", "vendor_name", "Required", "error"),
            ("total_amount", "total_amount", "Required", "error"), ("invoice_date", "invoice_date", "Expected", "warning")], 1):
        state = f"CASE WHEN {col} IS NULL THEN 'missing' ELSE 'present' END"
        rows.append((n, "required_field", f"{col} IS NOT NULL", f"'{severity}'",
                     f"'{word} field ''{label}'' is ' || {state}", f"'{label}'", "NULL", state))

    def checked(number, name, can, passes, severity, message, skip, field, expected="NULL", actual="NULL"):
        wrap = lambda a, b: f"CASE WHEN {can} THEN {a} ELSE {b} END"
        rows.append((number, name, wrap(passes, "true"), wrap(f"'{severity}'", "'warning'"), wrap(message, f"'{skip}'"),
                     wrap(f"'{field}'", "NULL"), wrap(expected, "NULL"), wrap(actual, "NULL")))

    fits = "regexp_matches(invoice_number, '^[A-Za-z0-9\\-\\.\\/]+$')"
    checked(5, "invoice_number_format", "coalesce(invoice_number, '') <> ''", fits, "warning",
            f"'Invoice number ''' || invoice_number || ''' ' || CASE WHEN {fits} THEN 'matches' ELSE 'does not match' END || ' expected format'",
            "Invoice number not present, skipping format check", "invoice_number", actual="invoice_number")

    def amount(number, name, can, actual, expected, severity, field, before, between, skip):
        ok = f"abs({actual} - {expected}) <= 0.02"
        checked(number, name, can, ok, severity,
                f"'{before} (' || {text(actual)} || ') ' || CASE WHEN {ok} THEN 'matches' ELSE 'does not match' END || ' {between} (' || {text(expected)} || ')'",
                skip, field, text(expected), text(actual))

    amount(6, "total_matches_components", "coalesce(total_amount, 0) <> 0 AND coalesce(subtotal, 0) <> 0", "total_amount",
           EXPECTED_TOTAL, "error", "total_amount", "Total", "subtotal + tax", "Cannot verify total (subtotal or total missing)")
    amount(7, "subtotal_matches_line_items", "n_items > 0 AND coalesce(subtotal, 0) <> 0", "subtotal", "items_total",
           "error", "subtotal", "Subtotal", "sum of line items", "Cannot verify subtotal (line items or subtotal missing)")
    amount(8, "tax_calculation", "coalesce(tax_rate, 0) <> 0 AND coalesce(subtotal, 0) <> 0 AND tax_amount IS NOT NULL",
           "tax_amount", EXPECTED_TAX, "warning", "tax_amount", "Tax amount", "expected",
           "Cannot verify tax (rate, subtotal, or amount missing)")
    oldest, newest = f"CAST({AS_OF} - 365 AS DATE)", f"CAST({AS_OF} + 30 AS DATE)"
    inside = f"invoice_date BETWEEN {oldest} AND {newest}"
    checked(9, "date_range", "invoice_date IS NOT NULL", inside, "warning",
            f"'Invoice date ' || CAST(invoice_date AS VARCHAR) || ' is ' || CASE WHEN {inside} THEN 'within' ELSE 'outside' END || ' expected range (' || CAST({oldest} AS VARCHAR) || ' to ' || CAST({newest} AS VARCHAR) || ')'",
            "No invoice date to validate", "invoice_date", actual="CAST(invoice_date AS VARCHAR)")
    checked(10, "due_date_order", "invoice_date IS NOT NULL AND due_date IS NOT NULL", "due_date >= invoice_date", "warning",
            "'Due date (' || CAST(due_date AS VARCHAR) || ') is ' || CASE WHEN due_date >= invoice_date THEN 'on or after' ELSE 'before' END || ' invoice date (' || CAST(invoice_date AS VARCHAR) || ')'",
            "Cannot compare dates (one or both missing)", "due_date")
    bad = "concat_ws(', ', CASE WHEN subtotal < 0 THEN '''subtotal''' END, CASE WHEN tax_amount < 0 THEN '''tax_amount''' END, CASE WHEN total_amount < 0 THEN '''total_amount''' END)"
    rows.append((11, "amounts_positive", f"{bad} = ''", "'error'",
                 f"CASE WHEN {bad} = '' THEN 'All amounts are positive' ELSE 'Negative amounts found: [' || {bad} || ']' END",
                 "NULL", "NULL", "NULL"))
    checked(12, "line_items_complete", "n_items > 0", "true", "warning", "'All ' || n_items || ' line items have amounts'",
            "No line items to validate", "line_items")
    contact = "coalesce(vendor_name, '') <> '' AND (coalesce(vendor_phone, '') <> '' OR coalesce(vendor_email, '') <> '')"
    rows.append((13, "vendor_contact_info", contact, "'warning'",
                 f"'Vendor ' || CASE WHEN {contact} THEN 'has' ELSE 'missing' END || ' name and contact info'", "'vendor'",
                 "NULL", "NULL"))
    return rows


RULES_CTE = "rule_results AS (\n" + "\nUNION ALL\n".join(
    f"SELECT document_id, {n} AS rule_number, '{name}' AS rule_name, {passed} AS passed, {severity} AS severity, "
    f"{message} AS message, CAST({field} AS VARCHAR) AS field_name, CAST({expected} AS VARCHAR) AS expected, "
    f"CAST({actual} AS VARCHAR) AS actual FROM headers" for n, name, passed, severity, message, field, expected, actual in _rules()) + ")"

STATUS_CTE = """statuses AS (
  SELECT document_id, count(*) AS total_rules, count(*) FILTER (passed) AS passed,
    count(*) FILTER (NOT passed AND severity = 'error') AS errors,
    count(*) FILTER (NOT passed AND severity = 'warning') AS warnings,
    CASE WHEN count(*) FILTER (NOT passed AND severity = 'error') > 0 THEN 'failed'
         WHEN count(*) FILTER (NOT passed) > 0 THEN 'review_needed' ELSE 'passed' END AS validation_status
  FROM rule_results GROUP BY document_id)"""

POSSIBLE = "(19 + CASE WHEN n_items > 0 AND coalesce(subtotal, 0) <> 0 THEN 2 ELSE 0 END)"
SCORE = """(CASE WHEN coalesce(invoice_number, '') <> '' THEN 3 ELSE 0 END + CASE WHEN coalesce(vendor_name, '') <> '' THEN 3 ELSE 0 END
  + CASE WHEN coalesce(total_amount, 0) <> 0 THEN 3 ELSE 0 END + CASE WHEN invoice_date IS NOT NULL THEN 2 ELSE 0 END
  + CASE WHEN due_date IS NOT NULL THEN 2 ELSE 0 END + CASE WHEN n_items > 0 THEN 2 ELSE 0 END
  + CASE WHEN coalesce(bill_to_name, '') <> '' THEN 1 ELSE 0 END + CASE WHEN coalesce(po_number, '') <> '' THEN 1 ELSE 0 END
  + CASE WHEN coalesce(subtotal, 0) <> 0 THEN 1 ELSE 0 END + CASE WHEN tax_amount IS NOT NULL THEN 1 ELSE 0 END
  + CASE WHEN n_items > 0 AND coalesce(subtotal, 0) <> 0 AND abs(items_total - subtotal) < 0.02 THEN 2 ELSE 0 END)"""
CONFIDENCE = f"round(CAST({SCORE} AS DOUBLE) / {POSSIBLE}, 2)"
COMPLETION = """((CASE WHEN invoice_number IS NULL THEN 0 ELSE 1 END + CASE WHEN invoice_date IS NULL THEN 0 ELSE 1 END
  + CASE WHEN vendor_name IS NULL THEN 0 ELSE 1 END + CASE WHEN total_amount IS NULL THEN 0 ELSE 1 END) / CAST(4 AS DOUBLE))"""

INVOICES_CTE = f"invoices AS (SELECT h.*, s.validation_status, {CONFIDENCE} AS parse_confidence FROM headers h JOIN statuses s USING (document_id))"

LINES_CTE = f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem),
lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS document_id, CAST(rn AS INTEGER) AS line_number,
    l_orderkey || '-' || CASE WHEN rn > 999 THEN CAST(rn AS VARCHAR) ELSE lpad(CAST(rn AS VARCHAR), 3, '0') END AS line_item_id,
    p_name || ' #' || l_partkey AS description, CAST(l_quantity AS DECIMAL(10,2)) AS quantity,
    {from_cents(half_up("CAST(round(l_extendedprice * 100) AS BIGINT)", "CAST(l_quantity AS BIGINT)"))} AS unit_price,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS line_amount
  FROM numbered LEFT JOIN part ON l_partkey = p_partkey)"""

STG_CTE = """stg AS (
  SELECT document_id, trim(vendor_name) AS vendor_name, trim(vendor_address) AS vendor_address, trim(vendor_city) AS vendor_city,
    upper(trim(vendor_state)) AS vendor_state, trim(vendor_zip) AS vendor_zip, trim(vendor_phone) AS vendor_phone,
    lower(trim(vendor_email)) AS vendor_email, trim(invoice_number) AS invoice_number, invoice_date, due_date,
    trim(po_number) AS po_number, subtotal, tax_amount, total_amount, upper(trim(currency)) AS currency, parse_confidence,
    validation_status, parse_timestamp
  FROM invoices WHERE validation_status IN ('passed', 'review_needed'))"""
CLEANED_CTE = f"""cleaned AS (
  SELECT document_id, vendor_name, vendor_address, vendor_city, vendor_state, vendor_zip, vendor_phone, vendor_email,
    md5(lower(trim(coalesce(vendor_name, ''))) || '|' || lower(trim(coalesce(vendor_address, '')))) AS vendor_id,
    invoice_number, invoice_date, due_date, po_number, CAST(date_diff('day', invoice_date, due_date) AS INTEGER) AS payment_terms_days,
    subtotal, tax_amount, total_amount, currency,
    CASE WHEN subtotal > 0 AND tax_amount IS NOT NULL THEN CAST(CAST({half_up(cents("tax_amount") + " * 10000", cents("subtotal"))} AS DOUBLE) / 10000 AS DECIMAL(16,4)) END AS effective_tax_rate,
    CASE WHEN total_amount >= 10000 THEN true ELSE false END AS is_high_value, parse_confidence, validation_status, parse_timestamp
  FROM stg)"""
VENDORS_CTE = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY vendor_id ORDER BY parse_timestamp DESC, document_id DESC) AS recency FROM cleaned),
activity AS (
  SELECT vendor_id, min(invoice_date) AS first_seen_date, max(invoice_date) AS last_seen_date, count(*) AS document_count
  FROM cleaned GROUP BY vendor_id),
vendors AS (
  SELECT r.vendor_id, vendor_name, vendor_address, vendor_city, vendor_state, vendor_zip, vendor_phone, vendor_email,
    first_seen_date, last_seen_date, document_count
  FROM ranked r LEFT JOIN activity a ON r.vendor_id = a.vendor_id WHERE recency = 1)"""
DIMS_CTE = """dim_vendors AS (SELECT CAST(row_number() OVER (ORDER BY vendor_id) AS BIGINT) AS vendor_key, * FROM vendors),
dim_documents AS (
  SELECT CAST(row_number() OVER (ORDER BY document_id) AS BIGINT) AS document_key, document_id, vendor_key,
    'invoice' AS document_type, invoice_number, invoice_date, due_date, po_number, payment_terms_days, subtotal, tax_amount,
    total_amount, effective_tax_rate, currency, is_high_value, parse_confidence, validation_status,
    parse_timestamp AS upload_timestamp
  FROM cleaned c LEFT JOIN (SELECT vendor_key, vendor_id FROM dim_vendors) v ON c.vendor_id = v.vendor_id)"""
FACTS_CTE = f"""fact_lines AS (
  SELECT CAST(row_number() OVER (ORDER BY line_item_id) AS BIGINT) AS line_item_key, document_key, vendor_key, line_number,
    trim(description) AS description, quantity, unit_price, line_amount
  FROM lines l JOIN dim_documents d ON l.document_id = d.document_id),
line_stats AS (
  SELECT document_key, count(*) AS n, CAST(sum(line_amount) AS DECIMAL(18,2)) AS amount, max(line_amount) AS hi, min(line_amount) AS lo
  FROM fact_lines GROUP BY document_key),
fact_summary AS (
  SELECT CAST(row_number() OVER (ORDER BY d.document_key) AS BIGINT) AS summary_key, d.document_key, vendor_key,
    coalesce(n, 0) AS total_line_items, subtotal, tax_amount, total_amount,
    coalesce({from_cents(half_up(cents("amount"), "n"))}, CAST(0 AS DECIMAL(12,2))) AS avg_line_item_amount,
    CAST(coalesce(hi, 0) AS DECIMAL(12,2)) AS max_line_item_amount, CAST(coalesce(lo, 0) AS DECIMAL(12,2)) AS min_line_item_amount,
    invoice_date, due_date, payment_terms_days, parse_confidence, is_high_value
  FROM dim_documents d LEFT JOIN line_stats s ON d.document_key = s.document_key)"""

SILVER = ["document_id", "vendor_name", "vendor_address", "vendor_city", "vendor_state", "vendor_zip", "vendor_phone",
          "vendor_email", "invoice_number", "invoice_date", "due_date", "po_number", "subtotal", "tax_amount",
          "total_amount", "currency", "parse_confidence", "validation_status", "parse_timestamp"]


def on(select: str, *ctes: str, faults: bool = True) -> str:
    return "WITH " + ",\n".join([headers(faults), *ctes]) + "\n" + select


JUDGED = (RULES_CTE, STATUS_CTE)
INVOICES = (*JUDGED, INVOICES_CTE)
STAGED = (*INVOICES, STG_CTE)
CLEANED = (*STAGED, CLEANED_CTE)
VENDORS = (*CLEANED, VENDORS_CTE)
DIMS = (*VENDORS, DIMS_CTE)
FACTS = (*DIMS, LINES_CTE, FACTS_CTE)

SHA16 = "substr(sha256(trim(lower(coalesce(vendor_name, ''))) || '|' || trim(lower(coalesce(vendor_address, '')))), 1, 16)"


def money(x: str) -> str:
    return f"format('{{:,.2f}}', CAST({x} AS DOUBLE))"


PLANTED = """planted_invoices AS (SELECT * FROM invoices UNION ALL SELECT * FROM invoices WHERE o_orderkey % 97 = 0),
planted_lines AS (SELECT CASE WHEN CAST(document_id AS BIGINT) % 83 <> 0 THEN line_item_id END AS line_item_id,
    CASE WHEN CAST(document_id AS BIGINT) % 89 = 0 THEN 'X' || document_id WHEN CAST(document_id AS BIGINT) % 79 <> 0 THEN document_id END AS document_id
  FROM lines),
planted_stg AS (SELECT * REPLACE (CASE WHEN CAST(document_id AS BIGINT) % 73 <> 0 THEN vendor_name END AS vendor_name,
    CASE WHEN CAST(document_id AS BIGINT) % 71 = 0 THEN 'unknown' ELSE validation_status END AS validation_status) FROM stg),
planted_documents AS (
  SELECT * REPLACE (CASE WHEN CAST(document_id AS BIGINT) % 67 = 0 THEN total_amount + 1 ELSE total_amount END AS total_amount) FROM dim_documents
  UNION ALL SELECT * FROM dim_documents WHERE CAST(document_id AS BIGINT) % 47 = 0)"""
PLANTED_FOR = {"invoices": "planted_invoices", "lines": "planted_lines", "stg": "planted_stg", "dim_documents": "planted_documents"}

#: Headers in which the rules fail that hold in all others.
PLANTED_HEADERS = """planted_headers AS (SELECT * REPLACE (
    CASE WHEN o_orderkey % 61 = 0 THEN CAST(subtotal + 5 AS DECIMAL(12,2)) ELSE subtotal END AS subtotal,
    CASE WHEN o_orderkey % 37 = 0 THEN CAST(-1 AS DECIMAL(12,2)) ELSE tax_amount END AS tax_amount),
  CASE WHEN o_orderkey % 41 = 0 THEN 1 ELSE 0 END AS n_missing FROM headers)"""


def planted_rules_sql() -> str:
    failed = [f"SELECT '{name}' AS rule_name, {severity} AS severity, {'n_items = 0 OR n_missing = 0' if name == 'line_items_complete' else passed} AS passed "
              f"FROM planted_headers" for _, name, passed, severity, *_ in _rules()]
    results = "results AS (\n" + "\nUNION ALL\n".join(failed) + ")"
    return on("SELECT rule_name, severity, count(*) AS failures FROM results WHERE NOT passed GROUP BY rule_name, severity", PLANTED_HEADERS, results)


def dq(planted: bool = False) -> str:
    named = lambda table: PLANTED_FOR.get(table, table) if planted else table
    unique = [("parsed_invoices", "invoices", "document_id"), ("parsed_line_items", "lines", "line_item_id"),
              ("stg_parsed_invoices", "stg", "document_id"), ("stg_parsed_line_items", "stg_lines", "line_item_id"),
              ("int_cleaned_invoices", "cleaned", "document_id"), ("int_normalized_vendors", "vendors", "vendor_id"),
              ("dim_vendors", "dim_vendors", "vendor_key"), ("dim_vendors", "dim_vendors", "vendor_id"),
              ("dim_documents", "dim_documents", "document_key"), ("dim_documents", "dim_documents", "document_id"),
              ("fact_invoice_line_items", "fact_lines", "line_item_key"), ("fact_invoice_summary", "fact_summary", "summary_key")]
    not_null = unique + [("parsed_line_items", "lines", "document_id"), ("stg_parsed_invoices", "stg", "vendor_name"),
                         ("stg_parsed_invoices", "stg", "total_amount"), ("stg_parsed_line_items", "stg_lines", "document_id"),
                         ("dim_vendors", "dim_vendors", "vendor_name")]
    row = "SELECT '{}' AS check_name, '{}' AS model, '{}' AS column_name, CAST(count(*) AS BIGINT) AS failures FROM {}"
    parts = [row.format("unique", m, c, f"(SELECT {c} FROM {named(t)} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
             for m, t, c in unique]
    parts += [row.format("not_null", m, c, f"{named(t)} WHERE {c} IS NULL") for m, t, c in not_null]
    parts.append(row.format("accepted_values", "stg_parsed_invoices", "validation_status",
                            f"{named('stg')} WHERE validation_status NOT IN ('passed', 'failed', 'review_needed')"))
    parts.append(row.format("relationships", "parsed_line_items", "document_id",
                            f"{named('lines')} WHERE document_id IS NOT NULL AND document_id NOT IN (SELECT document_id FROM invoices)"))
    parts.append(row.format("totals_match", "dim_documents", "total_amount",
                            f"{named('dim_documents')} WHERE abs(total_amount - (subtotal + tax_amount)) > 0.02"))
    return on("\nUNION ALL\n".join(parts), *FACTS,
              "stg_lines AS (SELECT l.* FROM lines l JOIN stg s ON l.document_id = s.document_id)", *([PLANTED] if planted else []))


EDITS_CTE = """edits AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS document_id,
    CASE WHEN o_orderstatus = 'F' THEN '' ELSE '(312) 555-' || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') END AS phone,
    'PO-' || o_orderkey || CASE WHEN o_orderpriority = '1-URGENT' THEN '-R' ELSE '' END AS po,
    CASE WHEN o_orderstatus = 'O' THEN CAST(CAST(CAST(o_orderdate AS DATE) + 45 AS DATE) AS VARCHAR) ELSE '' END AS due
  FROM orders)"""



def render_sql() -> str:
    pad = lambda x, n: f"{x} || repeat(' ', greatest({n} - length({x}), 0))"
    right = lambda x, n: f"repeat(' ', greatest({n} - length({x}), 0)) || {x}"
    g = "format('{:g}', CAST(quantity AS DOUBLE))"
    amount = lambda label, col: f"({pad(label, 54)}) || ' ' || ({right(money(col), 12)})"
    nl = "chr(10)"
    parts = ["''", f"repeat('=', 60)", f"repeat(' ', 24) || 'INVOICE'", "repeat('=', 60)", "''", "vendor_name", "vendor_address",
             "vendor_city || ', ' || vendor_state || ' ' || vendor_zip", "'Phone: ' || vendor_phone", "'Email: ' || vendor_email",
             "''", "repeat('─', 60)", "''", "'Bill To:'", "bill_to_name", "bill_to_address",
             "bill_to_city || ', ' || bill_to_state || ' ' || bill_to_zip", "''", "'Invoice Number:  ' || invoice_number",
             "'Invoice Date:    ' || invoice_date", "'Due Date:        ' || due_date", "'PO Number:       ' || po_number", "''",
             "repeat('─', 60)", "'Description                           Qty   Unit Price       Amount'", "repeat('─', 60)",
             "item_text", "repeat('─', 60)", amount("'Subtotal:'", "subtotal"), amount("'Tax (8.00%):'", "tax_amount"),
             "repeat('═', 60)", amount("'TOTAL DUE:'", "total_amount"), "repeat('═', 60)", "''", "'Payment Terms: Net 30'",
             "'Thank you for your business!'", "''"]
    items = f"""item_texts AS (
  SELECT document_id, string_agg(({pad("description", 35)}) || ' ' || ({right(g, 5)}) || ' ' || ({right(money("unit_price"), 12)})
    || ' ' || ({right(money("line_amount"), 12)}), {nl} ORDER BY line_number) AS item_text
  FROM lines GROUP BY document_id),
texts AS (
  SELECT document_id, concat_ws({nl}, {", ".join(parts)}) AS raw_text
  FROM headers LEFT JOIN item_texts USING (document_id))"""
    return on("SELECT document_id, CAST(length(raw_text) AS BIGINT) AS text_length, md5(raw_text) AS text_md5 FROM texts",
              LINES_CTE, items, faults=False)


def insights_sql() -> str:
    desc = "list_extract(list(description ORDER BY line_amount DESC, line_number), 1)"
    return on(f"""SELECT document_id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY place) AS INTEGER) AS insight_number, kind, text
FROM remarks WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY place) <= 3""",
              LINES_CTE, f"""item_facts AS (
  SELECT document_id, count(*) AS n, max(line_amount) AS hi, min(line_amount) AS lo, {desc} AS top,
    CAST(sum(line_amount) AS DECIMAL(18,2)) AS amount,
    string_agg(format('{{:g}}', CAST(quantity AS DOUBLE)) || 'x ' || description, ', ' ORDER BY line_number) FILTER (quantity >= 50) AS bulk
  FROM lines GROUP BY document_id),
facts AS (SELECT f.*, h.total_amount, CAST(hi AS DOUBLE) / CAST(total_amount AS DOUBLE) * 100 AS pct
  FROM item_facts f JOIN headers h USING (document_id)),
remarks AS (
  SELECT document_id, 1 AS place, 'top_spend' AS kind, CASE WHEN pct > 50 THEN 'Top spend: ' || top || ' drives '
    || CAST(CAST(round_even(pct, 0) AS BIGINT) AS VARCHAR) || '% of this invoice ($' || {money("hi")} || ' of $' || {money("total_amount")} || ').' END AS text FROM facts
  UNION ALL SELECT document_id, 2, 'bulk_orders', 'Bulk orders: ' || bulk || '.' FROM facts
  UNION ALL SELECT document_id, 3, 'range', CASE WHEN n > 1 AND hi <> lo THEN 'Line items range from $' || {money("lo")} || ' to $'
    || {money("hi")} || ' (avg $' || {money(from_cents(half_up(cents("amount"), "n")))} || ').' END FROM facts
  UNION ALL SELECT document_id, 4, 'largest_item', CASE WHEN pct <= 50 THEN 'Largest item: ' || top || ' at $' || {money("hi")} || '.' END FROM facts)""",
              faults=False)


def digest_sql() -> str:
    nl, dash = "chr(10)", "repeat('-', 40)"
    right = lambda x: f"repeat(' ', greatest(12 - length({x}), 0)) || {x}"
    join = lambda *parts: f"concat_ws({nl}, {', '.join(parts)})"
    g = "format('{:g}', CAST(quantity AS DOUBLE))"
    percent = lambda x: f"CAST(CAST(round_even({x} * 100, 0) AS INTEGER) AS VARCHAR) || '%'"
    listed = lambda title, col, n: f"CASE WHEN {n} > 0 THEN {nl} || '{title} (' || {n} || '):' || {nl} || {col} END"
    header = join("'DOCUMENT SUMMARY'", "repeat('=', 40)", "'Invoice Number:  ' || invoice_number",
                  "'Invoice Date:    ' || strftime(invoice_date, '%B %d, %Y')", "'Due Date:        ' || strftime(due_date, '%B %d, %Y')",
                  "'Payment Terms:   Net ' || date_diff('day', invoice_date, due_date)", "'PO Reference:    ' || po_number")
    vendor = join("'VENDOR'", dash, "'Name:    ' || vendor_name",
                  "'Address: ' || vendor_address || ', ' || vendor_city || ', ' || vendor_state || ' ' || vendor_zip",
                  "'Phone:   ' || vendor_phone", "'Email:   ' || vendor_email")
    money_part = join("'FINANCIAL SUMMARY'", dash, f"'Subtotal:    $' || {right(money('subtotal'))}",
                      f"'Tax:         $' || {right(money('tax_amount'))} || '  (8.00%)'", "repeat('=', 30)",
                      f"'TOTAL:       $' || {right(money('total_amount'))} || '  USD'")
    quality = join("'DATA QUALITY'", dash, "'Status: ' || CASE validation_status WHEN 'passed' THEN 'PASSED - All checks OK' "
                   "WHEN 'failed' THEN 'FAILED - Errors found' ELSE 'REVIEW NEEDED - Warnings present' END",
                   "'Rules checked: ' || total_rules", "'Passed: ' || passed",
                   listed("Errors", "error_list", "errors"), listed("Warnings", "warning_list", "warnings"))
    score = join("'EXTRACTION QUALITY'", dash, f"'Confidence: ' || {percent('confidence')} || ' (' || CASE WHEN confidence >= 0.9 THEN 'High' "
                 "WHEN confidence >= 0.7 THEN 'Medium' ELSE 'Low' END || ')'", f"'Key fields extracted: ' || {percent(COMPLETION)}")
    items = f"""item_parts AS (
  SELECT document_id, {join("'LINE ITEMS (' || count(*) || ' items)'", dash,
    f"string_agg('  ' || line_number || '. ' || description || ' — Qty: ' || {g} || ' x $' || {money('unit_price')} || ' = $' || {money('line_amount')}, {nl} ORDER BY line_number)",
    f"{nl} || '  Highest value item: ' || list_extract(list(description ORDER BY line_amount DESC, line_number), 1) || ' ($' || {money('max(line_amount)')} || ')'")} AS item_part
  FROM lines GROUP BY document_id),
messages AS (
  SELECT document_id, string_agg('  - ' || message, {nl} ORDER BY rule_number) FILTER (severity = 'error') AS error_list,
    string_agg('  - ' || message, {nl} ORDER BY rule_number) FILTER (severity = 'warning') AS warning_list
  FROM rule_results WHERE NOT passed GROUP BY document_id),
scored AS (SELECT *, {CONFIDENCE} AS confidence FROM headers)"""
    return on(f"""SELECT document_id, concat_ws({nl} || {nl}, {header}, {vendor}, {money_part}, item_part, {quality}, {score}) AS digest
FROM scored JOIN statuses USING (document_id) LEFT JOIN item_parts USING (document_id) LEFT JOIN messages USING (document_id)""",
              *JUDGED, LINES_CTE, items, faults=False)


# Unicode white space and word characters for a regex engine whose own classes are ASCII.
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160)"


def pattern(p: str) -> str:
    inside = p.replace(r"[\w\-]", r"[\p{L}\p{N}_\-]").replace(r"[\s\-\.]", r"[\s\-\.\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]")
    inside = inside.replace(r"[\-\s]", r"[\-\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]").replace(r"[A-Za-z\s]", r"[A-Za-z\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]")
    out, i = "", 0
    depth = 0
    while i < len(inside):
        two = inside[i:i + 2]
        if inside[i] == "[" and not two == "\\[":
            depth = 1
        if inside[i] == "]":
            depth = 0
        if two == r"\s" and not depth:
            out, i = out + WS, i + 2
        elif two == r"\w" and not depth:
            out, i = out + WORD, i + 2
        elif two == r"\d" and not depth:
            out, i = out + r"\p{Nd}", i + 2
        elif two[0] == "\\":
            out, i = out + two, i + 2
        else:
            out, i = out + inside[i], i + 1
    return out.replace("'", "''")


def stripped(x: str) -> str:
    return f"trim({x}, {STRIP})"


def found(x: str, p: str, group: int = 1, flags: str = "(?i)") -> str:
    return f"nullif({stripped(f'''regexp_extract({x}, '{flags}{pattern(p)}', {group})''')}, '')"


PHONE = fv.PHONE_PATTERN
EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
CITY = r"([A-Za-z\s]+),\s*([A-Z]{2})\s+(\d{5}(?:-\d{4})?)"
TOTAL = r"^.*(?:TOTAL\s*(?:DUE|AMOUNT)?|Amount\s*Due)\s*:?\s*\$?([\d,]+\.\d{2})"


def doc_fields_sql() -> str:
    number = ", ".join(found("text", p) for p in (
        r"Invoice\s*(?:Number|No\.?|#)\s*:?\s*([A-Z0-9][\w\-]+)", r"(INV[\-\s]?\d{4}[\-\s]?\d{1,6})",
        r"Invoice\s*:\s*([A-Z0-9][\w\-]+)"))
    po = ", ".join(found("text", p) for p in (
        r"(?:PO|P\.O\.)\s*(?:Number|No\.?|#)\s*:?\s*([A-Z0-9][\w\-]+)", r"(PO[\-\s]?[\w\-]+\d+)", r"(MDOT[\-\s][\w\-]+)"))

    def day(label):
        forms = [(r"(\d{4}-\d{2}-\d{2})", "%Y-%m-%d"), (r"(\d{2}/\d{2}/\d{4})", "%m/%d/%Y"), (r"(\d{2}-\d{2}-\d{4})", "%m-%d-%Y"),
                 (r"(\w+ \d{1,2},?\s*\d{4})", "%B %d, %Y")]
        return "coalesce(" + ", ".join(
            f"CAST(try_strptime({found('text', label + r'''\s*:?\s*''' + p)}, '{fmt}') AS DATE)" for p, fmt in forms) + ")"

    dec = lambda x: f"TRY_CAST(replace({x}, ',', '') AS DECIMAL(12,2))"
    rated = r"Tax\s*\((\d+\.?\d*)%\)\s*:?\s*\$?([\d,]+\.\d{2})"
    items = rf"^(.+?)(\s\s+\d+(?:,\d{{3}})*(?:\.\d+)?|\s+\d+(?:,\d{{3}})*)\s+\$?([\d,]+\.\d{{2}})\s+\$?([\d,]+\.\d{{2}})\s*$"
    skip = r"^(Subtotal|Tax|TOTAL|Payment|Thank|Bill|Invoice|Due|PO )"
    return f"""WITH split AS (
  SELECT doc_id, text, list_transform(string_split(text, chr(10)), lambda x: {stripped("x")}) AS lines FROM documents),
kept AS (
  SELECT *, list_filter(lines, lambda x: x <> '' AND NOT regexp_matches(x, '^[=─\\-═]+$') AND upper(x) <> 'INVOICE') AS vendor_lines,
    list_extract(list_filter(list_transform(list_filter(lines, lambda x: NOT regexp_matches(x, '(?i)^Subtotal')),
      lambda x: regexp_extract(x, '(?i){pattern(TOTAL)}', 1)), lambda x: x <> ''), 1) AS total_text,
    len(list_filter(lines, lambda x: regexp_matches(x, '{pattern(items)}') AND NOT regexp_matches(x, '(?i)^Description{WS}+Qty')
      AND NOT regexp_matches(x, '(?i){skip}'))) AS n_items
  FROM split),
placed AS (
  SELECT *, list_extract(list_filter(vendor_lines[3:], lambda x: {found("x", CITY, 1, "")} IS NOT NULL), 1) AS place FROM kept),
headers AS (
  SELECT doc_id, coalesce({number}) AS invoice_number, {day("Invoice Date")} AS invoice_date, {day("Due Date")} AS due_date,
    coalesce({po}) AS po_number, vendor_lines[1] AS vendor_name, vendor_lines[2] AS vendor_address,
    {found("place", CITY, 1, "")} AS vendor_city, {found("place", CITY, 2, "")} AS vendor_state, {found("place", CITY, 3, "")} AS vendor_zip,
    {found("text", PHONE, 0, "")} AS vendor_phone, {found("text", EMAIL, 0, "")} AS vendor_email,
    {dec(found("text", r"Subtotal\s*:?\s*\$?([\d,]+\.\d{2})"))} AS subtotal,
    CAST(CAST({found("text", rated, 1)} AS DOUBLE) / 100 AS DECIMAL(10,8)) AS tax_rate,
    {dec("coalesce(" + found("text", rated, 2) + ", " + found("text", r"Tax\s*:?\s*\$?([\d,]+\.\d{2})") + ")")} AS tax_amount,
    {dec("total_text")} AS total_amount, CAST(n_items AS BIGINT) AS n_items, CAST(NULL AS VARCHAR) AS bill_to_name, 0 AS items_total
  FROM placed)
SELECT doc_id, invoice_number, invoice_date, due_date, po_number, vendor_name, vendor_address, vendor_city, vendor_state, vendor_zip,
  vendor_phone, vendor_email, subtotal, tax_rate, tax_amount, total_amount, n_items AS line_item_count,
  {CONFIDENCE} AS parse_confidence, {COMPLETION} AS key_field_rate FROM headers"""


def upsert_sql() -> str:
    flags = f"parse_timestamp < {SPLIT}"
    first = lambda c: f"arg_min(struct_pack(v := {c}), struct_pack(t := parse_timestamp, d := document_id)).v AS {c}"
    return on(f"""SELECT coalesce(e.vendor_id, l.vendor_id) AS vendor_id, CASE WHEN l.vendor_id IS NULL THEN e.vendor_name ELSE l.vendor_name END AS vendor_name,
  CASE WHEN e.vendor_id IS NULL THEN l.vendor_address ELSE e.vendor_address END AS vendor_address,
  CASE WHEN e.vendor_id IS NULL THEN l.vendor_city ELSE e.vendor_city END AS vendor_city,
  CASE WHEN e.vendor_id IS NULL THEN l.vendor_state ELSE e.vendor_state END AS vendor_state,
  CASE WHEN e.vendor_id IS NULL THEN l.vendor_zip ELSE e.vendor_zip END AS vendor_zip,
  CASE WHEN l.vendor_id IS NULL THEN e.vendor_phone ELSE l.vendor_phone END AS vendor_phone,
  CASE WHEN l.vendor_id IS NULL THEN e.vendor_email ELSE l.vendor_email END AS vendor_email,
  CASE WHEN e.vendor_id IS NULL THEN {AS_OF} ELSE DATE '2000-01-01' END AS first_seen_date,
  coalesce(e.n, 0) + coalesce(l.n, 0) AS document_count,
  CASE WHEN e.vendor_id IS NULL THEN CAST({AS_OF} AS TIMESTAMP) ELSE {SPLIT} END AS created_at,
  CASE WHEN l.vendor_id IS NULL THEN {SPLIT} ELSE CAST({AS_OF} AS TIMESTAMP) END AS updated_at
FROM (SELECT * FROM sides WHERE early) e FULL JOIN (SELECT * FROM sides WHERE NOT early) l ON e.vendor_id = l.vendor_id""",
              *INVOICES, f"""fit AS (SELECT *, {SHA16} AS vendor_id, {flags} AS early FROM invoices WHERE validation_status <> 'failed'),
firsts AS (SELECT * FROM fit QUALIFY row_number() OVER (PARTITION BY vendor_id, early ORDER BY parse_timestamp, document_id) = 1),
lasts AS (SELECT * FROM fit QUALIFY row_number() OVER (PARTITION BY vendor_id, early ORDER BY parse_timestamp DESC, document_id DESC) = 1),
sides AS (SELECT f.vendor_id, f.early, l.vendor_name, f.vendor_address, f.vendor_city, f.vendor_state, f.vendor_zip, l.vendor_phone,
  l.vendor_email, (SELECT count(*) FROM fit x WHERE x.vendor_id = f.vendor_id AND x.early = f.early) AS n
  FROM firsts f JOIN lasts l ON f.vendor_id = l.vendor_id AND f.early = l.early)""")


UPLOADS = """WITH raw AS (
  SELECT 'doc-' || doc_id || CASE doc_id % 5 WHEN 1 THEN '.pdf' WHEN 2 THEN '.csv' WHEN 3 THEN '.TXT' ELSE '.txt' END AS path, text,
    CASE doc_id % 5 WHEN 1 THEN 'pdf' WHEN 2 THEN 'csv' ELSE 'txt' END AS kind, doc_id % 10 = 4 AS broken FROM documents),
bytes AS (SELECT *, CASE WHEN broken THEN '\\xFF'::BLOB || encode(text) ELSE encode(text) END AS content FROM raw),
uploads AS (
  SELECT substr(sha256(path || chr(10) || sha256(CASE WHEN kind = 'txt' THEN content ELSE ''::BLOB END)), 1, 32) AS document_id,
    path, kind, CAST(octet_length(content) AS BIGINT) AS size,
    CASE WHEN kind = 'txt' AND NOT broken THEN regexp_replace(text, '\\r\\n?', chr(10), 'g') END AS text,
    CASE WHEN kind = 'txt' THEN '{"source":"text_file","encoding":"utf-8"}' ELSE '{}' END AS metadata,
    CASE WHEN kind = 'csv' THEN 'unsupported_file_type' WHEN kind = 'pdf' THEN 'pdf_text_not_available' WHEN broken THEN 'not_utf8' END AS reject_reason
  FROM bytes)
"""


def oracle_sql() -> dict[str, str]:
    vendors_loaded = on(f"""SELECT {SHA16} AS vendor_id, vendor_name, vendor_address, min(vendor_city) AS vendor_city, min(vendor_state) AS vendor_state,
  min(vendor_zip) AS vendor_zip, min(vendor_phone) AS vendor_phone, min(vendor_email) AS vendor_email, {AS_OF} AS first_seen_date, count(*) AS document_count
FROM invoices WHERE validation_status <> 'failed' GROUP BY vendor_name, vendor_address""", *INVOICES, faults=False)
    summary_loaded = on(f"""SELECT i.document_id, coalesce(n, 0) AS total_line_items, subtotal, tax_amount, total_amount,
  {from_cents(half_up(cents("amount"), "k"))} AS avg_line_item_amount, hi AS max_line_item_amount, invoice_date, {SHA16} AS vendor_id
FROM invoices i LEFT JOIN (SELECT document_id, count(*) AS n, count(nullif(line_amount, 0)) AS k, CAST(sum(line_amount) AS DECIMAL(18,2)) AS amount,
  max(nullif(line_amount, 0)) AS hi FROM lines GROUP BY document_id) s ON i.document_id = s.document_id
WHERE validation_status <> 'failed'""", *INVOICES, LINES_CTE, faults=False)
    silver = ", ".join(SILVER)
    brief = f"""concat_ws(' ', 'Invoice ' || invoice_number, 'from ' || vendor_name, 'for $' || {money("total_amount")},
  'dated ' || strftime(invoice_date, '%b %d, %Y'))"""
    return {
        "stg_invoices": on("SELECT * FROM stg", *STAGED),
        "stg_line_items": on("""SELECT line_item_id, l.document_id, line_number, trim(description) AS description, quantity, unit_price,
  line_amount, parse_confidence AS extraction_confidence FROM lines l JOIN invoices i ON l.document_id = i.document_id
WHERE l.document_id IN (SELECT document_id FROM stg)""", *STAGED, LINES_CTE),
        "int_cleaned": on("SELECT * FROM cleaned", *CLEANED),
        "vendors_latest": on("SELECT * FROM vendors", *VENDORS),
        "dim_vendors": on("SELECT * FROM dim_vendors", *DIMS),
        "dim_documents": on("SELECT * FROM dim_documents", *DIMS),
        "fact_line_items": on("SELECT * FROM fact_lines", *FACTS),
        "fact_summary": on("SELECT * FROM fact_summary", *FACTS),
        "kpis": on("""SELECT count(*) AS total_invoices, CAST(coalesce(sum(total_amount), 0) AS DECIMAL(38,2)) AS total_spend,
  count(DISTINCT vendor_name) AS num_vendors FROM fact_summary s LEFT JOIN dim_vendors v ON s.vendor_key = v.vendor_key""", *FACTS),
        "spend_by_vendor": on("""SELECT vendor_name, CAST(coalesce(sum(total_amount), 0) AS DECIMAL(38,2)) AS total_amount
FROM fact_summary s LEFT JOIN dim_vendors v ON s.vendor_key = v.vendor_key WHERE vendor_name IS NOT NULL
GROUP BY vendor_name ORDER BY total_amount, vendor_name""", *FACTS),
        "spend_by_date": on("""SELECT invoice_date, CAST(coalesce(sum(total_amount), 0) AS DECIMAL(38,2)) AS total_amount
FROM fact_summary WHERE invoice_date IS NOT NULL GROUP BY invoice_date ORDER BY invoice_date""", *FACTS),
        "summary_by_date_desc": on("""SELECT document_key, vendor_name, total_amount, subtotal, tax_amount, total_line_items, invoice_date
FROM fact_summary s LEFT JOIN dim_vendors v ON s.vendor_key = v.vendor_key ORDER BY invoice_date DESC NULLS FIRST, document_key""", *FACTS),
        "top_line_items": on("""SELECT description AS "Description", quantity AS "Qty", unit_price AS "Unit Price", line_amount AS "Amount",
  vendor_name AS "Vendor" FROM fact_lines l LEFT JOIN dim_vendors v ON l.vendor_key = v.vendor_key
ORDER BY line_amount DESC NULLS FIRST, line_item_key LIMIT 5""", *FACTS),
        "recent_submissions": on(f"""SELECT invoice_number AS "Invoice #", vendor_name AS "Vendor",
  CASE WHEN coalesce(total_amount, 0) <> 0 THEN '$' || {money("total_amount")} ELSE '--' END AS "Total",
  coalesce(CAST(invoice_date AS VARCHAR), '--') AS "Invoice Date",
  CASE validation_status WHEN 'passed' THEN 'Passed' WHEN 'failed' THEN 'Needs Review' WHEN 'review_needed' THEN 'Needs Review' ELSE coalesce(validation_status, '--') END AS "Status",
  strftime(parse_timestamp, '%b %d, %Y %I:%M %p') AS "Submitted"
FROM invoices ORDER BY parse_timestamp DESC, document_id LIMIT 10""", *INVOICES),
        "loader_summary": on(f"""SELECT i.document_id, coalesce(n, 0) AS total_line_items, subtotal, tax_amount, total_amount,
  {from_cents(half_up(cents("amount"), "k"))} AS avg_line_item_amount, hi AS max_line_item_amount, invoice_date
FROM invoices i LEFT JOIN (SELECT document_id, count(*) AS n, count(nullif(line_amount, 0)) AS k, CAST(sum(line_amount) AS DECIMAL(18,2)) AS amount,
  max(nullif(line_amount, 0)) AS hi FROM lines GROUP BY document_id) s ON i.document_id = s.document_id
WHERE validation_status <> 'failed'""", *INVOICES, LINES_CTE),
        "dq_report": dq(),
        "totals_mismatch": on("""SELECT document_id AS document_key, invoice_number, subtotal, tax_amount, total_amount,
  CAST(subtotal + tax_amount AS DECIMAL(13,2)) AS expected_total, CAST(abs(total_amount - (subtotal + tax_amount)) AS DECIMAL(14,2)) AS difference
FROM headers WHERE abs(total_amount - (subtotal + tax_amount)) > 0.02"""),
        "validate_rules": on("SELECT * FROM rule_results", RULES_CTE),
        "rule_summary": on("""SELECT h.document_id, h.invoice_number, validation_status AS status, total_rules, passed, errors, warnings
FROM headers h JOIN statuses s ON h.document_id = s.document_id""", *JUDGED),
        "validate_status": on("SELECT validation_status, count(*) AS invoices FROM statuses GROUP BY validation_status", *JUDGED),
        "rule_failures": on("SELECT rule_name, severity, count(*) AS failures FROM rule_results WHERE NOT passed GROUP BY rule_name, severity", RULES_CTE),
        "gold_rejects": on("""SELECT h.document_id, invoice_number, 'validation_failed' AS reason, errors FROM headers h JOIN (
  SELECT document_id, string_agg(message, '; ' ORDER BY rule_number) AS errors FROM rule_results
  WHERE NOT passed AND severity = 'error' GROUP BY document_id) e ON h.document_id = e.document_id""", RULES_CTE),
        "load_status": on(f"""SELECT h.document_id, CASE WHEN errors > 0 THEN 'rejected' ELSE 'loaded' END AS status,
  CASE WHEN errors > 0 THEN 'validation_failed' END AS reason, CASE WHEN errors = 0 THEN {SHA16} END AS vendor_id
FROM headers h JOIN statuses s ON h.document_id = s.document_id""", *JUDGED),
        "completion_rate": on(f"SELECT document_id, {CONFIDENCE} AS parse_confidence, {COMPLETION} AS key_field_rate FROM headers"),
        "vendor_id_sha16": on(f"SELECT document_id, {SHA16} AS vendor_id FROM headers"),
        "parse_currency": f"""WITH raw AS (
  SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS p, o_orderpriority AS pr,
    CASE o_orderstatus WHEN 'F' THEN 'USD' WHEN 'O' THEN 'EUR' ELSE 'XXX' END AS code FROM orders),
texts AS (SELECT *, CASE pr WHEN '1-URGENT' THEN '$' || {money("p")} WHEN '2-HIGH' THEN ' €' || p || ' ' WHEN '3-MEDIUM' THEN '£99999' || p
  WHEN '4-NOT SPECIFIED' THEN p || ' approx' ELSE '¥' || p || '5' END AS written FROM raw)
SELECT o_orderkey, written, TRY_CAST(trim(regexp_replace(written, '[\\$€£¥,]', '', 'g')) AS DECIMAL(12,2)) AS amount,
  CASE code WHEN 'USD' THEN 'US Dollar' WHEN 'EUR' THEN 'Euro' END AS currency_name, CASE code WHEN 'USD' THEN '$' WHEN 'EUR' THEN '€' END AS symbol FROM texts""",
        "edits_applied": on("""SELECT i.document_id, invoice_number, po AS po_number, coalesce(CAST(nullif(due, '') AS DATE), due_date) AS due_date,
  vendor_name, coalesce(nullif(phone, ''), vendor_phone) AS vendor_phone, validation_status
FROM invoices i JOIN edits e ON i.document_id = e.document_id""", *INVOICES, EDITS_CTE),
        "edits_log": on("""SELECT h.document_id, 'PO Number' AS field, po_number AS original, po AS edited FROM headers h JOIN edits e ON h.document_id = e.document_id WHERE po <> po_number
UNION ALL SELECT h.document_id, 'Phone', vendor_phone, phone FROM headers h JOIN edits e ON h.document_id = e.document_id
WHERE vendor_phone <> '' AND phone <> '' AND phone <> vendor_phone""", EDITS_CTE),
        "vendor_upsert": upsert_sql(),
        "rendered_texts": render_sql(),
        "roundtrip_header": on("""SELECT document_id, invoice_number, invoice_date, due_date, po_number, subtotal, tax_rate, tax_amount,
  total_amount, currency FROM headers""", faults=False),
        "roundtrip_parties": on("""SELECT document_id, vendor_name, vendor_address, vendor_city, vendor_state, vendor_zip, vendor_phone,
  vendor_email, bill_to_name, bill_to_address, bill_to_city, bill_to_state, bill_to_zip FROM headers""", faults=False),
        "roundtrip_items": on("""SELECT document_id, CAST(line_number AS BIGINT) AS line_number, description, quantity, unit_price,
  line_amount AS amount FROM lines""", LINES_CTE, faults=False),
        "confidence": on(f"""SELECT document_id, {CONFIDENCE} AS parse_confidence, {COMPLETION} AS key_field_rate, n_items AS line_item_count
FROM headers""", faults=False),
        "digest_brief": on(f"SELECT document_id, {brief} AS digest_brief FROM headers", faults=False),
        "digest_full": digest_sql(),
        "insights": insights_sql(),
        "default_amounts": """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(12,2))
  ELSE CAST(l_quantity * CAST(round(l_extendedprice * 100) AS BIGINT) / 100 AS DECIMAL(12,2)) END AS amount FROM lineitem""",
        "run_counts": on("""SELECT count(*) AS found, count(*) AS parsed, count(*) AS extracted, count(*) FILTER (validation_status <> 'failed') AS loaded
FROM headers JOIN statuses USING (document_id)""", *JUDGED, faults=False),
        "doc_contacts": f"SELECT doc_id, {found('text', PHONE, 0, '')} AS phone, {found('text', EMAIL, 0, '')} AS email FROM documents",
        "doc_fields": doc_fields_sql(),
        "bronze_documents": """SELECT substr(sha256(CAST(doc_id AS VARCHAR) || chr(10) || text), 1, 32) AS document_id, 'unknown' AS file_name, 'txt' AS file_type,
  CAST(strlen(text) AS BIGINT) AS file_size_bytes, text AS raw_text, '[]' AS raw_tables_json, '{}' AS metadata_json,
  TIMESTAMP '2001-08-01 00:00:00' AS ingestion_timestamp, CAST(doc_id AS VARCHAR) AS source_path FROM documents""",
        "silver_invoices": on(f"SELECT {silver} FROM invoices", *INVOICES),
        "silver_line_items": on("""SELECT line_item_id, l.document_id, line_number, description, quantity, unit_price, line_amount,
  parse_confidence AS extraction_confidence FROM lines l JOIN invoices i ON l.document_id = i.document_id""", *INVOICES, LINES_CTE),
        "ingest_files": r"""WITH t AS (SELECT strlen(text) + 1 AS size, regexp_replace(text || chr(10), '\r\n?', chr(10), 'g') AS text FROM documents)
SELECT 'txt' AS file_type, CAST(size AS BIGINT) AS file_size_bytes, CAST(length(text) AS BIGINT) AS text_length, md5(text) AS text_md5,
  CAST(NULL AS VARCHAR) AS reject_reason FROM t""",
        "stream_ingest": on(f"SELECT {silver.replace('parse_timestamp', '''TIMESTAMP '2001-08-01 00:00:00' AS parse_timestamp''')} FROM invoices",
                            *INVOICES, faults=False),
        "stream_vendors": vendors_loaded,
        "stream_line_facts": on(f"""SELECT i.document_id, {SHA16} AS vendor_id, line_number, description, quantity, unit_price, line_amount
FROM lines l JOIN invoices i ON l.document_id = i.document_id WHERE validation_status <> 'failed'""", *INVOICES, LINES_CTE, faults=False),
        "stream_documents": on(f"""SELECT document_id, {SHA16} AS vendor_id, 'invoice' AS document_type, CAST(NULL AS VARCHAR) AS file_name, invoice_number,
  invoice_date, due_date, po_number, subtotal, tax_amount, total_amount, currency, parse_confidence, TIMESTAMP '2001-08-01 00:00:00' AS upload_timestamp
FROM invoices WHERE validation_status <> 'failed'""", *INVOICES, faults=False),
        "stream_summary": summary_loaded,
        "stream_duplicates": summary_loaded,
        "stream_duplicate_vendors": vendors_loaded,
        "dry_run": summary_loaded,
        "mart_files": on("SELECT * FROM fact_summary", *FACTS),
        "bronze_files": UPLOADS + """SELECT document_id, path AS file_name, kind AS file_type, size AS file_size_bytes, coalesce(text, '') AS raw_text,
  '[]' AS raw_tables_json, metadata AS metadata_json, TIMESTAMP '2001-08-01 00:00:00' AS ingestion_timestamp, path AS source_path FROM uploads""",
        "file_rejects": UPLOADS + """SELECT document_id, path AS file_name, kind AS file_type, size AS file_size_bytes, path AS source_path, reject_reason
FROM uploads WHERE reject_reason IS NOT NULL""",
        "compact_json": UPLOADS + """SELECT document_id, '{"tables":[],"metadata":' || metadata || ',"file_name":"' || path || '","file_type":"' || kind
  || '","file_size_bytes":' || size || CASE WHEN text IS NULL THEN '' ELSE ',"text_length":' || length(text) END || '}' AS json FROM uploads""",
        "stream_files": """SELECT 'doc-' || doc_id AS name, CASE WHEN doc_id % 5 = 1 THEN 'gz' ELSE 'txt' END AS file_type,
  md5(CASE WHEN doc_id % 5 = 1 OR doc_id % 10 = 4 THEN '' ELSE regexp_replace(text || chr(10), '\\r\\n?', chr(10), 'g') END) AS text_md5,
  CASE WHEN doc_id % 5 = 1 THEN 'unsupported_file_type' WHEN doc_id % 10 = 4 THEN 'not_utf8' END AS reject_reason, reject_reason AS dead_letter FROM documents""",
        "load_dead_letters": UPLOADS + """SELECT document_id, path AS file_name, md5(coalesce(text, '')) AS text_md5, reject_reason, reject_reason IS NULL AS parsed FROM uploads""",
        "extraction_rejects": on("""SELECT document_id, CASE CAST(document_id AS BIGINT) % 6 WHEN 0 THEN 'subtotal' WHEN 1 THEN 'tax_amount' WHEN 2 THEN 'tax_rate'
    WHEN 3 THEN 'total_amount' ELSE 'line_item' END || '_out_of_range' AS reason
FROM headers WHERE CAST(document_id AS BIGINT) % 6 < 4 OR CAST(document_id AS BIGINT) % 6 = 4 AND n_items > 0""", faults=False),
        "vendor_stamps": on(f"""SELECT {SHA16} AS vendor_id, CAST(min(day) AS DATE) AS first_seen_date, count(*) AS document_count, min(day) AS created_at, max(day) AS updated_at
FROM (SELECT *, TIMESTAMP '2001-08-01 00:00:00' + INTERVAL (CAST(document_id AS BIGINT) % 3) DAY AS day FROM invoices WHERE validation_status <> 'failed')
GROUP BY vendor_name, vendor_address""", *INVOICES, faults=False),
        "layouts_header": on("""SELECT document_id, invoice_number, invoice_date, due_date,
  CASE WHEN CAST(document_id AS BIGINT) % 4 = 3 THEN 'MDOT-' || document_id ELSE po_number END AS po_number, subtotal,
  CASE WHEN CAST(document_id AS BIGINT) % 3 <> 1 THEN tax_rate END AS tax_rate, tax_amount, total_amount FROM headers""", faults=False),
        "layouts_items": on("""SELECT document_id, CAST(line_number AS BIGINT) AS line_number, description, quantity, unit_price,
  line_amount AS amount FROM lines""", LINES_CTE, faults=False),
        "discovered": "SELECT 'txt' AS file_type, CAST(strlen(text) + 1 AS BIGINT) AS file_size_bytes FROM documents",
        "currency_from_csv": """WITH s AS (
  SELECT s_suppkey AS k, s_name, chr(CAST(65 + s_suppkey // 676 % 26 AS INT)) || chr(CAST(65 + s_suppkey // 26 % 26 AS INT)) || chr(CAST(65 + s_suppkey % 26 AS INT)) AS code FROM supplier)
SELECT CASE WHEN k % 5 = 2 THEN '1' ELSE '' END || code AS currency_code, s_name AS currency_name, CASE WHEN k % 5 <> 1 THEN CAST(k AS VARCHAR) END AS symbol,
  CASE k % 5 WHEN 1 THEN code || ',' || s_name WHEN 2 THEN '1' || code || ',' || s_name || ',' || k WHEN 3 THEN code || ',' || s_name || ',' || k || ',more' END AS line,
  CASE k % 5 WHEN 1 THEN 'wrong_number_of_columns' WHEN 2 THEN 'bad_currency_code' WHEN 3 THEN 'wrong_number_of_columns' END AS reject_reason FROM s""",
        "mart_sql": on("""SELECT vendor_id, count(DISTINCT d.document_id) AS documents, CAST(sum(s.total_amount) AS DECIMAL(38,2)) AS spend, CAST(sum(s.total_line_items) AS BIGINT) AS items,
  CAST(max(l.line_amount) AS DECIMAL(38,2)) AS line_amount
FROM fact_summary s JOIN dim_vendors v ON s.vendor_key = v.vendor_key JOIN dim_documents d ON s.document_key = d.document_key
LEFT JOIN (SELECT vendor_key, sum(line_amount) AS line_amount FROM fact_lines GROUP BY vendor_key) l ON l.vendor_key = v.vendor_key GROUP BY vendor_id""", *FACTS),
        "dq_report_faulty": dq(planted=True),
        "rule_failures_planted": planted_rules_sql(),
    }
