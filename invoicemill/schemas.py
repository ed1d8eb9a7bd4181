"""Table schemas. Text lengths of the warehouse columns are documentation, not enforced."""

PARTY = "name STRING, address STRING, city STRING, state STRING, zip STRING"
VENDOR = f"STRUCT<{PARTY.replace(' STRING', ': STRING')}, phone: STRING, email: STRING>"
BILL_TO = f"STRUCT<{PARTY.replace(' STRING', ': STRING')}>"
LINE_ITEM = ("STRUCT<line_number: INT, description: STRING, quantity: DECIMAL(18,6), "
             "unit_price: DECIMAL(12,2), amount: DECIMAL(12,2)>")

RAW_TABLES = "ARRAY<STRUCT<page: INT, data: ARRAY<ARRAY<STRING>>>>"

BRONZE = ("document_id STRING, file_name STRING, file_type STRING, file_size_bytes BIGINT, raw_text STRING, "
          "raw_tables_json STRING, metadata_json STRING, ingestion_timestamp TIMESTAMP_NTZ, source_path STRING")

SILVER_INVOICES = (
    "document_id STRING, vendor_name STRING, vendor_address STRING, vendor_city STRING, vendor_state STRING, "
    "vendor_zip STRING, vendor_phone STRING, vendor_email STRING, invoice_number STRING, invoice_date DATE, "
    "due_date DATE, po_number STRING, subtotal DECIMAL(12,2), tax_amount DECIMAL(12,2), total_amount DECIMAL(12,2), "
    "currency STRING, parse_confidence DOUBLE, validation_status STRING, parse_timestamp TIMESTAMP_NTZ"
)
# Columns we keep beyond the warehouse table: what was extracted but had no home, and the
# number of line items, which later joins use to find oversized documents.
SILVER_EXTRA = (
    "tax_rate DECIMAL(10,8), bill_to_name STRING, bill_to_address STRING, bill_to_city STRING, "
    "bill_to_state STRING, bill_to_zip STRING, line_item_count BIGINT"
)
SILVER_LINE_ITEMS = (
    "line_item_id STRING, document_id STRING, line_number INT, description STRING, quantity DECIMAL(10,2), "
    "unit_price DECIMAL(12,2), line_amount DECIMAL(12,2), extraction_confidence DOUBLE"
)
VENDOR_DIMENSION = (
    "vendor_id STRING, vendor_name STRING, vendor_address STRING, vendor_city STRING, vendor_state STRING, "
    "vendor_zip STRING, vendor_phone STRING, vendor_email STRING, first_seen_date DATE, document_count BIGINT, "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)
EDITS = "document_id STRING, field STRING, value STRING"
CURRENCY_CODES = "currency_code STRING, currency_name STRING, symbol STRING"


def names(ddl: str) -> list[str]:
    """Column names of a flat table schema."""
    return [part.split()[0] for part in ddl.replace("(12,2)", "").replace("(10,2)", "").replace("(10,8)", "").split(", ")]
