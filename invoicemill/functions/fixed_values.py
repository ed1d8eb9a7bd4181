"""Values that results depend on, stated as they are.

Fixed values: patterns, labels, formats, word lists, limits and weights. They must
stay exactly so for extraction, validation and digests to give the expected results.
Patterns are written in the common regex notation; ``text.rx`` turns them into the
dialect of the JVM.
"""

# ---- header fields: tried in this order, first hit wins, case ignored ----
INVOICE_NUMBER_PATTERNS = [
    r"Invoice\s*(?:Number|No\.?|#)\s*:?\s*([A-Z0-9][\w\-]+)",
    r"(INV[\-\s]?\d{4}[\-\s]?\d{1,6})",
    r"Invoice\s*:\s*([A-Z0-9][\w\-]+)",
]
PO_NUMBER_PATTERNS = [
    r"(?:PO|P\.O\.)\s*(?:Number|No\.?|#)\s*:?\s*([A-Z0-9][\w\-]+)",
    r"(PO[\-\s]?[\w\-]+\d+)",
    r"(MDOT[\-\s][\w\-]+)",
]
DATE_LABEL_GAP = r"\s*:?\s*"
DATE_NUMERIC_FORMS = [
    (r"(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd"),
    (r"(\d{2}/\d{2}/\d{4})", "MM/dd/yyyy"),
    (r"(\d{2}-\d{2}-\d{4})", "MM-dd-yyyy"),
]
DATE_MONTH_NAME_FORM = r"(\w+ \d{1,2},?\s*\d{4})"
DATE_MONTH_NAME_FORMATS = ["MMMM d, yyyy", "MMMM d yyyy", "MMM d, yyyy", "MMM d yyyy"]
INVOICE_DATE_LABEL = "Invoice Date"
DUE_DATE_LABEL = "Due Date"

# ---- parties ----
PHONE_PATTERN = r"\(?\d{3}\)?[\s\-\.]?\d{3}[\s\-\.]?\d{4}"
EMAIL_PATTERN = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
CITY_STATE_ZIP_PATTERN = r"([A-Za-z\s]+),\s*([A-Z]{2})\s+(\d{5}(?:-\d{4})?)"
BILL_TO_SPLIT_PATTERN = r"Bill\s*To\s*:?"
BILL_TO_SECTION_PATTERN = r"Bill\s*To\s*:?\s*\n(.*?)(?=Invoice\s*(?:Number|No|#|Date)|[─═\-]{10,})"
RULE_LINE_PATTERN = r"^[=─\-═]+$"
TITLE_LINE = "INVOICE"

# ---- money ----
SUBTOTAL_PATTERN = r"Subtotal\s*:?\s*\$?([\d,]+\.\d{2})"
TAX_WITH_RATE_PATTERN = r"Tax\s*\((\d+\.?\d*)%\)\s*:?\s*\$?([\d,]+\.\d{2})"
TAX_PATTERN = r"Tax\s*:?\s*\$?([\d,]+\.\d{2})"
TOTAL_PATTERN = r".*(?:TOTAL\s*(?:DUE|AMOUNT)?|Amount\s*Due)\s*:?\s*\$?([\d,]+\.\d{2})"
TOTAL_SKIP_PATTERN = r"Subtotal"
DEFAULT_CURRENCY = "USD"

# ---- line items: wide columns first, then single-blank columns ----
ITEM_WIDE_PATTERN = r"^(.+?)\s{2,}(\d+(?:,\d{3})*(?:\.\d+)?)\s+\$?([\d,]+\.\d{2})\s+\$?([\d,]+\.\d{2})\s*$"
ITEM_NARROW_PATTERN = r"^(.+?)\s+(\d+(?:,\d{3})*)\s+\$?([\d,]+\.\d{2})\s+\$?([\d,]+\.\d{2})\s*$"
ITEM_HEADER_PATTERN = r"Description\s+Qty"
ITEM_SKIP_PATTERN = r"^(Subtotal|Tax|TOTAL|Payment|Thank|Bill|Invoice|Due|PO )"
ITEM_SKIP_DESCRIPTIONS = ["description", "item", ""]

# ---- confidence weights and tolerances ----
CONFIDENCE_WEIGHTS = {
    "invoice_number": 3, "vendor_name": 3, "total_amount": 3,
    "invoice_date": 2, "due_date": 2, "line_items": 2,
    "bill_to_name": 1, "po_number": 1, "subtotal": 1, "tax_amount": 1,
    "items_match_subtotal": 2,
}
AMOUNT_TOLERANCE = "0.02"
MAX_INVOICE_AGE_DAYS = 365
MAX_DAYS_AHEAD = 30
INVOICE_NUMBER_FORMAT = r"^[A-Za-z0-9\-\.\/]+$"

# ---- statuses, severities, labels ----
PASSED, FAILED, REVIEW_NEEDED = "passed", "failed", "review_needed"
ERROR, WARNING = "error", "warning"
ACCEPTED_STATUSES = [PASSED, REVIEW_NEEDED]
STATUS_VALUES = [PASSED, FAILED, REVIEW_NEEDED]
STATUS_DIGEST_LABELS = {
    PASSED: "PASSED - All checks OK",
    FAILED: "FAILED - Errors found",
    REVIEW_NEEDED: "REVIEW NEEDED - Warnings present",
}
STATUS_LIST_LABELS = {PASSED: "Passed", FAILED: "Needs Review", REVIEW_NEEDED: "Needs Review"}
QUALITY_BANDS = [("0.9", "High"), ("0.7", "Medium")]
QUALITY_LOWEST = "Low"

# ---- star schema and reports ----
HIGH_VALUE_AMOUNT = 10000
DOCUMENT_TYPE = "invoice"
TOP_LINE_ITEMS = 5
RECENT_SUBMISSIONS = 10
MAX_INSIGHTS = 3
BULK_QUANTITY = 50
TOP_SPEND_PERCENT = 50
CURRENCY_SYMBOLS_PATTERN = r"[\$€£¥,]"
CURRENCY_CODE_PATTERN = r"^[A-Z]{3}$"
OUTER_SPACE_PATTERN = r"^\s+|\s+$"
CURRENCY_CODES = [
    ("USD", "US Dollar", "$"),
    ("EUR", "Euro", "€"),
    ("GBP", "British Pound", "£"),
    ("CAD", "Canadian Dollar", "C$"),
    ("AUD", "Australian Dollar", "A$"),
    ("JPY", "Japanese Yen", "¥"),
]

# ---- ingest ----
SUPPORTED_FILE_TYPES = ["pdf", "txt"]
TEXT_METADATA = {"source": "text_file", "encoding": "utf-8"}
