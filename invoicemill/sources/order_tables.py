"""Orders read as invoices: each order is one, its customer plays the vendor.

``invoices`` and ``line_items`` give cleaned-layer rows. ``faults=True`` plants the kinds of defects that
rules and checks must find; without faults the rows are what a rendered text must yield again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from invoicemill.functions.numbers import MONEY, QUANTITY, TAX_RATE
from invoicemill.operators.extract import confidence
from invoicemill.operators.hot_keys import join_to_unique, numbers_within
from invoicemill.operators.render import render
from invoicemill.operators.validate import validate
from invoicemill.schemas import SILVER_EXTRA, SILVER_INVOICES, SILVER_LINE_ITEMS, names
from invoicemill.session import COMPACT, TEXT_GROUPS, written

AS_OF = "2001-08-01"     # last order date of the tables; date rules compare with it
RATE = "0.08"
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str):
    return F.col(name).cast("string")


def _digits(name: str, width: int):
    return F.lpad((F.col(name) % 10 ** width).cast("string"), width, "0")


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation and region, two tables of fixed size."""
    people = table(spark, sf_dir, "customer")
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    return people.join(places, F.expr("c_nationkey = n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "n_nationkey", "r_name", "c_mktsegment")


def order_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("l_extendedprice").cast(MONEY)
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(amount).alias("line_items_total"), F.count("*").alias("line_item_count"),
        F.count_if(amount.isNull()).alias("line_items_missing"))


def headers(spark: SparkSession, sf_dir: str, faults: bool = True) -> DataFrame:
    """One row per order with the header columns and the aggregates that rules need."""
    orders = join_to_unique(table(spark, sf_dir, "orders"), vendors(spark, sf_dir), "o_custkey",
                            spread=["o_orderkey"], how="inner")
    rows = orders.join(order_sums(spark, sf_dir), F.expr("o_orderkey = l_orderkey"), "left")
    issued = F.col("o_orderdate").cast("date")
    contact = F.col("o_custkey") % 7 != 0
    email = F.concat(F.lit("AP"), _text("o_custkey"), F.lit("@Example.com"))
    number = F.concat(F.lit("INV-"), _text("o_orderkey"))
    due = F.date_add(issued, 30)
    subtotal = F.col("line_items_total").try_cast(MONEY)
    currency = F.lit("USD")
    if faults:
        every = lambda n: F.col("o_orderkey") % n == 0
        email = F.concat(email, F.lit(" "))
        number = F.when(every(101), None).when(every(103), F.concat(F.lit("INV "), _text("o_orderkey"))).otherwise(number)
        due = F.when(every(53), None).when(every(50), F.date_sub(issued, 1)).otherwise(due)
        currency = F.lit("usd ")
    else:
        subtotal = F.coalesce(subtotal, F.lit(0).cast(MONEY))
    rows = rows.withColumn("subtotal", subtotal)
    tax = F.round(F.col("subtotal") * F.lit(RATE).cast("decimal(10,8)"), 2).try_cast(MONEY)
    if faults:
        tax = F.when(every(59), (tax + F.lit("1.00").cast(MONEY)).try_cast(MONEY)).otherwise(tax)
    rows = rows.withColumn("tax_amount", tax)
    total = (F.col("subtotal") + F.col("tax_amount")).try_cast(MONEY)
    if faults:
        total = F.when((F.col("o_orderstatus") == "P") & every(4), F.col("o_totalprice").cast(MONEY)).otherwise(total)
    return rows.select(
        _text("o_orderkey").alias("document_id"),
        F.col("c_name").alias("vendor_name"),
        F.concat(F.lit("Unit "), _text("c_nationkey")).alias("vendor_address"),
        F.concat(F.lit("Nation "), F.chr(F.col("n_nationkey") + 65)).alias("vendor_city"),
        F.upper(F.substring("r_name", 1, 2)).alias("vendor_state"),
        _digits("o_custkey", 5).alias("vendor_zip"),
        F.when(contact, F.concat(F.lit("(217) 555-"), _digits("o_custkey", 4))).alias("vendor_phone"),
        F.when(contact, email).alias("vendor_email"),
        number.alias("invoice_number"), issued.alias("invoice_date"), due.alias("due_date"),
        F.concat(F.lit("PO-"), _text("o_orderkey")).alias("po_number"),
        "subtotal", F.lit(RATE).cast(TAX_RATE).alias("tax_rate"), "tax_amount", total.alias("total_amount"),
        currency.alias("currency"),
        F.concat("c_mktsegment", F.lit(" Purchasing")).alias("bill_to_name"),
        F.concat(F.lit("Dock "), _text("c_nationkey")).alias("bill_to_address"),
        F.col("r_name").alias("bill_to_city"), F.lit("US").alias("bill_to_state"),
        _digits("o_orderkey", 5).alias("bill_to_zip"),
        F.coalesce("line_item_count", F.lit(0)).alias("line_item_count"),
        F.coalesce("line_items_total", F.lit(0)).cast("decimal(24,2)").alias("line_items_total"),
        F.coalesce("line_items_missing", F.lit(0)).alias("line_items_missing"),
        F.col("o_orderdate").alias("parse_timestamp"),
        "o_orderstatus", "o_orderpriority")


def judged_headers(spark: SparkSession, sf_dir: str, faults: bool = True, *, messages: bool = True) -> DataFrame:
    """Headers with confidence, rule results (``messages``: whole ones) and status."""
    rows = headers(spark, sf_dir, faults)
    rows = rows.withColumn("parse_confidence", confidence(
        number=F.col("invoice_number"), vendor_name=F.col("vendor_name"), total=F.col("total_amount"),
        issued=F.col("invoice_date"), due=F.col("due_date"), item_count=F.col("line_item_count"),
        items_total=F.col("line_items_total"), bill_to_name=F.col("bill_to_name"), po=F.col("po_number"),
        subtotal=F.col("subtotal"), tax_amount=F.col("tax_amount")))
    return validate(rows, as_of=AS_OF, messages=messages)


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of every order, numbered from 1 within it. A value that does not fit its column is NULL, and so is the price of a line
    without a quantity."""
    lines = numbers_within(table(spark, sf_dir, "lineitem"), "l_orderkey", LINE_ORDER, "line_number")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = join_to_unique(lines, parts, "l_partkey", spread=["l_orderkey", "line_number"])
    quantity, amount = F.col("l_quantity").try_cast(QUANTITY), F.col("l_extendedprice").try_cast(MONEY)
    document = _text("l_orderkey")
    return lines.select(
        F.concat(document, F.lit("-"), F.when(F.col("line_number") > 999, _text("line_number")).otherwise(
            F.lpad(_text("line_number"), 3, "0"))).alias("line_item_id"),
        document.alias("document_id"), "line_number",
        F.concat("p_name", F.lit(" #"), _text("l_partkey")).alias("description"),
        quantity.alias("quantity"), F.round(F.try_divide(amount, quantity), 2).try_cast(MONEY).alias("unit_price"),
        amount.alias("line_amount"))


def planted_headers(rows: DataFrame) -> DataFrame:
    """Headers with a subtotal that its lines contradict, a negative tax, or lines without an amount."""
    every = lambda n: F.col("document_id").cast("bigint") % n == 0
    return rows.withColumns({
        "subtotal": F.when(every(61), (F.col("subtotal") + 5).cast(MONEY)).otherwise(F.col("subtotal")),
        "tax_amount": F.when(every(37), F.lit("-1.00").cast(MONEY)).otherwise(F.col("tax_amount")),
        "line_items_missing": F.when(every(41), F.lit(1)).otherwise(F.col("line_items_missing"))})


def planted_faults(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The layers with faults that each kind of check must count: repeated, missing and orphan keys, an unknown status, totals
    that do not add up."""
    every = lambda n: F.col("document_id").cast("bigint") % n == 0
    unless = lambda n, name: F.when(~every(n), F.col(name)).alias(name)
    change = lambda df, **columns: df.select(*[columns.get(c, F.col(c)) for c in df.columns])
    invoices, lines, staged, documents = (tables[n] for n in ("parsed_invoices", "parsed_line_items", "stg_parsed_invoices", "dim_documents"))
    orphan = F.when(every(89), F.concat(F.lit("X"), "document_id")).when(~every(79), F.col("document_id")).alias("document_id")
    status = F.when(every(71), "unknown").otherwise(F.col("validation_status")).alias("validation_status")
    total = F.when(every(67), (F.col("total_amount") + 1).cast(MONEY)).otherwise(F.col("total_amount")).alias("total_amount")
    return tables | {
        "parsed_invoices": invoices.unionByName(invoices.where(every(97))),
        "parsed_line_items": change(lines, document_id=orphan, line_item_id=unless(83, "line_item_id")),
        "stg_parsed_invoices": change(staged, vendor_name=unless(73, "vendor_name"), validation_status=status),
        "dim_documents": change(documents, total_amount=total).unionByName(documents.where(every(47)))}


def other_layouts(texts: DataFrame) -> DataFrame:
    """Rendered invoices (document_id, raw_text) with their labels, dates and item columns written in the other forms that are read."""
    key, text = F.col("document_id").cast("bigint"), F.col("raw_text")
    is_ = lambda n, rest: key % n == rest
    change = lambda pattern, by: F.regexp_replace(text, F.lit("(?m)" + pattern), F.lit(by))
    number, order = "^Invoice Number: +(?=INV)", "^PO Number: +PO-"
    steps = [
        F.when(is_(5, 1), change(number, "Invoice # ")).when(is_(5, 2), change(number, "Invoice: ")).when(is_(5, 3), change(number, "INVOICE NO. : "))
        .when(is_(5, 4) & (key >= 10_000), change(number, "Reference ")),
        F.when(is_(4, 1), change(order, "P.O. No: PO-")).when(is_(4, 2), change(order, "po#PO-")).when(is_(4, 3), change(order, "Contract MDOT-"))]
    for name in ("Invoice Date", "Due Date"):
        day = F.to_date(F.regexp_extract(text, rf"(?m)^{name}: +(\d{{4}}-\d{{2}}-\d{{2}})$", 1))
        write = lambda form: F.regexp_replace(text, F.lit(f"(?m)^{name}: +[\\d-]+$"), F.concat(F.lit(f"{name} : "), F.date_format(day, form)))
        steps.append(F.when(is_(3, 1), write("MM/dd/yyyy")).when(is_(6, 2), write("MM-dd-yyyy")).when(is_(12, 5), write("MMM d yyyy")).when(
            is_(12, 11), write("MMMM d, yyyy")))
    steps += [F.when(is_(3, 1), change(r"^Tax \(8\.00%\): +", r"TAX \$")), F.when(is_(2, 1), change("^TOTAL DUE: +", "Amount Due  ")),
              F.when(is_(3, 2), change(r"^(\S.*?) +(\S+) +([\d,]+\.\d{2}) +([\d,]+\.\d{2})$", r"$1 $2 \$$3 \$$4"))]
    for step in steps:              # one projection each: a text that is used several times is worked out once
        texts = texts.withColumn("raw_text", F.coalesce(step, text))
    return texts.select("document_id", "raw_text")


def out_of_range(texts: DataFrame) -> DataFrame:
    """Rendered invoices in which, by document, one kind of value is beyond what its column holds."""
    key, text, large = F.col("document_id").cast("bigint"), F.col("raw_text"), "99,999,999,999.99"
    planted = [(r"^Subtotal: +[\d,.]+$", f"Subtotal: {large}"), (r"^(Tax \(8\.00%\):) +[\d,.]+$", f"$1 {large}"), (r"^Tax \(8\.00%\)", "Tax (800.00%)"),
               (r"^TOTAL DUE: +[\d,.]+$", f"TOTAL DUE: {large}"), (r"^(\S.*? +\S+ +[\d,]+\.\d{2}) +[\d,]+\.\d{2}$", f"$1 {large}")]
    changed = F.when(F.lit(False), text)
    for rest, (pattern, by) in enumerate(planted):
        changed = changed.when(key % 6 == rest, F.regexp_replace(text, F.lit("(?m)" + pattern), F.lit(by)))
    return texts.select("document_id", changed.otherwise(text).alias("text"))


_landed: dict[tuple[str, str, str], DataFrame] = {}


def land_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the cleaned headers; later jobs read them as they would read a warehouse."""
    return written(judged_headers(spark, sf_dir).select(*names(SILVER_INVOICES), *names(SILVER_EXTRA)), "silver-invoices", COMPACT)


def land_lines(spark: SparkSession, sf_dir: str, invoices: DataFrame) -> DataFrame:
    """Write the cleaned lines of the landed headers."""
    lines = join_to_unique(numbered_lines(spark, sf_dir), invoices.select("document_id", "parse_confidence"),
                           "document_id", spread=["line_item_id"], counts=line_counts(invoices))
    return written(lines.withColumnRenamed("parse_confidence", "extraction_confidence")
                   .select(*names(SILVER_LINE_ITEMS)), "silver-line-items", COMPACT)


def land_silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Write the two cleaned tables."""
    invoices = land_headers(spark, sf_dir)
    return invoices, land_lines(spark, sf_dir, invoices)


def silver_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed headers, landed once per application; for jobs that look at no lines."""
    key = (spark.sparkContext.applicationId, sf_dir, "headers")
    if key not in _landed:
        _landed[key] = land_headers(spark, sf_dir)
    return _landed[key]


def silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The landed tables, each landed once per application."""
    invoices, key = silver_headers(spark, sf_dir), (spark.sparkContext.applicationId, sf_dir, "lines")
    if key not in _landed:
        _landed[key] = land_lines(spark, sf_dir, invoices)
    return invoices, _landed[key]


def line_counts(invoices: DataFrame) -> DataFrame:
    """Rows per document in the line table, which the header table already knows."""
    return invoices.select("document_id", F.col("line_item_count").alias("row_count"))


_rendered: dict[tuple[str, str], tuple[DataFrame, DataFrame, DataFrame]] = {}


def land_corpus(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fault-free headers, their line items, and the invoice texts rendered from both."""
    clean, lines = headers(spark, sf_dir, faults=False), numbered_lines(spark, sf_dir)      # not stored: only the texts are read again
    return clean, lines, written(render(clean, lines), "invoice-texts", TEXT_GROUPS)


def corpus(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rendered corpus, landed once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _rendered:
        _rendered[key] = land_corpus(spark, sf_dir)
    return _rendered[key]
