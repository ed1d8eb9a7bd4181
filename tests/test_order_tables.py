"""Values of the order tables that do not fit never stop a run."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from invoicemill.sources import order_tables as ot

SF = "/root/testdata/sf0.001"


def test_lines_without_quantity_or_beyond_their_column(spark, tmp_path):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").orderBy("l_orderkey").limit(40).dropDuplicates(["l_orderkey"])
    zero, huge = [r[0] for r in lines.select("l_orderkey").orderBy("l_orderkey").take(2)]
    quantity, price = lines.schema["l_quantity"].dataType, "double"
    odd = lines.withColumns({
        "l_quantity": F.when(F.col("l_orderkey") == zero, 0).otherwise(F.col("l_quantity")).cast(quantity),
        "l_extendedprice": F.when(F.col("l_orderkey") == huge, 1e30).otherwise(F.col("l_extendedprice").cast("double")).cast(price)})
    odd.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{SF}/part.parquet").write.parquet(f"{tmp_path}/part.parquet")
    got = {r.document_id: r for r in ot.numbered_lines(spark, str(tmp_path)).collect()}
    assert len(got) == lines.count() and len(got) > 2
    empty, large = got.pop(str(zero)), got.pop(str(huge))
    assert empty.quantity == D(0) and empty.unit_price is None and empty.line_amount is not None
    assert large.line_amount is None and large.unit_price is None and large.quantity is not None
    assert all(r.unit_price is not None for r in got.values())


def test_headers_land_without_lines(spark, tmp_path):
    """Queries of headers alone do not wait for the lines; both are landed once."""
    for name in ("customer", "nation", "region", "orders", "lineitem"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(50).write.parquet(f"{tmp_path}/{name}.parquet")
    first = ot.silver_headers(spark, str(tmp_path))         # the table of parts, which only lines need, is not there
    spark.read.parquet(f"{SF}/part.parquet").write.parquet(f"{tmp_path}/part.parquet")
    invoices, lines = ot.silver(spark, str(tmp_path))
    assert invoices is first and ot.silver(spark, str(tmp_path))[1] is lines
