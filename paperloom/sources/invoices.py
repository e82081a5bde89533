"""Invoices made from the star schema, with the faults that scanned documents have.

The tables hold no invoices. These frames derive them by rule, so that any engine can derive
the same: quantities, prices and totals as text with currency signs, missing and unreadable
values, totals off by amounts on both sides of every tolerance, corrupted identifiers.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: By which totals are off, in the order of their row's number modulo 6.
DELTAS = ("0", "0.005", "0.006", "0.01", "0.011", "1")
RATES = ("0", "5", "12", "18", "28")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over as many partitions as the session has cores, if its scan has fewer: one small
    file is one task, however much is done with each row."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _pick(values: tuple[str, ...], at: Column) -> Column:
    return F.get(F.array(*[F.lit(Decimal(v)) for v in values]), at.cast("int"))


def items(lineitem: DataFrame) -> DataFrame:
    """One row per line item, all amounts as text."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order))
    own = lineitem.select("*", number.alias("line_no")).withColumn("k", F.col("l_orderkey") + F.col("line_no"))
    k = F.col("k")
    quantity, price = F.col("l_quantity").cast("decimal(12,2)"), F.col("l_extendedprice").cast("decimal(14,2)")
    percent = (F.col("l_discount") * 100).cast("decimal(6,2)")
    exact = quantity * price
    expected = (
        F.when(k % 5 == 0, (exact * (100 - percent) * F.lit(Decimal("0.01"))).cast("decimal(20,4)"))
        .when(k % 5 == 1, (exact - 10).cast("decimal(20,4)"))
        .otherwise(exact.cast("decimal(20,4)"))
    )
    total = (expected + _pick(DELTAS, k % 6)).cast("decimal(18,4)")
    return own.select(
        F.col("l_orderkey").alias("doc_id"),
        "line_no",
        F.concat(F.lit("Part "), F.col("l_partkey")).alias("description"),
        F.when(k % 7 == 0, "12A4")
        .when(k % 7 == 3, F.lpad((F.col("l_partkey") % 1000000).cast("string"), 6, "0"))
        .when(k % 7 != 1, F.lpad((F.col("l_partkey") % 10000).cast("string"), 4, "0"))
        .alias("hsn_code"),
        F.when(k % 97 == 0, None).when(k % 89 == 0, "n/a").otherwise(quantity.cast("string")).alias("quantity"),
        F.concat(F.when(k % 3 == 0, "₹ ").otherwise(""), price.cast("string")).alias("unit_price"),
        F.when(k % 103 != 0, total.cast("string")).alias("total_amount"),
        F.when(k % 101 == 0, "abc").when(k % 5 == 0, percent.cast("string")).when(k % 5 == 1, "10.00").otherwise("0").alias("discount"),
        F.when(k % 5 == 0, "percentage").otherwise("amount").alias("discount_type"),
        F.when(k % 107 != 0, _pick(RATES, F.col("l_partkey") % 5).cast("int").cast("string")).alias("gst_rate"),
    )


def headers(orders: DataFrame) -> DataFrame:
    """One row per invoice: identifiers, dates, customer fields; some are corrupted."""
    key, cust, day = F.col("o_orderkey"), F.col("o_custkey"), F.to_date("o_orderdate")
    four = F.lpad((cust % 10000).cast("string"), 4, "0")
    return orders.select(
        key.alias("doc_id"),
        F.concat(F.when(key % 11 == 0, "inv?").otherwise("INV-"), F.date_format(day, "yyyy"), F.lit("-"), F.lpad(key.cast("string"), 6, "0")).alias("invoice_number"),
        F.when(key % 29 == 0, "2024-15-05").otherwise(F.date_format(day, "yyyy-MM-dd")).alias("invoice_date"),
        F.date_format(F.date_add(day, (key % 60 - 10).cast("int")), "yyyy-MM-dd").alias("due_date"),
        F.concat(F.lpad((cust % 37 + 1).cast("string"), 2, "0"), F.lit("ABCDE"), four, F.lit("F1"), F.when(key % 7 == 0, "X").otherwise("Z"), F.lit("5")).alias("gst_number"),
        F.concat(F.lit("ABCDE"), four, F.when(key % 13 == 0, "9").otherwise("F")).alias("pan_number"),
        F.when(key % 17 == 0, "012345").otherwise((cust % 900000 + 100000).cast("string")).alias("pincode"),
        F.when(key % 19 == 0, "12345").otherwise(F.concat(F.lit("9"), F.lpad(cust.cast("string"), 9, "0"))).alias("phone"),
        F.when(key % 23 == 0, "no mail").otherwise(F.concat(F.lit("user"), cust, F.lit("@example.com"))).alias("email"),
        F.concat(F.lit("PO-"), cust).alias("po_number"),
        day.alias("day"),
        cust.alias("customer"),
    )


def invoices(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Headers with the extracted sums as text: subtotal, discount, GST and final total."""
    from ..functions.money import parse_decimal

    own = items(lineitem).select("doc_id", parse_decimal(F.col("total_amount")).alias("t"), parse_decimal(F.col("gst_rate")).alias("r"))
    sums = own.groupBy("doc_id").agg(F.sum("t").alias("s"), F.sum((F.col("t") * F.col("r") * F.lit(Decimal("0.01"))).cast("decimal(20,6)")).alias("g"))
    money = "decimal(18,4)"
    zero = F.lit(Decimal("0"))
    key = F.col("doc_id")
    joined = headers(orders).join(sums, "doc_id", "left")
    subtotal = (F.coalesce("s", zero) + _pick(DELTAS, key % 6)).cast(money)
    discount = F.when(key % 4 == 0, Decimal("50")).otherwise(Decimal("0")).cast(money)
    gst = (F.coalesce("g", zero) + F.when(key % 9 == 0, Decimal("2.5")).otherwise(Decimal("0"))).cast(money)
    final = (subtotal - discount + gst + _pick(DELTAS, F.floor(key / 6) % 6)).cast(money)
    out = joined.select(
        *[c for c in joined.columns if c not in ("s", "g")],
        F.when(key % 31 == 0, "unreadable").otherwise(subtotal.cast("string")).alias("subtotal"),
        discount.cast("string").alias("total_discount"),
        gst.cast("string").alias("total_gst"),
        final.cast("string").alias("total_amount"),
    )
    return out


def texts(orders: DataFrame) -> DataFrame:
    """One page of text per invoice, its date in one of five forms."""
    own = headers(orders)
    form = F.col("doc_id") % 5
    date = (
        F.when(form == 0, F.date_format("day", "dd/MM/yyyy"))
        .when(form == 1, F.date_format("day", "MM/dd/yyyy"))
        .when(form == 2, F.date_format("day", "dd-MM-yy"))
        .when(form == 3, F.date_format("day", "dd MMM yyyy"))
        .otherwise(F.date_format("day", "MMMM dd, yyyy"))
    )
    lines = [
        F.lit("TAX INVOICE"),
        F.concat(F.when(F.col("doc_id") % 3 == 0, "Bill No: ").otherwise("Invoice Number: "), F.col("invoice_number")),
        F.concat(F.lit("Date: "), date),
        F.concat(F.lit("GSTIN: "), F.col("gst_number")),
        F.concat(F.lit("PO Number: "), F.col("po_number")),
        F.when(F.col("doc_id") % 4 == 1, "Ship To: ").otherwise("Bill To:"),
        F.concat(F.lit("Customer "), F.col("customer")),
        F.concat(F.lit("  "), F.col("customer"), F.lit(" Main Street")),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("Phone: "), F.col("phone"))).otherwise(F.concat(F.lit("City "), F.col("pincode"))),
        F.concat(F.when(F.col("doc_id") % 8 == 0, "Net Amount: Rs. ").otherwise("Grand Total: ₹"), F.format_string("%d,%03d.50", F.col("customer"), F.col("doc_id") % 1000)),
    ]
    return own.select("doc_id", F.concat_ws("\n", *lines).alias("text"), date.alias("date_text"), "phone", "email", "pincode")


def blocks(lineitem: DataFrame) -> DataFrame:
    """OCR blocks of a table of five columns per invoice: a header row and one row per item."""
    own = items(lineitem)
    cells = F.array("description", "hsn_code", "quantity", "unit_price", "total_amount")
    heads = F.array(*[F.lit(x) for x in ("Description", "HSN", "Qty", "Rate", "Amount")])
    rows = own.select("doc_id", "line_no", F.transform(cells, lambda c: F.coalesce(c, F.lit("-"))).alias("cells"))
    rows = rows.unionByName(own.select("doc_id").distinct().select("doc_id", F.lit(0).alias("line_no"), heads.alias("cells")))
    at = rows.select("doc_id", "line_no", F.posexplode("cells").alias("col", "text"))
    jitter = (F.col("doc_id") + F.col("line_no") * 3 + F.col("col") * 5) % 7
    y = (100 + 30 * F.col("line_no") + jitter).cast("int")
    return at.select(
        "doc_id",
        F.lit(1).alias("page_number"),
        (F.col("line_no") * 5 + F.col("col")).cast("int").alias("block_pos"),
        "text",
        ((50 + (F.col("doc_id") * 7 + F.col("line_no") * 11 + F.col("col") * 3) % 50) / 100.0).alias("confidence"),
        (50 + 100 * F.col("col")).cast("int").alias("x1"),
        y.alias("y1"),
        (130 + 100 * F.col("col")).cast("int").alias("x2"),
        (y + 20).alias("y2"),
    )
