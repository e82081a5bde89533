from pyspark.sql import functions as F

from paperloom.functions import money, scores
from paperloom.functions import text as X

INVOICE = """INVOICE
Invoice Number: INV-2024-001
Date: 15/05/2024
GSTIN: 07AABCU9603R1ZV
Buyer GSTIN 29GGGGG1314R9Z6
PO Number: PO-2024-789
Ship To:
ABC Company Ltd
123 Business Street
Mumbai
Phone: 98
Grand Total: ₹15,750.00"""


def one(spark, *columns, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1)])
    return df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_header_fields(spark):
    t = F.col("t")
    r = one(spark, X.invoice_number(t), X.invoice_date(t), X.po_number(t), X.total_amount(t), X.gst_numbers(t), X.gst_numbers(t, True), X.shipping_address(t), t=INVOICE)
    assert r[:4] == ("INV-2024-001", "2024-05-15", "PO-2024-789", "15750.00")
    # one behind a label is found by its label and by its form
    assert r[4] == ["07AABCU9603R1ZV", "07AABCU9603R1ZV", "29GGGGG1314R9Z6"] or sorted(set(r[4])) == ["07AABCU9603R1ZV", "29GGGGG1314R9Z6"]
    assert r[5] == ["07AABCU9603R1ZV", "29GGGGG1314R9Z6"]
    assert r[6] == "ABC Company Ltd\n123 Business Street\nMumbai"


def test_fields_are_null_without_a_match(spark):
    t = F.col("t")
    for text in ("", "nothing here"):
        r = one(spark, X.invoice_number(t), X.invoice_date(t), X.total_amount(t), X.shipping_address(t), t=text)
        assert tuple(r) == (None, None, None, None)


def test_subtotal_holds_a_total_label(spark):
    assert one(spark, X.total_amount(F.col("t")), t="Subtotal: 12500.00\nGrand Total: 14750")[0] == "12500.00"


def test_normalise_date(spark):
    cases = {
        "15/05/2024": "2024-05-15", "05/15/2024": "2024-05-15", "1-2-75": "1975-02-01", "01/02/68": "2068-02-01", "32/13/2024": None, "1/2-2024": None,
        "15 mar 2024": "2024-03-15", "15 March 2024": "2024-03-15", "may 5, 2024": "2024-05-05", "15 mar 24": None, "15/05/202": None, "": None, "29/02/2023": None,
    }
    df = spark.createDataFrame(list(cases.items()), "t string, want string")
    assert {r.t: r.got for r in df.select("t", X.normalise_date(F.col("t")).alias("got")).collect()} == cases


def test_formats(spark):
    cases = [
        ("gst_number", "07AABCU9603R1ZV", True), ("gst_number", "27AAPFU0939F1ZV", True), ("gst_number", "INVALID123", False), ("gst_number", "27FGHIJ5678K2L9", False), ("gst_number", "", None),
        ("invoice_number", "BILL/2024/001", True), ("invoice_number", "INV", True), ("invoice_number", "???", False), ("invoice_number", "INVALID@#$", False),
        ("pincode", "400001", True), ("pincode", "040001", False), ("phone", "9876543210", True), ("phone", "1234567890", False), ("email", "a@b.co", True), ("email", "a@b", False),
    ]
    for kind, value, want in cases:
        assert one(spark, X.has_format(F.col("v"), kind), v=value)[0] is want, (kind, value)


def test_money(spark):
    v = F.col("v")
    for text, want in (("₹ 1,234.50", 1234.5), ("$12", 12.0), ("", None), ("abc", None), (" -5 ", -5.0)):
        got = one(spark, money.parse_decimal(v), v=text)[0]
        assert (None if got is None else float(got)) == want
    for text, want in (("₹1,250.75 x", 1250.75), ("none", 0.0), ("-5", 5.0)):
        assert one(spark, money.parse_number(v), v=text)[0] == want
    for text, want in (("1,250.00", "1250.00"), ("12 a", None), ("12.", "12.")):
        assert one(spark, money.clean_amount(v), v=text)[0] == want
    for text, want in (("8471", True), ("847130", True), ("84713010", True), ("847", False), ("84710", False), ("12A4", False)):
        assert one(spark, money.hsn_is_valid(v), v=text)[0] is want
    assert one(spark, money.safe_divide(F.lit(1.0), F.lit(0.0)), money.percentage(F.lit(1.0), F.lit(4.0)))[:] == (0.0, 25.0)
    assert float(one(spark, money.round_to_currency(F.lit("2.675")))[0]) == 2.68


def test_scores(spark):
    c = F.col("c")
    for value, category, grade in ((0.95, "high", "HIGH"), (0.8, "medium", "MEDIUM"), (0.5, "low", "LOW"), (0.2, "low", "VERY_LOW")):
        assert one(spark, scores.category(c), scores.grade(c), c=value)[:] == (category, grade)
    a = lambda *x: F.array(*map(F.lit, x))
    assert one(spark, scores.weighted_mean(a(1.0, 0.0), a(3.0, 1.0)), scores.weighted_mean(a(1.0, 0.0), a(3.0)))[:] == (0.75, 0.5)
    assert one(spark, scores.normalise(F.lit(5.0), 0, 10), scores.normalise(F.lit(50.0), 0, 10), scores.normalise(F.lit(1.0), 1, 1))[:] == (0.5, 1.0, 0.0)
    assert abs(one(spark, scores.field_confidence(F.lit("INV-001"), F.lit(0.6)))[0] - 0.8) < 1e-9
    assert abs(one(spark, scores.field_confidence(F.lit("a?"), F.lit(0.6)))[0] - 0.3) < 1e-9


def test_text_helpers(spark):
    t = F.col("t")
    assert one(spark, X.clean_text(t), t="  a \n b™ (c) ")[0] == "a b (c)"
    assert one(spark, X.numbers_in(t), t="1,250.00 and 7")[0] == [1.0, 250.0, 7.0]
    assert one(spark, X.beside_label(t, "Total"), t="Name   X\nTotal   12.50")[0] == "12.50"
    assert one(spark, X.near_keyword(t, "beta", 2), t="alpha beta gamma")[0] == "a beta g"
    assert one(spark, X.is_phone(t), X.is_email(t), X.is_pincode(t), t="+91 98765 43210")[:] == (True, False, False)


def row_of(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_dates_and_gst_numbers(spark):
    r = row_of(
        spark,
        a=X.dates_in(F.lit("on 15/05/2024, 2024-05-15, 3 March 2024 and May 15, 2024")), b=X.dates_in(F.lit(None).cast("string")),
        c=X.normalise_gst(F.lit("07 abcde1234fq1z5")), d=X.normalise_gst(F.lit("07abcde")), e=X.normalise_gst(F.lit(None).cast("string")),
    )
    assert r.a == ["15/05/2024", "2024-05-15", "Mar", "May"] and r.b == []
    assert (r.c, r.d, r.e) == ("07ABCDE1234FQ1Z5", "07abcde", "")


def test_standard_date(spark):
    given = ["15/05/2024", "15-May-2024", "2024-05-15", "May 15, 2024", "2024-15-05", "soon", None]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, t string").select(X.standard_date(F.col("t")).alias("d"), "i").orderBy("i").collect()
    assert [r.d for r in rows] == ["15/05/2024"] * 4 + [None] * 3


def test_pattern_strength_and_nested_values(spark):
    pieces = ("INV-", "[0-9]{4}", "-", "[0-9]{3}")
    strength = lambda t: X.pattern_strength(F.lit(t), pieces)
    json = F.lit('{"a": {"b": 3, "c.d": "x"}, "n": null}')
    r = row_of(spark, a=strength("INV-2024-001"), b=strength("INV-2024"), c=strength("RANDOM-TEXT"), d=X.nested_get(json, ("a", "b")), e=X.nested_get(json, ("a", "c.d")), f=X.nested_get(json, ("n",), "none"), g=X.nested_get(json, ("a", "z")), h=X.nested_get(F.lit("no json"), ("a",), "?"))
    assert (r.a, r.b, r.c) == (1.0, 0.5, 0.0)
    assert (r.d, r.e, r.f, r.g, r.h) == ("3", "x", "none", None, "?")
