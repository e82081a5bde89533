"""Tables from OCR blocks: regions, rows, column roles, line items; lookups by place and text.

A block is a row (doc_id, page_number, block_pos, text, confidence, x1, y1, x2, y2). Blocks of
one page meet in one row of an aggregate at most: a page is bounded, a document or a corpus
is not, so nothing else is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import parse_number
from ..functions.text import let

# Header words, roles in the order they are tried, distances in pixels.
HEADER_WORDS = (
    "description", "item", "product", "service", "hsn", "sac", "code", "qty", "quantity", "qnty",
    "rate", "price", "unit price", "amount", "total", "value", "sum",
)
ROLES = (
    ("description", ("description", "item", "product", "service")),
    ("hsn", ("hsn", "sac", "code")),
    ("quantity", ("qty", "quantity", "qnty")),
    ("unit_price", ("rate", "price", "unit")),
    ("total", ("total", "amount", "value")),
    ("unit", ("unit", "uom")),
    ("tax", ("tax", "gst", "igst", "cgst", "sgst")),
)
NEAR_Y, NEAR_X, ROW_TOLERANCE, GRID_TOLERANCE = 200, 500, 15, 20
PAGE = ["doc_id", "page_number"]


def overlaps(a: str, b: str) -> Column:
    """Strict overlap of the boxes of two aliases."""
    f = F.col
    return (f(f"{a}.x1") < f(f"{b}.x2")) & (f(f"{a}.x2") > f(f"{b}.x1")) & (f(f"{a}.y1") < f(f"{b}.y2")) & (f(f"{a}.y2") > f(f"{b}.y1"))


def contains(a: str, b: str) -> Column:
    """Whether the box of ``a`` holds that of ``b``, edges included."""
    f = F.col
    return (f(f"{b}.x1") >= f(f"{a}.x1")) & (f(f"{b}.x2") <= f(f"{a}.x2")) & (f(f"{b}.y1") >= f(f"{a}.y1")) & (f(f"{b}.y2") <= f(f"{a}.y2"))


def blocks_in_regions(blocks: DataFrame, regions: DataFrame) -> DataFrame:
    """Blocks that overlap a region of their page, once per region (region_id)."""
    pairs = blocks.alias("b").join(regions.alias("r"), PAGE).where(overlaps("b", "r"))
    return pairs.select(*PAGE, "r.region_id", "b.block_pos", "b.text", "b.confidence")


def regions_from_headers(blocks: DataFrame, least: int = 2) -> DataFrame:
    """One region per header-like block: the hull of the blocks near it."""
    heads = blocks.where(F.lower("text").rlike("|".join(HEADER_WORDS)))
    near = (F.abs(F.col("b.y1") - F.col("h.y2")) < NEAR_Y) & (F.abs(F.col("b.x1") - F.col("h.x1")) < NEAR_X)
    pairs = heads.alias("h").join(blocks.alias("b"), PAGE).where(near)
    hull = pairs.groupBy(*PAGE, F.col("h.block_pos").alias("header_pos")).agg(
        F.min("b.x1").alias("x1"), F.min("b.y1").alias("y1"), F.max("b.x2").alias("x2"), F.max("b.y2").alias("y2"), F.count(F.lit(1)).alias("n_blocks")
    )
    return hull.where(F.col("n_blocks") >= least).withColumn("confidence", F.lit(0.8))


def _anchors(ys: Column, tolerance: int) -> Column:
    """The y1 of each row's first cell, of an array of ascending y1: a cell joins the row while its y1
    is within the tolerance of the row's first."""
    start = F.array().cast("array<int>")
    joins = lambda acc, y: (F.size(acc) > 0) & (y - F.try_element_at(acc, F.lit(-1)) <= tolerance)
    return F.aggregate(F.transform(ys, lambda y: y.cast("int")), start, lambda acc, y: F.when(joins(acc, y), acc).otherwise(F.array_append(acc, y)))


def numbered_rows(blocks: DataFrame, keys: list[str] = PAGE, tolerance: int = ROW_TOLERANCE) -> DataFrame:
    """Blocks with ``row_no`` (from 0, downwards) within their page or other key. A page's cells meet
    in one row; only its distinct heights are folded over."""
    pages = blocks.groupBy(*keys).agg(
        F.collect_list(F.struct("y1", "block_pos", "x1", "x2", "y2", "text", "confidence")).alias("cells"), _anchors(F.array_sort(F.collect_set("y1")), tolerance).alias("anchors")
    )
    cells = pages.select(*keys, "anchors", F.explode("cells").alias("c"))
    row_no = F.size(F.filter("anchors", lambda a: a <= F.col("c.y1"))) - 1
    return cells.select(*keys, row_no.alias("row_no"), "c.*")


def table_rows(blocks: DataFrame, keys: list[str] = PAGE, tolerance: int = ROW_TOLERANCE) -> DataFrame:
    """Rows of cells (array ``cells`` from left to right) per page or other key."""
    rows = numbered_rows(blocks, keys, tolerance).groupBy(*keys, "row_no")
    cells = rows.agg(F.array_sort(F.collect_list(F.struct("x1", "block_pos", "text"))).alias("c"))
    return cells.select(*keys, "row_no", F.transform("c", lambda x: x["text"]).alias("cells"))


def page_lines(blocks: DataFrame, tolerance: int = ROW_TOLERANCE) -> DataFrame:
    """Text of each page, a line for each row of blocks, from top to bottom and left to right."""
    rows = table_rows(blocks, PAGE, tolerance).select(*PAGE, F.struct("row_no", F.array_join("cells", " ").alias("line")).alias("r"))
    lines = F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"])
    return rows.groupBy(*PAGE).agg(F.array_join(lines, "\n").alias("text"))


def item_rows(rows: DataFrame, least: int = 2) -> DataFrame:
    """Of ``table_rows`` of pages the row with the most header-like cells (at least ``least``; of equals
    the first), as row 0, and all rows below it. Pages without such a row give none."""
    heads = F.size(F.filter("cells", lambda c: F.lower(c).rlike("|".join(HEADER_WORDS))))
    page = Window.partitionBy(*PAGE)
    best = F.max(F.when(heads >= least, F.struct(heads.alias("n"), (-F.col("row_no")).alias("at")))).over(page)
    marked = rows.withColumn("_head", -best["at"]).where(F.col("row_no") >= F.col("_head"))
    return marked.withColumn("row_no", F.col("row_no") - F.col("_head")).drop("_head")


def rows_of_regions(blocks: DataFrame, regions: DataFrame) -> DataFrame:
    """``table_rows`` of the blocks that lie fully within each region (region_id)."""
    inside = regions.alias("r").join(blocks.alias("b"), PAGE).where(contains("r", "b")).select(*PAGE, "r.region_id", "b.block_pos", "b.text", "b.confidence", "b.x1", "b.y1", "b.x2", "b.y2")
    return table_rows(inside, [*PAGE, "region_id"])


def regions_from_grid(blocks: DataFrame, least_cells: int = 3, least_rows: int = 2) -> DataFrame:
    """The hull of all rows with enough cells, on pages with enough such rows."""
    rows = numbered_rows(blocks, PAGE, GRID_TOLERANCE).groupBy(*PAGE, "row_no").agg(
        F.count(F.lit(1)).alias("n"), F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2")
    )
    hull = rows.where(F.col("n") >= least_cells).groupBy(*PAGE).agg(
        F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), F.count(F.lit(1)).alias("n_rows")
    )
    return hull.where(F.col("n_rows") >= least_rows).withColumn("confidence", F.lit(0.6))


def regions_from_boxes(boxes: DataFrame, blocks: DataFrame, least: int = 2) -> DataFrame:
    """Candidate boxes (box_id, from ruled lines in the image) that are large and hold blocks."""
    large = boxes.where((F.col("x2") - F.col("x1") > 200) & (F.col("y2") - F.col("y1") > 100))
    held = large.alias("r").join(blocks.alias("b"), PAGE).where(contains("r", "b"))
    rows = held.groupBy(*PAGE, "r.box_id", "r.x1", "r.y1", "r.x2", "r.y2").agg(F.count(F.lit(1)).alias("n_blocks"))
    return rows.where(F.col("n_blocks") >= least).withColumn("confidence", F.lit(0.7))


def _hull(cells: Column) -> Column:
    """The box around an array of boxes, and how many these are."""
    side = lambda name, of: of(F.transform(cells, lambda c: c[name])).alias(name)
    return F.struct(side("x1", F.array_min), side("y1", F.array_min), side("x2", F.array_max), side("y2", F.array_max), F.size(cells).alias("n"))


def table_regions(blocks: DataFrame, boxes: DataFrame | None = None, least: int = 2, least_cells: int = 3, least_rows: int = 2) -> DataFrame:
    """Per page the regions of the first method that finds any: headers, ruled boxes, grid.

    As ``regions_from_headers``, ``regions_from_boxes`` and ``regions_from_grid``, from one aggregate over a
    page's blocks (and one over its boxes): blocks are dealt once, and only the method that counts is computed."""
    head = F.coalesce(F.lower("text").rlike("|".join(HEADER_WORDS)), F.lit(False))
    pages = blocks.groupBy(*PAGE).agg(F.collect_list(F.struct("x1", "y1", "x2", "y2", head.alias("head"))).alias("_cells"))
    cells = F.col("_cells")
    near = lambda h: F.filter(cells, lambda b: (F.abs(b["y1"] - h["y2"]) < NEAR_Y) & (F.abs(b["x1"] - h["x1"]) < NEAR_X))
    by_header = F.filter(F.transform(F.filter(cells, lambda c: c["head"]), lambda h: let(near(h), _hull)), lambda r: r["n"] >= least)

    anchors = _anchors(F.array_sort(F.array_distinct(F.transform(cells, lambda c: c["y1"]))), GRID_TOLERANCE)

    def grid(tops: Column) -> Column:
        row = lambda y, i: F.filter(cells, lambda c: (c["y1"] >= y) & F.coalesce(c["y1"] < F.get(tops, i + 1), F.lit(True)))
        full = F.filter(F.transform(tops, row), lambda r: F.size(r) >= least_cells)
        return let(full, lambda rows: F.when(F.size(rows) >= least_rows, F.array(_hull(F.flatten(rows)))).otherwise(F.array()))

    by_grid = let(anchors, grid)
    methods = [(by_header, 0.8, 1), (by_grid, 0.6, 3)]
    if boxes is not None:
        large = boxes.where((F.col("x2") - F.col("x1") > 200) & (F.col("y2") - F.col("y1") > 100))
        ruled = large.groupBy(*PAGE).agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("_boxes"))
        pages = pages.join(ruled, PAGE, "left")
        held = lambda r: F.size(F.filter(cells, lambda b: (b["x1"] >= r["x1"]) & (b["x2"] <= r["x2"]) & (b["y1"] >= r["y1"]) & (b["y2"] <= r["y2"])))
        boxed = F.transform(F.coalesce("_boxes", F.array()), lambda r: F.struct(*[r[c].alias(c) for c in ("x1", "y1", "x2", "y2")], held(r).alias("n")))
        methods.insert(1, (F.filter(boxed, lambda r: r["n"] >= least), 0.7, 2))

    def first(rest: list) -> Column:
        found, confidence, method = rest[0]
        named = lambda r: F.transform(r, lambda x: F.struct(*[x[c].alias(c) for c in ("x1", "y1", "x2", "y2")], F.lit(confidence).alias("confidence"), F.lit(method).alias("method")))
        return let(found, lambda r: F.when(F.size(r) > 0, named(r)).otherwise(first(rest[1:]))) if len(rest) > 1 else named(found)

    return pages.select(*PAGE, F.explode(first(methods)).alias("r")).select(*PAGE, "r.*")


def role(header: Column) -> Column:
    """The first role of which the header cell holds a word, null if none."""
    low = F.lower(F.trim(header))
    return F.coalesce(*[F.when(low.rlike("|".join(words)), F.lit(name)) for name, words in ROLES])


def role_index(header_row: Column, name: str) -> Column:
    """Index of the last cell of the row that has the role, null if none."""
    return last_index(F.transform(header_row, role), name)


def last_index(values: Column, value: str) -> Column:
    """Index (from 0) of the last occurrence of a value in an array, null if there is none."""
    at = F.array_position(F.reverse(values), F.lit(value))
    return F.when(at > 0, (F.size(values) - at).cast("int"))


def _cell(row: Column, at: Column) -> Column:
    return F.get(row, at)


def parse_items(rows: DataFrame, keys: list[str] = PAGE) -> DataFrame:
    """Line items from ``table_rows``: row 0 of a key is its header.

    A cell is picked by its column's role; a description, quantity, price or total that is
    missing or 0 is sought in the row: the longest cell that is no number, the first number up
    to 1000, the least and the largest positive number. Rows of under 3 cells, and rows without
    a description or any number, give no item.
    """
    # the header's roles are read once for each page and reach its other rows through a window over the page
    names = ("description", "hsn", "quantity", "unit_price", "total", "unit")
    places = lambda roles: F.struct(*[last_index(roles, n).alias(f"at_{n}") for n in names])
    own = F.when(F.col("row_no") == 0, let(F.transform("cells", role), places))
    page = Window.partitionBy(*keys).orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    at = F.first(own, ignorenulls=True).over(page)
    body = rows.withColumn("_at", at).where(F.col("_at").isNotNull() & (F.col("row_no") > 0) & (F.size("cells") >= 3)).select("*", "_at.*")
    c = F.col("cells")
    body = body.withColumn("nums", F.transform(c, parse_number))
    positive = F.filter("nums", lambda n: n > 0)
    text = F.filter(c, lambda x: ~F.trim(x).rlike(r"^[0-9.,]+\z"))
    longest = F.aggregate(text, F.lit(None).cast("string"), lambda acc, x: F.when(acc.isNull() | (F.length(x) > F.length(acc)), x).otherwise(acc))
    number = lambda n: F.nullif(F.get("nums", F.col(f"at_{n}")), F.lit(0.0))
    zero = F.lit(0.0)
    out = body.select(
        *keys,
        "row_no",
        F.coalesce(F.nullif(F.trim(_cell(c, F.col("at_description"))), F.lit("")), longest, F.get(c, F.lit(0))).alias("description"),
        F.coalesce(F.trim(_cell(c, F.col("at_hsn"))), F.lit("")).alias("hsn_code"),
        F.coalesce(number("quantity"), F.get(F.filter("nums", lambda n: (n > 0) & (n <= 1000)), F.lit(0)), zero).alias("quantity"),
        F.coalesce(number("unit_price"), F.array_min(positive), zero).alias("unit_price"),
        F.coalesce(number("total"), F.array_max(positive), zero).alias("total_amount"),
        F.coalesce(F.trim(_cell(c, F.col("at_unit"))), F.lit("")).alias("unit"),
        F.lit(0.5).alias("confidence"),
    )
    return out.where((F.col("description") != "") & ((F.col("quantity") > 0) | (F.col("unit_price") > 0) | (F.col("total_amount") > 0)))


def locate_text(fields: DataFrame, blocks: DataFrame) -> DataFrame:
    """For each field (doc_id, field, value): the most confident block of the document whose text
    holds the value or is held by it, the earliest of equals; else an empty box at 0.5."""
    a, b = F.lower(F.trim("f.value")), F.lower(F.trim("b.text"))
    pairs = fields.alias("f").join(blocks.alias("b"), "doc_id").where((F.contains(a, b) | F.contains(b, a)) & (F.col("b.confidence") > 0))
    best = pairs.groupBy("doc_id", "f.field").agg(
        F.max_by(F.struct("b.confidence", "b.x1", "b.y1", "b.x2", "b.y2", F.col("b.text").alias("source_text")), F.struct(F.col("b.confidence"), -F.col("b.page_number"), -F.col("b.block_pos"))).alias("m")
    )
    joined = fields.join(best, ["doc_id", "field"], "left")
    box = [F.coalesce(F.col(f"m.{k}"), F.lit(0)).alias(k) for k in ("x1", "y1", "x2", "y2")]
    return joined.select("doc_id", "field", "value", F.coalesce("m.confidence", F.lit(0.5)).alias("confidence"), *box, F.coalesce("m.source_text", "value").alias("source_text"))


def nearest_to_keyword(blocks: DataFrame, keyword: str) -> DataFrame:
    """Per page the block nearest to the first block that holds the keyword, by the distance of
    their upper left corners; ties go to the earlier block."""
    key = blocks.where(F.contains(F.lower("text"), F.lit(keyword.lower())))
    first = key.groupBy(*PAGE).agg(F.min_by(F.struct("x1", "y1", "block_pos"), "block_pos").alias("k"))
    pairs = blocks.join(first, PAGE).where(F.col("block_pos") != F.col("k.block_pos"))
    distance = F.hypot(F.col("x1") - F.col("k.x1"), F.col("y1") - F.col("k.y1"))
    return pairs.groupBy(*PAGE).agg(F.min_by("text", F.struct(distance, F.col("block_pos"))).alias("text"))
