"""Records out of receipt text, model answers, web pages and shop links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from larder.functions.text import strip_tags, title_words

# --- receipts -----------------------------------------------------------------------

# Fixed value: one receipt line is "qty NAME unit [total]"; a name ends with a letter.
RECEIPT_ITEM = r"(\d+)?\s*([A-ZÀ-ÿ\s%]+[A-ZÀ-ÿ]+)\s+(\d+\.\d{2})\s*(\d+\.\d{2})?"
# Where an item can start at all: after the last one, at the first of some digits, or where a run of name
# characters begins; and only if that run, read once without going back, leads up to a price. What the item
# pattern finds stays the same, but a long text without prices is read in linear time.
_ITEM_START = r"(?:\G|(?<![A-ZÀ-ÿ\s%\d])(?=[A-ZÀ-ÿ\s%\d])|(?<=\d)(?=[A-ZÀ-ÿ\s%])|(?<=[A-ZÀ-ÿ\s%])(?=\d))(?=\d*+[A-ZÀ-ÿ\s%]++\d+\.\d{2})"
# Fixed value: a store name is a line that starts with capitals.
STORE_LINE = r"^[ ,]*[A-Z]{2,}[ ,.]*[A-Z]*"
# Street keywords.
STREET_WORDS = (
    "CALLE", "C.", "CARRER", "CTRA.", "AV.", "AVE", "PLAZA", "PZA.", "VIA", "CAMINO", "CLL", "CTRA", "CIRA",
)
STREET_LINE = "(?i)(?:" + "|".join(STREET_WORDS) + r")\.?\s+.*?\d+"


def _first_line(text: Column, pattern: str) -> Column:
    return F.get(F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(pattern))), F.lit(0))


# Marks around an item, between its parts, and after it; receipts hold no control characters.
_OPEN, _PART, _CLOSE = "\x02", "\x01", "\x03"


def parse_receipts(df: DataFrame, text: str = "text") -> DataFrame:
    """Store name, address and item array of each receipt text."""
    # Backslashes become blanks, commas become points, plus signs and stray marks go.
    read = df.withColumn("_t", F.translate(F.col(text), "\\,+" + _OPEN + _PART + _CLOSE, " ."))
    # All four parts of all items are marked in a single pass of the pattern.
    marked = F.regexp_replace(F.col("_t"), _ITEM_START + RECEIPT_ITEM, _OPEN + _PART.join(("$1", "$2", "$3", "$4")) + _CLOSE)
    found = F.filter(F.split(marked, _OPEN), lambda piece: F.contains(piece, F.lit(_CLOSE)))
    parts = F.transform(found, lambda piece: F.split(F.split_part(piece, F.lit(_CLOSE), F.lit(1)), _PART))
    return read.withColumns({
        "store_name": F.trim(F.regexp_replace(_first_line(F.col("_t"), STORE_LINE), r"[ ,.]*$", "")),
        "store_address": F.trim(_first_line(F.col("_t"), STREET_LINE)),
        "items": F.transform(parts, _receipt_item),
    }).drop("_t")


def _receipt_item(parts: Column) -> Column:
    quantity, name, unit, total = (F.get(parts, F.lit(i)) for i in range(4))
    price = unit.try_cast("double")
    return F.struct(
        F.coalesce(quantity.try_cast("int"), F.lit(1)).alias("quantity"),
        F.regexp_replace(name, r"^\s+|\s+$", "").alias("description"),
        price.alias("unit_price"),
        F.coalesce(total.try_cast("double"), price).alias("total_price"),
    )


def receipt_items(receipts: DataFrame, keep: Sequence[str]) -> DataFrame:
    # A plain inline makes the optimizer test the array in a filter first, and so
    # run the pattern again; the outer form parses once. Every item has a quantity.
    return receipts.select(*keep, F.inline_outer("items")).where("quantity is not null")


# --- invoices -----------------------------------------------------------------------

# Fixed value: the keys of the answers.
INVOICE_SCHEMA = (
    "`Invoice no.` string, location string, supermarket_name string, Date string, "
    "products array<struct<name: string, `Unit price`: string, quantity: string, amount: string>>, "
    "total_price string, total_products string, mode_of_payment string"
)


def parse_invoices(df: DataFrame, answer: str = "answer") -> DataFrame:
    """Invoice header and product array from the outermost braces of a model's answer."""
    found = F.regexp_extract(F.col(answer), r"(?s)(\{.*\})", 1)
    return df.withColumn("_j", F.from_json(found, INVOICE_SCHEMA)).select(
        *[c for c in df.columns if c != answer],
        F.col("_j").getField("Invoice no.").alias("invoice_no"),
        F.col("_j.location").alias("location"), F.col("_j.supermarket_name").alias("supermarket_name"),
        F.col("_j.Date").alias("date"), F.col("_j.total_price").alias("total_price"),
        F.col("_j.total_products").alias("total_products"),
        F.col("_j.mode_of_payment").alias("mode_of_payment"), F.col("_j.products").alias("products"),
    )


def invoice_products(invoices: DataFrame, keep: Sequence[str]) -> DataFrame:
    # The outer form parses the answer once; see receipt_items.
    listed = invoices.select(*keep, F.explode_outer("products").alias("p")).where("p is not null")
    return listed.select(
        *keep,
        title_words(F.col("p.name")).alias("product_name"),
        F.col("p").getField("Unit price").alias("unit_price"),
        F.col("p.quantity").alias("quantity"), F.col("p.amount").alias("amount"),
    )


# --- web pages ----------------------------------------------------------------------


def _element(html: Column, tag: str) -> Column:
    return F.regexp_extract(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)


def element_text(html: Column, tag: str, default: str) -> Column:
    """Text of the first such element, or the default when missing or empty."""
    text = strip_tags(_element(html, tag))
    return F.when(text != "", text).otherwise(default)


def link_targets(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'(?is)<a\s[^>]*?href="([^"]*)"'), F.lit(1))


def element_texts(html: Column, tag: str) -> Column:
    found = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), F.lit(1))
    return F.transform(found, strip_tags)


def page_fields(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Name, number of listed entries, links and description of each page."""
    h = F.col(html)
    body = F.array_join(element_texts(h, "p"), " ")
    return pages.select(
        key,
        element_text(h, "h1", "No name found").alias("name"),
        link_targets(h).alias("links"),
        element_texts(h, "li").alias("entries"),
        F.when(F.trim(body) != "", F.trim(body)).otherwise("No description found").alias("description"),
    )


def table_rows(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """One row per table line: its number in the page, whether it is a header, its cells."""
    rows = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr(?:\s[^>]*)?>(.*?)</tr>"), F.lit(1))
    cells = F.regexp_extract_all(F.col("row"), F.lit(r"(?is)<t[hd](?:\s[^>]*)?>(.*?)</t[hd]>"), F.lit(1))
    return (
        pages.select(key, F.posexplode(rows).alias("row_no", "row"))
        .select(key, "row_no", F.rlike("row", F.lit(r"(?i)<th[\s>]")).alias("is_header"),
                F.transform(cells, strip_tags).alias("cells"))
        .where(F.size("cells") > 0)
    )


def table_records(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Table lines as (heading, value) pairs of the page's header line.

    The header is looked up inside the page's own row array: no join, no shuffle.
    """
    rows = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr(?:\s[^>]*)?>(.*?)</tr>"), F.lit(1))

    def cells(row: Column) -> Column:
        return F.transform(
            F.regexp_extract_all(row, F.lit(r"(?is)<t[hd](?:\s[^>]*)?>(.*?)</t[hd]>"), F.lit(1)), strip_tags
        )

    is_head = lambda r: F.rlike(r, F.lit(r"(?i)<th[\s>]"))
    return (
        pages.withColumn("_rows", rows)
        .withColumn("_head", cells(F.get(F.filter("_rows", is_head), F.lit(0))))
        .select(key, "_head", F.posexplode(F.filter("_rows", lambda r: ~is_head(r))).alias("row_no", "_row"))
        .withColumn("_cells", cells(F.col("_row")))
        .select(key, "row_no", F.posexplode("_cells").alias("_i", "value"), "_head")
        .select(key, "row_no", F.lower(F.get("_head", F.col("_i"))).alias("heading"), "value")
        .where("heading is not null")
    )


# --- shop links ---------------------------------------------------------------------

# Shop sections that hold no groceries.
EXCLUDED_SECTIONS = ("personal-baby-care", "household-care", "home-kitchen", "office-school-supplies")
# Fixed value: a last path segment that starts so is a listing, not a category.
LISTING_MARK = "pr?sid"


def link_hierarchy(links: DataFrame, url: str = "url") -> DataFrame:
    """Path segments five to seven of a link as category, sub-category and product group."""
    parts = F.split(F.col(url), "/")
    names = ("category", "sub_category", "product_group")
    return links.withColumns({n: F.get(parts, F.lit(i)) for n, i in zip(names, (4, 5, 6))})


def grocery_links(links: DataFrame, url: str = "url", excluded: Sequence[str] = EXCLUDED_SECTIONS) -> DataFrame:
    """Links with a full hierarchy outside the excluded sections."""
    return link_hierarchy(links, url).where(
        F.col("product_group").isNotNull()
        & ~F.startswith(F.col("product_group"), F.lit(LISTING_MARK))
        & ~F.col("category").isin(*excluded)
    )
