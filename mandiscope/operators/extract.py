"""Fields out of scraped text, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandiscope.functions.text import blank_to_null, first_group, strip, try_double
from mandiscope.operators.relational import latest_by_key

# Labels searched in detail text.
MOQ_LABEL = r"MOQ|Minimum Order"
UNIT_LABEL = r"Unit|Packaging"
RESPONSE_LABEL = r"Response Rate"

# Product id patterns of a listing address, tried in order.
PRODUCT_PATH = r"/product/([^/]+)"
HTML_PATH = r"/([^/]+)\.html"
NUMBERED_PATH = r"/products/[^/]+-c(\d+)"

MAX_ERROR_TEXT = 500


def labelled_value(text: Column, label: str) -> Column:
    """Text after the first colon if the label occurs, the whole text if there is no colon."""
    value = F.when(text.contains(":"), strip(F.regexp_replace(text, r"(?s)^[^:]*:", ""))).otherwise(strip(text))
    return F.when(text.rlike(f"(?i){label}"), value)


def labelled_number(text: Column, label: str) -> Column:
    """A labelled number without its percent sign, null if it is none."""
    return try_double(strip(F.replace(labelled_value(text, label), F.lit("%"), F.lit(""))))


def has_badge(text: Column) -> Column:
    return F.coalesce(text.rlike("(?i)verified|trusted"), F.lit(False))


def _without_dots(url: Column) -> Column:
    """``url`` with the segments ``.`` and ``..`` of its path taken out, the latter with the segment before it."""
    root = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    rest = F.regexp_extract(url, r"([?#].*)$", 1)
    parts = F.split(path, "/", -1)
    last = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
        .when(part == ".", done)
        .otherwise(F.concat(done, F.array(part))),
    )
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), F.concat(root, F.array_join(F.concat(kept, last), "/"), rest)).otherwise(url)


def resolve_url(href: Column, base: Column | str) -> Column:
    """Absolute address of a link found on a page of ``base``; an address with a scheme of its own stays as it is."""
    base = F.lit(base) if isinstance(base, str) else base
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    folder = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    joined = (
        F.when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("#") | href.startswith("?"), F.concat(page, href))
        .when(href == "", base)
        .otherwise(F.concat(folder, F.when(folder.endswith("/"), "").otherwise("/"), href))
    )
    return F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href).otherwise(_without_dots(joined))


def product_id(url: Column) -> Column:
    """Id named by the address, otherwise a stable hash of it."""
    numbered = F.concat(F.lit("TI-"), first_group(url, NUMBERED_PATH))
    return F.coalesce(
        numbered, first_group(url, PRODUCT_PATH), first_group(url, HTML_PATH), F.xxhash64(url).cast("string")
    )


def price_numbers(text: Column) -> Column:
    numbers = F.regexp_extract_all(F.replace(text, F.lit(","), F.lit("")), F.lit(r"(\d+\.?\d*)"), F.lit(1))
    return F.transform(numbers, lambda x: x.cast("double"))


def price_range(listing: Column, detail: Column | None = None) -> Column:
    """Smallest and largest number of the listing's price text, else of the detail page's, as a struct."""
    text = listing if detail is None else F.coalesce(blank_to_null(listing), detail)
    numbers = price_numbers(text)
    return F.struct(F.array_min(numbers).alias("price_min"), F.array_max(numbers).alias("price_max"))


def moq(text: Column) -> Column:
    """First integer of a text that mentions MOQ."""
    return F.when(text.contains("MOQ"), first_group(text, r"(\d+)").try_cast("int"))


def spec_description(specs: Column, name: Column) -> Column:
    """Specifications longer than five characters without MOQ, joined; the name if none is left."""
    kept = F.filter(F.transform(specs, strip), lambda s: (F.length(s) > 5) & ~s.contains("MOQ"))
    return F.when(F.size(kept) > 0, F.array_join(kept, "; ")).otherwise(name)


def seed_keywords(category: Column, name: Column) -> Column:
    """The category and those of the first four words of the name that are longer than two characters."""
    words = F.slice(F.filter(F.split(name, r"(?U)\s+"), lambda w: w != ""), 1, 4)
    return F.concat(F.array(F.lower(category)), F.transform(F.filter(words, lambda w: F.length(w) > 2), F.lower))


def _start(text: Column, chars: int | None) -> Column:
    return text if chars is None else F.substring(text, 1, chars)


def first_valid(candidates: Sequence[Column], min_length: int) -> Column:
    """First candidate text that is long enough."""
    return F.get(F.filter(F.array(*candidates), lambda c: F.length(c) >= min_length), F.lit(0))


def card_name(titled: Column, heading: Column, card: Column, chars: int | None = 80) -> Column:
    """Titled heading, else any heading, of at least three characters; else ``chars`` of the card text, or all of it."""
    return F.coalesce(first_valid([titled, heading], 3), _start(card, chars))


def card_supplier(named: Column, texts: Column, name: Column) -> Column:
    """Named supplier of at least two characters, else the first text over four that is not the name."""
    other = F.get(F.filter(texts, lambda t: (F.length(t) > 4) & ~t.eqNullSafe(name)), F.lit(0))
    return F.coalesce(first_valid([named], 2), other)


def merge_detail(
    listing: DataFrame, detail: DataFrame, location_chars: int | None = 50, description_chars: int | None = 500
) -> DataFrame:
    """Let the detail page override rating, location (unless just the country) and description.

    The start of location and description counts, the whole text if the number of characters is ``None``. Of several
    detail rows of a product the newest counts. A price text of the detail page stands in for a missing one, if both
    sides have that column.
    """
    priced = "price_raw" in listing.columns and "price_raw" in detail.columns
    picked = latest_by_key(detail, "product_id", [c for c in ("scraped_at",) if c in detail.columns]).select(
        "product_id",
        F.col("supplier_rating").alias("_rating"),
        _start(F.col("supplier_location_raw"), location_chars).alias("_location"),
        _start(F.col("description"), description_chars).alias("_description"),
        *([F.col("price_raw").alias("_price")] if priced else []),
    )
    joined = listing.join(picked, "product_id", "left")
    location = F.when((F.col("_location") != "") & (F.col("_location") != "India"), F.col("_location"))
    merged = {
        "supplier_rating": F.coalesce(F.when(F.col("_rating") != 0, F.col("_rating")), "supplier_rating"),
        "supplier_location_raw": F.coalesce(location, "supplier_location_raw"),
        "description": F.coalesce(blank_to_null(F.col("_description")), "description"),
    }
    if priced:
        merged["price_raw"] = F.coalesce(blank_to_null(F.col("price_raw")), "_price")
    return joined.withColumns(merged).drop("_rating", "_location", "_description", "_price")


def fenced_body(text: Column) -> Column:
    """The part of a model answer that should be JSON."""
    tagged = F.regexp_extract(text, r"(?s)```json(.*?)(?:```|$)", 1)
    bare = F.regexp_extract(text, r"(?s)```(.*)```", 1)
    return strip(
        F.when(text.contains("```json"), tagged).when(text.contains("```"), bare).otherwise(text)
    )


def parse_fenced_json(df: DataFrame, text: str, schema: T.StructType, out: str = "parsed") -> DataFrame:
    """Add the parsed record, or an error and the start of the raw text where it is not JSON.

    Fields are read as text; :func:`clean_extracted` gives them their types.
    """
    fields = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    df = df.withColumn("_json", F.from_json(fenced_body(F.col(text)), fields, options))
    bad = F.col("_json").isNull() | F.col("_json._bad").isNotNull()
    return df.withColumns(
        {
            out: F.when(~bad, F.struct(*(F.col(f"_json.{f.name}") for f in schema.fields))),
            "error": F.when(bad, "Failed to parse extraction result"),
            "raw_response": F.when(bad, F.substring(F.col(text), 1, MAX_ERROR_TEXT)),
        }
    ).drop("_json")


# Fields of an extracted record by kind.
EXTRACTED_TEXT = (
    "product_id name currency unit supplier_name supplier_location description listing_url category subcategory".split()
)
EXTRACTED_NUMBERS = "price_min price_max moq supplier_rating response_rate".split()
EXTRACTED_LISTS = "certifications keywords".split()
TRUE_WORDS = ["true", "yes", "1"]

# Every field as text, which from_json also gives for nested values.
EXTRACTED_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in [*EXTRACTED_TEXT, *EXTRACTED_NUMBERS, "verified_supplier", *EXTRACTED_LISTS, "scraped_at"]
    ]
)


def text_list(col: Column) -> Column:
    """A list written as JSON or as comma text; other values give an empty list."""
    from_list = F.transform(
        F.filter(F.from_json(col, "array<string>"), lambda i: i.isNotNull()), strip
    )
    from_text = F.filter(F.transform(F.split(col, ","), strip), lambda i: i != "")
    return F.coalesce(
        F.when(strip(col).startswith("["), from_list).otherwise(from_text), F.array().cast("array<string>")
    )


def clean_extracted(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Coerce the text fields of an extracted record to their types, then repair the price range."""
    now = F.current_timestamp().cast("double") if now is None else now
    out = {c: strip(F.col(c).cast("string")) for c in EXTRACTED_TEXT}
    out |= {c: try_double(strip(F.col(c).cast("string"))) for c in EXTRACTED_NUMBERS}
    out["verified_supplier"] = F.coalesce(
        F.lower(F.col("verified_supplier").cast("string")).isin(TRUE_WORDS), F.lit(False)
    )
    out |= {c: text_list(F.col(c)) for c in EXTRACTED_LISTS}
    out["scraped_at"] = F.coalesce(try_double(F.col("scraped_at").cast("string")), now)
    return repair_price_range(df.withColumns(out))


def repair_price_range(df: DataFrame) -> DataFrame:
    """Order the two prices and copy the one present into the missing one; both ignore nulls."""
    low, high = F.least("price_min", "price_max"), F.greatest("price_min", "price_max")
    return df.withColumns({"price_min": low, "price_max": high})


def keep_original(extracted: DataFrame, raw_columns: Sequence[str], prefix: str = "raw_") -> DataFrame:
    """Fall back to the raw record's value where extraction gave none; raw columns carry ``prefix``."""
    return extracted.withColumns(
        {c: F.coalesce(c, f"{prefix}{c}") for c in raw_columns}
    ).drop(*(f"{prefix}{c}" for c in raw_columns))
