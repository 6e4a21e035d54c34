"""Landed pages to raw listing records: cards, the detail pages they link to, and both put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mandiscope.functions.text import try_double
from mandiscope.operators import extract
from mandiscope.sources.pages import CARD_SITES, DETAIL_SITES, SITE_ROOTS, site_cards, site_detail

# What a listing says before its detail page is read.
CURRENCY = "INR"
COUNTRY = "India"


def _fields(selectors) -> set[str]:
    return {s.field for s in selectors}


def _address(url: Column, root: str) -> Column:
    """Product id of an absolute or relative address."""
    return extract.product_id(extract.resolve_url(url, root))


def card_records(pages: DataFrame, site: str, category: Column | str, scraped_at: Column, key: str = "page_id") -> DataFrame:
    """One raw record per card of the listing pages, with the page's ``key`` and the card's ``pos``.

    A card without a link has no address; its id is a hash of its page, position and text. Fields that a site's cards
    do not have are null.
    """
    has = _fields(CARD_SITES[site][2])
    category = F.lit(category) if isinstance(category, str) else category

    def found(name: str, kind: str = "string") -> Column:
        return F.col(name) if name in has else F.lit(None).cast(kind)

    known = pages.select(key, "html", category.alias("category"), scraped_at.alias("scraped_at"))
    cards = site_cards(known, site, key, ["category", "scraped_at"])
    name = extract.card_name(F.col("name"), F.col("heading"), F.col("card_text")) if "heading" in has else F.col("name")
    supplier = found("supplier_name")
    if "texts" in has:
        supplier = extract.card_supplier(supplier, F.col("texts"), name)
    url = extract.resolve_url(F.col("href"), SITE_ROOTS[site])
    unlinked = F.xxhash64(key, "pos", "card_text").cast("string")
    described = extract.spec_description(F.col("specs"), name) if "specs" in has else F.lit(None).cast("string")
    return cards.select(
        key,
        "pos",
        F.when(url.isNull(), unlinked).otherwise(extract.product_id(url)).alias("product_id"),
        name.alias("name"),
        found("price_raw").alias("price_raw"),
        F.lit(CURRENCY).alias("currency"),
        extract.moq(found("moq_raw")).alias("moq"),
        supplier.alias("supplier_name"),
        F.lit(None).cast("double").alias("supplier_rating"),
        F.lit(COUNTRY).alias("supplier_location_raw"),
        extract.seed_keywords(F.col("category"), name).alias("keywords"),
        "category",
        described.alias("description"),
        url.alias("listing_url"),
        "scraped_at",
        F.lit(site).alias("source"),
    )


def detail_records(pages: DataFrame, site: str, scraped_at: Column, key: str = "page_id") -> DataFrame:
    """One record per detail page, with the product id its ``url`` names; absent fields are left out."""
    has = _fields(DETAIL_SITES[site])
    known = pages.select(key, "html", F.col("url").alias("page_url"), scraped_at.alias("scraped_at"))
    fields = site_detail(known, site, key, ["page_url", "scraped_at"])
    out = {c: F.col(c) for c in ("name", "price_raw", "supplier_name", "supplier_location_raw", "description", "certifications_raw") if c in has}
    out["supplier_rating"] = try_double(F.col("supplier_rating")) if "supplier_rating" in has else F.lit(None).cast("double")
    if "moq_raw" in has:
        out["moq_raw"] = extract.labelled_value(F.col("moq_raw"), extract.MOQ_LABEL)
    if "unit" in has:
        out["unit"] = extract.labelled_value(F.col("unit"), extract.UNIT_LABEL)
    if "response_rate" in has:
        out["response_rate"] = extract.labelled_number(F.col("response_rate"), extract.RESPONSE_LABEL)
    if "badge" in has:
        out["verified_supplier"] = extract.has_badge(F.col("badge"))
    return fields.select(
        _address(F.col("page_url"), SITE_ROOTS[site]).alias("product_id"), *(c.alias(n) for n, c in out.items()), "scraped_at"
    )


def page_listings(
    pages: DataFrame,
    details: DataFrame | None,
    site: str,
    category: Column | str,
    scraped_at: Column,
    key: str = "page_id",
) -> DataFrame:
    """Raw listings of a site: the cards of ``pages``, completed by the pages of ``details`` their links lead to.

    The detail page overrides rating, location and description and gives the price where the card has none; prices are
    read after that. Pages without cards give no rows, cards without a detail page stay as they are.
    """
    records = card_records(pages, site, category, scraped_at, key)
    if details is not None:
        records = extract.merge_detail(records, detail_records(details, site, scraped_at, key))
    prices = extract.price_range(F.col("price_raw"))
    return records.withColumn("_p", prices).withColumns({"price_min": F.col("_p.price_min"), "price_max": F.col("_p.price_max")}).drop("_p")
