"""The rules whose details change answers, on hand-written rows."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandiscope.functions.lookups import CITY_STATE, STATE_REGION, UNIT_SPELLINGS, lookup_frame
from mandiscope.operators import dedup, enrich, extract, geo, normalize, relational, validate
from mandiscope.plans import dashboard, pricing, summary
from mandiscope.plans.refine import record_step, refine

PRICE = "product_id string, price_min double, price_max double, currency string"


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_lookup_sizes():
    assert len(CITY_STATE) == len(dict(CITY_STATE)) == 52
    assert len(STATE_REGION) == 31 and len({r for _, r in STATE_REGION}) == 6
    assert len(dict(UNIT_SPELLINGS)) == len(UNIT_SPELLINGS)


@pytest.mark.parametrize(
    "text, code",
    [("usd", "USD"), ("$", "USD"), ("€", "EUR"), ("¥", "CNY"), (" rupee ", "INR"), ("xyz", "XYZ"), ("beads", "USD"), ("", "USD")],
)
def test_currency_code(spark, text, code):
    df = spark.createDataFrame([(text,)], "c string")
    assert rows(df, normalize.currency_code(F.col("c"))) == [(code,)]


def test_prices(spark):
    data = [
        ("inr", 44.0, 1050.0, "INR"),
        ("lower", 5.0, 6.0, "usd"),
        ("sign", 5.0, 6.0, "$"),
        ("null", 5.0, 6.0, None),
        ("unknown", 5.0, 6.0, "XQX"),
        ("unpriced", None, None, "INR"),
        ("half", None, 100.0, "EUR"),
    ]
    df = spark.createDataFrame(data, PRICE)
    columns = ["product_id", "price_min", "price_max", "currency", "original_currency", "currency_conversion_failed"]
    rates = lookup_frame(spark, [("USD", 1.0), ("INR", 0.010526), ("EUR", 1.08)], "from_currency", "rate")
    got = {r[0]: r[1:] for r in rows(normalize.normalize_prices(df, rates), *columns)}
    assert got["inr"] == (0.46, 11.05, "USD", "INR", None)
    assert got["lower"] == (5.0, 6.0, "USD", None, None)
    assert got["sign"][2] == "USD" and got["null"][2] is None
    assert got["unknown"] == (5.0, 6.0, "XQX", None, True)
    assert got["unpriced"] == (None, None, "INR", None, None)
    assert got["half"] == (None, 108.0, "USD", "EUR", None)
    strict = {r[0]: r[1] for r in rows(normalize.normalize_prices(df, rates, keep_spelling=True), "product_id", "currency")}
    assert strict["lower"] == "usd" and strict["sign"] == "$"


@pytest.mark.parametrize(
    "unit, standard",
    [("Pcs.", "pieces"), ("PIECES", None), ("KG.", None), ("KGS", "kg"), (" Sq.  Ft", None), ("sq. meter", None),
     ("Square  Meter", "square meters"), ("dozen", None), ("", None), (None, None)],
)
def test_unit(spark, unit, standard):
    df = spark.createDataFrame([(unit,)], "unit string")
    assert rows(normalize.normalize_unit(df), "unit", "original_unit") == [
        (standard, unit) if standard else (unit, None)
    ]


# Raw location, city, state, country, region.
GOLDEN = [
    ("Mumbai, Maharashtra", "Mumbai", "Maharashtra", "India", "West India"),
    ("India", "India", None, None, None),
    ("Ahmedabad", "Ahmedabad", "Gujarat", "India", "West India"),
    ("Hyderabad", "Hyderabad", "Telangana", "India", "South India"),
    ("Cnc Turning Center - General Use: Industrial at Best Price in New Delhi | Kwality Enterprises", None,
     "Cnc Turning Center", "General Use: Industrial at Best Price in New Delhi | Kwality Enterprises", None),
    ("Ic 666 Iso Tank Cleaner at 150.00 INR in Mumbai | Indochem Enterprises",
     "Ic 666 Iso Tank Cleaner at 150.00 INR in Mumbai | Indochem Enterprises", "Maharashtra", "India", "West India"),
    ("L7808cv-dg St Microelectronic Linear Voltage Regulators - Color: Black at Best Price in Delhi | Kirti Enterprises",
     "L7808cv", "dg St Microelectronic Linear Voltage Regulators",
     "Color: Black at Best Price in Delhi | Kirti Enterprises", None),
    ("Ethylene Diamine at 1239.00 INR in Mumbai, Maharashtra | A. B. Enterprises", None,
     "Ethylene Diamine at 1239.00 INR in Mumbai", "Maharashtra | A. B. Enterprises", None),
    ("Mumbai, India", None, "Mumbai", "India", None),
    ("Kerala", None, "Kerala", "India", "South India"),
    (" , ", None, None, None, None),
]


def test_locations(spark):
    df = spark.createDataFrame([(g[0],) for g in GOLDEN], "place string")
    got = {r[0]: r for r in rows(geo.parse_location(df, F.col("place")), "place", "geo_city", "geo_state", "geo_country", "geo_region")}
    for want in GOLDEN:
        assert got[want[0]] == want


def test_geo_overwrite(spark):
    df = spark.createDataFrame(
        [("Nowhere, Atlantis", "Pune", "West India"), (None, "Pune", "West India")],
        "supplier_location_raw string, supplier_city string, supplier_region string",
    )
    kept = rows(geo.enrich_geo(df), "supplier_city", "supplier_region")
    assert kept == [("Pune", "West India")] * 2
    written = rows(geo.enrich_geo(df, overwrite=True), "supplier_city", "supplier_region")
    assert sorted(written, key=str) == [("Pune", "West India"), (None, None)]


def test_tiers_and_stars(spark):
    df = spark.createDataFrame(
        [(4.0, True), (3.9, True), (3.0, True), (5.0, False), (None, True), (2.5, True)],
        "supplier_rating double, verified_supplier boolean",
    )
    assert [r[0] for r in rows(df, relational.supplier_tier())] == [
        "Gold", "Silver", "Silver", "Unverified", "Unverified", "Unverified"]
    assert [r[0] for r in rows(df, relational.supplier_tier(4.5, 3.5))][:3] == ["Silver", "Silver", "Unverified"]
    assert rows(df.limit(1), relational.rating_stars(F.lit(2.5)))[0][0] == "★★★☆☆"


def test_extraction(spark):
    df = spark.createDataFrame([("Price:1,050 - 3,500.50 INR", "MOQ-100Meter", "Name of thing one two")], "p string, m string, n string")
    got = df.select(
        extract.price_range(F.col("p")).alias("r"), extract.moq(F.col("m")).alias("m"),
        extract.seed_keywords(F.lit("Textiles"), F.col("n")).alias("k"),
        extract.price_range(F.lit(""), F.lit("7")).alias("d"),
    ).first()
    assert tuple(got.r) == (1050.0, 3500.5) and got.m == 100 and tuple(got.d) == (7.0, 7.0)
    assert got.k == ["textiles", "name", "thing", "one"]


@pytest.mark.parametrize(
    "href, base, want",
    [("/p/1", "https://a.com/x/y?q", "https://a.com/p/1"), ("b.html", "https://a.com/x/y", "https://a.com/x/b.html"),
     ("https://b.com/z", "https://a.com", "https://b.com/z"), ("//c.com/z", "http://a.com/x", "http://c.com/z"),
     ("../c.html", "https://x.com/a/b/d.html", "https://x.com/a/c.html"), ("mailto:a@b.c", "https://x.com/a/b", "mailto:a@b.c"),
     ("../../../z?q=..", "https://x.com/a/b", "https://x.com/z?q=.."), ("./", "https://x.com/a/b", "https://x.com/a/"),
     ("b", "https://a.com", "https://a.com/b"), ("?q=1", "https://a.com/x", "https://a.com/x?q=1")],
)
def test_urls(spark, href, base, want):
    df = spark.createDataFrame([(href, base)], "h string, b string")
    assert rows(df, extract.resolve_url(F.col("h"), F.col("b"))) == [(want,)]


def test_product_ids(spark):
    urls = ["https://t.com/products/a-b-c123.html", "https://t.com/product/x9/", "https://t.com/q/z.html", "https://t.com/none"]
    got = [r[0] for r in rows(spark.createDataFrame([(u,) for u in urls], "u string"), extract.product_id(F.col("u")))]
    assert got[:3] == ["TI-123", "x9", "z"] and int(got[3]) != 0


def test_fenced_json_and_cleaning(spark):
    texts = ['x\n```json\n{"name": " A ", "price_min": "9", "certifications": ["a ", null]}\n```', "```\n{\"name\":\"B\"}\n```", "no json"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = extract.parse_fenced_json(df, "t", extract.EXTRACTED_SCHEMA)
    cleaned = extract.clean_extracted(parsed.where(F.col("error").isNull()).select("parsed.*"), F.lit(1.0))
    got = {r.name: r for r in cleaned.collect()}
    assert got["A"].price_min == got["A"].price_max == 9.0 and got["A"].certifications == ["a"]
    assert got["B"].verified_supplier is False and got["B"].keywords == []
    bad = parsed.where(F.col("error").isNotNull()).first()
    assert bad.raw_response == "no json" and bad.parsed is None


def test_keep_original(spark):
    df = spark.createDataFrame([(None, "raw"), ("new", "raw")], "name string, raw_name string")
    assert rows(extract.keep_original(df, ["name"]), "name") == [("raw",), ("new",)]


def test_keywords_and_entities(spark):
    text = "The high-speed steel drill, 5 mm and 230 V AC motor; STEEL body 2kW"
    df = spark.createDataFrame([(text,)], "t string")
    words, found = df.select(enrich.extract_keywords(F.col("t")), enrich.extract_entities(F.col("t"))).first()
    assert words[0] == "high-speed steel drill" and "drill" in words and "the" not in words
    assert words == sorted(words, key=lambda w: (-len(w), w))
    assert {tuple(e) for e in found} == {
        ("steel", "MATERIAL"), ("5 mm", "MEASUREMENT"), ("230 V AC", "VOLTAGE"), ("2kW", "POWER")}


def test_short_description_takes_name(spark):
    df = spark.createDataFrame([("Brass valve", "Copper pipe"), ("Brass valve", None)], "name string, description string")
    got = rows(enrich.enrich_text(df), "keywords")
    assert got[0][0] == ["brass", "brass valve", "copper", "copper pipe", "pipe", "valve"]
    assert got[1][0] == ["brass", "brass valve", "valve"]


def test_validation(spark):
    df = spark.createDataFrame(
        [("a", "x", "USD", "2", 1.0, 2.0, 5.0), ("b", "x", None, "2.5", 1.0, 2.0, 5.0), ("c", "x", "", "3", 1.0, 2.0, 5.1),
         (None, "x", "usd", "3", -1.0, -2.0, None)],
        "product_id string, name string, currency string, moq string, price_min double, price_max double, supplier_rating double",
    )
    good = validate.validate_products(df).collect()
    assert [r.product_id for r in good] == ["a"] and good[0].moq == 2 and good[0].certifications == []
    bad = {r.product_id: r.reasons for r in validate.rejected_rows(df).collect()}
    assert bad["b"] == ["moq: type"] and bad["c"] == ["supplier_rating: range"]
    assert set(bad[None]) == {"product_id: missing", "price_min: negative", "price_max: negative",
                              "price_max: below price_min", "currency: format"}
    strict = validate.rejected_rows(df, currency_default=None)
    assert "currency: missing" in {r.product_id: r.reasons for r in strict.collect()}["b"]


def test_explorer_and_nulls_as_zero(spark):
    df = spark.createDataFrame(
        [("a", None, None, "Mumbai"), ("b", 10.0, 30.0, "Navi Mumbai"), ("c", 10.0, 30.0, None)],
        "product_id string, price_min double, price_max double, supplier_city string",
    )
    assert {r.product_id for r in relational.explorer_filter(df, city=" MUM ", price_from=0, price_to=50).collect()} == {"a", "b"}
    assert {r.product_id for r in relational.explorer_filter(df, price_from=1).collect()} == {"b", "c"}


def test_histogram_of_constant(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    got = summary.histogram(df, ["x"], 4).where("n > 0").collect()
    assert [(r.bin, r.n) for r in got] == [(2, 2)]


def test_p_values():
    # Critical values of Student's t.
    assert pricing.student_p_value(12.706, 1) == pytest.approx(0.05, abs=1e-4)
    assert pricing.student_p_value(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert pricing.student_p_value(1.96, 1e7) == pytest.approx(0.05, abs=1e-4)
    assert pricing.student_p_value(0.0, 5) == 1.0 and pricing.student_p_value(float("inf"), 5) == 0.0


def test_daily_volume_bounds(spark):
    start = dashboard.VOLUME_START
    df = spark.createDataFrame([(float(start),), (start + 30 * 86400.0,), (start - 1.0,)], "scraped_at double")
    got = dashboard.daily_volume(df).orderBy("day").collect()
    assert len(got) == 30 and got[0].n == 1 and sum(r.n for r in got) == 1


def test_record_step_and_refine(spark):
    schema = T.StructType([T.StructField("name", T.StringType())])
    step = record_step(lambda r: {"name": r["name"].upper()}, schema)
    assert rows(step(spark.createDataFrame([("a",)], schema)), "name") == [("A",)]
    df = spark.createDataFrame(
        [("1", "Steel pump", "Acme", 1.0, 2.0, "INR", "KGS", 10.0, "Pune", "Steel pump"),
         ("2", "steel  pumps", "ACME", 3.0, 4.0, "INR", "KGS", 20.0, "Pune", "Steel pump")],
        "product_id string, name string, supplier_name string, price_min double, price_max double, currency string, "
        "unit string, scraped_at double, supplier_location string, description string",
    )
    (only,) = refine(df).collect()
    assert (only.product_id, only.unit, only.currency, only.price_min, only.supplier_region) == ("2", "kg", "USD", 0.04, "West India")


def test_dedup_rate(spark):
    df = spark.createDataFrame([("a",), ("b",)], "x string")
    assert rows(dedup.dedup_rate(df, df.limit(1)), "removed_pct") == [(50.0,)]


def test_neighbouring_entities(spark):
    texts = ["copper brass steel fitting, nylon plastic", "Brass/copper pipe", "ref X12m", "Model 5, m type", "5 mm 6 mm"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [[e["text"] for e in r[0]] for r in df.select(enrich.extract_entities(F.col("t"))).collect()]
    assert found == [["copper", "brass", "steel", "nylon", "plastic"], ["Brass", "copper"], [], [], ["5 mm", "6 mm"]]


def test_partial_city_takes_the_first_hit(spark):
    texts = ["Navi Mumbai", "old delhi road", "Pun", "Goa and Pune", "", "nowhere at all", "BENGALURU east", None]
    column = geo.partial_city_state(F.col("t"))
    got = {r.t: r.s for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", column.alias("s")).collect()}
    hits = {t: [s for c, s in CITY_STATE if t is not None and (t.lower() in c.lower() or c.lower() in t.lower())] for t in texts}
    assert got == {t: (found or [None])[0] for t, found in hits.items()}
    # Compiled conditions, not a filter over an array of all cities.
    assert "filter(" not in str(column)


def test_texts_without_entities_are_searched_once(spark, folder):
    texts = ["", "5", "steely 5 mmx", "x5 mm", "\u0665 kg", "7/8INCHES", "1,5.", "230 V  AC", "glass5 hz", "9 kw-5Hz", "wood", "12 v dcx", "3\u00a0m"]
    ownwords = [(t, re.sub(r"\W", "", t)) for t in texts]
    df = spark.createDataFrame([(t,) for pair in ownwords for t in pair] + [(None,)], "t string")
    some = F.lit(False)
    for pattern in enrich.entity_patterns().values():
        some |= F.col("t").rlike(pattern)
    got = df.select("t", some.alias("some"), F.col("t").rlike(enrich.any_entity()).alias("any"), enrich.extract_entities(F.col("t")).alias("e")).collect()
    assert all(r.some == r.any and (r.e is None if r.t is None else r.any or r.e == []) for r in got)
    assert {r.any for r in got} == {True, False, None}
    assert [[e.text for e in r.e] for r in got if r.t in ("7/8INCHES", "9 kw-5Hz")] == [["7/8INCHES"], ["9 kw", "5Hz"]]


def test_lists_that_arrive_as_text(spark):
    rows = [("a", '["x", "y"]'), ("b", "x, y"), ("c", None), ("d", "[broken"), ("e", " [] ")]
    df = spark.createDataFrame(rows, "product_id string, certifications string")
    got = {r.product_id: (r.certifications, r.coercion_errors) for r in validate.coerce_types(df).collect()}
    wrong = (None, ["certifications: type"])
    assert got == {"a": (["x", "y"], []), "b": wrong, "c": (None, []), "d": wrong, "e": ([], [])}
