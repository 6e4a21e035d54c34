"""Fields out of pages and text."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandiscope.catalog.registry import query, r, rounded, with_listings
from mandiscope.operators import extract
from mandiscope.plans.page_listings import page_listings
from mandiscope.sources.listings import decode_lists, encode_lists, union_sources
from mandiscope.sources.pages import Selector, extract_cards, extract_detail, extract_with
from mandiscope.sources.tables import listings, table


def unescaped(expression: str) -> str:
    """SQL for the entities that occur in the pages."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&amp;", "&")):
        expression = f"replace({expression}, '{entity}', '{char}')"
    # A text cut inside its last entity.
    return f"regexp_replace({expression}, '&amp$', '&')"


@query(
    "extract_cards",
    f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, trim({unescaped("regexp_extract(li, '>(.*?)</a>', 1)")}) AS title,
      {unescaped("regexp_extract(li, 'href=\"([^\"]*)\"', 1)")} AS href
    FROM (SELECT page_id, unnest(cards) AS li, generate_subscripts(cards, 1) AS i
      FROM (SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) AS cards FROM pages))""",
)
def cards(spark, folder):
    fields = [Selector("title", "a"), Selector("href", "a", None, "href")]
    return extract_cards(table(spark, folder, "pages"), fields, "li").drop("card_text")


@query(
    "extract_detail",
    f"""SELECT page_id, trim({unescaped("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}) AS title,
      trim({unescaped("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}) AS name,
      regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
      trim({unescaped("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)")}) AS description FROM pages""",
)
def detail(spark, folder):
    fields = [
        Selector("title", "title"),
        Selector("name", "h1"),
        Selector("name", "div", "product-name|title"),
        Selector("lang", "html", None, "lang"),
        Selector("description", "div", "description|about|details|ad"),
    ]
    return extract_detail(table(spark, folder, "pages"), fields)


DETAIL_TEXT = """CASE l_returnflag WHEN 'A' THEN 'Minimum Order :  ' || CAST(l_quantity AS INTEGER) || ' pieces: boxed'
  WHEN 'N' THEN 'response rate:' || CAST(l_tax * 1000 AS INTEGER) || '%' ELSE ' Packaging ' || l_linestatus || ' ' END"""
VALUE = r"CASE WHEN contains(t, ':') THEN trim(regexp_replace(t, '(?s)^[^:]*:', '')) ELSE trim(t) END"


@query(
    "labelled_value",
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN regexp_matches(t, '(?i)MOQ|Minimum Order') THEN {VALUE} END AS moq_raw,
      CASE WHEN regexp_matches(t, '(?i)Unit|Packaging') THEN {VALUE} END AS unit,
      CASE WHEN regexp_matches(t, '(?i)Response Rate') THEN TRY_CAST(replace({VALUE}, '%', '') AS DOUBLE) END AS response_rate
    FROM (SELECT l_orderkey, l_linenumber, {DETAIL_TEXT} AS t FROM lineitem)""",
)
def labelled(spark, folder):
    text = (
        F.when(
            F.col("l_returnflag") == "A",
            F.concat(F.lit("Minimum Order :  "), F.col("l_quantity").cast("int").cast("string"), F.lit(" pieces: boxed")),
        )
        .when(
            F.col("l_returnflag") == "N",
            F.concat(F.lit("response rate:"), F.round(F.col("l_tax") * 1000).cast("int").cast("string"), F.lit("%")),
        )
        .otherwise(F.concat(F.lit(" Packaging "), "l_linestatus", F.lit(" ")))
    )
    t = F.col("t")
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", text.alias("t")).select(
        "l_orderkey",
        "l_linenumber",
        extract.labelled_value(t, extract.MOQ_LABEL).alias("moq_raw"),
        extract.labelled_value(t, extract.UNIT_LABEL).alias("unit"),
        extract.labelled_number(t, extract.RESPONSE_LABEL).alias("response_rate"),
    )


BADGE = """CASE c_mktsegment WHEN 'MACHINERY' THEN 'a VERIFIED seller' WHEN 'BUILDING' THEN 'trusted' ELSE c_mktsegment END"""


@query(
    "has_badge",
    f"""SELECT 'c' || c_custkey AS id, regexp_matches({BADGE}, '(?i)verified|trusted') AS verified FROM customer
    UNION ALL SELECT 'd' || doc_id, regexp_matches(text, '(?i)verified|trusted') FROM documents""",
)
def badges(spark, folder):
    segment = F.col("c_mktsegment")
    badge = F.when(segment == "MACHINERY", "a VERIFIED seller").when(segment == "BUILDING", "trusted").otherwise(segment)
    customers = table(spark, folder, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), badge.alias("t"))
    documents = table(spark, folder, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), F.col("text").alias("t"))
    return customers.unionByName(documents).select("id", extract.has_badge(F.col("t")).alias("verified"))


@query(
    "resolve_url",
    """SELECT page_id, href, CASE WHEN regexp_matches(href, '^(https?|mailto):') THEN href
      WHEN href LIKE './%' THEN folder || substr(href, 3)
      WHEN href LIKE '../%' AND regexp_matches(folder, '^[a-z]+://[^/]*/$') THEN folder || substr(href, 4)
      WHEN href LIKE '../%' THEN regexp_replace(folder, '[^/]+/$', '') || substr(href, 4)
      WHEN href LIKE '/%' THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href
      WHEN href = '' THEN url
      ELSE folder || href END AS link
    FROM (SELECT *, regexp_extract(url, '^([a-z]+://[^/?#]*(?:/[^?#]*/|/)?)', 1) AS folder FROM
      (SELECT page_id, url, unnest(list_concat(regexp_extract_all(html, 'href="([^"]*)"', 1),
        ['p7.html', url, '', '../up.html', './here.html', 'mailto:a@b.c'])) AS href FROM pages))""",
)
def links(spark, folder):
    found = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    all_links = F.concat(found, F.array(F.lit("p7.html"), F.col("url"), *map(F.lit, ("", "../up.html", "./here.html", "mailto:a@b.c"))))
    pages = table(spark, folder, "pages").select("page_id", "url", F.explode(all_links).alias("href"))
    return pages.select("page_id", "href", extract.resolve_url(F.col("href"), F.col("url")).alias("link"))


URL_FORM = """CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'https://m.example.com/products/red-lathe-c' || page_id || '.html'
  WHEN 2 THEN 'https://m.example.com/product/' || page_id || '/spec' ELSE 'https://m.example.com/x/item' || page_id || '.html' END"""


@query(
    "url_product_id",
    f"""SELECT page_id, CASE WHEN regexp_matches(u, '/products/[^/]+-c[0-9]+') THEN 'TI-' || regexp_extract(u, '/products/[^/]+-c([0-9]+)', 1)
      WHEN regexp_matches(u, '/product/[^/]+') THEN regexp_extract(u, '/product/([^/]+)', 1)
      WHEN regexp_matches(u, '/[^/]+\\.html') THEN regexp_extract(u, '/([^/]+)\\.html', 1) ELSE 'hashed' END AS product_id
    FROM (SELECT page_id, {URL_FORM} AS u FROM pages)""",
)
def url_ids(spark, folder):
    i, key = F.col("page_id") % 4, F.col("page_id").cast("string")
    url = (
        F.when(i == 0, F.col("url"))
        .when(i == 1, F.concat(F.lit("https://m.example.com/products/red-lathe-c"), key, F.lit(".html")))
        .when(i == 2, F.concat(F.lit("https://m.example.com/product/"), key, F.lit("/spec")))
        .otherwise(F.concat(F.lit("https://m.example.com/x/item"), key, F.lit(".html")))
    )
    pages = table(spark, folder, "pages").select("page_id", url.alias("u"))
    # A hash has no counterpart in SQL, so only that it is one is shown.
    hashed = F.xxhash64("u").cast("string") == extract.product_id(F.col("u"))
    return pages.select("page_id", F.when(hashed, "hashed").otherwise(extract.product_id(F.col("u"))).alias("product_id"))


NUMBERS = r"list_transform(regexp_extract_all(replace(t, ',', ''), '\d+\.?\d*'), lambda x: CAST(x AS DOUBLE))"
PRICE_TEXT = """CASE WHEN p_size % 5 = 0 THEN '' ELSE 'Rs 1,' || lpad(CAST(p_size AS VARCHAR), 3, '0') || '.50 to 2,'
  || lpad(CAST(p_size AS VARCHAR), 3, '0') || ' INR (Approx.)' END"""


@query(
    "price_range",
    f"""SELECT id, list_min({NUMBERS}) AS price_min, list_max({NUMBERS}) AS price_max FROM (
      SELECT 'd' || doc_id AS id, text AS t FROM documents UNION ALL
      SELECT 'p' || p_partkey, coalesce(nullif({PRICE_TEXT}, ''), 'from ' || p_size || '.75') FROM part)""",
)
def price_ranges(spark, folder):
    size = F.col("p_size")
    padded = F.lpad(size.cast("string"), 3, "0")
    listing = F.when(size % 5 == 0, "").otherwise(
        F.concat(F.lit("Rs 1,"), padded, F.lit(".50 to 2,"), padded, F.lit(" INR (Approx.)"))
    )
    detail = F.concat(F.lit("from "), size.cast("string"), F.lit(".75"))
    parts = table(spark, folder, "part").select(
        F.concat(F.lit("p"), "p_partkey").alias("id"), listing.alias("listing"), detail.alias("detail")
    )
    documents = table(spark, folder, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("id"), F.col("text").alias("listing"), F.lit(None).cast("string").alias("detail")
    )
    both = parts.unionByName(documents)
    found = both.withColumn("r", extract.price_range(F.col("listing"), F.col("detail")))
    return found.select("id", "r.price_min", "r.price_max")


@query(
    "moq_parse",
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_size END AS moq FROM part""",
)
def moqs(spark, folder):
    text = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("MOQ - "), F.col("p_size").cast("string"), F.lit(" of 9 Pieces")))
    other = text.when(F.col("p_size") % 3 == 1, "MOQ on request").otherwise("Minimum 12")
    return table(spark, folder, "part").select("p_partkey", extract.moq(other).alias("moq"))


TRIMMED = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


@query(
    "spec_description",
    f"""SELECT doc_id, md5(CASE WHEN len(s) > 0 THEN array_to_string(s, '; ') ELSE source END) AS description,
    len(s) AS specs FROM (SELECT doc_id, source, list_filter(list_transform(string_split(text, chr(10)), lambda x: {TRIMMED.format('x')}),
      lambda x: length(x) > 5 AND NOT contains(x, 'MOQ')) AS s FROM documents)""",
)
def spec_descriptions(spark, folder):
    specs = F.split("text", "\n")
    described = extract.spec_description(specs, F.col("source"))
    kept = F.filter(F.transform(specs, extract.strip), lambda s: (F.length(s) > 5) & ~s.contains("MOQ"))
    return table(spark, folder, "documents").select(
        "doc_id", F.md5(described.cast("binary")).alias("description"), F.size(kept).cast("bigint").alias("specs")
    )


@query(
    "seed_keywords",
    """SELECT doc_id, array_to_string(list_concat([lower(source)], list_transform(list_filter(list_slice(list_filter(
      string_split_regex(text, '\\s+'), lambda w: w <> ''), 1, 4), lambda w: length(w) > 2), lambda w: lower(w))), '|') AS keywords FROM documents""",
)
def seeds(spark, folder):
    words = extract.seed_keywords(F.col("source"), F.col("text"))
    return table(spark, folder, "documents").select("doc_id", F.array_join(words, "|").alias("keywords"))


@query(
    "merge_detail",
    """SELECT d.doc_id AS product_id, CAST(coalesce(nullif(quality * 4.5, 0), 1.0) AS DOUBLE) AS supplier_rating,
      CASE WHEN toxic = 1 THEN 'Mumbai, Maharashtra' ELSE 'India' END AS supplier_location_raw,
      md5(CASE WHEN quality = 1 THEN left(text, 500) ELSE lang END) AS description
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def merged(spark, folder):
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    listing = documents.select(
        F.col("doc_id").alias("product_id"),
        F.lit(1.0).alias("supplier_rating"),
        F.lit("India").alias("supplier_location_raw"),
        F.col("lang").alias("description"),
    )
    detail = labels.join(documents, "doc_id").select(
        F.col("doc_id").alias("product_id"),
        (F.col("quality") * 4.5).alias("supplier_rating"),
        F.when(F.col("toxic") == 1, "Mumbai, Maharashtra").otherwise("India").alias("supplier_location_raw"),
        F.when(F.col("quality") == 1, F.col("text")).alias("description"),
    )
    out = extract.merge_detail(listing, detail)
    return out.withColumn("description", F.md5(F.col("description").cast("binary")))


# A card and its detail page for every page. Cards differ in title, link, supplier, price and MOQ by the page's number.
CARD_NAME = "CASE page_id % 3 WHEN 0 THEN 'Lathe ' || page_id ELSE 'Steel pump ' || page_id END"


def _site_pages(pages):
    key, at = F.col("page_id").cast("string"), lambda n: F.col("page_id") % n
    name = F.concat(F.when(at(3) == 0, "Lathe ").otherwise("Steel pump "), key)
    address = F.concat(F.lit("/products/item-c"), key, F.lit(".html"))
    card = F.concat(
        F.lit('<div class="row fullwidthcard"><a href="/help">Help</a><a href="'), address, F.lit('">open</a>'),
        F.when(at(3) == 0, F.lit('<h2 class="card_title"> ')).otherwise(F.lit("<h2>")), name, F.lit("</h2>"),
        F.when(at(4) == 0, F.lit('<span class="anchor-wrapper">Acme &amp; Co</span>')).otherwise(F.lit("<p>abc</p><p></p>")),
        F.when(at(5) < 3, F.concat(F.lit('<div class="price-box">Rs 1,'), F.lpad((F.col("page_id") % 1000).cast("string"), 3, "0"), F.lit(" - 2,500.50</div>"))).otherwise(F.lit("")),
        F.lit('<p class="wordbreak">Finish - Blue</p><p class="wordbreak">MOQ - '), (at(90) + 5).cast("string"), F.lit(" Pieces</p>"),
        F.lit('<p class="wordbreak">Host '), F.col("url"), F.lit("</p></div>"),
    )
    detail = F.concat(
        F.lit("<html><h1>"), name, F.lit('</h1><span class="price">Rs 75</span>'),
        F.when(at(2) == 0, F.lit('<span class="rating">4.5</span>')).otherwise(F.lit('<span class="rating">new</span>')),
        F.when(at(4) == 1, F.lit('<p>Plant: <span class="city">Pune</span></p>'))
        .when(at(4) == 2, F.lit("<p><b>Works</b> in Surat, Gujarat </p>")).otherwise(F.lit("")),
        F.when(at(6) == 0, F.lit('<div class="description">Made to order</div>')).otherwise(F.lit("")), F.lit("</html>"),
    )
    cards = pages.select("page_id", "url", F.concat(F.lit("<body>"), card, F.lit("<div>no card</div></body>")).alias("html"))
    return cards, pages.where(at(7) != 0).select("page_id", address.alias("url"), detail.alias("html"))


@query(
    "page_listings",
    f"""SELECT 'TI-' || page_id AS product_id, {CARD_NAME} AS name, 'https://www.tradeindia.com/products/item-c' || page_id || '.html' AS listing_url,
      CASE WHEN page_id % 4 = 0 THEN 'Acme & Co' ELSE 'Finish - Blue' END AS supplier_name,
      CAST(CASE WHEN page_id % 5 < 3 THEN 1000 + page_id % 1000 WHEN page_id % 7 <> 0 THEN 75 END AS DOUBLE) AS price_min,
      CAST(CASE WHEN page_id % 5 < 3 THEN 2500.5 WHEN page_id % 7 <> 0 THEN 75 END AS DOUBLE) AS price_max,
      CAST(page_id % 90 + 5 AS INTEGER) AS moq, CASE WHEN page_id % 7 <> 0 AND page_id % 2 = 0 THEN 4.5 END AS supplier_rating,
      CASE WHEN page_id % 7 <> 0 AND page_id % 4 = 1 THEN 'Plant:Pune' WHEN page_id % 7 <> 0 AND page_id % 4 = 2 THEN 'in Surat, Gujarat'
        ELSE 'India' END AS supplier_location_raw,
      CASE WHEN page_id % 7 <> 0 AND page_id % 6 = 0 THEN 'Made to order' ELSE 'Finish - Blue; Host ' || url END AS description,
      CASE WHEN page_id % 3 = 0 THEN 'machines|lathe' ELSE 'machines|steel|pump' END || CASE WHEN page_id > 99 THEN '|' || page_id ELSE '' END AS keywords
    FROM pages""",
)
def listings_of_pages(spark, folder):
    """Cards and detail pages of one site, put together to raw listings."""
    cards, details = _site_pages(table(spark, folder, "pages"))
    out = page_listings(cards, details, "tradeindia_search", "Machines", F.lit(1.0))
    columns = "product_id name listing_url supplier_name price_min price_max moq supplier_rating supplier_location_raw description".split()
    return out.select(*columns, F.array_join("keywords", "|").alias("keywords"))


FENCED = """CASE turn % 4 WHEN 0 THEN 'Here:' || chr(10) || '```json' || chr(10) || '{"name":"' || role || '","moq":' || turn || '}' || chr(10) || '``` done'
  WHEN 1 THEN '```{"name":"' || role || '","moq":"' || turn || '"}```' WHEN 2 THEN ' {"name":"' || role || '"} ' ELSE text END"""


@query(
    "parse_fenced_json",
    f"""SELECT conv_id, turn, json_extract_string(j, '$.name') AS name, json_extract_string(j, '$.moq') AS moq,
      CASE WHEN j IS NULL THEN 'Failed to parse extraction result' END AS error, md5(CASE WHEN j IS NULL THEN left(t, 500) END) AS raw_response
    FROM (SELECT conv_id, turn, t, TRY_CAST(CASE WHEN contains(t, '```json') THEN regexp_extract(t, '(?s)```json(.*?)```', 1)
      WHEN contains(t, '```') THEN regexp_extract(t, '(?s)```(.*)```', 1) ELSE t END AS JSON) AS j
      FROM (SELECT conv_id, turn, {FENCED} AS t FROM conversations))""",
)
def fenced(spark, folder):
    i, turn = F.col("turn") % 4, F.col("turn").cast("string")
    name = F.concat(F.lit('{"name":"'), "role")
    text = (
        F.when(i == 0, F.concat(F.lit("Here:\n```json\n"), name, F.lit('","moq":'), turn, F.lit("}\n``` done")))
        .when(i == 1, F.concat(F.lit("```"), name, F.lit('","moq":"'), turn, F.lit('"}```')))
        .when(i == 2, F.concat(F.lit(" "), name, F.lit('"} ')))
        .otherwise(F.col("text"))
    )
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("moq", T.StringType())])
    data = table(spark, folder, "conversations").select("conv_id", "turn", text.alias("t"))
    out = extract.parse_fenced_json(data, "t", schema)
    return out.select(
        "conv_id", "turn", "parsed.name", "parsed.moq", "error", F.md5(F.col("raw_response").cast("binary")).alias("raw_response")
    )


@query(
    "clean_extracted",
    """SELECT product_id, name, price_min, price_max, moq, verified_supplier, certifications, keywords, scraped_at FROM (
    SELECT CAST(event_id AS VARCHAR) AS product_id, event_type AS name,
      CASE WHEN event_id % 3 = 0 THEN value ELSE least(value, 25) END AS price_min,
      CASE WHEN event_id % 3 = 0 THEN value ELSE greatest(value, 25) END AS price_max,
      CAST(json_extract_string(props, '$.k') AS DOUBLE) AS moq, event_type = 'click' AS verified_supplier,
      CASE WHEN event_id % 2 = 0 THEN 'ISO 9001|CE' ELSE 'a|' || event_type END AS certifications,
      '' AS keywords, 5.0::DOUBLE AS scraped_at FROM events)""",
)
def cleaned(spark, folder):
    key = F.col("event_id")
    data = table(spark, folder, "events").select(
        F.concat(F.lit(" "), key.cast("string"), F.lit(" ")).alias("product_id"),
        F.concat(F.col("event_type"), F.lit("\n")).alias("name"),
        F.col("value").cast("string").alias("price_min"),
        F.when(key % 3 == 0, "n/a").otherwise("25").alias("price_max"),
        F.get_json_object("props", "$.k").alias("moq"),
        F.when(F.col("event_type") == "click", "YES").otherwise("perhaps").alias("verified_supplier"),
        F.when(key % 2 == 0, " ISO 9001, CE, ,")
        .otherwise(F.concat(F.lit('[" a",null,"'), "event_type", F.lit('"]'))).alias("certifications"),
        *(F.lit(None).cast("string").alias(c) for c in (
            "currency", "unit", "supplier_name", "supplier_location", "description", "listing_url", "category",
            "subcategory", "supplier_rating", "response_rate", "keywords", "scraped_at")),
    )
    out = extract.clean_extracted(data, now=F.lit(5.0))
    return out.select(
        "product_id", "name", "price_min", "price_max", "moq", "verified_supplier",
        F.array_join("certifications", "|").alias("certifications"), F.array_join("keywords", "|").alias("keywords"), "scraped_at",
    )


@query(
    "repair_price_range",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 25 WHEN event_type = 'click' THEN value ELSE least(value, 25) END::DOUBLE AS price_min,
      CASE WHEN event_type = 'error' THEN 25 WHEN event_type = 'click' THEN value ELSE greatest(value, 25) END::DOUBLE AS price_max FROM events""",
)
def repaired(spark, folder):
    kind = F.col("event_type")
    data = table(spark, folder, "events").select(
        "event_id",
        F.when(kind != "error", F.col("value")).alias("price_min"),
        F.when(kind != "click", F.lit(25.0)).alias("price_max"),
    )
    return extract.repair_price_range(data)


@query(
    "first_valid",
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name WHEN p_size % 3 = 1 THEN p_type ELSE left(repeat(p_name || ' ', 12), 80) END AS name,
    CASE WHEN p_size % 2 = 0 THEN p_brand ELSE 'second text' END AS supplier FROM part""",
)
def names(spark, folder):
    i = F.col("p_size") % 3
    titled = F.when(i == 0, F.col("p_name")).when(i == 1, "ab")
    heading = F.when(i == 1, F.col("p_type")).otherwise("x")
    card = F.repeat(F.concat("p_name", F.lit(" ")), F.lit(12))
    name = extract.card_name(titled, heading, card)
    named = F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("B")
    supplier = extract.card_supplier(named, F.array(F.lit("tiny"), name, F.lit("second text")), name)
    return table(spark, folder, "part").select("p_partkey", name.alias("name"), supplier.alias("supplier"))


@query(
    "json_list_roundtrip",
    """SELECT p_partkey, CAST(to_json(string_split(p_name, ' ')) AS VARCHAR) AS encoded, replace(p_name, ' ', '|') AS decoded FROM part""",
)
def list_roundtrip(spark, folder):
    data = table(spark, folder, "part").select("p_partkey", F.split("p_name", " ").alias("keywords"))
    encoded = encode_lists(data).withColumn("encoded", F.col("keywords"))
    decoded = decode_lists(encoded, {"keywords": "array<string>"})
    return decoded.select("p_partkey", "encoded", F.array_join("keywords", "|").alias("decoded"))


@query(
    "union_sources",
    with_listings(
        f"""SELECT product_id, source, name, {r('price_max', 4)} AS price_max FROM (
        SELECT product_id, 'lines' AS source, name, price_max FROM listings
        UNION ALL SELECT 'E-' || event_id, 'events', NULL, value FROM events
        UNION ALL SELECT 'T-' || p_partkey, 'parts', p_name, NULL FROM part)"""
    ),
)
def unioned(spark, folder):
    lines = listings(spark, folder, "product_id", "name", "price_max").withColumn("source", F.lit("lines"))
    events = table(spark, folder, "events").select(
        F.concat(F.lit("E-"), "event_id").alias("product_id"), F.lit("events").alias("source"), F.col("value").alias("price_max")
    )
    parts = table(spark, folder, "part").select(
        F.concat(F.lit("T-"), "p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.lit("parts").alias("source")
    )
    return rounded(union_sources(lines, None, events, parts), 4, "price_max")


@query(
    "extract_with",
    r"""SELECT CASE WHEN bad THEN NULL ELSE url END AS url, CASE WHEN bad THEN NULL ELSE regexp_extract(html, '<title>([^<]*)</title>', 1) END AS title,
    CASE WHEN bad THEN 'no advertising wanted' END AS error FROM (SELECT *, contains(html, 'class="ad"') AS bad FROM pages)""",
)
def extracted_with(spark, folder):
    """A caller's extractor over whole pages; what it raises is kept as the error of the page."""

    def extractor(html: str, url: str) -> dict:
        if 'class="ad"' in html:
            raise ValueError("no advertising wanted")
        return {"url": url, "title": html.split("<title>")[1].split("</title>")[0]}

    return extract_with(table(spark, folder, "pages"), extractor, T.StructType().add("url", "string").add("title", "string"))


@query(
    "keep_original",
    with_listings("SELECT product_id, CASE WHEN moq % 2 = 0 THEN upper(name) ELSE name END AS name, moq FROM listings"),
)
def kept_original(spark, folder):
    """Extracted names fall back to those of the raw record where extraction gave none."""
    raw = listings(spark, folder, "product_id", "name", "moq")
    extracted = raw.withColumn("raw_name", F.col("name")).withColumn("name", F.when(F.col("moq") % 2 == 0, F.upper("name")))
    return extract.keep_original(extracted, ["name"])
