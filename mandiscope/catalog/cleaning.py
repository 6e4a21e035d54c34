"""De-duplication, normalisation, text and geographic enrichment, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from mandiscope.catalog.registry import LISTINGS, query, r, rounded, sql_list, sql_values, with_listings
from mandiscope.functions.lookups import (
    CITY_STATE,
    CURRENCY_NAMES,
    SCRAPE_CITIES,
    STATE_REGION,
    STOP_WORDS,
    UNIT_SPELLINGS,
    USD_RATES,
)
from mandiscope.ml.features import impute, label_encode, standardize
from mandiscope.operators import dedup, enrich, geo, normalize, validate
from mandiscope.operators.relational import distinct_by_key, merge_keywords
from mandiscope.session import spread
from mandiscope.sources.tables import listings, spread_listings, table

# ---- de-duplication -------------------------------------------------------------------------------

KEYED = "product_id scraped_at name price_min price_max moq".split()


@query(
    "distinct_by_key",
    with_listings(
        f"""SELECT {', '.join(KEYED)} FROM (SELECT *, row_number() OVER (PARTITION BY product_id
        ORDER BY scraped_at, name, price_min, price_max, moq) AS rn FROM listings) WHERE rn = 1"""
    ),
)
def first_seen(spark, folder):
    return distinct_by_key(listings(spark, folder, *KEYED), "product_id", ["scraped_at"])


SQUEEZED = r"regexp_replace(regexp_replace(lower(coalesce({0}, '')), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')"


@query(
    "dedup_signature",
    f"""SELECT doc_id, md5({SQUEEZED.format('text')}) AS name, {SQUEEZED.format("'  ' || source || '  ' || upper(lang)")}
    AS supplier FROM documents""",
)
def signatures(spark, folder):
    supplier = F.concat(F.lit("  "), "source", F.lit("  "), F.upper("lang"))
    data = table(spark, folder, "documents").withColumn("supplier_name", supplier)
    name, supplier = dedup.signature("text")
    return data.select("doc_id", F.md5(name.cast("binary")).alias("name"), supplier.alias("supplier"))


@query(
    "exact_duplicates",
    f"""WITH s AS (SELECT {SQUEEZED.format('text')} AS name, doc_id FROM documents)
    SELECT count(*) AS before, count(DISTINCT name) AS after,
      {r('(count(*) - count(DISTINCT name)) * 100.0 / count(*)')} AS removed_pct FROM s""",
)
def exact_duplicates(spark, folder):
    data = table(spark, folder, "documents").select(
        F.col("doc_id").alias("product_id"),
        F.col("text").alias("name"),
        F.lit("").alias("supplier_name"),
        (-F.col("doc_id")).cast("double").alias("scraped_at"),
    )
    return rounded(dedup.dedup_rate(data, dedup.exact_dedup(data)), 6, "removed_pct")


@query("fuzzy_dedup")
def fuzzy(spark, folder):
    data = listings(spark, folder, "product_id", "name", "supplier_name", "scraped_at")
    return dedup.fuzzy_dedup(data)


@query("name_similarity")
def name_similarity(spark, folder):
    """How many other names of parts each name is similar to, by the join of ``fuzzy_dedup``."""
    names = table(spark, folder, "part").select(dedup.signature("p_name")[0].alias("name"))
    found = dedup.similar_values(names, names, dedup.attribute(names, "name", 0.85))
    return found.groupBy(F.col("a").alias("name")).agg((F.count("*") - 1).alias("n_similar"))


# ---- normalisation --------------------------------------------------------------------------------

SPELLINGS = """CASE s_nationkey % 8 WHEN 0 THEN ' usd ' WHEN 1 THEN '€' WHEN 2 THEN 'British Pound' WHEN 3 THEN 'jpy'
  WHEN 4 THEN '¥' WHEN 5 THEN 'rupee' WHEN 6 THEN 'XXQ' ELSE 'doubloons' END"""


def _spelled_currency():
    texts = [" usd ", "€", "British Pound", "jpy", "¥", "rupee", "XXQ"]
    code = F.lit("doubloons")
    for i, text in reversed(list(enumerate(texts))):
        code = F.when(F.col("s_nationkey") % 8 == i, text).otherwise(code)
    return code


CODE = f"""CASE WHEN regexp_matches(upper(trim(t)), '^[A-Z]{{3}}$') THEN upper(trim(t))
  ELSE coalesce((SELECT iso FROM {sql_values(CURRENCY_NAMES, 'names(name, iso)')} WHERE name = upper(trim(t))), 'USD') END"""


@query("currency_code", f"SELECT s_suppkey, t AS currency, {CODE} AS code FROM (SELECT s_suppkey, {SPELLINGS} AS t FROM supplier)")
def currency_codes(spark, folder):
    data = table(spark, folder, "supplier").select("s_suppkey", _spelled_currency().alias("currency"))
    return data.withColumn("code", normalize.currency_code(F.col("currency")))


PRICED = "product_id moq price_min price_max currency".split()
RATED = f"""rated AS (SELECT l.*, rate FROM listings l
  LEFT JOIN {sql_values(USD_RATES, 'rates(code, rate)')} ON l.currency = code)"""


def money_sql(column: str) -> str:
    return f"CASE WHEN currency = 'USD' THEN {column} ELSE {r(f'{column} * rate', 2)} END"


@query(
    "normalize_prices",
    with_listings(
        f"""SELECT product_id, moq, {r(money_sql('price_min'), 2)} AS price_min, {r(money_sql('price_max'), 2)} AS price_max, 'USD' AS currency,
        CASE WHEN currency <> 'USD' THEN currency END AS original_currency,
        {r("CASE WHEN currency <> 'USD' THEN price_min END", 4)} AS original_price_min,
        {r("CASE WHEN currency <> 'USD' THEN price_max END", 4)} AS original_price_max,
        CAST(NULL AS BOOLEAN) AS currency_conversion_failed FROM rated""",
        RATED,
    ),
)
def normalized_prices(spark, folder):
    out = normalize.normalize_prices(listings(spark, folder, *PRICED))
    return rounded(rounded(out, 2, "price_min", "price_max"), 4, "original_price_min", "original_price_max")


CLEAN_UNIT = r"regexp_replace(regexp_replace(lower(trim({0})), '[^\w\s]', '', 'g'), '\s+', ' ', 'g')"
UNITS = sql_values(UNIT_SPELLINGS, "units(spelling, standard)")
UNIT_TEXT = """CASE l_linenumber WHEN 1 THEN ' ' || unit WHEN 2 THEN 'Sq.  Ft' WHEN 3 THEN 'PIECES' WHEN 4 THEN 'Square   Meter'
  WHEN 5 THEN 'dozen' ELSE unit END"""


@query(
    "normalize_unit",
    f"""WITH raw AS (SELECT l_orderkey, l_linenumber, {UNIT_TEXT} AS unit FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'Pcs.'
      WHEN 'N' THEN 'KGS' WHEN 'R' THEN 'sqm' END AS unit FROM lineitem)),
    j AS (SELECT raw.*, {CLEAN_UNIT.format('unit')} AS clean, standard FROM raw LEFT JOIN {UNITS}
      ON spelling = {CLEAN_UNIT.format('raw.unit')})
    SELECT l_orderkey, l_linenumber, CASE WHEN standard <> clean THEN standard ELSE unit END AS unit,
      CASE WHEN standard <> clean THEN unit END AS original_unit FROM j""",
)
def normalized_units(spark, folder):
    unit = F.when(F.col("l_returnflag") == "A", "Pcs.").when(F.col("l_returnflag") == "N", "KGS").otherwise("sqm")
    line = F.col("l_linenumber")
    text = (
        F.when(line == 1, F.concat(F.lit(" "), unit)).when(line == 2, "Sq.  Ft").when(line == 3, "PIECES")
        .when(line == 4, "Square   Meter").when(line == 5, "dozen").otherwise(unit)
    )
    return normalize.normalize_unit(
        table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", text.alias("unit"))
    )


@query(
    "normalize_product",
    with_listings(
        f"""SELECT product_id, moq, {r(money_sql('price_min'), 2)} AS price_min, {r(money_sql('price_max'), 2)} AS price_max, 'USD' AS currency,
        coalesce(standard, unit) AS unit, CASE WHEN standard IS NOT NULL THEN unit END AS original_unit
        FROM rated LEFT JOIN {UNITS} ON spelling = {CLEAN_UNIT.format('unit')}""",
        RATED,
    ),
)
def normalized(spark, folder):
    out = normalize.normalize_product(listings(spark, folder, *PRICED, "unit"))
    out = out.select("product_id", "moq", "price_min", "price_max", "currency", "unit", "original_unit")
    return rounded(out, 2, "price_min", "price_max")


# ---- text -----------------------------------------------------------------------------------------

KEYWORDS = rf"""
list_transform(list_slice(list_sort(list_transform(list_distinct(list_concat(
  list_filter(list_transform(string_split(array_to_string(w, ' '), '|'), lambda p: trim(p)),
    lambda p: length(p) > 2 AND len(string_split(p, ' ')) <= 4),
  list_filter(w, lambda p: p <> '|' AND length(p) > 2))), lambda p: {{'n': -length(p), 'k': p}})), 1, 20), lambda e: e.k)
"""
MARKED = rf"""list_transform(list_filter(string_split_regex(
  regexp_replace(lower({{0}}), '[^\p{{{{L}}}}\p{{{{N}}}}\s-]+', ' | ', 'g'), '\s+'), lambda p: p <> ''),
  lambda p: CASE WHEN p IN ({sql_list(STOP_WORDS)}) THEN '|' ELSE p END)"""


@query(
    "extract_keywords",
    f"SELECT doc_id, array_to_string({KEYWORDS}, '|') AS keywords FROM (SELECT doc_id, {MARKED.format('text')} AS w FROM documents)",
)
def keywords(spark, folder):
    return spread(table(spark, folder, "documents")).select(
        "doc_id", F.array_join(enrich.extract_keywords(F.col("text")), "|").alias("keywords")
    )


def _entities_sql(text: str) -> str:
    """Entities of a text in which every separator is doubled: an entity may then take one on either side and leave one
    for its neighbour."""
    parts = []
    number = r"\d+(?:(?:\.\.|,,|//)\d+)*(?:\s\s)?"
    units = {
        "MEASUREMENT": "mm|cm|m|kg|g|mg|l|ml|inch|inches|ft|feet|yards",
        "VOLTAGE": r"v(?:(?:\s\s)?(?:ac|dc))?",
        "POWER": "w|kw|hp",
        "FREQUENCY": "hz|khz|mhz",
    }
    found = {"MATERIAL": "steel|aluminum|plastic|copper|brass|glass|wood|cotton|polyester|nylon"}
    found |= {label: f"{number}(?:{unit})" for label, unit in units.items()}
    doubled = rf"regexp_replace({text}, '([^\p{{L}}\p{{N}}])', '\1\1', 'g')"
    for label, entity in found.items():
        pattern = rf"(?i)(?:^|[^\p{{L}}\p{{N}}])({entity})(?:[^\p{{L}}\p{{N}}]|$)"
        hits = rf"list_transform(regexp_extract_all(t, '{pattern}', 1), lambda h: regexp_replace(h, '([^\p{{L}}\p{{N}}])[^\p{{L}}\p{{N}}]', '\1', 'g'))"
        parts.append(
            f"""list_transform([{hits}], lambda hs: list_transform(list_filter(hs, lambda h, i:
            list_position(list_transform(hs, lambda x: lower(x)), lower(h)) = i AND length(trim(h)) > 1), lambda h: '{label}=' || trim(h)))[1]"""
        )
    return f"list_transform([{doubled}], lambda t: array_to_string(list_concat({', '.join(parts)}), '|'))[1]"


def _entity_text(column: str):
    pairs = enrich.extract_entities(F.col(column))
    return F.array_join(F.transform(pairs, lambda e: F.concat(e["label"], F.lit("="), e["text"])), "|")


@query(
    "extract_entities",
    f"""WITH {LISTINGS}, texts AS (SELECT 'd' || doc_id AS id, text FROM documents
    UNION ALL SELECT 'p' || p_partkey, p_name || ' Steel STEEL ' || p_size || ' mm, ' || (p_size * 5) || ' V AC / ' || p_size
      || 'kW and ' || p_size || '.5 Hz, brass copper steel/nylon, X' || p_size || 'm 5, m ' || p_size || ' cm 6 cm' FROM part)
    SELECT id, {_entities_sql('text')} AS entities FROM texts""",
)
def entities(spark, folder):
    documents = spread(table(spark, folder, "documents")).select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    size = F.col("p_size").cast("string")
    label = F.concat(
        F.col("p_name"), F.lit(" Steel STEEL "), size, F.lit(" mm, "), (F.col("p_size") * 5).cast("string"),
        F.lit(" V AC / "), size, F.lit("kW and "), size, F.lit(".5 Hz, brass copper steel/nylon, X"), size, F.lit("m 5, m "), size, F.lit(" cm 6 cm"),
    )
    parts = table(spark, folder, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id"), label.alias("text"))
    return documents.unionByName(parts).select("id", _entity_text("text").alias("entities"))


NAME_KEYWORDS = KEYWORDS.replace("(w,", "(wn,").replace("filter(w,", "filter(wn,")


@query(
    "enrich_text",
    with_listings(
        f"""SELECT product_id, moq, array_to_string(CASE WHEN length(description) < 50
          THEN list_sort(list_distinct(list_concat({KEYWORDS}, {NAME_KEYWORDS}))) ELSE {KEYWORDS} END, '|') AS keywords,
        {_entities_sql('description')} AS entities
        FROM (SELECT *, {MARKED.format('description')} AS w, {MARKED.format('name')} AS wn FROM listings)"""
    ),
)
def enriched_text(spark, folder):
    out = enrich.enrich_text(listings(spark, folder, "product_id", "moq", "name", "description"))
    return out.select("product_id", "moq", F.array_join("keywords", "|").alias("keywords"), _entity_text_of("entities"))


def _entity_text_of(column: str):
    joined = F.transform(column, lambda e: F.concat(e["label"], F.lit("="), e["text"]))
    return F.array_join(joined, "|").alias(column)


TOKENS = r"list_filter(string_split_regex(lower({0}), '\s+'), lambda t: length(t) > 2 AND NOT regexp_matches(t, '^[0-9]+$'))"


@query(
    "tokenize_docs",
    f"""SELECT doc_id, len(t) AS n, md5(array_to_string(t, ' ')) AS tokens FROM
    (SELECT doc_id, {TOKENS.format('text')} AS t FROM documents) WHERE len(t) > 0""",
)
def tokens(spark, folder):
    out = enrich.tokenize_docs(table(spark, folder, "documents").select("doc_id", "text"), "text")
    joined = F.md5(F.array_join("tokens", " ").cast("binary"))
    return out.select("doc_id", F.size("tokens").cast("bigint").alias("n"), joined.alias("tokens"))


VOCABULARY = f"""WITH d AS (SELECT {TOKENS.format('text')} AS t FROM documents), k AS (SELECT t FROM d WHERE len(t) > 0),
    c AS (SELECT token, count(*) AS doc_count FROM (SELECT unnest(list_distinct(t)) AS token FROM k) GROUP BY token)
    SELECT token, doc_count FROM c WHERE doc_count >= 2 AND doc_count <= floor((SELECT count(*) FROM k) * 0.5)
    """


@query("vocab_filter", VOCABULARY)
def vocabulary(spark, folder):
    return enrich.vocab_filter(enrich.tokenize_docs(table(spark, folder, "documents").select("text"), "text"))


@query(
    "merge_keywords",
    """SELECT p_partkey, array_to_string(list_transform(list_slice(list_sort(list_transform(
      list_distinct(k), lambda x: {'p': list_position(k, x), 'x': x})), 1, 3), lambda e: e.x), '|') AS keywords
    FROM (SELECT p_partkey, list_concat([lower(p_type)], string_split(p_name, ' '), [lower(p_type), lower(p_brand)]) AS k FROM part)""",
)
def merged_keywords(spark, folder):
    lists = [
        F.array(F.lower("p_type")), F.split("p_name", " "), F.array(F.lower("p_type"), F.lower("p_brand"))
    ]
    merged = merge_keywords(*lists, limit=3)
    return table(spark, folder, "part").select("p_partkey", F.array_join(merged, "|").alias("keywords"))


# ---- geography ------------------------------------------------------------------------------------

PLACE_TEXTS = [
    "Delhi", "Kerala", "Bangalore Rural", "New Delhi / Delhi / India", "Surat-Gujarat", "mum", "Atlantis",
    "Pune, Maharashtra", "Kochi, India", "a - b, c/d", " , ", "Mumbai, Maharashtra, India, Asia",
]
PLACES_SQL = (
    f"""places AS (SELECT c_custkey AS id, ([{sql_list(PLACE_TEXTS)}])[c_custkey % {len(PLACE_TEXTS)} + 1] AS place FROM customer
    UNION ALL SELECT -1 - s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'Mumbai, Maharashtra, India' WHEN 1 THEN 'Pune, Maharashtra'
      WHEN 2 THEN 'Navi Mumbai' ELSE n_name || ', ' || s_name END FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
)


def _places(spark, folder):
    texts = F.array(*map(F.lit, PLACE_TEXTS))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.get(texts, (F.col("c_custkey") % len(PLACE_TEXTS)).cast("int")).alias("place")
    )
    kind = F.col("s_suppkey") % 4
    place = (
        F.when(kind == 0, "Mumbai, Maharashtra, India").when(kind == 1, "Pune, Maharashtra")
        .when(kind == 2, "Navi Mumbai").otherwise(F.concat("n_name", F.lit(", "), "s_name"))
    )
    suppliers = (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select((-1 - F.col("s_suppkey")).alias("id"), place.alias("place"))
    )
    return customers.unionByName(suppliers)


CITY_DIM = f"city_dim AS (SELECT * FROM {sql_values(((c, s, i) for i, (c, s) in enumerate(CITY_STATE)), 't(city, state, ord)')})"
STATE_DIM = f"state_dim AS (SELECT * FROM {sql_values(STATE_REGION, 't(state, region)')})"
PARTIAL = """(SELECT arg_min(state, ord) FROM city_dim
  WHERE contains(lower(city), lower({0})) OR contains(lower({0}), lower(city)))"""
PARSED = f"""
split AS (SELECT id, place, list_filter(list_transform(string_split_regex(place, '[,/-]'), lambda p: trim(p)), lambda p: p <> '') AS p FROM places),
kinds AS (SELECT *, len(p) AS n, p[1] AS p1, p[2] AS p2,
  p[1] IN (SELECT city FROM city_dim) AS city1, p[1] IN (SELECT state FROM state_dim) AS state1,
  p[2] IN (SELECT state FROM state_dim) AS state2 FROM split),
located AS (SELECT id, place,
  CASE WHEN n >= 3 OR (n = 2 AND state2) THEN p1 WHEN n = 1 AND (city1 OR NOT state1) THEN p1 END AS city,
  CASE WHEN n >= 3 OR (n = 2 AND state2) THEN p2 WHEN n = 2 THEN p1
    WHEN n = 1 AND city1 THEN (SELECT any_value(state) FROM city_dim WHERE city = p1)
    WHEN n = 1 AND state1 THEN p1 WHEN n = 1 THEN {PARTIAL.format('p1')} END AS state,
  CASE WHEN n >= 3 THEN array_to_string(list_slice(p, 3, n), ',') WHEN n = 2 AND NOT state2 THEN p2
    WHEN n = 2 OR (n = 1 AND (city1 OR state1)) THEN 'India'
    WHEN n = 1 AND {PARTIAL.format('p1')} IS NOT NULL THEN 'India' END AS country FROM kinds)
"""
GEO_CTES = f"{CITY_DIM}, {STATE_DIM}, {PLACES_SQL}, {PARSED}"


@query(
    "parse_location",
    f"""WITH {GEO_CTES} SELECT id, place, city AS geo_city, l.state AS geo_state,
    country AS geo_country, region AS geo_region FROM located l LEFT JOIN state_dim d ON l.state = d.state""",
)
def parsed_locations(spark, folder):
    return geo.parse_location(_places(spark, folder), F.col("place"))


@query(
    "enrich_geo",
    f"""WITH {GEO_CTES} SELECT id, place AS supplier_location, coalesce(city, 'kept') AS supplier_city, l.state AS supplier_state,
    country AS supplier_country, region AS supplier_region FROM located l LEFT JOIN state_dim d ON l.state = d.state""",
)
def enriched_geo(spark, folder):
    data = _places(spark, folder).select("id", F.col("place").alias("supplier_location"), F.lit("kept").alias("supplier_city"))
    return geo.enrich_geo(data, overwrite=False).drop("supplier_location_raw")


@query(
    "city_state_lookup",
    f"""WITH {CITY_DIM}, {PLACES_SQL} SELECT id, place, city_dim.state FROM places LEFT JOIN city_dim ON place = city""",
)
def city_states(spark, folder):
    return geo.city_state_lookup(_places(spark, folder), "place")


@query(
    "state_region_lookup",
    f"""WITH {STATE_DIM}, {PLACES_SQL} SELECT id, place, region FROM places LEFT JOIN state_dim ON place = state""",
)
def state_regions(spark, folder):
    return geo.state_region_lookup(_places(spark, folder), "place")


@query(
    "fuzzy_city_match",
    f"WITH {CITY_DIM}, {PLACES_SQL} SELECT id, place, {PARTIAL.format('place')} AS state FROM places",
)
def fuzzy_city_match(spark, folder):
    return _places(spark, folder).withColumn("state", geo.partial_city_state(F.col("place")))


SCRAPE_DIM = f"scrape_dim AS (SELECT * FROM {sql_values(((c, i) for i, c in enumerate(SCRAPE_CITIES)), 't(name, ord)')})"


@query(
    "match_location",
    f"""WITH {CITY_DIM}, {STATE_DIM}, {SCRAPE_DIM}, {PLACES_SQL},
    hits AS (SELECT id, place, (SELECT arg_min(name, ord) FROM scrape_dim WHERE contains(lower(place), lower(name))) AS hit FROM places)
    SELECT id, place, hit AS supplier_city, c.state AS supplier_state, region AS supplier_region,
      CASE WHEN hit IS NOT NULL THEN 'India' END AS supplier_country, hit || ', ' || c.state || ', India' AS supplier_location
    FROM hits LEFT JOIN city_dim c ON hit = c.city LEFT JOIN state_dim d ON c.state = d.state""",
)
def matched_locations(spark, folder):
    return geo.match_location(_places(spark, folder), "place")


# ---- validation -----------------------------------------------------------------------------------

CHECKED = "product_id name price_min price_max currency moq supplier_rating response_rate".split()
DIRTY = """dirty AS (SELECT product_id, CASE WHEN moq = 7 THEN NULL ELSE name END AS name,
  CASE WHEN moq = 11 THEN -price_min ELSE price_min END AS price_min,
  CASE WHEN moq = 13 THEN price_min - 1 ELSE price_max END AS price_max,
  CASE WHEN moq = 17 THEN 'usd' WHEN moq = 19 THEN NULL WHEN moq = 23 THEN '' ELSE currency END AS currency,
  moq, supplier_rating, response_rate + moq - 40 AS response_rate FROM listings)"""


def _dirty(spark, folder):
    moq = F.col("moq")
    null = F.lit(None)
    return spread_listings(spark, folder, *CHECKED).select(
        "product_id",
        F.when(moq == 7, null).otherwise(F.col("name")).alias("name"),
        F.when(moq == 11, -F.col("price_min")).otherwise(F.col("price_min")).alias("price_min"),
        F.when(moq == 13, F.col("price_min") - 1).otherwise(F.col("price_max")).alias("price_max"),
        F.when(moq == 17, "usd").when(moq == 19, null).when(moq == 23, "").otherwise(F.col("currency")).alias("currency"),
        "moq",
        "supplier_rating",
        (F.col("response_rate") + moq - 40).alias("response_rate"),
    )


REASONS = """array_to_string(list_filter([
  CASE WHEN name IS NULL THEN 'name: missing' END,
  CASE WHEN supplier_rating < 0 OR supplier_rating > 5 THEN 'supplier_rating: range' END,
  CASE WHEN response_rate < 0 OR response_rate > 100 THEN 'response_rate: range' END,
  CASE WHEN price_min < 0 THEN 'price_min: negative' END,
  CASE WHEN price_max < 0 THEN 'price_max: negative' END,
  CASE WHEN price_max < price_min THEN 'price_max: below price_min' END,
  CASE WHEN currency <> '' AND NOT regexp_matches(currency, '^[A-Z]{3}$') THEN 'currency: format' END
], lambda x: x IS NOT NULL), '|')"""


@query(
    "validate_products",
    with_listings(
        f"""SELECT product_id, name, {r('price_min', 4)} AS price_min, {r('price_max', 4)} AS price_max,
        coalesce(currency, 'USD') AS currency, moq, supplier_rating FROM dirty WHERE {REASONS} = ''""",
        DIRTY,
    ),
)
def validated(spark, folder):
    out = validate.validate_products(_dirty(spark, folder))
    out = out.select("product_id", "name", "price_min", "price_max", "currency", "moq", "supplier_rating")
    return rounded(out, 4, "price_min", "price_max")


@query(
    "rejected_rows",
    with_listings(f"SELECT product_id, moq, {REASONS} AS reasons FROM dirty WHERE {REASONS} <> ''", DIRTY),
)
def rejected(spark, folder):
    out = validate.rejected_rows(_dirty(spark, folder))
    return out.select("product_id", "moq", F.array_join("reasons", "|").alias("reasons"))


@query(
    "coerce_types",
    with_listings(
        """SELECT product_id, CASE WHEN moq % 3 <> 0 AND moq % 5 <> 0 THEN moq END AS moq,
        CASE WHEN moq % 4 <> 0 THEN price_min END AS price_min,
        moq % 2 = 0 AS verified_supplier,
        CASE WHEN moq % 3 = 0 OR moq % 5 = 0 THEN 'moq' ELSE '' END || CASE WHEN moq % 4 = 0 THEN 'price_min' ELSE '' END AS errors
        FROM listings"""
    ),
)
def coerced(spark, folder):
    moq = F.col("moq")
    text = moq.cast("string")
    data = spread_listings(spark, folder, "product_id", "moq", "price_min").select(
        "product_id",
        F.when(moq % 3 == 0, F.concat(text, F.lit(".5"))).when(moq % 5 == 0, F.concat(text, F.lit(" pieces")))
        .otherwise(F.concat(F.lit(" "), text, F.lit(".0"))).alias("moq"),
        F.when(moq % 4 == 0, "on request").otherwise(F.col("price_min").cast("string")).alias("price_min"),
        F.when(moq % 2 == 0, "Yes").otherwise("off").alias("verified_supplier"),
    )
    out = validate.coerce_types(data)
    fields = F.array_sort(F.transform("coercion_errors", lambda e: F.split_part(e, F.lit(":"), F.lit(1))))
    return out.select("product_id", "moq", "price_min", "verified_supplier", F.array_join(fields, "").alias("errors"))


@query(
    "batch_count_check",
    """SELECT c_mktsegment AS batch, declared, actual, declared = actual AS matches FROM (
    SELECT c_mktsegment, count(*) FILTER (c_acctbal >= 0) AS declared, count(*) AS actual FROM customer GROUP BY 1)""",
)
def batch_counts(spark, folder):
    rows = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("batch"), "c_acctbal")
    manifest = rows.groupBy("batch").agg(F.count_if(F.col("c_acctbal") >= 0).alias("count"))
    return validate.batch_count_check(rows, manifest, "batch")


# ---- features -------------------------------------------------------------------------------------


@query(
    "impute",
    """WITH j AS (SELECT d.doc_id, CAST(CASE WHEN quality = 1 THEN n_chars END AS DOUBLE) AS n_chars,
      CASE WHEN toxic = 0 THEN lang END AS lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT doc_id, coalesce(n_chars, (SELECT median(n_chars) FROM j)) AS n_chars, coalesce(lang, (SELECT lang FROM j
      WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1), 'unknown') AS lang FROM j""",
)
def imputed(spark, folder):
    joined = table(spark, folder, "documents").drop("text").join(table(spark, folder, "labels"), "doc_id", "left")
    data = joined.select(
        "doc_id",
        F.when(F.col("quality") == 1, F.col("n_chars")).cast("double").alias("n_chars"),
        F.when(F.col("toxic") == 0, F.col("lang")).alias("lang"),
    )
    return impute(data, ["n_chars"], ["lang"])


@query(
    "standardize",
    f"""SELECT p_partkey, {r('(p_retailprice - m) / s')} AS z_p_retailprice, {r('(p_size - ms) / ss')} AS z_p_size FROM part,
    (SELECT avg(p_retailprice) AS m, stddev_pop(p_retailprice) AS s, avg(p_size) AS ms, stddev_pop(p_size) AS ss FROM part)""",
)
def standardized(spark, folder):
    data = table(spark, folder, "part").select("p_partkey", "p_retailprice", "p_size")
    out = standardize(data, ["p_retailprice", "p_size"]).drop("p_retailprice", "p_size")
    return rounded(out, 6, "z_p_retailprice", "z_p_size")


@query(
    "label_encode",
    "SELECT p_partkey, p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS code FROM part",
)
def encoded(spark, folder):
    return label_encode(table(spark, folder, "part").select("p_partkey", "p_brand"), "p_brand", "code")
