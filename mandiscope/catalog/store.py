"""Warehouse writes, the flagship run and the models."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandiscope.catalog.analysis import HEATMAP
from mandiscope.catalog.cleaning import CLEAN_UNIT, RATED, TOKENS, UNITS, VOCABULARY, money_sql
from mandiscope.catalog.registry import query, r, rounded, with_listings
from mandiscope.functions.scalars import with_row
from mandiscope.ml import anomaly, cluster, price_model, topics
from mandiscope.ml.features import prepare
from mandiscope.operators.geo import enrich_geo
from mandiscope.operators.normalize import normalize_product
from mandiscope.operators.relational import latest_by_key, upsert_rows
from mandiscope.operators.validate import validate_products
from mandiscope.plans.geography import state_heatmap
from mandiscope.plans.refine import apply_steps, record_step, refine
from mandiscope.schema import LISTING_SCHEMA
from mandiscope.session import shared_folder, spread
from mandiscope.sources.tables import LISTING_COLUMNS, listings, spread_listings, table
from mandiscope.sources import arrays, buckets, paging
from mandiscope.sources.listings import read_json_lines, read_listings_js, union_sources, write_listings_json
from mandiscope.sources.warehouse import create_warehouse, current_products, read_log, save_products, write_snapshot
from mandiscope.streaming.ingest import ingest
from mandiscope.streaming.volume import read_daily_volume, stream_daily_volume

MIDDLE = 946684800.0  # 2000-01-01
STORED = "product_id scraped_at name price_min price_max currency moq supplier_name".split()


@query(
    "upsert_latest",
    with_listings(
        f"""SELECT {', '.join(STORED)} FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY scraped_at >= {MIDDLE} DESC,
        scraped_at DESC, name DESC, price_min DESC, price_max DESC, currency DESC, moq DESC, supplier_name DESC) AS rn
        FROM listings) WHERE rn = 1"""
    ),
)
def upserted(spark, folder):
    data = listings(spark, folder, *STORED)
    return upsert_rows(data.where(F.col("scraped_at") < MIDDLE), data.where(F.col("scraped_at") >= MIDDLE))


def scratch(spark) -> str:
    """A new folder inside the shared one, for a query that has to write."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


# The latest valid record per product after normalisation.
REFINED = f"""refined AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY scraped_at DESC, name DESC,
  new_min DESC, new_max DESC, moq DESC, new_unit DESC, supplier_name DESC, supplier_rating DESC, supplier_location DESC,
  verified_supplier DESC, response_rate DESC, category DESC, subcategory DESC) AS rn
  FROM (SELECT *, {money_sql('price_min')} AS new_min, {money_sql('price_max')} AS new_max, coalesce(standard, unit) AS new_unit
    FROM rated LEFT JOIN {UNITS} ON spelling = {CLEAN_UNIT.format('unit')})
  WHERE supplier_rating BETWEEN 0 AND 5 AND response_rate BETWEEN 0 AND 100) WHERE rn = 1)"""
SAVED = with_listings(
    f"""SELECT product_id, name, {r('new_min', 2)} AS price_min, {r('new_max', 2)} AS price_max, moq, new_unit AS unit, supplier_name, category, scraped_at
    FROM refined""",
    RATED,
    REFINED,
)
OUT = "product_id name price_min price_max moq unit supplier_name category scraped_at".split()


def _prepare(df):
    return enrich_geo(normalize_product(df))


@query("save_products", SAVED)
def saved(spark, folder):
    path = scratch(spark) + "/products"
    save_products(_prepare(spread_listings(spark, folder)), path, batch=1)
    return rounded(current_products(spark, path).select(*OUT), 2, "price_min", "price_max")


@query(
    "save_counts",
    with_listings("""SELECT count(*) FILTER (WHERE ok) AS accepted, count(*) FILTER (WHERE NOT ok) AS rejected, count(*) FILTER (WHERE ok) AS kept,
      count(*) FILTER (WHERE NOT ok) AS rejects FROM (SELECT coalesce(supplier_rating BETWEEN 0 AND 5, true) AND coalesce(response_rate BETWEEN 0 AND 100, true) AS ok FROM listings)"""),
)
def save_counts(spark, folder):
    """The numbers one validated write observes, beside the rows it has kept."""
    root = scratch(spark)
    counts = save_products(spread_listings(spark, folder), f"{root}/products", 1, f"{root}/rejects")
    kept = read_log(spark, f"{root}/products").agg(F.count("*").alias("kept"))
    gone = spark.read.parquet(f"{root}/rejects").agg(F.count("*").alias("rejects")) if counts["rejected"] else spark.range(1).select(F.lit(0).cast("long").alias("rejects"))
    told = spark.range(1).select(*(F.lit(counts[c]).cast("long").alias(c) for c in ("accepted", "rejected")))
    return with_row(with_row(told, kept), gone)


BUCKETED = f"""SELECT {', '.join(STORED)} FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY write DESC, scraped_at DESC, name DESC,
  price_min DESC, price_max DESC, currency DESC, moq DESC, supplier_name DESC) AS rn FROM (
  SELECT *, 0 AS write FROM listings
  UNION ALL SELECT * REPLACE (price_min * 2 AS price_min), 1 AS write FROM listings WHERE moq = 7
  UNION ALL SELECT * REPLACE ('renamed' AS name), 2 AS write FROM listings WHERE moq IN (7, 8) AND currency = 'USD')) WHERE rn = 1"""


@query("bucketed_upsert", with_listings(BUCKETED))
def bucketed(spark, folder):
    """Listings in hash buckets after two upserts, merged on read."""
    path, data = scratch(spark) + "/products", listings(spark, folder, *STORED)
    buckets.create(data, path, buckets=32)
    buckets.upsert(data.where("moq = 7").withColumn("price_min", F.col("price_min") * 2), path)
    buckets.upsert(data.where("moq in (7, 8) and currency = 'USD'").withColumn("name", F.lit("renamed")), path)
    return buckets.read(spark, path)


@query(
    "page_snapshot",
    with_listings("SELECT product_id, name, price_max FROM listings ORDER BY name, product_id, price_max LIMIT 50 OFFSET 75"),
)
def page_snapshot(spark, folder):
    """Two pages of an ordered snapshot: the fourth by its number, the fifth by the last key of the fourth."""
    path, order = scratch(spark) + "/ordered", ("name", "product_id", "price_max")
    paging.write_ordered(listings(spark, folder, *order), path, order, rows=500)
    fourth = paging.page_number(spark, path, 4)
    last = fourth.collect()[-1]
    fifth = paging.page_after(spark, path, [last[c] for c in order])
    return fourth.unionByName(fifth).select("product_id", "name", "price_max")


@query("array_files", with_listings(f"SELECT {', '.join(STORED)} FROM listings"))
def array_files(spark, folder):
    """Listings written as files of one JavaScript array each and read back by byte ranges."""
    path = scratch(spark) + "/arrays"
    arrays.write_arrays(listings(spark, folder, *STORED), path, "PRODUCTS")
    fields = [f for f in LISTING_SCHEMA.fields if f.name in STORED]
    return arrays.read_array(spark, path, T.StructType(fields)).select(*STORED)


@query(
    "listing_files",
    with_listings(" UNION ALL ".join(f"SELECT '{kind}' AS kind, {', '.join(STORED)} FROM listings" for kind in ("lines", "array", "constant"))),
)
def listing_files(spark, folder):
    """Listings written as records by line, as JSON arrays and as JavaScript constants, each read back by a reader that splits files."""
    root, data = scratch(spark), listings(spark, folder, *STORED)
    schema = T.StructType([f for f in LISTING_SCHEMA.fields if f.name in STORED])
    write_listings_json(data, f"{root}/lines")
    arrays.write_arrays(data, f"{root}/array")
    arrays.write_arrays(data, f"{root}/constant", "PRODUCTS")
    found = {
        "lines": read_json_lines(spark, f"{root}/lines", schema),
        # A task's array may be too large to be held whole, as the reader of small files does.
        "array": arrays.read_array(spark, f"{root}/array", schema),
        "constant": read_listings_js(spark, f"{root}/constant", schema),
    }
    return union_sources(*(df.select(F.lit(kind).alias("kind"), *STORED) for kind, df in found.items()))


@query("warehouse_snapshot", SAVED)
def warehouse_snapshot(spark, folder):
    """The log as a registered table, its current state as a snapshot divided by category, read back."""
    root, name = scratch(spark), f"products_{uuid.uuid4().hex}"
    save_products(_prepare(spread_listings(spark, folder)), f"{root}/products", batch=1)
    create_warehouse(spark, name, f"{root}/products")
    try:
        spark.catalog.recoverPartitions(name)
        current = latest_by_key(spark.table(name), "product_id", ["batch", "scraped_at"]).drop("batch")
        write_snapshot(current, f"{root}/snapshot", by_category=True)
    finally:
        spark.sql(f"DROP TABLE {name}")
    kept = spark.read.schema(current.schema).parquet(f"{root}/snapshot")
    return rounded(kept.select(*OUT), 2, "price_min", "price_max")


@query(
    "record_step",
    with_listings("SELECT product_id, upper(substr(name, 1, 3)) || '-' || moq AS code, CASE WHEN moq % 2 = 0 THEN moq * 2 END AS pairs FROM listings"),
)
def record_steps(spark, folder):
    """A caller's function on single records as a step of the chain; fields that it leaves out are null."""

    def coded(record: dict) -> dict:
        out = {"product_id": record["product_id"], "code": f"{record['name'][:3].upper()}-{record['moq']}"}
        return out | ({"pairs": record["moq"] * 2} if record["moq"] % 2 == 0 else {})

    schema = T.StructType().add("product_id", "string").add("code", "string").add("pairs", T.IntegerType())
    return apply_steps(spread_listings(spark, folder, "product_id", "name", "moq"), [record_step(coded, schema)])


@query("event_day_volume", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1")
def event_day_volume(spark, folder):
    """Events per day by a stream over event time that takes them in by files of eight days, restarted half way."""
    root, events = scratch(spark), table(spark, folder, "events")
    part = F.floor(F.unix_date(F.to_date("ts")) / 8)
    late = part + (F.unix_date(F.to_date("ts")) % 8 == 7).cast("int")
    dealt = events.withColumn("file", F.when(F.col("event_id") % 3 == 0, late).otherwise(part))
    landings = sorted(r.file for r in dealt.select("file").distinct().collect() if r.file is not None)
    for at in landings:
        # The last day of each file lands in part with the next, one day late at most.
        dealt.where(F.col("file") == at).drop("file").coalesce(1).write.mode("append").parquet(f"{root}/events")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/events")
        stream_daily_volume(stream, f"{root}/volume", f"{root}/progress", late="10 days").awaitTermination()
    return read_daily_volume(spark, f"{root}/volume")


# Every second order lands again later, without its discount.
UPDATED = SAVED.replace("FROM lineitem", "FROM landed").replace(
    "WITH ", "WITH landed AS (SELECT * REPLACE (CASE WHEN l_orderkey % 2 = 0 THEN 0.0 ELSE l_discount END AS l_discount) FROM lineitem), ", 1
)


@query("incremental_upsert", UPDATED)
def incremental(spark, folder):
    """Line items taken in by one file stream, then updates of the same products by another; read back as current state."""
    root = scratch(spark)
    lines = table(spark, folder, "lineitem")
    updates = lines.where("l_orderkey % 2 = 0").withColumn("l_discount", F.lit(0).cast(lines.schema["l_discount"].dataType))
    updates.write.parquet(f"{root}/updates")

    def prepare(batch):
        return _prepare(listings(spark, folder, *LISTING_COLUMNS, lines=spread(batch)))

    for source, progress in ((f"{folder}/lineitem*.parquet", "first"), (f"{root}/updates", "second")):
        ingest(
            spark, source, f"{root}/products", f"{root}/{progress}", "parquet", lines.schema, prepare
        ).awaitTermination()
    return rounded(current_products(spark, f"{root}/products").select(*OUT), 2, "price_min", "price_max")


# State the location parser finds for the listings' four location forms.
GEO_STATE = """CASE WHEN supplier_location LIKE '%Maharashtra%' OR supplier_location = 'Navi Mumbai' THEN 'Maharashtra'
  ELSE split_part(supplier_location, ',', 1) END"""
FIRSTS = """firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(name), lower(supplier_name)
  ORDER BY scraped_at DESC, product_id) AS place FROM listings) WHERE place = 1)"""


@query(
    "refine_and_save",
    with_listings(
        f"""SELECT product_id, name, {r('new_min', 2)} AS price_min, {r('new_max', 2)} AS price_max, moq, new_unit AS unit, supplier_name, category,
        scraped_at, {GEO_STATE} AS supplier_state, len(string_split(name, ' ')) > 0 AS has_keywords FROM refined""",
        FIRSTS,
        RATED.replace("FROM listings l", "FROM firsts l"),
        REFINED,
    ),
)
def refined_and_saved(spark, folder):
    """The whole chain: de-duplicate (equal signatures), normalise, enrich text and geography, validate, keep the latest."""
    path = scratch(spark) + "/products"
    save_products(refine(spread_listings(spark, folder), 1.0, 1.0), path, batch=1)
    current = current_products(spark, path)
    out = current.select(*OUT, "supplier_state", (F.size("keywords") > 0).alias("has_keywords"))
    return rounded(out, 2, "price_min", "price_max")


# The pruned record of the flagship has fewer columns to break ties with.
CURRENT = REFINED.replace("refined AS", "current AS")
HEATMAP_COLUMNS = ["state", "listings", "avg_price", "avg_rating", "top_category", "density", "level"]


@query(
    "current_state_heatmap",
    with_listings(
        HEATMAP.replace("SOURCE", "latest").replace("price_min", "new_min").replace("price_max", "new_max"),
        RATED,
        CURRENT,
        f"latest AS (SELECT * REPLACE (geo_state AS supplier_state) FROM (SELECT *, {GEO_STATE} AS geo_state FROM current))",
    ),
)
def flagship(spark, folder):
    """Which states list most, at what price and rating: normalise, locate, validate, keep the latest, aggregate."""
    columns = (
        "product_id name price_min price_max currency moq unit supplier_name supplier_rating supplier_location "
        "response_rate category scraped_at supplier_state"
    ).split()
    data = _prepare(spread_listings(spark, folder, *columns))
    # Columns that the records don't have are the same in every row, so they settle no tie and need not be kept.
    valid = validate_products(data)
    valid = valid.select(*(c for c in valid.columns if c in data.columns))
    current = latest_by_key(valid, "product_id", ["scraped_at"])
    out = state_heatmap(current).select(*HEATMAP_COLUMNS)
    return rounded(rounded(out, 6, "avg_rating", "density"), 4, "avg_price")


# ---- models ---------------------------------------------------------------------------------------

PROFILE = "product_id supplier_rating response_rate moq price_min price_max".split()


@query("supplier_clusters")
def clusters(spark, folder):
    return cluster.supplier_clusters(listings(spark, folder, *PROFILE))


@query("cluster_profiles")
def profiles(spark, folder):
    return cluster.cluster_profiles(cluster.supplier_clusters(listings(spark, folder, *PROFILE)))


@query("kmeans_elbow")
def kmeans_elbow(spark, folder):
    return cluster.elbow(listings(spark, folder, *PROFILE))


MEANS = f"""{r('avg(supplier_rating)')} AS mean_supplier_rating, {r('avg(response_rate)')} AS mean_response_rate, {r('avg(moq)')} AS mean_moq,
  {r('avg((price_min + price_max) / 2)', 4)} AS mean_avg_price"""


@query("cluster_totals", with_listings(f"SELECT count(*) AS n, CAST(4 AS BIGINT) AS clusters, {MEANS} FROM listings"))
def cluster_totals(spark, folder):
    """The profiles put together again: rows, clusters and the means of all rows."""
    found = cluster.cluster_profiles(cluster.supplier_clusters(listings(spark, folder, *PROFILE)))
    means = (F.try_divide(F.sum(F.col(f"mean_{f}") * F.col("n")), F.sum("n")).alias(f"mean_{f}") for f in cluster.FEATURES)
    out = found.agg(F.count("*").alias("clusters"), *means, F.sum("n").alias("n"))
    return rounded(rounded(out, 6, "mean_supplier_rating", "mean_response_rate", "mean_moq"), 4, "mean_avg_price")


@query("cluster_nearest", with_listings("SELECT product_id, TRUE AS settled FROM listings"))
def cluster_nearest(spark, folder):
    """Every listing with whether the mean of its own cluster is the nearest one."""
    return cluster.settled(cluster.supplier_clusters(listings(spark, folder, *PROFILE))).select("product_id", "settled")


# Models that several queries report on are fitted once per application and state of the files they were fitted on.
_FITTED: dict[tuple, object] = {}


def file_state(df: DataFrame) -> tuple:
    """Name, size and time of every file ``df`` reads, so that new data under an old path is told apart."""
    spark = df.sparkSession
    found = []
    for name in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        found.append((name, status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


def _once(name, data, fit):
    """``fit(data)``, held for the latest state of its files."""
    at, state = (name, data.sparkSession.sparkContext.applicationId), file_state(data)
    if _FITTED.get(at, (None,))[0] != state:
        _FITTED[at] = state, fit(data)
    return _FITTED[at][1]


def _price_model(spark, folder):
    columns = [*PROFILE, "category", "subcategory", "unit", "supplier_region", "supplier_country"]
    return _once("price", listings(spark, folder, *columns), price_model.fit_price_model)


def _topics(spark, folder):
    texts = table(spark, folder, "documents").select("doc_id", "text")
    return _once("topics", texts, lambda data: topics.fit_topics(data, "text"))


@query("price_model_metrics")
def price_model_metrics(spark, folder):
    return price_model.metrics(_price_model(spark, folder))


@query("price_predictions")
def price_predictions(spark, folder):
    return _price_model(spark, folder).predictions


TEST_ROW = "CAST('0x' || substr(md5(product_id || ':42'), 1, 8) AS BIGINT) % 1000 < 200"


@query("price_test_rows", with_listings(f"SELECT product_id, {r('(price_min + price_max) / 2')} AS actual, TRUE AS predicted FROM listings WHERE {TEST_ROW}"))
def price_test_rows(spark, folder):
    """The rows held out of the price model with their prices, and whether each has a prediction."""
    found = _price_model(spark, folder).predictions
    return rounded(found.select("product_id", "actual", F.col("predicted").isNotNull().alias("predicted")), 6, "actual")


@query("feature_importance")
def feature_importance(spark, folder):
    return price_model.feature_importance(_price_model(spark, folder))


IMPORTANCE = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(DISTINCT {c}) > 1 AS used, 1.0 AS total FROM listings WHERE NOT {TEST_ROW}"
    for c in [*price_model.NUMBER_FEATURES, *price_model.TEXT_FEATURES]
)


@query("importance_use", with_listings(IMPORTANCE))
def importance_use(spark, folder):
    """Which features the price forest splits on, those that vary in its training rows, and the sum of all importances."""
    found = price_model.feature_importance(_price_model(spark, folder))
    total = found.agg(F.round(F.sum("importance"), 6).alias("total"))
    return with_row(found.select("feature", (F.col("importance") > 0).alias("used")), total)


GAPS = """gaps AS (SELECT product_id, CASE WHEN moq % 7 = 0 THEN NULL ELSE supplier_rating END AS supplier_rating,
  CASE WHEN moq % 5 = 1 THEN NULL ELSE response_rate END AS response_rate, CASE WHEN moq < 4 THEN NULL ELSE moq END AS moq,
  price_min, CASE WHEN moq % 9 = 2 THEN NULL ELSE price_max END AS price_max, CASE WHEN moq % 3 = 0 THEN NULL ELSE category END AS category FROM listings)"""
GAP_NUMBERS = "supplier_rating response_rate moq price_min price_max".split()
FILLED = f"""filled AS (SELECT product_id, {', '.join(f"coalesce({c}, (SELECT median({c}) FROM gaps)) AS {c}" for c in GAP_NUMBERS)},
  coalesce(category, (SELECT category FROM gaps WHERE category IS NOT NULL GROUP BY category ORDER BY count(*) DESC, category LIMIT 1)) AS category FROM gaps),
  averaged AS (SELECT *, (price_min + price_max) / 2 AS avg_price FROM filled)"""


@query(
    "filled_profiles",
    with_listings(
        "SELECT product_id, category, " + ", ".join(r(f"({f} - (SELECT avg({f}) FROM averaged)) / (SELECT stddev_pop({f}) FROM averaged)") + f" AS z_{f}" for f in cluster.FEATURES) + " FROM averaged",
        GAPS,
        FILLED,
    ),
)
def filled_profiles(spark, folder):
    """Profiles of listings with gaps: imputed, averaged and scaled by the pipeline that the models use, saved and loaded."""
    gap = {"supplier_rating": F.col("moq") % 7 == 0, "response_rate": F.col("moq") % 5 == 1, "price_max": F.col("moq") % 9 == 2, "category": F.col("moq") % 3 == 0}
    data = listings(spark, folder, *PROFILE, "category")
    data = data.withColumns({c: F.when(~w, F.col(c)) for c, w in gap.items()}).withColumn("moq", F.when(F.col("moq") >= 4, F.col("moq")))
    path = scratch(spark) + "/prepared"
    prepare(GAP_NUMBERS, ["category"], cluster.FEATURES, averaged=True).fit(data).write().overwrite().save(path)
    out = PipelineModel.load(path).transform(data).select("product_id", "category", *(f"z_{f}" for f in cluster.FEATURES))
    return rounded(out, 6, *(f"z_{f}" for f in cluster.FEATURES))


@query("price_anomalies")
def price_anomalies(spark, folder):
    return anomaly.price_anomalies(listings(spark, folder, "product_id", "price_min", "price_max", "moq"))


@query("anomaly_threshold", with_listings("SELECT count(*) AS n, TRUE AS separated, TRUE AS share_met FROM listings"))
def anomaly_threshold(spark, folder):
    """Whether the flagged listings are the tenth of lowest scores."""
    return anomaly.threshold_check(anomaly.price_anomalies(listings(spark, folder, "product_id", "price_min", "price_max", "moq")))


@query("topic_documents", f"SELECT doc_id, TRUE AS known FROM documents WHERE len({TOKENS.format('text')}) > 0")
def topic_documents(spark, folder):
    """Every document with a token has one of the topics."""
    known = F.col("topic").between(0, topics.TOPICS - 1).alias("known")
    return topics.dominant_topics(_topics(spark, folder)).select("doc_id", known)


@query("topic_vocabulary", VOCABULARY.replace("SELECT token, doc_count FROM", "SELECT token FROM"))
def topic_vocabulary(spark, folder):
    """The words the topics are made of: those within the document bounds."""
    return _topics(spark, folder).vocabulary.select("token")


@query("topic_terms")
def topic_terms(spark, folder):
    return topics.topic_terms(_topics(spark, folder))


@query("dominant_topics")
def dominant_topics(spark, folder):
    return topics.topic_histogram(_topics(spark, folder))
