import json

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandiscope.plans.page_listings import detail_records, page_listings
from mandiscope.plans.refine import record_step
from mandiscope.schema import LISTING_SCHEMA, PRODUCT_SCHEMA
from mandiscope.sources import arrays, buckets, listings, pages, paging, warehouse
from mandiscope.streaming.ingest import ingest
from mandiscope.streaming.volume import read_daily_volume, stream_daily_volume

RECORD = {"product_id": "TI-1", "name": "Pump", "price_min": 1.0, "price_max": 2.0, "currency": "USD",
          "keywords": ["a", "b"], "entities": [{"text": "steel", "label": "MATERIAL"}], "scraped_at": 5.0}


def test_json_and_js(spark, tmp_path):
    other = RECORD | {"product_id": "TI-2", "name": "café; const"}
    (tmp_path / "a.json").write_text(json.dumps([RECORD, other], indent=2), encoding="utf-8")
    (tmp_path / "b.js").write_text(f"const DATA = {json.dumps({'products': [RECORD, other]}, indent=2)};", encoding="utf-8")
    (tmp_path / "c.js").write_text(f"const PRODUCTS = {json.dumps([RECORD, other])};\n", encoding="utf-8")
    want = listings.read_listings_json(spark, str(tmp_path / "a.json")).orderBy("product_id").collect()
    assert [r.name for r in want] == ["Pump", "café; const"] and want[0].entities[0].label == "MATERIAL"
    for name in ("b.js", "c.js"):
        assert listings.read_listings_js(spark, str(tmp_path / name)).orderBy("product_id").collect() == want
    df = listings.read_listings_json(spark, str(tmp_path / "a.json"))
    listings.write_listings_json(df, str(tmp_path / "out"))
    assert listings.read_json_lines(spark, str(tmp_path / "out")).orderBy("product_id").collect() == want


def test_lists_as_text(spark):
    df = spark.createDataFrame([RECORD | {"certifications": None}], LISTING_SCHEMA)
    text = listings.encode_lists(df)
    assert text.first().keywords == '["a","b"]'
    back = listings.decode_lists(text, {"keywords": "array<string>", "entities": "array<struct<text:string,label:string>>"})
    assert back.first().keywords == ["a", "b"] and back.first().entities[0].text == "steel"


def product(**changes):
    return RECORD | {"moq": 1} | changes


def frame(spark, *records):
    return spark.createDataFrame(list(records), LISTING_SCHEMA)


def test_warehouse(spark, tmp_path):
    path = str(tmp_path / "products")
    first = frame(spark, product(), product(product_id="TI-2"), product(product_id="TI-3", price_min=-1.0))
    assert warehouse.save_products(first, path, 1, str(tmp_path / "rejects")) == {"accepted": 2, "rejected": 1}
    warehouse.save_products(frame(spark, product(name="Newer", scraped_at=4.0), product(name="Newest", scraped_at=4.5)), path, 2)
    current = {r.product_id: r.name for r in warehouse.current_products(spark, path).collect()}
    assert current == {"TI-1": "Newest", "TI-2": "Pump"}
    warehouse.save_products(frame(spark, product(name="Again")), path, 2)
    assert {r.product_id: r.name for r in warehouse.current_products(spark, path).collect()}["TI-1"] == "Again"
    assert warehouse.save_products(frame(spark, product(name=None)), path, 3)["accepted"] == 0
    snapshot = str(tmp_path / "snapshot")
    warehouse.write_snapshot(warehouse.current_products(spark, path), snapshot)
    loaded = warehouse.load_products(spark.read.parquet(snapshot), limit=0, category="")
    assert loaded.count() == 2 and loaded.columns == PRODUCT_SCHEMA.fieldNames()
    assert spark.read.parquet(str(tmp_path / "rejects")).first().reasons == ["price_min: negative"]


def test_create_warehouse(spark, tmp_path):
    warehouse.create_warehouse(spark, "listing_log", str(tmp_path / "log"))
    warehouse.create_warehouse(spark, "listing_log", str(tmp_path / "log"))
    assert spark.table("listing_log").columns == [*PRODUCT_SCHEMA.fieldNames(), "batch"]
    spark.sql("DROP TABLE listing_log")


def test_ingest_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    places = (str(landing), str(tmp_path / "table"), str(tmp_path / "progress"))

    def land(name, *records):
        (landing / name).write_text("\n".join(json.dumps(r) for r in records))
        ingest(spark, *places, prepare=lambda df: df).awaitTermination()

    land("1.json", product(), product(product_id="TI-2"))
    land("2.json", product(name="Late", scraped_at=1.0))
    current = {r.product_id: r.name for r in warehouse.current_products(spark, places[1]).collect()}
    assert current == {"TI-1": "Late", "TI-2": "Pump"}
    assert warehouse.read_log(spark, places[1]).count() == 3


def test_streams_share_a_warehouse(spark, tmp_path):
    table = str(tmp_path / "table")

    def land(stream, progress, *records):
        (tmp_path / stream).mkdir(exist_ok=True)
        (tmp_path / stream / f"{progress}.json").write_text("\n".join(json.dumps(r) for r in records))
        ingest(spark, str(tmp_path / stream), table, str(tmp_path / progress), prepare=lambda df: df).awaitTermination()

    warehouse.save_products(spark.createDataFrame([product(product_id="TI-0")], LISTING_SCHEMA), table, 0)
    land("one", "a", product(), product(product_id="TI-2"))
    land("two", "b", product(name="Later", scraped_at=1.0), product(product_id="TI-3"))
    current = {r.product_id: r.name for r in warehouse.current_products(spark, table).collect()}
    assert current == {"TI-0": "Pump", "TI-1": "Later", "TI-2": "Pump", "TI-3": "Pump"}
    assert warehouse.read_log(spark, table).count() == 5
    # A new checkpoint reads the first stream again and replaces nothing.
    land("one", "c", product(product_id="TI-4"))
    assert warehouse.read_log(spark, table).count() == 8


def test_repeated_batch_replaces_itself(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing/1.json").write_text(json.dumps(product()))
    places = (str(tmp_path / "landing"), str(tmp_path / "table"), str(tmp_path / "progress"))

    ingest(spark, *places, prepare=lambda df: df).awaitTermination()
    # As if the job had been lost after the write, before the batch was marked as done.
    for done in (tmp_path / "progress/commits").glob("*0*"):
        done.unlink()
    ingest(spark, *places, prepare=lambda df: df).awaitTermination()
    assert warehouse.read_log(spark, places[1]).count() == 1


CARD = """
<html><body><script>var a = "<div class='fullwidthcard'>";</script>
<div class="x fullwidthcard y"><h2 class="card_title"> Steel &amp; pump </h2><a href="/products/steel-c77.html">go</a>
 <span class="anchor-wrapper">Acme</span><div class="price-box">Rs 1,050</div><p>MOQ - 5</p></div>
<div class="fullwidthcard"><h2>Plain</h2><p class="wordbreak">Finish - Blue</p></div>
<h1>Head</h1><span class="rating">4.5</span><a class="company-name">Bharat</a></body></html>
"""


def test_pages(spark):
    df = spark.createDataFrame([(1, "https://a.com", CARD), (2, "https://a.com/b", None)], "page_id long, url string, html string")
    first, second = pages.site_cards(df, "tradeindia_search").orderBy("pos").collect()
    assert (first.name, first.href, first.supplier_name, first.price_raw) == ("Steel & pump", "/products/steel-c77.html", "Acme", "Rs 1,050")
    assert (second.name, second.heading) == (None, "Plain") and "Finish - Blue" in second.card_text
    detail = pages.site_detail(df, "tradeindia").where("page_id = 1").first()
    assert (detail.name, detail.supplier_name, detail.supplier_rating) == ("Head", "Bharat", "4.5")

    def extractor(html, url):
        return {"name": html[:3].strip(), "listing_url": url}

    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("listing_url", T.StringType())])
    got = {r.listing_url: r for r in pages.extract_with(df, extractor, schema).collect()}
    assert got["https://a.com"].error is None and got[None].error


LISTING = """<div class="fullwidthcard"><a href="/about">x</a><h2>Brass Gate Valve in bulk</h2><p>abc</p><span>Acme Ltd</span>
 <a href="../products/valve-c9.html">see</a><p>MOQ 12 pcs</p><p class="wordbreak"> Finish: red </p></div>
 <div class="fullwidthcard">bare</div>"""
DETAIL = """<h1>Valve</h1><span class="amount">90</span><ul><li>Minimum Order : <b>5</b> boxes</li></ul><p>Packaging</p>
 <script>"Response Rate: 1%"</script><p>Response Rate: 88%</p><i>a trusted name</i><span class="city-x">Pune</span>"""


def test_pages_to_listings(spark):
    schema = "page_id long, url string, html string"
    cards = spark.createDataFrame([(1, "u", LISTING), (2, "u", None), (3, None, "")], schema)
    found = spark.createDataFrame([(7, "/products/valve-c9.html", DETAIL), (8, None, None)], schema)
    when = F.lit(5.0)
    valve, bare = page_listings(cards, found, "tradeindia_search", "Valves", when).orderBy("pos").collect()
    assert (valve.product_id, valve.listing_url) == ("TI-9", "https://www.tradeindia.com/products/valve-c9.html")
    assert (valve.name, valve.supplier_name, valve.moq) == ("Brass Gate Valve in bulk", "Acme Ltd", 12)
    assert (valve.description, valve.keywords) == ("Finish: red", ["valves", "brass", "gate", "valve"])
    assert (bare.name, bare.listing_url, bare.price_min, bare.description) == ("bare", None, None, "bare") and bare.product_id
    detail = detail_records(found, "tradeindia", when).where("name is not null").first()
    assert (detail.product_id, detail.name, detail.price_raw) == ("TI-9", "Valve", "90")
    assert (detail.moq_raw, detail.unit, detail.response_rate, detail.verified_supplier) == ("5boxes", "Packaging", 88.0, True)
    other = spark.createDataFrame(
        [(1, "u", '<div class="product"><a class="title" href="/x/lathe.html">Lathe</a><span class="price">5 - 7</span></div>')], schema
    )
    for site in ("tradeindia", "indiamart"):
        lathe = page_listings(other, found, site, "Machines", when).first()
        assert (lathe.product_id, lathe.name, lathe.price_min, lathe.price_max) == ("lathe", "Lathe", 5.0, 7.0)
        assert detail_records(found, site, when).count() == 2


def test_union_of_sources(spark):
    a = spark.createDataFrame(pd.DataFrame({"x": [1]}))
    b = spark.createDataFrame(pd.DataFrame({"y": ["t"]}))
    got = [tuple(r) for r in listings.union_sources(None, a, b).select("x", "y").collect()]
    assert sorted(got, key=str) == [(1, None), (None, "t")]


def test_large_ids_beside_null_ids(spark):
    ids = [1152921504606859321, None, 1152921504606859322]
    html = '<div class="product"><a class="title">Pump</a></div><h1>Valve</h1>'
    data = spark.createDataFrame([(i, html, i) for i in ids], "page_id long, html string, more long").repartition(1)
    cards = pages.extract_cards(data, [pages.Selector("name", "a", "title")], "div", "product", keep=["more"]).collect()
    assert {(r.page_id, r.more, r.name, r.pos) for r in cards} == {(i, i, "Pump", 0) for i in ids}
    detail = pages.extract_detail(data, [pages.Selector("name", "h1")], keep=["more"]).collect()
    assert {(r.page_id, r.more, r.name) for r in detail} == {(i, i, "Valve") for i in ids}


def test_record_step_sees_nulls_and_whole_integers(spark):
    data = spark.createDataFrame([(1152921504606859321, 1.5, ["a"]), (None, None, None)], "id long, x double, tags array<string>").repartition(1)
    step = record_step(lambda r: {"id": r["id"], "told": repr((r["id"], r["x"], r["tags"]))}, T.StructType().add("id", "long").add("told", "string").add("absent", "double"))
    got = {(r.id, r.told, r.absent) for r in step(data).collect()}
    assert got == {(1152921504606859321, "(1152921504606859321, 1.5, ['a'])", None), (None, "(None, None, None)", None)}


def test_buckets_merge_on_read(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(2000).select(F.concat(F.lit("p"), "id").alias("product_id"), F.col("id").cast("double").alias("scraped_at"), F.lit("old").alias("name"))
    first = buckets.create(rows.union(rows.limit(5)), path, buckets=50)
    assert buckets.read(spark, path).count() == 2000 and sum(n for v in first.rows.values() for n in v) == 2000
    before = buckets.read(spark, path)
    few = spark.createDataFrame([("p7", 1.0, "new"), ("p7", 2.0, "newer"), ("q1", None, "added")], "product_id string, scraped_at double, name string")
    second = buckets.upsert(few, path)
    # Two keys touch two buckets; all others keep their files, and a reader keeps its version.
    touched = {b for b in second.rows if second.rows[b] != first.rows.get(b)}
    assert len(touched) <= 2 and second.base == first.base and set(second.changes) == touched
    assert before.where("name <> 'old'").count() == 0 and before.count() == 2000
    got = {r.product_id: r.name for r in buckets.read(spark, path).where("name <> 'old'").collect()}
    assert got == {"p7": "newer", "q1": "added"} and buckets.read(spark, path).count() == 2001
    assert buckets.read(spark, path, version=1).count() == 2000
    asked = buckets.read(spark, path, keys=["p7", "q1", "absent"])
    assert {(r.product_id, r.name) for r in asked.collect()} == {("p7", "newer"), ("q1", "added")} and len(asked.inputFiles()) <= 8


def test_buckets_with_many_changes_are_written_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(400).select(F.col("id").alias("product_id"), F.lit(1.0).alias("scraped_at"), F.lit(0).alias("n"))
    buckets.create(rows, path, buckets=8)
    for n in range(1, 4):
        buckets.upsert(rows.where(f"product_id % 5 = {n}").withColumn("n", F.lit(n)), path)
    held = buckets.manifest(spark, path)
    assert max(held.base.values()) > 1
    want = {i: i % 5 if i % 5 in (1, 2, 3) else 0 for i in range(400)}
    assert {r.product_id: r.n for r in buckets.read(spark, path).collect()} == want
    assert buckets.vacuum(spark, path, keep=1) and {r.product_id: r.n for r in buckets.read(spark, path).collect()} == want
    buckets.upsert(rows.limit(0), path)
    assert buckets.read(spark, path).count() == 400


def test_second_writer_of_a_version_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(10).select(F.col("id").alias("product_id"), F.lit(1.0).alias("scraped_at"))
    old = buckets.create(rows, path, buckets=4)
    buckets.upsert(rows, path)
    taken = buckets.manifest(spark, path).version
    with pytest.raises(buckets.Conflict):
        buckets._commit(spark, path, old._replace(version=taken))
    assert buckets.create(rows.limit(0), str(tmp_path / "none"), buckets=4).base == {}
    assert buckets.read(spark, str(tmp_path / "none")).count() == 0


def test_save_reads_the_batch_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    data = frame(spark, product(), product(product_id="TI-2"), product(product_id="TI-3", name=None))
    counted = data.mapInArrow(counting, data.schema)
    assert warehouse.save_products(counted, str(tmp_path / "t"), 1, str(tmp_path / "r")) == {"accepted": 2, "rejected": 1}
    assert reads.value == 3 and warehouse.read_log(spark, str(tmp_path / "t")).count() == 2
    assert warehouse.save_products(data.limit(0), str(tmp_path / "t"), 2) == {"accepted": 0, "rejected": 0}
    assert not list((tmp_path / "t/_staged").iterdir())


def test_daily_volume_of_a_stream(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def land(*times):
        made = spark.createDataFrame([(t,) for t in times], "t string").select(F.to_timestamp("t").alias("ts"))
        made.coalesce(1).write.mode("append").parquet(source)
        stream_daily_volume(spark.readStream.schema("ts timestamp").parquet(source), target, progress).awaitTermination()
        return {str(r.day): r.n for r in read_daily_volume(spark, target).collect()}

    assert land("2024-01-01 05:00:00", "2024-01-01 23:59:59", "2024-01-02 00:00:00") == {"2024-01-01": 2, "2024-01-02": 1}
    # One day late counts; the newest event moves the border for what lands next.
    assert land("2024-01-01 10:00:00", "2024-01-09 12:00:00") == {"2024-01-01": 3, "2024-01-02": 1, "2024-01-09": 1}
    assert land("2024-01-02 08:00:00", "2024-01-08 01:00:00") == {"2024-01-01": 3, "2024-01-02": 1, "2024-01-08": 1, "2024-01-09": 1}
    # A run that was lost before it was marked as done writes its folder again.
    last = max(int(p.name) for p in (tmp_path / "progress/commits").glob("[0-9]*"))
    for done in (tmp_path / "progress/commits").glob(f"*{last}*"):
        done.unlink()
    assert land("2024-01-09 13:00:00")["2024-01-09"] == 2


def test_pages_by_number_and_by_key(spark, tmp_path):
    path = str(tmp_path / "ordered")
    data = [(None if k % 17 == 0 else f"n{k * 7 % 40:02d}", k) for k in range(310)]
    paging.write_ordered(spark.createDataFrame(data, "name string, id long"), path, ("name", "id"), rows=60)
    want = sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert spark.read.parquet(f"{path}/ranges").count() > 3
    got, after = [], None
    while page := [tuple(r) for r in paging.page_after(spark, path, after, 45).collect()]:
        assert page == [tuple(r) for r in paging.page_number(spark, path, len(got) // 45 + 1, 45).collect()]
        got, after = got + page, page[-1]
    assert got == want and paging.page_number(spark, path, 9, 45).count() == 0
    plan = paging.page_number(spark, path, 3, 45)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [range" in plan.replace("isnotnull(range", "range") or "range#" in plan.split("PartitionFilters")[1][:80]
    paging.write_ordered(spark.createDataFrame([], "name string, id long"), str(tmp_path / "none"), ("name", "id"))
    assert paging.page_number(spark, str(tmp_path / "none")).count() == paging.page_after(spark, str(tmp_path / "none")).count() == 0


def test_ranges_are_no_more_than_their_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(paging, "RANGES", 4)
    path, data = str(tmp_path / "ordered"), [(f"n{k * 7 % 40:02d}", k) for k in range(310)]
    paging.write_ordered(spark.createDataFrame(data, "name string, id long"), path, ("name", "id"), rows=5)
    assert spark.read.parquet(f"{path}/ranges").count() <= 4
    assert [tuple(r) for r in paging.page_number(spark, path, 5, 45).collect()] == sorted(data)[180:225]
    assert [tuple(r) for r in paging.page_after(spark, path, sorted(data)[179], 45).collect()] == sorted(data)[180:225]


def test_constants_are_split(spark, tmp_path):
    (tmp_path / "a.js").write_text("const PRODUCTS = [" + ",".join(f'{{"product_id": "p{k}", "name": "n{k}"}}' for k in range(4000)) + "];")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = listings.read_listings_js(spark, str(tmp_path / "a.js"))
        assert found.rdd.getNumPartitions() > 2 and found.distinct().count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


ODD_NAMES = ['a}b', '{"', 'back\\', '\\"}', '],[{', '"products": [{', "é}\n}", "", "x" * 700, "}" * 60]


@pytest.fixture(params=[211, 1_000, 1 << 27])
def ranges(spark, request):
    """Ranges of as many bytes, so that few, some or all records cross them."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for name, value in zip(names, (request.param, 1)):
        spark.conf.set(name, str(value))
    yield request.param
    for name in names:
        spark.conf.unset(name)


def written_arrays(folder):
    """The same records as an array, a constant and a wrapper with other keys around them."""
    records = [product(product_id=f"TI-{i}", name=ODD_NAMES[i % len(ODD_NAMES)], moq=i) for i in range(30)]
    other = {"stats": {"x}": {"products": [{"product_id": "no"}]}}, "more": [{"product_id": "no", "name": "}"}] * 9}
    data = other | {"products": records} | {"later": [{"product_id": "no"}] * 5, "text": "}"}
    (folder / "a.json").write_text(json.dumps(records, indent=1), encoding="utf-8")
    (folder / "b.js").write_text(f"const PRODUCTS = {json.dumps(records)};\n", encoding="utf-8")
    (folder / "c.js").write_text(f"const DATA = {json.dumps(data, ensure_ascii=False)}", encoding="utf-8")
    (folder / "d.js").write_text(f"const DATA = {json.dumps(data, indent=2)};", encoding="utf-8")
    return records


def test_arrays_by_ranges(spark, tmp_path, ranges):
    records = written_arrays(tmp_path)
    want = sorted((r["product_id"], r["name"], r["moq"]) for r in records)
    for name in ("a.json", "b.js", "c.js", "d.js"):
        for broadcast in (100_000, 0):
            got = arrays.read_array(spark, str(tmp_path / name), broadcast_ranges=broadcast)
            assert sorted((r.product_id, r.name, r.moq) for r in got.collect()) == want, (name, broadcast)
    whole = listings.read_listings_json(spark, str(tmp_path / "a.json")).orderBy("moq").collect()
    assert arrays.read_array(spark, str(tmp_path / "a.json")).orderBy("moq").collect() == whole
    assert arrays.read_array(spark, str(tmp_path / "*.js")).count() == 90
    if ranges < 2_000:
        assert arrays._pieces(spark, str(tmp_path / "b.js")).select("start").distinct().count() > 5


def test_odd_arrays(spark, tmp_path, ranges):
    def ids(text):
        (tmp_path / "odd.json").write_text(text, encoding="utf-8")
        return [r.product_id for r in arrays.read_array(spark, str(tmp_path / "odd.json")).orderBy("product_id").collect()]

    assert [ids(t) for t in ("", "[]", " [ ] \n", "const PRODUCTS = [];", '{"products": []}', '{"other": [{"product_id": "1"}]}')] == [[]] * 6
    nested = json.dumps([1, None, "}", [{"product_id": "no"}] * 20, {"product_id": "2"}, [[{"a": "]"}] * 20], {"product_id": "3"}])
    assert ids(nested) == ["2", "3"]
    assert ids('[{"product_id": "1"}, {"product_id": 5 5}]') == [None, "1"]
    for cut in ('[{"product_id": "1"}, {"product_id": "2"', '[{"product_id": "1"}', '[{"product_id": "1'):
        with pytest.raises(Exception, match="ends inside of its array"):
            ids(cut)


class _Handed:
    """Stands for a table of pieces, and keeps what would run in its tasks."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def test_flat_records_are_not_looked_at_one_by_one(monkeypatch):
    feed, fed = arrays._Scan.feed, []
    monkeypatch.setattr(arrays._Scan, "feed", lambda self, piece, base=None: fed.append(piece) or feed(self, piece, base))
    records = [f'{{"product_id":"p{i}","name":"{name}"' for i, name in enumerate(["a", r'\"{', "\u00fc ]", ""] * 500)]
    records[700] = '{"product_id":"p700","more":[{"x":1},{"x":2}]'
    text = '["no", ' + "}, ".join(records[:900]) + "},\n\u00e9 " + "},".join(records[900:]) + "}]"
    pieces, n = text.split("}"), len(text)
    places = {"path": ["f"] * len(pieces), "start": [0] * len(pieces), "length": [n] * len(pieces)}
    summed = arrays._summaries(_Handed()).run([pa.RecordBatch.from_pydict({"value": pieces} | places).slice(a, 1000) for a in (0, 1000, 2000)])
    row = pa.Table.from_batches(summed).to_pylist()
    assert [(r["root"], r["quoted0"], r["change0"], r["wrong0"]) for r in row] == [("[", False, -1, False)] and len(fed) < 60
    state = {"quoted": False, "depth": 0, "key": None, "base": 1, "opened": -1}
    given = {"value": pieces, "path": places["path"], "start": places["start"]} | {k: pa.array([v] * len(pieces)) for k, v in state.items()}
    fed.clear()
    found = [t for b in arrays._cut(_Handed(), "products", True).run([pa.RecordBatch.from_pydict(given)]) for t in b["text"].to_pylist()]
    assert sorted(found) == sorted(r + "}" for r in records) and len(fed) < 60
    assert not [t for b in arrays._cut(_Handed(), "products", False).run([pa.RecordBatch.from_pydict(given)]) for t in b["text"].to_pylist()]


def test_write_arrays(spark, tmp_path):
    data = frame(spark, product(name='q"}'), product(product_id="TI-2")).coalesce(1)
    arrays.write_arrays(data, str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text()
    assert [r["name"] for r in json.loads(text)] == ['q"}', "Pump"]
    arrays.write_arrays(data.where("moq > 5"), str(tmp_path / "none"), "PRODUCTS")
    assert arrays.read_array(spark, str(tmp_path / "none")).count() == 0


def test_arrays_cut_elsewhere(spark, tmp_path):
    written_arrays(tmp_path)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    try:
        for before, after in (("1000", "500"), ("1000", "2000")):
            spark.conf.set(names[1], "1")
            spark.conf.set(names[0], before)
            late = arrays.read_array(spark, str(tmp_path / "b.js"))
            spark.conf.set(names[0], after)
            with pytest.raises(Exception, match="changed between two scans"):
                late.collect()
    finally:
        for name in names:
            spark.conf.unset(name)


def test_saved_batches_are_compressed_well(spark, tmp_path):
    df = spark.createDataFrame([("a", "pump", 1.0)], "product_id string, name string, scraped_at double")
    assert warehouse.save_products(df, str(tmp_path / "products"), 1)["accepted"] == 1
    assert all(".zstd." in p.name for p in (tmp_path / "products/batch=1").glob("part-*"))
