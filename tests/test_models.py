import collections
import io
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from mandiscope.catalog import store
from mandiscope.ml import anomaly, cluster, features, price_model, topics, trees
from mandiscope.operators.enrich import tokenize_docs, vocab_filter
from mandiscope.sources.tables import listings, table


@pytest.fixture(scope="module")
def products(spark, folder):
    return listings(spark, folder).cache()


def test_clusters(products):
    out = cluster.supplier_clusters(products, restarts=1)
    found = cluster.cluster_profiles(out).collect()
    assert {r.supplier_cluster for r in found} == {0, 1, 2, 3} and sum(r.n for r in found) == products.count()
    costs = [r.cost for r in cluster.elbow(products, restarts=1).orderBy("k").collect()]
    assert len(costs) == 8 and costs[-1] < costs[0]
    assert cluster.supplier_clusters(products.limit(5)) is None


def test_settled(spark):
    rows = [(float(i % 2 * 10 + i % 3), 1.0, i % 2 if i else 1) for i in range(12)]
    df = spark.createDataFrame(rows, "x double, y double, supplier_cluster int")
    found = cluster.settled(df, ["x", "y"]).collect()
    # The first row lies among cluster 0 but is given to cluster 1; the second feature is constant.
    assert [r.settled for r in found] == [False] + [True] * 11


def test_threshold_check(spark):
    def check(scores, flagged):
        df = spark.createDataFrame([(float(s), f) for s, f in zip(scores, flagged)], "anomaly_score double, is_anomaly boolean")
        return tuple(anomaly.threshold_check(df).first())

    assert check(range(21), [i < 2 for i in range(21)]) == (21, True, True)
    assert check(range(21), [i < 1 for i in range(21)]) == (21, True, False)
    assert check(range(21), [i < 4 for i in range(21)]) == (21, True, False)
    assert check(range(21), [i in (0, 5) for i in range(21)]) == (21, False, True)
    # Three rows tie at the threshold, so only the one below is flagged.
    assert check([0, 1, 1, 1, *range(2, 19)], [i < 1 for i in range(21)]) == (21, True, True)


def test_number_of_clusters():
    assert cluster.choose_k(100) == 4 and cluster.choose_k(12) == 4 and cluster.choose_k(11) == 4
    assert list(cluster.candidate_ks(12)) == [2, 3, 4, 5]


def test_price_model(products):
    fitted = price_model.fit_price_model(products, trees=10, max_depth=4)
    scores = price_model.metrics(fitted).first()
    assert math.isfinite(scores.r2) and scores.r2 == pytest.approx(price_model.evaluate(fitted), abs=1e-6)
    weights = price_model.feature_importance(fitted).collect()
    assert sum(r.importance for r in weights) == pytest.approx(1.0)
    again = price_model.metrics(price_model.fit_price_model(products, trees=10, max_depth=4)).first()
    assert again.n == scores.n and again.mse == pytest.approx(scores.mse)
    assert price_model.fit_price_model(products.limit(3)) is None


def test_anomalies(spark, products):
    out = anomaly.price_anomalies(products)
    found = anomaly.anomaly_summary(out).first()
    assert found.n == products.count() and 9 < found.anomaly_pct <= 10
    rng = np.random.default_rng(2)
    rows = [(str(i), *map(float, rng.normal(100, 1, 3))) for i in range(300)] + [("odd", 900.0, 900.0, 900.0)]
    small = anomaly.price_anomalies(spark.createDataFrame(rows, "product_id string, price_min double, price_max double, moq double"))
    assert small.orderBy("anomaly_score").first().product_id == "odd"


def test_topics(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = topics.fit_topics(docs, "text", passes=1)
    terms = topics.topic_terms(model).collect()
    assert len(terms) == 25 and all(r.weight > 0 for r in terms)
    shares = topics.topic_histogram(model).collect()
    assert sum(r.n for r in shares) == model.documents.count() and {r.topic for r in shares} <= set(range(5))
    assert topics.fit_topics(docs.limit(4), "text") is None


def test_topics_in_blocks_and_shards_follow_the_plain_passes(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text").where("doc_id < 60")
    model = topics.fit_topics(docs, "text", passes=2, block=2000, shard=100)
    assert model.blocks.count() > 3 and model.vocabulary.select("shard").distinct().count() > 3
    tokenized = tokenize_docs(docs, "text")
    words = {r.token: (r.shard, r.place) for r in model.vocabulary.collect()}
    assert set(words) == {r.token for r in vocab_filter(tokenized).collect()}
    order = {w: i for i, w in enumerate(sorted(words, key=words.get))}
    sizes = collections.Counter(shard for shard, _ in words.values())
    own = np.concatenate([np.random.default_rng([42, s]).gamma(100, 0.01, (sizes[s], 5)) for s in sorted(sizes)])
    bags = {r.doc_id: collections.Counter(order[t] for t in r.tokens if t in order) for r in tokenized.collect()}

    def logs(x):
        return topics._digamma(x) - topics._digamma(x.sum())

    def mixture(bag, near, prior):
        at, n = list(bag), np.array(list(bag.values()))
        now, before = np.ones(5), np.zeros(5)
        while np.abs(now - before).mean() > 1e-4:
            share = np.exp(logs(now))
            now, before = prior + share * (near[at].T @ (n / (near[at] @ share))), now
        return now, at, n

    prior = np.full(5, 0.2)
    for number in (1, 2):
        near, step, found, seen = np.exp(topics._digamma(own) - topics._digamma(own.sum(0))), (1024 + number) ** -0.51, 0 * own, []
        for bag in filter(None, bags.values()):
            now, at, n = mixture(bag, near, prior)
            share = np.exp(logs(now))
            found[at] += share * near[at] * (n / (near[at] @ share))[:, None]
            seen.append(logs(now))
        own = (1 - step) * own + step * (found + 0.2)
        prior = topics._moved(prior, sum(seen), len(seen), step)
    assert model.totals == pytest.approx(own.sum(0), rel=0.01) and model.concentration == pytest.approx(prior, rel=0.01)
    got = {(r.topic, r["rank"]): r.weight for r in topics.topic_terms(model).collect()}
    share = np.sort(own / own.sum(0), axis=0)[::-1]
    assert got == {(k, i + 1): pytest.approx(share[i, k], rel=0.02) for k in range(5) for i in range(5)}
    near = np.exp(topics._digamma(own) - topics._digamma(own.sum(0)))
    want = {d: int(mixture(bag, near, prior)[0].argmax()) if bag else 0 for d, bag in bags.items()}
    told = {r.doc_id: r.topic for r in topics.dominant_topics(model).collect()}
    assert set(told) == set(want) and np.mean([told[d] == want[d] for d in want]) > 0.95


def test_words_of_a_shard_are_fewer_the_more_blocks_there_are(spark, folder, monkeypatch):
    docs = table(spark, folder, "documents").select("doc_id", "text").where("doc_id < 60")
    monkeypatch.setattr(topics, "SHARD_BLOCKS", 600)
    model = topics.fit_topics(docs, "text", passes=1, block=2000)
    blocks = model.blocks.count()
    words = model.vocabulary.groupBy("shard").count().agg(F.max("count")).first()[0]
    held = model.weights.where("block >= 0").groupBy("shard").agg(F.sum(F.octet_length("data") / 40).alias("n")).agg(F.max("n")).first()[0]
    # A hash deals the words, so a shard may have some more than its share.
    assert blocks > 3 and words <= 2 * 600 / blocks and held <= 2 * 600


def test_mixtures_settle_in_few_steps_while_topics_are_alike(monkeypatch):
    rng, prior, seen, ratio = np.random.default_rng(3), np.full(5, 0.2), [], topics._ratio
    weights, counts = rng.gamma(100, 0.01, (50, 5, 300)), rng.integers(1, 4, (50, 300)).astype(float)
    counts[0, 3:] = 0
    monkeypatch.setattr(topics, "_ratio", lambda w, n, s: seen.append(len(n)) or ratio(w, n, s))
    found = topics._settle(weights, counts, prior)
    assert len(seen) < 80 and sum(seen) < 40 * len(counts)

    def step(mixture):
        share = topics._share(mixture)
        return prior + share * np.matmul(weights, ratio(weights, counts, share)[:, :, None])[:, :, 0]

    def bound(mixture):
        logs = np.log(topics._share(mixture))
        own = [sum(map(math.lgamma, m)) - math.lgamma(m.sum()) for m in mixture]
        return (counts * np.log(np.matmul(np.exp(logs)[:, None, :], weights)[:, 0])).sum(1) + ((prior - mixture) * logs).sum(1) + own

    plain = np.ones((50, 5))
    for _ in range(3000):
        plain = step(plain)
    # What stands still is as good as where plain steps end.
    assert (np.abs(step(found) - found).mean(1) < 2 * topics.TOLERANCE).all() and (found > prior).all()
    assert found.sum(1) == pytest.approx(prior.sum() + counts.sum(1), rel=1e-3) and (bound(found) - bound(plain)).mean() > -0.05


def test_few_topics_or_no_word_in_two_texts(spark):
    alone = spark.createDataFrame([(f"word{i}x",) for i in range(20)], "description string")
    assert topics.fit_topics(alone) is None


def test_features(spark):
    df = spark.createDataFrame([(1.0, 7.0, "b"), (3.0, 7.0, None), (None, 7.0, "b")], "x double, c double, t string")
    filled = features.impute(df, ["x"], ["t"])
    assert sorted((r.x, r.t) for r in filled.collect()) == [(1.0, "b"), (2.0, "b"), (3.0, "b")]
    scaled = features.standardize(filled, ["x", "c"]).agg(F.stddev_pop("z_x"), F.max("z_c")).first()
    assert scaled[0] == pytest.approx(1.0) and scaled[1] == 0.0
    codes = features.label_codes(spark.createDataFrame([(f"v{i:03d}",) for i in range(100)] * 2, "t string"), "t")
    assert [r.code for r in codes.orderBy("value").collect()] == list(range(100))


def test_prepared_rows_are_the_same_after_saving(spark, tmp_path):
    rows = [("a", 1.0, 10, "x"), ("b", None, 20, None), ("c", 5.0, None, "x"), ("d", 3.0, 40, "y"), ("e", None, None, None)]
    df = spark.createDataFrame(rows, "id string, price_min double, price_max int, kind string").withColumn("none", F.lit(None).cast("string"))
    fitted = features.prepare(["price_min", "price_max"], ["kind", "none"], ["price_min", "avg_price"], averaged=True).fit(df)
    fitted.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    want = {r.id: r for r in fitted.transform(df).collect()}
    assert want == {r.id: r for r in loaded.transform(df).collect()}
    assert (want["e"].price_min, want["e"].price_max, want["e"].kind, want["e"].none) == (3.0, 20.0, "x", "unknown")
    assert want["e"].avg_price == 11.5 and sum(r.z_price_min for r in want.values()) == pytest.approx(0)
    fresh = spark.createDataFrame([("f", None, 7, None)], "id string, price_min double, price_max int, kind string").withColumn("none", F.lit("n"))
    assert tuple(loaded.transform(fresh).first())[:6] == ("f", 3.0, 7.0, "x", "n", 5.0)


def test_columns_without_values_stay_null(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "x double, y double")
    out = features.prepare(["x", "y"], [], ["x", "y"]).fit(df).transform(df).collect()
    assert [(r.x, r.y, r.z_x, r.z_y) for r in out] == [(1.0, None, 0.0, None)] * 2


def test_rows_with_gaps_stay_in_the_models(spark, products):
    gaps = products.withColumn("moq", F.when(F.col("moq") > 5, F.col("moq"))).withColumn("price_max", F.when(F.col("moq") < 40, F.col("price_max")))
    assert gaps.where("moq is null or price_max is null").count() > 0
    assert cluster.supplier_clusters(gaps, restarts=1).where("supplier_cluster is not null").count() == products.count()
    assert anomaly.price_anomalies(gaps).where("anomaly_score is not null").count() == products.count()
    fitted = price_model.fit_price_model(gaps, trees=3, max_depth=3)
    tested = price_model.split_by_hash(products, "product_id")[1]
    assert fitted.predictions.where("predicted is not null").count() == tested.count()


def plain_lloyd(x, centres, most):
    for step in range(most + 1):
        own = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        cost = ((x - centres[own]) ** 2).sum()
        moved = np.array([x[own == k].mean(0) if (own == k).any() else c for k, c in enumerate(centres)])
        if step == most or np.abs(moved - centres).max() <= cluster.TOLERANCE:
            return centres, cost
        centres = moved


@pytest.mark.parametrize("most", [0, 2, 300])
def test_runs_that_share_passes_are_those_of_each_alone(spark, most):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 0.3, (60, 2)) for c in (0, 3, 7)])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double").repartition(5)
    asked = [(2, 0), (3, 0), (3, 1), (5, 4)]
    hashed = df.withColumn("h", F.xxhash64("a", "b", F.lit(cluster.SEED))).orderBy("h", "a", "b").collect()
    sample = np.array([tuple(r)[:2] for r in hashed])
    for run, found in cluster.shared_runs(df, asked, most).items():
        centres, cost = plain_lloyd(x, cluster._first_centres(sample, *run), most)
        assert found.centres == pytest.approx(centres) and found.cost == pytest.approx(cost)
    assert cluster.shared_runs(df.limit(0), asked) == {}


def test_equal_rows_are_read_once_per_pass(spark, monkeypatch):
    x = np.repeat(np.random.default_rng(3).normal(size=(40, 2)), np.arange(40) % 7 + 1, axis=0)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double").repartition(5)
    held, first = {}, cluster._first_centres

    def start(sample, k, run, counts):
        held[k, run] = first(sample, k, run, counts)
        assert len(sample) == 40 and counts.sum() == len(x)
        return held[k, run]

    monkeypatch.setattr(cluster, "_first_centres", start)
    for run, found in cluster.shared_runs(df, [(2, 0), (5, 1)]).items():
        centres, cost = plain_lloyd(x, held[run], 300)
        assert found.centres == pytest.approx(centres) and found.cost == pytest.approx(cost)


def test_scans_that_carry_several_passes_are_plain_passes(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 2)).round(4)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double").repartition(5).persist()
    scans, scan, held, first = [], cluster._scan, {}, cluster._first_centres
    monkeypatch.setattr(cluster, "OPEN", 1200)
    monkeypatch.setattr(cluster, "_scan", lambda moving, bounds: scans.append(bounds) or scan(moving, bounds))
    monkeypatch.setattr(cluster, "_first_centres", lambda *given: held.setdefault(given[1:3], first(*given)))
    asked = [(3, 0), (5, 1)]
    found = cluster.shared_runs(df, asked)
    passes = []
    for run in asked:
        centres, cost = plain_lloyd(x, held[run], 300)
        assert found[run].centres == pytest.approx(centres) and found[run].cost == pytest.approx(cost)
        passes.append(next(n for n in range(300) if plain_lloyd(x, held[run], n)[1] == cost))
    # Some scans sum up all rows, some leave rows open, and they are fewer than the passes.
    assert any(0 in b.values() for b in scans) and any(0 < v < np.inf for b in scans for v in b.values())
    assert 2 * len(scans) < max(passes)


def plain_tree(x, y, depth):
    def build(rows, left):
        best = (1e-9, None, None)
        if left and len(rows) > 1:
            for j in range(x.shape[1]):
                own = rows[np.argsort(x[rows, j], kind="stable")]
                for i in range(1, len(own)):
                    if x[own[i - 1], j] < x[own[i], j]:
                        a, b = y[own[:i]], y[own[i:]]
                        gain = a.sum() ** 2 / len(a) + b.sum() ** 2 / len(b) - y[rows].sum() ** 2 / len(rows)
                        if gain > best[0] + 1e-9:
                            best = (gain, j, (x[own[i - 1], j] + x[own[i], j]) / 2)
        if best[1] is None:
            return y[rows].mean()
        over = x[rows, best[1]] > best[2]
        return best[1], best[2], build(rows[~over], left - 1), build(rows[over], left - 1)

    def told(row, node):
        while isinstance(node, tuple):
            node = node[3] if row[node[0]] > node[1] else node[2]
        return node

    root = build(np.arange(len(y)), depth)
    return np.array([told(row, root) for row in x])


@pytest.mark.parametrize("seed", range(8))
def test_tree_is_that_of_plain_search(seed):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 6, 60), rng.normal(size=60), rng.integers(0, 3, 60)]).astype(float)
    y = rng.normal(size=60) + x[:, 0]
    nodes, gains = trees.grow_tree(x, y, seed)
    packed = io.BytesIO()
    np.savez_compressed(packed, at=nodes[:, [0, 2]].astype(np.int32), value=nodes[:, [1, 3]])
    assert trees.predict_sums(x, [packed.getvalue()]) == pytest.approx(plain_tree(x, y, seed))
    assert seed == 0 or gains.sum() <= ((y - y.mean()) ** 2).sum() + 1e-6


def test_forest_takes_all_rows_whatever_the_partitions(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(f"r{k}", float(a), float(b), float(a * 3 + rng.normal() / 9)) for k, (a, b) in enumerate(zip(rng.integers(0, 20, 500), rng.normal(size=500)))]
    df = spark.createDataFrame(rows, "key string, a double, b double, y double")
    made = [trees.grow_forest(df.repartition(n), ["a", "b"], "y", "key", 12, 30, 42, share=40) for n in (1, 6)]
    first, second = ({r.tree: bytes(r.nodes) for r in m.collect()} for m in made)
    assert first == second and set(first) == set(range(12))
    want = {r.key: r.predicted for r in trees.predict(df, made[0], ["a", "b"]).collect()}
    monkeypatch.setattr(trees, "SENT", 1)
    assert {r.key: r.predicted for r in trees.predict(df, made[0], ["a", "b"]).collect()} == pytest.approx(want)
    assert np.mean([(want[k] - y) ** 2 for k, _, _, y in rows]) < 3


def test_trees_draw_from_all_rows_however_few_a_task_takes(spark):
    rng = np.random.default_rng(4)
    # More rows than trees times share, some of them equal, and without keys that tell them apart.
    rows = [(None, float(a), float(b), float(a * 3 + b)) for a, b in zip(rng.integers(0, 20, 600), rng.normal(size=600))]
    rows += rows[:100]
    df = spark.createDataFrame(rows, "key string, a double, b double, y double")
    few, all_ = (trees.grow_forest(df, ["a", "b"], "y", "key", 6, 30, 42, share=s) for s in (90, 10_000))
    assert few.where("part > 0").count() > 12 and all_.where("part > 0").count() == 0
    found = [np.array([r.predicted for r in trees.predict(df, f, ["a", "b"]).orderBy("a", "b").collect()]) for f in (few, all_)]
    assert len(found[0]) == 700 and np.abs(found[0] - found[1]).mean() < 0.05
    weights = [{r["at"]: r.importance for r in trees.importances(f).collect()} for f in (few, all_)]
    assert weights[0] == pytest.approx(weights[1], abs=0.01) and sum(weights[0].values()) == pytest.approx(1)
    hashes = rng.integers(-(2**63), 2**63 - 1, 40_000)
    for mean in (1, 3, 2000):
        drawn = trees._draws(hashes, np.full(40_000, mean), 5)
        assert drawn.mean() == pytest.approx(mean, rel=0.03) and drawn.var() == pytest.approx(mean, rel=0.05)


def test_equal_features_are_predicted_once(spark, monkeypatch):
    rows = [(f"r{k}", float(k % 5), None if k % 3 else -0.0, float(k)) for k in range(90)]
    df = spark.createDataFrame(rows, "key string, a double, b double, y double")
    forest, asked, means = trees.grow_forest(df.fillna(1.0), ["a", "b"], "y", "key", 4, 30, 42, share=40), [], trees._means
    want = {r.key: r.predicted for r in means(df.fillna(1.0), forest, ["a", "b"], "predicted").collect()}
    monkeypatch.setattr(trees, "_means", lambda unique, *rest: asked.append(unique.count()) or means(unique, *rest))
    assert {r.key: r.predicted for r in trees.predict(df.fillna(1.0), forest, ["a", "b"]).collect()} == want
    assert asked == [10]


def test_fits_are_held_for_the_state_of_their_files(spark, tmp_path):
    path, fits = str(tmp_path / "t.parquet"), []
    fit = lambda data: fits.append(1) or data.count()
    spark.range(5).write.parquet(path)
    assert store._once("t", spark.read.parquet(path), fit) == store._once("t", spark.read.parquet(path), fit) == 5
    spark.range(7).write.mode("overwrite").parquet(path)
    assert store._once("t", spark.read.parquet(path), fit) == 7 and len(fits) == 2
