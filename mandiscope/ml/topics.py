"""Topics of descriptions by latent Dirichlet allocation.

Variational Bayes in passes over all documents, with the step and the fitted document concentration of Spark's online
optimizer, but with the words' weights in tables: neither the driver nor a task ever holds the vocabulary. Documents lie in
blocks, words in shards. A pass sends each block the weights of its own words and each shard the counts the blocks found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mandiscope.operators.enrich import tokenize
from mandiscope.session import forget, spread, written

# Topics, passes, words per topic, document bounds and seed.
TOPICS = 5
PASSES = 10
TOP_WORDS = 5
MIN_DOCS = 2
MAX_SHARE = 0.5
SEED = 42
MIN_TEXTS = 10
MIN_TOKENIZED = 5
# The step of pass t is (OFFSET + t) ** -DECAY, first weights are gamma of this shape, documents settle at this change.
OFFSET = 1024
DECAY = 0.51
SHAPE = 100.0
TOLERANCE = 1e-3
#: Plain steps of a document before many are taken at once; where topics differ much, most documents need few more.
PLAIN = 5
#: Tokens of a block of documents, words of a shard, and pairs of document and word that a task works on at once.
BLOCK = 4_000_000
SHARD = 16_384
PAIRS = 32_768
#: Words of a shard times blocks, as a shard's task holds what all blocks have counted for its words: at ``TOPICS`` topics some 21 MB.
SHARD_BLOCKS = 32 * SHARD

_BLOCKS = "block long, docs binary, starts binary, at binary, counts binary"
#: ``data`` of block -1 is the shard's own weights, elsewhere what a block gets of a shard or found for it; shard -1 sums up documents.
_SENT = "shard long, block long, data binary, sums array<double>"
_SENT_ARROW = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("data", pa.binary()), ("sums", pa.list_(pa.float64()))])


class TopicModel(NamedTuple):
    """``vocabulary`` has a row per word, ``documents`` one per text with a token, ``weights`` the shards of the words."""

    vocabulary: DataFrame
    documents: DataFrame
    blocks: DataFrame
    weights: DataFrame
    totals: np.ndarray
    concentration: np.ndarray


def _digamma(x: np.ndarray) -> np.ndarray:
    """By the recurrence up to 8 and more, two steps at once, then the asymptotic series."""
    less = sum((2 * x + 2 * i + 1) / ((x + i) * (x + i + 1)) for i in (0, 2, 4, 6))
    y = x + 8
    f = 1 / (y * y)
    return np.log(y) - 0.5 / y - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f / 240))) - less


def _trigamma(x: np.ndarray) -> np.ndarray:
    more = sum(1 / (x + i) ** 2 for i in range(8))
    y = x + 8
    f = 1 / (y * y)
    return more + 1 / y + f / 2 + f / y * (1 / 6 - f * (1 / 30 - f * (1 / 42 - f / 30)))


def _blocks(documents: DataFrame, tokens: int) -> DataFrame:
    """Documents in blocks of about so many tokens: per document the places of its distinct words in the block's list, and their counts."""
    schema = "block long, docs binary, starts binary, at binary, counts binary, words array<string>, in_docs array<long>"

    def row(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        docs, lists = table["_doc"].to_numpy(), table["tokens"].chunk(0)
        coded = lists.flatten().dictionary_encode()
        own = np.repeat(np.arange(len(docs)), lists.value_lengths().to_numpy())
        pair, counts = np.unique(own * len(coded.dictionary) + coded.indices.to_numpy(), return_counts=True)
        own, at = np.divmod(pair, len(coded.dictionary))
        starts = np.searchsorted(own, np.arange(len(docs) + 1))
        packed = [a.astype(t).tobytes() for a, t in ((docs, "i8"), (starts, "i8"), (at, "i4"), (counts, "i4"))]
        listed = [pa.ListArray.from_arrays([0, len(coded.dictionary)], a) for a in (coded.dictionary.cast(pa.string()), pa.array(np.bincount(at)))]
        columns = [pa.array([int(docs[0])]), *(pa.array([p], pa.binary()) for p in packed), *listed]
        return pa.RecordBatch.from_arrays(columns, "block docs starts at counts words in_docs".split())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ends = np.cumsum(batch["tokens"].value_lengths().to_numpy())
            places = [0, *(np.flatnonzero(np.diff(ends // tokens)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(places, places[1:]):
                if lo < hi:
                    held.append(batch.slice(lo, hi - lo))
                    size += len(held[-1]["tokens"].flatten())
                if size >= tokens:
                    yield row(held)
                    held, size = [], 0
        if held:
            yield row(held)

    return documents.select("_doc", "tokens").mapInArrow(cut, schema)


def _renumber(blocks: pa.Table, known: pa.Table) -> pa.Table:
    """The block with its words numbered by shard and place, and without those outside of the vocabulary."""
    row = blocks.to_pylist()[0]
    old, starts = np.frombuffer(row["at"], "i4"), np.frombuffer(row["starts"], "i8")
    order = np.lexsort((known["place"].to_numpy(), known["shard"].to_numpy()))
    number = np.full(row["words"], -1, "i4")
    number[known["at"].to_numpy()[order]] = np.arange(len(order))
    at = number[old]
    kept = at >= 0
    starts = np.concatenate(([0], np.cumsum(kept)))[starts]
    packed = [starts.astype("i8").tobytes(), at[kept].tobytes(), np.frombuffer(row["counts"], "i4")[kept].tobytes()]
    columns = [pa.array([row["block"]]), *(pa.array([p], pa.binary()) for p in (row["docs"], *packed))]
    return pa.Table.from_arrays(columns, "block docs starts at counts".split())


def _share(mixture: np.ndarray) -> np.ndarray:
    """Exponent of the expected logarithm of the topics' shares, one row per document."""
    return np.exp(_digamma(mixture) - _digamma(mixture.sum(1, keepdims=True)))


def _ratio(weights: np.ndarray, counts: np.ndarray, share: np.ndarray) -> np.ndarray:
    return counts / (np.matmul(share[:, None, :], weights)[:, 0] + 1e-100)


def _settle(weights: np.ndarray, counts: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Mixture of topics per document, each moved until a plain step changes it little; ``weights`` are document x topic x word.

    While topics are alike, plain steps creep for a thousand steps. So after the first few a mixture goes along the path of plain
    steps, many at once, by the exponential of their linear form (exponential Euler): four times as many where the force was foretold
    well, a quarter where it was not. A topic's share above its prior falls to no less than a tenth at once. The end is that of plain steps.
    """
    size = len(prior)
    mixture, out = np.ones((len(counts), size)), np.empty((len(counts), size))
    at, span, foretold, force, number = np.arange(len(counts)), np.ones(len(counts)), None, None, 0
    while True:
        share, before = _share(mixture), force
        ratio = _ratio(weights, counts, share)
        drawn = share * np.matmul(weights, ratio[:, :, None])[:, :, 0]
        force = prior + drawn - mixture
        moving = np.abs(force).mean(1) > TOLERANCE
        if not moving.all():
            out[at[~moving]] = (mixture + force)[~moving]
            if not moving.any():
                return out
            at, weights, counts, mixture, span, share, ratio, drawn, force = (
                x[moving] for x in (at, weights, counts, mixture, span, share, ratio, drawn, force)
            )
            before, foretold = (x if x is None else x[moving] for x in (before, foretold))
        number += 1
        if number <= PLAIN:
            mixture = mixture + force
            continue
        if foretold is not None:
            most = np.maximum(np.abs(force).sum(1), np.abs(before).sum(1))
            missed = np.abs(force - foretold).sum(1) / most
            span = np.where(missed < 0.5, span * 4, np.where(missed > 0.9, np.maximum(span / 4, 1), span))
        # The Jacobian of a plain step is a symmetric matrix times the diagonal of trigamma.
        pair = weights * share[:, :, None] * (ratio / np.sqrt(np.maximum(counts, 1)))[:, None, :]
        bend = np.eye(size) * drawn[:, :, None] - np.matmul(pair, pair.transpose(0, 2, 1))
        root = np.sqrt(_trigamma(mixture))
        pace, axes = np.linalg.eigh(root[:, :, None] * bend * root[:, None, :] - np.eye(size))
        pace = np.where(np.abs(pace) < 1e-9, 1e-9, pace)
        along = np.matmul(axes.transpose(0, 2, 1), (root * force)[:, :, None])[:, :, 0]
        gone = np.expm1(np.minimum(pace * span[:, None], 2)) / pace * along
        far = np.maximum(np.matmul(axes, gone[:, :, None])[:, :, 0] / root, 0.9 * (prior - mixture))
        gone = np.matmul(axes.transpose(0, 2, 1), (root * far)[:, :, None])[:, :, 0]
        foretold = force + np.matmul(axes, (pace * gone)[:, :, None])[:, :, 0] / root
        mixture = mixture + far


def _infer(block: dict, sent: list[np.ndarray], totals: np.ndarray, prior: np.ndarray, found: np.ndarray | None = None) -> np.ndarray:
    """Mixture of topics per document, of zeros where no word is known; counts of topics per word are added to ``found``."""
    weights = np.concatenate([np.zeros((0, len(prior))), *sent]) * np.exp(-_digamma(totals))
    starts = np.frombuffer(block["starts"], "i8")
    at, counts = np.frombuffer(block["at"], "i4"), np.frombuffer(block["counts"], "i4").astype(float)
    sizes = np.diff(starts)
    mixtures = np.zeros((len(sizes), len(prior)))
    # Documents of about one size together, filled up to the largest with pairs that count zero.
    order = np.argsort(sizes, kind="stable")
    order, done = order[sizes[order] > 0], 0
    while done < len(order):
        ahead = sizes[order[done : done + PAIRS]]
        fit = max(1, int((ahead * np.arange(1, len(ahead) + 1) <= PAIRS).sum()))
        docs = order[done : done + fit]
        done += fit
        place = np.arange(sizes[docs[-1]])
        real = place < sizes[docs][:, None]
        pairs = np.where(real, starts[docs][:, None] + place, 0)
        words, own = np.unique(at[pairs], return_inverse=True)
        near, number = weights[words], np.where(real, counts[pairs], 0.0)
        drawn = np.ascontiguousarray(near[own.reshape(pairs.shape)].transpose(0, 2, 1))
        mixture = mixtures[docs] = _settle(drawn, number, prior)
        if found is not None:
            share = _share(mixture)
            ratio = _ratio(drawn, number, share)
            for k in range(len(prior)):
                found[words, k] += np.bincount(own.ravel(), (share[:, k, None] * ratio).ravel(), len(words)) * near[:, k]
    return mixtures


def _matrices(table: pa.Table, topics: int) -> list[np.ndarray]:
    return [np.frombuffer(data, float).reshape(-1, topics) for data in table["data"].to_pylist()]


def _places(links: pa.Table) -> list[np.ndarray]:
    return [one.values.to_numpy() for one in links["places"]]


def _send(shard: int, own: np.ndarray, links: pa.Table) -> pa.Table:
    """The shard's weights, and to every block what it needs of them."""
    near = np.exp(_digamma(own))
    data = [own.tobytes(), *(near[places].tobytes() for places in _places(links))]
    blocks = [-1, *links["block"].to_pylist()]
    sums = [own.sum(0).tolist(), *[None] * len(links)]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(([shard] * len(blocks), blocks, data, sums), _SENT_ARROW)], schema=_SENT_ARROW)


def _expected(sent: DataFrame, blocks: DataFrame, parts: int, totals: np.ndarray, prior: np.ndarray) -> DataFrame:
    """What the blocks' documents count for the words of every shard, times the words' weights; ``parts`` tasks deal with the blocks."""

    def expect(sent: pa.Table, blocks: pa.Table) -> pa.Table:
        sent, block = sent.sort_by("shard"), blocks.to_pylist()[0]
        parts = _matrices(sent, len(prior))
        found = np.zeros((sum(map(len, parts)), len(prior)))
        mixtures = _infer(block, parts, totals, prior, found)
        mixtures = mixtures[mixtures.any(1)]
        logs = np.log(_share(mixtures)).sum(0)
        data = [f.tobytes() for f in np.split(found, np.cumsum([len(p) for p in parts])[:-1])] if parts else []
        shards = sent["shard"].to_pylist()
        sums = [*[None] * len(shards), [*logs.tolist(), float(len(mixtures))]]
        columns = [*shards, -1], [block["block"]] * (len(shards) + 1), [*data, None], sums
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SENT_ARROW)], schema=_SENT_ARROW)

    # A block is much work for its bytes: by their size the planner would put many into one task.
    dealt = (df.repartition(parts, "block").groupBy("block") for df in (sent.where("block >= 0"), blocks))
    return next(dealt).cogroup(next(dealt)).applyInArrow(expect, _SENT)


def _updated(sent: DataFrame, counted: DataFrame, links: DataFrame, step: float, topics: int) -> DataFrame:
    """The shards moved towards what the blocks counted, as sent to the blocks again."""

    def update(key: tuple, tables: pa.Table, links: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        if shard < 0:
            sums = np.array(tables["sums"].to_pylist()).sum(0)
            return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip((-1, -1, None, sums.tolist()), _SENT_ARROW)], schema=_SENT_ARROW)
        parts = dict(zip(tables["block"].to_pylist(), _matrices(tables, topics)))
        own = parts.pop(-1)
        total = np.zeros_like(own)
        # Blocks in order, so that sums don't depend on the order of arrival; a block has a word of the shard once.
        for block, places in sorted(zip(links["block"].to_pylist(), _places(links)), key=lambda link: link[0]):
            total[places] += parts[block]
        return _send(shard, (1 - step) * own + step * (total + 1 / topics), links)

    held = sent.where("block = -1 AND shard >= 0").unionByName(counted)
    return held.groupBy("shard").cogroup(links.groupBy("shard")).applyInArrow(update, _SENT)


def _sums(sent: DataFrame, topics: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights per topic over all words; over documents the sums of the topics' logarithms, and their number. One row per shard is read."""
    own = sent.where("block = -1").groupBy((F.col("shard") >= 0).alias("words"))
    rows = own.agg(*(F.sum(F.get("sums", F.lit(k))) for k in range(topics + 1))).collect()
    found = {r.words: [v or 0.0 for v in r[1:]] for r in rows}
    logs = found.get(False, [0.0] * (topics + 1))
    return np.array(found[True][:topics]), np.array(logs[:topics]), logs[topics]


def _moved(prior: np.ndarray, logs: np.ndarray, n: float, step: float) -> np.ndarray:
    """The document concentration after a Newton step on its likelihood, if that stays positive."""
    slope = n * (_digamma(prior.sum()) - _digamma(prior) + logs / n)
    c, q = n * _trigamma(prior.sum()), -n * _trigamma(prior)
    b = (slope / q).sum() / (1 / c + (1 / q).sum())
    moved = prior - step * (slope - b) / q
    return moved if (moved > 0).all() else prior


def fit_topics(
    df: DataFrame, text: str = "description", topics: int = TOPICS, passes: int = PASSES, block: int = BLOCK, shard: int = SHARD
) -> TopicModel | None:
    """Topics over all non-empty texts and all tokens within the document bounds; ``None`` when there are too few of them."""
    texts = df.where(F.col(text).isNotNull())
    # The number is made along with the tokens, so the planner keeps the filter above both and tokens are not made twice.
    numbered = spread(texts).select("*", tokenize(F.col(text)).alias("tokens"), F.monotonically_increasing_id().alias("_doc"))
    documents = written(numbered.where(F.size("tokens") > 0))
    total = documents.count()
    if total <= MIN_TOKENIZED or texts.limit(MIN_TEXTS + 1).count() <= MIN_TEXTS:
        return None
    drafts = written(_blocks(documents, block))
    entries = drafts.select("block", F.posexplode(F.arrays_zip("words", "in_docs")).alias("at", "e")).select(
        "block", "at", F.col("e.words").alias("token"), F.col("e.in_docs").alias("n")
    )
    counts = entries.groupBy("token").agg(F.sum("n").alias("doc_count"))
    words = written(counts.where(F.col("doc_count").between(MIN_DOCS, math.floor(total * MAX_SHARE))))
    shards = math.ceil(words.count() / min(shard, max(1, SHARD_BLOCKS // drafts.count())))
    if not shards:
        return None
    # A hash deals words evenly, so a window holds about ``shard`` of them.
    dealt = words.withColumn("shard", F.pmod(F.xxhash64("token"), F.lit(shards)))
    place = F.row_number().over(Window.partitionBy("shard").orderBy("token")) - 1
    vocabulary = written(dealt.withColumn("place", place))
    known = written(entries.join(vocabulary, "token").select("block", "at", "shard", "place"))
    links = written(known.groupBy("shard", "block").agg(F.sort_array(F.collect_list("place")).alias("places")))
    plain = drafts.select("block", "docs", "starts", "at", "counts", F.size("words").alias("words"))
    blocks = written(plain.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_renumber, _BLOCKS))

    def start(key: tuple, words: pa.Table, links: pa.Table) -> pa.Table:
        number = key[0].as_py()
        draw = np.random.default_rng([SEED, number]).gamma(SHAPE, 1 / SHAPE, (len(words), topics))
        return _send(number, draw, links)

    own = vocabulary.select("shard", "place").groupBy("shard")
    sent = written(own.cogroup(links.groupBy("shard")).applyInArrow(start, _SENT))
    totals, prior, parts = _sums(sent, topics)[0], np.full(topics, 1 / topics), 2 * blocks.count()
    for number in range(1, passes + 1):
        step = (OFFSET + number) ** -DECAY
        before = sent
        sent = written(_updated(before, _expected(before, blocks, parts, totals, prior), links, step, topics))
        totals, logs, n = _sums(sent, topics)
        prior = _moved(prior, logs, n, step) if n else prior
        forget(before)
    for done in (drafts, words, known, links):
        forget(done)
    return TopicModel(vocabulary, documents, blocks, sent, totals, prior)


def topic_terms(result: TopicModel, words: int = TOP_WORDS) -> DataFrame:
    """Most probable words per topic. The model has at most topics × words such rows."""
    totals = result.totals

    def top(weights: pa.Table, vocabulary: pa.Table) -> pa.Table:
        own = _matrices(weights, len(totals))[0] / totals
        table = vocabulary.sort_by("place")
        # The places are the words' own order, by which a stable sort breaks ties.
        first = np.argsort(-own, axis=0, kind="stable")[:words]
        topic = np.tile(np.arange(len(totals), dtype="i4"), len(first))
        columns = [topic, table["token"].take(pa.array(first.ravel())), own[first.ravel(), topic]]
        return pa.Table.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], ["topic", "term", "weight"])

    own = result.weights.where("block = -1 AND shard >= 0").groupBy("shard")
    picked = own.cogroup(result.vocabulary.groupBy("shard")).applyInArrow(top, "topic int, term string, weight double")
    # A shard gives each topic a few words only.
    rank = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("weight"), "term"))
    return picked.withColumn("rank", rank).where(F.col("rank") <= words).select("topic", "rank", "term", "weight")


def dominant_topics(result: TopicModel) -> DataFrame:
    """Documents with their most probable topic."""
    totals, prior = result.totals, result.concentration

    def infer(sent: pa.Table, blocks: pa.Table) -> pa.Table:
        block = blocks.to_pylist()[0]
        mixtures = _infer(block, _matrices(sent.sort_by("shard"), len(prior)), totals, prior)
        topic = mixtures.argmax(1).astype("i4")
        return pa.Table.from_arrays([pa.array(np.frombuffer(block["docs"], "i8")), pa.array(topic)], ["_doc", "topic"])

    sent = result.weights.where("block >= 0").groupBy("block")
    found = sent.cogroup(result.blocks.groupBy("block")).applyInArrow(infer, "_doc long, topic int")
    return result.documents.join(found, "_doc").drop("_doc", "tokens")


def topic_histogram(result: TopicModel) -> DataFrame:
    return dominant_topics(result).groupBy("topic").agg(F.count("*").alias("n"))
