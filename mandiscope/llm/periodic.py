"""Find periodic runs of words by internal pattern matching, and keep one period of each."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mandiscope.llm.common import whole_text

#: A run has at least so many periods and so many words. Block sizes rely on four periods or more.
EXPONENT, LEAST = 4, 6
#: Documents are indexed together up to so many words; a longer document is indexed alone.
WORDS = 200_000

RUNS = "array<struct<start:long,length:long,period:long>>"

PERIODIC_SQL = r"""
WITH crcs AS (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t
), texts AS (
    SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        xor(list_reduce(
            list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: unicode(c)::BIGINT),
            lambda crc, b: xor(t[1 + (xor(crc, b) & 255)], crc >> 8), 4294967295::BIGINT), 4294967295) AS h
    FROM documents, crcs
), planned AS (
    SELECT *, len(words) AS n, (h // 10) % greatest(len(words), 1) AS a FROM texts
), planted AS (
    SELECT k, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END])
        ELSE words END AS words
    FROM planned
), placed AS (
    SELECT k, unnest(words) AS word, unnest(range(n)) AS i FROM planted WHERE n > 0
), equal AS (
    SELECT x.k, x.i, y.i - x.i AS q FROM placed x JOIN placed y ON x.k = y.k AND x.word = y.word AND y.i > x.i
), stretches AS (
    SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS line FROM equal
), periods AS (
    SELECT k, q, min(i) AS start, count(*) + q AS length FROM stretches GROUP BY k, q, line
    HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
    SELECT k, start, length, min(q) AS period FROM periods GROUP BY k, start, length
), dropped AS (
    SELECT DISTINCT k, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
    SELECT k, string_agg(word, ' ' ORDER BY i) AS text FROM placed ANTI JOIN dropped USING (k, i) GROUP BY k
), found AS (
    SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
    FROM runs GROUP BY k
), best AS (
    SELECT DISTINCT ON (k) k, start, length, period FROM runs r
    WHERE NOT EXISTS (SELECT 1 FROM runs s WHERE s.k = r.k AND s.length * r.period > r.length * s.period)
    ORDER BY k, start, period
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
    (1000 * length // period)::BIGINT AS exponent_milli,
    sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM planted LEFT JOIN found USING (k) LEFT JOIN best USING (k) LEFT JOIN kept USING (k)
"""


class SuffixArray:
    """Suffix array of the words of several documents, with the rank of every block of 1, 2, 4 ... words.

    ``words`` are numbers, ``bounds`` where documents begin and end. Suffixes are ordered by document first, so a block
    only ever meets blocks of its own document. Doubling sorts again only what is not yet told apart; ``ranks[k]`` is
    the first slot of all suffixes that share their first ``2 ** k`` words, which is where they lie in the end as well.
    A block that reaches beyond its document differs from all others.
    """

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        n = len(words)
        document = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.begin, self.end = bounds[document], bounds[document + 1]
        key = document * (int(words.max(initial=0)) + 1) + words
        self.slots = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[self.slots] = _first_of(key[self.slots])
        self.ranks, size = [rank.astype(np.int32)], 1
        while True:
            many = np.bincount(rank, minlength=n)[rank[self.slots]]
            open_slots = np.flatnonzero(many > 1)
            if not len(open_slots):
                return
            at = self.slots[open_slots]
            after = at + size
            inside = after < self.end[at]
            # Beyond its document every suffix is of its own: the shorter, the smaller.
            then = np.where(inside, rank[np.minimum(after, n - 1)] + n, self.end[at] - at)
            key = rank[at] * (2 * n + 1) + then
            order = np.argsort(key, kind="stable")
            self.slots[open_slots] = at[order]
            rank = rank.copy()
            rank[at[order]] = open_slots[_first_of(key[order])]
            self.ranks.append(rank.astype(np.int32))
            size *= 2

    def agree(self, a: np.ndarray, b: np.ndarray, backward: bool = False) -> np.ndarray:
        """How many words from ``a`` and ``b`` on, or before them, are the same; ``a`` lies before ``b`` in one document."""
        a, b, most = a.copy(), b.copy(), len(self.slots)
        begin, end = self.begin[np.minimum(a, most - 1)], self.end[np.minimum(a, most - 1)]
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            size, rank = 1 << k, self.ranks[k]
            x, y = (a - size, b - size) if backward else (a, b)
            fits = (x >= begin) & (y + size <= end)
            same = fits & (rank[np.where(fits, x, 0)] == rank[np.where(fits, y, 0)])
            step = np.where(same, size, 0)
            total += step
            a, b = (a - step, b - step) if backward else (a + step, b + step)
        return total


def _first_of(ordered: np.ndarray) -> np.ndarray:
    """For each element of a sorted array the index of the first one equal to it."""
    fresh = np.ones(len(ordered), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    return np.maximum.accumulate(np.where(fresh, np.arange(len(ordered)), 0))


class WaveletTree:
    """Order statistics of ranges of an array of numbers below ``2 ** bits``, for many ranges at once."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values in slots ``low`` to ``high`` (exclusive) are less than ``value``."""
        count = np.zeros(len(low), np.int64)
        for bit, zeros, split in self.levels:
            left, right = zeros[low], zeros[high]
            one = (value >> bit & 1).astype(bool)
            count += np.where(one, right - left, 0)
            low, high = np.where(one, split + low - left, left), np.where(one, split + high - right, right)
        return count

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The value of rank ``n`` from 0 among those in slots ``low`` to ``high``, which hold more than ``n``."""
        value, n = np.zeros(len(low), np.int64), n.copy()
        for bit, zeros, split in self.levels:
            left, right = zeros[low], zeros[high]
            one = n >= right - left
            n -= np.where(one, right - left, 0)
            value |= one.astype(np.int64) << bit
            low, high = np.where(one, split + low - left, left), np.where(one, split + high - right, right)
        return value


def find_runs(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs of several documents, by start and period; places count from the first word of all.

    A run of period q with at least four periods holds an aligned block of m words, m the power of two with q < m <= 2 q,
    and q more words before or after it. As the block is longer than q, its occurrences within the run form a progression
    of difference q, so its nearest occurrence in the window before or after is q away. Blocks that occur once are
    left out; for the others the wavelet tree over the suffix array finds the predecessor and the successor of the
    block's place in its range. Each difference in m/2 to m - 1 is a candidate period, which ``agree`` extends both ways.
    """
    if len(words) < LEAST:
        return np.zeros((0, 3), np.int64)
    index = SuffixArray(words, bounds)
    local = (index.slots - index.begin[index.slots]).astype(np.int64)
    tree, candidates = None, []
    for k in range(1, len(index.ranks)):
        m, rank = 1 << k, index.ranks[k]
        counts = np.bincount(rank, minlength=len(rank))
        place = np.arange(len(rank)) - index.begin
        block = np.flatnonzero((place % m == 0) & (np.arange(len(rank)) + m <= index.end) & (counts[rank] > 1))
        if not len(block):
            continue
        if tree is None:
            tree = WaveletTree(local, int(np.diff(bounds).max()).bit_length())
        low = rank[block].astype(np.int64)
        high, at = low + counts[low], block - index.begin[block]
        own = tree.below(low, high, at)
        for step in (-1, 1):
            there = (own + step >= 0) & (own + step < high - low)
            near = tree.nth(low[there], high[there], own[there] + step)
            distance = np.abs(near - at[there])
            good = (2 * distance >= m) & (distance < m)
            first = np.minimum(near, at[there])[good] + index.begin[block[there][good]]
            candidates.append(np.stack([first, distance[good]], 1))
    if not candidates:
        return np.zeros((0, 3), np.int64)
    first, period = np.unique(np.concatenate(candidates), axis=0).T
    start = first - index.agree(first, first + period, backward=True)
    end = first + period + index.agree(first, first + period)
    runs = np.stack([start, end, period], 1)[end - start >= np.maximum(LEAST, EXPONENT * period)]
    runs = runs[np.lexsort(runs.T[::-1])]
    # A stretch may show multiples of its smallest period.
    return runs[_fresh(runs[:, :2])]


def _fresh(rows: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]).any(1)
    return fresh


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Consecutive documents of at most ``WORDS`` words together."""
    begin, held = 0, 0
    for k, size in enumerate(sizes):
        if held and held + size > WORDS:
            yield begin, k
            begin, held = k, 0
        held += size
    yield begin, len(sizes)


def _told(texts: list[list[bytes]]) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs (start, length, period) and the collapsed text of each document."""
    for first, last in _groups([len(t) for t in texts]):
        group, seen = texts[first:last], {}
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in group])])
        numbers = np.fromiter((seen.setdefault(w, len(seen)) for t in group for w in t), np.int64, int(bounds[-1]))
        runs = find_runs(numbers, bounds)
        owner = np.searchsorted(bounds, runs[:, 0], side="right") - 1
        cuts = np.searchsorted(owner, np.arange(len(group) + 1))
        for k, own in enumerate(group):
            mine = runs[cuts[k] : cuts[k + 1]] - [bounds[k], bounds[k], 0]
            if not len(mine):
                yield [], b" ".join(own)
                continue
            gone = np.zeros(len(own) + 1, np.int64)
            np.add.at(gone, mine[:, 0] + mine[:, 2], 1)
            np.add.at(gone, mine[:, 1], -1)
            kept = (np.cumsum(gone)[:-1] == 0).tolist()
            yield [(s, e - s, q) for s, e, q in mine.tolist()], b" ".join(w for w, keep in zip(own, kept) if keep)


def periodic_runs(docs: DataFrame, rewrite: Callable[[list[bytes], int | None], list[bytes]] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``runs``, ``best`` and ``collapsed``.

    Words lie between ASCII white space. A run is a stretch of words with smallest period q and at least
    max(6, 4 q) words that can't be extended; ``runs`` has them by start and period, ``best`` is the one of most
    periods (exact; ties: smallest start, then period) or null. ``collapsed`` (binary, UTF-8) has the words joined by
    one space without those that any run repeats after its first period. ``rewrite`` may change the words of a document
    before the search, given them and the id.

    Each document is looked at by itself within a task; nothing is shuffled. Null, empty and blank texts have no words
    and no runs. Rows may repeat ids or texts and each gives a row; ids may be null. An empty table gives no rows.
    Other columns are ignored. Memory of a task is in proportion to its longest document.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    listed = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.split() for text in batch.column("text").to_pylist()]
            if rewrite:
                texts = [rewrite(words, i) for words, i in zip(texts, batch.column("doc_id").to_pylist())]
            runs, collapsed = [list(x) for x in zip(*_told(texts))] if texts else ([], [])
            named = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
            best = [max(own, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]), default=None) for own in named]
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array([len(t) for t in texts], pa.int64()),
                "runs": pa.array(named, listed),
                "best": pa.array(best, listed.value_type),
                "collapsed": pa.array(collapsed, pa.binary()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    narrow = docs.select("doc_id", whole_text().cast("binary").alias("text"))
    return narrow.mapInArrow(search, f"doc_id {kind}, n_words long, runs {RUNS}, best {RUNS[6:-1]}, collapsed binary")


def runs_text() -> Column:
    """``runs`` as lines of ``start,length,period``."""
    return F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))))


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a repeated stretch planted in one document of ten, from the CRC of its id (null: empty text)."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def periodic_digest(docs: DataFrame) -> DataFrame:
    """The runs of ``docs`` after ``planted``, as digests: one row per row of ``docs``."""
    found = periodic_runs(docs, planted)
    best = [F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *best,
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(runs_text().cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
