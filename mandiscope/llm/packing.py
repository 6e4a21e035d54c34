"""Pack tokenized documents into sequences of fixed length by bin completion."""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mandiscope.llm.common import bounded, whole_text
from mandiscope.session import written

#: Tokens of a sequence.
CAPACITY = 2048
#: Entries of a worker's memory of encoded chunks; it starts anew when full.
REMEMBERED = 400_000
#: Work of the search: lengths looked at and steps of fillings walked, over all; the best packing found so far is kept.
SEARCH = 4_000_000
#: The least number of bins for what a branch leaves is only worked out for so many lengths; waste bounds all branches.
BOUNDED = 200
#: In fillings of more documents, only pairs are looked at for an exchange against one document.
SUBSETS = 8

_WORKER: dict = {}


class Chunks(dict):
    """Token ids (little-endian bytes) of a space and the text up to the next space."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[chunk] = np.asarray(self.encode(" " + chunk), "<u4").tobytes()
        return ids


class Encoder:
    """Ids of a text as the tokenizer in ``vocabulary`` gives them, as little-endian bytes.

    The tokenizer's pattern never joins text across a single space, so a text is encoded chunk by chunk and chunks
    are remembered. ``ranks`` is the same vocabulary in the form of merge ranks; it encodes chunks not seen yet, and
    gives the same ids. Texts with two spaces in a row or with a special token go to the tokenizer whole.
    """

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None):
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        encode = self._whole
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
        self.first = encode
        self.chunks = Chunks(encode)

    def _whole(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> bytes:
        if "  " in text or any(s in text for s in self.special) or not text.isascii() and re.search("[\ud800-\udfff]", text):
            return np.asarray(self._whole(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        head = np.asarray(self.first(first), "<u4").tobytes() if first else b""
        return head + b"".join(map(self.chunks.__getitem__, rest))


def public_files() -> dict[str, str | None]:
    """Where the public vocabulary lies on this machine; every executor has it."""
    import public_tokenizers

    path = public_tokenizers.path
    return {"vocabulary": path("byte_bpe_50k.json"), "ranks": path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def encoder(files: dict | None) -> Encoder:
    """The encoder of this Python worker; what it remembers serves all tasks of the worker."""
    made = files or public_files()
    at = tuple(made.values())
    if at not in _WORKER:
        _WORKER[at] = Encoder(**made)
    return _WORKER[at]


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, files: dict | None = None) -> DataFrame:
    """Per piece of a document ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document is its tokens and then id 0; only documents longer than ``capacity`` are cut, and only the first
    piece of one may be shorter. Null and empty texts are the id 0 alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(files), bytes(4)
        for batch in batches:
            rows = []
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = encode(text) + end
                total, begin, piece = len(ids) // 4, 0, 0
                stop = total % capacity or capacity
                while begin < total:
                    rows.append((row, piece, begin, stop - begin, zlib.crc32(ids[4 * begin : 4 * stop])))
                    begin, stop, piece = stop, stop + capacity, piece + 1
            row, piece, *rest = zip(*rows) if rows else [()] * 5
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in rest]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", whole_text().alias("text"))
    return narrow.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def _most_bins(counts: dict[int, int], capacity: int) -> int:
    """Bins that ``counts`` need at least: for each length t, documents over ``capacity - t`` stand alone, those over
    half of it can't share a bin, and what these leave open is all that is left for documents from t on."""
    lengths = sorted(counts)
    total = sum(n * k for n, k in counts.items())
    best = -(-total // capacity)
    sums, numbers = [0], [0]
    for n in lengths:
        sums.append(sums[-1] + n * counts[n])
        numbers.append(numbers[-1] + counts[n])
    half = bisect_right(lengths, capacity // 2)
    wide, wide_sum = numbers[-1] - numbers[half], sums[-1] - sums[half]
    for at in range(half):
        over = bisect_right(lengths, capacity - lengths[at])
        alone, alone_sum = numbers[-1] - numbers[over], sums[-1] - sums[over]
        room = (wide - alone) * capacity - (wide_sum - alone_sum)
        best = max(best, wide + max(0, -(-(sums[half] - sums[at] - room) // capacity)))
    return max(best, wide)


def _fillings(room: int, waste: int, left: dict[int, int]) -> Iterator[tuple[int, tuple[int, ...] | None]]:
    """All undominated (waste, filling) of ``room`` from ``left`` with at most ``waste``, those of least waste first.

    Between them, (steps, None) tells the work done.

    A filling is dominated if one or more of its documents can be exchanged for a single longer one, or several for one
    as long, or if one more fits. Which sums the lengths from each on can give is kept as the bits of a number, so
    only fillings that end within the waste are walked. Among equal waste, those of long documents come first, which
    keeps the short ones for later.
    """
    lengths = [n for n in sorted(left, reverse=True) if n <= room]
    full = (1 << room + 1) - 1
    sums = [1]
    for n in reversed(lengths):
        reach, many, step = sums[-1], left[n], 1
        while many > 0 and step * n <= room:
            used = min(step, many)
            reach |= reach << used * n & full
            many -= used
            step *= 2
        sums.append(reach)
    sums.reverse()
    ascending = lengths[::-1]

    def dominated(taken: tuple[int, ...], spare: int) -> bool:
        own = Counter(taken)

        def free(low: int, high: int) -> bool:
            at = bisect_left(ascending, low)
            while at < len(ascending) and ascending[at] <= high:
                if left[ascending[at]] > own[ascending[at]]:
                    return True
                at += 1
            return False

        if free(1, spare) or any(free(n + 1, n + spare) for n in own):
            return True
        if len(taken) > SUBSETS:
            return any(free(sum(p), sum(p) + spare) for p in set(combinations(taken, 2)))
        return any(free(sum(p), sum(p) + spare) for size in range(2, len(taken) + 1) for p in set(combinations(taken, size)))

    steps = len(lengths)
    for spare in range(min(waste, room) + 1):
        goal = room - spare
        if not sums[0] >> goal & 1:
            continue
        stack = [(goal, 0, ())]
        while stack:
            steps += 1
            if steps >= 1000:
                yield steps, None
                steps = 0
            open_, at, taken = stack.pop()
            if not open_:
                steps += 2 ** min(len(taken), SUBSETS)
                if not dominated(taken, spare):
                    yield steps, None
                    steps = 0
                    yield spare, taken
                continue
            if at == len(lengths) or not sums[at] >> open_ & 1:
                continue
            n = lengths[at]
            for many in range(min(left[n], open_ // n) + 1):
                if sums[at + 1] >> open_ - many * n & 1:
                    stack.append((open_ - many * n, at + 1, taken + (n,) * many))


def complete_bins(counts: dict[int, int], capacity: int = CAPACITY, search: int = SEARCH) -> list[tuple[tuple[int, ...], int]]:
    """Sequences for ``counts`` documents of each length, as (lengths in one sequence, number of such sequences).

    Branch and bound: at every depth all undominated fillings around the largest length left are tried in turn, those
    of least waste first, each as often as the counts allow and then once. A branch ends when its waste, or the least
    number of bins for what it leaves, shows that it can't beat the incumbent, which best fit gives first, or when
    the same documents were left before. Without the budget the result is the least number of sequences.

    The budget is ``search`` steps, each a length looked at or a partial filling walked (4 000 000 take some seconds). When
    it is spent, the best packing found so far is returned; it is never worse than best fit. Documents of
    equal length are alike, so the work depends on the number of lengths, ``capacity`` at most, and not on the number of
    documents. What was left before is remembered by a 64-bit hash, of which a clash could only hide a better packing.
    """
    left = {n: k for n, k in counts.items() if k}
    total = sum(n * k for n, k in left.items())
    best = _best_fit(left, capacity)
    fewest, bound = sum(k for _, k in best), _most_bins(left, capacity)
    plan: list[tuple[tuple[int, ...], int]] = []
    used = waste = spent = 0
    seen: dict[int, int] = {}

    def options() -> Iterator[tuple[tuple[int, ...], int, int]]:
        nonlocal spent
        largest = max(left)
        rest = {n: k - (n == largest) for n, k in left.items() if k > (n == largest)}
        slack = (fewest - 1) * capacity - total - waste
        singles = []
        for spare, others in _fillings(capacity - largest, slack, rest):
            if others is None:
                spent += spare
                if spent >= search:
                    return
                continue
            own = Counter((largest, *others))
            most = min(left[n] // k for n, k in own.items())
            filling = (largest, *others)
            if spare * most > slack:
                most = slack // spare
            yield filling, most, spare
            if most > 1:
                singles.append((filling, 1, spare))
        yield from singles

    def put(filling: tuple[int, ...], times: int) -> None:
        for n in filling:
            left[n] = left.get(n, 0) + times
            if not left[n]:
                del left[n]

    stack = [options()] if left and fewest > bound else []
    while stack and fewest > bound and spent < search:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if plan:
                filling, times = plan.pop()
                put(filling, times)
                used -= times
                waste -= (capacity - sum(filling)) * times
            continue
        filling, times, spare = step
        spent += 1 + len(left)
        if waste + spare * times > (fewest - 1) * capacity - total:
            continue
        put(filling, -times)
        plan.append((filling, times))
        used += times
        waste += spare * times
        ahead = iter(())
        if not left:
            if used < fewest:
                best, fewest = list(plan), used
        else:
            state = hash(frozenset(left.items()))
            if seen.get(state, used + 1) > used:
                seen[state] = used
                if len(left) > BOUNDED or used + _most_bins(left, capacity) < fewest:
                    ahead = options()
        stack.append(ahead)
    return best


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit over descending lengths; bins of equal content are kept as one with their number."""
    open_bins: dict[int, dict[tuple[int, ...], int]] = {}
    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            space = min((s for s in open_bins if s >= length), default=None)
            if space is None:
                fits = capacity // length
                full, rest = divmod(todo, fits)
                for many, times in ((fits, full), (rest, 1)):
                    if many and times:
                        bins = open_bins.setdefault(capacity - many * length, {})
                        bins[(length,) * many] = bins.get((length,) * many, 0) + times
                break
            content, have = next(iter(open_bins[space].items()))
            used = min(have, todo)
            if used == have:
                del open_bins[space][content]
                if not open_bins[space]:
                    del open_bins[space]
            else:
                open_bins[space][content] = have - used
            bins = open_bins.setdefault(space - length, {})
            bins[(*content, length)] = bins.get((*content, length), 0) + used
            todo -= used
    return [(content, k) for bins in open_bins.values() for content, k in bins.items()]


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int, int]]:
    """Where the documents of each length go: (length, first rank, last rank, per sequence, first sequence, offset)."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for filling, times in plan:
        offset = 0
        for length in sorted(set(filling), reverse=True):
            many = filling.count(length)
            begin = ranks.get(length, 0)
            ranks[length] = begin + many * times
            rows.append((length, begin, ranks[length] - 1, many, sequence, offset))
            offset += many * length
        sequence += times
    return rows


def pack(docs: DataFrame, capacity: int = CAPACITY, files: dict | None = None) -> DataFrame:
    """``token_pieces`` of ``docs`` with ``sequence_id`` and ``offset``: each sequence is filled without gaps from 0.

    Only the number of pieces of each length (``capacity`` numbers at most) goes to the driver, which plans by bin
    completion. Every piece then finds its place from its rank among the pieces of its length. Ranks are counted in
    parts of a length, so one length may hold any share of the pieces. Rows that repeat an id are documents of their
    own, as are rows without an id. An empty table gives no rows. Columns but ``doc_id`` and ``text`` are ignored.
    """
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, capacity, files))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int")
    pieces = pieces.withColumn("part", part)
    sizes = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    sizes = written(sizes)
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = _slots(complete_bins(counts, capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(order) - 1).join(starts, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    slots = spark.createDataFrame(plan, "length long, low long, high long, many long, first long, at long")
    by_length = slots.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("low", "high", "many", "first", "at"))).alias("slots"))
    placed = ranked.join(bounded(by_length), "length").withColumn(
        "slot", F.get(F.filter("slots", lambda s: (F.col("rank") >= s["low"]) & (F.col("rank") <= s["high"])), F.lit(0))
    )
    within = F.col("rank") - F.col("slot.low")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("slot.first") + F.floor(within / F.col("slot.many"))).cast("long").alias("sequence_id"),
        (F.col("slot.at") + F.pmod(within, F.col("slot.many")) * F.col("length")).cast("long").alias("offset"),
    )
