"""Exact removal of repeated substrings by refining buckets of q-grams."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mandiscope.llm.common import whole_text
from mandiscope.session import written

#: Bytes of a repeated string.
LENGTH = 50
#: Bytes of the q-grams that make the first buckets, and the number of them in a string.
GRAM = 24
SPAN = LENGTH - GRAM + 1
#: Text of a batch, and window starts handled at once; both bound the memory of a task.
BATCH_BYTES = 4 << 20
#: Text whose entries one part sorts.
PART_BYTES = 128 << 20
CHUNK = 1 << 18
#: Order of documents without an id: after all others.
LAST = np.iinfo(np.int64).max

_FACTOR = 0x9E3779B97F4A7C15 | 1
_TABLES: dict[str, np.ndarray] = {}


def _powers(base: int) -> np.ndarray:
    powers = np.full(CHUNK + LENGTH + 1, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def _tables() -> dict[str, np.ndarray]:
    if not _TABLES:
        values = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
        _TABLES.update(value=values, up=_powers(_FACTOR), down=_powers(pow(_FACTOR, -1, 1 << 64)))
    return _TABLES


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


class Places(NamedTuple):
    """Runs of neighbouring strings that share their least q-gram: bucket of the q-gram, identity of the text of the run,
    and the first and last start of its strings."""

    bucket: np.ndarray
    text: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of all q-grams, and prefix sums from which any substring gets its own."""
    t = _tables()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(t["value"][data] * t["up"][: len(data)], dtype=np.uint64, out=sums[1:])
    return _mix((sums[GRAM:] - sums[:-GRAM]) * t["down"][: len(data) - GRAM + 1]), sums


def places(data: np.ndarray) -> Places:
    """The runs of all strings of a document. Long documents are read in chunks, which only shortens runs at the seams."""
    found = []
    for begin in range(0, max(0, len(data) - LENGTH + 1), CHUNK):
        part = data[begin : begin + CHUNK + LENGTH - 1]
        grams, sums = _grams(part)
        at = np.arange(len(grams), dtype=np.uint64)
        low = np.uint64((1 << 20) - 1)
        least = (grams & ~low) | at
        width = 1
        while width < SPAN:
            step = min(width, SPAN - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        place = (least & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.append(first[1:], len(place)) - 1
        end = last + LENGTH
        whole = (sums[end] - sums[first]) * _tables()["down"][first] + (end - first).astype(np.uint64)
        found.append(Places(grams[place[first]], _mix(whole), first + begin, last + begin))
    if not found:
        none = np.zeros(0, np.uint64)
        return Places(none, none, none.astype(np.int64), none.astype(np.int64))
    return Places(*map(np.concatenate, zip(*found)))


def _strings(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the strings of the given runs with their identities of 64 and 32 bits.

    A string is refined from its bucket by the buckets at later offsets: q-grams at 0 and ``GRAM`` make an identifier of
    twice the length, which with the last q-gram covers the string. The second identity puts them together otherwise.
    """
    starts = np.concatenate([np.zeros(0, np.int64), *map(np.arange, first, last + 1)]).astype(np.int64)
    ids, more = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    for begin in range(0, max(0, len(data) - LENGTH + 1), CHUNK):
        inside = np.flatnonzero((starts >= begin) & (starts < begin + CHUNK))
        if len(inside):
            grams, _ = _grams(data[begin : begin + CHUNK + LENGTH - 1])
            s = starts[inside] - begin
            double = _mix(grams[s] * np.uint64(3) + grams[s + GRAM])
            ids[inside] = _mix(double * np.uint64(5) + grams[s + LENGTH - GRAM])
            more[inside] = _mix(_mix(grams[s + LENGTH - GRAM] * np.uint64(7) + grams[s]) + grams[s + GRAM] * np.uint64(9)) >> np.uint64(32)
    return starts, ids, more


class Entries(NamedTuple):
    """Distinct (part, identities) of a batch with the document of least id that has them, by part and document.

    For each original row ``number`` is its entry and ``later`` whether its document comes after that of the entry, so that
    the row repeats it whatever other batches hold.
    """

    part: np.ndarray
    doc: np.ndarray
    ids: tuple[np.ndarray, ...]
    number: np.ndarray
    later: np.ndarray


def _entries(doc: np.ndarray, id_of: np.ndarray, spread: np.ndarray, ids: tuple[np.ndarray, ...], parts: int) -> Entries:
    """Rows come by document and documents by id. The last identity has 64 bits, and equal ones are sorted together;
    where others differ beside it, more entries than needed are sent."""
    part = (spread >> np.uint64(24)).astype(np.int64) % parts
    own = id_of[doc]
    keys = (*ids, part)
    order = np.argsort(ids[-1], kind="stable")
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    least = order[new]
    sent = np.argsort(part[least] * len(id_of) + doc[least], kind="stable")
    place = np.empty(len(sent), np.int64)
    place[sent] = np.arange(len(sent))
    kept = least[sent]
    return Entries(part[kept], doc[kept], tuple(i[kept] for i in ids), place[group], own > own[least][group])


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _pack(array: np.ndarray, kind: str) -> bytes:
    return _squeeze(np.ascontiguousarray(array, kind).tobytes())


def _unpack(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


class Batch:
    """Documents of a batch with their runs."""

    def __init__(self, ids: bytes, sizes: bytes, body: bytes, parts: int):
        self.ids = _unpack(ids, "<i8")
        self.parts = parts
        told = _unpack(sizes, "<i8")
        # The size of a document without an id is told by its complement.
        self.nameless = told < 0
        ends = np.cumsum(np.where(self.nameless, ~told, told))
        data = _unpack(body, "u1")
        begins = ends - np.diff(ends, prepend=0)
        order = np.argsort(self.ids, kind="stable")
        self.ids, self.nameless = self.ids[order], self.nameless[order]
        self.docs = [data[begins[k] : ends[k]] for k in order]
        own = [places(d) for d in self.docs]
        self.runs = Places(*map(np.concatenate, zip(*own)))
        self.doc = np.repeat(np.arange(len(own)), [len(p.first) for p in own])
        self.entries = _entries(self.doc, self.ids, self.runs.bucket, (self.runs.bucket & np.uint64(0xFFFFFFFF), self.runs.text), parts)

    def told(self, entries: Entries, kinds: list[Callable[[np.ndarray], bytes]]) -> Iterator[tuple]:
        """(part, ids of documents, entries of each, packed identities) for each part with entries."""
        cut = np.flatnonzero(np.diff(entries.part, prepend=-1))
        for begin, end in zip(cut, np.append(cut[1:], len(entries.part))):
            docs, counts = np.unique(entries.doc[begin:end], return_counts=True)
            packed = [pack(i[begin:end]) for i, pack in zip(entries.ids, kinds)]
            yield int(entries.part[begin]), _pack(self.ids[docs], "<i8"), _pack(counts, "<i4"), *packed

    def answers(self, entries: Entries, parts: list[int], answers: list[bytes]) -> np.ndarray:
        """The answer for every original row, from the answers of the parts."""
        states = np.zeros(len(entries.part), np.uint8)
        for part, answer in zip(parts, answers):
            begin, end = np.searchsorted(entries.part, [part, part + 1])
            states[begin:end] = _unpack(answer, "u1")
        return np.where(entries.later, 1, states[entries.number])

    def contested(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray, Entries]:
        """Document, start and entry of each string of the runs in contested buckets."""
        doc, start, ids, more = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        open_runs = np.flatnonzero(states == 2)
        cuts = np.searchsorted(self.doc[open_runs], np.arange(len(self.docs) + 1))
        for k in np.flatnonzero(np.diff(cuts)):
            own = open_runs[cuts[k] : cuts[k + 1]]
            s, i, m = _strings(self.docs[k], self.runs.first[own], self.runs.last[own])
            doc.append(np.full(len(s), k))
            start.append(s)
            ids.append(i)
            more.append(m)
        at, every = np.concatenate(doc), np.concatenate(ids)
        return at, np.concatenate(start), _entries(at, self.ids, every, (np.concatenate(more), every), self.parts)


def _raw(kind: str) -> Callable[[np.ndarray], bytes]:
    return lambda x: np.ascontiguousarray(x, kind).tobytes()


def _batches(docs: DataFrame) -> DataFrame:
    """Documents in compressed batches: ``batch`` (hash of the content), ``ids``, ``sizes``, ``body``."""

    def pack(ids: list[int], sizes: list[int], texts: list[bytes]) -> pd.DataFrame:
        blobs = [_pack(np.array(ids), "<i8"), _pack(np.array(sizes), "<i8"), _squeeze(b"".join(texts))]
        name = int.from_bytes(hashlib.blake2b(b"".join(blobs), digest_size=8).digest(), "little", signed=True)
        return pd.DataFrame([[name, *blobs]], columns=["batch", "ids", "sizes", "body"])

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, sizes, texts, size = [], [], [], 0
        for frame in frames:
            for i, nameless, text in zip(frame["at"], frame["nameless"], frame["text"]):
                ids.append(i)
                texts.append(text.encode("utf-8", "surrogatepass"))
                sizes.append(~len(texts[-1]) if nameless else len(texts[-1]))
                size += len(texts[-1])
                if size >= BATCH_BYTES:
                    yield pack(ids, sizes, texts)
                    ids, sizes, texts, size = [], [], [], 0
        if ids:
            yield pack(ids, sizes, texts)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(int(LAST))).alias("at"), F.col("doc_id").isNull().alias("nameless"), whole_text().alias("text"))
    return rows.mapInPandas(gather, "batch long, ids binary, sizes binary, body binary")


def _owners(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Id of the document of every entry of a part, and where each blob ends."""
    owners = [np.repeat(_unpack(i, "<i8"), _unpack(c, "<i4")) for i, c in zip(group["ids"], group["counts"])]
    return np.concatenate(owners), np.cumsum([len(o) for o in owners])


def _answered(group: pd.DataFrame, states: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
    out = group[["batch", "part"]].copy()
    out["answer"] = [_pack(s, "u1") if s.any() else None for s in np.split(states, ends[:-1])]
    return out[out["answer"].notna()]


def _refine_runs(group: pd.DataFrame) -> pd.DataFrame:
    """Sort a part by bucket and text of the run. 1: a smaller document has the same run; 2: it has the first of this
    run, and its bucket holds other runs of other documents, so their strings have to be compared."""
    owner, ends = _owners(group)
    bucket = np.concatenate([np.frombuffer(b, "<u4") for b in group["bucket"]])
    text = np.concatenate([np.frombuffer(b, "<u8") for b in group["text"]])
    order = np.lexsort((owner, text, bucket))
    b, t, o = bucket[order], text[order], owner[order]
    new_bucket = np.concatenate(([True], b[1:] != b[:-1]))
    new_run = new_bucket | np.concatenate(([True], t[1:] != t[:-1]))
    bucket_at, run_at = np.flatnonzero(new_bucket), np.flatnonzero(new_run)
    of_bucket, of_run = np.cumsum(new_bucket) - 1, np.cumsum(new_run) - 1
    several = (np.minimum.reduceat(o, bucket_at) != np.maximum.reduceat(o, bucket_at)) & (np.add.reduceat(new_run.astype(np.int64), bucket_at) > 1)
    states = np.empty(len(o), np.uint8)
    states[order] = np.where(o > o[run_at][of_run], 1, np.where(several[of_bucket], 2, 0))
    return _answered(group, states, ends)


def _refine_strings(group: pd.DataFrame) -> pd.DataFrame:
    """Sort a part by string. 1: a smaller document has the same string."""
    owner, ends = _owners(group)
    string = np.concatenate([np.frombuffer(b, "<u8") for b in group["string"]])
    more = np.concatenate([np.frombuffer(b, "<u4") for b in group["more"]])
    order = np.lexsort((owner, more, string))
    s, m, o = string[order], more[order], owner[order]
    new = np.concatenate(([True], (s[1:] != s[:-1]) | (m[1:] != m[:-1])))
    states = np.empty(len(o), np.uint8)
    states[order] = o > o[np.flatnonzero(new)][np.cumsum(new) - 1]
    return _answered(group, states, ends)


def _cover(size: int, spans: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    edge = np.zeros(size + 1, np.int64)
    for begin, end in spans:
        np.add.at(edge, begin, 1)
        np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes that are left.

    Each byte of the UTF-8 text covered by a string of 50 bytes that also starts in a document of smaller id is removed.
    Neighbouring strings that share their least q-gram form a run. Runs are bucketed by that q-gram and sorted by their
    text: where a smaller document has the same run, all its strings are repeated. Only buckets with different runs of
    different documents are refined further, string by string. A repeated string has the same least q-gram wherever it
    occurs, so none is missed.

    Null and empty texts and texts under 50 bytes lose nothing. Rows of equal id are one document and never shorten each
    other; rows without an id come after all others, as one document with those whose id is the largest there is. An empty
    table gives no rows. Other columns are ignored.

    Of each batch only the least document of every run or string is sent, as the batch's others repeat it. A part holds
    what ``PART_BYTES`` of text send, so its memory does not grow with the table. Equality is by hashes: 96 bits for runs, of which
    64 tell runs around the same q-gram apart, and 96 bits for strings.
    """
    batches = written(_batches(docs))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-batches.count() * BATCH_BYTES // PART_BYTES))

    def runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds = [_raw("<u4"), _raw("<u8")]
        for frame in frames:
            for r in frame.itertuples():
                batch = Batch(r.ids, r.sizes, r.body, parts)
                rows = [(r.batch, *row) for row in batch.told(batch.entries, kinds)]
                yield pd.DataFrame(rows, columns=["batch", "part", "ids", "counts", "bucket", "text"])

    answer = "batch long, part int, answer binary"
    told = batches.mapInPandas(runs, "batch long, part int, ids binary, counts binary, bucket binary, text binary")
    by_run = written(told.groupBy("part").applyInPandas(_refine_runs, answer))

    def joined(name: str, answers: DataFrame) -> DataFrame:
        return answers.groupBy("batch").agg(F.collect_list(F.struct("part", "answer")).alias(name))

    def listed(cell) -> tuple[list[int], list[bytes]]:
        return ([], []) if cell is None else ([a["part"] for a in cell], [bytes(a["answer"]) for a in cell])

    def strings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                batch = Batch(r.ids, r.sizes, r.body, parts)
                _, _, entries = batch.contested(batch.answers(batch.entries, *listed(r.runs)))
                rows = [(r.batch, *row) for row in batch.told(entries, [_raw("<u4"), _raw("<u8")])]
                yield pd.DataFrame(rows, columns=["batch", "part", "ids", "counts", "more", "string"])

    told = batches.join(joined("runs", by_run), "batch").mapInPandas(strings, "batch long, part int, ids binary, counts binary, more binary, string binary")
    by_string = written(told.groupBy("part").applyInPandas(_refine_strings, answer))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                batch = Batch(r.ids, r.sizes, r.body, parts)
                states = batch.answers(batch.entries, *listed(r.runs))
                doc, start, entries = batch.contested(states)
                repeated = batch.answers(entries, *listed(r.strings)) == 1
                order = np.argsort(batch.doc, kind="stable")
                rows = []
                lines = np.searchsorted(batch.doc[order], np.arange(len(batch.docs) + 1))
                singles = np.searchsorted(doc, np.arange(len(batch.docs) + 1))
                for k, data in enumerate(batch.docs):
                    own = order[lines[k] : lines[k + 1]]
                    own = own[states[own] == 1]
                    at = start[singles[k] : singles[k + 1]][repeated[singles[k] : singles[k + 1]]]
                    gone = _cover(len(data), [(batch.runs.first[own], batch.runs.last[own] + LENGTH), (at, at + LENGTH)])
                    spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                    rows.append((None if batch.nameless[k] else int(batch.ids[k]), len(data), int(gone.sum()), spans, data[~gone].tobytes()))
                out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
                # Not from the column, which holds ids as floats where one of them is missing.
                out["doc_id"] = pd.array([row[0] for row in rows], "Int64")
                yield out

    every = batches.join(joined("runs", by_run), "batch", "left").join(joined("strings", by_string), "batch", "left")
    return every.mapInPandas(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


#: The same by brute force: every string of 50 bytes with the least id it starts in.
REPEATS_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), w AS (
  SELECT r, doc_id, unnest(range(0, len(x) // 2 - 49)) AS s, x FROM d WHERE len(x) >= 100
), k AS (SELECT r, doc_id, s, md5_number(x[2 * s + 1 : 2 * s + 100]) AS body FROM w
), f AS (SELECT body, min(doc_id) AS least FROM k GROUP BY body
), g AS (
  SELECT r, s, lag(s) OVER (PARTITION BY r ORDER BY s) AS before FROM k JOIN f USING (body) WHERE least < doc_id
), i AS (
  SELECT r, s, sum(CASE WHEN before IS NULL OR s > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY s) AS span FROM g
), p AS (SELECT r, span, min(s) AS b, max(s) + 50 AS e FROM i GROUP BY r, span
), q AS (SELECT r, b, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY b), 0) AS kept_from FROM p
), o AS (
  SELECT r, count(*) AS n_spans, sum(e - b) AS n_removed, max(e) AS tail, list({'a': kept_from, 'b': b} ORDER BY b) AS pieces FROM q GROUP BY r
)
SELECT doc_id, len(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(array_to_string(list_transform(pieces, lambda v: x[2 * v.a + 1 : 2 * v.b]), ''), '') || x[2 * coalesce(tail, 0) + 1 :])) AS kept_sha256
FROM d LEFT JOIN o USING (r)
"""
