"""Group spelling variants: the vocabulary's acceptor composed with a one-edit transducer and with itself."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mandiscope.llm.common import bounded, whole_text
from mandiscope.session import written

#: Words have at least so many code points and occurrences.
LENGTH, OCCURRENCES = 7, 2
#: A word is a variant of a near word that occurs so many times as often.
RATIO = 10
#: Initial states with more words than this are divided further, down to one edited place.
GROUP = 1000
#: Places of an initial state at most, which bounds the depth of its acceptor for words of any length.
WIDE = 64

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[a-zÀ-ÿ]+"

SPELLING_SQL = r"""
WITH RECURSIVE crcs AS (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, xor(list_reduce(
        flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
            lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)),
        lambda crc, b: xor(t[1 + (xor(crc, b) & 255)], crc >> 8), 4294967295::BIGINT), 4294967295) AS h
    FROM counted, crcs
), edited AS (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
    FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM edited WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), holes AS (
    SELECT word, n, unnest(list_transform(range(length(word)), lambda i: left(word, i::INT) || '*' || substr(word, i::INT + 2))) AS hole FROM words
), shorter AS (
    SELECT DISTINCT word, n, replace(hole, '*', '') AS less FROM holes
), near AS (
    SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
    UNION ALL SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.less = b.word
    UNION ALL SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.less = b.word
), best AS (
    SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, (-m, other)) AS other FROM near GROUP BY word
), formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * w.n THEN other END AS form, CASE WHEN m >= 10 * w.n THEN m END AS form_n
    FROM words w LEFT JOIN best USING (word)
), followed AS (
    SELECT word, word AS root FROM formed
    UNION ALL SELECT followed.word, form FROM followed JOIN formed ON formed.word = followed.root WHERE form IS NOT NULL
), roots AS (
    SELECT word, root FROM followed JOIN (SELECT word AS root FROM formed WHERE form IS NULL) USING (root)
)
SELECT word, form, root, n::BIGINT AS n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM formed JOIN roots USING (word)
"""


def vocabulary(docs: DataFrame, edit: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Distinct words of at least ``LENGTH`` code points and ``OCCURRENCES`` occurrences, with their number ``n``.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF with A-Z lowered. ``edit`` may change each word, given
    it and the id. Occurrences are counted before the shuffle, so a frequent word is no hot key.
    """
    text = F.translate(whole_text(), CAPITALS, SMALL)
    words = docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("word")).where(F.char_length("word") >= LENGTH)
    if edit:
        words = words.select("doc_id", "word").select(edit(F.col("word"), F.col("doc_id")).alias("word")).where(F.char_length("word") >= LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= OCCURRENCES)


def misspelt(word: Column, doc_id: Column) -> Column:
    """``word`` without one code point, for one in 31 of the CRCs of id (null: empty text) and word."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = F.pmod(h, F.char_length(word)).cast("int")
    return F.when(h % 31 == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))).otherwise(word)


class Acceptor:
    """Minimised deterministic acceptor of a set of words: states with the same continuations are one state.

    ``arcs[s]`` are the labelled arcs of state ``s`` in code-point order, ``final[s]`` whether a word may end there.
    """

    def __init__(self, words: list[str]):
        self.arcs: list[tuple[tuple[str, int], ...]] = []
        self.final: list[bool] = []
        self.known: dict[tuple, int] = {}
        self.words = sorted(words)
        self.start = self._state(0, len(self.words), 0)
        self.continued: dict[tuple[int, int], list[str]] = {}

    def _state(self, low: int, high: int, depth: int) -> int:
        """The state after the first ``depth`` code points of the words from ``low`` to ``high``, which share them."""
        words = self.words
        if high - low == 1:
            return self._tail(words[low][depth:])
        ends = len(words[low]) == depth
        at, arcs = low + ends, []
        while at < high:
            label, first = words[at][depth], at
            while at < high and words[at][depth] == label:
                at += 1
            arcs.append((label, self._state(first, at, depth + 1)))
        return self._kept(tuple(arcs), ends)

    def _tail(self, rest: str) -> int:
        state = self._kept((), True)
        for label in reversed(rest):
            state = self._kept(((label, state),), False)
        return state

    def _kept(self, arcs: tuple, ends: bool) -> int:
        state = self.known.get((arcs, ends))
        if state is None:
            state = self.known[arcs, ends] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(ends)
        return state

    def common(self, a: int, b: int) -> list[str]:
        """Continuations that both states accept: the composed states (a, edited, b), each enumerated once."""
        found = self.continued.get((a, b))
        if found is None:
            found = [""] if self.final[a] and self.final[b] else []
            other = dict(self.arcs[b])
            for label, then in self.arcs[a]:
                if label in other:
                    found += [label + rest for rest in self.common(then, other[label])]
            self.continued[a, b] = found
        return found

    def near_pairs(self, places: int, shorter: int) -> Iterator[tuple[str, str]]:
        """All accepted pairs, the shorter of length ``shorter``, that one edit turns into each other before place ``places``.

        Composed with the transducer that copies, edits once and copies on, the acceptor reads both words alike up to
        the edit, so unedited states are pairs of a state with itself. There two arcs replace one code point by another,
        or one arc inserts one; the latter counts at the first place where the words differ.
        """
        stack = [(self.start, "")]
        while stack:
            state, read = stack.pop()
            if len(read) >= places:
                continue
            arcs = self.arcs[state]
            for k, (label, then) in enumerate(arcs):
                stack.append((then, read + label))
                for other, there in arcs[k + 1 :]:
                    for rest in self.common(then, there):
                        if len(read) + len(rest) + 1 == shorter:
                            yield read + label + rest, read + other + rest
                for rest in self.common(then, state):
                    if len(read) + len(rest) == shorter and rest[:1] != label:
                        yield read + label + rest, read + rest


def _initial_states(words: DataFrame) -> DataFrame:
    """Each word once for every initial state it takes part in: ``length``, ``low``, ``high`` and the key of the state.

    Two near words, of which the shorter has ``length`` code points, first differ at one place from 0 to ``length``.
    Words that first differ at ``low`` or later and before ``high`` share their first ``low`` code points and their
    last ``length - high``, so these name the state of the composition that reads both. Places are halved, so every
    pair of near words belongs to exactly one interval.
    """
    both = words.select("word", "n", F.explode(F.array(F.char_length("word"), F.char_length("word") - 1)).alias("length")).where(F.col("length") >= LENGTH)
    return _divided(both.withColumn("low", F.lit(0)).withColumn("high", F.col("length") + 1))


def _divided(rows: DataFrame) -> DataFrame:
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    halves = F.explode(F.array(F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), "high"))).alias("places")
    return rows.select("word", "n", "length", halves).select("word", "n", "length", "places.low", "places.high")


def _keyed(rows: DataFrame) -> DataFrame:
    after = F.greatest(F.col("length") - F.col("high"), F.lit(0))
    first = F.substring("word", F.lit(1), F.col("low"))
    last = F.substring(F.col("word"), F.char_length("word") - after + 1, after)
    return rows.withColumn("state", F.concat_ws(" ", "length", "low", "high", first, last))


def initial_states(words: DataFrame, most: int = GROUP) -> DataFrame:
    """``_initial_states``, divided where they hold more than ``most`` words or more than ``WIDE`` places.

    At one place the words of a state differ in one or two code points only, so the alphabet bounds their number:
    90 letters give at most 90 + 90 * 90. Number of rounds: the logarithm of the longest word.
    """
    done, todo = [], _initial_states(words)
    while True:
        rows = written(_keyed(todo))
        places = F.col("high") - F.col("low")
        many = rows.groupBy("state").agg(F.count("*").alias("many"), F.max(places).alias("places"))
        crowded = written(many.where((F.col("many") > most) & (F.col("places") > 1)).select("state", F.lit(True).alias("crowded")))
        marked = written(rows.join(bounded(crowded), "state", "left"))
        again = F.coalesce("crowded", F.lit(False)) | (places > WIDE)
        done.append(marked.where(~again).select(rows.columns))
        todo = marked.where(again)
        if todo.isEmpty():
            return _union(done)
        todo = _divided(todo)


def _union(parts: list[DataFrame]) -> DataFrame:
    all_rows = parts[0]
    for part in parts[1:]:
        all_rows = all_rows.unionByName(part)
    return all_rows


def near_words(words: DataFrame, most: int = GROUP) -> DataFrame:
    """Per word with near words: ``word``, ``n_near``, and of these the most frequent one, ``other`` with ``other_n``.

    Initial states are dealt to tasks; each is built, composed and enumerated alone, and only sums over its pairs
    leave the task.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in map(_composed, _states(batches)):
            if found:
                yield pa.RecordBatch.from_pydict(dict(zip(("word", "n_near", "other", "other_n"), map(list, zip(*found)))))

    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    states = initial_states(words, most).repartition(parts, "state").sortWithinPartitions("state")
    parts_of = states.select("state", "word", "n", "length", "low", "high").mapInArrow(search, "word string, n_near long, other string, other_n long")
    first = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("first")
    return parts_of.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select(
        "word", "n_near", "first.other", (-F.col("first.less")).alias("other_n")
    )


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one state at a time; a state may begin in one batch and end in another."""
    state, held = None, []
    for batch in batches:
        for name, *row in zip(*(batch.column(c).to_pylist() for c in ("state", "word", "n", "length", "low", "high"))):
            if name != state:
                if len(held) > 1:
                    yield held
                state, held = name, []
            held.append(row)
    if len(held) > 1:
        yield held


def _composed(rows: list[tuple]) -> list[tuple[str, int, str, int]]:
    """(word, number of near words, the first of them, its n) for the words of one initial state."""
    _, _, length, low, high = rows[0]
    after = max(length - high, 0)
    whole = {word[low : len(word) - after]: (word, n) for word, n, *_ in rows}
    told: dict[str, list] = {}
    for pair in Acceptor(list(whole)).near_pairs(high - low, length - low - after):
        for one, other in (pair, pair[::-1]):
            word, n = whole[other]
            held = told.get(one)
            if held is None:
                told[one] = [1, -n, word]
            else:
                held[0] += 1
                if (-n, word) < (held[1], held[2]):
                    held[1:] = -n, word
    return [(whole[one][0], many, word, -less) for one, (many, less, word) in told.items()]


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of every word that has a form: forms are followed to the last by doubling.

    A form is more frequent than its word, so there are no circles, and the rounds are few.
    """
    links = written(forms.select("word", F.col("form").alias("root")))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        told = written(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = told.select("word", "root")
        if told.where("moved").isEmpty():
            return links


def spelling_variants(docs: DataFrame, edit: Callable[[Column, Column], Column] | None = None, most: int = GROUP) -> DataFrame:
    """One row per word of the vocabulary: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Near words differ by exactly one inserted, deleted or replaced code point. ``form`` is the near word of largest
    ``n`` (ties: smallest in code-point order) if that is at least ``RATIO`` times the word's own, else null; ``root``
    follows forms to the last. Both acceptors of the composition are the whole vocabulary; it is divided by initial
    states, and each pair of near words is enumerated in exactly one of them.

    Null, empty and blank texts have no words. Repeated rows count again. Ids matter only to ``edit``. A table
    without words of the length and number gives no rows. Other columns are ignored.
    """
    words = written(vocabulary(docs, edit))
    near = near_words(words, most)
    form = F.col("other_n") >= RATIO * F.col("n")
    formed = written(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form, F.col("other")).alias("form"), F.when(form, F.col("other_n")).alias("form_n")
        )
    )
    last = roots(formed.where("form is not null"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
