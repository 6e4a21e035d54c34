"""Language by rank order: the most frequent n-grams of a text against the profile of each language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mandiscope.llm.common import bounded, held_out, whole_text
from mandiscope.session import written

#: N-grams of a profile, and of a text, that are ranked.
RANKED = 400
#: Documents of each language that its profile is learnt from, at most.
FIT_ROWS = 3_000
#: Stands for a blank: no code point, and not zero, so that n-grams of different length are different numbers.
BLANK = (1 << 21) - 1

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of one to three letters of the whole text with their counts; words are padded with one blank.

    An n-gram is a number: 21 bits for each code point, with ``BLANK`` for a blank. Any other character ends a word.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.where(letter, codes.astype(np.int64), BLANK)
    c = np.concatenate(([BLANK], c, [BLANK]))
    c = c[np.concatenate(([True], (c[1:] != BLANK) | (c[:-1] != BLANK)))]
    two = c[:-1] << 21 | c[1:]
    three = two[:-1] << 21 | c[2:]
    every = np.sort(np.concatenate((c[c != BLANK], two, three[c[1:-1] != BLANK])))
    edge = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    return every[edge], np.diff(np.append(edge, len(every)))


def top(found: np.ndarray, counts: np.ndarray, ranked: int = RANKED) -> np.ndarray:
    """The most frequent n-grams in order; ties by their number."""
    return found[np.lexsort((found, -counts))[:ranked]]


def profiles(docs: DataFrame, rows: int = FIT_ROWS) -> dict[str, np.ndarray]:
    """The ranked n-grams of each language, from documents that are not held out, ``rows`` per language at most.

    The n-grams of all languages are counted at once in Spark and only the ranked ones reach the driver. Nulls in ``lang``
    are not learnt from.
    """
    known = docs.where(~held_out() & F.col("lang").isNotNull())
    ids = _sample(known, rows)
    sample = known.select("doc_id", "lang", whole_text().alias("text")).join(bounded(ids), ["doc_id", "lang"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, group in batch.groupby("lang"):
                pairs = [grams(t) for t in group["text"]]
                every, at = np.unique(np.concatenate([p[0] for p in pairs]), return_inverse=True)
                n = np.bincount(at, np.concatenate([p[1] for p in pairs]), len(every)).astype(np.int64)
                yield pd.DataFrame({"lang": name, "gram": every, "n": n})

    counts = sample.select("lang", "text").mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # Every task keeps no more than the ranked n-grams of a language before they meet.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.select("lang", "gram", place.alias("place")).where(F.col("place") <= RANKED).toPandas()
    return {name: own.sort_values("place")["gram"].to_numpy() for name, own in best.groupby("lang")}


def _sample(known: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` distinct ids of each language, those of least hash; all languages in the same scan.

    A threshold from their number thins the ids of a language before they are ordered, so that no task gathers
    more than a small multiple of ``rows``.
    """
    ids = known.select("lang", "doc_id").where("doc_id is not null").distinct()
    ids = written(ids.withColumn("at", F.xxhash64(F.lit("sample"), "doc_id")))
    counts = ids.groupBy("lang").agg(F.count("*").alias("own"))
    share = F.least(F.lit(1.0), F.lit(1.2 * (rows + 1000)) / F.col("own"))
    bound = F.when(F.col("own") > 2 * rows, (F.lit(-(2.0**63)) + share * (2.0**64 * 0.999999)).cast("long"))
    bounds = written(counts.select("lang", F.coalesce(bound, F.lit((1 << 63) - 1)).alias("bound")))
    thinned = ids.join(bounds, "lang").where(F.col("at") <= F.col("bound"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("at", "doc_id"))
    return written(thinned.select("lang", "doc_id", place.alias("place")).where(F.col("place") <= rows).drop("place"))


def language(docs: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``lang_pred``, ``score``.

    The distance of a text to a profile is the sum, over its ranked n-grams, of how far each is out of place there,
    and ``RANKED`` for one that the profile lacks. The least distance wins, ties by name. ``score`` is one minus its
    share of the greatest possible distance. Null texts and texts without a letter are ``und`` with score 0, as is
    every text if nothing could be learnt. A null id counts as the empty text for ``held_out``. Rows may repeat; other
    columns are ignored; an empty table gives no rows.
    """
    learnt = profiles(docs, rows)
    names = sorted(learnt)
    known = np.unique(np.concatenate([*learnt.values(), np.zeros(0, np.int64)]))
    places = np.full((len(names), len(known)), -1, np.int64)
    for k, name in enumerate(names):
        places[k, np.searchsorted(known, learnt[name])] = np.arange(len(learnt[name]))
    shared = docs.sparkSession.sparkContext.broadcast((names, known, places))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, known, places = shared.value
        for batch in texts:
            out, scores = ["und"] * len(batch), np.zeros(len(batch))
            for k, text in enumerate(batch):
                own = top(*grams(text))
                if not len(own) or not names:
                    continue
                at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
                place = np.where((known[at] == own)[None, :], places[:, at], -1)
                away = np.where(place < 0, RANKED, np.abs(place - np.arange(len(own))[None, :])).sum(axis=1)
                best = int(away.argmin())
                out[k], scores[k] = names[best], 1.0 - away[best] / (RANKED * len(own))
            yield pd.DataFrame({"lang_pred": out, "score": scores})

    return docs.select("doc_id", held_out().alias("held_out"), predict(whole_text()).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score"
    )
