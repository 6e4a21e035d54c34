"""Personal data: patterns find the protected entities, and corpus statistics the terms that give them away."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mandiscope.llm.common import KEY, bounded, document_key, whole_text
from mandiscope.session import written

#: Kinds of protected entities, in order.
KINDS = ("email", "ip", "card", "phone")
#: Documents that every term is taken to have besides its own, in which entities are as frequent as in the corpus.
PRIOR = 1.0
#: Share of an entity's information that a term may disclose before it is generalised, and before it is removed.
GENERALISE, REMOVE = 0.75, 0.95

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]+")
#: Country codes of two digits; those that begin with 1 or 7 have one, all others three.
_TWO_DIGITS = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())

_SPANS = "array<struct<kind:int,start:int,end:int>>"


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def entity_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base matches, by kind and start. Each kind is read once from left to right.

    An address is found from its ``@``: the local part is the run before it, back to the last match at most, which is
    the leftmost match of the pattern without trying every start.
    """
    found = []
    low, at = 0, text.find("@")
    while at >= 0:
        local = text[low:at]
        start = len(local.rstrip(_LOCAL)) + low
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        low = domain.end() if domain else at + 1
        if domain:
            found.append((0, start, low))
        at = text.find("@", low)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
                found.append((3, *m.span()))
    return found


def entity_classes(kind: int, value: str) -> list[str]:
    """The exact entity and the classes that it shares with others: kind, domain, network, issuer or country code."""
    value = value.lower()
    digits = re.sub("[^0-9]", "", value)
    if kind == 0:
        shared = ["@" + value.rsplit("@", 1)[1]]
    elif kind == 1:
        shared = [value.rsplit(".", n)[0] + ".*" for n in (1, 2)]
    elif kind == 2:
        shared = [digits[:6] + "*"]
    else:
        size = 1 if digits[0] in "17" else 2 if digits[:2] in _TWO_DIGITS else 3
        shared = [f"+{digits[:size]}*"]
    return [f"{KINDS[kind]}:{v}" for v in (value if kind < 2 else digits, *shared, "*")]


def _free_words(text: str, spans: list[tuple[int, int, int]]) -> set[str]:
    """The words of the whole text outside of all entities, in lower case."""
    inside = sorted((s, e) for _, s, e in spans)
    free, k, reach = set(), 0, 0
    for m in _TERM.finditer(text):
        while k < len(inside) and inside[k][0] < m.end():
            reach = max(reach, inside[k][1])
            k += 1
        if reach <= m.start():
            free.add(m.group().lower())
    return free


def _entities(docs: DataFrame) -> DataFrame:
    """Per row: id, key, base ``spans``, the ``classes`` of its entities and the ``words`` outside of them if there are any."""

    @F.pandas_udf(f"spans {_SPANS}, classes array<string>, words array<string>")
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            spans, classes, words = [], [], []
            for text in batch:
                own = entity_spans(text) if text else []
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in own])
                classes.append(sorted({c for k, s, e in own for c in entity_classes(k, text[s:e])}))
                words.append(sorted(_free_words(text, own)) if own else [])
            yield pd.DataFrame({"spans": spans, "classes": classes, "words": words})

    # No kind matches without a digit or an @.
    text = F.when(whole_text().rlike("[0-9@]"), whole_text()).otherwise(F.lit(""))
    return docs.select("doc_id", *document_key(), F.xxhash64(whole_text()).alias("body"), find(text).alias("p")).select(
        "doc_id", *KEY, "body", "p.*"
    )


def _terms(text: str = "text"):
    return F.array_remove(F.split(F.lower(whole_text(text)), r"[^\p{L}\p{N}]+"), "")


def disclosing_terms(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """Terms that reveal a protected entity: ``term``, ``disclosure`` and ``action`` (generalise or remove).

    An entity is an exact value or a class of ``entity_classes``, and a term goes with it if both are in one text; equal
    texts count once. With p over the distinct texts, an entity c has the information -log2 p(c), and a term t gives away
    the pointwise mutual information log2 p(c|t) / p(c) of it. p(c|t) is shrunk towards p(c) by ``PRIOR`` texts, and the
    share that is given away by b / (b + 1) if b texts hold both, since few texts say little. ``disclosure`` is the
    largest share over all entities.
    """
    # The share is at most b / (b + 1), so what is in fewer texts cannot reach the threshold.
    least = math.ceil(GENERALISE / (1 - GENERALISE))
    total = float(max(entities.select("body").distinct().count(), 1))
    texts = entities.where(F.size("classes") > 0).dropDuplicates(["body"])
    per_entity = texts.select(F.explode("classes").alias("entity")).groupBy("entity").agg(F.count("*").alias("with_entity"))
    per_entity = bounded(written(per_entity.where(F.col("with_entity") >= least)))
    recurring = texts.select("words", F.explode("classes").alias("entity")).join(per_entity.select("entity"), "entity")
    both = recurring.select("entity", F.explode("words").alias("term")).groupBy("entity", "term").agg(F.count("*").alias("both"))
    both = written(both.where(F.col("both") >= least))
    asked = bounded(both.select("term").distinct())
    distinct = docs.select(F.xxhash64(whole_text()).alias("body"), whole_text().alias("text")).dropDuplicates(["body"])
    per_term = (
        distinct.select(F.explode(F.array_distinct(_terms())).alias("term")).join(asked, "term").groupBy("term").agg(F.count("*").alias("with_term"))
    )
    joined = both.join(per_entity, "entity").join(per_term, "term")
    prior = F.col("with_entity") / F.lit(total)
    given = (F.col("both") + PRIOR * prior) / (F.greatest("with_term", "both") + PRIOR)
    seen = F.col("both") / (F.col("both") + 1)
    share = F.when(prior < 1, seen * F.least(F.lit(1.0), F.log2(given / prior) / -F.log2(prior))).otherwise(F.lit(0.0))
    worst = joined.groupBy("term").agg(F.max(share).alias("disclosure")).where(F.col("disclosure") >= GENERALISE)
    return worst.withColumn("action", F.when(F.col("disclosure") >= REMOVE, "remove").otherwise("generalise"))


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``spans``, all (kind, start, end) by kind and start.

    Kinds 0 to 3 are the base kinds, 4 are terms to generalise, 5 terms to remove; a term is a whole word, in either case,
    wherever it occurs outside of base spans. Null and empty texts have none. Rows of equal text count once in the
    statistics; ids may be null. An empty table gives no rows. Other columns are ignored.
    """
    entities = written(_entities(docs))
    terms = written(disclosing_terms(docs, entities))
    asked = terms.select("term", "action")
    hits = (
        docs.select(*document_key(), F.explode(F.array_distinct(_terms())).alias("term"))
        .join(bounded(asked), "term")
        .groupBy(*KEY)
        .agg(F.collect_set(F.struct("term", "action")).alias("terms"))
    )

    @F.pandas_udf(_SPANS)
    def place(texts: pd.Series, terms: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, terms):
            actions = {t["term"]: 4 + (t["action"] == "remove") for t in own}
            words = ((actions.get(m.group().lower()), *m.span()) for m in _TERM.finditer(text))
            out.append([{"kind": k, "start": s, "end": e} for k, s, e in words if k])
        return pd.Series(out)

    hit = bounded(written(hits))
    texts = docs.select(*document_key(), whole_text().alias("text")).join(hit, KEY).dropDuplicates(KEY)
    placed = texts.select(*KEY, place("text", "terms").alias("more"))
    outside = F.filter("more", lambda m: ~F.exists("spans", lambda s: (m["start"] < s["end"]) & (s["start"] < m["end"])))
    added = F.when(F.col("more").isNull(), F.col("spans")).otherwise(F.concat("spans", outside))
    return entities.drop("classes", "words", "body").join(placed, KEY, "left").select("doc_id", F.array_sort(added).alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``personal_data`` with the sanitised ``text``: entities and generalised terms become their kind, removed terms go."""
    names = [f"[{k}]" for k in KINDS] + ["[term]", ""]

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, spans):
            parts, at = [], 0
            for s in sorted(own, key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= at:
                    parts += [text[at : s["start"]], names[s["kind"]]]
                    at = s["end"]
            out.append("".join([*parts, text[at:]]))
        return pd.Series(out)

    found = personal_data(docs.select(F.struct("doc_id", "text").alias("doc_id"), "text"))
    return found.select("doc_id.doc_id", replaced(F.coalesce("doc_id.text", F.lit("")), "spans").alias("text"), "spans")


def personal_digest(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans as text, per row of ``docs``."""
    kinds = F.array(*[F.lit(k) for k in (*KINDS, "term", "removed")])

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")

    def number(kind: int):
        # A second argument of the condition, even a default, would be the place in the array.
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    counts = [number(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return personal_data(docs).select("doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
