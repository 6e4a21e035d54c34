"""Secrets in texts: an inverted index of trigrams picks the documents that each rule is tried on.

Only DataFrame functions are used.
"""

from __future__ import annotations

from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mandiscope.llm.common import KEY, bounded, document_key, whole_text
from mandiscope.session import written


class Rule(NamedTuple):
    """A kind of secret: its pattern, and the group that must have ``least`` characters (group 0: the whole match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The three base rules. Runs shorter than asked are not secrets, so patterns of one run ask at once.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Public formats of credentials.
MORE = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("private", r"-----BEGIN ([A-Z]+ )?PRIVATE KEY-----"),
    Rule("web", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE


class _Part(NamedTuple):
    """What a piece of a pattern can match: its strings if they are few, and the trigrams that any match has.

    ``must`` is a list of conditions; each is a list of alternatives; each alternative is a set of trigrams.
    """

    strings: list[str] | None
    must: list[list[frozenset[str]]]


def _condition(strings: list[str]) -> list[list[frozenset[str]]]:
    options = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
    return [options] if all(options) else []


class _Pattern:
    """Reads the part of the pattern language that rules use: literals, classes, groups, alternatives, repeats."""

    FEW = 32

    def __init__(self, pattern: str):
        self.text, self.at = pattern, 0

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alternatives(self) -> _Part:
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        if len(parts) == 1:
            return parts[0]
        if all(p.strings is not None for p in parts):
            return _Part([s for p in parts for s in p.strings], [])
        each = [mandatory(p) for p in parts]
        return _Part(None, [[o for options in each for o in options]] if all(all(o) for o in each) else [])

    def sequence(self) -> _Part:
        strings: list[str] | None = [""]
        whole, must = True, []
        while self.peek() not in ("", "|", ")"):
            part = self.repeated(self.atom())
            must += part.must
            if part.strings is not None and len(strings) * len(part.strings) <= self.FEW:
                strings = [a + b for a, b in product(strings, part.strings)]
            else:
                must += _condition(strings)
                whole = False
                strings = part.strings if part.strings is not None and len(part.strings) <= self.FEW else [""]
        return _Part(strings, must) if whole else _Part(None, must + _condition(strings))

    def atom(self) -> _Part:
        c = self.take()
        if c == "(":
            if self.peek() == "?":
                while self.take() != ":":
                    pass
            part = self.alternatives()
            self.take()
            return part
        if c == "[":
            members = self.members()
            return _Part(members if len(members) <= 8 else None, [])
        if c == ".":
            return _Part(None, [])
        if c == "\\":
            c = self.take()
            if c == "x":
                c = chr(int(self.take() + self.take(), 16))
            elif c.isalnum():
                return _Part(None, [])
        return _Part([c.lower()], [])

    def members(self) -> list[str]:
        found: list[str] = []
        while (c := self.take()) != "]":
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                found += map(chr, range(ord(c), ord(self.take()) + 1))
            else:
                found.append(c)
        return sorted({c.lower() for c in found})

    def repeated(self, part: _Part) -> _Part:
        c = self.peek()
        if c == "?":
            self.take()
            return _Part(None if part.strings is None else [*part.strings, ""], [])
        if c == "*":
            self.take()
            return _Part(None, [])
        if c == "+":
            self.take()
            least = 1
        elif c == "{":
            inside = self.text[self.at + 1 : self.text.index("}", self.at)]
            self.at += len(inside) + 2
            least = int(inside.split(",")[0])
        else:
            return part
        return _Part(None, part.must + (_condition(part.strings) if part.strings else []) if least else [])


def mandatory(part: _Part) -> list[frozenset[str]]:
    """Alternatives of which each match satisfies one; an empty set says nothing is mandatory."""
    conditions = part.must + (_condition(part.strings) if part.strings else [])
    combined = [frozenset[str]()]
    for options in conditions:
        if len(combined) * len(options) <= 64:
            combined = [a | b for a, b in product(combined, options)]
    return list(dict.fromkeys(combined))


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Boolean query of a pattern over lower-case trigrams: any of the sets, of a set all. ``[]``: scan fully."""
    options = mandatory(_Pattern(pattern).alternatives())
    return [o for o in options if not any(p < o for p in options)] if all(options) else []


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Inverted index over lower-case text: a row (``trigram``, key of a document) for each of ``trigrams`` it has.

    Posting lists are rows, not arrays, so one of any length spreads over all tasks.
    """
    low = docs.select(*document_key(), F.lower(whole_text()).alias("low"))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select(*KEY, F.explode(found).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """Intersect posting lists: per document the ``kinds`` of rules whose query it satisfies."""
    rows = [(kind, k, t, len(option)) for kind, options in queries.items() for k, option in enumerate(options) for t in sorted(option)]
    asked = index.sparkSession.createDataFrame(rows, "kind string, option int, trigram string, need int")
    counted = index.join(F.broadcast(asked), "trigram").groupBy(*KEY, "kind", "option", "need").agg(F.count_distinct("trigram").alias("n"))
    return counted.where("n = need").groupBy(*KEY).agg(F.collect_set("kind").alias("kinds"))


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All matches: key, ``rank`` of the rule, ``kind``, ``start``, ``end`` in code points, end exclusive; once per document.

    A rule with a trigram query is tried only on the documents its postings leave; a rule without one on all. Matches are
    found leftmost and do not overlap; those whose group is too short are dropped and not tried again.
    """
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    trigrams = sorted({t for q in queries.values() for option in q for t in option})
    picked = bounded(written(candidates(postings(docs, trigrams), queries)))
    texts = docs.select(*document_key(), whole_text().alias("text")).join(picked, KEY, "left")

    def matches(rank: int, rule: Rule) -> Column:
        pattern = F.lit(rule.pattern)
        tried = F.array_contains("kinds", rule.kind) if rule.kind in queries else F.lit(True)
        found = F.arrays_zip(
            F.split("text", rule.pattern, -1).alias("gap"),
            F.regexp_extract_all("text", pattern, 0).alias("all"),
            F.regexp_extract_all("text", pattern, rule.group).alias("part"),
        )
        sizes = F.transform(
            found,
            lambda m, i: F.struct(
                F.lit(rank).alias("rank"),
                i.alias("order"),
                F.char_length(m["gap"]).alias("gap"),
                F.char_length(m["all"]).alias("long"),
                (F.char_length(m["part"]) >= rule.least).alias("kept"),
            ),
        )
        return F.when(tried & F.col("text").rlike(rule.pattern), sizes)

    every = F.flatten(F.array_compact(F.array(*[matches(k, r) for k, r in enumerate(rules)])))
    rows = texts.select(*KEY, F.explode(every).alias("m")).select(*KEY, "m.*").where("long is not null").distinct()
    before = Window.partitionBy(*KEY, "rank").orderBy("order")
    end = F.sum(F.col("gap") + F.col("long")).over(before)
    kind = F.get(F.array(*[F.lit(r.kind) for r in rules]), F.col("rank"))
    placed = rows.withColumn("end", end).where("kept")
    return placed.select(*KEY, "rank", kind.alias("kind"), (F.col("end") - F.col("long")).alias("start"), "end")


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``found``, its matches in order of (start, rule) as an array of (start, rank, end, kind).

    Null and empty texts have none. Rows equal in id and text are scanned alike; ids may be null. An empty table gives no
    rows. Other columns are ignored.
    """
    spans = secret_spans(docs, rules)
    listed = spans.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("found"))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return docs.select("doc_id", *document_key()).join(listed, KEY, "left").select("doc_id", F.coalesce("found", none).alias("found"))


def _span_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])), ",")


def secrets_digest(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base matches and all matches as text, per row of ``docs``."""
    base = F.filter("found", lambda m: m["rank"] < len(BASE))
    counts = [F.size(F.filter("found", lambda m: m["kind"] == r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return scan_secrets(docs).select("doc_id", *counts, F.sha2(_span_text(base), 256).alias("base_sha256"), _span_text(F.col("found")).alias("spans"))


def _rule_sql(rank: int, rule: Rule) -> str:
    pattern = "'" + rule.pattern.replace(r"\x20", " ").replace("'", "''") + "'"
    return f"""SELECT r, {rank} AS rank, '{rule.kind}' AS kind, {rule.least} AS least, string_split_regex(t, {pattern}) AS gaps,
      regexp_extract_all(t, {pattern}, 0) AS hits, regexp_extract_all(t, {pattern}, {rule.group}) AS parts
    FROM d WHERE regexp_matches(t, {pattern})"""


SECRETS_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), m AS ({" UNION ALL ".join(_rule_sql(k, r) for k, r in enumerate(RULES))}
), p AS (
  SELECT r, rank, kind, least, hits, parts, list_transform(gaps, lambda x: length(x)) AS g, list_transform(hits, lambda x: length(x)) AS h, unnest(range(1, len(hits) + 1)) AS i FROM m
), s AS (
  SELECT r, rank, kind, CAST(list_sum(g[1:i]) + coalesce(list_sum(h[1:i - 1]), 0) AS BIGINT) AS b, h[i] AS n FROM p WHERE length(parts[i]) >= least
), a AS (
  SELECT r, count(*) FILTER (rank = 0) AS n0, count(*) FILTER (rank = 1) AS n1, count(*) FILTER (rank = 2) AS n2,
    string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, rank) FILTER (rank < {len(BASE)}) AS base,
    string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, rank) AS spans
  FROM s GROUP BY r
)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (r)
"""
