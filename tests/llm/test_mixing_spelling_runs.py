"""Mixing, spelling variants and periodic runs against plain versions, on odd rows as well."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest

from mandiscope.llm import mixing, periodic, spelling

ROWS = [
    (1, "alpha beta gamma delta", "b"),
    (2, "alpha " * 40, "a"),
    (3, None, "a"),
    (4, "", None),
    (5, " \t\n ", "ä"),
    (6, "word joined other\x0bwords\x1cstay", "ä"),
    (7, "one two three " * 7 + "end", "b"),
    (7, "one two three " * 7 + "end", "b"),
    (8, "tail of it", ""),
    (None, "no id here " * 5, None),
    (None, "no id here " * 5, None),
    (None, None, None),
    (9, " ".join(f"w{i % 977}" for i in range(3_000)), "long"),
    (10, "Ünïcodé straßen 𝔘𝔫𝔦 Straßen STRASSEN straßens ünïcodé", "b"),
    (1 << 60 | 1, "large id next to null ids", "b"),
]
CLASH = "row", "place", "size", "target", "need", "rank", "runs", "word", "state", "form", "root", "n", "its", "salt", "weight", "low", "collapsed"


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, source string, lang string, " + ", ".join(f"`{c}` int" for c in CLASH)
    return spark.createDataFrame([(*r, "en", *range(len(CLASH))) for r in ROWS], schema).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def test_empty_tables(empty):
    assert mixing.mix(empty).count() == 0
    assert spelling.spelling_variants(empty, spelling.misspelt).count() == 0
    assert periodic.periodic_digest(empty).count() == 0


# ---------------------------------------------------------------- mixing


def plain_targets(sizes, weights, share=Fraction(3, 2), epochs=2):
    """Clamp and reshare one round after another."""
    goal, target, free = share * sum(sizes.values()), {}, set(sizes)
    while free:
        room, total = goal - sum(target.values()), sum(weights[s] for s in free)
        above = {s for s in free if weights[s] * room > epochs * sizes[s] * total}
        if not above:
            return target | {s: weights[s] * room / total for s in free}
        target |= {s: Fraction(epochs * sizes[s]) for s in above}
        free -= above
    return target


def plain_mix(rows):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words_of(text))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    targets = plain_targets(sizes, {s: Fraction((3, 1, 2)[k % 3]) for k, s in enumerate(order)})
    out, before = [], Counter()
    for i, text, source in sorted(rows, key=lambda r: int(hashlib.md5(f"mix:{'' if r[0] is None else r[0]}:{r[1] or ''}".encode()).hexdigest()[:15], 16)):
        size = len(words_of(text))
        whole = int(targets[source] / sizes[source]) if sizes[source] else 0
        extra = 2 * before[source] + size <= 2 * (targets[source] - whole * sizes[source])
        before[source] += size
        out.append((i, size, sizes[source], round(float(targets[source]), 6), size * (whole + extra)))
    return sorted(map(str, out))


def told_mix(df):
    return sorted(str((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken)) for r in df.collect())


def test_mix_of_odd_rows(docs):
    assert told_mix(mixing.mix(docs)) == plain_mix(ROWS)


@pytest.mark.parametrize("seed", range(4))
def test_mix_of_hot_sources(spark, monkeypatch, seed):
    random = np.random.default_rng(seed)
    if seed % 2:
        monkeypatch.setattr(mixing, "bounded", lambda df: df)
        monkeypatch.setattr(mixing, "PASS_BITS", 4)
    sources = [None, "hot", *[f"s{k}" for k in range(int(random.integers(0, 12)))]]
    rows = [(int(k), "w " * int(random.pareto(1) * 20), "hot" if random.random() < 0.4 else sources[random.integers(len(sources))]) for k in range(400)]
    made = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert told_mix(made) == plain_mix(rows)
    longest, taken, target = Counter(), Counter(), {}
    by = {r[0]: r[2] for r in rows}
    for r in made.collect():
        source = by[r.doc_id]
        longest[source] = max(longest[source], r["size"])
        taken[source] += r.taken
        target[source] = r.target
        assert r.taken in (0, r["size"], 2 * r["size"])
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6 for s in taken)


def test_equal_rows_end_at_the_border(spark):
    rows = [(None, "a b", "x")] * 300 + [(None, "c", "y")] * 9
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    assert told_mix(mixing.mix(df)) == plain_mix(rows)


@pytest.mark.parametrize("share", [0.3, 1.5, 2.0, 3.0])
def test_water_level(spark, share):
    sizes = {f"s{k}": int(n) for k, n in enumerate([0, 1, 5, 5, 40, 1000, 7, 0, 90])}
    weights = {s: Fraction(k % 4 + 1) for k, s in enumerate(sizes)}
    df = spark.createDataFrame([(s, n, float(weights[s])) for s, n in sizes.items()], "source string, source_size long, weight double")
    want = plain_targets(sizes, weights, Fraction(share)) if share < 2 else {s: 2 * n for s, n in sizes.items()}
    got = {r.source: r.target for r in mixing.water_fill(df, share).collect()}
    assert got == pytest.approx({s: float(t) for s, t in want.items()})


# ---------------------------------------------------------------- spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counts):
    near_of = defaultdict(list)
    for a, b in combinations(counts, 2):
        if near(a, b):
            near_of[a].append(b)
            near_of[b].append(a)
    form = {}
    for word, others in near_of.items():
        best = min(others, key=lambda o: (-counts[o], o))
        if counts[best] >= 10 * counts[word]:
            form[word] = best

    def root(word):
        while word in form:
            word = form[word]
        return word

    return sorted(str((w, form.get(w), root(w), n, len(near_of[w]), counts.get(form.get(w)))) for w, n in counts.items())


def plain_vocabulary(rows, edit=True):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if edit and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def told_variants(df):
    return sorted(str((r.word, r.form, r.root, r.n, r.n_near, r.form_n)) for r in df.collect())


def test_variants_of_odd_rows(docs):
    rows = [(i, t) for i, t, _ in ROWS]
    assert told_variants(spelling.spelling_variants(docs, spelling.misspelt)) == plain_variants(plain_vocabulary(rows))


@pytest.mark.parametrize("most", [2, 20, 1000])
def test_variants_of_crowded_states(spark, monkeypatch, most):
    random = np.random.default_rng(most)
    letters = list("abé")
    base = ["".join(random.choice(letters, random.integers(7, 10))) for _ in range(120)] + ["a" * k for k in (7, 8, 9, 70, 71, 200, 201)]
    base += ["ab" * 100 + c + "b" * 40 for c in ("", "a", "é", "aa")]
    words = [w for k, w in enumerate(base) for _ in range(int(random.integers(1, 3)) * (30 if k % 11 == 0 else 1))]
    rows = [(k, " ".join(words[k::7])) for k in range(7)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert told_variants(spelling.spelling_variants(df, None, most)) == plain_variants(plain_vocabulary(rows, False))


def test_forms_are_followed_to_the_last(spark):
    words = ["aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb"]
    rows = [(k, " ".join([w] * 2 * 11**k)) for k, w in enumerate(words)]
    got = {r.word: (r.form, r.root) for r in spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {w: (words[k + 1] if k < 3 else None, words[3]) for k, w in enumerate(words)}


def test_minimised_acceptor():
    words = ["station", "stations", "nation", "nations", "ration"]
    machine = spelling.Acceptor(words)
    assert len(machine.arcs) < sum(map(len, words)) / 2 and machine.common(machine.start, machine.start) and sorted(machine.common(machine.start, machine.start)) == sorted(words)
    found = {tuple(sorted(p)) for k in (6, 7) for p in machine.near_pairs(9, k)}
    assert found == {tuple(sorted(p)) for p in combinations(words, 2) if near(*p)}


# ---------------------------------------------------------------- periodic runs


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_digest(i, text):
    words = words_of(text)
    n, h = len(words), zlib.crc32(b"" if i is None else str(i).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    text = b" ".join(w for k, w in enumerate(words) if k not in gone)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return str((i, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest()))


def test_runs_of_odd_rows(spark, docs):
    more = [(k, " ".join(f"x{j % (3 + k % 5)}" if j > k % 9 else f"y{j}" for j in range(k)), None) for k in range(120)]
    df = docs.select("doc_id", "text", "source").union(spark.createDataFrame(more, "doc_id long, text string, source string"))
    got = sorted(str(tuple(r)) for r in periodic.periodic_digest(df).collect())
    assert got == sorted(plain_digest(i, t) for i, t, _ in ROWS + more)


@pytest.mark.parametrize("seed", range(5))
def test_runs_of_several_documents(seed):
    random = np.random.default_rng(seed)
    for _ in range(150):
        texts = []
        for _ in range(random.integers(1, 5)):
            words = random.integers(0, random.integers(1, 4), random.integers(0, 60))
            if len(words) > 8 and random.random() < 0.7:
                a, p = random.integers(0, len(words) // 2), random.integers(1, 12)
                words = np.array([w if k < a else words[min(a + (k - a) % p, len(words) - 1)] for k, w in enumerate(words)])
            texts.append(words.astype(np.int64))
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        got = [tuple(r) for r in periodic.find_runs(np.concatenate(texts), bounds).tolist()]
        assert got == sorted((s + at, s + at + n, q) for t, at in zip(texts, bounds) for s, n, q in plain_runs(t.tolist()))


def test_documents_longer_than_a_group(monkeypatch):
    monkeypatch.setattr(periodic, "WORDS", 10)
    texts = [b"a b a b a b a b a b a b c".split(), [], b"x x x x x x x".split(), b"y y y".split()]
    assert list(periodic._told(texts)) == [([(0, 12, 2)], b"a b c"), ([], b""), ([(0, 7, 1)], b"x"), ([], b"y y y")]


def test_wavelet_tree():
    random = np.random.default_rng(3)
    values = random.permutation(500)
    tree = periodic.WaveletTree(values, 9)
    low = random.integers(0, 499, 300)
    high = np.array([random.integers(a + 1, 501) for a in low])
    value, n = random.integers(0, 500, 300), np.array([random.integers(0, b - a) for a, b in zip(low, high)])
    assert tree.below(low, high, value).tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(low, high, value)]
    assert tree.nth(low, high, n).tolist() == [int(np.sort(values[a:b])[k]) for a, b, k in zip(low, high, n)]
