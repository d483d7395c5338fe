"""Jaccard links, whitened embeddings and phrases against brute force, on small random tables with small bounds."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from gridclim.llm import collocations, jaccard, whitening

DOCS = "doc_id long, text string, tokens string, set_id long, root long, n long"


def edited(words, share, rnd):
    return " ".join(f"x{rnd.randrange(10**6)}" if rnd.random() < share else w for w in words)


def copies(seed):
    """Bases with near copies of many degrees, a passage that all share, and odd rows."""
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for b in range(12):
        base = [f"w{rnd.randrange(300)}" for _ in range(rnd.choice((5, 12, 40, 90, 300)))]
        if b % 3 == 0:
            base = base[: len(base) // 8] + passage + base[len(base) // 8 :][:8]
        texts += [edited(base, rnd.choice((0, 0.005, 0.01, 0.02, 0.04)), rnd) for _ in range(rnd.choice((1, 3, 14)))]
    texts += [None, "", " \n", "one", "ONE", "one two", "One\ttwo", "one two three", "a b c d", "A b c D", "é É ß", "é é ß"]
    return [(i, t) for i, t in enumerate(texts)]


def brute_components(rows, percent, shingle):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + shingle]) for k in range(max(len(w) - shingle, 0) + 1)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            same = len(sets[i] & sets[j])
            if j < i and sets[i] and sets[j] and 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("seed", "percent", "shingle", "small"), [(1, 85, 4, False), (2, 85, 4, True), (3, 80, 5, True), (4, 60, 2, True), (5, 100, 3, True)])
def test_jaccard_components(spark, monkeypatch, seed, percent, shingle, small):
    if small:  # pairs, triples and blocks on a small table
        for name, value in {"FREQUENT": (3, 6), "PAIRED": 3, "BLOCK_TOKENS": 700, "WIDTH": 64, "BROADCAST": 0}.items():
            monkeypatch.setattr(jaccard, name, value)
    rows = copies(seed)
    docs = spark.createDataFrame([(i, t, "k", 7, 8, 9) for i, t in rows], DOCS).repartition(5)
    got = jaccard.near_duplicates(docs, percent, shingle).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, percent, shingle)
    assert all((r.tokens, r.set_id, r.root, r.n) == ("k", 7, 8, 9) for r in got)
    assert len({r.component_id for r in got}) < len(rows) - 5


def test_merged_entries_keep_every_pair(spark):
    rng = random.Random(5)
    alike = [(sig, x) for sig in range(30) for x in rng.sample(range(40), 36)]
    apart = [(100 + sig, x) for sig in range(30) for x in (5007, *range(1000 + 10 * sig, 1010 + 10 * sig))]
    rows = [(sig, x, x, 10) for sig, x in alike + apart]
    members = spark.createDataFrame(rows, "sig long, set_id long, comp long, n long")
    found = [(r.sig, r.set_id, r.comp, r.n) for r in jaccard._merged(members).collect()]

    def pairs(rows):
        by = {}
        for sig, x, *_ in rows:
            by.setdefault(sig, set()).add(x)
        return {p for own in by.values() for p in combinations(sorted(own), 2)}

    assert pairs(rows) <= pairs(found)
    assert len(found) < len(rows) - len(alike) // 2 and len(set(found)) == len(found)


def test_members_of_large_entries_are_not_joined(spark, monkeypatch):
    """Near copies that share many entries: joins make rows for sets and pairs of sets, not one for each set and entry."""
    rnd = random.Random(7)
    common = rnd.sample(range(10**6, 2 * 10**6), 80)
    held = {i: np.sort(np.array(rnd.sample(common, 72) + [10 * i + j for j in range(rnd.choice((0, 8)))])) for i in range(1, 161)}
    sigs = list(range(100))
    rows = [(i, len(t), t.tobytes(), rnd.sample(sigs, 95)) for i, t in held.items()]
    sets = spark.createDataFrame(rows, "set_id long, n long, tokens binary, sigs array<long>")
    made, kind = [], type(sets)
    join = kind.join

    def counted(self, *args, **named):
        made.append((out := join(self, *args, **named)).count())
        return out

    monkeypatch.setattr(kind, "join", counted)
    links = [(r.a, r.b) for r in jaccard._links(sets, 85).collect()]
    monkeypatch.undo()
    assert sum(len(r[3]) for r in rows) == 15_200 and max(made) < 2_000
    root = {i: i for i in held}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    def connect(pairs):
        root.update({i: i for i in held})
        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return [find(i) for i in held]

    linked = [(a, b) for a, b in combinations(held, 2) if 100 * (same := len(np.intersect1d(held[a], held[b]))) >= 85 * (len(held[a]) + len(held[b]) - same)]
    assert connect(links) == connect(linked) and 1 < len(set(connect(linked))) < 120


def test_signatures_of_linked_sets_meet(monkeypatch):
    """Sets that link share an index entry, whatever the frequencies are."""
    monkeypatch.setattr(jaccard, "FREQUENT", (4, 20))
    rnd = random.Random(0)
    df = {t: rnd.choice((2, 3, 5, 9, 30, 900)) for t in rnd.sample(range(10**9), 3000)}
    every = sorted(df, key=lambda t: (df[t], t))
    for _ in range(300):
        n = rnd.choice((1, 2, 6, 7, 31, 40, 64, 70, 127, 130, 300))
        percent = rnd.choice((60, 85, 95))
        a = set(rnd.sample(every, n))
        b = (a - set(rnd.sample(sorted(a), jaccard.spare(n, percent) // 2))) | set(rnd.sample(every, rnd.randrange(jaccard.spare(n, percent) // 2 + 1)))
        if 100 * len(a & b) < percent * len(a | b):
            continue
        found = []
        for s in (a, b):
            own = sorted(s, key=lambda t: (df[t], t))
            found.append(set(jaccard.signatures(own, [df[t] for t in own], len(own), percent)))
        assert found[0] & found[1]


def test_jaccard_of_odd_rows(spark):
    rows = [(1, "a b c d e f g"), (None, "a b c d e f g"), (None, "q r s t u"), (None, None), (2, ""), (3, "A b c d e f g"), (3, "other words than those"), (3, "other words than those")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.near_duplicates(docs, 85, 4).collect())
    assert got == sorted([("1", 4, "1"), ("None", 4, "1"), ("None", 2, "None"), ("None", 0, "None"), ("2", 0, "2"), ("3", 4, "1"), ("3", 1, "3"), ("3", 1, "3")])
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0
    long = " ".join(f"w{i}" for i in range(400_000))  # megabytes in one text
    docs = spark.createDataFrame([(1, long), (2, long + " more"), (3, long[:1000])], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3}


def vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((n, d)) * np.linspace(3, 0.5, d) @ np.linalg.qr(rng.standard_normal((d, d)))[0] + 5


@pytest.mark.parametrize(("n", "d", "k"), [(400, 8, 32), (900, 40, 6), (500, 150, 20), (30, 50, 32), (200, 1, 3)])
def test_whitening_against_a_dense_solution(spark, n, d, k):
    v = vectors(n, d)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), k).toPandas()
    x = np.floor(64 * v).astype(np.int64) + 1_000_000
    centred = x - x.mean(axis=0)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    real = min(k, int((e > 1e-12 * e[0]).sum()))
    assert sorted(got.component.unique()) == list(range(1, real + 1)) and len(got) == n * real
    w = got.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    want = centred @ u[:, :real] / np.sqrt(e[:real])
    want = want * np.sign((want * w).sum(axis=0))
    assert np.abs(w - want).max() < 1e-7
    assert np.allclose(got.groupby("component").explained.first(), e[:real] / e.sum(), rtol=1e-9)
    assert got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1
    exact = [sum(int(y) ** 2 for y in row) for row in n * x.astype(object) - x.sum(axis=0)]
    assert got.groupby("vec_id").deviation.first().tolist() == exact


def test_jacobi_davidson_needs_few_products_and_meets_close_values():
    rng = np.random.default_rng(1)
    d = 300
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = np.sort(np.concatenate([[50, 50, 50, 49.999999, 30], rng.random(d - 5) * 20]))[::-1]
    a = q * values @ q.T
    calls = []

    def product(u):
        calls.append(u.shape[1])
        return a @ u

    found, u = whitening.jacobi_davidson(product, d, 12)
    assert np.abs(found - values[:12]).max() < 1e-11 and np.linalg.norm(a @ u - u * found, axis=0).max() < 1e-11
    assert np.abs(u.T @ u - np.eye(12)).max() < 1e-13 and len(calls) < 250


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 30))
    a, b = a + a.T, rng.standard_normal((30, 4))
    b[:, 3] = 0
    x = whitening.minres(lambda t: a @ t, b, 60, 1e-13)
    assert np.abs(a @ x - b).max() < 1e-8


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []), (7, [1.0, 2.0, 3.0]), (None, [2.0, 1.0]), (1, [1.0, 2.0]), (8, [0.0, 0.5])]
    table = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, component int, n double")
    got = whitening.whiten(table).collect()
    assert Counter(r.vec_id for r in got) == {1: 4, None: 2, 8: 2} and {r.n for r in got} == {4}
    assert whitening.whiten(table.where("vec_id in (2, 3)")).count() == 0
    assert whitening.whiten(table.where("vec_id = 1")).count() == 0  # no variance
    assert whitening.whiten(table.limit(0)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    with pytest.raises(Exception, match="2\\^34"):
        whitening.whiten(spark.createDataFrame([(1, [1e12, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")).count()


def brute_phrases(rows, top, least, covered):
    counts, out = {}, []
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    counts.setdefault(lang or "und", Counter())[tuple(w[i : i + m])] += 1
    for lang, f in counts.items():
        n = sum(a for p, a in f.items() if len(p) == 1)
        own = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {q for p, a in own.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= covered * f[q := p[i : i + m]]}
        scored = []
        for p, a in own.items():
            s, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if p not in dropped:
                scored.append((-s, -a, " ".join(p).encode(), lang, a, f[p[:k]], f[p[k:]], n, s))
        out += [(x[3], i, x[2].decode(), *x[4:]) for i, x in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def prose(seed):
    rnd = random.Random(seed)
    rows = []
    for _ in range(160):
        words = []
        for _ in range(rnd.randrange(80)):
            words += rnd.choice((["New", "york"], ["new", "york", "city"], ["the"], ["The", "end"], ["in", "the", "long", "run"], ["long", "run"], [f"w{int(rnd.paretovariate(0.8))}"], ["été"], [rnd.choice(".,;:!?\n\r\t")], ["the", "city"]))
        rows.append((rnd.choice(("en", "en", "de", None, "und")), " ".join(words)))
    return [*rows, ("en", None), ("xx", ""), (None, None), ("en", " \t\n..")]


@pytest.mark.parametrize(("seed", "top", "least"), [(1, 3, 3), (2, 8, 2), (3, 1, 10), (4, 2000, 2), (5, 2000, 30), (6, 15, 1)])
def test_phrases_against_brute_force(spark, monkeypatch, seed, top, least):
    monkeypatch.setattr(collocations, "CHUNK", 700)
    rows = prose(seed)
    docs = spark.createDataFrame([(*r, 5, "r") for r in rows], "lang string, text string, w1 int, phrase string").repartition(4)
    got = sorted(tuple(r) for r in collocations.mine(docs, top, least).collect())
    assert got == brute_phrases(rows, top, least, 80)


def test_bounds_are_never_below_the_scores_they_bound(spark):
    docs = spark.createDataFrame(prose(7), "lang string, text string")
    stored = collocations.encode(docs)
    counts = {m: collocations.count_phrases(stored, m) for m in (1, 2, 3, 4)}
    for m in (2, 3):
        bound = {(r[0], *r[1 : m + 1]): r.bound for r in collocations._bounded(counts[m], counts, m, 1).collect()}
        for longer in range(m + 1, 5):
            for r in collocations._scored(counts[longer], longer, counts, 1).collect():
                assert r.score <= bound[r.lang, *(r[f"w{i}"] for i in range(1, m + 1))]


def test_scores_are_exact_beyond_64_bits(spark):
    a = 9_000_000_000_000_007
    got = spark.sql(f"select {a}L as a, {3 * a - 11}L as b")
    assert got.select(collocations.score(got.a, got.b).alias("s")).first().s == 2_000_000 * a // (3 * a - 11)


def test_phrases_of_a_very_long_text(spark):
    text = "alpha beta gamma. " * 300_000
    docs = spark.createDataFrame([("en", text), ("en", "x" * 5_000_000), (None, None)], "lang string, text string")
    got = collocations.mine(docs).collect()
    assert [(r.phrase, r.a, r.score) for r in got] == [("alpha beta gamma", 300_000, 1_000_000)]
    assert collocations.mine(docs.limit(0)).count() == 0
