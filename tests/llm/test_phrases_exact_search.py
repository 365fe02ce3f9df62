"""Phrases, exact duplicates and lexical search against plain rewrites, with parameters
small enough that every path is taken."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rowgate.llm import exact, phrases, search

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_phrases(rows, most, longest, least, cover):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        cands = {g: a for g, a in count.items() if len(g) > 1 and a >= least}
        covered = set()
        for g, a in cands.items():
            for k in range(2, len(g)):
                covered |= {g[i: i + k] for i in range(len(g) - k + 1) if 100 * a >= cover * cands[g[i: i + k]]}
        kept = []
        for g, a in cands.items():
            if g not in covered:
                cuts = [(1000000 * a * a // (count[g[:k]] * count[g[k:]]), k) for k in range(1, len(g))]
                score, k = min(cuts)
                kept.append((-score, -a, " ".join(g).encode(), count[g[:k]], count[g[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def phrase_rows(seed=3):
    rnd = random.Random(seed)
    words = ["Ab", "b", "c", "été", "d\x00e", "日本", "x.", "y!", "z\n", "q\x1cq", "b:", "-", "to\t"]
    rows = [(rnd.choice(["en", "fr", None, "und"]), " ".join(rnd.choices(words, weights=[9, 8, 7, 3, 2, 2, 3, 1, 1, 1, 1, 1, 1], k=rnd.choice([1, 4, 20, 60])))) for _ in range(120)]
    return rows + [("en", None), (None, ""), ("en", "  \t "), ("en", "ab b c " * 300), ("de", "...,,"), rows[0], rows[0]]


@pytest.mark.parametrize("how", [dict(), dict(longest=4, least=3, cover=70), dict(longest=2, least=1, most=7), dict(longest=3, least=2, cover=101, most=50)])
def test_phrases(spark, how):
    rows = phrase_rows()
    docs = spark.createDataFrame([(i, lang, t, 1, "x") for i, (lang, t) in enumerate(rows)], "n long, lang string, text string, rank int, phrase string").repartition(4)
    want = brute_phrases(rows, how.get("most", 2000), how.get("longest", 3), how.get("least", 10), how.get("cover", 50))
    assert len(want) > 5
    for part_rows in (phrases.PART_ROWS, 7):  # one range, many ranges
        got = phrases.collocations(docs, part_rows=part_rows, **how)
        assert sorted(map(tuple, got.collect())) == want


def test_phrases_with_products_past_64_bits(spark):
    a = spark.range(1).selectExpr("4000000000000L a", "5000000000000L l", "6000000000000L r")
    assert a.select(phrases._score(a.a, a.l, a.r)).first()[0] == 1000000 * 4 * 4 // 30


def test_ranges_repeat_what_they_begin_inside():
    import pyarrow as pa

    runs = [b"a", b"a\0b", b"a\0b\0c", b"a\0b\0d", b"a\0e", b"b"]
    cuts = type("B", (), {"value": [("en", b"a\0b\0d")]})
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 6), pa.array(runs, pa.binary()), pa.array([50, 40, 11, 30, 10, 45], pa.int64())], names=["lang", "run", "n"])
    dealt = next(phrases._Deal(cuts, 3, False)(iter([batch])))
    rows = sorted(zip(*(dealt.column(c).to_pylist() for c in ("part", "lang", "key", "n", "again"))))
    assert [r[2] for r in rows if r[4]] == [b"a", b"a\0b"]
    table = pa.table(dict(zip(("part", "lang", "key", "n", "again"), map(list, zip(*rows)))))
    out = [r for b in phrases._Lockstep(False)(iter(table.to_batches())) for r in b.to_pylist()]
    whole = {r["run"]: (r["n"], r["parts"]) for r in out if r["n"] is not None}
    assert whole == {b"a\0b": (40, [50]), b"a\0b\0c": (11, [50, 40]), b"a\0b\0d": (30, [50, 40]), b"a\0e": (10, [50])}
    assert max(r["most"] for r in out if r["run"] == b"a\0b") == 30


def test_fingerprints_compose():
    poly, data = exact.Poly(64), random.Random(1).randbytes(61)
    for cut in (0, 1, 30, 61):
        assert poly.join(poly.of(data[:cut]), poly.of(data[cut:]), len(data) - cut) == poly.of(data)
    for k, base in enumerate(exact.BASES):
        assert poly.of(data)[k] == sum(b * pow(base, len(data) - 1 - i, exact.PRIME) for i, b in enumerate(data)) % exact.PRIME


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for t, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is None, -(i or 0)))
        out += [(i, order[0], len(ids), n == 0, hashlib.sha256(t.encode()).hexdigest()) for n, i in enumerate(order)]
    return sorted(out, key=str)


def exact_rows():
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("abAB é") for _ in range(rnd.choice([0, 1, 2, 3, 40, 200]))) for _ in range(150)]
    rows = [(i, rnd.choice([t, t.upper(), t.lower()])) for i, t in enumerate(texts * 2)]
    rows += [(1000, "hot") for _ in range(3)] + [(i, "HOT" if i % 2 else "hot") for i in range(1001, 1400)]
    rows += [(None, None), (None, ""), (7, None), (None, "only null"), (None, "ONLY null"), (5, "ÀB"), (6, "àb")]
    long = "x" * 5000
    return rows + [(2000, long), (2001, long[:-1] + "X"), (2002, long[:-1] + "y"), (2003, long)]


# the small primes make texts of one length collide, so that groups must be split
@pytest.mark.parametrize("how", [dict(), dict(chunk=16), dict(chunk=16, prime=3, bases=(2, 2)), dict(chunk=4, prime=2, bases=(1, 1))])
def test_exact(spark, how, monkeypatch):
    monkeypatch.setattr(exact, "BLOCK", 32)
    rows = exact_rows()
    docs = spark.createDataFrame([(i, t, "e", 3, True) for i, t in rows], "doc_id long, text string, dedup string, row int, kept boolean").repartition(5)
    found = exact.duplicates(docs, **how)
    got = sorted((tuple(r) for r in found.select("doc_id", "dedup_.keep_id", "dedup_.group_size", "dedup_.kept", "dedup_.text_sha256").collect()), key=str)
    assert got == brute_exact(rows)
    assert found.columns == [*docs.columns, "dedup_"]
    if not how:
        stay = exact.distinct_documents(docs)
        assert stay.columns == docs.columns and stay.count() == sum(w[3] for w in got)


def brute_search(docs, items, most):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    vectors = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    vectors = [v for v in vectors if v[2]]
    big_n, big_l = len(vectors), sum(v[2] for v in vectors)
    df = Counter(w for v in vectors for w in v[1])
    out = []
    for item, text in items:
        found = []
        for i, tf, n in vectors:
            m, s = 25 + (75 * n * big_n) // big_l, 0
            for w in terms(text):
                if tf[w]:
                    s += math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1))) * ((1000000000 * tf[w]) // (1000 * tf[w] + 8 * m))
            if s > 0:
                found.append((-s, i is None, i if i is not None else 0, i))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found, key=lambda f: f[:3])[:most], 1)]
    return sorted(out, key=str)


def search_rows():
    rnd = random.Random(9)
    vocab = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(3000)]
    docs = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([1, 3, 20, 200])))) for i in range(500)]
    docs += [(1000 + i, docs[3][1].upper()) for i in range(200)] + [docs[7], docs[7], (None, docs[3][1]), (None, None), (9, ""), (10, "..."), (11, "été Été 日本")]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([1, 5, 30])))) for i in range(30)]
    return docs, items + [(100, docs[3][1]), (101, None), (102, "--"), (None, "w1 w2 w2"), (103, "nowhere"), (100, docs[3][1]), (104, "ÉTÉ été 日本")]


@pytest.mark.parametrize("how", [dict(), dict(max_terms=5, most=3)])
def test_search(spark, how, monkeypatch):
    monkeypatch.setattr(search, "LEAF", 8)
    monkeypatch.setattr(search, "BLOCK", 100)
    docs, items = search_rows()
    frame = spark.createDataFrame([(i, t, 1, 2.0) for i, t in docs], "doc_id long, text string, rank int, score double").repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, id int")
    got = search.search(frame, asked, **how)
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, items, how.get("most", 10))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]


def test_trees_bound_their_documents():
    rnd = np.random.default_rng(2)
    tf = (rnd.random((400, 12)) < np.linspace(0.9, 0.05, 12)).astype(np.int32) * rnd.integers(1, 9, (400, 12), dtype=np.int32)
    m = rnd.integers(25, 900, 400)
    tree = search.Tree(tf, m, leaf=4)
    ranks, weights = np.array([0, 3, 7, 11]), np.array([10, 200, 3000, 9000])
    bound = tree.bounds(ranks, weights)
    leaves = [i for i, c in enumerate(tree.children) if not c]
    assert sorted(d for i in leaves for d in range(*tree.span[i])) == list(range(400))
    for i, c in enumerate(tree.children):
        assert tree.scores(i, ranks, weights).max() <= bound[i]
        assert not c or sorted(tree.span[x] for x in c) == [tree.span[x] for x in c]
    every = search.parts_of_score(tf[:, ranks].astype(np.int64), m[:, None]) @ weights
    best: list = []
    tree.search(ranks, weights, best, 10, list(range(400)))
    assert best == sorted((-int(s), False, i) for i, s in enumerate(every) if s)[:10]


@pytest.mark.parametrize("n", [1 << 20, 1 << 40])
def test_length_factor(n):
    got = search.length_factor(np.array([0, 3, n], np.int64), 10**9, 10**14)
    assert got.tolist() == [25 + 75 * x * 10**9 // 10**14 for x in (0, 3, n)]
