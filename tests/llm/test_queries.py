"""Each op query over the small tables against a plain rewrite of its contract."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash

from rowgate.llm import queries as Q

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(Q.tokenizer_path())


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def test_op1(spark, small):
    tk, want = tokenizer(), Counter()
    for i, t in small[1]:
        want[(i, tuple(tk.encode(t or "", add_special_tokens=False).ids + [1]))] += 1
    from rowgate.llm import packing

    docs = spark.read.parquet(f"{small[0]}/documents.parquet")
    pieces = packing.pack_documents(docs, Q.tokenizer_path(), 2048)
    got = pieces.collect()
    seq, parts = defaultdict(list), defaultdict(list)
    for p in got:
        assert p.length == len(p.ids) // 4 > 0
        seq[p.sequence_id].append((p.offset, p.length))
        parts[(p.doc_id, p.doc_tokens, p.start)].append([int.from_bytes(p.ids[k: k + 4], "little") for k in range(0, len(p.ids), 4)])
    padded = total = 0
    for s in seq.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 2048
        total += at
        padded += at if at & (at - 1) == 0 else 2048
    assert padded <= 1.02 * total
    assert total == sum(len(ids) * n for (_, ids), n in want.items())
    # every id of every document, once
    flat = Counter()
    for (doc, n, start), lists in parts.items():
        for ids in lists:
            for k, x in enumerate(ids):
                flat[(doc, n, start + k, x)] += 1
    expected = Counter()
    for (doc, ids), times in want.items():
        for k, x in enumerate(ids):
            expected[(doc, len(ids), k, x)] += times
    assert flat == expected
    digest = {(r.doc_id, r.start, r.length, r.ids_crc32) for r in Q.op1_packing(spark, small[0]).collect()}
    assert digest == {(p.doc_id, p.start, p.length, zlib.crc32(p.ids)) for p in got}


def brute_quality(text):
    t = (text or "").encode()
    w = WORD.findall(t)
    chars = sum(len(x.decode()) for x in w)
    lines = [x for x in t.split(b"\n") if WORD.search(x)]
    tri = Counter(tuple(w[i: i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if tri[tuple(w[i: i + 3])] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), chars, sum(t.count(c) for c in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")), len(lines) - len(set(lines)), len(hit), failed


def brute_kept(text):
    """The five rules, word by word."""
    n, chars, symbols, dup, _, failed = brute_quality(text)
    words = (text or "").encode().split()
    lines = [x for x in (text or "").encode().split(b"\n") if WORD.search(x)]
    wordlike = sum(any(c.isalpha() or ord(c) > 127 for c in w.decode()) for w in words)
    distinct = sum(len(set(words[k: k + 2000])) for k in range(0, n, 2000))
    bad = chars < 2 * n or chars > 15 * n or symbols * 10 > n or (dup >= 3 and dup * 10 > 3 * len(lines)) or wordlike * 10 < 7 * n or distinct * 20 < n
    return not failed and not bad


def test_op2(spark, small):
    got = rows(Q.op2_quality(spark, small[0]))
    assert [g[:7] for g in got] == sorted(((i, *brute_quality(t)) for i, t in small[1]), key=str)
    assert [(g[0], g[7]) for g in got] == [x[1] for x in sorted((str((i, *brute_quality(t), brute_kept(t))), (i, brute_kept(t))) for i, t in small[1])]
    assert any(g[7] for g in got)


def test_quality_verdicts_on_junk(spark):
    import random

    rnd = random.Random(3)
    few, many = [f"w{i}" for i in range(60)], [f"word{i}" for i in range(9000)]
    texts = [" ".join(rnd.choices(few, k=10_000)), " ".join(rnd.choices(few, k=1990)), " ".join(rnd.choices(many, k=10_000)), " ".join(rnd.choices(many, k=200)),
             " ".join(f"{i}" for i in range(300)), "\n".join(["same line of words here"] * 3 + [" ".join(rnd.choices(many, k=9)) for _ in range(6)]), "# * " * 20 + " ".join(rnd.choices(many, k=100)), "a " * 60]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    from rowgate.llm import quality

    got = {r.doc_id: r.quality.kept for r in quality.quality(docs).collect()}
    assert got == {i: brute_kept(t) for i, t in enumerate(texts)}
    assert [got[i] for i in range(5)] == [False, False, True, True, False]


def test_quality_estimates_are_marginal():
    from rowgate.llm import quality

    good, short = b" ".join(b"word%d" % i for i in range(80)), b"# # #"
    got = quality.estimate([short] * 9 + [good], {"symbols": quality.RULES["symbol_share"], "none": lambda f: False})
    assert got["symbols"][1] == got["none"][1] == 0  # only what passes the base rule counts


def brute_fingerprint(text):
    w = [x.decode() for x in WORD.findall((text or "").encode().lower())]
    sh = [" ".join(w[i: i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_op3(spark, small):
    fps = [(i, brute_fingerprint(t)) for i, t in small[1]]
    distinct = sorted({f for _, f in fps})
    group = {f: f for f in distinct}

    def root(f):
        while group[f] != f:
            f = group[f]
        return f

    for a in distinct:
        for b in distinct:
            if (a ^ b).bit_count() <= 4:
                group[root(a)] = root(b)
    least = {}
    for i, f in fps:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    want = sorted(((i, f"{f:016x}", least.get(root(f))) for i, f in fps), key=str)
    assert rows(Q.op3_simhash(spark, small[0])) == want
    assert any(w[0] != w[2] for w in want)


def test_op4(spark, small):
    got = Q.op4_toxicity(spark, small[0]).collect()
    assert len(got) == len(small[1])
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert rows(Q.op4_toxicity(spark, small[0])) == sorted(map(tuple, got), key=str)


def test_op4_does_not_depend_on_the_order_of_rows(spark):
    from rowgate.llm import toxicity

    docs = [(i % 40, f"good calm text number{i % 7} here" if i % 3 else f"vile nasty text number{i % 5} here") for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(40)], "doc_id long, toxic int")
    models = [toxicity.train(spark.createDataFrame(d, "doc_id long, text string").repartition(n), labels) for d, n in ((docs, 1), (docs[::-1], 5))]
    scored = [rows(toxicity.score(spark.createDataFrame(docs, "doc_id long, text string"), m)) for m in models]
    assert scored[0] == scored[1]


@pytest.mark.parametrize("name", list(Q.ORACLE))
def test_oracles_on_awkward_rows(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small[0]}/{t}.parquet/*.parquet')")
    got = Q.QUERIES[name](spark, small[0])
    rel = con.sql(Q.ORACLE[name])
    cols = sorted(got.columns)
    assert cols == sorted(rel.columns)
    want = sorted((tuple(r) for r in rel.select(*cols).fetchall()), key=str)
    assert rows(got.select(*cols)) == want


def brute_repeats(docs, width=35):
    words = [(i, WORD.findall((t or "").encode())) for i, t in docs]
    count = Counter(tuple(w[j: j + width]) for _, w in words for j in range(len(w) - width + 1))
    for i, w in words:
        gone = {q for j in range(len(w) - width + 1) if count[tuple(w[j: j + width])] > 1 for q in range(j, j + width)}
        yield i, len(w), len(gone), sha(b" ".join(x for k, x in enumerate(w) if k not in gone))


def test_op7(spark, small):
    assert rows(Q.op7_substrings(spark, small[0])) == sorted(brute_repeats(small[1]), key=str)


def test_op7_with_many_repeated_rows(spark):
    words = [f"w{i}" for i in range(120)]
    rows_ = [(1, " ".join(words))] * 3000 + [(2, " ".join(words[:60])), (3, " ".join(words[50:80])), (4, "alone " + " ".join(words[40:80]))]
    docs = spark.createDataFrame(rows_, "doc_id long, text string").repartition(6)
    from rowgate.llm import substrings

    got = rows(substrings.remove_repeats(docs, 35, kept_text=False).drop("kept"))
    assert got == sorted(brute_repeats(rows_), key=str)


def folded(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def test_op8(spark, small):
    where = defaultdict(set)
    for item, t in small[2]:
        w = folded(t)
        for j in range(max(1, len(w) - 12) if w else 0):
            where[tuple(w[j: j + 13])] |= set() if item is None else {str(item)}
    want = []
    for i, t in small[1]:
        w, hit, items = folded(t), set(), set()
        for win, ids in where.items():
            for j in range(len(w) - len(win) + 1):
                if tuple(w[j: j + len(win)]) == win:
                    hit |= set(range(j, j + len(win)))
                    items |= ids
        want.append((i, len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit) and 20 * len(hit) >= len(w)))
    assert rows(Q.op8_decontam(spark, small[0])) == sorted(want, key=str)
    assert any(x[5] for x in want)


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def brute_secrets(t):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(found)


def test_op9(spark, small):
    want, spans = [], {}
    for i, t in small[1]:
        b = brute_secrets(t or "")
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{z}" for a, k, z in b)
        want.append((i, *[sum(x[1] == k for x in b) for k in range(3)], sha(text), text))
    got = rows(Q.op9_secrets(spark, small[0]))
    assert [g[:5] for g in got] == [w[:5] for w in sorted(want, key=str)]
    texts = Counter((w[0], w[5]) for w in want)
    extra = 0
    for g in got:
        listed = g[5].split(",") if g[5] else []
        extra += sum(x.startswith("random") for x in listed)
        assert texts[(g[0], ",".join(x for x in listed if not x.startswith("random")))] > 0
    assert extra > 0 and not spans


def test_op10(spark, small):
    tk = tokenizer()
    want = [(i, len((t or "").encode()), n := len(tk.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t in small[1]]
    assert rows(Q.op10_tokens(spark, small[0])) == sorted(want, key=str)


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_empty_tables(spark, small, nothing, name):
    out = Q.QUERIES[name](spark, nothing)
    assert out.count() == 0
    assert out.schema == Q.QUERIES[name](spark, small[0]).schema
