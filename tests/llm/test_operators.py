"""Parts of the operators on their own: methods, bounds and hot groups."""

import itertools
import random
import re
import types
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowgate.llm import decontam, kk, packing, quality, secrets, simhash, substrings, tokens, toxicity, warc
from rowgate.llm import queries as Q


@pytest.mark.parametrize("seed", range(5))
def test_differencing(seed):
    rnd = random.Random(seed)
    sizes = [rnd.randint(1, 512) for _ in range(rnd.randint(1, 400))]
    for k in (1, 2, 7, 50):
        sets = kk.partition(sizes, k)
        assert len(sets) == k and sorted(itertools.chain(*sets)) == list(range(len(sizes)))
    packed = kk.pack(sizes, 2048)
    assert sorted(itertools.chain(*packed)) == list(range(len(sizes)))
    assert max(sum(sizes[i] for i in s) for s in packed) <= 2048
    assert kk.partition([8, 7, 6, 5, 4], 2) and sorted(sum([8, 7, 6, 5, 4][i] for i in s) for s in kk.partition([8, 7, 6, 5, 4], 2)) == [14, 16]
    assert kk.pack([], 10) == []
    with pytest.raises(ValueError):
        kk.pack([11], 10)


def test_packing_needs_a_power_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack_documents(spark.createDataFrame([(1, "a")], "doc_id long, text string"), Q.tokenizer_path(), 1000)


def test_cascade_order_does_not_change_verdicts(spark, small):
    docs = spark.read.parquet(f"{small[0]}/documents.parquet").select("doc_id", "text")
    names = list(quality.RULES)
    got = [sorted(map(str, quality.quality(docs, list(p)).select("doc_id", "quality").collect())) for p in (names, names[::-1])]
    assert got[0] == got[1]
    assert quality.order({"a": (1.0, 0.1), "b": (0.1, 0.1), "c": (0.01, 0.0)}) == ["b", "a", "c"]
    # an expensive rule is not run on what a cheaper one rejects
    f = quality.Features(b"# $ % & | " * 40 + b" ".join(b"w%d" % i for i in range(60)))
    cascade = [quality.RULES["symbol_share"], quality.RULES["distinct_share"]]
    assert any(r(f) for r in cascade) and "n_distinct" not in f.__dict__


def test_pigeonring_masks_miss_no_link():
    rnd, keys = random.Random(3), simhash.masks()
    assert sum(simhash.segments()) == (1 << 64) - 1
    for _ in range(20_000):
        x = sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, simhash.LIMIT)))
        assert any(x & k == 0 for k in keys)
    a = np.array([rnd.getrandbits(64) for _ in range(200)], np.uint64)
    b = a ^ np.array([sum(1 << q for q in rnd.sample(range(64), rnd.randint(0, 8))) for _ in a], np.uint64)
    assert (simhash.linked(a[:, None], b[None, :]) == (np.bitwise_count(a[:, None] ^ b[None, :]) <= simhash.LIMIT)).all()


def _components(fps):
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in itertools.combinations(fps, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {f: root(f) for f in fps}


def test_hot_key_is_split_without_losing_links(spark, run_root):
    """Many fingerprints around one, so that keys hold far more than a block."""
    rnd = random.Random(9)
    base = rnd.getrandbits(60)
    fps = sorted({base ^ sum(1 << b for b in rnd.sample(range(20), rnd.randint(0, 6))) for _ in range(400)} | {rnd.getrandbits(62) for _ in range(50)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.u: r.v for r in simhash.components(simhash.links(df, block=16), run_root).collect()}
    assert {f: got.get(f, f) for f in fps} == _components(fps)


def _near_groups(ids, texts, limit=4):
    """id -> smallest id linked with it by fingerprints within ``limit`` bits."""
    fps, parent = [simhash.fingerprint((t or "").encode()) for t in texts], list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= limit:
            parent[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(d, least.get(root(i), d))
    return {d: least[root(i)] for i, d in enumerate(ids)}


def test_near_copies(spark):
    """Copies with few and many changes, a chain of them, a group around one text and a
    passage that many texts share; the pipeline's stage keeps one of each group."""
    rnd = random.Random(21)
    vocab = [f"v{i}" for i in range(3000)]
    passage = rnd.sample(vocab, 40)
    texts = []
    for _ in range(25):
        w = rnd.sample(vocab, rnd.randint(30, 300)) + passage
        texts.append(" ".join(w))
        for share in (0.005, 0.01, 0.02, 0.03):
            texts.append(" ".join("changed" if rnd.random() < share else x for x in w))
    chain = rnd.sample(vocab, 400)
    texts += [" ".join(chain[k: k + 200]) for k in range(0, 200, 20)]
    centre = rnd.sample(vocab, 200)
    texts += [" ".join(x if rnd.random() > 0.01 else rnd.choice(vocab) for x in centre) for _ in range(60)]
    texts += [None, "", " \n", "One two", "one  TWO", "one two three"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    want = _near_groups(range(len(texts)), texts)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got == want and 10 < len(set(want.values())) < len(want) - 10
    import corpus_pipeline

    kept = corpus_pipeline.one_of_each(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want.values()))


@pytest.mark.parametrize("limit", [0, 2, 6])
def test_other_limits_miss_no_link(limit):
    rnd, keys = random.Random(limit), simhash.masks(limit)
    assert sum(simhash.segments(limit)) == (1 << 64) - 1
    for _ in range(2000):
        x = sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, limit)))
        assert any(x & k == 0 for k in keys)


def test_long_chain_is_one_component(spark, run_root):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "u long, v long")
    got = {r.u: r.v for r in simhash.components(edges, run_root).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {1001: 1000}


def test_toxicity_counterfactuals_ease_neutral_mentions():
    rnd = random.Random(2)
    plain = [f"w{i}" for i in range(200)]
    rows, y, sentences = [], [], []
    for n in range(600):
        toxic = n % 3 == 0
        w = rnd.sample(plain, 20) + (["vile"] if toxic and rnd.random() < 0.9 else [])
        if rnd.random() < (0.8 if toxic else 0.05):  # the group is named mostly in toxic texts
            w.append("muslims")
            sentences.append(w)
        rows.append(w)
        y.append(float(toxic))
    loose = toxicity.fit(rows, np.array(y), sentences, penalty=0.0)
    tight = toxicity.fit(rows, np.array(y), sentences, penalty=10.0)
    neutral = rnd.sample(plain, 20) + ["muslims"]
    assert abs(tight.word("muslims")) < 0.3 * abs(loose.word("muslims"))
    assert tight.logit(neutral) < loose.logit(neutral)
    assert tight.logit(neutral) < 0 < tight.logit(neutral + ["vile"])
    assert toxicity.swaps(["a", "b"], toxicity.IDENTITY) == []
    assert ["men"] in toxicity.swaps(["women"], toxicity.IDENTITY)


def test_toxicity_cut_of_the_classes_keeps_their_mix(spark):
    """The more frequent class is cut to as many texts as the other has: scores stay."""
    rnd = random.Random(6)
    plain = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(rnd.sample(plain, 15) + ["vile"] * (rnd.random() < (0.8 if i % 10 == 0 else 0.02)))) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in rows], "doc_id long, toxic int")
    whole, cut = (toxicity.train(docs, labels, per_class=n) for n in (2000, 150))
    assert "=vile" in whole.weights and "=vile" in cut.weights
    assert abs(whole.intercept - cut.intercept) < 0.3


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = Q.op4_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    c = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    # some labels are toxic for texts without any toxic word
    assert c.get((1, 1), 0) >= 0.85 * (c.get((1, 1), 0) + c.get((1, 0), 0))
    assert c.get((0, 1), 0) <= 0.01 * (c.get((0, 1), 0) + c.get((0, 0), 0))


def test_no_labels_of_one_class():
    m = toxicity.fit([["a"], ["b"]], np.array([0.0, 0.0]), [])
    assert m.weights == {} and m.logit(["a"]) < 0


def test_warc_round_trip_and_dictionary_frame(spark, small, run_root):
    pages = spark.read.parquet(f"{small[0]}/pages.parquet")
    manifest = warc.write_archives(pages, run_root, archive_bytes=2000)
    total = manifest.agg(F.sum("records"), F.count("archive")).first()
    assert total[0] == pages.count() and total[1] > 3
    back = warc.read_archives(spark, run_root)
    want = sorted((str(r.page_id), r.html or "") for r in pages.collect())
    response = {(r.payload_digest): r.html for r in back.where("record_type = 'response'").collect()}
    assert sorted((str(r.page_id), response[r.payload_digest]) for r in back.collect()) == want
    raw = spark.read.format("binaryFile").load(f"{run_root}/archives").first().content
    assert int.from_bytes(raw[:4], "little") == warc.MAGIC
    # writing again under the same names replaces the archives
    warc.write_archives(pages, run_root, archive_bytes=2000)
    assert warc.read_archives(spark, run_root).count() == pages.count()


def test_warc_dictionary_is_drawn_from_the_whole_table(spark, monkeypatch):
    import zstandard

    drawn, real = [], zstandard.train_dictionary
    monkeypatch.setattr(zstandard, "train_dictionary", lambda size, samples: drawn.extend(samples) or real(size, samples))
    pages = spark.range(0, 9000, 1, 3).selectExpr("id AS page_id", "CONCAT('http://s', id DIV 3000, '/', id) AS url", "REPEAT(CONCAT('<p>', id, '</p>'), 20) AS html")
    words = warc.dictionary(pages, "1970-01-01T00:00:00Z")
    sites = [sum(f"http://s{n}/".encode() in d for d in drawn) for n in range(3)]
    assert words and min(sites) > 200 and sum(sites) < 2 * warc.SAMPLE_RECORDS
    drawn.clear()
    warc.dictionary(pages.where("page_id < 20"), "1970-01-01T00:00:00Z")
    assert len(drawn) == 20
    assert warc.dictionary(pages.where("page_id < 0"), "1970-01-01T00:00:00Z") == b""


def test_warc_payloads_below_the_least_size_are_responses(spark, small, run_root):
    pages = spark.read.parquet(f"{small[0]}/pages.parquet")
    warc.write_archives(pages, run_root, min_bytes=12)
    back = warc.read_archives(spark, run_root)
    assert back.where("payload_bytes < 12 and record_type = 'revisit'").count() == 0
    assert back.where("record_type = 'revisit'").count() > 0


@pytest.mark.parametrize("cells", [1 << 16, 1 << 4])
def test_sketch_never_underestimates(cells):
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 200))).encode() for _ in range(30)]
    t = substrings._Text(texts, 14)
    assert len(t.first) == sum(max(0, len(x.split()) - 13) for x in texts)
    c = np.zeros(cells, int)
    for at in substrings.cells_of(t.places(), cells):
        np.add.at(c, at.astype(int), 1)
    count = {}
    for x in texts:
        w = x.split()
        for j in range(len(w) - 13):
            count[tuple(w[j: j + 14])] = count.get(tuple(w[j: j + 14]), 0) + 1
    estimate = np.minimum(*[c[at.astype(int)] for at in substrings.cells_of(t.grams[t.place], cells)])
    k = 0
    for x in texts:
        w = x.split()
        for j in range(len(w) - 13):
            assert estimate[k] >= count[tuple(w[j: j + 14])]
            k += 1


def test_full_sketch_changes_no_result(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small[0]}/documents.parquet")
    whole = sorted(map(str, substrings.remove_repeats(docs).collect()))
    monkeypatch.setattr(substrings, "MAX_CELLS", 1 << 16)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 200)
    assert sorted(map(str, substrings.remove_repeats(docs).collect())) == whole


def test_decontamination_spans_and_blocks(spark, small):
    docs = spark.createDataFrame([(1, "Où: ONE, two—three four! tail"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two—three"), (2, "four")], "item_id long, text string")
    got = {r.doc_id: r.bench for r in decontam.decontaminate(docs, bench, block_bytes=5).collect()}
    assert got[1].items == ["1", "2"] and [tuple(s) for s in got[1].spans] == [(4, 23)] and got[2].n_words == 0
    real = spark.read.parquet(f"{small[0]}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{small[0]}/benchmark.parquet")
    one, many = (sorted(map(str, decontam.decontaminate(real, items, block_bytes=b).collect())) for b in (1 << 20, 100))
    assert one == many
    with pytest.raises(ValueError):
        decontam.decontaminate(docs, bench, max_bytes=3)


def test_benchmark_items_without_id_are_hits(spark):
    docs = spark.createDataFrame([(1, "say one two three now"), (2, "four five"), (3, "six")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "one two three"), (None, "four five"), (7, "four five")], "item_id long, text string")
    for size in (1, 1 << 20):
        got = {r.doc_id: r.bench for r in decontam.decontaminate(docs, bench, block_bytes=size).collect()}
        assert [(got[i].n_hit, got[i].items, got[i].contaminated) for i in (1, 2, 3)] == [(3, [], True), (2, ["7"], True), (0, [], False)]


def test_windows_of_any_length_by_brute_force():
    """The automaton over blocks finds what a search for every window finds."""
    rnd = random.Random(3)
    for trial in range(300):
        n, letters = rnd.choice([1, 2, 3, 4, 5, 13]), "abcdefgh"[: rnd.choice([2, 3, 8])]
        text = lambda k: " ".join(rnd.choice(letters) for _ in range(k))
        items = [(str(i) if i % 5 else None, text(rnd.choice([0, 1, 2, 3, 5, 13, 20])).encode()) for i in range(rnd.randint(0, 6))]
        doc = text(rnd.randint(0, 40))
        w, hit, ids = doc.split(), set(), set()
        for item, t in items:
            t = t.decode().split()
            for j in range(max(1, len(t) - n + 1) if t else 0):
                win = t[j: j + n]
                for a in range(len(w) - len(win) + 1):
                    if w[a: a + len(win)] == win:
                        hit |= set(range(a, a + len(win)))
                        ids |= {item} - {None}
        held = types.SimpleNamespace(value=[(f"brute {trial}", items)])
        assert decontam._Scanner(held, n).scan(doc.encode())[:3] == (len(w), len(hit), sorted(ids))


def test_index_takes_a_bounded_number_of_bytes():
    """Of each word of the benchmark the trie has at most one node, and the table one row."""
    rnd = random.Random(4)
    text = " ".join(f"w{rnd.randrange(3000)}" for _ in range(20000)).encode()
    index = decontam._Index([("1", text)], 13)
    assert index.automaton.get_stats()["nodes_count"] <= 20001
    assert len(index.hashes) <= 20000


def planted(rnd):
    """Random tokens in four encodings, and look-alikes that aren't random."""
    hexes = "0123456789ABCDEF"  # in capitals, which the fixed patterns leave alone
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    tokens = []
    for name, alphabet in (("hex", hexes), ("base32", upper), ("base62", letters), ("base64", letters + "+/")):
        while sum(t[0] == name for t in tokens) < 250:
            t = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(20, 128)))
            if re.search("[0-9]", t) and re.search("[A-Za-z]", t):
                tokens.append((name, t))
    words = ["user", "account", "handler", "request", "session", "default", "config", "message", "buffer", "index", "parser", "status", "internal", "value"]
    pick = lambda k: [rnd.choice(words) for _ in range(k)]
    date = lambda: f"{rnd.randint(1990, 2030)}-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}"
    kinds = {
        "identifier": lambda: "_".join(pick(rnd.randint(4, 8))) + f"_{rnd.randint(1, 99)}",
        "camel": lambda: "".join(w.title() for w in pick(rnd.randint(4, 8))) + str(rnd.randint(1, 99)),
        "path": lambda: "/".join(["src", *pick(rnd.randint(4, 8)), f"v{rnd.randint(1, 9)}"]),
        "dates": lambda: f"{date()}/{date()}/from{date()}",
    }
    return tokens, [(name, make()) for name, make in kinds.items() for _ in range(250)]


def test_recall_and_precision_on_planted_strings(spark):
    """Figures in the README: recall by encoding, and how many look-alikes are called random."""
    rnd = random.Random(12)
    tokens, fakes = planted(rnd)
    docs = spark.createDataFrame([(i, f"see {t} there") for i, (_, t) in enumerate(tokens + fakes)], "doc_id int, text string").repartition(8)
    got = {r.doc_id: any(s.kind == 3 for s in r.secrets.spans) for r in secrets.find_secrets(docs).collect()}
    share = Counter(name for i, (name, _) in enumerate(tokens + fakes) if got[i])
    print(dict(share))
    found, false = sum(share[k] for k in ("hex", "base32", "base62", "base64")), sum(share[k] for k in ("identifier", "camel", "path", "dates"))
    assert found >= 0.9 * len(tokens)
    assert found >= 0.9 * (found + false)


def test_randomness_battery(spark):
    rnd = random.Random(8)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    real = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(30, 90))) + "a1" for _ in range(150)]
    fake = ["path/to/the/file/number/2020/of/my/things", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", "abcdefghijklmnopqrstuvwxyz0123456789abcdef", "the_quick_brown_fox_jumps_over_the_lazy_dog_99"] * 25
    docs = spark.createDataFrame([(i, f"see {t} there") for i, t in enumerate(real + fake)], "doc_id int, text string")
    got = {r.doc_id: [s.kind for s in r.secrets.spans] for r in secrets.find_secrets(docs).collect()}
    assert sum(3 in got[i] for i in range(150)) >= 135
    assert sum(3 in got[i] for i in range(150, 250)) <= 10


def test_many_matches_in_one_text(spark):
    """More matches than a block of running sums, with code points beyond the BMP between."""
    rnd = random.Random(1)
    text = "".join(f"😀{rnd.getrandbits(80):020x} " for _ in range(700))
    r = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert all(text[s.begin: s.end] == text[s.begin: s.end].strip(" 😀") and len(text[s.begin: s.end]) == 20 for s in r.secrets.base)
    assert len(r.secrets.base) == 700


def test_redaction(spark):
    s = [(0, 0, 5), (3, 1, 9), (9, 2, 12), (20, 2, 26)]
    df = spark.createDataFrame([("é😀3456789012345678901234567", s), ("clean", []), (None, [])], "t string, s array<struct<begin:int,kind:int,end:int>>")
    got = [r[0] for r in df.select(secrets.redact(F.col("t"), F.col("s"))).collect()]
    assert got == ["[REDACTED][REDACTED]34567890[REDACTED]7", "clean", None]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("chunk,overlap", [(40, 4), (97, 8), (1000, 64)])
def test_resynchronised_ids_are_the_library_s(name, chunk, overlap):
    import public_tokenizers

    rnd = random.Random(chunk)
    t = tokens.load(public_tokenizers.path(name))
    parts = ["the", " ", "  ", "\n", "don't", "12345", "...", "<|endoftext|>", "é", "é", " ", "supercalifragilistic" * 9, "日本", "!'s", "İ"]
    for _ in range(12):
        text = "".join(rnd.choice(parts) + (" " if rnd.random() < 0.6 else "") for _ in range(rnd.randint(0, 250)))
        whole = t.encode(text, add_special_tokens=False).ids
        assert list(itertools.chain(*tokens.resync_ids(t, text, chunk, overlap))) == whole


def test_piece_ids_are_the_library_s():
    enc = tokens.piece_ids(Q.tokenizer_path())
    for text in ("Thé ÉTÉ größe ÀÿßµªºØ x.y, z. ... ,a don't it's 12ab <|endoftext|> <|ENDOFTEXT|> a\x1cb c d \x00 İstanbul ﬁ Σας", "", ".", "ñ,", "À.", "é."):
        ids = enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert enc.ids(text.encode()) == b"".join(i.to_bytes(4, "little") for i in ids)
