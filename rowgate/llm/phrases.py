"""Phrase collocations from count streams in prefix and suffix order.

*Counts.*  Pieces of text between punctuation or line breaks are cut into runs of 1
to ``longest`` words.  A first pass over the texts adds up, per task and merged by
block of cells, a sketch that never counts a run too low; a second pass counts only
runs that the sketch gives ``least`` places or more, exactly, by the words
themselves.  A run of fewer places can't be a candidate nor part of one.

*Streams.*  The counted runs are sorted twice: by their words (prefix order) and by
their words from the last to the first (suffix order).  In either order a run comes
right after the shorter runs that it begins (ends) with and right before the longer
ones that begin (end) with it.  One lockstep pass over the stream, holding one run of
each length, hence gives the counts of all its first (last) parts and the largest
count of its extensions by a word, with no table to look anything up in.  The two
results meet by phrase.

Streams are dealt out by ranges of the order, cut at keys chosen by hash, so that a
word with any share of the runs spreads over many tasks; where a range begins inside
the extensions of a run, that run is repeated at its head.

Scores are exact, by decimals of 38 digits (counts up to 10**16).  The sketch has a
fixed largest size (``MAX_CELLS``).  A corpus that fills it lets more runs through to
the exact count and changes no result.

Texts that are null or empty have no words; a null language is ``und``.  Repeated
rows count as often as they come.  Equal scores go by count, then by the phrase's
bytes.  Empty tables give an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.session import run_dir

from .frames import first_rows, utf8

BATCH_BYTES = 4 << 20  # text that a task works on at once
MAX_CELLS = 1 << 26
BLOCKS = 256  # the sketch is merged in so many blocks
PART_ROWS, MOST_PARTS, PICKS = 50_000, 4096, 16
# Bytes that no word has: the ends of pieces stand apart as ":", words are joined by
# the lowest byte (so that a run's extensions follow it), and a NUL in a word is kept as ".".
END, JOIN, NUL = b":", b"\0", b"."
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else 0x0A if b in b".,;:!?\x0a\x0b\x0c\x0d" else 0x20 if b == 9 else NUL[0] if b == 0 else b for b in range(256)
)
_ENDS = re.compile(rb"\n+")


class Runs:
    """The runs of one batch of texts in one language, as numbers of its words.

    Number 0 is the end of a piece.  A run goes by the number of the run without its
    last word and that of the last word; both are below 2**31 in any batch."""

    def __init__(self, texts: list[bytes]):
        ids: defaultdict[bytes, int] = defaultdict(count(1).__next__)
        ids[END] = 0
        tokens = _ENDS.sub(b" : ", b"\n".join(t.translate(FOLD) for t in texts)).split()
        self.at = np.fromiter(map(ids.__getitem__, tokens), np.int64, len(tokens))
        self.words = list(ids)  # in order of their numbers
        self.n_words = int(np.count_nonzero(self.at))

    def of(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(numbers of the words, places) of the distinct runs of 1, 2, ... words."""
        word = self.at > 0
        inside, code, rows = word, self.at, np.arange(len(self.words), dtype=np.int64)[:, None]
        n = np.bincount(self.at, minlength=len(self.words))
        yield rows[1:], n[1:]
        for k in range(2, longest + 1):
            inside = inside[:-1] & word[k - 1:]
            # the run without its last word has a number of its own; so has the longer run
            code = code[: len(inside)] * len(self.words) + self.at[k - 1:]
            kinds, first, back, n = np.unique(code[inside], return_index=True, return_inverse=True, return_counts=True)
            begin = np.flatnonzero(inside)[first]
            rows = np.stack([self.at[begin + j] for j in range(k)], axis=1) if len(begin) else np.zeros((0, k), np.int64)
            yield rows, n
            code = np.zeros(len(inside), np.int64)
            code[inside] = back


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts by language, about BATCH_BYTES in all at a time (one text may be more)."""
    held: defaultdict[str, list[bytes]] = defaultdict(list)
    size = 0
    for batch in batches:
        for part in (batch.slice(at, 128) for at in range(0, batch.num_rows, 128)):
            for lang, text in zip(part.column("lang").to_pylist(), utf8(part, "text")):
                held[lang].append(text)
                size += len(text)
                if size >= BATCH_BYTES:
                    yield from held.items()
                    held.clear()
                    size = 0
    yield from held.items()


def _cells(runs: Runs, lang: str, rows: np.ndarray, hashes: np.ndarray, cells: int) -> np.ndarray:
    """A cell of the sketch for each run: by its words, their order and the language."""
    import xxhash

    h = np.full(len(rows), xxhash.xxh64_intdigest(lang.encode(), rows.shape[1]), np.uint64)
    for j in range(rows.shape[1]):
        h = (h ^ hashes[rows[:, j]]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - (cells.bit_length() - 1))


def _word_hashes(runs: Runs) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, runs.words), np.uint64, len(runs.words))


class _Sketch:
    """Texts -> per block the task's counts of its cells, up to ``least``, packed."""

    def __init__(self, longest: int, least: int, cells: int):
        self.longest, self.most, self.cells = longest, min(least, 255), cells

    def __call__(self, batches):
        import zlib

        held = np.zeros(self.cells, np.uint8)
        for lang, texts in _batches(batches):
            runs = Runs(texts)
            hashes = _word_hashes(runs)
            for rows, n in runs.of(self.longest):
                at = _cells(runs, lang, rows, hashes, self.cells)
                cell, back = np.unique(at, return_inverse=True)
                total = np.bincount(back, n, len(cell))
                held[cell] = np.minimum(held[cell] + np.minimum(total, self.most), self.most).astype(np.uint8)
        size = self.cells // BLOCKS
        for b in range(BLOCKS):
            part = held[b * size: (b + 1) * size]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["block", "counts"])


class _Merge:
    """Sorted packed counts -> one row of bits per block: cells that reach ``least``."""

    def __init__(self, least: int, size: int):
        self.most, self.size = min(least, 255), size

    def __call__(self, batches):
        import zlib

        now, total = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([zlib.compress(np.packbits(total >= self.most).tobytes(), 1)], pa.binary())], names=["block", "bits"])

        for batch in batches:
            for b, packed in zip(*(batch.column(c).to_pylist() for c in ("block", "counts"))):
                if b != now:
                    if now is not None:
                        yield row()
                    now, total = b, np.zeros(self.size, np.uint16)
                total = np.minimum(total + np.frombuffer(zlib.decompress(packed), np.uint8), self.most).astype(np.uint16)
        if now is not None:
            yield row()


class _Count:
    """Texts -> (lang, run, places) per batch for runs that the sketch lets through, and
    (lang, empty, all words)."""

    def __init__(self, longest: int, cells: int, sketch):
        self.longest, self.cells, self.sketch = longest, cells, sketch

    def __call__(self, batches):
        import zlib

        bits = np.zeros(self.cells // 8, np.uint8)
        size = self.cells // BLOCKS // 8
        for b, packed in self.sketch.value:
            bits[b * size: (b + 1) * size] = np.frombuffer(zlib.decompress(packed), np.uint8)
        for lang, texts in _batches(batches):
            runs = Runs(texts)
            hashes, words = _word_hashes(runs), runs.words
            yield self._rows(lang, [b""], [runs.n_words])
            for rows, n in runs.of(self.longest):
                at = _cells(runs, lang, rows, hashes, self.cells)
                yes = np.flatnonzero((bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1)
                for few in (yes[i: i + 50_000] for i in range(0, len(yes), 50_000)):
                    yield self._rows(lang, [JOIN.join(map(words.__getitem__, r)) for r in rows[few].tolist()], n[few])

    @staticmethod
    def _rows(lang, runs, n):
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(runs), pa.string()), pa.array(runs, pa.binary()), pa.array(n, pa.int64())], names=["lang", "run", "n"])


def turned(run: bytes) -> bytes:
    return JOIN.join(reversed(run.split(JOIN)))


class _Deal:
    """Runs -> their ranges of the order, and the ranges that begin inside their extensions."""

    def __init__(self, cuts, longest: int, suffix: bool):
        self.cuts, self.longest, self.suffix = cuts, longest, suffix

    def __call__(self, batches):
        cuts = self.cuts.value
        for batch in batches:
            out = []
            for lang, run, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "run", "n"))):
                key = turned(run) if self.suffix else run
                part = bisect_right(cuts, (lang, key))
                out.append((part, lang, key, n, False))
                if key.count(JOIN) + 1 < self.longest:
                    last = bisect_left(cuts, (lang, key + b"\x01"))
                    out.extend((p, lang, key, n, True) for p in range(part + 1, last + 1))
            kinds = (pa.int32(), pa.string(), pa.binary(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["part", "lang", "key", "n", "again"]) if out else pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names=["part", "lang", "key", "n", "again"])


class _Lockstep:
    """A sorted stream -> (lang, run, n, counts of its first parts from the shortest, largest
    count of an extension).  Holds one run of each length; repeated runs give the last only."""

    def __init__(self, suffix: bool):
        self.suffix = suffix

    def __call__(self, batches):
        stack, out, place = [], [], None

        def close(down_to: int) -> None:
            while len(stack) > down_to:
                lang, key, n, most, again = stack.pop()
                if stack:  # runs of two words or more
                    out.append((lang, turned(key) if self.suffix else key, None if again else n, None if again else [s[2] for s in stack], most))

        for batch in batches:
            for part, lang, key, n, again in zip(*(batch.column(c).to_pylist() for c in ("part", "lang", "key", "n", "again"))):
                if (part, lang) != place:
                    close(0)
                    place = part, lang
                while stack and not key.startswith(stack[-1][1] + JOIN):
                    close(len(stack) - 1)
                if stack and not again:
                    stack[-1][3] = max(stack[-1][3], n)
                stack.append([lang, key, n, 0, again])
            yield self._rows(out)
            out.clear()
        close(0)
        yield self._rows(out)

    @staticmethod
    def _rows(out):
        cols = list(zip(*out)) or [[]] * 5
        kinds = (pa.string(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["lang", "run", "n", "parts", "most"])


def _stream(runs: DataFrame, total: int, longest: int, suffix: bool, part_rows: int) -> DataFrame:
    """(lang, run, n, parts, most) for the runs of two words or more, from one order."""
    spark = runs.sparkSession
    parts = min(MOST_PARTS, -(-total // part_rows)) if total else 0
    cuts: list[tuple[str, bytes]] = []
    if parts > 1:  # about PICKS keys a part, at most MOST_PARTS * PICKS or so
        every = max(1, total // (parts * PICKS))
        some = runs.where(F.pmod(F.xxhash64("lang", "run"), F.lit(every)) == 0).select("lang", "run").collect()
        keys = sorted((r[0], turned(bytes(r[1])) if suffix else bytes(r[1])) for r in some)
        cuts = [keys[i * len(keys) // parts] for i in range(1, parts)] if len(keys) > parts else keys
    dealt = runs.mapInArrow(_Deal(spark.sparkContext.broadcast(cuts), longest, suffix), "part int, lang string, key binary, n long, again boolean")
    # a row for each range at least, so that small ranges aren't put together in few tasks
    ranged = dealt.repartition(max(1, min(len(cuts) + 1, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))), "part")
    sorted_ = ranged.sortWithinPartitions("part", "lang", "key")
    return sorted_.mapInArrow(_Lockstep(suffix), "lang string, run binary, n long, parts array<long>, most long")


def collocations(docs: DataFrame, most: int = 2000, longest: int = 3, least: int = 10, cover: int = 50, lang_col: str = "lang", text_col: str = "text", part_rows: int = PART_ROWS) -> DataFrame:
    """The first ``most`` of each language's candidates that no longer one covers: lang,
    ``rank`` from 1, ``phrase`` (words joined by a space), ``a`` its places, ``l`` and ``r``
    those of the parts of its worst cut, ``n`` all words of the language and ``score`` =
    floor(1000000 * a * a / (l * r)).

    Candidates have 2 to ``longest`` words and ``least`` places or more.  One goes if a
    longer candidate that contains it has ``cover`` percent of its places."""
    if longest < 2 or least < 1:
        raise ValueError("phrases have two words or more and at least one place")
    spark = docs.sparkSession
    folder = run_dir(spark, "phrases")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")).where("text <> ''")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    cells = 1 << max(16, min(MAX_CELLS.bit_length() - 1, (size * longest // 6).bit_length()))
    partial = rows.mapInArrow(_Sketch(longest, least, cells), "block long, counts binary")
    merged = partial.repartition("block").sortWithinPartitions("block").mapInArrow(_Merge(least, cells // BLOCKS), "block long, bits binary")
    bits = spark.sparkContext.broadcast([(r[0], bytes(r[1])) for r in merged.collect()])  # at most MAX_CELLS bits
    counted = rows.mapInArrow(_Count(longest, cells, bits), "lang string, run binary, n long")
    total = counted.groupBy("lang", "run").agg(F.sum("n").alias("n"))
    total.where((F.col("n") >= least) | (F.length("run") == 0)).write.parquet(f"{folder}/counts")
    stored = spark.read.schema("lang string, run binary, n long").parquet(f"{folder}/counts")
    runs = stored.where(F.length("run") > 0)
    words = stored.where(F.length("run") == 0).select("lang", F.col("n").alias("words"))
    how_many = runs.count()
    left = _stream(runs, how_many, longest, False, part_rows).select("lang", "run", "n", F.col("parts").alias("heads"), F.lit(None).cast("array<long>").alias("tails"), "most")
    right = _stream(runs, how_many, longest, True, part_rows).select("lang", "run", "n", F.lit(None).cast("array<long>").alias("heads"), F.col("parts").alias("tails"), "most")
    both = left.union(right).groupBy("lang", "run").agg(F.max("n").alias("a"), F.max("heads").alias("heads"), F.max("tails").alias("tails"), F.max("most").alias("most"))

    def cut(k: Column) -> Column:
        first, rest = F.get("heads", k - 1), F.get("tails", F.size("heads") - k)
        return F.struct(_score(F.col("a"), first, rest).alias("score"), k.alias("k"), first.alias("l"), rest.alias("r"))

    worst = F.array_min(F.transform(F.sequence(F.lit(1), F.size("heads")), cut))
    free = both.where(100 * F.col("most").cast("decimal(20,0)") < cover * F.col("a").cast("decimal(20,0)")).withColumn("w", worst)
    phrase = F.replace(F.translate(F.col("run").cast("string"), "\0", " "), F.lit("."), F.lit("\0"))
    scored = free.select("lang", phrase.alias("phrase"), "a", F.col("w.l").alias("l"), F.col("w.r").alias("r"), F.col("w.score").alias("score"))
    first = first_rows(scored, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], most, "rank")
    return first.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")


def _score(a: Column, left: Column, right: Column) -> Column:
    big = "decimal(19,0)"
    return F.call_function("div", (a.cast(big) * a.cast(big) * F.lit(1000000).cast("decimal(7,0)")).cast("decimal(38,0)"), (left.cast(big) * right.cast(big)).cast("decimal(38,0)"))

