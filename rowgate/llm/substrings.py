"""Removal of passages that repeat anywhere, behind a count-min prefilter.

A window is ``width`` consecutive words of one document; words covered by a
window whose word sequence also starts anywhere else are removed.

*Prefilter.*  Equal windows have equal smallest ``GRAM``-word sub-sequences (by
hash), so the number of places of a window's smallest sub-sequence is never less
than the number of places of the window.  Each partition counts these places,
far fewer than the windows, in a sparse count-min sketch of two cells a
sub-sequence; the sketches are merged by cell block in a shuffle.  A window is
*estimated repeated* if both cells count two or more.

*Exact pass.*  Only windows estimated repeated are grouped, by 128 bits of hash
over their words.  A task settles windows that repeat within a batch at once and
ships one of them, so that a passage in a third of all documents sends a few rows
per batch, not one per copy; the others travel as packed arrays, sharded by hash.

The merged sketch is broadcast as bits.  Its size is fixed by ``cells`` (chosen
from the corpus, at most ``MAX_CELLS`` bits, 64 MB) and so doesn't grow without
bound; on a corpus that fills it the prefilter passes more windows on, losing
none and changing no result.

Null and empty texts have no words and lose none.  Texts shorter than a window
have no windows.  Repeated rows repeat each other's windows.  Empty tables give
empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import row_key, utf8

GRAM = 12  # words of the sub-sequence that stands for a window in the sketch
MAX_CELLS = 1 << 29
BATCH_BYTES = 8 << 20  # text that a task works on at once
SHARD_WORDS = 4_000_000  # words of the corpus per shard of the exact pass
_B1, _B2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # odd multipliers of the rolling hashes


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolling(h: np.ndarray, n: int, base: int) -> np.ndarray:
    """Polynomial hashes modulo 2**64 of all runs of ``n`` numbers, by doubling."""
    if len(h) < n:
        return h[:0]
    total, done, power, size = None, 0, h, 1
    while n >= size:
        if n & size:  # the run's next ``size`` numbers
            part = power[done: done + len(h) - n + 1]
            total = part if total is None else total * np.uint64(pow(base, size, 1 << 64)) + part
            done += size
        if 2 * size <= n:
            power = power[:-size] * np.uint64(pow(base, size, 1 << 64)) + power[size:]
        size *= 2
    return total


class _WordHash(dict):
    """128-bit hashes of words (16 bytes), remembered up to a bound."""

    def __missing__(self, word: bytes) -> bytes:
        import xxhash

        got = xxhash.xxh3_128_digest(word)
        if len(self) >= 300_000:
            self.clear()
        self[word] = got
        return got


_WORDS = _WordHash()  # per worker


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Least of each ``n`` neighbours, by doubling."""
    size = 1
    while 2 * size <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (n - size)], x[n - size:]) if n > size else x


class _Text:
    """One batch of texts as word hashes end to end, with the windows in them.

    A window's place is that of its smallest sub-sequence by the upper half of
    the hash, the first of equal ones: a function of its words alone.
    """

    def __init__(self, texts: list[bytes], width: int):
        self.width, get = width, _WORDS.__getitem__
        parts, lengths = [], []
        for t in texts:
            words = t.split()
            lengths.append(len(words) if len(words) >= width else 0)
            if lengths[-1]:
                parts.append(b"".join(map(get, words)))
        self.lanes = np.frombuffer(b"".join(parts), "<u8").reshape(-1, 2)
        lengths = np.array(lengths, np.int64)
        self.doc = np.flatnonzero(lengths)  # documents with windows, their first words and ends
        ends = np.cumsum(lengths[self.doc])
        self.begin = ends - lengths[self.doc]
        n = len(self.lanes)
        if n == 0:
            self.first = self.place = np.zeros(0, np.int64)
            return
        self.grams = _mix(rolling(np.ascontiguousarray(self.lanes[:, 0]), GRAM, _B1))
        packed = (self.grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(self.grams), dtype=np.uint64)
        place = (sliding_min(packed, width - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        inside = np.ones(n, bool)  # not so where a window would reach into the next document
        for k in range(1, width):
            inside[ends - k] = False
        self.first = np.flatnonzero(inside)
        self.place = place[self.first]

    def places(self) -> np.ndarray:
        """Hashes of the distinct places that stand for a window."""
        return self.grams[np.unique(self.place)] if len(self.place) else np.zeros(0, np.uint64)

    def windows(self, repeated) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, first word, 2 x 64 bits, hash of the place) of the windows whose
        place is ``repeated``."""
        if not len(self.place):
            return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros((0, 2), np.uint64), np.zeros(0, np.uint64)
        at = np.unique(self.place)
        yes = np.zeros(len(self.grams), bool)
        yes[at] = repeated(self.grams[at])
        chosen = yes[self.place]
        first = self.first[chosen]
        which = np.searchsorted(self.begin, first, "right") - 1
        pair = [_mix(rolling(np.ascontiguousarray(self.lanes[:, k]), self.width, b)[first]) for k, b in ((0, _B1), (1, _B2))]
        return self.doc[which].astype(np.int32), first - self.begin[which], np.stack(pair, axis=1), self.grams[self.place[chosen]]


def cells_of(grams: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(cells - 1)
    return grams & mask, (grams >> np.uint64(32)) & mask


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to about BATCH_BYTES of text."""
    for batch in batches:
        step = max(1, int(batch.num_rows * BATCH_BYTES / max(1, batch.column("text").nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


class _Sketch:
    """Texts -> sparse partial sketches: per block its cells (4 bytes each) that this
    batch counts once and those it counts more often."""

    def __init__(self, width: int, cells: int, block: int):
        self.width, self.cells, self.block = width, cells, block

    def __call__(self, batches):
        for part in _parts(batches):
            grams = _Text(utf8(part, "text"), self.width).places()
            cell, count = np.unique(np.concatenate(cells_of(grams, self.cells)), return_counts=True)
            edges = np.searchsorted(cell, np.arange(0, self.cells + 1, self.block, dtype=np.uint64))
            rows = []
            for b, (lo, hi) in enumerate(zip(edges, edges[1:])):
                if lo < hi:
                    at, many = (cell[lo:hi] - np.uint64(b * self.block)).astype("<u4"), count[lo:hi] > 1
                    rows.append((b, at[~many].tobytes(), at[many].tobytes()))
            if rows:
                b, once, more = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(once, pa.binary()), pa.array(more, pa.binary())], names=["block", "once", "more"])


class _Merge:
    """Sorted partial sketches -> one row of bits per block: cells counted twice or more."""

    def __init__(self, block: int):
        self.block = block

    def __call__(self, batches):
        now, count = None, None
        for batch in batches:
            for b, once, more in zip(*(batch.column(c).to_pylist() for c in ("block", "once", "more"))):
                if b != now:
                    if now is not None:
                        yield self._row(now, count)
                    now, count = b, np.zeros(self.block, np.uint8)
                at = np.frombuffer(once, "<u4")
                count[at] = np.minimum(count[at] + 1, 2)
                count[np.frombuffer(more, "<u4")] = 2
        if now is not None:
            yield self._row(now, count)

    @staticmethod
    def _row(b: int, count: np.ndarray) -> pa.RecordBatch:
        import zlib

        bits = zlib.compress(np.packbits(count > 1, bitorder="little").tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([bits], pa.binary())], names=["block", "bits"])


_BITS: dict[str, np.ndarray] = {}  # the last sketch of this worker


class _Candidates:
    """Texts -> packed windows estimated repeated, by shard.

    Per batch and shard: ``keys`` (16 bytes a document), ``doc`` and ``first``
    (4 bytes a window: which of the keys, which word) and ``hash`` (16 bytes).
    Windows that repeat in the batch are settled here: their documents' words
    come back as rows with no hash, and one window of each goes on, with doc -1.
    """

    def __init__(self, width: int, cells: int, shards: int, name: str, sketch):
        self.width, self.cells, self.shards, self.name, self.sketch = width, cells, shards, name, sketch

    def _bits(self) -> np.ndarray:
        if self.name not in _BITS:
            import zlib

            block, parts = self.sketch.value
            bits = np.zeros(self.cells // 8, np.uint8)
            for b, z in parts:
                bits[b * block // 8: (b + 1) * block // 8] = np.frombuffer(zlib.decompress(z), np.uint8)
            _BITS.clear()
            _BITS[self.name] = bits
        return _BITS[self.name]

    def __call__(self, batches):
        bits = self._bits()

        def repeated(grams: np.ndarray) -> np.ndarray:
            yes = np.ones(len(grams), bool)
            for c in cells_of(grams, self.cells):
                yes &= (bits[c >> np.uint64(3)] >> (c & np.uint64(7)).astype(np.uint8)) & 1 == 1
            return yes

        for part in _parts(batches):
            doc, first, h, place = _Text(utf8(part, "text"), self.width).windows(repeated)
            if not len(doc):
                continue
            keys = np.stack([part.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b")], axis=1)
            order = np.lexsort((h[:, 1], h[:, 0]))
            h, doc, first, place = h[order], doc[order], first[order], place[order]
            new = np.concatenate([[True], np.any(h[1:] != h[:-1], axis=1)])
            size = np.diff(np.concatenate([np.flatnonzero(new), [len(h)]]))
            local = np.repeat(size > 1, size)
            yield from self._settled(keys, doc[local], first[local])
            doc = np.where(local, -1, doc).astype(np.int32)
            h, doc, first = h[new], doc[new], first[new]
            # equal windows have equal places; neighbours mostly share one, and so a shard
            shard = (place[new] % np.uint64(self.shards)).astype(np.int64)
            by = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[by], np.arange(self.shards + 1))
            rows = []
            for s, (lo, hi) in enumerate(zip(edges, edges[1:])):
                if lo < hi:
                    mine = by[lo:hi]
                    used, local_doc = np.unique(doc[mine], return_inverse=True)
                    ids = keys[used] if used[0] >= 0 else np.concatenate([[[0, 0]], keys[used[1:]]])
                    at = local_doc.astype("<i4") if used[0] >= 0 else (local_doc - 1).astype("<i4")
                    ids = ids if used[0] >= 0 else ids[1:]
                    rows.append((s, ids.astype("<i8").tobytes(), at.tobytes(), first[mine].astype("<u4").tobytes(), h[mine].astype("<u8").tobytes()))
            yield _packed(rows)

    def _settled(self, keys, doc, first):
        if len(doc):
            rows = {(keys[d].astype("<i8").tobytes(), words) for d, words in _by_document(doc, first)}
            yield _packed([(n % self.shards, key, b"", words, b"") for n, (key, words) in enumerate(sorted(rows))])


def _by_document(doc: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """First words by document as runs: (begin, end) pairs, 4 bytes each."""
    order = np.lexsort((first, doc))
    doc, first = doc[order], first[order]
    edges = np.concatenate([[0], np.flatnonzero(doc[1:] != doc[:-1]) + 1, [len(doc)]])
    for lo, hi in zip(edges, edges[1:]):
        w = first[lo:hi]
        cut = np.flatnonzero(np.diff(w) != 1) + 1
        begin, end = w[np.concatenate([[0], cut])], w[np.concatenate([cut - 1, [len(w) - 1]])] + 1
        yield doc[lo], np.stack([begin, end], axis=1).astype("<u4").tobytes()


_PACKED = "shard int, keys binary, doc binary, first binary, hash binary"


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["shard", "keys", "doc", "first", "hash"])


class _Resolve:
    """Packed windows sorted by shard -> (a, b, runs): per document the first words of
    windows that start elsewhere too.  Holds one shard."""

    def __call__(self, batches):
        now, held = None, []
        for batch in batches:
            for s, *row in zip(*(batch.column(c).to_pylist() for c in ("shard", "keys", "doc", "first", "hash"))):
                if not row[3]:  # settled before
                    yield self._rows([(np.frombuffer(row[0], "<i8"), row[2])])
                    continue
                if s != now:
                    yield from self._shard(held)
                    now, held = s, []
                held.append(row)
        yield from self._shard(held)

    def _shard(self, held):
        if not held:
            return
        keys, docs, base = [], [], 0
        for k, d, _, _ in held:
            ids, at = np.frombuffer(k, "<i8").reshape(-1, 2), np.frombuffer(d, "<i4")
            keys.append(ids)
            docs.append(np.where(at < 0, -1, at + base))
            base += len(ids)
        key, doc = np.concatenate(keys), np.concatenate(docs)
        first = np.concatenate([np.frombuffer(r[2], "<u4") for r in held])
        h = np.concatenate([np.frombuffer(r[3], "<u8").reshape(-1, 2) for r in held])
        order = np.lexsort((h[:, 1], h[:, 0]))
        h, doc, first = h[order], doc[order], first[order]
        starts = np.concatenate([[0], np.flatnonzero(np.any(h[1:] != h[:-1], axis=1)) + 1, [len(h)]])
        size = np.diff(starts)
        # a batch sends a window once, settled (doc -1) if it has it twice: two rows are
        # two batches, and a single row is repeated only if settled, when nobody waits
        yes = np.repeat(size > 1, size) & (doc >= 0)
        if yes.any():
            yield self._rows([(key[d], runs) for d, runs in _by_document(doc[yes], first[yes].astype(np.int64))])

    @staticmethod
    def _rows(rows):
        a, b = np.array([k for k, _ in rows], np.int64).T
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a)), pa.array(np.ascontiguousarray(b)), pa.array([r for _, r in rows], pa.binary())], names=["a", "b", "runs"])


def keep_mask(n: int, runs: list[bytes], width: int) -> np.ndarray:
    """Which of ``n`` words no window that begins in ``runs`` covers."""
    mark = np.zeros(n + 1, np.int64)
    for r in runs:
        begin, end = np.frombuffer(r, "<u4").reshape(-1, 2).astype(np.int64).T
        np.add.at(mark, begin, 1)
        np.add.at(mark, np.minimum(end - 1 + width, n), -1)
    return np.cumsum(mark[:-1]) == 0


class _Remove:
    def __init__(self, width: int, kept_text: bool, kind):
        self.width, self.kept_text, self.kind = width, kept_text, kind

    def __call__(self, batches):
        for part in _parts(batches):
            n, gone, sums, kept = [], [], [], []
            for t, runs in zip(utf8(part, "text"), part.column("runs").to_pylist()):
                words = t.split()
                left = words
                if runs:
                    left = [w for w, k in zip(words, keep_mask(len(words), runs, self.width).tolist()) if k]
                text = b" ".join(left)
                n.append(len(words))
                gone.append(len(words) - len(left))
                sums.append(hashlib.sha256(text).hexdigest())
                kept.append(text if self.kept_text else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("id").cast(self.kind), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sums, pa.string()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["id", "n_words", "n_removed", "kept_sha256", "kept"],
            )


def remove_repeats(docs: DataFrame, width: int = 35, id_col: str = "doc_id", text_col: str = "text", kept_text: bool = True) -> DataFrame:
    """Per document: id, ``n_words``, ``n_removed``, ``kept_sha256`` and the ``kept`` words
    joined by one space (null if not ``kept_text``)."""
    from pyspark.sql.pandas.types import to_arrow_type

    if width < GRAM:
        raise ValueError(f"windows must have at least {GRAM} words")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    key = row_key(F.col("id"), F.col("text"))
    keyed = rows.select(key["a"].alias("a"), key["b"].alias("b"), "id", "text")
    # spaces bound the words from above well enough to size the sketch and the shards
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // 6
    cells = 1 << max(16, min(MAX_CELLS, 8 * size // (width - GRAM + 1) * 2).bit_length())
    cells = min(cells, MAX_CELLS)
    block, shards = max(1 << 16, cells // 256), max(8, size // SHARD_WORDS + 1)
    texts = rows.select("text")
    partial = texts.mapInArrow(_Sketch(width, cells, block), "block long, once binary, more binary")
    merged = partial.repartition("block").sortWithinPartitions("block").mapInArrow(_Merge(block), "block long, bits binary")
    parts = [(r[0], bytes(r[1])) for r in merged.collect()]  # at most MAX_CELLS bits
    sketch = spark.sparkContext.broadcast((block, parts))
    name = hashlib.sha256(repr([(b, hashlib.sha256(z).digest()) for b, z in sorted(parts)]).encode()).hexdigest()
    packed = keyed.select("a", "b", "text").mapInArrow(_Candidates(width, cells, shards, name, sketch), _PACKED)
    found = packed.repartition("shard").sortWithinPartitions("shard").mapInArrow(_Resolve(), "a long, b long, runs binary")
    # rows that repeat wholly share a key and send the same runs again and again: each once
    runs = found.groupBy("a", "b").agg(F.collect_set("runs").alias("runs"))
    kind = rows.schema["id"].dataType
    joined = keyed.join(runs, ["a", "b"], "left").select("id", "text", "runs")
    out = joined.mapInArrow(_Remove(width, kept_text, to_arrow_type(kind)), f"id {kind.simpleString()}, n_words long, n_removed long, kept_sha256 string, kept string")
    return out.withColumnRenamed("id", id_col)
