"""Benchmark decontamination with one Aho-Corasick automaton.

Patterns are windows of ``n`` consecutive words of the benchmark's items (an
item with fewer words, but not none, is one window), lower-cased.  A document is
normalised the same way and scanned once; places of hit words are mapped back to
code points of the original text.

The automaton's letters are numbered words.  Windows overlap, so a trie of all of
them would hold every word ``n`` times; it holds each once instead.  Items are cut
into blocks of ``(n + 1) // 2`` words side by side, and every window has one of them
whole.  Where the scan meets a block, the windows of the text around it are looked
up in the sorted table of the benchmark's windows and compared word by word.  Short
items are patterns themselves.  While an index is built it takes about 25 bytes for
each byte of benchmark text (measured: 328 MB for 16 MB), so ``max_bytes`` bounds it.

The benchmark is read in blocks of at most ``block_bytes`` of text, each with an
automaton of its own (one block, hence one automaton, for any ordinary benchmark).
Blocks are scanned in the same pass over the documents.

Null texts have no words and are never contaminated; items without words match
nothing; windows of items with a null item_id are hits like any other but name no
item.  Repeated rows are judged alike, equal item_ids count once.  Empty tables are fine on either side.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import annotate, folded_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # as FOLD has them, before lower-casing
_BUILT: dict[str, object] = {}  # the last indexes of this worker


class _Index:
    """One block of the benchmark: an automaton over numbered words and its windows."""

    def __init__(self, items: list[tuple[str | None, bytes]], n: int):
        self.n, self.step = n, (n + 1) // 2
        self.number: dict[bytes, int] = {}  # from 1; 0 is any other word
        by_words: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            key = tuple(self.number.setdefault(w, len(self.number) + 1) for w in folded_words(text))
            if key:
                ids = by_words.setdefault(key, set())
                if item is not None:
                    ids.add(item)
        self.owners = [tuple(sorted(ids)) for ids in by_words.values()]  # of each different item
        short = {words: i for i, words in enumerate(by_words) if len(words) < n}
        long = [(i, words) for i, words in enumerate(by_words) if len(words) >= n]
        self._windows(long)
        self.automaton = self._automaton(short, [words for _, words in long]) if by_words else None

    def _automaton(self, short: dict[tuple[int, ...], int], long: list[tuple[int, ...]]):
        """Patterns -> (number of words, is it a block, the short item that it is or None)."""
        import ahocorasick

        a = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for words, i in short.items():
            a.add_word(words, (len(words), False, i))
        for words in long:
            for at in range(0, len(words) - self.step + 1, self.step):
                block = words[at: at + self.step]
                a.add_word(block, (self.step, True, short.get(block)))
        a.make_automaton()
        return a

    def _windows(self, long: list[tuple[int, tuple[int, ...]]]) -> None:
        """Different windows by hash: where each first starts, and the items that have it."""
        n = self.n
        self.words = np.fromiter((w for _, words in long for w in words), np.int32)
        sizes = np.array([len(words) for _, words in long], np.int64)
        ends = np.cumsum(sizes)
        starts = np.concatenate([np.arange(e - s, e - n + 1) for s, e in zip(sizes, ends)]) if long else np.zeros(0, np.int64)
        owner = np.repeat(np.array([i for i, _ in long], np.int32), sizes - n + 1 if long else 0)
        seed = 1
        while True:
            self.factors = np.random.default_rng(seed).integers(1, 1 << 63, n, np.uint64) | np.uint64(1)
            hashes = self._hash(self.words, starts)
            order = np.lexsort((starts, hashes))
            h, at = hashes[order], starts[order]
            first = np.ones(len(h), bool)
            first[1:] = h[1:] != h[:-1]
            group = np.cumsum(first) - 1
            same = all((self.words[at + k] == self.words[at[first][group] + k]).all() for k in range(n)) if len(h) else True
            if same:  # no two different windows share a hash
                break
            seed += 1
        self.hashes, self.first, self.owner = h[first], at[first], owner[order]
        self.bounds = np.append(np.flatnonzero(first), len(h))

    def _hash(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), np.uint64)
        for k in range(self.n):
            out = (out ^ words[starts + k].astype(np.uint64)) * self.factors[k]
            out ^= out >> np.uint64(29)
        return out

    def scan(self, words: list[bytes], begin: list, length: list, found: set[str]) -> None:
        """Adds the windows in ``words`` (where they begin, how long they are) and their items."""
        get, n = self.number.get, self.n
        ids = tuple([get(w, 0) for w in words])
        near = []
        for end, (k, block, item) in self.automaton.iter(ids):
            if item is not None:
                begin.append(end - k + 1)
                length.append(k)
                found.update(self.owners[item])
            if block:
                near.append(end)
        if not near or len(ids) < n:
            return
        # windows that hold a met block whole
        reach = np.array(near)[:, None] + np.arange(1 - n, 2 - self.step)
        starts = np.unique(reach[(reach >= 0) & (reach <= len(ids) - n)])
        text = np.array(ids, np.int32)
        hashes = self._hash(text, starts)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        ok = self.hashes[at] == hashes
        for k in range(n):
            ok &= text[starts + k] == self.words[self.first[at] + k]
        begin += starts[ok].tolist()
        length += [n] * int(ok.sum())
        owners = {int(i) for w in np.unique(at[ok]) for i in self.owner[self.bounds[w]: self.bounds[w + 1]]}
        found.update(*(self.owners[i] for i in owners))


class _Scanner:
    def __init__(self, items, n: int):
        blocks = items.value  # broadcast: [(key, [(item_id, text)])]
        for key in set(_BUILT) - {key for key, _ in blocks}:
            del _BUILT[key]
        self.indexes = []
        for key, block in blocks:
            if key not in _BUILT:
                _BUILT[key] = _Index(block, n)
            if _BUILT[key].automaton is not None:
                self.indexes.append(_BUILT[key])

    def scan(self, text: bytes):
        words = folded_words(text)
        found: set[str] = set()
        begin, length = [], []
        if words:
            for index in self.indexes:
                index.scan(words, begin, length, found)
        if not begin:
            return len(words), 0, [], []
        mark = np.zeros(len(words) + 1, np.int64)
        np.add.at(mark, begin, 1)
        np.add.at(mark, np.array(begin) + length, -1)
        hit = np.cumsum(mark[:-1]) > 0
        places = [m.span() for m in WORD.finditer(text.decode("utf-8", "replace"))]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
        return len(words), int(hit.sum()), sorted(found), [(places[i][0], places[j - 1][1]) for i, j in zip(edges[::2], edges[1::2])]

    def __call__(self, texts: list[bytes]) -> list[list]:
        rows = [self.scan(t) for t in texts]
        if not rows:
            return [[] for _ in range(5)]
        n, hit, ids, spans = map(list, zip(*rows))
        return [n, hit, ids, [[{"begin": a, "end": b} for a, b in s] for s in spans], [h > 0 and 20 * h >= k for h, k in zip(hit, n)]]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The benchmark in blocks; rows come to the driver one partition at a time."""
    out, block, size = [], [], 0
    rows = benchmark.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string"), text_col)
    for item, text in rows.toLocalIterator():
        raw = text.encode()
        if block and size + len(raw) > block_bytes:
            out.append(block)
            block, size = [], 0
        block.append((item, raw))
        size += len(raw)
    if block:
        out.append(block)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 13, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", into: str = "bench", block_bytes: int = 16 << 20, max_bytes: int = 64 << 20) -> DataFrame:
    """``docs`` with a struct ``into``: ``n_words``, ``n_hit``, ``items`` (ids as sorted
    strings), ``spans`` (code points of the original text, end exclusive) and
    ``contaminated`` (``n_hit > 0 and 20 * n_hit >= n_words``).

    The benchmark is the stated query set.  It is refused beyond ``max_bytes`` of
    text, the bound of what is broadcast (and, times 25, of what a worker holds);
    nothing is dropped silently.
    """
    total = benchmark.agg(F.coalesce(F.sum(F.octet_length(F.col(item_text_col))), F.lit(0))).first()[0]
    if total > max_bytes:
        raise ValueError(f"the benchmark has {total} bytes of text, more than max_bytes={max_bytes}")
    blocks = [(hashlib.sha256(repr((n, b)).encode()).hexdigest(), b) for b in _blocks(benchmark, item_col, item_text_col, block_bytes)]
    items = docs.sparkSession.sparkContext.broadcast(blocks)
    fields = "n_words long, n_hit long, items array<string>, spans array<struct<begin: long, end: long>>, contaminated boolean"
    return annotate(docs, text_col, into, fields, _Scanner, items, n)
