"""Token ids and counts of whole texts.

Two exact short cuts sit in front of the tokenizer library:

* White space is a hard boundary of a tokenizer that drops it, so the ids of a
  text are the ids of its white-space-free pieces, one after another; those of
  frequent pieces are kept per worker.
* A huge text is encoded in overlapping chunks with offsets.  Neighbouring
  chunks are spliced at a *proven stable common boundary*: a place where a
  non-space character meets white space (no pre-token spans it, so what follows
  does not depend on what came before), at which both encodings break, and from
  which on both agree to the last such place of the overlap.  If there is none,
  the overlap is doubled, at most until it covers the whole chunk, which is then
  encoded longer instead.

Nulls count as empty (0 tokens); empty tables give empty results; repeated rows
are counted once each; other columns pass through.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

CACHED_PIECES = 1_500_000  # entries kept per Python worker; about 200 MB
CACHED_BYTES = 64  # longer pieces are encoded each time
_SPACE = re.compile(r"\s")
_SHARED: dict[str, "PieceIds"] = {}  # per worker process, reused from task to task


def load(path: str):
    """The tokenizer in a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file."""
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-ins of bytes in byte-level vocabularies: printable
    Latin-1 for itself, the rest numbered from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PieceIds(dict):
    """Little-endian unsigned 32-bit ids of white-space-free pieces, by piece."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = load(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        norm = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        #: pieces are independent: white space never gets into a token
        self.by_piece = norm == ["NFC", "Replace", "Lowercase"] and split.get("behavior") == "Removed" and not spec.get("post_processor")
        self._alphabet = _byte_alphabet()
        self._ends = {c: self._library(c) for c in ".,"} if self.by_piece else {}

    def _library(self, text: str) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: bytes) -> bytes:
        text = piece.decode("utf-8", "replace")
        bare, end = (text[:-1], text[-1]) if text[-1] in self._ends else (text, "")
        if bare.isalpha() and max(bare) <= "\xff" and not set(bare) & {"ª", "º", "µ"}:
            # letters alone are one pre-token: normalise them here, straight to the merges
            symbols = bare.lower().encode().decode("latin-1").translate(self._alphabet)
            ids = b"".join(t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(symbols))
            if end:
                ids += self._ends[end]
        else:
            ids = self._library(text)
        if len(piece) <= CACHED_BYTES:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        """All ids of a text."""
        if self.by_piece:
            return b"".join(map(self.__getitem__, text.split()))
        return self._library(text.decode("utf-8", "replace"))


def piece_ids(path: str) -> PieceIds:
    got = _SHARED.get(path)
    if got is None:
        got = _SHARED[path] = PieceIds(path)
    return got


def _stable(text: str, lo: int, hi: int) -> Iterator[int]:
    """Places in (lo, hi) where a non-space character meets white space."""
    for m in _SPACE.finditer(text, lo + 1, hi):
        if not text[m.start() - 1].isspace():
            yield m.start()


def _encode(tokenizer, text: str, start: int, stop: int) -> list[tuple[int, int, int]]:
    """(id, start, end) with places in the whole text."""
    e = tokenizer.encode(text[start:stop], add_special_tokens=False)
    return [(i, start + a, start + b) for i, (a, b) in zip(e.ids, e.offsets)]


def _tail(tokens: list[tuple[int, int, int]], p: int, q: int) -> list[tuple[int, int, int]] | None:
    """Tokens that begin in [p, q), or None if one spans p or q."""
    out = []
    for t in tokens:
        if t[1] < p < t[2] or t[1] < q < t[2]:
            return None
        if p <= t[1] < q:
            out.append(t)
    return out


def resync_ids(tokenizer, text: str, chunk: int = 32_768, overlap: int = 256) -> Iterator[list[int]]:
    """Ids of ``text`` in runs, from overlapping chunks; equal to one whole encoding.

    At most one chunk and its widened overlap are in memory as tokens.
    """
    cut, start, stop = 0, 0, min(len(text), chunk)
    tokens = _encode(tokenizer, text, start, stop)
    while stop < len(text):
        wide = overlap
        while True:
            at = stop - wide
            if at <= cut:  # no boundary in the whole chunk: encode a longer one instead
                start, stop = cut, min(len(text), stop + max(chunk, stop - cut))
                tokens = _encode(tokenizer, text, start, stop)
                break
            nxt_stop = min(len(text), at + max(chunk, 2 * wide))
            nxt = _encode(tokenizer, text, at, nxt_stop)
            places = list(_stable(text, max(at, cut), stop))
            # from p the next chunk is taken; to q, the last such place, the two must agree
            if len(places) > 1:
                p, q = places[0], places[-1]
                mine, theirs = _tail(tokens, p, q), _tail(nxt, p, q)
                if mine is not None and mine == theirs:
                    yield [t[0] for t in tokens if cut <= t[1] < p]
                    cut, start, stop, tokens = p, at, nxt_stop, nxt
                    break
            wide *= 2
    yield [t[0] for t in tokens if t[1] >= cut]


class _Counter:
    def __init__(self, path: str, chunk: int, overlap: int):
        self.path, self.chunk, self.overlap = path, chunk, overlap
        self.pieces = None if path.endswith(".model") else piece_ids(path)
        self.model = load(path) if self.pieces is None else None

    def count(self, text: bytes) -> int:
        if self.model is not None:
            return len(self.model.encode(text.decode("utf-8", "replace")))
        if len(text) > self.chunk:
            s = text.decode("utf-8", "replace")
            if len(s) > self.chunk:
                return sum(map(len, resync_ids(self.pieces.tokenizer, s, self.chunk, self.overlap)))
        return len(self.pieces.ids(text)) // 4

    def __call__(self, texts: list[bytes]) -> list[list]:
        return [[len(t) for t in texts], [self.count(t) for t in texts]]


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", into: str = "tokens", chunk: int = 32_768, overlap: int = 256) -> DataFrame:
    """``docs`` with a struct ``into``: ``n_bytes`` and ``n_tokens`` of each whole text.

    ``path`` is a tokenizer file every executor has.  Texts of more than
    ``chunk`` characters go through overlapping chunks (``.json`` only).
    """
    from .frames import annotate

    return annotate(docs, text_col, into, "n_bytes long, n_tokens long", _Counter, path, chunk, overlap)
