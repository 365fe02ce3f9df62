"""Quality rules as a short-circuit cascade.

Rules are checks over lazily computed features of a text.  On the texts of a sample
that pass the base rule each rule's cost (seconds a text beyond the base figures, which
every text owes) and selectivity (share of texts rejected) are estimated, and the
cascade runs the rules by falling rejection per cost, stopping at the first that
rejects.  The order changes how much work a rejected text costs, never whether it is
rejected.

Nulls and empty texts have no words: they fail the base rule.  Whole texts are
read, however long.  Repeated rows are judged alike; an empty table gives an
empty result; other columns pass through.
"""

from __future__ import annotations

import time
from collections import Counter
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame

from .frames import annotate

SYMBOLS = b"#*$%&|<>"
BLOCK = 2000  # words among which distinct ones are counted
_CONTINUATION = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no code point


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in ``words``."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 2_000_000:  # keeps the next product below 2**63
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    _, where, count = np.unique(pairs[:n] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[where] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[starts + k] = True
    return int(covered.sum())


class Features:
    """Features of one text, each computed when first asked for."""

    def __init__(self, text: bytes):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(b"".join(self.words).translate(None, _CONTINUATION))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, (bytes([s]) for s in SYMBOLS)))

    @cached_property
    def lines(self) -> Counter:
        return Counter(line for line in self.text.split(b"\n") if line and not line.isspace())

    @cached_property
    def n_lines(self) -> int:
        return sum(self.lines.values())

    @property
    def n_dup_lines(self) -> int:
        return self.n_lines - len(self.lines)

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words)

    @cached_property
    def n_wordlike(self) -> int:
        """Words with a letter (ASCII, or any code point beyond)."""
        return sum(not w.isascii() or w.lower() != w.upper() for w in self.words)

    @cached_property
    def n_distinct(self) -> int:
        """Distinct words of each BLOCK words in turn, added up: long texts are judged by
        the same measure as short ones."""
        return sum(len(set(self.words[at: at + BLOCK])) for at in range(0, self.n_words, BLOCK))

    def base(self) -> tuple[int, int, int, int, int]:
        return self.n_words, self.word_chars, self.n_symbols, self.n_dup_lines, self.n_repeat_words


def base_failed(f: Features) -> bool:
    return f.n_words < 50 or 100 * f.n_repeat_words > 50 * f.n_words


# name -> rejects(features).  Each holds for texts that pass the base rule.
RULES = {
    "mean_word_length": lambda f: not 2 * f.n_words <= f.word_chars <= 15 * f.n_words,
    "symbol_share": lambda f: 10 * f.n_symbols > f.n_words,
    "duplicate_lines": lambda f: f.n_dup_lines >= 3 and 10 * f.n_dup_lines > 3 * f.n_lines,
    "wordlike_share": lambda f: 10 * f.n_wordlike < 7 * f.n_words,
    "distinct_share": lambda f: 20 * f.n_distinct < f.n_words,
}


def estimate(texts: list[bytes], rules: dict = RULES) -> dict[str, tuple[float, float]]:
    """Per rule: seconds a text beyond the base figures and share rejected, over those of
    ``texts`` that pass the base rule."""
    out = {}
    for name, rejects in rules.items():
        passing = [f for f in map(Features, texts) if not base_failed(f)]
        for f in passing:
            f.base()
        began, hits = time.process_time(), sum(bool(rejects(f)) for f in passing)
        out[name] = ((time.process_time() - began) / max(1, len(passing)), hits / max(1, len(passing)))
    return out


def order(estimates: dict[str, tuple[float, float]]) -> list[str]:
    """Rules by falling rejection per cost; among those that reject nothing, the
    cheap ones first."""
    return sorted(estimates, key=lambda r: (-estimates[r][1] / max(estimates[r][0], 1e-9), estimates[r][0], r))


def plan(docs: DataFrame, sample: int = 300, text_col: str = "text", seed: int = 7) -> list[str]:
    """The order of the rules, from at most ``sample`` texts."""
    texts = [(r[0] or "").encode() for r in docs.select(text_col).sample(0.2, seed).limit(sample).collect()]
    return order(estimate(texts))


class _Cascade:
    def __init__(self, names: list[str]):
        self.rules = [RULES[n] for n in names]

    def __call__(self, texts: list[bytes]) -> list[list]:
        rows = []
        for t in texts:
            f = Features(t)
            failed = base_failed(f)
            kept = not failed and not any(rejects(f) for rejects in self.rules)
            rows.append((*f.base(), failed, kept))
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(7)]


def quality(docs: DataFrame, names: list[str] | None = None, text_col: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with a struct ``into``: the base figures, ``base_failed`` and the
    cascade's verdict ``kept``.  ``names`` is the rules' order (default: planned
    from a sample of ``docs``)."""
    names = plan(docs, text_col=text_col) if names is None else names
    return annotate(docs, text_col, into, "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean", _Cascade, names)
