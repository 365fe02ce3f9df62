"""Secrets: fixed patterns plus a randomness test battery, in DataFrame functions only.

Fixed patterns give spans of kinds ``assign``, ``access`` and ``hex``.  Further
candidates are runs of 20 or more base-64 characters with a letter and a digit.
For each, the encoding is inferred (hex, base 32, base 62, base 64) and three
statistics of its symbols are turned into p-values under "random symbols": the
chi-squared statistic of uniformity over the encoding's alphabet, the number of
runs above and below the alphabet's middle, and the lag-1 serial correlation.
Fisher's sum combines them.

Structured text is what gets rejected.  Short strings give weak tests, so the
false-discovery control is run per length class: in each class the
Benjamini-Hochberg cut-off over all candidates of the corpus decides which are
called structured and dropped; the others are spans of kind ``random``, unless
they overlap a fixed-pattern span.  The cut-offs come from a histogram of
p-values (``BINS`` bins a class), so nothing is ranked in one task.

Null and empty texts have no spans.  Repeated rows are scanned alike, an empty
table gives an empty result, and other columns pass through.  Places are code
points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import free_name

# The patterns that every scan applies, in the order of kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}+"
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}+"
CLASSES = (20, 32, 64, 128)  # least lengths of the length classes
BINS, PER_OCTAVE = 400, 4
STEP = 256
_HEX, _UPPER, _LOWER, _DIGITS = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
# encoding -> (what the whole string must match, alphabet); the first that fits is inferred
ENCODINGS = {
    "hex": (r"^([0-9a-f]+|[0-9A-F]+)$", _HEX),
    "base32": (r"^[A-Z2-7]+=*$", _UPPER + "234567"),
    "base62": (r"^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS),
    "base64": (r"", _UPPER + _LOWER + _DIGITS + "+/"),
}


def spans(text: Column, pattern: str, ok=None, groups: tuple[int, ...] = ()) -> Column:
    """Spans of the leftmost non-overlapping matches as (begin, end, match); ``ok``
    filters by a match's groups.

    Matches and the pieces between them have known lengths; begins are their
    running sums, taken over blocks of STEP so that the work stays near linear.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    cols = [found.alias("m"), F.split(text, pattern, -1).alias("p"), *[F.regexp_extract_all(text, F.lit(pattern), F.lit(g)).alias(f"g{g}") for g in groups]]

    def place(s: Column) -> Column:
        m, p = s["m"], s["p"]
        step = F.zip_with(F.slice(p, 1, F.size(m)), m, lambda a, b: F.length(a) + F.length(b))
        s1 = F.transform(F.array(F.struct(step.alias("step"))), lambda t: _places(t["step"], m, p))
        flat = F.flatten(s1)
        if ok is None:
            return flat
        zipped = F.arrays_zip(flat.alias("at"), *[s[f"g{g}"].alias(f"g{g}") for g in groups])
        return F.transform(F.filter(zipped, ok), lambda z: z["at"])

    # a one-element array names the extracted arrays once for all uses below
    placed = F.flatten(F.transform(F.array(F.struct(*cols)), place))
    none = F.array().cast("array<struct<begin:int,end:int,match:string>>")
    return F.when(text.rlike(pattern), placed).otherwise(none)


def _places(step: Column, m: Column, p: Column) -> Column:
    zero = F.lit(0)
    add = lambda a, x: a + x
    total = lambda arr, at, n: F.aggregate(F.slice(arr, at + 1, n), zero, add)
    blocks = F.sequence(zero, F.floor((F.size(m) - 1) / STEP).cast("int"))
    sums = F.transform(blocks, lambda c: total(step, c * STEP, F.lit(STEP)))
    before = F.transform(F.array(F.struct(sums.alias("s"))), lambda t: F.transform(blocks, lambda c: total(t["s"], zero, c)))[0]

    def whole(t: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            block = F.floor(i / STEP).cast("int")
            begin = F.element_at(t["b"], block + 1) + total(step, block * STEP, i - block * STEP) + F.length(F.element_at(p, i + 1))
            return F.struct(begin.alias("begin"), (begin + F.length(x)).alias("end"), x.alias("match"))

        return F.transform(m, one)

    return F.flatten(F.transform(F.array(F.struct(before.alias("b"))), whole))


def let(fn, **values: Column) -> Column:
    """``fn`` of a struct of ``values``, each computed once however often it is used."""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), fn)[0]


def normal_tail(z: Column) -> Column:
    """1 - Phi(z) by the logistic approximation (error below 0.0002)."""
    return let(lambda t: 1 / (1 + F.exp(F.least(F.lit(700.0), t["z"] * (1.5976 + 0.070566 * t["z"] * t["z"])))), z=z)


def p_value(token: Column) -> Column:
    """Fisher's combined p-value of "symbols are uniform, independent draws"."""
    plain = F.regexp_replace(token, "=+$", "")
    url = F.translate(plain, "-_", "+/")
    forms = {"hex": F.lower(token), "base32": plain, "base62": plain, "base64": url}

    def of(name: str) -> Column:
        alphabet = ENCODINGS[name][1]
        k = float(len(alphabet))
        codes = lambda t: F.transform(t["c"], lambda c: F.instr(F.lit(alphabet), c) - 1)
        return let(lambda t: let(lambda u: _battery(u, k), s=t["s"], c=t["c"], v=codes(t)), s=forms[name], c=F.split(forms[name], ""))

    out = F.when(token.rlike(ENCODINGS["hex"][0]), of("hex"))
    for name in ("base32", "base62"):
        out = out.when(token.rlike(ENCODINGS[name][0]), of(name))
    return out.otherwise(of("base64"))


def _battery(t: Column, k: float) -> Column:
    """Combined p-value of a string ``s`` of characters ``c`` with codes ``v`` below ``k``."""
    s, c, v = t["s"], t["c"], t["v"]
    n = F.size(v).cast("double")
    often = lambda x: (F.length(s) - F.length(F.replace(s, x, F.lit("")))).cast("double")
    square = F.aggregate(F.transform(F.array_distinct(c), often), F.lit(0.0), lambda a, x: a + x * x)
    half, mean, var = k / 2, (k - 1) / 2, (k * k - 1) / 12
    head, rest = F.slice(v, 1, F.size(v) - 1), F.slice(v, 2, F.size(v) - 1)
    turns = F.size(F.filter(F.zip_with(head, rest, lambda a, b: (a >= half) != (b >= half)), lambda x: x)).cast("double")
    serial = F.aggregate(F.zip_with(head, rest, lambda a, b: (a - mean) * (b - mean)), F.lit(0.0), lambda a, x: a + x)

    def combined(u: Column) -> Column:
        tails = [
            normal_tail((k / u["n"] * u["square"] - u["n"] - (k - 1)) / F.sqrt(2 * (k - 1) * (u["n"] - 1) / u["n"])),
            2 * normal_tail(F.abs(u["turns"] - (u["n"] - 1) / 2) / F.sqrt((u["n"] - 1) / 4)),
            2 * normal_tail(F.abs(u["serial"] / var) / F.sqrt(u["n"] - 1)),
        ]
        x = sum((-2 * F.log(F.greatest(F.lit(1e-300), F.least(F.lit(1.0), p))) for p in tails), F.lit(0.0))
        return let(lambda w: F.exp(-w["x"] / 2) * (1 + w["x"] / 2 + w["x"] * w["x"] / 8), x=x)

    return let(combined, n=n, square=square, turns=turns, serial=serial)


def _length_class(token: Column) -> Column:
    return sum((F.when(F.length(token) >= n, 1).otherwise(0) for n in CLASSES[1:]), F.lit(0))


def _bin(p: Column) -> Column:
    """Bins of falling p: bin b has p in (2**(-(b+1)/PER_OCTAVE), 2**(-b/PER_OCTAVE)]."""
    return F.least(F.lit(BINS - 1), F.floor(-F.log2(F.greatest(p, F.lit(1e-300))) * PER_OCTAVE).cast("int"))


def scan(docs: DataFrame, text_col: str = "text", into: str = "secrets") -> DataFrame:
    """``docs`` with a struct ``into``: ``base`` spans (kind, begin, end) and ``candidates``
    (begin, end, length class, p-value bin) of the battery."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    fixed = {
        "assign": spans(text, ASSIGN, ok=lambda z: F.length(z["g2"]) >= 12, groups=(2,)),
        "access": spans(text, ACCESS),
        "hex": spans(text, HEX),
    }
    fixed["access"] = F.filter(fixed["access"], lambda x: F.length(x["match"]) >= 18)

    def of_kind(n: int, found: Column) -> Column:
        return F.transform(found, lambda x: F.struct(x["begin"].alias("begin"), F.lit(n).alias("kind"), x["end"].alias("end")))

    base = F.concat(*[of_kind(KINDS.index(kind), found) for kind, found in fixed.items()])
    mixed = F.filter(spans(text, CANDIDATE), lambda x: x["match"].rlike("[0-9]") & x["match"].rlike("[A-Za-z]"))
    name = free_name(docs, "base_spans"), free_name(docs, "mixed_runs")
    held = docs.withColumns({name[0]: F.array_sort(base), name[1]: mixed})
    free = F.filter(F.col(name[1]), lambda x: ~F.exists(F.col(name[0]), lambda b: (b["begin"] < x["end"]) & (x["begin"] < b["end"])))
    tested = F.transform(free, lambda x: F.struct(x["begin"].alias("begin"), F.lit(3).alias("kind"), x["end"].alias("end"), _length_class(x["match"]).alias("class"), _bin(p_value(x["match"])).alias("bin")))
    return held.withColumn(into, F.struct(F.col(name[0]).alias("base"), tested.alias("candidates"))).drop(*name)


def cutoffs(scanned: DataFrame, into: str = "secrets", q: float = 0.05) -> dict[int, int]:
    """Per length class the first bin that Benjamini-Hochberg at ``q`` calls structured
    (missing: none).  At most ``len(CLASSES) * BINS`` rows come to the driver."""
    each = scanned.select(F.explode(F.col(into)["candidates"]).alias("c")).groupBy("c.class", "c.bin").agg(F.count(F.lit(1)).alias("n"))
    count: dict[int, dict[int, int]] = {}
    for r in each.collect():
        count.setdefault(r[0], {})[r[1]] = r[2]
    out = {}
    for c, bins in count.items():
        total, tail = sum(bins.values()), 0
        for b in range(BINS - 1, -1, -1):  # from the smallest p up; a bin's largest p stands for it
            tail += bins.get(b, 0)
            if tail and 2.0 ** (-b / PER_OCTAVE) <= q * tail / total:
                out[c] = b
    return out


def find_secrets(docs: DataFrame, text_col: str = "text", into: str = "secrets", q: float = 0.05) -> DataFrame:
    """``docs`` with a struct ``into``: ``base`` and ``spans`` (base and random ones), each
    (begin, kind, end) by begin, then kind."""
    scanned = scan(docs, text_col, into)
    cut = cutoffs(scanned, into, q)
    limit = F.create_map(*[F.lit(x) for c in range(len(CLASSES)) for x in (c, cut.get(c, BINS))])
    s = F.col(into)
    random = F.transform(F.filter(s["candidates"], lambda x: x["bin"] < limit[x["class"]]), lambda x: F.struct(x["begin"].alias("begin"), x["kind"].alias("kind"), x["end"].alias("end")))
    return scanned.withColumn(into, F.struct(s["base"].alias("base"), F.array_sort(F.concat(s["base"], random)).alias("spans")))


def listed(spans_: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans_, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["begin"].cast("string"), x["end"].cast("string"))), ",")


def redact(text: Column, spans_: Column, mark: str = "[REDACTED]") -> Column:
    """``text`` with every span (sorted by begin; overlaps run together) replaced by ``mark``."""
    start = F.struct(F.lit(-1).alias("end"), F.lit("").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        from_ = F.greatest(acc["end"], F.lit(0))
        more = F.concat(acc["out"], F.substring(text, from_ + 1, x["begin"] - from_), F.lit(mark))
        out = F.when(x["begin"] < acc["end"], acc["out"]).otherwise(more)
        return F.struct(F.greatest(acc["end"], x["end"]).alias("end"), out.alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["end"] + 1, F.length(text)))
    return F.when(F.size(spans_) > 0, F.aggregate(spans_, start, add, rest)).otherwise(text)
