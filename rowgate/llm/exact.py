"""Exact duplicates by composable polynomial fingerprints, each group compared chunk by chunk.

A text's fingerprint is the value of its bytes (A-Z lower-cased) as the digits of a
polynomial in ``base`` modulo a prime, for two bases.  Fingerprints compose: that of
a followed by b is ``f(a) * base ** len(b) + f(b)``.  Texts of more than ``chunk``
bytes are therefore dealt out as chunks, hashed wherever they land, and put together
from chunk hashes and lengths alone, so that no task hashes a huge text by itself.

Equal fingerprints are no proof.  The rows of each group of equal length and
fingerprints are compared with one of them, chunk against chunk in a sorted stream
that holds one chunk.  Rows that differ from it form new groups and are compared
again, until none differs; usually the first pass is the last.

The rows with their fingerprints are written once to the checkpoint folder, which
gives every row a lasting number.  A group may be a third of all rows: its counts
are made per (group, salt) first, and the comparison deals it out in blocks of
``BLOCK`` rows, each with a copy of the row that the others are compared with.

Null texts count as empty; empty texts are equal to each other.  Repeated rows are
rows of one group.  Of equal texts the row with the largest id stays, a null id only
if there is no other; among repeated largest ids one row stays.  Empty tables give
empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.session import run_dir

from .frames import free_name, utf8

CHUNK = 1 << 16
BLOCK = 1024  # rows compared with one copy of a group's first row
SALTS = 256
PRIME = (1 << 61) - 1
BASES = (0x0F3A9D17C6E58B21, 0x1B64E2F09D3785AD)  # any two numbers below PRIME
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class Poly:
    """Fingerprints modulo ``prime`` of chunks of at most ``chunk`` bytes, and their composition."""

    def __init__(self, chunk: int = CHUNK, bases: tuple[int, ...] = BASES, prime: int = PRIME):
        if chunk > 1 << 24:
            raise ValueError("sums of a chunk must fit in 64 bits")
        self.bases, self.prime, self.tables = bases, prime, []
        for b in bases:
            powers, x = [], 1
            for _ in range(chunk):
                powers.append(x)
                x = x * b % prime
            powers = np.array(powers[::-1], np.uint64)  # the last byte counts once
            self.tables.append((powers >> np.uint64(31), powers & np.uint64((1 << 31) - 1)))

    def of(self, data: bytes) -> list[int]:
        x = np.frombuffer(data, np.uint8).astype(np.uint64)
        # below 2**24 bytes of 8 bits times 31 bits: no sum passes 2**63
        cut = [(hi[len(hi) - len(x):], lo[len(lo) - len(x):]) for hi, lo in self.tables]
        return [((int(x @ hi) << 31) + int(x @ lo)) % self.prime for hi, lo in cut]

    def join(self, a: list[int], b: list[int], length: int) -> list[int]:
        """Of a text with fingerprints ``a`` followed by one of ``length`` bytes with ``b``."""
        return [(x * pow(base, length, self.prime) + y) % self.prime for x, y, base in zip(a, b, self.bases)]


class _Hash:
    """Adds n_bytes, sha256 and, for texts of one chunk, the fingerprints f and g."""

    def __init__(self, args: tuple, column: str, names: list[str]):
        self.args, self.column, self.names = args, column, names

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly, chunk = Poly(*self.args), self.args[0]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t.translate(LOWER) for t in utf8(part, self.column)]
                marks = [poly.of(t) if len(t) <= chunk else [None, None] for t in texts]
                new = [
                    pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                    pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *self.names])


class _Cut:
    """Rows (text, ...) -> their chunks with a position: (others ..., pos, part)."""

    def __init__(self, chunk: int, others: list[str]):
        self.chunk, self.others = chunk, others

    def __call__(self, batches):
        rows, size = [], 0
        for batch in batches:
            kinds = [batch.schema.field(c).type for c in self.others]
            others = list(zip(*(batch.column(c).to_pylist() for c in self.others)))
            texts = batch.column("text").cast(pa.binary())
            for i, same in enumerate(others):
                text = (texts[i].as_py() or b"").translate(LOWER)
                for pos, begin in enumerate(range(0, max(1, len(text)), self.chunk)):
                    rows.append((*same, pos, text[begin: begin + self.chunk]))
                    size += len(rows[-1][-1]) + 64
                    if size >= 4 << 20:
                        yield self._batch(rows, kinds)
                        rows, size = [], 0
            if rows:
                yield self._batch(rows, kinds)
                rows, size = [], 0

    def _batch(self, rows, kinds):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), [*kinds, pa.int64(), pa.binary()])], names=[*self.others, "pos", "part"])


class _HashChunks:
    def __init__(self, args: tuple):
        self.args = args

    def __call__(self, batches):
        poly = Poly(*self.args)
        for batch in batches:
            parts = batch.column("part").to_pylist()
            marks = [poly.of(p) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("pos"), pa.array([len(p) for p in parts], pa.int64()), pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64())],
                names=["row", "pos", "length", "f", "g"],
            )


class _Compose:
    """(row, chunks in order) -> (row, f, g): a few numbers a chunk, no text."""

    def __init__(self, args: tuple):
        self.args = args

    def __call__(self, batches):
        poly = Poly(1, *self.args[1:])
        for batch in batches:
            f, g = [], []
            for chunks in batch.column("chunks").to_pylist():
                now = [0, 0]
                for c in chunks:
                    now = poly.join(now, [c["f"], c["g"]], c["length"])
                f.append(now[0])
                g.append(now[1])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(f, pa.int64()), pa.array(g, pa.int64())], names=["row", "f", "g"])


class _Differ:
    """Chunks sorted by (group, block, pos, other) -> rows with a chunk that differs from
    that of the group's first row.  Holds one chunk."""

    def __call__(self, batches):
        key, first = None, None
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("head", "block", "pos", "row")]
            parts, out = batch.column("part"), []
            for i, (head, block, pos, row) in enumerate(zip(*cols)):
                part = parts[i].as_py()
                if (head, block, pos) != key:
                    if row != head:
                        raise RuntimeError("a block of a group has no copy of its first row")
                    key, first = (head, block, pos), part
                elif part != first:
                    out.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["row"])


def _grouped(rows: DataFrame) -> DataFrame:
    """(row, head, n, keep, keep_row) for ``rows`` (row, id, ..., salt) of each group ``f, g, n_bytes``.
    The rows of a group come together only as sums per salt."""
    group = ["f", "g", "n_bytes"]
    # the largest id, no null before others; of equal ids the first row
    best = F.max(F.struct(F.col("id").isNotNull().alias("has"), F.col("id").alias("id"), (-F.col("row")).alias("minus")))
    partial = rows.groupBy(*group, "salt").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("head"), best.alias("best"))
    total = partial.groupBy(*group).agg(F.sum("n").alias("n"), F.min("head").alias("head"), F.max("best").alias("best"))
    back = partial.select(*group, "salt").join(total, group)
    both = rows.select(*group, "salt", "row", "id").join(back, [*group, "salt"])
    return both.select(*group, "salt", "row", "id", "head", "n", F.col("best.id").alias("keep"), (-F.col("best.minus")).alias("keep_row"))


def _differing(grouped: DataFrame, texts: DataFrame, chunk: int) -> DataFrame:
    """Rows of groups of more than one whose text is not that of the group's first row."""
    members = grouped.where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    one = F.array(F.pmod(F.xxhash64("row"), F.col("blocks")))
    # the first row goes to every block
    to = F.when(F.col("row") == F.col("head"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(one)
    dealt = texts.join(members.select("row", "head", to.alias("to")), "row").select("row", "head", "to", "text")
    cut = dealt.mapInArrow(_Cut(chunk, ["row", "head", "to"]), "row long, head long, to array<long>, pos long, part binary")
    spread = cut.select("row", "head", F.explode("to").alias("block"), "pos", "part", (F.col("row") != F.col("head")).alias("other"))
    return spread.repartition("head", "block", "pos").sortWithinPartitions("head", "block", "pos", "other").mapInArrow(_Differ(), "row long").distinct()


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", into: str = "dedup", chunk: int = CHUNK, bases: tuple[int, int] = BASES, prime: int = PRIME) -> DataFrame:
    """``docs`` with a struct ``into``: ``keep_id`` (id of the row that stays), ``group_size``,
    ``kept`` and ``text_sha256`` (of the lower-cased text)."""
    spark = docs.sparkSession
    folder = run_dir(spark, "exact")
    args = (chunk, bases, prime)
    # the columns under names of our own, so that none clashes
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.col(f"`{text_col}`").cast("string").alias("text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema.fields)
    made = own.mapInArrow(_Hash(args, "text", ["n_bytes", "sha", "f", "g"]), f"{fields}, n_bytes long, sha string, f long, g long")
    made = made.drop("text").withColumn("row", F.monotonically_increasing_id())
    made.write.option("compression", "zstd").parquet(f"{folder}/rows")
    stored = spark.read.schema(made.schema).parquet(f"{folder}/rows")
    texts = stored.select("row", F.col(names[text_col]).cast("string").alias("text"))

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    long = stored.where("f IS NULL").select("row", F.col(names[text_col]).cast("string").alias("text"))
    hashed = long.mapInArrow(_Cut(chunk, ["row"]), "row long, pos long, part binary").repartition("row", "pos").mapInArrow(_HashChunks(args), "row long, pos long, length long, f long, g long")
    chunks = hashed.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "length", "f", "g"))).alias("chunks"))
    composed = written(chunks.mapInArrow(_Compose(args), "row long, f long, g long"), "composed")
    plain = stored.select("row", F.col(names[id_col]).alias("id"), "n_bytes", "f", "g")
    whole = plain.where("f IS NOT NULL").unionByName(plain.drop("f", "g").where(F.col("n_bytes") > chunk).join(composed, "row"))
    salted = whole.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)))
    done, left = None, salted
    for n in range(1 << 20):
        grouped = written(_grouped(left), f"groups-{n}")
        other = written(_differing(grouped, texts, chunk), f"differ-{n}")
        if other.isEmpty():
            return _result(stored, names, grouped if done is None else done.unionByName(grouped), docs, into)
        # collisions: the rows equal to their first one are a group, the others start anew
        same = written(_grouped(grouped.join(other, "row", "left_anti").select("f", "g", "n_bytes", "salt", "row", "id")), f"same-{n}")
        left = grouped.join(other, "row", "left_semi").select("f", "g", "n_bytes", "salt", "row", "id")
        done = same if done is None else done.unionByName(same)


def _result(stored: DataFrame, names: dict[str, str], grouped: DataFrame, docs: DataFrame, into: str) -> DataFrame:
    into = free_name(docs, into)
    decided = grouped.select("row", F.col("keep").alias("k"), F.col("n").alias("size"), (F.col("row") == F.col("keep_row")).alias("stays"))
    both = stored.join(decided, "row")
    verdict: Column = F.struct(F.col("k").alias("keep_id"), F.col("size").alias("group_size"), F.col("stays").alias("kept"), F.col("sha").alias("text_sha256"))
    return both.select(*[F.col(n).alias(c) for c, n in names.items()], verdict.alias(into))


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    into = free_name(docs, "dedup")
    return duplicates(docs, id_col, text_col, into, **how).where(F.col(into)["kept"]).select(*docs.columns)
