"""Ranked lexical search: the best documents for each item, from document FP-trees.

Documents are restricted to the terms of the items, a vector of term counts each.
A task takes its documents in blocks.  In a block the vectors, terms in order of
falling document frequency, are put in one lexicographic order, so that documents
with the same first terms share a path of a trie.  Every node holds, over the
documents of its subtree, the largest count of each term and the smallest length
factor ``m``.  A term's part of a score grows with its count and falls with ``m``,
so these give an upper bound of all scores below the node.  Each item walks the
trie depth first, the best bound first, and leaves out subtrees whose bound is
below its last place so far; places carry over from block to block of a task.
Subtrees of up to ``LEAF`` documents, and small ones side by side, are leaves whose
documents are scored one by one.  Results are exact: a subtree is left out only if
no document in it can get a place.

The items are the stated query set.  They are taken in blocks of at most
``max_terms`` different terms (one item may have more), each of which reads the
documents once; what is broadcast is bounded by that, and what a task holds by
``CELLS`` counts.  The first rows of an item come together in two steps.

Terms are runs of ASCII letters and digits and of all other characters from 0x80,
A-Z lower-cased.  Texts that are null or have no term are no documents of the corpus
(they don't count in ``N``) and items without terms find nothing.  Each row is a
document or an item of its own, so repeated rows rank one after the other and
repeated items give their result as often; equal scores go by ascending id, null ids
last.  Ids may be of any type with an order (numbers, strings, dates).  Empty tables
on either side give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.session import run_dir

from .frames import annotate, first_rows, folded_words

LEAF = 64  # documents of a leaf
CELLS = 8 << 20  # counts a block holds (4 bytes each)
BLOCK = 4096  # documents of a block at most
B_PERCENT, K_EIGHTS = 75, 8  # length normalisation in percent; saturation 0.8, times 1000 over 100


class _Vectors:
    """Texts -> number of terms, and which of the items' terms they have how often."""

    def __init__(self, vocabulary):
        self.ids = vocabulary.value

    def __call__(self, texts: list[bytes]) -> list[list]:
        get, n, terms, counts = self.ids.get, [], [], []
        for t in texts:
            words = folded_words(t)
            n.append(len(words))
            found = sorted((i, k) for w, k in Counter(words).items() if (i := get(w)) is not None)
            terms.append([i for i, _ in found])
            counts.append([k for _, k in found])
        return [n, terms, counts]


def parts_of_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score per unit of its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + K_EIGHTS * m)


def length_factor(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """``m`` of documents with ``n`` terms; by whole numbers of any size where 64 bits don't do."""
    if len(n) and B_PERCENT * int(n.max()) * documents >= 1 << 63:
        n = n.astype(object)
    return (100 - B_PERCENT + (B_PERCENT * n * documents) // terms).astype(np.int64)


class Tree:
    """The trie of one block: ``tf`` (documents, terms by rank) and ``m`` in the trie's order.

    Node 0 is the root.  ``children[i]`` is empty for a leaf, whose documents are
    ``span[i]``; ``most`` and ``least`` hold each node's largest counts and smallest m.
    """

    def __init__(self, tf: np.ndarray, m: np.ndarray, leaf: int = LEAF):
        paths = [np.flatnonzero(row) for row in tf]
        keys = [p.astype(">u4").tobytes() for p in paths]  # bytes compare as the ranks do
        self.order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        self.tf, self.m, self.leaf = tf[self.order], m[self.order], leaf
        self.paths = [paths[i].tolist() for i in self.order.tolist()]
        self.children: list[list[int]] = []
        self.span: list[tuple[int, int]] = []
        self._grow(0, len(keys))
        self.most = np.zeros((len(self.span), tf.shape[1]), tf.dtype)
        self.least = np.zeros(len(self.span), np.int64)
        for i in range(len(self.span) - 1, -1, -1):  # children come after their parents
            if self.children[i]:
                self.most[i] = self.most[self.children[i]].max(axis=0)
                self.least[i] = self.least[self.children[i]].min()
            else:
                lo, hi = self.span[i]
                self.most[i], self.least[i] = self.tf[lo:hi].max(axis=0), self.m[lo:hi].min()

    def _node(self, lo: int, hi: int) -> int:
        self.children.append([])
        self.span.append((lo, hi))
        return len(self.span) - 1

    def _grow(self, lo: int, hi: int) -> None:
        open_ = [(self._node(lo, hi), 0)]
        while open_:
            node, depth = open_.pop()
            lo, hi = self.span[node]
            if hi - lo <= self.leaf:
                continue
            first, last = self.paths[lo], self.paths[hi - 1]
            if first == last:  # one path: leaves side by side
                cuts = list(range(lo, hi, self.leaf))
                self.children[node] = [self._node(a, min(a + self.leaf, hi)) for a in cuts]
                continue
            while depth < len(first) and first[depth] == last[depth]:  # the shared path
                depth += 1
            at = [p[depth] if depth < len(p) else -1 for p in self.paths[lo:hi]]
            edges = [lo, *(lo + i for i in range(1, hi - lo) if at[i] != at[i - 1]), hi]
            begin = lo
            for a, b in zip(edges, edges[1:]):
                if b - a > self.leaf:  # a subtree of its own; the small ones before it are a leaf
                    if begin < a:
                        self.children[node].append(self._node(begin, a))
                    self.children[node].append(self._node(a, b))
                    open_.append((self.children[node][-1], depth + (at[a - lo] >= 0)))
                    begin = b
                elif b - begin > self.leaf:
                    self.children[node].append(self._node(begin, a))
                    begin = a
            if begin < hi:
                self.children[node].append(self._node(begin, hi))

    def bounds(self, ranks: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Of every node: no document below scores more."""
        return parts_of_score(self.most[:, ranks].astype(np.int64), self.least[:, None]) @ weights

    def scores(self, node: int, ranks: np.ndarray, weights: np.ndarray) -> np.ndarray:
        lo, hi = self.span[node]
        return parts_of_score(self.tf[lo:hi, ranks].astype(np.int64), self.m[lo:hi, None]) @ weights

    def search(self, ranks: np.ndarray, weights: np.ndarray, best: list[tuple], most: int, ids: list) -> None:
        """Put the block's documents into ``best``: (-score, whether the id is null, id), sorted,
        at most ``most``.  ``ids`` are in the order the block came in."""
        bound = self.bounds(ranks, weights).tolist()
        walk = [0]
        while walk:
            node = walk.pop()
            last = -best[-1][0] if len(best) == most else 1
            if bound[node] < last:
                continue
            if self.children[node]:
                walk.extend(sorted(self.children[node], key=bound.__getitem__))
                continue
            got = self.scores(node, ranks, weights)
            for i in np.flatnonzero(got >= last).tolist():
                name = ids[self.order[self.span[node][0] + i]]
                best.append((-int(got[i]), name is None, name))
            best.sort()
            del best[most:]


class _Search:
    def __init__(self, plan, most: int, kind: pa.DataType):
        self.plan, self.most, self.kind = plan, most, kind

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, terms, rank_of, items = self.plan.value  # items: [(number, ranks, weights)]
        width = max(1, len(rank_of))
        rows = max(1, min(BLOCK, CELLS // width))
        best: dict[int, list] = {number: [] for number, _, _ in items}

        def block(part: pa.RecordBatch) -> None:
            ids = part.column("id").to_pylist()
            n = part.column("n").to_numpy(zero_copy_only=False)
            lists, counts = part.column("terms"), part.column("counts")
            tf = np.zeros((len(ids), width), np.int32)
            row = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            tf[row, rank_of[flat]] = counts.flatten().to_numpy(zero_copy_only=False)
            tree = Tree(tf, length_factor(n, documents, terms))
            for number, ranks, weights in items:
                tree.search(ranks, weights, best[number], self.most, ids)

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                block(batch.slice(at, rows))
        found = [(number, -s, i) for number, rows_ in best.items() for s, _, i in rows_]
        if found:
            number, score, ids = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(ids, self.kind), pa.array(score, pa.int64())], names=["item", "id", "score"])


def _item_blocks(items: DataFrame, max_terms: int) -> Iterator[tuple[list, dict[bytes, int]]]:
    """([(id, terms with repeats)], numbers of the terms) with at most ``max_terms`` terms, or
    one item's; rows come to the driver one partition at a time."""
    block, ids = [], {}
    for name, text in items.toLocalIterator():
        words = Counter(folded_words((text or "").encode()))
        if not words:
            continue
        if block and len(ids.keys() | words.keys()) > max_terms:
            yield block, ids
            block, ids = [], {}
        block.append((name, words))
        for w in words:
            ids.setdefault(w, len(ids))
    if block:
        yield block, ids


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def search(docs: DataFrame, items: DataFrame, most: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_terms: int = 8192) -> DataFrame:
    """Each item's ``most`` best documents with a score above 0: item id, ``rank`` from 1,
    document id and ``score``."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    folder = run_dir(spark, "search")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("id"), F.col(item_text_col).cast("string").alias("text"))
    id_kind, item_kind = rows.schema["id"].dataType, asked.schema["id"].dataType
    found_schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("id", id_kind), T.StructField("score", T.LongType())])
    out_schema = T.StructType([T.StructField("item_id", item_kind), T.StructField("rank", T.IntegerType()), T.StructField("id", id_kind), T.StructField("score", T.LongType())])
    results = []
    for number, (block, ids) in enumerate(_item_blocks(asked, max_terms)):
        at = f"{folder}/{number}"
        made = annotate(rows, "text", "v", "n long, terms array<int>, counts array<int>", _Vectors, spark.sparkContext.broadcast(ids))
        made.select("id", "v.*").where("n > 0").write.option("compression", "zstd").parquet(f"{at}/vectors")
        vectors = spark.read.parquet(f"{at}/vectors")
        documents, terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            break
        df = np.zeros(len(ids), np.int64)
        for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[r[0]] = r[1]
        rank_of = np.empty(len(ids), np.int32)
        rank_of[np.argsort(-df, kind="stable")] = np.arange(len(ids))
        plan = []
        for i, (_, words) in enumerate(block):
            of = sorted((int(rank_of[ids[w]]), weight(documents, int(df[ids[w]])) * k) for w, k in words.items() if df[ids[w]])
            if of:
                plan.append((i, np.array([r for r, _ in of]), np.array([w for _, w in of], np.int64)))
        sent = spark.sparkContext.broadcast((documents, terms, rank_of, plan))
        found = vectors.mapInArrow(_Search(sent, most, to_arrow_type(id_kind)), found_schema)
        best = first_rows(found, ["item"], [F.desc("score"), F.asc_nulls_last("id")], most, "rank")
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", item_kind)]))
        best.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "id", "score").write.parquet(f"{at}/best")
        results.append(f"{at}/best")
    out = spark.read.schema(out_schema).parquet(*results) if results else spark.createDataFrame([], out_schema)
    return out.withColumnRenamed("id", id_col).withColumnRenamed("item_id", item_col)
