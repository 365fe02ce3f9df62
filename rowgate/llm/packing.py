"""Packing token streams into fixed windows by Karmarkar-Karp differencing.

Each task turns its documents into ids and cuts them into pieces: whole
windows out of long documents first, the rest in pieces of at most
``max_piece`` ids, and every so often a document into fine pieces (powers of
two from 64 down) with which differencing evens out the last few ids.  Blocks
of ``block_windows`` windows are then divided by :func:`kk.pack`.  What is left
at the end of a task fills whole windows and then sequences of falling powers
of two, which need no padding.

There is no shuffle and no group to be hot; a block (about half a million ids)
is all that a task holds.  A sequence number is the task's partition number
times 2**32 plus a running number, so a task that runs again after a loss gives
the same sequences.

Null texts are empty: one end id.  Repeated rows are packed once each, under
their (equal) doc_id.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kk
from .frames import utf8
from .tokens import piece_ids

FINE = (64, 32, 16, 8, 4, 2, 1, 1)  # sizes of fine pieces, repeated


class _Packer:
    def __init__(self, doc_col: str, kind, text_col: str, path: str, window: int, end_id: int, max_piece: int, block_windows: int, fine: int):
        self.doc_col, self.kind, self.text_col, self.path = doc_col, kind, text_col, path
        self.window, self.end = window, end_id.to_bytes(4, "little")
        self.max_piece, self.block, self.fine = max_piece, block_windows * window, fine * block_windows

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        self.next_id = TaskContext.get().partitionId() << 32
        self.held: list[tuple] = []  # pieces: (doc, start, ids, doc_tokens)
        self.sum = self.fined = 0
        encoder = piece_ids(self.path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                done = []
                for doc, text in zip(part.column(self.doc_col).to_pylist(), utf8(part, self.text_col)):
                    done += self._add(doc, encoder.ids(text) + self.end)
                if done:
                    yield self._rows(done)
        done = self._last()
        if done:
            yield self._rows(done)

    def _add(self, doc, ids: bytes) -> list[tuple]:
        n, w, done, start = len(ids) // 4, self.window, [], 0
        while n - start >= w:
            done.append((doc, start, ids[4 * start: 4 * (start + w)], n, self.next_id, 0))
            self.next_id += 1
            start += w
        while start < n:
            # the last piece of a block is cut so that the block is full to the id
            room = min(n - start, self.block - self.sum)
            for size in self._sizes(room):
                self.held.append((doc, start, ids[4 * start: 4 * (start + size)], n))
                start += size
            self.sum += room
            if self.sum == self.block:
                done += self._pack()
        return done

    def _sizes(self, n: int) -> list[int]:
        if self.fined < self.fine and n >= 2 * FINE[0]:
            self.fined += n
            out, left = [], n
            while left:
                for f in FINE:
                    if f <= left:
                        out.append(f)
                        left -= f
            return out
        parts = -(-n // self.max_piece)
        return [n // parts + (i < n % parts) for i in range(parts)]

    def _pack(self) -> list[tuple]:
        done = []
        for subset in kk.pack([len(p[2]) // 4 for p in self.held], self.window):
            at = 0
            for i in sorted(subset):
                done.append((*self.held[i], self.next_id, at))
                at += len(self.held[i][2]) // 4
            self.next_id += 1
        self.held, self.sum, self.fined = [], 0, 0
        return done

    def _last(self) -> list[tuple]:
        """The rest of the task: as many full windows as it has, then powers of two."""
        if not self.held:
            return []
        full, tail = self.sum // self.window * self.window, []
        pieces, self.held, at = self.held, [], 0
        for doc, start, ids, n in pieces:
            k = len(ids) // 4
            here = max(0, min(k, full - at))
            if here:
                self.held.append((doc, start, ids[: 4 * here], n))
            if here < k:
                tail.append((doc, start + here, ids[4 * here:], n))
            at += k
        done = self._pack() if self.held else []
        left = at - full
        while left:
            room, offset = 1 << (left.bit_length() - 1), 0
            left -= room
            while offset < room:
                doc, start, ids, n = tail[0]
                k = min(len(ids) // 4, room - offset)
                done.append((doc, start, ids[: 4 * k], n, self.next_id, offset))
                offset += k
                tail[0] = (doc, start + k, ids[4 * k:], n)
                if not tail[0][2]:
                    tail.pop(0)
            self.next_id += 1
        return done

    def _rows(self, done: list[tuple]) -> pa.RecordBatch:
        doc, start, ids, n, seq, offset = map(list, zip(*done))
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, self.kind), pa.array(start, pa.int64()), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(n, pa.int64()), pa.array(seq, pa.int64()), pa.array(offset, pa.int64())],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )


def pack_documents(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, max_piece: int = 512, block_windows: int = 256, fine: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: its document and place there, its ``ids`` (little-endian
    unsigned 32-bit), its sequence and place there.

    ``window`` must be a power of two.  ``fine`` is how many ids per window come
    in fine pieces.  A sequence holds at most ``window`` ids.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType
    fn = _Packer("doc_id", to_arrow_type(kind), "text", path, window, end_id, max_piece, block_windows, fine)
    return rows.mapInArrow(fn, f"doc_id {kind.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with a CRC-32 in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
