"""Packing token ids into sequences: harmonic classes (op9) and best fit decreasing with a segment tree (op8).

Both cut a document's ids into pieces, each id in exactly one piece, and fill sequences of at most `capacity` ids.
Every worker packs its own partition with memory bounded by a constant, so nothing is shuffled, and a task that is run
again gives the same sequences. A sequence's number holds its partition's number in the upper bits.

Harmonic: whole sequences are cut off first. A rest of n ids is of class k = capacity // n, and k rests of class k
are a bin; rests of the last class and shorter ones fill bins one after another. What such a bin has left waits for
filling: the next documents longer than the capacity, or any document when `waiting` bins wait, give their first ids
to it, so all other rests stay whole and bins are full. Bins that are open at the end of a partition are laid end to
end and cut into full sequences and at last into powers of two, which need no padding.

Best fit decreasing: pieces of at most the capacity are gathered up to a fixed number of ids, sorted by length, and
each goes to the fullest bin that still holds it, found in a segment tree over the free capacities.

Defined cases. A null or empty text is the end id alone. Documents of any length are cut without loss. A null doc_id is
packed like any other and stays null; repeated rows are packed each. Other columns are not looked at. An empty table
gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import release, text_passes
from .tokens import TOGETHER, encoder

#: Bits of a sequence's number below its partition's.
LOCAL_BITS = 36
PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
PIECE_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
ROW = pa.schema([("sequence_id", pa.int64()), ("n_tokens", pa.int64()), ("n_segments", pa.int64()), ("input_ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())), ("position_ids", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64()))])
ROW_DDL = "sequence_id long, n_tokens long, n_segments long, input_ids binary, cu_seqlens array<int>, position_ids binary, doc_ids array<long>, doc_starts array<long>"


@dataclass(frozen=True)
class Params:
    """tokenizer: path of a tokenizers file. end: the id that ends a document. classes: the number of the last class.

    waiting: bins that wait for filling at most.

    gathered: ids that best fit decreasing sorts together. pad: the id after a sequence's last."""

    tokenizer: str
    end: int = 1
    capacity: int = 2048
    classes: int = 32
    waiting: int = 64
    gathered: int = 1 << 21
    pad: int = 0


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int


def documents_of(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[tuple[int | None, np.ndarray]]:
    """doc_id and ids, the end id included, of each row."""
    encode, end = encoder(p.tokenizer), np.array([p.end], dtype="<u4")
    for batch in batches:
        for a, b, texts in text_passes(batch.column(1), TOGETHER):
            for doc_id, ids in zip(batch.column(0).slice(a, b - a).to_pylist(), encode.ids([t.decode() for t in texts]), strict=True):
                yield doc_id, np.concatenate([ids, end])
    release()


class _Out:
    """Rows of pieces, let go in batches."""

    def __init__(self, with_ids: bool):
        self.rows: list[tuple] = []
        self.with_ids = with_ids

    def add(self, piece: Piece, sequence: int, offset: int) -> None:
        raw = piece.ids.tobytes()
        self.rows.append((piece.doc_id, piece.start, piece.ids.size, zlib.crc32(raw), piece.doc_tokens, sequence, offset, raw if self.with_ids else None))

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(PIECE)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECE, strict=True)], schema=PIECE)


def _harmonic(batches: Iterator[pa.RecordBatch], p: Params, with_ids: bool) -> Iterator[pa.RecordBatch]:
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << LOCAL_BITS
    out, bins, waiting = _Out(with_ids), {}, []  # class -> its open bin; full bins with room, and how much

    def close(pieces: list[Piece]) -> None:
        nonlocal number
        offset = 0
        for piece in pieces:
            out.add(piece, number, offset)
            offset += piece.ids.size
        number += 1

    def settle(pieces: list[Piece]) -> None:
        room = p.capacity - sum(x.ids.size for x in pieces)
        waiting.append((pieces, room)) if room else close(pieces)

    for doc_id, ids in documents_of(batches, p):
        at = 0
        if ids.size > p.capacity or len(waiting) >= p.waiting:
            while waiting and at < ids.size:
                pieces, room = waiting.pop()
                pieces.append(Piece(doc_id, at, ids[at : at + room], ids.size))
                at += pieces[-1].ids.size
                settle(pieces)
        while ids.size - at >= p.capacity:
            close([Piece(doc_id, at, ids[at : at + p.capacity], ids.size)])
            at += p.capacity
        if at < ids.size:
            rest = Piece(doc_id, at, ids[at:], ids.size)
            k = min(p.classes, p.capacity // rest.ids.size)
            held = bins.setdefault(k, [])
            if k == p.classes and sum(x.ids.size for x in held) + rest.ids.size > p.capacity:
                settle(bins.pop(k))
                held = bins.setdefault(k, [])
            held.append(rest)
            if k < p.classes and len(held) == k:
                settle(bins.pop(k))
        if len(out.rows) >= 10_000:
            yield out.taken()
    rest = [piece for pieces, _ in waiting for piece in pieces] + [piece for k in sorted(bins) for piece in bins[k]]
    left = sum(piece.ids.size for piece in rest)
    sizes = [p.capacity] * (left // p.capacity) + [1 << b for b in reversed(range(p.capacity.bit_length())) if (left % p.capacity) >> b & 1]
    rest.reverse()
    for size in sizes:
        taken = []
        while size:
            piece = rest.pop()
            if piece.ids.size > size:
                rest.append(Piece(piece.doc_id, piece.start + size, piece.ids[size:], piece.doc_tokens))
                piece = Piece(piece.doc_id, piece.start, piece.ids[:size], piece.doc_tokens)
            taken.append(piece)
            size -= piece.ids.size
        close(taken)
    yield out.taken()


def pack_harmonic(documents: DataFrame, p: Params, with_ids: bool = True) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if wanted, ids (little-endian unsigned 32-bit)."""
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    done = rows.mapInArrow(partial(_harmonic, p=p, with_ids=with_ids), PIECE_DDL)
    return done if with_ids else done.drop("ids")


class CapacityTree:
    """A segment tree over free capacities 0 to top: which hold a bin, and the least of them from a value on."""

    def __init__(self, top: int):
        self.size = 1 << top.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, free: int, by: int) -> None:
        node = free + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def least(self, free: int) -> int:
        """The least capacity with a bin that is free or more; -1 if there is none."""
        node = free + self.size
        if self.count[node]:
            return free
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node + (not self.count[2 * node])
                return node - self.size
            node >>= 1
        return -1


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """The bins, as lists of positions in lengths."""
    tree, open_bins, bins = CapacityTree(capacity), [[] for _ in range(capacity + 1)], []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        free = tree.least(lengths[k])
        if free < 0:
            at, free = len(bins), capacity
            bins.append([])
        else:
            at = open_bins[free].pop()
            tree.add(free, -1)
        bins[at].append(k)
        if free > lengths[k]:
            open_bins[free - lengths[k]].append(at)
            tree.add(free - lengths[k], 1)
    return bins


def _matrix_rows(pieces: list[Piece], first: int, p: Params) -> Iterator[pa.RecordBatch]:
    kind = "<u2" if encoder(p.tokenizer).whole.get_vocab_size() <= 1 << 16 else "<u4"
    bins = best_fit_decreasing([x.ids.size for x in pieces], p.capacity)
    for at in range(0, len(bins), 512):
        rows = []
        for k, members in enumerate(bins[at : at + 512], at):
            ids, places, ends = np.full(p.capacity, p.pad, dtype=kind), np.zeros(p.capacity, dtype="<u4"), [0]
            for m in members:
                x = pieces[m].ids
                ids[ends[-1] : ends[-1] + x.size] = x
                places[ends[-1] : ends[-1] + x.size] = np.arange(x.size)
                ends.append(ends[-1] + x.size)
            rows.append((first + k, ends[-1], len(members), ids.tobytes(), ends, places.tobytes(), [pieces[m].doc_id for m in members], [pieces[m].start for m in members]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ROW, strict=True)], schema=ROW)


def _best_fit(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << LOCAL_BITS
    pieces, held = [], 0
    for doc_id, ids in documents_of(batches, p):
        for at in range(0, ids.size, p.capacity):
            pieces.append(Piece(doc_id, at, ids[at : at + p.capacity], ids.size))
        held += ids.size
        if held >= p.gathered:
            yield from _matrix_rows(pieces, number, p)
            number += len(pieces)  # as many numbers as there can be bins
            pieces, held = [], 0
    if pieces:
        yield from _matrix_rows(pieces, number, p)


def pack_best_fit(documents: DataFrame, p: Params) -> DataFrame:
    """One row for each sequence: its ids and positions as little-endian rows of capacity numbers (ids of 16 bits where the vocabulary allows), cu_seqlens, and each segment's document and place in it."""
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(partial(_best_fit, p=p), ROW_DDL)


def write_packed(packed: DataFrame, path: str) -> None:
    """The packed rows as Parquet, for any store that Spark writes."""
    packed.write.mode("overwrite").parquet(path)
