"""Substring dedup by a compacted De Bruijn graph of token k-mers.

A window of words is an edge from its first to its last words but one. The graph is compacted by anchors: each window
is assigned to the least hash of the short word runs inside it, so equal windows have equal anchors, and the windows
that follow one another under one occurrence of an anchor are a path. Paths with an anchor that occurs once in the
corpus hold no repeated window and go. An anchor whose paths all have the same content does not branch: its whole path
is one edge of the compacted graph. Where contents branch, the windows of one path per content are compared one by
one. Source coordinates (document, word) say which occurrence is the first and give the exact spans of all later ones.
A path that its own text holds earlier is a later one whatever other texts hold: such paths are laid together where they
are found and join nothing, so a word said a thousand times (a path for each window) is one path and one span.

Work: scans of the texts, of which the first shuffles one (anchor, count) pair for every few words, the second only
paths whose anchor repeats, and the third only the first path of each content whose anchor branches, with its windows. Fixed-size bitmaps
make the later scans cheap; the joins after them are exact. Only documents that lose words are shuffled.

Defined cases. A null text has no words. Coordinates order by doc_id (null first), then word. Rows that repeat a
doc_id have the same coordinates, so neither is earlier than the other by its place, only by an earlier word.
Documents shorter than a window keep all words. Very long texts are used whole, in memory of the longest. A word is any run of bytes other than space and \\t to \\r, unchanged.
Other columns pass through, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import NULL_DOC, Words, bitmap, in_bitmap, mix, powers, release, rolled, rows_by_bitmap, text_passes, written

#: Words of a window; words of an anchor run.
WINDOW, ANCHOR = 20, 6
#: Bytes of text whose anchors are counted together before they are sent.
ANCHOR_BYTES = 1 << 20


class Paths:
    """The paths of some texts: row (text), start (word), n (windows), anchor, content; and windows, the hash of each."""

    def __init__(self, texts: list[bytes], window: int, anchor: int, contents: bool = True):
        words = Words(texts)
        runs = rolled(words.hashes, anchor)
        width = window - anchor + 1
        none = np.zeros(0, dtype=np.int64)
        self.row, self.start, self.n, self.anchor, self.content = none, none, none, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        if words.hashes.size < window:
            return
        least = np.lib.stride_tricks.sliding_window_view(runs, width).argmin(axis=1)
        at = np.arange(least.size) + least
        text = np.searchsorted(words.first, np.arange(least.size), side="right") - 1
        inside = np.arange(least.size) + window <= words.first[1:][text]
        new = np.ones(least.size, dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, least.size))
        begins, sizes = begins[inside[begins]], sizes[inside[begins]]
        self.row = text[begins]
        self.begin = begins
        self.start = begins - words.first[self.row]
        self.n = sizes
        self.anchor = runs[at[begins]]
        if contents:
            up, down = powers(words.hashes.size)
            self.sums = np.zeros(words.hashes.size + 1, dtype=np.uint64)
            np.cumsum(words.hashes * up[: words.hashes.size], out=self.sums[1:])
            self.down = down
            self.content = self._hash(begins, begins + sizes + window - 1)
            self.window = window

    def _hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def windows(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the windows of the paths in keep, path by path, and where each path's end."""
        ends = np.cumsum(self.n[keep])
        starts = np.repeat(self.begin[keep] - ends + self.n[keep], self.n[keep]) + np.arange(ends[-1] if ends.size else 0)
        return self._hash(starts, starts + self.window), ends


def _place(content: np.ndarray, doc_key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A hash of one occurrence of a content."""
    return mix(content.view(np.uint64) + mix(doc_key.view(np.uint64) * np.uint64(3) + start.view(np.uint64))).view(np.int64)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_place(*(batch.column(k).to_numpy() for k in range(3))))], names=["h"])


def _anchors(batches: Iterator[pa.RecordBatch], window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, texts in text_passes(batch.column(0), ANCHOR_BYTES):
            found, counts = np.unique(Paths(texts, window, anchor, contents=False).anchor, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], names=["anchor", "n"])


def _again(row: np.ndarray, anchor: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Which paths, by row and start, have an anchor and content that an earlier path of their row has."""
    order = np.lexsort((content, anchor, row))
    out = np.zeros(row.size, dtype=bool)
    out[order[1:]] = np.logical_and.reduce([x[order[1:]] == x[order[:-1]] for x in (row, anchor, content)])
    return out


def _laid_together(row: np.ndarray, start: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, start and n (windows) of paths, by row and start, where those of a row whose words overlap or touch are one."""
    new = np.ones(row.size, dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > start[:-1] + n[:-1] + window - 1)
    first = np.flatnonzero(new)
    last = np.flatnonzero(np.append(new[1:], True)[: row.size])  # paths of a text end in the order in which they start
    return row[first], start[first], start[last] + n[last] - start[first]


def _paths(batches: Iterator[pa.RecordBatch], window: int, anchor: int, bits: np.ndarray, unrolled: bool) -> Iterator[pa.RecordBatch]:
    """The paths whose anchor may be in bits, the first of each anchor and content of a text, and spans of its others (again);
    unrolled: those whose place may be, with the hash of each of their windows."""
    for batch in batches:
        keys = batch.column(0).to_numpy()
        for a, _, texts in text_passes(batch.column(2)):
            p = Paths(texts, window, anchor)
            if not p.n.size:
                continue
            named = _place(p.content, keys[p.row + a], p.start) if unrolled else p.anchor.view(np.int64)
            keep = np.flatnonzero(in_bitmap(bits, named))
            if not unrolled:
                again = _again(p.row[keep], p.anchor[keep], p.content[keep])
                row, start, n = _laid_together(p.row[keep[again]], p.start[keep[again]], p.n[keep[again]], window)
                keep = keep[~again]
                rows = pa.array(np.concatenate([p.row[keep], row]) + a)
                hashes = [pa.concat_arrays([pa.array(x[keep].view(np.int64)), pa.nulls(row.size, pa.int64())]) for x in (p.anchor, p.content)]
                columns = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(np.concatenate([p.start[keep], start])), pa.array(np.concatenate([p.n[keep], n])), *hashes, pa.array(np.arange(len(rows)) >= keep.size)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_key", "text_hash", "start", "n", "anchor", "content", "again"])
                continue
            rows = pa.array(p.row[keep] + a)
            columns = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(p.start[keep]), pa.array(p.n[keep]), pa.array(p.anchor[keep].view(np.int64)), pa.array(p.content[keep].view(np.int64))]
            hashes, ends = p.windows(keep)
            offsets = np.concatenate([[0], ends * 8]).astype(np.int32)
            columns.append(pa.Array.from_buffers(pa.binary(), keep.size, [None, pa.py_buffer(offsets), pa.py_buffer(hashes)]))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_key", "text_hash", "start", "n", "anchor", "content", "windows"])


def _unrolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = np.repeat(np.arange(batch.num_rows), batch.column(4).to_numpy())
        hashes = np.frombuffer(b"".join(batch.column(5).to_pylist()), dtype=np.int64)
        nth = np.concatenate([np.arange(n) for n in batch.column(4).to_numpy()] or [np.zeros(0, dtype=np.int64)])
        rows = pa.array(at)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), batch.column(2).take(rows), pa.array(batch.column(3).to_numpy()[at] + nth), pa.array(hashes), pa.array(nth)], names=["anchor", "content", "doc_key", "start", "window", "nth"])


def repeated_spans(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_key (doc_id, null as the least long), text_hash, start, n: the words from start on, n of them, are covered by repeated windows."""
    keyed = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_DOC)).alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    counts = keyed.select("text").mapInArrow(partial(_anchors, window=window, anchor=anchor), "anchor long, n long")
    repeated = written(counts.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"))
    bits = bitmap(repeated, "anchor")
    columns = "doc_key long, text_hash long, start long, n long, anchor long, content long"
    paths = written(keyed.mapInArrow(partial(_paths, window=window, anchor=anchor, bits=bits, unrolled=False), f"{columns}, again boolean"))
    once = paths.where("not again")

    contents = written(once.groupBy("anchor", "content").agg(F.count("*").alias("times"), F.min(F.struct("doc_key", "start")).alias("first")).select("anchor", "content", "times", F.col("first.doc_key").alias("first_doc"), F.col("first.start").alias("first_start")))
    # Paths of a content after its first one are repeated as a whole.
    later = once.join(contents.where("times > 1").drop("times"), ["anchor", "content"]).where("doc_key > first_doc or start > first_start").select("doc_key", "text_hash", "start", "n")
    later = later.union(paths.where("again").select("doc_key", "text_hash", "start", "n")).withColumn("n", F.col("n") + window - 1)
    # Where an anchor's contents branch, the windows of each content's first path are compared one by one.
    branching = contents.groupBy("anchor").agg(F.count("*").alias("contents")).where("contents > 1").select("anchor")
    firsts = written(contents.join(branching, "anchor", "left_semi").select("anchor", "content", F.col("first_doc").alias("doc_key"), F.col("first_start").alias("start")))
    places = bitmap(firsts.select("content", "doc_key", "start").mapInArrow(_places, "h long"), "h")
    open_paths = keyed.mapInArrow(partial(_paths, window=window, anchor=anchor, bits=places, unrolled=True), f"{columns}, windows binary")
    rows = written(open_paths.join(firsts, ["anchor", "content", "doc_key", "start"]).select("anchor", "content", "doc_key", "start", "n", "windows", "text_hash"))
    single = rows.drop("text_hash").dropDuplicates(["anchor", "content", "doc_key", "start"]).select("anchor", "content", "doc_key", "start", "n", "windows").mapInArrow(_unrolled, "anchor long, content long, doc_key long, start long, window long, nth long")
    single = written(single)
    least = single.groupBy("anchor", "window").agg(F.count("*").alias("times"), F.min(F.struct("doc_key", "start")).alias("first")).where("times > 1")
    again = single.join(least, ["anchor", "window"]).where("doc_key > first.doc_key or (doc_key = first.doc_key and start > first.start)")
    again = again.groupBy("anchor", "content").agg(F.collect_list("nth").alias("nths"))
    branched = rows.select("anchor", "content", "doc_key", "text_hash", "start").join(again, ["anchor", "content"]).select("doc_key", "text_hash", F.explode(F.transform("nths", lambda k: F.col("start") + k)).alias("start"), F.lit(window).cast("long").alias("n"))
    return later.union(branched)


def _cut(batches: Iterator[pa.RecordBatch], text_at: int, spans_at: int | None, bits: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """The text column without its spans' words, and what that leaves; no column spans_at: nothing goes.

    bits: only the rows whose first column cannot be in it, without that column."""
    for batch in batches:
        if bits is not None:
            batch = batch.filter(pa.array(~in_bitmap(bits, batch.column(0).to_numpy()))).select(list(range(1, batch.num_columns)))
        ends = np.zeros(batch.num_rows + 1, dtype=np.int64)
        if spans_at is not None:
            spans = batch.column(spans_at)
            ends = spans.offsets.to_numpy()
            starts, sizes = (spans.values.field(k).to_numpy(zero_copy_only=False) for k in ("start", "n"))
        kept, digests, words_in, words_out = [], [], [], []
        for k, text in enumerate(batch.column(text_at)):
            text = text.as_py()
            words = (text or "").encode().split()
            n = len(words)
            a, b = ends[k], ends[k + 1]
            if b > a:
                cover = np.zeros(n + 1, dtype=np.int64)
                np.add.at(cover, starts[a:b], 1)
                np.add.at(cover, np.minimum(starts[a:b] + sizes[a:b], n), -1)
                words = [words[j] for j in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]
            joined = b" ".join(words)
            kept.append(joined.decode() if len(words) < n else text)
            digests.append(hashlib.sha256(joined).hexdigest())
            words_in.append(n)
            words_out.append(n - len(words))
        left = [batch.column(j) for j in range(text_at)]
        yield pa.RecordBatch.from_arrays([*left, pa.array(kept, pa.string()), pa.array(words_in, pa.int64()), pa.array(words_out, pa.int64()), pa.array(digests, pa.string())], names=[*(f"c{j}" for j in range(len(left))), "kept", "n_words", "n_removed", "kept_sha256"])
        del kept, digests
        release()


def remove_repeats(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """documents with kept_text (null stays null; unchanged where nothing goes, else the kept words joined by a space), n_words, n_removed and kept_sha256 (of the kept words joined by a space)."""
    spans = written(repeated_spans(documents, window, anchor).distinct())
    bits = bitmap(spans.select(F.xxhash64("doc_key", "text_hash").alias("h")), "h")
    spans = spans.groupBy("doc_key", "text_hash").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    columns = documents.columns
    others = [c for c in columns if c != "text"]
    kinds = {f.name: f.dataType.simpleString() for f in documents.schema}
    named = documents.toDF(*[f"c_{k}" for k in range(len(columns))])
    at = lambda c: F.col(f"c_{columns.index(c)}")
    named = named.select(F.coalesce(at("doc_id").cast("long"), F.lit(NULL_DOC)).alias("key"), F.xxhash64(at("text")).alias("hash"), *[at(c).alias(f"c{k}") for k, c in enumerate(others)], at("text").cast("string").alias("text"))
    named = named.select(F.xxhash64("key", "hash").alias("h"), *named.columns)
    plain = [f"c{k}" for k in range(len(others))]
    schema = ", ".join([*(f"c{k} {kinds[c]}" for k, c in enumerate(others)), "kept_text string, n_words long, n_removed long, kept_sha256 string"])
    untouched = named.select("h", *plain, "text").mapInArrow(partial(_cut, text_at=len(others), spans_at=None, bits=bits), schema)
    joined = rows_by_bitmap(named, bits, True).join(spans, (F.col("key") == F.col("doc_key")) & (F.col("hash") == F.col("text_hash")), "left")
    touched = joined.select(*plain, "text", F.coalesce("spans", F.array().cast("array<struct<start:bigint,n:bigint>>")).alias("spans")).mapInArrow(partial(_cut, text_at=len(others), spans_at=len(others) + 1), schema)
    new = ["kept_text", "n_words", "n_removed", "kept_sha256"]
    return untouched.union(touched).select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(others) if c not in new], *new)
