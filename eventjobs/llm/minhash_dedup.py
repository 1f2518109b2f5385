"""MinHash near-duplicates by chosen-path set similarity join.

Every document becomes the set of its distinct word shingles and a signature of minwise values. A tree node splits
its documents by one or two chosen signature positions, so two sets of similarity s go on together with probability
s per position; nodes that are small enough are compared exhaustively on signatures, larger ones branch again, first
into several independent subtrees, and independent trees are repeated until a pair at the threshold is missed with
less than the target probability. Pairs whose signatures come near the threshold are confirmed on the full sets.

Only connections matter for the result, so what is known to be connected is never compared again: equal sets are one
row from the beginning; a first round links a spanning forest of small random blocks of every node, which joins large
groups of copies at linear cost; then trees only follow nodes that still hold two components or more, and where one
component has nearly all of a node only the rest is compared with it. A level's entries are made anew from the
signatures: bitmaps of the nodes that branched lead each set down its paths, so no level is joined with signatures.

Defined cases. A null text or one without words: empty set, linked with nothing, kept. Fewer words than a shingle:
the whole sequence is the one shingle. Very long texts are used whole; a worker holds one text's shingles at a time.
A null doc_id: links with nothing, component null, kept. Rows that repeat a doc_id: each row is judged on its own
text. A pair at the very threshold is a link; where links tie, any of them joins the same groups. The smallest doc_id
of a group is kept. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Words, bitmap, forget, in_bitmap, mix, release, rolled, spread, text_passes, written


@dataclass(frozen=True)
class Params:
    """shingle: words; a link needs part * intersection >= whole * union, as whole / part of similarity.

    stride: levels that a large node branches at once: a shingle that very many documents share brings unlike sets
    into one node, and few of them go on together. small: shingles of a set that goes along whole. positions: minwise values of a signature. slack: how far below the threshold an estimate still asks for a check
    on full sets. leaf: sets of a node that are compared exhaustively. recall: of pairs at the threshold."""

    shingle: int = 5
    whole: int = 80
    part: int = 100
    positions: int = 128
    small: int = 32
    slack: float = 0.1
    leaf: int = 64
    depth: int = 13
    stride: int = 6
    forest_trees: int = 3
    recall: float = 0.999

    @property
    def similarity(self) -> float:
        return self.whole / self.part

    @property
    def two(self) -> float:
        """How often a node chooses a second position: a pair at the threshold then goes on in one child on average."""
        return min(1.0, 1 / self.similarity - 1)

    @property
    def cut(self) -> int:
        """Equal positions from which a pair is checked: slack below the threshold, or less where that would take half of what recall allows."""
        below = np.cumsum(self._equal())  # below[k]: share of pairs at the threshold with up to k equal positions
        return min(math.ceil((self.similarity - self.slack) * self.positions), int(np.searchsorted(below, (1 - self.recall) / 2, side="right")))

    def missed(self, trees: int, subtrees: int, depth: int) -> float:
        """The share of pairs at the threshold that the estimate misses, or so many trees with so many subtrees whose nodes branch to a depth.

        All trees choose from the same positions, so that the share of equal ones of a pair is what counts in each."""
        equal = np.arange(self.positions + 1)

        def branched(on: np.ndarray) -> np.ndarray:
            one = equal / self.positions * on
            return (1 - self.two) * one + self.two * (1 - (1 - one) ** 2)

        stay = np.ones(self.positions + 1)
        for level in reversed(range(depth)):
            stay = branched(stay)
            if level == 1:
                stay = 1 - (1 - stay) ** subtrees
        return float(np.sum(self._equal() * np.where(equal < self.cut, 1.0, (1 - stay) ** trees)))

    def _equal(self) -> np.ndarray:
        """The chances of a pair at the threshold to have 0, 1, ... equal positions."""
        n, s = self.positions, self.similarity
        if s >= 1:
            return np.eye(n + 1)[n]
        ways = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(s) + (n - k) * math.log(1 - s) for k in range(n + 1)]
        return np.exp(ways)

    @cached_property
    def trees(self) -> int:
        """The fewest with three quarters of what recall allows where the first nodes are small, as nearly all are."""
        return next(n for n in count(1) if self.missed(n, 1, 1) <= 0.75 * (1 - self.recall))

    @cached_property
    def subtrees(self) -> int:
        """The fewest independent ones below a first node that meet recall where nodes branch to the last level."""
        return next(n for n in count(1) if self.missed(self.trees, n, self.depth) <= 1 - self.recall)


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """Of each text, the sorted distinct hashes of its shingles."""
    words = Words([t.lower() for t in texts])  # bytes.lower changes A-Z only
    all_rolled = rolled(words.hashes, size)
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= size:
            yield np.unique(all_rolled[a : b - size + 1])
        elif b > a:
            yield rolled(words.hashes[a:b], b - a)
        else:
            yield np.zeros(0, dtype=np.uint64)


def _signature_rows(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    rng = np.random.default_rng(7)
    scale = rng.integers(0, 1 << 31, size=p.positions, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 1 << 32, size=p.positions, dtype=np.uint32)
    for batch in batches:
        for a, b, texts in text_passes(batch.column(1)):
            sizes, ones, twos, signatures = [], [], [], []
            for s in shingle_sets(texts, p.shingle):
                sizes.append(s.size)
                ones.append(int(np.sum(mix(s + np.uint64(1)))) if s.size else None)
                twos.append(int(np.sum(mix(s ^ np.uint64(0x5851F42D4C957F2D)))) if s.size else None)
                if not s.size:
                    signatures.append(None)
                    continue
                low = (s >> np.uint64(32)).astype(np.uint32)
                least = np.full(p.positions, 0xFFFFFFFF, dtype=np.uint32)
                for at in range(0, low.size, 256):
                    least = np.minimum(least, (low[at : at + 256, None] * scale + shift).min(axis=0))
                signatures.append(s.size.to_bytes(4, "little") + least.tobytes() + (s.tobytes() if s.size <= p.small else b""))
            as_long = lambda xs: pa.array([None if x is None else (x & (1 << 64) - 1) - ((x >> 63 & 1) << 64) for x in xs], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(sizes, pa.int64()), as_long(ones), as_long(twos), pa.array(signatures, pa.binary())], names=["doc_id", "text_hash", "n_shingles", "node", "node2", "signature"])


def signatures(documents: DataFrame, p: Params) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, node and node2 (hashes that name the set) and the signature: the set's size, its minwise values, and a small set itself."""
    text = F.col("text").cast("string")
    return documents.select(F.col("doc_id").cast("long"), text, F.xxhash64(text).alias("text_hash")).mapInArrow(partial(_signature_rows, p=p), "doc_id long, text_hash long, n_shingles long, node long, node2 long, signature binary")


def _numbers(column: pa.Array, positions: int) -> np.ndarray:
    return np.frombuffer(b"".join(x[4 : 4 + 4 * positions] for x in column.to_pylist()), dtype=np.uint32).reshape(-1, positions)


def _children(keys: np.ndarray, values: np.ndarray, two: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row with its node's key: the keys of the one or two children it goes to, and its row number."""
    n, positions = values.shape
    rows = np.arange(n)
    draw = mix(keys ^ np.uint64(0xA0761D6478BD642F))
    first = (draw % np.uint64(positions)).astype(np.int64)
    second = ((first + 1 + (draw >> np.uint64(16)) % np.uint64(positions - 1)).astype(np.int64)) % positions
    both = (draw >> np.uint64(40)).astype(np.float64) < two * (1 << 24)
    out, at = [], []
    for chosen, which in ((first, np.ones(n, dtype=bool)), (second, both)):
        r = rows[which]
        c = chosen[which]
        out.append(mix(mix(keys[which] + c.astype(np.uint64)) ^ values[r, c].astype(np.uint64)))
        at.append(r)
    return np.concatenate(out), np.concatenate(at)


def _entries(batches: Iterator[pa.RecordBatch], p: Params, trees: list[int], two: float, trail: list[np.ndarray], bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Of each set (node, component, signature) its entries on the level below trail, the bitmaps of the nodes that branched.

    bits: only entries of nodes that may be in it, with their sketches."""
    for batch in batches:
        values, rows = _numbers(batch.column(2), p.positions), batch.column(2).to_pylist() if bits is not None else []
        for tree in trees if len(values) else []:
            keys, at = _children(np.full(len(values), mix(np.array([tree * 7919 + 13], dtype=np.uint64))[0]), values, two)
            for depth, branched in enumerate(trail):
                on = in_bitmap(branched, keys.view(np.int64))
                keys, at = keys[on], at[on]
                if not depth:
                    keys = np.concatenate([mix(keys + np.uint64(k)) for k in range(p.subtrees)])
                    at = np.tile(at, p.subtrees)
                for _ in range(p.stride):
                    keys, further = _children(keys, values[at], two)
                    at = at[further]
            if bits is not None:
                on = in_bitmap(bits, keys.view(np.int64))
                keys, at = keys[on], at[on]
            take = pa.array(at)
            columns = [pa.array(keys.view(np.int64)), batch.column(0).take(take), batch.column(1).take(take)]
            if bits is not None:
                least = values[at].astype(np.uint8)
                columns.append(pa.array([rows[x][:4] + least[k].tobytes() + rows[x][4 + 4 * p.positions :] for k, x in enumerate(at.tolist())], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["key", "node", "component", "sketch"][: len(columns)])


def entries(named: DataFrame, p: Params, trees: list[int], two: float, trail: list[np.ndarray]) -> DataFrame:
    """key, node, component, sketch of the sets (node, component, signature) in the nodes of a level that hold two components or more.

    The keys of such nodes are found on keys alone; a bitmap of them keeps the sketches of other nodes' sets from the shuffle."""
    plain = named.mapInArrow(partial(_entries, p=p, trees=trees, two=two, trail=trail, bits=None), "key long, node long, component long")
    mixed = plain.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    bits = bitmap(mixed, "key")
    return named.mapInArrow(partial(_entries, p=p, trees=trees, two=two, trail=trail, bits=bits), "key long, node long, component long, sketch binary")


class Sketches:
    """Sizes, minwise values (a byte each) and the small sets of some sets."""

    def __init__(self, rows: list[bytes], p: Params):
        self.rows, self.p = rows, p
        self.sizes = np.array([int.from_bytes(x[:4], "little") for x in rows], dtype=np.int64)
        self.least = np.frombuffer(b"".join(x[4 : 4 + p.positions] for x in rows), dtype=np.uint8).reshape(-1, p.positions)
        self.held: dict[int, frozenset[int]] = {}

    def small(self, k: int) -> frozenset[int]:
        if k not in self.held:
            self.held[k] = frozenset(np.frombuffer(self.rows[k][4 + self.p.positions :], dtype=np.uint64).tolist())
        return self.held[k]

    def near(self, a: int, b: int, components: np.ndarray, sides: np.ndarray | None = None) -> Iterator[tuple[int, int, int]]:
        """(minus the equal positions, k, j) of the pairs from a to b, of two components, that may link: by size, by estimate, and small sets by themselves.

        Where sides differ in a list, only pairs across them."""
        p, cut = self.p, self.p.cut
        mixed = sides is not None and sides[a:b].min() != sides[a:b].max()
        for k in range(a, b - 1):
            low, high = np.minimum(self.sizes[k + 1 : b], self.sizes[k]), np.maximum(self.sizes[k + 1 : b], self.sizes[k])
            hit = (components[k + 1 : b] != components[k]) & (p.part * low >= p.whole * high)
            if mixed:
                hit &= sides[k + 1 : b] != sides[k]
            at = k + 1 + np.flatnonzero(hit)
            same = np.count_nonzero(self.least[at] == self.least[k], axis=1)
            for j, equal in zip(at[same >= cut].tolist(), same[same >= cut].tolist(), strict=True):
                if self.sizes[k] <= p.small and self.sizes[j] <= p.small:
                    both = len(self.small(k) & self.small(j))
                    if p.part * both < p.whole * (int(self.sizes[k]) + int(self.sizes[j]) - both):
                        continue
                yield -equal, k, j


def _root(x: int, parent: dict[int, int]) -> int:
    while x in parent:
        x = parent[x]
    return x


def _candidates(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    """The members of each cell that have a partner to be checked, at most as many rows as came in, by groups that such pairs connect.

    A group is named by its members, so that it is the same wherever they meet again."""
    for batch in batches:
        lists = batch.column(1)
        ends, inner = lists.offsets.to_numpy(), lists.values
        nodes, components, sides = (inner.field(k).to_numpy(zero_copy_only=False) for k in ("node", "component", "side"))
        rows = inner.field("sketch").to_pylist()
        sketches = Sketches(rows, p)
        keep, groups = [], []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            parent: dict[int, int] = {}
            asked = set()
            for _, k, j in sketches.near(a, b, components, sides):
                asked |= {k, j}
                x, y = _root(k, parent), _root(j, parent)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            if asked:
                at = np.array(sorted(asked), dtype=np.int64)
                roots = np.array([_root(x, parent) for x in at.tolist()])
                _, index = np.unique(roots, return_inverse=True)
                names = np.zeros(index.max() + 1, dtype=np.uint64)
                np.add.at(names, index, mix(nodes[at].view(np.uint64) ^ np.uint64(0x2545F4914F6CDD1D)))
                keep.append(at)
                groups.append(names[index].view(np.int64))
        keep = np.concatenate(keep) if keep else np.zeros(0, dtype=np.int64)
        groups = np.concatenate(groups) if groups else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(groups), pa.array(nodes[keep]), pa.array(components[keep]), pa.array([rows[k] for k in keep.tolist()], pa.binary())], names=["cell", "node", "component", "sketch"])
    release()


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first column, in tables that never end inside a run of it."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        cells = rows.column(0).to_numpy()
        before = np.flatnonzero(cells != cells[-1]) if cells.size else cells
        cut = int(before[-1]) + 1 if before.size else 0
        if cut:
            yield rows.slice(0, cut)
        rest = rows.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def _linked(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    """Of each group's rows with full sets: confirmed links that join all its members that can be joined, likeliest first."""
    for rows in _whole_cells(batches):
        cells, nodes, components = (rows.column(k).to_numpy() for k in range(3))
        sketches, sets = Sketches(rows.column(3).to_pylist(), p), rows.column(4)
        ends = np.concatenate([[0], np.flatnonzero(cells[1:] != cells[:-1]) + 1, [cells.size]])
        left, right = [], []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            parent: dict[int, int] = {}
            for _, k, j in sorted(sketches.near(a, b, components)):
                x, y = _root(int(components[k]), parent), _root(int(components[j]), parent)
                if x == y:
                    continue
                one, two = (np.frombuffer(sets[i].as_buffer(), dtype=np.uint64) for i in (k, j))
                both = np.intersect1d(one, two, assume_unique=True).size
                if p.part * both >= p.whole * (one.size + two.size - both):
                    parent[max(x, y)] = min(x, y)
                    left.append(nodes[k])
                    right.append(nodes[j])
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
    release()


def _wanted_sets(batches: Iterator[pa.RecordBatch], p: Params, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        keep = np.flatnonzero(in_bitmap(bits, mix(ids.astype(np.int64).view(np.uint64)).view(np.int64))) if len(ids) else []
        for _, _, texts in text_passes(batch.column(1).take(pa.array(keep, pa.int64()))):
            nodes, sets = [], []
            for s in shingle_sets(texts, p.shingle):
                if s.size:
                    one = int(np.sum(mix(s + np.uint64(1))))
                    nodes.append(one - (one >> 63 << 64))
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "set"])


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(mix(batch.column(0).to_numpy().astype(np.int64).view(np.uint64)).view(np.int64))], names=["h"])


def candidates(cells: DataFrame, p: Params) -> DataFrame:
    """cell, node, component, sketch of the members of cells (cell, members) that have a partner near the threshold, once for each group."""
    asked = cells.mapInArrow(partial(_candidates, p=p), "cell long, node long, component long, sketch binary")
    return written(asked.dropDuplicates(["cell", "node"]))


def confirmed(asked: DataFrame, sets: DataFrame, documents: DataFrame, p: Params) -> DataFrame:
    """Links (a, b) of nodes, confirmed on full sets, from candidates: at most one less than a group's members.

    Full sets are made and sent only for candidates."""
    wanted = sets.select("node", "rep").join(asked.select("node").distinct(), "node", "left_semi")
    bits = bitmap(wanted.select("rep").mapInArrow(_mixed, "h long"), "h")
    full = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null").mapInArrow(partial(_wanted_sets, p=p, bits=bits), "node long, set binary")
    full = full.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])
    listed = asked.join(full, "node").select("cell", "node", "component", "sketch", "set").repartition("cell").sortWithinPartitions("cell")
    return written(listed.mapInArrow(partial(_linked, p=p), "a long, b long").distinct())


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for every node in links (a, b): least neighbours, then jumps along labels, until nothing changes."""
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")
    links = written(links.select(both).select("x.a", "x.b").distinct())
    labels = links.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component"))
    labels = written(labels)
    while True:
        near = links.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        near = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        new = written(near.join(jump, "component", "left").select("node", "old", F.least("component", F.coalesce("further", "component")).alias("component")))
        forget(labels)
        labels = new.select("node", "component")
        if new.where("old <> component").isEmpty():
            return labels


def open_nodes(entries: DataFrame) -> DataFrame:
    """key, n, main, few of the nodes that hold two components or more: their sets, the component with most of them, and how many are not in it."""
    parts = entries.groupBy("key", "component").agg(F.count("*").alias("n"))
    nodes = parts.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("top"))
    return nodes.where("top.n < n").select("key", "n", F.col("top.component").alias("main"), (F.col("n") - F.col("top.n")).alias("few"))


def _cells(entries: DataFrame) -> DataFrame:
    return entries.groupBy("cell").agg(F.collect_set(F.struct("node", "component", "side", "sketch")).alias("members")).where(F.size("members") > 1)


def _gathered(entries: DataFrame, p: Params) -> DataFrame:
    """Entries (key, node, component, sketch, n, main, few) where nodes of several trees that hold most of one group are one node.

    Such nodes have one main component and a quarter of all sets that meet it; what they hold is compared once, not for each tree."""
    large = F.col("n") > p.leaf
    met = entries.where(large).select("main", "node", (F.col("component") != F.col("main")).alias("outside")).distinct()
    groups = met.groupBy("main").agg(F.count("*").alias("all_n"), F.count_if("outside").alias("all_few"))
    joined = entries.join(groups, "main", "left")
    dense = F.coalesce(large & (4 * F.col("n") >= F.col("all_n")), F.lit(False))
    pick = lambda new, old: F.when(dense, new).otherwise(F.col(old)).alias(old)
    named = joined.select(pick(F.xxhash64("main", F.lit(1)), "key"), "node", "component", "sketch", pick(F.col("all_n"), "n"), "main", pick(F.col("all_few"), "few"))
    return named.where(~large).union(named.where(large).dropDuplicates(["key", "node"]))


def _blocks(entries: DataFrame, p: Params) -> DataFrame:
    """Entries (key, node, component, sketch, n, main, few) dealt to cells of at most about 2 * leaf members that hold every pair of two components.

    A node of up to leaf sets is one cell. Of a larger one the sets outside the main component go, in blocks, with
    every block of the main component and with one another; pairs inside the main component are connected already."""
    n, nought = F.col("n"), F.lit(0).cast("long")
    small, outside = n <= p.leaf, F.col("component") != F.col("main")
    blocks = lambda x: F.greatest(F.lit(1).cast("long"), F.ceil(x / p.leaf).cast("long"))
    few, many = blocks(F.col("few")), blocks(n - F.col("few"))
    mine = spread("node", F.when(outside, few).otherwise(many))
    to = lambda kind, low, high, side: F.struct(F.lit(kind).alias("kind"), low.cast("long").alias("low"), high.cast("long").alias("high"), side.cast("long").alias("side"))
    across = F.transform(F.sequence(nought, many - 1), lambda j: to(1, mine, j, F.lit(1)))
    among = F.transform(F.sequence(nought, few - 1), lambda j: to(2, F.least(mine, j), F.greatest(mine, j), mine))
    inside = F.transform(F.sequence(nought, few - 1), lambda j: to(1, j, mine, F.lit(0)))
    places = F.when(small, F.array(to(0, nought, nought, nought))).when(outside, F.concat(across, among)).otherwise(inside)
    dealt = entries.withColumn("place", F.explode(places))
    return dealt.select(F.xxhash64("key", "place.kind", "place.low", "place.high").alias("cell"), "node", "component", F.col("place.side").alias("side"), "sketch")


def similar_sets(sets: DataFrame, documents: DataFrame, p: Params) -> DataFrame:
    """node, component for the distinct sets (node, rep, signature) that link with another one."""
    # 1. Random blocks of every node join most copies, whatever their number, at linear cost.
    named = sets.select("node", F.col("node").alias("component"), "signature")
    met = written(entries(named, p, list(range(1000, 1000 + p.forest_trees)), 0.0, []))
    block = spread("node", F.ceil(F.col("n") / p.leaf).cast("long"))
    met = met.join(open_nodes(met).select("key", "n"), "key")
    cells = _cells(met.select(F.xxhash64("key", block).alias("cell"), "node", "component", F.lit(0).cast("long").alias("side"), "sketch"))
    tested = candidates(cells, p)
    forget(met)
    labels = components(confirmed(tested, sets, documents, p))

    # 2. Trees, only along nodes that hold two components or more; a node is compared as soon as it is small or all but
    # a few of its sets are of one component.
    named = written(sets.select("node", "signature").join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "signature"))
    leaves, trail = None, []
    while True:
        level = written(entries(named, p, list(range(p.trees)), p.two, trail))
        nodes = written(open_nodes(level))
        # Branching copies a set many times, comparing it with the few does so few / leaf times.
        ready = (F.col("n") <= p.leaf) | (F.col("few") <= 16 * p.leaf) if 1 + (len(trail) + 1) * p.stride <= p.depth else F.lit(True)
        mine = level.join(nodes.where(ready), "key").select("key", "node", "component", "sketch", "n", "main", "few")
        leaves = mine if leaves is None else leaves.union(mine)
        large = bitmap(nodes.where(~ready), "key")
        if not large.any():
            break
        trail.append(large)
    asked = written(candidates(_cells(_blocks(_gathered(leaves, p), p)), p).join(tested.select("cell").distinct(), "cell", "left_anti"))
    further = confirmed(asked, sets, documents, p)

    # 3. The components that the trees' links join.
    end = lambda c: F.col(c).alias("node")
    known = named.select("node", "component")
    ends = further.join(known.select(end("node").alias("a"), F.col("component").alias("from")), "a").join(known.select(end("node").alias("b"), F.col("component").alias("to")), "b")
    joined = components(ends.select(F.col("from").alias("a"), F.col("to").alias("b")).where("a <> b"))
    merged = joined.select(F.col("node").alias("component"), F.col("component").alias("merged"))
    return known.join(merged, "component", "left").select("node", F.coalesce("merged", "component").alias("component"))


def near_duplicates(documents: DataFrame, p: Params = Params()) -> DataFrame:
    """One row for each row of documents (doc_id, text): doc_id, n_shingles, component_id, kept. See the module."""
    return judged_rows(documents, p).drop("text_hash", "component")


def judged_rows(documents: DataFrame, p: Params = Params()) -> DataFrame:
    """near_duplicates with text_hash (xxhash64 of the text) and component (names the group itself, null without words)."""
    rows = written(signatures(documents, p))
    named = rows.where("node is not null and doc_id is not null")
    sets = written(named.groupBy("node", "node2").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")).drop("node2"))
    linked = similar_sets(sets, documents, p)
    least = sets.select("node", "rep").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = least.groupBy("component").agg(F.min("rep").alias("component_id")).join(least.select("node", "component"), "component").select("node", "component", "component_id")
    out = rows.select("doc_id", "text_hash", "n_shingles", "node").join(least, "node", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "text_hash", "component", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
